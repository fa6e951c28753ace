"""Schemas of the store's tables, as DDL, and typed errors."""

from __future__ import annotations

CHUNKS = (
    "id STRING, document STRING, embedding ARRAY<FLOAT>, wing STRING, room STRING, hall STRING, source_file STRING, chunk_index INT, "
    "added_by STRING, filed_at STRING, date STRING, entities ARRAY<STRING>, importance DOUBLE, ingest_mode STRING, normalize_version INT, "
    "source_mtime DOUBLE, session_id STRING, ts STRING, role STRING, extra MAP<STRING,STRING>"
)
INDEX_LINES = ("source_file STRING, line_no INT, topic STRING, entities ARRAY<STRING>, chunk_ids ARRAY<STRING>, pack_no INT")
ENTITIES = ("id STRING, name STRING, type STRING, properties STRING, created_at STRING")
TRIPLES = (
    "id STRING, subject STRING, predicate STRING, object STRING, valid_from STRING, valid_to STRING, confidence DOUBLE, "
    "source_closet STRING, source_file STRING, source_drawer_id STRING, adapter_name STRING, extracted_at STRING"
)
_END = "STRUCT<wing:STRING,room:STRING,drawer_id:STRING>"
LINKS = (f"id STRING, source {_END}, target {_END}, label STRING, created_at STRING, updated_at STRING")
MESSAGES = ("session_id STRING, uuid STRING, timestamp STRING, role STRING, content STRING")


class StoreError(Exception):
    """Any misuse of the store."""


class UnsupportedFilter(StoreError):
    """A filter holds an operator that the grammar hasn't."""


class DimensionMismatch(StoreError):
    """Vectors of another length than the collection's."""


class DuplicateId(StoreError):
    """add() met an id that is there already."""
