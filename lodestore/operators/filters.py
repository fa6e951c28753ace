"""The filter language: dicts of conditions on columns, compiled to one Column.

Keys at one level are all required. A bare value is ``$eq``. A missing value (null) equals
nothing, so it passes ``$ne`` and ``$nin`` and fails all else. Unknown operators raise.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestore.schema import UnsupportedFilter

Where = Mapping[str, Any]

_COMPARE: dict[str, Callable[[Column, Any], Column]] = {
    "$eq": lambda c, v: c == F.lit(v),
    "$ne": lambda c, v: ~c.eqNullSafe(F.lit(v)),
    "$gt": lambda c, v: c > F.lit(v),
    "$gte": lambda c, v: c >= F.lit(v),
    "$lt": lambda c, v: c < F.lit(v),
    "$lte": lambda c, v: c <= F.lit(v),
    "$in": lambda c, v: c.isin(list(v)),
    "$nin": lambda c, v: ~F.coalesce(c.isin(list(v)), F.lit(False)),
    "$contains": lambda c, v: F.contains(c, F.lit(v)),
}


def _all(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def where(spec: Where | None) -> Column:
    """The condition of a metadata filter; an empty one holds always."""
    parts = []
    for key, value in (spec or {}).items():
        if key == "$and":
            parts.append(_all([where(x) for x in value]))
        elif key == "$or":
            parts.append(reduce(lambda a, b: a | b, [where(x) for x in value], F.lit(False)))
        elif key.startswith("$"):
            raise UnsupportedFilter(key)
        elif isinstance(value, Mapping):
            for op, operand in value.items():
                if op not in _COMPARE:
                    raise UnsupportedFilter(op)
                parts.append(_COMPARE[op](F.col(key), operand))
        else:
            parts.append(F.col(key) == F.lit(value))
    return F.coalesce(_all(parts), F.lit(False))


def where_document(spec: Where | None, document: str = "document") -> Column:
    """``$contains`` only: an exact substring of the document."""
    parts = []
    for op, value in (spec or {}).items():
        if op != "$contains":
            raise UnsupportedFilter(op)
        parts.append(F.contains(F.col(document), F.lit(value)))
    return F.coalesce(_all(parts), F.lit(False))


def scope(wing: str | None = None, room: str | None = None) -> dict[str, Any]:
    """The filter of a wing, a room, both or neither."""
    parts = [{k: v} for k, v in (("wing", wing), ("room", room)) if v]
    return {"$and": parts} if len(parts) == 2 else (parts[0] if parts else {})


def get(chunks: DataFrame, ids: list | None = None, spec: Where | None = None, limit: int | None = None, offset: int = 0) -> DataFrame:
    """Rows by ids and filter, in order of id."""
    rows = chunks.where(where(spec))
    if ids is not None:
        rows = rows.where(F.col("id").isin(ids))
    rows = rows.orderBy("id")
    if offset:
        rows = rows.offset(max(0, offset))
    return rows if limit is None else rows.limit(limit)


def preview(document: str | Column, n: int = 200) -> Column:
    """The first n characters, with dots where more follow."""
    c = F.col(document) if isinstance(document, str) else document
    return F.when(F.char_length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def snippet(document: str | Column, n: int = 200) -> Column:
    """One trimmed line of at most n characters and dots."""
    c = F.col(document) if isinstance(document, str) else document
    return preview(F.replace(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), F.lit("\n"), F.lit(" ")), n)


def base_name(path: str | Column) -> Column:
    c = F.col(path) if isinstance(path, str) else path
    return F.coalesce(F.nullif(F.element_at(F.split(c, "/"), -1), F.lit("")), F.lit("?"))
