"""Token ids in ORC: stripes of run-length encoded integers, row indexes, Bloom filters on ids.

Documents are range-partitioned and sorted by id, encoded in Arrow batches and written by
Spark's ORC writer, so stripes are read in parallel and a range or a single id prunes
stripes by their statistics and Bloom filters. The tokens before a document are a
running sum within a file upon the sum of the files before.

White space never joins or takes part in a token of the tokenizers meant here (NORMALIZERS and the
pre-tokenizer of one file; with others whole texts are encoded), so a text's
ids are those of its chunks between ASCII blanks. Of a step's texts, Arrow finds the distinct chunks
and, of chunks of letters and then marks, the distinct stems in lower case and marks; those met before in
the worker are taken from caches whose bytes are counted, each other one is encoded by the library, and
Arrow puts the ids in the texts' order. Special tokens in a text get
their own ids, as is the library's default; a chunk that holds one is encoded whole.

Defined results: null text counts as empty and has the end id alone. Null ids come first;
rows with one id are separate documents, next to each other, ordered by a hash of the text. An
empty table gives an archive without documents. Other columns are not written.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestore.llm.common import stored, text_or_empty

#: Bytes that a worker's caches of chunks, and of stems, hold; they start anew beyond.
CACHE_BYTES, PART_BYTES = 140 << 20, 250 << 20
#: Bytes of an entry besides two for each character of its key and its ids, at most; stems encoded in one call.
ENTRY, CALL = 212, 400
#: Characters of a key that the caches keep, at most.
CACHED_CHARS = 128
#: Bytes of the texts whose chunks are taken together; a longer text is taken by itself.
STEP = 4 << 20
# How a tokenizer prepares a text that may be cut between blanks.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PRE_TOKENIZER = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Ends the last token of a stretch of letters, and no other.
LAST = "</w>"
#: Marks that may end a chunk; letters whose lower case is more than one letter or depends on others.
MARKS = ".,;:!?*%$&#|"
_LOWER_BY_CONTEXT = "[İΣ]"
_workers: dict = {}


def _held(entries: dict[str, bytes]) -> int:
    return ENTRY * len(entries) + 2 * sum(map(len, entries)) + sum(map(len, entries.values()))


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


def _lists(blobs: list[bytes]) -> pa.ListArray:
    """Lists of ids from their bytes."""
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(blobs))]))


def _joined(lists: pa.ListArray, at: np.ndarray) -> pa.ListArray:
    """Of neighbouring lists one each: from list at[i] up to at[i + 1]."""
    return pa.ListArray.from_arrays(pa.array(np.asarray(lists.offsets)[at]), lists.values)


class _Encoder:
    """One tokenizer with its caches; lives as long as its Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.cache_bytes = self.part_bytes = 0
        known = json.loads(self.tokenizer.to_str())
        normalizers = [x["type"] for x in (known["normalizer"] or {}).get("normalizers", [])]
        split = (known["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        self.by_chunk = (normalizers, split) == (NORMALIZERS, PRE_TOKENIZER)
        self.stems = self._for_stems(known) if self.by_chunk else None

    def _for_stems(self, known: dict):
        """The tokenizer without what leaves letters in lower case as they are, or None where ends of stems don't show in its tokens."""
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        model, bytes_only = known["model"], known["pre_tokenizer"]["pretokenizers"][1:]
        if [x["type"] for x in bytes_only] != ["ByteLevel"] or bytes_only[0]["add_prefix_space"] or bytes_only[0]["use_regex"]:
            return None
        if model["type"] != "BPE" or model["end_of_word_suffix"] != LAST or not all(c in model["vocab"] and c + LAST in model["vocab"] for c in ByteLevel.alphabet()):
            return None
        vocab = model["vocab"]
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith(LAST)]] = True
        at_spaces = {"type": "Split", "pattern": {"String": " "}, "behavior": "Removed", "invert": False}
        short = {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [at_spaces, *bytes_only]}}
        return Tokenizer.from_str(json.dumps(known | short))

    def _whole(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. One to a call: as fast as many, and only one is in the library's memory."""
        return [np.array(self.tokenizer.encode_batch_fast([t], add_special_tokens=False)[0].ids, "<u4").tobytes() for t in texts]

    def _of_stems(self, stems: list[str]) -> list[bytes]:
        """The ids of each stem, from many stems in one text."""
        if self.stems is None:
            return self._whole(stems)
        out = []
        for at in range(0, len(stems), CALL):
            some = stems[at : at + CALL]
            (found,) = self.stems.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            ends, raw = 4 * (np.flatnonzero(self.last[ids]) + 1), ids.tobytes()
            out += [raw[i:j] for _, i, j in zip(some, [0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        return out

    @staticmethod
    def _learn(keys: list[str], held: dict[str, bytes], encode) -> tuple[list[bytes], int]:
        """The ids of keys, those that held hasn't by encode; held keeps the short ones, whose bytes are returned."""
        found = list(map(held.get, keys))
        new = [k for k, x in zip(keys, found, strict=True) if x is None]
        learned = dict(zip(new, encode(new), strict=True))
        short = {k: x for k, x in learned.items() if len(k) <= CACHED_CHARS}
        held.update(short)
        return [learned[k] if x is None else x for k, x in zip(keys, found, strict=True)], _held(short)

    def _of_chunks(self, chunks: pa.Array) -> pa.ListArray:
        """The ids of each distinct chunk.

        A chunk of letters and then marks is cut in two, and the letters lowered: the tokenizer cuts there and lowers itself.
        Only where lowering is by the letter and the chunk is composed already.
        """
        if self.cache_bytes > CACHE_BYTES:
            self.cache.clear()
            self.cache_bytes = 0
        if self.part_bytes > PART_BYTES:
            self.parts.clear()
            self.part_bytes = 0
        stem = pc.utf8_rtrim(chunks, characters=MARKS)
        cut = pc.and_not(pc.utf8_is_alpha(stem), pc.match_substring_regex(stem, _LOWER_BY_CONTEXT))
        mask, wide = np.array(cut, bool), ~np.asarray(pc.string_is_ascii(stem), bool)
        mask[wide] &= np.array([unicodedata.is_normalized("NFC", s) for s in _strings(stem.filter(pa.array(wide)))], bool)
        cut = pa.array(mask)
        stems = pc.utf8_lower(stem.filter(cut)).dictionary_encode()
        marks = pc.replace_substring_regex(chunks.filter(cut), f"^[^{MARKS}]+", "")
        rest = pa.concat_arrays([chunks.filter(pc.invert(cut)), marks]).dictionary_encode()
        of_stems, more = self._learn(_strings(stems.dictionary), self.parts, self._of_stems)
        self.part_bytes += more
        of_rest, more = self._learn(_strings(rest.dictionary), self.cache, self._whole)
        self.cache_bytes += more
        # two lists of ids to a chunk: its stem's and its marks', or its own and an empty one
        two = np.full((len(chunks), 2), len(of_stems) + len(of_rest), np.int32)
        places, whole = np.asarray(rest.indices) + len(of_stems), len(chunks) - len(marks)
        two[mask, 0], two[mask, 1], two[~mask, 0] = np.asarray(stems.indices), places[whole:], places[:whole]
        pairs = _lists([*of_stems, *of_rest, b""]).take(pa.array(two.ravel()))
        return _joined(pairs, np.arange(0, 2 * len(chunks) + 1, 2))

    def encode(self, texts: pa.Array, end: bytes) -> pa.ListArray:
        """The ids of each text and then the end's."""
        if not self.by_chunk:
            return _lists([x + end for x in self._whole(texts.to_pylist())])
        split = pc.ascii_split_whitespace(texts)
        chunks, offsets = split.values.dictionary_encode(), np.asarray(split.offsets)
        known = pa.concat_arrays([self._of_chunks(chunks.dictionary), _lists([end])])
        places = np.insert(np.asarray(chunks.indices), offsets[1:], len(known) - 1)
        return _joined(known.take(pa.array(places)), offsets + np.arange(len(offsets)))

    def ids(self, texts: list[str]) -> list[bytes]:
        lists = self.encode(pa.array(texts, pa.string()), b"")
        values, offsets = np.asarray(lists.values).astype("<u4"), np.asarray(lists.offsets)
        return [values[i:j].tobytes() for i, j in zip(offsets[:-1], offsets[1:], strict=True)]


def _steps(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Where steps of at most STEP bytes, or one text, begin and end."""
    ends, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP, "right")))
        yield at, to
        at = to


def _encoder(path: str) -> _Encoder:
    if path not in _workers:
        _workers[path] = _Encoder(path)
    return _workers[path]


def encode(docs: DataFrame, tokenizer_path: str, end_id: int, text_col: str = "text") -> DataFrame:
    """id, ids of each row; docs needs the columns id and text_col."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(tokenizer_path)
        for b in batches:
            texts = pc.fill_null(b.column(1), "")
            for i, j in _steps(texts):
                ids = enc.encode(texts.slice(i, j - i), end)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), ids], names=["doc_id", "ids"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", text_col).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", stripe_bytes: int = 64 << 20, stride: int = 1000) -> None:
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    writer = encode(ordered, tokenizer_path, end_id).write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
    writer.option("orc.create.index", "true").option("orc.row.index.stride", str(stride)).option("orc.stripe.size", str(stripe_bytes)).orc(path)


def read(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """doc_id, ids and start, the number of ids of all documents before."""
    rows = spark.read.schema(f"doc_id {id_type}, ids array<int>").orc(path)
    rows = rows.withColumns({"n": F.size("ids").cast("long"), "file": F.col("_metadata.file_name"), "row": F.monotonically_increasing_id()})
    return _placed(rows)


def _placed(rows: DataFrame) -> DataFrame:
    files = rows.groupBy("file").agg(F.sum("n").alias("total"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count_if(F.col("doc_id").isNull()).alias("nulls"))
    order = Window.orderBy((F.col("nulls") > 0).desc(), F.col("low").asc_nulls_first(), F.col("high").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("base"))
    here = Window.partitionBy("file").orderBy(F.col("doc_id").asc_nulls_first(), "row").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n").over(here), F.lit(0)) + F.col("base")
    return rows.join(files, "file").withColumn("start", start).drop("file", "row", "base", "n")


def lookup(spark: SparkSession, path: str, doc_id, id_type: str = "bigint") -> DataFrame:
    """The ids of one document; statistics and Bloom filters leave out other stripes."""
    return spark.read.schema(f"doc_id {id_type}, ids array<int>").orc(path).where(F.col("doc_id") == doc_id)


def digests(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document in the files."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for b in batches:
            ids = b.column(3)
            values, offsets = np.asarray(ids.values).astype("<u4"), np.asarray(ids.offsets)
            sums = [zlib.crc32(values[i:j].tobytes()) for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())], names=["file", "row", "doc_id", "n", "ids_crc32"])

    rows = spark.read.schema(f"doc_id {id_type}, ids array<int>").orc(path)
    rows = rows.select(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("row"), "doc_id", "ids")
    slim = stored(rows.mapInArrow(crc, f"file string, row long, doc_id {id_type}, n long, ids_crc32 long"), "digests")  # read twice below
    slim = slim.withColumn("n_tokens", F.col("n"))
    return _placed(slim).select("doc_id", "start", "n_tokens", "ids_crc32")
