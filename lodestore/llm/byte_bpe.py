"""Byte-level BPE by Spark higher-order functions: ranked merges folded over byte arrays.

Each match of the split pattern is a word. A word that is a token itself is one id;
any other is cut into its bytes and an ``aggregate`` folds the merges, lowest rank and
then leftmost first, looking ranks up in a literal map from pairs of ids. Spark looks maps
up by a linear scan, so the map is the pairs' sparse matrix with its rows displaced into
one array, where a lookup is two array accesses. It comes from a table of one row by a scalar
subquery, which Spark turns into a literal when the query runs: as a literal written into the plan,
its printed form would fill the driver.

What is folded are distinct words: those that a bounded sample of the texts holds most often,
once; the others once for each block of documents (``BLOCK_WORDS`` words of one task) that holds
them. Within a task a block's distinct words go ahead of its documents, whose words are
numbers in the block's list by then; what follows the fold sets the ids in the order of the
words. No text or word is shuffled. Sample and blocks decide how often a word is folded, never
to what. Words over ``LONG_WORD`` bytes, for which a fold of arrays is quadratic, are
merged by an exact heap. Decoding concatenates the ids' binary pieces in Arrow batches.

Defined results: null text counts as empty; an empty text has no ids, and the hashes of
empty strings. Repeated rows are encoded each. Other columns pass through untouched.
"""

from __future__ import annotations

import base64
import ctypes
import gc
import heapq
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

from lodestore.llm.common import fresh, stored

#: Bytes of a word beyond which the fold gives way to the heap.
LONG_WORD = 512
#: Frequent words that are folded beforehand, and documents of their sample, at most.
CACHED_WORDS, SAMPLE_DOCS = 1 << 18, 20_000
#: Words of a block, unless one document holds more; distinct words in a row on their way to the fold.
BLOCK_WORDS, ROW_WORDS = 4_000_000, 1024
#: Documents whose words or ids are laid out at once.
SLICE = 250
#: No merge, and no piece: the last of all characters.
NEVER = "\U0010ffff"
#: Rows of an Arrow batch: their words are many.
SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


def java_pattern(pattern: str) -> str:
    """The split pattern for Java: white space by Unicode, as in the tokenizer."""
    return "(?U)" + pattern


def merge_pairs(ranks: dict[bytes, int]) -> dict[int, list[tuple[int, int]]]:
    """For each id the ids that may follow it in a merge, with the rank, which is the new id."""
    out: dict[int, list[tuple[int, int]]] = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None:
                out.setdefault(a, []).append((b, rank))
    return out


def displaced(rows: dict[int, list[tuple[int, int]]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A sparse matrix in one array: the shift of each row, and for each place its row and value; first fit, long rows first."""
    step = 4096
    free = np.ones(size + step, bool)
    shift, where = np.zeros(size, np.int64), []
    last, at = None, 0
    for a, row in sorted(rows.items(), key=lambda x: -len(x[1])):
        if len(row) != last:
            last, at = len(row), 0
        columns = np.array([b for b, _ in row])
        while True:
            if at + size + step > len(free):
                free = np.concatenate([free, np.ones(len(free), bool)])
            fits = free[at + columns[0] : at + columns[0] + step].copy()
            for c in columns[1:]:
                fits &= free[at + c : at + c + step]
            if fits.any():
                break
            at += step
        shift[a] = at + int(fits.argmax())
        free[shift[a] + columns] = False
        where.append((a, shift[a] + columns, np.array([r for _, r in row])))
    n = int(np.flatnonzero(~free)[-1]) + size + 1 if where else size
    owner, value = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    for a, places, values in where:
        owner[places], value[places] = a, values
    return shift, owner, value


@contextmanager
def settings(spark: SparkSession) -> Iterator[None]:
    """SETTINGS hold meanwhile."""
    before = {k: spark.conf.get(k) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def bind(value: Column, body) -> Column:
    """body(value) with value computed once: a lambda variable instead of a repeated expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def symbol(id_: int) -> str:
    """The character that stands for a token of several bytes in a folded word. Characters are in the order of the ids."""
    code = 256 + id_
    return chr(code if code < 0xD800 else code + 0x800)  # not a surrogate


def fold_word(word: Column, t: Column) -> Column:
    """Ids of one word. t: the literals.

    The fold's state is two strings, whose functions move no boxed values: p has a character for each piece, its byte or
    symbol(), between two NEVERs; r has at each place the symbol that the piece there and its successor merge to, or NEVER.
    """

    def merged(a: Column, b: Column) -> Column:
        place = F.get(t["shift"], a) + b
        return F.when(F.get(t["owner"], place) == a, F.get(t["symbol"], place)).otherwise(F.lit(NEVER))

    def begin(p: Column) -> Column:
        pairs = F.zip_with(F.split(p, ""), F.split(F.substring(p, 2, 1 << 30), ""), lambda x, y: merged(F.ascii(x), F.ascii(y)))
        return F.struct(p.alias("p"), F.array_join(pairs, "").alias("r"))

    def merge(s: Column, _: Column) -> Column:
        # a lambda variable by aggregate() over one value: cheaper than bind(), which asks for its type at each step
        def joined(s: Column, least: Column) -> Column:
            def at(s: Column, i: Column) -> Column:  # counted from 1; NEVERs stand on either side
                p, new = s["p"], F.ascii(least)
                both = F.concat(merged(F.ascii(F.substring(p, i - 1, 1)), new), merged(new, F.ascii(F.substring(p, i + 2, 1))))
                return F.struct(F.overlay(p, least, i, 2).alias("p"), F.overlay(s["r"], both, i - 1, 3).alias("r"))

            return F.when(least < NEVER, F.aggregate(F.array(F.instr(s["r"], least)), s, at)).otherwise(s)

        return F.aggregate(F.array(F.array_min(F.split(s["r"], ""))), s, joined)

    def ids(s: Column) -> Column:
        return F.transform(F.split(F.substring(s["p"], F.lit(2), F.char_length(s["p"]) - 2), ""), lambda c: F.get(t["id"], F.ascii(c)))

    as_bytes = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
    return F.aggregate(F.sequence(F.lit(2), F.octet_length(word)), begin(F.concat(F.lit(NEVER), as_bytes, F.lit(NEVER))), merge, ids)


def heap_merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word, in n log n: a heap of candidate pairs over a linked list of pieces."""
    n = len(word)
    end, nxt, prev, alive = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if (j := nxt[i]) < n and (r := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or (j := nxt[i]) >= n or end[j] != stop:
            continue
        end[i], nxt[i], alive[j] = stop, nxt[j], False
        if nxt[j] < n:
            prev[nxt[j]] = i
        offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


class ByteBpe:
    """The encoder of one rank file. encode() gives a table with ids, decode() a column."""

    def __init__(self, spark: SparkSession, rank_path: str, pattern: str):
        self.spark, self.pattern = spark, java_pattern(pattern)
        self.ranks = load_ranks(rank_path)
        code = {i: t[0] if len(t) == 1 else ord(symbol(i)) for t, i in self.ranks.items()}
        pairs = {code[a]: [(code[b], code[i]) for b, i in row] for a, row in merge_pairs(self.ranks).items()}
        shift, owner, value = displaced(pairs, 1 + max(code.values(), default=255))
        id_of: list[int | None] = [None] * len(shift)
        for i, c in code.items():
            id_of[c] = i
        used = owner >= 0
        symbols = [chr(x) if u else None for x, u in zip(value.tolist(), used, strict=True)]
        arrays = {"shift": pa.array(shift, pa.int32()), "owner": pa.array(owner, pa.int32(), mask=~used), "symbol": pa.array(symbols, pa.string()), "id": pa.array(id_of, pa.int32())}
        row = pa.table({k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for k, v in arrays.items()})
        self.tables = stored(spark.createDataFrame(row).coalesce(1), "ranks").select(F.struct(*arrays).alias("tables"))
        self.known: Known | None = None

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), F.lit(0))

    def fold(self, df: DataFrame, words: str, ids: str) -> DataFrame:
        """df with the ids of each of an array of words, if there is one; none for words over LONG_WORD bytes.

        The literal may be copied with a row, so rows should hold many words; those without any hold no literal.
        """
        t = fresh(df, "tables")
        some = F.col(words).isNotNull()
        short = lambda t: lambda x: F.when(F.octet_length(x) <= LONG_WORD, fold_word(x, t)).otherwise(F.array().cast("array<int>"))
        arrays = F.struct(*[F.col(t)[x].alias(x) for x in ("shift", "owner", "symbol", "id")])
        folded = bind(arrays, lambda t: F.transform(F.col(words), short(t)))
        return df.withColumn(t, F.when(some, self.tables.scalar())).withColumn(ids, F.when(some, folded)).drop(t)

    def fold_frequent(self, docs: DataFrame, text: str) -> None:
        """The words known beforehand: tokens, and the distinct others that a bounded sample holds most often, folded."""
        tokens: dict[str, int] = {}
        for t, i in self.ranks.items():
            try:
                tokens[t.decode()] = i
            except UnicodeDecodeError:  # no word by itself
                continue
        n = docs.count()
        part = docs if n <= SAMPLE_DOCS else docs.sample(SAMPLE_DOCS / n, seed=7).limit(2 * SAMPLE_DOCS)
        single = self.spark.createDataFrame(pa.table({"w": pa.array(list(tokens), pa.string())}))
        often = (
            part.select(F.explode(self.words(F.col(text))).alias("w")).where(F.octet_length("w") <= LONG_WORD)
            .groupBy("w").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(single), "w", "left_anti").orderBy(F.desc("n"), "w").limit(CACHED_WORDS)
        )
        often = stored(often.select("w"), "words")
        rows = often.groupBy(F.pmod(F.xxhash64("w"), F.lit(-(-CACHED_WORDS // ROW_WORDS))).alias("k")).agg(F.collect_list("w").alias("ws"))
        folded = self.fold(rows.repartition(4 * self.spark.sparkContext.defaultParallelism, "k"), "ws", "ids")
        folded = folded.select(F.explode(F.arrays_zip("ws", "ids")).alias("x")).select("x.ws", "x.ids").toArrow()  # rows as objects would fill the driver
        w, ids = folded.column(0).combine_chunks().cast(pa.string()), folded.column(1).combine_chunks()
        self.known = Known(
            pa.concat_arrays([pa.array(list(tokens), pa.string()), w]),
            np.concatenate([np.ones(len(tokens), np.int32), ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)]),
            np.concatenate([np.array(list(tokens.values()), np.int32), ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32)]),
        )

    def encode(self, docs: DataFrame, text: str = "text", ids: str = "ids", keep: list[str] | None = None, decoded: str | None = None) -> DataFrame:
        """docs, or its columns in keep, with a column of ids and, if named, one of the bytes decoded from them."""
        if self.known is None:
            self.fold_frequent(docs, text)
        kept = docs.select(*(docs.columns if keep is None else keep))
        w, rare, folded = (fresh(docs, x) for x in ("words", "rare", "folded"))
        ints = ArrayType(IntegerType(), False)
        # rows of distinct words have no document
        blocks = StructType([*(StructField(f.name, f.dataType) for f in kept.schema), StructField(w, ints), StructField(rare, ArrayType(StringType(), False))])
        schema = StructType([*kept.schema, StructField(ids, ints), *([StructField(decoded, BinaryType())] if decoded else [])])
        numbered = docs.select(*kept.columns, self.words(F.col(text)).alias(w)).mapInArrow(_numbered(self.known.words, blocks.names), blocks)
        return self.fold(numbered, rare, folded).mapInArrow(_in_order(self.known.lengths, self.known.ids, self.ranks, schema.names, _pieces(self.ranks) if decoded else None), schema)

    def decode(self, ids: Column) -> Column:
        """The bytes of an array of ids: their binary pieces, put together."""
        return F.arrow_udf(_pieces(self.ranks), "binary")(ids)


def digests(bpe: ByteBpe, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256; a written table."""
    ids = F.col("ids")
    joined = F.array_join(ids.cast("array<string>"), ",")
    encoded = bpe.encode(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", "ids", keep=["id"], decoded="decoded")
    out = encoded.select(
        F.col("id").alias(id_col), F.size(ids).cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
    with settings(bpe.spark):
        return stored(out, "digests")


def _pieces(ranks: dict[bytes, int]):
    """A function of arrays of ids: the bytes of each."""
    by_id = sorted((i, t) for t, i in ranks.items())
    size = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
    size[[i for i, _ in by_id]] = [len(t) for _, t in by_id]
    at, pool = np.cumsum(size) - size, np.frombuffer(b"".join(t for _, t in by_id), np.uint8)

    def decoded(lists: pa.Array) -> pa.Array:
        out = []
        for k in range(0, len(lists), SLICE):
            part = lists.slice(k, SLICE)
            ids = part.flatten().to_numpy(zero_copy_only=False)
            end = np.concatenate([[0], np.cumsum(size[ids])])
            data = pool[np.repeat(at[ids] - end[:-1], size[ids]) + np.arange(end[-1])]
            out.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(end[_ends(part)].astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary()))
        return pa.concat_arrays(out) if out else pa.array([], pa.binary())

    return decoded


@dataclass
class Known:
    """Words whose ids are known, the numbers of their ids, and the ids, one word's after the other's."""

    words: pa.Array
    lengths: np.ndarray
    ids: np.ndarray


def _numbered(known: pa.Array, names: list[str]):
    """A mapInArrow function. In: rows with their words last. Out, block by block: rows of words that aren't known, then the
    documents with the numbers of their words, those of the known words first."""

    def block(held: list[list[pa.Array]], offsets: list[np.ndarray], coded: list[pa.DictionaryArray]) -> Iterator[pa.RecordBatch]:
        whole = pa.chunked_array(coded).unify_dictionaries()
        words = whole.chunk(0).dictionary
        number = pc.index_in(words, value_set=known)
        new = number.is_null()
        rare = words.filter(new)
        number, new = number.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int32), new.to_numpy(zero_copy_only=False)
        number[new] = len(known) + np.arange(len(rare), dtype=np.int32)
        n = -(-len(rare) // ROW_WORDS)
        if n:
            ends = np.minimum(np.arange(n + 1) * ROW_WORDS, len(rare)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), rare)
            yield pa.RecordBatch.from_arrays([*(pa.nulls(n, x.type) for x in held[0]), pa.nulls(n, pa.list_(pa.int32())), lists], names=names)
        for columns, ends, code in zip(held, offsets, whole.chunks, strict=True):
            numbers = pa.array(number[code.indices.to_numpy()] if len(code) else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(ends), numbers), pa.nulls(len(ends) - 1, pa.list_(pa.string()))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, offsets, coded, size = [], [], [], 0
        for b in batches:
            for k in range(0, b.num_rows, SLICE):
                part = b.slice(k, SLICE)
                words = part.column(part.num_columns - 1)
                held.append(part.columns[:-1])
                offsets.append(_ends(words))
                coded.append(words.flatten().cast(pa.string()).dictionary_encode())
                size += len(coded[-1])
                if size >= BLOCK_WORDS:
                    yield from block(held, offsets, coded)
                    held, offsets, coded, size = [], [], [], 0
        if held:
            yield from block(held, offsets, coded)
        del held, offsets, coded
        _give_back()

    return run


def _give_back() -> None:
    """Freed memory goes back to the system: workers live on between tasks, several to an executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def _ends(lists: pa.ListArray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int32)


def _in_order(lengths: np.ndarray, known_ids: np.ndarray, ranks: dict[bytes, int], names: list[str], pieces):
    """A mapInArrow function: what _numbered gives, with the unknown words' ids last, to the ids of each document in order."""
    first = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pool, new = first, known_ids, True  # where each word's ids begin; new: no document of the block has come
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            is_words = b.column(b.num_columns - 2).is_valid().to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(is_words)) + 1).tolist(), b.num_rows]
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if i == j:
                    continue
                run_of = b.slice(i, j - i)
                if is_words[i]:
                    parts = parts if new else []
                    new = True
                    parts.append(_word_ids(run_of.column(b.num_columns - 2).flatten(), run_of.column(b.num_columns - 1).flatten(), ranks))
                    continue
                if new and parts:
                    at = np.concatenate([first, first[-1] + np.cumsum(np.concatenate([x for x, _ in parts]))])
                    pool = np.concatenate([known_ids, *(x for _, x in parts)])
                new = False
                for k in range(0, run_of.num_rows, SLICE):
                    part = run_of.slice(k, SLICE)
                    numbers = part.column(b.num_columns - 3)
                    w = numbers.flatten().to_numpy(zero_copy_only=False)
                    size = at[w + 1] - at[w]
                    end = np.concatenate([[0], np.cumsum(size)])
                    ids = pool[np.repeat(at[w] - end[:-1], size) + np.arange(end[-1])]
                    lists = pa.ListArray.from_arrays(pa.array(end[_ends(numbers)].astype(np.int32)), pa.array(ids))
                    yield pa.RecordBatch.from_arrays([*part.columns[:-3], lists, *([pieces(lists)] if pieces else [])], names=names)
        del at, pool, parts
        _give_back()

    return run


def _word_ids(words: pa.Array, ids: pa.ListArray, ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of ids of each word, and the ids; words too long for the fold are merged here."""
    lengths, flat = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    long_words = np.flatnonzero(pc.greater(pc.binary_length(words.cast(pa.binary())), LONG_WORD).to_numpy(zero_copy_only=False))
    if len(long_words):
        at = np.cumsum(lengths) - lengths
        merged = [np.array(heap_ids(words[int(i)].as_py().encode(), ranks), np.int32) for i in long_words]
        flat = np.insert(flat, np.repeat(at[long_words], [len(x) for x in merged]), np.concatenate(merged))
        lengths[long_words] = [len(x) for x in merged]
    return lengths, flat


def heap_ids(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    return [ranks[word]] if word in ranks else heap_merge(word, ranks)
