"""A stored full-text index: postings in blocks of documents with maxima, and top-k that skips blocks by them.

Documents are numbered as they are read, and ``BLOCK`` numbers are a block. A row of ``postings`` holds what one
term has in one block: the documents' places in it, frequencies, lengths, and the ``impact``, the highest weight that the term
gives any of these documents. Rows are range-partitioned and sorted by term and block, so a term's rows lie together, a
frequent term's in several files, and a filter on terms prunes files and row groups. ``terms`` holds document frequencies,
``documents`` each place's id, ``corpus`` one row of totals.

The sum of its terms' impacts bounds the score of any document of a block. ``search`` scores the blocks with the
highest bounds first, takes each query's k-th best score so far for its threshold, and then reads only blocks
whose bound reaches that; results are those of full scoring. ``plan`` tells which blocks are read.

Defined results: null and empty documents count in the corpus and match nothing. Null ids are kept. Rows with one id are
documents each. A query without known words has no results. Equal scores, to six places, are ordered by id.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from lodestore import scratch
from lodestore.functions import analyze
from lodestore.operators import filters, ranking
from lodestore.schema import UnsupportedFilter

# The weights of the store's full-text index.
K1, B = 1.2, 0.75
#: Documents of a block; a divisor of 2**33, so that a block is of one task, and at most 2**15.
BLOCK = 256
#: Queries that are scored together in a block.
QUERIES = 4096
#: Blocks that give a query's threshold, for each document asked for; distinct query terms whose table goes to all tasks.
FIRST_BLOCKS, BROADCAST_TERMS = 2, 100_000
POSTINGS = "postings"


@dataclass
class Index:
    spark: SparkSession
    path: str
    k1: float = K1
    b: float = B

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")


def _stems(found: DataFrame, word: str) -> DataFrame:
    """found with its words replaced by their stems; a word is stemmed once."""
    return found.join(analyze.stemmed(found.select(word).distinct(), word), word).drop(word).withColumnRenamed("stem", "term")


def _lists(starts: np.ndarray, n: int, values) -> pa.ListArray:
    """Lists that begin at starts, the last one ending at n."""
    return pa.ListArray.from_arrays(pa.array(np.append(starts, n).astype(np.int32)), values)


def _borders(*keys: np.ndarray) -> np.ndarray:
    """Where one of the keys isn't what it was in the row before."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


#: A posting's bytes in a binary: the document's place in its block, frequency, words of the document.
POSTING = np.dtype([("place", "<i2"), ("tf", "<i4"), ("length", "<i4")])
_PARTS = "array<struct<block: long, docs: binary>>"


def _packed(starts: np.ndarray, place: np.ndarray, tf: np.ndarray, length: np.ndarray) -> pa.Array:
    """Binaries of the postings that begin at starts."""
    out = np.zeros(len(place), POSTING)
    out["place"], out["tf"], out["length"] = place, tf, length
    ends = np.append(starts, len(place)) * POSTING.itemsize
    if ends[-1] < 2**31:
        return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out)])
    return pa.array([out[i:j].tobytes() for i, j in zip(starts, [*starts[1:], len(place)], strict=True)], pa.binary())


def _unpacked(docs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All postings of an array of binaries, and each one's row."""
    ends = np.frombuffer(docs.buffers()[1], np.int32)[docs.offset : docs.offset + len(docs) + 1]
    found = np.frombuffer(docs.buffers()[2], POSTING, (ends[-1] - ends[0]) // POSTING.itemsize, ends[0])
    return found, np.repeat(np.arange(len(docs)), np.diff(ends) // POSTING.itemsize)


def _counted(size: int):
    """Of batches of id, number, words: a row for each distinct word of a batch, with its postings by block, and a row without a word for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, number, lists = b.num_rows, b.column(1).to_numpy(), b.column(2)
            block, place = number // size, (number % size).astype(np.int16)
            lengths = np.diff(lists.offsets.to_numpy()).astype(np.int32)
            flat = lists.flatten().dictionary_encode()
            words = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            keys, tfs = np.unique(words * rows + np.repeat(np.arange(rows), lengths), return_counts=True)
            word, row = keys // max(rows, 1), keys % max(rows, 1)
            part = _borders(word, block[row])
            first = _borders(word[part])

            def parts(blocks, starts, *values):
                return pa.StructArray.from_arrays([pa.array(blocks), _packed(starts, *values)], names=["block", "docs"])

            names = ["word", "id", "parts"]
            values = parts(block[row[part]], part, place[row], tfs, lengths[row])
            yield pa.RecordBatch.from_arrays([flat.dictionary.take(pa.array(word[part[first]])), pa.nulls(len(first), b.column(0).type), _lists(first, len(part), values)], names=names)
            values = parts(block, np.arange(rows), place, np.ones(rows), lengths)
            yield pa.RecordBatch.from_arrays([pa.nulls(rows, flat.dictionary.type), b.column(0), _lists(np.arange(rows), rows, values)], names=names)

    return run


def _merged(k1: float, b: float, mean: float):
    """Of batches of term, block, docs, sorted by term and block: one row for each term and block, with n and impact."""

    def merge(t: pa.RecordBatch) -> pa.RecordBatch:
        term, block = t.column(0).dictionary_encode(), t.column(1).to_numpy()
        starts = _borders(term.indices.to_numpy(), block)
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, t.num_rows)))
        found, row = _unpacked(t.column(2))
        key = (group[row] << 16) + found["place"]
        key, at, to = np.unique(key, return_index=True, return_inverse=True)
        tf, length = np.bincount(to, found["tf"]), found["length"][at]
        weight = tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean))
        head = _borders(key >> 16)
        n = len(key)
        columns = [t.column(0).take(pa.array(starts)), pa.array(block[starts]), pa.array(np.diff(np.append(head, n)).astype(np.int32)), pa.array(np.maximum.reduceat(weight, head))]
        columns.append(_packed(head, key & 0xFFFF, tf, length))
        return pa.RecordBatch.from_arrays(columns, names=["term", "block", "n", "impact", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.concat_batches([held, batch]) if held is not None else batch
            last = int(_borders(t.column(0).dictionary_encode().indices.to_numpy(), t.column(1).to_numpy())[-1])
            if last:  # the last term and block may go on in the next batch
                yield merge(pa.concat_batches([t.slice(0, last)]))
            held = pa.concat_batches([t.slice(last)])
        if held is not None:
            yield merge(held)

    return run


def build(docs: DataFrame, path: str | None = None, id_col: str = "id", text_col: str = "document", k1: float = K1, b: float = B) -> Index:
    """Writes the index of docs under path, by default a scratch folder.

    Postings are packed by word and block where the documents are read, and each batch stems its distinct words. Packed,
    they are shuffled once, by term and block.
    """
    spark = docs.sparkSession
    path = path or f"{scratch.folder(spark)}/index"
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("number"), analyze.words(text_col).alias("words"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = analyze.stemmed(rows.mapInArrow(_counted(BLOCK), f"word string, id {kind}, parts {_PARTS}")).drop("word")
    counted = scratch.written(counted, f"{path}/words")
    one = F.col("parts")[0]
    unpacked = lambda batches: (pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(_unpacked(b.column(2))[0][x]) for x in ("place", "length"))], names=["id", "block", "place", "length"]) for b in batches)
    numbered = counted.where(F.col("stem").isNull()).select("id", one["block"].alias("block"), one["docs"].alias("docs")).mapInArrow(unpacked, f"id {kind}, block long, place short, length int")
    numbered = scratch.written(numbered, f"{path}/documents")
    whole = numbered.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("total")).first()
    n, total = whole.n, whole.total or 0
    mean = max(total / n, 1.0) if n else 1.0
    scratch.written(spark.createDataFrame([(n, total, mean, k1, b)], "documents long, words long, mean double, k1 double, b double"), f"{path}/corpus")
    terms = counted.where(F.col("stem").isNotNull()).select(F.col("stem").alias("term"), F.explode("parts").alias("p")).select("term", "p.*")
    ordered = terms.repartitionByRange("term", "block").sortWithinPartitions("term", "block")
    blocks = ordered.mapInArrow(_merged(k1, b, mean), "term string, block long, n int, impact double, docs binary")
    stored = scratch.written(blocks, f"{path}/{POSTINGS}")
    scratch.written(stored.groupBy("term").agg(F.sum("n").alias("df")), f"{path}/terms")
    return Index(spark, path, k1, b)


def query_terms(index: Index, queries: DataFrame) -> DataFrame:
    """queries (query_id, query) -> query_id, term, idf, wanted (distinct terms of the query, known or not), for the known ones."""
    asked = queries.select("query_id", F.explode(analyze.words("query")).alias("word")).distinct()
    asked = _stems(asked, "word").distinct()
    asked = asked.join(asked.groupBy("query_id").agg(F.count(F.lit(1)).alias("wanted")), "query_id")
    n = index.table("corpus").first().documents
    known = asked.join(index.table("terms"), "term")
    return known.withColumn("idf", F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)).select("query_id", "term", "idf", "wanted")


def _near(asked: DataFrame) -> DataFrame:
    """asked, to all tasks if it is small."""
    return F.broadcast(asked) if asked.count() <= BROADCAST_TERMS else asked


def _block_best(k: int, every: bool, size: int, k1: float, b: float, mean: float, out: pa.Schema):
    """Of a block's terms with their queries, and one row of its documents and of the queries that read it (null: all): each query's best k documents."""

    def run(terms: pa.Table, block: pa.Table) -> pa.Table:
        if not terms.num_rows or not block.num_rows:
            return out.empty_table()
        asked = terms.column("asked").combine_chunks()
        found, row = _unpacked(terms.column("docs").combine_chunks())
        n_asked = np.diff(asked.offsets.to_numpy())
        queries = asked.flatten()
        named = queries.field("query_id").dictionary_encode(null_encoding="encode")
        query, q = named.indices.to_numpy(), len(named.dictionary)
        place, tf, length = (found[x].astype(np.int64) for x in POSTING.names)
        weight = terms.column("idf").to_numpy()[row] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean))
        first = np.cumsum(n_asked) - n_asked
        scores, met = np.zeros(q * size), np.zeros(q * size, np.int64)
        for i, j in ranking.pieces(n_asked[row], ranking.PAIRS, len(row)):
            of, at = ranking.expanded(first[row[i:j]], n_asked[row[i:j]])
            cell = query[at].astype(np.int64) * size + place[i:j][of]
            scores += np.bincount(cell, weight[i:j][of], q * size)
            if every:
                met += np.bincount(cell, minlength=q * size)
        docs = block.column("docs").combine_chunks().flatten()
        ids, there = docs.field("id"), docs.field("place").to_numpy().astype(np.int64)
        rank = ranking.by_id(ids.take(pa.array(np.argsort(there))))  # equal ids in the order of documents
        order = np.argsort(there)[rank]
        scores, met = scores.reshape(q, size)[:, there[order]], met.reshape(q, size)[:, there[order]]
        valid = scores > 0
        if every:
            wanted = np.zeros(q, np.int64)
            wanted[query] = queries.field("wanted").to_numpy()
            valid &= met == wanted[:, None]
        reads = block.column("reads").combine_chunks()
        if reads[0].is_valid:
            reads = reads.flatten()
            at = pc.index_in(reads.field("query_id"), named.dictionary).to_numpy(zero_copy_only=False)
            least = np.full(q, np.inf)
            ok = ~np.isnan(at)
            least[at[ok].astype(np.int64)] = reads.field("least").to_numpy()[ok]
            valid &= scores >= least[:, None]
        query, column, _, _ = ranking.best(scores, valid, k)
        taken = pa.array(order[column])
        blocks = np.full(len(query), block.column("block")[0].as_py())
        values = [named.dictionary.take(pa.array(query)), pa.array(blocks), ids.take(taken), pa.array(blocks * size + there[order[column]]), pa.array(scores[query, column])]
        return pa.Table.from_arrays(values, schema=out)

    return run


def _scores(index: Index, postings: DataFrame, asked: DataFrame, k: int, blocks: DataFrame | None, every: bool, allowed: DataFrame | None) -> DataFrame:
    """query_id, block, id, number, score: of each query at most the best k documents of a block, in blocks (query_id, block, least: lower scores don't matter), or in all.

    A block's postings meet in one task, packed, and are multiplied with the queries there: queries go by tiles of some QUERIES.
    """
    c = index.table("corpus").first()
    tiles = -(-asked.select("query_id").distinct().count() // QUERIES) or 1
    tile = F.pmod(F.xxhash64("query_id"), F.lit(tiles)).cast("int")
    terms = asked.groupBy("term", tile.alias("tile")).agg(F.first("idf").alias("idf"), F.collect_list(F.struct("query_id", "wanted")).alias("asked"))
    rows = postings.select("term", "block", "docs").join(_near(terms), "term").drop("term")
    docs = index.table("documents")
    if allowed is not None:
        docs = docs.join(allowed.select("id").distinct(), "id", "left_semi")
    docs = docs.groupBy("block").agg(F.collect_list(F.struct("place", "id")).alias("docs"))
    kind = asked.schema["query_id"].dataType.simpleString()
    if blocks is None:
        docs = docs.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).withColumn("reads", F.lit(None).cast(f"array<struct<query_id: {kind}, least: double>>"))
    else:
        reads = blocks.groupBy("block", tile.alias("tile")).agg(F.collect_list(F.struct("query_id", "least")).alias("reads"))
        rows, docs = rows.join(reads.select("block", "tile"), ["block", "tile"], "left_semi"), docs.join(reads, "block")
    id_kind = docs.schema["docs"].dataType.elementType["id"].dataType.simpleString()
    out = StructType.fromDDL(f"query_id {kind}, block long, id {id_kind}, number long, score double")
    run = _block_best(k, every, BLOCK, c.k1, c.b, c["mean"], to_arrow_schema(out))
    return rows.groupBy("block", "tile").cogroup(docs.select("block", "tile", "docs", "reads").groupBy("block", "tile")).applyInArrow(run, out)


def _best(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.round("score", 6).desc(), "id", "number")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def plan(index: Index, queries: DataFrame, k: int, every: bool = False, allowed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """What a search reads: a written table of query_id, block, bound, postings, threshold, read; and the query's terms."""
    return _plan(index, queries, k, every, allowed)[:2]


def _plan(index: Index, queries: DataFrame, k: int, every: bool, allowed: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """plan, and the postings of the query's terms."""
    path = f"{scratch.folder(index.spark)}/search"
    asked = scratch.written(query_terms(index, queries), f"{path}/asked")
    # the index is read once; what follows reads only these
    mine = scratch.written(index.table(POSTINGS).join(_near(asked.select("term").distinct()), "term", "left_semi"), f"{path}/{POSTINGS}")
    heads = mine.select("term", "block", "n", "impact").join(_near(asked), "term")
    bounds = heads.groupBy("query_id", "block").agg(F.sum(F.col("idf") * F.col("impact")).alias("bound"), F.sum("n").alias("postings"), F.count(F.lit(1)).alias("met"), F.first("wanted").alias("wanted"))
    if every:  # a block without one of the terms has no match
        bounds = bounds.where(F.col("met") == F.col("wanted"))
    bounds = scratch.written(bounds.select("query_id", "block", "bound", "postings"), f"{path}/bounds")
    first = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
    tried = bounds.withColumn("place", F.row_number().over(first)).where(F.col("place") <= max(FIRST_BLOCKS, -(-FIRST_BLOCKS * k // BLOCK))).select("query_id", "block", F.lit(0.0).alias("least"))
    found = _best(_scores(index, mine, asked, k, scratch.written(tried, f"{path}/tried"), every, allowed), k)
    threshold = found.where(F.col("rank") == k).select("query_id", F.round("score", 6).alias("threshold"))
    # scores are compared to six places
    read = F.coalesce(F.col("bound") >= F.col("threshold") - 2e-6, F.lit(True))
    return scratch.written(bounds.join(threshold, "query_id", "left").withColumn("read", read), f"{path}/plan"), asked, mine


def search(index: Index, queries: DataFrame, k: int, every: bool = False, allowed: DataFrame | None = None) -> DataFrame:
    """The best k documents of each query (query_id, query): query_id, id, score, rank.

    every: only documents with all terms of the query. allowed: only documents whose ids it holds; counts stay the corpus's.
    """
    blocks, asked, mine = _plan(index, queries, k, every, allowed)
    # scores are compared to six places
    read = blocks.where("read").select("query_id", "block", F.coalesce(F.col("threshold") - 2e-6, F.lit(0.0)).alias("least"))
    return _best(_scores(index, mine, asked, k, read, every, allowed), k).select("query_id", "id", "score", "rank")


def full_search(index: Index, queries: DataFrame, k: int, every: bool = False, allowed: DataFrame | None = None) -> DataFrame:
    """As search, with every block read."""
    return _best(_scores(index, index.table(POSTINGS), query_terms(index, queries), k, None, every, allowed), k).select("query_id", "id", "score", "rank")


def pseudo_distance(score: Column) -> Column:
    """Higher scores are nearer: 1 / (1 + score)."""
    return 1 / (1 + score)


def find(index: Index, chunks: DataFrame, query_texts: Sequence[str], where_document: Mapping[str, Any], k: int = 10, where: filters.Where | None = None) -> DataFrame:
    """A collection's query with ``$search``: query_id (place in query_texts), id, distance, rank and the chunk's columns.

    One phrase serves all query_texts, a list has one for each. Documents match with all words of their phrase. Other
    conditions narrow what is ranked.
    """
    phrases = where_document.get("$search")
    if phrases is None:
        raise UnsupportedFilter("$search is missing")
    if query_texts is None:
        raise UnsupportedFilter("$search needs query texts")
    if isinstance(phrases, str):
        phrases = [phrases] * len(query_texts)
    if len(phrases) != len(query_texts):
        raise UnsupportedFilter(f"{len(phrases)} phrases for {len(query_texts)} query texts")
    asked = index.spark.createDataFrame(list(enumerate(map(str, phrases))), "query_id int, query string")
    rest = {x: v for x, v in where_document.items() if x != "$search"}
    allowed = chunks.where(filters.where(where) & filters.where_document(rest)) if where or rest else None
    hits = search(index, asked, k, every=True, allowed=allowed)
    return hits.join(chunks, "id").withColumn("distance", pseudo_distance(F.col("score"))).drop("score")
