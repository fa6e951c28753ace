"""Okapi BM25, over candidates per query or over a whole corpus by postings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestore import scratch
from lodestore.operators import ranking

K1, B = 1.5, 0.75
WORD = r"(?U)\w{2,}"
#: Terms of all queries whose tables go to all tasks; more are shuffled.
BROADCAST_TERMS = 200_000
#: Documents, and products of documents and queries, whose scores are held at once.
ROWS, CELLS = 512, 4_000_000


def tokens(text: str | Column) -> Column:
    """Lower-case words of two characters and more, by Unicode."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(WORD), F.lit(0))


def _score(tf: Column, df: Column, n: Column, length: Column, mean: Column, k1: float, b: float) -> Column:
    idf = F.log((n - df + 0.5) / (df + 0.5) + 1)
    return idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean))


def postings(docs: DataFrame, id_col: str = "id", text_col: str = "document") -> DataFrame:
    """term, id, tf, length: the inverted index, partitioned by term when stored."""
    t = docs.select(F.col(id_col).alias("id"), tokens(text_col).alias("t")).withColumn("length", F.size("t"))
    return t.select("id", "length", F.explode("t").alias("term")).groupBy("term", "id", "length").agg(F.count(F.lit(1)).alias("tf"))


def corpus_scores(docs: DataFrame, queries: DataFrame, id_col: str = "id", text_col: str = "document", k1: float = K1, b: float = B) -> DataFrame:
    """queries (query_id, query) over all docs: query_id, id, score of each document with a query term.

    Query terms, a set for each query, prune the postings before anything is shuffled; counts
    and the mean length are of the whole corpus, empty documents included. What is left is shuffled once, by id:
    frequencies, and after joins with tables of the query terms the scores too, are summed where a document's words lie.
    """
    terms = queries.select("query_id", F.explode(F.array_distinct(tokens("query"))).alias("term"))
    near = F.broadcast if terms.count() <= BROADCAST_TERMS else lambda x: x
    asked = near(terms.select("term").distinct())
    t = docs.select(F.col(id_col).alias("id"), tokens(text_col).alias("t")).withColumn("length", F.size("t").cast("double"))
    lengths = docs.select(F.regexp_count(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(WORD)).alias("length"))  # no arrays, no rows for words
    whole = lengths.agg(F.count(F.lit(1)).cast("double").alias("n"), F.greatest(F.avg("length"), F.lit(1.0)).alias("mean"))
    hits = t.select("id", "length", F.explode("t").alias("term")).join(asked, "term", "left_semi").repartition("id")
    tf = hits.groupBy("term", "id", "length").agg(F.count(F.lit(1)).cast("double").alias("tf"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).cast("double").alias("df"))
    scored = tf.join(near(df), "term").crossJoin(F.broadcast(whole))  # one row
    scored = scored.select("term", "id", _score(F.col("tf"), F.col("df"), F.col("n"), F.col("length"), F.col("mean"), k1, b).alias("s"))
    return scored.join(near(terms), "term").groupBy("query_id", "id").agg(F.sum("s").alias("score"))


def _hits(terms: pa.Array):
    """Of batches of id, words: id, length, and the numbers and frequencies of the terms that the document holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, lists = b.num_rows, b.column(1)
            length = np.diff(lists.offsets.to_numpy())
            place = pc.index_in(lists.flatten(), terms).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(rows), length)[place >= 0]
            keys, tf = np.unique(row * len(terms) + place[place >= 0], return_counts=True)
            ends = pa.array(np.searchsorted(keys, np.arange(rows + 1) * len(terms)).astype(np.int32))
            columns = [pa.array((keys % len(terms)).astype(np.int32)), pa.array(tf.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(length.astype(np.int32)), *(pa.ListArray.from_arrays(ends, c) for c in columns)], names=["id", "length", "terms", "tfs"])

    return run


def _best(k: int, idf: np.ndarray, query: np.ndarray, first: np.ndarray, count: np.ndarray, ids: pa.Array, mean: float, k1: float, b: float):
    """Of batches of hits: query_id, id and score of the best k of each piece of a batch that reach the task's k-th best so far. Term t is asked by query[first[t] :][: count[t]]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(ids)
        top = np.full((n, k), -1.0)
        for batch in batches:
            order = ranking.by_id(batch.column(0))
            batch = batch.take(pa.array(order))
            ends = batch.column(2).offsets.to_numpy()
            terms, tf = (batch.column(i).flatten().to_numpy().astype(np.int64) for i in (2, 3))
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            weight = idf[terms] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * batch.column(1).to_numpy()[row] / mean))
            pairs = np.bincount(row, count[terms], batch.num_rows).astype(np.int64)
            for i, j in ranking.pieces(pairs, ranking.PAIRS, max(1, min(ROWS, CELLS // max(n, 1)))):
                some = slice(ends[i] - ends[0], ends[j] - ends[0])
                of, at = ranking.expanded(first[terms[some]], count[terms[some]])
                cell = query[at] * (j - i) + (row[some] - i)[of]
                scores = np.bincount(cell, weight[some][of], n * (j - i)).reshape(n, j - i)
                q, column, rank, value = ranking.best(scores, scores > 0, k, top[:, -1])
                new = np.full((n, k), -1.0)
                new[q, rank] = value
                top = -np.sort(-np.concatenate([top, new], axis=1), axis=1)[:, :k]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(q)), batch.column(0).take(pa.array(i + column)), pa.array(scores[q, column])], names=["query_id", "id", "score"])

    return run


def search(docs: DataFrame, queries: DataFrame, k: int, id_col: str = "id", text_col: str = "document", k1: float = K1, b: float = B) -> DataFrame:
    """top_k of corpus_scores, with the same rows: query_id, id, score, rank.

    What documents hold of the query terms is written once, a row for each document. A document is scored for all
    queries in its task, and only a task's best rows are shuffled. Where the query terms are too many for a task, or several
    rows have one id, scores are shuffled.
    """
    spark = docs.sparkSession
    asked = queries.select("query_id", F.explode(F.array_distinct(tokens("query"))).alias("term"))
    if asked.count() > BROADCAST_TERMS:
        return top_k(corpus_scores(docs, queries, id_col, text_col, k1, b), k)
    asked = asked.toArrow()
    term, query = (asked.column(c).combine_chunks().dictionary_encode(null_encoding="encode") for c in ("term", "query_id"))
    rows = docs.select(F.col(id_col).alias("id"), tokens(text_col).alias("t"))
    kind, query_kind = (x.schema[c].dataType.simpleString() for x, c in ((rows, "id"), (queries, "query_id")))
    hits = scratch.written(rows.mapInArrow(_hits(term.dictionary), f"id {kind}, length int, terms array<int>, tfs array<int>"), f"{scratch.folder(spark)}/hits")
    if hits.groupBy("id").count().where("count > 1").limit(1).count():
        return top_k(corpus_scores(docs, queries, id_col, text_col, k1, b), k)
    whole = hits.agg(F.count(F.lit(1)).alias("n"), F.greatest(F.avg("length"), F.lit(1.0)).alias("mean")).first()
    df = np.zeros(len(term.dictionary))
    for r in hits.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # no more than the query terms
        df[r.t] = r["count"]
    numbers = term.indices.to_numpy().astype(np.int64)
    order, count = np.argsort(numbers, kind="stable"), np.bincount(numbers, minlength=len(df))
    idf = np.log((whole.n - df + 0.5) / (df + 0.5) + 1)
    run = _best(k, idf, query.indices.to_numpy().astype(np.int64)[order], np.cumsum(count) - count, count, query.dictionary, whole["mean"] or 1.0, k1, b)
    return top_k(hits.mapInArrow(run, f"query_id {query_kind}, id {kind}, score double"), k)


def top_k(scores: DataFrame, k: int) -> DataFrame:
    """The best k of each query by score to six places, then id, with rank."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.round("score", 6).desc(), "id"))
    return scores.withColumn("rank", rank).where(F.col("rank") <= k)


def candidate_scores(candidates: DataFrame, k1: float = K1, b: float = B) -> DataFrame:
    """candidates (query_id, query, id, document, ...) with bm25: counts are those of each query's candidates."""
    key = Window.partitionBy("query_id")
    t = candidates.withColumns({"_t": tokens("document"), "_q": F.array_distinct(tokens("query"))})
    t = t.withColumns({"_len": F.size("_t").cast("double")})
    t = t.withColumns({"_n": F.count(F.lit(1)).over(key).cast("double"), "_mean": F.avg("_len").over(key)})
    terms = t.select("query_id", "id", "_len", "_n", "_mean", F.explode(F.filter("_t", lambda x: F.array_contains(F.col("_q"), x))).alias("term"))
    tf = terms.groupBy("query_id", "id", "_len", "_n", "_mean", "term").agg(F.count(F.lit(1)).cast("double").alias("tf"))
    df = tf.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("query_id", "term")).cast("double"))
    s = df.groupBy("query_id", "id").agg(F.sum(_score(F.col("tf"), F.col("df"), F.col("_n"), F.col("_len"), F.col("_mean"), k1, b)).alias("bm25"))
    return candidates.join(s, ["query_id", "id"], "left").withColumn("bm25", F.coalesce("bm25", F.lit(0.0)))
