"""Exact dedup with a heavy-hitter split, in DataFrame functions only.

Texts are equal when identical after white space is deleted. A slim table (id, digest,
length) is written once. Misra-Gries counters (``freqItems``: at most 1/support per task)
name every digest that may hold more than a ``support`` share of the rows; an exact
aggregate verifies them, and the winners of the verified ones, at most 1/support rows, are
broadcast, so rows of hot groups are settled map-side. Other digests go through
an ordinary shuffle with partial aggregation.

Of equal texts the row with the most code points stays, then the smallest id (null last).
Defined results: null text counts as empty, so null, empty and blank texts form one group.
Rows repeated with one id are separate rows, of which one stays. Columns other than id and
text are neither read nor returned by ``groups``; ``drop_copies`` returns all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestore.llm.common import fresh, same_long, stored, text_or_empty

#: Share of the rows beyond which a digest is heavy; 1/SUPPORT bounds what is broadcast.
SUPPORT = 1 / 1024


def squeezed(text: Column) -> Column:
    """text without the characters of [\\x20\\x09-\\x0D]."""
    out = text_or_empty(text)
    for c in " \n\t\r\x0b\x0c":
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(squeezed(text), 256))


def _order(slim: DataFrame) -> Column:
    """The smallest is the row that stays."""
    return F.struct((-F.col("cp")).alias("cp"), F.col("id").isNull().alias("null"), F.col("id").alias("id"), F.col("row").alias("row"), F.col("key").alias("key"))


def _winners(slim: DataFrame) -> DataFrame:
    return slim.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(_order(slim)).alias("first"))


def heavy_winners(slim: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Digest, count and winner of each digest with over a ``support`` share of the rows."""
    spark = slim.sparkSession
    rows = slim.count()
    keys = slim.select(F.hex("digest").alias("digest"))  # the counters compare binary values by identity
    named = keys.stat.freqItems(["digest"], support).first()[0] if rows else []
    maybe = spark.createDataFrame([(bytes.fromhex(x),) for x in named], "digest binary")
    found = _winners(slim.join(F.broadcast(maybe), "digest", "left_semi")).where(F.col("n") > rows * support)
    return spark.createDataFrame(found.collect(), found.schema)


def _key(id_col: str, text_col: str) -> Column:
    """Tells the rows of a group apart, but for rows alike in id and text."""
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col), F.col(text_col))


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return stored(
        docs.select(F.col(id_col).alias("id"), digest(text).alias("digest"), F.char_length(text_or_empty(text)).alias("cp"), _key(id_col, text_col).alias("key"))
        .withColumn("row", F.monotonically_increasing_id()),
        "digests",
    )


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per row of docs: id_col, keep_id, group_size, kept, text_sha256."""
    slim = _slim(docs, id_col, text_col)
    heavy = F.broadcast(heavy_winners(slim, support))
    rest = slim.join(heavy, "digest", "left_anti")
    settled = slim.join(heavy, "digest").unionByName(rest.join(_winners(rest), "digest"))
    return settled.select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows of docs that stay, with all their columns.

    Losers of hot groups go map-side; any other text is shuffled once, to meet its group's winner. Of rows alike in id
    and text one stays, whatever its other columns.
    """
    slim = _slim(docs, id_col, text_col)
    heavy = heavy_winners(slim, support)
    rest = slim.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    d, k, n, wd, wk = (fresh(docs, x) for x in ("digest", "key", "place", "winner_digest", "winner_key"))
    pick = lambda x: x.select(F.col("digest").alias(wd), F.col("first.key").alias(wk))
    rows = docs.withColumns({d: digest(F.col(text_col)), k: _key(id_col, text_col)})
    won = (F.col(d) == F.col(wd)) & same_long(k, wk)
    # as repeated rows may be many, they meet in partial aggregates
    hot = rows.join(F.broadcast(pick(heavy)), won, "left_semi").groupBy(d).agg(F.first(F.struct(*docs.columns)).alias(n)).select(f"{n}.*")
    cold = rows.join(F.broadcast(heavy.select(F.col("digest").alias(d))), d, "left_anti").join(pick(_winners(rest)), won, "left_semi")
    cold = cold.withColumn(n, F.row_number().over(Window.partitionBy(d).orderBy(k))).where(F.col(n) == 1)
    return cold.select(*docs.columns).unionByName(hot)
