"""Measures of retrieval and of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def recall_at(hits: DataFrame, relevant: DataFrame, ks: list[int]) -> DataFrame:
    """hits (query_id, id, rank), relevant (query_id, id): for each k the share of queries with any, and with all, relevant ids among k."""
    want = relevant.distinct().groupBy("query_id").agg(F.count(F.lit(1)).alias("want"))
    got = relevant.distinct().join(hits.select("query_id", "id", "rank"), ["query_id", "id"])
    per = want.join(got, "query_id", "left").groupBy("query_id", "want").agg(*[F.count_if(F.col("rank") <= k).alias(f"g{k}") for k in ks])
    rows = per.select("want", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"g{k}").alias("got")) for k in ks])).alias("x"))
    return rows.groupBy("x.k").agg(F.avg((F.col("x.got") > 0).cast("double")).alias("recall_any"), F.avg((F.col("x.got") == F.col("want")).cast("double")).alias("recall_all"))


def ndcg_at(hits: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """NDCG of each query; the ideal order is that of what was retrieved."""
    flag = relevant.distinct().withColumn("rel", F.lit(1.0))
    h = hits.where(F.col("rank") <= k).join(flag, ["query_id", "id"], "left").withColumn("rel", F.coalesce("rel", F.lit(0.0)))
    ideal = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("rel"), "rank"))
    h = h.withColumn("ideal", ideal)
    g = h.groupBy("query_id").agg(F.sum(F.col("rel") / F.log2(F.col("rank") + 1)).alias("dcg"), F.sum(F.col("rel") / F.log2(F.col("ideal") + 1)).alias("idcg"))
    return g.select("query_id", F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg")).otherwise(F.lit(0.0)).alias("ndcg"))


def token_f1(pairs: DataFrame) -> DataFrame:
    """pairs (id, predicted, expected) with f1 of their words as multisets."""
    words = lambda c, side: pairs.select("id", F.explode(F.regexp_extract_all(F.lower(c), F.lit(r"[a-z0-9]+"), F.lit(0))).alias("w")).groupBy("id", "w").agg(F.count(F.lit(1)).alias(side))
    met = words("predicted", "p").join(words("expected", "e"), ["id", "w"], "full_outer")
    g = met.groupBy("id").agg(F.sum(F.least(F.coalesce("p", F.lit(0)), F.coalesce("e", F.lit(0)))).alias("both"), F.sum("p").alias("np"), F.sum("e").alias("ne"))
    f1 = F.when(F.col("both") > 0, 2 * F.col("both") / (F.col("np") + F.col("ne"))).otherwise(F.lit(0.0))
    return pairs.select("id").join(g, "id", "left").select("id", F.coalesce(f1, F.lit(0.0)).alias("f1"))


def evidence_recall(hits: DataFrame, evidence: DataFrame, k: int) -> DataFrame:
    """The share of each query's evidence among its first k."""
    got = hits.where(F.col("rank") <= k).select("query_id", "id").withColumn("hit", F.lit(1))
    return evidence.distinct().join(got, ["query_id", "id"], "left").groupBy("query_id").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))


def latency(samples: DataFrame, by: list[str], value: str = "seconds") -> DataFrame:
    return samples.groupBy(*by).agg(*[F.percentile(value, F.lit(p / 100)).alias(f"p{p}") for p in (50, 95, 99)])


def regressions(old: DataFrame, new: DataFrame, tolerance: float = 0.2) -> DataFrame:
    """(metric, value, higher_is_better): what got worse by more than the tolerance."""
    met = old.select("metric", F.col("value").alias("before")).join(new, "metric").where(F.col("before") != 0)
    change = (F.col("value") - F.col("before")) / F.abs("before")
    return met.withColumn("change", change).where(F.when(F.col("higher_is_better"), F.col("change") < -tolerance).otherwise(F.col("change") > tolerance))
