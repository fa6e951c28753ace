"""Counts, pages and digests of a store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestore.operators.filters import snippet


def status(chunks: DataFrame) -> DataFrame:
    """Counts of all, of each wing and of each room in one pass: level, wing, room, n."""
    c = chunks.select(F.coalesce("wing", F.lit("unknown")).alias("wing"), F.coalesce("room", F.lit("unknown")).alias("room"))
    g = c.groupingSets([["wing"], ["room"], []], "wing", "room").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    level = F.when(F.col("g") == 3, "total").when(F.col("g") == 1, "wing").otherwise("room")
    return g.select(level.alias("level"), "wing", "room", "n")


def wings(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy(F.coalesce("wing", F.lit("unknown")).alias("wing")).agg(F.count(F.lit(1)).alias("n"))


def rooms(chunks: DataFrame, wing: str | None = None) -> DataFrame:
    c = chunks.where(F.col("wing") == wing) if wing else chunks
    return c.groupBy(F.coalesce("room", F.lit("unknown")).alias("room")).agg(F.count(F.lit(1)).alias("n"))


def taxonomy(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy(F.coalesce("wing", F.lit("unknown")).alias("wing"), F.coalesce("room", F.lit("unknown")).alias("room")).agg(F.count(F.lit(1)).alias("n"))


def taxonomy_nested(chunks: DataFrame) -> DataFrame:
    """One row per wing with a map of its rooms' counts."""
    return taxonomy(chunks).groupBy("wing").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("room", "n")))).alias("rooms"))


def source_groups(chunks: DataFrame, least: int = 5, like: str | None = None, wing: str | None = None) -> DataFrame:
    """Sources of at least ``least`` chunks, with their counts."""
    c = chunks
    if wing:
        c = c.where(F.col("wing") == wing)
    if like:
        c = c.where(F.contains("source_file", F.lit(like)))
    return c.groupBy("source_file").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def dedup_estimate(groups: DataFrame, over: int = 20, part: float = 0.4) -> DataFrame:
    """What removing near copies may free: of groups over a size, a part each."""
    return groups.agg(F.count(F.lit(1)).alias("sources"), F.sum("n").alias("chunks"), F.coalesce(F.sum(F.when(F.col("n") > over, F.floor(F.col("n") * part))), F.lit(0)).alias("estimate"))


def essential_story(chunks: DataFrame, most: int = 15, budget: int = 3200, keys: tuple[str, ...] = ("importance", "emotional_weight", "weight")) -> DataFrame:
    """The most important chunks by room, as snippets, until the budget of characters is spent.

    Importance is the first of the keys that is there; one that is no number counts as 3.
    """
    there = [F.col(k).cast("string") for k in keys if k in chunks.columns]
    weight = F.coalesce(F.expr("try_cast(_w AS DOUBLE)"), F.lit(3.0))
    top = chunks.withColumn("_w", F.coalesce(*there, F.lit("3"))).withColumn("weight", weight).orderBy(F.desc("weight"), "id").limit(most)
    rows = top.select("room", "id", "weight", snippet("document").alias("snippet"))
    spent = F.sum(F.char_length("snippet")).over(Window.orderBy("room", F.desc("weight"), "id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("spent", spent).where(F.col("spent") <= budget)


def recall(chunks: DataFrame, wing: str | None = None, room: str | None = None, n: int = 10) -> DataFrame:
    c = chunks
    for k, v in (("wing", wing), ("room", room)):
        c = c.where(F.col(k) == v) if v else c
    return c.orderBy("id").limit(n).select("id", "wing", "room", snippet("document", 300).alias("snippet"))


def diary(entries: DataFrame, agent: str, last: int = 10) -> DataFrame:
    """An agent's latest entries, newest first, with the number of all."""
    mine = entries.where((F.col("room") == "diary") & (F.col("agent") == agent))
    total = mine.agg(F.count(F.lit(1)).alias("total"))
    return mine.orderBy(F.desc("filed_at"), F.desc("id")).limit(last).crossJoin(total)  # one row


def export_index(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("wing").agg(F.count_distinct("room").alias("rooms"), F.count(F.lit(1)).alias("chunks"))


def export_markdown(chunks: DataFrame, path: str) -> None:
    """A folder per wing and room of Markdown: a heading per chunk, its text quoted."""
    quoted = F.concat(F.lit("> "), F.replace("document", F.lit("\n"), F.lit("\n> ")))
    body = F.concat(F.lit("## "), "id", F.lit("\n\n"), quoted, F.lit("\n"))
    rows = chunks.select(F.regexp_replace("wing", r"[^\w-]", "_").alias("wing"), F.regexp_replace("room", r"[^\w-]", "_").alias("room"), body.alias("value"))
    rows.repartition("wing", "room").sortWithinPartitions("value").write.partitionBy("wing", "room").text(path)


def themes(messages: DataFrame, stop: list[str], last: int = 30, most: int = 3) -> DataFrame:
    """The commonest words of four and more letters of each session's latest user messages."""
    w = Window.partitionBy("session_id").orderBy(F.desc("ts"), F.desc("id"))
    recent = messages.where(F.col("role") == "user").withColumn("k", F.row_number().over(w)).where(F.col("k") <= last)
    words = recent.select("session_id", F.explode(F.regexp_extract_all(F.lower(F.substring("text", 1, 200)), F.lit(r"[a-z]{4,}"), F.lit(0))).alias("word")).where(~F.col("word").isin(stop))
    counts = words.groupBy("session_id", "word").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("session_id").orderBy(F.desc("n"), "word"))
    return counts.withColumn("rank", place).where(F.col("rank") <= most)


def message_trigger(messages: DataFrame, saved: DataFrame, every: int = 15) -> DataFrame:
    """Sessions with at least ``every`` user messages since their last save (session_id, saved)."""
    n = messages.groupBy("session_id").agg(F.count_if(F.col("role") == "user").alias("n"))
    return n.join(saved, "session_id", "left").withColumn("since", F.col("n") - F.coalesce("saved", F.lit(0))).where(F.col("since") >= every)


def names(registry: DataFrame) -> DataFrame:
    """registry (category, names array) as one set of names."""
    return registry.select(F.explode("names").alias("name")).distinct()


#: Without an identity file.
NO_IDENTITY = "No identity configured."


def identity(spark: SparkSession, path: str) -> str:
    """The text of the identity file, read by Spark; a default where there is none."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(path)
    if not file.getFileSystem(conf).exists(file):
        return NO_IDENTITY
    return spark.read.text(path, wholetext=True).agg(F.trim(F.array_join(F.collect_list("value"), "\n"), F.lit(" \t\r\n")).alias("x")).first().x


def wake_up(chunks: DataFrame, who: str, wing: str | None = None) -> DataFrame:
    """One row: text, the identity and the lines of the essential story by room, and tokens, a fourth of its characters."""
    rows = essential_story(chunks if wing is None else chunks.where(F.col("wing") == wing))
    lines = F.array_sort(F.collect_list(F.struct("room", (-F.col("weight")).alias("w"), "id", F.concat(F.lit("["), "room", F.lit("] "), "snippet").alias("line"))))
    text = F.concat(F.lit(who), F.lit("\n\n"), F.array_join(F.transform(lines, lambda x: x["line"]), "\n"))
    return rows.agg(text.alias("text")).withColumn("tokens", F.floor(F.char_length("text") / 4).cast("int"))


def stack_status(chunks: DataFrame, who: str) -> DataFrame:
    """One row: identity_tokens and total_drawers."""
    return chunks.agg(F.lit(len(who) // 4).alias("identity_tokens"), F.count(F.lit(1)).alias("total_drawers"))
