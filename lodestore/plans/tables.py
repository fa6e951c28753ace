"""The driver's tables in the roles of the store's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as chunks: wing is the language, room the source."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("document"), F.col("lang").alias("wing"), F.col("source").alias("room"), "n_chars")


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("session_id"), F.col("turn").alias("ts"), F.col("turn").alias("id"), "role", "text")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as facts of users: each holds until the user's next event of its type."""
    e = table(spark, sf_dir, "events")
    day = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    nxt = F.lead("ts").over(Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id"))
    return e.select(
        F.col("event_id").cast("string").alias("id"), F.concat(F.lit("user_"), "user_id").alias("subject"), F.col("event_type").alias("predicate"),
        F.concat(F.lit("event_"), "event_id").alias("object"), day("ts").alias("valid_from"), day(nxt).alias("valid_to"),
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    users = e.select(F.concat(F.lit("user_"), "user_id").alias("id"), F.concat(F.lit("User "), "user_id").alias("name")).distinct()
    return users.unionByName(e.select(F.concat(F.lit("event_"), "event_id").alias("id"), F.concat(F.lit("Event "), "event_id").alias("name")))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as chunks of the room graph: room is a brand, wing the supplier's nation, hall the part's type, with a date."""
    li, p, s, n = (table(spark, sf_dir, x) for x in ("lineitem", "part", "supplier", "nation"))
    rows = li.select("l_partkey", "l_suppkey", "l_shipdate").join(p.select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.join(s.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).join(n.select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select(F.col("p_brand").alias("room"), F.col("n_name").alias("wing"), F.col("p_type").alias("hall"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", F.col("label").cast("string").alias("wing"))


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query set of searches: every vector whose id is divisible by 50."""
    return table(spark, sf_dir, "embeddings").where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as notes, of which each kind holds markers, code or turns of its own."""
    texts = F.array(*[F.lit(x) for x in NOTES])
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.replace(F.element_at(texts, (F.col("o_orderkey") % len(NOTES) + 1).cast("int")), F.lit("{}"), F.col("o_orderpriority")).alias("text"))


#: Texts of notes; {} is an order's priority.
NOTES = (
    "We decided to go with {} instead of the queue because the approach is simpler.\n\nIt finally works, we shipped version 2 of {} and deployed it.",
    "There is a bug: the import keeps failing with an error, and {} crashed again.\n\nThe fix was a retry, so the bug is fixed and resolved for {}.",
    "I prefer snake_case for {}. Please always use tabs, never use spaces.",
    "I feel proud and happy, I love this {} and I am grateful.\n\nshort",
    "$ git push origin because\nimport bug from error\nWe chose {} rather than the default, a better option.\n```\nbug = error.crash()\nfail because broken\n```\nThat is our strategy.",
    "```\nbug = error.crash()\n```\n---\n",
    "\n".join(f"Line {i} of {{}} says it works and we fixed what broke." for i in range(21)),
    "\n".join(f"Line {i} of {{}} says it works and we fixed what broke." for i in range(20)),
    "> why did {} fail and crash?\nBecause the bug is an error, it is broken.\n> did we solve the problem?\nWe solved it, it worked, finally {} is fixed and I am happy, I love it.\n> thanks, you are a wonderful help to us",
    "Human: let's use {} and switch to the new stack.\nAssistant: I like when we always use one framework, don't use two.\nHuman: we decided on a strategy, it is the default.",
    "| a | bug |\n| - | error |\n{} = 1.5 * 22.7 / 1000000000\nobj.call(error) bug\nNothing much to tell here about {} at all.",
    "",
)
