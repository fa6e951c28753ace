"""Rules of small functions on literal rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestore.functions import memories, tools, validate
from lodestore.operators import browse, collection, graph, kg, search


def column(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [x.out for x in rows.select("i", f(F.col("v")).alias("out")).orderBy("i").collect()]


def test_segments(spark):
    lines = lambda n: "\n".join(f"line {i}" for i in range(n))
    got = column(spark, [lines(20), lines(21), lines(60), "a\n \nb", "a\n\nb\n\n", "> q\nx\n> r\n  User : s\ny", "> q\n> r", ""], memories.segments)
    assert [len(x) for x in got] == [1, 1, 3, 1, 2, 3, 1, 0]
    assert got[5] == ["> q\nx", "> r", "  User : s\ny"]


def test_prose(spark):
    text = "Keep this.\n$ rm it\n```py\nbug = error\n```\n  import os\n| a | b |\n12 + 34 = 46 / 2\nAnd this."
    assert column(spark, [text, "```\nonly code\n```", "x = os.path", "", "Keep\n```\nopen fence"], memories.prose) == ["Keep this.\nAnd this.", "```\nonly code\n```", "x = os.path", "", "Keep"]


def test_only_prose_is_scored(spark):
    docs = spark.createDataFrame([(1, "$ git fail because bug error\nThe weather was rather mild that day."), (2, "There is a bug, an error and a crash here.")], "id int, text string")
    assert [(x.id, x.memory_type) for x in memories.extract(docs).collect()] == [(2, "problem")]


def test_faults(spark):
    assert column(spark, ["ok", " a-b.c'd ", "_x", "x_", "a..b", "a\\b", "", None, "x" * 128, "x" * 129, "é"], validate.name_fault) == [None, None, "characters", "characters", "path", "path", "empty", "empty", None, "too long", None]
    assert column(spark, ["a: (b), c/d", "a\0b"], validate.fact_fault) == [None, "null byte"]
    assert column(spark, ["x" * 100_000, "x" * 100_001], validate.content_fault) == [None, "too long"]


def test_tool_lines(spark):
    rows = spark.createDataFrame([("Bash", '{"command":"ls"}', "a\nb"), ("Read", '{"file_path":"/f","offset":3,"limit":4}', "secret"), ("Read", '{"file_path":"/f","offset":"x","limit":"y"}', ""), ("Grep", '{"pattern":"p","glob":"*.c"}', "\n".join("m" * 1 for _ in range(22))), (None, "{}", "x" * 3000)], "n string, i string, r string")
    got = rows.select(tools.call(F.col("n"), F.col("i")).alias("c"), tools.result(F.col("n"), F.col("r")).alias("r")).collect()
    assert [x.c for x in got] == ["[Bash] ls", "[Read /f:3-7]", "[Read /f:x+y]", "[Grep] p in *.c", "[Unknown] {}"]
    assert [got[0].r, got[1].r, got[2].r] == ["→ a\n→ b", "", ""] and got[3].r.endswith("→ ... [2 more matches]") and got[4].r.endswith("... [truncated, 3000 chars]")
    long = spark.range(1).select(tools.result(F.lit("Bash"), F.lit("\n".join(str(i) for i in range(50)))).alias("r")).first().r
    assert "→ 19\n→ ... [10 lines omitted] ...\n→ 30" in long and long.endswith("→ 49")


def test_closed_facts_are_stored_once(spark):
    cols = "subject string, predicate string, object string, valid_from string, valid_to string"
    stored = spark.createDataFrame([("t1", "a", "knows", "b", "2020", "2021"), ("t2", "a", "knows", "c", None, None)], f"id string, {cols}")
    new = spark.createDataFrame([("a", "knows", "b", "2020", "2021"), ("a", "knows", "b", "2020", "2022"), ("a", "knows", "b", None, None), ("a", "knows", "c", "2020", None)], cols)
    got = kg.add_triples(stored, spark.createDataFrame([], "id string, name string, type string"), new)[0]
    assert sorted((x.object, x.valid_to or "") for x in got.collect()) == [("b", ""), ("b", "2021"), ("b", "2022"), ("c", "")]


def test_time_offsets(spark):
    got = column(spark, ["3 days ago", "2 Weeks ago", "Last month", "so recently", "99999999999 days ago", "never", None], lambda q: search.time_offset(q))
    assert [x and tuple(x) for x in got] == [(3, 2), (14, 5), (30, 7), (14, 14), (None, 2), None, None]


def test_preferences(spark):
    turns = spark.createDataFrame([(1, 1, "user", "I prefer tea. I prefer tea!"), (1, 2, "assistant", "I prefer coffee"), (2, 1, "user", None), (2, 2, "user", "I want to go.")], "session_id int, ts int, role string, text string")
    assert [(x.session_id, x.mention) for x in search.preferences(turns).orderBy("session_id").collect()] == []
    turns = turns.withColumn("text", F.replace("text", F.lit("tea"), F.lit("green tea")))
    assert [(x.session_id, x.mention) for x in search.preferences(turns).collect()] == [(1, "green tea")]


def test_names_links_and_status(spark, tmp_path):
    assert column(spark, ["/x/-Projects-My App/s", "C:\\-Projects-Foo", "/x"], collection.transcript_wing) == ["wing_my_app", "wing_foo", "wing_sessions"]
    links = spark.createDataFrame([("a",), ("b",)], "id string")
    assert [x.id for x in graph.delete_links(links, spark.createDataFrame([("a",), ("z",)], "id string")).collect()] == ["b"]
    assert browse.identity(spark, f"{tmp_path}/none.txt") == browse.NO_IDENTITY
    (tmp_path / "me.txt").write_text("\n I am.\nYes. \n")
    assert browse.identity(spark, f"{tmp_path}/me.txt") == "I am.\nYes."
    assert browse.stack_status(links, "12345678").first().identity_tokens == 2
