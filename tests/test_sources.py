"""Readers, entity detection and summaries."""

from __future__ import annotations

import sqlite3

from lodestore.functions import entities, summary
from lodestore.operators import quality
from lodestore.sources import files


def test_ignore_rules():
    r = files.IgnoreRules([("", "*.log\n!keep.log\n/build\nsecret/\ndocs/**/tmp.txt"), ("sub", "local.txt")])
    assert r.ignored("a.log") and r.ignored("x/y/b.log") and not r.ignored("keep.log")
    assert r.ignored("build/out.txt") and not r.ignored("x/build.txt") and r.ignored("a/secret/z.txt")
    assert r.ignored("docs/a/b/tmp.txt") and r.ignored("sub/local.txt") and not r.ignored("local.txt")


def test_scan(spark, tmp_path):
    for p in ("a.py", "node_modules/x.js", "sub/b.md", "c.bin", "skip.log.txt", "talk.meta.json"):
        (tmp_path / p).parent.mkdir(exist_ok=True)
        (tmp_path / p).write_text(f"text of {p}")
    got = {x.path: x.content for x in files.scan_project(spark, str(tmp_path), files.IgnoreRules([("", "*.log.txt")])).collect()}
    assert set(got) == {"a.py", "sub/b.md", "talk.meta.json"} and got["a.py"] == "text of a.py"
    forced = files.scan_project(spark, str(tmp_path), files.IgnoreRules([("", "*.log.txt")]), ["skip.log.txt"])
    assert forced.where("path = 'skip.log.txt'").count() == 1
    assert files.scan_conversations(spark, str(tmp_path)).count() == 2


def test_diary(spark, tmp_path):
    (tmp_path / "2026-01-01.md").write_text("# day\n## one\nfirst entry of the day\n## two\nsecond entry of the day")
    (tmp_path / "2026-01-02.md").write_text("short")
    days = files.diary_days(spark, str(tmp_path))
    assert [x.day for x in days.collect()] == ["2026-01-01"]
    from lodestore.functions.text import diary_entries

    assert [x.entry for x in diary_entries(days).collect()] == [0, 1]
    state = days.selectExpr("day", "size", "2 AS entries")
    assert files.changed_days(days, state).count() == 0 and files.changed_days(days, state.limit(0)).first().seen == 0


def test_sqlite_and_pivot(spark, tmp_path):
    with sqlite3.connect(tmp_path / "m.db") as con:
        con.execute("CREATE TABLE embedding_metadata (id, key, string_value, int_value, float_value, bool_value)")
        con.executemany("INSERT INTO embedding_metadata VALUES (?,?,?,?,?,?)", [(1, "wing", "w", None, None, None), (1, "n", None, 5, None, None), (2, "wing", "v", None, None, None)])
    spark.dataSource.register(files.SqliteMetadata)
    rows = spark.read.format("sqlite_metadata").option("step", "2").load(str(tmp_path / "m.db"))
    got = {x.id: (x.wing, x.n) for x in quality.eav_pivot(rows, ["wing", "n"]).collect()}
    assert got == {"1": ("w", "5"), "2": ("v", None)}


def test_adapter(spark):
    class Two(files.Adapter):
        @classmethod
        def name(cls):
            return "two"

        def items(self):
            return ["a", "b"]

        def records(self, item):
            yield f"text of {item}", item, 0

    spark.dataSource.register(Two)
    assert sorted(x.document for x in spark.read.format("two").load().collect()) == ["text of a", "text of b"]


def test_entities(spark):
    text = "Ann said hello. She laughed.\nAnn asked why. Thanks Ann!\nWe built Orbit. Deploying Orbit v2 today, import Orbit and orbit.py\nOrbit Orbit"
    got = {x.name: x.type for x in entities.detect(spark.createDataFrame([(1, text), (2, None)], "id int, text string")).collect()}
    assert got["Ann"] == "person" and got["Orbit"] == "project"
    assert entities.candidates(spark.createDataFrame([(1, "The The The Bob")], "id int, text string")).count() == 0


def test_summary(spark):
    text = "Yesterday Alice met Robert about the database. They decided to switched GraphStore because it is better. GraphStore is happy."
    rows = spark.createDataFrame([(text,), ("",), (None,)], "t string").select(summary.compressed("t").alias("s"), summary.ratio("t", summary.compressed("t")).alias("r"))
    got = [x.s for x in rows.collect()]
    assert got[0].startswith("0:ALI+ROB|graphstore_") and "DECISION" in got[0] and "determ" in got[0] and '"' in got[0]
    assert got[1] == got[2] == "0:???|misc"
    back = spark.createDataFrame([(got[0],)], "s string").select(summary.parts("s").alias("p")).first().p
    assert back.people == ["ALI", "ROB"] and back.topics[0] == "graphstore"
