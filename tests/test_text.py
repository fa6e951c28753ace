"""Search, text functions, transcripts, sweeps and queries against their SQL."""

from __future__ import annotations

import glob
import json
import math
import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodestore.functions import embed, memories, text
from lodestore.functions.query import clean_query
from lodestore.operators import bm25, metrics, search, vectors
from lodestore.schema import DimensionMismatch
from lodestore.sources import transcripts
from lodestore.streaming import sweep

SF = "/root/testdata/sf0.001"


def test_bm25_candidates(spark):
    rows = [(1, "rare common", i, d) for i, d in enumerate(["common words here", "rare thing common", "", "nothing at all", "common common"])]
    got = {x.id: x.bm25 for x in bm25.candidate_scores(spark.createDataFrame(rows, "query_id int, query string, id int, document string")).collect()}
    assert got[2] == got[3] == 0 and max(got, key=got.get) == 1 and got[0] > 0


def test_fusion(spark):
    rows = [(1, "alpha beta", 0, "alpha beta alpha", 0.5), (1, "alpha beta", 1, "unrelated words", 0.3)]
    hit = "query_id int, query string, id int, document string, distance double"
    order = lambda r: [x.id for x in search.fused(spark.createDataFrame(r, hit)).orderBy("rank").collect()]
    assert order(rows) == [0, 1]
    assert order([*rows, (1, "alpha beta", 2, "far", 1.9)])[:2] == [0, 1]


def test_index_hits_may_only_help(spark):
    hits = spark.createDataFrame([(1, f"d{i}", f"s{i}", 0.2 + i / 10) for i in range(4)], "query_id int, id string, source_file string, distance double")
    none = spark.createDataFrame([], "query_id int, source_file string, distance double")
    assert [x.id for x in search.index_boost(hits, none, 4).orderBy("rank").collect()] == ["d0", "d1", "d2", "d3"]
    misled = spark.createDataFrame([(1, "s3", 0.1), (1, "s2", 1.9)], "query_id int, source_file string, distance double")
    got = search.index_boost(hits, misled, 4).orderBy("rank").collect()
    assert {x.id for x in got} == {"d0", "d1", "d2", "d3"} and got[0].id == "d3"
    assert next(x for x in got if x.id == "d2").boost == 0  # too far


def test_top_k_and_dimensions(spark):
    rows = spark.createDataFrame([(i, [math.cos(i), math.sin(i)]) for i in range(50)] + [(99, None)], "id int, embedding array<double>")
    q = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0])], "query_id int, embedding array<double>")
    got = vectors.top_k(rows, q, 3).orderBy("query_id", "rank").collect()
    want = sorted(range(50), key=lambda i: (round(1 - math.cos(i), 9), i))[:3]
    assert [x.id for x in got[:3]] == want and len(got) == 6
    with pytest.raises(DimensionMismatch):
        vectors.dimension(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "embedding array<double>"))


def test_ndcg_uses_the_retrieved_ideal(spark):
    hits = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "query_id int, id string, rank int")
    rel = spark.createDataFrame([(1, "b"), (1, "z")], "query_id int, id string")
    assert metrics.ndcg_at(hits, rel, 5).first().ndcg == pytest.approx(1 / math.log2(3))
    got = metrics.recall_at(hits, rel, [1, 2]).orderBy("k").collect()
    assert [(x.recall_any, x.recall_all) for x in got] == [(0.0, 0.0), (1.0, 0.0)]


def test_clean_query():
    assert clean_query("x" * 200).method == "passthrough" and clean_query("").text == ""
    noise = "You are a helpful system prompt. " * 10
    got = clean_query(noise + "\nWhat was decided about auth?\nWhere is the plan?")
    assert (got.text, got.method) == ("Where is the plan?", "question_extraction")
    assert clean_query(noise + "\n何を決めましたか、教えてください？").method == "question_extraction"
    assert clean_query("word " * 200).clean_length <= 250


def test_noise_and_transforms(spark):
    raw = "<system-reminder>\nhidden\n</system-reminder>\nCURRENT TIME: now\nReal text about CURRENT TIME: inline\nRan 2 Stop hooks (3s)\n… +12 lines (ctrl)\nEnd [3 tokens] (ctrl+o to expand)"
    row = spark.createDataFrame([(raw,)], "t string").select(text.strip_noise("t").alias("a"), text.transformed(F.lit("a\r\n\r\n\r\n\r\nb  "), ["newline_normalize", "whitespace_collapse_internal", "whitespace_trim"]).alias("b")).first()
    assert row.a == "Real text about CURRENT TIME: inline\nEnd" and row.b == "a\n\nb"


def test_chunkers(spark):
    assert len(list(text.fixed_chunks("a" * 2000))) == 3 and list(text.fixed_chunks("short")) == []
    paragraphs = "\n\n".join("p" * 500 for _ in range(4))
    assert all(set(c) <= {"p", "\n"} for c in text.fixed_chunks(paragraphs))
    talk = "> q one is here\nanswer one is long enough\n\nmore of it\n> q two is here\nanswer two is long enough\n---\n> q three\nanswer three is long enough"
    rows = spark.createDataFrame([(1, talk), (2, "no quotes"), (3, None)], "id int, text string")
    got = [x.content for x in text.exchange_chunks(rows).orderBy("chunk_index").collect()]
    assert got[0] == "> q one is here\nanswer one is long enough more of it" and len(got) == 3
    lines = "\n".join(f"line {i} of the text" for i in range(60))
    assert [x.chunk_index for x in text.paragraph_chunks(spark.createDataFrame([(1, lines)], "id int, text string")).collect()] == [0, 1, 2]


def test_tags(spark):
    rows = spark.createDataFrame([("I love python code and the api server bug",), ("",), (None,)], "t string")
    assert [x.h for x in rows.select(text.hall("t").alias("h")).collect()] == ["technical", "general", "general"]
    c = spark.createDataFrame([("a/notes.md", 'Alice met Bob. Alice fixed the login page.\n# Plan of work\n"a quote that is long enough"', "w", "r", ["1", "2", "3", "4"]), ("b/x.txt", "nothing", "w", "r", ["5"])], "source_file string, content string, wing string, room string, chunk_ids array<string>")
    got = [x.line for x in text.index_lines(c).where("source_file = 'a/notes.md'").orderBy("line_no").collect()]
    assert got[0].startswith("fixed the login page") and got[0].endswith("|Alice|→1,2,3") and any(x.startswith('"a quote') for x in got)
    assert text.index_lines(c).where("source_file = 'b/x.txt'").first().line == "w/r/x||→5"


def test_memories(spark):
    rows = spark.createDataFrame([(1, "We decided to use postgres because it is better than the rest"), (2, "I prefer snake_case and please always use tabs"), (3, "tiny"), (4, "The bug was a crash but we fixed it, it works now")], "id int, text string")
    got = {x.id: x.memory_type for x in memories.extract(rows).collect()}
    assert got == {1: "decision", 2: "preference", 4: "milestone"}


def test_embedder(spark):
    got = spark.createDataFrame([("alpha beta alpha",), ("",)], "t string").select(embed.embed("t", 16).alias("e")).collect()
    assert sum(x * x for x in got[0].e) == pytest.approx(1, abs=1e-5) and set(got[1].e) == {0.0}


def test_chats():
    lines = "\n".join(json.dumps(x) for x in ({"type": "user", "message": {"content": "hi"}}, {"type": "assistant", "message": {"content": [{"type": "text", "text": "yo"}]}}, {"type": "summary"}))
    assert transcripts.parse_chat(lines) == [("user", "hi"), ("assistant", "yo")]
    tree = {"mapping": {"r": {"children": ["a"]}, "a": {"parent": "r", "message": {"author": {"role": "user"}, "content": {"parts": ["q"]}}, "children": ["b"]}, "b": {"parent": "a", "message": {"author": {"role": "assistant"}, "content": {"parts": ["z"]}}}}}
    assert transcripts.parse_chat(json.dumps(tree)) == [("user", "q"), ("assistant", "z")]
    channel = [{"type": "message", "user": "U1", "text": "a"}, {"type": "message", "user": "U2", "text": "b"}]
    assert transcripts.parse_chat(json.dumps(channel)) == [("user", "a"), ("assistant", "b")]
    assert transcripts.parse_chat("> a\n> b\n> c") is None and transcripts.parse_chat("plain") is None


MESSAGES = [("u-1", "abc", "10:00:05", "user"), ("a-1", "abc", "10:00:06", "assistant"), ("u-2", "abc", "10:01:00", "user"), ("a-2", "abc", "10:01:01", "assistant")]
MESSAGE = "id string, session_id string, timestamp string, role string"


def test_sweep(spark):
    m = spark.createDataFrame(MESSAGES, MESSAGE)
    none = m.limit(0)
    assert sweep.new_messages(m, none).count() == 4 and sweep.new_messages(m, m).count() == 0
    tied = spark.createDataFrame([("x", "abc", "10:01:01", "user"), ("y", "abc", "10:00:00", "user")], MESSAGE)
    assert [x.id for x in sweep.new_messages(tied, m).collect()] == ["x"]
    c = sweep.counted(m.unionByName(tied), m).first()
    assert (c.added, c.present, c.skipped) == (1, 1, 4)


def test_sweep_stream(spark, tmp_path):
    src, store = f"{tmp_path}/in", f"{tmp_path}/store"
    m = spark.createDataFrame(MESSAGES, MESSAGE)
    m.limit(0).write.parquet(store)
    append = lambda rows: rows.write.mode("append").parquet(store)
    for _ in range(2):
        m.write.mode("append").parquet(src)
        q = sweep.sweep_stream(spark.readStream.schema(m.schema).parquet(src), lambda: spark.read.schema(m.schema).parquet(store), append, f"{tmp_path}/check")
        q.awaitTermination()
    assert spark.read.parquet(store).count() == 4


def test_jsonl_reader(spark, tmp_path):
    rows = [{"type": "user", "sessionId": "s", "uuid": "1", "timestamp": "t", "message": {"content": "hi"}}, {"type": "assistant", "sessionId": "s", "uuid": "2", "timestamp": "t", "message": {"content": [{"type": "text", "text": "yo"}]}}, {"type": "progress"}]
    (tmp_path / "a.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\nbroken {")
    got = transcripts.read_jsonl(spark, str(tmp_path / "a.jsonl")).orderBy("uuid").collect()
    assert [(x.role, x.content) for x in got] == [("user", "hi"), ("assistant", "yo")]


def _same(spark_rows, duck_rows, names):
    def cell(v):
        if v is None or v != v:
            return "null"
        return f"{round(float(v), 5)}" if isinstance(v, int | float) and not isinstance(v, bool) else str(v)

    keys = sorted(names)
    table = lambda rows: sorted(tuple(cell(r[k]) for k in keys) for r in rows)
    return table(spark_rows) == table(duck_rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_queries_equal_their_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from lodestore.plans.catalogue import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    wrong = []
    for name, sql in ORACLE_SQL.items():
        df = QUERIES[name](spark, SF)
        cur = con.execute(sql)
        cols = [c[0] for c in cur.description]
        if sorted(cols) != sorted(df.columns) or not _same([r.asDict() for r in df.collect()], [dict(zip(cols, r, strict=True)) for r in cur.fetchall()], cols):
            wrong.append(name)
    assert wrong == []


def test_memories_of_equal_texts_are_read_once(spark, monkeypatch):
    texts = ["We decided to go with a queue because it is simpler.\n\nThere is a bug: the import keeps failing with an error, and it is broken.", "I prefer tabs. Please always use tabs, never use spaces.", "", None]
    df = spark.createDataFrame([(i, texts[i % 4]) for i in range(40)], "id long, text string")
    seen = []
    whole = memories.classified
    monkeypatch.setattr(memories, "classified", lambda rows, *a: seen.append(rows) or whole(rows, *a))
    for most in (memories.BROADCAST_BYTES, 0):
        monkeypatch.setattr(memories, "BROADCAST_BYTES", most)
        got = sorted((x.id, x.segment, x.memory_type) for x in memories.extract(df).collect())
        assert got == [x for i in range(40) for x in ([(i, 0, "decision"), (i, 1, "problem")] if i % 4 == 0 else [(i, 0, "preference")] if i % 4 == 1 else [])]
    assert [x.count() for x in seen] == [3, 3]


@pytest.mark.parametrize("most", [1000, 0])
def test_documents_are_shuffled_once_for_scores(spark, monkeypatch, most):
    monkeypatch.setattr(bm25, "BROADCAST_TERMS", most)
    rows = [(i, f"red {'fox ' * (i % 4)} word{i}") for i in range(30)] + [(5, "red word5 fox"), (None, "fox"), (40, None)]
    docs = spark.createDataFrame(rows, "id long, document string")
    queries = spark.createDataFrame([(1, "red fox"), (2, "word7 Fox fox"), (3, "absent")], "query_id int, query string")
    scores = bm25.corpus_scores(docs, queries)
    lists = [(i, re.findall(r"\w{2,}", (x or "").lower())) for i, x in rows]
    n, mean, tf, want = len(rows), sum(len(x) for _, x in lists) / len(rows), Counter(), Counter()
    for i, x in lists:
        for term, k in Counter(x).items():
            tf[term, i, len(x)] += k
    df = Counter(term for term, *_ in tf)
    for q, asked in ((1, {"red", "fox"}), (2, {"word7", "fox"})):
        for (term, i, length), k in tf.items():
            if term in asked:
                want[q, i] += math.log((n - df[term] + 0.5) / (df[term] + 0.5) + 1) * k * 2.5 / (k + 1.5 * (0.25 + 0.75 * length / mean))
    got = {(x.query_id, x.id): x.score for x in scores.collect()}
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-9 for x in want)
    plan = scores._jdf.queryExecution().optimizedPlan()
    if most:  # grouping by a document's terms and by its queries needs no exchange of its own
        text = bm25.top_k(scores, 2)._jdf.queryExecution().sparkPlan().toString()
        assert plan.toString().count("RepartitionByExpression [id") >= 1 and "SortMergeJoin" not in text


def test_bm25_search_equals_the_ranks_of_all_scores_and_shuffles_only_best_rows(spark, monkeypatch):
    import random

    monkeypatch.setattr(bm25, "ROWS", 16)
    rng = random.Random(5)
    words = ["wolf", "cat", "the", "the", "zug", "straße", "x9", "run"]
    docs = [(f"d{i:03}", " ".join(rng.choice(words) for _ in range(rng.randrange(0, 12)))) for i in range(300)]
    docs += [(f"c{i:03}", "wolf cat") for i in range(40)] + [(None, "wolf wolf"), ("n", None)]
    asked = [(1, "the wolf"), (2, "Zug cat wolf"), (3, "unknown"), (None, "run"), (4, "")]
    queries = spark.createDataFrame(asked, "query_id int, query string")

    def rows(found):
        return sorted(((r.query_id or 0), r["rank"], r.id or "", round(r.score, 9)) for r in found.select("query_id", "id", "score", "rank").collect())

    for extra in ([], [("d001", "wolf wolf cat"), ("d002", "zug")]):  # rows with one id are one document
        df = spark.createDataFrame(docs + extra, "id string, document string").repartition(3)
        found = bm25.search(df, queries, 7)
        assert rows(found) == rows(bm25.top_k(bm25.corpus_scores(df, queries), 7))
        if not extra:
            plan = found._jdf.queryExecution().sparkPlan().toString()
            assert "MapInArrow" in plan and "HashAggregate" not in plan  # no sums by query and document
    assert bm25.search(df, queries.limit(0), 3).collect() == [] == bm25.search(df.limit(0), queries, 3).collect()
