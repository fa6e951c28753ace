"""Edges of the store: vectors that aren't numbers, many queries, overflow, equal rows of a batch."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestore.functions import tools
from lodestore.operators import collection, quality, search, vectors


@pytest.mark.parametrize("most", [4096, 7])
def test_vectors_that_are_no_numbers_and_many_queries(spark, monkeypatch, most):
    monkeypatch.setattr(vectors, "QUERIES", most)
    monkeypatch.setattr(vectors, "ROWS", 20)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 5)).round(3)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(100, [float("nan")] * 5), (101, [None, 1.0, 1.0, 1.0, 1.0]), (102, None), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (104, [0.0] * 5), (7, x[7].tolist())]
    df = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(2)
    queries = df.select(F.col("id").alias("query_id"), "embedding").where("id % 2 = 0")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = vectors.top_k(df, queries, 3).collect()
    for q in range(0, 60, 2):
        d = [(round(1 - float(unit[q] @ unit[i]), 9), i) for i in [*range(60), 7]] + [(1.0, 104)]
        mine = sorted((r["rank"], r.id, r.distance) for r in got if r.query_id == q)
        assert [i for _, i, _ in mine] == [i for _, i in sorted(d)[:3]]
        assert [v for *_, v in mine] == pytest.approx([v for v, _ in sorted(d)[:3]], abs=1e-8)
    assert {r.query_id for r in got} == {*range(0, 60, 2), 104}
    assert vectors.top_k(df, queries.limit(0), 3).collect() == []
    near = {(r.query_id, r.id) for r in vectors.duplicates(df, queries, 0.9).collect()}
    assert {(q, q) for q in range(0, 60, 2)} <= near and not any(i in (100, 101, 102, 103) for p in near for i in p)


def test_numbers_beyond_their_type_are_left_out(spark):
    rows = [(1, "what happened 99999999 months ago?"), (2, "what happened 2 months ago?"), (3, "nothing"), (4, None)]
    df = spark.createDataFrame(rows, "id int, q string").select("id", search.time_offset(F.col("q")).alias("x"))
    assert {r.id: r.x and r.x.days for r in df.collect()} == {1: None, 2: 60, 3: None, 4: None}
    calls = spark.createDataFrame([('{"file_path": "a", "offset": 9223372036854775807, "limit": 5}',), ('{"file_path": "a", "offset": 3, "limit": 5}',)], "j string")
    assert [r.x for r in calls.select(tools.call(F.lit("Read"), F.col("j")).alias("x")).collect()] == ["[Read a:9223372036854775807]", "[Read a:3-8]"]


def test_equal_rows_of_a_batch_go_in_once(spark):
    rows = spark.createDataFrame([("w", "r", "same"), ("w", "r", "same"), ("w", "r", "other")], "wing string, room string, document string")
    first = collection.from_tool(rows, spark.createDataFrame([], "id string"))
    assert sorted(r.document for r in first.collect()) == ["other", "same"]
    assert collection.from_tool(rows, first).count() == 0


def test_near_pairs_meet_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(quality, "PAIR_TILE", 16)
    r = np.random.default_rng(5)
    rows = [(i, i % 3, v.tolist()) for i, v in enumerate(r.normal(size=(120, 6)))]
    rows += [(3, 0, [1.0] * 6), (500, 0, None), (501, 0, [0.0] * 6), (502, 0, [None] * 6), (503, 0, [float("nan")] * 6), (None, 0, [1.0] * 6), (504, None, [1.0] * 6), (505, 0, [1.0, 2.0]), (506, 9, [1.0] * 6)]
    df = spark.createDataFrame(rows, "id long, source_file int, embedding array<double>")
    want = {}
    good = [x for x in rows if x[0] is not None and x[1] is not None and x[2] and None not in x[2] and any(x[2]) and x[2][0] == x[2][0]]
    for i, s, a in good:
        for j, q, b in good:
            if s == q and i < j and len(a) == len(b) and np.dot(a, b) / np.sqrt(np.dot(a, a) * np.dot(b, b)) > 0.3:
                want[s] = want.get(s, 0) + 1
    assert {x.source_file: x.pairs for x in quality.near_pairs(df, 0.7).collect()} == want
    plan = quality.near_pairs(df, 0.7)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" in plan  # tiles of vectors meet, not rows
