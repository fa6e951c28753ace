"""Filters, collections, knowledge graph, room graph: small fixtures with expected rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestore.operators import browse, collection, filters, graph, kg, quality, vectors
from lodestore.plans import catalogue
from lodestore.schema import DuplicateId, UnsupportedFilter

CHUNKS = [
    ("drawer_proj_backend_aaa", "project", "backend", "auth.py", 0, "token-based sessions"),
    ("drawer_proj_backend_bbb", "project", "backend", "db.py", 0, "migrations, connection pooling"),
    ("drawer_proj_frontend_ccc", "project", "frontend", "App.tsx", 0, "client server-state library"),
    ("drawer_notes_planning_ddd", "notes", "planning", "sprint.md", 0, "sprint plan"),
]
COLUMNS = "id string, wing string, room string, source_file string, chunk_index int, document string"


@pytest.fixture()
def chunks(spark):
    return spark.createDataFrame(CHUNKS, COLUMNS)


def ids(df):
    return sorted(x.id for x in df.select("id").collect())


def test_filters(spark, chunks):
    assert len(ids(chunks.where(filters.where({"wing": "project"})))) == 3
    assert ids(chunks.where(filters.where({"$or": [{"room": "planning"}, {"room": {"$in": ["frontend"]}}]}))) == ["drawer_notes_planning_ddd", "drawer_proj_frontend_ccc"]
    assert len(ids(chunks.where(filters.where(None)))) == 4
    for bad in ({"wing": {"$regex": "x"}}, {"$not": []}):
        with pytest.raises(UnsupportedFilter):
            filters.where(bad)
    with pytest.raises(UnsupportedFilter):
        filters.where_document({"$or": []})


def test_filters_and_nulls(spark):
    rows = spark.createDataFrame([("a", None), ("b", "x"), ("c", "y")], "id string, wing string")
    assert ids(rows.where(filters.where({"wing": {"$ne": "x"}}))) == ["a", "c"]
    assert ids(rows.where(filters.where({"wing": {"$nin": ["x"]}}))) == ["a", "c"]
    assert ids(rows.where(filters.where({"wing": "x"}))) == ["b"]
    assert ids(collection.deleted(rows, where={"wing": "x"})) == ["a", "c"]
    assert ids(collection.deleted(rows)) == ["a", "b", "c"]


def test_taxonomy(chunks):
    assert {(x.wing, x.room): x.n for x in browse.taxonomy(chunks).collect()} == {("project", "backend"): 2, ("project", "frontend"): 1, ("notes", "planning"): 1}
    assert {x.wing: x.n for x in browse.wings(chunks).collect()} == {"project": 3, "notes": 1}


def test_collection(spark, tmp_path, chunks):
    c = collection.Collection(spark, f"file://{tmp_path}")
    assert c.count() == 0
    c.add(chunks)
    with pytest.raises(DuplicateId):
        c.add(chunks.limit(1))
    c.upsert(chunks.limit(2).withColumn("document", F.lit("new")))
    c.upsert(chunks.limit(2).withColumn("document", F.lit("new")))
    assert c.count() == 4 and c.rows().where("document = 'new'").count() == 2
    c.update(spark.createDataFrame([("drawer_notes_planning_ddd", {"a": "1"})], "id string, extra map<string,string>"))
    c.update(spark.createDataFrame([("drawer_notes_planning_ddd", {"b": "2"})], "id string, extra map<string,string>"))
    assert c.get(ids=["drawer_notes_planning_ddd"]).first().extra == {"a": "1", "b": "2"}
    c.delete(where={"wing": "project"})
    assert c.count() == 1
    c.vacuum()
    assert c.count() == 1


FACTS = [
    ("Alice", "parent_of", "Max", "2015-04-01", None), ("Max", "does", "swimming", "2025-01-01", None), ("Max", "does", "chess", "2024-06-01", None),
    ("Alice", "works_at", "Acme Corp", "2020-01-01", "2024-12-31"), ("Alice", "works_at", "NewCo", "2025-01-01", None),
]
NEW = "subject string, predicate string, object string, valid_from string, valid_to string"


@pytest.fixture()
def graph_tables(spark):
    none = spark.createDataFrame([], "id string, " + NEW)
    known = spark.createDataFrame([("alice", "Alice", "person"), ("max", "Max", "person"), ("swimming", "swimming", "activity"), ("chess", "chess", "activity")], "id string, name string, type string")
    return kg.add_triples(none, known, spark.createDataFrame(FACTS, NEW))


def test_kg_counts_and_as_of(graph_tables):
    triples, entities = graph_tables
    s = kg.stats(triples, entities).first()
    assert (s.entities, s.triples, s.open, s.closed, s.predicates) == (6, 5, 4, 1, "does,parent_of,works_at")
    at = lambda day: sorted((x.predicate, x.other) for x in kg.query_entity(triples, entities, "Alice", day, "outgoing").collect())
    assert at("2023-06-01") == [("parent_of", "Max"), ("works_at", "Acme Corp")]
    assert at("2025-06-01") == [("parent_of", "Max"), ("works_at", "NewCo")]
    assert at("2024-12-31") == [("parent_of", "Max"), ("works_at", "Acme Corp")]  # the last day is inside
    order = [x.valid_from for x in kg.timeline(triples, entities).collect()]
    assert order == sorted(order)


def test_kg_writes(spark, graph_tables):
    triples, entities = graph_tables
    again = spark.createDataFrame([("Alice", "works at", "NewCo", "2026-01-01", "2026-02-01"), ("Bob", "knows", "Max", None, None), ("Bob", "knows", "Max", None, None)], NEW)
    more, ents = kg.add_triples(triples, entities, again)
    assert more.count() == 6 and ents.count() == 7
    closed = kg.invalidate(more, "Alice", "works at", "NewCo", "2026-03-01")
    assert closed.where("valid_to = '2026-03-01'").count() == 1
    assert kg.invalidate(closed, "Alice", "works at", "NewCo", "2027-01-01").where("valid_to = '2027-01-01'").count() == 0


@pytest.mark.parametrize(("facts", "kind"), [
    ([("Bob", "husband_of", "Alice", None, None)], "relationship_mismatch"), ([("Bob", "brother", "Alice", "2010-01-01", "2023-06-01")], "stale_fact"),
    ([("Bob", "brother", "Alice", None, None)], None), ([], None),
])
def test_claims(spark, facts, kind):
    none = spark.createDataFrame([], "id string, " + NEW)
    ents = spark.createDataFrame([], "id string, name string, type string")
    triples, entities = kg.add_triples(none, ents, spark.createDataFrame(facts, NEW))
    texts = spark.createDataFrame([(1, "I heard Bob is Alice's brother."), (2, None)], "id int, text string")
    got = [x.type for x in kg.check_claims(kg.claims(texts), triples, entities, "2026-01-01").collect()]
    assert got == ([kind] if kind else [])


def test_similar_names_equal_all_pairs(spark):
    names = ["Anna", "Ana", "Hanna", "Bob", "Rob", "Robert", "Al", "Max", "Maxim", "Jo", "X", "Annabel"]
    a, b = names[::2], names
    got = {(x.mentioned, x.known, x.distance) for x in kg.similar_names(spark.createDataFrame([(x,) for x in a], "name string"), spark.createDataFrame([(x,) for x in b], "name string")).collect()}

    def lev(s, t):
        row = list(range(len(t) + 1))
        for i, c in enumerate(s, 1):
            old, row[0] = row[:], i
            for j, d in enumerate(t, 1):
                row[j] = min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (c != d))
        return row[-1]

    want = {(x, y, lev(x.lower(), y.lower())) for x in a for y in b if y not in a and 0 < lev(x.lower(), y.lower()) <= 2}
    assert got == want


ROOMS = [("chromadb", "wing_code", "databases", "2026-01-01"), ("chromadb", "wing_project", "databases", "2026-01-02"), ("general", "wing_code", "misc", ""), ("orphan", "", "misc", "")]
PLACE = "room string, wing string, hall string, date string"


def test_room_graph(spark):
    c = spark.createDataFrame(ROOMS, PLACE)
    assert [(x.room, x.wing_a, x.wing_b, x.hall) for x in graph.edges(c).collect()] == [("chromadb", "wing_code", "wing_project", "databases")]
    n = graph.nodes(c).collect()
    assert [x.room for x in n] == ["chromadb"] and n[0].wings == ["wing_code", "wing_project"]
    days = spark.createDataFrame([("r", "w", "h", f"2026-01-0{i}") for i in range(1, 10)], PLACE)
    assert graph.nodes(days).first().dates == [f"2026-01-0{i}" for i in range(5, 10)]


def test_traverse(spark):
    c = spark.createDataFrame([("auth", "wing_code", "", ""), ("login", "wing_code", "", ""), ("deploy", "wing_ops", "", "")], PLACE)
    assert [(x.room, x.hop, x.connected_via) for x in graph.traverse(c, "auth").collect()] == [("auth", 0, []), ("login", 1, ["wing_code"])]
    assert graph.traverse(c, "nowhere").count() == 0


def reached(pairs, start, hops):
    """Breadth-first over shared wings, room by room: hop and wings shared with the first discoverer by name."""
    wings = {r: {w for x, w in pairs if x == r} for r, _ in pairs}
    seen, frontier = {start: (0, [])}, [start]
    for hop in range(1, hops + 1):
        found = {r: next(sorted(wings[r] & wings[f]) for f in sorted(frontier) if wings[r] & wings[f]) for r in wings if r not in seen and any(wings[r] & wings[f] for f in frontier)}
        seen |= {r: (hop, via) for r, via in found.items()}
        frontier = list(found)
    return seen


def test_traverse_equals_breadth_first_search(spark):
    r = random.Random(3)
    pairs = [(f"r{r.randrange(60)}", f"w{r.randrange(50)}") for _ in range(110)]
    c = spark.createDataFrame([(*x, "", "") for x in pairs], PLACE)
    assert {x.room: (x.hop, x.connected_via) for x in graph.traverse(c, pairs[0][0], 3, 1000).collect()} == reached(pairs, pairs[0][0], 3)


def test_traverse_2hop_reads_all_line_items(spark, tmp_path):
    r = random.Random(4)
    items = [(390 + i, r.randrange(40), r.randrange(30)) for i in range(70)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    pairs = [(str(p), str(s)) for _, p, s in items]
    want = [(x, hop, sum(x == p for p, _ in pairs)) for x, (hop, _) in reached(pairs, min(pairs)[0], 2).items()]
    got = [tuple(x) for x in catalogue.QUERIES["traverse_2hop"](spark, str(tmp_path)).collect()]
    assert got == sorted(want, key=lambda x: (x[1], -x[2], x[0]))[:50] and len(got) > 10


def test_duplicates_are_all_found(spark):
    r = np.random.default_rng(5)
    base = r.normal(size=(4, 16))
    data = [(i, [float(x) for x in base[i % 4] + r.normal(size=16) * (0.05 if i < 90 else 0.4)]) for i in range(200)]
    rows = spark.createDataFrame(data, "id long, embedding array<double>").repartition(3)
    unit = np.array([v for _, v in data])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = {(q, i) for q in range(4) for i in range(200) if unit[q] @ unit[i] >= 0.8995}
    queries = rows.where("id < 4").withColumnRenamed("id", "query_id")
    assert {(x.query_id, x.id) for x in vectors.duplicates(rows, queries).collect()} == want and len(want) > 80
    few = vectors.duplicates(rows, queries, k=5).collect()
    assert sorted((x.query_id, x["rank"]) for x in few) == [(q, n) for q in range(4) for n in range(1, 6)]


def test_more_queries_than_a_pass_holds(spark, monkeypatch):
    monkeypatch.setattr(vectors, "QUERIES", 3)
    r = np.random.default_rng(6)
    unit = r.normal(size=(40, 8))
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(unit)], "id long, embedding array<double>").repartition(3)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    queries = rows.where("id < 10").withColumnRenamed("id", "query_id")
    got = {(x.query_id, x["rank"]): x.id for x in vectors.top_k(rows, queries, 4).collect()}
    assert got == {(q, k + 1): i for q in range(10) for k, i in enumerate(np.argsort(1 - unit[q] @ unit.T)[:4])}
    assert {(x.query_id, x.id) for x in vectors.duplicates(rows, queries, 0.5).collect()} == {(q, i) for q in range(10) for i in range(40) if unit[q] @ unit[i] >= 0.4995}
    assert vectors.top_k(rows, queries.limit(0), 4).count() == 0


def test_links_are_symmetric_and_keep_their_creation(spark):
    end = "struct<wing:string,room:string,drawer_id:string>"
    empty = spark.createDataFrame([], f"id string, source {end}, target {end}, label string, created_at string, updated_at string")
    row = lambda a, b: spark.createDataFrame([(a, b, "x")], f"source {end}, target {end}, label string")
    one = graph.upsert_links(empty, row(("a", "r", "1"), ("b", "s", "2")), "2026-01-01")
    two = graph.upsert_links(one, row(("b", "s", "2"), ("a", "r", "1")), "2026-02-02")
    got = two.collect()
    assert len(got) == 1 and (got[0].created_at, got[0].updated_at) == ("2026-01-01", "2026-02-02")
    assert [x.direction for x in graph.follow(two, spark.createDataFrame([], "id string, document string"), "a", "r").collect()] == ["incoming"]


def test_near_duplicates(spark):
    near, far = [1.0, 0.0], [0.2, 1.0]
    rows = [(i, "s", "x" * (40 - i), near) for i in range(3)] + [(3, "s", "y" * 30, far), (4, "s", "short", far), (5, "t", "z", near)]
    got = {x.id: x.kept for x in quality.near_duplicates(spark.createDataFrame(rows, "id int, source_file string, document string, embedding array<double>")).collect()}
    assert got == {0: True, 1: False, 2: False, 3: True, 4: False, 5: True}


def test_greedy_pack(spark):
    rows = [("s", i, "x" * n) for i, n in enumerate([700, 700, 200, 1600, 10])]
    got = [x.pack_no for x in quality.greedy_pack(spark.createDataFrame(rows, "source_file string, line_no int, line string")).orderBy("line_no").collect()]
    assert got == [1, 1, 2, 3, 4]
