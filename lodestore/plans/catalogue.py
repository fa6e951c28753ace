"""Queries of the library's operators on the driver's tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestore import scratch
from lodestore.functions import memories, text, tools, validate
from lodestore.operators import bm25, browse, collection, filters, graph, kg, metrics, quality, search, vectors
from lodestore.plans import tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def _lit(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


# --- filters and reads

_SHORT = "SELECT doc_id AS id, lang AS wing, source AS room, n_chars FROM documents WHERE "


def _filtered(spec) -> Query:
    return lambda s, d: t.chunks(s, d).where(filters.where(spec)).select("id", "wing", "room", "n_chars")


for _name, _spec, _sql in (
    ("where_eq_and", {"wing": "en", "room": "src3"}, "lang = 'en' AND source = 'src3'"),
    ("where_ne", {"wing": {"$ne": "en"}}, "lang IS DISTINCT FROM 'en'"),
    ("where_in_nin", {"room": {"$in": ["src1", "src2", "src3"]}, "wing": {"$nin": ["en"]}}, "source IN ('src1','src2','src3') AND (lang NOT IN ('en') OR lang IS NULL)"),
    ("where_or_range", {"$or": [{"n_chars": {"$lt": 100}}, {"n_chars": {"$gte": 5000, "$lte": 9000}}]}, "n_chars < 100 OR (n_chars >= 5000 AND n_chars <= 9000)"),
    ("where_nested", {"$and": [{"$or": [{"wing": "fr"}, {"wing": "de"}]}, {"n_chars": {"$gt": 2000}}]}, "(lang = 'fr' OR lang = 'de') AND n_chars > 2000"),
    ("where_contains", {"room": {"$contains": "1"}}, "contains(source, '1')"),
    ("scope_wing_room", filters.scope("de", "src5"), "lang = 'de' AND source = 'src5'"),
):
    QUERIES[_name], ORACLE_SQL[_name] = _filtered(_spec), _SHORT + _sql


@query("SELECT doc_id AS id FROM documents WHERE contains(text, 'License')")
def where_document_contains(s, d):
    return t.chunks(s, d).where(filters.where_document({"$contains": "License"})).select("id")


@query("SELECT doc_id AS id, lang AS wing, source AS room, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS preview FROM documents WHERE lang = 'es' ORDER BY doc_id LIMIT 20 OFFSET 10")
def get_page(s, d):
    return filters.get(t.chunks(s, d), spec={"wing": "es"}, limit=20, offset=10).select("id", "wing", "room", filters.preview("document").alias("preview"))


@query("SELECT count(*) AS n FROM documents")
def count(s, d):
    return t.chunks(s, d).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT page_id, coalesce(nullif(split_part(url, '/', -1), ''), '?') AS name FROM pages")
def base_name(s, d):
    return t.table(s, d, "pages").select("page_id", filters.base_name("url").alias("name"))


@query(r"SELECT doc_id AS id, md5(CASE WHEN length(x) > 200 THEN substr(x, 1, 200) || '...' ELSE x END) AS snippet FROM (SELECT doc_id, replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), chr(10), ' ') AS x FROM documents)")
def snippets(s, d):
    return t.chunks(s, d).select("id", F.md5(filters.snippet("document").cast("binary")).alias("snippet"))


_NAMES = ("'Wing ' || doc_id", "'a/b' || doc_id", "'..' || doc_id", "'  '", "repeat('x', 100 + CAST(doc_id % 60 AS INT))", "'_lead' || doc_id", "'tail-'", "source || chr(0)", "NULL", "'née ' || lang", "'a: (b), ' || doc_id")
_NAMED = "CASE doc_id % 11 " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(_NAMES)) + " END"
_BLANK = "(v IS NULL OR trim(v) = '')"


@query(f"""WITH n AS (SELECT doc_id AS id, {_NAMED} AS v FROM documents)
SELECT id, CASE WHEN {_BLANK} THEN 'empty' WHEN length(trim(v)) > 128 THEN 'too long' WHEN contains(v, '..') OR contains(v, '/') THEN 'path' WHEN contains(v, chr(0)) THEN 'null byte'
WHEN NOT regexp_full_match(trim(v), '[\\p{{L}}\\p{{N}}]|[\\p{{L}}\\p{{N}}][\\p{{L}}\\p{{N}}_ .''-]{{0,126}}[\\p{{L}}\\p{{N}}]') THEN 'characters' END AS as_name,
CASE WHEN {_BLANK} THEN 'empty' WHEN length(trim(v)) > 128 THEN 'too long' WHEN contains(v, chr(0)) THEN 'null byte' END AS as_fact,
CASE WHEN {_BLANK} THEN 'empty' WHEN length(repeat(v, 700)) > 100000 THEN 'too long' WHEN contains(v, chr(0)) THEN 'null byte' END AS as_content FROM n""".replace("\\\\", "\\"))
def value_faults(s, d):
    rows = t.table(s, d, "documents").select(F.col("doc_id").alias("id"), F.expr(_NAMED).alias("v"))
    return rows.select("id", validate.name_fault(F.col("v")).alias("as_name"), validate.fact_fault(F.col("v")).alias("as_fact"), validate.content_fault(F.repeat("v", F.lit(700))).alias("as_content"))


# --- vectors

_COS = "1 - list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[])"
_KNN = f"""WITH h AS (SELECT q.vec_id AS query_id, e.vec_id AS id, {_COS} AS d FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0 {{where}}),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), id) AS rank FROM h)
SELECT query_id, id, round(d, 6) AS distance, CAST(rank AS INT) AS rank FROM r WHERE rank <= {{k}}"""


def _hits(h: DataFrame) -> DataFrame:
    return h.select("query_id", "id", F.round("distance", 6).alias("distance"), "rank")


@query(_KNN.format(where="", k=5))
def knn_topk(s, d):
    return _hits(vectors.top_k(t.vectors(s, d), t.probes(s, d), 5))


@query(_KNN.format(where="AND e.label IN (1, 2, 3)", k=5))
def knn_filtered(s, d):
    return _hits(vectors.top_k(t.vectors(s, d).where(filters.where({"wing": {"$in": ["1", "2", "3"]}})), t.probes(s, d), 5))


@query(_KNN.format(where=f"AND {_COS} <= 0.8", k=50))
def knn_threshold(s, d):
    return _hits(vectors.top_k(t.vectors(s, d), t.probes(s, d), 50, max_distance=0.8))


@query(f"SELECT q.vec_id AS query_id, e.vec_id AS id, round({_COS}, 6) AS distance FROM embeddings e, embeddings q WHERE q.vec_id = 3 ORDER BY round({_COS}, 9), e.vec_id LIMIT 10")
def knn_single(s, d):
    q = t.vectors(s, d).where("id = 3").select(F.col("id").alias("query_id"), F.col("embedding").alias("q"))
    rows = t.vectors(s, d).crossJoin(F.broadcast(q))  # one row
    dist = vectors.cosine_distance(F.col("embedding"), F.col("q"))
    return rows.withColumn("x", dist).orderBy(F.round("x", 9), "id").limit(10).select("query_id", "id", F.round("x", 6).alias("distance"))


@query("SELECT q.vec_id AS query_id, e.vec_id AS id FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0 AND list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) >= 0.8995")
def check_duplicate(s, d):
    return vectors.duplicates(t.vectors(s, d), t.probes(s, d)).select("query_id", "id")


@query("SELECT CAST(min(len(embedding)) AS INT) AS dim, count(*) AS n FROM embeddings")
def vector_dimension(s, d):
    v = t.vectors(s, d)
    return v.agg(F.lit(vectors.dimension(v)).alias("dim"), F.count(F.lit(1)).alias("n"))


# --- BM25 and hybrid search

_TOK = r"regexp_extract_all(lower(coalesce({0}, '')), '[\p{{L}}\p{{N}}_\p{{M}}]{{2,}}')"
_BM25_SQL = f"""
WITH d AS (SELECT doc_id AS id, {_TOK.format('text')} AS t FROM documents),
w AS (SELECT count(*)::DOUBLE AS n, greatest(avg(len(t)), 1) AS mean FROM d),
q AS (SELECT item_id AS query_id, unnest(list_distinct({_TOK.format('text')})) AS term FROM benchmark),
p AS (SELECT id, len(t)::DOUBLE AS length, unnest(t) AS term FROM d),
tf AS (SELECT term, id, length, count(*)::DOUBLE AS tf FROM p WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*)::DOUBLE AS df FROM tf GROUP BY term),
s AS (SELECT q.query_id, tf.id, sum(ln((n - df + 0.5) / (df + 0.5) + 1) * tf * (k1 + 1) / (tf + k1 * (1 - 0.75 + 0.75 * length / mean))) AS score
      FROM tf JOIN df USING (term) JOIN q USING (term), w, (SELECT %K1% AS k1) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id) AS rank FROM s)"""


def _bm25_sql(k1: str = "1.5::DOUBLE") -> str:
    return _BM25_SQL.replace("%K1%", k1)


def _bm25_top(s, d, k, **kw):
    return bm25.search(t.chunks(s, d), t.queries(s, d), k, **kw)


@query(_bm25_sql("1.5::DOUBLE") + "SELECT query_id, id, round(score, 4) AS score, CAST(rank AS INT) AS rank FROM r WHERE rank <= 5")
def bm25_topk(s, d):
    return _bm25_top(s, d, 5).select("query_id", "id", F.round("score", 4).alias("score"), "rank")


@query(_bm25_sql("1.2::DOUBLE") + "SELECT query_id, id, round(1 / (1 + score), 6) AS distance FROM r WHERE rank <= 10")
def fulltext_pseudo_distance(s, d):
    return _bm25_top(s, d, 10, k1=1.2).select("query_id", "id", F.round(1 / (1 + F.col("score")), 6).alias("distance"))


_CAND = _bm25_sql("1.5::DOUBLE") + rf""",
c AS (SELECT r.query_id, r.id, b.text AS query, x.text AS document, r.rank / 20.0 AS distance FROM r JOIN benchmark b ON b.item_id = r.query_id JOIN documents x ON x.doc_id = r.id WHERE rank <= 10),
ct AS (SELECT query_id, id, {_TOK.format('document')} AS t, list_distinct({_TOK.format('query')}) AS qt, distance FROM c),
cn AS (SELECT *, len(t)::DOUBLE AS length, count(*) OVER (PARTITION BY query_id)::DOUBLE AS n, avg(len(t)) OVER (PARTITION BY query_id) AS mean FROM ct),
cp AS (SELECT query_id, id, length, n, mean, qt, unnest(t) AS term FROM cn),
ctf AS (SELECT query_id, id, length, n, mean, term, count(*)::DOUBLE AS tf FROM cp WHERE list_contains(qt, term) GROUP BY ALL),
cdf AS (SELECT *, count(*) OVER (PARTITION BY query_id, term)::DOUBLE AS df FROM ctf),
cs AS (SELECT query_id, id, sum(ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / mean))) AS bm25 FROM cdf GROUP BY 1, 2),
ca AS (SELECT c.query_id, c.id, c.distance, coalesce(cs.bm25, 0) AS bm25 FROM c LEFT JOIN cs USING (query_id, id))"""


def _candidates(s, d):
    hits = _bm25_top(s, d, 10).select("query_id", "id", (F.col("rank") / 20.0).alias("distance"))
    # the hits go to the texts, which aren't shuffled, and are found once
    found = scratch.written(hits.join(t.queries(s, d), "query_id"), f"{scratch.folder(s)}/found")
    near = F.broadcast if found.count() <= bm25.BROADCAST_TERMS else lambda x: x
    return scratch.written(t.chunks(s, d).select("id", "document").join(near(found), "id"), f"{scratch.folder(s)}/candidates")


@query(_CAND + " SELECT query_id, id, round(bm25, 4) AS bm25 FROM ca")
def bm25_candidate_rerank(s, d):
    return bm25.candidate_scores(_candidates(s, d)).select("query_id", "id", F.round("bm25", 4).alias("bm25"))


@query(_CAND + """, f AS (SELECT *, 0.6 * greatest(0, 1 - distance) + 0.4 * bm25 / nullif(max(bm25) OVER (PARTITION BY query_id), 0) AS fused FROM ca)
SELECT query_id, id, round(fused, 4) AS fused, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(fused, 6) DESC, round(distance, 6), id) AS INT) AS rank FROM f""")
def hybrid_rank(s, d):
    return search.fused(_candidates(s, d)).select("query_id", "id", F.round("fused", 4).alias("fused"), "rank")


@query("""WITH h AS (SELECT q.vec_id AS query_id, e.vec_id AS id, e.label AS source_file, 1 - list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS d FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0),
a AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), id) AS rank FROM h WHERE id % 2 = 0),
c AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), id) AS k FROM h WHERE id % 2 = 1),
p AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), source_file) AS place FROM c WHERE k <= 10),
b AS (SELECT query_id, source_file, min(place) AS place, arg_min(d, place) AS bd FROM p GROUP BY 1, 2),
x AS (SELECT a.query_id, a.id, a.d - CASE WHEN bd <= 1.5 AND place <= 5 THEN [0.40, 0.25, 0.15, 0.08, 0.04][place] ELSE 0 END AS eff FROM a LEFT JOIN b USING (query_id, source_file) WHERE a.rank <= 15),
y AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(eff, 9), id) AS rank FROM x)
SELECT query_id, id, round(eff, 6) AS effective, CAST(rank AS INT) AS rank FROM y WHERE rank <= 5""")
def closet_boost(s, d):
    v = t.vectors(s, d).withColumnRenamed("wing", "source_file")
    src = v.select("id", "source_file")
    near = lambda rows, k: vectors.top_k(rows, t.probes(s, d), k).drop("rank").join(src, "id")
    hits, index = near(v.where("id % 2 = 0"), 15), near(v.where("id % 2 = 1"), 10)
    return search.index_boost(hits, index, 5).select("query_id", "id", F.round("effective", 6).alias("effective"), "rank")


_CHUNKS = "SELECT conv_id AS source_file, CAST(turn AS INT) AS chunk_index, text AS document FROM conversations"


def _turns(s, d):
    return t.table(s, d, "conversations").select(F.col("conv_id").alias("source_file"), F.col("turn").cast("int").alias("chunk_index"), F.col("text").alias("document"))


@query(f"""WITH c AS ({_CHUNKS}), n AS (SELECT source_file, count(*) AS total FROM c GROUP BY 1)
SELECT h.source_file, h.chunk_index AS hit_index, md5(string_agg(c.document, chr(10) || chr(10) ORDER BY c.chunk_index, c.document)) AS text, n.total
FROM c h JOIN c ON c.source_file = h.source_file AND abs(c.chunk_index - h.chunk_index) <= 1 JOIN n ON n.source_file = h.source_file GROUP BY ALL""")
def neighbor_expand(s, d):
    c = _turns(s, d)
    return search.neighbours(c, c).withColumn("text", F.md5(F.col("text").cast("binary")))


@query(f"""WITH c AS ({_CHUNKS}), h AS (SELECT source_file, chunk_index AS query_id, document AS query FROM c),
m AS (SELECT c.*, query_id, row_number() OVER (PARTITION BY c.source_file, query_id ORDER BY chunk_index) AS pos, count(*) OVER (PARTITION BY c.source_file, query_id) AS total,
      len(list_filter(list_distinct({_TOK.format('query')}), lambda x: contains(lower(document), x))) AS found FROM c JOIN h USING (source_file)),
b AS (SELECT *, first_value(pos) OVER (PARTITION BY source_file, query_id ORDER BY found DESC, pos) AS best FROM m)
SELECT source_file, query_id, best - 1 AS best_index, total, md5(substr(string_agg(document, chr(10) || chr(10) ORDER BY pos), 1, 10000)) AS text FROM b WHERE abs(pos - best) <= 1 GROUP BY ALL""")
def hydrate_best_chunk(s, d):
    c = _turns(s, d)
    hits = c.select("source_file", F.col("chunk_index").alias("query_id"), F.col("document").alias("query"))
    out = search.hydrate(hits, c).withColumn("text", F.md5(F.col("text").cast("binary")))
    return out.select("source_file", "query_id", F.col("best_index").cast("long").alias("best_index"), "total", "text")


@query(_bm25_sql("1.5::DOUBLE") + r""", c AS (SELECT r.query_id, r.id, r.rank / 20.0 AS d, lower(x.text) AS doc, list_distinct(regexp_extract_all(lower(b.text), '[a-z]{3,}')) AS k
 FROM r JOIN benchmark b ON b.item_id = r.query_id JOIN documents x ON x.doc_id = r.id WHERE rank <= 10)
SELECT query_id, id, round(d * (1 - 0.3 * CASE WHEN len(k) > 0 THEN len(list_filter(k, lambda x: contains(doc, x))) / len(k) ELSE 0 END), 6) AS distance FROM c""")
def keyword_overlap_rerank(s, d):
    c = _candidates(s, d)
    return c.select("query_id", "id", F.round(search.keyword_overlap(F.col("distance"), F.col("document"), search.keywords("query")), 6).alias("distance"))


@query("""SELECT event_id, round(CASE WHEN abs(x) <= 7 THEN 0.6 WHEN abs(x) <= 21 THEN 1 - 0.4 * (1 - (abs(x) - 7) / 14.0) ELSE 1 END, 6) AS factor
FROM (SELECT event_id, date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS x FROM events)""")
def temporal_boost(s, d):
    off = F.datediff(F.lit("2024-02-01").cast("date"), F.col("ts").cast("date"))
    return t.table(s, d, "events").select("event_id", F.round(search.temporal_factor(off, 7), 6).alias("factor"))


@query("""WITH n AS (SELECT n_nationkey AS id, n_name || ' wrote "' || lower(n_name) || '" to Alice' AS doc FROM nation)
SELECT id, round(CASE WHEN contains(lower(doc), 'alice') THEN 0.6 ELSE 1 END * (1 - 0.6 * ((CASE WHEN contains(lower(doc), 'france') THEN 1 ELSE 0 END) / 1.0)), 6) AS factor FROM n""")
def quoted_name_boost(s, d):
    n = F.col("n_name")
    doc, q = F.concat(n, F.lit(' wrote "'), F.lower(n), F.lit('" to Alice')), F.lit('What did Alice say about "France"?')
    names = search.name_factor(q, doc, not_names=("What", "France"))
    return t.table(s, d, "nation").select(F.col("n_nationkey").alias("id"), F.round(names * search.quoted_factor(q, doc), 6).alias("factor"))


@query("""SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN 'a' || doc_id || ';b_' || doc_id ELSE 'x' || doc_id || ';y' END AS refs FROM documents""")
def pointer_parse(s, d):
    i = F.col("id").cast("string")
    line = F.when(F.col("id") % 3 == 0, "topic||").when(F.col("id") % 3 == 1, F.concat(F.lit("topic|Name|→a"), i, F.lit(",b_"), i)).otherwise(F.concat(F.lit("one||→x"), i, F.lit("\ntwo|N|→y,x"), i))
    return t.chunks(s, d).select("id", F.array_join(search.pointers(line), ";").alias("refs"))


@query(_KNN.format(where="", k=20).replace("SELECT query_id, id, round(d, 6) AS distance, CAST(rank AS INT) AS rank", "SELECT query_id, id, round(d * CASE WHEN (SELECT label FROM embeddings x WHERE x.vec_id = r.id) = query_id % 7 THEN 0.8 ELSE 1 END, 6) AS distance"))
def room_soft_boost(s, d):
    v = t.vectors(s, d)
    hits = vectors.top_k(v, t.probes(s, d), 20).join(v.select("id", F.col("wing").alias("room")), "id")
    return hits.select("query_id", "id", F.round(search.room_boost(F.col("distance"), F.col("room"), (F.col("query_id") % 7).cast("string")), 6).alias("distance"))


@query("""WITH q AS (SELECT vec_id AS query_id FROM embeddings WHERE vec_id % 50 = 0), r AS (SELECT DISTINCT label AS room FROM embeddings), x AS (SELECT query_id, room, (query_id / 50 * 7 + room * 5) % 11 AS score FROM q, r),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, CAST(room AS VARCHAR)) AS place, count(*) OVER (PARTITION BY query_id) AS n FROM x)
SELECT query_id, vec_id AS id FROM k JOIN embeddings ON label = room WHERE place <= greatest(2, floor(n / 3))""".replace("query_id / 50", "query_id // 50"))
def room_hard_routing(s, d):
    v = t.vectors(s, d).withColumnRenamed("wing", "room")
    rooms = v.select("room").distinct()
    scores = t.probes(s, d).select("query_id").join(F.broadcast(rooms.groupBy().agg(F.collect_set("room").alias("rooms")))).select("query_id", F.explode("rooms").alias("room"))
    scores = scores.withColumn("score", F.expr("(query_id div 50 * 7 + CAST(room AS INT) * 5) % 11"))
    return search.room_routed(scores, v, 2).select("query_id", "id")


@query("SELECT doc_id AS id, CAST(unnest(range(0, 1 + doc_id % 3)) AS INT) AS entry, '## part ' || unnest(range(0, 1 + doc_id % 3)) || chr(10) || 'of ' || doc_id AS text FROM documents")
def diary_entries(s, d):
    part = F.transform(F.sequence(F.lit(0).cast("long"), F.col("id") % 3), lambda k: F.concat(F.lit("## part "), k.cast("string"), F.lit("\nof "), F.col("id").cast("string")))
    days = t.chunks(s, d).select("id", F.concat(F.lit("# day\n"), F.array_join(part, "\n")).alias("text"))
    return text.diary_entries(days).select("id", F.col("entry").cast("int").alias("entry"), "text")


_ASKED = ("'What did I buy ' || doc_id % 40 || ' days ago?'", "'A couple of days ago, or last week?'", "'Yesterday I said'", "'a week ago'", "(doc_id % 5) || ' weeks ago or 3 months ago'", "'LAST  WEEK'", "'a month ago'",
          "(doc_id % 9) || ' months ago'", "'last month, last year'", "'last year'", "'a year ago'", "'Recently so'", "'never'")
_ASK = f"CASE doc_id % {len(_ASKED)} " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(_ASKED)) + " END"


@query(f"WITH q AS (SELECT doc_id AS id, lower({_ASK}) AS q FROM documents), " + "f AS (SELECT id, CASE " + " ".join(
    f"WHEN regexp_matches(q, {_lit(p)}) THEN [{days if days else f'CAST(regexp_extract(q, {_lit(p)}, 1) AS INT) * {k}'}, {tol}]" for p, days, k, tol in search.OFFSETS
) + " END AS f FROM q) SELECT id, CAST(f[1] AS INT) AS days, CAST(f[2] AS INT) AS tolerance FROM f")
def time_offsets(s, d):
    rows = t.table(s, d, "documents").select(F.col("doc_id").alias("id"), search.time_offset(F.expr(_ASK)).alias("x"))
    return rows.select("id", "x.days", "x.tolerance")


_SAY = ("'I prefer tea with ' || role || '. I prefer tea with ' || role || '!'", "'lately, I''ve been working on part ' || conv_id || ', and i want to rest more?'", "'I am looking for a ' || text", "text", "'i usually go; i''m worried about turn ' || turn")
_SAID = "CASE (conv_id + turn) % 5 " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(_SAY)) + " END"


@query(f"WITH c AS (SELECT conv_id AS session_id, lower({_SAID}) AS x FROM conversations WHERE role = 'user'), m AS (" + " UNION ALL ".join(
    f"SELECT session_id, unnest(regexp_extract_all(x, {_lit(p)}, 1)) AS m FROM c" for p in search.PREFERENCES
) + r"), k AS (SELECT session_id, regexp_replace(trim(m), '[.,;!? ]+$', '') AS mention FROM m) SELECT DISTINCT session_id, mention FROM k WHERE length(mention) BETWEEN 5 AND 80")
def preference_mentions(s, d):
    turns = t.table(s, d, "conversations").withColumn("text", F.expr(_SAID)).withColumnsRenamed({"conv_id": "session_id", "turn": "ts"})
    return search.preferences(turns).select("session_id", "mention")


_QUERY = 'Did Anna ever say "good night" about garden roses near Rome?'
_HAS = lambda x: f"contains(low, '{x}')::INT"


@query(f"""WITH d AS (SELECT doc_id AS id, lower(CASE doc_id % 4 WHEN 0 THEN 'Anna said good night.' WHEN 1 THEN 'roses in the garden of Rome' WHEN 2 THEN 'anna and rome, near' ELSE text END) AS low FROM documents)
SELECT id, round((1 - 0.5 * ({' + '.join(map(_HAS, ('say', 'good', 'night', 'garden', 'roses', 'near')))}) / 6) * (1 - 0.6 * {_HAS('good night')}) * (1 - 0.2 * ({_HAS('anna')} + {_HAS('rome')}) / 2), 6) AS factor FROM d""")
def predicate_fusion(s, d):
    doc = F.when(F.col("id") % 4 == 0, "Anna said good night.").when(F.col("id") % 4 == 1, "roses in the garden of Rome").when(F.col("id") % 4 == 2, "anna and rome, near").otherwise(F.col("document"))
    factor = search.predicate_factor(F.lit(_QUERY), doc, stop=("did", "ever", "about"), not_names=("Did",))
    return t.chunks(s, d).select("id", F.round(factor, 6).alias("factor"))


# --- counts and browsing


@query("""SELECT CASE WHEN grouping(wing) = 1 AND grouping(room) = 1 THEN 'total' WHEN grouping(room) = 1 THEN 'wing' ELSE 'room' END AS level, wing, room, count(*) AS n
FROM (SELECT coalesce(lang, 'unknown') AS wing, coalesce(source, 'unknown') AS room FROM documents) GROUP BY GROUPING SETS ((wing), (room), ())""")
def status_grouping_sets(s, d):
    return browse.status(t.chunks(s, d))


@query("SELECT coalesce(lang, 'unknown') AS wing, count(*) AS n FROM documents GROUP BY 1")
def wings(s, d):
    return browse.wings(t.chunks(s, d))


@query("SELECT coalesce(source, 'unknown') AS room, count(*) AS n FROM documents WHERE lang = 'en' GROUP BY 1")
def rooms(s, d):
    return browse.rooms(t.chunks(s, d), "en")


@query("SELECT coalesce(lang, 'unknown') AS wing, coalesce(source, 'unknown') AS room, count(*) AS n FROM documents GROUP BY 1, 2")
def taxonomy(s, d):
    return browse.taxonomy(t.chunks(s, d))


@query("SELECT l_suppkey AS source_file, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 5")
def source_groups(s, d):
    return browse.source_groups(t.table(s, d, "lineitem").select(F.col("l_suppkey").alias("source_file")))


@query("SELECT count(*) AS sources, CAST(sum(n) AS BIGINT) AS chunks, CAST(sum(CASE WHEN n > 20 THEN floor(n * 0.4) ELSE 0 END) AS BIGINT) AS estimate FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 5)")
def dedup_stats(s, d):
    g = browse.source_groups(t.table(s, d, "lineitem").select(F.col("l_suppkey").alias("source_file")))
    return browse.dedup_estimate(g).withColumn("estimate", F.col("estimate").cast("long"))


@query(r"""WITH c AS (SELECT doc_id AS id, source AS room, n_chars % 7 AS weight, replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), chr(10), ' ') AS x FROM documents),
k AS (SELECT id, room, CAST(weight AS DOUBLE) AS weight, length(CASE WHEN length(x) > 200 THEN substr(x, 1, 200) || '...' ELSE x END) AS n FROM c ORDER BY weight DESC, id LIMIT 15),
u AS (SELECT *, CAST(sum(n) OVER (ORDER BY room, weight DESC, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS spent FROM k)
SELECT room, id, weight, spent FROM u WHERE spent <= 3200""")
def essential_story(s, d):
    c = t.chunks(s, d).withColumn("importance", F.col("n_chars") % 7)
    return browse.essential_story(c).select("room", "id", "weight", "spent")


_STORY = ORACLE_SQL["essential_story"].replace("AS n FROM c", "AS n, CASE WHEN length(x) > 200 THEN substr(x, 1, 200) || '...' ELSE x END AS snippet FROM c").replace("SELECT room, id, weight, spent FROM u", "SELECT room, id, weight, snippet FROM u")


@query(f"""SELECT md5(text) AS text, CAST(floor(length(text) / 4) AS INT) AS tokens FROM (SELECT 'I am a store.' || chr(10) || chr(10) || string_agg('[' || room || '] ' || snippet, chr(10) ORDER BY room, weight DESC, id) AS text FROM ({_STORY}))""")
def wake_up(s, d):
    c = t.chunks(s, d).withColumn("importance", F.col("n_chars") % 7)
    return browse.wake_up(c, "I am a store.").withColumn("text", F.md5(F.col("text").cast("binary")))


@query("SELECT 3 AS identity_tokens, count(*) AS total_drawers FROM documents")
def stack_status(s, d):
    return browse.stack_status(t.chunks(s, d), "I am a store.")


@query("SELECT doc_id AS id, lang AS wing, source AS room FROM documents WHERE lang = 'fr' ORDER BY doc_id LIMIT 10")
def recall_wing(s, d):
    return browse.recall(t.chunks(s, d), wing="fr").select("id", "wing", "room")


@query("""SELECT event_id AS id, user_id, total FROM (SELECT event_id, user_id, ts, count(*) OVER () AS total FROM events WHERE event_type = (SELECT min(event_type) FROM events)) ORDER BY ts DESC, event_id DESC LIMIT 10""")
def diary_recent(s, d):
    e = t.table(s, d, "events")
    agent = e.agg(F.min("event_type")).first()[0]
    rows = e.select(F.col("event_id").alias("id"), "user_id", F.lit("diary").alias("room"), F.col("event_type").alias("agent"), F.col("ts").alias("filed_at"))
    return browse.diary(rows, agent).select("id", "user_id", "total")


@query("SELECT lang AS wing, count(DISTINCT source) AS rooms, count(*) AS chunks FROM documents GROUP BY 1")
def export_index(s, d):
    return browse.export_index(t.chunks(s, d))


@query("""WITH u AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS k FROM conversations WHERE role = 'user'),
w AS (SELECT conv_id AS session_id, unnest(regexp_extract_all(lower(substr(text, 1, 200)), '[a-z]{4,}')) AS word FROM u WHERE k <= 30),
c AS (SELECT session_id, word, count(*) AS n FROM w WHERE word NOT IN ('that', 'this', 'with', 'from') GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY n DESC, word) AS rank FROM c)
SELECT session_id, word, n, CAST(rank AS INT) AS rank FROM r WHERE rank <= 3""")
def themes_top3(s, d):
    return browse.themes(t.messages(s, d), ["that", "this", "with", "from"])


@query("SELECT conv_id AS session_id, count(*) FILTER (role = 'user') AS n FROM conversations GROUP BY 1 HAVING count(*) FILTER (role = 'user') >= 3")
def message_trigger(s, d):
    saved = s.createDataFrame([], "session_id bigint, saved bigint")
    return browse.message_trigger(t.messages(s, d), saved, 3).select("session_id", "n")


@query("SELECT DISTINCT r_name AS name FROM region UNION SELECT n_name FROM nation")
def name_union(s, d):
    r = t.table(s, d, "region").agg(F.lit("regions").alias("category"), F.collect_list("r_name").alias("names"))
    return browse.names(r.unionByName(t.table(s, d, "nation").agg(F.lit("nations").alias("category"), F.collect_list("n_name").alias("names"))))


# --- the room graph

_PLACES = """SELECT p_brand AS room, n_name AS wing, p_type AS hall, strftime(l_shipdate, '%Y-%m-%d') AS date
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""
_EDGES = f"""WITH p AS ({_PLACES}), w AS (SELECT DISTINCT room, wing FROM p), h AS (SELECT DISTINCT room, hall FROM p), c AS (SELECT room, count(*) AS count FROM p GROUP BY 1)
SELECT a.room, a.wing AS wing_a, b.wing AS wing_b, hall, count FROM w a JOIN w b ON a.room = b.room AND a.wing < b.wing JOIN h ON h.room = a.room JOIN c ON c.room = a.room"""


@query(f"""SELECT room, list_aggregate(list_sort(list(DISTINCT wing)), 'string_agg', ',') AS wings, count(*) AS count,
list_aggregate(list_sort(list(DISTINCT date))[greatest(count(DISTINCT date) - 4, 1):], 'string_agg', ',') AS dates FROM ({_PLACES}) GROUP BY room""")
def graph_nodes(s, d):
    n = graph.nodes(t.places(s, d))
    return n.select("room", F.array_join("wings", ",").alias("wings"), "count", F.array_join("dates", ",").alias("dates"))


@query(f"SELECT room, wing_a, wing_b, count(*) AS halls, max(count) AS count FROM ({_EDGES}) GROUP BY 1, 2, 3")
def graph_edges(s, d):
    return graph.edges(t.places(s, d)).groupBy("room", "wing_a", "wing_b").agg(F.count(F.lit(1)).alias("halls"), F.max("count").alias("count"))


@query(f"SELECT room, count(*) AS count FROM ({_PLACES}) GROUP BY 1 HAVING count(DISTINCT wing) >= 2 ORDER BY count DESC, room LIMIT 50")
def tunnels(s, d):
    return graph.tunnels(t.places(s, d)).select("room", "count")


@query(f"SELECT (SELECT count(DISTINCT room) FROM ({_PLACES})) AS rooms, (SELECT count(*) FROM (SELECT room FROM ({_PLACES}) GROUP BY 1 HAVING count(DISTINCT wing) >= 2)) AS tunnel_rooms, (SELECT count(*) FROM ({_EDGES})) AS edges")
def graph_stats(s, d):
    return graph.stats(t.places(s, d))


_ITEMS = "SELECT CAST(l_partkey AS VARCHAR) AS room, CAST(l_suppkey AS VARCHAR) AS wing FROM lineitem"


@query(f"""WITH p AS ({_ITEMS}), w AS (SELECT DISTINCT room, wing FROM p), s AS (SELECT min(room) AS room FROM p),
a AS (SELECT DISTINCT b.room FROM w x JOIN w b USING (wing) WHERE x.room = (SELECT room FROM s) AND b.room <> (SELECT room FROM s)),
c AS (SELECT DISTINCT b.room FROM w x JOIN w b USING (wing) WHERE x.room IN (SELECT room FROM a) AND b.room NOT IN (SELECT room FROM a) AND b.room <> (SELECT room FROM s)),
h AS (SELECT room, 0 AS hop FROM s UNION ALL SELECT room, 1 FROM a UNION ALL SELECT room, 2 FROM c)
SELECT h.room, CAST(hop AS INT) AS hop, count(*) AS count FROM h JOIN p ON p.room = h.room GROUP BY 1, 2 ORDER BY hop, count DESC, h.room LIMIT 50""")
def traverse_2hop(s, d):
    p = t.table(s, d, "lineitem").select(F.col("l_partkey").cast("string").alias("room"), F.col("l_suppkey").cast("string").alias("wing"))
    p = p.withColumns({"hall": F.lit(""), "date": F.lit("")})
    return graph.traverse(p, p.agg(F.min("room")).first()[0], 2).select("room", "hop", "count")


@query(f"SELECT DISTINCT room, CASE WHEN contains(room, '2') THEN 1.0 ELSE 0.5 END::DOUBLE AS score FROM ({_PLACES}) WHERE contains(room, '2') ORDER BY score DESC, room LIMIT 5")
def fuzzy_rooms(s, d):
    return graph.fuzzy_rooms(t.places(s, d), "2").select("room", F.col("score").cast("double").alias("score"))


def _links(s, d):
    n = t.table(s, d, "nation").join(t.table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    end = lambda wing, room, i: F.struct(wing.alias("wing"), room.alias("room"), i.alias("drawer_id"))
    i = F.col("n_nationkey").cast("string")
    rows = n.select(end(F.col("n_name"), F.lit("home"), i).alias("source"), end(F.col("r_name"), F.lit("all"), i).alias("target"), F.lit("in").alias("label"))
    empty = s.createDataFrame([], "id string, source struct<wing:string,room:string,drawer_id:string>, target struct<wing:string,room:string,drawer_id:string>, label string, created_at string, updated_at string")
    return graph.upsert_links(empty, rows, "2024-01-01")


@query("""SELECT substr(sha256(CASE WHEN a < b THEN a || '↔' || b ELSE b || '↔' || a END), 1, 16) AS id, created_at FROM (SELECT n_name || '/home' AS a, r_name || '/all' AS b, '2024-01-01' AS created_at FROM nation JOIN region ON n_regionkey = r_regionkey)""")
def link_upsert(s, d):
    return _links(s, d).select("id", "created_at")


@query("SELECT n_name AS wing FROM nation WHERE n_nationkey % 3 <> 0")
def link_delete(s, d):
    links = _links(s, d)
    gone = links.where("CAST(source.drawer_id AS INT) % 3 = 0").select("id").unionByName(s.createDataFrame([("unknown",)], "id string"))
    return graph.delete_links(links, gone).select(F.col("source.wing").alias("wing"))


@query("SELECT n_name AS wing, r_name AS other FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = (SELECT min(r_name) FROM region)")
def list_links(s, d):
    first = t.table(s, d, "region").agg(F.min("r_name")).first()[0]
    return graph.list_links(_links(s, d), first).select(F.col("source.wing").alias("wing"), F.col("target.wing").alias("other"))


@query("SELECT n_name AS wing, 'incoming' AS direction, substr(text, 1, 300) AS preview FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN documents ON doc_id = n_nationkey WHERE r_name = (SELECT min(r_name) FROM region)")
def follow_links(s, d):
    first = t.table(s, d, "region").agg(F.min("r_name")).first()[0]
    c = t.chunks(s, d).withColumn("id", F.col("id").cast("string"))
    return graph.follow(_links(s, d), c, first, "all").select("wing", "direction", "preview")


# --- the knowledge graph

_TIME = "strftime({0}, '%Y-%m-%dT%H:%M:%S')"
_FACTS = f"""SELECT CAST(event_id AS VARCHAR) AS id, 'user_' || user_id AS subject, event_type AS predicate, 'event_' || event_id AS object, {_TIME.format('ts')} AS valid_from,
{_TIME.format('lead(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id)')} AS valid_to FROM events"""
_AS_OF = "(valid_from IS NULL OR valid_from <= '{0}') AND (valid_to IS NULL OR valid_to >= '{0}')"
_NOON = "2024-01-15T12:00:00"


@query(f"SELECT predicate, replace(object, 'event_', 'Event ') AS other, valid_from, valid_to, valid_to IS NULL AS current FROM ({_FACTS}) WHERE subject = 'user_7'")
def kg_outgoing(s, d):
    return kg.query_entity(t.facts(s, d), t.entities(s, d), "User 7", direction="outgoing").select("predicate", "other", "valid_from", "valid_to", "current")


@query(f"SELECT predicate, replace(subject, 'user_', 'User ') AS other, valid_from FROM ({_FACTS}) WHERE object = 'event_11'")
def kg_incoming(s, d):
    return kg.query_entity(t.facts(s, d), t.entities(s, d), "Event 11", direction="incoming").select("predicate", "other", "valid_from")


@query(f"SELECT 'outgoing' AS direction, predicate, replace(object, 'event_', 'Event ') AS other FROM ({_FACTS}) WHERE subject = 'user_3' AND {_AS_OF.format(_NOON)}")
def kg_both_asof(s, d):
    return kg.query_entity(t.facts(s, d), t.entities(s, d), "user 3", as_of=_NOON).select("direction", "predicate", "other")


@query(f"SELECT subject, object, valid_from FROM ({_FACTS}) WHERE predicate = (SELECT min(event_type) FROM events) AND {_AS_OF.format(_NOON)}")
def kg_relationship(s, d):
    f = t.facts(s, d)
    first = f.agg(F.min("predicate")).first()[0]
    return kg.query_relationship(f, t.entities(s, d), first, _NOON).select("subject", "object", "valid_from")


@query(f"SELECT subject, predicate, valid_from FROM ({_FACTS}) ORDER BY valid_from ASC NULLS LAST, id LIMIT 100")
def kg_timeline(s, d):
    return kg.timeline(t.facts(s, d), t.entities(s, d)).select("subject", "predicate", "valid_from")


@query(f"SELECT id, subject, valid_from FROM ({_FACTS}) ORDER BY valid_from ASC NULLS LAST, id LIMIT 100")
def kg_list(s, d):
    return kg.list_triples(t.facts(s, d)).select("id", "subject", "valid_from")


@query(f"""SELECT count(*) AS triples, count(*) FILTER (valid_to IS NULL) AS open, count(*) FILTER (valid_to IS NOT NULL) AS closed, string_agg(DISTINCT predicate, ',' ORDER BY predicate) AS predicates,
(SELECT count(DISTINCT user_id) + count(*) FROM events) AS entities FROM ({_FACTS})""")
def kg_stats(s, d):
    return kg.stats(t.facts(s, d), t.entities(s, d))


# every fact again, open and with its own dates, and each closed one with another end besides
@query(f"""WITH f AS ({_FACTS}), o AS (SELECT DISTINCT subject, predicate, object FROM f WHERE valid_to IS NULL),
n AS (SELECT subject, predicate, object, NULL AS valid_from, NULL AS valid_to FROM f UNION SELECT subject, predicate, object, valid_from, valid_to FROM f WHERE valid_to IS NOT NULL
      UNION SELECT subject, predicate, object, valid_from, '2031-01-01' FROM f WHERE valid_to IS NOT NULL)
SELECT subject, predicate, object, valid_from, valid_to FROM f UNION ALL
SELECT n.* FROM n WHERE (subject, predicate, object) NOT IN (SELECT (subject, predicate, object) FROM o) AND (valid_to IS NULL OR valid_to = '2031-01-01')""")
def kg_add_batch(s, d):
    f = t.facts(s, d).select("id", "subject", "predicate", "object", "valid_from", "valid_to")
    none = F.lit(None).cast("string")
    new = f.withColumns({"valid_from": none, "valid_to": none}).unionByName(f).unionByName(f.where("valid_to IS NOT NULL").withColumn("valid_to", F.lit("2031-01-01")))
    return kg.add_triples(f, t.entities(s, d), new.drop("id"))[0].select("subject", "predicate", "object", "valid_from", "valid_to")


@query(f"""WITH f AS ({_FACTS}), x AS (SELECT predicate, object FROM f WHERE subject = 'user_5' AND valid_to IS NULL ORDER BY predicate LIMIT 1)
SELECT id, CASE WHEN subject = 'user_5' AND valid_to IS NULL AND (predicate, object) IN (SELECT (predicate, object) FROM x) THEN '2030-01-01' ELSE valid_to END AS valid_to FROM f WHERE subject = 'user_5'""")
def kg_invalidate(s, d):
    f = t.facts(s, d)
    x = f.where("subject = 'user_5' AND valid_to IS NULL").orderBy("predicate").first()
    return kg.invalidate(f, "user 5", x.predicate if x else "", x.object if x else "", "2030-01-01").where("subject = 'user_5'").select("id", "valid_to")


# each nation's name without its first letter is mentioned
@query("""SELECT DISTINCT substr(a.n_name, 2) AS mentioned, b.n_name AS known, levenshtein(lower(substr(a.n_name, 2)), lower(b.n_name)) AS distance FROM nation a, nation b
WHERE lower(b.n_name) NOT IN (SELECT lower(substr(n_name, 2)) FROM nation) AND levenshtein(lower(substr(a.n_name, 2)), lower(b.n_name)) BETWEEN 1 AND 2""")
def similar_names(s, d):
    n = t.table(s, d, "nation")
    return kg.similar_names(n.select(F.expr("substr(n_name, 2)").alias("name")), n.select(F.col("n_name").alias("name"))).withColumn("distance", F.col("distance").cast("long"))


# facts by region: another role, the same role ended, the same role open, the same role ending later, none
@query("""SELECT n_nationkey AS id, CASE n_regionkey WHEN 0 THEN 'relationship_mismatch' ELSE 'stale_fact' END AS type,
CASE n_regionkey WHEN 0 THEN 'cousin' ELSE 'brother' END AS fact FROM nation WHERE n_regionkey IN (0, 1)""")
def claims_mismatch(s, d):
    n = t.table(s, d, "nation").select(F.col("n_nationkey").alias("id"), F.concat(F.lit("N"), F.translate(F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), "0123456789", "abcdefghij")).alias("x"), F.col("n_regionkey").alias("r"))
    texts = n.select("id", F.when(F.col("id") % 2 == 0, F.concat("x", F.lit(" is Alice's brother."))).otherwise(F.concat(F.lit("Alice's Brother is "), "x")).alias("text"))
    texts = texts.withColumn("text", F.replace("text", F.lit("Brother"), F.lit("brother")))
    facts = n.where("r < 4").select(
        kg.slug("x").alias("subject"), F.when(F.col("r") == 0, "cousin").otherwise("brother").alias("predicate"), F.lit("alice").alias("object"),
        F.lit("2010-01-01").alias("valid_from"), F.when(F.col("r") == 1, "2020-01-01").when(F.col("r") == 3, "2025-01-01").alias("valid_to"),
    )
    ents = n.select(kg.slug("x").alias("id"), F.col("x").alias("name")).unionByName(s.createDataFrame([("alice", "Alice")], "id string, name string"))
    return kg.check_claims(kg.claims(texts), facts, ents, "2024-01-01").select("id", "type", "fact")


# --- incremental and set-based writes


@query("SELECT user_id AS session_id, max(ts) AS cursor FROM events GROUP BY 1")
def sweep_cursor(s, d):
    return t.table(s, d, "events").groupBy(F.col("user_id").alias("session_id")).agg(F.max("ts").alias("cursor"))


@query("""WITH c AS (SELECT user_id, max(ts) AS cursor FROM events WHERE event_id % 2 = 0 GROUP BY 1)
SELECT e.event_id FROM events e LEFT JOIN c USING (user_id) WHERE (c.cursor IS NULL OR e.ts >= c.cursor) AND e.event_id NOT IN (SELECT event_id FROM events WHERE event_id % 2 = 0)""")
def sweep_new_rows(s, d):
    from lodestore.streaming.sweep import new_messages

    e = t.table(s, d, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("session_id"), F.col("ts").alias("timestamp"))
    return new_messages(e, e.where("id % 2 = 0")).select(F.col("id").alias("event_id"))


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def upsert_latest(s, d):
    return collection.latest(t.table(s, d, "events"), "user_id", F.struct("ts", "event_id")).select("user_id", "event_id")


@query("SELECT doc_id AS id, CASE WHEN doc_id % 10 = 0 THEN 'moved' ELSE source END AS room FROM documents")
def update_merge(s, d):
    c = t.chunks(s, d).select("id", "wing", "room")
    return collection.updated(c, c.where("id % 10 = 0").select("id", F.lit("moved").alias("room"))).select("id", "room")


@query("SELECT doc_id AS id FROM documents WHERE NOT coalesce(lang = 'de' AND n_chars < 1000, false)")
def delete_where(s, d):
    return collection.deleted(t.chunks(s, d), where={"wing": "de", "n_chars": {"$lt": 1000}}).select("id")


@query("SELECT doc_id, 'drawer_' || lang || '_' || source || '_' || substr(sha256(CAST(doc_id AS VARCHAR) || '0'), 1, 24) AS id FROM documents")
def drawer_ids(s, d):
    rows = t.chunks(s, d).select(F.col("id").alias("doc_id"), "wing", "room", F.col("id").cast("string").alias("source_file"), F.lit(0).alias("chunk_index"), "document")
    return collection.from_file(rows).select("doc_id", "id")


def _drawers(s, d):
    """Documents as stored chunks of two files a source."""
    rows = t.chunks(s, d).select(F.concat_ws("/", "room", (F.col("id") % 2).cast("string")).alias("source_file"), F.col("id").cast("int").alias("chunk_index"), "wing", "room", "document", F.col("id").alias("doc_id"))
    return collection.from_file(rows).withColumn("source_mtime", F.col("doc_id") % 2 + 0.5)


_DRAWERS = """SELECT 'drawer_' || lang || '_' || source || '_' || substr(sha256(concat_ws('/', source, doc_id % 2) || doc_id), 1, 24) AS id, concat_ws('/', source, doc_id % 2) AS source_file,
doc_id, CAST(doc_id % 2 + 0.5 AS DOUBLE) AS source_mtime, lang, source, text FROM documents"""


@query(f"SELECT id, CASE WHEN doc_id % 3 = 0 THEN 'new ' || doc_id ELSE md5(text) END AS said FROM ({_DRAWERS}) UNION ALL SELECT 'other_' || doc_id, 'new ' || doc_id FROM documents WHERE doc_id % 5 = 0")
def upsert_rows(s, d):
    base = _drawers(s, d).select("id", "doc_id", F.md5(F.col("document").cast("binary")).alias("said"))
    said = F.concat(F.lit("new "), F.col("doc_id").cast("string")).alias("said")
    new = base.where("doc_id % 3 = 0").select("id", said).unionByName(base.where("doc_id % 5 = 0").select(F.concat(F.lit("other_"), F.col("doc_id").cast("string")).alias("id"), said))
    return collection.upserted(base.drop("doc_id"), new)


@query(f"SELECT source_file, doc_id FROM ({_DRAWERS}) WHERE doc_id % 2 = 0 UNION ALL SELECT DISTINCT source_file, -1 FROM ({_DRAWERS}) WHERE doc_id % 2 = 1")
def replace_sources(s, d):
    base = _drawers(s, d).select("source_file", "doc_id")
    return collection.replaced_sources(base, base.where("doc_id % 2 = 1").select("source_file", F.lit(-1).cast("long").alias("doc_id")).distinct())


@query("""SELECT 'drawer_' || lang || '_' || source || '_' || substr(sha256(lang || source || text), 1, 24) AS id, CAST(1 AS BIGINT) AS n FROM documents
WHERE text NOT IN (SELECT text FROM documents WHERE doc_id % 4 = 0) OR (lang, source, text) NOT IN (SELECT (lang, source, text) FROM documents WHERE doc_id % 4 = 0) GROUP BY 1""")
def tool_drawers(s, d):
    rows = t.chunks(s, d).select("id", "wing", "room", "document")
    stored = collection.from_tool(rows.where("id % 4 = 0").drop("id"), s.createDataFrame([], "id string"))
    return collection.from_tool(rows.drop("id"), stored).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH f AS (SELECT DISTINCT source_file FROM ({_DRAWERS})) SELECT source_file, CAST(m AS DOUBLE) AS source_mtime FROM (SELECT source_file, unnest([0.5, 1.5, 1.5005, 2.5]) AS m FROM f)
WHERE NOT (m = 0.5 AND source_file LIKE '%/0' OR m IN (1.5, 1.5005) AND source_file LIKE '%/1')""")
def stale_sources(s, d):
    c = _drawers(s, d)
    files = c.select("source_file").distinct().withColumn("source_mtime", F.explode(F.array(*[F.lit(x) for x in (0.5, 1.5, 1.5005, 2.5)])))
    return collection.stale_sources(files, c)


@query("SELECT 'user_' || user_id AS id, CASE WHEN user_id % 2 = 0 THEN 'USER ' || user_id ELSE 'User ' || user_id END AS name FROM (SELECT DISTINCT user_id FROM events) UNION ALL SELECT 'event_' || event_id, 'Event ' || event_id FROM events")
def kg_upsert_entities(s, d):
    e = t.entities(s, d)
    new = e.where("id LIKE 'user%' AND CAST(substr(id, 6) AS INT) % 2 = 0").select(F.upper("name").alias("name"))
    return kg.upsert_entities(e, new).select("id", "name")


@query(f"SELECT '_reg_' || substr(sha256(f), 1, 24) AS id, lang AS wing, f AS source_file FROM (SELECT DISTINCT lang, concat_ws('/', source, k) AS f FROM documents, (VALUES (0), (7)) v(k)) WHERE f NOT IN (SELECT source_file FROM ({_DRAWERS}))")
def registry_rows(s, d):
    c = _drawers(s, d)
    files = t.chunks(s, d).select("wing", F.explode(F.array(*[F.concat_ws("/", "room", F.lit(k)) for k in ("0", "7")])).alias("source_file"))
    return collection.sentinels(files, c).select("id", "wing", "source_file")


_PATH = "CASE doc_id % 4 WHEN 0 THEN '/h/u/-home-u-Projects-My App' || doc_id || '/s.jsonl' WHEN 1 THEN 'C:\\p\\-Projects-Tool' WHEN 2 THEN '/srv/' || source ELSE '/' END"


@query("SELECT doc_id, " + "CASE doc_id % 4 WHEN 0 THEN 'wing_my_app' || doc_id WHEN 1 THEN 'wing_tool' ELSE 'wing_sessions' END AS wing, "
       "CASE doc_id % 4 WHEN 0 THEN 's_jsonl' WHEN 1 THEN 'C__p__Projects_Tool' WHEN 2 THEN source ELSE 'palace' END || '_' || substr(sha256(" + _PATH + "), 1, 8) AS store FROM documents")
def derived_names(s, d):
    p = F.expr(_PATH.replace("\\", "\\\\"))
    return t.table(s, d, "documents").select("doc_id", collection.transcript_wing(p).alias("wing"), collection.store_name(p).alias("store"))


# --- quality


@query("""SELECT doc_id AS id, CASE WHEN doc_id % 11 = 0 THEN 'missing' ELSE 'document' END AS state FROM documents WHERE doc_id % 11 = 0 OR doc_id % 7 = 0""")
def parity_audit(s, d):
    a = t.chunks(s, d).select("id", "document", "wing")
    b = a.where("id % 11 <> 0").withColumn("document", F.when(F.col("id") % 7 == 0, F.concat("document", F.lit("!"))).otherwise(F.col("document")))
    return quality.parity(a, b, ["document", "wing"])


@query("SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unfetchable_ids(s, d):
    return quality.unfetchable(t.chunks(s, d).select("id"), t.table(s, d, "labels").select(F.col("doc_id").alias("id")))


@query("SELECT p_partkey AS id, p_brand AS brand, CAST(p_size AS VARCHAR) AS size FROM part")
def eav_pivot(s, d):
    p = t.table(s, d, "part")
    none = lambda k: F.lit(None).cast(k)
    rows = p.select(F.col("p_partkey").alias("id"), F.lit("brand").alias("key"), F.col("p_brand").alias("string_value"), none("int").alias("int_value"), none("double").alias("float_value"), none("boolean").alias("bool_value"))
    rows = rows.unionByName(p.select(F.col("p_partkey").alias("id"), F.lit("size").alias("key"), none("string").alias("string_value"), F.col("p_size").alias("int_value"), none("double").alias("float_value"), none("boolean").alias("bool_value")))
    return quality.eav_pivot(rows, ["brand", "size"])


@query("""WITH RECURSIVE e AS (SELECT vec_id AS id, CAST(label AS VARCHAR) AS source_file, embedding::DOUBLE[] AS v, 20 + vec_id % 50 AS n, count(*) OVER (PARTITION BY label) AS size,
       row_number() OVER (PARTITION BY label ORDER BY 20 + vec_id % 50 DESC, vec_id) AS pos FROM embeddings),
c AS (SELECT a.id, list(b.id) AS close FROM e a JOIN e b ON a.source_file = b.source_file AND a.id <> b.id AND 1 - list_cosine_similarity(a.v, b.v) < 0.15 GROUP BY 1),
o AS (SELECT e.*, coalesce(close, []) AS close FROM e LEFT JOIN c USING (id) WHERE size >= 5),
g(source_file, pos, kept) AS (SELECT DISTINCT source_file, CAST(0 AS BIGINT), CAST([] AS BIGINT[]) FROM o UNION ALL
  SELECT g.source_file, o.pos, CASE WHEN n >= 20 AND NOT list_has_any(kept, close) THEN list_append(kept, id) ELSE kept END FROM g JOIN o ON o.source_file = g.source_file AND o.pos = g.pos + 1),
f AS (SELECT source_file, max_by(kept, pos) AS kept FROM g GROUP BY 1)
SELECT o.id, o.source_file, list_contains(f.kept, o.id) AS kept FROM o JOIN f USING (source_file) UNION ALL SELECT id, source_file, true FROM e WHERE size < 5""")
def near_dup_greedy(s, d):
    v = t.vectors(s, d).withColumn("document", F.repeat(F.lit("x"), 20 + F.col("id").cast("int") % 50)).withColumnRenamed("wing", "source_file")
    return quality.near_duplicates(v)


@query("""SELECT label AS source_file, count(*) AS pairs FROM (SELECT a.label FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id
WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) > 0.3) GROUP BY 1""")
def near_dup_pairs(s, d):
    return quality.near_pairs(t.table(s, d, "embeddings"), 0.7, "label", "vec_id")


# --- text


@query(r"""SELECT doc_id AS id, len(list_filter(list_transform(str_split(text, chr(10) || chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')) AS paragraphs FROM documents""")
def paragraph_counts(s, d):
    c = F.filter(F.transform(F.split("document", "\n\n"), text.strip), lambda p: p != "")
    return t.chunks(s, d).select("id", F.size(c).cast("long").alias("paragraphs"))


_PARAS = f"list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: {_STRIP.format('x')}), lambda x: x <> '')"
_GROUPS = f"list_transform(range(0, len(lines), 25), lambda i: {_STRIP.format('array_to_string(lines[i + 1:i + 25], chr(10))')})"


@query(f"""WITH l AS (SELECT doc_id AS id, string_split(text, chr(10)) AS lines, {_PARAS} AS paras FROM documents),
s AS (SELECT id, list_filter(CASE WHEN len(paras) <= 1 AND len(lines) > 21 THEN {_GROUPS} ELSE paras END, lambda x: length(x) > 30) AS parts FROM l)
SELECT id, CAST(generate_subscripts(parts, 1) - 1 AS INT) AS chunk_index, unnest(parts) AS content FROM s""")
def paragraph_chunks(s, d):
    return text.paragraph_chunks(t.chunks(s, d), "id", "document")


# a chunk's start depends on the end of the one before
_CUT = "CASE WHEN pos + 800 >= n THEN n WHEN blank > 0 AND length(w) - blank - 1 > 400 THEN pos + length(w) - blank - 1 WHEN line > 0 AND length(w) - line > 400 THEN pos + length(w) - line ELSE pos + 800 END"


@query(rf"""WITH RECURSIVE d AS (SELECT doc_id AS id, {_STRIP.format("coalesce(text, '')")} AS text FROM documents),
c(id, text, n, pos, stop, step) AS (
  SELECT id, text, length(text), CAST(0 AS BIGINT), CAST(0 AS BIGINT), 0 FROM d WHERE length(text) > 0 UNION ALL
  SELECT id, text, n, CASE WHEN cut < n THEN cut - 100 ELSE cut END, cut, step + 1 FROM (SELECT *, {_CUT} AS cut FROM (
    SELECT *, strpos(reverse(w), chr(10) || chr(10)) AS blank, strpos(reverse(w), chr(10)) AS line FROM (SELECT *, substr(text, pos + 1, 800) AS w FROM c WHERE pos < n)))),
p AS (SELECT c.id, c.step, {_STRIP.format("substr(c.text, b.pos + 1, c.stop - b.pos)")} AS content FROM c JOIN (SELECT id, step + 1 AS step, pos FROM c) b ON b.id = c.id AND b.step = c.step)
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY step) - 1 AS INT) AS chunk_index, content FROM p WHERE length(content) >= 50""")
def fixed_chunks(s, d):
    return text.chunked(t.chunks(s, d), "id", "document")


@query(rf"""WITH d AS (SELECT conv_id AS id, string_agg(CASE WHEN role = 'user' THEN '> ' || replace(text, chr(10), ' ') ELSE text END, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY 1),
l AS (SELECT id, generate_subscripts(ls, 1) AS k, {_STRIP.format('unnest(ls)')} AS x FROM (SELECT id, string_split(text, chr(10)) AS ls FROM d)),
m AS (SELECT *, sum((starts_with(x, '>') OR starts_with(x, '---'))::INT) OVER (PARTITION BY id ORDER BY k) AS grp, count(*) FILTER (starts_with(x, '>')) OVER (PARTITION BY id) AS turns FROM l),
g AS (SELECT id, grp, first(x ORDER BY k) AS head, string_agg(x, ' ' ORDER BY k) FILTER (x <> '' AND k > first_k) AS tail FROM (SELECT *, min(k) OVER (PARTITION BY id, grp) AS first_k FROM m WHERE turns >= 3 AND grp > 0) GROUP BY 1, 2),
c AS (SELECT id, grp, head || coalesce(chr(10) || tail, '') AS text FROM g WHERE starts_with(head, '>')),
p AS (SELECT id, grp, i, substr(text, i * 800 + 1, 800) AS content FROM (SELECT *, unnest(range(0, (length(text) - 1) // 800 + 1)) AS i FROM c))
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY grp, i) - 1 AS INT) AS chunk_index, content FROM p WHERE length({_STRIP.format('content')}) > 30""")
def exchange_chunks(s, d):
    rows = t.table(s, d, "conversations")
    line = F.when(F.col("role") == "user", F.concat(F.lit("> "), F.replace("text", F.lit("\n"), F.lit(" ")))).otherwise(F.col("text"))
    docs = rows.groupBy(F.col("conv_id").alias("id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))), lambda x: x["l"]), "\n").alias("text"))
    return text.exchange_chunks(docs)


def _route_sql(table, key, col, keywords):
    score = {k: " + ".join(f"contains(x, '{w}')::INT" for w in ws) for k, ws in keywords.items()}
    most = f"greatest({', '.join(score.values())})"
    case = " ".join(f"WHEN {v} = m THEN '{k}'" for k, v in score.items())
    return f"WITH a AS (SELECT {key} AS id, lower(substr({col}, 1, 3000)) AS x FROM {table}), b AS (SELECT *, {most} AS m FROM a) SELECT id, CASE WHEN m = 0 THEN 'general' {case} END AS tag FROM b"


@query(_route_sql("documents", "doc_id", "text", text.HALLS))
def hall_tag(s, d):
    return t.chunks(s, d).select("id", text.hall("document").alias("tag"))


@query(_route_sql("documents", "doc_id", "text", text.TOPICS))
def convo_room(s, d):
    return t.chunks(s, d).select("id", text.convo_room("document").alias("tag"))


@query(r"""WITH w AS (SELECT doc_id AS id, unnest(regexp_extract_all(substr(text, 1, 5000), '[\p{L}\p{N}_\p{M}]+')) AS w FROM documents),
c AS (SELECT id, w FROM w WHERE regexp_full_match(w, '[A-Z][a-z]{2,19}') AND w NOT IN (""" + ", ".join(f"'{x}'" for x in text.NOT_NAMES) + r""") GROUP BY 1, 2 HAVING count(*) >= 2),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY w) AS k FROM c)
SELECT d.doc_id AS id, coalesce((SELECT string_agg(w, ';' ORDER BY w) FROM r WHERE r.id = d.doc_id AND k <= 25), '') AS entities FROM documents d""")
def entity_tags(s, d):
    return t.chunks(s, d).select("id", text.entity_tags("document").alias("entities"))


_WORD = r"[\p{L}\p{N}_\p{M}]"
_ACTION = rf"(?i)(?:{text.ACTIONS})\s+(?:{_WORD}|\s){{3,40}}"


@query(rf"""WITH c AS (SELECT CAST(doc_id AS VARCHAR) AS source_file, lang, source, substr(text, 1, 5000) AS x FROM documents),
w AS (SELECT source_file, w, count(*) AS n, min(k) AS first FROM (SELECT source_file, unnest(ws) AS w, generate_subscripts(ws, 1) AS k FROM (SELECT source_file, regexp_extract_all(x, '{_WORD}+') AS ws FROM c))
      WHERE regexp_full_match(w, '[A-Z][a-z]{{2,19}}') AND w NOT IN ({", ".join(map(_lit, text.NOT_NAMES))}) GROUP BY 1, 2 HAVING count(*) >= 2),
e AS (SELECT source_file, string_agg(w, ';' ORDER BY n DESC, first) AS entities FROM (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY n DESC, first) AS r FROM w) WHERE r <= 5 GROUP BY 1),
t AS (SELECT *, list_transform(list_concat(regexp_extract_all(x, {_lit(_ACTION)}), regexp_extract_all(x, '(?m)^#{{1,3}}\s+(.{{5,60}})$', 1)), lambda y: lower({_STRIP.format('y')})) AS raw,
      list_transform(regexp_extract_all(x, '"([^"]{{15,150}})"', 1)[:3], lambda q: '"' || q || '"') AS quotes FROM c),
u AS (SELECT *, list_filter(raw, lambda y, i: list_position(raw, y) = i)[:12] AS topics FROM t),
h AS (SELECT *, CASE WHEN len(topics) + len(quotes) > 0 THEN list_concat(topics, quotes) ELSE [concat_ws('/', lang, source, source_file)] END AS heads FROM u)
SELECT h.source_file, CAST(generate_subscripts(heads, 1) - 1 AS INT) AS line_no, unnest(heads) || '|' || coalesce(entities, '') || '|→' || h.source_file AS line FROM h LEFT JOIN e USING (source_file)""")
def index_lines(s, d):
    c = t.chunks(s, d).select(F.col("id").cast("string").alias("source_file"), F.col("document").alias("content"), "wing", "room", F.array(F.col("id").cast("string")).alias("chunk_ids"))
    return text.index_lines(c)


@query(f"""WITH RECURSIVE l AS ({ORACLE_SQL['index_lines']}), n AS (SELECT *, length(line) + 1 AS n FROM l),
p(source_file, line_no, line, used, pack) AS (SELECT source_file, line_no, line, n, 1 FROM n WHERE line_no = 0 UNION ALL
  SELECT n.source_file, n.line_no, n.line, CASE WHEN used + n.n > 1500 THEN n.n ELSE used + n.n END, CASE WHEN used + n.n > 1500 THEN pack + 1 ELSE pack END FROM p JOIN n ON n.source_file = p.source_file AND n.line_no = p.line_no + 1)
SELECT source_file, line_no, line, CAST(pack AS INT) AS pack_no FROM p""")
def index_packs(s, d):
    return quality.greedy_pack(index_lines(s, d))


@query("SELECT doc_id AS id, " + " + ".join(f"len(regexp_extract_all(lower(text), '{m.replace(chr(39), chr(39) * 2)}'))" for m in memories.MARKERS["decision"]) + " AS score FROM documents")
def decision_scores(s, d):
    return t.chunks(s, d).select("id", memories.score(F.col("document"), "decision").cast("long").alias("score"))


_NOTES = "SELECT o_orderkey AS id, replace([" + ", ".join("E" + _lit(x.replace("\n", "\\n")) for x in t.NOTES) + f"][o_orderkey % {len(t.NOTES)} + 1], '{{}}', o_orderpriority) AS text FROM orders"


def _memory_sql() -> str:
    turn = rf"[^\S\n]*(?:{'|'.join(memories.TURNS)})"
    kinds = list(memories.MARKERS)
    count = {k: " + ".join(f"len(regexp_extract_all(low, {_lit(m)}))" for m in ms) for k, ms in memories.MARKERS.items()}
    mood = lambda names: f"len(list_intersect(words, [{', '.join(map(_lit, names))}]))"
    code = " OR ".join(f"regexp_matches({_STRIP.format('y')}, {_lit(c)})" for c in memories.CODE)
    few = rf"(len(regexp_extract_all({_STRIP.format('y')}, '\p{{L}}')) / greatest(length({_STRIP.format('y')}), 1) < {memories.CODE_LETTERS} AND length({_STRIP.format('y')}) > {memories.CODE_CHARS})"
    paras = f"list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: {_STRIP.format('x')}), lambda x: x <> '')"
    groups = f"list_filter(list_transform(range(0, len(lines), 25), lambda i: {_STRIP.format('array_to_string(lines[i + 1:i + 25], chr(10))')}), lambda x: x <> '')"
    first = " ".join(f"WHEN {k} = most THEN '{k}'" for k in kinds)
    return rf"""WITH n AS ({_NOTES}), l AS (SELECT *, string_split(text, chr(10)) AS lines, {paras} AS paras FROM n),
s AS (SELECT id, CASE WHEN len(regexp_extract_all(text, {_lit('(?m)^' + turn)})) >= 3 THEN string_split(regexp_replace(text, {_lit(chr(92) + 'n(' + turn + ')')}, chr(1) || '\1', 'g'), chr(1))
      WHEN len(paras) <= 1 AND len(lines) > 20 THEN {groups} ELSE paras END AS parts FROM l),
p AS (SELECT id, unnest(parts) AS content, generate_subscripts(parts, 1) - 1 AS segment FROM s),
o AS (SELECT *, {_STRIP.format(r"array_to_string(list_filter(string_split(array_to_string(list_filter(string_split_regex(content, '(?m)^[^\S\n]*```[^\n]*(?:\n|\z)'), lambda x, i: i % 2 = 1), ''), chr(10)), lambda y: NOT (" + code + " OR " + few + ")), chr(10))")} AS kept FROM p),
q AS (SELECT *, lower(CASE WHEN kept <> '' THEN kept ELSE content END) AS low FROM o), w AS (SELECT *, list_distinct(regexp_extract_all(low, '\w+')) AS words FROM q),
c AS (SELECT id, segment, content, low, {mood(memories.POSITIVE)} - {mood(memories.NEGATIVE)} AS mood, {', '.join(f'{v} AS {k}' for k, v in count.items())} FROM w),
m AS (SELECT *, greatest({', '.join(kinds)}) AS most, ({' OR '.join(f'regexp_matches(low, {_lit(x)})' for x in memories.RESOLVED)}) AS solved FROM c),
f AS (SELECT *, CASE WHEN most = 0 THEN NULL {first} END AS first, least(1.0, (most + CASE WHEN length(content) > 500 THEN 2 WHEN length(content) > 200 THEN 1 ELSE 0 END) / 5.0) AS confidence FROM m)
SELECT id, CAST(segment AS INT) AS segment, {_STRIP.format('content')} AS content, CAST(confidence AS DOUBLE) AS confidence,
CASE WHEN first = 'problem' AND solved AND emotional > 0 AND mood > 0 THEN 'emotional' WHEN first = 'problem' AND solved THEN 'milestone' WHEN first = 'problem' AND mood > 0 AND milestone > 0 THEN 'milestone'
     WHEN first = 'problem' AND mood > 0 AND emotional > 0 THEN 'emotional' ELSE first END AS memory_type
FROM f WHERE first IS NOT NULL AND confidence >= 0.3 AND length({_STRIP.format('content')}) >= 20"""


@query(_memory_sql())
def memory_types(s, d):
    return memories.extract(t.notes(s, d)).select("id", "segment", "content", "confidence", "memory_type")


@query(r"SELECT doc_id AS id, CAST(floor(len(regexp_extract_all(text, '\S+')) * 1.3) AS INT) AS tokens FROM documents")
def token_estimate(s, d):
    return t.chunks(s, d).select("id", text.token_estimate("document").alias("tokens"))


@query(r"SELECT conv_id AS session_id, md5(string_agg(CASE WHEN role = 'user' THEN '> ' || text ELSE text END, chr(10) ORDER BY turn)) AS transcript FROM conversations WHERE role IN ('user', 'assistant') GROUP BY 1")
def transcript_render(s, d):
    from lodestore.sources.transcripts import rendered

    return rendered(t.messages(s, d)).select("session_id", F.md5(F.col("transcript").cast("binary")).alias("transcript"))


@query("""WITH r AS (SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn) <> role, true)::INT AS new FROM conversations),
g AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS run FROM r)
SELECT conv_id AS session_id, role, CAST(run AS BIGINT) AS run, count(*) AS n FROM g GROUP BY ALL""")
def merged_runs(s, d):
    from lodestore.sources.transcripts import merged

    return merged(t.messages(s, d)).select("session_id", "role", "run", "n")


_TOOL = "['Bash', 'Read', 'Grep', 'Glob', 'Edit', 'Write', 'Other'][doc_id % 7 + 1]"


@query(f"""WITH c AS (SELECT doc_id AS id, {_TOOL} AS tool, repeat('run ', CAST(doc_id % 80 AS INT)) AS command, '/f/' || doc_id AS path, doc_id % 2 = 0 AS even FROM documents)
SELECT id, CASE tool WHEN 'Bash' THEN '[Bash] ' || CASE WHEN length(command) > 200 THEN substr(command, 1, 200) || '...' ELSE command END
WHEN 'Read' THEN '[Read ' || path || CASE WHEN even THEN ':10-' || (10 + id) ELSE '' END || ']' WHEN 'Grep' THEN '[Grep] x+ in ' || CASE WHEN even THEN path ELSE '*.py' END WHEN 'Glob' THEN '[Glob] x+'
WHEN 'Other' THEN '[Other] ' || CASE WHEN length(j) > 200 THEN substr(j, 1, 200) || '...' ELSE j END ELSE '[' || tool || ' ' || path || ']' END AS line
FROM (SELECT *, '{{"command":"' || command || '"}}' AS j FROM c)""")
def tool_calls(s, d):
    c = t.chunks(s, d).select("id", F.element_at(F.array(*[F.lit(x) for x in ("Bash", "Read", "Grep", "Glob", "Edit", "Write", "Other")]), (F.col("id") % 7 + 1).cast("int")).alias("tool"))
    i, path, even = F.col("id").cast("string"), F.concat(F.lit('"/f/'), F.col("id").cast("string"), F.lit('"')), F.col("id") % 2 == 0
    command = F.concat(F.lit('{"command":"'), F.repeat(F.lit("run "), (F.col("id") % 80).cast("int")), F.lit('"}'))
    span = F.when(even, F.concat(F.lit(',"offset":10,"limit":'), i)).otherwise(F.lit(""))
    where = F.when(even, F.concat(F.lit(',"path":'), path)).otherwise(F.lit(',"path":"","glob":"*.py"'))
    asked = F.when(F.col("tool").isin("Bash", "Other"), command).when(F.col("tool").isin("Grep", "Glob"), F.concat(F.lit('{"pattern":"x+"'), where, F.lit("}"))).otherwise(F.concat(F.lit('{"file_path":'), path, span, F.lit("}")))
    return c.select("id", tools.call(F.col("tool"), asked).alias("line"))


@query(f"""WITH c AS (SELECT doc_id AS id, {_TOOL} AS tool, CASE WHEN doc_id % 7 = 6 THEN text ELSE array_to_string(list_transform(range(0, doc_id % 60), lambda i: 'row ' || i), chr(10)) END AS raw FROM documents),
l AS (SELECT *, {_STRIP.format('raw')} AS x FROM c), n AS (SELECT *, string_split(x, chr(10)) AS ls FROM l), a AS (SELECT *, len(ls) AS n FROM n)
SELECT id, md5(CASE WHEN x = '' OR tool IN ('Read', 'Edit', 'Write') THEN '' WHEN tool = 'Bash' AND n > 40 THEN '→ ' || array_to_string(ls[:20], E'\\n→ ') || E'\\n→ ' || '... [' || (n - 40) || ' lines omitted] ...' || E'\\n→ ' || array_to_string(ls[n - 19:], E'\\n→ ')
WHEN tool IN ('Grep', 'Glob') AND n > 20 THEN '→ ' || array_to_string(ls[:20], E'\\n→ ') || E'\\n→ ' || '... [' || (n - 20) || ' more matches]' WHEN tool IN ('Bash', 'Grep', 'Glob') THEN '→ ' || array_to_string(ls, E'\\n→ ')
WHEN length(x) > 2048 THEN '→ ' || substr(x, 1, 2048) || '... [truncated, ' || length(x) || ' chars]' ELSE '→ ' || x END) AS line FROM a""")
def tool_results(s, d):
    c = t.chunks(s, d).withColumn("tool", F.element_at(F.array(*[F.lit(x) for x in ("Bash", "Read", "Grep", "Glob", "Edit", "Write", "Other")]), (F.col("id") % 7 + 1).cast("int")))
    rows = F.expr("array_join(transform(slice(sequence(0, 59), 1, CAST(id % 60 AS INT)), i -> concat('row ', i)), '\n')")
    raw = F.when(F.col("tool") == "Other", F.col("document")).otherwise(rows)
    return c.select("id", F.md5(tools.result(F.col("tool"), raw).cast("binary")).alias("line"))


# --- measures

_REL = "SELECT item_id AS query_id, doc_id AS id FROM benchmark b JOIN documents d ON contains(d.text, b.text)"


def _relevant(s, d):
    return search.containing(t.chunks(s, d), t.queries(s, d))


@query(_REL)
def planted_passages(s, d):
    return _relevant(s, d)


@query(_bm25_sql("1.5::DOUBLE") + f""", v AS ({_REL}), pq AS (SELECT query_id, count(*) AS want, count(*) FILTER (rank <= 1) AS g1, count(*) FILTER (rank <= 5) AS g5 FROM v LEFT JOIN r USING (query_id, id) GROUP BY 1),
x AS (SELECT want, 1 AS k, g1 AS got FROM pq UNION ALL SELECT want, 5, g5 FROM pq)
SELECT CAST(k AS INT) AS k, round(avg((got > 0)::INT), 6) AS recall_any, round(avg((got = want)::INT), 6) AS recall_all FROM x GROUP BY k""")
def recall_at_k(s, d):
    m = metrics.recall_at(_bm25_top(s, d, 5), _relevant(s, d), [1, 5])
    return m.select("k", F.round("recall_any", 6).alias("recall_any"), F.round("recall_all", 6).alias("recall_all"))


@query(_bm25_sql("1.5::DOUBLE") + f""", v AS ({_REL}), h AS (SELECT r.query_id, r.rank, CASE WHEN v.id IS NULL THEN 0.0 ELSE 1.0 END AS rel FROM r LEFT JOIN v USING (query_id, id) WHERE rank <= 5),
i AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rel DESC, rank) AS ideal FROM h)
SELECT query_id, round(coalesce(sum(rel / log2(rank + 1)) / nullif(sum(rel / log2(ideal + 1)), 0), 0), 6) AS ndcg FROM i GROUP BY 1""")
def ndcg_at_k(s, d):
    return metrics.ndcg_at(_bm25_top(s, d, 5), _relevant(s, d), 5).select("query_id", F.round("ndcg", 6).alias("ndcg"))


@query(r"""WITH p AS (SELECT conv_id * 1000 + turn AS id, text AS a, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations),
x AS (SELECT id, w, count(*) AS n FROM (SELECT id, unnest(regexp_extract_all(lower(a), '[a-z0-9]+')) AS w FROM p WHERE b IS NOT NULL) GROUP BY 1, 2),
y AS (SELECT id, w, count(*) AS n FROM (SELECT id, unnest(regexp_extract_all(lower(b), '[a-z0-9]+')) AS w FROM p WHERE b IS NOT NULL) GROUP BY 1, 2),
z AS (SELECT id, sum(least(coalesce(x.n, 0), coalesce(y.n, 0))) AS k, sum(coalesce(x.n, 0)) + sum(coalesce(y.n, 0)) AS t FROM x FULL JOIN y USING (id, w) GROUP BY 1)
SELECT p.id, round(coalesce(2.0 * k / nullif(t, 0), 0), 6) AS f1 FROM p LEFT JOIN z USING (id) WHERE b IS NOT NULL""")
def token_f1(s, d):
    c = t.table(s, d, "conversations")
    pairs = c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("predicted"), F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn")).alias("expected"))
    return metrics.token_f1(pairs.where("expected IS NOT NULL")).select("id", F.round("f1", 6).alias("f1"))


@query("SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY 1")
def latency_percentiles(s, d):
    m = metrics.latency(t.table(s, d, "events"), ["event_type"], "value")
    return m.select("event_type", *[F.round(p, 6).alias(p) for p in ("p50", "p95", "p99")])


@query("""SELECT l_returnflag AS metric FROM (SELECT l_returnflag, sum(l_quantity) AS a, sum(l_quantity * (1 - l_discount) * CASE WHEN l_returnflag = 'R' THEN 0.5 ELSE 1 END) AS b FROM lineitem GROUP BY 1) WHERE (b - a) / abs(a) < -0.2""")
def metric_regressions(s, d):
    li = t.table(s, d, "lineitem")
    old = li.groupBy(F.col("l_returnflag").alias("metric")).agg(F.sum("l_quantity").alias("value"))
    new = li.groupBy(F.col("l_returnflag").alias("metric")).agg(F.sum(F.col("l_quantity") * (1 - F.col("l_discount")) * F.when(F.col("l_returnflag") == "R", 0.5).otherwise(1.0)).alias("value"))
    return metrics.regressions(old, new.withColumn("higher_is_better", F.lit(True))).select("metric")
