"""Queries of the full-text index, spelling, the registry of names and locale patterns, with their SQL; they join the catalogue's."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestore import scratch
from lodestore.functions import analyze, registry, spelling, zettel
from lodestore.operators import textindex
from lodestore.plans import tables as t
from lodestore.plans.catalogue import query
from lodestore.sources import locales, rooms

# --- full-text index


def _words_sql(text: str) -> str:
    out = f"strip_accents(lower(coalesce({text}, '')))"
    for a, b in analyze.FOLDS.items():
        out = f"replace({out}, '{a}', '{b}')"
    return rf"regexp_extract_all({out}, '\p{{L}}+|\p{{N}}+')"


def _search_sql(asked: str, every: bool) -> str:
    """s: query_id, id, score by full scoring. asked: SQL of the query texts."""
    return f"""WITH dw AS (SELECT doc_id AS id, unnest({_words_sql('text')}) AS word FROM documents),
qw AS (SELECT DISTINCT query_id, unnest({_words_sql('query')}) AS word FROM ({asked})),
vocabulary AS (SELECT word FROM dw UNION SELECT word FROM qw),
{analyze.stem_sql('vocabulary')},
n AS (SELECT count(*)::DOUBLE AS n FROM documents), l AS (SELECT id, count(*)::DOUBLE AS length FROM dw GROUP BY 1),
m AS (SELECT greatest(sum(length) / (SELECT n FROM n), 1) AS mean FROM l),
q AS (SELECT DISTINCT query_id, stem FROM qw JOIN stems USING (word)), wanted AS (SELECT query_id, count(*) AS wanted FROM q GROUP BY 1),
tf AS (SELECT stem, id, count(*)::DOUBLE AS tf FROM dw JOIN stems USING (word) WHERE stem IN (SELECT stem FROM q) GROUP BY 1, 2),
df AS (SELECT stem, count(*)::DOUBLE AS df FROM tf GROUP BY 1),
s AS (SELECT query_id, id, sum(ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / mean))) AS score
      FROM tf JOIN df USING (stem) JOIN q USING (stem) JOIN l USING (id) JOIN wanted USING (query_id), n, m GROUP BY 1, 2{' HAVING count(*) = any_value(wanted)' if every else ''}),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id) AS rank FROM s)
SELECT query_id, id, round(1 / (1 + score), 6) AS distance, CAST(rank AS INT) AS rank FROM r WHERE rank <= 10"""


def _found(s, d, asked, every):
    hits = textindex.search(textindex.build(t.chunks(s, d)), asked, 10, every)
    return hits.select("query_id", "id", F.round(textindex.pseudo_distance(F.col("score")), 6).alias("distance"), "rank")


@query(f"WITH w AS (SELECT doc_id, unnest({_words_sql('text')}) AS word FROM documents), {analyze.stem_sql('w')} SELECT stem, count(*) AS words, min(word) AS least FROM stems GROUP BY 1")
def text_stems(s, d):
    """How many distinct words of all documents each stem stands for."""
    words = t.chunks(s, d).select(F.explode(analyze.words("document")).alias("word")).distinct()
    return analyze.stemmed(words).groupBy("stem").agg(F.count(F.lit(1)).alias("words"), F.min("word").alias("least"))


@query(_search_sql("SELECT item_id AS query_id, text AS query FROM benchmark", False))
def fulltext_any(s, d):
    """The best ten documents for each benchmark passage, with any of its words."""
    return _found(s, d, t.queries(s, d), False)


_FEW = "SELECT item_id AS query_id, array_to_string(string_split(text, ' ')[2:4], ' ') AS query FROM benchmark"


@query(_search_sql(_FEW, True))
def fulltext_search(s, d):
    """The best ten documents with all of the second to fourth words of each benchmark passage."""
    asked = t.queries(s, d).select("query_id", F.array_join(F.slice(F.split("query", " "), 2, 3), " ").alias("query"))
    return _found(s, d, asked, True)


@query()
def fulltext_blocks(s, d):
    """What the search of all benchmark passages reads: blocks and postings of each query's terms, and how many of them."""
    plan, _ = textindex.plan(textindex.build(t.chunks(s, d)), t.queries(s, d), 10)
    read = F.col("read").cast("int")
    return plan.groupBy("query_id").agg(F.count(F.lit(1)).alias("blocks"), F.sum(read).alias("blocks_read"), F.sum("postings").alias("postings"), F.sum(F.col("postings") * read).alias("postings_read"))


# --- spelling

#: A word is in the dictionary of the queries if the documents hold it so often.
OFTEN = 50
_ENDING = spelling.ENDING.replace("'", "''")
_CHECKABLE = f"length(word) >= {spelling.LEAST} AND " + " AND ".join(f"NOT regexp_matches(word, '{p}')" for p in spelling.LEFT_ALONE)
# the engine's distance counts bytes, so letters of two bytes are written as one
_ONE_BYTE = "translate({}, 'àáâäçèéêëìíîïñòóôöùúûüœß', 'ABCDEFGHIJKLMNOPQRSTUVWX')"
_FIXES_SQL = rf"""WITH tokens AS (SELECT doc_id, unnest(regexp_extract_all(text, '\s+|\S+')) AS token, generate_subscripts(regexp_extract_all(text, '\s+|\S+'), 1) AS place FROM documents),
split AS (SELECT *, regexp_replace(token, '{_ENDING}', '') AS word FROM tokens),
words AS (SELECT word, count(*) AS n FROM split WHERE {_CHECKABLE} GROUP BY 1),
dictionary AS (SELECT lower(word) AS fix, sum(n) AS n FROM words GROUP BY 1 HAVING sum(n) >= {OFTEN}),
near AS (SELECT w.word, fix, d.n, levenshtein({_ONE_BYTE.format('w.word')}, {_ONE_BYTE.format('fix')}) AS distance FROM words w JOIN dictionary d ON abs(length(w.word) - length(fix)) <= 2 WHERE lower(w.word) NOT IN (SELECT fix FROM dictionary)),
fixes AS (SELECT word, fix, CAST(distance AS INT) AS distance FROM near WHERE distance <= 2 QUALIFY row_number() OVER (PARTITION BY word ORDER BY distance, n DESC, fix) = 1)
"""


def _dictionary(s, d):
    words = spelling.words_of(t.chunks(s, d))
    return words, spelling.frequent(words, OFTEN)


@query(_FIXES_SQL + "SELECT * FROM fixes")
def spell_fixes(s, d):
    """What each distinct word of the documents that isn't frequent would be corrected to."""
    return spelling.fixes(*_dictionary(s, d))


@query(_FIXES_SQL + """SELECT doc_id AS id, md5(string_agg(CASE WHEN fix IS NULL THEN token ELSE fix || substr(token, length(s.word) + 1) END, '' ORDER BY place)) AS corrected, count(fix) AS changed
FROM split s LEFT JOIN fixes USING (word) GROUP BY 1""")
def spell_corrected(s, d):
    """Every document corrected, and how many of its words changed."""
    chunks = t.chunks(s, d).select("id", "document")
    rows = spelling.corrected(chunks, _dictionary(s, d)[1])
    words = lambda c: F.regexp_extract_all(c, F.lit(spelling.TOKENS), F.lit(0))
    changed = F.size(F.filter(F.zip_with(words(F.col("document")), words(F.col("corrected")), lambda a, b: a != b), lambda x: x)).cast("long")
    return rows.select("id", F.md5("corrected").alias("corrected"), changed.alias("changed"))


# --- the registry of names

#: A capitalised word is in the queries' registry if the documents hold it so often; in lower case, so often, it is a common word too.
NAMED = 300


def _entries(s, d):
    """People: capitalised words of the documents. Those that stand in lower case as often are ambiguous."""
    words = t.chunks(s, d).select(F.explode(F.regexp_extract_all("document", F.lit(r"(?U)\b[A-Za-z]{3,}\b"), F.lit(0))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    often = scratch.written(words.where(F.col("n") >= NAMED), f"{scratch.folder(s)}/often")  # or the texts would be read for each kind of word
    none = F.array().cast("array<string>")
    names = often.where(F.regexp_like("word", F.lit("^[A-Z][a-z]+$")))
    rows = names.select(F.col("word").alias("name"), F.lit("person").alias("type"), F.lit("learned").alias("source"), F.lit(0.9).alias("confidence"), none.alias("aliases"), F.array(F.lit("personal")).alias("contexts"), F.col("n").alias("seen_count"))
    common = [r.word for r in often.where(F.regexp_like("word", F.lit("^[a-z]+$"))).select("word").collect()]  # no more than the texts' words over NAMED
    return rows, common


def _pattern_sql(patterns):
    """How many of the patterns a line has around a name, with borders that know letters beyond ASCII."""
    edge = "[^a-z0-9_ß-ÿœ]"  # the letters of the tables: classes of all letters are slow to compile for each row
    out = []
    for p in patterns:
        body = p.removeprefix(r"\b").removesuffix(r"\b")
        before = f"(^|{edge})" if p.startswith(r"\b") else ""
        after = f"({edge}|$)" if p.endswith(r"\b") else ""
        left, right = body.replace("'", "''").split("{name}")
        out.append(f"CAST(regexp_matches(low, '{before}{left}' || word || '{right}{after}') AS INT)")
    return " + ".join(out)


@query(rf"""WITH w AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[\p{{L}}\p{{M}}\p{{N}}_]+')) AS word FROM documents) WHERE regexp_matches(word, '^[A-Za-z]{{3,}}$') GROUP BY 1 HAVING count(*) >= {NAMED}),
names AS (SELECT word AS name, lower(word) AS alias FROM w WHERE regexp_matches(word, '^[A-Z][a-z]+$')), common AS (SELECT word FROM w WHERE regexp_matches(word, '^[a-z]+$')),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS nr FROM documents),
m AS (SELECT doc_id, nr, lower(line) AS low, unnest(regexp_extract_all(line, '[\p{{L}}\p{{M}}\p{{N}}_]+')) AS said FROM lines),
h AS (SELECT doc_id, nr, low, said, alias AS word, name FROM m JOIN names ON lower(said) = alias),
v AS (SELECT low, word, {_pattern_sql(registry.PERSON_CONTEXTS)} AS p, {_pattern_sql(registry.CONCEPT_CONTEXTS)} AS c FROM (SELECT DISTINCT low, word FROM h WHERE word IN (SELECT word FROM common))),
x AS (SELECT doc_id, nr, said, name, coalesce(p, 0) AS p, coalesce(c, 0) AS c FROM h LEFT JOIN v USING (low, word))
SELECT doc_id AS id, CAST(nr AS INT) AS line, said AS word, name AS canonical, CASE WHEN c > p THEN 'concept' ELSE 'person' END AS type,
       round(CASE WHEN p > c THEN least(0.95, 0.7 + p * 0.1) WHEN c > p THEN least(0.90, 0.7 + c * 0.1) ELSE 0.9 END, 6)::DOUBLE AS confidence, CAST(p AS INT) AS person_votes, CAST(c AS INT) AS concept_votes, count(*) AS n
FROM x GROUP BY ALL""")
def registry_mentions(s, d):
    """Mentions of the documents' frequent capitalised words: type, confidence and votes by the line; equal ones of a line are counted."""
    entries, common = _entries(s, d)
    m = registry.mentions(t.chunks(s, d), entries, common=common)
    return m.groupBy("id", "line", "word", "canonical", "type", "confidence", "person_votes", "concept_votes").agg(F.count(F.lit(1)).alias("n"))


# --- names by language


def _by_lang_sql(part: int) -> str:
    quoted = lambda v: f"'^({v})$'" if isinstance(v, str) else "[" + ", ".join(f"'{x}'" for x in v) + "]"
    return "CASE lang " + " ".join(f"WHEN '{k}' THEN {quoted(v[part])}" for k, v in locales.WORDS.items()) + f" ELSE {quoted(locales.WORDS['en'][part])} END"


@query(rf"""WITH w AS (SELECT doc_id AS id, CASE WHEN lower(lang) IN ({", ".join(repr(x) for x in locales.WORDS)}) THEN lower(lang) ELSE 'en' END AS lang, unnest(regexp_extract_all(text, '[\p{{L}}\p{{M}}\p{{N}}_]+')) AS name FROM documents)
SELECT id, lang, name, count(*) AS frequency FROM w WHERE regexp_matches(name, {_by_lang_sql(0)}) AND NOT list_contains({_by_lang_sql(2)}, lower(name)) GROUP BY ALL HAVING count(*) >= 3""")
def locale_names(s, d):
    """Capitalised words of every document by the patterns of its language."""
    docs = t.table(s, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("document"), "lang")
    return locales.names(docs, locales.built_in(s), phrases=False)


# --- lines of notes

_TELLING = " + ".join(f"contains(lower(q), '{w}')::INT" for w in zettel.TELLING)
_FOUND = ", ".join("regexp_extract_all(text, '" + p.replace("'", "''") + "', 1)" for p in zettel.QUOTES)
_TONES = ["joy", "anger", "raw_grief", "weary", "hopelessness"]


@query(rf"""WITH n AS (SELECT conv_id, turn, text, role, regexp_extract_all(text, '[a-z]{{4,}}')[1:2] AS topics, (turn % 10) / 10.0 AS weight FROM conversations),
q AS (SELECT conv_id, turn, q, i FROM (SELECT conv_id, turn, unnest(f) AS raw, generate_subscripts(f, 1) AS i FROM (SELECT conv_id, turn, list_concat(list_concat({_FOUND.split(", regexp", 1)[0]}, regexp{_FOUND.split(", regexp", 1)[1].rsplit(", regexp", 1)[0]}), regexp{_FOUND.rsplit(", regexp", 1)[1]}) AS f FROM n)), LATERAL (SELECT regexp_replace(raw, '^\s+|\s+$', '', 'g') AS q) WHERE length(q) >= 8),
b AS (SELECT conv_id, turn, arg_max(q, (CASE WHEN regexp_matches(q, '^\p{{Lu}}') THEN 2 ELSE 0 END - CASE WHEN regexp_matches(q, '^(The|This|She) ') THEN 2 ELSE 0 END + 2 * ({_TELLING}) + CASE WHEN length(q) > 20 THEN 1 ELSE 0 END) * 1000000 - i) AS quote FROM q GROUP BY 1, 2)
SELECT conv_id, turn, md5(turn || ':' || upper(substr(role, 1, 3)) || '|' || CASE WHEN len(topics) = 0 THEN 'misc' ELSE array_to_string(topics, '_') END || coalesce('|"' || quote || '"', '') || '|' || CAST(weight AS DOUBLE) || '|'
  || ['joy', 'rage', 'grief', 'wear', 'despair'][1 + turn % 5] || CASE WHEN turn = 0 THEN '|ORIGIN' ELSE '' END) AS line, true AS again
FROM n LEFT JOIN b USING (conv_id, turn)""")
def zettel_lines(s, d):
    """Every turn of the conversations as a note's line, and whether the line comes back from its fields."""
    c = t.table(s, d, "conversations")
    tone = F.element_at(F.array(*[F.lit(x) for x in _TONES]), (F.col("turn") % 5 + 1).cast("int"))
    topics = F.slice(F.regexp_extract_all("text", F.lit("[a-z]{4,}"), F.lit(0)), 1, 2)
    none = F.lit(None).cast("string")
    z = F.struct(
        F.concat(F.lit("z-"), F.col("turn").cast("string")).alias("id"), F.array("role").alias("people"), topics.alias("topics"), none.alias("title"), F.col("text").alias("content"), none.alias("origin_label"), none.alias("notes"),
        ((F.col("turn") % 10) / 10).alias("emotional_weight"), F.array(tone).alias("emotional_tone"), (F.col("turn") == 0).alias("origin_moment"), none.alias("sensitivity"), none.alias("date_context"),
    )
    rows = c.select("conv_id", "turn", z.alias("z")).select("conv_id", "turn", zettel.encoded(F.col("z")).alias("said"))
    return rows.select("conv_id", "turn", F.md5("said").alias("line"), F.coalesce(zettel.line(zettel.parsed(F.col("said"))) == F.col("said"), F.lit(False)).alias("again"))


# --- rooms of projects

_KNOWN = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in rooms.ROOMS.items()) + "}"
_SKIPPED = ", ".join(f"'{x}'" for x in rooms.SKIPPED)


@query(rf"""WITH f AS (SELECT regexp_extract(url, '^[^:]*://[^/?#]*/([^/?#]*)', 1) AS project, list_filter(string_split(replace(regexp_extract(url, '^[^:]*://([^/?#]*)', 1), '.', '/') || regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS parts FROM pages),
d AS (SELECT DISTINCT project, 1 AS level, parts[1] AS folder FROM f WHERE len(parts) > 1 UNION SELECT DISTINCT project, 2, parts[2] FROM f WHERE len(parts) > 2 AND parts[1] NOT IN ({_SKIPPED})),
g AS (SELECT project, level, folder, coalesce({_KNOWN}[replace(lower(folder), '-', '_')], CASE WHEN level = 1 AND length(folder) > 2 AND regexp_matches(folder, '^\p{{L}}') THEN replace(replace(lower(folder), '-', '_'), ' ', '_') END) AS name FROM d WHERE folder NOT IN ({_SKIPPED})),
r AS (SELECT project, name, arg_min(folder, level || folder) AS folder FROM g WHERE name IS NOT NULL GROUP BY 1, 2)
SELECT project, name, 'Files from ' || folder || '/' AS description, name || ',' || lower(folder) AS keywords FROM r
UNION ALL SELECT DISTINCT project, 'general', CASE WHEN project IN (SELECT project FROM r) THEN 'Files that don''t fit other rooms' ELSE 'All project files' END, '' FROM f WHERE project NOT IN (SELECT project FROM r WHERE name = 'general')""")
def folder_rooms(s, d):
    """Rooms of the pages' sections: a section is a project, whose files lie under the labels of their hosts."""
    url = F.col("url")
    path = F.concat(F.replace(F.regexp_extract(url, "^[^:]*://([^/?#]*)", 1), F.lit("."), F.lit("/")), F.regexp_extract(url, "^[^:]*://[^/?#]*([^?#]*)", 1))
    files = t.table(s, d, "pages").select(F.regexp_extract(url, "^[^:]*://[^/?#]*/([^/?#]*)", 1).alias("project"), path.alias("path"))
    return rooms.detect(files).withColumn("keywords", F.array_join("keywords", ","))
