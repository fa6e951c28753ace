"""The registry: look-up, votes in columns and in the pass over texts, mentions, learning."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from lodestore.functions import registry


@pytest.fixture(scope="module")
def entries(spark):
    people = spark.createDataFrame([("Riley", "personal"), ("Max", None), ("Maxwell", "work"), ("Ever", "personal"), (" ", "x"), ("Riley", "personal")], "name string, context string")
    projects = spark.createDataFrame([("Acme",), ("max",)], "name string")
    return registry.seeded(people, projects, {"Maxie": "Maxwell", "Mike D.": "Riley"})


def plain_votes(word, context):
    return [sum(bool(re.search(p.replace("{name}", re.escape(word.lower())), context.lower())) for p in kind) for kind in (registry.PERSON_CONTEXTS, registry.CONCEPT_CONTEXTS)]


CONTEXTS = [
    "Have you ever tried it?", "I went out with Ever today", "Ever said hello. Ever laughed.", "if you ever, ever since, not ever", "my friend Ever was there", "ever: hi", "Ever's bike and ever of", "the ever of it", "", None,
    "called ever again", "éver said", "hey ever\nthanks ever", "drop off ever", "dropped ever picked up ever",
]


def test_votes_equal_plain_patterns(spark):
    rows = spark.createDataFrame([(c,) for c in CONTEXTS if c is not None], "c string")
    got = {r.c: [r.p, r.q] for r in rows.select("c", registry.votes(F.lit("Ever"), F.col("c"), registry.PERSON_CONTEXTS).alias("p"), registry.votes(F.lit("Ever"), F.col("c"), registry.CONCEPT_CONTEXTS).alias("q")).collect()}
    assert got == {c: plain_votes("Ever", c) for c in CONTEXTS if c is not None}
    odd = rows.limit(1).select(registry.votes(F.lit(r"a\E.b"), F.lit(r"a\E.b said"), registry.PERSON_CONTEXTS).alias("p")).first()
    assert odd.p == 2


def test_lookup(spark, entries):
    words = [("riley", ""), ("MAXIE", ""), ("max", "went with Max"), ("acme", ""), ("Sam", ""), ("Nobody", "x"), (None, "x"), *[("Ever", c) for c in CONTEXTS]]
    confirmed = spark.createDataFrame([("sam", "person", 0.9), ("riley", "concept", 0.5)], "word string, type string, confidence double")
    df = spark.createDataFrame([(i, w, c, "e") for i, (w, c) in enumerate(words)], "i int, word string, context string, entry string").drop("entry")
    got = {r.i: r for r in registry.lookup(df, entries, confirmed).collect()}
    short = lambda r: (r.type, r["name"], r.source, r.confidence, r.decided)
    assert [short(got[i]) for i in range(7)] == [
        ("person", "Riley", "onboarding", 1.0, False), ("person", "Maxwell", "onboarding", 1.0, False), ("person", "max", "onboarding", 0.8, True), ("project", "Acme", "onboarding", 1.0, False),
        ("person", "Sam", "wiki", 0.9, False), ("unknown", "Nobody", "none", 0.0, False), ("unknown", None, "none", 0.0, False),
    ]
    for i, c in enumerate(CONTEXTS, 7):
        p, q = plain_votes("Ever", c or "")
        expected = ("person", min(0.95, 0.7 + p * 0.1)) if p > q else ("concept", min(0.9, 0.7 + q * 0.1)) if q > p else ("person", 1.0)
        assert (got[i].type, got[i].confidence) == (expected[0], pytest.approx(expected[1])), c
        assert got[i].decided == (p != q)
    assert registry.lookup(df.limit(0), entries).count() == 0
    assert {r.type for r in registry.lookup(df, entries.limit(0)).collect()} == {"unknown"}


def test_mentions_equal_a_plain_search(spark, entries):
    texts = ["Riley met MAXIE and Mike D. today.\nForever Ever, ever since; Ever_x xRiley Rileys", "İstanbul with Max, Max told Acme", None, "", "no one", "my friend Ever was there\nhave you ever?"] * 2
    docs = spark.createDataFrame([(i, t, "w") for i, t in enumerate(texts)], "id int, document string, word string")
    got = sorted((r.id, r.line, r["at"], r.word, r.canonical, r.type, r.person_votes, r.concept_votes) for r in registry.mentions(docs, entries).collect())
    aliases = {"riley": "Riley", "mike d.": "Riley", "max": "Max", "maxwell": "Maxwell", "maxie": "Maxwell", "ever": "Ever", "acme": "Acme"}
    expected = []
    for i, t in enumerate(texts):
        for n, line in enumerate((t or "").split("\n")):
            for a, name in aliases.items():
                for m in re.finditer(rf"(?<!\w){re.escape(a)}" + (r"(?!\w)" if a[-1].isalnum() else ""), line, re.I):
                    p, q = plain_votes(a, line) if a in registry.COMMON_WORDS else (0, 0)
                    kind = "project" if name == "Acme" else "concept" if q > p else "person"
                    expected.append((i, n, m.start(), m.group(), name, kind, p, q))
    assert got == sorted(expected)
    assert registry.mentions(docs, entries.limit(0)).count() == 0 and registry.mentions(docs.limit(0), entries).count() == 0


def test_people_of_queries_and_unknown_names(spark, entries):
    q = spark.createDataFrame([(1, "What did Riley say?"), (2, "have you ever seen it"), (3, "I went\nwith Ever and Maxie"), (4, None)], "query_id int, query string")
    assert sorted(map(tuple, registry.people_in(q, entries).collect())) == [(1, "Riley"), (3, "Ever"), (3, "Maxwell")]
    words = spark.createDataFrame([(w,) for w in ("Riley", "Zoe", "zoe", "May", "Zoe", None)], "word string")
    assert [r.word for r in registry.unknown_names(words, entries).collect()] == ["Zoe"]


def test_what_is_learned_is_merged_in_any_order(spark, entries):
    text = "Zelda said hi.\nZelda asked why.\nhey Zelda, she is here.\nthanks Zelda\nRiley said hi.\nRiley asked.\nhey Riley"
    first, second = (registry.learned(spark.createDataFrame([(i, text)], "id int, document string"), entries) for i in range(2))
    assert [(r["name"], r.type, r.source, r.seen_count) for r in first.collect()] == [("Zelda", "person", "learned", 4)]
    a, b = ({tuple(map(str, r)) for r in registry.merged(*x).collect()} for x in ((entries, first, second), (second, entries, first)))
    assert a == b
    zelda = registry.merged(entries, first, second).where("name = 'Zelda'").first()
    assert (zelda.seen_count, zelda.source) == (8, "learned")
    again = registry.merged(entries, first)
    assert registry.learned(spark.createDataFrame([(1, text)], "id int, document string"), again).count() == 0


def test_votes_come_from_what_stands_around_a_name():
    """As the patterns over the whole line, for names at borders, in other words, twice, and with odd white space."""
    words = "will will's wills' goodwill said told is was with saw picked up drop dropped off hey thanks my son have you if not would the of in to since : , ' - _ é 5 mark".split()
    rnd = random.Random(1)
    for _ in range(3000):
        line = "".join(rnd.choice(words) + rnd.choice([" ", " ", "", "  ", "\t", " ' "]) for _ in range(rnd.randint(1, 7)))
        for name in ("will", "off", "mark", "s", "with", "'s"):
            if places := [m.start() for m in re.finditer(f"(?={re.escape(name)})", line)]:
                assert list(registry._line_votes(line, {name: places})[name]) == plain_votes(name, line), (line, name)


def test_votes_are_counted_only_where_a_pattern_may_hold():
    """Names that are words are looked up, not searched inside other words; votes stay those of the patterns over the whole line."""
    words = "will will's wills' goodwill mark's marks' said told is was with saw called took picked up drop dropped off hey thanks thank my son have you if not would the of in to at for since : , ' - _ é 5 mark again more".split()
    rnd, names = random.Random(2), {"will", "off", "mark", "s", "with", "é"}
    for _ in range(3000):
        line = "".join(rnd.choice(words) + rnd.choice([" ", " ", "", "  ", "\t", " ' ", "'x", "s'y"]) for _ in range(rnd.randint(1, 8)))
        met, places = registry._word_places(line, names, names)
        assert sorted(met) == sorted((m.start(), m.group()) for m in re.finditer(r"\w+", line) if m.group() in names)
        counted = registry._line_votes(line, places)
        assert all(list(counted.get(w, (0, 0))) == plain_votes(w, line) for _, w in met), line
    assert registry._word_places("a goodwill, willing to will; willow", {"will"}, {"will"}) == ([(23, "will")], {})
