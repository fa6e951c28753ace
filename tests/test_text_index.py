"""The analyzer against a plain stemmer, the index against full scoring in plain Python."""

from __future__ import annotations

import math
import random
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestore.functions import analyze
from lodestore.operators import filters, ranking, textindex
from lodestore.schema import UnsupportedFilter

# Published pairs of the English stemmer.
PAIRS = """consign consign|consigned consign|consistency consist|consolatory consolatori|consolidating consolid|consonant conson|conspicuously conspicu|conspirator conspir|constancy constanc
knackeries knackeri|kneaded knead|knightly knight|knives knive|generously generous|generate generat|skies sky|dying die|yes yes|happily happili|hoping hope|hopping hop|relational relat|conditional condit
digitizer digit|callousness callous|sensibiliti sensibl|electriciti electr|inference infer|irritant irrit|adoption adopt|effective effect|bowdlerize bowdler|probate probat|cease ceas|controll control
gas gas|this this|gaps gap|kiwis kiwi|ties tie|cries cri|agreed agre|feed feed|bled bled|conflated conflat|sized size|falling fall|filing file|by by|say say|cry cri|proceeded proceed|innings inning
herring herring|news news|only onli|early earli|singly singl|communism communism|kneels kneel|knocker knocker|boyish boyish|roll roll"""  # fmt: skip


def plain_stem(word: str) -> str:
    """The stemmer as a procedure over one word."""
    if len(word) < 3 or not re.fullmatch("[a-z]+", word):
        return word
    if word in analyze.SPECIAL:
        return analyze.SPECIAL[word]
    vowels = set("aeiouy")
    w = list(word)
    for i, c in enumerate(w):
        if c == "y" and (i == 0 or w[i - 1] in vowels):
            w[i] = "Y"
    s = "".join(w)

    def region(start: int) -> int:
        for i in range(start + 1, len(s)):
            if s[i] not in vowels and s[i - 1] in vowels:
                return i + 1
        return len(s)

    r1 = next((len(p) for p in ("gener", "commun", "arsen") if s.startswith(p)), region(0))
    r2 = region(r1) if r1 < len(s) else len(s)

    def short_end(x: str) -> bool:
        if len(x) == 2:
            return x[0] in vowels and x[1] not in vowels
        return len(x) > 2 and x[-3] not in vowels and x[-2] in vowels and x[-1] not in vowels and x[-1] not in "wxY"

    def longest(x: str, endings) -> str:
        return max((e for e in endings if x.endswith(e)), key=len, default="")

    e = longest(s, ["sses", "ied", "ies", "us", "ss", "s"])
    if e == "sses":
        s = s[:-2]
    elif e in ("ied", "ies"):
        s = s[:-2] if len(s) > 4 else s[:-1]
    elif e == "s" and any(c in vowels for c in s[:-2]):
        s = s[:-1]
    if s in analyze.STAY_AFTER_1A:
        return s
    e = longest(s, ["eed", "eedly", "ed", "edly", "ing", "ingly"])
    if e in ("eed", "eedly"):
        if len(s) - len(e) >= r1:
            s = s[: len(s) - len(e)] + "ee"
    elif e and any(c in vowels for c in s[: len(s) - len(e)]):
        s = s[: len(s) - len(e)]
        if s.endswith(("at", "bl", "iz")):
            s += "e"
        elif s[-2:] in analyze.DOUBLES:
            s = s[:-1]
        elif r1 >= len(s) and short_end(s):
            s += "e"
    if len(s) > 2 and s[-1] in "yY" and s[-2] not in vowels:
        s = s[:-1] + "i"
    e = longest(s, analyze.STEP_2)
    if e and len(s) - len(e) >= r1 and not (e == "ogi" and s[-4:-3] != "l") and not (e == "li" and s[-3] not in "cdeghkmnrt"):
        s = s[: len(s) - len(e)] + analyze.STEP_2[e]
    e = longest(s, analyze.STEP_3)
    if e and len(s) - len(e) >= (r2 if e == "ative" else r1):
        s = s[: len(s) - len(e)] + analyze.STEP_3[e]
    e = longest(s, analyze.STEP_4)
    if e and len(s) - len(e) >= r2 and not (e == "ion" and s[-4:-3] not in ("s", "t")):
        s = s[: len(s) - len(e)]
    if s[-1] == "e" and (len(s) - 1 >= r2 or (len(s) - 1 >= r1 and not short_end(s[:-1]))):
        s = s[:-1]
    elif s.endswith("ll") and len(s) - 1 >= r2:
        s = s[:-1]
    return s.replace("Y", "y")


def stems_of(spark, words):
    return {r.word: r.stem for r in analyze.stemmed(spark.createDataFrame([(w,) for w in set(words)], "word string")).collect()}


def test_stems_of_published_pairs(spark):
    pairs = [p.split() for line in PAIRS.split("\n") for p in line.split("|")]
    got = stems_of(spark, [w for w, _ in pairs])
    assert {w: got[w] for w, _ in pairs} == dict(pairs)
    assert {w: plain_stem(w) for w, _ in pairs} == dict(pairs)


def test_stems_equal_the_plain_stemmer(spark):
    rng = random.Random(2)
    parts = ["y", "a", "e", "i", "o", "u", "b", "s", "t", "l", "gener", "commun", "sh", "st", "ll", "w", "x", "an", "er", "logi"]
    ends = ["", "s", "ies", "ied", "sses", "us", "eed", "eedly", "ed", "ing", "ingly", "edly", "y", "e", "ative", *analyze.STEP_2, *analyze.STEP_3, *analyze.STEP_4]
    words = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 6))) + rng.choice(ends) + rng.choice(["", "", "s", "ly", "ing", "ed"]) for _ in range(6000)]
    words += [*analyze.SPECIAL, *analyze.STAY_AFTER_1A, "y", "yy", "ayy", "été", "a1", "42", ""]
    got = stems_of(spark, words)
    assert {w: s for w, s in got.items() if s != plain_stem(w)} == {}


def plain_words(text: str | None) -> list[str]:
    x = "".join(c for c in unicodedata.normalize("NFD", (text or "").lower()) if not unicodedata.combining(c))
    for a, b in analyze.FOLDS.items():
        x = x.replace(a, b)
    return [plain_stem(w) for w in re.findall(r"[^\W\d_]+|\d+", x)]


def plain_search(docs, query, k, every=False, allowed=None):
    terms = set(plain_words(query))
    bags = [(i, Counter(plain_words(t))) for i, t in docs]
    mean = max(sum(sum(b.values()) for _, b in bags) / len(bags), 1)
    df = {x: sum(x in b for _, b in bags) for x in terms}
    out = []
    for i, b in bags:
        met = [x for x in terms if x in b]
        if not met or (every and len(met) < len(terms)) or (allowed is not None and i not in allowed):
            continue
        length = sum(b.values())
        out.append((i, sum(math.log((len(docs) - df[x] + 0.5) / (df[x] + 0.5) + 1) * b[x] * 2.2 / (b[x] + 1.2 * (0.25 + 0.75 * length / mean)) for x in met)))
    return sorted(out, key=lambda x: (-round(x[1], 6), x[0]))[:k]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(7)
    words = ["runs", "running", "Café", "cafe", "straße", "wolves", "wolf", "cat", "the", "the", "the", "Zug", "x9y", "naïve", "relational", "related"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40)))) for i in range(400)]
    docs += [(400 + i, "the rare wolf met a unique zebra " * (1 + i % 3)) for i in range(5)]  # together at the end
    docs += [(500, None), (501, ""), (502, "... !"), (503, docs[7][1]), (504, docs[7][1])]
    return docs


def test_search_skips_blocks_and_equals_full_scoring(spark, corpus, monkeypatch):
    monkeypatch.setattr(textindex, "BLOCK", 16)
    df = spark.createDataFrame(corpus, "id long, document string").withColumn("words", F.lit(0)).coalesce(1)
    index = textindex.build(df)
    asked = {1: "zebra wolves", 2: "RUN café", 3: "unknown", 4: "", 5: "relating the strasse", 6: "unique"}
    queries = spark.createDataFrame(list(asked.items()), "query_id int, query string")
    for every in (False, True):
        got = textindex.search(index, queries, 4, every).collect()
        full = textindex.full_search(index, queries, 4, every).collect()
        assert sorted((r.query_id, r.id, r["rank"]) for r in got) == sorted((r.query_id, r.id, r["rank"]) for r in full)
        for q, text in asked.items():
            expected = plain_search(corpus, text, 4, every)
            mine = sorted((r["rank"], r.id, r.score) for r in got if r.query_id == q)
            assert [i for _, i, _ in mine] == [i for i, _ in expected], (q, every)
            assert [s for *_, s in mine] == pytest.approx([s for _, s in expected])
    plan, _ = textindex.plan(index, queries, 4)
    by = {r.query_id: (r.n, r.read) for r in plan.groupBy("query_id").agg(F.count("*").alias("n"), F.sum(F.col("read").cast("int")).alias("read")).collect()}
    assert by[1][1] < by[1][0] > 10  # most blocks hold a wolf, and none a zebra
    odd = spark.createDataFrame([(i,) for i, _ in corpus if i % 2], "id long")
    got = textindex.search(index, queries.where("query_id = 1"), 4, allowed=odd).orderBy("rank").collect()
    assert [r.id for r in got] == [i for i, _ in plain_search(corpus, asked[1], 4, allowed={i for i, _ in corpus if i % 2})]


def test_find_promotes_search(spark):
    rows = [("a", "the quick brown fox", "x"), ("b", "a machine that learns", "x"), ("c", "machines and foxes", "y"), ("d", None, "y")]
    chunks = spark.createDataFrame(rows, "id string, document string, wing string")
    index = textindex.build(chunks)
    assert [r.id for r in textindex.find(index, chunks, ["q"], {"$search": "brown"}).collect()] == ["a"]
    assert {r.id for r in textindex.find(index, chunks, ["q"], {"$search": "Machine"}).collect()} == {"b", "c"}
    assert [r.id for r in textindex.find(index, chunks, ["q"], {"$search": "machine"}, where={"wing": "y"}).collect()] == ["c"]
    assert [r.id for r in textindex.find(index, chunks, ["q"], {"$search": "machine", "$contains": "learns"}).collect()] == ["b"]
    two = textindex.find(index, chunks, ["p", "q"], {"$search": ["fox", "machine learning"]}).collect()
    assert {(r.query_id, r.id) for r in two} == {(0, "a"), (0, "c"), (1, "b")} and all(0 < r.distance < 1 for r in two)
    for texts, spec in ((["p", "q"], {"$search": ["fox"]}), (None, {"$search": "fox"}), (["p"], {"$contains": "fox"})):
        with pytest.raises(UnsupportedFilter):
            textindex.find(index, chunks, texts, spec)
    with pytest.raises(UnsupportedFilter):
        filters.where_document({"$search": "fox"})


def test_index_of_nothing(spark):
    index = textindex.build(spark.createDataFrame([], "id long, document string"))
    queries = spark.createDataFrame([(1, "wolf")], "query_id int, query string")
    assert textindex.search(index, queries, 3).collect() == [] and textindex.search(index, queries.limit(0), 3).collect() == []


def test_a_block_gives_each_query_its_best_rows_only(spark, corpus):
    """Scores leave a block's task as the best k of each query, not as a row for each document that has one of its words."""
    index = textindex.build(spark.createDataFrame(corpus, "id long, document string").coalesce(1))
    queries = spark.createDataFrame([(1, "the wolf runs"), (2, "cat")], "query_id int, query string")
    terms = textindex.query_terms(index, queries)
    rows = textindex._scores(index, index.table(textindex.POSTINGS), terms, 3, None, False, None)
    assert [r["count"] for r in rows.groupBy("query_id", "block").count().collect()] == [3, 3, 3, 3]
    assert index.table(textindex.POSTINGS).count() == index.table(textindex.POSTINGS).select("term", "block").distinct().count()


def test_millionths_round_as_sql(spark):
    x = [0.5e-6, 1.5e-6, 2.5e-6, 1.0000005, 7.1234565, 3.4999995, 12.3456785, 100.0000015, 0.1, 2 / 3]
    got = spark.createDataFrame([(v,) for v in x], "x double").select(F.round("x", 6).alias("r")).collect()
    assert [round(r.r * 1e6) for r in got] == ranking.millionths(np.array(x)).astype(int).tolist()
