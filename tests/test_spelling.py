"""Spelling against brute-force edit distance."""

from __future__ import annotations

import itertools
import random
import re

from pyspark.sql import functions as F

from lodestore.functions import spelling


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def changed(rng: random.Random, word: str, letters: str) -> str:
    for _ in range(rng.randrange(4)):
        i = rng.randrange(len(word) + 1)
        word = rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i:], word[:i] + rng.choice(letters) + word[i + 1 :]])
    return word


def best(word: str, dictionary: dict[str, int]):
    near = [(distance(word, d), -n, d) for d, n in dictionary.items()]
    return min((x for x in near if x[0] <= 2), default=None)


def test_fixes_equal_brute_force(spark):
    rng, letters = random.Random(20), "abcé"
    dictionary = {"".join(rng.choice(letters) for _ in range(rng.choice([1, 3, 5, 8, 14, 15, 16, 17, 18, 25, 40]))): rng.randrange(5) for _ in range(150)}
    words = {changed(rng, rng.choice(list(dictionary)), letters) for _ in range(500)} | {"abcdefghij" * 30, "abcdefghij" * 30 + "x", "", "ab"}
    dictionary["abcdefghij" * 30] = 2
    d = spark.createDataFrame([*dictionary.items(), (None, 3), ("", 9)], "word string, n long")
    got = {r.word: (r.distance, r.fix) for r in spelling.fixes(spark.createDataFrame([(w,) for w in words], "word string"), d).collect()}
    expected = {w: (b[0], b[2]) for w in words if len(w) >= 4 and w not in dictionary and (b := best(w, dictionary))}
    assert got == expected and len(got) > 100


def test_words_that_stay(spark):
    skip = ["hi", "ok", "I", "3am", "top10", "bge-large-v1.5", "OtherDB", "NoteStore", "NDCG", "MAX_RESULTS", "train_test", "https://example.com", "www.google.com", "`code`", "**bold**", "Proper", "notes.txt"]
    rows = spark.createDataFrame([(w,) for w in [*skip, "hello", "question", "knoe"]], "w string")
    assert {r.w for r in rows.where(spelling.checkable(F.col("w"))).collect()} == {"hello", "question", "knoe"}


def test_texts_keep_all_but_the_misspelt(spark):
    dictionary = spark.createDataFrame([("know", 9), ("question", 5), ("before", 7), ("the", 99)], "word string, n long")
    texts = ["I knoe the  quesion,\n\tbefor!  OtherDB knoe", "", None, "Knoe knoe-it kno", "I knoe the  quesion,\n\tbefor!  OtherDB knoe", "notestroe knoe.\")"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "id int, document string, fix int")
    out = {r.id: r.corrected for r in spelling.corrected(docs, dictionary).collect()}
    first = "I know the  question,\n\tbefore!  OtherDB know"
    assert out == {0: first, 1: "", 2: None, 3: "Knoe knoe-it kno", 4: first, 5: "notestroe know.\")"}
    names = spark.createDataFrame([("KNOE",)], "name string")
    assert spelling.corrected(docs, dictionary, names=names).where("id = 5").first().corrected == texts[5]
    assert spelling.corrected(docs.limit(0), dictionary).count() == 0 and spelling.corrected(docs, dictionary.limit(0)).where("not (corrected <=> document)").count() == 0


def test_only_what_users_wrote_is_corrected(spark):
    dictionary = spark.createDataFrame([("know", 9), ("before", 7)], "word string, n long")
    text = "knoe befor\n> I knoe it\n  > befor\n>\n> \nassistant: knoe"
    docs = spark.createDataFrame([(1, text), (2, "no user knoe"), (3, None)], "id int, document string")
    out = {r.id: r.corrected for r in spelling.transcripts(docs, dictionary).collect()}
    assert out == {1: "knoe befor\n> I know it\n  > before\n>\n> \nassistant: knoe", 2: "no user knoe", 3: None}


def test_keys_of_near_words_meet(spark):
    rng, letters = random.Random(3), "abcdef"
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice(letters) for _ in range(rng.randrange(2, 24)))
        b = changed(rng, a, letters)
        if re.fullmatch(".+", b) and distance(a, b) <= 2:
            pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string")
    assert df.where(~F.arrays_overlap(spelling.index_keys(F.col("a")), spelling.lookup_keys(F.col("b")))).count() == 0


def test_words_are_checked_once_and_letters_lost_once(spark, monkeypatch):
    for edits in (1, 2, 3):
        words = ["", "a", "aa", "abca", "letter", "naïve"]
        want = [{"".join(c for i, c in enumerate(w) if i not in lost) for n in range(edits + 1) for lost in itertools.combinations(range(len(w)), n)} for w in words]
        got = [r.d for r in spark.createDataFrame([(w,) for w in words], "w string").select(spelling.deletions(F.col("w"), edits).alias("d")).collect()]
        assert [set(x) for x in got] == want and all(len(x) == len(set(x)) for x in got)
    assert spelling.deletions(F.lit("a"))._jc.toString().count("array_distinct") == 1
    checked = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda w: checked.add(1) or True, "boolean")
    monkeypatch.setattr(spelling, "checkable", lambda word: seen(word))
    docs = spark.createDataFrame([("often words, words often",)] * 50, "document string")
    assert {(r.word, r.n) for r in spelling.words_of(docs).collect()} == {("often", 100), ("words", 100)}
    assert checked.value == 3  # often, words and words with its comma


def test_words_meet_in_groups_and_no_deletions_are_rows(spark, monkeypatch):
    monkeypatch.setattr(spelling, "ASKED", 40, raising=False)
    monkeypatch.setattr(spelling, "KNOWN", 30, raising=False)
    rng, letters = random.Random(8), "abcé😀"
    dictionary = {"".join(rng.choice(letters) for _ in range(rng.choice([2, 4, 6, 9, 16, 17]))): rng.randrange(3) for _ in range(100)}
    words = {changed(rng, rng.choice(list(dictionary)), letters) for _ in range(200)}
    df = spelling.fixes(spark.createDataFrame([(w,) for w in words], "word string"), spark.createDataFrame([*dictionary.items()], "word string, n long"))
    got = {r.word: (r.distance, r.fix) for r in df.collect()}
    assert got == {w: (b[0], b[2]) for w in words if len(w) >= 4 and w not in dictionary and (b := best(w, dictionary))} and len(got) > 50
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "array_distinct" not in plan and "CoGroup" in plan  # no rows for all deletions of dictionary words, which a join may send through the driver
