"""Lines of notes: encoding against a plain version, round trips, moments."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from lodestore.functions import zettel

NOTE = ["id", "people", "topics", "title", "content", "origin_label", "notes", "emotional_weight", "emotional_tone", "origin_moment", "sensitivity", "date_context"]
CODES, SKIP = {"Alice": "ALC", "bob": "BOB"}, ["secret"]


def plain_entity(name):
    if any(s in name.lower() for s in SKIP):
        return None
    return CODES.get(name) or CODES.get(name.lower()) or next((v for k, v in CODES.items() if k.lower() in name.lower()), name[:3].upper())


def plain_quote(z):
    text = " ".join(z[k] or "" for k in ("content", "origin_label", "notes"))
    found = [m.strip() for p in zettel.QUOTES for m in re.findall(p, text)]
    found = [q for q in dict.fromkeys(found) if len(q) >= 8]
    score = lambda q: 2 * q[0].isupper() - 2 * q.startswith(("The ", "This ", "She ")) + 2 * sum(w in q.lower() for w in zettel.TELLING) + (len(q) > 20)
    if found:
        return max(found, key=score)
    return (z["title"] or "").split(" - ", 1)[1][:45] if " - " in (z["title"] or "") else ""


def plain_line(z):
    who = sorted({c for p in z["people"] or [] if (c := plain_entity(p))}) or ["???"]
    tones = list(dict.fromkeys(zettel.EMOTIONS.get(e, e[:4]) for e in z["emotional_tone"] or []))[:3]
    notes = (z["notes"] or "").lower()
    flags = [
        name
        for name, on in (
            ("ORIGIN", z["origin_moment"]), ("SENSITIVE", (z["sensitivity"] or "").upper().startswith("MAXIMUM")), ("CORE", "foundational pillar" in notes or "core" in notes),
            ("GENESIS", "genesis" in notes or "genesis" in (z["origin_label"] or "").lower()), ("PIVOT", "pivot" in notes),
        )
        if on
    ]
    q = plain_quote(z)
    parts = [z["id"].split("-")[-1] + ":" + "+".join(who), "_".join((z["topics"] or [])[:2]) or "misc", f'"{q}"' if q else "", str(0.5 if z["emotional_weight"] is None else z["emotional_weight"]), "+".join(tones), "+".join(flags)]
    return "|".join(p for i, p in enumerate(parts) if i < 2 or p)


def some_notes(n):
    rng = random.Random(8)
    texts = ["", None, 'He said "I remember the real love of it" and "The cat sat there".', "She reveals: we are all waiting for peace here. (it's 'quite all right now') ok", 'plain', '"short" and "exactly8"', 'asks: why | me and you? "a | barred quote"', "  'Trust in dreams' "]
    pick = lambda xs: rng.choice(xs)
    lists = [None, [], ["Alice"], ["Bobby", "Carol", "Carol"], ["alice b", "Secret One"], ["Secret One"], ["é"]]
    return [
        (f"zettel-{i:03}", pick(lists), pick([None, [], ["memory"], ["a", "b", "c"]]), pick([None, "", "T", "T - the tail - of it all"]), pick(texts), pick([None, "the Genesis"]), pick([None, "a CORE pivot", "genesis", "'hope and dream' x"]),
         pick([None, 0.0, 0.7, 0.85, 1.0]), pick([None, [], ["joy", "joyful", "rage"], ["weariness", "hope", "love", "fear"]]), pick([None, True, False]), pick([None, "", "maximum (x)", "low"]), pick([None, "2026-01-02, Friday"]))
        for i in range(n)
    ]


def test_lines_equal_a_plain_version_and_come_back(spark):
    notes = some_notes(300)
    df = spark.createDataFrame([(x,) for x in notes], f"z {zettel.ZETTEL}").select("z.id", zettel.encoded(F.col("z"), CODES, SKIP).alias("line"))
    df = df.withColumn("again", zettel.line(zettel.parsed(F.col("line"))))
    got = {r.id: r for r in df.collect()}
    for x in notes:
        z = dict(zip(NOTE, x, strict=True))
        assert got[z["id"]].line == plain_line(z) == got[z["id"]].again
    bad = spark.createDataFrame([("no line",), ("001|A|2026|t",), (None,)], "l string").select(zettel.parsed(F.col("l")).alias("p"))
    assert [r.p for r in bad.collect()] == [None] * 3


def test_files_are_encoded_and_decoded(spark):
    tunnels = [("zettel-001", "zettel-002", "follows: temporal"), ("zettel-002", "zettel-003", None)]
    rows = [("001-my - file.txt", "journey", some_notes(3), tunnels), ("plain", None, [], []), (None, "", some_notes(1), [])]
    files = spark.createDataFrame(rows, zettel.FILE)
    text = zettel.encoded_file(F.col("source_file"), F.col("emotional_arc"), F.col("zettels"), F.col("tunnels"), CODES, SKIP)
    got = files.select("source_file", text.alias("t")).withColumn("d", zettel.decoded(F.col("t"))).collect()
    for r, (source, arc, notes, _) in zip(got, rows, strict=True):
        assert r.d.zettels == [plain_line(dict(zip(NOTE, x, strict=True))) for x in notes]
        assert r.d.arc == (arc or "")
        assert "\n".join(["|".join(r.d.header), *([f"ARC:{arc}"] if arc else []), *r.d.zettels, *r.d.tunnels]) == r.t
    assert tuple(got[0].d.header)[::3] == ("001", "my - file") and got[0].d.tunnels == ["T:001<->002|follows", "T:002<->003|"]
    assert tuple(got[1].d.header) == ("000", "???", "unknown", "plain")


def test_moments(spark):
    notes = some_notes(120)
    files = spark.createDataFrame([("f", "", notes, [])], zettel.FILE)
    got = {r.place: r for r in zettel.moments(files, codes=CODES, skip=SKIP).collect()}
    expected = set()
    for i, x in enumerate(notes):
        z = dict(zip(NOTE, x, strict=True))
        if (z["emotional_weight"] or 0) >= 0.85 or re.search(r"\|[A-Z+]*(ORIGIN|CORE|GENESIS)[A-Z+]*$", plain_line(z)):
            expected.add(i)
    assert set(got) == expected and all(r.line for r in got.values())
    assert zettel.moments(files.limit(0)).count() == 0
