"""Short lines for notes (zettels): encoding, parsing back, and the essential moments of many files, as columns.

A file has source_file, emotional_arc, zettels and tunnels (``FILE``). A zettel's line is
``id:entities|topics|"quote"|weight|emotions|flags``, of which quote, emotions and flags may be absent. Encoding is
lossy, but lines are a grammar: ``parsed`` gives the fields of a line and ``line`` the same line from the fields, for topics without a bar.

Defined results: missing lists are empty and missing texts blank; a weight defaults to 0.5 in a line and to 0 among moments. A note without
people has the entity ``???``. Repeated codes of a line count once. Null files give null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ZETTEL = (
    "STRUCT<id: STRING, people: ARRAY<STRING>, topics: ARRAY<STRING>, title: STRING, content: STRING, origin_label: STRING, notes: STRING, emotional_weight: DOUBLE, "
    "emotional_tone: ARRAY<STRING>, origin_moment: BOOLEAN, sensitivity: STRING, date_context: STRING>"
)
FILE = f"source_file STRING, emotional_arc STRING, zettels ARRAY<{ZETTEL}>, tunnels ARRAY<STRUCT<from: STRING, to: STRING, label: STRING>>"
NOBODY, WEIGHT, ESSENTIAL = "???", 0.5, 0.85

# Codes of emotions, words that make a quote telling, patterns of quotes.
EMOTIONS = {
    "vulnerability": "vul", "vulnerable": "vul", "joy": "joy", "joyful": "joy", "fear": "fear", "mild_fear": "fear", "trust": "trust", "trust_building": "trust", "grief": "grief", "raw_grief": "grief",
    "wonder": "wonder", "philosophical_wonder": "wonder", "rage": "rage", "anger": "rage", "love": "love", "devotion": "love", "hope": "hope", "despair": "despair", "hopelessness": "despair",
    "peace": "peace", "relief": "relief", "humor": "humor", "dark_humor": "humor", "tenderness": "tender", "raw_honesty": "raw", "brutal_honesty": "raw", "self_doubt": "doubt", "anxiety": "anx",
    "exhaustion": "exhaust", "conviction": "convict", "quiet_passion": "passion", "warmth": "warmth", "curiosity": "curious", "gratitude": "grat", "frustration": "frust", "confusion": "confuse",
    "satisfaction": "satis", "excitement": "excite", "determination": "determ", "surprise": "surprise",
}
TELLING = [
    "love", "fear", "remember", "soul", "feel", "stupid", "scared", "beautiful", "destroy", "respect", "trust", "consciousness", "alive", "forget", "waiting", "peace", "matter", "real", "guilt",
    "escape", "rest", "hope", "dream", "lost", "found",
]
QUOTES = [
    r'"([^"]{8,55})"',
    r"(?:^|[\s(])'([^']{8,55})'(?:[\s.,;:!?)]|$)",
    r"""(?i)(?:says?|said|articulates?|reveals?|admits?|confesses?|asks?):\s*["']?([^.!?]{10,55})[.!?]""",
]
LINE = r'^([^:|]*):([^|]*)\|([^|]*)(?:\|"(.*)")?\|(-?[0-9][0-9.]*(?:E-?[0-9]+)?)(?:\|([^|A-Z][^|]*))?(?:\|([A-Z+]+))?$'


def _list(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def last_part(id_: Column) -> Column:
    return F.substring_index(id_, "-", -1)


def entity(name: Column, codes: Mapping[str, str] | None = None, skip: Sequence[str] = ()) -> Column:
    """The code of a name: its own, that of the first known name in it, or its first three letters; null for names to skip."""
    low = F.lower(name)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for s in skip:
        out = out.when(F.contains(low, F.lit(s)), F.lit(None))
    for match in (lambda k: name == k, lambda k: low == k, lambda k: F.contains(low, F.lit(k.lower()))):
        for k, v in (codes or {}).items():
            out = out.when(match(k), F.lit(v))
    return out.otherwise(F.upper(F.substring(name, 1, 3)))


def entities(people: Column, codes: Mapping[str, str] | None = None, skip: Sequence[str] = ()) -> Column:
    """The distinct codes of people, in order; of nobody a mark for that."""
    found = F.array_sort(F.array_distinct(F.filter(F.transform(_list(people), lambda p: entity(p, codes, skip)), lambda c: c.isNotNull())))
    return F.when(F.size(found) == 0, F.array(F.lit(NOBODY))).otherwise(found)


def emotions(tone: Column) -> Column:
    """The codes of the first three distinct emotions, joined."""
    table = F.create_map(*[F.lit(x) for kv in EMOTIONS.items() for x in kv])
    return F.array_join(F.slice(F.array_distinct(F.transform(_list(tone), lambda e: F.coalesce(F.element_at(table, e), F.substring(e, 1, 4)))), 1, 3), "+")


def flags(z: Column) -> Column:
    notes = F.lower(_text(z["notes"]))
    genesis = F.contains(notes, F.lit("genesis")) | F.contains(F.lower(_text(z["origin_label"])), F.lit("genesis"))
    return F.array_join(
        F.filter(
            F.array(
                F.when(F.coalesce(z["origin_moment"], F.lit(False)), F.lit("ORIGIN")),
                F.when(F.upper(_text(z["sensitivity"])).startswith("MAXIMUM"), F.lit("SENSITIVE")),
                F.when(F.contains(notes, F.lit("foundational pillar")) | F.contains(notes, F.lit("core")), F.lit("CORE")),
                F.when(genesis, F.lit("GENESIS")),
                F.when(F.contains(notes, F.lit("pivot")), F.lit("PIVOT")),
            ),
            lambda x: x.isNotNull(),
        ),
        "+",
    )


def quote(z: Column) -> Column:
    """The most telling quote of a note, else what its title says after a dash, else nothing."""
    text = F.concat_ws(" ", _text(z["content"]), _text(z["origin_label"]), _text(z["notes"]))
    found = F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in QUOTES])
    found = F.array_distinct(F.filter(F.transform(found, lambda q: F.regexp_replace(q, r"(?U)^\s+|\s+$", "")), lambda q: F.char_length(q) >= 8))

    def score(q: Column, i: Column) -> Column:
        low = F.lower(q)
        telling = sum((F.contains(low, F.lit(w)).cast("int") for w in TELLING), F.lit(0))
        opening = F.when(F.regexp_like(q, F.lit(r"^\p{Lu}")), 2).otherwise(0) - F.when(F.regexp_like(q, F.lit("^(The|This|She) ")), 2).otherwise(0)
        return F.struct((opening + 2 * telling + F.when(F.char_length(q) > 20, 1).otherwise(0)).alias("score"), (-i).alias("i"), q.alias("q"))

    title = _text(z["title"])
    tail = F.when(F.contains(title, F.lit(" - ")), F.substring(F.element_at(F.split(title, " - ", 2), 2), 1, 45)).otherwise(F.lit(""))
    return F.coalesce(F.array_max(F.transform(found, score))["q"], tail)


def _joined(*parts: Column) -> Column:
    """Parts with bars between; empty ones after the first two are left out."""
    return F.array_join(F.concat(F.array(*parts[:2]), F.filter(F.array(*parts[2:]), lambda x: x != "")), "|")


def _quoted(q: Column) -> Column:
    return F.when(q != "", F.concat(F.lit('"'), q, F.lit('"'))).otherwise(F.lit(""))


def encoded(z: Column, codes: Mapping[str, str] | None = None, skip: Sequence[str] = ()) -> Column:
    """A zettel's line."""
    topics = F.slice(_list(z["topics"]), 1, 2)
    who = F.concat(last_part(z["id"]), F.lit(":"), F.array_join(entities(z["people"], codes, skip), "+"))
    weight = F.coalesce(z["emotional_weight"], F.lit(WEIGHT)).cast("string")
    return _joined(who, F.when(F.size(topics) > 0, F.array_join(topics, "_")).otherwise(F.lit("misc")), _quoted(quote(z)), weight, emotions(z["emotional_tone"]), flags(z))


def encoded_tunnel(t: Column) -> Column:
    label = _text(t["label"])
    short = F.when(F.contains(label, F.lit(":")), F.substring_index(label, ":", 1)).otherwise(F.substring(label, 1, 30))
    return F.concat(F.lit("T:"), last_part(t["from"]), F.lit("<->"), last_part(t["to"]), F.lit("|"), short)


def encoded_file(source_file: Column, arc: Column, zettels: Column, tunnels: Column, codes: Mapping[str, str] | None = None, skip: Sequence[str] = ()) -> Column:
    """A file's text: header, arc, a line for each zettel and tunnel."""
    source = F.coalesce(source_file, F.lit("unknown"))
    dashed = F.contains(source, F.lit("-"))
    title = F.when(dashed, F.trim(F.element_at(F.split(F.replace(source, F.lit(".txt"), F.lit("")), "-", 2), -1))).otherwise(source)
    people = F.flatten(F.transform(zettels, lambda z: _list(z["people"])))
    header = F.array_join(
        F.array(
            F.when(dashed, F.substring_index(source, "-", 1)).otherwise(F.lit("000")), F.array_join(F.slice(entities(people, codes, skip), 1, 3), "+"), F.coalesce(F.get(zettels, F.lit(0))["date_context"], F.lit("unknown")), title
        ),
        "|",
    )
    lines = F.concat(F.array(header), F.when(_text(arc) != "", F.array(F.concat(F.lit("ARC:"), arc))).otherwise(F.array().cast("array<string>")), F.transform(zettels, lambda z: encoded(z, codes, skip)), F.transform(tunnels, encoded_tunnel))
    return F.array_join(lines, "\n")


def decoded(text: Column) -> Column:
    """struct(header, arc, zettels, tunnels) of a file's text; lines of zettels and tunnels as they are."""
    lines = F.split(F.trim(text), "\n")
    is_arc, is_tunnel = (lambda x: x.startswith("ARC:")), (lambda x: x.startswith("T:"))
    barred = lambda x: ~is_arc(x) & ~is_tunnel(x) & F.contains(x, F.lit("|"))
    noted = lambda x: F.contains(F.substring_index(x, "|", 1), F.lit(":"))
    head = F.split(F.element_at(F.concat(F.array(F.lit("")), F.filter(lines, lambda x: barred(x) & ~noted(x))), -1), r"\|")
    part = lambda i, name: _text(F.get(head, F.lit(i))).alias(name)
    arcs = F.filter(lines, is_arc)
    return F.struct(
        F.struct(part(0, "file"), part(1, "entities"), part(2, "date"), part(3, "title")).alias("header"),
        _text(F.substring(F.get(arcs, F.size(arcs) - 1), 5, 1 << 30)).alias("arc"),
        F.filter(lines, lambda x: barred(x) & noted(x)).alias("zettels"),
        F.filter(lines, is_tunnel).alias("tunnels"),
    )


def parsed(line_: Column) -> Column:
    """struct(id, entities, topics, quote, weight, emotions, flags) of a zettel's line; null if it isn't one."""
    part = lambda i: F.regexp_extract(line_, LINE, i)
    listed = lambda c: F.filter(F.split(c, r"\+"), lambda x: x != "")
    fields = F.struct(part(1).alias("id"), F.split(part(2), r"\+").alias("entities"), part(3).alias("topics"), part(4).alias("quote"), part(5).alias("weight"), listed(part(6)).alias("emotions"), listed(part(7)).alias("flags"))
    return F.when(F.regexp_like(line_, F.lit(LINE)), fields)


def line(p: Column) -> Column:
    """The line of the fields that ``parsed`` gives."""
    return _joined(F.concat(p["id"], F.lit(":"), F.array_join(p["entities"], "+")), p["topics"], _quoted(p["quote"]), p["weight"], F.array_join(p["emotions"], "+"), F.array_join(p["flags"], "+"))


def moments(files: DataFrame, least: float = ESSENTIAL, codes: Mapping[str, str] | None = None, skip: Sequence[str] = ()) -> DataFrame:
    """date, weight, source_file, place, line of the notes that weigh at least so much or have a flag of origin, core or genesis.

    A wake-up text has them by date, and within it by weight from the top.
    """
    day = F.coalesce(F.get("zettels", F.lit(0))["date_context"], F.lit("unknown"))
    rows = files.select("source_file", F.trim(F.substring_index(day, ",", 1)).alias("date"), F.posexplode("zettels").alias("place", "z"))
    z = F.col("z")
    rows = rows.withColumns({"weight": F.coalesce(z["emotional_weight"], F.lit(0.0)), "flags": flags(z)})
    rows = rows.where((F.col("weight") >= least) | F.regexp_like("flags", F.lit("ORIGIN|CORE|GENESIS")))
    title, q = _text(z["title"]), quote(z)
    hint = F.when(F.contains(title, F.lit(" - ")), F.substring(F.element_at(F.split(title, " - ", 2), 2), 1, 30)).otherwise(F.array_join(F.slice(_list(z["topics"]), 1, 2), "_"))
    said = F.when((q != hint) & (q != title), _quoted(q)).otherwise(F.lit(""))
    secret = F.when((_text(z["sensitivity"]) != "") & ~F.contains(F.col("flags"), F.lit("SENSITIVE")), F.lit("SENSITIVE")).otherwise(F.lit(""))
    weight = F.coalesce(z["emotional_weight"], F.lit(WEIGHT)).cast("string")
    parts = F.filter(F.array(F.array_join(entities(z["people"], codes, skip), "+"), hint, said, secret, weight, F.col("flags")), lambda x: x != "")
    return rows.select("date", "weight", "source_file", "place", F.array_join(parts, "|").alias("line"))
