"""A lossy one-line summary of a text: people, topics, a key sentence, moods and flags, as columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestore.functions.text import strip, token_estimate

# Words that tell a mood or a flag, in the order in which they are reported.
MOODS = {
    "decided": "determ", "prefer": "convict", "worried": "anx", "excited": "excite", "frustrated": "frust", "confused": "confuse", "love": "love", "hate": "rage",
    "hope": "hope", "fear": "fear", "trust": "trust", "happy": "joy", "sad": "grief", "surprised": "surprise", "grateful": "grat", "curious": "curious",
    "wonder": "wonder", "anxious": "anx", "relieved": "relief", "satisf": "satis", "disappoint": "grief", "concern": "anx",
}
FLAGS = {
    "decided": "DECISION", "chose": "DECISION", "switched": "DECISION", "migrated": "DECISION", "replaced": "DECISION", "instead of": "DECISION", "because": "DECISION",
    "founded": "ORIGIN", "created": "ORIGIN", "started": "ORIGIN", "born": "ORIGIN", "launched": "ORIGIN", "first time": "ORIGIN", "core": "CORE", "fundamental": "CORE",
    "essential": "CORE", "principle": "CORE", "belief": "CORE", "always": "CORE", "never forget": "CORE", "turning point": "PIVOT", "changed everything": "PIVOT",
    "realized": "PIVOT", "breakthrough": "PIVOT", "epiphany": "PIVOT", "api": "TECHNICAL", "database": "TECHNICAL", "architecture": "TECHNICAL", "deploy": "TECHNICAL",
    "infrastructure": "TECHNICAL", "algorithm": "TECHNICAL", "framework": "TECHNICAL", "server": "TECHNICAL", "config": "TECHNICAL",
}
KEY_WORDS = (
    "decided", "because", "instead", "prefer", "switched", "chose", "realized", "important", "key", "critical", "discovered", "learned", "conclusion", "solution",
    "reason", "why", "breakthrough", "insight",
)
STOP = tuple("the a an and or but in on at to for of with by from as is was are were be been being have has had do does did will would could should may might must can this that these those it its they them their we our you your i my me he she his her who what".split())


def _signals(text: Column, table: Mapping[str, str], most: int = 3) -> Column:
    low = F.lower(text)
    found = F.array(*[F.when(F.contains(low, F.lit(k)), F.lit(v)) for k, v in table.items()])
    return F.slice(F.array_distinct(F.filter(found, lambda x: x.isNotNull())), 1, most)


def topics(text: Column, most: int = 3) -> Column:
    """The commonest words; capitals, inner capitals and joined words count two more each time. Ties by place."""
    words = F.regexp_extract_all(text, F.lit(r"[a-zA-Z][a-zA-Z_-]{2,}"), F.lit(0))
    weight = lambda w: 1 + F.when(F.regexp_like(w, F.lit("^[A-Z]")), 2).otherwise(0) + F.when(F.regexp_like(w, F.lit("^.+[A-Z]|[_-]")), 2).otherwise(0)
    named = F.filter(F.transform(words, lambda w: F.struct(F.lower(w).alias("w"), weight(w).alias("n"))), lambda s: ~s["w"].isin(*STOP))
    keys = F.array_distinct(F.transform(named, lambda s: s["w"]))
    total = lambda k: F.aggregate(F.filter(named, lambda s: s["w"] == k), F.lit(0), lambda a, s: a + s["n"])
    ranked = F.array_sort(F.transform(keys, lambda k: F.struct((-total(k)).alias("n"), F.array_position(keys, k).alias("at"), k.alias("w"))))
    return F.transform(F.slice(ranked, 1, most), lambda s: s["w"])


def key_sentence(text: Column) -> Column:
    parts = F.filter(F.transform(F.split(text, r"[.!?\n]+"), strip), lambda s: F.char_length(s) > 10)

    def score(s: Column) -> Column:
        n = F.char_length(s)
        words = sum((F.contains(F.lower(s), F.lit(w)).cast("int") for w in KEY_WORDS), F.lit(0))
        return 2 * words + (n < 80).cast("int") + (n < 40).cast("int") - 2 * (n > 150).cast("int")

    best = F.get(F.array_sort(F.transform(parts, lambda s, i: F.struct((-score(s)).alias("n"), i.alias("at"), s.alias("s")))), F.lit(0))["s"]
    return F.when(F.char_length(best) > 55, F.concat(F.substring(best, 1, 52), F.lit("..."))).otherwise(F.coalesce(best, F.lit("")))


def people(text: Column, codes: Mapping[str, str] | None = None, most: int = 3) -> Column:
    """Codes of the known names in the text, else the first letters of capitalised words past the first."""
    low = F.lower(text)
    known = F.filter(F.array(*[F.when(F.contains(low, F.lit(n.lower())), F.lit(c)) for n, c in (codes or {}).items()]).cast("array<string>"), lambda x: x.isNotNull())
    words = F.filter(F.split(strip(text), r"\s+"), lambda w: w != "")
    bare = F.transform(F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda w: F.regexp_replace(w, "[^a-zA-Z]", ""))
    names = F.filter(bare, lambda w: F.regexp_like(w, F.lit("^[A-Z][a-z]+$")) & ~F.lower(w).isin(*STOP))
    guessed = F.slice(F.array_distinct(F.transform(names, lambda w: F.upper(F.substring(w, 1, 3)))), 1, most)
    return F.when(F.size(known) > 0, F.slice(F.array_distinct(known), 1, most)).otherwise(guessed)


def compressed(text: str | Column, codes: Mapping[str, str] | None = None, header: Sequence[Column] = ()) -> Column:
    """``0:PEOPLE|topics|"sentence"|moods|flags``, after a header line of the given columns."""
    c = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    who, what, said = people(c, codes), topics(c), key_sentence(c)
    or_ = lambda a, sep, other: F.when(F.size(a) > 0, F.array_join(a, sep)).otherwise(F.lit(other))
    line = F.concat_ws(
        "|", F.concat(F.lit("0:"), or_(who, "+", "???")), or_(what, "_", "misc"), F.when(said != "", F.concat(F.lit('"'), said, F.lit('"'))),
        F.nullif(F.array_join(_signals(c, MOODS), "+"), F.lit("")), F.nullif(F.array_join(_signals(c, FLAGS), "+"), F.lit("")),
    )
    if header:
        line = F.concat(F.concat_ws("|", *[F.coalesce(F.nullif(h, F.lit("")), F.lit("?")) for h in header]), F.lit("\n"), line)
    return line


def parts(line: str | Column) -> Column:
    """A summary line as a struct of its fields again."""
    c = F.col(line) if isinstance(line, str) else line
    last = F.element_at(F.split(c, "\n"), -1)
    f = F.split(last, r"\|")
    quoted = F.filter(f, lambda x: F.startswith(x, F.lit('"')))
    return F.struct(F.split(F.regexp_replace(F.get(f, F.lit(0)), "^0:", ""), r"\+").alias("people"), F.split(F.get(f, F.lit(1)), "_").alias("topics"), F.regexp_replace(F.coalesce(F.get(quoted, F.lit(0)), F.lit("")), '^"|"$', "").alias("sentence"))


def ratio(text: str | Column, line: str | Column) -> Column:
    """Tokens of a text over those of its summary."""
    return token_estimate(text) / F.greatest(token_estimate(line), F.lit(1))
