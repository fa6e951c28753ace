"""The registry of people and projects: look-up, disambiguation by context, mentions in texts, learning.

A registry is a table of entries: name (canonical), type (person or project), source, confidence, aliases, contexts,
seen_count. Words that are names and common words as well are ambiguous: patterns around the word vote for a person or for a concept, and
a tie leaves the person.

Mentions are found in one pass over the texts: aliases that are one word by looking each word up, others by an automaton. The aliases go to all tasks: ``MAX_ALIASES``
bounds them, and more raise ValueError. A mention is a row with its place; its context is the line, whose votes are counted
once for each ambiguous word in it. What is learned from texts is merged as an aggregate by name, so batches may come in any order.

Defined results: null texts have no mentions and null words are unknown. Matching ignores case. Of entries that
share an alias people come before projects, then the first by name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestore.functions import entities

#: Aliases that go to all tasks, at most.
MAX_ALIASES = 500_000
ENTRY = "name string, type string, source string, confidence double, aliases array<string>, contexts array<string>, seen_count long"

# Common words that are also names, or look like names at the start of a sentence.
COMMON_WORDS = [
    "ever", "grace", "will", "bill", "mark", "april", "may", "june", "joy", "hope", "faith", "chance", "chase", "hunter", "dash", "flash", "star", "sky", "river", "brook", "lane", "art", "clay", "gil",
    "nat", "max", "rex", "ray", "jay", "rose", "violet", "lily", "ivy", "ash", "reed", "sage",
    "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "january", "february", "march", "july", "august", "september", "october", "november", "december",
]
# Contexts of a person and of a concept; {name} stands for the word.
PERSON_CONTEXTS = [
    r"\b{name}\s+said\b",
    r"\b{name}\s+told\b",
    r"\b{name}\s+asked\b",
    r"\b{name}\s+laughed\b",
    r"\b{name}\s+smiled\b",
    r"\b{name}\s+was\b",
    r"\b{name}\s+is\b",
    r"\b{name}\s+called\b",
    r"\b{name}\s+texted\b",
    r"\bwith\s+{name}\b",
    r"\bsaw\s+{name}\b",
    r"\bcalled\s+{name}\b",
    r"\btook\s+{name}\b",
    r"\bpicked\s+up\s+{name}\b",
    r"\bdrop(?:ped)?\s+(?:off\s+)?{name}\b",
    r"\b{name}(?:'s|s')\b",
    r"\bhey\s+{name}\b",
    r"\bthanks?\s+{name}\b",
    r"^{name}[:\s]",
    r"\bmy\s+(?:son|daughter|kid|child|brother|sister|friend|partner|colleague|coworker)\s+{name}\b",
]
CONCEPT_CONTEXTS = [
    r"\bhave\s+you\s+{name}\b",
    r"\bif\s+you\s+{name}\b",
    r"\b{name}\s+since\b",
    r"\b{name}\s+again\b",
    r"\bnot\s+{name}\b",
    r"\b{name}\s+more\b",
    r"\bwould\s+{name}\b",
    r"\bcould\s+{name}\b",
    r"\bwill\s+{name}\b",
    r"(?:the\s+)?{name}\s+(?:of|in|at|for|to)\b",
]
# Certainty of a vote: least, most for a person and for a concept, and what each pattern adds.
SURE, MOST_PERSON, MOST_CONCEPT, EACH = 0.7, 0.95, 0.90, 0.1


def seeded(people: DataFrame, projects: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Entries from what a user told: people (name, context) and projects (name); aliases: from an alias to a canonical name."""
    names = people.select(F.trim("name").alias("name"), F.coalesce("context", F.lit("personal")).alias("context")).where("name <> ''")
    given = names.sparkSession.createDataFrame([(v, k) for k, v in (aliases or {}).items()], "name string, alias string").groupBy("name").agg(F.sort_array(F.collect_set("alias")).alias("aliases"))
    whole = names.dropDuplicates(["name"]).join(given, "name", "left")
    rows = whole.select("name", F.lit("person").alias("type"), F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"), F.array("context").alias("contexts"))
    rows = rows.unionByName(projects.select("name").distinct().select("name", F.lit("project").alias("type"), F.array().cast("array<string>").alias("aliases"), F.array().cast("array<string>").alias("contexts")))
    return rows.select("name", "type", F.lit("onboarding").alias("source"), F.lit(1.0).alias("confidence"), "aliases", "contexts", F.lit(0).cast("long").alias("seen_count"))


def _aliases(entries: DataFrame, common: Sequence[str]) -> DataFrame:
    """alias (lower case), entry, ambiguous: one entry for each alias."""
    each = entries.select(F.struct("name", "type", "source", "confidence", "contexts").alias("entry"), F.explode(F.array_distinct(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("alias"))
    each = each.select(F.lower("alias").alias("alias"), "entry", F.struct((F.col("entry.type") != "person").alias("project"), F.col("entry.name").alias("name")).alias("order")).where("alias <> ''")
    one = each.groupBy("alias").agg(F.min_by("entry", "order").alias("entry"))
    words = one.sparkSession.createDataFrame([(w.lower(),) for w in sorted(set(common))], "alias string").withColumn("common", F.lit(True))
    return one.join(F.broadcast(words), "alias", "left").select("alias", "entry", (F.coalesce("common", F.lit(False)) & (F.col("entry.type") == "person")).alias("ambiguous"))


def votes(name: Column, context: Column, patterns: Sequence[str]) -> Column:
    """How many of the patterns the context has around the name."""
    quoted, low = F.concat(F.lit(r"\Q"), F.replace(F.lower(name), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")), F.lower(context)

    def met(p: str) -> Column:
        before, _, after = p.partition("{name}")
        return F.regexp_like(low, F.concat(F.lit(f"(?U){before}"), quoted, F.lit(after))).cast("int")

    return sum((met(p) for p in patterns), F.lit(0))


def _judged(rows: DataFrame, word: str) -> DataFrame:
    """rows with entry (or null), person_votes and concept_votes: type, name, source, confidence, decided."""
    by_person, by_concept = F.col("person_votes") > F.col("concept_votes"), F.col("concept_votes") > F.col("person_votes")
    sure = lambda most, n: F.bround(F.least(F.lit(most), SURE + F.col(n) * EACH), 6)
    return rows.withColumns({
        "type": F.when(F.col("entry").isNull(), "unknown").when(by_concept, "concept").otherwise(F.col("entry.type")),
        "name": F.when(F.col("entry").isNull() | by_person | by_concept, F.col(word)).otherwise(F.col("entry.name")),
        "source": F.when(F.col("entry").isNull(), "none").when(by_concept, "context_disambiguated").otherwise(F.col("entry.source")),
        "confidence": F.when(F.col("entry").isNull(), 0.0).when(by_person, sure(MOST_PERSON, "person_votes")).when(by_concept, sure(MOST_CONCEPT, "concept_votes")).otherwise(F.col("entry.confidence")),
        "decided": by_person | by_concept,
    })


def lookup(words: DataFrame, entries: DataFrame, confirmed: DataFrame | None = None, common: Sequence[str] = COMMON_WORDS, word: str = "word", context: str = "context") -> DataFrame:
    """words (word, context) with type, name, source, confidence, person_votes, concept_votes, decided (by context).

    confirmed: what a user confirmed of words looked up elsewhere (word, type, confidence), asked last.
    """
    a = _aliases(entries, common)
    if confirmed is not None:
        more = confirmed.select(F.lower("word").alias("alias"), F.struct(F.col("word").alias("name"), "type", F.lit("wiki").alias("source"), F.col("confidence").cast("double").alias("confidence"), F.array().cast("array<string>").alias("contexts")).alias("entry"))
        more = more.groupBy("alias").agg(F.min("entry").alias("entry")).join(a, "alias", "left_anti")
        a = a.unionByName(more.withColumn("ambiguous", F.lit(False)))
    rows = words.withColumns({"_low": F.lower(word), context: F.coalesce(F.col(context), F.lit("")) if context in words.columns else F.lit("")})
    met = rows.join(a, F.col("_low") == F.col("alias"), "left").withColumn("ambiguous", F.coalesce("ambiguous", F.lit(False)))
    ask = F.col("ambiguous") & (F.col(context) != "")
    person, concept = (F.when(ask, votes(F.col(word), F.col(context), p)).otherwise(F.lit(0)) for p in (PERSON_CONTEXTS, CONCEPT_CONTEXTS))
    out = _judged(met.withColumns({"person_votes": person, "concept_votes": concept}), word)
    found_elsewhere = F.col("source") == "wiki"  # such a word is its own name
    return out.withColumn("name", F.when(found_elsewhere, F.col(word)).otherwise(F.col("name"))).drop("_low", "alias", "entry", "ambiguous")


_inner = lambda c: c.isalnum() or c == "_"
_PATTERNS = [p.split("{name}") for p in (*PERSON_CONTEXTS, *CONCEPT_CONTEXTS)]
# "x" stands for a name, which begins and ends with a letter, digit or underscore
_BEFORE, _AFTER = [re.compile(f"(?:{before})x\\Z") for before, _ in _PATTERNS], [re.compile(f"x(?:{after})") for _, after in _PATTERNS]
#: What follows a name, as far as a pattern may look: white space and a word, an end of a possessive and the word it is in, or one character.
_FOLLOWS = re.compile(r"\s+\w*|s?'\w*|.?", re.DOTALL)
_WORD = re.compile(r"\w+")
# The words that a pattern may have right before and right after a name, and those after a name that may end another word.
_CUES_BEFORE = set("with saw called took up off drop dropped hey thank thanks son daughter kid child brother sister friend partner colleague coworker you not would could will".split())
_CUES_AFTER_END = {"of", "in", "at", "for", "to"}
_CUES_AFTER = set("said told asked laughed smiled was is called texted since again more".split()) | _CUES_AFTER_END
_PERSON = (1 << len(PERSON_CONTEXTS)) - 1


@lru_cache(4096)
def _patterns(word: str) -> list[list[re.Pattern]]:
    return [[re.compile(p.replace("{name}", re.escape(word))) for p in kind] for kind in (PERSON_CONTEXTS, CONCEPT_CONTEXTS)]


@lru_cache(1 << 16)
def _met_before(context: str) -> int:
    """The patterns, as bits, whose part before the name the context ends with."""
    return sum(1 << i for i, p in enumerate(_BEFORE) if p.search(context + "x"))


@lru_cache(1 << 16)
def _met_after(context: str) -> int:
    return sum(1 << i for i, p in enumerate(_AFTER) if p.match("x" + context))


def _before(low: str, at: int) -> str:
    """The two words before a place and the white space after each; one character where none stands before it. Empty at the line's start only."""
    begin = at
    for _ in range(2):
        end = begin
        while end and low[end - 1].isspace():
            end -= 1
        if end == begin:
            break
        begin = end
        while begin and _inner(low[begin - 1]):
            begin -= 1
        if begin == end:
            break
    return low[max(begin - 1, 0) : at]


def _line_votes(low: str, places: dict[str, list[int]]) -> dict[str, tuple[int, int]]:
    """Votes for a person and for a concept of words by all places where they stand in a line, inside other words too."""
    out = {}
    for word, ats in places.items():
        if _inner(word[0]) and _inner(word[-1]):
            bits = 0
            for at in ats:
                if after := _met_after(_FOLLOWS.match(low, at + len(word)).group()):
                    bits |= after & _met_before(_before(low, at))
            out[word] = (bits & _PERSON).bit_count(), (bits >> len(PERSON_CONTEXTS)).bit_count()
        else:  # borders of such names lie elsewhere
            out[word] = tuple(sum(p.search(low) is not None for p in kind) for kind in _patterns(word))
    return out


def _word_places(low: str, plain: set[str], ambiguous: set[str]) -> tuple[list[tuple[int, str]], dict[str, list[int]]]:
    """Words of a line that are in plain, and of the ambiguous among them the places where a pattern may hold, be they in other words."""
    met: list[tuple[int, str]] = []
    places: dict[str, list[int]] = {}
    ends: list[tuple[int, str]] = []
    asked, before, at, word, doubt = set(), "", 0, "", False
    for x in (*_WORD.finditer(low), None):
        after, begin = (x.group(), x.start()) if x else ("", len(low))
        if doubt:
            end = at + len(word)
            if after in _CUES_AFTER or before in _CUES_BEFORE or not at or low.startswith("'", end):
                places.setdefault(word, []).append(at)
        if after in _CUES_AFTER_END and word:
            ends.append((at, word))
        if word.endswith("s") and low.startswith("'", at + len(word)):
            ends.append((at, word))
        before, at, word, doubt = word, begin, after, False
        if word in plain:
            met.append((at, word))
            if word in ambiguous:
                asked.add(word)
                doubt = True
    if asked:
        for at, word in ends:
            if (most := word[:-1]) in asked:
                places.setdefault(most, []).append(at)
            for i in range(1, len(word)):
                if word[i:] in asked:
                    places.setdefault(word[i:], []).append(at + i)
    return met, places


def mentions(docs: DataFrame, entries: DataFrame, id_col: str = "id", text_col: str = "document", common: Sequence[str] = COMMON_WORDS) -> DataFrame:
    """One row per mention of an alias as whole words: id_col, line (from 0), at (place in the line), word, canonical, and what ``lookup`` says."""
    spark = docs.sparkSession
    table = _aliases(entries, common)
    known = table.limit(MAX_ALIASES + 1).toPandas()
    if len(known) > MAX_ALIASES:
        raise ValueError(f"more than {MAX_ALIASES} aliases")
    ambiguous, automaton = set(known.alias[known.ambiguous]), ahocorasick.Automaton()
    plain = {x for x in known.alias if _WORD.fullmatch(x)}
    for x in set(known.alias) - plain:
        automaton.add_word(x, len(x))
    if len(automaton):
        automaton.make_automaton()
    some, odd = len(known) > 0, len(automaton) > 0

    def in_line(line: str) -> Iterator[tuple[int, str, int, int]]:
        """Place, word and votes of each mention; a word's votes are counted once for the line, from what stands around it."""
        low = line.lower()
        if len(low) != len(line):  # letters whose lower case is longer
            low = "".join(x if len(x := c.lower()) == 1 else c for c in line)
        met, places = _word_places(low, plain, ambiguous)
        for end, size in automaton.iter(low) if odd else ():
            at = end - size + 1
            word = low[at : end + 1]
            if word in ambiguous:
                places.setdefault(word, []).append(at)
            if not ((at and _inner(low[at - 1]) and _inner(low[at])) or (end + 1 < len(low) and _inner(low[end + 1]) and _inner(low[end]))):
                met.append((at, word))
        if met:
            counted = _line_votes(low, {word: places[word] for word in {w for _, w in met} if word in places}) if places else {}
            for at, word in met:
                yield at, line[at : at + len(word)], *counted.get(word, (0, 0))

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(i, n, *m) for i, text in zip(b.i, b.t, strict=True) if text and some for n, line in enumerate(text.split("\n")) for m in in_line(line)]
            yield pd.DataFrame(out, columns=["i", "line", "at", "word", "person_votes", "concept_votes"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInPandas(found, f"i {kind}, line int, at int, word string, person_votes int, concept_votes int")
    rows = rows.withColumn("alias", F.lower("word")).join(F.broadcast(spark.createDataFrame(known, table.schema) if some else table), "alias")
    judged = _judged(rows.withColumn("canonical", F.col("entry.name")), "word")
    return judged.select(F.col("i").alias(id_col), "line", "at", "word", "canonical", "type", "name", "source", "confidence", "person_votes", "concept_votes", "decided")


def people_in(queries: DataFrame, entries: DataFrame, id_col: str = "query_id", text_col: str = "query", common: Sequence[str] = COMMON_WORDS) -> DataFrame:
    """id_col, name: the known people that a query names, by canonical name; ambiguous words count if the query's context votes for a person."""
    one_line = queries.select(id_col, F.replace(text_col, F.lit("\n"), F.lit(" ")).alias(text_col))
    m = mentions(one_line, entries.where("type = 'person'"), id_col, text_col, common)
    sure = ~F.lower("word").isin([w.lower() for w in common]) | (F.col("decided") & (F.col("type") == "person"))
    return m.where(sure).select(id_col, F.col("canonical").alias("name")).distinct()


def learned(docs: DataFrame, entries: DataFrame, least: float = 0.75, id_col: str = "id", text_col: str = "document") -> DataFrame:
    """Entries of people that texts introduce: those sure enough in a text and not known. Of several texts the surest counts, and what they saw is summed."""
    found = entities.classified(entities.scored(entities.candidates(docs, id_col, text_col), docs, id_col, text_col))
    new = found.where((F.col("type") == "person") & (F.col("confidence") >= least)).join(entries.select("name"), "name", "left_anti")
    rows = new.groupBy("name").agg(F.max("confidence").alias("confidence"), F.sum("frequency").alias("seen_count"))
    none = F.array().cast("array<string>")
    return rows.select("name", F.lit("person").alias("type"), F.lit("learned").alias("source"), "confidence", none.alias("aliases"), F.array(F.lit("personal")).alias("contexts"), "seen_count")


def merged(*entries: DataFrame) -> DataFrame:
    """Entries put together by name: what was told goes before what was learned, then the surest; aliases are united, counts summed."""
    rows = entries[0]
    for e in entries[1:]:
        rows = rows.unionByName(e)
    order = F.struct((F.col("source") == "onboarding").cast("int").alias("told"), "confidence", "type", "contexts")
    best = rows.groupBy("name").agg(
        F.max_by(F.struct("type", "source", "confidence", "contexts"), order).alias("b"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("aliases")))).alias("aliases"), F.sum("seen_count").alias("seen_count")
    )
    return best.select("name", "b.type", "b.source", "b.confidence", "aliases", "b.contexts", "seen_count")


def unknown_names(words: DataFrame, entries: DataFrame, common: Sequence[str] = COMMON_WORDS, word: str = "word") -> DataFrame:
    """Distinct capitalised words that neither the registry nor the common words have."""
    rows = words.select(word).distinct().where(F.regexp_like(word, F.lit(r"^\p{Lu}")) & ~F.lower(word).isin([w.lower() for w in common]))
    return lookup(rows, entries, common=common, word=word).where("type = 'unknown'").select(word)
