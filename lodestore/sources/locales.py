r"""Patterns of names by language, as a table, merged by language and matched by each row's own language.

A locale is a JSON file named after its language with an ``entity`` section: ``candidate_pattern``, ``multi_word_pattern``,
``direct_address_pattern``, lists of ``person_verb_patterns``, ``pronoun_patterns``, ``dialogue_patterns``, ``project_verb_patterns`` and
``stopwords``, and ``boundary_chars``: what stands inside words of a script whose marks aren't word characters. There ``\b`` becomes a border of
those characters. ``read`` gives a row per pattern; ``merged`` puts languages together; ``names`` finds candidates in texts.

Defined results: languages are named in any case; one without a locale counts as English, and so does a null one. Null texts have no
names. A pattern table without English gives such rows no names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ENTITY = (
    "entity STRUCT<boundary_chars: STRING, candidate_pattern: STRING, multi_word_pattern: STRING, direct_address_pattern: STRING, person_verb_patterns: ARRAY<STRING>, "
    "pronoun_patterns: ARRAY<STRING>, dialogue_patterns: ARRAY<STRING>, project_verb_patterns: ARRAY<STRING>, stopwords: ARRAY<STRING>>"
)
TABLE = "lang string, kind string, place int, pattern string"
SINGLE, LISTS = ("candidate", "multi_word", "direct_address"), ("person_verb", "pronoun", "dialogue", "project_verb")
FALLBACK, LEAST = "en", 3

# What a capitalised word is in some languages, and a few words that are none.
WORDS = {
    "en": (r"[A-Z][a-z]{1,19}", r"[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+", ["the", "this", "that", "and"]),
    "de": (r"[A-ZÄÖÜ][a-zäöüß]{1,19}", r"[A-ZÄÖÜ][a-zäöüß]+(?:\s+[A-ZÄÖÜ][a-zäöüß]+)+", ["der", "die", "das", "und"]),
    "es": (r"[A-ZÁÉÍÓÚÑÜ][a-záéíóúñü]{1,19}", r"[A-ZÁÉÍÓÚÑÜ][a-záéíóúñü]+(?:\s+[A-ZÁÉÍÓÚÑÜ][a-záéíóúñü]+)+", ["el", "la", "los", "y"]),
    "fr": (r"[A-ZÀÂÄÇÉÈÊËÎÏÔÖÙÛÜŸÆŒ][a-zàâäçéèêëîïôöùûüÿæœ]{1,19}", r"[A-ZÀÂÄÇÉÈÊËÎÏÔÖÙÛÜŸÆŒ][a-zàâäçéèêëîïôöùûüÿæœ]+(?:\s+[A-ZÀÂÄÇÉÈÊËÎÏÔÖÙÛÜŸÆŒ][a-zàâäçéèêëîïôöùûüÿæœ]+)+", ["le", "la", "les", "et"]),
}


def border(chars: str) -> str:
    """A word border where words consist of the characters of a class."""
    return f"(?:(?<=[{chars}])(?=[^{chars}])|(?<=[^{chars}])(?=[{chars}])|^(?=[{chars}])|(?<=[{chars}])$)"


def _with_borders(pattern: Column, chars: Column, wrap: bool) -> Column:
    b = F.when(F.coalesce(chars, F.lit("")) == "", F.lit(r"\b")).otherwise(F.replace(F.lit(border("@")), F.lit("@"), chars))
    return F.concat(b, F.lit("("), pattern, F.lit(")"), b) if wrap else F.replace(pattern, F.lit(r"\b"), b)


def table(entities: DataFrame) -> DataFrame:
    """lang, entity -> lang, kind, place, pattern with its borders written out."""
    e = entities.select(F.lower("lang").alias("lang"), "entity.*")
    row = lambda kind, place, p: F.struct(F.lit(kind).alias("kind"), place.alias("place"), p.alias("pattern"))
    chars, zero = F.col("boundary_chars"), F.lit(0)
    single = [row(k, zero, _with_borders(F.col(f"{k}_pattern"), chars, k != "direct_address")) for k in SINGLE]
    of = lambda kind, column, change: F.transform(F.coalesce(column, F.array().cast("array<string>")), lambda p, i: row(kind, i, change(p)))
    lists = [of(k, F.col(f"{k}_patterns"), lambda p: _with_borders(p, chars, False)) for k in LISTS]
    rows = e.select("lang", F.explode(F.concat(F.array(*single), *lists, of("stopword", F.col("stopwords"), F.lower))).alias("x"))
    return rows.select("lang", "x.*").where("pattern IS NOT NULL")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The pattern table of a folder of locales; files without an entity section give no rows."""
    files = spark.read.schema(ENTITY).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder)
    return table(files.select(F.regexp_replace("_metadata.file_name", r"\.json$", "").alias("lang"), "entity").where("entity IS NOT NULL"))


def built_in(spark: SparkSession) -> DataFrame:
    """The pattern table of WORDS."""
    rows = [(lang, (None, c, m, None, None, None, None, None, stop)) for lang, (c, m, stop) in WORDS.items()]
    return table(spark.createDataFrame(rows, f"lang string, {ENTITY}"))


def merged(patterns: DataFrame, languages: Sequence[str] = (FALLBACK,)) -> DataFrame:
    """kind, place, pattern of some languages together: in the languages' order, each pattern once; stop words in their own order. English if none is known."""
    spark = patterns.sparkSession
    order = {x.lower(): i for i, x in reversed(list(enumerate(languages)))}
    asked = spark.createDataFrame([*order.items()], "lang string, nr int")
    found = patterns.join(F.broadcast(asked), "lang")
    if found.isEmpty():
        found = patterns.where(F.col("lang") == FALLBACK).withColumn("nr", F.lit(0))
    own = F.col("kind").isin(*SINGLE)  # a language's own, repeated or not
    stop = F.col("kind") == "stopword"
    once = found.groupBy("kind", "pattern", F.when(own, F.col("nr")).alias("of")).agg(F.min(F.struct("nr", "place")).alias("at"))
    order_of = Window.partitionBy("kind").orderBy(F.when(~stop, F.col("at.nr")), F.when(~stop, F.col("at.place")), "pattern")
    place = F.row_number().over(order_of) - 1
    return once.select("kind", place.alias("place"), "pattern")


def names(docs: DataFrame, patterns: DataFrame, id_col: str = "id", text_col: str = "document", lang_col: str = "lang", least: int = LEAST, phrases: bool = True) -> DataFrame:
    """id_col, lang, name, frequency: what a text holds at least so often, by the patterns and stop words of its language.

    The table of patterns is small and becomes part of the plan, a regular expression for each language.
    """
    held: dict[str, dict[str, list[str]]] = {}
    for r in patterns.where(F.col("kind").isin("candidate", "multi_word", "stopword")).orderBy("lang", "kind", "place").collect():
        held.setdefault(r.lang, {}).setdefault(r.kind, []).append(r.pattern)
    none = F.array().cast("array<string>")
    known = F.lower(lang_col).isin(*held) if held else F.lit(False)
    rows = docs.select(id_col, F.when(known, F.lower(lang_col)).otherwise(F.lit(FALLBACK)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    kinds = ("candidate", "multi_word") if phrases else ("candidate",)

    def by_lang(value) -> Column:
        out = F.when(F.lit(False), none)
        for lang, p in held.items():
            out = out.when(F.col("lang") == lang, value(p))
        return out.otherwise(none)

    found = by_lang(lambda p: F.concat(none, *[F.regexp_extract_all("_t", F.lit(f"(?U){x}"), F.lit(1)) for k in kinds for x in p.get(k, [])]))
    one = rows.select(id_col, "lang", F.explode(found).alias("name")).groupBy(id_col, "lang", "name").agg(F.count(F.lit(1)).alias("frequency")).where(F.col("frequency") >= least)
    stop = by_lang(lambda p: F.array(*[F.lit(x) for x in p.get("stopword", [])]).cast("array<string>"))
    said = F.split(F.lower("name"), r"(?U)\s+")
    return one.where((F.char_length("name") >= 2) & ~F.arrays_overlap(said, stop))
