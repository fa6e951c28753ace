"""People and projects named in texts: candidates, signals, classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestore.functions.summary import STOP

# What is said and done by people, and with projects; %s stands for the name.
DIALOGUE = (r"(?m)^>\s*%s[:\s]", r"(?m)^%s:\s", r"(?m)^\[%s\]", r'"%s\s+said')
PERSON_VERBS = [
    r"\b%s\s+said\b",
    r"\b%s\s+asked\b",
    r"\b%s\s+told\b",
    r"\b%s\s+replied\b",
    r"\b%s\s+laughed\b",
    r"\b%s\s+smiled\b",
    r"\b%s\s+cried\b",
    r"\b%s\s+felt\b",
    r"\b%s\s+thinks?\b",
    r"\b%s\s+wants?\b",
    r"\b%s\s+loves?\b",
    r"\b%s\s+hates?\b",
    r"\b%s\s+knows?\b",
    r"\b%s\s+decided\b",
    r"\b%s\s+pushed\b",
    r"\b%s\s+wrote\b",
    r"\bhey\s+%s\b",
    r"\bthanks?\s+%s\b",
    r"\bhi\s+%s\b",
    r"\bdear\s+%s\b",
]
PRONOUNS = r"\b(?:she|her|hers|he|him|his|they|them|their)\b"
DIRECT = r"\bhey\s+%s\b|\bthanks?\s+%s\b|\bhi\s+%s\b"
PROJECT_VERBS = (
    r"\bbuilding\s+%s\b", r"\bbuilt\s+%s\b", r"\bship(?:ping|ped)?\s+%s\b", r"\blaunch(?:ing|ed)?\s+%s\b", r"\bdeploy(?:ing|ed)?\s+%s\b", r"\binstall(?:ing|ed)?\s+%s\b",
    r"\bthe\s+%s\s+architecture\b", r"\bthe\s+%s\s+pipeline\b", r"\bthe\s+%s\s+system\b", r"\bthe\s+%s\s+repo\b", r"\b%s\s+v\d+\b", r"\b%s\.py\b", r"\b%s-core\b", r"\b%s-local\b",
    r"\bimport\s+%s\b", r"\bpip\s+install\s+%s\b",
)
VERSIONED, CODE = r"\b%s[-v]\w+", r"\b%s\.(?:py|js|ts|yaml|yml|json|sh)\b"
LEAST, CAPS = 3, {"person": 15, "project": 10, "uncertain": 8}


def candidates(docs: DataFrame, id_col: str = "id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """id_col, name, frequency: capitalised words and phrases that a text holds ``least`` times, without stop words."""
    c = F.coalesce(F.col(text_col), F.lit(""))
    single = F.regexp_extract_all(c, F.lit(r"\b[A-Z][a-z]{1,19}\b"), F.lit(0))
    phrases = F.regexp_extract_all(c, F.lit(r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+\b"), F.lit(0))
    rows = docs.select(id_col, F.explode(F.concat(single, phrases)).alias("name"))
    rows = rows.where(~F.exists(F.split(F.lower("name"), r"\s+"), lambda w: w.isin(*STOP)))
    return rows.groupBy(id_col, "name").agg(F.count(F.lit(1)).alias("frequency")).where(F.col("frequency") >= least)


def _count(text: Column, pattern: str, name: Column) -> Column:
    """Matches of a pattern with the name in it; patterns differ by row, so the name stands between literal pieces."""
    pieces = pattern.split("%s")
    quoted = F.concat(F.lit(r"\Q"), name, F.lit(r"\E"))
    whole = [F.lit("(?i)" + pieces[0])]
    for p in pieces[1:]:
        whole += [quoted, F.lit(p)]
    return F.regexp_count(text, F.concat(*whole))


def scored(found: DataFrame, docs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """candidates with their signals: dialogue, action, pronoun, direct, project, and both scores."""
    rows = found.join(docs.select(id_col, F.col(text_col).alias("_t")), id_col)
    t, n = F.col("_t"), F.col("name")
    lines = F.split(t, "\n")
    near = F.size(F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: F.contains(F.lower(F.get(lines, i - 1)), F.lower(n)) & F.regexp_like(F.lower(F.array_join(F.slice(lines, F.greatest(i - 2, F.lit(1)), F.when(i >= 3, 5).otherwise(i + 2)), " ")), F.lit(PRONOUNS))))
    inside = lambda patterns: F.get(F.transform(F.array(t), lambda x: sum((_count(x, p, n) for p in patterns), F.lit(0))), F.lit(0))
    rows = rows.withColumns({
        "dialogue": inside(DIALOGUE), "action": inside(PERSON_VERBS), "pronoun": near, "direct": _count(t, DIRECT, n),
        "project": 2 * inside(PROJECT_VERBS) + 3 * _count(t, VERSIONED, n) + 3 * _count(t, CODE, n),
    })
    return rows.withColumn("person", 3 * F.col("dialogue") + 2 * F.col("action") + 2 * F.col("pronoun") + 4 * F.col("direct")).drop("_t")


def classified(rows: DataFrame) -> DataFrame:
    """scored rows with type and confidence: a person needs two kinds of signals."""
    total = F.col("person") + F.col("project")
    share = F.col("person") / total
    kinds = sum(((F.col(k) > 0).cast("int") for k in ("dialogue", "action", "pronoun", "direct")), F.lit(0))
    person = (share >= 0.7) & (kinds >= 2) & (F.col("person") >= 5)
    kind = F.when(total == 0, "uncertain").when(person, "person").when(share >= 0.7, "uncertain").when(share <= 0.3, "project").otherwise("uncertain")
    sure = (
        F.when(total == 0, F.least(F.lit(0.4), F.col("frequency") / 50)).when(person, F.least(F.lit(0.99), 0.5 + share * 0.5)).when(share >= 0.7, F.lit(0.4))
        .when(share <= 0.3, F.least(F.lit(0.99), 0.5 + (1 - share) * 0.5)).otherwise(F.lit(0.5))
    )
    return rows.withColumns({"type": kind, "confidence": F.bround(sure, 2)})


def detect(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """The surest people, projects and uncertain names of each text."""
    rows = classified(scored(candidates(docs, id_col, text_col), docs, id_col, text_col))
    place = F.row_number().over(Window.partitionBy(id_col, "type").orderBy(F.desc("confidence"), F.desc("frequency"), "name"))
    cap = F.when(F.col("type") == "person", CAPS["person"]).when(F.col("type") == "project", CAPS["project"]).otherwise(CAPS["uncertain"])
    return rows.withColumn("place", place).where(F.col("place") <= cap).drop("place")


def new_people(found: DataFrame, known: DataFrame, least: float = 0.7) -> DataFrame:
    """People that are sure enough and not in known (name) yet."""
    return found.where((F.col("type") == "person") & (F.col("confidence") >= least)).join(known.select("name"), "name", "left_anti")
