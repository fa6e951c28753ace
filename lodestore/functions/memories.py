"""Typed memories from prose: decisions, preferences, milestones, problems and emotions, scored by markers."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestore import scratch
from lodestore.functions.text import strip

# The markers of each type, in the order that settles ties.
MARKERS: dict[str, tuple[str, ...]] = {
    "decision": (
        r"\blet'?s (use|go with|try|pick|choose|switch to)\b", r"\bwe (should|decided|chose|went with|picked|settled on)\b", r"\bi'?m going (to|with)\b",
        r"\bbetter (to|than|approach|option|choice)\b", r"\binstead of\b", r"\brather than\b", r"\bthe reason (is|was|being)\b", r"\bbecause\b",
        r"\btrade-?off\b", r"\bpros and cons\b", r"\bover\b.*\bbecause\b", r"\barchitecture\b", r"\bapproach\b", r"\bstrategy\b", r"\bpattern\b",
        r"\bstack\b", r"\bframework\b", r"\binfrastructure\b", r"\bset (it |this )?to\b", r"\bconfigure\b", r"\bdefault\b",
    ),
    "preference": (
        r"\bi prefer\b", r"\balways use\b", r"\bnever use\b", r"\bdon'?t (ever |like to )?(use|do|mock|stub|import)\b", r"\bi like (to|when|how)\b",
        r"\bi hate (when|how|it when)\b", r"\bplease (always|never|don'?t)\b", r"\bmy (rule|preference|style|convention) is\b", r"\bwe (always|never)\b",
        r"\bfunctional\b.*\bstyle\b", r"\bimperative\b", r"\bsnake_?case\b", r"\bcamel_?case\b", r"\btabs\b.*\bspaces\b", r"\bspaces\b.*\btabs\b",
        r"\buse\b.*\binstead of\b",
    ),
    "milestone": (
        r"\bit works\b", r"\bit worked\b", r"\bgot it working\b", r"\bfixed\b", r"\bsolved\b", r"\bbreakthrough\b", r"\bfigured (it )?out\b",
        r"\bnailed it\b", r"\bcracked (it|the)\b", r"\bfinally\b", r"\bfirst time\b", r"\bfirst ever\b", r"\bnever (done|been|had) before\b",
        r"\bdiscovered\b", r"\brealized\b", r"\bfound (out|that)\b", r"\bturns out\b", r"\bthe key (is|was|insight)\b", r"\bthe trick (is|was)\b",
        r"\bnow i (understand|see|get it)\b", r"\bbuilt\b", r"\bcreated\b", r"\bimplemented\b", r"\bshipped\b", r"\blaunched\b", r"\bdeployed\b",
        r"\breleased\b", r"\bprototype\b", r"\bproof of concept\b", r"\bdemo\b", r"\bversion \d", r"\bv\d+\.\d+",
        r"\d+x (compression|faster|slower|better|improvement|reduction)", r"\d+% (reduction|improvement|faster|better|smaller)",
    ),
    "problem": (
        r"\b(bug|error|crash|fail|broke|broken|issue|problem)\b", r"\bdoesn'?t work\b", r"\bnot working\b", r"\bwon'?t\b.*\bwork\b",
        r"\bkeeps? (failing|crashing|breaking|erroring)\b", r"\broot cause\b", r"\bthe (problem|issue|bug) (is|was)\b",
        r"\bturns out\b.*\b(was|because|due to)\b", r"\bthe fix (is|was)\b", r"\bworkaround\b", r"\bthat'?s why\b", r"\bthe reason it\b",
        r"\bfixed (it |the |by )\b", r"\bsolution (is|was)\b", r"\bresolved\b", r"\bpatched\b", r"\bthe answer (is|was)\b", r"\b(had|need) to\b.*\binstead\b",
    ),
    "emotional": (
        r"\blove\b", r"\bscared\b", r"\bafraid\b", r"\bproud\b", r"\bhurt\b", r"\bhappy\b", r"\bsad\b", r"\bcry\b", r"\bcrying\b", r"\bmiss\b",
        r"\bsorry\b", r"\bgrateful\b", r"\bangry\b", r"\bworried\b", r"\blonely\b", r"\bbeautiful\b", r"\bamazing\b", r"\bwonderful\b", r"i feel",
        r"i'm scared", r"i love you", r"i'm sorry", r"i can't", r"i wish", r"i miss", r"i need", r"never told anyone", r"nobody knows", r"\*[^*]+\*",
    ),
}
# What a problem that is over says, words of a good and of a bad mood, the starts of a turn, and lines that are code.
RESOLVED: tuple[str, ...] = (
    r"\bfixed\b", r"\bsolved\b", r"\bresolved\b", r"\bpatched\b", r"\bgot it working\b", r"\bit works\b", r"\bnailed it\b",
    r"\bfigured (it )?out\b", r"\bthe (fix|answer|solution)\b",
)
POSITIVE = ("pride", "proud", "joy", "happy", "love", "loving", "beautiful", "amazing", "wonderful", "incredible", "fantastic", "brilliant", "perfect", "excited", "thrilled", "grateful", "warm", "breakthrough", "success", "works", "working", "solved", "fixed", "nailed", "heart", "hug", "precious", "adore")
NEGATIVE = ("bug", "error", "crash", "crashing", "crashed", "fail", "failed", "failing", "failure", "broken", "broke", "breaking", "breaks", "issue", "problem", "wrong", "stuck", "blocked", "unable", "impossible", "missing", "terrible", "horrible", "awful", "worse", "worst", "panic", "disaster", "mess")
TURNS: tuple[str, ...] = (r">\s", r"(?i:human|user|q)\s*:", r"(?i:assistant|ai|a|claude|chatgpt)\s*:")
CODE: tuple[str, ...] = (
    r"^[\$#]\s",
    r"^(cd|source|echo|export|pip|npm|git|python|bash|curl|wget|mkdir|rm|cp|mv|ls|cat|grep|find|chmod|sudo|brew|docker)\s",
    r"^(import|from|def|class|function|const|let|var|return)\s",
    r"^[A-Z_]{2,}=",
    r"^\|",
    r"^[-]{2,}",
    r"^[{}\[\]]\s*$",
    r"^(if|for|while|try|except|elif|else:)\b",
    r"^\w+\.\w+\(",
    r"^\w+ = \w+\.\w+",
)
LEAST_CHARS, LEAST_CONFIDENCE = 20, 0.3
#: Share of letters below which a line is code, if it has more characters than that.
CODE_LETTERS, CODE_CHARS = 0.4, 10
#: Bytes of memories of distinct texts that go to all tasks.
BROADCAST_BYTES = 16 << 20


def segments(text: Column) -> Column:
    """A text with three or more speakers' turns by turns; else paragraphs; a text of one paragraph and over 20 lines in groups of 25 lines."""
    turn = rf"[^\S\n]*(?:{'|'.join(TURNS)})[^\S\n]*"
    by_turn = F.split(text, rf"\n(?={turn})")
    paras = F.filter(F.transform(F.split(text, "\n\n"), strip), lambda p: p != "")
    lines = F.split(text, "\n")
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / 25).cast("int")), lambda i: strip(F.array_join(F.slice(lines, i * 25 + 1, 25), "\n")))
    grouped = F.filter(groups, lambda g: g != "")
    return F.when(F.regexp_count(text, F.lit(rf"(?m)^{turn}")) >= 3, by_turn).when((F.size(paras) <= 1) & (F.size(lines) > 20), grouped).otherwise(paras)


def is_code(line: Column) -> Column:
    """Whether a line, without white space around it, looks like code."""
    letters = F.regexp_count(line, F.lit(r"\p{L}")) / F.greatest(F.char_length(line), F.lit(1))
    few = (letters < CODE_LETTERS) & (F.char_length(line) > CODE_CHARS)
    # a constant pattern is compiled once; one that comes from an array, for each line
    return reduce(or_, [F.regexp_like(line, F.lit(c)) for c in CODE]) | few


def prose(text: Column) -> Column:
    """The lines that aren't code, fenced or by their looks; the text itself if none is left."""
    outside = F.filter(F.split(text, r"(?m)^[^\S\n]*```[^\n]*(?:\n|\z)"), lambda _, i: i % 2 == 0)  # fences alternate
    lines = F.filter(F.split(F.array_join(outside, ""), "\n"), lambda line: ~is_code(strip(line)))
    left = strip(F.array_join(lines, "\n"))
    return F.when(left != "", left).otherwise(text)


def score(text: Column, kind: str) -> Column:
    """Matches of all markers. Inside a lambda, as so many patterns are too much for one generated method."""
    return F.get(F.transform(F.array(F.lower(text)), lambda low: sum((F.regexp_count(low, F.lit(m)) for m in MARKERS[kind]), F.lit(0))), F.lit(0))


def _sentiment(text: Column) -> Column:
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\w+"), F.lit(0)))
    has = lambda names: F.size(F.array_intersect(words, F.array(*[F.lit(n) for n in names])))
    return has(POSITIVE) - has(NEGATIVE)


def classified(rows: DataFrame, text_col: str = "content") -> DataFrame:
    """rows with memory_type (null if none) and confidence."""
    c = F.col(text_col)
    kinds = list(MARKERS)
    said = rows.withColumn("_prose", prose(c))
    p = F.col("_prose")
    scored = said.withColumns({f"_{k}": score(p, k) for k in kinds} | {"_mood": _sentiment(p)})
    most = F.greatest(*[F.col(f"_{k}") for k in kinds])
    first = F.when(most == 0, None)
    for k in kinds:
        first = first.when(F.col(f"_{k}") == most, k)
    bonus = F.when(F.char_length(c) > 500, 2).when(F.char_length(c) > 200, 1).otherwise(0)
    scored = scored.withColumns({"_first": first, "confidence": F.least(F.lit(1.0), (most + bonus) / 5.0)})
    happy = F.col("_mood") > 0
    solved = F.regexp_like(F.lower(p), F.lit("|".join(RESOLVED)))
    problem = F.col("_first") == "problem"
    kind = (
        F.when(problem & solved & (F.col("_emotional") > 0) & happy, "emotional").when(problem & solved, "milestone")
        .when(problem & happy & (F.col("_milestone") > 0), "milestone").when(problem & happy & (F.col("_emotional") > 0), "emotional").otherwise(F.col("_first"))
    )
    kept = (F.char_length(strip(c)) >= LEAST_CHARS) & (F.col("confidence") >= LEAST_CONFIDENCE)
    return scored.withColumn("memory_type", F.when(kept, kind)).drop(*[f"_{k}" for k in kinds], "_mood", "_first", "_prose")


def extract(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """id, segment, content, memory_type, confidence of the segments that hold a memory. Equal texts are read once."""
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    key = F.sha2(F.col("_text").cast("binary"), 256).alias("_key")
    parts = rows.select("_text").distinct().select(key, F.posexplode(segments(F.col("_text"))).alias("segment", "content"))
    said = classified(parts).withColumn("content", strip("content"))
    # exploded, not filtered: Spark would put the whole of the type's expression, with all that it repeats, into the filter
    kind = F.explode(F.when(F.col("memory_type").isNotNull(), F.array("memory_type")))
    said = scratch.written(said.select("_key", "segment", "content", "confidence", kind.alias("memory_type")), f"{scratch.folder(docs.sparkSession)}/memories")
    size = said.agg(F.sum(F.octet_length("content") + 100)).first()[0] or 0
    return rows.select(id_col, key).join(F.broadcast(said) if size <= BROADCAST_BYTES else said, "_key").drop("_key")
