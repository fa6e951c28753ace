"""URL filters: given rules first, then association rules that Spark's FP-growth mines from labelled URLs.

Given rules name a host and the beginning of a path; a rule fits its host and all subdomains of it,
and of those that fit the longest wins. They are columns: no Python, no shuffle.

URLs are told apart by tokens: labels of the host, segments of the path (digits as ``#``), the
leading digit of numbers in it, names of query parameters, an extension, a fragment. FP-growth counts all combinations of
tokens with a label that hold at least ``MIN_SUPPORT`` of the labelled URLs; combinations that
predict a label with less than ``MIN_CONFIDENCE``, or no better than a part of themselves does,
are pruned. What is left stands in an inverted index from a token to the rules that hold it, which
goes to all tasks: a rule fits a URL when as many of its tokens point to it as it has. Of rules that fit, the one
with the highest confidence, then support, then fewest tokens decides; where none fits, the label that most labelled URLs have.

The rules are no more than 2^L / MIN_SUPPORT for URLs of L frequent tokens; ``judge`` raises
ValueError beyond ``MAX_RULES`` rather than send them to all tasks. All labelled URLs are counted: none are sampled.

Defined results: host and path of a null URL, or of one without ``://``, are empty; they fit no rule and have no tokens, so
they get the majority's verdict. Repeated rows count each and are judged each. Without labelled URLs the verdict is ``allow``.
Other columns pass through; columns of the names that are added are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestore.llm.common import stored

ALLOW, BLOCK = "allow", "block"
#: Share of the labelled URLs that a mined combination holds, and share of those that have the label, at least.
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.8
#: Given rules, and mined rules, at most: both go to all tasks.
MAX_GIVEN, MAX_RULES = 2_000, 200_000
#: Token sets whose verdict a task remembers.
REMEMBERED = 50_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def given_rule(host_: Column, path_: Column, rules: Iterable[tuple[str, str]]) -> tuple[Column, Column]:
    """Of (verdict, host/path) rules: text and verdict of the longest that fits, else nulls. Of equal ones the last holds."""
    latest = {text: verdict for verdict, text in rules}
    if len(latest) > MAX_GIVEN:
        raise ValueError(f"more than {MAX_GIVEN} given rules")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text in sorted(latest, key=lambda x: (len(x), x)):
        name, slash, rest = text.partition("/")
        fits = ((host_ == name) | host_.endswith(f".{name}")) & path_.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, latest[text]).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """What a URL is told by: an array without repeats."""
    u, p = F.coalesce(url, F.lit("")), path(url)
    stem = F.regexp_replace(p, r"\.\w+$", "")
    some = lambda a: F.filter(a, lambda x: x != "")
    named = lambda tag, a: F.transform(some(a), lambda x: F.concat(F.lit(f"{tag}:"), x))
    query = F.regexp_extract(u, r"^(?s:.*?)://[^?#]*\?([^#]*)", 1)
    return F.array_distinct(
        F.concat(
            named("host", F.split(host(url), r"\.")),
            named("path", F.split(F.regexp_replace(stem, "[0-9]+", "#"), "/")),
            named("lead", F.regexp_extract_all(stem, F.lit("/([0-9])[0-9]*(?=/|$)"), F.lit(1))),
            named("ext", F.array(F.regexp_extract(p, r"\.(\w+)$", 1))),
            named("query", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))),
            F.when(F.regexp_like(u, F.lit(r"^(?s:.*?)://[^#]*#")), F.array(F.lit("fragment"))).otherwise(F.array()),
        )
    )


@dataclass
class Rules:
    """Mined rules in the order in which they decide, with their inverted index."""

    found: list[tuple[frozenset[str], str, float, float]]  # tokens, label, confidence, support
    default: str
    index: dict[str, list[int]] = field(init=False)

    def __post_init__(self) -> None:
        self.index = {}
        for i, (words, *_) in enumerate(self.found):
            for w in words:
                self.index.setdefault(w, []).append(i)

    def decide(self, words: Iterable[str]) -> tuple[str, str | None]:
        """Verdict, and the rule that gives it."""
        met = Counter(i for w in set(words) for i in self.index.get(w, ()))
        first = min((i for i, n in met.items() if n == len(self.found[i][0])), default=None)
        return (self.default, None) if first is None else (self.found[first][1], " ".join(sorted(self.found[first][0])))


def pruned(rules: Iterable[tuple[frozenset[str], str, float, float]]) -> list[tuple[frozenset[str], str, float, float]]:
    """Without the rules that a part of their tokens predicts as well, in the order in which they decide."""
    out: list[tuple[frozenset[str], str, float, float]] = []
    holds: dict[tuple[str, str], list[int]] = {}
    for words, label, confidence, support in sorted(rules, key=lambda r: (len(r[0]), sorted(r[0]), r[1])):
        met = Counter(i for w in words for i in holds.get((w, label), ()))
        if any(n == len(out[i][0]) and out[i][2] >= confidence for i, n in met.items()):
            continue
        for w in words:
            holds.setdefault((w, label), []).append(len(out))
        out.append((words, label, confidence, support))
    return sorted(out, key=lambda r: (-r[2], -r[3], len(r[0]), sorted(r[0]), r[1]))


def mine(labelled: DataFrame, url_col: str = "url", label_col: str = "label", min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> Rules:
    """The rules that labelled URLs give. Rows without a label are not labelled."""
    rows = labelled.where(F.col(label_col).isNotNull()).select(tokens(F.col(url_col)).alias("t"), F.col(label_col).cast("string").alias("l"))
    items = stored(rows.select(F.concat("t", F.array(F.concat(F.lit("="), "l"))).alias("items"), "l"), "urls")
    counts = {r.l: r.n for r in items.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Rules([], ALLOW)
    default = min(counts, key=lambda x: (-counts[x], x))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items.select("items"))
    said = model.associationRules.select("antecedent", F.element_at("consequent", 1).alias("label"), "confidence", "support")
    said = said.where(F.col("label").startswith("=") & ~F.exists("antecedent", lambda x: x.startswith("=")))
    best = said.limit(MAX_RULES + 1).collect()
    if len(best) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} mined rules: raise the support")
    # rounded, as sums in other orders must not change the order of rules
    return Rules(pruned((frozenset(r.antecedent), r.label[1:], round(r.confidence, 9), round(r.support, 9)) for r in best), default)


def mined_verdict(url: Column, rules: Rules) -> Column:
    """What the mined rules say of a URL: struct(verdict, rule)."""
    kind = pa.struct([("verdict", pa.string()), ("rule", pa.string())])

    def decided(lists: pa.Array) -> pa.Array:
        remembered: dict[frozenset[str], tuple[str, str | None]] = {}
        out = []
        for words in lists.to_pylist():
            key = frozenset(w for w in words if w in rules.index)
            if key not in remembered:
                if len(remembered) >= REMEMBERED:
                    remembered.clear()
                remembered[key] = rules.decide(key)
            out.append(remembered[key])
        return pa.array([{"verdict": v, "rule": r} for v, r in out], kind)

    if not rules.found:
        return F.struct(F.lit(rules.default).alias("verdict"), F.lit(None).cast("string").alias("rule"))
    return F.arrow_udf(decided, "verdict string, rule string")(tokens(url))


def judge(urls: DataFrame, given: Iterable[tuple[str, str]], url_col: str = "url", labelled: DataFrame | None = None, label_col: str = "label") -> DataFrame:
    """urls with host, path, rule, verdict and, where mined rules decide, mined_rule.

    labelled: URLs with a label, to mine from; without it those of urls that a given rule fits, with that rule's verdict.
    """
    u, given = F.col(url_col), list(given)
    rule, verdict = given_rule(F.col("host"), F.col("path"), given)
    known = urls.withColumns({"host": host(u), "path": path(u)}).withColumns({"rule": rule, "verdict": verdict})
    rules = mine(known.where(F.col("rule").isNotNull()), url_col, "verdict") if labelled is None else mine(labelled, url_col, label_col)
    said = known.withColumn("mined_rule", mined_verdict(u, rules))
    own = F.col("rule").isNull()
    return said.withColumns({"verdict": F.when(own, F.col("mined_rule.verdict")).otherwise(F.col("verdict")), "mined_rule": F.when(own, F.col("mined_rule.rule"))})
