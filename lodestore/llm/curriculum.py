"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight schedule over training time t in [0, 1], piecewise linear between
knots: at each time the mix takes words of the sources by their weights then. A schedule's
integral is its source's weight in all words, which gives its target, stopped at
``max_repeats`` times its size with the excess shared again by weight. A source's documents
stand in an order by hash, pass after pass; a copy whose midpoint in that stream of words
lies before the target is taken. Inverting the source's cumulative demand at the midpoint
gives the copy's position in training, and range-sorting by position gives the mix.

Running sums are taken in two levels, over buckets of the hash and then within one, so no
source, however hot, is gathered in one task. Only one row per source meets in one task.

Defined results: null text has size 0; a null source is a source, the last in order; empty
documents are in the table with taken 0 and never in the mix; repeated rows are separate rows;
an empty table gives an empty mix. Extra columns pass through ``mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestore.llm.common import fresh, stored, text_or_empty

Schedule = Sequence[tuple[float, float]]

#: The schedules (time, weight) repeat over the sources in order of their names; their integrals are 1, 2 and 3.
CURRICULUM: Sequence[Schedule] = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 3.0)), ((0.0, 4.0), (1.0, 2.0)))
#: A document is taken this often at most.
MAX_REPEATS = 3
#: Hexadecimal digits of the hash that name a bucket of a source, at least; rows of all buckets of one name, about, at most.
BUCKET_DIGITS, BUCKET_ROWS = 3, 200_000


def words(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def cumulative(schedule: Schedule) -> list[float]:
    """The integral of a schedule from 0 to each of its knots; before the first and after the last it is constant."""
    if schedule[0][0] != 0 or schedule[-1][0] != 1:
        raise ValueError("a schedule runs from 0 to 1")
    out = [0.0]
    for (t0, v0), (t1, v1) in zip(schedule[:-1], schedule[1:], strict=True):
        if t1 <= t0 or min(v0, v1) < 0:
            raise ValueError("knots rise in time, and weights aren't negative")
        out.append(out[-1] + (t1 - t0) * (v0 + v1) / 2)
    return out


def targets(sizes: DataFrame, schedules: Sequence[Schedule], max_repeats: int = MAX_REPEATS) -> DataFrame:
    """sizes (source, source_size: one row per source) with kind, the number of its schedule, and target.

    Shares again what sources over their cap leave, by weight, until none is above: the
    level at which capped and other sources together hold all words, found over the
    sources in order of cap by weight.
    """
    k = len(schedules)
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("kind", F.pmod(F.row_number().over(by_name) - 1, F.lit(k)))
    weight = F.element_at(F.array(*[F.lit(cumulative(x)[-1]) for x in schedules]), F.col("kind") + 1)
    cap = F.col("source_size").cast("double") * max_repeats
    ready = ranked.withColumns({"weight": weight, "cap": cap, "ratio": F.when(weight > 0, cap / weight).otherwise(F.lit(float("inf")))})
    every = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before, after = every.rowsBetween(Window.unboundedPreceding, -1), every.rowsBetween(0, Window.unboundedFollowing)
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = ready.withColumn("level", left / F.nullif(F.sum("weight").over(after), F.lit(0.0)))
    level = level.withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(whole))
    target = F.coalesce(F.least("cap", F.col("weight") * F.col("level")), "cap")
    return level.select("source", "source_size", "kind", target.alias("target"))


def _digits(rows: int) -> int:
    """Digits of a bucket's name: the buckets grow in number with the table. The results don't depend on it."""
    digits = BUCKET_DIGITS
    while rows > BUCKET_ROWS * 16 ** (digits - 1):
        digits += 1
    return digits


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, digits: int) -> tuple[DataFrame, dict[str, str]]:
    """docs with its size, place in the order and bucket; the names of those columns. Rows with one id, or none, are dealt by their texts."""
    name = {x: fresh(docs, x) for x in ("source_key", "bucket", "place", "tie", "size", "head", "source_size", "kind", "target", "start")}
    place = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text_or_empty(text_col).cast("binary"))).cast("binary"))
    rows = docs.withColumns({
        name["source_key"]: F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n")),
        name["size"]: words(F.col(text_col)), name["place"]: place, name["tie"]: F.xxhash64(text_or_empty(text_col)),
        name["bucket"]: F.substring(place, 1, digits),
    })
    return rows, name


def _streams(rows: DataFrame, name: dict[str, str], id_col: str, schedules: Sequence[Schedule], max_repeats: int) -> DataFrame:
    """rows with source_size, kind, target and start: words of the source before this row, in a pass."""
    key, bucket = name["source_key"], name["bucket"]
    slim = rows.select(F.col(key).alias("k"), F.col(bucket).alias("bucket"), F.col(name["size"]).alias("size")).groupBy("k", "bucket").agg(F.sum("size").alias("size"))
    sizes = slim.groupBy("k").agg(F.sum("size").alias("source_size"))
    source = F.when(F.col("k") != "n", F.substring("k", 2, 1 << 30))
    sources = targets(sizes.select(source.alias("source"), "source_size"), schedules, max_repeats)
    sources = sources.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("k"), "source_size", "kind", "target")
    before = Window.partitionBy("k").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = slim.withColumn("head", F.coalesce(F.sum("size").over(before), F.lit(0))).drop("size").join(sources, "k")
    heads = heads.select(F.col("k").alias(key), F.col("bucket").alias(bucket), *[F.col(x).alias(name[x]) for x in ("head", "source_size", "kind", "target")])
    here = Window.partitionBy(key, bucket).orderBy(name["place"], id_col, name["tie"]).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(heads, [key, bucket])
    return joined.withColumn(name["start"], F.col(name["head"]) + F.coalesce(F.sum(name["size"]).over(here), F.lit(0)))


def _copies(name: dict[str, str], max_repeats: int) -> Column:
    """Numbers of the passes in which the row is taken."""
    size, start = F.col(name["size"]), F.col(name["start"])
    middle = lambda k: k * F.col(name["source_size"]) + start + size / 2
    return F.filter(F.sequence(F.lit(0), F.lit(max_repeats - 1)), lambda k: (size > 0) & (middle(k) < F.col(name["target"])))


def _position(name: dict[str, str], copy: Column, schedules: Sequence[Schedule]) -> Column:
    """Where in training a copy stands: its source's cumulative demand inverted at its midpoint."""
    u = (copy * F.col(name["source_size"]) + F.col(name["start"]) + F.col(name["size"]) / 2) / F.col(name["target"])
    return inverse(u, F.col(name["kind"]), schedules)


def plan(docs: DataFrame, schedules: Sequence[Schedule] = CURRICULUM, max_repeats: int = MAX_REPEATS, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of docs: id, size, source_size, target, taken (words the mix takes of it, repeats counted) and position
    (of its first copy, null if none is taken), range-sorted by position; rows that aren't taken stand first."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    digits = _digits(docs.count())
    sized, name = _sized(slim, "id", "text", "source", seed, digits)
    rows = _streams(stored(sized.drop("text", "source"), "sizes"), name, "id", schedules, max_repeats)
    copies = F.size(_copies(name, max_repeats)).cast("long")
    first = F.when(copies > 0, _position(name, F.lit(0), schedules))
    rows = stored(rows.select(F.col("id").alias(id_col), "size", "source_size", "target", (copies * F.col(name["size"])).alias("taken"), first.alias("position")), "plan")
    return rows.repartitionByRange("position", id_col).sortWithinPartitions("position", id_col)


def mix(docs: DataFrame, schedules: Sequence[Schedule] = CURRICULUM, max_repeats: int = MAX_REPEATS, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", position_col: str | None = None) -> DataFrame:
    """The copies that the mix takes, all columns of docs, range-sorted by position; position_col adds it to the columns."""
    sized, name = _sized(docs, id_col, text_col, source_col, seed, _digits(docs.count()))
    rows = _streams(sized, name, id_col, schedules, max_repeats)
    k, pos = fresh(rows, "pass"), position_col or fresh(rows, "position")
    rows = rows.withColumn(k, F.explode(_copies(name, max_repeats)))
    rows = rows.withColumn(pos, _position(name, F.col(k), schedules))
    ordered = rows.repartitionByRange(pos, id_col).sortWithinPartitions(pos, id_col)
    return ordered.select(*docs.columns, *([pos] if position_col else []))


def inverse(u: Column, kind: Column, schedules: Sequence[Schedule]) -> Column:
    """The time at which a source has got the share u of its demand: the integral of its schedule inverted, exactly.

    In the segment where the integral reaches u of the whole, the weight is v + g x after x, so that v x + g x²/2 is what is left.
    """
    out = F.lit(None).cast("double")
    for k, s in enumerate(schedules):
        area = cumulative(s)
        y = u * F.lit(area[-1])
        here = F.lit(1.0)
        for (t0, v0), (t1, v1), done, upto in reversed(list(zip(s[:-1], s[1:], area[:-1], area[1:], strict=True))):
            left = y - F.lit(done)
            root = F.sqrt(F.greatest(F.lit(v0 * v0) + F.lit(2 * (v1 - v0) / (t1 - t0)) * left, F.lit(0.0)))
            x = F.when(left > 0, 2 * left / (F.lit(v0) + root)).otherwise(F.lit(0.0))
            here = F.when(y <= F.lit(upto), F.least(F.lit(t1), F.lit(t0) + x)).otherwise(here)
        out = F.when(kind == k, here).otherwise(out)
    return out
