"""Near-copy removal within a source, audits, pivots, samples."""

from __future__ import annotations



import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Vectors of a source that are a tile, where pairs are counted.
PAIR_TILE = 8192


def near_duplicates(chunks: DataFrame, max_distance: float = 0.15, least_chars: int = 20, least_group: int = 5) -> DataFrame:
    """id, source_file, kept: longest first, a chunk goes if short or near a kept one of its source.

    The rule is greedy, so a source is one group; groups under ``least_group`` stay as they are.
    """
    sizes = chunks.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    rows = chunks.join(sizes, "source_file")
    id_type = chunks.schema["id"].dataType.simpleString()
    src_type = chunks.schema["source_file"].dataType.simpleString()

    def greedy(t: pd.DataFrame) -> pd.DataFrame:
        t = t.assign(n=t.document.fillna("").str.len()).sort_values(["n", "id"], ascending=[False, True])
        x = np.stack([np.asarray(v, np.float64) for v in t.embedding])
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        kept: list[int] = []
        flags = []
        for i, n in enumerate(t.n):
            good = n >= least_chars and not (kept and (1 - x[kept] @ x[i] < max_distance).any())
            flags.append(good)
            if good:
                kept.append(i)
        return pd.DataFrame({"id": t.id, "source_file": t.source_file, "kept": flags})

    large = rows.where(F.col("n") >= least_group).select("id", "source_file", "document", "embedding")
    out = large.groupBy("source_file").applyInPandas(greedy, f"id {id_type}, source_file {src_type}, kept boolean")
    return out.unionByName(rows.where(F.col("n") < least_group).select("id", "source_file", F.lit(True).alias("kept")))


def near_pairs(rows: DataFrame, max_distance: float, source_col: str = "source_file", id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """source_file, pairs: how many pairs of different ids of a source are nearer than max_distance; sources without any are left out.

    A source's vectors are dealt into tiles, and each two tiles meet in a task. Distances so near to the limit that the order of the sum
    may tell are summed again one component after the other. Vectors that are null, zero or hold nulls or NaN are near nothing.
    """
    v = rows.select(F.col(source_col).alias("source"), F.col(id_col).alias("i"), F.col(vec_col).cast("array<double>").alias("v"))
    v = v.where("source IS NOT NULL AND i IS NOT NULL AND size(v) > 0").where(~F.exists("v", lambda x: x.isNull())).withColumn("width", F.size("v"))
    sizes = v.groupBy("source", "width").agg(F.ceil(F.count(F.lit(1)) / PAIR_TILE).cast("long").alias("tiles"))
    dealt = v.join(sizes, ["source", "width"]).withColumn("tile", F.pmod(F.xxhash64("i", "v"), F.col("tiles")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).withColumns({"lo": F.least("tile", "other"), "hi": F.greatest("tile", "other")})

    def counted(t: pd.DataFrame) -> pd.DataFrame:
        x, place, tile = np.stack(t.v.to_numpy()).astype(np.float64), np.unique(t.i.to_numpy(), return_inverse=True)[1], t.tile.to_numpy()
        left, right, one = np.flatnonzero(tile == t.lo.iloc[0]), np.flatnonzero(tile == t.hi.iloc[0]), t.lo.iloc[0] == t.hi.iloc[0]
        pairs = 0
        with np.errstate(all="ignore"):
            total, y = np.einsum("ij,ij->i", x, x), x[right].T
            for at in range(0, len(left), 256):
                some = left[at : at + 256]
                far = 1 - (x[some] @ y) / np.sqrt(total[some][:, None] * total[right])
                a, b = np.nonzero(np.abs(far - max_distance) < 1e-9)
                far[a, b] = _summed_distance(x[some[a]], x[right[b]])
                p, q = place[some][:, None], place[right]
                pairs += int(((far < max_distance) & np.isfinite(far) & ((p < q) if one else (p != q))).sum())
        return pd.DataFrame({"source": t.source.iloc[:1], "pairs": [pairs]})

    kind = v.schema["source"].dataType.simpleString()
    met = dealt.groupBy("source", "width", "lo", "hi").applyInPandas(counted, f"source {kind}, pairs long")
    return met.groupBy(F.col("source").alias("source_file")).agg(F.sum("pairs").alias("pairs")).where("pairs > 0")


def _summed_distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine distances of rows, summed from the first component to the last."""
    a, b, c = (np.add.accumulate(p * q, axis=1)[:, -1] for p, q in ((x, y), (x, x), (y, y)))
    return 1 - a / np.sqrt(b * c)


def parity(src: DataFrame, dst: DataFrame, columns: list[str], vec_col: str | None = None, tolerance: float = 1e-6) -> DataFrame:
    """id and state of every row in which two stores differ: missing, phantom, or the columns that differ."""
    a = src.select("id", F.struct(*columns, *([vec_col] if vec_col else [])).alias("a"))
    b = dst.select("id", F.struct(*columns, *([vec_col] if vec_col else [])).alias("b"))
    both = a.join(b, "id", "full_outer")
    wrong = [F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in columns]
    if vec_col:
        delta = F.array_max(F.zip_with(F.col(f"a.{vec_col}"), F.col(f"b.{vec_col}"), lambda x, y: F.abs(x - y)))
        wrong.append(F.when((delta > tolerance) | (F.size(F.col(f"a.{vec_col}")) != F.size(F.col(f"b.{vec_col}"))), F.lit(vec_col)))
    state = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "phantom").otherwise(F.array_join(F.filter(F.array(*wrong), lambda x: x.isNotNull()), ","))
    return both.select("id", state.alias("state")).where(F.col("state") != "")


def unfetchable(listed: DataFrame, fetched: DataFrame) -> DataFrame:
    """Ids that are listed but can't be read."""
    return listed.select("id").distinct().join(fetched.select("id"), "id", "left_anti")


def eav_pivot(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows (id, key, string_value, int_value, float_value, bool_value) as a column per key, text."""
    value = F.coalesce("string_value", F.col("int_value").cast("string"), F.col("float_value").cast("string"), F.col("bool_value").cast("string"))
    return rows.groupBy("id").agg(*[F.max(F.when(F.col("key") == k, value)).alias(k) for k in keys])


def eav_map(rows: DataFrame) -> DataFrame:
    value = F.coalesce("string_value", F.col("int_value").cast("string"), F.col("float_value").cast("string"), F.col("bool_value").cast("string"))
    return rows.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("key", value.alias("value")))).alias("metadata"))


def evenly_spaced(rows: DataFrame, n: int) -> DataFrame:
    """n rows at even steps in the order of id, the first and the last among them."""
    total = rows.count()
    if total <= n:
        return rows
    step = (total - 1) / max(1, n - 1)
    wanted = sorted({round(i * step) + 1 for i in range(n)})
    return rows.withColumn("_k", F.row_number().over(Window.orderBy("id"))).where(F.col("_k").isin(wanted)).drop("_k")


def greedy_pack(lines: DataFrame, most: int = 1500) -> DataFrame:
    """lines (source_file, line_no, line) with pack_no: whole lines fill a pack up to ``most`` characters, then the next."""
    per = lines.groupBy("source_file").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("ls"))
    state = F.struct(F.lit(0).alias("used"), F.lit(1).alias("pack"), F.array().cast("array<int>").alias("packs"))

    def put(s, x):
        n = F.char_length(x["line"]) + 1
        over = (s["used"] > 0) & (s["used"] + n > most)
        pack = F.when(over, s["pack"] + 1).otherwise(s["pack"])
        return F.struct(F.when(over, n).otherwise(s["used"] + n).alias("used"), pack.alias("pack"), F.concat(s["packs"], F.array(pack)).alias("packs"))

    packs = per.withColumn("p", F.aggregate("ls", state, put, lambda s: s["packs"]))
    return packs.select("source_file", F.explode(F.arrays_zip("ls", "p")).alias("z")).select("source_file", "z.ls.line_no", "z.ls.line", F.col("z.p").alias("pack_no"))
