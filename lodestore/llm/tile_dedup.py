"""Embedding near-dedup: int8 quantised tile products with rigorous error bounds.

Unit vectors are quantised to int8 with one scale each; the norm of what is lost bounds, per
vector, how far a quantised product may lie from the cosine. Vectors are dealt into tiles
by hash, and each pair of tiles is one group: a product of the matrices of int8 codes, scaled afterwards, rules out
all pairs that the bound keeps below the threshold, and only the others are recomputed in
double precision. A group returns a row per linked vector, its links and the smallest
id it reaches there, never the pairs; components follow from those rows.

All pairs are compared, so work grows with the square of the vectors; a tile pair's memory
doesn't grow. A vector goes to each pair that its tile is in, so there are no more tiles than ``WAYS``, enough for the cores, until
tiles of ``MOST_TILE`` vectors make more of them necessary: up to ``WAYS * MOST_TILE`` vectors what is shuffled grows as the input. Defined results: vectors that are null, empty, zero or hold a null or
non-finite component link with nothing, nor do vectors of different length or with a null
id, which are kept. Rows repeated with one id are separate vectors that link with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestore.llm.common import stored
from lodestore.llm.components import components

THRESHOLD = 0.9
#: Vectors of a tile, at least and at most; tiles of more vectors than the least that are enough for the cores; products in a block.
TILE, MOST_TILE, WAYS, BLOCK = 4096, 65_536, 16, 1 << 20
#: Links that a task holds before it folds them into labels.
LINKS = 1 << 21
#: Different lengths of vectors up to which their table is broadcast; tasks that pairs of tiles are dealt to, at most.
LENGTHS, MOST_TASKS = 1 << 16, 1 << 16


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and error norms (rounded up) of unit vectors."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    err = np.linalg.norm(x - q * scale[:, None], axis=1) * (1 + 1e-9) + 1e-12
    return q, scale, err


def _unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def linked_blocks(x: np.ndarray, y: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of the pairs of unit vectors with cosine >= threshold, block by block of x."""
    (qx, sx, ex), (qy, sy, ey) = quantise(x), quantise(y)
    # sums of products of codes are whole numbers, which these kinds hold exactly
    kind = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
    codes, worst, inverse = qy.T.astype(kind), ey.max(), 1 / sy
    block = max(1, BLOCK // len(y))
    for at in range(0, len(x), block):
        e = ex[at : at + block]
        floor = threshold - (e * (1 + worst) + worst * (1 + e) + e * worst) - 1e-6  # the least cosine of scaled codes, and a margin for the rounding of the next line
        need = ((floor / sx[at : at + block])[:, None] * inverse).astype(kind)
        i, j = np.nonzero(qx[at : at + block].astype(kind) @ codes >= need)
        for k in range(0, len(i), 1 << 16):
            ii, jj = i[k : k + (1 << 16)] + at, j[k : k + (1 << 16)]
            sure = np.einsum("ij,ij->i", x[ii], y[jj]) >= threshold
            yield ii[sure], jj[sure]


def local_labels(n: int, i: np.ndarray, j: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """For each of n places the smallest place that it reaches by the links i-j, and by those whose labels are given."""
    if label is not None:
        i, j = np.concatenate([i, np.arange(n)]), np.concatenate([j, label])
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label == before).all():
            return label


def _fold(label: np.ndarray, links: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The labels with the found links, which are added to the numbers of links."""
    if not found:
        return label
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    links += np.bincount(i, minlength=len(links)) + np.bincount(j, minlength=len(links))
    return local_labels(len(label), i, j, label)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, row and the vector's components as bytes; null for vectors that link with nothing."""
    for b in batches:
        lists = b.column(2)
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        flat = lists.flatten()
        x = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False)
        square = np.zeros(len(lists))
        if some := np.flatnonzero(sizes).tolist():
            with np.errstate(over="ignore", invalid="ignore"):
                square[some] = np.add.reduceat(x.astype(np.float64) ** 2, ends[some])
        good = np.isfinite(square) & (square > 0)
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer((ends * x.itemsize).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(x))])
        raw = pc.if_else(pa.array(good), raw, pa.scalar(None, pa.large_binary())).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), raw], names=["id", "row", "raw"])


def _tile_pair(threshold: float, kind: str):
    def linked(table: pd.DataFrame) -> pd.DataFrame:
        t = table.sort_values(["id", "row"], kind="stable")  # so that the smallest place is the smallest id
        ids, rows, tile = t.id.to_numpy(), t.row.to_numpy(), t.tile.to_numpy()
        x = _unit(np.frombuffer(b"".join(t.raw), kind).reshape(len(t), -1).astype(np.float64))
        lo, hi = t.lo.iloc[0], t.hi.iloc[0]
        left, right = np.flatnonzero(tile == lo), np.flatnonzero(tile == hi)
        links, label, found, held = np.zeros(len(t), np.int64), np.arange(len(t)), [], 0
        if len(left) and len(right):
            for i, j in linked_blocks(x[left], x[right], threshold):
                i, j = left[i], right[j]
                if lo == hi:
                    i, j = i[i < j], j[i < j]
                found.append((i, j))
                held += len(i)
                if held >= LINKS:
                    label, found, held = _fold(label, links, found), [], 0
        label = _fold(label, links, found)
        some = links > 0
        return pd.DataFrame({"row": rows[some], "id": ids[some], "links": links[some], "root": ids[label[some]]})

    return linked


def near_copies(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row per vector: id_col, n_links, component_id, kept."""
    id_type = vectors.schema[id_col].dataType.simpleString()
    double = "double" in vectors.schema[vec_col].dataType.simpleString()
    kind = "<f8" if double else "<f4"
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).withColumn("row", F.monotonically_increasing_id())

    packed = rows.select("id", "row", F.col("v").cast(f"array<{'double' if double else 'float'}>").alias("v"))
    packed = stored(packed.mapInArrow(_pack, f"id {id_type}, row long, raw binary"), "vectors")
    good = packed.where(F.col("raw").isNotNull() & F.col("id").isNotNull()).withColumn("bytes", F.octet_length("raw"))
    n = F.count(F.lit(1))
    tiles = F.least(F.ceil(n / tile), F.greatest(F.lit(WAYS), F.ceil(n / max(tile, MOST_TILE))))
    sizes = stored(good.groupBy("bytes").agg(tiles.cast("long").alias("tiles")), "sizes")
    lengths, pairs = sizes.agg(F.count(F.lit(1)), F.sum(F.col("tiles") * (F.col("tiles") + 1) / 2)).first()
    dealt = good.join(F.broadcast(sizes) if lengths <= LENGTHS else sizes, "bytes").withColumn("tile", F.pmod(F.xxhash64("row"), F.col("tiles")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    dealt = dealt.withColumns({"lo": F.least("tile", "other"), "hi": F.greatest("tile", "other")})
    # a number of partitions by the work, as sizes in bytes say little about it
    dealt = dealt.select("bytes", "lo", "hi", "tile", "id", "row", "raw").repartition(int(min(max(2 * (pairs or 0), 1), MOST_TASKS)), "bytes", "lo", "hi")
    found = dealt.groupBy("bytes", "lo", "hi").applyInPandas(_tile_pair(threshold, kind), f"row long, id {id_type}, links long, root {id_type}")
    found = stored(found, "links")
    reached = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("row").agg(F.sum("links").alias("n"))
    out = packed.select("id", "row").join(links, "row", "left").join(reached, F.col("id") == F.col("node"), "left")
    comp = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"), F.coalesce(F.col("id") == comp, F.lit(True)).alias("kept"))
