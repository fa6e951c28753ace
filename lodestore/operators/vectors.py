"""Exact cosine search: query vectors against all rows, best k for each query.

Up to QUERIES queries go with the tasks as a matrix, and rows stay where they are. More are cut into tiles and rows into groups by
hashes of their ids, and each pair of a tile and a group meets in a task: no set of queries passes through the
driver. A batch or group gives, for each query, only its best k rows, and a window merges them.
The check for duplicates has no k: every row at the threshold or above is given.

Vectors that are null or hold a null, NaN or infinite component are near nothing, as rows and as queries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestore.schema import DimensionMismatch

#: Query vectors that go with the tasks, or are a tile; rows of a group.
QUERIES, ROWS = 4096, 16384


def dimension(rows: DataFrame, vec_col: str = "embedding") -> int | None:
    """The length of all vectors; raises where they differ."""
    low, high = rows.agg(F.min(F.size(vec_col)), F.max(F.size(vec_col))).first()
    if low != high:
        raise DimensionMismatch(f"vectors of {low} to {high} components")
    return low


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine of two array columns, in SQL only."""
    total = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return 1 - total(a, b) / F.sqrt(total(a, a) * total(b, b))


def similarity(distance: Column) -> Column:
    return F.bround(F.greatest(F.lit(0.0), 1 - distance), 3)


Pick = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


def _matrix(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """The usable vectors at length 1, and which they are."""
    some = vectors.notna().to_numpy()
    x = [np.asarray(v, np.float64) for v in vectors[some]]
    if len({len(v) for v in x}) > 1:
        raise DimensionMismatch(f"vectors of {sorted({len(v) for v in x})} components")
    m = np.stack(x) if x else np.zeros((0, 0))
    good = np.isfinite(m).all(axis=1)
    m = m[good]
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300), np.flatnonzero(some)[good]


def _met(q: np.ndarray, q_ids: np.ndarray, part: pd.DataFrame, pick: Pick) -> pd.DataFrame:
    """What pick chooses of part (i, v) for the queries, rows at a time."""
    out = []
    for at in range(0, len(part), 2048):
        some = part.iloc[at : at + 2048]
        x, which = _matrix(some.v)
        if not len(x) or not len(q):
            continue
        if x.shape[1] != q.shape[1]:
            raise DimensionMismatch(f"{x.shape[1]} components against {q.shape[1]}")
        d = 1 - q @ x.T
        i, j = pick(d)
        out.append(pd.DataFrame({"query_id": q_ids[i], "id": some.i.to_numpy()[which[j]], "distance": d[i, j]}))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"query_id": [], "id": [], "distance": []})


def _pairs(rows: DataFrame, queries: DataFrame, pick: Pick, id_col: str, vec_col: str) -> DataFrame:
    """query_id, id, distance of what pick chooses from the distances (queries by rows) of each batch."""
    kinds = {"query_id": queries.schema["query_id"].dataType, "id": rows.schema[id_col].dataType}
    schema = ", ".join([*(f"{k} {v.simpleString()}" for k, v in kinds.items()), "distance double"])
    asked = queries.select(F.col("query_id").alias("i"), F.col("embedding").alias("v"))
    r = rows.select(F.col(id_col).alias("i"), F.col(vec_col).alias("v"))
    n = asked.count()
    if n <= QUERIES:
        few = asked.toPandas()
        q, which = _matrix(few.v)
        q_ids = few.i.to_numpy()[which]

        def chosen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield _met(q, q_ids, b, pick)

        return r.mapInPandas(chosen, schema)
    tiles, groups = -(-n // QUERIES), max(1, -(-r.count() // ROWS))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    part = lambda m: F.pmod(F.xxhash64("i", "v"), F.lit(m)).cast("int")
    asked = asked.withColumn("tile", part(tiles)).withColumn("group", every(groups))
    r = r.withColumn("group", part(groups)).withColumn("tile", every(tiles))

    def met(q_part: pd.DataFrame, r_part: pd.DataFrame) -> pd.DataFrame:
        q, which = _matrix(q_part.v)
        return _met(q, q_part.i.to_numpy()[which], r_part, pick)

    return asked.groupBy("tile", "group").cogroup(r.groupBy("tile", "group")).applyInPandas(met, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.round("distance", 9), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def top_k(rows: DataFrame, queries: DataFrame, k: int, id_col: str = "id", vec_col: str = "embedding", max_distance: float | None = None) -> DataFrame:
    """queries (query_id, embedding) -> query_id, id, distance, rank (from 1; by distance, then id)."""

    def nearest(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = min(k, d.shape[1])
        return np.nonzero(d <= np.partition(d, n - 1, axis=1)[:, n - 1 : n])  # ties at the edge are for the window to settle

    found = _pairs(rows, queries, nearest, id_col, vec_col)
    if max_distance:
        found = found.where(F.col("distance") <= max_distance)
    return _ranked(found, k)


def duplicates(rows: DataFrame, queries: DataFrame, threshold: float = 0.9, k: int | None = None, id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """All rows that are at least as similar to a query as the threshold; where k is given, a report of each query's nearest k of them."""
    near = 1 - threshold + 0.001  # similarity is rounded to three places below
    found = _pairs(rows, queries, lambda d: np.nonzero(d <= near), id_col, vec_col).withColumn("similarity", F.bround(1 - F.col("distance"), 3))
    found = found.where(F.col("similarity") >= threshold)
    return found if k is None else _ranked(found, k)
