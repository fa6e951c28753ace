"""A deterministic embedder without a model: hashed words, weighted by counts, of unit length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestore.operators.bm25 import tokens

DIMENSION = 384


def embed(text: str | Column, dimension: int = DIMENSION) -> Column:
    """array<float>: each word adds a sign at a hashed place; the zero vector for a text without words."""
    words = F.array_sort(F.transform(tokens(text), lambda t: F.struct(F.pmod(F.xxhash64(t), F.lit(dimension)).cast("int").alias("at"), F.when(F.bitwise_not(F.xxhash64(t)) % 2 == 0, 1.0).otherwise(-1.0).alias("v"))))
    zero = F.array_repeat(F.lit(0.0), dimension)
    put = F.aggregate(words, zero, lambda a, w: F.concat(F.slice(a, 1, w["at"]), F.array(F.get(a, w["at"]) + w["v"]), F.slice(a, w["at"] + 2, dimension)))
    norm = lambda a: F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))
    unit = F.get(F.transform(F.array(put), lambda a: F.transform(a, lambda x: F.when(norm(a) > 0, x / norm(a)).otherwise(0.0))), F.lit(0))
    return unit.cast("array<float>")
