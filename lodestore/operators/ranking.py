"""Sums and ranks of scores inside a task, in the order that ranks have everywhere: score to six places, highest first, then id."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Products of postings and queries that are held at once.
PAIRS = 2_000_000


def millionths(scores: np.ndarray) -> np.ndarray:
    """scores in whole millionths, rounded as the SQL function does: half up, by the decimal digits of the double."""
    y = scores * 1e6
    out = np.floor(y + 0.5)
    for i in np.flatnonzero(np.abs(y - np.floor(y) - 0.5) <= 1e-6 + np.abs(y) * 1e-15):
        out[i] = int(Decimal(repr(float(scores[i]))).scaleb(6).to_integral_value(ROUND_HALF_UP))
    return out


def by_id(ids: pa.Array) -> np.ndarray:
    """The rows in the order of their ids, nulls first, equal ids as they come."""
    table = pa.table({"id": ids, "row": np.arange(len(ids))})
    return pc.sort_indices(table, sort_keys=[("id", "ascending"), ("row", "ascending")], null_placement="at_start").to_numpy()


def expanded(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ranges of places, the range and the place of every member."""
    of = np.repeat(np.arange(len(count)), count)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + first[of]


def pieces(sizes: np.ndarray, most: int, rows: int) -> Iterator[tuple[int, int]]:
    """Borders of runs of at most rows rows whose sizes sum to at most most, or of one row."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        to = min(max(int(np.searchsorted(ends, done + most, "right")), at + 1), at + rows, len(sizes))
        yield at, to
        at = to


def best(scores: np.ndarray, valid: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The best k valid columns of each row of scores, whose columns are in the order of ids: row, column, rank from 0, millionths.

    floor: millionths below which a row's scores don't matter.
    """
    row, column = np.nonzero(valid)
    value = millionths(scores[row, column])
    if floor is not None:
        near = value >= floor[row]
        row, column, value = row[near], column[near], value[near]
    order = np.lexsort((column, -value, row))
    row, column, value = row[order], column[order], value[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
    keep = rank < k
    return row[keep], column[keep], rank[keep], value[keep]
