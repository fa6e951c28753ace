"""Periodic runs of words, by matching aligned blocks.

A run is a stretch of consecutive words with smallest period q, at least ``LEAST`` and twice q
long, that no neighbouring word extends with that period. Any run of period q holds a block of B words that starts
at a multiple of B and comes again q words later inside the run, if 2B - 1 + q is at most the
run's length. So for each power of two B the document's aligned blocks become keys of an
Aho-Corasick automaton over word numbers, which is searched over the document once; each occurrence of
a key at a distance that belongs to B seeds an extension, word by word in both directions, and what is
long enough and has no smaller period is a run. Distances that belong to B are those for which no
larger power of two would do, hence below 4B.

Keys are the first ``KEY`` words of a block at most, which finds more seeds, never fewer. Blocks whose first words don't come
again at such a distance are no keys: a hash of four words tells. A seed inside a stretch that was
extended with its distance, or inside a run whose period divides its distance, is skipped, so work is
n log n in a document's words; memory is some hundred bytes a word of the longest document.

Documents are independent rows: nothing is shuffled, and a hot source or group of copies changes nothing.
Defined results: null text counts as empty; an empty or blank text has no words and no runs, and collapses
to the empty text. Repeated rows are searched each. Rows keep their other columns; what is added is named by
parameters, and replaces columns of that name.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

#: Words of the shortest run.
LEAST = 12
#: Words of a block that its key has, at most.
KEY = 64
#: Bytes of text after which a batch goes out.
BATCH_BYTES = 8 << 20

Run = tuple[int, int, int]
RUNS = ArrayType(StructType([StructField(x, LongType(), False) for x in ("start", "length", "period")]), False)


def scales(n: int, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Block sizes for a document of n words, each with its smallest and largest distance."""
    out: dict[int, tuple[int, int]] = {}
    d = 1
    while 2 * d <= n and max(least, 2 * d) <= n:
        room = max(least, 2 * d) - d + 1  # twice B
        b = 1 << max(0, (room // 2).bit_length() - 1)
        last = d if d < least else 4 * b - 2
        lo, hi = out.get(b, (d, d))
        out[b] = (min(lo, d), max(hi, last))
        d = last + 1
    return [(b, lo, hi) for b, (lo, hi) in sorted(out.items())]


@lru_cache(4096)
def _primes(d: int) -> tuple[int, ...]:
    out, p = [], 2
    while p * p <= d:
        if d % p == 0:
            out.append(p)
            while d % p == 0:
                d //= p
        p += 1
    return (*out, d) if d > 1 else tuple(out)


def _extend(w: np.ndarray, p: int, d: int, k: int) -> tuple[int, int]:
    """The widest stretch around w[p : p + k], which comes again d later, that keeps period d."""
    i, last, step = p + k, len(w) - d, 32
    while i < last:
        j = min(i + step, last)
        other = np.flatnonzero(w[i:j] != w[i + d : j + d])
        if len(other):
            i += int(other[0])
            break
        i, step = j, min(2 * step, 1 << 16)
    s, step = p, 32
    while s > 0:
        j = max(s - step, 0)
        other = np.flatnonzero(w[j:s] != w[j + d : s + d])
        if len(other):
            s = j + int(other[-1]) + 1
            break
        s, step = j, min(2 * step, 1 << 16)
    return s, i + d


def _has_smaller_period(w: np.ndarray, s: int, d: int) -> bool:
    """Of a stretch from s with period d, at least 2d long: a smaller period would divide d."""
    return any(np.array_equal(w[s : s + d - d // r], w[s + d // r : s + d]) for r in _primes(d))


class _Again:
    """Where hashes of four consecutive words come again."""

    def __init__(self, w: np.ndarray):
        x = w.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.n = len(w)
        if self.n < 4:
            self.at = np.zeros(0, np.int64)
            return
        m = np.uint64(0xD6E8FEB86659FD93)
        h = ((x[:-3] * m + x[1:-2]) * m + x[2:-1]) * m + x[3:]
        order = np.argsort(h, kind="stable")
        same = np.diff(h[order]) == 0
        keep = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        group = np.concatenate([[0], np.cumsum(~same)])[keep]
        self.at = order[keep]
        self.key = group * (self.n + 1) + self.at

    def blocks(self, b: int, lo: int, hi: int) -> np.ndarray:
        """Multiples of b whose four words come again lo to hi words later."""
        mine = np.flatnonzero(self.at % b == 0)
        at, key = self.at[mine], self.key[mine]
        room = np.minimum(hi, self.n - at)
        fits = room >= lo
        at, key, room = at[fits], key[fits], room[fits]
        i = np.searchsorted(self.key, key + lo)
        found = i < len(self.key)
        found[found] = self.key[i[found]] <= (key + room)[found]
        return np.sort(at[found])


def find_runs(w: np.ndarray, least: int = LEAST) -> list[Run]:
    """(start, length, period) of every run of w, by start, then period."""
    n = len(w)
    if n < max(2, least):
        return []
    again = _Again(w)
    words: tuple[int, ...] = ()
    runs: list[Run] = []
    for b, lo, hi in scales(n, least):
        k = min(b, KEY)
        if b >= 4:
            at = again.blocks(b, lo, hi)
        else:  # blocks below four words: the few distances are compared
            hits = np.zeros(n, bool)
            for d in range(lo, min(hi, n - b) + 1):
                eq = w[:-d] == w[d:]
                hits[: n - d - b + 1] |= np.logical_and.reduce([eq[j : n - d - b + 1 + j] for j in range(b)])
            at = np.flatnonzero(hits)
            at = at[at % b == 0]
        at = at[at + lo + k <= n]
        if not len(at):
            continue
        words = words or tuple(w.tolist())
        runs += _search(w, words, at.tolist(), b, k, lo, hi, least, runs)
    return sorted(set(runs), key=lambda r: (r[0], r[2]))


def _search(w: np.ndarray, words: tuple[int, ...], at: list[int], b: int, k: int, lo: int, hi: int, least: int, known: list[Run]) -> list[Run]:
    """Runs whose seeds are the blocks that start in ``at``. known: those of smaller blocks."""
    numbers: dict[tuple[int, ...], int] = {}
    block_of = [numbers.setdefault(words[p : p + k], len(numbers)) for p in at]
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for key, i in numbers.items():
        automaton.add_word(key, i)
    automaton.make_automaton()
    where: list[list[int]] = [[] for _ in numbers]
    for end, i in automaton.iter(words):
        where[i].append(end - k + 1)
    inside: dict[int, list[tuple[int, int]]] = {}
    for s, length, q in known:  # such a run has the whole of a seed of a block in it
        if 2 * q <= hi:
            for p in range(-(-s // b) * b, s + length - lo - k + 1, b):
                inside.setdefault(p, []).append((q, s + length))
    done: dict[int, int] = {}
    out = []
    for p, i in zip(at, block_of, strict=True):
        places = where[i]
        around = inside.get(p, ())
        for j in range(bisect_left(places, p + lo), len(places)):
            d = places[j] - p
            if d > hi:
                break
            stop = p + d + k
            if done.get(d, 0) >= stop or any(d % q == 0 and d > q and stop <= e for q, e in around):
                continue
            s, e = _extend(w, p, d, k)
            done[d] = e
            if e - s >= max(least, 2 * d) and not _has_smaller_period(w, s, d):
                out.append((s, e - s, d))
    return out



def numbered(words: list[bytes]) -> np.ndarray:
    number: dict[bytes, int] = {}
    return np.array([number.setdefault(x, len(number)) for x in words], np.int32)


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words stay: all but those that a run has after its first period."""
    edge = np.zeros(n + 1, np.int32)
    for s, length, q in runs:
        edge[s + q] += 1
        edge[s + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def annotate(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    runs_col: str = "runs",
    collapsed_col: str = "collapsed",
    rewrite: Callable[[object, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """docs without text_col but with two columns: the runs of each text, and its words joined by one space without the repeats of any run.

    rewrite: from an id and a number of words to the places of the words that are to stand instead, or None.
    """
    kept = [f for f in docs.schema if f.name not in (text_col, runs_col, collapsed_col)]
    schema = StructType([*kept, StructField(runs_col, RUNS), StructField(collapsed_col, StringType())])
    names, has_id = [f.name for f in kept], id_col in docs.columns

    def one(text: str | None, id_: object) -> tuple[list[dict], bytes]:
        words = (text or "").encode().split()  # bytes are split at exactly the blanks that are meant
        if rewrite is not None and (places := rewrite(id_, len(words))) is not None:
            words = [words[i] for i in places.tolist()]
        runs = find_runs(numbered(words))
        if runs:
            words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs)).tolist()]
        return [{"start": s, "length": n, "period": q} for s, n, q in runs], b" ".join(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([pa.field(x, pa.int64(), False) for x in ("start", "length", "period")]))
        for b in batches:
            ids = b.column(names_in.index(id_col)) if has_id else None
            texts, at = b.column(names_in.index(text_col)), 0
            while at < b.num_rows:
                runs, texts_out, size, first = [], [], 0, at
                while at < b.num_rows and size < BATCH_BYTES:
                    r, t = one(texts[at].as_py(), ids[at].as_py() if ids is not None else None)
                    runs.append(r)
                    texts_out.append(t)
                    size += len(t)
                    at += 1
                rest = b.slice(first, at - first)
                columns = [rest.column(names_in.index(x)) for x in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(runs, kind), pa.array(texts_out, pa.string())], names=[*names, runs_col, collapsed_col])

    names_in = docs.columns
    return docs.mapInArrow(run, schema)
