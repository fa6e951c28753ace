"""N-gram Jaccard join over word 5-grams by chosen paths.

Copies with equal word sequences are one class first. A class has a sketch of min-hash
tokens; two classes share a token with the probability of their similarity. From a root
per run, every node of the path tree samples a few token places; sets that agree there go on
together. Buckets of up to ``SMALL`` sets are compared by brute force, which bounds the work for each
set. In a larger one every member is compared with one, the pivot; if at most ``FEW`` members aren't
near it, these are compared with all, in chunks, and the bucket is done, since all others hang together by the pivot: a hot
group of near copies ends there, in work that grows with its size. Other large buckets split
again, and what is still large after ``DEPTH`` splits is compared in tiles. Runs repeat
until a pair at the threshold is missed with less than 1 - ``RECALL`` (``runs_for``).

Buckets return, of pairs whose sketches come near the threshold, only which classes hang
together. Within each such candidate group every pair of classes is then compared exactly, on
the shingles of the whole texts, in tiles of bounded bytes; a row per class with the
number of linked documents comes back, never the pairs.

Defined results: words are what white space ([\\x20\\x09-\\x0D]) separates; a text of one to four
words has them as its one shingle; shingles are compared by hashes of 64 bits; null, empty and blank texts link with nothing. Repeated rows
are separate documents and copies of each other. Null ids are allowed and stand last.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from lodestore.llm.common import pick_rows, release, stored, text_key
from lodestore.llm.components import components
from lodestore.llm.tile_dedup import local_labels

N, THRESHOLD, RECALL = 5, 0.8, 0.999
#: Token places of a sketch; places that a node samples on average; splits; bucket for brute force; rows away from a pivot; rows of a tile.
PLACES, BRANCH, DEPTH, SMALL, FEW, TILE = 64, 1.6, 4, 2048, 48, 1024
#: Standard deviations below the threshold at which a sketch still counts as near.
MARGIN = 4.0
#: Bytes of the candidates' keys up to which they are broadcast to the texts; more are joined by a shuffle.
BROADCAST_BYTES = 16 << 20
#: Bytes of text in a tile of the exact comparison.
TILE_BYTES = 4 << 20

_MUL, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_INV = np.uint64(pow(int(_MUL), -1, 1 << 64))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and the number of the text that each is in."""
    b = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    blank = (b == 32) | ((b >= 9) & (b <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank])))
    start, end = edge[::2], edge[1::2]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _powers(_MUL, len(b)))])
    words = mixed((total[end] - total[start]) * _powers(_INV, len(b))[start])
    return words, np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, "right")


def shingle_hashes(words: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' shingles, and the texts that they are in, in order; texts of fewer words have one."""
    h = np.zeros(max(0, len(words) - N + 1), np.uint64)
    for k in range(N):
        h = h * _ODD + words[k : k + len(h)]
    whole = doc[: len(h)] == doc[N - 1 :][: len(h)]
    counts = np.bincount(doc, minlength=n_docs)
    ends = np.cumsum(counts)
    short = np.flatnonzero((counts > 0) & (counts < N))
    extra = []
    for d in short:
        x = np.full(1, counts[d], np.uint64)  # an array: it wraps around silently
        for w in words[ends[d] - counts[d] : ends[d]]:
            x = x * _ODD + w
        extra.append(x[0])
    h, at = np.concatenate([h[whole], np.array(extra, np.uint64)]), np.concatenate([doc[: len(whole)][whole], short])
    order = np.argsort(at, kind="stable")
    return mixed(h[order]), at[order]


def batches_of(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    at, total = 0, 0
    for i, s in enumerate(sizes):
        if total and total + s > most:
            yield at, i
            at, total = i, 0
        total += s
    if at < len(sizes):
        yield at, len(sizes)


_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 1 << 63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, PLACES, dtype=np.uint64)


def sketches(texts: list[bytes]) -> list[tuple[bytes | None, bytes | None]]:
    """Digest of the word sequence and sketch of each text; null for texts without words."""
    out: list[tuple[bytes | None, bytes | None]] = [(None, None)] * len(texts)
    words, doc = word_hashes(texts)
    h, at = shingle_hashes(words, doc, len(texts))
    if not len(h):
        return out
    there, first = np.unique(at, return_index=True)
    mins = np.empty((len(there), PLACES), np.uint32)
    for k in range(PLACES):
        mins[:, k] = np.minimum.reduceat((h * _A[k] + _B[k]) >> np.uint64(32), first)
    ends = np.searchsorted(doc, there, "right")
    starts = np.searchsorted(doc, there, "left")
    for i, d in enumerate(there):
        out[d] = (hashlib.blake2b(words[starts[i] : ends[i]].tobytes(), digest_size=16).digest(), mins[i].tobytes())
    return out


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        texts = [(t or "").encode() for t in b.text]
        got: list = []
        for i, j in batches_of(np.array([len(t) for t in texts]), 1 << 18):
            got += sketches(texts[i:j])
        yield pd.DataFrame({"id": b.id, "row": b.row, "text_key": b.text_key, "bytes": [len(t) for t in texts], "digest": [d for d, _ in got], "sketch": [s for _, s in got]})


def runs_for(recall: float = RECALL) -> int:
    """Runs after which a pair at the threshold is missed with less than 1 - recall.

    In a run the nodes that both sets reach are a branching process with BRANCH * THRESHOLD
    children on average; it must live through the root and DEPTH more splits.
    """
    dead = 0.0
    for _ in range(DEPTH + 1):
        dead = math.exp(-BRANCH * THRESHOLD * (1 - dead))
    return math.ceil(math.log(1 - recall) / math.log(dead))


def _split(level: int, runs: int, seed: int):
    """A mapInPandas function: every row to its children (node, row, sketch)."""

    def children(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            s = np.frombuffer(b"".join(b.sketch), np.uint32).reshape(len(b), PLACES)
            for run in range(runs if level == 0 else 1):
                node = np.full(len(b), seed + run, np.uint64) if level == 0 else b.node.to_numpy().astype(np.uint64)
                for k in range(PLACES):
                    here = mixed(node * _ODD + np.uint64(k + 1))
                    picks = (here >> np.uint64(11)) < np.uint64(int(BRANCH / PLACES * 2**53))
                    if picks.any():
                        child = mixed(here[picks] ^ mixed(s[picks, k].astype(np.uint64) + np.uint64(1)))
                        yield pd.DataFrame({"node": child.astype(np.int64), "rep": b.rep[picks].to_numpy()})

    return children


def near(s: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    least = THRESHOLD - MARGIN * math.sqrt(THRESHOLD * (1 - THRESHOLD) / PLACES)
    out = np.zeros(len(i), bool)
    for k in range(0, len(i), 1 << 15):
        out[k : k + (1 << 15)] = (s[i[k : k + (1 << 15)]] == s[j[k : k + (1 << 15)]]).sum(1) >= least * PLACES
    return out


def _small_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Brute force of all buckets at once: rows at a distance of 1, 2, ... in the order by node."""
    rest = None
    for b in _with_end(batches):
        if b is None:
            if rest is not None:
                yield _compare(rest)
            return
        rest = b if rest is None else pd.concat([rest, b], ignore_index=True)
        whole = rest.node.to_numpy() != rest.node.iloc[-1]
        if whole.any():
            yield _compare(rest[whole])
            rest = rest[~whole]


def _with_end(batches):
    for b in batches:
        if len(b):
            yield b
    yield None


def _compare(t: pd.DataFrame) -> pd.DataFrame:
    t = t.sort_values(["node", "rep"])
    node, rep = t.node.to_numpy(), t.rep.to_numpy()
    s = np.frombuffer(b"".join(t.sketch), np.uint32).reshape(len(t), PLACES)
    found = [(np.zeros(0, int), np.zeros(0, int))]
    for d in range(1, len(t)):
        i = np.flatnonzero(node[:-d] == node[d:])
        if not len(i):
            break
        i = i[near(s, i, i + d)]
        found.append((i, i + d))
    return _stars(rep, found)


def _stars(rep: np.ndarray, found: list) -> pd.DataFrame:
    i, j = np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])
    label = local_labels(len(rep), i, j)
    some = label != np.arange(len(rep))
    return pd.DataFrame({"a": rep[some], "b": rep[label[some]]}).drop_duplicates()


def _tile_pair(t: pd.DataFrame) -> pd.DataFrame:
    t = t.sort_values("rep").drop_duplicates(["rep", "tile"])
    rep, tile = t.rep.to_numpy(), t.tile.to_numpy()
    s = np.frombuffer(b"".join(t.sketch), np.uint32).reshape(len(t), PLACES)
    left, right = np.flatnonzero(tile == t.lo.iloc[0]), np.flatnonzero(tile == t.hi.iloc[0])
    found = [(np.zeros(0, int), np.zeros(0, int))]
    for i in left:
        j = right[right > i] if t.lo.iloc[0] == t.hi.iloc[0] else right
        j = j[near(s, np.full(len(j), i), j)]
        found.append((np.full(len(j), i), j))
    return _stars(rep, found)


_EDGES = "a long, b long"


@F.pandas_udf(BooleanType())
def _meets(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether two sketches come near each other."""
    s = np.frombuffer(b"".join([*a, *b]), np.uint32).reshape(2 * len(a), PLACES)
    at = np.arange(len(a))
    return pd.Series(near(s, at, at + len(a)))


def _outside(t: pd.DataFrame) -> pd.DataFrame:
    """A chunk of a bucket: the rows that aren't near the pivot with all."""
    t = t.sort_values(["rep"]).drop_duplicates("rep")
    rep, s = t.rep.to_numpy(), np.frombuffer(b"".join(t.sketch), np.uint32).reshape(len(t), PLACES)
    found = [(np.zeros(0, int), np.zeros(0, int))]
    for i in np.flatnonzero(~t.near.to_numpy()):
        j = np.flatnonzero(near(s, np.full(len(t), i), np.arange(len(t))))
        found.append((np.full(len(j), i), j))
    return _stars(rep, found)


def _by_pivot(large: DataFrame, sketch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (a, b) in large buckets (node, rep, n), and the buckets' rows that these don't settle.

    The pivot is the row first by a hash that is the same in all buckets, so that the buckets of one hot group agree on it.
    """
    first = F.min(F.struct(F.xxhash64("rep").alias("h"), F.col("rep").alias("pivot"))).alias("first")
    pivots = large.groupBy("node").agg(first).select("node", F.col("first.pivot").alias("pivot"))
    pivots = pivots.join(sketch.select(F.col("rep").alias("pivot"), F.col("sketch").alias("pivot_sketch")), "pivot")
    rows = stored(large.join(sketch, "rep").join(pivots, "node").select("node", "rep", "n", "pivot", _meets("sketch", "pivot_sketch").alias("near")), "pivots")
    edges = rows.where("near AND rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b"))
    rest = stored(rows.where("NOT near").groupBy("node").agg(F.count(F.lit(1)).alias("rest")), "rest")
    chunks = F.ceil(F.col("n") / TILE).cast("int")
    few = rows.join(rest.where(F.col("rest") <= FEW).select("node"), "node", "left_semi")
    few = few.withColumn("chunk", F.when(F.col("near"), F.array(F.pmod(F.xxhash64("rep"), chunks).cast("int"))).otherwise(F.sequence(F.lit(0), chunks - 1)))
    few = few.select("node", F.explode("chunk").alias("chunk"), "rep", "near").join(sketch, "rep")
    edges = edges.unionByName(few.groupBy("node", "chunk").applyInPandas(_outside, _EDGES))
    return edges, large.join(rest.where(F.col("rest") > FEW).select("node"), "node", "left_semi")


def _bucket_edges(reps: DataFrame, seed: int, recall: float) -> DataFrame:
    """Which classes hang together by their sketches: stars of edges (a, b)."""
    runs = runs_for(recall)
    rows = reps.select("rep", "sketch").mapInPandas(_split(0, runs, seed), "node long, rep long")
    edges = sketch = None
    for level in range(DEPTH + 1):
        rows = stored(rows, "nodes")
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        live = stored(rows.join(sizes, "node"), "buckets")
        release(rows)
        if sketch is None:  # of those that met another class: the others have no link
            sketch = stored(reps.select("rep", "sketch").join(live.select("rep").distinct(), "rep", "left_semi"), "met")
        small = live.where(F.col("n") <= SMALL).select("rep", "node").join(sketch, "rep")
        new = small.repartition("node").sortWithinPartitions("node").mapInPandas(_small_buckets, _EDGES)
        large = live.where(F.col("n") > SMALL)
        none = large.isEmpty()
        if not none:
            settled, large = _by_pivot(large, sketch)
            new = new.unionByName(settled)
        if level == DEPTH and not none:
            tiles = F.ceil(F.col("n") / TILE).cast("int")
            dealt = large.withColumn("tile", F.pmod(F.xxhash64("rep"), tiles).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
            dealt = dealt.select("node", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"), "tile", "rep").join(sketch, "rep")
            new = new.unionByName(dealt.groupBy("node", "lo", "hi").applyInPandas(_tile_pair, _EDGES))
        new = stored(new.distinct(), "stars")
        edges = new if edges is None else edges.unionByName(new)
        if none or level == DEPTH:
            break
        rows = stored(large, "large").select("node", "rep").join(sketch, "rep").select("node", "rep", "sketch").mapInPandas(_split(level + 1, 1, seed), "node long, rep long").distinct()
    return edges


def exact_links(sets: list[np.ndarray], weight: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, list]:
    """Linked documents of each set, and the links, of all pairs between left and right."""
    size = np.array([len(x) for x in sets])
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(size)
    flags = np.zeros(code.max() + 1, np.int32)
    r_code = np.concatenate([code[ends[j] - size[j] : ends[j]] for j in right])
    r_first = np.concatenate([[0], np.cumsum(size[right])[:-1]])
    linked, found = np.zeros(len(sets), np.int64), [(np.zeros(0, int), np.zeros(0, int))]
    for i in left:
        mine = code[ends[i] - size[i] : ends[i]]
        flags[mine] = 1
        both = np.add.reduceat(flags[r_code], r_first)
        flags[mine] = 0
        # inter / union >= t
        j = right[both >= THRESHOLD * (size[i] + size[right] - both) - 1e-9]
        j = j[j > i] if same else j[j != i]
        linked[i] += weight[j].sum()
        linked[j] += weight[i]
        found.append((np.full(len(j), i), j))
    return linked, found


def _verify(t: pd.DataFrame) -> pd.DataFrame:
    t = t.sort_values("rep").drop_duplicates(["rep", "tile"])
    texts = [x.encode() for x in t.text]
    h, at = shingle_hashes(*word_hashes(texts), len(texts))
    ends = np.searchsorted(at, np.arange(len(texts)), "right")
    sets = [np.unique(h[(ends[i - 1] if i else 0) : ends[i]]) for i in range(len(texts))]
    tile, lo, hi = t.tile.to_numpy(), t.lo.iloc[0], t.hi.iloc[0]
    left, right = np.flatnonzero(tile == lo), np.flatnonzero(tile == hi)
    rep = t.rep.to_numpy()
    if not len(left) or not len(right):
        return pd.DataFrame({"rep": rep[:0], "linked": rep[:0], "root": rep[:0]})
    linked, found = exact_links(sets, t.n.to_numpy(), left, right, lo == hi)
    label = local_labels(len(t), np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found]))
    some = linked > 0
    return pd.DataFrame({"rep": rep[some], "linked": linked[some], "root": rep[label[some]]})


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Groups (comp, lo, hi) of a sorted partition, one after the other."""
    rest = None
    for b in _with_end(batches):
        if b is not None:
            rest = b if rest is None else pd.concat([rest, b], ignore_index=True)
        if rest is None:
            return
        key = rest.comp.astype(str) + ":" + rest.lo.astype(str) + ":" + rest.hi.astype(str)
        whole = key != key.iloc[-1] if b is not None else pd.Series(True, index=rest.index)
        outs = [_verify(g) for _, g in rest[whole].groupby(key[whole], sort=False)]
        if outs:
            yield pd.concat(outs, ignore_index=True)
        rest = rest[~whole].reset_index(drop=True)


def _classes(docs: DataFrame, id_col: str, text_col: str, seed: int, recall: float) -> DataFrame:
    """id, row, text_key, copies, linked, comp of each row of docs; comp is null for rows without a link."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"), text_key(text_col).alias("text_key"))
    slim = stored(rows.mapInPandas(_sketch, f"id {id_type}, row long, text_key long, bytes long, digest binary, sketch binary"), "sketches")
    classes = stored(slim.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("n")), "classes")
    reps = stored(slim.select(F.col("row").alias("rep"), "id", "text_key", "bytes", "sketch").join(classes.select("rep", "n"), "rep"), "reps")
    groups = components(_bucket_edges(reps, seed, recall)).select(F.col("node").alias("rep"), F.col("component").alias("comp"))
    members = stored(groups.join(reps.drop("sketch"), "rep"), "members")
    tiles = members.groupBy("comp").agg(F.ceil(F.sum("bytes") / TILE_BYTES).cast("int").alias("tiles"))
    dealt = stored(members.join(tiles, "comp").withColumn("tile", F.pmod(F.xxhash64("rep"), "tiles").cast("int")), "dealt")
    size = dealt.agg(F.sum(F.lit(80) + F.coalesce(F.octet_length(F.col("id").cast("string")), F.lit(0)))).first()[0] or 0
    dealt = F.broadcast(dealt) if size <= BROADCAST_BYTES else dealt
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), text_key(text_col).alias("key"))
    met = texts.join(dealt, (F.col("key") == F.col("text_key")) & F.col("doc").eqNullSafe(F.col("id")))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select("comp", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"), "tile", "rep", "n", "text")
    exact = met.repartition("comp", "lo", "hi").sortWithinPartitions("comp", "lo", "hi").mapInPandas(_verified, "rep long, linked long, root long")
    exact = stored(exact, "links")
    linked = exact.groupBy("rep").agg(F.sum("linked").alias("linked"))
    comps = components(exact.select(F.col("rep").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("rep"), F.col("component").alias("comp"))
    full = classes.join(linked, "rep", "left").join(comps, "rep", "left").select("digest", "n", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("comp", "rep").alias("comp"))
    slim = slim.select("id", "row", "text_key", "digest")
    blank = slim.where(F.col("digest").isNull()).select("id", "row", "text_key", *[F.lit(None).cast("long").alias(x) for x in ("n", "linked", "comp")])
    return slim.join(full, "digest").select("id", "row", "text_key", "n", "linked", "comp").unionByName(blank)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, recall: float = RECALL) -> DataFrame:
    """One row per row of docs: id_col, class_id (smallest id of its group), n_links (other documents linked with it), kept, and its text_key."""
    rows = stored(_classes(docs, id_col, text_col, seed, recall), "rows")
    first = F.min(F.struct(F.col("id").isNull().alias("null"), "id", "row"))
    groups = rows.where(F.col("comp").isNotNull()).groupBy("comp").agg(first.alias("first"))
    out = rows.join(groups, "comp", "left")
    alone = F.col("comp").isNull()
    return out.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("n") - 1 + F.col("linked")).cast("long").alias("n_links"),
        (alone | (F.col("row") == F.col("first.row"))).alias("kept"),
        "text_key",
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, recall: float = RECALL) -> DataFrame:
    """docs with one row of each group, all columns. Of rows without words that are alike in id and text, all but one go too."""
    kept = near_copies(docs, id_col, text_col, seed, recall).where("kept").select(F.col(id_col).alias("id"), "text_key")
    return pick_rows(docs, kept, id_col, text_col)
