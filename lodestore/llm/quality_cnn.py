"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes, each marked if the four bytes from it on stand a few bytes before as well
(no short filter can learn that two places are equal), are cut into chunks of two blocks, each chunk overlapping the next by a
block, from its first byte to its last. Zeros stand before each text, so that neither marks nor
filters reach into another: a text's score is the same in any batch. Learned filters slide over the bytes with a
stride; their responses are max-pooled within each chunk. The mean and the maximum of
the chunks' pooled features give, through a logistic layer, one probability.

The network is fitted on the driver on at most ``SAMPLE`` labelled rows and ``SAMPLE_BYTES``
of their texts, balanced and chosen by a hash of their ids; scoring runs over all rows in Arrow batches, with the weights as a constant.
Ids, languages, sources and labels are never inputs.

Defined results: null text counts as empty, which is scored as one chunk of padding. Null
labels are not learned from; a document with several labels gives a row for each. Without any
label of one kind the score is the share of label 1, or 0.5. Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestore.llm.common import fresh, stored, text_or_empty

WIDTH, STRIDE, BLOCK, FILTERS = 8, 4, 256, 16
#: Labelled rows learned from, at most; score from which a text is good.
SAMPLE, CUT = 3000, 0.3
#: Bytes of the texts learned from, at most, half of them for each label.
SAMPLE_BYTES = 32 << 20
#: Bytes back within which a repetition is marked; values of a marked or unmarked byte.
LAGS, VALUES = range(3, 25), 512
#: Zeros before each text: at least a filter's width and the largest lag with its four bytes.
PAD = 32
#: Bytes laid out at once.
BATCH_BYTES = 1 << 20


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one row of marked bytes, each after PAD zeros and filled with zeros to whole blocks; the first block of each."""
    sizes = np.array([-(-(PAD + len(t)) // BLOCK) for t in texts])
    first = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(first[-1]) * BLOCK + WIDTH, np.uint8)
    for t, at in zip(texts, first[:-1], strict=True):
        out[at * BLOCK + PAD : at * BLOCK + PAD + len(t)] = np.frombuffer(t, np.uint8)
    four = np.lib.stride_tricks.as_strided(out, (len(out) - 3, 4), (1, 1)).copy().view(np.uint32)[:, 0]
    again = np.zeros(len(out), bool)
    for lag in LAGS:
        again[lag : len(four)] |= four[lag:] == four[:-lag]
    return out + 256 * (again & (out > 0)).astype(np.uint16), first


@dataclass
class Network:
    tables: np.ndarray  # (WIDTH, VALUES, FILTERS): the filters on one-hot bytes
    bias: np.ndarray
    weights: np.ndarray  # of the mean and the maximum of chunks
    shift: float

    def responses(self, data: np.ndarray) -> np.ndarray:
        """(blocks, positions of a block, FILTERS)."""
        n = (len(data) - WIDTH) // STRIDE
        out = np.repeat(self.bias[None], n, axis=0)
        for k in range(WIDTH):
            out += self.tables[k][data[k : k + n * STRIDE : STRIDE]]
        return out.reshape(-1, BLOCK // STRIDE, out.shape[1])

    def pooled(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """Per text the mean and maximum of its chunks, with what gradients need."""
        data, first = layout(texts)
        r = self.responses(data)
        best = r.argmax(1)
        blocks = np.maximum(np.take_along_axis(r, best[:, None], 1)[:, 0], 0)
        # a chunk is a block and the next one of the same text
        n = np.diff(first)
        last = np.zeros(len(blocks), bool)
        last[first[1:] - 1] = True
        nxt = np.concatenate([blocks[1:], blocks[:1]])
        from_next = (nxt > blocks) & ~last[:, None]
        chunks = np.where(from_next, nxt, blocks)
        mean = np.add.reduceat(chunks, first[:-1]) / n[:, None]
        top = np.maximum.reduceat(chunks, first[:-1])
        return np.hstack([mean, top]), data, first, best, blocks, from_next, chunks

    def scores(self, texts: list[bytes]) -> np.ndarray:
        x = (self.pooled(texts)[0] * self.weights).sum(1) + self.shift  # a matrix product's rounding depends on the number of rows
        return 1 / (1 + np.exp(-np.clip(x.astype(np.float64), -30, 30)))


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = 12, seed: int = 3) -> Network:
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.15, (WIDTH, VALUES, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32), 0.0,
    )
    share = labels.mean() if len(labels) else 0.5
    if share in (0, 1) or not len(labels):
        p = float(np.clip(share, 0.01, 0.99))
        net.weights[:], net.shift = 0, float(np.log(p / (1 - p)))
        return net
    params = {"tables": net.tables, "bias": net.bias, "weights": net.weights, "shift": np.zeros(1, np.float32)}
    m = {k: np.zeros_like(v) for k, v in params.items()}
    v2 = {k: np.zeros_like(v) for k, v in params.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), 32):
            part = order[at : at + 32]
            net.shift = float(params["shift"][0])
            g = _gradients(net, [texts[i] for i in part], labels[part])
            step += 1
            rate = 0.01 * (1 - epoch / epochs)
            for k, p in params.items():
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v2[k] = 0.99 * v2[k] + 0.01 * g[k] ** 2
                p -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-6) + rate * 1e-3 * p).astype(np.float32)
    net.shift = float(params["shift"][0])
    return net


def _gradients(net: Network, texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
    x, data, first, best, blocks, from_next, chunks = net.pooled(texts)
    p = 1 / (1 + np.exp(-np.clip(x @ net.weights + net.shift, -30, 30)))
    d = ((p - labels) / len(texts)).astype(np.float32)
    dx = d[:, None] * net.weights
    n = np.diff(first)
    text_of = np.repeat(np.arange(len(texts)), n)
    dchunks = (dx[:, :FILTERS] / n[:, None])[text_of]
    top = chunks == x[text_of, FILTERS:]
    dchunks += np.where(top, dx[text_of, FILTERS:] / np.maximum(1, np.add.reduceat(top, first[:-1], dtype=np.float32))[text_of], 0)
    dblocks = np.where(from_next, 0, dchunks)
    dblocks[1:] += np.where(from_next, dchunks, 0)[:-1]
    dblocks[blocks <= 0] = 0
    b, f = np.nonzero(dblocks)
    g = dblocks[b, f]
    place = b * BLOCK + best[b, f] * STRIDE
    dt = np.zeros((WIDTH, VALUES * FILTERS))
    for k in range(WIDTH):
        dt[k] = np.bincount(data[place + k].astype(np.int64) * FILTERS + f, g, VALUES * FILTERS)
    return {
        "tables": dt.reshape(WIDTH, VALUES, FILTERS).astype(np.float32), "bias": np.bincount(f, g, FILTERS).astype(np.float32),
        "weights": x.T @ d, "shift": np.array([d.sum()], np.float32),
    }


def sample(docs: DataFrame, labels: DataFrame, learn_from: Column, label_col: str, id_col: str, text_col: str, most: int) -> tuple[list[bytes], np.ndarray, float]:
    """Texts and labels of at most ``most`` rows, half of them of each label where there are enough, the first by a hash of
    the id; the share of label 1 among all that may be learned from. Of rows with one id the smallest text counts."""
    known = labels.where(learn_from & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    halves = [known.where(F.col("label") == x).orderBy(F.xxhash64("id"), "id").limit(most // 2) for x in (0, 1)]
    chosen = halves[0].unionByName(halves[1]).distinct()
    rows = docs.select(F.col(id_col).alias("doc"), text_or_empty(text_col).alias("text")).join(F.broadcast(chosen), F.col("doc") == F.col("id"))
    rows = stored(rows.groupBy("id", "label").agg(F.min("text").alias("text")), "sample")
    left, kept = {0: SAMPLE_BYTES // 2, 1: SAMPLE_BYTES // 2}, {}
    for x in sorted(rows.select("id", "label", F.octet_length("text").alias("bytes"), F.xxhash64("id").alias("hash")).collect(), key=lambda x: (x.hash, str(x.id))):
        if x.bytes <= left[x.label]:  # one that doesn't fit costs only itself
            left[x.label] -= x.bytes
            kept[x.id, x.label] = len(kept)
    got = sorted(((kept[x.id, x.label], x.text.encode(), x.label) for x in rows.toLocalIterator() if (x.id, x.label) in kept), key=lambda x: x[0])
    share = known.agg(F.avg("label")).first()[0]
    return [t for _, t, _ in got], np.array([y for _, _, y in got], np.float32), 0.5 if share is None else share


def learn(docs: DataFrame, labels: DataFrame, learn_from: Column, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE) -> Network:
    """The network fitted on labels where learn_from, a condition on the columns of labels, holds."""
    texts, marks, share = sample(docs, labels, learn_from, label_col, id_col, text_col, most)
    net = fit(texts, marks)
    if 0 < share < 1 and 0 < marks.sum() < len(marks):  # the sample is balanced, the corpus isn't
        drawn = float(marks.mean())
        net.shift += float(np.log(share / (1 - share)) - np.log(drawn / (1 - drawn)))
    return net


def score(docs: DataFrame, net: Network, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with the probability that a text is good."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        out: list[np.ndarray] = []
        part: list[bytes] = []
        size = 0
        for t in texts:
            b = (t or "").encode()
            if part and size + len(b) > BATCH_BYTES:
                out.append(net.scores(part))
                part, size = [], 0
            part.append(b)
            size += len(b) + BLOCK
        if part:
            out.append(net.scores(part))
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return docs.withColumn(score_col, scored(F.col(text_col)))


def keep_good(docs: DataFrame, net: Network, text_col: str = "text", cut: float = CUT) -> DataFrame:
    s = fresh(docs, "score")
    return score(docs, net, text_col, s).where(F.col(s) >= cut).drop(s)
