"""Language identification by string kernels.

The kernel of two texts is the blended spectrum of n-gram presence: for n = 1, 2, 3, how many
byte n-grams both hold, normalised to 1 for a text with itself, and averaged over n. Landmarks
drawn from the training texts give a Nyström map of the kernel; on it, one-versus-rest kernel
ridge regression is fitted for each language. Scoring is batched: presence rows times the
landmarks' presence, then times the folded map and regression.

Learns on the driver from at most ``PER_LANG`` texts of each of at most ``LANGS`` languages, by a
hash of the text; scores all rows in Arrow batches, over whole texts. Ids, sources and
labels are never inputs. N-grams of three bytes are hashed to 2**16 places.

Defined results: null texts and those without a letter are ``und`` with score 0. Null languages
are not learned from; without any to learn, all texts are ``und``. Repeated rows are alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestore.llm.common import fresh, stored

#: Texts of a language learned from, landmarks of a language and languages, at most.
PER_LANG, LANDMARKS, LANGS = 150, 24, 200
#: Rows, of a language and a number, up to which the table of languages goes to all tasks.
BROADCAST_LANGS = 100_000
RIDGE = 1e-2
#: Bytes of the texts learned from, at most, but for one text of each language.
SAMPLE_BYTES = 64 << 20
#: Rows of a batch; bytes looked at in one go.
ROWS, PIECE = 64, 1 << 20
SPANS = (0, 256, 256 + 65536)
WIDTH = 256 + 65536 + 65536


def places(text: bytes) -> np.ndarray:
    """Where in a presence row the n-grams of a text stand, repeated as they are."""
    b = np.frombuffer(text, np.uint8).astype(np.int32)
    two = (b[:-1] << 8) | b[1:]
    three = (((two[:-1] << 8) | b[2:]).astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(16)
    return np.concatenate([b, two + SPANS[1], three.astype(np.int32) + SPANS[2]])


def presence(texts: list[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), WIDTH), np.uint8)
    for row, t in zip(out, texts, strict=True):
        for at in range(0, max(1, len(t)), PIECE):
            row[places(t[at : at + PIECE + 2])] = 1
    return out


def _norms(p: np.ndarray) -> list[np.ndarray]:
    ends = [*SPANS[1:], WIDTH]
    return [np.sqrt(np.maximum(1, p[:, a:b].sum(1, dtype=np.int64))) for a, b in zip(SPANS, ends, strict=True)]


@dataclass
class Model:
    langs: list[str]
    used: list[np.ndarray]  # for each n, the places that landmarks hold
    marks: list[np.ndarray]  # for each n, the landmarks' presence there, normalised: (places, landmarks)
    head: np.ndarray  # (landmarks, languages): Nyström map and regression in one
    shift: np.ndarray

    def kernel(self, p: np.ndarray) -> np.ndarray:
        out = 0
        for used, marks, norm in zip(self.used, self.marks, _norms(p), strict=True):
            out = out + (p[:, used].astype(np.float32) @ marks) / norm[:, None].astype(np.float32)
        return out / len(self.used)

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        f = self.kernel(presence(texts)) @ self.head + self.shift
        best = f.argmax(1)
        e = np.exp(np.clip(8 * (f - f.max(1, keepdims=True)), -50, 0).astype(np.float64))
        return [self.langs[i] for i in best], (e / e.sum(1, keepdims=True))[np.arange(len(f)), best]


def fit(texts: list[bytes], langs: list[str], landmarks: int = LANDMARKS, seed: int = 5) -> Model | None:
    names = sorted(set(langs))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    code = np.array([names.index(x) for x in langs])
    chosen = np.concatenate([rng.permutation(np.flatnonzero(code == k))[:landmarks] for k in range(len(names))])
    m = presence([texts[i] for i in chosen])
    used, marks = [], []
    for a, b, norm in zip(SPANS, [*SPANS[1:], WIDTH], _norms(m), strict=True):
        u = np.flatnonzero(m[:, a:b].any(0)) + a
        used.append(u)
        marks.append((m[:, u] / norm[:, None]).T.astype(np.float32))
    model = Model(names, used, marks, np.eye(len(chosen), dtype=np.float32), np.zeros(len(chosen), np.float32))
    k_mm = model.kernel(m).astype(np.float64)
    value, vector = np.linalg.eigh((k_mm + k_mm.T) / 2)
    keep = value > 1e-6 * value.max()
    nystrom = vector[:, keep] / np.sqrt(value[keep])
    k = np.vstack([model.kernel(presence(texts[i : i + ROWS])) for i in range(0, len(texts), ROWS)])
    phi = k @ nystrom
    centre = phi.mean(0)
    y = np.where(code[:, None] == np.arange(len(names)), 1.0, -1.0)
    weight = len(code) / (len(names) * np.bincount(code, minlength=len(names)))[code]
    x = phi - centre
    beta = np.linalg.solve(x.T @ (x * weight[:, None]) + RIDGE * len(x) * np.eye(x.shape[1]), x.T @ ((y - y.mean(0)) * weight[:, None]))
    model.head = (nystrom @ beta).astype(np.float32)
    model.shift = (y.mean(0) - centre @ beta).astype(np.float32)
    return model


def learn(docs: DataFrame, learn_from: Column, lang_col: str = "lang", text_col: str = "text", per_lang: int = PER_LANG) -> Model | None:
    """The model of the texts of docs where learn_from, a condition on its columns, holds."""
    known = docs.where(learn_from & F.col(lang_col).isNotNull() & (F.octet_length(text_col) > 0))
    known = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    # keys first: the window carries hashes, and of those only about four times as many as are taken
    keys = stored(known.select("lang", F.xxhash64("text").alias("h")).distinct(), "keys")
    many = stored(keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    if many.count() <= BROADCAST_LANGS:  # so that keys are thinned before they are dealt by language
        many = F.broadcast(many)
    least = keys.join(many, "lang").where((F.col("h").cast("double") / 2.0**64 + 0.5) * F.col("n") <= 4 * per_lang).select("lang", "h")
    chosen = least.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("rank") <= per_lang).orderBy("rank", "lang").limit(LANGS * per_lang)
    texts = known.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "h"])
    rows = stored(texts.groupBy("lang", "h").agg(F.min("rank").alias("rank"), F.min("text").alias("text")), "sample")
    left, kept = SAMPLE_BYTES, set()
    for x in sorted(rows.select("lang", "h", "rank", F.octet_length("text").alias("bytes")).collect(), key=lambda x: (x.rank, x.lang)):
        if x.bytes <= left or x.rank == 1:  # one that doesn't fit costs only itself
            left -= min(x.bytes, left)
            kept.add((x.lang, x.h))
    got = sorted((x.lang, x.h, x.text) for x in rows.toLocalIterator() if (x.lang, x.h) in kept)
    return fit([t.encode() for _, _, t in got], [lang for lang, _, _ in got])


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """docs with a column struct of the predicted language and its score, unpacked."""

    @F.pandas_udf("lang string, score double")
    def told(texts: pd.Series) -> pd.DataFrame:
        langs, scores = ["und"] * len(texts), np.zeros(len(texts))
        some = [i for i, t in enumerate(texts) if model and t and any(map(str.isalpha, t))]
        for at in range(0, len(some), ROWS):
            part = some[at : at + ROWS]
            got, p = model.predict([texts.iloc[i].encode() for i in part])
            for i, x, s in zip(part, got, p, strict=True):
                langs[i], scores[i] = x, s
        return pd.DataFrame({"lang": langs, "score": scores})

    t = fresh(docs, "told")
    rows = docs.withColumn(t, told(F.col(text_col)))
    return rows.withColumns({lang_col: F.col(f"{t}.lang"), score_col: F.col(f"{t}.score")}).drop(t)
