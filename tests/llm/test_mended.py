"""Faults that were found in earlier rounds, and brute-force versions of what had none."""

from __future__ import annotations

import hashlib
import unicodedata
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestore.llm import html_crf, kernel_langid, quality_cnn, token_orc, warc


@pytest.mark.parametrize("before,after", [(4, 2), (2, 7)])
def test_all_records_come_back_when_the_cores_change_between_the_scans(spark, tmp_path, monkeypatch, before, after):
    inner = "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    pages = [(i, "u", f"<p>{i}" + (inner * (i % 4) if i % 3 == 0 else "") + "x" * (i % 50)) for i in range(1500)]
    path = f"file://{tmp_path}/a"
    warc.write(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), path)
    chain = warc._chain

    def changed(*args):
        out = chain(*args)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", after)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        return out

    monkeypatch.setattr(warc, "_chain", changed)
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", before)
    try:
        got = {int(x.id): x.payload_digest for x in warc.index(spark, path).collect()}
        whole = {hashlib.sha1(bytes(x.payload)).hexdigest() for x in warc.records(spark, path).collect()}
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {i: hashlib.sha1(t.encode()).hexdigest() for i, _, t in pages}
    assert whole == set(got.values())


def test_many_copied_payloads_are_salted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    pages = [(i, "u", f"<p>{i % 7}" + "y" * 1200) for i in range(90)] + [(None, "u", "<p>1" + "y" * 1200)]
    warc.write(spark.createDataFrame(pages, "page_id long, url string, html string"), f"file://{tmp_path}/a")
    got = warc.index(spark, f"file://{tmp_path}/a").collect()
    last = {k: max(i for i, *_ in pages[:-1] if i % 7 == k) for k in range(7)}
    assert len(got) == len(pages)
    assert {(int(x.id), x.refers_to and int(x.refers_to)) for x in got if x.id} == {(i, None if i == last[i % 7] else last[i % 7]) for i in range(90)}


def test_one_long_text_costs_only_itself(spark, monkeypatch):
    monkeypatch.setattr(quality_cnn, "SAMPLE_BYTES", 4000)
    docs = spark.createDataFrame([(i, "g" * (9000 if i == 0 else 20) if i < 60 else "b" * 20) for i in range(120)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, quality int")
    texts, marks, share = quality_cnn.sample(docs, labels, F.lit(True), "quality", "doc_id", "text", 3000)
    assert (marks.sum(), len(marks), share) == (59, 119, 0.5) and max(map(len, texts)) == 20
    monkeypatch.setattr(kernel_langid, "SAMPLE_BYTES", 3000)
    rows = [("a" * 9000 if i == 0 else f"abc {i}", "x") for i in range(30)] + [(f"def {i}", "y") for i in range(30)]
    model = kernel_langid.learn(spark.createDataFrame(rows, "text string, lang string"), F.lit(True))
    assert model.langs == ["x", "y"]


def test_a_language_of_copies_is_learned(spark):
    rows = [("der hund und die katze sind hier", "de")] * 3000 + [(f"the dog number {i} and a cat", "en") for i in range(3000)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    for k in range(3):  # a hash could spare it by chance
        varied = docs.withColumn("text", F.concat("text", F.lit("." * k)))
        model = kernel_langid.learn(varied, F.lit(True))
        assert model.langs == ["de", "en"]
    got = {(x.lang, x.lang_pred) for x in kernel_langid.predict(docs.distinct(), model).collect()}
    assert got == {("de", "de"), ("en", "en")}


def test_languages_equal_a_plain_nystrom_ridge_regression():
    rng = np.random.default_rng(1)
    alphabets = {"a": "abcde ", "b": "cdefg ", "c": "ghijk "}
    texts, langs = [], []
    for lang, letters in alphabets.items():
        for _ in range(12):
            texts.append("".join(rng.choice(list(letters), 40)).encode())
            langs.append(lang)
    model = kernel_langid.fit(texts, langs, landmarks=5, seed=9)

    def grams(t: bytes) -> list[set]:
        at = set(kernel_langid.places(t).tolist())
        a, b, c = kernel_langid.SPANS
        return [{x for x in at if x < b}, {x for x in at if b <= x < c}, {x for x in at if x >= c}]

    def kernel(s: bytes, t: bytes) -> float:
        return float(np.mean([len(x & y) / np.sqrt(len(x) * len(y)) for x, y in zip(grams(s), grams(t), strict=True)]))

    names, code = sorted(alphabets), np.array([sorted(alphabets).index(x) for x in langs])
    draw = np.random.default_rng(9)
    marks = [texts[i] for k in range(3) for i in draw.permutation(np.flatnonzero(code == k))[:5]]
    k_mm = np.array([[kernel(s, t) for t in marks] for s in marks])
    value, vector = np.linalg.eigh(k_mm)
    keep = value > 1e-6 * value.max()
    to_map = vector[:, keep] / np.sqrt(value[keep])
    phi = np.array([[kernel(s, t) for t in marks] for s in texts]) @ to_map
    centre = phi.mean(0)
    new = [bytes(rng.choice(list(b"abcdefghijk "), 30).astype(np.uint8)) for _ in range(40)]
    phi_new = np.array([[kernel(s, t) for t in marks] for s in new]) @ to_map - centre
    f = np.zeros((len(new), 3))
    for k in range(3):  # one against the rest, as least squares with a penalty written as more rows
        y = np.where(code == k, 1.0, -1.0)
        root = np.sqrt(len(code) / (3 * np.bincount(code)))[code]
        penalty = np.sqrt(kernel_langid.RIDGE * len(texts)) * np.eye(phi.shape[1])
        beta = np.linalg.lstsq(np.vstack([(phi - centre) * root[:, None], penalty]), np.concatenate([(y - y.mean()) * root, np.zeros(phi.shape[1])]), rcond=None)[0]
        f[:, k] = phi_new @ beta + y.mean()
    got, score = model.predict(new)
    assert np.allclose(model.kernel(kernel_langid.presence(new)) @ model.head + model.shift, f, atol=2e-3)
    clear = np.sort(f, axis=1)[:, -1] - np.sort(f, axis=1)[:, -2] > 0.01
    assert clear.sum() > 20 and [g for g, c in zip(got, clear, strict=True) if c] == [names[i] for i, c in zip(f.argmax(1), clear, strict=True) if c]


def test_caches_of_tokens_count_their_bytes(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, encoder = Tokenizer.from_file(path), token_orc._Encoder(path)
    monkeypatch.setattr(token_orc, "CACHE_BYTES", 5_000)
    monkeypatch.setattr(token_orc, "PART_BYTES", 5_000)
    texts = [f"word{i} thing{i % 7}. Other-{i}! {'x' * (i % 300)}" for i in range(500)]
    most = 0
    for at in range(0, len(texts), 10):
        got = encoder.ids(texts[at : at + 10])
        assert got == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts[at : at + 10]]
        for held, counted in ((encoder.cache, encoder.cache_bytes), (encoder.parts, encoder.part_bytes)):
            assert counted == token_orc._held(held)
            most = max(most, counted)
    assert most < 60_000
    monkeypatch.setattr(encoder, "by_chunk", False)  # as for tokenizers whose texts can't be cut
    assert encoder.ids(texts[:5]) == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts[:5]]


def test_stems_take_the_short_way_through_the_library():
    """Of letters and marks, only the marks go through the tokenizer's normalizer and patterns (op3 over its CPU budget before)."""
    encoder, seen = token_orc._Encoder(public_tokenizers.path("word_bpe_49k.json")), []

    class Watched:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, texts, **how):
            seen.extend(texts)
            return self.tokenizer.encode_batch_fast(texts, **how)

    words = ["".join(x) for x in product("thé", "ingß", "aeiou", "nñdж")]
    texts = [f"{a} {a.title()}, {b}. {b.upper()}&&&" for a, b in zip(words, words[1:], strict=False)]
    want = [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    encoder.tokenizer = Watched(encoder.tokenizer)
    assert encoder.ids(texts) == want
    assert set(seen) <= {"", ",", ".", "&&&"} and len(seen) <= 4
    assert set(words) <= set(encoder.parts)


def test_tokens_of_awkward_texts_equal_the_librarys(monkeypatch):
    encoder = token_orc._Encoder(public_tokenizers.path("word_bpe_49k.json"))

    def same(texts):
        want = [np.array(x.ids, "<u4").tobytes() for x in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        assert [t for t, g, w in zip(texts, encoder.ids(texts), want, strict=True) if g != w] == []

    ideographs = [range(0x3400, 0xA000), range(0xAC00, 0xE000), range(0x17000, 0x18D00), range(0x20000, 0x110000)]
    letters = [chr(i) for i in range(0x110000) if not any(i in r for r in ideographs) and unicodedata.category(chr(i))[0] == "L"]
    same([f"{c} a{c}b. {c}{c}!" for c in letters])
    bits = [*"aBéÉİΣσςßẞǅ\u212a\u2126日アがク가각क़א1²½'’-_.,!&|#$<\x00\x01\x1c\x1f\x85\xa0\u3000\u200b\ufeff \t\n\x0b\x0c", "\u0301", "\u3099", "\ufb1d", "'s", "  ", "\r\n", "the", "tion", "</w>", "<|endoftext|>", "<|startoftext|>"]
    rng = np.random.default_rng(3)
    same(["".join(bits[k] for k in rng.integers(0, len(bits), n)) for n in rng.integers(0, 25, 4000)])
    same(["", " ", "x" * 5000, ("ab" * 200 + "! ") * 40])
    assert encoder.ids([]) == []
    short, encoder.stems, encoder.parts = encoder.stems, None, {}  # as for tokenizers whose tokens don't show where a stem ends
    assert short is not None
    same(["Plain words, and more words."])
    monkeypatch.setattr(token_orc, "STEP", 10)
    texts = pa.array(["abc", "", "x" * 25, "defg", "hij", "klm", "é" * 5]).slice(1)
    assert list(token_orc._steps(texts)) == [(0, 1), (1, 2), (2, 5), (5, 6)]
    assert list(token_orc._steps(pa.array([], pa.large_string()))) == []


def test_marginals_and_gradient_equal_enumeration():
    from itertools import product

    rng = np.random.default_rng(4)
    page = [[1, 2], [2, 3], [5], [1, 5, 7]]
    field = html_crf.Field()
    field.emit[:8], field.step, field.start = rng.normal(size=(8, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)

    def weight(labels, f) -> float:
        total = f.start[labels[0]] + sum(f.emit[x, y] for fs, y in zip(page, labels, strict=True) for x in fs)
        return total + sum(f.step[a, b] for a, b in zip(labels[:-1], labels[1:], strict=True))

    every = list(product((0, 1), repeat=len(page)))
    p = np.exp([weight(y, field) for y in every])
    p /= p.sum()
    single, steps = field.marginals(page)
    for i in range(len(page)):
        assert np.allclose(single[i], [sum(q for y, q in zip(every, p, strict=True) if y[i] == k) for k in (0, 1)])
    assert np.allclose(steps, [[sum(q * sum((y[i], y[i + 1]) == (a, b) for i in range(3)) for y, q in zip(every, p, strict=True)) for b in (0, 1)] for a in (0, 1)])
    # a step of learning goes along the numeric gradient of the labels' likelihood
    labels, rate, tiny = [0, 1, 1, 0], 1e-3, 1e-6

    def likelihood(f) -> float:
        return weight(labels, f) - np.log(np.sum(np.exp([weight(y, f) for y in every])))

    moved = html_crf.Field(field.emit.copy(), field.step.copy(), field.start.copy())
    moved.learn(page, labels, rate, decay=0)
    for name, at, scale in (("emit", (2, 1), 1), ("emit", (5, 0), 1), ("step", (1, 0), 3), ("start", (1,), 1)):
        up = html_crf.Field(field.emit.copy(), field.step.copy(), field.start.copy())
        getattr(up, name)[at] += tiny
        numeric = (likelihood(up) - likelihood(field)) / tiny
        assert np.isclose((getattr(moved, name)[at] - getattr(field, name)[at]) / rate * scale, numeric, atol=1e-3), (name, at)


def test_formulas_and_objects_are_text_of_the_page():
    long = "The proof is short and takes three steps, as the following text tells in some detail, with all that belongs to it. "
    html = f"<html><body><nav><a href='/'>Home</a></nav><article><h1>On proofs</h1><p>{long}We know that <math><mi>x</mi><mo>=</mo><mn>3</mn></math> holds.</p><p>{long}<object>a drawing</object> Please subscribe to this view.</p></article></body></html>"
    text = html_crf.main_text(html, html_crf.train())
    assert "We know that x=3 holds." in text and "a drawing Please subscribe to this view." in text and "Home" not in text
