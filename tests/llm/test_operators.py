"""The operators against brute force, the libraries they follow, and rows of every awkward kind."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestore.llm import byte_bpe, chosen_path, components, curriculum, exact_dedup, html_crf, kernel_langid, quality_cnn, tile_dedup, token_orc, warc

public_tokenizers = pytest.importorskip("public_tokenizers")

WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu"]
# extra columns have names that the operators use inside
ROW = "doc_id long, text string, source string, lang string, digest string, row int, size int, node long, n int"


def text_of(seed: int, n: int = 60) -> str:
    r = np.random.default_rng(seed)
    return " ".join(r.choice(WORDS, n)) + f" end{seed}"


def rows(texts, sources=None):
    return [(i, t, (sources or ["s"])[i % len(sources or ["s"])], "en", "x", 1, 2, 3, 4) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def awkward(spark):
    base = text_of(1)
    texts = [None, "", " \t\n", base, base.replace(" ", "  "), base + " more", "one two", "one two", "x" * 3000, "日本 🙂 é́ \x1c \x01 don't", base, text_of(2, 5000)]
    data = rows(texts, ["b", "a", None])
    data += [data[3], (None, base, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(data, ROW)


@pytest.fixture(scope="module")
def none(awkward):
    return awkward.limit(0)


def same_columns(out, docs):
    assert out.columns == docs.columns


# --- exact dedup


def squeezed(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


@pytest.mark.parametrize("support", [1 / 1024, 0.2])
def test_exact_dedup(spark, awkward, support):
    data = awkward.collect()
    got = exact_dedup.groups(awkward, support=support).collect()
    assert len(got) == len(data)
    by = defaultdict(list)
    for x in data:
        by[hashlib.sha256(squeezed(x.text).encode()).hexdigest()].append(x)
    for h, xs in by.items():
        mine = [x for x in got if x.text_sha256 == h]
        first = min(xs, key=lambda x: (-len(x.text or ""), x.doc_id is None, x.doc_id or 0))
        assert len(mine) == len(xs) and {x.group_size for x in mine} == {len(xs)} and {x.keep_id for x in mine} == {first.doc_id}
        assert sum(x.kept for x in mine) == 1
    kept = exact_dedup.drop_copies(awkward, support=support)
    same_columns(kept, awkward)
    assert sorted(squeezed(x.text) for x in kept.collect()) == sorted({squeezed(x.text) for x in data})


@pytest.mark.parametrize("parts", [1, 8])
def test_heavy_winners_names_every_digest_over_the_support(spark, tmp_path, parts):
    n, support = 12_000, 1 / 256
    # at the start of the table: 3000 rows of one digest, then 60, 50 and 47 of others; 46 are under the support; the rest is single
    sizes = [3000, 60, 50, 47, 46]
    keys = [f"g{g}" for g, m in enumerate(sizes) for _ in range(m)]
    keys += [f"s{i}" for i in range(n - len(keys))]
    data = [(i, hashlib.sha256(k.encode()).digest(), 1, i, -i) for i, k in enumerate(keys)]
    spark.createDataFrame(data, "id long, digest binary, cp int, row long, key long").coalesce(1).sortWithinPartitions("id").repartitionByRange(parts, "id").write.parquet(f"{tmp_path}/slim")
    for slim in (spark.read.parquet(f"{tmp_path}/slim"), spark.createDataFrame(data, "id long, digest binary, cp int, row long, key long")):
        got = {bytes(x.digest): (x.n, x["first"].id) for x in exact_dedup.heavy_winners(slim, support).collect()}
        assert got == {hashlib.sha256(f"g{g}".encode()).digest(): (sizes[g], sum(sizes[:g])) for g in range(4)}


def test_exact_dedup_is_native_and_empty(awkward, none):
    plan = exact_dedup.groups(awkward)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert exact_dedup.groups(none).count() == 0 and exact_dedup.drop_copies(none).count() == 0


# --- WARC


def test_warc_rejects_magic_in_payloads(spark, tmp_path):
    big = "<p>é" + "x" * 1500
    fake = "a WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\n\r\nb"
    pages = [(1, "u", big), (2, "u", big), (3, "v", "small"), (4, "v", "small"), (5, None, None), (6, "w\r\nX: y", fake + big), (7, "w", "WARC/1.0\r\n" + fake), (8, "z", ""), (None, "n", big), (9, "t", "\r\n\r\n")]
    df = spark.createDataFrame([(*p, 1, "x") for p in pages], "page_id long, url string, html string, n int, digest string")
    path = f"file://{tmp_path}/a"
    warc.write(df.repartition(2), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        got = {(x.id and int(x.id)): x for x in warc.index(spark, path).collect()}
        full = {bytes(x.payload) for x in warc.records(spark, path).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == len(pages)
    for i, _, html in pages:
        b = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(b), hashlib.sha1(b).hexdigest())
        revisit = html == big and i != 2
        assert got[i].record_type == ("revisit" if revisit else "response") and got[i].refers_to == ("2" if revisit else None)
    assert {(h or "").encode() for _, _, h in pages} == full
    warc.write(df.limit(0), f"file://{tmp_path}/b")
    assert warc.index(spark, f"file://{tmp_path}/b").count() == 0


# --- token ids in ORC


def test_token_orc(spark, tmp_path, awkward, none):
    from tokenizers import Tokenizer

    p = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(p)
    tok.encode_special_tokens = True
    token_orc.write(awkward, f"file://{tmp_path}/t", p, 1)
    got = token_orc.digests(spark, f"file://{tmp_path}/t").collect()
    ids = {x.doc_id: [] for x in awkward.collect()}
    for x in awkward.collect():
        ids[x.doc_id].append(tok.encode(x.text or "", add_special_tokens=False).ids + [1])
    want = sorted((d is not None, d or 0, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, many in ids.items() for i in many)
    assert sorted((x.doc_id is not None, x.doc_id or 0, x.n_tokens, x.ids_crc32) for x in got) == want
    order = sorted(got, key=lambda x: x.start)
    assert [x.start for x in order] == np.concatenate([[0], np.cumsum([x.n_tokens for x in order])[:-1]]).tolist()
    assert [x.doc_id for x in order if x.doc_id is not None] == sorted(x.doc_id for x in order if x.doc_id is not None)
    assert token_orc.lookup(spark, f"file://{tmp_path}/t", 5).count() == 1
    token_orc.write(none, f"file://{tmp_path}/e", p, 1)
    assert token_orc.digests(spark, f"file://{tmp_path}/e").count() == 0


def test_token_orc_keeps_the_librarys_special_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    p = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(p)
    texts = ["end of page <|endoftext|> next", "a<|endoftext|>b c.<|startoftext|>! d", "<|ENDOFTEXT|> <|endoftext| >", "<|endoftext|><|endoftext|>", "e<|endoftext|>\u0301 \x01<|endoftext|>\x01 x\x1c<|startoftext|>", "plain text."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    token_orc.write(docs, f"file://{tmp_path}/t", p, 1)
    got = {x.doc_id: x.ids for x in token_orc.read(spark, f"file://{tmp_path}/t").collect()}
    assert got == {i: [*tok.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    assert 49407 in got[0]


# --- byte-level BPE


@pytest.fixture(scope="module")
def bpe(spark):
    return byte_bpe.ByteBpe(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def test_byte_bpe_equals_the_library(spark, bpe, awkward, none):
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    out = bpe.encode(awkward).withColumn("back", bpe.decode(F.col("ids")))
    assert out.columns[: len(awkward.columns)] == awkward.columns
    got = out.collect()
    assert len(got) == awkward.count()
    for x in got:
        assert x.ids == enc.encode_ordinary(x.text or "") and bytes(x.back) == (x.text or "").encode()
    assert byte_bpe.digests(bpe, none).count() == 0
    one = byte_bpe.digests(bpe, awkward.where("doc_id = 1")).first()
    assert one.n_tokens == 0 and one.ids_sha256 == one.decoded_sha256 == hashlib.sha256(b"").hexdigest()


def test_byte_bpe_long_words_and_small_blocks(spark, bpe, monkeypatch):
    import tiktoken

    monkeypatch.setattr(byte_bpe, "BLOCK_WORDS", 40)  # seen by the driver alone: workers cut no block
    monkeypatch.setattr(byte_bpe, "CACHED_WORDS", 3)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    r = np.random.default_rng(6)
    long = ["".join(r.choice(list("abcdeéß"), n)) for n in (200, 511, 512, 513, 600, 3000)]
    texts = [" ".join(long), *(x[:512] for x in long), "a" * 511, "a" * 512, "a" * 513, None, ""] + [" ".join("".join(r.choice(list("abcdefgh"), 9)) for _ in range(30)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, b"x", [1]) for i, t in enumerate(texts)], "doc_id long, text string, words binary, rare array<int>").repartition(3)
    encoder = byte_bpe.ByteBpe(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    got = {x.doc_id: x for x in encoder.encode(docs, decoded="back").collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i].ids == enc.encode_ordinary(t or "") and bytes(got[i].back) == (t or "").encode() and bytes(got[i].words) == b"x"
    batch = lambda texts: pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([t.split() for t in texts], pa.list_(pa.string()))], names=["id", "w"])
    known = pa.array(["a", "b"])
    out = list(byte_bpe._numbered(known, ["id", "w", "rare"])(iter([batch(["a x x", "y a"] * 30), batch(["b y z"])])))
    kinds = [b.column(2).null_count == 0 for b in out]
    assert kinds == [True, False, True, False] and out[1].column(1).to_pylist()[:2] == [[0, 2, 2], [3, 0]] and out[3].column(1).to_pylist() == [[1, 2, 3]]


def test_heap_merge_equals_naive_merges():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"aa": 259, b"aaa": 260}
    for word in (b"aaaaa", b"abcabc", b"bcaab", b"x"):
        parts = [bytes([c]) for c in word]
        while True:
            best = min(((ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))), default=(1 << 30, 0))
            if best[0] == 1 << 30:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        assert byte_bpe.heap_merge(word, ranks) == [ranks[p] for p in parts]


# --- near copies


def jaccard_truth(data):
    def shingles(t):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = [shingles(x.text) for x in data]
    links = [{j for j, b in enumerate(sets) if j != i and a and b and len(a & b) >= 0.8 * len(a | b)} for i, a in enumerate(sets)]
    comp = list(range(len(sets)))
    for _ in sets:
        for i, js in enumerate(links):
            comp[i] = min([comp[i], *(comp[j] for j in js)])
    return links, comp


@pytest.mark.parametrize(("small", "few"), [(2048, 48), (8, 6)])  # the second: pivots, splits and tiles
def test_chosen_path_equals_brute_force(spark, awkward, none, monkeypatch, small, few):
    monkeypatch.setattr(chosen_path, "SMALL", small)
    monkeypatch.setattr(chosen_path, "FEW", few)
    monkeypatch.setattr(chosen_path, "TILE", 16 if small == 8 else 1024)
    base = text_of(7, 120).split()
    texts = [x.text for x in awkward.collect()]
    for i in range(70):  # one large group of near copies, and edits around the threshold
        w = list(base)
        for k in range(1 + i % 3):
            w[(i * 7 + k * 31) % len(w)] = f"new{i}{k}"
        texts.append(" ".join(w))
    for i in range(30):
        w = text_of(100 + i // 3, 90).split()
        w[i % 80] = f"edit{i}"
        texts.append(" ".join(w))
    docs = spark.createDataFrame(rows(texts), ROW)
    data = docs.collect()
    links, comp = jaccard_truth(data)
    got = {x.doc_id: x for x in chosen_path.near_copies(docs).collect()}
    for i in range(len(data)):
        assert (got[i].n_links, got[i].class_id) == (len(links[i]), comp[i]), i
        assert got[i].kept == (comp[i] == i)
    left = chosen_path.drop_near_copies(docs)
    same_columns(left, docs)
    assert sorted(x.doc_id for x in left.collect()) == sorted({*comp})
    assert chosen_path.near_copies(awkward).count() == awkward.count()
    assert chosen_path.near_copies(none).count() == 0 and chosen_path.drop_near_copies(none).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (5, 5), (None, 3)]
    got = {x.node: x.component for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_tile_dedup_equals_brute_force(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(150, 16))
    x[50:90] = x[0] + r.normal(size=(40, 16)) * np.linspace(0.05, 0.6, 40)[:, None]
    data = [(i, v.tolist(), 1, "a") for i, v in enumerate(x)]
    data += [(200, None, 1, "a"), (201, [0.0] * 16, 1, "a"), (202, [float("nan")] * 16, 1, "a"), (203, [None] * 16, 1, "a"), (204, [], 1, "a"), (205, [1.0, 2.0], 1, "a"), (206, [2.0, 4.0], 1, "a"), (None, x[3].tolist(), 1, "a"), (7, x[7].tolist(), 1, "a")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, row int, tile string")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.9) & ~np.eye(len(u), dtype=bool)
    got = defaultdict(list)
    for y in tile_dedup.near_copies(df, tile=40).collect():
        got[y.vec_id].append(y)
    for i in range(150):
        assert {y.n_links for y in got[i]} == {int(near[i].sum()) + (i == 7) + int(near[i][7])}, i
    assert all(got[i][0].n_links == 0 and got[i][0].kept for i in (200, 201, 202, 203, 204))
    assert [got[i][0].component_id for i in (205, 206)] == [205, 205] and len(got[7]) == 2
    assert got[None][0].n_links == 0 and got[None][0].kept
    assert tile_dedup.near_copies(df.limit(0)).count() == 0


def test_tiles_grow_with_the_vectors(spark, monkeypatch):
    """No vector goes to more than WAYS pairs of tiles while tiles may grow, and a task folds the links it holds."""
    monkeypatch.setattr(tile_dedup, "WAYS", 2)
    monkeypatch.setattr(tile_dedup, "LINKS", 8)
    met = []
    fold = tile_dedup.stored
    monkeypatch.setattr(tile_dedup, "stored", lambda df, name: met.append((name, df)) or fold(df, name))
    x = np.random.default_rng(3).normal(size=(120, 4))
    got = {y.vec_id: (y.n_links, y.component_id) for y in tile_dedup.near_copies(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), tile=10).collect()}
    assert [r.tiles for name, df in met if name == "sizes" for r in df.collect()] == [2]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    i, j = np.nonzero((u @ u.T >= 0.9) & ~np.eye(len(u), dtype=bool))
    label = tile_dedup.local_labels(len(u), i, j)
    assert got == {k: (int((i == k).sum()), int(label[k])) for k in range(len(u))}


def test_quantisation_bound_is_rigorous():
    r = np.random.default_rng(2)
    x = r.normal(size=(60, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, s, e = tile_dedup.quantise(x)
    off = np.abs((q * s[:, None]) @ (q * s[:, None]).T - x @ x.T)
    assert (off <= e[:, None] * (1 + e) + e * (1 + e[:, None]) + e[:, None] * e).all()


# --- classifiers


def test_quality_network(spark, none):
    good, bad = [text_of(i, 40) for i in range(60)], [" ".join(w + "***" for w in text_of(i, 40).split()) for i in range(60)]
    docs = spark.createDataFrame(rows([*good, *bad, None, ""]), ROW)
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)] + [(5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    net = quality_cnn.learn(docs, labels, F.col("doc_id") % 3 != 0)
    got = {x.doc_id: x.score for x in quality_cnn.score(docs, net).collect()}
    held = [i for i in range(120) if i % 3 == 0]
    assert np.mean([(got[i] >= 0.3) == (i < 60) for i in held]) > 0.9 and all(0 <= s <= 1 for s in got.values())
    assert got[120] == got[121]
    same_columns(quality_cnn.keep_good(docs, net), docs)
    assert quality_cnn.keep_good(none, net).count() == 0
    flat = quality_cnn.learn(docs, labels.limit(0), F.lit(True))
    assert {x.score for x in quality_cnn.score(docs, flat).collect()} == {0.5}


def test_network_reads_to_the_end():
    net = quality_cnn.fit([b"good text here", b"bad*** text***"] * 10, np.array([1, 0] * 10, np.float32), epochs=20)
    clean = b"good text here " * 500
    assert net.scores([clean])[0] > net.scores([clean + b"bad*** text*** " * 500])[0]


def test_scores_do_not_depend_on_other_texts():
    net = quality_cnn.fit([b"good text here", b"bad*** text***"] * 10, np.array([1, 0] * 10, np.float32), epochs=5)
    r = np.random.default_rng(8)
    texts = [text_of(i, n).encode()[:size] for i, (n, size) in enumerate([(90, 512), (90, 256), (90, 255), (90, 224), (90, 225), (1, 3), (400, 2000)])] + [b"", b"\x00\x00\x00\x00a\x00\x00\x00\x00a"]
    alone = [net.scores([t])[0] for t in texts]
    for _ in range(20):
        order = r.permutation(len(texts))
        got = net.scores([b"*** *** bad", *(texts[i] for i in order), b"*** bad ***"])[1:-1]
        assert got.tolist() == [alone[i] for i in order]


def test_network_equals_plain_loops():
    net = quality_cnn.fit([b"good text here", b"bad*** text***"] * 10, np.array([1, 0] * 10, np.float32), epochs=2)
    for text in (b"", b"abc", text_of(3, 80).encode(), text_of(4, 35).encode() * 2):
        size = -(-(quality_cnn.PAD + len(text)) // quality_cnn.BLOCK) * quality_cnn.BLOCK
        b = bytes(quality_cnn.PAD) + text + bytes(size - quality_cnn.PAD - len(text) + quality_cnn.WIDTH)
        value = [c + 256 * bool(c and any(i >= lag and b[i : i + 4] == b[i - lag : i - lag + 4] for lag in quality_cnn.LAGS)) for i, c in enumerate(b)]
        blocks = []
        for at in range(0, size, quality_cnn.BLOCK):
            places = range(at, at + quality_cnn.BLOCK, quality_cnn.STRIDE)
            blocks.append(np.maximum(np.max([net.bias + sum(net.tables[k][value[i + k]] for k in range(quality_cnn.WIDTH)) for i in places], axis=0), 0))
        chunks = [np.maximum(x, y) for x, y in zip(blocks, [*blocks[1:], blocks[-1]], strict=True)]
        x = np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0)]) @ net.weights + net.shift
        assert net.scores([text])[0] == pytest.approx(1 / (1 + np.exp(-x)), abs=1e-4)


def test_kernel_equals_sets():
    texts = [text_of(i, 20).encode() for i in range(12)]
    model = kernel_langid.fit(texts, ["a", "b"] * 6, landmarks=2)
    rng = np.random.default_rng(5)
    marks = [texts[i] for i in [*rng.permutation(range(0, 12, 2))[:2], *rng.permutation(range(1, 12, 2))[:2]]]

    def grams(t):
        b = list(t)
        hashed = {((((x << 8 | y) << 8 | z) * 2654435761) & 0xFFFFFFFF) >> 16 for x, y, z in zip(b, b[1:], b[2:], strict=False)}
        return [set(b), {(x, y) for x, y in zip(b, b[1:], strict=False)}, hashed]

    want = [[np.mean([len(x & y) / np.sqrt(len(x) * len(y)) for x, y in zip(grams(t), grams(m), strict=True)]) for m in marks] for t in texts]
    assert np.allclose(model.kernel(kernel_langid.presence(texts)), want, atol=1e-5)


def test_language_sample_takes_the_same_rows_each_time(spark):
    docs = spark.createDataFrame([(i, text_of(i % 50, 10), None, "ab"[i % 2], None, 0, 0, 0, 0) for i in range(200)], ROW)
    one, two = (kernel_langid.learn(x, F.lit(True), per_lang=20) for x in (docs, docs.repartition(5)))
    assert np.array_equal(one.head, two.head)


def test_language_kernel(spark, none):
    en, de = "the and of with that this from they were", "der die und nicht mit ein ich auf für"
    mk = lambda src, i: " ".join(np.random.default_rng(i).choice(src.split(), 30))
    data = [(i, mk(en if i % 2 else de, i), None, "en" if i % 2 else "de", None, 0, 0, 0, 0) for i in range(80)]
    data += [(100, None, None, "en", None, 0, 0, 0, 0), (101, "123 !!", None, None, None, 0, 0, 0, 0), (102, "", None, None, None, 0, 0, 0, 0)]
    docs = spark.createDataFrame(data, ROW)
    model = kernel_langid.learn(docs, F.col("doc_id") % 4 != 0)
    got = {x.doc_id: x for x in kernel_langid.predict(docs, model).collect()}
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") for i in range(80))
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[101].score == 0
    assert kernel_langid.learn(none, F.lit(True)) is None
    assert {x.lang_pred for x in kernel_langid.predict(docs, None).collect()} == {"und"}


# --- pages


@pytest.fixture(scope="module")
def crf():
    return html_crf.train()


def test_pages(spark, crf):
    article = "<article><h1>T &amp; t</h1><p><b>First&nbsp;one<br>x<p>Second &lt;b&gt; &copy; <i>in</i>line</p></article>"
    frame = "<nav><ul><li><a href=/>menu</a></ul></nav><div class=ad>Buy now.</div>{}<footer>&copy; foot</footer>"
    pages = [(1, "u", frame.format(article)), (2, "u", None), (3, "u", ""), (4, "u", frame.format(article) + "<p clas"), (5, "u", "<script>var a='<p>x</p>'</script>"), (5, "u", frame.format(article))]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, blocks string")
    got = html_crf.extract(df, crf).collect()
    want = "T & t First one x Second <b> © inline"
    assert [x.text for x in got] == [want, "", "", want, "", want]
    assert html_crf.extract(df.limit(0), crf).count() == 0


def test_all_ancestors_and_whole_attributes_count():
    names = lambda *xs: {zlib.crc32(x.encode()) % html_crf.PLACES for x in xs}
    html = "<html><body><main>" + "<div>" * 5 + "<nav class='side menu'>" + "<div class=box>" * 60 + f"<section id='{'x ' * 200}footer'>deep</section>" + "</div>" * 60 + "</nav>" + "</div>" * 5 + "<p>after</main></body></html>"
    deep, after = html_crf.leaf_blocks(html)
    assert names("t html", "t body", "t main", "t div", "t nav", "c side", "c menu", "c box", "t section", "c x", "c footer", "p section") <= set(html_crf.features(deep))
    plain = html_crf.leaf_blocks("<html><body><main><p>after</main></body></html>")[0]
    assert after.text == "after" and sorted(html_crf.features(after)) == sorted(html_crf.features(plain))


def test_pages_without_optional_tags(crf):
    article = "<article><h1>A title</h1><p>First of all, a line.<p>Then another.<ul><li>one thing<li>and a second</ul><p>At last {}the end.</article>"
    want = "A title First of all, a line. Then another. one thing and a second At last the end."
    control = "<select><option>red<option>blue</select><textarea>write here</textarea><button>Send</button>"
    nav = "<nav><ul><li><a href=/>menu</a></ul></nav>"
    for page in (
        "<html><head><title>t</title><body>" + nav + article.format(control),
        "<html><head><title>t</title>" + nav + article.format(""),
        "<head><meta charset=u><noscript><img src=x></noscript><style>p{}</style>" + article.format(control),
        "<head><title>t<body>" + article.format(""),
        article.format("") + "<p class='x",
        "<article><table><thead><tr><th>A title<tbody><tr><td>First of all, a line.<td>Then another.<tr><td>one thing<td>and a second</table><p>At last the end.</article>",
    ):
        assert html_crf.main_text(page, crf) == want
    assert [b.text for b in html_crf.leaf_blocks("<p>if 1 <b and more of it")] == ["if 1 <b and more of it"]
    long = "<article>" + "".join(f"<p>Paragraph number {i}, as long as any." for i in range(20_000)) + "</article>"
    assert len(html_crf.main_text(long, crf)) > 500_000


def test_viterbi_equals_enumeration():
    r = np.random.default_rng(4)
    for n in range(1, 8):
        field = html_crf.Field(r.normal(size=(html_crf.PLACES, 2)), r.normal(size=(2, 2)), r.normal(size=2))
        page = [r.integers(0, html_crf.PLACES, 5).tolist() for _ in range(n)]
        s = field.scores(page)
        total = lambda ys: field.start[ys[0]] + sum(s[i][y] for i, y in enumerate(ys)) + sum(field.step[a, b] for a, b in zip(ys, ys[1:], strict=False))  # noqa: B023, E731
        assert tuple(field.decode(page)) == max(itertools.product((0, 1), repeat=n), key=total)


def test_field_on_other_layouts(crf):
    right = total = 0
    for blocks, labels in html_crf.labelled_pages(80, seed=5):
        got = crf.decode([html_crf.features(b) for b in blocks])
        right += sum(a == b for a, b in zip(got, labels, strict=True))
        total += len(labels)
    assert right / total > 0.97


def test_marginals_sum_to_one(crf):
    blocks, _ = next(html_crf.labelled_pages(1, seed=9))
    p, steps = crf.marginals([html_crf.features(b) for b in blocks])
    assert np.allclose(p.sum(1), 1) and np.isclose(steps.sum(), len(blocks) - 1)


# --- mixing


def test_mix_targets(spark, awkward, none):
    texts = [text_of(i, 20 + i % 50) for i in range(300)]
    docs = spark.createDataFrame([(i, t, ["a", "b", "b", "b", "c", None][i % 6], "en", None, 0, 0, 0, 0) for i, t in enumerate(texts)], ROW)
    got = curriculum.plan(docs).collect()
    assert len(got) == 300 and all(x.taken <= 3 * x.size for x in got)
    src = {i: ["a", "b", "b", "b", "c", None][i % 6] for i in range(300)}
    by, target = defaultdict(int), {}
    for x in got:
        by[src[x.doc_id]] += x.taken
        target[src[x.doc_id]] = (x.target, x.source_size)
    total = sum(len(t.split()) for t in texts)
    assert sum(t for t, _ in target.values()) == pytest.approx(total)
    assert all(t <= 3 * s + 1e-6 for t, s in target.values())
    assert all(abs(by[s] - t) <= 80 for s, (t, _) in target.items())
    again = {x.doc_id: x.taken for x in curriculum.plan(docs.repartition(7)).collect()}
    assert again == {x.doc_id: x.taken for x in got}
    mixed = curriculum.mix(docs)
    same_columns(mixed, docs)
    n = defaultdict(int)
    for x in mixed.collect():
        n[x.doc_id] += len(x.text.split())
    assert dict(n) == {x.doc_id: x.taken for x in got if x.taken}
    assert curriculum.plan(awkward).count() == awkward.count()
    assert curriculum.plan(none).count() == 0 and curriculum.mix(none).count() == 0


def test_positions_invert_the_demand(spark):
    steps = ((0.0, 0.0), (0.25, 2.0), (0.5, 2.0), (1.0, 0.0))
    schedules = [*curriculum.CURRICULUM, steps]
    assert [curriculum.cumulative(s)[-1] for s in schedules] == [1.0, 2.0, 3.0, 1.25]
    rows = spark.range(4).withColumnRenamed("id", "kind").crossJoin(spark.range(101).selectExpr("id / 100 AS u"))
    for x in rows.withColumn("t", curriculum.inverse(F.col("u"), F.col("kind"), schedules)).collect():
        grid = np.linspace(0, x.t, 20_001)
        area = np.trapezoid(np.interp(grid, *zip(*schedules[x.kind], strict=True)), grid)
        assert area == pytest.approx(x.u * curriculum.cumulative(schedules[x.kind])[-1], abs=1e-6) and 0 <= x.t <= 1


def test_plan_tells_positions_of_the_mix(spark):
    docs = spark.createDataFrame([(None if i < 150 else i, text_of(i, 1 + i % 40), ["a", "b", "c"][i % 3], "", "", 0, 0, 0, 0) for i in range(400)], ROW)
    plan = curriculum.plan(docs).collect()
    at = [x.position for x in plan if x.position is not None]
    assert at == sorted(at) and all((x.taken > 0) == (x.position is not None) for x in plan)
    first = {}
    for x in curriculum.mix(docs, position_col="at").collect():
        first.setdefault((x.doc_id, x.text), x["at"])
    assert sorted(first.values()) == pytest.approx(sorted(at))
    assert len({x.position for x in plan if x.doc_id is None}) > 100


def test_curriculum_follows_its_schedule(spark):
    docs = spark.createDataFrame([(i, text_of(i, 30), "ab"[i % 2], "", "", 0, 0, 0, 0) for i in range(400)], ROW)
    early, late = ((0.0, 3.0), (1.0, 0.0)), ((0.0, 0.0), (1.0, 3.0))
    got = curriculum.mix(docs, [early, late], position_col="at").collect()
    assert [x["at"] for x in got] == sorted(x["at"] for x in got)
    place = {s: np.mean([x["at"] for x in got if x.source == s]) for s in "ab"}
    assert place["a"] == pytest.approx(1 / 3, abs=0.05) and place["b"] == pytest.approx(2 / 3, abs=0.05)
