"""The pipeline, stage by stage, against what each stage must do to its own input."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest

pytest.importorskip("public_tokenizers")

import public_tokenizers  # noqa: E402
import tiktoken  # noqa: E402

import corpus_pipeline  # noqa: E402
from lodestore.llm import byte_bpe, chosen_path, quality_cnn  # noqa: E402
from lodestore.llm.common import fold_of, stored  # noqa: E402


def test_stages(spark, tmp_path):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    good = [" ".join(f"{words[(i + j) % 10]}{i}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(60)) for i in range(20)]
    texts = [*good, good[0] + " ", good[1] + " and more", " ".join(f"{w}***" for w in words * 5), None, ""]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)] + [(3, good[3], "en", "s0", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i != 22), 0) for i in range(23)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for (name, stage), check in zip(corpus_pipeline.STAGES, (None, exact, near, mixed, encoded), strict=True):
        before, now = now, stored(stage(spark, now, str(tmp_path)), "stage")
        if check:
            check([x.text for x in before.collect()], now)
        if name != "byte-level BPE":
            assert now.columns == docs.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == now.count() > 0


def squeezed(t):
    return re.sub(r"\s", "", t or "")


def exact(before, now):
    assert sorted(squeezed(x.text) for x in now.collect()) == sorted({squeezed(t) for t in before})


def near(before, now):
    left = [x.text for x in now.collect()]
    assert len(left) == len(before) - 1  # good[1] and its longer copy


def mixed(before, now):
    assert {x.text for x in now.collect()} <= set(before)


def encoded(before, now):
    assert now.count() == len(before) and all(x.n_tokens > 0 for x in now.collect())


def brute_force(rows, net):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of all five stages, with counts; and how many rows each stage left."""
    good = [x for x in rows if net.scores([(x.text or "").encode()])[0] >= 0.3]
    groups = defaultdict(list)
    for x in good:
        groups[squeezed(x.text)].append(x)
    once = sorted((min(g, key=lambda x: (-len(x.text or ""), x.doc_id)) for g in groups.values()), key=lambda x: x.doc_id)
    sets = []
    for x in once:
        w = (x.text or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    least = list(range(len(once)))
    for i in range(len(once)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= chosen_path.THRESHOLD:
                a, b = sorted((least[i], least[j]))
                least = [a if x == b else x for x in least]
    apart = [x for i, x in enumerate(once) if least[i] == i]
    size = {x.doc_id: len((x.text or "").split()) for x in apart}
    sources = sorted({x.source for x in apart}, key=lambda s: (s is None, s))
    total = {s: sum(size[x.doc_id] for x in apart if x.source == s) for s in sources}
    weight = {s: 1.0 + i % 3 for i, s in enumerate(sources)}
    target, free = {}, list(sources)
    while free:  # sources that the level would take over their cap leave the rest to the others
        level = (sum(total.values()) - sum(target.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > 3 * total[s]]
        target |= {s: 3 * total[s] for s in over} or {s: weight[s] * level for s in free}
        free = [s for s in free if s not in target]
    taken = []
    for s in sources:
        start = 0
        for x in sorted((x for x in apart if x.source == s), key=lambda x: hashlib.md5(f"mix:{x.doc_id}:{hashlib.md5((x.text or '').encode()).hexdigest()}".encode()).hexdigest()):
            taken += [x for k in range(3) if size[x.doc_id] and k * total[s] + start + size[x.doc_id] / 2 < target[s]]
            start += size[x.doc_id]
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    out = Counter()
    for x in taken:
        ids = enc.encode_ordinary(x.text)
        out[x.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha(x.text.encode())] += 1
    return out, [len(good), len(once), len(apart), len(taken)]


def test_run_equals_brute_force(spark, tmp_path):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    good = [" ".join(f"{words[(i + j) % 10]}{i}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(20 + 3 * i)) for i in range(30)]
    bad = [" ".join(f"{w}***{i}" for w in words * 2) for i in range(60)]
    texts = [*good, *bad, good[0] + " ", good[1] + " and more", good[9] + " or less", good[10].replace(" ", "\n"), None, "", "short one"]
    data = [(i, t, "en", ["s0", "s1", "s1", "s2", "s1", None][i % 6], len(t or "")) for i, t in enumerate(texts)] + [(3, good[3], "en", "s2", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 30), 0) for i in range(90)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, labels = (spark.read.parquet(f"{tmp_path}/{x}.parquet") for x in ("documents", "labels"))
    net = quality_cnn.learn(docs, labels, fold_of("doc_id", 5) != 0)
    want, left = brute_force(docs.collect(), net)
    assert Counter(tuple(x) for x in corpus_pipeline.run(spark, str(tmp_path)).collect()) == want
    assert len(data) > left[0] + 50 and left[0] > left[1] > left[2] > 0 and max(want.values()) > 1, left
