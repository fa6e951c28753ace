"""Periodic runs, token alignment and URL rules against brute-force versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lodestore.llm import periodic_runs, queries, token_align, url_rules

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# -- periodic runs


def brute_runs(w: list, least: int = 12) -> list[tuple[int, int, int]]:
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            e = i + q
            if e - s >= max(least, 2 * q) and not any(all(w[x] == w[x + p] for x in range(s, e - p)) for p in range(1, q)):
                out.append((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng: random.Random, kind: int) -> list[int]:
    n = rng.randrange(170)
    if kind < 2:
        return [rng.randrange(2 + 2 * kind) for _ in range(n)]
    if kind == 2:
        out: list[int] = []
        while len(out) < n:
            out += [rng.randrange(9) for _ in range(rng.randrange(1, 30))] * rng.randrange(1, 6)
            out = out[: len(out) - rng.randrange(3)]
        return out
    if kind == 3:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    return [rng.randrange(30)] * n


@pytest.mark.parametrize("least", [12, 2, 7])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for t in range(600):
        w = some_words(rng, t % 5)
        assert periodic_runs.find_runs(np.array(w, np.int32), least) == brute_runs(w, least), w


def test_keys_shorter_than_blocks_lose_no_run(monkeypatch):
    monkeypatch.setattr(periodic_runs, "KEY", 4)
    rng = random.Random(4)
    for _ in range(20):
        unit = [rng.randrange(5) for _ in range(rng.randrange(100, 300))]
        w = [rng.randrange(5) for _ in range(50)] + unit * 3 + unit[:20] + [9] + unit
        assert periodic_runs.find_runs(np.array(w, np.int32)) == brute_runs(w)


def test_periodic_and_long_documents_stay_near_linear():
    assert periodic_runs.find_runs(np.zeros(40_000, np.int32)) == [(0, 40_000, 1)]
    assert periodic_runs.find_runs(np.arange(40_000, dtype=np.int32) % 777) == [(0, 40_000, 777)]


def brute_op11(id_, text):
    words = (text or "").encode().split()
    h = zlib.crc32(b"" if id_ is None else str(id_).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    more = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (id_, len(runs), *more, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_op11_equals_brute_force(spark, tmp_path):
    rng = random.Random(11)
    texts = [None, "", " \t\n\x0b\x0c\r ", "a\x1cb \x85c\xa0d", "x " * 30, "é ü\n" * 9]
    texts += ["".join(f"{w}{rng.choice([' ', chr(10), '  '])}" for w in some_words(rng, k % 5)) for k in range(150)]
    rows = [(i if i % 9 else None, t, 1) for i, t in enumerate(texts)] + [(7, "a b " * 10, 1)] * 3
    spark.createDataFrame(rows, "doc_id long, text string, runs int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((brute_op11(i, t) for i, t, _ in rows), key=str)
    assert any(r.n_runs > 1 for r in got)


def test_runs_of_an_empty_table_and_other_columns(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.annotate(none).collect() == []
    one = spark.createDataFrame([("k", "a b a b a b a b a b a b c", 5)], "name string, text string, collapsed int")
    row = periodic_runs.annotate(one).first()
    assert (row["name"], row["collapsed"]) == ("k", "a b c") and [tuple(r) for r in row["runs"]] == [(0, 12, 2)]


# -- alignment of tokenizers


def brute_align(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    letters = token_align.byte_letters()
    docs = []
    for id_, t in rows:
        groups, n_a, n_b = [], 0, 0
        if t:
            x, y = a.encode(f" {t}", add_special_tokens=False), b.encode(t)
            x_bytes = [bytes(letters[c] for c in p) for p in x.tokens]
            y_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
            if b"".join(x_bytes) == b"".join(y_bytes) == f" {t}".encode():
                n_a, n_b = len(x_bytes), len(y_bytes)
                x_ends, y_ends = np.cumsum([len(p) for p in x_bytes]).tolist(), np.cumsum([len(p) for p in y_bytes]).tolist()
                i = j = 0
                for end in sorted(set(x_ends) & set(y_ends)):
                    i2, j2 = x_ends.index(end) + 1, y_ends.index(end) + 1
                    groups.append((x.ids[i:i2], y[j:j2]))
                    i, j = i2, j2
        docs.append((id_, n_a, n_b, groups))
    counts: Counter = Counter()
    for *_, groups in docs:
        counts.update({(p, q) for x, y in groups for p in x for q in y})
    top: dict = defaultdict(int)
    for (p, _), n in counts.items():
        top[p] = max(top[p], n)
    out = []
    for id_, n_a, n_b, groups in docs:
        links = [(p, q) for x, y in groups for p in x for q in y]
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((id_, n_a, n_b, len(groups), len(links), sum(counts[x] == top[x[0]] for x in links), sum(counts[x] for x in links), sha))
    return out


ODD = ["", None, " ", "a  b", "\n\n x\t", "<|endoftext|> hi <s>", "▁x", "日本語のテキスト。 漢字", "a\x1c.b\x85c\xa0d", "don't  won't\r\n\r\nit's", "x" * 300, "é" * 50, "🙂🙃 ok", "\x00\x01", " lead", "trail  ", "!!!???...", "1234567890 12", "a b　c"]
PARTS = ["a", "the ", "  ", "\n", "\n\n", "\t", "ing", "'s", " ", "é", "漢", "🙂", "<|endoftext|>", ".", "1", "\x1d", "\xa0", "b", "\r", "▁"]


def odd_texts(n: int) -> list:
    rng = random.Random(5)
    return ODD + ["".join(rng.choice(PARTS[: len(PARTS) - (k % 9 > 0)]) for _ in range(rng.randrange(30))) for k in range(n)]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("block_chars", [8 << 20, 300])
def test_op12_equals_brute_force(spark, monkeypatch, block_chars):
    rows = [(i if i % 7 else None, t) for i, t in enumerate(odd_texts(150))] + [(3, "the same, again.")] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("code", F.lit(1)).repartition(3)
    monkeypatch.setattr(token_align, "BLOCK_CHARS", block_chars)
    monkeypatch.setattr(token_align, "SLICE_CHARS", min(block_chars, token_align.SLICE_CHARS))
    if block_chars < 1000:
        assert token_align.encoded(docs, A_PATH, B_PATH).select("block").distinct().count() > 3
    got = token_align.align(docs, A_PATH, B_PATH).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_align(rows), key=str)


def test_units_cut_as_whole_texts():
    pair = token_align.Pair(A_PATH, B_PATH)
    assert pair.by_unit
    texts = [f" {t}" for t in odd_texts(300) if t]
    known = pair.learn(sorted({u for t in texts for u in pair.split(t)}))
    by_unit = [";".join(pair.unit_text[known[u]] for u in pair.split(t)) for t in texts]
    pair.by_unit = False
    whole = pair.learn(sorted(set(texts)))
    facts = pair.tables()[0]
    for t, cut in zip(texts, by_unit, strict=True):
        if facts[whole[t], 4]:
            assert pair.unit_text[whole[t]] == cut, t


def test_alignment_of_an_empty_table(spark):
    assert token_align.align(spark.createDataFrame([], "doc_id long, text string"), A_PATH, B_PATH).collect() == []


# -- URL rules

GIVEN = queries.URL_RULES
URLS = [None, "", "nothing", "http://", "http://Example.ORG", "HTTP://a.Example.ORG/es/x", "https://example.org/en/17?q=1", "https://example.org/en/27#t", "http://x.com/fr/", "http://com/de/1", "http://notcom/de/1",
        "ftp://u:p@h.com:80/de/a?b://c", "x://y.org?p=/es/", "http://e.net/de/1.html", "a\nb://c.org/\nd"]


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min((path.index(c) for c in "?#" if c in path), default=len(path))]
    fits = [(text, verdict) for verdict, text in GIVEN if (host == text.split("/")[0] or host.endswith("." + text.split("/")[0])) and path.startswith("/" + text.split("/", 1)[1])]
    return (host, path, *(max(fits, key=lambda x: len(x[0])) if fits else (None, None)))


def brute_mine(labelled, min_support, min_confidence):
    """labelled: (tokens, label). Every subset is counted."""
    n, both, alone = len(labelled), Counter(), Counter()
    for words, label in labelled:
        for k in range(1, len(words) + 1):
            for c in combinations(sorted(words), k):
                alone[frozenset(c)] += 1
                both[frozenset(c), label] += 1
    rules = {(c, label): (round(m / alone[c], 9), round(m / n, 9)) for (c, label), m in both.items() if m >= min_support * n and m / alone[c] >= min_confidence}
    return {(c, label, *v) for (c, label), v in rules.items() if not any(x < c and y == label and rules[x, y][0] >= v[0] for x, y in rules)}


def some_urls(n: int) -> list[str]:
    rng = random.Random(13)
    end = ["", "/", ".html", "?page=2&ref=x", "#top"]
    return [f"http://{rng.choice(['', 'm.', 'blog.'])}{rng.choice(['one', 'two'])}.example.{rng.choice(['org', 'com', 'net'])}/{rng.choice(['en', 'fr', 'de', 'es'])}/{rng.randrange(300)}{rng.choice(end)}" for _ in range(n)]


def test_op13_equals_brute_force(spark, tmp_path):
    rows = [(i if i != 5 else None, u, "<p>") for i, u in enumerate(URLS + some_urls(400))] + [(1, "http://one.example.net/es/1", None)] * 3
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op13_url_rules(spark, str(tmp_path)).collect()
    tokens = {r.url: r.t for r in pages.select("url", url_rules.tokens(F.col("url")).alias("t")).collect()}
    labelled = [(tokens[u], brute_url(u)[3]) for _, u, _ in rows if brute_url(u)[2]]
    rules = sorted(brute_mine(labelled, url_rules.MIN_SUPPORT, url_rules.MIN_CONFIDENCE), key=lambda r: (-r[2], -r[3], len(r[0]), sorted(r[0]), r[1]))
    default = min(Counter(label for _, label in labelled).items(), key=lambda x: (-x[1], x[0]))[0]
    expected = []
    for id_, u, _ in rows:
        host, path, rule, verdict = brute_url(u)
        mined = next((r for r in rules if r[0] <= set(tokens[u])), None)
        expected.append((id_, host, path, rule, verdict or (mined[1] if mined else default), None if rule or not mined else " ".join(sorted(mined[0]))))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert any(r.rule is None and r.verdict == "block" for r in got)


def test_urls_without_labels_and_without_rows(spark):
    urls = spark.createDataFrame([("http://a.net/x", "z"), (None, "z")], "url string, host string")
    assert [(r.host, r.verdict, r.mined_rule) for r in url_rules.judge(urls, GIVEN).collect()] == [("a.net", "allow", None), ("", "allow", None)]
    assert url_rules.judge(urls.limit(0), GIVEN).collect() == []
    labelled = spark.createDataFrame([("http://a.net/x", "block"), ("http://b.net/y", None)], "url string, label string")
    assert {r.verdict for r in url_rules.judge(urls, [], labelled=labelled).collect()} == {"block"}


def test_of_equally_sure_rules_the_first_in_order_decides():
    rules = url_rules.Rules(url_rules.pruned([(frozenset("a"), "allow", 0.9, 0.5), (frozenset("ab"), "block", 0.95, 0.1), (frozenset("ac"), "allow", 0.9, 0.2)]), "allow")
    assert [r[0] for r in rules.found] == [frozenset("ab"), frozenset("a")]
    assert rules.decide(["a", "b"]) == ("block", "a b") and rules.decide(["a"]) == ("allow", "a") and rules.decide(["b"]) == ("allow", None)
