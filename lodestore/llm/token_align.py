"""Alignment of two tokenizers over a corpus, by a dictionary of groups.

Both tokenizers encode a space and the text. Byte offsets at which tokens of both end cut the tokens into groups;
all tokens of one group are linked across it. Groups are interned: a block of documents (``BLOCK_CHARS`` of
one task, or one longer document) has a dictionary of its distinct groups with the number of its documents
that hold each, and documents refer to it. The blocks' dictionaries meet in one aggregate; links are then expanded
once per distinct group of the corpus and weighed by its documents. A document that links one id
pair in several groups would count for each, so what is too much is counted in the blocks and taken off. What the
counts give for each group is joined back to the blocks' dictionaries by the group, and from there, a
block at a time, to the documents.

No text, token or occurrence of a group is shuffled; a block sends a row for each of its distinct groups, so
the most frequent group or pair has a row a block. Rows of a block meet in one task, which holds no more than one block.

Between runs of white space neither tokenizer joins anything (checked for each pair of files; where it
doesn't hold, and for texts with a blank that pieces of B join, such as a carriage return, whole texts are encoded), so a text's tokens are those of its units, a run of white space with
what follows up to the next. Units met before in the worker are taken from a cache of ``CACHED_UNITS``
units of ``CACHED_CHARS`` characters at most, which starts anew after the block that fills it.

Defined results: a text that is null or empty, or whose tokens' bytes of either side are not those of a space and the
text, has no tokens: zeros, and an empty groups_sha256. Special tokens' strings are ordinary text. Repeated rows are documents each. An empty table gives an empty
result. Ids may be null; columns besides id and text are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from lodestore.llm.common import stored

#: Characters of text in a block, unless one document has more, and in a slice of it that is laid out at once.
BLOCK_CHARS, SLICE_CHARS = 8 << 20, 1 << 19
#: Units that a worker keeps, and characters of a unit that it keeps.
CACHED_UNITS, CACHED_CHARS = 400_000, 48
#: Characters encoded in one call.
CALL_CHARS = 1 << 12
DOCUMENT, GROUP, REPEAT = 0, 1, 2
SPACE_PIECE = "▁"
# White space by Unicode.
BLANKS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNIT = re.compile(f"[{BLANKS}]*[^{BLANKS}]+|[{BLANKS}]+")
_BLANK = re.compile(f"[{BLANKS}]")
_workers: dict = {}


def byte_letters() -> dict[str, int]:
    """Byte-level tokenizers write printable bytes as themselves and the others, in order, as letters from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Two tokenizers: A a byte-level file of the tokenizers library, B a sentencepiece model. Lives as long as its Python worker."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        vocab = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        specials = {x["id"] for x in json.loads(self.a.to_str())["added_tokens"]}
        self.a_bytes = [b""] * (max(vocab) + 1)
        for i, t in vocab.items():
            self.a_bytes[i] = t.encode() if i in specials else bytes(letters[c] for c in t)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_PIECE, " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.width = len(self.b_bytes)
        plain = [p.lstrip(SPACE_PIECE) for i, p in enumerate(pieces) if not self.b.is_byte(i) and len(p) > 1]
        pre = json.loads(self.a.to_str())["pre_tokenizer"] or {}
        self.by_unit = (
            (pre.get("type"), pre.get("use_regex"), pre.get("add_prefix_space")) == ("ByteLevel", True, False)
            and json.loads(self.a.to_str())["normalizer"] is None
            and pieces[self.b.encode("\na")[0]] == SPACE_PIECE
            and not any(SPACE_PIECE in p for p in plain)
        )
        self.sticky = {c for p in plain for c in _BLANK.findall(p)}
        self._forget()

    def _forget(self) -> None:
        self.units: dict[str, int] = {}
        self.groups: dict[str, int] = {}
        self.group_text: list[str] = []
        self.unit_text: list[str] = []
        # one after the other, with where they begin: pairs of groups, groups of units; tokens of A, of B, groups, links of units and whether bytes agree
        self.pairs, self.pair_at, self.unit_groups, self.unit_at, self.facts = array("q"), array("q", [0]), array("q"), array("q", [0]), array("q")
        self.laid_out: tuple[int, tuple] = (-1, ())

    def forget_if_full(self) -> None:
        if len(self.units) > CACHED_UNITS or len(self.unit_text) > CACHED_UNITS:
            self._forget()

    def encode_a(self, text: str) -> list[int]:
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode_b(self, text: str) -> list[int]:
        """text begins with white space; what B puts before a text isn't in the ids, unless text begins with it."""
        if text == " ":  # it puts nothing before an empty text
            return [self.b.piece_to_id(SPACE_PIECE)]
        return self.b.encode(text[1:]) if text[0] == " " else self.b.encode(text)[1:]

    def _intern(self, a: list[int], b: list[int], text: str) -> int:
        code = self.groups[text] = len(self.group_text)
        self.group_text.append(text)
        if len(a) == len(b) == 1:
            self.pairs.append(a[0] * self.width + b[0])
        else:
            self.pairs.extend(sorted({i * self.width + j for i in set(a) for j in set(b)}))
        self.pair_at.append(len(self.pairs))
        return code

    def learn(self, new: list[str]) -> dict[str, int]:
        """Numbers of units that the cache hasn't; it has the short ones afterwards."""
        out: dict[str, int] = {}
        batch: list[str] = []
        size = 0
        for u in new:
            if not self.by_unit or _BLANK.match(u[-1]) or any(c in u for c in self.sticky):  # such as white space at the end of a text
                self._learn([u], out)
                continue
            batch.append(u)
            size += len(u)
            if size >= CALL_CHARS:
                self._learn(batch, out)
                batch, size = [], 0
        if batch:
            self._learn(batch, out)
        return out

    def _learn(self, units: list[str], out: dict[str, int]) -> None:
        text = "".join(units)
        data = text.encode()
        a, b = self.encode_a(text), self.encode_b(text)
        agree = b"".join([self.a_bytes[i] for i in a]) == data and b"".join([self.b_bytes[i] for i in b]) == data
        if not agree and len(units) > 1:  # halves lead to those whose bytes differ
            self._learn(units[: len(units) // 2], out)
            self._learn(units[len(units) // 2 :], out)
            return
        if not agree:
            self._add(units[0], [], (0, 0, 0, 0, False), out)
            return
        ends = np.cumsum([len(u.encode()) for u in units])
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        i_at, j_at = (np.concatenate([[0], np.searchsorted(x, common, "right")]) for x in (a_ends, b_ends))
        links = np.concatenate([[0], np.cumsum(np.diff(i_at) * np.diff(j_at))])
        last = np.searchsorted(common, ends, "right")
        first = np.concatenate([[0], last[:-1]])
        facts = zip((i_at[last] - i_at[first]).tolist(), (j_at[last] - j_at[first]).tolist(), (last - first).tolist(), (links[last] - links[first]).tolist(), strict=True)
        a_text, b_text, known = list(map(str, a)), list(map(str, b)), self.groups
        codes, i, j = [], 0, 0
        for i2, j2 in zip(i_at[1:].tolist(), j_at[1:].tolist(), strict=True):
            group = f"{a_text[i]}|{b_text[j]}" if i2 - i == j2 - j == 1 else f"{','.join(a_text[i:i2])}|{','.join(b_text[j:j2])}"
            codes.append(known[group] if group in known else self._intern(a[i:i2], b[j:j2], group))
            i, j = i2, j2
        for u, f, l, fact in zip(units, first.tolist(), last.tolist(), facts, strict=True):
            self._add(u, codes[f:l], (*fact, True), out)

    def _add(self, unit: str, codes: list[int], facts: tuple[int, int, int, int, bool], out: dict[str, int]) -> None:
        number = out[unit] = len(self.unit_text)
        if len(unit) <= CACHED_CHARS:
            self.units[unit] = number
        self.unit_text.append(";".join([self.group_text[c] for c in codes]))
        self.unit_groups.extend(codes)
        self.unit_at.append(len(self.unit_groups))
        self.facts.extend(facts)

    def split(self, text: str) -> list[str]:
        return _UNIT.findall(text) if self.by_unit and not any(c in text for c in self.sticky) else [text]

    def tables(self) -> tuple:
        """Facts of units as arrays; groups of units and pairs of groups, one after the other, with their beginnings."""
        if self.laid_out[0] != len(self.unit_text):
            facts, *rest = (np.array(x, np.int64) for x in (self.facts, self.unit_at, self.unit_groups, self.pair_at, self.pairs))
            self.laid_out = len(self.unit_text), (facts.reshape(-1, 5), *rest)
        return self.laid_out[1]


def _pair(a_path: str, b_path: str) -> Pair:
    if (a_path, b_path) not in _workers:
        _workers[a_path, b_path] = Pair(a_path, b_path)
    return _workers[a_path, b_path]


def _spread(at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of which, its places at[i] to at[i + 1]: the number in which, and the place."""
    size = at[which + 1] - at[which]
    owner = np.repeat(np.arange(len(which)), size)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + at[which][owner]


def _counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each comes, or the sum of its weights."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], np.diff(keys) != 0]))
    if weights is None:
        return keys[first], np.diff(np.concatenate([first, [len(keys)]]))
    return keys[first], np.add.reduceat(weights[order], first)


FACTS = ("n_a", "n_b", "n_groups", "n_links")


def encoded(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A written table of blocks. kind DOCUMENT: id, its numbers and digest, its distinct groups by their codes in the block with their frequencies.
    GROUP: code, group and the documents of the block that hold it. REPEAT: an id pair and how often documents of the block hold it in one more group."""
    ids = docs.select(id_col).schema[0].dataType
    long, ints = LongType(), ArrayType(IntegerType(), False)
    schema = StructType(
        [
            StructField("kind", IntegerType()), StructField("block", long), StructField("id", ids), *(StructField(x, long) for x in FACTS), StructField("groups_sha256", StringType()),
            StructField("codes", ints), StructField("freqs", ints), StructField("code", IntegerType()), StructField("group", StringType()), StructField("docs", long), StructField("pair", long),
        ]
    )
    names = schema.names

    def rows(n: int, id_type: pa.DataType, **columns: pa.Array) -> pa.RecordBatch:
        kinds = {"kind": pa.int32(), "block": pa.int64(), "id": id_type, **dict.fromkeys(FACTS, pa.int64()), "groups_sha256": pa.string(), "codes": pa.list_(pa.int32()), "freqs": pa.list_(pa.int32()), "code": pa.int32(), "group": pa.string(), "docs": pa.int64(), "pair": pa.int64()}
        return pa.RecordBatch.from_arrays([columns.get(x, pa.nulls(n, kinds[x])) for x in names], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a_path, b_path)
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, tuple]] = []  # slices of a block
        seen, repeats, chars = [], [], 0

        def take(part_ids: pa.Array, texts: list[str]) -> None:
            units = [pair.split(f" {t}") if t else [] for t in texts]
            new = sorted({u for x in units for u in x if u not in pair.units})
            more = pair.learn(new)
            get = (pair.units | more).__getitem__ if any(len(u) > CACHED_CHARS for u in more) else pair.units.__getitem__
            numbers = [np.array([get(u) for u in x], np.int64) for x in units]
            facts, at, flat, pair_at, pairs = pair.tables()
            good = np.array([len(x) > 0 and bool(facts[x, 4].all()) for x in numbers], bool)
            numbers = [x if g else x[:0] for x, g in zip(numbers, good, strict=True)]
            size = np.array([len(x) for x in numbers], np.int64)
            sums = np.zeros((len(texts), 4), np.int64)
            sums[size > 0] = np.add.reduceat(facts[np.concatenate(numbers), :4], (np.cumsum(size) - size)[size > 0], axis=0) if size.any() else 0
            text_of = pair.unit_text
            sha = [hashlib.sha256(";".join([text_of[i] for i in x.tolist()]).encode()).hexdigest() if len(x) else "" for x in numbers]
            # distinct units of each document, their groups, distinct groups, their pairs
            span = max(1, len(pair.unit_text))
            keys, n = _counted(np.repeat(np.arange(len(texts)), size) * span + (np.concatenate(numbers) if size.any() else np.zeros(0, np.int64)))
            owner, place = _spread(at, keys % span)
            span_g = max(1, len(pair.group_text))
            keys, freq = _counted((keys // span)[owner] * span_g + flat[place], n[owner])
            doc, group = keys // span_g, keys % span_g
            seen.append(_counted(group))
            owner, place = _spread(pair_at, group)
            span_p = len(pair.a_bytes) * pair.width
            held_pairs, times = _counted(doc[owner] * span_p + pairs[place])
            again = times > 1
            repeats.append(_counted(held_pairs[again] % span_p, times[again] - 1))
            held.append((part_ids, (sums, sha, doc, group, freq)))

        def close() -> Iterator[pa.RecordBatch]:
            block = (part << 33) + number
            id_type = held[0][0].type
            used, n_docs = _counted(np.concatenate([k for k, _ in seen]), np.concatenate([n for _, n in seen]))
            for part_ids, (sums, sha, doc, group, freq) in held:
                n = len(part_ids)
                ends = pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32))
                lists = {"codes": np.searchsorted(used, group), "freqs": freq}
                columns = {k: pa.ListArray.from_arrays(ends, pa.array(v.astype(np.int32))) for k, v in lists.items()} | {k: pa.array(sums[:, i]) for i, k in enumerate(FACTS)}
                yield rows(n, id_type, kind=pa.array(np.full(n, DOCUMENT, np.int32)), block=pa.array(np.full(n, block)), id=part_ids, groups_sha256=pa.array(sha, pa.string()), **columns)
            for i in range(0, len(used), 1 << 16):
                u, d = used[i : i + (1 << 16)], n_docs[i : i + (1 << 16)]
                texts = pa.array([pair.group_text[c] for c in u.tolist()], pa.string())
                yield rows(len(u), id_type, kind=pa.array(np.full(len(u), GROUP, np.int32)), block=pa.array(np.full(len(u), block)), code=pa.array(np.arange(i, i + len(u), dtype=np.int32)), group=texts, docs=pa.array(d))
            p, extra = _counted(np.concatenate([k for k, _ in repeats]), np.concatenate([n for _, n in repeats]))
            for i in range(0, len(p), 1 << 16):
                q, d = p[i : i + (1 << 16)], extra[i : i + (1 << 16)]
                yield rows(len(q), id_type, kind=pa.array(np.full(len(q), REPEAT, np.int32)), block=pa.array(np.full(len(q), block)), docs=pa.array(d), pair=pa.array(q))

        for b in batches:
            i = 0
            while i < b.num_rows:
                first, texts, size = i, [], 0
                while i < b.num_rows and size < SLICE_CHARS:
                    texts.append(b.column(1)[i].as_py() or "")
                    size += len(texts[-1])
                    i += 1
                take(b.column(0).slice(first, i - first), texts)
                chars += size
                if chars >= BLOCK_CHARS:
                    yield from close()
                    pair.forget_if_full()
                    held, seen, repeats, chars, number = [], [], [], 0, number + 1
        if held:
            yield from close()
            pair.forget_if_full()

    return stored(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema), "aligned")


def _expanded(groups: DataFrame) -> DataFrame:
    """Rows with a group -> a, b and times (links of these ids in one occurrence of it) for each of its distinct id pairs."""
    counted = lambda side: F.transform(
        F.array_distinct(F.split(side, ",")), lambda x: F.struct(x.cast("int").alias("id"), F.size(F.filter(F.split(side, ","), lambda y: y == x)).alias("n"))
    )
    sides = F.split("group", r"\|")
    one = groups.withColumn("x", F.explode(counted(F.get(sides, F.lit(0)))))
    both = one.withColumn("y", F.explode(counted(F.get(sides, F.lit(1)))))
    return both.select(*groups.columns, F.col("x.id").alias("a"), F.col("y.id").alias("b"), (F.col("x.n") * F.col("y.n")).cast("long").alias("times"))


def pair_counts(blocks: DataFrame, width: int) -> DataFrame:
    """From encoded(): a, b, docs (how many documents hold them linked), best (whether no other b of that a has more); a written table.

    width: ids of B."""
    groups = blocks.where(F.col("kind") == GROUP).groupBy("group").agg(F.sum("docs").alias("docs"))
    more = blocks.where(F.col("kind") == REPEAT).select(F.floor(F.col("pair") / width).cast("int").alias("a"), (F.col("pair") % width).cast("int").alias("b"), (-F.col("docs")).alias("docs"))
    counts = stored(_expanded(groups).select("a", "b", "docs").unionByName(more).groupBy("a", "b").agg(F.sum("docs").alias("docs")), "pairs")
    top = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return stored(counts.join(top, "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best")), "counts")


def group_values(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """For each distinct group: n_best and count_sum of one occurrence of it."""
    groups = blocks.where(F.col("kind") == GROUP).select("group").distinct()
    linked = _expanded(groups).join(counts, ["a", "b"])
    return linked.groupBy("group").agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum"))


def _valued(names: list[str]):
    """A function of a block's documents and its dictionary with values: the documents with sums over their groups."""

    def run(docs: pa.Table, values: pa.Table) -> pa.Table:
        code = values.column("code").to_numpy()
        held = np.zeros((len(code), 2), np.int64)
        held[code] = np.stack([values.column("n_best").to_numpy(), values.column("count_sum").to_numpy()], axis=1) if len(code) else 0
        lists, freqs = docs.column("codes").combine_chunks(), docs.column("freqs").combine_chunks()
        size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        each = held[lists.flatten().to_numpy()] * freqs.flatten().to_numpy().astype(np.int64)[:, None]
        sums = np.zeros((len(size), 2), np.int64)
        if size.any():
            sums[size > 0] = np.add.reduceat(each, (np.cumsum(size) - size)[size > 0], axis=0)
        columns = {"n_best": pa.array(sums[:, 0]), "count_sum": pa.array(sums[:, 1])}
        return pa.table([columns[x] if x in columns else docs.column(x) for x in names], names=names)

    return run


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, n_a, n_b, n_groups, n_links, n_best (links to the b that most documents link with their a), count_sum (over links, of
    the documents that link their id pair) and groups_sha256."""
    import sentencepiece

    blocks = encoded(docs, a_path, b_path, id_col, text_col)
    counts = pair_counts(blocks, sentencepiece.SentencePieceProcessor(model_file=b_path).vocab_size())
    dictionary = blocks.where(F.col("kind") == GROUP).select(F.col("block").alias("of_block"), "code", "group")
    valued = dictionary.join(group_values(blocks, counts), "group").select("of_block", "code", "n_best", "count_sum")
    rows = blocks.where(F.col("kind") == DOCUMENT).select("block", "id", *FACTS, "groups_sha256", "codes", "freqs")
    out = StructType([rows.schema["id"], *(StructField(x, LongType()) for x in (*FACTS, "n_best", "count_sum")), StructField("groups_sha256", StringType())])
    joined = rows.groupBy("block").cogroup(valued.groupBy("of_block")).applyInArrow(_valued(out.names), out)
    return joined.withColumnRenamed("id", id_col)
