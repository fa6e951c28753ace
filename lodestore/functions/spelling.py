"""Spelling of user messages, against a dictionary of words with frequencies, by a deletion-neighbourhood index.

Words of up to ``SHORT`` letters in the dictionary meet the words to check in groups, each of a part of either, and leave a row for each word. In a
group, words lose up to ``EDITS`` letters, and pairs that become equal are within as many edits as letters were lost, those lost at the same place
counted once; where both lost the most they must have lost them at the same places. Words are compared by hashes, then letter by letter; nothing is
compared all against all. Longer dictionary words, which can lose too many letters, are indexed by the ``EDITS`` + 1 parts they are cut into, of which one
comes through unchanged and at most ``EDITS`` places off; words meet these by equality, and Spark's own edit distance settles what met.

A word is left as it is if it is short, has digits, marks of code or of a path, inner or only capitals, begins with a capital, is a known name or
stands in the dictionary. Of dictionary words within reach the nearest is taken, then the most frequent, then the first.
Punctuation at the end and all white space stay.

Each distinct word is settled once. A text meets its fixes by a digest of the text, so equal texts are settled
once, too. Defined results: null texts stay null. Dictionary words that are null or empty are ignored; repeated ones count together.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestore import scratch

#: Fixes that go to all tasks; more are shuffled.
BROADCAST_FIXES = 200_000
#: Edits within reach; letters of a dictionary word that is indexed by deletions.
EDITS, SHORT = 2, 16
#: Words to check and dictionary words of a group, about.
ASKED, KNOWN = 32_768, 65_536
# Letters of the shortest word that is checked, marks at a word's end, what words aren't checked.
LEAST = 4
ENDING = r"""[.,!?;:'")]+$"""
LEFT_ALONE = [
    r"\p{Nd}",
    r"[A-Z][a-z]+[A-Z]",
    r"^[A-Z_@#$%^&*()+=\[\]{}|<>?.:/\\]+$",
    r"[-_]",
    r"(?i)https?://|www\.|/Users/|~/|\.[a-z]{2,4}$",
    r"[`*_#{}\[\]\\]",
    r"^\p{Lu}",
]
TOKENS = r"(?U)\s+|\S+"


def stem(token: Column) -> Column:
    """A token without the punctuation at its end."""
    return F.regexp_replace(token, ENDING, "")


def checkable(word: Column) -> Column:
    ok = F.char_length(word) >= LEAST
    for pattern in LEFT_ALONE:
        ok = ok & ~F.regexp_like(word, F.lit(pattern))
    return ok


def words_of(docs: DataFrame, text_col: str = "document") -> DataFrame:
    """word, n: the checkable words of texts and how often each stands there. The texts are read once, and each distinct token is checked once."""
    tokens = docs.select(F.explode(F.regexp_extract_all(text_col, F.lit(r"(?U)\S+"), F.lit(0))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    folder = scratch.folder(docs.sparkSession)
    tokens = scratch.written(tokens, f"{folder}/tokens")  # or the checks would be moved before the aggregate, to every token
    words = tokens.select(stem(F.col("token")).alias("word"), "n").where(checkable(F.col("word"))).groupBy("word").agg(F.sum("n").alias("n"))
    return scratch.written(words, f"{folder}/words")


def frequent(words: DataFrame, least: int) -> DataFrame:
    """word, n: a dictionary of what stands in lower case at least so often."""
    return words.groupBy(F.lower("word").alias("word")).agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _without(word: Column, at: Column) -> Column:
    return F.concat(F.substring(word, F.lit(1), at - 1), F.substring(word, at + 1, F.char_length(word)))


def deletions(word: Column, edits: int = EDITS) -> Column:
    """The distinct strings that a word becomes by losing up to so many letters. Letters are lost from left to right, so each set of places comes once."""
    none = F.array().cast("array<int>")

    def fewer(x: Column) -> Column:
        places = F.when(x["at"] <= F.char_length(x["w"]), F.sequence(x["at"], F.char_length(x["w"]))).otherwise(none)
        return F.transform(places, lambda i: F.struct(_without(x["w"], i).alias("w"), i.alias("at")))

    out, level = F.array(word), F.array(F.struct(word.alias("w"), F.lit(1).alias("at")))
    for _ in range(edits):
        level = F.flatten(F.transform(level, fewer))
        out = F.concat(out, F.transform(level, lambda x: x["w"]))
    return F.array_distinct(out)


def _parts(length: Column, edits: int) -> list[tuple[Column, Column]]:
    """Begin, from 1, and size of the parts of a word of some length."""
    k = edits + 1
    ends = [F.floor(length * i / k).cast("int") for i in range(k + 1)]
    return [(ends[i] + 1, ends[i + 1] - ends[i]) for i in range(k)]


def _key(kind: Column | str, text: Column) -> Column:
    return F.concat(kind if isinstance(kind, Column) else F.lit(kind), F.lit(":"), text)


def index_keys(word: Column, edits: int = EDITS) -> Column:
    """What a dictionary word is found by."""
    return F.when(F.char_length(word) <= SHORT, F.transform(deletions(word, edits), lambda w: _key("d", w))).otherwise(part_keys(word, edits))


def part_keys(word: Column, edits: int = EDITS) -> Column:
    """What a long dictionary word is found by."""
    n = F.char_length(word)
    return F.array(*[_key(F.concat(n.cast("string"), F.lit(f".{i}")), F.substring(word, at, size)) for i, (at, size) in enumerate(_parts(n, edits))])


def lookup_keys(word: Column, edits: int = EDITS) -> Column:
    """What a word to check looks for."""
    n, none = F.char_length(word), F.array().cast("array<string>")
    by_deletion = F.when(n <= SHORT + edits, F.transform(deletions(word, edits), lambda w: _key("d", w))).otherwise(none)
    return F.array_distinct(F.concat(by_deletion, long_keys(word, edits)))


def long_keys(word: Column, edits: int = EDITS) -> Column:
    """What a word to check looks for among long dictionary words."""
    n, none = F.char_length(word), F.array().cast("array<string>")

    def of(m: Column) -> Column:
        keys = [_key(F.concat(m.cast("string"), F.lit(f".{i}")), F.substring(word, at + off, size)) for i, (at, size) in enumerate(_parts(m, edits)) for off in range(-edits, edits + 1)]
        return F.when(m > SHORT, F.array(*keys)).otherwise(none)

    return F.when(n > SHORT - edits, F.flatten(F.transform(F.sequence(n - edits, n + edits), of))).otherwise(none)


@lru_cache
def _losses(edits: int) -> tuple[dict[tuple[int, ...], int], np.ndarray, np.ndarray, np.ndarray]:
    """Ways to lose letters, numbered by length and places; of each the number lost, the places between kept letters (those lost at one place told apart), the letters kept."""
    most = SHORT + edits
    ways = {(n, *lost): 0 for n in range(most + 1) for k in range(edits + 1) for lost in combinations(range(n), k)}
    between, kept = np.full((len(ways), max(edits, 1)), -1, np.int16), np.full((len(ways), most + 1), most, np.int8)
    for way, (n, *lost) in enumerate(ways):
        ways[n, *lost] = way
        gaps = [at - i for i, at in enumerate(lost)]
        between[way, : len(lost)] = [g * (edits + 1) + gaps[:i].count(g) for i, g in enumerate(gaps)]
        kept[way, : n - len(lost)] = [i for i in range(n) if i not in lost]
    return ways, (between >= 0).sum(1), between, kept


_FACTOR = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(_FACTOR)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shorter(words: list[str], edits: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The letters of words, and for each number of lost letters: word, way and hash of what is left."""
    ways = _losses(edits)[0]
    powers = np.array([pow(_FACTOR, i, 1 << 64) for i in range(SHORT + edits + 1)], np.uint64)
    back = np.array([pow(_FACTOR, -i, 1 << 64) for i in range(edits + 1)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters, out = np.zeros((len(words), SHORT + edits + 1), np.uint32), [([], [], []) for _ in range(edits + 1)]
    for n in map(int, np.unique(sizes)):
        rows = np.flatnonzero(sizes == n).astype(np.int32)
        letters[rows, :n] = own = np.frombuffer("".join(words[i] for i in rows).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(rows), n)
        before = np.zeros((n + 1, len(rows)), np.uint64)
        np.cumsum(_mixed(own.T) * powers[:n, None], axis=0, out=before[1:])
        for k in range(min(edits, n) + 1):
            for lost in combinations(range(n), k):
                begins, ends = [0, *(i + 1 for i in lost)], [*lost, n]
                left = sum(((before[e] - before[b]) * back[i] for i, (b, e) in enumerate(zip(begins, ends, strict=True)) if e > b), np.zeros(len(rows), np.uint64))
                for part, x in zip(out[k], (rows, np.full(len(rows), ways[n, *lost], np.int32), left), strict=True):
                    part.append(x)
    return letters, [_joined(x) for x in out]


def _joined(parts: tuple[list[np.ndarray], ...]) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate([*part, np.empty(0, kind)]) for part, kind in zip(parts, (np.int32, np.int32, np.uint64), strict=True))


def _equal(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal hashes in a and b."""
    order = np.argsort(b)
    b = b[order]
    bits = max(len(b) * 8, 1).bit_length()
    held, shift = np.zeros(1 << bits, bool), np.uint64(64 - bits)
    held[_mixed(b) >> shift] = True
    some = np.flatnonzero(held[_mixed(a) >> shift])  # most hashes have no equal
    some = some[np.argsort(a[some])]  # neighbours in a row are looked up faster
    begins = np.flatnonzero(np.diff(b, prepend=~b[:1]))
    at = np.minimum(np.searchsorted(b[begins], a[some]), max(len(begins) - 1, 0))
    low, count = (begins[at], np.diff(begins, append=len(b))[at] * (b[begins[at]] == a[some])) if len(b) else (at, at)
    first = np.repeat(low - (np.cumsum(count) - count), count)
    return np.repeat(some, count), order[first + np.arange(len(first))]


def _nearest(words: list[str], known: list[str], edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each word the edits to its nearest known word and the place of that, the first of equally near ones; more than edits if none is within reach."""
    _, number, between, kept = _losses(edits)
    (asked, mine), (given, theirs) = _shorter(words, edits), _shorter(known, edits)
    best = np.full(len(words), (edits + 1) << 32, np.int64)

    def settle(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], x: np.ndarray, y: np.ndarray) -> None:
        for at in range(0, len(x), 1 << 17):
            i, j = x[at : at + (1 << 17)], y[at : at + (1 << 17)]
            (wi, p), (wj, q) = (a[0][i], a[1][i]), (b[0][j], b[1][j])
            gaps, others = between[p], between[q]
            both = sum(((gaps[:, [m]] == others) & (others >= 0)).sum(1) for m in range(gaps.shape[1]))
            far = number[p] + number[q] - both
            ok = np.flatnonzero(far <= edits)
            same = (np.take_along_axis(asked[wi[ok]], kept[p[ok]].astype(np.int64), 1) == np.take_along_axis(given[wj[ok]], kept[q[ok]].astype(np.int64), 1)).all(1)
            ok = ok[same]
            np.minimum.at(best, wi[ok], (far[ok].astype(np.int64) << 32) + wj[ok])

    def fewer(x: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        return _joined(tuple([part[i] for part in x[:edits]] for i in range(3)))

    def placed(x: tuple[np.ndarray, ...]) -> np.ndarray:
        """Hashes that tell the places apart, too."""
        return x[2] ^ _mixed((between[x[1]].astype(np.int64) @ (1 << 9 * np.arange(between.shape[1]))).astype(np.uint64))

    few, less = fewer(mine), fewer(theirs)
    settle(few, less, *_equal(few[2], less[2]))
    settle(mine[edits], less, *_equal(mine[edits][2], less[2]))
    settle(few, theirs[edits], *_equal(theirs[edits][2], few[2])[::-1])
    settle(mine[edits], theirs[edits], *_equal(placed(mine[edits]), placed(theirs[edits])))
    return best >> 32, best & 0xFFFFFFFF


def _near_short(asked: DataFrame, known: DataFrame, edits: int) -> DataFrame:
    """asked (word), known (fix, n) of at most SHORT letters -> word, fix, n, distance: of the known words in a group with it the one that a word is to be."""
    parts, slices = (max(1, -(-df.count() // most)) for df, most in ((asked, ASKED), (known, KNOWN)))
    parts = max(parts, -(-2 * asked.sparkSession.sparkContext.defaultParallelism // slices))

    def dealt(df: DataFrame, word: str, own: str, n: int, other: str, m: int) -> DataFrame:
        rows = df.withColumn(own, F.pmod(F.xxhash64(word), F.lit(n)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
        return rows.repartition(parts * slices, "part", "slice").groupBy("part", "slice")

    def settled(words: pd.DataFrame, dictionary: pd.DataFrame) -> pd.DataFrame:
        dictionary = dictionary.sort_values(["n", "fix"], ascending=[False, True])
        far, at = _nearest(words.word.tolist(), dictionary.fix.tolist(), edits)
        met = np.flatnonzero(far <= edits)
        fix, n = (dictionary[c].to_numpy()[at[met]] for c in ("fix", "n"))
        return pd.DataFrame({"word": words.word.to_numpy()[met], "fix": fix, "n": n, "distance": far[met].astype(np.int32)})

    words = asked.where(F.char_length("word") <= SHORT + edits)
    return dealt(words, "word", "part", parts, "slice", slices).cogroup(dealt(known, "fix", "slice", slices, "part", parts)).applyInPandas(settled, "word string, fix string, n long, distance int")


def fixes(words: DataFrame, dictionary: DataFrame, names: DataFrame | None = None, edits: int = EDITS) -> DataFrame:
    """words (word) -> word, fix, distance of those that the rules let be changed and that have a dictionary word (word, n) within reach.

    names: known names (name), in any case, that stay as they are.
    """
    folder = scratch.folder(words.sparkSession)
    known = scratch.written(dictionary.where(F.col("word") != "").groupBy(F.col("word").alias("fix")).agg(F.sum("n").cast("long").alias("n")), f"{folder}/known")
    asked = scratch.written(words.select("word").distinct(), f"{folder}/distinct")  # or every word would be checked wherever it stands
    asked = asked.where(checkable(F.col("word"))).withColumn("low", F.lower("word"))
    stay = known.select(F.col("fix").alias("low"))
    if names is not None:
        stay = stay.unionByName(names.select(F.lower("name").alias("low")).distinct())
    asked = scratch.written(asked.join(stay, "low", "left_anti").select("word"), f"{folder}/asked")
    long = F.char_length("fix") > SHORT
    met = asked.select("word", F.explode(long_keys(F.col("word"), edits)).alias("key")).join(known.where(long).select("fix", "n", F.explode(part_keys(F.col("fix"), edits)).alias("key")), "key")
    far = met.select("word", "fix", "n", F.levenshtein("word", "fix", edits).alias("distance")).where(F.col("distance") >= 0)  # met by several keys: harmless for a minimum
    near = far.unionByName(_near_short(asked, known.where(~long), edits))
    best = near.groupBy("word").agg(F.min(F.struct("distance", (-F.col("n")).alias("n"), "fix")).alias("b"))
    return best.select("word", F.col("b.fix").alias("fix"), F.col("b.distance").alias("distance"))


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKENS), F.lit(0))


def _mended(text: Column) -> Column:
    """text with the fixes of the column _fixes."""

    def one(token: Column) -> Column:
        word = stem(token)
        return F.coalesce(F.concat(F.element_at(F.col("_fixes"), word), F.substring(token, F.char_length(word) + 1, F.char_length(token))), token)

    return F.array_join(F.transform(_tokens(text), one), "")


def _with_fixes(docs: DataFrame, read: Column, dictionary: DataFrame, text_col: str, names: DataFrame | None, edits: int) -> DataFrame:
    """docs with _fixes, a map from the words of read (a column of _text) to what they are to be, or null. Equal texts are read once."""
    key = F.sha2(F.col(text_col).cast("binary"), 256)
    texts = docs.where(F.col(text_col).isNotNull()).groupBy(key.alias("_key")).agg(F.first(text_col).alias("_text"))
    held = texts.select("_key", F.explode(F.array_distinct(F.transform(_tokens(read), stem))).alias("word"))
    found = scratch.written(fixes(held, dictionary, names, edits), f"{scratch.folder(docs.sparkSession)}/fixes")
    few = found.count() <= BROADCAST_FIXES
    fixed = held.join(F.broadcast(found) if few else found, "word").groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("word", "fix"))).alias("_fixes"))
    return docs.withColumn("_key", key).join(fixed, "_key", "left").drop("_key")


def corrected(docs: DataFrame, dictionary: DataFrame, text_col: str = "document", names: DataFrame | None = None, out_col: str = "corrected", edits: int = EDITS) -> DataFrame:
    """docs with a column of corrected texts."""
    rows, text = _with_fixes(docs, F.col("_text"), dictionary, text_col, names, edits), F.col(text_col)
    return rows.withColumn(out_col, F.when(F.col("_fixes").isNull(), text).otherwise(_mended(text))).drop("_fixes")


def user_lines(text: Column, mend: Callable[[Column], Column]) -> Column:
    """mend(message) for each line that a user wrote, marked by ``>``; other lines, and empty messages, stay."""

    def line(x: Column) -> Column:
        indent = F.char_length(x) - F.char_length(F.ltrim(x)) + 2
        message = F.substring(x, indent + 1, F.char_length(x))
        return F.when(F.ltrim(x).startswith(">") & (F.trim(message) != ""), F.concat(F.substring(x, F.lit(1), indent), mend(message))).otherwise(x)

    return F.array_join(F.transform(F.split(text, "\n"), line), "\n")


def transcripts(docs: DataFrame, dictionary: DataFrame, text_col: str = "document", names: DataFrame | None = None, out_col: str = "corrected", edits: int = EDITS) -> DataFrame:
    """docs with a column of transcripts in which what users wrote is corrected."""
    said = F.array_join(F.filter(F.split("_text", "\n"), lambda x: F.ltrim(x).startswith(">")), "\n")
    rows, text = _with_fixes(docs, said, dictionary, text_col, names, edits), F.col(text_col)
    return rows.withColumn(out_col, F.when(F.col("_fixes").isNull(), text).otherwise(user_lines(text, _mended))).drop("_fixes")
