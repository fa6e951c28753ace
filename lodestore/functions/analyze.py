"""The full-text analyzer: words and numbers of a text, in lower case, folded to ASCII, English suffixes stripped.

Words end where the class of character changes (letter, digit, other). Folding takes marks off
Latin letters. The stemmer is the English Snowball one (Porter2): regions by two positions in the word, then
steps of which each looks for its longest suffix and replaces it if that suffix stands in the
step's region. Steps are SQL expressions over the columns before them, so a vocabulary is stemmed in columns, once for each
distinct word; ``steps`` is the automaton as data, and runs on any engine that has the functions.

Defined results: null text has no words. Words with a letter outside a-z, and numbers, are their own stems.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"\p{L}+|\p{N}+"
#: Letters that fold to several, or that carry no mark.
FOLDS = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ø": "o", "đ": "d", "ð": "d", "ł": "l", "ħ": "h", "ı": "i"}


def _marked() -> dict[str, str]:
    """Lower-case Latin letters with marks and what they are without."""
    out = {}
    for block in (range(0xC0, 0x250), range(0x1E00, 0x1F00)):
        for c in map(chr, block):
            base = unicodedata.normalize("NFD", c)[0]
            if c == c.lower() and c != base and "a" <= base <= "z":
                out[c] = base
    return out


def folded(text: Column) -> Column:
    """text in lower case without the marks of Latin letters."""
    marked = _marked()
    plain = F.lower(F.coalesce(text, F.lit("")))
    out = F.translate(plain, "".join(marked) + "".join(map(chr, range(0x300, 0x370))), "".join(marked.values()))
    for a, b in FOLDS.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.when(F.octet_length(text) == F.length(text), plain).otherwise(out)  # nothing to fold in ASCII


def words(text: str | Column) -> Column:
    """The words of a text in order, folded but not stemmed."""
    return F.regexp_extract_all(folded(F.col(text) if isinstance(text, str) else text), F.lit(WORD), F.lit(0))


# Fixed values of the stemmer.
STAY_AFTER_1A = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
STEP_2 = {
    "ational": "ate", "fulness": "ful", "iveness": "ive", "ization": "ize", "ousness": "ous", "biliti": "ble", "lessli": "less", "tional": "tion", "alism": "al", "aliti": "al", "ation": "ate", "entli": "ent",
    "fulli": "ful", "iviti": "ive", "ousli": "ous", "abli": "able", "alli": "al", "anci": "ance", "ator": "ate", "enci": "ence", "izer": "ize", "bli": "ble", "ogi": "og", "li": "",
}
STEP_3 = {"ational": "ate", "tional": "tion", "alize": "al", "ative": "", "icate": "ic", "iciti": "ic", "ical": "ic", "ness": "", "ful": ""}
STEP_4 = ["ement", "able", "ance", "ence", "ible", "ment", "ant", "ate", "ent", "ion", "ism", "iti", "ive", "ize", "ous", "al", "er", "ic"]
DOUBLES = ["bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"]
V, NOT_V = "[aeiouy]", "[^aeiouy]"
#: Ends in a short syllable: vowel and consonant, before which stands a consonant or nothing.
SHORT = f"{NOT_V}{V}[^aeiouywxY]$|^{V}{NOT_V}$"


def _any(endings) -> str:
    return f"({'|'.join(endings)})$"


def _has(c: str, pattern: str) -> str:
    return f"regexp_extract({c}, '({pattern})', 1) <> ''"


def _cut(c: str, n: str = "1") -> str:
    return f"substr({c}, 1, length({c}) - {n})"


def _found(c: str, endings) -> str:
    """Leftmost is longest, as all end where the word ends."""
    return f"regexp_extract({c}, '{_any(endings)}', 1)"


def steps(word: str, replace: Callable[[str, str, str], str]) -> list[list[tuple[str, str]]]:
    """Levels of (column, SQL expression); a level's expressions see the columns of earlier levels. The last column is ``stem``.

    replace: the engine's call that replaces all matches of a pattern with one group: (column, pattern, text that follows the group).
    """
    table = lambda c, suffix, rules: f"CASE {suffix} " + " ".join(f"WHEN '{k}' THEN {_cut(c, str(len(k)))} || '{v}'" for k, v in rules.items()) + f" ELSE {c} END"
    first = f"^{NOT_V}*{V}+{NOT_V}"
    return [
        [("s0", f"CASE WHEN substr({word}, 1, 1) = 'y' THEN 'Y' || substr({word}, 2) ELSE {word} END")],
        [("s1", replace("s0", f"({V})y", "Y"))],
        [("r1", f"CASE WHEN {_has('s1', '^gener|^commun|^arsen')} THEN length(regexp_extract(s1, '(^gener|^commun|^arsen)', 1)) WHEN {_has('s1', first)} THEN length(regexp_extract(s1, '({first})', 1)) ELSE length(s1) END")],
        [
            ("r2", f"CASE WHEN {_has('substr(s1, r1 + 1)', first)} THEN r1 + length(regexp_extract(substr(s1, r1 + 1), '({first})', 1)) ELSE length(s1) END"),
            ("e1a", _found("s1", ["sses", "ied", "ies", "us", "ss", "s"])),
        ],
        [("a", f"CASE WHEN e1a = 'sses' THEN {_cut('s1', '2')} WHEN e1a IN ('ied', 'ies') THEN CASE WHEN length(s1) > 4 THEN {_cut('s1', '2')} ELSE {_cut('s1')} END WHEN e1a = 's' AND {_has(_cut('s1', '2'), V)} THEN {_cut('s1')} ELSE s1 END")],
        [("e1b", _found("a", ["eedly", "ingly", "edly", "eed", "ing", "ed"]))],
        [("b0", _cut("a", "length(e1b)"))],
        [
            (
                "b",
                f"CASE WHEN e1b = '' THEN a WHEN e1b IN ('eed', 'eedly') THEN CASE WHEN length(b0) >= r1 THEN b0 || 'ee' ELSE a END WHEN NOT {_has('b0', V)} THEN a "
                f"WHEN {_has('b0', _any(['at', 'bl', 'iz']))} THEN b0 || 'e' WHEN {_has('b0', _any(DOUBLES))} THEN {_cut('b0')} WHEN length(b0) <= r1 AND {_has('b0', SHORT)} THEN b0 || 'e' ELSE b0 END",
            )
        ],
        [("c", f"CASE WHEN {_has('b', f'^.+{NOT_V}[yY]$')} THEN {_cut('b')} || 'i' ELSE b END")],
        [("e2", _found("c", STEP_2))],
        [("d", f"CASE WHEN e2 = '' OR length(c) - length(e2) < r1 THEN c WHEN e2 = 'ogi' AND NOT {_has('c', 'logi$')} THEN c WHEN e2 = 'li' AND NOT {_has('c', '[cdeghkmnrt]li$')} THEN c ELSE {table('c', 'e2', STEP_2)} END")],
        [("e3", _found("d", STEP_3))],
        [("f", f"CASE WHEN e3 = '' OR length(d) - length(e3) < r1 THEN d WHEN e3 = 'ative' AND length(d) - 5 < r2 THEN d ELSE {table('d', 'e3', STEP_3)} END")],
        [("e4", _found("f", STEP_4))],
        [("g", f"CASE WHEN e4 = '' OR length(f) - length(e4) < r2 THEN f WHEN e4 = 'ion' AND NOT {_has('f', '[st]ion$')} THEN f ELSE {_cut('f', 'length(e4)')} END")],
        [
            (
                "h",
                f"CASE WHEN {_has('g', 'e$')} AND (length(g) - 1 >= r2 OR (length(g) - 1 >= r1 AND NOT {_has(_cut('g'), SHORT)})) THEN {_cut('g')} WHEN {_has('g', 'll$')} AND length(g) - 1 >= r2 THEN {_cut('g')} ELSE g END",
            )
        ],
        [
            (
                "stem",
                f"CASE WHEN length({word}) <= 2 OR {_has(word, '[^a-z]')} THEN {word} " + " ".join(f"WHEN {word} = '{k}' THEN '{v}'" for k, v in SPECIAL.items())
                + f" WHEN a IN ({', '.join(repr(x) for x in STAY_AFTER_1A)}) THEN a ELSE replace(h, 'Y', 'y') END",
            )
        ],
    ]


def stemmed(vocabulary: DataFrame, word_col: str = "word") -> DataFrame:
    """vocabulary (distinct words, already folded) with a column stem."""
    named = [x for level in steps(word_col, lambda c, pattern, then: f"regexp_replace({c}, '{pattern}', '$1{then}')") for x in level]
    named = [(name, re.sub(r"regexp_extract\((\w+), '\(([^']*)\)', 1\) <> ''", r"\1 rlike '\2'", sql)) for name, sql in named]  # no need of the text that is found
    out = named[-1][1]
    for name, sql in reversed(named[:-1]):  # each step is a lambda variable: as columns, the optimizer would write them into each other
        out = f"aggregate(cast(array() AS array<int>), {sql}, (a, b) -> a, {name} -> {out})"
    word = F.col(word_col)
    return vocabulary.select("*", F.when(word.isNull() | (F.length(word) <= 2) | ~word.rlike("^[a-z]*$"), word).otherwise(F.expr(out)).alias("stem"))


def stem_sql(source: str, word: str = "word") -> str:
    """The same automaton as SQL common table expressions: v_0 holds source's distinct words, the last, ``stems``, word and stem."""
    levels = steps(word, lambda c, pattern, then: f"regexp_replace({c}, '{pattern}', '\\1{then}', 'g')")
    parts = [f"v_0 AS (SELECT DISTINCT {word} FROM {source})"]
    for i, level in enumerate(levels):
        parts.append(f"v_{i + 1} AS (SELECT *, " + ", ".join(f"{sql} AS {name}" for name, sql in level) + f" FROM v_{i})")
    return ",\n".join([*parts, f"stems AS (SELECT {word}, stem FROM v_{len(levels)})"])
