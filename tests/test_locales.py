"""Locale patterns: reading, borders, merging, and names against Python's own patterns."""

from __future__ import annotations

import json
import re
from collections import Counter

import pytest

from lodestore.sources import locales

FILES = {
    "en": {"candidate_pattern": "[A-Z][a-z]{1,19}", "multi_word_pattern": r"[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+", "person_verb_patterns": [r"\b{name}\s+said\b", r"\b{name}\s+asked\b"], "direct_address_pattern": r"\bhey\s+{name}\b", "stopwords": ["The", "and"]},
    "pt-br": {"candidate_pattern": "[A-ZÀ-Ú][a-zà-ÿ]{1,19}", "person_verb_patterns": [r"\b{name}\s+disse\b", r"\b{name}\s+said\b"], "stopwords": ["uma", "and"]},
    "hi": {"boundary_chars": "\\w\\u0900-\\u097F", "candidate_pattern": "[\\u0900-\\u097F]{2,20}", "person_verb_patterns": [r"\b{name}\s+कहा\b"]},
    "ja": None,
}


@pytest.fixture(scope="module")
def patterns(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("locales")
    for lang, entity in FILES.items():
        (folder / f"{lang}.json").write_text(json.dumps({"lang": lang, "terms": {"x": "y"}} | ({"entity": entity} if entity else {}), indent=1), encoding="utf-8")
    return locales.read(spark, str(folder)).persist()


def listed(rows, kind):
    return [r.pattern for r in sorted((r for r in rows if r.kind == kind), key=lambda r: r.place)]


def test_languages_are_merged_in_order(patterns):
    rows = locales.merged(patterns, ("PT-BR", "en", "pt-br", "xx")).collect()
    assert listed(rows, "person_verb") == [r"\b{name}\s+disse\b", r"\b{name}\s+said\b", r"\b{name}\s+asked\b"]
    assert listed(rows, "candidate") == [r"\b([A-ZÀ-Ú][a-zà-ÿ]{1,19})\b", r"\b([A-Z][a-z]{1,19})\b"]
    assert listed(rows, "stopword") == ["and", "the", "uma"]
    for unknown in (("xx", "ja"), ()):
        assert listed(locales.merged(patterns, unknown).collect(), "direct_address") == [r"\bhey\s+{name}\b"]
    hindi = locales.merged(patterns, ("hi",)).collect()
    b = locales.border(FILES["hi"]["boundary_chars"])
    assert listed(hindi, "person_verb") == [rf"{b}{{name}}\s+कहा{b}"] and r"\b" not in listed(hindi, "candidate")[0]


TEXTS = [
    ("en", "Anna met Anna Lee and The Anna. Anna Lee said Éanna, Anna Lee; annA"), ("pt-BR", "João viu João e João-João; uma Uma Uma Uma"), ("hi", "अनीता ने कहा। अनीता, अनीता और x अनीताa"), ("ja", "Bob Bob Bob"), (None, "Bob Bob Bob"),
    ("en", None), ("en", ""), ("hi", "Bob Bob Bob"),
]


def test_names_equal_plain_patterns(spark, patterns):
    docs = spark.createDataFrame([(i, lang, text, "x") for i, (lang, text) in enumerate(TEXTS)], "id int, lang string, document string, name string")
    got = sorted((r.id, r.lang, r["name"], r.frequency) for r in locales.names(docs, patterns, least=2).collect())
    expected = []
    for i, (lang, text) in enumerate(TEXTS):
        key = (lang or "en").lower()
        key = key if FILES.get(key) else "en"
        e, counts = FILES[key], Counter()
        b = locales.border(e["boundary_chars"]) if "boundary_chars" in e else r"\b"
        for kind in ("candidate_pattern", "multi_word_pattern"):
            if kind in e:
                counts.update(re.findall(f"{b}({e[kind]}){b}", text or ""))
        stop = {w.lower() for w in e.get("stopwords", [])}
        expected += [(i, key, name, n) for name, n in counts.items() if n >= 2 and not stop & set(name.lower().split())]
    assert got == sorted(expected) and any(lang == "hi" for _, lang, *_ in got)
    assert locales.names(docs, patterns.where("lang = 'hi'"), least=2).select("id").distinct().count() == 1
    assert locales.names(docs.limit(0), patterns).count() == 0 and locales.names(docs, patterns.limit(0)).count() == 0
