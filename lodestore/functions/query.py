"""Finding the question in a query that has other text before it."""

from __future__ import annotations

import re
from dataclasses import dataclass

#: Lengths up to which a query is safe, of the shortest and of the longest result.
SAFE, SHORTEST, LONGEST = 200, 10, 250
_QUOTES = "'\""
_ASKS = re.compile(r"[?？]\s*[\"']?\s*$")
_SENTENCE = re.compile(r"[.!?。！？\n]+")


@dataclass(frozen=True)
class CleanQuery:
    text: str
    method: str
    original_length: int

    @property
    def clean_length(self) -> int:
        return len(self.text)


def _unquoted(s: str) -> str:
    s = s.strip()
    while len(s) > 1 and s[0] in _QUOTES and s[0] == s[-1]:
        s = s[1:-1].strip()
    return s.lstrip(_QUOTES).rstrip(_QUOTES).strip() if s else s


def _short(s: str) -> str:
    s = _unquoted(s)
    if len(s) <= LONGEST:
        return s
    fits = [p for p in map(_unquoted, _SENTENCE.split(s)) if SHORTEST <= len(p) <= LONGEST]
    return fits[-1] if fits else s[-LONGEST:].strip()


def clean_query(raw: str | None) -> CleanQuery:
    """The last question, else the last line of some length, else the end of a query that is long."""
    if not raw or not raw.strip():
        return CleanQuery(raw or "", "passthrough", len(raw or ""))
    s = raw.strip()
    if len(s) <= SAFE:
        return CleanQuery(s, "passthrough", len(s))
    lines = [x.strip() for x in s.split("\n") if x.strip()]
    asked = [x for x in lines if _ASKS.search(x)]
    if asked and len(asked[-1]) >= SHORTEST:
        q = asked[-1]
        return CleanQuery(q if len(q) <= LONGEST else _short(q), "question_extraction", len(s))
    for line in reversed(lines):
        if len(line) >= SHORTEST and len(q := _short(line)) >= SHORTEST:
            return CleanQuery(q, "tail_sentence", len(s))
    return CleanQuery(s[-LONGEST:].strip(), "tail_truncation", len(s))
