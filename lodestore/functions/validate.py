"""Checks of names, facts' values and contents, as columns: the reason why a value isn't accepted, or null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestore.functions.text import strip

# Lengths, and the characters of a name.
NAME_CHARS, CONTENT_CHARS = 128, 100_000
NAME = r"(?U)^(?:[^\W_]|[^\W_][\w .'-]{0,126}[^\W_])$"


def _common(value: Column, most: int) -> Column:
    return F.when(value.isNull() | (strip(value) == ""), "empty").when(F.char_length(strip(value)) > most, "too long")


def name_fault(value: Column) -> Column:
    """For names of wings, rooms and predicates, which may become paths."""
    v = strip(value)
    path = F.contains(v, F.lit("..")) | F.contains(v, F.lit("/")) | F.contains(v, F.lit("\\"))
    return _common(value, NAME_CHARS).when(path, "path").when(F.contains(v, F.lit("\0")), "null byte").when(~F.regexp_like(v, F.lit(NAME)), "characters")


def fact_fault(value: Column) -> Column:
    """For subjects and objects of facts."""
    return _common(value, NAME_CHARS).when(F.contains(value, F.lit("\0")), "null byte")


def content_fault(value: Column) -> Column:
    """For documents; their length counts with the white space around them."""
    empty = value.isNull() | (strip(value) == "")
    return F.when(empty, "empty").when(F.char_length(value) > CONTENT_CHARS, "too long").when(F.contains(value, F.lit("\0")), "null byte")
