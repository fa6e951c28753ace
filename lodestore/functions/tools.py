"""One-line forms of tool calls and shortened tool results in transcripts, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestore.functions.text import strip

# Lines kept of a result at either end, matches kept, characters kept of others and of inputs.
ENDS, MATCHES, RESULT_CHARS, INPUT_CHARS = 20, 20, 2048, 200


def _cut(c: Column, most: int) -> Column:
    return F.when(F.char_length(c) > most, F.concat(F.substring(c, 1, most), F.lit("..."))).otherwise(c)


def call(name: Column, input_json: Column) -> Column:
    """A tool call's line, from the tool's name and its input as JSON. An end beyond a long is left out."""
    get = lambda key: F.get_json_object(input_json, f"$.{key}")
    path = F.coalesce(get("file_path"), F.lit("?"))
    offset, limit = get("offset"), get("limit")
    end = F.when(offset.rlike(r"^-?\d+$") & limit.rlike(r"^-?\d+$"), F.concat(F.lit("-"), F.try_add(offset.try_cast("bigint"), limit.try_cast("bigint")).cast("string"))).otherwise(F.concat(F.lit("+"), limit))
    end = F.coalesce(end, F.lit(""))
    span = F.when(offset.isNotNull() & limit.isNotNull(), F.concat(F.lit(":"), offset, end)).otherwise(F.lit(""))
    text = lambda key: F.coalesce(get(key), F.lit(""))
    return (
        F.when(name == "Bash", F.concat(F.lit("[Bash] "), _cut(text("command"), INPUT_CHARS)))
        .when(name == "Read", F.concat(F.lit("[Read "), path, span, F.lit("]")))
        .when(name == "Grep", F.concat(F.lit("[Grep] "), text("pattern"), F.lit(" in "), F.coalesce(F.nullif(get("path"), F.lit("")), get("glob"), F.lit(""))))
        .when(name == "Glob", F.concat(F.lit("[Glob] "), text("pattern")))
        .when(name.isin("Edit", "Write"), F.concat(F.lit("["), name, F.lit(" "), path, F.lit("]")))
        .otherwise(F.concat(F.lit("["), F.coalesce(name, F.lit("Unknown")), F.lit("] "), _cut(F.coalesce(input_json, F.lit("{}")), INPUT_CHARS)))
    )


def result(name: Column, content: Column) -> Column:
    """A tool result's lines, each after an arrow; empty for tools whose result is kept elsewhere."""
    text = strip(F.coalesce(content, F.lit("")))
    lines = F.split(text, "\n")
    n = F.size(lines)
    arrow = lambda xs: F.concat(F.lit("→ "), F.array_join(xs, "\n→ "))
    ends = F.concat(
        arrow(F.slice(lines, 1, ENDS)), F.lit("\n→ ... ["), (n - 2 * ENDS).cast("string"), F.lit(" lines omitted] ...\n"),
        arrow(F.slice(lines, F.greatest(n - ENDS + 1, F.lit(1)), F.lit(ENDS))),
    )
    matches = F.concat(arrow(F.slice(lines, 1, MATCHES)), F.lit("\n→ ... ["), (n - MATCHES).cast("string"), F.lit(" more matches]"))
    other = F.concat(F.lit("→ "), F.substring(text, 1, RESULT_CHARS), F.lit("... [truncated, "), F.char_length(text).cast("string"), F.lit(" chars]"))
    return (
        F.when((text == "") | name.isin("Read", "Edit", "Write"), "")
        .when(name == "Bash", F.when(n <= 2 * ENDS, arrow(lines)).otherwise(ends))
        .when(name.isin("Grep", "Glob"), F.when(n <= MATCHES, arrow(lines)).otherwise(matches))
        .otherwise(F.when(F.char_length(text) > RESULT_CHARS, other).otherwise(F.concat(F.lit("→ "), text)))
    )
