"""Text functions as columns: cleaning, chunking, tagging, routing, extraction."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tags and lines that are no content.
NOISE_TAGS = ("system-reminder", "command-message", "command-name", "task-notification", "user-prompt-submit-hook", "hook_output")
NOISE_LINES = (
    "CURRENT TIME:", "VERIFIED FACTS (do not contradict)", "AGENT SPECIALIZATION:", "Checking verified facts...", "Injecting timestamp...",
    "Starting background pipeline...", "Checking emotional weights...", "Auto-save reminder...", "Checking pipeline...",
)
HOOKS = "Stop|PreCompact|PreToolUse|PostToolUse|UserPromptSubmit|Notification|SessionStart|SessionEnd"

# Keywords of halls and of conversation rooms, in the order that settles ties.
HALLS: dict[str, tuple[str, ...]] = {
    "emotions": ("scared", "afraid", "worried", "happy", "sad", "love", "hate", "feel", "cry", "tears"),
    "consciousness": ("consciousness", "conscious", "aware", "real", "genuine", "soul", "exist", "alive"),
    "memory": ("memory", "remember", "forget", "recall", "archive", "palace", "store"),
    "technical": ("code", "python", "script", "bug", "error", "function", "api", "database", "server"),
    "identity": ("identity", "name", "who am i", "persona", "self"),
    "family": ("family", "kids", "children", "daughter", "son", "parent", "mother", "father"),
    "creative": ("game", "gameplay", "player", "app", "design", "art", "music", "story"),
}
TOPICS: dict[str, tuple[str, ...]] = {
    "technical": ("code", "python", "function", "bug", "error", "api", "database", "server", "deploy", "git", "test", "debug", "refactor"),
    "architecture": ("architecture", "design", "pattern", "structure", "schema", "interface", "module", "component", "service", "layer"),
    "planning": ("plan", "roadmap", "milestone", "deadline", "priority", "sprint", "backlog", "scope", "requirement", "spec"),
    "decisions": ("decided", "chose", "picked", "switched", "migrated", "replaced", "trade-off", "alternative", "option", "approach"),
    "problems": ("problem", "issue", "broken", "failed", "crash", "stuck", "workaround", "fix", "solved", "resolved"),
}
# Capitalised words that are no names.
NOT_NAMES = tuple(
    "The This That These Those When Where What Why Who Which How After Before Then Now Here There And But Or Yet So If Else Yes No Maybe Okay "
    "User Assistant System Tool Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April May June July August "
    "September October November December".split()
)
ACTIONS = "built|fixed|wrote|added|pushed|tested|created|decided|migrated|reviewed|deployed|configured|removed|updated"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: str | Column) -> Column:
    """Without white space, by Unicode, at both ends."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def strip_noise(x: str | Column) -> Column:
    """Without system tags, status lines and collapsed-output marks; whole lines only, prose that names them stays."""
    c = _c(x)
    for tag in NOISE_TAGS:
        c = F.regexp_replace(c, rf"(?m)^(?:> )?<{tag}(?:\s[^>]*)?>(?:(?!\n\s*\n)[\s\S])*?</{tag}>[ \t]*\n?", "")
    lines = "|".join(rf"\Q{p}\E" for p in NOISE_LINES)
    c = F.regexp_replace(c, rf"(?m)^(?:> )?(?:{lines}).*\n?", "")
    c = F.regexp_replace(c, rf"(?m)^(?:> )?Ran \d+ (?:{HOOKS}) hooks?.*\n?", "")
    c = F.regexp_replace(c, r"(?m)^(?:> )?…\s*\+\d+ lines.*\n?", "")
    c = F.regexp_replace(c, r"\s*\[\d+\s+tokens?\]\s*\(ctrl\+o to expand\)", "")
    return strip(F.regexp_replace(c, r"\n{4,}", "\n\n\n"))


def _lines(c: Column, each=lambda x: x, keep=None) -> Column:
    parts = F.transform(F.split(c, "\n"), each)
    return F.array_join(F.filter(parts, keep) if keep else parts, "\n")


#: Transforms that a source may declare by name.
TRANSFORMS = {
    "utf8_replace_invalid": lambda c: c,
    "newline_normalize": lambda c: F.regexp_replace(c, r"\r\n?", "\n"),
    "whitespace_trim": strip,
    "whitespace_collapse_internal": lambda c: F.regexp_replace(c, r"\n{3,}", "\n\n"),
    "line_trim": lambda c: _lines(c, strip),
    "line_join_spaces": lambda c: F.array_join(F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != ""), " "),
    "blank_line_drop": lambda c: _lines(c, keep=lambda x: strip(x) != ""),
}


def transformed(x: str | Column, names: Sequence[str]) -> Column:
    """The named transforms, one after the other; an unknown name raises KeyError."""
    c = _c(x)
    for n in names:
        c = TRANSFORMS[n](c)
    return c


def route(x: str | Column, keywords: Mapping[str, Sequence[str]], window: int = 3000, default: str = "general") -> Column:
    """The topic with most of its keywords in the first characters; the first in order of equal ones."""
    c = F.lower(F.substring(_c(x), 1, window))
    scores = [sum((F.contains(c, F.lit(k)).cast("int") for k in words), F.lit(0)) for words in keywords.values()]
    most = F.greatest(*scores) if len(scores) > 1 else scores[0]
    out = F.when(most == 0, default)
    for topic, s in zip(keywords, scores, strict=True):
        out = out.when(s == most, topic)
    return out.otherwise(default)


def hall(x: str | Column) -> Column:
    return route(x, HALLS)


def convo_room(x: str | Column) -> Column:
    return route(x, TOPICS)


def file_room(path: Column, content: Column, rooms: Mapping[str, Sequence[str]]) -> Column:
    """The room of a file: by a folder of its path, by its name, by most keywords in its start; else general."""
    p = F.lower(path)
    folders = F.slice(F.split(p, "/"), 1, F.greatest(F.size(F.split(p, "/")) - 1, F.lit(0)))
    stem = F.regexp_replace(F.element_at(F.split(p, "/"), -1), r"\.[^.]*$", "")
    text = F.lower(F.substring(content, 1, 2000))
    by_folder = by_name = None
    for room, words in rooms.items():
        names = [n.lower() for n in (room, *words)]
        hit = F.exists(folders, lambda f, names=names: F.greatest(*[(f == n) | F.contains(f, F.lit(n)) | ((f != "") & F.contains(F.lit(n), f)) for n in [*names, names[0]]]))
        by_folder = F.when(hit, room) if by_folder is None else by_folder.when(hit, room)
        low = room.lower()
        same = F.contains(stem, F.lit(low)) | ((stem != "") & F.contains(F.lit(low), stem))
        by_name = F.when(same, room) if by_name is None else by_name.when(same, room)
    scores = [sum((F.size(F.split(text, rf"\Q{w.lower()}\E")) - 1 for w in (room, *words)), F.lit(0)) for room, words in rooms.items()]
    most = F.greatest(*scores, F.lit(0))
    by_text = F.when(most == 0, "general")
    for room, s in zip(rooms, scores, strict=True):
        by_text = by_text.when(s == most, room)
    return F.coalesce(by_folder, by_name, by_text, F.lit("general"))


def fixed_chunks(content: str, size: int = 800, overlap: int = 100, least: int = 50) -> Iterator[str]:
    """Chunks that end, past their middle, at a blank line or else at a line's end; overlapping; short ones dropped."""
    text = content.strip()
    at = 0
    while at < len(text):
        end = min(at + size, len(text))
        if end < len(text):
            for mark in ("\n\n", "\n"):
                if (cut := text.rfind(mark, at, end)) > at + size // 2:
                    end = cut
                    break
        piece = text[at:end].strip()
        if len(piece) >= least:
            yield piece
        at = end - overlap if end < len(text) else end


def chunked(docs: DataFrame, id_col: str = "source_file", text_col: str = "content") -> DataFrame:
    """id_col, chunk_index, content: fixed_chunks of each text. Boundaries depend on those before, so they are cut in Arrow batches."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, k, c) for i, t in zip(b.iloc[:, 0], b.iloc[:, 1], strict=True) for k, c in enumerate(fixed_chunks(t or ""))]
            yield pd.DataFrame(rows, columns=[id_col, "chunk_index", "content"])

    return docs.select(id_col, text_col).mapInPandas(cut, f"{id_col} {id_type}, chunk_index int, content string")


def exchange_chunks(docs: DataFrame, id_col: str = "id", text_col: str = "text", size: int = 800, least: int = 30) -> DataFrame:
    """Chunks of transcripts: a quoted user line with the answer's lines, up to the next quote or rule; long ones split."""
    lines = docs.select(id_col, F.transform(F.split(F.coalesce(_c(text_col), F.lit("")), "\n"), strip).alias("ls"))
    turn = lambda x: F.startswith(x, F.lit(">"))
    rows = lines.where(F.size(F.filter("ls", turn)) >= 3)

    # groups by a fold over the lines: a quote opens one, a rule ends it, other lines go to the open one
    def step(s: Column, x: Column) -> Column:
        opened = F.struct(F.concat(s["done"], F.when(s["now"] != "", F.array(s["now"])).otherwise(F.array().cast("array<string>"))).alias("done"), x.alias("now"))
        ended = F.struct(opened["done"].alias("done"), F.lit("").alias("now"))
        grown = F.struct(s["done"].alias("done"), F.when((s["now"] != "") & (x != ""), F.concat(s["now"], F.when(F.contains(s["now"], F.lit("\n")), F.lit(" ")).otherwise(F.lit("\n")), x)).otherwise(s["now"]).alias("now"))
        return F.when(turn(x), opened).when(F.startswith(x, F.lit("---")), ended).otherwise(grown)

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"))
    groups = F.aggregate("ls", start, step, lambda s: F.concat(s["done"], F.when(s["now"] != "", F.array(s["now"])).otherwise(F.array().cast("array<string>"))))
    pieces = lambda g: F.transform(F.sequence(F.lit(0), F.floor((F.char_length(g) - 1) / size).cast("int")), lambda i: F.substring(g, i * size + 1, F.lit(size)))
    parts = F.filter(F.flatten(F.transform(groups, pieces)), lambda p: F.char_length(strip(p)) > least)
    return rows.select(id_col, F.posexplode(parts).alias("chunk_index", "content"))


def paragraph_chunks(docs: DataFrame, id_col: str = "id", text_col: str = "text", least: int = 30, group: int = 25) -> DataFrame:
    """Chunks by blank lines; a text without any and with over 20 lines in groups of lines."""
    c = F.coalesce(_c(text_col), F.lit(""))
    paras = F.filter(F.transform(F.split(c, "\n\n"), strip), lambda p: p != "")
    lines = F.split(c, "\n")
    grouped = F.transform(F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / group).cast("int")), lambda i: strip(F.array_join(F.slice(lines, i * group + 1, group), "\n")))
    parts = F.when((F.size(paras) <= 1) & (F.size(lines) > 21), grouped).otherwise(paras)
    return docs.select(id_col, F.posexplode(F.filter(parts, lambda p: F.char_length(p) > least)).alias("chunk_index", "content"))


def _bound(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def candidate_names(x: str | Column, window: int = 5000) -> Column:
    """Capitalised words in the first characters, in order, repeated as they are."""
    return F.filter(F.regexp_extract_all(F.substring(_c(x), 1, window), F.lit(r"(?U)\b([A-Z][a-z]{2,19})\b"), F.lit(1)), lambda w: ~w.isin(*NOT_NAMES))


def entity_tags(x: str | Column, known: Sequence[str] = (), most: int = 25) -> Column:
    """Known names in the text, and candidates that stand there twice and more; in order, joined by semicolons."""
    c = _c(x)
    words = candidate_names(c)
    # in order, the second of equal ones
    second = lambda a: F.filter(a, lambda w, i: F.coalesce(F.get(a, i - 1) == w, F.lit(False)) & ~F.coalesce(F.get(a, i - 2) == w, F.lit(False)))
    often = _bound(F.sort_array(words), second)
    found = [F.when(F.regexp_like(c, F.lit(rf"(?U)(?<!\w)\Q{k}\E(?!\w)")), F.lit(k)) for k in known]
    all_ = F.array_union(often, F.filter(F.array(*found), lambda w: w.isNotNull())) if found else often
    return F.array_join(F.slice(F.sort_array(all_), 1, most), ";")


def index_lines(chunks: DataFrame) -> DataFrame:
    """chunks (source_file, content, wing, room, chunk_ids) as lines topic|entities|→ids: topics, headers and quotes, at least one line."""
    c = F.substring("content", 1, 5000)
    words = candidate_names(F.col("content"))
    # by count, then by place of first occurrence: runs of equal names in order of name and place
    placed = F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    starts = lambda a: F.filter(F.transform(a, lambda s, k: F.struct(s["w"].alias("w"), s["i"].alias("i"), k.alias("k"))), lambda s: F.coalesce(F.get(a, s["k"] - 1)["w"] != s["w"], F.lit(True)))
    run = lambda a: lambda b: F.transform(b, lambda s, j: F.struct((s["k"] - F.coalesce(F.get(b, j + 1)["k"], F.size(a))).alias("n"), s["i"].alias("at"), s["w"].alias("w")))
    ranked = F.sort_array(F.filter(_bound(placed, lambda a: _bound(starts(a), run(a))), lambda s: s["n"] <= -2))
    entities = F.array_join(F.transform(F.slice(ranked, 1, 5), lambda s: s["w"]), ";")
    topics = F.concat(F.regexp_extract_all(c, F.lit(rf"(?iU)(?:{ACTIONS})\s+[\w\s]{{3,40}}"), F.lit(0)), F.regexp_extract_all(c, F.lit(r"(?m)^#{1,3}\s+(.{5,60})$"), F.lit(1)))
    topics = F.slice(F.array_distinct(F.transform(topics, lambda t: F.lower(strip(t)))), 1, 12)
    quotes = F.transform(F.slice(F.regexp_extract_all(c, F.lit(r'"([^"]{15,150})"'), F.lit(1)), 1, 3), lambda q: F.concat(F.lit('"'), q, F.lit('"')))
    stem = F.substring(F.regexp_replace(F.element_at(F.split("source_file", "/"), -1), r"(?<=.)\.[^.]*$", ""), 1, 40)
    heads = F.concat(topics, quotes)
    heads = F.when(F.size(heads) > 0, heads).otherwise(F.array(F.concat_ws("/", "wing", "room", stem)))
    refs = F.concat(F.lit("→"), F.array_join(F.slice("chunk_ids", 1, 3), ","))
    line = F.transform(heads, lambda h: F.concat_ws("|", h, entities, refs))
    return chunks.select("source_file", F.posexplode(line).alias("line_no", "line"))


def token_estimate(x: str | Column) -> Column:
    """Tokens of a text, from its words."""
    return F.floor(F.regexp_count(_c(x), F.lit(r"(?U)\S+")) * 1.3).cast("int")


def diary_entries(days: DataFrame, text_col: str = "text") -> DataFrame:
    """Entries of diary files, each from a heading of the second level to the next, with their number."""
    parts = F.filter(F.split(F.concat(F.lit("\n"), _c(text_col)), r"\n(?=## .)"), lambda p: F.startswith(p, F.lit("## ")))
    return days.select(*[c for c in days.columns if c != text_col], F.posexplode(parts).alias("entry", "text"))


def sessions(lines: DataFrame, by: str = "file", order: str = "line_no", text: str = "line") -> DataFrame:
    """lines with session: a running count of session headers in their file."""
    from pyspark.sql.window import Window

    header = F.regexp_like(text, F.lit(r"^\s*(?:Session \d+|=== new session)"))
    w = Window.partitionBy(by).orderBy(order)
    return lines.withColumn("session", F.sum(header.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
