"""Chat transcripts: readers of the known forms, merging of runs, rendering as quoted text."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rendered(messages: DataFrame) -> DataFrame:
    """messages (session_id, ts, role, text) as one text each: users' lines quoted, in order."""
    rows = messages.where(F.col("role").isin("user", "assistant"))
    line = F.when(F.col("role") == "user", F.concat(F.lit("> "), "text")).otherwise(F.col("text"))
    per = rows.groupBy("session_id").agg(F.array_sort(F.collect_list(F.struct("ts", line.alias("line")))).alias("ls"))
    return per.select("session_id", F.array_join(F.transform("ls", lambda x: x["line"]), "\n").alias("transcript"))


def merged(messages: DataFrame) -> DataFrame:
    """Runs of one role as one message: session_id, run, role, n, text."""
    order = Window.partitionBy("session_id").orderBy("ts")
    new = F.coalesce(F.lag("role").over(order) != F.col("role"), F.lit(True)).cast("int")
    runs = messages.withColumn("new", new).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    per = runs.groupBy("session_id", "run", "role").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("ts", "text"))).alias("ls"))
    return per.select("session_id", "run", "role", "n", F.array_join(F.transform("ls", lambda x: x["text"]), "\n").alias("text"))


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Line-wise session logs: session_id, uuid, timestamp, role, content of user and assistant lines; broken lines are left out."""
    v = F.try_parse_json(F.col("value"))
    get = lambda p, kind="string": F.try_variant_get(F.col("v"), p, kind)
    rows = spark.read.text(path).select(v.alias("v")).where(F.col("v").isNotNull())
    rows = rows.select(
        get("$.sessionId").alias("session_id"), get("$.uuid").alias("uuid"), get("$.timestamp").alias("timestamp"), get("$.type").alias("role"),
        get("$.message.content").alias("plain"), get("$.message.content", "array<variant>").alias("blocks"),
    )
    return rows.select("session_id", "uuid", "timestamp", "role", flattened(F.col("plain"), F.col("blocks")).alias("content")).where(
        F.col("role").isin("user", "assistant") & F.col("session_id").isNotNull() & F.col("uuid").isNotNull() & F.col("timestamp").isNotNull()
    )


def flattened(plain: Column, blocks: Column) -> Column:
    """Content that is text or a list of typed blocks, as text."""
    kind = lambda b, p: F.try_variant_get(b, p, "string")
    one = lambda b: (
        F.when(kind(b, "$.type") == "text", kind(b, "$.text"))
        .when(kind(b, "$.type") == "tool_use", F.concat(F.lit("[tool_use "), F.coalesce(kind(b, "$.name"), F.lit("")), F.lit("] "), F.coalesce(kind(b, "$.input"), F.lit(""))))
        .when(kind(b, "$.type") == "tool_result", F.concat(F.lit("[tool_result] "), F.coalesce(kind(b, "$.content"), F.lit(""))))
    )
    return F.when(blocks.isNotNull(), F.array_join(F.transform(blocks, one), "\n")).otherwise(plain)


def _text_of(content) -> str:
    if isinstance(content, str):
        return content
    if isinstance(content, dict):
        return content.get("text") or "\n".join(p for p in content.get("parts", []) if isinstance(p, str))
    return "\n".join(x if isinstance(x, str) else x.get("text", "") for x in content or [] if isinstance(x, str | dict)).strip()


def _from_lines(rows: list[dict]) -> list[tuple[str, str]]:
    out = []
    for r in rows:
        if r.get("type") in ("user", "human", "assistant") and isinstance(m := r.get("message"), dict):
            out.append(("assistant" if r["type"] == "assistant" else "user", _text_of(m.get("content"))))
        elif r.get("type") == "event_msg" and isinstance(p := r.get("payload"), dict) and p.get("type") in ("user_message", "agent_message"):
            out.append(("user" if p["type"] == "user_message" else "assistant", p.get("message") or ""))
    return out


def _from_tree(tree: dict) -> list[tuple[str, str]]:
    """A mapping of nodes with parents and children: from the root along first children."""
    at = next((k for k, n in tree.items() if not n.get("parent")), None)
    out, seen = [], set()
    while at is not None and at not in seen:
        seen.add(at)
        if m := tree[at].get("message"):
            role, text = (m.get("author") or {}).get("role"), _text_of(m.get("content"))
            if role in ("user", "assistant") and text:
                out.append((role, text))
        at = next(iter(tree[at].get("children") or []), None)
    return out


def _from_channel(rows: list[dict]) -> list[tuple[str, str]]:
    """Messages of several people: who speaks first is the user, and each new speaker takes the other role of the one before."""
    roles: dict[str, str] = {}
    last, out = "", []
    for r in rows:
        who, text = r.get("user") or r.get("username") or "", (r.get("text") or "").strip()
        if r.get("type") == "message" and who and text:
            last = roles.setdefault(who, "assistant" if last == "user" else "user")
            out.append((last, text))
    return out


def parse_chat(text: str) -> list[tuple[str, str]] | None:
    """Roles and texts of a chat in any known form; None if it is in none (or quoted text already)."""
    if sum(line.startswith(">") for line in text.split("\n")) >= 3:
        return None
    lines = [x for x in text.splitlines() if x.strip()]
    rows = []
    for x in lines:
        try:
            rows.append(json.loads(x))
        except ValueError:
            continue
    if len(got := _from_lines([r for r in rows if isinstance(r, dict)])) >= 2:
        return got
    try:
        data = json.loads(text)
    except ValueError:
        return None
    if isinstance(data, dict) and isinstance(data.get("mapping"), dict):
        return _from_tree(data["mapping"]) or None
    items = data.get("messages") or data.get("chat_messages") or [] if isinstance(data, dict) else data
    if not isinstance(items, list):
        return None
    items = [x for x in items if isinstance(x, dict)]
    if any(x.get("type") == "message" for x in items):
        return _from_channel(items) or None
    who = {"user": "user", "human": "user", "assistant": "assistant", "ai": "assistant"}
    out = [(who[r], _text_of(x.get("content") or x.get("text"))) for x in items if (r := x.get("role") or x.get("sender")) in who]
    return out if len(out) >= 2 else None


def normalised(files: DataFrame, id_col: str = "path", text_col: str = "content") -> DataFrame:
    """files with their chats as quoted text; what is no chat stays as it is. One file is one task's unit."""
    id_type = files.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for t in b[text_col]:
                chat = parse_chat(t or "")
                out.append(t if chat is None else "\n".join((f"> {x}" if r == "user" else x) + ("\n" if r != "user" else "") for r, x in chat))
            yield pd.DataFrame({id_col: b[id_col], text_col: out})

    return files.select(id_col, text_col).mapInPandas(run, f"{id_col} {id_type}, {text_col} string")
