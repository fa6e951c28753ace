"""Incremental ingest of message logs, in batches or as a stream.

A session's cursor is its largest stored timestamp when the run starts. Messages before it
are dropped for good; those at it are looked at again, and ids make that harmless.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_messages(messages: DataFrame, stored: DataFrame) -> DataFrame:
    """Messages (id, session_id, timestamp, ...) not before their session's cursor and not stored yet."""
    cursors = stored.groupBy("session_id").agg(F.max("timestamp").alias("cursor"))
    late = messages.join(cursors, "session_id", "left").where(F.col("cursor").isNull() | (F.col("timestamp") >= F.col("cursor"))).drop("cursor")
    return late.join(stored.select("id"), "id", "left_anti")


def counted(messages: DataFrame, stored: DataFrame) -> DataFrame:
    """Per session how many messages a sweep adds, finds present and skips."""
    cursors = stored.groupBy("session_id").agg(F.max("timestamp").alias("cursor"))
    here = stored.select("id", F.lit(True).alias("there"))
    rows = messages.join(cursors, "session_id", "left").join(here, "id", "left")
    old = F.coalesce(F.col("timestamp") < F.col("cursor"), F.lit(False))
    there = F.coalesce("there", F.lit(False))
    return rows.groupBy("session_id").agg(F.count_if(~old & ~there).alias("added"), F.count_if(~old & there).alias("present"), F.count_if(old).alias("skipped"))


def sweep_stream(source: DataFrame, read_stored: Callable[[], DataFrame], append: Callable[[DataFrame], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """A stream of messages swept batch by batch; replayed batches add nothing, as ids are looked up."""

    def batch(rows: DataFrame, _: int) -> None:
        append(new_messages(rows.dropDuplicates(["id"]), read_stored()))

    writer = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def save_triggers(messages: DataFrame, every: int = 15) -> DataFrame:
    """A stream of messages (session_id, role) to a row per session whenever ``every`` more user messages have come."""

    def count(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, saved = state.get if state.exists else (0, 0)
        n += sum(int((b.role == "user").sum()) for b in batches)
        fire = n - saved >= every
        state.update((n, n if fire else saved))
        if fire:
            yield pd.DataFrame({"session_id": [key[0]], "messages": [n]})

    kind = messages.schema["session_id"].dataType.simpleString()
    return messages.groupBy("session_id").applyInPandasWithState(count, f"session_id {kind}, messages long", "n long, saved long", "append", "NoTimeout")
