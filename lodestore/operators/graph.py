"""The graph of rooms that wings share, derived by aggregates and bounded joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rooms(chunks: DataFrame) -> DataFrame:
    return chunks.where((F.col("room") != "") & (F.col("room") != "general") & (F.col("wing") != ""))


def nodes(chunks: DataFrame) -> DataFrame:
    """room, its wings and halls in order, count, and its last five dates."""
    g = _rooms(chunks).groupBy("room").agg(
        F.sort_array(F.collect_set("wing")).alias("wings"), F.sort_array(F.collect_set(F.nullif("hall", F.lit("")))).alias("halls"),
        F.count(F.lit(1)).alias("count"), F.sort_array(F.collect_set(F.nullif("date", F.lit("")))).alias("dates"),
    )
    return g.withColumn("dates", F.slice("dates", F.greatest(F.size("dates") - 4, F.lit(1)), 5))


def edges(chunks: DataFrame) -> DataFrame:
    """Pairs of wings that share a room, for each of its halls."""
    rows = _rooms(chunks)
    w = rows.select("room", "wing").distinct()
    pairs = w.withColumnRenamed("wing", "wing_a").join(w.withColumnRenamed("wing", "wing_b"), "room").where(F.col("wing_a") < F.col("wing_b"))
    halls = rows.where(F.coalesce("hall", F.lit("")) != "").select("room", "hall").distinct()
    counts = rows.groupBy("room").agg(F.count(F.lit(1)).alias("count"))
    return pairs.join(halls, "room").join(counts, "room")


def tunnels(chunks: DataFrame, wing_a: str | None = None, wing_b: str | None = None, most: int = 50) -> DataFrame:
    """Rooms in two wings or more."""
    n = nodes(chunks).where(F.size("wings") >= 2)
    for w in (wing_a, wing_b):
        n = n.where(F.array_contains("wings", w)) if w else n
    return n.orderBy(F.desc("count"), "room").limit(most)


def stats(chunks: DataFrame) -> DataFrame:
    n = nodes(chunks).agg(F.count(F.lit(1)).alias("rooms"), F.count_if(F.size("wings") >= 2).alias("tunnel_rooms"))
    return n.crossJoin(edges(chunks).agg(F.count(F.lit(1)).alias("edges")))  # one row by one row


def rooms_per_wing(chunks: DataFrame) -> DataFrame:
    return _rooms(chunks).groupBy("wing").agg(F.count_distinct("room").alias("rooms"))


def traverse(chunks: DataFrame, start: str, max_hops: int = 2, most: int = 50) -> DataFrame:
    """Rooms reached from start over shared wings: room, hop, count, connected_via (wings shared with the first discoverer by name).

    A wing carries its first frontier room by name, so that each hop is one join that gives at most
    the pairs of room and wing: where a room's first discoverer is in a wing, it is first there too. Hops are at most ten.
    """
    rooms = _rooms(chunks)
    w = rooms.select("room", "wing").distinct()
    counts = rooms.groupBy("room").agg(F.count(F.lit(1)).alias("count"))
    frontier = w.where(F.col("room") == start).select("room").distinct()
    seen = frontier.select("room", F.lit(0).alias("hop"), F.array().cast("array<string>").alias("connected_via"))
    for hop in range(1, min(max(1, max_hops), 10) + 1):
        via = frontier.join(w, "room").groupBy("wing").agg(F.min("room").alias("source"))
        met = via.join(w, "wing").join(seen.select("room"), "room", "left_anti")
        found = met.groupBy("room", "source").agg(F.sort_array(F.collect_set("wing")).alias("shared"))
        found = found.groupBy("room").agg(F.min_by("shared", "source").alias("connected_via")).select("room", F.lit(hop).alias("hop"), "connected_via")
        seen = seen.unionByName(found)
        frontier = found.select("room")
    return seen.join(counts, "room").orderBy("hop", F.desc("count"), "room").limit(most)


def fuzzy_rooms(chunks: DataFrame, query: str, most: int = 5) -> DataFrame:
    """Rooms like a name: containing it, or one of its parts between hyphens."""
    q = query.lower()
    parts = [F.contains("room", F.lit(p)) for p in q.split("-") if p]
    some = parts[0] if parts else F.lit(False)
    for p in parts[1:]:
        some = some | p
    score = F.when(F.contains("room", F.lit(q)), 1.0).when(some, 0.5)
    rooms = _rooms(chunks).select("room").distinct()
    return rooms.withColumn("score", score).where(F.col("score").isNotNull()).orderBy(F.desc("score"), "room").limit(most)


def _end(c: Column) -> Column:
    return F.concat_ws("/", c["wing"], c["room"])


def link_id(source: Column, target: Column) -> Column:
    """The same for both directions."""
    a, b = _end(source), _end(target)
    return F.substring(F.sha2(F.concat_ws("↔", F.least(a, b), F.greatest(a, b)).cast("binary"), 256), 1, 16)


def upsert_links(links: DataFrame, new: DataFrame, now: str) -> DataFrame:
    """new (source, target, label) by link_id; what stands keeps its created_at."""
    n = new.withColumn("id", link_id(F.col("source"), F.col("target")))
    old = links.select("id", F.col("created_at").alias("was"))
    n = n.join(old, "id", "left").select("id", "source", "target", "label", F.coalesce("was", F.lit(now)).alias("created_at"), F.lit(now).alias("updated_at"))
    return links.join(n, "id", "left_anti").unionByName(n)


def delete_links(links: DataFrame, ids: DataFrame) -> DataFrame:
    """links without those that ids (id) names; unknown ids change nothing."""
    return links.join(ids.select("id").distinct(), "id", "left_anti")


def list_links(links: DataFrame, wing: str | None = None) -> DataFrame:
    return links.where((F.col("source.wing") == wing) | (F.col("target.wing") == wing)) if wing else links


def follow(links: DataFrame, chunks: DataFrame, wing: str, room: str) -> DataFrame:
    """The other ends of a place's links with a preview of their chunk; a link out of the place comes before one in."""
    here = lambda end: (F.col(f"{end}.wing") == wing) & (F.col(f"{end}.room") == room)
    out = links.where(here("source")).select("id", "label", F.lit("outgoing").alias("direction"), "target.*")
    in_ = links.where(here("target") & ~here("source")).select("id", "label", F.lit("incoming").alias("direction"), "source.*")
    text = chunks.select(F.col("id").alias("drawer_id"), F.substring("document", 1, 300).alias("preview"))
    return out.unionByName(in_).join(text, "drawer_id", "left")
