"""Hybrid retrieval: rank fusion, index boosts, hydration, expansion and re-weighting rules."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestore.operators import bm25

#: The boost of the first index hits by rank, and the distance up to which they boost.
BOOSTS, BOOST_DISTANCE = (0.40, 0.25, 0.15, 0.08, 0.04), 1.5
VECTOR_WEIGHT, TEXT_WEIGHT = 0.6, 0.4
MAX_HYDRATED = 10_000


def fused(hits: DataFrame, vector_weight: float = VECTOR_WEIGHT, text_weight: float = TEXT_WEIGHT) -> DataFrame:
    """hits (query_id, query, id, document, distance, ...) with bm25, fused and rank: by fused score, then distance and id."""
    scored = bm25.candidate_scores(hits)
    most = F.max("bm25").over(Window.partitionBy("query_id"))
    text = F.when(most > 0, F.col("bm25") / most).otherwise(F.lit(0.0))
    scored = scored.withColumn("fused", vector_weight * F.greatest(F.lit(0.0), 1 - F.col("distance")) + text_weight * text)
    order = Window.partitionBy("query_id").orderBy(F.round("fused", 6).desc(), F.round("distance", 6), "id")
    return scored.withColumn("rank", F.row_number().over(order))


def index_boost(hits: DataFrame, index_hits: DataFrame, k: int) -> DataFrame:
    """Boosts hits (query_id, id, source_file, distance) whose source has an index hit (query_id, source_file, distance).

    The rank of an index hit counts all of the query's, and a source has the rank of its best; only those
    near enough and among the first ranks boost. Adds boost, effective; keeps the best k by effective.
    """
    place = Window.partitionBy("query_id").orderBy(F.round("distance", 9), "source_file")
    best = index_hits.withColumn("place", F.row_number().over(place))
    best = best.groupBy("query_id", "source_file").agg(F.min_by(F.struct("place", "distance"), "place").alias("b"))
    table = F.array(*[F.lit(x) for x in BOOSTS])
    boost = F.when(F.col("b.distance") <= BOOST_DISTANCE, F.get(table, F.col("b.place") - 1))
    best = best.select("query_id", "source_file", F.coalesce(boost, F.lit(0.0)).alias("boost"))
    out = hits.join(best, ["query_id", "source_file"], "left").withColumn("boost", F.coalesce("boost", F.lit(0.0)))
    out = out.withColumn("effective", F.col("distance") - F.col("boost"))
    order = Window.partitionBy("query_id").orderBy(F.round("effective", 9), "id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def term_hits(terms: Column, document: Column) -> Column:
    """How many of the terms occur in the document as substrings, whatever the case."""
    return F.size(F.filter(terms, lambda t: F.contains(F.lower(document), t)))


def hydrate(hits: DataFrame, chunks: DataFrame, radius: int = 1) -> DataFrame:
    """For each hit (query_id, query, source_file) the source's chunk with most query terms and its neighbours, joined.

    chunks: source_file, chunk_index, document. The first of equal chunks wins. Adds best_index, total, text.
    """
    asked = hits.select("query_id", "source_file", F.array_distinct(bm25.tokens("query")).alias("terms")).distinct()
    source = Window.partitionBy("source_file")
    placed = chunks.select("source_file", "document", F.row_number().over(source.orderBy("chunk_index")).alias("pos"), F.count(F.lit(1)).over(source).alias("total"))
    # what is compared goes without the documents that are returned
    met = placed.select("source_file", "pos", "total", F.lower("document").alias("low")).join(asked, "source_file")
    found = F.size(F.filter("terms", lambda t: F.contains("low", t)))
    best = met.groupBy("query_id", "source_file").agg(F.max_by("pos", F.struct(found.alias("found"), (-F.col("pos")).alias("pos"))).alias("best"), F.first("total").alias("total"))
    near = best.withColumn("pos", F.explode(F.sequence(F.col("best") - radius, F.col("best") + radius))).join(placed.select("source_file", "pos", "document"), ["source_file", "pos"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "document"))), lambda x: x["document"]), "\n\n")
    out = near.groupBy("query_id", "source_file", "best", "total").agg(text.alias("text"))
    return out.select("query_id", "source_file", (F.col("best") - 1).alias("best_index"), "total", F.substring("text", 1, MAX_HYDRATED).alias("text"))


def neighbours(hits: DataFrame, chunks: DataFrame, radius: int = 1) -> DataFrame:
    """For each hit (source_file, chunk_index) the chunks within the radius, joined, and the source's count."""
    total = chunks.groupBy("source_file").agg(F.count(F.lit(1)).alias("total"))
    around = hits.select("source_file", F.col("chunk_index").alias("hit_index")).withColumn("chunk_index", F.explode(F.sequence(F.col("hit_index") - radius, F.col("hit_index") + radius)))
    got = around.join(chunks.select("source_file", "chunk_index", "document"), ["source_file", "chunk_index"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "document"))), lambda x: x["document"]), "\n\n")
    return got.groupBy("source_file", "hit_index").agg(text.alias("text")).join(total, "source_file")


def pointers(line: str | Column) -> Column:
    """Chunk ids that an index line's arrows point to, in order, once each."""
    c = F.col(line) if isinstance(line, str) else line
    return F.array_distinct(F.flatten(F.transform(F.regexp_extract_all(c, F.lit(r"→([\w,]+)"), F.lit(1)), lambda x: F.split(x, ","))))


def keywords(query: str | Column, stop: Sequence[str] = ()) -> Column:
    """Distinct words of three and more ASCII letters that are no stop words."""
    c = F.col(query) if isinstance(query, str) else query
    words = F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"[a-z]{3,}"), F.lit(0)))
    return F.array_except(words, F.array(*[F.lit(x) for x in stop])) if stop else words


def keyword_overlap(distance: Column, document: Column, words: Column, weight: float = 0.30) -> Column:
    """The distance, less by the weight's part for the share of words in the document."""
    share = F.when(F.size(words) > 0, term_hits(words, document) / F.size(words)).otherwise(F.lit(0.0))
    return distance * (1 - weight * share)


def temporal_factor(days_off: Column, tolerance: Column | float, most: float = 0.40) -> Column:
    """1 - most within the tolerance, rising to 1 at three times the tolerance."""
    t = F.lit(tolerance) if isinstance(tolerance, int | float) else tolerance
    d = F.abs(days_off)
    return F.when(d <= t, F.lit(1 - most)).when(d <= 3 * t, 1 - most * (1 - (d - t) / (2 * t))).otherwise(F.lit(1.0))


def quoted_factor(query: Column, document: Column, weight: float = 0.60) -> Column:
    """1 less the weight's part for the share of the query's quoted phrases in the document."""
    phrases = F.transform(F.regexp_extract_all(query, F.lit(r"""['"]([^'"]{3,60})['"]"""), F.lit(1)), F.lower)
    return F.when(F.size(phrases) > 0, 1 - weight * term_hits(phrases, document) / F.size(phrases)).otherwise(F.lit(1.0))


# Capitalised words of questions that are no names.
NOT_NAMES = ("What", "When", "Where", "Who", "How", "Which", "Did", "Do", "Was", "Have", "Has", "Had", "Is", "Are", "The", "My", "Our", "Their", "Can", "Could", "Would", "Should", "Will", "Shall", "May", "Might", "I", "It", "Its", "This", "That", "These", "Those")


def name_factor(query: Column, document: Column, weight: float = 0.40, not_names: Sequence[str] = NOT_NAMES) -> Column:
    """1 less the weight's part for the share of the query's names in the document."""
    names = F.array_except(F.array_distinct(F.regexp_extract_all(query, F.lit(r"\b([A-Z][a-z]{2,15})\b"), F.lit(1))), F.array(*[F.lit(x) for x in not_names]))
    return F.when(F.size(names) > 0, 1 - weight * term_hits(F.transform(names, F.lower), document) / F.size(names)).otherwise(F.lit(1.0))


# Phrases of time, in the order in which they are looked for, with days back (0: the number in the phrase, times a factor) and tolerance.
OFFSETS: tuple[tuple[str, int, int, int], ...] = (
    (r"(\d+)\s+days?\s+ago", 0, 1, 2), (r"a\s+couple\s+(?:of\s+)?days?\s+ago", 2, 1, 2), (r"yesterday", 1, 1, 1), (r"a\s+week\s+ago", 7, 1, 3),
    (r"(\d+)\s+weeks?\s+ago", 0, 7, 5), (r"last\s+week", 7, 1, 3), (r"a\s+month\s+ago", 30, 1, 7), (r"(\d+)\s+months?\s+ago", 0, 30, 10),
    (r"last\s+month", 30, 1, 7), (r"last\s+year", 365, 1, 30), (r"a\s+year\s+ago", 365, 1, 30), (r"recently", 14, 1, 14),
)
# How users say what they prefer or are concerned with.
PREFERENCES: tuple[str, ...] = (
    r"i(?:'ve been| have been) having (?:trouble|issues?|problems?) with ([^,\.!?]{5,80})", r"i(?:'ve been| have been) feeling ([^,\.!?]{5,60})",
    r"i(?:'ve been| have been) (?:struggling|dealing) with ([^,\.!?]{5,80})", r"i(?:'ve been| have been) (?:worried|concerned) about ([^,\.!?]{5,80})",
    r"i(?:'m| am) (?:worried|concerned) about ([^,\.!?]{5,80})", r"i prefer ([^,\.!?]{5,60})", r"i usually ([^,\.!?]{5,60})",
    r"i(?:'ve been| have been) (?:trying|attempting) to ([^,\.!?]{5,80})", r"i(?:'ve been| have been) (?:considering|thinking about) ([^,\.!?]{5,80})",
    r"lately[,\s]+(?:i've been|i have been|i'm|i am) ([^,\.!?]{5,80})", r"recently[,\s]+(?:i've been|i have been|i'm|i am) ([^,\.!?]{5,80})",
    r"i(?:'ve been| have been) (?:working on|focused on|interested in) ([^,\.!?]{5,80})", r"i want to ([^,\.!?]{5,60})",
    r"i(?:'m| am) looking (?:to|for) ([^,\.!?]{5,60})", r"i(?:'m| am) thinking (?:about|of) ([^,\.!?]{5,60})", r"i(?:'ve been| have been) (?:noticing|experiencing) ([^,\.!?]{5,80})",
)


def time_offset(question: Column) -> Column:
    """struct(days, tolerance) of the first phrase of OFFSETS in a question, or null; days that an int doesn't hold are null; with temporal_factor this boosts dated documents."""
    q = F.lower(question)
    found = F.when(F.lit(False), F.struct(F.lit(0).alias("days"), F.lit(0).alias("tolerance")))
    for pattern, days, factor, tolerance in OFFSETS:
        back = F.lit(days) if days else F.try_multiply(F.regexp_extract(q, pattern, 1).try_cast("int"), F.lit(factor))
        found = found.when(F.regexp_like(q, F.lit(pattern)), F.struct(back.alias("days"), F.lit(tolerance).alias("tolerance")))
    return found


def preferences(turns: DataFrame, by: str = "session_id", order: str = "ts", role: str = "role", text: str = "text") -> DataFrame:
    """by, mention: what users say they prefer or are concerned with, once each, by the place of its first turn; a document for each session follows by joining them."""
    found = [F.transform(F.regexp_extract_all(F.lower(text), F.lit(p), F.lit(1)), lambda m, i=i: F.struct(F.lit(i).alias("pattern"), m.alias("m"))) for i, p in enumerate(PREFERENCES)]
    rows = turns.where(F.col(role) == "user").select(by, F.col(order).alias("at"), F.posexplode(F.concat(*found)).alias("k", "x"))
    clean = F.regexp_replace(F.trim("x.m"), r"[.,;!? ]+$", "")
    rows = rows.select(by, clean.alias("mention"), F.struct("at", "x.pattern", "k").alias("place")).where(F.char_length("mention").between(5, 80))
    return rows.groupBy(by, "mention").agg(F.min("place").alias("place"))


def predicate_factor(query: Column, document: Column, stop: Sequence[str] = (), not_names: Sequence[str] = (), words: float = 0.50, quoted: float = 0.60, names: float = 0.20) -> Column:
    """Factor of a distance from a query's keywords other than its names, its quoted phrases and its names."""
    said = F.transform(F.array_except(F.regexp_extract_all(query, F.lit(r"\b([A-Z][a-z]{2,15})\b"), F.lit(1)), F.array(*[F.lit(x) for x in not_names]).cast("array<string>")), F.lower)
    about = F.array_except(keywords(query, stop), said)
    return keyword_overlap(F.lit(1.0), document, about, words) * quoted_factor(query, document, quoted) * name_factor(query, document, names, not_names or ("",))


def two_pass(first: DataFrame, second: DataFrame, k: int) -> DataFrame:
    """Hits of a first search in its order, then those of a second that it hasn't; (query_id, id, rank)."""
    both = first.select("query_id", "id", F.lit(0).alias("pass"), "rank").unionByName(second.select("query_id", "id", F.lit(1).alias("pass"), "rank"))
    once = both.groupBy("query_id", "id").agg(F.min(F.struct("pass", "rank")).alias("at"))
    order = Window.partitionBy("query_id").orderBy("at.pass", "at.rank", "id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("at")


def hall_navigated(hits: DataFrame, validated: DataFrame, same_hall: float = 0.75, near_hall: float = 0.90, seen: float = 0.85) -> DataFrame:
    """hits (query_id, id, hall, query_hall, distance) weighted by hall and by membership in validated (query_id, id)."""
    flag = validated.select("query_id", "id").distinct().withColumn("validated", F.lit(True))
    hall = F.when(F.col("hall") == F.col("query_hall"), same_hall).when(F.col("hall") == "general", near_hall).otherwise(1.0)
    out = hits.join(flag, ["query_id", "id"], "left")
    return out.withColumn("distance", F.col("distance") * hall * F.when(F.col("validated"), seen).otherwise(1.0)).drop("validated")


def room_boost(distance: Column, room: Column, query_room: Column, factor: float = 0.8) -> Column:
    return F.when(room == query_room, distance * factor).otherwise(distance)


def room_routed(room_scores: DataFrame, chunks: DataFrame, k: int) -> DataFrame:
    """Chunks of each query's best rooms: max(k, a third) of them. room_scores: query_id, room, score."""
    w = Window.partitionBy("query_id")
    keep = room_scores.withColumns({"place": F.row_number().over(w.orderBy(F.desc("score"), "room")), "n": F.count(F.lit(1)).over(w)})
    keep = keep.where(F.col("place") <= F.greatest(F.lit(k), F.floor(F.col("n") / 3))).select("query_id", "room")
    return chunks.join(keep, "room")


#: Phrases that are looked for in one pass over the texts.
PHRASES = 100_000


def containing(chunks: DataFrame, phrases: DataFrame) -> DataFrame:
    """phrases (query_id, query), a stated set checked for size: query_id, id of the chunks whose document holds the phrase.

    One automaton of all phrases reads each text once; empty phrases and null texts match nothing.
    """
    got = phrases.where(F.col("query") != "").select("query_id", "query").limit(PHRASES + 1).collect()
    if len(got) > PHRASES:
        raise ValueError(f"more than {PHRASES} phrases: look for them in parts")
    by: dict[str, list] = {}
    for x in got:
        by.setdefault(x.query, []).append(x.query_id)
    id_type, q_type = (df.schema[c].dataType.simpleString() for df, c in ((chunks, "id"), (phrases, "query_id")))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = ahocorasick.Automaton()
        for q in by:
            automaton.add_word(q, q)
        automaton.make_automaton()
        for b in batches:
            rows = [(i, d) for d, t in zip(b.id, b.document, strict=True) if t and by for q in {q for _, q in automaton.iter(t)} for i in by[q]]
            yield pd.DataFrame(rows, columns=["query_id", "id"])

    return chunks.select("id", "document").mapInPandas(find, f"query_id {q_type}, id {id_type}")


def best_per_corpus_id(hits: DataFrame) -> DataFrame:
    """One row per query and corpus_id: its nearest."""
    return hits.groupBy("query_id", "corpus_id").agg(F.min("distance").alias("distance"))
