"""A temporal knowledge graph on immutable tables: facts with validity intervals, as-of reads, set-based writes.

Dates are ISO text and compare as text; both ends of an interval are inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def slug(name: str | Column) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    return F.replace(F.replace(F.lower(c), F.lit(" "), F.lit("_")), F.lit("'"), F.lit(""))


def predicate_name(name: str | Column) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    return F.replace(F.lower(c), F.lit(" "), F.lit("_"))


def valid_at(t: str | Column) -> Column:
    t = F.lit(t) if isinstance(t, str) else t
    return (F.col("valid_from").isNull() | (F.col("valid_from") <= t)) & (F.col("valid_to").isNull() | (F.col("valid_to") >= t))


def _directed(triples: DataFrame, entities: DataFrame, direction: str) -> DataFrame:
    mine, other = ("subject", "object") if direction == "outgoing" else ("object", "subject")
    e = entities.select(F.col("id").alias(other), F.col("name").alias("other_name"))
    rows = triples.join(e, other)
    return rows.select(F.lit(direction).alias("direction"), F.col(mine).alias("entity"), "predicate", F.col("other_name").alias("other"), "valid_from", "valid_to", F.col("valid_to").isNull().alias("current"))


def query_entity(triples: DataFrame, entities: DataFrame, name: str, as_of: str | None = None, direction: str = "both") -> DataFrame:
    """Facts about an entity, of either direction; a loop stands twice."""
    facts = triples.where(valid_at(as_of)) if as_of else triples
    me = slug(F.lit(name))
    parts = [_directed(facts.where(F.col({"outgoing": "subject", "incoming": "object"}[d]) == me), entities, d) for d in ("outgoing", "incoming") if direction in (d, "both")]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _named(triples: DataFrame, entities: DataFrame) -> DataFrame:
    s = entities.select(F.col("id").alias("subject"), F.col("name").alias("subject_name"))
    o = entities.select(F.col("id").alias("object"), F.col("name").alias("object_name"))
    return triples.join(s, "subject").join(o, "object")


def query_relationship(triples: DataFrame, entities: DataFrame, predicate: str, as_of: str | None = None) -> DataFrame:
    facts = triples.where(F.col("predicate") == predicate_name(F.lit(predicate)))
    return _named(facts.where(valid_at(as_of)) if as_of else facts, entities)


def timeline(triples: DataFrame, entities: DataFrame, name: str | None = None, limit: int = 100, descending: bool = False) -> DataFrame:
    """Facts in order of valid_from, those without one last."""
    facts = triples
    if name:
        me = slug(F.lit(name))
        facts = facts.where((F.col("subject") == me) | (F.col("object") == me))
    by = F.col("valid_from").desc_nulls_last() if descending else F.col("valid_from").asc_nulls_last()
    return _named(facts, entities).orderBy(by, "id").limit(limit)


def list_triples(facts: DataFrame, limit: int = 100) -> DataFrame:
    """The first facts by valid_from, undated ones last."""
    return facts.orderBy(F.col("valid_from").asc_nulls_last(), "id").limit(limit)


def stats(triples: DataFrame, entities: DataFrame) -> DataFrame:
    facts = triples.agg(
        F.count(F.lit(1)).alias("triples"), F.count_if(F.col("valid_to").isNull()).alias("open"),
        F.count_if(F.col("valid_to").isNotNull()).alias("closed"), F.array_join(F.sort_array(F.collect_set("predicate")), ",").alias("predicates"),
    )
    return facts.crossJoin(entities.agg(F.count(F.lit(1)).alias("entities")))  # one row by one row


def triple_id(subject: Column, predicate: Column, object_: Column, valid_from: Column) -> Column:
    key = F.concat_ws("|", subject, predicate, object_, F.coalesce(valid_from, F.lit("")))
    return F.concat_ws("_", F.lit("t"), subject, predicate, object_, F.substring(F.sha2(key.cast("binary"), 256), 1, 12))


def add_triples(triples: DataFrame, entities: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """new (subject, predicate, object as names; valid_from, valid_to) into the graph; unknown entities are created.

    A fact that stands open already isn't added, whatever the new one's dates; of equal open facts in new the
    first by valid_from is, of equal closed ones each span that isn't stored yet.
    """
    n = new.select(F.col("subject").alias("s_name"), F.col("object").alias("o_name"), slug("subject").alias("subject"), predicate_name("predicate").alias("predicate"), slug("object").alias("object"), "valid_from", "valid_to")
    stands = triples.where(F.col("valid_to").isNull()).select("subject", "predicate", "object")
    fresh = n.join(stands, ["subject", "predicate", "object"], "left_anti")
    closed = triples.where(F.col("valid_to").isNotNull()).select(*[F.col(x).alias(f"was_{x}") for x in ("subject", "predicate", "object", "valid_from", "valid_to")])
    fresh = fresh.join(closed, [F.col(x).eqNullSafe(F.col(f"was_{x}")) for x in ("subject", "predicate", "object", "valid_from", "valid_to")], "left_anti")
    span = F.when(F.col("valid_to").isNull(), F.lit("open")).otherwise(F.concat_ws("|", F.coalesce("valid_from", F.lit("")), "valid_to"))
    once = Window.partitionBy("subject", "predicate", "object", "span").orderBy(F.col("valid_from").asc_nulls_first(), "s_name", "o_name")
    fresh = fresh.withColumn("span", span).withColumn("k", F.row_number().over(once)).where(F.col("k") == 1).drop("k", "span")
    rows = fresh.select(triple_id(F.col("subject"), F.col("predicate"), F.col("object"), F.col("valid_from")).alias("id"), "subject", "predicate", "object", "valid_from", "valid_to")
    names = fresh.select(F.col("subject").alias("id"), F.col("s_name").alias("name")).unionByName(fresh.select(F.col("object").alias("id"), F.col("o_name").alias("name")))
    created = names.groupBy("id").agg(F.min("name").alias("name")).withColumn("type", F.lit("unknown")).join(entities, "id", "left_anti")
    return triples.unionByName(rows, allowMissingColumns=True), entities.unionByName(created, allowMissingColumns=True)


def upsert_entities(entities: DataFrame, new: DataFrame) -> DataFrame:
    """new (name, type) replaces entities of the same slug."""
    n = new.withColumn("id", slug("name"))
    return entities.join(n, "id", "left_anti").unionByName(n, allowMissingColumns=True)


def invalidate(triples: DataFrame, subject: str, predicate: str, object_: str, ended: str) -> DataFrame:
    """Closes an open fact; closed ones stay as they are."""
    hit = (F.col("subject") == slug(F.lit(subject))) & (F.col("predicate") == predicate_name(F.lit(predicate))) & (F.col("object") == slug(F.lit(object_))) & F.col("valid_to").isNull()
    return triples.withColumn("valid_to", F.when(hit, F.lit(ended)).otherwise(F.col("valid_to")))


def facts_to_triples(people: DataFrame) -> DataFrame:
    """people (name, relationship, parent, partner, interests array) as triples for add_triples."""
    def part(s: Column, p: Column, o: Column, when: Column) -> DataFrame:
        return people.where(when).select(s.alias("subject"), p.alias("predicate"), o.alias("object"), F.lit(None).cast("string").alias("valid_from"), F.lit(None).cast("string").alias("valid_to"))

    child = part(F.col("name"), F.lit("child_of"), F.col("parent"), F.col("parent").isNotNull())
    married = part(F.col("name"), F.lit("married_to"), F.col("partner"), F.col("partner").isNotNull())
    likes = people.select("name", F.explode("interests").alias("i")).select(F.col("name").alias("subject"), F.lit("loves").alias("predicate"), F.col("i").alias("object"), F.lit(None).cast("string").alias("valid_from"), F.lit(None).cast("string").alias("valid_to"))
    return child.unionByName(married).unionByName(likes)


_IS = r"\b([A-Z][\w-]+)\s+is\s+([A-Z][\w-]+)'s\s+([a-z]{3,20})\b"
_OF = r"\b([A-Z][\w-]+)'s\s+([a-z]{3,20})\s+is\s+([A-Z][\w-]+)\b"


def claims(texts: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Claims of the forms "X is Y's role" and "Y's role is X": id, subject X, predicate role, object Y."""
    def form(pattern: str, x: int, role: int, y: int) -> Column:
        got = [F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(g)) for g in (x, role, y)]
        return F.arrays_zip(got[0].alias("subject"), F.transform(got[1], F.lower).alias("predicate"), got[2].alias("object"))

    both = texts.select(F.col(id_col).alias("id"), F.explode(F.concat(form(_IS, 1, 3, 2), form(_OF, 3, 2, 1))).alias("c"))
    return both.select("id", "c.*")


def check_claims(found: DataFrame, triples: DataFrame, entities: DataFrame, today: str) -> DataFrame:
    """Claims against facts: relationship_mismatch (open fact, other predicate) and stale_fact (equal fact, closed before today)."""
    facts = _named(triples, entities).select(F.col("subject").alias("sid"), F.lower("predicate").alias("fact"), F.lower(F.trim("object_name")).alias("obj"), "valid_to")
    met = found.join(facts, (slug(F.col("subject")) == F.col("sid")) & (F.lower(F.trim(F.col("object"))) == F.col("obj")))
    kind = F.when(F.col("valid_to").isNull() & (F.col("fact") != F.col("predicate")), "relationship_mismatch").when((F.col("valid_to") < today) & (F.col("fact") == F.col("predicate")), "stale_fact")
    return met.withColumn("type", kind).where(F.col("type").isNotNull()).select("id", "type", "subject", "predicate", "object", "fact", "valid_to")


def similar_names(mentioned: DataFrame, registry: DataFrame, most: int = 2) -> DataFrame:
    """Pairs of a mentioned name and a known, unmentioned one at an edit distance of 1 to ``most``.

    A near name shares a piece: a name cut into most + 1 pieces keeps one of them in place but for most
    positions, so pairs meet on pieces by an equi-join rather than each with each.
    """
    def pieces(c: Column, shifts: bool) -> Column:
        n = F.char_length(c)
        cut = lambda i: F.floor(n * i / (most + 1)).cast("int")
        if not shifts:
            return F.array(*[F.struct(F.substring(c, cut(F.lit(i)) + 1, cut(F.lit(i + 1)) - cut(F.lit(i))).alias("text"), n.alias("n"), F.lit(i).alias("i")) for i in range(most + 1)])
        every = F.sequence(n - most, n + most)
        piece = lambda m, i: (lambda a, b: F.transform(F.sequence(F.lit(-most), F.lit(most)), lambda d: F.struct(F.substring(c, a + 1 + d, b - a).alias("text"), m.alias("n"), F.lit(i).alias("i"))))(F.floor(m * i / (most + 1)).cast("int"), F.floor(m * (i + 1) / (most + 1)).cast("int"))
        return F.array_distinct(F.flatten(F.flatten(F.transform(F.filter(every, lambda m: m > 0), lambda m: F.array(*[piece(m, i) for i in range(most + 1)])))))

    a = mentioned.select(F.lower("name").alias("a"), F.col("name").alias("mentioned")).distinct()
    b = registry.select(F.lower("name").alias("b"), F.col("name").alias("known")).distinct().join(a.select(F.col("a").alias("b")), "b", "left_anti")
    left = a.withColumn("k", F.explode(pieces(F.col("a"), False)))
    right = b.withColumn("k", F.explode(pieces(F.col("b"), True)))
    met = left.join(right, "k").select("mentioned", "known", "a", "b").distinct()
    near = met.withColumn("distance", F.levenshtein("a", "b")).where(F.col("distance").between(1, most))
    return near.select("mentioned", "known", "distance")
