"""WARC archives: writing with revisit records, and split reading by boundary-chain verification.
A record is a row of Spark's text writer whose line separator is the record's end, so files
are written by Spark to any store it knows, and read back in byte ranges. The magic of a record is
the reader's line separator: every task emits, for its range, the places of the magic and, by the
header after it, where that record's successor would start. Inside a range the candidates'
chains are contracted; pointer jumping from the start of each file over the ranges' entries
then finds those that are reachable, and only they are records. A magic inside a payload is not
reachable and its bytes go back to the record around it.

Defined results: null payload counts as empty. Equal payloads of at least ``min_bytes`` have one
response, at the largest id, and revisits of it; smaller ones are all responses. Null ids are
written as empty and read as null; rows with one id are separate records. Equal payloads that all have a
null id are all responses, as none can be referred to. Line ends within a URL, which would end its header
field, are left out. Text after the last reachable record is ignored; a file that doesn't start with a
record has none. Texts are read a second time for what records in several pieces consist of, and pieces are met by the SHA-1 of what they
hold, so it doesn't matter how files are cut into ranges then; a piece that isn't met is an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestore.llm.common import stored, text_or_empty

MAGIC, END = "WARC/1.0\r\n", "\r\n\r\n"
#: Payloads below this many bytes are never revisits.
MIN_BYTES = 1000
#: Ways into which the pages of one digest are dealt, against hot payloads.
SALTS = 16
#: Rows up to which a table of copied payloads, or of pieces to look for, is broadcast; a row has a digest of 40 bytes and an id at most.
BROADCAST_ROWS = 50_000


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def with_revisits(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """id, url, payload (binary), digest, n, refers_to (null for responses).

    Only groups with copies meet their pages; few of them are broadcast, more are salted.
    """
    rows = pages.select(
        F.col(id_col).alias("id"), F.regexp_replace(text_or_empty(url_col), r"[\r\n]", "").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumns({"digest": F.sha1("payload"), "n": F.octet_length("payload").cast("long")})
    groups = rows.where(F.col("n") >= min_bytes).groupBy("digest").agg(F.max("id").alias("response"), F.count(F.lit(1)).alias("copies"))
    groups = stored(groups.where(F.col("copies") > 1).select("digest", "response"), "copied")
    if groups.count() <= BROADCAST_ROWS:
        met = rows.join(F.broadcast(groups), "digest", "left")
    else:
        dealt = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(dealt, ["digest", "salt"], "left").drop("salt")
    other = F.col("response").isNotNull() & ~F.col("id").eqNullSafe(F.col("response"))
    return met.withColumn("refers_to", F.when(other, F.col("response"))).drop("response")


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = MIN_BYTES, date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes the archive. A revisit has no payload; its length is kept in a field of our own."""
    rows = with_revisits(pages, id_col, url_col, payload_col, min_bytes)
    revisit = F.col("refers_to").isNotNull()
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    header = F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", urn(F.col("id"))),
        _line("WARC-Date", F.lit(date)),
        F.when(F.col("url") != "", _line("WARC-Target-URI", F.col("url"))).otherwise(F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(
            _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            _line("WARC-Refers-To", urn(F.col("refers_to"))),
            _line("X-Full-Payload-Length", F.col("n").cast("string")),
        )).otherwise(F.lit("")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n").cast("string"))),
        F.lit("\r\n"),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    rows.select(F.concat(header, body).alias("value")).write.option("lineSep", END).text(path)


def _field(head: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(head, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between magics: file, range, row (its order), piece."""
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("piece"),
    )


def _headed(pieces: DataFrame) -> DataFrame:
    """Pieces with head, the header if it ends, and jump: from a piece's start to the start of the piece of its successor."""
    at = F.instr(F.col("piece"), END)
    head = F.when(at > 0, F.substring_index("piece", END, 1))
    size = F.expr("try_cast(`_size` as bigint)")
    out = pieces.withColumn("head", head).withColumn("_size", _field(F.concat(F.lit("\r\n"), F.col("head")), "Content-Length"))
    jump = F.octet_length("head") + len(END) + size + len(END) + len(MAGIC)
    return out.withColumns({"bytes": F.octet_length("piece").cast("long"), "size": size, "jump": F.when(size >= 0, jump)}).drop("_size")


_LINK = "file string, range long, start long, exit long"
_MARK = "file string, range long, row long, start long, record long, last long"


def _contract(table: pd.DataFrame) -> pd.DataFrame:
    """For each candidate of a range, where its chain leaves the range."""
    t = table.sort_values("row")
    start, jump = t.start.to_numpy(), t.jump.to_numpy()
    exits = np.where(np.isnan(jump.astype(float)), -1, start + np.nan_to_num(jump.astype(float)).astype(np.int64)).astype(np.int64)
    at = np.searchsorted(start, exits)
    inside = (exits >= 0) & (at < len(start))
    inside[inside] = start[at[inside]] == exits[inside]
    for i in range(len(t) - 1, -1, -1):  # successors stand behind, so they are settled
        if inside[i]:
            exits[i] = exits[at[i]]
    return pd.DataFrame({"file": t.file, "range": t.range, "start": start, "exit": exits})


def _walk(table: pd.DataFrame) -> pd.DataFrame:
    """Marks the records of a range from its entry: each piece gets the start of its record, null before the first."""
    t = table.sort_values("row")
    start, jump = t.start.to_numpy(), t.jump.to_numpy().astype(float)
    record = np.full(len(t), -1, np.int64)
    at, entry = 0, t.entry.iloc[0]
    at = np.searchsorted(start, entry) if entry == entry and entry is not None else len(t)
    while at < len(t) and not np.isnan(jump[at]):
        record[at] = start[at]
        to = start[at] + int(jump[at])
        at2 = np.searchsorted(start, to)
        if at2 < len(t) and start[at2] != to:
            break
        at = at2
    record = np.maximum.accumulate(record) if len(t) else record
    last = record[-1]
    return pd.DataFrame({"file": t.file, "range": t.range, "row": t.row, "start": start, "record": record, "last": last})


def _reachable(links: DataFrame) -> DataFrame:
    """Entries (file, start) of ranges that the chain from a file's start passes, by pointer jumping.

    A file of k ranges needs log2(k) + 1 rounds; entries are at most a few to a range.
    """
    first = links.where(F.col("start") == len(MAGIC)).select("file", "start")
    entries = links.select("file", F.col("exit").alias("start")).unionByName(first).distinct()
    jumps = stored(links.join(entries, ["file", "start"], "left_semi").select("file", "start", "exit"), "jumps")
    most = jumps.groupBy("file").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    seen = first
    for _ in range(int(most).bit_length()):
        step = jumps.join(seen, ["file", "start"]).select("file", F.col("exit").alias("start"))
        seen = stored(seen.unionByName(step.where(F.col("start") >= 0)).distinct(), "seen")
        to = jumps.select("file", F.col("start").alias("exit"), F.col("exit").alias("next"))
        jumps = stored(jumps.join(to, ["file", "exit"], "left").select("file", "start", F.coalesce("next", F.lit(-1)).alias("exit")), "jumps")
    return seen


def _payload() -> Column:
    return F.substring(F.col("piece").cast("binary"), (F.octet_length("head") + len(END) + 1).cast("int"), F.col("size").cast("int"))


def _chain(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Each piece with its record, and the pieces' bytes.

    file, range, row, start, record (start of the record it belongs to; -1 if none), key, head,
    size and, of a piece that is a record by its lengths, the digest of its payload.
    """
    pieces = _pieces(spark, path)
    headed = _headed(pieces)
    complete = F.col("jump") == F.col("bytes") + len(MAGIC)
    slim = stored(headed.select("file", "range", "row", "bytes", "jump", "head", "size", F.sha1("piece").alias("key"), F.when(complete, F.sha1(_payload())).alias("digest")), "candidates")
    here = Window.partitionBy("file", "range").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    step = F.col("bytes") + len(MAGIC)
    ranges = slim.groupBy("file", "range").agg(F.sum(step).alias("total"))
    upto = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("base", F.coalesce(F.sum("total").over(upto), F.lit(0))).drop("total")
    placed = slim.select("file", "range", "row", "jump", F.coalesce(F.sum(step).over(here), F.lit(0)).alias("start")).join(ranges, ["file", "range"])
    placed = placed.withColumn("start", F.col("start") + F.col("base")).drop("base")
    placed = stored(placed.withColumn("jump", F.when(F.col("start") > 0, F.col("jump"))), "placed")
    links = stored(placed.where(F.col("jump").isNotNull()).groupBy("file", "range").applyInPandas(_contract, _LINK), "links")
    entry = _reachable(links).join(links.select("file", "range", "start"), ["file", "start"])
    entry = entry.groupBy("file", "range").agg(F.min("start").alias("entry"))
    marked = stored(placed.join(entry, ["file", "range"], "left").groupBy("file", "range").applyInPandas(_walk, _MARK), "marked")
    # pieces before a range's first record belong to the last record of the ranges before
    last = marked.groupBy("file", "range").agg(F.max("last").alias("last"))
    carried = last.withColumn("carried", F.coalesce(F.max("last").over(upto), F.lit(-1))).select("file", "range", "carried")
    found = marked.join(carried, ["file", "range"]).withColumn("record", F.when(F.col("record") >= 0, F.col("record")).otherwise(F.col("carried")))
    found = found.select("file", "range", "row", "start", "record").join(slim.select("file", "range", "row", "key", "head", "size", "digest"), ["file", "range", "row"])
    return found, pieces


def _together(found: DataFrame, pieces: DataFrame) -> DataFrame:
    """file, start, head, payload of the records whose pieces found holds."""
    parts = found.select("file", "record", "start", "key")
    wanted = stored(parts.select("key").distinct(), "wanted")
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    met = pieces.select(F.sha1("piece").alias("key"), "piece").join(wanted, "key", "left_semi").groupBy("key").agg(F.first("piece").alias("piece"))
    whole = parts.join(met, "key", "left").withColumn("piece", F.coalesce("piece", F.raise_error(F.lit("a piece of the archive is not what it was")).cast("string")))
    joined = whole.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("start", "piece"))).alias("ps"))
    text = F.array_join(F.transform("ps", lambda p: p["piece"]), MAGIC)
    rows = _headed(joined.select("file", F.col("record").alias("start"), text.alias("piece")))
    return rows.select("file", "start", "head", _payload().alias("payload"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """The reachable records: file, start, head, payload (binary)."""
    found, pieces = _chain(spark, path)
    return _together(found.where(F.col("record") >= 0), pieces)


def index(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: id, url, record_type, refers_to, payload_bytes, payload_digest. Ids are text.

    Of responses both are taken from the payload read, a revisit's from its header. Only
    records with a magic inside, whose payload is in several pieces, are read again.
    """
    found, pieces = _chain(spark, path)
    found = stored(found.where(F.col("record") >= 0), "found")
    own = F.col("start") == F.col("record")
    out = found.where(own & F.col("digest").isNotNull()).select("head", F.col("size").alias("n"), "digest")
    broken = found.where(own & F.col("digest").isNull()).select("file", "record")
    parts = found.join(broken, ["file", "record"], "left_semi")
    if not parts.isEmpty():
        again = _together(parts, pieces)
        out = out.unionByName(again.select("head", F.octet_length("payload").cast("long").alias("n"), F.sha1("payload").alias("digest")))
    head = F.concat(F.lit("\r\n"), F.col("head"))
    kind = _field(head, "WARC-Type")
    revisit = kind == "revisit"
    urn = lambda name: F.nullif(F.regexp_extract(_field(head, name), r"^<urn:page:(.*)>$", 1), F.lit(""))
    return out.select(
        urn("WARC-Record-ID").alias("id"),
        _field(head, "WARC-Target-URI").alias("url"),
        kind.alias("record_type"),
        F.when(revisit, urn("WARC-Refers-To")).alias("refers_to"),
        F.when(revisit, _field(head, "X-Full-Payload-Length").cast("long")).otherwise(F.col("n")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace(_field(head, "WARC-Payload-Digest"), "^sha1:", "")).otherwise(F.col("digest")).alias("payload_digest"),
    )
