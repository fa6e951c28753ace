"""Mutable collections on immutable files: every write is a new snapshot, and a pointer names the current one.

There is one writer. A snapshot is complete before the pointer moves, so readers see the old
or the new one; pointers are tiny Spark-written tables, the one with the highest number counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lodestore.operators import filters
from lodestore.schema import CHUNKS, DuplicateId, StoreError


def latest(rows: DataFrame, key: str | list[str], version: Column) -> DataFrame:
    """One row per key: that of the highest version."""
    keys = [key] if isinstance(key, str) else key
    k = F.row_number().over(Window.partitionBy(*keys).orderBy(version.desc()))
    return rows.withColumn("_k", k).where(F.col("_k") == 1).drop("_k")


def upserted(base: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """base with new's rows in place of those of the same key; whole rows."""
    return base.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def updated(base: DataFrame, changes: DataFrame, key: str = "id", map_col: str = "extra") -> DataFrame:
    """base with the non-null columns of changes put in; maps are merged, the new value first."""
    c = changes.select(key, F.struct(*[x for x in changes.columns if x != key]).alias("_c"))
    rows = base.join(c, key, "left")
    out = []
    for x in base.columns:
        if x == key or x not in changes.columns:
            out.append(F.col(x))
        elif x == map_col:
            old = F.coalesce(F.map_filter(x, lambda k, _: ~F.coalesce(F.map_contains_key(F.col(f"_c.{x}"), k), F.lit(False))), F.create_map().cast("map<string,string>"))
            out.append(F.when(F.col(f"_c.{x}").isNull(), F.col(x)).otherwise(F.map_concat(old, F.col(f"_c.{x}"))).alias(x))
        else:
            out.append(F.coalesce(F.col(f"_c.{x}"), F.col(x)).alias(x))
    return rows.select(*out)


def deleted(base: DataFrame, ids: list | None = None, where: filters.Where | None = None) -> DataFrame:
    """base without the rows that both ids and filter name; neither given, nothing goes."""
    if not ids and not where:
        return base
    gone = filters.where(where)
    return base.where(~(gone & F.col("id").isin(ids)) if ids else ~gone)


def drawer_id(wing: Column, room: Column, key: Column) -> Column:
    return F.concat_ws("_", F.lit("drawer"), wing, room, F.substring(F.sha2(key.cast("binary"), 256), 1, 24))


def from_file(rows: DataFrame, added_by: str = "miner", version: int = 2) -> DataFrame:
    """rows (wing, room, source_file, chunk_index, document) as chunks with ids by place."""
    key = F.concat("source_file", F.col("chunk_index").cast("string"))
    return rows.withColumns({"id": drawer_id(F.col("wing"), F.col("room"), key), "added_by": F.lit(added_by), "normalize_version": F.lit(version)})


def from_tool(rows: DataFrame, base: DataFrame, added_by: str = "tool") -> DataFrame:
    """rows (wing, room, document) as chunks with ids by content; those in base already are left out, and of equal ones in rows one goes in."""
    n = rows.withColumns({"id": drawer_id(F.col("wing"), F.col("room"), F.concat("wing", "room", "document")), "added_by": F.lit(added_by)})
    return n.join(base.select("id"), "id", "left_anti").dropDuplicates(["id"])


def sentinels(files: DataFrame, chunks: DataFrame, added_by: str = "miner", version: int = 2) -> DataFrame:
    """Marker rows (room _registry) for files (wing, source_file) that gave no chunk, so that they aren't read again."""
    none = files.select("wing", "source_file").distinct().join(chunks.select("source_file").distinct(), "source_file", "left_anti")
    key = F.substring(F.sha2(F.col("source_file").cast("binary"), 256), 1, 24)
    return none.select(F.concat(F.lit("_reg_"), key).alias("id"), "wing", F.lit("_registry").alias("room"), "source_file", F.lit(added_by).alias("added_by"), F.lit("registry").alias("ingest_mode"), F.lit(version).alias("normalize_version"))


def transcript_wing(path: Column) -> Column:
    """The wing of a transcript's project folder."""
    project = F.regexp_extract(F.replace(path, F.lit("\\"), F.lit("/")), r"-Projects-([^/]+?)(?:/|$)", 1)
    return F.when(project != "", F.concat(F.lit("wing_"), F.replace(F.lower(project), F.lit(" "), F.lit("_")))).otherwise("wing_sessions")


def store_name(path: Column) -> Column:
    """A name for the store at an absolute path: its last folder in safe characters and eight digits of the path's hash."""
    base = F.regexp_replace(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"[^A-Za-z0-9_]", "_"), r"^_+|_+$", "")
    return F.concat(F.when(base != "", base).otherwise("palace"), F.lit("_"), F.substring(F.sha2(path.cast("binary"), 256), 1, 8))


def stale_sources(files: DataFrame, chunks: DataFrame, version: int = 2) -> DataFrame:
    """files (source_file, source_mtime) that aren't in the store as they are now, by version and time."""
    m = chunks.where(F.col("normalize_version") >= version).select("source_file", F.col("source_mtime").alias("m")).distinct()
    hit = (files.source_file == m.source_file) & (F.abs(files.source_mtime - m.m) < 0.001)
    return files.join(m, hit, "left_anti")


def replaced_sources(base: DataFrame, new: DataFrame) -> DataFrame:
    """base with all chunks of new's sources replaced by new's."""
    return base.join(new.select("source_file").distinct(), "source_file", "left_anti").unionByName(new, allowMissingColumns=True)


class Collection:
    """A named collection in a folder that Spark can write."""

    def __init__(self, spark: SparkSession, root: str, name: str = "drawers", schema: str = CHUNKS):
        self.spark, self.root, self.schema = spark, f"{root.rstrip('/')}/{name}", T.StructType.fromDDL(schema)

    def _paths(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return jvm, path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int:
        _, path, fs = self._paths()
        names = [x.getPath().getName() for x in fs.listStatus(path)] if fs.exists(path) else []
        done = [int(x[1:]) for x in names if x[:1] == "v" and x[1:].isdigit() and fs.exists(path.suffix(f"/{x}/_SUCCESS"))]
        return max(done, default=0)

    def rows(self) -> DataFrame:
        v = self.version()
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/v{v}") if v else self.spark.createDataFrame([], self.schema)

    def _commit(self, rows: DataFrame) -> None:
        full = rows.select(*[F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema])
        full.write.parquet(f"{self.root}/v{self.version() + 1}")

    def add(self, new: DataFrame) -> None:
        ids = new.select("id")
        if ids.join(self.rows().select("id"), "id", "left_semi").limit(1).count() or ids.groupBy("id").count().where("count > 1").limit(1).count():
            raise DuplicateId("an id is in the collection already")
        self._commit(self.rows().unionByName(new, allowMissingColumns=True))

    def upsert(self, new: DataFrame) -> None:
        self._commit(upserted(self.rows(), new))

    def update(self, changes: DataFrame) -> None:
        self._commit(updated(self.rows(), changes))

    def delete(self, ids: list | None = None, where: filters.Where | None = None) -> None:
        if ids or where:
            self._commit(deleted(self.rows(), ids, where))

    def get(self, **kw) -> DataFrame:
        return filters.get(self.rows(), **kw)

    def count(self) -> int:
        return self.rows().count()

    def vacuum(self, keep: int = 2) -> None:
        """Removes all but the latest snapshots."""
        jvm, path, fs = self._paths()
        if keep < 1:
            raise StoreError("the current snapshot must stay")
        for v in range(1, self.version() - keep + 1):
            fs.delete(path.suffix(f"/v{v}"), True)

    def drop(self) -> None:
        _, path, fs = self._paths()
        fs.delete(path, True)
