"""What the operators of this subpackage share: shared folders, tables, names."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: White space of the contracts, as a Java and DuckDB class.
SPACE = r"[\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir. Only in one process (tests) may that be unset: a temporary folder then; on a cluster that is an error."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        conf = _local_dir()
    return f"{conf.rstrip('/')}/lodestore-{uuid.uuid4().hex}"


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="lodestore-")


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """df written as a table in the shared folder and read again: its lineage ends there."""
    path = f"{shared_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes the files of tables that stored() gave; nothing still to be computed may read them."""
    for x in tables:
        jvm, conf = x.sparkSession._jvm, x.sparkSession._jsparkSession.sessionState().newHadoopConf()
        path = jvm.org.apache.hadoop.fs.Path(x.stored_path)
        path.getFileSystem(conf).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df has not."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def fold_of(doc_id: str | Column, k: int) -> Column:
    """crc32 of the id as text, modulo k; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit(""))), F.lit(k))


def text_key(text: str | Column) -> Column:
    return F.xxhash64(text_or_empty(text))


def same_long(a: str, b: str) -> Column:
    """Whether two long columns are equal, in a form that Spark doesn't take for a key of a join: rows stay dealt by the other keys."""
    return F.col(a).bitwiseXOR(F.col(b)) == 0


def pick_rows(docs: DataFrame, picked: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs that picked (id, text_key) names, one for each, with all columns. Shuffles each text once."""
    k, h, n, pk, ph = (fresh(docs, x) for x in ("text_key", "id_key", "place", "picked_key", "picked_id"))
    key = lambda c: F.xxhash64(F.col(c).isNull(), F.col(c))
    p = picked.select(F.col("text_key").alias(pk), key("id").alias(ph))
    rows = docs.withColumns({k: text_key(text_col), h: key(id_col)})
    rows = rows.join(p, (F.col(k) == F.col(pk)) & same_long(h, ph), "left_semi")
    one = Window.partitionBy(k, h).orderBy(F.lit(0))
    return rows.withColumn(n, F.row_number().over(one)).where(F.col(n) == 1).select(*docs.columns)
