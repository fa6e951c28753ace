"""Files of projects and conversations, diaries, SQLite stores and adapters as DataFrames."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# What is read, and what is passed over.
READABLE = tuple(".txt .md .py .js .ts .jsx .tsx .json .jsonl .yaml .yml .html .css .java .go .rs .rb .sh .csv .sql .toml".split())
CONVERSATIONS = (".txt", ".md", ".json", ".jsonl")
SKIP_FILES = (".gitignore", "package-lock.json")
SKIP_DIRS = tuple(
    ".git node_modules __pycache__ .venv venv env dist build .next coverage .ruff_cache .mypy_cache .pytest_cache .cache .tox .nox .idea .vscode .ipynb_checkpoints .eggs htmlcov target".split()
)
MAX_BYTES = 500 << 20


class IgnoreRules:
    """Ignore files of a tree: of all rules of the folders above a path, the last that fits decides."""

    def __init__(self, files: Iterable[tuple[str, str]]):
        """files: (folder relative to the root, content of its ignore file)."""
        self.rules: list[tuple[str, re.Pattern, bool, bool]] = []
        for folder, content in sorted(files, key=lambda x: x[0].count("/") if x[0] else -1):
            for line in content.splitlines():
                line = line.rstrip()
                if line and not line.startswith("#"):
                    self.rules.append((folder, *self._rule(line)))

    @staticmethod
    def _rule(line: str) -> tuple[re.Pattern, bool, bool]:
        keep = line.startswith("!")
        line = line[1:] if keep else line.removeprefix("\\")
        only_dir, body = line.endswith("/"), line.strip("/")
        parts = []
        for p in body.split("/"):
            parts.append(".*" if p == "**" else fnmatch.translate(p).removeprefix("(?s:").removesuffix(")\\Z").removesuffix(")\\z").replace(".*", "[^/]*"))
        text = "/".join(parts).replace(".*/", "(?:.*/)?")
        anchored = "/" in line.rstrip("/")
        return re.compile(("" if anchored else "(?:.*/)?") + text + r"\Z"), only_dir, keep

    def ignored(self, path: str, is_dir: bool = False) -> bool:
        """A path is ignored if it, or a folder above it, is."""
        parts = path.split("/")
        return any(self._one("/".join(parts[:i]), is_dir or i < len(parts)) for i in range(1, len(parts) + 1))

    def _one(self, path: str, is_dir: bool) -> bool:
        out = False
        for folder, rx, only_dir, keep in self.rules:
            rel = path if not folder else (path[len(folder) + 1 :] if path.startswith(folder + "/") else None)
            if rel and (is_dir or not only_dir) and rx.match(rel):
                out = not keep
        return out


def _listed(spark: SparkSession, root: str, extensions: Sequence[str]) -> DataFrame:
    glob = "*{" + ",".join(extensions) + "}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return files.where(F.col("length") <= MAX_BYTES)


def scan_project(spark: SparkSession, root: str, ignore: IgnoreRules | None = None, include: Sequence[str] = ()) -> DataFrame:
    """path (below root), modified, content of a project's readable files. Rules of ignore don't hold for what include names."""
    base = re.escape(root.rstrip("/").split("://")[-1].replace("file:", ""))
    files = _listed(spark, root, READABLE).withColumn("path", F.regexp_replace("path", rf"^.*?{base}/", ""))
    parts = F.split("path", "/")
    files = files.where(~F.exists(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p.isin(*SKIP_DIRS)) & ~F.element_at(parts, -1).isin(*SKIP_FILES))
    if ignore is not None and ignore.rules:
        hidden = F.udf(lambda p: ignore.ignored(p), "boolean")  # rules are a loop over patterns; paths are short
        forced = F.lit(False)
        for i in include:
            forced = forced | (F.col("path") == i) | F.startswith("path", F.lit(i.rstrip("/") + "/"))
        files = files.where(forced | ~hidden("path"))
    return files.select("path", F.unix_timestamp("modificationTime").cast("double").alias("source_mtime"), F.decode("content", "UTF-8").alias("content"))


def scan_conversations(spark: SparkSession, root: str) -> DataFrame:
    files = _listed(spark, root, CONVERSATIONS).where(~F.endswith("path", F.lit(".meta.json")))
    return files.select("path", F.decode("content", "UTF-8").alias("content"))


def detection_sample(files: DataFrame, most: int = 10, chars: int = 5000) -> DataFrame:
    """The start of at most ten files, prose only where there are three of it."""
    prose = F.regexp_like("path", F.lit(r"\.(txt|md)$"))
    many = files.agg(F.count_if(prose)).first()[0] >= 3
    return (files.where(prose) if many else files).orderBy("path").limit(most).select("path", F.substring("content", 1, chars).alias("content"))


def diary_days(spark: SparkSession, root: str, least: int = 50) -> DataFrame:
    """day, text, size of diary files named by their day."""
    files = spark.read.text(root, wholetext=True).select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))
    day = F.regexp_extract("name", r"^(\d{4}-\d{2}-\d{2}).*\.md$", 1)
    return files.select(day.alias("day"), "text", F.char_length("text").alias("size")).where((F.col("day") != "") & (F.col("size") >= least))


def changed_days(days: DataFrame, state: DataFrame) -> DataFrame:
    """Days that state (day, size, entries) hasn't as they are, with the number of entries seen."""
    met = days.join(state.select("day", F.col("size").alias("old"), "entries"), "day", "left")
    return met.where(F.col("old").isNull() | (F.col("old") != F.col("size"))).select("day", "text", "size", F.coalesce("entries", F.lit(0)).alias("seen"))


class _SqlitePartition(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class _SqliteReader(DataSourceReader):
    """Rows of a key-value metadata table by ranges of its row id; the file must be on every executor."""

    def __init__(self, options):
        self.path, self.table, self.step = options["path"], options.get("dbtable", "embedding_metadata"), int(options.get("step", 50_000))
        if not re.fullmatch(r"\w+", self.table):
            raise ValueError(f"no name of a table: {self.table}")

    def partitions(self):
        import sqlite3

        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as con:
            top = con.execute(f"SELECT max(rowid) FROM {self.table}").fetchone()[0] or 0
        return [_SqlitePartition(i, i + self.step) for i in range(0, top + 1, self.step)]

    def read(self, partition):
        import sqlite3

        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as con:
            sql = f"SELECT id, key, string_value, int_value, float_value, bool_value FROM {self.table} WHERE rowid >= ? AND rowid < ?"
            for i, k, s, n, f, b in con.execute(sql, (partition.low, partition.high)):
                yield str(i), k, s, n, f, None if b is None else bool(b)


class SqliteMetadata(DataSource):
    """``spark.read.format("sqlite_metadata").load(path)``: id, key and typed values, for eav_pivot."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_metadata"

    def schema(self) -> str:
        return "id string, key string, string_value string, int_value long, float_value double, bool_value boolean"

    def reader(self, schema):
        return _SqliteReader(self.options)


class Adapter(DataSource):
    """A source plug-in: subclasses give name(), items() and, for one item, its records (document, source_file, chunk_index).

    Items are the partitions, so sources are read in parallel.
    """

    def items(self) -> list[str]:
        raise NotImplementedError

    def records(self, item: str) -> Iterator[tuple[str, str, int]]:
        raise NotImplementedError

    def schema(self) -> str:
        return "document string, source_file string, chunk_index int"

    def reader(self, schema):
        return _AdapterReader(self.items, self.records)


class _Item(InputPartition):
    def __init__(self, name: str):
        self.name = name


class _AdapterReader(DataSourceReader):
    def __init__(self, items: Callable[[], list[str]], records: Callable[[str], Iterator[tuple]]):
        self.items, self.records = items, records

    def partitions(self):
        return [_Item(x) for x in self.items()]

    def read(self, partition):
        yield from self.records(partition.name)
