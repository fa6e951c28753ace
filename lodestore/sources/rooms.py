"""Rooms of projects, proposed from the names of their folders and files.

A project is any number of files (project, path from its root, with slashes). Folders of the first level give a room each: the one their name
is known for, or, if it begins with a letter and has more than two, their own name. Folders of the second level give only known rooms.
Of folders that give one room the first by level, then by name, describes it. A project whose folders give none is judged by its
files' names: rooms whose keywords stand in them twice or more, the ``MOST`` commonest. What doesn't fit is general.

Only distinct folders, and counts of rooms, are shuffled, so a project with most of the files is no burden. Defined
results: null and empty paths count as no file; files at the root and in skipped folders give no folder. Repeated paths count each as a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# What folders and files are called, by room; folders that are skipped.
ROOMS = {
    "frontend": "frontend", "front-end": "frontend", "front_end": "frontend", "client": "frontend", "ui": "frontend", "views": "frontend", "components": "frontend", "pages": "frontend",
    "backend": "backend", "back-end": "backend", "back_end": "backend", "server": "backend", "api": "backend", "routes": "backend", "services": "backend", "controllers": "backend", "models": "backend",
    "database": "backend", "db": "backend",
    "docs": "documentation", "doc": "documentation", "documentation": "documentation", "wiki": "documentation", "readme": "documentation", "notes": "documentation",
    "design": "design", "designs": "design", "mockups": "design", "wireframes": "design", "assets": "design", "storyboard": "design",
    "costs": "costs", "cost": "costs", "budget": "costs", "finance": "costs", "financial": "costs", "pricing": "costs", "invoices": "costs", "accounting": "costs",
    "meetings": "meetings", "meeting": "meetings", "calls": "meetings", "meeting_notes": "meetings", "standup": "meetings", "minutes": "meetings",
    "team": "team", "staff": "team", "hr": "team", "hiring": "team", "employees": "team", "people": "team",
    "research": "research", "references": "research", "reading": "research", "papers": "research",
    "planning": "planning", "roadmap": "planning", "strategy": "planning", "specs": "planning", "requirements": "planning",
    "tests": "testing", "test": "testing", "testing": "testing", "qa": "testing",
    "scripts": "scripts", "tools": "scripts", "utils": "scripts",
    "config": "configuration", "configs": "configuration", "settings": "configuration", "infrastructure": "configuration", "infra": "configuration", "deploy": "configuration",
}
SKIPPED = [".git", "node_modules", "__pycache__", ".venv", "venv", "env", "dist", "build", ".next", "coverage"]
GENERAL, MOST, LEAST = "general", 6, 2


def _known(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in ROOMS.items() for x in kv])
    return F.element_at(table, F.replace(F.lower(name), F.lit("-"), F.lit("_")))


def _parts(files: DataFrame) -> DataFrame:
    """project and parts, the folders of each file and its name."""
    parts = F.filter(F.split(F.coalesce("path", F.lit("")), "/"), lambda x: x != "")
    return files.select("project", parts.alias("parts")).where(F.size("parts") > 0)


def from_folders(files: DataFrame) -> DataFrame:
    """project, name, folder: the rooms that folders give."""
    top, second = F.get("parts", F.lit(0)), F.get("parts", F.lit(1))
    depth, skipped = F.size("parts"), lambda c: c.isin(*SKIPPED)
    own = F.when((F.char_length(top) > 2) & F.regexp_like(top, F.lit(r"^\p{L}")), F.replace(F.replace(F.lower(top), F.lit("-"), F.lit("_")), F.lit(" "), F.lit("_")))
    given = lambda level, folder, name, ok: F.when(ok, F.struct(F.lit(level).alias("level"), folder.alias("folder"), name.alias("name")))
    usable = (depth > 1) & ~skipped(top)
    found = F.array(given(1, top, F.coalesce(_known(top), own), usable), given(2, second, _known(second), usable & (depth > 2) & ~skipped(second)))
    rows = _parts(files).select("project", F.explode(found).alias("x")).select("project", "x.*").where("name IS NOT NULL").distinct()
    return rows.groupBy("project", "name").agg(F.min(F.struct("level", "folder")).alias("first")).select("project", "name", F.col("first.folder").alias("folder"))


def from_files(files: DataFrame, most: int = MOST, least: int = LEAST) -> DataFrame:
    """project, name, n: the commonest rooms by keywords in files' names; a file counts for each keyword in its name."""
    rows = _parts(files).where(~F.exists(F.slice("parts", 1, F.size("parts") - 1), lambda x: x.isin(*SKIPPED)))
    name = F.replace(F.replace(F.lower(F.element_at("parts", -1)), F.lit("-"), F.lit("_")), F.lit(" "), F.lit("_"))
    met = F.filter(F.array(*[F.when(F.contains(name, F.lit(k)), F.lit(v)) for k, v in ROOMS.items()]), lambda x: x.isNotNull())
    counts = rows.select("project", F.explode(met).alias("name")).groupBy("project", "name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    place = F.row_number().over(Window.partitionBy("project").orderBy(F.desc("n"), "name"))
    return counts.withColumn("place", place).where(F.col("place") <= most).drop("place")


def detect(files: DataFrame) -> DataFrame:
    """project, name, description, keywords of each room that is proposed."""
    none = F.array().cast("array<string>")
    folders = from_folders(files).select("project", "name", F.concat(F.lit("Files from "), "folder", F.lit("/")).alias("description"), F.array("name", F.lower("folder")).alias("keywords"))
    projects = _parts(files).select("project").distinct()
    bare = projects.join(folders.select(F.col("project").alias("p")).distinct(), F.col("project").eqNullSafe(F.col("p")), "left_anti")
    named = from_files(files).join(bare.select(F.col("project").alias("p")), F.col("project").eqNullSafe(F.col("p")), "left_semi")
    named = named.select("project", "name", F.concat(F.lit("Files related to "), "name").alias("description"), F.array("name").alias("keywords"))
    with_files = named.select(F.col("project").alias("p")).distinct()
    fit = lambda text: (F.lit(GENERAL).alias("name"), F.lit(text).alias("description"), none.alias("keywords"))
    has_general = folders.where(F.col("name") == GENERAL).select(F.col("project").alias("p"))
    rest = folders.select("project").distinct().join(has_general, F.col("project").eqNullSafe(F.col("p")), "left_anti").select("project", *fit("Files that don't fit other rooms"))
    whole = bare.join(with_files, F.col("project").eqNullSafe(F.col("p")), "left_anti").select("project", *fit("All project files"))
    return folders.unionByName(named).unionByName(rest).unionByName(whole)
