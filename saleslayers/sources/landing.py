"""Landing folders: routing of file names, dated paths, the registry of files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslayers.operators.rows import conform_to, dedupe_latest, timestamp
from saleslayers.schemas import FILE_REGISTRY, LANDING_PLANS
from saleslayers.sources.files import CSV_FILES

# The kinds of files, in the order in which their names are looked for.
CATEGORIES = ("sale_orders", "customers", "products", "suppliers", "warehouses")

LANDING = "LANDING"
NEW = "NEW"
PROCESSED = "PROCESSED"
UNMATCHED = "UNMATCHED"


def route(file_name: Column) -> Column:
    """The first category named in a file name, in any case; NULL when there is none."""
    lowered = F.lower(file_name)
    return F.coalesce(*[F.when(lowered.contains(c), c) for c in CATEGORIES])


def landing_folder(category: str | Column) -> Column:
    return F.concat(F.lit(category) if isinstance(category, str) else category, F.lit("_data"))


def landing_path(category: Column, run_ts: datetime, unique: Column | None = None) -> Column:
    """`<category>_data/yyyy/MM/dd/<category>_<yyyyMMdd>_<unique>.csv`, unique by default a UUID."""
    now = timestamp(run_ts)
    name = F.concat_ws(
        "_", category, F.date_format(now, "yyyyMMdd"), F.uuid() if unique is None else unique.cast("string")
    )
    return F.when(
        category.isNotNull(),
        F.concat_ws("/", landing_folder(category), F.date_format(now, "yyyy/MM/dd"), F.concat(name, F.lit(".csv"))),
    )


def list_files(spark: SparkSession, folder: str | list[str], pattern: str = CSV_FILES) -> DataFrame:
    """path, file_key, modified and size of the files below a folder or several; contents are not read.

    file_key is the path as scans report it in `_metadata.file_path`.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", F.col("_metadata.file_path").alias("file_key"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"))
    )


def register(files: DataFrame, run_ts: datetime) -> DataFrame:
    """Registry rows for files that arrived (columns file_key and optionally source_zip, entry, reason and a
    status other than NEW)."""
    status = F.col("status") if "status" in files.columns else F.lit(NEW)
    stamped = files.withColumns({"upload_timestamp": timestamp(run_ts), "status": status})
    return conform_to(stamped, FILE_REGISTRY)


def mark_processed(registry: DataFrame, files: DataFrame, run_ts: datetime) -> DataFrame:
    """Registry rows recording that `files` (column file_key) are done; to be appended."""
    waiting = registry_state(registry).filter(F.col("status") == NEW)
    return waiting.join(files.select("file_key").distinct(), "file_key", "left_semi").withColumns(
        {"status": F.lit(PROCESSED), "processed_at": timestamp(run_ts)}
    )


def registry_state(registry: DataFrame) -> DataFrame:
    """The latest row per file of the append-only registry."""
    return dedupe_latest(registry, ["file_key"], ["processed_at", "upload_timestamp"])


def plan_landings(entries: DataFrame, plans: DataFrame, run_ts: datetime) -> DataFrame:
    """The entries (key, target) whose landing is not planned yet, as rows of the append-only table of plans.

    A plan is written before its copy and binds the entry to its target for good: whoever makes up for an
    interrupted landing, on whatever day, finds the copy under the same name.
    """
    missing = entries.join(plans.select("key"), "key", "left_anti").dropDuplicates(["key"])
    return conform_to(missing.withColumns({"planned_at": timestamp(run_ts), "status": F.lit(LANDING)}), LANDING_PLANS)


def planned_targets(entries: DataFrame, plans: DataFrame) -> DataFrame:
    """The entries with the target of their first plan (of two runs at once, both follow the earlier)."""
    first = plans.groupBy("key").agg(F.min_by("target", F.struct("planned_at", "target")).alias("target"))
    return entries.drop("target").join(first, "key")


def new_files(registry: DataFrame, category: str) -> DataFrame:
    """Files of a category that are registered but not processed."""
    in_folder = F.concat(F.lit("/"), F.col("file_key")).contains(f"/{category}_data/")
    ours = registry.filter(in_folder)
    return (
        ours.filter(F.col("status") == NEW)
        .select("file_key")
        .distinct()
        .join(ours.filter(F.col("status") == PROCESSED).select("file_key"), "file_key", "left_anti")
    )
