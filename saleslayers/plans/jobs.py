"""The loads of all layers over one table root, in their order: raw, dimensions, fact, reports."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from saleslayers.plans import bronze, gold, incremental, silver
from saleslayers.schemas import FILE_REGISTRY, LANDING_PLANS, LOAD_LEDGER, STRING
from saleslayers.session import scratch_path
from saleslayers.sinks.dimensions import compact_history, drop_old_current_rows, read_current, read_history
from saleslayers.sinks.audit import empty_file_audit
from saleslayers.sinks.tables import append, drop_old_versions, read_version, write_version, written
from saleslayers.sources.archives import CSV, LANDED, archive_contents, land_entries, qualified
from saleslayers.sources.landing import NEW, UNMATCHED, landing_path, list_files, mark_processed, plan_landings, planned_targets, register, route
from saleslayers.sources.tables import loads_after, read_table_or_empty
from saleslayers.streaming import loads


#: Versions kept of report tables, and of the current rows of dimensions: readers of the one before the
#: newest are not disturbed.
KEPT_VERSIONS = 2


@dataclass(frozen=True)
class Layout:
    """Where files arrive and where the tables are."""

    landing: str
    root: str

    @property
    def registry(self) -> str:
        return f"{self.root}/registry"

    @property
    def landing_plans(self) -> str:
        return f"{self.root}/landing_plans"

    def arrivals(self, table: str) -> str:
        return f"{self.landing}/{table}_data"

    def raw(self, table: str) -> str:
        return f"{self.root}/raw/{table}"

    def audit(self, table: str) -> str:
        return f"{self.root}/audit/{table}"

    def ledger(self, table: str) -> str:
        return f"{self.root}/ledger/{table}"

    def malformed(self, table: str) -> str:
        return f"{self.root}/malformed/{table}"

    def refined(self, table: str) -> str:
        return f"{self.root}/refined/{table}"

    def rejects(self, table: str) -> str:
        return f"{self.root}/rejects/{table}"

    def report(self, name: str) -> str:
        return f"{self.root}/reports/{name}"

    def changes(self, table: str) -> str:
        return f"{self.root}/changes/{table}"

    def kept_up(self, name: str) -> incremental.Tables:
        """A report that `load_reports` keeps up, with its partial sums."""
        return incremental.Tables(self.report(name), f"{self.root}/partial_sums/{name}", f"{self.root}/refreshes/{name}")

    def checkpoint(self, load: str) -> str:
        return f"{self.root}/checkpoints/{load}"


def land_archives(spark: SparkSession, layout: Layout, archives: str, run_ts: datetime) -> None:
    """Unpacks a drop of ZIP archives into the landing folders and registers every entry.

    Each CSV entry of a known category is copied, as it is, to
    `<category>_data/yyyy/MM/dd/<category>_<yyyyMMdd>_<key>.csv`. The key is a hash of the archive's path,
    time and size and of the entry, so archives of equal names never meet and no landed file is ever
    replaced. The same archive again lands nothing. Other entries are registered with what became of
    them: skipped, unmatched, corrupt, or unreadable for a file that is no archive.

    A run that was interrupted is made up for by the next one, on any day: an entry's target is planned before
    it is copied, so the copies that are there already are found under their names and registered.
    """
    with copied_entries(spark, layout, archives, run_ts) as (listed, outcome):
        known = registry(spark, layout)
        unused = listed.filter("NOT usable").select(
            "source_zip", "entry", F.when(F.col("status") == CSV, UNMATCHED).otherwise(F.upper("status")).alias("status"), F.lit(None).cast("string").alias("reason")
        )
        bad = outcome.filter(F.col("status") != LANDED).select("source_zip", "entry", F.upper("status").alias("status"), "reason")
        others = unused.unionByName(bad).withColumn("file_key", F.concat_ws("#", "source_zip", "entry"))
        rows = others.join(known.select("file_key"), "file_key", "left_anti")
        good = outcome.filter(F.col("status") == LANDED)
        # A folder per category and day, of this run and of interrupted ones.
        folders = [r[0] for r in good.select(F.regexp_extract("target", "^(.*)/[^/]*$", 1)).distinct().collect()]
        if folders:
            # The listing gives the path as scans report it.
            files = list_files(spark, folders)
            in_target = F.element_at(F.split("target", "/"), -1).alias("name")
            found = files.select("file_key", F.element_at(F.split("path", "/"), -1).alias("name"))
            arrived = good.withColumn("name", in_target).join(found, "name").withColumn("status", F.lit(NEW))
            rows = rows.unionByName(arrived.select("file_key", "source_zip", "entry", "status", "reason"))
        if not rows.isEmpty():
            append(register(rows, run_ts), layout.registry)


@contextmanager
def copied_entries(spark: SparkSession, layout: Layout, archives: str, run_ts: datetime) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The first part of landing: plans targets, copies entries. Gives all entries and what became of the copies;
    nothing is registered yet."""
    key = F.md5(F.concat_ws("|", "version", "entry"))
    contents = archive_contents(spark, archives).withColumns({"category": route(F.col("entry")), "key": key})
    usable = (F.col("status") == CSV) & F.col("category").isNotNull()
    target = F.concat(F.lit(qualified(spark, layout.landing).rstrip("/") + "/"), landing_path(F.col("category"), run_ts, F.col("key")))
    landed_keys = registry(spark, layout).select(F.regexp_extract("file_key", "_([0-9a-f]{32})[.]csv$", 1).alias("key"))
    with written(contents.withColumn("usable", usable), scratch_path(spark, "archive-contents")) as listed:
        wanted = listed.filter("usable").join(landed_keys, "key", "left_anti").withColumn("target", target)
        planned = plan_landings(wanted, landing_plans(spark, layout), run_ts)
        if not planned.isEmpty():
            append(planned, layout.landing_plans)
        bound = planned_targets(wanted, landing_plans(spark, layout))
        with written(land_entries(bound), scratch_path(spark, "landed-entries")) as outcome:
            yield listed, outcome


def landing_plans(spark: SparkSession, layout: Layout) -> DataFrame:
    """The append-only table of planned landings; no rows before the first."""
    return read_table_or_empty(spark, layout.landing_plans, LANDING_PLANS)


def registry(spark: SparkSession, layout: Layout) -> DataFrame:
    """The append-only registry of landed files; no rows before the first."""
    return read_table_or_empty(spark, layout.registry, FILE_REGISTRY)


def load_raw(
    spark: SparkSession,
    layout: Layout,
    name: str,
    run_ts: datetime,
    *,
    split_malformed: bool = False,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> None:
    """New files of one kind into their raw table. Files without a data row count as read, too.

    With `split_malformed`, records that do not fit the layout are set apart with their text and file; otherwise
    a value that does not parse is NULL and the row goes on. A large backlog is worked off in batches of so many
    files or bytes (like "64g").
    """
    table = bronze.RAW_TABLES[name]
    with written(list_files(spark, layout.arrivals(name)).select("file_key"), scratch_path(spark, "arrivals")) as arrived:
        # The stream takes at least what has arrived by now.
        loads.ingest_files(
            spark,
            table,
            layout.arrivals(name),
            layout.raw(name),
            layout.checkpoint(f"raw-{name}"),
            audit=layout.audit(name),
            rejects=layout.malformed(name) if split_malformed else None,
            ledger=layout.ledger(name),
            clock=lambda: run_ts,
            max_files=max_files,
            max_bytes=max_bytes,
        )
        read = read_table_or_empty(spark, layout.audit(name), StructType([StructField("file_key", STRING)]))
        empty = arrived.join(read.select("file_key"), "file_key", "left_anti")
        if not empty.isEmpty():
            dated = "createddate" in table.schema.fieldNames()
            append(empty_file_audit(empty, run_ts, dated), f"{layout.audit(name)}/{loads.BATCH}=-1")
        done = mark_processed(registry(spark, layout), arrived, run_ts)
        if not done.isEmpty():
            append(done, layout.registry)


def new_loads(spark: SparkSession, layout: Layout, name: str, watermark: datetime | None) -> DataFrame:
    """Rows of a raw table that were loaded after a consumer's watermark; older loads' folders are not listed."""
    table = bronze.RAW_TABLES[name]
    rows = read_table_or_empty(spark, layout.raw(name), loads.raw_table_schema(table))
    return loads_after(rows, read_table_or_empty(spark, layout.ledger(name), LOAD_LEDGER), watermark)


def load_dimension(spark: SparkSession, layout: Layout, name: str, run_ts: datetime) -> None:
    """New raw rows into one dimension."""
    plan = silver.DIMENSIONS[name]
    loads.upsert_dimension(
        spark,
        plan,
        layout.raw(plan.raw_table),
        layout.refined(name),
        layout.checkpoint(name),
        rejects=layout.rejects(name),
        clock=lambda: run_ts,
    )
    drop_old_current_rows(spark, layout.refined(name), KEPT_VERSIONS)
    compact_history(spark, layout.refined(name), plan.schema, KEPT_VERSIONS)


def load_fact(
    spark: SparkSession, layout: Layout, partition_columns: Sequence[str] = silver.FACT_PARTITIONS
) -> None:
    """New raw order lines into the fact table."""
    loads.upsert_fact(
        spark,
        layout.raw("sale_orders"),
        layout.refined("fact_sale_orders"),
        layout.checkpoint("fact_sale_orders"),
        rejects=layout.rejects("fact_sale_orders"),
        partition_columns=partition_columns,
        changes=layout.changes("fact_sale_orders"),
        ledger=layout.ledger("fact_sale_orders"),
    )


def read_star(spark: SparkSession, layout: Layout) -> gold.Star:
    """The fact table and the current rows of the dimensions."""
    return gold.Star(
        loads.read_fact(spark, layout.refined("fact_sale_orders")),
        *(read_current(spark, layout.refined(name), plan.schema) for name, plan in silver.DIMENSIONS.items()),
    )


def read_dimension(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """A dimension with its history."""
    return read_history(spark, layout.refined(name), silver.DIMENSIONS[name].schema)


def refresh_report_table(spark: SparkSession, root: str, report: gold.Report, star: gold.Star, run_ts: datetime) -> DataFrame:
    """Writes a whole report as its table's next version, frees all but the last KEPT_VERSIONS and returns the new one."""
    table = read_version(spark, root, report.schema)
    write_version(gold.refresh_report(table, gold.report_rows(report, star, run_ts), report), root)
    drop_old_versions(spark, root, KEPT_VERSIONS)
    return read_version(spark, root, report.schema)


def load_reports(
    spark: SparkSession, layout: Layout, run_ts: datetime, fact_partitions: Sequence[str] = silver.FACT_PARTITIONS
) -> None:
    """The groups of all reports that loads since the last call touched."""
    star = read_star(spark, layout)
    for report in gold.REPORTS.values():
        incremental.refresh(star, report, layout.kept_up(report.name), layout.changes("fact_sale_orders"), run_ts, fact_partitions)


def read_report(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """A report as `load_reports` left it."""
    return incremental.read_report(spark, gold.REPORTS[name], layout.kept_up(name))


def load_all(
    spark: SparkSession,
    layout: Layout,
    run_ts: datetime,
    fact_partitions: Sequence[str] = silver.FACT_PARTITIONS,
) -> None:
    """Everything that has arrived, through all layers. Running it again changes nothing."""
    for name in bronze.RAW_TABLES:
        load_raw(spark, layout, name, run_ts)
    for name in silver.DIMENSIONS:
        load_dimension(spark, layout, name, run_ts)
    load_fact(spark, layout, fact_partitions)
    load_reports(spark, layout, run_ts, fact_partitions)
