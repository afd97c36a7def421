"""File drops to raw tables, raw tables to the fact table, in repeatable micro-batches.

The stream's checkpoint is the record of which files are done. A batch that is repeated
after a failure replaces what it wrote before, so each file counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import nullcontext
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from saleslayers import schemas
from saleslayers.functions.quality import rejected_rows
from saleslayers.operators.history import apply_history
from saleslayers.operators.rows import timestamp
from saleslayers.plans import bronze, silver
from saleslayers.schemas import BIGINT, INT, STRING, TIMESTAMP
from saleslayers.session import scratch_path
from saleslayers.sinks.audit import file_audit
from saleslayers.sinks.dimensions import read_current, write_dimension
from saleslayers.sinks.tables import (
    append_batch,
    finish_replacement,
    partitions_of,
    replace_partitions,
    rows_in_partitions,
    written,
)
from saleslayers.sources.files import CSV_FILES, CSV_OPTIONS
from saleslayers.sources.tables import read_table_or_empty

Clock = Callable[[], datetime]

BATCH = "ingest_batch"
SOURCE_FILE = "source_file"
CORRUPT = "corrupt_record"
_LEDGER_ENTRY = StructType([f for f in schemas.LOAD_LEDGER if f.name != BATCH])
_FACT_ENTRY = StructType([f for f in schemas.FACT_LEDGER if f.name != BATCH])


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def stream_csv(
    spark: SparkSession,
    schema: StructType,
    folder: str,
    *,
    max_files: int | None = None,
    max_bytes: str | None = None,
    corrupt: str | None = None,
    archive: str | None = None,
    pattern: str = CSV_FILES,
) -> DataFrame:
    """New CSV files below a folder, plain or compressed, with the path each row came from. A batch takes so many files or bytes at most;
    `corrupt` names the column of the schema that gets the text of malformed records. With `archive`, files of
    batches that are done move there (outside the folder), so that listings stay short."""
    reader = (
        spark.readStream.schema(schema)
        .options(**CSV_OPTIONS)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
    )
    bounds = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes, "columnNameOfCorruptRecord": corrupt, "sourceArchiveDir": archive, "cleanSource": archive and "archive"}
    for option, value in bounds.items():
        if value:
            reader = reader.option(option, value)
    return reader.csv(folder).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def run_available(rows: DataFrame, each_batch: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Works off what has arrived, then stops."""
    query = (
        rows.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def copy_files(
    spark: SparkSession, schema: StructType, landing: str, root: str, checkpoint: str, *, max_files: int | None = None
) -> StreamingQuery:
    """Rows of every new file, as they are, into a Parquet folder; each file exactly once."""
    query = (
        stream_csv(spark, schema, landing, max_files=max_files)
        .writeStream.format("parquet")
        .option("path", root)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def ingest_files(
    spark: SparkSession,
    table: bronze.RawTable,
    landing: str,
    root: str,
    checkpoint: str,
    *,
    audit: str | None = None,
    rejects: str | None = None,
    ledger: str | None = None,
    clock: Clock = utc_now,
    max_files: int | None = None,
    max_bytes: str | None = None,
    archive: str | None = None,
) -> StreamingQuery:
    """Every new file of a landing folder into the raw table, validated, deduped and stamped.

    The files of a batch are parsed once; records are counted as they are, and the ledger gets the batch's number,
    its time and the counts. With `rejects`, records that do not fit the layout go there, with their text and
    file, instead of being read as rows with missing values. `max_files` and `max_bytes` bound a batch.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        run_ts, read = clock(), Observation()
        malformed = F.col(CORRUPT).isNotNull() if rejects else F.lit(False)
        counted = batch.observe(read, F.count("*").alias("read"), F.count(F.when(malformed, 1)).alias("malformed"))
        with written(counted, scratch_path(spark, "arrived")) as arrived:
            good = arrived.filter(~malformed) if rejects else arrived
            append_batch(bronze.ingest(good.drop(SOURCE_FILE, CORRUPT), table, run_ts), root, batch_id, table.partition_columns, BATCH)
            if rejects:
                bad = arrived.filter(malformed).select(CORRUPT, SOURCE_FILE, timestamp(run_ts).alias(silver.LOAD))
                append_batch(bad, rejects, batch_id, column=BATCH)
            if audit:
                append_batch(file_audit(good, batch_id, run_ts), audit, batch_id, column=BATCH)
        if ledger:
            # From the footers of what was written.
            kept = read_table_or_empty(spark, f"{root}/{BATCH}={batch_id}", table.schema).count()
            entry = [(run_ts, read.get["read"], read.get["malformed"], kept)]
            append_batch(spark.createDataFrame(entry, _LEDGER_ENTRY).coalesce(1), ledger, batch_id, column=BATCH)

    schema = StructType([*table.schema.fields]).add(CORRUPT, STRING) if rejects else table.schema
    stream = stream_csv(spark, schema, landing, max_files=max_files, max_bytes=max_bytes, corrupt=CORRUPT if rejects else None, archive=archive)
    return run_available(stream, load, checkpoint)


def raw_table_schema(table: bronze.RawTable) -> StructType:
    """Columns of a raw table as `ingest_files` writes it."""
    schema = StructType([*table.schema.fields])
    if table.date_column:
        schema = schema.add("year", INT).add("month", INT).add("day", INT)
    return schema.add("ingestion_timestamp", TIMESTAMP).add(BATCH, BIGINT)


def upsert_fact(
    spark: SparkSession,
    raw_root: str,
    fact_root: str,
    checkpoint: str,
    *,
    rejects: str | None = None,
    partition_columns: Sequence[str] = silver.FACT_PARTITIONS,
    changes: str | None = None,
    ledger: str | None = None,
) -> StreamingQuery:
    """Every new raw order line into the fact table; only the touched partitions are rewritten, and recorded
    below `changes`. Valid and rejected lines are counted as they are labelled, for the ledger."""
    raw_table = bronze.RAW_TABLES["sale_orders"]

    def load(batch: DataFrame, batch_id: int) -> None:
        counts, rejected = Observation(), F.count(F.when(F.col("error_flag") == 1, 1))
        labelled = silver.labelled_lines(batch)
        counted = labelled.observe(counts, F.count("*").alias("lines"), rejected.alias("rejected"))
        # Labels are expressions over stored rows: they are computed again for the valid lines, not written in between.
        if rejects:
            append_batch(rejected_rows(counted).drop(silver.LOAD), rejects, batch_id, column=BATCH)
        valid = silver.fact_batch(labelled if rejects else counted)
        write_fact(valid, fact_root, partition_columns, changes=changes, batch_id=batch_id)
        if ledger:
            entry = [(counts.get["lines"] - counts.get["rejected"], counts.get["rejected"])]
            append_batch(spark.createDataFrame(entry, _FACT_ENTRY).coalesce(1), ledger, batch_id, column=BATCH)

    raw = spark.readStream.schema(raw_table_schema(raw_table)).parquet(raw_root)
    return run_available(raw, load, checkpoint)


def upsert_dimension(
    spark: SparkSession,
    plan: silver.DimensionPlan,
    raw_root: str,
    dimension_root: str,
    checkpoint: str,
    *,
    rejects: str | None = None,
    clock: Clock = utc_now,
) -> StreamingQuery:
    """Every new raw row into a history-keeping dimension, written as its next version.

    A batch that is repeated after a failure finds its rows current and changes nothing.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        run_ts = clock()
        if rejects:
            append_batch(silver.dimension_rejects(batch, plan, run_ts), rejects, batch_id, column=BATCH)
        with written(silver.dimension_batch(batch, plan, run_ts), scratch_path(spark, "dimension-batch")) as rows:
            current = read_current(spark, dimension_root, plan.schema)
            # One row per key by construction, so the uniqueness check is left out.
            after = apply_history(current, rows, plan.rule, run_ts, check_unique=False, only_current=True)
            write_dimension(after, dimension_root)

    raw = spark.readStream.schema(raw_table_schema(bronze.RAW_TABLES[plan.raw_table])).parquet(raw_root)
    return run_available(raw, load, checkpoint)


def write_fact(
    batch: DataFrame,
    fact_root: str,
    partition_columns: Sequence[str] = silver.FACT_PARTITIONS,
    *,
    changes: str | None = None,
    batch_id: int = 0,
    stored: bool = False,
) -> None:
    """Merges a batch of valid lines into the partitioned fact table.

    The creation time is part of the key and gives the partition, so a line can only meet its
    older self within the partitions that the batch touches. Small tables do with years or
    months as partitions; a table always keeps the ones it was first written with.

    With `changes`, the touched partitions are put on record under the batch's number once they are in
    place; a batch that is repeated after a failure replaces its record. `stored` states that the batch is plain
    expressions over a written table: it is then read twice instead of being written in between.
    """
    spark = batch.sparkSession
    finish_replacement(spark, fact_root, partition_columns)
    with nullcontext(batch) if stored else written(batch, scratch_path(spark, "fact-batch")) as rows:
        if rows.isEmpty():
            return
        with written(partitions_of(rows, partition_columns), scratch_path(spark, "touched")) as touched:
            affected = rows_in_partitions(read_fact(spark, fact_root), touched, partition_columns)
            replace_partitions(silver.merge_fact(affected, rows), fact_root, partition_columns)
            if changes:
                append_batch(touched, changes, batch_id, column=BATCH)


def read_fact(spark: SparkSession, fact_root: str) -> DataFrame:
    """The fact table, or no rows before its first load."""
    return read_table_or_empty(spark, fact_root, schemas.FACT_SALE_ORDERS)
