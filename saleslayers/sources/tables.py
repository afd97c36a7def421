"""Table scans, whole or only what is new to a consumer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, name_or_path: str, schema: StructType | None = None) -> DataFrame:
    """All rows of a catalog table ("db.table") or of a Parquet folder (a path)."""
    if "/" not in name_or_path:
        return spark.table(name_or_path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(name_or_path)


def read_table_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The columns of `schema` of a Parquet folder; no rows before its first write.

    The planner knows that these are none, so that what meets them in a join is not shuffled.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema).filter(F.lit(False))
    return spark.read.schema(schema).parquet(path)


def rows_after(df: DataFrame, watermark: datetime | None, column: str = "ingestion_timestamp") -> DataFrame:
    """Rows stamped after the consumer's watermark; all rows when it has none yet.

    The comparison is on the bare column, so it reaches the Parquet scan.
    """
    if watermark is None:
        return df
    return df.filter(F.col(column) > F.lit(watermark).cast(df.schema[column].dataType))


def loads_after(table: DataFrame, ledger: DataFrame, watermark: datetime | None) -> DataFrame:
    """Rows of a table partitioned by `ingest_batch` whose load came after the consumer's watermark.

    The ledger says which batches these are, and the join on the partition column lists only their folders
    (dynamic partition pruning): no file of an older load is opened, however many loads there are.
    """
    if watermark is None:
        return table
    newer = rows_after(ledger, watermark).select("ingest_batch").distinct()
    return table.join(newer, "ingest_batch", "left_semi").select(*table.columns)


def watermark_of(df: DataFrame, column: str = "ingestion_timestamp") -> datetime | None:
    """The newest stamp among consumed rows, to be kept by the consumer (one value)."""
    return df.agg(F.max(column)).first()[0]
