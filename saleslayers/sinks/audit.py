"""What each batch read: one audit row per file."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslayers.operators.rows import timestamp
from saleslayers.sources.landing import PROCESSED


def file_audit(rows: DataFrame, batch_id: int, run_ts: datetime, file_column: str = "source_file") -> DataFrame:
    """Rows and first and last creation time per source file of a batch.

    `rows` carries the file path as a column (`_metadata.file_path` of the scan).
    """
    measures = [F.count("*").alias("row_count")]
    if "createddate" in rows.columns:
        measures += [F.min("createddate").alias("first_created"), F.max("createddate").alias("last_created")]
    return (
        rows.groupBy(F.col(file_column).alias("file_key"))
        .agg(*measures)
        .withColumns(
            {
                "batch_id": F.lit(batch_id).cast("long"),
                "status": F.lit(PROCESSED),
                "processed_at": timestamp(run_ts),
            }
        )
    )


def empty_file_audit(files: DataFrame, run_ts: datetime, dated: bool) -> DataFrame:
    """Audit rows of files (column file_key) that were read and hold no data row; they belong to no batch."""
    none = F.lit(None).cast("timestamp")
    times = {"first_created": none, "last_created": none} if dated else {}
    return files.select("file_key").distinct().withColumns(
        {"row_count": F.lit(0).cast("long"), **times, "batch_id": F.lit(None).cast("long"), "status": F.lit(PROCESSED), "processed_at": timestamp(run_ts)}
    )
