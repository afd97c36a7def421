"""CSV scans with a fixed schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

CSV_OPTIONS = {"header": True, "mode": "PERMISSIVE"}
#: Names of CSV files; a compressed one is read by one task.
CSV_FILES = "*.{csv,csv.gz}"
CORRUPT_RECORD = "_corrupt_record"


def csv_schema(schema: StructType, keep_corrupt: bool = False) -> StructType:
    """The read schema, with a column for the text of malformed lines when asked for."""
    return StructType([*schema.fields]).add(CORRUPT_RECORD, StringType()) if keep_corrupt else schema


def read_csv(
    spark: SparkSession, schema: StructType, paths: str | Sequence[str], *, keep_corrupt: bool = False
) -> DataFrame:
    """Rows of CSV files with a header; a value that does not parse is NULL, the row is kept."""
    return (
        spark.read.schema(csv_schema(schema, keep_corrupt))
        .options(**CSV_OPTIONS)
        .csv(paths if isinstance(paths, str) else list(paths))
    )


def parse_csv_lines(
    lines: DataFrame, schema: StructType, column: str = "line", keep: Sequence[str] = ()
) -> DataFrame:
    """Typed rows from single CSV lines held in a text column, behind them the columns to keep."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parsed = F.from_csv(F.col(column), ddl, {"mode": "PERMISSIVE"})
    return lines.select(parsed.alias("row"), *keep).select("row.*", *keep)
