"""Dense numbers for the values of a column, kept from load to load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from saleslayers.session import scratch_path
from saleslayers.sinks.tables import written

# monotonically_increasing_id has the partition above this bit and the row within it below.
_PARTITION_BIT = 33


def with_numbers(values: DataFrame, order: list[str], start: int, name: str = "number") -> DataFrame:
    """The rows with gapless numbers from `start` in the given order, read from a table of the scratch folder.

    Rows are dealt by ranges of the order and sorted there; what meets in one task is the size of each range
    alone, whose prefix sum is its first number.
    """
    columns = [F.col(c).asc_nulls_first() for c in order]
    spread = values.repartitionByRange(*columns).sortWithinPartitions(*columns)
    local = spread.withColumn("__local", F.monotonically_increasing_id())
    with written(local, scratch_path(values.sparkSession, "numbering")) as rows:
        split = rows.withColumns({"__part": F.shiftright("__local", _PARTITION_BIT), "__local": F.col("__local").bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1))})
        before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        bases = split.groupBy("__part").count().select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__base"))
        numbered = split.join(bases, "__part").withColumn(name, F.col("__local") + F.col("__base") + F.lit(start))
        path = scratch_path(values.sparkSession, "numbers")
        numbered.drop("__part", "__local", "__base").write.parquet(path)
    return values.sparkSession.read.parquet(path)


def number_new(values: DataFrame, column: str, known: DataFrame, order: list[str]) -> DataFrame:
    """Numbers (column, number) for the values that `known` (column, number) does not have, following its last one."""
    last = known.agg(F.max("number")).first()[0]
    new = values.join(known.select(column), column, "left_anti")
    return with_numbers(new, order, 0 if last is None else last + 1).select(column, "number")
