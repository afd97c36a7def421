"""CSV files that an outside system drops, written by Spark from rows of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUND = "round"


def write_csv(df: DataFrame, folder: str, *partition_columns: str) -> str:
    """Rows as compressed files with a header; each has the rows of one task, so that none grows with the table."""
    df.write.mode("append").partitionBy(*partition_columns).options(header=True, compression="gzip").csv(folder)
    return folder


class Drops:
    """The files of several drops, written in one pass over the rows and dropped one after the other."""

    def __init__(self, rows: DataFrame, folder: str, rounds: Column, **changes: Column) -> None:
        """`rounds` has the numbers of the drops that a row is in; `changes` are new values, which may depend on ROUND."""
        self._spark, self._folder, self._empty = rows.sparkSession, folder, rows.limit(0)
        write_csv(rows.withColumn(ROUND, F.explode(rounds)).withColumns(changes), folder, ROUND)

    def arrive(self, number: int, landing: str) -> None:
        """Moves a drop's files into the landing folder. One without rows is a file without rows."""
        hadoop = self._spark._jvm.org.apache.hadoop.fs
        source, target = hadoop.Path(f"{self._folder}/{ROUND}={number}"), hadoop.Path(f"{landing}/drop-{number}")
        files = source.getFileSystem(self._spark._jsc.hadoopConfiguration())
        if not files.exists(source):
            write_csv(self._empty, target.toString())
            return
        files.mkdirs(target.getParent())
        if not files.rename(source, target):
            raise OSError(f"could not move {source.toString()} into the landing folder")


def in_rounds(*conditions: Column) -> Column:
    """The numbers of the conditions that hold."""
    numbers = F.array(*[F.when(c, F.lit(n)) for n, c in enumerate(conditions)])
    return F.array_compact(numbers)
