"""What the document operators share: reading tables, words as columns, written intermediates, global row numbers."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from saleslayers.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space of the word definition, as a regular expression class.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back; cuts its lineage and gives its measured size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.written_to = path
    return back


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark resolves it: "/x" is on the default one, not a task's local disk."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()


def discard(df: DataFrame) -> None:
    """Deletes a table made by `written` that nothing will read again."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.written_to)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text as an array: runs of anything but ASCII white space. Null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """The frame in the given order with gapless row numbers from 0 in the column `name`.

    Rows are dealt by ranges of the order and sorted there; a partition's first number is the
    prefix sum of the sizes of those before it. Only these sizes, one row each, meet in a task.
    Rows that are equal in all of `order` are numbered in any order.
    """
    local, part, base = (fresh(df, n) for n in ("_local", "_part", "_base"))
    spread = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    sorted_rows = written(
        spread.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order]).withColumn(
            local, F.monotonically_increasing_id()
        ),
        "numbered",
    )
    # monotonically_increasing_id: the partition above bit 33, the row within it below.
    split = sorted_rows.withColumn(part, F.shiftright(local, 33)).withColumn(
        local, F.col(local).bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = split.groupBy(part).count()
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(base))
    return split.join(bases, part).withColumn(name, F.col(local) + F.col(base)).drop(local, part, base)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of steps whose results are written: it does so once the driver's
    objects for them are collected, which in a long job may be too late for the disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
