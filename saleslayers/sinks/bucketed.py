"""Tables of the session catalog whose rows lie in buckets of a key, so that joins on it move no row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslayers.session import scratch_path
from saleslayers.sinks.tables import written

#: A bucket is read by one task, which adaptive execution cannot split. Above so many times the mean bucket, a
#: table is written without buckets: its joins then shuffle, and a hot key's rows are split.
LARGEST_BUCKET = 2.0


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket that Spark writes a key's rows to."""
    return F.pmod(F.hash(key), F.lit(buckets))


def is_even(rows: DataFrame, key: str, buckets: int) -> bool:
    """Whether no bucket has more than LARGEST_BUCKET times the mean; of few rows any may be the largest.

    One row per bucket comes to the driver.
    """
    sizes = [r["count"] for r in rows.groupBy(bucket_of(key, buckets)).count().select("count").collect()]
    mean = sum(sizes) / buckets
    return max(sizes, default=0) <= max(LARGEST_BUCKET * mean, 1000)


def write_bucketed(rows: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Writes rows as an external table in buckets of a key, sorted by it, and reads it back by its name.

    Bucketed tables of one number of buckets join on their keys without a shuffle of either; where a key
    is hot the table gets no buckets. One file per bucket: the shuffle of the write is the last one on this key.
    The rows are evaluated once, for the sizes of the buckets and for the table.
    """
    spark = rows.sparkSession
    with written(rows, scratch_path(spark, "bucketed")) as stored:
        even = is_even(stored, key, buckets)
        writer = (stored.repartition(buckets, key) if even else stored).write.mode("overwrite").option("path", path)
        (writer.bucketBy(buckets, key).sortBy(key) if even else writer).saveAsTable(table)
    return spark.table(table)


def drop_tables(spark: SparkSession, *tables: str) -> None:
    """Takes external tables out of the catalog; their files stay."""
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
