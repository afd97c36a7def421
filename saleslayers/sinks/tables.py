"""Parquet tables: append, replace by version, replace by partition."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


MOVES_AT_ONCE = 32

#: Number of rows of a partition in `partitions_of`.
LINES = "lines"


def laid_out(df: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """Rows grouped by partition before a write, so each partition gets few files.

    The rebalance hint lets adaptive execution split a partition that holds very many rows
    over several tasks, and put small ones together.
    """
    return df.hint("rebalance", *partition_columns) if partition_columns else df


def append(df: DataFrame, path: str, partition_columns: Sequence[str] = ()) -> None:
    laid_out(df, partition_columns).write.mode("append").partitionBy(*partition_columns).parquet(path)


def append_batch(
    df: DataFrame, path: str, batch_id: int, partition_columns: Sequence[str] = (), column: str = "ingest_batch"
) -> None:
    """An append that can be repeated: each batch has its own partition, replaced as a whole.

    Readers that ask for `ingest_batch > n` read the newer batches only.
    """
    folder = f"{path}/{column}={batch_id}"
    laid_out(df, partition_columns).write.mode("overwrite").partitionBy(*partition_columns).parquet(folder)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """The same rows, read back from a written table.

    Cuts a long lineage, evaluates a frame with several consumers once, survives lost executors,
    and gives the planner the real size.
    """
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def written(df: DataFrame, path: str) -> Iterator[DataFrame]:
    """`materialise` for the length of a block; the written copy is deleted at its end."""
    try:
        yield materialise(df, path)
    finally:
        drop_folder(df.sparkSession, path)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder, hadoop


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder if it is there."""
    fs, folder, _ = _file_system(spark, path.rstrip("/"))
    fs.delete(folder, True)


def complete_folders(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """What follows a prefix in the names of the completely written folders below a root."""
    fs, folder, hadoop = _file_system(spark, root)
    if not fs.exists(folder):
        return []
    found = [status.getPath() for status in fs.listStatus(folder)]
    return [p.getName()[len(prefix) :] for p in found if p.getName().startswith(prefix) and fs.exists(hadoop.Path(p, "_SUCCESS"))]


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions below a table root, oldest first."""
    return sorted(map(int, complete_folders(spark, root, "version=")))


def read_version(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The newest complete version of a table, or no rows when there is none."""
    known = versions(spark, root)
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/version={known[-1]}")


def write_version(df: DataFrame, root: str, partition_columns: Sequence[str] = ()) -> int:
    """Writes the next version beside the ones being read; it counts once it is complete."""
    number = max(versions(df.sparkSession, root), default=0) + 1
    laid_out(df, partition_columns).write.mode("overwrite").partitionBy(*partition_columns).parquet(
        f"{root}/version={number}"
    )
    return number


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2, part: str = "") -> None:
    """Deletes all but the newest complete versions, or one part (subfolder) of each of them.

    Readers of the kept ones are not disturbed.
    """
    fs, _, hadoop = _file_system(spark, root)
    for number in versions(spark, root)[: -max(keep, 1)]:
        fs.delete(hadoop.Path(f"{root}/version={number}/{part}".rstrip("/")), True)


def partitions_of(rows: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """The partitions that rows belong to, with the number of their lines."""
    return rows.groupBy(*partition_columns).agg(F.count("*").alias(LINES))


def rows_in_partitions(table: DataFrame, partitions: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """The table's rows in some partitions (a written frame of `partitions_of`).

    A semi join on the bare partition columns: Spark first reads the small frame and then lists only the
    folders that it names (dynamic partition pruning), however many there are, and nothing comes to the
    driver but these names, typed. Partition values are not NULL.
    """
    # The comparison tells the planner that the frame selects; without one it would not prune.
    named = partitions.filter(F.col(LINES) > 0).select(*partition_columns)
    return table.join(named, list(partition_columns), "left_semi")


def replace_partitions(df: DataFrame, path: str, partition_columns: Sequence[str]) -> None:
    """Replaces just the partitions that `df` has rows for.

    The new partitions are first written beside the table, whole, and then moved into place.
    `finish_replacement` completes the moves if the driver dies between them.
    """
    laid_out(df, partition_columns).write.mode("overwrite").partitionBy(*partition_columns).parquet(_pending(path))
    finish_replacement(df.sparkSession, path, partition_columns)


def finish_replacement(spark: SparkSession, path: str, partition_columns: Sequence[str]) -> None:
    """Moves completely written partitions into the table; does nothing when there are none.

    To be called before reading a table that is about to be changed.
    """
    fs, pending, hadoop = _file_system(spark, _pending(path))
    if not fs.exists(hadoop.Path(pending, "_SUCCESS")):
        return
    pattern = "/".join(f"{c}=*" for c in partition_columns)

    def move(source) -> None:
        place = "/".join(source.toString().split("/")[-len(partition_columns) :])
        target = hadoop.Path(f"{path.rstrip('/')}/{place}")
        fs.mkdirs(target.getParent())
        fs.delete(target, True)
        if not fs.rename(source, target):
            raise OSError(f"could not move {source.toString()} into the table")

    # Many at a time: on an object store each move is a copy.
    with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
        list(pool.map(move, [status.getPath() for status in fs.globStatus(hadoop.Path(pending, pattern))]))
    fs.delete(pending, True)


def _pending(path: str) -> str:
    return f"{path.rstrip('/')}.pending"
