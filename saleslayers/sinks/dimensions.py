"""History-keeping dimensions as tables whose closed rows are written once.

Each version of a dimension holds its current rows and the rows closed by the load that made
it. So a load rewrites current rows only, however long the history, and a report that needs
current rows reads nothing else.

Closed rows of many loads are merged: MERGED_AT_ONCE neighbouring parts of one size become one, sorted by the time
their rows were closed, and those parts again. A history of n loads has a number of parts in the order of
log n, and each closed row is rewritten as often.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saleslayers.sinks.tables import complete_folders, drop_folder, drop_old_versions, read_version, versions, write_version

#: Parts of closed rows that are merged into one.
MERGED_AT_ONCE = 16


def write_dimension(current_and_closed: DataFrame, root: str) -> int:
    """Writes the outcome of one load: all current rows and the newly closed ones."""
    return write_version(current_and_closed, root, ["is_current"])


def read_current(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The current rows."""
    return read_version(spark, root, schema).filter(F.col("is_current")).select(*schema.fieldNames())


@dataclass(frozen=True, order=True)
class ClosedPart:
    """Closed rows of the loads from the first to the last."""

    first: int
    last: int

    @property
    def loads(self) -> int:
        return self.last - self.first + 1


def parts_to_read(loads: list[int], merged: list[ClosedPart]) -> list[ClosedPart]:
    """Parts that hold the closed rows of all loads once: merged ones, and loads that no merged part holds.

    A part that a larger one holds is left from an interrupted clean-up.
    """
    every = [ClosedPart(n, n) for n in loads] + merged
    chosen: list[ClosedPart] = []
    for part in sorted(every, key=lambda p: (p.first, -p.last)):
        if not chosen or part.last > chosen[-1].last:
            chosen.append(part)
    return chosen


def next_merge(parts: list[ClosedPart], at_once: int = MERGED_AT_ONCE) -> list[ClosedPart]:
    """The oldest `at_once` neighbours of one size (within a factor of that number), or none."""

    def size(part: ClosedPart) -> int:
        level, n = 0, part.loads
        while n >= at_once:
            level, n = level + 1, n // at_once
        return level

    for k in range(len(parts) - at_once + 1):
        run = parts[k : k + at_once]
        if len({size(part) for part in run}) == 1:
            return run
    return []


def _merged(spark: SparkSession, root: str) -> list[ClosedPart]:
    return [ClosedPart(*map(int, name.split("-"))) for name in complete_folders(spark, f"{root}/closed", "loads=")]


def _place(root: str, part: ClosedPart) -> str:
    return f"{root}/version={part.first}" if part.loads == 1 else f"{root}/closed/loads={part.first}-{part.last}"


def _closed(spark: SparkSession, root: str, parts: list[ClosedPart], schema: StructType) -> DataFrame:
    """Closed rows of parts; no current part is opened."""
    rows = spark.createDataFrame([], schema)
    single, merged = [_place(root, p) for p in parts if p.loads == 1], [_place(root, p) for p in parts if p.loads > 1]
    if single:
        found = spark.read.schema(schema).option("basePath", root).parquet(*single)
        rows = rows.unionByName(found.filter(~F.col("is_current")).select(*schema.fieldNames()))
    if merged:
        rows = rows.unionByName(spark.read.schema(schema).parquet(*merged))
    return rows


def read_history(
    spark: SparkSession, root: str, schema: StructType, closed_after: datetime | None = None
) -> DataFrame:
    """Current and closed rows; with `closed_after`, of the closed ones only those closed later (merged parts are sorted
    by that time, so their files are skipped)."""
    known = versions(spark, root)
    if not known:
        return spark.createDataFrame([], schema)
    closed = _closed(spark, root, parts_to_read(known, _merged(spark, root)), schema)
    if closed_after is not None:
        closed = closed.filter(F.col("end_date") > F.lit(closed_after).cast("timestamp"))
    return read_current(spark, root, schema).unionByName(closed)


def compact_history(
    spark: SparkSession, root: str, schema: StructType, keep: int = 2, at_once: int = MERGED_AT_ONCE
) -> None:
    """Merges closed rows of loads before the last `keep`, as long as there are enough parts of one size.

    A merged part counts once it is complete, and replaces the parts it holds from then on; these are deleted
    after it, so an interrupted run loses nothing and leaves nothing that is read twice.
    """
    while True:
        known = versions(spark, root)
        old, merged = known[: max(len(known) - max(keep, 1), 0)], _merged(spark, root)
        parts = parts_to_read(old, merged)
        for left in sorted({*merged, *[ClosedPart(n, n) for n in old]} - {*parts}):
            drop_folder(spark, _place(root, left))
        run = next_merge(parts, at_once)
        if not run:
            return
        whole = ClosedPart(run[0].first, run[-1].last)
        rows = _closed(spark, root, run, schema)
        rows.repartitionByRange("end_date").sortWithinPartitions("end_date").write.mode("overwrite").parquet(_place(root, whole))


def drop_old_current_rows(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Frees the current parts of older versions; closed rows stay."""
    drop_old_versions(spark, root, keep, "is_current=true")
