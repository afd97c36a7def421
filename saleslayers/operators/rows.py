"""Filters, stamps and latest-row selection."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which every listed column has a value (NaN counts as a value)."""
    return df.filter(reduce(and_, [F.col(c).isNotNull() for c in columns], F.lit(True)))


def stamp(df: DataFrame, run_ts: datetime, column: str = "ingestion_timestamp") -> DataFrame:
    """Adds the load time; one value per run, given by the caller."""
    return df.withColumn(column, timestamp(run_ts))


def timestamp(value: datetime) -> Column:
    return F.lit(value).cast("timestamp")


def date_parts(df: DataFrame, column: str) -> DataFrame:
    """Adds year, month and day of a date or timestamp column."""
    return df.withColumns(
        {"year": F.year(column), "month": F.month(column), "day": F.dayofmonth(column)}
    )


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str | Sequence[str],
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row per key.

    Newest is the greatest `order_by`, NULL last. Ties are settled by all remaining columns
    (by name, greatest first), so the outcome does not depend on how rows are laid out.

    Spark plans `row_number() = 1` with a group limit on both sides of the shuffle, so each
    map task sends at most one row per key, however many copies of a key there are.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    if tiebreak is None:
        tiebreak = sorted(set(df.columns) - set(keys) - set(order))
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*order, *tiebreak]])
    return df.withColumn("rn", F.row_number().over(window)).filter(F.col("rn") == 1).drop("rn")


def conform_to(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of `schema`, in its order and types.

    Values that do not fit become NULL, missing columns are added as NULL, others are dropped.
    """
    present = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            (
                F.lit(None).cast(f.dataType)
                if f.name not in present
                else F.col(f.name)
                if present[f.name] == f.dataType
                else F.col(f.name).try_cast(f.dataType)
            ).alias(f.name)
            for f in schema
        ]
    )
