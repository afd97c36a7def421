"""History-keeping dimensions: one current row per key, closed rows for the past (type 2)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslayers.operators.merge import fail_on_copies, keys_match
from saleslayers.operators.rows import timestamp


@dataclass(frozen=True)
class Dimension:
    """Which columns open a new version, and whether closing a row counts as an update of it."""

    key: str
    tracked: tuple[str, ...]
    closing_sets_updated_at: bool


# The tracked columns of each dimension.
CUSTOMERS = Dimension("customer_id", ("email", "phone", "customer_name"), True)
PRODUCTS = Dimension(
    "product_id", ("product_name", "category", "sub_category", "unit_price", "cost_price"), True
)
SUPPLIERS = Dimension(
    "supplier_id",
    (
        "supplier_name",
        "contact_name",
        "email",
        "phone",
        "address",
        "city",
        "state",
        "country",
        "postal_code",
        "business_category",
    ),
    False,
)
WAREHOUSES = Dimension("warehouse_id", ("location",), False)


def _differs(columns: Sequence[str]) -> Column:
    return reduce(or_, [~F.col(f"tgt.{c}").eqNullSafe(F.col(f"src.{c}")) for c in columns])


def current_rows(dimension: DataFrame) -> DataFrame:
    return dimension.filter(F.col("is_current"))


def apply_history(
    dimension: DataFrame,
    batch: DataFrame,
    rule: Dimension,
    run_ts: datetime,
    *,
    check_unique: bool = True,
    only_current: bool = False,
) -> DataFrame:
    """The dimension after a batch of conformed rows, at most one per key.

    A key whose tracked columns changed gets its current row closed at `run_ts` and the batch
    row as its new current row; new keys are added; everything else is left as it is. Changes
    in other columns open no version. Running the same batch again changes nothing.

    Closed history never takes part in the join. Current rows and batch meet in one full outer join, so each
    input is read and shuffled once per load, and every outcome is emitted from the joined row. With
    `only_current`, the caller states that the dimension's closed rows are kept elsewhere.
    """
    key = [rule.key]
    current = current_rows(dimension).withColumn("__known", F.lit(True)).alias("tgt")
    changes = batch.withColumn("__hit", F.lit(True)).alias("src")
    joined = current.join(changes, keys_match("tgt", "src", key), "full")

    closing = {"is_current": F.lit(False), "end_date": timestamp(run_ts)}
    if rule.closing_sets_updated_at:
        closing["updated_at"] = timestamp(run_ts)

    def row(value: Callable[[str], Column]) -> Column:
        return F.struct(*[value(f.name).cast(f.dataType).alias(f.name) for f in dimension.schema])

    kept = row(lambda c: F.col(f"tgt.{c}"))
    closed = row(lambda c: closing.get(c, F.col(f"tgt.{c}")))
    opened = row(lambda c: F.col(f"src.{c}"))
    outcome = (
        F.when(F.col("tgt.__known").isNull(), F.array(opened))
        .when(F.col("src.__hit").isNotNull() & _differs(rule.tracked), F.array(closed, opened))
        .otherwise(F.array(kept))
    )
    after = joined.select(F.inline(outcome))
    if not only_current:
        after = dimension.filter(~F.coalesce(F.col("is_current"), F.lit(False))).unionByName(after)
    if not check_unique:
        return after
    return after.unionByName(fail_on_copies(batch.select(*key), key, dimension.schema))
