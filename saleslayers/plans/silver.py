"""Refined tables: conformed dimensions and the order-line fact."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saleslayers import schemas
from saleslayers.functions.quality import label_quality, valid_rows
from saleslayers.operators import conform, history
from saleslayers.operators.merge import merge
from saleslayers.operators.rows import dedupe_latest


@dataclass(frozen=True)
class DimensionPlan:
    """From a raw table to its dimension."""

    raw_table: str
    schema: StructType
    conform: Callable[..., DataFrame]
    rule: history.Dimension
    order_by: tuple[str, ...] = ()


DIMENSIONS = {
    "dim_customers": DimensionPlan("customers", schemas.DIM_CUSTOMERS, conform.customers, history.CUSTOMERS),
    "dim_products": DimensionPlan("products", schemas.DIM_PRODUCTS, conform.products, history.PRODUCTS),
    "dim_suppliers": DimensionPlan(
        "suppliers", schemas.DIM_SUPPLIERS, conform.suppliers, history.SUPPLIERS, ("updated_at",)
    ),
    "dim_warehouses": DimensionPlan(
        "warehouses", schemas.DIM_WAREHOUSES, conform.warehouses, history.WAREHOUSES, ("updated_at",)
    ),
}

# The key of an order line in the fact table, and what makes two valid lines
# of one load copies of each other.
FACT_KEYS = ("salesordernumber", "salesorderlinenumber", "product_id", "customer_id", "createddate")
FACT_COPY_KEYS = ("createddate", "customer_id", "product_id")
FACT_PARTITIONS = ("year", "month", "day")


def latest_load(raw: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The newest row per business key over several loads."""
    return dedupe_latest(raw, keys, ["ingestion_timestamp", *order_by])


def dimension_batch(raw: DataFrame, plan: DimensionPlan, run_ts: datetime) -> DataFrame:
    """Conformed rows of the new loads, one per dimension key.

    Copies are settled after conforming: two raw keys can become one ("7" and "07"). Rows
    whose key does not parse are in `dimension_rejects`.
    """
    conformed = plan.conform(raw, run_ts, carry=["ingestion_timestamp"])
    keyed = conformed.filter(F.col(plan.rule.key).isNotNull())
    return latest_load(keyed, [plan.rule.key], plan.order_by).drop("ingestion_timestamp")


def dimension_rejects(raw: DataFrame, plan: DimensionPlan, run_ts: datetime) -> DataFrame:
    """Conformed rows without a usable key; no order line can refer to them."""
    return plan.conform(raw, run_ts).filter(F.col(plan.rule.key).isNull())


def refresh_dimension(dimension: DataFrame, raw: DataFrame, plan: DimensionPlan, run_ts: datetime) -> DataFrame:
    """The dimension after the raw rows of the new loads."""
    batch = dimension_batch(raw, plan, run_ts)
    # One row per key by construction, so the uniqueness check is left out.
    return history.apply_history(dimension, batch, plan.rule, run_ts, check_unique=False)


LOAD = "ingestion_timestamp"


def labelled_lines(raw: DataFrame) -> DataFrame:
    """Conformed order lines of the new loads with quality labels and the time of their load."""
    return label_quality(conform.sale_orders(raw, carry=[LOAD]))


def fact_batch(labelled: DataFrame) -> DataFrame:
    """Valid lines, one per fact key.

    Within a load, lines of one customer, product and creation time are copies, and the later processed
    one stays. Over several loads (if the lines know their load) the newest load's line stays. As rejects
    are out before any copy is chosen, and loads are settled one by one, the fact table does not
    depend on which loads a batch happens to hold.
    """
    load = [LOAD] if LOAD in labelled.columns else []
    valid = valid_rows(labelled).select(*schemas.FACT_SALE_ORDERS.fieldNames(), *load)
    lines = dedupe_latest(valid, [*FACT_COPY_KEYS, *load], "processeddate")
    if load:
        lines = dedupe_latest(lines, FACT_KEYS, [LOAD, "processeddate"]).drop(LOAD)
    return lines


def merge_fact(fact: DataFrame, batch: DataFrame) -> DataFrame:
    """The fact table after a batch: known lines updated, new lines added."""
    updated = [c for c in schemas.FACT_SALE_ORDERS.fieldNames() if c not in FACT_KEYS]
    # One line per fact key by construction, in the batch and so in the table.
    return merge(fact, batch, FACT_KEYS, set=updated, check_unique=False, unique_target=True)
