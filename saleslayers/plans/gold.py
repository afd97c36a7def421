"""Report tables over the fact table and the current rows of the dimensions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saleslayers import schemas
from saleslayers.operators.history import current_rows
from saleslayers.operators.merge import keys_match
from saleslayers.operators.rows import conform_to, timestamp
from saleslayers.sinks.bucketed import write_bucketed


@dataclass(frozen=True)
class Star:
    """The fact table and its dimensions, history included."""

    fact: DataFrame
    customers: DataFrame
    products: DataFrame
    suppliers: DataFrame
    warehouses: DataFrame


def _with(fact: DataFrame, dimension: DataFrame, key: str, **names: str) -> DataFrame:
    """Left join on the current rows, taking only the named columns (new=old).

    There is one current row per key, so no line is counted twice. No broadcast is forced:
    Spark decides by the measured size, and otherwise splits a hot key's lines, which are
    the left side.
    """
    attributes = current_rows(dimension).select(
        F.col(key).alias("__key"), *[F.col(old).alias(new) for new, old in names.items()]
    )
    return fact.join(attributes, F.col(key) == F.col("__key"), "left").drop("__key")


def co_located(star: Star, prefix: str, folder: str, buckets: int) -> Star:
    """The star with lines and current customers (the largest dimension) as catalog tables `<prefix>_fact` and
    `<prefix>_customers` in buckets of the customer, for reports that join them again and again."""
    fact = write_bucketed(star.fact, f"{prefix}_fact", f"{folder}/fact", "customer_id", buckets)
    customers = write_bucketed(current_rows(star.customers), f"{prefix}_customers", f"{folder}/customers", "customer_id", buckets)
    return replace(star, fact=fact, customers=customers)


# Sums run on exact decimals and become doubles once, at the end.


def _quantity() -> Column:
    return F.sum("quantity").alias("total_quantity_sold")


def _amount() -> Column:
    return F.sum(F.col("quantity") * F.col("unitprice")).cast("double").alias("total_sales_amount")


def _tax() -> Column:
    return F.sum("taxamount").cast("double").alias("total_tax_collected")


def _orders() -> Column:
    # Exact. Spark first groups on (report key, order number), which spreads a hot report key.
    return F.count_distinct("salesordernumber").alias("total_orders")


def star_lines(star: Star) -> DataFrame:
    """Order lines with the names of all four dimensions."""
    # The largest dimension first: if it needs a shuffle, the lines are still narrow.
    lines = _with(star.fact, star.customers, "customer_id", customer_name="customer_name")
    lines = _with(lines, star.products, "product_id", product_name="product_name")
    lines = _with(lines, star.suppliers, "supplier_id", supplier_name="supplier_name")
    return _with(lines, star.warehouses, "warehouse_id", warehouse_name="warehouse_name")


def sales_summary(star: Star, run_ts: datetime) -> DataFrame:
    """Customer x product x supplier x warehouse x day, by name."""
    return (
        star_lines(star)
        .groupBy(
            "customer_name",
            "product_name",
            "supplier_name",
            "warehouse_name",
            F.to_date("createddate").alias("sale_date"),
        )
        .agg(_quantity(), _amount(), _tax())
    )


def top_sales(star: Star, run_ts: datetime) -> DataFrame:
    """The summary, greatest sales first; equal amounts in key order."""
    return sales_summary(star, run_ts).orderBy(
        F.desc("total_sales_amount"),
        "customer_name",
        "product_name",
        "supplier_name",
        "warehouse_name",
        "sale_date",
    )


def by_country(star: Star, run_ts: datetime) -> DataFrame:
    return (
        _with(star.fact, star.customers, "customer_id", country="country")
        .groupBy("country")
        .agg(_amount(), _quantity(), _orders(), timestamp(run_ts).alias("last_updated"))
    )


def _by_supplier(star: Star, run_ts: datetime, period: Column) -> DataFrame:
    # Id and name come from the dimension: lines of unknown suppliers form the NULL group.
    lines = _with(
        star.fact.withColumnRenamed("supplier_id", "line_supplier_id"),
        star.suppliers.withColumn("line_supplier_id", F.col("supplier_id")),
        "line_supplier_id",
        supplier_id="supplier_id",
        supplier_name="supplier_name",
    )
    return lines.groupBy(period, "supplier_id", "supplier_name").agg(
        _amount(), _quantity(), _orders(), timestamp(run_ts).alias("last_updated")
    )


def by_supplier_daily(star: Star, run_ts: datetime) -> DataFrame:
    return _by_supplier(star, run_ts, F.to_date("createddate").alias("sales_date"))


def by_supplier_monthly(star: Star, run_ts: datetime) -> DataFrame:
    return _by_supplier(star, run_ts, F.date_format("createddate", "yyyy-MM").alias("sales_month"))


@dataclass(frozen=True)
class Report:
    name: str
    schema: StructType
    keys: tuple[str, ...]
    build: Callable[[Star, datetime], DataFrame]


REPORTS = {
    r.name: r
    for r in (
        Report(
            "sales_summary",
            schemas.SALES_SUMMARY,
            ("customer_name", "product_name", "supplier_name", "warehouse_name", "sale_date"),
            sales_summary,
        ),
        Report("by_country", schemas.BY_COUNTRY, ("country",), by_country),
        Report("by_supplier_daily", schemas.BY_SUPPLIER_DAILY, ("sales_date", "supplier_id"), by_supplier_daily),
        Report(
            "by_supplier_monthly", schemas.BY_SUPPLIER_MONTHLY, ("sales_month", "supplier_id"), by_supplier_monthly
        ),
    )
}


def report_rows(report: Report, star: Star, run_ts: datetime) -> DataFrame:
    """A report in the layout of its table, as new rows."""
    rows = report.build(star, run_ts).withColumns(
        {"created_at": timestamp(run_ts), "updated_at": timestamp(run_ts)}
    )
    return conform_to(rows, report.schema)


def refresh_report(table: DataFrame, rows: DataFrame, report: Report) -> DataFrame:
    """The report table after a run: the report as it is now, with the creation time of groups known before.

    A group that no line belongs to any more (its customer moved, its supplier has another name) goes, so
    a report always adds up to the fact table. Group keys may be NULL and are matched null-safely.
    """
    known = table.select(*report.keys, F.col("created_at").alias("__first")).alias("old")
    joined = rows.alias("new").join(known, keys_match("new", "old", report.keys), "left")
    created = F.coalesce(F.col("old.__first"), F.col("new.created_at")).alias("created_at")
    return joined.select(*[created if c == "created_at" else F.col(f"new.{c}") for c in report.schema.fieldNames()])
