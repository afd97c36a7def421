"""Exact distinct orders that add up: daily bitmaps of order numbers, from which months and suppliers are counted.

A count of distinct orders of a month is not the sum of its days' counts. With dense order numbers a day's orders
of a supplier are bits, 32768 numbers to a bitmap; the days' bitmaps are joined by OR, and their bits counted. So a
month, quarter or year is counted from the daily table and no line is read again. Numbers follow the orders' days,
so that a day's orders lie in few bitmaps. A bitmap is kept as its words of 64 bits that have a bit: most suppliers
have few orders a day, and sums over words of fixed width need no sort.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslayers.operators.history import current_rows
from saleslayers.operators.numbering import number_new
from saleslayers.operators.rows import timestamp
from saleslayers.plans.gold import Star

ORDER = "salesordernumber"


def new_order_numbers(lines: DataFrame, known: DataFrame) -> DataFrame:
    """Numbers (salesordernumber, number) of orders that are not known yet, by their first day."""
    first = lines.groupBy(ORDER).agg(F.min("createddate").alias("first"))
    return number_new(first, ORDER, known, ["first", ORDER])


def daily(lines: DataFrame, numbers: DataFrame, *keys: str) -> DataFrame:
    """Sums per day, keys and word of a bitmap of order numbers: sales_date, keys, bucket, word, quantity, amount, orders."""
    position = F.bitmap_bit_position(F.col("number"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), position.bitwiseAND(F.lit(63)).cast("int"))
    return (
        lines.join(numbers, ORDER)
        .groupBy(
            F.to_date("createddate").alias("sales_date"),
            *keys,
            F.bitmap_bucket_number(F.col("number")).alias("bucket"),
            F.shiftright(position, 6).alias("word"),
        )
        .agg(
            F.sum("quantity").alias("quantity"),
            F.sum(F.col("quantity") * F.col("unitprice")).alias("amount"),
            F.bit_or(bit).alias("orders"),
        )
    )


def totals(days: DataFrame, *keys: str) -> DataFrame:
    """Totals of any columns of daily sums: total_sales_amount, total_quantity_sold, total_orders (exact).

    The orders of a hot key are many words, which are joined apart from each other; only their counts meet.
    """
    joined = days.groupBy(*keys, "bucket", "word").agg(
        F.sum("quantity").alias("quantity"), F.sum("amount").alias("amount"), F.bit_count(F.bit_or("orders")).cast("long").alias("orders")
    )
    return joined.groupBy(*keys).agg(
        F.sum("amount").cast("double").alias("total_sales_amount"), F.sum("quantity").alias("total_quantity_sold"), F.sum("orders").alias("total_orders")
    )


def supplier_monthly(days: DataFrame, star: Star, run_ts: datetime) -> DataFrame:
    """The monthly supplier report from daily sums by line_supplier."""
    suppliers = current_rows(star.suppliers).select(F.col("supplier_id").alias("line_supplier"), "supplier_id", "supplier_name")
    named = days.join(suppliers, "line_supplier", "left").drop("line_supplier")
    monthly = totals(named.withColumn("sales_month", F.date_format("sales_date", "yyyy-MM")), "sales_month", "supplier_id", "supplier_name")
    return monthly.withColumn("last_updated", timestamp(run_ts))
