"""Ordered quality rules for order lines: the first rule that applies names the defect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALID = "Valid"

Rule = tuple[Column, str]


def _missing_or_negative(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) < 0)


def order_line_rules() -> list[Rule]:
    """The nine defects of an order line, in order of precedence."""
    return [
        (_missing_or_negative("quantity"), "Invalid quantity"),
        (_missing_or_negative("taxamount"), "Invalid tax amount"),
        (_missing_or_negative("unitprice"), "Invalid unit price"),
        (F.col("customer_id").isNull(), "Missing customer ID"),
        (F.col("product_id").isNull(), "Missing product ID"),
        (F.col("supplier_id").isNull(), "Missing supplier ID"),
        (F.col("warehouse_id").isNull(), "Missing warehouse ID"),
        (F.col("createddate").isNull() | F.col("processeddate").isNull(), "Missing date"),
        (F.col("processeddate") < F.col("createddate"), "Invalid date order"),
    ]


def first_defect(rules: Sequence[Rule], otherwise: str = VALID) -> Column:
    """One CASE expression over the rules; `otherwise` when none applies."""
    if not rules:
        return F.lit(otherwise)
    (predicate, name), *rest = rules
    case = F.when(predicate, name)
    for predicate, name in rest:
        case = case.when(predicate, name)
    return case.otherwise(otherwise)


def label_quality(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Adds error_description (first defect or "Valid") and error_flag (1 for a defect)."""
    labelled = df.withColumn("error_description", first_defect(order_line_rules() if rules is None else rules))
    return labelled.withColumn("error_flag", F.when(F.col("error_description") == VALID, 0).otherwise(1))


def valid_rows(labelled: DataFrame) -> DataFrame:
    return labelled.filter(F.col("error_flag") == 0)


def rejected_rows(labelled: DataFrame) -> DataFrame:
    return labelled.filter(F.col("error_flag") == 1)


def quality_counts(labelled: DataFrame) -> DataFrame:
    """Rows per flag in one pass, instead of one count per stream."""
    return labelled.groupBy("error_flag").agg(F.count("*").alias("row_count"))
