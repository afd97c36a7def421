"""Cleaning, conforming and quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslayers.catalog.base import Query, bronze_table, dimension, fact, labelled, raw
from saleslayers.catalog.mapping import RUN_TS
from saleslayers.catalog.sql import (
    EMAIL_ADDRESS,
    bronze_sql,
    conform_sql,
    digits_sql,
    dimension_sql,
    fact_sql,
    labelled_lines_sql,
    lines_sql,
    raw_sql,
)
from saleslayers.functions.cleaning import null_if_not_digits, null_if_not_email
from saleslayers.functions.quality import quality_counts, rejected_rows
from saleslayers.operators import conform

QUERIES = {
    "clean_numeric_text": Query(
        lambda spark, d: raw(spark, d, "customers").select(
            "CustomerID", null_if_not_digits(F.col("PostalCode")).alias("postal_code")
        ),
        f'SELECT "CustomerID", {digits_sql(chr(34) + "PostalCode" + chr(34))} AS postal_code FROM ({raw_sql("customers")})',
    ),
    # Returned lines get a negative number here, which the rule turns into NULL.
    "clean_line_number": Query(
        lambda spark, d: raw(spark, d, "sale_orders").select(
            "salesordernumber",
            "processeddate",
            null_if_not_digits(
                F.when(F.col("ordertype") == "P", -F.col("salesorderlinenumber")).otherwise(
                    F.col("salesorderlinenumber")
                )
            ).alias("line_number"),
        ),
        f"""SELECT salesordernumber, processeddate,
            CASE WHEN ordertype = 'P' AND salesorderlinenumber > 0 THEN NULL ELSE salesorderlinenumber END AS line_number
            FROM ({raw_sql("sale_orders")})""",
    ),
    "clean_email": Query(
        lambda spark, d: raw(spark, d, "suppliers").select(
            "supplier_id", null_if_not_email(F.col("email")).alias("email")
        ),
        f"""SELECT supplier_id, CASE WHEN regexp_matches(email, '{EMAIL_ADDRESS}') THEN email END AS email
            FROM ({raw_sql("suppliers")})""",
    ),
    **{
        f"silver_{name}": Query(
            lambda spark, d, name=name: getattr(conform, name)(bronze_table(spark, d, name), RUN_TS),
            conform_sql(name, f"({bronze_sql(name)})"),
        )
        for name in ("customers", "products", "suppliers", "warehouses")
    },
    "silver_fact": Query(
        lambda spark, d: conform.sale_orders(bronze_table(spark, d, "sale_orders")),
        lines_sql(f"({bronze_sql('sale_orders')})"),
    ),
    "fact_quality_label": Query(
        lambda spark, d: labelled(spark, d).select(
            "salesordernumber", "salesorderlinenumber", "error_description"
        ),
        f"SELECT salesordernumber, salesorderlinenumber, error_description FROM ({labelled_lines_sql()})",
    ),
    "fact_quality_flag": Query(lambda spark, d: labelled(spark, d), labelled_lines_sql()),
    "fact_quality_counts": Query(
        lambda spark, d: quality_counts(labelled(spark, d)),
        f"SELECT error_flag, count(*) AS row_count FROM ({labelled_lines_sql()}) GROUP BY error_flag",
    ),
    "fact_rejects": Query(
        lambda spark, d: rejected_rows(labelled(spark, d)),
        f"SELECT * FROM ({labelled_lines_sql()}) WHERE error_flag = 1",
    ),
    "dedupe_fact": Query(fact, fact_sql()),
    "dimension_batch_customers": Query(
        lambda spark, d: dimension(spark, d, "dim_customers"), dimension_sql("customers")
    ),
}
