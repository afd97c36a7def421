"""Row operators and raw tables."""

from __future__ import annotations

from datetime import datetime, timezone

from saleslayers.catalog.base import Query, bronze_table, raw
from saleslayers.catalog.mapping import table
from saleslayers.catalog.sql import bronze_sql, latest, raw_sql
from saleslayers.operators.rows import dedupe_latest, require_not_null
from saleslayers.plans.bronze import RAW_TABLES
from saleslayers.sources.tables import rows_after

ORDERS = RAW_TABLES["sale_orders"]
CUSTOMERS = RAW_TABLES["customers"]

QUERIES = {
    "require_not_null": Query(
        lambda spark, d: require_not_null(raw(spark, d, "customers"), CUSTOMERS.required),
        f'SELECT * FROM ({raw_sql("customers")}) WHERE '
        + " AND ".join(f'"{c}" IS NOT NULL' for c in CUSTOMERS.required),
    ),
    "dedupe_latest": Query(
        lambda spark, d: dedupe_latest(raw(spark, d, "sale_orders"), ORDERS.keys, ORDERS.order_by),
        latest(f"({raw_sql('sale_orders')})", ORDERS.schema.fieldNames(), ORDERS.keys, ORDERS.order_by),
    ),
    "scan_incremental": Query(
        lambda spark, d: rows_after(
            table(spark, d, "events"), datetime(2024, 1, 20, tzinfo=timezone.utc), column="ts"
        ),
        "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'",
    ),
    **{
        f"bronze_{name}": Query(lambda spark, d, name=name: bronze_table(spark, d, name), bronze_sql(name))
        for name in RAW_TABLES
    },
}
