"""Raw tables: required columns present, one row per key and load, stamped with the load time."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from saleslayers import schemas
from saleslayers.operators.rows import date_parts, dedupe_latest, require_not_null, stamp


@dataclass(frozen=True)
class RawTable:
    """One kind of raw file and how its rows are kept."""

    name: str
    schema: StructType
    required: tuple[str, ...]
    keys: tuple[str, ...]
    order_by: tuple[str, ...]
    date_column: str | None = None

    @property
    def partition_columns(self) -> tuple[str, ...]:
        """Months for dated rows; small tables stay unpartitioned."""
        return ("year", "month") if self.date_column else ()


# Required columns, keys and order of each raw table. Customers and products
# carry no order of their own, so only the tie-break decides between their copies.
RAW_TABLES = {
    t.name: t
    for t in (
        RawTable(
            "sale_orders",
            schemas.SALE_ORDERS,
            ("salesordernumber", "salesorderlinenumber", "createddate"),
            ("salesordernumber", "salesorderlinenumber"),
            ("processeddate",),
            "createddate",
        ),
        RawTable(
            "customers",
            schemas.CUSTOMERS,
            ("FirstName", "LastName", "CustomerID", "EmailAddress"),
            ("CustomerID",),
            (),
        ),
        RawTable("products", schemas.PRODUCTS, ("ProductID", "ProductNumber"), ("ProductID", "ProductNumber"), ()),
        RawTable(
            "suppliers",
            schemas.SUPPLIERS,
            ("supplier_id", "supplier_name", "email", "phone"),
            ("supplier_id", "supplier_name"),
            ("created_at",),
        ),
        RawTable(
            "warehouses",
            schemas.WAREHOUSES,
            ("warehouse_id", "warehouse_name", "country", "location"),
            ("warehouse_id",),
            ("created_at",),
        ),
    )
}


def ingest(raw: DataFrame, table: RawTable, run_ts: datetime) -> DataFrame:
    """Rows of one load, ready to append."""
    kept = dedupe_latest(require_not_null(raw, table.required), table.keys, table.order_by)
    if table.date_column:
        kept = date_parts(kept, table.date_column)
    return stamp(kept, run_ts)
