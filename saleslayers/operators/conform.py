"""Raw rows to the column layout of the refined tables.

Text that does not parse as its target type becomes NULL (`try_cast`), so one bad value
never fails a load; for order lines the quality rules then reject the row. `carry` names
raw columns to keep behind the conformed ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from saleslayers.functions.cleaning import null_if_not_digits, null_if_not_email
from saleslayers.operators.rows import timestamp


def validity(run_ts: datetime) -> list[Column]:
    """An open validity interval starting now."""
    return [
        timestamp(run_ts).alias("start_date"),
        F.lit(None).cast("timestamp").alias("end_date"),
        F.lit(True).alias("is_current"),
    ]


def load_times(run_ts: datetime) -> list[Column]:
    return [timestamp(run_ts).alias("created_at"), timestamp(run_ts).alias("updated_at")]


def _renamed(**names: str) -> list[Column]:
    """target=source pairs."""
    return [F.col(source).alias(target) for target, source in names.items()]


def _typed(target: str, source: str, type_name: str) -> Column:
    return F.col(source).try_cast(type_name).alias(target)


def _decimal(raw: DataFrame, name: str, precision: int, scale: int) -> Column:
    """try_cast to a decimal. It raises and drops an error for each value beyond the range, which costs more than
    all else that is done to a line; where amounts are numbers, those that cannot fit are told by comparison."""
    column = F.col(name)
    if isinstance(raw.schema[name].dataType, NumericType):
        limit = F.lit(Decimal(10) ** (precision - scale))
        column = F.when((column > -limit) & (column < limit), column)
    return column.try_cast(f"decimal({precision},{scale})").alias(name)


# Source and target column names of the following layouts.


def customers(raw: DataFrame, run_ts: datetime, carry: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        _typed("customer_id", "CustomerID", "int"),
        F.concat_ws(" ", "FirstName", "LastName").alias("customer_name"),
        *_renamed(email="EmailAddress", phone="Phone", region="City"),
        null_if_not_digits(F.col("PostalCode")).alias("postal_code"),
        *_renamed(country="CountryRegion", company_name="CompanyName", address_line="AddressLine1"),
        *validity(run_ts),
        *load_times(run_ts),
        *carry,
    )


def products(raw: DataFrame, run_ts: datetime, carry: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        _typed("product_id", "ProductID", "int"),
        *_renamed(product_name="Name"),
        null_if_not_digits(F.col("ProductNumber")).try_cast("int").alias("product_number"),
        *_renamed(category="ProductCategoryID", sub_category="ProductModelID", color="Color", size="Size"),
        _typed("weight", "Weight", "double"),
        _typed("unit_price", "ListPrice", "double"),
        _typed("cost_price", "StandardCost", "double"),
        _typed("sell_start_date", "SellStartDate", "timestamp"),
        F.col("ThumbNailPhoto").cast("binary").alias("thumbnail_photo"),
        *_renamed(thumbnail_photo_file_name="ThumbnailPhotoFileName", rowguid="rowguid"),
        *validity(run_ts),
        *load_times(run_ts),
        *carry,
    )


def suppliers(raw: DataFrame, run_ts: datetime, carry: Sequence[str] = ()) -> DataFrame:
    """Keeps the created_at and updated_at of the file."""
    return raw.select(
        "supplier_id",
        "supplier_name",
        "contact_name",
        null_if_not_email(F.col("email")).alias("email"),
        "phone",
        "address",
        "city",
        "state",
        "country",
        "postal_code",
        "business_category",
        *validity(run_ts),
        "created_at",
        "updated_at",
        *carry,
    )


def warehouses(raw: DataFrame, run_ts: datetime, carry: Sequence[str] = ()) -> DataFrame:
    """Keeps the created_at and updated_at of the file."""
    return raw.select(
        "warehouse_id",
        "warehouse_name",
        "location",
        "city",
        "state",
        "country",
        null_if_not_digits(F.col("postal_code")).try_cast("int").alias("postal_code"),
        _typed("capacity", "capacity", "int"),
        *validity(run_ts),
        "created_at",
        "updated_at",
        *carry,
    )


def sale_orders(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Order lines; amounts beyond their decimal range become NULL and so fail the rules."""
    return raw.select(
        "salesordernumber",
        null_if_not_digits(F.col("salesorderlinenumber")).alias("salesorderlinenumber"),
        "ordertype",
        _typed("quantity", "quantity", "int"),
        _decimal(raw, "taxamount", 7, 4),
        _decimal(raw, "unitprice", 8, 4),
        _typed("customer_id", "customer_id", "int"),
        _typed("product_id", "product_id", "int"),
        "createddate",
        "processeddate",
        "supplier_id",
        "warehouse_id",
        "year",
        "month",
        "day",
        *carry,
    )
