"""Text helpers for the oracle statements, and the layers as SQL."""

from __future__ import annotations

from collections.abc import Sequence

from saleslayers import schemas
from saleslayers.catalog.mapping import RAW, RUN_TS_SQL
from saleslayers.plans.bronze import RAW_TABLES
from saleslayers.plans.silver import FACT_COPY_KEYS

NON_DIGIT = "[^0-9]"
EMAIL_ADDRESS = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

FACT_COLUMNS = schemas.FACT_SALE_ORDERS.fieldNames()


def with_(select: str, **ctes: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({body})" for name, body in ctes.items()) + f" {select}"


def columns(names: Sequence[str], prefix: str = "") -> str:
    return ", ".join(f'{prefix}"{n}"' for n in names)


def latest(source: str, names: Sequence[str], keys: Sequence[str], order_by: Sequence[str]) -> str:
    """The newest row per key; ties by all other columns, by name."""
    order = [*order_by, *sorted(set(names) - set(keys) - set(order_by))]
    ordering = ", ".join(f'"{c}" DESC NULLS LAST' for c in order)
    return (
        f"SELECT {columns(names)} FROM (SELECT {columns(names)}, "
        f"row_number() OVER (PARTITION BY {columns(keys)} ORDER BY {ordering}) AS rn FROM {source}) WHERE rn = 1"
    )


def raw_sql(name: str) -> str:
    return RAW[name][1].strip()


def bronze_columns(name: str) -> list[str]:
    parts = ["year", "month", "day"] if RAW_TABLES[name].date_column else []
    return [*RAW_TABLES[name].schema.fieldNames(), *parts, "ingestion_timestamp"]


def bronze_from(source: str, name: str, stamp: str = RUN_TS_SQL) -> str:
    """One load of the rows of `source` into the raw table."""
    rule = RAW_TABLES[name]
    names = rule.schema.fieldNames()
    required = " AND ".join(f'"{c}" IS NOT NULL' for c in rule.required)
    kept = latest(f"(SELECT * FROM {source} WHERE {required})", names, rule.keys, rule.order_by)
    parts = ""
    if rule.date_column:
        c = rule.date_column
        parts = ", ".join(f"CAST({p}({c}) AS INTEGER) AS {p}" for p in ("year", "month", "day")) + ", "
    return f"SELECT {columns(names)}, {parts}{stamp} AS ingestion_timestamp FROM ({kept})"


def bronze_sql(name: str) -> str:
    return bronze_from(f"({raw_sql(name)})", name)


def validity_sql(stamp: str, load_times: bool) -> str:
    times = f"{stamp} AS created_at, {stamp} AS updated_at" if load_times else "created_at, updated_at"
    return f"{stamp} AS start_date, CAST(NULL AS TIMESTAMP) AS end_date, TRUE AS is_current, {times}"


def digits_sql(name: str) -> str:
    return f"CASE WHEN regexp_matches(CAST({name} AS VARCHAR), '{NON_DIGIT}') THEN NULL ELSE {name} END"


def conform_sql(name: str, source: str, stamp: str = RUN_TS_SQL) -> str:
    """Conformed dimension rows of a raw table."""
    select = {
        "customers": f"""SELECT TRY_CAST("CustomerID" AS INTEGER) AS customer_id,
            concat_ws(' ', "FirstName", "LastName") AS customer_name, "EmailAddress" AS email, "Phone" AS phone,
            "City" AS region, {digits_sql('"PostalCode"')} AS postal_code, "CountryRegion" AS country,
            "CompanyName" AS company_name, "AddressLine1" AS address_line, {validity_sql(stamp, True)}""",
        "products": f"""SELECT "ProductID" AS product_id, "Name" AS product_name,
            TRY_CAST({digits_sql('"ProductNumber"')} AS INTEGER) AS product_number,
            "ProductCategoryID" AS category, "ProductModelID" AS sub_category, "Color" AS color, "Size" AS size,
            CAST("Weight" AS DOUBLE) AS weight, CAST("ListPrice" AS DOUBLE) AS unit_price,
            CAST("StandardCost" AS DOUBLE) AS cost_price, "SellStartDate" AS sell_start_date,
            CAST("ThumbNailPhoto" AS BLOB) AS thumbnail_photo, "ThumbnailPhotoFileName" AS thumbnail_photo_file_name,
            rowguid, {validity_sql(stamp, True)}""",
        "suppliers": f"""SELECT supplier_id, supplier_name, contact_name,
            CASE WHEN regexp_matches(email, '{EMAIL_ADDRESS}') THEN email END AS email, phone, address, city, state,
            country, postal_code, business_category, {validity_sql(stamp, False)}""",
        "warehouses": f"""SELECT warehouse_id, warehouse_name, location, city, state, country,
            TRY_CAST({digits_sql('postal_code')} AS INTEGER) AS postal_code,
            TRY_CAST(capacity AS INTEGER) AS capacity, {validity_sql(stamp, False)}""",
    }[name]
    return f"{select} FROM {source}"


def dimension_sql(name: str) -> str:
    """Current rows after one load. The raw keys of the test tables stay distinct when conformed."""
    return conform_sql(name, f"({bronze_sql(name)})")


def lines_sql(source: str) -> str:
    """Conformed order lines of a raw table."""
    return f"""SELECT salesordernumber, {digits_sql('salesorderlinenumber')} AS salesorderlinenumber, ordertype,
        TRY_CAST(quantity AS INTEGER) AS quantity, TRY_CAST(taxamount AS DECIMAL(7,4)) AS taxamount,
        TRY_CAST(unitprice AS DECIMAL(8,4)) AS unitprice, TRY_CAST(customer_id AS INTEGER) AS customer_id,
        TRY_CAST(product_id AS INTEGER) AS product_id, createddate, processeddate, supplier_id, warehouse_id,
        year, month, day FROM {source}"""


def labelled_sql(source: str) -> str:
    return f"""SELECT *, CASE WHEN error_description = 'Valid' THEN 0 ELSE 1 END AS error_flag FROM (
        SELECT *, CASE
            WHEN quantity IS NULL OR quantity < 0 THEN 'Invalid quantity'
            WHEN taxamount IS NULL OR taxamount < 0 THEN 'Invalid tax amount'
            WHEN unitprice IS NULL OR unitprice < 0 THEN 'Invalid unit price'
            WHEN customer_id IS NULL THEN 'Missing customer ID'
            WHEN product_id IS NULL THEN 'Missing product ID'
            WHEN supplier_id IS NULL THEN 'Missing supplier ID'
            WHEN warehouse_id IS NULL THEN 'Missing warehouse ID'
            WHEN createddate IS NULL OR processeddate IS NULL THEN 'Missing date'
            WHEN processeddate < createddate THEN 'Invalid date order'
            ELSE 'Valid' END AS error_description FROM ({source}))"""


def labelled_lines_sql() -> str:
    return labelled_sql(lines_sql(f"({bronze_sql('sale_orders')})"))


def fact_sql(where: str = "TRUE") -> str:
    """The fact table after one load of the raw order lines that meet a condition."""
    valid = f"(SELECT * FROM ({labelled_lines_sql()}) WHERE error_flag = 0 AND {where})"
    return latest(valid, FACT_COLUMNS, FACT_COPY_KEYS, ["processeddate"])
