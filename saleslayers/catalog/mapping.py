"""The five kinds of raw rows, derived from the star-schema tables of a data folder.

Each is written twice: as a DataFrame and as SQL text for the oracle. Some keys get NULL or
malformed values on purpose, so the cleaning and quality rules have work to do; every
table is used whole.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_TS = datetime(2025, 1, 1, tzinfo=timezone.utc)
RUN_TS_SQL = "TIMESTAMP '2025-01-01 00:00:00'"
SECOND_TS = datetime(2025, 2, 1, tzinfo=timezone.utc)
SECOND_TS_SQL = "TIMESTAMP '2025-02-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _padded(prefix: str, name: str, width: int) -> Column:
    # Pads to at least `width`: longer keys stay whole, so they stay distinct.
    digits = _text(name)
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").join(
        _places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return rows.select(
        F.lit("Customer").alias("FirstName"),
        F.substr("c_name", F.lit(10)).alias("LastName"),
        F.col("c_mktsegment").alias("CompanyName"),
        F.when(key % 13 != 0, F.concat(F.lit("c"), _text("c_custkey"), F.lit("@example.com"))).alias("EmailAddress"),
        _padded("555-", "c_custkey", 7).alias("Phone"),
        _text("c_custkey").alias("CustomerID"),
        F.col("c_name").alias("AddressLine1"),
        F.col("r_name").alias("City"),
        F.col("n_name").alias("CountryRegion"),
        F.when(key % 5 == 0, F.concat(F.lit("AB"), _text("c_custkey")))
        .otherwise(_padded("", "c_custkey", 5))
        .alias("PostalCode"),
    )


CUSTOMERS_SQL = """
SELECT 'Customer' AS "FirstName",
  substr(c_name, 10) AS "LastName",
  c_mktsegment AS "CompanyName",
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'c' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS "EmailAddress",
  '555-' || lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(length(CAST(c_custkey AS VARCHAR)), 7) AS INTEGER), '0') AS "Phone",
  CAST(c_custkey AS VARCHAR) AS "CustomerID",
  c_name AS "AddressLine1",
  r_name AS "City",
  n_name AS "CountryRegion",
  CASE WHEN c_custkey % 5 = 0 THEN 'AB' || CAST(c_custkey AS VARCHAR)
    ELSE lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(length(CAST(c_custkey AS VARCHAR)), 5) AS INTEGER), '0') END AS "PostalCode"
FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(10,2)")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("ProductID"),
        F.col("p_name").alias("Name"),
        F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("FR-"), _text("p_partkey")))
        .otherwise(_text("p_partkey"))
        .alias("ProductNumber"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("Color"),
        (price - 100).cast("decimal(10,2)").alias("StandardCost"),
        price.alias("ListPrice"),
        _text("p_size").alias("Size"),
        F.col("p_size").cast("decimal(10,2)").alias("Weight"),
        F.substr("p_brand", F.lit(7)).cast("int").alias("ProductCategoryID"),
        F.col("p_size").alias("ProductModelID"),
        F.to_timestamp(F.lit("1995-01-01 00:00:00")).alias("SellStartDate"),
        F.lit(None).cast("string").alias("ThumbNailPhoto"),
        F.col("p_type").alias("ThumbnailPhotoFileName"),
        F.concat(F.lit("guid-"), _text("p_partkey")).alias("rowguid"),
    )


PRODUCTS_SQL = """
SELECT CAST(p_partkey AS INTEGER) AS "ProductID",
  p_name AS "Name",
  CASE WHEN p_partkey % 4 = 0 THEN 'FR-' || CAST(p_partkey AS VARCHAR) ELSE CAST(p_partkey AS VARCHAR) END
    AS "ProductNumber",
  split_part(p_name, ' ', 1) AS "Color",
  CAST(CAST(p_retailprice AS DECIMAL(10,2)) - 100 AS DECIMAL(10,2)) AS "StandardCost",
  CAST(p_retailprice AS DECIMAL(10,2)) AS "ListPrice",
  CAST(p_size AS VARCHAR) AS "Size",
  CAST(p_size AS DECIMAL(10,2)) AS "Weight",
  CAST(substr(p_brand, 7) AS INTEGER) AS "ProductCategoryID",
  p_size AS "ProductModelID",
  TIMESTAMP '1995-01-01 00:00:00' AS "SellStartDate",
  CAST(NULL AS VARCHAR) AS "ThumbNailPhoto",
  p_type AS "ThumbnailPhotoFileName",
  'guid-' || CAST(p_partkey AS VARCHAR) AS "rowguid"
FROM part
"""


def _opening() -> Column:
    return F.to_timestamp(F.lit("1995-01-01 00:00:00"))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").join(
        _places(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )
    return rows.select(
        _padded("SUP", "s_suppkey", 4).alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.col("s_name").alias("contact_name"),
        F.when(F.col("s_suppkey") % 6 == 0, "bad-address")
        .otherwise(F.concat(F.lit("s"), _text("s_suppkey"), F.lit("@example.com")))
        .alias("email"),
        _padded("556-", "s_suppkey", 7).alias("phone"),
        F.col("n_name").alias("address"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.col("n_name").alias("country"),
        _padded("", "s_suppkey", 5).alias("postal_code"),
        F.col("r_name").alias("business_category"),
        _opening().alias("created_at"),
        _opening().alias("updated_at"),
    )


SUPPLIERS_SQL = """
SELECT 'SUP' || lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(length(CAST(s_suppkey AS VARCHAR)), 4) AS INTEGER), '0') AS supplier_id,
  s_name AS supplier_name,
  s_name AS contact_name,
  CASE WHEN s_suppkey % 6 = 0 THEN 'bad-address' ELSE 's' || CAST(s_suppkey AS VARCHAR) || '@example.com' END AS email,
  '556-' || lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(length(CAST(s_suppkey AS VARCHAR)), 7) AS INTEGER), '0') AS phone,
  n_name AS address,
  n_name AS city,
  r_name AS state,
  n_name AS country,
  lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(length(CAST(s_suppkey AS VARCHAR)), 5) AS INTEGER), '0') AS postal_code,
  r_name AS business_category,
  TIMESTAMP '1995-01-01 00:00:00' AS created_at,
  TIMESTAMP '1995-01-01 00:00:00' AS updated_at
FROM supplier
  LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
"""


def warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(spark, sf_dir).select(
        _padded("WH", "n_nationkey", 3).alias("warehouse_id"),
        F.col("n_name").alias("warehouse_name"),
        F.col("r_name").alias("location"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.col("n_name").alias("country"),
        F.when(F.col("n_nationkey") % 7 == 0, "X1").otherwise(_padded("", "n_nationkey", 5)).alias("postal_code"),
        (100 * (F.col("n_nationkey") + 1)).cast("string").alias("capacity"),
        _opening().alias("created_at"),
        _opening().alias("updated_at"),
    )


WAREHOUSES_SQL = """
SELECT 'WH' || lpad(CAST(n_nationkey AS VARCHAR), CAST(greatest(length(CAST(n_nationkey AS VARCHAR)), 3) AS INTEGER), '0') AS warehouse_id,
  n_name AS warehouse_name,
  r_name AS location,
  n_name AS city,
  r_name AS state,
  n_name AS country,
  CASE WHEN n_nationkey % 7 = 0 THEN 'X1' ELSE lpad(CAST(n_nationkey AS VARCHAR), CAST(greatest(length(CAST(n_nationkey AS VARCHAR)), 5) AS INTEGER), '0') END AS postal_code,
  CAST(100 * (n_nationkey + 1) AS VARCHAR) AS capacity,
  TIMESTAMP '1995-01-01 00:00:00' AS created_at,
  TIMESTAMP '1995-01-01 00:00:00' AS updated_at
FROM nation
  LEFT JOIN region ON n_regionkey = r_regionkey
"""


def _order_number(key: str) -> Column:
    return F.concat(F.lit("SO"), _text(key)).alias("salesordernumber")


def sale_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Lines meet their order last and by its number: they then lie where the latest line per number is chosen,
    # and are not shuffled again for it.
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part").withColumn("p_retailprice", F.col("p_retailprice").cast("decimal(12,2)")), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    rows = lines.select("*", _order_number("l_orderkey")).join(table(spark, sf_dir, "orders").select("*", _order_number("o_orderkey")), "salesordernumber")
    return rows.select(
        "salesordernumber",
        F.col("l_linenumber").alias("salesorderlinenumber"),
        F.col("o_orderdate").cast("timestamp").alias("createddate"),
        F.col("l_shipdate").cast("timestamp").alias("processeddate"),
        F.col("o_orderstatus").alias("ordertype"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").alias("unitprice"),
        (F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(4,2)")).alias("taxamount"),
        _text("o_custkey").alias("customer_id"),
        _text("l_partkey").alias("product_id"),
        _padded("SUP", "l_suppkey", 4).alias("supplier_id"),
        _padded("WH", "s_nationkey", 3).alias("warehouse_id"),
    )


SALE_ORDERS_SQL = """
SELECT 'SO' || CAST(l_orderkey AS VARCHAR) AS salesordernumber,
  l_linenumber AS salesorderlinenumber,
  o_orderdate AS createddate,
  l_shipdate AS processeddate,
  o_orderstatus AS ordertype,
  CAST(l_quantity AS INTEGER) AS quantity,
  CAST(p_retailprice AS DECIMAL(12,2)) AS unitprice,
  CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS taxamount,
  CAST(o_custkey AS VARCHAR) AS customer_id,
  CAST(l_partkey AS VARCHAR) AS product_id,
  'SUP' || lpad(CAST(l_suppkey AS VARCHAR), CAST(greatest(length(CAST(l_suppkey AS VARCHAR)), 4) AS INTEGER), '0') AS supplier_id,
  'WH' || lpad(CAST(s_nationkey AS VARCHAR), CAST(greatest(length(CAST(s_nationkey AS VARCHAR)), 3) AS INTEGER), '0') AS warehouse_id
FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
"""

RAW = {
    "sale_orders": (sale_orders, SALE_ORDERS_SQL),
    "customers": (customers, CUSTOMERS_SQL),
    "products": (products, PRODUCTS_SQL),
    "suppliers": (suppliers, SUPPLIERS_SQL),
    "warehouses": (warehouses, WAREHOUSES_SQL),
}
