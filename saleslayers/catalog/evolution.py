"""Conforming to a schema and evolving a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslayers import schemas
from saleslayers.catalog.base import Query, bronze_table
from saleslayers.catalog.mapping import RUN_TS, table
from saleslayers.catalog.sql import bronze_columns, bronze_sql
from saleslayers.operators.evolve import Evolved, Migration, evolve, ledger_rows, pending
from saleslayers.operators.rows import conform_to
from saleslayers.plans import migrations
from saleslayers.session import scratch_path

PRODUCT_COLUMNS = bronze_columns("products")
PRODUCTS_FROM = f"FROM ({bronze_sql('products')})"


def _evolved(*steps):
    return lambda spark, d: evolve(bronze_table(spark, d, "products"), steps).df


def _select(**changes: str | None) -> str:
    """All columns of the raw products, some of them computed, dropped (None) or added."""
    kept = [
        f'{changes[c]} AS "{c}"' if changes.get(c) else f'"{c}"'
        for c in PRODUCT_COLUMNS
        if c not in changes or changes[c] is not None
    ]
    added = [f'{e} AS "{c}"' for c, e in changes.items() if c not in PRODUCT_COLUMNS]
    return f"SELECT {', '.join(kept + added)} {PRODUCTS_FROM}"


CHAIN = (
    {"action": "add_column", "name": "loyalty_score", "type": "INT"},
    {"action": "drop_column", "name": "rowguid"},
    {"action": "rename_column", "old_name": "Name", "new_name": "product_name"},
    {"action": "update_column_type", "name": "ProductID", "new_type": "BIGINT"},
    {"action": "update_column_type", "name": "Weight", "new_type": "DECIMAL(12,4)"},
    {"action": "set_tblproperties", "properties": {"write.format.default": "parquet"}},
    {"action": "update_partition", "partitioned_by": ["ProductCategoryID"]},
)


def conform_to_schema(spark, sf_dir):
    """Raw order lines in the layout of the fact table: types narrowed, other columns left out."""
    return conform_to(bronze_table(spark, sf_dir, "sale_orders"), schemas.FACT_SALE_ORDERS)


def evolve_repartition(spark, sf_dir):
    """Written with a new partitioning and read back."""
    step = {"action": "update_partition", "partitioned_by": ["ProductCategoryID"]}
    path = scratch_path(spark, "evolve-repartition")
    evolve(bronze_table(spark, sf_dir, "products"), [step]).write(path)
    return spark.read.parquet(path)


def evolve_chain(spark, sf_dir):
    path = scratch_path(spark, "evolve-chain")
    evolve(Evolved(bronze_table(spark, sf_dir, "products"), location=path), CHAIN).write()
    return spark.read.parquet(path)


def migrations_applied(spark, sf_dir):
    """A stored table through two migrations in two runs; the second run has one of them and a third, and a
    further run changes nothing."""
    root = scratch_path(spark, "migrations")
    migrations.store(Evolved(bronze_table(spark, sf_dir, "products")), f"{root}/tables/products")
    kinds = {True: [], False: []}
    for step in CHAIN:
        kinds[step["action"] in migrations.SCHEMA_ONLY].append(step)
    light = Migration("bronze", "001_columns", "products", {"type": "alter", "alterations": kinds[True]})
    heavy = Migration("bronze", "002_layout", "products", {"type": "alter", "alterations": kinds[False]})
    migrations.run_migrations(spark, root, [light], RUN_TS)
    for _ in range(2):
        migrations.run_migrations(spark, root, [heavy, light], RUN_TS)
    return migrations.read_table(spark, root, "products")


def migrations_pending(spark, sf_dir):
    """One step per product type and brand, named after them; one type is not recorded yet."""
    steps = table(spark, sf_dir, "part").select(
        "p_type", F.concat(F.lit("silver/"), F.col("p_type"), F.lit("_"), F.col("p_brand")).alias("filename")
    ).distinct()
    recorded = steps.filter(F.col("p_type") != "ECONOMY")
    return pending(steps.select("filename"), ledger_rows(recorded, RUN_TS))


QUERIES = {
    "conform_to_schema": Query(
        conform_to_schema,
        f"""SELECT salesordernumber, salesorderlinenumber, ordertype, quantity,
            TRY_CAST(taxamount AS DECIMAL(7,4)) AS taxamount, TRY_CAST(unitprice AS DECIMAL(8,4)) AS unitprice,
            TRY_CAST(customer_id AS INTEGER) AS customer_id, TRY_CAST(product_id AS INTEGER) AS product_id,
            createddate, processeddate, supplier_id, warehouse_id, year, month, day
            FROM ({bronze_sql('sale_orders')})""",
    ),
    "evolve_add_column": Query(
        _evolved({"action": "add_column", "name": "loyalty_score", "type": "INT"}),
        _select(loyalty_score="CAST(NULL AS INTEGER)"),
    ),
    "evolve_drop_column": Query(_evolved({"action": "drop_column", "name": "rowguid"}), _select(rowguid=None)),
    "evolve_rename_column": Query(
        _evolved({"action": "rename_column", "old_name": "Name", "new_name": "product_name"}),
        _select(Name=None, product_name='"Name"'),
    ),
    "evolve_widen_type": Query(
        _evolved({"action": "update_column_type", "name": "ProductID", "new_type": "BIGINT"}),
        _select(ProductID='CAST("ProductID" AS BIGINT)'),
    ),
    "evolve_repartition": Query(evolve_repartition, _select()),
    "evolve_chain": Query(
        evolve_chain,
        _select(
            rowguid=None,
            Name=None,
            ProductID='CAST("ProductID" AS BIGINT)',
            Weight='CAST("Weight" AS DECIMAL(12,4))',
            loyalty_score="CAST(NULL AS INTEGER)",
            product_name='"Name"',
        ),
    ),
    "migrations_applied": Query(
        migrations_applied,
        _select(
            rowguid=None,
            Name=None,
            ProductID='CAST("ProductID" AS BIGINT)',
            Weight='CAST("Weight" AS DECIMAL(12,4))',
            loyalty_score="CAST(NULL AS INTEGER)",
            product_name='"Name"',
        ),
    ),
    "migrations_pending": Query(
        migrations_pending,
        "SELECT DISTINCT 'silver/' || p_type || '_' || p_brand AS filename FROM part WHERE p_type = 'ECONOMY'",
    ),
}
