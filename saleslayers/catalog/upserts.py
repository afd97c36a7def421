"""Merges and history-keeping dimensions, each from a first and a second load."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslayers.catalog.base import Query, bronze_table, labelled, raw
from saleslayers.catalog.mapping import RUN_TS, SECOND_TS, SECOND_TS_SQL
from saleslayers.catalog.sql import (
    FACT_COLUMNS,
    bronze_from,
    bronze_sql,
    columns,
    conform_sql,
    fact_sql,
    labelled_lines_sql,
    lines_sql,
    raw_sql,
    with_,
)
from saleslayers.operators import conform
from saleslayers.operators.history import apply_history
from saleslayers.operators.merge import merge
from saleslayers.plans import bronze, silver
from saleslayers.plans.silver import FACT_KEYS
from saleslayers.session import scratch_path
from saleslayers.sinks.dimensions import compact_history, drop_old_current_rows, read_current, read_history, write_dimension

# --- merges: order lines created before July 1998, then a second load that starts in January
# --- 1998, with a new quantity on every line. Together the loads cover all lines.

FIRST_END = "1998-07-01"
SECOND_START = "1998-01-01"

VALUES = [c for c in FACT_COLUMNS if c not in FACT_KEYS]
IN_FIRST = f"createddate < TIMESTAMP '{FIRST_END} 00:00:00'"
IN_SECOND = f"createddate >= TIMESTAMP '{SECOND_START} 00:00:00'"


def _first(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("createddate") < FIRST_END)


def _second(lines: DataFrame, quantity: Column) -> DataFrame:
    return lines.filter(F.col("createddate") >= SECOND_START).withColumn("quantity", quantity)


def _lines(spark, sf_dir) -> DataFrame:
    return conform.sale_orders(bronze_table(spark, sf_dir, "sale_orders"))


LINES_SQL = lines_sql(f"({bronze_sql('sale_orders')})")


def merge_upsert(spark, sf_dir) -> DataFrame:
    lines = _lines(spark, sf_dir)
    return merge(_first(lines), _second(lines, F.col("quantity") + 1), FACT_KEYS, set=VALUES, unique_target=True)


def merge_conditional(spark, sf_dir) -> DataFrame:
    lines = _lines(spark, sf_dir)
    return merge(
        _first(lines),
        _second(lines, 51 - F.col("quantity")),
        FACT_KEYS,
        set={"quantity": "src.quantity", "ordertype": F.concat(F.col("tgt.ordertype"), F.lit("*"))},
        when=F.col("src.quantity") > F.col("tgt.quantity"),
    )


def merge_insert_columns(spark, sf_dir) -> DataFrame:
    """Known lines stay; new ones come without the helper columns and without an order type."""
    lines = labelled(spark, sf_dir)
    return merge(
        _first(lines).select(*FACT_COLUMNS),
        _second(lines, F.col("quantity") + 1),
        FACT_KEYS,
        insert=[c for c in FACT_COLUMNS if c != "ordertype"],
    )


def fact_any_batching(spark, sf_dir) -> DataFrame:
    """Two loads consumed by one batch. The second repeats lines, some of them with a bad quantity: these are
    rejected and the first load's lines stay, as if the loads had come one after the other."""
    rows = raw(spark, sf_dir, "sale_orders")
    bad = F.col("customer_id").cast("int") % 5 == 0
    again = _second(rows, F.when(bad, -5).otherwise(F.col("quantity") + 1))
    table = bronze.RAW_TABLES["sale_orders"]
    both = bronze.ingest(_first(rows), table, RUN_TS).unionByName(bronze.ingest(again, table, SECOND_TS))
    return silver.fact_batch(silver.labelled_lines(both))


def _replaced(**changes: str) -> str:
    return ", ".join(f'{changes[c]} AS "{c}"' if c in changes else f'"{c}"' for c in FACT_COLUMNS)


BOTH = f"({IN_FIRST} AND {IN_SECOND})"
GROWS = f"({BOTH} AND 51 - quantity > quantity)"

MERGES = {
    "merge_upsert": Query(
        merge_upsert,
        f"SELECT {_replaced(quantity=f'CASE WHEN {IN_SECOND} THEN quantity + 1 ELSE quantity END')} FROM ({LINES_SQL})",
    ),
    "merge_conditional": Query(
        merge_conditional,
        "SELECT "
        + _replaced(
            quantity=f"CASE WHEN {GROWS} OR NOT {IN_FIRST} THEN 51 - quantity ELSE quantity END",
            ordertype=f"CASE WHEN {GROWS} THEN ordertype || '*' ELSE ordertype END",
        )
        + f" FROM ({LINES_SQL})",
    ),
    "merge_insert_columns": Query(
        merge_insert_columns,
        "SELECT "
        + _replaced(
            quantity=f"CASE WHEN {IN_FIRST} THEN quantity ELSE quantity + 1 END",
            ordertype=f"CASE WHEN {IN_FIRST} THEN ordertype END",
        )
        + f" FROM ({labelled_lines_sql()})",
    ),
}

# --- dimensions: a first load without one group of rows, then a load of all rows in which
# --- some tracked and some untracked columns have new values.


@dataclass(frozen=True)
class TwoLoads:
    """The same two loads as conditions and values, for Spark and for SQL."""

    absent_at_first: str
    changes: dict[str, str]


LOADS = {
    # Asian customers get a new phone (tracked), European ones a new address (not tracked).
    "customers": TwoLoads(
        "\"CompanyName\" = 'BUILDING'",
        {
            "Phone": "CASE WHEN \"City\" = 'ASIA' THEN '777' || \"Phone\" ELSE \"Phone\" END",
            "AddressLine1": "CASE WHEN \"City\" = 'EUROPE' THEN 'New ' || \"AddressLine1\" ELSE \"AddressLine1\" END",
        },
    ),
    # Red products get dearer (tracked), blue ones another size (not tracked).
    "products": TwoLoads(
        "\"ThumbnailPhotoFileName\" = 'ECONOMY'",
        {
            "ListPrice": "CAST(\"ListPrice\" + CASE WHEN \"Color\" = 'red' THEN 10 ELSE 0 END AS DECIMAL(10,2))",
            "Size": "CASE WHEN \"Color\" = 'blue' THEN 'XL' ELSE \"Size\" END",
        },
    ),
    # Malformed addresses, NULL in the dimension, are put right; one region gets a new contact.
    "suppliers": TwoLoads(
        "state = 'AFRICA'",
        {
            "email": "CASE WHEN email = 'bad-address' THEN 'info@example.com' ELSE email END",
            "contact_name": "CASE WHEN state = 'ASIA' THEN 'Sales ' || contact_name ELSE contact_name END",
        },
    ),
    # American warehouses move (tracked), Asian ones grow (not tracked).
    "warehouses": TwoLoads(
        "state = 'AFRICA'",
        {
            "location": "CASE WHEN state = 'AMERICA' THEN 'Dock ' || location ELSE location END",
            "capacity": "CASE WHEN state = 'ASIA' THEN '5000' ELSE capacity END",
        },
    ),
}


def _spark_text(text: str) -> str:
    return text.replace('"', "`")


def _history_query(name: str) -> Query:
    loads = LOADS[name]
    raw_table = bronze.RAW_TABLES[name]
    plan = silver.DIMENSIONS[f"dim_{name}"]
    rule = plan.rule

    def run(spark, sf_dir) -> DataFrame:
        rows = raw(spark, sf_dir, name)
        first = rows.filter(~F.expr(_spark_text(loads.absent_at_first)))
        second = rows.withColumns({c: F.expr(_spark_text(e)) for c, e in loads.changes.items()})
        empty = spark.createDataFrame([], plan.schema)
        opened = silver.refresh_dimension(empty, bronze.ingest(first, raw_table, RUN_TS), plan, RUN_TS)
        return silver.refresh_dimension(opened, bronze.ingest(second, raw_table, SECOND_TS), plan, SECOND_TS)

    names = raw_table.schema.fieldNames()
    changed = ", ".join(f'{loads.changes[c]} AS "{c}"' if c in loads.changes else f'"{c}"' for c in names)
    output = plan.schema.fieldNames()
    closing = {"end_date": SECOND_TS_SQL, "is_current": "FALSE"}
    if rule.closing_sets_updated_at:
        closing["updated_at"] = SECOND_TS_SQL
    closed = ", ".join(f"{closing[c]} AS {c}" if c in closing else f'o."{c}"' for c in output)
    differs = " OR ".join(f'o."{c}" IS DISTINCT FROM n."{c}"' for c in rule.tracked)
    same_key = f'o."{rule.key}" = n."{rule.key}"'
    sql = with_(
        f"""SELECT {columns(output, "o.")} FROM o LEFT JOIN n ON {same_key} WHERE n."{rule.key}" IS NULL OR NOT ({differs})
        UNION ALL SELECT {closed} FROM o JOIN n ON {same_key} WHERE {differs}
        UNION ALL SELECT {columns(output, "n.")} FROM n LEFT JOIN o ON {same_key}
            WHERE o."{rule.key}" IS NULL OR {differs}""",
        all_rows=raw_sql(name),
        first_rows=f"SELECT * FROM all_rows WHERE NOT ({loads.absent_at_first})",
        second_rows=f"SELECT {changed} FROM all_rows",
        o=conform_sql(name, f"({bronze_from('first_rows', name)})"),
        n=conform_sql(name, f"({bronze_from('second_rows', name, SECOND_TS_SQL)})", SECOND_TS_SQL),
    )
    return Query(run, sql)


def scd2_stored_customers(spark, sf_dir) -> DataFrame:
    """The customers' two loads as a stored dimension, the second repeated until its closed rows are in merged parts."""
    loads, plan, raw_table = LOADS["customers"], silver.DIMENSIONS["dim_customers"], bronze.RAW_TABLES["customers"]
    root, rows = scratch_path(spark, "stored-customers"), raw(spark, sf_dir, "customers")
    first = rows.filter(~F.expr(_spark_text(loads.absent_at_first)))
    second = rows.withColumns({c: F.expr(_spark_text(e)) for c, e in loads.changes.items()})
    for part, run_ts in [(first, RUN_TS)] + [(second, SECOND_TS)] * 5:
        batch = silver.dimension_batch(bronze.ingest(part, raw_table, run_ts), plan, run_ts)
        after = apply_history(read_current(spark, root, plan.schema), batch, plan.rule, run_ts, check_unique=False, only_current=True)
        write_dimension(after, root)
        drop_old_current_rows(spark, root)
        compact_history(spark, root, plan.schema, at_once=2)
    return read_history(spark, root, plan.schema)


BATCHING = {
    "scd2_stored_customers": Query(scd2_stored_customers, _history_query("customers").sql),
    "fact_any_batching": Query(
        fact_any_batching,
        f"""SELECT * REPLACE (CASE WHEN {IN_SECOND} AND customer_id % 5 <> 0 THEN quantity + 1 ELSE quantity END AS quantity)
            FROM ({fact_sql()}) WHERE {IN_FIRST} OR customer_id % 5 <> 0""",
    )
}

QUERIES = {**MERGES, **BATCHING, **{f"scd2_{name}": _history_query(name) for name in LOADS}}
