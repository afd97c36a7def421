"""Star joins, reports and their refresh."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from saleslayers.catalog.base import Query, StarOf, raw
from saleslayers.catalog.drops import Drops, in_rounds, write_csv
from saleslayers.catalog.mapping import RUN_TS, RUN_TS_SQL, SECOND_TS, SECOND_TS_SQL
from saleslayers.catalog.sql import FACT_COLUMNS, columns, dimension_sql, fact_sql, with_
from saleslayers.catalog.upserts import FIRST_END, IN_FIRST, IN_SECOND, SECOND_START
from saleslayers.plans import distinct, gold, incremental
from saleslayers.plans.gold import REPORTS
from saleslayers.plans.jobs import (
    Layout,
    load_dimension,
    load_fact,
    load_raw,
    read_star,
    refresh_report_table,
)
from saleslayers.session import scratch_path
from saleslayers.sinks.bucketed import drop_tables
from saleslayers.sinks.tables import append, materialise, written
from saleslayers.streaming import loads

AMOUNT = "CAST(sum(quantity * unitprice) AS DOUBLE) AS total_sales_amount"
QUANTITY = "CAST(sum(quantity) AS BIGINT) AS total_quantity_sold"
TAX = "CAST(sum(taxamount) AS DOUBLE) AS total_tax_collected"
ORDERS = "count(DISTINCT salesordernumber) AS total_orders"

CUTOFF = "1998-07-01"

BUCKETS = 16

BASE = {
    "fact": fact_sql(),
    "c": dimension_sql("customers"),
    "p": dimension_sql("products"),
    "s": dimension_sql("suppliers"),
    "w": dimension_sql("warehouses"),
}


def report_sql(name: str, source: str, stamp: str) -> str:
    """A report over a CTE of order lines."""
    if name == "sales_summary":
        return f"""SELECT customer_name, product_name, supplier_name, warehouse_name,
            CAST(createddate AS DATE) AS sale_date, {QUANTITY}, {AMOUNT}, {TAX}
            FROM {source} f LEFT JOIN c ON f.customer_id = c.customer_id LEFT JOIN p ON f.product_id = p.product_id
            LEFT JOIN s ON f.supplier_id = s.supplier_id LEFT JOIN w ON f.warehouse_id = w.warehouse_id
            GROUP BY 1, 2, 3, 4, 5"""
    if name == "by_country":
        return f"""SELECT country, {AMOUNT}, {QUANTITY}, {ORDERS}, {stamp} AS last_updated
            FROM {source} f LEFT JOIN c ON f.customer_id = c.customer_id GROUP BY country"""
    period = {
        "by_supplier_daily": "CAST(createddate AS DATE) AS sales_date",
        "by_supplier_monthly": "strftime(createddate, '%Y-%m') AS sales_month",
    }[name]
    return f"""SELECT {period}, s.supplier_id, s.supplier_name, {AMOUNT}, {QUANTITY}, {ORDERS}, {stamp} AS last_updated
        FROM {source} f LEFT JOIN s ON f.supplier_id = s.supplier_id GROUP BY 1, 2, 3"""


def report(name: str) -> Query:
    return Query(
        lambda spark, d: REPORTS[name].build(StarOf(spark, d), RUN_TS),
        with_(report_sql(name, "fact", RUN_TS_SQL), **BASE),
    )


def _refreshed_sql(rule: gold.Report) -> str:
    """The refreshed table from the CTEs n (the report now) and o (its earlier groups)."""
    same = " AND ".join(f'n."{k}" IS NOT DISTINCT FROM o."{k}"' for k in rule.keys)
    values = [c for c in rule.schema.fieldNames() if c not in ("created_at", "updated_at")]
    outputs = ", ".join(
        f'CAST(n."{c}" AS DOUBLE) AS "{c}"' if c == "total_quantity_sold" else f'n."{c}"' for c in values
    )
    return f"""SELECT {outputs},
        CASE WHEN o.seen THEN {RUN_TS_SQL} ELSE {SECOND_TS_SQL} END AS created_at, {SECOND_TS_SQL} AS updated_at
        FROM n LEFT JOIN o ON {same}"""


def refresh(name: str) -> Query:
    """A report table holding the lines before a date, refreshed from all lines."""
    rule = REPORTS[name]

    def run(spark, sf_dir):
        everything, before = StarOf(spark, sf_dir), StarOf(spark, sf_dir)
        root = scratch_path(spark, f"report-{name}")
        with written(everything.fact, scratch_path(spark, "lines")) as everything.fact:
            before.fact = everything.fact.filter(F.col("createddate") < CUTOFF)
            refresh_report_table(spark, root, rule, before, RUN_TS)
            return refresh_report_table(spark, root, rule, everything, SECOND_TS)

    return Query(
        run,
        with_(
            _refreshed_sql(rule),
            **BASE,
            earlier=f"SELECT * FROM fact WHERE createddate < TIMESTAMP '{CUTOFF} 00:00:00'",
            n=report_sql(name, "fact", SECOND_TS_SQL),
            o=f"SELECT *, TRUE AS seen FROM ({report_sql(name, 'earlier', RUN_TS_SQL)})",
        ),
    )


MOVED = {
    "c": ("customers", {"country": "CASE WHEN customer_id % 3 = 0 THEN 'New ' || country ELSE country END"}),
    "s": ("suppliers", {"supplier_name": "CASE WHEN phone LIKE '%3' THEN supplier_name || ' Ltd' ELSE supplier_name END"}),
}


def _moved_sql() -> dict[str, str]:
    changed = {}
    for short, (_, changes) in MOVED.items():
        replaced = ", ".join(f"{e} AS {c}" for c, e in changes.items())
        changed[f"{short}2"] = f"SELECT * REPLACE ({replaced}) FROM {short}"
    return changed


def refresh_moved(name: str) -> Query:
    """A report table refreshed after customers changed country and suppliers their name. Groups that no line
    belongs to any more are gone, so the report adds up to the fact table."""
    rule = REPORTS[name]

    def run(spark, sf_dir):
        before, after = StarOf(spark, sf_dir), StarOf(spark, sf_dir)
        for dimension, changes in MOVED.values():
            setattr(after, dimension, getattr(before, dimension).withColumns({c: F.expr(e) for c, e in changes.items()}))
        root = scratch_path(spark, f"moved-{name}")
        with written(before.fact, scratch_path(spark, "lines")) as lines:
            before.fact = after.fact = lines
            refresh_report_table(spark, root, rule, before, RUN_TS)
            return refresh_report_table(spark, root, rule, after, SECOND_TS)

    now = report_sql(name, "fact", SECOND_TS_SQL).replace("JOIN c ON", "JOIN c2 c ON").replace("JOIN s ON", "JOIN s2 s ON")
    return Query(
        run, with_(_refreshed_sql(rule), **BASE, **_moved_sql(), n=now, o=f"SELECT *, TRUE AS seen FROM ({report_sql(name, 'fact', RUN_TS_SQL)})")
    )


def kept_up(name: str) -> Query:
    """A report kept up by touched groups: lines until a date, then a second load with corrected and new lines, while
    customers changed country and suppliers their name. The same as a rebuild of everything."""
    rule, months = REPORTS[name], ("year", "month")

    def run(spark, sf_dir):
        base = scratch_path(spark, f"kept-up-{name}")
        tables = incremental.Tables(f"{base}/report", f"{base}/partial_sums", f"{base}/refreshes")
        source = StarOf(spark, sf_dir)
        lines = materialise(source.fact, f"{base}/lines")
        used = {n.table: materialise(getattr(source, n.table), f"{base}/{n.table}") for n in incremental.PLANS[name].names}
        moved = dict(used)
        for dimension, changes in MOVED.values():
            if dimension in used:
                moved[dimension] = used[dimension].withColumns({c: F.expr(e) for c, e in changes.items()})
        second = lines.filter(F.col("createddate") >= SECOND_START).withColumn("quantity", F.col("quantity") + 1)
        rounds = ((lines.filter(F.col("createddate") < FIRST_END), used, RUN_TS), (second, moved, SECOND_TS))
        for number, (batch, dimensions, run_ts) in enumerate(rounds):
            loads.write_fact(batch, f"{base}/fact", months, changes=f"{base}/changes", batch_id=number, stored=True)
            star = gold.Star(loads.read_fact(spark, f"{base}/fact"), *[dimensions.get(d) for d in ("customers", "products", "suppliers", "warehouses")])
            incremental.refresh(star, rule, tables, f"{base}/changes", run_ts, months)
        return incremental.read_report(spark, rule, tables).drop("updated_at", "last_updated")

    now = report_sql(name, "fact2", SECOND_TS_SQL).replace("JOIN c ON", "JOIN c2 c ON").replace("JOIN s ON", "JOIN s2 s ON")
    stamps = [c for c in ("updated_at", "last_updated") if c in rule.schema.fieldNames()]
    return Query(
        run,
        with_(
            f"SELECT * EXCLUDE ({', '.join(stamps)}) FROM ({_refreshed_sql(rule)})",
            **BASE,
            **_moved_sql(),
            fact2=f"SELECT * REPLACE (CASE WHEN {IN_SECOND} THEN quantity + 1 ELSE quantity END AS quantity) FROM fact",
            earlier=f"SELECT * FROM fact WHERE {IN_FIRST}",
            n=now,
            o=f"SELECT *, TRUE AS seen FROM ({report_sql(name, 'earlier', RUN_TS_SQL)})",
        ),
    )


def star_join_bucketed(spark, sf_dir):
    """The star join over lines and customers in buckets of the customer. The tables' names are their own and go once
    the result is resolved; the files stay."""
    star, prefix = StarOf(spark, sf_dir), f"saleslayers_star_{uuid.uuid4().hex}"
    plain = gold.Star(star.fact, star.customers, star.products, star.suppliers, star.warehouses)
    lines = gold.star_lines(gold.co_located(plain, prefix, scratch_path(spark, "co-located"), BUCKETS))
    lines.schema
    drop_tables(spark, f"{prefix}_fact", f"{prefix}_customers")
    return lines


def supplier_monthly_from_daily(spark, sf_dir):
    """The monthly report from stored daily sums. Orders get their numbers in two loads."""
    base, star = scratch_path(spark, "daily"), StarOf(spark, sf_dir)
    lines = materialise(star.fact, f"{base}/lines")
    numbers = spark.createDataFrame([], "salesordernumber string, number long")
    for part in (lines.filter(F.col("createddate") < CUTOFF), lines):
        append(distinct.new_order_numbers(part, numbers), f"{base}/numbers")
        numbers = spark.read.parquet(f"{base}/numbers")
    days = materialise(distinct.daily(lines.withColumnRenamed("supplier_id", "line_supplier"), numbers, "line_supplier"), f"{base}/days")
    return distinct.supplier_monthly(days, star, RUN_TS)


def load_all_layers(spark, sf_dir):
    """From dropped CSV files through all layers to the report by country, in two rounds.

    The second round drops the order lines from a date on; the first has all others.
    """
    base = scratch_path(spark, "layers")
    layout = Layout(f"{base}/landing", f"{base}/tables")
    early = F.col("createddate") < CUTOFF
    drops = Drops(raw(spark, sf_dir, "sale_orders"), f"{base}/drops", in_rounds(early, ~early))
    report = REPORTS["by_country"]
    write_csv(raw(spark, sf_dir, "customers"), layout.arrivals("customers"))
    for number, run_ts in enumerate((RUN_TS, SECOND_TS)):
        drops.arrive(number, layout.arrivals("sale_orders"))
        for name in ("sale_orders", "customers"):
            load_raw(spark, layout, name, run_ts)
        load_dimension(spark, layout, "dim_customers", run_ts)
        load_fact(spark, layout, ("year",))
        table = refresh_report_table(spark, layout.report(report.name), report, read_star(spark, layout), run_ts)
    return table.drop("created_at", "updated_at")


STAR_SQL = f"""SELECT {columns(FACT_COLUMNS, "f.")}, warehouse_name, supplier_name, product_name, customer_name
    FROM fact f LEFT JOIN c ON f.customer_id = c.customer_id LEFT JOIN p ON f.product_id = p.product_id
    LEFT JOIN s ON f.supplier_id = s.supplier_id LEFT JOIN w ON f.warehouse_id = w.warehouse_id"""

QUERIES = {
    "load_all_layers": Query(
        load_all_layers,
        with_(
            f"""SELECT country, total_sales_amount, CAST(total_quantity_sold AS DOUBLE) AS total_quantity_sold,
            total_orders, last_updated FROM ({report_sql('by_country', 'fact', SECOND_TS_SQL)})""",
            **BASE,
        ),
    ),
    "star_join": Query(lambda spark, d: gold.star_lines(StarOf(spark, d)), with_(STAR_SQL, **BASE)),
    "star_join_bucketed": Query(star_join_bucketed, with_(STAR_SQL, **BASE)),
    "gold_sales_summary": report("sales_summary"),
    "gold_by_country": report("by_country"),
    "gold_supplier_daily": report("by_supplier_daily"),
    "gold_supplier_monthly": report("by_supplier_monthly"),
    "gold_supplier_monthly_from_daily": Query(
        supplier_monthly_from_daily, with_(report_sql("by_supplier_monthly", "fact", RUN_TS_SQL), **BASE)
    ),
    "gold_top_sales": Query(
        lambda spark, d: gold.top_sales(StarOf(spark, d), RUN_TS),
        with_(
            report_sql("sales_summary", "fact", RUN_TS_SQL)
            + " ORDER BY total_sales_amount DESC, customer_name NULLS FIRST, product_name NULLS FIRST,"
            " supplier_name NULLS FIRST, warehouse_name NULLS FIRST, sale_date NULLS FIRST",
            **BASE,
        ),
    ),
    "gold_merge_refresh": refresh("sales_summary"),
    "gold_merge_by_country": refresh("by_country"),
    "gold_merge_supplier_daily": refresh("by_supplier_daily"),
    "gold_merge_supplier_monthly": refresh("by_supplier_monthly"),
    "gold_incremental_refresh": kept_up("sales_summary"),
    "gold_incremental_by_country": kept_up("by_country"),
    "gold_incremental_supplier_daily": kept_up("by_supplier_daily"),
    "gold_incremental_supplier_monthly": kept_up("by_supplier_monthly"),
    "gold_moved_by_country": refresh_moved("by_country"),
    "gold_moved_supplier_monthly": refresh_moved("by_supplier_monthly"),
}
