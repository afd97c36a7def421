from datetime import date, datetime, timezone
from decimal import Decimal

from conftest import as_set

from saleslayers import schemas
from saleslayers.plans import gold
from saleslayers.plans.gold import REPORTS, Star

T = datetime(2025, 1, 1)
RUN_TS = T.replace(tzinfo=timezone.utc)
LATER = datetime(2025, 2, 1, tzinfo=timezone.utc)


def rows(spark, schema, *values):
    """Rows given by the columns that matter; the others are NULL."""
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(v.get(n) for n in names) for v in values], schema)


def line(order, number, customer, supplier, day, quantity=2, price="1.5000", product=1, warehouse="W1"):
    return dict(
        salesordernumber=order,
        salesorderlinenumber=number,
        quantity=quantity,
        taxamount=Decimal("0.2500"),
        unitprice=Decimal(price),
        customer_id=customer,
        product_id=product,
        createddate=day,
        processeddate=day,
        supplier_id=supplier,
        warehouse_id=warehouse,
    )


def star(spark, *lines):
    return Star(
        rows(spark, schemas.FACT_SALE_ORDERS, *lines),
        rows(
            spark,
            schemas.DIM_CUSTOMERS,
            dict(customer_id=1, customer_name="old", country="A", is_current=False),
            dict(customer_id=1, customer_name="one", country="B", is_current=True),
            dict(customer_id=2, customer_name="two", country="B", is_current=True),
        ),
        rows(
            spark,
            schemas.DIM_PRODUCTS,
            dict(product_id=1, product_name="same", is_current=True),
            dict(product_id=2, product_name="same", is_current=True),
        ),
        rows(
            spark,
            schemas.DIM_SUPPLIERS,
            dict(supplier_id="S1", supplier_name="sup", is_current=False),
            dict(supplier_id="S1", supplier_name="sup", is_current=True),
        ),
        rows(spark, schemas.DIM_WAREHOUSES, dict(warehouse_id="W1", warehouse_name="house", is_current=True)),
    )


MAY, JUNE = datetime(2024, 5, 31, 23, 59, 59), datetime(2024, 6, 1)
LINES = (
    line("SO1", 1, 1, "S1", MAY),
    line("SO1", 2, 1, "S1", MAY, product=2),
    line("SO2", 1, 2, "S1", JUNE),
    line("SO3", 1, 99, "S9", JUNE, warehouse="W9"),
    line("SO3", 2, 99, "S8", JUNE),
)


def test_country_counts_orders_once_and_current_rows_only(spark):
    got = as_set(gold.by_country(star(spark, *LINES), RUN_TS))
    assert got == sorted([("B", 9.0, 6, 2, T), (None, 6.0, 4, 1, T)], key=repr)


def test_unknown_suppliers_form_one_group(spark):
    got = as_set(gold.by_supplier_daily(star(spark, *LINES), RUN_TS))
    assert got == sorted(
        [
            (date(2024, 5, 31), "S1", "sup", 6.0, 4, 1, T),
            (date(2024, 6, 1), "S1", "sup", 3.0, 2, 1, T),
            (date(2024, 6, 1), None, None, 6.0, 4, 1, T),
        ],
        key=repr,
    )


def test_month_boundary(spark):
    got = as_set(gold.by_supplier_monthly(star(spark, *LINES), RUN_TS).select("sales_month", "supplier_id", "total_orders"))
    assert got == sorted([("2024-05", "S1", 1), ("2024-06", "S1", 1), ("2024-06", None, 1)], key=repr)


def test_summary_groups_by_name(spark):
    got = as_set(gold.sales_summary(star(spark, *LINES), RUN_TS))
    assert ("one", "same", "sup", "house", date(2024, 5, 31), 4, 6.0, 0.5) in got
    assert (None, "same", None, None, date(2024, 6, 1), 2, 3.0, 0.25) in got
    assert len(got) == 4


def test_top_sales_is_sorted(spark):
    got = gold.top_sales(star(spark, *LINES, line("SO9", 1, 2, "S1", MAY, quantity=100)), RUN_TS).collect()
    assert [r.total_sales_amount for r in got] == sorted([r.total_sales_amount for r in got], reverse=True)
    assert got[0].customer_name == "two"


def test_refresh_is_repeatable_and_keeps_created_at(spark):
    for report in REPORTS.values():
        first = gold.report_rows(report, star(spark, *LINES[:2], LINES[3]), RUN_TS)
        full = gold.report_rows(report, star(spark, *LINES), LATER)
        once = gold.refresh_report(first, full, report)
        assert once.columns == report.schema.fieldNames()
        assert once.count() == full.count()
        assert as_set(gold.refresh_report(once, full, report)) == as_set(once)
        assert as_set(once.drop("created_at")) == as_set(full.drop("created_at"))
        known = {tuple(r) for r in first.select(*report.keys).collect()}
        for row in once.collect():
            added = tuple(row[k] for k in report.keys) not in known
            assert row.created_at == (datetime(2025, 2, 1) if added else T)


def test_hot_report_key_is_spread_by_order_number(spark):
    plan = gold.by_country(star(spark, *LINES), RUN_TS)._jdf.queryExecution().executedPlan().toString()
    first_shuffle = plan[plan.rindex("partial_sum") :]
    assert "partial_sum" in plan and "hashpartitioning(country" in plan
    assert any("hashpartitioning(country" in l and "salesordernumber" in l for l in plan.splitlines()), first_shuffle
