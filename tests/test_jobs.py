"""All layers over a few dropped files, in two rounds and with a repeated run."""

import zipfile
from datetime import date, datetime, timezone

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from saleslayers import schemas
from saleslayers.plans import jobs
from saleslayers.plans.jobs import Layout, land_archives, load_all, load_raw, read_dimension, read_report, read_star, registry
from saleslayers.sinks.dimensions import drop_old_current_rows
from saleslayers.sources.landing import registry_state

FIRST, SECOND, THIRD = (datetime(2025, m, 1, tzinfo=timezone.utc) for m in (1, 2, 3))


def drop(layout, table, name, *lines):
    from pathlib import Path

    folder = Path(layout.arrivals(table))
    folder.mkdir(parents=True, exist_ok=True)
    header = ",".join(getattr(schemas, table.upper()).fieldNames())
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def customer(key, name, country, phone="555"):
    return f"{name},X,Co,{name.lower()}@example.com,{phone},{key},Street,Town,{country},123"


def order(number, line, customer_id, quantity, day="2024-05-01", shipped="2024-05-03"):
    return f"{number},{line},{day},{shipped},M,{quantity},2.0,0.5,{customer_id},1,SUP1,WH1"


def test_archives_are_landed_and_registered(spark, tmp_path):
    layout = Layout(str(tmp_path / "landing"), str(tmp_path / "tables"))
    (tmp_path / "zips").mkdir()
    for name, people in (("one", [customer("1", "Ann", "A")]), ("two", [customer("2", "Bo", "B"), customer("1", "An", "B")])):
        with zipfile.ZipFile(tmp_path / "zips" / f"{name}.zip", "w") as archive:
            header = ",".join(schemas.CUSTOMERS.fieldNames())
            archive.writestr("Customers.csv", "\n".join([header, *people]))
            archive.writestr("readme.txt", "x")
    for _ in range(2):  # the same drop again lands nothing
        land_archives(spark, layout, str(tmp_path / "zips"), FIRST)
    load_raw(spark, layout, "customers", SECOND)
    assert as_set(spark.read.parquet(layout.raw("customers")).select("CustomerID")) == [("1",), ("2",)]
    state = registry_state(registry(spark, layout)).filter("status = 'PROCESSED'")
    names = [(r.source_zip.split("/")[-1], r.entry, r.processed_at) for r in state.collect()]
    assert sorted(names) == [
        ("one.zip", "Customers.csv", datetime(2025, 2, 1)),
        ("two.zip", "Customers.csv", datetime(2025, 2, 1)),
    ]
    before = registry(spark, layout).count()
    load_raw(spark, layout, "customers", THIRD)
    assert registry(spark, layout).count() == before


def zipped(path, **entries):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as archive:
        for name, people in entries.items():
            archive.writestr(f"{name}.csv", "\n".join([",".join(schemas.CUSTOMERS.fieldNames()), *people]))


def test_archives_of_equal_names_never_meet(spark, tmp_path):
    layout = Layout(str(tmp_path / "landing"), str(tmp_path / "tables"))
    zipped(tmp_path / "drop1" / "drop.zip", customers=[customer("1", "Ann", "A")])
    zipped(tmp_path / "drop2" / "a" / "drop.zip", customers=[customer("2", "Bo", "B")])
    zipped(tmp_path / "drop2" / "b" / "drop.zip", customers=[customer("3", "Cy", "C")])
    for drop_folder in ("drop1", "drop2", "drop1"):
        land_archives(spark, layout, str(tmp_path / drop_folder), FIRST)
    load_raw(spark, layout, "customers", SECOND)
    assert as_set(spark.read.parquet(layout.raw("customers")).select("CustomerID")) == [("1",), ("2",), ("3",)]
    assert registry_state(registry(spark, layout)).filter("status = 'PROCESSED'").count() == 3


class Lost(Exception):
    pass


@pytest.mark.parametrize("lost_at", ["append", "land_entries", "list_files"])
def test_an_interrupted_landing_is_made_up_for(spark, tmp_path, monkeypatch, lost_at):
    """The run is lost as it writes its plans, as it copies, or between the copies and the registry; the next one is
    on another day. Every entry is landed once, under its first name, and registered."""
    layout = Layout(str(tmp_path / "landing"), str(tmp_path / "tables"))
    zipped(tmp_path / "zips" / "drop.zip", customers=[customer("1", "Ann", "A")], customers_b=[customer("2", "Bo", "B")], other=["x"])

    def lost(*_, **__):
        raise Lost

    with monkeypatch.context() as patch:
        patch.setattr(jobs, lost_at, lost)
        with pytest.raises(Lost):
            land_archives(spark, layout, str(tmp_path / "zips"), FIRST)
    assert registry(spark, layout).isEmpty()
    zipped(tmp_path / "zips" / "new.zip", customers=[customer("3", "Cy", "C")])
    for _ in range(2):
        land_archives(spark, layout, str(tmp_path / "zips"), SECOND)
    landed = sorted(str(p.relative_to(tmp_path / "landing")) for p in (tmp_path / "landing").rglob("*.csv"))
    days = [name.split("/", 1)[1].rsplit("/", 1)[0] for name in landed]
    assert days == (["2025/02/01"] * 3 if lost_at == "append" else ["2025/01/01"] * 2 + ["2025/02/01"])
    load_raw(spark, layout, "customers", THIRD)
    assert as_set(spark.read.parquet(layout.raw("customers")).select("CustomerID")) == [("1",), ("2",), ("3",)]
    state = registry_state(registry(spark, layout))
    assert sorted(r.status for r in state.collect()) == ["PROCESSED"] * 3 + ["UNMATCHED"]
    assert sorted(r.file_key.rsplit("/", 1)[-1] for r in state.filter("status = 'PROCESSED'").collect()) == sorted(n.rsplit("/", 1)[-1] for n in landed)


def test_two_runs_that_planned_at_once_follow_the_first_plan(spark, tmp_path):
    layout = Layout(str(tmp_path / "landing"), str(tmp_path / "tables"))
    zipped(tmp_path / "zips" / "drop.zip", customers=[customer("1", "Ann", "A")])
    with jobs.copied_entries(spark, layout, str(tmp_path / "zips"), FIRST):
        plans = jobs.landing_plans(spark, layout)
        first = plans.first()
        later = plans.withColumns({"target": F.lit("/elsewhere.csv"), "planned_at": F.lit(SECOND)})
        later.write.mode("append").parquet(layout.landing_plans)
    with jobs.copied_entries(spark, layout, str(tmp_path / "zips"), THIRD) as (_, outcome):
        assert [r.target for r in outcome.collect()] == [first.target]


def test_empty_and_damaged_entries_are_on_record(spark, tmp_path):
    layout = Layout(str(tmp_path / "landing"), str(tmp_path / "tables"))
    zipped(tmp_path / "zips" / "one.zip", customers=[], customers_good=[customer("1", "Ann", "A")], customers_bad=["Damaged,x"], other=["x"])
    path = tmp_path / "zips" / "one.zip"
    path.write_bytes(path.read_bytes().replace(b"Damaged", b"damaged"))
    (tmp_path / "zips" / "two.zip").write_bytes(b"no archive")
    for _ in range(2):
        land_archives(spark, layout, str(tmp_path / "zips"), FIRST)
    load_raw(spark, layout, "customers", SECOND)
    state = {(r.entry or "-"): r for r in registry_state(registry(spark, layout)).collect()}
    assert {k: r.status for k, r in state.items()} == {
        "customers.csv": "PROCESSED", "customers_good.csv": "PROCESSED", "customers_bad.csv": "CORRUPT", "other.csv": "UNMATCHED", "-": "UNREADABLE",
    }
    assert "CRC" in state["customers_bad.csv"].reason
    audit = spark.read.parquet(layout.audit("customers"))
    assert sorted(r.row_count for r in audit.collect()) == [0, 1]
    before = registry(spark, layout).count(), audit.count()
    load_raw(spark, layout, "customers", THIRD)
    assert (registry(spark, layout).count(), spark.read.parquet(layout.audit("customers")).count()) == before


def test_two_rounds(spark, tmp_path):
    layout = Layout(str(tmp_path / "landing"), str(tmp_path / "tables"))
    drop(layout, "customers", "a.csv", customer("1", "Ann", "A"), customer("2", "Bo", "B"), customer("x2", "Bad", "B"))
    drop(layout, "products", "a.csv", "1,Bike,10,red,5.00,9.00,M,1.00,3,4,2020-01-01,,f.gif,g")
    drop(layout, "suppliers", "a.csv", "SUP1,Sup,Con,bad,55,Ad,Ci,St,Co,1,Cat,2020-01-01,2020-01-01")
    drop(layout, "warehouses", "a.csv", "WH1,House,Loc,Ci,St,Co,77,500,2020-01-01,2020-01-01")
    drop(layout, "sale_orders", "a.csv", order("SO1", 1, "1", 3), order("SO2", 1, "2", 4), order("SO3", 1, "1", -4), order("SO4", 1, "9", 1))
    load_all(spark, layout, FIRST)

    def country():
        rows = read_report(spark, layout, "by_country")
        return as_set(rows.select("country", "total_sales_amount", "total_orders"))

    assert country() == sorted([("A", 6.0, 1), ("B", 8.0, 1), (None, 2.0, 1)], key=repr)
    star = read_star(spark, layout)
    assert as_set(star.customers.select("customer_id", "customer_name")) == [(1, "Ann X"), (2, "Bo X")]
    assert spark.read.parquet(layout.rejects("dim_customers")).first().customer_name == "Bad X"
    assert [r.error_description for r in spark.read.parquet(layout.rejects("fact_sale_orders")).collect()] == ["Invalid quantity"]
    assert star.suppliers.first().email is None

    # Ann moves with a new phone, a line is corrected, a line is new.
    drop(layout, "customers", "b.csv", customer("1", "Ann", "C", phone="777"))
    drop(layout, "sale_orders", "b.csv", order("SO2", 1, "2", 5), order("SO5", 1, "1", 1, "2024-06-01", "2024-06-02"))
    load_all(spark, layout, SECOND)
    people = read_dimension(spark, layout, "dim_customers")
    versions = as_set(people.filter("customer_id = 1").select("country", "is_current"))
    assert versions == [("A", False), ("C", True)]
    # A group that no line belongs to any more is gone: the report adds up to the fact table.
    expected = sorted([("B", 10.0, 1), ("C", 8.0, 2), (None, 2.0, 1)], key=repr)
    assert country() == expected
    total = read_star(spark, layout).fact.selectExpr("sum(quantity * unitprice) AS t").first().t
    assert float(total) == sum(amount for _, amount, _ in expected)

    load_all(spark, layout, THIRD)
    assert country() == expected
    assert read_star(spark, layout).customers.count() == 2
    assert read_dimension(spark, layout, "dim_customers").count() == 3
    drop(layout, "customers", "c.csv", customer("1", "Ann", "C", phone="888"))
    load_all(spark, layout, THIRD)
    drop_old_current_rows(spark, layout.refined("dim_customers"), keep=1)
    people = read_dimension(spark, layout, "dim_customers").filter("customer_id = 1").orderBy("start_date")
    assert [(r.phone, r.start_date.month, r.end_date and r.end_date.month) for r in people.collect()] == [
        ("555", 1, 2),
        ("777", 2, 3),
        ("888", 3, None),
    ]
    summary = read_report(spark, layout, "sales_summary")
    assert summary.filter("customer_name = 'Ann X'").select("sale_date").distinct().count() == 2
    assert {r.sale_date for r in summary.collect()} == {date(2024, 5, 1), date(2024, 6, 1)}
