"""Reports kept up by touched groups: against rebuilds, after crashes, and what they read."""

from datetime import datetime, timezone

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from saleslayers import schemas
from saleslayers.plans import gold, incremental
from saleslayers.plans.gold import REPORTS, Star
from saleslayers.sinks import tables as sink
from saleslayers.streaming import loads
from saleslayers.streaming.loads import read_fact, write_fact

FIRST, SECOND, THIRD = (datetime(2025, m, 1, tzinfo=timezone.utc) for m in (1, 2, 3))
PARTS = ("year", "month", "day")


def lines(spark, *rows):
    """(order, line, day, quantity, customer, supplier)"""
    made = [(o, n, datetime.fromisoformat(d), datetime.fromisoformat(d), "M", q, 2.0, 0.5, c, 1, s, "W", *map(int, d.split("-"))) for o, n, d, q, c, s in rows]
    layout = "salesordernumber string, salesorderlinenumber int, createddate timestamp, processeddate timestamp, ordertype string, quantity int, unitprice double, taxamount double, customer_id int, product_id int, supplier_id string, warehouse_id string, year int, month int, day int"
    return incremental.conform_to(spark.createDataFrame(made, layout), schemas.FACT_SALE_ORDERS)


class Shop:
    """A small star below a folder whose reports are kept up."""

    def __init__(self, spark, root):
        self.spark, self.root, self.batch = spark, str(root), 0
        self.customers = {1: ("Ann", "A"), 2: ("Bo", "B"), 3: ("Cy", "A")}
        self.suppliers = {"S1": "One", "S2": "Two"}

    def star(self):
        frame = self.spark.createDataFrame
        return Star(
            read_fact(self.spark, f"{self.root}/fact"),
            frame([(k, *v, True) for k, v in self.customers.items()], "customer_id int, customer_name string, country string, is_current boolean"),
            frame([(1, "Bike", True)], "product_id int, product_name string, is_current boolean"),
            frame([(k, v, True) for k, v in self.suppliers.items()], "supplier_id string, supplier_name string, is_current boolean"),
            frame([("W", "House", True)], "warehouse_id string, warehouse_name string, is_current boolean"),
        )

    def load(self, *rows):
        write_fact(lines(self.spark, *rows), f"{self.root}/fact", PARTS, changes=f"{self.root}/changes", batch_id=self.batch)
        self.batch += 1

    def tables(self, name):
        return incremental.Tables(*[f"{self.root}/{name}/{x}" for x in ("report", "sums", "runs")])

    def refresh(self, name, run_ts):
        incremental.refresh(self.star(), REPORTS[name], self.tables(name), f"{self.root}/changes", run_ts, PARTS)

    def rows(self, name, *columns):
        return as_set(incremental.read_report(self.spark, REPORTS[name], self.tables(name)).select(*columns))

    def same_as_rebuild(self, name):
        columns = [c for c in REPORTS[name].schema.fieldNames() if c not in ("created_at", "updated_at", "last_updated")]
        whole = gold.report_rows(REPORTS[name], self.star(), FIRST).select(*columns)
        return self.rows(name, *columns) == as_set(whole)


START = [("O1", 1, "2024-05-01", 3, 1, "S1"), ("O1", 2, "2024-05-01", 1, 1, "S2"), ("O2", 1, "2024-05-02", 4, 2, "S1"), ("O3", 1, "2024-06-01", 5, 3, "S2"), ("O4", 1, "2024-06-01", 1, 9, "S9")]


@pytest.fixture
def shop(spark, tmp_path):
    made = Shop(spark, tmp_path)
    made.load(*START)
    return made


@pytest.mark.parametrize("name", list(REPORTS))
def test_equal_to_a_rebuild_after_each_kind_of_change(shop, name):
    shop.refresh(name, FIRST)
    assert shop.same_as_rebuild(name)
    shop.load(("O2", 1, "2024-05-02", 7, 2, "S2"), ("O5", 1, "2024-05-02", 1, 1, "S1"))  # a corrected line changes its supplier
    shop.customers[1], shop.suppliers["S2"] = ("Ann", "C"), "Deux"
    shop.customers[9] = ("Di", "B")  # known from now on
    del shop.customers[3]  # and another is not any more
    shop.refresh(name, SECOND)
    assert shop.same_as_rebuild(name)
    shop.load(("O6", 1, "2024-07-01", 2, 3, "S1"))
    shop.load(("O6", 2, "2024-07-02", 2, 1, "S1"))
    shop.customers[2] = ("Bob", "A")
    shop.refresh(name, THIRD)
    assert shop.same_as_rebuild(name)


def test_times_of_groups(shop):
    shop.refresh("by_country", FIRST)
    shop.load(("O5", 1, "2024-05-02", 1, 1, "S1"))
    shop.customers[2] = ("Bo", "D")
    shop.refresh("by_country", SECOND)
    got = {country: (made.month, updated.month) for country, made, updated in shop.rows("by_country", "country", "created_at", "updated_at")}
    assert got == {"A": (1, 2), "D": (2, 2), None: (1, 1)}


def test_nothing_new_writes_nothing(shop, tmp_path):
    shop.refresh("by_country", FIRST)
    before = sorted((str(p), p.stat().st_mtime_ns) for p in tmp_path.rglob("*") if p.is_file())
    shop.refresh("by_country", SECOND)
    assert sorted((str(p), p.stat().st_mtime_ns) for p in tmp_path.rglob("*") if p.is_file()) == before


@pytest.mark.parametrize("name", ["by_country", "by_supplier_monthly"])
def test_untouched_fact_partitions_are_not_read(shop, tmp_path, name):
    """Their files are replaced by something that no scan could read."""
    shop.refresh(name, FIRST)
    shop.load(("O5", 1, "2024-06-01", 1, 1, "S1"))
    shop.customers[2] = ("Bo", "D")
    for day in (1, 2):
        for file in (tmp_path / "fact" / "year=2024" / "month=5" / f"day={day}").glob("*.parquet"):
            file.write_bytes(b"no parquet")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    shop.refresh(name, SECOND)
    total = sum(q for (q,) in shop.rows(name, "total_quantity_sold"))
    assert total == 15
    if name == "by_country":
        assert shop.rows(name, "country", "total_quantity_sold") == sorted([("A", 10.0), ("D", 4.0), (None, 1.0)], key=repr)


def test_fact_scan_is_pruned_by_the_touched_partitions(shop):
    shop.refresh("by_country", FIRST)
    touched = sink.materialise(sink.partitions_of(lines(shop.spark, START[0]), PARTS), f"{shop.root}/touched")
    rows = sink.rows_in_partitions(read_fact(shop.spark, f"{shop.root}/fact"), touched, PARTS)
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "PartitionFilters: [isnotnull(year" in plan


class Lost(Exception):
    pass


@pytest.mark.parametrize("name, step", [("by_country", "summed"), ("by_supplier_daily", "recorded"), ("by_supplier_daily", "summed"), ("by_supplier_daily", "written")])
def test_an_interrupted_refresh_is_made_up_for(shop, monkeypatch, name, step):
    """The driver is lost after recording groups, after replacing partial sums, or before the refresh counts as done."""
    shop.refresh(name, FIRST)
    shop.load(("O2", 1, "2024-05-02", 7, 2, "S2"))  # the only line of (S1, that day) and of its order moves on
    shop.customers[1] = ("Ann", "C")

    def lost(*_, **__):
        raise Lost

    replace, calls = incremental.replace_partitions, []

    def counted(*args):
        calls.append(args)
        if step == "recorded" or step == "summed" and len(calls) == 2:
            raise Lost
        replace(*args)

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "replace_partitions", counted)
        if step == "written":
            patch.setattr(incremental, "write_version", lost)
        with pytest.raises(Lost):
            shop.refresh(name, SECOND)
    shop.refresh(name, THIRD)
    assert shop.same_as_rebuild(name)


def test_an_order_in_two_groups_and_partitions_counts_once_each(shop):
    shop.load(("O1", 3, "2024-06-02", 1, 3, "S1"))
    shop.refresh("by_country", FIRST)
    assert shop.rows("by_country", "country", "total_orders") == sorted([("A", 2), ("B", 1), (None, 1)], key=repr)
    shop.customers[2] = ("Bo", "A")
    shop.refresh("by_country", SECOND)
    assert shop.rows("by_country", "country", "total_orders") == sorted([("A", 3), (None, 1)], key=repr)


def test_only_one_record_of_refreshes_is_kept(shop, tmp_path):
    for month in range(1, 4):
        shop.load((f"N{month}", 1, f"2024-0{month}-01", 1, 1, "S1"))
        shop.refresh("by_country", FIRST)
    runs = [p.name for p in (tmp_path / "by_country" / "runs").iterdir()]
    assert sorted(runs) == ["done", "run=3"]
    assert shop.rows("by_country", F.sum("total_quantity_sold")) == [(17.0,)]


@pytest.mark.parametrize("stored", [False, True])
def test_a_stored_batch_is_not_written_again(spark, tmp_path, monkeypatch, stored):
    names, path = [], loads.scratch_path
    monkeypatch.setattr(loads, "scratch_path", lambda spark, name: names.append(name) or path(spark, name))
    batch = lines(spark, *START)
    batch.write.parquet(f"{tmp_path}/lines")
    batch = spark.read.parquet(f"{tmp_path}/lines")
    write_fact(batch, f"{tmp_path}/fact", PARTS, changes=f"{tmp_path}/changes", stored=stored)
    assert ("fact-batch" in names) != stored
    assert as_set(read_fact(spark, f"{tmp_path}/fact")) == as_set(batch)


def test_changed_groups_are_made_distinct_once(shop, monkeypatch):
    shop.refresh("sales_summary", FIRST)
    shop.load(("O1", 1, "2024-05-01", 9, 1, "S1"))
    shop.suppliers["S2"] = "Second"
    plans, append = [], incremental.append
    monkeypatch.setattr(incremental, "append", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or append(df, *a))
    shop.refresh("sales_summary", SECOND)
    of_groups = [line for plan in plans for line in plan.splitlines() if "Aggregate [" in line and "report_part" in line]
    assert len(of_groups) == 1 and shop.same_as_rebuild("sales_summary")
