"""Rows of large queries are evaluated once, and no task gets all lines of one kind."""

from __future__ import annotations

import glob
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from saleslayers import schemas
from saleslayers.catalog import files, reports
from saleslayers.catalog.drops import Drops, in_rounds
from saleslayers.plans import silver
from saleslayers.sinks.bucketed import drop_tables, write_bucketed
from saleslayers.sources.landing import list_files
from saleslayers.sources.tables import read_table_or_empty

LINE = (1, datetime(2024, 1, 2), datetime(2024, 1, 3), "P", 1, 2.0, 0.1, "1", "1", "SUP0001", "WH001")


def lines(spark, n, days=("1998-06-30", "1998-07-02")):
    """n order lines of the layout of the files, created by turns on some days."""
    rows = spark.createDataFrame([(f"SO{k}", *LINE) for k in range(n)], schemas.SALE_ORDERS)
    number = F.substr("salesordernumber", F.lit(3)).cast("int")
    day = F.element_at(F.array(*[F.lit(d) for d in days]), number % len(days) + 1).cast("timestamp")
    return rows.withColumns({"createddate": day, "processeddate": day})


def counted(spark, rows):
    """The rows, and a sum of how many were evaluated."""
    seen = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    return rows.mapInPandas(passing, rows.schema), seen


@pytest.mark.parametrize("query", ["append_roundtrip", "load_ledger", "stream_bronze"])
def test_two_loads_evaluate_their_lines_once(spark, monkeypatch, query):
    rows, seen = counted(spark, lines(spark, 10))
    monkeypatch.setattr(files, "raw", lambda *_: rows)
    result = files.QUERIES[query].run(spark, "")
    assert seen.value == 10
    assert result.count() == (2 if query == "load_ledger" else 10)


@pytest.mark.parametrize("query", ["gold_merge_by_country", "gold_moved_by_country"])
def test_refreshes_evaluate_their_lines_once(spark, sf_dir, monkeypatch, query):
    typed = lines(spark, 10).withColumns({"year": F.year("createddate"), "month": F.month("createddate"), "day": F.dayofmonth("createddate")})
    fact = typed.select(*[F.col(f.name).cast(f.dataType) for f in schemas.FACT_SALE_ORDERS])
    rows, seen = counted(spark, fact)
    monkeypatch.setattr("saleslayers.catalog.base.fact", lambda *_: rows)
    found = reports.QUERIES[query].run(spark, sf_dir).collect()
    assert seen.value == 10 and sum(r.total_orders for r in found) == 10


def test_bucketed_rows_are_evaluated_once(spark, tmp_path):
    rows, seen = counted(spark, spark.range(100).withColumn("v", F.col("id") * 2))
    try:
        assert write_bucketed(rows, "once_bucketed", str(tmp_path / "t"), "id", 4).agg(F.sum("v")).first()[0] == 9900
        assert seen.value == 100
    finally:
        drop_tables(spark, "once_bucketed")


def test_lines_of_one_order_type_are_written_by_several_tasks(spark, monkeypatch):
    """One audit row per type all the same."""
    monkeypatch.setattr(files, "raw", lambda *_: lines(spark, 40).repartition(4))
    before = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/audited-*"))
    (row,) = files.ingest_audit(spark, "").collect()
    (folder,) = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/audited-*")) - before
    assert (row.ordertype, row.row_count, row.batch_id, row.status) == ("P", 40, 7, "PROCESSED")
    assert (row.first_created, row.last_created) == (datetime(1998, 6, 30), datetime(1998, 7, 2))
    assert len(glob.glob(f"{folder}/ordertype=P/*.csv.gz")) == 4


def test_drops_arrive_one_after_the_other(spark, tmp_path):
    """A drop without rows is a file without rows; NULL conditions choose no drop."""
    rows = spark.createDataFrame([(1,), (2,), (None,)], "n int")
    drops = Drops(rows, str(tmp_path / "drops"), in_rounds(F.col("n") < 2, F.col("n") > 5, F.col("n") > 0))
    read = []
    for number in range(3):
        drops.arrive(number, str(tmp_path / "landing"))
        files_there = list_files(spark, str(tmp_path / "landing")).count()
        found = spark.read.schema("n int").option("header", True).option("recursiveFileLookup", True).csv(str(tmp_path / "landing"))
        read.append((files_there > number, sorted(r.n for r in found.collect())))
    assert read == [(True, [1]), (True, [1]), (True, [1, 1, 2])]


def test_first_load_meets_no_table(spark, tmp_path):
    """The planner knows that there are no old lines: the batch is not shuffled to meet them."""
    empty = read_table_or_empty(spark, str(tmp_path / "none"), schemas.FACT_SALE_ORDERS)
    batch = spark.createDataFrame([], schemas.FACT_SALE_ORDERS)
    assert "Join" not in silver.merge_fact(empty, batch)._jdf.queryExecution().optimizedPlan().toString()
