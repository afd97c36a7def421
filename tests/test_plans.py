"""Plan shapes that decide how the queries behave on large and skewed tables."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from saleslayers.operators import history
from saleslayers.plans import gold, silver
from saleslayers.catalog.mapping import RUN_TS
from saleslayers.catalog.registry import QUERIES
from saleslayers.operators.merge import merge
from saleslayers.plans.gold import Star
from saleslayers.sinks.bucketed import drop_tables

# Reading these needs files to be written first.
FILES = ("scan_", "append_", "stream_", "ingest_", "expand_", "evolve_repartition", "evolve_chain", "load_ledger", "gold_incremental_", "scd2_stored_")


LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def shuffle_joins_only(spark):
    """No broadcast, and sizes at which a test table already counts as skewed."""
    before = {k: spark.conf.get(k, None) for k in LIMITS}
    try:
        for key, value in LIMITS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(FILES)])
def test_no_product_of_tables_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name].run(spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in plan


def test_reports_read_only_what_they_use(spark, sf_dir):
    plan = QUERIES["gold_by_country"].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert schemas and not any("l_discount" in s or "o_totalprice" in s or "c_acctbal" in s for s in schemas)


def test_lines_lie_by_order_number_when_the_latest_is_chosen(spark, sf_dir):
    """The join with the orders is the last shuffle: none by order and line number follows."""
    with shuffle_joins_only(spark):
        plan = plan_of(QUERIES["bronze_sale_orders"].run(spark, sf_dir))
    assert "Exchange hashpartitioning(salesordernumber" in plan
    assert not re.search(r"Exchange hashpartitioning\(salesordernumber#\d+L?, salesorderlinenumber", plan)


def test_filter_reaches_the_scan(spark, sf_dir):
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts" in plan_of(QUERIES["scan_incremental"].run(spark, sf_dir))


def test_hot_customer_is_split_when_the_dimension_is_too_large_to_broadcast(spark, tmp_path):
    """A third of all lines belong to one customer; the shuffle join splits them."""
    rows = 300_000
    fact = spark.range(rows, numPartitions=8).select(
        F.concat(F.lit("SO"), (F.col("id") / 3).cast("long").cast("string")).alias("salesordernumber"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).cast("int").alias("customer_id"),
        F.lit(1).alias("quantity"),
        F.lit("1.0").cast("decimal(8,4)").alias("unitprice"),
    )
    customers = spark.range(5000).select(
        F.col("id").cast("int").alias("customer_id"),
        F.concat(F.lit("country "), (F.col("id") % 20).cast("string")).alias("country"),
        F.lit(True).alias("is_current"),
    )
    fact.write.parquet(str(tmp_path / "f"))
    customers.write.parquet(str(tmp_path / "c"))
    with shuffle_joins_only(spark):
        nothing = spark.createDataFrame([], "x int")
        star = Star(
            spark.read.parquet(str(tmp_path / "f")),
            spark.read.parquet(str(tmp_path / "c")),
            nothing,
            nothing,
            nothing,
        )
        report = gold.by_country(star, RUN_TS)
        total = report.collect()
        plan = report._jdf.queryExecution().executedPlan().toString()
    assert sum(r.total_quantity_sold for r in total) == rows
    assert "skew=true" in plan


def test_hot_target_key_is_split_in_a_merge(spark, tmp_path):
    """A third of the target's rows share one key and are all updated."""
    rows = 300_000
    spark.range(rows, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.lit(0).alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    ).write.parquet(str(tmp_path / "target"))
    spark.range(-1000, 100_000).select(
        F.col("id").alias("k"), F.lit(1).alias("v"), F.lit("new").alias("payload")
    ).write.parquet(str(tmp_path / "source"))
    with shuffle_joins_only(spark):
        target, source = (spark.read.parquet(str(tmp_path / n)) for n in ("target", "source"))
        after = merge(target, source, ["k"], set=["v"]).groupBy("v").count()
        counts = {r.v: r["count"] for r in after.collect()}
        plan = plan_of(after)
    known = [i for i in range(rows) if i % 3]
    updated = 100_000 + sum(i < 100_000 for i in known)
    added = 1000 + sum(1 for i in range(1, 100_000) if i % 3 == 0)
    assert counts == {0: rows - updated, 1: updated + added}
    assert "skew=true" in plan


def _scans_and_exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan parquet"), plan.count("Exchange hashpartitioning")


def test_a_load_reads_dimension_and_batch_once(spark, tmp_path):
    plan = silver.DIMENSIONS["dim_customers"]
    for name in ("current", "batch"):
        spark.createDataFrame([], plan.schema).write.parquet(f"{tmp_path}/{name}")
    current, batch = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("current", "batch"))
    with_conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(with_conf)
    spark.conf.set(with_conf, "-1")
    try:
        after = history.apply_history(current, batch, plan.rule, RUN_TS, check_unique=False, only_current=True)
        assert _scans_and_exchanges(after) == (2, 2)
        merged = merge(current, batch, ["customer_id"], set=["phone"], check_unique=False, unique_target=True)
        assert _scans_and_exchanges(merged) == (2, 2)
        report = gold.REPORTS["by_country"]
        spark.createDataFrame([], report.schema).write.parquet(f"{tmp_path}/report")
        stored = spark.read.parquet(f"{tmp_path}/report")
        assert _scans_and_exchanges(gold.refresh_report(stored, stored, report)) == (2, 2)
    finally:
        spark.conf.set(with_conf, before)


def test_lines_in_buckets_of_the_customer_are_not_moved(spark, tmp_path):
    """Lines and customers meet without an exchange of either; a hot customer's lines get no buckets and are split."""
    rows = 40_000
    lines = spark.range(rows).select((F.col("id") % 900).cast("int").alias("customer_id"), F.lit(1).alias("quantity"), F.lit("1.0").cast("decimal(8,4)").alias("unitprice"))
    hot = lines.withColumn("customer_id", F.when(F.col("customer_id") % 3 == 0, 7).otherwise(F.col("customer_id")))
    people = spark.range(900).select(F.col("id").cast("int").alias("customer_id"), F.concat(F.lit("n"), "id").alias("customer_name"), F.lit(True).alias("is_current"))
    nothing = spark.createDataFrame([], "x int")
    with shuffle_joins_only(spark):
        found = {}
        for name, fact in (("even", lines), ("hot", hot)):
            star = gold.co_located(Star(fact, people, nothing, nothing, nothing), f"test_{name}", str(tmp_path / name), 8)
            joined = gold._with(star.fact, star.customers, "customer_id", customer_name="customer_name")
            assert joined.groupBy().agg(F.sum("quantity"), F.count("customer_name")).first() == (rows, rows)
            found[name] = plan_of(joined)
            drop_tables(spark, f"test_{name}_fact", f"test_{name}_customers")
    assert "Exchange" not in found["even"] and "Bucketed: true" in found["even"]
    assert found["hot"].count("Exchange hashpartitioning(customer_id") >= 1
