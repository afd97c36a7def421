import shutil
import zipfile
from datetime import datetime, timezone
from decimal import Decimal

from conftest import as_set
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saleslayers import schemas
from saleslayers.session import scratch_path
from saleslayers.sinks.tables import (
    append,
    append_batch,
    drop_old_versions,
    finish_replacement,
    materialise,
    read_version,
    replace_partitions,
    partitions_of,
    rows_in_partitions,
    versions,
    write_version,
    written,
)
from saleslayers.sources import landing
from saleslayers.sources.archives import archive_contents, data_lines, expand_archives
from saleslayers.sources.files import parse_csv_lines, read_csv
from saleslayers.sources.tables import loads_after, read_table, rows_after, watermark_of

RUN_TS = datetime(2025, 1, 1, tzinfo=timezone.utc)

CSV = """i,d,t,s
1,2.50,2024-09-21,plain
x,2.50,2024-09-21,bad int
2,abc,not a date,bad rest
3,1.00
4,1.00,2024-09-21,long,extra
5,,,
6,1.00,2024-09-21,"a, b"
"""


def test_permissive_csv(spark, tmp_path):
    schema = StructType.fromDDL("i int, d decimal(10,2), t timestamp, s string")
    (tmp_path / "f.csv").write_text(CSV)
    day = datetime(2024, 9, 21)
    got = as_set(read_csv(spark, schema, str(tmp_path)))
    assert got == sorted(
        [
            (1, Decimal("2.50"), day, "plain"),
            (None, Decimal("2.50"), day, "bad int"),
            (2, None, None, "bad rest"),
            (3, Decimal("1.00"), None, None),
            (4, Decimal("1.00"), day, "long"),
            (5, None, None, None),
            (6, Decimal("1.00"), day, 'a, b'),
        ],
        key=repr,
    )
    corrupt = read_csv(spark, schema, str(tmp_path), keep_corrupt=True).cache()
    bad = {r._corrupt_record for r in corrupt.filter("_corrupt_record is not null").collect()}
    assert "x,2.50,2024-09-21,bad int" in bad and len(bad) == 4


def test_incremental_scan_reaches_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for day in (1, 2, 3):
        append(spark.range(day).withColumn("ingestion_timestamp", F.lit(datetime(2025, 1, day))), path)
    table = read_table(spark, path)
    mark = datetime(2025, 1, 1, tzinfo=timezone.utc)
    assert rows_after(table, mark).count() == 5
    assert rows_after(table, None).count() == 6
    assert watermark_of(table) == datetime(2025, 1, 3)
    plan = rows_after(table, mark)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ingestion_timestamp" in plan


def test_routing_and_paths(spark):
    names = ["Sale_Orders_1.csv", "PRODUCTS.csv", "customers-and-products.csv", "my_warehouses", "other.csv", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    df = df.withColumn("c", landing.route(F.col("n"))).orderBy("i")
    assert [r.c for r in df.collect()] == ["sale_orders", "products", "customers", "warehouses", None, None]
    paths = [r[0] for r in df.select(landing.landing_path(F.col("c"), RUN_TS)).collect()]
    assert paths[0].startswith("sale_orders_data/2025/01/01/sale_orders_20250101_") and paths[0].endswith(".csv")
    assert len({p for p in paths if p}) == 4 and paths[4:] == [None, None]


def test_registry_life(spark):
    keys = ["raw/customers_data/2025/a.csv", "raw/customers_data/2025/b.csv", "customers_data/c.csv", "x/products_data/d.csv"]
    files = spark.createDataFrame([(k, "drop.zip") for k in keys], "file_key string, source_zip string")
    registry = landing.register(files, RUN_TS)
    assert registry.schema.fieldNames() == schemas.FILE_REGISTRY.fieldNames()
    done = landing.mark_processed(registry, files.filter(F.col("file_key").contains("a.csv")), RUN_TS)
    registry = registry.unionByName(done)
    assert as_set(landing.new_files(registry, "customers")) == sorted([(keys[1],), (keys[2],)], key=repr)
    state = {r.file_key: (r.status, r.processed_at) for r in landing.registry_state(registry).collect()}
    assert state[keys[0]] == ("PROCESSED", datetime(2025, 1, 1)) and state[keys[1]] == ("NEW", None)


def test_listing_reads_no_contents(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.csv").write_text("x\n")
    (tmp_path / "two.txt").write_text("x\n")
    files = landing.list_files(spark, str(tmp_path))
    assert [r.path.rsplit("/", 1)[1] for r in files.collect()] == ["one.csv"]
    assert "content:binary" not in files._jdf.queryExecution().executedPlan().toString()


HEADER = "FirstName,LastName,CompanyName,EmailAddress,Phone,CustomerID,AddressLine1,City,CountryRegion,PostalCode\n"


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as z:
        z.writestr("CUSTOMERS_1.csv", HEADER + "Ann,Lee,C,a@b.org,1,7,addr,town,land,1\r\n" + 'Bo,"L, K",C,,2,8,a,t,l,2')
        z.writestr("products.csv", "ProductID\n1\n")
        z.writestr("suppliers.csv", "")
        z.writestr("mystery.csv", "h\nv\n")
        z.writestr("notes.txt", "no")
        z.writestr("folder/customers_2.csv", HEADER)
        z.writestr("LOUD.CSV", "h\n")
    (tmp_path / "broken.zip").write_text("this is no archive")
    (tmp_path / "customers.csv").write_text(HEADER)
    status = {r.entry: r.status for r in archive_contents(spark, str(tmp_path)).collect()}
    assert status == {
        "CUSTOMERS_1.csv": "csv",
        "products.csv": "csv",
        "suppliers.csv": "csv",
        "mystery.csv": "csv",
        "notes.txt": "skipped",
        "folder/customers_2.csv": "skipped",
        "LOUD.CSV": "skipped",
        None: "unreadable",
    }
    lines = expand_archives(spark, str(tmp_path))
    found = {(r.entry, r.category): r["count"] for r in lines.groupBy("entry", "category").count().collect()}
    assert found == {("CUSTOMERS_1.csv", "customers"): 3, ("products.csv", "products"): 2, ("mystery.csv", None): 2}
    people = parse_csv_lines(data_lines(lines, "customers"), schemas.CUSTOMERS)
    assert as_set(people.select("FirstName", "LastName", "EmailAddress", "PostalCode")) == [
        ("Ann", "Lee", "a@b.org", "1"),
        ("Bo", "L, K", None, "2"),
    ]


def test_long_entry_is_read_whole(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("sale_orders.csv", "\n".join(str(i) for i in range(50001)))
    lines = data_lines(expand_archives(spark, str(tmp_path)), "sale_orders")
    assert lines.agg(F.count("*"), F.sum(F.col("line").cast("long")), F.max("line_no")).first()[:] == (50000, 1250025000, 50001)


def test_versions(spark, tmp_path):
    root = str(tmp_path / "dim")
    schema = StructType.fromDDL("a int, b string")
    assert read_version(spark, root, schema).count() == 0
    write_version(spark.createDataFrame([(1, "x")], schema), root)
    grown = read_version(spark, root, schema).unionByName(spark.createDataFrame([(2, "y")], schema))
    assert write_version(grown, root) == 2
    (tmp_path / "dim" / "version=3").mkdir()  # a version that was never completed
    assert versions(spark, root) == [1, 2]
    assert as_set(read_version(spark, root, schema)) == [(1, "x"), (2, "y")]
    drop_old_versions(spark, root, keep=1)
    assert versions(spark, root) == [2]


def test_replacing_partitions_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "fact")
    schema = StructType.fromDDL("v int, year int, month int")
    append(spark.createDataFrame([(1, 2024, 1), (2, 2024, 2), (3, 2025, 1)], schema), path, ["year", "month"])
    table = spark.read.schema(schema).parquet(path)
    batch = spark.createDataFrame([(9, 2024, 2), (9, 2026, 1)], schema)
    materialise(partitions_of(batch, ["year", "month"]), str(tmp_path / "touched"))
    touched = rows_in_partitions(table, spark.read.parquet(str(tmp_path / "touched")), ["year", "month"])
    assert as_set(touched.select("v", "year", "month")) == [(2, 2024, 2)]
    assert "dynamicpruning" in touched._jdf.queryExecution().executedPlan().toString()
    replace_partitions(touched.select("v", "year", "month").withColumn("v", F.col("v") * 10).unionByName(batch), path, ["year", "month"])
    assert as_set(spark.read.schema(schema).parquet(path)) == sorted(
        [(1, 2024, 1), (20, 2024, 2), (9, 2024, 2), (3, 2025, 1), (9, 2026, 1)], key=repr
    )


def test_interrupted_replacement_is_finished(spark, tmp_path):
    path, pending = tmp_path / "fact", tmp_path / "fact.pending"
    schema = StructType.fromDDL("v int, year int, month int")
    append(spark.createDataFrame([(1, 2024, 1), (2, 2024, 2), (3, 2025, 1)], schema), str(path), ["year", "month"])
    changed = spark.createDataFrame([(10, 2024, 1), (20, 2024, 2)], schema)
    append(changed, str(pending), ["year", "month"])
    # As after a driver lost between removing an old partition and moving the new one in.
    shutil.rmtree(path / "year=2024" / "month=1")
    finish_replacement(spark, str(path), ["year", "month"])
    expected = [(3, 2025, 1), (10, 2024, 1), (20, 2024, 2)]
    assert as_set(spark.read.schema(schema).parquet(str(path))) == sorted(expected, key=repr)
    assert not pending.exists()
    finish_replacement(spark, str(path), ["year", "month"])
    # New partitions that were not completely written are not used.
    append(changed, str(pending), ["year", "month"])
    (pending / "_SUCCESS").unlink()
    finish_replacement(spark, str(path), ["year", "month"])
    assert as_set(spark.read.schema(schema).parquet(str(path))) == sorted(expected, key=repr)


def test_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "raw")
    for batch_id, n in ((0, 3), (1, 4), (1, 4)):
        append_batch(spark.range(n), path, batch_id)
    rows = spark.read.parquet(path)
    assert {r.ingest_batch: r["count"] for r in rows.groupBy("ingest_batch").count().collect()} == {0: 3, 1: 4}


def test_intermediates_live_in_the_shared_folder_and_go_away(spark, tmp_path):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    with written(spark.range(5), path) as table:
        assert table.count() == 5
    import os

    assert not os.path.exists(path)


def test_new_loads_are_found_by_the_ledger(spark, tmp_path):
    """Files of older loads are replaced by something that no scan could read."""
    schema = StructType.fromDDL("v int, ingestion_timestamp timestamp, ingest_batch long")
    root, ledger = str(tmp_path / "raw"), str(tmp_path / "ledger")
    for batch in range(4):
        stamp = F.lit(datetime(2025, 1 + batch, 1)).cast("timestamp").alias("ingestion_timestamp")
        append_batch(spark.range(batch, batch + 2).select(F.col("id").cast("int").alias("v"), stamp), root, batch)
        append_batch(spark.range(1).select(stamp), ledger, batch)
    for batch in (0, 1):
        for file in (tmp_path / "raw" / f"ingest_batch={batch}").glob("*.parquet"):
            file.write_bytes(b"no parquet")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    table = spark.read.schema(schema).parquet(root)
    newer = loads_after(table, spark.read.parquet(ledger), datetime(2025, 2, 1, 12))
    assert as_set(newer.select("v", "ingest_batch")) == [(2, 2), (3, 2), (3, 3), (4, 3)]
    plan = newer._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_batch" in plan and "dynamicpruning" in plan
    assert loads_after(table, spark.read.parquet(ledger), datetime(2026, 1, 1)).count() == 0
    assert loads_after(table, spark.read.parquet(ledger), None) is table
