"""File scans, archives, the file registry, appends and streamed loads.

The files are written by Spark from the tables of the data folder, into fresh folders of the
shared scratch space.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from datetime import timedelta
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslayers import schemas
from saleslayers.catalog.base import Query, bronze_table, raw
from saleslayers.catalog.drops import ROUND, Drops, in_rounds, write_csv
from saleslayers.catalog.mapping import RUN_TS, RUN_TS_SQL, SECOND_TS, SECOND_TS_SQL, table
from saleslayers.catalog.sql import bronze_columns, bronze_sql, columns, fact_sql, labelled_lines_sql, raw_sql
from saleslayers.catalog.upserts import FIRST_END, IN_FIRST, IN_SECOND, SECOND_START
from saleslayers.plans import bronze, jobs
from saleslayers.plans.jobs import Layout
from saleslayers.session import scratch_path
from saleslayers.sinks.audit import file_audit
from saleslayers.sinks.tables import append, written
from saleslayers.sources import landing
from saleslayers.sources.archives import data_lines, expand_archives, file_system_of, qualified
from saleslayers.sources.files import parse_csv_lines, read_csv
from saleslayers.sources.tables import read_table, rows_after
from saleslayers.streaming import loads

ORDERS = bronze.RAW_TABLES["sale_orders"]


def _early() -> Column:
    return F.col("createddate") < FIRST_END


def _late() -> Column:
    return F.col("createddate") >= FIRST_END


# --- CSV files --------------------------------------------------------------------------


def scan_csv_permissive(spark, sf_dir):
    """Order lines whose quantity is no number for one order type: those read as NULL."""
    rows = raw(spark, sf_dir, "sale_orders")
    text = F.when(F.col("ordertype") == "P", "n/a").otherwise(F.col("quantity").cast("string"))
    return read_csv(
        spark, schemas.SALE_ORDERS, write_csv(rows.withColumn("quantity", text), scratch_path(spark, "csv"))
    )


def _raw_typed(**changes: str) -> str:
    """Raw order lines in the types of the CSV schema."""
    changes = {
        "unitprice": "CAST(unitprice AS DOUBLE)",
        "taxamount": "CAST(taxamount AS DOUBLE)",
        **changes,
    }
    names = schemas.SALE_ORDERS.fieldNames()
    outputs = ", ".join(f"{changes[c]} AS {c}" if c in changes else c for c in names)
    return f"SELECT {outputs} FROM ({raw_sql('sale_orders')})"


# --- tables -----------------------------------------------------------------------------


def _two_appends(spark, sf_dir) -> str:
    """A raw table filled by two loads, split by creation time."""
    path = scratch_path(spark, "appended")
    with written(raw(spark, sf_dir, "sale_orders"), scratch_path(spark, "lines")) as rows:
        for part, run_ts in ((_early(), RUN_TS), (_late(), SECOND_TS)):
            append(bronze.ingest(rows.filter(part), ORDERS, run_ts), path, ORDERS.partition_columns)
    return path


def append_roundtrip(spark, sf_dir):
    return read_table(spark, _two_appends(spark, sf_dir)).select(*bronze_columns("sale_orders"))


def scan_table(spark, sf_dir):
    """A catalog table, read by name. Its name is its own and goes once the table is resolved; the files stay."""
    name = f"saleslayers_scan_{uuid.uuid4().hex}"
    bronze_table(spark, sf_dir, "suppliers").write.option("path", scratch_path(spark, "table")).saveAsTable(name)
    rows = read_table(spark, name)
    rows.schema
    spark.sql(f"DROP TABLE {name}")  # external: the catalog entry alone
    return rows


def scan_new_loads(spark, sf_dir):
    """Only what was loaded after the first load: by the time that each row carries."""
    rows = read_table(spark, _two_appends(spark, sf_dir)).select(*bronze_columns("sale_orders"))
    return rows_after(rows, RUN_TS + timedelta(days=1))


def scan_new_batches(spark, sf_dir):
    """The same from a raw table of two streamed loads, by the ledger of its loads."""
    layout = _two_loads(spark, sf_dir, "two-loads")
    return jobs.new_loads(spark, layout, "sale_orders", RUN_TS + timedelta(days=1)).select(*bronze_columns("sale_orders"))


def load_ledger(spark, sf_dir):
    """What the ledger has of these loads: records read and kept."""
    layout = _two_loads(spark, sf_dir, "ledger")
    return read_table(spark, layout.ledger("sale_orders"))


def fact_load_counts(spark, sf_dir):
    """What the ledger has of the fact loads that follow: valid and rejected lines."""
    return read_table(spark, _two_loads(spark, sf_dir, "fact-ledger", into_fact=True).ledger("fact_sale_orders"))


def _two_loads(spark, sf_dir, name: str, into_fact: bool = False) -> Layout:
    """Order lines dropped and loaded twice, split by creation time; the second drop holds each of its lines twice."""
    base = scratch_path(spark, name)
    layout = Layout(f"{base}/landing", f"{base}/tables")
    drops = Drops(raw(spark, sf_dir, "sale_orders"), f"{base}/drops", in_rounds(_early(), _late(), _late()))
    for numbers, run_ts in (([0], RUN_TS), ([1, 2], SECOND_TS)):
        for number in numbers:
            drops.arrive(number, layout.arrivals("sale_orders"))
        jobs.load_raw(spark, layout, "sale_orders", run_ts)
        if into_fact:
            jobs.load_fact(spark, layout, ("year",))
    return layout


APPENDED_SQL = (
    "SELECT "
    + columns([c for c in bronze_columns("sale_orders") if c != "ingestion_timestamp"])
    + f", CASE WHEN createddate < TIMESTAMP '{FIRST_END} 00:00:00' THEN {RUN_TS_SQL} ELSE {SECOND_TS_SQL} END"
    + f" AS ingestion_timestamp FROM ({bronze_sql('sale_orders')})"
)

# --- file names and registry ---------------------------------------------------------------


def _file_names(spark, sf_dir) -> DataFrame:
    """One file name per order; some name two categories, some none."""
    label = (
        F.when(F.col("o_orderstatus") == "P", "Daily_SALE_ORDERS")
        .when(F.col("o_orderstatus") == "F", "products-Customers")
        .otherwise("readme")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.concat(label, F.lit("_"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("entry"),
    )


NAMES_SQL = """SELECT o_orderkey, o_orderpriority, CASE o_orderstatus WHEN 'P' THEN 'Daily_SALE_ORDERS'
    WHEN 'F' THEN 'products-Customers' ELSE 'readme' END || '_' || CAST(o_orderkey AS VARCHAR) || '.csv' AS entry,
    CASE o_orderstatus WHEN 'P' THEN 'sale_orders' WHEN 'F' THEN 'customers' END AS category FROM orders"""
PATH_SQL = "category || '_data/2025/01/01/' || category || '_20250101_' || CAST(o_orderkey AS VARCHAR) || '.csv'"


def route_files(spark, sf_dir):
    return _file_names(spark, sf_dir).select("entry", landing.route(F.col("entry")).alias("category"))


def landing_path(spark, sf_dir):
    """Paths with the order key in place of the random part."""
    return _file_names(spark, sf_dir).select(
        "entry", landing.landing_path(landing.route(F.col("entry")), RUN_TS, F.col("o_orderkey")).alias("file_key")
    )


def new_files(spark, sf_dir):
    """Registered order files, of which those of urgent orders are processed."""
    files = (
        _file_names(spark, sf_dir)
        .withColumn("file_key", landing.landing_path(landing.route(F.col("entry")), RUN_TS, F.col("o_orderkey")))
        .filter(F.col("file_key").isNotNull())
    )
    registered = landing.register(files, RUN_TS)
    done = landing.mark_processed(registered, files.filter(F.col("o_orderpriority") == "1-URGENT"), SECOND_TS)
    return landing.new_files(registered.unionByName(done), "sale_orders")


def ingest_audit(spark, sf_dir):
    """Audit rows of a scan of one folder per order type, put together by folder: a type has as many files as tasks
    have lines of it."""
    folder = write_csv(raw(spark, sf_dir, "sale_orders"), scratch_path(spark, "audited"), "ordertype")
    names = [f for f in schemas.SALE_ORDERS if f.name != "ordertype"]
    rows = read_csv(spark, type(schemas.SALE_ORDERS)(names), f"{folder}/*").withColumn(
        "source_file", F.col("_metadata.file_path")
    )
    audit = file_audit(rows, 7, RUN_TS)
    measures = {"row_count": F.sum, "first_created": F.min, "last_created": F.max, "batch_id": F.max, "status": F.max, "processed_at": F.max}
    return (
        audit.groupBy(F.regexp_extract("file_key", "/(ordertype=[^/]*)/", 1).alias("folder"))
        .agg(*[of(c).alias(c) for c, of in measures.items()])
        .select(F.regexp_extract("folder", "ordertype=([A-Z])", 1).alias("ordertype"), *measures)
    )


# --- archives ---------------------------------------------------------------------------


def _zip_lines(header: str, folder: str, name: str):
    """Writes the lines of each partition as one ZIP file and returns its path."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        path = f"{folder}/drop-{number}.zip"
        fs, local = file_system_of(path)
        fs.create_dir(local.rsplit("/", 1)[0])
        with fs.open_output_stream(local) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            with archive.open(f"{name}_{number}.csv", "w", force_zip64=True) as entry:
                text = io.TextIOWrapper(entry, "utf-8")
                text.write(header + "\n")
                for batch in batches:
                    for line in batch["line"]:
                        text.write(line + "\n")
                text.flush()
                text.detach()
            archive.writestr("notes.txt", "not a CSV file")
            archive.writestr(f"old/{name}.csv", header + "\n")
        yield pd.DataFrame({"path": [path]})

    return write


def zip_rows(rows: DataFrame, folder: str, name: str) -> None:
    """Drops rows as archives into a folder, as an outside system would: one archive per partition of the rows."""
    folder = qualified(rows.sparkSession, folder)
    lines = rows.select(F.to_csv(F.struct(*rows.columns)).alias("line"))
    writer = _zip_lines(",".join(rows.columns), folder, name)
    lines.mapInPandas(writer, "path STRING").write.format("noop").mode("overwrite").save()


def _drop_damaged(spark, folder: str, name: str) -> None:
    """An archive with a damaged entry and one without data rows, and a file that is no archive."""
    header = ",".join(schemas.CUSTOMERS.fieldNames())
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr(f"{name}_damaged.csv", header + "\nNobody,at,all")
        archive.writestr(f"{name}_empty.csv", header + "\n")
    files, place = file_system_of(qualified(spark, folder))
    for file, data in (("damaged.zip", packed.getvalue().replace(b"Nobody", b"nobody")), ("broken.zip", b"no archive")):
        with files.open_output_stream(f"{place}/{file}") as out:
            out.write(data)


def expand_archive_rows(spark, sf_dir):
    """Customers dropped as archives, read back as typed rows; damaged ones beside them change nothing."""
    folder = scratch_path(spark, "zips")
    zip_rows(raw(spark, sf_dir, "customers").hint("rebalance"), folder, "Customers")
    _drop_damaged(spark, folder, "Customers")
    lines = expand_archives(spark, folder)
    return parse_csv_lines(data_lines(lines, "customers"), schemas.CUSTOMERS)


def land_archives(spark, sf_dir):
    """Customers dropped as archives, among damaged ones, unpacked into the landing folder and read from there."""
    base = scratch_path(spark, "landed")
    zip_rows(raw(spark, sf_dir, "customers").hint("rebalance"), f"{base}/zips", "Customers")
    _drop_damaged(spark, f"{base}/zips", "Customers")
    layout = Layout(f"{base}/landing", f"{base}/tables")
    jobs.land_archives(spark, layout, f"{base}/zips", RUN_TS)
    return read_csv(spark, schemas.CUSTOMERS, f"{layout.arrivals('customers')}/{RUN_TS:%Y/%m/%d}")


def land_archives_same_name(spark, sf_dir):
    """Two drops of one day whose archives have equal names, each landed twice: all rows are there once."""
    base = scratch_path(spark, "landed-twice")
    layout = Layout(f"{base}/landing", f"{base}/tables")
    rows = raw(spark, sf_dir, "customers")
    even = F.col("CustomerID").cast("int") % 2 == 0
    for number, part in enumerate((even, ~even)):
        zip_rows(rows.filter(part), f"{base}/drop{number}", "Customers")
        for _ in range(2):
            jobs.land_archives(spark, layout, f"{base}/drop{number}", RUN_TS)
    return read_csv(spark, schemas.CUSTOMERS, f"{layout.arrivals('customers')}/{RUN_TS:%Y/%m/%d}")


def _interrupted_landing(spark, sf_dir, name: str) -> tuple[Layout, str]:
    """Customers dropped as archives, landed by a run that is lost after the copies and before it registers them.
    What it copied is read by a load of the raw table. The next day's run lands the drop again, twice."""
    base = scratch_path(spark, name)
    layout, zips = Layout(f"{base}/landing", f"{base}/tables"), f"{base}/zips"
    zip_rows(raw(spark, sf_dir, "customers").hint("rebalance"), zips, "Customers")
    _drop_damaged(spark, zips, "Customers")
    with jobs.copied_entries(spark, layout, zips, RUN_TS):
        pass  # here the run is lost
    jobs.load_raw(spark, layout, "customers", RUN_TS + timedelta(hours=1))
    for _ in range(2):
        jobs.land_archives(spark, layout, zips, RUN_TS + timedelta(days=1))
    jobs.load_raw(spark, layout, "customers", SECOND_TS)
    return layout, zips


def land_archives_retried(spark, sf_dir):
    """The raw rows after such a landing: each customer once, from the first load."""
    layout, _ = _interrupted_landing(spark, sf_dir, "landed-again")
    rows = read_table(spark, layout.raw("customers"))
    return rows.select(*schemas.CUSTOMERS.fieldNames(), loads.BATCH)


def _registered(spark, layout: Layout, zips: str) -> DataFrame:
    """By status: entries of the registry less what the archives of whole rows hold of that kind (`more_entries`), rows
    read from the files, and how many of the landed files are not registered as this."""
    state = landing.registry_state(jobs.registry(spark, layout))
    audit = read_table(spark, layout.audit("customers")).select("file_key", "row_count")

    def told(rows: DataFrame, status, entries: int, row_count=F.lit(0), files: int = 0) -> DataFrame:
        return rows.select(status.alias("status"), F.lit(entries).alias("entries"), row_count.alias("row_count"), F.lit(files).alias("files"))

    processed, skipped = F.lit("PROCESSED"), F.lit("SKIPPED")
    archives, landed = landing.list_files(spark, zips, "drop-*.zip"), landing.list_files(spark, layout.arrivals("customers"))
    parts = [
        told(state.join(audit, "file_key", "left"), F.col("status"), 1, F.coalesce("row_count", F.lit(0)), -1),
        told(archives, processed, -1),
        told(archives, skipped, -2),
        told(landed, processed, 0, files=1),
    ]
    files = F.when(F.col("status") == "PROCESSED", F.sum("files"))
    totals = [F.sum("entries").alias("more_entries"), F.sum("row_count").alias("row_count"), files.alias("unregistered_files")]
    return reduce(DataFrame.unionByName, parts).groupBy("status").agg(*totals)


def landed_registry(spark, sf_dir):
    """What the registry holds of a drop among damaged archives after a raw load."""
    base = scratch_path(spark, "registered")
    zip_rows(raw(spark, sf_dir, "customers").hint("rebalance"), f"{base}/zips", "Customers")
    _drop_damaged(spark, f"{base}/zips", "Customers")
    layout = Layout(f"{base}/landing", f"{base}/tables")
    jobs.land_archives(spark, layout, f"{base}/zips", RUN_TS)
    jobs.load_raw(spark, layout, "customers", SECOND_TS)
    return _registered(spark, layout, f"{base}/zips")


def landed_registry_retried(spark, sf_dir):
    """The same of a drop whose first landing was lost before it registered anything."""
    return _registered(spark, *_interrupted_landing(spark, sf_dir, "registered-again"))


# Beside the archives of whole rows: an entry without rows, a damaged one, and a file that is no archive.
REGISTERED_SQL = f"""SELECT 'PROCESSED' AS status, CAST(1 AS BIGINT) AS more_entries, CAST(count(*) AS BIGINT) AS row_count,
        CAST(0 AS BIGINT) AS unregistered_files FROM ({raw_sql("customers")})
    UNION ALL SELECT 'SKIPPED', 0, 0, NULL UNION ALL SELECT 'CORRUPT', 1, 0, NULL UNION ALL SELECT 'UNREADABLE', 1, 0, NULL"""

# --- streamed loads ----------------------------------------------------------------------


def stream_ingest_files(spark, sf_dir):
    """Two drops of files, a stream started three times: each row arrives once."""
    base = scratch_path(spark, "stream-copy")
    drops = Drops(raw(spark, sf_dir, "sale_orders"), f"{base}/drops", in_rounds(_early(), _late()))
    for number in range(2):
        drops.arrive(number, f"{base}/landing")
        loads.copy_files(spark, schemas.SALE_ORDERS, f"{base}/landing", f"{base}/rows", f"{base}/checkpoint")
    loads.copy_files(spark, schemas.SALE_ORDERS, f"{base}/landing", f"{base}/rows", f"{base}/checkpoint")
    return read_table(spark, f"{base}/rows").select(*schemas.SALE_ORDERS.fieldNames())


def _stream_raw(spark, base: str, run_ts) -> None:
    loads.ingest_files(
        spark,
        ORDERS,
        f"{base}/landing",
        f"{base}/raw",
        f"{base}/raw-checkpoint",
        audit=f"{base}/audit",
        clock=lambda: run_ts,
    )


def stream_bronze(spark, sf_dir):
    """Two drops of order lines, each validated, deduped, stamped and appended."""
    base = scratch_path(spark, "stream-raw")
    drops = Drops(raw(spark, sf_dir, "sale_orders"), f"{base}/drops", in_rounds(_early(), _late()))
    for number, run_ts in enumerate((RUN_TS, SECOND_TS)):
        drops.arrive(number, f"{base}/landing")
        _stream_raw(spark, base, run_ts)
    return read_table(spark, f"{base}/raw").select(*bronze_columns("sale_orders"), loads.BATCH)


def stream_bronze_malformed(spark, sf_dir):
    """Order lines of which those of one order type have a quantity that is no number: they are set apart in the batch
    that reads them, all others are loaded."""
    base = scratch_path(spark, "stream-malformed")
    layout, rows = Layout(f"{base}/landing", f"{base}/tables"), raw(spark, sf_dir, "sale_orders")
    text = F.when(F.col("ordertype") == "P", "n/a").otherwise(F.col("quantity").cast("string"))
    write_csv(rows.withColumn("quantity", text), layout.arrivals("sale_orders"))
    jobs.load_raw(spark, layout, "sale_orders", RUN_TS, split_malformed=True)
    good = read_table(spark, layout.raw("sale_orders")).select("salesordernumber", "salesorderlinenumber", "quantity", F.lit(0).alias("malformed"))
    bad = read_table(spark, layout.malformed("sale_orders")).withColumn("field", F.split(loads.CORRUPT, ","))
    number = F.element_at("field", 2).cast("int")
    return good.unionByName(bad.select(F.element_at("field", 1).alias("salesordernumber"), number.alias("salesorderlinenumber"), F.lit(None).cast("int").alias("quantity"), F.lit(1).alias("malformed")))


def stream_silver_upsert(spark, sf_dir):
    """Two overlapping drops of order lines, streamed through to the fact table."""
    base = scratch_path(spark, "stream-fact")
    rounds = in_rounds(_early(), F.col("createddate") >= SECOND_START)
    drops = Drops(raw(spark, sf_dir, "sale_orders"), f"{base}/drops", rounds, quantity=F.col("quantity") + F.col(ROUND))
    for number, run_ts in enumerate((RUN_TS, SECOND_TS)):
        drops.arrive(number, f"{base}/landing")
        _stream_raw(spark, base, run_ts)
        loads.upsert_fact(
            spark,
            f"{base}/raw",
            f"{base}/fact",
            f"{base}/fact-checkpoint",
            rejects=f"{base}/rejects",
            partition_columns=("year", "month"),
        )
    return loads.read_fact(spark, f"{base}/fact")


def _in_csv_types(sql: str) -> str:
    return f"SELECT * REPLACE (CAST(unitprice AS DOUBLE) AS unitprice, CAST(taxamount AS DOUBLE) AS taxamount) FROM ({sql})"


QUERIES = {
    "scan_csv_permissive": Query(
        scan_csv_permissive, _raw_typed(quantity="CASE WHEN ordertype = 'P' THEN NULL ELSE quantity END")
    ),
    "scan_table": Query(scan_table, bronze_sql("suppliers")),
    "append_roundtrip": Query(append_roundtrip, APPENDED_SQL),
    "scan_new_loads": Query(
        scan_new_loads, f"SELECT * FROM ({APPENDED_SQL}) WHERE ingestion_timestamp > {RUN_TS_SQL}"
    ),
    "scan_new_batches": Query(
        scan_new_batches, f"SELECT * FROM ({_in_csv_types(APPENDED_SQL)}) WHERE ingestion_timestamp > {RUN_TS_SQL}"
    ),
    "load_ledger": Query(
        load_ledger,
        f"""SELECT CAST(b AS INTEGER) AS ingest_batch, CASE b WHEN 0 THEN {RUN_TS_SQL} ELSE {SECOND_TS_SQL} END AS ingestion_timestamp,
            CAST(sum(n) AS BIGINT) AS read_rows, CAST(0 AS BIGINT) AS malformed_rows, CAST(sum(k) AS BIGINT) AS kept_rows FROM (
            SELECT CASE WHEN {IN_FIRST} THEN 0 ELSE 1 END AS b, CASE WHEN {IN_FIRST} THEN 1 ELSE 2 END AS n, 0 AS k FROM ({raw_sql("sale_orders")})
            UNION ALL SELECT CASE WHEN {IN_FIRST} THEN 0 ELSE 1 END, 0, 1 FROM ({bronze_sql("sale_orders")})) GROUP BY b""",
    ),
    "fact_load_counts": Query(
        fact_load_counts,
        f"""SELECT CAST(CASE WHEN {IN_FIRST} THEN 0 ELSE 1 END AS INTEGER) AS ingest_batch,
            count(*) FILTER (error_description = 'Valid') AS valid_lines, count(*) FILTER (error_description <> 'Valid') AS rejected_lines
            FROM ({labelled_lines_sql()}) GROUP BY 1""",
    ),
    "route_files": Query(route_files, f"SELECT entry, category FROM ({NAMES_SQL})"),
    "landing_path": Query(landing_path, f"SELECT entry, {PATH_SQL} AS file_key FROM ({NAMES_SQL})"),
    "new_files": Query(
        new_files,
        f"""SELECT {PATH_SQL} AS file_key FROM ({NAMES_SQL})
            WHERE category = 'sale_orders' AND o_orderpriority <> '1-URGENT'""",
    ),
    "ingest_audit": Query(
        ingest_audit,
        f"""SELECT ordertype, count(*) AS row_count, min(createddate) AS first_created,
            max(createddate) AS last_created, CAST(7 AS BIGINT) AS batch_id, 'PROCESSED' AS status,
            {RUN_TS_SQL} AS processed_at FROM ({raw_sql("sale_orders")}) GROUP BY ordertype""",
    ),
    "land_archives": Query(land_archives, raw_sql("customers")),
    "land_archives_same_name": Query(land_archives_same_name, raw_sql("customers")),
    "land_archives_retried": Query(
        land_archives_retried, f"SELECT {columns(schemas.CUSTOMERS.fieldNames())}, 0 AS ingest_batch FROM ({bronze_sql('customers')})"
    ),
    "landed_registry": Query(landed_registry, REGISTERED_SQL),
    "landed_registry_retried": Query(landed_registry_retried, REGISTERED_SQL),
    "expand_archives": Query(expand_archive_rows, raw_sql("customers")),
    "stream_ingest_files": Query(stream_ingest_files, _raw_typed()),
    "stream_bronze": Query(
        stream_bronze,
        f"""SELECT *, CASE WHEN createddate < TIMESTAMP '{FIRST_END} 00:00:00' THEN 0 ELSE 1 END AS ingest_batch
            FROM ({_in_csv_types(APPENDED_SQL)})""",
    ),
    "stream_bronze_malformed": Query(
        stream_bronze_malformed,
        f"""SELECT salesordernumber, salesorderlinenumber, quantity, 0 AS malformed FROM ({bronze_sql("sale_orders")}) WHERE ordertype <> 'P'
            UNION ALL SELECT salesordernumber, salesorderlinenumber, NULL, 1 FROM ({raw_sql("sale_orders")}) WHERE ordertype = 'P'""",
    ),
    "stream_silver_upsert": Query(
        stream_silver_upsert,
        f"""SELECT * REPLACE (CASE WHEN {IN_SECOND} THEN quantity + 1 ELSE quantity END AS quantity)
            FROM ({fact_sql()})""",
    ),
}
