import shutil
from datetime import datetime, timezone

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from saleslayers.plans import bronze
from saleslayers.sources.tables import read_table
from saleslayers.streaming import loads

ORDERS = bronze.RAW_TABLES["sale_orders"]
HEADER = ",".join(ORDERS.schema.fieldNames())


def line(order, number, created="2024-09-21", processed="2024-09-24", quantity=1, customer="1", product="1"):
    return f"{order},{number},{created},{processed},M,{quantity},1.5,0.25,{customer},{product},SUP1,WH1"


def drop(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


@pytest.fixture
def job(spark, tmp_path):
    class Job:
        landing = tmp_path / "landing" / "sale_orders_data"

        def ingest(self, month=1, **options):
            return loads.ingest_files(
                spark,
                ORDERS,
                str(self.landing),
                str(tmp_path / "raw"),
                str(tmp_path / "raw-checkpoint"),
                audit=str(tmp_path / "audit"),
                clock=lambda: datetime(2025, month, 1, tzinfo=timezone.utc),
                **options,
            )

        def upsert(self):
            return loads.upsert_fact(
                spark,
                str(tmp_path / "raw"),
                str(tmp_path / "fact"),
                str(tmp_path / "fact-checkpoint"),
                rejects=str(tmp_path / "rejects"),
            )

        def raw(self):
            return read_table(spark, str(tmp_path / "raw"))

        def audit(self):
            return read_table(spark, str(tmp_path / "audit"))

        def fact(self):
            return loads.read_fact(spark, str(tmp_path / "fact"))

        def rejects(self):
            return read_table(spark, str(tmp_path / "rejects"))

        def lose_last_commit(self, name):
            """As after a crash between the write of a batch and its commit."""
            commits = tmp_path / name / "commits"
            last = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
            last.unlink()
            (commits / f".{last.name}.crc").unlink(missing_ok=True)

    return Job()


def test_files_once_over_restarts(job):
    drop(job.landing, "a.csv", line("SO1", 1), line("SO1", 1, processed="2024-09-25", quantity=7), line("SO1", 2), line("", 3))
    job.ingest()
    assert as_set(job.raw().select("salesordernumber", "salesorderlinenumber", "quantity")) == [("SO1", 1, 7), ("SO1", 2, 1)]
    job.ingest(2)
    assert job.raw().count() == 2
    drop(job.landing / "2024", "b.csv", line("SO2", 1))
    job.ingest(3)
    assert job.raw().count() == 3
    audit = {r.file_key.rsplit("/", 1)[1]: (r.row_count, r.status, r.processed_at.month) for r in job.audit().collect()}
    assert audit == {"a.csv": (4, "PROCESSED", 1), "b.csv": (1, "PROCESSED", 3)}


def test_bounded_batches_see_all_files(job):
    for i in range(5):
        drop(job.landing, f"f{i}.csv", line(f"SO{i}", 1))
    job.ingest(max_files=2)
    assert job.raw().count() == 5
    assert job.raw().select(loads.BATCH).distinct().count() == 3


def test_batches_bounded_by_bytes_give_the_rows_of_one(job, spark, tmp_path):
    """Fifty files in several batches, the stream lost after one of them."""
    for i in range(50):
        drop(job.landing, f"f{i:02}.csv", line(f"SO{i}", 1))
    size = (job.landing / "f00.csv").stat().st_size
    job.ingest(max_bytes=str(size * 12), ledger=str(tmp_path / "ledger"))
    job.lose_last_commit("raw-checkpoint")
    job.ingest(2, max_bytes=str(size * 12), ledger=str(tmp_path / "ledger"))
    assert as_set(job.raw().select("salesordernumber")) == sorted([(f"SO{i}",) for i in range(50)], key=repr)
    ledger = read_table(spark, str(tmp_path / "ledger"))
    assert 4 <= ledger.count() <= 6 and ledger.selectExpr("sum(read_rows)", "sum(kept_rows)").first() == (50, 50)


def test_finished_files_move_to_an_archive(job, tmp_path):
    for i in range(3):
        drop(job.landing, f"f{i}.csv", line(f"SO{i}", 1))
        job.ingest(archive=str(tmp_path / "finished"), max_files=1)
    job.ingest(archive=str(tmp_path / "finished"))
    assert as_set(job.raw().select("salesordernumber")) == [("SO0",), ("SO1",), ("SO2",)]
    left, moved = (sorted(p.name for p in (tmp_path / f).rglob("f*.csv")) for f in ("landing", "finished"))
    assert sorted(left + moved) == ["f0.csv", "f1.csv", "f2.csv"] and "f0.csv" in moved


def test_malformed_records_are_set_apart_with_their_file(job, spark, tmp_path):
    other = {"rejects": str(tmp_path / "malformed"), "ledger": str(tmp_path / "ledger")}
    drop(job.landing, "a.csv", line("SO1", 1), line("SO2", 1, quantity="many"), line("SO3", 1) + ",more", "x", line("SO1", 1, processed="2024-09-25"), line("", 5))
    job.ingest(**other)
    drop(job.landing, "empty.csv")
    job.ingest(2, **other)
    assert as_set(job.raw().select("salesordernumber", "quantity")) == [("SO1", 1)]
    bad = read_table(spark, str(tmp_path / "malformed"))
    assert sorted(r.corrupt_record.split(",")[0] for r in bad.collect()) == ["SO2", "SO3", "x"]
    assert {r.source_file.rsplit("/", 1)[-1] for r in bad.collect()} == {"a.csv"}
    counts = {r.ingest_batch: (r.read_rows, r.malformed_rows, r.kept_rows) for r in read_table(spark, str(tmp_path / "ledger")).collect()}
    assert counts.pop(0) == (6, 3, 1) and set(counts.values()) <= {(0, 0, 0)}
    assert job.audit().filter("row_count > 0").count() == 1 and job.audit().first().row_count == 3


def test_repeated_batch_does_not_duplicate(job):
    drop(job.landing, "a.csv", line("SO1", 1), line("SO2", 1))
    job.ingest()
    job.lose_last_commit("raw-checkpoint")
    job.ingest(2)
    assert job.raw().count() == 2 and job.audit().count() == 1


def test_upsert_updates_adds_and_repeats(job):
    drop(job.landing, "a.csv", line("SO1", 1), line("SO1", 2, product="2"), line("SO9", 1, quantity=-1))
    job.ingest()
    job.upsert()
    assert job.fact().count() == 2
    assert [r.error_description for r in job.rejects().collect()] == ["Invalid quantity"]
    # A renamed copy of the file, a correction and a new day.
    shutil.copy(job.landing / "a.csv", job.landing / "copy.csv")
    drop(job.landing, "b.csv", line("SO1", 2, product="2", quantity=5, processed="2024-09-30"), line("SO3", 1, created="2024-09-23"))
    job.ingest(2)
    job.upsert()
    expected = [("SO1", 1, 1), ("SO1", 2, 5), ("SO3", 1, 1)]
    columns = ["salesordernumber", "salesorderlinenumber", "quantity"]
    assert as_set(job.fact().select(*columns)) == expected
    job.lose_last_commit("fact-checkpoint")
    job.upsert()
    job.upsert()
    assert as_set(job.fact().select(*columns)) == expected


def test_copy_is_exactly_once(spark, tmp_path):
    folder = tmp_path / "in"
    for round_ in range(3):
        drop(folder, f"{round_}.csv", line("SO1", 1), line("SO1", 1))
        loads.copy_files(spark, ORDERS.schema, str(folder), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_read_fact_before_first_load(spark, tmp_path):
    assert loads.read_fact(spark, str(tmp_path / "none")).filter(F.lit(True)).count() == 0
