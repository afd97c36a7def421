"""Migrations of stored tables: once, in order, and again after a crash."""

from datetime import datetime, timezone

import pytest
from conftest import as_set

from saleslayers.operators.evolve import Evolved, Migration
from saleslayers.plans import migrations
from saleslayers.plans.migrations import load, read_table, run_migrations, store
from saleslayers.sinks.tables import versions

RUN_TS = datetime(2025, 1, 1, tzinfo=timezone.utc)


def alter(name, *steps):
    return Migration("silver", name, "t", {"type": "alter", "alterations": list(steps)})


ADD = {"action": "add_column", "name": "c", "type": "INT"}
DROP = {"action": "drop_column", "name": "b"}


@pytest.fixture
def root(spark, tmp_path):
    store(Evolved(spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")), f"{tmp_path}/tables/t")
    return str(tmp_path)


def test_added_and_dropped_columns_rewrite_nothing(spark, root):
    assert run_migrations(spark, root, [alter("1", ADD, DROP)], RUN_TS) == ["silver/1"]
    assert as_set(read_table(spark, root, "t")) == [(1, None), (2, None)]
    assert versions(spark, f"{root}/tables/t/data") == [1]
    # A column that comes back is empty, though the files still have the old one.
    run_migrations(spark, root, [alter("2", {"action": "add_column", "name": "B", "type": "STRING"})], RUN_TS)
    assert as_set(read_table(spark, root, "t")) == [(1, None, None), (2, None, None)]
    assert run_migrations(spark, root, [alter("1", ADD, DROP)], RUN_TS) == []


def test_crash_between_table_and_ledger(spark, root, monkeypatch):
    steps = alter("1", {"action": "rename_column", "old_name": "b", "new_name": "d"}, {"action": "update_column_type", "name": "a", "new_type": "BIGINT"})

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(migrations, "append", crash)
        with pytest.raises(OSError):
            run_migrations(spark, root, [steps], RUN_TS)
    assert run_migrations(spark, root, [steps], RUN_TS) == ["silver/1"]
    assert read_table(spark, root, "t").schema.simpleString() == "struct<a:bigint,d:string>"
    assert versions(spark, f"{root}/tables/t/data") == [1, 2]


def test_a_failing_migration_stops_the_run(spark, root):
    good, bad, late = alter("1", ADD), alter("2", {"action": "drop_column", "name": "none"}), alter("3", DROP)
    with pytest.raises(ValueError, match="none"):
        run_migrations(spark, root, [late, bad, good], RUN_TS)
    assert load(spark, f"{root}/tables/t").applied == ("silver/1",)
    create = Migration("bronze", "9", "u", {"columns": [{"name": "x", "type": "int"}]})
    assert run_migrations(spark, root, [create, good], RUN_TS) == ["bronze/9"]
    assert read_table(spark, root, "u").count() == 0
