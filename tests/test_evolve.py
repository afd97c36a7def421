from datetime import datetime, timezone
from decimal import Decimal

import pytest
from conftest import as_set

from saleslayers.operators.evolve import (
    Evolved,
    Migration,
    create_table,
    data_type,
    evolve,
    is_widening,
    migrate,
    pending,
)
from saleslayers.schemas import MIGRATION_LEDGER

RUN_TS = datetime(2025, 1, 1, tzinfo=timezone.utc)


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(1, "x", Decimal("1.50")), (2, None, None)], "a int, b string, c decimal(5,2)")


def test_add_drop_rename_widen(spark, table):
    got = evolve(
        table,
        [
            {"action": "add_column", "name": "d", "type": "INT"},
            {"action": "drop_column", "name": "b"},
            {"action": "rename_column", "old_name": "a", "new_name": "id"},
            {"action": "update_column_type", "name": "id", "new_type": "BIGINT"},
            {"action": "update_column_type", "name": "c", "new_type": "DECIMAL(7,2)"},
        ],
    ).df
    assert got.schema.simpleString() == "struct<id:bigint,c:decimal(7,2),d:int>"
    assert as_set(got) == sorted([(1, Decimal("1.50"), None), (2, None, None)], key=repr)


@pytest.mark.parametrize(
    "steps",
    [
        [],
        [{"action": "explode_column", "name": "a"}],
        [{"action": "add_column", "name": "A", "type": "int"}],
        [{"action": "drop_column", "name": "zz"}],
        [{"action": "rename_column", "old_name": "a", "new_name": "b"}],
        [{"action": "update_column_type", "name": "b", "new_type": "int"}],
        [{"action": "update_column_type", "name": "c", "new_type": "decimal(5,1)"}],
        [{"action": "update_partition", "partitioned_by": ["zz"]}],
        [{"action": "update_partition", "partitioned_by": ["a"]}, {"action": "drop_column", "name": "a"}],
    ],
)
def test_wrong_steps_are_refused(table, steps):
    with pytest.raises(ValueError):
        evolve(table, steps)


@pytest.mark.parametrize(
    "old, new, allowed",
    [
        ("int", "bigint", True),
        ("bigint", "int", False),
        ("float", "double", True),
        ("int", "double", True),
        ("bigint", "double", False),
        ("int", "decimal(10,0)", True),
        ("int", "decimal(9,0)", False),
        ("decimal(5,2)", "decimal(6,3)", True),
        ("decimal(5,2)", "decimal(5,3)", False),
        ("string", "string", True),
        ("string", "int", False),
        ("date", "timestamp", True),
    ],
)
def test_widening(spark, old, new, allowed):
    assert is_widening(data_type(old), data_type(new)) is allowed


def test_repartition_properties_and_location(spark, table, tmp_path):
    steps = [
        {"action": "update_partition", "partitioned_by": ["a"]},
        {"action": "rename_column", "old_name": "a", "new_name": "key"},
        {"action": "set_tblproperties", "properties": {"read.split.target-size": 134217728}},
        {"action": "update_location", "location": str(tmp_path / "moved")},
    ]
    evolved = evolve(table, steps)
    evolved.save_as_table("evolved_table")
    assert sorted(p.name for p in (tmp_path / "moved").iterdir() if p.is_dir()) == ["key=1", "key=2"]
    assert as_set(spark.table("evolved_table").select("key", "b")) == sorted([(1, "x"), (2, None)], key=repr)
    shown = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES evolved_table").collect()}
    assert shown["read.split.target-size"] == "134217728"


def test_create_from_spec(spark):
    spec = {"columns": [{"name": "a", "type": "INT"}, {"name": "b", "type": "decimal(7,4)"}], "partitioned_by": ["a"]}
    made = create_table(spark, spec)
    assert made.df.schema.simpleString() == "struct<a:int,b:decimal(7,4)>" and made.partition_by == ("a",)
    assert made.df.count() == 0


MIGRATIONS = [
    Migration("silver", "001_create", "t", {"columns": [{"name": "a", "type": "int"}]}),
    Migration("bronze", "002_add", "raw", {"type": "alter", "alterations": [{"action": "add_column", "name": "n", "type": "int"}]}),
    Migration("silver", "002_add", "t", {"type": "alter", "actions": [{"action": "add_column", "name": "n", "type": "int"}]}),
]


def test_each_migration_once_in_order(spark):
    empty = spark.createDataFrame([], MIGRATION_LEDGER)
    raw = {"raw": spark.createDataFrame([(1,)], "a int")}
    tables, ledger = migrate(spark, raw, empty, MIGRATIONS, RUN_TS)
    assert tables["t"].df.columns == ["a", "n"] and tables["raw"].df.columns == ["a", "n"]
    names = ["bronze/002_add", "silver/001_create", "silver/002_add"]
    assert sorted(r.filename for r in ledger.collect()) == names
    again, same = migrate(spark, tables, ledger, MIGRATIONS, RUN_TS)
    assert again["t"].df.columns == ["a", "n"] and same.count() == 3
    assert pending(spark.createDataFrame([(n,) for n in [*names, "gold/x"]], "filename string"), ledger).collect() == [("gold/x",)]


def test_failing_migration_stops_the_rest(spark):
    bad = Migration("bronze", "000_bad", "raw", {"type": "alter", "actions": []})
    with pytest.raises(ValueError):
        migrate(spark, {"raw": Evolved(spark.range(1))}, spark.createDataFrame([], MIGRATION_LEDGER), [bad, *MIGRATIONS], RUN_TS)
    odd = Migration("bronze", "000_odd", "raw", {"type": "vacuum"})
    with pytest.raises(ValueError, match="vacuum"):
        migrate(spark, {"raw": Evolved(spark.range(1))}, spark.createDataFrame([], MIGRATION_LEDGER), [odd], RUN_TS)
