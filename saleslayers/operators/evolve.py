"""Schema evolution of tables as DataFrame rewrites.

A step is plain data: {"action": ..., ...}. Steps fold into one projection, so a table is
rewritten once however many there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from saleslayers.operators.rows import timestamp
from saleslayers.schemas import MIGRATION_LEDGER
from saleslayers.sinks.tables import laid_out

Step = Mapping[str, object]

ZONES = ("bronze", "silver", "gold")

_INTEGERS = [ByteType(), ShortType(), IntegerType(), LongType()]
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}


@dataclass(frozen=True)
class Evolved:
    """A table after some steps: its rows and how it is to be written."""

    df: DataFrame
    partition_by: tuple[str, ...] = ()
    location: str | None = None
    properties: dict[str, str] = field(default_factory=dict)

    def write(self, path: str | None = None) -> None:
        """Writes the evolved table, to its new location unless a path is given."""
        target = path or self.location
        if target is None:
            raise ValueError("no path to write to")
        laid_out(self.df, self.partition_by).write.mode("overwrite").partitionBy(*self.partition_by).parquet(target)

    def save_as_table(self, name: str) -> None:
        """Creates or replaces a catalog table, with the location and properties of the steps."""
        writer = laid_out(self.df, self.partition_by).write.mode("overwrite").partitionBy(*self.partition_by)
        if self.location:
            writer = writer.option("path", self.location)
        writer.format("parquet").saveAsTable(name)
        if self.properties:
            pairs = ", ".join(f"'{k}'='{v}'" for k, v in self.properties.items())
            self.df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def data_type(name: str) -> DataType:
    return StructType.fromDDL(f"c {name}")[0].dataType


def is_widening(old: DataType, new: DataType) -> bool:
    """Whether every value of the old type is a value of the new one."""
    if old == new:
        return True
    if old in _INTEGERS and new in _INTEGERS:
        return _INTEGERS.index(old) < _INTEGERS.index(new)
    if old in _INTEGERS and isinstance(new, DecimalType):
        return new.precision - new.scale >= _DIGITS[old.simpleString()]
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return (old, new) in (
        (FloatType(), DoubleType()),
        (ByteType(), FloatType()),
        (ShortType(), FloatType()),
        (ByteType(), DoubleType()),
        (ShortType(), DoubleType()),
        (IntegerType(), DoubleType()),
        (DateType(), TimestampType()),
        (DateType(), TimestampNTZType()),
    )


def _require(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")


def _require_absent(df: DataFrame, name: str) -> None:
    if name.lower() in [c.lower() for c in df.columns]:
        raise ValueError(f"column exists: {name}")


def add_column(table: Evolved, name: str, type: str) -> Evolved:
    _require_absent(table.df, name)
    return replace(table, df=table.df.withColumn(name, F.lit(None).cast(data_type(type))))


def drop_column(table: Evolved, name: str) -> Evolved:
    _require(table.df, name)
    if name in table.partition_by:
        raise ValueError(f"partition column: {name}")
    return replace(table, df=table.df.drop(name))


def rename_column(table: Evolved, old_name: str, new_name: str) -> Evolved:
    _require(table.df, old_name)
    if new_name.lower() != old_name.lower():
        _require_absent(table.df, new_name)
    partitions = tuple(new_name if c == old_name else c for c in table.partition_by)
    return replace(table, df=table.df.withColumnRenamed(old_name, new_name), partition_by=partitions)


def update_column_type(table: Evolved, name: str, new_type: str) -> Evolved:
    """Widening only: narrowing would lose values."""
    _require(table.df, name)
    old, new = table.df.schema[name].dataType, data_type(new_type)
    if not is_widening(old, new):
        raise ValueError(f"{name}: {old.simpleString()} does not widen to {new.simpleString()}")
    return replace(table, df=table.df.withColumn(name, F.col(name).cast(new)))


def update_partition(table: Evolved, partitioned_by: Sequence[str]) -> Evolved:
    _require(table.df, *partitioned_by)
    return replace(table, partition_by=tuple(partitioned_by))


def set_tblproperties(table: Evolved, properties: Mapping[str, object]) -> Evolved:
    return replace(table, properties={**table.properties, **{k: str(v) for k, v in properties.items()}})


def update_location(table: Evolved, location: str) -> Evolved:
    return replace(table, location=location)


# The action names a step may have.
ACTIONS = {
    "add_column": add_column,
    "drop_column": drop_column,
    "rename_column": rename_column,
    "update_column_type": update_column_type,
    "update_partition": update_partition,
    "set_tblproperties": set_tblproperties,
    "update_location": update_location,
}


def evolve(table: DataFrame | Evolved, steps: Sequence[Step]) -> Evolved:
    """The table after all steps, in order. Nothing is applied when one of them is wrong."""
    if not steps:
        raise ValueError("no steps")
    unknown = [s["action"] for s in steps if s["action"] not in ACTIONS]
    if unknown:
        raise ValueError(f"unknown action: {', '.join(map(str, unknown))}")
    evolved = table if isinstance(table, Evolved) else Evolved(table)
    for step in steps:
        arguments = {k: v for k, v in step.items() if k != "action"}
        evolved = ACTIONS[step["action"]](evolved, **arguments)
    return evolved


def schema_of(columns: Sequence[Mapping[str, str]]) -> StructType:
    """The row type of a table spec: [{"name": ..., "type": ...}, ...]."""
    schema = StructType()
    for column in columns:
        schema = schema.add(column["name"], data_type(column["type"]))
    return schema


def create_table(spark: SparkSession, spec: Mapping[str, object]) -> Evolved:
    """An empty table from a spec with columns and, optionally, partitioned_by and location."""
    schema = schema_of(spec["columns"])
    empty = spark.createDataFrame([], schema)
    return Evolved(empty, tuple(spec.get("partitioned_by") or ()), spec.get("location"))


# --- which evolutions are still to be applied ------------------------------------------


@dataclass(frozen=True)
class Migration:
    """A named change of one table: a "create" with a spec, or an "alter" with steps."""

    zone: str
    name: str
    table: str
    spec: Mapping[str, object]

    @property
    def filename(self) -> str:
        """Ledger key: the zone keeps equal names of different zones apart."""
        return f"{self.zone}/{self.name}"

    @property
    def kind(self) -> str:
        return str(self.spec.get("type", "create"))

    @property
    def steps(self) -> Sequence[Step]:
        return self.spec.get("alterations") or self.spec.get("actions") or ()


def pending(names: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of `names` (column filename) that the ledger does not hold."""
    return names.join(ledger.select("filename"), "filename", "left_anti")


def ledger_rows(names: DataFrame, run_ts: datetime) -> DataFrame:
    """Rows to append to the ledger."""
    return names.select("filename", timestamp(run_ts).alias("applied_at"))


def migrate(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | Evolved],
    ledger: DataFrame,
    migrations: Sequence[Migration],
    run_ts: datetime,
) -> tuple[dict[str, Evolved], DataFrame]:
    """Tables and ledger after all pending migrations: by zone, then by name, each once.

    The first failing migration raises, so nothing after it is applied or recorded. The result
    is a plan; writing the returned tables and then the ledger makes it lasting.
    """
    ordered = sorted(migrations, key=lambda m: (ZONES.index(m.zone), m.name))
    names = spark.createDataFrame([(m.filename,) for m in ordered], "filename STRING")
    open_names = {row.filename for row in pending(names, ledger).collect()}
    evolved = {name: t if isinstance(t, Evolved) else Evolved(t) for name, t in tables.items()}
    for migration in ordered:
        if migration.filename not in open_names:
            continue
        if migration.kind == "create":
            if migration.table not in evolved:
                evolved[migration.table] = create_table(spark, migration.spec)
        elif migration.kind == "alter":
            evolved[migration.table] = evolve(evolved[migration.table], migration.steps)
        else:
            raise ValueError(f"unknown migration type: {migration.kind}")
    applied = spark.createDataFrame([(n,) for n in sorted(open_names)], "filename STRING")
    after = ledger.select(*MIGRATION_LEDGER.fieldNames()).unionByName(ledger_rows(applied, run_ts))
    return evolved, after
