"""Schema evolution of stored tables: pending migrations are applied once, in order, and recorded.

A stored table is a folder of data versions beside a folder of specs, each one row: the read schema, the
data version it belongs to, the partitions, and the migrations it includes. Adding or dropping a column
writes a spec only: Parquet reads a missing column as NULL and skips an unwanted one. A rename, another
type or other partitions write the next data version, whole, before the spec that names it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from saleslayers.operators.evolve import ZONES, Evolved, Migration, create_table, evolve, ledger_rows, pending
from saleslayers.schemas import MIGRATION_LEDGER
from saleslayers.sinks.tables import append, read_version, versions, write_version
from saleslayers.sources.tables import read_table_or_empty

SCHEMA_ONLY = ("add_column", "drop_column", "set_tblproperties")
_SPEC = StructType().add("spec", "string")


@dataclass(frozen=True)
class Stored:
    """A stored table as its newest complete spec describes it."""

    root: str
    schema: StructType
    files: StructType
    data: int
    partition_by: tuple[str, ...] = ()
    properties: tuple[tuple[str, str], ...] = ()
    applied: tuple[str, ...] = ()

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self.root}/data/version={self.data}")

    def save(self, spark: SparkSession) -> None:
        spec = {
            "schema": self.schema.jsonValue(), "files": self.files.jsonValue(), "data": self.data,
            "partition_by": self.partition_by, "properties": self.properties, "applied": self.applied,
        }
        write_version(spark.createDataFrame([(json.dumps(spec),)], _SPEC), f"{self.root}/spec")


def load(spark: SparkSession, root: str) -> Stored | None:
    """The table below a folder, if there is one."""
    if not versions(spark, f"{root}/spec"):
        return None
    spec = json.loads(read_version(spark, f"{root}/spec", _SPEC).first()["spec"])
    schema, files = (StructType.fromJson(spec[k]) for k in ("schema", "files"))
    pairs = tuple(map(tuple, spec["properties"]))
    return Stored(root, schema, files, spec["data"], tuple(spec["partition_by"]), pairs, tuple(spec["applied"]))


def store(evolved: Evolved, root: str, applied: Sequence[str] = ()) -> Stored:
    """Writes a table's rows as its next data version, and then the spec."""
    spark = evolved.df.sparkSession
    number = write_version(evolved.df, f"{root}/data", evolved.partition_by)
    properties = tuple(sorted(evolved.properties.items()))
    table = Stored(root, evolved.df.schema, evolved.df.schema, number, tuple(evolved.partition_by), properties, tuple(applied))
    table.save(spark)
    return table


def apply(spark: SparkSession, table: Stored | None, root: str, migration: Migration) -> None:
    """One migration of one table; does nothing if the table includes it already."""
    if table and migration.filename in table.applied:
        return
    applied = (*(table.applied if table else ()), migration.filename)
    if migration.kind == "create":
        if table:
            replace(table, applied=applied).save(spark)
        else:
            store(create_table(spark, migration.spec), root, applied)
        return
    if migration.kind != "alter":
        raise ValueError(f"unknown migration type: {migration.kind}")
    if not table:
        raise ValueError(f"no such table: {migration.table}")
    before = Evolved(table.rows(spark), table.partition_by, properties=dict(table.properties))
    after = evolve(before, migration.steps)
    if after.location:
        raise ValueError("a stored table stays below its root")
    added = [str(s.get("name")).lower() for s in migration.steps if s["action"] == "add_column"]
    in_files = {f.name.lower() for f in table.files}
    # A column that was dropped and comes back must not bring its old values with it.
    if all(s["action"] in SCHEMA_ONLY for s in migration.steps) and not in_files.intersection(added):
        properties = tuple(sorted(after.properties.items()))
        replace(table, schema=after.df.schema, properties=properties, applied=applied).save(spark)
    else:
        store(after, root, applied)


def run_migrations(spark: SparkSession, root: str, migrations: Sequence[Migration], run_ts: datetime) -> list[str]:
    """Applies what the ledger below `root` does not hold, by zone, then by name; gives the names.

    Each table is whole before its migration is recorded. If the driver dies in between, the table knows
    the migration and the next run only records it. The first failing one stops the run; those before stay.
    """
    ledger = read_table_or_empty(spark, f"{root}/ledger", MIGRATION_LEDGER)
    names = spark.createDataFrame([(m.filename,) for m in migrations], "filename STRING")
    open_names = {row.filename for row in pending(names, ledger).collect()}  # as many as files of migrations
    done = []
    for migration in sorted(migrations, key=lambda m: (ZONES.index(m.zone), m.name)):
        if migration.filename in open_names:
            place = f"{root}/tables/{migration.table}"
            apply(spark, load(spark, place), place, migration)
            name = spark.createDataFrame([(migration.filename,)], "filename STRING")
            append(ledger_rows(name, run_ts), f"{root}/ledger")
            done.append(migration.filename)
    return done


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return load(spark, f"{root}/tables/{name}").rows(spark)
