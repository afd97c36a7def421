"""Reports kept up with the fact table by the groups that its loads touch.

For each report the lines are summed up once, by the ids of its dimensions, its period and the order: the
partial sums, partitioned like the fact table. A load of lines replaces the partial sums of the fact
partitions that it touched. The groups met by these, before and after, and by the ids whose names changed
since the last refresh, are computed anew from partial sums; all other groups stay as they are. So a refresh
reads no fact partition that no load touched, whatever changed in the dimensions.

A refresh that is interrupted leaves its list of groups behind, and the next one adds it to its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saleslayers.operators.history import current_rows
from saleslayers.operators.merge import keys_match
from saleslayers.operators.rows import conform_to, timestamp
from saleslayers.plans import gold
from saleslayers.schemas import BIGINT, STRING
from saleslayers.session import scratch_path
from saleslayers.sinks.tables import (
    LINES,
    append,
    drop_folder,
    drop_old_versions,
    finish_replacement,
    partitions_of,
    read_version,
    replace_partitions,
    rows_in_partitions,
    versions,
    write_version,
    written,
)
from saleslayers.sources.tables import read_table_or_empty

#: The partition of a report table: the month of its groups, or one for reports without a period.
PART = "report_part"
WHOLE = "all"

_ORDER = "salesordernumber"
_DONE = StructType().add("changes", BIGINT)


@dataclass(frozen=True)
class Names:
    """What a report takes from a dimension: the fact column of its id, and columns by their name in the report."""

    table: str
    id: str
    columns: dict[str, str]


@dataclass(frozen=True)
class Plan:
    """How a report is kept up: its dimensions, its period (a column of the report and its expression over lines),
    whether it counts orders, the partition of a group, and which fact partitions hold a group (partition
    columns as expressions over its period)."""

    names: tuple[Names, ...]
    period: str | None = None
    of_line: str = ""
    orders: bool = True
    part: str = f"'{WHOLE}'"
    held_by: dict[str, str] = field(default_factory=dict)


def _day(period: str) -> dict[str, str]:
    return {"year": f"year({period})", "month": f"month({period})", "day": f"dayofmonth({period})"}


_SUPPLIER = Names("suppliers", "supplier_id", {"supplier_id": "supplier_id", "supplier_name": "supplier_name"})

PLANS = {
    "sales_summary": Plan(
        (
            Names("customers", "customer_id", {"customer_name": "customer_name"}),
            Names("products", "product_id", {"product_name": "product_name"}),
            Names("suppliers", "supplier_id", {"supplier_name": "supplier_name"}),
            Names("warehouses", "warehouse_id", {"warehouse_name": "warehouse_name"}),
        ),
        "sale_date",
        "to_date(createddate)",
        orders=False,
        part="date_format(sale_date, 'yyyy-MM')",
        held_by=_day("sale_date"),
    ),
    "by_country": Plan((Names("customers", "customer_id", {"country": "country"}),)),
    "by_supplier_daily": Plan((_SUPPLIER,), "sales_date", "to_date(createddate)", part="date_format(sales_date, 'yyyy-MM')", held_by=_day("sales_date")),
    "by_supplier_monthly": Plan((_SUPPLIER,), "sales_month", "date_format(createddate, 'yyyy-MM')", part="sales_month", held_by={"year": "int(substr(sales_month, 1, 4))", "month": "int(substr(sales_month, 6, 2))"}),
}


def _line_id(names: Names) -> str:
    """The id of a line; the report may have the dimension's own id under the plain name."""
    return f"line_{names.id}"


def partial_sums(fact: DataFrame, plan: Plan, partition_columns: Sequence[str]) -> DataFrame:
    """Lines summed up by ids, period and, where orders are counted, order."""
    ids = [F.col(n.id).alias(_line_id(n)) for n in plan.names]
    period = [F.expr(plan.of_line).alias(plan.period)] if plan.period else []
    order = [F.col(_ORDER)] if plan.orders else []
    amount = F.sum(F.col("quantity") * F.col("unitprice")).alias("amount")
    return fact.groupBy(*partition_columns, *ids, *period, *order).agg(F.sum("quantity").alias("quantity"), amount, F.sum("taxamount").alias("tax"))


def named(partials: DataFrame, plan: Plan, names: dict[str, DataFrame]) -> DataFrame:
    """Partial sums with the columns of the report's dimensions instead of their ids; unknown ids have NULLs."""
    rows = partials
    for n in plan.names:
        rows = rows.join(names[n.table].withColumnRenamed("id", _line_id(n)), _line_id(n), "left")
    return rows.drop(*[_line_id(n) for n in plan.names])


def groups(partials: DataFrame, plan: Plan) -> DataFrame:
    """The report's groups from named partial sums."""
    keys = [c for n in plan.names for c in n.columns] + ([plan.period] if plan.period else [])
    measures = [
        F.sum("quantity").alias("total_quantity_sold"),
        F.sum("amount").cast("double").alias("total_sales_amount"),
        F.sum("tax").cast("double").alias("total_tax_collected"),
    ]
    orders = [F.count_distinct(_ORDER).alias("total_orders")] if plan.orders else []
    return partials.groupBy(*keys).agg(*measures, *orders)


def names_of(star: gold.Star, names: Names) -> DataFrame:
    """id and the report's columns of the current rows of a dimension."""
    rows = current_rows(getattr(star, names.table))
    return rows.select(F.col(names.id).alias("id"), *[F.col(old).alias(new) for new, old in names.columns.items()])


@dataclass(frozen=True)
class Tables:
    """Where a report and what keeps it up lie."""

    report: str
    partials: str
    runs: str

    @property
    def done(self) -> str:
        return f"{self.runs}/done"

    def run(self, number: int, what: str) -> str:
        return f"{self.runs}/run={number}/{what}"


def read_report(spark: SparkSession, report: gold.Report, tables: Tables) -> DataFrame:
    """The report table as the last refresh left it; no rows before the first."""
    return _stored(spark, report, tables).select(*report.schema.fieldNames())


def _stored(spark: SparkSession, report: gold.Report, tables: Tables) -> DataFrame:
    return read_table_or_empty(spark, tables.report, StructType([*report.schema.fields]).add(PART, STRING))


def refresh(
    star: gold.Star, report: gold.Report, tables: Tables, changes: str, run_ts: datetime, partition_columns: Sequence[str]
) -> None:
    """Brings a report up to the fact table's recorded changes and the dimensions' current rows.

    `changes` holds the partitions that loads of the fact table touched, by batch. The first refresh sums up the
    whole fact table. Groups that changed get `run_ts` as their update time, new ones as their creation time;
    a group without lines goes. Refreshing again without changes writes nothing.
    """
    _Refresh(star, report, tables, run_ts, partition_columns).run(changes)


class _Refresh:
    def __init__(self, star: gold.Star, report: gold.Report, tables: Tables, run_ts: datetime, partition_columns: Sequence[str]) -> None:
        self.spark, self.fact = star.fact.sparkSession, star.fact
        self.report, self.plan, self.tables, self.run_ts = report, PLANS[report.name], tables, run_ts
        self.partition_columns = list(partition_columns)
        for root, columns in ((tables.partials, self.partition_columns), (tables.report, [PART])):
            finish_replacement(self.spark, root, columns)
        known = versions(self.spark, tables.done)
        self.first, self.number = not known, max(known, default=0) + 1
        self.now = {n.table: names_of(star, n) for n in self.plan.names}
        self.before = {table: read_table_or_empty(self.spark, tables.run(self.number - 1, table), rows.schema) for table, rows in self.now.items()}
        #: Layout of the partial sums, without reading anything.
        self.sums_schema = partial_sums(self.fact.limit(0), self.plan, self.partition_columns).schema

    def run(self, changes: str) -> None:
        seen = -1 if self.first else read_version(self.spark, self.tables.done, _DONE).first()["changes"]
        schema = StructType([self.fact.schema[c] for c in self.partition_columns]).add(LINES, BIGINT).add("ingest_batch", BIGINT)
        log = read_table_or_empty(self.spark, changes, schema).filter(F.col("ingest_batch") > seen)
        newest = log.agg(F.max("ingest_batch")).first()[0]
        if self.first:
            self._replace_sums(self.fact)
            self._write(groups(self._named(self._partials(), self.now), self.plan), self._report().limit(0))
        else:
            moved = self._moved()
            if newest is None and not moved and self._recorded().isEmpty():
                return
            with written(partitions_of(log, self.partition_columns), scratch_path(self.spark, "touched")) as touched:
                self._apply(touched, moved)
            self._write_recorded()
        for table, rows in self.now.items():
            rows.write.mode("overwrite").parquet(self.tables.run(self.number, table))
        write_version(self.spark.createDataFrame([(seen if newest is None else newest,)], _DONE), self.tables.done)
        self._forget()

    def _apply(self, touched: DataFrame, moved: dict[str, DataFrame]) -> None:
        """Puts the groups that change on record, then replaces the partial sums of the touched partitions."""
        fact = rows_in_partitions(self.fact, touched, self.partition_columns)
        with written(partial_sums(fact, self.plan, self.partition_columns), scratch_path(self.spark, "partial-sums")) as sums:
            of_moved = [self._of_ids(table, ids) for table, ids in moved.items()]
            old = [rows_in_partitions(self._partials(), touched, self.partition_columns), *of_moved]
            keys = [self._keys(self._named(rows, self.before)) for rows in old] + [self._keys(self._named(rows, self.now)) for rows in [sums, *of_moved]]
            append(reduce(DataFrame.union, keys).distinct(), self.tables.run(self.number, "groups"))
            replace_partitions(sums, self.tables.partials, self.partition_columns)

    def _replace_sums(self, fact: DataFrame) -> None:
        replace_partitions(partial_sums(fact, self.plan, self.partition_columns), self.tables.partials, self.partition_columns)

    def _write_recorded(self) -> None:
        """Computes the recorded groups anew and replaces the partitions of the report that hold them."""
        with written(self._recorded().distinct(), scratch_path(self.spark, "groups")) as keys:
            held_by = {c: e for c, e in self.plan.held_by.items() if c in self.partition_columns}
            partials = self._partials()
            if held_by:
                where = partitions_of(keys.select(*[F.expr(e).alias(c) for c, e in held_by.items()]), [*held_by])
                partials = rows_in_partitions(partials, where, [*held_by])
            same = keys_match("n", "k", self.report.keys)
            rows = self._named(partials, self.now).alias("n").join(keys.alias("k"), same, "left_semi")
            old = rows_in_partitions(self._report(), partitions_of(keys, [PART]), [PART])
            kept = old.alias("n").join(keys.alias("k"), same, "left_anti")
            self._write(groups(rows, self.plan), old, kept)

    def _write(self, rows: DataFrame, old: DataFrame, kept: DataFrame | None = None) -> None:
        """Groups with their times into the partitions of the report, beside those that stay."""
        times = dict.fromkeys(("created_at", "updated_at", "last_updated"), timestamp(self.run_ts))
        names = self.report.schema.fieldNames()
        fresh = gold.refresh_report(old.select(*names), conform_to(rows.withColumns(times), self.report.schema), self.report)
        whole = fresh.withColumn(PART, F.expr(self.plan.part))
        replace_partitions(whole if kept is None else whole.unionByName(kept), self.tables.report, [PART])

    def _forget(self) -> None:
        """Deletes what only refreshes before the last one needed."""
        drop_folder(self.spark, self.tables.run(self.number - 1, ""))
        drop_folder(self.spark, self.tables.run(self.number, "groups"))
        drop_old_versions(self.spark, self.tables.done, keep=1)

    def _partials(self) -> DataFrame:
        return read_table_or_empty(self.spark, self.tables.partials, self.sums_schema)

    def _report(self) -> DataFrame:
        return _stored(self.spark, self.report, self.tables)

    def _recorded(self) -> DataFrame:
        """The groups that this refresh, or an interrupted attempt at it, has found to change."""
        schema = StructType([self.report.schema[k] for k in self.report.keys]).add(PART, STRING)
        return read_table_or_empty(self.spark, self.tables.run(self.number, "groups"), schema)

    def _named(self, partials: DataFrame, names: dict[str, DataFrame]) -> DataFrame:
        return named(partials, self.plan, names)

    def _keys(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.report.keys, F.expr(self.plan.part).alias(PART))

    def _of_ids(self, table: str, ids: DataFrame) -> DataFrame:
        line_id = next(_line_id(n) for n in self.plan.names if n.table == table)
        return self._partials().join(ids.withColumnRenamed("id", line_id), line_id, "left_semi")

    def _moved(self) -> dict[str, DataFrame]:
        """By dimension the ids whose names are not what they were; dimensions without such ids are left out."""
        found = {}
        for n in self.plan.names:
            before, now = self.before[n.table], self.now[n.table]
            same = keys_match("old", "new", ["id", *n.columns])
            changed = [a.alias("old").join(b.alias("new"), same, "left_anti").select("id") for a, b in ((before, now), (now, before))]
            ids = changed[0].union(changed[1]).distinct()
            if not ids.isEmpty():
                found[n.table] = ids
        return found
