"""Keyed upsert as joins, for tables whose catalog has no MERGE of its own."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Assignments = Sequence[str] | Mapping[str, "Column | str"]

_KNOWN = "__known"
_HIT = "__source_row"


def fail_on_copies(source: DataFrame, keys: Sequence[str], layout: StructType) -> DataFrame:
    """No rows, in the given layout; reading them fails when two source rows share a key.

    NULL keys are equal. Counting combines on the map side, so many copies of one key cost
    nothing more, and only the key columns are read.
    """
    copies = source.groupBy(*keys).agg(F.count("*").alias("__copies"))
    message = F.concat(
        F.lit(f"merge source has several rows for one key ({', '.join(keys)}): "), F.col("__copies").cast("string")
    )
    failing = copies.filter(F.when(F.col("__copies") > 1, F.raise_error(message).cast("boolean")).otherwise(False))
    return failing.select(
        *[(F.col(f.name) if f.name in keys else F.lit(None)).cast(f.dataType).alias(f.name) for f in layout]
    )


def keys_match(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of the key columns of two aliased frames."""
    return reduce(and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _expressions(assignments: Assignments, side: str) -> dict[str, Column]:
    """Column names stand for the column of that name on `side`; values may be any expression."""
    if not isinstance(assignments, Mapping):
        assignments = {name: f"{side}.{name}" for name in assignments}
    return {name: F.col(v) if isinstance(v, str) else v for name, v in assignments.items()}


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    set: Assignments | None = None,
    when: Column | None = None,
    insert: Assignments | None = None,
    check_unique: bool = True,
    unique_target: bool = False,
) -> DataFrame:
    """The target table after an upsert from `source`.

    keys          matched null-safely: a NULL key equals a NULL key
    set           columns to update on a match: names (taken from the source) or
                  {column: expression over "tgt.x" and "src.x"}; None updates nothing
    when          extra condition for the update, over "tgt.x" and "src.x"
    insert        columns of a new row: names or {column: expression over "src.x"}; other
                  columns are NULL; None means every target column, by name
    check_unique  fail when two source rows share a key; pass False only for a source that
                  is unique by construction (saves a pass over its keys)
    unique_target  True states that the target has one row per key: target and source then
                  meet in one full outer join, and each is evaluated and shuffled once

    The result has the target's columns and types.

    Shape otherwise: target LEFT JOIN source, plus source ANTI JOIN the keys found in the target. A
    small source is broadcast by its measured size and the joins then do not shuffle the target;
    for a large one both sides shuffle on the keys, and a key with very many target rows
    sits on the left side of its joins, where adaptive execution can split it.
    """
    updates = _expressions(set or {}, "src")
    inserts = _expressions(insert if insert is not None else target.columns, "src")
    unknown = [c for c in [*updates, *inserts] if c not in target.columns]
    if unknown:
        raise ValueError(f"not a column of the target: {', '.join(unknown)}")

    if unique_target:
        after = _merge_unique(target, source, keys, updates, inserts, when)
        return after.unionByName(fail_on_copies(source, keys, target.schema)) if check_unique else after

    kept = target
    if updates:
        hit = F.col(f"src.{_HIT}").isNotNull()
        applies = hit if when is None else hit & when
        kept = (
            target.alias("tgt")
            .join(source.withColumn(_HIT, F.lit(True)).alias("src"), keys_match("tgt", "src", keys), "left")
            .select(
                *[
                    F.when(applies, updates[f.name].cast(f.dataType)).otherwise(F.col(f"tgt.{f.name}")).alias(f.name)
                    if f.name in updates
                    else F.col(f"tgt.{f.name}")
                    for f in target.schema
                ]
            )
        )

    found = (
        target.select(*keys)
        .distinct()
        .alias("tgt")
        .join(source.select(*keys).alias("src"), keys_match("tgt", "src", keys), "left_semi")
    )
    added = (
        source.alias("src")
        .join(found.alias("found"), keys_match("src", "found", keys), "left_anti")
        .select(*[inserts.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema])
    )
    after = kept.unionByName(added)
    return after.unionByName(fail_on_copies(source, keys, target.schema)) if check_unique else after


def _merge_unique(
    target: DataFrame, source: DataFrame, keys: Sequence[str], updates: dict[str, Column], inserts: dict[str, Column], when: Column | None
) -> DataFrame:
    known, hit = F.col(f"tgt.{_KNOWN}").isNotNull(), F.col(f"src.{_HIT}").isNotNull()
    applies = hit if when is None else hit & when
    joined = (
        target.withColumn(_KNOWN, F.lit(True))
        .alias("tgt")
        .join(source.withColumn(_HIT, F.lit(True)).alias("src"), keys_match("tgt", "src", keys), "full")
    )

    def value(name: str) -> Column:
        old, new = F.col(f"tgt.{name}"), inserts.get(name, F.lit(None))
        changed = F.when(applies, updates[name]).otherwise(old) if name in updates else old
        return F.when(known, changed).otherwise(new)

    return joined.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in target.schema])


def merge_into_table(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    *,
    set: Assignments | None = None,
    when: Column | None = None,
    insert: Assignments | None = None,
) -> None:
    """The same upsert, run by the table's own MERGE (catalogs with row-level operations).

    `table` is aliased "tgt" through its name: in `when` and `set` write the target's columns
    as "<table>.x" and the source's as "src.x".
    """
    on = reduce(and_, [F.col(f"{table}.{k}").eqNullSafe(F.col(f"src.{k}")) for k in keys])
    writer = source.alias("src").mergeInto(table, on)
    if set:
        matched = writer.whenMatched() if when is None else writer.whenMatched(when)
        writer = matched.update(_expressions(set, "src"))
    unmatched = writer.whenNotMatched()
    writer = unmatched.insertAll() if insert is None else unmatched.insert(_expressions(insert, "src"))
    writer.merge()
