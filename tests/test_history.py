from datetime import datetime, timezone

import pytest
from conftest import as_set
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleslayers.operators.history import Dimension, apply_history, current_rows

SCHEMA = (
    "id int, name string, note string, start_date timestamp, end_date timestamp, is_current boolean, "
    "created_at timestamp, updated_at timestamp"
)
RULE = Dimension("id", ("name",), True)
QUIET = Dimension("id", ("name",), False)
T0, T1, T2, T3 = (datetime(2025, m, 1) for m in (1, 2, 3, 4))


def utc(t):
    return t.replace(tzinfo=timezone.utc)


def batch(spark, t, *rows):
    return spark.createDataFrame([(*r, t, None, True, t, t) for r in rows], SCHEMA)


def start(spark, *rows):
    return apply_history(spark.createDataFrame([], SCHEMA), batch(spark, T0, *rows), RULE, utc(T0))


def test_first_load_then_changes(spark):
    dim = start(spark, (1, "a", "n"), (2, "b", "n"), (3, "c", "n"), (4, None, "n"), (5, "e", "n"))
    after = apply_history(
        dim,
        batch(spark, T1, (1, "A", "m"), (2, "b", "m"), (4, "d", "n"), (5, None, "n"), (6, "f", "n")),
        RULE,
        utc(T1),
    )
    assert as_set(after) == sorted(
        [
            (1, "a", "n", T0, T1, False, T0, T1),  # tracked change: closed ...
            (1, "A", "m", T1, None, True, T1, T1),  # ... and opened again
            (2, "b", "n", T0, None, True, T0, T0),  # untracked change: no version
            (3, "c", "n", T0, None, True, T0, T0),  # not in the batch
            (4, None, "n", T0, T1, False, T0, T1),  # NULL to value
            (4, "d", "n", T1, None, True, T1, T1),
            (5, "e", "n", T0, T1, False, T0, T1),  # value to NULL
            (5, None, "n", T1, None, True, T1, T1),
            (6, "f", "n", T1, None, True, T1, T1),  # new key
        ],
        key=repr,
    )


def test_closing_may_leave_updated_at(spark):
    after = apply_history(start(spark, (1, "a", "n")), batch(spark, T1, (1, "b", "n")), QUIET, utc(T1))
    assert as_set(after.filter("not is_current")) == [(1, "a", "n", T0, T1, False, T0, T0)]


def test_closed_history_is_never_edited_and_key_can_return(spark):
    dim = start(spark, (1, "a", "n"))
    dim = apply_history(dim, batch(spark, T1, (1, "b", "n")), RULE, utc(T1))
    again = apply_history(dim, batch(spark, T2, (1, "a", "n")), RULE, utc(T2))
    closed = [r for r in as_set(again) if not r[5]]
    assert closed == [(1, "a", "n", T0, T1, False, T0, T1), (1, "b", "n", T1, T2, False, T1, T2)]
    assert as_set(current_rows(again)) == [(1, "a", "n", T2, None, True, T2, T2)]


def test_two_batch_rows_for_a_key_fail(spark):
    with pytest.raises(Exception, match="several rows for one key"):
        apply_history(start(spark, (1, "a", "n")), batch(spark, T1, (1, "b", "n"), (1, "c", "n")), RULE, utc(T1)).collect()


def test_history_takes_no_part_in_joins(spark):
    """A key with very many closed versions costs nothing but a copy of its rows."""
    past = spark.range(6000).select(
        F.lit(1).alias("id"),
        F.col("id").cast("string").alias("name"),
        F.lit("n").alias("note"),
        F.lit(T0).alias("start_date"),
        F.lit(T0).alias("end_date"),
        F.lit(False).alias("is_current"),
        F.lit(T0).alias("created_at"),
        F.lit(T0).alias("updated_at"),
    )
    dim = past.unionByName(batch(spark, T0, (1, "z", "n"), (2, "y", "n")))
    after = apply_history(dim, batch(spark, T1, (1, "x", "n")), RULE, utc(T1))
    assert after.count() == 6003
    assert after.filter("is_current").count() == 2


LOAD = st.dictionaries(st.integers(0, 3), st.none() | st.sampled_from("abc"), max_size=4)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(loads=st.lists(LOAD, min_size=1, max_size=3))
def test_laws(spark, loads):
    dim = spark.createDataFrame([], SCHEMA)
    for month, load in enumerate(loads, start=1):
        t = datetime(2025, month, 1)
        rows = batch(spark, t, *[(k, v, "n") for k, v in load.items()])
        dim = apply_history(dim, rows, RULE, utc(t))
        # The same load again, later, changes nothing.
        once = as_set(dim)
        dim = spark.createDataFrame(once, SCHEMA)
        assert as_set(apply_history(dim, rows, RULE, utc(datetime(2026, month, 1)))) == once
    by_key = {}
    for row in once:
        by_key.setdefault(row[0], []).append(row)
    expected = {}
    for load in loads:
        expected.update(load)
    assert set(by_key) == set(expected)
    for key, versions in by_key.items():
        versions.sort(key=lambda r: r[3])
        assert [r[5] for r in versions] == [False] * (len(versions) - 1) + [True]
        assert versions[-1][1] == expected[key]
        assert all(a[4] == b[3] for a, b in zip(versions, versions[1:]))
