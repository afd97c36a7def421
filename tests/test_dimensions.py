"""Closed rows of stored dimensions: which parts are read, how they are merged, and what a crash leaves."""

from datetime import datetime, timezone

import pytest
from conftest import as_set

from saleslayers import schemas
from saleslayers.operators.history import Dimension, apply_history
from saleslayers.sinks import dimensions
from saleslayers.sinks.dimensions import ClosedPart, compact_history, drop_old_current_rows, next_merge, parts_to_read, read_current, read_history, write_dimension
from saleslayers.sinks.tables import versions

SCHEMA = schemas._table(
    id=schemas.INT,
    name=schemas.STRING,
    start_date=schemas.TIMESTAMP,
    end_date=schemas.TIMESTAMP,
    is_current=schemas.BOOLEAN,
    created_at=schemas.TIMESTAMP,
    updated_at=schemas.TIMESTAMP,
)
RULE = Dimension("id", ("name",), True)


def at(day):
    return datetime(2025, 1, day, tzinfo=timezone.utc)


def load(spark, root, day, *rows):
    stamp = datetime(2025, 1, day)
    batch = spark.createDataFrame([(*r, stamp, None, True, stamp, stamp) for r in rows], SCHEMA)
    write_dimension(apply_history(read_current(spark, root, SCHEMA), batch, RULE, at(day), check_unique=False, only_current=True), root)
    drop_old_current_rows(spark, root)


def history(spark, root, **other):
    rows = read_history(spark, root, SCHEMA, **other).collect()
    return sorted(((r.id, r.name, r.start_date.day, r.end_date and r.end_date.day, r.is_current) for r in rows), key=repr)


@pytest.mark.parametrize("n, levels", [(200, 2), (5000, 4)])
def test_number_of_parts_after_many_loads(n, levels):
    """At most 15 parts of each power of 16, and the two newest loads, which are not merged yet."""
    most = 15 * levels + 2
    merged, loads, rewritten = [], [], 0
    for number in range(1, n + 1):
        loads.append(number)
        while run := next_merge(parts_to_read(loads[:-2], merged)):
            whole = ClosedPart(run[0].first, run[-1].last)
            rewritten += whole.loads
            merged, loads = [p for p in merged if p not in run] + [whole], [x for x in loads if ClosedPart(x, x) not in run]
        parts = parts_to_read(loads, merged)
        assert len(parts) <= most and sum(p.loads for p in parts) == number
        assert [p.first for p in parts] == [1, *[p.last + 1 for p in parts[:-1]]]
    assert rewritten <= 3 * n


def test_parts_of_an_interrupted_clean_up_are_not_read():
    whole = ClosedPart(1, 16)
    assert parts_to_read([*range(9, 20)], [whole, ClosedPart(1, 4)]) == [whole, ClosedPart(17, 17), ClosedPart(18, 18), ClosedPart(19, 19)]
    assert parts_to_read([], []) == [] and next_merge([]) == []


def test_merged_history_is_the_same(spark, tmp_path):
    root = str(tmp_path / "dim")
    assert history(spark, root) == []
    expected = []
    for day in range(1, 9):
        load(spark, root, day, (1, f"v{day}"), (2, "still"))
        if day > 1:
            expected.append((1, f"v{day - 1}", day - 1, day, False))
        compact_history(spark, root, SCHEMA, at_once=2)
        assert history(spark, root) == sorted([*expected, (1, f"v{day}", day, None, True), (2, "still", 1, None, True)], key=repr)
    assert versions(spark, root) == [7, 8]
    assert sorted(p.name for p in (tmp_path / "dim" / "closed").iterdir()) == ["loads=1-4", "loads=5-6"]
    assert history(spark, root, closed_after=datetime(2025, 1, 6)) == sorted(
        [(1, "v6", 6, 7, False), (1, "v7", 7, 8, False), (1, "v8", 8, None, True), (2, "still", 1, None, True)], key=repr
    )


def test_an_interrupted_merge_loses_and_doubles_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "dim")
    for day in range(1, 7):
        load(spark, root, day, (1, f"v{day}"))
    before = history(spark, root)

    class Lost(Exception):
        pass

    def lost(*_):
        raise Lost

    with monkeypatch.context() as patch:  # lost as it deletes what is merged
        patch.setattr(dimensions, "drop_folder", lost)
        with pytest.raises(Lost):
            compact_history(spark, root, SCHEMA, at_once=4)
    (tmp_path / "dim" / "closed" / "loads=5-6").mkdir()  # a merge that was never completed
    assert history(spark, root) == before and len(versions(spark, root)) == 6
    compact_history(spark, root, SCHEMA, at_once=4)
    assert history(spark, root) == before and versions(spark, root) == [5, 6]
    load(spark, root, 7, (1, "v7"))
    assert len(as_set(read_history(spark, root, SCHEMA))) == 7
