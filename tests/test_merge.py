import pytest
from conftest import as_set
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleslayers.operators.merge import fail_on_copies, merge, merge_into_table

SCHEMA = "k int, l string, v int, w string"
KEYS = ["k", "l"]


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


TARGET = [(1, "a", 10, "old"), (2, None, 20, "old"), (3, "c", None, "old"), (4, "d", 40, "old")]


def test_update_and_insert(spark):
    source = frame(spark, (1, "a", 11, "new"), (2, None, None, "new"), (3, "c", 30, "new"), (5, None, 50, "new"))
    got = merge(frame(spark, *TARGET), source, KEYS, set=["v", "w"])
    assert as_set(got) == sorted(
        [(1, "a", 11, "new"), (2, None, None, "new"), (3, "c", 30, "new"), (4, "d", 40, "old"), (5, None, 50, "new")],
        key=repr,
    )


def test_condition_and_expressions(spark):
    source = frame(spark, (1, "a", 5, "new"), (4, "d", 50, "new"))
    got = merge(
        frame(spark, *TARGET),
        source,
        KEYS,
        set={"v": F.col("src.v") + F.col("tgt.v"), "w": "src.w"},
        when=F.col("src.v") > F.col("tgt.v"),
    )
    assert as_set(got) == sorted([TARGET[0], TARGET[1], TARGET[2], (4, "d", 90, "new")], key=repr)


def test_unknown_condition_does_not_update(spark):
    got = merge(frame(spark, TARGET[2]), frame(spark, (3, "c", 1, "new")), KEYS, set=["v"], when=F.col("tgt.v") > 0)
    assert as_set(got) == [TARGET[2]]


def test_insert_only_and_insert_columns(spark):
    source = frame(spark, (1, "a", 11, "new"), (9, "z", 90, "new"))
    assert as_set(merge(frame(spark, *TARGET), source, KEYS)) == sorted([*TARGET, (9, "z", 90, "new")], key=repr)
    listed = merge(frame(spark, *TARGET), source, KEYS, insert={"k": "src.k", "l": "src.l", "w": F.lit("made")})
    assert as_set(listed) == sorted([*TARGET, (9, "z", None, "made")], key=repr)


def test_helper_columns_stay_out_and_types_are_the_targets(spark):
    source = spark.createDataFrame([(7, "g", 70, "new", 1)], "k bigint, l string, v bigint, w string, flag int")
    got = merge(frame(spark, *TARGET), source, KEYS, set=["v"])
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in frame(spark).schema]


@pytest.mark.parametrize("set_", [["v"], None])
def test_duplicate_source_key_fails(spark, set_):
    source = frame(spark, (2, None, 1, "x"), (2, None, 2, "y"))
    with pytest.raises(Exception, match="several rows for one key"):
        merge(frame(spark, *TARGET), source, KEYS, set=set_).collect()


def test_many_copies_of_one_key_are_counted_before_the_shuffle(spark):
    source = spark.range(30000, numPartitions=4).selectExpr("1 k", "'a' l", "1 v", "'new' w")
    check = fail_on_copies(source, KEYS, frame(spark).schema)
    assert check.columns == frame(spark).columns
    plan = check._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "Window" not in plan
    with pytest.raises(Exception, match="30000"):
        check.count()


def test_unknown_column_is_refused(spark):
    with pytest.raises(ValueError, match="nope"):
        merge(frame(spark, *TARGET), frame(spark, *TARGET), KEYS, set=["nope"])


def test_every_target_row_of_a_hot_key_is_updated(spark):
    target = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("int").alias("k"),
        F.lit(None).cast("string").alias("l"),
        F.lit(1).alias("v"),
        F.lit("old").alias("w"),
    )
    got = merge(target, frame(spark, (0, None, 5, "new"), (-1, None, 6, "new")), KEYS, set=["v"])
    assert {r.v: r["count"] for r in got.groupBy("v").count().collect()} == {5: 3000, 1: 6000, 6: 1}


def test_small_source_is_broadcast_and_target_not_shuffled(spark, tmp_path):
    spark.range(2000).selectExpr("cast(id as int) k", "'a' l", "1 v", "'old' w").write.parquet(str(tmp_path / "t"))
    spark.range(10).selectExpr("cast(id as int) k", "'a' l", "2 v", "'new' w").write.parquet(str(tmp_path / "s"))
    target, source = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s"))
    plan = merge(target, source, KEYS, set=["v"], check_unique=False)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert "BroadcastHashJoin" in plan


ROW = st.tuples(
    st.none() | st.integers(0, 3), st.none() | st.sampled_from("ab"), st.none() | st.integers(0, 5), st.just("w")
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=st.lists(ROW, max_size=12), source=st.lists(ROW, max_size=12))
def test_against_brute_force_and_twice_is_once(spark, target, source):
    source = list({r[:2]: r for r in source}.values())
    wanted = {r[:2]: r for r in source}
    expected = [(*r[:2], wanted[r[:2]][2], r[3]) if r[:2] in wanted else r for r in target]
    known = {r[:2] for r in target}
    expected += [r for r in source if r[:2] not in known]
    src = frame(spark, *source)
    once = merge(frame(spark, *target), src, KEYS, set=["v"])
    assert as_set(once) == sorted(expected, key=repr)
    assert as_set(merge(once, src, KEYS, set=["v"])) == sorted(expected, key=repr)


def test_table_merge_is_left_to_the_catalog(spark):
    frame(spark, *TARGET).write.mode("overwrite").saveAsTable("merge_target")
    with pytest.raises(Exception, match="(?i)merge"):
        merge_into_table(
            frame(spark, *TARGET), "merge_target", KEYS, set=["v"], when=F.col("src.v") > F.col("merge_target.v")
        )
