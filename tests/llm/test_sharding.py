import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleslayers.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
@pytest.mark.parametrize("seed", [0, 7])
def test_permutation_and_inverse(n, seed):
    rows = np.arange(n)
    places = sharding.permute(rows, n, seed)
    assert sorted(places.tolist()) == list(range(n))
    assert (sharding.invert(places, n, seed) == rows).all()


def test_shuffle_is_well_mixed():
    n = 20_000
    places = sharding.permute(np.arange(n), n)
    assert (np.bincount(places[:5000] // 1000, minlength=20) > 180).all()
    assert abs(np.corrcoef(np.arange(n), places)[0, 1]) < 0.05
    assert np.mean(sharding.permute(np.arange(n), n, 1) == places) < 0.01


def test_large_domain():
    n = 3 * 10**15
    rows = np.array([0, 1, n // 2, n - 1])
    places = sharding.permute(rows, n)
    assert ((places >= 0) & (places < n)).all() and (sharding.invert(places, n) == rows).all()


def test_shards_and_slots(spark):
    ids = [*range(0, 300, 3), 5, 5, 5, None, None]
    docs = spark.createDataFrame([(i, zlib.crc32(str(i).encode())) for i in ids], "doc_id long, c long").withColumns({"shard": F.lit(99), "_number": F.lit(1)})
    rows = sharding.shard(docs, ["doc_id", "c"], 8).collect()
    assert len(rows) == len(ids) and docs.columns[:2] == ["doc_id", "c"]
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    # The row at a place is computed from the place alone; rows are numbered in id order, nulls first.
    ordered = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    numbers = sharding.locate(np.array([r.shard for r in ordered]), np.array([r.slot for r in ordered]), len(rows), 8)
    assert sorted(numbers.tolist()) == list(range(len(rows)))
    assert [ordered[i].doc_id for i in range(len(rows))] == [ordered[i].doc_id for i in np.argsort(numbers)]
    assert sharding.shard(docs.limit(0), ["doc_id"], 8).count() == 0


def test_same_rows_same_shards(spark):
    docs = spark.range(500).withColumnRenamed("id", "doc_id")
    first = sorted(map(tuple, sharding.shard(docs, ["doc_id"], 7).collect()))
    assert first == sorted(map(tuple, sharding.shard(docs.repartition(5), ["doc_id"], 7).collect()))
