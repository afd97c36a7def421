"""A reproducible shuffle into shards: a Feistel permutation of global row numbers, cycle-walked onto the row count."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslayers.llm.common import fresh, numbered

#: The modulus of the round function (2^31 - 1) and the two offsets of each round at seed 0.
PRIME = 2147483647
ROUNDS = ((104729, 1299709), (611953, 15485863), (7368787, 32452843), (49979687, 67867967), (86028121, 122949823), (141650939, 160481183), (179424673, 198491317), (217645199, 256203221))


def half_bits(n: int) -> int:
    """Bits of each half, so that the domain of 4^bits holds n rows (and fewer than 4n, for n above 1)."""
    bits = 1
    while 4**bits < n:
        bits += 1
    return bits


def _round(right: np.ndarray, a: int, b: int, mask: int) -> np.ndarray:
    return ((right + a) % PRIME) * ((right + b) % PRIME) % PRIME & mask


def permute(rows: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """The place of each row number in the shuffle; a permutation of 0 to n - 1 for every seed."""
    return _walk(rows, n, seed, ROUNDS, forward=True)


def invert(places: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """The row number at each place: what a reader needs to find the row of (shard, slot)."""
    return _walk(places, n, seed, ROUNDS[::-1], forward=False)


def _walk(values: np.ndarray, n: int, seed: int, rounds: tuple, forward: bool) -> np.ndarray:
    bits = half_bits(n)
    if bits > 31:
        raise ValueError("more than 2^62 rows")
    mask = (1 << bits) - 1
    out = np.asarray(values, dtype=np.int64).copy()
    todo = np.arange(len(out))
    while len(todo):
        # Until it falls below n: the walk stays on the value's own cycle, so it ends and stays one to one.
        left, right = out[todo] >> bits, out[todo] & mask
        for a, b in rounds:
            a, b = (a + seed) % PRIME, (b + seed) % PRIME
            if forward:
                left, right = right, left ^ _round(right, a, b, mask)
            else:
                left, right = right ^ _round(left, a, b, mask), left
        out[todo] = (left << bits) | right
        todo = todo[out[todo] >= n]
    return out


def shard(docs: DataFrame, order: list[str], shards: int, seed: int = 0) -> DataFrame:
    """The rows with two more columns: shard (0 to shards - 1) and slot (gapless from 0 in each shard).

    Rows are numbered in the given order; the permuted number is dealt round the shards, so that
    shard sizes differ by one at most, whatever the rows hold. Nulls sort first; rows equal in the
    whole order swap places at most; no rows give no shards. Carry narrow rows here (ids, not texts):
    each is sorted and written once. Columns named shard or slot are replaced.
    """
    docs = docs.drop("shard", "slot")
    number = fresh(docs, "_number")
    rows = numbered(docs, order, number)
    n = rows.count()

    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(permute(batch.to_numpy(), n, seed))

    placed = rows.withColumn(number, F.pandas_udf(place, "long")(F.col(number)))
    where = F.col(number)
    return placed.withColumns(
        {"shard": (where % shards).cast("int"), "slot": F.expr(f"`{number}` div {shards}")}
    ).drop(number)


def locate(shard_ids: np.ndarray, slots: np.ndarray, n: int, shards: int, seed: int = 0) -> np.ndarray:
    """Row numbers at (shard, slot), computed without reading any row."""
    return invert(np.asarray(slots, dtype=np.int64) * shards + np.asarray(shard_ids, dtype=np.int64), n, seed)
