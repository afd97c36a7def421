"""Hard negatives of anchor vectors by Fagin's threshold algorithm.

Vectors are dealt into blocks; a block holds a list of its rows for each dimension, sorted by that component.
For an anchor, every list is read from the end that its component's sign points to. Rows met for the first
time are scored by their whole integer vectors. The threshold is the score of a row that would stand at the
reached depth in every list: no row yet unseen can have more. A window (a range of scores, of which the first
k rows are wanted) is settled once the threshold is strictly below its kth score, as an equal score could
belong to a smaller id. Each block's first k rows of a window meet in a ranking by anchor.

Anchors are a stated query set: each block of rows meets all of them, a bundle at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from saleslayers.llm.common import discard, written

#: Rows of a block and anchors of a bundle: what a task holds at once.
BLOCK, BUNDLE = 4096, 256
#: Depth of the first sorted access; each following one goes as deep again.
FIRST_DEPTH = 32
#: Size from which a component counts as not finite: below, products of 2 ** 15 components fit 64 bits.
TOO_LARGE = 65536.0

_BLOCK = "slot int, block long, dims int, n int, ids binary, labels binary, anchors binary, vectors binary, lists binary"
_ANCHOR = "anchor long, vec_id long, label long, dims int, vector binary"
_BUNDLE = "dims int, n int, anchor binary, ids binary, labels binary, vectors binary, windows binary"
_FOUND = "anchor long, anchor_id long, window_id int, score long, vec_id long"


@dataclass
class Rows:
    """A block: ids, labels, integer vectors, and per dimension the rows in ascending order of its component."""

    block: int
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    lists: np.ndarray

    def __post_init__(self) -> None:
        self.largest = int(np.abs(self.vectors).max(initial=0))
        self.doubles = self.vectors.astype(np.float64)

    def score(self, rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
        """Exact inner products: in doubles while sums stay below 2 ** 53, which is faster, else in integers."""
        if self.largest * int(np.abs(vector).max(initial=0)) * len(vector) < 1 << 53:
            return (self.doubles[rows] @ vector.astype(np.float64)).astype(np.int64)
        return self.vectors[rows].astype(np.int64) @ vector


@dataclass
class Best:
    """A window: of the rows whose score is in a range, the first k by score and id."""

    low: int
    high: int
    k: int
    scores: np.ndarray
    ids: np.ndarray

    @staticmethod
    def empty(low: int, high: int, k: int) -> Best:
        return Best(low, high, k, np.empty(0, np.int64), np.empty(0, np.int64))

    def floor(self) -> int:
        """The kth score; while there are fewer rows, the least score that may come in."""
        return int(self.scores[-1]) if len(self.scores) == self.k else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.floor()) & (scores <= self.high)
        if fits.any():
            scores, ids = np.append(self.scores, scores[fits]), np.append(self.ids, ids[fits])
            first = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[first], ids[first]


def search(rows: Rows, vector: np.ndarray, wanted: np.ndarray, windows: list[Best]) -> int:
    """Fills the windows with rows of a block that are wanted (a flag per row); returns the depth that was reached."""
    n = len(rows.ids)
    signed = np.flatnonzero(vector) if vector.any() else np.arange(1)
    up, down = signed[vector[signed] < 0], signed[vector[signed] >= 0]
    seen = np.zeros(n, bool)
    depth, reach = 0, min(FIRST_DEPTH, n)
    while depth < n:
        met = np.zeros(n, bool)
        met[rows.lists[down, n - reach : n - depth]] = True
        met[rows.lists[up, depth:reach]] = True
        new = np.flatnonzero(met & ~seen & wanted)
        seen |= met
        scores = rows.score(new, vector)
        for window in windows:
            window.add(scores, rows.ids[new])
        last = rows.vectors[rows.lists[down, n - reach], down] @ vector[down] + rows.vectors[rows.lists[up, reach - 1], up] @ vector[up]
        if seen.all() or all(last < window.floor() for window in windows):
            return reach
        depth, reach = reach, min(2 * reach, n)
    return depth


def _int64(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values, np.int64).tobytes()


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(field.split() for field in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], names)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one vector length each, of the rows of a partition (vec_id, label, is_anchor, vector)."""
    slot = TaskContext.get().partitionId()
    number = slot << 20
    held: dict[int, list] = {}

    def made(dims: int, parts: list) -> pa.RecordBatch:
        nonlocal number
        ids, labels, anchors = (np.concatenate([p[k] for p in parts]) for k in range(3))
        vectors = np.concatenate([p[3] for p in parts]).astype(np.int32)
        # A row without components scores 0 with every other; one component of 0 says the same.
        vectors = vectors if dims else np.zeros((len(ids), 1), np.int32)
        lists = np.argsort(vectors, axis=0, kind="stable").T.astype(np.uint16)
        number += 1
        found = [_int64(ids), _int64(labels), anchors.tobytes(), vectors.tobytes(), np.ascontiguousarray(lists).tobytes()]
        return _batch(_BLOCK, [[x] for x in (slot, number - 1, dims, len(ids), *found)])

    for batch in batches:
        ids, labels, anchors = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        vectors = batch.column(3)
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        for dims in np.unique(sizes):
            at = np.flatnonzero(sizes == dims)
            values = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dims)
            for a in range(0, len(at), BLOCK):
                own = at[a : a + BLOCK]
                parts = held.setdefault(int(dims), [])
                if sum(len(p[0]) for p in parts) + len(own) > BLOCK:
                    yield made(int(dims), parts)
                    parts.clear()
                parts.append((ids[own], labels[own], anchors[own], values[a : a + BLOCK]))
    for dims, parts in held.items():
        if parts:
            yield made(dims, parts)


def _rows(block: dict) -> Rows:
    n, dims = block["n"], max(block["dims"], 1)
    return Rows(
        block["block"],
        np.frombuffer(block["ids"], np.int64),
        np.frombuffer(block["labels"], np.int64),
        np.frombuffer(block["vectors"], np.int32).reshape(n, dims),
        np.frombuffer(block["lists"], np.uint16).reshape(dims, n),
    )


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per anchor of the blocks; an anchor's own number tells its block and its place there."""
    for batch in batches:
        for block in batch.to_pylist():
            at = np.flatnonzero(np.frombuffer(block["anchors"], bool))
            ids, labels = (np.frombuffer(block[c], np.int64)[at] for c in ("ids", "labels"))
            vectors = np.frombuffer(block["vectors"], np.int32).reshape(block["n"], -1)[at]
            yield _batch(_ANCHOR, [block["block"] * BLOCK + at, ids, labels, np.full(len(at), block["dims"]), [v.tobytes() for v in vectors]])


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of one vector length, BUNDLE at a time; `windows` holds three numbers for each window of each anchor."""
    held: dict[int, list[dict]] = {}

    def made(dims: int, rows: list[dict]) -> pa.RecordBatch:
        windows = [(k, *w) for k, r in enumerate(rows) for w in zip(r["window_ids"], r["lows"], r["highs"])]
        numbers = [_int64(np.array([r[c] for r in rows])) for c in ("anchor", "vec_id", "label")]
        found = [*numbers, b"".join(r["vector"] for r in rows), _int64(np.array(windows).reshape(-1, 4))]
        return _batch(_BUNDLE, [[x] for x in (dims, len(rows), *found)])

    for batch in batches:
        for row in batch.to_pylist():
            rows = held.setdefault(row["dims"], [])
            rows.append(row)
            if len(rows) == BUNDLE:
                yield made(row["dims"], rows)
                rows.clear()
    for dims, rows in held.items():
        if rows:
            yield made(dims, rows)


def _searcher(k: int, same_label: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, held = None, []  # the blocks of a slot: as many rows as a partition had, about BLOCK
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["slot"] != slot:
                    slot, held = row["slot"], []
                if row["kind"] == 0:  # sorted before the bundles that meet it
                    held.append((row["dims"], _rows(row)))
                else:
                    for dims, rows in held:
                        if dims == row["dims"]:
                            yield from _found(rows, row, k, same_label)

    return run


def _found(rows: Rows, bundle: dict, k: int, same_label: bool) -> Iterator[pa.RecordBatch]:
    n = bundle["n"]
    numbers, ids, labels = (np.frombuffer(bundle[c], np.int64) for c in ("anchor", "ids", "labels"))
    vectors = np.frombuffer(bundle["vectors"], np.int32).reshape(n, -1).astype(np.int64)
    ranges = np.frombuffer(bundle["windows"], np.int64).reshape(-1, 4)
    starts = np.searchsorted(ranges[:, 0], np.arange(n + 1))
    out: list[tuple] = []
    for a in range(n):
        wanted = (rows.labels == labels[a]) == same_label
        if same_label and numbers[a] // BLOCK == rows.block:
            wanted[numbers[a] % BLOCK] = False  # the anchor itself
        own = ranges[starts[a] : starts[a + 1]]
        windows = [Best.empty(int(w[2]), int(w[3]), k) for w in own]
        search(rows, vectors[a], wanted, windows)
        out += [(numbers[a], ids[a], w[1], best.scores, best.ids) for w, best in zip(own, windows) if len(best.ids)]
    if out:
        sizes = [len(x[3]) for x in out]
        columns = [np.repeat([x[c] for x in out], sizes) for c in range(3)] + [np.concatenate([x[c] for x in out]) for c in (3, 4)]
        yield _batch(_FOUND, columns)


def _met(blocks: DataFrame, slots: int, anchors: DataFrame, k: int, same_label: bool) -> DataFrame:
    """The first k rows of every window: each block's own first k, ranked by anchor and window."""
    none = lambda *names: [F.lit(None).cast("binary").alias(c) for c in names]
    # Every bundle to every slot: the query set against all rows, in blocks.
    sent = anchors.mapInArrow(_bundles, _BUNDLE).withColumns({"slot": F.explode(F.sequence(F.lit(0), F.lit(slots - 1))), "kind": F.lit(1), "block": F.lit(None).cast("long")})
    columns = ["slot", "kind", "block", "dims", "n", "ids", "labels", "vectors"]
    left = blocks.withColumn("kind", F.lit(0)).select(*columns, "lists", *none("anchor", "windows"))
    right = sent.select(*columns, *none("lists"), "anchor", "windows")
    dealt = left.union(right).repartition("slot").sortWithinPartitions("slot", "kind")
    found = dealt.mapInArrow(_searcher(k, same_label), _FOUND)
    order = Window.partitionBy("anchor", "window_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    least_percent: int = 30,
    most_percent: int = 90,
    scale: int = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per anchor, positive and negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A component x counts as floor(scale * x). An anchor's positives are its first rows of the same label by
    inner product, ties by smaller id; a positive's negatives are the first rows of another label whose score
    is between the two percentages of the positive's. Fewer are returned where there are fewer.

    Rows with a null id, label, vector or component take no part, nor do those with a component that is not
    finite or whose scaled size is TOO_LARGE * scale or more. Rows of another vector length never score with
    an anchor. Repeated rows are rows of their own, anchors too: of two equal ones each is a positive of the
    other. Empty tables give no rows; other columns are not read. Ids and labels are whole numbers.
    """
    plain = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"), F.col(vector_col).alias("vector")
    )
    usable = F.forall("vector", lambda x: F.coalesce(F.abs(x.cast("double")) < TOO_LARGE, F.lit(False)))
    kept = plain.dropna(subset=["vec_id", "label", "vector"]).where(usable)
    whole = kept.withColumn("vector", F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("int")))
    slots = max(1, -(-whole.count() // BLOCK))
    blocks = written(whole.repartition(slots).mapInArrow(_blocks, _BLOCK), "vector-blocks")
    anchors = written(blocks.mapInArrow(_anchors, _ANCHOR), "anchors")
    one = lambda value: F.array(F.lit(value).cast("long"))
    anywhere = anchors.withColumns({"window_ids": one(0), "lows": one(-(1 << 62)), "highs": one(1 << 62)})
    first = written(_met(blocks, slots, anywhere, positives, True).select("anchor", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # A negative score would need a window whose end lies before its start.
    ranges = first.where("positive_score >= 0").withColumns(
        {"low": F.expr(f"positive_score * {least_percent}"), "high": F.expr(f"positive_score * {most_percent} div 100")}
    )
    ranges = ranges.withColumn("low", F.expr("(low + 99) div 100"))
    listed = ranges.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct(F.col("rank").cast("long").alias("window_id"), "low", "high"))).alias("w"))
    ranged = anchors.join(listed, "anchor").select(
        *anchors.columns, F.col("w.window_id").alias("window_ids"), F.col("w.low").alias("lows"), F.col("w.high").alias("highs")
    )
    ranged = written(ranged, "anchor-windows")
    found = written(_met(blocks, slots, ranged, negatives, False), "negatives")
    for done in (blocks, anchors, ranged):
        discard(done)
    named = first.select("anchor", F.col("rank").alias("window_id"), "positive_id", "positive_score")
    return found.join(named, ["anchor", "window_id"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
