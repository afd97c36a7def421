"""Packing token sequences with little padding: minimum bin slack over the histogram of piece lengths.

A document is cut into full pieces and a rest. How many pieces of each length there are is a table of
at most `capacity` rows, whatever the corpus holds; the plan is made on it alone. Each plan entry is a
multiset of lengths that fills a sequence as closely as the remaining lengths allow, used as often as
they last. A piece then finds its sequence and offset from its rank among pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslayers.llm.common import numbered, written
from saleslayers.llm.tokens import encoder


@dataclass(frozen=True)
class Fill:
    """So many sequences, each with the same number of pieces of each length (longest first)."""

    times: int
    uses: tuple[tuple[int, int], ...]


def fullest(target: int, counts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of the (length, count) at hand, longest first, the multiset whose sum is nearest to the target from below.

    Sums that can be reached are the bits of an integer; a length with a count is added by doubling
    chunks. The bits before each length are kept, to trace back how many of it the best sum takes.
    """
    mask, reach, steps = (1 << (target + 1)) - 1, 1, []
    for length, count in counts:
        if length > target:
            continue
        count = min(count, target // length)
        steps.append((length, count, reach))
        chunk = 1
        while count:
            take = min(chunk, count)
            reach |= (reach << (take * length)) & mask
            count, chunk = count - take, chunk * 2
        if reach >> target:
            break
    total, uses = reach.bit_length() - 1, []
    for length, count, before in reversed(steps):
        used = next(k for k in range(count + 1) if total >= k * length and before >> (total - k * length) & 1)
        if used:
            uses.append((length, used))
            total -= used * length
    return uses[::-1]


def plan(histogram: dict[int, int], capacity: int) -> list[Fill]:
    """Fills that use up the histogram. Each starts from the longest length left, so every round ends one or more."""
    left = {length: n for length, n in sorted(histogram.items(), reverse=True) if n}
    fills = []
    while left:
        seed = next(iter(left))
        rest = [(length, n - (length == seed)) for length, n in left.items() if n > (length == seed)]
        uses = dict(fullest(capacity - seed, rest))
        uses[seed] = uses.get(seed, 0) + 1
        times = min(left[length] // n for length, n in uses.items())
        fills.append(Fill(times, tuple(sorted(uses.items(), reverse=True))))
        for length, n in uses.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return fills


def cut(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens and, if asked for, ids (32-bit, little-endian).

    Null and empty texts give one piece of the end id; repeated rows give their pieces again.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
    kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
    schema = ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in names)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for doc_id, found in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1))):
                ids = np.append(found, end_id).astype("<u4")
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity]
                    data = piece.tobytes()
                    values = [doc_id, start, len(piece), zlib.crc32(data), len(ids), *[data] * with_ids]
                    for column, value in zip(rows, values):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(pieces, schema)


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """The pieces with sequence_id and offset. No two overlap, and a sequence has no gap before its last piece.

    The pieces are numbered in order of length by their ranges, so a length that most pieces have is
    spread over many tasks. The plan has a few thousand numbers at most; it goes to the tasks as it is.
    """
    rows = numbered(pieces, ["length", "doc_id", "start"], "_number")
    histogram = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    first, at = {}, 0
    for length in sorted(histogram):
        first[length], at = at, at + histogram[length]
    entries, sequence = [], 0
    for fill in plan(histogram, capacity):
        offset = 0
        for length, per in fill.uses:
            entries.append((first[length], per, sequence, offset, length))
            first[length] += per * fill.times
            offset += per * length
        sequence += fill.times
    lookup = np.array(sorted(entries), dtype=np.int64).reshape(-1, 5)

    def place(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            number = batch.to_numpy()
            begin, per, base, offset, length = lookup[np.searchsorted(lookup[:, 0], number, "right") - 1].T
            rank = number - begin
            yield pd.DataFrame({"sequence_id": base + rank // per, "offset": offset + rank % per * length})

    placed = rows.withColumn("_at", F.pandas_udf(place, "sequence_id long, offset long")(F.col("_number")))
    return placed.select(*pieces.columns, "_at.sequence_id", "_at.offset")


def sequences(packed: DataFrame, capacity: int, pad_id: int) -> DataFrame:
    """The packed token sequences themselves, from pieces that carry their ids: sequence_id, n_tokens, ids.

    ids has `capacity` unsigned 32-bit integers, filled up with the pad id. A sequence is at most
    `capacity` tokens, so a group is small whatever the corpus.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(ordered.alias("p"), F.sum("length").alias("n_tokens"))
    filled = F.concat(F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])), F.unhex(F.expr(f"repeat('{int(pad_id).to_bytes(4, 'little').hex()}', cast({capacity} - n_tokens as int))")))
    return joined.select("sequence_id", "n_tokens", filled.alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """Cut and pack in one call; the pieces are written once, as the texts are encoded once."""
    return pack(written(cut(docs, tokenizer, end_id, capacity, with_ids), "pieces"), capacity)
