"""Exact repeated passages by suffix arrays over shards that hold all texts around a common anchor.

Every string of LENGTH bytes has an anchor: the place of the least hash among its k-grams. Equal strings
have equal anchors, so strings around an anchor that occurs once are not repeated, and the rest meet in
the shard of their anchor's hash. A shard sorts the suffixes of its distinct pieces by induced sorting;
common prefixes of LENGTH show which strings are equal, and the earliest of them stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslayers.llm.common import discard, numbered, release, written
from saleslayers.llm.suffix_array import common_prefixes, joined, suffix_array

#: Bytes of a repeated string, and of a k-gram.
LENGTH = 100
K = 32
#: An anchor with more distinct pieces than this is too common for one shard: their strings are compared one
#: by one, under hashes of 128 bits, by a grouped minimum.
COMMON = 4096
#: Bytes of text whose anchors are found at once, and of pieces whose suffixes are sorted at once.
TEXT_AT_ONCE = 1 << 18
PIECES_AT_ONCE = 4 << 20

_BYTES = np.random.Generator(np.random.PCG64(17)).integers(1, 2**63, 256, dtype=np.uint64)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def anchors(text: np.ndarray, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a byte array: hashes of anchors, and the first start and number of the strings that each one serves.

    Of equal least hashes in a string the last is its anchor, so that equal strings agree.
    """
    n = len(text) - length + 1
    grams, factor, span = _BYTES[text], _FACTOR, 1
    while span < k:  # a k-gram is two neighbouring halves; k is a power of two
        grams = grams[:-span] * factor + grams[span:]
        with np.errstate(over="ignore"):
            factor = factor * factor
        span *= 2
    grams = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    # The place in the low bits, counted backwards, lets the minimum carry it and prefers the last of equals.
    bits = np.uint64(24)
    low = np.uint64((1 << 24) - 1)
    least = (grams >> bits << bits) | (low - np.arange(len(grams), dtype=np.uint64))
    per_string, span = length - k + 1, 1
    while span * 2 <= per_string:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < per_string:
        rest = per_string - span
        least = np.minimum(least[:-rest], least[rest:])
    place = (low - (least[:n] & low)).astype(np.int64)
    opens = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    return grams[place[opens]], opens, np.diff(np.append(opens, n))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per anchor of each text: anchor, doc, at (the first start), strings."""
    for batch in batches:
        keys, texts = batch.column(0).to_numpy(), batch.column(1).cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        # Texts side by side, so many at a time; a longer one in stretches that overlap by a string less a byte.
        a = 0
        while a < len(keys):
            b = max(a + 1, int(np.searchsorted(ends, ends[a] + TEXT_AT_ONCE, "right")) - 1)
            b = min(b, len(keys))
            for low in range(int(ends[a]), max(int(ends[b]) - LENGTH + 1, int(ends[a])), TEXT_AT_ONCE) if b == a + 1 else [int(ends[a])]:
                high = min(int(ends[b]), low + TEXT_AT_ONCE + LENGTH - 1) if b == a + 1 else int(ends[b])
                if high - low < LENGTH:
                    continue
                hashes, first, count = anchors(data[low:high])
                rows = _within(hashes, first + low, count, ends[a : b + 1])
                if len(rows[0]):
                    doc = np.searchsorted(ends[a : b + 1], rows[1], "right") - 1
                    columns = [rows[0].view(np.int64), keys[a + doc], rows[1] - ends[a + doc], rows[2]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "doc", "at", "strings"])
            a = b


def _within(hashes: np.ndarray, first: np.ndarray, count: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of starts cut at the texts' ends: strings that reach into the next text are left out."""
    lasts = first + count
    # A run may reach over several short texts; it is cut into one part per text.
    from_doc = np.searchsorted(ends, first, "right") - 1
    to_doc = np.searchsorted(ends, lasts - 1, "right") - 1
    parts = to_doc - from_doc + 1
    row = np.repeat(np.arange(len(first)), parts)
    doc = from_doc[row] + np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
    low = np.maximum(first[row], ends[doc])
    high = np.minimum(lasts[row], ends[doc + 1] - LENGTH + 1)
    real = high > low
    return hashes[row][real], low[real], (high - low)[real]


def _met_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by anchor those whose anchor the row before or after has, and the first and last one, whose
    neighbours are in other partitions."""
    pending, again = None, True
    names = ["anchor", "doc", "at", "strings"]
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [c.to_numpy() for c in batch.columns]
        if pending is not None:
            rows = [np.append(x, y) for x, y in zip(pending, rows)]
        same = rows[0][1:] == rows[0][:-1]
        keep = np.append(again, same)[:-1] | same  # all but the last row, which waits for the next batch
        again = bool(same[-1]) if len(same) else again
        pending = [x[-1:] for x in rows]
        yield pa.RecordBatch.from_arrays([pa.array(x[:-1][keep]) for x in rows], names)
    if pending is not None:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in pending], names)


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the bytes around the anchors of each text."""
    names = ["anchor", "piece_hash", "doc", "at", "strings"]
    for batch in batches:
        hashes = []
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        lists = batch.column(2)
        found = lists.flatten()
        at, strings = (found.field(n).to_numpy() for n in ("at", "strings"))
        sizes = np.diff(lists.offsets.to_numpy())
        doc = np.repeat(np.arange(len(texts)), sizes)
        for d, low, high in zip(doc.tolist(), at.tolist(), (at + strings + LENGTH - 1).tolist()):
            hashes.append(xxhash.xxh3_64_intdigest(texts[d][low:high]))
        columns = [found.field("anchor"), np.array(hashes, np.uint64).view(np.int64), batch.column(0).to_numpy()[doc], at, strings]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


_FETCHED = "anchor long, doc long, at long, piece binary, string_a long, string_b long"


def _fetch_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around anchors; for common anchors a row per string, with its hash."""
    names = ["anchor", "doc", "at", "piece", "string_a", "string_b"]
    kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 2
    for batch in batches:
        rows: list[tuple] = []
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for doc, text, found in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist()):
            for x in found:
                anchor, at, strings = x["anchor"], x["at"], x["strings"]
                if x["common"]:
                    for s in range(at, at + strings):
                        a, b = np.frombuffer(xxhash.xxh3_128_digest(text[s : s + LENGTH]), np.int64).tolist()
                        rows.append((None, doc, s, None, a, b))
                else:
                    rows.append((anchor, doc, at, text[at : at + strings + LENGTH - 1], None, None))
        columns = zip(*rows) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def later_copies(pieces: list[bytes], docs: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int]]:
    """Of distinct pieces at (doc, at): runs (piece, first, last) of starts whose string stands earlier in another
    piece. Order is by doc, then by place."""
    text, starts = joined(pieces)
    order = suffix_array(text, LENGTH)
    piece = np.repeat(np.arange(len(pieces)), np.diff(np.append(starts, len(text) - 1)))
    ends = np.append(starts[1:] - 1, len(text) - 2)
    order = order[1:]  # without the end mark
    order = order[order + LENGTH <= ends[piece[order]]]  # starts of whole strings
    repeats = common_prefixes(text, order, LENGTH)[order] >= LENGTH
    if not repeats.any():
        return []
    group = np.cumsum(~repeats)
    size = np.bincount(group)
    member = size[group] > 1
    where, group = order[member], group[member]
    owner = piece[where]
    _, doc_rank = np.unique(docs, return_inverse=True)
    place = (doc_rank[owner].astype(np.int64) << 40) | (at[owner] + where - starts[owner])
    bounds = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    least = np.repeat(np.minimum.reduceat(place, bounds), np.diff(np.append(bounds, len(group))))
    late = np.sort(where[place > least])
    if not len(late):
        return []
    # Neighbouring starts of one piece make a run; pieces are a separator apart, so no run crosses them.
    opens = np.flatnonzero(np.append(True, late[1:] != late[:-1] + 1))
    closes = np.append(opens[1:], len(late)) - 1
    owner = piece[late[opens]]
    return list(zip(owner.tolist(), (late[opens] - starts[owner]).tolist(), (late[closes] - starts[owner]).tolist()))


def _shard_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards of pieces, sorted by anchor, to byte spans (doc, low, high) that stand earlier too."""

    def emit(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        pieces = [r[3] for r in rows]
        docs, at = (np.array([r[i] for r in rows], np.int64) for i in (1, 2))
        runs = later_copies(pieces, docs, at) if len(rows) > 1 else []
        if runs:
            owner, first, last = (np.array(c, np.int64) for c in zip(*runs))
            columns = [docs[owner], at[owner] + first, at[owner] + last + LENGTH]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "low", "high"])

    waiting: list[tuple] = []
    size = 0
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(3)] + [batch.column(3).cast(pa.binary()).to_pylist()]
        for row in zip(*columns):
            if size >= PIECES_AT_ONCE and waiting[-1][0] != row[0]:
                yield from emit(waiting)
                waiting, size = [], 0
            waiting.append(row)
            size += len(row[3])
    if waiting:
        yield from emit(waiting)


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[list[int]] = []
    for low, high in sorted((s["low"], s["high"]) for s in spans):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


_CUT = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(with_text: bool):
    names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text]
    kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_text

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for doc, text, copy, found in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                spans = merged(found or [])
                if copy:  # of a whole earlier text: each of its strings stands there too
                    spans = [(0, len(text))] if len(text) >= LENGTH else []
                at, parts = 0, []
                for low, high in spans:
                    parts.append(text[at:low])
                    at = high
                kept = b"".join([*parts, text[at:]])
                values = (doc, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), *[kept] * with_text)
                for column, value in zip(rows, values):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)

    return cut


def repeated_spans(texts: DataFrame) -> DataFrame:
    """Byte spans (doc, low, high) that a string of LENGTH covers which starts earlier too; they may overlap.

    texts has doc (unique, not null; its order is the documents' order) and text. Documents that are whole
    copies of earlier ones are left out: see `whole_copies`.
    """
    spark = texts.sparkSession
    anchored = "anchor long, doc long, at long, strings long"
    rows = written(texts.mapInArrow(_anchor_rows, anchored), "anchors")
    # By ranges of anchor and doc: an anchor that a third of all texts have is dealt over many tasks.
    dealt = rows.repartitionByRange("anchor", "doc").sortWithinPartitions("anchor")
    candidates = written(dealt.mapInArrow(_met_again, anchored), "candidates")
    discard(rows)
    release(spark)
    hashed = _around(texts.join(whole_copies(texts), "doc", "left_anti"), candidates, ["anchor", "at", "strings"])
    pieces = written(hashed.mapInArrow(_hash_pieces, "anchor long, piece_hash long, doc long, at long, strings long"), "pieces")
    discard(candidates)
    release(spark)
    key = ["anchor", "piece_hash"]
    first = F.min(F.struct("doc", "at", "strings")).alias("first")
    firsts = written(pieces.groupBy(*key).agg(first).select(*key, "first.*"), "first-pieces")
    # Of equal pieces around an anchor, all but the first repeat it throughout.
    known = firsts.select(*key, F.col("doc").alias("first_doc"), F.col("at").alias("first_at"))
    later = pieces.join(known, key).where("doc <> first_doc OR at <> first_at")
    throughout = later.select("doc", F.col("at").alias("low"), (F.col("at") + F.col("strings") + (LENGTH - 1)).alias("high"))
    # The first ones are compared with each other where their anchor has several.
    several = firsts.groupBy("anchor").count().where("count > 1").select("anchor", (F.col("count") > COMMON).alias("common"))
    wanted = firsts.join(several, "anchor").select("doc", "anchor", "at", "strings", "common")
    fetched = written(_around(texts, wanted, ["anchor", "at", "strings", "common"]).mapInArrow(_fetch_pieces, _FETCHED), "distinct-pieces")
    release(spark)
    shards = fetched.where("piece IS NOT NULL").select("anchor", "doc", "at", "piece").repartition("anchor").sortWithinPartitions("anchor")
    sorted_out = shards.mapInArrow(_shard_runs, "doc long, low long, high long")
    strings = fetched.where("piece IS NULL").select("string_a", "string_b", "doc", "at")
    earliest = strings.groupBy("string_a", "string_b").agg(F.min(F.struct("doc", "at")).alias("first"))
    repeated = strings.join(earliest, ["string_a", "string_b"]).where(F.struct("doc", "at") != F.col("first"))
    one_by_one = repeated.select("doc", F.col("at").alias("low"), (F.col("at") + LENGTH).alias("high"))
    return throughout.union(sorted_out).union(one_by_one)


def _around(texts: DataFrame, places: DataFrame, fields: list[str]) -> DataFrame:
    """doc, text and the places in it, for each text that has any: no more than it has bytes."""
    per_doc = places.groupBy("doc").agg(F.collect_list(F.struct(*fields)).alias("found"))
    return texts.join(per_doc, "doc").select("doc", "text", "found")


def whole_copies(texts: DataFrame) -> DataFrame:
    """The docs whose text, byte for byte, an earlier doc has."""
    hashed = texts.select("doc", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))
    firsts = hashed.groupBy("a", "b").agg(F.min("doc").alias("first"))
    return hashed.join(firsts, ["a", "b"]).where("doc <> first").select("doc")


def _cut_all(texts: DataFrame, with_text: bool) -> DataFrame:
    spans = written(repeated_spans(texts), "spans")
    release(texts.sparkSession)
    copies = whole_copies(texts).select("doc", F.lit(True).alias("copy"))
    per_doc = spans.groupBy("doc").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    marks = copies.join(per_doc, "doc", "full")
    rows = texts.join(marks, "doc", "left").select("doc", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "spans")
    return rows.mapInArrow(_cut(with_text), _CUT + ", kept binary" * with_text)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (the bytes that stay).

    A null text is empty. Rows equal in id and text are one document and get equal results; rows of one
    id with different texts are documents one after the other, by the hash of the text; a null id comes
    before all others. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    fields = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text]
    unclear = rows.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if unclear.isEmpty():
        return _cut_all(rows.withColumnRenamed("doc_id", "doc"), with_text).select(F.col("doc").alias("doc_id"), *fields)
    # Ids that do not tell documents apart: number the distinct ones, and give every row its document's result.
    keyed = rows.withColumn("hash", F.xxhash64("text"))
    distinct = written(numbered(keyed.dropDuplicates(["doc_id", "hash"]), ["doc_id", "hash"], "doc"), "told-apart")
    result = _cut_all(distinct.select("doc", "text"), with_text)
    by_key = distinct.select("doc", F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).join(result, "doc")
    ids = keyed.select("doc_id", "hash")
    return ids.join(by_key, ids["doc_id"].eqNullSafe(by_key["_id"]) & (ids["hash"] == by_key["_hash"])).select("doc_id", *fields)
