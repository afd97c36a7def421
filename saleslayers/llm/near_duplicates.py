"""Near-duplicates by circulant MinHash: banded signatures propose pairs, full shingle sets confirm them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslayers.llm.common import fresh, written
from saleslayers.llm.components import components

#: Words of a shingle, and the similarity from which texts are linked, in per cent.
SHINGLE = 5
PERCENT = 75
#: Bands and rows of a signature. At similarity 0.75 a pair meets in no band with probability
#: (1 - 0.75^6)^40 = 4e-4, at 0.8 with 5e-6; such a pair is still linked if both meet a common partner.
BANDS, ROWS = 40, 6
#: Bits of a document's shingle bitmap, by which pairs of short texts are ruled out for certain.
BITMAP = 1024
#: For texts that fill their bitmaps: low bits of each coordinate that a sketch keeps, and how many coordinates two sketches must agree in before
#: texts are compared: at similarity 0.75 they agree in 184 on average and in fewer than 150 with probability
#: 3e-7, at 0.47 in 121, and in 150 with probability 1e-4, however long the texts are.
PLANES, AGREE = 4, 150
_WORDS = -(-BANDS * ROWS // 64)
_BITS = BITMAP // 64 + PLANES * _WORDS
#: Words whose hashes a task remembers; bounds memory, never the result.
REMEMBERED = 300_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
#: One odd factor for each place of a shingle.
_PLACES = [np.uint64(pow(0x9E3779B97F4A7C15, j + 1, 1 << 64)) for j in range(SHINGLE)]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles. Fewer words than a shingle: one of the whole sequence."""
    words = (text or b"").translate(_LOWER).split()  # bytes.split parts at ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    h = np.array([_hashes[w] for w in words], dtype=np.uint64)
    span = min(SHINGLE, len(h))
    total = np.full(len(h) - span + 1, span, np.uint64)
    for j in range(span):
        total += h[j : len(h) - span + 1 + j] * _PLACES[j]
    return np.unique(_mixed(total))


def signature(shingles: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """Circulant MinHash: a first permutation of the shingles' universe, then one second permutation for all
    coordinates, shifted round by one more place for each. The universe is the integers of 32 bits."""
    first = (_mixed(shingles * _MIX[3] + _MIX[4]) >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    least = np.full(size, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(first), 512):
        x = first[None, a : a + 512] + shifts  # modulo 2^32: a circular shift
        t = x >> np.uint32(16)
        x ^= t
        x *= np.uint32(0x85EBCA6B)
        np.right_shift(x, np.uint32(13), out=t)
        x ^= t
        x *= np.uint32(0xC2B2AE35)
        np.right_shift(x, np.uint32(16), out=t)
        x ^= t
        np.minimum(least, x.min(axis=1), out=least)
    return least


def band_keys(signed: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, of the band's number and coordinates."""
    rows = signed.reshape(-1, ROWS).astype(np.uint64)
    key = np.arange(len(rows), dtype=np.uint64) + np.uint64(1)
    for j in range(ROWS):
        key = _mixed(key * _MIX[0] + rows[:, j])
    return key.view(np.int64)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITMAP, bool)
    bits[(shingles >> np.uint64(40)).astype(np.int64) % BITMAP] = True
    return np.packbits(bits).view(np.int64)


def sketch(signed: np.ndarray) -> np.ndarray:
    """The low bits of all coordinates, one plane of 64-bit words after the other."""
    planes = np.zeros((PLANES, 64 * _WORDS), bool)
    for j in range(PLANES):
        planes[j, : len(signed)] = (signed >> np.uint32(j)) & np.uint32(1)
    return np.packbits(planes).view(np.int64)


_SIGNED = "doc_id long, n long, set_a long, set_b long, bands array<long>, bits array<long>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, sets, bands, bits, ends = [], [], [], [], [0]
        for text in batch.column(1).cast(pa.binary()).to_pylist():
            shingles = shingle_set(text)
            sizes.append(len(shingles))
            sets.append(np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64))
            if len(shingles):
                signed = signature(shingles)
                bands.append(band_keys(signed))
                bits += [bitmap(shingles), sketch(signed)]
            ends.append(ends[-1] + bool(len(shingles)))
        if not sizes:
            continue
        both = np.array(sets)
        at = np.array(ends, np.int32)
        keys, planes = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (bands, bits))
        columns = [
            batch.column(0),
            pa.array(sizes, pa.int64()),
            pa.array(both[:, 0]),
            pa.array(both[:, 1]),
            pa.ListArray.from_arrays(pa.array(at * BANDS), pa.array(keys)),
            pa.ListArray.from_arrays(pa.array(at * _BITS), pa.array(planes)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "set_a", "set_b", "bands", "bits"])
    _hashes.clear()  # a worker outlives its task, and other operators need its memory


def _possible(a: str, b: str) -> Column:
    """Whether two documents may be similar enough: by sizes and bitmaps, and by the coordinates they agree in.

    Each bit that one document has and the other lacks is a shingle, at least, that they do not share.
    """

    def bits(x: str, i: int) -> Column:
        return F.get(f"{x}.bits", F.lit(i))

    def shared_at_most(x: str, y: str) -> Column:
        alone = [F.bit_count(bits(x, i).bitwiseAND(F.bitwise_not(bits(y, i)))) for i in range(BITMAP // 64)]
        return F.col(f"{x}.n") - reduce(Column.__add__, alone)

    def differ(word: int) -> Column:
        """Of 64 coordinates, the number whose low bits are not the same."""
        at = [BITMAP // 64 + plane * _WORDS + word for plane in range(PLANES)]
        return F.bit_count(reduce(Column.bitwiseOR, [bits(a, i).bitwiseXOR(bits(b, i)) for i in at]))

    total = F.col(f"{a}.n") + F.col(f"{b}.n")
    most = F.least(shared_at_most(a, b), shared_at_most(b, a))
    apart = reduce(Column.__add__, [differ(word) for word in range(_WORDS)])
    return (most * (100 + PERCENT) >= total * PERCENT) & (apart <= BANDS * ROWS - AGREE)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with both texts, those whose full sets are similar enough."""
    for batch in batches:
        keep, last, left = [], None, None
        texts = zip(batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).cast(pa.binary()).to_pylist())
        for text_u, text_v in texts:
            if left is None or text_u != last:
                last, left = text_u, shingle_set(text_u)
            right = shingle_set(text_v)
            both = len(np.intersect1d(left, right, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(left) + len(right) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))
    _hashes.clear()


def _texts_of(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The documents of the pairs, written once: a part of the corpus, as most documents are in no pair.

    The ids are written before, so that Spark knows their size when it plans: few are sent to the texts,
    and only for many are the texts shuffled.
    """
    ids = written(pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct(), "pair-ids")
    return written(rows.join(ids, "doc_id").dropDuplicates(["doc_id", "text"]), "pair-texts")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (u, v) that are links. texts (doc_id, text) has every document of the pairs."""
    left = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u"))
    right = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v"))
    rows = pairs.join(left, "u").join(right, "v").select("u", "v", "text_u", "text_v")
    return rows.mapInArrow(_confirm, "u long, v long")


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least id reachable by links), kept (it is its own).

    Documents with equal sets are one vertex from the start. In a bucket of a band, each document is
    first compared with the bucket's least; then only documents of different components that meet in a
    bucket are, if bitmaps and whole signatures allow: what is left out is a pair that is connected already,
    proven too different, or too different by the odds stated at AGREE. Null and empty texts are linked with nothing. A row without an id has no component and is
    kept. Rows of one id are one document: repeated rows get equal results, and if their texts differ,
    the links of all of them count. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = written(rows.mapInArrow(_sign, _SIGNED), "signatures")
    real = signed.where("n > 0 AND doc_id IS NOT NULL")
    by_set = ["set_a", "set_b", "n"]
    firsts = written(real.groupBy(*by_set).agg(F.min("doc_id").alias("rep")), "distinct-sets")
    reps = firsts.select(*by_set, F.col("rep").alias("doc_id")).join(real, [*by_set, "doc_id"])
    reps = written(reps.select("doc_id", "n", "bands", "bits", *by_set[:2]).dropDuplicates([*by_set, "doc_id"]), "representatives")

    banded = reps.select("doc_id", F.explode("bands").alias("bucket"))
    hubs = banded.groupBy("bucket").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub <> last")
    buckets = written(banded.join(hubs.select("bucket", "hub"), "bucket"), "buckets")
    small = reps.select("doc_id", "n", "bits")

    stars = buckets.where("doc_id <> hub").select(F.col("hub").alias("u"), F.col("doc_id").alias("v")).distinct()
    a, b = small.alias("a"), small.alias("b")
    stars = stars.join(a, F.col("u") == F.col("a.doc_id")).join(b, (F.col("v") == F.col("b.doc_id")) & _possible("a", "b")).select("u", "v").distinct()
    stars = written(stars, "star-pairs")
    links = written(confirmed(stars, _texts_of(stars, rows)), "star-links")

    found = components(links)

    placed = buckets.join(found.withColumnRenamed("v", "doc_id"), "doc_id", "left").select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("bucket")
    open_rows = written(placed.join(mixed, "bucket", "left_semi").join(small, "doc_id"), "open-buckets")
    a, b = open_rows.alias("a"), open_rows.alias("b")
    different = (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.doc_id") < F.col("b.doc_id")) & (F.col("a.component") != F.col("b.component"))
    crossing = a.join(b, different & _possible("a", "b")).select(F.col("a.doc_id").alias("u"), F.col("b.doc_id").alias("v")).distinct()
    crossing = written(crossing.join(stars, ["u", "v"], "left_anti"), "crossing-pairs")
    more = confirmed(crossing, _texts_of(crossing, rows))

    # An id whose rows have different texts ties the representatives of their sets together.
    owner = written(real.join(firsts, by_set).select("doc_id", "rep").distinct(), "owners")
    several = owner.groupBy("doc_id").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least <> most")
    ties = owner.join(several, "doc_id").select(F.col("least").alias("u"), F.col("rep").alias("v"))
    ends = components(links.union(more).union(ties)).withColumnRenamed("v", "rep")
    per_doc = owner.join(ends, "rep", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    joined = signed.select("doc_id", F.col("n").alias("n_shingles")).join(per_doc, "doc_id", "left")
    own = F.coalesce("component_id", "doc_id")
    return joined.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the near-duplicates of an earlier id; all their columns. Rows of one id stay together."""
    gone = fresh(docs, "_gone")
    drop = link(docs, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(drop, docs[id_col].cast("long") == drop[gone], "left_anti")
