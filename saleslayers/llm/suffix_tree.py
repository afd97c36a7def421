"""Language-model scores by a probabilistic suffix tree over words.

A context (up to DEPTH words back) is kept if what follows it differs enough from what follows its
suffix, which is kept with it. Next-word distributions are discounted and smoothed with the suffix's,
down to add-one word counts. A word is scored in the longest kept context that it stands in.

Counts cover the whole training part. Every string that occurs LEAST_COUNT times takes part, whatever the
size of the corpus. Texts lie in blocks of some megabytes, and strings are told by 64-bit hashes. A block asks
for each of its distinct strings once, with its own number of them, in arrays by ranges of hashes; a range adds
the numbers up and answers each block in the order that it asked in. So one round gives blocks the counts of
their words, the next those of pairs of frequent words, and of triples of frequent pairs; then, from the parts
that blocks send of the gains, the contexts that are kept. At last a block knows all about its own strings and
scores its texts by itself.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslayers.llm.common import discard, release, written

#: Longest context (the two kinds of strings above words, below, are those of it), least number of a counted string, discount, and the gain in log-likelihood (in nats,
#: over all its occurrences) from which a context is kept.
DEPTH = 2
LEAST_COUNT = 2
DISCOUNT = 0.75
LEAST_GAIN = 8.0

#: Bytes of text in a block.
TEXT_AT_ONCE = 8_000_000
#: Tokens of the corpus for each range of hashes; no more strings than that meet in one, on average.
TOKENS_A_RANGE = 4_000_000

#: Share of all tokens from which a string is common. Not used any more: common strings are asked for like others.
COMMON_SHARE = 5e-7

#: The end of a text as a token; no word has white space.
END = "\n"


class Index:
    """Places of 64-bit keys in an array, by open addressing; -1 where there is none."""

    def __init__(self, keys: np.ndarray) -> None:
        self._bits = max(4, int(2 * len(keys) + 1).bit_length())
        self._slots = np.full(1 << self._bits, -1, np.int64)
        self._keys = keys
        left = np.arange(len(keys))
        at = self._home(keys)
        while len(left):
            free = self._slots[at] < 0
            self._slots[at[free]] = left[free]  # of several, one stays
            lost = self._slots[at] != left
            left, at = left[lost], (at[lost] + 1) & (len(self._slots) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, np.int64)
        left, at = np.arange(len(keys)), self._home(keys)
        while len(left):
            slot = self._slots[at]
            hit = slot >= 0
            left, at, slot = left[hit], at[hit], slot[hit]
            same = self._keys[slot] == keys[left]
            found[left[same]] = slot[same]
            left, at = left[~same], (at[~same] + 1) & (len(self._slots) - 1)
        return found


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts as a dictionary array, and where each text's begin. A to Z are lowered."""
    lowered = pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    split = pc.ascii_split_whitespace(lowered)
    words, offsets = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)  # at white space around a text
    kept = np.append(0, np.cumsum(real))
    return words.filter(pa.array(real)).dictionary_encode(), kept[offsets]


def _hashes(words: list[str] | np.ndarray) -> np.ndarray:
    return pd.util.hash_array(np.asarray(words, object), categorize=False)


#: The hash of the end.
_END = _hashes([END])[0]

#: A block: its texts' ids, flags and numbers of tokens; its words' hashes, the frequent ones first; and the stream of its tokens,
#: an end before the first text and after each, as places of words (_packed). Arrays of numbers are binary: Spark moves them whole.
_BLOCK = "block long, tokens long, train_tokens long, doc_ids array<long>, held_out array<boolean>, sizes array<int>, words binary, stream binary"


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers compressed; whole ones with the low bytes of all first, others as they are, as few are different."""
    if numbers.dtype != float:
        numbers = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T)
    return pa.compress(np.ascontiguousarray(numbers), "zstd", asbytes=True)


def _unpacked(packed: pa.Scalar, n: int, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    apart = np.frombuffer(pa.decompress(packed.as_buffer(), size * int(n), "zstd"), np.uint8)
    if dtype is float:
        return apart.view(float)
    return np.ascontiguousarray(apart.reshape(size, -1).T).view(dtype)[:, 0]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, held_out, text) as blocks."""
    part, number = TaskContext.get().partitionId(), 0
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).cumsum()
        a = 0
        while a < batch.num_rows:
            before = sizes[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(sizes, before + TEXT_AT_ONCE - size, "right")))
            held.append(batch.slice(a, b - a))
            size += sizes[b - 1] - before
            a = b
            if size >= TEXT_AT_ONCE or a < batch.num_rows:
                yield _block(pa.Table.from_batches(held), (part << 32) + number)
                held, size, number = [], 0, number + 1
    if held:
        yield _block(pa.Table.from_batches(held), (part << 32) + number)


def _block(rows: pa.Table, number: int) -> pa.RecordBatch:
    coded, offsets = _split(pa.concat_arrays(rows.column(2).chunks))
    docs, sizes = len(offsets) - 1, np.diff(offsets) + 1
    hashes = np.append(_hashes(coded.dictionary.to_numpy(zero_copy_only=False)), _END)
    words, place = np.unique(hashes, return_inverse=True)
    stream = np.full(offsets[-1] + docs + 1, place[-1], np.int32)
    stream[np.arange(offsets[-1]) + np.repeat(np.arange(docs), sizes - 1) + 1] = place[coded.indices.to_numpy()]
    order = np.argsort(-np.bincount(stream, minlength=len(words)))
    turn = np.empty(len(words), np.int32)
    turn[order] = np.arange(len(words))
    stream = turn[stream]
    train = ~rows.column(1).to_numpy().astype(bool)
    return pa.RecordBatch.from_arrays(
        [
            *(pa.array([x]) for x in (number, int(sizes.sum()), int(sizes[train].sum()))),
            pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64())),
            pa.array([~train], pa.list_(pa.bool_())),
            pa.array([sizes.astype(np.int32)], pa.list_(pa.int32())),
            pa.array([words[order].tobytes()]),
            pa.array([_packed(stream)]),
        ],
        ["block", "tokens", "train_tokens", "doc_ids", "held_out", "sizes", "words", "stream"],
    )


#: What a block asks of a range of hashes: n keys, ascending, as differences, and one or two numbers for each.
_ASKED = "kind int, range int, block long, n int, keys binary, x binary, y binary"
#: What it is told, in the order of the keys; and how many strings it is the first to ask for, of those that occur.
_TOLD = "kind int, range int, block long, n int, firsts long, told binary"
#: Kinds of questions: numbers of words, pairs and triples; the rest of a kept context of two words and of one (nan: not kept).
WORDS, PAIRS, TRIPLES, LONGER, SHORTER = 1, 2, 3, 4, 5


def _asked(kind: int, block: int, bits: int, keys: np.ndarray, x: np.ndarray, y: np.ndarray | None = None) -> pa.Table:
    """A row for each of 2 ** bits ranges in which keys are."""
    ends = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
    ends = [0, *ends, len(keys)]
    ranges = [(k, slice(a, b)) for k, (a, b) in enumerate(zip(ends, ends[1:])) if a < b]
    columns = [
        pa.array([kind] * len(ranges), pa.int32()),
        pa.array([k for k, _ in ranges], pa.int32()),
        pa.array([block] * len(ranges), pa.int64()),
        pa.array([at.stop - at.start for _, at in ranges], pa.int32()),
        pa.array([_packed(np.diff(keys[at], prepend=np.uint64(0))) for _, at in ranges], pa.binary()),
        *(pa.array([z if z is None else _packed(z[at]) for _, at in ranges], pa.binary()) for z in (x, y)),
    ]
    return pa.Table.from_arrays(columns, ["kind", "range", "block", "n", "keys", "x", "y"])


def _answers(asked: pa.Table) -> pa.Table:
    """What all blocks ask of a range. A number is told doubled, and one more for the first block that asks."""
    kind, sizes = asked["kind"][0].as_py(), asked["n"].to_numpy()
    column = lambda c, dtype: [_unpacked(z, n, dtype) for z, n in zip(asked[c], sizes)]
    keys = np.concatenate([np.cumsum(k) for k in column("keys", np.uint64)])
    order = np.argsort(keys, kind="stable")  # of ascending runs
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    times = np.diff(np.append(starts, len(keys)))
    sums = lambda c, dtype: np.add.reduceat(np.concatenate(column(c, dtype))[order], starts)
    firsts = np.zeros(len(keys), np.int64)
    if kind in (LONGER, SHORTER):
        told = np.where(sums("x", float) >= LEAST_GAIN, 1 - sums("y", float), np.nan)
    else:
        told = sums("x", np.int64)
        firsts[order[starts]] = told > 0
    of_each = np.empty(len(keys), told.dtype)
    of_each[order] = np.repeat(told, times)
    if kind not in (LONGER, SHORTER):
        of_each *= 2
        of_each[order[starts]] += 1
    ends = np.cumsum(sizes)
    firsts = np.add.reduceat(firsts, ends - sizes)
    packed = pa.array([_packed(of_each[b - n : b]) for b, n in zip(ends, sizes)], pa.binary())
    return pa.table([*(asked[c] for c in ("kind", "range", "block", "n")), pa.array(firsts), packed], ["kind", "range", "block", "n", "firsts", "told"])


#: A string's hash is that of its first part, and that of its last part turned by so many bits.
_OF_PAIR, _OF_TRIPLE = np.uint64(1), np.uint64(7)


def _turned(x: np.ndarray, y: np.ndarray, by: np.uint64) -> np.ndarray:
    return x ^ ((y << by) | (y >> (np.uint64(64) - by)))


def _distinct(keys: np.ndarray, at: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Strings that end at the tokens `at`: ascending, the string of each place, a place of each, its number in training texts."""
    distinct, place = np.unique(keys, return_inverse=True)
    one = np.empty(len(distinct), np.int64)
    one[place] = at
    return distinct, place, one, np.bincount(place[train[at]], minlength=len(distinct))


class _Strings:
    """The strings of a block, and all that it was told of them.

    Places are those of tokens, and a string's is that of its last one; the first token of a text has
    the end before it as its predecessor. The two words that stand before the token i are stream[i - 1] and
    stream[i], as the stream begins with an end."""

    def __init__(self, block: pa.Table, told: pa.Table | None) -> None:
        self.number = block["block"][0].as_py()
        self.words, place = np.unique(np.frombuffer(block["words"][0].as_buffer(), np.uint64), return_inverse=True)
        self.sizes = np.asarray(block["sizes"][0].values)
        self.stream = place.astype(np.int32)[_unpacked(block["stream"][0], self.sizes.sum() + 1, np.int32)]
        self.train = ~np.repeat(block["held_out"][0].values.to_numpy(zero_copy_only=False), self.sizes)
        self.told = told.sort_by([("kind", "ascending"), ("range", "ascending")]) if told is not None else None

    def answer(self, kind: int) -> np.ndarray:
        dtype = float if kind in (LONGER, SHORTER) else np.int64
        of = self.told.filter(pc.equal(self.told["kind"], kind))
        return np.concatenate([np.zeros(0, dtype), *(_unpacked(z, n.as_py(), dtype) for z, n in zip(of["told"], of["n"]))])

    def know_words(self) -> None:
        self.n_words = self.answer(WORDS) >> 1
        self.frequent = (self.n_words >= LEAST_COUNT) | (self.words == _END)
        hashes = self.words[self.stream]
        self.keys = _turned(hashes[:-1], hashes[1:], _OF_PAIR)
        frequent = self.frequent[self.stream]
        at = np.flatnonzero(frequent[:-1] & frequent[1:])
        self.pairs, place, self.one_pair, self.own_pairs = _distinct(self.keys[at], at, self.train)
        self.pair = np.full(len(self.keys), -1, np.int32)
        self.pair[at] = place

    def know_pairs(self) -> None:
        self.know_words()
        n = self.answer(PAIRS)
        self.first_pair, self.n_pairs = n & 1 == 1, n >> 1
        counted = np.append(self.n_pairs >= LEAST_COUNT, False)[self.pair]
        at = np.flatnonzero(counted[:-1] & counted[1:] & (self.words[self.stream[1:-1]] != _END)) + 1
        keys = _turned(self.keys[at - 1], self.keys[at], _OF_TRIPLE)
        self.triples, place, self.one_triple, self.own_triples = _distinct(keys, at, self.train)
        self.triple = np.full(len(self.keys), -1, np.int32)
        self.triple[at] = place

    def know_triples(self) -> None:
        self.know_pairs()
        n = self.answer(TRIPLES)
        self.first_triple, self.n_triples = n & 1 == 1, n >> 1

    def know_longer(self) -> None:
        self.know_triples()
        self.rest_longer = np.full(len(self.pairs), np.nan)
        self.rest_longer[self.n_pairs >= LEAST_COUNT] = self.answer(LONGER)

    def ask_words(self, bits: int) -> pa.Table:
        n = np.bincount(self.stream[1:][self.train], minlength=len(self.words))
        return _asked(WORDS, self.number, max(0, bits - 3), self.words, n)  # a block has far fewer words than tokens

    def ask_pairs(self, bits: int) -> pa.Table:
        self.know_words()
        return _asked(PAIRS, self.number, bits, self.pairs, self.own_pairs)

    def ask_triples(self, bits: int) -> pa.Table:
        self.know_pairs()
        return _asked(TRIPLES, self.number, bits, self.triples, self.own_triples)

    def ask_longer(self, bits: int) -> pa.Table:
        """With the parts of the contexts' gains and masses that come from triples that no block before asked for."""
        self.know_triples()
        t = np.flatnonzero(self.first_triple & (self.n_triples >= LEAST_COUNT))
        at, n = self.one_triple[t], self.n_triples[t]
        before = self.pair[at - 1]
        n_p, n_q, n_b = self.n_pairs[before], self.n_pairs[self.pair[at]], self.n_words[self.stream[at]]
        counted = self.n_pairs >= LEAST_COUNT
        gain, mass = (np.bincount(before, x, len(self.pairs)).astype(float)[counted] for x in (n * np.log(n / n_p / (n_q / n_b)), (n - DISCOUNT) / n_p))
        return _asked(LONGER, self.number, bits, self.pairs[counted], gain, mass)

    def ask_shorter(self, bits: int, tokens: int, distinct: int) -> pa.Table:
        """Likewise; a word that ends a kept longer context is kept whatever it gains."""
        self.know_longer()
        q = np.flatnonzero(self.first_pair & (self.n_pairs >= LEAST_COUNT))
        at, n = self.one_pair[q], self.n_pairs[q]
        b, w = self.stream[at], self.stream[at + 1]
        root = (self.n_words[w] + 1) / (tokens + distinct + 1)
        gain, mass = (np.bincount(b, x, len(self.words)).astype(float) for x in (n * np.log(n / self.n_words[b] / root), (n - DISCOUNT) / self.n_words[b]))
        gain[self.stream[self.one_pair[~np.isnan(self.rest_longer)] + 1]] = np.inf
        return _asked(SHORTER, self.number, max(0, bits - 3), self.words[self.frequent], gain[self.frequent], mass[self.frequent])

    def scores(self, tokens: int, distinct: int) -> list[np.ndarray]:
        """Known words, base score and score of each text."""
        self.know_longer()
        rest_shorter = np.full(len(self.words), np.nan)
        rest_shorter[self.frequent] = self.answer(SHORTER)
        root = (self.n_words + 1) / (tokens + distinct + 1)
        base, known = np.log10(root), (self.n_words > 0).astype(np.int64)
        # What a string adds: a context's rest goes to the words after it, and a string that was counted takes back its part.
        word = base + np.nan_to_num(np.log10(rest_shorter))
        b, w = self.stream[self.one_pair], self.stream[self.one_pair + 1]
        n_b = np.maximum(self.n_words[b], 1)
        low = (self.n_pairs - DISCOUNT) / n_b + rest_shorter[b] * root[w]
        pair = np.zeros(len(self.pairs) + 1)
        counted = self.n_pairs >= LEAST_COUNT
        pair[:-1][counted] = (np.nan_to_num(np.log10(low / rest_shorter[b] / root[w], where=counted, out=np.zeros(len(low)))) + np.nan_to_num(np.log10(self.rest_longer)))[counted]
        p, q = self.pair[self.one_triple - 1], self.pair[self.one_triple]
        high = (self.n_triples - DISCOUNT) / self.n_pairs[p] + self.rest_longer[p] * low[q]
        triple = np.zeros(len(self.triples) + 1)
        kept = (self.n_triples >= LEAST_COUNT) & ~np.isnan(self.rest_longer[p])
        triple[:-1][kept] = np.log10(high[kept] / self.rest_longer[p[kept]] / low[q[kept]])
        best = word[self.stream[1:]] + pair[self.pair] + triple[self.triple]
        starts = np.cumsum(self.sizes) - self.sizes
        return [np.add.reduceat(x, starts) for x in (known[self.stream[1:]], base[self.stream[1:]], best)]


def _ask_words(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield from _Strings(pa.Table.from_batches([batch.slice(k, 1)]), None).ask_words(bits).to_batches()


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(block: pa.Table, told: pa.Table, tokens: int, distinct: int) -> pa.Table:
    strings = _Strings(block, told)
    known, base, score = strings.scores(tokens, distinct)
    sizes = strings.sizes.astype(np.int64)
    columns = [block["doc_ids"][0].values, block["held_out"][0].values, *map(pa.array, (sizes, known, np.full(len(sizes), tokens, np.int64), base, score))]
    return pa.table(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def _each(blocks: DataFrame, told: list[DataFrame], do: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Each block with all that it was told."""
    return blocks.groupBy("block").cogroup(reduce(DataFrame.union, told).groupBy("block")).applyInArrow(do, schema)


def _free(spark: SparkSession) -> None:
    """Frees the disks of the shuffles before. Spark's listeners let go of a query a little after it ends, so that one
    `release` gives back only what was used a step before."""
    release(spark)
    time.sleep(0.5)
    release(spark)


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The rows that are not held out train the model; a null flag counts as not held out. base_score is by
    add-one word counts, score by the tree; both are log10 of the whole text's probability, its end
    included. A null or empty text is its end alone. Repeated rows count and are scored as often as they
    occur. Without training rows every token has probability 1. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text")
    )
    blocks = written(rows.mapInArrow(_blocks, _BLOCK), "blocks")
    total = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "train_tokens")]).first()
    bits = max(0, math.ceil(math.log2(max(1, total["tokens"]) / TOKENS_A_RANGE)))
    told: list[DataFrame] = []

    def answered(name: str, asked: Callable[[], DataFrame]) -> None:
        told.append(written(asked().groupBy("range").applyInArrow(_answers, _TOLD), name))
        _free(docs.sparkSession)  # no frame of the round is held here any more

    answered("told-words", lambda: blocks.mapInArrow(partial(_ask_words, bits=bits), _ASKED))
    size = total["train_tokens"], told[0].agg(F.coalesce(F.sum("firsts"), F.lit(0))).first()[0]
    answered("told-pairs", lambda: _each(blocks, told, lambda block, known: _Strings(block, known).ask_pairs(bits), _ASKED))
    answered("told-triples", lambda: _each(blocks, told, lambda block, known: _Strings(block, known).ask_triples(bits), _ASKED))
    answered("told-longer", lambda: _each(blocks, told, lambda block, known: _Strings(block, known).ask_longer(bits), _ASKED))
    answered("told-shorter", lambda: _each(blocks, told, lambda block, known: _Strings(block, known).ask_shorter(bits, *size), _ASKED))
    scored = written(_each(blocks, told, lambda block, known: _score(block, known, *size), _SCORED), "scored")
    for done in (blocks, *told):
        discard(done)
    _free(docs.sparkSession)
    return scored
