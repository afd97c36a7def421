"""Language of texts by a sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of the words of a text, with the words' ends marked. A feature's weight in a text is
its share of the text's n-grams times its inverse document frequency, which is counted over all training texts.
The regression is trained with follow-the-regularised-leader (proximal, per-coordinate rates) under an elastic
net, on a bounded sample of the training rows; a temperature fitted on a part of the sample that is left out of
training turns its sums into probabilities.

Weights are relative to the text's length, so the sum of a text is that of its words: each distinct word of some
megabytes of texts is looked up once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Lengths of the n-grams, and bits of the hashed features.
GRAMS = (1, 2, 3)
FEATURE_BITS = 16
#: Training rows that the regression is fitted on: of each language the first by the hash of the text, languages in
#: turn until there are so many. Every CALIBRATION-th of them fits the temperature instead.
SAMPLE, CALIBRATION = 3000, 5
#: Parts of a language whose first rows are found apart from each other.
SALTS = 64
#: Rate and its offset, elastic net (absolute and squared weights), and passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.02, 0.1, 4
#: The answer for texts without a letter.
UNDETERMINED = "und"

#: Bytes of text whose words are looked up together, and texts whose features are marked together.
TEXT_AT_ONCE, MARKED_AT_ONCE = 1_500_000, 128

#: Fixed value: an odd multiplier near 2 ** 64 over the golden ratio.
_MIX = np.uint64(0x9E3779B97F4A7C15)

_SAMPLED = "lang string, turn int, hash long, features binary, times binary"


@dataclass
class Texts:
    """The letter runs of some texts, lowered: distinct words, each text's words as their numbers, and n-grams."""

    codes: np.ndarray
    offsets: np.ndarray
    lengths: np.ndarray
    features: np.ndarray

    @property
    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.lengths) - self.lengths

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For each text the sum over its n-grams of a value per feature (or several, as rows of `values`)."""
        ends = np.cumsum(self.lengths)
        of_words = np.diff(np.cumsum(values[:, self.features], axis=1)[:, ends - 1], prepend=0, axis=1) if len(ends) else np.zeros((len(values), 0))
        total = np.append(np.zeros((len(values), 1)), np.cumsum(of_words[:, self.codes], axis=1), axis=1)
        return np.diff(total[:, self.offsets], axis=1)


def split(texts: pa.Array) -> Texts:
    lowered = pc.utf8_lower(pc.fill_null(texts, ""))
    letters = pc.replace_substring_regex(lowered, r"[^\p{L}\p{M}]+", " ").cast(pa.large_string())
    runs = pc.ascii_split_whitespace(letters)
    words, offsets = runs.flatten(), runs.offsets.to_numpy() - runs.offsets[0].as_py()
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    coded = words.filter(pa.array(real)).dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    lengths, features = _features(distinct)
    return Texts(coded.indices.to_numpy().astype(np.int64), np.append(0, np.cumsum(real))[offsets], lengths, features)


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of n-grams of each word, and the hashed n-grams of all, one word's after the other's."""
    text = "".join([f" {w} " for w in words])
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    found, at = [], []
    for size in GRAMS:
        n = max(len(points) - size + 1, 0)
        whole = owner[:n] == owner[size - 1 : size - 1 + n]
        if size == 1:
            whole &= points != 32  # the marks of the ends say nothing by themselves
        place = np.flatnonzero(whole)
        mixed = np.full(len(place), size, np.uint64)
        for k in range(size):
            mixed = (mixed + points[place + k]) * _MIX
            mixed ^= mixed >> np.uint64(29)
        found.append((mixed * _MIX) >> np.uint64(64 - FEATURE_BITS))
        at.append(owner[place])
    owners = np.concatenate(at)
    order = np.argsort(owners, kind="stable")
    return np.bincount(owners, minlength=len(words)), np.concatenate(found)[order].astype(np.int64)


def _small(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of some megabytes of text, as words take many times their bytes."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + TEXT_AT_ONCE, "right")))
            yield batch.slice(a, b - a)
            a = b


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """In how many texts (one column) each feature occurs. At most 2 ** FEATURE_BITS rows come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << FEATURE_BITS, np.int64)
        marked = np.zeros((MARKED_AT_ONCE, 1 << FEATURE_BITS), bool)
        for batch in _small(batches, 0):
            found = split(batch.column(0))
            once = np.unique(found.owners * (len(found.lengths) + 1) + found.codes)
            owner, word = np.divmod(once, len(found.lengths) + 1)
            starts = found.starts
            for a in range(0, batch.num_rows, MARKED_AT_ONCE):
                i, j = np.searchsorted(owner, [a, a + MARKED_AT_ONCE])
                sizes = found.lengths[word[i:j]]
                marked[np.repeat(owner[i:j] - a, sizes), found.features[_ranges(starts[word[i:j]], sizes)]] = True
                total += np.count_nonzero(marked, axis=0)
                marked[:] = False
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["feature", "n"])

    rows = texts.mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << FEATURE_BITS, np.int64)
    counts[rows["feature"].to_numpy()] = rows["n"].to_numpy()
    return counts


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of each sampled text (lang, text, turn, hash) with their numbers."""
    for batch in _small(batches, 1):
        found = split(batch.column(1))
        starts, out = found.starts, []
        for a, b in zip(found.offsets, found.offsets[1:]):
            word = found.codes[a:b]
            features, times = np.unique(found.features[_ranges(starts[word], found.lengths[word])], return_counts=True)
            out.append((features.astype(np.int32).tobytes(), times.astype(np.int32).tobytes()))
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in (0, 2, 3)), *map(pa.array, zip(*out))], ["lang", "turn", "hash", "features", "times"])


@dataclass
class Model:
    """Languages, and per feature (rows) and language the weight, idf included; the intercepts and the temperature."""

    languages: list[str]
    weights: np.ndarray
    intercepts: np.ndarray
    temperature: float

    def probabilities(self, texts: Texts) -> np.ndarray:
        totals = texts.sums(np.append(self.weights, np.ones((1, self.weights.shape[1])), axis=0))
        sums = totals[:-1] / np.maximum(totals[-1], 1) + self.intercepts[:, None]
        return _softmax(sums.T / self.temperature)


def _softmax(sums: np.ndarray) -> np.ndarray:
    raised = np.exp(sums - sums.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


class Leader:
    """Follow-the-regularised-leader: the weights minimise the sum of past gradients, their distance from past weights
    and an elastic net, in closed form per coordinate. The intercept (the last coordinate) is not penalised."""

    def __init__(self, features: int, languages: int) -> None:
        self._z, self._n = np.zeros((2, features + 1, languages))
        self._l1, self._l2 = np.full((features + 1, 1), L1), np.full((features + 1, 1), L2)
        self._l1[-1] = self._l2[-1] = 0

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self._z[at], self._n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self._l1[at], 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + self._l2[at])

    def learn(self, at: np.ndarray, values: np.ndarray, language: int) -> None:
        weights = self.weights(at)
        error = _softmax((values @ weights)[None])[0]
        error[language] -= 1
        gradient = values[:, None] * error
        n = self._n[at]
        grown = n + gradient**2
        self._z[at] += gradient - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * weights
        self._n[at] = grown


def _temperature(sums: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of the least loss, by golden sections of its logarithm; 1 without rows."""
    if not len(truth):
        return 1.0

    def loss(log: float) -> float:
        chance = _softmax(sums / np.exp(log))[np.arange(len(truth)), truth]
        return -np.log(np.maximum(chance, 1e-300)).mean()

    low, high, part = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(rows: DataFrame) -> Model:
    """A model of training rows (lang, text). Rows with a null in either teach nothing. The sample is the same for the
    same rows, in any order; equal texts are one in it."""
    known = rows.dropna(subset=["lang", "text"])
    hashed = known.withColumn("hash", F.xxhash64("text"))
    # The texts stay where they are: their hashes choose, first within SALTS parts of a language.
    order = ["turn", "hash", "lang"]
    chosen = hashed.select("lang", "hash").distinct().withColumn("part", F.pmod("hash", F.lit(SALTS)))
    for by in (["lang", "part"], ["lang"]):
        chosen = chosen.withColumn("turn", F.row_number().over(Window.partitionBy(*by).orderBy("hash"))).where(F.col("turn") <= SAMPLE)
    chosen = chosen.select(*order).orderBy(*order).limit(SAMPLE)  # SAMPLE rows at most: small enough to broadcast
    first = hashed.join(F.broadcast(chosen), ["lang", "hash"]).dropDuplicates(["lang", "hash"])
    sample = first.select("lang", "text", "turn", "hash").mapInArrow(_vectors, _SAMPLED).toArrow().sort_by([(c, "ascending") for c in order])
    counts = document_frequencies(known.select("text"))
    n = known.count()
    idf = np.log((n + 1) / (counts + 1)) + 1
    vectors = [(np.frombuffer(f, np.int32), np.frombuffer(t, np.int32)) for f, t in zip(sample["features"].to_pylist(), sample["times"].to_pylist())]
    weighted = [(f, t / max(t.sum(), 1) * idf[f]) for f, t in vectors]
    sizes = [np.sqrt((x**2).sum()) for _, x in weighted]
    scale = 1 / np.mean(sizes) if np.sum(sizes) else 1.0
    languages = sorted(set(sample["lang"].to_pylist()))
    truth = np.array([languages.index(x) for x in sample["lang"].to_pylist()], np.int64)
    # The row of the intercept is 1 in every text.
    examples = [(np.append(f, len(idf)), np.append(x * scale, 1.0)) for f, x in weighted]
    left_out = np.arange(len(examples)) % CALIBRATION == CALIBRATION - 1
    leader = Leader(len(idf), max(len(languages), 1))
    mixed = np.random.default_rng(0)
    for _ in range(PASSES):
        for k in mixed.permutation(np.flatnonzero(~left_out)):
            leader.learn(*examples[k], truth[k])
    sums = [examples[k][1] @ leader.weights(examples[k][0]) for k in np.flatnonzero(left_out)]
    weights = leader.weights(np.arange(len(idf) + 1))
    return Model(languages, (weights[:-1] * idf[:, None] * scale).T, weights[-1], _temperature(np.array(sums), truth[left_out]))


def identify(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (0 to 1, the probability of the answer).

    Learns from the rows that are not held out (a null flag counts as not held out) and have a text and a language.
    A null text or one without a letter is `und` with score 0, as is every text where nothing could be learned.
    Predictions read the text only. Repeated rows are judged alike and count in the document frequencies each;
    empty tables give no rows; other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    model = docs.sparkSession.sparkContext.broadcast(fit(rows.where("NOT held_out").select("lang", "text")))
    schema = rows.select("doc_id", "held_out").schema.add("lang_pred", "string").add("score", "double")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in _small(batches, 2):
            texts = batch.column(2)
            real = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            names, score = np.array([UNDETERMINED] * len(texts), object), np.zeros(len(texts))
            if own.languages:
                chances = own.probabilities(split(texts))
                names = np.where(real, np.array(own.languages, object)[chances.argmax(axis=1)], names)
                score = np.where(real, chances.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return rows.select("doc_id", "held_out", "text").mapInArrow(judge, schema)
