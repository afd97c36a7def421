"""Alignment of two tokenizers' ids over the same bytes, with corpus counts of linked id pairs.

Both tokenizers encode a text; the cumulative byte ends of each are a dictionary from end to token index.
The ends that both dictionaries have, in order, cut both id lists into groups of the same bytes, and links
are the pairs of tokens of a group whose byte ranges overlap.

Neither tokenizer has a token that goes on over white space after a word, so a text falls into segments (white
space and what follows it) whose ends are common ends. The distinct segments of some megabytes of texts are
joined to one text, aligned once, and each document is put together from its segments. A tokenizer for which
that does not hold gets whole texts as segments.

Counts of pairs are by document. A block (those megabytes of documents) gives each of its pairs once, with the
number of its documents; these are summed over the corpus and go back to the blocks, whose documents hold
places in the block's list of pairs.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslayers.llm.common import discard, written

#: Characters of text from which a block of documents ends (a longer text is a block), and of segments encoded as one text.
BLOCK_CHARS, JOINED_CHARS = 4_000_000, 50_000
#: Segments remembered by a worker; beyond, it begins anew. Bounds memory, never the result.
REMEMBERED = 300_000
#: A pair's number: the first id times this, and the second.
SECOND = 1 << 20

#: Before a space or line feed that follows something else than white space.
_CUT = re.compile(r"(?<=\S)(?=[ \n])")

_DOC = "block long, is_block boolean, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, pairs array<long>, times array<int>"
_VALUE = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_level() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable bytes stand for themselves, the others
    for the characters from 256 on, in their order."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteTokens:
    """A byte-level tokenizer of the tokenizers library: ids of texts without special tokens, and each id's bytes."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        decoded = _byte_level()
        self.bytes: dict[int, bytes] = {}
        for token, number in self._tokenizer.get_vocab(with_added_tokens=False).items():
            self.bytes[number] = bytes(decoded[c] for c in token) if all(c in decoded for c in token) else token.encode()
        # Its words begin at white space at the latest.
        probe = [t for t, _ in self._tokenizer.pre_tokenizer.pre_tokenize_str(" a\nb  c")] if self._tokenizer.pre_tokenizer else []
        self.cuts = probe == ["Ġa", "Ċ", "b", "Ġ", "Ġc"] and self._tokenizer.normalizer is None

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class PieceTokens:
    """A sentencepiece model that sets a space before a text; its pieces in UTF-8 with U+2581 as a space."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(k) for k in range(self._model.get_piece_size())]
        byte = [self._model.is_byte(k) for k in range(len(pieces))]
        self.bytes = {k: bytes([int(p[3:5], 16)]) if b else p.replace("▁", " ").encode() for k, (p, b) in enumerate(zip(pieces, byte))}
        ahead = self._model.encode("\n")
        # No piece holds a line feed, or a space after another character: none goes on over a cut.
        self._ahead = [self._model.piece_to_id("▁"), self._model.piece_to_id("<0x0A>")]
        self.cuts = ahead == self._ahead and not any("\n" in p or "▁" in p.lstrip("▁") for p, b in zip(pieces, byte) if not b)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts as they are; the space that the model would set before each stands before a line feed instead."""
        if not self.cuts:
            return self._model.encode([t.removeprefix(" ") for t in texts], num_threads=1)
        return [ids[2:] for ids in self._model.encode(["\n" + t for t in texts], num_threads=1)]


@dataclass
class Alignment:
    """Common ends, the token index behind each in both lists, and links as token indices with their ends."""

    ends: np.ndarray
    behind_a: np.ndarray
    behind_b: np.ndarray
    link_ends: np.ndarray
    links_a: np.ndarray
    links_b: np.ndarray


def align_ids(sizes_a: np.ndarray, sizes_b: np.ndarray) -> Alignment:
    """Groups and links of two tokenizations of the same bytes, from the bytes of each token (one at least)."""
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    index_a = dict(zip(ends_a.tolist(), range(1, len(ends_a) + 1)))
    index_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1)))
    common = sorted(index_a.keys() & index_b.keys())
    # Between two neighbouring ends of either list lies one token of each: every overlapping pair of a slice, once.
    every = np.union1d(ends_a, ends_b)
    return Alignment(
        np.array(common, np.int64),
        np.fromiter(map(index_a.__getitem__, common), np.int64, len(common)),
        np.fromiter(map(index_b.__getitem__, common), np.int64, len(common)),
        every,
        np.searchsorted(ends_a, every),
        np.searchsorted(ends_b, every),
    )


def group_texts(a: list[str], b: list[str], found: Alignment) -> list[str]:
    """Each group as `a1,a2|b1`."""
    stop_a, stop_b = found.behind_a.tolist(), found.behind_b.tolist()
    starts = zip([0, *stop_a], [0, *stop_b])
    # Most groups are one token of each.
    return [f"{a[i]}|{b[j]}" if k - i == 1 == m - j else f"{','.join(a[i:k])}|{','.join(b[j:m])}" for (i, j), k, m in zip(starts, stop_a, stop_b)]


@dataclass
class Segments:
    """Distinct segments: numbers of ids, groups and links (none where the ids do not spell it), groups as text,
    and the linked pairs of all, one segment's after the other's."""

    numbers: np.ndarray
    groups: list[str]
    pairs: np.ndarray

    @property
    def spelt(self) -> np.ndarray:
        return self.numbers[:, 0] > 0


_NOTHING = Segments(np.zeros((0, 4), np.int64), [], np.empty(0, np.int64))


class Aligner:
    """Alignments of segments by two tokenizers."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self._a, self._b = ByteTokens(path_a), PieceTokens(path_b)
        self._sizes = tuple(np.array([len(t.bytes.get(k, b"")) for k in range(max(t.bytes) + 1)]) for t in (self._a, self._b))
        self._names = tuple([str(k) for k in range(len(sizes))] for sizes in self._sizes)
        self._cuts = self._a.cuts and self._b.cuts
        self.known: dict[str, int] = {}
        self._memory = _NOTHING

    def split(self, text: str) -> list[str]:
        return _CUT.split(" " + text) if self._cuts else [" " + text]

    def _runs(self, segments: list[str]) -> list[list[str]]:
        """Segments that may be encoded as one text: after something else than white space, the next one begins anew."""
        if not self._cuts:
            return [[segment] for segment in segments]
        alone = [segment for segment in segments if segment[-1].isspace()]
        others = [segment for segment in segments if not segment[-1].isspace()] if alone else segments
        stops = np.searchsorted(ends := np.cumsum([*map(len, others)]), np.arange(JOINED_CHARS, ends[-1] + JOINED_CHARS, JOINED_CHARS), "left") + 1 if others else []
        return [run for a, b in zip([0, *stops], stops) if (run := others[a:b])] + [[segment] for segment in alone]

    def learn(self, segments: list[str]) -> Segments:
        """The remembered segments, in the order of their numbers in `known`; these are among them afterwards."""
        new = [x for x in segments if x not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            self._memory, new = _NOTHING, segments
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            old, made = self._memory, self.align(new)
            self._memory = Segments(np.concatenate([old.numbers, made.numbers]), old.groups + made.groups, np.concatenate([old.pairs, made.pairs]))
        return self._memory

    def align(self, segments: list[str]) -> Segments:
        runs, parts = self._runs(segments), []
        while runs:
            texts = ["".join(run) for run in runs]
            again = []
            for run, text, a, b in zip(runs, texts, self._a.encode(texts), self._b.encode(texts)):
                whole = text.encode("utf-8", "replace")
                if b"".join(map(self._a.bytes.__getitem__, a)) == whole == b"".join(map(self._b.bytes.__getitem__, b)):
                    parts.append((run, *self._run(run, np.array(a), np.array(b))))
                elif len(run) > 1:  # which of them?
                    half = len(run) // 2
                    again += [run[:half], run[half:]]
                else:
                    parts.append((run, np.zeros((1, 4), np.int64), [""], np.empty(0, np.int64)))
            runs = again
        if not parts:
            return _NOTHING
        made = Segments(np.concatenate([p[1] for p in parts]), [g for p in parts for g in p[2]], np.concatenate([p[3] for p in parts]))
        place = {segment: k for k, segment in enumerate(s for p in parts for s in p[0])}
        order = np.fromiter(map(place.__getitem__, segments), np.int64, len(segments))
        if (order == np.arange(len(order))).all():
            return made
        picked = _ranges(np.cumsum(made.numbers[:, 3]) - made.numbers[:, 3], made.numbers[:, 3], order)
        return Segments(made.numbers[order], [made.groups[k] for k in order], made.pairs[picked])

    def _run(self, run: list[str], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray]:
        found = align_ids(self._sizes[0][a], self._sizes[1][b])
        ends = np.cumsum([len(s.encode("utf-8", "replace")) for s in run])
        groups = np.searchsorted(found.ends, ends, "right")
        links = np.searchsorted(found.link_ends, ends, "right")
        behind = [found.behind_a[groups - 1], found.behind_b[groups - 1], groups, links]
        numbers = np.stack([np.diff(x, prepend=0) for x in behind], axis=1)
        told = group_texts([self._names[0][k] for k in a.tolist()], [self._names[1][k] for k in b.tolist()], found)
        stops = groups.tolist()
        texts = [";".join(told[i:k]) for i, k in zip([0, *stops], stops)]
        return numbers, texts, a[found.links_a].astype(np.int64) * SECOND + b[found.links_b]


def _ranges(starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The places of the chosen ranges, one range after the other."""
    n = sizes[which]
    ends = np.cumsum(n)
    return np.repeat(starts[which] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner; kept between tasks."""
    return Aligner(path_a, path_b)


def _schema(fields: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in fields.split(", "))])


def _block(found: Aligner, block: int, ids: list, texts: list, keep_groups: bool) -> Iterator[pa.RecordBatch]:
    """The documents of a block, and the block itself with its pairs and their numbers of documents."""
    segments = [found.split(text) if text else [] for text in texts]
    every = [*chain.from_iterable(segments)]
    known = found.learn([*dict.fromkeys(every)])
    rows, sizes = len(segments), np.array([len(own) for own in segments], np.int64)
    code = np.fromiter(map(found.known.__getitem__, every), np.int64, len(every))
    owner = np.repeat(np.arange(rows), sizes)
    bad = np.bincount(owner[~known.spelt[code]], minlength=rows) > 0
    told = [*map(known.groups.__getitem__, code.tolist())]
    stops = np.cumsum(sizes).tolist()
    told = ["" if no else ";".join(told[a:b]) for a, b, no in zip([0, *stops], stops, bad)]
    good = ~bad[owner]
    code, owner = code[good], owner[good]
    numbers = [np.bincount(owner, known.numbers[code, k], rows).astype(np.int64) for k in range(4)]
    shas = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in told]
    used, code = np.unique(code, return_inverse=True)
    n = known.numbers[:, 3]
    pairs, at = np.unique(known.pairs[_ranges(np.cumsum(n) - n, n, used)], return_inverse=True)
    n = n[used]
    held = at[_ranges(np.cumsum(n) - n, n, code)]
    held, times = np.unique(np.repeat(owner, n[code]) * max(len(pairs), 1) + held, return_counts=True)
    place = held % max(len(pairs), 1)
    offsets = np.searchsorted(held, np.arange(rows + 1) * max(len(pairs), 1))
    lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)) for values in (place, times.astype(np.int32))]
    columns = [np.full(rows, block), pa.array([False] * rows), pa.array(ids, pa.int64()), *numbers, pa.array(shas), pa.array(told if keep_groups else [None] * rows, pa.string()), *lists]
    schema = _schema(_DOC)
    yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], schema=schema)
    of_block = [[block], [True], *[[None]] * 7, [pairs], [np.bincount(place, minlength=len(pairs))]]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(of_block, schema.types)], schema=schema)


def _documents(path_a: str, path_b: str, keep_groups: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = aligner(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size > BLOCK_CHARS:
                    yield from _block(found, block, ids, texts, keep_groups)
                    block, ids, texts, size = block + 1, [], [], 0
        if ids:
            yield from _block(found, block, ids, texts, keep_groups)

    return run


def _complete(documents: pa.Table, values: pa.Table) -> pa.Table:
    """The documents of a block with what the corpus counts of their pairs give."""
    place = values["place"].to_numpy()
    counts, best = np.zeros((2, len(place)), np.int64)
    counts[place], best[place] = values["n"].to_numpy(), values["best"].to_numpy()
    lists = documents["pairs"].combine_chunks()
    at, times = lists.flatten().to_numpy(), documents["times"].combine_chunks().flatten().to_numpy().astype(np.int64)
    ends = np.cumsum(lists.value_lengths().to_numpy())
    sums = [np.append(0, np.cumsum(times * of[at])) for of in (best, counts)]
    n_best, count_sum = (np.diff(total[ends], prepend=0) for total in sums)
    columns = {c: documents[c] for c in documents.column_names} | {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
    names = [field.split()[0] for field in _VALUE.split(", ")]
    return pa.table([columns[c] for c in names], names)


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = False) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; groups as text if asked for.

    Text A is a space and the text by a byte-level tokenizer, text B the text by a sentencepiece model that sets
    a space before it. `groups` writes each group's ids as `a1,a2|b1`, joined by `;`. A pair's count is the number
    of rows that hold it linked; n_best counts links whose count is the highest of their A id, count_sum adds up
    the counts of all links.

    A null or empty text, or one whose tokens do not spell its bytes (characters that the model rewrites, U+2581),
    has zeros and an empty digest. Repeated rows count each; ids may be null or repeated and are whole numbers.
    Empty tables give no rows; other columns are not read.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    aligned = written(plain.mapInArrow(_documents(path_a, path_b, keep_groups), _DOC), "aligned")
    of_block = aligned.where("is_block").select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "x"))
    of_block = written(of_block.select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.times").alias("n")).where("n > 0"), "block-pairs")
    counts = written(of_block.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.expr(f"pair div {SECOND}")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    judged = counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    values = of_block.select("block", "place", "pair").join(judged, "pair").select("block", "place", "n", "best")
    documents = aligned.where("NOT is_block").drop("is_block")
    whole = documents.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(_complete, _VALUE)
    done = written(whole if keep_groups else whole.drop("groups"), "aligned-documents")
    for table in (aligned, of_block, counts):
        discard(table)
    return done
