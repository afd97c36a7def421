"""Encoding, token files and packing."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from saleslayers.llm import packing, token_files, tokens
from saleslayers.llm.common import qualified
from saleslayers.session import scratch_path

PATH = tokens.default_tokenizer()
TEXTS = [
    None, "", "  \n\t", "Hello, World. don't it's can't 12.5% a.b,c", "<|endoftext|> foo<|endoftext|>bar <|ENDOFTEXT|>",
    "ΑΣ. İstanbul Éa. ﬁn x y áb é. \x1c q\x1dz 漢字。 ½ ² ǅ ŉ. ß, ẞ.", "word " * 5000, "á ́b \r\n\x0b\x0c c", "naïve, NAÏVE. École",
]


def plain(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [x.ids for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_words_give_the_ids_of_whole_texts(monkeypatch):
    choose = random.Random(1)
    alphabet = "abcXYZ .,'-é漢1\n&#́ßσΣ"
    texts = TEXTS + ["".join(choose.choice(alphabet) for _ in range(choose.randint(0, 60))) for _ in range(400)]
    want = plain(texts)
    monkeypatch.setattr(tokens, "REMEMBERED", 100)
    monkeypatch.setattr(tokens, "TEXT_AT_ONCE", 500)
    enc = tokens.WordEncoder(PATH)
    for _ in range(2):
        assert [x.tolist() for x in enc.encode(pa.array(texts))] == want
    sliced = pa.array(["skipped", *texts]).slice(1)
    assert [x.tolist() for x in enc.encode(sliced)] == want
    assert enc.encode(pa.array([], pa.string())) == []


def test_files_round_trip(spark, tmp_path):
    docs = [(i * 7 % 101, t) for i, t in enumerate(TEXTS * 3)] + [(500, "last"), (500, "last"), (-3, "first")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"id": F.lit("x"), "number": F.lit(1)})
    folder = scratch_path(spark, "files")
    parts = token_files.write_ids(frame.repartition(3), folder, PATH, end_id=2)
    rows = sorted(map(tuple, token_files.read_ids(spark, folder, parts).collect()))
    ordered = sorted(docs, key=lambda d: (d[0], d[1] or ""))
    want, start = [], 0
    for (doc_id, _), ids in zip(ordered, plain([t for _, t in ordered])):
        ids = np.array([*ids, 2], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert rows == sorted(want)
    whole = np.concatenate([token_files.open_part(folder, p, "ids") for p in parts])
    assert len(whole) == start and whole.dtype == np.dtype("<u2") and isinstance(token_files.open_part(folder, parts[0], "ids"), np.memmap)
    assert not list(tmp_path.glob(".*"))


def test_no_documents_no_files(spark):
    folder = scratch_path(spark, "none")
    parts = token_files.write_ids(spark.createDataFrame([], "doc_id long, text string"), folder, PATH, 2)
    assert parts == [] and token_files.read_ids(spark, folder, parts).count() == 0


def test_null_ids_come_first_and_read_back_as_null(spark):
    folder = scratch_path(spark, "null")
    for ids, schema in (([None, 5, None], "long"), (["a", "5", None], "string")):
        frame = spark.createDataFrame([(i, "x") for i in ids], f"doc_id {schema}, text string")
        target = f"{folder}/{schema}"
        rows = token_files.read_ids(spark, target, token_files.write_ids(frame, target, PATH, 2)).collect()
        n = len(plain(["x"])[0]) + 1
        assert sorted((r.start, r.doc_id, r.n_tokens) for r in rows) == [(0, None, n), (n, None, n), (2 * n, 5, n)]


def test_folders_are_on_the_default_file_system(spark):
    assert qualified(spark, "/a/b").startswith("file:/") and qualified(spark, "file:/a/b") == "file:/a/b"


@pytest.mark.parametrize("seed", range(4))
def test_fullest_is_the_best_sum(seed):
    choose = random.Random(seed)
    for _ in range(60):
        counts = sorted({choose.randint(1, 30): choose.randint(1, 4) for _ in range(5)}.items(), reverse=True)
        target = choose.randint(0, 60)
        uses = dict(packing.fullest(target, counts))
        best = max(s for ks in itertools.product(*[range(n + 1) for _, n in counts]) if (s := sum(k * c[0] for k, c in zip(ks, counts))) <= target)
        assert sum(k * n for k, n in uses.items()) == best and all(n <= dict(counts)[k] for k, n in uses.items())


def fewest(histogram, capacity):
    """A number of sequences that no packing can go below. For each size: two pieces of over half a sequence never meet,
    and pieces of at least that size fit only beside those of the long ones that leave so much room."""
    bounds = []
    for size in range(capacity // 2 + 1):
        alone = sum(n for k, n in histogram.items() if k > capacity - size)
        beside = {k: n for k, n in histogram.items() if capacity / 2 < k <= capacity - size}
        room = sum((capacity - k) * n for k, n in beside.items())
        small = sum(k * n for k, n in histogram.items() if size <= k <= capacity / 2)
        bounds.append(alone + sum(beside.values()) + max(0, -(-(small - room) // capacity)))
    return max(bounds)


def test_plan_uses_every_piece_once():
    choose = random.Random(5)
    histogram = {choose.randint(1, 2048): choose.choice([1, 3, 70, 10_000]) for _ in range(800)}
    fills = packing.plan(histogram, 2048)
    used = {}
    for f in fills:
        assert sum(k * n for k, n in f.uses) <= 2048 and f.times > 0
        for k, n in f.uses:
            used[k] = used.get(k, 0) + n * f.times
    assert used == histogram
    assert sum(f.times for f in fills) <= fewest(histogram, 2048) * 1.02 + 2  # few lengths with many pieces each: a hard case
    assert packing.plan({}, 2048) == []


def test_packed_documents(spark):
    choose = random.Random(8)
    docs = [(i, " ".join(choose.choice(["alpha", "beta.", "x"]) for _ in range(choose.choice([0, 3, 10, 40, 200])))) for i in range(150)] + [(400, None), (7, "again"), (None, "no id")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"offset": F.lit(1), "ids": F.lit(2)})
    packed = packing.pack_documents(frame, PATH, 1, 64, with_ids=True)
    rows = packed.collect()
    by_sequence = {}
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert len(by_sequence) <= sum(r.length for r in rows) / 64 * 1.05 + 1
    want = sorted([*ids, 1] for (i, _), ids in zip(docs, plain([t for _, t in docs])) if i not in (7,))
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    found = [np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(g, key=lambda r: r.start)]).tolist() for i, g in got.items() if i != 7]
    assert sorted(found) == want and sum(r.length for r in got[7]) == sum(len(x) + 1 for x in plain([docs[7][1], "again"]))
    whole = packing.sequences(packed, 64, pad_id=0).collect()
    for s in whole:
        ids = np.frombuffer(s.ids, "<u4")
        assert len(ids) == 64 and not ids[s.n_tokens :].any()
        for r in by_sequence[s.sequence_id]:
            assert ids[r.offset : r.offset + r.length].tobytes() == bytes(r.ids)
    assert packing.pack_documents(frame.limit(0), PATH, 1, 64).count() == 0
