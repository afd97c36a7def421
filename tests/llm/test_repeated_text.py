import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleslayers.llm import repeated_text as rt
from saleslayers.llm.suffix_array import FIRST_BYTE, common_prefixes, joined, suffix_array


def brute(rows, length=100):
    seen, out = set(), {}
    for key, text in rows:
        data = (text or "").encode()
        covered = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if data[s : s + length] in seen:
                covered[s : s + length] = b"\1" * length
            seen.add(data[s : s + length])
        kept = bytes(x for x, c in zip(data, covered) if not c)
        spans = sum(1 for k, c in enumerate(covered) if c and not (k and covered[k - 1]))
        out[key] = (len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed, n):
    choose = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", " ", "é", "aaaa", "\n", "漢"]
    some = lambda k: "".join(choose.choice(words) for _ in range(k))
    passages = [some(60) for _ in range(4)]
    part = lambda: choose.choice([choose.choice(passages)[choose.randint(0, 50) :][: choose.randint(80, 260)], some(choose.randint(0, 9))])
    docs = [(i, "".join(part() for _ in range(choose.randint(0, 6)))) for i in range(n)]
    return docs + [(900, None), (901, ""), (902, "a" * 500), (903, "a" * 700), (904, "ab" * 300), (905, docs[3][1]), (906, docs[3][1]), (907, "x" * 99), (908, "x" * 99), (909, some(4000)), (910, "z" + docs[5][1])]


@pytest.mark.parametrize("common, at_once, pieces", [(4096, 1 << 18, 4 << 20), (1, 300, 2000), (0, 1 << 18, 1)])
def test_matches_brute_force(spark, monkeypatch, common, at_once, pieces):
    monkeypatch.setattr(rt, "COMMON", common)
    monkeypatch.setattr(rt, "TEXT_AT_ONCE", at_once)
    monkeypatch.setattr(rt, "PIECES_AT_ONCE", pieces)
    docs = corpus(3, 60)
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"doc": F.lit(1), "anchor": F.lit("x"), "found": F.lit(2)})
    rows = {r.doc_id: tuple(r)[1:-1] for r in rt.deduplicate(frame, with_text=True).collect()}
    want = brute(docs)
    assert {i for i in want if rows.get(i) != want[i]} == set()


def test_rows_that_share_an_id(spark):
    docs = corpus(4, 12)
    extra = [(3, docs[5][1] + "!" * 150), (None, docs[4][1]), docs[6], docs[6], (None, "first of all " * 20)]
    rows = rt.deduplicate(spark.createDataFrame(docs + extra, "doc_id long, text string"), with_text=True).collect()
    assert len(rows) == len(docs) + len(extra)
    twice = [tuple(r) for r in rows if r.doc_id == 6]
    assert len(twice) == 3 and len(set(map(str, twice))) == 1
    # A null id comes first, so the later document with its text has gone.
    assert {r.n_removed for r in rows if r.doc_id == 4} == {len(docs[4][1].encode()) if len(docs[4][1].encode()) >= 100 else 0}


def test_nothing_to_compare(spark):
    assert rt.deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    row = rt.deduplicate(spark.createDataFrame([(1, "é" * 60)], "doc_id long, text string")).first()
    assert tuple(row)[1:] == brute([(1, "é" * 60)])[1]


@pytest.mark.parametrize("seed", range(5))
def test_suffix_arrays(seed):
    choose = random.Random(seed)
    for trial in range(60):
        letters = [b"ab", b"a", bytes(range(256)), b"abcab"][trial % 4]
        pieces = [bytes(choose.choice(letters) for _ in range(choose.randint(0, 40))) for _ in range(choose.randint(1, 6))]
        text, starts = joined(pieces)
        values = text.tolist()
        order = suffix_array(text)
        assert order.tolist() == sorted(range(len(values)), key=lambda i: values[i:])
        shared = common_prefixes(text, order, 12)
        for a, b in zip(order.tolist(), order.tolist()[1:]):
            k = 0
            while k < 12 and values[a + k] == values[b + k] and values[a + k] >= FIRST_BYTE:
                k += 1
            assert shared[b] == k
        for piece, s in zip(pieces, starts):
            assert bytes((text[s : s + len(piece)] - FIRST_BYTE).astype(np.uint8)) == piece


def test_equal_strings_have_equal_anchors():
    choose = np.random.default_rng(1)
    for letters in (2, 26):
        text = choose.integers(97, 97 + letters, 3000).astype(np.uint8)
        text[2000:2300] = text[100:400]
        hashes, first, count = rt.anchors(text)
        of_string = np.repeat(hashes, count)
        assert first[0] == 0 and count.sum() == len(text) - 99
        assert (of_string[100:301] == of_string[2000:2201]).all()
