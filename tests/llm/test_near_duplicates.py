import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleslayers.llm import near_duplicates as nd
from saleslayers.llm.components import components

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = (text or "").translate(LOW).split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs):
    sets = {}
    for i, t in docs:
        sets.setdefault(i, []).append(shingles(t))
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and any(a and b and 100 * len(a & b) >= 75 * len(a | b) for a in sets[x] for b in sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: find(i) for i in ids}


def corpus(seed):
    choose = random.Random(seed)
    word = lambda: "".join(choose.choice("abcdefgh") for _ in range(3))
    docs = []
    for group in range(12):
        base = [word() for _ in range(choose.choice([4, 30, 80, 200]))]
        for _ in range(choose.randint(1, 6)):
            copy = list(base)
            for _ in range(int(len(base) * choose.choice([0, 0.01, 0.03, 0.06, 0.2]))):
                copy[choose.randrange(len(copy))] = word()
            docs.append((len(docs) * 3 % 101, " ".join(copy)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(spark, seed):
    docs = corpus(seed) + [(500, None), (501, ""), (502, "One two"), (503, "one TWO"), (504, "one"), (505, "x " * 9000), (506, "X\n" * 8000)]
    docs += [docs[0], (600, docs[1][1]), (600, docs[5][1])]
    frame = spark.createDataFrame(docs + [(None, docs[2][1])], "doc_id long, text string").withColumns({"n": F.lit(1), "bands": F.lit(2)})
    rows = nd.link(frame).collect()
    want = brute(docs)
    assert len(rows) == len(docs) + 1
    for r in rows:
        assert (r.component_id, r.kept) == ((want[r.doc_id], want[r.doc_id] == r.doc_id) if r.doc_id is not None else (None, True))
    assert sorted(r.n_shingles for r in rows if r.doc_id is not None) == sorted(len(shingles(t)) for _, t in docs)
    kept = nd.one_of_each(frame)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, c in want.items() if c == i} | {None}


def test_empty_table(spark):
    assert nd.link(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_signatures_estimate_similarity():
    choose = np.random.default_rng(3)
    for share in (0.3, 0.6, 0.75, 0.9):
        both = choose.integers(0, 2**63, 4000).astype(np.uint64)
        cut = int(4000 * (1 - share) / 2)
        a, b = both[: 4000 - cut], both[cut:]
        alike = np.mean(nd.signature(a, 1024) == nd.signature(b, 1024))
        assert abs(alike - len(both[cut : 4000 - cut]) / 4000) < 0.06


def test_bitmaps_and_sketches_let_links_pass(spark):
    choose = random.Random(9)
    rows = []
    for i in range(300):
        n = choose.choice([5, 20, 100, 400, 3000])
        base = np.array([choose.getrandbits(64) for _ in range(n)], np.uint64)
        other = np.append(base[: n - int(n * choose.random() * 0.4)], np.array([choose.getrandbits(64) for _ in range(int(n * choose.random() * 0.2))], np.uint64))
        both = len(np.intersect1d(base, other))
        linked = 100 * both >= 75 * (len(base) + len(other) - both)
        bits = [[*nd.bitmap(x).tolist(), *nd.sketch(nd.signature(x)).tolist()] for x in (base, other)]
        rows.append((i, len(base), bits[0], len(other), bits[1], bool(linked)))
    pairs = spark.createDataFrame(rows, "i int, n long, bits array<long>, n2 long, bits2 array<long>, linked boolean")
    a = pairs.select("i", "n", "bits", "linked").alias("a")
    b = pairs.select("i", F.col("n2").alias("n"), F.col("bits2").alias("bits")).alias("b")
    possible = a.join(b, (F.col("a.i") == F.col("b.i")) & nd._possible("a", "b")).select("a.i").collect()
    assert {r[0] for r in rows if r[-1]} <= {r.i for r in possible} and len(possible) < len(rows)


def test_recall_at_the_least_similarity():
    choose = np.random.default_rng(11)
    met = 0
    for _ in range(3000):
        both = choose.integers(0, 2**63, 160).astype(np.uint64)
        a, b = (nd.signature(x) for x in (both[:140], both[20:]))  # 120 of 160 shared: 0.75
        low = (1 << nd.PLANES) - 1
        met += bool((nd.band_keys(a) == nd.band_keys(b)).any() and np.sum((a & low) == (b & low)) >= nd.AGREE)
    assert met >= 0.998 * 3000


def test_texts_of_one_template_are_not_all_compared(spark, monkeypatch):
    choose = random.Random(4)
    word = lambda: "".join(choose.choice("abcdefghijkl") for _ in range(5))
    template = " ".join(word() for _ in range(900))
    docs = [(i, template + " " + " ".join(word() for _ in range(500))) for i in range(400)]
    compared, confirm = [], nd.confirmed
    monkeypatch.setattr(nd, "confirmed", lambda pairs, texts: (compared.append(pairs.count()), confirm(pairs, texts))[1])
    copy = (1000, docs[7][1] + " and some more words")
    rows = {r.doc_id: r.component_id for r in nd.link(spark.createDataFrame([*docs, copy], "doc_id long, text string")).collect()}
    assert rows == {**{i: i for i, _ in docs}, 1000: 7}
    assert sum(compared) < 0.01 * 400 * 399 / 2


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 30)] + [(90, 3), (3, 4), (4, 90), (7, 7), (6, 5)]
    choose = random.Random(2)
    edges = [(b, a) if choose.random() < 0.5 else (a, b) for a, b in edges]
    got = {r.v: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in range(5, 30)}, 3: 3, 4: 3, 90: 3}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
