import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleslayers.llm import suffix_tree as st

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)), "\n"]


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


def corpus(seed, n=160):
    choose = random.Random(seed)
    chain = {w: [choose.choice("abcdefghij") for _ in range(3)] for w in "abcdefghij"}
    docs = []
    for i in range(n):
        word, out = choose.choice("abcdefghij"), []
        for _ in range(choose.randint(0, 80)):
            out.append(word.upper() if choose.random() < 0.2 else word if choose.random() < 0.9 else f"rare{choose.randint(0, 400)}")
            word = choose.choice(chain[word])
        docs.append((i, " ".join(out)))
    return docs + [(900, None), (901, ""), (902, "  \n a\tb\x0bc "), (903, "x" * 5000), (904, "A b " * 4000)]


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def brute_tree(docs, least):
    """The same tree by dictionaries: (probability of a token after its predecessors)."""
    texts = [tokens(t) for i, t in docs if not held(i)]
    c1 = Counter(w for t in texts for w in t)
    n, v = sum(c1.values()), len(c1)
    root = lambda w: (c1[w] + 1) / (n + v + 1)
    frequent = {w for w, c in c1.items() if c >= least} | {"\n"}
    c2 = Counter((a, b) for t in texts for a, b in zip(["\n", *t], t) if {a, b} <= frequent)
    c2 = {k: c for k, c in c2.items() if c >= least}
    c3 = Counter()
    for t in texts:
        s = ["\n", *t]
        for a, b, c in zip(s, s[1:], s[2:]):
            if b != "\n" and (a, b) in c2 and (b, c) in c2:
                c3[a, b, c] += 1
    c3 = {k: c for k, c in c3.items() if c >= least}
    gain1, gain2 = Counter(), Counter()
    for (a, b), c in c2.items():
        gain1[a] += c * math.log(c / c1[a] / root(b))
    for (a, b, w), c in c3.items():
        gain2[a, b] += c * math.log(c / c2[a, b] / (c2[b, w] / c1[b]))
    kept2 = {k for k, g in gain2.items() if g >= st.LEAST_GAIN}
    kept1 = {k for k, g in gain1.items() if g >= st.LEAST_GAIN} | {b for _, b in kept2}

    def chance1(b, w):
        if b not in kept1:
            return root(w)
        rest = 1 - sum((c - st.DISCOUNT) / c1[b] for (x, _), c in c2.items() if x == b)
        return max(c2.get((b, w), st.DISCOUNT) - st.DISCOUNT, 0) / c1[b] + rest * root(w)

    def chance(a, b, w):
        if (a, b) not in kept2 or b == "\n":
            return chance1(b, w)
        rest = 1 - sum((c - st.DISCOUNT) / c2[a, b] for (x, y, _), c in c3.items() if (x, y) == (a, b))
        return max(c3.get((a, b, w), st.DISCOUNT) - st.DISCOUNT, 0) / c2[a, b] + rest * chance1(b, w)

    return c1, n, v, chance


@pytest.mark.parametrize("share", [st.COMMON_SHARE, 0.002, 2.0])
def test_scores_match_brute_force(spark, monkeypatch, share):
    """With the values of all, some and no strings sent to the tasks."""
    monkeypatch.setattr(st, "COMMON_SHARE", share)
    docs = corpus(1)
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"token": F.lit(1), "row": F.lit(2), "known": F.lit(3)})
    rows = {r.doc_id: r for r in st.score_documents(frame, held_out()).collect()}
    c1, n, v, chance = brute_tree(docs, st.LEAST_COUNT)
    assert len(rows) == len(docs)
    for i, text in docs:
        r, t = rows[i], tokens(text)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(t), sum(c1[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((c1[w] + 1) / (n + v + 1)) for w in t), abs=1e-6)
        if len(t) < 2000:
            s = [None, "\n", *t]
            assert r.score == pytest.approx(sum(math.log10(chance(*s[k : k + 3])) for k in range(len(t))), abs=1e-6)


def test_contexts_help_on_held_out_texts(spark):
    rows = st.score_documents(spark.createDataFrame(corpus(2), "doc_id long, text string"), held_out()).where("held_out AND n_tokens > 20").collect()
    better = np.mean([r.score > r.base_score for r in rows])
    assert len(rows) > 5 and better > 0.9


def test_distributions_add_up():
    """Of the tree by dictionaries, whose scores are those of the operator."""
    c1, _, _, chance = brute_tree(corpus(3), st.LEAST_COUNT)
    words = sorted(c1)
    for a in words[::5]:
        for b in [w for w in words if len(w) == 1]:
            assert sum(chance(a, b, w) for w in [*words, "never seen"]) == pytest.approx(1, abs=1e-9)


def test_small_tables(spark):
    assert st.score_documents(spark.createDataFrame([], "doc_id long, text string"), held_out()).count() == 0
    only = st.score_documents(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), F.lit(True)).first()
    assert (only.n_known, only.train_tokens, only.base_score, only.score) == (0, 0, 0.0, 0.0)
    rows = st.score_documents(spark.createDataFrame([(None, "a"), (None, None), (5, "a"), (5, "a")], "doc_id long, text string"), held_out()).collect()
    assert sorted(r.n_known for r in rows) == [1, 2, 2, 2] and {r.train_tokens for r in rows} == {7}


def test_index():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**40, 5000))
    index = st.Index(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(np.array([-5, 2**41, int(keys[7]) + (int(keys[7]) + 1 == int(keys[8])) * 0])) == [-1, -1, 7]).all()
    assert (st.Index(np.zeros(0, np.int64)).find(np.array([3])) == [-1]).all()


def test_rare_strings_of_a_large_corpus_take_part(spark):
    # Over two million tokens, in which a share of 1e-6 would be a count of three.
    filler = " ".join("f%d" % (k % 50) for k in range(10_000))
    docs = [(i, filler) for i in range(1000, 1300) if not held(i)]
    twice = [(i, "north zq1 zq2 zq3 zq4 zq1 zq2 zq3 zq4 south") for i in range(40) if not held(i)][:1]
    asked = next((i, "zq1 zq2 zq3") for i in range(40, 80) if held(i))
    rows = st.score_documents(spark.createDataFrame([*docs, *twice, asked], "doc_id long, text string"), held_out())
    row = rows.where(f"doc_id = {asked[0]}").first()
    assert row.train_tokens > 2_000_000 and row.score > row.base_score + 3


def test_no_table_has_a_row_for_each_string(spark, monkeypatch):
    """Strings go in arrays by block and range of hashes; a row for each occurrence took too much disk."""
    rows, write = [], st.written

    def written(df, name):
        back = write(df, name)
        rows.append((name, back.count()))
        return back

    monkeypatch.setattr(st, "written", written)
    docs = spark.createDataFrame(corpus(4), "doc_id long, text string").coalesce(2)
    assert st.score_documents(docs, held_out()).count() == 165
    assert sum(n for name, n in rows if name != "scored") < 50


def test_blocks_change_no_score(spark):
    docs = spark.createDataFrame(corpus(5), "doc_id long, text string")
    one, many = (
        {r.doc_id: r for r in st.score_documents(d, held_out()).collect()} for d in (docs.coalesce(1), docs.repartition(9))
    )
    for i, r in one.items():
        assert many[i][:5] == r[:5]
        assert many[i][5:] == pytest.approx(r[5:], abs=1e-6)
