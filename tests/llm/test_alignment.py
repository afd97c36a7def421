import hashlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleslayers.llm import alignment
from saleslayers.llm.alignment import SECOND, align_ids, default_tokenizers, group_texts

ODD = [
    None, "", " ", "\n", "a", "  x  ", " \n a\n\n b \n", "a\r\nb\r\n c", "tab\tx y\t\tz", "▁x a", "a ▁", "ﬁ Å ① a", "日本語 テスト　x", "<s> </s> <0x41> <|endoftext|> <unk>",
    "it's  don't 's 'll", "\x1c \x85 a", "a\x00b", "x" * 3000 + " y", "🙂🙂 a🙂", "1234 56,7.8  ...!!!\n- a", "a  's b\n 's", "a \n", "word " * 50, "word " * 50,
]


@lru_cache(maxsize=1)
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    path_a, path_b = default_tokenizers()
    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=path_b), alignment.ByteTokens(path_a).bytes, alignment.PieceTokens(path_b).bytes


def spans(ids, names):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(names[i]), i))
        at += len(names[i])
    return out


def brute(text):
    """Of the whole text: n_a, n_b, groups as text, and all links, or None without tokens."""
    a, b, bytes_a, bytes_b = tokenizers()
    ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
    if not ids_a or not b"".join(bytes_a[i] for i in ids_a) == (" " + text).encode() == b"".join(bytes_b[i] for i in ids_b):
        return None
    spans_a, spans_b = spans(ids_a, bytes_a), spans(ids_b, bytes_b)
    links = [(i, j) for s, e, i in spans_a for t, f, j in spans_b if s < f and t < e]
    groups, done = [], 0
    for end in sorted({e for _, e, _ in spans_a} & {e for _, e, _ in spans_b}):
        groups.append("|".join(",".join(str(i) for s, e, i in x if done < e <= end) for x in (spans_a, spans_b)))
        done = end
    return len(ids_a), len(ids_b), groups, links


def expected(texts):
    found = [brute(t) for t in texts]
    held = Counter(pair for f in found if f for pair in set(f[3]))
    most = {}
    for (i, _), n in held.items():
        most[i] = max(most.get(i, 0), n)
    out = []
    for k, f in enumerate(found):
        if f is None:
            out.append((k, 0, 0, 0, 0, 0, 0, ""))
        else:
            best = sum(held[p] == most[p[0]] for p in f[3])
            out.append((k, f[0], f[1], len(f[2]), len(f[3]), best, sum(held[p] for p in f[3]), hashlib.sha256(";".join(f[2]).encode()).hexdigest()))
    return out


def aligned(spark, texts, **other):
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, block int").withColumn("pairs", F.lit("x"))
    got = alignment.align(docs.repartition(3), *default_tokenizers(), **other)
    return sorted(tuple(r) for r in got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


def test_odd_texts_against_whole_texts(spark):
    assert alignment.aligner(*default_tokenizers())._cuts
    assert aligned(spark, ODD) == expected(ODD)


def test_documents_of_many_blocks(spark, sf_dir, monkeypatch):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    texts += texts[:5]  # repeated rows count each
    want = expected(texts)
    assert aligned(spark, texts) == want
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 2000)
    monkeypatch.setattr(alignment, "REMEMBERED", 300)
    monkeypatch.setattr(alignment, "JOINED_CHARS", 100)
    assert aligned(spark, texts) == want


def test_groups_are_kept_and_ids_may_repeat(spark):
    docs = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "three"), (5, None)], "doc_id long, text string")
    rows = alignment.align(docs, *default_tokenizers(), keep_groups=True).collect()
    assert Counter((r.doc_id, r.groups) for r in rows) == Counter((i, ";".join(brute(t)[2]) if t else "") for i, t in [(1, "one two"), (1, "one two"), (None, "three"), (5, None)])
    assert all(r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") for r in rows)
    assert alignment.align(docs.limit(0), *default_tokenizers()).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab's 'dlA1\n\t\r .é▁日\xa0\x1f!,", max_size=12), max_size=8))
def test_segments_give_what_whole_texts_give(texts):
    found = alignment.aligner(*default_tokenizers())
    documents, block = alignment._block(found, 0, list(range(len(texts))), texts, True)
    pairs = block.column("pairs").to_pylist()[0]
    for text, row in zip(texts, documents.to_pylist()):
        want = brute(text) or (0, 0, [], [])
        assert (row["n_a"], row["n_b"], row["groups"]) == (want[0], want[1], ";".join(want[2]))
        assert {pairs[p]: n for p, n in zip(row["pairs"], row["times"])} == Counter(i * SECOND + j for i, j in want[3])


def test_groups_and_links():
    found = align_ids(np.array([2, 3, 1, 2]), np.array([1, 2, 2, 1, 2]))
    assert found.ends.tolist() == [5, 6, 8]
    assert group_texts(["a", "b", "c", "d"], ["v", "w", "x", "y", "z"], found) == ["a,b|v,w,x", "c|y", "d|z"]
    assert list(zip(found.links_a.tolist(), found.links_b.tolist())) == [(0, 0), (0, 1), (1, 1), (1, 2), (2, 3), (3, 4)]


@pytest.mark.parametrize("text", ["one two  three", "x\ny"])
def test_whole_texts_where_cuts_are_not_safe(text):
    found = alignment.Aligner(*default_tokenizers())
    found._cuts = found._b.cuts = False
    made = found.align(found.split(text))
    want = brute(text)
    assert made.numbers.tolist() == [[want[0], want[1], len(want[2]), len(want[3])]] and made.groups == [";".join(want[2])]
