import hashlib
import random
import re

from pyspark.sql import functions as F

from saleslayers.llm import decontamination

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(docs, items):
    out = {}
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(len(v), 10)
            windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1 if n else 0):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found.add(item_id)
        ids = ",".join(sorted(map(str, found)))
        out[doc_id] = (len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit))
    return out


def test_matches_brute_force(spark):
    choose = random.Random(4)
    vocabulary = ["alpha", "Beta", "c", "Δ", "e1", "naïve"]
    text = lambda n: " ".join(choose.choice(vocabulary) + choose.choice(["", ",", " -"]) for _ in range(n))
    items = [(i, text(choose.choice([1, 3, 5, 6, 9, 10, 11, 14, 30]))) for i in range(25)] + [(90, None), (91, "..."), (7, "a repeated id, of its own text"), (92, "alpha " * 40)]
    docs = [(i, " ".join(choose.choice([text(choose.randint(0, 12)), choose.choice(items)[1] or ""]) for _ in range(choose.randint(0, 6)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "alpha " * 500), (103, items[3][1].upper()), (104, ", ".join(words(items[8][1])))]
    frame = spark.createDataFrame(docs + [docs[3]], "doc_id long, text string").withColumns({"fps": F.lit(1), "w": F.lit(2), "h": F.lit("x")})
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("size", F.lit(0))
    rows = decontamination.decontaminate(frame, bench).collect()
    want = brute(docs, items)
    assert len(rows) == len(docs) + 1
    for r in rows:
        assert tuple(r)[1:] == want[r.doc_id], r.doc_id
    kept = decontamination.clean_documents(frame, bench)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, v in want.items() if not v[-1]}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c"), (None, "d"), (1, "other text of one id")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    rows = decontamination.decontaminate(docs, bench).collect()
    assert sorted((r.n_words, r.contaminated) for r in rows) == [(1, False), (3, False), (5, False)]
    assert decontamination.decontaminate(docs.limit(0), bench).count() == 0
    some = spark.createDataFrame([(5, "d")], "item_id long, text string")
    assert [r.doc_id for r in decontamination.decontaminate(docs, some).where("contaminated").collect()] == [None]
    assert decontamination.clean_documents(docs, some).count() == 2
