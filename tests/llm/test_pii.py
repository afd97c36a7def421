import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from saleslayers.llm import pii

# The base patterns as they are stated, apart from the operator's linear ones.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def counts(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        twice = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(x - 9 if x > 9 else x for x in twice) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    found = [(m.start(), n, m.end(), k) for n, (k, p) in enumerate(STATED.items()) for m in re.finditer(p, text or "") if counts(k, m.group())]
    return sorted(found)


def test_base_spans_match_the_stated_patterns(spark):
    choose = random.Random(5)
    texts = ["".join(choose.choice(a) for _ in range(choose.randint(0, n))) for a, n in (("aB1.@-+ ()%_9é\U0001f600,4\n", 80), ("0123456789 -.+()@a", 200)) for _ in range(600)]
    texts += [None, "", "a@b.c_d@e.f x@y.z.@q.w a@b..c", "x@y.z " * 1500, "a" * 50_000, "1" * 30_000 + ".2.3", "+1" + " (" * 20_000,
              "4111 1111 1111 1111, 4111-1111-1111-1112 \U0001f600 +1 (499) 555-6503 8.196.197.208 001.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"spans": F.lit(1), "terms": F.lit(2), "h": F.lit(3)})
    rows = {r.doc_id: r for r in pii.find(docs).collect()}
    for i, text in enumerate(texts):
        want, r = base(text), rows[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[3] == k for x in want) for k in STATED]
        listed = ",".join(f"{k}:{s}:{e}" for s, _, e, k in want)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def people():
    docs = [(i, f"Please write to Jonathan Kowalski at jk{i % 5}@corp.com about item {'abcdefghij'[i % 10] * 4} soon") for i in range(20)]
    return docs + [(100 + i, "please write to the office about item lists and call soon " * 2) for i in range(80)]


def brute_terms(docs):
    """Term spans by row, with what they leave, by dictionaries over rows."""
    near, rows_of, texts_of, n_term = {}, {}, {}, {}
    for row, (_, text) in enumerate(docs):
        for t in set(re.findall(r"[^\W\d_]{3,}", (text or "").lower())):
            n_term[t] = n_term.get(t, 0) + 1
        spans = base(text)
        for s, n, e, kind in spans:
            entity = (kind, text[s:e].lower() if kind == "email" else re.sub("[^0-9.+]", "", text[s:e]))
            a = max([s - 80, 0, *[x[2] for x in spans if x[1] == n and x[2] <= s]])
            z = min([e + 80, len(text), *[x[0] for x in spans if x[1] == n and x[0] >= e]])
            rows_of.setdefault(entity, set()).add(row)
            texts_of.setdefault(entity, set()).add(text)
            for m in re.finditer(r"[^\W\d_]{3,}", text):
                cut = (m.start() == s - 80 == a and text[a - 1 : a].isalpha()) or (m.end() == z == e + 80 and text[z : z + 1].isalpha())
                if not cut and (a <= m.start() and m.end() <= s or e <= m.start() and m.end() <= z):
                    near.setdefault((entity, m.group().lower()), []).append((row, m.start(), m.end()))
    found = {}
    for (entity, term), places in near.items():
        both, alone = len({r for r, _, _ in places}), len(texts_of[entity]) == 1
        left = math.log2((n_term[term] + (pii.PRIOR if alone else 0)) / both)
        told = math.log2(len(docs) / len(rows_of[entity])) - left
        if (alone or len({docs[r][1] for r, _, _ in places}) >= 2) and left <= pii.GENERALISE and told >= (pii.TOLD_ALONE if alone else pii.TOLD):
            for row, s, e in places:
                if not any(x[0] < e and s < x[2] for x in base(docs[row][1])):
                    found.setdefault(row, {})[s, e] = min(left, found.get(row, {}).get((s, e), 99))
    return found


def test_terms_that_give_an_entity_away(spark):
    docs = people()
    rows = {r.doc_id: r for r in pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = brute_terms(docs)
    for row, (i, text) in enumerate(docs):
        places = want.get(row, {})
        assert {s for s in rows[i].spans.split(",") if s.startswith("term")} == {f"term:{s}:{e}" for s, e in places}
        assert ("Kowalski" in {text[s:e] for s, e in places}) == (i < 100)
    assert all(rows[i].spans == "" and rows[i].n_term == 0 for i in range(100, 180))


def test_terms_match_brute_force(spark):
    """Entities of one text and of several, matches that do not count within the context, repeated rows."""
    choose = random.Random(8)
    vocabulary = ["word" + "".join(choose.choice("abcdefgh") for _ in range(4)) for _ in range(2500)]
    values = ["a%d@b.org" % (k // 2) for k in range(400)] + ["4111 1111 1111 1111", "+1 499 555 65 03", "8.8.4.4", "2024-05-06 17", "12-34", "999.1.1.1", "7"]
    docs = [(i, " ".join(choose.choice(values) if choose.random() < 0.12 else choose.choice(vocabulary) for _ in range(choose.randint(0, 60)))) for i in range(600)]
    docs += [docs[3], docs[3], docs[8], (700, docs[9][1]), (701, None), (702, "12 " * 400 + "near 4111 1111 1111 1112 x " + "4111111111111111 zebra")]
    rows = pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = sorted((r.doc_id, tuple(sorted(s for s in r.spans.split(",") if s.startswith("term")))) for r in rows)
    want = brute_terms(docs)
    assert got == sorted((i, tuple(sorted(f"term:{s}:{e}" for s, e in want.get(row, {})))) for row, (i, _) in enumerate(docs))
    assert sum(map(len, want.values())) > 50


def test_planted_names_are_found_and_common_words_stay(spark):
    choose = random.Random(6)
    common = ["w" + "".join(choose.choice("abcdefghijklmnop") for _ in range(4)) for _ in range(400)]
    name = lambda: "".join(choose.choice("aeiou") + choose.choice("bdfgklmnprstvz") for _ in range(4)).title()
    docs, planted = [], 0
    for i in range(3000):
        text = " ".join(choose.choice(common) for _ in range(60))
        if i % 20 == 0:
            text += f" {name()} {name()} u{i}@mail.org " + " ".join(choose.choice(common) for _ in range(30))
            planted += 2
        docs.append((i, text))
    rows = pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    terms = [docs[r.doc_id][1][int(s.split(":")[1]) : int(s.split(":")[2])] for r in rows for s in r.spans.split(",") if s.startswith("term")]
    right = sum(t[0].isupper() for t in terms)
    assert right >= 0.98 * planted and right >= 0.98 * len(terms)


def test_sanitised_documents(spark):
    docs = people() + [(500, None), (501, ""), (502, "call +49 30 123456 78, card 4111 1111 1111 1111"), (502, "of the same id: a@b.co"), (None, "no id a@b.co")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"n_chars": F.length("text"), "_spans": F.lit("x"), "terms": F.lit(1)})
    out = pii.sanitise(frame)
    assert out.columns == frame.columns
    rows = out.collect()
    assert len(rows) == len(docs)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r.text)
        assert r.n_chars == (None if r.text is None else len(r.text)) and r._spans == "x"
    assert by_id[3] == ["Please write to [TERM] [TERM] at [EMAIL] about item dddd soon"]
    assert by_id[500] == [None] and by_id[501] == [""] and by_id[100] == [docs[20][1]]
    assert sorted(by_id[502]) == ["call [PHONE], card [CARD]", "of the same id: [EMAIL]"] and by_id[None] == ["no id [EMAIL]"]
    assert not any(base(r.text) for r in rows)


def test_rare_terms_near_an_entity_of_one_text(spark):
    docs = [(i, f"please call the office about item lists {i}") for i in range(2000)] + [(5000, "please call Jonathan Kowalski at jk@corp.com about item lists")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    row = pii.find(frame).where("doc_id = 5000").first()
    text = docs[-1][1]
    terms = [text[int(s.split(":")[1]) : int(s.split(":")[2])] for s in row.spans.split(",") if s.startswith("term")]
    assert terms == ["Jonathan", "Kowalski"] and row.n_term == 2
    clean = pii.sanitise(frame).where("doc_id = 5000").first().text
    assert clean == "please call   at [EMAIL] about item lists"  # each name leaves one bit at most: removed


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(none).count() == 0 and pii.sanitise(none).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 256, 257, 1000])
def test_prefix_sums(spark, n):
    steps = [(k * 7) % 11 for k in range(n)]
    got = spark.createDataFrame([(steps,)], "s array<int>").select(pii.prefix_sums(F.col("s"))).first()[0]
    assert got == [sum(steps[:k]) for k in range(n)]
