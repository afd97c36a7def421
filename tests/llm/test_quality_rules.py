import random
import re
import time

import pytest
from pyspark.sql import functions as F

from saleslayers.llm import quality_rules

GOOD = "\n".join("The " + " ".join(f"word{i}x{j}" for j in range(15)) + " ends here." for i in range(4))


def brute(text):
    words = (text or "").split()
    seen, covered = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered |= {p + k for p in places for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.split()]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


CASES = [None, "", " \n\t", "one", "a b a b a b a b", GOOD, GOOD + "\n" + GOOD, "x | y ## <b> \U0001f600 é\n\nx | y ## <b> \U0001f600 é", "a " * 3000, "a b c " * 20 + "d"]


def test_measures_match_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(CASES)], "doc_id long, text string, kept string")
    rows = {r.doc_id: r.q for r in quality_rules.judge(docs, into="q").collect()}
    for i, text in enumerate(CASES):
        q = rows[i]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == brute(text), text
        assert q.base_failed == (q.n_words < 50 or 100 * q.n_repeat_words > 50 * q.n_words)


def test_lines_go_and_documents_that_lose_too_much(spark):
    menu = "Home | About | News | Contact | Login"
    docs = [(1, GOOD), (2, f"{menu}\n{GOOD}\nAll rights reserved."), (3, GOOD[:300] + ("\n" + menu) * 30), (4, GOOD), (4, GOOD)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"n_chars": F.length("text"), "_quality": F.lit(1)})
    kept = {r.doc_id: r for r in quality_rules.clean(frame).collect()}
    assert set(kept) == {1, 2, 4}
    assert kept[2].text == GOOD and kept[2].n_chars == len(GOOD) and kept[1].text == GOOD
    assert quality_rules.clean(frame).columns == frame.columns and quality_rules.clean(frame).count() == 4


@pytest.mark.parametrize("line", ["** $$$ ## %% &&", "Buy now!! Yes!! Do it!!", "Sign up for our newsletter"])
def test_lines_that_fail(spark, line):
    assert spark.range(1).select(quality_rules.line_fails(F.lit(line))).first()[0]


def test_clean_lines_stay(spark):
    for line in [*GOOD.split("\n"), "", "Ça va – très bien, merci.", "Price: 12.50 euros (about 14 dollars)."]:
        assert not spark.range(1).select(quality_rules.line_fails(F.lit(line))).first()[0], line


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert quality_rules.clean(docs).count() == 0


def test_navigation_is_short_items_between_separators(spark):
    """Against the rule as a plain pattern, which takes quadratic time."""
    plain = re.compile(r"^[ \t\r]*(?:[^|»›>•·]{1,30}[ \t\r]*[|»›>•·]+[ \t\r]*){3,}[^|»›>•·]{0,30}\Z")
    choose = random.Random(3)
    parts = ["|", "|", "»", ">", "a|", "b c »", " ", "  ", "\t", "a", "bc d", "x" * 29, "y" * 30, "z" * 31, " " * 40, "\r"]
    lines = ["".join(choose.choice(parts) for _ in range(choose.randint(0, 11))) for _ in range(800)]
    lines += [choose.choice(["|", " | ", "»"]).join(choose.choice(parts) for _ in range(choose.randint(3, 7))) for _ in range(800)]
    got = spark.createDataFrame([(x,) for x in lines], "line string").select("line", F.col("line").rlike(quality_rules.NAVIGATION).alias("hit")).collect()
    wrong = [r.line for r in got if r.hit != bool(plain.match(r.line))]
    assert not wrong and 100 < sum(r.hit for r in got) < 1400


@pytest.mark.parametrize("unit", [" ", "\t", "|", "!", "a ", "a |", " |", "! ", "x"])
def test_a_line_of_a_megabyte_is_read_about_once(spark, unit):
    docs = spark.createDataFrame([(unit * (1_000_000 // len(unit)) + "x" * 40,)], "line string")
    docs.limit(0).select(quality_rules.line_fails(F.col("line"))).collect()
    start = time.perf_counter()
    docs.select(quality_rules.line_fails(F.col("line"))).collect()
    assert time.perf_counter() - start < 5  # quadratic rules take hours
