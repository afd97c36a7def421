"""Line-first cleaning: judge each line, drop the failing ones, then reject documents that lose too much text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslayers.llm.common import fresh, words

#: Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"

#: A document is rejected if its failing lines hold more than this share of its words.
MAX_LOST_PERCENT = 40

#: A line is navigation if it is short items between separators: four or more of at most 30 characters each, not
#: counting white space around them. Runs of white space and separators are taken whole (possessive), so that a
#: line is read about once, however long such runs are.
NAVIGATION = (
    r"^(?![|»›>•·])(?:\s*+(?:[^|»›>•·\s](?:[^|»›>•·]{0,28}[^|»›>•·\s])?\s*+)?[|»›>•·]++){3,}+"
    r"\s*+[^|»›>•·]{0,30}+\z"
)
#: Phrases of page furniture; a line counts only if it is short enough to be little else.
BOILERPLATE = (
    r"(?i)\b(?:all rights reserved|accept (?:all )?cookies|cookie policy|privacy policy|terms of (?:use|service)"
    r"|enable javascript|click here|sign up for our newsletter|subscribe to our newsletter|share (?:this )?on"
    r"|skip to (?:main )?content|lorem ipsum|log in|sign in)\b"
)
BOILERPLATE_MAX_CHARS = 200
#: A line fails on punctuation if more than this share of its characters besides white space are marks.
MAX_MARK_PERCENT = 25
MARKS = r"[^\p{L}\p{M}\p{N}\s]"
#: ... or if it shouts: this many runs of two or more exclamation or question marks.
SHOUTS = r"(?:[!?]{2,}.*?){3}"


def line_fails(line: Column) -> Column:
    """Whether a line breaks the navigation, boilerplate or punctuation rules."""
    visible = F.length(F.regexp_replace(line, r"\s+", ""))
    marks = F.regexp_count(line, F.lit(MARKS))
    return (
        line.rlike(NAVIGATION)
        | ((F.length(line) <= BOILERPLATE_MAX_CHARS) & line.rlike(BOILERPLATE))
        | (marks * 100 > visible * MAX_MARK_PERCENT)
        | line.rlike(SHOUTS)
    )


def _repeated_words(tokens: str, trigrams: str) -> Column:
    """Words within three-word windows that occur twice or more, from the columns of words and windows.

    Windows are sorted with their places, so that equal ones are neighbours; a word counts once
    however many such windows hold it.
    """
    placed = F.sort_array(F.transform(F.col(trigrams), lambda t, i: F.struct(t.alias("t"), i.alias("i"))))

    def places(rows: Column) -> Column:
        def shared(x: Column, j: Column) -> Column:
            same = lambda k: F.coalesce(F.get(rows, k)["t"] == x["t"], F.lit(False))
            return F.when(same(j - 1) | same(j + 1), x["i"])

        return F.sort_array(F.array_compact(F.transform(rows, shared)))

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(starts, j + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    # let-bindings: an array of one element, transformed, evaluates its element once
    once = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    repeats = F.size(F.array_distinct(trigrams)) < F.size(trigrams)
    return F.when(repeats, once(placed, lambda rows: once(places(rows), covered))).otherwise(F.lit(0)).cast("long")


def judge(docs: DataFrame, text_col: str = "text", into: str = "quality") -> DataFrame:
    """The documents with one more column, a struct of measures and verdict. No row is dropped or moved.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    n_failed_lines and clean_text (the text without failing lines). A null or empty text has no
    words, fails the base rules and has an empty clean_text. Repeated rows are judged alike; other
    columns pass through, whatever their names.
    """
    names = ("text", "words", "tri", "lines", "good", "m")
    text, tokens, tri, lines, good, m = (fresh(docs, f"_q_{n}") for n in names)
    n = F.size(tokens)
    step = (
        docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
        .withColumn(tokens, words(F.col(text)))
        .withColumn(
            tri,
            F.transform(
                F.slice(F.col(tokens), F.lit(1), F.greatest(n - 2, F.lit(0))),
                lambda w, i: F.concat_ws(" ", w, F.get(F.col(tokens), i + 1), F.get(F.col(tokens), i + 2)),
            ),
        )
        .withColumn(lines, F.split(F.col(text), "\n", -1))
        .withColumn(good, F.filter(F.col(lines), lambda line: ~line_fails(line)))
    )
    worded = F.filter(F.col(lines), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    n_words = n.cast("long")
    clean_text = F.array_join(F.col(good), "\n")
    all_good = F.size(good) == F.size(lines)
    measures = step.withColumn(
        m,
        F.struct(
            n_words.alias("n_words"),
            F.length(F.array_join(tokens, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size(worded) - F.size(F.array_distinct(worded))).cast("long").alias("n_dup_lines"),
            _repeated_words(tokens, tri).alias("n_repeat_words"),
            (F.size(lines) - F.size(good)).cast("long").alias("n_failed_lines"),
            F.when(all_good, n_words)
            .otherwise(F.regexp_count(clean_text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"))
            .alias("clean_words"),
            F.when(all_good, F.col(text)).otherwise(clean_text).alias("clean_text"),
        ),
    )
    q = F.col(m)
    failed = (q["n_words"] < MIN_WORDS) | (q["n_repeat_words"] * 100 > q["n_words"] * MAX_REPEATED_PERCENT)
    lost = (q["n_words"] - q["clean_words"]) * 100 > q["n_words"] * MAX_LOST_PERCENT
    verdict = [failed.alias("base_failed"), (~failed & ~lost).alias("kept")]
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_failed_lines", "clean_text")
    return measures.withColumn(into, F.struct(*[q[f].alias(f) for f in fields], *verdict)).drop(
        text, tokens, tri, lines, good, m
    )


def clean(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that pass, without their failing lines; the same columns, n_chars (if any) kept true."""
    q, keep, cleaned_text = (fresh(docs, n) for n in ("_quality", "_keep", "_clean"))
    verdict = F.struct(F.col(q)["kept"].alias(keep), F.col(q)["clean_text"].alias(cleaned_text))
    # Through a generator: a filter on a plain column would be moved below it, and all rules computed once more.
    judged = judge(docs, text_col, q).select(*docs.columns, F.inline(F.array(verdict)))
    cleaned = judged.where(keep).withColumn(text_col, F.col(cleaned_text))
    if "n_chars" in docs.columns and text_col == "text":
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.length(text_col).cast(kind))
    return cleaned.select(*docs.columns)
