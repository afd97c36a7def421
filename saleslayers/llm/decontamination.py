"""Benchmark decontamination by winnowing: shared fingerprints first, then exact windows around the hits."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslayers.llm.common import fresh, lower_ascii, written

#: Words of a window, and of a k-gram within it. A window holds WINDOW - K + 1 k-grams; the least hash of
#: these is its fingerprint, so two texts that share a window share its fingerprint.
WINDOW = 10
K = 5

#: What separates words (after lower-casing): ASCII but letters and digits.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def benchmark_words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _SEPARATORS), "")


def fingerprints(tokens: str, length: int) -> Column:
    """The fingerprint of each window of so many words, by start. Windows of up to K words are one k-gram."""
    k = min(K, length)
    per_window = length - k + 1
    words = F.col(tokens)
    grams = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - (k - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, k)]),
    )
    if per_window == 1:
        return grams
    once = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    return once(
        grams,
        lambda g: F.transform(
            F.slice(g, F.lit(1), F.greatest(F.size(g) - (per_window - 1), F.lit(0))),
            lambda h, i: F.least(h, *[F.get(g, i + j) for j in range(1, per_window)]),
        ),
    )


def _benchmark_window(size: int) -> Callable[[Column, Column], Column]:
    return lambda fp, i: F.struct(F.array_join(F.slice("w", i + 1, size), " ").alias("window"), fp.alias("fp"))


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The distinct windows (wid, size, window, fp), and which items hold them (wid, item_id)."""
    rows = items.select(F.col(id_col).alias("item_id"), benchmark_words(F.col(text_col)).alias("w"))
    rows = rows.where(F.size("w") > 0).withColumn("size", F.least(F.size("w"), F.lit(WINDOW)))
    by_size = []
    for size in range(1, WINDOW + 1):
        starts = F.transform(fingerprints("w", size), _benchmark_window(size))
        by_size.append(rows.where(F.col("size") == size).select("item_id", "size", F.inline(starts)))
    held = written(reduce(DataFrame.union, by_size).distinct(), "benchmark-windows")
    windows = held.select("size", "window", "fp").distinct().withColumn("wid", F.monotonically_increasing_id())
    windows = written(windows, "benchmark-distinct")
    return windows, held.join(windows.select("wid", "window", "size"), ["window", "size"]).select("wid", "item_id").distinct()


def _runs(size: int) -> Column:
    """Runs of neighbouring windows with one fingerprint, from the columns w and fps: fp, at (the first start), context.

    A run has as many windows as a window has k-grams at most; where repeated words would make it
    longer, each further start opens another. The context is the words that all its windows span.
    """
    per_window = size - min(K, size) + 1
    fps, words = F.col("fps"), F.col("w")

    def run(fp: Column, i: Column) -> Column:
        opens = (i == 0) | (F.get(fps, i - 1) != fp) | F.coalesce(F.get(fps, i - per_window) == fp, F.lit(False))
        context = F.array_join(F.slice(words, i + 1, per_window + size - 1), " ")
        return F.when(opens, F.struct(fp.alias("fp"), i.alias("at"), context.alias("context")))

    return F.filter(F.transform(fps, run), lambda r: r.isNotNull())


def _contexts(keyed: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """One pass over the texts: the runs whose fingerprint the benchmark has (doc_id, h, size, at, context), and a
    row for each document with size 0 and its number of words as `at`."""
    tokens = keyed.select("doc_id", "h", benchmark_words(F.col("text")).alias("w"))
    # The document's own row takes part in the join under the hash of its text, so that these rows are spread.
    own = F.struct(F.col("h").alias("fp"), (-1 - F.size("w")).alias("at"), F.lit("").alias("context"))
    found = []
    for size in sizes or [WINDOW]:
        marked = tokens.withColumn("fps", fingerprints("w", size))
        runs = _runs(size) if size != (sizes or [WINDOW])[0] else F.concat(F.array(own), _runs(size))
        known = windows.where(F.col("size") == size).select("fp").distinct().withColumn("known", F.lit(True))
        rows = marked.select("doc_id", "h", F.inline(runs)).join(known, "fp", "left").where("known OR at < 0")
        is_own = F.col("at") < 0
        found.append(rows.select("doc_id", "h", F.when(is_own, 0).otherwise(size).alias("size"), F.when(is_own, -1 - F.col("at")).otherwise(F.col("at")).alias("at"), "context"))
    return written(reduce(DataFrame.union, found), "fingerprint-hits")


def _occurrences(contexts: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """Where benchmark windows occur, word for word: doc_id, h, wid, start, size."""
    found = []
    for size in sizes:
        per_window = size - min(K, size) + 1
        words = F.split("context", " ")
        last = F.least(F.lit(per_window - 1), F.size(words) - size)
        spots = F.transform(F.sequence(F.lit(0), last), _window_at(words, size))
        rows = contexts.where(F.col("size") == size).select("doc_id", "h", F.inline(spots))
        known = windows.where(F.col("size") == size).select("window", "wid")
        found.append(rows.join(known, "window").select("doc_id", "h", "wid", "start", F.lit(size).alias("size")))
    if not found:
        return contexts.sparkSession.createDataFrame([], "doc_id long, h long, wid long, start int, size int")
    return reduce(DataFrame.union, found)


def _window_at(words: Column, size: int) -> Callable[[Column], Column]:
    return lambda s: F.struct((F.col("at") + s).alias("start"), F.array_join(F.slice(words, s + 1, size), " ").alias("window"))


def _same_document(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Joined on the document id (null is a value) and the hash of the text, which tells rows of one id apart."""
    right = right.withColumnsRenamed({"doc_id": "_doc_id", "h": "_h"})
    joined = left.join(right, left["doc_id"].eqNullSafe(right["_doc_id"]) & (left["h"] == right["_h"]), how)
    return joined.drop("_doc_id", "_h")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null or empty text has no words and is clean; an item without words is in no document; with an
    empty benchmark all documents are clean. Repeated rows give equal results; rows of one id with
    different texts are judged apart. Null item ids name no item in the list. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
    windows, members = benchmark_windows(items)
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # ten at most
    contexts = _contexts(keyed, windows, sizes)
    spots = written(_occurrences(contexts, windows, sizes), "occurrences")
    # Repeated rows find the same spots again, so they count once.
    covered = F.flatten(F.transform("o", lambda o: F.sequence(o["start"], o["start"] + o["size"] - 1)))
    hit = (
        spots.groupBy("doc_id", "h")
        .agg(F.collect_set(F.struct("start", "size")).alias("o"))
        .select("doc_id", "h", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"))
    )
    listed = (
        spots.select("doc_id", "h", "wid").distinct().join(members, "wid").select("doc_id", "h", F.col("item_id").cast("string").alias("item"))
        .groupBy("doc_id", "h").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    marks = _same_document(hit, listed, "left")
    counted = contexts.where("size = 0").select("doc_id", "h", F.col("at").cast("long").alias("n_words"))
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return _same_document(counted, marks, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_found).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_found, ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that hold no benchmark window; all their columns. An id is dropped with all its rows."""
    gone = fresh(docs, "_gone")
    bad = decontaminate(docs, items, id_col).where("contaminated").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad[gone]), "left_anti")
