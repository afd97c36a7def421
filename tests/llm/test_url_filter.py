import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleslayers.llm import url_filter
from saleslayers.llm.catalog import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "http://A.Example.NET", "http://a.net/", "http://net/x", "https://example.net/en/1?q#f", "https://www.example.net/en", "https://x.example.net/en/y",
    "http://example.com/de/a", "http://badexample.com/de/a", "ftp://u.org/fr/", "ftp://u.org?x=/fr/", "http://a://b/c", "HTTP://É.ORG/FR/", "http://h#/net/", "x://y.org/fr/z#q?r", "http://cheap-pills.example.com/en/1",
]


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c.group().lower(), m.group(1)), m.group(2)) if m else ("", "")


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.fit(url_filter.labelled_urls(spark))


def test_hosts_paths_and_rules(spark, model):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(4, URLS[4])], "page_id long, url string").withColumns({"host": F.lit("x"), "_grams": F.lit(1)})
    rows = url_filter.judge(pages, URL_RULES, model).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        host, path = parts(URLS[r.page_id])
        assert (r.host, r.path) == (host, path)
        fit = [k for k in URL_RULES if (host == k.split("/")[0] or host.endswith("." + k.split("/")[0])) and path.startswith(k[k.index("/") :])]
        assert r.rule == (max(fit, key=len) if fit else None)
        assert r.verdict == URL_RULES[r.rule] if r.rule else r.verdict in ("allow", "block")


def accuracy(spark, is_out):
    """Over the hosts that are left out of the fit."""
    labelled = url_filter.labelled_urls(spark).collect()
    model = url_filter.fit(spark.createDataFrame([r for r in labelled if not is_out(r.url)], "url string, label double"))
    test = spark.createDataFrame([(k, r.url, r.label) for k, r in enumerate(labelled) if is_out(r.url)], "page_id long, url string, label double")
    got = {r.page_id: r.verdict for r in url_filter.judge(test, {}, model).collect()}
    return np.mean([(got[r.page_id] == "block") == (r.label == 1.0) for r in test.collect()])


def test_held_out_names(spark):
    every = url_filter.names(url_filter.BLOCK_FIRST, url_filter.BLOCK_SECOND) + url_filter.names(url_filter.ALLOW_FIRST, url_filter.ALLOW_SECOND)
    out = {n for k, n in enumerate(every) if k % 5 == 2}
    assert accuracy(spark, lambda url: any(n in url for n in out)) > 0.95


@pytest.mark.parametrize("fold", range(2))
def test_names_with_a_word_that_was_never_seen(spark, fold):
    out = [w for words in (url_filter.BLOCK_FIRST, url_filter.ALLOW_FIRST) for k, w in enumerate(words) if k % 4 == fold]
    assert accuracy(spark, lambda url: any(f"{w}-" in url for w in out)) >= 0.85


def test_labels_of_ones_own_and_no_pages(spark):
    labelled = spark.createDataFrame([("http://good.org/a", 0), ("http://good.org/b", 0), ("http://evil.org/a", 1), (None, 1), ("http://evil.org/b", None)], "url string, label int")
    model = url_filter.fit(labelled)
    pages = spark.createDataFrame([(1, "http://evil.org/c"), (2, "http://good.org/c")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.judge(pages, {}, model).collect()} == {1: "block", 2: "allow"}
    assert url_filter.judge(pages.limit(0), URL_RULES, model).count() == 0
