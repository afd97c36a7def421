"""URL verdicts: rules by host and path, and a logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslayers.llm.common import lower_ascii

#: Lengths of the n-grams, number of hashed features, and the regression's ridge.
GRAMS = (3, 4)
FEATURES = 1 << 16
RIDGE = 0.01
#: At most so many labelled rows are fitted on (the first by the hash of their url); the table is meant to be small.
MAX_LABELLED = 20_000

#: Words whose pairs name the hosts of the small labelled table, by what such sites offer.
BLOCK_FIRST = ("poker", "roulette", "jackpot", "betting", "viagra", "cialis", "steroid", "pharmacy", "porn", "erotic", "escort", "webcam", "loan", "forex", "crypto", "lottery", "warez", "torrent", "keygen", "replica")
BLOCK_SECOND = ("bonus", "cheap", "deals", "discount", "free", "hot", "instant", "offers", "online24", "profit", "sale", "winner")
ALLOW_FIRST = ("astronomy", "biology", "chess", "choir", "climate", "cooking", "court", "football", "geology", "history", "hospital", "language", "law", "museum", "parliament", "physics", "poetry", "railway", "school", "weather")
ALLOW_SECOND = ("academy", "archive", "association", "bulletin", "centre", "council", "foundation", "institute", "journal", "library", "review", "society")
#: Ends of hosts and paths that both labels have, and paths of blocked ones only.
HOSTS = ("www.{}.com", "{}.net", "blog.{}.org", "{}.info")
PLAIN_PATHS = ("/", "/index.html", "/about", "/2024/05/page-3", "/news/archive.php")
BLOCK_PATHS = ("/buy-now", "/free-signup")


def names(first: tuple[str, ...], second: tuple[str, ...]) -> list[str]:
    return [f"{a}-{b}" for a, b in product(first, second)]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table: url and label, 1 for block; 480 names at four hosts each. Callers may bring
    their own instead. Both labels share hosts' ends and most paths, so the names decide."""
    rows = []
    for label, named, paths in ((1.0, names(BLOCK_FIRST, BLOCK_SECOND), PLAIN_PATHS + BLOCK_PATHS), (0.0, names(ALLOW_FIRST, ALLOW_SECOND), PLAIN_PATHS)):
        rows += [(f"https://{end.format(name)}{paths[(i + j) % len(paths)]}", label) for i, name in enumerate(named) for j, end in enumerate(HOSTS)]
    return spark.createDataFrame(rows, "url string, label double")


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A to Z lowered; empty for null or where there is no ://."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host_col: Column, path_col: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; both null if none does.

    A rule is written host/path. It fits its host and all subdomains, where the path starts with its own.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):  # the last that fits wins
        rule_host, slash, rest = rule.partition("/")
        fits = ((host_col == rule_host) | host_col.endswith(f".{rule_host}")) & path_col.startswith(slash + rest)
        name = F.when(fits, rule).otherwise(name)
        verdict = F.when(fits, rules[rule]).otherwise(verdict)
    return name, verdict


def _grams(text: Column, tag: str) -> Column:
    """Character n-grams with the ends marked, tagged by where they come from."""
    bounded = F.concat(F.lit("^"), text, F.lit("$"))
    ends = [F.greatest(F.length(bounded) - (size - 1), F.lit(1)) for size in GRAMS]
    one_length = [F.transform(F.sequence(F.lit(1), end), _piece(bounded, size, tag)) for end, size in zip(ends, GRAMS)]
    return F.concat(*one_length)


def _piece(text: Column, size: int, tag: str) -> Callable[[Column], Column]:
    return lambda i: F.concat(F.lit(tag), F.substr(text, i, F.lit(size)))


def features(urls: DataFrame, host_col: str, path_col: str, into: str) -> DataFrame:
    return urls.withColumn(into, F.concat(_grams(F.col(host_col), "h:"), _grams(F.col(path_col), "p:")))


def fit(labelled: DataFrame) -> PipelineModel:
    """A model from a small table (url, label). Null urls have empty parts; a table of one label gives that label."""
    bounded = labelled.select("url", F.col("label").cast("double").alias("label")).where(F.col("label").isNotNull())
    bounded = bounded.orderBy(F.xxhash64("url"), "url", "label").limit(MAX_LABELLED)
    rows = features(bounded.select(host(F.col("url")).alias("_host"), path(F.col("url")).alias("_path"), "label"), "_host", "_path", "_grams")
    hashing = HashingTF(numFeatures=FEATURES, inputCol="_grams", outputCol="_features", binary=True)
    regression = LogisticRegression(featuresCol="_features", labelCol="label", predictionCol="_block", probabilityCol="_probability", rawPredictionCol="_raw", regParam=RIDGE, maxIter=50, standardization=False)
    return Pipeline(stages=[hashing, regression]).fit(rows)


def judge(pages: DataFrame, rules: dict[str, str], model: PipelineModel, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: page_id, host, path, rule, verdict and the model's block probability.

    Rows are judged one by one, so repeated rows agree; null and malformed urls have empty host and
    path and get the model's verdict on these. No row is moved, and only these two columns are read.
    """
    parts = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url"))
    parts = parts.select("page_id", host(F.col("_url")).alias("host"), path(F.col("_url")).alias("path"))
    scored = model.transform(features(parts, "host", "path", "_grams"))
    rule, ruled = rule_for(F.col("host"), F.col("path"), rules)
    modelled = F.when(F.col("_block") == 1.0, "block").otherwise("allow")
    chance = F.get(vector_to_array("_probability"), F.lit(1))
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(ruled, modelled).alias("verdict"), chance.alias("block_probability"))
