"""What a catalog entry is, and the layers of a data folder as DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from saleslayers.catalog.mapping import RAW, RUN_TS
from saleslayers.functions.quality import label_quality
from saleslayers.operators import conform
from saleslayers.plans import bronze, silver


@dataclass(frozen=True)
class Query:
    """A query over a data folder and, where SQL can state it, the same result as SQL."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return RAW[name][0](spark, sf_dir)


def bronze_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bronze.ingest(raw(spark, sf_dir, name), bronze.RAW_TABLES[name], RUN_TS)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled lines of a single load, which holds each line once already."""
    return label_quality(conform.sale_orders(bronze_table(spark, sf_dir, "sale_orders")))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.fact_batch(labelled(spark, sf_dir))


def dimension(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    plan = silver.DIMENSIONS[name]
    return silver.dimension_batch(bronze_table(spark, sf_dir, plan.raw_table), plan, RUN_TS)


class StarOf:
    """The star of a data folder; tables that a report does not use are never planned."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._sf_dir = spark, sf_dir

    @cached_property
    def fact(self) -> DataFrame:
        return fact(self._spark, self._sf_dir)

    def __getattr__(self, name: str) -> DataFrame:
        if f"dim_{name}" not in silver.DIMENSIONS:
            raise AttributeError(name)
        return dimension(self._spark, self._sf_dir, f"dim_{name}")
