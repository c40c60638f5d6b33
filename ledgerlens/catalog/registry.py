"""Query registry and table access."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Parquet tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    name: str
    survey: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, survey: str, sql: str | None = None):
    """Register a query under a name, with the survey ids it covers."""
    def add(build):
        if name in REGISTRY:
            raise KeyError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, survey, build, sql)
        return build
    return add
