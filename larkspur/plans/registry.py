"""Named queries: a Spark callable and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from larkspur import fixtures

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


class Tables:
    """The input tables of one folder, read on first use: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        # Times are wall-clock UTC throughout, whatever the machine's zone.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return self.build(Tables(spark, folder))


CATALOGUE: dict[str, Query] = {}


def query(sql: str | None = None, views: str = "", key: str | None = None):
    """Register the decorated function under its own name (or ``key``).

    ``views`` names the stand-in views the SQL refers to; their text is put
    in front of it.
    """

    def register(build: Callable[[Tables], DataFrame]):
        name = key or build.__name__
        if name in CATALOGUE:
            raise ValueError(f"query {name} is registered twice")
        text = fixtures.with_views(views.split(), sql) if sql else None
        CATALOGUE[name] = Query(build, text)
        return build

    return register
