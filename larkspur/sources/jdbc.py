"""SQL tables over JDBC; the driver jar and the address come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, url: str, table: str, *, column: str, lower: int, upper: int, parts: int,
         properties: dict[str, str]) -> DataFrame:
    """Parallel read: ``parts`` range queries on a numeric column."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts,
                           properties=properties)


def write(df: DataFrame, url: str, table: str, *, mode: str, batch: int, properties: dict[str, str]) -> None:
    options = {"url": url, "dbtable": table, "batchsize": str(batch), **properties}
    df.write.format("jdbc").options(**options).mode(mode).save()
