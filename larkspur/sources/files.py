"""Files: readers with fixed schemas, writers with explicit modes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, *, header: bool = True, sep: str = ",",
             encoding: str = "UTF-8", null_text: str = "") -> DataFrame:
    return spark.read.schema(schema).csv(path, header=header, sep=sep, encoding=encoding, nullValue=null_text)


def parse_lines(lines: DataFrame, column: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Split text lines into well-formed rows and the lines that are not.

    ``schema`` is a DDL string; a line with too few or too many fields, or with
    a field of the wrong type, goes to the second result.
    """
    parsed = lines.select(
        "*", F.from_csv(column, f"{schema}, broken string",
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}).alias("row"))
    good = parsed.filter(F.col("row.broken").isNull()).select("row.*").drop("broken")
    bad = parsed.filter(F.col("row.broken").isNotNull()).select(F.col("row.broken").alias("line"))
    return good, bad


def parse_wide(lines: DataFrame, column: str, head: dict[str, str], width: int, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Lines of a few named fields and ``width`` numbers to typed rows with a ``vals`` array, and the lines that are not so.

    An empty number is missing (null); a line with another number of fields,
    or with a field that does not read as its type, goes to the second result.
    """
    fields = F.split(column, sep)
    numbers = F.slice(fields, len(head) + 1, width)
    typed = lines.withColumns({
        "_fields": fields, "_head": F.struct(*[F.get(fields, i).try_cast(kind).alias(name) for i, (name, kind) in enumerate(head.items())]),
        "_vals": F.transform(numbers, lambda x: F.nullif(F.trim(x), F.lit("")).try_cast("double"))})
    wrong = F.exists(F.arrays_zip(numbers.alias("text"), F.col("_vals").alias("value")), lambda x: x["value"].isNull() & (F.trim(x["text"]) != ""))
    whole = (F.size("_fields") == len(head) + width) & F.expr(" AND ".join(f"_head.{name} IS NOT NULL" for name in head)) & ~wrong
    return typed.where(whole).select("_head.*", F.col("_vals").alias("vals")), typed.where(~F.coalesce(whole, F.lit(False))).select(column)


def infer_csv(spark: SparkSession, path: str, *, header: bool = True, share: float = 1.0) -> DataFrame:
    """CSV whose types are found from ``share`` of its rows; one more pass over the files than with a schema."""
    return spark.read.option("inferSchema", True).option("samplingRatio", share).csv(path, header=header)


def infer_lines(lines: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """CSV lines held in a column, with types found from the first line."""
    first = lines.select(column).first()[0]
    parsed = lines.select(F.from_csv(column, F.schema_of_csv(F.lit(first))).alias("row")).select("row.*")
    return parsed.toDF(*names)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_text(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Lines (or, for folders of small files, whole files) with the path they came from."""
    # The argument, not the option: its default would undo the option.
    return spark.read.text(path, wholetext=whole_file, lineSep=None if whole_file else "\n").withColumn("path", F.col("_metadata.file_path"))


def query_parquet(spark: SparkSession, path: str, columns: str, condition: str) -> DataFrame:
    """SQL straight on a path."""
    return spark.sql(f"SELECT {columns} FROM parquet.`{path}` WHERE {condition}")


def read_libsvm(spark: SparkSession, path: str, width: int) -> DataFrame:
    """Sparse lines; the width is given, so no pass is spent on finding it."""
    return spark.read.format("libsvm").option("numFeatures", width).load(path)


def write(df: DataFrame, path: str, fmt: str, mode: str = "errorifexists", files: int | None = None, **options) -> None:
    """Write in one format; ``files`` is only for small exports."""
    out = df if files is None else df.coalesce(files)
    out.write.mode(mode).options(**options).format(fmt).save(path)


def overwrite_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace only the partitions that occur in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def create_partitioned(df: DataFrame, table: str, path: str, partition: str) -> None:
    """A catalogued table over ``path``, one folder per value of ``partition``; what is there already is an error."""
    df.write.mode("errorifexists").partitionBy(partition).option("path", path).format("parquet").saveAsTable(table)


def append_partitioned(df: DataFrame, table: str, partition: str) -> None:
    """Add rows by column name; partitions that are not there yet are made."""
    df.write.mode("append").partitionBy(partition).format("parquet").saveAsTable(table)


def insert_partitions(df: DataFrame, table: str) -> None:
    """Put rows in place of those of the same partitions, by column position as INSERT does; other partitions stay."""
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # the writer's option of that name does not reach an insert
    try:
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def read_partition(spark: SparkSession, path: str, schema: T.StructType, partition: str, value) -> DataFrame:
    """One folder of a partitioned table; the filter prunes all others."""
    return spark.read.schema(schema).parquet(path).filter(F.col(partition) == value)


def new_partitions(df: DataFrame, known: Sequence[str], partition: str) -> DataFrame:
    """Rows of partitions that are not registered yet."""
    return df.filter(~F.col(partition).isin(*known)) if known else df


def hour_slice(df: DataFrame, column: str, as_of: str) -> DataFrame:
    """Rows of the last full hour before ``as_of``, start included, end not."""
    end = F.date_trunc("hour", F.lit(as_of).cast("timestamp")).cast("timestamp_ntz")
    start = end - F.expr("INTERVAL 1 HOUR")
    return df.filter((F.col(column) >= start) & (F.col(column) < end))


def pack(values: Column, half: bool = False) -> Column:
    """Numeric array to one binary field of 4-byte (or 2-byte) floats."""
    kind = "<f2" if half else "<f4"

    @F.pandas_udf("binary")
    def to_bytes(column: pd.Series) -> pd.Series:
        return column.map(lambda v: None if v is None else np.asarray(v, dtype=kind).tobytes())

    return to_bytes(values)


def unpack(blob: Column, half: bool = False) -> Column:
    """The array back from its binary field."""
    kind = "<f2" if half else "<f4"

    @F.pandas_udf("array<float>")
    def to_array(column: pd.Series) -> pd.Series:
        return column.map(lambda b: None if b is None else np.frombuffer(b, dtype=kind).astype("f4"))

    return to_array(blob)
