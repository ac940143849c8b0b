"""Where jobs keep intermediate tables, and how they cut lineage.

Both use the shared folder named by ``spark.checkpoint.dir``.  Only a local
master with that setting unset gets a fresh temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _LOCAL_ROOT:
        _LOCAL_ROOT[app] = tempfile.mkdtemp(prefix="larkspur-")
        context.setCheckpointDir(_LOCAL_ROOT[app] + "/checkpoints")
    return _LOCAL_ROOT[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused, so retries cannot mix."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: written to the shared folder, survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once and read back, for a result that several branches reuse."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Share out rows ahead of costly per-row work, if a scan has fewer splits than there are cores.

    A large table has splits enough and passes unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
