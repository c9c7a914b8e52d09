"""Stages between plans, in the folder that the driver and all executors share."""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession) -> str:
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("name a folder that the driver and all executors share in spark.checkpoint.dir")
        import tempfile  # one machine, one process

        at = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(at)
    return f"{at.rstrip('/')}/stage-{uuid.uuid4().hex}"


#: Spark's setting that frees what was shuffled for a command when it has ended.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scopes = threading.local()


def _written(df: DataFrame, at: str) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        df.write.option("compression", "zstd").parquet(at)
    finally:
        spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)
    return spark.read.schema(df.schema).parquet(at)


def _belongs(at: str, scopes: list) -> None:
    if scopes:
        scopes[-1].append(at)


def staged(df: DataFrame) -> DataFrame:
    """Written as Parquet and read again; what was shuffled for it is freed then."""
    at = shared_path(df.sparkSession)
    _belongs(at, getattr(_scopes, "open", []))
    return _written(df, at)


@contextmanager
def passing(spark: SparkSession):
    """Stages written inside are removed at the end, but those written by the function that it gives (they belong to the scope around, if there is one).

    Frames that read a removed stage can't be used any more.
    """
    scopes = _scopes.open = getattr(_scopes, "open", [])
    outer = list(scopes)
    scopes.append([])

    def keep(df: DataFrame) -> DataFrame:
        at = shared_path(spark)
        _belongs(at, outer)
        return _written(df, at)

    try:
        yield keep
    finally:
        for at in scopes.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
