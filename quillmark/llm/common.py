"""Helpers that several of these operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder name inside the folder that the driver and all executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("name a folder that the driver and all executors share in spark.checkpoint.dir")
        import tempfile  # one machine, one process

        shared = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/quillmark-{uuid.uuid4().hex}"


def staged(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Write ``df`` once and go on from the written table: cuts the lineage in a way that a lost executor can't undo."""
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a staged table that no later step reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    return next(c for c in (stem, *(f"{stem}_{k}" for k in range(len(taken) + 1))) if c.lower() not in taken)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of text that a task unpacks at once.
AT_ONCE = 1 << 22


def bounded(batches: Iterable[pa.RecordBatch], text: int, at_once: int = AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Batches whose column ``text`` holds about ``at_once`` bytes; a longer value stands alone."""
    for b in batches:
        upto = np.cumsum(np.nan_to_num(pc.binary_length(b.column(text)).to_numpy(zero_copy_only=False).astype(float)))
        a = 0
        while a < len(upto):
            z = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + at_once, "right")))
            yield b.slice(a, z - a)
            a = z


#: Bytes of one range of ids, and most ranges: a table of more than their product has larger ranges, as each range is a task.
RANGE, MOST_RANGES = 64 << 20, 1 << 15
#: Tasks that the rows of one key are dealt to in a join that a key may be hot in.
SALTS = 16


def hot_join(rows: DataFrame, table: DataFrame, key: list[str], by: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has one row for a key; a key's rows are dealt out by ``by``.

    The table's row goes where rows of its key are, so it is copied at most ``SALTS`` times and no more often than there are rows.
    """
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(by), F.lit(SALTS)))
    heads = salted.select(*key, "__salt").distinct().join(table, key)
    return salted.join(heads, [*key, "__salt"], how).drop("__salt")


@dataclass(frozen=True)
class Ranges:
    """Ranges of ascending ids: the first id of each, and the weight of all rows before it. A null id comes before all others."""

    first: np.ndarray
    before: np.ndarray
    nulls: bool

    def __len__(self) -> int:
        return len(self.before)

    def of(self, id_col: str) -> Column:
        """Number of the range that an id falls in."""
        first, nulls = self.first, self.nulls

        @F.pandas_udf("int")
        def place(ids):
            import pandas as pd

            got = np.searchsorted(first, ids.fillna(0).to_numpy(np.int64), "right") - 1 + nulls
            return pd.Series(np.where(ids.isna(), 0, got).astype(np.int32))

        return place(F.col(id_col).cast("long"))

    def heads(self, spark: SparkSession) -> DataFrame:
        """(head, part): the first id of each range, as many rows as there are ranges."""
        ids = pa.array([*[None] * self.nulls, *self.first.tolist()], pa.int64())
        return spark.createDataFrame(pa.table({"head": ids, "part": pa.array(np.arange(len(self)), pa.int32())}))


def id_ranges(rows: DataFrame, size: int = RANGE) -> Ranges:
    """Ranges of about ``size`` of the weights in ``rows`` (id, w), where ids are integers; an id of more weight is a range of its own.

    Weights are summed along the ids inside of sorted partitions and from one partition to the next, so no task sees more than its part. There are at most
    MOST_RANGES ranges and one more for each partition, so what comes to the driver, 16 bytes a range, doesn't grow beyond that.
    """
    spark = rows.sparkSession
    at = scratch(spark)
    each = rows.groupBy("id").agg(F.sum("w").alias("w")).repartitionByRange(parts(spark), "id")
    each = staged(each.select("id", "w", F.spark_partition_id().alias("p")), at)  # the partitions' bounds are drawn once
    sums = sorted(each.groupBy("p").agg(F.sum("w").alias("w")).collect())
    size = max(size, sum(r["w"] for r in sums) // MOST_RANGES + 1)
    upto, offset = 0, {}
    for r in sums:
        offset[r["p"]], upto = upto, upto + r["w"]
    along = W.partitionBy("p").orderBy("id")
    told = each.withColumn("b", F.sum("w").over(along.rowsBetween(W.unboundedPreceding, 0)) - F.col("w"))
    k = F.floor(F.col("b") / size)
    cut = told.withColumn("new", F.coalesce(k != F.lag(k).over(along), F.lit(True))).where("new")
    got = cut.select("p", F.col("id").cast("long").alias("id"), F.col("b").cast("long").alias("b")).toArrow().sort_by("id")  # nulls are last
    discard(spark, at)
    first = got["id"].to_pylist()
    before = [offset[p] + b for p, b in zip(got["p"].to_pylist(), got["b"].to_pylist(), strict=True)]
    nulls = bool(first) and first[-1] is None
    if nulls:
        first, before = first[:-1], [before[-1], *before[:-1]]
    return Ranges(np.array(first, np.int64), np.array(before, np.int64), nulls)
