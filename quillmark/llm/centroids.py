"""Operator 11: clusters of vectors around centroids, each vector's found by a tournament of bisectors.

Components are whole numbers, floor(scale * x). For centroids a < b, |v - a|^2 > |v - b|^2 exactly if
v . 2(b - a) > |b|^2 - |a|^2, so the normal 2(b - a) and the threshold of each pair are whole numbers, too, and are
worked out once a round. A vector's nearest centroid wins a knockout of k - 1 sign tests; in each the smaller number
stands on the left, and zero leaves it in. The distance to the winner alone is then worked out. A round's sums come
from the tasks that read the vectors, one set for a task, so k * size numbers reach the driver, whatever the table's size.

Defined results: vectors that are null, of another length, with null or non-finite components or components beyond
the range of a float take no part. Rows of one id are vectors of their own; null ids come last among first centroids, and rows of equal
hashes stand in the order of their components' bytes. Fewer vectors than k give as many centroids; an empty table gives no rows. Sums are
exact for any float; a distance or an inertia beyond a long is given as the largest long. Other columns aren't looked at.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, scratch, staged

#: Below these, 64-component products are exact in doubles and in longs; at 1024 components still.
FAST, WIDE = 1 << 18, 1 << 24
ROWS = 4096
LONGEST = (1 << 63) - 1
#: Sums travel as two decimals, so that sums of any floats fit.
LIMB = 10**30


def usable(vector: Column, size: int) -> Column:
    """Vectors of that many finite components; a float's range is the limit."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > F.lit(3.4028235677973366e38))
    return F.coalesce((F.size(vector) == size) & ~F.exists(vector, bad), F.lit(False))


def packed(rows: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Whole numbers of each row: as 32-bit numbers, or as decimals where one doesn't fit; and which fit."""
    whole = np.floor(256.0 * rows) if rows.size else rows
    small = (np.abs(whole) < WIDE).all(1)
    data = [None] * len(rows)
    flat = np.where(small[:, None], whole, 0).astype("<i4")
    for k in range(len(rows)):
        data[k] = flat[k].tobytes() if small[k] else ",".join(str(int(x)) for x in whole[k]).encode()
    return data, small


def unpacked(b: pa.RecordBatch, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, rows) of the batch's vectors that fit 32 bits, and of the others as Python's whole numbers."""
    small = b.column("small").to_numpy(zero_copy_only=False)
    data = b.column("x").to_pylist()
    at, rest = np.flatnonzero(small), np.flatnonzero(~small)
    out = []
    if len(at):
        out.append((at, np.frombuffer(b"".join(data[k] for k in at), "<i4").reshape(-1, size)))
    if len(rest):
        out.append((rest, np.array([[int(n) for n in data[k].split(b",")] for k in rest], object).reshape(-1, size)))
    return out


def whole_vectors(table: DataFrame, id_col: str, vector_col: str, size: int) -> DataFrame:
    """(id, small, x) of the vectors that take part."""

    def run(batches):
        for b in batches:
            rows = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            data, small = packed(rows)
            yield pa.record_batch([b.column(0), pa.array(small), pa.array(data, pa.binary())], ["id", "small", "x"])

    kept = table.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(usable(F.col("v"), size))
    return kept.mapInArrow(run, f"id {dict(table.dtypes)[id_col]}, small boolean, x binary")


class Bisectors:
    """Normals and thresholds of all pairs of centroids, in whole numbers."""

    def __init__(self, centroids: list[list[int]]):
        self.exact = np.array(centroids, object).reshape(len(centroids), -1)
        self.largest = max((abs(x) for c in centroids for x in c), default=0)
        self.ready: dict = {}

    def of(self, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if kind not in self.ready:
            c = self.exact.astype(kind)
            square = (c * c).sum(1)
            self.ready[kind] = c, 2 * (c[None] - c[:, None]), square[None] - square[:, None]
        return self.ready[kind]

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Winner and squared distance of each row, and the rows in the numbers that were exact for them."""
        top = max(self.largest, max((abs(int(x)) for x in (rows.min(), rows.max())), default=0)) if rows.size else self.largest
        kind = np.float64 if top < FAST else np.int64 if top < WIDE else object
        c, normal, cut = self.of(kind)
        x, k = rows.astype(kind), len(c)
        left = np.arange(0, k - 1, 2)
        side = x @ normal[left, left + 1].T > cut[left, left + 1]
        alive = np.where(side, left + 1, left)
        if k % 2:
            alive = np.concatenate([alive, np.full((len(x), 1), k - 1)], 1)
        while alive.shape[1] > 1:
            pairs = alive.shape[1] // 2
            won = []
            for j in range(pairs):
                a, b = alive[:, 2 * j], alive[:, 2 * j + 1]
                n = normal[a, b]
                score = np.einsum("ij,ij->i", x, n) if kind is not object else (x * n).sum(1)
                won.append(np.where(score > cut[a, b], b, a))
            alive = np.stack(won + ([alive[:, -1]] if alive.shape[1] % 2 else []), 1)
        w = alive[:, 0].astype(np.int64)
        return w, ((x - c[w]) ** 2).sum(1), x


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    size = len(centroids[0])

    def run(batches):
        field = Bisectors(centroids)
        for b in batches:
            cluster, distance = np.zeros(len(b), np.int32), np.zeros(len(b), np.int64)
            for at, rows in unpacked(b, size):
                for a in range(0, len(at), ROWS):
                    w, d, _ = field.nearest(rows[a : a + ROWS])
                    cluster[at[a : a + ROWS]] = w
                    distance[at[a : a + ROWS]] = [min(int(v), LONGEST) for v in d] if d.dtype == object else d
            yield pa.record_batch([b.column("id"), pa.array(cluster), pa.array(distance)], ["id", "cluster", "distance"])

    return vectors.mapInArrow(run, f"id {dict(vectors.dtypes)['id']}, cluster int, distance long")


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round: the floor of the exact mean of each; those without vectors stay."""
    size, k = len(centroids[0]), len(centroids)

    def run(batches):
        field = Bisectors(centroids)
        sums, count = np.zeros((k, size), object), np.zeros(k, np.int64)
        for b in batches:
            for _, rows in unpacked(b, size):
                for a in range(0, len(rows), ROWS):
                    w, _, x = field.nearest(rows[a : a + ROWS])
                    own = (w[None] == np.arange(k)[:, None]).astype(x.dtype)
                    part = own @ x
                    sums += part if part.dtype == object else part.astype(np.int64).astype(object)
                    count += np.bincount(w, minlength=k)
        c, i = (z.ravel() for z in np.meshgrid(np.flatnonzero(count), np.arange(size), indexing="ij"))
        split = [divmod(int(s), LIMB) for s in sums[c, i]]
        high, low = ([Decimal(s[j]) for s in split] for j in (0, 1))
        kind = pa.decimal128(38, 0)
        yield pa.record_batch([pa.array(c, pa.int32()), pa.array(i, pa.int32()), pa.array(count[c]), pa.array(high, kind), pa.array(low, kind)], ["cluster", "i", "n", "high", "low"])

    parts = vectors.mapInArrow(run, "cluster int, i int, n long, high decimal(38,0), low decimal(38,0)")
    out = [list(c) for c in centroids]
    for r in parts.groupBy("cluster", "i").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")]).collect():  # k * size rows
        out[r["cluster"]][r["i"]] = (int(r["high"]) * LIMB + int(r["low"])) // r["n"]
    return out


def first_centroids(vectors: DataFrame, k: int, seed: int, size: int) -> list[list[int]]:
    """The k vectors whose ids have the smallest hashes, in the order of these."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.select("small", "x", rank.alias("rank")).orderBy(F.col("rank").asc_nulls_last(), "x").limit(k).collect()
    b = pa.record_batch([pa.array([r["small"] for r in rows], pa.bool_()), pa.array([bytes(r["x"]) for r in rows], pa.binary())], ["small", "x"])
    out: list[list[int]] = [[] for _ in rows]
    for at, whole in unpacked(b, size):
        for place, row in zip(at, whole.tolist(), strict=True):
            out[place] = [int(n) for n in row]
    return out


def clusters(table: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, size: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part."""
    spark = table.sparkSession
    at = scratch(spark)
    vectors = staged(whole_vectors(table, id_col, vector_col, size), f"{at}/vectors")
    centroids = first_centroids(vectors, k, seed, size)
    kind = dict(table.dtypes)[id_col]
    if not centroids:
        return spark.createDataFrame([], f"{id_col} {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    found = staged(assigned(vectors, centroids), f"{at}/found")
    discard(spark, f"{at}/vectors")
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}  # at most k rows
    total = min(sum(sums.values()), LONGEST)
    about = [(c, min(s, LONGEST), total, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, s in sums.items()]
    told = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = found.join(F.broadcast(told), "cluster")  # at most k rows
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
