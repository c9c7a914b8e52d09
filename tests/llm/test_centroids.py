import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmark.llm import centroids


def plain(rows, k=40, rounds=5, size=64):
    """Lloyd's rounds with Python's whole numbers and all distances."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    centre = [v for _, v in sorted(kept, key=lambda r: hashlib.sha256(f"2:{r[0]}".encode()).hexdigest())[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centre))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(near(v)[1], []).append(v)
        centre = [[sum(x) // len(own[n]) for x in zip(*own[n], strict=True)] if n in own else c for n, c in enumerate(centre)]
    found = [(i, near(v)) for i, v in kept]
    inertia = {}
    for _, (d, n) in found:
        inertia[n] = inertia.get(n, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    return sorted((i, n, d, inertia[n], sum(inertia.values()), sha[n]) for i, (d, n) in found)


def got(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted(tuple(r[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in centroids.clusters(df, **more).collect())


def test_against_all_distances(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=64)]) for i in range(300)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(40)]  # ties and copies
    odd = [(2000, None), (2001, [1.0] * 63), (2002, [1.0] * 63 + [None]), (2003, [math.nan] * 64), (2004, [math.inf] * 64), (2005, [0.0] * 64)]
    assert got(spark, rows + odd) == plain(rows + odd)


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    rng = random.Random(5)
    rows = [(i, [float(rng.randrange(2)) / 256] * 64) for i in range(60)]
    assert got(spark, rows) == plain(rows)


def test_few_vectors_empty_table_and_clashing_names(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    assert got(spark, rows) == plain(rows)
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert centroids.clusters(df).count() == 0
    more = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cluster", F.lit("x")).withColumn("ID", F.lit(1)).withColumn("x", F.lit(2))
    assert centroids.clusters(more).count() == 3


@pytest.mark.parametrize("scale", [1.0, 3e3, 1e5])
def test_exact_at_any_length(spark, scale):
    rng = np.random.default_rng(7)
    rows = [(i, [float(np.float32(x * scale)) for x in rng.normal(size=64)]) for i in range(70)]
    assert got(spark, rows, k=6) == plain(rows, k=6)


def test_beyond_a_long(spark):
    rows = [(1, [3e38] * 64), (2, [-3e38] * 64), (3, [2.9e38] * 64), (4, [-2.9e38] * 64)]
    out = got(spark, rows, k=2)
    assert out[0][1] == out[2][1] != out[1][1] == out[3][1] and {r[2] for r in out} == {centroids.LONGEST}


def test_null_ids_take_part(spark):
    df = spark.createDataFrame([(None, [1.0] * 64), (None, [1.0] * 64), (4, [0.0] * 64)], "vec_id long, embedding array<float>")
    out = centroids.clusters(df).collect()
    assert len(out) == 3 and {r["distance"] for r in out} == {0}


def test_tournament_finds_the_nearest():
    rng = np.random.default_rng(11)
    for k in (1, 2, 3, 5, 40):
        c = rng.integers(-9, 9, (k, 8))
        x = rng.integers(-9, 9, (500, 8))
        w, d, _ = centroids.Bisectors(c.tolist()).nearest(x)
        every = ((x[:, None] - c[None]) ** 2).sum(2)
        assert (w == every.argmin(1)).all() and (d == every.min(1)).all()
