from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from quillmark.llm import nearest

SF = "/root/testdata/sf0.1"


def brute(ids, x, queries, k=20):
    out = {}
    for q in queries:
        v = x[ids.index(q)]
        pairs = sorted((-float(np.dot(x[j], v)), i) for j, i in enumerate(ids) if i != q)[:k]
        out[q] = [(i, -s) for s, i in pairs]
    return out


def found(df, k=20):
    got = {}
    for r in nearest.neighbours(df, F.col("vec_id") % 20 == 0, k).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(got[r["query_id"]]) == r["rank"]
    return got


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / len(w) for q, w in want.items()])


def test_recall_and_scores_on_the_whole_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    ids, x = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], np.float64)
    want = brute(ids, x, [i for i in ids if i % 20 == 0])
    got = found(df)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) > 0.95
    at = {i: k for k, i in enumerate(ids)}
    for q, v in got.items():
        for i, s in v:
            assert abs(s - float(np.dot(x[at[q]], x[at[i]]))) < 1e-12
        assert [s for _, s in v] == sorted((s for _, s in v), reverse=True)


def test_lengths_differ_and_one_vector_is_very_common(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SHARD", 300)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 24)) * rng.uniform(0.2, 3, (1500, 1))
    x[::3] = x[0]
    x = x.astype(np.float32).astype(np.float64)
    ids = list(range(1500))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>")
    want, got = brute(ids, x, ids[::20]), found(df)
    assert recall(got, want) > 0.9
    q = got[60]  # one of the common ones: ties go to smaller ids
    ties = [i for i, s in q if abs(s - float(np.dot(x[0], x[0]))) < 1e-9]
    assert ties == sorted(ties) and 60 not in ties


def test_every_code_within_the_radius_is_probed():
    rng = np.random.default_rng(2)
    index = nearest.Index.__new__(nearest.Index)
    index.codes = rng.integers(0, 256, (3000, 8)).astype(np.uint8)
    index.order = [np.argsort(index.codes[:, j], kind="stable") for j in range(8)]
    index.counts = [np.bincount(index.codes[:, j], minlength=256) for j in range(8)]
    for r in (0, 3, 7, 8, 20, 27, 33, 64):
        code = index.codes[r] if r < 10 else rng.integers(0, 256, 8).astype(np.uint8)
        far = nearest._POP[index.codes ^ code].sum(1)
        assert index.within(code, r).tolist() == np.flatnonzero(far <= r).tolist()


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (20, None, 1), (40, [0.0, 0.0], 1), (3, [float("nan"), 1.0], 1), (4, [None, 1.0], 1), (5, [0.5, 2.0], 1), (5, [0.5, 2.0], 1), (6, [float("inf"), 1.0], 1), (7, [1.0], 1), (None, [1.0, 1.0], 1), (60, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int")
    assert found(df) == {0: [(60, 1.0), (5, 0.5)], 60: [(0, 1.0), (5, 0.5)]}
    assert nearest.neighbours(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    assert found(df.where("vec_id = 40 or vec_id = 20")) == {}


def test_double_vectors_keep_their_precision(spark):
    rows = [(i, [1.0 + i * 1e-9, 2.0]) for i in range(0, 60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want, got = brute([i for i, _ in rows], np.array([v for _, v in rows]), [0, 20, 40]), found(df)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(abs(s - t) < 1e-15 for q in want for (_, s), (_, t) in zip(got[q], want[q], strict=True))


def test_queries_that_find_too_little_search_again(spark, monkeypatch):
    fit = nearest.fit
    monkeypatch.setattr(nearest, "fit", lambda *args: replace(fit(*args), margin=-60.0))  # radii of nearly 0
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 16)).astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = found(df)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in brute(list(range(400)), x, range(0, 400, 20)).items()}


def test_two_vectors_of_one_id_are_one_candidate(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.9, 0.0]), (2, [0.7, 0.0])]
    assert found(spark.createDataFrame(rows, "vec_id long, embedding array<double>")) == {0: [(1, 0.9), (2, 0.7)]}
