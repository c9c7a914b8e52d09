import math
import zlib
from collections import Counter

import numpy as np
import pytest

from quillmark.llm import features, quality, queries

SF = "/root/testdata/sf0.01"


def test_weights_follow_planted_preferences():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 4))
    good = x @ np.array([2.0, -1.0, 0, 0]) > 0.8
    s = quality.fit_pairs(x, good).scores(x)
    assert ((s >= 0.5) == good).mean() > 0.95
    assert abs(s[good].mean() - s[~good].mean()) > 0.3


def test_fit_is_the_least_loss_over_all_pairs():
    """The ridge makes the loss strictly convex, so no slope anywhere means the one minimum; slopes by plain loops."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(40, 3))
    good = x[:, 0] + rng.normal(size=40) > 0
    r = quality.fit_pairs(x, good)
    z = ((x - x.mean(0)) / x.std(0)).tolist()
    pairs = [(a, b) for a in range(40) for b in range(40) if good[a] and not good[b]]
    slope = [1e-3 * w for w in r.weights]
    for a, b in pairs:
        diff = [p - q for p, q in zip(z[a], z[b], strict=True)]
        miss = 1 / (1 + math.exp(sum(w * d for w, d in zip(r.weights, diff, strict=True))))
        slope = [s - miss * d / len(pairs) for s, d in zip(slope, diff, strict=True)]
    assert max(map(abs, slope)) < 1e-9
    scores = sorted(sum(w * v for w, v in zip(r.weights, row, strict=True)) for row in z)
    bad = int((~good).sum())
    assert scores[bad - 1] < r.threshold < scores[bad]


def test_query_against_one_process(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    x = {i: features.of_text(t) for i, t in texts.items()}
    learnt = sorted((r["doc_id"], r["quality"]) for r in labels.collect() if r["quality"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1)
    r = quality.fit_pairs(np.array([x[i] for i, _ in learnt]).astype(np.float32).astype(float), np.array([q == 1 for _, q in learnt]), ridge=quality.RIDGE)
    got = {g["doc_id"]: g for g in queries.op9_quality(spark, "/root/testdata/sf0.001").collect()}
    assert got.keys() == x.keys()
    for i, v in x.items():
        assert abs(got[i]["score"] - r.scores(v[None])[0]) < 1e-9 and got[i]["predicted"] == int(got[i]["score"] >= 0.5)


def test_hashed_shares():
    words = Counter(b"One two two THREE".split())
    want = np.zeros(features.WORD_PLACES)
    for w, n in ((b"one", 1), (b"two", 2), (b"three", 1)):
        want[zlib.crc32(w) % features.WORD_PLACES] += n / 4
    assert np.allclose(features.word_shares(words, 4) ** 2, want)
    raw = bytes(range(200)) * 3
    want = np.zeros(features.RUN_PLACES)
    for a in range(len(raw) - 2):
        want[(int.from_bytes(raw[a : a + 3], "little") * 0x9E3779B1 % 2**32) >> 26] += 1 / (len(raw) - 2)
    got = features.run_shares(np.frombuffer(raw, np.uint8))
    assert np.allclose(got**2, want)
    short, features.AT_ONCE = features.AT_ONCE, 7
    try:
        assert np.array_equal(features.run_shares(np.frombuffer(raw, np.uint8)), got)
    finally:
        features.AT_ONCE = short
    assert not features.run_shares(np.frombuffer(b"ab", np.uint8)).any()


def test_held_out_accuracy_and_ranges(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    out = [(r["quality"], got[r["doc_id"]]["predicted"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert np.mean([a == b for a, b in out]) > 0.97


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.3), (2, "", 0.1), (3, "good words here.", 0.2), (3, "good words here.", 0.2), (None, "a", 0.0), (5, "x " * 200_000, 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1)], "doc_id long, quality int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == 6 and all(r["score"] is not None for r in got)
    same = [r["score"] for r in got if r["doc_id"] == 3]
    assert same[0] == same[1]
    none = quality.classify(docs, labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.classify(docs.where("false"), labels).count() == 0


@pytest.mark.parametrize("text", [None, "", "   ", "ÉCOLE!! | #", "a"])
def test_features_are_finite(text):
    assert np.isfinite(features.of_text(text)).all()
