import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quillmark.llm import repeats


def plain(rows, window=35):
    """Every window in one table."""
    words = [(t or "").encode().split() for _, t in rows]
    starts = {}
    for r, w in enumerate(words):
        for i in range(len(w) - window + 1):
            starts.setdefault(tuple(w[i : i + window]), []).append((r, i))
    gone = [set() for _ in rows]
    for places in starts.values():
        if len(places) > 1:
            for r, i in places:
                gone[r].update(range(i, i + window))
    kept = [b" ".join(x for i, x in enumerate(w) if i not in g) for w, g in zip(words, gone, strict=True)]
    return sorted((i is not None, i or 0, len(w), len(g), hashlib.sha256(k).hexdigest()) for (i, _), w, g, k in zip(rows, words, gone, kept, strict=True))


def got(spark, rows, window=35):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_words"], r["n_removed"], r["kept_sha256"]) for r in repeats.digests(df, window=window).collect())


def corpus(seed, n=60, vocabulary=400):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)]
    passages = [rng.choices(words, k=rng.choice((20, 34, 35, 36, 60, 120, 300))) for _ in range(10)]
    rows = []
    for i in range(n):
        t = rng.choices(words, k=rng.randrange(0, 120))
        for _ in range(rng.randrange(0, 4)):
            p = list(rng.choice(passages))
            a = rng.randrange(len(p))
            p = p[a:] + (p[:a] if rng.random() < 0.3 else [])
            for _ in range(rng.choice((0, 0, 0, 1, 3))):  # edits
                p[rng.randrange(len(p))] = rng.choice(words)
            at = rng.randrange(len(t) + 1)
            t[at:at] = p
        rows.append((i, " ".join(t)))
    return rows + [(n + k, rows[k][1]) for k in range(5)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_windows(spark, seed):
    rows = corpus(seed)
    assert got(spark, rows) == plain(rows)


@pytest.mark.parametrize("window", [1, 2, 3, 4, 7, 20])
def test_other_windows(spark, window):
    rows = corpus(window, 30, 3000)
    assert got(spark, rows, window) == plain(rows, window)


def test_low_variety(spark):
    rng = random.Random(9)
    rows = [(1, "a " * 200), (2, "a b " * 50), (3, " ".join(rng.choices("ab", k=600))), (4, "b a " * 40 + "c"), (5, " ".join(rng.choices("ab", k=600)))]
    assert got(spark, rows) == plain(rows)


def test_odd_rows(spark):
    long = " ".join(f"x{k}" for k in range(30000))
    once = " ".join(f"y{k}" for k in range(40))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, long), (5, long + " end"), (None, once), (None, once), (7, once), (8, once), (8, once), (9, once[:-4]), (10, "é ü " * 40), (11, "a\x00b \x1c")]
    assert got(spark, rows) == plain(rows)


def test_empty_table_and_clashing_names(spark):
    assert repeats.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = corpus(4, 8)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("marks", F.lit(1)).withColumn("H", F.lit(2)).withColumn("id", F.lit(3)).withColumn("n_words", F.lit(4))
    assert sorted((r["doc_id"], r["n_removed"]) for r in repeats.digests(df).collect()) == sorted((r[1], r[3]) for r in plain(rows))


def test_texts_and_paths(spark):
    passage = " ".join(f"p{k}" for k in range(80))
    df = spark.createDataFrame([(1, f"one {passage} two"), (2, f"three {passage}"), (3, "alone")], "doc_id long, text string")
    assert {r["doc_id"]: r["kept_text"] for r in repeats.without_repeats(df).collect()} == {1: "one two", 2: "three", 3: "alone"}
    found = repeats.repeats(df).collect()
    assert {r["c"] for r in found} == {2} and max(r["length"] for r in found) > repeats.WINDOW  # a path is one piece
    assert len(found) < 2 * (80 - 34)


def test_each_window_holds_a_node():
    rng = random.Random(3)
    for window in (1, 2, 3, 4, 5, 8, 35):
        k, _ = repeats.sizes(window)
        words = [str(rng.randrange(9)).encode() for _ in range(3000)]
        p = repeats.nodes_of(repeats.Sequence(words), window).tolist()
        gaps = [b - a for a, b in zip([-1, *p], [*p, len(words) - k + 1], strict=True)]
        assert max(gaps) <= window - k + 1
