import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmark.llm import neardup

SF = "/root/testdata/sf0.01"


def word_sets(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = {i: word_sets(t) for i, t in rows}
    ids = sorted(sets)
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    index = {}
    for i in ids:
        for s in sets[i]:
            index.setdefault(s, []).append(i)
    pairs = {(a, b) for g in index.values() for k, a in enumerate(g) for b in g[k + 1 :]}
    for a, b in pairs:
        n = len(sets[a] & sets[b])
        if n and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def got(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(df).collect()}


def test_against_brute_force_on_chains_and_edited_copies(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(500)]
    rows, i = [], 0
    for _ in range(12):
        base = rng.choices(words, k=rng.randrange(30, 300))
        for _ in range(rng.randrange(1, 14)):
            t = list(base)
            for _ in range(rng.randrange(0, max(2, len(t) // 25))):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((i, " ".join(t)))
            i += 1
            if rng.random() < 0.3:
                base = t  # a chain
    rng.shuffle(rows)
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (7, "É a b c d"), (8, "é a b c d"), (9, "w " * 60_000), (10, "w " * 50_000)]
    out = got(spark, rows)
    assert out == brute(rows) and out[5] == (1, 4, False) and out[2] == (0, 2, True) and out[8][1] == 8 and out[10][1] == 9
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(empty).count() == 0
    more = spark.createDataFrame([(1, "a b", 2, "x"), (1, "a b", 2, "x"), (None, "a b", 0, "y")], "doc_id long, text string, n long, key string")
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in neardup.near_duplicates(more).collect()) == [(-1, 1), (1, 1), (1, 1)]


def test_whole_table_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(spark, rows) == brute(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.booleans(), min_size=64, max_size=64), st.integers(0, 31))
def test_every_pair_within_the_radius_shares_an_entry(order, errors):
    rng = np.random.default_rng(sum(order) + errors)
    x = rng.integers(0, 1 << 16, 64)
    y = x.copy()
    at = rng.permutation(64)[:errors]
    y[at] += 1
    same = (x == y).reshape(-1, neardup.CHUNK).sum(1)
    assert (same >= neardup.CHUNK - 1).any()


def test_hot_key_is_split_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rng = random.Random(1)
    base = [f"v{k}" for k in range(200)]
    rows = []
    for i in range(60):
        t = list(base)
        for _ in range(rng.randrange(0, 14)):
            t[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    assert got(spark, rows) == brute(rows)


def test_texts_that_no_pair_names_are_not_moved(spark):
    docs = spark.range(20_000).selectExpr("id doc_id", "concat('a b c d e ', id) text")
    ids = spark.range(0, 20_000, 100).toDF("id")
    few = neardup.likely(docs.withColumnRenamed("doc_id", "id"), ids)
    found = {r["id"] for r in few.collect()}
    assert found >= set(range(0, 20_000, 100)) and len(found) < 250
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sets = neardup.full_sets(ids, docs, "doc_id", "text")
        assert {r["id"] for r in sets.collect()} == set(range(0, 20_000, 100))
        plan = sets._jdf.queryExecution().sparkPlan().toString()  # the root comes first
        assert plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
