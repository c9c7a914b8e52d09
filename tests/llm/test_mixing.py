import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quillmark.llm import mixing

SF = "/root/testdata/sf0.01"


def entropy(w):
    return -sum(x * math.log(x) for x in w if x > 0)


@pytest.fixture(scope="module")
def docs(spark):
    # one source holds a third of all tokens and more
    rows = [(i, "w " * (1 + i % 7), "hot" if i % 3 else f"s{i % 12}") for i in range(3000)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").cache()


def drawn(docs, mix):
    rows = mixing.mixed(docs, mix).collect()
    tokens, copies = defaultdict(int), {}
    for r in rows:
        n = len((r["text"] or "").split())
        tokens[r["source"]] += n * len(r["mix_at"])
        copies[r["doc_id"]] = len(r["mix_at"])
        assert all(0 <= x <= 1 for x in r["mix_at"])
    return rows, tokens, copies


def test_entropy_is_met_and_budget_is_spent(docs):
    rows, tokens, copies = drawn(docs, mixing.Mix(target_entropy=0.9, budget_tokens=20_000))
    weight = {r["source"]: r["mix_weight"] for r in rows}
    assert abs(sum(weight.values()) - 1) < 1e-9
    assert abs(entropy(weight.values()) - 0.9 * math.log(len(weight))) < 1e-5
    for s, w in weight.items():
        assert w * 20_000 - 8 <= tokens[s] <= w * 20_000 + 1e-6


def test_every_document_is_drawn_without_a_budget_and_repeats_are_limited(docs):
    _, tokens, copies = drawn(docs, mixing.Mix(max_repeats=2.0))
    assert min(copies.values()) >= 1 and max(copies.values()) <= 2
    assert tokens["s0"] > sum(1 + i % 7 for i in range(3000) if i % 12 == 0)


def test_brute_force_weights(docs):
    sums = defaultdict(int)
    for r in docs.collect():
        sums[r["source"]] += len(r["text"].split())
    total = sum(sums.values())
    low, high = 0.0, 4.0
    for _ in range(60):
        a = (low + high) / 2
        w = [(v / total) ** a for v in sums.values()]
        low, high = (a, high) if entropy([x / sum(w) for x in w]) > 0.85 * math.log(len(w)) else (low, a)
    z = sum((v / total) ** high for v in sums.values())
    got = {r["source"]: r["mix_weight"] for r in mixing.mixed(docs, mixing.Mix(target_entropy=0.85)).select("source", "mix_weight").distinct().collect()}
    for s, v in sums.items():
        assert abs(got[s] - (v / total) ** high / z) < 1e-6


def test_prefix_of_the_order_holds_the_weights(docs):
    rows = mixing.mixed(docs, mixing.Mix(target_entropy=0.9, budget_tokens=20_000)).collect()
    order = sorted((x, r["source"], len(r["text"].split())) for r in rows for x in r["mix_at"])
    weight = {r["source"]: r["mix_weight"] for r in rows}
    half = defaultdict(int)
    for _, s, n in order[: len(order) // 2]:
        half[s] += n
    total = sum(half.values())
    assert all(abs(half[s] / total - w) < 0.06 for s, w in weight.items())


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y", None), (3, "x y", None), (4, "z " * 50_000, "b"), (None, "k", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as weight", "2 as block")
    got = mixing.mixed(df, mixing.Mix(target_entropy=0.9, max_repeats=3.0))
    assert got.columns[:5] == df.columns and got.count() == 6
    assert min(len(r["mix_at"]) for r in got.collect()) >= 1
    assert mixing.mixed(df.where("false"), mixing.Mix(target_entropy=0.9)).count() == 0


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert mixing.mixed(df, mixing.Mix(target_entropy=0.97, max_repeats=4.0)).count() == df.count()


def shares(spark, *tokens):
    return spark.createDataFrame([(k, "w " * n, f"s{k}") for k, n in enumerate(tokens)], "doc_id long, text string, source string")


def test_limits_that_rule_each_other_out_are_errors(spark):
    df = shares(spark, 600, 300, 100)
    with pytest.raises(ValueError, match=r"can't be met: .* 2 repetitions"):
        mixing.mixed(df, mixing.Mix(target_entropy=0.3, max_repeats=2))
    with pytest.raises(ValueError, match="as a whole"):
        mixing.mixed(df, mixing.Mix(max_repeats=2, budget_tokens=3000))
    with pytest.raises(ValueError, match="negative"):
        mixing.mixed(df, mixing.Mix(budget_tokens=-1))
    with pytest.raises(ValueError, match="can't be met"):
        mixing.mixed(shares(spark, 50, 50, 50), mixing.Mix(target_entropy=0.9))


def test_limits_are_kept_on_both_sides(spark):
    df = shares(spark, 600, 300, 100)
    weights = lambda mix: {r["source"]: r["mix_weight"] for r in mixing.mixed(df, mix).select("source", "mix_weight").collect()}
    assert abs(entropy(weights(mixing.Mix(target_entropy=0.05)).values()) - 0.05 * math.log(3)) < 1e-6
    w = weights(mixing.Mix(target_entropy=0.99, max_repeats=1.5))  # the limit leaves it less even
    assert abs((w["s2"] / 0.1) / (w["s0"] / 0.6) - 1.5) < 1e-6
    w = weights(mixing.Mix(target_entropy=0.6, max_repeats=3, budget_tokens=2000))
    assert max(w["s0"] / 0.6, w["s1"] / 0.3, w["s2"] / 0.1) * 2 <= 3 + 1e-6 and entropy(w.values()) <= 0.6 * math.log(3) + 1e-6
    w = weights(mixing.Mix(target_entropy=0.3, max_repeats=2, only_flatten=True))
    assert abs(w["s0"] - 0.6) < 1e-9
    assert mixing.mixed(shares(spark, 50, 50, 50), mixing.Mix(target_entropy=0.9, only_flatten=True)).count() == 3
    assert {len(r["mix_at"]) for r in mixing.mixed(df, mixing.Mix(budget_tokens=0)).collect()} == {0}


def test_counts_of_a_column(spark):
    df = shares(spark, 1, 1).withColumn("c", F.when(F.col("doc_id") == 0, 30).otherwise(10))
    got = {r["source"]: r["mix_weight"] for r in mixing.mixed(df, mixing.Mix(), tokens=F.col("c")).collect()}
    assert got == {"s0": 0.75, "s1": 0.25}


@pytest.mark.parametrize("mix", [mixing.Mix(target_entropy=0.97, max_repeats=4.0, only_flatten=True), mixing.Mix(max_repeats=1.5), mixing.Mix(target_entropy=0.9, budget_tokens=70_000, seed=3)])
def test_draw_of_the_whole_table_against_brute_force(spark, mix):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    key = F.struct("source", "doc_id")
    turns = [mixing.place(mix.seed, t, key).alias(f"t{t}") for t in range(8)]
    rows = df.select("doc_id", "source", "text", mixing.place(mix.seed, -1, key).alias("u"), *turns).collect()
    got = {r["doc_id"]: r for r in mixing.mixed(df, mix).collect()}
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append((r["u"], len(r["text"].split()), r))
    total = sum(n for some in by.values() for _, n, _ in some)
    weight = {s: got[some[0][2]["doc_id"]]["mix_weight"] for s, some in by.items()}
    tokens = {s: sum(n for _, n, _ in some) for s, some in by.items()}
    budget = mix.budget_tokens or max(tokens[s] / weight[s] for s in by) * (1 + 1e-12)
    assert total <= budget or mix.budget_tokens
    for s, some in by.items():
        passes, rest = divmod(budget * weight[s], tokens[s])
        run, inside = 0, set()
        for u, n, r in sorted(some, key=lambda x: x[0]):
            run += n
            if run > rest:
                # the block of the permutation that the budget ends in, at whose start the cut lies if none of it fits
                blocks = math.ceil(math.sqrt(len(some)))
                start = int(u * blocks) / blocks
                break
            inside.add(r["doc_id"])
        drawn = passes * tokens[s] + rest
        cut = max([u for u, _, r in some if r["doc_id"] in inside] + [start])
        for u, _, r in some:
            want = [(e + r[f"t{e}"]) * tokens[s] / drawn for e in range(int(passes))]
            if r["doc_id"] in inside:
                want.append((passes * tokens[s] + u / max(cut, 1e-12) * rest) / drawn)
            assert got[r["doc_id"]]["mix_at"] == pytest.approx(want, abs=1e-9)
