"""Matching and lookups against small models in Python."""

import difflib
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quillmark import queries as Q
from quillmark.functions.scalars import PREFIX
from quillmark.operators import lookups as L
from quillmark.operators import reconcile as R


def versions(rng, n=400, keys=60):
    p = [(k, f"k{rng.randrange(keys)}", rng.randrange(3)) for k in range(n)]
    c = [(10_000 + k, f"k{rng.randrange(keys)}", rng.randrange(3)) for k in range(n)]
    return p, c


def frames(spark, p, c):
    return tuple(spark.createDataFrame(x, "rec_idx long, key string, reapprop_amount long") for x in (p, c))


def greedy(p, c):
    left, out = {}, set()
    for j, k, a in sorted(c):
        left.setdefault(k, []).append((j, a))
    for i, k, a in sorted(p):
        free = left.get(k, [])
        hit = next((x for x in free if x[1] == a), free[0] if free else None)
        if hit:
            free.remove(hit)
            out.add((i, hit[0]))
    return out


def test_greedy_against_a_walk(spark):
    p, c = versions(random.Random(1))
    got = {tuple(r) for r in R.match_greedy(*frames(spark, p, c), ["key"]).collect()}
    assert got == greedy(p, c)


def test_exact_first_pairs_as_many_and_never_misses_an_equal_amount(spark):
    p, c = versions(random.Random(2))
    got = {tuple(r) for r in R.match_exact_first(*frames(spark, p, c), ["key"]).collect()}
    assert len(got) == len(greedy(p, c)) == len({i for i, _ in got}) == len({j for _, j in got})
    key, a = {i: k for i, k, _ in p + c}, {i: x for i, _, x in p + c}
    assert all(key[i] == key[j] for i, j in got)
    equal = sum(a[i] == a[j] for i, j in got)
    best = sum(min(sum(1 for _, k, x in p if (k, x) == s), sum(1 for _, k, x in c if (k, x) == s)) for s in {(k, x) for _, k, x in p})
    assert equal == best


def test_too_many_rows_of_a_key_are_an_error(spark):
    p, c = versions(random.Random(3), 50, 1)
    with pytest.raises(PySparkException):
        R.match_greedy(*frames(spark, p, c), ["key"], most=60).collect()


def test_greedy_folds_a_key_of_any_size(spark, monkeypatch):
    rng = random.Random(8)
    p = [(k, "hot" if k % 3 else f"k{k % 7}", rng.randrange(900)) for k in range(9000)]
    c = [(10_000 + k, "hot" if k % 3 else f"k{k % 7}", rng.randrange(900)) for k in range(8500)]
    want = greedy(p, c)
    assert {tuple(r) for r in R.match_greedy(*frames(spark, p, c), ["key"]).collect()} == want
    monkeypatch.setattr(R._Spilled, "IN_MEMORY", 1000)  # places in files
    fold = R.match_greedy(*frames(spark, p, c), ["key"])
    assert {tuple(r) for r in fold.collect()} == want


def test_lines_of_a_large_key_have_numbers_of_their_own(spark, monkeypatch):
    line = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(1)
    same = line.crossJoin(spark.range(20_500)).withColumn("l_orderkey", F.lit(1).cast("bigint")).withColumn("l_linenumber", F.when(F.col("id") < 20_000, 1).otherwise(2)).drop("id")
    monkeypatch.setattr(Q, "table", lambda *_: same)
    for rows in Q.line_versions(spark, "")[:1]:
        assert rows.select("rec_idx").distinct().count() == 20_500


def test_null_keys_match_each_other(spark):
    p, c = frames(spark, [(1, None, 5)], [(2, None, 6)])
    got = R.compare_versions(p, c, ["key"]).collect()
    assert [(r["status"], r["prior_idx"], r["current_idx"]) for r in got] == [("modified", 1, 2)]


def test_texts_choose_in_order_and_below_the_threshold_stay_unmatched(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdef", k=5))
    texts = [" ".join(word() for _ in range(30)) for _ in range(12)]

    def changed(t):
        w = t.split()
        for _ in range(rng.randrange(12)):
            w[rng.randrange(30)] = word()
        return " ".join(w)

    p = [(i, "", "x", 7, t) for i, t in enumerate(texts)]
    c = [(100 + i, "", "x", 7, changed(rng.choice(texts))) for i in range(14)]
    schema = "rec_idx long, approp_id string, fund string, reapprop_amount long, bill_language string"
    used, want = set(), set()
    for i, *_, t in p:
        best = max(((difflib.SequenceMatcher(None, t[:PREFIX], u[:PREFIX]).ratio(), -j) for j, *_, u in c if j not in used), default=(0, 0))
        if best[0] >= 0.4:
            used.add(-best[1])
            want.add((i, -best[1]))
    pf, cf = spark.createDataFrame(p, schema), spark.createDataFrame(c, schema)
    told = R.compare_versions(pf, cf, ["approp_id", "fund"], id_col="approp_id", text_col="bill_language").collect()
    assert {(r["prior_idx"], r["current_idx"]) for r in told if r["match_method"] == "no_id_text"} == want
    assert sum(r["match_method"] == "no_id_unmatched" for r in told) == len(p) - len(want)


def test_near_copies_of_one_key_beyond_any_number_of_pairs(spark):
    # 330 by 330 like texts: more pairs than one array was allowed to hold; the walk is the same
    words = [f"w{k:02}" for k in range(5)]

    def rows(first, seed):
        rng = random.Random(seed)
        out = []
        for k in range(330):
            w = list(words)
            w[rng.randrange(5)] = f"n{rng.randrange(40):02}"
            out.append((first + k, "x", " ".join(w)))
        return out

    p, c = rows(0, 1), rows(1000, 2)
    used, want = set(), set()
    ratio = {(x, y): difflib.SequenceMatcher(None, x[:PREFIX], y[:PREFIX]).ratio() for x in {r[2] for r in p} for y in {r[2] for r in c}}
    assert sum(ratio[x[2], y[2]] >= 0.4 for x in p for y in c) > 100_000
    for i, _, x in p:
        _, j = min((-ratio[x, y], j) for j, _, y in c if j not in used)
        used.add(j)
        want.add((i, j))
    schema = "rec_idx long, fund string, bill_language string"
    got = R.match_by_text(spark.createDataFrame(p, schema), spark.createDataFrame(c, schema), ["fund"]).collect()
    assert {(r["prior_idx"], r["current_idx"]) for r in got} == want


def test_cascade_levels_and_a_null_first_row(spark):
    row = "doc_id string, status string, agency string, approp_id string, chapter_year int, approp_amount long, reapprop_amount long"
    rows = spark.createDataFrame([("a", "dropped", "X", "1", 2020, 5, 1), ("b", "dropped", "X", "1", 2020, 6, 1), ("c", "dropped", "X", "1", 2021, 7, 1), ("d", "dropped", "X", "1", 2022, 8, 1), ("e", "dropped", "X", "", 2020, 5, 1), ("f", "dropped", "X", None, 2020, 9, 1), ("g", "dropped", None, "1", 2020, 5, 1), ("h", "continued", "X", "1", 2020, 5, 1)], row)
    table = spark.createDataFrame(
        [(1, "X", "1", 2020, 5, 1, None), (2, "X", "1", 2020, 5, 1, 10.0), (3, "X", "1", 2020, 4, 0, 999.99), (4, "X", "1", 2019, 7, 0, 1000.0), (5, "X", "2", 2020, 9, 0, 1000.5), (6, "X", "9", 2020, 5, 1, 3.0)],
        "row_idx long, agency string, approp_id string, chapter_year int, approp_amount long, reapprop_amount long, balance double",
    )
    got = {r["doc_id"]: (r["balance"], r["method"], r["rounded"], r["insert_eligible"]) for r in L.attach_balance(rows, table).collect()}
    # the first row of a key decides even if its balance is null; the next pass has the same first row
    assert got["a"] == (None, "", 0, False) and got["b"] == (None, "", 0, False)
    assert got["c"] == (1000.0, "agency+id+amt", 1000, True) and got["d"] == (None, "", 0, False)
    assert got["e"] == (None, "", 0, False) and got["f"] == (1000.5, "agency+noid+chyr+amt", 2000, True)
    assert got["g"] == (None, "", 0, False) and "h" not in got


def test_small_agencies_get_codes_that_are_left(spark):
    codes = spark.createDataFrame([("1", k, 2_000_000 + k) for k in range(3)] + [("1", 50 + k, 10 + k) for k in range(5)] + [("2", 60, 99)], "code string, id int, amount long")
    known = spark.createDataFrame([("BIG", k, 2_000_000 + k) for k in range(3)] + [("SMALL", 50 + k, 10 + k) for k in range(5)] + [("TINY", 60, 99), ("", 60, 99)], "agency string, id int, amount long")
    assert {tuple(r) for r in L.learned_mapping(codes, known, ["id", "amount"], "code", "agency", "amount").collect()} == {("1", "BIG"), ("2", "TINY")}


def test_as_of_joins_look_strictly_before_or_after(spark):
    from quillmark.operators import sequences as S

    rows = spark.createDataFrame([("a", 1), ("a", 5), ("a", 5), ("a", 9), ("b", 3), (None, 4), ("a", None)], "g string, t int")
    blocks = spark.createDataFrame([("a", 5, "x"), ("a", 5, "w"), ("a", 7, "y"), ("b", 3, "z"), (None, 1, "n")], "g string, t int, v string")
    got = {(r["g"], r["t"], r["found"] and (r["found"]["t"], r["found"]["v"])) for r in S.as_of(rows, blocks, ["g"], ["t"], ["v"]).collect()}
    assert got == {("a", 1, None), ("a", 5, None), ("a", 9, (7, "y")), ("b", 3, None), (None, 4, None), ("a", None, None)}
    got = {(r["g"], r["t"], r["found"] and (r["found"]["t"], r["found"]["v"])) for r in S.as_of(rows, blocks, ["g"], ["t"], ["v"], later=True).collect()}
    assert got == {("a", 1, (5, "w")), ("a", 5, (7, "y")), ("a", 9, None), ("b", 3, None), (None, 4, None), ("a", None, (5, "w"))}
    assert S.as_of(rows, blocks, ["g"], ["t"], ["v"]).count() == 7


def test_greedy_on_one_hot_key_is_the_plain_walk(spark):
    import random

    from quillmark.operators import reconcile as R

    for seed in range(6):
        rng = random.Random(seed)
        kinds = (3, 40, 4000)[seed % 3]
        p = [("k" if i % 3 else "l", i, rng.randrange(kinds) if rng.random() < 0.98 else None) for i in range(400)]
        c = [("k" if i % 3 else "m", i, rng.randrange(kinds) if rng.random() < 0.98 else None) for i in range(1000, 1350)]
        want = set()
        for key in "klm":
            free = [(i, a) for k, i, a in c if k == key]
            for k, i, a in p:
                if k == key and free:
                    hit = next((x for x in free if x[1] == a), free[0])
                    free.remove(hit)
                    want.add((i, hit[0]))
        df = lambda rows: spark.createDataFrame(rows, "k string, rec_idx long, reapprop_amount long")
        assert {tuple(r) for r in R.match_greedy(df(p), df(c), ["k"]).collect()} == want


def test_header_groups_close_stop_and_cross_pages(spark):
    from pyspark.sql import functions as F

    from quillmark.operators import edits as E

    rows = ["H one", "two", "S three", "H four:", "five", "H six", "seven", "", "eight", "nine"]
    lines = spark.createDataFrame([("d", k // 4, k % 4, k % 4 + 1 if x else None, x, not x) for k, x in enumerate(rows)], "doc string, page_idx int, p_idx int, line_num int, text string, is_blank boolean")
    places = E.numbered_places(lines, ["doc"])
    groups = E.header_groups(places, F.col("text").startswith("H"), ["doc"], 3, closes=F.col("text").endswith(":"), stops=F.col("text").startswith("S"))
    assert sorted((r["header"], r["place"]) for r in groups.collect()) == [(1, 1), (1, 2), (4, 4), (6, 6), (6, 7), (6, 8)]
    starts = spark.createDataFrame([("d", 2), ("d", 5), ("d", 7), ("d", 9), ("d", 1)], "doc string, place long")
    got = sorted((r["start"], r["page_idx"], r["line_num"]) for r in E.headers_of(places, groups, starts, ["doc"]).collect())
    assert got == [(2, 0, 1), (5, 0, 4), (7, 1, 2), (9, 1, 2), (9, 1, 3), (9, 2, 1)]


def test_rows_of_one_large_key_are_compared_in_many_pieces(spark):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choices(["aid", "road", "school", "fund", "water", "grant"], k=12)) + " tail" * 40
    p, c = ([("G", k, text()) for k in range(n)] for n in (150, 140))
    schema = "fund string, rec_idx long, bill_language string"
    want, used = set(), set()
    for _, i, x in p:
        ratios = [(-difflib.SequenceMatcher(None, x[:150], y[:150]).ratio(), j) for _, j, y in c if j not in used]
        best = min(ratios, default=(0, None))
        if -best[0] >= 0.4:
            used.add(best[1])
            want.add((i, best[1]))
    left, right = spark.createDataFrame(p, schema), spark.createDataFrame(c, schema)
    assert {(r["prior_idx"], r["current_idx"]) for r in R.match_by_text(left, right, ["fund"]).collect()} == want
    a, b, tasks = R.text_pieces(left.selectExpr("fund __k", "rec_idx __i"), right.selectExpr("fund __k", "rec_idx __j"))
    sizes = [r["count"] for r in a.join(b, ["__k", "__p", "__q"]).groupBy("__p", "__q").count().collect()]
    assert sum(sizes) == 150 * 140 and max(sizes) < 2 * R.SIDE**2 and len(sizes) == 9 and tasks == 22


def exact_first(p, c):
    """(i, j) of rows (i, key, amount), equal amounts first, then what is left in order."""
    out, taken = set(), set()
    for equal in (True, False):
        for i, k, a in sorted(p, key=lambda r: r[0]):
            hit = next((j for j, l, b in sorted(c, key=lambda r: r[0]) if j not in taken and (k or "") == (l or "") and (not equal or (a is not None and a == b))), None)
            if hit is not None and i not in {x for x, _ in out}:
                taken.add(hit)
                out.add((i, hit))
    return out


def nullable(rng, first, n):
    return [(first + k, rng.choice([None, "", "a", "b", "c", "d"]), rng.choice([None, 1, 2, 3])) for k in range(n)]


def test_every_row_of_both_versions_is_told_once_with_its_own_columns(spark):
    for seed, mode in ((1, "exact_first"), (2, "exact_first"), (3, "greedy"), (4, "greedy")):
        rng = random.Random(seed)
        p, c = nullable(rng, 0, 40), nullable(rng, 20, 44)
        left, right = (df.withColumn("source", F.concat(F.lit(s), F.col("rec_idx"))) for df, s in zip(frames(spark, p, c), "pc", strict=True))
        own, other = {r[0]: r for r in p}, {r[0]: r for r in c}
        want = exact_first(p, c) if mode == "exact_first" else greedy_null(p, c)
        rows = [tuple(r) for gathered in (False, True) for r in R.compare_versions(left, right, ["key"], carried=["source"], mode=mode, gathered=gathered).collect()]
        status = lambda i, j: "continued" if own[i][2] is not None and own[i][2] == other[j][2] else "modified"
        met = {(i, j, own[i][1], f"p{i}", own[i][2], other[j][2] or 0) for i, j in want}
        lost = {(i, -1, own[i][1], f"p{i}", own[i][2], 0) for i in own.keys() - {i for i, _ in want}}
        new = {(-1, j, other[j][1], f"c{j}", 0, other[j][2] or 0) for j in other.keys() - {j for _, j in want}}
        assert {(r[1], r[2], *r[4:]) for r in rows} == met | lost | new and len(rows) == 2 * len(met | lost | new)
        assert all(r[3] == ("full_key" if r[1] >= 0 and r[2] >= 0 else "") for r in rows)
        assert all(r[0] == ("new" if r[1] < 0 else "dropped" if r[2] < 0 else status(r[1], r[2])) for r in rows if None not in (own.get(r[1], (0, 0, 0))[2], other.get(r[2], (0, 0, 0))[2]))


def greedy_null(p, c):
    """A walk in which null amounts are equal."""
    return greedy(*([(i, k or "", -1 if a is None else a) for i, k, a in rows] for rows in (p, c)))


def test_versions_that_lie_together_are_moved_once_and_meet_without_a_join(spark):
    plan = Q.reconcile_one_to_one(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") <= 2  # the table by its key, once for each version and the same


def test_only_keys_with_several_rows_left_on_both_sides_are_followed(spark, monkeypatch):
    seen, followed = [], R._followed

    def counted(p, c, kind):
        seen.append((p.count(), c.count()))
        return followed(p, c, kind)

    monkeypatch.setattr(R, "_followed", counted)
    p = [(k, f"one{k}", 1) for k in range(9)] + [(20 + k, "few", k) for k in range(4)] + [(30 + k, "many", 3 - k) for k in range(3)]
    c = [(100 + k, f"one{k}", 2) for k in range(9)] + [(120, "few", 9), (121, "few", 1)] + [(130 + k, "many", 7 + k) for k in range(3)]
    for gathered in (False, True):
        got = R.compare_versions(*frames(spark, p, c), ["key"], mode="greedy", gathered=gathered)
        assert {(r["prior_idx"], r["current_idx"]) for r in got.collect() if r["prior_idx"] >= 0 and r["current_idx"] >= 0} == greedy(p, c)
    assert seen == [(7, 5)] * 2


def test_ratios_of_whole_texts_are_those_of_difflib(monkeypatch):
    from quillmark.functions import likeness as T

    rng = random.Random(7)
    for n in range(120):
        letters = rng.choice(["a", "ab", "abcdefgh", "ab \u00e9\U0001f600"])
        text = lambda most=60: "".join(rng.choices(letters, k=rng.randrange(most)))
        a = [text(400 if n % 10 == 0 else 60) for _ in range(3)]
        b = [text(), rng.choice(a) * 2 + text(), rng.choice(a)[5:] + text()]
        monkeypatch.setattr(T, "SORTED", 80 if n % 3 == 0 else 400_000)
        monkeypatch.setattr(T, "BATCH", 70 if n % 3 == 0 else 400_000)
        for least in (0.0, 0.4, 0.8):
            want = {(i, j): r for i, x in enumerate(a) for j, y in enumerate(b) if (r := difflib.SequenceMatcher(None, x, y, autojunk=False).ratio()) >= least}
            assert {(i, j): r for parts in T.ratios(a, b, least) for i, j, r in zip(*(p.tolist() for p in parts), strict=True)} == want


def test_documents_are_compared_by_their_whole_texts(spark, tmp_path):
    from quillmark.queries import QUERIES

    # alike for 150 code points, told apart by what stands behind them only
    rng = random.Random(11)
    tails = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(60)) for _ in range(4)]
    head = "The " + "same " * 40
    rows = [(2 * k, "en", head + t) for k, t in enumerate(tails)] + [(2 * (3 - k) + 1, "en", head + t[:-1] + "!") for k, t in enumerate(tails)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r["prior_idx"], r["current_idx"]) for r in QUERIES["reconcile_text"](spark, str(tmp_path)).collect()}
    assert got == {(0, 7), (2, 5), (4, 3), (6, 1)}
