"""Letters of places, and queries over whole tables."""

from pyspark.sql import functions as F

from quillmark import queries as own
from quillmark.functions.scalars import letters

SF = "/root/testdata/sf0.001"


def test_letters_go_on_past_three(spark):
    places = [0, 25, 26, 701, 702, 18_277, 18_278, 475_253, 475_254, 2**31, 2**63 - 1]

    def want(k):
        out = ""
        k += 1
        while k:
            k, r = divmod(k - 1, 26)
            out = chr(65 + r) + out
        return out

    got = spark.createDataFrame([(k,) for k in places], "k long").select("k", letters(F.col("k")).alias("x")).collect()
    assert {r["k"]: r["x"] for r in got} == {k: want(k) for k in places}
    row = spark.range(17_000, 20_000).select(letters(F.col("id")).alias("x")).collect()
    assert len({r["x"] for r in row}) == 3000 and all(set(r["x"]) <= set(map(chr, range(65, 91))) for r in row)


def test_whole_tables_are_read(spark):
    n = {t: spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("orders", "lineitem")}
    assert own.QUERIES["lookup_cascade_all"](spark, SF).count() == n["orders"] == own.QUERIES["lookup_summary_all"](spark, SF).first()["n"]
    assert own.QUERIES["page_labels_all"](spark, SF).count() == n["lineitem"]


def test_ranks_over_ranges_are_row_numbers(spark):
    from quillmark.operators import sequences as S

    rows = [(f"p{k % 3}" if k % 3 < 2 else None, (k * 7919) % 1009, k) for k in range(3000)]
    df = spark.createDataFrame(rows, "page string, a int, k int")
    got = {(r["page"], r["k"]): r["rank"] for r in S.ranked(df, ["page"], ["a", "k"]).collect()}
    want = {}
    for page in {r[0] for r in rows}:
        for n, (_, _, k) in enumerate(sorted((r for r in rows if r[0] == page), key=lambda r: (r[1], r[2])), 1):
            want[page, k] = n
    assert got == want
    assert S.ranked(df.where("false"), ["page"], ["a", "k"]).count() == 0
    labels = S.long_page_labels(df.where("page is not null"), ["page"], F.lit(12), ["a", "k"])
    assert sorted(labels.where("page = 'p0'").toPandas()["label"].str.len().unique()) == [3, 4, 5]


def test_invariants_count_what_is_short_and_over(spark):
    from quillmark.operators import placement as A

    own = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, a long")
    placed = spark.createDataFrame([(1, 10), (1, 10), (3, 30), (4, 5)], "k int, a long")
    labels = spark.createDataFrame([("1A",), ("1A",), ("1B",)], "label string")
    got = {r["rule"]: r["violations"] for r in A.invariants(own, labels, placed, "k", ["label"], "a").collect()}
    assert got == {"survivor placed once": 1, "every survivor placed": 1, "only survivors placed": 2, "amounts balance": 1, "labels unique": 1}
    assert {r["violations"] for r in A.invariants(own, labels.where("label = '1B'"), own, "k", ["label"], "a").collect()} == {0}
