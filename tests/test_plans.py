"""Placement, edit scripts and audits on small fixtures."""

from pyspark.sql import functions as F

from quillmark.operators import audit as Q
from quillmark.operators import edits as E
from quillmark.operators import placement as A
from quillmark.operators import sequences as S
from quillmark.plans import placing as PL
from quillmark.queries import bill_plan

REC = "rec_idx long, doc_id string, agency string, program string, fund string, chapter_year int, amending_year int, approp_id string, approp_amount long, reapprop_amount long, first_page int, first_line int, last_page int, last_line int, chyr_page int, fund_page int, source string"


def rec(i, program, fund, year, page, line, amount=5000, approp=None):
    return (i, "d", "X", program, fund, year, 0, approp or str(i % 1000), amount, amount, page, line, page, line + 1, page, page, "reapprop")


def test_each_rule_once(spark):
    prior = [rec(1, "P1", "F1", 2021, 1, 1), rec(2, "P1", "F1", 2021, 1, 3), rec(3, "P1", "F1", 2020, 1, 5), rec(4, "P1", "F2", 2020, 1, 7), rec(5, "P1", "F3", 2019, 1, 9), rec(6, "P1", "F4", 2024, 1, 11), rec(7, "P1", "F5", 2020, 1, 13), rec(8, "P2", "F1", 2020, 1, 15), rec(9, "P3", "F1", 2020, 1, 17), rec(10, "P4", "F9", 2020, 1, 19)]
    current = [rec(1001, "P1", "F1", 2021, 5, 2), rec(1002, "P1", "F2", 2020, 6, 4, approp="77"), rec(1003, "P1", "F3", 2021, 7, 6, approp="78"), rec(1004, "P1", "F4", 2020, 8, 8, approp="79"), rec(1005, "P3", "F7", 2020, 9, 10, approp="80")]
    p, c = spark.createDataFrame(prior, REC), spark.createDataFrame(current, REC)
    matches = spark.createDataFrame([(1, 1001)], "prior_idx long, current_idx long")
    ordered = PL.in_document_order(p, ["doc_id"])
    got = {r["rec_idx"]: tuple(r["anchor"]) for r in A.anchors(ordered.where("rec_idx > 1"), ordered, c, matches, ["doc_id"], PL.FUND, PL.BLOCK).collect()}
    assert got[2] == got[3] == ("continued_same_fund", 5, 3)
    assert got[4] == ("chyr_header", 6, 3)
    assert got[5] == ("after_newer_chyr", 7, 7)
    assert got[6] == ("fund_header", 8, 7)
    assert got[7] == ("program_header", 5, 1)
    assert got[8] == ("before_next_program", 9, 9)
    assert got[9] == ("program_header", 9, 9)
    assert got[10] == ("doc_start", 0, 0)


def test_next_fund_that_exists_and_its_header(spark):
    prior = [rec(1, "P1", "F1", 2020, 1, 1), rec(2, "P1", "F2", 2020, 1, 3), rec(3, "P1", "F3", 2020, 1, 5)]
    p, c = spark.createDataFrame(prior, REC), spark.createDataFrame([rec(1003, "P1", "F3", 2020, 4, 9)], REC)
    none = spark.createDataFrame([], "prior_idx long, current_idx long")
    ordered = PL.in_document_order(p, ["doc_id"])
    args = (ordered.where("rec_idx = 1"), ordered, c, none, ["doc_id"], PL.FUND, PL.BLOCK)
    assert tuple(A.anchors(*args).first()["anchor"]) == ("before_next_fund", 4, 8)
    heads = spark.createDataFrame([("d", "P1", "F3", 4, 6)], "doc_id string, program string, fund string, page int, line int")
    assert tuple(A.anchors(*args, fund_headers=heads).first()["anchor"]) == ("before_next_fund", 4, 5)


def test_more_than_26_labels_on_a_page(spark):
    df = spark.range(30).select(F.lit("d").alias("doc_id"), F.col("id"))
    got = [r["label"] for r in S.page_labels(df, ["doc_id"], F.lit(272), ["id"]).orderBy("id").collect()]
    assert got[0] == "272A" and got[25] == "272Z" and got[26:] == ["272AA", "272AB", "272AC", "272AD"]


def test_rendered_bills_make_whole_plans(spark):
    plan = bill_plan(spark, "/root/testdata/sf0.001").cache()
    rows = plan.collect()
    assert len({r["rec_idx"] for r in rows}) == len(rows) > 100
    keys = {}
    for r in rows:  # one block for each label
        keys.setdefault((r["doc_id"], r["label"]), set()).add((r["program"], r["fund"], r["chapter_year"]))
    assert all(len(k) == 1 for k in keys.values())
    nested = PL.nested(plan, ["doc_id"])
    assert nested.count() == len(keys)
    assert sum(b["total"] for b in Q.brief(nested).collect()) == sum(r["rounded"] for r in rows)
    kinds = {r["anchor"]["kind"] for r in rows}
    assert {"continued_same_fund", "chyr_header"} <= kinds <= set(A.RULES)
    bad = A.invariants(plan, plan.select("doc_id", "label").distinct(), plan, "rec_idx", ["doc_id", "label"], "rounded")
    assert {r["violations"] for r in bad.collect()} == {0}
    plan.unpersist()


def lines(spark, rows):
    """(page, p_idx, number, raw)"""
    out = [("d", p, i, n, raw, raw.split("  ", 1)[-1], not raw.strip()) for p, i, n, raw in rows]
    return spark.createDataFrame(out, "doc_id string, page_idx int, p_idx int, line_num int, raw_text string, text string, is_blank boolean").withColumn("global_p_idx", F.col("page_idx") * 100 + F.col("p_idx"))


ROWS = [(0, 0, None, "HEAD"), (0, 1, 1, " 1  General Fund"), (0, 2, None, " "), (0, 3, 2, " 2  For a (11111) ... (re. $500)"), (0, 4, 3, " 3  For b (22222) ... (re. $500)"), (1, 0, None, "HEAD"), (1, 1, 1, " 1  middle"), (2, 0, 1, " 1  end ... (re. 700)"), (2, 1, 2, " 2  new thing ..... 900")]
SURV = "doc_id string, first_page int, first_line int, last_page int, last_line int, source string, old_amount long, new_amount long"


def test_script_keeps_strikes_replaces_and_appends(spark):
    ranges = spark.createDataFrame([("d", 0, 3, 2, 1, "reapprop", 700, 2000), ("d", 2, 2, 2, 2, "appropriation", 900, 1000)], SURV)
    got = {(r["page_idx"], r["p_idx"]): (r["op"], r["new"]) for r in E.edit_script(lines(spark, ROWS), ranges, ["doc_id"]).collect()}
    assert got[0, 0] == ("strike", None) and got[0, 2][0] == "blank" and got[0, 3][0] == "strike" and got[0, 4] == ("keep", ROWS[4][3])
    assert got[1, 0][0] == "strike" and got[1, 1][0] == "keep" and got[2, 0] == ("replace", " 1  end ... (re. $2,000)") and got[2, 1] == ("append", " 2  new thing ..... 900 ... (re. $1,000)")


def test_equal_amounts_on_a_page_change_on_their_own_line(spark):
    ranges = spark.createDataFrame([("d", 0, 3, 0, 3, "reapprop", 500, 1000)], SURV)
    got = {r["p_idx"]: r["op"] for r in E.edit_script(lines(spark, ROWS), ranges, ["doc_id"]).where("page_idx = 0").collect()}
    assert got == {0: "strike", 1: "strike", 2: "blank", 3: "strike", 4: "replace"}


def test_label_goes_behind_the_last_visible_line(spark):
    ranges = spark.createDataFrame([("d", 0, 2, 0, 2, "reapprop", 1, 1)], SURV)
    labels = spark.createDataFrame([("d", "7A")], "doc_id string, label string")
    script = E.edit_script(lines(spark, ROWS), ranges, ["doc_id"])
    assert [tuple(r) for r in E.labels_before_kept(script, labels, ["doc_id"]).collect()] == [("d", 0, 1, "7A")]
    first = E.edit_script(lines(spark, ROWS[1:]), spark.createDataFrame([("d", 0, 1, 0, 1, "reapprop", 1, 1)], SURV), ["doc_id"])
    assert E.labels_before_kept(first, labels, ["doc_id"]).count() == 0
    new = E.with_inserts(lines(spark, ROWS), spark.createDataFrame([("d", 0, 1, "36B"), ("d", 0, 1, "36AA")], "doc_id string, page_idx int, p_idx int, label string"), ["doc_id"], F.col("raw_text"))
    assert [r["label"] for r in new.where("page_idx = 0 and p_idx = 1").orderBy("label").collect()] == ["", "36AA", "36B"]


def tags(spark, rows, **needs):
    df = spark.createDataFrame([("d", i, k, t, t.split("  ", 1)[-1]) for i, (k, t) in enumerate(rows)], "doc_id string, n int, kind string, raw_text string, text string")
    want = spark.createDataFrame([("d", needs.get("chapter", False), needs.get("fund", False))], "doc_id string, needs_chapter_header boolean, needs_fund_header boolean")
    return Q.flags(df, ["doc_id"], ["n"], want).first()["tags"]


def test_each_tag(spark):
    ok = [("struck", " 1  x"), ("keep", " 2  For a (11111)"), ("keep", " 3  b (re. $1)"), ("struck", " 4  y")]
    assert tags(spark, ok) == []
    assert tags(spark, [*ok, ("keep", " 5  Total of Sub-schedule ... 3")]) == ["subschedule-in-kept"]
    assert tags(spark, [*ok, ("keep", " 5  ------")]) == ["separator-in-kept"]
    assert tags(spark, [*ok, ("keep", " 5  intro"), ("edit", " 6  c (re. $2)")]) == ["struck-between-kept"]
    assert tags(spark, [("keep", " 1  By chapter 1, of the laws of 2020:"), *ok]) == []
    assert tags(spark, [("struck", " 1  x")]) == ["empty-insert"] and tags(spark, ok[1:3]) == ["no-strikes"]
    assert tags(spark, ok, chapter=True, fund=True) == ["missing-chyr-header", "missing-fund-header"]
    assert tags(spark, [("keep", " 1  General Fund"), ("keep", " 2  By chapter 1, section 2, of the laws of 2020:"), *ok], chapter=True, fund=True) == []


def test_a_plan_leaves_no_stage_but_its_own(spark):
    import os

    at = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(at))
    plan = bill_plan(spark, "/root/testdata/sf0.001")
    left = set(os.listdir(at)) - before
    assert len(left) == 1 and plan.inputFiles() and all(next(iter(left)) in f for f in plan.inputFiles())
    assert plan.where("label is not null").count() > 100


def test_what_is_shuffled_for_a_stage_is_freed_and_passing_stages_go(spark):
    import os

    from quillmark.sources.stages import passing, staged

    at = spark.conf.get("spark.checkpoint.dir")
    before, was = set(os.listdir(at)), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    with passing(spark) as outer:
        with passing(spark) as keep:
            one = staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
            two = keep(one.groupBy().sum("count"))
        assert len(set(os.listdir(at)) - before) == 1
        three = outer(two)
    assert len(set(os.listdir(at)) - before) == 1 and three.first()[0] == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == was
