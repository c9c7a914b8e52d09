"""Malformed pages and files of any size."""

import html
import random

import pytest
from pyspark.sql import functions as F

from quillmark.functions import scalars as X
from quillmark.functions import patterns as P
from quillmark.sources import documents as D

REFERENCES = [
    "&amp;", "&lt", "&nbsp;x", "&#8212;", "&#x2014;", "&eacute;", "&eacute", "&notit;", "&notin;", "&unknown;", "&#0;", "&#128;", "&#x110000;", "&#99999999999;", "&#0000000000065;", "a & b &c", "&ampfoo", "&copy2024",
    "&#xD800;", "&", "&#", "&;", "&NotEqualTilde;", "x&#65y", "&#X41;z", "&zzzzamp;", "", "&amp;amp;", "&#38;lt;",
]
MALFORMED = """pre<p>no</p></div><DIV id=a class='x page y'><p>1 First<p>2 Second &#8212;<p>3 Third &eacute; <b title="a>b">bold</b> a < b</div>
<script>"<div class=page><p>no</p>"</script><!-- <div class="page"><p>no</p> --><div class=page data-x=">"><div><p>in</div><p style='x'>after</p> text <section>y</section><p>z</div></div></div>
<div class="pages"><p>not</p></div><div class="page"><p>o1<div class="page"><p>i1</p><p>i2</div><p>o2</div><div class="page"><table><tr><td><p>t1<td><p>t2</table><p/>last"""
WANTED = [
    (0, 0, "1 First"), (0, 1, "2 Second —"), (0, 2, "3 Third é bold a < b"), (1, 0, "in"), (1, 1, "after"), (1, 2, "z"), (2, 0, "o1"), (2, 1, "i1"), (2, 2, "i2"), (2, 3, "o2"),
    (3, 0, "i1"), (3, 1, "i2"), (4, 0, "t1"), (4, 1, "t2"), (4, 2, "last"),
]


def lines(df):
    return sorted((r["doc_id"] or "", r["page_idx"], r["p_idx"], r["global_p_idx"], r["raw_text"]) for r in df.collect())


def test_references_are_those_of_html(spark):
    df = spark.createDataFrame([(x,) for x in REFERENCES], "t string")
    assert [r["u"] for r in df.select(X.unescaped(F.col("t")).alias("u")).collect()] == [html.unescape(x) for x in REFERENCES]
    assert spark.range(1).select(X.unescaped(F.lit(None).cast("string"))).first()[0] is None


def test_malformed_markup(spark):
    rows = [("a", MALFORMED), ("b", None), ("c", ""), (None, '<div class="page"><p>n'), ("d", "<div class=page>"), ("e", "<!-- <div class=page><p>x")]
    got = lines(D.paged_lines(spark.createDataFrame(rows, "doc_id string, html string")))
    assert got == [("", 0, 0, 0, "n"), *(("a", p, i, n, t) for n, (p, i, t) in enumerate(WANTED))]


def test_plain_pages_and_clashing_names(spark):
    df = spark.createDataFrame([(7, '<div class="page"><p>1</p><p> 12  x &amp; y </p></div>')], "doc_id long, html string").withColumn("piece", F.lit(1)).withColumn("N", F.lit(2)).withColumn("page_idx", F.lit(9))
    got = D.paged_lines(df).orderBy("p_idx").collect()
    assert [(r["doc_id"], r["page_idx"], r["p_idx"], r["line_num"], r["text"], r["is_blank"]) for r in got] == [(7, 0, 0, None, "1", False), (7, 0, 1, 12, "x & y", False)]
    assert D.paged_lines(df.where("false")).count() == 0


@pytest.mark.parametrize("lasting", [False, True])
def test_files_in_parts_have_the_lines_of_whole_files(spark, tmp_path, lasting):
    rng = random.Random(3)
    for k in range(3):
        text = ["\n<!doctype html><body class='page'>" if k else ""]
        for i in range(400):
            text.append(MALFORMED if i % 41 == k else f'<div class="page"><p>{i}</p><p> 1 l &amp; {rng.random()}</p><div><p> 2 é</div></div>')
            if lasting and k < 2 and i % 60 == 7:
                text.append("<script>var a='<div class=\"page\"><p>no</p><div>';</SCRIPT ><!-- <div class='page'> <script> <div> --><p>x<style><div> <!-- </style>")
        (tmp_path / f"f {k}.html").write_text("".join(text) + ("<!-- <div class=page><p>never <div>" if lasting else ""))
    want = lines(D.paged_lines(D.scan(spark, str(tmp_path))))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")
        assert D.file_pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 8
        assert lines(D.file_lines(spark, str(tmp_path))) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_no_piece_holds_more_than_a_div(spark, tmp_path):
    for n in (50, 500):
        (tmp_path / f"{n}").mkdir()
        (tmp_path / f"{n}" / "f.html").write_text("".join(f'<div class="page"><p>{i}</p></div>' for i in range(n)))
    longest = [D.file_pieces(spark, str(tmp_path / f"{n}")).agg(F.max(F.length("piece"))).first()[0] for n in (50, 500)]
    assert max(longest) < 40


def test_pages_are_made_once(spark):
    """Places and lines both read a document's pieces; what makes its html runs once for each document."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def html(n):
        made.add(1)
        return f'<div class="page"><p>{n}</p><div class="page"><p>x</p></div></div>'

    docs = spark.range(3).select(F.col("id").alias("doc_id"), html.asNondeterministic()("id").alias("html"))
    assert D.paged_lines(docs).count() == 9
    assert made.value == 3


def test_blank_and_trailing_space(spark):
    rows = spark.createDataFrame([(" 1  text \u00a0",), ("\u00a0 \t",), ("",), (" 2  a\u2003b",), ("no number \u2003",)], "raw string")
    got = rows.select(P.is_blank(F.col("raw")).alias("b"), P.line_body(F.col("raw")).alias("t")).collect()
    assert [(r["b"], r["t"]) for r in got] == [(False, "text"), (True, ""), (True, ""), (False, "a\u2003b"), (False, "no number")]


def test_a_reference_is_looked_up_once_for_each_text(spark):
    texts = ["&#x65;&#101; &period;&amp &amp;&unknown; &notit; &#0;&#x80;" * 40, "no reference", "& alone &", "", "&lt;" * 3 + "&LT" * 2, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.unescaped(F.col("t")).alias("u"))
    assert all(r["u"] == (None if r["t"] is None else html.unescape(r["t"])) for r in df.collect())
    assert "array_distinct" in df._jdf.queryExecution().optimizedPlan().toString()
