"""Readers and sinks on files."""

from pyspark.sql import functions as F

from quillmark.operators import edits as E
from quillmark.sources import documents as D
from quillmark.sources import records as RS


def test_scan_reads_one_row_for_each_file(spark, tmp_path):
    for name, n in (("a pg315-450.html", 2), ("b.html", 1)):
        (tmp_path / name).write_text("".join(f'<div class="page"><p>{k}</p>\n<p> 1  x &amp; y</p></div>' for k in range(n)))
    docs = D.scan(spark, str(tmp_path))
    assert {r["doc_id"]: r["p"] for r in docs.select("doc_id", D.first_page_of(F.col("file_name")).alias("p")).collect()} == {"a pg315-450": 315, "b": 1}
    lines = D.paged_lines(docs).where("doc_id like 'a%'").orderBy("global_p_idx").collect()
    assert [(r["page_idx"], r["p_idx"], r["global_p_idx"], r["line_num"], r["text"]) for r in lines] == [(0, 0, 0, None, "0"), (0, 1, 1, 1, "x & y"), (1, 0, 2, None, "1"), (1, 1, 3, 1, "x & y")]
    assert D.page_slice(D.paged_lines(docs), 1, 1).count() == 2


def test_csv_keeps_nulls_empty_texts_quotes_and_newlines(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, 'a "b"\nc, d'), (4, "é")]
    df = spark.createDataFrame(rows, "k int, t string")
    RS.write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, RS.read_csv(spark, str(tmp_path / "c"), df.schema).collect()), key=lambda r: r[0]) == rows


def test_nested_json_and_text(spark, tmp_path):
    df = spark.createDataFrame([("1A", [(1, "x"), (2, None)], (3, 4)), ("1B", [], None)], "label string, survivors array<struct<rec_idx:bigint,fund:string>>, anchor_upper struct<page:int,line:int>")
    RS.write_json(df, str(tmp_path / "j"))
    back = RS.read_json(spark, str(tmp_path / "j"), df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert back.selectExpr("label", "inline(survivors)").count() == 2
    lines = spark.createDataFrame([("d", 2, "b"), ("d", 1, "a")], "doc string, n int, t string")
    RS.write_text(lines, ["doc"], ["n"], "t", str(tmp_path / "t"))
    assert "".join(p.read_text() for p in (tmp_path / "t").glob("part-*")) == "a\nb\n"


def test_choice_of_labels(spark):
    plan = spark.createDataFrame([("1A",), ("1B",), ("1C",)], "label string")
    assert [r[0] for r in E.chosen(plan, first=2).collect()] == ["1A", "1B"] and E.chosen(plan, labels=["1C"]).count() == 1 and E.chosen(plan).count() == 3
