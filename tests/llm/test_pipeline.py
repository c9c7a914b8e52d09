import hashlib
import re
from collections import Counter

import corpus_pipeline as cp
from quillmark.llm import neardup, quality
from quillmark.llm.common import scratch, staged, table
from test_neardup import brute

SF = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, docs
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        before, docs = docs, staged(stage(spark, docs, SF), f"{scratch(spark)}/{name}")
        assert docs.columns == columns and docs.schema == before.schema, name
        kept[name] = (before.collect(), docs.collect())
    # quality: what the classifier rejects goes, all else stays
    rows, out = kept["quality"]
    verdict = {r["doc_id"]: r["predicted"] for r in quality.classify(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()}
    assert {r["doc_id"] for r in out} == {i for i, v in verdict.items() if v} and len(out) < len(rows)
    # near duplicates: one of each group by brute force
    rows, out = kept["near_duplicates"]
    assert {r["doc_id"] for r in out} == {i for i, (_, _, k) in brute([(r["doc_id"], r["text"]) for r in rows]).items() if k}
    # pii: ids and other columns stay
    rows, out = kept["pii"]
    assert sorted((r["doc_id"], r["lang"], r["source"]) for r in rows) == sorted((r["doc_id"], r["lang"], r["source"]) for r in out)
    assert not any(re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", a["text"]) and a["text"] == b["text"] for a, b in zip(sorted(rows), sorted(out), strict=True))
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    # mixing: every document at least once, none more than twice
    rows, out = kept["mixing"]
    n = Counter(r["doc_id"] for r in out)
    assert set(n) == {r["doc_id"] for r in rows} and max(n.values()) <= 2
    last = cp.STAGES[-1][1](spark, docs, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in out}
    assert len(last) == len(out)
    for r in last:
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() and len(r["ids"]) == r["n_tokens"]


def test_odd_rows(spark):
    rows = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (3, "Some good words, in a row.", "en", "a", 26), (3, "Some good words, in a row.", "en", "a", 26), (None, "More words here, as well.", None, "b", 24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in cp.STAGES:
        assert stage(spark, docs.where("false"), SF).count() == 0, name
        assert stage(spark, docs, SF).count() > 0, name
    left = cp.without_near_duplicates(spark, docs, SF).collect()
    assert sorted(str(r["doc_id"]) for r in left) == ["1", "2", "3", "None"] and neardup.near_duplicates(docs).count() == 5


def test_near_duplicates_without_ids_and_with_repeated_ones(spark):
    words = [f"w{k}" for k in range(60)]
    near, other = " ".join(words), " ".join(["new", *words[1:]])
    rows = [(None, near, 0), (7, near, 1), (None, other, 2), (7, near, 3), (4, other, 4), (None, "quite another text of a few words", 5), (None, "quite another text of a few words", 6), (None, "", 7), (None, None, 8), (9, None, 9), (9, None, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_0 long")
    left = cp.without_near_duplicates(spark, docs, SF)
    assert left.columns == docs.columns
    got = sorted(r["row_0"] for r in left.collect())
    assert got[0] == 4 and len(got) == 6 and got[1] in (5, 6) and got[2:] == [7, 8, 9, 10]


def test_clashing_names_pass_through(spark):
    docs = table(spark, SF, "documents").limit(200).selectExpr("*", "'x' quality_score", "'y' mix_at", "'z' Row", "'w' mix_weight")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        r = out.first()
        assert (r["quality_score"], r["mix_at"], r["Row"], r["mix_weight"]) == ("x", "y", "z", "w"), name
    assert cp.STAGES[-1][1](spark, docs, SF).count() == 200
