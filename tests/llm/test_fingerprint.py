import hashlib
import random

import numpy as np

from quillmark.llm import fingerprint as fp

SF = "/root/testdata/sf0.01"


def rows_of(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return fp.compared(df).collect()


def brute(rows):
    rows = sorted((i, t or "") for i, t in rows)
    out = {}
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        e = t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]
        a, b, c = map(fp.sketch, (t, e, nxt))
        out[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), fp.text_of(a), fp.text_of(b), fp.likeness(a, b), fp.likeness(a, c))
    return out


def test_whole_table_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in fp.compared(df).collect()}
    want = brute([(r["doc_id"], r["text"]) for r in df.collect()])
    assert got == want
    near = [v[4] for v in want.values() if v[0] > 400]
    far = [v[5] for v in want.values() if v[0] > 400]
    assert 0.6 < np.median(near) < 0.9 and np.median(far) < 0.1


def test_odd_rows(spark):
    rows = [(5, None), (2, ""), (9, "short"), (7, "long text " * 30_000), (-3, "é中" * 40)]
    assert {r["doc_id"]: tuple(r)[1:] for r in rows_of(spark, rows)} == brute(rows)
    one = rows_of(spark, [(1, "a b c d")])
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert len(rows_of(spark, [(1, "a"), (1, "a"), (None, "b"), (None, None)])) == 4
    clash = spark.createDataFrame([(1, "a", 3, True)], "doc_id long, text string, part int, guest boolean")
    assert fp.compared(clash).count() == 1 and fp.compared(clash.where("false")).count() == 0


def test_sketches_merge_and_estimate_containment():
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(20_000))
    part = text[40_000:60_000]
    a, b = fp.sketch(part), fp.sketch(text)
    assert fp.containment(a, b) > 0.97 and abs(fp.containment(b, a) - len(part) / len(text)) < 0.03
    halves = fp.merge(fp.sketch(text[:70_000]), fp.sketch(text[70_000 - fp.WIDTH + 1 :]))
    assert np.array_equal(halves[halves < (1 << 32) // fp.FRACTION], b[b < (1 << 32) // fp.FRACTION])
    assert np.array_equal(fp.from_text(fp.text_of(a)), a)


def test_many_small_ranges_with_nulls_ties_and_one_large_text(spark, monkeypatch):
    from quillmark.llm import common

    rows = [(k * 7 % 900 - 100, f"text {k} " * (k % 40)) for k in range(900)] + [(4, "d" * 40_000), (None, "e" * 99), (None, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sized = df.selectExpr("doc_id id", "octet_length(text) w")
    ranges = common.id_ranges(sized, 1000)
    assert len(ranges) > 64 and ranges.nulls
    placed = sized.withColumn("part", ranges.of("id")).collect()
    order = sorted(placed, key=lambda r: (r["id"] is not None, r["id"] or 0))
    assert [r["part"] for r in order] == sorted(r["part"] for r in order)  # ranges are in the order of ids
    for k in range(len(ranges)):
        mine = [r["w"] for r in placed if r["part"] == k]
        assert mine and ranges.before[k] == sum(r["w"] for r in placed if r["part"] < k)
        assert sum(mine) <= 1000 + 40_300  # one id more than the size at most
    monkeypatch.setattr(common, "MOST_RANGES", 3)
    assert len(common.id_ranges(sized, 1000)) <= 3 + common.parts(spark) + 1
    monkeypatch.undo()
    monkeypatch.setattr(fp, "id_ranges", lambda x: common.id_ranges(x, 1000))
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, *tuple(r)[1:]) for r in fp.compared(df).collect())
    ordered = sorted((i is not None, i or 0, t) for i, t in rows)
    want = []
    for k, (known, i, t) in enumerate(ordered):
        nxt = ordered[(k + 1) % len(ordered)][2]
        e = fp.edited(t, nxt)
        a, b, c = map(fp.sketch, (t, e, nxt))
        want.append((known, i, len(t), hashlib.sha256(e.encode()).hexdigest(), fp.text_of(a), fp.text_of(b), fp.likeness(a, b), fp.likeness(a, c)))
    assert got == sorted(want)
