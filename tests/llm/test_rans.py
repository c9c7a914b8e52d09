import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from quillmark.llm import rans
from quillmark.llm.common import scratch

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 6000), st.integers(1, 60_000), st.integers(0, 99))
def test_blocks_round_trip(n, kinds, seed):
    rng = np.random.default_rng(seed)
    ids = np.minimum(rng.geometric(0.01, n), kinds) - 1
    counts = np.bincount(ids, minlength=1)
    if not n:
        counts = np.ones(1, np.int64)
    table = rans.Table(rans.scaled(counts))
    assert table.freq.sum() == 1 << rans.SCALE
    data = rans.encode_block(ids, table, lanes=16, every=8)
    assert rans.decode_block(data, table, every=8).tolist() == ids.tolist()
    # parts between checkpoints, decoded apart
    marks = rans.HEAD.unpack_from(data)[6]
    apart = [rans.decode_block(data, table, 8, k, k + 1) for k in range(marks)]
    assert np.concatenate(apart or [[]]).tolist() == ids.tolist()


def test_damage_is_noticed():
    ids = np.arange(500) % 7
    table = rans.Table(rans.scaled(np.bincount(ids)))
    data = bytearray(rans.encode_block(ids, table))
    data[-3] ^= 1
    with pytest.raises(ValueError):
        rans.decode_block(bytes(data), table)


def expected(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    out, start = {}, 0
    for i, text in sorted(rows):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def got(spark, df):
    at = scratch(spark)
    rans.write(df, PATH, at)
    rows = rans.digests(spark, at).collect()
    return {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows}, at


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    found, at = got(spark, df)
    assert found == expected(rows)
    back = rans.read(spark, at).where("doc_id = 5").first()
    assert zlib.crc32(np.array(back["ids"], "<u4").tobytes()) == found[5][2]


def test_odd_rows(spark):
    rows = [(3, None), (1, ""), (2, "don't <|endoftext|>  x\n"), (9, "é中 " * 30_000), (7, "a")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, ids string, file int")
    assert got(spark, df)[0] == expected(rows)
    assert got(spark, df.where("false"))[0] == {}
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    at = scratch(spark)
    rans.write(twice, PATH, at)
    assert sorted(r["start"] for r in rans.digests(spark, at).collect()) == [0, 2, 5]


def test_added_tokens_as_the_library_has_them(spark, monkeypatch):
    from quillmark.llm import queries
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|><|endoftext|>don't"), (3, "x <|endoftext|"), (4, "\n \n<|endoftext|>  y "), (5, None)]
    want, start = {}, 0
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(queries, "table", lambda *_: df)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.op6_rans(spark, "").collect()} == want


def test_parts_are_decoded_and_checked_apart():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 300, 50_000).astype(np.uint32)
    table = rans.Table(rans.scaled(np.bincount(ids, minlength=300)))
    payload = rans.encode_block(ids, table, lanes=64, every=16)
    for a, z in ((0, 50_000), (1024, 2048), (7, 9), (1023, 1025), (49_990, 50_000), (5, 5)):
        assert rans.part_of(payload, table, a, z, 16).tolist() == ids[a:z].tolist()
    broken = bytearray(payload)
    broken[-3] ^= 1  # in the words of the last part
    assert rans.part_of(bytes(broken), table, 0, 1024, 16).tolist() == ids[:1024].tolist()
    with pytest.raises(ValueError, match="damaged"):
        rans.part_of(bytes(broken), table, 49_990, 50_000, 16)


def test_chosen_documents_alone(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"text {k} " * (k % 50)) for k in range(400)], "doc_id long, text string")
    rans.write(docs, PATH, str(tmp_path / "b"))
    every = {r["doc_id"]: tuple(r) for r in rans.read(spark, str(tmp_path / "b")).collect()}
    some = rans.read(spark, str(tmp_path / "b"), F.col("doc_id").isin(0, 17, 399)).collect()
    assert {r["doc_id"]: tuple(r) for r in some} == {k: every[k] for k in (0, 17, 399)}
    assert rans.read(spark, str(tmp_path / "b"), F.col("doc_id") > 400).collect() == []
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "c"), (None, "d")], "doc_id long, text string")
    rans.write(twice, PATH, str(tmp_path / "t"))
    assert sorted(r["start"] for r in rans.read(spark, str(tmp_path / "t"), F.col("doc_id") == 1).collect()) == [2, 5]


def test_many_files(spark, monkeypatch):
    monkeypatch.setattr(rans, "RANGE", 4 * 100)
    rows = [(k * 7 % 400 - 50, f"text {k} " * (k % 30)) for k in range(400)] + [(900, "long " * 3000)]
    found, at = got(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert found == expected(rows)
    assert spark.read.parquet(f"{at}/blocks").select("file").distinct().count() > 64
