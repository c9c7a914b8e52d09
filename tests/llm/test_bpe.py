import hashlib
import random
import struct

import pytest
import tiktoken

from quillmark.llm import bpe

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks_of(PATH), special_tokens={})


def test_every_boundary_rule_against_the_library(reference):
    rng = random.Random(7)
    parts = ["a", "s", "t", "re", "ve", "ll", "'", "'s", "'re", " ", "  ", "\n", "\t", "1", "23", "é", "中", "!", "''", "\U0001f600", "D", "́", "\x1c", "\x85", " "]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(4000)]
    texts += ["", "ab" * 5000 + "xyz", "a" * 3000, "'s" * 50, " " * 500, "'", "x'", "'l"]
    pieces, _ = bpe.codec(PATH)
    for _, _, some in bpe.chunks(texts):
        t = bpe.Tokens(some, pieces)
        for k, text in enumerate(some):
            assert t.ids[t.bounds[k] : t.bounds[k + 1]].tolist() == reference.encode_ordinary(text), text


def test_query_columns_nulls_repeats_and_clashing_names(spark, reference):
    rows = [(1, "It's 10 o'clock,  isn't it?\n", "x"), (2, None, "y"), (3, "", "z"), (3, "", "z"), (None, "señor 中文", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(map(tuple, bpe.round_trip(docs, PATH).collect()), key=str)
    want = []
    for i, text, _ in rows:
        ids = reference.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_decode_gives_the_text_back(spark):
    docs = spark.createDataFrame([(1, "don't  panic\t !"), (2, None)], "doc_id long, text string")
    back = {r["doc_id"]: bytes(r["bytes"]).decode() for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    assert back == {1: "don't  panic\t !", 2: ""}


def test_empty_table(spark):
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_windows_and_a_cache_that_forgets_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 64)
    monkeypatch.setattr(bpe, "CACHE", 40)
    monkeypatch.setattr(bpe, "CACHED_IDS", 100)
    rng = random.Random(3)
    words = ["It's", "  ", "don't", "\n\n", " ", "x", "1234", "señor", "中文", "'ll", "!?", "\t", "word"]
    texts = ["".join(rng.choices(words, k=rng.randrange(200))) for _ in range(60)] + ["no" * 200, " " * 300, None]
    pieces = bpe.Pieces(bpe.codec(PATH)[0].encode)
    vocabulary = bpe.codec(PATH)[1]
    seen = 0
    for a, z, ids, bounds in bpe.encoded(texts, pieces):
        for k in range(a, z):
            own = ids[bounds[k - a] : bounds[k - a + 1]]
            assert own.tolist() == reference.encode_ordinary(texts[k] or "")
            ends = vocabulary.ends(own)
            assert vocabulary.decoded(own, ends).tobytes().decode() == (texts[k] or "")
            assert [vocabulary.decoded(own[:j]).tobytes() for j in range(len(own) + 1)][1:] == [(texts[k] or "").encode()[:e] for e in ends]
            seen += 1
    assert seen == len(texts)
    assert pieces.ends.n < 400


def test_merging_side_by_side_equals_merging_alone():
    rng = random.Random(11)
    merges = bpe.Merges(bpe.ranks_of(PATH))
    some = ["".join(rng.choices("abcdeinrst é中1", k=rng.randrange(1, 90))).encode() for _ in range(500)] + [b"a" * 64, b"a" * 65, b"zz"]
    ids, counts = merges.all(some)
    at = 0
    for piece, n in zip(some, counts.tolist(), strict=True):
        assert ids[at : at + n].tolist() == merges(piece)
        at += n
    assert at == len(ids)
