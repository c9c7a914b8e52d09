import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmark.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def tokens(text):
    """Ids and bytes of both libraries for whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    global _A, _B
    if "_A" not in globals():
        _A, _B = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        _A.encode_special_tokens = True
    letters = {c: b for b in range(256) for c in [_letter(b)]}
    a, b = _A.encode(" " + text, add_special_tokens=False).ids, _B.encode(text)
    bytes_a = [bytes(letters[c] for c in _A.id_to_token(k)) for k in a]
    bytes_b = [bytes([int(_B.id_to_piece(k)[1:-1], 16)]) if _B.is_byte(k) else _B.id_to_piece(k).replace("▁", " ").encode() for k in b]
    return a, bytes_a, b, bytes_b


def _letter(b):
    from tokenizers import pre_tokenizers

    if not _LETTERS:
        alphabet = sorted(pre_tokenizers.ByteLevel.alphabet(), key=ord)
        own = [c for c in alphabet if ord(c) < 256]
        rest = [c for c in alphabet if ord(c) >= 256]
        _LETTERS.update({ord(c): c for c in own})
        _LETTERS.update(dict(zip([x for x in range(256) if x not in _LETTERS], rest, strict=True)))
    return _LETTERS[b]


_LETTERS: dict[int, str] = {}


def plain(rows):
    every, count = [], Counter()
    for i, text in rows:
        a, x, b, y = tokens(text or "")
        whole = (" " + (text or "")).encode()
        if not text or b"".join(x) != whole or b"".join(y) != whole:
            every.append((i, [], [], [], ""))
            continue
        ends_a, ends_b = np.cumsum([*map(len, x)]).tolist(), np.cumsum([*map(len, y)]).tolist()
        shared = sorted(set(ends_a) & set(ends_b))
        links = [(a[ends_a.index(e)], b[ends_b.index(e)]) for e in shared]
        groups, start = [], 0
        for e in shared:
            own = [",".join(str(k) for k, z in zip(ids, ends, strict=True) if start < z <= e) for ids, ends in ((a, ends_a), (b, ends_b))]
            groups.append("|".join(own))
            start = e
        count.update(links)
        every.append((i, a, b, links, ";".join(groups)))
    best = {}
    for (_, k), n in count.items():
        best[k] = max(best.get(k, 0), n)
    out = []
    for i, a, b, links, groups in every:
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((i, len(a), len(b), len(links), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), sha))
    return sorted(out, key=str)


def got(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((tuple(r[c] for c in COLUMNS) for r in align.alignment(df, A, B).collect()), key=str)


ODD = [
    (1, None), (2, ""), (3, " "), (4, "  two  spaces   here "), (5, "<|endoftext|> and <s> </s> <unk> <0x41>"), (6, "a ▁ mark"), (7, "日本語の文章と emoji 👩‍👩‍👧 and é"),
    (8, "tab\tand\nline\r\n\x0b end"), (9, "x" * 5000), (10, "ﬁ ① ½  nbsp 　wide"), (None, "null id"), (None, "null id"), (12, "same"), (12, "same"), (13, "1234567 89,5 http://a.b/c?d=e"), (14, "\x00 ﻿b"), (15, "a  "), (16, "\n"),
]


def test_odd_texts_against_the_libraries(spark):
    assert got(spark, ODD) == plain(ODD)


def test_documents_against_the_libraries(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert got(spark, rows) == plain(rows)


def test_empty_table_and_clashing_names(spark):
    assert align.alignment(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
    df = spark.createDataFrame(ODD[:8], "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("PAIR", F.lit(2)).withColumn("n", F.lit(3))
    assert sorted((tuple(r[c] for c in COLUMNS) for r in align.alignment(df, A, B).collect()), key=str) == plain(ODD[:8])


def test_rare_pairs_take_the_other_way(spark, monkeypatch):
    monkeypatch.setattr(align, "HOT", 50)
    rows = [(k, f"word{k % 7} and some other words {k} the the the") for k in range(60)]
    assert got(spark, rows) == plain(rows)


def test_texts_cut_at_spaces_have_the_library_s_ids():
    import sentencepiece

    lib, pieces = sentencepiece.SentencePieceProcessor(model_file=B), align.Pieces(B)
    assert pieces.apart
    texts = [t or "" for _, t in ODD]
    ids, bounds = pieces([" " + t for t in texts])
    for t, a, z in zip(texts, bounds[:-1], bounds[1:], strict=True):
        if t:
            assert ids[a:z].tolist() == lib.encode(t)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)))
def test_shared_cuts(a, b):
    a, b = np.array(sorted(a | {61})), np.array(sorted(b | {61}))
    i, j = align.common_ends(a, b)
    assert a[i].tolist() == b[j].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_groups_can_be_spelled(spark):
    df = spark.createDataFrame([(1, "hello"), (2, None)], "doc_id long, text string")
    out = {r["id"]: r["groups"] for r in align.aligned(df, A, B, spell=True).collect()}
    a, _, b, _ = tokens("hello")
    assert out == {1: ",".join(map(str, a)) + "|" + ",".join(map(str, b)), 2: ""}
