import random

import pytest

from quillmark.llm import bpe, edits

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.01"


def counted(text):
    return len(bpe.Tokens([text], bpe.codec(PATH)[0]).ids)


def test_random_edits_against_counting_anew():
    rng = random.Random(3)
    parts = ["a", "s", "t", "re", "ll", "'", "'s", " ", "  ", "\n", "1", "é", "!", "word", " the", "x'll"]
    pieces, _ = bpe.codec(PATH)
    for _ in range(150):
        text = "".join(rng.choices(parts, k=rng.randrange(0, 900)))
        tree = edits.TokenTree(text, pieces)
        for _ in range(12):
            at, length = rng.randrange(len(text) + 1), rng.choice([0, 1, 2, 5, 60, 2000])
            new = "".join(rng.choices(parts, k=rng.choice([0, 0, 1, 3, 40, 1500 if rng.random() < 0.1 else 2])))
            tree.replace(at, length, new)
            text = text[:at] + new + text[at + length :]
            assert "".join(tree.texts) == text
            assert tree.total == counted(text)
            assert sum(map(sum, tree.counts)) == tree.total


def test_only_the_neighbourhood_is_encoded_again():
    text = "some words and more " * 5000
    tree = edits.TokenTree(text, bpe.codec(PATH)[0])
    tree.encoded = 0
    tree.replace(50_000, 3, "new words")
    assert tree.encoded < 15 and tree.total == counted(text[:50_000] + "new words" + text[50_003:])
    assert tree.count_before(10 * 20) == counted("some words and more " * 10) - 1


def applied(text, es):
    for at, length, new in es:
        at = min(max(at, 0), len(text))
        text = text[:at] + (new or "") + text[at + (length or 0) :]
    return text


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in edits.edited_counts(docs, edits.sample_edits(), PATH).collect()}
    assert len(got) == docs.count()
    for r in docs.limit(300).collect():
        t = r["text"]
        n = len(t)
        want = applied(t, [(n // 2, 40, t[:24])])
        want = applied(want, [(n // 4, 0, " edited")])
        want = applied(want, [(n - 5, 20, "")])
        assert (got[r["doc_id"]]["n_tokens"], got[r["doc_id"]]["edited_tokens"]) == (counted(t), counted(want))
        assert got[r["doc_id"]]["encoded_again"] <= 80


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "b c"), (5, "long text " * 20_000)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, e int")
    got = sorted(((r["doc_id"] or -1, r["n_tokens"], r["edited_tokens"]) for r in edits.edited_counts(df, edits.sample_edits(), PATH).collect()))
    # in the empty text the last edit starts at the clipped place 0 and takes the inserted word away
    assert got == [(-1, 2, 0), (1, 0, 0), (2, 0, 0), (3, 1, 0), (3, 1, 0), (5, 40_001, 40_000)]
    assert edits.edited_counts(df.where("false"), edits.sample_edits(), PATH).count() == 0
