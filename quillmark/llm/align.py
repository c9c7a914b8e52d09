"""Operator 13: how the tokens of two tokenizers lie on each other, by divide and conquer at shared cuts.

Both tokenizers cut the bytes of space and text. A byte at which tokens of both end is a shared cut. One is looked for from the
middle of A's ends outwards, each end by a bisect in B's; what lies before and behind it is cut in the same way, and an interval without a
shared cut is a leaf: a group. All intervals of one depth are looked at side by side, and an end is tried once, so the
work is that of one bisect for a token. A shared cut links the A token and the B token that end there.

How often two ids are linked is counted over all documents. A document's distinct pairs then meet these counts: pairs
above 1/2**17 of all links, which are fewer than 2**17, by a broadcast; the others by a shuffle. The best count of an id of B is one row for an
id of its vocabulary.

A's ids come from its library, one call for the distinct slices of its split pattern; B's from its library, one call for distinct words
with the spaces before them, if none of its pieces has a space behind another character, else for whole texts: then no merge crosses such a place.

Defined results: null and empty texts, and texts that a tokenizer doesn't give back byte for byte, have no tokens: zeros and an empty string. Repeated
rows count as often as they occur; null ids take part; an empty table gives no rows; other columns aren't looked at.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import bounded, discard, scratch, staged
from .rans import library

#: Bits of an id in a pair.
BITS = 20
#: Pairs with more than this share of all links are hot; there are fewer than its inverse.
HOT = 1 << 17
#: Distinct words kept with their tokens, and the longest of them.
KEPT, LONGEST = 250_000, 64
#: Bytes of text whose tokens are laid on each other at once.
TOGETHER = 1 << 20


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b``, both strictly ascending, of the values that are in both."""
    lo, hi = np.zeros(1, np.int64), np.full(1, len(a))
    low, high = np.zeros(1, np.int64), np.full(1, len(b))  # of b
    hits = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    while len(lo):
        up = (lo + hi) // 2
        down, at = up.copy(), np.full(len(lo), -1)  # ends down up to up aren't shared, but for a hit
        active = np.arange(len(lo))
        for turn in itertools.count():
            if not len(active):
                break
            own = active[up[active] < hi[active]] if turn % 2 == 0 else active[down[active] > lo[active]]
            place = up[own] if turn % 2 == 0 else down[own] - 1
            found = np.minimum(np.searchsorted(b, a[place]), len(b) - 1)
            hit = b[found] == a[place]
            if turn % 2 == 0:
                up[own] += 1
            else:
                down[own] -= 1
            at[own[hit]] = found[hit]
            hits.append((place[hit], found[hit]))
            active = active[(at[active] < 0) & ((up[active] < hi[active]) | (down[active] > lo[active]))]
        cut = at >= 0
        lo, hi = np.concatenate([lo[cut], up[cut]]), np.concatenate([down[cut], hi[cut]])
        low, high = np.concatenate([low[cut], at[cut] + 1]), np.concatenate([at[cut], high[cut]])
        open_ = (lo < hi) & (low < high)
        lo, hi, low, high = lo[open_], hi[open_], low[open_], high[open_]
    i, j = (np.sort(np.concatenate(x)) for x in zip(*hits, strict=True))
    return i, j


class Side:
    """Bytes of each id of a vocabulary, and texts of the ids with what stands behind them."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = np.array(tokens, object)
        self.size = np.array([len(x) for x in tokens], np.int64)
        self.ids = [str(k).encode() for k in range(len(tokens))]

    def ending(self, by: bytes) -> list[bytes]:
        return [k + by for k in self.ids]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


@functools.lru_cache(2)
def side_a(path: str) -> Side:
    from tokenizers import Tokenizer

    t, letters = Tokenizer.from_file(path), byte_letters()
    vocabulary = t.get_vocab()
    tokens = [b""] * (1 + max(vocabulary.values()))
    for token, k in vocabulary.items():
        tokens[k] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    return Side(tokens)


class Pieces:
    """B's ids of texts; distinct words go to the library once while they are kept."""

    def __init__(self, path: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.lib.id_to_piece(k) for k in range(self.lib.get_piece_size())]
        space = "▁"
        self.apart = not any(re.search(f"[^{space}]{space}", x) for k, x in enumerate(names) if not self.lib.is_control(k)) and space in names
        self.side = Side([bytes([int(x[3:5], 16)]) if self.lib.is_byte(k) else x.replace(space, " ").encode() for k, x in enumerate(names)])
        self.space = self.lib.piece_to_id(space)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.ends = bpe.Grown(np.int32), bpe.Grown(np.int64)
        self.ends.add(np.zeros(1, np.int64))

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of words that each begin with a space, which the library adds itself."""
        return [ids if w != " " else [self.space] for ids, w in zip(self.lib.encode([w[1:] for w in words], num_threads=1), words, strict=True)]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of texts that begin with a space."""
        if not self.apart:
            every = self.lib.encode([x[1:] for x in texts], num_threads=1)
            return np.array([*itertools.chain.from_iterable(every)], np.int64), np.cumsum([0, *map(len, every)])
        if len(self.number) > KEPT or self.flat.n > 16 * KEPT:
            self.clear()
        words = [re.findall(" +[^ ]*", x) for x in texts]
        number, fresh = self.number, {}
        k = np.empty(sum(map(len, words)), np.int64)
        for i, w in enumerate(itertools.chain.from_iterable(words)):
            n = number.get(w)
            if n is None:
                n = fresh.setdefault(w, len(self.ends.all) - 1 + len(fresh))
            k[i] = n
        if fresh:
            ids = self.encode([*fresh])
            self.ends.add(self.ends.all[-1] + np.cumsum([*map(len, ids)]))
            self.flat.add(np.array([*itertools.chain.from_iterable(ids)], np.int32))
            number.update((w, n) for w, n in fresh.items() if len(w) <= LONGEST)
        ends = self.ends.all
        count = (ends[1:] - ends[:-1])[k]
        upto = np.concatenate([[0], np.cumsum(count)])
        out = self.flat.all[bpe.spread(ends[:-1][k], count)].astype(np.int64)
        return out, upto[np.cumsum([0, *map(len, words)])]


@functools.lru_cache(2)
def pieces_b(path: str) -> Pieces:
    return Pieces(path)


def faithful(side: Side, ids: np.ndarray, bounds: np.ndarray, data: list[bytes]) -> np.ndarray:
    """Which texts' tokens give back their bytes."""
    whole = b"".join(side.tokens[ids].tolist())
    upto = np.concatenate([[0], np.cumsum(side.size[ids])])[bounds]
    return np.array([z - a == len(d) and whole[a:z] == d for a, z, d in zip(upto[:-1].tolist(), upto[1:].tolist(), data, strict=True)], bool)


class Aligned:
    """The tokens of some texts, those of the faithful ones alone; text k has ``a[abounds[k]:abounds[k + 1]]`` and likewise b."""

    def __init__(self, texts: list[str], a_path: str, b_path: str):
        own, pieces = side_a(a_path), pieces_b(b_path)
        data = [x.encode() for x in texts]
        parts = [(ids.astype(np.int64), np.diff(bounds)) for _, _, ids, bounds in bpe.encoded(texts, library(a_path))]
        a = np.concatenate([x for x, _ in parts]) if parts else np.zeros(0, np.int64)
        abounds = np.concatenate([[0], np.cumsum(np.concatenate([n for _, n in parts]))]) if parts else np.zeros(1, np.int64)
        b, bbounds = pieces(texts)
        good = faithful(own, a, abounds, data) & faithful(pieces.side, b, bbounds, data) & np.array([len(x) > 1 for x in data], bool)
        drop = lambda ids, bounds: (ids[np.repeat(good, np.diff(bounds))], np.concatenate([[0], np.cumsum(np.diff(bounds) * good)]))
        (self.a, self.abounds), (self.b, self.bbounds) = drop(a, abounds), drop(b, bbounds)
        # faithful texts have equal bytes on both sides, so all stand behind each other
        self.i, self.j = common_ends(np.cumsum(own.size[self.a]), np.cumsum(pieces.side.size[self.b]))
        self.links = np.searchsorted(self.i, self.abounds)  # links of each text: a text's end is a shared cut
        self.sides = own, pieces.side

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        before = lambda cuts, n: np.searchsorted(cuts, np.arange(n))  # shared cuts before a token
        ga, gb = before(self.i, len(self.a)), before(self.j, len(self.b))
        place_a = np.arange(len(self.a)) + np.concatenate([[0], self.j + 1])[ga]
        place_b = np.arange(len(self.b)) + np.concatenate([self.i + 1, [0]])[gb]
        na, nb = len(self.sides[0].ids), len(self.sides[1].ids)
        code = np.empty(len(self.a) + len(self.b), np.int64)
        last_a, last_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        last_a[self.i], last_b[self.j] = True, True
        code[place_a] = self.a + np.where(last_a, na, 0)
        code[place_b] = 2 * na + self.b + np.where(last_b, nb, 0)
        out = spelled(self.sides)[code].tolist()
        at = (self.abounds + self.bbounds).tolist()
        return [b"".join(out[x:z])[:-1] for x, z in zip(at[:-1], at[1:], strict=True)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, n): how often a text links each pair, a pair being A's id and B's behind it."""
        text = np.repeat(np.arange(len(self.abounds) - 1), np.diff(self.links))
        pair = self.a[self.i] << BITS | self.b[self.j]
        key, n = np.unique(text << 2 * BITS | pair, return_counts=True)
        return key >> 2 * BITS, key & ((1 << 2 * BITS) - 1), n


_spelled: dict[int, np.ndarray] = {}


def spelled(sides: tuple[Side, Side]) -> np.ndarray:
    """A's ids before a comma, before a bar, then B's before a comma and before a semicolon."""
    key = id(sides[0]) ^ id(sides[1])
    if key not in _spelled:
        a, b = sides
        _spelled.clear()
        _spelled[key] = np.array(a.ending(b",") + a.ending(b"|") + b.ending(b",") + b.ending(b";"), object)
    return _spelled[key]


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", spell: bool = False) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups_sha256, pair, n, groups): a document's groups and how often it links each pair.

    ``groups`` is the groups' text itself where ``spell`` is set, else null.
    """

    def run(batches):
        for b in bounded(batches, 1, TOGETHER):
            texts = [" " + (x or "") for x in b.column(1).to_pylist()]
            some = Aligned(texts, a_path, b_path)
            groups = some.groups()
            text, pair, n = some.pairs()
            bounds = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
            count = lambda x: pa.array(np.diff(x))
            sha = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
            lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x)) for x in (pair, n.astype(np.int32))]
            yield pa.record_batch(
                [b.column(0), count(some.abounds), count(some.bbounds), count(some.links), count(some.links), pa.array(sha), *lists, pa.array([g.decode() if spell else None for g in groups], pa.string())],
                ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "n", "groups"],
            )

    schema = f"id {dict(docs.dtypes)[id_col]}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair array<long>, n array<int>, groups string"
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def pair_counts(documents: DataFrame) -> DataFrame:
    """(pair, c, of_b): links of each pair in all documents, and its id of B."""
    counted = documents.select(F.inline(F.arrays_zip("pair", "n"))).groupBy("pair").agg(F.sum("n").alias("c"))
    return counted.withColumn("of_b", F.col("pair").bitwiseAND((1 << BITS) - 1))


def with_best(counted: DataFrame) -> DataFrame:
    """(pair, c, best): and whether no other pair of B's id has more links."""
    top = counted.groupBy("of_b").agg(F.max("c").alias("top"))  # one row for an id of B's vocabulary
    return counted.join(F.broadcast(top), "of_b").select("pair", "c", (F.col("c") == F.col("top")).alias("best"))


def alignment(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    at = scratch(docs.sparkSession)
    # numbered in a written table, so that a lost task can't number rows anew
    documents = staged(aligned(docs, a_path, b_path, id_col, text_col).drop("groups").withColumn("row", F.monotonically_increasing_id()), f"{at}/documents", compression="zstd")
    counted = staged(pair_counts(documents), f"{at}/counted")
    counts = staged(with_best(counted), f"{at}/counts")
    total = counts.agg(F.sum("c")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("c") > total // HOT + 1))  # fewer than HOT rows
    cold = counts.where(F.col("c") <= total // HOT + 1)
    rows = documents.select("row", F.inline(F.arrays_zip("pair", "n")))
    found = lambda df: df.groupBy("row").agg(F.sum(F.col("n") * F.col("c")).alias("s"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("k"))
    both = found(rows.join(hot, "pair")).unionByName(found(rows.join(hot, "pair", "left_anti").join(cold, "pair")))
    sums = both.groupBy("row").agg(F.sum("s").alias("s"), F.sum("k").alias("k"))
    out = documents.drop("pair", "n").join(sums, "row", "left")
    zero = F.lit(0).cast("long")
    out = out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.coalesce("k", zero).alias("n_best"), F.coalesce("s", zero).alias("count_sum"), "groups_sha256")
    discard(docs.sparkSession, f"{at}/counted")
    return out
