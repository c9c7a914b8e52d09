"""Operator 1: token counts that follow edits.

A document keeps its slices (the pieces that are encoded apart) in chunks with a segment tree over
them, whose nodes hold the tokens and the code points below. Whether a slice starts at a place
depends on at most five code points before and two behind it, so an edit can only move boundaries near it: the
slices that touch the edit and this margin are cut and encoded again, all others keep their counts,
and the sums on the way from the changed chunks to the root are updated.

Defined results: a null text counts as empty and has no tokens; an edit's place and length are clipped to the
text, a null edit, place, length or insertion does nothing or inserts nothing; edits apply in their order; repeated rows
are counted apart; other columns aren't looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bpe

#: Slices of a chunk when a tree is built; a chunk may grow to eight times as many.
CHUNK = 64
#: Code points before and behind an edit where boundaries may move, with some to spare.
BEFORE, BEHIND = 4, 8


class TokenTree:
    def __init__(self, text: str, pieces: bpe.Pieces, cut: np.ndarray | None = None, counts: np.ndarray | None = None):
        """``cut``: slice starts with the end, ``counts``: tokens of the slices, if they are known."""
        self.pieces = pieces
        self.encoded = 0
        if cut is None:
            t = bpe.Tokens([text], pieces)
            cut, counts = t.cut, t.counts
            self.encoded = len(counts)
        self.build(text, cut, counts)

    def build(self, text: str, cut: np.ndarray, counts: np.ndarray) -> None:
        edges = np.append(np.arange(0, len(counts), CHUNK), len(counts)) if len(counts) else np.zeros(2, np.int64)
        at = cut[edges]
        self.texts = [text[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        self.lengths = np.split(np.diff(cut), edges[1:-1])
        self.counts = np.split(counts, edges[1:-1])
        n = len(self.texts)
        self.size = 1 << (n - 1).bit_length()
        self.tokens, self.chars = np.zeros(2 * self.size, np.int64), np.zeros(2 * self.size, np.int64)
        upto = np.concatenate([[0], np.cumsum(counts)])
        self.tokens[self.size : self.size + n] = np.diff(upto[edges])
        self.chars[self.size : self.size + n] = np.diff(at)
        level = self.size
        while level > 1:
            for tree in (self.tokens, self.chars):
                tree[level // 2 : level] = tree[level : 2 * level].reshape(-1, 2).sum(1)
            level //= 2

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def find(self, at: int) -> tuple[int, int]:
        """The chunk that holds a code point (the last one for the end) and the chunk's start."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if at - start >= self.chars[node] and self.chars[node + 1]:
                start += int(self.chars[node])
                node += 1
        return node - self.size, start

    def count_before(self, at: int) -> int:
        """Tokens of the whole slices before a code point."""
        chunk, start = self.find(at)
        node, total = chunk + self.size, 0
        while node > 1:
            if node % 2:
                total += int(self.tokens[node - 1])
            node //= 2
        ends = np.cumsum(self.lengths[chunk])
        return total + int(self.counts[chunk][ends <= at - start].sum())

    def replace(self, at: int, length: int, new: str) -> None:
        n = int(self.chars[1])
        at = min(max(at, 0), n)
        length = min(max(length, 0), n - at)
        first, start = self.find(max(0, at - BEFORE - BEHIND))
        last, last_start = self.find(min(n, at + length + BEFORE + BEHIND))
        window = "".join(self.texts[first : last + 1])
        lead = self.tail(first)
        trail = self.head(last)
        a = at - start
        changed = window[:a] + new + window[a + length :]
        cp = np.frombuffer((lead + changed + trail).encode("utf-32-le"), np.uint32)
        if not len(changed):
            lengths = counts = np.zeros(0, np.int64)
        else:
            begin = np.zeros(len(cp), bool)
            begin[0] = True
            flags = bpe.starts_of(cp, begin)[len(lead) : len(lead) + len(changed)]
            flags[0] = True
            cut = np.append(np.flatnonzero(flags), len(changed))
            lengths = np.diff(cut)
            counts = np.full(len(lengths), -1, np.int64)
            old_lengths, old_counts = np.concatenate(self.lengths[first : last + 1]), np.concatenate(self.counts[first : last + 1])
            old_ends = np.cumsum(old_lengths)
            left = int((cut[1:] <= a - BEFORE).sum())
            left = min(left, int((old_ends <= a - BEFORE).sum()))
            right = int((cut[:-1] >= a + len(new) + BEHIND).sum())
            right = min(right, int((old_ends - old_lengths >= a + length + BEHIND).sum()))
            counts[:left] = old_counts[:left]
            if right:
                counts[-right:] = old_counts[-right:]
            for k in np.flatnonzero(counts < 0).tolist():
                piece = changed[cut[k] : cut[k + 1]].encode()
                counts[k] = self.pieces.count(piece)
                self.encoded += 1
        self.put(first, last, changed, lengths, counts)

    def tail(self, chunk: int) -> str:
        """Some code points before a chunk."""
        out = ""
        while chunk > 0 and len(out) < BEHIND:
            chunk -= 1
            out = self.texts[chunk][-BEHIND:] + out
        return out[-BEHIND:]

    def head(self, chunk: int) -> str:
        """Some code points behind a chunk."""
        out = ""
        while chunk + 1 < len(self.texts) and len(out) < BEHIND:
            chunk += 1
            out += self.texts[chunk][:BEHIND]
        return out[:BEHIND]

    def put(self, first: int, last: int, text: str, lengths: np.ndarray, counts: np.ndarray) -> None:
        """New content of some chunks, dealt over them, and new sums above them."""
        k = last - first + 1
        if len(counts) > 8 * CHUNK * k:
            self.texts[first : last + 1] = [text, *[""] * (k - 1)]
            self.lengths[first : last + 1] = [lengths, *[lengths[:0]] * (k - 1)]
            self.counts[first : last + 1] = [counts, *[counts[:0]] * (k - 1)]
            every = np.concatenate(self.lengths)
            self.build("".join(self.texts), np.concatenate([[0], np.cumsum(every)]), np.concatenate(self.counts))
            return
        edges = np.linspace(0, len(counts), k + 1).astype(int)
        at = np.concatenate([[0], np.cumsum(lengths)])[edges].tolist()
        for j in range(k):
            a, b = edges[j], edges[j + 1]
            self.texts[first + j] = text[at[j] : at[j + 1]]
            self.lengths[first + j], self.counts[first + j] = lengths[a:b], counts[a:b]
            self.tokens[self.size + first + j], self.chars[self.size + first + j] = counts[a:b].sum(), at[j + 1] - at[j]
        lo, hi = (self.size + first) // 2, (self.size + last) // 2
        while lo >= 1:
            for tree in (self.tokens, self.chars):
                tree[lo : hi + 1] = tree[2 * lo : 2 * hi + 2].reshape(-1, 2).sum(1)
            lo, hi = lo // 2, hi // 2


def edited_counts(docs: DataFrame, edits: Column, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, edited_tokens, n_slices, encoded_again).

    ``edits``: array of structs (at, length, new) over code points, to be applied in this order.
    """

    def run(batches):
        pieces, _ = bpe.codec(path)
        for b in batches:
            every = b.column(2).to_pylist()
            for a, z, texts in bpe.chunks(b.column(1).to_pylist()):
                t = bpe.Tokens(texts, pieces)
                upto = np.concatenate([[0], np.cumsum(list(map(len, texts)))])
                before, after, again = [], [], []
                for k, text in enumerate(texts):
                    i, j = t.per_text[k], t.per_text[k + 1]
                    tree = TokenTree(text, pieces, t.cut[i : j + 1] - upto[k] if j > i else np.zeros(1, np.int64), t.counts[i:j])
                    before.append(tree.total)
                    for e in every[a + k] or ():
                        if e and e["at"] is not None:
                            tree.replace(e["at"], e["length"] or 0, e["new"] or "")
                    after.append(tree.total)
                    again.append(tree.encoded)
                yield pa.record_batch([b.column(0)[a:z], pa.array(before, pa.int64()), pa.array(after, pa.int64()), pa.array(np.diff(t.per_text), pa.int64()), pa.array(again, pa.int64())], [id_col, "n_tokens", "edited_tokens", "n_slices", "encoded_again"])

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(id_col, text_col, edits.cast("array<struct<at:long,length:long,new:string>>").alias("e"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, edited_tokens long, n_slices long, encoded_again long")


def sample_edits(text_col: str = "text") -> Column:
    """Three edits of every text: a part in the middle makes way for the text's start, a word comes in at a quarter, and the last code points go."""
    text, n = F.col(text_col), F.char_length(text_col)
    one = lambda at, length, new: F.struct(at.cast("long").alias("at"), F.lit(length).cast("long").alias("length"), new.alias("new"))
    return F.array(one(F.floor(n / 2), 40, F.substring(text, 1, 24)), one(F.floor(n / 4), 0, F.lit(" edited")), one(n - 5, 20, F.lit("")))
