"""Operator 10: byte-level BPE by rank files, with vectorised pre-tokenisation.

Code points become class numbers (letter, number, white space, other) through one lookup array.
Every rule of the split pattern then is a comparison of neighbouring classes, and what has to be
carried further (where the present run began) is a scan: the transition function of a code point is
either constant (a run begins here) or the identity, such functions compose associatively, and
``maximum.accumulate`` composes them. No regular expression runs.

Slices between boundaries are encoded by pair merging once per distinct slice and worker. Slices are told apart by
two 64-bit hashes, so a worker keeps 30 to 50 bytes for one, in arrays whose size is bounded. The byte offset behind each
token is kept beside the ids, and decoding puts the bytes of the vocabulary at those offsets.

Defined results: a null text counts as empty; an empty text has no tokens and decodes to no bytes; a very long text
is worked on in windows that end where a slice must start; equal rows give equal rows; a null id stays null; other columns aren't looked at.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded

OTHER, LETTER, NUMBER, SPACE = range(4)
# The code points of the Unicode property White_Space.
WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: Distinct slices that a worker keeps, and their tokens; beyond that it forgets those that came once, which changes no result.
CACHE, CACHED_IDS = 500_000, 2_500_000
#: Slices up to this length are kept, longer ones are encoded each time.
HASHED = 256
#: Code points that are worked on at once.
CHUNK = 1 << 18


@functools.cache
def classes() -> np.ndarray:
    by_category = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((by_category.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[list(WHITE_SPACE)] = SPACE
    return out


def starts_of(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where a slice of the split pattern starts; ``first`` marks the first code point of each text."""
    n = len(cp)
    cls = classes()[cp]
    run = first.copy()
    run[1:] |= cls[1:] != cls[:-1]
    last = np.ones(n, bool)
    last[:-1] = run[1:]
    ends_text = np.ones(n, bool)
    ends_text[:-1] = first[1:]
    start = run.copy()
    # white space leaves its last code point to what follows; a plain space is joined to it
    left = (cls == SPACE) & last & ~ends_text
    start |= left
    joined = left & (cp == 0x20)
    start[1:] &= ~joined[:-1]
    # contractions: a lone apostrophe that starts a slice, and s t m d or re ve ll behind it
    quote = np.flatnonzero((cp == 0x27) & run & last & ~ends_text & start)
    if len(quote):
        one = cp[quote + 1]
        two = np.where(quote + 2 < n, cp[np.minimum(quote + 2, n - 1)], 0)
        two[(quote + 2 < n) & first[np.minimum(quote + 2, n - 1)]] = 0
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            double |= (one == ord(a)) & (two == ord(b))
        hit = quote[single | double]
        start[hit + 1] = False
        after = hit + np.where(double[single | double], 3, 2)
        start[after[after < n]] = True
    return start


def slices(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 and code points of all texts in one, byte offsets of the slices (with the end), their code point offsets, and the slices before each text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    whole = "".join(texts)
    at = np.concatenate([[0], np.cumsum(sizes)])
    cp = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    if not len(cp):
        return b"", cp, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64)
    first = np.zeros(len(cp), bool)
    first[at[:-1][sizes > 0]] = True
    start = starts_of(cp, first)
    width = np.ones(len(cp), np.int64)
    for least in (0x80, 0x800, 0x10000):
        width += cp >= least
    ends = np.cumsum(width)
    cut = np.flatnonzero(start)
    offsets = np.append((ends - width)[cut], ends[-1])
    return whole.encode(), cp, offsets, np.append(cut, len(cp)), np.searchsorted(cut, at)


class Merges:
    """Pair merging over token ids. In a rank file a token's rank is its id, so a pair's rank is the id it merges to."""

    NONE = 1 << 30

    #: Slices up to this many bytes are merged side by side.
    SHORT = 64

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys, values = array("q"), array("q")
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        keys, values = np.array(keys, np.int64), np.array(values, np.int64)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    @functools.cached_property
    def pair(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.values.tolist(), strict=True))

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], self.NONE)

    def __call__(self, piece: bytes) -> list[int]:
        """Token ids of one slice: the lowest rank is merged first, the leftmost of equal ranks before others."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        if len(ids) > 200:
            return self.long(ids)
        get, none = self.pair.get, self.NONE
        rank = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while rank:
            best = min(rank)
            if best == none:
                break
            i = rank.index(best)
            ids[i] = best
            del ids[i + 1], rank[i]
            if i < len(rank):
                rank[i] = get(best << 32 | ids[i + 1], none)
            if i:
                rank[i - 1] = get(ids[i - 1] << 32 | best, none)
        return ids

    def all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of some slices behind each other, and how many each has."""
        apart = {k: self(x) for k, x in enumerate(pieces) if len(x) > self.SHORT or x in self.ranks}
        rest = [k for k in range(len(pieces)) if k not in apart]
        owner, ids = self.side_by_side([pieces[k] for k in rest])
        counts = np.zeros(len(pieces), np.int64)
        counts[rest] = np.bincount(owner, minlength=len(rest)) if rest else 0
        for k, x in apart.items():
            counts[k] = len(x)
        out = np.empty(int(counts.sum()), np.uint32)
        start = np.cumsum(counts) - counts
        out[spread(start[rest], counts[rest])] = ids
        for k, x in apart.items():
            out[start[k] : start[k] + len(x)] = x
        return out, counts

    def side_by_side(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of the slice, id) of each token: every round merges the first of the lowest ranks of each slice."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        of = np.repeat(np.arange(len(pieces)), size)
        ids = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = np.full(len(ids), self.NONE)
        inner = np.flatnonzero(of[1:] == of[:-1])
        rank[inner] = self.rank_of(ids[inner], ids[inner + 1])
        done = [(of[:0], ids[:0])]
        while len(of):
            first = np.flatnonzero(np.diff(of, prepend=-1))
            least = np.minimum.reduceat(rank, first)
            least = np.repeat(least, np.diff(first, append=len(of)))
            ended = least == self.NONE
            done.append((of[ended], ids[ended]))
            of, ids, rank, least = (x[~ended] for x in (of, ids, rank, least))
            at = np.flatnonzero(rank == least)
            at = at[np.diff(of[at], prepend=-1) > 0]
            ids[at] = least[at]
            gone = np.zeros(len(of), bool)
            gone[at + 1] = True
            of, ids, rank = of[~gone], ids[~gone], rank[~gone]
            at -= np.arange(len(at))
            for left in (at, at[at > 0] - 1):
                inside = (left + 1 < len(of)) & (of[np.minimum(left + 1, len(of) - 1)] == of[left])
                rank[left] = np.where(inside, rank[left], self.NONE)
                left = left[inside]
                rank[left] = self.rank_of(ids[left], ids[left + 1])
        owner, ids = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(owner, kind="stable")
        return owner[order], ids[order]

    def long(self, ids: list[int]) -> list[int]:
        """The same for long slices, by a heap of candidate pairs over linked positions."""
        n, get = len(ids), self.pair.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
                if (q := get(r << 32 | ids[after[j]])) is not None:
                    heapq.heappush(heap, (q, i, r, ids[after[j]]))
            if before[i] >= 0 and (q := get(ids[before[i]] << 32 | r)) is not None:
                heapq.heappush(heap, (q, before[i], ids[before[i]], r))
        return [x for x in ids if x >= 0]


class Grown:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.room, self.n = np.empty(1024, dtype), 0

    def add(self, values: np.ndarray) -> None:
        need = self.n + len(values)
        if need > len(self.room):
            self.room = np.concatenate([self.room[: self.n], np.empty(max(need, len(self.room) * 3 // 2) - self.n, self.room.dtype)])
        self.room[self.n : need] = values
        self.n = need

    @property
    def all(self) -> np.ndarray:
        return self.room[: self.n]


class Pieces:
    """Two hashes of a slice -> its number; the token ids of all slices so far stand behind each other in ``flat``.

    ``encode`` gives the ids of some slices and how many each has. The hashes stand in two sorted runs, the smaller of which takes new ones.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], one: Callable[[bytes], list[int]] | None = None):
        self.encode, self.one = encode, one or (lambda piece: encode([piece])[0])
        self.counted: dict[bytes, int] = {}
        self.clear()

    def clear(self) -> None:
        self.flat, self.ends, self.hits = Grown(np.uint32), Grown(np.int32), Grown(np.int32)
        self.ends.add(np.zeros(1, np.int32))
        self.runs = [self.run(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32)) for _ in range(2)]

    @staticmethod
    def run(h: np.ndarray, check: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(h, kind="stable")
        return h[order], check[order], k[order]

    def add(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Numbers of slices with these ids."""
        first, start = self.ends.n - 1, self.flat.n
        self.flat.add(ids)
        self.ends.add(start + np.cumsum(counts))
        self.hits.add(np.zeros(len(counts), np.int32))
        return np.arange(first, first + len(counts), dtype=np.int32)

    def numbers(self, h: np.ndarray, check: np.ndarray, keep: np.ndarray, piece: Callable[[np.ndarray], list[bytes]]) -> np.ndarray:
        """Numbers of distinct slices; ``piece`` gives the bytes of those that are new, ``keep`` marks those that may be kept."""
        k = np.full(len(h), -1, np.int32)
        for hs, checks, ks in self.runs:
            if len(hs):
                at = np.minimum(np.searchsorted(hs, h), len(hs) - 1)
                same = (hs[at] == h) & (checks[at] == check) & keep
                k[same] = ks[at[same]]
        new = np.flatnonzero(k < 0)
        if len(new):
            k[new] = self.add(*self.encode(piece(new)))
            new = new[keep[new]]
            new = new[np.unique(h[new], return_index=True)[1]]
            self.runs[1] = self.run(*(np.concatenate([old, x[new]]) for old, x in zip(self.runs[1], (h, check, k), strict=True)))
            if len(self.runs[1][0]) > 4096 + len(self.runs[0][0]) // 8:
                self.runs = [self.run(*map(np.concatenate, zip(*self.runs, strict=True))), self.run(h[:0], check[:0], k[:0])]
        self.hits.all[k] += 1
        return k

    def count(self, piece: bytes) -> int:
        """Tokens of one slice."""
        if piece not in self.counted:
            if len(self.counted) > CACHE // 10:
                self.counted = {}
            self.counted[piece] = len(self.one(piece))
        return self.counted[piece]

    def trim(self) -> None:
        """Keep the slices that came in more than one chunk, and half of the room at most."""
        if self.ends.n <= CACHE and self.flat.n <= CACHED_IDS:
            return
        h, check, k = map(np.concatenate, zip(*self.runs, strict=True))
        ends, flat, hits = self.ends.all, self.flat.all, self.hits.all[k]
        best = np.argsort(-hits, kind="stable")[: CACHE // 2]
        best = best[hits[best] > 1]
        size = (ends[1:] - ends[:-1])[k[best]]
        best = best[np.cumsum(size) <= CACHED_IDS // 2]
        h, check, k = h[best], check[best], k[best]
        size, start = (ends[1:] - ends[:-1])[k], ends[:-1][k]
        ids = flat[spread(start, size)]
        self.clear()
        self.runs[0] = self.run(h, check, self.add(ids, size))


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Numbers from each start on, as many as its size says, behind each other."""
    upto = np.cumsum(size)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(start - (upto - size), size)


@functools.cache
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def hashes(cp: np.ndarray, cut: np.ndarray, base: int) -> np.ndarray:
    """A hash of each slice from one running sum over all code points."""
    size = 1 << max(CHUNK.bit_length() - 1, (len(cp) + 1).bit_length())
    up, down = _powers(base, size)
    run = np.empty(len(cp) + 1, np.uint64)
    run[0] = 0
    np.cumsum((cp.astype(np.uint64) + np.uint64(1)) * up[: len(cp)], out=run[1:])
    return ((run[cut[1:]] - run[cut[:-1]]) * down[cut[:-1]]) ^ (np.diff(cut).astype(np.uint64) << np.uint64(48))


class Tokens:
    """Token ids of some texts: ``ids[bounds[k]:bounds[k + 1]]`` are those of text k; slices ``per_text[k]`` up to
    ``per_text[k + 1]`` are its own, with ``counts`` tokens each, at the byte ``offsets`` and code points ``cut``.

    Each distinct slice of the texts is looked up once.
    """

    def __init__(self, texts: list[str], pieces: Pieces):
        raw, cp, self.offsets, self.cut, per_text = slices(texts)
        pieces.trim()
        h, check = (hashes(cp, self.cut, base) for base in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93))
        long = np.flatnonzero(np.diff(self.cut) > HASHED)
        h[long] = long  # each for itself
        _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if (check[first][inverse] != check).any():  # two slices of one hash, or a hash like a long slice's number
            first = inverse = np.arange(len(h))
        keep = np.diff(self.cut)[first] <= HASHED
        at = self.offsets
        k = pieces.numbers(h[first], check[first], keep, lambda new: [raw[a:b] for a, b in zip(at[first[new]].tolist(), at[first[new] + 1].tolist(), strict=True)])[inverse]
        ends = pieces.ends.all
        self.counts = (ends[1:] - ends[:-1])[k].astype(np.int64)
        self.ids = pieces.flat.all[spread(ends[:-1][k].astype(np.int64), self.counts)]
        self.bounds, self.per_text = np.concatenate([[0], np.cumsum(self.counts)])[per_text], per_text


def chunks(texts: list[str | None]) -> Iterator[tuple[int, int, list[str]]]:
    """Runs of texts with about ``CHUNK`` code points; a longer text stands alone."""
    a, size, out = 0, 0, []
    for k, text in enumerate(texts):
        text = text or ""
        if out and size + len(text) > CHUNK:
            yield a, k, out
            a, size, out = k, 0, []
        out.append(text)
        size += len(text)
    if out:
        yield a, len(texts), out


def windows(text: str) -> list[str]:
    """A long text in parts that end before a plain space between two characters that aren't white space: a slice starts there."""
    out, a = [], 0
    while len(text) - a > CHUNK:
        at = text.find(" ", a + CHUNK)
        while at >= 0 and (text[at - 1].isspace() or at + 1 == len(text) or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        out.append(text[a:at])
        a = at
    return [*out, text[a:]]


def encoded(texts: list[str | None], pieces: Pieces) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(a, z, ids, bounds) of the texts a up to z, run by run: those of text a + k are ``ids[bounds[k]:bounds[k + 1]]``."""
    for a, z, some in chunks(texts):
        if len(some) == 1 and len(some[0]) > CHUNK:
            ids = np.concatenate([Tokens([x], pieces).ids for x in windows(some[0])])
            yield a, z, ids, np.array([0, len(ids)])
        else:
            t = Tokens(some, pieces)
            yield a, z, t.ids, t.bounds


@functools.lru_cache(2)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Vocabulary:
    """Bytes of the tokens behind each other."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (1 + max(ranks.values()))
        for token, k in ranks.items():
            tokens[k] = token
        self.raw = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.start = np.cumsum(self.size) - self.size

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset behind each token."""
        return np.cumsum(self.size[ids])

    def decoded(self, ids: np.ndarray, ends: np.ndarray | None = None) -> np.ndarray:
        """The bytes that ids stand for, each token's up to its own offset."""
        ends = self.ends(ids) if ends is None else ends
        return self.raw[spread(self.start[ids], np.diff(ends, prepend=0))]


@functools.lru_cache(2)
def codec(path: str) -> tuple[Pieces, Vocabulary]:
    ranks = ranks_of(path)
    merges = Merges(ranks)
    return Pieces(merges.all, merges), Vocabulary(ranks)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, ends array<int>): the token ids of every whole text and the byte offset of its UTF-8 form behind each of them."""

    def run(batches):
        pieces, vocabulary = codec(path)
        for b in bounded(batches, 1):
            for a, z, ids, bounds in encoded(b.column(1).to_pylist(), pieces):
                ends = [vocabulary.ends(ids[i:j]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.record_batch([b.column(0)[a:z], int_lists(bounds, ids), int_lists(bounds, np.concatenate(ends))], [id_col, "ids", "ends"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, ends array<int>")


def int_lists(bounds: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.astype(np.uint32).view(np.int32)))


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, bytes binary): the bytes that the token ids stand for, by their offsets. UTF-8 text gives ``bytes`` cast to string."""

    def run(batches):
        vocabulary = codec(path)[1]
        for b in batches:
            out = [vocabulary.decoded(np.array(x or (), np.int64), np.array(e or (), np.int64)).tobytes() for x, e in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.record_batch([b.column(0), pa.array(out, pa.binary())], [id_col, "bytes"])

    kind = dict(encoded.dtypes)[id_col]
    return encoded.select(id_col, "ids", "ends").mapInArrow(run, f"`{id_col}` {kind}, bytes binary")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode, then decode the ids, in one pass: (id, n_tokens, ids_sha256, decoded_sha256[, ids])."""

    def run(batches):
        pieces, vocabulary = codec(path)
        for b in bounded(batches, 1):
            for a, z, every, bounds in encoded(b.column(1).to_pylist(), pieces):
                sha, back = [], []
                for i, j in zip(bounds[:-1], bounds[1:], strict=True):
                    sha.append(hashlib.sha256(every[i:j].astype("<u4").tobytes()).hexdigest())
                    whole = hashlib.sha256()
                    for k in range(i, j, CHUNK // 4):
                        whole.update(vocabulary.decoded(every[k : min(j, k + CHUNK // 4)]))
                    back.append(whole.hexdigest())
                ids = [int_lists(bounds, every)] if keep_ids else []
                yield pa.record_batch([b.column(0)[a:z], pa.array(np.diff(bounds), pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string()), *ids], [id_col, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids)
