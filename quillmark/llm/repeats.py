"""Operator 12: long repeated passages by a compacted de Bruijn graph.

A window is ``size`` consecutive words of one document. Of a document's k-mers of words only those are nodes whose
smallest m-mer stands first or last (closed syncmers): that depends on the k-mer's own words alone, each window
holds at least one whole node, and about one word in eight starts one. The edges of a node reach from the start of the node before it
(or of the document) to the end of the node behind it (or of the document); their words are its context.

A node that occurs once is in no repeated window. A node that occurs more often, always in one context, doesn't branch: what
surrounds it in one place surrounds it in all. A document's maximal runs of such nodes are compacted paths, and a
path lies whole in each document that it occurs in, since a document's ends count as edges; so a join of the documents'
nodes with the table of nodes compacts it, and no pointer has to be followed. All windows whose nodes lie on one path are
repeated as often as the path. A window that also holds a repeated node that branches is looked at by itself.

Paths and such windows are pieces: places in documents. Their words are read again at their source coordinates, and pieces of equal 128-bit
digests are the verified repeats. Nodes that many rows share meet the node table by a broadcast of those above
1/1024 of all rows, which are fewer than 1024; the others by a shuffle.

Defined results: null, empty and blank texts have no words; documents shorter than a window lose nothing; repeated rows (of one id and text) repeat
each other's windows, like any copies, and each is returned; null ids take part; an empty table gives no rows; other columns aren't looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, discard, scratch, staged

#: Words of a window.
WINDOW = 35
#: A key with more than this share of all rows is hot; there are fewer such keys than its inverse.
HOT = 1024

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            both.append(np.cumprod(x, dtype=np.uint64))
        _powers[base] = tuple(both)
    return _powers[base]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Sequence:
    """Hashes of any runs of words of one text."""

    def __init__(self, words: list[bytes], seed: int = 0):
        n = len(words)
        base = _BASES[seed]
        up, self.down = powers(base, n + 1)
        h = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up[:n], dtype=np.uint64)])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + length)

    def all(self, length: int) -> np.ndarray:
        at = np.arange(len(self.sums) - length)
        return self.hashes(at, at + length)


def sizes(window: int) -> tuple[int, int]:
    """(k, m): the longest k-mers of which each window holds a node."""
    m = min(3, window)
    return (window + 1 + m) // 2, m


def lowest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def nodes_of(seq: Sequence, window: int) -> np.ndarray:
    """Ascending places of the text's nodes."""
    k, m = sizes(window)
    x = seq.all(m)
    span = k - m
    low = lowest(x, span + 1)
    return np.flatnonzero((low == x[: len(low)]) | (low == x[span:]))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # at ASCII white space


def nodes(docs: DataFrame, window: int) -> DataFrame:
    """(node, context) of every node of the documents ``docs`` (id, h, t) that hold a window, with their places."""
    k, _ = sizes(window)

    def run(batches):
        for b in bounded(batches, 2):
            row, at, node, context = [], [], [], []
            for r, text in enumerate(b.column(2).to_pylist()):
                words = words_of(text)
                n = len(words)
                if n < window:
                    continue
                seq = Sequence(words)
                p = nodes_of(seq, window)
                first, last = np.concatenate([[0], p[:-1]]), np.concatenate([p[1:] + k, [n]])
                around = seq.hashes(first, last)
                around[0] ^= np.uint64(0x5851F42D4C957F2D)  # the document's start and end are edges of their own
                around[-1] ^= np.uint64(0x14057B7EF767814F)
                row.append(np.full(len(p), r))
                at.append(p)
                node.append(seq.hashes(p, p + k))
                context.append(around)
            if row:
                take = pa.array(np.concatenate(row))
                longs = [pa.array(np.concatenate(x).view(np.int64)) for x in (node, context)]
                yield pa.record_batch([b.column(0).take(take), b.column(1).take(take), pa.array(np.concatenate(at).astype(np.int32)), *longs], ["id", "h", "at", "node", "context"])

    return docs.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, h long, at int, node long, context long")


def joined_back(rows: DataFrame, counted: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of ``counted``, which has the keys that occur more than once and their counts ``c``.

    Keys above a share of all rows meet theirs by a broadcast of bounded size, so a hot key isn't gathered in one task.
    """
    total = counted.agg(F.sum("c")).first()[0] or 0
    hot = F.broadcast(counted.where(F.col("c") > total // HOT + 1))  # fewer than HOT rows
    cold = counted.where(F.col("c") <= total // HOT + 1)
    rest = rows.join(hot.select(*keys), keys, "left_anti")
    return rows.join(hot, keys).unionByName(rest.join(cold, keys))


def with_marks(docs: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """Documents with what their marks hold; a null id equals a null id."""
    m = marks.select(F.col("id").alias("mid"), F.col("h").alias("mh"), "marks")
    return docs.join(m, docs["id"].eqNullSafe(m["mid"]) & (docs["h"] == m["mh"]), how).select("id", "h", "t", "marks")


def digest(data: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(data)
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def pieces_of(words: list[bytes], marks: list[int], window: int) -> tuple[list, list, list, list]:
    """(starts, lengths, digests) of the paths of a text and of its windows that have to be looked at by themselves.

    ``marks``: 2 * place of each repeated node, plus 1 if it doesn't branch.
    """
    k, _ = sizes(window)
    seq = Sequence(words)
    p = nodes_of(seq, window)
    state = np.zeros(len(p), np.int8)  # 0 unique, 1 branches, 2 on a path
    told = np.array(sorted(marks), np.int64)
    state[np.searchsorted(p, told >> 1)] = 1 + (told & 1)
    start = np.arange(len(words) - window + 1)
    first = np.searchsorted(p, start)
    last = np.searchsorted(p, start + window - k, "right")  # nodes first up to last lie whole in the window

    def count(kind: int) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(state == kind)])
        return upto[last] - upto[first]

    repeated, branching = count(0) == 0, count(1) > 0
    a, z = stretches(repeated & ~branching)
    z = z + window - 1
    d = [digest(b" ".join(words[i:j])) for i, j in zip(a, z, strict=True)]
    alone = np.flatnonzero(repeated & branching)
    second = Sequence(words, 1) if len(alone) else None
    ones = seq.hashes(alone, alone + window).view(np.int64) if len(alone) else []
    twos = second.hashes(alone, alone + window).view(np.int64) if len(alone) else []
    return [*a, *alone], [*(z - a), *[window] * len(alone)], [*(x[0] for x in d), *ones], [*(x[1] for x in d), *twos]


def pieces(marked: DataFrame, window: int) -> DataFrame:
    """(id, h, at, length, d1, d2) of the pieces of the documents that hold repeated nodes."""

    def run(batches):
        for b in bounded(batches, 2):
            row, cols = [], [[], [], [], []]
            for r, (text, marks) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                found = pieces_of(words_of(text), marks, window)
                row.append(np.full(len(found[0]), r))
                for c, x in zip(cols, found, strict=True):
                    c.append(np.array(x, np.int64))
            take = pa.array(np.concatenate(row) if row else np.zeros(0, np.int64))
            at, length, d1, d2 = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols)
            yield pa.record_batch([b.column(0).take(take), b.column(1).take(take), pa.array(at.astype(np.int32)), pa.array(length.astype(np.int32)), pa.array(d1), pa.array(d2)], ["id", "h", "at", "length", "d1", "d2"])

    return marked.mapInArrow(run, f"id {dict(marked.dtypes)['id']}, h long, at int, length int, d1 long, d2 long")


def sources(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, t): rows are told apart by id and text, so rows equal in both have one result."""
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("h"), F.coalesce(text_col, F.lit("")).alias("t"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, h, at, length, d1, d2, c): verified repeats, their first word and their words, the digest that names them and how often they occur.

    Paths are whole; windows with a branching node stand for themselves. Equal digests are the copies of one repeat.
    """
    own = sources(docs, id_col, text_col)
    at = scratch(docs.sparkSession)
    found = staged(nodes(own, window), f"{at}/nodes", compression="zstd")
    table = found.groupBy("node").agg(F.count("*").alias("c"), F.min("context").alias("x"), F.max("context").alias("y")).where("c > 1")
    table = staged(table.select("node", "c", (F.col("x") == F.col("y")).cast("int").alias("plain")), f"{at}/table")
    marks = joined_back(found.select("id", "h", "at", "node"), table, ["node"]).groupBy("id", "h").agg(F.collect_set(F.col("at") * 2 + F.col("plain")).alias("marks"))
    some = staged(pieces(with_marks(own, marks, "inner"), window), f"{at}/pieces", compression="zstd")
    discard(docs.sparkSession, f"{at}/nodes")
    copies = some.groupBy("d1", "d2").agg(F.count("*").alias("c")).where("c > 1")
    copies = staged(copies, f"{at}/copies")
    return joined_back(some, copies, ["d1", "d2"])


def rewritten(docs: DataFrame, schema: str, row: Callable[[list[bytes], np.ndarray], tuple], id_col: str, text_col: str, window: int) -> DataFrame:
    """Rows of ``schema`` that ``row`` makes of each document's words and of which of them a repeat covers."""
    own = sources(docs, id_col, text_col)
    span = F.struct(F.col("at").alias("a"), (F.col("at") + F.col("length")).alias("z"))
    spans = repeats(docs, id_col, text_col, window).groupBy("id", "h").agg(F.collect_set(span).alias("marks"))
    kind = dict(own.dtypes)["id"]
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        for b in bounded(batches, 2):
            out = []
            for text, marks in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                words = words_of(text)
                depth = np.zeros(len(words) + 1, np.int64)
                if marks:
                    np.add.at(depth, [m["a"] for m in marks], 1)
                    np.add.at(depth, [m["z"] for m in marks], -1)
                out.append(row(words, np.cumsum(depth[:-1]) > 0))
            yield pa.record_batch([b.column(0), *map(pa.array, zip(*out, strict=True))], ["id", *names])

    return with_marks(own, spans, "left").mapInArrow(run, f"id {kind}, {schema}").withColumnRenamed("id", id_col)


def kept_words(words: list[bytes], covered: np.ndarray) -> bytes:
    return b" ".join([w for w, c in zip(words, covered.tolist(), strict=True) if not c] if covered.any() else words)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_removed, kept_text): the words that no repeated window covers, joined by one space."""
    row = lambda words, covered: (len(words), int(covered.sum()), kept_words(words, covered).decode())
    return rewritten(docs, "n_words long, n_removed long, kept_text string", row, id_col, text_col, window)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every document."""
    row = lambda words, covered: (len(words), int(covered.sum()), hashlib.sha256(kept_words(words, covered)).hexdigest())
    return rewritten(docs, "n_words long, n_removed long, kept_sha256 string", row, id_col, text_col, window)

