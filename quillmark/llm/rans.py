"""Operator 6: token ids as files of a static range asymmetric numeral system.

One table of frequencies, counted over all documents and scaled to 2**18, serves all blocks. A block
holds whole documents in id order. Its ids are dealt to interleaved lanes, which are encoded backwards by
64-bit states that give off 32-bit words; every 256 steps the states and the place in the words
are kept as a checkpoint from which a decoder can start, with a checksum of the words up to the next one, so parts of
a block are decoded and checked apart. A block's head:

    magic "QRB2", scale bits, lanes, tokens, steps, words, checkpoints, crc32 of the checkpoints
    checkpoints: word offset, crc32 of its words and the states of all lanes, as unsigned 64-bit numbers
    words: unsigned 32-bit numbers in the order in which a decoder reads them

Blocks are rows of a Parquet table (file, block, start, doc_ids, n_tokens, payload), beside a table of
frequencies, so Spark writes and commits them, and a block is decoded with nothing but the frequencies.

Defined results: a null or empty text has the end id alone; null ids come first; rows of equal ids are
ordered by their token ids; an empty table gives empty files; other columns aren't looked at.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import RANGE, bounded, discard, id_ranges, scratch, staged

SCALE, LANES, EVERY = 18, 1024, 256
#: Tokens of a block, but for a longer document, which is a block of its own.
BLOCK = 1 << 19
HEAD = struct.Struct("<4sHHQIIII")
LOW = np.uint64(1 << 31)


def scaled(counts: np.ndarray, bits: int = SCALE) -> np.ndarray:
    """Frequencies that sum to 2**bits, at least 1 wherever a count isn't 0."""
    total, size = int(counts.sum()), 1 << bits
    if np.count_nonzero(counts) > size // 2:
        raise ValueError("too many different ids for the scale")
    if not total:
        return np.zeros(len(counts), np.uint32)
    f = np.where(counts > 0, np.maximum(1, (counts.astype(np.float64) * (size / total)).astype(np.int64)), 0)
    over = int(f.sum()) - size
    for k in np.argsort(-f, kind="stable"):
        if over <= 0:
            f[k] -= over  # what is missing goes to the most frequent id
            break
        less = min(over, int(f[k]) // 2)
        f[k] -= less
        over -= less
    return f.astype(np.uint32)


class Table:
    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint16 if len(freq) <= 1 << 16 else np.uint32), freq)


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = EVERY) -> bytes:
    n = len(ids)
    lanes = max(1, min(lanes, n // 32))
    steps = -(-n // lanes)
    padded = np.full(steps * lanes, ids[-1] if n else 0, np.int64)
    padded[:n] = ids
    rows = padded.reshape(steps, lanes)
    x = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    given, marks = 0, []
    bits, top, half, mask = np.uint64(SCALE), np.uint64(63 - SCALE), np.uint64(32), np.uint64(0xFFFFFFFF)
    for t in range(steps - 1, -1, -1):
        f, c = table.freq[rows[t]], table.start[rows[t]]
        big = x >= f << top
        if big.any():
            out = x[big]
            words.append((out & mask).astype("<u4"))
            given += len(out)
            x[big] = out >> half
        q = x // f
        x = (q << bits) + (x - q * f) + c
        if t % every == 0:
            marks.append((given, x.copy()))
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
    starts = [given - done for done, _ in reversed(marks)]
    crcs = [zlib.crc32(stream[a:z]) for a, z in zip(starts, [*starts, given][1:], strict=True)]
    points = b"".join(np.concatenate([np.array([a, crc], np.uint64), state]).astype("<u8").tobytes() for a, crc, (_, state) in zip(starts, crcs, reversed(marks), strict=True))
    return HEAD.pack(b"QRB2", SCALE, lanes, n, steps, len(stream), len(marks), zlib.crc32(points)) + points + stream.tobytes()


def decode_block(payload: bytes, table: Table, every: int = EVERY, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of a block, or of its checkpoints ``first`` up to ``last`` only, whose words alone are read and checked."""
    magic, scale, lanes, n, steps, n_words, marks, crc = HEAD.unpack_from(payload)
    size = marks * (lanes + 2) * 8
    if magic != b"QRB2" or scale != SCALE or len(payload) != HEAD.size + size + 4 * n_words or zlib.crc32(memoryview(payload)[HEAD.size : HEAD.size + size]) != crc:
        raise ValueError("damaged block")
    points = np.frombuffer(payload, "<u8", marks * (lanes + 2), HEAD.size).reshape(marks, lanes + 2)
    words = np.frombuffer(payload, "<u4", n_words, HEAD.size + size)
    last = marks if last is None else min(last, marks)
    if first >= last:
        return np.zeros(0, np.uint32)
    edges = np.append(points[:, 0], n_words).astype(np.int64)
    if any(zlib.crc32(words[edges[k] : edges[k + 1]]) != int(points[k, 1]) for k in range(first, last)):
        raise ValueError("damaged block")
    at, x = int(edges[first]), points[first, 2:].astype(np.uint64)
    lo, hi = first * every, min(steps, last * every)
    out = np.empty((hi - lo, lanes), np.uint32)
    bits, half, mask = np.uint64(SCALE), np.uint64(32), np.uint64((1 << SCALE) - 1)
    for t in range(hi - lo):
        slot = x & mask
        s = table.symbol[slot]
        out[t] = s
        x = table.freq[s] * (x >> bits) + slot - table.start[s]
        low = x < LOW
        need = np.count_nonzero(low)
        if need:
            x[low] = (x[low] << half) | words[at : at + need]
            at += need
    return out.ravel()[: min(n, hi * lanes) - lo * lanes]


@functools.lru_cache(2)
def library(path: str):
    """The tokenizer and what it said of single slices; every distinct slice goes to it once."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    size = np.zeros(t.get_vocab_size(), np.int64)  # bytes of each token; its text has a letter for every byte
    for token, k in t.get_vocab().items():
        size[k] = len(token)

    def encoded(words: list[str], ends: np.ndarray, between: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of the words, and how many each has; None if a token spans two. Without ``between`` the words are handed over apart."""
        whole = [words] if between is None else [between.join(words) + between]
        ids = np.array(t.encode_batch_fast(whole, is_pretokenized=between is None, add_special_tokens=False)[0].ids, np.uint32)
        upto = np.cumsum(size[ids])
        at = np.searchsorted(upto, ends)
        if at[-1] >= len(upto) or (upto[at] != ends).any() or upto[-1] != ends[-1]:
            return None
        counts = np.diff(at, prepend=-1)
        if between:  # its token ends each word
            counts, ids = counts - 1, np.delete(ids, at)
        return ids, counts

    def encode(unseen: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # Texts of slices that the library cuts where they meet: words with the space before them, and words on lines
        # of their own. White space goes to it in separate parts.
        kinds: tuple[list, list, list] = ([], [], [])
        for k, x in enumerate(unseen):
            word = x.decode()
            kinds[0 if word[0] == " " and len(word) > 1 and not word[1].isspace() else 2 if word[0].isspace() else 1].append((k, word))
        every, counts, place = [], np.zeros(len(unseen), np.int64), []
        for some, between in zip(kinds, ("", "\n", None), strict=True):
            if not some:
                continue
            at, words = map(list, zip(*some, strict=True))
            ends = np.cumsum([len(unseen[k]) for k in at])
            got = encoded(words, ends + np.arange(1, len(at) + 1) * bool(between), between)
            got = got or encoded(words, ends, None)
            if got is None:
                raise ValueError("token ids don't cover the slices")
            every.append(got[0])
            counts[at] = got[1]
            place += at
        start = np.empty(len(unseen), np.int64)
        start[place] = np.cumsum(counts[place]) - counts[place]
        return np.concatenate(every)[bpe.spread(start, counts)], counts

    return bpe.Pieces(encode)


@functools.lru_cache(2)
def added_tokens(path: str) -> tuple[re.Pattern | None, dict[str, int]]:
    """Pattern of the added tokens of a tokenizer file, the longest first, and their ids."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f).get("added_tokens") or []
    if any(x.get(k) for x in found for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that take in white space or whole words only aren't known here")
    ids = {x["content"]: x["id"] for x in found}
    return (re.compile("|".join(re.escape(x) for x in sorted(ids, key=len, reverse=True))) if ids else None), ids


def tokenised(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str, added: bool = False) -> DataFrame:
    """(id, n, ids): the token ids with the end id, as unsigned 16-bit or else 32-bit numbers."""

    def split(texts: list[str], pattern: re.Pattern | None) -> tuple[list[str], list[list[str]]]:
        """Texts with those that hold added tokens cut at them, and each text's tokens."""
        parts, shape = [], []
        for x in texts:
            tokens = pattern.findall(x) if pattern else []
            parts += pattern.split(x) if tokens else [x]
            shape.append(tokens)
        return parts, shape

    def run(batches):
        pieces = library(path)
        pattern, special = added_tokens(path) if added else (None, {})
        for b in bounded(batches, 1):
            cut, shape = split([x or "" for x in b.column(1).to_pylist()], pattern)
            each = (ids[i:j] for _, _, ids, bounds in bpe.encoded(cut, pieces) for i, j in zip(bounds[:-1], bounds[1:], strict=True))
            data, size = [], []
            for tokens in shape:
                some = [next(each)]
                for token in tokens:
                    some += [[special[token]], next(each)]
                x = np.concatenate([*some, [end_id]]).astype("<u4")
                size.append(len(x))
                data.append((b"\2" + x.astype("<u2").tobytes()) if x.max() < 65536 else (b"\4" + x.tobytes()))
            yield pa.record_batch([b.column(0), pa.array(size, pa.int64()), pa.array(data, pa.binary())], ["id", "n", "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, n long, ids binary")


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2" if data[0] == 2 else "<u4", -1, 1)


def counts_of(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents; as many numbers as the vocabulary has."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            c = np.bincount(np.concatenate([unpacked(x) for x in b.column(0).to_pylist()] or [np.zeros(0, np.uint16)]))
            if len(c) > len(total):
                c, total = total, c.astype(np.int64)
            total[: len(c)] += c
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["token", "c"])

    rows = tokens.select("ids").mapInArrow(run, "token long, c long").groupBy("token").agg(F.sum("c").alias("c")).collect()
    out = np.zeros(1 + max((r["token"] for r in rows), default=0), np.int64)
    for r in rows:
        out[r["token"]] = r["c"]
    return out


def write(docs: DataFrame, path: str, to: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", added: bool = False) -> None:
    """Encode every whole text with the tokenizer file ``path`` and write blocks and frequencies under ``to``.

    With ``added``, added tokens in the texts get their ids, as the library does as loaded; else they are text like any other.
    """
    spark = docs.sparkSession
    at = scratch(spark)
    tokens = staged(tokenised(docs, path, end_id, id_col, text_col, added), f"{at}/tokens", compression="zstd")
    freq = scaled(counts_of(tokens))
    ranges = id_ranges(tokens.select("id", F.col("n").alias("w")), RANGE // 4)
    n_files, before = max(1, len(ranges)), ranges.before
    tokens = tokens.withColumn("file", ranges.of("id"))
    kind = dict(docs.dtypes)[id_col]
    arrow_id = tokens.select("id").schema
    from pyspark.sql.pandas.types import to_arrow_schema

    id_type = to_arrow_schema(arrow_id).field(0).type

    def run(batches):
        table = Table(freq)
        file, block, start, ids, ends, held = None, 0, 0, [], [], 0

        def flush():
            nonlocal block, start, ids, ends, held
            payload = encode_block(np.concatenate(ends), table)
            row = pa.record_batch([pa.array([file], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([[len(x) for x in ends]], pa.list_(pa.int64())), pa.array([payload], pa.binary())], ["file", "block", "start", "doc_ids", "n_tokens", "payload"])
            block, start, ids, ends, held = block + 1, start + held, [], [], 0
            return row

        for b in batches:
            for f, i, data in zip(*(b.column(c).to_pylist() for c in ("file", "id", "ids")), strict=True):
                x = unpacked(data)
                if ids and (f != file or held + len(x) > BLOCK):
                    yield flush()
                if f != file:
                    file, block, start = f, 0, int(before[f])
                ids.append(i)
                ends.append(x)
                held += len(x)
        if ids:
            yield flush()

    ordered = tokens.select("file", "id", "ids").repartitionById(n_files, "file").sortWithinPartitions("file", "id", "ids")
    ordered.mapInArrow(run, f"file int, block int, start long, doc_ids array<{kind}>, n_tokens array<long>, payload binary").write.option("compression", "none").parquet(f"{to}/blocks")
    spark.createDataFrame([(k, int(f)) for k, f in enumerate(freq) if f], "token int, freq int").coalesce(1).write.parquet(f"{to}/frequencies")
    discard(spark, at)


def part_of(payload: bytes, table: Table, a: int, z: int, every: int = EVERY) -> np.ndarray:
    """Ids ``a`` up to ``z`` of a block, from the checkpoints around them."""
    lanes = HEAD.unpack_from(payload)[2]
    first = a // (lanes * every)
    return decode_block(payload, table, every, first, -(-z // (lanes * every)))[a - first * lanes * every : z - first * lanes * every]


def read(spark: SparkSession, at: str, only: Column | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, from the files alone; blocks are decoded in parallel.

    ``only``: a condition on ``doc_id``; of blocks with few such documents only the parts that hold them are decoded.
    """
    if only is not None:
        return _chosen(spark, at, only)
    return _decoded(spark, at, lambda x: x.astype(np.uint32).view(np.int32).tolist(), pa.list_(pa.int32()), "ids array<int>")


def digests(spark: SparkSession, at: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    return _decoded(spark, at, lambda x: zlib.crc32(x.astype("<u4").tobytes()), pa.int64(), "ids_crc32 long")


def _chosen(spark: SparkSession, at: str, only: Column) -> DataFrame:
    freq = frequencies(spark, at)
    blocks = spark.read.parquet(f"{at}/blocks")
    kind = dict(blocks.dtypes)["doc_ids"][len("array<") : -1]
    # ids alone are exploded; a block's payload then comes once, beside the ids that are looked for in it
    wanted = blocks.select("file", "block", F.explode("doc_ids").alias("doc_id")).where(only).groupBy("file", "block").agg(F.collect_set("doc_id").alias("wanted"))
    rows = blocks.join(wanted, ["file", "block"]).select("wanted", "start", "doc_ids", "n_tokens", "payload")

    def run(batches):
        table = Table(freq)
        for b in batches:
            for k, (wanted, start, n, payload) in enumerate(zip(*(b.column(c).to_pylist() for c in ("wanted", "start", "n_tokens", "payload")), strict=True)):
                ids = b.column("doc_ids")[k].values
                upto = np.cumsum(n)
                at = np.flatnonzero(pc.is_in(ids, pa.array(wanted, ids.type)).to_numpy(zero_copy_only=False))
                each = [part_of(payload, table, int(upto[i] - n[i]), int(upto[i])).view(np.int32) for i in at]
                yield pa.record_batch(
                    [ids.take(pa.array(at)), pa.array(start + upto[at] - np.array(n)[at], pa.int64()), pa.array(np.array(n)[at], pa.int64()), pa.array(each, pa.list_(pa.int32()))],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids array<int>")


def frequencies(spark: SparkSession, at: str) -> np.ndarray:
    rows = spark.read.parquet(f"{at}/frequencies").collect()  # as many as the vocabulary has
    freq = np.zeros(1 + max((r["token"] for r in rows), default=0), np.uint32)
    for r in rows:
        freq[r["token"]] = r["freq"]
    return freq


def _decoded(spark: SparkSession, at: str, value, kind: pa.DataType, column: str) -> DataFrame:
    freq = frequencies(spark, at)
    blocks = spark.read.parquet(f"{at}/blocks").select("start", "doc_ids", "n_tokens", "payload")
    of = dict(blocks.dtypes)["doc_ids"][len("array<") : -1]

    def run(batches):
        table = Table(freq)
        for b in batches:
            for k, (start, n, payload) in enumerate(zip(*(b.column(c).to_pylist() for c in ("start", "n_tokens", "payload")), strict=True)):
                ids = decode_block(payload, table)
                ends = np.cumsum(n)
                if ends[-1] != len(ids):
                    raise ValueError("damaged block")
                each = [value(ids[e - m : e]) for e, m in zip(ends.tolist(), n, strict=True)]
                yield pa.record_batch([b.column("doc_ids")[k].values, pa.array(start + ends - n, pa.int64()), pa.array(n, pa.int64()), pa.array(each, kind)], ["doc_id", "start", "n_tokens", column.split()[0]])

    return blocks.mapInArrow(run, f"doc_id {of}, start long, n_tokens long, {column}")
