"""Operator 7: threshold-scaled sketches of documents.

Every run of 16 code points is hashed to 32 bits, and all hashes below 1/16 of the range are kept
(with the smallest hash in any case, so that no text but the empty one has an empty sketch). Sketches
of parts merge by union, and as all documents keep the same part of the hashes, intersections estimate how
much of one text another contains even if their lengths differ greatly.

Defined results: null counts as empty; the empty text has the fingerprint ""; a text shorter than 16
code points is one shingle; equal texts have equal fingerprints; two empty sketches are alike (1), an empty and another aren't (0);
rows of equal ids follow each other by their texts; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_ranges

WIDTH, FRACTION = 16, 16


def sketch(text: str | None) -> np.ndarray:
    """Sorted distinct 32-bit hashes."""
    cp = np.frombuffer((text or "").encode("utf-32-le"), np.uint32).astype(np.uint64)
    if not len(cp):
        return np.zeros(0, np.uint32)
    h = (cp + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    if len(cp) < WIDTH:
        value = np.uint64(len(cp))
        for x in h.tolist():
            value = np.uint64((int(value) * 0xD6E8FEB86659FD93 + x) & 0xFFFFFFFFFFFFFFFF)
        h = np.array([value], np.uint64)
    else:
        span = 1
        while span < WIDTH:  # hashes of runs twice as long from two that lie side by side
            h = (h[:-span] * np.uint64(0xD6E8FEB86659FD93) + h[span:]) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
            span *= 2
    h = (h * np.uint64(0x94D049BB133111EB)) >> np.uint64(32)
    low = h[h < (1 << 32) // FRACTION]
    return np.unique(np.append(low, h.min())).astype(np.uint32)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of two texts' shingles together."""
    both = np.union1d(a, b)
    keep = both < (1 << 32) // FRACTION
    keep[:1] = True
    return both[keep]


def shared(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated part of a's shingles that b has."""
    return shared(a, b) / len(a) if len(a) else 1.0


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Twice the shared shingles over all shingles of both."""
    return 2 * shared(a, b) / (len(a) + len(b)) if len(a) or len(b) else 1.0


def text_of(a: np.ndarray) -> str:
    return a.astype(">u4").tobytes().hex()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(s), ">u4").astype(np.uint32)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row."""

    def run(batches):
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([text_of(sketch(t)) for t in b.column(1).to_pylist()], pa.string())], [id_col, "fingerprint"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last quarter of the code points gives way to as many from the start of the following text."""
    q = len(text) // 4
    return text[: len(text) - q] + following[:q]


def with_following(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(part, guest, id, text): id ranges, each ended by a guest, the first row of the next range (of the first for the last)."""
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = id_ranges(base.select("id", F.octet_length("text").alias("w")))
    n = max(1, len(ranges))
    heads = F.broadcast(ranges.heads(docs.sparkSession).select("head", F.pmod(F.col("part") - 1, F.lit(n)).alias("part")))
    guests = base.join(heads, F.col("id").eqNullSafe(F.col("head"))).groupBy("part", "id").agg(F.min("text").alias("text")).withColumn("guest", F.lit(True))
    base = base.withColumn("part", ranges.of("id"))
    both = base.withColumn("guest", F.lit(False)).unionByName(guests)
    return both.repartitionById(n, "part").sortWithinPartitions("part", "guest", "id", "text").select("part", "guest", "id", "text")


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document beside its edited text and the next document: see the contract of the query."""

    def run(batches):
        waiting = None
        for b in batches:
            out = []
            for part, guest, i, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own = sketch(text)
                if waiting and waiting[0] == part:
                    _, wi, wt, ws = waiting
                    e = edited(wt, text)
                    es = sketch(e)
                    out.append((wi, len(wt), hashlib.sha256(e.encode()).hexdigest(), text_of(ws), text_of(es), likeness(ws, es), likeness(ws, own)))
                waiting = None if guest else (part, i, text, own)
            cols = list(zip(*out, strict=True)) or [[]] * 7
            kinds = [b.column(2).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["i", "n", "e", "f", "g", "x", "y"])

    kind = dict(docs.dtypes)[id_col]
    return with_following(docs, id_col, text_col).mapInArrow(run, f"i {kind}, n long, e string, f string, g string, x double, y double").toDF(id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
