"""Operator 8: approximate nearest neighbours by multi-index hashing.

A rotation is learned on a bounded sample so that the signs of rotated vectors lose little (iterative
quantisation). The 64 signs are a code; it is split into 8 substrings of 8 bits and every shard of the data
has an index of each. By pigeonhole, a code within Hamming distance r = 8 k + a of the query's has at most k errors in one
of the first a + 1 substrings or at most k - 1 in one of the others, so probing those buckets finds every
code within r. What is found is ranked by inner products of the original vectors in double precision.

The radius belongs to the query and is found once: its 20th best score in the sample bounds the angle of better ones, and
the binomial spread of the distances at that angle, with a margin set on the sample, gives r. A query for which too little
lies within it searches once more with the radius that takes in all codes.

Vectors of one shard make up an index, queries stream past it, and the best of all shards are merged.
Equal vectors are indexed once, with the smallest ids that a result can need.

Defined results: vectors that are null, zero, or hold null or non-finite numbers take no part, nor do those of
another length than the most frequent; equal scores go to the smaller id; repeated rows of one id are one candidate, and of several vectors of one id the best counts; a null id takes no part;
fewer candidates than asked for are all given; other columns aren't looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import parts, scratch, staged

BITS, SUB = 64, 8
#: Most vectors that the rotation and the margins are learned on; every vector is indexed.
SAMPLE = 20_000
#: Vectors of one shard.
SHARD = 20_000
#: Part of the neighbours in the sample that the margin must cover.
COVER = 0.985
_POP = np.array([x.bit_count() for x in range(256)], np.uint8)


@dataclass(frozen=True)
class Coder:
    ids: np.ndarray  # of the sample
    sample: np.ndarray
    longest: float  # norm of the longest vector
    rotation: np.ndarray
    margin: float

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Signs of rotated vectors, lifted to one length so that the inner product orders like the angle."""
        lift = np.sqrt(np.maximum(0, self.longest**2 - (x * x).sum(1, dtype=np.float64)))
        return self.query_codes(np.concatenate([x, lift[:, None]], 1))

    def query_codes(self, x: np.ndarray) -> np.ndarray:
        if x.shape[1] < self.rotation.shape[0]:
            x = np.concatenate([x, np.zeros((len(x), 1))], 1)
        return np.packbits(x @ self.rotation > 0, axis=1)

    def radius(self, x: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
        scores = x @ self.sample.T
        scores[ids[:, None] == self.ids[None, :]] = -np.inf
        if scores.shape[1] <= k + 1:
            return np.full(len(x), BITS)
        worst = -np.partition(-scores, k, axis=1)[:, k]
        return bound(worst, np.linalg.norm(x, axis=1) * self.longest, self.margin)


def bound(score: np.ndarray, length: np.ndarray, margin: float) -> np.ndarray:
    p = np.arccos(np.clip(score / length, -1, 1)) / math.pi
    return np.clip(np.ceil(BITS * p + margin * np.sqrt(BITS * p * (1 - p))), 0, BITS).astype(np.int64)


def rotation_of(x: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Columns that map vectors to ``BITS`` numbers: principal axes turned towards the corners of the cube."""
    rng = np.random.default_rng(8)
    d, blocks = x.shape[1], []
    while sum(b.shape[1] for b in blocks) < BITS:
        n = min(d, BITS)
        values, axes = np.linalg.eigh(x.T @ x)
        axes = axes[:, ::-1][:, :n]
        v = x @ axes
        r = np.linalg.qr(rng.normal(size=(n, n)))[0]
        for _ in range(rounds):
            a, _, b = np.linalg.svd(np.sign(v @ r).T @ v)
            r = (a @ b).T
        blocks.append(axes @ r)
    return np.concatenate(blocks, 1)[:, :BITS]


def fit(ids: np.ndarray, sample: np.ndarray, longest: float, k: int) -> Coder:
    lift = np.sqrt(np.maximum(0, longest**2 - (sample * sample).sum(1)))
    coder = Coder(ids, sample, longest, rotation_of(np.concatenate([sample, lift[:, None]], 1)), 0.0)
    if len(sample) <= 2 * k + 2:
        return coder
    q = np.arange(0, len(sample), max(1, len(sample) // 400))
    scores = sample[q] @ sample.T
    scores[np.arange(len(q)), q] = -np.inf
    best = np.argpartition(-scores, k, axis=1)[:, : k + 1]
    worst = np.take_along_axis(scores, best, 1).min(1)
    p = np.arccos(np.clip(worst / (np.linalg.norm(sample[q], axis=1) * longest), -1, 1)) / math.pi
    far = _POP[coder.query_codes(sample[q])[:, None, :] ^ coder.codes(sample)[best]].sum(2)
    over = (far - (BITS * p)[:, None]) / np.sqrt(np.maximum(BITS * p * (1 - p), 1e-9))[:, None]
    return Coder(ids, sample, longest, coder.rotation, float(np.quantile(over, COVER)))


class Index:
    def __init__(self, coder: Coder, vectors: np.ndarray):
        self.codes = coder.codes(vectors)
        self.order = [np.argsort(self.codes[:, j], kind="stable") for j in range(self.codes.shape[1])]
        self.counts = [np.bincount(self.codes[:, j], minlength=256) for j in range(self.codes.shape[1])]

    def within(self, code: np.ndarray, r: int) -> np.ndarray:
        """Places of all codes within Hamming distance ``r``."""
        k, a = divmod(int(r), BITS // SUB)
        seen = np.zeros(len(self.codes), bool)
        for j, value in enumerate(code):
            errors = k if j <= a else k - 1
            if errors >= 0:
                near = _POP[np.arange(256, dtype=np.uint8) ^ value] <= errors
                seen[self.order[j][np.repeat(near, self.counts[j])]] = True
        at = np.flatnonzero(seen)
        return at[_POP[self.codes[at] ^ code].sum(1, dtype=np.int64) <= r]


def usable(vector: Column, n: int) -> Column:
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vector) == n) & F.forall(vector, number) & F.exists(vector, lambda x: x != 0), F.lit(False))


def neighbours(table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest that are found for each row that ``is_query`` picks."""
    spark = table.sparkSession
    at = scratch(spark)
    kind = dict(table.dtypes)[id_col]
    vector = F.col(vector_col) if dict(table.dtypes)[vector_col] in ("array<float>", "array<double>") else F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).alias("id"), vector.alias("v"), is_query.alias("is_query")).where("id is not null and v is not null and size(v) > 0")
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    out = f"query_id {kind}, rank int, {id_col} {kind}, score double"
    if lengths is None:
        return spark.createDataFrame([], out)
    rows = rows.where(usable(F.col("v"), lengths["n"]))
    # equal vectors once, with the smallest ids: a query needs k of them besides its own
    few = rows.select("id", "v").distinct().withColumn("r", F.row_number().over(W.partitionBy("v").orderBy("id"))).where(f"r <= {k + 1}")
    classes = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = staged(classes.select(F.element_at("ids", 1).alias("id"), "v", "ids"), f"{at}/classes")
    stats = classes.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("m")).first()
    if not stats["n"]:
        return spark.createDataFrame([], out)
    sample = classes.select("id", "v").orderBy(F.xxhash64("id")).limit(SAMPLE).toPandas()  # bounded by SAMPLE
    coder = fit(sample["id"].to_numpy(), np.stack(sample["v"].to_list()).astype(np.float64), math.sqrt(stats["m"]), k)

    shards = max(1, math.ceil(stats["n"] / SHARD))
    vectors = dict(rows.dtypes)["v"]

    def radii(batches):
        for b in batches:
            x = b.column("v").flatten().to_numpy().reshape(b.num_rows, -1).astype(np.float64)
            ids = b.column("id").to_numpy()
            r = [coder.radius(x[c : c + 256], ids[c : c + 256], k) for c in range(0, len(x), 256)]
            yield pa.record_batch([b.column("id"), b.column("v"), pa.array(np.concatenate(r) if r else [], pa.int32())], ["id", "v", "r"])

    queries = staged(rows.where("is_query").select("id", "v").distinct().mapInArrow(radii, f"id {kind}, v {vectors}, r int"), f"{at}/queries")
    bare = replace(coder, ids=coder.ids[:0], sample=coder.sample[:0])  # shards need no sample

    def search(queries: DataFrame) -> DataFrame:
        data = classes.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("role"), "id", "v", "ids", F.lit(0).alias("r"))
        dealt = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("role"), "id", "v", F.lit(None).cast(f"array<{kind}>").alias("ids"), "r")
        both = data.unionByName(dealt).repartitionById(shards, "shard").sortWithinPartitions("shard", "role", "id")
        return both.mapInArrow(run, f"query_id {kind}, id {kind}, score double")

    def run(batches):
        shard, held, index = None, [], None
        vectors = ids = None
        for b in batches:
            marks = b.column("shard").to_numpy() * 2 + b.column("role").to_numpy()
            cut = np.concatenate([[0], np.flatnonzero(np.diff(marks)) + 1, [len(marks)]]) if len(marks) else [0]
            for a, z in zip(cut, cut[1:], strict=False):
                part, (now, role) = b.slice(a, z - a), divmod(int(marks[a]), 2)
                if now != shard:
                    shard, held, index = now, [], None
                x = part.column("v").flatten().to_numpy().reshape(z - a, -1).astype(np.float64)
                if role == 0:
                    held.append((x, part.column("ids").to_pylist()))
                    continue
                if not held and index is None:
                    continue
                if index is None:
                    vectors = np.concatenate([h[0] for h in held])
                    ids = [i for h in held for i in h[1]]
                    held, index = [], Index(bare, vectors)
                r = part.column("r").to_numpy()
                for c in range(0, z - a, 256):
                    yield answered(part.column("id").to_numpy()[c : c + 256], x[c : c + 256], r[c : c + 256], index, vectors, ids)

    def answered(own, x, radii, index, vectors, ids):
        found = []
        for q, v, code, r in zip(own.tolist(), x, bare.query_codes(x), radii.tolist(), strict=True):
            at = index.within(code, r)
            score = vectors[at] @ v
            if len(at) > k + 1:
                # equal scores at the border all stay
                keep = score >= -np.partition(-score, k)[k]
                at, score = at[keep], score[keep]
            pairs = sorted((-s, i) for s, p in zip(score.tolist(), at.tolist(), strict=True) for i in ids[p] if i != q)[:k]
            found += [(q, i, -s) for s, i in pairs]
        cols = list(zip(*found, strict=True)) or [[], [], []]
        return pa.record_batch([pa.array(cols[0], b_type), pa.array(cols[1], b_type), pa.array(cols[2], pa.float64())], ["query_id", "id", "score"])

    from pyspark.sql.pandas.types import to_arrow_schema

    b_type = to_arrow_schema(classes.select("id").schema).field(0).type
    def ranked(found: DataFrame) -> DataFrame:
        # one dealing by query does for both steps
        best = found.repartition("query_id").groupBy("query_id", "id").agg(F.max("score").alias("score"))
        return best.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))).where(f"rank <= {k}")

    first = staged(ranked(search(queries)), f"{at}/first")
    enough = min(k, rows.select("id").distinct().count() - 1)
    full = first.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("c")).where(F.col("c") >= enough)
    short = staged(queries.join(full, "id", "left_anti").withColumn("r", F.lit(BITS)), f"{at}/short")
    out = first
    if not short.isEmpty():
        again = ranked(search(short))
        out = first.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(again)
    return out.select("query_id", "rank", F.col("id").alias(id_col), "score")
