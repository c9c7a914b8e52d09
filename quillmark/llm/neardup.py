"""Operator 5: near-duplicate documents by MinHash and a multi-index Hamming join.

A document is the set of its 5-word shingles. Its signature has 256 MinHash values, cut to 16 bits
for the first 64 (those are indexed) and to 8 bits for the others (those only refine). The distance
of two signatures is the number of positions that differ. The 64 indexed positions are split into 16
chunks of 4. By pigeonhole, two signatures within distance 31 have a chunk with at most one error,
so each signature is entered 64 times: for every chunk, once without each of its positions. All
pairs within distance 31 meet under some entry; pairs of a Jaccard similarity of 0.75 are within it
but for a chance of 1.5e-5, as their distance is binomial with mean 16. What meets is confirmed on the
full shingle sets.

Only classes of documents with equal sets are compared. An entry's members are first compared with
the smallest of them. Rows that this leaves in other components than their smallest member are then
compared with all members, in pieces of bounded size that return no more links than join their
components, so neither step makes a row for each pair of a group. Components come from label
propagation on the confirmed links with Spark joins.

Defined results: null, empty and blank texts have no shingle and are linked with nothing; a text of
one to four words is one shingle; repeated rows share a set; a null id takes part under no name (its row keeps null
component_id unless equal to others' set); other columns aren't looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SALTS, discard, hot_join, scratch, staged

WORDS = 5
INDEXED, REFINING = 64, 192
CHUNK = 4
RADIUS = 31
#: Of all 256 positions: 64 + 4.9 standard deviations of the binomial at similarity 0.75.
WHOLE_RADIUS = 98
#: Most members of one group that stand on either side of a piece of work, and about as many shingles.
BLOCK, BLOCK_SHINGLES = 1024, 2_000_000
KEEP, OF = 75, 100
#: Bits that tell by a hash which ids are chosen, 64 in a row; so many rows are broadcast at most.
BITS = 1 << 24

_rng = np.random.default_rng(5)
_A = _rng.integers(1, 1 << 32, INDEXED + REFINING, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, INDEXED + REFINING, dtype=np.uint32)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; A-Z is lower-cased, words are cut at ASCII white space."""
    found = (text or "").encode().lower().split()
    n = len(found)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)
    m = max(1, n - words + 1)
    out = np.full(m, min(n, words), np.uint64)
    for k in range(min(n, words)):
        out = (out ^ h[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(found: np.ndarray) -> bytes:
    """64 numbers of 16 bits and 192 of 8; the minimum of each hash function over the set."""
    x = (found >> np.uint64(32)).astype(np.uint32) ^ found.astype(np.uint32)
    low = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    for a in range(0, len(x), 2048):
        part = x[a : a + 2048]
        low = np.minimum(low, (part[None, :] * _A[:, None] + _B[:, None]).min(1))
    low ^= low >> np.uint32(15)
    low *= np.uint32(0x2C1B3C6D)
    low ^= low >> np.uint32(12)
    return (low[:INDEXED] >> np.uint32(8)).astype("<u2").tobytes() + (low[INDEXED:] >> np.uint32(8)).astype(np.uint8).tobytes()


def sets_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n, s1, s2, sig): size, two 64-bit numbers that name the set, signature."""

    def run(batches):
        for b in batches:
            n, s1, s2, sig = [], [], [], []
            for text in b.column(1).to_pylist():
                found = shingles(text)
                name = xxhash.xxh3_128_digest(found.tobytes())
                n.append(len(found))
                s1.append(int.from_bytes(name[:8], "big", signed=True))
                s2.append(int.from_bytes(name[8:], "big", signed=True))
                sig.append(signature(found) if len(found) else None)
            yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(sig, pa.binary())], ["id", "n", "s1", "s2", "sig"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, f"id {kind}, n long, s1 long, s2 long, sig binary")


def entries(classes: DataFrame) -> DataFrame:
    """(key, id): 64 entries of each class. A key holds its number and three values of 16 bits, 54 bits in all."""

    def run(batches):
        for b in batches:
            sig = signatures(b.column("sig"))[:, :INDEXED].astype(np.uint64)
            keys = np.empty((len(sig), INDEXED), np.uint64)
            for slot in range(INDEXED):
                first = slot // CHUNK * CHUNK
                key = np.full(len(sig), slot, np.uint64)
                for p in range(first, first + CHUNK):
                    if p != slot:
                        key = key << np.uint64(16) | sig[:, p]
                keys[:, slot] = key
            yield pa.record_batch([b.column("id"), pa.ListArray.from_arrays(pa.array(np.arange(len(sig) + 1, dtype=np.int32) * INDEXED), pa.array(keys.ravel().view(np.int64)))], ["id", "keys"])

    kind = dict(classes.dtypes)["id"]
    return classes.select("id", "sig").mapInArrow(run, f"id {kind}, keys array<long>").select("id", F.explode("keys").alias("key"))


def signatures(column) -> np.ndarray:
    """All 256 values of each binary signature as 16-bit numbers."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), 2 * INDEXED + REFINING)
    return np.concatenate([raw[:, : 2 * INDEXED].copy().view("<u2"), raw[:, 2 * INDEXED :].astype(np.uint16)], axis=1)


def close(a: str, b: str):
    """Whether two signatures are within both radii."""

    @F.pandas_udf("boolean")
    def of(a, b):
        import pandas as pd

        x, y = signatures(pa.array(a, pa.binary())), signatures(pa.array(b, pa.binary()))
        return pd.Series(((x[:, :INDEXED] != y[:, :INDEXED]).sum(1) <= RADIUS) & ((x != y).sum(1) <= WHOLE_RADIUS))

    return of(a, b)


def like_sizes(a, b):
    """Needed for the similarity: the smaller set isn't too small."""
    return OF * F.least(a, b) >= KEEP * F.greatest(a, b)


def likely(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` (id, ...) whose id's bit is set by one of ``ids``: all rows of these ids and few others.

    So other texts aren't moved where there are too many ids to copy them to all tasks. The bits are of fixed number; ids beyond it only let more rows pass.
    """
    slot = F.pmod(F.xxhash64("id"), F.lit(BITS))
    word, bit = F.shiftright(slot, 6).alias("__w"), F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    bits = ids.select(word, bit.alias("__b")).groupBy("__w").agg(F.bit_or("__b").alias("__bits"))
    return docs.withColumn("__w", word).join(F.broadcast(bits), "__w").where(F.col("__bits").bitwiseAND(bit) != 0).drop("__w", "__bits")


def full_sets(ids: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, set): the sorted shingle hashes of the documents whose ids are given."""
    kind = dict(ids.dtypes)["id"]

    def run(batches):
        for b in batches:
            ends, flat = [0], []
            for t in b.column(1).to_pylist():
                flat.append(shingles(t))
                ends.append(ends[-1] + len(flat[-1]))
            values = np.concatenate(flat) if flat else np.zeros(0, np.uint64)
            yield pa.record_batch([b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))], ["id", "set"])

    texts = likely(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")), ids)
    texts = texts.join(ids.distinct(), "id").dropDuplicates(["id"])  # a semi join would be moved below the one with the bits
    return texts.mapInArrow(run, f"id {kind}, set array<long>")


def confirmed(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Pairs (a, b) whose full shingle sets are similar enough."""
    sets = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("id")), docs, id_col, text_col)
    both = hot_join(pairs, sets.select(F.col("id").alias("a"), F.col("set").alias("x")), ["a"], "b").join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")
    both = both.select("a", "b", F.size(F.array_intersect("x", "y")).cast("long").alias("i"), (F.size("x") + F.size("y")).cast("long").alias("s"))
    return both.where(OF * F.col("i") >= KEEP * (F.col("s") - F.col("i"))).select("a", "b")


def components(links: DataFrame, at: str) -> DataFrame:
    """(id, component) of every id that is linked: the smallest id that can be reached.

    Each round takes the smallest label among the neighbours and then the label of that label, so
    that a chain's length at least halves; labels are written out after each round.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    # the id on the other side decides where the rows of a hub go; labels are copied to all of these places
    salted = lambda df, by: df.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)))
    copied = lambda df: df.withColumn("salt", F.explode(F.array(*[F.lit(k).cast("long") for k in range(SALTS)])))
    both = staged(salted(both, "a"), f"{at}/links")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("l")), f"{at}/labels0")
    k = 0
    while True:
        k += 1
        seen = both.join(copied(labels.select(F.col("id").alias("b"), F.col("l").alias("lb"))), ["b", "salt"]).groupBy("a").agg(F.min("lb").alias("m"))
        # neighbours' smallest label, also handed to the label's own id (hooking)
        new = labels.join(seen, labels["id"] == seen["a"]).select("id", "l", F.least("l", "m").alias("n"))
        hooks = new.where("n < l").groupBy(F.col("l").alias("h")).agg(F.min("n").alias("hn"))
        new = new.join(hooks, new["id"] == hooks["h"], "left").select("id", "l", F.coalesce(F.least("n", "hn"), "n").alias("n"))
        jump = copied(new.select(F.col("id").alias("n"), F.col("n").alias("jn")))
        done = salted(new, "id").join(jump, ["n", "salt"], "left").select("id", F.coalesce(F.least("n", "jn"), "n").alias("l"), F.col("l").alias("old"))
        labels = staged(done, f"{at}/labels{k}")
        discard(labels.sparkSession, f"{at}/labels{k - 1}")
        if labels.where("l <> old").isEmpty():
            discard(labels.sparkSession, f"{at}/links")
            return labels.select("id", F.col("l").alias("component"))


def close_rows(i, now, mine, n, sig, right) -> np.ndarray:
    """Places in ``right`` of rows under other labels than ``mine`` whose sizes and signatures are close to row i's."""
    at = np.flatnonzero((now != mine) & (OF * np.minimum(n[i], n[right]) >= KEEP * np.maximum(n[i], n[right])))
    if len(at):
        at = at[(sig[right[at], :INDEXED] != sig[i, :INDEXED]).sum(1) <= RADIUS]
        at = at[(sig[right[at]] != sig[i]).sum(1) <= WHOLE_RADIUS]
    return at


def links_of(ids, n, label, sig, sets, left, right):
    """Confirmed links of the rows ``left`` to the rows ``right``, as many as join their labels.

    A row's close signatures under other labels are confirmed on the full sets, all in one search.
    """
    up: dict[int, int] = {}

    def root(x):
        while x in up:
            x = up[x]
        return x

    now = label[right].copy()
    for i in left:
        mine = root(int(label[i]))
        at = close_rows(i, now, mine, n, sig, right)
        if not len(at):
            continue
        own = sets[i]
        others = [sets[k] for k in right[at]]
        every = np.concatenate(others)
        place = np.minimum(np.searchsorted(own, every), len(own) - 1)
        both = np.add.reduceat((own[place] == every).astype(np.int64), np.concatenate([[0], np.cumsum([len(x) for x in others])[:-1]]))
        for k in at[OF * both >= KEEP * (n[i] + n[right[at]] - both)]:
            old, mine = root(int(now[k])), root(mine)
            if old != mine:
                yield ids[i], ids[right[k]]
                lost, mine = max(old, mine), min(old, mine)
                up[lost] = mine
                now[now == lost] = mine


def in_pieces(members: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on the members of each group, in pieces of bounded size.

    ``members``: low, id, n, label, home and more. ``home`` is the label of the group's smallest member. A pair
    under two labels has at least one row away from home, so those rows, in blocks, meet all rows, in
    blocks. ``work`` gets a piece's rows; ``first`` marks those that stand on the first side.
    """
    away = F.col("label") != F.col("home")
    size = lambda rows, shingles: F.greatest(F.lit(1), F.ceil(rows / BLOCK), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")
    sizes = members.groupBy("low").agg(
        size(F.count("*"), F.sum("n")).alias("qs"), size(F.count_if(away), F.sum(F.when(away, F.col("n")).otherwise(0))).alias("ps")
    )
    m = hot_join(members, sizes, ["low"], "id")
    cols = [c for c in members.columns if c != "home"]
    h = F.xxhash64("id")
    every = F.sequence(F.lit(0), F.col("ps") - 1), F.sequence(F.lit(0), F.col("qs") - 1)
    as_right = m.select(*cols, F.explode(every[0]).alias("p"), F.pmod(h, F.col("qs")).cast("int").alias("q"), F.lit(False).alias("first"))
    as_left = m.where(away).select(*cols, F.pmod(h, F.col("ps")).cast("int").alias("p"), F.explode(every[1]).alias("q"), F.lit(True).alias("first"))
    dealt = as_right.unionByName(as_left).repartition("low", "p", "q").sortWithinPartitions("low", "p", "q", "id", "first")

    def run(batches):
        kept, group = [], None
        for b in batches:
            k = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("low", "p", "q")], 1)
            cut = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1, [len(k)]]) if len(k) else [0]
            for a, z in zip(cut, cut[1:], strict=False):
                now = tuple(k[a].tolist())
                if now != group and kept:
                    yield from work(pa.Table.from_batches(kept))
                    kept = []
                group = now
                kept.append(b.slice(a, z - a))
        if kept:
            yield from work(pa.Table.from_batches(kept))

    return dealt.mapInArrow(run, schema)


def involved(members: DataFrame) -> DataFrame:
    """(low, id) of the members that are close to any member under another label, by sizes and signatures."""
    kind = dict(members.dtypes)["id"]

    def work(t: pa.Table):
        ids, n, label, first = (t.column(c).to_numpy() for c in ("id", "n", "label", "first"))
        sig = signatures(t.column("sig"))
        left, right = np.flatnonzero(first), np.flatnonzero(~first)
        hit = np.zeros(len(ids), bool)
        for i in left:
            at = close_rows(i, label[right], label[i], n, sig, right)
            if len(at):
                hit[i] = True
                hit[right[at]] = True
        out = np.unique(ids[hit])
        if len(out):
            yield pa.record_batch([pa.array(np.full(len(out), t.column("low")[0].as_py())), pa.array(out)], ["low", "id"])

    return in_pieces(members, work, f"low {kind}, id {kind}").distinct()


def across(members: DataFrame) -> DataFrame:
    """Confirmed links between members of one group whose labels differ. ``members`` hold their full sets."""
    kind = dict(members.dtypes)["id"]

    def work(t: pa.Table):
        ids, n, label, first = (t.column(c).to_numpy() for c in ("id", "n", "label", "first"))
        sets = [x.values.to_numpy().view(np.uint64) for c in t.column("set").chunks for x in c]
        out = list(links_of(ids, n, label, signatures(t.column("sig")), sets, np.flatnonzero(first), np.flatnonzero(~first)))
        if out:
            a, b = np.array([o[0] for o in out]), np.array([o[1] for o in out])
            yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return in_pieces(members, work, f"a {kind}, b {kind}").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row. Ids are integers, and rows of one id have one text."""
    spark = docs.sparkSession
    at = scratch(spark)
    sets = staged(sets_of(docs, id_col, text_col), f"{at}/sets")
    named = sets.where("n > 0 and id is not null")
    # classes of equal sets; their smallest id stands for them
    first = sets.where("n > 0").groupBy("s1", "s2").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    classes = staged(named.join(first.select("id"), "id", "left_semi").dropDuplicates(["id"]).select("id", "n", "sig"), f"{at}/classes")
    keys = entries(classes)
    shared = keys.groupBy("key").agg(F.min("id").alias("low"), F.count("*").alias("g")).where("g > 1").drop("g")
    # all entries with one smallest member make up a group: whoever shares an entry shares a group
    met = staged(keys.join(shared, "key").select("low", "id").distinct(), f"{at}/met")

    side = lambda x: classes.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"sig{x}"))
    stars = met.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b"))
    stars = hot_join(stars, side("a"), ["a"], "b").join(side("b"), "b").where(like_sizes(F.col("na"), F.col("nb"))).where(close("siga", "sigb")).select("a", "b")
    stars = staged(stars, f"{at}/candidates")
    links = staged(confirmed(stars, docs, id_col, text_col), f"{at}/stars")
    labels = components(links, f"{at}/first")

    # groups whose members aren't all in one component yet
    label = F.coalesce("component", "id").alias("label")
    told = staged(met.join(labels, "id", "left").select("low", "id", label), f"{at}/told")
    homes = told.groupBy("low").agg(F.max(F.when(F.col("id") == F.col("low"), F.col("label"))).alias("home"), F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("g")).where("x <> y and g > 2")
    members = staged(hot_join(told, homes.select("low", "home"), ["low"], "id").join(classes, "id"), f"{at}/members")
    near = staged(involved(members), f"{at}/near")
    members = members.join(near, ["low", "id"])
    more = staged(across(members.join(full_sets(near.select("id"), docs, id_col, text_col), "id")), f"{at}/more")
    labels = components(links.union(more), f"{at}/second")

    # rows find their own label; rows of a set that others have find that of the set's smallest id, in several places each
    others = first.where("copies > 1").join(labels, "id", "left").select("s1", "s2", F.coalesce("component", "id").alias("of_set"))
    others = others.withColumn("salt", F.explode(F.array(*[F.lit(k).cast("long") for k in range(SALTS)])))
    out = sets.where("n > 0").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS))).join(others, ["s1", "s2", "salt"], "left").join(labels, "id", "left")
    out = out.select("id", "n", F.coalesce("of_set", "component", "id").alias("c")).unionByName(sets.where("n = 0").select("id", "n", F.col("id").alias("c")))
    out = out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("c").alias("component_id"))
    for done in ("met", "classes", "candidates", "stars", "told", "members", "near", "more"):
        discard(spark, f"{at}/{done}")
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
