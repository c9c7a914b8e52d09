"""Operator 4: mixing sources to target weights by a temperature.

Token shares p of the sources are raised to an exponent a and normalised. Entropy falls as the exponent grows, and
repetitions grow on both sides of 1, so the exponents that meet the target entropy (a part of the logarithm of the number
of sources) and those that keep the repetitions under a limit are intervals; their ends are found by bisection, and the smallest exponent in
both is taken. So a limit on repetitions is always kept: it may leave the mixture less even than the target, and a target that it rules out from
the other side is an error that names what can be reached. A source's part of the token budget
then is drawn as keyed permutations of its documents: whole passes over the source, and one last
pass that ends where the budget does. The cut of the last pass is found from sums of blocks of the
permutation and one look into the block that holds it, so it is a single number for each source, and
choosing documents needs no shuffle of them.

Defined results: words are tokens unless a column of counts is given (null text or count: none); a null source is a source of its own; sources
without any token keep one copy of each document; rows with equal ids are drawn together; an empty
table gives an empty result; a budget of 0 draws nothing, a negative one is an error; other columns pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, scratch, staged

#: Intervals that one job narrows the exponent by, and the number of such jobs.
SECTIONS, NARROWINGS = 256, 4
MAX_EXPONENT = 64.0
#: Most sources whose plan is broadcast; beyond that Spark joins it by shuffling.
BROADCAST_SOURCES = 20_000


@dataclass(frozen=True)
class Mix:
    target_entropy: float | None = None
    max_repeats: float | None = None
    budget_tokens: float | None = None  # None: the smallest budget that draws every document
    only_flatten: bool = False  # sources that are more even than the target stay as they are
    seed: int = 17


def n_tokens(text: Column) -> Column:
    return F.when(F.trim(text) == "", 0).otherwise(F.coalesce(F.size(F.split(F.trim(text), r"\s+")), F.lit(0))).cast("long")


def place(seed: int, turn: Column | int, *cols: Column) -> Column:
    """Where a document stands in a permutation of its source: a number in [0, 1)."""
    turn = F.lit(turn) if isinstance(turn, int) else turn
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), turn, *cols), 11) / float(1 << 53)


def weights_at(a: float, share: Column) -> Column:
    return F.pow(share, F.lit(a))


def exponent(sources: DataFrame, mix: Mix) -> float:
    """Smallest exponent that obeys both limits; 1 if there are none. ``sources``: share, tokens.

    Each job reads sums over all sources for a row of exponents, so one number of each comes back.
    """
    if mix.budget_tokens is not None and mix.budget_tokens < 0:
        raise ValueError("a budget can't be negative")
    if mix.target_entropy is None and mix.max_repeats is None:
        return 1.0
    r = sources.agg(F.count("*").alias("n"), F.min("share").alias("lo"), F.max("share").alias("hi"), F.sum("tokens").alias("total")).first()
    n = r["n"]
    need = 1.0 if mix.budget_tokens is None else mix.budget_tokens / max(1, r["total"] or 0)
    if mix.max_repeats is not None and need > mix.max_repeats + 1e-12:
        raise ValueError(f"the budget repeats the sources {need:.6g} times as a whole, the limit is {mix.max_repeats:.6g}")
    if n < 2:
        return 1.0

    def figures(tries: list[float]) -> list[tuple[float, float]]:
        """(entropy as a part of the largest, repetitions) at each exponent."""
        each = sources.select("share", F.posexplode(F.array(*map(F.lit, tries))).alias("k", "a"))
        p = F.pow("share", "a")
        sums = each.groupBy("k").agg(F.sum(p).alias("z"), F.sum(p * F.log("share") * F.col("a")).alias("l")).sort("k").collect()  # as many rows as tries
        out = []
        for a, s in zip(tries, sums, strict=True):
            z = s["z"]
            # largest and smallest ratio of weight to share are those of the smallest and the largest share
            ratios = [r[c] ** (a - 1) / z for c in ("lo", "hi")]
            out.append(((math.log(z) - s["l"] / z) / math.log(n), max(ratios) / min(ratios) if mix.budget_tokens is None else max(ratios) * need))
        return out

    def edge(low: float, high: float, inside) -> float:
        """Where ``inside`` turns true between ``low``, where it is false, and ``high``, on the true side; either may be the larger."""
        for _ in range(NARROWINGS):
            tries = [low + (high - low) * k / SECTIONS for k in range(SECTIONS + 1)]
            first = next((k for k, f in enumerate(figures(tries)) if inside(*f)), SECTIONS)
            low, high = tries[max(0, first - 1)], tries[first]
        return high

    even = lambda e, _: e <= mix.target_entropy + 1e-12
    few = lambda _, t: t <= mix.max_repeats + 1e-12
    (flat, own, sharp) = figures([0.0, 1.0, MAX_EXPONENT])
    least, most = 0.0, MAX_EXPONENT
    if mix.max_repeats is not None:
        least = 0.0 if few(*flat) else edge(0.0, 1.0, few)
        most = MAX_EXPONENT if few(*sharp) else edge(MAX_EXPONENT, 1.0, few)
    if mix.target_entropy is None:
        return min(least, 1.0)
    if mix.only_flatten and own[0] > mix.target_entropy:
        return 1.0
    if even(*figures([least])[0]):
        return least
    reached = figures([most])[0]
    if not even(*reached):
        raise ValueError(f"an entropy of {mix.target_entropy:.6g} can't be met: under these limits it is {reached[0]:.6g} at least, with {reached[1]:.6g} repetitions at the exponent {most:.6g}")
    return edge(least, most, even)


def plan(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", tokens: Column | None = None) -> DataFrame:
    """(source, tokens, share, weight, passes, cut): documents whose place in the last pass is at most ``cut`` are in it."""
    spark = docs.sparkSession
    at = scratch(spark)
    key = F.struct(F.col(source_col), F.col(id_col))
    narrow = docs.select(F.col(source_col).alias("source"), F.coalesce((n_tokens(F.col(text_col)) if tokens is None else tokens).cast("long"), F.lit(0)).alias("n"), place(mix.seed, -1, key).alias("u"))
    narrow = staged(narrow, f"{at}/narrow")
    sources = narrow.groupBy("source").agg(F.sum("n").alias("tokens"), F.count("*").alias("docs"))
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    sources = staged(sources.withColumn("share", F.when(F.col("tokens") > 0, F.col("tokens") / F.lit(float(max(total, 1))))), f"{at}/sources")
    with_tokens = sources.where("tokens > 0")
    a = exponent(with_tokens, mix)
    r = with_tokens.agg(F.sum(weights_at(a, F.col("share"))).alias("z"), F.min(weights_at(a - 1, F.col("share"))).alias("least")).first()
    z = r["z"] or 1.0
    # every source gets at least one pass if the budget is total / (least weight to share)
    budget = mix.budget_tokens if mix.budget_tokens is not None else total * z / (r["least"] or 1.0) * (1 + 1e-12)
    want = F.col("weight") * float(budget)
    sources = sources.withColumn("weight", F.when(F.col("tokens") > 0, weights_at(a, F.col("share")) / z)).withColumn("passes", F.when(F.col("tokens") > 0, F.floor(want / F.col("tokens"))).otherwise(1).cast("long"))
    sources = sources.withColumn("rest", F.coalesce(want - F.col("passes") * F.col("tokens"), F.lit(0.0))).withColumn("blocks", F.ceil(F.sqrt("docs")))
    # blocks of the last pass: their sums, then the block that the budget ends in
    joined = narrow.join(sources, narrow["source"].eqNullSafe(sources["source"])).select(sources["source"], "n", "u", F.floor(F.col("u") * F.col("blocks")).alias("block"), "rest")
    sums = joined.groupBy("source", "block").agg(F.sum("n").alias("n"), F.first("rest").alias("rest"))
    upto = sums.withColumn("upto", F.sum("n").over(W.partitionBy("source").orderBy("block")))
    ends = upto.where("upto > rest").groupBy("source").agg(F.min_by(F.struct("block", (F.col("upto") - F.col("n")).alias("before")), "block").alias("e")).select(F.col("source").alias("s"), "e.*")
    inside = joined.join(ends, joined["source"].eqNullSafe(F.col("s")) & (joined["block"] == ends["block"])).select("source", "n", "u", "rest", "before")
    run = F.col("before") + F.sum("n").over(W.partitionBy("source").orderBy("u").rangeBetween(W.unboundedPreceding, 0))
    # the largest place whose running sum fits; nothing of this block fits: the block's start
    inside = inside.withColumn("fits", run <= F.col("rest")).groupBy("source").agg(F.max(F.when(F.col("fits"), F.col("u"))).alias("u")).select(F.col("source").alias("s2"), "u")
    out = sources.join(ends, sources["source"].eqNullSafe(F.col("s")), "left").join(inside, sources["source"].eqNullSafe(F.col("s2")), "left")
    start = F.col("block") / F.col("blocks") - 1e-15
    cut = F.when(F.col("block").isNull(), 1.0).otherwise(F.coalesce("u", start))
    cut = F.when(F.col("rest") <= 0, -1.0).otherwise(cut)
    out = staged(out.select("source", "tokens", "docs", "share", "weight", "passes", "rest", cut.alias("cut")), f"{at}/plan")
    for done in ("narrow", "sources"):
        discard(spark, f"{at}/{done}")
    return out


def mixed(
    docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", tokens: Column | None = None, weight_col: str = "mix_weight", at_col: str = "mix_at"
) -> DataFrame:
    """``docs`` with ``mix_weight`` (of the source) and ``mix_at``: a place in [0, 1] for each copy that is drawn.

    ``tokens``: the documents' token counts, if they are to be other than words.
    Sorted by these places, every stretch of the copies holds the sources in their weights.
    """
    chosen = plan(docs, mix, id_col, text_col, source_col, tokens)
    n = chosen.count()
    names = {c: f"__mix_{c}" for c in chosen.columns}
    p = chosen.select([F.col(c).alias(v) for c, v in names.items()])
    p = F.broadcast(p) if n <= BROADCAST_SOURCES else p
    out = docs.join(p, F.col(source_col).eqNullSafe(F.col(names["source"])), "left")
    key = F.struct(F.col(source_col), F.col(id_col))
    passes, tokens, rest = (F.col(names[c]) for c in ("passes", "tokens", "rest"))
    drawn = tokens * passes + F.greatest(rest, F.lit(0.0))
    whole = F.when(passes > 0, F.transform(F.sequence(F.lit(0), (passes - 1).cast("int")), lambda e: (e + place(mix.seed, e, key)) * tokens / drawn)).otherwise(F.array().cast("array<double>"))
    whole = F.when(tokens > 0, whole).otherwise(F.array(place(mix.seed, 0, key)))
    last = place(mix.seed, -1, key)
    partly = F.when((tokens > 0) & (last <= F.col(names["cut"])), F.array((passes * tokens + F.least(last / F.greatest(F.col(names["cut"]), F.lit(1e-12)), F.lit(1.0)) * rest) / drawn)).otherwise(F.array().cast("array<double>"))
    return out.withColumns({weight_col: F.col(names["weight"]), at_col: F.concat(whole, partly)}).drop(*names.values())
