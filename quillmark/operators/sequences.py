"""Operators over ordered sequences: carried context, epochs, runs, groups, gaps, first positions and labels.

All of them are windows within the caller's partition columns; nothing is ordered over the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import letters
from ..sources.stages import staged


def upto(part: list[str], order: list[str]):
    return W.partitionBy(*part).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)


def before(part: list[str], order: list[str]):
    return W.partitionBy(*part).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)


def after(part: list[str], order: list[str]):
    """Rows behind a row, the nearest last: an order from the end needs one running value, a frame up to the end would be read anew for each row."""
    return W.partitionBy(*part).orderBy(*[F.desc(c) for c in order]).rowsBetween(W.unboundedPreceding, -1)


def carry_forward(df: DataFrame, values: dict[str, Column], part: list[str], order: list[str]) -> DataFrame:
    """Each value holds until the next one that isn't null."""
    w = upto(part, order)
    return df.withColumns({k: F.last(v, ignorenulls=True).over(w) for k, v in values.items()})


def epochs(df: DataFrame, change: Column, part: list[str], order: list[str], name: str = "epoch") -> DataFrame:
    """Number of changes so far; a part of the partition for whatever a change resets."""
    return df.withColumn(name, F.sum(F.when(change, 1).otherwise(0)).over(upto(part, order)))


def runs(df: DataFrame, cols: list[str], part: list[str], order: list[str], name: str = "run") -> DataFrame:
    """Numbers stretches of equal values (null equals null)."""
    w = W.partitionBy(*part).orderBy(*order)
    same = F.lit(True)
    for c in cols:
        same &= F.col(c).eqNullSafe(F.lag(c).over(w))
    first = F.row_number().over(w) == 1
    return df.withColumn("__change", F.when(first | ~same, 1).otherwise(0)).withColumn(name, F.sum("__change").over(upto(part, order))).drop("__change")


def last_per_page(df: DataFrame, value: Column, page: list[str], order: str, name: str) -> DataFrame:
    """(page, value): the last value of each page that isn't null."""
    return df.withColumn("__v", value).groupBy(*page).agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.col(order))).alias(name))


def segments(df: DataFrame, header: Column, terminator: Column, part: list[str], order: list[str]) -> DataFrame:
    """``segment``: headers so far and terminators on earlier rows; ``closed``: the segment ends in a terminator."""
    b, u = before(part, order), upto(part, order)
    n = F.sum(F.when(header, 1).otherwise(0)).over(u) + F.coalesce(F.sum(F.when(terminator, 1).otherwise(0)).over(b), F.lit(0))
    out = df.withColumn("segment", n)
    return out.withColumn("closed", F.max(F.when(terminator & ~header, 1).otherwise(0)).over(W.partitionBy(*part, "segment")) == 1)


def excluded_spans(df: DataFrame, opens: Column, closes: Column, part: list[str], order: list[str]) -> DataFrame:
    """``excluded``: from a row that opens a span to the row that closes it; both count."""
    event = F.when(opens, 1).when(closes, 0)
    now = F.last(event, ignorenulls=True).over(upto(part, order))
    was = F.last(event, ignorenulls=True).over(before(part, order))
    return df.withColumn("excluded", F.coalesce((now == 1) | (closes & (was == 1)), F.lit(False)))


def wrapped_parts(df: DataFrame, indent: Column, part: list[str], order: list[str], most: int | None = None) -> DataFrame:
    """``part_no``: a line that is indented deeper than all part starts so far continues the part before it."""
    df = df.withColumn("__i", indent)
    new = F.col("__i") <= F.min("__i").over(before(part, order))
    out = df.withColumn("__n", F.when(F.coalesce(new, F.lit(True)), 1).otherwise(0)).withColumn("part_no", F.sum("__n").over(upto(part, order)))
    if most:
        out = out.where(F.coalesce(F.lag("part_no").over(W.partitionBy(*part).orderBy(*order)) < most, F.lit(True)))
    return out.drop("__i", "__n")


def positions(df: DataFrame, part: list[str], order: list, name: str = "position") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*part).orderBy(*order)))


def groups_of(df: DataFrame, chosen: Column, same: list[str], part: list[str], order: list[str], name: str = "group_no") -> DataFrame:
    """Chosen rows, numbered so that any other row or a change of ``same`` between two of them splits."""
    flagged = runs(df.withColumn("__c", chosen), ["__c", *same], part, order, "__run").where("__c")
    w = W.partitionBy(*part).orderBy("__run")
    return flagged.withColumn(name, F.dense_rank().over(w)).drop("__c", "__run")


def neighbours(df: DataFrame, anchor: Column, part: list[str], order: list[str]) -> DataFrame:
    """``previous_anchor`` and ``next_anchor``: the nearest anchors around each row, itself left out."""
    return df.withColumns({"previous_anchor": F.last(anchor, ignorenulls=True).over(before(part, order)), "next_anchor": F.last(anchor, ignorenulls=True).over(after(part, order))})


def first_positions(df: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """(keys, position): the smallest position of each group."""
    return df.groupBy(*keys).agg(F.min(F.struct(*position)).alias("p")).select(*keys, "p.*")


def distinct_in_order(df: DataFrame, scope: list[str], keys: list[str], position: list[str], name: str = "rank") -> DataFrame:
    """Distinct keys of each scope, ranked by where they come first."""
    first = first_positions(df, [*scope, *keys], position)
    return positions(first, scope, [*position, *keys], name)


def previous_in_run(df: DataFrame, value: Column, same: list[str], part: list[str], order: list[str], name: str) -> DataFrame:
    """Latest value before the row within the stretch of equal ``same``."""
    out = runs(df, same, part, order, "__run")
    return out.withColumn(name, F.last(value, ignorenulls=True).over(before([*part, "__run"], order))).drop("__run")


def next_existing(ranked: DataFrame, existing: DataFrame, scope: list[str], key: str, rank: str = "rank", stop: list[str] | None = None) -> DataFrame:
    """``next_key``: the first later key of the scope that exists in the other version.

    ``stop``: columns whose change ends the search.
    """
    flagged = ranked.join(existing.select(*{*scope, key} & {*existing.columns}).distinct().withColumn("__e", F.lit(True)), [c for c in (*scope, key) if c in existing.columns], "left")
    part = scope
    if stop:
        flagged = runs(flagged, stop, scope, [rank], "__stop")
        part = [*scope, "__stop"]
    found = F.last(F.when(F.col("__e"), F.col(key)), ignorenulls=True).over(after(part, [rank]))
    return flagged.withColumns({"exists": F.coalesce("__e", F.lit(False)), "next_key": found}).drop("__e", "__stop")


def as_of(rows: DataFrame, blocks: DataFrame, on: list[str], order: list[str], carried: list[str], later: bool = False, name: str = "found") -> DataFrame:
    """As-of join: ``name``, a struct of ``order`` and ``carried`` of the nearest block of the same ``on`` strictly before a row in ``order`` (strictly after it, if ``later``).

    Places of both sides make up one ordered window for each ``on``; no row meets more than one block. Of blocks in one place the one with
    the smallest ``carried`` counts. Null keys find nothing; null order values come first.
    """
    there = F.lit(True)
    for c in on:
        there &= F.col(c).isNotNull()
    b = blocks.where(there).groupBy(*on, *order).agg(F.min(F.struct(*carried)).alias("__v"))
    b = b.withColumns({"__v": F.struct(*order, *[F.col(f"__v.{c}").alias(c) for c in carried if c not in order]), "__row": F.lit(0)})
    keys = rows.select(*on, *order).distinct().withColumns({"__v": F.lit(None).cast(b.schema["__v"].dataType), "__row": F.lit(1)})
    # at one place blocks stand where the row doesn't look
    sort = [F.desc(c) for c in order] + [F.desc("__row")] if later else [F.col(c) for c in order] + [F.desc("__row")]
    w = W.partitionBy(*on).orderBy(*sort).rowsBetween(W.unboundedPreceding, -1)
    found = b.unionByName(keys).withColumn("__v", F.last("__v", ignorenulls=True).over(w)).where("__row = 1")
    found = found.select(*[F.col(c).alias(f"__k_{c}") for c in (*on, *order)], F.col("__v").alias(name))
    same = F.lit(True)
    for c in (*on, *order):
        same &= rows[c].eqNullSafe(F.col(f"__k_{c}"))
    return rows.join(found, same, "left").drop(*[f"__k_{c}" for c in (*on, *order)])


def nearest_newer(rows: DataFrame, blocks: DataFrame, on: list[str], age: list[str], carried: list[str]) -> DataFrame:
    """As-of join: the block of the same ``on`` with the smallest ``age`` above the row's own."""
    out = as_of(rows, blocks, on, age, carried, later=True, name="__m")
    return out.withColumns({f"newer_{c}": F.col(f"__m.{c}") for c in dict.fromkeys([*age, *carried])}).drop("__m")


def ranked(df: DataFrame, part: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """``name``: a row's number in its partition, from 1, without the partition as one task.

    Rows are dealt to ranges of (part, order), each a task's; the numbers of rows of a part in the ranges before come on top of
    those within a range. Ranges are written with the rows once, so that a lost task can't draw them anew. ``order`` should tell all rows of a part apart; rows that it doesn't are numbered in any order.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = staged(df.repartitionByRange(ranges, *part, *order).withColumn("__range", F.spark_partition_id()))
    upto = W.partitionBy(*part).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    counts = rows.groupBy(*part, "__range").agg(F.count("*").alias("__n"))
    counts = counts.select(*[F.col(c).alias(f"__p_{c}") for c in part], F.col("__range").alias("__r"), F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__before"))
    own = rows.withColumn("__own", F.row_number().over(W.partitionBy(*part, "__range").orderBy(*order)))
    same = F.col("__range") == F.col("__r")
    for c in part:
        same &= own[c].eqNullSafe(F.col(f"__p_{c}"))
    return own.join(counts, same).withColumn(name, F.col("__before") + F.col("__own")).select(*df.columns, name)


def long_page_labels(df: DataFrame, page: list[str], page_number: Column, order: list[str], name: str = "label") -> DataFrame:
    """The labels of ``page_labels`` for few pages of any number of rows each: a page isn't one task."""
    return ranked(df, page, order, "__n").withColumn(name, F.concat(page_number.cast("string"), letters(F.col("__n") - 1))).drop("__n")


def page_labels(df: DataFrame, page: list[str], page_number: Column, order: list, name: str = "label") -> DataFrame:
    """Page number and a letter by the place on the page."""
    n = F.row_number().over(W.partitionBy(*page).orderBy(*order)) - 1
    return df.withColumn(name, F.concat(page_number.cast("string"), letters(n)))
