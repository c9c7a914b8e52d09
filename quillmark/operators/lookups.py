"""Attaching values by lookups of loosening keys, and learning a mapping of codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import eligible, round_up

#: Passes of the cascade: name and key columns. A record with an id tries the first four, one without the others.
WITH_ID = (("agency+id+chyr+amt", ("agency", "approp_id", "chapter_year", "approp_amount")), ("agency+id+chyr", ("agency", "approp_id", "chapter_year")), ("agency+id+amt", ("agency", "approp_id", "approp_amount")), ("agency+id_only", ("agency", "approp_id")))
WITHOUT_ID = (("agency+noid+chyr+amt+re", ("agency", "chapter_year", "approp_amount", "reapprop_amount")), ("agency+noid+chyr+amt", ("agency", "chapter_year", "approp_amount")))


def first_of_key(lookup: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """(keys, value) of the first row of each key; its value counts even if it is null."""
    first = lookup.groupBy(*keys).agg(F.min_by(F.struct(value), order).alias("f"))
    return first.select(*keys, F.col(f"f.{value}").alias(value))


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], value: str, order: str, name: str) -> DataFrame:
    """Left join with the first row of each key; the value goes to ``name``."""
    return rows.join(first_of_key(table, keys, value, order).withColumnRenamed(value, name), keys, "left")


def cascade(rows: DataFrame, table: DataFrame, passes, value: str = "balance", order: str = "row_idx", out: str | None = None, method: str = "method", when: Column | None = None) -> DataFrame:
    """First pass whose value isn't null, and its name. The table isn't used up, so the passes are independent joins."""
    out = out or value
    names = []
    for k, (_, keys) in enumerate(passes):
        names.append(f"__v{k}")
        rows = lookup(rows, table, list(keys), value, order, names[-1])
    found = [F.col(n) if when is None else F.when(when, F.col(n)) for n in names]
    tag = F.coalesce(*[F.when(v.isNotNull(), F.lit(t)) for v, (t, _) in zip(found, passes, strict=True)], F.lit(""))
    return rows.withColumns({out: F.coalesce(*found), method: tag}).drop(*names)


def attach_balance(comparison: DataFrame, table: DataFrame, value: str = "balance", order: str = "row_idx") -> DataFrame:
    """Dropped records with ``balance``, ``method``, ``rounded`` and ``insert_eligible``."""
    rows = comparison.where("status = 'dropped'").withColumns({"agency": F.coalesce("agency", F.lit("")), "approp_id": F.coalesce("approp_id", F.lit(""))})
    has_id = F.col("approp_id") != ""
    rows = cascade(rows, table.where("approp_id <> ''"), WITH_ID, value, order, "__a", "__ma", has_id)
    rows = cascade(rows, table, WITHOUT_ID, value, order, "__b", "__mb", ~has_id)
    rows = rows.withColumns({value: F.coalesce("__a", "__b"), "method": F.when(has_id, F.col("__ma")).otherwise(F.col("__mb"))}).drop("__a", "__b", "__ma", "__mb")
    return rows.withColumns({"rounded": round_up(F.col(value)), "insert_eligible": eligible(F.col(value))})


def preferred(tables: list[DataFrame], scope: list[str]) -> DataFrame:
    """Rows of the first table that has any for their ``scope`` (an agency, say); tables behind it only fill in where it has none."""
    ranked = None
    for k, df in enumerate(tables):
        one = df.withColumn("__rank", F.lit(k))
        ranked = one if ranked is None else ranked.unionByName(one)
    best = ranked.groupBy(*[F.col(c).alias(f"__s_{c}") for c in scope]).agg(F.min("__rank").alias("__best"))
    same = F.col("__rank") == F.col("__best")
    for c in scope:
        same &= F.col(c).eqNullSafe(F.col(f"__s_{c}"))
    return ranked.join(best, same, "left_semi").drop("__rank")


def unmatched_sample(rows: DataFrame, order: list[str], n: int = 15, value: str = "balance") -> DataFrame:
    """The first ``n`` records without a balance, for a report."""
    return rows.where(F.col(value).isNull()).orderBy(*order).limit(n)


def balance_summary(rows: DataFrame, value: str = "balance") -> DataFrame:
    v = F.col(value)
    return rows.agg(
        F.count("*").alias("n"), F.count_if(v.isNotNull()).alias("matched"), F.count_if(v.isNull()).alias("unmatched"), F.count_if(v == 0).alias("zero"),
        F.count_if((v > 0) & (v < 1000)).alias("small"), F.count_if(F.col("insert_eligible")).alias("eligible"), F.sum(F.when(F.col("insert_eligible"), F.col("rounded")).otherwise(0)).alias("rounded_total"),
    )


def learned_mapping(codes: DataFrame, known: DataFrame, on: list[str], code: str, agency: str, amount: str, large: int = 1_000_000) -> DataFrame:
    """(code, agency): each agency votes for the code that it shares most rows with.

    Votes of large amounts count alone where an agency has any; other agencies get only codes that
    those left. Ties go to the smaller code, and a code that several agencies win goes to the last of them by name.
    """
    joined = known.where(F.coalesce(F.col(agency), F.lit("")) != "").select(agency, *on).join(codes.select(code, *on), on)
    votes = joined.groupBy(agency, code).agg(F.count("*").alias("n"), F.count_if(F.col(amount) >= large).alias("big"))
    has_big = F.max("big").over(W.partitionBy(agency)) > 0
    votes = votes.withColumn("by_big", has_big).withColumn("v", F.when(has_big, F.col("big")).otherwise(F.col("n"))).where("v > 0")
    won = votes.withColumn("r", F.row_number().over(W.partitionBy(agency).orderBy(F.desc("v"), code))).where("r = 1")
    large_won = won.where("by_big").groupBy(code).agg(F.max(agency).alias(agency))
    small_won = won.where("not by_big").groupBy(code).agg(F.min(agency).alias(agency)).join(large_won.select(code), code, "left_anti")
    return large_won.unionByName(small_won)


def apply_mapping(rows: DataFrame, mapping: DataFrame, code: str, agency: str) -> DataFrame:
    return rows.join(mapping, code, "left").withColumn(agency, F.coalesce(agency, F.lit("")))


def missing_in(rows: DataFrame, other: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Flag of rows whose key the other table hasn't."""
    there = other.select(*keys).distinct().withColumn("__there", F.lit(True))
    return rows.join(there, keys, "left").withColumn(name, F.col("__there").isNull()).drop("__there")


def expected_and_actual(expected: DataFrame, actual: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, expected, actual, delta) over the keys of either side."""
    e, a = expected.select(*keys, F.col(value).alias("expected")), actual.select(*keys, F.col(value).alias("actual"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    out = e.join(a, keys, "full").select(*keys, zero("expected"), zero("actual"))
    return out.withColumn("delta", F.col("actual") - F.col("expected"))
