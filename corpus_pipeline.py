"""Five stages from raw documents to token ids; each is written as Parquet and read again before the next.

Defined results: null and empty texts have a score like any other and are no near duplicates of anything; of repeated rows
one stays; null sources are a source of their own; empty tables give empty tables; other columns are kept, whatever their
names, but that ``n_chars`` follows the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm import bpe, common, mixing, neardup, pii, quality
from quillmark.llm.queries import pii_key, tokenizer

#: No budget: every document is drawn at least once; rarer sources up to one and a half times as often.
MIX = mixing.Mix(max_repeats=1.5)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold of the ranking."""
    ranker = quality.fit(docs, common.table(spark, sf_dir, "labels"))
    score = common.free_name(docs, "quality_score")
    return quality.score(docs, ranker, score_col=score).where(F.col(score) >= 0.5).select(docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id, rows without an id last.

    Rows are compared by numbers of their own, so repeated ids and rows without one are told apart; texts without words all stay.
    """
    row = common.free_name(docs, "row")
    # numbered once, in a written table, so that a lost task can't number rows anew
    rows = common.staged(docs.withColumn(row, F.monotonically_increasing_id()), f"{common.scratch(spark)}/rows")
    groups = neardup.near_duplicates(rows, row).select(row, "component_id")
    ids = rows.select(row, F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"))
    kept = groups.join(ids, row).groupBy("component_id").agg(F.min(F.struct("no_id", "id", row)).alias("first")).select(f"first.{row}")
    return rows.join(kept, row, "left_semi").select(docs.columns)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to pseudonyms; addresses may change in length, so lengths are counted anew."""
    out = pii.pseudonymise(docs, pii_key(spark))
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies as the mixture draws them, in the order of their places in it."""
    at, weight = common.free_name(docs, "mix_at"), common.free_name(docs, "mix_weight")
    drawn = mixing.mixed(docs, MIX, at_col=at, weight_col=weight).withColumn(at, F.explode(at))
    n = common.parts(spark)
    return drawn.repartitionByRange(n, at).sortWithinPartitions(at).select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every copy."""
    return bpe.round_trip(docs, tokenizer("byte_bpe_50k.tiktoken"), keep_ids=True)


STAGES = [("quality", good_quality), ("near_duplicates", without_near_duplicates), ("pii", pseudonyms), ("mixing", mixed_sources), ("bpe", token_ids)]
#: The fitted ranking, MinHash classes and keyed permutations are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.staged(stage(spark, docs, sf_dir), f"{common.scratch(spark)}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
