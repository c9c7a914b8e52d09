"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, bpe, centroids, edits, fingerprint, html, mixing, nearest, neardup, oracles, pii, quality, rans, repeats
from .common import scratch, table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.tiktoken"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits.edited_counts(table(spark, sf_dir, "documents"), edits.sample_edits(), tokenizer("byte_bpe_50k.tiktoken"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.extract(pages, odds=html.fit(pages))


def pii_key(spark: SparkSession) -> str:
    """The secret key of the pseudonyms: a setting of the session; these queries go on with a sample key where it is unset."""
    return spark.conf.get("spark.quillmark.pii.key", "sample-key-of-the-queries")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pii.pseudonymise(table(spark, sf_dir, "documents"), pii_key(spark), count_col="n_private")
    return docs.select("doc_id", "text", "n_private")


#: Production parameters: 97 % of the largest entropy, at most four passes over a source, as many tokens as there are. Sources that are more even stay so.
TEMPERATURE = mixing.Mix(target_entropy=0.97, max_repeats=4.0, only_flatten=True)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = mixing.mixed(docs, TEMPERATURE)
    return out.select("doc_id", "source", "mix_weight", F.size("mix_at").alias("copies"), "mix_at")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = scratch(spark)
    rans.write(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), at, added=True)
    return rans.digests(spark, at)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compared(table(spark, sf_dir, "documents"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


QUERIES = {"op1_token_counts": op1_token_counts, "op2_main_text": op2_main_text, "op3_pii": op3_pii, "op4_mixing": op4_mixing, "op5_minhash": op5_minhash, "op6_rans": op6_rans, "op7_fingerprints": op7_fingerprints, "op8_nearest": op8_nearest, "op9_quality": op9_quality, "op10_byte_bpe": op10_byte_bpe, "op11_clusters": op11_clusters, "op12_repeats": op12_repeats, "op13_alignment": op13_alignment}
ORACLES = {"op2_main_text": oracles.OP2, "op5_minhash": oracles.OP5, "op11_clusters": oracles.clusters(), "op12_repeats": oracles.OP12}
