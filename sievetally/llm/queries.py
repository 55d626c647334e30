"""The operators applied to the given tables with production parameters, as their contracts name the results."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievetally.llm import bpe, jaccard_tree, langid, near_vectors, packing, pii, ranking, secret_scan, sources, token_scan, topk, toxicity, vocabulary, warc_zip
from sievetally.llm.common import fold, table

BPE_FILE = "byte_bpe_multi_50k.tiktoken"
PACK_FILE = "byte_bpe_50k.json"
# The id after the last token of BPE_FILE.
SEPARATOR = 50_256


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, as digests."""
    docs = table(spark, sf_dir, "documents")
    pairs = bpe.BytePairs(spark, vocabulary.read_ranks(public_tokenizers.path(BPE_FILE)), public_tokenizers.PATTERN)
    ids = docs.select("doc_id", pairs.encode(F.col("text")).alias("ids"))
    both = ids.select("doc_id", "ids", pairs.decode(F.col("ids")).alias("decoded"))
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows by integer inner product for every 50th vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5, scale=256.0)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a model of four fifths of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.classify(docs, toxicity_model(docs, labels)).select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.ToxicityModel:
    return toxicity.fit(docs, labels.where(fold("doc_id", 5) != 0))


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors within each label."""
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [pii.of_kind(F.col("base"), k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a model of three quarters of them."""
    found = identify_languages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def identify_languages(docs: DataFrame, keep_rows: bool = False) -> DataFrame:
    return langid.learn_and_identify(docs, fold("doc_id", 4) != 2, keep_rows=keep_rows)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat token files by their separators."""
    docs = table(spark, sf_dir, "documents")
    tokens = vocabulary.read_ranks(public_tokenizers.path(BPE_FILE))
    return token_scan.token_counts(docs, tokens, public_tokenizers.PATTERN, SEPARATOR).select("doc_id", "n_tokens")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens packed into sequences of 1024."""
    with open(public_tokenizers.path(PACK_FILE), encoding="utf-8") as file:
        return packing.pack_documents(table(spark, sf_dir, "documents"), file.read(), public_tokenizers.PATTERN)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC records in ZIP packages and read back."""
    records = warc_zip.archive_pages(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents by five-word shingles and a similarity of 0.75."""
    found = jaccard_tree.jaccard_join(table(spark, sf_dir, "documents"), words=5, percent=75)
    return found.select("doc_id", "n_shingles", "component_id")


def op11_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return ranking.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the words of every source differ from those of the other sources of its language."""
    return sources.divergence(table(spark, sf_dir, "documents"), least_docs=10, top=10)


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    found = secret_scan.secrets(table(spark, sf_dir, "documents"))
    counts = [secret_scan.of_kind(F.col("base"), k).alias(f"n_{rule.name}") for k, rule in enumerate(secret_scan.BASE)]
    return found.select("doc_id", *counts, F.sha2(secret_scan.span_text(F.col("base")), 256).alias("base_sha256"), secret_scan.span_text(F.col("spans")).alias("spans"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_topk": op2_topk,
    "op3_toxicity": op3_toxicity,
    "op4_near_vectors": op4_near_vectors,
    "op5_pii": op5_pii,
    "op6_langid": op6_langid,
    "op7_token_counts": op7_token_counts,
    "op8_packing": op8_packing,
    "op9_warc": op9_warc,
    "op10_jaccard": op10_jaccard,
    "op11_ranking": op11_ranking,
    "op12_sources": op12_sources,
    "op13_secrets": op13_secrets,
}
