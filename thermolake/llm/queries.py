"""Registered queries of the package: each applies its operator to the whole intended table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thermolake.llm import (
    ann,
    codes,
    dac,
    decontaminate,
    divergence,
    jaccard,
    kneser_ney,
    packing,
    quality,
    secrets,
    toxicity,
    url_filter,
    warc,
)
from thermolake.llm.common import fold, table
from thermolake.llm.oracles import SOURCE_DIVERGENCE, URL_FILTER, vector_codes

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def known_labels(spark: SparkSession, sf_dir: str, label: str, folds: int, held_out: int) -> DataFrame:
    """(doc_id, label) without the documents of the held-out fold."""
    learn = F.coalesce(fold(F.col("doc_id"), folds) != held_out, F.lit(False))
    return table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("label")).filter(learn)


def is_held_out(folds: int, held_out: int) -> Column:
    return F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out")


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = ann.search(ann.build(vectors, k=10), vectors.filter("id % 100 = 0"), k=10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; ``rejected`` by the threshold of the language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.fit(docs, known_labels(spark, sf_dir, "toxic", 3, 1))
    scored = toxicity.score(docs, model)
    cut = toxicity.threshold(model, F.col("lang"))
    return scored.select(
        "doc_id",
        is_held_out(3, 1),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        cut.alias("threshold"),
        (F.col("score") >= cut).alias("rejected"),
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of all documents with all benchmark items."""
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 1024 ids."""
    cut = packing.pieces(table(spark, sf_dir, "documents"), TOKENIZER)
    digests = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under links of 80 % shared shingles."""
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as directly addressable codes and read back."""
    manifest = dac.write(table(spark, sf_dir, "documents"), TOKENIZER)
    return dac.read(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by compression with a good and a bad dictionary."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, known_labels(spark, sf_dir, "quality", 4, 2))
    scored = quality.score(docs, model)
    return scored.select("doc_id", is_held_out(4, 2), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, found through the trigram index."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = [rule.kind for rule in secrets.BASE]
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    of_base = F.filter("found", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(secrets.written(of_base).cast("binary"), 256).alias("base_sha256"),
        secrets.written("found").alias("spans"),
    )


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of all documents under a model of those outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = kneser_ney.train(docs.filter(fold(F.col("doc_id"), 7) != 2))
    scored = kneser_ney.score(docs, model)
    tokens = F.lit(model.tokens).cast("bigint").alias("train_tokens")
    return scored.select("doc_id", is_held_out(7, 2), "n_tokens", "n_known", tokens, "base_score", "score")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC bundles and read back by their places."""
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("record_id"), "url", F.col("html").cast("binary").alias("payload")
    )
    read = warc.read(warc.write(pages))
    return read.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of all sources of each language, and the terms each source has too many of."""
    found = divergence.audit(table(spark, sf_dir, "documents"))
    return found.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


# The rules of the query; longest wins.
URL_RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of all pages by rule, or by the aliases that redirects and canonical links name."""
    judged = url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors: 8 parts, 16 entries, 6 rounds."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    return codes.compress(vectors).select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest": op1_nearest,
    "op2_toxicity": op2_toxicity,
    "op3_decontaminate": op3_decontaminate,
    "op4_packing": op4_packing,
    "op5_jaccard": op5_jaccard,
    "op6_token_files": op6_token_files,
    "op7_quality": op7_quality,
    "op8_secrets": op8_secrets,
    "op9_language_model": op9_language_model,
    "op10_warc": op10_warc,
    "op11_source_divergence": op11_source_divergence,
    "op12_url_filter": op12_url_filter,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES: dict[str, str] = {
    "op11_source_divergence": SOURCE_DIVERGENCE,
    "op12_url_filter": URL_FILTER,
    "op13_vector_codes": vector_codes(),
}
