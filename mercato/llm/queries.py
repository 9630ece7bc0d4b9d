"""The operators of this package bound to the test tables, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from mercato.llm import bpe_count, contamination, fingerprints, gru, jaccard, language, manifest, middle, oracle, pieces, repeats, toxicity, url_rules, weak_quality
from mercato.llm.tables import fold, load

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZERS = os.environ.get("MERCATO_TOKENIZERS")
DROPOUT = 0.1
SEED = 20240


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file; MERCATO_TOKENIZERS names another folder."""
    return os.path.join(TOKENIZERS, name) if TOKENIZERS else public_tokenizers.path(name)


# The written policy of op1.
URL_POLICY = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of its id in ``labels``: bad if toxic or of low quality; unknown labels are left out."""
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    marked = load(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("page_id")).agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    bad = ((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int")
    labelled = pages.join(marked, "page_id").select("url", bad.alias("bad"))
    return url_rules.judge(pages, URL_POLICY, labelled).drop("url")


def op2_latent_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item whose passage it holds."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination.find(docs, load(spark, sf_dir, "benchmark"))


def op3_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    labels = load(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels, fold(parts=5) != 0)
    scored = toxicity.score(docs.withColumn("held_out", fold(parts=5) == 0), model)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op4_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs, fold(parts=4) != 2)
    told = language.predict(docs.drop("lang").withColumn("held_out", fold(parts=4) == 2), model)
    return told.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op5_piece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    made = pieces.encode(docs, tokenizer("piece_bpe_32k.model"), DROPOUT, SEED, check=True)
    return made.select("doc_id", "n_pieces", F.sha2(F.array_join("piece_ids", " "), 256).alias("pieces_sha256"), F.col("same").alias("lossless"))


def op6_fragment_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_components(load(spark, sf_dir, "documents"))


def op7_repeat_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After the digests: whether the text lost bytes, and what is left of it; what is left of a cut character reads U+FFFD."""
    made = repeats.remove_repeats(load(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
        (F.col("n_removed") > 0).alias("repeated"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"),
    )


def op8_recurrent_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru.log_likelihood(load(spark, sf_dir, "documents"), fold(parts=7) == 2)


def op9_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_neighbours(load(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    made = bpe_count.count_tokens(docs, tokenizer("word_bpe_49k.json"), limit=2048)
    return made.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op11_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = weak_quality.judge(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = middle.transform(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middle.restored(), 256).alias("restored_sha256"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 7 divides the id's crc32, the claimed row has one character more than the listed one."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    rest = F.col("source"), F.col("lang")
    more = F.when(fold(parts=7) == 0, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars")).cast("decimal(20,0)")
    leaves = docs.select(
        "doc_id", "lang",
        manifest.leaf(F.col("doc_id"), *rest, F.col("n_chars"), F.col("text")).alias("leaf"),
        manifest.leaf(F.col("doc_id"), *rest, more, F.col("text")).alias("claimed"),
    )
    told = manifest.verify(manifest.prove(leaves, "lang", "doc_id", keep=["claimed"]), "claimed")
    return told.select("doc_id", "leaf", "subroot", "root", F.sha2(manifest.siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root", "verified")


QUERIES: dict[str, Query] = {
    "op1_url_rules": op1_url_rules,
    "op2_latent_retrieval": op2_latent_retrieval,
    "op3_compression_toxicity": op3_compression_toxicity,
    "op4_output_codes": op4_output_codes,
    "op5_piece_dropout": op5_piece_dropout,
    "op6_fragment_jaccard": op6_fragment_jaccard,
    "op7_repeat_intervals": op7_repeat_intervals,
    "op8_recurrent_likelihood": op8_recurrent_likelihood,
    "op9_weighted_sampling": op9_weighted_sampling,
    "op10_token_counts": op10_token_counts,
    "op11_weak_quality": op11_weak_quality,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLE: dict[str, str] = {"op1_url_rules": oracle.OP1, "op12_fill_in_middle": oracle.OP12, "op13_merkle_manifest": oracle.OP13}
