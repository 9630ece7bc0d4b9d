"""Cleaning a corpus in stages, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read
again as the next one's documents. Null, empty and very long texts, repeated rows, null keys and
empty tables go through every stage; what happens to them is said at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mercato.llm import contamination, jaccard, language, pieces, repeats
from mercato.llm.queries import DROPOUT, SEED, tokenizer
from mercato.llm.tables import attach, drop, load, small_batches, stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Belief in the best language below which no language is told; four equal ones have 0.25.
LEAST_BELIEF = 0.3
# Bytes of a repeat: passages of over 50 words are longer.
REPEAT_BYTES = 200


def told_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts that no language fits; fills a null lang.

    Null, empty and letterless texts go. Learned from the rows with a lang; if there is none, every
    text goes, because none can be told.
    """
    small_batches(spark)
    model = language.fit(docs, F.lit(True))
    told = language.predict(docs.select(*COLUMNS), model)
    kept = told.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_BELIEF))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each component of near copies, once.

    Wordless texts and rows with a null doc_id link with nothing and stay.
    """
    small_batches(spark)
    docs = docs.select(*COLUMNS)
    found = jaccard.near_components(docs)
    first = found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("_rows"))
    first = stage(first, "near-kept")
    out = attach(docs.where("doc_id is not null"), first, ["doc_id"], "inner")
    again = first.where("_rows > 1").select("doc_id")
    if not again.isEmpty():  # a repeated row: only these ids are shuffled
        more = out.where("_rows > 1").dropDuplicates(["doc_id"])
        out = out.where("_rows = 1").unionByName(more)
    return out.select(*COLUMNS).unionByName(docs.where("doc_id is null"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every string of ``REPEAT_BYTES`` bytes that starts twice in the corpus out of all texts.

    A row of which nothing is left goes; null and empty texts stay as they are. n_chars is that of the new text.
    """
    small_batches(spark)
    before = F.coalesce(F.octet_length("text"), F.lit(0)).alias("_bytes")
    cut = repeats.strip_repeats(docs.select(*COLUMNS, before), REPEAT_BYTES).where("_bytes = 0 or text <> ''")
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage; rows with a null doc_id stay."""
    marked = contamination.mark(docs.select(*COLUMNS), load(spark, sf_dir, "benchmark"))
    return marked.where(~F.col("contaminated")).select(*COLUMNS)


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, with seeded merge-dropout; an empty text has none."""
    small_batches(spark)
    return pieces.encode(docs.select(*COLUMNS), tokenizer("piece_bpe_32k.model"), DROPOUT, SEED).drop("text")


STAGES = [
    ("language", told_language),
    ("near copies", one_of_near_copies),
    ("repeats", without_repeats),
    ("benchmark", without_benchmark),
    ("pieces", as_pieces),
]

# Compression, hashing and vocabulary stages can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = load(spark, sf_dir, "documents"), None
    for k, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{k}")
            if held is not None:
                drop(held)  # the stage's input: nothing reads it any more
            held = docs
    return docs
