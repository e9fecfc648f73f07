"""The corpus pipeline: from raw documents to packed training sequences (part of ``tripweave.llm``).

Every stage works on all rows that its predecessor kept; all but the last return the columns of
the documents table. Defined results for odd rows are those of each stage's operator: null and
empty texts fail the quality rules, repeated rows and equal texts leave one row, of near copies one
row stays whatever their doc_ids are, and an empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import exact_dedup, packing, quality_classifier, quality_rules, shingle_join
from tripweave.sinks.files import store


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.3 or more, by a model of the labels outside the held-out fifth."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return quality_classifier.keep_good(docs, quality_classifier.fit(docs, labels.where(fifth != 0)))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality_rules.keep_passing(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles (similarity 0.75 or more), the row with the smallest doc_id."""
    return shingle_join.keep_one(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens with their place in the sequences."""
    return packing.pack(packing.token_pieces(docs, _tokenizer()))


STAGES = [
    ("quality classifier", classify_quality),
    ("quality rules", apply_rules),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("best-fit packing", pack_sequences),
]

# The classifier, the tokenizer and the packing are beyond SQL; tests hold the stages against
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = store(docs, f"stage-{number}")
    return docs
