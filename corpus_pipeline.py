"""The corpus pipeline: quality, line dedup, near-dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of ``documents``. The pipeline learns its quality model from labels, so
no SQL can express it; ``tests/llm`` hold each stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import decontam, linespread, pieces, quality, simhash
from weftline.llm.common import Written, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("predicted = 1").select(COLUMNS)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out lines that stand on several sites, but for their first document; n_chars follows the text."""
    cleaned = linespread.remove_boilerplate(docs)
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", changed).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one with the smallest id, of each near-duplicate group."""
    return simhash.drop_near_duplicates(docs).select(COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded text."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.encode_decode(docs.select("doc_id", "text"), model, with_ids=True)
    return coded.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_boilerplate_lines),
    ("near-dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

#: No SQL expresses a model fitted to labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        written = Written(stage(spark, docs, sf_dir))
        if before:
            before.drop()
        docs, before = written.df, written
    return docs
