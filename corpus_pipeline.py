"""From raw documents to piece ids: quality, near duplicates, contamination, personal data, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last return the columns of documents, as the
caller has them, further ones with any name included. Null texts count as empty: they are judged by their empty statistics, are
copies of each other only with equal ids, hold no benchmark words, stay null when masked, and have no pieces. Repeated rows are
judged alike; one of them stays behind near_duplicates. An empty table gives an empty result.
``run`` writes every stage's result as Parquet in ``spark.checkpoint.dir`` and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import decontaminate, near_duplicates, pii, quality, sentencepiece
from panelkit.llm.common import Scratch


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on these documents, does not reject."""
    return quality.drop_bad(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_duplicates.drop_near_duplicates(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without verbatim benchmark passages of some weight."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars, where there is one, counts the new text."""
    masked = pii.mask_pii(docs)
    if "n_chars" not in docs.columns:
        return masked
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", n_chars).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of all documents, their number, and whether they decode to the text."""
    coded = sentencepiece.encode(docs, decoded_col="decoded")
    n_pieces = F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long").alias("n_pieces")
    return coded.select("doc_id", "lang", "source", "n_chars", n_pieces, F.expr("decoded <=> text").alias("same"), "piece_ids")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_clean),
    ("personal_data", mask_personal),
    ("pieces", encode),
]

#: The field's and the scorer's weights and the sampled signatures have no SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "corpus-pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir))
    return docs
