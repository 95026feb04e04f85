"""Training-data pipeline: documents in, packed sequences out.

Each stage takes the rows its predecessor kept and writes what it keeps, so a lost executor costs no earlier stage. All
stages but the last return the columns of documents.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from holdfast.llm.common import neutral, restored, table
from holdfast.llm.cotraining import quality_classifier
from holdfast.llm.packing import pack
from holdfast.llm.quality_rules import quality_rules
from holdfast.llm.simhash import one_of_each
from holdfast.session import scratch_path


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; those with null, empty or very short texts go."""
    return restored(quality_rules(neutral(docs)).where("kept"), docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts; it is fitted on the whole table, since the rules leave few bad ones."""
    labels, whole = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    return restored(quality_classifier(neutral(docs), labels, fit_on=neutral(whole)).where("accepted"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each group whose fingerprints (three-word shingles) are linked by
    differences of three bits or fewer."""
    return one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and place, and their token ids."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), ids=True)


STAGES = [
    ("quality_rules", rules), ("quality_classifier", classifier), ("simhash_near_dedup", near_duplicates),
    ("best_fit_packing", packed),
]

#: Fitted models and tokenizers are beyond SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
