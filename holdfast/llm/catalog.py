"""The queries of this package by name, and the SQL that expresses them where SQL can."""

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from holdfast.llm import cotraining, packing
from holdfast.llm.byte_bpe import byte_bpe
from holdfast.llm.common import SPACES, table
from holdfast.llm.language_model import language_model_scores
from holdfast.llm.license_scan import license_scan
from holdfast.llm.periodic_runs import periodic_runs
from holdfast.llm.quality_rules import quality_rules
from holdfast.llm.sentence_pieces import sentence_pieces
from holdfast.llm.sharding import shards
from holdfast.llm.simhash import fingerprint_groups
from holdfast.llm.spelling import spelling_variants
from holdfast.llm.token_counts import token_counts
from holdfast.llm.topk import top_k


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return language_model_scores(table(spark, folder, "documents").withColumn("held_out", held_out))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents"))


def op5_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_groups(table(spark, folder, "documents"))


def op6_cotrained_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return cotraining.quality_classifier(docs, labels, keep=["doc_id"])


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(table(spark, folder, "documents"), keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"))


def op9_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards(table(spark, folder, "documents"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    return placed.select(
        "doc_id", size.alias("size"), F.crc32("text").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def slip(key: str, word: str) -> str:
    """The word with a letter left out where 31 divides the checksum of document and word."""
    h = zlib.crc32(f"{key}:{word}".encode())
    return word if h % 31 else word[:h % len(word)] + word[h % len(word) + 1:]


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"), slip)


def op12_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return sentence_pieces(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; where 10 divides the checksum h of doc_id, the words from word a on repeat the p words there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    spaced = F.translate("text", SPACES[1:], " " * (len(SPACES) - 1))
    words = F.filter(F.split(spaced, " "), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), g.alias("g"))
    n = F.size("words")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    unit = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(unit, times)), F.lit(1), n - F.col("a"))
    made = F.concat_ws(" ", F.concat(F.slice("words", F.lit(1), F.col("a")), tail))
    return rows.select("doc_id", F.when(n > 0, made).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs(with_repeats(table(spark, folder, "documents")))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_best_fit_packing, op3_lm_scores, op4_license_scan, op5_simhash_groups, op6_cotrained_quality,
    op7_quality_rules, op8_exact_top_k, op9_shards, op10_byte_bpe,
    op11_spelling_variants, op12_sentence_pieces, op13_periodic_runs, pipeline)}

ORACLES = {
    "op8_exact_top_k": """
        with vectors as (
            select cast(vec_id as bigint) vec_id,
                list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) v
            from embeddings
            where vec_id is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
            select q.vec_id query_id, c.vec_id vec_id,
                cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) score
            from vectors q join vectors c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
            where q.vec_id % 100 = 0)
        select query_id, cast(rank as int) rank, vec_id, score
        from (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from scored)
        where rank <= 10""",
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
