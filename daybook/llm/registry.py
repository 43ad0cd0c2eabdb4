"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import decontam, divergence, elias_fano, langid, licenses, linedup, minmax, packing, perspective, quality, rindex, secrets, whitening
from daybook.llm.shared import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    rest = F.crc32(F.col("doc_id").cast("string")) % 4
    out = langid.identify(documents, langid.fit(documents, rest != 2))
    return out.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "n_words", "n_switches")


def op2_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rindex.remove_repeats(table(spark, sf_dir, "documents"), length=200)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_elias_fano(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = elias_fano.round_trip(table(spark, sf_dir, "documents"), _tokenizer(), end_id=2)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), _tokenizer(), window=2048, end_id=1)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_line_edit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "n_lines", "n_removed", F.col("text_left").alias("text"))


def op6_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.judge(documents, quality.fit(documents, table(spark, sf_dir, "labels")))


def op9_perspective(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspective.rotate(table(spark, sf_dir, "conversations")).withColumn("mask", perspective.mask_text())


def op10_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("places")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_run_length_index": op2_run_length_index,
    "op3_elias_fano": op3_elias_fano,
    "op4_packing": op4_packing,
    "op5_line_edit_join": op5_line_edit_join,
    "op6_containment": op6_containment,
    "op7_minmax": op7_minmax,
    "op8_quality": op8_quality,
    "op9_perspective": op9_perspective,
    "op10_secret_forest": op10_secret_forest,
    "op11_whitening": op11_whitening,
    "op12_divergence": op12_divergence,
    "op13_license_scan": op13_license_scan,
}

ORACLE_SQL: dict[str, str] = {"op5_line_edit_join": linedup.SQL, "op9_perspective": perspective.SQL, "op12_divergence": divergence.SQL}
