"""A corpus pipeline of the training-data operators, from ``documents`` to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns the documents that it
keeps, with the columns of ``documents``; the last returns packed pieces.

1. quality: documents that the quality rules reject go.
2. line_dedup: lines that stand earlier in the corpus, exactly or within one
   edit, go; a document of which nothing is left goes, n_chars follows the text.
3. near_dedup: of each group of near-duplicates (five-word shingles, 0.8) the
   document with the least doc_id stays.
4. decontaminate: documents that contain a benchmark item go.
5. pack: what is left as token ids in sequences of at most 2048.

Defined cases are those of the operators. Rows without a doc_id pass through
every stage on their own text; rows that share a doc_id are one document to
stage 3; an empty table gives an empty result of each stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import decontam, linedup, minmax, packing, quality
from daybook.llm.shared import cut, ship

#: Removed ids are broadcast up to this many rows; beyond that the join shuffles.
BROADCAST = 2_000_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality.keep(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = linedup.dedup_lines(docs).where("n_lines = 0 or n_removed < n_lines")
    text = {"text": F.col("text_left"), "n_chars": F.char_length("text_left").cast("bigint")}
    return out.select(*[text[c].alias(c) if c in text else F.col("row")[c].alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    gone = cut(minmax.near_duplicates(docs, shingle=5, percent=80).where("not kept").select("doc_id").distinct())
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST else gone, "doc_id", "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontam.keep(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), window=2048, end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: SQL cannot express the tokenizer and the online packing; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
