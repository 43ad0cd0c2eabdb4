"""Every stage of the corpus pipeline against brute force on its own input."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from daybook.llm import quality
from tests.conftest import SF001
from daybook.llm.linedup import LEVELS
from tests.llm import brute


def rows_of(df):
    return Counter((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect())


def judged(spark, rows, docs):
    ratio = quality.fit(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    llr = {r["doc_id"]: r["llr"] for r in quality.judge(docs, ratio).collect()}
    out = []
    for r in rows:
        n, _, _, _, again = brute.base_counts(r["text"])
        if n >= 10 and 100 * again <= 20 * n and llr[r["doc_id"]] >= quality.THRESHOLD:
            out.append(r)
    return out


def lines(spark, rows, docs):
    out = []
    for r, (n, gone, left) in zip(rows, brute.dedup_lines([(r["doc_id"], r["text"]) for r in rows], LEVELS), strict=True):
        if n == 0 or gone < n:
            out.append({**r, "text": left, "n_chars": None if left is None else len(left)})
    return out


def near(spark, rows, docs):
    to = brute.components([(r["doc_id"], r["text"]) for r in rows], 5, 80)
    return [r for r in rows if to[r["doc_id"]] == r["doc_id"]]


def clean(spark, rows, docs):
    items = [brute.shingles(r["text"], 5) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    return [r for r in rows if not any(x and 100 * len(x & brute.shingles(r["text"], 5)) >= 80 * len(x) for x in items)]


@pytest.mark.parametrize("given", ["documents", "its predecessor's result"])
def test_stages_equal_brute_force(spark, given):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for (name, stage), want in zip(pipeline.STAGES[:-1], (judged, lines, near, clean), strict=True):
        rows = [r.asDict() for r in docs.collect()]
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns
        kept = Counter((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in want(spark, rows, docs))
        assert rows_of(out) == kept, name
        assert kept and kept != rows_of(docs) or name == "near_dedup", name
        if given != "documents":
            docs = spark.createDataFrame(out.collect(), docs.schema)


def test_run_packs_what_is_left(spark):
    out = pipeline.run(spark, SF001)
    total = out.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert total.where("n <> m").count() == 0
    assert 0 < total.count() < spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").where("false")
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF001).collect() == []


def test_stages_take_null_and_repeated_rows(spark):
    text = "One line of this text that is long enough to count.\nAnother line of it, with other words in it."
    rows = [(1, None, "en", "s", 0), (2, "", None, None, 0), (None, text, "en", "s", None), (None, text, "en", "s", None), (3, text, "en", "s", 9), (3, text, "en", "s", 9)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{SF001}/documents.parquet").schema)
    counts = [stage(spark, docs, SF001).count() for _, stage in pipeline.STAGES]
    # null and empty texts fail the rules; the rows without an id come after doc 3, so their lines go
    assert counts[0] == 4 and counts[1] == 4 and counts[2] == 6 and counts[3] == 6
