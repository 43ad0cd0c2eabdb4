"""Quality rules: base counts and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed byte n-grams (case kept, white space included)
are fitted with add-one smoothing: the target from documents that the labels
trust (quality 1), the raw one from every document. A document's score is the
mean over its n-grams of ``log p_target - log p_raw``; being length-normalised
it is near 0 for text like the trusted text, whatever its length, and far
below 0 for text of a kind that the labels distrust. A document is rejected
if the base rules fail or the score is below a fixed threshold: the verdict
is deterministic, nothing is sampled.

Bounds: the hash table has ``2 ** BITS`` entries (two 64-bit counts each, the
only thing that reaches the driver); the target is fitted on at most
``MAX_TRUSTED`` trusted documents (least hashes of the id first). Raw counts,
scores and verdicts cover all documents. Both passes stream over the input
splits; only the partial count tables are shuffled.

Defined cases: a null or empty text has no words, so it fails the base rules;
a text with under three bytes scores 0; without any trusted document every
score is 0; repeated rows are judged alike; other columns are passed through
by ``keep`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.shared import lean
from daybook.llm.textbytes import chunks, hashes, mix, prefix, shingles, texts_of, words

#: Length of an n-gram in bytes, and bits of its hash.
GRAM = 3
BITS = 16
MAX_TRUSTED = 50_000
#: Mean log ratio below which a document is rejected.
THRESHOLD = -0.6

COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, llr double, kept boolean"

_SYMBOL = np.zeros(256, np.bool_)
_SYMBOL[list(b"#*$%&|<>")] = True


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n-gram at each byte, and whether one starts there."""
    if len(data) < GRAM:
        return np.empty(0, np.int64), np.empty(0, np.bool_)
    n = len(data) - GRAM + 1
    x = np.zeros(n, np.uint32)
    for k in range(GRAM):
        x = x * np.uint32(257) + data[k : k + n]
    valid = np.ones(n, np.bool_)
    for k in range(1, GRAM):
        at = offsets[1:] - k
        valid[at[(at >= 0) & (at < n)]] = False
    return (x * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS)).astype(np.int64), valid


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a byte-wise array over each text."""
    total = np.concatenate(([0], np.cumsum(flags)))
    return np.diff(total[np.minimum(offsets, len(flags))])


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The five counts of each text."""
    n = len(offsets) - 1
    start, end, at = words(data, offsets)
    sums = prefix(data)
    word = hashes(sums, start, end)
    n_words = np.diff(at)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[start] += 1
    inside[end] -= 1
    lead = (data & 0xC0) != 0x80
    chars = _per_text((np.cumsum(inside[:-1]) > 0) & lead, offsets)
    # lines with a word
    line = np.unique(np.concatenate((offsets[:-1], np.flatnonzero(data == 10) + 1)))
    line = line[line < len(data)]
    stop = np.append(line[1:], len(data))
    some = np.searchsorted(start, stop) > np.searchsorted(start, line)
    line, stop = line[some], stop[some]
    stop = stop - (data[stop - 1] == 10) if len(stop) else stop
    owner = np.searchsorted(offsets, line, "right") - 1
    key = mix(hashes(sums, line, stop) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    dup = np.bincount(owner, minlength=n) - np.bincount(owner[first], minlength=n)
    # words in windows of five that come twice or more
    window, first = shingles(word, at, 5)
    long = n_words >= 5
    owner = np.repeat(np.arange(n), np.diff(first))
    window, owner, place = window[long[owner]], owner[long[owner]], (np.arange(len(owner)) - first[owner] + at[owner])[long[owner]]
    key = mix(window + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    covered = np.zeros(len(word) + 1, np.int32)
    if len(twice):
        found = twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key
        np.add.at(covered, place[found], 1)
        np.add.at(covered, place[found] + 5, -1)
    repeat = np.concatenate(([0], np.cumsum(np.cumsum(covered[:-1]) > 0)))
    return {
        "n_words": n_words, "word_chars": chars, "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_dup_lines": dup, "n_repeat_words": repeat[at[1:]] - repeat[at[:-1]],
    }


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality", max_trusted: int = MAX_TRUSTED) -> np.ndarray:
    """log p_target - log p_raw for each hash value."""
    trusted = (
        labels.where(F.col(quality_col) == 1).select(F.col(id_col).cast("bigint").alias("doc_id")).where("doc_id is not null").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_trusted)
    )
    ids = np.sort(np.array([r[0] for r in trusted.collect()], np.int64))  # at most max_trusted

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
        for batch in batches:
            data, offsets = texts_of(batch.column("text"))
            trust = np.isin(batch.column("doc_id").fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), ids)
            for i, j in chunks(offsets):
                part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                grams, valid = _grams(part, at)
                raw += np.bincount(grams[valid], minlength=1 << BITS)
                if trust[i:j].any():
                    here = valid & np.repeat(trust[i:j], np.diff(at))[: len(valid)]
                    target += np.bincount(grams[here], minlength=1 << BITS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"gram": some, "raw": raw[some], "target": target[some]})

    texts = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = texts.mapInArrow(lean(count), "gram bigint, raw bigint, target bigint").groupBy("gram").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.ones(1 << BITS), np.ones(1 << BITS)
    for gram, a, b in table.collect():  # at most 2 ** BITS rows
        raw[gram] += a
        target[gram] += b
    if target.sum() == 1 << BITS:
        return np.zeros(1 << BITS)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def _judged(column: pa.Array, ratio: np.ndarray, threshold: float) -> dict[str, np.ndarray]:
    data, offsets = texts_of(column)
    out: list[dict[str, np.ndarray]] = []
    for i, j in chunks(offsets):
        part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        counts = base_counts(part, at)
        grams, valid = _grams(part, at)
        many = _per_text(valid, at)
        counts["llr"] = _per_text(np.where(valid, ratio[grams], 0.0), at) / np.maximum(many, 1)
        counts["base_failed"] = (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])
        counts["kept"] = ~counts["base_failed"] & (counts["llr"] >= threshold)
        out.append(counts)
    names = [x.split()[0] for x in COUNTS.split(", ")]
    return {k: np.concatenate([c[k] for c in out]) for k in names}


def judge(df: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the base counts, base_failed, the score ``llr`` and kept, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), **_judged(batch.column(1), ratio, threshold)})

    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run), f"doc_id bigint, {COUNTS}")


def keep(df: DataFrame, ratio: np.ndarray, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose document is kept, all columns as they are."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(_judged(batch.column(at), ratio, threshold)["kept"]))

    return df.mapInArrow(lean(run), df.schema)
