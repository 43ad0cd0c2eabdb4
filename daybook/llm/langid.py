"""Word-level language labels by a linear-chain conditional random field.

A text's lines are the chains, its letter runs (lower-cased) the words. A
word's emission score for each language adds the learned weights of its affix
and n-gram features (hashed byte 2- to 4-grams of the word between a start
and an end mark, so those at a mark are its prefixes and suffixes), averaged,
and of its lexicon entry; transition weights between the labels of
neighbouring words are learned with them. Forward-backward gives each word's
posterior over the languages; a document's language is the one with the
greatest mean posterior over its words, and that mean is its score. So text
that switches between languages is labelled word by word.

Training is weakly supervised: the words of a sampled document carry the
document's language. Every ``MIX``-th chain is joined with the next chain of
another language, so that switches occur. The objective is the conditional
log-likelihood with an L2 penalty, climbed by ``STEPS`` AdaGrad steps over the
whole sample. The sample is bounded: about ``MAX_DOCS`` documents of each
language, those with the least hashes of id and text, of at most ``MAX_CHARS``
characters each (a longer one is labelled like any other, but not learned from;
a language with longer ones only is not learned); equal rows count once. The
sample is all that reaches the driver. The hash table and the
``LEXICON`` most frequent words bound the model, which is broadcast.

Scale: one pass to count languages, one to fetch the sample, one to label;
no shuffle of texts. Chains are worked on side by side, one numpy step for
each position, so a long line costs steps and no memory.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
equal scores go to the first language in order; without any labelled document
every row is ``und``; repeated rows are labelled alike; null ids are kept;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.textbytes import chunks, hashes, prefix, ragged, texts_of, words

MAX_DOCS = 150
MAX_CHARS = 200_000
LEXICON = 4000
BITS = 16
GRAMS = (2, 3, 4)
MIX = 5
STEPS = 15
RATE = 0.5
PENALTY = 1e-3
#: Weight of the averaged n-gram score against the lexicon's.
GAIN = 6.0
#: Bytes of text labelled at once.
AT_ONCE = 2 << 20

# letters lower-cased, bytes of longer characters kept, all else a space
_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[0x61:0x7B] = _LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def _letters(data: np.ndarray) -> np.ndarray:
    out = _LETTERS[data]
    # the capitals of U+00C0 - U+00DE (but not U+00D7) follow 0xC3
    upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[upper] += 0x20
    return out


@dataclass
class Chains:
    """Words of some texts: distinct words and, for each occurrence, which one it is."""

    start: np.ndarray  # of each occurrence, into the texts' bytes
    end: np.ndarray
    code: np.ndarray  # distinct word of each occurrence
    key: np.ndarray  # hash of each distinct word
    gram: np.ndarray  # hashed features of the distinct words, back to back
    owner: np.ndarray  # distinct word of each feature
    at: np.ndarray  # first occurrence of each text (one more)
    chain: np.ndarray  # first occurrence of each chain


def chains(data: np.ndarray, offsets: np.ndarray) -> Chains:
    clean = _letters(data) if len(data) else data
    start, end, at = words(clean, offsets)
    code, key = pd.factorize(hashes(prefix(clean), start, end))
    first = np.empty(len(key), np.int64)
    first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    # distinct words between marks
    size = (end - start)[first]
    marked = np.full(int((size + 2).sum()), 2, np.uint32)
    begin = np.cumsum(size + 2) - (size + 2)
    marked[ragged(begin + 1, size)] = clean[ragged(start[first], size)]
    marked[begin + size + 1] = 3
    gram, owner = [], []
    for n in GRAMS:
        many = np.maximum(size + 3 - n, 0)
        here = ragged(begin, many)
        x = np.full(len(here), n, np.uint32)
        for k in range(n):
            x = x * np.uint32(0x01000193) + marked[here + k]
        gram.append((x * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS)).astype(np.int64))
        owner.append(np.repeat(np.arange(len(key)), many))
    lines = np.concatenate((offsets[:-1], np.flatnonzero(data == 10) + 1))
    chain = np.unique(np.searchsorted(start, lines))
    return Chains(start, end, code, key, np.concatenate(gram), np.concatenate(owner), at, chain[chain < len(start)])


@dataclass
class Model:
    labels: list[str]
    lexicon: np.ndarray  # hashes of words, ascending
    grams: np.ndarray  # weights: hash value x label
    entries: np.ndarray  # weights: lexicon entry (the last: any other word) x label
    steps: np.ndarray  # weights: label x next label
    first: np.ndarray  # weights of a chain's first label

    def _entry(self, c: Chains) -> np.ndarray:
        if not len(self.lexicon):
            return np.zeros(len(c.key), np.int64)
        spot = np.minimum(np.searchsorted(self.lexicon, c.key), len(self.lexicon) - 1)
        return np.where(self.lexicon[spot] == c.key, spot, len(self.lexicon))

    def emissions(self, c: Chains) -> np.ndarray:
        """Scores of the distinct words."""
        k, n = len(self.labels), len(c.key)
        many = np.maximum(np.bincount(c.owner, minlength=n), 1)
        out = np.empty((n, k))
        for i in range(k):
            out[:, i] = np.bincount(c.owner, self.grams[c.gram, i], minlength=n)
        return out * (GAIN / many)[:, None] + self.entries[self._entry(c)]

    def posterior(self, c: Chains, expected: np.ndarray | None = None) -> np.ndarray:
        """Posterior of each occurrence's label by forward-backward; adds pair posteriors to ``expected``."""
        score = self.emissions(c)
        weight = np.exp(score - score.max(1, keepdims=True))[c.code] if len(score) else score
        size = np.diff(np.append(c.chain, len(c.code)))
        order = np.argsort(-size, kind="stable")
        begin, size = c.chain[order], size[order]
        longest = int(size[0]) if len(size) else 0
        alive = np.searchsorted(-size, -np.arange(longest), "left")  # chains longer than t
        step = np.exp(self.steps)
        ahead, back = np.empty_like(weight), np.ones_like(weight)
        for t in range(longest):
            here = begin[: alive[t]] + t
            x = weight[here] * ((ahead[here - 1] @ step) if t else np.exp(self.first))
            ahead[here] = x / x.sum(1, keepdims=True)
        for t in range(longest - 2, -1, -1):
            here = begin[: alive[t + 1]] + t
            after = weight[here + 1] * back[here + 1]
            x = after @ step.T
            total = x.sum(1, keepdims=True)
            back[here] = x / total
            if expected is not None:
                norm = (ahead[here] * x).sum(1, keepdims=True)
                expected += (ahead[here] / norm).T @ after * step
        out = ahead * back
        return out / out.sum(1, keepdims=True)


def train(texts: list[str], langs: list[str]) -> Model:
    """Fit a model on a bounded sample held in memory."""
    labels = sorted(set(langs))
    k = len(labels)
    data, offsets = texts_of(pa.array(texts, pa.large_string()))
    c = chains(data, offsets)
    truth = np.repeat(np.searchsorted(labels, langs), np.diff(c.at)) if k else np.empty(0, np.int64)
    # join every MIX-th chain with the next one of another language: cut both and swap their ends
    swap = np.arange(len(c.code))
    bounds = np.append(c.chain, len(c.code))
    lead = truth[c.chain] if len(c.chain) else truth
    for i in range(0, len(c.chain) - 1, MIX):
        j = i + 1 + int(np.argmax(lead[i + 1 :] != lead[i]))
        if lead[j] != lead[i]:
            n = min(bounds[i + 1] - bounds[i], bounds[j + 1] - bounds[j]) // 2
            a, b = bounds[i] + np.arange(n), bounds[j] + np.arange(n)
            swap[a], swap[b] = swap[b].copy(), swap[a].copy()
    c.code, truth = c.code[swap], truth[swap]
    many = np.bincount(c.code, minlength=len(c.key))
    top = np.sort(c.key[np.lexsort((c.key, -many))[:LEXICON]])
    model = Model(labels, top, np.zeros((1 << BITS, k)), np.zeros((len(top) + 1, k)), np.zeros((k, k)), np.zeros(k))
    if not len(c.code):
        return model
    n, share = len(c.key), GAIN / np.maximum(np.bincount(c.owner, minlength=len(c.key)), 1)
    entry = model._entry(c)
    pairs = np.setdiff1d(np.arange(1, len(c.code)), c.chain)
    seen = np.zeros((k, k))
    np.add.at(seen, (truth[pairs - 1], truth[pairs]), 1)
    params = [model.grams, model.entries, model.steps, model.first]
    squares = [np.full_like(p, 1e-8) for p in params]
    total = len(c.code)
    for _ in range(STEPS):
        expected = np.zeros((k, k))
        post = model.posterior(c, expected)
        gap = -post
        gap[np.arange(total), truth] += 1
        word = np.stack([np.bincount(c.code, gap[:, i], minlength=n) for i in range(k)], 1)
        grams = np.stack([np.bincount(c.gram, (word[:, i] * share)[c.owner], minlength=1 << BITS) for i in range(k)], 1)
        entries = np.stack([np.bincount(entry, word[:, i], minlength=len(top) + 1) for i in range(k)], 1)
        for p, square, slope in zip(params, squares, (grams, entries, seen - expected, gap[c.chain].sum(0)), strict=True):
            slope = slope / total - PENALTY / total * p
            square += slope**2
            p += RATE * slope / np.sqrt(square)
    return model


def fit(df: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = MAX_DOCS) -> Model:
    """Train on about ``max_docs`` documents of each language among the rows that ``may_learn`` allows."""
    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), may_learn.alias("may"))
    rows = rows.where("may and lang is not null and text is not null").where(F.char_length("text") <= MAX_CHARS)
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return train([], [])
    spot = F.pmod(F.xxhash64("doc_id", "lang", "text"), F.lit(1 << 30))
    chosen = F.lit(False)
    for lang, n in sorted(counts.items()):
        chosen = chosen | ((F.col("lang") == lang) & (spot < int(min(1.0, max_docs / n) * (1 << 30))))
    sample = sorted((r["doc_id"] or 0, r["lang"], r["text"]) for r in rows.where(chosen).select("doc_id", "lang", "text").distinct().collect())
    return train([r[2] for r in sample], [r[1] for r in sample])


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", spans: bool = False) -> DataFrame:
    """doc_id, lang_pred, score, n_words and n_switches for every row; with ``spans`` also the runs of equal labels (bytes)."""
    held = df.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id bigint, lang_pred string, score double, n_words bigint, n_switches bigint"
    if spans:
        schema += ", spans array<struct<start: bigint, stop: bigint, lang: string>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            data, offsets = texts_of(batch.column("text"))
            for i, j in chunks(offsets, AT_ONCE):
                part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").slice(i, j - i), **_labelled(part, at, model, spans)})

    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def _labelled(data: np.ndarray, offsets: np.ndarray, model: Model, spans: bool) -> dict:
    c = chains(data, offsets)
    n, many = len(offsets) - 1, np.diff(c.at)
    ascii_letter = np.concatenate(([0], np.cumsum((_LETTERS[data] != 0x20) & (data < 0x80))))
    known = np.diff(ascii_letter[offsets]) > 0
    for d in np.flatnonzero(~known & (many > 0)).tolist():  # letters of other scripts, or signs only
        known[d] = any(map(str.isalpha, data[offsets[d] : offsets[d + 1]].tobytes().decode("utf-8", "replace")))
    known &= len(model.labels) > 0
    out: dict = {}
    if not model.labels or not len(c.code):
        best, score, switches, label = np.zeros(n, np.int64), np.zeros(n), np.zeros(n, np.int64), np.zeros(len(c.code), np.int64)
    else:
        post = model.posterior(c)
        total = np.concatenate((np.zeros((1, post.shape[1])), np.cumsum(post, 0)))
        mean = np.diff(total[c.at], axis=0) / np.maximum(many, 1)[:, None]
        best, score = mean.argmax(1), mean.max(1)
        label = post.argmax(1)
        change = np.zeros(len(label) + 1, np.int64)
        change[1:-1] = label[1:] != label[:-1]
        change[c.at[:-1]] = 0  # not between texts
        change = np.concatenate(([0], np.cumsum(change)))
        switches = change[c.at[1:]] - change[c.at[:-1]]
    out["lang_pred"] = [model.labels[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)]
    out["score"] = np.clip(np.where(known, score, 0.0), 0.0, 1.0)
    out["n_words"], out["n_switches"] = many, switches
    if spans:
        out["spans"] = []
        for d in range(n):
            a, b = c.at[d], c.at[d + 1]
            cut = np.concatenate(([a], a + 1 + np.flatnonzero(label[a + 1 : b] != label[a : b - 1]), [b])) if b > a and known[d] else np.array([a])
            out["spans"].append([{"start": int(c.start[x] - offsets[d]), "stop": int(c.end[y - 1] - offsets[d]), "lang": model.labels[label[x]]} for x, y in zip(cut, cut[1:], strict=False)])
        out["spans"] = pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())])))
    return out
