"""License scan by fuzzy search for short notices.

Texts are brought to words: A-Z lower-cased, runs of digits, letters a-z and
non-ASCII characters, one space between two words. A notice is a short string
of such words with a number k of edits (characters inserted, left out or
replaced) that it may be away from a place.

1. Seeds: a notice is cut into k + 1 pieces. A place within k edits holds one
   of them as it is (pigeonhole), and the piece's position bounds the place. All
   pieces are searched as exact strings over a whole batch of texts at once.
2. Verification: around each seed found, a window of the notice's length and k
   characters more on both sides is looked at. One bit-parallel pass gives the
   least edits of the notice in it; a window over k is dropped. The regex
   library's bounded-error matching, bounded by that least number, then verifies
   the edits and reports the span (bounded by k instead it takes some hundred
   times as long).

Base phrases are notices of no edits that must begin and end with a word; all
their places are reported. Other notices may lie anywhere in the words; of
overlapping places of the same notice the first verified one is reported, so
each window that no reported place touches has been verified. Labels do not
depend on that choice.

Places are spans: label, notice, first and last word (from 0), start and end
character of the text as it was given, and edits. ``score`` is the greatest
1 - edits / length of the notice among a row's places, 0 without a place.

Scale: one pass over the texts, no shuffle; what a task holds is bounded by
its batch, or by its longest single text.

Defined cases: a null or empty text, or one without a word, has no place,
no words and score 0; rows that share an id, or have none, are answered each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.runs import LOWER_OR_DIGIT, runs
from daybook.llm.shared import lean, source
from daybook.llm.textbytes import LOWER, chunks, texts_of


@dataclass(frozen=True)
class Notice:
    """A short notice (words with one space between), its label and the edits allowed; a base one is a phrase of whole words."""

    label: str
    text: str
    edits: int = 0
    base: bool = False


#: The phrases and labels that must be found as they are.
PHRASES = (
    Notice("mit", "mit license", base=True),
    Notice("apache", "apache license", base=True),
    Notice("gpl", "general public license", base=True),
)

#: Notices that may be a few edits away, and the labels they stand for.
NOTICES = (
    Notice("agpl", "gnu affero general public license", 3),
    Notice("apache", "licensed under the apache license version 2 0", 4),
    Notice("apache", "you may not use this file except in compliance with the license", 6),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 9),
    Notice("bsd", "released under the bsd license", 2),
    Notice("cc by", "licensed under cc by 4 0", 1),
    Notice("cc by nc", "licensed under cc by nc 4 0", 1),
    Notice("cc by sa", "licensed under cc by sa 4 0", 1),
    Notice("creative commons", "creative commons attribution", 2),
    Notice("cc0", "to the extent possible under law the author has waived all copyright", 6),
    Notice("gpl", "licensed under the gnu general public license", 4),
    Notice("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", 9),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", 7),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 7),
    Notice("mit", "released under the mit license", 2),
    Notice("mpl", "this source code form is subject to the terms of the mozilla public license", 7),
    Notice("proprietary", "all rights reserved", 1),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 7),
)

_SPANS = "array<struct<label: string, notice: string, base: boolean, first_word: bigint, last_word: bigint, start: bigint, stop: bigint, edits: int>>"
_SPAN = pa.struct([("label", pa.string()), ("notice", pa.string()), ("base", pa.bool_()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("edits", pa.int32())])


def pieces(notice: Notice) -> list[tuple[int, str]]:
    """Offsets and texts of the notice's k + 1 pieces, of nearly equal length."""
    k, n = notice.edits + 1, len(notice.text)
    if n < k:
        raise ValueError(f"notice {notice.text!r} is too short for {notice.edits} edits")
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, notice.text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class _Distance:
    """Least edits of a notice within a window, one step of whole-word bit operations for each character."""

    def __init__(self, text: str):
        self.size, self.full, self.top = len(text), (1 << len(text)) - 1, 1 << (len(text) - 1)
        self.at: dict[str, int] = {}
        for i, c in enumerate(text):
            self.at[c] = self.at.get(c, 0) | 1 << i

    def least(self, window: str) -> int:
        plus, minus, score, best, full = self.full, 0, self.size, self.size, self.full
        for c in window:
            same = self.at.get(c, 0)
            diagonal = (((same & plus) + plus) ^ plus) | same | minus
            more, less = minus | (full & ~(diagonal | plus)), plus & diagonal
            if more & self.top:
                score += 1
            elif less & self.top:
                score -= 1
                best = min(best, score)
            more, less = more << 1 & full, less << 1 & full  # a match may begin anywhere
            plus, minus = less | (full & ~(diagonal | more)), more & diagonal
        return best


class _Search:
    """Compiled notices: places in a string of words, texts apart by line feeds."""

    def __init__(self, notices: Sequence[Notice]) -> None:
        self.notices = list(dict.fromkeys(notices))
        self.seeds: dict[str, list[tuple[int, int]]] = {}
        self.exact, self.distance = [], [_Distance(n.text) for n in self.notices]
        self.compiled: dict[tuple[int, int], regex.Pattern] = {}
        for i, notice in enumerate(self.notices):
            for offset, piece in pieces(notice):
                self.seeds.setdefault(piece, []).append((i, offset))
            exact = regex.escape(notice.text, literal_spaces=True)
            self.exact.append(rf"(?<![^ \n]){exact}(?![^ \n])" if notice.base else exact)

    def fuzzy(self, i: int, edits: int) -> regex.Pattern:
        """Notice i with that many errors at most."""
        if (i, edits) not in self.compiled:
            self.compiled[i, edits] = regex.compile(rf"(?:{self.exact[i]}){{e<={edits}}}" if edits else self.exact[i])
        return self.compiled[i, edits]

    def candidates(self, words: str) -> dict[int, list[tuple[int, int]]]:
        """For each notice the starts that seeds suggest, ascending, each with the place of its seed."""
        found: dict[int, set[tuple[int, int]]] = {}
        for piece, uses in self.seeds.items():
            at = words.find(piece)
            while at >= 0:
                for i, offset in uses:
                    found.setdefault(i, set()).add((at - offset, at))
                at = words.find(piece, at + 1)
        return {i: sorted(starts) for i, starts in found.items()}

    def places(self, words: str) -> Iterator[tuple[int, int, int, int]]:
        """(notice, start, stop, edits) of every place, by notice and start."""
        for i, starts in sorted(self.candidates(words).items()):
            notice, done = self.notices[i], 0
            k, n = notice.edits, len(notice.text)
            for at, seed in starts:
                if notice.base:
                    hit = self.fuzzy(i, 0).match(words, at)  # sees the signs around it, for the words' ends
                elif seed < done:
                    continue
                else:
                    low, high = max(at - k, done), at + n + k
                    low = max(low, words.rfind("\n", low, seed) + 1)  # a place lies within one text
                    end = words.find("\n", seed, high)
                    high = min(high, len(words)) if end < 0 else end
                    edits = self.distance[i].least(words[low:high])
                    hit = self.fuzzy(i, edits).search(words, low, high) if edits <= k else None
                if hit and hit[0].strip():
                    done = hit.end()
                    blank = len(hit[0]) - len(hit[0].lstrip()), len(hit[0]) - len(hit[0].rstrip())
                    yield i, hit.start() + blank[0], hit.end() - blank[1], sum(hit.fuzzy_counts)


def _joined(data: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts as one string, and per word: start in it, start and end in the bytes; each text's first word."""
    solid = LOWER_OR_DIGIT[data]
    start, end, at = runs(solid, offsets)
    if not len(start):
        return "", start, start, end, at
    keep = np.flatnonzero(solid)
    size = end - start
    begin = np.concatenate(([0], np.cumsum(size + 1)[:-1]))  # one sign behind each word
    out = np.full(int(begin[-1] + size[-1]), 0x20, np.uint8)
    out[np.arange(len(keep)) + np.repeat(np.arange(len(start)), size)] = data[keep]
    heads = at[1:-1]
    heads = heads[(heads > 0) & (heads < len(start))]
    out[begin[heads] - 1] = 0x0A  # before the first word of each text but the first
    # places in the string count characters, not bytes
    character = np.cumsum((out & 0xC0) != 0x80) - 1
    return out.tobytes().decode("utf-8", "replace"), character[begin], start, end, at


def places(df: DataFrame, notices: Sequence[Notice] = (*PHRASES, *NOTICES), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words and places (spans) of every row."""
    notices = tuple(notices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(notices)
        for batch in batches:
            data, offsets = texts_of(batch.column("text"))
            for i, j in chunks(offsets):
                part, cuts = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                words, begin, start, end, at = _joined(LOWER[part], cuts)
                spans: list[list[dict]] = [[] for _ in range(j - i)]
                for which, low, high, edits in search.places(words):
                    first = int(np.searchsorted(begin, low, "right")) - 1
                    last = int(np.searchsorted(begin, high)) - 1
                    doc = int(np.searchsorted(at, first, "right")) - 1
                    head = part[cuts[doc] : end[last]]
                    new = (head & 0xC0) != 0x80
                    notice = search.notices[which]
                    spans[doc].append({
                        "label": notice.label, "notice": notice.text, "base": notice.base, "first_word": first - int(at[doc]), "last_word": last - int(at[doc]),
                        "start": int(new[: start[first] - cuts[doc]].sum()), "stop": int(new.sum()), "edits": edits,
                    })
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(np.diff(at), pa.int64()), pa.array(spans, pa.list_(_SPAN))], ["doc_id", "n_words", "places"])

    return source(df, id_col, text_col).mapInArrow(lean(run), f"doc_id bigint, n_words bigint, places {_SPANS}")


def scan(df: DataFrame, notices: Sequence[Notice] = (*PHRASES, *NOTICES), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and places of every row."""
    base = F.filter("places", lambda p: p["base"])
    score = F.array_max(F.transform("places", lambda p: 1 - p["edits"] / F.char_length(p["notice"])))
    return places(df, notices, id_col, text_col).select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["first_word"])).alias("first_word"), F.array_max(F.transform(base, lambda p: p["first_word"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(base, lambda p: p["label"]))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"]))), ",").alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"), "places",
    )
