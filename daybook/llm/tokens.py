"""Byte-level BPE over whole batches.

The tokenizers library encodes every distinct piece of text once for each
Python worker; numpy splits the texts into those pieces (the vocabulary's
published pattern: contractions, letters, numbers, other signs, white space)
and puts the ids together. ``tests/llm`` holds the ids against the library's
own encoding of the whole texts. ``encoder`` gives the ids of the library's
``encode(text, add_special_tokens=False)`` with its default settings: a string
of one of the file's added tokens in a text is that token. Letters and numbers
are those of the library's own patterns. Files whose tokens or steps are not of
the plain kind are left to the library as a whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa

from daybook.llm.textbytes import mix, ragged

#: Texts taken from an Arrow batch at once.
ROWS = 512
#: Characters encoded at once, and distinct pieces a worker remembers.
CHARS = 1 << 18
REMEMBERED = 100_000

_LETTER, _NUMBER, _SPACE, _OTHER, _END = 0, 1, 2, 3, 4
_U64 = np.uint64
_BASE = 0xC2B2AE3D27D4EB4F | 1

# fixed values: Unicode White_Space
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# fixed values: the pattern's contractions, after the apostrophe
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class (by the library's patterns) and hash value of each code point."""
    from tokenizers import Regex, pre_tokenizers

    kinds = np.full(0x110000, _OTHER, np.uint8)
    # no surrogates, and none of the planes that Unicode leaves empty or private
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x40000), np.arange(0xE0000, 0xF0000)])
    every = points.astype("<u4").tobytes().decode("utf-32-le")
    for kind, name in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
        for _, (i, j) in pre_tokenizers.Split(Regex(name), "removed", invert=True).pre_tokenize_str(every):
            kinds[points[i:j]] = kind
    kinds[WHITE_SPACE] = _SPACE
    return kinds, mix(np.arange(1, 0x110001, dtype=_U64) * _U64(0xD1342543DE82EF95))


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for step in (_BASE, pow(_BASE, -1, 1 << 64)):
        x = np.full(n, step, _U64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


@lru_cache(1)
def _byte_letters() -> list[str]:
    """Byte-level BPE writes each byte as one printable character."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def pieces(joined: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of texts that each end with one extra character at ``ends``.

    Returns code points, and starts and ends of the pieces among them.
    """
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _tables()[0][points]
    kind[ends] = _END
    new = np.ones(len(kind), np.bool_)
    new[1:] = kind[1:] != kind[:-1]
    new[ends] = True
    space = kind == _SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:])  # a run's last white space
    inner = last[kind[last + 1] != _END]
    new[inner] = True
    joins = inner[points[inner] == 0x20]
    new[joins + 1] = False  # " word" is one piece
    marks = np.flatnonzero((points == 0x27) & new)
    for i in marks[kind[marks + 1] == _LETTER].tolist():
        after = joined[i + 1 : i + 3]
        for suffix in CONTRACTIONS:
            if after.startswith(suffix):
                new[i + 1] = False
                stop = i + 1 + len(suffix)
                new[stop] = True
                # a space there starts its own piece already; letters go on as a new one
                break
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(kind))
    real = kind[start] != _END
    return points, start[real], end[real]


class Encoder:
    """Texts to ids with a tokenizers file of byte-level BPE.

    With ``added``, strings of the file's added tokens are those tokens;
    without it they are ordinary text.
    """

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        self.model, self.size = whole.model, whole.get_vocab_size()
        tokens = whole.get_added_tokens_decoder() if added else {}
        self.added = {t.content: i for i, t in tokens.items()}
        # the longest of those that start at the same place
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if tokens else None
        file = json.loads(whole.to_str())
        before = file["pre_tokenizer"] or {}
        plain = file["normalizer"] is None and before.get("type") == "ByteLevel" and not before["add_prefix_space"] and before.get("use_regex", True)
        plain = plain and not any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in tokens.values())
        self.library = whole if added and not plain else None
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.start = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int32)
        self.flat = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def _learn(self, keys: list[int], strings: list[str]) -> None:
        letters, model = _byte_letters(), self.model
        ids = [[t.id for t in model.tokenize("".join([letters[b] for b in s.encode("utf-8", "replace")]))] for s in strings]
        n, total = len(self.known), sum(map(len, ids))
        while n + len(ids) > len(self.start):
            self.start, self.count = (np.concatenate((x, np.zeros_like(x))) for x in (self.start, self.count))
        while self.used + total > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        self.count[n : n + len(ids)] = count
        self.start[n : n + len(ids)] = self.used + np.cumsum(count) - count
        self.flat[self.used : self.used + total] = [t for x in ids for t in x]
        self.used += total
        self.known.update(zip(keys, range(n, n + len(ids)), strict=True))

    def encoded(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``encode`` for ``ROWS`` texts of an Arrow column at a time: first and last row, ids, offsets."""
        for i in range(0, len(column), ROWS):
            part = column.slice(i, ROWS)
            yield i, i + len(part), *self.encode(part.to_pylist())

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts back to back (uint32) and the n + 1 offsets; a null is empty."""
        if self.library is not None:
            ids = [np.array(self.library.encode(x or "", add_special_tokens=False).ids, np.uint32) for x in texts]
            return np.concatenate([np.empty(0, np.uint32), *ids]), np.cumsum([0, *map(len, ids)])
        if not any(t in x for x in texts if x for t in self.added):
            return self._plain(texts)
        parts = [self.split.split(x or "") for x in texts]  # text, token, text, ... text
        ids, ends = self._plain([x for p in parts for x in p[::2]])
        many = np.fromiter((len(p) // 2 for p in parts), np.int64, len(parts))
        last = np.cumsum(many + 1)
        tokens = [self.added[t] for p in parts for t in p[1::2]]
        ids = np.insert(ids, np.delete(ends, np.append(0, last)), np.array(tokens, np.uint32))
        return ids, np.append(0, ends[last] + np.cumsum(many))

    def _plain(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        flat, offsets = [], [np.zeros(1, np.int64)]
        i, at = 0, 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j] or "") <= CHARS):
                size += len(texts[j] or "")
                j += 1
            ids, ends = self._encode(texts[i:j])
            flat.append(ids)
            offsets.append(ends + at)
            i, at = j, at + len(ids)
        return np.concatenate([np.empty(0, np.uint32), *flat]), np.concatenate(offsets)

    def _encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        joined = "\0".join([x or "" for x in texts]) + "\0"
        ends = np.cumsum(np.fromiter((len(x or "") + 1 for x in texts), np.int64, len(texts))) - 1
        points, start, end = pieces(joined, ends)
        if not len(start):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        up, down = _powers(1 << max(CHARS + 64, len(points) + 1).bit_length())
        sums = np.zeros(len(points) + 1, _U64)
        np.cumsum(_tables()[1][points] * up[: len(points)], out=sums[1:])
        key = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(_U64))
        code, distinct = pd.factorize(key)
        if len(self.known) > REMEMBERED:
            self._forget()
        keys = distinct.tolist()
        index = np.fromiter((self.known.get(k, -1) for k in keys), np.int64, len(keys))
        fresh = np.flatnonzero(index < 0)
        if len(fresh):
            seen = np.empty(len(keys), np.int64)
            seen[code[::-1]] = np.arange(len(code) - 1, -1, -1)
            self._learn([keys[k] for k in fresh.tolist()], [joined[start[p] : end[p]] for p in seen[fresh].tolist()])
            index[fresh] = np.arange(len(self.known) - len(fresh), len(self.known))
        index = index[code]
        count = self.count[index].astype(np.int64)
        ids = self.flat[ragged(self.start[index], count)]
        total = np.concatenate(([0], np.cumsum(count)))
        return ids, total[np.searchsorted(start, ends)]


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One encoder for each file and Python worker, with the file's added tokens."""
    return Encoder(path, added=True)
