"""Benchmark items inside long documents: size-partitioned MinHash containment.

Sets are distinct five-word shingles (A-Z lower-cased). The Jaccard similarity
of a short item and a long document is tiny even when the document holds the
whole item, so documents are partitioned by set size (powers of two) and each
partition has its own one-permutation MinHash: the number of bins is four to
eight times the partition's sizes, so whatever its length a document keeps the
least hash of nearly every one of its shingles' bins, and a shingle of an item
that the document holds is such a least hash with probability over 0.88. Items
are probed against these signatures by their rarer shingles: of n shingles, of
which containment requires ``needed``, the n - needed + ``SPARE`` that the fewest
items share are indexed. A document that contains the item has ``SPARE`` of them
at least, and it is a candidate if two are found (its miss probability is below
1e-9: SPARE = 12 with 0.88 each). So a passage that very many items have in
common (an instruction's beginning, say) is hardly ever a key. Items of up to
``TINY`` shingles form a partition in which the signature is the whole set, so
none is missed: n - needed + 1 rarest shingles are indexed, and one is enough.
Every candidate is verified on the words themselves: the share of the item's
shingles that the document holds must reach ``percent``.

An item of fewer than five words is one shingle of its own length, and is looked
for as such in every text: exactly, wherever it stands.

Scale: the items are a stated query set. They are taken in blocks of at most
``ITEMS`` items and about ``SHINGLES`` shingles, each broadcast as one small
index, and each block streams over the documents without a shuffle; a
document is read as a whole by one task.

Defined cases: null or empty texts (of items or documents) have no shingles
and are never found; an item of fewer than five words is its whole sequence of
words, and ``keep`` overlooks it unless it has ``KEEP_WORDS`` (an item of one or
two words stands in clean documents); equal benchmark rows are reported each; empty tables give no
rows; extra columns are ignored by ``find`` and passed through by ``keep``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.minmax import sets_of
from daybook.llm.shared import lean, source
from daybook.llm.textbytes import ragged

SIZE = 5
PERCENT = 80
TINY = 16
#: Indexed shingles that a containing document has at least, for larger items.
SPARE = 12
#: Words an item needs for ``keep`` to act on it.
KEEP_WORDS = 3
ITEMS = 100_000
SHINGLES = 2_000_000

FOUND = "doc_id bigint, item_id bigint, item_shingles bigint, shared bigint"

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_UPPER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
_U64 = np.uint64
_SPOTS = 1 << 20


def exact(text: str, size: int = SIZE) -> set[tuple[str, ...]]:
    """The shingles of a text as words."""
    w = _WORD.findall(text.translate(_UPPER))
    if 0 < len(w) < size:
        return {tuple(w)}
    return set(zip(*(w[k:] for k in range(size)), strict=False)) if w else set()


class Index:
    """Shingles of a block of items, ready to be probed with sorted sets."""

    def __init__(self, items: list[tuple[int | None, str | None]], size: int, percent: int):
        self.items, self.size, self.percent = items, size, percent
        values, owners, sizes = [], [], np.zeros(len(items), np.int64)
        for i, j, found, first in sets_of(pa.array([t for _, t in items], pa.large_string()), size):
            values.append(found)
            sizes[i:j] = np.diff(first)
            owners.append(np.repeat(np.arange(i, j), np.diff(first)))
        flat, owner = np.concatenate([np.empty(0, _U64), *values]), np.concatenate([np.empty(0, np.int64), *owners])
        self.sizes = sizes
        # at least this many shared shingles are needed; of the rarest ones this many are indexed, and must be seen
        needed = -(-percent * sizes // 100)
        tiny = sizes <= TINY
        indexed, self.seen = sizes - needed + np.where(tiny, 1, SPARE), np.where(tiny, 1, 2)
        _, code, often = np.unique(flat, return_inverse=True, return_counts=True)
        order = np.lexsort((flat, often[code], owner))  # each item's shingles, the rarest first
        flat, owner = flat[order], owner[order]
        rank = np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]
        chosen = rank < indexed[owner]
        flat, owner = flat[chosen], owner[chosen]
        self.tables = []
        for part in (~tiny[owner], tiny[owner]):
            order = np.lexsort((owner[part], flat[part]))
            keys, begin = np.unique(flat[part][order], return_index=True)
            spot = np.zeros(_SPOTS, np.bool_)
            spot[(keys & _U64(_SPOTS - 1)).astype(np.int64)] = True
            self.tables.append((keys, np.append(begin, part.sum()), owner[part][order], spot))

    def _hits(self, table: int, values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, item) of every value that an item has."""
        keys, begin, items, spot = self.tables[table]
        if not len(keys):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        some = np.flatnonzero(spot[(values & _U64(_SPOTS - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(keys, values[some]), len(keys) - 1)
        real = keys[at] == values[some]
        some, at = some[real], at[real]
        many = begin[at + 1] - begin[at]
        return np.repeat(owner[some], many), items[ragged(begin[at], many)]

    def candidates(self, values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, item) pairs whose signatures meet."""
        count = np.diff(first)
        owner = np.repeat(np.arange(len(count)), count)
        # the partition of a set of n shingles: 2^p <= n < 2^(p + 1); 2^(p + 3) bins by the leading bits
        power = np.maximum(np.ceil(np.log2(np.maximum(count, 1) + 1)).astype(np.int64) - 1, 0)
        bins = values >> (48 - np.minimum(power + 3, 48))[owner].astype(_U64)
        least = np.ones(len(values), np.bool_)  # sets are ascending, so a bin's first value is its least
        least[1:] = (bins[1:] != bins[:-1]) | (owner[1:] != owner[:-1])
        a, b = self._hits(0, values[least], owner[least]), self._hits(1, values, owner)
        pair, times = np.unique(np.concatenate((a[0], b[0])) * len(self.items) + np.concatenate((a[1], b[1])), return_counts=True)
        row, item = pair // max(len(self.items), 1), pair % max(len(self.items), 1)
        enough = times >= self.seen[item]
        return row[enough], item[enough]

    def found(self, column: pa.Array) -> Iterator[tuple[int, int, int, int]]:
        """(row, item, item's shingles, shared) of each verified containment."""
        for i, _, values, first in sets_of(column, self.size):
            rows, items = self.candidates(values, first)
            last, held = -1, set()
            for row, item in zip(rows.tolist(), items.tolist(), strict=True):
                if row != last:
                    last, held = row, exact(column[i + row].as_py(), self.size)
                mine = exact(self.items[item][1], self.size)
                shared = len(mine & held)
                if 100 * shared >= self.percent * len(mine):
                    yield i + row, item, len(mine), shared


def indexes(items: DataFrame, item_id: str = "item_id", item_text: str = "text", size: int = SIZE, percent: int = PERCENT, least: int = 1) -> Iterator[Index]:
    """The items of at least ``least`` words in blocks of a bounded size, those of fewer than ``size`` words by their own length."""
    blocks: dict[int, list[tuple[int | None, str | None]]] = {}
    held: dict[int, int] = {}
    for row in items.select(F.col(item_id).cast("bigint"), F.col(item_text).cast("string")).toLocalIterator():
        words = len(_WORD.findall(row[1] or ""))
        if words < max(least, 1):
            continue
        own = min(words, size)
        if blocks.get(own) and (len(blocks[own]) >= ITEMS or held[own] + words > SHINGLES):
            yield Index(blocks.pop(own), own, percent)
        if not blocks.get(own):
            blocks[own], held[own] = [], 0
        blocks[own].append((row[0], row[1]))
        held[own] += words
    for own, block in sorted(blocks.items()):
        yield Index(block, own, percent)


def find(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, item_id, item_shingles and shared of every item that a document contains."""
    texts = source(df, id_col, text_col)
    out = None
    for index in indexes(items, size=size, percent=percent):
        held = df.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(held.value.found(batch.column("text")))
                if found:
                    row, item, size, shared = (list(c) for c in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(row)), pa.array([held.value.items[k][0] for k in item], pa.int64()), pa.array(size, pa.int64()), pa.array(shared, pa.int64())],
                        ["doc_id", "item_id", "item_shingles", "shared"],
                    )

        part = texts.mapInArrow(lean(run), FOUND)
        out = part if out is None else out.union(part)
    return out if out is not None else df.sparkSession.createDataFrame([], FOUND)


def keep(df: DataFrame, items: DataFrame, text_col: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The rows that contain no item, all columns as they are."""
    at = df.columns.index(text_col)
    for index in indexes(items, size=size, percent=percent, least=KEEP_WORDS):
        held = df.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, np.bool_)
                clean[[f[0] for f in held.value.found(batch.column(at))]] = False
                yield batch.filter(pa.array(clean))

        df = df.mapInArrow(lean(run), df.schema)
    return df
