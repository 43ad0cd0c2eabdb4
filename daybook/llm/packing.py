"""Sum-of-squares online packing of tokenised documents into windows.

Each document's ids, with the end id, come in one after another. Full windows
are cut off a document first; what is left (1 to window - 1 ids) is placed,
uncut, by the sum-of-squares rule: with N(h) the number of open sequences
filled to level h, choose the level (or a new sequence) whose change keeps
the sum of N(h)^2 over the partially filled levels least, ties to the fullest.
The counts are one array over the levels, so a placement looks at ``window``
numbers whatever the number of open sequences.

At the end of a task the sequences that stayed open are closed without padding:
the fullest stay as the rule filled them and are topped up with what is cut off
the emptiest, until those are used up; what the last one cannot fill goes out
in lengths that are powers of two. So only the emptiest sequences are cut anew
(about a quarter of the open ids, whose levels are spread evenly), and no
sequence is padded. ``SumOfSquares.cut`` counts those ids. The share falls as a
task holds more documents; the README states it.

Scale: each input split is packed in its own task, without any shuffle; a
task keeps the pieces of its open sequences only. The same split gives the
same pieces on a second attempt; sequence_id is (task << 32) + its number.

Defined cases: a null or empty text is the end id alone; null and repeated
doc_ids are packed like any other row; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from daybook.llm.shared import lean, source
from daybook.llm.tokens import encoder

PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
#: Bytes of ids in an output batch.
OUT = 8 << 20

Piece = tuple[int | None, int, int, np.ndarray]  # doc_id, start, doc_tokens, ids


class SumOfSquares:
    """The level array and the open sequences."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(window)]
        self.cut = 0  # ids that did not stay where the rule placed them

    def level(self, size: int) -> int:
        """The level (0: a new sequence) that a piece of ``size`` ids goes to."""
        window, count = self.window, self.count
        top = window - size
        after = count[size + 1 : window + 1].copy()  # counts of the levels reached from 1..top
        here = count[1 : top + 1]
        # (after + 1)^2 - after^2 + (here - 1)^2 - here^2; a full sequence no longer counts
        change = 2 * (after - here) + 2
        if top >= 1:
            change[-1] = 1 - 2 * here[-1]
        change[here == 0] = np.iinfo(np.int64).max
        fresh = 2 * count[size] + 1 if size < window else 0
        if top < 1:
            return 0
        best = top - 1 - int(np.argmin(change[::-1]))
        return best + 1 if change[best] <= fresh else 0

    def place(self, piece: Piece) -> list[Piece] | None:
        """Place one piece; the sequence if that made it full."""
        size = len(piece[3])
        at = self.level(size)
        if at:
            pieces = self.open[at].pop()
            self.count[at] -= 1
        else:
            pieces = []
        pieces.append(piece)
        if at + size == self.window:
            return pieces
        self.open[at + size].append(pieces)
        self.count[at + size] += 1
        return None

    def drain(self) -> Iterator[list[Piece]]:
        """Close what is still open: the fullest topped up from the emptiest, the rest in powers of two."""
        left = [pieces for level in reversed(self.open) for pieces in reversed(level)]  # the fullest first
        self.open, self.count[:] = [[] for _ in range(self.window)], 0
        i, j = 0, len(left) - 1
        while i <= j:
            room = self.window - sum(len(p[3]) for p in left[i])
            while room and i < j:
                doc, start, tokens, ids = left[j].pop()
                part = ids[:room]
                if len(part) < len(ids):
                    left[j].append((doc, start + len(part), tokens, ids[len(part) :]))
                left[i].append((doc, start, tokens, part))
                room, self.cut = room - len(part), self.cut + len(part)
                j -= not left[j]
            if room:
                yield from self._powers(left[i])
            else:
                yield left[i]
            i += 1

    def _powers(self, pieces: list[Piece]) -> Iterator[list[Piece]]:
        total = sum(len(p[3]) for p in pieces)
        self.cut += total
        i = used = 0
        for size in [1 << b for b in range(total.bit_length(), -1, -1) if total >> b & 1]:
            out, room = [], size
            while room:
                doc, start, tokens, ids = pieces[i]
                part = ids[used : used + room]
                out.append((doc, start + used, tokens, part))
                room, used = room - len(part), used + len(part)
                if used == len(ids):
                    i, used = i + 1, 0
            yield out


def sequences(documents: Iterator[tuple[int | None, np.ndarray]], window: int) -> Iterator[list[Piece]]:
    """Sequences of pieces, in the order in which they become full."""
    bins = SumOfSquares(window)
    for doc, ids in documents:
        n = len(ids)
        whole = n // window * window
        for start in range(0, whole, window):
            yield [(doc, start, n, ids[start : start + window])]
        if whole < n and (full := bins.place((doc, whole, n, ids[whole:].copy()))):
            yield full
    yield from bins.drain()


def pack(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048, end_id: int = 1) -> DataFrame:
    """One row for each piece: its ids (little-endian uint32), document, sequence and place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, base = encoder(tokenizer), TaskContext.get().partitionId() << 32

        def documents() -> Iterator[tuple[int | None, np.ndarray]]:
            for batch in batches:
                for i, j, ids, offsets in coder.encoded(batch.column("text")):
                    ids = np.insert(ids, offsets[1:], end_id)
                    ends = (offsets + np.arange(len(offsets))).tolist()
                    for doc, a, b in zip(batch.column("doc_id").slice(i, j - i).to_pylist(), ends, ends[1:], strict=False):
                        yield doc, ids[a:b]

        rows: list[tuple] = []
        held = 0
        for number, sequence in enumerate(sequences(documents(), window)):
            offset = 0
            for doc, start, tokens, ids in sequence:
                rows.append((doc, start, len(ids), tokens, base + number, offset, ids.astype("<u4").tobytes()))
                offset += len(ids)
            held += offset * 4
            if held >= OUT:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)

    return source(df, id_col, text_col).mapInArrow(lean(run), PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    kinds = [pa.int64()] * 6 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
