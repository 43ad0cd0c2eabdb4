"""Repeated byte strings of a corpus by run-length indexes.

Every byte covered by a ``length``-byte string that also starts anywhere else
in the corpus (the same text included) is removed; strings never cross texts,
and are judged on the input. Result: exact, whatever the number of copies.

1. Blocks. The anchor of a ``length``-byte string is the ``GRAM``-byte gram in
   it with the least hash. Consecutive strings with one anchor form a block,
   so equal strings lie in blocks with equal anchors, and only blocks whose
   anchor occurs twice can hold a repeated string; all others end here, as
   hashes.
2. Equal blocks collapse to one with its number of copies, before anything
   else moves. Different blocks are dealt to buckets by their anchor.
3. Index. A bucket's blocks are one text with separators; its suffixes are
   sorted and only the runs of the Burrows-Wheeler transform are kept, with the
   text position, and the common prefix with the neighbouring suffix, sampled
   at both ends of every run. Between samples a match gets one byte shorter
   for each step along the text, so streaming a block through the samples gives
   its matching statistics: at each position the longest match that starts
   anywhere else. A position with ``length`` or more is a repeated string.
4. Marks go back to every block of every text, and the texts lose what is
   marked.

Bounds: an index holds whole anchors, about ``FULL`` symbols or, for one anchor
with many blocks, at most ``BUCKET``. An anchor with more than
``CROWD`` different blocks (a common phrase in many contexts) is not put in
one task: its blocks are cut again by anchors of the next size in ``GRAMS``;
at the last, the string itself, different blocks have different anchors. Hot
anchors and blocks meet their rows in equi-joins that Spark splits. Ids that
restrict a pass over the texts are broadcast up to ``BROADCAST`` rows only;
beyond that the same join shuffles. Blocks meet their anchors in a shuffle at
every size.

Defined cases: a null text counts as empty; texts shorter than ``length`` stay
whole; equal rows are copies of each other, so both lose what they share; null
ids are kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.shared import cut, run_dir
from daybook.llm.textbytes import chunks, hashes, prefix, texts_of

LENGTH = 200
#: Sizes of anchors; the last is the string itself.
GRAMS = (40, 160, 200)
CROWD = 2048
BROADCAST = 500_000
#: Symbols of an index at most: two ranks and a position share a 64-bit word.
BITS = 21
BUCKET = (1 << BITS) - 1
#: Symbols that an index takes before it starts the next (small arrays stay in the processor's cache).
FULL = 1 << 17
#: Bytes of texts that are cut into blocks at once; a longer text is cut in segments.
SEGMENT = 1 << 18

_U64 = np.uint64
_POSITION = _U64((1 << 24) - 1)


def blocks(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first byte, number of strings, anchor and hash of each block."""
    if len(data) < length:
        none = np.empty(0, np.int64)
        return none, none, none, none, none
    sums = prefix(data)
    at = np.arange(len(data) - gram + 1)
    value = hashes(sums, at, at + gram)
    width = length - gram + 1
    # least hash in each window of ``width`` grams, the leftmost of equal ones
    both = (value & ~_POSITION) | at.astype(_U64) & _POSITION
    rows = -(-len(both) // width)
    padded = np.full(rows * width, ~_U64(0))
    padded[: len(both)] = both
    table = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(table, 1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], 1)[:, ::-1].ravel()
    many = len(data) - length + 1
    least = np.minimum(back[:many], ahead[width - 1 : width - 1 + many])
    place = (least & _POSITION).astype(np.int64)
    low = np.arange(many) & int(_POSITION)
    place = np.arange(many) + ((place - low) & int(_POSITION))
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:many]
    valid = np.arange(many) + length <= offsets[owner + 1]
    new = valid.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~valid[:-1] | (owner[1:] != owner[:-1])
    start = np.flatnonzero(new)
    stop = np.append(start[1:], many)
    ending = np.flatnonzero(valid & np.append(~valid[1:], True)) + 1
    last = ending[np.searchsorted(ending, start, "right")] if len(ending) else stop
    n = np.minimum(stop, last) - start
    owner = owner[start]
    return owner, start - offsets[owner], n, value[place[start]].astype(np.int64), hashes(sums, start, start + n + length - 1).astype(np.int64)


class RunLengthIndex:
    """Runs of the Burrows-Wheeler transform of several strings, with samples at both ends of each run.

    ``symbols`` and ``lengths`` are the runs; ``heads`` and ``tails`` the text
    positions of their first and last rows; ``head_common`` and
    ``tail_common`` what those suffixes share with the row before and after.
    """

    def __init__(self, strings: list[bytes]):
        size = np.fromiter(map(len, strings), np.int64, len(strings))
        joined = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        self.size = len(joined)
        if self.size > BUCKET:
            raise ValueError("too many symbols for one index")
        self.stop = np.cumsum(size + 1) - 1  # the separator behind each string
        self.first = self.stop - size
        text = joined.astype(np.uint16) + np.uint16(1)
        text[self.stop] = 0
        end = np.repeat(self.stop, size + 1).astype(np.int32)
        order, levels = self._sorted(text, end, int(size.max(initial=0)))
        before = np.concatenate((text[:1] * 0, text[:-1]))[order]  # the transform
        head = np.ones(self.size, np.bool_)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)  # no string precedes another
        tail = np.append(head[1:], True)
        self.symbols, self.lengths = before[head], np.diff(np.append(np.flatnonzero(head), self.size))
        self.heads, self.tails = order[head], order[tail]
        rows = np.flatnonzero(head)
        self.head_common = self._common(text, end, levels, order, rows - 1, rows)
        rows = np.flatnonzero(tail)
        self.tail_common = self._common(text, end, levels, order, rows, rows + 1)
        self.end = end

    def _sorted(self, text: np.ndarray, end: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """Suffixes up to the end of their string in order, equal ones by position, and their ranks by ever longer prefixes."""
        n, bits = self.size, _U64(BITS)
        at = np.arange(n, dtype=np.int32)
        # as many symbols as fit beside the position: the bytes that occur, in order
        dense = np.cumsum(np.bincount(text, minlength=257) > 0) - 1
        code, wide = dense.astype(_U64)[text], max(1, int(dense[-1]).bit_length())
        span = (64 - BITS) // wide
        key = np.zeros(n, _U64)
        for k in range(span):
            key <<= _U64(wide)
            key |= code[np.minimum(at + k, end)]
        both = np.sort(key << bits | at.astype(_U64))
        order = (both & _U64(BUCKET)).astype(np.int32)
        both >>= bits
        rank = np.empty(n, np.int32)
        rank[order] = np.cumsum(np.append(False, both[1:] != both[:-1]), dtype=np.int32)
        levels = [(span, rank)]
        while span < longest:
            ranked = rank[order]
            new = np.append(False, ranked[1:] != ranked[:-1])
            same = ~new
            same[0] = False
            same[:-1] |= same[1:].copy()
            rows = np.flatnonzero(same)  # only suffixes that share their rank
            if not len(rows):
                break
            part = order[rows]
            spot = part + np.int32(span)
            after = np.where(spot <= end[part], rank[np.minimum(spot, n - 1)] + 1, 0)
            both = np.sort(ranked[rows].astype(_U64) << _U64(2 * BITS) | after.astype(_U64) << bits | part.astype(_U64))
            order[rows] = (both & _U64(BUCKET)).astype(np.int32)
            both >>= bits
            new[rows[1:]] |= both[1:] != both[:-1]
            rank = np.empty(n, np.int32)
            rank[order] = np.cumsum(new, dtype=np.int32)
            span *= 2
            levels.append((span, rank))
        return order, levels

    def _common(self, text: np.ndarray, end: np.ndarray, levels: list[tuple[int, np.ndarray]], order: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes in two rows (0 outside the index)."""
        out = np.zeros(len(upper), np.int64)
        real = np.flatnonzero((upper >= 0) & (lower < self.size))
        a, b = order[upper[real]].astype(np.int64), order[lower[real]].astype(np.int64)
        most = np.minimum(end[a] - a, end[b] - b)
        got = np.zeros(len(a), np.int64)
        for span, rank in reversed(levels):  # equal ranks: equal for ``span`` symbols, or to the ends of both
            open_ = np.flatnonzero(got < most)
            x, y = a[open_] + got[open_], b[open_] + got[open_]
            got[open_] += np.where(rank[x] == rank[y], span, 0)
        for _ in range(levels[0][0]):
            open_ = np.flatnonzero(got < most)
            x, y = a[open_] + got[open_], b[open_] + got[open_]
            more = text[x] == text[y]
            got[open_] += more
            most[open_[~more]] = got[open_[~more]]
        out[real] = np.minimum(got, most)
        return out

    def matches(self) -> np.ndarray:
        """At each position, the longest match with any other position, streamed along the samples."""
        best = np.zeros(self.size, np.int64)
        at = np.arange(self.size)
        for places, common in ((self.heads, self.head_common), (self.tails, self.tail_common)):
            value, sampled = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
            value[places], sampled[places] = common, places
            last = np.maximum.accumulate(sampled)
            best = np.maximum(best, value[last] - (at - last))
        return np.minimum(best, self.end - at)


def _ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, how many) of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [(int(a), int(b - a)) for a, b in edge.reshape(-1, 2)]


def _cut_texts(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """blocks() of all texts, a chunk or a segment of a long text at a time; rows count from the batch's first."""
    for i, j in chunks(offsets, SEGMENT):
        part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        if len(part) <= SEGMENT:
            owner, start, *rest = blocks(part, at, length, gram)
            yield owner + i, start, *rest
            continue
        for a in range(0, len(part), SEGMENT):
            piece = part[a : a + SEGMENT + length - 1]
            owner, start, *rest = blocks(piece, np.array([0, len(piece)]), length, gram)
            yield owner + i, start + a, *rest


BLOCKS = "doc bigint, hash bigint, start bigint, n bigint, anchor bigint, block bigint"


def _all_blocks(texts: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, start, n, anchor, block in _cut_texts(*texts_of(batch.column("text")), length, min(GRAMS[0], length)):
                rows = pa.array(owner)
                yield pa.RecordBatch.from_arrays([batch.column("doc").take(rows), batch.column("hash").take(rows), pa.array(start), pa.array(n), pa.array(anchor), pa.array(block)], ["doc", "hash", "start", "n", "anchor", "block"])

    return texts.mapInArrow(run, BLOCKS)


def _contents(rows: DataFrame, length: int) -> DataFrame:
    """anchor, block, copies and the bytes, of rows (text, wanted array)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch.column("text"))
            raw = data.tobytes()
            out = [
                (w["anchor"], w["block"], w["copies"], raw[a + w["start"] : a + w["start"] + w["n"] + length - 1])
                for a, wanted in zip(offsets.tolist(), batch.column("wanted").to_pylist(), strict=False)
                for w in wanted
            ]
            for i in range(0, len(out), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[i : i + 4096], strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["anchor", "block", "copies", "content"])

    return rows.select("text", "wanted").mapInArrow(run, "anchor bigint, block bigint, copies bigint, content binary")


def _marks(contents: DataFrame, length: int) -> DataFrame:
    """anchor, block, first and n: repeated strings of each block, by an index over whole anchors at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        same, size = 0, 0  # held[same:] has the newest anchor

        def done(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
            index = RunLengthIndex([r[3] for r in rows])
            found = index.matches() >= length
            out = []
            for (anchor, block, copies, content), at in zip(rows, index.first.tolist(), strict=True):
                n = len(content) - length + 1
                for a, many in _ranges(found[at : at + n]) if copies < 2 else [(0, n)]:
                    out.append((anchor, block, a, many))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 4)], ["anchor", "block", "first", "n"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "block", "copies", "content")), strict=True):
                if held and held[-1][:2] == row[:2]:
                    continue  # the same block, fetched from equal rows
                if held and held[-1][0] != row[0]:
                    same = len(held)
                if same and size + len(row[3]) + 1 > FULL:
                    yield done(held[:same])
                    held, same = held[same:], 0
                    size = sum(len(r[3]) + 1 for r in held)
                held.append(row)
                size += len(row[3]) + 1
        if held:
            yield done(held)

    dealt = contents.select("anchor", "block", "copies", "content").repartition("anchor").sortWithinPartitions("anchor", "block")
    return dealt.mapInArrow(run, "anchor bigint, block bigint, first bigint, n bigint")


def _recut(contents: DataFrame, length: int, gram: int) -> DataFrame:
    """Blocks of blocks by a larger anchor: anchor, block, copies, content, and where they lie (in, inside, offset)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch.column("content"))
            raw = data.tobytes()
            for owner, start, n, anchor, block in _cut_texts(data, offsets, length, gram):
                rows, at = pa.array(owner), (offsets[owner] + start).tolist()
                content = pa.array([raw[a : a + m + length - 1] for a, m in zip(at, n.tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(block), batch.column("copies").take(rows), content, batch.column("anchor").take(rows), batch.column("block").take(rows), pa.array(start)],
                    ["anchor", "block", "copies", "content", "in", "inside", "offset"],
                )

    return contents.select("anchor", "block", "copies", "content").mapInArrow(run, "anchor bigint, block bigint, copies bigint, content binary, in bigint, inside bigint, offset bigint")


def _repeated(contents: DataFrame, length: int, level: int) -> DataFrame:
    """_marks of all contents; crowded anchors are cut again."""
    crowded = cut(contents.groupBy("anchor").agg(F.count_distinct("block").alias("n")).where(F.col("n") > CROWD).select("anchor"))
    many = crowded.count()
    if not many or level + 1 == len(GRAMS):
        return _marks(contents, length)
    side = F.broadcast(crowded) if many <= BROADCAST else crowded
    plain = _marks(contents.join(side, "anchor", "left_anti"), length)
    parts = cut(_recut(contents.join(side, "anchor", "left_semi").dropDuplicates(["anchor", "block"]), length, min(GRAMS[level + 1], length)))
    twice = parts.groupBy("anchor").agg(F.sum("copies").alias("seen")).where("seen > 1").select("anchor")
    whole = cut(parts.groupBy("anchor", "block").agg(F.sum("copies").alias("copies"), F.min("content").alias("content")).join(twice, "anchor", "left_semi"))
    inner = _repeated(whole, length, level + 1).select("anchor", "block", "first", "n")
    back = parts.select("anchor", "block", "in", "inside", "offset").join(inner, ["anchor", "block"])
    return plain.union(back.select(F.col("in").alias("anchor"), F.col("inside").alias("block"), (F.col("offset") + F.col("first")).alias("first"), "n"))


def _removed(rows: DataFrame, length: int) -> DataFrame:
    """Digest and remaining bytes of rows (doc_id, text, marks)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch.column("text"))
            out = []
            for i, marks in enumerate(batch.column("marks").to_pylist()):
                text = data[offsets[i] : offsets[i + 1]]
                edge = np.zeros(len(text) + 1, np.int64)
                for m in marks:
                    edge[m["start"]] += 1
                    edge[m["start"] + m["n"] + length - 1] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                out.append((len(text), int(gone.sum()), [{"start": a, "stop": a + n} for a, n in _ranges(gone)], text[~gone].tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), _SPANS, pa.binary()), strict=True))], ["doc_id", "n_bytes", "n_removed", "spans", "kept"]) if out else pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([], k) for k in (pa.int64(), pa.int64(), _SPANS, pa.binary()))], ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return rows.select("doc_id", "text", "marks").mapInArrow(run, OUT)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
OUT = "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, stop: bigint>>, kept binary"


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (maximal removed runs of bytes) and kept (the bytes left) of every row."""
    texts = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumns({"doc": F.coalesce("doc_id", F.lit(-(1 << 63))), "hash": F.xxhash64("text")})
    path = run_dir(df.sparkSession, "blocks")  # hashes of all blocks, made once
    _all_blocks(texts.where(F.octet_length("text") >= length).select("doc", "hash", "text"), length).write.parquet(path)
    cut_up = df.sparkSession.read.parquet(path)
    # cut off, so that the join below can split an anchor that very many blocks share
    # anchors grow with the corpus: always shuffled, so that disk grows in step with the input
    twice = cut(cut_up.groupBy("anchor").agg(F.count("*").alias("seen")).where("seen > 1").select("anchor"))
    placed = cut(cut_up.join(twice.hint("merge"), "anchor", "left_semi"))
    # one place to fetch each different block from
    where = F.min(F.struct("doc", "hash", "start", "n")).alias("w")
    distinct = placed.groupBy("anchor", "block").agg(F.count("*").alias("copies"), where)
    wanted = cut(distinct.groupBy("w.doc", "w.hash").agg(F.collect_list(F.struct("anchor", "block", "copies", "w.start", "w.n")).alias("wanted")))
    key = ["doc", "hash"]
    ids = wanted.select(key)
    some = texts.join(F.broadcast(ids), key, "left_semi") if ids.count() <= BROADCAST else texts
    contents = cut(_contents(some.join(wanted, key), length))
    marks = _repeated(contents, length, 0)
    hits = placed.join(marks.select("anchor", "block", "first", F.col("n").alias("many")), ["anchor", "block"])
    spots = cut(hits.groupBy(key).agg(F.collect_set(F.struct((F.col("start") + F.col("first")).alias("start"), F.col("many").alias("n"))).alias("marks")))
    ids = spots.select(key)
    none = F.expr("cast(array() as array<struct<start: bigint, stop: bigint>>)").alias("spans")
    rest = [F.col("doc_id"), F.octet_length("text").cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_removed"), none, F.col("text").cast("binary").alias("kept")]
    if ids.count() <= BROADCAST:
        ids = F.broadcast(ids)
        return texts.join(ids, key, "left_anti").select(rest).unionByName(_removed(texts.join(ids, key, "left_semi").join(spots, key), length))
    joined = texts.join(spots, key, "left")
    return joined.where("marks is null").select(rest).unionByName(_removed(joined.where("marks is not null"), length))
