"""Token ids as binary files with Elias-Fano coded document boundaries.

A file holds the ids of a run of documents in ascending doc_id order, back to
back as little-endian unsigned 16- or 32-bit integers, and behind them a
footer: the running token counts and the document ids, each as an Elias-Fano
sequence. An Elias-Fano sequence of n non-decreasing values below u stores
the low ``l = floor(log2(u / n))`` bits of each value as they are and the high
parts in unary in one bit vector, about ``2 + log2(u / n)`` bits a value; the
position of every 256th one is sampled (32 bits each), so ``select`` unpacks
one block. Readers take a block of documents at a time (``between``), or one
document by two selects (``document_at``): a file's offsets are never unpacked
into a table.

Scale: documents are dealt by ranges of (doc_id, hash of the text) - the hash
splits a doc_id that many rows share - sorted inside a task and streamed to
one file per task in the shared folder; a task keeps only running counts and
ids of its documents. File names are unique per attempt and only files that
the manifest names are read, so a lost executor's leftovers do no harm. The
driver sees one manifest row for each file.

Defined cases: null or empty text is the end id alone; null doc_ids come
first; equal doc_ids follow each other by the hash of their texts; an empty
table gives an empty manifest and no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.shared import run_dir, source
from daybook.llm.tokens import encoder

MAGIC = b"EFIDS001"
BLOCK = 256
#: Bytes of ids that a reading task holds at once.
READ = 8 << 20

MANIFEST = "part int, file string, n_docs bigint, n_ids bigint"
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


class EliasFano:
    """A non-decreasing sequence of unsigned integers."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.width, self.low, self.high, self.samples = n, width, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        width = max(0, (universe // max(n, 1)).bit_length() - 1)
        bits = np.zeros((n, width), np.uint8)
        for b in range(width):
            bits[:, b] = (values >> np.uint64(b)) & np.uint64(1)
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, width, np.packbits(bits.ravel(), bitorder="little"), np.packbits(high, bitorder="little"), ones[::BLOCK].astype(np.uint32))

    def block(self, k: int) -> np.ndarray:
        """Values BLOCK*k up to BLOCK*(k+1), from one sample to the next."""
        i, j = k * BLOCK, min(self.n, (k + 1) * BLOCK)
        a = int(self.samples[k])
        b = int(self.samples[k + 1]) if k + 1 < len(self.samples) else len(self.high) * 8
        bits = np.unpackbits(self.high[a // 8 : (b + 7) // 8], bitorder="little")
        ones = np.flatnonzero(bits) + a // 8 * 8
        ones = ones[ones >= a][: j - i]
        value = (ones - np.arange(i, j)).astype(np.uint64) << np.uint64(self.width)
        if self.width:
            a, b = i * self.width, j * self.width
            bits = np.unpackbits(self.low[a // 8 : (b + 7) // 8], bitorder="little")[a % 8 : a % 8 + b - a].reshape(-1, self.width)
            for w in range(self.width):
                value |= bits[:, w].astype(np.uint64) << np.uint64(w)
        return value

    def select(self, i: int) -> int:
        return int(self.block(i // BLOCK)[i % BLOCK])

    def between(self, i: int, j: int) -> np.ndarray:
        """Values i up to j, unpacking only the blocks that hold them."""
        if i >= j:
            return np.empty(0, np.uint64)
        first = i // BLOCK
        some = np.concatenate([self.block(k) for k in range(first, (j - 1) // BLOCK + 1)])
        return some[i - first * BLOCK : j - first * BLOCK]

    def all(self) -> np.ndarray:
        return np.concatenate([np.empty(0, np.uint64), *(self.block(k) for k in range(len(self.samples)))])

    def dump(self) -> tuple[dict, bytes]:
        parts = [self.low.tobytes(), self.high.tobytes(), self.samples.astype("<u4").tobytes()]
        return {"n": self.n, "width": self.width, "bytes": [len(p) for p in parts]}, b"".join(parts)

    @classmethod
    def load(cls, head: dict, raw: bytes) -> EliasFano:
        a, b, c = head["bytes"]
        return cls(head["n"], head["width"], np.frombuffer(raw, np.uint8, a), np.frombuffer(raw, np.uint8, b, a), np.frombuffer(raw, "<u4", c // 4, a + b))


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def write_file(path: str, batches: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]], id_bytes: int) -> tuple[int, int]:
    """Write (doc_ids, ids, ends of each document's ids, number of null doc_ids) batches; documents and ids written."""
    store, at = _open(path)
    docs, ends, nulls, total = [], [], 0, 0
    with store.open_output_stream(at) as out:
        for doc_ids, ids, ended, none in batches:
            out.write(ids.astype(f"<u{id_bytes}").tobytes())
            docs.append(doc_ids)
            ends.append(ended + total)
            nulls += none
            total += len(ids)
        doc_ids, bounds = np.concatenate(docs).astype(np.int64), np.concatenate(([0], *ends))
        least = int(doc_ids[nulls]) if len(doc_ids) > nulls else 0
        shifted = doc_ids[nulls:].astype(np.uint64) - np.uint64(least & 0xFFFFFFFFFFFFFFFF)
        (one, raw), (two, more) = EliasFano.of(bounds).dump(), EliasFano.of(shifted).dump()
        head = json.dumps({"id_bytes": id_bytes, "n_ids": total, "nulls": nulls, "least": least, "bounds": one, "docs": two}).encode()
        out.write(raw + more + head + len(head).to_bytes(4, "little") + MAGIC)
    return len(doc_ids), total


@dataclass(frozen=True)
class Footer:
    """What a reader keeps of a file: both sequences as they are stored."""

    id_bytes: int
    nulls: int
    least: int
    bounds: EliasFano
    docs: EliasFano

    def doc_ids(self, i: int, j: int) -> list[int | None]:
        """doc_ids of documents i up to j; null ones come first."""
        none = max(0, min(j, self.nulls) - i)
        real = self.docs.between(max(i - self.nulls, 0), max(j - self.nulls, 0)) + np.uint64(self.least & 0xFFFFFFFFFFFFFFFF)
        return [None] * none + real.astype(np.int64).tolist()


def _footer(file: pa.NativeFile, path: str) -> Footer:
    size = file.size()
    tail = file.read_at(12, size - 12)
    if tail[4:] != MAGIC:
        raise ValueError(f"{path} is not a token file")
    n = int.from_bytes(tail[:4], "little")
    head = json.loads(file.read_at(n, size - 12 - n))
    one, two = (sum(head[k]["bytes"]) for k in ("bounds", "docs"))
    start = size - 12 - n - one - two
    bounds, docs = EliasFano.load(head["bounds"], file.read_at(one, start)), EliasFano.load(head["docs"], file.read_at(two, start + one))
    return Footer(head["id_bytes"], head["nulls"], head["least"], bounds, docs)


def _ids(file: pa.NativeFile, footer: Footer, start: int, stop: int) -> np.ndarray:
    width = footer.id_bytes
    return np.frombuffer(file.read_at((stop - start) * width, start * width), f"<u{width}")


def document_at(path: str, k: int) -> tuple[int | None, int, np.ndarray]:
    """doc_id, first position and ids of the file's document number k, by selects."""
    store, at = _open(path)
    with store.open_input_file(at) as file:
        footer = _footer(file, path)
        start, stop = footer.bounds.select(k), footer.bounds.select(k + 1)
        return footer.doc_ids(k, k + 1)[0], start, _ids(file, footer, start, stop)


def read_file(path: str) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Runs of documents: doc_ids, their first positions (one more) and their ids; one block of bounds at a time."""
    store, at = _open(path)
    with store.open_input_file(at) as file:
        footer = _footer(file, path)
        n = footer.bounds.n - 1
        for first in range(0, n, BLOCK):
            last = min(first + BLOCK, n)
            bounds = footer.bounds.between(first, last + 1).astype(np.int64)
            doc_ids, i = footer.doc_ids(first, last), 0
            while i < last - first:
                j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + READ // 4, "right")) - 1)
                j = min(j, last - first)
                yield doc_ids[i:j], bounds[i : j + 1], _ids(file, footer, int(bounds[i]), int(bounds[j]))
                i = j


def write_tokens(df: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> list[dict]:
    """Encode every text, write the files below ``path`` and a manifest; its rows."""
    store, at = _open(path)
    store.create_dir(at, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task, first = encoder(tokenizer), TaskContext.get(), next(batches, None)
        if first is None:
            return
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.ids"

        def coded() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
            batch = first
            while batch is not None:
                for i, j, ids, offsets in coder.encoded(batch.column("text")):
                    out = np.insert(ids, offsets[1:], end_id)
                    keys = batch.column("doc_id").slice(i, j - i)
                    yield keys.fill_null(0).to_numpy(zero_copy_only=False), out, offsets[1:] + np.arange(1, len(offsets)), keys.null_count
                batch = next(batches, None)

        made = coded()
        start = next(made, None)
        if start is None:
            return
        from itertools import chain

        n_docs, n_ids = write_file(f"{path}/{name}", chain([start], made), 2 if coder.size <= 1 << 16 else 4)
        yield pa.RecordBatch.from_pydict({"part": pa.array([task.partitionId()], pa.int32()), "file": [name], "n_docs": [n_docs], "n_ids": [n_ids]})

    texts = source(df, id_col, text_col).withColumn("order", F.xxhash64("text"))
    dealt = texts.repartitionByRange("doc_id", "order").sortWithinPartitions("doc_id", "order").drop("order")
    files = sorted((r.asDict() for r in dealt.mapInArrow(write, MANIFEST).collect()), key=lambda r: r["part"])
    start = 0
    for f in files:
        f["start"], start = start, start + f["n_ids"]
    with store.open_output_stream(f"{at}/manifest.json") as out:
        out.write(json.dumps(files).encode())
    return files


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian uint32) from the files."""
    store, at = _open(path)
    with store.open_input_stream(f"{at}/manifest.json") as file:
        files = json.loads(file.read())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                for doc_ids, bounds, ids in read_file(f"{path}/{name}"):
                    raw, cut = ids.astype("<u4").tobytes(), (bounds - bounds[0]) * 4
                    column = pa.Array.from_buffers(pa.binary(), len(doc_ids), [None, pa.py_buffer(cut.astype(np.int32).tobytes()), pa.py_buffer(raw)]) if len(raw) < 1 << 31 else pa.array([raw[a:b] for a, b in zip(cut, cut[1:], strict=False)], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(bounds[:-1] + base), pa.array(np.diff(bounds)), column], ["doc_id", "start", "n_tokens", "ids"])

    rows = [(f["file"], f["start"]) for f in files]
    if not rows:
        return spark.createDataFrame([], DOCUMENTS)
    # one task for each file
    listed = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "file string, start bigint")
    return listed.mapInArrow(read, DOCUMENTS)


def round_trip(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, path: str | None = None) -> DataFrame:
    """Write the files (to a new path in the shared folder if none is given) and read them back."""
    path = path or run_dir(df.sparkSession, "tokens")
    write_tokens(df, path, tokenizer, id_col, text_col, end_id)
    return read_tokens(df.sparkSession, path)
