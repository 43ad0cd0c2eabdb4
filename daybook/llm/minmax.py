"""Near-duplicate documents by min-max hashing.

A document's set is its distinct word shingles (A-Z lower-cased). Each of
``PERMUTATIONS`` random functions is evaluated once for a shingle and gives
two signature values, the least and the greatest over the set; both agree
between two sets with probability J, so a signature is twice as long for the
same work and its estimate of J has less variance. ``ROWS`` values form a
band; documents that agree in a band are candidates. With 48 bands of 6, a
pair at J = 0.8 is missed with probability (1 - 0.8^6)^48 < 1e-6, whatever
the size of the sets. Every link is confirmed on the full sets.

Copies first collapse to one node for each distinct set, so a group of equal
documents of any size is one row from then on. No bucket is ever expanded to
its pairs:

1. each node is compared with at most ``GROUPS`` centres, the least nodes (in
   ``GROUPS`` different random orders) among the buckets that it shares;
2. components of the confirmed links settle most buckets. In a bucket that
   still holds several components, only the nodes outside its largest
   component are compared with the others, in blocks of about ``BLOCK`` by
   ``BLOCK`` nodes and ``BLOCK_BYTES`` of sets, and only across components. Two nodes that share a bucket
   and are not yet connected are always compared, so no link between
   different texts is lost.

What a pass over the texts needs (ids with their buckets) is broadcast only if
it holds at most ``BROADCAST`` entries; beyond that the same join shuffles.

Defined cases: a null text or one without words has an empty set, links with
nothing and stays; a row without doc_id links with nothing, has a null
component and stays; rows that share a doc_id are one document; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.components import components
from daybook.llm.shared import cut, lean, source
from daybook.llm.textbytes import LOWER, chunks, hashes, mix, prefix, shingles, texts_of, words

BANDS, ROWS = 48, 6
PERMUTATIONS = BANDS * ROWS // 2
GROUPS = 8
BLOCK = 512
BLOCK_BYTES = 4 << 20
BROADCAST = 400_000

_U64 = np.uint64
_SEED = mix(np.arange(1, 2 * PERMUTATIONS + 1, dtype=_U64) * _U64(0x9E3779B97F4A7C15))
_TIMES, _PLUS = _SEED[:PERMUTATIONS] | _U64(1), _SEED[PERMUTATIONS:]
_LOW48 = _U64((1 << 48) - 1)


def sets_of(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges with their distinct shingles (48-bit hashes, ascending) and each row's first (one more)."""
    data, offsets = texts_of(column)
    data = LOWER[data]
    for i, j in chunks(offsets):
        while i < j:
            k = min(j, i + (1 << 16) - 1)
            part, at = data[offsets[i] : offsets[k]], offsets[i : k + 1] - offsets[i]
            start, end, first = words(part, at)
            found, begin = shingles(hashes(prefix(part), start, end), first, size)
            owner = np.repeat(np.arange(k - i, dtype=_U64), np.diff(begin))
            both = np.sort(owner << _U64(48) | found >> _U64(16))
            both = both[np.append(True, both[1:] != both[:-1])] if len(both) else both
            yield i, k, both & _LOW48, np.searchsorted(both >> _U64(48), np.arange(k - i + 1, dtype=_U64))
            i = k


def signature(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Least and greatest value of every permutation, side by side, for each non-empty set."""
    x = mix(values + _U64(1))
    out = np.empty((len(first), 2 * PERMUTATIONS), _U64)
    for p in range(PERMUTATIONS):
        y = x * _TIMES[p] + _PLUS[p]
        out[:, 2 * p] = np.minimum.reduceat(y, first)
        out[:, 2 * p + 1] = np.maximum.reduceat(y, first)
    return out


def _bands(sign: np.ndarray) -> np.ndarray:
    out = np.repeat(np.arange(1, BANDS + 1, dtype=_U64)[None, :], len(sign), 0)
    parts = sign.reshape(len(sign), BANDS, ROWS)
    for r in range(ROWS):
        out = mix(out * _U64(0xE7037ED1A0B428DB) + parts[:, :, r])
    return out.astype(np.int64)


def _described(texts: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, key (of the set) and the bands of each row; key is null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, values, first in sets_of(batch.column("text"), size):
                count = np.diff(first)
                some = np.flatnonzero(count)
                key: list[bytes | None] = [None] * (j - i)
                band: list[np.ndarray | None] = [None] * (j - i)
                if len(some):
                    at = first[:-1][some]
                    x = mix(values + _U64(7))
                    sums = np.stack([np.add.reduceat(x, at), np.add.reduceat(mix(x), at)], 1)
                    for d, s, b in zip(some.tolist(), sums, _bands(signature(values, at)), strict=True):
                        key[d], band[d] = s.tobytes(), b
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(count, pa.int64()), pa.array(key, pa.binary()), pa.array(band, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "key", "bands"],
                )

    return texts.mapInArrow(lean(run), "doc_id bigint, n_shingles bigint, key binary, bands array<bigint>")


def _small(wanted: DataFrame) -> DataFrame:
    """Broadcast (node, tags) only if all of its tags are few."""
    total = wanted.agg(F.sum(F.size("tags"))).first()[0] or 0
    return F.broadcast(wanted) if total <= BROADCAST else wanted


def _with_sets(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """wanted (node, tags) with the set of each node's texts."""
    schema = wanted.schema["tags"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, values, first in sets_of(batch.column("text"), size):
                raw = [values[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for a, b in zip(first, first[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(i, j - i), batch.column("tags").slice(i, j - i), pa.array(raw, pa.binary())], ["node", "tags", "shingles"])

    rows = texts.withColumnRenamed("doc_id", "node").join(_small(wanted), "node").select("node", "tags", "text")
    return rows.mapInArrow(lean(run), f"node bigint, tags {schema}, shingles binary")


def _set(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _linked(a: int, b: int, both: int, percent: int) -> bool:
    return 100 * both >= percent * (a + b - both)


def _confirmed(pairs: DataFrame, percent: int) -> DataFrame:
    """The links among pairs (a, b, left, right)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
                n, m = len(left) // 6, len(right) // 6
                keep.append(_linked(n, m, min(n, m), percent) and _linked(n, m, len(np.intersect1d(_set(left), _set(right), assume_unique=True)), percent))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "left", "right").mapInArrow(lean(run), "a bigint, b bigint")


def _blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Links across components inside (key, i, j) blocks of minor and other nodes."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["node", "left", "shingles"])
        right = pdf[~pdf["left"]]
        sets = [_set(x) for x in right["shingles"]]
        size = np.array([len(x) for x in sets])
        if not len(sets):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        at = np.concatenate(([0], np.cumsum(size)[:-1]))
        values, place = np.unique(np.concatenate(sets), return_inverse=True)
        del sets
        mine = np.zeros(len(values), np.int32)  # 1 at the values of one left set
        node, comp = right["node"].to_numpy(), right["component"].to_numpy()
        out = []
        for a, c, raw in zip(*(pdf.loc[pdf["left"], k] for k in ("node", "component", "shingles")), strict=True):
            own = _set(raw)
            spot = np.minimum(np.searchsorted(values, own), len(values) - 1)
            spot = spot[values[spot] == own]
            mine[spot] = 1
            both = np.add.reduceat(mine[place], at)
            mine[spot] = 0
            hit = np.flatnonzero((comp != c) & (100 * both >= percent * (size + len(own) - both)))
            _, one = np.unique(comp[hit], return_index=True)  # one link to each other component
            out += [(a, b) for b in node[hit[one]].tolist()]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return rows.groupBy("bucket", "i", "j").applyInPandas(run, "a bigint, b bigint")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable) and kept, one row for each input row."""
    texts = source(df, id_col, text_col)
    rows = cut(_described(texts, shingle))
    # one node for each distinct set
    sets = rows.where("key is not null and doc_id is not null")
    nodes = cut(sets.groupBy("key").agg(F.min("doc_id").alias("node"), F.min("n_shingles").alias("size"), F.min("bands").alias("bands")))
    listed = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    # an order of its own for each group of buckets
    one = F.struct(F.xxhash64("node", F.pmod("bucket", F.lit(GROUPS))).alias("rank"), F.col("node").alias("centre"))
    # cut off, as below, so that the join can split a bucket that very many nodes share
    buckets = cut(listed.groupBy("bucket").agg(F.count("*").alias("n"), F.min(one).alias("best")).where("n > 1"))
    members = cut(listed.join(buckets, "bucket").select("bucket", "node", "size", "n", "best"))
    # 1: links to centres
    pairs = members.groupBy("node", F.pmod("bucket", F.lit(GROUPS)).alias("g")).agg(F.min("best").alias("best")).select("node", F.col("best.centre").alias("centre")).where("node <> centre").distinct()
    none = F.expr("cast(array() as array<bigint>)")
    centres = pairs.select(F.col("centre").alias("node")).distinct().select("node", F.array("node").alias("self"))
    tags = pairs.groupBy("node").agg(F.collect_set("centre").alias("to")).join(centres, "node", "full")
    wanted = cut(tags.select("node", F.concat(F.coalesce("to", none), F.coalesce("self", none)).alias("tags")))
    placed = _with_sets(texts, wanted, shingle).withColumn("centre", F.explode("tags"))
    left = placed.where("node <> centre").select("centre", F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = placed.where("node = centre").select("centre", F.col("shingles").alias("right"))
    links = cut(_confirmed(left.join(right, "centre").withColumnRenamed("centre", "b"), percent).distinct())
    # 2: buckets that still hold several components
    found = components(links)
    known = members.select("bucket", "node", "size").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = known.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    mixed = cut(parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.sum("size").alias("size"), F.max(F.struct("n", "component", "size")).alias("main")).where("parts > 1"))
    minor = F.col("component") != F.col("main.component")
    bytes_of = 6 / BLOCK_BYTES  # of one shingle, in blocks
    lefts = F.ceil(F.greatest((F.col("n") - F.col("main.n")) / BLOCK, (F.col("all_size") - F.col("main.size")) * bytes_of))
    rights = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("all_size") * bytes_of))
    left_open = known.join(mixed.select("bucket", "n", F.col("size").alias("all_size"), "main"), "bucket").select("node", F.struct("bucket", "component", minor.alias("minor"), lefts.alias("lefts"), rights.alias("rights")).alias("t"))
    tags = cut(left_open.groupBy("node").agg(F.collect_list("t").alias("tags")))  # a node has at most BANDS buckets
    tagged = _with_sets(texts, tags, shingle).select("node", "shingles", F.explode("tags").alias("t")).select("node", "shingles", "t.*")
    # a minor node meets every block of the others, and every node every block of the minor ones
    cells = F.expr("""concat(
        if(minor, transform(sequence(0L, rights - 1), x -> struct(true as left, pmod(xxhash64(node), lefts) as i, x as j)), array()),
        transform(sequence(0L, lefts - 1), x -> struct(false as left, x as i, pmod(xxhash64(node), rights) as j)))""")
    rows_in = tagged.select("bucket", "node", "component", "shingles", F.explode(cells).alias("c")).select("bucket", "node", "component", "shingles", "c.*")
    more = _blocks(rows_in, percent)
    final = components(links.union(more.distinct()))
    # back to the rows
    place = nodes.select("key", "node").join(final, "node", "left").select("key", F.coalesce("component", "node").alias("component"))
    out = rows.select("doc_id", "n_shingles", "key").join(place, "key", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"), F.expr("doc_id is null or doc_id = coalesce(component, doc_id)").alias("kept"))
