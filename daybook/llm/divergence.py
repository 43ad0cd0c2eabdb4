"""Source divergence audit: how the sources of a language differ in their words.

Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased. A
language keeps the terms of at least ``min_docs`` of its documents. A group is
one source of one language; with count c of a kept term, N the sum of c over
the kept terms and V their number, p = 1 + floor(SCALE * (c + 1) / (N + V)),
for a group as for its whole language. f(p, q) = floor((p - q)^2 / q). All of
it is integer arithmetic, exact for N + V below 9 * 10^15.

1. Each task counts its batches' terms in Arrow dictionaries; the counts are
   summed in one shuffle. Kept terms get dense ids in the order of (language,
   term): a number within the partition plus the partitions' sizes before it.
2. A group's counts become sorted (term id, count) arrays, one for each block
   of ``BLOCK`` ids, so no array grows with the vocabulary. Ids are stored as
   16-bit steps and counts as bytes, with larger ones apart.
3. Every unordered pair of a language's sources is one task for each block: its
   two arrays are co-grouped, the shorter one gallops through the longer one,
   and overlapping and one-sided terms are priced both ways. Terms that
   neither group has cost the same each, so only their number is needed: V
   less the terms seen in all blocks.
4. A group's own terms are scored against its language in SQL; the ``top``
   ranks are limited in the map tasks before the window's shuffle.

A source with a third of all rows is a few arrays after step 1; the number of
pairs is that of the result.

Defined cases: null text, lang and source count as ''; a document without terms
still makes its group occur; a language without kept terms has value 0 for
every pair and no term rows; repeated rows are documents of their own; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.runs import LETTERS, runs
from daybook.llm.shared import cut, lean
from daybook.llm.textbytes import LOWER, texts_of

MIN_DOCS = 3
TOP = 200
SCALE = 1_000_000_000
#: Term ids of one block; steps between them fit 16 bits.
BLOCK = 1 << 16
#: Values of the shorter array that gallop together.
STRIDE = 64
#: The list of groups is broadcast up to this many rows.
BROADCAST = 200_000


def term_counts(rows: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with it) of (lang, source, text) without nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch.column("text"))
            data = LOWER[data]
            solid = LETTERS[data]
            start, end, at = runs(solid, offsets)
            if not len(start):
                continue
            places = np.concatenate(([0], np.cumsum(end - start)))
            strings = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(places), pa.py_buffer(data[solid]))
            coded = strings.dictionary_encode()
            term, k = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
            langs, sources = batch.column("lang").dictionary_encode(), batch.column("source").dictionary_encode()
            group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
            doc = np.repeat(np.arange(batch.num_rows), np.diff(at))
            in_doc, times = np.unique(doc * k + term, return_counts=True)
            key, back = np.unique(group[in_doc // k] * k + in_doc % k, return_inverse=True)
            n = np.zeros(len(key), np.int64)
            np.add.at(n, back, times)
            owner = key // k
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(owner // len(sources.dictionary))), sources.dictionary.take(pa.array(owner % len(sources.dictionary))),
                    coded.dictionary.take(pa.array(key % k)).cast(pa.string()), pa.array(n), pa.array(np.bincount(back, minlength=len(key)), pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )

    parts = rows.mapInArrow(lean(run), "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def vocabulary(counts: DataFrame, min_docs: int) -> DataFrame:
    """lang, term, total and a dense id for every kept term, in the order of (lang, term)."""
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    placed = kept.select("lang", "term", "total").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    placed = cut(placed.withColumn("mark", F.monotonically_increasing_id()))
    part, place = F.shiftright("mark", 33), F.col("mark").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("part")).count().orderBy("part").collect()  # one row a partition
    before, offsets = 0, []
    for r in sizes:
        offsets.append((r["part"], before))
        before += r["count"]
    first = placed.sparkSession.createDataFrame(offsets, "part bigint, before bigint")
    ids = placed.withColumn("part", part).join(F.broadcast(first), "part")
    return ids.select("lang", "term", "total", (F.col("before") + place).alias("id"))


# -- arrays ------------------------------------------------------------------------------------


def encode(ids: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Sorted ids within a block as 16-bit steps; counts as bytes, those of 255 and more apart."""
    steps = np.diff(ids, prepend=0).astype("<u2")
    return steps.tobytes(), np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[counts >= 255].astype("<i8").tobytes()


def decode(steps: bytes, small: bytes, large: bytes) -> tuple[np.ndarray, np.ndarray]:
    counts = np.frombuffer(small, np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(large, "<i8")
    return np.cumsum(np.frombuffer(steps, "<u2").astype(np.int64)), counts


def _gallop(values: np.ndarray, at: int, least: int) -> int:
    """The first place from ``at`` on with a value of at least ``least``, by doubling steps."""
    step, low = 1, at
    while at < len(values) and values[at] < least:
        low, at, step = at + 1, at + step, step * 2
    high = min(at, len(values))
    return low + int(np.searchsorted(values[low:high], least))


def intersect(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common values of two ascending arrays, the first galloping through the second."""
    left, right, at = [], [], 0
    for i in range(0, len(short), STRIDE):
        some = short[i : i + STRIDE]
        at = _gallop(long, at, some[0])
        stop = _gallop(long, at, some[-1] + 1)
        window = long[at:stop]
        if len(window):
            place = np.minimum(np.searchsorted(window, some), len(window) - 1)
            hit = np.flatnonzero(window[place] == some)
            left.append(hit + i)
            right.append(place[hit] + at)
        at = stop
        if at >= len(long):
            break
    none = np.empty(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def price(counts: np.ndarray, mass: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / mass), three decimal digits at a time, so that nothing leaves 64 bits."""
    rest, out = counts.astype(np.int64) + 1, np.zeros(len(counts), np.int64)
    out, rest = out + rest // mass, rest % mass
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // mass, rest % mass
    return out + 1


def _gaps(p: np.ndarray, q: np.ndarray) -> int:
    return int(((p - q) * (p - q) // q).sum())


def pair_values(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], mass_a: int, mass_b: int) -> tuple[int, int, int]:
    """Sums of f over the terms that a or b has, as (a against b, b against a), and their number."""
    swap = len(a[0]) > len(b[0])
    place = intersect(b[0], a[0]) if swap else intersect(a[0], b[0])
    in_a, in_b = place[::-1] if swap else place
    only_a, only_b = np.ones(len(a[0]), np.bool_), np.ones(len(b[0]), np.bool_)
    only_a[in_a] = only_b[in_b] = False
    p, q = price(a[1], mass_a), price(b[1], mass_b)
    zero = np.zeros(1, np.int64)
    base_p, base_q = price(zero, mass_a), price(zero, mass_b)
    sides = [(p[in_a], q[in_b]), (p[only_a], base_q), (base_p, q[only_b])]
    there = sum(_gaps(x, y) for x, y in sides)
    back = sum(_gaps(y, x) for x, y in sides)
    return there, back, len(a[0]) + int(only_b.sum())


def _arrays(kept: DataFrame) -> DataFrame:
    """lang, source, block and the coded array of each group's counts in each block."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        return pd.DataFrame([(*key, *encode(pdf["id"].to_numpy() % BLOCK, pdf["n"].to_numpy()))])

    blocks = kept.select("lang", "source", F.floor(F.col("id") / BLOCK).alias("block"), "id", "n")
    return blocks.groupBy("lang", "source", "block").applyInPandas(run, "lang string, source string, block bigint, steps binary, small binary, large binary")


def _pair_sums(arrays: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b, there, back, seen for every pair of sources a < b that has a kept term."""
    own = groups.select("lang", "source", F.col("mass").alias("mass"))
    other = groups.select("lang", F.col("source").alias("other"), F.col("mass").alias("other_mass"))
    few = groups.count() <= BROADCAST
    sided = arrays.join(F.broadcast(own) if few else own, ["lang", "source"])
    sided = sided.join(F.broadcast(other) if few else other, "lang")  # one row for each partner
    # the smaller source is the pair's first side; names differ by side, because both come from the same rows
    code = ["steps", "small", "large"]
    first = sided.where("source < other").select("lang", F.col("source").alias("a"), F.col("other").alias("b"), "block", F.col("mass").alias("mass_a"), F.col("other_mass").alias("mass_b"), *code)
    second = sided.where("source > other").select(
        F.col("lang").alias("lang_2"), F.col("other").alias("a_2"), F.col("source").alias("b_2"), F.col("block").alias("block_2"),
        F.col("other_mass").alias("mass_a_2"), F.col("mass").alias("mass_b_2"), *[F.col(c).alias(f"{c}_2") for c in code],
    )
    none = np.empty(0, np.int64), np.empty(0, np.int64)

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        # one row each at most; the last three columns are the array, the two before them the masses
        a, b = (decode(*side.iloc[0, 6:9]) if len(side) else none for side in (left, right))
        some = left if len(left) else right
        there, back, seen = pair_values(a, b, int(some.iat[0, 4]), int(some.iat[0, 5]))
        return pd.DataFrame({"lang": [key[0]], "a": [key[1]], "b": [key[2]], "there": [there], "back": [back], "seen": [seen]})

    keys = ["lang", "a", "b", "block"]
    tasks = first.groupBy(*keys).cogroup(second.groupBy(*[f"{k}_2" for k in keys])).applyInPandas(run, "lang string, a string, b string, there bigint, back bigint, seen bigint")
    return tasks.groupBy("lang", "a", "b").agg(F.sum("there").alias("there"), F.sum("back").alias("back"), F.sum("seen").alias("seen"))


def _price(count: str, mass: str) -> str:
    return f"(1 + (cast({SCALE} as decimal(10,0)) * cast({count} + 1 as decimal(20,0))) div cast({mass} as decimal(20,0)))"


def _gap(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank of every group."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    rows = df.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    counts = cut(term_counts(rows))
    terms = cut(vocabulary(counts, min_docs))
    kept = cut(counts.select("lang", "source", "term", "n").join(terms, ["lang", "term"]))
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    groups = rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = cut(groups.select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"), (F.coalesce("own", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("mass"), (F.col("lang_n") + F.col("v")).alias("lang_mass")))
    # pairs: seen terms from the tasks, absent ones by their number
    a = groups.select("lang", F.col("source").alias("a"), "v", F.col("mass").alias("mass_a"))
    b = groups.select("lang", F.col("source").alias("b"), F.col("mass").alias("mass_b"))
    pairs = a.join(b, "lang").where("a < b").join(_pair_sums(cut(_arrays(kept)), groups), ["lang", "a", "b"], "left")
    pairs = pairs.withColumns({"base_a": F.expr(f"if(v = 0, 1, {_price('0', 'greatest(mass_a, 1)')})"), "base_b": F.expr(f"if(v = 0, 1, {_price('0', 'greatest(mass_b, 1)')})"), "absent": F.col("v") - F.coalesce("seen", F.lit(0))})
    there = F.expr(f"coalesce(there, 0) + absent * ({_gap('base_a', 'base_b')})")
    back = F.expr(f"coalesce(back, 0) + absent * ({_gap('base_b', 'base_a')})")
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item"), there.alias("value")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"), back.alias("value")))
    against = pairs.select("lang", F.explode(ways).alias("w")).select("lang", "w.source", "w.item", "w.value")
    # terms of a group against its language
    few = groups.count() <= BROADCAST
    masses = groups.select("lang", "source", "mass", "lang_mass")
    scored = kept.join(F.broadcast(masses) if few else masses, ["lang", "source"])
    scored = scored.select("lang", "source", F.col("term").alias("item"), F.expr(_price("n", "mass")).alias("p"), F.expr(_price("total", "lang_mass")).alias("q"))
    over = scored.where("p > q").select("lang", "source", "item", F.expr(_gap("p", "q")).alias("value"))
    return _ranked(against, "pair").unionByName(_ranked(over, "term").where(F.col("rank") <= top))


#: The same rows from dense counts.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
w AS (SELECT doc, lang, source, unnest(terms) AS term FROM d),
v AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
l AS (SELECT lang, count(*) AS v, sum(total) AS n FROM v GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
dense AS (
  SELECT g.lang, g.source, v.term, v.total, coalesce(c.n, 0) AS n
  FROM g JOIN v USING (lang) LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL) c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
own AS (SELECT lang, source, sum(n) AS own FROM dense GROUP BY lang, source),
p AS (
  SELECT lang, source, term, dense.n, 1 + CAST(1000000000 * CAST(dense.n + 1 AS HUGEINT) // (own + l.v) AS HUGEINT) AS p,
         1 + CAST(1000000000 * CAST(total + 1 AS HUGEINT) // (l.n + l.v) AS HUGEINT) AS q
  FROM dense JOIN own USING (lang, source) JOIN l USING (lang)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""
