"""Joins in time: the last match before an instant, and overlapping spans.

``asof_join`` gives every left row the values of its key's last right row at or
before (or the first at or after) its own time. It never compares pairs:

1. the right side is reduced to one row for each key and instant in a
   pre-aggregated group-by (the greatest by ``tie``, then by value), so copies
   of one instant, however many, move as one row;
2. both sides are put below each other and sorted once per key; the last
   non-null right value over the frame from the key's start to the row itself is
   the answer (a running window, linear in the rows);
3. a key with more than ``rows_per_segment`` rows is cut into segments by
   approximate quantiles of its own times, each a sort of its own. The right
   value that a segment starts with is carried over from the segments before
   it: a table of one row for each segment of a hot key.

So the plan holds one shuffle of the rows, no range or nested-loop join, and a
key with a third of all rows is spread over ``CUTS`` + 1 tasks.

``interval_join`` finds the pairs of overlapping closed spans of a key. A span
gets the level of its length (bucket width doubles from level to level), so that
it lies in at most two buckets of its own level and of any higher one. Pairs
meet at the greater of their two levels, by an equi-join on (key, level,
bucket), in the first bucket that both lie in, and are checked exactly there.
A long span is thus never cut into many short buckets, and no pair is found
twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A key with more rows than this is cut into segments.
ROWS_PER_SEGMENT = 1_000_000
#: Cut points of such a key.
CUTS = 255
#: Hot keys (each with its cut points) are broadcast up to this many.
BROADCAST_KEYS = 2_000
#: Levels of span lengths, each twice as long as the one before.
LEVELS = 48

_DAY = dt.timedelta(days=1)


def ticks(df: DataFrame, name: str) -> Column:
    """A time column as a number: microseconds, days or the number itself."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("bigint")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint")
    if isinstance(kind, T.FractionalType):
        return F.col(name).cast("double")
    raise TypeError(f"{name} is {kind.simpleString()}, not a date, timestamp or number")


def _span(df: DataFrame, name: str, length: dt.timedelta | float) -> float:
    """A length in the ticks of a column."""
    if isinstance(length, dt.timedelta):
        return length / (_DAY if isinstance(df.schema[name].dataType, T.DateType) else dt.timedelta(microseconds=1))
    return length


def _complete(names: Sequence[str]) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & F.col(n).isNotNull()
    return out


def _hot_cuts(points: DataFrame, rows_per_segment: int, cuts: int) -> DataFrame | None:
    """k and the cut points of every key with more rows than a segment may hold; None without one."""
    hot = points.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows_per_segment).select("k").checkpoint(eager=True)
    n = hot.count()
    if not n:
        return None
    shares = F.array(*[F.lit((i + 1) / (cuts + 1)) for i in range(cuts)])
    rows = points.join(F.broadcast(hot) if n <= BROADCAST_KEYS else hot, "k")
    found = rows.groupBy("k").agg(F.array_distinct(F.percentile_approx("t", shares, 100 * (cuts + 1))).alias("cuts")).checkpoint(eager=True)
    return F.broadcast(found) if n <= BROADCAST_KEYS else found


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    left_time: str,
    right_time: str,
    values: dict[str, str],
    tie: Sequence[str] = (),
    direction: str = "backward",
    exact: bool = True,
    within: dt.timedelta | float | None = None,
    rows_per_segment: int = ROWS_PER_SEGMENT,
    cuts: int = CUTS,
) -> DataFrame:
    """Every left row with ``values`` (output name -> right column) of its match.

    ``on`` pairs left and right key columns; ``exact`` lets a right row at the
    same instant match; ``within`` bounds the distance. Of several right rows
    at the matching instant the one greatest by ``tie``, then by the values,
    counts. A left row without a match, or with a null key or time, keeps nulls;
    right rows with a null key or time match nothing; repeated left rows are
    answered each; an empty side is fine.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction is 'backward' or 'forward'")
    if not on or not values:
        raise ValueError("name at least one key and one value")
    if clash := set(values) & set(left.columns):
        raise ValueError(f"the left side already has {sorted(clash)}")
    sign = 1 if direction == "backward" else -1
    l_keys, r_keys = [a for a, _ in on], [b for _, b in on]
    key = lambda names: F.struct(*[F.col(n).alias(f"k{i}") for i, n in enumerate(names)])
    whole_l, whole_r = _complete([*l_keys, left_time]), _complete([*r_keys, right_time])
    pick = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(tie)], *[F.col(c).alias(f"v{i}") for i, c in enumerate(values.values())])
    r = right.where(whole_r).select(key(r_keys).alias("k"), (ticks(right, right_time) * sign).alias("t"), pick.alias("v"))
    r = r.groupBy("k", "t").agg(F.max("v").alias("v"))
    rows = left.where(whole_l).select(key(l_keys).alias("k"), (ticks(left, left_time) * sign).alias("t"), F.struct("*").alias("row"))
    # the type of both key structs is the left one's, and a time may be whole on one side only
    k_type, t_type = rows.schema["k"].dataType, "double" if "double" in (dict(r.dtypes)["t"], dict(rows.dtypes)["t"]) else "bigint"
    r = r.select(F.col("k").cast(k_type).alias("k"), F.col("t").cast(t_type).alias("t"), "v")
    rows = rows.withColumn("t", F.col("t").cast(t_type))
    points = rows.select("k", "t").unionByName(r.select("k", "t"))
    found = _hot_cuts(points, rows_per_segment, cuts)
    if found is None:
        r, rows = r.withColumn("seg", F.lit(0)), rows.withColumn("seg", F.lit(0))
    else:
        segment = F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("t"))), F.lit(0))
        r, rows = (x.join(found, "k", "left").withColumn("seg", segment).drop("cuts") for x in (r, rows))
    seen = F.struct("t", "v")
    stacked = rows.withColumn("m", F.lit(None).cast(r.select(seen.alias("m")).schema["m"].dataType)).withColumn("side", F.lit(1 if exact else 0))
    stacked = stacked.unionByName(r.select("k", "t", "seg", seen.alias("m"), F.lit(0 if exact else 1).alias("side"), F.lit(None).cast(rows.schema["row"].dataType).alias("row")))
    order = Window.partitionBy("k", "seg").orderBy("t", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    matched = stacked.withColumn("m", F.last("m", ignorenulls=True).over(order)).where("row is not null")
    if found is not None:
        # what each segment of a hot key starts with; rows of one hot key and segment are aggregated before they move
        last = r.join(found, "k", "left_semi").groupBy("k", "seg").agg(F.max(seen).alias("last"))
        every = found.select("k", F.explode(F.sequence(F.lit(0), F.size("cuts"))).alias("seg"))
        before = Window.partitionBy("k").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
        carry = every.join(last, ["k", "seg"], "left").select("k", "seg", F.last("last", ignorenulls=True).over(before).alias("carry"))
        matched = matched.join(carry, ["k", "seg"], "left").withColumn("m", F.coalesce("m", "carry"))
    if within is not None:
        far = F.col("t") - F.col("m.t") > F.lit(_span(left, left_time, within))
        matched = matched.withColumn("m", F.when(~far, F.col("m")))
    out = matched.select("row.*", *[F.col(f"m.v.v{i}").alias(name) for i, name in enumerate(values)])
    kinds = {name: right.schema[c].dataType for name, c in values.items()}
    rest = left.where(~whole_l).select("*", *[F.lit(None).cast(kinds[name]).alias(name) for name in values])
    return out.unionByName(rest)


# ---------------------------------------------------------------- spans


def _levelled(df: DataFrame, keys: Sequence[str], span: tuple[str, str], width: float, name: str) -> DataFrame:
    """k, start, stop (numbers), level and the row as ``name``, of every span that is one."""
    start, stop = ticks(df, span[0]), ticks(df, span[1])
    rows = df.where(_complete([*keys, *span]) & (start <= stop))
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    level = F.least(F.greatest(F.ceil(F.log2((stop - start) / F.lit(width))), F.lit(0)), F.lit(LEVELS)).cast("int")
    # log2 of a length of 0 is null
    return rows.select(key.alias("k"), start.cast("double").alias("start"), stop.cast("double").alias("stop"), F.coalesce(level, F.lit(0)).alias("level"), F.struct("*").alias(name))


def _bucketed(df: DataFrame, levels: Sequence[int], width: float) -> DataFrame:
    """Each span at its own level and at those higher ones that the other side has, in its buckets there."""
    wanted = F.array(*[F.lit(x) for x in levels]).cast("array<int>")
    at = F.array_distinct(F.concat(F.array("level"), F.filter(wanted, lambda x: x > F.col("level"))))
    size = F.lit(width) * F.pow(F.lit(2.0), F.col("at"))
    first, last = F.floor(F.col("start") / size), F.floor(F.col("stop") / size)
    return df.withColumn("at", F.explode(at)).withColumn("first", first).withColumn("bucket", F.explode(F.sequence(first, last)))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    width: dt.timedelta | float,
) -> DataFrame:
    """Pairs ``l``, ``r`` (both rows as structs) of one key whose closed spans overlap.

    ``width`` is the bucket of the shortest spans, best near the usual length;
    it changes the plan's cost, never its result. Spans with a null key, start
    or end, or that end before they start, overlap nothing; repeated rows pair
    each; an empty side gives no pairs. Lengths up to 2^``LEVELS`` widths have
    buckets of their own size.
    """
    w = float(_span(left, left_span[0], width))
    if w <= 0:
        raise ValueError("the width must be positive")
    a = _levelled(left, [x for x, _ in on], left_span, w, "l")
    b = _levelled(right, [y for _, y in on], right_span, w, "r")
    b = b.withColumn("k", F.col("k").cast(a.schema["k"].dataType))
    # which levels a side has: a handful of numbers
    has = [sorted(r["level"] for r in x.select("level").distinct().collect()) for x in (a, b)]
    a = _bucketed(a, has[1], w).select("k", "at", "bucket", *[F.col(c).alias(f"a_{c}") for c in ("start", "stop", "level", "first")], "l")
    b = _bucketed(b, has[0], w).select("k", "at", "bucket", *[F.col(c).alias(f"b_{c}") for c in ("start", "stop", "level", "first")], "r")
    overlap = (F.col("a_start") <= F.col("b_stop")) & (F.col("b_start") <= F.col("a_stop"))
    meeting = (F.col("at") == F.greatest("a_level", "b_level")) & (F.col("bucket") == F.greatest("a_first", "b_first"))
    return a.join(b, ["k", "at", "bucket"]).where(overlap & meeting).select("l", "r")
