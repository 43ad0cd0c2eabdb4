"""Previous value of a key by date.

The default is the plain ``lag(v) OVER (PARTITION BY key ORDER BY date)``: a
deduplicated series has at most one row for each key and calendar day, so no
group is large however often the raw rows were copied, and what follows can
group by the key without another shuffle.

For input that is *not* unique per (key, date), ``segment=YEAR`` splits each
key's series by a prefix of the date string and shuffles **once** on
(key, segment); everything below reads that one exchange:

1. ``lag`` runs over ``PARTITION BY key, segment`` - many small groups, so a
   long or hot key is spread over as many tasks as it has years;
2. each (key, segment)'s last (date, value) is aggregated in place (the data
   is already partitioned that way, no exchange); a ``lag`` over those rows -
   one per key and year, bounded by the calendar - gives every segment the
   last value of the previous non-empty segment (the "carry");
3. the carry is joined back on (key, segment) and a segment's first row takes
   it, every other row its in-segment ``lag``.

The join keys are the partitioning columns themselves and are never NULL
(the key is wrapped in a struct - a struct holding a NULL key is not NULL and
compares equal to another such struct - and a NULL date gets the empty
segment), so a plain equi-join matches NULL keys and keeps the partitioning:
when the carry is too big to broadcast, only the carry is shuffled, and the
window needs no further exchange. Two full shuffles in all (the caller's
dedup and this one), the same as the unsplit window.

The key travels only inside the group struct, so both branches read the very
same columns from the exchange and Spark computes it once (``ReusedExchange``);
with the key as a separate column the carry branch would prune it and run the
whole input a second time.

A prefix of a string orders like the string (and the empty segment of NULL
dates sorts first, as NULL does), so segment order equals date order and the
result is the plain ``lag`` exactly (tests compare them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

YEAR = 4  # length of the date prefix that names a segment ("yyyy")


def with_previous_value(
    df: DataFrame, k: str, d: str, v: str, out: str = "_prev", segment: int | None = None
) -> DataFrame:
    """Columns ``k, d, v`` and ``out``: ``v`` at the key's previous available date."""
    if not segment:
        w = Window.partitionBy(k).orderBy(F.col(d))
        return df.select(k, d, v, F.lag(F.col(v)).over(w).alias(out))
    grp, seg = "_grp", "_seg"
    s = df.select(
        F.struct(F.col(k)).alias(grp),
        F.coalesce(F.substring(F.col(d), 1, segment), F.lit("")).alias(seg),
        F.col(d),
        F.col(v),
    ).repartition(grp, seg)
    last = s.groupBy(grp, seg).agg(F.max(F.struct(F.col(d).alias("d"), F.col(v).alias("v"))).alias("_last"))
    carry = last.select(
        grp, seg, F.lag(F.col("_last.v")).over(Window.partitionBy(grp).orderBy(seg)).alias("_carry")
    )
    joined = s.join(carry, on=[grp, seg], how="left")
    w = Window.partitionBy(grp, seg).orderBy(F.col(d))
    prev = F.when(F.row_number().over(w) == 1, F.col("_carry")).otherwise(F.lag(F.col(v)).over(w))
    return joined.select(F.col(f"{grp}.{k}").alias(k), d, v, prev.alias(out))
