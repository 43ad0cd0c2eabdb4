from __future__ import annotations

from pyspark.sql import types as T

from daybook.spec import SeriesSpec

SPEC = SeriesSpec(k="k", d="d", v="v", order_cols=("ts",), expected_keys=())
SERIES = T.StructType(
    [T.StructField("k", T.StringType()), T.StructField("d", T.StringType()), T.StructField("v", T.DoubleType())]
)


def series(spark, rows):
    return spark.createDataFrame(rows, SERIES)


def rows_of(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def same(a, b):
    """Equal as multisets (exceptAll both ways)."""
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
