"""Session settings.

On a cluster the session is given; only settings that are unset are filled
in. ``local_session`` is for tests and the benchmark.

``STATIC_DEFAULTS`` can only be given when the session is built (spark-submit
``--conf`` on a cluster). ``spark.python.sql.dataFrameDebugging.enabled``
makes PySpark record the Python call site of every DataFrame function call
(several JVM round trips each); the report and summary plans are built from
hundreds of column expressions, so it adds about a second of driver time per
query. It only enriches error messages.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every plan in this package relies on. ANSI stays on (the code uses
# try_* where data may be bad).
PLAN_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


STATIC_DEFAULTS = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    for k, v in PLAN_DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "daybook") -> SparkSession:
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**STATIC_DEFAULTS, **PLAN_DEFAULTS}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
