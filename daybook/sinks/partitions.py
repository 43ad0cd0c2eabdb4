"""Tables partitioned by one column: merge corrections, rewrite touched partitions only.

``merge_rows`` (MERGE / upsert) brings new rows and late corrections into such a
table: it reads only the partitions that the updates touch, keeps the newest
version of every key, and replaces these partitions as a whole. A key must lie
in one partition (a month of its date, say), so no other one can hold it.

Replacing survives the end of the process at any point. The new partitions are
written to a staging directory; renaming that to ``<table>.__commit-<id>`` is the
one step that decides. From then on every partition is moved in by renames, and
a move that was interrupted is completed by the next write, or by ``recover``.
Before that step nothing of the table has changed. A reader in between sees each
partition either old or new. A table has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.silver import latest_per_key
from daybook.sinks.tables import _fs, _move, _path, path_exists

OLD = "_old"


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table with its known columns (the partition column typed as given)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def _commits(spark: SparkSession, path: str) -> list[str]:
    fs, _ = _fs(spark, path)
    found = fs.globStatus(_path(spark, f"{path.rstrip('/')}.__commit-*"))
    return sorted(f.getPath().toString() for f in found or [])


def _move_in(spark: SparkSession, commit: str, path: str) -> int:
    """Move the partitions of a decided replacement in; every step can be repeated."""
    fs, target = _fs(spark, path)
    fs.mkdirs(target)
    old = _path(spark, f"{commit}/{OLD}")
    fs.mkdirs(old)
    moved = 0
    for f in fs.listStatus(_path(spark, commit)):
        name = f.getPath().getName()
        if not f.isDirectory() or name.startswith("_"):
            continue
        here = _path(spark, f"{path.rstrip('/')}/{name}")
        if fs.exists(here):
            _move(fs, here, _path(spark, f"{commit}/{OLD}/{name}"), "set the old partition aside")
        _move(fs, f.getPath(), here, "move the partition in")
        moved += 1
    fs.delete(_path(spark, commit), True)
    return moved


def recover(spark: SparkSession, path: str) -> int:
    """Complete replacements that were decided but not finished; the number of partitions moved."""
    return sum(_move_in(spark, c, path) for c in _commits(spark, path))


def replace_partitions(df: DataFrame, path: str, by: str) -> int:
    """Replace the partitions that ``df`` has rows of; all others stay as they are."""
    spark = df.sparkSession
    recover(spark, path)
    mark = uuid.uuid4().hex[:12]
    staged = f"{path.rstrip('/')}.__staging-{mark}"
    fs, _ = _fs(spark, path)
    try:
        # one task for each partition's rows or part of them: a hot partition is split, small ones make one file
        df.hint("rebalance", F.col(by)).write.partitionBy(by).parquet(staged)
    except Exception:
        fs.delete(_path(spark, staged), True)
        raise
    commit = f"{path.rstrip('/')}.__commit-{mark}"
    _move(fs, _path(spark, staged), _path(spark, commit), "decide the replacement")
    return _move_in(spark, commit, path)


def touched(updates: DataFrame, by: str) -> list:
    """The partitions that updates lie in (names of partitions, not rows)."""
    return sorted((r[0] for r in updates.select(by).distinct().collect()), key=lambda x: (x is not None, x))


def _in(by: str, values: Sequence) -> Column:
    some = F.col(by).isin([v for v in values if v is not None])
    return some | F.col(by).isNull() if None in values else some


def merge_rows(updates: DataFrame, path: str, keys: Sequence[str], order_cols: Sequence[str], by: str) -> list:
    """Insert new keys, replace keys of which an update is newer by ``order_cols``; the touched partitions.

    Updates have the table's columns, its partition column among them. Late
    corrections, repeated ones and ones that are older than what the table has
    give the same table in any order of arrival. Empty updates change nothing.
    """
    spark = updates.sparkSession
    recover(spark, path)
    where = touched(updates, by)
    if not where:
        return []
    present = read_partitioned(spark, path, updates.schema).where(_in(by, where))
    merged = latest_per_key(present.unionByName(updates), keys, order_cols)
    replace_partitions(merged, path, by)
    return where
