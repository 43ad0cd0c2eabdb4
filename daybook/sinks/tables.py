"""Parquet table sinks: append with schema growth, replace, CTAS, views,
and write verification.

Locations: a table's staging directory lies beside the table, so publishing it
is one rename on the table's own file system; scratch tables lie under the
cluster's shared checkpoint folder (``spark.checkpoint.dir``) and are removed
when the application ends. Nothing is written to a machine-local folder: a
session without a checkpoint folder is an error.

An appended batch is one directory below the table (``batch-<id>``), published
by a single rename: a reader sees all of it or nothing.

A replace renames the old table aside and the new one in. Where the process ends
between the two, the table is only there under its name aside: ``read_table``
reads it there, and the next write puts it back first (``recover``). A table has
one writer at a time.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_scratch: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; it must be configured."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory name under the shared folder, removed at the application's end."""
    base = f"{shared_dir(spark)}/daybook/{spark.sparkContext.applicationId}"
    if base not in _scratch:
        _scratch.add(base)
        atexit.register(_remove_scratch, spark, base)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def _remove_scratch(spark: SparkSession, base: str) -> None:
    try:
        fs, p = _fs(spark, base)
        fs.delete(p, True)
    except Exception:  # noqa: BLE001 - the gateway is already gone; only scratch stays behind
        pass


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    p = _path(spark, path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def quarantine_path(bronze_path: str) -> str:
    """Records of a bronze table that were not accepted, with reason and source file."""
    return f"{bronze_path.rstrip('/')}.__quarantine"


def report_path(bronze_path: str) -> str:
    """Quality reports of a bronze table's streamed batches."""
    return f"{bronze_path.rstrip('/')}.__reports"


def _set_aside(spark: SparkSession, path: str) -> list:
    """Old versions of a table that a replace left under their names aside, newest first."""
    fs, p = _fs(spark, path)
    found = fs.globStatus(_path(spark, f"{path.rstrip('/')}.__replaced-*"))
    return sorted(found or [], key=lambda f: f.getModificationTime(), reverse=True)


def recover(spark: SparkSession, path: str) -> bool:
    """Put back a table whose replace was interrupted; True if there was one.

    Old versions left behind by a replace that did happen are deleted. Writers
    call it before they touch a table.
    """
    fs, target = _fs(spark, path)
    aside = _set_aside(spark, path)
    back = bool(aside) and not fs.exists(target)
    if back:
        _move(fs, aside.pop(0).getPath(), target, "put the old table back")
    for f in aside:
        fs.delete(f.getPath(), True)
    return back


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None, merge: bool = False) -> DataFrame:
    """Read a table written by these sinks, all of its batches.

    Pass ``schema`` where the columns are known (no footer is read, and a table
    without files reads as empty), or ``merge`` for a table whose appended
    batches added columns (NULL for older batches; reads every footer). A table
    that an interrupted replace left aside is read there.
    """
    if not path_exists(spark, path):
        aside = _set_aside(spark, path)
        path = aside[0].getPath().toString() if aside else path
    reader = spark.read.option("recursiveFileLookup", "true")
    if schema is not None:
        return reader.schema(schema).parquet(path)
    return reader.option("mergeSchema", str(merge).lower()).parquet(path)


def _move(fs, src, dst, what: str) -> None:
    if not fs.rename(src, dst):
        raise OSError(f"could not {what}: {src} -> {dst}")


# ---------------------------------------------------------------- F1


def append_table(df: DataFrame, path: str) -> None:
    """append; a batch may carry columns the table does not have yet."""
    spark = df.sparkSession
    append_staged(spark, stage(df, path), path)


def append_staged(spark: SparkSession, staged: str, path: str) -> str:
    """Publish a staged write as one batch directory of ``path``: one rename,
    whatever the number of files; no row is read or copied again."""
    recover(spark, path)
    fs, target = _fs(spark, path)
    fs.mkdirs(target)
    batch = f"{path.rstrip('/')}/batch-{uuid.uuid4().hex[:12]}"
    _move(fs, _path(spark, staged), _path(spark, batch), "publish the batch")
    return batch


def discard(spark: SparkSession, staged: str) -> None:
    """Drop a staged directory that failed its gate."""
    fs, p = _fs(spark, staged)
    fs.delete(p, True)


# ---------------------------------------------------------------- F2


def stage(df: DataFrame, path: str, observation: Observation | None = None) -> str:
    """Write ``df`` beside ``path`` in a fresh staging directory."""
    staged = f"{path.rstrip('/')}.__staging-{uuid.uuid4().hex[:12]}"
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("written"))
    try:
        df.write.parquet(staged)
    except Exception:
        discard(df.sparkSession, staged)
        raise
    return staged


def publish_staged(spark: SparkSession, staged: str, path: str) -> DataFrame:
    """Swap a staged directory in as ``path``: the old table is renamed aside,
    the new one renamed in, and only then the old one deleted. If the second
    rename fails the old table is put back; if the process ends before it, the
    next read or write finds the old table aside."""
    recover(spark, path)
    fs, target = _fs(spark, path)
    src, aside = _path(spark, staged), None
    if fs.exists(target):
        aside = _path(spark, f"{path.rstrip('/')}.__replaced-{uuid.uuid4().hex[:12]}")
        _move(fs, target, aside, "set the old table aside")
    try:
        fs.mkdirs(target.getParent())
        _move(fs, src, target, "publish the table")
    except Exception:
        if aside is not None:
            fs.rename(aside, target)
        raise
    if aside is not None:
        fs.delete(aside, True)
    return read_table(spark, path)


def overwrite_table(df: DataFrame, path: str) -> DataFrame:
    """replace data and schema at ``path``.

    Writing straight over a path the plan still reads fails (or loses data),
    so the new version is written to a staging directory first and renamed
    into place after the write job has finished reading the old one.
    """
    staged = stage(df, path)
    return publish_staged(df.sparkSession, staged, path)


# ---------------------------------------------------------------- F3 / F4


def _location(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _note(spark: SparkSession, base: str, text: str | None) -> str | None:
    """Write (or, without a text, read) the version that a replacement is about to point the table to."""
    fs, p = _fs(spark, f"{base.rstrip('/')}/_pending")
    if text is None:
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return text


def _drop_note(spark: SparkSession, base: str) -> None:
    fs, p = _fs(spark, f"{base.rstrip('/')}/_pending")
    fs.delete(p, False)


def _versions(spark: SparkSession, name: str, path: str | None) -> str:
    return path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}.__versions"


def open_table(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """The table, after completing a replacement that was interrupted between its drop and its creation."""
    base = _versions(spark, name, path)
    pending = _note(spark, base, None)
    if pending is not None:
        if not spark.catalog.tableExists(name):
            _create(spark, name, pending)
        elif _location(spark, name).rstrip("/").rsplit("/", 1)[-1] != pending.rsplit("/", 1)[-1]:
            discard(spark, pending)  # the drop never happened: the old version stays
        _drop_note(spark, base)
    return spark.table(name)


def _create(spark: SparkSession, name: str, version: str) -> None:
    spark.catalog.createTable(name, path=version, source="parquet")


def create_or_replace_table_as(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``CREATE OR REPLACE TABLE name AS`` - replaces rows and columns.

    The data is written once, to a version directory of its own (below
    ``path``, or below the warehouse), and the table is then pointed there, so
    a query that reads ``name`` itself can replace it. Where the columns stay
    the same this is one change of the table's location. Otherwise the table
    is dropped and created anew; the new version is noted first, so that
    ``open_table`` or the next replacement completes one that was interrupted.
    The version it replaces is deleted last; a failed write leaves the table as
    it was.
    """
    spark = df.sparkSession
    base = _versions(spark, name, path)
    if _note(spark, base, None) is not None:
        open_table(spark, name, path)
    version = f"{base.rstrip('/')}/version-{uuid.uuid4().hex[:12]}"
    try:
        df.write.parquet(version)
    except Exception:
        discard(spark, version)
        raise
    old = _location(spark, name)
    ours = bool(old) and "/version-" in old
    if ours and spark.table(name).dtypes == df.dtypes:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        spark.catalog.refreshTable(name)
    else:
        _note(spark, base, version)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        _create(spark, name, version)
        _drop_note(spark, base)
    if ours:
        discard(spark, old)
    return spark.table(name)


def create_or_replace_view(df: DataFrame, name: str) -> DataFrame:
    """named lazy query, evaluated whenever it is read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


# ---------------------------------------------------------------- F5


def verify_write(df: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """write ``df`` and return ``(written, table_total)``.

    ``written`` is counted by an ``Observation`` on the write job itself (no
    second run of the plan); ``table_total`` is a count of the target.
    """
    spark = df.sparkSession
    obs = Observation(f"daybook_write_{uuid.uuid4().hex[:8]}")
    staged = stage(df, path, observation=obs)
    if mode == "append":
        append_staged(spark, staged, path)
    elif mode == "overwrite":
        publish_staged(spark, staged, path)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    written = int(obs.get["written"])
    return read_table(spark, path).agg(F.lit(written).cast("long").alias("written"), F.count(F.lit(1)).alias("table_total"))
