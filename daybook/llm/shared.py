"""The folder that driver and executors share, and small DataFrame helpers."""

from __future__ import annotations

import atexit
import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Where it is unset and the master is local (tests), an own folder is set as
    the checkpoint directory; on a cluster an unset folder is an error, because
    no machine-local folder would be seen by the other machines.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="daybook-llm-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def ship(spark: SparkSession) -> None:
    """Give executors this package, once for each application, where it is not installed on them.

    Python workers hold a few Arrow batches of texts at a time; where the
    session has the default of 64 MB a batch, it is lowered.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH_BYTES, "67108864b") == "67108864b":
        spark.conf.set(BATCH_BYTES, "8m")
    if getattr(context, "_daybook_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="daybook-code-"), "daybook.zip")  # the driver serves it
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                out.write(os.path.join(folder, name), os.path.join("daybook", os.path.relpath(os.path.join(folder, name), package)))
    context.addPyFile(path)
    context._daybook_shipped = True


Batches = Iterator[pa.RecordBatch]


def _release() -> None:
    """Give memory that is free to the system: Arrow's pool and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function for mapInArrow whose worker holds no freed memory between batches, nor when idle after the task."""

    def held(batches: Batches) -> Batches:
        def each() -> Batches:
            for batch in batches:
                yield batch
                del batch
                _release()

        yield from run(each())
        _release()

    return held


def run_dir(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, not created yet; it is removed when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        context = spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
    except Exception:  # noqa: BLE001 - the gateway is already gone; only scratch stays behind
        pass


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def slots(spark: SparkSession) -> int:
    """Shuffle partitions of the session, for explicit repartitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def source(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id (bigint) and the text, under fixed names.

    Whatever other columns the caller has, and whatever they are called, they
    cannot clash with an operator's own columns after this.
    """
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
