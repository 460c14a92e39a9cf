"""Session helpers: building a session and locating the shared checkpoint folder."""

from __future__ import annotations

import atexit
import io
import os
import uuid
import zipfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "textloom") -> SparkSession:
    """Session for tests and local runs; on a cluster pass your own session instead."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The setting is read from the session. Where it is unset and the master is plain local mode (one
    machine by definition), the warehouse folder takes its place; on a cluster an unset value is an
    error, because a machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    current = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if not current:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder shared by the cluster")
        current = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/textloom-scratch"
        spark.conf.set(_CHECKPOINT_KEY, current)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def file_store(path: str):
    """``(file system, name)`` of a path or URI in the shared store."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def remove_table(path: str) -> None:
    """Delete a written scratch table that nothing reads any more."""
    store, name = file_store(path)
    store.delete_dir(name)


_SHIPPED: set[str] = set()
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Texts are long: Arrow batches end at ``BATCH_BYTES`` instead of Spark's default of 64 MB, unless the session says otherwise.

    An executor holds a batch of every task twice, in the JVM and in the worker.
    """
    if spark.conf.get(_BATCH_BYTES, None) in ("67108864b", "64MB", "64m"):
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the workers, wherever they were started: its sources go to them once per application."""
    bound_batches(spark)
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = f"{scratch_path(spark, 'package')}/textloom.zip"
    store, name = file_store(path)
    store.create_dir(name.rpartition("/")[0], recursive=True)
    with store.open_output_stream(name, compression=None) as out:
        out.write(raw.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one written table.

    It lives as long as the application: results are lazy and read it, so it is removed when the
    driver's interpreter ends, or before by :func:`remove_scratch`.
    """
    if not _SCRATCH:
        atexit.register(remove_scratch)
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def remove_scratch() -> None:
    """Delete all scratch tables of this application; nothing that was built from them can be read afterwards."""
    from pyarrow import fs

    while _SCRATCH:
        store, name = file_store(_SCRATCH.pop())
        if store.get_file_info(name).type != fs.FileType.NotFound:
            store.delete_dir(name)


def materialize(df, name: str):
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Used where two branches of a plan must see exactly the same rows (e.g. the
    same partition numbering). It also cuts lineage, and a lost executor
    cannot change what was written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
