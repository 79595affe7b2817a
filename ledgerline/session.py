"""Session construction and lineage checkpoints.

On a cluster the session already exists and names a shared checkpoint folder in
``spark.checkpoint.dir``; we read it from there.  Only local runs (tests, bench)
get a scratch folder of their own, and only when the setting is unset.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "16g",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def local_session(master: str | None = None, app: str = "ledgerline", **extra) -> SparkSession:
    """A local session for tests and the benchmark (never used on a cluster)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    for k, v in {**LOCAL_CONF, **extra}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_local_folders: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Set and return the shared checkpoint folder; a local master without one gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        folder = _local_folders[app]
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_checkpoint(df: DataFrame) -> None:
    """Delete the files of a frame that ``cut_lineage`` returned, or of the one that ``df`` selects from; nothing may be computed from it
    any more."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    stored = leaves.head().rdd().getCheckpointFile()
    if leaves.size() != 1 or not stored.isDefined():
        raise ValueError("not a checkpoint")
    delete_files(df.sparkSession, stored.get())


def delete_files(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that this library wrote to the shared folder and that nothing reads any more."""
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(context.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends there, and columns are read as needed."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_sent: set[str] = set()
_sending = threading.Lock()  # fits run in threads; Spark refuses a second archive of the same name


def send_library(spark: SparkSession) -> None:
    """Give the executors this library's code, once per application, for the steps that run in Python there."""
    context = spark.sparkContext
    with _sending:
        if context.applicationId not in _sent:
            package = os.path.dirname(os.path.abspath(__file__))
            name = os.path.basename(package)
            archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), f"{name}-code"), "zip", os.path.dirname(package), name)
            context.addPyFile(archive)
            _sent.add(context.applicationId)


def in_arrow(df: DataFrame, step: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow(step, schema)`` with the library's code on the executors."""
    send_library(df.sparkSession)
    return df.mapInArrow(step, schema)
