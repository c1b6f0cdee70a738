"""Tables written once to the folder that driver and executors share.

A staged table cuts lineage: what it holds is never computed again, and the
loss of an executor costs no more than its running tasks.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_staged: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where it is unset, a temporary one is set on a local master, and is an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="siltstone-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(f"file://{folder}")
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


#: Whether a query's shuffle files go when it ends; otherwise they stay until the driver's garbage collector finds them unused.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def fleeting(spark: SparkSession):
    """Shuffle files of queries that are made and run within are removed once each has ended."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged-{label}-{uuid.uuid4().hex}"
    with fleeting(spark):
        df.write.option("compression", "zstd").parquet(path)
    _staged.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def recorded():
    """Collects the paths that are staged within."""
    first = len(_staged)
    paths: list[str] = []
    yield paths
    paths += _staged[first:]


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables; only once nothing reads them any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(conf).delete(path, True)
