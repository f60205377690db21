"""Session settings, and where scratch tables go."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings the jobs count on. AQE turns a shuffled join into a broadcast one
# only when the measured size allows it, and splits skewed partitions. Generated
# code of a wide projection is cut up before it grows past what the JVM compiles.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", memory: str = "8g", name: str = "salesmill") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def free_shuffles(spark: SparkSession) -> None:
    """Let the files of shuffles that are done with go.

    They lie on the disks until the driver's JVM collects the frames they belong to. It
    makes little garbage of its own, so it may not do so before the disks are full.
    """
    gc.collect()
    spark._jvm.System.gc()


@contextlib.contextmanager
def open_writers(spark: SparkSession, count: int) -> Iterator[None]:
    """Within this, a task that writes up to ``count`` folders keeps a file open in each.

    Otherwise it sorts its rows by folder first, and spills what it cannot hold.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, count)
    try:
        yield
    finally:
        spark.conf.set(name, before)


_ROOTS: dict[str, str] = {}


def _scratch_root(spark: SparkSession) -> str:
    """The folder of this application in the scratch space, deleted when its JVM ends."""
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            base = tempfile.mkdtemp(prefix="salesmill-")
        root = f"{base.rstrip('/')}/salesmill-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _ROOTS[app] = root
    return _ROOTS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder in the shared scratch space of the cluster.

    The cluster names that space in ``spark.checkpoint.dir``. A local session
    may do without; elsewhere a machine-local folder would be invisible to the
    other machines, so its absence is an error.
    """
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
