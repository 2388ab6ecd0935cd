"""Session settings, and making this package known to Python workers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("sparquern")
    settings = {
        "spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": memory, "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.sql.adaptive.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in (settings | conf).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ready(spark)


def ready(spark: SparkSession) -> SparkSession:
    """Send this package to the workers, once for each application, unless their path has it already."""
    paths = [Path(p or ".").resolve() for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(":")]]
    app = spark.sparkContext.applicationId
    if ROOT not in paths and app not in _shipped:
        folder = tempfile.mkdtemp(prefix="sparquern-ship-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/sparquern", "zip", ROOT, "sparquern"))
        _shipped.add(app)
    return spark


_own: list[str] = []
_written: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or what setCheckpointDir() has set.

    A folder of our own serves only on a single machine; a cluster that names none is an error, as its
    executors would each write to their own disk.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="sparquern-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return f"file://{_own[0]}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table; clear_scratch() deletes what was written there."""
    _written.append(f"{scratch_dir(spark)}/sparquern-{name}-{uuid.uuid4().hex}")
    return _written[-1]


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read back.

    It cuts the lineage, so later stages survive lost executors, and each reader gets the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """df.checkpoint() into the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark))
    return df.checkpoint(eager=True)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables of this session; results that still read them must have been written. Gives their number."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    done = 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        done += bool(path.getFileSystem(conf).delete(path, True))
    return done


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
