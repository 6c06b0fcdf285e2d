"""Session helpers shared by every subpackage."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_local: dict[str, str] = {}
_runs: list[tuple[SparkSession, str]] = []


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("recordloom")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for the Arrow functions that import it there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(here)
    path = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(here):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, here)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a plain local session that leaves it unset gets a temporary one, until the driver ends."""
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if sc.applicationId not in _local:
        _local[sc.applicationId] = tempfile.mkdtemp(prefix="recordloom-")
        atexit.register(shutil.rmtree, _local[sc.applicationId], ignore_errors=True)
    return f"file://{_local[sc.applicationId]}"


def run_folder(spark: SparkSession, label: str) -> str:
    """A folder of its own for one run, in the shared one; removed when the driver ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _runs.append((spark, path))
    return path


@atexit.register
def _remove_runs() -> None:
    for spark, path in _runs:
        try:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session may have ended before
            return


def spread(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """``df`` in one task for every so many rows, for work that costs much a row: a large table may be a small file, or few partitions."""
    tasks = -(-df.count() // rows)
    return df.repartition(tasks) if tasks > 1 else df


def give_back() -> None:
    """Return what a worker has freed to the system; workers stay, and what they hold on to counts against the stages after."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the Parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
