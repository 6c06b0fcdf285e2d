"""Tables that cut lineage, kept in the folder all executors share.

The folder is the one named in ``spark.checkpoint.dir``.  Only a plain local session may leave it unset; it then
gets a temporary folder of its own.
"""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}
_open: list["Scratch"] = []


def shared_folder(spark: SparkSession) -> str:
    set_by_cluster = spark.conf.get("spark.checkpoint.dir", "")
    if set_by_cluster:
        return set_by_cluster.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if sc.applicationId not in _local:
        path = tempfile.mkdtemp(prefix="recordloom-scratch-")
        _local[sc.applicationId] = path
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    return f"file://{_local[sc.applicationId]}"


class Scratch:
    """A folder of Parquet tables that belongs to one run of one operator; removed when the driver ends."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        _open.append(self)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return it as a scan: one attempt's files count, a lost executor costs no recomputation."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no plan reads any more, and let Spark delete shuffle files whose plans are gone."""
        for name in names:
            self._delete(f"{self.root}/{name}")
        release(self.spark)

    def _delete(self, path: str) -> None:
        sc = self.spark.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


@atexit.register
def _clean() -> None:
    for s in _open:
        try:
            s._delete(s.root)
        except Exception:  # the session may have ended before
            return
