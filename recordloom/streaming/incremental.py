"""Incremental runs with Structured Streaming: a budget of files each time, keys seen once, what is left over later."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 100, kind: str = "parquet") -> DataFrame:
    """New files of a folder, at most so many a batch; the checkpoint is the cursor."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(kind).load(path)


def seen_once(stream: DataFrame, keys: list[str], event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """The first row of each key.  With an event time, state is bounded by the watermark: a key that comes back more than ``delay``
    after it was seen counts as new.  Without, the state holds every key; it is on disk, and a batch looks up only its own."""
    state_on_disk(stream.sparkSession)
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys) if event_time else stream.dropDuplicates(keys)


def drain(stream: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    """Process all that is there now, and stop."""
    query = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()


def state_on_disk(spark: SparkSession) -> None:
    """Keyed state in RocksDB, of which each batch saves what it changed: neither memory nor a batch's cost grows with the keys.
    Space on disk is not taken ahead, which would be 4 MB for each of the shuffle partitions, however few their keys."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")


def new_keys(stream: DataFrame, keys: list[str], order: str, known: DataFrame | None = None) -> DataFrame:
    """The first row of each key that neither an earlier batch nor ``known`` held; within a batch the smallest by ``order``, null last.
    To be written in update mode.

    ``known`` is a stream with the key columns (such as of a target written before) that is there whole in the first batch.  A null key
    is a key like others.  The state holds every key and its first row, on disk; a key is new in the batch whose time is its only one.
    ``seen_once`` with an event time forgets keys instead."""
    state_on_disk(stream.sparkSession)
    rows = stream.select(*keys, F.lit(False).alias("_rl_known"), F.struct(*stream.columns).alias("_rl_row"))
    if known is not None:
        rows = rows.unionByName(known.select(*keys, F.lit(True).alias("_rl_known")), allowMissingColumns=True)
    rows = rows.withColumn("_rl_at", F.current_timestamp())  # the time of the batch, also when it is repeated
    rank = F.struct("_rl_at", ~F.col("_rl_known"), F.col(f"_rl_row.{order}").isNull(), F.col(f"_rl_row.{order}"))
    seen = rows.groupBy(*keys).agg(F.min_by("_rl_row", rank).alias("_rl_row"), F.bool_or("_rl_known").alias("_rl_known"), F.min("_rl_at").alias("_rl_since"), F.max("_rl_at").alias("_rl_last"))
    return seen.where(~F.col("_rl_known") & (F.col("_rl_since") == F.col("_rl_last"))).select("_rl_row.*")


def read_appended(spark: SparkSession, target: str) -> DataFrame:
    """What is in a folder that runs append to, at any depth."""
    return spark.read.option("recursiveFileLookup", True).parquet(target)


def append_new(stream: DataFrame, keys: list[str], order: str, target: str, checkpoint: str) -> None:
    """Append to a Parquet folder the rows whose key it lacks.  The first run learns the keys that are there, from a copy of them
    beside the checkpoint, so that they count also if it is repeated; later ones look up only those of their own rows.  Each batch
    goes to a folder of its own, which a repeated batch writes anew."""
    spark = stream.sparkSession
    place = f"{checkpoint}/{KNOWN}"
    if not _there(spark, f"{place}/_SUCCESS"):
        there = read_appended(spark, target) if _there(spark, target) else spark.createDataFrame([], stream.schema)
        there.select(*keys).write.mode("overwrite").parquet(place)
    known = spark.readStream.schema(stream.select(*keys).schema).parquet(place)

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/{RUN}{number}")

    fresh = new_keys(stream, keys, order, known)
    fresh.writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


#: Folders of batches start with this; it is no partition column.
RUN = "appended-"

#: Folder of a checkpoint for the keys that its target held before the first run.
KNOWN = "known"


def _there(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def windowed_counts(stream: DataFrame, event_time: str, window: str, keys: list[str], delay: str = "10 minutes") -> DataFrame:
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, window), *keys).agg(F.count(F.lit(1)).alias("n"))


def two_hops(edges: DataFrame, start: DataFrame, src: str, dst: str, node: str) -> DataFrame:
    """Nodes within two links of the start, each with its smallest distance."""
    first = start.select(F.col(node)).withColumn("hop", F.lit(0))
    step = edges.select(F.col(src).alias("_rl_s"), F.col(dst).alias(node))
    one = step.join(first, step["_rl_s"] == first[node], "left_semi").select(node).withColumn("hop", F.lit(1))
    two = step.join(one.select(F.col(node).alias("_rl_n")), F.col("_rl_s") == F.col("_rl_n"), "left_semi").select(node).withColumn("hop", F.lit(2))
    return first.unionByName(one).unionByName(two).groupBy(node).agg(F.min("hop").alias("hop"))
