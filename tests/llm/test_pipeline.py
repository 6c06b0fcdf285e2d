import os
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import __spark_entry__
import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"file://{tmp_path}/{k}")
        docs = spark.read.parquet(f"file://{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns and 0 < docs.count() <= before
            before = docs.count()
        if k == 3:
            assert docs.where(F.lit(False) if not bench else F.exists(F.array(*map(F.lit, bench)), lambda b: F.col("text").contains(b))).count() == 0
            left = {r["doc_id"] for r in docs.collect()}
    assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} == left
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_stages_send_small_batches(spark):
    import corpus_pipeline

    before = spark.conf.get(corpus_pipeline.ROWS)
    try:
        spark.conf.set(corpus_pipeline.ROWS, 10_000)
        stage = corpus_pipeline._in_small_batches(lambda spark, docs, sf_dir: docs)
        assert stage(spark, spark.range(3), "").count() == 3 and int(spark.conf.get(corpus_pipeline.ROWS)) == corpus_pipeline.BATCH
        assert all(f.__wrapped__ for _, f in corpus_pipeline.STAGES)
    finally:
        spark.conf.set(corpus_pipeline.ROWS, before)
