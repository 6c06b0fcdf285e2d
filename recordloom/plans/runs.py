"""Queries of sources and sinks that keep state between runs, each beside its SQL: workbooks, page cursors, seen keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..runtime import run_folder, ship, table
from ..sources import files, workbook
from ..streaming import cursor, incremental
from .book import query as _query


def table_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table as a stream of its files, whether it is a file or a folder of them."""
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf}/{name}.parquet")
    folder = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf}/{name}.parquet" if folder else f"{sf}/{name}*.parquet")


#: Sheets that are read, and what holds for each.
COUNTRIES = {"Costa Rica": {"country": "CR", "name_format": "family_first"}, "Panama": {"country": "PA", "name_format": "given_first"}, "Ecuador": {"country": "EC", "name_format": "family_first"}}


@_query("""SELECT client_id, coalesce(name, '') AS name, coalesce(email, '') AS email, coalesce(segment, '') AS category, CASE nation_id % 4 WHEN 0 THEN 'CR' WHEN 1 THEN 'PA' ELSE 'EC' END AS country,
    CASE nation_id % 4 WHEN 1 THEN 'given_first' ELSE 'family_first' END AS name_format, balance, CAST(updated_at AS DATE) AS day, updated_at, client_id % 3 = 0 AS flag FROM clients WHERE nation_id % 4 < 3""")
def workbook_round_trip(spark, sf) -> DataFrame:
    """Clients are written to workbooks, a sheet a country, and read again; a sheet without settings is left out."""
    ship(spark)
    c = table(spark, sf, "clients").where("nation_id is not null")
    sheet = F.element_at(F.array(*map(F.lit, [*COUNTRIES, "Notes & <more>"])), (F.col("nation_id") % 4 + 1).cast("int"))
    out = c.select(sheet.alias("sheet"), F.col("client_id").alias("Id"), F.col("segment").alias(" Especialidad"), F.col("name").alias("Nombre"), F.col("email").alias("Correo"), F.col("balance").alias("Saldo"),
                   F.col("updated_at").cast("date").alias("Dia"), F.col("updated_at").alias("Hora"), (F.col("client_id") % 3 == 0).alias("Marca"))
    folder = run_folder(spark, "workbooks")
    workbook.write_workbooks(out, folder, "sheet", ["Id"], 4)
    rows = workbook.read_workbooks(spark, folder)
    roles = {"id": ("id",), "name": ("nombre", "name"), "email": ("email", "correo"), "category": ("especialidad",), "balance": ("saldo",), "day": ("dia",), "at": ("hora",), "flag": ("marca",)}
    found = workbook.by_sheet(rows, roles, COUNTRIES)
    at = F.when(F.length("at") == 10, F.concat("at", F.lit(" 00:00:00"))).otherwise(F.col("at"))
    return found.select(F.col("id").cast("long").alias("client_id"), "name", "email", "category", "country", "name_format", F.when(F.col("balance") != "", F.col("balance")).cast("double").alias("balance"),
                        F.when(F.col("day") != "", F.col("day")).cast("date").alias("day"), F.when(at != "", at).cast("timestamp_ntz").alias("updated_at"), (F.col("flag") == "true").alias("flag"))


@_query("""SELECT sale_id, client_id, total FROM sales""")
def budgeted_pages(spark, sf) -> DataFrame:
    """Sales as pages of three sources' answers, each ended by a page without records; runs of a limited number of pages take them
    all in, each from where the one before ended."""
    ship(spark)
    place, size = run_folder(spark, "cursor"), 500
    s = table(spark, sf, "sales").select((F.col("sale_id") % 3).alias("k"), (F.floor(F.col("sale_id") / (3 * size)) + 1).alias("page"), F.struct("sale_id", "client_id", "total").alias("r"))
    pages = s.groupBy("k", "page").agg(F.count(F.lit(1)).alias("n"), F.to_json(F.collect_list("r")).alias("records"))
    known = pages.groupBy("k").agg(F.sum("n").alias("total"), F.max("page").alias("last"))
    ends = known.select("k", (F.col("last") + 1).alias("page"), F.lit(0).cast("long").alias("n"), F.lit("[]").alias("records"))
    body = F.concat(F.lit('{"Type": 0, "Data": {"nresul": '), F.col("total"), F.lit(', "medicos": '), F.col("records"), F.lit("}}"))
    snapshots = pages.unionByName(ends).join(known.select("k", "total"), "k").select(F.concat(F.lit("s"), "k").alias("source"), "page", F.when(F.col("k") == 0, 0).otherwise(F.col("total")).cast("long").alias("total"), "n", body.alias("body"))
    snapshots.repartitionByRange(8, "source", "page").sortWithinPartitions("source", "page").write.parquet(f"{place}/pages")
    count = spark.read.parquet(f"{place}/pages").count()

    def shape(stream: DataFrame) -> DataFrame:
        opened = files.open_envelope(stream, "body", "struct<medicos:array<struct<sale_id:long,client_id:long,total:double>>>")
        return opened.select(F.explode("data.medicos").alias("r")).select("r.*")

    cursor.run_all(spark, f"{place}/pages", f"{place}/out", f"{place}/checkpoint", ["s0", "s1", "s2"], shape, budget=max(1, -(-count // 3)), page_size=size)
    return spark.read.parquet(f"{place}/out").drop("batch")


@_query("""SELECT client_id, kind, bool_or(click_id % 4 = 0) AS old FROM clicks WHERE client_id IS NOT NULL GROUP BY 1, 2""")
def appended_keys(spark, sf) -> DataFrame:
    """The target holds the clients' kinds of a quarter of the clicks; two runs over all clicks add what it lacks, the second
    nothing."""
    ship(spark)
    place = run_folder(spark, "appended")
    table(spark, sf, "clicks").where("client_id is not null and click_id % 4 = 0").groupBy("client_id", "kind").agg(F.min("click_id").alias("click_id")).withColumn("old", F.lit(True)).write.parquet(f"{place}/target")
    for _ in range(2):
        stream = table_stream(spark, sf, "clicks").where("client_id is not null").select("client_id", "kind", "click_id").withColumn("old", F.lit(False))
        incremental.append_new(stream, ["client_id", "kind"], "click_id", f"{place}/target", f"{place}/checkpoint")
    return incremental.read_appended(spark, f"{place}/target").select("client_id", "kind", "old")


@_query("SELECT date_trunc('day', ts) AS since, kind, count(*) AS n FROM clicks WHERE ts IS NOT NULL GROUP BY 1, 2")
def streamed_counts(spark, sf) -> DataFrame:
    """Counts by day and kind, kept up to date by a stream."""
    place = run_folder(spark, "counts")
    stream = table_stream(spark, sf, "clicks").where("ts is not null").withColumn("ts", F.col("ts").cast("timestamp"))
    counts = incremental.windowed_counts(stream, "ts", "1 day", ["kind"])

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{place}/counts")

    counts.writeStream.foreachBatch(put).outputMode("complete").option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{place}/counts").select(F.col("window.start").cast("timestamp_ntz").alias("since"), "kind", "n")
