"""A streaming source over page snapshots: a cursor for each source, and a budget of pages a run.

Snapshots are rows (source, page, total, n, body): what a site answered for a page, how many records it said it has in
all, and how many the page holds.  An offset is {source: {next, total, complete}}.  A run takes the sources in order and
admits pages from each cursor on until the budget is spent; a page without records, or one past the announced total,
completes its source, and a page that is not there yet ends its turn.  Planning reads only counts, of no more pages than
the budget; bodies are read by the tasks.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..sources.workbook import store_of

SCHEMA = "source string, page long, body string"


@dataclass
class Range(InputPartition):
    source: str
    first: int
    last: int


class Reader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.position, self.budget = options["path"], options["position"], int(options.get("budget", 100))
        self.size, self.task = int(options.get("pagesize", 8)), int(options.get("pagespertask", 20))
        self.sources = options["sources"].split(",")

    def _table(self, columns: list[str], source: str, first: int, last: int) -> ds.Scanner:
        store, path = store_of(self.path)
        within = (pc.field("source") == source) & (pc.field("page") >= first) & (pc.field("page") <= last)
        return ds.dataset(path, filesystem=store, format="parquet").scanner(columns=columns, filter=within)

    def initialOffset(self) -> dict:
        return {s: {"next": 1, "total": 0, "complete": False} for s in self.sources}

    def planned(self) -> dict:
        """The end of the last run that was planned.  If that run failed, Spark takes it up again from its own log, first."""
        store, path = store_of(f"{self.position}/planned.json")
        if store.get_file_info(path).type == fs.FileType.NotFound:
            return self.initialOffset()
        with store.open_input_file(path) as f:
            return {**self.initialOffset(), **json.loads(f.read())}

    def latestOffset(self) -> dict:
        out, left = self.planned(), self.budget
        for source in self.sources:
            at = dict(out[source])
            if at["complete"] or not left:
                continue
            found = {r["page"]: r for r in self._table(["page", "total", "n"], source, at["next"], at["next"] + left).to_table().to_pylist()}
            while left or at["next"] in found and not found[at["next"]]["n"]:
                here = found.get(at["next"])
                if here is None:
                    break
                if not here["n"]:
                    at["complete"] = True
                    break
                at["total"] = at["total"] or -(-(here["total"] or 0) // self.size)
                at["next"], left = at["next"] + 1, left - 1
                if at["total"] and at["next"] > at["total"]:
                    at["complete"] = True
                    break
            out[source] = at
        return out

    def partitions(self, start: dict, end: dict) -> list[Range]:
        store, path = store_of(self.position)
        store.create_dir(path, recursive=True)
        fresh = posixpath.join(path, f".{uuid.uuid4().hex}")
        with store.open_output_stream(fresh) as f:
            f.write(json.dumps(end).encode())
        store.move(fresh, posixpath.join(path, "planned.json"))
        return [Range(s, k, min(k + self.task, end[s]["next"]) - 1) for s in end for k in range(start.get(s, {}).get("next", 1), end[s]["next"], self.task)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("source", pa.string()), ("page", pa.int64()), ("body", pa.string())])
        for batch in self._table(schema.names, partition.source, partition.first, partition.last).to_batches():
            yield batch.cast(schema)


class Pages(DataSource):
    """Options: path of the snapshots, position (a folder beside the query's checkpoint, of that query only), sources in order,
    divided by commas, budget in pages, pageSize in records, pagesPerTask."""

    @classmethod
    def name(cls) -> str:
        return "page_cursor"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> Reader:
        return Reader({k.lower(): v for k, v in self.options.items()})


def page_stream(spark: SparkSession, path: str, checkpoint: str, sources: list[str], budget: int = 100, page_size: int = 8) -> DataFrame:
    """(source, page, body) of the next pages within the budget; with the same checkpoint each run goes on where the last ended."""
    spark.dataSource.register(Pages)
    options = {"path": path, "position": f"{checkpoint}/position", "sources": ",".join(sources), "budget": str(budget), "pageSize": str(page_size)}
    return spark.readStream.format("page_cursor").options(**options).load()


def position(checkpoint: str, sources: list[str]) -> dict:
    """Where the next run begins: {source: {next, total, complete}}."""
    return Reader({"path": "", "position": f"{checkpoint}/position", "sources": ",".join(sources)}).planned()


def run_once(stream: DataFrame, target: str, checkpoint: str) -> None:
    """One run, within the budget: its rows go to a folder of their own, batch=N of the target, which a run repeated after a
    failure writes anew."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_all(spark: SparkSession, path: str, target: str, checkpoint: str, sources: list[str], shape=lambda df: df, budget: int = 100, page_size: int = 8) -> int:
    """Runs until every source is complete, or a run takes no page further; returns their number."""
    runs = 0
    while True:
        before = position(checkpoint, sources)
        if all(s["complete"] for s in before.values()):
            return runs
        run_once(shape(page_stream(spark, path, checkpoint, sources, budget, page_size)), target, checkpoint)
        if position(checkpoint, sources) == before:
            return runs
        runs += 1
