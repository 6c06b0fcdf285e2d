"""Token-ID shards: a concatenated id array and Elias-Fano document boundaries.

A shard is two files.  ``shard-NNNNN.ids`` holds the ids of its documents one after the other, little-endian, 16 bits
each if the vocabulary allows and 32 otherwise.  ``shard-NNNNN.ef`` holds two Elias-Fano codes: the documents' ends, in
ids, and their doc_ids less the smallest.  Shards follow each other in ascending doc_id order.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..runtime import ship
from .eliasfano import EliasFano, encode
from .scratch import partitions, shared_folder
from .tokens import encoder

_HEAD = "<4sBqQQQ"
_MAGIC = b"RLx1"
MANIFEST = "shard int, ids string, ef string, n_docs long, n_ids long"


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_shards(docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None, shards: int | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> list:
    """Encode every whole text, append ``end_id``, write the shards, and return the manifest: a row per shard.

    Documents are dealt to shards by range of (id, text hash) and sorted there, so one id with very many rows is split
    too; equal ids stay in any order of their texts.  A null text counts as empty, a null id is refused, an empty table
    gives no shards.  A shard is written under a name of its own and then renamed, so an attempt that is lost leaves
    nothing that counts, and a repeated one writes the same bytes.  The manifest is as long as there are shards.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    n = shards or partitions(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, out, ends, ids, total = encoder(vocabulary), TaskContext.get().partitionId(), None, [], [], 0
        end = np.array([end_id], enc.dtype).tobytes()
        store, base = _store(folder)
        name, own = f"{base}/shard-{shard:05d}", uuid.uuid4().hex
        for b in batches:
            if b.num_rows and out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{name}.ids-{own}")
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i is None:
                    raise ValueError("a document without an id cannot be addressed in a shard")
                data = enc.encode(text) + end
                out.write(data)
                total += len(data) // enc.dtype.itemsize
                ends.append(total)
                ids.append(i)
        if out is None:
            return
        out.close()
        codes = [encode(np.array(ends)), encode(np.array(ids) - ids[0])]
        with store.open_output_stream(f"{name}.ef-{own}") as f:
            f.write(struct.pack(_HEAD, _MAGIC, enc.dtype.itemsize, ids[0], len(ids), *map(len, codes)) + b"".join(codes))
        for kind in ("ids", "ef"):
            store.move(f"{name}.{kind}-{own}", f"{name}.{kind}")
        uri = f"{folder}/shard-{shard:05d}"
        yield pa.RecordBatch.from_pylist([{"shard": shard, "ids": f"{uri}.ids", "ef": f"{uri}.ef", "n_docs": len(ids), "n_ids": total}], pa.schema([("shard", pa.int32()), ("ids", pa.string()), ("ef", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = ["id", F.xxhash64("text")]
    made = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(write, MANIFEST).collect()
    return sorted(made, key=lambda m: m["shard"])


class Shard:
    """Random access to one shard's documents."""

    def __init__(self, ids_uri: str, ef_uri: str):
        store, path = _store(ef_uri)
        with store.open_input_stream(path) as f:
            data = f.read()
        magic, width, self.base, self.n, n_ends, n_ids = struct.unpack_from(_HEAD, data)
        if magic != _MAGIC:
            raise ValueError(f"{ef_uri} is not a shard index")
        self.dtype, head = np.dtype(f"<u{width}"), struct.calcsize(_HEAD)
        self.ends = EliasFano(data[head : head + n_ends])
        self.doc_ids = EliasFano(data[head + n_ends : head + n_ends + n_ids])
        store, path = _store(ids_uri)
        self.file = store.open_input_file(path)

    def __len__(self) -> int:
        return self.n

    def block(self, start: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(doc_ids, bounds, ids) of documents start..stop-1; document k's ids are ids[bounds[k]:bounds[k+1]]."""
        bounds = np.concatenate([[self.ends[start - 1] if start else 0], self.ends.range(start, stop)])
        raw = self.file.read_at(int(bounds[-1] - bounds[0]) * self.dtype.itemsize, int(bounds[0]) * self.dtype.itemsize)
        return self.doc_ids.range(start, stop) + self.base, bounds, np.frombuffer(raw, self.dtype)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.block(i, i + 1)[2]


def read_shards(spark, manifest: list, block: int = 256) -> DataFrame:
    """(doc_id, start, ids binary) of every document, from the files; start counts the ids of all documents before it.

    ids are little-endian unsigned 32-bit integers."""
    schema = "doc_id long, start long, ids binary"
    before, rows = 0, []
    for m in manifest:  # as many as there are shards
        rows.append((m["ids"], m["ef"], before))
        before += m["n_ids"]
    if not rows:
        return spark.createDataFrame([], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids_uri, ef_uri, first in zip(*(c.to_pylist() for c in b.columns)):
                shard = Shard(ids_uri, ef_uri)
                for s in range(0, len(shard), block):
                    doc_ids, bounds, ids = shard.block(s, min(s + block, len(shard)))
                    wide, cut = ids.astype("<u4").tobytes(), ((bounds - bounds[0]) * 4).tolist()
                    parts = [wide[x:y] for x, y in zip(cut, cut[1:])]
                    yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(bounds[:-1] + first, pa.int64()), pa.array(parts, pa.binary())], ["doc_id", "start", "ids"])

    ship(spark)
    listed = spark.createDataFrame(rows, "ids string, ef string, first long")
    return listed.repartition(len(rows)).mapInArrow(read, schema)


def ids_crc32(column: str = "ids"):
    """Unsigned crc32 of a binary column."""
    return F.crc32(column)


def crc32(raw: bytes) -> int:
    return zlib.crc32(raw)
