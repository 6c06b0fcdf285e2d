"""Best-fit packing of documents into sequences under several capacities.

A piece takes length tokens, one document slot and length**2 of attention cost.  Pieces of one length are alike, so the
plan is made for the histogram of lengths, longest first: all bins with the same residual capacities stand as one group,
and a length goes to the group of bins that scores best under every constraint.  The plan's size depends on the
sequence length, not on the number of documents.  The pieces then take their places by their rank within their length;
ranks are counted in blocks, so a very frequent length is no single group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..runtime import ship
from .scratch import Scratch, partitions
from .tokens import encoder

PIECES = "id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32): documents, encoded and ended with ``end_id``; those over ``capacity`` are cut.

    A cut document's first piece takes what is left over, so that all others are full."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        end = np.array([end_id], enc.dtype).tobytes()
        for b in batches:
            out: list[tuple] = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.frombuffer(enc.encode(text) + end, enc.dtype)
                at, n, k = 0, len(ids), 0
                while at < n:
                    size = (n - at) % capacity or capacity
                    out.append((i, k, at, size, zlib.crc32(ids[at : at + size].astype("<u4").tobytes())))
                    at, k = at + size, k + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["id", "piece", "start", "length", "ids_crc32"])

    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECES)


class Plan:
    """Places for all pieces, by length and rank within the length: rows of (length, first rank, items per bin, first
    sequence, offset in the sequence), sorted."""

    def __init__(self, histogram: dict[int, int], capacity: int, max_documents: int, max_attention: int,
                 weights: tuple[float, float, float] = (1.0, 0.2, 0.2), rule: str = "norm"):
        full = np.array([capacity, max_documents, max_attention], float)
        room = np.zeros((1024, 3))  # residual tokens, documents, attention cost of a group of equal bins
        first, bins = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        used, self.sequences, steps = 0, 0, []
        w = np.asarray(weights) / full**2

        def group(sequence: int, n: int, left: np.ndarray) -> None:
            nonlocal room, first, bins, used
            if n <= 0:
                return
            if used == len(room):
                keep = np.flatnonzero((bins > 0) & (room.min(axis=1) >= 1))
                room[: len(keep)], first[: len(keep)], bins[: len(keep)], used = room[keep], first[keep], bins[keep], len(keep)
                if used > len(room) // 2:
                    room, first, bins = np.vstack([room, np.zeros_like(room)]), np.append(first, np.zeros_like(first)), np.append(bins, np.zeros_like(bins))
            room[used], first[used], bins[used] = left, sequence, n
            used += 1

        for length in sorted(histogram, reverse=True):
            need = np.array([length, 1, length * length], float)
            if (need > full).any():
                raise ValueError(f"a piece of {length} tokens fits no sequence")
            todo, rank = histogram[length], 0
            while todo:
                fits = np.flatnonzero((room[:used] >= need).all(axis=1) & (bins[:used] > 0))
                if len(fits):
                    left = room[fits] - need
                    score = (left * left * w).sum(axis=1) if rule == "norm" else -(room[fits] * need * w).sum(axis=1)
                    g = int(fits[np.lexsort((first[fits], score))[0]])
                    sequence, n, have = int(first[g]), int(bins[g]), room[g].copy()
                    bins[g] = 0
                else:
                    each = int((full // need).min())
                    sequence, n, have = self.sequences, -(-todo // each), full
                    self.sequences += n
                each = int((have // need).min())
                whole = min(n, todo // each)
                part = min(todo - whole * each, each - 1) if whole < n else 0
                offset = int(capacity - have[0])
                if whole:
                    steps.append((length, rank, each, sequence, offset))
                    group(sequence, whole, have - each * need)
                if part:
                    steps.append((length, rank + whole * each, part, sequence + whole, offset))
                    group(sequence + whole, 1, have - part * need)
                group(sequence + whole + (part > 0), n - whole - (part > 0), have)
                todo, rank = todo - whole * each - part, rank + whole * each + part
        self.steps = np.array(sorted(steps), np.int64).reshape(-1, 5)

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence_id, offset) of the pieces."""
        wide = np.int64(1) << 42
        at = np.searchsorted(self.steps[:, 0] * wide + self.steps[:, 1], length * wide + rank, side="right") - 1
        _, since, each, sequence, offset = self.steps[at].T
        k = rank - since
        return sequence + k // each, offset + k % each * length


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = 2048, max_documents: int | None = None,
         max_attention: int | None = None, id_col: str = "doc_id", text_col: str = "text", rule: str = "norm") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every document.

    A sequence holds at most ``capacity`` tokens, ``max_documents`` pieces (capacity, if not given) and
    ``max_attention`` of summed squared lengths (capacity squared, if not given).  ``rule`` is "norm", for the smallest
    weighted norm of what is left, or "dot", for the largest weighted dot product of need and room.  Offsets are
    gapless.  A null text counts as empty and still takes its end id; rows that repeat an id are packed each; a null id
    is kept; an empty table gives no rows.  Other columns are not read.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "packing")
    cut = pieces(docs, vocabulary, end_id, capacity, id_col, text_col)
    blocks = 2 * partitions(spark)
    table = scratch.save(cut.withColumn("block", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(blocks))), "pieces")
    counts = scratch.save(table.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    plan = Plan(histogram, capacity, max_documents or capacity, max_attention or capacity**2, rule=rule)
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = scratch.save(counts.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "base")
    within = Window.partitionBy("length", "block").orderBy("id", "piece", "ids_crc32")
    ranked = table.withColumn("rank", F.row_number().over(within) - 1).join(base.hint("merge"), ["length", "block"])
    shared = spark.sparkContext.broadcast(plan)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = shared.value
        for f in frames:
            sequence, offset = p.places(f["length"].to_numpy(np.int64), f["rank"].to_numpy(np.int64))
            yield f.assign(sequence_id=sequence, offset=offset)[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    ship(spark)
    rows = ranked.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("rank"))
    return rows.mapInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
