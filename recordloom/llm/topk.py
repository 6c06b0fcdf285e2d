"""Exact top-k by inner product with the threshold algorithm (Fagin, Lotem and Naor, 2001).

Every block of vectors keeps one list per dimension, sorted by the component.  A query reads all its lists in step, from
the top where its own component is positive and from the bottom where it is negative; each vector met for the first
time is scored in full.  What the lists show at the current depth bounds the score of every vector not met so far, and
the search stops once that bound is under the k-th best score.  Depths double, so few rounds are taken; once most vectors of
the lists have been met, the rest are scored too.

Queries and candidates are dealt to blocks of bounded size; a cell pairs one block of each, and a query's best of all
cells are merged.  A cell holds its queries and one set of lists at a time, however many candidates it has; what the lists
before have found counts in the bound's test.  Blocks grow with the tables up to a limit, so that rows are sent to fewer cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import ship
from .scratch import Scratch

#: Rows of a block; while there are more cells than tasks to keep busy, blocks are doubled up to LARGER times or CELL_BYTES.
QUERY_BLOCK, CANDIDATE_BLOCK, LARGER, CELL_BYTES = 512, 8192, 8, 16_000_000
#: Candidates in one set of lists, and their components at most.
LISTED, COMPONENTS = 8192, 4_000_000


def quantised(embedding: str, scale: float = 64.0) -> Column:
    """floor(scale * x) of each component, or null for a vector that is null or holds a null or non-finite component."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(F.col(embedding).isNotNull() & ~bad, F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


class Lists:
    """One block of candidates with its sorted lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.n, self.dims = ids, len(ids), vectors.shape[1]
        self.largest = int(np.abs(vectors).max(initial=0))
        self.vectors = vectors
        down = np.argsort(-vectors, axis=0, kind="stable").T
        self.order = np.ascontiguousarray(np.concatenate([down, down[:, ::-1]])).astype(np.int32)
        self.values = np.take_along_axis(np.concatenate([vectors.T, vectors.T]), self.order, axis=1)
        self.narrow = vectors.astype(np.float32)

    def search(self, query: np.ndarray, own: int, k: int, first_depth: int = 16, known: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores, vectors scored) of the k best but ``own``, ties to the smaller id; of these and the ``known`` best of
        other blocks, (ids, scores)."""
        exact32 = self.dims * max(1, self.largest) * max(1, int(np.abs(query).max(initial=0))) < 1 << 24
        table, q = (self.narrow, query.astype(np.float32)) if exact32 else (self.vectors, query)
        active = np.flatnonzero(query)
        lists = active + self.dims * (query[active] < 0)
        met = np.zeros(self.n, bool)
        best_ids, best = known or (np.empty(0, np.int64), np.empty(0, np.int64))
        depth, next_depth, scored = 0, first_depth, 0
        while depth < self.n:
            stop = min(next_depth, self.n)
            now = met.copy()
            if len(lists):
                now[self.order[lists, depth:stop]] = True
            else:
                now[:] = True
            if np.count_nonzero(now) * 2 > self.n:  # reading on would cost more than scoring the rest
                now[:] = True
            new = np.flatnonzero(now & ~met)
            met, depth, next_depth = now, stop, stop * 2
            if len(new):
                scored += len(new)
                s = ((table @ q)[new] if len(new) * 4 > self.n else table[new] @ q).astype(np.int64)
                if len(best) == k:  # ties may have smaller ids
                    new, s = new[s >= best[-1]], s[s >= best[-1]]
                other = self.ids[new] != own
                ids, s = np.concatenate([best_ids, self.ids[new][other]]), np.concatenate([best, s[other]])
                if len(s) > k:
                    cut = np.partition(s, len(s) - k)[len(s) - k]
                    ids, s = ids[s >= cut], s[s >= cut]
                top = np.lexsort((ids, -s))[:k]
                best_ids, best = ids[top], s[top]
            bound = int((query[active] * self.values[lists, depth - 1]).sum()) if len(lists) else 0
            if len(best) == k and best[-1] > bound:  # a vector not met could still tie at the bound
                break
            if met.all():
                break
        return best_ids, best, scored


def blocks(candidates: int, queries: int, width: int, tasks: int) -> tuple[int, int]:
    """Numbers of blocks of candidates and of queries, of ``width`` bytes each; ``tasks`` cells or more, if blocks can be as large."""
    c_size, q_size = CANDIDATE_BLOCK, QUERY_BLOCK
    count = lambda: (max(1, -(-candidates // c_size)), max(1, -(-queries // q_size)))
    c, q = count()
    while c * q > tasks:
        if c_size * q_size == CANDIDATE_BLOCK * QUERY_BLOCK * LARGER**2 or 2 * width * max(c_size, q_size) > CELL_BYTES:
            break
        if c_size * QUERY_BLOCK < q_size * CANDIDATE_BLOCK:
            c_size *= 2
        else:
            q_size *= 2
        c, q = count()
    return c, q


def listings(parts: Iterator[tuple[np.ndarray, np.ndarray]], listed: int) -> Iterator[Lists]:
    """Lists of ``listed`` candidates each, and of the rest, from parts (ids, vectors)."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        while n >= listed:
            ids, vectors = (np.concatenate(x) for x in zip(*held))
            yield Lists(ids[:listed], vectors[:listed])
            held, n = [(ids[listed:], vectors[listed:])], n - listed
    if n:
        yield Lists(*(np.concatenate(x) for x in zip(*held)))


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "vector") -> DataFrame:
    """(query_id, rank, id, score): the k largest inner products of each query with all vectors but its own.

    Both tables have an integer id and an array of integers.  Ties go to the smaller id; with fewer than k other
    vectors all are returned.  Null vectors and null ids take no part.  Shorter vectors count as ended by zeros.  Rows
    that repeat an id are one item for exclusion, and each is a candidate; repeated queries are answered once.  Empty
    tables give no rows.  Components times components must sum within 64 bits.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "topk")
    pick = lambda df: df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    vectors = scratch.save(pick(vectors), "vectors")
    queries = scratch.save(pick(queries).dropDuplicates(["id"]), "queries")
    shape, asked = (df.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.min(F.array_min("vector")), F.max(F.array_max("vector"))).first() for df in (vectors, queries))
    dims = max(shape[1] or 0, asked[1] or 0, 1)
    low, high = min(shape[2] or 0, asked[2] or 0), max(shape[3] or 0, asked[3] or 0)
    narrow = next(np.dtype(x) for x in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(x).min <= low and high <= np.iinfo(x).max)
    c_blocks, q_blocks = blocks(shape[0], asked[0], dims * narrow.itemsize, 8 * spark.sparkContext.defaultParallelism)
    listed = max(1, min(LISTED, COMPONENTS // dims))
    names = ["cell", "kind", "ids", "rows"]

    def deal(kind: int, own: int, other: int):
        """Rows by block, as bytes, to each cell of it; a cell's queries are of kind 0 and come before its candidates."""

        def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                ids, size, flat = b.column(0).to_numpy(), pc.list_value_length(b.column(1)).to_numpy(), b.column(1).flatten()
                if flat.null_count:
                    raise ValueError("a vector holds a null component")
                rows, row = np.zeros((len(ids), dims), narrow), np.repeat(np.arange(len(ids)), size)
                rows[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = flat.to_numpy()
                block = b.column(2).to_numpy()
                order = np.argsort(block, kind="stable")
                ids, rows, block = ids[order].astype("<i8"), rows[order], block[order]
                edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
                id_blobs, blobs = (pa.array([x[s:e].tobytes() for s, e in zip(edge[:-1], edge[1:])], pa.binary()) for x in (ids, rows))
                mine, kinds = block[edge[:-1]].astype(np.int64), pa.array(np.full(len(blobs), kind), pa.int32())
                for y in range(other):  # a cell's share at a time: all copies of a batch may not fit
                    cells = mine * q_blocks + y if kind else y * q_blocks + mine
                    yield pa.RecordBatch.from_arrays([pa.array(cells), kinds, id_blobs, blobs], names)

        return dealt

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lambda parts: (np.frombuffer(b"".join(p[0] for p in parts), "<i8"), np.frombuffer(b"".join(p[1] for p in parts), narrow).reshape(-1, dims).astype(np.int64))
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        for _, group in groupby(rows, key=lambda row: row[0]):
            by_kind = groupby(group, key=lambda row: row[1])
            kind, parts = next(by_kind)
            if kind:  # no query
                continue
            ids, asked = read([p[2:] for p in parts])
            best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(ids)
            for _, parts in by_kind:
                for lists in listings((read([p[2:]]) for p in parts), listed):
                    best = [lists.search(q, int(i), k, known=x)[:2] for i, q, x in zip(ids, asked, best)]
            out = [np.repeat(ids, [len(x[0]) for x in best]), *(np.concatenate(x) for x in zip(*best))]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["query_id", "id", "score"])

    ship(spark)
    numbered = lambda df, n: df.withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.lit(n)).cast("int"))
    cells = "cell long, kind int, ids binary, rows binary"
    both = numbered(vectors, c_blocks).mapInArrow(deal(1, c_blocks, q_blocks), cells).unionByName(numbered(queries, q_blocks).mapInArrow(deal(0, q_blocks, c_blocks), cells))
    tasks = c_blocks * q_blocks
    dealt = both.repartition(min(4 * tasks, max(tasks, 1000)), "cell").sortWithinPartitions("cell", "kind")
    found = dealt.mapInArrow(solve, "query_id long, id long, score long")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
