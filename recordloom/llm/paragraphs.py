"""Near-duplicate paragraphs by MinHash banding, exact Jaccard and connected components.

Two kinds of paragraphs are compared, each with its own kind.  Lines are as the text gives them.  Passages are cut by
content: a word starts one if the hash of it and the next word is the least of those near it, and the passage runs to the
first such word that is some words on.  So a passage that repeats inside longer lines, or across line breaks, gives the
same cuts wherever it stands, and the paragraphs between them are the same.  Passages overlap.

A paragraph's set of word shingles is signed by MinHash; the signature is cut into bands, and paragraphs that agree in a
band become candidates.  The bands of a passage also hold its first shingle, as neighbours that overlap would be candidates
without end otherwise.  The bands are tuned for recall: at the threshold 3 lines and 6
passages in 1000 are missed, fewer above.

Candidates of a band value are linked as a star.  Links are made within parts of each input partition first and only one
paragraph of a value goes on to the shuffle, so a value that very many paragraphs share lands in no single task.  The texts
are then cut again, and only paragraphs that are candidates or repeat are kept.  Each link is verified by the exact Jaccard
similarity of the shingle sets, as sets of 31-bit hashes, and the verified links give components.

A star may miss links between paragraphs that are both unlike its centre.  So wherever a link between two components
failed, the components' paragraphs are looked at again: band values that hold two or more components are compared in
full, in parts of bounded size, and components that a pair joins become one class.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import ship
from .components import connected_components, forest
from .scratch import Scratch, partitions

#: Bands, and rows in each, of lines and of passages: 1 - (1 - 0.8**3)**8 = 0.997 and 1 - (1 - 0.8**2)**5 = 0.994 at 0.8.
BANDS = ((8, 3), (5, 2))
#: A passage starts at a word whose hash is the least of NEAR words on either side, and has LEAST words or more; a stretch
#: of LONG words without such a word is cut.
NEAR, LEAST, LONG = 6, 16, 64
#: Paragraphs of a band value that are compared in one piece; of more, each two parts of about this size are.
PART = 400
#: Bytes of text cut at a time, in whole texts; bytes of text whose band values make a cell.
SLICE, CELL_BYTES = 2_500_000, 24_000_000
#: Band values that a task gathers before it deals them to cells.
HELD = 500_000
_FACTORS = np.random.default_rng(2).integers(1, 2**32, (64, 2), dtype=np.uint64)
_GOLD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: The bit of a band value that tells the first band; a band value and a paragraph's number, as shuffled.
_FIRST = np.uint64(1 << 40)
_RECORD = np.dtype([("low", "<u4"), ("high", "<u2"), ("node", "<i8")])


_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_SMALL = np.arange(256, dtype=np.uint8) + 32 * ((np.arange(256) >= 65) & (np.arange(256) <= 90)).astype(np.uint8)
_LETTERS = np.random.default_rng(3).integers(0, 2**64, 64 * 256, dtype=np.uint64)


def hashed_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first bytes) of the words between white space, lower-cased in A-Z: sums of a random number for each letter and
    its place."""
    if not len(raw):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    space = _SPACE[raw]
    first = np.flatnonzero(~space & np.r_[True, space[:-1]])
    size = np.flatnonzero(~space & np.r_[space[1:], True]) + 1 - first
    out, letters, end = np.empty(len(first), np.uint64), _SMALL[raw[~space]], np.cumsum(size)
    s = 0
    while s < len(first):  # a few million letters at a time
        e = max(s + 1, int(np.searchsorted(end, (end[s - 1] if s else 0) + (1 << 22))))
        base = int(end[s] - size[s])
        at = (end[s:e] - size[s:e] - base).astype(np.int64)
        place = np.arange(int(end[e - 1]) - base, dtype=np.int32) - np.repeat(at.astype(np.int32), size[s:e])
        value = _LETTERS[(place & 63) << 8 | letters[base : int(end[e - 1])]]
        if size[s:e].max() > 64:
            value *= (place >> 6).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        out[s:e] = np.add.reduceat(value, at)
        s = e
    return out, first


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of each k words in a row; of all words, if fewer."""
    n = max(1, len(words) - k + 1)
    h = np.zeros(n, np.uint64)
    for j in range(min(k, len(words))):
        h = (h ^ words[j : j + n]) * _GOLD
        h ^= h >> np.uint64(29)
    return h


def signatures(sets: np.ndarray, starts: np.ndarray, kind: int, ends: np.ndarray | None = None) -> np.ndarray:
    """One hash per band for each set of 32-bit hashes, sets[starts[i]:ends[i]]; without ``ends`` a set ends where the next one
    starts.  Sets may overlap; none is empty.  Of passages, kind 1, the first hash counts in all bands."""
    bands, rows = BANDS[kind]
    head = sets[starts] * _MIX if kind else np.zeros(len(starts), np.uint64)
    if ends is not None:
        sets = np.append(sets, np.uint64(0))  # so that an end may be the end of all
        starts = np.stack([starts, ends], 1).ravel()
    step = 1 if ends is None else 2
    out = np.empty((len(starts) // step, bands), np.uint64)
    for b in range(bands):
        h = head ^ np.uint64(b)
        for a, c in _FACTORS[b * rows : (b + 1) * rows]:
            low = np.minimum.reduceat((sets * (a | np.uint64(1)) + c) & np.uint64(0xFFFFFFFF), starts)[::step]
            h = (h ^ low) * _MIX
            h ^= h >> np.uint64(32)
        out[:, b] = h
    return out


def cuts(words: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the passages of texts that stand one after the other, words[first[i]:last[i]], none empty."""
    after = np.append(words[1:], np.uint64(0))
    after[last - 1] = 0
    key = (words ^ (after * _GOLD)) * _MIX
    key ^= key >> np.uint64(31)
    shift = np.repeat(np.arange(1, len(first) + 1) * NEAR, last - first)  # texts are set apart
    wide = np.full(len(words) + (len(first) + 2) * NEAR, np.uint64(2**64 - 1))
    at = np.arange(len(words)) + shift
    wide[at] = key
    least = np.ones(len(words), bool)
    for d in range(1, NEAR + 1):
        least &= (key < wide[at - d]) & (key <= wide[at + d])
    edge = np.unique(np.concatenate([np.flatnonzero(least), first, last]))
    pieces = np.maximum(1, -(-np.diff(edge, append=edge[-1:]) // LONG))
    edge = np.repeat(edge, pieces) + (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * LONG
    own = np.searchsorted(first, edge, "right") - 1
    start, stop = edge, last[own]
    end = np.minimum(edge[np.minimum(np.searchsorted(edge, edge + LEAST), len(edge) - 1)], stop)
    keep = (end - start >= LEAST) | ((start == first[own]) & (end > start))
    return start[keep], end[keep]


class Cutter:
    """Paragraphs of texts: of each its text's number, kind, first word, and words; its number, and its set of hashes."""

    def __init__(self, shingle: int, min_words: int):
        self.shingle, self.min_words = shingle, max(shingle, min_words)

    def __call__(self, texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, kind, start, n_words, node, from, to, sets) in slices of whole texts, each kind by itself; a paragraph's set is
        sets[from:to], of 31-bit hashes beside the kind."""
        held: list[bytes] = []
        since = size = 0
        for i, text in enumerate(texts):
            held.append(text or b"")
            size += len(held[-1])
            if size >= SLICE or i == len(texts) - 1:
                yield from self._slice(held, since)
                held, since, size = [], i + 1, 0

    def _slice(self, held: list[bytes], since: int) -> Iterator[tuple[np.ndarray, ...]]:
        raw = np.frombuffer(b"\n".join(held), np.uint8)
        words, at = hashed_words(raw)
        if len(words) < self.min_words:
            return
        bounds = np.cumsum([0, *(len(x) + 1 for x in held)])
        upto = np.searchsorted(at, bounds)  # words before each text
        full = np.flatnonzero(np.diff(upto))
        first, last = upto[:-1][full], upto[1:][full]
        line = np.searchsorted(np.flatnonzero(raw == 10), at)
        begin = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
        size = np.diff(np.append(begin, len(words)))
        line = begin[size >= self.min_words]
        size = size[size >= self.min_words]
        start, stop = cuts(words, first, last)
        some = stop - start >= self.min_words
        h = shingles(words, self.shingle)
        wide = h * _MIX
        wide = np.append((wide ^ (wide >> np.uint64(32))) * _GOLD, np.uint64(0))
        for kind, start, stop in ((0, line, line + size), (1, start[some], stop[some])):
            if not len(start):
                continue
            own, to = np.searchsorted(first, start, "right") - 1, stop - self.shingle + 1
            total = np.add.reduceat(wide, np.stack([start, to], 1).ravel())[::2]
            node = (total ^ ((stop - start) * 2 + kind).astype(np.uint64)) * _MIX
            node ^= node >> np.uint64(32)
            sets = (h & np.uint64(0xFFFFFFFE)) | np.uint64(kind)  # lines and passages share none
            yield since + full[own], kind, start - first[own], stop - start, node.view(np.int64), start, to, sets


def _star(value: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions of the smallest node of each value, u, v): the others linked to it, and nodes that a value holds twice to
    themselves."""
    order = np.lexsort((node, value))
    v, n = value[order], node[order]
    first = np.r_[True, v[1:] != v[:-1]] if len(v) else np.empty(0, bool)
    hub = n[np.flatnonzero(first)][np.cumsum(first) - 1] if len(v) else n
    again = ~first & (n == np.r_[n[:1], n[:-1]])
    other = (n != hub) & ~again
    return order[first], np.append(n[other], n[again]), np.append(hub[other], n[again])


def routed(docs: DataFrame, text_col: str, shingle: int, min_words: int, cells: int) -> DataFrame:
    """(cell, link, rows) of the paragraphs' band values, and of links found on the way.

    Values are gathered over batches and kinds before they are dealt to cells, so there are as many rows as cells for every
    HELD values of a partition, however small the batches are."""
    names, kinds = ["cell", "link", "rows"], (pa.int64(), pa.bool_(), pa.binary())

    def deal(values: list[np.ndarray], nodes: list[np.ndarray]) -> pa.RecordBatch:
        value, owner = np.concatenate(values), np.concatenate(nodes)
        first, u, v = _star(value, owner)
        value, owner = value[first], owner[first]
        cell = ((value >> np.uint64(24)).astype(np.float64) * (cells / 2.0**40)).astype(np.int64)  # values are in order
        rows = np.empty(len(value), _RECORD)
        rows["low"], rows["high"], rows["node"] = value & np.uint64(0xFFFFFFFF), (value >> np.uint64(32)) & np.uint64(0xFFFF), owner
        edge = np.append(np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]), len(cell))
        out = [(int(cell[s]), False, rows[s:e].tobytes()) for s, e in zip(edge[:-1].tolist(), edge[1:].tolist())]
        found = _pairs(u, v)
        out += [(int(found[k, 0]) % cells, True, found[k : k + 20_000].tobytes()) for k in range(0, len(found), 20_000)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, values, nodes, held = Cutter(shingle, min_words), [], [], 0
        for b in batches:
            for _, kind, _, _, node, start, to, sets in cut(b.column(0).to_pylist()):
                value = signatures(sets, start, kind, to) & ~_FIRST
                value[:, 0] |= _FIRST
                values.append(value.ravel())
                nodes.append(np.repeat(node, value.shape[1]))
                held += value.size
                if held >= HELD:
                    yield deal(values, nodes)
                    values, nodes, held = [], [], 0
        if held:
            yield deal(values, nodes)

    return docs.select(F.col(text_col).cast("binary")).mapInArrow(route, "cell long, link boolean, rows binary")


def _pairs(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.unique(np.stack([u, v], 1), axis=0)


def candidate_links(docs: DataFrame, text_col: str, shingle: int, min_words: int) -> DataFrame:
    """(u, v) stars over paragraphs that share a band value, by their numbers; u = v for a paragraph that repeats.

    A paragraph's number is a 64-bit hash of its kind, length and shingles.  Each cell of band values is met by itself, and
    there are as many cells as tasks, or as the texts ask for."""
    spark = docs.sparkSession
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    tasks = 4 * partitions(spark)
    cells = max(tasks, -(-total // CELL_BYTES))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        for (_, link), group in groupby(rows, key=lambda row: row[:2]):  # one cell at a time is held
            if link:
                for *_, x in group:
                    found = np.frombuffer(x, "<i8").reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["u", "v"])
                continue
            held = np.frombuffer(b"".join(x for *_, x in group), _RECORD)
            value = held["low"].astype(np.uint64) | held["high"].astype(np.uint64) << np.uint64(32)
            _, u, v = _star(value, held["node"])
            twice = held["node"][value & _FIRST > 0]  # that a paragraph repeats need not be said for every band
            found = _pairs(u, v)
            found = found[(found[:, 0] != found[:, 1]) | np.isin(found[:, 0], twice)]
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["u", "v"])

    ship(spark)
    dealt = routed(docs, text_col, shingle, min_words, cells)
    return dealt.repartition(tasks, "cell").sortWithinPartitions("cell", "link").mapInArrow(meet, "u long, v long").distinct()


def marked(nodes: DataFrame) -> np.ndarray:
    """A bit for each value of the first 24 bits of the nodes: 2 MB, however many nodes there are."""
    at = nodes.selectExpr("shiftrightunsigned(node, 46) AS k", "shiftleft(1L, CAST(shiftrightunsigned(node, 40) & 63 AS INT)) AS bit")
    rows = at.groupBy("k").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2**18 rows of 16 bytes
    out = np.zeros(1 << 18, np.int64)
    out[rows["k"].to_numpy()] = rows["bits"].to_numpy()
    return out


def members(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, shingle: int, min_words: int) -> DataFrame:
    """(node, id, tid, kind, start, n_words, payload) of the paragraphs whose numbers are in ``nodes``; payload is the set.

    The nodes' marks keep most other paragraphs from being shuffled; where there are too many nodes for that, the join
    still keeps them out of the result."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(marked(nodes))
    names = ["node", "id", "tid", "kind", "start", "n_words", "payload"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, marks = Cutter(shingle, min_words), shared.value
        for b in batches:
            for text, kind, start, size, node, lo, hi, sets in cut(b.column(2).to_pylist()):
                word = node.view(np.uint64)
                at = np.flatnonzero((marks[(word >> np.uint64(46)).astype(np.int64)] >> ((word >> np.uint64(40)) & np.uint64(63)).astype(np.int64)) & 1)
                narrow = sets.astype("<u4")
                for k in range(0, len(at), 4000):
                    some = at[k : k + 4000]
                    payload = [narrow[s:e].tobytes() for s, e in zip(lo[some].tolist(), hi[some].tolist())]
                    own = pa.array(text[some])
                    yield pa.RecordBatch.from_arrays([pa.array(node[some]), b.column(0).take(own), b.column(1).take(own), pa.array(np.full(len(some), kind), pa.int32()), pa.array(start[some], pa.int32()), pa.array(size[some], pa.int32()), pa.array(payload, pa.binary())], names)

    ship(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("tid"), F.col(text_col).cast("binary").alias("text"))
    cut = text.mapInArrow(split, f"node long, id {kind}, tid long, kind int, start int, n_words int, payload binary")
    return cut.join(nodes.hint("merge"), "node", "left_semi")


def jaccard_of(a: bytes, b: bytes) -> float:
    x, y = (np.unique(np.frombuffer(p, "<u4")) for p in (a, b))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(1, len(x) + len(y) - both)


def shared(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of ``a`` with each of ``b``."""
    both = np.intersect1d(np.concatenate(a), np.concatenate(b))
    out = np.zeros((len(a), len(b)), np.float32)

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        values = np.concatenate(sets)
        row, column = np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.searchsorted(both, values)
        ok = both[np.minimum(column, len(both) - 1)] == values
        return row[ok], column[ok]

    if len(both):
        (row_a, at_a), (row_b, at_b) = places(a), places(b)
        for k in range(0, len(both), 4096):
            x, y = (np.zeros((len(s), min(4096, len(both) - k)), np.float32) for s in (a, b))
            for m, row, at in ((x, row_a, at_a), (y, row_b, at_b)):
                here = (at >= k) & (at < k + 4096)
                m[row[here], at[here] - k] = 1
            out += x @ y.T
    return out


def joined(sets: list[bytes], root: np.ndarray, similarity: float, step: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between roots: pairs of sets of different roots that are similar enough."""
    x = [np.unique(np.frombuffer(p, "<u4")) for p in sets]
    size = np.array([len(s) for s in x])
    names, r = np.unique(root, return_inverse=True)
    now = np.arange(len(names))
    for i in range(0, len(x), step):
        for j in range(i, len(x), step):
            p, q = slice(i, i + step), slice(j, j + step)
            apart = now[r[p]][:, None] != now[r[q]][None, :]
            if not apart.any():
                continue
            both = shared(x[p], x[q]).astype(np.int64)
            u, v = np.nonzero(apart & (both / np.maximum(1, size[p][:, None] + size[q][None, :] - both) >= similarity))
            if len(u):
                at = np.flatnonzero(now != np.arange(len(now)))
                now = forest(len(names), np.append(at, r[p][u]), np.append(now[at], r[q][v]))
    at = np.flatnonzero(now != np.arange(len(now)))
    return names[at], names[now[at]]


def missed_links(links: DataFrame, roots: DataFrame, sets: DataFrame, scratch: Scratch, similarity: float) -> DataFrame:
    """(u, v) links between roots that the stars missed.

    ``links`` has u, v and ok, ``roots`` node and root, ``sets`` node and payload.  Two similar paragraphs of one band
    value are joined by a path of star links; if their roots differ, some link on it failed between either root and
    another, so only roots with such links are looked at."""
    spark = sets.sparkSession
    cells = 4 * partitions(spark)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            payload = b.column(2).to_pylist()
            kinds = np.array([x[0] & 1 for x in payload])
            for kind in (0, 1):
                own = np.flatnonzero(kinds == kind)
                for k in range(0, len(own), 2000):
                    at = own[k : k + 2000]
                    some = [payload[i] for i in at.tolist()]
                    starts = np.cumsum([0, *(len(x) // 4 for x in some)])[:-1]
                    value = signatures(np.frombuffer(b"".join(some), "<u4").astype(np.uint64), starts, kind)
                    node, root = (np.repeat(c.to_numpy()[at], value.shape[1]) for c in b.columns[:2])
                    yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64).ravel()), pa.array(node), pa.array(root)], ["value", "node", "root"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = [], (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        for _, group in groupby(rows, key=lambda row: row[:3]):  # one group at a time is held
            *_, root, payload = zip(*group)
            found += zip(*(x.tolist() for x in joined(list(payload), np.array(root), similarity)))
            if len(found) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["u", "v"])
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["u", "v"])

    failed = links.where("not ok").select("u", "v")
    for end in ("u", "v"):
        failed = failed.join(roots.withColumnsRenamed({"node": end, "root": f"root_{end}"}), end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    doubtful = scratch.save(failed.where("root_u <> root_v").select(F.explode(F.array("root_u", "root_v")).alias("root")).distinct(), "doubtful")
    rooted = sets.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    again = scratch.save(rooted.join(doubtful, "root", "left_semi").select("node", "root", "payload"), "again")
    values = scratch.save(again.mapInArrow(entries, "value long, node long, root long"), "values")
    mixed = values.groupBy("value").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo < hi")
    members = values.join(scratch.save(mixed.select("value", F.ceil(F.col("n") / PART).cast("int").alias("parts")), "mixed"), "value")
    mine = F.pmod(F.xxhash64("node"), "parts").cast("int")
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: (k != F.col("mine")) | (F.col("parts") == 1)))
    dealt = members.withColumn("mine", mine).withColumn("other", other).select("value", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "node")
    filled = scratch.save(dealt, "dealt").join(again.hint("merge"), "node").select("value", "i", "j", "root", "payload")
    filled = filled.repartition(cells, "value", "i", "j").sortWithinPartitions("value", "i", "j")
    found = scratch.save(filled.mapInArrow(compare, "u long, v long").distinct(), "missed")
    scratch.drop("doubtful", "again", "values", "mixed", "dealt")
    return found


def settled_roots(links: DataFrame, sets: DataFrame, scratch: Scratch, similarity: float) -> DataFrame:
    """(node, root) of what candidate ``links`` (u, v) connect, once verified by the sets' exact Jaccard similarity, and
    what they missed."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [jaccard_of(x, y) >= similarity for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ok, pa.bool_())], ["u", "v", "ok"])

    left = scratch.save(links.join(sets.withColumnsRenamed({"node": "u", "payload": "a"}).hint("merge"), "u"), "left")
    pairs = left.join(sets.withColumnsRenamed({"node": "v", "payload": "b"}).hint("merge"), "v").select("u", "v", "a", "b")
    judged = scratch.save(pairs.mapInArrow(verify, "u long, v long, ok boolean"), "judged")
    del left, pairs
    scratch.drop("left")
    first = scratch.save(connected_components(judged.where("ok"), scratch), "first")
    whole = scratch.save(connected_components(missed_links(judged, first, sets, scratch, similarity), scratch), "whole")
    scratch.drop("missed", "judged")
    moved = first.join(whole.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    alone = whole.join(first, "node", "left_anti")  # roots that no verified link touched
    settled = scratch.save(moved.unionByName(alone), "settled")
    scratch.drop("first", "whole")
    return settled


def near_duplicate_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, min_words: int = 5) -> DataFrame:
    """(id, tid, kind, start, n_words, class_id, keeper, kept) of every paragraph that has a near duplicate.

    Paragraphs are lines (kind 0) and passages (kind 1) of at least ``min_words`` words, and of ``shingle`` words at least;
    start counts the text's words before it.  Two of a kind are linked if their sets of ``shingle`` words in a row,
    lower-cased in A-Z, have a Jaccard similarity of at least ``similarity``, and passages if they also start with the same
    ``shingle`` words; class_id stands for a component of links
    with two or more paragraphs, keeper is its first one as (id, tid, start), and kept marks it.  tid is a hash of the
    exact text.  Of rows that repeat both id and text all count, and of those with the keeper all are marked kept.
    Null and empty texts have no paragraphs; null ids come last; an empty table gives no rows; other columns are not read.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "paragraphs")
    links = scratch.save(candidate_links(docs, text_col, shingle, min_words), "candidates")
    scratch.drop()
    nodes = scratch.save(links.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "nodes")
    held = scratch.save(members(docs, nodes, id_col, text_col, shingle, min_words), "members")
    scratch.drop("nodes")
    links = links.where("u <> v")
    linked = links.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    sets = held.select("node", "payload").join(linked.hint("merge"), "node", "left_semi").groupBy("node").agg(F.first("payload").alias("payload"))
    roots = settled_roots(links, scratch.save(sets, "sets"), scratch, similarity)
    scratch.drop("candidates", "sets")
    at = F.struct(F.col("id").isNull().alias("no_id"), "id", "tid", "start")
    first = held.groupBy("node").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("times"))
    rooted = scratch.save(first.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    classes = scratch.save(rooted.groupBy("root").agg(F.min("first").alias("keeper"), F.sum("times").alias("size")).where("size > 1"), "classes")
    classed = scratch.save(rooted.select("root", "node").join(classes, "root").select("node", F.col("root").alias("class_id"), "keeper"), "classed")
    scratch.drop("rooted", "settled", "classes")
    found = held.select("node", "id", "tid", "kind", "start", "n_words").join(classed, "node").select("id", "tid", "kind", "start", "n_words", "class_id", "keeper")
    return found.withColumn("kept", at.eqNullSafe(F.col("keeper")))


_WORD = re.compile(r"[^ \t-\r]+")


def without(text: str, gone: list[tuple[int, int]]) -> str:
    """``text`` without the words gone, as (first word, words); where a stretch goes, of the white space on its sides only that
    with a line break stays, or else that before it."""
    spans = [m.span() for m in _WORD.finditer(text)]
    out = np.zeros(len(spans) + 1, np.int64)
    for start, n in gone:
        out[start] += 1
        out[start + n] -= 1
    lost = np.flatnonzero(np.diff(np.r_[0, (np.cumsum(out) > 0).astype(np.int8)]))  # where stretches start and end
    parts, at = [], 0
    for s, e in zip(lost[::2].tolist(), lost[1::2].tolist()):
        before, after = spans[s - 1][1] if s else 0, spans[e][0] if e < len(spans) else len(text)
        left, right = text[before : spans[s][0]], text[spans[e - 1][1] : after]
        parts.append(text[at:before])
        if s and e < len(spans):
            parts.append(right if "\n" in right and "\n" not in left else left)
        at = after
    return "".join(parts) + text[at:]


def drop_repeated_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars", **how) -> DataFrame:
    """``docs`` with the words of repeated paragraphs taken out but for each class's first one; documents left without words
    are dropped.

    ``chars_col``, if the table has it, is brought up to date.  All other columns, and texts that lose nothing, stay as
    they are, null and empty ones too; rows that repeat id and text are changed alike; an empty table stays empty.  Parameters
    are those of near_duplicate_paragraphs.
    """
    gone = near_duplicate_paragraphs(docs, id_col, text_col, **how).where("not kept").groupBy("id", "tid").agg(F.collect_set(F.struct("start", "n_words")).alias("_rl_gone"))
    gone = gone.withColumnsRenamed({"id": "_rl_id", "tid": "_rl_tid"})

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None else without(t, [(x["start"], x["n_words"]) for x in s]) for t, s in zip(texts, spans)], dtype=object)

    def cut_out(text: Column) -> Column:
        return cut(text, F.col("_rl_gone"))

    keyed = docs.withColumn("_rl_text", F.coalesce(F.xxhash64(text_col), F.lit(0)))
    joined = keyed.join(gone, keyed[id_col].eqNullSafe(gone["_rl_id"]) & (keyed["_rl_text"] == gone["_rl_tid"]), "left")
    left = joined.withColumn(text_col, cut_out(F.col(text_col)))
    left = left.where(F.col("_rl_gone").isNull() | F.col(text_col).rlike(r"[^ \t-\r]"))
    if chars_col and chars_col in docs.columns:
        left = left.withColumn(chars_col, F.when(F.col("_rl_gone").isNull(), F.col(chars_col)).otherwise(F.length(text_col)).cast(docs.schema[chars_col].dataType))
    return left.select(*docs.columns)
