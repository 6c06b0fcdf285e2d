"""Exact removal of repeated byte strings by suffix sorting.

Every window of ``length`` bytes is keyed by the smallest hash of the short strings in it.  Equal windows have equal
keys, and neighbouring windows mostly share one, so a document becomes few runs of windows.  Keys whose short string occurs
once in the corpus hold no repeat and are left out.  Runs of equal bytes are collapsed and counted.  The distinct runs of each other
key are suffix-sorted together in two stages: only suffixes smaller than their successors are sorted directly, the others
are induced by one scan over the buckets of first bytes.  Windows that agree with a neighbour in the sorted order in all
their bytes are repeated.  A key with very many distinct runs, such as one in a passage that a third of all documents
hold, is split into parts that are sorted each; the distinct windows of its parts are then compared by fingerprints, in
cells that spread evenly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..runtime import ship
from .scratch import Scratch, partitions

#: Bytes that are keyed at a time; bytes beyond which no further key joins a suffix sort; bytes that one key may bring to
#: it in one part (together under 2**20); windows in a run.
SLICE, SORTED, HOT, RUN = 1 << 20, 400_000, 600_000, 1024
_SPANS = "array<struct<a:int,n:int>>"


def _rolling(data: np.ndarray, length: int, factor: int) -> np.ndarray:
    """A polynomial hash of the ``length`` bytes from each position on."""
    power, sizes = np.array([factor], np.uint64), []
    x = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    out, done, size = None, 0, 1
    while True:
        if length & size:
            if out is None:
                out = x
            else:  # the hash of the bytes before, then of these
                out = out[: len(x) - done] * power[0] + x[done:] if len(x) > done else np.empty(0, np.uint64)
            done += size
        if size * 2 > length:
            break
        x = x[:-size] * power[0] + x[size:] if len(x) > size else np.empty(0, np.uint64)
        power = power * power
        size *= 2
    n = len(data) - length + 1
    return out[:n] if n > 0 else np.empty(0, np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """Minima or maxima of each ``width`` values in a row."""
    size = 1
    while size * 2 <= width and len(x) > size:
        x = best(x[:-size], x[size:])
        size *= 2
    if (rest := width - size) and len(x) > rest:
        x = best(x[:-rest], x[rest:])
    return x


def window_keys(grams: np.ndarray, width: int) -> np.ndarray:
    """The smallest hash of the ``width`` grams in each window."""
    return _slide(grams, width, np.minimum)[: max(0, len(grams) - width + 1)]


def runs(data: bytes, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document, first window, windows, key, times, hash of the bytes) of the runs of the documents that ``bounds``
    delimit; times says how often the key's gram stands in the run, and windows of a run can be equal only if twice."""
    grams, width = _mixed(_rolling(np.frombuffer(data, np.uint8), gram, 0x100000001B3)), length - gram + 1
    keys = window_keys(grams, width)
    n = len(keys)
    if not n:
        return tuple(np.empty(0, np.int64) for _ in range(6))
    doc = np.searchsorted(bounds, np.arange(n), "right") - 1
    inside = np.arange(n) + length <= bounds[doc + 1]
    new = np.r_[True, (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])]
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, n))
    if (long := size > RUN).any():
        more = [np.arange(s + RUN, s + z, RUN) for s, z in zip(start[long], size[long])]
        start = np.sort(np.concatenate([start, *more]))
        size = np.diff(np.append(start, n))
    keep = inside[start]
    start, size = start[keep], size[keep]
    around = np.concatenate([np.zeros(width - 1, np.uint64), keys, np.zeros(width - 1, np.uint64)])
    chosen = np.flatnonzero(grams == _slide(around, width, np.maximum)[: len(grams)])  # the smallest of some window
    lo, hi = np.searchsorted(chosen, start), np.searchsorted(chosen, start + size + width - 1)
    owner = np.repeat(np.arange(len(start)), hi - lo)
    at = chosen[np.arange(len(owner)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)]
    times = np.bincount(owner, grams[at] == keys[start][owner], minlength=len(start)).astype(np.int64)
    view = memoryview(data)
    seg = np.fromiter((xxhash.xxh3_64_intdigest(view[s : s + z + length - 1]) for s, z in zip(start.tolist(), size.tolist())), np.uint64, len(start))
    return doc[start], start - bounds[doc[start]], size, keys[start], times, seg


def _ranks(x: np.ndarray) -> np.ndarray:
    order = np.argsort(x)
    y = x[order]
    out = np.empty(len(x), np.int64)
    out[order] = np.cumsum(np.r_[False, y[1:] != y[:-1]]) if len(x) else 0
    return out


def rank16(t: np.ndarray) -> np.ndarray:
    """Ranks of the 16 bytes from each position on, zeros after the end; under 2**20 bytes."""
    k = np.zeros(len(t) + 8, np.uint64)
    for j in range(8):
        k[: max(0, len(t) - j)] |= t[j:].astype(np.uint64) << np.uint64(56 - 8 * j)
    r8 = _ranks(k)
    return _ranks((r8[: len(t)] << 32) | r8[np.minimum(np.arange(len(t)) + 8, len(t))])


def two_stage(t: np.ndarray, depth: int, r16: np.ndarray | None = None) -> np.ndarray:
    """The suffixes of ``t`` in order of at least their first ``depth`` bytes."""
    n = len(t)
    if not n:
        return np.empty(0, np.int64)
    r16 = rank16(t) if r16 is None else r16
    ranks = np.concatenate([r16 + 1, np.zeros(depth + 64, np.int64)])  # after the end: smaller than any byte
    begin = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
    value = t[begin].astype(np.int64)
    smaller = np.repeat(value < np.append(value[1:], -1), np.diff(np.append(begin, n)))  # than its successor

    direct = np.flatnonzero(smaller)
    out = direct.copy()
    at, slot, offset = direct, np.zeros(len(direct), np.int64), 0
    while len(at) and offset < depth:
        key = (slot << 42) | (ranks[at + offset] << 21) | ranks[at + offset + 16]
        order = np.argsort(key, kind="stable")
        at, key, slot = at[order], key[order], slot[order]
        block = np.r_[True, slot[1:] != slot[:-1]]
        first = np.flatnonzero(block)
        place = slot + np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        out[place] = at
        new = np.r_[True, key[1:] != key[:-1]]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(at)))
        slot = np.repeat(place[first], size)
        tied = np.repeat(size > 1, size)
        at, slot, offset = at[tied], slot[tied], offset + 32

    cut = np.searchsorted(t[out], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[t[n - 1]].append(np.array([n - 1]))  # its successor is the end
    buckets = []

    def induce(found: np.ndarray, c: int) -> None:
        before = found[found > 0] - 1
        before = before[t[before] > c]
        order = np.argsort(t[before], kind="stable")
        before = before[order]
        edge = np.searchsorted(t[before], np.arange(c + 1, 257))
        for d in np.flatnonzero(np.diff(edge)).tolist():
            induced[c + 1 + d].append(before[edge[d] : edge[d + 1]])

    for c in range(256):
        if induced[c]:
            larger = [np.concatenate(induced[c])]
            while len(larger[-1]):  # runs of this byte
                before = larger[-1][larger[-1] > 0] - 1
                larger.append(before[t[before] == c])
            buckets.append(np.concatenate(larger))
            induce(buckets[-1], c)
            induced[c] = []
        if cut[c] < cut[c + 1]:
            buckets.append(out[cut[c] : cut[c + 1]])
            induce(buckets[-1], c)
    return np.concatenate(buckets)


def repeated(parts: list[bytes], counts: list[int], length: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """For each part, which of its windows occur at least twice, a part standing for ``counts`` occurrences; and of each
    distinct window the part and place of one occurrence, and whether it is repeated."""
    sizes = np.array([len(p) for p in parts])
    t = np.frombuffer(b"\xff".join(parts), np.uint8)  # no text holds this byte
    first = np.cumsum(sizes + 1) - (sizes + 1)
    owner = np.repeat(np.arange(len(parts)), sizes + 1)[: len(t)]
    window = np.arange(len(t)) + length <= (first + sizes)[owner]
    r16 = rank16(t)
    order = two_stage(t, length, r16)
    order = order[window[order]]
    common = np.arange(max(0, len(order) - 1))
    for offset in [*range(0, length - 15, 16), length - 16]:
        common = common[r16[order[common] + offset] == r16[order[common + 1] + offset]]
    new = np.ones(len(order), bool)
    new[common + 1] = False
    group = np.cumsum(new) - 1
    weight = np.bincount(group, np.asarray(counts, float)[owner[order]]) if len(order) else np.empty(0)
    hit = np.zeros(len(t), bool)
    hit[order[weight[group] >= 2]] = True
    at = order[new]
    return [hit[f : f + z - length + 1] for f, z in zip(first.tolist(), sizes.tolist())], owner[at], at - first[owner[at]], weight >= 2


def _spans(hit: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.r_[0, hit.view(np.int8), 0]))
    return [{"a": a, "n": b - a} for a, b in edge.reshape(-1, 2).tolist()]


def _texts(column: pa.Array) -> tuple[bytes, np.ndarray]:
    column = pc.fill_null(column, b"")
    values = column.to_pylist()
    return b"".join(values), np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int64)


def remove_repeats(docs: DataFrame, length: int = 200, gram: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, removed, kept) for every row: the maximal removed spans (start, length) and the other bytes.

    A byte is removed if a string of ``length`` bytes (32 or more) that covers it also starts anywhere else in the
    table, in the same document or another; strings never cross documents and are judged on the input.  A null text
    counts as empty.  Rows that repeat an id are separate documents, so equal rows lose what is long enough.  A null id
    is kept.  An empty table gives no rows.  Other columns are not read.  Keys and runs are compared by 64-bit hashes
    each, together 128 bits, windows in different parts of a split key by 128 bits, and all others by their bytes.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "suffixes")
    gram = gram or max(16, length // 5)
    kind = docs.schema[id_col].dataType.simpleString()
    text = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("th"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    long = text.where(F.length("text") >= length)
    ship(spark)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds = _texts(b.column(2))
            s = 0
            while s < b.num_rows:
                e = max(s + 1, int(np.searchsorted(bounds, bounds[s] + SLICE, "right")) - 1)
                lo, hi = int(bounds[s]), int(bounds[e])
                for part in range(lo, max(lo + 1, hi - length + 1), 4 * SLICE):  # more than one for a single very long text
                    stop = min(hi, part + 4 * SLICE + length - 1)
                    rel = bounds[s : e + 1] - part if e > s + 1 else np.array([0, stop - part])
                    doc, at, n, key, times, seg = runs(data[part:stop], rel, length, gram)
                    at = at + (part - lo if e == s + 1 else 0)
                    which = pa.array(doc + s)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(which), b.column(1).take(which), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(times.astype(np.int32)), pa.array(key.view(np.int64)), pa.array(seg.view(np.int64))], ["doc_id", "th", "s", "n", "grams", "key", "seg"])
                s = e

    table = scratch.save(long.mapInArrow(keyed, f"doc_id {kind}, th long, s int, n int, grams int, key long, seg long"), "runs")
    keys = table.groupBy("key").agg(F.sum("grams").alias("times"), ((F.min("seg") != F.max("seg")) | (F.max("grams") > 1)).alias("several")).where("times > 1")
    keys = scratch.save(keys.select("key", "several"), "keys")
    shared = scratch.save(table.drop("grams").join(keys, "key"), "shared")
    scratch.drop("runs", "keys")

    distinct = shared.where("several").groupBy("key", "seg").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "s", "n")).alias("at"))
    distinct = scratch.save(distinct, "distinct")
    per_key = scratch.save(distinct.groupBy("key").agg(F.count(F.lit(1)).alias("segs"), F.min("times").alias("least")).where("least = 1"), "per_key")
    most = max(2, HOT // (RUN + length))
    wanted = distinct.join(per_key, "key").select("key", "seg", "times", F.ceil(F.col("segs") / most).cast("int").alias("of"), "at.doc_id", "at.th", "at.s", "at.n")
    wanted = scratch.save(wanted.groupBy("doc_id", "th").agg(F.collect_list(F.struct("key", "seg", "times", "of", "s", "n")).alias("wanted")), "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(w["key"], w["seg"], w["times"], w["of"], data[w["s"] : w["s"] + w["n"] + length - 1]) for data, ws in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for w in ws]
            for s in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[s : s + 20_000]), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))], ["key", "seg", "times", "of", "data"])

    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["th"] == b["th"])
    found = long.join(wanted, same(long, wanted)).select(long["text"], "wanted")
    segs = scratch.save(found.mapInArrow(cut, "key long, seg long, times long, of int, data binary"), "segs")
    scratch.drop("distinct", "per_key", "wanted")

    cells = 4 * partitions(spark)
    record = np.dtype([("w1", "<u8"), ("w2", "<u8"), ("key", "<i8"), ("seg", "<i8"), ("a", "<i4"), ("known", "<i4")])
    span_type = pa.list_(pa.struct([("a", pa.int32()), ("n", pa.int32())]))
    names, kinds = ["cell", "key", "seg", "spans", "windows"], (pa.int32(), pa.int64(), pa.int64(), span_type, pa.binary())
    schema = f"cell int, key long, seg long, spans {_SPANS}, windows binary"

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[bytes, int, bool]] = {}

        def judged() -> pa.RecordBatch:
            ids, (parts, counts, split) = np.array(list(held)), zip(*held.values())
            hits, part, place, known = repeated(list(parts), list(counts), length)
            out = [(-1, int(k), int(s), _spans(h), None) for (k, s), h in zip(ids, hits)]
            if any(split):  # what other parts of the key hold is compared by fingerprints
                mine = np.array(split)[part]
                rows = np.zeros(int(mine.sum()), record)
                part, place = part[mine], place[mine]
                data = [np.frombuffer(p, np.uint8) for p in parts]
                order = np.argsort(part, kind="stable")
                for name, factor in (("w1", 0x9E3779B185EBCA87), ("w2", 0xC2B2AE3D27D4EB4F)):
                    cut = np.searchsorted(part[order], np.arange(len(parts) + 1))
                    for i in np.unique(part):
                        at = order[cut[i] : cut[i + 1]]
                        rows[name][at] = _mixed(_rolling(data[i], length, factor))[place[at]]
                rows["key"], rows["seg"], rows["a"], rows["known"] = ids[part, 0], ids[part, 1], place, known[mine]
                cell = (rows["w1"] >> np.uint64(33)).astype(np.int64) % cells
                order = np.argsort(cell, kind="stable")
                cut = np.searchsorted(cell[order], np.arange(cells + 1))
                out += [(c, None, None, None, rows[order[cut[c] : cut[c + 1]]].tobytes()) for c in range(cells) if cut[c] < cut[c + 1]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

        size, last = 0, None
        for b in batches:
            for key, seg, times, of, data in zip(*(c.to_pylist() for c in b.columns)):
                group = (key, seg % of)
                if group != last and size > SORTED:
                    yield judged()
                    held, size = {}, 0
                if (key, seg) not in held:
                    held[key, seg] = (data, times, of > 1)
                    size += len(data) + 1
                last = group
        if held:
            yield judged()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.frombuffer(b"".join(x for b in batches for x in b.column(0).to_pylist()), record)
        order = np.lexsort((rows["w2"], rows["w1"]))
        rows = rows[order]
        new = np.r_[True, (rows["w1"][1:] != rows["w1"][:-1]) | (rows["w2"][1:] != rows["w2"][:-1])] if len(rows) else np.empty(0, bool)
        size = np.diff(np.append(np.flatnonzero(new), len(rows)))
        found = rows[np.repeat(size > 1, size) & (rows["known"] == 0)]
        found = found[np.lexsort((found["a"], found["seg"], found["key"]))]
        new = np.r_[True, (found["key"][1:] != found["key"][:-1]) | (found["seg"][1:] != found["seg"][:-1])] if len(found) else np.empty(0, bool)
        cut = np.append(np.flatnonzero(new), len(found)).tolist()
        out = [(int(found["key"][s]), int(found["seg"][s]), [{"a": a, "n": 1} for a in found["a"][s:e].tolist()]) for s, e in zip(cut, cut[1:])]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds[1:4])], names[1:4])

    parted = segs.repartition(partitions(spark), "key", F.pmod("seg", "of")).sortWithinPartitions("key", F.pmod("seg", "of"))
    sorted_ = scratch.save(parted.mapInArrow(sort, schema), "sorted")
    across = sorted_.where("cell >= 0").select("windows", "cell").repartition(cells, "cell").mapInArrow(meet, f"key long, seg long, spans {_SPANS}")
    decided = sorted_.where("cell < 0").select("key", "seg", "spans").unionByName(across)
    decided = scratch.save(decided.withColumn("judged", F.lit(True)), "decided")
    scratch.drop("segs", "sorted")

    judged = shared.where("several").join(decided, ["key", "seg"], "left")
    spans = F.when(F.col("judged"), F.col("spans")).otherwise(F.array(F.struct(F.lit(0).alias("a"), F.col("n"))))
    some = judged.select("doc_id", "th", "s", F.explode(spans).alias("x")).select("doc_id", "th", (F.col("s") + F.col("x.a")).alias("s"), F.col("x.n").alias("n"))
    hits = shared.where("not several").select("doc_id", "th", "s", "n").unionByName(some)
    hits = scratch.save(hits.groupBy("doc_id", "th").agg(F.collect_set(F.struct("s", "n")).alias("hits")), "hits")
    scratch.drop("shared", "decided")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, spans, kept = [], [], []
            for data, hits in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                sizes.append(len(data))
                gone: list[list[int]] = []
                for a, e in sorted((h["s"], h["s"] + h["n"] + length - 1) for h in hits or ()):
                    if gone and a <= gone[-1][1]:
                        gone[-1][1] = max(gone[-1][1], e)
                    else:
                        gone.append([a, e])
                spans.append([{"start": a, "length": e - a} for a, e in gone])
                edge = [0, *(x for g in gone for x in g), len(data)]
                kept.append(b"".join(data[x:y] for x, y in zip(edge[::2], edge[1::2])) if gone else data)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "removed", "kept"])

    whole = text.join(hits, same(text, hits), "left").select(text["doc_id"], text["text"], "hits")
    return whole.mapInArrow(remove, f"doc_id {kind}, n_bytes long, removed array<struct<start:long,length:long>>, kept binary")
