"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance d <= 2h+1 have a word halfway: at most h bits from one of them and h+1 from the other.
So every fingerprint emits all words within half the radius, the words are brought together, and fingerprints that
meet there are verified.  For radius 3 every fingerprint emits its ball of radius 1, and the fingerprints with an even
number of bits also emit the shell at distance 2: a pair at distance 3 has one even and one odd member, a pair at
distance 2 meets in two balls of radius 1.  That is complete, with half the words of emitting both shells.

The shuffle is on the words, in compressed form.  Words are dealt to cells by their first bits, and a fingerprint is
sent once to each cell that any of its words falls into; the cell derives the words again.  Within a cell the groups of
fingerprints at one word are linked as stars to their smallest member, so a dense group costs as many links as it has
members, and only a spanning forest leaves the cell.  Copies share a fingerprint and are collapsed before all this.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..runtime import give_back, ship
from .components import connected_components, forest
from .paragraphs import hashed_words, settled_roots, shingles
from .scratch import Scratch, partitions

#: Words that one cell may derive at a time.
CELL_WORDS = 3_000_000
#: Words of text whose shingles are hashed at a time.
SLICE_WORDS = 150_000
#: 64-bit words beside the band that a candidate carries if it is verified by its shingles later.
BESIDE = 2
#: Bytes of a fingerprint's copies that are shuffled at a time.
AT_ONCE = 2_500

_LANES = sum(((np.arange(256, dtype=np.uint64) >> np.uint64(b)) & np.uint64(1)) << np.uint64(8 * b) for b in range(8))


def shingle_hashes(text: bytes, shingle: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words, lower-cased in A-Z and joined by single spaces; of all words if fewer."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    runs = zip(*(words[i:] for i in range(shingle)))
    return np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(seed)), np.uint64, len(words) - shingle + 1)


def _remix(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th independent word made from hashes; the 0-th is the hash itself."""
    if not k:
        return h
    x = h + np.uint64((k * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One word per document: a bit is 1 if set in over half of the document's hashes.  Every count is over 0."""
    first = np.cumsum(counts) - counts
    pieces = (counts + 254) // 255  # a byte holds the count of a bit over 255 hashes
    owner_first = np.cumsum(pieces) - pieces
    within = np.arange(pieces.sum()) - np.repeat(owner_first, pieces)
    starts = np.repeat(first, pieces) + within * 255
    columns = hashes.view(np.uint8).reshape(-1, 8)
    out = np.zeros((len(counts), 8), np.uint8)
    for j in range(8):
        sums = np.add.reduceat(_LANES[columns[:, j]], starts).view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(sums.astype(np.int64), owner_first, axis=0)
        out[:, j] = np.packbits(ones * 2 > counts[:, None], axis=1, bitorder="little")[:, 0]
    return out.view(np.uint64)[:, 0]


def fingerprints(texts: list[bytes], shingle: int, words: int, once: bool = False) -> np.ndarray:
    """SimHash fingerprints of ``words`` 64-bit words each; a text without words has fingerprint zero.  With ``once``
    repeats of a shingle do not count."""
    out = np.zeros((len(texts), words), np.uint64)
    held: list[np.ndarray] = []
    owners: list[int] = []

    def flush() -> None:
        if held:
            h, counts = np.concatenate(held), np.array([len(x) for x in held])
            for k in range(words):
                out[owners, k] = majority_bits(_remix(h, k), counts)
            held.clear()
            owners.clear()

    size = 0
    for i, text in enumerate(texts):
        if len(h := shingle_hashes(text, shingle)):
            h = np.unique(h) if once else h
            held.append(h)
            owners.append(i)
            size += len(h)
        if size >= SLICE_WORDS:
            flush()
            size = 0
    flush()
    return out


def fingerprint_table(docs: DataFrame, id_col: str, text_col: str, shingle: int, words: int, once: bool = False) -> DataFrame:
    """(id, tid, fp): tid is a hash of the exact text, fp the fingerprint's words, little-endian."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [x or b"" for x in b.column(2).to_pylist()]
            fp = fingerprints(texts, shingle, words, once)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x.tobytes() for x in fp], pa.binary())], ["id", "tid", "fp"])
        give_back()

    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("tid"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(hashed, f"id {kind}, tid long, fp binary")


def _flips(bits: int, weight: int) -> np.ndarray:
    """All words with ``weight`` of the lowest ``bits`` bits set, for weights 0 to 2."""
    one = np.uint64(1) << np.arange(bits, dtype=np.uint64)
    if weight == 0:
        return np.zeros(1, np.uint64)
    if weight == 1:
        return one
    i, j = np.triu_indices(bits, 1)
    return one[i] | one[j]


def destinations(keys: np.ndarray, width: int, prefix: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of a key, cell) for each cell that holds a word emitted by the key: cells differ from the key's own first
    ``prefix`` bits in at most 1 bit, or 2 for keys with an even number of bits."""
    own = (keys >> np.uint64(width - prefix)).astype(np.int64)
    even = np.bitwise_count(keys) % 2 == 0
    near = np.concatenate([_flips(prefix, 0), _flips(prefix, 1)]).astype(np.int64)
    far = _flips(prefix, 2).astype(np.int64)
    all_, ev = np.arange(len(keys)), np.flatnonzero(even)
    index = np.concatenate([np.repeat(all_, len(near)), np.repeat(ev, len(far))])
    cell = np.concatenate([(own[:, None] ^ near).ravel(), (own[ev][:, None] ^ far).ravel()])
    return index, cell


def _emit(keys: np.ndarray, width: int, prefix: int, cell: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(words, index of the emitting key): the words of this cell at ``distance`` from their keys."""
    apart = np.bitwise_count((keys >> np.uint64(width - prefix)) ^ np.uint64(cell)) if prefix else np.zeros(len(keys), np.uint8)
    words, index = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    top = np.uint64(cell) << np.uint64(width - prefix) if prefix else np.uint64(0)
    low = np.uint64((1 << (width - prefix)) - 1)
    for d in range(distance + 1):
        at = np.flatnonzero(apart == d)
        flips = _flips(width - prefix, distance - d)
        if len(at) and len(flips):
            words.append((((keys[at] & low) | top)[:, None] ^ flips).ravel())
            index.append(np.repeat(at, len(flips)))
    return np.concatenate(words), np.concatenate(index)


def meetings(keys: np.ndarray, width: int, prefix: int, cell: int) -> tuple[np.ndarray, np.ndarray]:
    """(group, index): the keys that meet at each word of the cell, groups of two or more, groups in ascending order.

    Keys may repeat.  A cell that would derive too many words at a time is split by further bits, one part after the
    other."""
    rest = width - prefix
    even = np.bitwise_count(keys) % 2 == 0
    if prefix < width - 8 and prefix < 40 and len(keys) * (1 + rest + rest * rest // 4) > CELL_WORDS * 4 and len(keys) > 64:
        groups, members, n = [], [], 0
        for bit in (0, 1):
            part = cell * 2 + bit
            apart = np.bitwise_count((keys >> np.uint64(rest - 1)) ^ np.uint64(part))
            at = np.flatnonzero(apart <= np.where(even, 2, 1))
            g, m = meetings(keys[at], width, prefix + 1, part)
            groups.append(g + n)
            members.append(at[m])
            n = groups[-1][-1] + 1 if len(g) else n
        return np.concatenate(groups), np.concatenate(members)
    parts = [_emit(keys, width, prefix, cell, d) for d in (0, 1)]
    inner_w, inner_i = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(inner_w, kind="stable")
    inner_w, inner_i = inner_w[order], inner_i[order]
    seen = np.zeros(1 << 20, bool)
    shift = np.uint64(44)
    mul = np.uint64(0x9E3779B97F4A7C15)
    seen[(inner_w * mul) >> shift] = True
    outer_w, outer_i = [], []
    ev = np.flatnonzero(even)
    step = max(1, CELL_WORDS // max(1, rest * rest // 2))
    for s in range(0, len(ev), step):
        w, i = _emit(keys[ev[s : s + step]], width, prefix, cell, 2)
        hit = seen[(w * mul) >> shift]
        w, i = w[hit], i[hit]
        at = np.searchsorted(inner_w, w)
        hit = (at < len(inner_w)) & (inner_w[np.minimum(at, len(inner_w) - 1)] == w) if len(inner_w) else np.zeros(len(w), bool)
        outer_w.append(w[hit])
        outer_i.append(ev[s : s + step][i[hit]])
    w, i = np.concatenate([inner_w, *outer_w]), np.concatenate([inner_i, *outer_i])
    order = np.argsort(w, kind="stable")  # the members of balls of radius 1 stay first in each group
    w, i = w[order], i[order]
    new = np.r_[True, w[1:] != w[:-1]] if len(w) else np.empty(0, bool)
    size = np.diff(np.append(np.flatnonzero(new), len(w)))
    keep = np.repeat(size > 1, size)
    return np.repeat(np.cumsum(size > 1) - 1, size)[keep], i[keep]


def distance(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp[a] ^ fp[b]).sum(axis=1, dtype=np.int64)


def links(fp: np.ndarray, group: np.ndarray, member: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, over the members, of all links of at most ``radius`` bits between members of one group.

    Stars first: each member against the first of its group.  Groups that are still apart are then compared in full,
    in blocks, so that no link is lost that would join two parts."""
    none = np.empty(0, np.int64)
    if not len(group):
        return none, none
    first = np.r_[True, group[1:] != group[:-1]]
    start = np.flatnonzero(first)
    hub = member[np.repeat(start, np.diff(np.append(start, len(group))))]
    pair = np.unique(np.stack([np.minimum(hub, member), np.maximum(hub, member)], 1)[hub != member], axis=0)
    ok = distance(fp, pair[:, 0], pair[:, 1]) <= radius
    a, b = pair[ok, 0], pair[ok, 1]
    root = forest(len(fp), a, b)
    lo, hi = np.minimum.reduceat(root[member], start), np.maximum.reduceat(root[member], start)
    end = np.append(start[1:], len(group))
    done: set[bytes] = set()
    for g in np.flatnonzero(lo != hi):
        m = np.unique(member[start[g] : end[g]])
        if m.tobytes() in done or len(np.unique(root[m])) < 2:
            continue
        done.add(m.tobytes())
        found = False
        for s in range(0, len(m), 256):
            x, y = np.nonzero(root[m[s : s + 256]][:, None] != root[m][None, :])
            x, y = m[s : s + 256][x], m[y]
            hit = distance(fp, x, y) <= radius
            if hit.any():
                a, b, found = np.append(a, x[hit]), np.append(b, y[hit]), True
        if found:
            root = forest(len(fp), a, b)
    at = np.flatnonzero(root != np.arange(len(root)))
    return at, root[at]


def linked_fingerprints(distinct: DataFrame, scratch: Scratch, words: int, width: int, radius: int, beside: int = 0) -> DataFrame:
    """(u, v) edges that connect exactly what links of at most ``radius`` bits connect, among the fingerprints that meet.

    ``distinct`` has one row per fingerprint: node (long) and fp.  The fingerprint is cut into bands of ``width`` bits,
    each hashed by balls of radius 3.  One band of all bits finds every pair within 3 bits; b bands find every pair
    within 4b-1 bits, and most beyond.  With ``beside`` only so many words next to the band's are sent along, and the radius
    holds for these.  Edges lead to the smallest node of what is connected in a cell.

    More fingerprints ask for more cells, and each is sent to more of them; so the bands are taken in turns, and what is shuffled
    at a time stays within AT_ONCE bytes a fingerprint, or one band."""
    spark = distinct.sparkSession
    n = max(1, distinct.count())
    bands = words * 64 // width
    per_node = (1 + width + width * (width - 1) // 4)
    prefix = int(np.clip(np.ceil(np.log2(max(1.0, n * per_node / CELL_WORDS))), 1, 16))
    record = np.dtype([("node", "<i8"), ("key", f"<u{width // 8}"), ("fp", "<u8", (beside,))] if beside else [("node", "<i8"), ("fp", "<u8", (words,))])

    def band(fp: np.ndarray, b: int) -> np.ndarray:
        per_word = 64 // width
        x = fp[:, b // per_word]
        return x if per_word == 1 else (x >> np.uint64(width * (b % per_word))) & np.uint64((1 << width) - 1)

    def routed(turn: range):
        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                rows = np.empty(b.num_rows, record)
                rows["node"] = b.column(0).to_numpy()
                fp = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u8").reshape(-1, words)
                if not beside:
                    rows["fp"] = fp
                for k in turn:
                    keys = band(fp, k)
                    if beside:
                        rows["key"] = keys
                        rows["fp"] = fp[:, (k * width // 64 + 1 + np.arange(beside)) % words]
                    index, cell = destinations(keys, width, prefix)
                    order = np.argsort(cell, kind="stable")
                    index, cell = index[order], cell[order]
                    cut = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
                    bounds = [*zip(cut.tolist(), [*cut[1:].tolist(), len(cell)])]
                    cells, blobs = [(k << prefix) | int(cell[s]) for s, _ in bounds], [rows[index[s:e]].tobytes() for s, e in bounds]
                    yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(blobs, pa.binary())], ["cell", "rows"])

        return route

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for b in batches:
            for c, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(c, []).append(x)
        while held:
            c, parts = held.popitem()
            rows = np.frombuffer(b"".join(parts), record)
            if beside:
                rows = rows[np.argsort(rows["node"])]
                keys = rows["key"].astype(np.uint64)
            else:
                keys = band(np.ascontiguousarray(rows["fp"]), c >> prefix)
            group, member = meetings(keys, width, prefix, c & ((1 << prefix) - 1))
            a, b = links(np.ascontiguousarray(rows["fp"]), group, member, radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(rows["node"][a]), pa.array(rows["node"][b])], ["u", "v"])
        give_back()

    def found(turn: range) -> DataFrame:
        dealt = distinct.select("node", "fp").mapInArrow(routed(turn), "cell long, rows binary")
        return dealt.repartition(min(len(turn) << prefix, 4 * partitions(spark)), "cell").mapInArrow(solve, "u long, v long").distinct()

    ship(spark)
    copies = 1 + prefix + prefix * (prefix - 1) / 4  # cells that a key is sent to, on average
    step = max(1, int(AT_ONCE / (copies * record.itemsize)))
    turns = [range(k, min(k + step, bands)) for k in range(0, bands, step)]
    if len(turns) == 1:
        return scratch.save(found(turns[0]), "links")
    parts = []
    for i, turn in enumerate(turns):
        parts.append(scratch.save(found(turn), f"links{i}"))
        scratch.drop()  # the turn's shuffle files
    whole = scratch.save(functools.reduce(DataFrame.unionByName, parts).distinct(), "links")
    scratch.drop(*(f"links{i}" for i in range(len(turns))))
    return whole


def shingle_sets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(node, payload): even 32-bit hashes of the shingles of each node's text; ``nodes`` has node, id and tid."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.unique(shingles(hashed_words(np.frombuffer(x or b"", np.uint8))[0], shingle).astype("<u4") & np.uint32(0xFFFFFFFE)).tobytes() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], ["node", "payload"])

    texts = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_tid"), F.col(text_col).cast("binary").alias("_text"))
    texts = texts.join(nodes, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_tid") == F.col("tid"))).select("node", "_text")
    return texts.mapInArrow(hashed, "node long, payload binary").groupBy("node").agg(F.first("payload").alias("payload"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, words: int = 1,
                    width: int = 64, radius: int = 3, similarity: float | None = None) -> DataFrame:
    """(id, tid, fp, component_id, keeper_tid) for every row of ``docs``.

    Rows whose fingerprints are at most ``radius`` bits apart are linked; component_id is the smallest id reachable and
    keeper_tid the smallest text hash among the component's rows of that id.  With one band (``width`` 64, ``words``
    1, radius 3) every link counts.  With ``words`` 64-bit words in bands of 32 bits a pair must also meet in a band,
    which is certain within 4 * bands - 1 bits.

    With ``similarity`` fingerprints are of distinct shingles and only propose pairs: those that meet in a band and are at
    most ``radius`` bits apart in the two words beside it.  A pair is linked if the exact Jaccard similarity of its sets
    of shingles is at least ``similarity``; texts of one fingerprint count as equal.

    A null text counts as empty.  Texts without words have fingerprint zero and are linked like any other.  Equal rows
    and equal ids share a component if their texts do.  A null id is never a component_id unless all ids are null.
    An empty table gives no rows; other columns of ``docs`` are not read.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    table = scratch.save(fingerprint_table(docs, id_col, text_col, shingle, words, similarity is not None), "rows")
    best = F.min(F.struct(F.col("id").isNull().alias("n"), "id", "tid")).alias("best")
    distinct = table.groupBy("fp").agg(best).withColumn("node", F.monotonically_increasing_id())
    distinct = scratch.save(distinct, "distinct")  # the node numbers are fixed from here on
    found = linked_fingerprints(distinct, scratch, words, width, radius, BESIDE if similarity is not None else 0)
    if similarity is None:
        roots = connected_components(found, scratch)
    else:
        nodes = found.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(distinct.select("node", "best.id", "best.tid"), "node")
        roots = settled_roots(found, scratch.save(shingle_sets(docs, nodes, id_col, text_col, shingle), "sets"), scratch, similarity)
    roots = scratch.save(roots.join(distinct.select("node", "best"), "node"), "roots")
    least = scratch.save(roots.groupBy("root").agg(F.min("best").alias("least")), "least")
    moved = scratch.save(roots.select("node", "root").join(least, "root").select("node", "least"), "moved")
    classes = distinct.join(moved, "node", "left").select("fp", F.coalesce("least", "best").alias("least"))
    classes = scratch.save(classes, "classes")
    scratch.drop("links", "sets", "settled", "roots", "least", "moved")
    return table.join(classes, "fp", "left").select("id", "tid", "fp", F.col("least.id").alias("component_id"), F.col("least.tid").alias("keeper_tid"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` with one document of each near-duplicate group: the one of the smallest id.

    Rows that repeat an id and its text count as one document; if they differ elsewhere, any one of them stays.  Of rows that share
    an id only, each text is a document.  Null and empty texts, and others without a word, are one group.  A null id is
    larger than any other.  All columns are kept as they are, whatever their names; an empty table gives an empty one.
    """
    groups = near_duplicates(docs, id_col, text_col, **how)
    keepers = groups.select(F.col("component_id").alias("_rl_id"), F.col("keeper_tid").alias("_rl_tid")).distinct()
    keyed = docs.withColumn("_rl_text", F.xxhash64(F.col(text_col))).dropDuplicates([id_col, "_rl_text"])
    kept = keyed.join(keepers, keyed[id_col].eqNullSafe(keepers["_rl_id"]) & (keyed["_rl_text"] == keepers["_rl_tid"]), "left_semi")
    return kept.select(*docs.columns)
