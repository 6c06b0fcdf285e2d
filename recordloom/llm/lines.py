"""Document rules, and lines that too many documents of a host share.

Each text is read once, whole: its rule figures, and for each of its distinct normalised lines a 64-bit hash and the code
points of words that stand in it.  Distinct documents are counted by (host, hash); lines above the limit are removed,
and documents of which too little is left are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import ship
from .scratch import Scratch

#: Most documents of a host that may hold a line; share of a document's words, in code points, that must be left; parts that
#: the rows of one (host, line) are dealt to when the frequent lines are looked up.
MOST, LEFT, SALTS = 20, 0.5, 16
_SPACE, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SCHEMA = pa.schema([*((c, pa.int64()) for c in _STATS), ("lines", pa.list_(pa.struct([("line", pa.int64()), ("chars", pa.int64())])))])


def _points(text: bytes) -> int:
    """Code points of UTF-8 bytes: those that do not continue one."""
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def repeated_words(words: list[bytes], width: int = 8) -> int:
    """Words within runs of ``width`` words, a power of two, that are found twice or more; the first time counts too."""
    if len(words) <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    step = 1
    while step < width:  # numbers of runs twice as long, equal for equal runs
        _, ids = np.unique(ids[:-step] * len(words) + ids[step:], return_inverse=True)
        step *= 2
    again = (np.bincount(ids) > 1)[ids]
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:-width] += again
    edge[width:] -= again
    return int(np.count_nonzero(np.cumsum(edge)))


def figures(text: str | None) -> dict:
    """The rule figures of a text, and its distinct normalised lines: words in lower case (A-Z), one space between."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip(_SPACE)]
    held: dict[int, int] = {}
    for line in lines:
        parts = line.split()
        h = xxhash.xxh64_intdigest(b" ".join(parts).translate(_LOWER))
        held[h] = held.get(h, 0) + _points(b"".join(parts))
    return {"n_words": len(words), "word_chars": _points(data.translate(None, _SPACE)), "n_symbols": len(data) - len(data.translate(None, _SYMBOLS)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeated_words(words),
            "lines": [{"line": h - (1 << 64) if h >> 63 else h, "chars": n} for h, n in held.items()]}


def _read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts:
        texts = batch.column("text")
        for s in range(0, len(texts), 500):
            found = pa.RecordBatch.from_pylist([figures(t) for t in texts.slice(s, 500).to_pylist()], schema=_SCHEMA)
            rest = batch.slice(s, 500)
            yield pa.RecordBatch.from_arrays([rest.column("id"), rest.column("host"), *found.columns], names=["id", "host", *_SCHEMA.names])


def line_frequency(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", most: int = MOST, left: float = LEFT) -> DataFrame:
    """One row for each row of ``docs``: id, host, the rule figures of its text, ``removed_chars`` and ``n_removed_lines`` (distinct
    ones) of lines that more than ``most`` distinct ids of its host hold, and ``depleted``: it lost lines, and under ``left`` of
    the code points in its words are left.

    Null texts have no lines.  Rows without a host make a host of their own, and rows without an id are one document of
    it.  Repeated rows get a row each and count once.  Lines are told apart by 64 bits of hash.  Other columns are not
    read; an empty table gives no rows."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text"))
    schema = f"id {dict(rows.dtypes)['id']}, host string, {', '.join(f'{c} long' for c in _STATS)}, lines array<struct<line: long, chars: long>>"
    read = Scratch(spark, "lines").save(rows.mapInArrow(_read, schema).withColumn("row", F.monotonically_increasing_id()), "read")

    key = F.struct(F.col("host").isNull().alias("none"), F.coalesce("host", F.lit("")).alias("name")).alias("key")
    held = read.select("row", "id", key, F.explode("lines").alias("at")).select("row", "id", "key", "at.*")
    who = held.select("key", "line", F.struct(F.col("id").isNull(), F.col("id")).alias("who"))
    above = who.groupBy("key", "line").agg(F.count_distinct("who").alias("n")).where(F.col("n") > most)
    above = above.select("key", "line", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    lost = held.select("row", "key", "line", "chars", (F.col("row") % SALTS).cast("int").alias("salt")).join(above, ["key", "line", "salt"])
    lost = lost.groupBy("row").agg(F.sum("chars").alias("removed_chars"), F.count(F.lit(1)).alias("n_removed_lines"))
    out = read.drop("lines").join(lost, "row", "left").fillna(0, ["removed_chars", "n_removed_lines"]).drop("row")
    return out.withColumn("depleted", (F.col("removed_chars") > 0) & (F.col("word_chars") - F.col("removed_chars") < left * F.col("word_chars")))


def base_failed(least: int = 20, repeated: int = 30) -> Column:
    """Too few words, or more than ``repeated`` per cent of them in repeated runs."""
    return (F.col("n_words") < least) | (100 * F.col("n_repeat_words") > repeated * F.col("n_words"))
