"""How filters overlap: what each removes in every order of them, from one pass over the texts.

Each document gets a mask of the filters that it fails.  Copies are found by sorting: rows are dealt by ranges of
(fingerprint, doc_id) and sorted by (fingerprint, text, doc_id), so that a copy stands next to the one before it.  Where
the copies of a text may go on from an earlier range, a few rows of each range are settled by a join.  Masks are counted
by part; the counts are additive, and all orders of the filters are worked out from them alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import ship
from .scratch import Scratch, partitions

_OUT = "doc_id long, part string, mask int, copy boolean, ask boolean, note boolean, fp long, text string"


def _neighbours(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (fp, text, doc_id) with what the row before tells: ``copy`` if a smaller doc_id with the same text went
    before.  The first of a text whose fingerprint is the range's first are marked ``ask``: there may be a smaller one in
    an earlier range.  Notes, rows of their own, tell the smallest doc_id of each text at either end of the range."""
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("copy", pa.bool_()), ("ask", pa.bool_()), ("note", pa.bool_()), ("fp", pa.int64()), ("text", pa.large_string())])
    first, run, open_notes = None, None, []  # fingerprint of the range's first row; fingerprint, text and smallest doc_id of the last row's text; all texts of its fingerprint

    def noted() -> pa.RecordBatch:
        rows = [{"doc_id": least, "part": None, "mask": 0, "copy": False, "ask": False, "note": True, "fp": fp, "text": text} for fp, text, least in open_notes]
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    for batch in parts:
        copy, ask, kept = [], [], []
        for i, h, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "fp", "text"))):
            if run is None or h != run[0] or text != run[1]:
                if run is not None and h != run[0]:
                    if run[0] == first:
                        yield noted()
                    open_notes.clear()
                first = h if first is None else first
                run = [h, text, None]
                open_notes.append(run)
            run[2] = i if run[2] is None else run[2]
            copy.append(i is not None and i > run[2])
            ask.append(i is not None and i == run[2] and h == first)
            kept.append(text if ask[-1] else None)
        flags = [pa.array(copy, pa.bool_()), pa.array(ask, pa.bool_()), pa.array([False] * len(copy), pa.bool_())]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "part", "mask")), *flags, batch.column("fp"), pa.array(kept, pa.large_string())], schema=schema)
    if open_notes:
        yield noted()


def failure_masks(docs: DataFrame, fails: dict[str, Column], copies: str, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(doc_id, part, mask) of every row: bit k of the mask is set if it fails the k-th filter of ``fails`` in order of names;
    ``copies`` is one more filter, that the text is the same as that of a smaller doc_id.

    The conditions are on the text, which they find as the column ``text``; null texts and parts count as empty, null
    conditions as passed.  A null doc_id is no smaller than any, nor is any smaller.  Rows with equal doc_id and text
    are all failed or none.  Other columns are not read, so their names do not matter; an empty table gives no rows."""
    spark = docs.sparkSession
    ship(spark)
    names = sorted([*fails, copies])
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), text.alias("text"), F.xxhash64(text).alias("fp"))
    dealt = rows.repartitionByRange(partitions(spark), "fp", "doc_id").sortWithinPartitions("fp", "text", "doc_id")
    mask = sum((F.when(fails[x], 1 << k).otherwise(0) for k, x in enumerate(names) if x != copies), F.lit(0))
    seen = dealt.select("doc_id", "part", "text", "fp", mask.cast("int").alias("mask")).mapInArrow(_neighbours, _OUT)
    seen = Scratch(spark, "masks").save(seen, "seen")
    lowest = seen.where("note").groupBy("fp", "text").agg(F.min("doc_id").alias("lowest"))
    asked = seen.where("ask").join(lowest, ["fp", "text"], "left").withColumn("copy", F.coalesce(F.col("lowest") < F.col("doc_id"), F.lit(False)))
    settled = seen.where("not ask and not note").select("doc_id", "part", "mask", "copy").unionByName(asked.select("doc_id", "part", "mask", "copy"))
    bit = 1 << names.index(copies)
    return settled.select("doc_id", "part", F.when(F.col("copy"), F.col("mask").bitwiseOR(F.lit(bit))).otherwise(F.col("mask")).alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good ones and toxic ones by (part, mask): counters that may be added up over any parts of the table.

    A document labelled several times has its largest labels; without labels it is neither good nor toxic."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("good"), F.max("toxic").alias("toxic"))
    rows = masks.join(known, "doc_id", "left")
    one = lambda c: F.sum(F.when(F.col(c) == 1, 1).otherwise(0)).cast("long")
    return rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), one("good").alias("good"), one("toxic").alias("toxic"))


def all_orders(counts: DataFrame, names: str) -> DataFrame:
    """For each part, order of the filters and step: what the step's filter does after those before it, as sums of ``counts``."""
    spark = counts.sparkSession
    steps = [("".join(o), k + 1, 1 << names.index(o[k]), sum(1 << names.index(x) for x in o[:k])) for o in permutations(names) for k in range(len(names))]
    steps = spark.createDataFrame(steps, "filter_order string, step int, bit int, earlier int")
    steps = steps.withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit((1 << len(names)) - 1))))  # a bounded table, made by rule
    mask, bit = F.col("mask"), F.col("bit")
    fails, gone = mask.bitwiseAND(bit) > 0, mask.bitwiseAND(F.col("earlier")) > 0
    add = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(0)).cast("long")
    share = F.col("n") * F.floor(F.lit(factorial(len(names))) / F.bit_count(mask))  # of all orders, those in which this filter is the first that is failed
    return counts.join(F.broadcast(steps), "mask").groupBy("part", "filter_order", "step").agg(
        add(~fails & ~gone).alias("kept"), add(fails & ~gone).alias("removed"), add(fails & gone).alias("redundant"), add(mask == bit).alias("unique_fails"),
        add(fails & ~gone, "good").alias("good_lost"), add(fails & ~gone, "toxic").alias("toxic_lost"), F.sum(F.when(fails, share).otherwise(0)).cast("long").alias("shapley"))
