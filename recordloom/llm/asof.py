"""Tolerant as-of join: for each row on the left the latest row of its key at or before its time, within a tolerance.

An equi-join on the key with a time-range predicate, hot keys salted by replication, would still form as many pairs as a
hot key's rows on either side multiply to.  So time is cut into a tree of intervals, each parted into ``2 ** BITS``
children, and the equi-join runs on (key, cell): in each interval around its time a row on the left meets the latest time
of every child before its own, and in the smallest interval the single times at or before it.  Smallest are the
intervals that hold no more than ``2 ** BITS`` distinct times of any key; their depth is found from the data, so a row
on the left has at most ``2 ** BITS`` candidates a level however many rows its key has.  Cells that many rows ask for are
salted: their rows on the left are dealt to parts, and their few candidates replicated.  Of rows at one time the first
by the tie order is kept, and their number, before any join; the latest time is then joined to it, and a left join
brings back what has no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .scratch import Scratch

#: An interval has 2 ** BITS children.  At most DEEP keys have trees deeper than the others'.  A cell that more than one in HOT of all
#: requests are for is salted, into SALTS parts at most; there are fewer than HOT such cells.  Whatever the size of the
#: tables, only these keys and cells are collected and broadcast.
BITS, DEEP, HOT, SALTS = 6, 10_000, 400, 64


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970 of a timestamp; without a zone it is read as UTC, whatever the session's zone."""
    c = F.col(column)
    if df.schema[column].dataType.typeName() != "timestamp_ntz":
        return F.unix_micros(c)
    day = F.unix_date(c.cast("date")).cast("long") * 86_400_000_000
    return day + F.hour(c).cast("long") * 3_600_000_000 + F.minute(c).cast("long") * 60_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def times(right: DataFrame, key: str, at: str, prefer: list[str]) -> DataFrame:
    """(key, t, best, n): of the rows with one key and time the first by ``prefer``, larger before smaller and null last, and
    their number.  Rows without key or time are left out."""
    known = right.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    return known.groupBy(F.col(key).alias("key"), F.col(at).alias("t")).agg(F.max(F.struct(*prefer)).alias("best"), F.count(F.lit(1)).alias("n"))


def trees(found: DataFrame, back: int) -> tuple[list[int], int, dict]:
    """The widths of the levels' intervals as powers of two, the first no shorter than ``back``; the number of levels that all keys
    have; and that of at most DEEP keys that have more.  In a key's last level no interval holds more than ``2 ** BITS`` of
    its distinct times."""
    spark, widths, base, depth, within = found.sparkSession, [max(BITS, back.bit_length())], None, {}, found
    while widths[-1] > BITS:
        full = within.groupBy("key", F.shiftright("t", widths[-1])).count().where(F.col("count") > 1 << BITS).select("key").distinct()
        keys = [r["key"] for r in full.limit(DEEP + 1).collect()]
        if base is None and len(keys) <= DEEP:
            base = len(widths)
        if not keys:
            break
        widths.append(max(BITS, widths[-1] - BITS))
        if base is not None:
            depth |= dict.fromkeys(keys, len(widths))
            within = found.join(F.broadcast(spark.createDataFrame([(k,) for k in keys], found.select("key").schema)), "key", "left_semi")
    return widths, base or len(widths), depth


def _cell(level: int, at: Column, width: int) -> Column:
    """The number of an interval of a level, with room for a salt."""
    return (F.shiftright(at, width) * 16 + level) * SALTS


def offers(found: DataFrame, widths: list[int], base: int) -> DataFrame:
    """(key, cell, since, at): in a cell ``at`` is a candidate for rows from ``since`` on, null for all.  ``found`` has the depth of
    each key's tree."""
    cells = F.array(*[_cell(k, F.col("t"), w) for k, w in enumerate(widths)])
    out = found.select("key", F.element_at(cells, F.col("depth")).alias("cell"), F.col("t").alias("since"), F.col("t").alias("at"))
    for level, narrow in enumerate(widths[1:]):  # the latest time of each child
        deeper = found.where(F.col("depth") > level + 1) if level + 1 >= base else found
        child = deeper.groupBy("key", F.shiftright("t", narrow).alias("child")).agg(F.max("t").alias("at"))
        out = out.unionByName(child.select("key", _cell(level, F.col("at"), widths[level]).alias("cell"), F.shiftleft(F.col("child") + 1, narrow).alias("since"), "at"))
    whole = found.groupBy("key", F.shiftright("t", widths[0]).alias("child")).agg(F.max("t").alias("at"))
    return out.unionByName(whole.select("key", _cell(0, F.shiftleft(F.col("child") + 1, widths[0]), widths[0]).alias("cell"), F.lit(None).cast("long").alias("since"), "at"))


def as_of(left: DataFrame, right: DataFrame, left_id: str, key: str, left_at: str, right_at: str, prefer: list[str], back: int) -> DataFrame:
    """One row for each distinct ``left_id``: id, key, t, found (t, best, n) of the latest row at or before t and at most
    ``back`` earlier, in whole numbers of one unit.

    Of the rows at the latest time ``best`` holds the columns ``prefer`` of the one that comes first by them, larger
    before smaller, null last, and n their number.  Without such rows ``found`` is null; so it is for a null key or time.
    Repeated rows on the left count once; if they differ, the largest (key, t) counts.  A null id is an id like others.
    Repeated rows on the right are rows of their own.  Empty tables give no rows, or no matches.  Other columns are not
    read, so their names do not matter.  Times may be negative; they and the tolerance are under 2 ** 52."""
    scratch = Scratch(left.sparkSession, "as_of")
    rows = left.groupBy(F.col(left_id).alias("id")).agg(F.max(F.struct(F.col(key).alias("key"), F.col(left_at).alias("t"))).alias("at"))
    rows = scratch.save(rows.select("id", "at.key", "at.t"), "left")
    found = scratch.save(times(right, key, right_at, prefer), "times")
    spark, kind = left.sparkSession, dict(rows.dtypes)["key"]
    widths, base, depth = trees(found, back)
    deep = F.broadcast(spark.createDataFrame([*depth.items()], f"key {kind}, depth int")) if depth else None

    def deepened(df: DataFrame) -> DataFrame:
        return df.join(deep, "key", "left").fillna(base, ["depth"]) if deep is not None else df.withColumn("depth", F.lit(base))

    asking = deepened(rows.where("key is not null and t is not null"))
    cells = F.slice(F.array(*[_cell(k, F.col("t"), w) for k, w in enumerate(widths)]), F.lit(1), F.col("depth"))
    ask = asking.select("id", "key", F.col("t").alias("asked"), F.explode(cells).alias("cell"))
    offer = offers(deepened(found.select("key", "t")), widths, base)
    limit = ask.count() // HOT
    hot = ask.groupBy("key", "cell").count().where(F.col("count") > limit).collect() if limit else []
    if hot:
        hot = F.broadcast(spark.createDataFrame([(r["key"], r["cell"], min(SALTS, r["count"] // limit + 1)) for r in hot], f"key {kind}, cell long, parts int"))
        parts = F.coalesce("parts", F.lit(1))
        ask = ask.join(hot, ["key", "cell"], "left").withColumn("cell", F.col("cell") + F.pmod(F.xxhash64("id", "asked"), parts)).drop("parts")
        offer = offer.join(hot, ["key", "cell"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1))).withColumn("cell", F.col("cell") + F.col("salt")).drop("parts", "salt")
    near = ask.join(offer, ["key", "cell"]).where((F.col("since").isNull() | (F.col("since") <= F.col("asked"))) & (F.col("at") >= F.col("asked") - back))
    latest = near.groupBy(F.col("id").alias("_rl_id")).agg(F.max("at").alias("at"))
    matched = rows.join(latest, F.col("id").eqNullSafe(F.col("_rl_id")), "left").drop("_rl_id")
    value = found.select("key", F.col("t").alias("at"), F.struct("t", "best", "n").alias("found"))
    return matched.join(value, ["key", "at"], "left").select("id", "key", "t", "found")
