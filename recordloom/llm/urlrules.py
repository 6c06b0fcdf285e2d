"""URL rules by a sort-merge range join on reversed-host keys, in DataFrame functions only.

A rule (host, path) holds for its host and all subdomains, where the url's path starts with the rule's.  A key is the
host's labels in reverse, a slash, and the path, so every url that a rule holds for has, at the level of the rule's
host, a key that starts with the rule's key: the rule is an interval of keys, and intervals are nested or apart.

A url gives one key for each of its host's upper levels, as far as rules go.  Keys and the ends of rules are sorted
together and swept: an opening pushes its rule, an end pops it.  The stack is kept by depth: a running sum of openings
less ends is the depth, and the rule on top at a key is the last one that was opened at that depth.  The sorted keys are
dealt to blocks by range, with a salt, so a host with very many urls is split; each block hands its depth, and its last
opening at each depth, on to the blocks after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .scratch import Scratch, partitions

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OPEN, _URL, _END = 0, 1, 2


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(rule, verdict) rows of a short list; longer lists come as a table."""
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for r, v in rules])))


def _host_and_path() -> tuple[Column, Column]:
    """Of ``_rl_url``.  Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#``
    or the end.  Both are empty for a null url or one without ``://``."""
    at = F.locate("://", F.coalesce("_rl_url", F.lit("")))
    rest = F.when(at > 0, F.expr("substring(_rl_url, locate('://', _rl_url) + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _key(host: Column, path: Column, level: Column | None = None) -> Column:
    labels = F.reverse(F.split(host, "\\."))
    labels = labels if level is None else F.slice(labels, F.lit(1), level)
    return F.concat(F.array_join(labels, "."), F.lit("/"), path)


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``pages``: the longest rule that holds, else null and ``default``.

    ``rules`` has rule (host, then path from its first slash on) and verdict ("allow" or "block").  A rule given twice
    counts once, and blocks if either blocks.  A null url, or one without ``://``, has an empty host and path, which no
    rule holds for.  A null id is kept, repeated rows stay repeated, an empty table gives no rows, no rules give the
    default throughout.  Other columns are not read.
    """
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession, "urlrules")
    slash = F.locate("/", "rule")
    rules = rules.where(F.col("rule").isNotNull()).select("rule", "verdict", F.when(slash > 0, F.expr("substring(rule, 1, locate('/', rule) - 1)")).otherwise(F.col("rule")).alias("h"), F.when(slash > 0, F.expr("substring(rule, locate('/', rule))")).otherwise("").alias("p"))
    rules = rules.withColumn("k", _key(F.col("h"), F.col("p")).cast("binary")).groupBy("k").agg(F.max("verdict").alias("verdict"), F.min("rule").alias("rule"), F.max(F.size(F.split("h", "\\."))).alias("labels"), F.max(F.length("p")).alias("chars"))
    rules = scratch.save(rules, "rules")
    limits = rules.agg(F.coalesce(F.max("labels"), F.lit(1)), F.coalesce(F.max("chars"), F.lit(0))).first()
    levels, chars = max(1, limits[0]), max(0, limits[1])

    keyed = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("_rl_url"))
    host, path = _host_and_path()
    keyed = keyed.select("id", host.alias("host"), path.alias("path"))
    depth_of_host = F.least(F.size(F.split("host", "\\.")), F.lit(levels))
    urls = keyed.withColumn("level", F.explode(F.sequence(F.lit(1), depth_of_host)))
    urls = urls.withColumn("k", _key(F.col("host"), F.substring("path", 1, chars) if chars else F.lit(""), F.col("level")).cast("binary"))
    nothing = F.lit(None)
    urls = urls.select("k", F.lit(_URL).alias("kind"), "id", "host", "path", "level", nothing.cast("string").alias("rule"), nothing.cast("string").alias("verdict"))
    id_type = keyed.schema["id"].dataType
    bound = [nothing.cast(id_type).alias("id"), nothing.cast("string").alias("host"), nothing.cast("string").alias("path"), nothing.cast("int").alias("level"), "rule", "verdict"]
    opened = rules.select("k", F.lit(_OPEN).alias("kind"), *bound)
    ended = rules.select(F.concat("k", F.lit(b"\xff")).alias("k"), F.lit(_END).alias("kind"), *bound)  # no text holds this byte
    order = ["k", "kind", "salt"]
    events = urls.unionByName(opened).unionByName(ended).withColumn("salt", F.xxhash64("id", "path", "level"))
    events = events.repartitionByRange(partitions(spark), *order).withColumn("block", F.spark_partition_id())
    events = scratch.save(events, "events")  # blocks are fixed from here on

    step = F.when(F.col("kind") == _OPEN, 1).when(F.col("kind") == _END, -1).otherwise(0)
    so_far = Window.partitionBy("block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # over as many rows as there are blocks
    totals = events.groupBy("block").agg(F.sum(step).alias("step"))
    carried = totals.select("block", F.coalesce(F.sum("step").over(earlier), F.lit(0)).alias("before"))
    swept = events.withColumn("inside", F.sum(step).over(so_far)).join(F.broadcast(carried), "block")
    swept = swept.withColumn("depth", (F.col("inside") + F.col("before")).cast("int"))
    opening = F.when(F.col("kind") == _OPEN, F.struct("rule", "verdict"))
    swept = scratch.save(swept.select("block", "depth", *order, "id", "host", "path", "level", opening.alias("opening")), "swept")
    at_depth = Window.partitionBy("block", "depth").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    lasts = swept.where(F.col("opening").isNotNull()).groupBy("block", "depth").agg(F.max_by("opening", "k").alias("opening"))
    deepest = swept.agg(F.max("depth")).first()[0] or 1
    spread = carried.select("block", F.explode(F.sequence(F.lit(1), F.lit(deepest))).alias("depth")).join(lasts, ["block", "depth"], "left")
    handed = spread.select("block", "depth", F.last("opening", True).over(Window.partitionBy("depth").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("handed"))
    handed = scratch.save(handed, "handed")
    topped = swept.withColumn("top", F.last("opening", True).over(at_depth)).where(F.col("kind") == _URL)
    topped = topped.join(handed, ["block", "depth"], "left").withColumn("top", F.when(F.col("depth") > 0, F.coalesce("top", "handed")))
    best = F.max(F.when(F.col("top").isNotNull(), F.struct(F.length("top.rule").alias("n"), F.col("top.rule").alias("rule"), F.col("top.verdict").alias("verdict")))).alias("best")
    judged = topped.groupBy("id", "host", "path").agg(best, F.count_if(F.col("level") == 1).alias("times"))
    judged = judged.select("id", "host", "path", "best", "times").where("times = 1").drop("times").unionByName(
        judged.where("times > 1").select("id", "host", "path", "best", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("t")).drop("t"))
    return judged.select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
