"""First, best and latest rows, and what a group shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_per_key(df: DataFrame, keys: list, order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key in a total order; Spark prunes groups before and after its shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rl_rank", F.row_number().over(w)).where(F.col("_rl_rank") <= n).drop("_rl_rank")


def current_best(claims: DataFrame, keys: list, score: str, verified: str, tie: str, superseded: str | None = None) -> DataFrame:
    """The best live claim of each key: highest score, then latest verified with nulls last, then smallest tie column."""
    live = claims.where(F.col(superseded).isNull()) if superseded else claims
    return top_per_key(live, keys, [F.desc(score), F.desc_nulls_last(verified), F.asc(tie)])


def not_seen(df: DataFrame, seen: DataFrame, key: Column, seen_key: Column) -> DataFrame:
    """Rows whose key the other table lacks; a null key counts as unseen."""
    known = seen.select(seen_key.alias("_rl_key")).distinct()
    return df.join(known, key == F.col("_rl_key"), "left_anti")


def share(df: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of each group and their percentage of all rows."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n").alias("_rl_all"))
    return counted.join(F.broadcast(total)).select(*keys, "n", F.round(100.0 * F.col("n") / F.col("_rl_all"), 4).alias("pct"))


def shared_by(df: DataFrame, value: str, least: int, tag: str) -> DataFrame:
    """``df`` with a tag that says whether a value occurs at least ``least`` times; null values never do."""
    many = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_rl_n")).where(F.col("_rl_n") >= least).select(value, F.lit(True).alias(tag))
    return df.join(many, value, "left").withColumn(tag, F.coalesce(tag, F.lit(False)))


def collapse(df: DataFrame, key: str, position: str, firsts: list[str], lists: list[str]) -> DataFrame:
    """One row per key: first values by position, and ordered lists of distinct non-empty values."""
    first = [F.min_by(c, position).alias(c) for c in firsts]
    ordered = lambda c: F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(c).cast("string").alias("v"))))
    distinct = [F.array_distinct(F.filter(F.transform(ordered(c), lambda s: s["v"]), lambda v: F.trim(v) != "")).alias(c) for c in lists]
    return df.groupBy(key).agg(*first, *distinct)


def overwrite_from(left: DataFrame, right: DataFrame, key: str, columns: list[str], how: str = "left") -> DataFrame:
    """Left rows, with the right row's columns where there is one, even if they are empty; the first by position if the
    right side repeats a key is up to the caller.  ``how`` "full" keeps right-only rows as well."""
    r = right.select(F.col(key).alias("_rl_key"), F.lit(True).alias("_rl_hit"), *[F.col(c).alias(f"_rl_{c}") for c in columns])
    joined = left.join(r, left[key] == r["_rl_key"], "full_outer" if how == "full" else "left")
    own = [c for c in left.columns if c != key]
    out = [F.coalesce(left[key], r["_rl_key"]).alias(key)]
    for c in own:
        out.append(F.when(F.col("_rl_hit"), F.col(f"_rl_{c}")).otherwise(left[c]).alias(c) if c in columns else left[c])
    return joined.select(*out, *[F.col(f"_rl_{c}").alias(c) for c in columns if c not in own])


def ambiguous(df: DataFrame, key: str, rank: Column, score: str, value: str, within: float = 1.0) -> DataFrame:
    """Best row per key with a flag: more than one distinct value of the best rank scores within ``within`` of the best."""
    ranked = df.withColumn("_rl_rank", rank)
    best = ranked.groupBy(key).agg(F.max(F.struct("_rl_rank", score)).alias("_rl_best"))
    close = ranked.join(best, key).where((F.col("_rl_rank") == F.col("_rl_best._rl_rank")) & (F.col(score) >= F.col(f"_rl_best.{score}") - within))
    return close.groupBy(key).agg(F.max(score).alias("best"), F.countDistinct(value).alias("candidates"), F.min_by(value, F.struct(-F.col(score), value)).alias("value")).withColumn("ambiguous", F.col("candidates") > 1)


def host_limited(df: DataFrame, key: str, url: str, position: str, skip: list[str], n: int) -> DataFrame:
    """The first hit of each host of a key, hosts in the skip list left out, and of those the first n."""
    hosted = df.withColumn("host", F.try_parse_url(F.col(url), F.lit("HOST"))).where(F.col("host").isNotNull() & ~F.col("host").isin(skip))
    return top_per_key(top_per_key(hosted, [key, "host"], [F.asc(position)]), [key], [F.asc(position)], n)
