"""Merging sources by precedence, reviewing, and reporting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import agrees, has_value, text


def by_precedence(*values: Column) -> Column:
    """The first value that is not blank, or an empty string."""
    return F.coalesce(*[F.when(has_value(v), v) for v in values], F.lit(""))


def review_reason(reasons: list[tuple[Column, str]]) -> Column:
    """The first reason that holds, or null."""
    out = F
    for holds, why in reasons:
        out = out.when(holds, why)
    return out


def clean_view(df: DataFrame, email: str, phone: str, suggested: str) -> DataFrame:
    """Quality flags of both contacts: OK, the issue, or FALTA if there is none."""
    flag = lambda c, issue: F.when(~has_value(c), "FALTA").when(issue, "REVISAR").otherwise("OK")
    return df.withColumn("email_quality", flag(email, text(suggested) != "")).withColumn("phone_quality", flag(phone, ~text(phone).rlike(r"^\+\d{8,15}$")))


def clean_rows(df: DataFrame) -> DataFrame:
    """The delivered columns of normalised records.

    Needs category, category_raw, full_name, family_name_1, family_name_2, given_name, email, suggested_domain, email_issue,
    phone, phone_type, phone_issue, assigned, comment and restored; missing text counts as empty.  The quality of a contact
    is OK, else its issue, else FALTA."""
    say = lambda c: text(F.col(c))
    category = F.upper(by_precedence(F.col("category"), F.col("category_raw")))
    suggested = F.when(has_value("email") & has_value("suggested_domain"), F.concat(F.substring_index("email", "@", 1), F.lit("@"), say("suggested_domain"))).otherwise("")
    plain = [say(c).alias(c) for c in ("full_name", "family_name_1", "family_name_2", "given_name", "email")]
    email = F.when(has_value("email") & ~has_value("email_issue"), "OK").otherwise(by_precedence(F.col("email_issue"), F.lit("FALTA")))
    phone = F.when(has_value("phone"), "OK").otherwise(by_precedence(F.col("phone_issue"), F.lit("FALTA")))
    rest = [say(c).alias(c) for c in ("phone", "phone_type", "assigned", "comment")]
    return df.select(category.alias("category"), *plain, suggested.alias("suggested_email"), *rest, email.alias("email_quality"), phone.alias("phone_quality"), "restored")


def rates(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """(stage, n, total, rate) rows: how many rows meet each condition; a rate of 0 for an empty table."""
    one = df.agg(F.count(F.lit(1)).alias("_rl_all"), *[F.count_if(c).alias(n) for n, c in conditions.items()])
    rows = F.inline(F.array(*[F.struct(F.lit(n).alias("stage"), F.col(n).alias("n"), F.col("_rl_all").alias("total"), F.round(F.coalesce(F.try_divide(n, "_rl_all"), F.lit(0.0)), 4).alias("rate")) for n in conditions]))
    return one.select(rows)


def issues(df: DataFrame) -> DataFrame:
    return df.where((F.col("email_quality") != "OK") | (F.col("phone_quality") != "OK"))


def counts(df: DataFrame, groups: list[str], conditions: dict[str, Column]) -> DataFrame:
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("rows_total"), *[F.count_if(c).alias(n) for n, c in conditions.items()])


def as_rows(df: DataFrame, names: list[str]) -> DataFrame:
    """(metric, value) rows of a one-row table."""
    return df.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])))


def goal_gap(df: DataFrame, groups: list[str], goal: int) -> DataFrame:
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).withColumn("gap", F.greatest(F.lit(goal) - F.col("n"), F.lit(0)))


def value_counts(df: DataFrame, groups: list[str], value: str, name: str) -> DataFrame:
    """(groups, name): how often each value stands in a group, as "value: count, ..." with the most frequent first; of equals the
    first in order of letters; null as nothing."""
    n = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_rl_n"))
    listed = F.sort_array(F.collect_list(F.struct(-F.col("_rl_n"), F.col(value).alias("v"))))
    return n.groupBy(*groups).agg(F.array_join(F.transform(listed, lambda x: F.concat(x["v"], F.lit(": "), (-x["col1"]).cast("string"))), ", ").alias(name))


def group_report(df: DataFrame, groups: list[str], counts: dict[str, Column], listed: dict[str, str], goal: int) -> DataFrame:
    """A row a group: its rows, those for which each condition holds, the goal and what is missing to it, and for each column of
    ``listed`` (name: column) how often each of its values stands there, empty if none does."""
    some = [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counts.items()]
    out = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), *some).withColumn("goal", F.lit(goal)).withColumn("gap", F.greatest(F.lit(goal) - F.col("n"), F.lit(0)))
    for name, column in listed.items():
        found = value_counts(df, groups, column, name).withColumnsRenamed({g: f"_rl_{g}" for g in groups})
        same = [F.col(g).eqNullSafe(F.col(f"_rl_{g}")) for g in groups]
        out = out.join(found, same, "left").drop(*[f"_rl_{g}" for g in groups]).fillna("", [name])
    return out


def verification_report(inputs: DataFrame, matches: DataFrame, key: str, least: float = 0.75) -> DataFrame:
    """Every input (key, name, category) with its match (key, canonical, categories as an array, score, path, oid), as the ten columns
    of a report.  Categories agree, or not, or it is an empty string: without a match, or without a category on either side."""
    j = inputs.join(matches, key, "left")
    none, agree = F.col("oid").isNull(), agrees(F.col("category"), F.col("categories"))
    said = F.when(none | (text("category") == ""), "").otherwise(F.coalesce(agree.cast("string"), F.lit("")))
    return j.select(key, "name", text("category").alias("category"), (~none).alias("matched"), text("canonical").alias("canonical_name"), F.coalesce(F.array_join("categories", ", "), F.lit("")).alias("canonical_categories"), said.alias("category_agrees"),
                    F.round(F.coalesce("score", F.lit(0.0)), 3).alias("score"), text("path").alias("profile_url"), text(F.col("oid").cast("string")).alias("oid"), F.when(none, f"no match of {least} or more").otherwise("").alias("notes"))


def stacked(*tables: DataFrame) -> DataFrame:
    """All rows, columns aligned by name; missing ones are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
