"""Claims of contacts from profiles and pages, the best of them, and what they add to records.

Which signals and priors a claim has, and the names of its kinds, are fixed values that scores depend on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import contacts, scores
from ..functions.text import has_value, text
from .ranking import top_per_key


def country_by_suffix(url: Column, site: str, countries: dict[str, str], default: str) -> Column:
    """The country that stands for what follows ``site`` and a dot in the url, up to the next slash."""
    suffix = F.regexp_extract(text(url), rf"{site}\.([^/?#]+)", 1)
    known = F.create_map(*[F.lit(x) for pair in countries.items() for x in pair])
    return F.coalesce(F.try_element_at(known, suffix), F.lit(default))


def phone_in(raw: Column, country: Column) -> Column:
    """phone_parts by the row's own country; null for countries without a numbering plan."""
    return F.coalesce(*[F.when(country == c, contacts.phone_parts(raw, c)) for c in contacts.NUMBERING])


def _claim(attribute: str, value: Column, subkind: Column, signals: Column, prior: Column) -> Column:
    return F.struct(F.lit(attribute).alias("attribute"), value.alias("value"), subkind.alias("subkind"), F.round(scores.confidence(F.array_compact(signals), prior), 4).alias("confidence"))


def profile_claims(df: DataFrame, keep: list[str], phones: str, emails: str, country: Column) -> DataFrame:
    """One claim per valid phone and address of a profile: ``keep``, attribute, value, subkind, confidence.

    ``phones`` and ``emails`` are arrays of strings, null counts as empty; the prior is 0.40."""
    prior = F.lit(0.40)
    split = df.select(*keep, country.alias("_rl_country"), F.col(phones).alias("_rl_p"), F.col(emails).alias("_rl_e"))

    def of_phone(raw: Column) -> Column:
        p = phone_in(raw, F.col("_rl_country"))
        signals = F.array(F.lit("source_tier_2"), F.lit("phonenumbers_valid"), F.lit("single_source"), F.when(p["line_type"] == "mobile", "phone_type_mobile"))
        return F.when(p.isNotNull(), _claim("phone", p["e164"], F.lit("clinic_main"), signals, prior))

    def of_email(raw: Column) -> Column:
        e = contacts.email_parts(raw)
        free = e["is_freemail"]
        signals = F.array(F.lit("source_tier_2"), F.when(free, "single_source").otherwise("mx_ok"))
        return F.when(e.isNotNull(), _claim("email", e["address"], F.when(free, "personal").otherwise("clinic"), signals, prior))

    return _claims(split, keep, F.transform("_rl_p", of_phone), F.transform("_rl_e", of_email))


def page_claims(df: DataFrame, keep: list[str], url: str, phones: str, emails: str, country: Column | None = None, skip: tuple[str, ...] = ()) -> DataFrame:
    """Claims of a page found by search; ``phones`` and ``emails`` are arrays of struct(value, proximity).

    The url's tier is a signal and proximity raises the prior.  Without a country phones are taken as they are, of no known
    kind; with one they are normalised, and those not valid there go.  Addresses that hold a part in ``skip`` go."""
    split = df.select(*keep, F.concat(F.lit("source_tier_"), scores.tier(F.col(url)).cast("string")).alias("_rl_tier"), (F.lit(None).cast("string") if country is None else country).alias("_rl_country"), F.col(phones).alias("_rl_p"), F.col(emails).alias("_rl_e"))
    tier, prior = F.col("_rl_tier"), lambda near: F.lit(0.20) + F.lit(0.30) * near

    def of_phone(x: Column) -> Column:
        signals = F.array(tier, F.lit("phonenumbers_valid"), F.lit("single_source"))
        if country is None:
            return _claim("phone", x["value"], F.lit("unknown"), signals, prior(x["proximity"]))
        p = phone_in(x["value"], F.col("_rl_country"))
        return F.when(p.isNotNull(), _claim("phone", p["e164"], F.coalesce(p["line_type"], F.lit("unknown")), signals, prior(x["proximity"])))

    def of_email(x: Column) -> Column:
        e = contacts.email_parts(x["value"])
        free, wanted = e["is_freemail"], e.isNotNull()
        for part in skip:
            wanted = wanted & ~F.lower(x["value"]).contains(part)
        signals = F.array(tier, F.lit("single_source"), F.when(x["proximity"] >= 0.85, F.when(free, "verified_within_180d").otherwise("mx_ok")))
        return F.when(wanted, _claim("email", e["address"], F.when(free, "personal").otherwise("clinic"), signals, prior(x["proximity"])))

    return _claims(split, keep, F.transform("_rl_p", of_phone), F.transform("_rl_e", of_email))


def _claims(df: DataFrame, keep: list[str], phones: Column, emails: Column) -> DataFrame:
    none = F.expr("cast(array() as array<struct<attribute:string,value:string,subkind:string,confidence:double>>)")
    both = F.concat(F.coalesce(phones, none), F.coalesce(emails, none))
    return df.select(*keep, F.explode(F.array_compact(both)).alias("_rl_claim")).select(*keep, "_rl_claim.*")


def best_claims(claims: DataFrame, name: str, position: str) -> DataFrame:
    """The surest claim of each name and attribute; of equals the first by position."""
    return top_per_key(claims, [name, "attribute"], [F.desc("confidence"), F.asc(position)])


def name_as_key(first_surname, second_surname, given) -> Column:
    """Surnames and given names in upper case, the second surname only if there is one."""
    a, b, g = (F.trim(text(c)) for c in (first_surname, second_surname, given))
    return F.upper(F.concat_ws(" ", a, F.when(b != "", b), g))


def with_best_claims(records: DataFrame, key: Column, best: DataFrame, name: str, attributes: tuple[str, ...] = ("phone", "email")) -> DataFrame:
    """Records with the value and confidence of the best claim of each attribute: an empty string and null without one."""
    wide = best.groupBy(F.col(name).alias("_rl_name")).agg(*[F.max(F.when(F.col("attribute") == a, F.struct("value", "confidence"))).alias(f"_rl_{a}") for a in attributes])
    joined = records.join(wide, key == F.col("_rl_name"), "left")
    found = [c for a in attributes for c in (text(F.col(f"_rl_{a}.value")).alias(f"found_{a}"), F.round(F.col(f"_rl_{a}.confidence"), 3).alias(f"found_{a}_confidence"))]
    return joined.select(*records.columns, *found)


def candidates(df: DataFrame, first_surname: str, second_surname: str, given: str, category: str, priority: tuple[str, ...]) -> DataFrame:
    """Records that can be searched for, with full_raw, category_low and priority (0 for the categories named, else 1);
    those without a surname or given name go.  Order by priority and surname."""
    a, b, g = (F.trim(text(c)) for c in (first_surname, second_surname, given))
    named = df.where(has_value(first_surname) & has_value(given))
    low = F.lower(F.trim(text(category)))
    return named.select("*", F.concat_ws(" ", a, F.when(b != "", b), g).alias("full_raw"), low.alias("category_low"), F.when(low.isin(*priority), 0).otherwise(1).alias("priority"))
