"""Row rules: which records count as persons, profiles or matches, and how sure a match is."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip_accents, text

#: The labels of a match and their ranks, and from which ratios they hold.
LABELS = {"alta": 3, "media": 2, "baja": 1}
SURE, LIKELY = 93, 90


def without_placeholder(email: Column, marks: tuple[str, ...]) -> Column:
    """The address, or an empty string if it holds one of ``marks``, letter case aside."""
    low = F.lower(text(email))
    return F.when(F.exists(F.array(*map(F.lit, marks)), lambda m: low.contains(m)), "").otherwise(text(email))


def is_person(name: Column, places: tuple[str, ...]) -> Column:
    """Two words or more, and none of the words that tell an establishment; accents and letter case aside."""
    words = F.split(F.trim(F.upper(strip_accents(text(name)))), r"\s+")
    return (F.size(words) >= 2) & ~F.arrays_overlap(words, F.array(*map(F.lit, places)))


def is_profile(url: Column, start: str) -> Column:
    """Whether the url's path starts with ``start`` and holds two slashes or more."""
    path = F.regexp_extract(text(url), r"^[^:]+://[^/?#]*([^?#]*)", 1)
    return path.startswith(start) & (F.length(path) - F.length(F.replace(path, F.lit("/"))) >= 2)


def on_domain(url: Column, part: str) -> Column:
    return F.lower(text(url)).contains(part.lower())


def address_case(well_formed: Column, has_mail_host: Column, accepted: Column) -> Column:
    """invalid_format, no_mx, verified, rejected or unverified, the first that holds; ``accepted`` is null if nothing was asked."""
    return F.when(~well_formed, "invalid_format").when(~has_mail_host, "no_mx").when(accepted, "verified").when(~accepted, "rejected").otherwise("unverified")


def match_label(words: Column, other: Column, alike: Column, same_place: Column) -> Column:
    """How sure it is that two names are one, from their word sets, their ratio (0 to 100) and whether the places agree."""
    shared, held = F.size(F.array_intersect(words, other)), F.size(F.array_except(words, other)) == 0
    high = (held & ((shared >= 3) | ((shared >= 2) & same_place))) | ((alike >= SURE) & (shared >= 3) & same_place)
    medium = (alike >= SURE) & ((shared >= 3) | ((shared >= 2) & same_place))
    low = (alike >= LIKELY) & (shared >= 2)
    return F.when((F.size(words) < 2) | (F.size(other) < 2), "descartado").when(high, "alta").when(medium, "media").when(low, "baja").otherwise("descartado")


def label_rank(label: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair]), label), F.lit(0))


def overlap(a: Column, b: Column) -> Column:
    return F.when(F.arrays_overlap(a, b), 1.0).otherwise(0.0)


def first_pattern(title: Column, patterns: list[tuple[str, str]]) -> Column:
    """The value of the first pattern, in the list's order, that is found in the title, accents and letter case aside; or null."""
    up, out = F.upper(strip_accents(text(title))), F
    for pattern, value in patterns:
        out = out.when(up.rlike(pattern), value)
    return out


def place_suffix(place: Column, names: list[str]) -> Column:
    """The first of ``names`` that the text ends with as whole words, accents and letter case aside; or null."""
    up, out = F.concat(F.lit(" "), F.trim(F.upper(strip_accents(text(place))))), F
    for name in names:
        out = out.when(up.endswith(F.concat(F.lit(" "), F.upper(strip_accents(F.lit(name))))), name)
    return out


def province(region: Column, city: Column, provinces: dict[str, list[str]], searched: Column, trusts_search: Column) -> Column:
    """The province of a record: its region, its city's province, its city if that is the name of one, or, where there is no
    city and the source is trusted, the one that was searched for; null otherwise.  Provinces with their cities are a
    short fixed list; a city named twice belongs to the last."""
    plain = lambda c: F.upper(strip_accents(text(c)))
    named = F.create_map(*[x for p in provinces for x in (plain(F.lit(p)), F.lit(p))])
    cities = {c: p for p, all_of in provinces.items() for c in all_of}
    held = F.create_map(*[x for c, p in cities.items() for x in (plain(F.lit(c)), F.lit(p))])
    town = F.trim(plain(city))
    return F.coalesce(F.try_element_at(named, plain(region)), F.try_element_at(held, town), F.try_element_at(named, town), F.when((town == "") & trusts_search, searched))
