"""Confidence, pair and proximity scores as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip_accents, text

# Log-odds of signals, coefficients of pair features, and parts of addresses of pages by tier.
SIGNALS = {
    "source_tier_1": 1.6, "source_tier_2": 0.6, "source_tier_3": 0.1, "agreement_2_sources": 0.9, "agreement_3plus_sources": 1.5,
    "single_source": -0.3, "mx_ok": 0.6, "catch_all_domain": -0.4, "external_validator_pass": 1.3, "external_validator_fail": -2.0,
    "phonenumbers_valid": 0.7, "phone_region_match": 0.3, "phone_type_mobile": 0.2, "email_domain_matches_affiliation": 1.0,
    "phone_matches_known_clinic_phone": -0.5, "verified_within_180d": 0.4, "verified_within_365d": 0.1, "stale_over_2y": -0.6,
    "is_inferred_from_pattern": -0.7, "is_inferred_from_specialty_signal": -0.5, "is_inferred_from_clinic_central": -0.4,
    "contradicted_by_tier1": -2.5, "contradicted_by_tier2": -1.0,
}
COEFFICIENTS = {
    "name_token_sort": 2.1, "name_token_set": 1.1, "name_embed_cos": 2.8, "specialty_match": 1.5, "city_match": 1.0,
    "edu_overlap": 1.2, "affil_overlap": 1.4, "phone_overlap": 4.0, "email_overlap": 5.0,
}
BIAS, PRIOR = -3.5, 0.30
OFFICIAL = ("msp.gob", "ministeriodesalud", "colegiomedico", "consejotecnicodesalud", "medicos.cr", ".gov", ".gob")
SOCIAL = ("facebook.com", "linkedin.com", "twitter.com", "instagram.com")


def logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(0.9999)), F.lit(0.0001))
    return F.ln(p / (1 - p))


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def confidence(signals: Column, prior: Column) -> Column:
    """Probability of a claim: the prior's log-odds plus those of its distinct known signals."""
    weights = F.create_map(*[F.lit(x) for kv in SIGNALS.items() for x in kv])
    known = F.array_sort(F.array_distinct(signals))
    return sigmoid(F.aggregate(known, logit(prior), lambda z, s: z + F.coalesce(F.try_element_at(weights, s), F.lit(0.0))))


def evidence(signals: Column, prior: Column) -> Column:
    """The claim's evidence: prior, the weight of each known signal, and the score."""
    weights = F.create_map(*[F.lit(x) for kv in SIGNALS.items() for x in kv])
    known = F.filter(F.array_distinct(signals), lambda s: F.map_contains_key(weights, s))
    return F.struct(prior.alias("prior"), F.map_from_arrays(known, F.transform(known, lambda s: F.try_element_at(weights, s))).alias("signals"), F.round(confidence(signals, prior), 4).alias("score"))


def bucket(p: Column, high: float = 0.85, middle: float = 0.55) -> Column:
    return F.when(p >= high, "auto_publish").when(p >= middle, "human_review").otherwise("hypothesis")


def tier(url: Column, official: tuple[str, ...] = OFFICIAL, social: tuple[str, ...] = SOCIAL) -> Column:
    low = F.lower(text(url))
    has = lambda parts: F.exists(F.array(*[F.lit(p) for p in parts]), lambda p: low.contains(p))
    return F.when(has(official), 1).when(has(social), 3).otherwise(2)


def pair_probability(features: dict[str, Column], coefficients: dict[str, float] | None = None) -> Column:
    """Logistic score of the features that are there; the others are left out.  Other coefficients come with their own "bias"."""
    by = coefficients or COEFFICIENTS | {"bias": BIAS}
    z = F.lit(by["bias"])
    for k, v in features.items():
        z = z + F.coalesce(v, F.lit(0.0)) * by[k]
    return sigmoid(z)


def jaccard(a: Column, b: Column) -> Column:
    """0 for two empty sets."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) == 0


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + 1e-9)


def _significant(words: Column) -> Column:
    return F.transform(F.filter(words, lambda t: F.length(t) >= 4), lambda t: F.lower(strip_accents(t)))


def name_present(body: Column, words: Column) -> Column:
    low = F.lower(strip_accents(body))
    return F.exists(_significant(words), lambda t: low.contains(t))


def proximity(body: Column, target: Column, words: Column) -> Column:
    """0.3 without words of the name; 0 if the target is absent; 0.9 with a word within 200 characters of it, 0.5 with
    one elsewhere, else 0."""
    low, names, goal = F.lower(strip_accents(body)), _significant(words), F.lower(text(target))
    at = F.position(goal, low)
    begin = F.greatest(at - 200, F.lit(1))
    window = F.substr(low, begin, at + 200 - begin)
    near, far = F.exists(names, lambda t: window.contains(t)), F.exists(names, lambda t: low.contains(t))
    return F.when(F.size(names) == 0, 0.3).when((goal != "") & (at == 0), 0.0).when((goal != "") & near, 0.9).when(far, 0.5).otherwise(0.0)


def hit_rank(url: Column, words: Column, family: Column, bad: tuple[str, ...], good: tuple[str, ...], profile: str) -> Column:
    low = F.lower(text(url))
    has = lambda parts: F.exists(F.array(*[F.lit(p) for p in parts]), lambda p: low.contains(p))
    return F.when(has(bad), -1.0).otherwise(F.when((family != "") & F.lower(strip_accents(words)).contains(family), 2.0).otherwise(0.0) + F.when(has(good), 1.0).otherwise(0.0) + F.when(low.contains(profile), 0.5).otherwise(0.0))
