"""Emails, phones and category names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .ratio import nearest
from .text import strip_accents, text, transliterate

# Domains, patterns with their priors, and words that mark what is no address.
FREEMAIL = ("gmail.com", "googlemail.com", "yahoo.com", "yahoo.es", "hotmail.com", "outlook.com", "live.com", "icloud.com", "me.com", "protonmail.com")
KNOWN_DOMAINS = ("clinicabiblica.com", "ccss.sa.cr", "ucr.ac.cr", "coopesain.sa.cr", "pediaclinic.cr")
PATTERNS = (
    ("{first}.{last}", 0.34), ("{f}{last}", 0.18), ("{first}{last}", 0.12), ("{first}_{last}", 0.06), ("{first}.{last2}", 0.05),
    ("{last}.{first}", 0.05), ("{f}.{last}", 0.04), ("{first}.{m}.{last}", 0.03), ("{first}", 0.03), ("{last}", 0.03),
    ("dr.{last}", 0.02), ("dr{last}", 0.02), ("{first}-{last}", 0.02), ("info", 0.01), ("contacto", 0.01),
)
NOT_ADDRESSES = (".png", ".jpg", ".jpeg", ".svg", ".gif", ".webp", "sentry.io", "wixpress.com", "@2x.", "@3x.")
# country: calling code, length of the national number, first digits of mobile and of fixed lines
NUMBERING = {"CR": ("506", 8, "[5-8]", "[24]"), "PA": ("507", 8, "6", "[1-57-9]"), "CO": ("57", 10, "3", "60[1-8]"), "EC": ("593", 9, "9", "[2-7]")}

#: An address: RFC 5322's dot-atom, then dotted labels.
ADDRESS = r"^[a-z0-9!#$%&'*+/=?^_`{|}~-]+(\.[a-z0-9!#$%&'*+/=?^_`{|}~-]+)*@([a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?\.)+[a-z]{2,63}$"
#: What passes for an address in running text: a fixed pattern.
IN_TEXT = r"(?i)(?<![A-Z0-9_.+-])([A-Z0-9_.+-]+@[A-Z0-9-]+\.[A-Z0-9.-]+)(?![A-Z0-9_.+-])"


def email_parts(c) -> Column:
    """struct(address, local, domain, is_freemail) of a cell, or null if it holds no valid address."""
    s = F.lower(F.trim(F.regexp_replace(text(c), r"(?U)\s+", ""), F.lit(".,;")))
    s = F.trim(F.trim(s, F.lit('"')), F.lit("'"))
    local, domain = F.substring_index(s, "@", 1), F.substring_index(s, "@", -1)
    ok = s.rlike(ADDRESS) & (F.length(local) <= 64) & (F.length(domain) <= 253)
    return F.when(ok, F.struct(s.alias("address"), local.alias("local"), domain.alias("domain"), domain.isin(*FREEMAIL).alias("is_freemail")))


def loose_email(c) -> Column:
    return text(c).rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$")


def emails_in(c) -> Column:
    """Plausible addresses in a text or in mailto links, distinct, in order."""
    found = F.array_distinct(F.concat(F.regexp_extract_all(text(c), F.lit(IN_TEXT), 1), F.transform(F.regexp_extract_all(text(c), F.lit(r"(?i)mailto:([^\"'?>\s]+)"), 1), F.trim)))
    return F.filter(found, plausible)


def plausible(e: Column) -> Column:
    low = F.lower(e)
    out = (F.length(F.regexp_replace(low, "[^@]", "")) == 1) & (F.length(F.substring_index(low, "@", 1)) <= 64) & (F.length(F.substring_index(low, "@", -1)) <= 253) & F.substring_index(low, "@", -1).contains(".")
    for part in NOT_ADDRESSES:
        out = out & ~low.contains(part)
    return out


def hypotheses(name: Column, domain: Column) -> Column:
    """array<struct(address, pattern, prior)>: guessed addresses, likeliest first, each once; empty without a surname or domain."""
    given = F.split(F.lower(transliterate(name["given_name"])), " ")
    first, middle = F.coalesce(F.try_element_at(given, F.lit(1)), F.lit("")), F.coalesce(F.try_element_at(given, F.lit(2)), F.lit(""))
    last1 = F.lower(transliterate(name["family_name_1"]))
    slots = {"{first}": first, "{f}": F.substring(first, 1, 1), "{m}": F.substring(middle, 1, 1), "{last}": last1, "{last2}": F.lower(transliterate(F.coalesce(name["family_name_2"], name["family_name_1"])))}
    rows = []
    for k, (pattern, prior) in enumerate(sorted(PATTERNS, key=lambda p: -p[1])):
        local: Column = F.lit(pattern)
        for slot, value in slots.items():
            local = F.replace(local, F.lit(slot), value)
        local = F.trim(F.replace(local, F.lit(".."), F.lit(".")), F.lit("."))
        rows.append(F.struct(F.lower(F.concat(local, F.lit("@"), domain)).alias("address"), F.lit(pattern).alias("pattern"), F.lit(prior).alias("prior"), F.lit(k).alias("k"), (local != "").alias("ok")))
    every = F.filter(F.array(*rows), lambda h: h["ok"])
    first_of = F.filter(every, lambda h: ~F.exists(every, lambda g: (g["address"] == h["address"]) & (g["k"] < h["k"])))
    return F.when((text(domain) != "") & (last1 != ""), F.transform(first_of, lambda h: F.struct(h["address"].alias("address"), h["pattern"].alias("pattern"), h["prior"].alias("prior")))).otherwise(F.expr("cast(array() as array<struct<address:string,pattern:string,prior:double>>)"))


def common_addresses(given, first_surname, second_surname, domain: str = "") -> Column:
    """Five guesses from plain lower-case names, in a fixed order; without a domain they stand at a placeholder.  Empty without
    a given name or first surname."""
    g, a, b = (F.lower(strip_accents(F.trim(text(c)))) for c in (given, first_surname, second_surname))
    join = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    head = [join(g, ".", a), join(g, a), join(F.substring(g, 1, 1), a)]
    if domain:
        tail = [F.when(b != "", join(g, ".", a, ".", b)).otherwise(join(g, ".", a)), F.replace(join(a, b, g), F.lit(" "))]
    else:
        tail = [join("dr.", g, ".", a), join("doctor.", g, ".", a)]
    at = F.lit(f"@{domain or 'clinic'}.com")
    none = F.expr("cast(array() as array<string>)")
    return F.when((g != "") & (a != ""), F.array(*[F.concat(x, at) for x in head + tail])).otherwise(none)


def hypothesis_signals(tier: Column, mx_ok: Column, catch_all: Column, external: Column) -> Column:
    return F.array_compact(F.array(F.lit("is_inferred_from_pattern"), F.concat(F.lit("source_tier_"), tier.cast("string")), F.when(mx_ok, "mx_ok"), F.when(catch_all, "catch_all_domain"), F.when(external >= 0.7, "external_validator_pass").when(external < 0.7, "external_validator_fail")))


def phone_parts(c, country: str) -> Column:
    """struct(e164, national, line_type) by public numbering plans, or null if the number is not valid there."""
    code, size, mobile, fixed = NUMBERING[country]
    s = F.regexp_replace(text(c), r"[^\d+]", "")
    s = F.when(s.rlike("^50[67]"), F.concat(F.lit("+"), s)).otherwise(s)
    national = F.when(s.startswith("+" + code), F.substring(s, len(code) + 2, 30)).when(~s.startswith("+"), F.regexp_replace(s, "^0", "") if country == "EC" else s)
    kind = F.when(national.rlike(f"^{mobile}"), "mobile").when(national.rlike(f"^{fixed}"), "landline")
    ok = national.rlike(rf"^\d{{{size}}}$") & kind.isNotNull() if country != "EC" else (national.rlike(r"^9\d{8}$") | national.rlike(r"^[2-7]\d{7}$"))
    return F.when(ok, F.struct(F.concat(F.lit("+" + code), national).alias("e164"), national.alias("national"), kind.alias("line_type")))


def phone_or_raw(c, country: str) -> Column:
    """A valid number in international form, its area or network code apart; what is no valid number as it is."""
    p = phone_parts(c, country)
    n = p["national"]
    return F.coalesce(F.concat(F.lit(f"+{NUMBERING[country][0]} "), F.substr(n, F.lit(1), F.length(n) - 7), F.lit(" "), F.substr(n, F.length(n) - 6, F.lit(7))), text(c))


def phones_in(c, country: str) -> Column:
    """Valid numbers in a text, in E.164 form, distinct, in order."""
    runs = F.regexp_extract_all(text(c), F.lit(r"(\+?\d[\d ().-]{6,18}\d)"), 1)
    return F.array_distinct(F.filter(F.transform(runs, lambda r: phone_parts(r, country)["e164"]), lambda p: p.isNotNull()))


def area_filled(c, province: Column) -> Column:
    """Seven-digit local numbers with their area code."""
    digits = F.regexp_replace(text(c), r"\D", "")
    return F.when(F.length(digits) == 7, F.concat(F.when(province.isin("Carchi", "Imbabura"), "06").otherwise("07"), digits)).otherwise(digits)


def suggested_domain(domain: Column) -> Column:
    """The known domain that a mistyped one is most like, at a weighted ratio of 85 or more; null for known ones."""
    known = FREEMAIL + KNOWN_DOMAINS
    return F.when(~domain.isin(*known), nearest([*known], 85.0)(domain))


def nearest_category(c, variants) -> Column:
    """The code of a known variant, or of the one most like it at a weighted ratio of 88 or more; null otherwise."""
    codes = F.create_map(*[F.lit(x) for code, words in variants.items() for w in words for x in (w, code)])
    key = F.upper(F.trim(strip_accents(c)))
    return F.coalesce(category_code(c, variants), F.try_element_at(codes, nearest([w for words in variants.values() for w in words], 88.0)(key)))


def category_code(c, variants) -> Column:
    """The code of an exactly known variant, from (code, variant) rows held in a map; null otherwise."""
    table = F.create_map(*[F.lit(x) for code, words in variants.items() for w in words for x in (w, code)])
    return F.try_element_at(table, F.upper(F.trim(strip_accents(c))))
