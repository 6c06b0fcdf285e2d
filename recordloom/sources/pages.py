"""HTML snapshots to records, by patterns on the JVM side, or over an element tree where structure nests."""

from __future__ import annotations

import json
import re
from urllib.parse import parse_qs, urlparse

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from ..functions.text import strip_tags, text, unescape
from . import tree


def title(html) -> Column:
    return strip_tags(F.regexp_extract(text(html), r"(?is)<title[^>]*>(.*?)</title>", 1))


def links(html) -> Column:
    """Distinct href values in order."""
    return F.array_distinct(F.regexp_extract_all(text(html), F.lit(r"(?i)href\s*=\s*[\"']([^\"']+)[\"']"), 1))


def body_text(html) -> Column:
    s = F.regexp_replace(text(html), r"(?is)<(script|style)\b.*?</\1>", " ")
    return strip_tags(F.regexp_replace(s, r"(?is)^.*?<body[^>]*>|</body>.*$", ""))


def attribute(card: Column, name: str) -> Column:
    return unescape(F.regexp_extract(card, f'{name}="([^"]*)"', 1))


def cards(html, marker: str, wanted: str | None = None) -> Column:
    """Parts of a listing from each marker to the next; with ``wanted`` only those in which that pattern is found."""
    every = F.slice(F.split(text(html), marker), 2, 1 << 20)
    return F.filter(every, lambda c: c.rlike(wanted)) if wanted else every


def autocompleted(raw) -> Column:
    """array<struct(name, path)> of a registry's JSON answer; empty if it is no array; objects without a name go, and so does
    what follows a path's question mark."""
    none = F.expr("cast(array() as array<struct<name:string,path:string>>)")
    rows = F.when(F.trim(text(raw)).startswith("["), F.from_json(text(raw), "array<struct<name:string,path:string>>"))
    named = F.filter(F.coalesce(rows, none), lambda r: F.trim(text(r["name"])) != "")
    return F.transform(named, lambda r: F.struct(r["name"].alias("name"), F.substring_index(text(r["path"]), "?", 1).alias("path")))


def title_parts(t: Column) -> Column:
    """struct(name, details) of "Name - Detail - ... - Section - Site" titles."""
    p = F.split(t, r"\s+-\s+")
    return F.struct(F.try_element_at(p, F.lit(1)).alias("name"), F.when(F.size(p) > 3, F.array_join(F.slice(p, F.lit(2), F.greatest(F.size(p) - 3, F.lit(1))), " - ")).otherwise("").alias("details"))


def unwrapped(url: Column) -> Column:
    """The target of a search redirect (uddg=), other urls as they are; null for script links."""
    target = F.try_parse_url(url, F.lit("QUERY"), F.lit("uddg"))
    return F.when(~F.lower(url).startswith("javascript:"), F.coalesce(F.url_decode(target), url))


def of_type(node, kind: str) -> list[dict]:
    """Every object of an @type at any depth."""
    if isinstance(node, list):
        return [x for n in node for x in of_type(n, kind)]
    if not isinstance(node, dict):
        return []
    return ([node] if node.get("@type") == kind else []) + [x for v in node.values() for x in of_type(v, kind)]


def _json_names(scripts: list[str], kind: str) -> list[str]:
    out = []
    for s in scripts:
        try:
            out += [str(x.get("name") or "") for x in of_type(json.loads(s), kind)]
        except (ValueError, RecursionError):
            continue
    return out


def _hrefs(elements: list[tree.Element], scheme: str) -> list[str]:
    held = [e.attrs.get("href", "") for e in elements]
    return [h[len(scheme) :].split("?")[0].strip() for h in held if h.lower().startswith(scheme)]


def _distinct(values) -> list[str]:
    return list(dict.fromkeys(v for v in values if v))


def _first(elements: list[tree.Element]) -> str:
    return next((e.text() for e in elements), "")


def _parser(schema: str, one):
    """A column function that makes a struct of each page by ``one(html)``, which returns a dict of its fields, or None."""

    @F.pandas_udf(T.StructType([T.StructField("p", T.StructType.fromDDL(schema))]))
    def parsed(htmls: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"p": [one(h) for h in htmls]})

    return lambda html: parsed(html)["p"]


#: Where profile pages have their fields, fixed values of the directory's markup.
PROFILE = {
    "name": 'h1[itemprop="name"]', "other_name": '[data-id="doctor-name"]', "specialty": 'a[href*="/especialidad/"], [itemprop="medicalSpecialty"]',
    "phones": '[itemprop="telephone"], [data-phone-id], a[href^="tel:"]', "emails": 'a[href^="mailto:"]', "clinics": '[itemtype*="MedicalOrganization"], [data-id="address"], .address',
    "bio": '[itemprop="description"], .doctor-description', "scripts": 'script[type="application/ld+json"]',
}


def _profile(html: str | None) -> dict | None:
    at = tree.found(tree.parse(html), PROFILE)
    name, specialty = _first(at["name"] or at["other_name"]), _first(at["specialty"])
    if not name and not specialty:
        return None
    phones = [e.attrs["href"].removeprefix("tel:").strip() if e.attrs.get("href") else e.text() for e in at["phones"]]
    clinics = [" | ".join(e.lines()) for e in at["clinics"]]
    scripts = ["".join(p for p in e.parts if isinstance(p, str)) for e in at["scripts"]]
    return {"name": name, "specialty": specialty, "phones": _distinct(p for p in phones if len(p) >= 7), "emails": _distinct(_hrefs(at["emails"], "mailto:")),
            "clinics": [c for c in clinics if c], "bio": _first(at["bio"]), "listed": _json_names(scripts, "Physician")}


def profile_record():
    """A column function: struct(name, specialty, phones, emails, clinics, bio, listed) of a profile page; null if it has neither
    name nor specialty.  Phones of under seven characters go; ``listed`` are the names of physicians in JSON-LD."""
    return _parser("name string, specialty string, phones array<string>, emails array<string>, clinics array<string>, bio string, listed array<string>", _profile)


def _named(html: str | None) -> dict:
    at = tree.found(tree.parse(html), {"name": PROFILE["name"], "links": "[href]", "scripts": PROFILE["scripts"]})
    scripts = ["".join(p for p in e.parts if isinstance(p, str)) for e in at["scripts"]]
    return {"name": _first(at["name"]), "phones": _distinct(_hrefs(at["links"], "tel:")), "emails": _distinct(_hrefs(at["links"], "mailto:")), "listed": _json_names(scripts, "Physician")}


def profile():
    """A column function: struct(name, phones, emails, listed) of any page, from its heading, links and JSON-LD; fields that a page
    lacks are empty."""
    return _parser("name string, phones array<string>, emails array<string>, listed array<string>", _named)


#: Where a directory's profile has its address cards; fixed values of its markup.
CARD = {
    "cards": ".profile-address-card", "names": ".profile-address-card__name", "streets": '[data-test-id="address-info-street"]', "cities": ".city[content]", "regions": ".province.region[content]",
    "specialties": '[data-test-id="doctor-specializations"]', "insurers": '[data-test-id="address-insurances-modal"] a[title]', "services": "[:services]",
}
_MODAL_PHONE = re.compile(r"address-\d+-(\d{7,15})-\d+-phone")
_THREE_PARTS = re.compile(r"/[a-z0-9-]+/[a-z0-9-]+/[a-z0-9-]+")
#: Insurers that a record names at most.
INSURERS = 15


def default_service(raw: str) -> tuple[int | None, str]:
    """(lowest price, name) of the highlighted service of a JSON list, or else of the first; (None, "") if it is no such list."""
    try:
        services = [s for s in json.loads(raw) if isinstance(s, dict)]
    except (ValueError, TypeError):
        return None, ""
    best = next((s for s in services if s.get("isDefaultServiceForHighlight")), services[0] if services else {})
    price = best.get("priceMin")
    return int(price) if isinstance(price, (int, float)) else None, str(best.get("name") or "").strip()


def _address_cards(html: str | None) -> dict:
    root = tree.parse(html)
    at = tree.found(root, {"field." + k if k in ("streets", "cities", "regions") else k: s for k, s in CARD.items()})
    inner = [tree.found(card, {k: CARD[k] for k in ("names", "streets", "cities", "regions")}) for card in at["cards"]]
    value = {"names": tree.Element.text, "streets": lambda e: e.text().rstrip(","), "cities": lambda e: e.attrs["content"], "regions": lambda e: e.attrs["content"]}
    held = {k: [" ".join(value[k](found[k][0]).split()) for found in inner if found[k]] for k in value}
    for k in ("streets", "cities", "regions"):  # without any in cards, what the page has elsewhere
        held[k] = held[k] or [" ".join(value[k](e).split()) for e in at["field." + k]]
    price, service = default_service(next((e.attrs[":services"] for e in at["services"]), ""))
    return {"phones": _distinct(_MODAL_PHONE.findall(html or "")), "remote": any("línea" in n.lower() for n in held["names"]), "offices": _distinct(n for n in held["names"] if "línea" not in n.lower()),
            "streets": _distinct(held["streets"]), "cities": _distinct(held["cities"]), "regions": _distinct(held["regions"]), "specialties": _first(at["specialties"]).strip(" ·,") if at["specialties"] else None,
            "insurers": _distinct(e.attrs["title"].strip() for e in at["insurers"] if _THREE_PARTS.fullmatch(e.attrs.get("href", "")))[:INSURERS], "price_min": price, "price_service": service}


def address_cards():
    """A column function: struct(phones, remote, offices, streets, cities, regions, specialties, insurers, price_min, price_service) of a
    profile with address cards.  Streets, cities and regions that no card has are looked for in the whole page;
    ``specialties`` is null where the page has no such list, for the caller's own to stand."""
    lists = ", ".join(f"{k} array<string>" for k in ("offices", "streets", "cities", "regions"))
    return _parser(f"phones array<string>, remote boolean, {lists}, specialties string, insurers array<string>, price_min long, price_service string", _address_cards)


def listing_records(html) -> Column:
    """array<struct> of a listing's cards, whose fields stand in data attributes; facilities and cards without name or url go."""
    fields = {"result_id": "data-result-id", "name": "data-doctor-name", "url": "data-doctor-url", "specialty": "data-eec-specialization-name", "city": "data-eec-address-cities",
              "rating": "data-eec-stars-rating", "reviews": "data-eec-opinions-count", "entity": "data-test-entity-type"}
    rows = F.transform(cards(html, 'data-test-id="result-item"'), lambda c: F.struct(*[F.trim(attribute(c, a)).alias(n) for n, a in fields.items()]))
    kept = F.filter(rows, lambda r: (r["name"] != "") & (r["url"] != "") & (r["entity"] != "facility"))
    return F.transform(kept, lambda r: r.dropFields("entity"))


#: Result lists of two search engines: (a result, its link, its snippet); fixed values of their markup.
LAYOUTS = {"a": ("li.b_algo", "h2 > a", ".b_caption p, .b_lineclamp4, .b_lineclamp2"), "b": ("div.result, div.web-result", "a.result__a", ".result__snippet")}


def _target(href: str) -> str:
    """Where a search engine's redirect leads."""
    if "uddg=" not in href:
        return "https:" + href if href.startswith("//") else href
    query = parse_qs(urlparse(href if href.startswith("http") else "https:" + href).query)
    return query.get("uddg", [href])[0]


def _hits(html: str | None) -> dict:
    root, out = tree.parse(html), []
    for layout, (result, link, snippet) in LAYOUTS.items():
        for e in tree.found(root, {"r": result})["r"]:
            at = tree.found(e, {"link": link, "snippet": snippet})
            url = _target(at["link"][0].attrs.get("href", "")) if at["link"] else ""
            if url and not url.startswith("javascript:"):
                out.append({"layout": layout, "title": at["link"][0].text(), "url": url, "snippet": _first(at["snippet"])})
    return {"hits": out}


def search_hits():
    """A column function: struct(hits array<struct(layout, title, url, snippet)>) of a page of search results in either layout, in
    order; results without a link go, and so do script links."""
    return _parser("hits array<struct<layout:string,title:string,url:string,snippet:string>>", _hits)


def _microdata(html: str | None) -> dict:
    items = tree.scopes(tree.parse(html))
    top = [k for k in range(len(items))]
    for k, item in enumerate(items):  # a scope stands after the one around it
        top[k] = k if item["parent"] is None or not item["prop"] else top[item["parent"]]
    out = []
    for k in dict.fromkeys(top):
        own = [items[k], *(x for j, x in enumerate(items) if top[j] == k and j != k)]
        get = lambda *names: next((v for x in own for n in names for v in x["values"].get(n, ()) if v), "")
        name = next((v for v in items[k]["values"].get("name", ()) if v), "")
        if name:
            kind = items[k]["kind"].rstrip("/").rsplit("/", 1)[-1]
            out.append({"kind": kind, "name": name, "url": get("url"), "street": get("streetAddress"), "locality": get("addressLocality"), "phone": get("telephone"), "parts": len(own) - 1})
    return {"records": out}


def microdata():
    """A column function: struct(records array<struct(kind, name, url, street, locality, phone, parts)>) of a page's schema.org items,
    in order.  An item that is a property of another (its address, say) is part of that one's record; other items within
    an item are records of their own.  The name is the item's own; items without one go."""
    return _parser("records array<struct<kind:string,name:string,url:string,street:string,locality:string,phone:string,parts:int>>", _microdata)
