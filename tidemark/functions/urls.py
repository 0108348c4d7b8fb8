"""URL expressions: redirect targets, canonical form, hashes, hosts, handles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query parameters that only track.
TRACKING = "utm_source utm_medium utm_campaign utm_term utm_content gclid fbclid igshid mc_cid mc_eid vero_id gaa_at gaa_n gaa_ts gaa_sig".split()
#: Parameters in which forwarding links carry their target, in order of preference.
TARGETS = "url q u dest destination redirect target continue".split()


def is_http(url: Column) -> Column:
    return F.trim(F.coalesce(url, F.lit(""))).rlike("^https?://")


def redirect_target(url: Column) -> Column:
    """The address a forwarding link carries, of the first parameter of ``TARGETS`` that holds one; else null."""
    found = []
    for name in TARGETS:
        raw = F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)
        value = F.try_url_decode(raw)
        found.append(F.when(value.rlike(r"^\s*https?://"), F.trim(value)))
    return F.coalesce(*found)


def resolve(url: Column, resolved: Column | None = None) -> Column:
    """Redirect target, else an address looked up beforehand, else the URL itself."""
    own = F.trim(F.coalesce(url, F.lit("")))
    return F.coalesce(redirect_target(own), *([F.nullif(resolved, F.lit(""))] if resolved is not None else []), own)


def normalize(url: Column) -> Column:
    """Lower scheme and host, no leading ``www.``, single slashes, no fragment or tracking, sorted parameters."""
    # The array of one element binds the resolved address, so its patterns are matched once.
    whole = F.get(F.transform(F.array(resolve(url)), _normal_form), F.lit(0))
    return F.when(F.trim(F.coalesce(url, F.lit(""))) == "", "").otherwise(whole)


def _normal_form(u: Column) -> Column:
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    scheme = F.when(scheme == "", "http").otherwise(scheme)
    host = F.regexp_replace(F.lower(F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)), r"^www\.", "")
    path = F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#;]*)", 1)
    path = F.regexp_replace(path, "/{2,}", "/")
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p: F.struct(
            F.coalesce(F.try_url_decode(F.regexp_extract(p, "^([^=]*)", 1)), F.regexp_extract(p, "^([^=]*)", 1)).alias("k"),
            F.coalesce(F.try_url_decode(F.regexp_extract(p, "^[^=]*=?(.*)$", 1)), F.regexp_extract(p, "^[^=]*=?(.*)$", 1)).alias("v"),
        ),
    )
    kept = F.array_sort(F.filter(pairs, lambda p: ~p["k"].isin(TRACKING) & ~p["k"].startswith("utm_") & ~p["k"].startswith("gaa_")))
    code = lambda x: F.replace(F.replace(F.url_encode(x), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))
    text = F.array_join(F.transform(kept, lambda p: F.concat(code(p["k"]), F.lit("="), code(p["v"]))), "&")
    return F.concat(scheme, F.lit("://"), host, path, F.when(text != "", F.concat(F.lit("?"), text)).otherwise(""))


def url_hash(url: Column) -> Column:
    """SHA-256 of the normal form; empty for an empty URL."""
    return F.get(F.transform(F.array(normalize(url)), lambda n: F.when(n == "", "").otherwise(F.sha2(n, 256))), F.lit(0))


def host(url: Column) -> Column:
    """Host name, lower case, every ``www.`` removed, without port and user."""
    h = F.lower(F.regexp_extract(F.trim(F.coalesce(url, F.lit(""))), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.replace(h, F.lit("www."), F.lit(""))


def host_matches(h: Column, domain: Column | str) -> Column:
    """Whether a host is a domain or lies below it."""
    d = F.lit(domain) if isinstance(domain, str) else domain
    return (h == d) | F.endswith(h, F.concat(F.lit("."), d))


def domains_of(cell: Column) -> Column:
    """Sorted distinct hosts of a pipe-separated cell of addresses, schemes optional; hosts without a dot are dropped."""
    parts = F.filter(F.transform(F.split(F.coalesce(cell, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda p: (p != "") & (F.lower(p) != "nan"))
    hosts = F.transform(parts, lambda p: host(F.when(p.contains("://"), p).otherwise(F.concat(F.lit("http://"), p))))
    return F.array_sort(F.array_distinct(F.filter(hosts, lambda h: h.contains("."))))


def item_hash(url: Column, *parts: Column) -> Column:
    """MD5 of the URL, or of the other parts joined by pipes where it is empty."""
    joined = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.md5(F.coalesce(F.nullif(url, F.lit("")), joined))


def handle(url: Column, reserved: list[str]) -> Column:
    """First path word of a profile address, lower case; empty for reserved words."""
    first = F.lower(F.regexp_extract(url, r"^[A-Za-z]+://[^/]+/@?([^/?#]+)", 1))
    return F.when(first.isin(reserved), "").otherwise(first)
