"""URL scalars as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import fast_space

# fixed values: tracking parameters of the two cleaners (besides utm_*), second-level labels, aggregators, standards sites,
# parameters that carry a destination, tokens of official sources
TRACKING = ("gclid", "fbclid", "ref")
TRACKING_NEWS = ("gclid", "fbclid", "mc_cid", "mc_eid", "ocid", "cmpid", "ref", "ref_src", "src", "guccounter", "guce_referrer", "guce_referrer_sig")
SECOND_LEVEL = ("co", "com", "org", "net", "gov", "ac")
AGGREGATORS = ("news.google.", "google.com/rss", "googleusercontent.com", "bing.com/news", "msn.com/")
BLOCKED_HOSTS = ("w3.org", "www.w3.org", "schema.org", "www.schema.org", "xml.org", "www.xml.org")
EMBEDDED = ("url", "u", "q", "target", "redirect", "redirect_url")
OFFICIAL = ("world health organization", "who.int", "reliefweb", "cdc.gov", "ecdc.europa.eu", "paho.org", "afro.who.int", "gov.", ".gov", "ministry of health", "public health agency")

_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def any_of(c: Column, tokens: tuple[str, ...]) -> Column:
    """Whether the text holds any of these substrings."""
    out = F.lit(False)
    for t in tokens:
        out = out | c.contains(t)
    return F.coalesce(out, F.lit(False))


def scheme(u: Column) -> Column:
    return F.lower(F.regexp_extract(fast_space(u), _PARTS, 1))


def netloc(u: Column) -> Column:
    return F.regexp_extract(fast_space(u), _PARTS, 2)


def path(u: Column) -> Column:
    return F.regexp_extract(fast_space(u), _PARTS, 3)


def query_string(u: Column) -> Column:
    return F.regexp_extract(fast_space(u), _PARTS, 4)


def host(u: Column) -> Column:
    """Lower-case host, without credentials and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(netloc(u), "^.*@", ""), ":[0-9]*$", ""))


def site_key(u: Column) -> Column:
    """Last two labels of the host (www. apart), three under a second-level domain of a two-letter country."""
    parts = F.filter(F.split(F.regexp_replace(host(u), r"^www\.", ""), r"\."), lambda x: x != "")
    n = F.size(parts)
    country = (n >= 3) & (F.length(F.try_element_at(parts, F.lit(-1))) == 2) & F.coalesce(F.try_element_at(parts, F.lit(-2)).isin(*SECOND_LEVEL), F.lit(False))
    return F.array_join(F.slice(parts, F.greatest(F.lit(1), n - F.when(country, 2).otherwise(1)), 3), ".")


def same_site(a: Column, b: Column) -> Column:
    return (site_key(a) != "") & (site_key(a) == site_key(b))


def _kept(u: Column, drop, blanks: bool) -> Column:
    """The query string without dropped parameters."""
    name = lambda p: F.lower(F.substring_index(p, "=", 1))
    return F.array_join(F.filter(F.split(query_string(u), "&"), lambda p: (p != "") & (F.lit(True) if blanks else p.rlike("=.")) & ~(name(p).startswith("utm_") | drop(name(p)))), "&")


def _with_query(base: Column, q: Column) -> Column:
    return F.concat(base, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))


def canonical_url(u: Column) -> Column:
    """Scheme and network place (with its port) lower, path without closing slashes but / for none, no fragment, no utm_*,
    gclid, fbclid or ref."""
    trimmed = F.regexp_replace(path(u), "/+$", "")
    base = F.concat(scheme(u), F.lit("://"), F.lower(netloc(u)), F.when(trimmed == "", "/").otherwise(trimmed))
    return F.when(scheme(u) == "", fast_space(u)).otherwise(_with_query(base, _kept(u, lambda k: k.isin(*TRACKING), True)))


def decode_embedded(u: Column) -> Column:
    """The first URL that a redirect carries in its parameters, in their fixed order; else itself."""
    out = F.lit(None).cast("string")
    for key in EMBEDDED:
        inner = F.try_url_decode(F.regexp_extract(query_string(u), rf"(?:^|&){key}=([^&]+)", 1))
        out = F.coalesce(out, F.when(inner.rlike("^https?://"), inner))
    return F.coalesce(out, fast_space(u))


def clean_news_url(u: Column) -> Column:
    """The destination, without fragment, blank and tracking parameters; empty if it is no web address."""
    u = decode_embedded(u)
    base = F.concat(scheme(u), F.lit("://"), netloc(u), path(u))
    return F.when(scheme(u).isin("http", "https") & (netloc(u) != ""), _with_query(base, _kept(u, lambda k: k.isin(*TRACKING_NEWS), False))).otherwise("")


def aggregator(u: Column) -> Column:
    return any_of(F.lower(fast_space(u)), AGGREGATORS)


def blocked_destination(u: Column) -> Column:
    return host(u).isin(*BLOCKED_HOSTS)


def official_source(flag: Column, *fields: Column) -> Column:
    """Marked as official, or so by a token in source, publisher or URL."""
    return F.coalesce(flag, F.lit(False)) | any_of(F.lower(F.concat_ws(" ", *fields)), OFFICIAL)


def candidate_urls(*urls: Column) -> Column:
    """Cleaned destinations once each, direct ones before aggregators, then shorter first; standards sites go."""
    cleaned = F.filter(F.array(*(clean_news_url(u) for u in urls)), lambda x: (x != "") & ~blocked_destination(x))
    rows = F.transform(F.array_distinct(cleaned), lambda x, i: F.struct(aggregator(x).cast("int").alias("a"), F.length(x).alias("n"), i.alias("i"), x.alias("u")))
    return F.transform(F.array_sort(rows), lambda r: r["u"])


def safe_public(u: Column) -> Column:
    """https without credentials, to a public host by its name or address (names are not resolved)."""
    h = F.regexp_replace(F.lower(F.regexp_replace(netloc(u), "^.*@", "")), r":[0-9]*$", "")
    four = r"^(0\.|10\.|127\.|169\.254\.|192\.168\.|192\.0\.0\.|198\.1[89]\.|100\.(6[4-9]|[7-9][0-9]|1[01][0-9]|12[0-7])\.|172\.(1[6-9]|2[0-9]|3[01])\.|2(2[4-9]|[345][0-9])\.)"
    six = r"^\[(::1?|::ffff:.*|fe[89ab][0-9a-f]:.*|f[cd][0-9a-f]{2}:.*|ff.*)\]$"
    private = h.rlike(four) | h.rlike(six) | h.rlike(r"(^|\.)(localhost|local|internal|home\.arpa)$")
    return (scheme(u) == "https") & (h != "") & ~private & ~netloc(u).contains("@")
