"""URL functions as native Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ABSOLUTE = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"
#: Bytes that a URL parser rejects: control characters, a space in the authority, a broken percent escape in it.
MALFORMED = r"[\x00-\x1f\x7f]|%(?![0-9A-Fa-f]{2})|^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*[ <>\"]"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, ABSOLUTE, group)


def url_scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def url_authority(url: Column) -> Column:
    """host[:port] without user info, case kept."""
    return F.regexp_replace(_part(url, 2), r"^.*@", "")


def url_hostname(url: Column) -> Column:
    """Lower-case host without port; '' when the URL is relative."""
    return F.lower(F.regexp_replace(url_authority(url), r":[0-9]*$", ""))


def url_path(url: Column) -> Column:
    return _part(url, 3)


def url_query(url: Column) -> Column:
    return F.regexp_replace(_part(url, 4), r"^\?", "")


def url_origin(url: Column) -> Column:
    return F.concat(url_scheme(url), F.lit("://"), F.lower(url_authority(url)))


def lookup_host_path(url: Column) -> tuple[Column, Column]:
    """(host without port, path or '/') used by rule lookups; host is null for relative URLs."""
    host = url_hostname(url)
    path = url_path(url)
    return F.when(host != "", host), F.when(path == "", F.lit("/")).otherwise(path)


def host_or_url(url: Column) -> Column:
    host = url_hostname(url)
    return F.when(host == "", url).otherwise(host)


def host_or_unknown(url: Column) -> Column:
    host = url_hostname(url)
    return F.when(url.isNull() | (host == ""), F.lit("_unknown_")).otherwise(host)


def host_with_port(url: Column) -> Column:
    return F.lower(url_authority(url))


def _form_encoded(text: Column) -> Column:
    """Form encoding in which only letters, digits and -._~ stay as they are."""
    return F.regexp_replace(F.regexp_replace(F.url_encode(text), "%7E", "~"), r"\*", "%2A")


def _allowed_query(host: Column, query: Column, allowed: Mapping[str, Sequence[str]]) -> Column:
    """Keep allow-listed parameters per host (www-insensitive), decoded and encoded again, sorted by key.

    A parameter is cut at its first "="; equal keys keep their order.  A query that cannot be decoded stays as it is.
    """
    bare = F.regexp_replace(host, r"^www\.", "")
    cut = lambda kv: F.instr(kv, "=")
    key = lambda kv: F.when(cut(kv) > 0, F.substr(kv, F.lit(1), cut(kv) - 1)).otherwise(kv)
    value = lambda kv: F.when(cut(kv) > 0, F.substr(kv, cut(kv) + 1)).otherwise(F.lit(""))
    pair = F.transform(
        F.filter(F.split(query, "&"), lambda kv: kv != ""),
        lambda kv, i: F.struct(F.try_url_decode(key(kv)).alias("k"), i.alias("i"), F.try_url_decode(value(kv)).alias("v")),
    )
    broken = F.exists(pair, lambda p: p["k"].isNull() | p["v"].isNull()) | query.contains(";")
    out = F.lit("")
    for name, params in allowed.items():
        kept = F.array_sort(F.filter(pair, lambda p: F.lower(p["k"]).isin([x.lower() for x in params])))
        text = F.array_join(F.transform(kept, lambda p: F.concat(_form_encoded(p["k"]), F.lit("="), _form_encoded(p["v"]))), "&")
        out = F.when(bare == name.lower().removeprefix("www."), F.when(broken, query).otherwise(text)).otherwise(out)
    return out


def normalize_url(
    url: Column,
    *,
    force_https: bool = True,
    strip_www: bool = False,
    strip_trailing_slash: bool = True,
    strip_fragment: bool = True,
    allowed_params: Mapping[str, Sequence[str]] | None = None,
) -> Column:
    """Canonical URL: https, lower-case host, no query (or allow-listed keys), no trailing slash, no fragment.

    null stays null, '' stays '', relative URLs are returned unchanged, malformed URLs give null
    (callers keep the original with coalesce).
    """
    scheme = url_scheme(url)
    if force_https:
        scheme = F.when(scheme == "http", F.lit("https")).otherwise(scheme)
    raw = _part(url, 2)
    user = F.regexp_extract(raw, r"^(.*@)", 1)
    host = F.lower(F.regexp_replace(url_authority(url), r":$", ""))
    if strip_www:
        host = F.regexp_replace(host, r"^www\.", "")
    path = url_path(url)
    if strip_trailing_slash:
        path = F.when(F.length(path) > 1, F.regexp_replace(path, r"/+$", "")).otherwise(path)
    if allowed_params:
        query = _allowed_query(url_hostname(url), url_query(url), allowed_params)
        query = F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query))
    else:
        query = F.lit("")
    fragment = F.lit("") if strip_fragment else _part(url, 5)
    built = F.concat(scheme, F.lit("://"), user, host, path, query, fragment)
    return (
        F.when(url == "", url)
        .when(url.rlike(MALFORMED), F.lit(None).cast("string"))
        .when(raw == "", url)
        .otherwise(built)
    )


def normalize_or_keep(url: Column, **options) -> Column:
    return F.coalesce(normalize_url(url, **options), url)


def quote_regex(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\.+*?()|\[\]{}^$])", r"\\$1")


def exact_path_pattern(url: Column) -> Column:
    """^quoted(path)$ for a URL, '/' for an empty path."""
    _, path = lookup_host_path(url)
    return F.concat(F.lit("^"), quote_regex(path), F.lit("$"))


def first_denied(url: Column, patterns: Sequence[str]) -> Column:
    """First deny-list entry (case-insensitive substring, '' ignored) that hits, else null."""
    low = F.lower(url)
    checks = [F.when(low.contains(p.lower()), F.lit(p)) for p in patterns if p]
    if not checks:
        return F.lit(None).cast("string")
    return F.when(url != "", F.coalesce(*checks))


def has_path_prefix(url: Column, prefixes: Sequence[str]) -> Column:
    """True when the path starts with one of the prefixes; an empty list allows everything."""
    if not prefixes:
        return F.lit(True)
    path = url_path(url)
    out = F.lit(False)
    for p in prefixes:
        out = out | path.startswith(p)
    return out
