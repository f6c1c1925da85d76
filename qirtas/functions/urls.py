"""URL canonicalisation and classification as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qirtas.functions.text import strip

# Query keys that only track, parts of listing paths, extensions of
# files that are no documents, and parts of system paths.
TRACKING = ("utm_", "fbclid", "gclid")
LISTING_HINTS = ("/category/", "/tag/", "/author/", "/page/", "/search/", "/feed/", "/wp-json/")
STATIC_EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif", ".webp", ".svg", ".css", ".js", ".ico", ".xml", ".rss", ".zip")
SYSTEM_PARTS = ("wp-content", "wp-admin", "wp-includes")
ROOT_PATHS = ("", "/", "/p/")


def scheme(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
    return F.when(found == "", "https").otherwise(found)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def _query(url: Column) -> Column:
    pairs = F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda p: p != "")
    kept = F.filter(pairs, lambda p: ~F.lower(p).rlike("^(" + "|".join(TRACKING) + ")"))

    def again(p: Column) -> Column:
        key, value = F.regexp_extract(p, r"^([^=]*)", 1), F.regexp_extract(p, r"^[^=]*=(.*)$", 1)
        code = lambda c: F.url_encode(F.coalesce(F.try_url_decode(c), c))
        return F.concat(code(key), F.lit("="), code(value))

    return F.array_join(F.transform(kept, again), "&")


def canonical_url(url: Column, longest_extension: int = 8) -> Column:
    """Scheme and host lower-case, single slashes, a slash at the end unless there
    is an extension, tracking keys and fragment removed. Null and empty give empty.
    """
    u = strip(F.coalesce(url, F.lit("")))
    p = F.regexp_replace(path(u), "/{2,}", "/")
    p = F.when(p == "", "/").otherwise(p)
    plain = (p == "/") | p.rlike(rf"\.[A-Za-z0-9]{{2,{longest_extension}}}$")
    p = F.when(plain, p).otherwise(F.concat(F.regexp_replace(p, "/+$", ""), F.lit("/")))
    q = _query(u)
    out = F.concat(scheme(u), F.lit("://"), host(u), p, F.when(q == "", "").otherwise(F.concat(F.lit("?"), q)))
    return F.when(u == "", "").otherwise(out)


def _contains_any(c: Column, parts: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for part in parts:
        out = out | c.contains(part)
    return out


def is_pdf(url: Column, allowed: Column) -> Column:
    p = F.lower(path(url))
    return allowed & (p.endswith(".pdf") | p.contains("/pdf/"))


def is_listing(url: Column, allowed: Column) -> Column:
    p = F.lower(path(url))
    return allowed & (p.isin(*ROOT_PATHS) | _contains_any(p, LISTING_HINTS))


def is_document(url: Column, allowed: Column, pdf_allowed: Column) -> Column:
    p = F.lower(path(url))
    static = F.lit(False)
    for e in STATIC_EXTENSIONS:
        static = static | p.endswith(e)
    return allowed & ~is_pdf(url, pdf_allowed) & ~p.isin(*ROOT_PATHS) & ~static & ~_contains_any(p, LISTING_HINTS + SYSTEM_PARTS)


def title_from_url(url: Column) -> Column:
    """The last part of the path as words; the host if there is none."""
    last = F.regexp_extract(F.regexp_replace(path(url), "/+$", ""), r"([^/]*)$", 1)
    name = strip(F.regexp_replace(F.when(last == "", host(url)).otherwise(last), "[-_]+", " "))
    return F.when(name == "", url).otherwise(name)


def raw_file_stem(url: Column) -> Column:
    """The path as a slug of at most 90 characters, or ``root``, and 12 hex digits of the hash."""
    slug = F.substring(F.regexp_replace(F.regexp_replace(path(url), r"[^A-Za-z0-9]+", "-"), "^-+|-+$", ""), 1, 90)
    return F.concat(F.when(slug == "", "root").otherwise(slug), F.lit("-"), F.substring(F.sha1(url), 1, 12))
