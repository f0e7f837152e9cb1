"""URL columns: identity, cache keys, sites. All are plain Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that sign a URL, and those that only track a visitor (by prefix).
SIGNING = ("x-amz-[a-z-]+", "x-goog-[a-z-]+", "awsaccesskeyid", "signature", "expires", "googleaccessid", "response-content-(type|disposition)", "sv", "se", "sr", "sp", "sig", "st", "spr", "skoid", "sktid", "skt", "ske", "sks", "skv")
SIGNED = ("x-amz-signature", "x-goog-signature", "signature", "sig")
TRACKING = ("utm_", "fbclid", "gclid", "ref", "source")
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "nic", "org", "res")

_SIGNING = "(?i)^(" + "|".join(SIGNING) + ")$"
_SIGNED = "(?i)(^|&)(" + "|".join(SIGNED) + ")="


def _part(url: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(F.trim(url), pattern, group)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://"))


def host(url: Column) -> Column:
    """Lower-cased, without user, password and port; empty if there is none."""
    return F.lower(_part(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"))


def port(url: Column) -> Column:
    return _part(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?[^/?#:]*:([0-9]+)")


def path(url: Column) -> Column:
    found = _part(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)")
    return F.when(found == "", "/").otherwise(found)


def query(url: Column) -> Column:
    return _part(url, r"^[^?#]*\?([^#]*)")


def _names(pair: Column) -> Column:
    return F.substring_index(pair, "=", 1)


def _assemble(scheme_: Column, host_: Column, path_: Column, query_: Column) -> Column:
    return F.concat(scheme_, F.lit("://"), host_, path_, F.when(query_ == "", "").otherwise(F.concat(F.lit("?"), query_)))


def _site(url: Column) -> Column:
    p, s = port(url), scheme(url)
    plain = (p == "") | ((s == "http") & (p == "80")) | ((s == "https") & (p == "443"))
    return F.when(plain, host(url)).otherwise(F.concat(host(url), F.lit(":"), p))


def canonical(url: Column) -> Column:
    """The URL as an identity: scheme and host in lower case, no fragment, no default port, ``/`` for no path; of a
    signed URL the signing parameters go, other queries stay as they are."""
    q = query(url)
    kept = F.array_join(F.filter(F.split(q, "&"), lambda kv: ~_names(kv).rlike(_SIGNING)), "&")
    return _assemble(scheme(url), _site(url), path(url), F.when(q.rlike(_SIGNED), kept).otherwise(q))


def cache_key(url: Column, tracking: tuple[str, ...] = TRACKING) -> Column:
    """The URL as the key of a cache: canonical, without tracking parameters, the others in order."""
    drop = "(?i)^(" + "|".join(tracking) + ")"
    kept = F.array_sort(F.filter(F.split(query(url), "&"), lambda kv: (kv != "") & ~kv.rlike(drop)))
    return _assemble(scheme(url), _site(url), path(url), F.array_join(kept, "&"))


def notice_id(url: Column, title: Column | None = None) -> Column:
    """sha256 of the canonical URL, or of URL and title where one URL carries several notices."""
    key = canonical(url)
    return F.sha2(key if title is None else F.concat(key, F.lit("\n"), title), 256)


def site_key(url: Column) -> Column:
    """The URL without scheme, ``www.`` and trailing slashes, in lower case, for comparing addresses."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"(?i)^https?://(www\.)?", ""), r"/+$", ""))


def domain(host_: Column, second_level: tuple[str, ...] = SECOND_LEVEL) -> Column:
    """The part of a host that is registered: its last two labels, three where the last but one is a second level."""
    parts = F.split(host_, r"\.")
    n = F.size(parts)
    three = (n >= 3) & F.try_element_at(parts, n - 1).isin(*second_level)
    return F.array_join(F.slice(parts, F.greatest(F.lit(1), n - F.when(three, 2).otherwise(1)), F.lit(3)), ".")


def same_site(a: Column, b: Column) -> Column:
    """Whether a host is another or below it."""
    return (a == b) | F.endswith(a, F.concat(F.lit("."), b))


def deeper(longer: Column, shorter: Column) -> Column:
    """Whether a URL is on the site of another, at a longer path that begins with the other's."""
    a, b = site_key(longer), site_key(shorter)
    return (a != b) & F.startswith(a, F.concat(b, F.lit("/")))


def file_name(url: Column) -> Column:
    return F.regexp_extract(path(url), r"([^/]*)$", 1)
