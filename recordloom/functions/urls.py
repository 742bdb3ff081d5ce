"""URL rules as column expressions. No function here runs Python on executors
except ``reencode_query``, which re-encodes escapes the way HTML forms do."""

from __future__ import annotations

from urllib.parse import parse_qsl, quote, urlencode

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Query keys that only identify a click, and the parts of a URL.
CLICK_KEYS = ["fbclid", "gclid", "mc_cid", "mc_eid"]
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _part(url: Column, n: int) -> Column:
    return F.regexp_extract(F.trim(url), _PARTS, n)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def authority(url: Column) -> Column:
    return _part(url, 2)


def path(url: Column) -> Column:
    return _part(url, 3)


def query(url: Column) -> Column:
    return _part(url, 4)


def fragment(url: Column) -> Column:
    return _part(url, 5)


def host(url: Column) -> Column:
    """Lower-case host without user, port or brackets' port."""
    bare = F.regexp_replace(authority(url), r"^.*@", "")
    return F.lower(F.regexp_replace(bare, r":[0-9]*$", ""))


def port(url: Column) -> Column:
    """Explicit port, or null."""
    return F.regexp_extract(authority(url), r":([0-9]+)$", 1).try_cast("int")


def _is_web(url: Column) -> Column:
    return scheme(url).isin("http", "https") & (host(url) != "")


def _bare_path(url: Column) -> Column:
    """Path without trailing slashes."""
    return F.regexp_replace(path(url), r"/+$", "")


def normalize_url(url: Column) -> Column:
    """Strict form, null if it is no web URL: user and fragment go, an explicit port
    stays, trailing slashes go unless the path is a single one, the query stays verbatim."""
    at = F.when(port(url) > 0, F.concat(host(url), F.lit(":"), port(url).cast("string"))).otherwise(host(url))
    where = F.when(path(url).isin("", "/"), F.lit("/")).otherwise(_bare_path(url))
    asked = F.when(query(url) != "", F.concat(F.lit("?"), query(url))).otherwise("")
    return F.when(_is_web(url), F.concat(scheme(url), F.lit("://"), at, where, asked))


def require_urls(url: Column) -> Column:
    """Like ``normalize_url``, aborting on anything that is no web URL."""
    found = normalize_url(url)
    return F.when(found.isNull(), F.raise_error(F.concat(F.lit("invalid public URL: "), F.coalesce(url, F.lit("null"))))).otherwise(found)


def _asked(url: Column) -> Column:
    """Query without click identifiers and without empty parts."""
    pairs = F.filter(F.split(query(url), "&"), lambda p: (p != "") & ~F.lower(F.split_part(p, F.lit("="), F.lit(1))).isin(CLICK_KEYS))
    return F.array_join(F.transform(pairs, lambda p: F.when(F.contains(p, F.lit("=")), p).otherwise(F.concat(p, F.lit("=")))), "&")


@F.pandas_udf(T.StringType())
def reencode_query(text: pd.Series) -> pd.Series:
    """Decode and encode a query string again, keeping order and blanks."""
    return text.map(lambda q: urlencode(parse_qsl(q, keep_blank_values=True)) if isinstance(q, str) else q)


def discovery_url(url: Column, exact: bool = False) -> Column:
    """Discovery form, empty text if it is no web URL: user and port stay, lower-case
    authority, no fragment or path parameters, click identifiers go.

    ``exact`` also re-encodes escapes in the query, in a vectorised Python function;
    without it the query must hold no escapes to come out the same.
    """
    plain = F.regexp_replace(F.regexp_replace(path(url), r";[^/]*$", ""), r"/+$", "")
    where = F.when(plain == "", F.lit("/")).otherwise(plain)
    asked = reencode_query(_asked(url)) if exact else _asked(url)
    valid = scheme(url).isin("http", "https") & (authority(url) != "")
    return F.when(valid, F.concat(scheme(url), F.lit("://"), F.lower(authority(url)), where, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise(""))).otherwise("")


def is_request_page(url: Column) -> Column:
    """The path is /request/ and one segment without a dot."""
    return path(url).rlike(r"^/request/[^/?.]+$")


def request_slug(url: Column) -> Column:
    """Slug of a request page or its .json twin; empty for other and nested paths."""
    leaf = F.regexp_extract(_bare_path(url), r"^/request/([^/]+)$", 1)
    return F.regexp_replace(leaf, r"\.json$", "")


def host_pattern(url: Column) -> Column:
    """Index pattern of a site: host/request/*."""
    return F.concat(host(url), F.lit("/request/*"))


def in_scope(url: Column, scope: Column) -> Column:
    """Equal to the scope, or below it if the scope ends with a star."""
    stem = F.expr("''") if scope is None else F.left(scope, F.length(scope) - 1)
    return F.when(F.endswith(scope, F.lit("*")), F.startswith(url, stem)).otherwise(url == scope)


def is_exact_canonical(url: Column, site: str) -> Column:
    """https, the given host, default port, no user, query or fragment."""
    return (scheme(url) == "https") & (host(url) == site) & (F.coalesce(port(url), F.lit(443)) == 443) & ~F.contains(authority(url), F.lit("@")) & (query(url) == "") & (fragment(url) == "")


def is_safe_https(url: Column) -> Column:
    """https with a host, no user or fragment, port 443 and no dot segments."""
    return (scheme(url) == "https") & (host(url) != "") & ~F.contains(authority(url), F.lit("@")) & (fragment(url) == "") & (F.coalesce(port(url), F.lit(443)) == 443) & ~path(url).rlike(r"(^|/)\.\.?(/|$)")


@F.pandas_udf(T.StringType())
def percent_quote(text: pd.Series) -> pd.Series:
    return text.map(lambda u: quote(u, safe=":/?#[]@!$&'()*+,;=%") if isinstance(u, str) else u)


def replay_url(url: Column, timestamp: Column) -> Column:
    """Address of an archived copy, identity form."""
    return F.concat(F.lit("https://web.archive.org/web/"), timestamp, F.lit("id_/"), percent_quote(url))


def canonical_request_url(explicit: Column, source: Column, slug: Column) -> Column:
    """The explicit address, else built from source and slug, else null."""
    built = F.when((F.coalesce(source, F.lit("")) != "") & (F.coalesce(slug, F.lit("")) != ""), F.concat(F.regexp_replace(source, r"/+$", ""), F.lit("/request/"), slug))
    return F.coalesce(F.nullif(explicit, F.lit("")), built)
