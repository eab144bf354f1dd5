"""Address encoding, decoding and parsing as ``Column -> Column`` functions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from catlink.functions.text import col, extract


def _swap(c: Column, pairs: dict[str, str]) -> Column:
    for old, new in pairs.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def encode_name(c: Column | str) -> Column:
    """Name -> path segment: blanks become ``+``, parentheses stay."""
    return _swap(F.url_encode(col(c)), {"*": "%2A", "%28": "(", "%29": ")", "%7E": "~"})


def decode(c: Column | str) -> Column:
    """Percent and plus decoding that leaves malformed escapes as they are."""
    return F.url_decode(F.regexp_replace(col(c), r"%(?![0-9A-Fa-f]{2})", "%25"))


def decode_name(url: Column | str, prefix: str) -> Column:
    """The decoded address without its first ``len(prefix)`` characters."""
    return F.substr(decode(url), F.lit(len(prefix) + 1))


def id_from_url(url: Column | str, prefix: str) -> Column:
    """Number right after ``prefix``; NULL when the address has another shape."""
    return extract(url, "^" + re.escape(prefix) + r"([0-9]+)").try_cast("bigint")


def wiki_base(lang: str) -> str:
    return f"http://{lang}.wikipedia.org/wiki/"


def wiki_title(url: Column | str, lang: str) -> Column:
    """Page title of an encyclopedia address, NULL for addresses of other sites."""
    u = col(url)
    # '+' is an ordinary character in these paths
    return F.when(u.startswith(wiki_base(lang)), decode_name(F.replace(u, F.lit("+"), F.lit("%2B")), wiki_base(lang)))


def quote_title(c: Column | str) -> Column:
    """Title -> path of its encyclopedia page."""
    kept = {"%2F": "/", "%24": "$", "%2C": ",", "%3A": ":", "%3B": ";", "%40": "@"}
    return _swap(F.url_encode(F.replace(col(c), F.lit(" "), F.lit("_"))), {"*": "%2A", **kept})


def escape_query(c: Column | str) -> Column:
    """Protect a name from being read as search syntax."""
    out = col(c)
    for word in ("OR", "AND", "NOT"):
        out = F.regexp_replace(out, rf"\b{word}\b", word.lower())
    return F.replace(out, F.lit("+"), F.lit("\\+"))


def mbid(url: Column | str, kind: str) -> Column:
    """The 36-character entity identifier at the end of an address."""
    return extract(url, rf"/{kind}/([0-9a-f-]{{36}})(?=\n?\z)")


# Store and rights-society address formats.
STORE_ARTIST_URL = "http://itunes.apple.com/us/artist/id"
STORE_ALBUM_URL = "http://itunes.apple.com/us/album/id"
RIGHTS_SEARCH = "/ace/search.cfm"
RIGHTS_QUERY = "?requesttimeout=300&mode=results&searchstr="
RIGHTS_FIELD = "&search_in="
RIGHTS_TAIL = "&search_type=exact&search_det=t,s,w,p,b,v&results_pp=25&start=1"


def store_id(url: Column | str) -> Column:
    return extract(url, r"/id(\d+)").try_cast("bigint")


def store_url(store_id_col: Column | str, base: str) -> Column:
    """Address of a store id; NULL for a missing (or zero) id."""
    i = col(store_id_col)
    return F.when(i.isNotNull() & (i != 0), F.concat(F.lit(base), i.cast("string")))


def album_slug(url: Column | str) -> Column:
    return extract(url, r"/cd/([^/]+)")


def artist_slug(url: Column | str) -> Column:
    return extract(url, r"/Artist/([^/]+)")


def rights_search_url(term: Column | str, field: str, server: str) -> Column:
    return F.concat(F.lit(server + RIGHTS_SEARCH + RIGHTS_QUERY), col(term).cast("string"), F.lit(RIGHTS_FIELD + field + RIGHTS_TAIL))
