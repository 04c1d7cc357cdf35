"""Link resolution and URL parts."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The only schemes a link may have after resolving.
LINK_SCHEMES = ("http", "https")

_PLAIN_CHARS = r"[^\s;#?\\\[\]\p{Cntrl}]"
# A root-relative or absolute link whose resolution is plain concatenation:
# no parameters, no empty query, no dot segments, no characters to strip.
_ROOTED = rf"^/(?!/)(?:{_PLAIN_CHARS})*(?:\?{_PLAIN_CHARS}+)?$"
_ABSOLUTE = rf"^https?://{_PLAIN_CHARS}+(?:\?{_PLAIN_CHARS}+)?$"
_PLAIN_BASE = r"^https?://[^\s/?#;\\\[\]]+(?:[/?#]|$)"
_DOT_SEGMENT = r"(?:^|/)\.\.?(?:/|\?|$)"
_OTHER_SCHEME = r"^(?:mailto|javascript|tel|data):"


def netloc(url: Column) -> Column:
    """Authority as written: keeps port and case."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def hostname(url: Column) -> Column:
    """Lower-cased host without credentials or port; null when there is none."""
    authority = F.regexp_replace(netloc(url), r"^.*@", "")
    host = F.regexp_extract(authority, r"^(\[[^\]]*\]|[^:]*)", 1)
    bare = F.lower(F.regexp_replace(host, r"[\[\]]", ""))
    return F.when(bare != "", bare)


def defragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


@F.pandas_udf(T.StringType())
def _join_any(base: pd.Series, href: pd.Series) -> pd.Series:
    def joined(b, h):
        if b is None or h is None:
            return None
        try:
            return urljoin(b, h)
        except ValueError:
            return None

    return pd.Series([joined(b, h) for b, h in zip(base, href)], dtype=object)


def resolve_link(base: Column, href: Column) -> Column:
    """Absolute URL of ``href`` on page ``base``, without its fragment.

    Links whose resolution is plain concatenation stay in the JVM. Only the rest
    (relative paths, dot segments, parameters, odd characters) are handed to the
    URL library; the others reach it as null.
    """
    bare = defragment(href)
    rooted = base.rlike(_PLAIN_BASE) & bare.rlike(_ROOTED) & ~bare.rlike(_DOT_SEGMENT)
    absolute = bare.rlike(_ABSOLUTE)
    foreign = bare.rlike(_OTHER_SCHEME)
    easy = F.coalesce(rooted | absolute | foreign, F.lit(True))
    site = F.concat(url_scheme(base), F.lit("://"), netloc(base))
    general = defragment(_join_any(F.when(~easy, base), F.when(~easy, href)))
    return F.when(rooted, F.concat(site, bare)).when(absolute | foreign, bare).otherwise(general)


def same_netloc(url: Column, host: Column) -> Column:
    """http(s) URL whose authority equals ``host`` exactly (port and case count)."""
    return url_scheme(url).isin(*LINK_SCHEMES) & (netloc(url) == host)


def same_hostname(url: Column, host: Column) -> Column:
    """URL whose lower-cased host name equals ``host``; port is ignored."""
    return F.coalesce(hostname(url) == host, F.lit(False))


def normalize_link(base: Column, href: Column, host: Column) -> Column:
    """Resolved link, or null when it leaves ``host``."""
    url = resolve_link(base, href)
    return F.when(same_netloc(url, host), url)
