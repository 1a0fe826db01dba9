"""URL identity: two canonical forms, their hashes, hosts and titles, all as column expressions.

``url_canon`` is the identity of collected items; ``canon_url`` is the history's. They differ on purpose: the first
strips one of www./m./amp. and keeps an unusual port, the second strips all three in turn and drops ports.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Query keys that never identify a page, matched from their start without case.
TRACKING = (
    r"(?i)^(utm_|spm|ref$|ref_src|fbclid|gclid|dclid|mc_cid|mc_eid|share_|share$|campaign|medium$|source$|from$|wechat|igshid"
    r"|si$|feature$|_hsenc|_hsmi|oly_|vero_|cmpid|sr_share|tt_|s$|token$|trk)"
)
DEFAULT_PORTS = {"http": "80", "https": "443", "ws": "80", "wss": "443"}


def _parts(url: Column) -> dict[str, Column]:
    u = F.regexp_replace(F.coalesce(url, F.lit("")), r"^\s+|\s+$", "")
    full = F.when(u.contains("://"), u).otherwise(F.concat(F.lit("https://"), u))
    rest = F.substring_index(full, "://", -1)
    rest = F.when(F.length(full) > 0, F.regexp_replace(full, r"^[^:/?#]*://", "")).otherwise(rest)
    authority = F.regexp_replace(F.regexp_extract(rest, r"^([^/?#]*)", 1), r"^.*@", "")
    return {
        "raw": u,
        "scheme": F.lower(F.regexp_extract(full, r"^([^:/?#]*)://", 1)),
        "host": F.lower(F.regexp_extract(authority, r"^(\[[^\]]*\]|[^:]*)", 1)),
        "port": F.regexp_extract(authority, r":(\d+)$", 1),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
        "query": F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1),
    }


def _decoded(x: Column) -> Column:
    return F.coalesce(F.try_url_decode(x), x)


def _encoded(x: Column) -> Column:
    return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def clean_query(query: Column) -> Column:
    """Decoded pairs without tracking keys, in order of key and value, encoded again."""
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("k"), _decoded(F.when(p.contains("="), F.regexp_replace(p, r"^[^=]*=", "")).otherwise("")).alias("v")),
    )
    kept = F.array_sort(F.filter(pairs, lambda p: ~p["k"].rlike(TRACKING)))
    return F.array_join(F.transform(kept, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")


@F.pandas_udf(T.StringType())
def _idna(hosts: pd.Series) -> pd.Series:
    def one(h):
        try:
            return h.encode("idna").decode("ascii")
        except (UnicodeError, AttributeError):
            return h

    return hosts.map(one)


def _joined(p: dict[str, Column], netloc: Column) -> Column:
    path = F.regexp_replace(p["path"], r"/+$", "")
    query = clean_query(p["query"])
    tail = F.concat(F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when(p["raw"] == "", "").otherwise(F.concat(p["scheme"], F.lit("://"), netloc, tail))


def url_canon(url: Column, idna: bool = False) -> Column:
    """The canonical URL of an item; idempotent, and the empty string for null or blank.

    idna: hosts beyond ASCII go through an Arrow UDF; without it they stay as they are and all runs in the JVM.
    """
    p = _parts(url)
    host = _idna(p["host"]) if idna else p["host"]
    host = F.regexp_replace(host, r"^(www\.|m\.|amp\.)", "")
    usual = F.create_map(*[F.lit(x) for kv in DEFAULT_PORTS.items() for x in kv])
    plain = (p["port"] == "") | (p["port"].cast("int") == 0) | (p["port"] == F.coalesce(F.element_at(usual, p["scheme"]), F.lit("")))
    return _joined(p, F.when(plain, host).otherwise(F.concat(host, F.lit(":"), p["port"].cast("int").cast("string"))))


def canon_url(url: Column) -> Column:
    """The history's canonical URL: no port, and www., m. and amp. stripped one after the other."""
    p = _parts(url)
    host = p["host"]
    for prefix in (r"^www\.", r"^m\.", r"^amp\."):
        host = F.regexp_replace(host, prefix, "")
    return _joined(p, host)


def item_key(url: Column) -> Column:
    return F.substring(F.sha2(url_canon(url), 256), 1, 16)


def url_hash(url: Column) -> Column:
    """sha1 of the history's form."""
    return F.sha1(canon_url(url))


def url_host(url: Column) -> Column:
    return F.when(F.coalesce(url, F.lit("")).contains("://"), _parts(url)["host"]).otherwise("")


def slug_title(url: Column) -> Column:
    """A readable title from the last path segment, else the host with its port."""
    netloc = F.regexp_extract(url, r"^[^:/?#]*://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[^:/?#]*://[^/?#]*([^?#]*)", 1)
    last = F.element_at(F.filter(F.split(path, "/"), lambda s: s != ""), -1)
    last = F.coalesce(_decoded(F.replace(last, F.lit("+"), F.lit("%2B"))), netloc)
    title = F.trim(F.regexp_replace(F.regexp_replace(last, r"(?i)\.(html?|php|aspx?|md)$", ""), r"[-_+]+", " "))
    return F.when(title == "", netloc).otherwise(title)


def urljoin(base: Column, href: Column) -> Column:
    """href seen from base: absolute, protocol-relative, rooted or beside base; dot segments are left as they are."""
    origin = F.regexp_extract(base, r"^([^:/?#]*://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^([^:/?#]*://[^/?#]*/(?:[^?#]*/)?)", 1)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^([^:/?#]*:)", 1), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), href))
        .otherwise(F.concat(F.when(folder == "", F.concat(origin, F.lit("/"))).otherwise(folder), href))
    )
