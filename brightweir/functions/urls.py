"""URL expressions: canonical form, hash, repository key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from brightweir import fixed_values as fixed
from brightweir.functions.text import bind, strip

# scheme, authority, path, query; the fragment is matched and ignored.
_SPLIT = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//[^/?#]*)?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
# path up to the parameters of its last segment, and these parameters.
_SEGMENT = r"(?s)^((?:.*/)?[^/;]*)(?:;(.*))?$"


def _decode(c: Column) -> Column:
    # A percent sign that starts no escape is literal text.
    return F.url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encode(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def _canonical_query(query: Column) -> Column:
    def as_pair(part: Column) -> Column:
        return F.struct(
            _decode(F.substring_index(part, "=", 1)).alias("key"),
            _decode(F.regexp_extract(part, "(?s)^[^=]*=(.*)$", 1)).alias("value"),
        )

    pairs = F.transform(F.split(query, "&"), as_pair)
    kept = F.filter(
        pairs, lambda p: (p["value"] != "") & ~F.lower(p["key"]).isin(fixed.TRACKING_PARAMETERS)
    )
    encoded = F.transform(
        F.array_sort(kept), lambda p: F.concat(_encode(p["key"]), F.lit("="), _encode(p["value"]))
    )
    return F.array_join(encoded, "&")


def canonical_url(c: Column) -> Column:
    """One spelling per address.

    Scheme and authority in lower case, default port and one trailing slash
    removed, tracking and blank parameters dropped, the rest sorted, fragment
    dropped.  Empty or null gives an empty string.
    """
    url = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), "[\t\r\n]", "")
    return bind(url, lambda u: bind(F.struct(
        F.lower(F.regexp_extract(u, _SPLIT, 1)).alias("scheme"),
        F.lower(F.regexp_extract(u, _SPLIT, 2)).alias("host"),
        F.regexp_extract(u, _SPLIT, 3).alias("path"),
        F.regexp_extract(u, _SPLIT, 4).alias("query"),
    ), _rebuilt))


def _rebuilt(parts: Column) -> Column:
    scheme, host, path, query = parts["scheme"], parts["host"], parts["path"], parts["query"]
    host = (
        F.when((scheme == "http") & host.endswith(":80"), F.regexp_replace(host, ":80$", ""))
        .when((scheme == "https") & host.endswith(":443"), F.regexp_replace(host, ":443$", ""))
        .otherwise(host)
    )
    base = F.regexp_replace(F.regexp_extract(path, _SEGMENT, 1), "(?s)^(.+)/$", "$1")
    parameters = F.regexp_extract(path, _SEGMENT, 2)
    kept_query = F.when(query == "", F.lit("")).otherwise(
        bind(_canonical_query(query), lambda q: F.when(q == "", q).otherwise(F.concat(F.lit("?"), q)))
    )
    return F.concat(
        F.when(scheme == "", F.lit("")).otherwise(F.concat(scheme, F.lit(":"))),
        F.when(host == "//", F.lit("")).otherwise(host),
        base,
        F.when(parameters == "", F.lit("")).otherwise(F.concat(F.lit(";"), parameters)),
        kept_query,
    )


def url_key(c: Column) -> Column:
    """SHA-256 of the canonical URL."""
    return F.sha2(canonical_url(c), 256)


def repo_url(c: Column) -> Column:
    """Full repository address; a bare ``owner/name`` gets the host in front."""
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(None)).when(
        c.startswith("http"), c
    ).otherwise(F.concat(F.lit(fixed.REPO_HOST_PREFIX), c))


def repo_key(c: Column) -> Column:
    """Lower-cased ``owner/name`` of a code-host address, null for other addresses."""
    owner = strip(F.regexp_extract(c, fixed.REPO_PATTERN, 1))
    name = F.regexp_replace(strip(F.regexp_extract(c, fixed.REPO_PATTERN, 2)), r"\.git$", "")
    return F.when(F.rlike(c, F.lit(fixed.REPO_PATTERN)), F.lower(F.concat(owner, F.lit("/"), name)))
