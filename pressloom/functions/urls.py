"""URL identity: canonical form, site ids and record keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hosts whose query string and fragment carry no identity.
TRACKING_HOSTS = ("mako.co.il", "c14.co.il")

_SCHEME = r"\A[A-Za-z][A-Za-z0-9+.\-]*:"
_LITERAL_HOST = r"\A(?:[^@]*@)*\[(?:[0-9a-f:.]*:[0-9a-f:.]*(?:%[^\]]*)?|v[0-9a-f]+\.[^\]]+)\](?::[^\[\]]*)?\z"


def _first(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(c, pattern, group)


def _any_host(netloc: Column, hosts: Sequence[str]) -> Column:
    hit = F.lit(False)
    for h in hosts:
        hit = hit | netloc.contains(h)
    return hit


def _split(url: Column) -> dict[str, Column]:
    u = F.regexp_replace(F.regexp_replace(url, r"\A[\x00-\x20]+", ""), r"[\t\r\n]", "")
    rest = F.regexp_replace(u, _SCHEME, "")
    netloc = F.lower(_first(rest, r"\A//([^/?#]*)"))
    tail = F.regexp_replace(rest, r"\A//[^/?#]*", "")
    body = _first(tail, r"\A[^#]*", 0)
    brackets = netloc.contains("[") | netloc.contains("]")
    return {
        "netloc": netloc,
        "path": _first(body, r"\A[^?]*", 0),
        "query": _first(body, r"(?s)\A[^?]*\?(.*)\z"),
        "fragment": _first(tail, r"(?s)\A[^#]*#(.*)\z"),
        "invalid": brackets & ~netloc.rlike(_LITERAL_HOST),
    }


def host_of(url: Column) -> Column:
    """Lower-case network location, '' when there is none or the URL cannot be read."""
    p = _split(url)
    return F.when(p["invalid"], F.lit("")).otherwise(p["netloc"])


def canonicalize_url(url: Column, strip_hosts: Sequence[str] = TRACKING_HOSTS) -> Column:
    """https scheme, lower-case host, no trailing slashes; query and fragment go only for `strip_hosts`."""
    url = F.coalesce(url, F.lit(""))
    p = _split(url)
    path = F.rtrim(p["path"], F.lit("/"))
    hier = (
        F.when(
            p["netloc"] != "",
            F.concat(F.lit("//"), p["netloc"], F.when((path != "") & ~path.startswith("/"), "/").otherwise(""), path),
        )
        .when((path == "") | path.startswith("/"), F.concat(F.lit("//"), path))
        .otherwise(path)
    )
    keep = ~_any_host(p["netloc"], strip_hosts)
    query = F.when(keep & (p["query"] != ""), F.concat(F.lit("?"), p["query"])).otherwise("")
    fragment = F.when(keep & (p["fragment"] != ""), F.concat(F.lit("#"), p["fragment"])).otherwise("")
    return F.when(p["invalid"], url).otherwise(F.concat(F.lit("https:"), hier, query, fragment))


def extract_url_id(url: Column, source: Column | None = None) -> Column:
    """Article id of the two known sites, NULL otherwise.  The first site rule that applies decides."""
    host = host_of(url)
    src = F.lower(F.coalesce(source, F.lit(""))) if source is not None else F.lit("")
    numeric = F.nullif(_first(url, r"/article/(\p{Nd}+)"), F.lit(""))
    token = F.nullif(_first(url, r"Article-([A-Za-z0-9]+)\.htm"), F.lit(""))
    return F.when(host.contains("c14.co.il") | (src == "c14"), numeric).when(
        host.contains("mako.co.il") | src.isin("n12", "mako"), token
    )


def short_hash(text: Column, n: int = 10) -> Column:
    return F.substring(F.sha1(F.encode(F.coalesce(text, F.lit("")), "UTF-8")), 1, n)


def build_record_key(source: Column, canonical_url: Column, url_id: Column) -> Column:
    """`source:id`, or `source:` and a 12-digit hash of the canonical URL when the site gives no id."""
    from pressloom.functions.text import strip

    src = strip(F.lower(F.coalesce(source, F.lit(""))))
    return F.concat(src, F.lit(":"), F.coalesce(F.nullif(url_id, F.lit("")), short_hash(canonical_url, 12)))
