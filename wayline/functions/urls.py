"""URL and hash expressions. Patterns rather than parse_url, which rejects what the captured data holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARTS = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)(?::[0-9]*)?([^?#]*)(?:\?([^#]*))?"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _PARTS, 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 2)


def query(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 3)


def landing_path(url: Column) -> Column:
    return F.regexp_replace(path(url), "/+$", "")


def landing_identity(url: Column) -> Column:
    """Host and path: scheme, query, fragment and a last slash do not tell pages apart."""
    return F.concat(host(url), F.lit("|"), landing_path(url))


def page_key(url: Column) -> Column:
    """As landing_identity, and www. is no other site."""
    return F.concat(F.regexp_replace(host(url), r"^www\.", ""), F.lit("|"), landing_path(url))


def trace_key(url: Column) -> Column:
    return F.concat(landing_identity(url), F.lit("?"), query(url))


def landed(target: Column, seen: Column) -> Column:
    """Whether a visit to target ended at seen: the same page or one below it; an empty target always has."""
    same_host = host(target) == host(seen)
    below = F.startswith(landing_path(seen), F.concat(landing_path(target), F.lit("/"))) & (landing_path(target) != "")
    return (target == "") | (same_host & ((landing_path(target) == landing_path(seen)) | below))


def in_domain(name: Column, domain: Column) -> Column:
    """Whether a host is the domain or under it; never a mere suffix."""
    return (name == domain) | F.endswith(name, F.concat(F.lit("."), domain))


def in_domains(name: Column, domains: Sequence[str]) -> Column:
    found = F.lit(False)
    for domain in domains:
        found = found | in_domain(name, F.lit(domain))
    return found


def is_homepage(url: Column) -> Column:
    return path(url).isin("", "/")


def redirect_target(url: Column, name: str = "url") -> Column:
    """The page a redirect link leads to, where its parameter holds one; else the link."""
    raw = F.regexp_extract(query(url), rf"(?:^|&){name}=([^&]*)", 1)
    decoded = F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when(decoded.rlike("^https?://"), decoded).otherwise(url)


def url_hash(url: Column) -> Column:
    return F.substring(F.md5(url), 1, 8)


def body_key(body: Column) -> Column:
    return F.substring(F.sha2(body, 256), 1, 16)


def pick(salt: Column, n: int) -> Column:
    """A number below n that the salt alone decides: its hash's first byte."""
    return F.conv(F.substring(F.sha2(salt, 256), 1, 2), 16, 10).cast("int") % n


def action_signature(tool: Column, params: Column) -> Column:
    """One text for a tool and its parameters in any order."""
    pairs = F.transform(F.array_sort(F.map_entries(params)), lambda kv: F.concat_ws("=", kv["key"], kv["value"]))
    return F.concat(tool, F.lit("\u0001"), F.array_join(pairs, "\u0001"))


def host_root(host: Column, roots: Sequence[str]) -> Column:
    """The first of the roots that a host is, or is a sub-domain of; '' for none."""
    hit = [F.when((host == root) | F.endswith(host, F.lit(f".{root}")), F.lit(root)) for root in roots]
    return F.coalesce(*hit, F.lit(""))


def rotated(seed: Column, choices: Sequence[str]) -> Column:
    """One of the choices, by the CRC-32 of the seed's UTF-8 bytes."""
    return F.element_at(F.array(*map(F.lit, choices)), (F.crc32(seed) % len(choices) + 1).cast("int"))


def exclusion_reason(url: Column, engine: str, redirect: tuple[str, str], excluded: Sequence[str], impossible: Sequence[str], noise: str) -> Column:
    """Why a link is no candidate, the first reason counting; '' for none.

    engine: the search engine's host; redirect: host and path of its result links, which are candidates unless they wrap
    another address openly; excluded and impossible: roots of hosts; noise: a pattern of paths.
    """
    browsable, name, way = url.rlike("^https?://"), host(url), path(url)
    wraps = F.replace(F.replace(url, F.lit("%3A"), F.lit(":")), F.lit("%2F"), F.lit("/")).rlike(r"[?&]url=https?://")
    out, beyond = host_root(name, excluded), host_root(name, impossible)
    return (
        F.when(~browsable, "non_http_scheme")
        .when(name == "", "no_host")
        .when((name == redirect[0]) & (way == redirect[1]), F.when(wraps, "redirect_wrapper").otherwise(""))
        .when(name == engine, "engine_self")
        .when(out != "", F.concat(F.lit("excluded_host:"), out))
        .when(beyond != "", F.concat(F.lit("impossible_content:"), beyond))
        .when(way.rlike(noise), "path_noise")
        .when(wraps, "redirect_wrapper")
        .otherwise("")
    )
