"""Ordered checks, lenient parsers and small scores. All are Column in, Column out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayline.functions.text import contains_any

# Shapes of credentials by class.
CREDENTIAL_CLASSES = {"assignment": r"(?i)(?:password|secret|token|api_?key)\s*[:=]\s*\S{6,}", "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}", "bearer": r"(?i)bearer\s+[a-z0-9._-]{16,}"}


def credential_classes(text: Column) -> Column:
    """The classes of credentials a text shows; never their text."""
    return F.filter(F.array(*(F.when(text.rlike(p), name) for name, p in CREDENTIAL_CLASSES.items())), lambda x: x.isNotNull())


def shape(text: Column) -> Column:
    """Letters and digits of a text as classes, so that a finding can be told without showing it."""
    out = F.regexp_replace(text, "[a-z]", "a")
    return F.regexp_replace(F.regexp_replace(out, "[A-Z]", "A"), "[0-9]", "9")


def block_kind(url: Column, title: Column, body: Column, urls: Sequence[str], titles: Sequence[str], bodies: Sequence[str]) -> Column:
    """captcha by the address or the title, rate_limit by the body, else null."""
    return F.when(contains_any(url, urls) | contains_any(title, titles), "captcha").when(contains_any(body, bodies), "rate_limit")


def is_boilerplate(text: Column, phrases: Sequence[str], tail: str) -> Column:
    """A closed phrase, a text that ends as boilerplate does, or nothing at all."""
    bare = F.trim(text)
    return (bare == "") | bare.isin(*phrases) | bare.rlike(tail)


def composite_parts(text: Column, separators: str = r"\s*[,;/]\s*") -> Column:
    """Parts of two and more characters; none unless there are two of them."""
    parts = F.filter(F.split(text, separators), lambda x: F.length(F.trim(x)) >= 2)
    return F.when(F.size(parts) >= 2, parts).otherwise(F.array().cast("array<string>"))


def snapshot_parts(text: Column) -> Column:
    """Address, title and body of a snapshot that begins with lines of the first two."""
    pattern = r"(?s)^URL: ([^\n]*)\nTitle: ([^\n]*)\n\n(.*)$"
    return F.struct(*(F.regexp_extract(text, pattern, k).alias(name) for k, name in ((1, "url"), (2, "title"), (3, "body"))))


def is_truncated(body: Column, limit: int, share: float = 0.95) -> Column:
    return F.length(body) >= limit * share


def element_line(line: Column) -> Column:
    """Reference, tag and label of a line like: e12= button "Play"."""
    pattern = r'^(\w+)= (\w+) "(.*)"$'
    return F.struct(*(F.regexp_extract(line, pattern, k).alias(name) for k, name in ((1, "ref"), (2, "tag"), (3, "label"))))


def confidence(value: Column) -> Column:
    """A number from 0 to 1; null for all else."""
    return F.when(value.between(0, 1), value)


def lead_in_stripped(text: Column, prefixes: Sequence[str]) -> Column:
    """Without the first of the prefixes the text begins with."""
    out = text
    for prefix in reversed(list(prefixes)):
        out = F.when(F.startswith(text, F.lit(prefix)), F.substring(text, F.lit(len(prefix) + 1), F.length(text))).otherwise(out)
    return out


def five_tiers(share: Column) -> Column:
    """0 to 1 as a tier from 1 to 5, rounded half to even and clamped."""
    return F.greatest(F.lit(1), F.least(F.lit(5), F.bround(share * 4).cast("int") + 1))


def ratio_difference(a: Column, b: Column) -> Column:
    """|b - a| / a; a missing b counts as 0, without an a there is none."""
    return F.abs(F.coalesce(b, F.lit(0)) - a) / F.nullif(a, F.lit(0))


def ordering_time(text: Column) -> Column:
    """Seconds since the epoch of an ISO text, 0 where it is none."""
    return F.coalesce(F.unix_micros(F.try_to_timestamp(text)) / 1e6, F.lit(0.0))


def face(version: Column, segment: str) -> Column:
    """A segment of name@code:3/llm:4; empty without."""
    return F.regexp_extract(version, rf"[@/]{segment}:([^/]*)", 1)


def selected_lines(text: Column, most: Column) -> Column:
    """Line numbers of an answer that holds digits, commas and blanks only: those within bounds, each once; else null."""
    found = F.transform(F.regexp_extract_all(text, F.lit("[0-9]{1,9}"), F.lit(0)), lambda x: x.cast("int"))
    return F.when(text.rlike("^[0-9, ]+$"), F.array_distinct(F.filter(found, lambda k: (k >= 1) & (k <= most))))


def intercept(rules: Sequence[tuple[str, Column]]) -> Column:
    """The verdict of the first rule that holds, else go_on."""
    out = F.lit("go_on")
    for name, test in reversed(list(rules)):
        out = F.when(F.coalesce(test, F.lit(False)), name).otherwise(out)
    return out


# Patterns of credentials, in any case.
CREDENTIALS = {
    "authorization": r"authorization\s*[:=]",
    "bearer": r"bearer\s+[A-Za-z0-9._\-]{16,}",
    "signed_token": r"eyJ[A-Za-z0-9_\-]{10,}\.[A-Za-z0-9_\-]{10,}",
    "model_key": r"(?<![A-Za-z0-9])sk-ant-[A-Za-z0-9_\-]{16,}",
    "service_key": r"(?<![A-Za-z0-9])sk-[A-Za-z0-9]{16,}",
    "cloud_key": r"AKIA[0-9A-Z]{16,}",
    "api_key": r"AIza[0-9A-Za-z_\-]{35,}",
    "password_in_url": r"https?://[^\s/:@]+:[^\s/@]+@",
    "cookie": r"set-cookie\s*:",
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "code_host_token": r"ghp_[A-Za-z0-9]{36,}",
}


def credential_patterns(text: Column, patterns: dict[str, str] = CREDENTIALS) -> Column:
    """The names of the patterns that are found in the text, in their order."""
    return F.array_compact(F.array(*(F.when(text.rlike(f"(?i){p}"), F.lit(name)) for name, p in patterns.items())))
