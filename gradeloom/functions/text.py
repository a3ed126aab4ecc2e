"""Column helpers for text and digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squeeze(text: Column) -> Column:
    """Collapse runs of whitespace to one space and trim; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def short_sha256(value: Column, length: int = 16) -> Column:
    return F.substring(F.sha2(value, 256), 1, length)


def percent_encode(text: Column) -> Column:
    """Percent-encode a path, keeping ``/`` and writing a space as %20."""
    out = F.url_encode(text)
    out = F.regexp_replace(out, r"\+", "%20")
    return F.regexp_replace(out, "%2F", "/")


def rule_case(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """First matching pattern wins: ``rules`` is ``[(label, regex), ...]`` in priority order."""
    expr = None
    for label, pattern in rules:
        cond = text.rlike(pattern)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(F.lit(default)) if default is not None else expr
