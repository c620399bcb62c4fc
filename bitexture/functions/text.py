"""Text columns: Unicode strip, token counters, scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that Unicode-aware string stripping treats as white space.
UNICODE_SPACE = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

TokenCounter = Callable[[Column], Column]


def strip(text: Column) -> Column:
    """Drop leading and trailing Unicode white space (``trim`` handles the ASCII space only)."""
    return F.regexp_replace(text, f"^{UNICODE_SPACE}+|{UNICODE_SPACE}+$", "")


def right_strip(text: Column) -> Column:
    return F.regexp_replace(text, f"{UNICODE_SPACE}+$", "")


def without_spaces(text: Column) -> Column:
    return F.regexp_replace(text, f"{UNICODE_SPACE}+", "")


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def count_chars(text: Column) -> Column:
    return F.length(text)


def count_bytes(text: Column) -> Column:
    return F.octet_length(text)


TOKEN_COUNTERS: dict[str, TokenCounter] = {"ws": count_words, "chars": count_chars, "bytes": count_bytes}


def harmonic_mean(a: Column, b: Column) -> Column:
    """NULL when both are zero, so such pairs sort last."""
    return F.try_divide(F.lit(2.0) * a * b, a + b)
