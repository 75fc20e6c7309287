"""Text cleansing: trimming, null tokens, defaults and label mapping."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters which count as outer white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Texts which stand for a missing value (compared as written).
NULL_TOKENS = ("", "N/A", "NULL", "null", "None", "none")

# Texts which stand for a blank (compared in lower case).
BLANK_TOKENS = ("", "null", "n/a", "nan", "pd.na", "none")

# Care level codes and their labels.
CARE_LEVELS = {
    "AL": "Assisted Living",
    "Assisted": "Assisted Living",
    "Assisted Living": "Assisted Living",
    "IL": "Independent Living",
    "Independent": "Independent Living",
    "Independent Living": "Independent Living",
    "MC": "Memory Care",
    "Memory": "Memory Care",
    "Memory Care": "Memory Care",
}


def strip(c: Column) -> Column:
    """Remove outer white space of any kind (SQL ``trim`` alone would keep tabs)."""
    return F.btrim(c, F.lit(WHITESPACE))


def was_trimmed(c: Column) -> Column:
    return F.coalesce(strip(c) != c, F.lit(False))


def null_tokens_to_null(c: Column) -> Column:
    """Strip, and turn the null tokens into NULL."""
    stripped = strip(c)
    return F.when(~stripped.isin(*NULL_TOKENS), stripped)


def is_blank(c: Column) -> Column:
    return c.isNull() | F.lower(strip(c)).isin(*BLANK_TOKENS)


def blank_to_default(c: Column, default: str = "N/A") -> Column:
    return F.when(is_blank(c), F.lit(default)).otherwise(c)


def empty_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def _label_map(labels: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(text) for pair in labels.items() for text in pair])


def label_any_case(c: Column, labels: Mapping[str, str] = CARE_LEVELS) -> Column:
    """Map codes to labels ignoring case; unknown texts stay as they are."""
    lowered = {code.lower(): label for code, label in labels.items()}
    return F.coalesce(F.try_element_at(_label_map(lowered), F.lower(strip(c))), c)


def label_exact(c: Column, labels: Mapping[str, str] = CARE_LEVELS) -> Column:
    """Map codes to labels in exactly the written case; unknown texts stay as they are."""
    return F.coalesce(F.try_element_at(_label_map(labels), strip(c)), c)
