"""Numbers: safe casts, map-literal lookup and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakestrata.functions.text import strip

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def number(c: Column) -> Column:
    """The text as a double, NULL where it is no number."""
    text = strip(c.cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def rate_for(role: Column, rates: Column) -> Column:
    """Look the row's own role up in a ``{'role': rate}`` text; NULL if bad or missing."""
    parsed = F.from_json(rates, "map<string,double>", {"allowSingleQuotes": "true"})
    return F.try_element_at(parsed, strip(role))


def product(amount: Column, rate: Column) -> Column:
    return number(amount) * rate


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, two decimals, halves up; NULL for a zero whole.

    Both are counts, so the rounding is done on integers and is exact.
    """
    n, d = part.cast("long"), F.nullif(whole.cast("long"), F.lit(0).cast("long"))
    hundredths = F.call_function("div", n * 20000 + d, d * 2)
    return hundredths.cast("double") / F.lit(100.0)


def divide(part: Column, whole: Column) -> Column:
    """Ratio as a double, 0 where the divisor is missing or zero (measure form)."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double"))
    return F.coalesce(ratio, F.lit(0.0))
