"""Dates: mixed-format parsing, month ends and the monthly snapshot status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakestrata.functions.text import is_blank, strip

_ISO = r"^(\d{4}-\d{1,2}-\d{1,2})$"

# The strict month/day/year form, rewritten to ISO.
_MONTH_DAY_YEAR = ((r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2"),)

# Further forms the lenient parser takes, rewritten to ISO in this order. Where
# the first number can be a month it is one, otherwise it is the day.
LENIENT_FORMS = (
    (r"^(\d{4})-(\d{1,2})-(\d{1,2})[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?$", "$1-$2-$3"),
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})$", "$1-$2-$3"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"^(0?[1-9]|1[0-2])[-/](\d{1,2})[-/](\d{4})$", "$3-$1-$2"),
    (r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})$", "$3-$2-$1"),
)

# Forms with an English month name, full or short, rewritten to "Month d yyyy".
NAMED_FORMS = (
    (r"^([A-Za-z]+) (\d{1,2}),? (\d{4})$", "$1 $2 $3"),
    (r"^(\d{1,2}) ([A-Za-z]+),? (\d{4})$", "$2 $1 $3"),
)
SHORTEST_DATE = len("1/1/2025")
_NAMED = (r"^[A-Za-z]+ \d{1,2} \d{4}$", "[MMMM][MMM] d yyyy")

# The monthly suffix of an extract, once for file names and once for names without ".csv".
MONTHLY_FILE = r"_(\d{4})_(\d{2})\.csv$"
DATASET_OF_STEM = r"^(.+)_\d{4}_\d{2}$"


def _rewritten(c: Column, forms: Sequence[tuple[str, str]]) -> Column:
    for pattern, replacement in forms:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def _from_iso(c: Column) -> Column:
    # Rewriting to ISO and casting keeps the cell inside generated code; a formatter based
    # try_to_date would raise and swallow an exception for every cell of another format.
    return F.regexp_extract(c, _ISO, 1).try_cast("date")


def mixed_date(c: Column) -> Column:
    """Strict: ``YYYY-MM-DD`` or ``MM/DD/YYYY`` after stripping, anything else is NULL."""
    return _from_iso(_rewritten(strip(c), _MONTH_DAY_YEAR))


def mixed_date_lenient(c: Column) -> Column:
    """Strict forms first, then the declared further forms in their order."""
    text = strip(c)
    named = _rewritten(text, NAMED_FORMS)
    pattern, layout = _NAMED
    other = F.coalesce(
        _from_iso(_rewritten(text, LENIENT_FORMS)),
        F.when(named.rlike(pattern), F.try_to_date(F.initcap(F.lower(named)), layout)),
    )
    # Blanks and null tokens are shorter than any date, so they skip the further forms.
    return F.coalesce(mixed_date(c), F.when(F.length(text) >= SHORTEST_DATE, other))


def date_outcome(raw: Column, parsed: Column) -> Column:
    """``ok``, ``blank`` or ``invalid`` for one date cell."""
    return F.when(parsed.isNotNull(), "ok").when(is_blank(raw), "blank").otherwise("invalid")


def month_end_of_file(source_file: Column) -> Column:
    """Last day of the month in the file name, NULL where the name has none."""
    month = F.translate(F.substring(F.regexp_extract(source_file, MONTHLY_FILE, 0), 2, 7), "_", "-")
    return F.last_day(F.concat(month, F.lit("-01")).try_cast("date"))


def dataset_of_file(source_file: Column) -> Column:
    """Dataset name: the file stem without its monthly suffix."""
    stem = F.regexp_replace(F.element_at(F.split(source_file, "/"), -1), r"(?i)\.csv$", "")
    dataset = F.regexp_extract(stem, DATASET_OF_STEM, 1)
    return F.when(dataset != "", dataset).otherwise(stem)


def snapshot_status(admit: Column, discharge: Column, month_end: Column) -> Column:
    """Active when admitted by the month end and not discharged before its first day."""
    active = (admit <= month_end) & (
        discharge.isNull() | (discharge >= F.trunc(month_end, "MM").cast("date"))
    )
    return F.when(active, "Active").otherwise("Not Active")
