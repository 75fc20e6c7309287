from __future__ import annotations

import hashlib
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from lakestrata.functions import dates, numbers, text
from lakestrata.sources import drops


def apply(spark, build, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(build(F.col("v"))).collect()]


STRICT = {
    "2025-01-19": date(2025, 1, 19),
    " 2025-01-19 ": date(2025, 1, 19),
    "03/28/2025": date(2025, 3, 28),
    "3/8/2025": date(2025, 3, 8),
    "2025-1-9": date(2025, 1, 9),
    "": None,
    "N/A": None,
    "null": None,
    None: None,
    "2025-02-30": None,
    "28/03/2025": None,
    "2025-01-19 10:00": None,
    "25-1-9": None,
}

LENIENT = {
    **STRICT,
    "28/03/2025": date(2025, 3, 28),
    "2025-01-19 10:00": date(2025, 1, 19),
    "2025-01-19T10:00:05.25": date(2025, 1, 19),
    "20250119": date(2025, 1, 19),
    "01-02-2025": date(2025, 1, 2),
    "13-02-2025": date(2025, 2, 13),
    "March 3, 2025": date(2025, 3, 3),
    "Mar 3, 2025": date(2025, 3, 3),
    "3 MAY 2025": date(2025, 5, 3),
    "Foo 3, 2025": None,
    "02/30/2025": None,
}


def test_strict_dates(spark):
    assert apply(spark, dates.mixed_date, STRICT) == list(STRICT.values())


def test_lenient_dates(spark):
    assert apply(spark, dates.mixed_date_lenient, LENIENT) == list(LENIENT.values())


def test_date_outcomes(spark):
    found = apply(spark, lambda c: dates.date_outcome(c, dates.mixed_date(c)), STRICT)
    expected = ["ok"] * 5 + ["blank"] * 4 + ["invalid"] * 4
    assert found == expected


def test_null_tokens(spark):
    values = ["", "N/A", "NULL", "null", "None", "none", " N/A\t", "n/a", " x ", None]
    assert apply(spark, text.null_tokens_to_null, values) == [None] * 7 + ["n/a", "x", None]


def test_defaults(spark):
    values = [None, " ", "NaN", "n/a", "pd.NA", "kept ", "None of it"]
    assert apply(spark, text.blank_to_default, values) == ["N/A"] * 5 + ["kept ", "None of it"]


def test_strip_takes_all_white_space(spark):
    values = ["\t a b 　", " x ", "\x1cy\r\n", "plain", "", "   "]
    assert apply(spark, text.strip, values) == [v.strip() for v in values]
    assert apply(spark, text.was_trimmed, [" a", "a", None]) == [True, False, False]


def test_labels(spark):
    values = ["al", "AL", "Memory", "weird", None, " IL "]
    any_case = apply(spark, text.label_any_case, values)
    assert any_case == ["Assisted Living", "Assisted Living", "Memory Care", "weird", None, "Independent Living"]
    exact = apply(spark, text.label_exact, values)
    assert exact == ["al", "Assisted Living", "Memory Care", "weird", None, "Independent Living"]


def test_rate_lookup(spark):
    both = "{'CNA': 18.5, 'RN': 42}"
    rows = [("CNA", both), ("RN ", both), ("Cook", "{'CNA': 18.5}"), ("CNA", "junk"), ("CNA", ""), (None, both), ("CNA", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, role string, rates string")
    found = df.orderBy("i").select(numbers.rate_for(F.col("role"), F.col("rates"))).collect()
    assert [r[0] for r in found] == [18.5, 42.0, None, None, None, None, None]


def test_product(spark):
    found = apply(spark, lambda c: numbers.product(c, F.lit(18.5)), ["8.5", "", "x", None, "1d", " 2 "])
    assert found == [157.25, None, None, None, None, 37.0]


def test_month_end_and_dataset(spark):
    files = ["pcc_residents_2025_02.csv", "a/b_2024_02.csv", "x.csv", "a_2025_1.csv", "b_2025_13.csv"]
    ends = [date(2025, 2, 28), date(2024, 2, 29), None, None, None]
    assert apply(spark, dates.month_end_of_file, files) == ends
    names = ["pcc_residents_2025_01.csv", "lookup.csv", "f/a_2025_1.csv", "g/units_2025_06.CSV"]
    assert apply(spark, dates.dataset_of_file, names) == ["pcc_residents", "lookup", "a_2025_1", "units"]
    assert [drops.dataset_of(n) for n in names] == ["pcc_residents", "lookup", "a_2025_1", "units"]


def test_snapshot_status(spark):
    cases = [
        ("2025-02-28", None, "Active"),
        ("2025-01-01", "2025-02-01", "Active"),
        ("2025-01-01", "2025-01-31", "Not Active"),
        ("2025-03-01", None, "Not Active"),
        (None, None, "Not Active"),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, a string, d string, s string")
    last = F.lit("2025-02-28").cast("date")
    status = dates.snapshot_status(F.col("a").cast("date"), F.col("d").cast("date"), last)
    assert [r[0] for r in df.orderBy("i").select(status).collect()] == [c[2] for c in cases]
    no_month = dates.snapshot_status(F.col("a").cast("date"), F.col("d").cast("date"), F.lit(None).cast("date"))
    assert {r[0] for r in df.select(no_month).collect()} == {"Not Active"}


@pytest.mark.parametrize(
    ("n", "d", "expected"),
    [(3, 7, 42.86), (1, 800, 0.13), (0, 5, 0.0), (4, 0, None), (191, 915, 20.87), (1, 16, 6.25)],
)
def test_percent(spark, n, d, expected):
    row = spark.range(1).select(numbers.percent(F.lit(n), F.lit(d)), numbers.divide(F.lit(n), F.lit(d))).first()
    assert row[0] == expected
    assert row[1] == (n / d if d else 0.0)


def test_row_hash(spark):
    row = {"a": 'x"y', "b": "é/ü", "c": "", "d": "t\tab\\"}
    payload = json.dumps(list(row.items()), ensure_ascii=False, separators=(",", ":")).encode()
    df = spark.createDataFrame([tuple(row.values())], list(row))
    assert df.select(drops.row_hash(list(row))).first()[0] == hashlib.sha256(payload).hexdigest()
