from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import joins, quality, windows
from lakestrata.operators.calendar import calendar
from lakestrata.operators.cube import distinct_cube, distinct_per, distinct_trailing
from lakestrata.operators.dedupe import first_by_key, keep_first
from lakestrata.operators.keys import kept_keys, surrogate_keys, union_distinct
from lakestrata.operators.occupancy import covered_points, keys_covered_on

DAY = date(2025, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_keep_first_takes_the_earlier_file_and_null_equals_null(spark):
    df = spark.createDataFrame(
        [("a", None, "f_2", 0), ("a", None, "f_1", 9), ("a", None, "f_1", 3), ("b", 1, "f_2", 1), (None, None, "f_3", 0)],
        "k string, v int, source_file string, row_ordinal int",
    )
    once = keep_first(df, ["k", "v"])
    assert rows(once) == rows(spark.createDataFrame([("a", None, "f_1", 3), ("b", 1, "f_2", 1), (None, None, "f_3", 0)], df.schema))
    assert rows(keep_first(once, ["k", "v"])) == rows(once)


def test_keep_first_of_wanted_business_columns_sorts_nothing(spark):
    df = spark.createDataFrame(
        [("a", None, 5, "f_2", 0), ("a", None, 5, "f_1", 9), ("a", 1, 6, "f_1", 3), ("a", 1, 7, "f_1", 4), (None, 1, 7, "f_3", 0)],
        "k string, v int, w int, source_file string, row_ordinal int",
    )
    once = keep_first(df, ["k", "v", "w"], wanted=["k", "v"])
    assert rows(once) == rows(spark.createDataFrame([("a", None), ("a", 1), ("a", 1), (None, 1)], "k string, v int"))
    assert "Sort" not in final_plan(once)
    first = keep_first(df, ["k", "v", "w"], wanted=["k", "source_file"])
    assert rows(first) == rows(spark.createDataFrame([("a", "f_1"), ("a", "f_1"), ("a", "f_1"), (None, "f_3")], "k string, source_file string"))


def test_rows_with_nulls_in_other_places_are_no_copies(spark):
    df = spark.createDataFrame(
        [("x", "d", None, "f", 0), ("x", None, "d", "f", 1), ("x", None, "d", "f", 2)], "k string, a string, b string, source_file string, row_ordinal int"
    )
    assert rows(keep_first(df, ["k", "a", "b"])) == rows(df.filter("row_ordinal < 2"))
    assert tuple(quality.duplicate_report(df, "t", ["k", "a", "b"]).first()) == ("t", 3, 3, 2)


def test_a_duplicate_report_shuffles_no_texts(spark):
    df = spark.createDataFrame([("text", "f_1", 0), ("text", "f_2", 0), ("text", "f_2", 0)], "words string, source_file string, row_ordinal int")
    report = quality.duplicate_report(df, "t", ["words"])
    assert tuple(report.first()) == ("t", 3, 2, 1)
    assert all("words" not in part.splitlines()[0] for part in final_plan(report).split("Exchange")[1:])


def test_first_by_key(spark):
    df = spark.createDataFrame(
        [(1, "late", "f_2", 0), (1, "early", "f_1", 5), (2, None, "f_1", 1), (2, "x", "f_1", 2)],
        "id int, a string, source_file string, row_ordinal int",
    )
    assert rows(first_by_key(df, ["id"], ["a"])) == rows(spark.createDataFrame([(1, "early"), (2, None)], "id int, a string"))


@pytest.mark.parametrize("with_null", [True, False])
def test_surrogate_keys_are_dense_in_id_order(spark, with_null):
    ids = [f"R{i:05d}" for i in range(3000)]
    members = spark.createDataFrame([(i,) for i in random.Random(1).sample(ids, 3000)] + [(None,)] * with_null, "id string")
    keyed = {r.id: r.key for r in surrogate_keys(members.repartition(7), "id", "key").collect()}
    expected = {i: n + 1 for n, i in enumerate(ids)}
    assert keyed == (expected | {None: 0} if with_null else expected)


def test_surrogate_keys_of_nothing(spark):
    empty = surrogate_keys(spark.createDataFrame([], "id string"), "id", "key")
    assert empty.columns == ["id", "key"] and empty.count() == 0


def test_union_distinct(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "k string, n int")
    b = spark.createDataFrame([("y",), ("z",)], "k string")
    assert {r.k for r in union_distinct([a, b], "k").collect()} == {"x", "y", "z", None}


def skewed(spark, n=4000):
    """A third of the rows has one key, another part has none."""
    draw = random.Random(7)
    keys = [draw.choice([1, 1, None, draw.randrange(2, 400)]) for _ in range(n)]
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "full"])
@pytest.mark.parametrize("cut", [False, True])
def test_null_safe_join_equals_a_plain_join(spark, request, how, cut):
    if cut:
        request.getfixturevalue("cut_partitions")
    big = skewed(spark).repartition(6)
    small = spark.createDataFrame([(k, k * 10) for k in range(1, 300)] + [(None, -1), (1, 11), (900, 9)], "k int, v int")
    found = joins.null_safe_join(big, small, ["k"], how)
    plain = big.alias("b").join(small.alias("s"), F.col("b.k").eqNullSafe(F.col("s.k")), how)
    plain = plain.select(F.coalesce("b.k", "s.k").alias("k"), "b.i", "s.v")
    assert found.columns == ["k", "i", "v"]
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, plain.collect()))
    if cut and how != "full":
        assert "skew=true" in final_plan(found)


def test_lookup_key_null_member_and_unknown_id(spark):
    fact = spark.createDataFrame([("a", 1), (None, 2), ("zz", 3)], "id string, n int")
    dim = spark.createDataFrame([("a", "x", 1), (None, "y", 0)], "id string, extra string, key long")
    assert {r.n: r.key for r in joins.lookup_key(fact, dim, "id", "key").collect()} == {1: 1, 2: 0, 3: None}


def leases(spark, seed=3, n=300):
    draw = random.Random(seed)
    spans = []
    for i in range(n):
        unit = draw.choice([1, 1, 1, draw.randrange(2, 12), None])
        start = DAY + timedelta(draw.randrange(0, 200)) if draw.random() > 0.05 else None
        end = None if draw.random() < 0.3 else DAY + timedelta(draw.randrange(0, 260))
        spans.append((unit, draw.choice(["c", "d"]), i, start, end))
    return spans, spark.createDataFrame(spans, "unit int, com string, lease int, start date, end date")


def units(spark):
    points = [(u, c, DAY + timedelta(30 * m)) for u in [1, 2, 3, 4, 20, None] for c in "cd" for m in range(7)]
    return points, spark.createDataFrame(points, "unit int, com string, at date")


def holds(point, span):
    unit, com, at = point
    return unit == span[0] and com == span[1] and None not in (unit, span[3]) and span[3] <= at and (span[4] is None or span[4] >= at)


def test_covered_points_against_brute_force(spark):
    spans, intervals = leases(spark)
    points, asked = units(spark)
    found = covered_points(asked, intervals, ["unit", "com"], "at", "start", "end")
    expected = [(*p, any(holds(p, s) for s in spans)) for p in points]
    assert rows(found) == sorted(expected, key=repr)


@pytest.mark.parametrize("cut", [False, True])
def test_interval_join_against_brute_force(spark, request, cut):
    if cut:
        request.getfixturevalue("cut_partitions")
    spans, intervals = leases(spark)
    points, asked = units(spark)
    found = joins.interval_join(asked, intervals, ["unit", "com"], "at", "start", "end")
    expected = []
    for p in points:
        inside = [(*p, *s[2:]) for s in spans if holds(p, s)]
        expected += inside or [(*p, None, None, None)]
    assert rows(found) == sorted(expected, key=repr)


def test_interval_join_without_points(spark):
    _, intervals = leases(spark)
    none = spark.createDataFrame([], "unit int, com string, at date")
    assert joins.interval_join(none, intervals, ["unit", "com"], "at", "start", "end").count() == 0


def test_month_aligned_join(spark):
    events = spark.createDataFrame([(1, DAY), (1, DAY + timedelta(40)), (None, DAY), (2, None)], "k int, at date")
    snaps = spark.createDataFrame([(1, date(2025, 1, 31), "a"), (1, date(2025, 3, 31), "b"), (None, date(2025, 1, 31), "c")], "k int, last date, v string")
    found = joins.month_aligned_join(events, snaps, ["k"], "at", "last")
    assert rows(found) == [(1, DAY, date(2025, 1, 31), "a")]


def calendar_of(spark, first, last):
    bounds = spark.createDataFrame([(first, last)], "a date, b date")
    return calendar(bounds, "a", "b")


@pytest.mark.parametrize("unit", ["month", "day"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rolling_distinct_against_brute_force(spark, unit, seed):
    draw = random.Random(seed)
    seen = [
        (draw.choice("ab"), draw.choice([1, 1, draw.randrange(2, 30), None]), DAY + timedelta(draw.choice([draw.randrange(0, 40), draw.randrange(0, 400)])))
        for _ in range(120)
    ]
    seen += [("a", 1, None), (None, 3, DAY), ("c", 1, None)]
    first, last = date(2025, 2, 10), date(2025, 12, 30)
    df = spark.createDataFrame(seen, "g string, k int, d date")
    reports = windows.report_dates(calendar_of(spark, first, last), unit)
    found = windows.rolling_distinct(df, "k", "d", ["g"], "n", reports)
    expected = []
    for n in range((last - first).days + 1):
        at = first + timedelta(n)
        if unit == "month" and at != last and (at + timedelta(1)).day != 1:
            continue
        for g in ("a", "b", "c", None):
            keys = {k for h, k, d in seen if h == g and k and d and at - timedelta(90) < d <= at}
            expected.append((g, at, len(keys)))
    assert rows(found) == sorted(expected, key=repr)


def test_rolling_distinct_without_groups(spark):
    df = spark.createDataFrame([(1, DAY), (2, DAY + timedelta(1))], "k int, d date")
    reports = windows.report_dates(calendar_of(spark, DAY, DAY + timedelta(91)))
    counts = {r.report_date: r.n for r in windows.rolling_distinct(df, "k", "d", [], "n", reports).collect()}
    assert counts[DAY] == 1 and counts[DAY + timedelta(89)] == 2 and counts[DAY + timedelta(90)] == 1
    assert counts[DAY + timedelta(91)] == 0 and len(counts) == 92


def test_share_and_top(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 3), ("a", "z", 1), ("b", "x", 5)], "g string, r string, n int")
    shares = windows.share_of_total(df, ["g"], "n", "share")
    top = windows.top_k(shares, ["g"], [F.desc("n"), F.asc("r")], 2).select("g", "r", "share", "rank")
    assert rows(top) == [("a", "x", 42.86, 1), ("a", "y", 42.86, 2), ("b", "x", 100.0, 1)]


def test_rules_let_missing_values_pass(spark):
    df = spark.createDataFrame(
        [(1, DAY, DAY, "Won", "12.5"), (9, DAY, DAY - timedelta(1), "No", "x"), (None, None, DAY, None, "")],
        "r int, a date, b date, s string, t string",
    )
    broken = (
        quality.not_null(["a"]) | quality.in_range("r", 1, 5) | quality.in_set("s", ["Won"])
        | quality.ordered_dates([("a", "b")]) | quality.typed({"t": "decimal(4,2)", "s": "varchar(2)"})
    )
    found = {r.rule: r.violations for r in quality.count_violations(df, "t", broken).collect()}
    assert found == {
        "a is null": 1, "r out of range": 1, "s not allowed": 1, "b before a": 1,
        "t is no decimal(4,2)": 1, "s is no varchar(2)": 1,
    }
    bad = quality.quarantine(df, broken)
    assert sorted(len(r.broken_rules) for r in bad.collect()) == [1, 1, 4]


def test_keys_rules(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "a"), (None, "a"), (7, "a")], "k int, v string")
    assert tuple(quality.unique_violations(df, "t", ["k"]).first())[2:] == (1, 1)
    dim = spark.createDataFrame([(1,), (2,)], "id int")
    assert quality.foreign_key_violations(df, "t", "k", dim, "id").first().violations == 1
    assert rows(quality.conflicting_keys(df.filter("k is not null"), "k", ["v"])) == [(1, 2, 2)]
    report = quality.duplicate_report(df, "t", ["v"]).first()
    assert tuple(report) == ("t", 6, 5, 2)


def test_date_column_report(spark):
    df = spark.createDataFrame([("2025-01-01", "", "2025-01-01"), ("", "N/A", "x")], "a string, b string, c string")
    assert [r.kind for r in quality.date_column_report(df, ["a", "b", "c"]).collect()] == ["date", "text", "text"]


def test_domain_overlap_and_unexpected(spark):
    a = spark.createDataFrame([("E10104",), ("E10104",), ("E10105",), (None,)], "employee_id string")
    b = spark.createDataFrame([("E1000",), ("E10105",)], "reported_by string")
    assert [tuple(r) for r in quality.domain_overlap(a, "employee_id", b, "reported_by").collect()] == [
        ("employee_id", 3, 2, 6, 6, 1), ("reported_by", 2, 2, 5, 6, 1)
    ]
    assert rows(quality.unexpected_members(a, "employee_id", ["E10105"])) == [("E10104", 2)]


def test_reconcile_columns(spark):
    raw = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "dataset string, column string")
    stored = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "z")], "dataset string, column string")
    assert {r.dataset: r.column_check for r in quality.reconcile_columns(raw, stored).collect()} == {"a": "FAIL", "b": "PASS"}


def test_reconcile(spark):
    raw = spark.createDataFrame([("a",), ("a",), ("b",)], "dataset string")
    stored = spark.createDataFrame([("a",), ("a",), ("c",)], "dataset string")
    assert {r.dataset: r.row_check for r in quality.reconcile(raw, stored).collect()} == {"a": "PASS", "b": "FAIL", "c": "FAIL"}


def test_keys_stay_when_members_come_and_go(spark):
    def members(*found):
        return spark.createDataFrame(found, "id string, role string").repartition(3)

    first = kept_keys(members(("b", "x"), ("d", "y"), ("f", None)), "id", "key", None)
    assert rows(first) == [("b", "x", 1), ("d", "y", 2), ("f", None, 3)]
    second = kept_keys(members(("a", "n"), ("d", "changed"), ("z", "n"), (None, "nobody")), "id", "key", first)
    expected = [(None, "nobody", 0), ("a", "n", 4), ("b", "x", 1), ("d", "changed", 2), ("f", None, 3), ("z", "n", 5)]
    assert rows(second) == sorted(expected, key=repr)
    # A null id that is known keeps key 0 and counts no further.
    third = kept_keys(members(("c", "n"), (None, "again")), "id", "key", second)
    assert {("c", "n", 6), (None, "again", 0), ("b", "x", 1)} <= set(rows(third)) and len(rows(third)) == 7
    assert rows(kept_keys(members(("a", "n")).limit(0), "id", "key", first)) == rows(first)


def test_distinct_cube_answers_periods_and_windows(spark):
    draw = random.Random(5)
    seen = [
        (draw.choice([1, 2, None]), draw.choice([0, 7, 32_767, 32_768, 100_000, None]), draw.choice([DAY + timedelta(days=draw.randrange(200)), None]))
        for _ in range(400)
    ]
    df = spark.createDataFrame(seen, "g int, k long, day date")
    cube = distinct_cube(df, "k", "day", ["g"])
    known = [(g, k, d) for g, k, d in seen if k is not None and d is not None]

    months = {}
    for g, k, d in known:
        months.setdefault((g, d.replace(day=1)), set()).add(k)
    found = distinct_per(cube, ["g", F.trunc("day", "month").alias("m")], "n")
    assert rows(found) == sorted(((g, m, len(k)) for (g, m), k in months.items()), key=repr)
    assert rows(distinct_per(cube, ["g"], "n")) == sorted(
        ((g, len({k for h, k, _ in known if h == g})) for g in {g for g, _, _ in known}), key=repr
    )
    reports = [DAY + timedelta(days=n) for n in (0, 30, 89, 120, 400)]
    dates = spark.createDataFrame([(d,) for d in reports], "report_date date")
    expected = [
        (g, r, len({k for h, k, d in known if h == g and timedelta(0) <= r - d < timedelta(days=90)}))
        for g in {g for g, _, _ in known} for r in reports
    ]
    assert rows(distinct_trailing(cube, ["g"], dates, "n")) == sorted(expected, key=repr)


def test_keys_covered_on_equals_counting_at_each_date(spark):
    draw = random.Random(3)

    def day(null=0.1):
        return None if draw.random() < null else DAY + timedelta(days=draw.randrange(40))

    spans = [(draw.choice([1, None]), draw.choice([1, 2, 3, None]), day(), day(0.2)) for _ in range(80)]
    asked = [(g, DAY + timedelta(days=n)) for g in (1, None, 9) for n in range(-2, 45, 3)] + [(1, None)]
    found = keys_covered_on(
        spark.createDataFrame(spans, "g int, k int, s date, e date"), ["g"], "k", "s", "e",
        spark.createDataFrame(asked, "g int, at date"), "at", "n",
    )

    def count(g, at):
        return len({k for h, k, s, e in spans if h == g and k is not None and s and at and s <= at and (e is None or e >= at)})

    assert rows(found) == sorted(((g, at, count(g, at)) for g, at in asked), key=repr)


def test_the_sweep_writes_rows_by_spans_and_dates(spark):
    """One unit leased anew each day, asked for on every day: no pairs of leases and days."""
    n = 300
    spans = spark.range(n).select(F.lit(1).alias("g"), F.lit(1).alias("k"), F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("s"))
    spans = spans.withColumn("e", F.date_add("s", 200))
    dates = spans.select("g", F.col("s").alias("at"))
    found = keys_covered_on(spans, ["g"], "k", "s", "e", dates, "at", "n")
    assert rows(found.groupBy("n").count()) == [(1, n)]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_quarantine_table_names_every_broken_rule(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 5), ("b", 9, 5), (None, 1, 5), ("c", None, 99), ("d", 1, 1)], "id string, fk int, v int"
    )
    dim = spark.createDataFrame([(1,), (2,)], "key int")
    counts = quality.key_counts(df, {"id": ["id"], "fk": ["fk"]})
    broken = quality.not_null(["id", "fk"]) | quality.in_range("v", 2, 10)
    apart = quality.quarantine_table(df, broken, counts, [("id",)], [("fk", dim, "key")])
    assert {(r.id, r.fk): r.broken_rules for r in apart.collect()} == {
        ("a", 1): ["unique (id)"], ("a", 2): ["unique (id)"], ("b", 9): ["fk in dimension"], (None, 1): ["id is null"],
        ("c", None): ["fk is null", "v out of range"], ("d", 1): ["v out of range"],
    }
    assert quality.quarantine_table(df, {}, counts).count() == 0
    many = {f"rule {i}": F.col("v") > i for i in range(70)}
    assert {len(r.broken_rules) for r in quality.quarantine_table(df, many, counts).collect()} == {1, 5, 70}


def test_reconciliation_sees_changed_cells_and_not_the_order(spark):
    rows_ = [("1", "a"), ("2", None), ("3", "c")]

    def side(found):
        df = spark.createDataFrame(found, "k string, v string").repartition(2)
        return df.agg(F.lit("d").alias("dataset"), *quality.fingerprint(df, ["k", "v"]))

    def check(found):
        return quality.reconcile_content(side(rows_), side(found)).first().content_check

    assert check([("3", "c"), ("1", "a"), ("2", "")]) == "PASS"
    for other in ([("1", "b"), ("2", ""), ("3", "c")], [("1", "a"), ("1", "a"), ("3", "c")], [("1", "c"), ("2", ""), ("3", "a")], rows_[:2], [("1a", ""), *rows_[1:]]):
        assert check(other) == "FAIL", other


def test_snapshots_laid_out_by_an_explode_are_not_broadcast(spark):
    """Spark counts no rows that an explode makes: it takes these snapshots for a few hundred bytes."""
    events = spark.sql("SELECT id AS k, DATE '2024-01-05' AS at FROM range(30)")
    snaps = spark.sql("SELECT id AS k, explode(sequence(DATE '2024-01-31', DATE '2026-01-31', INTERVAL 1 MONTH)) AS last FROM range(30)")
    found = joins.month_aligned_join(events, snaps, ["k"], "at", "last")
    assert Counter(row.k for row in found.collect()) == Counter(range(30))
    assert "SortMergeJoin" in final_plan(found) and "Broadcast" not in final_plan(found)


def test_rules_of_distinct_rows_shuffle_flags_alone(spark):
    rows = spark.createDataFrame([(1, 9, "x"), (1, 9, "x"), (2, 9, "y"), (3, 1, "z"), (4, None, "z")], "h long, n int, words string")
    rules = quality.in_range("n", 1, 5) | quality.not_null(["n"])
    found = quality.count_distinct_violations(rows, ["h"], "t", rules)
    assert {(row.rule, row.violations) for row in found.collect()} == {("n out of range", 2), ("n is null", 1)}
    assert "words" not in final_plan(found).split("Exchange")[1].splitlines()[0] and "Sort" not in final_plan(found)


def generated_rows(node) -> int:
    """Rows which the explodes of a plan that has run have made."""
    own = node.metrics().apply("numOutputRows").value() if node.nodeName() == "Generate" else 0
    return own + sum(generated_rows(node.children().apply(i)) for i in range(node.children().size()))


def test_an_interval_is_not_laid_on_every_month(spark, no_broadcast):
    """Ten years with a point in each month: an interval without an end is written once, not 120 times."""
    points = spark.sql("SELECT 1 AS unit, explode(sequence(DATE '2020-01-31', DATE '2029-12-31', INTERVAL 1 MONTH)) AS at")
    points = spark.createDataFrame(points.collect(), points.schema)
    intervals = spark.sql("SELECT 1 AS unit, id AS lease, DATE '2020-01-01' AS start, CAST(NULL AS DATE) AS end FROM range(5)")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = joins.interval_join(points, intervals, ["unit"], "at", "start", "end")
        assert len(found.collect()) == 5 * 120
        assert generated_rows(found._jdf.queryExecution().executedPlan()) == 5
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_sweeps_with_equal_points_open_ends_and_turns_on_one_day(spark):
    """Equal points are one, a key that is left and taken on one day stays covered."""
    days = [DAY + timedelta(n) for n in range(6)]
    spans = spark.createDataFrame(
        [(1, days[1], days[2]), (1, days[3], days[3]), (1, days[3], days[3]), (2, days[4], None), (None, days[0], None), (3, days[2], days[1])],
        "k int, s date, e date",
    )
    asked = [(k, d) for k in (1, 2, 3, None) for d in [*days, None]]
    points = spark.createDataFrame(asked * 2, "k int, at date")
    taken = {(1, d) for d in days[1:4]} | {(2, d) for d in days[4:]}
    assert rows(covered_points(points, spans, ["k"], "at", "s", "e")) == sorted(((*p, p in taken) for p in asked), key=repr)
    dates = spark.createDataFrame([(d,) for d in days], "at date")
    found = keys_covered_on(spans, [], "k", "s", "e", dates, "at", "n")
    assert rows(found) == sorted(((d, sum((k, d) in taken for k in (1, 2))) for d in days), key=repr)
