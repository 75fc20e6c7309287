"""Data quality: rules as counts of violations, anomaly reports and layer reconciliation.

The single-row rules of a table are one aggregate, however many there are. Unique keys and foreign
keys need the rows of a key together, so each costs a shuffle of (key, count) pairs; a fact's
columns for all of them are read in one scan (``key_counts``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.dates import mixed_date
from lakestrata.functions.text import is_blank
from lakestrata.operators.dedupe import ROW_HASHES, with_row_hashes


def count_violations(df: DataFrame, table: str, broken: Mapping[str, Column]) -> DataFrame:
    """``(table, rule, violations)`` for conditions which are true where a rule is broken."""
    sums = [
        F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long").alias(rule)
        for rule, condition in broken.items()
    ]
    counted = df.agg(*sums)
    rows = [
        F.struct(F.lit(table).alias("table"), F.lit(rule).alias("rule"), F.col(f"`{rule}`").alias("violations"))
        for rule in broken
    ]
    return counted.select(F.inline(F.array(*rows)))


def count_distinct_violations(
    df: DataFrame, same: Sequence[str], table: str, broken: Mapping[str, Column]
) -> DataFrame:
    """``count_violations`` of distinct rows: rows that are equal in ``same`` are copies and count once.

    Rules are judged before the shuffle, so of a row only ``same`` and a flag per rule go through it.
    """
    flags = {rule: f"_rule{i}" for i, rule in enumerate(broken)}
    judged = df.select(*same, *[F.coalesce(broken[rule], F.lit(False)).alias(flag) for rule, flag in flags.items()])
    rows = judged.groupBy(*same).agg(*[F.max(flag).alias(flag) for flag in flags.values()])
    return count_violations(rows, table, {rule: F.col(flag) for rule, flag in flags.items()})


def quarantine(df: DataFrame, broken: Mapping[str, Column]) -> DataFrame:
    """Rows which break at least one rule, with the names of the rules they break."""
    names = [F.when(condition, F.lit(rule)) for rule, condition in broken.items()]
    marked = df.withColumn("broken_rules", F.array_compact(F.array(*names)))
    return marked.filter(F.size("broken_rules") > 0)


def quarantine_table(
    df: DataFrame,
    broken: Mapping[str, Column],
    counts: DataFrame,
    unique: Sequence[Sequence[str]] = (),
    references: Sequence[tuple[str, DataFrame, str]] = (),
) -> DataFrame:
    """Rows which break any rule of a table, with the names of all rules they break.

    The single-row rules are one bit mask per row. ``counts`` are the table's ``key_counts``; of
    them only the keys that are repeated, or missing in their dimension (column, dimension and its
    column), are joined to the rows, so rows of sound keys meet nothing. All rows of a repeated key
    are set apart, also the first.
    """
    names = list(broken)
    words = [names[i : i + _MASK_BITS] for i in range(0, len(names), _MASK_BITS)]
    masks = {}
    for w, part in enumerate(words):
        bits = [F.when(broken[name], F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, name in enumerate(part)]
        masks[f"__mask{w}"] = reduce(Column.__add__, bits)
    marked = df.withColumns(masks) if masks else df

    rules: list[tuple[str, list[str], DataFrame]] = []
    for key in unique:
        wrong = counts.filter((F.col("name") == _key_name(key)) & (F.col("n") > 1)).select("key")
        rules.append((f"unique ({_key_name(key)})", list(key), wrong))
    for column, dim, dim_column in references:
        wrong = unknown_keys(counts, column, dim, dim_column).select(F.array("k").alias("key"))
        rules.append((f"{column} in dimension", [column], wrong))
    flags = []
    for i, (name, columns, wrong) in enumerate(rules):
        flag = f"__key{i}"
        side = wrong.select(F.col("key").alias(f"__k{i}"), F.lit(True).alias(flag))
        own = F.array(*[F.col(c).cast("string") for c in columns])
        marked = marked.join(side, own == F.col(f"__k{i}"), "left").drop(f"__k{i}")
        flags.append((name, F.col(flag)))
    found = [
        F.when(F.col(f"__mask{w}").bitwiseAND(F.lit(1 << i)) != 0, F.lit(name))
        for w, part in enumerate(words) for i, name in enumerate(part)
    ]
    found += [F.when(flag, F.lit(name)) for name, flag in flags]
    any_row = [F.col(f"__mask{w}") != 0 for w in range(len(words))] + [F.coalesce(flag, F.lit(False)) for _, flag in flags]
    if not any_row:
        return df.withColumn("broken_rules", F.array().cast("array<string>")).filter(F.lit(False))
    apart = marked.filter(reduce(Column.__or__, any_row))
    return apart.select(*df.columns, F.array_compact(F.array(*found)).alias("broken_rules"))


#: Rules in one number.
_MASK_BITS = 62


def not_null(columns: Sequence[str]) -> dict[str, Column]:
    return {f"{c} is null": F.col(c).isNull() for c in columns}


def in_range(column: str, low, high=None) -> dict[str, Column]:
    c = F.col(column)
    outside = c < low if high is None else (c < low) | (c > high)
    return {f"{column} out of range": outside}


def in_set(column: str, allowed: Sequence) -> dict[str, Column]:
    return {f"{column} not allowed": ~F.col(column).isin(*allowed)}


def ordered_dates(pairs: Sequence[tuple[str, str]]) -> dict[str, Column]:
    """Each pair is (earlier, later); a missing date breaks nothing."""
    return {f"{later} before {earlier}": F.col(later) < F.col(earlier) for earlier, later in pairs}


def typed(types: Mapping[str, str]) -> dict[str, Column]:
    """Texts which do not fit a declared type: ``varchar(n)`` by length, others by a safe cast.

    A decimal which needs rounding to its scale fits, one with too many whole digits does not.
    """
    broken = {}
    for column, declared in types.items():
        c = F.col(column)
        if declared.startswith("varchar("):
            broken[f"{column} is no {declared}"] = F.length(c) > int(declared[8:-1])
        else:
            broken[f"{column} is no {declared}"] = ~is_blank(c) & c.try_cast(declared).isNull()
    return broken


def unique_violations(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """How many key values occur more than once, and how many rows are too many.

    Keys with a NULL part are not compared, as in SQL.
    """
    return unique_report(key_counts(df, {_key_name(key): list(key)}), table, key)


def foreign_key_violations(
    df: DataFrame, table: str, column: str, dim: DataFrame, dim_column: str
) -> DataFrame:
    """Rows whose non-null ``column`` is missing in the dimension.

    Rows are counted per key before the anti join, so a key with many rows is one row there.
    """
    return foreign_report(key_counts(df, {column: [column]}), table, column, dim, dim_column)


def _key_name(key: Sequence[str]) -> str:
    return ", ".join(key)


def key_counts(df: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """``name, key, n``: rows per value of several keys, from one scan of ``df``.

    A key is the array of its columns as text; keys with a NULL part are left out. Each row is
    expanded to one short row per key, which partial aggregation reduces before the shuffle.
    """
    parts = [
        F.struct(F.lit(name).alias("name"), F.array(*[F.col(c).cast("string") for c in columns]).alias("key"))
        for name, columns in keys.items()
    ]
    expanded = df.select(F.inline(F.array(*parts)))
    known = F.forall("key", lambda x: x.isNotNull())
    return expanded.filter(known).groupBy("name", "key").agg(F.count("*").alias("n"))


def unique_report(counts: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    repeated = counts.filter((F.col("name") == _key_name(key)) & (F.col("n") > 1))
    return repeated.agg(
        F.lit(table).alias("table"),
        F.lit(f"unique ({_key_name(key)})").alias("rule"),
        F.count("*").alias("violations"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("extra_rows"),
    )


def unknown_keys(counts: DataFrame, column: str, dim: DataFrame, dim_column: str) -> DataFrame:
    """``k, n``: values of the column, as text, which the dimension lacks, and their rows."""
    per_key = counts.filter(F.col("name") == column).select(F.col("key")[0].alias("k"), "n")
    members = dim.select(F.col(dim_column).cast("string").alias("k")).distinct()
    return per_key.join(members, "k", "left_anti")


def foreign_report(counts: DataFrame, table: str, column: str, dim: DataFrame, dim_column: str) -> DataFrame:
    return unknown_keys(counts, column, dim, dim_column).agg(
        F.lit(table).alias("table"),
        F.lit(f"{column} in dimension").alias("rule"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("violations"),
    )


def date_column_report(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Which text columns are dates: at least one non-blank value and all of them parse."""
    sums = []
    for c in candidates:
        filled = ~is_blank(F.col(c))
        sums += [
            F.sum(filled.cast("long")).alias(f"{c}|filled"),
            F.sum((filled & mixed_date(F.col(c)).isNotNull()).cast("long")).alias(f"{c}|parsed"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"`{c}|filled`").alias("filled"),
            F.col(f"`{c}|parsed`").alias("parsed"),
            F.when((F.col(f"`{c}|filled`") > 0) & (F.col(f"`{c}|filled`") == F.col(f"`{c}|parsed`")), "date")
            .otherwise("text")
            .alias("kind"),
        )
        for c in candidates
    ]
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def domain_overlap(left: DataFrame, left_id: str, right: DataFrame, right_id: str) -> DataFrame:
    """Per side: rows, distinct ids, id lengths and how many ids the other side also has."""
    lefts = left.filter(F.col(left_id).isNotNull()).groupBy(F.col(left_id).alias("id")).agg(F.count("*").alias("left_rows"))
    rights = right.filter(F.col(right_id).isNotNull()).groupBy(F.col(right_id).alias("id")).agg(F.count("*").alias("right_rows"))
    counted = lefts.join(rights, "id", "full").agg(
        *_side("left", F.col("left_rows"), F.col("right_rows")),
        *_side("right", F.col("right_rows"), F.col("left_rows")),
    )
    names = ("id_rows", "distinct_ids", "shortest", "longest", "shared_ids")
    rows = [
        F.struct(F.lit(label).alias("side"), *[F.col(f"{side}_{n}").alias(n) for n in names])
        for side, label in (("left", left_id), ("right", right_id))
    ]
    return counted.select(F.inline(F.array(*rows)))


def _side(side: str, rows: Column, other: Column) -> list[Column]:
    length = F.when(rows.isNotNull(), F.length("id"))
    shared = F.when(rows.isNotNull() & other.isNotNull(), 1)
    return [
        F.coalesce(F.sum(rows), F.lit(0)).cast("long").alias(f"{side}_id_rows"),
        F.count(rows).alias(f"{side}_distinct_ids"),
        F.min(length).alias(f"{side}_shortest"),
        F.max(length).alias(f"{side}_longest"),
        F.count(shared).alias(f"{side}_shared_ids"),
    ]


def duplicate_report(df: DataFrame, table: str, business: Sequence[str]) -> DataFrame:
    """Rows, distinct rows with all columns, and distinct rows without the metadata columns.

    Three numbers from one pass: rows collapse to distinct rows, those to business rows. Hashes
    stand for both, so no text is shuffled.
    """
    hashed = with_row_hashes(with_row_hashes(df, business), df.columns, ("_w1", "_w2"))
    whole = hashed.groupBy(*ROW_HASHES, "_w1", "_w2").agg(F.count("*").alias("_rows"))
    business_rows = whole.groupBy(*ROW_HASHES).agg(F.sum("_rows").alias("_rows"), F.count("*").alias("_whole"))
    return business_rows.agg(
        F.lit(table).alias("table"),
        F.sum("_rows").cast("long").alias("all_rows"),
        F.sum("_whole").cast("long").alias("distinct_with_metadata"),
        F.count("*").alias("distinct_without_metadata"),
    )


def unexpected_members(df: DataFrame, column: str, expected: Sequence[str]) -> DataFrame:
    """Members outside the expected list, with their row counts."""
    return (
        df.groupBy(column)
        .agg(F.count("*").alias("row_count"))
        .filter(~F.col(column).isin(*expected))
    )


def conflicting_keys(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Ids which occur with more than one combination of attribute values."""
    versions = df.groupBy(key, *attributes).agg(F.count("*").alias("n"))
    return (
        versions.groupBy(key)
        .agg(F.count("*").alias("versions"), F.sum("n").alias("row_count"))
        .filter("versions > 1")
    )


def format_census(df: DataFrame, column: str) -> DataFrame:
    """How many values have which shape: digits become 9, letters A, outer blanks are marked."""
    text = F.col(column)
    shape = F.regexp_replace(F.regexp_replace(text, "[0-9]", "9"), "[A-Za-z]", "A")
    return df.groupBy(F.coalesce(shape, F.lit("(null)")).alias("shape")).agg(F.count("*").alias("row_count"))


def reconcile(raw: DataFrame, stored: DataFrame, column: str = "dataset") -> DataFrame:
    """Row counts per dataset on both sides; PASS where both have the dataset and agree."""
    left = raw.groupBy(column).agg(F.count("*").alias("raw_rows"))
    right = stored.groupBy(column).agg(F.count("*").alias("stored_rows"))
    return reconcile_counts(left, right, column)


def reconcile_counts(raw: DataFrame, stored: DataFrame, column: str = "dataset") -> DataFrame:
    both = raw.join(stored, column, "full")
    same = F.coalesce(F.col("raw_rows") == F.col("stored_rows"), F.lit(False))
    return both.withColumn("row_check", F.when(same, "PASS").otherwise("FAIL"))


def fingerprint(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Aggregates which tell two multisets of rows apart, whatever their order: the number of rows
    and two sums of parts of a hash of each row. A null cell is an empty one, as in an extract, and
    so are those of a column which ``df`` lacks.

    A cell's length stands before it, so that no two rows are joined to the same text.
    """
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c in df.columns else F.lit("") for c in columns]
    text = F.concat(*[F.concat(F.octet_length(c).cast("string"), F.lit(":"), c) for c in cells])
    digest = F.md5(text.cast("binary"))
    parts = [F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)") for at in (1, 18)]
    sums = [F.coalesce(F.sum(p), F.lit(0)).cast("decimal(38,0)").cast("string") for p in parts]
    return [F.count(F.lit(1)).alias("rows"), F.concat_ws("/", *sums).alias("content")]


def reconcile_content(raw: DataFrame, stored: DataFrame) -> DataFrame:
    """``dataset, raw_rows, stored_rows, content, row_check, content_check`` of ``dataset, rows,
    content`` on either side. The content is a PASS where both sides hold the same rows: a changed
    row is a FAIL also if the number of rows stays. ``content`` is that of the stored side."""
    left = raw.select("dataset", F.col("rows").alias("raw_rows"), F.col("content").alias("__raw"))
    right = stored.select("dataset", F.col("rows").alias("stored_rows"), "content")
    both = left.join(right, "dataset", "full")
    checks = {"row_check": F.col("raw_rows") == F.col("stored_rows"), "content_check": F.col("__raw") == F.col("content")}
    return both.withColumns(
        {name: F.when(F.coalesce(same, F.lit(False)), "PASS").otherwise("FAIL") for name, same in checks.items()}
    ).drop("__raw")


def reconcile_columns(raw: DataFrame, stored: DataFrame) -> DataFrame:
    """``dataset, column_check``: whether every column of the extracts (``dataset, column``) was
    stored. A dataset which was not stored at all fails."""
    kept = stored.select("dataset", "column").distinct().withColumn("is_stored", F.lit(True))
    found = raw.select("dataset", "column").distinct().join(kept, ["dataset", "column"], "left")
    missing = F.count_if(F.col("is_stored").isNull())
    return found.groupBy("dataset").agg(F.when(missing == 0, "PASS").otherwise("FAIL").alias("column_check"))
