"""Records with line breaks in cells, read in small blocks, against the reader that takes a file as one."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lakestrata.sources import drops, records

COLUMNS = ["id", "note", "more"]


@pytest.fixture
def small_blocks(spark):
    small = {"spark.sql.files.maxPartitionBytes": "64b", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {name: spark.conf.get(name, None) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def write(folder, texts) -> list[str]:
    for i, text in enumerate(texts):
        (folder / f"x_{i}.csv").write_bytes(text.encode())
    return sorted(str(p) for p in folder.glob("*.csv"))


def cells(df) -> list:
    return sorted((tuple(r)[: len(COLUMNS)] for r in df.collect()), key=repr)


def whole_file_reader(spark, paths) -> list:
    reader = spark.read.schema(", ".join(f"{c} string" for c in COLUMNS)).option("header", "true").option("escape", '"')
    rows = reader.option("multiLine", "true").csv(paths)
    return cells(rows.select(*[F.coalesce(c, F.lit("")) for c in COLUMNS]))


def test_random_files_equal_the_whole_file_reader(spark, tmp_path, small_blocks):
    draw = random.Random(7)
    inner = ["a", "b c", '""', "\n", "\n\n", ",", "é漢", "x" * 90, '""\n""', " ", "'"]

    def cell():
        kind = draw.random()
        if kind < 0.5:
            return '"' + "".join(draw.choice(inner) for _ in range(draw.randrange(5))) + '"'
        return draw.choice(["", "plain", "7", 'in"ner', "a b", '5" pipe'])

    texts = []
    for n in (0, 1, 40, 90):
        lines = [",".join(COLUMNS)] + [f"{i},{cell()},{cell()}" for i in range(n)]
        texts.append("\n".join(lines) + draw.choice(["", "\n"]))
    paths = write(tmp_path, texts)
    found = drops.scan_text(spark, paths, COLUMNS, multiline=True)
    assert cells(found) == whole_file_reader(spark, paths)
    assert records.block_states(spark, paths).count() > 30


def test_bom_carriage_returns_and_a_cell_longer_than_blocks(spark, tmp_path, small_blocks):
    long = "\n".join(f'line ""{i}"", and more' for i in range(60))
    text = "﻿id,note,more\r\n" + f'1,"{long}",z\r\n2,"a\r\nb",\r\n\r\n3,"said ""x""",y\r\n'
    paths = write(tmp_path, [text])
    rows = drops.scan_text(spark, paths, COLUMNS, multiline=True)
    expected = [("1", long.replace('""', '"'), "z"), ("2", "a\r\nb", ""), ("3", 'said "x"', "y")]
    assert cells(rows) == sorted(expected, key=repr)
    # In the order of the file.
    assert [r.id for r in rows.orderBy("row_ordinal").collect()] == ["1", "2", "3"]
    scanned = records.lines(spark, paths)
    assert scanned.select("block").distinct().count() > 20 and scanned.rdd.getNumPartitions() > 3
    states = records.block_states(spark, paths)
    (extract,) = drops.read_headers(spark, paths, states).values()
    assert extract == (tuple(COLUMNS), 3)


def test_a_file_that_ends_inside_a_cell(spark, tmp_path, small_blocks):
    paths = write(tmp_path, ['id,note,more\n1,a,b\n2,"open\n' + "and on\n" * 30, 'id,note,more\n3,c,d\n'])
    rows = {r.id: r for r in drops.scan_text(spark, paths, COLUMNS, multiline=True).collect()}
    assert set(rows) == {"1", "2", "3"} and rows["2"].note.startswith("open\nand on")


def test_shuffled_lines_give_the_same_records(spark, tmp_path, small_blocks, monkeypatch):
    """Beyond the bound of the broadcast, lines are joined with their blocks by a shuffle."""
    paths = write(tmp_path, ["id,note,more\n" + "\n".join(f'{i},"a\n{i}\n""b""",c' for i in range(60))] * 2)
    expected = cells(drops.scan_text(spark, paths, COLUMNS, multiline=True))
    assert len(expected) == 120
    monkeypatch.setattr(records, "MOST_BROADCAST", 0)
    assert cells(drops.scan_text(spark, paths, COLUMNS, multiline=True)) == expected


def test_ends_inside():
    cases = {
        "a,b": False, '"a': True, '"a"': False, '"a""': True, 'a,"b': True, 'a"b,c': False, '"a"x,"b': True, '"a"x"b': False, "": False,
    }
    for line, state in cases.items():
        assert records.ends_inside(line, False) is state, line
        assert records.ends_inside(line, True) is records.ends_inside('"' + line, False), line


def test_rows_of_other_headers_and_too_many_cells(spark, tmp_path, small_blocks):
    (tmp_path / "shop_items_2025_01.csv").write_text('id,note\n1,"two\nlines"\n2,x,"one\ntoo many"\n')
    (tmp_path / "shop_items_2025_02.csv").write_text('note,id\n"three\n\nlines",3\n')
    paths = drops.discover(spark, str(tmp_path))["shop_items"]
    rows = drops.read_dataset(spark, "shop_items", paths, str(tmp_path), "batch", "now", True)
    good = rows.filter(F.col(drops.CORRUPT).isNull()).orderBy("id").collect()
    assert [(r.id, r.note, r.source_file) for r in good] == [
        ("1", "two\nlines", "shop_items_2025_01.csv"), ("3", "three\n\nlines", "shop_items_2025_02.csv")
    ]
    (bad,) = rows.filter(F.col(drops.CORRUPT).isNotNull()).collect()
    assert bad[drops.CORRUPT] == '2,x,"one\ntoo many"'
