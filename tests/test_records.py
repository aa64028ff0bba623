"""CSV records with line breaks in quotes, cut into blocks of any size."""

import csv
import random
from collections import Counter

import pytest

from tallyhouse.sources import records
from tallyhouse.sources.raw import RAW_COLUMNS, LoadError, check_input, read_raw, write_landing

SPLIT = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture
def blocks(spark):
    """Set the block size of file scans for one test."""
    before = {k: spark.conf.get(k) for k in SPLIT}

    def cut(size):
        for k, v in SPLIT.items():
            spark.conf.set(k, v or str(size))

    yield cut
    for k, v in before.items():
        spark.conf.set(k, v)


def landing(folder, files, ends="\n", header=RAW_COLUMNS):
    folder.mkdir(exist_ok=True)
    for i, rows in enumerate(files):
        with open(folder / f"{i}.csv", "w", newline="") as f:
            csv.writer(f, lineterminator=ends).writerows([header, *rows])
    return str(folder)


def awkward(seed, n):
    rng = random.Random(seed)

    def text():
        return "x" + "".join(rng.choice('ab,"\n\r \t\\é') for _ in range(rng.randrange(9))) + "x"

    rows = [tuple(text() for _ in RAW_COLUMNS) for _ in range(n)]
    rows[n // 2] = tuple(RAW_COLUMNS)
    rows[n // 3] = ("x" + "\n" * 400 + "x", *rows[n // 3][1:])
    return rows


@pytest.mark.parametrize("size", [1 << 27, 400, 61])
def test_any_block_size_gives_the_same_records(spark, blocks, tmp_path, size):
    rows = awkward(size, 60)
    path = landing(tmp_path / "a", [rows[:40], rows[40:]], "\r\n" if size == 400 else "\n")
    blocks(size)
    assert Counter(map(tuple, read_raw(spark, path).collect())) == Counter(rows)
    assert read_raw(spark, path).filter("tax IS NOT NULL").count() == 60


def test_more_blocks_than_are_listed(spark, blocks, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "MOST_LISTED", 3)
    blocks(100)
    rows = awkward(4, 40)
    assert Counter(map(tuple, read_raw(spark, landing(tmp_path / "a", [rows])).collect())) == Counter(rows)
    plain = [tuple(str(i) for _ in RAW_COLUMNS) for i in range(60)]
    assert Counter(map(tuple, read_raw(spark, landing(tmp_path / "b", [plain, []])).collect())) == Counter(plain)


@pytest.mark.parametrize("size", [1 << 27, 400])
def test_lines_are_put_in_order_in_tasks_of_few(spark, blocks, tmp_path, monkeypatch, size):
    """A block is cut into chunks, and there are as many tasks as the lines need, so none holds a whole block."""
    monkeypatch.setattr(records, "CHUNK_LINES", 8)
    monkeypatch.setattr(records, "LINES_PER_TASK", 8)
    blocks(size)
    rows = awkward(6, 60)
    found = records.csv_records(spark, landing(tmp_path / "a", [rows[:40], rows[40:]]), RAW_COLUMNS)
    assert found.rdd.getNumPartitions() > 400 // 8
    assert Counter(map(tuple, read_raw(spark, str(tmp_path / "a")).collect())) == Counter(rows)


def test_written_rows_come_back(spark, tmp_path):
    rows = awkward(2, 50)
    frame = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS))
    write_landing(frame.repartition(4), str(tmp_path / "landing"))
    assert Counter(map(tuple, read_raw(spark, str(tmp_path / "landing")).collect())) == Counter(rows)


@pytest.mark.parametrize("fields", [7, 9, 10])
def test_other_numbers_of_fields_are_errors(spark, tmp_path, fields):
    rows = [tuple("a" * 8), tuple("b" * fields)]
    found = read_raw(spark, landing(tmp_path / "a", [rows]))
    for action in (found.collect, found.count, found.select("tax").collect):
        with pytest.raises(Exception, match="not 8 fields"):
            action()


def test_unpaired_quotes_and_other_headers_are_errors(spark, tmp_path, monkeypatch):
    open_quote = tmp_path / "open.csv"
    open_quote.write_text(",".join(RAW_COLUMNS) + '\n1,2,3,4,"five,6,7,8\n')
    with pytest.raises(LoadError, match="never closed"):
        read_raw(spark, str(open_quote))
    with pytest.raises(LoadError, match="first line"):
        check_input(spark, landing(tmp_path / "a", [[tuple("a" * 8)]], header=RAW_COLUMNS[::-1]))
    quoted = tmp_path / "quoted.csv"
    quoted.write_text("﻿" + ",".join(f'"{c}"' for c in RAW_COLUMNS) + "\r\n\r\n1,2,3,4,5,6,7,8\r\n\r\n")
    assert [tuple(r) for r in read_raw(spark, str(quoted)).collect()] == [tuple("12345678")]


def test_a_field_that_swallows_blocks_is_an_error(spark, blocks, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "LONGEST_RECORD", 300)
    blocks(100)
    with pytest.raises(LoadError, match="too long"):
        read_raw(spark, landing(tmp_path / "a", [[("x\n" * 500, *"bcdefgh")]]))


def test_plain_lines_are_not_shuffled(spark, tmp_path, capsys):
    path = landing(tmp_path / "a", [[tuple("a" * 8)] * 20])
    read_raw(spark, path).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan.replace("BroadcastExchange", "") and plan.count("FileScan") == 1
