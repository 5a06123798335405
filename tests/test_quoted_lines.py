import csv
import io
import random

import pytest

from basketlens.sources import raw_files
from basketlens.sources.quoted_lines import quoted_lines, quoted_records

NAMES = ["Key", "Label", "Brand"]
TYPES = raw_files._schema("Key:long, Label:text, Brand:text")
SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in (SPLIT, "spark.sql.files.openCostInBytes")}
    spark.conf.set(SPLIT, "150")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def written(path, rows, end="\n", encoding="utf-8"):
    text = io.StringIO(newline="")
    csv.writer(text, lineterminator=end).writerows([NAMES, *rows])
    path.write_bytes(text.getvalue().encode(encoding))
    return str(path)


def read(spark, path, **how):
    rows = raw_files.read_csv(spark, path, TYPES, line_breaks=True, **how).collect()
    return sorted((r.Key, r.Label, r.Brand) for r in rows)


PIECES = ["plain", 'say "hi"', "two\nlines", "\n", "a,b", '"', '""\n""', "three\n\nbreaks\n", "é ß", "x" * 40]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_breaks_over_split_edges(spark, tmp_path, small_splits, end):
    pick = random.Random(7)
    rows = [(i, "".join(pick.choices(PIECES, k=pick.randint(1, 3))), pick.choice(PIECES)) for i in range(400)]
    path = written(tmp_path / "t.csv", rows, end)
    starts = quoted_lines(spark, path).select("start").distinct().count()
    assert starts > 50
    assert quoted_lines(spark, path).rdd.getNumPartitions() > 10
    assert read(spark, path) == rows


def test_several_files_and_windows_1252(spark, tmp_path, small_splits):
    folder = tmp_path / "many"
    folder.mkdir()
    rows = [(i, f"Zoë €\n{i}" if i % 3 else "Škoda", "b") for i in range(60)]
    for k in range(3):
        written(folder / f"{k}.csv", rows[k * 20 : k * 20 + 20], encoding="cp1252")
    assert read(spark, str(folder), windows_1252=True) == rows


def test_byte_order_mark_and_blank_lines(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes('﻿Key,Label,Brand\n\n1,"a\n\nb",c\n\n2,d,e\n'.encode())
    assert read(spark, str(path)) == [(1, "a\n\nb", "c"), (2, "d", "e")]


def test_records_of_another_width_are_marked(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('Key,Label,Brand\n1,"a\nb"\n2,"c\nd",e\n')
    cells = raw_files.read_cells(spark, str(path), NAMES, line_breaks=True)
    assert raw_files.unreadable(cells, TYPES).first().n == 1


def test_another_header_is_an_error(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("Label,Key,Brand\nx,1,b\n")
    with pytest.raises(Exception, match="(?i)header"):
        read(spark, str(path))


def test_a_cell_left_open_is_an_error(spark, tmp_path, small_splits):
    path = tmp_path / "t.csv"
    path.write_text('Key,Label,Brand\n1,"open,b\n' + "2,x,y\n" * 300)
    with pytest.raises(Exception, match="not closed"):
        read(spark, str(path))


def test_an_empty_file_with_a_header_has_no_rows(spark, tmp_path):
    path = written(tmp_path / "t.csv", [])
    assert read(spark, path) == []
    assert quoted_records(spark, path).collect()[0].first is True
