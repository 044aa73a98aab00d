"""Scans of hand-written files: headers, blank rows, ragged rows, charsets, record numbers."""

import csv
import io
import random

import pytest

from rowharbor.control import NO_QUOTE, FileControl
from rowharbor.operators.checks import check_ragged
from rowharbor.sources.delimited import (
    column_preview,
    data_columns,
    placeholder_columns,
    read_header,
    sample_rows,
    scan_delimited,
    scan_head,
    with_record_no,
)

CSV = FileControl(separator=",")


def write(tmp_path, text, name="in.csv", encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def cells(df):
    return [tuple(r[c] for c in data_columns(df)) for r in df.collect()]


def test_quotes_and_line_breaks(spark, tmp_path):
    path = write(tmp_path, 'id,"Full Name", note \n1,"a ""b"", c","two\nlines"\n2,,""\n')
    df = scan_delimited(spark, path, CSV)
    assert data_columns(df) == ["id", "Full Name", "note"]
    assert cells(df) == [("1", 'a "b", c', "two\nlines"), ("2", None, "")]


def test_header_after_skipped_records(spark, tmp_path):
    text = 'about,"this\nfile, and more",x\n"second\n\nrecord",y,z\na,b,c\n1,2,3\n4,5,6\n'
    path = write(tmp_path, text)
    control = CSV.with_options(skip=2)
    assert read_header(spark, path, control) == ["a", "b", "c"]
    assert cells(scan_delimited(spark, path, control)) == [("1", "2", "3"), ("4", "5", "6")]


def test_no_header(spark, tmp_path):
    path = write(tmp_path, "1,x\n2,y\n")
    df = scan_delimited(spark, path, CSV.with_options(has_header_row=False))
    assert data_columns(df) == placeholder_columns(2) == ["column_0", "column_1"]
    assert len(cells(df)) == 2


def test_bom_and_charset(spark, tmp_path):
    path = write(tmp_path, "﻿id,né\n1,é\n")
    assert cells(scan_delimited(spark, path, CSV)) == [("1", "é")]
    assert read_header(spark, path, CSV) == ["id", "né"]
    latin = write(tmp_path, "id,né\n1,é\n", "latin.csv", "iso-8859-1")
    control = CSV.with_options(encoding="ISO-8859-1")
    df = scan_delimited(spark, latin, control)
    assert data_columns(df) == ["id", "né"] and cells(df) == [("1", "é")]


@pytest.mark.parametrize("encoding", ["utf-16", "UTF-16LE", "utf-32"])
def test_wide_charsets(spark, tmp_path, encoding):
    path = write(tmp_path, 'id,né\n1,é\n2,"x\ny"\n', encoding=encoding)
    control = CSV.with_options(encoding=encoding, multi_line=False)
    df = scan_delimited(spark, path, control)
    assert data_columns(df) == ["id", "né"] and cells(df) == [("1", "é"), ("2", "x\ny")]


def test_tsv_keeps_quotes(spark, tmp_path):
    path = write(tmp_path, 'a\tb\n"x"\t"y\n', "in.tsv")
    control = FileControl(separator="\t", quote=NO_QUOTE)
    assert cells(scan_delimited(spark, path, control)) == [('"x"', '"y')]


def test_escape_character(spark, tmp_path):
    path = write(tmp_path, 'a,b\n"x \\"q\\"",2\n')
    assert cells(scan_delimited(spark, path, CSV.with_options(escape="\\"))) == [('x "q"', "2")]


def test_ragged_rows(spark, tmp_path):
    path = write(tmp_path, "a,b,c\n1,2,3\n\n1,2\n1,2,3,4\n")
    df = scan_delimited(spark, path, CSV)
    assert sorted(cells(df), key=str) == [("1", "2", "3"), ("1", "2", "3"), ("1", "2", None)]
    assert sorted(r.record for r in check_ragged(df).collect()) == ["1,2", "1,2,3,4"]


def test_header_only(spark, tmp_path):
    path = write(tmp_path, "a,b")
    assert cells(scan_delimited(spark, path, CSV)) == []


def small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.fixture()
def split_small(spark):
    before = {
        k: spark.conf.get(k)
        for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    }
    yield lambda size: small_splits(spark, size)
    for k, v in before.items():
        spark.conf.set(k, v)


def test_record_numbers_over_many_splits(spark, tmp_path, split_small):
    lines = [f"{i},{'x' * (i % 17)}" for i in range(3000)]
    path = write(tmp_path, "id,pad\n" + "\n".join(lines) + "\n")
    split_small(2000)
    df = scan_delimited(spark, path, CSV.with_options(multi_line=False))
    assert df.rdd.getNumPartitions() > 5
    numbered = with_record_no(df).collect()
    assert sorted(r.record_no for r in numbered) == list(range(3000))
    assert all(int(r.id) == r.record_no for r in numbered)


def test_head_and_preview(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    write(folder, "id,name\n1,a\n2,\n", "part-0.csv")
    write(folder, "id,name\n" + "".join(f"{i},{'n' * 30}\n" for i in range(3, 50)), "part-1.csv")
    head = scan_head(spark, str(folder), CSV, 4)
    assert [r.id for r in head.orderBy("record_no").collect()] == ["1", "2", "3", "4"]
    shown = {r.column_name: r.preview for r in column_preview(head, 3).collect()}
    assert shown == {"id": "1, 2, 3", "name": ("a, N/A, " + "n" * 30)[:50]}
    assert sample_rows(head, 2, ["name", "other"]).columns == ["name"]


def test_leading_records():
    from rowharbor.control import parse_control
    from rowharbor.sources.delimited import leading_records

    def lead(block):
        return leading_records(parse_control('{"csv": %s}' % block).file)

    assert lead("{}") == 1 and lead('{"skip": 2}') == 3
    assert lead('{"columns": ["a"]}') == 0 and lead('{"columns": ["a"], "skip": 1}') == 1
    assert leading_records(CSV.with_options(columns=["a"])) == 1


def test_java_charset(spark, tmp_path):
    path = write(tmp_path, "id,né\n1,€\n", encoding="windows-1252")
    control = CSV.with_options(encoding="windows-1252", multi_line=False)
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        df = scan_delimited(spark, path, control)
        assert data_columns(df) == ["id", "né"] and cells(df) == [("1", "€")]
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")


@pytest.mark.parametrize("skip", [0, 1])
@pytest.mark.parametrize("names", ["id,name,day", "id,name,ID", "id,,"])
def test_files_of_a_folder_share_their_header(spark, tmp_path, skip, names):
    control = CSV.with_options(skip=skip)
    lead = "about\n" * skip
    write(tmp_path, f"{lead}{names}\n1,a,b\n", "a.csv")
    write(tmp_path, f"{lead}{names.replace('id', 'Id', 1)}\n2,c,d\n", "b.csv")
    write(tmp_path, f"{lead}{names}\n", "c.csv")
    rows = scan_delimited(spark, str(tmp_path), control)
    assert sorted(c[:3] for c in cells(rows)) == [("1", "a", "b"), ("2", "c", "d")]
    first, second, *rest = names.split(",")
    write(tmp_path, f"{lead}{','.join([second, first, *rest])}\n3,e,f\n", "d.csv")
    mixed = scan_delimited(spark, str(tmp_path), control)
    with pytest.raises(Exception, match="(?i)header"):
        mixed.collect()


def test_a_file_with_fewer_columns_is_refused(spark, tmp_path):
    write(tmp_path, "id,name\n1,a\n", "a.csv")
    write(tmp_path, "id\n2\n", "b.csv")
    with pytest.raises(Exception, match="(?i)header"):
        scan_delimited(spark, str(tmp_path), CSV).collect()
    named = scan_delimited(spark, str(tmp_path), CSV, ["id", "name"])
    assert sorted(cells(named)) == [("1", "a"), ("2", None)]
