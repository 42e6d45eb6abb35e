"""CSV records cut by many tasks, against a reading of the whole text at once."""

import os
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.session import ensure_dir, local_path
from feedloom.sources import csv_records as R
from feedloom.sources import sheets


def model(text):
    """Records character by character."""
    out, cell, inside, i, fresh = [], "", False, 0, True
    while i < len(text):
        c = text[i]
        if inside:
            if c == '"' and text[i + 1:i + 2] == '"':
                cell, i = cell + '""', i + 2
                continue
            inside = c != '"'
        elif c == "\n":
            out.append(cell.removesuffix("\r"))
            cell, fresh, i = "", True, i + 1
            continue
        elif c == '"' and fresh:
            inside = True
        fresh = not inside and c == ","
        cell, i = cell + c, i + 1
    out.append(cell.removesuffix("\r"))
    return [r for r in out if r]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(['"', '""', ",", "\n", "\r\n", "a", 'b"', ',"', "é", '"\n']), max_size=30).map("".join))
def test_cutting_equals_a_reading_by_characters(text):
    assert R.cut_records(text) == model(text.removesuffix("\n"))


def _put(folder, name, text):
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
        f.write(text)


def _random_csv(seed, rows):
    rng = random.Random(seed)
    cell = lambda: rng.choice(["x", "12", 'q"uote', '"a,b"', '"line\nbreak"', '"two\n\n""lines"" \r\n"', "", '""', '"é\n' + "long " * 30 + '"'])
    return "".join(f"{i},{cell()},{cell()}{rng.choice([chr(10), chr(13) + chr(10)])}" for i in range(rows))


@pytest.mark.parametrize("split", ["700", "64k", "40"])
def test_records_of_split_files(spark, tmp_out, split):
    folder = local_path(ensure_dir(tmp_out + "/in"))
    texts = {f"{i}.csv": _random_csv(i, 40 + 60 * i) for i in range(3)}
    texts["end.csv"] = 'a,b,"never\nclosed'
    if split == "40":
        texts = {"0.csv": _random_csv(9, 25)}
    for name, text in texts.items():
        _put(folder, name, text)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes",
                                          "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        for k, v in zip(old, (split, "1", "7")):
            spark.conf.set(k, v)
        records, heads = R.csv_records(spark, tmp_out + "/in")
        got = records.collect()
        parts = R._lines(spark, tmp_out + "/in").rdd.getNumPartitions()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert split == "64k" or parts > len(texts)
    for name, text in texts.items():
        mine = sorted((r["block"], r["n"], r["line"]) for r in got if r["file"].endswith(name))
        assert [x[2] for x in mine] == model(text.removesuffix("\n"))
        assert mine[0][:2] == (0, 0)
    assert sorted(heads) == sorted(model(t)[0] for t in texts.values())


def test_headers_of_all_files_and_their_line_breaks(spark, tmp_out):
    folder = local_path(ensure_dir(tmp_out + "/in"))
    _put(folder, "1.csv", '﻿"a\nb",c\r\n1,"x\r\ny"\r\n')
    _put(folder, "2.csv", '\n"a\nb",c\n\n2,5" pipe\n3,7" bar\n')
    df = sheets.read_sheet(spark, tmp_out + "/in")
    assert df.columns == ["a\nb", "c"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "x\r\ny"), ("2", '5" pipe'), ("3", '7" bar')]
    _put(folder, "3.csv", "a,c\n4,z\n")
    with pytest.raises(ValueError, match="different headers"):
        sheets.read_sheet(spark, tmp_out + "/in")
    typed = sheets.read_sheet(spark, tmp_out + "/in", schema="n int, t string")
    assert sorted(r["n"] for r in typed.collect()) == [1, 2, 3, 4]
    _put(folder, "4.csv", "a\n4\n")
    with pytest.raises(ValueError, match="CSV parse error"):
        sheets.read_sheet(spark, tmp_out + "/in", schema="n int, t string")


def test_bodies_with_bare_quotes(spark):
    body = 'n,t\n5" pipe,1\n6,2\r\n7" bar,"3\r\n,"""\n'
    lines = spark.createDataFrame([(body,)], "b string").select(F.posexplode(sheets.record_lines(F.col("b"))).alias("n", "line"))
    assert [tuple(r) for r in sheets.sheet_from_lines(lines).collect()] == [
        ('5" pipe', "1"), ("6", "2"), ('7" bar', '3\r\n,"')]


def test_empty_files_and_ragged_rows(spark, tmp_out):
    folder = local_path(ensure_dir(tmp_out + "/in"))
    _put(folder, "1.csv", "\r\n\n")
    with pytest.raises(ValueError, match="empty"):
        sheets.read_sheet(spark, tmp_out + "/in")
    _put(folder, "2.csv", "a,b\n1,2\n1,2,3\n")
    with pytest.raises(Exception, match=re.escape("expected 2 cells")):
        sheets.read_sheet(spark, tmp_out + "/in").collect()
