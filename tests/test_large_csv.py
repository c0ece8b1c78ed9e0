"""Quoted CSV in many ranges: the rows have to be those of one reader of the whole file."""

import csv
import io
import random
import re

import pytest

from dayblotter.sources import files, large_csv
from dayblotter.sources.files import read_csv
from dayblotter.sources.large_csv import header_of, read_split


def expected(text):
    rows = [row for row in csv.reader(io.StringIO(text, newline="")) if row]
    return in_order(tuple(cell or None for cell in row) for row in rows[1:])


def found(df):
    return in_order(tuple(row) for row in df.collect())


def in_order(rows):
    return sorted(rows, key=lambda row: [(cell is not None, cell or "") for cell in row])


def table(rng, rows, line="\n"):
    """Values with line breaks, quotes, commas, letters of several bytes, and none."""
    parts = ["a", "bc", "é", "😀", ",", '"', "\n", "\n\n", "\r\n", " ", "x" * 40, "12"]
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=line)
    writer.writerow(["First Name", "Se\nCond", 'Th"ird', "n"])
    for number in range(rows):
        writer.writerow(["".join(rng.choice(parts) for _ in range(rng.randrange(5))) for _ in range(3)] + [number])
    return out.getvalue()


@pytest.mark.parametrize("size", [7, 64, 1000])
@pytest.mark.parametrize("line", ["\n", "\r\n"])
def test_rows_do_not_depend_on_the_ranges(spark, tmp_path, size, line):
    texts = [table(random.Random(seed), 25 if size < 10 else 60, line) for seed in range(2)]
    for number, text in enumerate(texts):
        (tmp_path / f"{number}.csv").write_text(text, newline="")
    df = read_split(spark, [str(tmp_path)], ["a", "b", "c", "n"], "\n", size)
    assert found(df) == in_order(expected(texts[0]) + expected(texts[1]))


def test_ranges_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    text = table(random.Random(1), 3000)
    (tmp_path / "a.csv").write_text(text, newline="")
    seen = {}
    whole = large_csv._within
    monkeypatch.setattr(large_csv, "_within", lambda counts: seen.update(counts=counts) or whole(counts))
    df = read_csv(spark, str(tmp_path / "a.csv"), range_bytes=4096)
    assert df.columns == ["first_name", "se\ncond", 'th"ird', "n"]
    assert len(seen["counts"]) > len(text.encode()) // 4096 - 1 > 10
    assert found(df) == in_order(expected(text))


def test_both_ways_give_the_same_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿" + table(random.Random(2), 200), newline="")
    path = str(tmp_path / "a.csv")
    one, many = read_csv(spark, path), read_csv(spark, path, range_bytes=512)
    assert one.columns == many.columns and found(one) == found(many)


def test_a_value_over_many_ranges(spark, tmp_path):
    text = 'a,b\n1,"' + "line, \"\"quoted\"\"\n" * 400 + '"\n2,"x\ny"\n3,\n'
    (tmp_path / "a.csv").write_text(text, newline="")
    assert found(read_csv(spark, str(tmp_path / "a.csv"), range_bytes=100)) == in_order(expected(text))


@pytest.mark.parametrize("text", ["a,b\n1,2", "a,b\n1,2\n\n\n3,4\n", "a,b\r\n1,2\r\n", "a,b\r1,2\r3,\"x\ry\"", 'a,b\n"1",""\n', "a,b\n"])
def test_ends_of_files_and_of_lines(spark, tmp_path, text):
    (tmp_path / "a.csv").write_text(text, newline="")
    assert found(read_csv(spark, str(tmp_path / "a.csv"), range_bytes=3)) == in_order(expected(text))


def test_large_and_small_files_are_stacked_by_name(spark, tmp_path):
    (tmp_path / "large.csv").write_text("B,A\n" + "".join(f'"{n}\n",{n}\n' for n in range(100)))
    (tmp_path / "small.csv").write_text("A,C\n7,8\n")
    (tmp_path / "empty.csv").write_text("")
    got = read_csv(spark, str(tmp_path), range_bytes=64)
    assert got.count() == 101 and sorted(got.columns) == ["a", "b", "c"]
    assert got.where("c = '8'").select("a", "b").collect() == [("7", None)]


def test_header_from_the_first_characters(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text('"A\n1",B\r\n' + "x,y\r\n" * 100_000, newline="")
    asked = []
    first = large_csv.first_characters
    monkeypatch.setattr(large_csv, "first_characters", lambda s, path, count: asked.append(count) or first(s, path, count))
    assert header_of(spark, str(tmp_path / "a.csv")) == (["A\n1", "B"], "\n") and asked == [large_csv.HEADER_CHARACTERS]
    (tmp_path / "long.csv").write_text(",".join(f"column_{n}" for n in range(20_000)) + "\n1")
    assert len(header_of(spark, str(tmp_path / "long.csv"))[0]) == 20_000
    (tmp_path / "old.csv").write_text("a,b\r1,2", newline="")
    assert header_of(spark, str(tmp_path / "old.csv")) == (["a", "b"], "\r")


@pytest.mark.parametrize("row, said", [("x,y,z", "(?i)malformed"), ("x", "(?i)malformed"), ('"x,y', "odd number"), ('5" pipe,y\n6" pipe,z', "(?i)malformed")])
def test_damaged_files_are_errors(spark, tmp_path, row, said):
    (tmp_path / "a.csv").write_text(f"A,B\n1,2\n{row}\n3,4\n")
    with pytest.raises(Exception, match=said):
        read_csv(spark, str(tmp_path / "a.csv"), range_bytes=8).collect()


def test_whole_files_are_read_only_where_they_fit_a_range(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("a\n" + "1\n" * 100)
    asked = []
    monkeypatch.setattr(files, "_by_header", lambda s, paths: asked.append(list(paths)) or {})
    read_csv(spark, str(tmp_path / "a.csv"), range_bytes=10)
    assert asked == [[]]
    assert re.search("a.csv", files._by_size(spark, [str(tmp_path)], 10)[1][0])
