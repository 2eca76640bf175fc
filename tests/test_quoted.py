"""Records with line ends in quoted fields, against Spark's own multi-line reader."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources.delimited import LoadError, load_raw
from tidemark.sources.quoted import open_after, parse_records, read_records

NAMES = ["a", "b", "c"]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _cell(rng, separator, end):
    words = ["x", "café", "", 'say "hi"', f"one{separator}two", f"line{end}line", f"{end}{end}", '"', "  pad ", f'q"{end}"q', 'a"']
    text = rng.choice(words)
    if any(x in text for x in (separator, "\n", "\r")) or text.startswith('"') or rng.random() < 0.3:
        return '"' + text.replace('"', '""') + '"'
    return text


def _file(path, seed, separator=",", end="\n", encoding="utf-8", rows=120):
    rng = random.Random(seed)
    lines = [separator.join(NAMES)]
    for i in range(rows):
        lines.append(separator.join([f"k{i}", _cell(rng, separator, end), _cell(rng, separator, end)]))
        if rng.random() < 0.05:
            lines.append("")
    path.write_bytes((end.join(lines) + end).encode(encoding))
    return str(path)


def _whole(spark, path, separator, encoding):
    reader = spark.read.option("sep", separator).option("encoding", encoding).option("multiLine", True).option("quote", '"').option("escape", '"').option("header", True)
    return [tuple(r) for r in reader.schema("a string, b string, c string").csv(path).collect()]


@pytest.mark.parametrize("separator,end,encoding", [(",", "\n", "utf-8"), ("|", "\n", "utf-8-sig"), (";", "\r\n", "utf-8"), ("\t", "\n", "latin1")])
def test_equals_the_whole_file_reader(spark, tmp_path, small_splits, separator, end, encoding):
    path = _file(tmp_path / "a.csv", 5, separator, end, encoding)
    known = "ISO-8859-1" if encoding == "latin1" else "UTF-8"
    records = read_records(spark, [path], known, separator)
    got = parse_records(records, NAMES, separator).orderBy("row_index").collect()
    assert [r.row_index for r in got] == list(range(120))
    assert [(r.a, r.b, r.c) for r in got] == _whole(spark, path, separator, known)


def test_a_file_is_read_by_many_tasks_and_a_record_may_span_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"part {i}" for i in range(300))
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text(f'a,b,c\n1,"{long}",x\n\n2,"y\n",\n3,z,"last\nline"')
    lines = spark.read.text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 4
    got = load_raw(spark, str(tmp_path), validate=False).orderBy("row_index").collect()
    assert [(r.row_index, r.a, r.c) for r in got] == [(0, "1", "x"), (1, "2", ""), (2, "3", "last\nline"), (3, "1", "x"), (4, "2", ""), (5, "3", "last\nline")]
    assert got[0].b == long == got[3].b and got[4].b == "y\n"


def test_quotes_that_open_nothing(spark):
    cases = {'5" pipe,x': False, 'a,"b': True, '"a""': True, '"a"""': False, '"a","b"': False, '"a,"b",c': False, '""': False, '"': True, 'x,""': False, 'x,"""': True, "": False}
    df = spark.createDataFrame(list(cases.items()), "line string, want boolean")
    assert df.where(open_after(F.col("line"), ",") != F.col("want")).collect() == []


def test_open_quotes_and_bare_returns(spark, tmp_path):
    (tmp_path / "open.csv").write_text('a,b,c\n1,"never,closed\n2,x,y\n')
    with pytest.raises(LoadError, match="not closed"):
        load_raw(spark, str(tmp_path / "open.csv"), validate=False)
    (tmp_path / "old.csv").write_bytes(b'a,b,c\r1,"x\ry",z\r2,"p",q\r')
    got = load_raw(spark, str(tmp_path / "old.csv"), validate=False).orderBy("row_index").collect()
    assert [r.a for r in got] == ["1", "2"]
