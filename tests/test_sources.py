from __future__ import annotations

import pytest

from tidemark.sources.delimited import LoadError, SchemaError, describe_files, load_cleaned, load_raw, load_rejects
from tidemark.sources.sinks import write_cleaning, write_csv
from tidemark.operators.cleaning import clean

HEADER = ["case_id", "client_name", "category", "priority", "intake_date", "closure_date", "status"]


def _write(path, separator=",", rows=(), encoding="utf-8", header=HEADER):
    lines = [separator.join(header)] + [separator.join(r) for r in rows]
    path.write_bytes(("\n".join(lines) + "\n").encode(encoding))
    return str(path)


ROW = ["C1", "Café Corp", "Billing", "High", "2024-01-01", "2024-01-05", "Closed"]


def test_latin1_is_read_intact(spark, tmp_path):
    got = load_raw(spark, _write(tmp_path / "a.csv", rows=[ROW], encoding="latin1")).first()
    assert got.client_name == "Café Corp"


@pytest.mark.parametrize("separator", [";", "\t", "|", ","])
def test_separators_are_detected(spark, tmp_path, separator):
    path = _write(tmp_path / "a.csv", separator, [ROW, ["C2", "a,b" if separator != "," else "ab", "", "", "", "", ""]])
    assert describe_files(spark, [path]).first().separator == separator
    got = load_raw(spark, path).orderBy("row_index").collect()
    assert [r.case_id for r in got] == ["C1", "C2"] and got[1].category == ""


def test_many_files_mixed_kinds_quotes_and_bom(spark, tmp_path):
    _write(tmp_path / "a.csv", rows=[ROW] * 3)
    _write(tmp_path / "b.csv", ";", rows=[ROW] * 2, encoding="latin1")
    _write(tmp_path / "c.csv", rows=[['"say ""hi"""', '"line one\nline two"', *ROW[2:]]], encoding="utf-8-sig", header=[" case_id ", *HEADER[1:]])
    got = load_raw(spark, str(tmp_path)).collect()
    assert sorted(r.row_index for r in got) == list(range(6))
    odd = [r for r in got if r.case_id.startswith("say")]
    assert odd[0].case_id == 'say "hi"' and odd[0].client_name == "line one\nline two"


def test_row_index_follows_file_order(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        for name in "ab":
            _write(tmp_path / f"{name}.csv", rows=[[f"{name}{i:04d}", *ROW[1:]] for i in range(200)])
        got = load_raw(spark, str(tmp_path)).orderBy("row_index").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.row_index for r in got] == list(range(400))
    assert [r.case_id for r in got] == [f"{n}{i:04d}" for n in "ab" for i in range(200)]


def test_errors(spark, tmp_path):
    with pytest.raises(SchemaError):
        load_raw(spark, _write(tmp_path / "x.csv", rows=[["1", "2"]], header=["case_id", "client_name"]))
    with pytest.raises(FileNotFoundError):
        load_raw(spark, str(tmp_path / "nowhere.csv"))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(LoadError):
        load_raw(spark, str(tmp_path / "empty.csv"))


def test_clean_outputs_round_trip(spark, tmp_path):
    raw = load_raw(spark, _write(tmp_path / "a.csv", rows=[ROW, ["", *ROW[1:]]]))
    stored = write_cleaning(clean(raw), str(tmp_path / "out"))
    assert stored.summary.first().quarantined_rows == 1
    assert spark.read.parquet(str(tmp_path / "out/audit")).count() == 1
    columns = ["case_id", "client_name", "category", "priority", "intake_date", "closure_date", "triage_date", "status", "duration_days"]
    write_csv(stored.cleaned.select(*columns), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().duration_days == "4.0"


def test_cleaned_csv_comes_back_typed(spark, tmp_path):
    header = ["case_id", "client_name", "category", "priority", "intake_date", "closure_date", "triage_date", "triaged", "contact_count", "assigned_agent", "status", "resolution_notes"]
    rows = [["C1", '"Ann ""A"" Lee"', "Billing", "High", "2024-01-01", "2024-01-05", "2024-01-02", "yes", "3", "Bo", "Closed", '"fine, done"'], ["C2", "Bob", "Billing", "Low", "2024-02-01", "", "", "no", "", "Bo", "Open", ""]]
    cleaned = clean(load_raw(spark, _write(tmp_path / "a.csv", rows=rows, header=header))).cleaned
    write_csv(cleaned.select(*[c for c in cleaned.columns if c in {*header, "duration_days"}]).orderBy("case_id"), str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    typed = load_cleaned(spark, str(tmp_path / "csv"), back.columns)
    first = typed.orderBy("case_id").collect()
    assert first[0].client_name == 'Ann "A" Lee' and first[0].resolution_notes == "fine, done"
    assert (str(first[0].closure_date), first[0].duration_days, first[0].triaged) == ("2024-01-05", 4.0, True)
    assert first[1].closure_date is None and first[1].duration_days is None
    assert dict(typed.dtypes)["intake_date"] == "date" and dict(typed.dtypes)["contact_count"] == "int"


EXTRA = ["C2", "Acme", " Inc", "Billing", "High", "2024-01-01", "2024-01-05", "Closed"]


def test_records_with_extra_fields_raise_or_are_set_aside(spark, tmp_path):
    path = _write(tmp_path / "a.csv", rows=[ROW, EXTRA, ROW[:4]])
    with pytest.raises(LoadError):
        load_raw(spark, path)
    with pytest.raises(Exception, match="more fields than the header"):
        load_raw(spark, path, encoding="UTF-8", separator=",").collect()
    kept = load_raw(spark, path, strict=False).orderBy("row_index").collect()
    assert [(r.row_index, r.case_id, r.status) for r in kept] == [(0, "C1", "Closed"), (2, "C1", "")]
    (reject,) = load_rejects(spark, path).collect()
    assert (reject.row_index, reject.record) == (1, ",".join(EXTRA))


def test_quoted_line_ends_and_extra_fields(spark, tmp_path):
    path = _write(tmp_path / "a.csv", rows=[['"two\nlines, quoted"', *ROW[1:]], EXTRA])
    assert [r.case_id for r in load_raw(spark, path, strict=False).collect()] == ["two\nlines, quoted"]
    assert load_rejects(spark, path).count() == 1
