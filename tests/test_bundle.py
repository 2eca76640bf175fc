"""Tables published as one run."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.sources import bundle


def tables(spark) -> dict:
    return {
        "first": spark.range(5).select("id", F.lit("x").alias("kind")),
        "second": spark.range(3).select(F.array("id").alias("ids"), F.lit(None).cast("double").alias("gone")),
        "empty": spark.range(0).select("id"),
    }


def failing(spark):
    return spark.range(2).select(F.raise_error(F.lit("ended here")).cast("long").alias("id"))


def test_a_published_run_is_read_back(spark, tmp_path):
    manifest = bundle.publish(spark, tables(spark), str(tmp_path), "r1")
    assert {name: m["rows"] for name, m in manifest.items()} == {"first": 5, "second": 3, "empty": 0}
    got = bundle.read_bundle(spark, str(tmp_path), verify=True)
    assert {name: df.count() for name, df in got.items()} == {"first": 5, "second": 3, "empty": 0}
    assert got["empty"].columns == ["id"]


def test_a_run_cut_short_is_not_seen_and_goes_on(spark, tmp_path):
    folder, given = str(tmp_path), tables(spark)
    with pytest.raises(Exception, match="ended here"):
        bundle.publish(spark, {"first": given["first"], "second": failing(spark), "empty": given["empty"]}, folder, "r1")
    assert bundle.published_runs(spark, folder) == []
    with pytest.raises(bundle.NotPublished):
        bundle.read_bundle(spark, folder)
    with pytest.raises(bundle.NotPublished):
        bundle.read_bundle(spark, folder, "r1")

    # The first table is whole: its plan, which now would fail, isn't run again.
    again = bundle.publish(spark, {**given, "first": failing(spark)}, folder, "r1")
    assert again["first"]["rows"] == 5
    assert bundle.read_bundle(spark, folder, verify=True)["first"].count() == 5


def test_a_damaged_table_is_written_again_before_publishing_and_reported_after(spark, tmp_path):
    folder, given = str(tmp_path), tables(spark)
    with pytest.raises(Exception, match="ended here"):
        bundle.publish(spark, {"first": given["first"], "second": failing(spark)}, folder, "r1")
    spark.range(4).select("id", F.lit("x").alias("kind")).write.mode("overwrite").parquet(f"{folder}/r1/first")
    bundle.publish(spark, given, folder, "r1")
    assert bundle.read_bundle(spark, folder, verify=True)["first"].count() == 5
    spark.range(4).select("id", F.lit("x").alias("kind")).write.mode("overwrite").parquet(f"{folder}/r1/first")
    with pytest.raises(bundle.Damaged):
        bundle.read_bundle(spark, folder, verify=True)


def test_a_published_run_stays_as_it_is(spark, tmp_path):
    folder, given = str(tmp_path), tables(spark)
    first = bundle.publish(spark, given, folder, "r1")
    assert bundle.publish(spark, {**given, "first": failing(spark)}, folder, "r1") == first
    with pytest.raises(FileExistsError):
        bundle.publish(spark, {"other": given["first"]}, folder, "r1")
    bundle.publish(spark, {"first": given["empty"]}, folder, "r2")
    assert bundle.published_runs(spark, folder) == ["r1", "r2"]
    assert bundle.read_bundle(spark, folder)["first"].count() == 0
    assert bundle.read_bundle(spark, folder, "r1")["first"].count() == 5


@pytest.mark.parametrize("name", ["", "_manifests", "a/b", "..", "a b"])
def test_names_that_would_leave_the_folder_are_refused(spark, tmp_path, name):
    with pytest.raises(ValueError):
        bundle.publish(spark, {name: spark.range(1)}, str(tmp_path), "r1")
    with pytest.raises(ValueError):
        bundle.publish(spark, {"t": spark.range(1)}, str(tmp_path), name)
