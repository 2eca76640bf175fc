"""Many tables published as one: staged first, then made visible together by one manifest.

A run's tables are written below ``folder/run``. Each gets an entry (rows, digest, columns) once it is whole, so a
rerun of the same run writes only what is missing or damaged. The manifest, moved into place last, holds all entries;
readers go by the manifest alone and never see a run that was cut short.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_-]*")
Manifest = dict[str, dict]


class NotPublished(LookupError):
    """There is no manifest for the run: nothing was published, or it ended before."""


class Damaged(RuntimeError):
    """Stored rows are not those the manifest lists."""


def _file(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _exists(spark: SparkSession, path: str) -> bool:
    system, place = _file(spark, path)
    return system.exists(place)


def _read(spark: SparkSession, path: str) -> Manifest:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _put(spark: SparkSession, path: str, content: Manifest, replace: bool = False) -> None:
    """A small file that is there whole or not at all: written beside its place, then moved."""
    system, place = _file(spark, path)
    draft = _file(spark, f"{path}.{uuid.uuid4().hex}.draft")[1]
    system.mkdirs(place.getParent())
    stream = system.create(draft, False)
    stream.write(json.dumps(content, sort_keys=True).encode())
    stream.close()
    if replace:
        system.delete(place, False)
    if system.exists(place) or not system.rename(draft, place):
        system.delete(draft, False)
        raise FileExistsError(path)


def measure(df: DataFrame) -> dict:
    """Rows, columns and a digest of the rows that doesn't depend on their order."""
    hashed = F.xxhash64(*df.columns).cast("decimal(38,0)")
    found = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(hashed), F.lit(0)).cast("string").alias("digest")).first()
    return {"rows": found["rows"], "digest": found["digest"], "schema": df.schema.jsonValue()}


def _check_name(name: str) -> None:
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a name of a run or table: {name!r}")


def _manifest_path(folder: str, run: str) -> str:
    return f"{folder.rstrip('/')}/_manifests/{run}.json"


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, run: str) -> Manifest:
    """Write all tables and then their manifest; returns it.

    A run that is published already is left as it is, if it has the same tables, and its manifest returned. A run that
    was cut short goes on: tables whose entry agrees with the stored rows aren't computed again.
    """
    for name in (run, *tables):
        _check_name(name)
    target = _manifest_path(folder, run)
    if _exists(spark, target):
        listed = _read(spark, target)
        if set(listed) != set(tables):
            raise FileExistsError(f"run {run} is published with other tables: {sorted(listed)}")
        return listed
    manifest = {}
    for name, df in tables.items():
        path, entry = f"{folder.rstrip('/')}/{run}/{name}", f"{folder.rstrip('/')}/_entries/{run}/{name}.json"
        listed = _read(spark, entry) if _exists(spark, entry) else None
        if listed is None or not _stored_as(spark, path, listed):
            df.write.mode("overwrite").parquet(path)
            listed = measure(spark.read.parquet(path))
            _put(spark, entry, listed, replace=True)
        manifest[name] = listed
    _put(spark, target, manifest)
    return manifest


def _stored_as(spark: SparkSession, path: str, listed: dict) -> bool:
    return _exists(spark, path) and measure(spark.read.parquet(path)) == listed


def published_runs(spark: SparkSession, folder: str) -> list[str]:
    """Names of the runs that were published, in name order."""
    system, place = _file(spark, f"{folder.rstrip('/')}/_manifests")
    if not system.exists(place):
        return []
    return sorted(f.getPath().getName().removesuffix(".json") for f in system.listStatus(place) if f.getPath().getName().endswith(".json"))


def read_manifest(spark: SparkSession, folder: str, run: str | None = None) -> Manifest:
    """The manifest of a run, by default of the last one in name order."""
    if run is None:
        runs = published_runs(spark, folder)
        if not runs:
            raise NotPublished(f"no run is published in {folder}")
        run = runs[-1]
    if not _exists(spark, _manifest_path(folder, run)):
        raise NotPublished(f"run {run} is not published in {folder}")
    return _read(spark, _manifest_path(folder, run))


def read_bundle(spark: SparkSession, folder: str, run: str | None = None, verify: bool = False) -> dict[str, DataFrame]:
    """All tables of a published run. ``verify`` reads them once to compare rows and digests with the manifest."""
    if run is None:
        runs = published_runs(spark, folder)
        run = runs[-1] if runs else None
    manifest = read_manifest(spark, folder, run)
    tables = {name: spark.read.parquet(f"{folder.rstrip('/')}/{run}/{name}") for name in manifest}
    for name, df in tables.items():
        if verify and measure(df) != manifest[name]:
            raise Damaged(f"{folder}/{run}/{name}")
    return tables
