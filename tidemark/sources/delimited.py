"""Delimited text in mixed encodings and separators, read as strings.

One splittable text scan looks at every line of every file: whether the bytes are UTF-8, whether a quoted
field runs over a line end, how lines are separated, and whether a line has more fields than its header.
The driver sees one short row per file. Files are then read in groups that share encoding, separator, layout
and header. Records with more fields than the header are an error (``strict``) or go to a table of rejects.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark import vocab
from tidemark.sources.quoted import OpenQuote, parse_records, read_records
from tidemark.sources.row_index import with_row_index

# Candidate separators, in order of preference.
SEPARATORS = [",", ";", "\t", "|"]
SINGLE_BYTE = "ISO-8859-1"


class LoadError(Exception):
    """The input cannot be read."""


class SchemaError(LoadError):
    """A required column is missing."""


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    try:
        read = spark.read.text(list(paths))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no such input: {', '.join(paths)}") from error
        raise LoadError(str(error)) from error
    return read.select(
        F.col("value"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )


def _separator_counts(value: Column) -> list[Column]:
    """How often each candidate occurs outside quotes."""
    bare = F.regexp_replace(value, '"[^"]*"', "")
    return [(F.length(bare) - F.length(F.replace(bare, F.lit(s), F.lit("")))).alias(f"c{i}") for i, s in enumerate(SEPARATORS)]


def describe_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Per file, from one scan: encoding, separator, whether records span lines, header line, lines with extra fields.

    A separator that occurs equally often in all lines wins, the more frequent one first; otherwise the most
    frequent one in the header; otherwise a comma.
    """
    lines = _lines(spark, paths).select("*", *_separator_counts(F.col("value")))
    written = F.trim("value") != ""
    first = F.when(written & (F.col("start") == 0), F.col("at"))
    every = range(len(SEPARATORS))
    whole = lines.groupBy("path").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.bool_or(F.pmod(F.regexp_count("value", F.lit('"')), F.lit(2)) == 1).alias("multiline"),
        F.min_by("value", first).alias("header"),
        *[F.min_by(f"c{i}", first).alias(f"head{i}") for i in every],
        *[F.min(F.when(written, F.col(f"c{i}"))).alias(f"low{i}") for i in every],
        *[F.max(F.when(written, F.col(f"c{i}"))).alias(f"high{i}") for i in every],
    )
    whole = whole.select("*", *[F.when(F.col(f"low{i}") == F.col(f"high{i}"), F.col(f"low{i}")).otherwise(F.lit(0)).alias(f"even{i}") for i in every])

    def best(kind: str) -> Column:
        ranked = F.array(*[F.struct(F.col(f"{kind}{i}").alias("n"), F.lit(-i).alias("p"), F.lit(s).alias("s")) for i, s in enumerate(SEPARATORS)])
        top = F.array_max(F.filter(ranked, lambda r: r.n > 0))
        return top.s

    chosen = F.coalesce(best("even"), best("head"), F.lit(SEPARATORS[0]))
    beyond = F.map_from_arrays(F.array(*[F.lit(s) for s in SEPARATORS]), F.array(*[F.col(f"high{i}") > F.col(f"head{i}") for i in every]))
    return whole.withColumn("separator", chosen).select(
        "path",
        F.when(F.col("utf8"), "UTF-8").otherwise(SINGLE_BYTE).alias("encoding"),
        "separator",
        F.coalesce("multiline", F.lit(False)).alias("multiline"),
        "header",
        F.coalesce(beyond[F.col("separator")], F.lit(False)).alias("extra_fields"),
    )


def _header_names(spark: SparkSession, path: str, encoding: str, separator: str, multiline: bool) -> list[str]:
    head = _reader(spark, encoding, separator, multiline).option("header", False).csv(path).limit(1).first()
    return [str(v or "").lstrip("﻿").strip() for v in head] if head else []


def _reader(spark: SparkSession, encoding: str, separator: str, multiline: bool):
    return (
        spark.read.option("sep", separator)
        .option("encoding", encoding)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def check_columns(columns: Sequence[str], required: Sequence[str]) -> None:
    missing = [c for c in required if c not in set(columns)]
    if missing:
        raise SchemaError(f"missing required columns {missing}; found {list(columns)}")


REJECT = "_rejected_record"


def _fields(record: str, separator: str) -> Column:
    """How many fields a record's text has."""
    cells = F.regexp_replace(record, '"[^"]*"', "")
    return F.length(cells) - F.length(F.replace(cells, F.lit(separator), F.lit(""))) + 1


def _groups(spark: SparkSession, paths: list[str], encoding: str | None, separator: str | None, multiline: bool | None, strict: bool) -> list[tuple]:
    """(encoding, separator, multiline, files) of the files that are read together."""
    if encoding and separator:
        # Nothing to find out: the reader itself checks each file's header against the first file's.
        return [(encoding, separator, bool(multiline), paths)]
    described = describe_files(spark, paths).withColumn("header", F.md5("header"))
    files = described.collect()  # one short row per file, as the file listing itself
    if not files or any(f.header is None for f in files):
        raise LoadError(f"no data in {[f.path for f in files if f.header is None] or paths}")
    groups: dict[tuple, list] = defaultdict(list)
    for f in files:
        layout = f.multiline if multiline is None else multiline
        if strict and f.extra_fields and not layout and not separator:
            raise LoadError(f"{f.path}: some records have more fields than the header")
        groups[(encoding or f.encoding, separator or f.separator, layout, f.header)].append(f.path)
    return [(*kind[:3], members) for kind, members in sorted(groups.items())]


def _load(spark: SparkSession, paths: str | Sequence[str], required, validate, encoding, separator, multiline, strict: bool) -> DataFrame:
    """All records with ``row_index`` and, for those with more fields than the header, their text in ``REJECT``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    parts = []
    for enc, sep, multi, members in _groups(spark, paths, encoding, separator, multiline, strict):
        names = _header_names(spark, members[0], enc, sep, multi)
        if not names:
            raise LoadError(f"no data in {members}")
        if validate:
            check_columns(names, vocab.REQUIRED_COLUMNS if required is None else required)
        if len(set(names)) != len(names):
            raise LoadError(f"repeated column names {names} in {members[0]}")
        if multi:
            # The files are split and their records put together again, where no carriage return alone ends a line.
            try:
                records = read_records(spark, members, enc, sep)
            except OpenQuote as error:
                raise LoadError(str(error)) from error
            if records is not None:
                cut = parse_records(records, names, sep)
                parts.append(cut.select("row_index", *[F.col(f"`{n}`") for n in names], F.when(_fields("record", sep) > len(names), F.col("record")).alias(REJECT)))
                continue
        schema = StructType([StructField(n, StringType()) for n in [*names, REJECT]])
        # Without column pruning a record is parsed whole, whatever columns are asked for.
        reader = _reader(spark, enc, sep, multi).option("header", True).option("columnNameOfCorruptRecord", REJECT).option("columnPruning", False)
        read = with_row_index(reader.schema(schema).csv(members))
        # A record is set aside for extra fields only; one with fewer has empty cells, as usual.
        # The reader refuses to give the record's text alone, so a data column takes part in the test.
        extra = (_fields(REJECT, sep) > len(names)) & (F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) >= 0)
        parts.append(read.withColumn(REJECT, F.when(extra, F.col(REJECT))))
    if len(parts) > 1:
        # Groups follow each other: each group's rows start after the largest index before it.
        shifted = []
        offset: Column = F.lit(0).cast("long")
        for part in parts:
            shifted.append(part.withColumn("row_index", F.col("row_index") + offset))
            offset = offset + part.agg(F.count("*")).scalar()
        parts = shifted
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return table.select("row_index", *[F.coalesce(c, F.lit("")).alias(c) for c in table.columns if c not in ("row_index", REJECT)], REJECT)


def load_raw(
    spark: SparkSession,
    paths: str | Sequence[str],
    required: Sequence[str] | None = None,
    validate: bool = True,
    encoding: str | None = None,
    separator: str | None = None,
    multiline: bool | None = None,
    strict: bool = True,
) -> DataFrame:
    """All files as one all-string table with stripped column names, ``""`` for empty cells, and ``row_index``.

    Records with more fields than the header raise: at once where the scan has seen them, else when they are
    read. With ``strict=False`` they are left out here and are to be had from :func:`load_rejects`.

    Giving both ``encoding`` and ``separator`` skips the scan; all files must then share one header. A file
    with an odd quote in a line is taken to hold line ends in quoted fields; its records are put together from
    lines (:mod:`tidemark.sources.quoted`), so it is read by many tasks, unless a carriage return alone ends its
    lines. A quoted field that is never closed raises. ``multiline=False`` says that there are no such line ends.
    """
    table = _load(spark, paths, required, validate, encoding, separator, multiline, strict)
    if not strict:
        return table.where(F.col(REJECT).isNull()).drop(REJECT)
    message = F.concat(F.lit("record with more fields than the header: "), F.substring(REJECT, 1, 200))
    checked = F.when(F.col(REJECT).isNotNull(), F.raise_error(message).cast("long")).otherwise(F.col("row_index"))
    return table.withColumn("row_index", checked).drop(REJECT)


def load_rejects(
    spark: SparkSession,
    paths: str | Sequence[str],
    required: Sequence[str] | None = None,
    validate: bool = True,
    encoding: str | None = None,
    separator: str | None = None,
    multiline: bool | None = None,
) -> DataFrame:
    """(row_index, record): the records that :func:`load_raw` sets aside with ``strict=False``."""
    table = _load(spark, paths, required, validate, encoding, separator, multiline, False)
    return table.where(F.col(REJECT).isNotNull()).select("row_index", F.col(REJECT).alias("record"))


# The schema of a cleaned table, for reading one back.
CLEAN_SCHEMA = (
    "case_id string, client_name string, category string, priority string, intake_date date, closure_date date, "
    "triage_date date, triaged boolean, contact_count int, assigned_agent string, status string, "
    "resolution_notes string, duration_days double"
)


def load_cleaned(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Read a cleaned CSV back with its types; ``columns`` names those it has, in order, if not all."""
    whole = StructType.fromDDL(CLEAN_SCHEMA)
    schema = whole if columns is None else StructType([whole[c] for c in columns])
    return spark.read.option("header", True).option("escape", '"').schema(schema).csv(path)
