"""What the operators share: table access, Arrow batches, stored tables, exact distributed ranks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.session import stored_table

#: A word is a run of anything but the six ASCII white-space characters. ``bytes.split()`` cuts the same words.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Rows handed to a Python worker at a time; Spark also ends a batch at ``arrow.maxBytesPerBatch``.
BATCH_ROWS = 1024


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches to ``BATCH_ROWS`` rows.

    At the default of 10,000 rows, texts of some kilobytes fill tens of megabytes in the buffers of the JVM and
    of the worker, for each running task.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def map_rows(df: DataFrame, rows: Callable[[dict], Iterator[tuple]], schema: str | StructType) -> DataFrame:
    """Run ``rows`` over batches given as a dict of Python lists; it yields output tuples.

    Output leaves in pieces of ``BATCH_ROWS`` rows, so a batch that yields many rows stays bounded.
    """
    parsed = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(parsed)
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                held: list[tuple] = []
                for row in rows({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}):
                    held.append(row)
                    if len(held) >= BATCH_ROWS:
                        yield _batch(held, arrow)
                        held = []
                if held:
                    yield _batch(held, arrow)

    return df.mapInArrow(run, parsed)


def _batch(held: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: its lineage ends here."""
    return stored_table(df).table


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that no helper column can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def ranked(
    df: DataFrame, by: Sequence[str], bucket: Column, order: Sequence[str | Column], name: str = "rank", weight: str | None = None
) -> DataFrame:
    """Add ``name``: how many rows (or how much ``weight``) come before this row in its group, from 0.

    ``bucket`` must grow with the order, so a group is ordered bucket by bucket: rows are counted inside
    (group, bucket), and the bucket totals, folded on the map side, are summed up over the buckets.
    No window ever holds a whole group; groups match with NULL as a value.
    """
    # A struct of the group columns compares NULL as equal to NULL and keeps one hash key for window and join.
    group = F.struct(*by) if by else F.lit(0)
    placed = df.withColumn("_group", group).withColumn("_bucket", bucket)
    amount = F.lit(1).cast("long") if weight is None else F.col(weight)
    totals = placed.groupBy("_group", "_bucket").agg(F.sum(amount).alias("_held"))
    over = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        F.col("_group").alias("_of"), F.col("_bucket").alias("_at"), F.coalesce(F.sum("_held").over(over), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_group", "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(amount).over(inside), F.lit(0))
    same = (F.col("_group") == F.col("_of")) & (F.col("_bucket") == F.col("_at"))
    out = placed.withColumn("_own", own).join(before, same, "left")
    return out.withColumn(name, (F.col("_before") + F.col("_own")).cast("long")).select(*df.columns, name)


def buckets_for(n: int, rows: int = 20_000, least: int = 64) -> int:
    """How many even buckets keep about ``rows`` rows each: grows with the table, so no bucket does."""
    return max(least, -(-n // rows))
