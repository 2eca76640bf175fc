"""Proportional stratified interleaving into shards.

Rows are put in a seeded order within their source; row ``r`` of a source of ``n`` gets the fractional rank
``(r + start) / n``, where ``start`` is the source's own seeded number between 0 and 1; all rows sorted by it
interleave the sources in proportion at every point, and cutting the order into equal stretches gives shards
whose counts differ by one at most and whose every source is near its share. With one start for all sources,
every source of one row would have the same fraction, and thousands of them would be ordered by one task; with
starts of their own they lie evenly. Ranks are exact and counted bucket by bucket (``ranked``), whatever a
source holds.

Defined results: a NULL source is a source of its own; a NULL text has no bytes; equal rows take neighbouring
places in any order; fewer rows than shards leave shards empty; ties of fractional ranks go by source (NULL
first), digest and key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import buckets_for, ranked, stored
from tidemark.llm.mixing import digest_bucket, seeded_digest

SHARDS = 24
SEED = 23


def byte_size(text: str) -> Column:
    """UTF-8 bytes of the text and eight for its record's frame."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def source_start(seed: int, source: str) -> Column:
    """Where a source's fractional ranks start: a seeded number from 0 to below 1, NULL's own."""
    named = F.coalesce(F.concat(F.lit(f"{seed}|="), F.col(source).cast("string")), F.lit(f"{seed}|-"))
    return F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("double") / 2.0**32


def assign_shards(rows: DataFrame, digest: str, source: str, shards: int = SHARDS, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Add ``shard`` and ``slot`` to (narrow) rows; ``digest`` holds their seeded order."""
    base = stored(rows)
    n = base.count()
    buckets = buckets_for(n)
    sizes = base.groupBy(source).agg(F.count("*").alias("_n")).withColumn("_start", source_start(seed, source)).withColumnRenamed(source, "_source")
    inner = ranked(base, [source], digest_bucket(digest, buckets), [digest, F.col(key).asc_nulls_first()], "_rank")
    joined = inner.join(sizes, F.col(source).eqNullSafe(F.col("_source"))).drop("_source")
    placed = stored(joined.withColumn("_part", (F.col("_rank") + F.col("_start")) / F.col("_n")))
    order = ["_part", F.col(source).asc_nulls_first(), digest, F.col(key).asc_nulls_first()]
    whole = ranked(placed, [], F.floor(F.col("_part") * buckets), order, "_place")
    # Shard s takes the places from ceil(s * n / shards) on.
    shard = F.floor(F.col("_place").cast("decimal(38,0)") * shards / max(n, 1)).cast("int")
    first = F.ceil(F.col("_shard").cast("decimal(38,0)") * n / shards).cast("long")
    whole = whole.withColumn("_shard", shard).withColumn("slot", F.col("_place") - first)
    return whole.select(*rows.columns, F.col("_shard").alias("shard"), "slot")


def shard_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(key, size, text_crc32, source, shard, slot) for every row. Texts are read once and not shuffled."""
    narrow = docs.select(
        F.col(key).alias(key),
        byte_size(text).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
        F.col(source).alias("source"),
        seeded_digest(seed, key, text).alias("_digest"),
    )
    return assign_shards(narrow, "_digest", "source", shards, key, seed).drop("_digest")
