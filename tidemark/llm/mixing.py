"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Native DataFrame operations only. Sizes are words. Each source's target is its weight's part of the budget,
stopped at ``epochs`` times the source's size; what is cut off is shared again by weight among the others
until nobody is above. The level ``L`` of ``sum(min(cap, L * weight)) = budget`` rises to its fixed point in
rounds of one small aggregation over the per-source table; the driver sees two sums a round.

A target is taken as whole repetitions of all documents and a fraction of one more. For the fraction a
source's documents are ordered by a seeded digest of (id, text) and taken up to the first that would
overshoot; of those left the one whose size is nearest to the gap, if it narrows it, is taken too. So two
digests per source (the cutoff and the filler) describe the fraction, and texts are never shuffled.

Defined results: a NULL source is a source of its own, after all others; a NULL text has size 0; rows equal
in id and text share their place and are taken or left together; a source without words has target 0 and
its documents are left out of the mix; an empty table gives an empty mix; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_PATTERN, buckets_for, ranked, stored, whole_row

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
SEED = 17


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def seeded_digest(seed: int, key: str, text: str) -> Column:
    """A hexadecimal order of the rows that depends on the seed, the id and the text alone."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text), F.lit(""))))


def digest_bucket(digest: str, buckets: int) -> Column:
    """Even buckets that grow with the digest."""
    return F.floor(F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") * buckets / 2.0**32).cast("long")


def targets(sizes: DataFrame, source: str, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """Add ``target`` to (source, source_size), weights repeating over the sources in code-point order, NULL last.

    The order is found without one task sorting all sources: a range partitioning, stored, and ranks inside.
    """
    order = F.col(source).asc_nulls_last()
    # One row per source; storing fixes the partition numbers, so a recomputed task can't see others.
    parted = stored(sizes.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    placed = ranked(parted, [], F.col("_part"), [order], "_place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    table = stored(placed.select(source, "source_size", weight.alias("_weight"), (F.col("source_size") * float(epochs)).alias("_cap")))
    all_words, all_weight = table.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.sum(F.when(F.col("_cap") > 0, F.col("_weight")))).first()
    budget, level, held = all_words * share, 0.0, None
    free = all_weight or 0.0
    full = 0.0
    while free and (full, free) != held:
        held = (full, free)
        level = max(level, (budget - full) / free)
        above = F.col("_cap") < F.lit(level) * F.col("_weight")
        full, free = table.agg(F.coalesce(F.sum(F.when(above, F.col("_cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0.0))).first()
    if not free:
        level = float("inf")
    return table.select(source, "source_size", F.least("_cap", F.lit(level) * F.col("_weight")).alias("target"))


def plan_mixture(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: float = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row per source: source_size, target, ``copies`` (whole repetitions), ``cutoff`` (the last digest taken once more) and ``filler``."""
    units = docs.select(F.col(source).alias("source"), word_count(text).alias("size"), seeded_digest(seed, key, text).alias("digest"))
    units = stored(units.groupBy("source", "digest").agg(F.sum("size").alias("size")))
    aimed = stored(targets(units.groupBy("source").agg(F.sum("size").alias("source_size")), "source", weights, share, epochs))
    before = ranked(units, ["source"], digest_bucket("digest", buckets_for(units.count())), ["digest"], "before", weight="size")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    aimed = aimed.withColumn("copies", whole).withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
    mine = aimed.where(F.col("rest") > 0).select(F.col("source").alias("_source"), "rest")
    reach = F.col("before") + F.col("size")
    # Sizes aren't negative, so these are the first units of the order, up to the one that would overshoot.
    aligned = stored(before.join(mine, F.col("source").eqNullSafe(F.col("_source"))).withColumn("fits", reach <= F.col("rest")))
    first = aligned.where("fits").groupBy("_source").agg(F.max("digest").alias("cutoff"), F.max(reach).alias("reached"))
    gaps = mine.withColumnRenamed("_source", "_of").join(first, F.col("_of").eqNullSafe(F.col("_source")), "left").select(
        "_of", "cutoff", (F.col("rest") - F.coalesce("reached", F.lit(0))).alias("gap")
    )
    miss = F.abs(F.col("size") - F.col("gap"))
    near = aligned.where(~F.col("fits")).join(gaps.drop("cutoff"), F.col("_source").eqNullSafe(F.col("_of"))).where(miss < F.col("gap"))
    filler = near.groupBy("_of").agg(F.min(F.struct(miss.alias("miss"), "digest"))["digest"].alias("filler")).withColumnRenamed("_of", "_filled")
    ends = gaps.join(filler, F.col("_of").eqNullSafe(F.col("_filled")), "left").select("_of", "cutoff", "filler")
    out = aimed.join(ends, F.col("source").eqNullSafe(F.col("_of")), "left")
    return stored(out.select("source", "source_size", "target", "copies", "cutoff", "filler"))


def with_copies(docs: DataFrame, plan: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """(doc, copies, source_size, target): every row as a struct, how often the mix repeats it, its source's figures."""
    own = plan.select(F.col("source").alias("of"), "source_size", "target", F.col("copies").alias("whole"), "cutoff", "filler")
    rows = docs.select(whole_row(docs).alias("doc"), F.col(source).alias("from"), seeded_digest(seed, key, text).alias("digest"))
    joined = rows.join(own, F.col("from").eqNullSafe(F.col("of")))
    extra = F.coalesce(F.col("digest") <= F.col("cutoff"), F.lit(False)) | F.coalesce(F.col("digest") == F.col("filler"), F.lit(False))
    return joined.select("doc", (F.col("whole") + extra.cast("int")).alias("copies"), "source_size", "target")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mixture takes it."""
    plan = plan_mixture(docs, key, text, source, **settings)
    rows = with_copies(docs, plan, key, text, source, settings.get("seed", SEED)).where(F.col("copies") > 0)
    return rows.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
