"""Hard negatives by slot-decomposed selection.

Every positive of an anchor asks for the best negatives whose score lies in a window under that positive's own
score. The windows of one anchor overlap, but their upper limits, sorted, cut the scores into disjoint slots: a
negative falls into one slot, and the windows that can see it are those of the slot's limit and of all higher ones.
So a combiner keeps, for each anchor and block of rows, the best ``take`` of every slot; slots are merged over the
blocks; and a walk over an anchor's slots from the highest limit down merges suffixes of at most ``take`` rows, which
answers all windows at once. A lower limit only cuts the end of a window's list.

Anchors and rows are cut into blocks by digest, and a task scores one block of anchors against one block of rows with
a matrix product; only ``positives`` rows an anchor and block, and ``take`` rows a slot and block, leave it.

Defined results: rows with a NULL label, id or vector, or a NULL or non-finite component, take no part; vectors of
different lengths aren't compared; an anchor is never its own positive or negative, nor is any row of its id; equal
anchor rows are one anchor, all other repeated rows count as rows; a positive with a negative score has an empty
window; scores beyond a long are held at its limits; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.topk import usable
from tidemark.session import stored_table

POSITIVES = 5
TAKE = 3
#: A negative's score lies between these shares of the positive's, in hundredths.
LOW, HIGH = 50, 95
SCALE = 256
#: Rows and anchors in a block, on average.
BLOCK = 4096
ANCHORS = 4096
_MOST = 2**63 - 1


def _whole(vectors: pd.Series, scale: int) -> np.ndarray:
    return np.floor(np.stack(vectors.to_numpy()).astype(np.float64) * scale)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact and held within a long."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    left, right = ([[int(x) for x in row] for row in m] for m in (a, b))
    return np.array([[max(-_MOST - 1, min(_MOST, sum(x * y for x, y in zip(p, q)))) for q in right] for p in left], dtype=np.int64)


def best(scores: np.ndarray, ids: np.ndarray, take: int) -> np.ndarray:
    """The places of the ``take`` highest scores, ties by smaller id."""
    if len(scores) > take:
        kth = np.partition(scores, len(scores) - take)[len(scores) - take]
        among = np.nonzero(scores >= kth)[0]
    else:
        among = np.arange(len(scores))
    return among[np.lexsort((ids[among], ~scores[among]))][:take]  # ~x falls as x rises, and never overflows


def upper_limits(positives: np.ndarray, high: int = HIGH) -> np.ndarray:
    """The largest whole score of each window: floor(high * positive / 100)."""
    return np.array([int(p) * high // 100 for p in positives], dtype=np.int64)


def lower_limits(positives: np.ndarray, low: int = LOW) -> np.ndarray:
    """The smallest whole score of each window: ceil(low * positive / 100)."""
    return np.array([-(-int(p) * low // 100) for p in positives], dtype=np.int64)


def slots_of(scores: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The slot of every score: the place of the smallest limit, of limits rising, that isn't under it; len(limits) if none."""
    return np.searchsorted(limits, scores, side="left")


def answer(limits: np.ndarray, held: dict[int, list[tuple[int, int]]], take: int = TAKE) -> list[list[tuple[int, int]]]:
    """For every limit the best ``take`` (score, id) of its slot and all lower ones, merged upwards: each slot joins one running list."""
    running: list[tuple[int, int]] = []
    out = []
    for slot in range(len(limits)):
        running = sorted([*running, *held.get(slot, [])], key=lambda x: (-x[0], x[1]))[:take]
        out.append(running)
    return out


def mine(
    vectors: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
    positives: int = POSITIVES, take: int = TAKE, low: int = LOW, high: int = HIGH, scale: int = SCALE, block: int = BLOCK, anchor_block: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    named = F.col(label) if isinstance(label, str) else label
    flat = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"), named.alias("label"), is_anchor.alias("anchor")).where(F.col("label").isNotNull())
    # The label travels with the id, as one key, through the check of the vectors.
    checked = usable(flat.select(F.when(F.col("key").isNotNull(), F.struct("key", "label")).alias("key"), "vector", "anchor"), "key", "vector", F.col("anchor"))
    table = stored_table(checked.select(F.col("id.key").alias("id"), F.col("id.label").alias("label"), "vec", "dim", "asks")).table
    n, asked = table.agg(F.count("*"), F.count(F.when(F.col("asks"), 1))).first()
    blocks, anchor_blocks = max(1, -(-n // block)), max(1, -(-asked // anchor_block))

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    mixed = F.xxhash64("id", "vec", "label")
    # ``a``: an anchor's number, as its id may stand for several different rows.
    anchors = table.where("asks").select("id", "label", "vec", "dim").distinct().withColumn("a", F.md5(F.to_json(F.struct("id", "label", "vec"))))
    anchors = stored_table(anchors).table
    rows = table.select("id", "label", "vec", "dim", F.pmod(mixed, F.lit(blocks)).alias("b"), every(anchor_blocks).alias("q"))
    kind, kinds = vectors.schema[key].dataType.simpleString(), "a string, anchor_id {0}, other {0}, score long"

    def paired(asking: DataFrame, function, schema: str) -> DataFrame:
        left = asking.select("*", F.pmod(F.xxhash64("a"), F.lit(anchor_blocks)).alias("q"), every(blocks).alias("b"))
        return left.groupBy("dim", "q", "b").cogroup(rows.groupBy("dim", "q", "b")).applyInPandas(function, schema)

    def near(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for i, other, scores in _scored(left, right, scale):
            among = np.nonzero(other & (right["label"].to_numpy() == left["label"].iloc[i]))[0]
            for j in among[best(scores[among], right["id"].to_numpy()[among], positives)]:
                out.append((left["a"].iloc[i], left["id"].iloc[i], right["id"].iloc[j], scores[j]))
        return pd.DataFrame(out, columns=["a", "anchor_id", "other", "score"])

    first = Window.partitionBy("a").orderBy(F.desc("score"), "other")
    found = paired(anchors, near, kinds.format(kind)).withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    found = stored_table(found).table
    asking = found.groupBy("a").agg(F.array_sort(F.collect_set("score")).alias("scores"))  # at most ``positives`` each

    def slotted(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        ids, labels = right["id"].to_numpy(), right["label"].to_numpy()
        for i, other, scores in _scored(left, right, scale):
            limits = np.unique(upper_limits(left["scores"].iloc[i], high))
            slot = slots_of(scores, limits)
            fitting = other & (labels != left["label"].iloc[i]) & (scores >= lower_limits(left["scores"].iloc[i], low).min())
            for s in range(len(limits)):
                among = np.nonzero(fitting & (slot == s))[0]
                for j in among[best(scores[among], ids[among], take)]:
                    out.append((left["a"].iloc[i], s, ids[j], scores[j]))
        return pd.DataFrame(out, columns=["a", "slot", "negative_id", "score"])

    kept = paired(anchors.join(asking, "a"), slotted, f"a string, slot int, negative_id {kind}, score long")
    top = Window.partitionBy("a", "slot").orderBy(F.desc("score"), "negative_id")
    kept = kept.withColumn("place", F.row_number().over(top)).where(F.col("place") <= take)
    # At most positives * take rows an anchor on the left, ``positives`` on the right.
    held = kept.groupBy("a").agg(F.collect_list(F.struct("slot", "score", "negative_id")).alias("held"))
    wanted = found.groupBy("a", "anchor_id").agg(F.collect_list(F.struct("place", F.col("other").alias("positive_id"), "score")).alias("wanted"))

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for anchor, want, have in zip(batch["anchor_id"], batch["wanted"], batch["held"]):
                want = sorted(want, key=lambda w: w["place"])
                scores = np.array([w["score"] for w in want], dtype=np.int64)
                limits = np.unique(upper_limits(scores, high))
                slots: dict[int, list[tuple[int, int]]] = {}
                for h in have:
                    slots.setdefault(h["slot"], []).append((h["score"], h["negative_id"]))
                merged = answer(limits, slots, take)
                for w, upper, least in zip(want, upper_limits(scores, high), lower_limits(scores, low)):
                    fitting = [x for x in merged[int(np.searchsorted(limits, upper))] if x[0] >= least]
                    out += [(anchor, w["positive_id"], r, x[1], w["score"], x[0]) for r, x in enumerate(fitting, 1)]
            yield pd.DataFrame(out, columns=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    schema = f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, positive_score long, negative_score long"
    return wanted.join(held, "a").select("anchor_id", "wanted", "held").mapInPandas(windows, schema)


def _scored(left: pd.DataFrame, right: pd.DataFrame, scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the anchor, which rows have another id, scores) for every anchor of the block."""
    if not len(left) or not len(right):
        return
    a, b, ids = _whole(left["vec"], scale), _whole(right["vec"], scale), right["id"].to_numpy()
    for start in range(0, len(a), 256):  # bounds the matrix of scores
        scores = products(a[start : start + 256], b)
        for i in range(len(scores)):
            yield start + i, ids != left["id"].iloc[start + i], scores[i]
