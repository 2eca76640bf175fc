"""Exact substring deduplication with super-k-mers.

A window is ``k`` consecutive words. Its minimiser is the smallest hash of its ``m``-word runs; consecutive
windows with the same minimiser are one super-k-mer, and equal windows have equal minimisers. So a stretch of
text travels as one packed string to its minimiser's bucket, and a bucket sees every copy of its windows.

1. Texts give light rows (minimiser, text, first window, windows, places), equal texts once. A minimiser that occurs
   once holds no repeated window: its text need not travel.
2. Texts with repeated minimisers are read again (equal ones folded to one), cut at those super-k-mers and
   packed. Bucket by bucket, windows are sorted as tuples of word numbers and neighbours compared: exact.
3. A minimiser with over ``hot`` super-k-mers (a passage in a third of all documents) would fill one bucket.
   Its windows are counted as 128-bit digests with map-side folding, and the repeated digests come back to the
   super-k-mers in small slices.
4. Repeated windows return to their texts as word spans. A text that occurs twice repeats all its windows.

Defined results: NULL and empty texts have no words, nothing is removed, the digest is that of the empty
string; texts under ``k`` words keep all words; windows overlapping their own copy count like any others; rows
equal in all columns are several rows; NULL ids are carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_PATTERN, map_rows, stored, whole_row
from tidemark.session import StoredTable, stored_table

WINDOW = 35
RUN = 4
#: Super-k-mers of one minimiser beyond which its windows travel singly. Decides where work happens, not the result.
HOT = 500
#: Words that one bucket holds on average.
BUCKET_WORDS = 400_000
#: Repeated digests of a hot minimiser that come back together.
SLICE = 64
SEED = 0x9E3779B97F4A7C15


def _run_hashes(words: list[bytes], m: int) -> np.ndarray:
    """A 64-bit hash of every run of ``m`` words."""
    one = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), dtype=np.uint64, count=len(words))
    out = np.zeros(max(0, len(words) - m + 1), dtype=np.uint64)
    for i in range(m):
        out = (out ^ one[i : i + len(out)]) * np.uint64(SEED)
        out ^= out >> np.uint64(29)
    return out


def super_kmers(words: list[bytes], k: int = WINDOW, m: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, windows, places) of each super-k-mer, windows being numbered by their first word.

    ``places`` is how often the minimiser stands in the stretch: over once, and the stretch may repeat itself.
    """
    n = len(words) - k + 1
    if n < 1:
        return (np.zeros(0, np.int64),) * 4
    runs = _run_hashes(words, m)
    least, width, span = runs, k - m + 1, 1
    while span * 2 <= width:  # minima over doubling spans, then two overlapping ones make the window
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:n], least[width - span : width - span + n])
    first = np.concatenate([[0], np.nonzero(least[1:] != least[:-1])[0] + 1])
    windows = np.diff(np.append(first, n))
    reach = windows + width - 1
    begin = np.cumsum(reach) - reach
    at = np.arange(reach.sum()) - np.repeat(begin - first, reach)
    places = np.add.reduceat(runs[at] == np.repeat(least[first], reach), begin, dtype=np.int64)
    return least[first].view(np.int64), first, windows, places


def text_key(text: str):
    """128 bits that stand for a text; NULL and empty are one."""
    return F.md5(F.coalesce(F.col(text), F.lit("")))


def light_rows(docs: DataFrame, text: str, k: int, m: int) -> StoredTable:
    """(minimiser, text_key, first, windows, places) of every distinct text; stored."""

    def rows(batch: dict) -> Iterator[tuple]:
        for h, t in zip(batch["h"], batch["t"]):
            for value, first, n, places in zip(*(x.tolist() for x in super_kmers(t.encode().split(), k, m))):
                yield value, h, first, n, places

    texts = docs.where(F.length(text) >= 2 * k - 1).select(text_key(text).alias("h"), F.col(text).alias("t"))
    return stored_table(map_rows(texts, rows, "minimiser long, text_key string, first int, windows int, places int").distinct())


def repeated_windows(docs: DataFrame, text: str = "text", k: int = WINDOW, m: int = RUN, hot: int = HOT) -> DataFrame:
    """(text_key, first, last): word spans [first, last) covered by windows that start at several places of distinct texts."""
    rows = light_rows(docs, text, k, m)
    light = rows.table
    often = light.groupBy(F.col("minimiser").alias("_m")).agg(F.sum("places").alias("_n")).where(F.col("_n") > 1)
    part = F.struct("first", "windows", "minimiser", (F.col("_n") > hot).alias("hot"))
    wanted = light.join(often, F.col("minimiser") == F.col("_m")).groupBy("text_key").agg(F.collect_list(part).alias("parts"))
    texts = docs.where(F.length(text) >= 2 * k - 1).groupBy(text_key(text).alias("text_key")).agg(F.first(text).alias("t"))
    chosen = stored(texts.join(wanted, "text_key"))
    rows.delete()
    n_words = chosen.agg(F.sum(F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["windows"] + k))).first()[0] or 0
    buckets = max(32, -(-n_words // BUCKET_WORDS))

    def packed(batch: dict) -> Iterator[tuple]:
        for h, t, parts in zip(batch["text_key"], batch["t"], batch["parts"]):
            # str.split() also cuts at \x1c-\x1f, which are no white space here; bytes.split() is the one rule.
            words = [w.decode() for w in t.encode().split()]
            for p in parts:
                if not p["hot"]:
                    first = p["first"]
                    yield p["minimiser"] % buckets, h, first, " ".join(words[first : first + p["windows"] + k - 1])

    def digests(batch: dict) -> Iterator[tuple]:
        for h, t, parts in zip(batch["text_key"], batch["t"], batch["parts"]):
            words = t.encode().split()
            for p in parts:
                if p["hot"]:
                    starts = range(p["first"], p["first"] + p["windows"])
                    yield p["minimiser"], h, p["first"], [hashlib.md5(b" ".join(words[i : i + k])).digest() for i in starts]

    def count_bucket(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_repeated_in_bucket(rows["text_key"].tolist(), rows["first"].tolist(), rows["packed"].tolist(), k), columns=["text_key", "first", "last"])

    cold = map_rows(chosen, packed, "bucket long, text_key string, first int, packed string")
    spans = cold.groupBy("bucket").applyInPandas(count_bucket, "text_key string, first int, last int")
    heated = chosen.where(F.exists("parts", lambda p: p["hot"]))
    alone = stored(map_rows(heated, digests, "minimiser long, text_key string, first int, digests array<binary>"))
    hot_spans = _repeated_digests(alone, k)
    cold_spans = spans.select("text_key", F.array(F.struct("first", "last")).alias("spans"))
    both = cold_spans.union(hot_spans.select("text_key", "spans"))
    merged = both.groupBy("text_key").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))

    def cut(batch: dict) -> Iterator[tuple]:
        for h, t, found in zip(batch["text_key"], batch["t"], batch["spans"]):
            kept, at, removed = [], 0, 0
            words = t.encode().split()
            for s in found:
                kept += words[at : s["first"]] if s["first"] > at else []
                removed += max(0, s["last"] - max(at, s["first"]))
                at = max(at, s["last"])
            yield h, removed, b" ".join(kept + words[at:]).decode()

    return map_rows(chosen.select("text_key", "t").join(merged, "text_key"), cut, "text_key string, n_removed long, kept string")


def _repeated_digests(alone: DataFrame, k: int) -> DataFrame:
    """(text_key, spans) of the windows of hot minimisers whose digest occurs more than once.

    Occurrences fold on the map side. The repeated digests of a minimiser come back in slices of about
    ``SLICE``, so a super-k-mer meets a slice or two, not every window its partners.
    """
    each = alone.select("minimiser", F.explode("digests").alias("digest"))
    twice = each.groupBy("minimiser", "digest").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    sizes = twice.groupBy(F.col("minimiser").alias("_m")).agg(F.ceil(F.count("*") / F.lit(SLICE)).cast("long").alias("slices"))

    def slice_of(digest):
        return F.pmod(F.xxhash64(digest), F.col("slices"))

    sliced = twice.join(sizes, F.col("minimiser") == F.col("_m")).groupBy(F.col("minimiser").alias("_of"), slice_of("digest").alias("_slice")).agg(F.collect_list("digest").alias("repeated"))
    asked = alone.join(sizes, F.col("minimiser") == F.col("_m"))
    asked = asked.withColumn("slice", F.explode(F.array_distinct(F.transform("digests", slice_of))))
    met = asked.join(sliced, (F.col("minimiser") == F.col("_of")) & (F.col("slice") == F.col("_slice")))
    placed = F.transform("digests", lambda d, i: F.struct((F.col("first") + i).alias("first"), (F.col("first") + i + k).alias("last"), F.array_contains("repeated", d).alias("again")))
    hits = F.transform(F.filter(placed, lambda x: x["again"]), lambda x: F.struct(x["first"].alias("first"), x["last"].alias("last")))
    return met.select("text_key", hits.alias("spans"))


def _repeated_in_bucket(keys: list[str], firsts: list[int], packed: list[str], k: int) -> list[tuple[str, int, int]]:
    """Sort the windows of a bucket's packed strings and return those that stand beside an equal one, as merged spans."""
    number: dict[str, int] = {}
    coded = [np.array([number.setdefault(w, len(number)) for w in p.split(" ")], dtype=np.int32) for p in packed]
    held = np.concatenate(coded)
    sizes = np.array([len(c) for c in coded])
    ends = np.cumsum(sizes)
    # Start positions of windows in the joined words, string by string.
    owner = np.repeat(np.arange(len(coded)), sizes - k + 1)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes - k + 1) - (sizes - k + 1), sizes - k + 1)
    start = (ends - sizes)[owner] + inside
    # Windows are put in groups of equal prefixes of doubling length (as suffix arrays are): ranks stay exact.
    rank, span = held.astype(np.int64), 1
    while span * 2 <= k:
        pair = rank[: len(rank) - span] * (len(held) + len(number) + 1) + rank[span:]
        rank = np.unique(pair, return_inverse=True)[1]
        span *= 2
    pair = rank[start] * (len(held) + len(number) + 1) + rank[start + k - span]
    order = np.argsort(pair, kind="stable")
    same = pair[order][1:] == pair[order][:-1]
    again = np.zeros(len(order), dtype=bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    out: list[tuple[str, int, int]] = []
    last = (-1, -2)
    for i in np.nonzero(again)[0].tolist():
        o, at = int(owner[i]), int(inside[i])
        if last == (o, at - 1):
            out[-1] = (out[-1][0], out[-1][1], firsts[o] + at + k)
        else:
            out.append((keys[o], firsts[o] + at, firsts[o] + at + k))
        last = (o, at)
    return out


def changed_texts(docs: DataFrame, text: str = "text", k: int = WINDOW, m: int = RUN, hot: int = HOT) -> DataFrame:
    """(key_, n_removed, kept, twice) of every text that shares a window with another text or occurs twice; stored."""
    shared = repeated_windows(docs, text, k, m, hot)
    copies = docs.groupBy(text_key(text).alias("copy_")).agg(F.count("*").alias("n_")).where(F.col("n_") > 1).select("copy_")
    both = shared.join(copies, F.col("text_key") == F.col("copy_"), "full_outer")
    return stored(both.select(F.coalesce("text_key", "copy_").alias("key_"), "n_removed", "kept", F.col("copy_").isNotNull().alias("twice")))


def remove_repeats(docs: DataFrame, text: str = "text", k: int = WINDOW, m: int = RUN, hot: int = HOT) -> DataFrame:
    """All rows and columns of ``docs``; where words go, the text is its kept words joined by single spaces."""
    changed = changed_texts(docs, text, k, m, hot)
    words = F.size(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD_PATTERN), F.lit(0)))
    rows = docs.select(whole_row(docs).alias("doc"), text_key(text).alias("mine"), (words >= k).alias("long"))
    joined = rows.join(changed, F.col("mine") == F.col("key_"), "left")
    own = {c: F.col("doc").getField(c) for c in docs.columns}
    after = F.when(F.col("twice") & F.col("long"), F.lit("")).otherwise(F.coalesce("kept", own[text]))
    return joined.select(*[(after if c == text else v).alias(c) for c, v in own.items()])


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = WINDOW, m: int = RUN, hot: int = HOT) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) of every row. Only digests of texts are shuffled here."""
    changed = changed_texts(docs, text, k, m, hot).select("key_", "n_removed", F.sha2("kept", 256).alias("_kept"), "twice")
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD_PATTERN), F.lit(0))
    rows = docs.select(F.col(key).alias(key), text_key(text).alias("_text"), words.alias("_words"))
    rows = rows.select(key, "_text", F.size("_words").cast("long").alias("n_words"), F.sha2(F.array_join("_words", " "), 256).alias("_whole"))
    every = F.col("twice") & (F.col("n_words") >= k)
    return rows.join(changed, F.col("_text") == F.col("key_"), "left").select(
        key,
        "n_words",
        F.when(every, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(every, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("_kept", "_whole")).alias("kept_sha256"),
    )
