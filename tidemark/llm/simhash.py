"""SimHash near-duplicates with bit-sliced comparison.

A fingerprint has 64 bits; two link when at most ``RADIUS`` bits differ. Buckets: cut the bits into
``RADIUS + 1`` bands, and any linked pair agrees on one band. A bucket over ``LIMIT`` fingerprints is not
compared but cut again: its members agree on the band, so the linked pairs among them agree on one of
``RADIUS + 1`` bands of the remaining bits. Each level leaves three quarters of the bits, and a bucket of
distinct fingerprints that agree on all but ten bits can't hold more than 1,024; so the cutting ends by
itself, nothing is capped and no link is lost.

Inside a bucket the fingerprints stand in blocks of 64 lanes, stored as 64 bit planes (one word per bit).
A fingerprint meets a block by XOR with each plane; a carry-save counter of two bits per lane and an
overflow bit hold the distances, and a block is abandoned once all its lanes have overflowed.
A bucket returns a spanning forest of its links, at most one edge per member, never all pairs.

Defined results: NULL and empty texts have no words and the zero fingerprint, which links like any other;
texts of one or two words are one shingle; equal texts share a fingerprint and so a component; a NULL id
gets its component's smallest non-NULL id, which is NULL if there is none; rows sharing an id all stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tidemark.llm.common import map_rows, stored, whole_row
from tidemark.llm.graph import components
from tidemark.session import stored_table

RADIUS = 3
LIMIT = 1024
SHINGLE = 3
SEED = 42
#: Wide fingerprints for whole groups of near copies: five-word shingles, eight times 64 bits, Jaccard similarity.
WIDE_SHINGLE = 5
WIDE_PRINTS = 8
SIMILARITY = 0.8
#: Texts sampled at least to find the common shingles, and how many of these the workers hold. Decide work, not the result.
SAMPLE = 5000
COMMON = 200_000
#: (64 bits of a fingerprint, block) meetings in memory at a time.
MEETINGS = 1 << 17


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """64 majority bits over the XXH64 values of the word shingles, as a signed long."""
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w)] if len(w) < words else map(b" ".join, zip(*[w[i:] for i in range(words)]))
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[i : i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, key: str, text: str, words: int = SHINGLE) -> DataFrame:
    """(key, fingerprint) for every row."""

    def rows(batch: dict) -> Iterator[tuple]:
        for k, t in zip(batch["k"], batch["t"]):
            yield k, fingerprint(t, words)

    schema = StructType([StructField(key, docs.schema[key].dataType), StructField("fingerprint", LongType())])
    return map_rows(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), rows, schema)


def _planes(members: np.ndarray) -> np.ndarray:
    """Blocks of 64 members (rows of 64-bit words) as bit planes: word j of a block holds bit j of each lane."""
    width = members.shape[1]
    blocks = -(-len(members) // 64)
    padded = np.zeros((blocks * 64, width), dtype="<u8")
    padded[: len(members)] = members
    bits = np.unpackbits(padded.view(np.uint8).reshape(blocks, 64, 8 * width), axis=2, bitorder="little")
    return np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little").reshape(blocks, 64 * width, 8).copy().view("<u8")[:, :, 0]


def _beyond(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """The lanes whose bitwise counter is over ``radius``."""
    more, same = np.zeros_like(counter[0]), ~np.zeros_like(counter[0])
    for i in reversed(range(len(counter))):
        if (radius >> i) & 1:
            same &= counter[i]
        else:
            more |= same & counter[i]
            same &= ~counter[i]
    return more


def _near_lanes(query: np.ndarray, block: np.ndarray, planes: np.ndarray, over: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Which meetings survive, and the lanes within ``radius`` of each. ``over`` starts as the lanes to ignore.

    Counters are carry-save: plane i of ``counter`` is bit i of every lane's distance, a carry out of the last
    plane marks the lane as over. Meetings whose lanes are all over are abandoned.
    """
    alive = np.arange(len(query))
    counter = [np.zeros(len(query), "<u8") for _ in range(max(1, radius.bit_length()))]
    step = 8 if planes.shape[1] == 64 else 32
    for j in range(planes.shape[1]):
        carry = planes[block, j] ^ (np.uint64(0) - ((query[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1)))
        for i, plane in enumerate(counter):
            counter[i], carry = plane ^ carry, plane & carry
        over = over | carry
        if j % step == step - 1:
            over = over | _beyond(counter, radius)
            live = ~over != 0
            if not live.all():
                alive, query, block, over = alive[live], query[live], block[live], over[live]
                counter = [plane[live] for plane in counter]
            if not len(alive):
                break
    return alive, ~over


def bucket_links(buckets: list[list], radius: int = RADIUS) -> Iterator[tuple]:
    """Spanning links of each bucket's fingerprints (signed longs, or bytes of whole 64-bit words), many buckets in one run."""
    held: list[list] = []
    meetings = 0
    for bucket in buckets:
        held.append(bucket)
        words = 1 if isinstance(bucket[0], int) else len(bucket[0]) // 8
        meetings += words * len(bucket) * -(-len(bucket) // 64)
        if meetings >= MEETINGS:
            yield from _links(held, radius)
            held, meetings = [], 0
    if held:
        yield from _links(held, radius)


def _links(buckets: list[list], radius: int) -> Iterator[tuple]:
    flat = [x for b in buckets for x in b]
    if isinstance(flat[0], int):
        bits = np.array(flat, dtype=np.int64).view("<u8").reshape(-1, 1)
    else:
        bits = np.frombuffer(b"".join(flat), dtype="<u8").reshape(len(flat), -1)
    sizes = np.array([len(b) for b in buckets])
    blocks = -(-sizes // 64)
    first_member = np.cumsum(sizes) - sizes
    first_block = np.cumsum(blocks) - blocks
    planes = np.concatenate([_planes(bits[s : s + n]) for s, n in zip(first_member, sizes)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    lane0 = np.repeat(first_member, blocks) + 64 * (np.arange(blocks.sum()) - np.repeat(first_block, blocks))
    held = np.minimum(64, np.repeat(first_member + sizes, blocks) - lane0)
    # Every member meets the blocks from its own on; the lanes up to itself are ignored.
    own_block = first_block[owner] + (np.arange(len(flat)) - first_member[owner]) // 64
    ahead = first_block[owner] + blocks[owner] - own_block
    query = np.repeat(np.arange(len(flat)), ahead)
    block = np.arange(ahead.sum()) - np.repeat(np.cumsum(ahead) - ahead, ahead) + np.repeat(own_block, ahead)
    none, every = np.uint64(0), ~np.uint64(0)
    absent = np.where(held == 64, none, every << np.minimum(held, 63).astype("<u8")).astype("<u8")
    lane = (query - lane0[block]).clip(-1, 63)
    upto = np.where(lane < 0, none, every >> (np.uint64(63) - lane.clip(0).astype("<u8"))).astype("<u8")
    root = np.arange(len(flat))
    for s in range(0, len(query), MEETINGS):  # a single bucket may have more
        q, b = query[s : s + MEETINGS], block[s : s + MEETINGS]
        alive, near = _near_lanes(bits[q], b, planes, absent[b] | upto[s : s + MEETINGS], radius)
        q, b = q[alive], b[alive]
        for t in range(0, len(q), 4096):  # 4096 meetings are at most 262,144 links
            hit, at = np.nonzero(np.unpackbits(near[t : t + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            if len(hit):
                _merge(root, q[t : t + 4096][hit], lane0[b[t : t + 4096][hit]] + at)
    while (root[root] != root).any():
        root = root[root]
    for i in np.nonzero(root != np.arange(len(root)))[0]:
        yield flat[i], flat[root[i]]


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of many links at once: hook the larger root to the smaller until both ends agree."""
    while True:
        while (root[root] != root).any():
            root[:] = root[root]
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])


def _bands(free: list[int], radius: int) -> list[list[int]]:
    """``radius + 1`` bands of nearly equal width over the free bits."""
    n = radius + 1
    return [free[len(free) * i // n : len(free) * (i + 1) // n] for i in range(n)]


def _masks(free: list[int], radius: int) -> list[int]:
    return [int(np.array([sum(1 << b for b in band)], dtype=np.uint64).view(np.int64)[0]) for band in _bands(free, radius)]


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, limit: int = LIMIT) -> DataFrame:
    """(u, v): spanning links among the distinct values of ``fingerprint``."""
    every = prints.select("fingerprint").where(F.col("fingerprint").isNotNull()).distinct()
    # agreed: the bits on which all of a bucket's members agree, as a mask. The key is (mask, masked bits).
    open_rows = stored(every.select("fingerprint", F.lit(0).cast("long").alias("agreed")))
    out: DataFrame | None = None
    # Which bits are free after a level depends on the bands taken, so each level lists its masks: 4, then
    # 16, ... only for the masks that still have a bucket over the limit.
    masks, first = [0], True
    while masks:
        by_mask = {}
        for m in masks:
            free = [b for b in range(64) if not (m >> b) & 1]
            by_mask[m] = [x | m for x in map(_unsigned, _masks(free, radius))]
        choice = F.create_map(*[x for m, subs in by_mask.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(s)) for s in subs]))])
        keyed = open_rows.select("fingerprint", F.explode(choice[F.col("agreed")]).alias("agreed"))
        keyed = keyed.withColumn("value", F.col("fingerprint").bitwiseAND(F.col("agreed"))).distinct()
        counted = keyed.groupBy("agreed", "value").agg(F.count("*").alias("n"))
        small = counted.where(F.col("n").between(2, limit)).select("agreed", "value")
        large = stored(counted.where(F.col("n") > limit).select("agreed", "value"))
        members = keyed.join(small, ["agreed", "value"]).groupBy("agreed", "value").agg(F.collect_list("fingerprint").alias("members"))

        def rows(batch: dict) -> Iterator[tuple]:
            yield from bucket_links(batch["members"], radius)

        links = map_rows(members.select("members"), rows, "u long, v long")
        links = stored(links.distinct())
        out = links if out is None else out.union(links)
        masks = sorted(_unsigned(r[0]) for r in large.select("agreed").distinct().collect())
        if masks:
            open_rows = stored(keyed.join(large, ["agreed", "value"]).select("fingerprint", "agreed"))
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _unsigned(mask: int) -> int:
    return mask & ((1 << 64) - 1)


def wide_fingerprint(text: str | None, words: int = WIDE_SHINGLE, prints: int = WIDE_PRINTS) -> bytes:
    """``prints`` fingerprints over the set of word shingles, their hashes remixed for each."""
    w = (text or "").encode().lower().split()
    if not w:
        return bytes(8 * prints)
    shingles = [b" ".join(w)] if len(w) < words else map(b" ".join, zip(*[w[i:] for i in range(words)]))
    hashes = np.unique(np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype="<u8"))
    out = []
    for i in range(prints):
        mixed = hashes + np.uint64((i * 0x9E3779B97F4A7C15) & (2**64 - 1))
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(31)
        ones = np.zeros(64, dtype=np.int64)
        for s in range(0, len(mixed), 1 << 16):
            ones += np.unpackbits(mixed[s : s + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(np.packbits(2 * ones > len(mixed), bitorder="little").tobytes())
    return b"".join(out)


def wide_radius(similarity: float, bits: int) -> int:
    """Differing bits to expect at a Jaccard similarity: sets of one size have the cosine 2J / (1 + J). One deviation is added."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return round(bits * share + math.sqrt(bits * share * (1 - share)))


def wide_links(prints: DataFrame, similarity: float = SIMILARITY, limit: int = LIMIT) -> DataFrame:
    """(u, v): spanning links among the distinct values of ``wide`` that estimate to ``similarity`` or more.

    An estimate with a recall under one; ``keep_representatives`` joins by exact similarity instead.
    Candidates agree on one of the 16-bit bands. A band's bucket over ``limit`` is cut into tiles, and every
    pair of tiles is a bucket of its own, so that all its pairs are compared in groups of bounded size.
    """
    every = stored(prints.select("wide").distinct())
    bits = 64 * WIDE_PRINTS
    bands = F.transform(F.sequence(F.lit(0), F.lit(bits // 16 - 1)), lambda i: F.struct(i.alias("band"), F.substring(F.col("wide"), 2 * i + 1, F.lit(2)).alias("value")))
    keyed = every.select("wide", F.explode(bands).alias("b")).select("wide", "b.band", "b.value")
    sizes = keyed.groupBy("band", "value").agg(F.ceil(F.count("*") / F.lit(limit)).cast("long").alias("tiles"), F.count("*").alias("n"))
    sized = keyed.join(sizes.where(F.col("n") > 1).drop("n"), ["band", "value"])
    own = F.pmod(F.xxhash64("wide"), F.col("tiles"))
    tiled = sized.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    members = tiled.groupBy("band", "value", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")).agg(F.collect_list("wide").alias("members"))
    radius = wide_radius(similarity, bits)

    def rows(batch: dict) -> Iterator[tuple]:
        yield from bucket_links([m for m in batch["members"] if len(m) > 1], radius)

    return stored(map_rows(members.select("members"), rows, "u binary, v binary").distinct())


def classes(prints: DataFrame, least: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``least`` (one row per fingerprint) with ``root``, the smallest fingerprint of its component."""
    found = components(fingerprint_links(prints, radius))
    joined = least.join(found, F.col("fingerprint") == F.col("node"), "left")
    return joined.withColumn("root", F.coalesce("root", "fingerprint")).drop("node")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(key, fingerprint, component_id) for every row; the id is the smallest key of the component."""
    prints = stored(with_fingerprints(docs, key, text, words))
    rooted = stored(classes(prints, prints.groupBy("fingerprint").agg(F.min(key).alias("least")), radius))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = rooted.select("fingerprint", "root").join(named, "root").select("fingerprint", "component_id")
    return prints.join(ids, "fingerprint").select(key, "fingerprint", "component_id")


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each group that ``near_duplicates`` finds: the one with the smallest (key, digest of its text), NULL keys last.

    Rows equal in key and text are one row. Only digests are shuffled to choose; the chosen rows come back by a semi join.
    """
    own = _own(key, text)

    def rows(batch: dict) -> Iterator[tuple]:
        for row, t in zip(batch["own"], batch["t"]):
            yield row, fingerprint(t, words)

    schema = StructType([StructField("own", docs.select(own.alias("own")).schema["own"].dataType), StructField("fingerprint", LongType())])
    prints = stored_table(map_rows(docs.select(own.alias("own"), F.col(text).alias("t")), rows, schema)).table
    rooted = classes(prints, prints.groupBy("fingerprint").agg(F.min("own").alias("least")), radius)
    chosen = stored_table(rooted.groupBy("root").agg(F.min("least").alias("own")).select("own")).table
    return _rows_of(docs, own, prints, chosen)


def _own(key: str, text: str):
    """What tells a row from others: its key, NULL last, then the digest of its text."""
    return F.struct(F.col(key).isNull().alias("absent"), F.col(key).alias("id"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"))


def _rows_of(docs: DataFrame, own, prints: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``chosen`` names, one of each; ``prints`` has ``own`` for every row of ``docs``."""
    kept = docs.select(whole_row(docs).alias("doc"), own.alias("mine")).join(chosen, F.col("mine") == F.col("own"), "left_semi")
    # Rows equal in key and text would all pass: of these one stays, found among the repeated keys alone.
    again = prints.groupBy("own").agg(F.count("*").alias("n")).where(F.col("n") > 1).join(chosen, "own", "left_semi").select(F.col("own").alias("again"))
    once = kept.join(again, F.col("mine") == F.col("again"), "left_anti")
    twice = kept.join(again, F.col("mine") == F.col("again"), "left_semi").dropDuplicates(["mine"])
    return once.union(twice).select("doc.*")


def shingle_set(text: str | None, words: int = WIDE_SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of the word shingles; a text of fewer words is one shingle, one without words has none."""
    w = (text or "").encode().lower().split()
    if not w:
        return np.zeros(0, dtype="<u8")
    shingles = [b" ".join(w)] if len(w) < words else map(b" ".join, zip(*[w[i:] for i in range(words)]))
    return np.unique(np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype="<u8"))


def parity_bits(shingles: np.ndarray) -> bytes:
    """512 bits, each the parity of the shingles that fall on it: two sets differ in at least as many shingles as bits."""
    return np.packbits(np.bincount((shingles >> np.uint64(55)).astype(np.int64), minlength=512).astype(np.uint8) & 1).tobytes()


def prefix(shingles: np.ndarray, similarity: float, common: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The first shingles in one global order (common ones last, then by hash), so many that sets of ``similarity`` share one."""
    if not len(shingles):
        return shingles
    at = np.minimum(np.searchsorted(common, shingles), max(0, len(common) - 1))
    rank = np.where(common[at] == shingles, often[at], 0) if len(common) else np.zeros(len(shingles), np.int64)
    n = len(shingles) - math.ceil(similarity * len(shingles) - 1e-9) + 1
    return shingles[np.lexsort((shingles, rank))[:n]]


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the Jaccard similarity of two sorted sets is ``similarity`` or more."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both + 1e-9 >= similarity * (len(a) + len(b) - both)


def common_shingles(docs: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Shingles seen in three or more texts of a sample, with their counts. They set an order, so no result hangs on them."""
    n = docs.count()
    step = max(1, n // max(SAMPLE, n // 100))

    def rows(batch: dict) -> Iterator[tuple]:
        for t in batch["t"]:
            yield (shingle_set(t).view("<i8").tolist(),)

    texts = docs.select(F.col(text).alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(step)) == 0).distinct()
    counted = map_rows(texts, rows, "shingles array<long>").select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n"))
    held = counted.where(F.col("n") >= 3).orderBy(F.col("n").desc(), "s").limit(COMMON).toPandas()
    values, often = held["s"].to_numpy(dtype="<i8").view("<u8"), held["n"].to_numpy(dtype=np.int64)
    order = np.argsort(values)
    return values[order], often[order]


def _bucket_pairs(members: list, similarity: float, every: bool) -> Iterator[tuple]:
    """Pairs of a bucket that size and parity bits don't rule out.

    ``every``: all pairs of different roots; otherwise each member's first such pair only.
    """
    ids = [m["set_id"] for m in members]
    size = np.array([m["size"] for m in members], dtype=np.int64)
    bits = np.frombuffer(b"".join(m["bits"] for m in members), dtype="<u8").reshape(len(members), -1)
    roots = np.unique([m["root"].hex() for m in members], return_inverse=True)[1] if every else np.arange(len(members))
    for s in range(0, len(members), 128):
        mine = np.arange(s, min(s + 128, len(members)))
        a, b = size[mine][:, None], size[None, : mine[-1] + 1]
        apart = np.bitwise_count(bits[mine][:, None, :] ^ bits[None, : mine[-1] + 1, :]).sum(axis=2, dtype=np.int64)
        open_ = (np.minimum(a, b) + 1e-9 >= similarity * np.maximum(a, b)) & (apart <= (1 - similarity) / (1 + similarity) * (a + b) + 1e-9)
        open_ &= (roots[mine][:, None] != roots[None, : mine[-1] + 1]) & (np.arange(mine[-1] + 1)[None, :] < mine[:, None])
        for i, j in zip(*(x.tolist() for x in np.nonzero(open_))) if every else ((i, int(open_[i].argmax())) for i in np.nonzero(open_.any(axis=1))[0].tolist()):
            yield min(ids[s + i], ids[j]), max(ids[s + i], ids[j])


def _candidates(members: DataFrame, similarity: float, every: bool, limit: int = LIMIT) -> DataFrame:
    """(u, v) over the buckets of ``members`` (token, n, set_id, size, bits, root); buckets over ``limit`` go as pairs of tiles."""
    tiles = F.ceil(F.col("n") / F.lit(limit)).cast("long")
    tiled = members.withColumn("own", F.pmod(F.xxhash64("set_id"), tiles)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
    held = tiled.groupBy("token", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")).agg(
        F.collect_list(F.struct("set_id", "size", "bits", "root")).alias("members"), F.min("root").alias("a"), F.max("root").alias("b")
    )
    if every:
        held = held.where(F.col("a") != F.col("b"))

    def rows(batch: dict) -> Iterator[tuple]:
        for bucket in batch["members"]:
            if len(bucket) > 1:
                yield from _bucket_pairs(bucket, similarity, every)

    return stored(map_rows(held.select("members"), rows, "u binary, v binary").distinct())


def _verified(docs: DataFrame, text: str, sets: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose shingle sets have the similarity; only texts of candidates are read again."""
    ids = pairs.select(F.col("u").alias("set_id")).union(pairs.select("v")).distinct()
    wanted = ids.join(sets.select("set_id", "digest"), "set_id")
    texts = docs.select(F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"), F.col(text).alias("t"))
    once = texts.join(wanted, "digest").groupBy("set_id").agg(F.first("t").alias("t"))

    def expand(batch: dict) -> Iterator[tuple]:
        for i, t in zip(batch["set_id"], batch["t"]):
            yield i, shingle_set(t).tobytes()

    def check(batch: dict) -> Iterator[tuple]:
        for u, v, a, b in zip(batch["u"], batch["v"], batch["a"], batch["b"]):
            if similar(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), similarity):
                yield u, v

    full = stored(map_rows(once, expand, "set_id binary, shingles binary"))
    left = full.select(F.col("set_id").alias("u"), F.col("shingles").alias("a"))
    right = full.select(F.col("set_id").alias("v"), F.col("shingles").alias("b"))
    return stored(map_rows(pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b"), check, "u binary, v binary"))


def keep_representatives(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE, radius: int = RADIUS, similarity: float = SIMILARITY
) -> DataFrame:
    """One row of each near-duplicate group: the one with the smallest (key, digest of its text), NULL keys last.

    Groups are joined by fingerprints within ``radius`` and by every pair of texts whose sets of five-word
    shingles have a Jaccard similarity of ``similarity`` or more: candidates share a shingle of their prefixes, which
    misses no such pair, and each is checked on the whole sets. First every set is tied to one other at most, so few whole sets travel;
    then all pairs that those links leave in different groups are checked. Rows equal in key and text are
    one row. Only digests are shuffled to choose; the chosen come back by a semi join.
    """
    own = _own(key, text)
    common, often = common_shingles(docs, text)

    def rows(batch: dict) -> Iterator[tuple]:
        for row, t in zip(batch["own"], batch["t"]):
            shingles = shingle_set(t)
            first = prefix(shingles, similarity, common, often).view("<i8").tolist()
            yield row, fingerprint(t, words), xxhash.xxh3_128_digest(shingles.tobytes()), len(shingles), parity_bits(shingles), first

    kind = docs.select(own.alias("own")).schema["own"].dataType
    schema = StructType([StructField("own", kind), StructField("fingerprint", LongType()), StructField("set_id", BinaryType()), StructField("size", LongType())])
    schema = schema.add("bits", BinaryType()).add("prefix", ArrayType(LongType()))
    prints = stored(map_rows(docs.select(own.alias("own"), F.col(text).alias("t")), rows, schema))
    sets = stored(prints.groupBy("set_id").agg(*[F.first(c).alias(c) for c in ("size", "bits", "prefix")], F.min("own.digest").alias("digest")))
    keyed = sets.select("set_id", F.explode("prefix").alias("token"))
    shared = keyed.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    members = stored(keyed.join(shared, "token").join(sets.select("set_id", "size", "bits"), "set_id"))
    # One graph over fingerprints and sets, whose ids differ in length; a document ties its two together.
    narrow = lambda c: F.unhex(F.lpad(F.hex(c), 16, "0"))
    ties = prints.select(narrow("fingerprint").alias("u"), F.col("set_id").alias("v")).distinct()
    links = fingerprint_links(prints, radius).select(narrow("u").alias("u"), narrow("v").alias("v"))
    ahead = _candidates(members.withColumn("root", F.col("set_id")), similarity, every=False)
    ahead = stored(ahead.groupBy("v").agg(F.min("u").alias("u")).select("u", "v"))
    found = stored(components(ties.union(links).union(_verified(docs, text, sets, ahead, similarity))))
    rooted = members.join(found.select(F.col("node").alias("set_id"), "root"), "set_id")
    rest = _verified(docs, text, sets, _candidates(rooted, similarity, every=True), similarity)
    found = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")).union(rest))
    least = prints.groupBy("set_id").agg(F.min("own").alias("least"))
    chosen = stored(least.join(found, F.col("set_id") == F.col("node")).groupBy("root").agg(F.min("least").alias("own")).select("own"))
    return _rows_of(docs, own, prints, chosen)


def hex_fingerprint(column: str = "fingerprint"):
    return F.lower(F.lpad(F.hex(column), 16, "0"))
