"""Best-fit packing planned on the histogram of lengths.

Documents are tokenized, closed with an end token and cut into pieces. Only the histogram of piece lengths
(at most ``capacity`` entries, whatever the corpus) reaches the driver. There best-fit decreasing runs over
counts: sequences are kept as runs of equal free room with consecutive numbers, a whole run takes the next
length at once, and every step of the plan is one line "pieces ranked a..b of length L go to sequences
from s on, m in each, at offset o". Pieces then find their line by joining on their rank within their
length, so no step handles documents one at a time or holds a length in one task.

Defined results: a NULL or empty text is the end token alone (one piece of length 1); only documents over
``capacity`` tokens are cut, their first piece taking the remainder; equal rows are packed like any others;
which of several pieces of one length takes which slot follows (hash, key, piece, crc), hence reruns agree.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.llm.common import buckets_for, map_rows, ranked, stored

CAPACITY = 1024
END_ID = 2
#: The vocabulary as ranks: the ids of ``byte_bpe_50k.json``, several times faster to look up (tests compare the two).
RANKS = "byte_bpe_50k.tiktoken"
JSON = "byte_bpe_50k.json"
#: White space in a row from which on a text goes to the JSON tokenizer.
LONG_RUN = 100_000
_RUN = re.compile(r"\s{%d}" % LONG_RUN)
SPECIAL = {"<|endoftext|>": 50256}


def tokenizer(path: str | None = None):
    """The byte-level BPE of the 50,257-entry vocabulary; ``path`` names another rank file."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path(RANKS), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def json_tokenizer(path: str | None = None):
    """The tokenizer of the JSON vocabulary, which the ranks are taken from."""
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path or public_tokenizers.path(JSON))


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the remainder first, then full pieces."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """(key, piece, start, length, ids_crc32) for every piece of every row."""

    def rows(batch: dict) -> Iterator[tuple]:
        encode = _encoder(path)
        for k, t in zip(batch["k"], batch["t"]):
            ids = np.array([*encode(t or ""), end_id], dtype="<u4")
            for i, (start, length) in enumerate(cut(len(ids), capacity)):
                yield k, i, start, length, zlib.crc32(ids[start : start + length].tobytes())

    longs = [StructField(n, LongType()) for n in ("start", "length", "ids_crc32")]
    schema = StructType([StructField(key, docs.schema[key].dataType), StructField("piece", IntegerType()), *longs])
    return map_rows(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), rows, schema)


_ENCODERS: dict = {}


def _encoder(path: str | None):
    """One tokenizer per task (loading the ranks takes a tenth of a second).

    The rank tokenizer's pattern backtracks over white space and fails on runs of about a million, so a text with a
    run of ``LONG_RUN`` goes to the JSON tokenizer, slower and with equal ids.
    """
    if path not in _ENCODERS:
        encoding, plain = tokenizer(path), []

        def encode(t: str) -> list[int]:
            if len(t) < LONG_RUN or not _RUN.search(t):
                return encoding.encode(t, allowed_special="all")
            if not plain:
                plain.append(json_tokenizer())
            return plain[0].encode(t, add_special_tokens=False).ids

        _ENCODERS[path] = encode
    return _ENCODERS[path]


def plan_slots(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, pieces, first sequence, pieces in each, offset).

    ``free[r]`` holds runs (first sequence, how many) of sequences with ``r`` free places. The fullest fitting
    run takes ``r // length`` pieces in each of its sequences, which is what placing them one by one would do.
    """
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)
    plan, used = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        for room in sorted(r for r in free if r >= length):
            each, runs = room // length, free.pop(room)
            while runs and left:
                at, many = runs.pop()
                whole = min(many, left // each)
                if whole:
                    plan.append((length, rank, whole * each, at, each, capacity - room))
                    rank, left = rank + whole * each, left - whole * each
                    free[room - each * length].append((at, whole))
                    at, many = at + whole, many - whole
                if many and left:  # fewer than ``each`` are left: they share the next sequence
                    plan.append((length, rank, left, at, left, capacity - room))
                    free[room - left * length].append((at, 1))
                    rank, left, at, many = rank + left, 0, at + 1, many - 1
                if many:
                    runs.append((at, many))
            if runs:
                free[room].extend(runs)
            if not left:
                break
        if left:
            each = capacity // length
            whole, rest = divmod(left, each)
            if whole:
                plan.append((length, rank, whole * each, used, each, 0))
                free[capacity - each * length].append((used, whole))
            if rest:
                plan.append((length, rank + whole * each, rest, used + whole, rest, 0))
                free[capacity - rest * length].append((used + whole, 1))
            used += whole + bool(rest)
    return plan


def assign(cut_pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces. The plan's size depends on ``capacity`` alone."""
    spark = cut_pieces.sparkSession
    counts = {r["length"]: r["n"] for r in cut_pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_slots(counts, capacity)
    n_buckets = buckets_for(sum(counts.values()))
    mixed = F.xxhash64(key, "piece", "ids_crc32")
    spread = cut_pieces.withColumn("_mixed", mixed)
    rank = ranked(spread, ["length"], F.pmod("_mixed", F.lit(n_buckets)), ["_mixed", key, "piece", "ids_crc32"], "rank")
    # A length's lines as one sorted array, so that a piece meets its length's row once, whatever the number of lines.
    lines: dict[int, list[tuple]] = defaultdict(list)
    for length, first, n, at, each, offset in plan:
        lines[length].append((first, n, at, each, offset))
    fields = "first:long,n:long,at:long,each:long,offset:long"
    slots = spark.createDataFrame(list(lines.items()), f"length long, lines array<struct<{fields}>>")
    joined = rank.join(F.broadcast(slots), "length")
    line = F.filter("lines", lambda x: (F.col("rank") >= x["first"]) & (F.col("rank") < x["first"] + x["n"]))[0]
    placed = joined.withColumn("_line", line).withColumn("_i", F.col("rank") - F.col("_line.first"))
    return placed.select(
        *cut_pieces.columns,
        (F.col("_line.at") + F.floor(F.col("_i") / F.col("_line.each"))).cast("long").alias("sequence_id"),
        (F.col("_line.offset") + F.col("_i") % F.col("_line.each") * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """One row per piece with its sequence and offset. Pieces are stored, so that texts are tokenized once."""
    return assign(stored(pieces(docs, key, text, capacity, end_id, path)), key, capacity)
