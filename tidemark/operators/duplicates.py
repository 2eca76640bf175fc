"""Exact, normalized and fuzzy duplicates, and their clusters.

Exact and normalized matches are star edges from the first row of each key. Fuzzy matching works on
distinct (name, companion) groups with a lossless candidate filter; a row-level edge list is a join
away, and clustering needs only a linear number of edges.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.similarity import indel_ratio, token_sorted
from tidemark.functions.text import filled, name_key, row_digest
from tidemark.operators.components import connected_components
from tidemark.operators.keyed import with_key_stats
from tidemark.session import stored_table

DEFAULT_THRESHOLD = 85.0
COMPANION_THRESHOLD = 70.0
NORMALIZED_KEYS = ["client_name", "category", "intake_date", "closure_date"]
GRAM_BUCKETS = 65_536
SALT_ROWS = 20_000
#: Rows of a group that are paired in one go; two chunks make some four million pairs.
CHUNK_ROWS = 2_000


def _star_edges(rows: DataFrame, match_type: str, fields: Sequence[str]) -> DataFrame:
    marked = with_key_stats(rows, "key", {"first_row": F.min("row_index")})
    return marked.where(F.col("row_index") != F.col("first_row")).select(
        F.col("first_row").alias("index_a"),
        F.col("row_index").alias("index_b"),
        F.lit(match_type).alias("match_type"),
        F.lit(100.0).alias("similarity_score"),
        F.array(*[F.lit(c) for c in fields]).alias("matched_fields"),
    )


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Edges from the first row to every row equal to it in all columns. NULL equals NULL."""
    names = [c for c in df.columns if c != "row_index"]
    return _star_edges(df.select("row_index", row_digest(names).alias("key")), "EXACT", names)


def normalized_duplicates(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """As :func:`exact_duplicates` on normalized key columns; rows with a blank key take no part."""
    keys = [c for c in NORMALIZED_KEYS if c in df.columns] if keys is None else list(keys)
    if not keys:
        return _star_edges(df.select("row_index", F.lit(None).cast("string").alias("key")), "NORMALIZED", keys)
    read = df.select("row_index", *[name_key(c).alias(c) for c in keys])
    complete = F.lit(True)
    for c in keys:
        complete = complete & (F.col(c) != "")
    return _star_edges(read.select("row_index", F.when(complete, row_digest(keys)).alias("key")), "NORMALIZED", keys)


def named_rows(df: DataFrame, name: str = "client_name", companion: str | None = "category") -> DataFrame:
    """(row_index, name, companion, group_key) of the rows with a name."""
    other = name_key(companion) if companion and companion in df.columns else F.lit("")
    read = df.select("row_index", name_key(name).alias("name"), other.alias("companion"))
    return read.where(F.col("name") != "").withColumn("group_key", row_digest(["name", "companion"]))


def _gram_plan(threshold: float) -> tuple[int, Column]:
    """Gram size, and the number of rarest grams of a text that must be indexed to miss no pair.

    With sentinels around both texts, two texts of lengths a and b and common subsequence L share at
    least 3L − (a + b) + 1 bigrams: an unmatched character of one text breaks at most two of its own
    bigrams, one of the other text at most one. A pair at the threshold has L ≥ t(a + b)/2 and
    b ≥ a·t/(2 − t), so a text must share (1.5t − 1)·2a/(2 − t) + 1 of its a + 1 bigrams, and any
    (a + 1) − shared + 1 of them contain a hit. Below t = 2/3 that bound is empty and single
    characters take over, which share at least L ≥ t(a + b)/2 ≥ a·t/(2 − t).
    """
    t, a = threshold / 100.0, F.length("sorted_name")
    if 3 * t >= 2:
        shared = F.greatest(F.lit(1.0), F.ceil(a * ((1.5 * t - 1) * 2 / (2 - t)) + 1 - 1e-9))
        return 2, (a + 1) - shared + 1
    shared = F.greatest(F.lit(1.0), F.ceil(a * (t / (2 - t)) - 1e-9))
    return 1, a - shared + 1


def _prefixes(names: DataFrame, threshold: float) -> DataFrame:
    """(sorted_name, prefix): the rarest grams of each distinct text, rarest first.

    Grams are hashed to a fixed number of buckets, so the frequency table has at most that many rows.
    Merging grams can only add candidates. A repeated gram counts as a new gram each time.
    """
    size, keep = _gram_plan(threshold)
    text = F.concat(F.lit("\x02"), F.col("sorted_name"), F.lit("\x03")) if size == 2 else F.col("sorted_name")
    grams = (
        names.select("sorted_name", text.alias("t"))
        .select("sorted_name", F.explode(F.sequence(F.lit(1), F.length("t") - F.lit(size - 1))).alias("i"), "t")
        .select("sorted_name", F.pmod(F.xxhash64(F.substr("t", F.col("i"), F.lit(size))), F.lit(GRAM_BUCKETS)).alias("gram"))
        .groupBy("sorted_name", "gram")
        .agg(F.count("*").alias("times"))
    )
    frequency = grams.groupBy("gram").agg(F.count("*").alias("freq"))
    ranked = grams.join(F.broadcast(frequency), "gram").select(
        "sorted_name", "freq", "gram", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("nth")
    )
    # At most one entry per character of the text.
    per_text = ranked.groupBy("sorted_name").agg(F.array_sort(F.collect_list(F.struct("freq", "gram", "nth"))).alias("all"))
    return per_text.select("sorted_name", F.slice("all", F.lit(1), keep.cast("int")).alias("prefix"))


def gram_lanes(prefixes: DataFrame, salt_rows: int = SALT_ROWS) -> tuple[DataFrame, DataFrame]:
    """The two sides of the candidate join, both cut into lanes of about ``salt_rows`` texts.

    A hot gram's texts fall into lanes by digest, and every pair of lanes is a group of its own, so a group
    is bounded on both sides and any pair of texts still meets in exactly one group of a shared gram.
    """
    entries = prefixes.select("sorted_name", "prefix", F.explode("prefix").alias("g"))
    lanes = F.ceil(F.col("g.freq") / F.lit(float(salt_rows))).cast("int")
    own, every = F.pmod(F.xxhash64("sorted_name"), lanes).cast("int"), F.sequence(F.lit(0), lanes - 1)
    near = entries.select(
        F.col("sorted_name").alias("text_a"), F.col("prefix").alias("prefix_a"), "g", own.alias("lane_a"), F.explode(every).alias("lane_b")
    )
    far = entries.select(
        F.col("sorted_name").alias("text_b"), F.col("prefix").alias("prefix_b"), "g", F.explode(every).alias("lane_a"), own.alias("lane_b")
    )
    return near, far


def similar_texts(names: DataFrame, threshold: float = DEFAULT_THRESHOLD, salt_rows: int = SALT_ROWS) -> DataFrame:
    """(text_a, text_b, score) for all distinct pairs of ``sorted_name`` at or above the threshold.

    Exact: pairs meet on a shared rare gram, a hot gram is split into lanes, a pair that meets several
    times is kept only on its first shared gram, and bounded edit distance (never above the
    insertion-deletion distance) drops most of the rest before the exact score.
    """
    near, far = gram_lanes(_prefixes(names, threshold), salt_rows)
    total = F.length("text_a") + F.length("text_b")
    room = F.floor(total * F.lit(1 - threshold / 100.0) + 1e-9).cast("int")
    met = near.join(far, ["g", "lane_a", "lane_b"]).where(
        (F.col("text_a") < F.col("text_b"))
        & (F.abs(F.length("text_a") - F.length("text_b")) <= room)
        & (F.element_at(F.array_intersect("prefix_a", "prefix_b"), 1) == F.col("g"))
    )
    close = met.where(F.call_function("levenshtein", F.col("text_a"), F.col("text_b"), room) >= 0)
    scored = close.select("text_a", "text_b", indel_ratio("text_a", "text_b").alias("score"))
    return scored.where(F.col("score") >= threshold)


def fuzzy_group_pairs(
    df: DataFrame, name: str = "client_name", companion: str | None = "category", threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Similar pairs of (name, companion) groups with their row counts and first rows.

    Two names match when their token-sorted similarity reaches the threshold; two different, non-blank
    companions must also be alike to 70. Equal names are left to the normalized tier.
    """
    groups = named_rows(df, name, companion).groupBy("group_key", "name", "companion").agg(
        F.count("*").alias("rows"), F.min("row_index").alias("first_row")
    )
    forms = groups.select("group_key", "name", "companion", "rows", "first_row", token_sorted("name").alias("sorted_name"))
    texts = forms.select("sorted_name").distinct()
    pairs = similar_texts(texts, threshold)
    # Names that differ only in word order share their sorted form and score 100.
    same = forms.groupBy("sorted_name").agg(F.count_distinct("name").alias("names")).where(F.col("names") > 1)
    pairs = pairs.unionByName(
        same.select(F.col("sorted_name").alias("text_a"), F.col("sorted_name").alias("text_b"), F.lit(100.0).alias("score"))
    )
    side = lambda tag: forms.select(*[F.col(c).alias(f"{c}_{tag}") for c in forms.columns])
    joined = pairs.join(side("a"), F.col("text_a") == F.col("sorted_name_a")).join(
        side("b"), F.col("text_b") == F.col("sorted_name_b")
    )
    ordered = (F.col("text_a") != F.col("text_b")) | (F.col("name_a") < F.col("name_b"))
    joined = joined.where(ordered & (F.col("name_a") != F.col("name_b")))
    compatible = (
        (F.col("companion_a") == "") | (F.col("companion_b") == "") | (F.col("companion_a") == F.col("companion_b"))
    )
    checked = joined.withColumn(
        "companion_score", F.when(compatible, F.lit(100.0)).otherwise(indel_ratio("companion_a", "companion_b"))
    )
    return checked.where(F.col("companion_score") >= COMPANION_THRESHOLD).select(
        "group_key_a", "name_a", "companion_a", "rows_a", "first_row_a",
        "group_key_b", "name_b", "companion_b", "rows_b", "first_row_b",
        F.bround("score", 2).alias("similarity_score"),
    )


def fuzzy_duplicates(
    df: DataFrame, name: str = "client_name", companion: str | None = "category", threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Row-level fuzzy edges, smaller index first. As large as the answer itself; see :func:`fuzzy_links`.

    A group's rows lie in chunks of some ``CHUNK_ROWS`` by digest. Pairs of chunks, not of rows, are joined and dealt to
    all tasks; unfolding two chunks is a loop, so no row of the answer passes a join, a sort or a shuffle.
    """
    pairs = fuzzy_group_pairs(df, name, companion, threshold)
    rows = named_rows(df, name, companion).select("row_index", "group_key")
    sizes = pairs.select(F.col("group_key_a").alias("of"), F.col("rows_a").alias("n")).union(pairs.select("group_key_b", "rows_b")).distinct()
    many = F.ceil(F.col("n") / F.lit(float(CHUNK_ROWS))).cast("int")
    chunks = (
        rows.join(sizes, F.col("group_key") == F.col("of"))
        .groupBy("group_key", F.pmod(F.xxhash64("row_index"), many).cast("int").alias("chunk"))
        .agg(F.collect_list("row_index").alias("rows"))
    )
    lanes = lambda n: F.explode(F.sequence(F.lit(0), F.ceil(F.col(n) / F.lit(float(CHUNK_ROWS))).cast("int") - 1))
    met = pairs.select("group_key_a", "group_key_b", "rows_b", "similarity_score", lanes("rows_a").alias("chunk_a"))
    met = met.select("group_key_a", "group_key_b", "similarity_score", "chunk_a", lanes("rows_b").alias("chunk_b"))
    side = lambda tag: chunks.select(F.col("group_key").alias(f"group_key_{tag}"), F.col("chunk").alias(f"chunk_{tag}"), F.col("rows").alias(f"list_{tag}"))
    both = met.join(side("a"), ["group_key_a", "chunk_a"]).join(side("b"), ["group_key_b", "chunk_b"])
    # By number, so that adaptive execution doesn't put pairs of chunks, which are small themselves, into one task.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(tasks, "group_key_a", "chunk_a", "group_key_b", "chunk_b")
    edges = dealt.select("similarity_score", "list_b", F.explode("list_a").alias("row_a")).select("similarity_score", "row_a", F.explode("list_b").alias("row_b"))
    return edges.select(
        F.least("row_a", "row_b").alias("index_a"),
        F.greatest("row_a", "row_b").alias("index_b"),
        F.lit("FUZZY").alias("match_type"),
        "similarity_score",
        F.array(*[F.lit(c) for c in (name, companion) if c and c in df.columns]).alias("matched_fields"),
    )


def fuzzy_links(df: DataFrame, pairs: DataFrame, name: str = "client_name", companion: str | None = "category") -> DataFrame:
    """A linear number of edges with the same components as the row-level fuzzy edges.

    All rows of two matched groups are one component, so each row only needs its group's first row,
    and the two first rows each other.
    """
    matched = pairs.select(F.col("group_key_a").alias("group_key")).union(pairs.select("group_key_b")).distinct()
    rows = named_rows(df, name, companion).select("row_index", "group_key")
    inside = with_key_stats(rows, "group_key", {"first_row": F.min("row_index")}).where(F.col("row_index") != F.col("first_row"))
    spokes = inside.join(matched, "group_key", "left_semi").select(
        F.col("first_row").alias("index_a"), F.col("row_index").alias("index_b")
    )
    return spokes.union(pairs.select(F.least("first_row_a", "first_row_b"), F.greatest("first_row_a", "first_row_b")))


def cluster_members(edges: DataFrame) -> DataFrame:
    """(canonical, member) over any edge table."""
    return connected_components(edges).select("canonical", "member")


def cluster_groups(members: DataFrame, typed_edges: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per cluster: canonical row, size and dominant match type.

    The type looks only at edges between the canonical row and a member: EXACT beats NORMALIZED beats
    FUZZY, and a pair found by several tiers carries the latest tier. ``ids`` (row_index, case_id)
    adds the sample identifier. Member lists stay a long table: a cluster may hold any share of the rows.
    """
    tier = F.when(F.col("match_type") == "EXACT", 1).when(F.col("match_type") == "NORMALIZED", 2).otherwise(3)
    pairs = typed_edges.groupBy(F.least("index_a", "index_b").alias("canonical"), F.greatest("index_a", "index_b").alias("member")).agg(
        F.max(tier).alias("tier")
    )
    groups = (
        members.join(pairs, ["canonical", "member"], "left")
        .groupBy("canonical")
        .agg(F.count("*").alias("total_records"), F.min(F.coalesce("tier", F.lit(3))).alias("tier"))
    )
    typed = groups.select(
        F.col("canonical").alias("canonical_index"),
        "total_records",
        F.when(F.col("tier") == 1, "EXACT").when(F.col("tier") == 2, "NORMALIZED").otherwise("FUZZY").alias("match_type"),
    )
    if ids is None:
        return typed.withColumn("sample_identifier", F.format_string("Row %d", "canonical_index"))
    return typed.join(ids.select(F.col("row_index").alias("canonical_index"), filled("case_id").alias("sample_identifier")), "canonical_index", "left")


class DuplicateReport:
    """All tiers over one table. Cheap edges throughout: no row-level fuzzy edge list is built."""

    def __init__(self, df: DataFrame, threshold: float = DEFAULT_THRESHOLD, name: str = "client_name", companion: str = "category"):
        self.df, self.threshold, self.name, self.companion = df, threshold, name, companion
        self.exact = exact_duplicates(df)
        self.normalized = normalized_duplicates(df)

    @cached_property
    def fuzzy_pairs(self) -> DataFrame | None:
        """Similar groups, kept in the shared checkpoint folder because clusters and counts both read them."""
        if self.name not in self.df.columns:
            return None
        return stored_table(fuzzy_group_pairs(self.df, self.name, self.companion, self.threshold)).table

    @cached_property
    def members(self) -> DataFrame:
        edges = self.exact.select("index_a", "index_b").union(self.normalized.select("index_a", "index_b"))
        if self.fuzzy_pairs is not None:
            edges = edges.union(fuzzy_links(self.df, self.fuzzy_pairs, self.name, self.companion))
        return cluster_members(edges)

    @property
    def groups(self) -> DataFrame:
        ids = self.df if "case_id" in self.df.columns else None
        return cluster_groups(self.members, self.exact.unionByName(self.normalized), ids)

    @property
    def summary(self) -> DataFrame:
        fuzzy = F.lit(0).cast("long")
        if self.fuzzy_pairs is not None:
            fuzzy = self.fuzzy_pairs.agg(F.coalesce(F.sum(F.col("rows_a") * F.col("rows_b")), F.lit(0))).scalar()
        return self.df.agg(F.count("*").alias("total_records")).select(
            "total_records",
            self.exact.agg(F.count("*")).scalar().alias("exact_duplicate_count"),
            self.normalized.agg(F.count("*")).scalar().alias("normalized_duplicate_count"),
            fuzzy.alias("fuzzy_duplicate_count"),
            self.members.agg(F.count("*")).scalar().alias("total_unique_records_affected"),
            self.members.agg(F.count_distinct("canonical")).scalar().alias("clusters"),
        )
