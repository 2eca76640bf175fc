"""Duplicate tiers, clusters, and the fuzzy join against brute force."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from tidemark.functions.similarity import common_subsequence
from pyspark.sql import functions as F

from tidemark.operators import duplicates
from tidemark.operators.components import connected_components


def _edges(df):
    return sorted((r.index_a, r.index_b) for r in df.collect())


def test_exact_and_normalized(rows):
    df = rows(case_id=["A", "A", "B"], client_name=["X", "X", "Y"], status=["Open", "Open", "Open"])
    assert _edges(duplicates.exact_duplicates(df)) == [(0, 1)]
    df = rows(case_id=["A", "B", "C"], client_name=["Acme  Corp", " acme corp", ""], category=["Billing", "BILLING", ""], intake_date=["1", "1", ""])
    assert _edges(duplicates.normalized_duplicates(df)) == [(0, 1)]


def test_fuzzy_fixture(rows):
    df = rows(client_name=["Fuzzy Matching Co", "Fuzzy Matching Company", "Totally Unrelated Inc"], category=["A", "A", "B"])
    got = duplicates.fuzzy_duplicates(df, threshold=80.0).collect()
    assert [(r.index_a, r.index_b, r.similarity_score) for r in got] == [(0, 1, 87.18)]


def _ratio(a, b):
    return 200.0 * common_subsequence([a], [b])[0] / (len(a) + len(b))


@pytest.mark.parametrize("threshold", [60.0, 75.0, 85.0])
def test_fuzzy_rows_equal_brute_force(rows, threshold):
    random.seed(int(threshold))
    words = ["acme", "acmee", "corp", "crop", "co", "ltd", "lt", "north", "norht", "a", "ab"]
    names = [" ".join(random.choice(words) for _ in range(random.randint(1, 3))) for _ in range(70)]
    kinds = [random.choice(["billing", "billng", "hardware", ""]) for _ in names]
    want = set()
    for i, a in enumerate(names):
        for j in range(i + 1, len(names)):
            b = names[j]
            alike = _ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))) >= threshold
            if a != b and alike and (not kinds[i] or not kinds[j] or kinds[i] == kinds[j] or _ratio(kinds[i], kinds[j]) >= 70):
                want.add((i, j))
    df = rows(client_name=names, category=kinds)
    got = _edges(duplicates.fuzzy_duplicates(df, threshold=threshold))
    assert len(got) == len(set(got)) and set(got) == want
    # The short edge list gives the same clusters as all row pairs.
    pairs = duplicates.fuzzy_group_pairs(df, threshold=threshold)
    short = {tuple(r) for r in connected_components(duplicates.fuzzy_links(df, pairs)).collect()}
    full = {tuple(r) for r in connected_components(duplicates.fuzzy_duplicates(df, threshold=threshold)).collect()}
    assert short == full


def test_hot_grams_are_split_without_loss(spark):
    names = [f"customer {i:03d}" for i in range(60)]
    df = spark.createDataFrame([(n,) for n in names], "sorted_name string")
    plain = {tuple(r)[:2] for r in duplicates.similar_texts(df, 90.0).collect()}
    assert {tuple(r)[:2] for r in duplicates.similar_texts(df, 90.0, salt_rows=7).collect()} == plain and plain
    near, far = duplicates.gram_lanes(duplicates._prefixes(df, 90.0), salt_rows=7)
    for side in (near, far):
        # 60 texts in nine lanes: no group of a gram and two lanes holds much more than its share.
        assert side.groupBy("g", "lane_a", "lane_b").count().agg(F.max("count")).first()[0] <= 3 * 7


def test_components_equal_union_find(spark):
    random.seed(3)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(500 + i, 501 + i) for i in range(40)] + [(900, 901 + i) for i in range(50)]
    parent: dict[int, int] = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    want = {(n, find(n)) for n in nodes}
    got = connected_components(spark.createDataFrame(edges, "index_a long, index_b long")).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_report(rows):
    df = rows(case_id=["1", "2", "3", "4"], client_name=["Fuzzy Matching Co", "Fuzzy Matching Company", "Solo", "solo "],
              category=["A", "A", "B", "B"], intake_date=["x"] * 4, closure_date=["y"] * 4)
    report = duplicates.DuplicateReport(df)
    s = report.summary.first()
    assert (s.exact_duplicate_count, s.normalized_duplicate_count, s.fuzzy_duplicate_count, s.total_unique_records_affected, s.clusters) == (0, 1, 1, 4, 2)
    groups = {r.canonical_index: (r.total_records, r.match_type, r.sample_identifier) for r in report.groups.collect()}
    assert groups == {0: (2, "FUZZY", "1"), 2: (2, "NORMALIZED", "3")}
    clusters = defaultdict(list)
    for r in report.members.collect():
        clusters[r.canonical].append(r.member)
    assert {k: sorted(v) for k, v in clusters.items()} == {0: [0, 1], 2: [2, 3]}
