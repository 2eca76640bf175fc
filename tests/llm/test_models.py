"""Clustering, the language model and hard negatives against brute force, with awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import clustering, lm, negatives

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<float>, label int, cluster string, v int, id string, score int"


def vector_rows(seed: int, n: int, dim: int, spread: int = 6) -> list[tuple]:
    """Few distinct values, so that distances and scores tie; unusable rows; repeated rows; columns with clashing names."""
    rng = random.Random(seed)
    rows = [(i, [rng.randint(-spread, spread) / 8 for _ in range(dim)], rng.choice([0, 1, 2, 9])) for i in range(n)]
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.5] * (dim + 1), 1), (n + 3, [NAN, *[0.5] * (dim - 1)], 1), (n + 4, [*[0.5] * (dim - 1), INF], 2)]
    rows += [(n + 5, [None, *[0.5] * (dim - 1)], 1), (n + 6, [0.5] * dim, None), (None, [0.25] * dim, 1), (50, [0.75] * dim, 1), rows[0], rows[0], rows[7], (3, rows[3][1], 9)]
    return [(*r, "c", 3, "i", 4) for r in rows]


def usable(v) -> bool:
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def whole(v) -> list[int]:
    return [math.floor(256 * np.float64(np.float32(x))) for x in v]


# --- clustering ---


def lloyd(rows, k, rounds, dim, seed):
    kept = [(i, whole(v)) for i, v, *_ in rows if usable(v) and len(v) == dim]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        of = defaultdict(list)
        for _, v in kept:
            of[near(v)[1]].append(v)
        centres = [[sum(x) // len(of[j]) for x in zip(*of[j])] if of[j] else c for j, c in enumerate(centres)]
    out = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, c, d in out:
        inertia[c] += d
    return [(i, c, d, inertia[c], sum(inertia.values()), tuple(centres[c])) for i, c, d in out]


@pytest.mark.parametrize("n,k,dim", [(150, 12, 5), (4, 40, 3)])
def test_clusters_equal_plain_rounds(spark, n, k, dim):
    rows = vector_rows(n, max(n, 8), dim)
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    got = [(*r[:5], tuple(r[5])) for r in clustering.clusters(df, k=k, rounds=4, dim=dim).collect()]
    show = lambda x: str(x)
    assert sorted(got, key=show) == sorted(lloyd(rows, k, 4, dim, clustering.SEED), key=show)


def test_clusters_of_an_empty_table_and_of_large_components(spark):
    empty = clustering.clusters(spark.createDataFrame([], VECTORS))
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"] and empty.count() == 0
    far = clustering.clusters(spark.createDataFrame([(1, [3e38, -3e38]), (2, [-3e38, 3e38]), (3, [0.0, 0.0])], "vec_id long, embedding array<float>"), k=1, dim=2)
    assert {r.cluster for r in far.collect()} == {0} and all(0 <= r.distance <= r.cluster_inertia == r.inertia for r in far.collect())


# --- hard negatives ---


def mined(rows, positives, take, step):
    kept = [(i, y, whole(v)) for i, v, y, *_ in rows if i is not None and y is not None and usable(v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, y, v in {(i, y, tuple(v)) for i, y, v in kept if i % step == 0}:
        others = sorted(((-dot(v, w), j, z) for j, z, w in kept if j != i and len(w) == len(v)), key=lambda x: x[:2])
        for s, j, _ in [o for o in others if o[2] == y][:positives]:
            fitting = [o for o in others if o[2] != y and 50 * -s <= 100 * -o[0] <= 95 * -s][:take]
            out += [(i, j, r, o[1], -s, -o[0]) for r, o in enumerate(fitting, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed,n,dim,block", [(1, 120, 3, 16), (2, 90, 1, 4096), (3, 60, 8, 7)])
def test_negatives_equal_brute_force(spark, seed, n, dim, block):
    rows = vector_rows(seed, n, dim)
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = negatives.mine(df, F.col("vec_id") % 5 == 0, block=block, anchor_block=block).collect()
    assert sorted(map(tuple, got)) == mined(rows, negatives.POSITIVES, negatives.TAKE, 5)


def test_negatives_of_an_empty_table_and_of_scores_beyond_doubles(spark):
    assert negatives.mine(spark.createDataFrame([], VECTORS), F.col("vec_id") % 5 == 0).count() == 0
    a = np.array([[2.0**40, 1.0], [2.0**70, 0.0]])
    assert negatives.products(a, a).tolist() == [[2**63 - 1, 2**63 - 1], [2**63 - 1, 2**63 - 1]]
    b = np.array([[2.0**30, 1.0]])
    assert negatives.products(b, b).tolist() == [[2**60 + 1]]


def test_slots_answer_overlapping_windows():
    rng = random.Random(4)
    for _ in range(200):
        scores = [rng.randint(-20, 60) for _ in range(30)]
        positives = np.array([rng.randint(-10, 60) for _ in range(5)])
        limits = np.unique(negatives.upper_limits(positives))
        slots, held = negatives.slots_of(np.array(scores), limits), defaultdict(list)
        for s in range(len(limits)):
            held[s] = sorted(((scores[i], i) for i in range(30) if slots[i] == s), key=lambda x: (-x[0], x[1]))[:3]
        merged = negatives.answer(limits, held, 3)
        for u, found in zip(limits, merged):
            assert found == sorted(((x, i) for i, x in enumerate(scores) if x <= u), key=lambda x: (-x[0], x[1]))[:3]


# --- language model ---


TEXTS = "doc_id long, text string, t string, held string, row int, word string, part string"


def prose(seed: int, n: int) -> list[tuple]:
    """Two languages whose words come in fixed orders, so that the words before tell much."""
    rng = random.Random(seed)
    tongues = [[f"{a}{b}{e}" for a in "bcdfg" for b in "aeiou"] for e in ("ra", "lt")]
    texts = []
    for _ in range(n):
        words, at = rng.choice(tongues), rng.randrange(25)
        picked = []
        for _ in range(rng.randint(5, 120)):
            at = (at + rng.choice([1, 1, 1, 7])) % 25
            picked.append(words[at] if rng.random() < 0.9 else f"x{rng.randrange(5000)}{words[0][-2:]}")
        texts.append(" ".join(picked))
    rows = [(i, x) for i, x in enumerate(texts)]
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "A\x1fb a\x1fB É é"), (None, "bara cera"), (None, None), (n + 4, "w" * 500 + " " + "w" * 500), (n + 5, "w" * 499)]
    return [(*r, "t", "h", 1, "w", "p") for r in [*rows, rows[0], rows[0]]]


def tokens_of(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode())), b"end"]


def is_held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def test_base_scores_and_counts_equal_brute_force(spark, monkeypatch):
    rows = prose(1, 300)
    monkeypatch.setattr(lm, "FREQUENT", 40)
    df = spark.createDataFrame(rows, TEXTS).repartition(4)
    c = Counter(w for i, x, *_ in rows if not is_held(i) for w in tokens_of(x))
    total, types = sum(c.values()), len(c)
    want = []
    for i, x, *_ in rows:
        w = tokens_of(x)
        base = sum(math.log10((c[t] + 0.5) / (total + 0.5 * (types + 1))) for t in w)
        want.append((i, is_held(i), len(w), sum(c[t] > 0 for t in w), total, round(base, 6)))
    got = lm.score_documents(df).collect()
    show = lambda x: str(x)
    assert sorted(((*r[:5], round(r[5], 6)) for r in got), key=show) == sorted(want, key=show)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 1.2 * sum(r.base_score for r in held)  # both are negative: it has learned the order


def test_frequent_words_give_the_same_scores_as_joined_ones(spark):
    docs = spark.createDataFrame(prose(2, 60), TEXTS).coalesce(1).select(F.col("doc_id").alias("id"), lm.held_out("doc_id").alias("held"), F.col("text").alias("t"), F.lit(0).alias("part")).cache()
    counted = lm.count_words(docs).cache()
    many, few = (lm.learn_vocabulary(counted, head=20, classes=5, frequent=n) for n in (10**6, 30))
    assert many.symbols.keys() >= few.symbols.keys() and len(few.frequent) <= 31
    known = {bytes(r["word"]): r["train"] for r in counted.collect()}
    assert all(known[w] == n for w, n in many.frequent.items()) and many.frequent.keys() == known.keys()


def test_probabilities_of_a_place_add_up_to_one(spark):
    docs = spark.createDataFrame(prose(3, 80), TEXTS).select(lm.held_out("doc_id").alias("held"), F.col("text").alias("t"))
    words = lm.learn_vocabulary(lm.count_words(docs), head=20, classes=6)
    model = lm.LogBilinear.first(words.counts)
    lm.Trainer(model, words.counts).train(np.random.default_rng(0).integers(0, model.n, (2000, lm.CONTEXT)), np.random.default_rng(1).integers(0, model.n, 2000))
    before = np.full((model.n, lm.CONTEXT), 3)
    each = 10 ** model.log_probabilities(before, np.arange(model.n))
    assert abs(each.sum() - 1) < 1e-5
    inside = defaultdict(float)
    for w, c in words.frequent.items():
        if c and words.symbol(w) >= len(words.symbols):
            inside[words.symbol(w)] += (c + 0.5) / 10 ** words.share[words.symbol(w)]
    for symbol, share in inside.items():  # what is left is one unseen word's share
        assert abs(share + 0.5 / 10 ** words.share[symbol] - 1) < 1e-9
    assert words.counts.sum() == words.tokens


def test_gradients_raise_the_contrastive_objective():
    rng = np.random.default_rng(5)
    counts = rng.integers(1, 50, 30).astype(float)
    model = lm.LogBilinear.first(counts, context=2, width=4)
    target = rng.integers(0, 30, 4000)
    before = np.stack([(target + 1) % 30, rng.integers(0, 30, 4000)], axis=1)
    start = model.log_probabilities(before, target).mean()
    trainer = lm.Trainer(model, counts, noise=16)
    for _ in range(5):
        trainer.train(before, target)
    assert model.log_probabilities(before, target).mean() > start + 0.5


def test_model_on_empty_tables_and_very_long_texts(spark):
    empty = lm.score_documents(spark.createDataFrame([], TEXTS))
    assert empty.count() == 0 and empty.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    one = lm.score_documents(spark.createDataFrame([(2, "a b")], "doc_id long, text string")).first()
    held = next(i for i in range(50) if is_held(i))
    none = lm.score_documents(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (one.train_tokens, one.n_known, none.train_tokens, none.n_known) == (3, 3, 0, 0)
    assert abs(none.base_score - 3 * math.log10(0.5 / 0.5)) < 1e-12
    long = [(2, "ab " * 700_000), (3, "y" * 2_000_000), (7, "\n" * 2_000_000)]
    got = {r.doc_id: r for r in lm.score_documents(spark.createDataFrame(long, "doc_id long, text string")).collect()}
    assert [got[i].n_tokens for i in (2, 3, 7)] == [700_001, 2, 1] and all(math.isfinite(r.score) for r in got.values())
