"""The corpus operators against brute force on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import chat, graph, licenses, mixing, packing, pii, quality, sharding, simhash, substrings, topk

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _bucket string, `_source` int, text_key string"


def corpus(seed: int = 0, n: int = 120) -> list[tuple]:
    """NULLs in every column, empty and long texts, ties, repeated rows, near copies."""
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in "bcdfgh" for b in ("a", "e", "io", "é")]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 40, 90, 200]))) for _ in range(n)]
    texts += ["", " \t\n", "x" * 50_000, " ".join(["long"] * 6_000), None, None]
    texts += [texts[5]] * 20 + [texts[6] + " tail", "same line\nsame line\nother", "a b c\x0bd", "<|endoftext|> ok"]
    rows = [(i, t, "en", rng.choice(["s0", "s0", "s1", "s2", None]), 1, "b", 3, "k") for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[0], (None, texts[1], None, None, None, None, None, None), (None, None, None, "s1", None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def same_rows(got, want):
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


# --- chat formatting ---


def test_perspectives_against_plain_python(spark):
    rng = random.Random(1)
    turns = [(c, t, rng.choice(["bob", "eve mc<", None, "system"]), rng.choice(["hi", "", None, "é b"])) for c in (1, 2, None) for t in range(150 if c == 1 else 5)]
    turns += [(7, None, "a", "x"), (7, 1, "a", "x"), (7, 1, "a", "x"), (7, 1, "b", None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(3)
    parts = defaultdict(dict)
    for r in chat.rotate(df, part_turns=16).collect():
        assert r.n_turns <= 16
        spans = [tuple(map(int, m.split("-"))) for m in r.masks.split(",") if m]
        assert len(spans) == r.n_own_turns
        parts[r.conv_id, r.speaker][r.part] = (r.text, "".join(r.text[a:b] for a, b in spans))
    want = {}
    for conv in {t[0] for t in turns}:
        mine = [(t, r or "unknown", r is None, b or "", r or "") for c, t, r, b in turns if c == conv]
        mine.sort(key=lambda x: (x[0] is None, x[0] or 0, x[2], x[4], x[3]))
        names = [re.sub(r"[\s<|>]", "_", r) for _, r, _, _, _ in mine]
        for who in set(names):
            text = trained = ""
            for (_, _, _, body, _), name in zip(mine, names):
                text += ("<|assistant|>\n" if name == who else f"<|user name={name}|>\n") + body + "<|end|>\n"
                trained += body + "<|end|>" if name == who else ""
            want[conv, who] = (text, trained)
    got = {k: tuple("".join(v[p][i] for p in sorted(v)) for i in (0, 1)) for k, v in parts.items()}
    assert got == want


def test_roles_that_look_alike_are_participants_of_their_own(spark):
    turns = [(1, 0, "a b", "one"), (1, 1, "a_b", "two"), (1, 2, None, "three"), (1, 3, "unknown", "four"), (1, 4, "a b", "five"), (1, 5, "a_b~2", "six"), (2, 0, "a_b", "seven")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(3)
    got = {(r.conv_id, r.speaker): [r.text[int(a) : int(b)] for a, b in (m.split("-") for m in r.masks.split(","))] for r in chat.rotate(df).collect()}
    said = {("a_b"): ["one", "five"], "a_b~2": ["two"], "unknown": ["four"], "unknown~2": ["three"], "a_b_2": ["six"]}
    assert got == {**{(1, n): [f"{t}<|end|>" for t in x] for n, x in said.items()}, (2, "a_b"): ["seven<|end|>"]}


# --- packing ---


def test_very_long_runs_have_the_ids_of_the_named_tokenizer(spark):
    plain = packing.json_tokenizer()
    texts = [c * 2_000_000 for c in " \n\t"] + ["a\n" + " " * 150_000 + "b <|endoftext|>", "x" * 300_000, " \n" * 600_000]
    rows = packing.pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), capacity=1 << 30).collect()
    want = {i: np.array([*plain.encode(t, add_special_tokens=False).ids, 2], dtype="<u4") for i, t in enumerate(texts)}
    assert {r.doc_id: (r.length, r.ids_crc32) for r in rows} == {i: (len(x), zlib.crc32(x.tobytes())) for i, x in want.items()}


@pytest.mark.parametrize("capacity,seed", [(10, 1), (64, 2), (1024, 3)])
def test_plan_equals_best_fit_decreasing(capacity, seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randint(1, capacity), max(1, capacity // 3)]) for _ in range(3000)]
    used = defaultdict(list)
    for length, first, n, at, each, offset in packing.plan_slots(dict(Counter(lengths)), capacity):
        for i in range(n):
            used[at + i // each].append((offset + i % each * length, length))
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    assert Counter(n for v in used.values() for _, n in v) == Counter(lengths)
    free: list[int] = []
    for length in sorted(lengths, reverse=True):
        fitting = [r for r in free if r >= length]
        room = min(fitting) if fitting else capacity
        if fitting:
            free.remove(room)
        free.append(room - length)
    assert len(used) == len(free)


def test_packing_round_trip(docs):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(path("byte_bpe_50k.json"))
    rows = packing.pack(docs, capacity=256).collect()
    want = Counter()
    for doc_id, text, *_ in corpus():
        ids = [*encode.encode(text or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 256 + 1
        for piece, start in enumerate([0, *range(first, len(ids), 256)]):
            part = ids[start : first if piece == 0 else start + 256]
            want[doc_id, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 256


# --- sharding ---


def test_sources_of_one_row_lie_evenly(spark):
    """A source for each of 50,000 rows beside one large source: no bucket of the order is hot, shards stay level and mixed."""
    rows = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < 50_000, F.concat(F.lit("host"), F.col("id"))).otherwise("large").alias("source"))
    starts = rows.where("doc_id < 50000").select(F.floor(sharding.source_start(23, "source") * 64).alias("b")).groupBy("b").count().collect()
    assert len(starts) == 64 and max(r["count"] for r in starts) < 2 * 50_000 / 64
    per = sharding.shard_documents(rows).groupBy("shard").agg(F.count("*").alias("n"), F.count_if(F.col("source") == "large").alias("large")).collect()
    assert len(per) == 24 and all(r.n == 2500 and abs(r.large - 10_000 / 24) < 40 for r in per)


def test_shards_are_level_and_match_the_mixture(docs):
    rows = sharding.shard_documents(docs, shards=7).collect()
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in corpus())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    per = Counter(r.shard for r in rows)
    assert max(per.values()) - min(per.values()) <= 1 and set(per) == set(range(7))
    for shard, n in per.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    sources = Counter(r.source for r in rows)
    for source, n in sources.items():
        for shard in range(7):
            assert abs(sum(r.source == source and r.shard == shard for r in rows) - n / 7) < 2
    again = sharding.shard_documents(docs.repartition(3), shards=7).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


# --- mixing ---


def water_filling(sizes, weights, share, epochs):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, free, target = share * sum(sizes.values()), set(order), {}
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > epochs * sizes[s]}
        if not above:
            return target | {s: level * weight[s] for s in free}
        target |= {s: float(epochs * sizes[s]) for s in above}
        free -= above
    return target


@pytest.mark.parametrize("share,epochs", [(1.5, 2), (0.3, 2), (2.9, 3), (5.0, 2)])
def test_mixture_targets_and_what_is_taken(docs, share, epochs):
    plan = mixing.plan_mixture(docs, share=share, epochs=epochs)
    sizes = Counter()
    for _, text, _, source, *_ in corpus():
        sizes[source] += len(words_of(text))
    want = water_filling(sizes, mixing.WEIGHTS, share, epochs)
    got = {r.source: r.target for r in plan.collect()}
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s], rel=1e-9) for s in want)
    rows = mixing.with_copies(docs, plan).collect()
    assert len(rows) == len(corpus())
    taken = Counter()
    for r in rows:
        assert 0 <= r.copies <= epochs
        taken[r.doc.source] += r.copies * len(words_of(r.doc.text))
    longest = max(len(words_of(t)) for _, t, *_ in corpus())
    for s in want:
        assert abs(taken[s] - want[s]) <= longest
    mixed = mixing.mix(docs, share=share, epochs=epochs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)


# --- personal data ---

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 12 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return [(s, e, k) for s, _, e, k in sorted(out)]


def test_base_spans_against_plain_patterns():
    rng = random.Random(4)
    for _ in range(40_000):
        text = "".join(rng.choice("a@@..1234567 +-é(%") for _ in range(rng.randint(0, 50)))
        assert pii.base_spans(text) == plain_spans(text)
    assert pii.base_spans("mail x@y.org, 4111 1111 1111 1111, +49 (30) 1234567, 10.0.0.255, 1.2.3.256") == plain_spans("mail x@y.org, 4111 1111 1111 1111, +49 (30) 1234567, 10.0.0.255, 1.2.3.256")
    assert len(pii.base_spans("a" * 200_000 + "@" + "1" * 200_000)) == 0  # linear on long runs


def pii_rows():
    """An entity that 'zarvin' gives away, in four different texts; 'common' stands everywhere."""
    rows = [(i, f"common note {i} about {i} times this wrote filler text") for i in range(60)]
    rows += [(100 + i, f"common note {i} about zarvin, ann@x.org wrote this {i} times") for i in range(4)]
    rows += [(200 + i, "lonely quobix bob@x.org wrote") for i in range(5)]  # copies are one text
    return [*rows, (300, None), (301, ""), (None, "common zarvin ann@x.org"), (302, "zarvin? no")]


def test_disclosing_terms_are_found_and_generalised(spark):
    df = spark.createDataFrame(pii_rows(), "doc_id long, text string").repartition(4)
    rows = {r.doc_id: r for r in pii.report(df).collect()}
    assert len(rows) == len(pii_rows())
    for doc_id, text in pii_rows():
        base = pii.span_text(plain_spans(text))
        assert rows[doc_id].base == base
        terms = [x for x in rows[doc_id].spans.split(",") if x.startswith("term")]
        shown = [text[int(x.split(":")[1]) : int(x.split(":")[2])] for x in terms]
        assert ("zarvin" in shown) == ("zarvin" in (text or "") and "ann@" in text)
        assert "common" not in shown and "quobix" not in shown
        assert [x for x in rows[doc_id].spans.split(",") if x and x not in terms] == [x for x in base.split(",") if x]
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[100] == "common note 0 about [TERM], [EMAIL] wrote this 0 times"
    assert clean[200] == "lonely quobix [EMAIL] wrote" and clean[300] is None and clean[301] == "" and clean[302] == "zarvin? no"


def test_disclosure_equals_the_formula(spark):
    df = spark.createDataFrame(pii_rows(), "doc_id long, text string")
    found = pii.scan(df)
    got = {(r.entity, r.term): r.disclosure for r in pii.disclosing_terms(df, found, threshold=0.0).collect()}
    n = sum(t is not None for _, t in pii_rows())
    value = math.log(5 * n / (6 * 5)) / math.log(n / 5)
    assert got[pii._digest("email:ann@x.org"), pii._digest("zarvin")] == pytest.approx(value, rel=1e-12)


def test_every_occurrence_of_a_disclosing_term_goes(spark):
    """The term stands ten words off its entity, twice in a text, and in texts without the entity."""
    far = "one two three four five six seven eight nine ten"
    rows = [(i, f"common note {i} {far} filler text") for i in range(60)]
    rows += [(100 + i, f"Zarvin {far} {i} ann@x.org {far} zarvin") for i in range(8)] + [(200, "zarvin? no")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    clean = {r.doc_id: r.text for r in pii.sanitise(df, everywhere=True).collect()}
    assert clean[103] == f"[TERM] {far} 3 [EMAIL] {far} [TERM]" and clean[200] == "[TERM]? no" and clean[5] == rows[5][1]
    spans = {r.doc_id: r.spans for r in pii.report(df, everywhere=True).collect()}
    assert spans[200] == "term:0:6" and spans[5] == "" and spans[103].count("term") == 2
    beside = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert beside[103] == clean[103] and beside[200] == "zarvin? no"


def test_terms_that_are_joined_give_the_same_spans(spark):
    """With ``limit=0`` no term travels with the function; copies, NULL and empty texts and clashing columns among the rows."""
    rows = [*pii_rows(), (303, "ZARVIN, (zarvin) and xzarvin"), (304, "lonely zarvin"), (304, "lonely zarvin")]
    df = spark.createDataFrame([(*r, "kept", 7) for r in rows], "doc_id long, text string, terms string, h long").repartition(4)
    for everywhere in (True, False):
        sent = sorted(pii.report(df, everywhere=everywhere, threshold=0.7).collect(), key=str)
        assert sorted(pii.report(df, everywhere=everywhere, threshold=0.7, limit=0).collect(), key=str) == sent
        clean = pii.sanitise(df, everywhere=everywhere, threshold=0.7, limit=0)
        assert clean.columns == df.columns
        assert sorted(clean.collect(), key=str) == sorted(pii.sanitise(df, everywhere=everywhere, threshold=0.7).collect(), key=str)
    joined = {r.doc_id: r.text for r in pii.sanitise(df, everywhere=True, limit=0, threshold=0.7).collect()}
    assert joined[303] == "[TERM], ([TERM]) and xzarvin" and joined[304] == "lonely [TERM]" and joined[300] is None


def test_unique_values_are_protected_by_their_classes(spark):
    """Every address and number stands in one text only; 'quellmark' comes with its domain, 'dialix' with phone numbers."""
    rows = [(i, f"common note {i} about filler text") for i in range(60)]
    rows += [(100 + i, f"common quellmark wrote, u{i}@corp.example {i}") for i in range(5)]
    rows += [(200 + i, f"common dialix +49 {30 + i} 12345{i}7 about") for i in range(5)]
    rows += [(300 + i, f"common other v{i}@site{i}.example {i}") for i in range(5)] + [(400, "quellmark and dialix alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    clean = {r.doc_id: r.text for r in pii.sanitise(df, everywhere=True).collect()}
    assert clean[102] == "common [TERM] [TERM], [EMAIL] 2"
    assert clean[203] == "common [TERM] [PHONE] about" and clean[400] == "[TERM] and [TERM] alone"
    assert clean[301].startswith("common [TERM] [EMAIL]") and clean[7] == rows[7][1]


# --- licences ---


def test_phrases_against_word_lists(docs, spark):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = [t for _, t, *_ in corpus()] + ["MIT License, mit license; CC-BY 4.0", "GNU General Public License", "Émit license", "Licensed under the Apache License, Version 2.0."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.scan_documents(df).collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (texts[r.doc_id] or "").translate(lower))
        places = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + phrase.count(" ") + 1] == phrase.split()]
        starts = [i for i, _ in places]
        want = (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
    last = licenses.scan_documents(df).where(F.col("doc_id") == len(texts) - 1).first()
    assert last.labels == "apache,apache-2.0-notice" and last.score == 1.0


def accepts(template: str, words: list[str]) -> bool:
    """Plain recursion over the template's parts."""
    parts = re.findall(r"\[\[|\]\]|\{\{\d+\}\}|\S+", template)

    def close(i):
        depth = 0
        for j in range(i, len(parts)):
            depth += (parts[j] == "[[") - (parts[j] == "]]")
            if depth == 0:
                return j

    def go(i, j):
        if i == len(parts):
            return j == len(words)
        if parts[i] == "[[":
            return go(i + 1, j) or go(close(i) + 1, j)
        if parts[i] == "]]":
            return go(i + 1, j)
        if parts[i].startswith("{{"):
            return any(go(i + 1, k) for k in range(j, min(len(words), j + int(parts[i][2:-2])) + 1))
        return j < len(words) and words[j] == parts[i] and go(i + 1, j + 1)

    return go(0, 0)


@pytest.mark.parametrize("template", ["a [[ b c ]] {{2}} d [[ e ]]", "[[ a ]] b {{1}} c", "a [[ b [[ c ]] {{1}} ]] a"])
def test_automata_against_recursion(template):
    rng = random.Random(9)
    automaton = licenses.compile_template("t", template)
    for _ in range(600):
        words = [rng.choice("abcde") for _ in range(rng.randint(0, 9))]
        found = licenses.accept(automaton, [w.encode() for w in words])
        assert all(accepts(template, words[s:e]) for s, e in found)
        ends = [any(accepts(template, words[s:e]) for s in range(e + 1)) for e in range(1, len(words) + 1)]
        assert bool(found) == any(ends)


def test_templates_start_with_words():
    with pytest.raises(ValueError):
        licenses.compile_template("t", "{{3}} license")


def test_whole_wording_is_asked_for():
    """A whole text fits its own template; cut short or with one word altered near its end it fits none of the texts."""
    automata = [licenses.compile_template(label, t) for label, t in licenses.TEMPLATES.items() if label.endswith("-text")]
    assert all(label.endswith(("-text", "-notice")) for label in licenses.TEMPLATES) and len(automata) == 13
    fit = lambda words: {a.label for a in automata if licenses.accept(a, words)}
    for a in automata:
        plain = re.sub(r"\[\[.*?\]\]", " ", licenses.TEMPLATES[a.label]).replace("{{1}}", "1")
        words = re.sub(r"\{\{\d+\}\}", "the authors", plain).encode().split()
        assert fit([b"intro", *words, b"more"]) == {a.label}
        assert fit(words[:-1]) == set() and fit([*words[:-9], b"altered", *words[-8:]]) == set()


def test_licence_files_get_their_label(spark):
    from pathlib import Path

    files = {"Apache-2.0": "apache-2.0-text", "GPL-2": "gpl-2.0-text", "GPL-3": "gpl-3.0-text", "LGPL-2.1": "lgpl-2.1-text", "LGPL-3": "lgpl-3.0-text", "MPL-2.0": "mpl-2.0-text", "CC0-1.0": "cc0-1.0-text"}
    texts = [(f"{Path(licenses.__file__).parent}/licence_texts/{f}.txt", label) for f, label in files.items()]
    df = spark.createDataFrame([(i, Path(p).read_text()) for i, (p, _) in enumerate(texts)], "doc_id long, text string")
    for r in licenses.scan_documents(df).collect():
        assert [x for x in r.labels.split(",") if x.endswith("-text")] == [texts[r.doc_id][1]] and r.score > 0.7


# --- SimHash ---


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    bits = [sum((xxhash.xxh64_intdigest(s, 42) >> j) & 1 for s in shingles) for j in range(64)]
    return sum(1 << j for j in range(64) if 2 * bits[j] > len(shingles))


def closure(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("size,flips", [(3, 2), (150, 5), (400, 9)])
def test_bit_sliced_links_against_all_pairs(size, flips):
    rng = random.Random(size)
    base, out = rng.getrandbits(64), set()
    for _ in range(size):
        x = base
        for _ in range(rng.randint(0, flips)):
            x ^= 1 << rng.randrange(64)
        out.add(simhash._signed(x))
    links = set(simhash.bucket_links([sorted(out), sorted(out)[:2], [7]]))
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    assert closure(out, lambda a, b: (a, b) in links or (b, a) in links) == closure(out, near)


def test_near_duplicates_against_brute_force(docs):
    rows = simhash.near_duplicates(docs).collect()
    prints = {}
    want_prints = Counter((d, plain_fingerprint(t)) for d, t, *_ in corpus())
    assert Counter((r.doc_id, r.fingerprint & (2**64 - 1)) for r in rows) == want_prints
    roots = closure({p for _, p in want_prints}, lambda a, b: (a ^ b).bit_count() <= 3)
    for d, p in want_prints:
        if d is not None:
            prints[roots[p]] = min(d, prints.get(roots[p], d))
    assert all(r.component_id == prints[roots[r.fingerprint & (2**64 - 1)]] for r in rows)


def test_crowded_bands_are_cut_without_loss(spark):
    rng = random.Random(8)
    base = rng.getrandbits(64)
    values = set()
    for _ in range(500):
        x = base
        for _ in range(rng.randint(0, 4)):
            x ^= 1 << rng.randrange(64)
        values.add(simhash._signed(x))
    df = spark.createDataFrame([(v,) for v in values], "fingerprint long").repartition(3)
    links = {tuple(r) for r in simhash.fingerprint_links(df, limit=32).collect()}
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    assert closure(values, lambda a, b: (a, b) in links or (b, a) in links) == closure(values, near)


def test_one_document_of_each_group_stays(docs):
    """Groups by brute force: narrow fingerprints within three bits, wide ones that share a band within the radius."""
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    prints = {(d, t or ""): (plain_fingerprint(t), simhash.wide_fingerprint(t)) for d, t, *_ in corpus()}
    radius = simhash.wide_radius(0.8, 512)

    def near(a, b):
        (na, wa), (nb, wb) = prints[a], prints[b]
        apart = (int.from_bytes(wa) ^ int.from_bytes(wb)).bit_count()
        band = any(wa[i : i + 2] == wb[i : i + 2] for i in range(0, 64, 2))
        return (na ^ nb).bit_count() <= 3 or (band and apart <= radius)

    order = sorted(prints, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    rank = {x: i for i, x in enumerate(order)}
    groups = closure(set(range(len(order))), lambda i, j: near(order[i], order[j]))
    found = [groups[rank[r.doc_id, r.text or ""]] for r in kept.collect()]
    assert len(found) == len(set(found)) and set(found) == set(groups.values())


def test_one_row_of_each_simhash_group_stays(docs, spark):
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    order = sorted({(d, t or "") for d, t, *_ in corpus()}, key=lambda x: (x[0] is None, x[0] or 0, hashlib.md5(x[1].encode()).hexdigest()))
    prints = [plain_fingerprint(t) for _, t in order]
    groups = closure(set(range(len(order))), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    assert sorted(order.index((r.doc_id, r.text or "")) for r in kept.collect()) == sorted(set(groups.values()))
    assert simhash.one_per_group(spark.createDataFrame([], SCHEMA)).count() == 0


def test_near_copies_go_and_unlike_texts_stay(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for i in range(60):
        base = [word() for _ in range(250)]
        copy = base[:]
        for at in rng.sample(range(250), 2):
            copy[at] = word()
        other = base[:60] + [word() for _ in range(190)]  # shares a passage, not the text
        rows += [(3 * i, " ".join(base)), (3 * i + 1, " ".join(copy)), (3 * i + 2, " ".join(other))]
    left = {r.doc_id for r in simhash.keep_representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(3 * i in left and 3 * i + 2 in left for i in range(60))
    assert sum(3 * i + 1 in left for i in range(60)) <= 2


def test_groups_equal_true_jaccard_around_the_bound(spark):
    """Copies from well under to well over a similarity of 0.8: exactly those at 0.8 or more are joined."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage, texts = [word() for _ in range(40)], []
    for i in range(240):
        base = [word() for _ in range(rng.choice([30, 120, 260]))] + (passage if i % 3 == 0 else [])
        copy, share = base[:], rng.uniform(0.01, 0.06)
        for at in rng.sample(range(len(base)), max(1, round(share * len(base)))):
            copy[at] = word()
        texts += [" ".join(base), " ".join(copy)]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    prints = [plain_fingerprint(t) for t in texts]
    near = lambda a, b: 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]) or (prints[a] ^ prints[b]).bit_count() <= 3
    alike = [len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(0, 480, 2)]
    assert sum(0.8 <= x < 0.87 for x in alike) > 20 and sum(0.7 < x < 0.8 for x in alike) > 20
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    left = {r.doc_id for r in simhash.keep_representatives(df).collect()}
    assert left == set(closure(range(480), near).values())


def test_wide_tiles_lose_nothing(spark):
    rng = random.Random(13)
    base, prints = rng.getrandbits(512), set()
    for _ in range(150):
        x = base
        for _ in range(rng.randint(20, 60)):
            x ^= 1 << rng.randrange(512)
        prints.add(x.to_bytes(64))
    df = spark.createDataFrame([(bytearray(p),) for p in prints], "wide binary").repartition(3)
    links = {(bytes(r.u), bytes(r.v)) for r in simhash.wide_links(df, limit=20).collect()}

    def near(a, b):
        band = any(a[i : i + 2] == b[i : i + 2] for i in range(0, 64, 2))
        return band and (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() <= simhash.wide_radius(0.8, 512)

    assert closure(prints, lambda a, b: (a, b) in links or (b, a) in links) == closure(prints, near)


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 500), (901, 900)]
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}


# --- substrings ---


def plain_removal(rows, k):
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    seen = Counter(tuple(w[i : i + k]) for _, w in texts for i in range(len(w) - k + 1))
    out = []
    for d, w in texts:
        gone = {j for i in range(len(w) - k + 1) if seen[tuple(w[i : i + k])] > 1 for j in range(i, i + k)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("k,m,hot", [(5, 2, 6), (12, 3, 2000), (35, 4, 10)])
def test_repeated_windows_against_brute_force(spark, docs, k, m, hot):
    rng = random.Random(k)
    rows = [(d, t) for d, t, *_ in corpus()] + [(1000 + i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(150)]
    shared = " ".join(f"w{j}" for j in range(50))
    rows += [(2000 + i, f"x {i} {shared} {i} z") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    same_rows(substrings.report(df, k=k, m=m, hot=hot).collect(), plain_removal(rows, k))


def test_control_characters_do_not_shift_windows(spark):
    """\\x1c-\\x1f cut no words, though str.split() cuts at them: all-ASCII texts that hold them before a shared passage."""
    shared = " ".join(f"w{j}" for j in range(50))
    rows = [(i, f"x{c}{i} y{c}{c}z {shared} {i} end") for i, c in enumerate("\x1c\x1d\x1e\x1f" * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for hot in (1, 2000):
        same_rows(substrings.report(df, k=12, m=3, hot=hot).collect(), plain_removal(rows, 12))


def test_removed_words_leave_the_text(docs):
    after = substrings.remove_repeats(docs, k=12, m=3)
    assert after.columns == docs.columns
    want = Counter((d, n == 0, digest) for d, _, n, digest in plain_removal([(d, t) for d, t, *_ in corpus()], 12))
    got = Counter()
    for r in after.collect():
        kept = " ".join(words_of(r.text))
        got[r.doc_id, (r.doc_id, r.text) in {(d, t) for d, t, *_ in corpus()}, hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert Counter(k[::2] for k in got.elements()) == Counter(k[::2] for k in want.elements())


# --- quality rules ---


def plain_counts(text):
    text = text or ""
    w = words_of(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    repeated = {j for i, x in enumerate(windows) if often[x] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if words_of(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def test_counts_and_verdicts_against_plain_python(docs):
    rows = quality.judge_documents(docs).collect()
    same_rows([tuple(r)[:6] for r in rows], [(d, *plain_counts(t)) for d, t, *_ in corpus()])
    for r in rows:
        failed = r.n_words < 50 or 2 * r.n_repeat_words > r.n_words
        assert r.kept == (r.rejected_by is None) and not (failed and r.kept)
    kept = quality.keep_documents(docs)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in rows if r.kept)


def test_the_order_of_rules_changes_no_verdict(docs):
    verdicts = set()
    for rules in (quality.default_rules(), quality.default_rules()[::-1]):
        verdicts.add(tuple(sorted(str((r.doc_id, r.kept)) for r in quality.judge_documents(docs, rules=rules, sample_rows=3).collect())))
    assert len(verdicts) == 1


def test_rules_are_ordered_by_rejections_per_second():
    rule = lambda name, need: quality.Rule(name, (need,), lambda d: False)
    cost = {"words": 1.0, "n_words": 10.0, "n_symbols": 0.1}
    seen = [{"rejected": ["b"] if i < 9 else ["a", "c"] if i < 12 else [], "cost": cost} for i in range(20)]
    order = quality.order_rules([rule("a", "words"), rule("b", "n_words"), rule("c", "n_symbols")], seen)
    assert [r.name for r in order] == ["c", "b", "a"]  # 3 for 0.1, then 9 for 10; a has nothing left to reject


# --- top-k ---


def test_top_k_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    vectors = {i: rng.normal(size=8).tolist() for i in range(160)}
    vectors |= {200: [0.0] * 8, 201: vectors[7], 202: vectors[7], 203: [1.0], 205: [float("nan")] * 8, 206: [1.0, None] * 4, 207: None, 208: [1e300] * 8, 210: [], 211: [], 215: [float("inf")] * 8, 220: [-1e-3] * 8}
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors.items()] + [(None, [0.0] * 8, 0)], "vec_id long, embedding array<double>, label int").repartition(4)
    good = {i: [math.floor(x * 256) for x in v] for i, v in vectors.items() if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in good if i % 5 == 0):
        scores = [(-max(-(2**63), min(2**63 - 1, sum(map(int.__mul__, good[q], v)))), i) for i, v in good.items() if i != q and len(v) == len(good[q])]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:5])]
    same_rows(topk.top_k(df, F.col("vec_id") % 5 == 0, block=40, query_block=9).collect(), want)


def test_repeated_rows_ask_once(spark):
    rows = [(50, [0.5, 0.25]), (50, [0.5, 0.25]), (50, [0.0, 1.0]), *[(i, [i / 64, 1 - i / 64]) for i in range(1, 9)], (8, [8 / 64, 1 - 8 / 64])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).collect()
    want = []
    for q in ([0.5, 0.25], [0.0, 1.0]):
        others = sorted((-sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(q, v)), i) for i, v in rows if i != 50)
        want += [(50, r, i, -s) for r, (s, i) in enumerate(others[:5], 1)]
    same_rows(got, want)


# --- empty tables, clashing columns ---


def test_empty_tables(spark, empty):
    for table in (
        packing.pack(empty),
        sharding.shard_documents(empty),
        mixing.mix(empty),
        mixing.with_copies(empty, mixing.plan_mixture(empty)),
        pii.report(empty),
        pii.sanitise(empty),
        licenses.scan_documents(empty),
        simhash.near_duplicates(empty),
        simhash.keep_representatives(empty),
        substrings.report(empty),
        substrings.remove_repeats(empty),
        quality.judge_documents(empty),
        quality.keep_documents(empty),
        chat.rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")),
        topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0),
    ):
        assert table.count() == 0


def test_pipeline_stages_hand_on_documents(spark, tmp_path):
    import corpus_pipeline

    rows = [r[:5] for r in corpus()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns, name
        docs = corpus_pipeline.stored(after)
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert json.loads(pieces.toJSON().first() or "{}").keys() >= {"doc_id", "sequence_id", "offset"}
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").distinct().collect()}
