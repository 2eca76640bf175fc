"""Information-theoretic sanitisation of personal data.

Protected entities are the values that fixed patterns find: e-mail and IP addresses, payment cards, phone
numbers. A term can reveal an entity without naming it: it does so as far as meeting the term makes meeting
the entity likelier. Counts over all documents,

    n(e)     documents with entity e      n(t, e)  documents with term t and entity e, wherever they stand
    n(t)     documents with term t        N        documents

give the pointwise mutual information ``log(n(t,e) N / (n(t) n(e)))`` and the entity's information
``log(N / n(e))``. The term discloses the share PMI / information of the entity; at ``threshold`` or more,
and with at least ``support`` different texts behind it (copies aren't evidence), its occurrences are generalised (a
number to ``[NUMBER]``, a word to ``[TERM]``) along with the entity itself (``[EMAIL]`` ...): with ``everywhere``, as in
the registered query and the pipeline, in every document, otherwise in the documents that hold the entity. Only
entities with ``support`` texts meet the terms of their documents, so the work grows with these documents.

Most values stand in one or two texts and never reach the support. So classes are entities too, with counts pooled over
all documents: the kind, and an e-mail's domain, an address's network (three numbers), a card's first six and a
phone number's first five digits. A term that gives such a class away is generalised like any other.

Digests stand for terms and entities (64 bits) and for texts (128 bits). Texts are read three times. Up to
``SENT_TERMS`` disclosing terms, 8 bytes each, travel with the function that rewrites; more of them are joined to the
digests of the texts that hold them, as are terms that go only beside their entity. Both ways give the same spans.

Defined results: NULL and empty texts have no spans; spans of one kind don't overlap, spans of several kinds
may, and rewriting merges them under the first kind; equal texts get equal spans; rows are kept as they are.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_PATTERN, map_rows, small_batches, stored, whole_row

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 3
THRESHOLD = 0.8
#: Disclosing terms that are sent with the function; beyond it they are joined.
SENT_TERMS = 100_000
EMAIL, IP, CARD, PHONE = KINDS

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
# A match can only begin at the start of a run of digits; saying so keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(WORD_PATTERN)
_EDGES = ".,;:!?\"'()[]{}<>|"
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain, found from the @ outwards in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        at = text.find("@", max(done, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed; code points, end exclusive."""
    if not text:
        return []
    found = []
    if "@" in text:
        found += [(s, e, EMAIL) for s, e in _emails(text)]
    if _DIGIT.search(text):
        if text.count(".") >= 3:
            for m in _IP.finditer(text):
                if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
                    found.append((*m.span(), IP))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((*m.span(), CARD))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append((*m.span(), PHONE))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def span_text(spans: list) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _digest(value: str) -> int:
    """As Spark's ``xxhash64`` of a string, so both sides of a join may compute it."""
    h = xxhash.xxh64_intdigest(value.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def _term(token: str) -> str:
    return token.strip(_EDGES).translate(_LOWER)


def _entity(kind: str, value: str) -> str:
    return kind + ":" + (value.lower() if kind == EMAIL else value if kind == IP else re.sub("[^0-9]", "", value))


def _names(kind: str, value: str) -> list[str]:
    """What a mention stands for in the counts: its value, and its classes (its kind; e-mail domain, network, issuer or dialling prefix)."""
    own = _entity(kind, value)
    bare = own[len(kind) + 1 :]
    part = "@" + bare.rsplit("@", 1)[1] if kind == EMAIL else bare.rsplit(".", 1)[0] + "." if kind == IP else bare[: 6 if kind == CARD else 5]
    return [own, f"{kind}:*", f"{kind}:{part}*"]


def entity_digests(text: str, spans: list) -> set[int]:
    return {_digest(name) for s, e, kind in spans for name in _names(kind, text[s:e])}


def outside(text: str, spans: list) -> Iterator[tuple[int, int]]:
    """The words that touch no mention."""
    last, taken = 0, sorted((s, e) for s, e, _ in spans)
    for m in _WORD.finditer(text):
        while last < len(taken) and taken[last][1] <= m.start():
            last += 1
        if last == len(taken) or taken[last][0] >= m.end():
            yield m.span()


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """One stored row per document with entities: text_key, its entities and its terms outside all mentions, each once."""

    def rows(batch: dict) -> Iterator[tuple]:
        for h, t in zip(batch["h"], batch["t"]):
            if spans := base_spans(t):
                terms = {_term(t[s:e]) for s, e in outside(t, spans)} - {""}
                yield h, sorted(entity_digests(t, spans)), sorted(map(_digest, terms))

    narrow = docs.select(F.md5(text).alias("h"), F.col(text).alias("t"))
    return stored(map_rows(narrow, rows, "text_key string, entities array<long>, terms array<long>"))


def _term_digests(text: str) -> Column:
    """The digests of a text's words without their edges, as :func:`_digest` gives them."""
    plain = F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)
    return F.transform(F.regexp_extract_all(plain, F.lit(WORD_PATTERN), F.lit(0)), lambda w: F.xxhash64(F.btrim(w, F.lit(_EDGES))))


def term_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, n_term): documents with each term, folded on the map side."""
    words = _term_digests(text)
    return docs.select(F.explode(F.array_distinct(words)).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))


def disclosing_terms(docs: DataFrame, found: DataFrame, text: str = "text", support: int = SUPPORT, threshold: float = THRESHOLD) -> DataFrame:
    """(entity, term, disclosure) at the threshold or over it."""
    n_docs = docs.where(F.col(text).isNotNull()).count()
    texts = found.groupBy("text_key").agg(F.count("*").alias("copies"), F.first("entities").alias("entities"), F.first("terms").alias("terms"))
    held = texts.select("copies", "terms", F.explode("entities").alias("entity"))
    entities = held.groupBy("entity").agg(F.sum("copies").alias("n_entity"), F.count("*").alias("held_by")).where(F.col("held_by") >= support)
    entities = stored(entities.select("entity", "n_entity"))
    each = held.join(entities.select("entity"), "entity").select("entity", "copies", F.explode("terms").alias("term"))
    pairs = each.groupBy("entity", "term").agg(F.sum("copies").alias("both"), F.count("*").alias("texts")).where(F.col("texts") >= support)
    known = pairs.join(entities, "entity").join(term_counts(docs, text), "term")
    mutual = F.log(F.col("both") * float(n_docs) / (F.col("n_term") * F.col("n_entity")).cast("double"))
    scored = known.withColumn("disclosure", F.try_divide(mutual, F.log(float(n_docs) / F.col("n_entity").cast("double"))))
    return stored(scored.where(F.col("disclosure") >= threshold).select("entity", "term", "disclosure"))


def _few(terms: DataFrame, limit: int) -> frozenset[int] | None:
    """The terms, if there are at most ``limit`` of them: what the driver fetches is bounded by it."""
    held = terms.limit(limit + 1).toPandas()["term"].tolist()
    return frozenset(map(int, held)) if len(held) <= limit else None


def _marked(docs: DataFrame, text: str, everywhere: bool, limit: int, support: int, threshold: float) -> tuple[DataFrame, frozenset[int]]:
    """``docs`` as (row, t, terms), and the terms that hold for every row.

    Up to ``limit`` disclosing terms travel with the function. More of them, and terms that go only beside the
    entity they give away, are joined to the texts that hold them: (text's digest, its terms), one row a text.
    """
    found = scan(docs, text)
    disclosing = disclosing_terms(docs, found, text, support, threshold)
    row = docs.select(whole_row(docs).alias("row"), F.col(f"`{text}`").alias("t"))
    if everywhere:
        terms = disclosing.select("term").distinct()
        few = _few(terms, limit)
        if few is not None:
            return row.withColumn("terms", F.lit(None).cast("array<long>")), few
        held = docs.select(F.md5(text).alias("h"), F.explode(F.array_distinct(_term_digests(text))).alias("term")).distinct()
        pairs = held.join(terms, "term", "left_semi")
    else:
        held = found.dropDuplicates(["text_key"]).select(F.col("text_key").alias("h"), "entities", F.explode("terms").alias("term"))
        pairs = held.join(disclosing, "term").where(F.array_contains("entities", F.col("entity"))).select("h", "term").distinct()
    marks = pairs.groupBy("h").agg(F.collect_list("term").alias("terms"))
    return row.withColumn("h", F.md5("t")).join(marks, "h", "left").drop("h"), frozenset()


def _mark(text: str | None, spans: list, terms: frozenset[int] | set[int], seen: dict[str, int]) -> list[tuple[int, int]]:
    """[(start, end)] of the words of ``text`` whose digest is among ``terms``; ``seen`` keeps the digests of words met before."""
    if not text or not terms:
        return []
    out = []
    for s, e in outside(text, spans):
        raw = text[s:e]
        digest = seen.get(raw)
        if digest is None:
            if len(seen) > 200_000:
                seen.clear()
            term = _term(raw)
            digest = seen[raw] = _digest(term) if term else 0
        if digest in terms:
            left = len(raw) - len(raw.lstrip(_EDGES))
            out.append((s + left, s + left + len(raw.strip(_EDGES))))
    return out


def rewrite(text: str | None, terms: list | None) -> str | None:
    """The text with every span generalised; overlapping spans merge under the first one's kind."""
    if text is None:
        return None
    spans = base_spans(text) + [(s, e, "number" if text[s:e].isdigit() else "term") for s, e in terms or []]
    out, at = [], 0
    for s, e, kind in sorted(spans, key=lambda x: (x[0], -x[1])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def sanitise(
    docs: DataFrame, text: str = "text", everywhere: bool = False, limit: int = SENT_TERMS, support: int = SUPPORT, threshold: float = THRESHOLD
) -> DataFrame:
    """All rows and columns of ``docs``, entities and disclosing terms of ``text`` generalised."""
    rows, common = _marked(docs, text, everywhere, limit, support, threshold)
    small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def rewritten(texts: pd.Series, terms: pd.Series) -> pd.Series:
        seen: dict[str, int] = {}
        out = []
        for t, own in zip(texts.tolist(), terms.tolist()):
            out.append(rewrite(t, _mark(t, base_spans(t), common if own is None else set(own), seen)) if isinstance(t, str) else None)
        return pd.Series(out, dtype=object)

    changed = rewritten("t", "terms")
    return rows.select(*[(changed if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns])


def report(
    docs: DataFrame, key: str = "doc_id", text: str = "text", everywhere: bool = False, limit: int = SENT_TERMS, support: int = SUPPORT,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(key, the four counts, base, spans) of every row; spans as ``kind:start:end`` lists, ``term`` among them."""
    marked, common = _marked(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), "t", everywhere, limit, support, threshold)
    order = {k: i for i, k in enumerate((*KINDS, "term"))}

    def rows(batch: dict) -> Iterator[tuple]:
        seen: dict[str, int] = {}
        for k, t, own in zip(batch["k"], batch["t"], batch["terms"]):
            base = base_spans(t)
            terms = common if own is None else set(own)
            every = sorted([*base, *((s, e, "term") for s, e in _mark(t, base, terms, seen))], key=lambda x: (x[0], order[x[2]], x[1]))
            listed = [",".join(f"{kind}:{s}:{e}" for s, e, kind in spans) for spans in (base, every)]
            yield (k, *[sum(kind == x for _, _, kind in base) for x in KINDS], *listed)

    kind = docs.schema[key].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return map_rows(marked.select(F.col("row.k").alias("k"), "t", "terms"), rows, f"{key} {kind}, {counts}, base string, spans string")
