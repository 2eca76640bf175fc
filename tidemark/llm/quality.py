"""Quality rules as a short-circuit cascade.

Every rule reads a few text measures; a measure is computed once, when the first rule asks for it. On a
bounded sample each measure's seconds and each rule's verdicts are taken, and the rules are put in the
order of rejections per second among the documents that are still standing, the cost being only that of
measures which earlier rules have not already paid for. A document leaves at its first rejecting rule.

The verdict is the conjunction of all rules, so it doesn't depend on the order or on the timings: reruns,
recomputed tasks and clusters of other speed agree. The sample decides only how much work is saved.

Defined results: a NULL or empty text has no words and is rejected (``too_few_words``); rows of any other
column, NULL or clashing in name, are carried as they are; an empty table gives an empty table.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tidemark.llm.common import BATCH_ROWS, map_rows, small_batches

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Documents whose rule costs and verdicts set the order of the rules. The bound is a parameter.
SAMPLE_ROWS = 2000


class Measured:
    """A text and the measures taken of it so far."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self._done: dict[str, object] = {}

    def __getattr__(self, name: str):
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._done:
            self._done[name] = MEASURES[name](self)
        return self._done[name]


def _repeat_words(doc: Measured) -> int:
    """Words inside three-word windows that stand in the text at least twice."""
    w = doc.words
    windows = list(zip(w, w[1:], w[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = {x for x, n in Counter(windows).items() if n > 1}
    covered, reach = 0, 0
    for i, x in enumerate(windows):
        if x in often:
            covered += i + 3 - max(reach, i)
            reach = i + 3
    return covered


def _dup_lines(doc: Measured) -> int:
    lines = [x for x in doc.text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


MEASURES: dict[str, Callable[[Measured], object]] = {
    "words": lambda d: d.text.encode().split(),
    "n_words": lambda d: len(d.words),
    "word_chars": lambda d: len(d.text) - sum(map(d.text.count, SPACES)),
    "n_symbols": lambda d: sum(map(d.text.count, SYMBOLS)),
    "n_dup_lines": _dup_lines,
    "n_lines": lambda d: d.text.count("\n") + 1,
    "n_repeat_words": _repeat_words,
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Measured], bool]


def default_rules() -> list[Rule]:
    return [
        Rule("too_few_words", ("words", "n_words"), lambda d: d.n_words < 50),
        Rule("repeated_words", ("words", "n_words", "n_repeat_words"), lambda d: 100 * d.n_repeat_words > 50 * d.n_words),
        Rule("symbol_heavy", ("words", "n_words", "n_symbols"), lambda d: 10 * d.n_symbols > 3 * d.n_words),
        Rule("word_length", ("words", "n_words", "word_chars"), lambda d: d.word_chars < 2 * d.n_words or d.word_chars > 30 * d.n_words),
        Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda d: 2 * d.n_dup_lines > d.n_lines),
    ]


def profile_rules(docs: DataFrame, rules: list[Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Per sampled document: the seconds of each measure and which rules reject it (about ``sample_rows``).

    Rows are drawn at random in the scan, so no text is moved; the driver gets timings and rule names alone.
    """

    def take(batch: dict) -> Iterator[tuple]:
        for value in batch["text"]:
            doc, cost = Measured(value), {}
            for need in dict.fromkeys(n for r in rules for n in r.needs):
                began = time.perf_counter()
                getattr(doc, need)
                cost[need] = time.perf_counter() - began
            yield [r.name for r in rules if r.rejects(doc)], cost

    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs.select(F.col(text).alias("text")).sample(share, seed=7)
    return [r.asDict() for r in map_rows(sample, take, "rejected array<string>, cost map<string,double>").collect()]


def order_rules(rules: list[Rule], seen: list[dict]) -> list[Rule]:
    """Greedy order: most rejections per second among those standing, paid measures being free."""
    standing, left, paid, out = list(seen), list(rules), set(), []
    while left:
        def gain(rule: Rule) -> float:
            hits = sum(rule.name in s["rejected"] for s in standing)
            cost = sum(s["cost"].get(n, 0.0) for s in standing for n in rule.needs if n not in paid)
            return hits / (cost + 1e-9)

        best = max(left, key=gain)
        left.remove(best)
        out.append(best)
        paid |= set(best.needs)
        standing = [s for s in standing if best.name not in s["rejected"]]
    return out


def cascade_order(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    rules = rules or default_rules()
    return order_rules(rules, profile_rules(docs, rules, text, sample_rows))


def _first_rejection(rules: list[Rule], doc: Measured) -> str | None:
    return next((r.name for r in rules if r.rejects(doc)), None)


def keep_documents(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns as they were."""
    ordered = cascade_order(docs, rules, text, sample_rows)
    at = docs.columns.index(text)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                mask = [_first_rejection(ordered, Measured(t)) is None for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def judge_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """(key, the five counts, kept, rejected_by): the cascade's verdict with every count completed for the report.

    ``rejected_by`` is the first rejecting rule in the sampled order, so it may differ between runs; ``kept`` may not.
    """
    ordered = cascade_order(docs, rules, text, sample_rows)
    schema = StructType([StructField(key, docs.schema[key].dataType), *[StructField(c, LongType()) for c in COUNTS]])
    schema = schema.add("kept", BooleanType()).add("rejected_by", "string")

    def judge(batch: dict) -> Iterator[tuple]:
        for k, value in zip(batch["k"], batch["t"]):
            doc = Measured(value)
            why = _first_rejection(ordered, doc)
            yield (k, *[getattr(doc, c) for c in COUNTS], why is None, why)

    return map_rows(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), judge, schema)
