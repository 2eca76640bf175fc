"""Numbers and booleans out of free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import vocab
from tidemark.functions.text import stripped

# Java's parser alone would also accept type suffixes such as "5d".
_NUMBER = r"^(?i)[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)$"


def to_number(value: Column | str) -> Column:
    """Double, or NULL when the text is not a number. ``nan`` is NULL too: it is no usable value."""
    text = stripped(value)
    number = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return F.when(F.isnan(number), F.lit(None).cast("double")).otherwise(number)


def is_number(value: Column | str) -> Column:
    """Whether the text reads as a number (``nan`` included)."""
    return stripped(value).rlike(_NUMBER)


def to_flag(value: Column | str, hint: Column | None = None) -> Column:
    """Standard boolean; an unknown token is true only if ``hint`` (a companion column) is filled."""
    text = F.lower(stripped(value))
    rest = F.lit(False) if hint is None else ~F.lower(stripped(hint)).isin(*vocab.MISSING_TRIAGE_TOKENS)
    return F.when(text.isin(*vocab.TRUE_TOKENS), F.lit(True)).when(text.isin(*vocab.FALSE_TOKENS), F.lit(False)).otherwise(rest)
