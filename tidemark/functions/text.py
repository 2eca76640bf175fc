"""Text normal forms. All are JVM expressions, all treat NULL as the empty string.

Whitespace means Unicode whitespace: Java's ``\\s`` and Spark's ``trim`` alone would leave
no-break spaces in place, so the class and the trim set are spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python and Unicode call whitespace.
_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def sql_text(value: str) -> str:
    """A string literal for use inside a SQL expression."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def filled(value: Column | str) -> Column:
    """The value as a string, NULL as ``""``."""
    return F.coalesce(as_column(value).cast("string"), F.lit(""))


def stripped(value: Column | str) -> Column:
    """Outer whitespace removed (a trim over a fixed character set, no regex)."""
    return F.btrim(filled(value), F.lit(_BLANKS))


def collapsed(value: Column | str) -> Column:
    """Outer whitespace removed and every inner run turned into one space; case kept."""
    return F.trim(F.regexp_replace(filled(value), _SPACE_RUN, " "))


def name_key(value: Column | str) -> Column:
    """Lower-cased :func:`collapsed`: the comparison form of names."""
    return F.lower(collapsed(value))


def token(value: Column | str) -> Column:
    """Alias look-up form: lower case, runs of ``- _ / .`` and whitespace become one space."""
    return F.trim(F.regexp_replace(F.lower(filled(value)), r"(?U)[\s\x1c-\x1f\-_/.]+", " "))


def category_key(value: Column | str, joiner: str = " ") -> Column:
    """Comparison form of categories; ``joiner=""`` gives the despaced form."""
    return F.trim(F.regexp_replace(F.lower(stripped(value)), r"(?U)[\s\x1c-\x1f_-]+", joiner))


def is_token(value: Column | str, tokens: list[str]) -> Column:
    """Whether the stripped, lower-cased value is one of ``tokens``."""
    return F.lower(stripped(value)).isin(*tokens)


def present(items: list[tuple[Column, Column]], kind: str) -> Column:
    """Array of the values whose condition holds, in order; ``kind`` is the SQL type of a value.

    Every value is computed only where its condition holds, in generated code. ``array_compact`` would build
    all of them in interpreted expressions, however few a row needs.
    """
    none = F.expr(f"CAST(array() AS array<{kind}>)")
    return F.concat(none, *[F.when(applies, F.array(value)).otherwise(none) for applies, value in items])


def row_digest(columns: list[Column | str]) -> Column:
    """SHA-256 over length-prefixed values: one 64-character key that stands for the whole tuple.

    Grouping and joining on the digest keeps long texts out of the shuffle. The length prefix keeps
    ``("ab", "c")`` and ``("a", "bc")`` apart, and NULL apart from ``""``.
    """
    parts = []
    for column in columns:
        text = as_column(column).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat_ws("|", *parts), 256)


def row_key(columns: list[Column | str]) -> Column:
    """The first 16 bytes of :func:`row_digest`, for keys that only group and join: a quarter of what a shuffle writes for its text."""
    return F.substring(F.unhex(row_digest(columns)), 1, 16)
