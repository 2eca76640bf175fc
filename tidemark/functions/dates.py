"""Mixed-format dates. Results are zone-free timestamps, so no session time zone can shift them.

A cell is read by its shape. The shape of the common forms, digits only, is one character translation, looked up in a
set. Every other cell goes through a small grammar: a clock at its end is taken off, a weekday at its front and ordinal
endings go, the month's name becomes ``B``, runs of one or two digits ``d`` and of four ``y``; the shape that is left is
looked up in a table that names each run's part (``LAYOUTS``), and the date is assembled from the runs. Both ways end
in one checked constructor, so an impossible date is NULL, whatever its form.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import vocab
from tidemark.functions.text import as_column, sql_text, stripped

# Names of months and weekdays, and the shapes of dates with the parts that their digit runs stand for.
_MONTHS = "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
_MONTH_ORDER = "janfebmaraprmayjunjulaugsepoctnovdec"
_WEEKDAYS = "mon(?:day)?|tue(?:s|sday)?|wed(?:nesday)?|thu(?:rs?|rsday)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?"
#: Y year, M month, D day, T year of two digits; A and B: month and day, or day and month where only that is possible.
LAYOUTS = {
    "y d d": "YMD",
    "d d y": "ABY",
    "d d d": "ABT",
    "y d": "YM",
    "d y": "MY",
    "d B y": "DY",
    "B d y": "DY",
    "y B d": "YD",
    "B y": "Y",
    "y B": "Y",
    "d B d": "DT",
    "B d d": "DT",
}
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*(?:([ap])\.?m\.?)?\s*(z|utc|gmt|[+-]\d{2}:?\d{2})?(?:\s*\([a-z]+\))?$"
_BEFORE_CLOCK = r"^(.*?)(?:[t,]|\s)\s*" + _CLOCK
#: "Tue Mar 5 14:05:06 UTC 2024": the year goes before the clock.
_YEAR_LAST = r"\s(\d{1,2}:\d{2}(?::\d{2})?(?:\s(?:utc|gmt))?)\s(\d{4})$"
_WEEK = r"^(\d{4})-?w(\d{2})(?:-?([1-7]))?$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})(?:t?(\d{2})(\d{2})(\d{2}))?$"
_SEPARATORS = r"[\s,./'’-]+"
#: Two-digit years from here on are of the last century.
PIVOT = 69

_YEAR_FIRST = [f"9999{a}{m}{b}{d}" for a, b, m, d in product("-/.", "-/.", ("9", "99"), ("9", "99"))]
_SLASHED = [f"{m}/{d}/9999" for m, d in product(("9", "99"), ("9", "99"))]
_ISO_CLOCK = [f"9999-99-99{t}99:99{s}" for t, s in product(" T", ("", ":99"))]
#: Parts that one match hands on together; no cell holds this character and a clock.
_CUT = "\x01"


def _let(name: str, value: str, body: str) -> str:
    """``body`` over a value that is computed once. The grammar is SQL text, as that is planned in one call."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _groups(text: str, form: str, n: int) -> str:
    """The groups of a match as an array, by one match; NULL if there is none."""
    cut = f"split(regexp_replace({text}, {sql_text(form)}, {sql_text(_CUT.join(f'${i}' for i in range(1, n + 1)))}), {sql_text(_CUT)})"
    return _let("g", cut, f"CASE WHEN size(g) = {n} THEN g END")


def _assembled(year: str, month: str, day: str, hour: str = "0", minute: str = "0", second: str = "0") -> str:
    """The one constructor. Sixty seconds would be carried into the next minute, so they are none."""
    return f"try_make_timestamp_ntz({year}, {month}, {day}, {hour}, {minute}, CASE WHEN {second} < 60 THEN CAST({second} AS DECIMAL(16, 6)) END)"


def _shape(date: str) -> str:
    """The date's digit runs and month as ``y``, ``d`` and ``B`` with blanks between; whatever else it holds stays."""
    steps = [
        (rf"^(?:{_WEEKDAYS})\.?(?:\s*,\s*|\s+)", ""),
        (r"(?<=\d)(?:st|nd|rd|th)(?![a-z])(?: of(?= ))?", ""),
        (rf"(?<![a-z])(?:{_MONTHS})(?![a-z])", "B"),
    ]
    named = date
    for form, to in steps:
        named = f"regexp_replace({named}, {sql_text(form)}, {sql_text(to)})"
    # Only a cell with letters can hold names.
    named = f"CASE WHEN {date} RLIKE '[a-z]' THEN {named} ELSE {date} END"
    for form, to in [(r"(?<!\d)\d{4}(?!\d)", "y"), (r"(?<!\d)\d{1,2}(?!\d)", "d")]:
        named = f"regexp_replace({named}, {sql_text(form)}, {sql_text(to)})"
    # A name may stand next to any separators; numbers alone take one sort of them, or blanks.
    loose = f"regexp_replace(r, {sql_text(_SEPARATORS)}, ' ')"
    strict = f"regexp_replace(r, {sql_text(r'^([yd])([-/.]|\s+)([yd])(?:\2([yd]))?$')}, '$1 $3 $4')"
    return f"trim({_let('r', named, f'CASE WHEN instr(r, {sql_text("B")}) > 0 THEN {loose} ELSE {strict} END')})"


def _date_fields(date: str) -> str:
    """struct(y, m, d) of a lower-cased date without a clock; NULL if its shape isn't in the table."""
    table = "map(" + ", ".join(f"'{k}', '{v}'" for k, v in LAYOUTS.items()) + ")"
    run = lambda letter: f"TRY_CAST(try_element_at(runs, nullif(instr(layout, '{letter}'), 0)) AS INT)"
    name = f"regexp_extract({date}, {sql_text(rf'(?:^|[^a-z])({_MONTHS})(?![a-z])')}, 1)"
    number = f"CASE WHEN instr(layout, 'M') + instr(layout, 'A') = 0 THEN CAST((instr('{_MONTH_ORDER}', nullif(substr({name}, 1, 3), '')) + 2) / 3 AS INT) END"
    month = f"coalesce({number}, {run('M')}, CASE WHEN {run('A')} > 12 THEN {run('B')} ELSE {run('A')} END)"
    day = f"CASE WHEN instr(layout, 'A') > 0 THEN CASE WHEN {run('A')} > 12 THEN {run('A')} ELSE {run('B')} END WHEN instr(layout, 'D') > 0 THEN {run('D')} ELSE 1 END"
    year = f"coalesce({run('Y')}, {run('T')} + CASE WHEN {run('T')} < {PIVOT} THEN 2000 ELSE 1900 END)"
    fields = f"CASE WHEN layout IS NOT NULL THEN struct({year} AS y, {month} AS m, {day} AS d) END"
    runs = f"regexp_extract_all({date}, {sql_text(r'(\d+)')}, 1)"
    return _let("layout", f"try_element_at({table}, {_shape(date)})", _let("runs", f"CASE WHEN layout IS NOT NULL THEN {runs} END", fields))


def _week_date(low: str) -> str:
    """A day of an ISO week: week 1 holds January 4th, and not every year has a week 53."""
    field = lambda i: f"TRY_CAST(w[{i}] AS INT)"
    monday = f"date_add(fourth, ({field(1)} - 1) * 7 - weekday(fourth))"
    real = f"{field(1)} >= 1 AND weekofyear(monday) = {field(1)}"
    found = f"CASE WHEN {real} THEN CAST(date_add(monday, coalesce({field(2)}, 1) - 1) AS TIMESTAMP_NTZ) END"
    return _let("w", _groups(low, _WEEK, 3), _let("fourth", f"CAST({_assembled(field(0), '1', '4')} AS DATE)", _let("monday", monday, found)))


def _compact(low: str) -> str:
    field = lambda i: f"coalesce(TRY_CAST(c[{i}] AS INT), 0)"
    return _let("c", _groups(low, _COMPACT, 6), _assembled(*map(field, range(6))))


def _clocked(low: str) -> str:
    """A date and a time of day; an offset is taken off, so the result is in UTC. Digits beyond microseconds are cut."""
    hour = "TRY_CAST(c[1] AS INT)"
    twelve = f"CASE WHEN {hour} BETWEEN 1 AND 12 THEN {hour} % 12 + CASE WHEN c[5] = 'p' THEN 12 ELSE 0 END END"
    second = "CAST(concat(CASE WHEN c[3] = '' THEN '0' ELSE c[3] END, '.', rpad(substr(c[4], 1, 6), 6, '0')) AS DECIMAL(16, 6))"
    zone = "regexp_replace(c[6], '[^0-9]', '')"
    minutes = f"coalesce(TRY_CAST(substr({zone}, 1, 2) AS INT) * 60 + TRY_CAST(substr({zone}, 3, 2) AS INT), 0)"
    local = _assembled("f.y", "f.m", "f.d", f"CASE WHEN c[5] = '' THEN {hour} ELSE {twelve} END", "TRY_CAST(c[2] AS INT)", second)
    utc = f"timestampadd(MINUTE, CASE WHEN c[6] LIKE '-%' THEN {minutes} ELSE -{minutes} END, {local})"
    turned = f"regexp_replace({low}, {sql_text(_YEAR_LAST)}, ' $2 $1')"
    return _let("c", _groups(turned, _BEFORE_CLOCK, 7), _let("f", f"CASE WHEN c IS NOT NULL THEN {_date_fields('c[0]')} END", utc))


def _grammar(low: str) -> str:
    plain = _let("f", _date_fields(low), _assembled("f.y", "f.m", "f.d"))
    return f"""CASE WHEN instr({low}, ':') > 0 THEN {_clocked(low)}
      WHEN {low} RLIKE {sql_text(_COMPACT)} THEN {_compact(low)} WHEN {low} RLIKE {sql_text(_WEEK)} THEN {_week_date(low)} ELSE {plain} END"""


def _cell() -> str:
    among = lambda values: ", ".join(map(sql_text, values))
    part = lambda i: f"TRY_CAST(p[{i}] AS INT)"
    year_first = _let("p", "split(translate(t, '/.', '--'), '-')", _assembled(*map(part, range(3))))
    month = f"CASE WHEN {part(0)} > 12 THEN {part(1)} ELSE {part(0)} END"
    day = f"CASE WHEN {part(0)} > 12 THEN {part(0)} ELSE {part(1)} END"
    slashed = _let("p", "split(t, '/')", _assembled(part(2), month, day))
    by_shape = f"""CASE WHEN s IN ({among(_YEAR_FIRST)}) THEN {year_first} WHEN s IN ({among(_SLASHED)}) THEN {slashed}
      WHEN s IN ({among(_ISO_CLOCK)}) THEN TRY_CAST(t AS TIMESTAMP_NTZ)
      WHEN lower(t) IN ({among(vocab.MISSING_DATE_TOKENS)}) THEN CAST(NULL AS TIMESTAMP_NTZ) ELSE {_let("low", "lower(t)", _grammar("low"))} END"""
    return _let("s", "translate(t, '012345678', '999999999')", by_shape)


_CELL = _cell()


def parse_date(value: Column | str) -> Column:
    """Parse one date cell; anything impossible or of no known shape gives NULL.

    Numbers read month first unless only day first is possible; a month without a day is its first day; years of two
    digits are 1969 to 2068. Times with an offset or ``Z`` become UTC, times without one are taken as they stand; a
    weekday's name is not checked against the date. Shapes outside the table are deliberately not guessed at: they come
    back NULL and the rules engine reports them.
    """
    return F.call_function("transform", F.array(stripped(value)), F.expr(f"t -> {_CELL}"))[0]


def duration_days(start: Column | str, end: Column | str) -> Column:
    """Days from start to end, half-even rounded to two decimals; NULL if either is missing."""
    micros = F.timestamp_diff("MICROSECOND", as_column(start), as_column(end))
    return F.bround(micros / F.lit(86_400_000_000.0), 2)


def iso_date(value: Column | str) -> Column:
    return F.date_format(as_column(value), "yyyy-MM-dd")


def month_key(value: Column | str) -> Column:
    return F.date_format(as_column(value), "yyyy-MM")


def ordinal_day(value: Column | str) -> Column:
    """Day number with 0001-01-01 as day 1."""
    return F.datediff(as_column(value).cast("date"), F.lit("0001-01-01").cast("date")) + F.lit(1)
