"""The registered queries once more, as plain SQL over the same tables.

Written from the definitions, not from the DataFrame code: shared pieces are common table expressions
that build the case view, parse dates and clean rows in SQL's own terms.
"""

from __future__ import annotations

from tidemark import vocab

ORACLES: dict[str, str] = {}

_REF = f"TIMESTAMP '{vocab.REFERENCE_DATE} 00:00:00'"
_WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _list(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _map(key: str, aliases: dict[str, str]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in aliases.items()) + " END"


def strip(c: str) -> str:
    return f"regexp_replace(coalesce({c}, ''), '^{_WS}+|{_WS}+$', '', 'g')"


def collapse(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{_WS}+', ' ', 'g'))"


def tok(c: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({c}, '')), '({_WS}|[-_/.])+', ' ', 'g'))"


def catkey(c: str, joiner: str = " ") -> str:
    return f"trim(regexp_replace(lower({strip(c)}), '({_WS}|[-_])+', '{joiner}', 'g'))"


def parse(c: str) -> str:
    s = f"trim({c})"
    return f"""CASE WHEN lower({s}) IN ({_list(vocab.MISSING_DATE_TOKENS)}) THEN NULL
      WHEN regexp_full_match({s}, '\\d{{4}}[-/.]\\d{{1,2}}[-/.]\\d{{1,2}}') THEN try_strptime(replace(replace({s}, '/', '-'), '.', '-'), '%Y-%m-%d')
      WHEN regexp_full_match({s}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') THEN
        CASE WHEN CAST(split_part({s}, '/', 1) AS INT) > 12 THEN try_strptime({s}, '%d/%m/%Y') ELSE try_strptime({s}, '%m/%d/%Y') END
      ELSE try_strptime({s}, '%Y-%m-%d %H:%M:%S') END"""


def days(a: str, b: str) -> str:
    return f"round_even((epoch({b}) - epoch({a})) / 86400.0, 2)"


def number(c: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({c}), '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') THEN TRY_CAST(trim({c}) AS DOUBLE) END"


CASES = """
lines AS (SELECT l_orderkey, max(l_shipdate) AS last_ship, count(*) AS n_lines FROM lineitem GROUP BY 1),
spine AS (
  SELECT o_orderkey AS k, o_orderstatus AS st, o_orderpriority AS prio, CAST(o_orderdate AS DATE) AS day,
         CAST(last_ship AS DATE) AS last_ship, n_lines, c_name AS name, c_mktsegment AS seg, c_nationkey AS nation, copy
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN lines ON o_orderkey = l_orderkey,
       unnest(CASE WHEN o_orderkey % 50 = 0 THEN [0, 1] ELSE [0] END) AS u(copy)),
cases AS (
  SELECT k * 2 + copy AS row_index,
    CASE WHEN k % 101 = 0 THEN '' WHEN k % 97 = 0 THEN 'C-' || (k - k % 970) WHEN copy = 1 THEN k || '-R' ELSE CAST(k AS VARCHAR) END AS case_id,
    CASE WHEN copy = 1 THEN name || '  ' WHEN k % 7 = 0 THEN upper(name) WHEN k % 11 = 0 THEN '  ' || name || ' '
         WHEN k % 13 = 0 THEN replace(name, '#', '  #') ELSE name END AS client_name,
    CASE WHEN k % 17 = 0 THEN '' WHEN k % 23 = 0 THEN 'novel_cat_' || (k % 5)
      WHEN seg = 'AUTOMOBILE' THEN CASE k % 4 WHEN 0 THEN 'TECH SUPPORT' WHEN 1 THEN 'tech_support' ELSE 'Technical Support' END
      WHEN seg = 'BUILDING' THEN CASE k % 4 WHEN 0 THEN 'billng' WHEN 1 THEN 'BILLING-DEPT' ELSE 'Billing' END
      WHEN seg = 'FURNITURE' THEN CASE k % 4 WHEN 0 THEN 'hardware_maint' WHEN 1 THEN 'Hardware ' ELSE 'Hardware' END
      WHEN seg = 'HOUSEHOLD' THEN CASE k % 4 WHEN 0 THEN 'gen.inquiry' WHEN 1 THEN 'GENERAL  INQUIRY' ELSE 'General Inquiry' END
      ELSE CASE k % 4 WHEN 0 THEN 'sec alert' WHEN 1 THEN 'security-alert' ELSE 'Security Alert' END END AS category,
    CASE WHEN k % 43 = 0 THEN 'TBD'
      WHEN prio = '1-URGENT' THEN CASE k % 3 WHEN 0 THEN 'URGENT_OVERRIDE' WHEN 1 THEN 'p1' ELSE 'Critical' END
      WHEN prio = '2-HIGH' THEN CASE k % 3 WHEN 0 THEN 'HIGH' ELSE 'High' END
      WHEN prio = '3-MEDIUM' THEN CASE k % 3 WHEN 0 THEN 'med' ELSE 'Medium' END
      WHEN prio = '5-LOW' THEN CASE k % 3 WHEN 0 THEN ' low ' ELSE 'Low' END ELSE 'Medium' END AS priority,
    CASE WHEN k % 199 = 0 THEN '2099-01-01' WHEN k % 223 = 0 THEN '' WHEN k % 227 = 0 THEN 'not-a-date'
      WHEN k % 10 = 0 THEN strftime(day, '%m/%d/%Y') WHEN k % 10 = 1 THEN strftime(day, '%Y.%m.%d')
      WHEN k % 10 = 2 AND day(day) > 12 THEN strftime(day, '%d/%m/%Y')
      WHEN k % 10 = 3 THEN strftime(day, '%Y-%m-%d') || ' 08:30:00' ELSE strftime(day, '%Y-%m-%d') END AS intake_date,
    CASE WHEN k % 211 = 0 THEN '2024-13-45' WHEN last_ship IS NULL THEN ''
      WHEN k % 4 = 1 THEN strftime(last_ship, '%m/%d/%Y') ELSE strftime(last_ship, '%Y-%m-%d') END AS closure_date,
    CASE WHEN k % 5 < 2 THEN '' WHEN k % 241 = 0 THEN 'bad' ELSE strftime(day + CAST(k % 9 - 1 AS INT), '%Y-%m-%d') END AS triage_date,
    (['Yes', 'No', 'Y', '1', '0', 'TRUE', '', 'maybe'])[k % 8 + 1] AS triaged,
    CASE WHEN k % 53 = 0 THEN '-5' WHEN k % 59 = 0 THEN '999999' WHEN k % 61 = 0 THEN 'abc' WHEN k % 67 = 0 THEN ''
      WHEN k % 71 = 0 THEN '150' WHEN k % 37 = 0 THEN ' 3.0 ' ELSE CAST(coalesce(n_lines, 0) AS VARCHAR) END AS contact_count,
    'Agent_' || nation AS assigned_agent,
    CASE WHEN k % 83 = 0 THEN 'UNKNOWN_STATUS' WHEN st = 'F' THEN CASE k % 3 WHEN 0 THEN 'RESOLVED' ELSE 'Closed' END
      WHEN st = 'P' THEN 'closed' ELSE CASE k % 3 WHEN 0 THEN 'in_progress' WHEN 1 THEN 'on hold' ELSE 'Open' END END AS status,
    'Order ' || k || ' for ' || lower(seg) AS resolution_notes
  FROM spine)
"""
COLUMNS = [
    "case_id", "client_name", "category", "priority", "intake_date", "closure_date", "triage_date", "triaged",
    "contact_count", "assigned_agent", "status", "resolution_notes",
]

PARSED = f"""
parsed AS (
  SELECT *, {parse('intake_date')} AS ia, {parse('closure_date')} AS ca, {parse('triage_date')} AS ta FROM cases),
timed AS (SELECT *, {days('ia', 'ca')} AS dur FROM parsed),
flagged AS (
  SELECT *, list_filter([
    CASE WHEN trim(intake_date) <> '' AND ia IS NULL THEN 'INVALID_INTAKE_FORMAT' WHEN trim(intake_date) = '' THEN 'MISSING_INTAKE_DATE'
         WHEN ia > {_REF} THEN 'FUTURE_INTAKE_DATE' END,
    CASE WHEN trim(closure_date) <> '' AND ca IS NULL THEN 'INVALID_CLOSURE_FORMAT' END,
    CASE WHEN dur < 0 THEN 'NEGATIVE_DURATION' END,
    CASE WHEN trim(triage_date) <> '' AND ta IS NULL THEN 'INVALID_TRIAGE_FORMAT' END,
    CASE WHEN ta < ia THEN 'TRIAGE_BEFORE_INTAKE' END,
    CASE WHEN ia IS NOT NULL AND ta > ca THEN 'TRIAGE_AFTER_CLOSURE' END], lambda x: x IS NOT NULL) AS flags
  FROM timed)
"""


def _category(c: str) -> str:
    return f"""CASE WHEN {strip(c)} = '' THEN 'Uncategorized' WHEN {strip(c)} IN ({_list(vocab.CANONICAL_CATEGORIES)}) THEN {strip(c)}
      ELSE coalesce({_map(tok(c), vocab.CATEGORY_ALIASES)}, {strip(c)}) END"""


_FLAG = f"""CASE WHEN lower(trim(triaged)) IN ({_list(vocab.TRUE_TOKENS)}) THEN true WHEN lower(trim(triaged)) IN ({_list(vocab.FALSE_TOKENS)}) THEN false
  ELSE lower(trim(triage_date)) NOT IN ({_list(vocab.MISSING_TRIAGE_TOKENS)}) END"""

CLEAN = f"""
middle AS (SELECT coalesce(CAST(trunc(median(v)) AS INT), 3) AS m FROM (SELECT {number('contact_count')} AS v FROM cases) WHERE v BETWEEN 0 AND 100),
graded AS (
  SELECT *, list_filter(flags, lambda x: x IN ({_list(vocab.CRITICAL_DATE_FLAGS)})) AS crit,
    lower({collapse('case_id')}) IN ({_list(vocab.MISSING_ID_TOKENS)}) AS keyless FROM flagged),
std AS (
  SELECT row_index, {collapse('case_id')} AS case_id, {collapse('client_name')} AS client_name, {_category('category')} AS category,
    coalesce({_map(tok('priority'), vocab.PRIORITY_ALIASES)}, {collapse('priority')}) AS priority,
    CASE WHEN NOT held THEN strftime(ia, '%Y-%m-%d') END AS intake_date, CASE WHEN NOT held THEN strftime(ca, '%Y-%m-%d') END AS closure_date,
    CASE WHEN NOT held THEN strftime(ta, '%Y-%m-%d') END AS triage_date, {_FLAG} AS triaged,
    CASE WHEN {number('contact_count')} BETWEEN 0 AND 100 THEN CAST(trunc({number('contact_count')}) AS INT) ELSE (SELECT m FROM middle) END AS contact_count,
    {collapse('assigned_agent')} AS assigned_agent,
    coalesce({_map(tok('status'), vocab.STATUS_ALIASES)}, {collapse('status')}) AS status,
    {collapse('resolution_notes')} AS resolution_notes, CASE WHEN NOT held THEN dur END AS duration_days,
    CASE WHEN keyless THEN 'Missing required primary key `case_id`' WHEN len(crit) > 0 THEN 'Critical date defect: ' || array_to_string(crit, ', ') ELSE '' END AS quarantine_reason
  FROM (SELECT *, keyless OR len(crit) > 0 AS held FROM graded)),
ranked AS (
  SELECT *, CASE WHEN quarantine_reason = '' THEN min(row_index) OVER
    (PARTITION BY quarantine_reason = '', lower(client_name), lower(category), intake_date, closure_date) END AS first_row FROM std),
clean AS (SELECT * EXCLUDE (quarantine_reason, first_row) FROM ranked WHERE quarantine_reason = '' AND first_row = row_index),
closed AS (
  SELECT *, substr(intake_date, 1, 7) AS intake_month, datediff('day', DATE '0001-01-01', CAST(intake_date AS DATE)) + 1 AS ordinal
  FROM clean WHERE lower(status) = 'closed' AND duration_days >= 0)
"""

BASE = f"WITH {CASES}"
DATED = f"{BASE}, {PARSED}"
FULL = f"{DATED}, {CLEAN}"


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


# --- text, dates, coercion -------------------------------------------------------------------
oracle("text_forms", f"""{BASE} SELECT row_index, {strip('client_name')} AS stripped, {collapse('client_name')} AS collapsed,
  lower({collapse('client_name')}) AS name_key, {tok('category')} AS category_token, {catkey('category')} AS category_key,
  {catkey('category', '')} AS category_despaced FROM cases""")
oracle("document_name_keys", f"""SELECT doc_id, md5({collapse('text')}) AS collapsed_md5, CAST(length({strip('text')}) AS INT) AS stripped_length FROM documents""")
oracle("parsed_dates", f"""{DATED} SELECT row_index, strftime(ia, '%Y-%m-%d %H:%M:%S') AS intake_at, strftime(ca, '%Y-%m-%d %H:%M:%S') AS closure_at,
  strftime(ta, '%Y-%m-%d %H:%M:%S') AS triage_at, dur AS duration_days, strftime(ia, '%Y-%m') AS intake_month,
  CAST(coalesce(datediff('day', DATE '0001-01-01', CAST(ia AS DATE)) + 1, 0) AS BIGINT) AS intake_ordinal FROM timed""")
# The days are known here, so nothing is parsed: what each way of writing keeps of a day is stated.
oracle("parsed_date_shapes", """
WITH o AS (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS d, o_orderkey % 20 AS way FROM orders),
r AS (SELECT o_orderkey, CASE
    WHEN way IN (0, 2, 3, 6, 7, 8, 12, 13, 14) THEN d
    WHEN way = 1 THEN d + INTERVAL '12 hours 5 minutes 6 seconds'
    WHEN way IN (4, 5) THEN date_trunc('month', d)
    WHEN way = 9 THEN date_trunc('week', d)
    WHEN way = 10 THEN d
    WHEN way = 11 THEN d + INTERVAL '14 hours 5 minutes 6.25 seconds'
    WHEN way = 15 THEN d + INTERVAL '14 hours 5 minutes 6 seconds' END AS moment FROM o)
SELECT o_orderkey, strftime(CAST(moment AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%g') AS read_at FROM r""")
oracle("coerced_cells", f"""{BASE} SELECT row_index, {number('contact_count')} AS contacts, {_FLAG} AS triaged FROM cases""")

# --- normalization ---------------------------------------------------------------------------
oracle("normalized_categories", f"""{BASE} SELECT row_index, {_category('category')} AS category,
  coalesce({_map(tok('priority'), vocab.PRIORITY_ALIASES)}, priority) AS priority,
  coalesce({_map(tok('status'), vocab.STATUS_ALIASES)}, status) AS status FROM cases""")


def _enum_records(column: str, aliases: dict[str, str]) -> str:
    m = _map(tok(column), aliases)
    return f"""SELECT row_index, '{column}' AS column_name, {column} AS raw_value, {tok(column)} AS cleaned_token,
      coalesce({m}, {column}) AS normalized_value, {m} IS NOT NULL AS is_canonical, {m} IS NULL AS is_unresolved,
      CASE WHEN {m} IS NOT NULL THEN {column} <> {m} ELSE false END AS was_modified,
      CASE WHEN {m} IS NOT NULL THEN 'Normalized {column} ''' || {column} || ''' -> ''' || {m} || '''' ELSE 'Retained unrecognized {column} ''' || {column} || '''' END AS transformation_reason
      FROM cases"""


oracle("client_segments_by_rule_table", f"""{BASE}, rules AS (SELECT {tok('c_name')} AS t, min({strip('c_mktsegment')}) AS m FROM customer GROUP BY 1)
  SELECT row_index, 'client_name' AS column_name, client_name AS raw_value, {tok('client_name')} AS cleaned_token, coalesce(m, client_name) AS normalized_value,
    m IS NOT NULL AS is_canonical, m IS NULL AS is_unresolved, m IS NOT NULL AND client_name <> m AS was_modified,
    CASE WHEN m IS NOT NULL THEN format('Normalized client_name ''{{}}'' -> ''{{}}''', client_name, m) ELSE format('Retained unrecognized client_name ''{{}}''', client_name) END AS transformation_reason
  FROM cases LEFT JOIN rules ON t = {tok('client_name')} AND t <> ''""")
oracle("part_types_by_shuffled_rules", f"SELECT p_partkey, p_name, min({strip('p_type')}) OVER (PARTITION BY {tok('p_name')}) AS p_type FROM part")
oracle("rule_conflicts", f"""SELECT {tok('p_name')} AS token, min({strip('p_brand')}) AS chosen, count(DISTINCT {strip('p_brand')}) AS "values"
  FROM part GROUP BY 1 HAVING count(DISTINCT {strip('p_brand')}) > 1""")

_C, _CM = strip("category"), _map(tok("category"), vocab.CATEGORY_ALIASES)
_CK = f"{_C} IN ({_list(vocab.CANONICAL_CATEGORIES)})"
_RECORDS = f"""SELECT row_index, 'category' AS column_name, category AS raw_value, {tok('category')} AS cleaned_token, {_category('category')} AS normalized_value,
  {_C} <> '' AND ({_CK} OR {_CM} IS NOT NULL) AS is_canonical, {_C} <> '' AND NOT {_CK} AND {_CM} IS NULL AS is_unresolved,
  {_C} = '' OR (NOT {_CK} AND {_CM} IS NOT NULL) AS was_modified,
  CASE WHEN {_C} = '' THEN 'Missing category defaulted to ''Uncategorized''' WHEN {_CK} THEN 'Already canonical category'
    WHEN {_CM} IS NOT NULL THEN 'Mapped alias ''' || {_C} || ''' -> ''' || {_CM} || '''' ELSE 'Retained unmapped category ''' || {_C} || '''' END AS transformation_reason
  FROM cases UNION ALL {_enum_records('priority', vocab.PRIORITY_ALIASES)} UNION ALL {_enum_records('status', vocab.STATUS_ALIASES)}"""
oracle("normalization_records", f"{BASE} {_RECORDS}")
oracle("normalization_summary", f"""{BASE}, records AS ({_RECORDS}) SELECT column_name, count(*) AS cells, count(*) FILTER (was_modified) AS modified,
  count(*) FILTER (is_unresolved) AS unresolved FROM records GROUP BY 1""")
oracle("priority_with_default", """SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Critical' WHEN '2-HIGH' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium'
  WHEN '5-LOW' THEN 'Low' ELSE 'Unknown' END AS priority, o_orderpriority <> '4-NOT SPECIFIED' AS is_canonical, count(*) AS orders FROM orders GROUP BY 1, 2""")

# --- dates -----------------------------------------------------------------------------------
oracle("date_audit_rows", f"{DATED} SELECT row_index, dur AS duration_days, array_to_string(flags, ',') AS flags, len(flags) = 0 AS is_valid FROM flagged")
oracle("date_audit_summary", f"""{DATED} SELECT count(*) AS total_records, count(*) FILTER (len(flags) = 0) AS valid_date_records,
  count(*) FILTER (list_contains(flags, 'INVALID_INTAKE_FORMAT')) AS unparseable_intake_count,
  count(*) FILTER (list_contains(flags, 'INVALID_CLOSURE_FORMAT')) AS unparseable_closure_count,
  count(*) FILTER (list_contains(flags, 'FUTURE_INTAKE_DATE')) AS future_date_count,
  count(*) FILTER (list_contains(flags, 'NEGATIVE_DURATION')) AS negative_duration_count,
  count(*) FILTER (list_contains(flags, 'TRIAGE_BEFORE_INTAKE') OR list_contains(flags, 'TRIAGE_AFTER_CLOSURE')) AS triage_order_violation_count,
  count(*) FILTER (ia IS NOT NULL AND ca IS NULL AND NOT list_contains(flags, 'INVALID_CLOSURE_FORMAT')) AS open_cases_count,
  round_even(avg(dur) FILTER (len(flags) = 0 AND dur >= 0), 2) AS mean_duration_days,
  round_even(median(dur) FILTER (len(flags) = 0 AND dur >= 0), 2) AS median_duration_days FROM flagged""")

# --- rules -----------------------------------------------------------------------------------
_NK = f"lower({collapse('client_name')})"
HITS = f"""
keyed AS (
  SELECT *, trim(case_id) AS cid, {catkey('category', '')} AS ck0, {_NK} AS nk, {catkey('category')} AS ck1, {number('contact_count')} AS num FROM timed),
counted AS (
  SELECT *, count(*) OVER (PARTITION BY cid) AS same_id, count(*) OVER (PARTITION BY nk, ck0, trim(intake_date)) AS same_case FROM keyed),
hits AS (
  SELECT row_index, 'missing_case_id' AS rule_name, 'CRITICAL' AS severity, 'case_id' AS "column", 'Row ' || row_index AS value FROM counted WHERE lower(cid) IN ({_list(vocab.MISSING_ID_TOKENS)})
  UNION ALL SELECT row_index, 'duplicate_case_id', 'MAJOR', 'case_id', cid FROM counted WHERE cid <> '' AND same_id > 1
  UNION ALL SELECT row_index, 'semantic_duplicate_case', 'MAJOR', 'client_name + category + intake_date', 'Row ' || row_index FROM counted
    WHERE nk <> '' AND ck0 <> '' AND trim(intake_date) <> '' AND same_case > 1
  UNION ALL SELECT row_index, 'invalid_status_enum', 'MAJOR', 'status', trim(status) FROM counted WHERE trim(status) <> '' AND lower(trim(status)) NOT IN ({_list(vocab.VALID_STATUSES)})
  UNION ALL SELECT row_index, 'invalid_priority_enum', 'MAJOR', 'priority', trim(priority) FROM counted WHERE trim(priority) <> '' AND lower(trim(priority)) NOT IN ({_list(vocab.VALID_PRIORITIES)})
  UNION ALL SELECT row_index, 'unstandardized_or_missing_category', 'MINOR', 'category', trim(category) FROM counted
    WHERE ck1 NOT IN ({_list([c.lower() for c in vocab.CANONICAL_CATEGORIES])})
  UNION ALL SELECT row_index, 'invalid_contact_count_bounds', 'MAJOR', 'contact_count', trim(contact_count) FROM counted
    WHERE trim(contact_count) <> '' AND (num IS NULL OR num < 0 OR num > 1000)
  UNION ALL SELECT row_index, 'invalid_intake_date_format', 'CRITICAL', 'intake_date', trim(intake_date) FROM counted WHERE trim(intake_date) <> '' AND ia IS NULL
  UNION ALL SELECT row_index, 'invalid_closure_date_format', 'CRITICAL', 'closure_date', trim(closure_date) FROM counted WHERE trim(closure_date) <> '' AND ca IS NULL
  UNION ALL SELECT row_index, 'future_intake_date', 'CRITICAL', 'intake_date', trim(intake_date) FROM counted WHERE ia > {_REF}
  UNION ALL SELECT row_index, 'negative_resolution_duration', 'CRITICAL', 'intake_date -> closure_date',
    'Row ' || row_index || ' (Intake: ' || trim(intake_date) || ', Closure: ' || trim(closure_date) || ')' FROM counted WHERE ca < ia),
score AS (
  SELECT n AS total_records, greatest(0.0, round_even(100 - penalty / (n * 3.0) * 100, 2)) AS quality_score, rules AS total_anomalies, total_hits,
    n - dirty AS clean_records_count, round_even((n - dirty) * 100.0 / n, 2) AS clean_records_pct
  FROM (SELECT (SELECT count(*) FROM cases) AS n, CAST(sum(CASE severity WHEN 'CRITICAL' THEN 3.0 WHEN 'MAJOR' THEN 1.5 ELSE 0.5 END) AS DOUBLE) AS penalty,
    CAST(count(DISTINCT rule_name) AS INT) AS rules, count(*) AS total_hits, count(DISTINCT row_index) AS dirty FROM hits))
"""
RULED = f"{DATED}, {HITS}"
oracle("rule_hits", f"{RULED} SELECT * FROM hits")
oracle("quality_score", f"""{RULED} SELECT *, CASE WHEN quality_score >= 85 THEN 'HEALTHY' WHEN quality_score >= 60 THEN 'ACTION REQUIRED' ELSE 'CRITICAL DEGRADATION' END AS health FROM score""")
oracle("anomaly_listing", f"""{RULED} SELECT rule_name, severity, "column", count(*) AS affected_rows,
  round_even(count(*) * 100.0 / (SELECT count(*) FROM cases), 2) AS pct_of_dataset,
  CAST(CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'MAJOR' THEN 1 ELSE 2 END AS INT) AS severity_rank FROM hits GROUP BY 1, 2, 3""")
oracle("anomaly_samples", f"""{RULED}, seen AS (SELECT rule_name, value, min(row_index) AS first_row FROM hits GROUP BY 1, 2)
  SELECT rule_name, value, first_row, CAST(row_number() OVER (PARTITION BY rule_name ORDER BY first_row, value) AS INT) AS position FROM seen
  QUALIFY row_number() OVER (PARTITION BY rule_name ORDER BY first_row, value) <= 5""")

# --- cleaning --------------------------------------------------------------------------------
oracle("cleaned_cases", f"{FULL} SELECT * FROM clean")
oracle("quarantined_cases", f"{FULL} SELECT row_index, case_id, client_name, quarantine_reason FROM std WHERE quarantine_reason <> ''")
oracle("merged_cases", f"{FULL} SELECT row_index, first_row AS merged_into FROM ranked WHERE first_row <> row_index")
oracle("contact_median", f"{FULL} SELECT CAST(m AS BIGINT) AS median FROM middle")
oracle("contact_median_by_agent", f"""{BASE}, c AS (SELECT assigned_agent, priority, {number('contact_count')} AS k FROM cases)
  SELECT assigned_agent, priority, CAST(coalesce(trunc(median(k) FILTER (k BETWEEN 0 AND {vocab.MAX_CONTACTS_CLEANING})), {vocab.DEFAULT_CONTACTS}) AS BIGINT) AS median FROM c GROUP BY 1, 2""")

_CELLS = " UNION ALL ".join(
    f"SELECT row_index, case_id, '{c}' AS column_name, {c} AS old_value, {collapse(c)} AS new_value, 'WHITESPACE_TRIMMING' AS transformation_rule, "
    f"'Trimmed irregular whitespace from column ''{c}''' AS reason, {100 + i} AS stage FROM cases WHERE {c} <> {collapse(c)}"
    for i, c in enumerate(COLUMNS)
)
_DATES = " UNION ALL ".join(
    f"SELECT row_index, {collapse('case_id')}, '{k}_date', {k}_date, strftime({a}, '%Y-%m-%d'), 'DATE_FORMAT_STANDARDIZATION', "
    f"'Standardized {k} date to ISO-8601 ''' || strftime({a}, '%Y-%m-%d') || '''', 700 FROM graded "
    f"WHERE NOT keyless AND len(crit) = 0 AND {k}_date <> strftime({a}, '%Y-%m-%d')"
    for k, a in (("intake", "ia"), ("closure", "ca"))
)
AUDIT = f"""
records AS ({_RECORDS}),
trail AS (
  {_CELLS}
  UNION ALL SELECT r.row_index, c.case_id, column_name, raw_value, normalized_value, upper(column_name) || '_NORMALIZATION', transformation_reason,
    CASE column_name WHEN 'category' THEN 200 WHEN 'priority' THEN 300 ELSE 400 END FROM records r JOIN cases c USING (row_index) WHERE was_modified
  UNION ALL SELECT row_index, case_id, 'triaged', triaged, f, 'BOOLEAN_STANDARDIZATION', 'Standardized boolean triaged flag ''' || triaged || ''' -> ' || f, 500
    FROM (SELECT *, CASE WHEN {_FLAG} THEN 'True' ELSE 'False' END AS f FROM cases) WHERE triaged <> f
  UNION ALL SELECT row_index, case_id, 'contact_count', contact_count, CAST(m AS VARCHAR), 'METRIC_IMPUTATION',
    'Imputed invalid/outlier contact count ''' || contact_count || ''' with cohort median (' || m || ')', 600
    FROM cases, middle WHERE ({number('contact_count')} BETWEEN 0 AND 100) IS NOT TRUE
  UNION ALL SELECT row_index, {collapse('case_id')}, 'RECORD', 'ACTIVE', 'QUARANTINED', CASE WHEN keyless THEN 'PRIMARY_KEY_QUARANTINE' ELSE 'TEMPORAL_ANOMALY_QUARANTINE' END,
    CASE WHEN keyless THEN 'Missing required primary key `case_id`' ELSE 'Critical date defect: ' || array_to_string(crit, ', ') END, 700 FROM graded WHERE keyless OR len(crit) > 0
  UNION ALL {_DATES}
  UNION ALL SELECT row_index, c.case_id, 'RECORD', 'ACTIVE', 'MERGED_DUPLICATE', 'DEDUPLICATION_MERGE', 'Deduplicated redundant case matching primary canonical submission', 800
    FROM ranked r JOIN cases c USING (row_index) WHERE r.first_row <> r.row_index)
"""
TRAIL = f"{FULL}, {AUDIT}"
oracle("cleaning_audit", f"{TRAIL} SELECT row_index, case_id, column_name, old_value, new_value, transformation_rule, reason, CAST(stage AS INT) AS stage FROM trail")
oracle("audit_summary", f"""{TRAIL} SELECT 'total' AS scope, 'all' AS name, count(*) AS entries, count(DISTINCT row_index) AS rows FROM trail
  UNION ALL SELECT 'rule', transformation_rule, count(*), count(DISTINCT row_index) FROM trail GROUP BY 2
  UNION ALL SELECT 'column', column_name, count(*), count(DISTINCT row_index) FROM trail GROUP BY 2""")
SUMMARY = """summary AS (SELECT count(*) AS initial_rows, count(*) FILTER (first_row = row_index) AS final_rows, count(*) FILTER (first_row <> row_index) AS deduplicated_rows,
  count(*) FILTER (quarantine_reason <> '') AS quarantined_rows, (SELECT count(*) FROM trail) AS modifications FROM ranked)"""
oracle("cleaning_summary", f"{TRAIL}, {SUMMARY} SELECT * FROM summary")

# --- profile ---------------------------------------------------------------------------------


def _missing(c: str) -> str:
    return f"({strip(c)} = '' OR lower(coalesce({c}, '')) IN ('nan', 'none'))"


def _unpivot(source: str, columns: list[str], row: str) -> str:
    return " UNION ALL ".join(f"SELECT {row} AS row_index, {i} AS ordinal, '{c}' AS column_name, coalesce(CAST({c} AS VARCHAR), '') AS value FROM {source}" for i, c in enumerate(columns))


def _column_profile(source: str, columns: list[str], row: str, date: str, first: int | None = 20) -> str:
    limit = f" QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY row_index) <= {first}" if first else ""
    return f"""cells AS (SELECT *, {strip('value')} AS s, {_missing('value')} AS gone FROM ({_unpivot(source, columns, row)})),
  firsts AS (SELECT * FROM cells WHERE NOT gone{limit}),
  dated AS (SELECT column_name, bool_and(({date}) IS NOT NULL) AS all_dates FROM firsts GROUP BY 1),
  m AS (SELECT column_name, min(ordinal) AS ordinal, count(*) AS total, count(*) FILTER (gone) AS missing, count(*) FILTER (s <> '') AS written,
    count(*) FILTER (s <> '' AND NOT regexp_full_match(lower(s), '[+-]?((\\d+\\.?\\d*|\\.\\d+)(e[+-]?\\d+)?|inf|infinity|nan)')) AS not_number,
    count(*) FILTER (s <> '' AND lower(s) NOT IN ('yes', 'no', 'y', 'n', 'true', 'false', '1', '0')) AS not_boolean,
    count(DISTINCT value) FILTER (NOT gone) AS unique_count, count(DISTINCT lower(s)) FILTER (NOT gone) AS folded FROM cells GROUP BY 1)
  SELECT CAST(ordinal AS INT) AS ordinal, column_name, CASE WHEN written = 0 THEN 'empty' WHEN not_number = 0 THEN 'numeric' WHEN not_boolean = 0 THEN 'boolean'
    WHEN coalesce(all_dates, false) THEN 'datetime' WHEN folded <= 10 OR (folded < 50 AND folded / written < 0.5) THEN 'categorical' ELSE 'text' END AS inferred_type,
    total AS total_count, missing AS missing_count, round_even(missing * 100.0 / total, 2) AS missing_percentage, unique_count,
    round_even(unique_count / total, 4) AS unique_ratio FROM m LEFT JOIN dated USING (column_name)"""


oracle("dataset_profile", f"""{BASE}, u AS (SELECT count(*) AS d FROM (SELECT DISTINCT * EXCLUDE (row_index) FROM cases)), n AS (SELECT count(*) AS n FROM cases)
  SELECT n AS row_count, 12 AS column_count, n - d AS exact_duplicate_rows, round_even((n - d) * 100.0 / n, 2) AS exact_duplicate_percentage FROM u, n""")
oracle("repeated_lines", """SELECT count(*) AS row_count, 2 AS column_count, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS exact_duplicate_rows,
  round_even((count(*) - count(DISTINCT (l_orderkey, l_linenumber))) * 100.0 / count(*), 2) AS exact_duplicate_percentage FROM lineitem""")
oracle("repeated_whole_lines", """SELECT count(*) AS row_count, 11 AS column_count, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS exact_duplicate_rows,
  round_even((count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem))) * 100.0 / count(*), 2) AS exact_duplicate_percentage FROM lineitem""")
oracle("order_row_index", "SELECT row_number() OVER () - 1 AS row_index, o_orderkey FROM orders")
oracle("column_profile", f"{BASE}, {_column_profile('cases', COLUMNS, 'row_index', parse('value'))}")
oracle("column_profile_all_values", f"{BASE}, {_column_profile('cases', COLUMNS, 'row_index', parse('value'), None)}")
oracle("profile_customers", f"WITH {_column_profile('customer', ['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment'], 'c_custkey', parse('value'))}")
oracle("top_values", f"""{BASE}, cells AS ({_unpivot('cases', COLUMNS, 'row_index')}), c AS (SELECT column_name, value, count(*) AS n FROM cells WHERE NOT {_missing('value')} GROUP BY 1, 2)
  SELECT column_name, value, n, CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS INT) AS position FROM c
  QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) <= 5""")
oracle("frequent_cells", ORACLES["top_values"])
oracle("frequent_document_words", """WITH w AS (SELECT lang, unnest(string_split_regex(text, '[\\x20\\x09-\\x0D]+')) AS word FROM documents),
  c AS (SELECT lang, word, count(*) AS n FROM w WHERE word <> '' GROUP BY 1, 2)
  SELECT lang, word, n, CAST(row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS INT) AS position FROM c
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= 10""")
oracle("distinct_by_merged_sketches", f"""WITH cells AS ({_unpivot('events', ['event_id', 'ts', 'user_id', 'event_type', 'value', 'props'], '0')}), m AS (SELECT column_name, count(*) AS total_count,
    count(*) FILTER ({_missing('value')}) AS missing_count, count(DISTINCT value) FILTER (NOT {_missing('value')}) AS unique_count FROM cells GROUP BY 1)
  SELECT column_name, total_count, missing_count, round_even(missing_count * 100.0 / total_count, 2) AS missing_percentage, unique_count, true AS within_error FROM m WHERE unique_count > 0""")
oracle("first_values", f"""{BASE}, cells AS ({_unpivot('cases', COLUMNS, 'row_index')}) SELECT row_index, column_name, value FROM cells WHERE NOT {_missing('value')}
  QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY row_index) <= 5""")


def _missing_share(source: str, columns: list[str]) -> str:
    return f"""cells AS ({_unpivot(source, columns, '0')}), m AS (SELECT column_name, count(*) FILTER ({_missing('value')}) AS missing_count, count(*) AS t FROM cells GROUP BY 1)
  SELECT column_name, missing_count, round_even(missing_count * 100.0 / t, 2) AS missing_pct,
    CASE WHEN missing_count * 100.0 / t > 10 THEN 'HIGH' WHEN missing_count * 100.0 / t > 5 THEN 'MED' ELSE 'LOW' END AS severity FROM m"""


oracle("missing_share", f"{BASE}, {_missing_share('cases', COLUMNS)}")
oracle("missingness_sample", f"""{BASE} SELECT row_index, {', '.join(f"CAST({_missing(c)} AS INT) AS {c}" for c in COLUMNS)} FROM cases
  ORDER BY md5(CAST(row_index AS VARCHAR)), row_index LIMIT 60""")
oracle("profile_pages", f"WITH {_missing_share('pages', ['page_id', 'url', 'html'])}")

# --- duplicates ------------------------------------------------------------------------------
oracle("exact_duplicates", """SELECT first AS index_a, doc_id AS index_b FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text, lang, source, n_chars) AS first FROM documents) WHERE doc_id <> first""")
_NORMAL = f"""nk AS (SELECT row_index, case_id, lower({collapse('client_name')}) AS a, lower({collapse('category')}) AS b, lower({collapse('intake_date')}) AS c, lower({collapse('closure_date')}) AS d FROM cases),
  ng AS (SELECT row_index, case_id, min(row_index) OVER w AS first, count(*) OVER w AS n FROM nk WHERE a <> '' AND b <> '' AND c <> '' AND d <> '' WINDOW w AS (PARTITION BY a, b, c, d))"""
oracle("normalized_duplicates", f"{BASE}, {_NORMAL} SELECT first AS index_a, row_index AS index_b FROM ng WHERE first <> row_index")
_DOCS = f"""d AS (SELECT doc_id, min(doc_id) OVER w AS first, count(*) OVER w AS n FROM documents WHERE {collapse('text')} <> '' WINDOW w AS (PARTITION BY lower({collapse('text')})))"""
oracle("normalized_document_duplicates", f"WITH {_DOCS} SELECT first AS index_a, doc_id AS index_b FROM d WHERE first <> doc_id")
oracle("cluster_members", f"WITH {_DOCS} SELECT first AS canonical, doc_id AS member FROM d WHERE n > 1")
oracle("order_chain_clusters", """WITH o AS (SELECT *, row_number() OVER w AS place, lead(o_orderstatus) OVER w AS status, lead(o_orderpriority) OVER w AS priority, count(*) OVER (PARTITION BY o_custkey) AS n
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
  SELECT o_orderkey AS canonical_index, n AS total_records, CASE WHEN o_orderstatus = status THEN 'EXACT' WHEN o_orderpriority = priority THEN 'NORMALIZED' ELSE 'FUZZY' END AS match_type,
    'Row ' || CAST(o_orderkey AS VARCHAR) AS sample_identifier FROM o WHERE place = 1 AND n > 1""")
oracle("duplicate_clusters", f"""{BASE}, {_NORMAL} SELECT first AS canonical_index, max(n) AS total_records, 'NORMALIZED' AS match_type,
  max(CASE WHEN row_index = first THEN case_id END) AS sample_identifier FROM ng WHERE n > 1 GROUP BY 1""")

# Longest common subsequence: a recursive fold over the characters of one text, each step a running maximum.
_LCS_REC = """names AS (SELECT name, array_to_string(list_sort(string_split(name, ' ')), ' ') AS s FROM (SELECT DISTINCT lower(trim(p_name)) AS name FROM part)),
  texts AS (SELECT DISTINCT s FROM names),
  pairs AS (SELECT x.s AS a, y.s AS b FROM texts x JOIN texts y ON x.s < y.s),
  fold AS (
    SELECT a, b, 0 AS i, list_transform(generate_series(0, length(b)), lambda j: 0) AS r FROM pairs
    UNION ALL
    SELECT a, b, i + 1, list_concat([0], list_transform(generate_series(1, length(b)), lambda j:
      list_max(list_transform(generate_series(1, j), lambda t: greatest(r[t + 1], r[t] + CASE WHEN substr(b, t, 1) = substr(a, i + 1, 1) THEN 1 ELSE 0 END)))))
    FROM fold WHERE i < length(a)),
  scored AS (SELECT a, b, 200.0 * r[length(b) + 1] / (length(a) + length(b)) AS score FROM fold WHERE i = length(a)
    UNION ALL SELECT s, s, 100.0 FROM texts),
  np AS (SELECT x.name AS name_1, y.name AS name_2, score FROM scored JOIN names x ON x.s = a JOIN names y ON y.s = b WHERE x.name < y.name
    UNION ALL SELECT y.name, x.name, score FROM scored JOIN names x ON x.s = a JOIN names y ON y.s = b WHERE y.name < x.name AND a <> b)"""
_TYPE_REC = """types AS (SELECT DISTINCT lower(trim(p_type)) AS t FROM part),
  tp AS (SELECT x.t AS a, y.t AS b FROM types x JOIN types y ON x.t < y.t),
  tf AS (SELECT a, b, 0 AS i, list_transform(generate_series(0, length(b)), lambda j: 0) AS r FROM tp
    UNION ALL SELECT a, b, i + 1, list_concat([0], list_transform(generate_series(1, length(b)), lambda j:
      list_max(list_transform(generate_series(1, j), lambda t: greatest(r[t + 1], r[t] + CASE WHEN substr(b, t, 1) = substr(a, i + 1, 1) THEN 1 ELSE 0 END)))))
    FROM tf WHERE i < length(a)),
  near AS (SELECT a, b FROM tf WHERE i = length(a) AND 200.0 * r[length(b) + 1] / (length(a) + length(b)) >= 70
    UNION ALL SELECT b, a FROM tf WHERE i = length(a) AND 200.0 * r[length(b) + 1] / (length(a) + length(b)) >= 70
    UNION ALL SELECT t, t FROM types)"""
_FUZZY = f"WITH RECURSIVE {_LCS_REC}, {_TYPE_REC}"
oracle("fuzzy_group_pairs", f"""{_FUZZY}, g AS (SELECT lower(trim(p_name)) AS name, lower(trim(p_type)) AS t, count(*) AS n FROM part GROUP BY 1, 2)
  SELECT name_1, name_2, x.t AS companion_1, y.t AS companion_2, x.n * y.n AS row_pairs, round_even(score, 2) AS similarity_score
  FROM np JOIN g x ON x.name = name_1 JOIN g y ON y.name = name_2 JOIN near ON near.a = x.t AND near.b = y.t WHERE score >= 70""")
oracle("fuzzy_duplicates", f"""{_FUZZY}, g AS (SELECT p_partkey AS k, lower(trim(p_name)) AS name, lower(trim(p_type)) AS t FROM part)
  SELECT least(x.k, y.k) AS index_a, greatest(x.k, y.k) AS index_b, round_even(score, 2) AS similarity_score
  FROM np JOIN g x ON x.name = name_1 JOIN g y ON y.name = name_2 JOIN near ON near.a = x.t AND near.b = y.t WHERE score >= 80""")

# --- statistics ------------------------------------------------------------------------------


def _spread(source: str, value: str, by: str) -> str:
    return f"""SELECT {by}, count(*) AS count, round(avg({value}), 6) AS mean, round(median({value}), 6) AS median,
      round(stddev_samp({value}), 6) AS std FROM {source} GROUP BY ALL"""


oracle("monthly_cohorts", f"{FULL} {_spread('closed', 'duration_days', 'intake_month')}")
oracle("category_durations", f"{FULL} {_spread('closed', 'duration_days', 'category')}")
oracle("priority_durations", f"{FULL} {_spread('closed', 'duration_days', 'priority')}")


def _ranks(source: str, value: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    keep = f"{by}, " if by else ""
    return f"""SELECT *, rank() OVER ({part} ORDER BY {value}) + (count(*) OVER (PARTITION BY {keep}{value}) - 1) / 2 AS rk,
      count(*) OVER (PARTITION BY {keep}{value}) AS tied, count(*) OVER ({part}) AS total FROM {source}"""


oracle("mid_ranks", f"""WITH r AS ({_ranks('events', 'value', 'event_type')}) SELECT event_type, value, count(*) AS n, CAST(min(rk) AS DOUBLE) AS mid_rank FROM r WHERE value IS NOT NULL GROUP BY 1, 2""")


def _boxes(source: str, value: str, by: str) -> str:
    return f"""q AS (SELECT {by}, count({value}) AS count, avg({value}) AS mean, quantile_cont({value}, 0.25) AS q1, median({value}) AS median, quantile_cont({value}, 0.75) AS q3 FROM {source} GROUP BY 1)
  SELECT q.{by}, any_value(q.count) AS count, round(any_value(q.mean), 6) AS mean, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
    round(min({value}) FILTER ({value} >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low, round(max({value}) FILTER ({value} <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
    count(*) FILTER ({value} < q1 - 1.5 * (q3 - q1) OR {value} > q3 + 1.5 * (q3 - q1)) AS outliers FROM q JOIN {source} s ON s.{by} = q.{by} GROUP BY 1"""


oracle("event_outliers", """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
  s AS (SELECT e.event_type, CASE WHEN value < q1 - 1.5 * (q3 - q1) THEN 'low' WHEN value > q3 + 1.5 * (q3 - q1) THEN 'high' END AS side, value, count(*) AS rows FROM events e JOIN q ON e.event_type = q.event_type GROUP BY ALL)
  SELECT event_type, side, CAST(row_number() OVER (PARTITION BY event_type, side ORDER BY CASE WHEN side = 'low' THEN value ELSE -value END) AS INT) AS place, round(value, 6) AS value, rows
  FROM s WHERE side IS NOT NULL QUALIFY place <= 5""")
oracle("line_price_medians", """SELECT l_suppkey, count(l_extendedprice) AS count, round(avg(CAST(l_extendedprice AS DOUBLE)), 4) AS mean,
  round(median(CAST(l_extendedprice AS DOUBLE)), 4) AS median, round(stddev_samp(CAST(l_extendedprice AS DOUBLE)), 4) AS std FROM lineitem GROUP BY 1""")


def _two_factors(sweeps: int = 40) -> str:
    """Both factors are taken out by turns, until nothing is left of them; then two numbers remain to be fitted."""
    steps = ["""v0 AS MATERIALIZED (SELECT l_partkey AS a, l_suppkey AS b, CAST(l_extendedprice AS DOUBLE) AS y, CAST(l_quantity AS DOUBLE) AS x, CAST(l_returnflag = 'R' AS DOUBLE) AS z FROM lineitem
  WHERE l_extendedprice IS NOT NULL AND l_partkey IS NOT NULL AND l_suppkey IS NOT NULL AND l_quantity IS NOT NULL AND l_returnflag IS NOT NULL)"""]
    for i in range(sweeps):
        by = "ab"[i % 2]
        steps.append(f"v{i + 1} AS MATERIALIZED (SELECT a, b, " + ", ".join(f"{c} - avg({c}) OVER (PARTITION BY {by}) AS {c}" for c in "yxz") + f" FROM v{i})")
    return "WITH " + ",\n".join(steps) + f""",
  m AS (SELECT sum(y * y) AS yy, sum(x * y) AS xy, sum(z * y) AS zy, sum(x * x) AS xx, sum(z * z) AS zz, sum(x * z) AS xz FROM v{sweeps}),
  w AS (SELECT count(*) AS n, var_pop(y) * count(*) AS tss FROM v0),
  l AS (SELECT count(DISTINCT a) + count(DISTINCT b) AS levels FROM v0),
  f AS (SELECT n, levels - 2 + 2 AS df, 1 - (yy - (xy * xy * zz - 2 * xy * zy * xz + zy * zy * xx) / (xx * zz - xz * xz)) / tss AS r2 FROM m, w, l)
  SELECT n, df AS model_df, n - 1 - df AS resid_df, round(r2, 8) AS r2, round(1 - (1 - r2) * (n - 1) / (n - 1 - df), 8) AS adj_r2,
    round(r2 / df / ((1 - r2) / (n - 1 - df)), 4) AS f_stat, true AS solved FROM f"""


oracle("line_price_factors", _two_factors())
oracle("event_quartiles", f"WITH {_boxes('events', 'value', 'event_type')}")
oracle("trend_by_event_type", """WITH s AS (SELECT event_type, datediff('day', DATE '0001-01-01', CAST(ts AS DATE)) + 1 AS x, value AS y FROM events),
  f AS (SELECT event_type, regr_count(y, x) AS n, regr_slope(y, x) AS slope, regr_r2(y, x) AS r2, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy FROM s GROUP BY 1)
  SELECT event_type, CAST(n AS BIGINT) AS n, round(slope, 6) AS slope, round(r2, 6) AS r2, round(sqrt((1 - r2) * syy / sxx / (n - 2)), 6) AS std_err,
    round(slope / sqrt((1 - r2) * syy / sxx / (n - 2)), 6) AS t FROM f""")


def _kruskal(source: str, by: str = "") -> str:
    keep = f"{by}, " if by else ""
    return f"""r AS ({_ranks(source, 'value', by)}),
  g AS (SELECT {keep}event_type, count(*) AS m, sum(rk) AS rs FROM r GROUP BY ALL),
  t AS (SELECT {keep}sum(tied * tied - 1.0) AS ties, count(*) AS n FROM r GROUP BY ALL),
  h AS (SELECT {keep}count(*) AS groups, sum(rs * rs / m) AS s FROM g GROUP BY ALL)
  SELECT {keep}n, groups, round(CASE WHEN groups > 1 THEN (12.0 / (n * (n + 1.0)) * s - 3 * (n + 1)) / (1 - ties / (CAST(n AS DOUBLE) ** 3 - n)) ELSE 0 END, 6) AS h_stat
  FROM h JOIN t {'USING (' + by + ')' if by else 'ON true'}"""


def _simpson(density: str, upper: str, steps: int = 4000) -> str:
    """Integral of a density in @ from 0 to ``upper``, row by row."""
    weight = f"CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return f"(SELECT {upper} / {steps} / 3 * sum({weight} * ({density.replace('@', f'({upper} * i / {steps})')})) FROM range(0, {steps + 1}) AS k(i))"


def _student(t: str, df: str) -> str:
    """Two-sided tail of Student's t; all but nothing lies within 60."""
    density = f"exp(lgamma(({df} + 1) / 2.0) - lgamma({df} / 2.0) - ({df} + 1) / 2.0 * ln(1 + @ * @ / {df})) / sqrt({df} * pi())"
    return f"(1 - 2 * {_simpson(density, f'least(abs({t}), 60)')})"


def _chi2(h: str, df: str) -> str:
    """Upper tail of chi-square, integrated over its square root, where the density is smooth."""
    density = f"2 * pow(@, {df} - 1) * exp(-@ * @ / 2) / (pow(2, {df} / 2.0) * exp(lgamma({df} / 2.0)))"
    return f"(1 - {_simpson(density, f'sqrt({h})')})"


def _normal(z: str) -> str:
    return f"(1 - 2 * {_simpson('exp(-@ * @ / 2) / sqrt(2 * pi())', f'least(abs({z}), 12)')})"


def _arms(source: str, value: str, arm: str, by: str = "") -> str:
    """u_p and welch_p of two arms, in columns n1, n2, u, z, t, df."""
    keep = f"{by}, " if by else ""
    return f"""r AS ({_ranks(source, value, by)}),
  s AS (SELECT {keep}count(*) FILTER ({arm}) AS n1, avg({value}) FILTER ({arm}) AS m1, stddev_samp({value}) FILTER ({arm}) AS s1,
    count(*) FILTER (NOT {arm}) AS n2, avg({value}) FILTER (NOT {arm}) AS m2, stddev_samp({value}) FILTER (NOT {arm}) AS s2,
    sum(rk) FILTER ({arm}) - count(*) FILTER ({arm}) * (count(*) FILTER ({arm}) + 1) / 2 AS u, sum(tied * tied - 1.0) AS ties, CAST(count(*) AS DOUBLE) AS n FROM r GROUP BY ALL),
  w AS (SELECT *, greatest(u, n1 * n2 - u) AS big, s1 * s1 / n1 AS e1, s2 * s2 / n2 AS e2 FROM s),
  a AS (SELECT *, (big - n1 * n2 / 2.0 - 0.5) / sqrt(n1 * n2 / 12.0 * (n + 1 - ties / (n * (n - 1)))) AS z, (m1 - m2) / sqrt(e1 + e2) AS t,
    (e1 + e2) * (e1 + e2) / (e1 * e1 / (n1 - 1) + e2 * e2 / (n2 - 1)) AS df FROM w)"""


oracle("trend_p_values", f"""WITH s AS (SELECT event_type, datediff('day', DATE '0001-01-01', CAST(ts AS DATE)) + 1 AS x, value AS y FROM events),
  f AS (SELECT event_type, regr_count(y, x) AS n, regr_slope(y, x) AS slope, regr_r2(y, x) AS r2, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy FROM s GROUP BY 1),
  g AS (SELECT *, sqrt((1 - r2) * syy / sxx / (n - 2)) AS err, CAST(n - 2 AS DOUBLE) AS df FROM f)
  SELECT event_type, CAST(n AS BIGINT) AS n, round(slope, 6) AS slope, round(r2, 6) AS r2, round(err, 6) AS std_err, round({_student('(slope / err)', 'df')}, 6) AS p_value FROM g""")
oracle("kruskal_p_values", f"""WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events), k AS (WITH {_kruskal('e', 'day').replace('round(CASE', '(CASE').replace(' END, 6) AS h_stat', ' END) AS h_stat')})
  SELECT day, round(CASE WHEN groups > 1 THEN {_chi2('greatest(h_stat, 0.0)', '(groups - 1)')} ELSE 1 END, 6) AS p_value FROM k""")
oracle("kruskal_by_unknown_segment", f"""WITH e AS (SELECT *, CAST(user_id % 3 AS VARCHAR) AS part FROM events), k AS (WITH {_kruskal('e', 'part')})
  SELECT nullif(part, '0') AS part, n, groups, h_stat FROM k""")
oracle("spearman_p_values", f"""WITH a AS (SELECT l_returnflag, l_discount, rk AS rx FROM ({_ranks('(SELECT * FROM lineitem)', 'l_quantity', 'l_returnflag')})),
  b AS (SELECT l_returnflag, rx, rk AS ry FROM ({_ranks('a', 'l_discount', 'l_returnflag')})),
  c AS (SELECT l_returnflag, count(*) AS n, corr(rx, ry) AS rho FROM b GROUP BY 1), d AS (SELECT *, CAST(n - 2 AS DOUBLE) AS df, rho * sqrt((n - 2) / ((1 - rho) * (1 + rho))) AS t FROM c)
  SELECT l_returnflag, n, round(rho, 6) AS rho, round({_student('t', 'df')}, 6) AS p_value FROM d""")
oracle("two_arm_p_values", f"""WITH {_arms('(SELECT l_returnflag, l_quantity, l_linestatus FROM lineitem)', 'l_quantity', "(l_linestatus = 'F')", 'l_returnflag')}
  SELECT l_returnflag, CASE WHEN n1 > 0 AND n2 > 0 THEN round({_normal('z')}, 6) END AS u_p, CASE WHEN n1 > 1 AND n2 > 1 THEN round({_student('t', 'df')}, 6) END AS welch_p FROM a""")
oracle("kruskal_event_types", f"WITH {_kruskal('events')}")
oracle("kruskal_by_day", f"WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events), {_kruskal('e', 'day')}")
oracle("spearman_lines", f"""WITH a AS (SELECT l_returnflag, l_extendedprice, rk AS rx FROM ({_ranks('(SELECT * FROM lineitem)', 'l_quantity', 'l_returnflag')})),
  b AS (SELECT l_returnflag, rx, rk AS ry FROM ({_ranks('a', 'l_extendedprice', 'l_returnflag')}))
  SELECT l_returnflag, count(*) AS n, round(corr(rx, ry), 6) AS rho FROM b GROUP BY 1""")
oracle("two_arm_lines", f"""WITH r AS (SELECT *, l_linestatus = 'F' AS arm FROM ({_ranks('lineitem', 'l_quantity', 'l_returnflag')})),
  s AS (SELECT l_returnflag, count(*) FILTER (arm) AS count_1, avg(l_quantity) FILTER (arm) AS mean_1, median(l_quantity) FILTER (arm) AS median_1, stddev_samp(l_quantity) FILTER (arm) AS std_1,
    count(*) FILTER (NOT arm) AS count_2, avg(l_quantity) FILTER (NOT arm) AS mean_2, median(l_quantity) FILTER (NOT arm) AS median_2, stddev_samp(l_quantity) FILTER (NOT arm) AS std_2,
    sum(rk) FILTER (arm) AS rs FROM r GROUP BY 1)
  SELECT l_returnflag, count_1, round(mean_1, 5) AS mean_1, round(median_1, 5) AS median_1, round(std_1, 5) AS std_1, count_2, round(mean_2, 5) AS mean_2,
    round(median_2, 5) AS median_2, round(std_2, 5) AS std_2, round(rs - count_1 * (count_1 + 1) / 2, 5) AS u_stat,
    round((mean_1 - mean_2) / sqrt(std_1 ** 2 / count_1 + std_2 ** 2 / count_2), 5) AS welch_t FROM s""")
oracle("trend_finding", f"""{FULL}, f AS (SELECT regr_count(duration_days, ordinal) AS n, regr_slope(duration_days, ordinal) AS slope, regr_r2(duration_days, ordinal) AS r2,
    regr_sxx(duration_days, ordinal) AS sxx, regr_syy(duration_days, ordinal) AS syy FROM closed),
  m AS (SELECT intake_month, avg(duration_days) AS mean FROM closed GROUP BY 1),
  c AS (SELECT count(*) AS cohorts, min(intake_month) AS first_month, max(intake_month) AS last_month, round_even(arg_min(mean, intake_month), 2) AS first_month_mean,
    round_even(arg_max(mean, intake_month), 2) AS last_month_mean FROM m WHERE intake_month IS NOT NULL)
  SELECT 'Q1' AS question_id, CAST(n AS BIGINT) AS n, cohorts, round_even(slope * 30.4375, 3) AS monthly_slope_days, round_even(r2, 4) AS r_squared,
    round_even(sqrt((1 - r2) * syy / sxx / (n - 2)) * 30.4375, 4) AS std_err, first_month, last_month, first_month_mean, last_month_mean,
    round_even(last_month_mean - first_month_mean, 2) AS mean_increase FROM f, c""")
oracle("trend_verdict", f"""{FULL}, f AS (SELECT regr_count(duration_days, ordinal) AS n, regr_slope(duration_days, ordinal) AS slope, regr_r2(duration_days, ordinal) AS r2,
    regr_sxx(duration_days, ordinal) AS sxx, regr_syy(duration_days, ordinal) AS syy FROM closed),
  g AS (SELECT *, slope / sqrt((1 - r2) * syy / sxx / (n - 2)) AS t, CAST(n - 2 AS DOUBLE) AS df FROM f), p AS (SELECT *, {_student('t', 'df')} AS p FROM g)
  SELECT 'Q1' AS question_id, round(p, 6) AS p_value, CASE WHEN n < 10 THEN 'CANNOT ANSWER' WHEN slope > 0 AND p < 0.05 THEN 'YES' WHEN slope < 0 AND p < 0.05 THEN 'NO'
    ELSE 'INCONCLUSIVE / NO SIGNIFICANT INCREASE' END AS verdict, CASE WHEN n < 10 THEN 'CANNOT ANSWER' WHEN p < 0.01 THEN 'HIGH' WHEN p < 0.05 THEN 'MEDIUM' ELSE 'LOW' END AS confidence_level FROM p""")
oracle("triage_verdict", f"""{FULL}, urgent AS (SELECT duration_days, triaged FROM closed WHERE priority IN ('High', 'Critical')), {_arms('urgent', 'duration_days', 'triaged')},
  q AS (SELECT median(duration_days) FILTER (triaged) AS d1, median(duration_days) FILTER (NOT triaged) AS d2 FROM urgent),
  p AS (SELECT *, {_normal('z')} AS up, {_student('t', 'df')} AS wp, round_even(m1, 2) AS a1, round_even(m2, 2) AS a2 FROM a, q)
  SELECT 'Q3' AS question_id, n1 AS triaged_n, a1 AS triaged_mean, round_even(d1, 2) AS triaged_median, round_even(s1, 2) AS triaged_std,
    n2 AS untriaged_n, a2 AS untriaged_mean, round_even(d2, 2) AS untriaged_median, round_even(s2, 2) AS untriaged_std,
    round_even(a2 - a1, 2) AS mean_difference_days, round_even((a2 - a1) / a2 * 100, 2) AS percentage_reduction, u AS mann_whitney_u, round(up, 6) AS mann_whitney_p, up < 0.05 AS significant,
    round_even(t, 3) AS welch_t_stat, round(wp, 6) AS welch_t_p, CASE WHEN n1 + n2 < 10 THEN 'CANNOT ANSWER' WHEN up < 0.05 AND a1 < a2 THEN 'YES' ELSE 'MODERATE / INCONCLUSIVE EFFECT' END AS verdict,
    CASE WHEN n1 + n2 < 10 THEN 'CANNOT ANSWER' WHEN up < 0.01 AND a1 < a2 THEN 'HIGH' WHEN up < 0.05 AND a1 < a2 THEN 'MEDIUM' WHEN n2 >= 5 THEN 'MEDIUM' ELSE 'LOW' END AS confidence_level FROM p""")
def _drivers(by: str) -> str:
    """Q2 per segment: rank tests, and least squares by eliminating the moment matrix pivot by pivot."""
    f_density = "2 * pow(@, d1 - 1) * exp(lgamma((d1 + d2) / 2.0) - lgamma(d1 / 2.0) - lgamma(d2 / 2.0) + d1 / 2.0 * ln(d1 / d2) - (d1 + d2) / 2.0 * ln(1 + d1 * @ * @ / d2))"
    return f"""full_rows AS (SELECT {by} AS seg, duration_days AS value, category AS event_type, priority, CAST(contact_count AS DOUBLE) AS x, CAST(triaged AS DOUBLE) AS z FROM closed
    WHERE duration_days IS NOT NULL AND category IS NOT NULL AND priority IS NOT NULL AND contact_count IS NOT NULL),
  kw AS (WITH {_kruskal('full_rows', 'seg').replace(', 6) AS h_stat', ', 12) AS h_stat')}),
  sa AS (SELECT seg, x, value, rk AS rx FROM ({_ranks('full_rows', 'x', 'seg')})), sb AS (SELECT seg, rx, rk AS ry FROM ({_ranks('sa', 'value', 'seg')})),
  sp AS (SELECT *, rho * sqrt((n - 2) / ((1 - rho) * (1 + rho))) AS t, CAST(n - 2 AS DOUBLE) AS df FROM (SELECT seg, count(*) AS n, corr(rx, ry) AS rho FROM sb GROUP BY 1)),
  ca AS (SELECT list(DISTINCT event_type ORDER BY event_type) AS cats FROM full_rows), pa AS (SELECT list(DISTINCT priority ORDER BY priority) AS pris FROM full_rows),
  mean AS (SELECT seg, avg(value) AS my, avg(x) AS mx FROM full_rows GROUP BY 1),
  vec AS (SELECT seg, list_concat([1.0], list_transform(cats, lambda c: CASE WHEN c = event_type THEN 1.0 ELSE 0.0 END), list_transform(pris, lambda c: CASE WHEN c = priority THEN 1.0 ELSE 0.0 END), [x - mx, z, value - my]) AS v
    FROM full_rows JOIN mean USING (seg), ca, pa),
  gram AS (SELECT seg, i, j, sum(v[i] * v[j]) AS s FROM vec, unnest(range(1, len(v) + 1)) AS a(i), unnest(range(1, len(v) + 1)) AS b(j) GROUP BY ALL),
  mrow AS (SELECT seg, i, list(s ORDER BY j) AS line FROM gram GROUP BY seg, i), mat AS (SELECT seg, list(line ORDER BY i) AS m FROM mrow GROUP BY seg),
  sweep AS (WITH RECURSIVE e AS (SELECT seg, m, list_transform(m, lambda r, i: r[i]) AS diag, 1 AS k, 0 AS rank, len(m) AS p FROM mat
    UNION ALL SELECT seg, CASE WHEN m[k][k] > 1e-9 * greatest(diag[k], 1e-300) THEN list_transform(m, lambda r, i: CASE WHEN i > k THEN list_transform(r, lambda c, j: c - r[k] * m[k][j] / m[k][k]) ELSE r END) ELSE m END,
      diag, k + 1, rank + CASE WHEN m[k][k] > 1e-9 * greatest(diag[k], 1e-300) THEN 1 ELSE 0 END, p FROM e WHERE k < p)
    SELECT seg, m[p][p] AS rss, diag[p] AS tss, rank FROM e WHERE k = p),
  fit AS (SELECT seg, CAST(rank - 1 AS DOUBLE) AS d1, CAST(n - rank AS DOUBLE) AS d2, n, CASE WHEN tss > 0 THEN 1 - rss / tss END AS r2 FROM sweep JOIN sp USING (seg)),
  ff AS (SELECT *, CASE WHEN d2 > 0 THEN 1 - (1 - r2) * (n - 1) / d2 END AS adj, CASE WHEN d1 > 0 AND d2 > 0 AND r2 < 1 THEN r2 / d1 / ((1 - r2) / d2) END AS f FROM fit),
  fp AS (SELECT *, CASE WHEN f IS NOT NULL THEN 1 - {_simpson(f_density, 'sqrt(f)')} END AS f_p FROM ff),
  gm AS (SELECT seg, event_type, avg(value) AS m FROM full_rows GROUP BY ALL),
  ends AS (SELECT seg, arg_min(event_type, (-m, event_type)) AS top, max(m) AS top_mean, arg_max(event_type, (-m, event_type)) AS low, min(m) AS low_mean FROM gm GROUP BY 1)
  SELECT {'seg AS ' + by + ', ' if by != "'all'" else ''}'Q2' AS question_id, kw.n AS n, round_even(h_stat, 3) AS h_stat, round(kwp, 6) AS kw_p, kwp < 0.05 AS kw_significant, round_even(rho, 3) AS rho, round(spp, 6) AS spearman_p,
    round_even(adj, 4) AS adj_r_squared, round(f_p, 6) AS f_pvalue, top AS top_category, round_even(top_mean, 2) AS top_category_mean, low AS bottom_category, round_even(low_mean, 2) AS bottom_category_mean,
    CASE WHEN kw.n >= 20 THEN 'PRIMARY DRIVERS' ELSE 'CANNOT ANSWER' END AS verdict, CASE WHEN kw.n >= 20 THEN 'HIGH' ELSE 'CANNOT ANSWER' END AS confidence_level
  FROM (SELECT *, CASE WHEN groups > 1 THEN {_chi2('greatest(h_stat, 0.0)', '(groups - 1)')} ELSE 1 END AS kwp FROM kw) AS kw JOIN (SELECT *, {_student('t', 'df')} AS spp FROM sp) AS sp USING (seg) JOIN fp USING (seg) JOIN ends USING (seg)"""


oracle("driver_finding", f"""{FULL}, {_drivers("'all'")}""")
oracle("driver_finding_by_agent", f"""{FULL}, {_drivers("assigned_agent")}""")
oracle("triage_crosstab", f"""{FULL} SELECT category, count(*) FILTER (NOT triaged) AS untriaged, count(*) FILTER (triaged) AS triaged FROM closed
  WHERE priority IN ('High', 'Critical') GROUP BY 1""")
oracle("triage_finding", f"""{FULL}, r AS ({_ranks("(SELECT * FROM closed WHERE priority IN ('High', 'Critical'))", 'duration_days')}),
  s AS (SELECT count(*) FILTER (triaged) AS n1, avg(duration_days) FILTER (triaged) AS m1, median(duration_days) FILTER (triaged) AS d1, stddev_samp(duration_days) FILTER (triaged) AS s1,
    count(*) FILTER (NOT triaged) AS n2, avg(duration_days) FILTER (NOT triaged) AS m2, median(duration_days) FILTER (NOT triaged) AS d2, stddev_samp(duration_days) FILTER (NOT triaged) AS s2,
    sum(rk) FILTER (triaged) AS rs FROM r)
  SELECT 'Q3' AS question_id, n1 AS triaged_n, round_even(m1, 2) AS triaged_mean, round_even(d1, 2) AS triaged_median, round_even(s1, 2) AS triaged_std,
    n2 AS untriaged_n, round_even(m2, 2) AS untriaged_mean, round_even(d2, 2) AS untriaged_median, round_even(s2, 2) AS untriaged_std,
    rs - n1 * (n1 + 1) / 2 AS mann_whitney_u, round_even((m1 - m2) / sqrt(s1 ** 2 / n1 + s2 ** 2 / n2), 3) AS welch_t_stat FROM s""")
oracle("data_health", f"""{RULED}, {CLEAN}, k AS (SELECT count(*) AS c FROM clean)
  SELECT round_even(quality_score / 100 * 21 + least(100.0, c * 100.0 / total_records) / 100 * 9, 2) AS data_health FROM score, k""")


def _card(question: str, source: str, sample: str, power: str, penalty: str, high: str = "true", medium: str = "true") -> str:
    return f"""SELECT '{question}' AS question_id, CASE WHEN dead THEN 'CANNOT ANSWER' WHEN total >= 80 AND {high} THEN 'HIGH' WHEN total >= 55 AND {medium} THEN 'MEDIUM' ELSE 'LOW' END AS overall_confidence,
    CASE WHEN dead THEN 0 ELSE total END AS confidence_score, CASE WHEN dead THEN 0 ELSE round_even(sample, 1) END AS sample_size_score, CASE WHEN dead THEN 0 ELSE round_even(data_health, 1) END AS data_quality_score,
    CASE WHEN dead THEN 0 ELSE round_even(power, 1) END AS statistical_power_score, CASE WHEN dead THEN 0 ELSE round_even(penalty, 1) END AS confounding_penalty
  FROM (SELECT *, greatest(0, least(100, round_even(sample + data_health + power - penalty, 1))) AS total FROM (
    SELECT *, confidence_level = 'CANNOT ANSWER' AS dead, CAST({sample} AS DOUBLE) AS sample, CAST({power} AS DOUBLE) AS power, CAST({penalty} AS DOUBLE) AS penalty FROM {source}, dh, ov))"""


def _scorecard() -> str:
    lost = "CASE WHEN 100 - final_records * 100.0 / raw_records > 10 THEN 5 ELSE 0 END"
    steps = lambda p, a, b, c: f"CASE WHEN {p} < 0.001 THEN {a} WHEN {p} < 0.01 THEN {b} WHEN {p} < 0.05 THEN {c} ELSE 0 END"
    parts = {"tf": "trend_finding", "tv": "trend_verdict", "dr": "driver_finding", "tr": "triage_verdict", "cx": "triage_crosstab", "dh": "data_health", "ov": "dataset_overview"}
    held = ", ".join(f"{k} AS ({ORACLES[v]})" for k, v in parts.items())
    trend = _card("Q1", "(SELECT * FROM tf JOIN tv USING (question_id))", "least(30, cohorts / 12.0 * 15 + final_records / 100.0 * 15)",
                  f"{steps('p_value', 20, 15, 10)} + CASE WHEN r_squared >= 0.2 THEN 10 WHEN r_squared >= 0.1 THEN 6 WHEN r_squared >= 0.05 THEN 3 ELSE 0 END",
                  f"CASE WHEN cohorts < 6 THEN 5 ELSE 0 END + {lost}", "p_value < 0.01", "p_value < 0.05")
    drivers = _card("Q2", "dr", "least(30, final_records / 100.0 * 30)",
                    "CASE WHEN kw_p < 0.001 AND spearman_p < 0.001 THEN 20 WHEN kw_p < 0.05 THEN 12 ELSE 0 END + CASE WHEN adj_r_squared >= 0.3 THEN 10 WHEN adj_r_squared >= 0.15 THEN 6 ELSE 0 END", "5")
    triage = _card("Q3", "tr", "least(30, (triaged_n + untriaged_n) / 40.0 * 30)", steps("mann_whitney_p", 25, 20, 12),
                   "CASE WHEN untriaged_n < 10 THEN 8 ELSE 0 END + CASE WHEN (SELECT max(category LIKE '%Hardware%') FROM cx) THEN 4 ELSE 0 END")
    return f"WITH {held} {trend} UNION ALL {drivers} UNION ALL {triage}"


# --- report tables ---------------------------------------------------------------------------
_BAND = "round(std / sqrt(count), 6) AS std_err, round(mean - std / sqrt(count), 6) AS lower, round(mean + std / sqrt(count), 6) AS upper"
oracle("monthly_trend", f"""{FULL}, m AS (SELECT intake_month, count(*) AS count, avg(duration_days) AS mean, median(duration_days) AS median, stddev_samp(duration_days) AS std FROM closed GROUP BY 1),
  i AS (SELECT *, CAST(row_number() OVER (ORDER BY intake_month) - 1 AS INT) AS month_idx FROM m), l AS (SELECT regr_slope(mean, month_idx) AS s, regr_intercept(mean, month_idx) AS b FROM i)
  SELECT intake_month, count, round(mean, 6) AS mean, round(median, 6) AS median, round(std, 6) AS std, {_BAND}, month_idx, round(s * month_idx + b, 6) AS trend_mean FROM i, l""")
oracle("category_spread", f"""{FULL}, m AS (SELECT category, count(*) AS count, avg(duration_days) AS mean, median(duration_days) AS median, stddev_samp(duration_days) AS std FROM closed GROUP BY 1)
  SELECT category, count, round(mean, 6) AS mean, round(median, 6) AS median, round(std, 6) AS std, {_BAND} FROM m""")
oracle("lifecycle_funnel", f"""{FULL}, s AS (SELECT count(*) AS raw, count(*) FILTER (quarantine_reason = '') AS kept, count(*) FILTER (first_row = row_index) AS final FROM ranked)
  SELECT CAST(step AS INT) AS step, stage, rows, round_even(rows * 100.0 / raw, 1) AS pct_of_raw FROM (
    SELECT 0 AS step, 'Raw Input' AS stage, raw AS rows, raw FROM s UNION ALL SELECT 1, 'After Quarantine', kept, raw FROM s
    UNION ALL SELECT 2, 'After Deduplication', final, raw FROM s UNION ALL SELECT 3, 'Analytical Records', final, raw FROM s)""")
oracle("dispositions", f"""{FULL}, d AS (SELECT CASE WHEN quarantine_reason <> '' THEN 'QUARANTINED' WHEN first_row = row_index THEN 'CLEAN' ELSE 'MERGED' END AS disposition, count(*) AS rows FROM ranked GROUP BY 1)
  SELECT disposition, rows, round_even(rows * 100.0 / sum(rows) OVER (), 1) AS pct FROM d""")
oracle("triage_boxes", f"{FULL}, u AS (SELECT * FROM closed WHERE priority IN ('High', 'Critical')), {_boxes('u', 'duration_days', 'triaged')}")
oracle("category_triage_means", f"""{FULL} SELECT category, round(coalesce(avg(duration_days) FILTER (NOT triaged), 0), 6) AS not_triaged,
  round(coalesce(avg(duration_days) FILTER (triaged), 0), 6) AS triaged FROM closed WHERE priority IN ('High', 'Critical') GROUP BY 1""")
oracle("dataset_overview", f"""{TRAIL}, {SUMMARY} SELECT initial_rows AS raw_records, 12 AS columns, quarantined_rows AS quarantined, deduplicated_rows AS deduplicated, final_rows AS final_records,
  round_even(final_rows * 100.0 / initial_rows, 1) AS retention_pct, round_even((initial_rows - final_rows) * 100.0 / initial_rows, 1) AS attrition_pct, modifications AS audit_entries FROM summary""")
oracle("censoring_by_month", f"""{FULL} SELECT substr(intake_date, 1, 7) AS intake_month, count(*) AS cases, count(*) FILTER (closure_date IS NULL) AS open_cases,
  round(count(*) FILTER (closure_date IS NULL) / count(*), 6) AS open_share FROM clean WHERE intake_date IS NOT NULL GROUP BY 1""")
oracle("category_mix_by_month", f"""{FULL}, c AS (SELECT intake_month, category, count(*) AS cases FROM closed GROUP BY 1, 2)
  SELECT intake_month, category, cases, round(cases / sum(cases) OVER (PARTITION BY intake_month), 6) AS share FROM c""")
oracle("sparse_cells", f"{FULL} SELECT category, priority, count(*) AS cases, count(*) < 30 AS too_small FROM closed GROUP BY 1, 2")
oracle("confidence_scorecard", _scorecard())
_PUBLISHED = [
    "quality_score", "anomaly_listing", "column_profile", "cleaning_summary", "audit_summary", "dataset_overview", "lifecycle_funnel", "dispositions", "censoring_by_month", "monthly_trend",
    "category_spread", "triage_boxes", "category_triage_means", "category_mix_by_month", "sparse_cells", "trend_finding", "driver_finding", "triage_finding", "confidence_scorecard",
]
oracle("published_reports", " UNION ALL ".join(f"SELECT '{t}' AS table_name, (SELECT count(*) FROM ({ORACLES[t]})) AS rows" for t in _PUBLISHED))
oracle("duplicate_report", f"""WITH RECURSIVE fz AS ({ORACLES['fuzzy_duplicates']}),
  ex AS (SELECT first AS index_a, p_partkey AS index_b FROM (SELECT p_partkey, min(p_partkey) OVER (PARTITION BY p_name, p_type, p_brand) AS first FROM part) WHERE p_partkey <> first),
  e AS (SELECT index_a AS a, index_b AS b FROM fz UNION SELECT index_b, index_a FROM fz UNION SELECT index_a, index_b FROM ex UNION SELECT index_b, index_a FROM ex),
  reach AS (SELECT DISTINCT a, a AS b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
  root AS (SELECT a, min(b) AS canonical FROM reach GROUP BY 1)
  SELECT (SELECT count(*) FROM part) AS total_records, (SELECT count(*) FROM ex) AS exact_duplicate_count, CAST(0 AS BIGINT) AS normalized_duplicate_count,
    (SELECT count(*) FROM fz) AS fuzzy_duplicate_count, (SELECT count(*) FROM root) AS total_unique_records_affected, (SELECT count(DISTINCT canonical) FROM root) AS clusters""")
