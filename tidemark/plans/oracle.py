"""Independent SQL (DuckDB dialect) for every registered query.

Written from the rule semantics, not from the Spark code: rule texts are
listed by hand, checks are plain SQL predicates, AND/OR verdicts are boolean
SQL over per-component counts.
"""

from __future__ import annotations

_CATALOGUE = """
cat AS (
  SELECT p_partkey AS rule_key,
    CAST(p_size % 5 AS INTEGER) AS source_system_id,
    CASE WHEN p_partkey % 3 = 0 THEN lower(p_type)
         WHEN p_partkey % 3 = 1 THEN p_type
         ELSE upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) END AS table_name,
    CASE p_partkey % 4 WHEN 0 THEN 'p_name' WHEN 1 THEN 'p_brand' WHEN 2 THEN 'p_type'
         ELSE 'p_comment' END AS field_name,
    CASE p_partkey % 8
      WHEN 0 THEN 'required'
      WHEN 4 THEN CASE WHEN p_partkey % 16 = 4 THEN 'string_format(^a and (b)$) or max_length(30)' END
      WHEN 1 THEN 'choice(''A'',''B'') or min_length(3)'
      WHEN 2 THEN 'choice(''salt and pepper'')'
      WHEN 3 THEN 'Required and max_length(20)'
      WHEN 5 THEN 'unknown_rule(3)'
      WHEN 6 THEN 'string_format(^[a-z]+ [a-z]+$) and max_length(12)'
      WHEN 7 THEN 'not_future_date or string_validation(ring)' END AS expectation,
    CASE p_size % 3 WHEN 0 THEN 'warn' WHEN 1 THEN 'drop' END AS expectation_action,
    CASE WHEN p_partkey % 7 <> 0 THEN 1 ELSE 0 END AS active
  FROM part)
"""

_ORDERS_Q = """
oq AS (
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus,
    o_totalprice, o_orderdate,
    CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS o_orderpriority
  FROM orders)
"""

_EVENTS_W = "PARTITION BY user_id ORDER BY ts ASC NULLS FIRST, event_id ASC NULLS FIRST"

_EVENTS_V = """
ev AS (SELECT event_id, user_id, ts, event_type,
  CASE WHEN event_type <> 'error' THEN value END AS v FROM events)
"""

_PROFILE_ORDER = "ORDER BY SP_EffectiveDate ASC NULLS FIRST, SP_ProfileId ASC NULLS FIRST, SP_ID ASC NULLS FIRST"


def _profile_chain(mode: str) -> str:
    """CTEs cand .. f7 of the profile selection in one look-back mode."""
    w = f"PARTITION BY AccountId {_PROFILE_ORDER}"
    if mode == "running":
        demote = f"max(CASE WHEN r1 = 1 THEN 1 END) OVER ({w} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) IS NOT NULL"
        prev_upto = f"last_value(EscheatDate IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        prev_before = f"last_value(EscheatDate IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        invalid_before = f"max(CASE WHEN vp0 = 0 THEN 1 END) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS NOT NULL"
    else:
        demote = f"lead(CASE WHEN r1 = 1 THEN 1 END, 1) OVER ({w}) IS NOT NULL"
        prev_upto = prev_before = f"lag(EscheatDate, 1) OVER ({w})"
        invalid_before = f"lag(CASE WHEN vp0 = 0 THEN TRUE END, 1) OVER ({w}) IS NOT NULL"
    return f"""
cand AS (
  SELECT o_custkey AS AccountId,
    CAST(o_orderdate AS DATE) AS SP_EffectiveDate,
    o_orderkey AS SP_ProfileId, o_orderkey AS SP_ID,
    CASE WHEN o_orderstatus = 'F' THEN 'SOLDONORAFTER' ELSE 'OTHER' END AS SP_EffectiveDateType,
    CAST(DATE '1995-06-01' + CAST(o_custkey % 2000 AS INTEGER) AS DATE) AS SoldDate,
    CASE WHEN o_custkey % 3 = 0
         THEN CAST(DATE '1997-01-01' + CAST(o_custkey % 1000 AS INTEGER) AS DATE) END AS ReplacementDate,
    CASE WHEN o_orderkey % 5 <> 0
         THEN CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) AS DATE) END AS EscheatDate
  FROM orders),
r1a AS (
  SELECT *,
    first_value(EscheatDate IGNORE NULLS) OVER ({w} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS eDateToUse,
    CASE WHEN SP_EffectiveDateType = 'SOLDONORAFTER' THEN
      CASE WHEN SP_EffectiveDate <= SoldDate
             OR (ReplacementDate IS NOT NULL AND SP_EffectiveDate <= ReplacementDate)
           THEN 1 ELSE 0 END
    END AS r1raw
  FROM cand),
r1 AS (
  SELECT * EXCLUDE (r1raw), CASE WHEN demoted THEN 0 ELSE r1raw END AS r1
  FROM (SELECT *, {demote.replace('r1 = 1', 'r1raw = 1')} AS demoted FROM r1a)),
f5a AS (
  SELECT *, row_number() OVER ({w}) AS RN FROM r1 WHERE r1 IS NULL OR r1 = 1),
f5 AS (
  SELECT * FROM f5a
  WHERE r1 = 1 OR RN = 1 OR EscheatDate IS NULL OR SP_EffectiveDate <= EscheatDate),
f6 AS (
  SELECT *,
    CASE WHEN r1 IS NOT NULL THEN r1
         WHEN RN = 1 THEN 1
         WHEN coalesce({prev_upto}, eDateToUse) IS NULL THEN NULL
         WHEN SP_EffectiveDate <= coalesce({prev_before}, EscheatDate, eDateToUse) THEN 1
         ELSE 0 END AS vp0
  FROM f5),
f7 AS (
  SELECT *, CASE WHEN {invalid_before} THEN 0 ELSE vp0 END AS vp FROM f6)
"""


def _days(col: str) -> str:
    return f"CAST(date_diff('day', DATE '1970-01-01', {col}) AS BIGINT)"


def _profile_select(mode: str) -> str:
    return f"""WITH {_profile_chain(mode)},
pick AS (
  SELECT *, row_number() OVER (PARTITION BY AccountId
    ORDER BY vp DESC NULLS LAST, SP_EffectiveDate DESC NULLS LAST,
             SP_ProfileId DESC NULLS LAST, SP_ID DESC NULLS LAST) AS rk
  FROM f7)
SELECT AccountId, SP_ID AS StateProfileId, vp AS Acct_ValidProfile,
  {_days('EscheatDate')} AS escheat_day, {_days('SP_EffectiveDate')} AS effective_day
FROM pick WHERE rk = 1"""


def _failing_single(table_sql: str, column: str, expectation: str, key: str, fail: str,
                    with_value: bool = True) -> str:
    value = f", CAST({column} AS VARCHAR) AS value" if with_value else ""
    exp = expectation.replace("'", "''")
    return (f"SELECT '{column}' AS column_name, '{exp}' AS expectation, 'warn' AS action, "
            f"{key}{value} FROM {table_sql} WHERE {fail}")


def _verdict_rows(table: str, rules: list[tuple[str, str, list[str], str]],
                  missing_of: dict[str, str]) -> str:
    """rules: (column, expectation, [component fail predicates], combine) where
    combine is a boolean SQL over c1..cn = 'component n passed'."""
    parts = []
    for col, exp, fails, combine in rules:
        counts = ", ".join(f"count(*) FILTER (WHERE {f}) AS f{i + 1}" for i, f in enumerate(fails))
        any_fail = " OR ".join(f"({f})" for f in fails)
        verdict = combine
        for i in range(len(fails), 0, -1):
            verdict = verdict.replace(f"c{i}", f"(f{i} = 0)")
        n_missing = len(fails)
        e = exp.replace("'", "''")
        parts.append(f"""SELECT '{col}' AS column_name, '{e}' AS expectation, {verdict} AS success,
  CAST({n_missing} * miss AS BIGINT) AS missing_count,
  CAST(CASE WHEN {verdict} THEN 0 ELSE anyf END AS BIGINT) AS unexpected_count
FROM (SELECT {counts}, count(*) FILTER (WHERE {any_fail}) AS anyf,
        count(*) FILTER (WHERE {missing_of[col]}) AS miss FROM {table})""")
    return "\nUNION ALL\n".join(parts)


def _row_report(sample: int | None) -> str:
    rank = ""
    limit = ""
    if sample is not None:
        rank = ", row_number() OVER (PARTITION BY expectation_type, \"column\" ORDER BY c_custkey) AS rn"
        limit = f" AND rn <= {sample}"
    return f"""WITH c AS (
  SELECT c_custkey, c_name, CASE WHEN c_custkey % 17 <> 0 THEN c_mktsegment END AS seg FROM customer),
checks AS (
  SELECT 'required' AS expectation_type, 'c_name' AS "column", c_custkey, c_name AS val, c_name IS NULL AS fail FROM c
  UNION ALL SELECT 'required', 'c_mktsegment', c_custkey, seg, seg IS NULL FROM c
  UNION ALL SELECT 'choice', 'c_mktsegment', c_custkey, seg,
    seg IS NOT NULL AND seg NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') FROM c
  UNION ALL SELECT 'string_format', 'c_name', c_custkey, c_name,
    c_name IS NOT NULL AND NOT regexp_matches(c_name, '^Customer#0000000[0-9]{{2}}$') FROM c),
agg AS (SELECT expectation_type, "column", count(*) FILTER (WHERE fail) AS n FROM checks GROUP BY 1, 2),
bad AS (SELECT *{rank} FROM checks WHERE fail)
SELECT a.expectation_type, a."column", FALSE AS status, CAST(a.n AS BIGINT) AS unexpected_count,
  CAST(b.val AS VARCHAR) AS unexpected_value, b.c_custkey
FROM agg a JOIN bad b ON a.expectation_type = b.expectation_type AND a."column" = b."column"
WHERE a.n > 0{limit}
UNION ALL
SELECT expectation_type, "column", TRUE, CAST(0 AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT)
FROM agg WHERE n = 0"""


def _win(expr: str) -> str:
    return f"WITH {_EVENTS_V} SELECT event_id, {expr} AS result FROM ev"


ORACLE_SQL: dict[str, str] = {  # *_hot keys are added below: same SQL, split plan
    "rules_lookup": f"""WITH {_CATALOGUE}
SELECT lower(table_name) AS table_name, field_name, expectation, expectation_action
FROM cat
WHERE lower(table_name) = 'economy' AND source_system_id = 2 AND active = 1
  AND expectation IS NOT NULL""",

    "rules_expand": f"""WITH {_CATALOGUE},
comp(k, component_no, operator, component, rule_name, args_text) AS (VALUES
  (0, 1, NULL, 'required', 'required', ''),
  (0, 2, 'and', 'min_length(1)', 'min_length', '1'),
  (1, 1, NULL, 'choice(''A'',''B'')', 'choice', 'A|B'),
  (1, 2, 'or', 'min_length(3)', 'min_length', '3'),
  (2, 1, NULL, 'choice(''salt and pepper'')', 'choice', 'salt and pepper'),
  (3, 1, NULL, 'Required', 'required', ''),
  (3, 2, 'and', 'min_length(1)', 'min_length', '1'),
  (3, 3, 'and', 'max_length(20)', 'max_length', '20'),
  (4, 1, NULL, 'string_format(^a and (b)$)', 'string_format', '^a and (b)$'),
  (4, 2, 'or', 'max_length(30)', 'max_length', '30'),
  (6, 1, NULL, 'string_format(^[a-z]+ [a-z]+$)', 'string_format', '^[a-z]+ [a-z]+$'),
  (6, 2, 'and', 'max_length(12)', 'max_length', '12'),
  (7, 1, NULL, 'not_future_date', 'not_future_date', ''),
  (7, 2, 'or', 'string_validation(ring)', 'string_validation', 'ring'))
SELECT cat.rule_key, CAST(comp.component_no AS INTEGER) AS component_no,
  CAST(comp.operator AS VARCHAR) AS operator, comp.component, comp.rule_name, comp.args_text
FROM cat JOIN comp ON cat.rule_key % 8 = comp.k WHERE cat.expectation IS NOT NULL""",

    "batch_rows": """SELECT event_id, user_id, row_number() OVER (ORDER BY event_id) AS RowIndex
FROM events WHERE CAST(user_id % 10 AS VARCHAR) = '3'""",

    "row_index": """SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS RowIndex
FROM orders""",

    "dq_required": f"WITH {_ORDERS_Q} " + _failing_single(
        "oq", "o_orderstatus", "required", "o_orderkey",
        "o_orderstatus IS NULL OR length(o_orderstatus) < 1"),

    "dq_choice": f"WITH {_ORDERS_Q} " + _failing_single(
        "oq", "o_orderpriority", "choice('1-URGENT','2-HIGH')", "o_orderkey",
        "o_orderpriority IS NOT NULL AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH')"),

    "dq_choice_large": """
SELECT 'text' AS action, o_orderkey, 'C' || o_custkey AS value FROM orders WHERE o_custkey % 2 <> 0 OR o_custkey >= 200000
UNION ALL
SELECT 'number', o_orderkey, CAST(o_custkey AS VARCHAR) FROM orders WHERE o_custkey % 3 <> 1 OR o_custkey >= 300000""",

    "dq_wide_rules": """
WITH v AS (
  SELECT k, 'number_range(' || k || ', 400)' AS expectation, 'warn' AS action,
    count(*) FILTER (WHERE page_id NOT BETWEEN k AND 400) AS a, 0 AS b, count(*) FILTER (WHERE page_id NOT BETWEEN k AND 400) AS c,
    count(*) FILTER (WHERE page_id IS NULL) AS missing, FALSE AS is_or
  FROM pages, range(125) r(k) GROUP BY k
  UNION ALL
  SELECT k, 'number_range(2, ' || k || ')', 'drop', count(*) FILTER (WHERE page_id NOT BETWEEN 2 AND k), 0,
    count(*) FILTER (WHERE page_id NOT BETWEEN 2 AND k), count(*) FILTER (WHERE page_id IS NULL), FALSE
  FROM pages, range(125) r(k) GROUP BY k
  UNION ALL
  SELECT k, 'min_length(' || k || ') or max_length(' || k // 2 || ')', 'warn', count(*) FILTER (WHERE length(url) < k),
    count(*) FILTER (WHERE length(url) > k // 2), count(*) FILTER (WHERE length(url) < k OR length(url) > k // 2),
    2 * count(*) FILTER (WHERE url IS NULL), TRUE
  FROM pages, range(125) r(k) GROUP BY k)
SELECT expectation, action, CASE WHEN is_or THEN a = 0 OR b = 0 ELSE a = 0 END AS success, CAST(missing AS BIGINT) AS missing_count,
  CAST(CASE WHEN a = 0 OR is_or AND b = 0 THEN 0 ELSE c END AS BIGINT) AS unexpected_count
FROM v""",

    "csv_rows": """
SELECT o_orderkey,
  CASE WHEN good THEN o_orderkey END AS key, CASE WHEN good AND o_orderstatus <> 'P' THEN o_orderstatus END AS status,
  CASE WHEN good THEN CAST(o_totalprice AS DOUBLE) END AS price,
  CASE WHEN good THEN CAST(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) END AS day,
  CASE WHEN good THEN o_orderkey % 2 = 0 END AS flag, CASE WHEN good THEN 'say "' || o_orderpriority || '", or not' END AS note,
  CASE WHEN good THEN 'int,string,double,date,boolean,string' END AS kinds,
  CASE WHEN o_orderkey % 97 = 0 THEN o_orderkey || ',' || CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus ELSE '' END
       WHEN o_orderkey % 89 = 0 THEN o_orderkey || ',F' END AS rejected
FROM (SELECT *, NOT (o_orderkey % 97 = 0 OR o_orderkey % 89 = 0) AS good FROM orders)""",

    "dq_date_format": """WITH t AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
         WHEN o_orderkey % 11 = 0 THEN strftime(o_orderdate, '%Y-%-m-%-d')
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date_text
  FROM orders) """ + _failing_single(
        "t", "order_date_text", "date_format(%Y-%m-%d)", "o_orderkey",
        "order_date_text IS NOT NULL AND try_strptime(order_date_text, '%Y-%m-%d') IS NULL"),

    "dq_time_format": """WITH t AS (
  SELECT event_id,
    CASE WHEN event_id % 11 = 0 THEN strftime(ts, '%H-%M-%S') ELSE strftime(ts, '%H:%M:%S') END
      AS event_time
  FROM events) """ + _failing_single(
        "t", "event_time", "time_format(%H:%M:%S)", "event_id",
        "event_time IS NOT NULL AND try_strptime(event_time, '%H:%M:%S') IS NULL"),

    "dq_string_format": _failing_single(
        "pages", "url", "string_format(^https://)", "page_id",
        "url IS NOT NULL AND NOT regexp_matches(url, '^https://')"),

    "dq_data_type": """
SELECT 'orders' AS table_name, 'o_totalprice' AS column_name, 'data_type(decimal)' AS expectation,
  TRUE AS success, CAST(0 AS BIGINT) AS missing_count, CAST(0 AS BIGINT) AS unexpected_count,
  count(TRY_CAST(o_totalprice AS DOUBLE)) AS conforming_count FROM orders
UNION ALL SELECT 'orders', 'o_orderkey', 'data_type(int)', FALSE, 0, 0,
  count(TRY_CAST(o_orderkey AS INTEGER)) FROM orders
UNION ALL SELECT 'orders', 'o_orderpriority', 'data_type(int)', FALSE, 0, 0,
  count(TRY_CAST(o_orderpriority AS INTEGER)) FROM orders
UNION ALL SELECT 'events', 'props_digits', 'data_type(int)', FALSE, 0, 0,
  count(TRY_CAST(regexp_replace(props, '[^0-9]', '', 'g') AS INTEGER)) FROM events""",

    "dq_number_range": _failing_single(
        "customer", "c_acctbal", "number_range(0, 5000)", "c_custkey",
        "c_acctbal IS NOT NULL AND NOT (c_acctbal BETWEEN 0 AND 5000)", with_value=False),

    "dq_between": """
SELECT 'lineitem' AS table_name, 'l_quantity' AS column_name, 'number_range(2, 6)' AS expectation,
  'warn' AS action, f = 0 AS success, CAST(m AS BIGINT) AS missing_count,
  CAST(CASE WHEN f = 0 THEN 0 ELSE f END AS BIGINT) AS unexpected_count, 'all' AS batch_id
FROM (SELECT count(*) FILTER (WHERE l_quantity IS NOT NULL AND NOT (l_quantity BETWEEN 2 AND 6)) AS f,
             count(*) FILTER (WHERE l_quantity IS NULL) AS m FROM lineitem)""",

    "dq_not_future_datetime": _failing_single(
        "events", "ts", "not_future_datetime", "event_id",
        "ts > TIMESTAMP '2024-01-15 12:00:00'", with_value=False),

    "dq_not_future_date": _failing_single(
        "orders", "o_orderdate", "not_future_date", "o_orderkey",
        "o_orderdate > TIMESTAMP '2000-01-01 00:00:00'", with_value=False),

    "dq_max_length": _failing_single(
        "documents", "text", "max_length(5000)", "doc_id", "length(text) > 5000",
        with_value=False),

    "dq_min_length": _failing_single(
        "documents", "text", "min_length(50)", "doc_id", "length(text) < 50"),

    "dq_string_validation": _failing_single(
        "part", "p_name", "string_validation(ring)", "p_partkey",
        "p_name IS NOT NULL AND NOT regexp_matches(p_name, '.*ring.*')"),

    "dq_component_summary": f"""WITH {_ORDERS_Q},
c AS (
  SELECT 'o_orderstatus' AS column_name, 'choice(''F'',''O'')' AS expectation, 1 AS component_no,
    CAST(NULL AS VARCHAR) AS operator, 'choice' AS rule_name,
    count(*) FILTER (WHERE o_orderstatus IS NULL) AS missing_count,
    count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS unexpected_count FROM oq
  UNION ALL SELECT 'o_orderpriority', 'required and max_length(6)', 1, NULL, 'required', 0,
    count(*) FILTER (WHERE o_orderpriority IS NULL) FROM oq
  UNION ALL SELECT 'o_orderpriority', 'required and max_length(6)', 2, 'and', 'min_length',
    count(*) FILTER (WHERE o_orderpriority IS NULL),
    count(*) FILTER (WHERE length(o_orderpriority) < 1) FROM oq
  UNION ALL SELECT 'o_orderpriority', 'required and max_length(6)', 3, 'and', 'max_length',
    count(*) FILTER (WHERE o_orderpriority IS NULL),
    count(*) FILTER (WHERE length(o_orderpriority) > 6) FROM oq
  UNION ALL SELECT 'o_totalprice', 'number_range(1000, 300000)', 1, NULL, 'number_range',
    count(*) FILTER (WHERE o_totalprice IS NULL),
    count(*) FILTER (WHERE NOT (o_totalprice BETWEEN 1000 AND 300000)) FROM oq
  UNION ALL SELECT 'o_orderdate', 'not_future_date', 1, NULL, 'not_future_date',
    count(*) FILTER (WHERE o_orderdate IS NULL),
    count(*) FILTER (WHERE o_orderdate > TIMESTAMP '1999-01-01 00:00:00') FROM oq)
SELECT column_name, expectation, CAST(component_no AS INTEGER) AS component_no, operator, rule_name,
  unexpected_count = 0 AS success, CAST(missing_count AS BIGINT) AS missing_count,
  CAST(unexpected_count AS BIGINT) AS unexpected_count
FROM c""",

    "dq_and": _verdict_rows("events", [
        ("event_type", "choice('view','click','purchase') and max_length(5)",
         ["event_type NOT IN ('view', 'click', 'purchase')", "length(event_type) > 5"], "c1 AND c2"),
        ("event_type", "max_length(8) and min_length(4)",
         ["length(event_type) > 8", "length(event_type) < 4"], "c1 AND c2"),
        ("value", "number_range(0, 1000) and number_range(5, 50)",
         ["NOT (value BETWEEN 0 AND 1000)", "NOT (value BETWEEN 5 AND 50)"], "c1 AND c2"),
    ], {"event_type": "event_type IS NULL", "value": "value IS NULL"}),

    "dq_or": _verdict_rows("events", [
        ("event_type", "choice('view','click') or max_length(5)",
         ["event_type NOT IN ('view', 'click')", "length(event_type) > 5"], "c1 OR c2"),
        ("event_type", "max_length(8) or choice('x')",
         ["length(event_type) > 8", "event_type NOT IN ('x')"], "c1 OR c2"),
        ("value", "number_range(0, 10) or number_range(10, 100)",
         ["NOT (value BETWEEN 0 AND 10)", "NOT (value BETWEEN 10 AND 100)"], "c1 OR c2"),
    ], {"event_type": "event_type IS NULL", "value": "value IS NULL"}),

    "dq_and_or_precedence": _verdict_rows("events", [
        ("event_type", "max_length(8) or choice('view') and min_length(9)",
         ["length(event_type) > 8", "event_type NOT IN ('view')", "length(event_type) < 9"],
         "c1 OR (c2 AND c3)"),
        ("event_type", "choice('view') and min_length(9) or max_length(8)",
         ["event_type NOT IN ('view')", "length(event_type) < 9", "length(event_type) > 8"],
         "(c1 AND c2) OR c3"),
        ("event_type", "choice('view') or max_length(8) and min_length(9)",
         ["event_type NOT IN ('view')", "length(event_type) > 8", "length(event_type) < 9"],
         "c1 OR (c2 AND c3)"),
    ], {"event_type": "event_type IS NULL"}),

    "dq_failing_rows": """WITH v AS (
  SELECT count(*) FILTER (WHERE length(text) < 50) AS t1,
         count(*) FILTER (WHERE length(text) > 5000) AS t2,
         count(*) FILTER (WHERE lang NOT IN ('en', 'de')) AS l1,
         count(*) FILTER (WHERE NOT regexp_matches(source, '^src[0-9]$')) AS s1,
         count(*) FILTER (WHERE length(source) > 5) AS s2
  FROM documents)
SELECT 'text' AS column_name, 'min_length(50) or max_length(5000)' AS expectation, 'warn' AS action,
  doc_id, text AS value FROM documents
WHERE (SELECT NOT (t1 = 0 OR t2 = 0) FROM v) AND (length(text) < 50 OR length(text) > 5000)
UNION ALL
SELECT 'lang', 'choice(''en'',''de'')', 'warn', doc_id, lang FROM documents
WHERE (SELECT l1 > 0 FROM v) AND lang NOT IN ('en', 'de')
UNION ALL
SELECT 'source', 'string_format(^src[0-9]$) and max_length(5)', 'warn', doc_id, source FROM documents
WHERE (SELECT NOT (s1 = 0 AND s2 = 0) FROM v)
  AND (NOT regexp_matches(source, '^src[0-9]$') OR length(source) > 5)""",

    "dq_report": f"""WITH {_ORDERS_Q},
a AS (SELECT
  count(*) FILTER (WHERE o_orderstatus IS NULL) AS s_null,
  count(*) FILTER (WHERE length(o_orderstatus) < 1) AS s_short,
  count(*) FILTER (WHERE length(o_orderstatus) > 1) AS s_long,
  count(*) FILTER (WHERE o_orderstatus IS NULL OR length(o_orderstatus) < 1) AS s_any,
  count(*) FILTER (WHERE o_orderpriority IS NULL) AS p_null,
  count(*) FILTER (WHERE length(o_orderpriority) < 1) AS p_short,
  count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS p_choice,
  count(*) FILTER (WHERE o_orderpriority IS NULL OR length(o_orderpriority) < 1
                   OR o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS p_any,
  count(*) FILTER (WHERE NOT (o_totalprice BETWEEN 1000 AND 400000)) AS t_out,
  count(*) FILTER (WHERE o_totalprice IS NULL) AS t_null,
  count(*) FILTER (WHERE o_orderdate > TIMESTAMP '1999-06-30 00:00:00') AS d_future,
  count(*) FILTER (WHERE o_orderdate IS NULL) AS d_null,
  count(*) FILTER (WHERE o_custkey NOT IN (1, 2, 3)) AS k_choice,
  count(*) FILTER (WHERE NOT (o_custkey BETWEEN 0 AND 1000)) AS k_range,
  count(*) FILTER (WHERE o_custkey NOT IN (1, 2, 3) OR NOT (o_custkey BETWEEN 0 AND 1000)) AS k_any,
  count(*) FILTER (WHERE o_custkey IS NULL) AS k_null
  FROM oq),
r AS (
  SELECT 'o_orderstatus' AS column_name, 'required' AS expectation, 'warn' AS action,
    s_null = 0 AND s_short = 0 AS success, s_null AS missing_count, s_any AS unexpected_count FROM a
  UNION ALL SELECT 'o_orderstatus', 'max_length(1)', NULL, s_long = 0, s_null, s_long FROM a
  UNION ALL SELECT 'o_orderpriority', 'required and choice(''1-URGENT'',''2-HIGH'',''3-MEDIUM'')',
    'warn', p_null = 0 AND p_short = 0 AND p_choice = 0, 2 * p_null, p_any FROM a
  UNION ALL SELECT 'o_totalprice', 'number_range(1000, 400000)', 'drop', t_out = 0, t_null, t_out FROM a
  UNION ALL SELECT 'o_orderdate', 'not_future_datetime', 'warn', d_future = 0, d_null, d_future FROM a
  UNION ALL SELECT 'o_custkey', 'choice(1,2,3) or number_range(0, 1000)', 'warn',
    k_choice = 0 OR k_range = 0, 2 * k_null, k_any FROM a)
SELECT 'orders' AS table_name, column_name, expectation, CAST(action AS VARCHAR) AS action, success,
  CAST(missing_count AS BIGINT) AS missing_count,
  CAST(CASE WHEN success THEN 0 ELSE unexpected_count END AS BIGINT) AS unexpected_count,
  'b-001' AS batch_id
FROM r""",

    "dq_row_report": _row_report(None),
    "dq_row_report_sample": _row_report(5),

    "win_row_number": _win(f"row_number() OVER ({_EVENTS_W})"),
    "win_first_nonnull": _win(
        f"first_value(v IGNORE NULLS) OVER ({_EVENTS_W} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"),
    "win_last_nonnull": _win(
        f"last_value(v IGNORE NULLS) OVER ({_EVENTS_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"),
    "win_prev_nonnull": _win(
        f"last_value(v IGNORE NULLS) OVER ({_EVENTS_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"),
    "win_lead": _win(f"lead(v, 1) OVER ({_EVENTS_W})"),
    "win_lag": _win(f"lag(v, 1) OVER ({_EVENTS_W})"),
    "win_future_any": _win(
        f"last_value(CASE WHEN event_type = 'purchase' THEN TRUE END IGNORE NULLS) OVER ({_EVENTS_W} "
        "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"),
    "win_future_two": _win(
        f"CASE WHEN lead(CAST(event_type = 'purchase' AS INTEGER), 1) OVER ({_EVENTS_W}) = 1 "
        f"OR lead(CAST(event_type = 'purchase' AS INTEGER), 2) OVER ({_EVENTS_W}) = 1 THEN TRUE END"),

    "profile_round1": f"""WITH {_profile_chain('running')}
SELECT AccountId, SP_ID, {_days('eDateToUse')} AS eDateToUse_day, r1 AS Acct_ValidProfile_R1 FROM r1""",
    "profile_round2": f"""WITH {_profile_chain('running')}
SELECT AccountId, SP_ID, CAST(RN AS BIGINT) AS RN, vp AS Acct_ValidProfile FROM f7""",
    "profile_select_running": _profile_select("running"),
    "profile_select_adjacent": _profile_select("adjacent"),
}


def _catalogue_report() -> str:
    """Verdicts of the catalogue's rule texts on each string column of part,
    joined to the distinct active rules of system 2 / 'economy'."""
    texts = {
        "required": (["{f} IS NULL", "length({f}) < 1"], "c1 AND c2", 1),
        "choice('A','B') or min_length(3)": (
            ["{f} NOT IN ('A', 'B')", "length({f}) < 3"], "c1 OR c2", 2),
        "choice('salt and pepper')": (["{f} <> 'salt and pepper'"], "c1", 1),
        "Required and max_length(20)": (
            ["{f} IS NULL", "length({f}) < 1", "length({f}) > 20"], "c1 AND c2 AND c3", 2),
        "string_format(^a and (b)$) or max_length(30)": (
            ["NOT regexp_matches({f}, '^a and (b)$')", "length({f}) > 30"], "c1 OR c2", 2),
        "string_format(^[a-z]+ [a-z]+$) and max_length(12)": (
            ["NOT regexp_matches({f}, '^[a-z]+ [a-z]+$')", "length({f}) > 12"], "c1 AND c2", 2),
        "not_future_date or string_validation(ring)": (
            ["{f} > '2024-01-15 00:00:00'", "NOT regexp_matches({f}, '.*ring.*')"], "c1 OR c2", 2),
    }
    blocks = []
    for f in ("p_name", "p_brand", "p_type"):
        for text, (fails, combine, missing_components) in texts.items():
            preds = [x.format(f=f) for x in fails]
            counts = ", ".join(f"count(*) FILTER (WHERE {p}) AS f{i + 1}" for i, p in enumerate(preds))
            verdict = combine
            for i in range(len(preds), 0, -1):
                verdict = verdict.replace(f"c{i}", f"(f{i} = 0)")
            anyf = " OR ".join(f"({p})" for p in preds)
            t = text.replace("'", "''")
            blocks.append(
                f"SELECT '{f}' AS field_name, '{t}' AS expectation, {verdict} AS success, "
                f"CAST({missing_components} * nulls AS BIGINT) AS missing_count, "
                f"CAST(CASE WHEN {verdict} THEN 0 ELSE anyf END AS BIGINT) AS unexpected_count "
                f"FROM (SELECT {counts}, count(*) FILTER (WHERE {anyf}) AS anyf, "
                f"count(*) FILTER (WHERE {f} IS NULL) AS nulls FROM part)")
    verdicts = "\nUNION ALL\n".join(blocks)
    return f"""WITH {_CATALOGUE},
rules AS (
  SELECT DISTINCT field_name, expectation, expectation_action FROM cat
  WHERE lower(table_name) = 'economy' AND source_system_id = 2 AND active = 1
    AND expectation IS NOT NULL),
v AS ({verdicts})
SELECT 'Economy' AS table_name, r.field_name AS column_name, r.expectation,
  r.expectation_action AS action, v.success, v.missing_count, v.unexpected_count,
  'b-cat' AS batch_id
FROM rules r JOIN v ON r.field_name = v.field_name AND r.expectation = v.expectation"""


ORACLE_SQL["dq_catalogue_report"] = _catalogue_report()

ORACLE_SQL["dq_index_list"] = f"""
SELECT column_name, expectation, FALSE AS success,
  CAST(count(*) OVER (PARTITION BY column_name, expectation) AS BIGINT) AS unexpected_count, doc_id, value
FROM ({ORACLE_SQL["dq_failing_rows"]}) fr"""

ORACLE_SQL["row_index_shuffled"] = """
SELECT count(*) AS n, count(*) AS numbers, 1::BIGINT AS first, count(*) AS last
FROM (SELECT DISTINCT l_partkey, l_suppkey, l_quantity FROM lineitem)"""

ORACLE_SQL["batch_of_view"] = """
SELECT count(*) AS n, count(*) AS numbers, 1::BIGINT AS first, count(*) AS last, sum(c)::BIGINT AS orders
FROM (SELECT o_custkey, count(*) AS c FROM orders WHERE o_orderkey % 3 = 1 GROUP BY o_custkey)"""

ORACLE_SQL["dq_long_text"] = """
SELECT 'text' AS column_name, 'string_validation(the)' AS expectation, 'warn' AS action, doc_id, text AS value
FROM documents WHERE text IS NOT NULL AND NOT contains(text, 'the')
UNION ALL SELECT 'text', 'string_validation([0-9]{3}-[0-9]{4})', 'warn', doc_id, text
FROM documents WHERE text IS NOT NULL AND NOT regexp_matches(text, '[0-9]{3}-[0-9]{4}')"""

ORACLE_SQL["dq_unevaluable"] = """
SELECT 'O_ORDERSTATUS' AS column_name, 'required and choice(''F'',''O'')' AS expectation, f = 0 AS success,
  0::BIGINT AS missing_count, f AS unexpected_count
FROM (SELECT count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS f FROM orders)
UNION ALL SELECT 'o_day', 'data_type(int)', FALSE, 0, 0
UNION ALL SELECT 'o_orderpriority', 'string_format([) or max_length(8)', f = 0, 0, f
FROM (SELECT count(*) FILTER (WHERE length(o_orderpriority) > 8) AS f FROM orders)
UNION ALL SELECT 'o_day', 'number_range(1, 2)', NULL, NULL, NULL
UNION ALL SELECT 'o_orderpriority', 'string_format([) or max_length(8)', NULL, NULL, NULL
UNION ALL SELECT 'o_orderpriority', 'date_format(%Q)', NULL, NULL, NULL
UNION ALL SELECT 'o_missing', 'required', NULL, NULL, NULL"""

for _name in [k for k in ORACLE_SQL if k.startswith("win_")] + [
        "profile_round2", "profile_select_running", "profile_select_adjacent"]:
    ORACLE_SQL[f"{_name}_hot"] = ORACLE_SQL[_name]
