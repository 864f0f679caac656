"""DuckDB SQL that recomputes each registered query independently.

Used as the second opinion by the driver's correctness check and by
``tests/test_oracle.py``. The SQL reads the same parquet views (orders,
customer, lineitem, documents, labels, events) and rebuilds the application
table itself. Doubles are rounded to 6 places, as on the Spark side.
"""

from __future__ import annotations

from readyspark import presets as P
from readyspark.sources import applications as A


def q(v) -> str:
    """SQL literal."""
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def inlist(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"


NUMBER_RE = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def strip(expr: str) -> str:
    return rf"regexp_replace(regexp_replace({expr}, '^\s+', ''), '\s+$', '')"


APP_COLS = A.APPLICATION_COLUMNS

APPS = f"""
lines AS (
  SELECT l_orderkey, count(*) AS n_lines,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned
  FROM lineitem GROUP BY l_orderkey
),
apps AS (
  SELECT o.o_orderkey AS app_id,
    CASE WHEN c.c_nationkey % 4 = 0 THEN 'no checking'
         WHEN c.c_acctbal < 1000 THEN '<0'
         WHEN c.c_acctbal < 5000 THEN '0<=X<200' ELSE '>=200' END AS checking_status,
    CAST(l.n_lines * 6 AS DOUBLE) AS duration,
    list_extract({lst(A.PRIORITY_HISTORY)}, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER)) AS credit_history,
    list_extract({lst(A.PURPOSE_BY_ORDERKEY)}, CAST(o.o_orderkey % 10 + 1 AS INTEGER)) AS purpose,
    o.o_totalprice / 20 AS credit_amount,
    list_extract({lst(A.SAVINGS_BY_CUSTKEY)}, CAST(o.o_custkey % 5 + 1 AS INTEGER)) AS savings_status,
    list_extract({lst(A.EMPLOYMENT_BY_CUSTKEY)}, CAST(o.o_custkey % 5 + 1 AS INTEGER)) AS employment,
    CAST(o.o_orderkey % 4 + 1 AS DOUBLE) AS installment_commitment,
    list_extract({lst(A.PERSONAL_BY_CUSTKEY_MOD10)}, CAST(o.o_custkey % 10 + 1 AS INTEGER)) AS personal_status,
    list_extract({lst(A.PARTIES_BY_ORDERKEY)}, CAST(o.o_orderkey % 3 + 1 AS INTEGER)) AS other_parties,
    CAST(c.c_nationkey % 4 + 1 AS DOUBLE) AS residence_since,
    CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'car' WHEN 'MACHINERY' THEN 'life insurance'
         WHEN 'HOUSEHOLD' THEN 'no known property' ELSE 'real estate' END AS property_magnitude,
    CAST(o.o_custkey % 60 + 18 AS DOUBLE) AS age,
    CASE o.o_orderstatus WHEN 'F' THEN 'bank' WHEN 'O' THEN 'none' WHEN 'P' THEN 'stores' END
      AS other_payment_plans,
    list_extract({lst(A.HOUSING_BY_CUSTKEY)}, CAST(o.o_custkey % 3 + 1 AS INTEGER)) AS housing,
    CAST(o.o_orderkey % 3 + 1 AS DOUBLE) AS existing_credits,
    list_extract({lst(A.JOB_BY_ORDERKEY)}, CAST(o.o_orderkey % 4 + 1 AS INTEGER)) AS job,
    CAST(o.o_orderkey % 2 + 1 AS DOUBLE) AS num_dependents,
    CASE WHEN o.o_orderkey % 3 = 0 THEN 'yes' ELSE 'no' END AS own_telephone,
    CASE WHEN o.o_orderkey % 2 = 0 THEN 'yes' ELSE 'no' END AS foreign_worker,
    CASE WHEN (CAST(l.n_lines >= 5 AS INTEGER) + CAST(c.c_acctbal < 1000 AS INTEGER)
               + CAST(2 * l.n_returned > l.n_lines AS INTEGER)) >= 2 THEN 'bad' ELSE 'good' END AS class
  FROM orders o
  JOIN lines l ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
)"""

_DIRTY_SELECT = ", ".join(
    {
        "duration": "CASE WHEN app_id % 89 = 0 THEN 'n/a' ELSE CAST(CAST(duration AS BIGINT) AS VARCHAR) END AS duration",
        "credit_amount": "CASE WHEN app_id % 97 <> 0 THEN credit_amount END AS credit_amount",
        "housing": "CASE WHEN app_id % 53 = 0 THEN '  ' || housing || ' ' ELSE housing END AS housing",
        "purpose": "CASE WHEN app_id % 71 = 0 THEN 'invalid' ELSE purpose END AS purpose",
        "class": "CASE WHEN app_id % 83 = 0 THEN 'unknown' ELSE class END AS class",
    }.get(c, c) for c in APP_COLS)

DIRTY = f"""{APPS},
dirty0 AS (SELECT {_DIRTY_SELECT} FROM apps),
dirty AS (SELECT * FROM dirty0 UNION ALL SELECT * FROM dirty0 WHERE app_id % 101 = 0)"""


def _num(c: str, text: bool) -> str:
    if text:
        return (f"CASE WHEN regexp_matches(CAST({c} AS VARCHAR), '{NUMBER_RE}') "
                f"THEN CASE WHEN isnan(TRY_CAST({c} AS DOUBLE)) THEN NULL ELSE TRY_CAST({c} AS DOUBLE) END END")
    return f"CASE WHEN isnan(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END"


_NOT_NULL_ALL = " AND ".join(f"{c} IS NOT NULL" for c in APP_COLS)
_CONVERT = ", ".join(
    (f"{_num(c, c == 'duration')} AS {c}" if c in P.NUMERIC_COLUMNS
     else f"{strip(f'CAST({c} AS VARCHAR)')} AS {c}" if c in P.ALLOWED_CATEGORIES else c)
    for c in APP_COLS)
_RANGES = " AND ".join(f"{c} >= {v}" for c, v in P.NUMERIC_MIN.items())
_DOMAINS = " AND ".join(f"{c} IN {inlist(v)}" for c, v in P.ALLOWED_CATEGORIES.items())

CLEAN = f"""{DIRTY},
dedup AS (SELECT DISTINCT * FROM dirty WHERE {_NOT_NULL_ALL}),
converted AS (SELECT {_CONVERT} FROM dedup),
clean AS (
  SELECT * FROM converted
  WHERE {" AND ".join(f"{c} IS NOT NULL" for c in P.NUMERIC_COLUMNS)}
    AND {_RANGES} AND {_DOMAINS} AND class IN {inlist(P.TARGET_VALUES)}
)"""

_AGE_GROUP = ("CASE WHEN age > 17 AND age <= 24 THEN '<25' WHEN age > 24 AND age <= 40 THEN '25-40' "
              "WHEN age > 40 AND age <= 60 THEN '40-60' WHEN age > 60 THEN '60+' END")
_SEX = ("CASE WHEN lower(coalesce(personal_status, 'none')) LIKE '%female%' THEN 'female' "
        "WHEN lower(coalesce(personal_status, 'none')) LIKE '%male%' THEN 'male' END")
FEATURE_EXPRS = {
    "monthly_payment": "CASE WHEN duration = 0 THEN NULL ELSE credit_amount / duration END",
    "age_group": _AGE_GROUP,
    "has_additional_security": "CAST(other_parties IS DISTINCT FROM 'none' AS INTEGER)",
    "high_risk_financial_status": (
        f"CAST(coalesce(checking_status = '<0' AND savings_status IN {inlist(P.HIGH_RISK_SAVINGS)}, false) AS INTEGER)"),
    "sex": _SEX,
}
PREP_COLS = [c for c in APP_COLS if c not in P.DELETED_ATTRIBUTES] + list(FEATURE_EXPRS)
_FEAT_SELECT = ", ".join(f"{FEATURE_EXPRS[c]} AS {c}" if c in FEATURE_EXPRS else c for c in PREP_COLS)
_PREP_SELECT = ", ".join(
    "CAST(CASE class WHEN 'good' THEN 0 WHEN 'bad' THEN 1 END AS INTEGER) AS class" if c == "class" else c
    for c in PREP_COLS)

FEATURED = f"""{CLEAN},
featured AS (SELECT {_FEAT_SELECT} FROM clean)"""

PREPARED = f"""{FEATURED},
prepared AS (SELECT {_PREP_SELECT} FROM featured)"""
PREP_DOUBLES = [c for c in P.NUMERIC_COLUMNS if c != "age"] + ["monthly_payment"]


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def rounded(cols, doubles) -> str:
    return ", ".join(r6(c) + f" AS {c}" if c in doubles else c for c in cols)


# ------------------------------------------------------------------ rule rows

def _row(gate, metric, subject, value, threshold, comparison, passed, cases="NULL", violations="NULL"):
    if comparison == "NULL" and passed is None:
        passed = "true"
    return (f"SELECT {q(gate)} AS gate, {q(metric)} AS metric, CAST({subject} AS VARCHAR) AS subject, "
            f"CAST({value} AS DOUBLE) AS value, CAST({threshold} AS DOUBLE) AS threshold, CAST({comparison} AS VARCHAR) AS comparison, "
            f"coalesce({passed}, false) AS passed, CAST({cases} AS BIGINT) AS cases, "
            f"CAST({violations} AS BIGINT) AS violations")


def rule_rows_sql(table: str, gate: str, rows: list[tuple], counters: list[str],
                  share_column: str | None, ctes: str) -> str:
    """rows: (metric, subject, value, threshold, comparison, passed, cases, violations) SQL texts
    over a one-row ``agg`` (and ``share``) relation."""
    agg = f"agg AS (SELECT count(*) AS n{''.join(', ' + c for c in counters)} FROM {table})"
    parts = [agg]
    src = "agg"
    if share_column:
        parts.append(f"cls AS (SELECT {share_column} AS k0, count(*) AS k FROM {table} "
                     f"WHERE {share_column} IS NOT NULL GROUP BY {share_column})")
        parts.append("share AS (SELECT CAST(min(k) AS DOUBLE) / sum(k) AS s, CAST(sum(k) AS BIGINT) AS total, "
                     "count(*) AS nk FROM cls)")
        src = "agg, share"
    body = "\nUNION ALL\n".join(_row(gate, *r) + f" FROM {src}" for r in rows)
    return with_(ctes + ",\n" + ",\n".join(parts), body)


def _not_null_rows(cols, mostly, doubles, start=0):
    rows, counters = [], []
    for i, c in enumerate(cols, start):
        cond = f"{c} IS NOT NULL" + (f" AND NOT isnan({c})" if c in doubles else "")
        counters.append(f"count(*) FILTER (WHERE {cond}) AS nn{i}")
        share = f"(CAST(nn{i} AS DOUBLE) / NULLIF(n, 0))"
        rows.append(("not_null", q(c), share, mostly, "'>='", f"coalesce({share} >= {mostly}, n = 0)",
                     "n", f"n - nn{i}"))
    return rows, counters


def _set_rows(specs, start=0):
    """specs: (metric, column, ok_condition)"""
    rows, counters = [], []
    for i, (metric, c, ok) in enumerate(specs, start):
        counters.append(f"count(*) FILTER (WHERE {c} IS NOT NULL) AS sc{i}")
        counters.append(f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT coalesce({ok}, false)) AS sv{i}")
        share = f"(CAST(sv{i} AS DOUBLE) / NULLIF(sc{i}, 0))"
        rows.append((metric, q(c), share, "0.0", "'<='", f"coalesce({share} <= 0.0, sc{i} = 0)",
                     f"sc{i}", f"sv{i}"))
    return rows, counters


_SHARE_ROW = ("min_class_share", "'class'", "s", P.MIN_CLASS_SHARE, "'>='",
              f"coalesce(s >= {P.MIN_CLASS_SHARE}, s IS NULL) AND coalesce(nk, 0) >= 1", "total", "NULL")


def rule_suite_raw_sql() -> str:
    dirty_doubles = [c for c in P.NUMERIC_COLUMNS if c != "duration"]
    nn_rows, nn_counters = _not_null_rows(APP_COLS, P.RAW_NOT_NULL_MOSTLY, dirty_doubles)
    rows = ([("non_empty", "'table'", "n", "0.0", "'>'", "n > 0", "n", "NULL"),
             ("row_count", "'table'", "n", P.RAW_MIN_ROWS, "'>='", f"n >= {P.RAW_MIN_ROWS}", "n", "NULL"),
             ("column_exists", "'class'", "1.0", "1.0", "'=='", "true", "NULL", "NULL")]
            + nn_rows + [_SHARE_ROW])
    return rule_rows_sql("dirty", "data_validation", rows, nn_counters, "class", DIRTY)


def rule_suite_prepared_sql() -> str:
    feats = P.EXPECTED_FEATURES
    nn_rows, nn_counters = _not_null_rows(feats, "1.0", ["monthly_payment"])
    cls_rows, cls_counters = _set_rows([("in_set", "class", "class IN (0, 1)")], start=0)
    set_rows, set_counters = _set_rows([
        ("between", "monthly_payment", "monthly_payment > 0"),
        ("in_set", "has_additional_security", "has_additional_security IN (0, 1)"),
        ("in_set", "high_risk_financial_status", "high_risk_financial_status IN (0, 1)"),
        ("in_set", "age_group", f"age_group IN {inlist(P.AGE_LABELS)}"),
    ], start=1)
    rows = ([("row_count", "'table'", "n", P.PREPARED_MIN_ROWS, "'>='", f"n >= {P.PREPARED_MIN_ROWS}", "n", "NULL"),
             ("column_exists", "'class'", "1.0", "1.0", "'=='", "true", "NULL", "NULL")]
            + cls_rows + [_SHARE_ROW]
            + [("column_exists", q(f), "1.0", "1.0", "'=='", "true", "NULL", "NULL") for f in feats]
            + nn_rows + set_rows
            + [("column_absent", q(c), "0.0", "0.0", "'=='", "true", "NULL", "NULL")
               for c in P.DELETED_ATTRIBUTES])
    return rule_rows_sql("prepared", "data_post_processing", rows, nn_counters + cls_counters + set_counters,
                         "class", PREPARED)


def clean_reason_counts_sql() -> str:
    dirty_doubles = [c for c in P.NUMERIC_COLUMNS if c != "duration"]
    has_null = " OR ".join(f"{c} IS NULL" + (f" OR isnan({c})" if c in dirty_doubles else "") for c in APP_COLS)
    nums = {c: _num(c, c == "duration") for c in P.NUMERIC_COLUMNS}
    numeric_bad = " OR ".join(f"({v}) IS NULL" for v in nums.values())
    range_ok = " AND ".join(f"coalesce(({nums[c]}) >= {v}, false)" for c, v in P.NUMERIC_MIN.items())
    dom_ok = " AND ".join(f"coalesce({strip(f'CAST({c} AS VARCHAR)')} IN {inlist(v)}, false)"
                          for c, v in P.ALLOWED_CATEGORIES.items())
    tgt_bad = f"NOT coalesce(class IN {inlist(P.TARGET_VALUES)}, false)"
    body = f"""g AS (SELECT *, count(*) AS _copies FROM dirty GROUP BY ALL),
f AS (SELECT _copies, ({has_null}) AS fn, ({numeric_bad}) AS fnum, NOT ({range_ok}) AS fr,
             NOT ({dom_ok}) AS fd, {tgt_bad} AS ft FROM g),
s AS (SELECT
  sum(_copies) AS input_rows,
  coalesce(sum(_copies) FILTER (WHERE fn), 0) AS null_rows,
  coalesce(sum(_copies - 1) FILTER (WHERE NOT fn), 0) AS duplicate_rows,
  count(*) FILTER (WHERE NOT fn AND fnum) AS non_numeric_rows,
  count(*) FILTER (WHERE NOT fn AND NOT fnum AND fr) AS out_of_range_rows,
  count(*) FILTER (WHERE NOT fn AND NOT fnum AND NOT fr AND fd) AS invalid_category_rows,
  count(*) FILTER (WHERE NOT fn AND NOT fnum AND NOT fr AND NOT fd AND ft) AS invalid_target_rows,
  count(*) FILTER (WHERE NOT fn AND NOT fnum AND NOT fr AND NOT fd AND NOT ft) AS kept_rows
  FROM f)"""
    from readyspark.operators.clean import CLEAN_REASONS
    sel = "\nUNION ALL\n".join(
        f"SELECT CAST({i} AS INTEGER) AS step, {q(name)} AS reason, CAST({name} AS BIGINT) AS rows FROM s"
        for i, name in enumerate(CLEAN_REASONS))
    return with_(DIRTY + ",\n" + body, sel)


def contract_split_sql() -> str:
    req = ["duration", "credit_amount", "housing", "class"]
    parts = [f"CASE WHEN {c} IS NULL{' OR isnan(' + c + ')' if c == 'credit_amount' else ''} THEN 'missing:{c}' END"
             for c in req]
    parts.append(f"CASE WHEN duration IS NOT NULL AND ({_num('duration', True)}) IS NULL THEN 'non_numeric:duration' END")
    parts.append(f"CASE WHEN credit_amount IS NOT NULL AND ({_num('credit_amount', False)}) IS NULL "
                 "THEN 'non_numeric:credit_amount' END")
    reasons = f"concat_ws(',', {', '.join(parts)})"
    return with_(DIRTY, f"SELECT app_id, {reasons} AS reasons, {reasons} = '' AS valid FROM dirty")


_GENDER = (f"CASE WHEN t IN {inlist(P.MALE_CODES)} THEN 'male' WHEN t IN {inlist(P.FEMALE_CODES)} THEN 'female' "
           "WHEN t LIKE '%female%' THEN 'female' WHEN t LIKE '%male%' THEN 'male' ELSE 'unknown' END")

ORACLE = {
    "clean_applications": with_(CLEAN, f"SELECT {', '.join(APP_COLS)} FROM clean"),
    "clean_reason_counts": clean_reason_counts_sql(),
    "contract_split": contract_split_sql(),
    "feature_table": with_(FEATURED, f"SELECT {', '.join(PREP_COLS)} FROM featured"),
    "gender_codes": with_(APPS, f"SELECT {_GENDER} AS gender, count(*) AS n FROM "
                                f"(SELECT lower({strip('coalesce(personal_status, ' + q('none') + ')')}) AS t FROM apps) "
                                "GROUP BY 1"),
    "target_encoding": with_(PREPARED, "SELECT app_id, class FROM prepared"),
    "rule_suite_raw": rule_suite_raw_sql(),
    "rule_suite_prepared": rule_suite_prepared_sql(),
}


# ------------------------------------------------------------------ profiling

_GENDERED = f"""{CLEAN},
gendered AS (SELECT *, {_GENDER} AS gender FROM (
  SELECT *, lower({strip("coalesce(personal_status, 'none')")}) AS t FROM clean))"""


def _quartile_sql(table, group, col):
    return (f"SELECT {group}, {r6(f'quantile_cont({col}, 0.25)')} AS q1, {r6(f'quantile_cont({col}, 0.5)')} AS median, "
            f"{r6(f'quantile_cont({col}, 0.75)')} AS q3 FROM {table} WHERE {col} IS NOT NULL GROUP BY {group}")


def _hist_sql(table, group, col, bins):
    return f"""
rng AS (SELECT {group}, CASE WHEN min({col}) = max({col}) THEN min({col}) - 0.5 ELSE min({col}) END AS lo,
               CASE WHEN min({col}) = max({col}) THEN max({col}) + 0.5 ELSE max({col}) END AS hi
        FROM {table} WHERE {col} IS NOT NULL GROUP BY {group}),
b AS (SELECT t.{group}, CAST(least(floor((CAST(t.{col} AS DOUBLE) - r.lo) * {bins} / (r.hi - r.lo)), {bins - 1}) AS INTEGER) AS bin,
             r.lo, r.hi
      FROM {table} t JOIN rng r ON t.{group} IS NOT DISTINCT FROM r.{group} WHERE t.{col} IS NOT NULL)
SELECT r.{group}, i::INTEGER AS bin, r.lo + i * ((r.hi - r.lo) / {bins}) AS lower,
       r.lo + (i + 1) * ((r.hi - r.lo) / {bins}) AS upper, count(b.bin) AS n
FROM rng r CROSS JOIN range({bins}) AS t(i) LEFT JOIN b ON b.{group} IS NOT DISTINCT FROM r.{group} AND b.bin = i
GROUP BY r.{group}, i, r.lo, r.hi"""


def _box_sql(table, group, col):
    g = group or "'all'"
    gsel = f"f.gk AS {group}, " if group else ""
    return f"""
q AS (SELECT {g} AS gk, quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.5) AS median,
              quantile_cont({col}, 0.75) AS q3 FROM {table} WHERE {col} IS NOT NULL GROUP BY {g}),
f AS (SELECT *, q1 - (q3 - q1) * 1.5 AS lf, q3 + (q3 - q1) * 1.5 AS uf FROM q)
SELECT {gsel}{r6('f.q1')} AS q1, {r6('f.median')} AS median, {r6('f.q3')} AS q3,
       {r6(f'min(t.{col}) FILTER (WHERE t.{col} >= f.lf AND t.{col} <= f.uf)')} AS whisker_low,
       {r6(f'max(t.{col}) FILTER (WHERE t.{col} >= f.lf AND t.{col} <= f.uf)')} AS whisker_high,
       count(*) FILTER (WHERE NOT (t.{col} >= f.lf AND t.{col} <= f.uf)) AS outliers, count(*) AS n
FROM {table} t JOIN f ON {g.replace(group or "#", "t." + (group or ""))} IS NOT DISTINCT FROM f.gk
WHERE t.{col} IS NOT NULL
GROUP BY f.gk, f.q1, f.median, f.q3"""


_EMP_POS = f"list_position({lst(P.EMPLOYMENT_ORDER)}, employment)"

ORACLE.update({
    "value_counts": with_(CLEAN, "SELECT purpose, count(*) AS n FROM clean WHERE purpose IS NOT NULL GROUP BY purpose"),
    "crosstab_share": with_(_GENDERED + ",\ncells AS (SELECT gender, class, count(*) AS n FROM gendered "
                            "WHERE gender IS NOT NULL AND class IS NOT NULL GROUP BY gender, class)",
                            "SELECT g.gender, c.class, coalesce(n, 0) AS n, "
                            + r6("coalesce(n, 0) / sum(n) OVER (PARTITION BY g.gender) * 100.0") + " AS share "
                            "FROM (SELECT DISTINCT gender FROM cells) g CROSS JOIN (SELECT DISTINCT class FROM cells) c "
                            "LEFT JOIN cells ON cells.gender = g.gender AND cells.class = c.class"),
    "ordered_crosstab": with_(CLEAN + f",\ncells AS (SELECT employment, CAST({_EMP_POS} AS BIGINT) AS position, class, "
                              f"count(*) AS n FROM clean WHERE {_EMP_POS} IS NOT NULL AND class IS NOT NULL "
                              "GROUP BY employment, position, class)",
                              f"SELECT o.v AS employment, o.p AS position, c.class, coalesce(n, 0) AS n, "
                              + r6("coalesce(coalesce(n, 0) / nullif(sum(n) OVER (PARTITION BY o.v), 0), 0.0)") + " AS share FROM "
                              f"(SELECT unnest({lst(P.EMPLOYMENT_ORDER)}) AS v, unnest(range(1, {len(P.EMPLOYMENT_ORDER) + 1})) AS p) o "
                              "CROSS JOIN (SELECT DISTINCT class FROM cells) c "
                              "LEFT JOIN cells ON cells.employment = o.v AND cells.class = c.class"),
    "group_describe": with_(CLEAN, f"SELECT class, count(credit_amount) AS count, {r6('avg(credit_amount)')} AS mean, "
                                   f"{r6('stddev_samp(credit_amount)')} AS std, {r6('min(credit_amount)')} AS min, "
                                   f"{r6('max(credit_amount)')} AS max, {r6('quantile_cont(credit_amount, 0.5)')} AS median "
                                   "FROM clean WHERE credit_amount IS NOT NULL GROUP BY class"),
    "group_quartiles": with_(CLEAN, _quartile_sql("clean", "class", "credit_amount")),
    "histogram": with_(CLEAN + "," + _hist_sql("clean", "class", "age", 20).split("\nSELECT")[0],
                       "SELECT" + _hist_sql("clean", "class", "age", 20).split("\nSELECT")[1]),
    "box_stats": with_(CLEAN + "," + _box_sql("clean", "class", "credit_amount").split("\nSELECT")[0],
                       "SELECT" + _box_sql("clean", "class", "credit_amount").split("\nSELECT")[1]),
    "box_stats_overall": with_(CLEAN + "," + _box_sql("clean", None, "duration").split("\nSELECT")[0],
                               "SELECT" + _box_sql("clean", None, "duration").split("\nSELECT")[1]),
    "sorted_classes": with_(CLEAN, "SELECT DISTINCT class FROM clean WHERE class IS NOT NULL"),
    "event_quartiles": _quartile_sql("events", "event_type", "value"),
    "event_histogram": with_(_hist_sql("events", "event_type", "value", 30).split("\nSELECT")[0],
                             "SELECT" + _hist_sql("events", "event_type", "value", 30).split("\nSELECT")[1]),
})


# ------------------------------------------------------------------ split, metrics, gates

from readyspark.operators.score import CREDIT_SCORECARD  # noqa: E402


def md5_hash(*parts) -> str:
    text = " || '|' || ".join(parts)
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)"


SPLIT = f"""{PREPARED},
hashed AS (SELECT *, {md5_hash("CAST(app_id AS VARCHAR)", q(str(P.SEED)))} AS h FROM prepared),
cnt AS (SELECT class, count(*) AS nc FROM hashed GROUP BY class),
tot AS (SELECT sum(nc) AS n, CAST(ceil(CAST({P.TEST_SIZE} AS DOUBLE) * sum(nc)) AS BIGINT) AS nt FROM cnt),
raw AS (SELECT c.class, CAST(t.nt * c.nc AS DOUBLE) / t.n AS r, t.nt FROM cnt c, tot t),
fl AS (SELECT *, floor(r) AS f FROM raw),
rk AS (SELECT *, row_number() OVER (ORDER BY r - f DESC, class) AS rr, nt - sum(f) OVER () AS lft FROM fl),
quota AS (SELECT class, CAST(f + CASE WHEN rr <= lft THEN 1 ELSE 0 END AS BIGINT) AS qn FROM rk),
ranked AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY h, app_id) - 1 AS rnk FROM hashed),
split AS (SELECT r.* EXCLUDE (rnk, h), CASE WHEN r.rnk < qu.qn THEN 'test' ELSE 'train' END AS split
          FROM ranked r JOIN quota qu ON r.class = qu.class),
test AS (SELECT * EXCLUDE (split) FROM split WHERE split = 'test'),
train AS (SELECT * EXCLUDE (split) FROM split WHERE split = 'train')"""


def scorecard_sql(card=CREDIT_SCORECARD, cols=None) -> str:
    cols = cols or {}
    c = lambda name: cols.get(name, name)
    expr = f"CAST({card.intercept!r} AS DOUBLE)"
    for t in card.terms:
        if t.equals is None:
            expr = f"({expr} + CAST({t.weight!r} AS DOUBLE) * CAST({c(t.column)} AS DOUBLE))"
        else:
            expr = (f"({expr} + CASE WHEN coalesce({c(t.column)} = {q(t.equals)}, false) "
                    f"THEN CAST({t.weight!r} AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)")
    return f"least(CAST(1.0 AS DOUBLE), greatest(CAST(0.0 AS DOUBLE), {expr}))"


SCORED = f"""{SPLIT},
scored AS (SELECT *, {scorecard_sql()} AS p_bad FROM test),
scored2 AS (SELECT *, CAST(p_bad >= {CREDIT_SCORECARD.cutoff} AS INTEGER) AS prediction FROM scored)"""


def zdiv(a, b) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), CAST(0.0 AS DOUBLE))"


_CONF = ("count(*) FILTER (WHERE class = 0 AND prediction = 0) AS tn, "
         "count(*) FILTER (WHERE class = 0 AND prediction = 1) AS fp, "
         "count(*) FILTER (WHERE class = 1 AND prediction = 0) AS fn, "
         "count(*) FILTER (WHERE class = 1 AND prediction = 1) AS tp, count(*) AS samples")

_MCC = ("CASE WHEN sqrt(CAST(tp + fp AS DOUBLE) * CAST(tp + fn AS DOUBLE) * CAST(tn + fp AS DOUBLE) * CAST(tn + fn AS DOUBLE)) > 0 "
        "THEN (CAST(tp AS DOUBLE) * CAST(tn AS DOUBLE) - CAST(fp AS DOUBLE) * CAST(fn AS DOUBLE)) / "
        "sqrt(CAST(tp + fp AS DOUBLE) * CAST(tp + fn AS DOUBLE) * CAST(tn + fp AS DOUBLE) * CAST(tn + fn AS DOUBLE)) "
        "ELSE CAST(0.0 AS DOUBLE) END")

_RATES = {
    "accuracy": zdiv("tp + tn", "tn + fp + fn + tp"),
    "precision": zdiv("tp", "tp + fp"),
    "recall": zdiv("tp", "tp + fn"),
    "f1": zdiv("2 * tp", "2 * tp + fp + fn"),
    "mcc": _MCC,
}

METRICS_CTE = f"""{SCORED},
conf AS (SELECT {_CONF} FROM scored2),
ps AS (SELECT p_bad AS s, count(*) FILTER (WHERE class = 1) AS pos, count(*) FILTER (WHERE class = 0) AS neg
       FROM scored2 GROUP BY p_bad),
psr AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef FROM ps),
auc AS (SELECT CAST(sum(pos * (2 * bef + neg)) AS DOUBLE) / NULLIF(CAST(2 * sum(pos) * sum(neg) AS DOUBLE), 0) AS roc_auc FROM psr),
metrics AS (
  {" UNION ALL ".join(f"SELECT {q(m)} AS metric, {e} AS value FROM conf" for m, e in _RATES.items())}
  UNION ALL SELECT 'roc_auc' AS metric, roc_auc AS value FROM auc),
trc AS (SELECT class, count(*) AS ntr FROM train GROUP BY class),
tec AS (SELECT class, count(*) AS nte FROM test GROUP BY class),
both_ AS (SELECT coalesce(a.class, b.class) AS class, a.ntr, b.nte FROM trc a FULL JOIN tec b ON a.class = b.class),
baseline AS (SELECT class AS majority_class, {zdiv("coalesce(nte, 0)", "tot")} AS baseline_accuracy FROM (
   SELECT *, row_number() OVER (ORDER BY ntr DESC NULLS LAST, class) AS r, sum(coalesce(nte, 0)) OVER () AS tot FROM both_)
   WHERE r = 1)"""

_GR = f"""rates AS (SELECT sex, samples, tn, fp, fn, tp, {zdiv("fp", "fp + tn")} AS false_positive_rate,
      {zdiv("fn", "fn + tp")} AS false_negative_rate, {zdiv("tp", "tp + fn")} AS true_positive_rate
   FROM (SELECT sex, {_CONF} FROM scored2 GROUP BY sex))"""

_FAIR_ROWS = f"""gap AS (SELECT
    abs(max(false_positive_rate) FILTER (WHERE sex = 'male') - max(false_positive_rate) FILTER (WHERE sex = 'female')) AS fpr_d,
    abs(max(false_negative_rate) FILTER (WHERE sex = 'male') - max(false_negative_rate) FILTER (WHERE sex = 'female')) AS fnr_d
    FROM rates),
fairness AS (
  {" UNION ALL ".join(_row("fairness", m, "sex", m, "NULL", "NULL", "true", "samples") + " FROM rates"
                      for m in ("false_positive_rate", "false_negative_rate", "true_positive_rate"))}
  UNION ALL {_row("fairness", "fpr_difference", "NULL", "fpr_d", "NULL", "NULL", None)} FROM gap
  UNION ALL {_row("fairness", "fnr_difference", "NULL", "fnr_d", "NULL", "NULL", None)} FROM gap
  UNION ALL {_row("fairness", "separation_difference", "NULL", "(fpr_d + fnr_d) / 2", P.FAIRNESS_THRESHOLD, "'<='",
                  f"(fpr_d + fnr_d) / 2 <= {P.FAIRNESS_THRESHOLD}")} FROM gap)"""

_PERF = f"""limits AS ({" UNION ALL ".join(f"SELECT {q(m)} AS metric, CAST({t!r} AS DOUBLE) AS threshold"
                                          for m, t in P.PERFORMANCE_THRESHOLDS.items())}
   UNION ALL SELECT 'accuracy' AS metric, baseline_accuracy AS threshold FROM baseline),
performance AS (SELECT 'performance' AS gate, m.metric, CAST(NULL AS VARCHAR) AS subject, m.value, l.threshold,
   '>' AS comparison, coalesce(m.value > l.threshold, false) AS passed, CAST(NULL AS BIGINT) AS cases,
   CAST(NULL AS BIGINT) AS violations FROM metrics m LEFT JOIN limits l ON m.metric = l.metric)"""


def _u(name):
    return f"CAST({md5_hash('CAST(app_id AS VARCHAR)', q(name), q(str(P.SEED)))} AS DOUBLE) / CAST(4294967296.0 AS DOUBLE)"


_LOW, _SPAN = P.PERTURB_LOW, P.PERTURB_HIGH - P.PERTURB_LOW
_PD = f"greatest(round_even(duration * (CAST({_LOW!r} AS DOUBLE) + CAST({_SPAN!r} AS DOUBLE) * {_u('duration')}), 0), CAST(0.0 AS DOUBLE))"
_PA = f"greatest(credit_amount * (CAST({_LOW!r} AS DOUBLE) + CAST({_SPAN!r} AS DOUBLE) * {_u('credit_amount')}), CAST(0.0 AS DOUBLE))"
_CHK = "CASE checking_status " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in P.CHECKING_IMPROVEMENT.items()) + " ELSE checking_status END"
_SAV = "CASE savings_status " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in P.SAVINGS_DETERIORATION.items()) + " ELSE savings_status END"


def _pay(a, d):
    return f"CASE WHEN ({d}) = 0 THEN NULL ELSE ({a}) / ({d}) END"


VARIANTS = f"""{METRICS_CTE},
v_pert AS (SELECT * REPLACE ({_PD} AS duration, {_PA} AS credit_amount) FROM test),
v_pert2 AS (SELECT * REPLACE (greatest({_pay("credit_amount", "duration")}, CAST(0.0 AS DOUBLE)) AS monthly_payment) FROM v_pert),
v_infl AS (SELECT * REPLACE (credit_amount * CAST({P.INFLATION_FACTOR!r} AS DOUBLE) AS credit_amount) FROM test),
v_infl2 AS (SELECT * REPLACE ({_pay("credit_amount", "duration")} AS monthly_payment) FROM v_infl),
v_dur AS (SELECT * REPLACE (duration + {P.DURATION_INCREASE_MONTHS} AS duration) FROM test),
v_dur2 AS (SELECT * REPLACE ({_pay("credit_amount", "duration")} AS monthly_payment) FROM v_dur),
v_chk AS (SELECT *, coalesce(checking_status IN {inlist(P.CHECKING_MOVABLE)}, false) AS mask FROM test),
v_chk2 AS (SELECT * REPLACE ({_CHK} AS checking_status) FROM v_chk),
v_sav AS (SELECT *, coalesce(savings_status IN {inlist(P.SAVINGS_MOVABLE)}, false) AS mask FROM test),
v_sav2 AS (SELECT * REPLACE ({_SAV} AS savings_status) FROM v_sav),
vs AS (
  SELECT 'perturbation' AS variant, true AS mask, app_id, class, {scorecard_sql()} AS p_bad FROM v_pert2
  UNION ALL SELECT 'inflation', true, app_id, class, {scorecard_sql()} FROM v_infl2
  UNION ALL SELECT 'duration_increase', true, app_id, class, {scorecard_sql()} FROM v_dur2
  UNION ALL SELECT 'checking_status_improvement', mask, app_id, class, {scorecard_sql()} FROM v_chk2
  UNION ALL SELECT 'savings_status_deterioration', mask, app_id, class, {scorecard_sql()} FROM v_sav2),
vsp AS (SELECT v.*, CAST(v.p_bad >= {CREDIT_SCORECARD.cutoff} AS INTEGER) AS prediction, b.p_bad AS p_base,
        b.prediction AS pred_base FROM vs v JOIN scored2 b ON v.app_id = b.app_id),
f1p AS (SELECT
   {", ".join(f"count(*) FILTER (WHERE variant = '{vv}' AND class = 1 AND {pc} = 1) AS tp_{n}, "
              f"count(*) FILTER (WHERE variant = '{vv}' AND class = 0 AND {pc} = 1) AS fp_{n}, "
              f"count(*) FILTER (WHERE variant = '{vv}' AND class = 1 AND {pc} = 0) AS fn_{n}"
              for n, vv, pc in (("clean", "perturbation", "pred_base"), ("perturbation", "perturbation", "prediction"),
                                ("inflation", "inflation", "prediction")))}
   FROM vsp),
f1v AS (SELECT {", ".join(f"{zdiv(f'2 * tp_{n}', f'2 * tp_{n} + fp_{n} + fn_{n}')} AS f1_{n}"
                          for n in ("clean", "perturbation", "inflation"))} FROM f1p),
rob AS (SELECT *, f1_perturbation / NULLIF(f1_clean, 0) AS r_p, f1_inflation / NULLIF(f1_clean, 0) AS r_i FROM f1v),
robustness AS (
  {" UNION ALL ".join(_row("robustness", m, "NULL", e, "NULL", "NULL", None) + " FROM rob"
                      for m, e in (("f1_clean", "f1_clean"), ("f1_perturbation", "f1_perturbation"),
                                   ("f1_inflation", "f1_inflation"), ("robustness_perturbation", "r_p"),
                                   ("robustness_inflation", "r_i")))}
  UNION ALL {_row("robustness", "mean_robustness_score", "NULL", "(r_p + r_i) / 2", P.ROBUSTNESS_THRESHOLD, "'>='",
                  f"(r_p + r_i) / 2 >= {P.ROBUSTNESS_THRESHOLD}")} FROM rob),
mm AS (SELECT variant, count(*) FILTER (WHERE mask) AS cases,
          count(*) FILTER (WHERE mask AND ((variant IN ('duration_increase', 'savings_status_deterioration') AND p_bad < p_base)
                                          OR (variant = 'checking_status_improvement' AND p_bad > p_base))) AS viol
       FROM vsp WHERE variant NOT IN ('perturbation', 'inflation') GROUP BY variant),
metamorphic AS (SELECT 'metamorphic' AS gate, 'violation_rate' AS metric, variant AS subject,
   {zdiv("viol", "cases")} AS value, CAST({P.MAX_VIOLATION_RATE} AS DOUBLE) AS threshold, '<=' AS comparison,
   coalesce({zdiv("viol", "cases")} <= {P.MAX_VIOLATION_RATE}, false) AS passed, CAST(cases AS BIGINT) AS cases,
   CAST(viol AS BIGINT) AS violations FROM mm)"""

_VAR_OUT = {
    "perturbed_rows": ("v_pert2", "app_id, duration, credit_amount, monthly_payment"),
    "inflated_rows": ("v_infl2", "app_id, credit_amount, monthly_payment"),
    "duration_shift": ("v_dur2", "app_id, duration, monthly_payment"),
    "checking_shift": ("v_chk2", "app_id, checking_status, mask"),
    "savings_shift": ("v_sav2", "app_id, savings_status, mask"),
}

ORACLE.update({
    "exact_split": with_(SPLIT, "SELECT app_id, class, split FROM split"),
    "split_summary": with_(SPLIT, "SELECT split, class, count(*) AS n FROM split GROUP BY split, class"),
    "stratified_folds": with_(SPLIT, f"""SELECT app_id, class, CAST((row_number() OVER (PARTITION BY class ORDER BY
        {md5_hash("CAST(app_id AS VARCHAR)", "'fold'", q(str(P.SEED)))}, app_id) - 1) % {P.N_FOLDS} AS INTEGER) AS fold FROM train"""),
    "majority_baseline": with_(METRICS_CTE, "SELECT majority_class, baseline_accuracy FROM baseline"),
    "class_weights": with_(SPLIT, """SELECT class, n_c, CAST(sum(n_c) OVER () AS DOUBLE) / (count(*) OVER () * n_c) AS weight
        FROM (SELECT class, count(*) AS n_c FROM train GROUP BY class)"""),
    "confusion": with_(SCORED, f"SELECT {_CONF} FROM scored2"),
    "classification_metrics": with_(METRICS_CTE, "SELECT metric, value FROM metrics"),
    "roc_auc": with_(METRICS_CTE, "SELECT roc_auc FROM auc"),
    "group_rates": with_(METRICS_CTE + ",\n" + _GR, "SELECT * FROM rates"),
    "separation_gap": with_(METRICS_CTE + ",\n" + _GR + ",\n" + _FAIR_ROWS, "SELECT * FROM fairness"),
    "performance_gate": with_(METRICS_CTE + ",\n" + _PERF, "SELECT * FROM performance"),
    "scorecard_scoring": with_(PREPARED + f",\ns AS (SELECT app_id, {scorecard_sql()} AS p_bad FROM prepared)",
        f"""SELECT app_id, p_bad, CAST(p_bad >= {CREDIT_SCORECARD.cutoff} AS INTEGER) AS prediction,
        CASE WHEN p_bad >= {CREDIT_SCORECARD.cutoff} THEN 'bad' ELSE 'good' END AS prediction_label,
        1.0 - p_bad AS probability_good, p_bad AS probability_bad FROM s"""),
    **{name: with_(VARIANTS, f"SELECT {cols} FROM {t}") for name, (t, cols) in _VAR_OUT.items()},
    "robustness_gate": with_(VARIANTS, "SELECT * FROM robustness"),
    "metamorphic_gate": with_(VARIANTS, "SELECT * FROM metamorphic"),
})


_MODEL_GATES = with_(VARIANTS + ",\n" + _GR + ",\n" + _FAIR_ROWS + ",\n" + _PERF,
                     "SELECT * FROM performance UNION ALL SELECT * FROM fairness "
                     "UNION ALL SELECT * FROM robustness UNION ALL SELECT * FROM metamorphic")
GATE_REPORT = (f"SELECT * FROM ({rule_suite_raw_sql()}) UNION ALL SELECT * FROM ({rule_suite_prepared_sql()}) "
               f"UNION ALL SELECT * FROM ({_MODEL_GATES})")

ORACLE.update({
    "gate_report": GATE_REPORT,
    "gate_overview": f"SELECT gate, bool_and(passed) AS gate_passed, count(*) AS checks FROM ({GATE_REPORT}) GROUP BY gate",
    "readiness_verdict": (f"SELECT coalesce(bool_and(passed), false) AS production_ready, "
                          f"count(*) FILTER (WHERE NOT passed) AS failed_checks FROM ({GATE_REPORT})"),
    "document_group_rates": f"""WITH j AS (SELECT d.doc_id, d.lang, d.n_chars, l.quality,
        CAST(d.n_chars >= 2000 AS INTEGER) AS prediction FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
      c AS (SELECT lang, count(*) FILTER (WHERE quality = 0 AND prediction = 0) AS tn,
        count(*) FILTER (WHERE quality = 0 AND prediction = 1) AS fp,
        count(*) FILTER (WHERE quality = 1 AND prediction = 0) AS fn,
        count(*) FILTER (WHERE quality = 1 AND prediction = 1) AS tp, count(*) AS samples FROM j GROUP BY lang)
      SELECT lang, samples, tn, fp, fn, tp, {zdiv("fp", "fp + tn")} AS false_positive_rate,
        {zdiv("fn", "fn + tp")} AS false_negative_rate, {zdiv("tp", "tp + fn")} AS true_positive_rate FROM c""",
    "document_class_balance": rule_rows_sql(
        "j", "document_labels",
        [("row_count", "'table'", "n", "1", "'>='", "n >= 1", "n", "NULL"),
         ("in_set", "'quality'", "(CAST(sv0 AS DOUBLE) / NULLIF(sc0, 0))", "0.0", "'<='",
          "coalesce((CAST(sv0 AS DOUBLE) / NULLIF(sc0, 0)) <= 0.0, sc0 = 0)", "sc0", "sv0"),
         ("min_class_share", "'quality'", "s", P.MIN_CLASS_SHARE, "'>='",
          f"coalesce(s >= {P.MIN_CLASS_SHARE}, s IS NULL) AND coalesce(nk, 0) >= 1", "total", "NULL")],
        ["count(*) FILTER (WHERE quality IS NOT NULL) AS sc0",
         "count(*) FILTER (WHERE quality IS NOT NULL AND NOT coalesce(quality IN (0, 1), false)) AS sv0"],
        "quality",
        "j AS (SELECT d.doc_id, d.lang, d.n_chars, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"),
})


def _onehot_sql():
    cats = {c: sorted(P.AGE_LABELS if c == "age_group" else P.ALLOWED_CATEGORIES[c]) for c in P.NOMINAL_FEATURES}
    cols = ["app_id"] + [f"CAST(coalesce({c} = {q(v)}, false) AS INTEGER) AS {c}__{i}"
                         for c, vals in cats.items() for i, v in enumerate(vals)]
    return with_(SPLIT, f"SELECT {', '.join(cols)} FROM test")


ORACLE.update({
    "ordinal_encoding": with_(PREPARED, ", ".join([
        "SELECT app_id",
        f"CAST(coalesce(list_position({lst(P.EMPLOYMENT_ORDER)}, employment), 0) - 1 AS DOUBLE) AS employment_code",
        f"CAST(coalesce(list_position({lst(P.JOB_ORDER)}, job), 0) - 1 AS DOUBLE) AS job_code"]) + " FROM prepared"),
    "onehot_wide": _onehot_sql(),
    "onehot_slots": """WITH f AS (SELECT CAST(o_custkey AS VARCHAR) AS customer, o_orderpriority FROM orders WHERE o_orderstatus = 'F'),
        c AS (SELECT customer, row_number() OVER (ORDER BY customer) - 1 AS i FROM (SELECT DISTINCT customer FROM f WHERE customer IS NOT NULL)),
        p AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS i
              FROM (SELECT DISTINCT o_orderpriority FROM f WHERE o_orderpriority IS NOT NULL)),
        n AS (SELECT (SELECT count(*) FROM c) AS nc, (SELECT count(*) FROM p) AS np)
        SELECT o_orderkey, CAST(c.i AS INTEGER) AS customer_slot, CAST(n.nc + p.i AS INTEGER) AS priority_slot,
               CAST(n.nc + n.np AS INTEGER) AS slots
        FROM orders LEFT JOIN c ON CAST(o_custkey AS VARCHAR) = c.customer LEFT JOIN p USING (o_orderpriority), n""",
    "class_balance": rule_rows_sql("prepared", "class_balance", [_SHARE_ROW], [], "class", PREPARED),
})


# ------------------------------------------------------------------ shape summary, stream scoring

_SPARK_TYPE = ("CASE {t} WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
               "WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' ELSE lower({t}) END")


def _shape_sql():
    cols = " UNION ALL ".join(
        f"SELECT 'column' AS kind, {q(c)} AS name, {_SPARK_TYPE.format(t=f'typeof(any_value({c}))')} AS type, "
        f"count(*) AS rows FROM dirty" for c in APP_COLS)
    target = ("SELECT 'target_value' AS kind, CAST(class AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS type, "
              "count(*) AS rows FROM dirty WHERE class IS NOT NULL GROUP BY class")
    return with_(DIRTY, f"{cols} UNION ALL {target}")


def _stream_sql():
    doubles = [c for c in P.NUMERIC_COLUMNS if c != "duration"]
    required = list(P.NUMERIC_COLUMNS) + list(P.ALLOWED_CATEGORIES)
    ok = [f"{c} IS NOT NULL" + (f" AND NOT isnan({c})" if c in doubles else "") for c in required]
    ok.append(f"({_num('duration', True)}) IS NOT NULL")
    feats = {
        "duration": "CAST(duration AS DOUBLE)",
        "high_risk_financial_status": FEATURE_EXPRS["high_risk_financial_status"],
    }
    p = scorecard_sql(cols=feats)
    cut = CREDIT_SCORECARD.cutoff
    return with_(DIRTY + f",\nv AS (SELECT * FROM dirty WHERE {' AND '.join(ok)}),\ns AS (SELECT app_id, {p} AS p_bad FROM v)",
                 f"SELECT app_id, p_bad, CAST(p_bad >= {cut} AS INTEGER) AS prediction, "
                 f"CASE WHEN p_bad >= {cut} THEN 'bad' ELSE 'good' END AS prediction_label, "
                 "1.0 - p_bad AS probability_good, p_bad AS probability_bad FROM s")


ORACLE.update({"shape_summary": _shape_sql(), "stream_scores": _stream_sql(),
               "stream_published": f"""SELECT app_id, (CASE WHEN app_id % 2 = 0 THEN 1 ELSE 2 END)::BIGINT AS model_version,
                   true AS same_probability FROM ({_stream_sql()})"""})


def _ordered_crosstabs_sql():
    from readyspark.plans.queries import ORDERED_PROFILES
    parts = []
    for feature, order in ORDERED_PROFILES:
        pos = f"list_position({lst([float(v) for v in order] if not isinstance(order[0], str) else order)}, {feature})"
        cat = f"CAST({feature} AS VARCHAR)" if isinstance(order[0], str) else f"CAST(CAST({feature} AS BIGINT) AS VARCHAR)"
        parts.append(f"""SELECT {q(feature)} AS feature, {cat} AS category, CAST({pos} AS BIGINT) AS position, class,
            count(*) AS n FROM clean WHERE {pos} IS NOT NULL AND class IS NOT NULL GROUP BY ALL""")
    cells = " UNION ALL ".join(parts)
    declared = ", ".join(f"({q(f)}, {q(v if isinstance(v, str) else str(int(v)))}, {i})"
                         for f, order in ORDERED_PROFILES for i, v in enumerate(order, 1))
    share = r6("coalesce(coalesce(n, 0) / nullif(sum(n) OVER (PARTITION BY o.feature, o.category), 0), 0.0)")
    return with_(CLEAN + f",\ncells AS ({cells}),\no(feature, category, position) AS (VALUES {declared})",
                 f"SELECT o.feature, o.category, o.position::BIGINT AS position, c.class, coalesce(n, 0) AS n, {share} AS share "
                 "FROM o CROSS JOIN (SELECT DISTINCT class FROM cells) c "
                 "LEFT JOIN cells ON cells.feature = o.feature AND cells.category = o.category AND cells.class = c.class")


ORACLE["ordered_crosstabs"] = _ordered_crosstabs_sql()


# ------------------------------------------------------------------ sinks, alignment, learning facts

def _rejected_sql():
    """Rows that fail the contract, with the reasons of the contract query and their columns as they came."""
    doubles = [c for c in P.NUMERIC_COLUMNS if c != "duration"]
    required = list(P.NUMERIC_COLUMNS) + list(P.ALLOWED_CATEGORIES)
    checks = [f"CASE WHEN {c} IS NULL" + (f" OR isnan({c})" if c in doubles else "") + f" THEN 'missing:{c}' END" for c in required]
    checks.append(f"CASE WHEN duration IS NOT NULL AND ({_num('duration', True)}) IS NULL THEN 'non_numeric:duration' END")
    return with_(DIRTY, "SELECT * FROM (SELECT app_id, duration, credit_amount, housing, "
                        f"array_to_string([x FOR x IN [{', '.join(checks)}] IF x IS NOT NULL], ',') AS reasons FROM dirty) "
                        "WHERE reasons <> ''")


_HISTORY_PARAMS = [("n_estimators", 100.0, "100"), ("max_depth", None, "None"), ("min_samples_split", 2.0, "2"),
                   ("min_samples_leaf", 1.0, "1"), ("max_features", None, "sqrt"), ("bootstrap", None, "True")]
_PARAM_ROWS = " UNION ALL ".join(
    f"SELECT 'run-1' AS run_id, 'param' AS kind, {q(n)} AS name, CAST({'NULL' if v is None else v} AS DOUBLE) AS value, {q(t)} AS text"
    for n, v, t in _HISTORY_PARAMS)
_NUMERIC_PREPARED = [c for c in PREP_COLS if c in list(P.NUMERIC_COLUMNS) + ["monthly_payment", "has_additional_security",
                                                                        "high_risk_financial_status"]
                     and c not in P.DELETED_ATTRIBUTES]

ORACLE.update({
    "stream_rejected": _rejected_sql(),
    "parquet_round_trip": ORACLE["clean_applications"],
    "csv_round_trip": ORACLE["clean_applications"],
    "report_round_trip": ORACLE["rule_suite_raw"],
    "history_round_trip": with_(METRICS_CTE, "SELECT run_id, 'metric' AS kind, metric AS name, value, CAST(NULL AS VARCHAR) AS text "
                                f"FROM metrics CROSS JOIN (VALUES ('run-1'), ('run-2')) t(run_id) UNION ALL {_PARAM_ROWS}"),
    "published_scores": with_(SCORED, "SELECT app_id, class, p_bad, prediction FROM scored2"),
    "refused_publication": with_(SCORED, "SELECT app_id, true AS refused FROM scored2"),
    "aligned_rates": ORACLE["group_rates"],
    "crosstab_wide": with_(_GENDERED, "SELECT gender, " + ", ".join(
        r6(f"count(*) FILTER (WHERE class = {q(v)}) / count(*) FILTER (WHERE class IN {inlist(P.TARGET_VALUES)})") + f" AS {v}"
        for v in P.TARGET_VALUES) + " FROM gendered WHERE gender IS NOT NULL GROUP BY gender"),
    "weighted_rows": with_(SPLIT, "SELECT app_id, class, CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY class)) "
                                  "AS weight FROM split WHERE split = 'train'"),
    "numeric_column_counts": with_(PREPARED, " UNION ALL ".join(
        f"SELECT {q(c)} AS name, count({c}) AS filled FROM prepared" for c in _NUMERIC_PREPARED)),
    # the query checks the run's own scores; what it must find is known beforehand
    "forest_walk": with_(SPLIT, "SELECT app_id, class, true AS same_probability, true AS same_label, true AS above_majority FROM test"),
    "search_scores": """SELECT candidate::INTEGER AS candidate, max_depth, true AS same_accuracy, true AS same_precision, true AS same_recall,
        true AS same_f1, true AS same_mcc, true AS same_roc_auc, true AS same_rank FROM (VALUES (0, '3'), (1, '5')) v(candidate, max_depth)""",
    "forest_gates": """SELECT gate, metric, subject, true AS same_value, true AS same_verdict FROM (
        SELECT 'performance' AS gate, unnest(['accuracy', 'precision', 'recall', 'f1', 'mcc', 'roc_auc']) AS metric, '' AS subject
        UNION ALL SELECT 'fairness', metric, subject FROM (VALUES ('female'), ('male')) s(subject),
          (VALUES ('false_positive_rate'), ('false_negative_rate'), ('true_positive_rate')) m(metric)
        UNION ALL SELECT 'fairness', unnest(['fpr_difference', 'fnr_difference', 'separation_difference']), ''
        UNION ALL SELECT 'robustness', unnest(['f1_clean', 'f1_perturbation', 'f1_inflation', 'robustness_perturbation',
          'robustness_inflation', 'mean_robustness_score']), ''
        UNION ALL SELECT 'metamorphic', 'violation_rate',
          unnest(['duration_increase', 'checking_status_improvement', 'savings_status_deterioration']))""",
    "forest_score_facts": with_(SPLIT, "SELECT app_id, class, true AS in_range, true AS is_cut FROM test"),
})
