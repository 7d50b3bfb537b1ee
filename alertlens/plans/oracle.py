"""DuckDB twins of the registered queries (the correctness gate).

Each string is self-contained SQL over the pre-registered views (``events`` here).  They
are written independently of the Spark plans: the effective preference, for example, is the
plain many-to-many join + sort + keep-first, which the Spark side
never forms.  Labels and constants come from ``functions.constants``, the same source the
Spark expressions use.
"""

from __future__ import annotations

import datetime as dt

from alertlens.functions import constants as C
from alertlens.functions.calendar import reporting_window
from alertlens.options import RECORD, Options
from alertlens.plans import queries as Q

DAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")


def _s(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _d(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def next_day(expr: str, day: str) -> str:
    iso = DAYS.index(day) + 1
    return f"(({expr}) + CAST(((({iso}) - isodow({expr}) + 6) % 7) + 1 AS INTEGER))"


def snap(expr: str, week_start: str = "TUE") -> str:
    z = DAYS[(DAYS.index(week_start) - 1) % 7]
    return next_day(f"CAST({expr} AS DATE) - 1", z)


K = "json_extract_string(props, '$.k')"
USER = "CASE WHEN event_id % 40 IN (7, 17, 27) THEN NULL ELSE CAST(user_id AS VARCHAR) END"
CUST = f"lpad({USER}, 9, '0')"
EID = "CAST(event_id AS VARCHAR)"
WEEKLY_ID = f"{USER} || '-' || strftime(date_trunc('week', ts), '%Y%m%d')"
YMD = "strftime(ts, '%Y%m%d')"

def dec_cte(where: str = "") -> str:
    return f"""dec AS (
  SELECT {_s(C.ACTIVITY_DECISION)} AS event_activity_type, {EID} AS source_event_id, {YMD} AS partition_date,
         ts AS process_ts, ts AS source_event_ts, {EID} AS event_id, ts AS event_ts,
         {USER} AS account_id, {_s(C.ALERT_TYPE)} AS alert_type,
         TRY_CAST({K} AS DECIMAL(12,2)) AS threshold_amount, {CUST} AS customer_id,
         'CAD' AS account_currency, CAST(NULL AS DECIMAL(12,2)) AS credit_limit,
         CAST(NULL AS VARCHAR) AS masked_account, {WEEKLY_ID} AS decision_id,
         TRY_CAST(value AS DECIMAL(12,2)) AS alert_amount
  FROM events WHERE event_type = 'purchase' {where})"""


DEC = dec_cte()


def _pref_select(activity: str, partition: str) -> str:
    return f"""SELECT ts AS envelope_ts_p, 'ONLINE' AS event_channel_type_p, {_s(activity)} AS event_activity_type_p,
         {partition} AS partition_date_p, ts AS process_ts_p, ts AS source_event_ts_p, ts AS event_ts_p,
         {_s(activity)} AS event_activity_name_p, {_s(C.ALERT_TYPE)} AS preference_type_p, {CUST} AS client_id_p,
         CASE WHEN CAST({K} AS INTEGER) % 2 = 0 THEN 'true' ELSE 'false' END AS is_business_p,
         'true' AS send_alert_eligible_p, 'true' AS active_p, {K} AS threshold_p, {CUST} AS cust_id_p,
         {USER} AS account_p, CAST(NULL AS VARCHAR) AS masked_account_no_p, {USER} AS external_account_p,
         {_s(C.PRODUCT_TYPE)} AS product_type_p, {EID} AS source_event_id_p
  FROM events"""


def pref_cte(inc_where: str = "") -> str:
    return f"""pref_ini AS (
  {_pref_select(C.ACTIVITY_PREF_CREATE, _s(C.INITIAL_LOAD_PARTITION))} WHERE event_type = 'signup'),
pref_inc AS (
  {_pref_select(C.ACTIVITY_PREF_UPDATE, YMD)} WHERE event_type = 'click' {inc_where}),
pref AS (SELECT * FROM pref_ini UNION ALL SELECT * FROM pref_inc)"""


PREF = pref_cte()

def deliv_cte(where: str = "") -> str:
    return f"""deliv AS (
  SELECT ts AS process_ts_a, {_s(C.ACTIVITY_DELIVERY)} AS event_activity_type_a, {EID} AS source_event_id_a,
         {YMD} AS partition_date_a, ts AS envelope_ts_a, {EID} AS event_id_a, ts AS event_ts_a,
         {_s(C.ACTIVITY_DELIVERY)} AS event_activity_name_a, 'true' AS alert_sent_a, 'true' AS send_inbox_a,
         {_s(C.ALERT_TYPE)} AS alert_type_a, TRY_CAST({K} AS DECIMAL(12,2)) AS threshold_amount_a,
         'false' AS send_sms_a, 'true' AS send_push_a, CAST(NULL AS VARCHAR) AS masked_account_a,
         CAST(NULL AS VARCHAR) AS reason_code_a, {WEEKLY_ID} AS decision_id_a,
         TRY_CAST(value AS DECIMAL(12,2)) AS alert_amount_a, {USER} AS account_id_a, {USER} AS account_a,
         {_s(C.PRODUCT_TYPE)} AS account_product_a, 'false' AS send_email_a
  FROM (SELECT * REPLACE (CASE WHEN event_id % 40 = 3 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) ELSE ts END AS ts)
        FROM events WHERE event_type = 'view') v WHERE true {where})"""


DELIV = deliv_cte()

D1 = """d1 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY decision_id ORDER BY event_ts ASC NULLS FIRST,
           account_id ASC NULLS FIRST, customer_id ASC NULLS FIRST, source_event_id ASC NULLS FIRST) AS rn
    FROM dec) WHERE rn = 1)"""

# the plain form: fan-out join, flag, sort, keep first
DP = """dp_all AS (
  SELECT d.*, p.*,
         CASE WHEN d.event_ts > p.event_ts_p OR (p.event_ts_p IS NULL AND d.event_ts IS NOT NULL)
              THEN 'Y' ELSE 'N' END AS dec_tm_ge_pref_tm
  FROM d1 d LEFT JOIN pref p
    ON d.account_id IS NOT DISTINCT FROM p.external_account_p AND d.customer_id IS NOT DISTINCT FROM p.cust_id_p),
dp AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY decision_id ORDER BY dec_tm_ge_pref_tm DESC,
           event_ts_p DESC NULLS LAST, source_event_id_p ASC NULLS FIRST) AS rn
    FROM dp_all) WHERE rn = 1)"""

A1 = """a1 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY decision_id_a ORDER BY event_ts_a DESC NULLS LAST,
           source_event_id_a ASC NULLS FIRST) AS rn
    FROM deliv) WHERE rn = 1)"""

J = """j AS (SELECT * FROM dp LEFT JOIN a1 ON dp.decision_id IS NOT DISTINCT FROM a1.decision_id_a)"""


def bucket_case(x: str, zero_negative: bool = False) -> str:
    neg = f"{x} <= 0" if zero_negative else f"{x} < 0"
    parts = [f"WHEN {x} IS NULL THEN {_s(C.MISSING_BUCKET)}", f"WHEN {neg} THEN {_s(C.NEGATIVE_BUCKET)}"]
    parts += [f"WHEN {x} <= {b} THEN {_s(label)}" for label, b in C.LATENCY_BUCKETS]
    return "CASE " + " ".join(parts) + f" ELSE {_s(C.OVERFLOW_BUCKET)} END"


LAT = "(CAST(epoch_us(event_ts_a) - epoch_us(event_ts) AS DOUBLE) / CAST(1000000 AS DOUBLE))"

def fin_cte(nulls_low: bool = True, zero_negative: bool = False) -> str:
    thr = ("alert_amount < threshold_amount OR (alert_amount IS NULL AND threshold_amount IS NOT NULL)"
           if nulls_low else "alert_amount < threshold_amount")
    return f"""fin0 AS (
  SELECT *, CAST(source_event_ts AS DATE) AS src_event_date, CAST(process_ts AS DATE) AS process_date,
         CAST(event_ts AS DATE) AS event_date, CAST(event_ts AS DATE) AS decision_date,
         CASE WHEN {thr} THEN 'Y' ELSE 'N' END AS threshold_limit_check,
         CASE WHEN event_ts_a IS NULL OR event_ts IS NULL THEN 'Y' ELSE 'N' END AS found_missing,
         {LAT} AS time_diff
  FROM j WHERE NOT (coalesce(lower(is_business_p) = 'true', false) AND coalesce(dec_tm_ge_pref_tm = 'Y', false))),
fin AS (
  SELECT *, CASE WHEN time_diff <= {C.SLA_SECONDS} THEN 'Y' ELSE 'N' END AS sla_ind,
         {bucket_case('time_diff', zero_negative)} AS alert_time
  FROM fin0)"""


FIN = fin_cte()

PIPE = ",\n".join([DEC, PREF, DELIV, D1, DP, A1, J, FIN])


DP_STRICT = DP.replace("d.account_id IS NOT DISTINCT FROM p.external_account_p AND d.customer_id IS NOT DISTINCT FROM p.cust_id_p",
                       "d.account_id = p.external_account_p AND d.customer_id = p.cust_id_p")
J_STRICT = J.replace("dp.decision_id IS NOT DISTINCT FROM a1.decision_id_a", "dp.decision_id = a1.decision_id_a")


def strict_pipe(w) -> str:
    """Strict preset: half-open window [start, end + 1 day), incremental preferences up to the
    window end (half-open), deliveries after the window start, NULL keys never match."""
    start = f"TIMESTAMP '{w.start_ts.isoformat(sep=' ')}'"
    end = f"TIMESTAMP '{w.end_bound.isoformat(sep=' ')}'"
    return ",\n".join([
        dec_cte(f"AND strftime(ts, '%Y%m%d') > '{w.partition_cutoff}' AND ts >= {start} AND ts < {end}"),
        pref_cte(f"AND ts < {end}"),
        deliv_cte(f"AND ts > {start}"),
        D1, DP_STRICT, A1, J_STRICT, FIN])


# the ports' preset: comparisons with a missing operand are false, nulls last in every sort,
# a latency of exactly 0 s in the negative bucket
D1_PORT = D1.replace("ASC NULLS FIRST", "ASC NULLS LAST")
DP_PORT = DP.replace("CASE WHEN d.event_ts > p.event_ts_p OR (p.event_ts_p IS NULL AND d.event_ts IS NOT NULL)",
                     "CASE WHEN d.event_ts > p.event_ts_p").replace("ASC NULLS FIRST", "ASC NULLS LAST")
A1_PORT = A1.replace("ASC NULLS FIRST", "ASC NULLS LAST")
PIPE_PORT = ",\n".join([DEC, PREF, DELIV, D1_PORT, DP_PORT, A1_PORT, J, fin_cte(False, True)])


def _t(ts: dt.datetime) -> str:
    return f"TIMESTAMP '{ts.isoformat(sep=' ')}'"


def third_pipe(w) -> str:
    """The third preset: header times, half-open window for decisions and deliveries, deliveries
    with an id only; comparisons and orders as the ports'."""
    inside = f"ts >= {_t(w.start_ts)} AND ts < {_t(w.end_bound)}"
    return ",\n".join([
        dec_cte(f"AND strftime(ts, '%Y%m%d') > '{w.partition_cutoff}' AND {inside}"),
        pref_cte(f"AND ts > {_t(w.end_bound)}"),
        deliv_cte(f"AND {inside} AND {WEEKLY_ID} IS NOT NULL"),
        D1_PORT, DP_PORT, A1_PORT, J, fin_cte(False, True)])


W3 = reporting_window(Q.REPORT_DT, Q.FIX_THIRD)


def windowed_pipe(w) -> str:
    """The weekly run's feeds (record preset): decisions in [start, end + 1 day] with the
    partition cutoff, incremental preferences after the window end, deliveries after the
    window start (envelope time = ts in the fixture)."""
    start = f"TIMESTAMP '{w.start_ts.isoformat(sep=' ')}'"
    end = f"TIMESTAMP '{w.end_bound.isoformat(sep=' ')}'"
    return ",\n".join([
        dec_cte(f"AND strftime(ts, '%Y%m%d') > '{w.partition_cutoff}' AND ts BETWEEN {start} AND {end}"),
        pref_cte(f"AND ts > {end}"),
        deliv_cte(f"AND ts > {start}"),
        D1, DP, A1, J, FIN])


def sample_cte(name: str, src: str, n: int = 10, seed: int = 42) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY decision_date ORDER BY md5('{seed}|' || decision_id) ASC NULLS FIRST,
           decision_id ASC NULLS FIRST) AS rn
    FROM {src}) WHERE rn <= {n})"""


def control_sql(control: str, src: str, report_dt: dt.date, opts: Options = RECORD) -> str:
    names = {"accuracy": C.CONTROL_ACCURACY, "timeliness": C.CONTROL_TIMELINESS, "completeness": C.CONTROL_COMPLETENESS}
    risk, test = names[control]
    rde = opts.control_ids[list(names).index(control)]
    good, bad = opts.pass_code, opts.fail_code
    if control == "completeness":
        good, bad = opts.completeness_pass_code or good, opts.completeness_fail_code or bad
    snapshot = _d(report_dt) if opts.snap_from_report else snap("decision_date", opts.week_start)
    passed = {"accuracy": "threshold_limit_check = 'Y'", "timeliness": "sla_ind = 'Y'",
              "completeness": "coalesce(trim(decision_id_a), '') <> ''"}[control]
    monthly = control == "completeness" and opts.completeness_segment == "month"
    seg = "strftime(decision_date, '%Y%m')" if monthly else "strftime(decision_date, '%Y%m%d')"
    return f"""SELECT {_s(risk)} AS ControlRisk, {_s(test)} AS TestType, {_s(rde)} AS RDE,
         CASE WHEN coalesce({passed}, false) THEN {_s(good)} ELSE {_s(bad)} END AS CommentCode,
         {seg} AS Segment10, {_d(report_dt)} AS DateCompleted, {snapshot} AS SnapDate,
         count(*) AS Volume, CAST(sum(alert_amount) AS DECIMAL(22,2)) AS Bal,
         CAST(sum(threshold_amount) AS DECIMAL(22,2)) AS Amount
  FROM {src} GROUP BY ALL"""


def comments_case(col: str = "CommentCode") -> str:
    whens = " ".join(f"WHEN {_s(k)} THEN {_s(v)}" for k, v in C.DEFAULT_COMMENTS.items())
    return f"CASE {col} {whens} END"


def scorecard_sql(final_src: str, sample_src: str, report_dt: dt.date, opts: Options = RECORD) -> str:
    u = " UNION ALL ".join([
        "(" + control_sql("accuracy", sample_src, report_dt, opts) + ")",
        "(" + control_sql("timeliness", final_src, report_dt, opts) + ")",
        "(" + control_sql("completeness", final_src, report_dt, opts) + ")",
    ])
    pad = ", ".join(f"'.' AS Segment{i}" for i in range(2, 10))
    return f"""SELECT {_s(opts.regulatory_name)} AS RegulatoryName, {_s(opts.lob)} AS LOB, {_s(opts.report_name)} AS ReportName,
       ControlRisk, TestType, {_s(C.TEST_PERIOD)} AS TestPeriod, {_s(C.PRODUCT_TYPE_LABEL)} AS ProductType, RDE,
       '.' AS SubDE, '.' AS Segment, {pad}, Segment10, 'N' AS HoldoutFlag, CommentCode,
       {comments_case()} AS Comments, Volume, Bal, Amount, DateCompleted, SnapDate
FROM ({u}) u"""


def with_pipe(body: str, extra: str = "") -> str:
    ctes = PIPE + (",\n" + extra if extra else "")
    return f"WITH {ctes}\n{body}"


def cumulative(agg: str, part: str, order: str) -> str:
    p = f"PARTITION BY {part}" if part else ""
    return f"""SELECT *, row_number() OVER ({p} ORDER BY {order}) AS position, CAST(frequency AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(sum(frequency) OVER ({p}) AS DOUBLE) AS percent,
       CAST(sum(frequency) OVER ({p} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
         AS cum_frequency,
       CAST(sum(frequency) OVER ({p} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
         * CAST(100 AS DOUBLE) / CAST(sum(frequency) OVER ({p}) AS DOUBLE) AS cum_percent
FROM ({agg}) a"""


def oneway_sql(src: str, cols, labels=None) -> str:
    labels = labels or {}
    parts = []
    for c in cols:
        lv = labels.get(c, f"CAST({c} AS VARCHAR)")
        parts.append(f"SELECT {_s(c)} AS variable, {lv} AS level, count(*) AS frequency FROM {src} GROUP BY ALL")
    agg = " UNION ALL ".join(parts)
    return cumulative(agg, "variable", "level ASC NULLS FIRST")


def crosstab_sql(src: str, cols) -> str:
    agg = f"SELECT {', '.join(cols)}, count(*) AS frequency FROM {src} GROUP BY ALL"
    return cumulative(agg, "", ", ".join(f"{c} ASC NULLS FIRST" for c in cols))


RD = Q.REPORT_DT
W = Q.WINDOW
BLANK = "CASE WHEN coalesce(trim(decision_id_a), '') = '' THEN 'Blank' ELSE 'Not Blank' END"
MASK = "'******' || substr(customer_id, 7, 3)"
MASK_PORT = "'******' || right(customer_id, 3)"


def _head(src_date: str = "decision_date") -> str:
    return f"""strftime({src_date}, '%Y%m') AS event_month, {_d(RD)} AS reporting_date,
       {snap(src_date)} AS event_week_ending, {_s(RECORD.lob)} AS LOB, {_s(C.PRODUCT_TYPE_LABEL)} AS Product,
       account_id AS account_number"""


AMOUNTS = "threshold_amount AS thresholdamount, alert_amount AS available_credit, decision_id AS decisionid, decision_date AS event_date"
TS_TEXT = """CASE event_type WHEN 'purchase' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')
       WHEN 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
       WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
       WHEN 'signup' THEN strftime(ts, '%Y-%m-%d')
       ELSE 'ts-' || CAST(event_id AS VARCHAR) END"""
NUM_TEXT = f"""CASE event_type WHEN 'purchase' THEN {K} WHEN 'view' THEN {K} || '.5'
       WHEN 'click' THEN '9999999999' || {K} WHEN 'signup' THEN '-' || {K} || '.25' ELSE 'n/a' END"""
KEY_TEXT = "CASE event_type WHEN 'error' THEN '   ' WHEN 'click' THEN '' ELSE CAST(user_id AS VARCHAR) END"
ENV_START = f"TIMESTAMP '{W.start_ts.isoformat(sep=' ')}'"
ENV_END = f"TIMESTAMP '{W.end_bound.isoformat(sep=' ')}'"


def _window_cols(r: str, week_start: str, sfx: str) -> str:
    n = DAYS[(DAYS.index(week_start) + 1) % 7]
    end = f"({next_day(r, n)} - 9)"
    start = f"CASE WHEN {end} < DATE '2022-07-25' THEN DATE '2022-06-30' ELSE {end} - 6 END"
    out = f"{start} AS week_start{sfx}, {end} AS week_end{sfx}"
    if not sfx:
        out += f", strftime({start} - 7, '%Y%m%d') AS partition_cutoff"
    return out


FINAL_SEL = ", ".join(Q.FINAL_COLUMNS)

ORACLE = {
    "extract_envelope": f"WITH {DEC} SELECT * FROM dec",
    "json_scalars": f"WITH {DELIV} SELECT * FROM deliv",
    "scan_decisions": f"""WITH {DEC} SELECT decision_id, source_event_id, partition_date, event_ts, account_id,
       customer_id, alert_amount, threshold_amount FROM dec
       WHERE partition_date > '{W.partition_cutoff}' AND event_ts BETWEEN {ENV_START} AND {ENV_END}""",
    "scan_preferences": f"""WITH {PREF} SELECT DISTINCT source_event_id_p, event_activity_type_p, event_ts_p,
       external_account_p, cust_id_p, is_business_p, threshold_p FROM (
       SELECT * FROM pref_ini UNION SELECT * FROM pref_inc WHERE envelope_ts_p > {ENV_END}) x""",
    "scan_deliveries": f"""WITH {DELIV} SELECT source_event_id_a, decision_id_a, event_ts_a, alert_amount_a,
       threshold_amount_a FROM deliv WHERE envelope_ts_a > {ENV_START}""",
    "union_preferences": f"WITH {PREF} SELECT * FROM pref_ini UNION SELECT * FROM pref_inc",
    "partition_cutoff": f"""WITH {DEC} SELECT source_event_id, partition_date,
       CAST(try_strptime(partition_date, '%Y%m%d') AS DATE) AS partition_day FROM dec
       WHERE partition_date > '{W.partition_cutoff}'""",
    "safe_timestamp": f"""SELECT event_id, ts_text, TRY_CAST(regexp_replace(ts_text, 'Z$', '') AS TIMESTAMP) AS parsed_ts
       FROM (SELECT event_id, {TS_TEXT} AS ts_text FROM events) t""",
    "safe_decimal": f"""SELECT event_id, num_text, TRY_CAST(num_text AS DECIMAL(12,2)) AS amount
       FROM (SELECT event_id, {NUM_TEXT} AS num_text FROM events) t""",
    "blank_keys": f"""SELECT event_id, raw_key, CASE WHEN trim(raw_key) = '' THEN NULL ELSE raw_key END AS clean_key
       FROM (SELECT event_id, {KEY_TEXT} AS raw_key FROM events) t""",
    "resolve_keys": f"""WITH {DELIV} SELECT source_event_id_a,
       CASE WHEN trim(decision_id_a) = '' THEN NULL ELSE decision_id_a END AS decision_key, event_ts_a AS sent_ts FROM deliv""",
    "exclude_business": with_pipe("""SELECT decision_id, source_event_id, is_business_p, dec_tm_ge_pref_tm FROM j
       WHERE NOT (coalesce(lower(is_business_p) = 'true', false) AND coalesce(dec_tm_ge_pref_tm = 'Y', false))"""),
    "date_parts": with_pipe("SELECT decision_id, src_event_date, process_date, event_date, decision_date FROM fin"),
    "threshold_check": f"""WITH {DEC} SELECT source_event_id, alert_amount, threshold_amount,
       CASE WHEN alert_amount < threshold_amount OR (alert_amount IS NULL AND threshold_amount IS NOT NULL)
            THEN 'Y' ELSE 'N' END AS threshold_limit_check,
       CASE WHEN coalesce(alert_amount < threshold_amount, false) THEN 'Y' ELSE 'N' END AS threshold_check_port
       FROM dec""",
    "found_missing": with_pipe("SELECT decision_id, CASE WHEN event_ts_a IS NULL OR event_ts IS NULL THEN 'Y' ELSE 'N' END AS found_missing FROM j"),
    "latency": with_pipe(f"SELECT decision_id, event_ts, event_ts_a, {LAT} AS time_diff FROM j"),
    "sla_flag": with_pipe(f"""SELECT decision_id, time_diff, CASE WHEN time_diff <= {C.SLA_SECONDS} THEN 'Y' ELSE 'N' END AS sla_ind
       FROM (SELECT decision_id, {LAT} AS time_diff FROM j) t"""),
    "latency_bucket": with_pipe(f"""SELECT decision_id, time_diff, {bucket_case('time_diff')} AS alert_time,
       {bucket_case('time_diff', True)} AS alert_time_port FROM (SELECT decision_id, {LAT} AS time_diff FROM j) t"""),
    "mask_id": f"""WITH {DEC} SELECT customer_id, {MASK} AS custid_mask, {MASK_PORT} AS custid_mask_port
       FROM (SELECT DISTINCT customer_id FROM dec) t""",
    "snap_date": f"""WITH {DEC} SELECT decision_date, {snap('decision_date')} AS snap_date,
       {snap('decision_date', 'THU')} AS snap_date_port FROM (SELECT DISTINCT CAST(event_ts AS DATE) AS decision_date FROM dec) t""",
    "reporting_window": f"""SELECT report_dt, {_window_cols('report_dt', 'TUE', '')}, {_window_cols('report_dt', 'THU', '_port')}
       FROM (SELECT DISTINCT CAST(ts AS DATE) AS report_dt FROM events) t""",
    "effective_preference": f"""WITH {DEC}, {PREF}, {D1}, {DP}
       SELECT decision_id, source_event_id, source_event_id_p, event_ts_p, is_business_p, dec_tm_ge_pref_tm FROM dp""",
    "preference_fanout_size": f"""WITH {DEC}, {PREF}
       SELECT d.account_id, d.customer_id, count(DISTINCT d.source_event_id) AS decisions,
              count(DISTINCT p.source_event_id_p) AS preferences, count(*) AS fanout_rows
       FROM dec d LEFT JOIN pref p ON d.account_id IS NOT DISTINCT FROM p.external_account_p
            AND d.customer_id IS NOT DISTINCT FROM p.cust_id_p
       GROUP BY d.account_id, d.customer_id""",
    "join_deliveries": f"""WITH {DEC}, {DELIV}, {D1}, {A1}
       SELECT decision_id, source_event_id, decision_id_a, source_event_id_a, event_ts_a
       FROM d1 LEFT JOIN a1 ON d1.decision_id IS NOT DISTINCT FROM a1.decision_id_a""",
    "dedup_first": f"WITH {DEC}, {D1} SELECT decision_id, source_event_id, event_ts, alert_amount FROM d1",
    "dedup_rejects": f"""WITH {DEC}, {D1} SELECT decision_id, source_event_id, event_ts FROM dec
       WHERE source_event_id NOT IN (SELECT source_event_id FROM d1)""",
    "delivery_rejects": f"""WITH {DELIV}, {A1} SELECT decision_id_a, source_event_id_a, event_ts_a FROM deliv
       WHERE source_event_id_a NOT IN (SELECT source_event_id_a FROM a1)""",
    "dedup_latest": f"WITH {DELIV}, {A1} SELECT decision_id_a, source_event_id_a, event_ts_a FROM a1",
    "stratified_sample": with_pipe("SELECT decision_date, decision_id, threshold_limit_check FROM samp",
                                   sample_cte("samp", "fin")),
    "latency_counts": with_pipe("SELECT alert_time, count(*) AS decision_count FROM fin GROUP BY alert_time"),
    "totals": with_pipe("SELECT count(*) AS total_records, count(DISTINCT decision_id) AS total_distinct_decision_id FROM fin"),
    "control_accuracy": with_pipe(control_sql("accuracy", "samp", RD), sample_cte("samp", "fin")),
    "control_timeliness": with_pipe(control_sql("timeliness", "fin", RD)),
    "control_completeness": with_pipe(control_sql("completeness", "fin", RD)),
    "code_comment": with_pipe(f"""SELECT ControlRisk, Segment10, SnapDate, CommentCode, {comments_case()} AS Comments, Volume
       FROM (({control_sql('timeliness', 'fin', RD)}) UNION ALL ({control_sql('completeness', 'fin', RD)})) u"""),
    "scorecard": with_pipe(scorecard_sql("fin", "samp", RD), sample_cte("samp", "fin")),
    "freq_oneway": with_pipe(oneway_sql("fin", Q.ONEWAY_COLUMNS, {"decision_id_a": BLANK})),
    "freq_decision_ids": f"WITH {DEC}\n{oneway_sql('dec', ('decision_id', 'source_event_id'))}",
    "summary_order": with_pipe(" UNION ALL ".join(
        f"(SELECT *, row_number() OVER (ORDER BY {', '.join(f'{c} ASC NULLS FIRST' for c in Q.A.SUMMARY_ORDER)}) AS position"
        f" FROM ({control_sql(k, src, RD)}) x)" for k, src in (("accuracy", "samp"), ("timeliness", "fin"), ("completeness", "fin"))),
        sample_cte("samp", "fin")),
    "freq_flags": with_pipe(oneway_sql("j", ("dec_tm_ge_pref_tm", "is_business_p"))),
    "freq_crosstab": with_pipe(crosstab_sql("j", ("dec_tm_ge_pref_tm", "is_business_p"))),
    "freq_crosstab7": with_pipe(crosstab_sql("fin", Q.CROSSTAB7)),
    "fail_completeness": with_pipe(f"""SELECT {_head()}, {AMOUNTS}, {MASK} AS custid_mask FROM fin
       WHERE coalesce(trim(decision_id_a), '') = ''"""),
    "fail_timeliness": with_pipe(f"""SELECT {_head()}, {AMOUNTS}, event_ts AS eventTimestamp, event_ts_a AS sent_timestamp,
       CAST(ceil(time_diff / 60.0) AS BIGINT) AS total_minutes, {MASK} AS custid_mask FROM fin
       WHERE coalesce(sla_ind, '') <> 'Y'"""),
    "fail_accuracy": with_pipe(f"""SELECT {_head()}, {_s(C.ACCURACY_DECISION_LABEL)} AS decision, {AMOUNTS},
       {MASK} AS custid_mask FROM samp WHERE coalesce(threshold_limit_check, '') <> 'Y'""", sample_cte("samp", "fin")),
    "history_replace": with_pipe(
        """SELECT * FROM new_week UNION ALL
       SELECT * FROM hist h WHERE NOT EXISTS (SELECT 1 FROM new_week n WHERE n.SnapDate IS NOT DISTINCT FROM h.SnapDate)""",
        ",\n".join([
            sample_cte("samp", "fin"),
            f"hist AS ({scorecard_sql('fin', 'samp', Q.HISTORY_DT)})",
            f"wk AS (SELECT * FROM fin WHERE decision_date BETWEEN {_d(W.start)} AND {_d(W.end)})",
            sample_cte("samp_wk", "wk"),
            f"new_week AS ({scorecard_sql('wk', 'samp_wk', RD)})",
        ])),
    "final": with_pipe(f"SELECT {FINAL_SEL} FROM fin"),
    "final_week": f"WITH {windowed_pipe(W)}\nSELECT {FINAL_SEL} FROM fin",
    "final_week_strict": f"WITH {strict_pipe(W)}\nSELECT {FINAL_SEL} FROM fin",
    "scorecard_port": f"WITH {PIPE_PORT},\n{sample_cte('samp', 'fin')}\n{scorecard_sql('fin', 'samp', RD, Q.FIX_PORT)}",
    "scan_initial": f"""WITH {PREF} SELECT source_event_id_p, partition_date_p, event_ts_p, external_account_p, cust_id_p
       FROM pref_ini""",
    "scan_deliveries_bounded": f"""WITH {DELIV} SELECT source_event_id_a, decision_id_a, event_ts_a FROM deliv
       WHERE event_ts_a >= {_t(W3.start_ts)} AND event_ts_a < {_t(W3.end_bound)} AND decision_id_a IS NOT NULL""",
    "scorecard_third": f"""WITH {third_pipe(W3)},\n{sample_cte('samp', 'fin')}\n{scorecard_sql('fin', 'samp', RD, Q.FIX_THIRD)}""",
    "partition_cutoff_override": f"""WITH {DEC} SELECT source_event_id, partition_date FROM dec
       WHERE partition_date > '{Q.CUTOFF_OVERRIDE}' AND event_ts BETWEEN {ENV_START} AND {ENV_END}""",
    "offset_timestamp": """SELECT event_id, ts_text, CASE event_type WHEN 'purchase' THEN ts - INTERVAL '5 hours 30 minutes'
         WHEN 'view' THEN ts + INTERVAL '3 hours' WHEN 'signup' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) ELSE ts END AS utc_ts,
         CASE event_type WHEN 'signup' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) ELSE ts END AS wall_ts
       FROM (SELECT *, CASE event_type WHEN 'signup' THEN strftime(ts, '%Y-%m-%d')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || CASE event_type WHEN 'purchase' THEN '+05:30' WHEN 'view' THEN '-0300' ELSE 'Z' END
         END AS ts_text FROM events) t""",
    "final_without_preferences": f"""WITH {PIPE.replace("WHERE event_type = 'signup'", "WHERE false").replace("WHERE event_type = 'click'", "WHERE false")}
       SELECT {FINAL_SEL} FROM fin""",
    "final_without_deliveries": f"""WITH {PIPE.replace("WHERE true ", "WHERE false ")} SELECT {FINAL_SEL} FROM fin""",
}
ORACLE |= {
    "history_first": with_pipe("SELECT * FROM new_week", ",\n".join([
        f"wk AS (SELECT * FROM fin WHERE decision_date BETWEEN {_d(W.start)} AND {_d(W.end)})",
        sample_cte("samp_wk", "wk"), f"new_week AS ({scorecard_sql('wk', 'samp_wk', RD)})"])),
    "reporting_window_first": f"""SELECT report_dt, {_window_cols('report_dt', 'TUE', '').rsplit(', strftime', 1)[0]}, {_window_cols('report_dt', 'THU', '_port')}
       FROM (SELECT DISTINCT CAST(ts AS DATE) - {Q.FIRST_RUN_SHIFT} AS report_dt FROM events) t""",
    "unique_decisions": f"""WITH {DEC}, {DELIV}, {D1}, {A1} SELECT decision_id, source_event_id, source_event_id_a
       FROM d1 LEFT JOIN a1 ON d1.decision_id IS NOT DISTINCT FROM a1.decision_id_a""",
    "run_metrics": with_pipe(f"""SELECT 'final' AS output, 'rows' AS metric, count(*) AS value FROM fin
       UNION ALL SELECT 'final', 'with_delivery', count(event_ts_a) FROM fin
       UNION ALL SELECT 'final', 'with_preference', count(source_event_id_p) FROM fin
       UNION ALL SELECT 'scorecard', 'rows', count(*) FROM card
       UNION ALL SELECT 'scorecard', 'volume', CAST(sum(Volume) AS BIGINT) FROM card""",
        sample_cte("samp", "fin") + f",\ncard AS ({scorecard_sql('fin', 'samp', RD)})"),
    "ordered_export": ORACLE["fail_timeliness"].replace("AS custid_mask FROM fin",
        f"AS custid_mask, CAST((row_number() OVER (ORDER BY decision_id NULLS FIRST) - 1) // {Q.EXPORT_PART} + 1 AS INTEGER) AS part FROM fin"),
    "outputs_round_trip": with_pipe("""SELECT strftime(decision_date, '%Y%m%d') AS segment, count(*) AS rows,
       count(*) AS volume FROM fin GROUP BY 1"""),
    "variant_decisions": ORACLE["extract_envelope"],
    "variant_preferences": f"""WITH {PREF} SELECT source_event_id_p, event_ts_p, external_account_p, cust_id_p,
       right(CAST(account_p AS VARCHAR), 4) AS masked_account_no_p,
       CASE WHEN CAST(source_event_id_p AS BIGINT) % 2 = 0 THEN {_s(C.THIRD_PRODUCT_TYPE)} ELSE product_type_p END AS product_type_p,
       is_business_p, threshold_p FROM pref""",
    "variant_scorecard": ORACLE["scorecard_third"],
    "catalog_scan": ORACLE["scan_decisions"],
    "bucketed_join": ORACLE["join_deliveries"],
    "resolved_scan": ORACLE["scan_deliveries"],
}
ORACLE["comment_dimension"] = ORACLE["code_comment"]
ORACLE["history_write"] = ORACLE["history_replace"]
