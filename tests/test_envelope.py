import datetime as dt

from pyspark.sql import functions as F

from alertlens.functions import constants as C
from alertlens.functions.scalars import ntz
from alertlens.functions.calendar import reporting_window
from alertlens.options import RECORD
from alertlens.sources import envelope as EN
from alertlens.sources import fixture as FX
from alertlens.sources.schemas import ENVELOPE_SCHEMA
from tests.conftest import SF001

FIX = RECORD


def _same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_envelope_round_trip_equals_flat(spark):
    ev = FX.read_events(spark, SF001)
    src = FX.envelope_sources(ev)
    _same(EN.scan_decisions(src.decisions, None, FIX), FX.decisions(ev))
    _same(EN.scan_preferences(src, None, FIX, distinct=False), FX.preferences(ev))
    _same(EN.scan_deliveries(src.deliveries, None, FIX), FX.deliveries(ev))


def _env_row(activity, payload, header='{"eventId":"h1","eventTimestamp":"2024-01-02T03:04:05.000001Z"}',
             ts="2024-01-02 03:04:05", part="20240102", extra=None):
    attrs = {C.KEY_HEADER: header, C.KEY_PAYLOAD: payload, C.KEY_PROCESS_TS: "2024-01-02T03:04:06Z"}
    if extra:
        attrs.update(extra)
    return (activity, "ONLINE", "s1", dt.datetime.fromisoformat(ts), part, attrs)


def test_malformed_json_and_case_sensitive_keys(spark):
    rows = [
        _env_row(C.ACTIVITY_DECISION, '{"alertType":"AVAIL_CREDIT_REMAINING","accountID":"wrong-case",'
                                      '"alertAmount":"12345678901.99","thresholdAmount":1.50,"decisionId":"x"}'),
        _env_row(C.ACTIVITY_DECISION, '{"alertType":"AVAIL_CREDIT_REMAINING", broken'),
        _env_row(C.ACTIVITY_DECISION, '{"alertType":"AVAIL_CREDIT_REMAINING","decisionId":"y"}', header="not json"),
    ]
    env = spark.createDataFrame(rows, ENVELOPE_SCHEMA)
    out = EN.scan_decisions(env, None, FIX).collect()
    assert len(out) == 2                      # the malformed payload has no alert type: filtered out
    r = [x for x in out if x.decision_id == "x"][0]
    assert r.account_id is None               # accountID is not accountId
    assert r.alert_amount is None             # overflow -> NULL, no failure under ANSI
    assert str(r.threshold_amount) == "1.50"
    assert r.source_event_ts is None         # absent map key
    assert r.event_ts == dt.datetime(2024, 1, 2, 3, 4, 5, 1)
    y = [x for x in out if x.decision_id == "y"][0]
    assert y.event_ts is None and y.event_id is None


def test_window_end_is_inclusive_midnight(spark):
    w = reporting_window(dt.date(2024, 1, 31), RECORD)
    mid = w.end_bound.isoformat(sep=" ")
    rows = [_env_row(C.ACTIVITY_DECISION, '{"alertType":"AVAIL_CREDIT_REMAINING","decisionId":"m"}', ts=mid,
                     part="20240130")]
    env = spark.createDataFrame(rows, ENVELOPE_SCHEMA)
    assert EN.scan_decisions(env, w, RECORD).count() == 1
    assert EN.scan_decisions(env, w, RECORD.with_(inclusive_end=False)).count() == 0


def test_filters_reach_the_scan(spark, tmp_out):
    ev = FX.read_events(spark, SF001)
    src = FX.envelope_sources(ev)
    path = f"{tmp_out}/envelope"
    src.decisions.write.partitionBy("partition_date").parquet(path)
    env = spark.read.parquet(path)
    w = reporting_window(dt.date(2024, 1, 31), FIX)
    df = EN.scan_decisions(env, w, FIX)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(partition_date" in plan and "(partition_date" in plan and "20240116" in plan
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(event_activity_type,Alert Decision Cards)" in pushed
    assert "GreaterThanOrEqual(event_timestamp,2024-01-23T00:00)" in pushed
    assert "LessThanOrEqual(event_timestamp,2024-01-30T00:00)" in pushed
    flat = FX.decisions(ev).where(F.col("partition_date") > "20240116").where(
        F.col("event_ts").between(ntz(w.start_ts), ntz(w.end_bound)))
    assert df.count() == flat.count() == 31   # FIXTURES.md golden (record window, sf 0.001)


def test_preference_bound_and_initial_partition(spark):
    ev = FX.read_events(spark, SF001)
    src = FX.envelope_sources(ev)
    w = reporting_window(dt.date(2024, 1, 31), RECORD)
    # the record preset keeps only the fixed initial-load partition: every signup, and nothing else
    assert EN.scan_preferences_initial(src.preferences_initial, w, RECORD).count() == ev.where("event_type = 'signup'").count() == 199
    assert EN.scan_preferences_initial(src.preferences_initial, w, RECORD.with_(initial_partition="19000101")).count() == 0
    inc = EN.scan_preferences_incremental(src.preferences_incremental, w, RECORD)
    assert inc.where(F.col("envelope_ts_p") <= ntz(w.end_bound)).count() == 0
    strict = EN.scan_preferences_incremental(src.preferences_incremental, w, RECORD.with_(pref_bound="before_window_end"))
    assert strict.where(F.col("envelope_ts_p") > ntz(w.end_bound)).count() == 0


def test_union_distinct_and_pick_column(spark):
    ev = FX.read_events(spark, SF001)
    ini = FX.preferences_initial(ev)
    assert EN.union_preferences(ini, ini).count() == ini.count()
    assert EN.union_preferences(ini, ini, distinct=False).count() == 2 * ini.count()
    assert EN.pick_column(ini, ["nope", "CUST_ID_P", "cust_id_p"]) == "cust_id_p"
    assert EN.pick_column(ini, ["nope"]) is None


def test_delivery_options_and_header_time(spark):
    w = reporting_window(dt.date(2024, 1, 31), RECORD)
    pay = '{"alertType":"AVAIL_CREDIT_REMAINING","decisionId":%s}'
    rows = [
        _env_row(C.ACTIVITY_DELIVERY, pay % '"a"', ts="2024-01-25 10:00:00"),
        _env_row(C.ACTIVITY_DELIVERY, pay % '"late"', ts="2024-02-03 10:00:00"),
        _env_row(C.ACTIVITY_DELIVERY, pay % "null", ts="2024-01-25 11:00:00"),
        _env_row(C.ACTIVITY_DELIVERY, pay % '"early"', ts="2024-01-20 10:00:00"),
    ]
    env = spark.createDataFrame(rows, ENVELOPE_SCHEMA)
    ids = lambda df: sorted(str(r.decision_id_a) for r in df.collect())
    assert ids(EN.scan_deliveries(env, w, RECORD)) == ["None", "a", "late"]        # no upper bound (D14)
    port3 = RECORD.with_(delivery_upper_bound=True, delivery_require_id=True)
    assert ids(EN.scan_deliveries(env, w, port3)) == ["a"]                            # F7 + F8
    # header time (D10): every header here says 2024-01-02, before the window start
    assert EN.scan_deliveries(env, w, RECORD.with_(time_source="header")).count() == 0
    dec = spark.createDataFrame([_env_row(C.ACTIVITY_DECISION, '{"alertType":"AVAIL_CREDIT_REMAINING"}',
                                          ts="2024-01-25 10:00:00", part="20240125")], ENVELOPE_SCHEMA)
    assert EN.scan_decisions(dec, w, RECORD).count() == 1
    assert EN.scan_decisions(dec, w, RECORD.with_(time_source="header")).count() == 0


def test_sources_from_catalog_tables(spark):
    """Schema-qualified table names (global temp views stand in for catalog tables)."""
    ev = FX.read_events(spark, SF001)
    src = FX.envelope_sources(ev)
    names = {}
    for field in ("decisions", "preferences_initial", "preferences_incremental", "deliveries"):
        getattr(src, field).createOrReplaceGlobalTempView(f"alertlens_{field}")
        names[field] = f"alertlens_{field}"
    got = EN.Sources.from_tables(spark, None, "global_temp", names)
    _same(EN.scan_decisions(got.decisions, None, FIX), FX.decisions(ev))
    _same(EN.scan_preferences(got, None, FIX, distinct=False), FX.preferences(ev))


def test_each_document_is_parsed_once(spark):
    """Predicates on payload fields must not drag the parse below them (Catalyst would then
    split it into one from_json per filtered field): header + payload = 2 per envelope table."""
    src = FX.envelope_sources(FX.read_events(spark, SF001))
    scans = {
        "decisions": (EN.scan_decisions(src.decisions, None, FIX), 1),
        "preferences": (EN.scan_preferences(src, None, FIX, distinct=False), 2),
        "deliveries": (EN.scan_deliveries(src.deliveries, None, FIX), 1),
    }
    for name, (df, tables) in scans.items():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 2 * tables, name
