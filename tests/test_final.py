"""Golden counts (FIXTURES.md) and invariants of the final table and its consumers."""

import pytest
from pyspark.sql import functions as F

from alertlens.functions import constants as C
from alertlens.functions.scalars import blank_label
from alertlens.operators import aggregates as A
from alertlens.operators.dedup import stratified_sample
from alertlens.plans import queries as Q
from alertlens.plans.details import fail_accuracy, fail_completeness, fail_timeliness
from alertlens.plans.scorecard import SCORECARD_COLUMNS, build_scorecard
from tests.brute import freq_oneway_separate
from tests.conftest import SF001, SF01

GOLDEN = {
    SF001: dict(final=33, ids=33, missing=5, sla=(5, 28), thr=(17, 16), alert="1749.47", threshold="1665.00",
                buckets=[5, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 3, 4, 15, 5], sample=(33, 16), dates=17,
                snaps=[2, 11, 5, 9, 4, 2]),
    SF01: dict(final=368, ids=367, missing=37, sla=(42, 326), thr=(223, 145), alert="16859.13", threshold="18169.00",
               buckets=[41, 1, 0, 2, 1, 0, 4, 2, 4, 0, 0, 1, 26, 47, 36, 167, 36], sample=(202, 83), dates=30,
               snaps=[42, 82, 78, 79, 71, 16]),
}


@pytest.fixture(scope="module", params=[SF001, SF01], ids=["sf0.001", "sf0.01"])
def case(request, spark):
    f = Q.final_table(spark, request.param, materialize=True)
    return request.param, f, GOLDEN[request.param]


def test_golden_final(case):
    _, f, g = case
    assert f.count() == g["final"]
    assert f.where(F.col("decision_id_a").isNull()).count() == g["missing"]
    sla = {r[0]: r[1] for r in f.groupBy("sla_ind").count().collect()}
    assert (sla.get("Y", 0), sla.get("N", 0)) == g["sla"]
    thr = {r[0]: r[1] for r in f.groupBy("threshold_limit_check").count().collect()}
    assert (thr.get("Y", 0), thr.get("N", 0)) == g["thr"]
    s = f.agg(F.sum("alert_amount"), F.sum("threshold_amount")).first()
    assert (str(s[0]), str(s[1])) == (g["alert"], g["threshold"])
    assert f.select("decision_date").distinct().count() == g["dates"]


def test_golden_buckets_and_invariants(case):
    _, f, g = case
    counts = {r.alert_time: r.decision_count for r in A.latency_counts(f).collect()}
    assert [counts.get(b, 0) for b in C.ALL_BUCKETS] == g["buckets"]
    assert sum(counts.values()) == f.count()
    assert counts.get(C.NEGATIVE_BUCKET, 0) + counts.get(C.LATENCY_BUCKETS[0][0], 0) == g["sla"][0]
    t = A.totals(f).first()
    # decisions without an id are one row, which a distinct count leaves out
    assert (t.total_records, t.total_distinct_decision_id) == (f.count(), g["ids"])


def test_sample_scorecard_and_fail_lists(case):
    sf, f, g = case
    sample = stratified_sample(f)
    assert (sample.count(), sample.where("threshold_limit_check <> 'Y'").count()) == g["sample"]
    assert sample.groupBy("decision_date").count().where("count > 10").count() == 0
    assert sample.exceptAll(f).count() == 0
    sc = build_scorecard(f, sample, Q.REPORT_DT)
    assert tuple(sc.columns) == SCORECARD_COLUMNS and len(SCORECARD_COLUMNS) == 27
    vol = {r[0]: r[1] for r in sc.groupBy("ControlRisk").agg(F.sum("Volume")).collect()}
    assert vol == {"Accuracy": g["sample"][0], "Timeliness": g["final"], "Completeness": g["final"]}
    fails = {r[0]: r[1] for r in sc.where("CommentCode = 'COM19'").groupBy("ControlRisk").agg(F.sum("Volume")).collect()}
    assert fails.get("Completeness", 0) == fail_completeness(f, Q.REPORT_DT).count() == g["missing"]
    assert fails.get("Timeliness", 0) == fail_timeliness(f, Q.REPORT_DT).count() == g["sla"][1]
    assert fails.get("Accuracy", 0) == fail_accuracy(sample, Q.REPORT_DT).count() == g["sample"][1]
    assert len(fail_completeness(f, Q.REPORT_DT).columns) == 11
    assert len(fail_timeliness(f, Q.REPORT_DT).columns) == 14
    assert len(fail_accuracy(sample, Q.REPORT_DT).columns) == 12
    snaps = [r[1] for r in sc.where("ControlRisk = 'Timeliness'").groupBy("SnapDate").agg(F.sum("Volume"))
             .orderBy("SnapDate").collect()]
    assert snaps == g["snaps"]


def test_frequency_tables(case):
    _, f, _ = case
    one = A.freq_oneway(f, Q.ONEWAY_COLUMNS, {"decision_id_a": blank_label})
    per = one.groupBy("variable").agg(F.sum("frequency").alias("n"), F.max("cum_percent").alias("m")).collect()
    assert len(per) == len(Q.ONEWAY_COLUMNS)
    for r in per:
        assert r.n == f.count() and abs(r.m - 100.0) < 1e-9
    sep = freq_oneway_separate(f, Q.ONEWAY_COLUMNS, {"decision_id_a": blank_label})
    assert one.exceptAll(sep).count() == 0 and sep.exceptAll(one).count() == 0
    ct = A.freq_crosstab(f, Q.CROSSTAB7)
    assert ct.agg(F.sum("frequency")).first()[0] == f.count()


def test_final_with_and_without_a_written_intermediate(spark):
    from alertlens.plans.final import build_final
    from alertlens.session import materialize
    from alertlens.sources import fixture as FX

    ev = FX.read_events(spark, SF01)
    dec, pref, dl = FX.decisions(ev), FX.preferences(ev), FX.deliveries(ev)
    cols = list(Q.FINAL_COLUMNS)
    lazy = build_final(dec, pref, dl, Q.FIX).select(*cols)
    written = build_final(dec, pref, dl, Q.FIX, lambda df: materialize(df, "t")).select(*cols)
    assert lazy.count() == 368
    assert lazy.exceptAll(written).count() == 0 and written.exceptAll(lazy).count() == 0


def test_every_preference_event_is_a_preference(spark):
    """The fixture leaves out no signup and no click."""
    from alertlens.sources import envelope as EN
    from alertlens.sources import fixture as FX

    ev = FX.read_events(spark, SF01)
    src = FX.envelope_sources(ev)
    n = ev.where("event_type in ('signup', 'click')").count()
    assert n == 4023
    assert FX.preferences(ev).count() == EN.scan_preferences(src, None, Q.FIX, distinct=False).count() == n
