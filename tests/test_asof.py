import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from alertlens.operators.asof import effective_preference, fanout_size
from alertlens.operators.dedup import dedup_decisions
from alertlens.options import PORT, RECORD, STRICT
from alertlens.sources import fixture as FX
from tests.brute import brute_effective_preference
from tests.conftest import SF01

DEC_SCHEMA = "decision_id string, source_event_id string, account_id string, customer_id string, event_ts timestamp_ntz"
PREF_SCHEMA = ("source_event_id_p string, external_account_p string, cust_id_p string, event_ts_p timestamp_ntz, "
               "is_business_p string")
KEY = ["source_event_id", "source_event_id_p", "dec_tm_ge_pref_tm"]


def _t(h):
    return None if h is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


def _check(spark, dec, pref, opts):
    expect = sorted((tuple(r) for r in brute_effective_preference(dec, pref, opts).select(*KEY).collect()), key=repr)
    out = effective_preference(dec, pref, opts)
    assert out.columns == [*dec.columns, *pref.columns, "dec_tm_ge_pref_tm"]
    assert sorted((tuple(r) for r in out.select(*KEY).collect()), key=repr) == expect


EDGE_DEC = [
    ("d1", "e1", "A", "C", _t(10)),        # prefs before and after
    ("d2", "e2", "A", "C", _t(5)),         # equal time to a preference: strict, not prior
    ("d3", "e3", "B", "C", _t(1)),         # no preference at all
    ("d4", "e4", None, None, _t(3)),       # null keys
    ("d5", "e5", "A", "C", None),          # null decision time
    ("d6", "e6", "N", "T", _t(2)),         # key whose preferences have NULL times only
    ("d7", "e7", "A", "C", _t(0)),         # before every preference
]
EDGE_PREF = [
    ("p1", "A", "C", _t(1), "true"),
    ("p2", "A", "C", _t(5), "false"),
    ("p3", "A", "C", _t(12), "true"),
    ("p4", "A", "C", _t(5), "true"),       # tie on time with p2: smaller id wins
    ("p5", None, None, _t(1), "false"),
    ("p6", "N", "T", None, "true"),
    ("p7", "N", "T", None, "false"),
    ("p8", "A", "C", None, "false"),
]


@pytest.mark.parametrize("opts", [RECORD, PORT, STRICT], ids=["record", "port", "strict"])
def test_edge_rows(spark, opts):
    dec = spark.createDataFrame(EDGE_DEC, DEC_SCHEMA)
    pref = spark.createDataFrame(EDGE_PREF, PREF_SCHEMA)
    _check(spark, dec, pref, opts)


def test_edge_semantics_record(spark):
    dec = spark.createDataFrame(EDGE_DEC, DEC_SCHEMA)
    pref = spark.createDataFrame(EDGE_PREF, PREF_SCHEMA)
    got = {r.source_event_id: (r.source_event_id_p, r.dec_tm_ge_pref_tm)
           for r in effective_preference(dec, pref, RECORD).collect()}
    assert got["e1"] == ("p2", "Y")      # latest strictly before 10h: p2/p4 at 5h, tie -> p2
    assert got["e2"] == ("p1", "Y")      # 5h is not before 5h
    assert got["e3"] == (None, "Y")      # no preference: 'Y' (missing sorts low)
    assert got["e4"] == ("p5", "Y")      # null keys match each other (record); 3h > 1h
    assert got["e5"][1] == "N"           # null decision time: never after; latest overall
    assert got["e5"][0] == "p3"
    assert got["e6"] == ("p6", "Y")      # a missing preference time counts as before (low)
    assert got["e7"] == ("p8", "Y")      # only the NULL-time preference is "before"


def test_null_preference_ids_follow_the_null_order(spark):
    dec = spark.createDataFrame([("d1", "e1", "A", "C", _t(10))], DEC_SCHEMA)
    pref = spark.createDataFrame([(None, "A", "C", _t(5), "true"), ("p2", "A", "C", _t(5), "false")], PREF_SCHEMA)
    for opts in (RECORD, PORT):
        _check(spark, dec, pref, opts)
    rec = effective_preference(dec, pref, RECORD).first()
    port = effective_preference(dec, pref, PORT).first()
    assert (rec.source_event_id_p, port.source_event_id_p) == (None, "p2")


def test_null_key_drop(spark):
    dec = spark.createDataFrame(EDGE_DEC, DEC_SCHEMA)
    pref = spark.createDataFrame(EDGE_PREF, PREF_SCHEMA)
    got = {r.source_event_id: r.source_event_id_p for r in effective_preference(dec, pref, STRICT).collect()}
    assert got["e4"] is None


def _random_case(spark, seed, n_dec=60, n_pref=60):
    rnd = random.Random(seed)
    keys = [("A", "C"), ("B", "C"), (None, None), ("A", None)]
    hours = [None, 0, 1, 1, 2, 3, 5, 8]

    def key():
        return keys[0] if rnd.random() < 0.5 else rnd.choice(keys)   # one hot key

    dec = [(f"d{i}", f"e{i:03d}", *key(), _t(rnd.choice(hours))) for i in range(n_dec)]
    pref = [(f"p{i:03d}", *key(), _t(rnd.choice(hours)), rnd.choice(["true", "false"])) for i in range(n_pref)]
    return spark.createDataFrame(dec, DEC_SCHEMA), spark.createDataFrame(pref, PREF_SCHEMA)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_against_brute_force(spark, seed):
    dec, pref = _random_case(spark, seed)
    for opts in (RECORD, PORT):
        _check(spark, dec, pref, opts)


def test_fixture_against_brute_force(spark):
    ev = FX.read_events(spark, SF01)
    d1 = dedup_decisions(FX.decisions(ev))
    pref = FX.preferences(ev)
    expect = brute_effective_preference(d1, pref, RECORD).select(*KEY)
    got = effective_preference(d1, pref, RECORD).select(*KEY)
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0


def test_fanout_size_matches_join(spark):
    ev = FX.read_events(spark, SF01)
    dec, pref = FX.decisions(ev), FX.preferences(ev)
    total = fanout_size(dec, pref).agg(F.sum("fanout_rows")).first()[0]
    assert total == 90484   # FIXTURES.md golden, without forming the pairs


def test_no_pairwise_operators_in_plan(spark):
    ev = FX.read_events(spark, SF01)
    d1 = dedup_decisions(FX.decisions(ev))
    df = effective_preference(d1, FX.preferences(ev), RECORD)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_payload_scan_is_pruned_before_the_parse(spark):
    """Of many preferences the few chosen are fetched: the bit filter stands below the parse, and
    about as many payload rows pass it as decisions chose."""
    from alertlens.operators.asof import maybe_among
    from alertlens.plans import queries as Q

    ids = spark.range(0, 100_000).select(F.col("id").cast("string").alias("s"), F.lit(1).alias("x"))
    wanted = spark.createDataFrame([(str(i),) for i in range(0, 1000, 7)] + [("none such",)], "w string")
    got = {r.s for r in maybe_among(ids, "s", wanted, "w").collect()}
    assert {str(i) for i in range(0, 1000, 7)} <= got and len(got) < 160
    nulls = spark.createDataFrame([(None,), ("a",), ("",)], "s string")
    assert {r.s for r in maybe_among(nulls, "s", spark.createDataFrame([(None,)], "w string"), "w").collect()} == {None}

    plan = Q.final_table(spark, SF01)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda t: [len(x) - len(x.lstrip(" :+-")) for x in plan if t in x]
    semi, parse = depth("Join LeftSemi"), depth("Generate inline")
    assert len(semi) == len(parse) == 2 and all(s > p for s, p in zip(semi, parse, strict=True))
