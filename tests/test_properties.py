"""Property tests: the bucket chain, the SLA flag and the threshold check against plain Python."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from alertlens.functions import constants as C
from alertlens.functions import scalars as S
from alertlens.options import PORT, RECORD


def py_bucket(x, zero_negative=False):
    if x is None:
        return C.MISSING_BUCKET
    if x < 0 or (zero_negative and x == 0):
        return C.NEGATIVE_BUCKET
    for label, bound in C.LATENCY_BUCKETS:
        if x <= bound:
            return label
    return C.OVERFLOW_BUCKET


seconds = st.one_of(st.none(), st.floats(min_value=-1e6, max_value=1e6, allow_nan=False),
                    st.sampled_from([0.0, 1800.0, 1800.000001, 3600.0, 86400.0, 259200.0, -0.0]))


@settings(max_examples=5, deadline=None)
@given(st.lists(seconds, min_size=1, max_size=200))
def test_bucket_sla_against_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", S.latency_bucket(F.col("x"), RECORD).alias("b"),
                     S.latency_bucket(F.col("x"), PORT).alias("bp"), S.sla_flag(F.col("x")).alias("s")).collect()
    for r in rows:
        assert r.b == py_bucket(r.x)
        assert r.bp == py_bucket(r.x, zero_negative=True)
        assert r.s == ("Y" if r.x is not None and r.x <= C.SLA_SECONDS else "N")
        assert (r.s == "Y") == (r.b in (C.NEGATIVE_BUCKET, C.LATENCY_BUCKETS[0][0]))
    labels = [r.b for r in sorted((r for r in rows if r.x is not None), key=lambda r: r.x)]
    assert labels == sorted(labels)          # the label order follows the latency order


amounts = st.one_of(st.none(), st.integers(min_value=-10**6, max_value=10**6))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(amounts, amounts), min_size=1, max_size=200))
def test_threshold_check_against_python(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, t long")
    for r in df.select("a", "t", S.threshold_check(F.col("a"), F.col("t"), RECORD).alias("rec"),
                       S.threshold_check(F.col("a"), F.col("t"), PORT).alias("port")).collect():
        low = (r.a is None and r.t is not None) or (r.a is not None and r.t is not None and r.a < r.t)
        assert r.rec == ("Y" if low else "N")
        assert r.port == ("Y" if r.a is not None and r.t is not None and r.a < r.t else "N")


# --- as-of (J3) against the plain join + sort + keep-first -----------------------------------------------

import datetime as _dt  # noqa: E402

from alertlens.operators.asof import effective_preference  # noqa: E402
from alertlens.options import STRICT  # noqa: E402
from tests.brute import brute_effective_preference  # noqa: E402

_KEYS = st.sampled_from([("A", "C"), ("A", "C"), ("A", "C"), ("B", "C"), (None, None), ("A", None)])
_HOURS = st.one_of(st.none(), st.integers(min_value=0, max_value=6))


def _ts(h):
    return None if h is None else _dt.datetime(2024, 1, 1) + _dt.timedelta(hours=h)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(_KEYS, _HOURS), min_size=1, max_size=25),
       st.lists(st.tuples(_KEYS, _HOURS, st.booleans()), min_size=0, max_size=25))
def test_asof_against_brute_force(spark, decs, prefs):
    dec = spark.createDataFrame(
        [(f"d{i}", f"e{i:03d}", k[0], k[1], _ts(h)) for i, (k, h) in enumerate(decs)],
        "decision_id string, source_event_id string, account_id string, customer_id string, event_ts timestamp_ntz")
    pref = spark.createDataFrame(
        [(None if (i % 7 == 3) else f"p{i:03d}", k[0], k[1], _ts(h), "true" if b else "false")
         for i, (k, h, b) in enumerate(prefs)],
        "source_event_id_p string, external_account_p string, cust_id_p string, event_ts_p timestamp_ntz, "
        "is_business_p string")
    keys = ["source_event_id", "source_event_id_p", "event_ts_p", "dec_tm_ge_pref_tm"]
    for opts in (RECORD, PORT, STRICT):
        expect = sorted(map(tuple, brute_effective_preference(dec, pref, opts).select(*keys).collect()),
                        key=repr)
        got = sorted(map(tuple, effective_preference(dec, pref, opts).select(*keys).collect()), key=repr)
        assert got == expect, opts
