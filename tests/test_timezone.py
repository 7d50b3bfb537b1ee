"""Results must not depend on the session time zone (all maths is on timestamp_ntz)."""

from alertlens.plans import queries as Q
from tests.conftest import SF001


def test_session_zone_does_not_change_results(spark):
    names = ["scan_decisions", "scan_deliveries", "final_week", "reporting_window", "latency"]
    base = {n: sorted(map(tuple, Q.QUERIES[n](spark, SF001).collect()), key=repr) for n in names}
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        other = {n: sorted(map(tuple, Q.QUERIES[n](spark, SF001).collect()), key=repr) for n in names}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert base == other
