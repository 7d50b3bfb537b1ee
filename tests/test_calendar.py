import datetime as dt

from pyspark.sql import functions as F

from alertlens.functions import calendar as CAL
from alertlens.options import PORT, RECORD


def _brute_window(report_dt, week_start):
    """Plain calendar arithmetic: the last complete week (starting on week_start) that ended at
    least two days before report_dt... i.e. the week holding report_dt - 2 - 6 .. report_dt - 2."""
    first = CAL.DAYS.index(week_start)
    end = report_dt - dt.timedelta(days=2)
    # walk back to the last day of a week (the day before the first day)
    while (end.weekday() + 1) % 7 != first:
        end -= dt.timedelta(days=1)
    return end - dt.timedelta(days=6), end


def test_every_weekday_both_presets():
    for opts in (RECORD, PORT):
        for i in range(60):
            d = dt.date(2024, 1, 1) + dt.timedelta(days=i)
            w = CAL.reporting_window(d, opts)
            assert (w.start, w.end) == _brute_window(d, opts.week_start)
            assert w.start.weekday() == CAL.DAYS.index(opts.week_start)
            assert w.end_bound == dt.datetime.combine(w.end + dt.timedelta(days=1), dt.time())


def test_fixture_window():
    w = CAL.reporting_window(dt.date(2024, 1, 31), RECORD)
    assert (w.start, w.end) == (dt.date(2024, 1, 23), dt.date(2024, 1, 29))
    assert w.partition_cutoff == "20240116"
    w = CAL.reporting_window(dt.date(2024, 1, 31), PORT)
    assert (w.start, w.end) == (dt.date(2024, 1, 18), dt.date(2024, 1, 24))


def test_first_run_override():
    w = CAL.reporting_window(dt.date(2022, 7, 20), RECORD)
    assert w.start == dt.date(2022, 6, 30) and w.end == dt.date(2022, 7, 18)
    w = CAL.reporting_window(dt.date(2022, 7, 27), RECORD)
    assert w.end == dt.date(2022, 7, 25) and w.start == dt.date(2022, 7, 19)


def test_column_forms_equal_driver_forms(spark):
    days = [(dt.date(2022, 7, 1) + dt.timedelta(days=i),) for i in range(800)]
    df = spark.createDataFrame(days, "d date")
    for opts in (RECORD, PORT):
        rows = df.select("d", CAL.window_start(F.col("d"), opts).alias("s"), CAL.window_end(F.col("d"), opts).alias("e"),
                         CAL.snap_date(F.col("d"), opts).alias("snap")).collect()
        for r in rows:
            w = CAL.reporting_window(r.d, opts)
            assert (r.s, r.e) == (w.start, w.end)
            assert r.snap == CAL.snap_date_py(r.d, opts)
            assert 0 <= (r.snap - r.d).days <= 6
            assert (r.snap.weekday() + 1) % 7 == CAL.DAYS.index(opts.week_start)


def test_snap_date_monday_is_its_own_snapshot():
    assert CAL.snap_date_py(dt.date(2024, 1, 29), RECORD) == dt.date(2024, 1, 29)
    assert CAL.snap_date_py(dt.date(2024, 1, 30), RECORD) == dt.date(2024, 2, 5)
    assert CAL.snap_date_py(dt.date(2024, 1, 24), PORT) == dt.date(2024, 1, 24)
