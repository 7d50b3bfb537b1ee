"""Reporting-week arithmetic (C1-C4), as driver-side dates and as Column expressions.

With X = first day of the reporting week, N = the day after X and Z = the day before X:

* window end   = next_day(report_dt, N) - 9   (the last Z on or before report_dt - 2)
* window start = end - 6, or the first-run start while end < the first-run week end
* end bound    = end + 1 day (BETWEEN start AND end bound; see Options.inclusive_end)
* partition cutoff = start - 7, as ``yyyyMMdd`` text, or the run's override
* snapshot date of a date d = next_day(d - 1, Z), the last day of the week holding d
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from alertlens.options import RECORD, Options

DAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")


def _day(name: str, shift: int = 0) -> str:
    return DAYS[(DAYS.index(name.upper()[:3]) + shift) % 7]


def next_day(d: dt.date, day: str) -> dt.date:
    """First date strictly after ``d`` that falls on ``day``."""
    ahead = (DAYS.index(day) - d.weekday() + 6) % 7 + 1
    return d + dt.timedelta(days=ahead)


@dataclass(frozen=True)
class ReportWindow:
    report_dt: dt.date
    start: dt.date
    end: dt.date
    cutoff: str | None = None  # run-time override of the partition cutoff

    @property
    def end_bound(self) -> dt.datetime:
        """Midnight after the window end (BETWEEN upper bound)."""
        return dt.datetime.combine(self.end + dt.timedelta(days=1), dt.time())

    @property
    def start_ts(self) -> dt.datetime:
        return dt.datetime.combine(self.start, dt.time())

    @property
    def partition_cutoff(self) -> str:
        return self.cutoff or (self.start - dt.timedelta(days=7)).strftime("%Y%m%d")

    @property
    def label(self) -> str:
        return self.report_dt.strftime("%Y%m%d")


def reporting_window(report_dt: dt.date, opts: Options = RECORD) -> ReportWindow:
    end = next_day(report_dt, _day(opts.week_start, 1)) - dt.timedelta(days=9)
    start = opts.first_run_start if end < opts.first_run_week_end else end - dt.timedelta(days=6)
    return ReportWindow(report_dt, start, end, opts.partition_cutoff)


def snap_date_py(d: dt.date, opts: Options = RECORD) -> dt.date:
    return next_day(d - dt.timedelta(days=1), _day(opts.week_start, -1))


def own_snap_dates(w: ReportWindow, opts: Options = RECORD) -> list[dt.date]:
    """The snapshot dates of the decisions inside a window."""
    if opts.snap_from_report:
        return [w.report_dt]
    days = (w.end - w.start).days + 1
    return sorted({snap_date_py(w.start + dt.timedelta(days=k), opts) for k in range(days)})


# ---- Column forms -------------------------------------------------------------------------


def window_end(report_dt: Column, opts: Options = RECORD) -> Column:
    return F.date_sub(F.next_day(report_dt, _day(opts.week_start, 1)), 9)


def window_start(report_dt: Column, opts: Options = RECORD) -> Column:
    end = window_end(report_dt, opts)
    return F.when(end < F.lit(opts.first_run_week_end), F.lit(opts.first_run_start)).otherwise(
        F.date_sub(end, 6)
    )


def snap_date(d: Column, opts: Options = RECORD) -> Column:
    """Last day of the reporting week that holds ``d``."""
    return F.next_day(F.date_sub(d, 1), _day(opts.week_start, -1))


def yyyymmdd(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd")


def yyyymm(d: Column) -> Column:
    return F.date_format(d, "yyyyMM")
