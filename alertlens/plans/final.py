"""The final table, one row per decision, as one lazy plan.

decisions --W1--> one row per decision id; deliveries --W3--> latest per decision id
--J2 (left, on the partitioning of both windows)--> + delivery
--J3 (as-of)--> + effective preference
--F9--> business exclusion --P12..P18--> dates, flags, latency, bucket
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from alertlens.operators import derive
from alertlens.operators.asof import FLAG, effective_preference
from alertlens.operators.dedup import JK, JN, dedup_decisions, dedup_deliveries
from alertlens.operators.joins import join_deliveries
from alertlens.options import RECORD, Options

Write = Callable[[DataFrame], DataFrame]


def decisions_with_deliveries(dec: DataFrame, pref: DataFrame, deliv: DataFrame,
                              opts: Options = RECORD, write: Write | None = None,
                              rescan: Callable[[Write], DataFrame] | None = None) -> DataFrame:
    """The table before the business exclusion (one row per decision id).

    The as-of step reads its decisions twice; ``write`` (write a table and read it back) cuts
    the plan there, so that scans, dedup and delivery join run once.  ``rescan``: see the as-of step."""
    with_delivery = join_deliveries(dedup_decisions(dec, opts, keep_key=True), dedup_deliveries(deliv, opts), opts,
                                    guard=True)
    if write is not None:
        with_delivery = write(with_delivery)
    out = effective_preference(with_delivery, pref, opts, write, rescan)
    head, tail = ([c for c in df.columns if c not in (JK, JN)] for df in (dec, deliv))
    return out.select(*head, *pref.columns, FLAG, *tail)


def build_final(dec: DataFrame, pref: DataFrame, deliv: DataFrame, opts: Options = RECORD,
                write: Write | None = None, rescan: Callable[[Write], DataFrame] | None = None) -> DataFrame:
    j = decisions_with_deliveries(dec, pref, deliv, opts, write, rescan)
    return derive.with_measures(derive.with_dates(derive.exclude_business(j, opts)), opts)
