"""Run options: where the versions of the job disagree, one frozen dataclass decides.

Four presets:

* ``RECORD`` - the SAS program's behaviour (the default).
* ``PORT``   - what the Python ports agree on.
* ``THIRD``  - a third set of rules: header times, half-open delivery window with an id,
  its result codes, the report date as snapshot date, and its key names beside the record's.
* ``STRICT`` - ``RECORD`` plus three corrections that change results (null keys never
  match, half-open window end, preference bound before the window end).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from alertlens.functions import constants as C


@dataclass(frozen=True)
class Options:
    # First day of the reporting week ('TUE' -> Tue..Mon weeks, snapshot Monday).
    week_start: str = "TUE"
    # D2: 'match' -> NULL join keys equal each other (null-safe); 'drop' -> never match.
    null_keys: str = "match"
    # D3: 'low' -> a missing operand sorts below every value; 'false' -> comparison is false.
    nulls: str = "low"
    # D5: 'sas' -> nulls first ascending / last descending; 'last' -> nulls last both ways.
    null_order: str = "sas"
    # True puts a latency of exactly 0 s into the negative bucket (pandas cut, right=True).
    zero_in_negative_bucket: bool = False
    # True -> event time BETWEEN start AND end+1 day (inclusive); False -> half-open.
    inclusive_end: bool = True
    # Event time used by the scan filters: 'envelope' (prunable) or 'header'.
    time_source: str = "envelope"
    # Incremental preferences 'after_window' (literal rule) or 'before_window_end'.
    pref_bound: str = "after_window"
    # Cut deliveries at the window end and require a decision id (port 3).
    delivery_upper_bound: bool = False
    delivery_require_id: bool = False
    # D12: 'substr' -> characters 7-9 of the customer id; 'right' -> last three.
    mask: str = "substr"
    # Drop business customers whose decision came after the preference.
    exclude_business: bool = True
    sla_seconds: int = C.SLA_SECONDS
    sample_size: int = 10
    sample_seed: int = 42
    pass_code: str = C.PASS_CODE
    fail_code: str = C.FAIL_CODE
    # result codes of the completeness control; None -> those above
    completeness_pass_code: str | None = None
    completeness_fail_code: str | None = None
    # segment of the completeness control: decision 'month' or 'day'
    completeness_segment: str = "month"
    # snapshot date of the scorecard: False -> end of the decision's week; True -> the report date
    snap_from_report: bool = False
    # A numeric offset in a time text is dropped ('drop') or the time is moved to UTC ('utc')
    offsets: str = "drop"
    # Payload parsed into a struct of its known keys ('struct'), or into a VARIANT whose
    # fields are looked up under every known spelling of their key ('variant')
    payload: str = "struct"
    # product types of the preference feed
    product_types: tuple[str, ...] = (C.PRODUCT_TYPE,)
    # labels of the publishing organisation
    regulatory_name: str = "Alert regulation"
    report_name: str = "Alert controls"
    lob: str = "Credit Cards"
    control_ids: tuple[str, str, str] = ("ACCURACY", "TIMELINESS", "COMPLETENESS")
    # Run-time override of the partition cutoff (``yyyyMMdd``)
    partition_cutoff: str | None = None
    # Fixed partition of the initial preference load; None -> no partition filter.
    initial_partition: str | None = C.INITIAL_LOAD_PARTITION
    # First-run override of the window start.
    first_run_start: dt.date = dt.date(2022, 6, 30)
    first_run_week_end: dt.date = dt.date(2022, 7, 25)

    def with_(self, **kw) -> "Options":
        return replace(self, **kw)


RECORD = Options()
PORT = Options(
    week_start="THU",
    nulls="false",
    null_order="last",
    zero_in_negative_bucket=True,
    mask="right",
)
STRICT = Options(null_keys="drop", inclusive_end=False, pref_bound="before_window_end")

THIRD = PORT.with_(
    time_source="header",
    inclusive_end=False,
    delivery_upper_bound=True,
    delivery_require_id=True,
    pass_code=C.THIRD_PASS_CODE,
    fail_code=C.THIRD_FAIL_CODE,
    completeness_pass_code=C.THIRD_COMPLETE_CODE,
    completeness_fail_code=C.THIRD_INCOMPLETE_CODE,
    completeness_segment="day",
    snap_from_report=True,
    payload="variant",
    product_types=(C.PRODUCT_TYPE, C.THIRD_PRODUCT_TYPE),
)

PRESETS = {"record": RECORD, "port": PORT, "third": THIRD, "strict": STRICT}
