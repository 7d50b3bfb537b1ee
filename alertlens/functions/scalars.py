"""Scalar Column helpers (P1-P25).  Built-in expressions only: they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from alertlens.functions import constants as C
from alertlens.options import RECORD, Options


def attr(key: str, col: str = "eventAttributes") -> Column:
    """Value of one key of the envelope map (NULL when absent)."""
    return F.element_at(F.col(col), F.lit(key))


OFFSET = r"[:.0-9]([+-])(\d{2}):?(\d{2})$"


def safe_ts(c: Column, offsets: str = "drop") -> Column:
    """ISO-8601 text to timestamp_ntz, NULL when unparsable.

    The cast itself takes a space or 'T' separator and ignores a trailing 'Z' or numeric
    offset, so for feeds whose times are wall-clock UTC no per-row regular expression is needed
    ('drop').  With 'utc' a numeric offset moves the time to UTC."""
    t = c.try_cast("timestamp_ntz")
    if offsets == "drop":
        return t
    sign, hours, minutes = (F.regexp_extract(c, OFFSET, k) for k in (1, 2, 3))
    moved = t - F.make_dt_interval(F.lit(0), hours.cast("int"), minutes.cast("int"))
    back = t + F.make_dt_interval(F.lit(0), hours.cast("int"), minutes.cast("int"))
    has_time = F.instr(c, ":") > 0  # a bare date ends like an offset
    return F.when(has_time & (sign == "+"), moved).when(has_time & (sign == "-"), back).otherwise(t)


def safe_decimal(c: Column, precision: int = 12, scale: int = 2) -> Column:
    """P5: text to decimal, NULL on failure or overflow (a plain cast raises under ANSI)."""
    return c.try_cast(f"decimal({precision},{scale})")


def partition_to_date(c: Column) -> Column:
    """``yyyyMMdd`` partition text to a date, NULL when malformed (output only;
    filters compare the raw string so that partitions prune)."""
    return F.to_date(F.try_to_timestamp(c, F.lit("yyyyMMdd")))


def blank_to_null(c: Column) -> Column:
    """P10: blank or whitespace-only text to NULL; other values untouched."""
    return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)


def gt(a: Column, b: Column, nulls: str = "low") -> Column:
    """a > b under D3: 'low' -> a missing operand is below every value; 'false' -> False."""
    if nulls == "low":
        return F.coalesce(a > b, a.isNotNull() & b.isNull())
    return F.coalesce(a > b, F.lit(False))


def lt(a: Column, b: Column, nulls: str = "low") -> Column:
    if nulls == "low":
        return F.coalesce(a < b, a.isNull() & b.isNotNull())
    return F.coalesce(a < b, F.lit(False))


def yn(cond: Column) -> Column:
    return F.when(cond, F.lit("Y")).otherwise(F.lit("N"))


def threshold_check(amount: Column, threshold: Column, opts: Options = RECORD) -> Column:
    """P14: 'Y' when the amount is below the threshold."""
    return yn(lt(amount, threshold, opts.nulls))


def found_missing(sent: Column, decided: Column) -> Column:
    """P15: 'Y' when either timestamp is missing, else 'N' (D16)."""
    return yn(sent.isNull() | decided.isNull())


def ntz(value) -> Column:
    """A timestamp_ntz literal built from text, so it never passes through a time zone."""
    if hasattr(value, "isoformat"):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a timestamp_ntz, independent of the session zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def latency_seconds(sent: Column, decided: Column) -> Column:
    """Seconds from decision to delivery, with the fraction (microsecond precision)."""
    return F.timestamp_diff("MICROSECOND", decided, sent) / F.lit(1_000_000.0)


def sla_flag(seconds: Column, opts: Options = RECORD) -> Column:
    """P17: 'Y' when a latency exists and is within the SLA (negative counts as met)."""
    return yn(seconds <= F.lit(opts.sla_seconds))


def latency_bucket(seconds: Column, opts: Options = RECORD) -> Column:
    """The 17-label latency bucket, first match wins (see constants.LATENCY_BUCKETS)."""
    negative = seconds <= 0 if opts.zero_in_negative_bucket else seconds < 0
    expr = F.when(seconds.isNull(), F.lit(C.MISSING_BUCKET)).when(negative, F.lit(C.NEGATIVE_BUCKET))
    for label, bound in C.LATENCY_BUCKETS:
        expr = expr.when(seconds <= F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(C.OVERFLOW_BUCKET))


def mask_id(c: Column, opts: Options = RECORD) -> Column:
    """P20: six stars then characters 7-9 (record) or the last three (port)."""
    tail = F.substring(c, 7, 3) if opts.mask == "substr" else F.substring(c, -3, 3)
    return F.concat(F.lit(C.MASK_PREFIX), tail)


def ceil_minutes(seconds: Column) -> Column:
    """Whole minutes, rounded up."""
    return F.ceil(seconds / F.lit(60.0)).cast("long")


def control_code(passed: Column, pass_code: str = C.PASS_CODE, fail_code: str = C.FAIL_CODE) -> Column:
    """pass/fail result code from a boolean."""
    return F.when(passed, F.lit(pass_code)).otherwise(F.lit(fail_code))


def is_blank(c: Column) -> Column:
    """NULL and '' (and whitespace) are both blank."""
    return F.coalesce(F.trim(c), F.lit("")) == ""


def blank_label(c: Column) -> Column:
    """P25: 'Blank' / 'Not Blank'."""
    return F.when(is_blank(c), F.lit("Blank")).otherwise(F.lit("Not Blank"))


def lookup(c: Column, mapping: dict[str, str]) -> Column:
    """Code -> text from a small parameter dict, as a map literal (no join); NULL if unknown."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), c)
