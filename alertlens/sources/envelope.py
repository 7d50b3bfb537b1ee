"""Scans over event-envelope tables (S1-S4, S7) with the job's filters (F1-F8).

Account, customer and decision keys are cleaned here (P10): a blank or whitespace-only key is a
missing key, in every preset.

Plain-column predicates (activity type, partition text, envelope time) are applied first,
so they reach the Parquet scan as pushed filters / partition filters; the map column is
parsed once per document with ``from_json`` (behind a Generate barrier, see
``_parse_documents``) and projected away at once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlens.functions import constants as C
from alertlens.functions.calendar import ReportWindow
from alertlens.functions.scalars import attr, blank_to_null, ntz, safe_decimal, safe_ts
from alertlens.options import RECORD, Options
from alertlens.sources import schemas as SC


Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Sources:
    """The four envelope inputs of one run."""

    decisions: DataFrame
    preferences_initial: DataFrame
    preferences_incremental: DataFrame
    deliveries: DataFrame

    @classmethod
    def from_tables(cls, spark: SparkSession, catalog: str | None, schema: str, names: dict) -> "Sources":
        """Catalog.schema-qualified table names, keyed like the dataclass fields."""
        prefix = f"{catalog}.{schema}" if catalog else schema
        return cls(**{k: spark.table(f"{prefix}.{v}") for k, v in names.items()})

    @classmethod
    def from_paths(cls, spark: SparkSession, paths: dict) -> "Sources":
        return cls(**{k: spark.read.schema(SC.ENVELOPE_SCHEMA).parquet(v) for k, v in paths.items()})


def _json(key: str, schema) -> Column:
    return F.from_json(attr(key), schema)


def _variant_fields(v: str, schema) -> Column:
    """The schema's fields as texts out of a VARIANT column: the key itself, then its other
    spellings.  Every lookup walks the parsed document; nothing is parsed again."""
    def field(name: str) -> Column:
        paths = (name, *SC.OTHER_KEYS.get(name, ()))
        return F.coalesce(*[F.try_variant_get(F.col(v), f"$.{p}", "string") for p in paths])

    return F.struct(*[field(f.name).alias(f.name) for f in schema])


def _parse_documents(df: DataFrame, keep, payload_schema, opts: Options = RECORD) -> DataFrame:
    """Parse the header and the payload document once per row.

    The parsed values come out of a one-element ``inline`` (a Generate node).  Predicates
    on parsed fields (alert type, product type) then stay above it: without that barrier
    Catalyst pushes them below the projection and splits every filtered field into its own
    ``from_json`` call, so the payload would be parsed once per filtered field plus once for
    the projection (3 parses instead of 1 here; about 2x the scan time).  Predicates on the
    plain envelope columns are applied before, and still reach the Parquet scan.

    With the 'variant' option the payload is parsed into a VARIANT instead, once as well, and its
    fields are found under any known spelling of their keys; a malformed document gives NULLs."""
    as_variant = opts.payload == "variant"
    docs = F.struct(
        attr(C.KEY_PROCESS_TS).alias("_proc"),
        attr(C.KEY_SRC_EVENT_TS).alias("_src"),
        _json(C.KEY_HEADER, SC.HEADER_SCHEMA).alias("h"),
        (F.try_parse_json(attr(C.KEY_PAYLOAD)) if as_variant else _json(C.KEY_PAYLOAD, payload_schema)).alias("p"),
    )
    parsed = df.select(*keep, F.inline(F.array(docs)))
    if as_variant:
        parsed = parsed.select(*keep, "_proc", "_src", "h", _variant_fields("p", payload_schema).alias("p"))
    return parsed


def event_window(df: DataFrame, col: str, start, end_bound, inclusive_end: bool) -> DataFrame:
    """BETWEEN start AND end bound (inclusive), or half-open."""
    c = F.col(col)
    if inclusive_end:
        return df.where(c.between(F.lit(start), F.lit(end_bound)))
    return df.where((c >= F.lit(start)) & (c < F.lit(end_bound)))


def partition_cutoff(df: DataFrame, after: str | None = None, equals: str | None = None,
                     col: str = "partition_date") -> DataFrame:
    """filter on the raw ``yyyyMMdd`` partition text, so that partitions prune."""
    if after is not None:
        df = df.where(F.col(col) > F.lit(after))
    if equals is not None:
        df = df.where(F.col(col) == F.lit(equals))
    return df


def _lit_ts(d):
    return ntz(d)


def scan_decisions(env: DataFrame, window: ReportWindow | None = None, opts: Options = RECORD) -> DataFrame:
    """Decisions of the reporting week, 16 typed columns."""
    df = resolved(env).where(F.col("event_activity_type") == C.ACTIVITY_DECISION)
    if window is not None:
        df = partition_cutoff(df, after=window.partition_cutoff)
        if opts.time_source == "envelope":
            df = event_window(df, "event_timestamp", _lit_ts(window.start_ts), _lit_ts(window.end_bound), opts.inclusive_end)
    parsed = _parse_documents(df, ["event_activity_type", "source_event_id", "partition_date"], SC.DECISION_SCHEMA, opts)
    out = parsed.select(
        "event_activity_type", "source_event_id", "partition_date",
        safe_ts(F.col("_proc"), opts.offsets).alias("process_ts"),
        safe_ts(F.col("_src"), opts.offsets).alias("source_event_ts"),
        F.col("h.eventId").alias("event_id"),
        safe_ts(F.col("h.eventTimestamp"), opts.offsets).alias("event_ts"),
        blank_to_null(F.col("p.accountId")).alias("account_id"),
        F.col("p.alertType").alias("alert_type"),
        safe_decimal(F.col("p.thresholdAmount")).alias("threshold_amount"),
        blank_to_null(F.col("p.customerID")).alias("customer_id"),
        F.col("p.accountCurrency").alias("account_currency"),
        safe_decimal(F.col("p.creditLimit")).alias("credit_limit"),
        F.col("p.maskedAccount").alias("masked_account"),
        blank_to_null(F.col("p.decisionId")).alias("decision_id"),
        safe_decimal(F.col("p.alertAmount")).alias("alert_amount"),
    ).where(F.col("alert_type") == C.ALERT_TYPE)
    if window is not None and opts.time_source == "header":
        out = event_window(out, "event_ts", _lit_ts(window.start_ts), _lit_ts(window.end_bound), opts.inclusive_end)
    return out


def _scan_preferences(df: DataFrame, opts: Options, keep: Step | None = None) -> DataFrame:
    df = df.where(F.col("event_activity_type").isin(*C.PREFERENCE_ACTIVITIES))
    if keep is not None:  # before the documents are parsed
        df = keep(df)
    parsed = _parse_documents(
        df, ["event_timestamp", "event_channel_type", "event_activity_type", "partition_date", "source_event_id"],
        SC.PREFERENCE_SCHEMA, opts)
    return parsed.select(
        F.col("event_timestamp").alias("envelope_ts_p"),
        F.col("event_channel_type").alias("event_channel_type_p"),
        F.col("event_activity_type").alias("event_activity_type_p"),
        F.col("partition_date").alias("partition_date_p"),
        safe_ts(F.col("_proc"), opts.offsets).alias("process_ts_p"),
        safe_ts(F.col("_src"), opts.offsets).alias("source_event_ts_p"),
        safe_ts(F.col("h.eventTimestamp"), opts.offsets).alias("event_ts_p"),
        F.col("h.eventActivityName").alias("event_activity_name_p"),
        F.col("p.preferenceType").alias("preference_type_p"),
        blank_to_null(F.col("p.clientID")).alias("client_id_p"),
        F.col("p.isBusiness").alias("is_business_p"),
        F.col("p.sendAlertEligible").alias("send_alert_eligible_p"),
        F.col("p.active").alias("active_p"),
        F.col("p.threshold").alias("threshold_p"),
        blank_to_null(F.col("p.custID")).alias("cust_id_p"),
        blank_to_null(F.col("p.account")).alias("account_p"),
        F.col("p.maskAccountNo").alias("masked_account_no_p"),
        blank_to_null(F.col("p.externalAccount")).alias("external_account_p"),
        F.col("p.productType").alias("product_type_p"),
        F.col("source_event_id").alias("source_event_id_p"),
    ).where((F.col("preference_type_p") == C.ALERT_TYPE) & F.col("product_type_p").isin(*opts.product_types))


def scan_preferences_initial(env: DataFrame, window: ReportWindow | None = None, opts: Options = RECORD,
                             keep: Step | None = None) -> DataFrame:
    """The initial preference load (one fixed partition)."""
    env = resolved(env)
    if opts.initial_partition is not None:
        env = partition_cutoff(env, equals=opts.initial_partition)
    return _scan_preferences(env, opts, keep)


def scan_preferences_incremental(env: DataFrame, window: ReportWindow | None = None, opts: Options = RECORD,
                                 keep: Step | None = None) -> DataFrame:
    """S3: incremental preferences, bounded by event time."""
    env = resolved(env)
    if window is not None:
        bound = _lit_ts(window.end_bound)
        t = F.col("event_timestamp")
        if opts.pref_bound == "after_window":
            env = env.where(t > bound)
        else:
            env = env.where(t <= bound if opts.inclusive_end else t < bound)
    return _scan_preferences(env, opts, keep)


def union_preferences(initial: DataFrame, incremental: DataFrame, distinct: bool = True) -> DataFrame:
    """UNION of both loads.  The map column is already projected away, so the
    set operation is legal.  ``distinct=False`` is used inside ``build_final``: an exact
    duplicate preference row can never change which preference is picked (ties carry the
    same values), so the extra full shuffle of the distinct buys nothing there."""
    u = initial.unionByName(incremental)
    return u.distinct() if distinct else u


def scan_preferences(sources: Sources, window: ReportWindow | None = None, opts: Options = RECORD,
                     distinct: bool = True, keep: Step | None = None) -> DataFrame:
    """Both loads.  ``keep`` filters the envelope rows of either before their documents are parsed."""
    return union_preferences(
        scan_preferences_initial(sources.preferences_initial, window, opts, keep),
        scan_preferences_incremental(sources.preferences_incremental, window, opts, keep),
        distinct,
    )


def _delivery_window(df: DataFrame, col: str, window: ReportWindow, opts: Options) -> DataFrame:
    """after the window start, or with the bounded option the half-open [start, end + 1 day)."""
    if opts.delivery_upper_bound:
        return event_window(df, col, _lit_ts(window.start_ts), _lit_ts(window.end_bound), inclusive_end=False)
    return df.where(F.col(col) > _lit_ts(window.start_ts))


def scan_deliveries(env: DataFrame, window: ReportWindow | None = None, opts: Options = RECORD) -> DataFrame:
    """Delivery-audit records after the window start (no upper bound in the record)."""
    df = resolved(env).where(F.col("event_activity_type") == C.ACTIVITY_DELIVERY)
    if window is not None and opts.time_source == "envelope":
        df = _delivery_window(df, "event_timestamp", window, opts)
    parsed = _parse_documents(
        df, ["event_activity_type", "source_event_id", "partition_date", "event_timestamp"], SC.DELIVERY_SCHEMA, opts)
    out = parsed.select(
        safe_ts(F.col("_proc"), opts.offsets).alias("process_ts_a"),
        F.col("event_activity_type").alias("event_activity_type_a"),
        F.col("source_event_id").alias("source_event_id_a"),
        F.col("partition_date").alias("partition_date_a"),
        F.col("event_timestamp").alias("envelope_ts_a"),
        F.col("h.eventId").alias("event_id_a"),
        safe_ts(F.col("h.eventTimestamp"), opts.offsets).alias("event_ts_a"),
        F.col("h.eventActivityName").alias("event_activity_name_a"),
        F.col("p.alertSent").alias("alert_sent_a"),
        F.col("p.sendInbox").alias("send_inbox_a"),
        F.col("p.alertType").alias("alert_type_a"),
        safe_decimal(F.col("p.thresholdAmount")).alias("threshold_amount_a"),
        F.col("p.sendSMS").alias("send_sms_a"),
        F.col("p.sendPush").alias("send_push_a"),
        F.col("p.maskedAccount").alias("masked_account_a"),
        F.col("p.reasonCode").alias("reason_code_a"),
        blank_to_null(F.col("p.decisionId")).alias("decision_id_a"),
        safe_decimal(F.col("p.alertAmount")).alias("alert_amount_a"),
        blank_to_null(F.col("p.accountID")).alias("account_id_a"),
        blank_to_null(F.col("p.account")).alias("account_a"),
        F.col("p.accountProduct").alias("account_product_a"),
        F.col("p.sendEmail").alias("send_email_a"),
    ).where(F.col("alert_type_a") == C.ALERT_TYPE)
    if window is not None and opts.time_source == "header":
        out = _delivery_window(out, "event_ts_a", window, opts)
    if opts.delivery_require_id:
        out = out.where(F.col("decision_id_a").isNotNull())
    return out


def pick_column(df: DataFrame, candidates) -> str | None:
    """First candidate name present in the frame, whatever its case and underscores (driver
    side, schema only)."""
    names = {_plain(c): c for c in reversed(df.columns)}
    for cand in candidates:
        if _plain(cand) in names:
            return names[_plain(cand)]
    return None


def _plain(name: str) -> str:
    return name.replace("_", "").strip().lower()


def resolved(env: DataFrame) -> DataFrame:
    """An envelope table under the names the scans use: each column by its own name, else the
    first of its other names that the table has.  Renaming is a projection, so filters still reach
    the scan.  A table without one of the columns is refused by name."""
    if all(f.name in env.columns for f in SC.ENVELOPE_SCHEMA):
        return env
    found = {f.name: pick_column(env, (f.name, *SC.ENVELOPE_NAMES[f.name])) for f in SC.ENVELOPE_SCHEMA}
    missing = sorted(n for n, c in found.items() if c is None)
    if missing:
        raise ValueError(f"envelope table without {', '.join(missing)}; it has {', '.join(env.columns)}")
    return env.select(*[F.col(f"`{c}`").alias(n) for n, c in found.items()])
