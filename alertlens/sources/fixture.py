"""Adapter from the driver's ``events`` table to the job's three feeds (FIXTURES.md §2).

Two forms of the same rows:

* flat feeds (``decisions``, ``preferences_initial``, ``preferences_incremental``,
  ``deliveries``) with the canonical extracted columns, and
* envelope tables (``envelope_sources``): the same values wrapped into the event envelope
  (a string map whose values are timestamps and JSON documents), so that the production
  scans in ``sources.envelope`` can be run on them.  Scanning the envelope tables without a
  reporting window gives back exactly the flat feeds.

Mapping (fixed by the fixture): purchase -> decision; signup -> initial preference (all in the
fixed initial-load partition); click -> incremental preference; view -> delivery; error -> noise
that every scan must drop.  The weekly decision id is ``user_id-<Monday yyyyMMdd>``.  Some events
have no usable key: by ``event_id % 40`` (7, 17, 27) the account, customer and decision id are an
empty text, spaces or NULL, which all mean a missing key.  Some deliveries fall on midnight.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlens.functions import constants as C
from alertlens.functions.scalars import blank_to_null
from alertlens.sources.envelope import Sources

# fixed values of the fixture mapping
NOISE_ALERT_TYPE = "LOW_BALANCE"
NOISE_PRODUCT_TYPE = "DEBIT_CARD"
CHANNEL = "ONLINE"
CURRENCY = "CAD"
FIXTURE_REPORT_DATE = dt.date(2024, 1, 31)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _k() -> Column:
    return F.get_json_object(F.col("props"), "$.k")


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _monday(ts: Column) -> Column:
    return F.next_day(F.date_sub(F.to_date(ts), 7), "Mon")


def _raw(c: Column) -> Column:
    """A key as the feed has it: some are blank or missing."""
    k = F.col("event_id") % 40
    return F.when(k == 7, F.lit("")).when(k == 17, F.lit("   ")).when(k == 27, F.lit(None).cast("string")).otherwise(c)


def _raw_decision_id() -> Column:
    return _raw(F.concat(_text("user_id"), F.lit("-"), F.date_format(_monday(F.col("ts")), "yyyyMMdd")))


def _raw_customer() -> Column:
    return _raw(F.lpad(_text("user_id"), 9, "0"))


def _raw_account() -> Column:
    return _raw(_text("user_id"))


def _weekly_decision_id() -> Column:
    return blank_to_null(_raw_decision_id())


def _customer() -> Column:
    return blank_to_null(_raw_customer())


def _account() -> Column:
    return blank_to_null(_raw_account())


def _dec12(c: Column) -> Column:
    return c.try_cast("decimal(12,2)")


def _is_business() -> Column:
    return F.when(_k().cast("int") % 2 == 0, F.lit("true")).otherwise(F.lit("false"))


def _ymd(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def _null_s() -> Column:
    return F.lit(None).cast("string")


# ---- flat feeds -----------------------------------------------------------------------------


def decisions(events: DataFrame) -> DataFrame:
    ev = events.where(F.col("event_type") == "purchase")
    return ev.select(
        F.lit(C.ACTIVITY_DECISION).alias("event_activity_type"),
        _text("event_id").alias("source_event_id"),
        _ymd(F.col("ts")).alias("partition_date"),
        F.col("ts").alias("process_ts"),
        F.col("ts").alias("source_event_ts"),
        _text("event_id").alias("event_id"),
        F.col("ts").alias("event_ts"),
        _account().alias("account_id"),
        F.lit(C.ALERT_TYPE).alias("alert_type"),
        _dec12(_k()).alias("threshold_amount"),
        _customer().alias("customer_id"),
        F.lit(CURRENCY).alias("account_currency"),
        F.lit(None).cast("decimal(12,2)").alias("credit_limit"),
        _null_s().alias("masked_account"),
        _weekly_decision_id().alias("decision_id"),
        _dec12(F.col("value")).alias("alert_amount"),
    )


def _preferences(ev: DataFrame, activity: str, partition: Column) -> DataFrame:
    return ev.select(
        F.col("ts").alias("envelope_ts_p"),
        F.lit(CHANNEL).alias("event_channel_type_p"),
        F.lit(activity).alias("event_activity_type_p"),
        partition.alias("partition_date_p"),
        F.col("ts").alias("process_ts_p"),
        F.col("ts").alias("source_event_ts_p"),
        F.col("ts").alias("event_ts_p"),
        F.lit(activity).alias("event_activity_name_p"),
        F.lit(C.ALERT_TYPE).alias("preference_type_p"),
        _customer().alias("client_id_p"),
        _is_business().alias("is_business_p"),
        F.lit("true").alias("send_alert_eligible_p"),
        F.lit("true").alias("active_p"),
        _k().alias("threshold_p"),
        _customer().alias("cust_id_p"),
        _account().alias("account_p"),
        _null_s().alias("masked_account_no_p"),
        _account().alias("external_account_p"),
        F.lit(C.PRODUCT_TYPE).alias("product_type_p"),
        _text("event_id").alias("source_event_id_p"),
    )


def preferences_initial(events: DataFrame) -> DataFrame:
    ev = events.where(F.col("event_type") == "signup")
    return _preferences(ev, C.ACTIVITY_PREF_CREATE, F.lit(C.INITIAL_LOAD_PARTITION))


def preferences_incremental(events: DataFrame) -> DataFrame:
    ev = events.where(F.col("event_type") == "click")
    return _preferences(ev, C.ACTIVITY_PREF_UPDATE, _ymd(F.col("ts")))


def preferences(events: DataFrame) -> DataFrame:
    return preferences_initial(events).unionByName(preferences_incremental(events))


def _on_the_hour(events: DataFrame) -> DataFrame:
    """Some deliveries (``event_id % 40 = 3``) fall exactly on midnight, where windows start."""
    at = F.when((F.col("event_id") % 40 == 3) & (F.col("event_type") == "view"), F.to_date("ts").cast("timestamp_ntz"))
    return events.withColumn("ts", at.otherwise(F.col("ts")))


def deliveries(events: DataFrame) -> DataFrame:
    ev = _on_the_hour(events).where(F.col("event_type") == "view")
    return ev.select(
        F.col("ts").alias("process_ts_a"),
        F.lit(C.ACTIVITY_DELIVERY).alias("event_activity_type_a"),
        _text("event_id").alias("source_event_id_a"),
        _ymd(F.col("ts")).alias("partition_date_a"),
        F.col("ts").alias("envelope_ts_a"),
        _text("event_id").alias("event_id_a"),
        F.col("ts").alias("event_ts_a"),
        F.lit(C.ACTIVITY_DELIVERY).alias("event_activity_name_a"),
        F.lit("true").alias("alert_sent_a"),
        F.lit("true").alias("send_inbox_a"),
        F.lit(C.ALERT_TYPE).alias("alert_type_a"),
        _dec12(_k()).alias("threshold_amount_a"),
        F.lit("false").alias("send_sms_a"),
        F.lit("true").alias("send_push_a"),
        _null_s().alias("masked_account_a"),
        _null_s().alias("reason_code_a"),
        _weekly_decision_id().alias("decision_id_a"),
        _dec12(F.col("value")).alias("alert_amount_a"),
        _account().alias("account_id_a"),
        _account().alias("account_a"),
        F.lit(C.PRODUCT_TYPE).alias("account_product_a"),
        F.lit("false").alias("send_email_a"),
    )


# ---- envelope form --------------------------------------------------------------------------


def _iso_tz(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _iso_space(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _envelope(ev: DataFrame, activity: str, payload: Column, partition: Column | None = None) -> DataFrame:
    header = F.to_json(
        F.struct(
            _text("event_id").alias("eventId"),
            _iso_tz(F.col("ts")).alias("eventTimestamp"),
            F.lit(activity).alias("eventActivityName"),
        )
    )
    attrs = F.create_map(
        F.lit(C.KEY_PROCESS_TS), _iso_tz(F.col("ts")),
        F.lit(C.KEY_SRC_EVENT_TS), _iso_space(F.col("ts")),
        F.lit(C.KEY_HEADER), header,
        F.lit(C.KEY_PAYLOAD), F.to_json(payload),
    )
    return ev.select(
        F.lit(activity).alias("event_activity_type"),
        F.lit(CHANNEL).alias("event_channel_type"),
        _text("event_id").alias("source_event_id"),
        F.col("ts").alias("event_timestamp"),
        (_ymd(F.col("ts")) if partition is None else partition).alias("partition_date"),
        attrs.alias("eventAttributes"),
    )


def _kv() -> Column:
    return _k().cast("int")


def _spelled(c: Column, key: str, other: str, own_keys: bool) -> list[Column]:
    """A payload field under its key, or for every second event under the other spelling."""
    if not own_keys:
        return [c.alias(key)]
    even = F.col("event_id") % 2 == 0
    return [F.when(~even, c).alias(key), F.when(even, c).alias(other)]


def _decision_payload(alert_type: Column, own_keys: bool = False) -> Column:
    return F.struct(
        _raw_account().alias("accountId"),
        alert_type.alias("alertType"),
        _kv().alias("thresholdAmount"),
        *_spelled(_raw_customer(), "customerID", "customerId", own_keys),
        F.lit(CURRENCY).alias("accountCurrency"),
        _raw_decision_id().alias("decisionId"),
        F.col("value").alias("alertAmount"),
    )


def _preference_payload(product: Column, own_keys: bool = False) -> Column:
    masked = _spelled(F.right(_account(), F.lit(4)), "maskAccountNo", "maskedAccountNo", True) if own_keys else []
    return F.struct(
        *masked,
        F.lit(C.ALERT_TYPE).alias("preferenceType"),
        _raw_customer().alias("clientID"),
        (_kv() % 2 == 0).alias("isBusiness"),  # a JSON boolean; extracts as 'true'/'false'
        F.lit(True).alias("sendAlertEligible"),
        F.lit(True).alias("active"),
        _kv().alias("threshold"),
        _raw_customer().alias("custID"),
        _raw_account().alias("account"),
        _raw_account().alias("externalAccount"),
        product.alias("productType"),
    )


def _delivery_payload(alert_type: Column) -> Column:
    return F.struct(
        F.lit(True).alias("alertSent"),
        F.lit(True).alias("sendInbox"),
        alert_type.alias("alertType"),
        _kv().alias("thresholdAmount"),
        F.lit(False).alias("sendSMS"),
        F.lit(True).alias("sendPush"),
        _raw_decision_id().alias("decisionId"),
        F.col("value").alias("alertAmount"),
        _raw_account().alias("accountID"),
        _raw_account().alias("account"),
        F.lit(C.PRODUCT_TYPE).alias("accountProduct"),
        F.lit(False).alias("sendEmail"),
    )


def envelope_sources(events: DataFrame, own_keys: bool = False) -> Sources:
    """The four envelope inputs, each with the 'error' events mixed in as noise that only
    the payload predicates (alert type / product type) remove.  One scan per table.  With
    ``own_keys`` every second document uses the other spellings of keys and product type."""
    et = F.col("event_type")
    noise = et == "error"
    alert = F.when(noise, F.lit(NOISE_ALERT_TYPE)).otherwise(F.lit(C.ALERT_TYPE))
    usual = F.lit(C.PRODUCT_TYPE)
    if own_keys:
        usual = F.when(F.col("event_id") % 2 == 0, F.lit(C.THIRD_PRODUCT_TYPE)).otherwise(usual)
    product = F.when(noise, F.lit(NOISE_PRODUCT_TYPE)).otherwise(usual)
    dec = _envelope(events.where(et.isin("purchase", "error")), C.ACTIVITY_DECISION, _decision_payload(alert, own_keys))
    ini = _envelope(events.where((et == "signup") | noise), C.ACTIVITY_PREF_CREATE, _preference_payload(product, own_keys),
                    F.when(noise, _ymd(F.col("ts"))).otherwise(F.lit(C.INITIAL_LOAD_PARTITION)))
    inc = _envelope(events.where((et == "click") | noise), C.ACTIVITY_PREF_UPDATE, _preference_payload(product, own_keys))
    dlv = _envelope(_on_the_hour(events).where(et.isin("view", "error")), C.ACTIVITY_DELIVERY, _delivery_payload(alert))
    return Sources(decisions=dec, preferences_initial=ini, preferences_incremental=inc, deliveries=dlv)
