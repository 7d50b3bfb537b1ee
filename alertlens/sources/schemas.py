"""Schemas of the envelope tables and of the JSON documents held in their map column.

Fixed values: the JSON key names below are those the upstream feeds use; keys are
case-sensitive and differ by feed (``accountId`` in decisions, ``accountID`` in deliveries).
One struct of strings per feed: every field is parsed once with ``from_json`` and cast
afterwards with ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import types as T

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("event_activity_type", T.StringType()),
        T.StructField("event_channel_type", T.StringType()),
        T.StructField("source_event_id", T.StringType()),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("partition_date", T.StringType()),
        T.StructField("eventAttributes", T.MapType(T.StringType(), T.StringType())),
    ]
)

# fixed values: JSON keys per document
HEADER_FIELDS = ("eventId", "eventTimestamp", "eventActivityName")
DECISION_FIELDS = (
    "accountId", "alertType", "thresholdAmount", "customerID", "accountCurrency",
    "creditLimit", "maskedAccount", "decisionId", "alertAmount",
)
PREFERENCE_FIELDS = (
    "preferenceType", "clientID", "isBusiness", "sendAlertEligible", "active", "threshold",
    "custID", "account", "maskAccountNo", "externalAccount", "productType",
)
DELIVERY_FIELDS = (
    "alertSent", "sendInbox", "alertType", "thresholdAmount", "sendSMS", "sendPush",
    "maskedAccount", "reasonCode", "decisionId", "alertAmount", "accountID", "account",
    "accountProduct", "sendEmail",
)


# fixed values: other spellings of a key in some feeds, tried in this order after the key itself
OTHER_KEYS = {"customerID": ("customerId",), "maskAccountNo": ("maskedAccountNo",)}

#: Other names of the envelope's columns; matching ignores case and underscores.
ENVELOPE_NAMES = {
    "event_activity_type": ("activity_type",),
    "event_channel_type": ("channel_type",),
    "source_event_id": (),
    "event_timestamp": ("event_ts",),
    "partition_date": ("process_date",),
    "eventAttributes": ("attributes",),
}


def string_struct(fields) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


HEADER_SCHEMA = string_struct(HEADER_FIELDS)
DECISION_SCHEMA = string_struct(DECISION_FIELDS)
PREFERENCE_SCHEMA = string_struct(PREFERENCE_FIELDS)
DELIVERY_SCHEMA = string_struct(DELIVERY_FIELDS)

DEC12 = T.DecimalType(12, 2)

# Canonical (extracted) feeds.  ``event_ts*`` is always the header's event time (the one
# the job computes with); ``envelope_ts*`` is the envelope column the scans filter on.
DECISION_COLUMNS = (
    "event_activity_type", "source_event_id", "partition_date", "process_ts",
    "source_event_ts", "event_id", "event_ts", "account_id", "alert_type", "threshold_amount",
    "customer_id", "account_currency", "credit_limit", "masked_account", "decision_id",
    "alert_amount",
)
PREFERENCE_COLUMNS = (
    "envelope_ts_p", "event_channel_type_p", "event_activity_type_p", "partition_date_p",
    "process_ts_p", "source_event_ts_p", "event_ts_p", "event_activity_name_p",
    "preference_type_p", "client_id_p", "is_business_p", "send_alert_eligible_p", "active_p",
    "threshold_p", "cust_id_p", "account_p", "masked_account_no_p", "external_account_p",
    "product_type_p", "source_event_id_p",
)
DELIVERY_COLUMNS = (
    "process_ts_a", "event_activity_type_a", "source_event_id_a", "partition_date_a",
    "envelope_ts_a", "event_id_a", "event_ts_a", "event_activity_name_a", "alert_sent_a",
    "send_inbox_a", "alert_type_a", "threshold_amount_a", "send_sms_a", "send_push_a",
    "masked_account_a", "reason_code_a", "decision_id_a", "alert_amount_a", "account_id_a",
    "account_a", "account_product_a", "send_email_a",
)
