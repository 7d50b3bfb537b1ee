"""Fixed values that right results need as they stand.

Fixed values: activity types, payload type filters, control texts, scorecard
constants and latency-bucket labels, stated as the job states them.
"""

# --- fixed values: envelope activity types -------------------------------------------
ACTIVITY_DECISION = "Alert Decision Cards"
ACTIVITY_PREF_CREATE = "Create Account Preference"
ACTIVITY_PREF_UPDATE = "Update Account Preference"
ACTIVITY_DELIVERY = "Alert Delivery Audit"
PREFERENCE_ACTIVITIES = (ACTIVITY_PREF_CREATE, ACTIVITY_PREF_UPDATE)

# --- fixed values: payload filters ------------------------------------------------------
ALERT_TYPE = "AVAIL_CREDIT_REMAINING"
PRODUCT_TYPE = "CREDIT_CARD"
THIRD_PRODUCT_TYPE = "CREDITCARD"
INITIAL_LOAD_PARTITION = "20220324"

# --- fixed values: map keys of eventAttributes ----------------------------------------
KEY_PROCESS_TS = "ess_process_timestamp"
KEY_SRC_EVENT_TS = "ess_src_event_timestamp"
KEY_HEADER = "SourceEventHeader"
KEY_PAYLOAD = "eventPayload"

# --- fixed values: control rows ---------------------------------------------------------
# (ControlRisk, TestType) per control; the control ids are options.
CONTROL_ACCURACY = ("Accuracy", "Sample")
CONTROL_TIMELINESS = ("Timeliness", "Anomaly")
CONTROL_COMPLETENESS = ("Completeness", "Reconciliation")
PASS_CODE = "COM16"
FAIL_CODE = "COM19"
# codes of the third preset
THIRD_PASS_CODE = "COM6"
THIRD_FAIL_CODE = "COM5"
THIRD_COMPLETE_CODE = "CON9"
THIRD_INCOMPLETE_CODE = "CON8"

# --- fixed values: scorecard constant columns -------------------------------------------
TEST_PERIOD = "Portfolio"
PRODUCT_TYPE_LABEL = "Credit Cards"
SEGMENT_PAD = "."
HOLDOUT_FLAG = "N"
ACCURACY_DECISION_LABEL = "AlertDecision"
MASK_PREFIX = "******"

# The code-to-text dimension is an input of the job; these texts are ours.
DEFAULT_COMMENTS = {
    "COM16": "Control passed",
    "COM19": "Control failed - see detail list",
}

# --- fixed values: SLA and latency buckets ----------------------------------------------
SLA_SECONDS = 1800
# (label, inclusive upper bound in seconds).  First match wins; NULL -> MISSING_BUCKET,
# negative -> NEGATIVE_BUCKET.  Bounds are 1800, 3600, 3600*2 .. 3600*10, 3600*24, *48, *72.
NEGATIVE_BUCKET = "00 - Less than 0 seconds"
MISSING_BUCKET = "99 - Timestamp is missing"
LATENCY_BUCKETS = (
    ("01 - Less than or equal to 30 minutes", 1800),
    ("02 - Greater than 30 mins and less than or equal to 60 mins", 3600),
    ("03 - Greater than 1 hour and less than or equal to 2 hours", 3600 * 2),
    ("04 - Greater than 2 hours and less than or equal to 3 hours", 3600 * 3),
    ("05 - Greater than 3 hours and less than or equal to 4 hours", 3600 * 4),
    ("06 - Greater than 4 hours and less than or equal to 5 hours", 3600 * 5),
    ("07 - Greater than 5 hours and less than or equal to 6 hours", 3600 * 6),
    ("08 - Greater than 6 hours and less than or equal to 7 hours", 3600 * 7),
    ("09 - Greater than 7 hours and less than or equal to 8 hours", 3600 * 8),
    ("10 - Greater than 8 hours and less than or equal to 9 hours", 3600 * 9),
    ("11 - Greater than 9 hours and less than or equal to 10 hours", 3600 * 10),
    ("12 - Greater than 10 hours and less than or equal to 24 hours", 3600 * 24),
    ("13 - Greater than 1 day and less than or equal to 2 days", 3600 * 48),
    ("14 - Greater than 2 days and less than or equal to 3 days", 3600 * 72),
)
OVERFLOW_BUCKET = "15 - Greater than 3 days"
ALL_BUCKETS = (NEGATIVE_BUCKET,) + tuple(b[0] for b in LATENCY_BUCKETS) + (OVERFLOW_BUCKET, MISSING_BUCKET)
