"""Declared schemas. Column names, order, types and nullability."""

from pyspark.sql import types as T

_s, _ntz = T.StringType(), T.TimestampNTZType()

MESSAGES = T.StructType([
    T.StructField("email_id", _s, False),
    T.StructField("sender", _s, False),
    T.StructField("recipient", _s, False),
    T.StructField("cc", _s),
    T.StructField("subject", _s),
    T.StructField("body", _s),
    T.StructField("sent_at", _ntz, False),
    T.StructField("sender_dept", _s),
    T.StructField("recipient_dept", _s),
    T.StructField("compliance_label", _s),
])
MESSAGE_KEY = "email_id"

TRAINING_PAIRS = T.StructType([
    T.StructField("prompt", _s),
    T.StructField("completion", _s),
])

ANALYSIS = T.StructType([
    T.StructField("is_violation", T.BooleanType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("category", _s),
    T.StructField("reasoning", _s),
])

WRITTEN_MESSAGE = T.StructType([
    T.StructField("subject", _s),
    T.StructField("body", _s),
])

LOADED_AT = "loaded_at"
REJECT_REASON = "reject_reason"

# Longest value allowed per column, for the optional length check.
MESSAGE_LENGTHS = {
    "email_id": 36, "sender": 100, "recipient": 100, "cc": 500, "subject": 500,
    "body": 16777216, "sender_dept": 50, "recipient_dept": 50, "compliance_label": 50,
}
