"""StructTypes for every shape that crosses an operator boundary."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# Fixed value: Avro schema of one transaction message (field names, types,
# order and defaults decide the wire bytes).  ``logicalType`` sits beside the
# field type, so Avro ignores it and ``timestamp`` stays a plain long of
# epoch milliseconds.
TRANSACTION_AVRO = json.dumps({
    "type": "record",
    "name": "Transaction",
    "fields": [
        {"name": "transaction_id", "type": "string"},
        {"name": "user_id", "type": "string"},
        {"name": "amount", "type": "double"},
        {"name": "currency", "type": "string"},
        {"name": "merchant", "type": "string"},
        {"name": "category", "type": ["null", "string"], "default": None},
        {"name": "timestamp", "type": "long", "logicalType": "timestamp-millis"},
        {"name": "country", "type": "string"},
        {"name": "device_type", "type": "string"},
        {"name": "is_fraud", "type": "boolean", "default": False},
    ],
})

_SPARK = {"string": T.StringType(), "double": T.DoubleType(), "long": T.LongType(), "boolean": T.BooleanType()}


def _struct(schema_json: str) -> T.StructType:
    """The record's fields; a union with null is a nullable field."""
    out = T.StructType()
    for f in json.loads(schema_json)["fields"]:
        kinds = f["type"] if isinstance(f["type"], list) else [f["type"]]
        out.add(f["name"], _SPARK[next(k for k in kinds if k != "null")], "null" in kinds)
    return out


TRANSACTION = _struct(TRANSACTION_AVRO)

# Column names and order of the flag and feature records.
FLAGGED_IMMEDIATE_COLUMNS = [
    "transaction_id", "user_id", "amount", "currency", "merchant",
    "timestamp", "fraud_reason", "rule_score", "is_fraud",
]

FEATURE_COLUMNS = [
    "window", "user_id", "window_amount", "window_count",
    "avg_amount", "max_amount", "velocity",
]

FLAGGED_WINDOWED_COLUMNS = FEATURE_COLUMNS + ["fraud_reason", "rule_score"]

WINDOW = T.StructType([
    T.StructField("start", T.TimestampType(), True),
    T.StructField("end", T.TimestampType(), True),
])

# Both flag shapes share one topic, so a reader needs the union of columns.
FLAG_SUPERSET = T.StructType([
    T.StructField("transaction_id", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("currency", T.StringType(), True),
    T.StructField("merchant", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("fraud_reason", T.StringType(), True),
    T.StructField("rule_score", T.DoubleType(), True),
    T.StructField("is_fraud", T.BooleanType(), True),
    T.StructField("window", WINDOW, True),
    T.StructField("window_amount", T.DoubleType(), True),
    T.StructField("window_count", T.LongType(), True),
    T.StructField("avg_amount", T.DoubleType(), True),
    T.StructField("max_amount", T.DoubleType(), True),
    T.StructField("velocity", T.DoubleType(), True),
])

CORRUPT_COLUMN = "_corrupt_record"

FLAG_SUPERSET_WITH_CORRUPT = T.StructType(
    FLAG_SUPERSET.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
)

