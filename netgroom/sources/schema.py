"""Columns of the raw, clean and reply tables."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_COLUMNS = ["source_row_id", "ip", "hostname", "fqdn", "mac", "owner", "device_type", "site", "notes"]
RAW_FIELDS = RAW_COLUMNS[1:-1]

# Texts that mean "no value" in a raw file, matched exactly.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

STEP = T.StructType(
    [
        T.StructField("field", T.StringType()),
        T.StructField("from", T.StringType()),
        T.StructField("to", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)

CLEAN = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("ip_valid", T.BooleanType()),
        T.StructField("ip_type", T.StringType()),
        T.StructField("subnet_cidr", T.StringType()),
        T.StructField("hostname", T.StringType()),
        T.StructField("hostname_valid", T.BooleanType()),
        T.StructField("fqdn", T.StringType()),
        T.StructField("fqdn_consistent", T.StringType()),
        T.StructField("reverse_ptr", T.StringType()),
        T.StructField("mac", T.StringType()),
        T.StructField("mac_valid", T.BooleanType()),
        T.StructField("owner", T.StringType()),
        T.StructField("owner_email", T.StringType()),
        T.StructField("owner_team", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("device_type_confidence", T.LongType()),
        T.StructField("site", T.StringType()),
        T.StructField("site_normalized", T.StringType()),
        T.StructField("source_row_id", T.LongType()),
        T.StructField("normalization_steps", T.ArrayType(STEP)),
    ]
)

OWNER_COLUMNS = ["owner", "owner_team", "owner_email"]
ANOMALY_INPUT_COLUMNS = [
    "source_row_id", "ip", "ip_valid", "ip_type", "subnet_cidr", "hostname", "hostname_valid",
    "fqdn", "reverse_ptr", "mac", "mac_valid", "device_type", "site_normalized",
]

OWNER_REPLY = T.StructType(
    [T.StructField(c, T.MapType(T.StringType(), T.StringType())) for c in OWNER_COLUMNS]
    + [T.StructField("confidence_percentage", T.MapType(T.StringType(), T.DoubleType()))]
)

ANOMALY = T.StructType(
    [
        T.StructField("source_row_id", T.LongType()),
        T.StructField("affected_fields", T.ArrayType(T.StringType())),
        T.StructField("issue_type", T.StringType()),
        T.StructField("recommended_action", T.StringType()),
        T.StructField("anomaly_confidence", T.LongType()),
    ]
)
