"""The registered queries: each takes a session and a directory of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netgroom.functions import (
    canonical_ipv4_type,
    clean_ipv4,
    ip_version,
    private_subnet_24,
    reverse_ptr,
)
from netgroom.operators.anomalies import all_anomalies, anomaly_input, detect_anomalies, duplicate_mac
from netgroom.operators.clean import clean_fields, clean_inventory, normalization_log
from netgroom.operators.owners import (
    correct_owner,
    high_confidence,
    merge_owner,
    propose_owner,
    unknown_proposals,
)
from netgroom.operators.payload import column_rows, owner_payloads, owner_reply_rows, payloads
from netgroom.operators.reports import (
    preview,
    quality_report,
    row_count,
    site_device_matrix,
    subnet_rollup,
)
from netgroom.operators.starter import starter_anomalies, starter_clean
from netgroom.operators.textscan import page_hosts, text_emails, text_ipv4
from netgroom.plans import features  # noqa: F401  registers its queries
from netgroom.plans.fixture import inventory, literals, proposals, read_table
from netgroom.plans.registry import Query, query, registered
from netgroom.sources.schema import OWNER_COLUMNS, OWNER_REPLY
from netgroom.sources.writers import csv_columns

def queries() -> dict[str, Query]:
    return registered()


def _fields(spark: SparkSession, sf_dir: str, field: str, *more: str) -> DataFrame:
    return clean_fields(inventory(spark, sf_dir)).select(
        "source_row_id", F.col(field).alias("raw"), F.col(f"{field}_clean").alias(field), *more
    )


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_inventory(inventory(spark, sf_dir))


def _flat_anomalies(df: DataFrame) -> DataFrame:
    return df.withColumn("affected_fields", F.array_join("affected_fields", ","))


def _starter_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table as a plain CSV reader gives it: missing texts are empty."""
    return inventory(spark, sf_dir).fillna("")


@query
def q_ip_clean(spark, sf_dir):
    return _fields(spark, sf_dir, "ip", "ip_valid", "ip_reason")


@query
def q_ip_type(spark, sf_dir):
    return clean_fields(inventory(spark, sf_dir)).select(
        "source_row_id", F.col("ip_clean").alias("ip"), "ip_type"
    )


@query
def q_ip_subnet(spark, sf_dir):
    return clean_fields(inventory(spark, sf_dir)).select(
        "source_row_id", F.col("ip_clean").alias("ip"), "subnet_cidr"
    )


@query
def q_reverse_ptr(spark, sf_dir):
    return clean_fields(inventory(spark, sf_dir)).select(
        "source_row_id", F.col("ip_clean").alias("ip"), "reverse_ptr"
    )


@query
def q_reverse_ptr6(spark, sf_dir):
    return reverse_ptr(literals(spark, sf_dir), "ip")


@query
def q_ip_version(spark, sf_dir):
    return ip_version(literals(spark, sf_dir), "ip")


@query
def q_hostname_clean(spark, sf_dir):
    return _fields(spark, sf_dir, "hostname", "hostname_valid", "hostname_reason")


@query
def q_site_clean(spark, sf_dir):
    return _fields(spark, sf_dir, "site", "site_reason")


@query
def q_fqdn_clean(spark, sf_dir):
    return _fields(spark, sf_dir, "fqdn", "fqdn_valid", "fqdn_reason", "fqdn_consistent")


@query
def q_mac_clean(spark, sf_dir):
    return _fields(spark, sf_dir, "mac", "mac_valid", "mac_reason")


@query
def q_owner_parse(spark, sf_dir):
    return _fields(spark, sf_dir, "owner", "owner_email", "owner_team", "owner_reason")


@query
def q_device_type_clean(spark, sf_dir):
    return _fields(spark, sf_dir, "device_type", "device_type_confidence", "device_type_reason")


@query
def q_inventory_clean(spark, sf_dir):
    return csv_columns(_clean(spark, sf_dir))


@query
def q_normalization_log(spark, sf_dir):
    return normalization_log(inventory(spark, sf_dir))


@query
def q_quality_report(spark, sf_dir):
    return quality_report(inventory(spark, sf_dir))


@query
def q_row_count(spark, sf_dir):
    return row_count(_clean(spark, sf_dir))


@query
def q_preview(spark, sf_dir):
    return preview(correct_owner(_clean(spark, sf_dir)).drop("normalization_steps"))


@query
def q_owner_payload(spark, sf_dir):
    """Payloads read back: every owner value must be in exactly one of them."""
    maps = T.StructType([f for f in OWNER_REPLY.fields if f.name in OWNER_COLUMNS])
    rows = column_rows(owner_payloads(_clean(spark, sf_dir)), "payload", maps)
    return rows.withColumn("source_row_id", F.col("source_row_id").cast("long"))


@query
def q_owner_response_rows(spark, sf_dir):
    replies = payloads(proposals(spark, sf_dir), OWNER_REPLY.names)
    return owner_reply_rows(replies, "payload")


@query
def q_owner_high_confidence(spark, sf_dir):
    return high_confidence(proposals(spark, sf_dir))


@query
def q_owner_propose(spark, sf_dir):
    return propose_owner(_clean(spark, sf_dir))


@query
def q_owner_correct(spark, sf_dir):
    return correct_owner(_clean(spark, sf_dir)).select("source_row_id", *OWNER_COLUMNS)


@query
def q_owner_merge(spark, sf_dir):
    merged = merge_owner(_clean(spark, sf_dir), proposals(spark, sf_dir))
    return merged.select("source_row_id", *OWNER_COLUMNS)


@query
def q_owner_merge_empty(spark, sf_dir):
    """A failed correction step leaves no proposals and the table as it is."""
    merged = merge_owner(_clean(spark, sf_dir), proposals(spark, sf_dir).where("false"))
    return merged.select("source_row_id", *OWNER_COLUMNS)


@query
def q_owner_unknown(spark, sf_dir):
    """Proposals of all orders against the devices with a valid address."""
    known = _clean(spark, sf_dir).where("ip_valid")
    return unknown_proposals(known, proposals(spark, sf_dir)).select("source_row_id", *OWNER_COLUMNS)


@query
def q_anomaly_input(spark, sf_dir):
    return anomaly_input(_clean(spark, sf_dir))


@query
def q_anomaly_rules(spark, sf_dir):
    return _flat_anomalies(detect_anomalies(_clean(spark, sf_dir)))


@query
def q_duplicate_mac(spark, sf_dir):
    return duplicate_mac(_clean(spark, sf_dir))


@query
def q_anomalies_all(spark, sf_dir):
    return _flat_anomalies(all_anomalies(_clean(spark, sf_dir)))


@query
def q_starter_clean(spark, sf_dir):
    return starter_clean(_starter_input(spark, sf_dir))


@query
def q_starter_subnet(spark, sf_dir):
    cleaned = clean_ipv4(_starter_input(spark, sf_dir).select("source_row_id", "ip"))
    ip = F.col("ip_clean")
    return cleaned.select(
        "source_row_id", canonical_ipv4_type(ip).alias("ip_type"), private_subnet_24(ip).alias("subnet_cidr")
    )


@query
def q_starter_anomalies(spark, sf_dir):
    found = starter_anomalies(_starter_input(spark, sf_dir))
    return found.select(
        "source_row_id", F.inline("issues"), F.array_join("recommended_actions", "|").alias("recommended_actions")
    )


@query
def q_subnet_rollup(spark, sf_dir):
    return subnet_rollup(_clean(spark, sf_dir))


@query
def q_site_device_matrix(spark, sf_dir):
    return site_device_matrix(_clean(spark, sf_dir))


@query
def q_text_emails(spark, sf_dir):
    return text_emails(read_table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")


@query
def q_text_ipv4(spark, sf_dir):
    return text_ipv4(read_table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")


@query
def q_page_hosts(spark, sf_dir):
    return page_hosts(read_table(spark, sf_dir, "pages", "url"), "url")
