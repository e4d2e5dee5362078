"""Anomalies by declarative rules and by shared MAC addresses."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netgroom.operators.skew import salted_lookup
from netgroom.sources.schema import ANOMALY, ANOMALY_INPUT_COLUMNS


@dataclass(frozen=True)
class Rule:
    """When ``condition`` holds, report ``fields`` with this issue, action and confidence."""

    condition: str
    fields: Sequence[str]
    issue: str
    action: str
    confidence: int


def _at_edge(octet: str) -> str:
    """Condition: all host octets of the address within its subnet are ``octet``."""
    return (
        f"(subnet_cidr LIKE '%/24' AND ip LIKE '%.{octet}')"
        f" OR (subnet_cidr LIKE '%/16' AND ip LIKE '%.{octet}.{octet}')"
        f" OR (subnet_cidr LIKE '%/8' AND ip LIKE '%.{octet}.{octet}.{octet}')"
    )


# Conditions, fields, texts and confidences; the first rule that holds wins.
DEFAULT_RULES = [
    Rule(
        "NOT ip_valid",
        ["ip", "ip_valid", "ip_type", "subnet_cidr"],
        "'IP address is invalid or missing'",
        "drop",
        100,
    ),
    Rule(
        "ip_type = 'loopback'",
        ["ip", "ip_type"],
        "concat('IP is loopback address (', ip, '), not typically used for network devices in inventory')",
        "modify",
        80,
    ),
    Rule(
        "ip_type = 'link_local_apipa' AND NOT mac_valid",
        ["ip", "ip_type", "mac_valid"],
        "'IP is link-local (APIPA) and MAC address is missing'",
        "modify",
        75,
    ),
    Rule(
        _at_edge("255"),
        ["ip"],
        "concat('IP is broadcast address (', ip, '), should not be used for hosts')",
        "modify",
        90,
    ),
    Rule(
        _at_edge("0"),
        ["ip"],
        "concat('IP is network address (', ip, '), not for host use')",
        "modify",
        90,
    ),
    Rule(
        "NOT mac_valid AND device_type = 'server'",
        ["mac_valid"],
        "'MAC address is invalid or missing for a server device'",
        "modify",
        80,
    ),
    Rule(
        "NOT mac_valid AND device_type = 'router'",
        ["mac_valid"],
        "'MAC address is invalid or missing for a router device'",
        "modify",
        70,
    ),
]


def anomaly_input(clean: DataFrame) -> DataFrame:
    """The columns anomaly detection looks at."""
    return clean.select(*ANOMALY_INPUT_COLUMNS)


def _report(fields: Sequence[str], issue: Column, action: str, confidence: int) -> Column:
    return F.struct(
        F.array(*[F.lit(f) for f in fields]).alias("affected_fields"),
        issue.alias("issue_type"),
        F.lit(action).alias("recommended_action"),
        F.lit(confidence).cast("long").alias("anomaly_confidence"),
    )


def detect_anomalies(clean: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Rows for which a rule holds, reported by the first such rule; no shuffle.

    Rows without a finding are dropped by ``inline`` and not by a filter: a
    filter would be pushed below the cleaning and repeat it in its condition.
    """
    rules = DEFAULT_RULES if rules is None else rules
    if not rules:
        return clean.sparkSession.createDataFrame([], ANOMALY)
    number = F.coalesce(*[F.when(F.expr(r.condition), i) for i, r in enumerate(rules)])
    report = F.coalesce(
        *[
            F.when(F.col("_rule") == i, _report(r.fields, F.expr(r.issue), r.action, r.confidence))
            for i, r in enumerate(rules)
        ]
    )
    found = F.when(F.col("_rule").isNotNull(), F.array(report))
    return (
        clean.withColumn("_rule", number)
        .select("source_row_id", F.inline(found))
        .select(*ANOMALY.names)
    )


def duplicate_mac(clean: DataFrame) -> DataFrame:
    """Devices that share their MAC address, with the group size and another row of the group.

    Counting is pre-aggregated before the shuffle and the join back to the rows
    is salted by the counts, so one address may hold any share of the table, which is read twice.
    """
    rows = clean.where("mac IS NOT NULL").select("source_row_id", "mac")
    groups = rows.groupBy("mac").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("source_row_id").alias("_first"),
        F.max("source_row_id").alias("_last"),
    )
    return with_other(salted_lookup(rows, groups.where("n > 1"), "mac"))


def with_other(found: DataFrame, *more: str) -> DataFrame:
    """Rows of shared addresses with their group (``n``, ``_first``, ``_last``) as findings: the group size and another row."""
    other = F.when(F.col("source_row_id") == F.col("_first"), F.col("_last")).otherwise(F.col("_first"))
    return found.select("source_row_id", "mac", F.col("n").alias("devices"), other.alias("other_row_id"), *more)


def duplicate_mac_anomalies(clean: DataFrame) -> DataFrame:
    """:func:`duplicate_mac` as anomaly records."""
    return shared_mac_records(duplicate_mac(clean))


def shared_mac_records(found: DataFrame) -> DataFrame:
    """Findings of shared addresses as anomaly records."""
    issue = F.concat(
        F.lit("MAC address is duplicate with another device (source_row_id "),
        F.col("other_row_id"),
        F.lit(")"),
    )
    return (
        found.select("source_row_id", _report(["mac"], issue, "modify", 90).alias("_report"))
        .select("source_row_id", "_report.*")
        .select(*ANOMALY.names)
    )


def all_anomalies(clean: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Findings of the rules and of the shared addresses together."""
    return detect_anomalies(clean, rules).unionByName(duplicate_mac_anomalies(clean))
