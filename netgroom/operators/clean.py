"""Cleaning the raw table: one narrow plan, no shuffle."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netgroom.functions import (
    Stages,
    add_fields,
    canonical_ipv4_type,
    default_subnet,
    device_type_stages,
    fqdn_stages,
    hostname_stages,
    ipv4_stages,
    mac_stages,
    owner_stages,
    reverse_ptr4,
    site_stages,
    trace,
)
from netgroom.sources.schema import CLEAN

LOGGED_FIELDS = ["ip", "hostname", "fqdn", "mac", "owner", "device_type", "site"]


@cache
def ipv4_derived_stages() -> Stages:
    """Type, subnet and reverse pointer of the cleaned address, from the fourth stage on."""
    ip = F.col("ip_clean")
    return [
        {},
        {},
        {},
        {"ip_type": canonical_ipv4_type(ip)},
        {"subnet_cidr": default_subnet(ip, F.col("ip_type")), "reverse_ptr": reverse_ptr4(ip)},
    ]


def clean_fields(raw: DataFrame) -> DataFrame:
    """The raw table plus cleaned value, validity and reason of every field.

    Columns a query does not ask for are pruned together with their work.
    """
    return add_fields(
        raw,
        ipv4_stages(),
        ipv4_derived_stages(),
        hostname_stages(),
        site_stages(),
        fqdn_stages(hostname="hostname_clean", site="site_clean"),
        mac_stages(),
        owner_stages(),
        device_type_stages(),
    )


@cache
def _steps():
    return F.array(
        *[trace(f, F.col(f), F.col(f"{f}_clean"), F.col(f"{f}_reason")) for f in LOGGED_FIELDS]
    )


def clean_inventory(raw: DataFrame) -> DataFrame:
    """The clean table: 20 columns, the last one the ordered log of all changes of the row."""
    cleaned = {
        "ip": "ip_clean",
        "hostname": "hostname_clean",
        "fqdn": "fqdn_clean",
        "mac": "mac_clean",
        "owner": "owner_clean",
        "device_type": "device_type_clean",
        "site_normalized": "site_clean",
    }
    columns = [F.col(cleaned.get(c, c)).alias(c) for c in CLEAN.names[:-1]]
    return clean_fields(raw).select(*columns, _steps().alias("normalization_steps"))


def normalization_log(raw: DataFrame) -> DataFrame:
    """The audit log: one row for every field of every device, in field order."""
    return (
        clean_fields(raw)
        .select("source_row_id", F.posexplode(_steps()).alias("step", "s"))
        .select("source_row_id", F.col("step").cast("long").alias("step"), "s.*")
    )
