"""The field functions on columns of free text: addresses in documents, hosts of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netgroom.functions import canonical_ipv4_type, clean_fqdn, clean_ipv4
from netgroom.functions.owner import EMAIL

# Runs of digits and dots with at least four parts; possessive, so long numbers stay linear.
QUAD = r"(?<![0-9])[0-9]++(?:[.][0-9]++){3,}+"


def text_emails(df: DataFrame, key: str, text: str) -> DataFrame:
    """Every e-mail address of every text, with its position among them."""
    found = F.regexp_extract_all(F.col(text), F.lit(EMAIL), F.lit(0))
    return (
        df.where(F.col(text).contains("@"))
        .select(key, F.posexplode(found).alias("pos", "email"))
        .withColumn("pos", F.col("pos").cast("long"))
    )


def text_ipv4(df: DataFrame, key: str, text: str) -> DataFrame:
    """Every dotted number of every text, judged as an IPv4 address."""
    found = F.regexp_extract_all(F.col(text), F.lit(QUAD), F.lit(0))
    candidates = df.select(key, F.posexplode(found).alias("pos", "candidate"))
    return clean_ipv4(candidates, "candidate", "ip").select(
        key,
        F.col("pos").cast("long").alias("pos"),
        "candidate",
        F.col("ip_clean").alias("ip"),
        "ip_valid",
        F.col("ip_reason").alias("reason"),
        canonical_ipv4_type(F.col("ip_clean")).alias("ip_type"),
    )


def page_hosts(df: DataFrame, url: str) -> DataFrame:
    """Pages and hosts of each domain (the last two labels of a valid host name).

    Pages are counted by host before the hosts are checked, so a host is
    checked once and a host of very many pages is a single row in the shuffles.
    """
    host = F.regexp_extract(F.col(url), r"\A[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    counted = df.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("n"))
    hosts = clean_fqdn(counted, "host", "host")
    domain = F.when(F.col("host_valid"), F.substring_index(F.col("host_clean"), ".", -2))
    return (
        hosts.select(domain.alias("domain"), "host_reason", "host_clean", "n")
        .groupBy("domain", "host_reason")
        .agg(F.sum("n").alias("pages"), F.countDistinct("host_clean").alias("hosts"))
    )
