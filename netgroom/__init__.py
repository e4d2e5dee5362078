"""Cleaning, validation and auditing of network inventories on Spark."""

from netgroom.operators.anomalies import all_anomalies, detect_anomalies, duplicate_mac
from netgroom.operators.clean import clean_fields, clean_inventory, normalization_log
from netgroom.operators.entities import device_classes
from netgroom.operators.history import as_of, extend_history, history, snapshot_at, snapshot_diff
from netgroom.operators.learned import learn_owner
from netgroom.operators.mined import dependency_violations, mine_dependencies
from netgroom.operators.owners import correct_owner, merge_owner, propose_owner
from netgroom.operators.prefixes import cidr_cover, longest_prefix
from netgroom.operators.spelling import guess_device_type
from netgroom.plans.daily import run_daily, run_starter
from netgroom.session import tune
from netgroom.sources.readers import read_clean, read_raw
from netgroom.streaming.ingest import publish_stream, raw_stream
from netgroom.streaming.shared import shared_macs, watch_shared_macs

__all__ = [
    "all_anomalies",
    "as_of",
    "cidr_cover",
    "clean_fields",
    "clean_inventory",
    "correct_owner",
    "dependency_violations",
    "detect_anomalies",
    "device_classes",
    "duplicate_mac",
    "extend_history",
    "guess_device_type",
    "history",
    "learn_owner",
    "longest_prefix",
    "merge_owner",
    "mine_dependencies",
    "normalization_log",
    "propose_owner",
    "publish_stream",
    "raw_stream",
    "read_clean",
    "read_raw",
    "run_daily",
    "run_starter",
    "shared_macs",
    "snapshot_at",
    "snapshot_diff",
    "tune",
    "watch_shared_macs",
]
