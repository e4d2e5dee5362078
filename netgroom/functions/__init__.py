"""Field functions: each adds the cleaned value, its validity and the reason as native columns."""

from netgroom.functions.device import clean_device_type, device_type_stages
from netgroom.functions.ipv4 import (
    canonical_ipv4_type,
    clean_ipv4,
    default_subnet,
    ipv4_stages,
    ipv4_type,
    private_subnet_24,
    reverse_ptr4,
)
from netgroom.functions.ipv6 import expand_ipv6, ip_version, reverse_ptr
from netgroom.functions.mac import clean_mac, mac_stages
from netgroom.functions.names import clean_fqdn, clean_hostname, fqdn_stages, hostname_stages
from netgroom.functions.owner import owner_stages, parse_owner
from netgroom.functions.site import clean_site, site_stages
from netgroom.functions.stages import Stages, add_fields
from netgroom.functions.trace import trace

__all__ = [
    "Stages",
    "add_fields",
    "canonical_ipv4_type",
    "clean_device_type",
    "clean_fqdn",
    "clean_hostname",
    "clean_ipv4",
    "clean_mac",
    "clean_site",
    "default_subnet",
    "device_type_stages",
    "expand_ipv6",
    "fqdn_stages",
    "hostname_stages",
    "ip_version",
    "ipv4_stages",
    "ipv4_type",
    "mac_stages",
    "owner_stages",
    "parse_owner",
    "private_subnet_24",
    "reverse_ptr",
    "reverse_ptr4",
    "site_stages",
    "trace",
]
