"""DuckDB SQL for the registered queries, written independently of the Spark columns.

Only the fixture texts are shared.  Where Spark uses patterns over the whole
text, this file splits the text and works on lists.
"""

from __future__ import annotations

from netgroom.plans.features_sql import features_sql
from netgroom.plans.fixture import INVENTORY_SQL, LITERALS_SQL, PROPOSALS_SQL

_STRIP = r"regexp_replace({0}, '^[\s\x1c-\x1f\x0b]+|[\s\x1c-\x1f\x0b]+$', '', 'g')"


def _strip(column: str) -> str:
    return _STRIP.format(column)


def _ip(source: str, column: str = "ip", count_reason: str = "wrong_octet_count") -> str:
    """Rows of ``source`` with ``ip_reason``, ``ip_valid``, ``ip_clean`` and the octets ``o``."""
    return rf"""
SELECT *, ip_reason = 'ok' AS ip_valid,
  CASE WHEN ip_reason = 'ok' THEN list_transform(ip_parts, lambda p: CAST(replace(p, '+', '') AS BIGINT)) END AS o,
  CASE WHEN ip_reason = 'ok' THEN array_to_string(
    list_transform(ip_parts, lambda p: CAST(CAST(replace(p, '+', '') AS BIGINT) AS VARCHAR)), '.') END AS ip_clean
FROM (
  SELECT *, CASE
    WHEN ip_text IS NULL THEN 'missing'
    WHEN ip_text LIKE '%:%' THEN 'ipv6_or_non_ipv4'
    WHEN len(ip_parts) <> 4 THEN '{count_reason}'
    ELSE coalesce(list_filter(list_transform(ip_parts, lambda p: CASE
        WHEN p = '' THEN 'empty_octet'
        WHEN NOT regexp_full_match(p, '\+*[0-9]+') THEN 'non_numeric_or_negative'
        WHEN p LIKE '++%' THEN 'non_decimal_format'
        WHEN CAST(replace(p, '+', '') AS HUGEINT) > 255 THEN 'octet_out_of_range'
      END), lambda r: r IS NOT NULL)[1], 'ok')
    END AS ip_reason
  FROM (SELECT *, string_split(ip_text, '.') AS ip_parts FROM (SELECT *, {_strip(column)} AS ip_text FROM {source}))
)"""


_TYPE = """CASE WHEN o IS NULL THEN 'invalid'
  WHEN o[1] = 10 OR (o[1] = 172 AND o[2] BETWEEN 16 AND 31) OR (o[1] = 192 AND o[2] = 168) THEN 'private_rfc1918'
  WHEN o[1] = 169 AND o[2] = 254 THEN 'link_local_apipa'
  WHEN o[1] = 127 THEN 'loopback'
  ELSE 'public_or_other' END"""

_SUBNET = """CASE ip_type
  WHEN 'private_rfc1918' THEN CASE o[1] WHEN 10 THEN '10.0.0.0/8'
    WHEN 172 THEN concat('172.', o[2], '.0.0/16') ELSE concat('192.168.', o[3], '.0/24') END
  WHEN 'link_local_apipa' THEN '169.254.0.0/16'
  WHEN 'loopback' THEN '127.0.0.0/8'
  WHEN 'public_or_other' THEN concat(o[1], '.', o[2], '.', o[3], '.0/24')
  ELSE '' END"""

_HOST = "^[a-zA-Z0-9]([a-zA-Z0-9-]*[a-zA-Z0-9])?$"

_HOSTNAME = f"""
SELECT *, hostname_reason = 'ok' AS hostname_valid,
  CASE WHEN hostname_reason = 'ok' THEN lower(hostname_text)
    WHEN hostname_reason NOT IN ('missing', 'empty_string') THEN hostname_text END AS hostname_clean
FROM (SELECT *, CASE
    WHEN hostname_text IS NULL THEN 'missing'
    WHEN hostname_text = '' THEN 'empty_string'
    WHEN length(hostname_text) > 63 THEN 'too_long'
    WHEN position('.' IN hostname_text) > 0 THEN 'contains_periods'
    WHEN NOT regexp_matches(hostname_text, '{_HOST}') THEN 'invalid_characters'
    ELSE 'ok' END AS hostname_reason
  FROM (SELECT *, {_strip("hostname")} AS hostname_text FROM with_ip))"""

_SITE = rf"""
SELECT *, CASE WHEN site_reason = 'normalized_site' THEN site_name ELSE 'unknown' END AS site_clean
FROM (SELECT *, CASE
    WHEN site_text IS NULL THEN 'missing'
    WHEN site_text = '' THEN 'empty_string'
    WHEN site_name IN ('n/a', 'na', 'none', 'null', 'unknown') THEN 'missing'
    ELSE 'normalized_site' END AS site_reason
  FROM (SELECT *, trim(regexp_replace(replace(regexp_replace(site_text, '[\s,_]+', '-', 'g'), 'building', 'bldg'),
      '-+', '-', 'g'), '-') AS site_name
    FROM (SELECT *, lower({_strip("site")}) AS site_text FROM with_hostname)))"""


def _fqdn(source: str, column: str = "fqdn", consistent: str = "'unknown'") -> str:
    return rf"""
SELECT *, fqdn_reason = 'valid' AS fqdn_valid,
  CASE WHEN fqdn_reason = 'valid' THEN lower(fqdn_body)
    WHEN fqdn_reason NOT IN ('missing', 'empty_string') THEN fqdn_text END AS fqdn_clean,
  CASE WHEN fqdn_reason = 'valid' THEN {consistent} ELSE 'inconsistent' END AS fqdn_consistent
FROM (SELECT *, CASE
    WHEN fqdn_text IS NULL THEN 'missing'
    WHEN fqdn_text = '' THEN 'empty_string'
    WHEN length(fqdn_body) > 255 THEN 'too_long'
    WHEN len(labels) < 2 THEN 'too_few_labels'
    ELSE coalesce(list_filter(list_transform(labels, lambda l, i: CASE
        WHEN length(l) > 63 THEN 'label_' || (i - 1) || '_too_long'
        WHEN l = '' THEN 'empty_label'
        WHEN i = 1 AND NOT regexp_matches(l, '{_HOST}') THEN 'invalid_hostname_label'
        WHEN NOT regexp_matches(l, '^[a-zA-Z0-9-]+$') THEN 'invalid_domain_label' || (i - 1)
        WHEN l LIKE '-%' OR l LIKE '%-' THEN 'label_' || (i - 1) || '_hyphen_edge'
      END), lambda r: r IS NOT NULL)[1], 'valid')
    END AS fqdn_reason
  FROM (SELECT *, string_split(fqdn_body, '.') AS labels
    FROM (SELECT *, CASE WHEN fqdn_text LIKE '%.' THEN fqdn_text[:-2] ELSE fqdn_text END AS fqdn_body
      FROM (SELECT *, {_strip(column)} AS fqdn_text FROM {source}))))"""


_FQDN = _fqdn(
    "with_site",
    consistent="""CASE WHEN hostname_clean IS NULL OR site_clean IS NULL THEN 'unknown'
    WHEN lower(fqdn_body) = lower(hostname_clean || '.' || site_clean) THEN 'consistent'
    ELSE 'inconsistent' END""",
)

_MAC = rf"""
SELECT *, mac_reason = 'valid' AS mac_valid,
  CASE WHEN mac_reason = 'valid' THEN concat_ws(':', mac_hex[1:2], mac_hex[3:4], mac_hex[5:6],
    mac_hex[7:8], mac_hex[9:10], mac_hex[11:12]) END AS mac_clean
FROM (SELECT *, lower(regexp_replace(mac_text, '[^0-9A-Fa-f]', '', 'g')) AS mac_hex, CASE
    WHEN mac_text IS NULL THEN 'missing'
    WHEN mac_text = '' THEN 'empty_string'
    WHEN regexp_full_match(mac_text, '([0-9A-Fa-f]{{2}}[:-]){{5}}[0-9A-Fa-f]{{2}}')
      OR regexp_full_match(mac_text, '[0-9A-Fa-f]{{4}}\.[0-9A-Fa-f]{{4}}\.[0-9A-Fa-f]{{4}}') THEN 'valid'
    ELSE 'invalid_format' END AS mac_reason
  FROM (SELECT *, {_strip("mac")} AS mac_text FROM with_fqdn))"""

_EMAIL = r"[\pL\pN_.-]+@[\pL\pN_.-]+\.[\pL\pN_]+"

_OWNER = rf"""
SELECT *, regexp_extract_all(owner_text, '{_EMAIL}')[1] AS owner_email,
  {_strip(r"regexp_extract_all(owner_rest, '\((.*?)\)', 1)[1]")} AS owner_team,
  nullif(lower({_strip(r"regexp_replace(owner_rest, '\(.*?\)', '', 'g')")}), '') AS owner_clean,
  CASE WHEN coalesce(owner_text, '') = '' THEN 'missing' ELSE 'owner_valid_and_normalized' END AS owner_reason
FROM (SELECT *, {_strip(f"regexp_replace(owner_text, '{_EMAIL}', '', 'g')")} AS owner_rest
  FROM (SELECT *, {_strip("owner")} AS owner_text FROM with_mac))"""

_DEVICE = r"""
SELECT *,
  CASE WHEN device_exact IS NOT NULL THEN device_exact ELSE coalesce(device_fuzzy, 'unknown') END AS device_type_clean,
  CAST(CASE WHEN device_exact IS NOT NULL THEN 100 WHEN device_fuzzy IS NOT NULL THEN 90 ELSE 0 END AS BIGINT)
    AS device_type_confidence,
  CASE WHEN device_type IS NULL THEN 'missing' WHEN device_text = '' THEN 'empty_string'
    WHEN device_exact IS NOT NULL THEN 'exact_match' WHEN device_fuzzy IS NOT NULL THEN 'fuzzy_match'
    ELSE 'no_match' END AS device_type_reason
FROM (SELECT *,
    CASE WHEN device_text IN ('switch', 'router', 'firewall', 'server', 'printer', 'storage', 'ups', 'camera', 'unknown')
        THEN device_text
      WHEN device_text = 'controller' THEN 'wireless_controller'
      WHEN device_text = 'phone' THEN 'ip_phone' END AS device_exact,
    CASE WHEN regexp_matches(device_text, '\bsw\b|switch') THEN 'switch'
      WHEN regexp_matches(device_text, '\brtr\b|router') THEN 'router'
      WHEN regexp_matches(device_text, '\bfw\b|firewall|asa|pa\d+') THEN 'firewall'
      WHEN regexp_matches(device_text, '\bap\b|access[_-]?point') THEN 'wireless_ap'
      WHEN regexp_matches(device_text, 'wlc|controller') THEN 'wireless_controller'
      WHEN regexp_matches(device_text, 'f5|ltm|lb|load[_-]?balancer') THEN 'load_balancer'
      WHEN regexp_matches(device_text, 'server|vm|esxi') THEN 'server'
      WHEN regexp_matches(device_text, 'print') THEN 'printer'
      WHEN regexp_matches(device_text, 'ups') THEN 'ups'
      WHEN regexp_matches(device_text, 'voip|phone') THEN 'ip_phone'
      WHEN regexp_matches(device_text, 'cam') THEN 'camera'
      WHEN regexp_matches(device_text, 'nas|san|storage') THEN 'storage' END AS device_fuzzy
  FROM (SELECT *, regexp_replace(regexp_replace(lower(%s), '[,_;/]', ' ', 'g'), '\s+', ' ', 'g') AS device_text
    FROM with_owner))""" % _strip("device_type")


def _step(field: str) -> str:
    return f"{{'field': '{field}', 'from': {field}, 'to': {field}_clean, 'reason': {field}_reason}}"


_FIELDS = ["ip", "hostname", "fqdn", "mac", "owner", "device_type", "site"]
_STEPS = "[" + ", ".join(map(_step, _FIELDS)) + "]"

_CLEAN = f"""
SELECT ip_clean AS ip, ip_valid, ip_type, subnet_cidr, hostname_clean AS hostname, hostname_valid,
  fqdn_clean AS fqdn, fqdn_consistent, reverse_ptr, mac_clean AS mac, mac_valid, owner_clean AS owner,
  owner_email, owner_team, device_type_clean AS device_type, device_type_confidence, site,
  site_clean AS site_normalized, source_row_id, {_STEPS} AS normalization_steps, o
FROM fields"""

_BASE = f"""inv AS ({INVENTORY_SQL}),
with_ip AS (SELECT *, {_SUBNET} AS subnet_cidr,
    CASE WHEN ip_valid THEN concat(o[4], '.', o[3], '.', o[2], '.', o[1], '.in-addr.arpa') END AS reverse_ptr
  FROM (SELECT *, {_TYPE} AS ip_type FROM ({_ip("inv")}))),
with_hostname AS ({_HOSTNAME}),
with_site AS ({_SITE}),
with_fqdn AS ({_FQDN}),
with_mac AS ({_MAC}),
with_owner AS ({_OWNER}),
fields AS ({_DEVICE}),
clean AS ({_CLEAN}),
proposals AS ({PROPOSALS_SQL}),
corrected AS (SELECT * REPLACE (
    CASE WHEN moved THEN NULL WHEN owner IS NULL AND owner_email IS NOT NULL THEN string_split(owner_email, '@')[1]
      ELSE owner END AS owner,
    CASE WHEN moved THEN owner ELSE owner_team END AS owner_team),
    CASE WHEN owner IS NULL AND owner_email IS NOT NULL THEN 80 ELSE 100 END AS confidence
  FROM (SELECT *, owner_team IS NULL AND coalesce(owner IN ('facilities', 'ops', 'platform', 'sec'), FALSE) AS moved
    FROM clean)),
rules AS (SELECT source_row_id, ip, ip_type, device_type, CASE
    WHEN NOT ip_valid THEN 1 WHEN ip_type = 'loopback' THEN 2
    WHEN ip_type = 'link_local_apipa' AND NOT mac_valid THEN 3
    WHEN edge = list_transform(edge, lambda x: 255) THEN 4
    WHEN edge = list_transform(edge, lambda x: 0) THEN 5
    WHEN NOT mac_valid AND device_type = 'server' THEN 6
    WHEN NOT mac_valid AND device_type = 'router' THEN 7 END AS rule
  FROM (SELECT *, o[CAST(CAST(string_split(subnet_cidr, '/')[2] AS BIGINT) / 8 AS BIGINT) + 1 : 4] AS edge
    FROM (SELECT * REPLACE (nullif(subnet_cidr, '') AS subnet_cidr) FROM clean))),
rule_anomalies AS (SELECT source_row_id,
    ['ip,ip_valid,ip_type,subnet_cidr', 'ip,ip_type', 'ip,ip_type,mac_valid', 'ip', 'ip', 'mac_valid', 'mac_valid'][rule]
      AS affected_fields,
    CASE rule WHEN 1 THEN 'IP address is invalid or missing'
      WHEN 2 THEN 'IP is loopback address (' || ip || '), not typically used for network devices in inventory'
      WHEN 3 THEN 'IP is link-local (APIPA) and MAC address is missing'
      WHEN 4 THEN 'IP is broadcast address (' || ip || '), should not be used for hosts'
      WHEN 5 THEN 'IP is network address (' || ip || '), not for host use'
      ELSE 'MAC address is invalid or missing for a ' || device_type || ' device' END AS issue_type,
    CASE WHEN rule = 1 THEN 'drop' ELSE 'modify' END AS recommended_action,
    CAST([100, 80, 75, 90, 90, 80, 70][rule] AS BIGINT) AS anomaly_confidence
  FROM rules WHERE rule IS NOT NULL),
same_mac AS (SELECT source_row_id, mac, devices,
    CASE WHEN source_row_id = first_id THEN last_id ELSE first_id END AS other_row_id
  FROM (SELECT source_row_id, mac, count(*) OVER m AS devices, min(source_row_id) OVER m AS first_id,
      max(source_row_id) OVER m AS last_id
    FROM clean WHERE mac IS NOT NULL WINDOW m AS (PARTITION BY mac))
  WHERE devices > 1),
starter_in AS (SELECT source_row_id, coalesce(ip, '') AS ip, coalesce(hostname, '') AS hostname,
    coalesce(fqdn, '') AS fqdn, coalesce(mac, '') AS mac, coalesce(owner, '') AS owner,
    coalesce(device_type, '') AS device_type, coalesce(site, '') AS site FROM inv),
starter AS (SELECT *, {_TYPE} AS ip_type FROM ({_ip("starter_in", count_reason="wrong_part_count")})),
starter_net AS (SELECT *, CASE WHEN ip_type = 'private_rfc1918'
    THEN concat(o[1], '.', o[2], '.', o[3], '.0/24') ELSE '' END AS subnet_cidr FROM starter)"""

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_QUAD = rf"{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}"

# IPv6 literals group by group: an embedded IPv4 address becomes two groups, "::" the missing ones.
_LITERALS = rf"""lit AS ({LITERALS_SQL}),
v0 AS (SELECT *, {_strip("ip")} AS s FROM lit),
v1 AS (SELECT *, position('%' IN s) > 0 AS scoped, lower(string_split(s, '%')[1]) AS a FROM v0),
v2 AS (SELECT *, string_split(a, ':') AS raw_groups, string_split(a, ':')[-1] AS last_group FROM v1),
v3 AS (SELECT *, CASE WHEN regexp_full_match(last_group, '{_QUAD}')
    THEN list_transform(string_split(last_group, '.'), lambda q: CAST(q AS INTEGER)) END AS q FROM v2),
v4 AS (SELECT *, CASE WHEN q IS NULL THEN a ELSE array_to_string(list_concat(raw_groups[:-2],
    [printf('%x', q[1] * 256 + q[2]), printf('%x', q[3] * 256 + q[4])]), ':') END AS b FROM v3),
v5 AS (SELECT *, string_split(b, '::') AS halves FROM v4),
v6 AS (SELECT *, CASE WHEN halves[1] = '' THEN [] ELSE string_split(halves[1], ':') END AS hi,
    CASE WHEN len(halves) < 2 OR halves[2] = '' THEN [] ELSE string_split(halves[2], ':') END AS lo FROM v5),
v7 AS (SELECT *, list_concat(hi, list_concat(
    CASE WHEN len(halves) = 2 THEN list_transform(range(greatest(8 - len(hi) - len(lo), 0)), lambda x: '0') ELSE [] END,
    lo)) AS groups FROM v6),
v8 AS (SELECT *, a LIKE '%:%' AND len(groups) = 8 AND len(halves) <= 2
    AND (len(halves) = 1 OR len(hi) + len(lo) <= 7)
    AND len(list_filter(groups, lambda g: NOT regexp_full_match(g, '[0-9a-f]{{1,4}}'))) = 0 AS is6,
    regexp_full_match(s, '{_QUAD}') AS is4 FROM v7)"""


def _with(select: str) -> str:
    return f"WITH {_BASE}\n{select}"


def _field(name: str, *more: str) -> str:
    columns = ", ".join(more)
    return _with(f"SELECT source_row_id, {name} AS raw, {name}_clean AS {name}, {columns} FROM fields")


_CSV_CLEAN = "* EXCLUDE (o) REPLACE (CAST(to_json(normalization_steps) AS VARCHAR) AS normalization_steps)"
_OWNERS = "source_row_id, owner, owner_team, owner_email"
_MERGED = """SELECT c.source_row_id,
  CASE WHEN p.source_row_id IS NULL THEN c.owner ELSE p.owner END AS owner,
  CASE WHEN p.source_row_id IS NULL THEN c.owner_team ELSE p.owner_team END AS owner_team,
  CASE WHEN p.source_row_id IS NULL THEN c.owner_email ELSE p.owner_email END AS owner_email
FROM clean c LEFT JOIN (SELECT * FROM proposals WHERE confidence_percentage >= 70) p USING (source_row_id)"""
_PREVIEW_COLUMNS = (
    "ip, ip_valid, ip_type, subnet_cidr, hostname, hostname_valid, fqdn, fqdn_consistent, reverse_ptr, mac, "
    "mac_valid, owner, owner_email, owner_team, device_type, device_type_confidence, site, site_normalized, "
    "source_row_id"
)
_ANOMALY_COLUMNS = "source_row_id, affected_fields, issue_type, recommended_action, anomaly_confidence"

_TEXT_IPV4 = r"""cand AS (SELECT doc_id, CAST(generate_subscripts(found, 1) - 1 AS BIGINT) AS pos, unnest(found) AS candidate
  FROM (SELECT doc_id, regexp_extract_all(text, '[0-9]+(?:[.][0-9]+){3,}') AS found FROM documents))"""


def oracle_sql() -> dict[str, str]:
    fields = _field_sql()
    # the stream finds what the batch finds
    return fields | features_sql(_BASE, _DEVICE) | {"q_stream_duplicate_mac": fields["q_duplicate_mac"]}


def _field_sql() -> dict[str, str]:
    literals = f"WITH {_LITERALS}\n"
    return {
        "q_ip_clean": _field("ip", "ip_valid", "ip_reason"),
        "q_ip_type": _with("SELECT source_row_id, ip_clean AS ip, ip_type FROM fields"),
        "q_ip_subnet": _with("SELECT source_row_id, ip_clean AS ip, subnet_cidr FROM fields"),
        "q_reverse_ptr": _with("SELECT source_row_id, ip_clean AS ip, reverse_ptr FROM fields"),
        "q_reverse_ptr6": literals
        + r"""SELECT source_row_id, ip, CASE
  WHEN is4 THEN array_to_string(list_reverse(string_split(s, '.')), '.') || '.in-addr.arpa'
  WHEN is6 AND NOT scoped THEN array_to_string(list_reverse(string_split(
    array_to_string(list_transform(groups, lambda g: lpad(g, 4, '0')), ''), '')), '.') || '.ip6.arpa'
  END AS reverse_ptr FROM v8""",
        "q_ip_version": literals
        + """SELECT source_row_id, ip, CASE WHEN is4 THEN '4'
  WHEN is6 AND len(string_split(s, ':')) >= 3 THEN '6' ELSE 'invalid' END AS ip_version FROM v8""",
        "q_hostname_clean": _field("hostname", "hostname_valid", "hostname_reason"),
        "q_site_clean": _field("site", "site_reason"),
        "q_fqdn_clean": _field("fqdn", "fqdn_valid", "fqdn_reason", "fqdn_consistent"),
        "q_mac_clean": _field("mac", "mac_valid", "mac_reason"),
        "q_owner_parse": _field("owner", "owner_email", "owner_team", "owner_reason"),
        "q_device_type_clean": _field("device_type", "device_type_confidence", "device_type_reason"),
        "q_inventory_clean": _with(f"SELECT {_CSV_CLEAN} FROM clean"),
        "q_normalization_log": _with(
            "\nUNION ALL\n".join(
                f"SELECT source_row_id, CAST({i} AS BIGINT) AS step, '{f}' AS field, {f} AS \"from\", "
                f'{f}_clean AS "to", {f}_reason AS reason FROM fields'
                for i, f in enumerate(_FIELDS)
            )
        ),
        "q_quality_report": _with(
            "SELECT field, reason, CAST(count(*) AS BIGINT) AS rows FROM ("
            + " UNION ALL ".join(f"SELECT '{f}' AS field, {f}_reason AS reason FROM fields" for f in _FIELDS)
            + ") GROUP BY field, reason"
        ),
        "q_row_count": "SELECT count(*) AS rows FROM orders",
        "q_preview": _with(
            f"""SELECT source_row_id, CAST(to_json(t) AS VARCHAR) AS row_json
FROM (SELECT {_PREVIEW_COLUMNS} FROM corrected ORDER BY source_row_id LIMIT 20) t"""
        ),
        "q_owner_payload": _with(f"SELECT {_OWNERS} FROM clean"),
        "q_owner_response_rows": _with(f"SELECT {_OWNERS}, confidence_percentage FROM proposals"),
        "q_owner_high_confidence": _with(
            f"SELECT {_OWNERS}, confidence_percentage FROM proposals WHERE confidence_percentage >= 70"
        ),
        "q_owner_propose": _with(
            f"SELECT {_OWNERS}, CAST(confidence AS DOUBLE) AS confidence_percentage FROM corrected"
        ),
        "q_owner_correct": _with(f"SELECT {_OWNERS} FROM corrected"),
        "q_owner_merge": _with(_MERGED),
        "q_owner_merge_empty": _with(f"SELECT {_OWNERS} FROM clean"),
        "q_owner_unknown": _with(
            f"SELECT {_OWNERS} FROM proposals WHERE source_row_id NOT IN "
            "(SELECT source_row_id FROM clean WHERE ip_valid)"
        ),
        "q_anomaly_input": _with(
            "SELECT source_row_id, ip, ip_valid, ip_type, subnet_cidr, hostname, hostname_valid, fqdn, "
            "reverse_ptr, mac, mac_valid, device_type, site_normalized FROM clean"
        ),
        "q_anomaly_rules": _with(f"SELECT {_ANOMALY_COLUMNS} FROM rule_anomalies"),
        "q_duplicate_mac": _with("SELECT source_row_id, mac, devices, other_row_id FROM same_mac"),
        "q_anomalies_all": _with(
            f"""SELECT {_ANOMALY_COLUMNS} FROM rule_anomalies
UNION ALL SELECT source_row_id, 'mac',
  'MAC address is duplicate with another device (source_row_id ' || other_row_id || ')',
  'modify', CAST(90 AS BIGINT) FROM same_mac"""
        ),
        "q_starter_clean": _with(
            """SELECT CASE WHEN ip_valid THEN ip_clean ELSE ip_text END AS ip,
  CASE WHEN ip_valid THEN 'true' ELSE 'false' END AS ip_valid,
  CASE WHEN ip_valid THEN '4' ELSE '' END AS ip_version, subnet_cidr,
  CASE WHEN ip_valid THEN 'ip_trim|ip_parse|ip_normalize' ELSE 'ip_trim|ip_invalid_' || ip_reason END
    AS normalization_steps,
  source_row_id, hostname, fqdn, mac, owner, device_type, site FROM starter_net"""
        ),
        "q_starter_subnet": _with("SELECT source_row_id, ip_type, subnet_cidr FROM starter_net"),
        "q_starter_anomalies": _with(
            """SELECT source_row_id, 'ip' AS field, ip_reason AS type, ip AS value,
  'Correct IP or mark record for review' AS recommended_actions FROM starter WHERE NOT ip_valid"""
        ),
        "q_subnet_rollup": _with(
            "SELECT subnet_cidr, ip_type, count(*) AS devices, count(DISTINCT mac) AS distinct_macs "
            "FROM clean GROUP BY subnet_cidr, ip_type"
        ),
        "q_site_device_matrix": _with(
            "SELECT site_normalized, device_type, CAST(grouping(site_normalized, device_type) AS BIGINT) AS level, "
            "count(*) AS devices FROM clean GROUP BY CUBE (site_normalized, device_type)"
        ),
        "q_text_emails": f"""SELECT doc_id, CAST(generate_subscripts(found, 1) - 1 AS BIGINT) AS pos, unnest(found) AS email
FROM (SELECT doc_id, regexp_extract_all(text, '{_EMAIL}') AS found FROM documents)""",
        "q_text_ipv4": f"""WITH {_TEXT_IPV4}
SELECT doc_id, pos, candidate, ip_clean AS ip, ip_valid, ip_reason AS reason, {_TYPE} AS ip_type
FROM ({_ip("cand", "candidate")})""",
        "q_page_hosts": rf"""WITH hosts AS (SELECT regexp_extract(url,
    '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1) AS host FROM pages),
checked AS ({_fqdn("hosts", "host")})
SELECT domain, host_reason, count(*) AS pages, count(DISTINCT fqdn_clean) AS hosts
FROM (SELECT CASE WHEN fqdn_valid THEN array_to_string(string_split(fqdn_clean, '.')[-2:], '.') END AS domain,
    fqdn_reason AS host_reason, fqdn_clean FROM checked)
GROUP BY domain, host_reason""",
    }
