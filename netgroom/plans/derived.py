"""More tables that the registered queries work on, derived from the given ones; the texts run unchanged in Spark and in DuckDB."""

from __future__ import annotations

# Devices whose row ids are repeated and missing, beside a key of every row.
REPEATED_SQL = """
SELECT o_orderkey AS row_key,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_orderkey % 400 END AS source_row_id,
  'owner' || CAST(o_custkey % 50 AS STRING) AS owner,
  CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE 'team' || CAST(o_custkey % 7 AS STRING) END AS owner_team,
  CAST(NULL AS STRING) AS owner_email
FROM orders
"""

# Replies of a model about anomalies: whole lists, and lists that break one rule each.
REPLIES_SQL = """
SELECT o_orderkey AS reply_id, CASE o_orderkey % 13
    WHEN 0 THEN '[' || good || ']'
    WHEN 1 THEN '[' || good || ',' || good || ']'
    WHEN 2 THEN '[]'
    WHEN 3 THEN '[' || good || ',{"source_row_id":' || id || ',"affected_fields":"ip","issue_type":"odd","recommended_action":"drop","anomaly_confidence":9}]'
    WHEN 4 THEN '[{"source_row_id":' || id || ',"affected_fields":["ip"],"issue_type":"odd","recommended_action":"drop","anomaly_confidence":"high"}]'
    WHEN 5 THEN '[{"source_row_id":' || id || ',"affected_fields":["ip"],"issue_type":"odd","recommended_action":"look","anomaly_confidence":9}]'
    WHEN 6 THEN '[{"affected_fields":["ip"],"issue_type":"odd","recommended_action":"drop","anomaly_confidence":9}]'
    WHEN 7 THEN '[{"source_row_id":' || id || ',"affected_fields":[],"issue_type":"odd","recommended_action":"drop","anomaly_confidence":9}]'
    WHEN 8 THEN '[{"source_row_id":' || id || ',"affected_fields":["ip"],"issue_type":"odd","recommended_action":"modify","anomaly_confidence":101}]'
    WHEN 9 THEN 'no anomalies were found'
    WHEN 10 THEN NULL
    WHEN 11 THEN '{"anomalies":[' || good || ']}'
    ELSE '[{"source_row_id":"' || id || '","affected_fields":["ip","mac"],"issue_type":"odd","recommended_action":"modify","anomaly_confidence":"95"}]'
  END AS reply
FROM (SELECT o_orderkey, CAST(o_orderkey AS STRING) AS id, '{"source_row_id":' || CAST(o_orderkey AS STRING)
    || ',"affected_fields":["ip"],"issue_type":"odd","recommended_action":"drop","anomaly_confidence":' || CAST(o_custkey % 101 AS STRING) || '}' AS good
  FROM orders) t
"""

# An inventory whose notes hold line breaks, commas and quotes.
NOTED_SQL = """
SELECT CAST(doc_id AS STRING) AS source_row_id, '10.0.' || CAST(doc_id % 256 AS STRING) || '.7' AS ip, 'doc-' || CAST(doc_id AS STRING) AS hostname,
  CAST(NULL AS STRING) AS fqdn, CAST(NULL AS STRING) AS mac, lang AS owner, '5" rack, "left"' AS device_type, source AS site, text AS notes
FROM documents
"""

def _snapshot(k: int) -> str:
    """The table of run ``k``: devices come and go, some change owner or site, some stand there twice."""
    owner = f"'o' || CAST((o_custkey + {k // 2} * (o_orderkey % 3)) % 20 AS STRING)"
    site = f"CASE WHEN (o_orderkey + {k}) % 11 = 0 THEN NULL ELSE 's' || CAST((o_orderkey + CASE WHEN o_orderkey % 4 = 0 THEN {k} ELSE 0 END) % 6 AS STRING) END"
    return f"""
SELECT '2025-11-0{k}' AS run_date, o_orderkey AS source_row_id, {owner} AS owner, {site} AS site FROM orders WHERE (o_orderkey * 7 + {k * k}) % 5 <> 0
UNION ALL
SELECT '2025-11-0{k}', CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey - 1 END, 'twin', {site} FROM orders WHERE o_orderkey % 40 = {k % 3}
"""


# The tables of five runs.
SNAPSHOTS = {f"2025-11-0{k}": _snapshot(k) for k in range(1, 6)}
SNAPSHOTS_SQL = "UNION ALL".join(SNAPSHOTS.values())

# Dates at which the history is asked for devices, one of them far more often than the others.
LOOKUPS_SQL = """
SELECT o_orderkey AS lookup_id, CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 4 ELSE o_orderkey % 1000 END AS source_row_id,
  '2025-11-0' || CAST(o_custkey % 8 AS STRING) AS asked_for
FROM orders
"""

# Devices that share addresses and names with a few others, and one name with many.
SHARED_SQL = """
SELECT o_orderkey AS source_row_id,
  CASE WHEN o_orderkey % 5 = 0 THEN 'mac' || CAST(o_custkey AS STRING) END AS mac,
  CASE WHEN o_orderkey % 6 = 1 THEN '10.' || CAST((o_orderkey - o_orderkey % 16) AS STRING) WHEN o_orderkey % 6 = 2 THEN '127.0.0.1' END AS ip,
  o_orderkey % 6 IN (1, 2) AS ip_valid,
  CASE o_orderkey % 6 WHEN 1 THEN 'private_rfc1918' WHEN 2 THEN 'loopback' ELSE 'invalid' END AS ip_type,
  CASE WHEN o_orderkey % 8 = 3 THEN 'h' || CAST(o_orderkey * 13 % 4001 AS STRING) || '.lan' WHEN o_orderkey % 61 = 4 THEN 'hot.lan'
    WHEN o_orderkey % 8 = 4 THEN 'nolabel' END AS fqdn
FROM orders
"""

# Prefixes of all lengths, some twice, some no prefixes.
PREFIXES_SQL = """
SELECT CASE c_custkey % 9
    WHEN 0 THEN '10.' || CAST(c_custkey % 256 AS STRING) || '.0.0/' || CAST(8 + c_custkey % 17 AS STRING)
    WHEN 1 THEN '192.168.' || CAST(c_custkey % 256 AS STRING) || '.' || CAST(c_custkey * 7 % 256 AS STRING) || '/' || CAST(20 + c_custkey % 13 AS STRING)
    WHEN 2 THEN '172.16.0.0/' || CAST(8 + c_custkey % 10 AS STRING)
    WHEN 3 THEN '8.8.' || CAST(c_custkey % 256 AS STRING) || '.0/' || CAST(16 + c_custkey % 16 AS STRING)
    WHEN 4 THEN '10.10.10.' || CAST(c_custkey % 256 AS STRING) || '/32'
    WHEN 5 THEN '169.254.0.0/16'
    WHEN 6 THEN '10.0.0.0/33'
    WHEN 7 THEN 'any'
    ELSE CASE WHEN c_custkey % 2 = 0 THEN '0.0.0.0/1' ELSE '300.1.1.0/8' END
  END AS prefix, 'zone' || CAST(c_custkey AS STRING) AS zone
FROM customer
"""

# Types with a letter missing, doubled, changed or swapped, and others that are near to nothing.
MISSPELT_SQL = """
SELECT o_orderkey AS source_row_id, CASE o_orderkey % 16
    WHEN 0 THEN 'swtich' WHEN 1 THEN 'routr' WHEN 2 THEN ' Fierwal' WHEN 3 THEN 'servr' WHEN 4 THEN 'printre' WHEN 5 THEN 'storge'
    WHEN 6 THEN 'kamera' WHEN 7 THEN 'controler' WHEN 8 THEN 'phon' WHEN 9 THEN 'upz' WHEN 10 THEN 'swiitchh' WHEN 11 THEN NULL
    WHEN 12 THEN 'switch' WHEN 13 THEN 'rooter' WHEN 14 THEN 'zzzz' ELSE 'thing' || CAST(o_custkey % 50 AS STRING) END AS device_type
FROM orders
"""

# Devices whose team mostly follows from site, type and network; some teams are missing.
TEAMS_SQL = """
SELECT o_orderkey AS source_row_id, CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE 'team' || CAST(base AS STRING) END AS owner_team,
  CASE WHEN o_orderkey % 3 = 0 THEN 'own' || CAST(o_custkey % 9 AS STRING) END AS owner, CAST(NULL AS STRING) AS owner_email,
  CASE WHEN o_orderkey % 20 < 16 THEN 'site' || CAST(base AS STRING) WHEN o_orderkey % 20 = 19 THEN 'unknown' ELSE 'site' || CAST(o_orderkey % 7 AS STRING) END AS site_normalized,
  CASE WHEN o_orderkey % 8 = 5 THEN 'unknown' ELSE 'type' || CAST((base * 2 + o_orderkey % 3) % 5 AS STRING) END AS device_type,
  CASE WHEN o_orderkey % 6 = 2 THEN '' ELSE '10.' || CAST(base + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS STRING) || '.0.0/16' END AS subnet_cidr,
  CASE WHEN o_orderkey % 5 = 3 THEN NULL ELSE CASE WHEN o_orderkey % 13 = 0 THEN 'x' WHEN base % 2 = 0 THEN 'edge' ELSE 'core' END || CAST(o_orderkey AS STRING) END AS hostname
FROM (SELECT o_orderkey, o_custkey, o_custkey % 7 AS base FROM orders) t
"""
