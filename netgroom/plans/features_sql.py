"""DuckDB SQL for the queries of ``features``."""

from __future__ import annotations

from netgroom.functions.device import EXACT
from netgroom.plans.derived import (
    LOOKUPS_SQL,
    MISSPELT_SQL,
    NOTED_SQL,
    PREFIXES_SQL,
    REPEATED_SQL,
    REPLIES_SQL,
    SHARED_SQL,
    SNAPSHOTS,
    SNAPSHOTS_SQL,
    TEAMS_SQL,
)
from netgroom.plans.fixture import PROPOSALS_SQL

_CSV = f"""
SELECT CAST(source_row_id AS BIGINT) AS source_row_id, ip, hostname, '' AS mac, coalesce(owner, '') AS owner, device_type,
  coalesce(site, '') AS site, length(coalesce(notes, '')) AS n_chars, md5(coalesce(notes, '')) AS notes_md5
FROM ({NOTED_SQL})"""

_REPEATED = f"""
SELECT t.row_key, t.source_row_id,
  CASE WHEN p.source_row_id IS NULL THEN t.owner ELSE p.owner END AS owner,
  CASE WHEN p.source_row_id IS NULL THEN t.owner_team ELSE p.owner_team END AS owner_team,
  CASE WHEN p.source_row_id IS NULL THEN t.owner_email ELSE p.owner_email END AS owner_email
FROM ({REPEATED_SQL}) t LEFT JOIN (SELECT * FROM ({PROPOSALS_SQL}) WHERE confidence_percentage >= 70) p ON p.source_row_id = t.row_key"""

_AUDIT = f"""
WITH r AS (SELECT reply_id, CASE WHEN reply LIKE '[%' THEN CAST(reply AS JSON) END AS reply FROM ({REPLIES_SQL})),
each AS (SELECT reply_id, unnest(CAST(reply AS JSON[])) AS x FROM r WHERE reply IS NOT NULL),
judged AS (SELECT reply_id, count(*) AS records, count(*) FILTER (
    TRY_CAST(json_extract_string(x, '$.source_row_id') AS BIGINT) IS NOT NULL AND json_type(json_extract(x, '$.affected_fields')) = 'ARRAY' AND json_array_length(json_extract(x, '$.affected_fields')) > 0
    AND json_extract_string(x, '$.issue_type') IS NOT NULL AND json_extract_string(x, '$.recommended_action') IN ('drop', 'modify')
    AND TRY_CAST(json_extract_string(x, '$.anomaly_confidence') AS DOUBLE) BETWEEN 0 AND 100) AS whole
  FROM each GROUP BY reply_id)
SELECT reply_id, reply IS NOT NULL AND coalesce(records = whole, TRUE) AS readable, coalesce(records, 0) AS records, coalesce(whole, 0) AS whole
FROM r LEFT JOIN judged USING (reply_id)"""


_SAME = "x.source_row_id IS NOT DISTINCT FROM y.source_row_id"

_DIFF = f"""
WITH old AS (SELECT source_row_id, owner, site FROM ({SNAPSHOTS["2025-11-02"]})),
new AS (SELECT source_row_id, owner, site FROM ({SNAPSHOTS["2025-11-03"]})),
gone AS (SELECT source_row_id, count(*) AS n, any_value({{'owner': owner, 'site': site}}) AS s FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new) GROUP BY 1),
come AS (SELECT source_row_id, count(*) AS n, any_value({{'owner': owner, 'site': site}}) AS s FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old) GROUP BY 1)
SELECT coalesce(x.source_row_id, y.source_row_id) AS source_row_id,
  CASE WHEN x.n IS NULL THEN 'added' WHEN y.n IS NULL THEN 'removed' ELSE 'changed' END AS change,
  CASE WHEN x.n = 1 AND y.n = 1 THEN concat_ws(',', CASE WHEN x.s.owner IS DISTINCT FROM y.s.owner THEN 'owner' END,
    CASE WHEN x.s.site IS DISTINCT FROM y.s.site THEN 'site' END) END AS changed_fields,
  coalesce(x.n, 0) AS rows_old, coalesce(y.n, 0) AS rows_new
FROM gone x FULL JOIN come y ON {_SAME}"""

# A series begins where the run before does not show a state, and ends where the next one does not.
_INTERVALS = f"""
runs AS (SELECT run_date, row_number() OVER (ORDER BY run_date) AS k FROM (SELECT DISTINCT run_date FROM ({SNAPSHOTS_SQL}))),
states AS (SELECT k, source_row_id, owner, site, count(*) AS copies FROM ({SNAPSHOTS_SQL}) JOIN runs USING (run_date) GROUP BY ALL),
marked AS (SELECT x.*, NOT EXISTS (SELECT 1 FROM states y WHERE y.k = x.k - 1 AND {_SAME} AND x.owner = y.owner AND x.site IS NOT DISTINCT FROM y.site
    AND x.copies = y.copies) AS begins FROM states x),
intervals AS (SELECT x.source_row_id, x.owner, x.site, x.copies, x.k AS first, (SELECT min(z.k) FROM range(x.k + 1, 7) z(k) WHERE NOT EXISTS (
    SELECT 1 FROM states y WHERE y.k = z.k AND {_SAME} AND x.owner = y.owner AND x.site IS NOT DISTINCT FROM y.site AND x.copies = y.copies)) AS ended
  FROM marked x WHERE begins),
known AS (SELECT source_row_id, owner, site, copies, a.run_date AS valid_from, b.run_date AS valid_to, ended - first AS runs
  FROM intervals JOIN runs a ON a.k = first LEFT JOIN runs b ON b.k = ended)"""

_AS_OF = f"""WITH {_INTERVALS}
SELECT lookup_id, l.source_row_id, asked_for, owner, site, copies, valid_from, valid_to, runs
FROM ({LOOKUPS_SQL}) l LEFT JOIN known h
  ON l.source_row_id = h.source_row_id AND valid_from <= asked_for AND (valid_to IS NULL OR asked_for < valid_to)"""

# Labels spread from row to row until none changes.
_CLASSES = f"""
WITH RECURSIVE d AS ({SHARED_SQL}),
edges AS (SELECT source_row_id AS r, 'mac:' || mac AS v FROM d WHERE mac IS NOT NULL
  UNION ALL SELECT source_row_id, 'ip:' || ip FROM d WHERE ip_valid AND ip_type = 'private_rfc1918'
  UNION ALL SELECT source_row_id, 'fqdn:' || fqdn FROM d WHERE contains(fqdn, '.')),
links AS (SELECT DISTINCT x.r AS a, y.r AS b FROM edges x JOIN edges y USING (v)),
labels(r, label) USING KEY (r) AS (
  SELECT source_row_id, source_row_id FROM d
  UNION
  SELECT n.b, min(l.label) FROM labels l JOIN links n ON n.a = l.r JOIN recurring.labels o ON o.r = n.b WHERE l.label < o.label GROUP BY n.b)
SELECT r AS source_row_id, label AS class_id, count(*) OVER (PARTITION BY label) AS class_rows FROM labels"""

_NUMBER = "list_reduce(list_transform(string_split({0}, '.'), lambda q: CAST(q AS BIGINT)), lambda x, y: x * 256 + y)"

_LONGEST = f"""
list AS (SELECT prefix, zone, CAST(string_split(prefix, '/')[2] AS INTEGER) AS len, {_NUMBER.format("string_split(prefix, '/')[1]")} AS net
  FROM (SELECT * FROM ({PREFIXES_SQL}) WHERE regexp_full_match(prefix, '[0-9.]+/([12]?[0-9]|3[0-2])')
    AND len(list_filter(string_split(string_split(prefix, '/')[1], '.'), lambda q: CAST(q AS BIGINT) > 255)) = 0)),
devices AS (SELECT source_row_id, ip, {_NUMBER.format("ip")} AS a FROM clean),
held AS (SELECT source_row_id, prefix, zone, row_number() OVER (PARTITION BY source_row_id ORDER BY len DESC, prefix, zone) AS k
  FROM devices JOIN list ON a >> (32 - len) = net >> (32 - len))
SELECT source_row_id, ip, prefix, zone FROM devices LEFT JOIN (SELECT * FROM held WHERE k = 1) USING (source_row_id)"""

# A block counts if all its addresses are there and the block around it is not full.
_COVER = f"""
numbers AS (SELECT DISTINCT {_NUMBER.format("ip")} AS a FROM clean WHERE ip IS NOT NULL),
blocks AS (SELECT k, a >> k AS b, count(*) AS n FROM numbers, range(33) t(k) GROUP BY ALL HAVING count(*) = 1::BIGINT << k),
tops AS (SELECT x.k, x.b << x.k AS net FROM blocks x LEFT JOIN blocks y ON y.k = x.k + 1 AND y.b = x.b >> 1 WHERE y.k IS NULL)
SELECT concat(net >> 24, '.', (net >> 16) & 255, '.', (net >> 8) & 255, '.', net & 255, '/', 32 - k) AS prefix, CAST(32 - k AS INTEGER) AS length, 1::BIGINT << k AS addresses
FROM tops"""


def _spelling(device: str) -> str:
    """``device`` derives the type of the rows of ``with_owner``."""
    names = ", ".join(f"({k}, '{n}', '{t}')" for k, (n, t) in enumerate(EXACT.items()))
    return f"""
WITH with_owner AS ({MISSPELT_SQL}), fields AS ({device}), names(place, name, type) AS (VALUES {names}),
near AS (SELECT source_row_id, type, distance FROM (SELECT source_row_id, type, place, length(t) AS size, levenshtein(t, name) AS distance
    FROM (SELECT source_row_id, lower(trim(device_type)) AS t FROM fields WHERE device_type_reason = 'no_match') CROSS JOIN names)
  WHERE distance = 0 OR (distance = 1 AND size >= 4) OR (distance = 2 AND size >= 6)
  QUALIFY row_number() OVER (PARTITION BY source_row_id ORDER BY distance, place) = 1)
SELECT source_row_id, device_type AS raw, coalesce(type, device_type_clean) AS device_type,
  CASE WHEN type IS NULL THEN device_type_confidence ELSE CAST(100 - 20 * distance AS BIGINT) END AS device_type_confidence,
  CASE WHEN type IS NULL THEN device_type_reason ELSE 'misspelt_' || distance END AS device_type_reason
FROM fields LEFT JOIN near USING (source_row_id)"""


_PREFIX_OF_HOST = "regexp_extract(hostname, '^[a-z]+')"
_EVIDENCE = {"site_normalized": "site_normalized", "device_type": "device_type", "subnet_cidr": "subnet_cidr", "host": _PREFIX_OF_HOST}

_LEARNED = f"""
WITH d AS ({TEAMS_SQL}),
says AS ({" UNION ALL ".join(f"SELECT source_row_id, owner_team, '{n}=' || {e} AS value FROM d WHERE coalesce({e}, '') NOT IN ('', 'unknown')" for n, e in _EVIDENCE.items())}),
teams AS (SELECT owner_team AS team, count(*) / (SELECT count(*) FROM d WHERE owner_team IS NOT NULL AND source_row_id % 5 <> 0) AS share
  FROM d WHERE owner_team IS NOT NULL AND source_row_id % 5 <> 0 GROUP BY ALL),
weights AS (SELECT value, team, ln((count(*) + 2.0::DOUBLE * any_value(share)) / (2.0::DOUBLE * any_value(share))) AS weight
  FROM says JOIN teams ON team = owner_team WHERE source_row_id % 5 <> 0 GROUP BY ALL),
scores AS (SELECT source_row_id, team, round(sum(weight) + ln(any_value(share)), 6) AS score FROM says JOIN weights USING (value) JOIN teams USING (team)
  WHERE owner_team IS NULL OR source_row_id % 5 = 0 GROUP BY ALL),
best AS (SELECT source_row_id, team, least(CAST(floor(round(coalesce(score - lead(score) OVER w, 10), 6)) AS BIGINT), 9) AS step FROM scores
  WINDOW w AS (PARTITION BY source_row_id ORDER BY score DESC, team) QUALIFY row_number() OVER w = 1),
steps AS (SELECT step, (count(*) FILTER (team = owner_team) + 1) * 100 // (count(*) + 2) AS confidence
  FROM best JOIN d USING (source_row_id) WHERE owner_team IS NOT NULL GROUP BY ALL)
SELECT source_row_id, owner, team AS owner_team, owner_email, CAST(coalesce(confidence, 50) AS DOUBLE) AS confidence_percentage
FROM best JOIN d USING (source_row_id) LEFT JOIN steps USING (step) WHERE d.owner_team IS NULL"""

_RULES = [
    ("site_normalized", "subnet_cidr", "site_normalized", "subnet_cidr", "subnet_cidr"),
    ("subnet_cidr", "site_normalized", "subnet_cidr", "site_normalized", "site_normalized"),
    ("regexp_extract(hostname, ''^[a-z]+'', 0)", "device_type", _PREFIX_OF_HOST, "device_type", "device_type"),
]
_MINED = f"""
WITH d AS ({TEAMS_SQL}),
sides AS (SELECT * FROM ({" UNION ALL ".join(f"SELECT source_row_id, '{g} -> {t}' AS rule, '{f}' AS field, {x} AS given, {y} AS then_ FROM d" for g, t, x, y, f in _RULES)})
  WHERE coalesce(given, '') NOT IN ('', 'unknown') AND coalesce(then_, '') NOT IN ('', 'unknown')),
usual AS (SELECT rule, given, then_ AS usual, c AS agree, n FROM (SELECT rule, given, then_, count(*) AS c, sum(count(*)) OVER (PARTITION BY rule, given) AS n
    FROM sides GROUP BY rule, given, then_)
  WHERE n >= 5 QUALIFY row_number() OVER (PARTITION BY rule, given ORDER BY c DESC, then_) = 1)"""


def features_sql(base: str, device: str) -> dict[str, str]:
    """``base`` names the tables of the cleaned inventory, ``device`` derives a device's type."""
    return {
        "q_csv_quoted_breaks": _CSV,
        "q_owner_merge_repeated": _REPEATED,
        "q_reply_audit": _AUDIT,
        "q_history_diff": _DIFF,
        "q_history_intervals": f"WITH {_INTERVALS}\nSELECT * FROM known",
        "q_history_extended": f"WITH {_INTERVALS}\nSELECT * FROM known",
        "q_history_asof": _AS_OF,
        "q_device_classes": _CLASSES,
        "q_longest_prefix": f"WITH {base}, {_LONGEST}",
        "q_cidr_cover": f"WITH {base}, {_COVER}",
        "q_device_spelling": _spelling(device),
        "q_owner_learned": _LEARNED,
        "q_mined_dependencies": f"""{_MINED}
SELECT rule, count(*) AS "values", CAST(sum(n) AS BIGINT) AS rows, CAST(sum(agree) AS BIGINT) AS kept, CAST(sum(n) - sum(agree) AS BIGINT) AS violations,
  CAST(sum(agree) * 100 // sum(n) AS BIGINT) AS confidence FROM usual GROUP BY rule""",
        "q_mined_anomalies": f"""{_MINED}
SELECT source_row_id, field AS affected_fields, field || ' is ' || then_ || ' where ' || agree || ' of ' || n || ' rows with ' || given || ' have ' || usual AS issue_type,
  'modify' AS recommended_action, CAST(agree * 100 // n AS BIGINT) AS anomaly_confidence
FROM sides JOIN usual USING (rule, given) WHERE then_ <> usual AND agree >= 0.7 * n""",
    }
