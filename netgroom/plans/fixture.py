"""The inventory that the registered queries work on, derived from the table ``orders``.

The texts run unchanged in Spark and in DuckDB.  One device comes from each
order; between them the rows reach every reason code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

INVENTORY_SQL = """
SELECT id AS source_row_id,
  CASE id % 19
    WHEN 0 THEN '192.168.' || LPAD(CAST(a AS STRING), 3, '0') || '.' || LPAD(CAST(b AS STRING), 3, '0')
    WHEN 1 THEN '10.0.1.' || CAST(256 + b AS STRING)
    WHEN 2 THEN '10.0.' || CAST(a AS STRING)
    WHEN 3 THEN '10.0.1.1.' || CAST(b AS STRING)
    WHEN 4 THEN 'fe80::1%eth0'
    WHEN 5 THEN '127.0.0.' || CAST(b AS STRING)
    WHEN 6 THEN '169.254.' || CAST(a AS STRING) || '.' || CAST(b AS STRING)
    WHEN 7 THEN '  10.' || CAST(a AS STRING) || '.10.' || CAST(b AS STRING) || '  '
    WHEN 8 THEN 'abc.def.ghi.jkl'
    WHEN 9 THEN '192.168.1.-1'
    WHEN 10 THEN '192.168.' || CAST(a AS STRING) || '.255'
    WHEN 11 THEN '192.168.' || CAST(a AS STRING) || '.0'
    WHEN 12 THEN '8.8.' || CAST(a AS STRING) || '.' || CAST(b AS STRING)
    WHEN 13 THEN '010.010.010.010'
    WHEN 14 THEN NULL
    WHEN 15 THEN '172.' || CAST(12 + b % 24 AS STRING) || '.' || CAST(a AS STRING) || '.' || CAST(b AS STRING)
    WHEN 16 THEN '10..1.' || CAST(b AS STRING)
    WHEN 17 THEN '++1.2.3.' || CAST(b AS STRING)
    ELSE '   '
  END AS ip,
  CASE id % 11
    WHEN 0 THEN 'HOST' || CAST(id AS STRING)
    WHEN 1 THEN NULL
    WHEN 2 THEN '  '
    WHEN 3 THEN 'web.' || CAST(a AS STRING)
    WHEN 4 THEN '-edge' || CAST(a AS STRING)
    WHEN 5 THEN 'bad_host' || CAST(a AS STRING)
    WHEN 6 THEN LPAD(CAST(id AS STRING), 70, 'h')
    ELSE 'box-' || CAST(id % 1000 AS STRING)
  END AS hostname,
  CASE id % 13
    WHEN 0 THEN 'box-' || CAST(id % 1000 AS STRING) || '.pier'
    WHEN 1 THEN 'BOX-' || CAST(id % 1000 AS STRING) || '.PIER.'
    WHEN 2 THEN 'nolabel'
    WHEN 3 THEN 'a..local'
    WHEN 4 THEN '-a.local'
    WHEN 5 THEN 'a.lo_cal'
    WHEN 6 THEN 'a.-local'
    WHEN 7 THEN 'a.' || LPAD('x', 64, 'x')
    WHEN 8 THEN '  '
    WHEN 9 THEN REPEAT('abcdefgh.', 30) || 'com'
    WHEN 10 THEN 'box-02.local'
    ELSE NULL
  END AS fqdn,
  CASE id % 7
    WHEN 0 THEN 'AA-BB-CC-DD-EE-' || LPAD(CAST(a % 100 AS STRING), 2, '0')
    WHEN 1 THEN 'aabb.ccdd.ee' || LPAD(CAST(a % 100 AS STRING), 2, '0')
    WHEN 2 THEN '00:11-22:33-44:' || LPAD(CAST(b % 100 AS STRING), 2, '0')
    WHEN 3 THEN '00:11:22:33:44'
    WHEN 4 THEN 'zz:11:22:33:44:55'
    WHEN 5 THEN ' '
    ELSE NULL
  END AS mac,
  CASE id % 9
    WHEN 0 THEN 'Zofia (platform) zofia' || CAST(a AS STRING) || '@mail.fjord.example'
    WHEN 1 THEN 'ops'
    WHEN 2 THEN 'mette' || CAST(b AS STRING) || '@mail.fjord.example'
    WHEN 3 THEN 'Facilities'
    WHEN 4 THEN 'Ola ( Net Ops ) Dahl'
    WHEN 5 THEN '()'
    WHEN 6 THEN '  '
    WHEN 7 THEN 'a@x.io Bob b@y.io (A) (B)'
    ELSE NULL
  END AS owner,
  CASE id % 23
    WHEN 0 THEN 'server' WHEN 1 THEN 'Switch ' WHEN 2 THEN 'iot' WHEN 3 THEN 'access_point'
    WHEN 4 THEN 'wireless_ap' WHEN 5 THEN 'load_balancer' WHEN 6 THEN 'core sw' WHEN 7 THEN 'rtr;edge'
    WHEN 8 THEN 'PA220' WHEN 9 THEN 'access-point' WHEN 10 THEN 'WLC' WHEN 11 THEN 'f5 ltm'
    WHEN 12 THEN 'ESXi host' WHEN 13 THEN 'print/scan' WHEN 14 THEN 'backups' WHEN 15 THEN 'voip'
    WHEN 16 THEN 'cam01' WHEN 17 THEN 'NAS' WHEN 18 THEN 'unknown' WHEN 19 THEN 'controller'
    WHEN 20 THEN '  ' WHEN 21 THEN ',' ELSE NULL
  END AS device_type,
  CASE id % 10
    WHEN 0 THEN 'OSLO Quay' WHEN 1 THEN 'Pier Bldg 7' WHEN 2 THEN 'PIER-BUILDING-7' WHEN 3 THEN 'Pier'
    WHEN 4 THEN ' Shed-4 ' WHEN 5 THEN ' N/A ' WHEN 6 THEN 'DC__1,, east' WHEN 7 THEN '---'
    WHEN 8 THEN '  ' ELSE NULL
  END AS site
FROM (SELECT o_orderkey AS id, o_custkey % 256 AS a, o_orderkey % 251 AS b FROM orders) t
"""

# Proposals as a model might send them: rows of pending orders have none, some confidences
# lie below the threshold or are missing, some owners are proposed to be empty.
PROPOSALS_SQL = """
SELECT o_orderkey AS source_row_id,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'p' || CAST(o_orderkey AS STRING) END AS owner,
  'team' || CAST(o_custkey % 5 AS STRING) AS owner_team,
  CAST(NULL AS STRING) AS owner_email,
  CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
       ELSE CAST(o_orderkey % 101 AS DOUBLE) END AS confidence_percentage
FROM orders
WHERE o_orderstatus <> 'P'
"""

# IPv6 and IPv4 literals of every shape, good and bad.
LITERALS_SQL = """
SELECT id AS source_row_id,
  CASE id % 17
    WHEN 0 THEN '2001:DB8::' || CAST(a AS STRING)
    WHEN 1 THEN '2001:db8:' || CAST(a AS STRING) || ':0:0:' || CAST(b AS STRING) || ':8:1'
    WHEN 2 THEN '::'
    WHEN 3 THEN '::ffff:10.0.' || CAST(a % 256 AS STRING) || '.' || CAST(b AS STRING)
    WHEN 4 THEN 'fe80::' || CAST(b AS STRING) || '%eth0'
    WHEN 5 THEN '1:2:3:4:5:6:7::'
    WHEN 6 THEN '1:2:3:4:5:6:7:8:9'
    WHEN 7 THEN '1::2::3'
    WHEN 8 THEN ':1:2:3:4:5:6:7'
    WHEN 9 THEN '2001:db8::12345'
    WHEN 10 THEN '::1.2.3.' || CAST(a + 200 AS STRING)
    WHEN 11 THEN ' 10.' || CAST(a AS STRING) || '.0.' || CAST(b AS STRING) || ' '
    WHEN 12 THEN '10.0.0.0' || CAST(b % 10 AS STRING)
    WHEN 13 THEN '1:2:3:4:5:6:7::8'
    WHEN 14 THEN 'g::1'
    WHEN 15 THEN '  '
    ELSE NULL
  END AS ip
FROM (SELECT o_orderkey AS id, o_custkey % 256 AS a, o_orderkey % 251 AS b FROM orders) t
"""


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a given table, as its files are split."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    columns = [c for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority") if c in sql]
    orders = read_table(spark, sf_dir, "orders", *columns)
    return spark.sql(sql.replace("FROM orders", "FROM {orders}"), orders=orders)


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, INVENTORY_SQL)


def proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, PROPOSALS_SQL)


def literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, LITERALS_SQL)
