"""DuckDB SQL for the derived logs, written independently of the Spark side."""

from __future__ import annotations

M = 1540483477
MASK = 4294967295


def _mul(x: str) -> str:
    return f"((({x}) * {M}) & {MASK})"


def hash_ctes(name: str, keys: str) -> str:
    """CTEs ending in ``name(k, h)``; ``keys`` selects distinct ASCII keys k of < 8 bytes."""
    byte = "ascii(substr(k, {0}, 1))"
    word = " + ".join(f"({byte.format(i + 1)}::BIGINT << {8 * i})" for i in range(4))
    return f"""
{name}_0 AS (SELECT k, length(k) AS n, xor(2538058380::BIGINT, length(k)::BIGINT) AS h FROM ({keys})),
{name}_1 AS (SELECT k, n, h, CASE WHEN n >= 4 THEN {_mul(word)} END AS w FROM {name}_0),
{name}_2 AS (SELECT k, n, CASE WHEN n >= 4 THEN xor({_mul('h')}, {_mul('xor(w, w >> 24)')}) ELSE h END AS h,
  n - n % 4 AS base, n % 4 AS rest FROM {name}_1),
{name}_3 AS (SELECT k, rest, h,
  (CASE WHEN rest >= 1 THEN ascii(substr(k, (base + 1)::BIGINT, 1))::BIGINT ELSE 0 END)
  + (CASE WHEN rest >= 2 THEN ascii(substr(k, (base + 2)::BIGINT, 1))::BIGINT << 8 ELSE 0 END)
  + (CASE WHEN rest >= 3 THEN ascii(substr(k, (base + 3)::BIGINT, 1))::BIGINT << 16 ELSE 0 END) AS t FROM {name}_2),
{name}_4 AS (SELECT k, CASE WHEN rest > 0 THEN {_mul('xor(h, t)')} ELSE h END AS h FROM {name}_3),
{name}_5 AS (SELECT k, {_mul('xor(h, h >> 13)')} AS h FROM {name}_4),
{name} AS (SELECT k, xor(h, h >> 15) AS h FROM {name}_5)"""


LOG = (
    hash_ctes("hashes", "SELECT DISTINCT user_id::VARCHAR AS k FROM events")
    + """,
keyed AS (SELECT 'ev-' || event_type AS topic, ((h & 2147483647) % 4)::INTEGER AS "partition",
  ts AS "timestamp", k AS "key", props AS value, event_id AS arrival_seq
  FROM events JOIN hashes ON k = user_id::VARCHAR),
log AS (SELECT topic, "partition", row_number() OVER (PARTITION BY topic, "partition"
  ORDER BY "timestamp", arrival_seq) - 1 AS "offset", "timestamp", "key", value, arrival_seq,
  regexp_extract(value, ': (\\d+)', 1)::BIGINT AS kn FROM keyed)"""
)

ORDER_LOG = (
    hash_ctes("ohashes", "SELECT DISTINCT o_custkey::VARCHAR AS k FROM orders")
    + """,
okeyed AS (SELECT 'ord-' || lower(o_orderstatus) AS topic, ((h & 2147483647) % 4)::INTEGER AS "partition",
  o_orderdate AS "timestamp", k AS "key", o_orderkey AS arrival_seq, o_orderpriority
  FROM orders JOIN ohashes ON k = o_custkey::VARCHAR),
olog AS (SELECT topic, "partition", row_number() OVER (PARTITION BY topic, "partition"
  ORDER BY "timestamp", arrival_seq) - 1 AS "offset", "timestamp", "key",
  '{"o_orderkey":' || arrival_seq || ',"o_orderpriority":"' || o_orderpriority || '"}' AS value, arrival_seq
  FROM okeyed)"""
)

ENDS = """
ends AS (SELECT topic, "partition", max("offset") + 1 AS end_offset FROM log GROUP BY ALL)"""

COMMITS = (
    ENDS
    + """,
commits AS (
  SELECT 'g1' AS group_id, topic, "partition", end_offset // 4 AS "offset", 'early' AS metadata, 1 AS commit_seq
  FROM ends WHERE "partition" < 3
  UNION ALL
  SELECT 'g1', topic, "partition", end_offset // 2, 'late', 2 FROM ends WHERE "partition" < 3)"""
)

COMMITTABLES = """
committables AS (SELECT 'g1' AS group_id, topic, "partition", "offset", "timestamp",
  'm' || arrival_seq AS metadata, (arrival_seq // 8) * 8 + 7 - arrival_seq % 8 AS arrival_seq FROM log)"""

COMMITTABLES2 = """
committables AS (SELECT g AS group_id, topic, "partition", "offset", "timestamp", 'm' || arrival_seq AS metadata,
  ((arrival_seq // 8) * 8 + 7 - arrival_seq % 8) * 2 + i AS arrival_seq
  FROM log, (VALUES ('g1', 0), ('g2', 1)) AS groups(g, i))"""

JITTERED = """
jittered AS (SELECT * REPLACE ("timestamp" - to_hours((arrival_seq % 7 * 3)::INTEGER) AS "timestamp") FROM log)"""

ASSIGNMENTS = """
assignments AS (SELECT topic, "partition", e::INTEGER AS epoch,
  'm' || (("partition" + e) % (CASE WHEN e = 3 THEN 3 ELSE 2 END)) AS member
  FROM (SELECT DISTINCT topic, "partition" FROM log), range(4) AS epochs(e))"""

TXN = """
txn_log AS (SELECT *, CASE WHEN arrival_seq // 100 % 5 <> 4 THEN arrival_seq // 100 END AS txn_id FROM log)"""

POLLS = """
polls AS (SELECT * REPLACE (CASE WHEN topic = 'ev-click' AND "partition" = 0 AND arrival_seq // 500 = 7
  THEN "offset" - 300 ELSE "offset" END AS "offset"), arrival_seq // 500 AS poll_batch FROM log)"""

# What was requested and committed before each poll.
REQUESTED = """
asked AS (SELECT topic, "partition", poll_batch, max("offset") + 1 AS "offset" FROM polls
  WHERE "partition" < 3 AND poll_batch % 4 = 2 GROUP BY ALL),
acked AS (SELECT topic, "partition", poll_batch + 1 AS poll_batch, "offset" FROM asked)"""

TP = 'topic, "partition"'


def on_log(select: str, *more: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{','.join([LOG, *more])}\n{select}"
