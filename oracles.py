"""SQL for DuckDB that states what each registered query must return."""

from __future__ import annotations

ZERO = "00000000000000000000"

LOG = """log AS (
  SELECT CASE event_type WHEN 'signup' THEN 2 WHEN 'error' THEN 1 ELSE 4 END AS op,
         event_id + 1 AS lsn, user_id * 20 AS k, value AS v
  FROM events)"""

ACCOUNTS = "tgt AS (SELECT c_custkey AS k, c_acctbal AS v FROM customer)"
QUANTITIES = "tgt AS (SELECT l_orderkey AS k, l_quantity AS v FROM lineitem)"

# Later state of the customers and lagging copies of two tables.
LATER = """later AS (
  SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_nationkey < 5 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
  FROM customer WHERE c_mktsegment <> 'BUILDING'
  UNION ALL
  SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_mktsegment = 'MACHINERY')"""

MOVES = """WITH now AS (
  SELECT c_custkey AS k, CASE WHEN c_mktsegment = 'AUTOMOBILE' AND c_custkey % 5 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS n, c_mktsegment AS s
  FROM customer WHERE c_mktsegment NOT IN ('MACHINERY', 'BUILDING') OR (c_mktsegment = 'BUILDING' AND c_custkey % 3 = 0)
  UNION ALL SELECT -c_custkey - 1, c_nationkey, c_mktsegment FROM customer WHERE c_mktsegment = 'MACHINERY'
  UNION ALL SELECT c_custkey + 10000000, c_nationkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 2 = 0),
was AS (SELECT c_custkey AS k, c_nationkey AS n, c_mktsegment AS s FROM customer),
gone AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY n, s ORDER BY k) AS place FROM was WHERE k NOT IN (SELECT k FROM now)),
come AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY n, s ORDER BY k) AS place FROM now WHERE k NOT IN (SELECT k FROM was))
SELECT CASE WHEN g.k IS NULL THEN 2 WHEN c.k IS NULL THEN 1 ELSE 4 END AS op, '0x' || format('{:020X}', 5) AS lsn,
       COALESCE(c.k, g.k) AS c_custkey, COALESCE(c.n, g.n) AS c_nationkey, COALESCE(c.s, g.s) AS c_mktsegment,
       CASE WHEN c.k IS NOT NULL THEN g.k END AS before
FROM gone g FULL JOIN come c ON g.n = c.n AND g.s = c.s AND g.place = c.place
UNION ALL
SELECT 4, '0x' || format('{:020X}', 5), now.k, now.n, now.s, NULL FROM now JOIN was ON now.k = was.k AND now.n <> was.n"""

LAGGING_ORDERS = """lag_orders AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 400000 THEN 'O' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderpriority <> '1-URGENT'
  UNION ALL
  SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderpriority = '5-LOW')"""

LAGGING_LINEITEM = """lag_lines AS (
  SELECT * REPLACE (CASE WHEN l_discount = 0.1 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity)
  FROM lineitem WHERE l_tax <> 0.08)"""

MAPPING = """maps AS (
  SELECT c_custkey AS doc, 'tgt_' || c_custkey AS target, 1 AS pos, 'id' AS target_col, 'c_custkey' AS source_col,
         'src_' || c_mktsegment AS source_table FROM customer
  UNION ALL
  SELECT c_custkey, 'tgt_' || c_custkey, 2, 'balance', 'c_acctbal', 'src_' || c_mktsegment FROM customer
  UNION ALL
  SELECT c_custkey, 'tgt_' || c_custkey, 3, 'label', c_name, 'src_' || c_mktsegment FROM customer)"""


def _hex(number: str) -> str:
    return f"format('{{:020X}}', {number})"


SHOWN = f"op, '0x' || {_hex('lsn')} AS lsn, k, v"
TOP = f"(SELECT {_hex('MAX(event_id) + 1')} FROM events)"


def _strict(ctes: str, keys: str = "k", order: str = "lsn") -> str:
    """One-by-one replay on a unique key: which changes take effect, then the last of them."""
    on = " AND ".join(f"l.{c.strip()} = t.{c.strip()}" for c in keys.split(","))
    return f"""WITH {ctes},
marked AS (
  SELECT l.*, COALESCE(
    LAST_VALUE(CASE l.op WHEN 2 THEN TRUE WHEN 1 THEN FALSE END IGNORE NULLS) OVER (
      PARTITION BY {', '.join('l.' + c.strip() for c in keys.split(','))} ORDER BY {order}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    t.present, FALSE) AS there
  FROM log l LEFT JOIN (SELECT {keys}, TRUE AS present FROM tgt) t ON {on}),
effective AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {', '.join(c + ' DESC' for c in order.split(','))}) AS back
  FROM marked WHERE op = 1 OR (op = 2 AND NOT there) OR (op = 4 AND there))
SELECT {keys}, v FROM tgt l WHERE NOT EXISTS (SELECT 1 FROM effective t WHERE {on})
UNION ALL
SELECT {keys}, v FROM effective WHERE back = 1 AND op <> 1"""


UPSERT = f"""WITH {LOG}, {ACCOUNTS},
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY lsn DESC) AS back FROM log)
SELECT k, v FROM tgt WHERE k NOT IN (SELECT k FROM log)
UNION ALL
SELECT k, v FROM ranked WHERE back = 1 AND op <> 1"""

BAG = f"""WITH {LOG}, {QUANTITIES},
births AS (SELECT k, v, CAST(-1 AS BIGINT) AS born FROM tgt UNION ALL SELECT k, v, lsn FROM log WHERE op = 2),
fates AS (SELECT k, MAX(CASE WHEN op = 1 THEN lsn END) AS deleted, MAX(CASE WHEN op = 4 THEN lsn END) AS updated
          FROM log GROUP BY k)
SELECT b.k, CASE WHEN f.updated > b.born THEN u.v ELSE b.v END AS v
FROM births b LEFT JOIN fates f ON b.k = f.k LEFT JOIN log u ON u.k = f.k AND u.lsn = f.updated
WHERE f.deleted IS NULL OR b.born > f.deleted"""

STRICT = _strict(f"{LOG}, {ACCOUNTS}")

# The second half of the log.
LATE_LOG = LOG.replace("FROM events", "FROM events WHERE event_id > (SELECT MAX(event_id) // 2 FROM events)")
LATE_STRICT = _strict(f"{LATE_LOG}, {ACCOUNTS}")
LATE_UPSERT = UPSERT.replace(LOG, LATE_LOG)

# The first half of the log, and the three modes at its end.
EARLY_LOG = LOG.replace("FROM events", "FROM events WHERE event_id <= (SELECT MAX(event_id) // 2 FROM events)")
EARLY = {"a_upsert": UPSERT.replace(LOG, EARLY_LOG), "b_bag": BAG.replace(LOG, EARLY_LOG), "c_slow": _strict(f"{EARLY_LOG}, {ACCOUNTS}")}
HALF = f"(SELECT {_hex('MAX(event_id) // 2 + 1')} FROM events)"
CUTS = " UNION ALL ".join(
    f"SELECT {cycle} AS cycle, '{name}' AS table_name, k, v, {sync} AS sync FROM ({sql})"
    for cycle, sync, states in (
        (1, HALF, EARLY), (2, HALF, EARLY), (3, TOP, {"a_upsert": UPSERT, "b_bag": BAG, "c_slow": STRICT})
    )
    for name, sql in states.items()
)

COMPOSITE = _strict(
    """log AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 2 WHEN 'R' THEN 1 ELSE 4 END AS op, CAST(l_shipdate AS DATE) AS lsn,
         l_linenumber AS s1, l_partkey AS s2, l_orderkey AS s3, l_extendedprice AS s4,
         l_suppkey AS supp, l_partkey AS part, l_quantity AS v
  FROM lineitem),
tgt AS (SELECT p_partkey % 100 AS supp, p_partkey AS part, p_retailprice AS v FROM part)""",
    keys="supp, part",
    order="lsn,s1,s2,s3,s4",
)

LATER_ROWS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"

CAPTURE = f"""WITH {LATER}
SELECT CASE WHEN a.c_custkey IS NULL THEN 1 WHEN b.c_custkey IS NULL THEN 2 ELSE 4 END AS op,
       '0x' || {_hex('77')} AS lsn,
       COALESCE(a.c_custkey, b.c_custkey) AS c_custkey, COALESCE(a.c_name, b.c_name) AS c_name,
       COALESCE(a.c_nationkey, b.c_nationkey) AS c_nationkey, COALESCE(a.c_acctbal, b.c_acctbal) AS c_acctbal,
       COALESCE(a.c_mktsegment, b.c_mktsegment) AS c_mktsegment
FROM customer b FULL JOIN later a ON a.c_custkey = b.c_custkey
WHERE a.c_custkey IS NULL OR b.c_custkey IS NULL OR a.c_name <> b.c_name OR a.c_nationkey <> b.c_nationkey
   OR a.c_acctbal <> b.c_acctbal OR a.c_mktsegment <> b.c_mktsegment"""

RECONCILE_KEYS = f"""WITH {LAGGING_ORDERS}
SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CAST(s.o_orderkey IS NOT NULL AS BIGINT) AS source_rows, CAST(t.o_orderkey IS NOT NULL AS BIGINT) AS target_rows,
       CASE WHEN t.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra'
            WHEN s.o_custkey = t.o_custkey AND s.o_orderstatus = t.o_orderstatus AND s.o_totalprice = t.o_totalprice
             AND s.o_orderdate = t.o_orderdate AND s.o_orderpriority = t.o_orderpriority THEN 'equal'
            ELSE 'different' END AS status
FROM orders s FULL JOIN lag_orders t ON s.o_orderkey = t.o_orderkey"""

RECONCILE_RANGES = f"""SELECT 'all over' AS differences, * FROM ({RECONCILE_KEYS}) WHERE status <> 'equal'
UNION ALL
SELECT 'one place', o_orderkey, 1, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '5-LOW' THEN 2 ELSE 1 END,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'missing' ELSE 'different' END
FROM orders, (SELECT MAX(o_orderkey) AS top FROM orders)
WHERE o_orderkey BETWEEN top // 3 AND top // 3 + top // 100 AND (o_orderpriority IN ('1-URGENT', '5-LOW')
  OR o_orderpriority = '2-HIGH')"""

LINE_REST = """{'a': l_partkey, 'b': l_suppkey, 'c': l_quantity, 'd': l_extendedprice, 'e': l_discount, 'f': l_tax,
 'g': l_returnflag, 'h': l_linestatus, 'i': l_shipdate}"""

RECONCILE_GROUPS = f"""WITH {LAGGING_LINEITEM},
s AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n, LIST_SORT(LIST({LINE_REST})) AS body
      FROM lineitem GROUP BY ALL),
t AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n, LIST_SORT(LIST({LINE_REST})) AS body
      FROM lag_lines GROUP BY ALL)
SELECT l_orderkey, l_linenumber, COALESCE(s.n, 0) AS source_rows, COALESCE(t.n, 0) AS target_rows,
       CASE WHEN t.n IS NULL THEN 'missing' WHEN s.n IS NULL THEN 'extra'
            WHEN s.body = t.body THEN 'equal' ELSE 'different' END AS status
FROM s FULL JOIN t USING (l_orderkey, l_linenumber)"""

RECONCILE_ROWS = f"""WITH {LAGGING_LINEITEM},
s AS (SELECT l_orderkey, l_linenumber, l_quantity, COUNT(*) AS n FROM lineitem GROUP BY ALL),
t AS (SELECT l_orderkey, l_linenumber, l_quantity, COUNT(*) AS n FROM lag_lines GROUP BY ALL)
SELECT l_orderkey, l_linenumber, l_quantity, COALESCE(s.n, 0) AS source_rows, COALESCE(t.n, 0) AS target_rows,
       CASE WHEN t.n IS NULL THEN 'missing' WHEN s.n IS NULL THEN 'extra'
            WHEN s.n = t.n THEN 'equal' ELSE 'different' END AS status
FROM s FULL JOIN t USING (l_orderkey, l_linenumber, l_quantity)"""

QUARANTINE = f"""WITH raw AS (
  SELECT event_type, CASE event_type WHEN 'purchase' THEN 7 WHEN 'signup' THEN 2 WHEN 'error' THEN 1 ELSE 4 END AS op,
         event_id + 1 AS n, format('{{:X}}', event_id + 1) AS short,
         CASE WHEN props <> '{{"k": 1}}' THEN user_id END AS k, value AS v
  FROM events)
SELECT op, CASE WHEN event_type = 'click' THEN (CASE WHEN LENGTH(short) % 2 = 1 THEN '0' ELSE '' END) || short
                ELSE {_hex('n')} END AS lsn,
       k, CASE WHEN reason IS NULL THEN v END AS v, reason
FROM (SELECT *, CASE WHEN op = 7 THEN 'unknown operation' WHEN event_type = 'click' THEN 'bad log position'
                     WHEN k IS NULL THEN 'null key k' WHEN event_type = 'view' THEN 'v is not double' END AS reason
      FROM raw)"""

NET = f"""WITH {LOG},
ends AS (SELECT k, FIRST(op ORDER BY lsn) AS first_op, LAST(op ORDER BY lsn) AS last_op, MAX(lsn) AS lsn
         FROM log GROUP BY k)
SELECT CASE WHEN e.last_op = 1 THEN 1 WHEN e.first_op = 2 THEN 2 ELSE 4 END AS op,
       '0x' || {_hex('e.lsn')} AS lsn, e.k, l.v
FROM ends e JOIN log l ON l.k = e.k AND l.lsn = e.lsn
WHERE NOT (e.first_op = 2 AND e.last_op = 1)"""

KEYLESS_LOG = LOG.replace("user_id * 20 AS k", """CASE WHEN props <> '{"k": 1}' THEN user_id * 20 END AS k""")
KEYLESS_NET = f"""{NET.replace(LOG, KEYLESS_LOG).replace("FROM log GROUP BY k", "FROM log WHERE k IS NOT NULL GROUP BY k")}
UNION ALL
SELECT op, '0x' || {_hex('lsn')}, k, v FROM log WHERE k IS NULL AND op = 2"""

TYPES = """WITH info AS (
  SELECT 'c' || p_partkey AS column_name, p_type, p_size,
    CASE WHEN p_size < 5 THEN 'varchar' WHEN p_size < 10 THEN 'nchar' WHEN p_size < 15 THEN 'decimal'
         WHEN p_size < 20 THEN 'datetime' WHEN p_size < 25 THEN 'bit' WHEN p_size < 30 THEN 'bigint'
         WHEN p_size < 35 THEN 'float' WHEN p_size < 38 THEN 'date' WHEN p_size < 40 THEN 'money'
         WHEN p_size < 42 THEN 'uniqueidentifier' WHEN p_size < 43 THEN 'datetimeoffset' WHEN p_size < 44 THEN 'image'
         WHEN p_size < 45 THEN 'time' WHEN p_size < 47 THEN 'xml' ELSE 'geometry' END AS kind,
    CASE WHEN p_size < 3 THEN -1 WHEN p_size < 7 THEN p_size * 10 END AS len
  FROM part)
SELECT column_name,
  CASE kind WHEN 'varchar' THEN 'string' WHEN 'nchar' THEN 'string'
    WHEN 'decimal' THEN CASE WHEN p_size = 12 THEN 'decimal(18,4)' ELSE 'decimal(38,18)' END
    WHEN 'datetime' THEN 'timestamp_ntz' WHEN 'bit' THEN 'boolean' WHEN 'bigint' THEN 'bigint'
    WHEN 'float' THEN 'double' WHEN 'date' THEN 'date' WHEN 'money' THEN 'decimal(19,4)'
    WHEN 'datetimeoffset' THEN 'timestamp' WHEN 'image' THEN 'binary' ELSE 'string' END AS spark_type,
  CASE WHEN kind IN ('varchar', 'nchar') THEN CASE WHEN len = -1 THEN 'text' ELSE kind || '(' || COALESCE(len, 255) || ')' END
       WHEN kind = 'datetime' THEN 'DATETIME' WHEN kind = 'bit' THEN 'TINYINT(1)'
       WHEN kind = 'decimal' AND p_size = 12 THEN 'decimal(18,4)' ELSE kind END AS declared_type,
  p_type <> 'ECONOMY' AS nullable
FROM info"""

# What each column of the parts' information schema became; the number in its name decides.
DRIFT = f"""WITH was AS (SELECT SUBSTR(column_name, 2)::BIGINT AS n, * FROM ({TYPES})),
now AS (
  SELECT w.*,
    CASE WHEN spark_type = 'bigint' THEN
           CASE WHEN n % 2 = 1 THEN 'int' WHEN n % 4 = 0 THEN 'decimal(22,3)' ELSE 'decimal(20,3)' END
         WHEN spark_type = 'decimal(18,4)' THEN CASE WHEN n % 2 = 0 THEN 'decimal(19,5)' ELSE 'decimal(18,5)' END
         WHEN spark_type = 'date' THEN CASE WHEN n % 2 = 0 THEN 'timestamp_ntz' ELSE 'int' END
         WHEN spark_type = 'double' THEN CASE WHEN n % 2 = 0 THEN 'float' ELSE 'string' END
         WHEN spark_type = 'binary' THEN 'string' ELSE spark_type END AS new_type,
    CASE WHEN n % 5 = 0 THEN FALSE WHEN n % 5 = 1 THEN TRUE ELSE nullable END AS new_null
  FROM was w)
SELECT column_name,
  CASE WHEN n % 7 = 0 THEN 'dropped'
       WHEN new_type <> spark_type AND NOT (new_type IN ('decimal(22,3)', 'decimal(19,5)', 'timestamp_ntz')
         OR (spark_type = 'double' AND new_type = 'string')) THEN 'narrowed'
       WHEN nullable AND NOT new_null THEN 'refuses nulls' WHEN new_type <> spark_type THEN 'widened'
       WHEN NOT nullable AND new_null THEN 'allows nulls' ELSE 'same' END AS verdict,
  spark_type AS old_type, CASE WHEN n % 7 <> 0 THEN new_type END AS new_type
FROM now
UNION ALL SELECT 'x' || column_name, 'added', NULL, spark_type FROM now WHERE n % 7 = 0"""

EVOLVED = f"""WITH log AS (
  SELECT CASE event_type WHEN 'signup' THEN 2 WHEN 'error' THEN 1 ELSE 4 END AS op, event_id + 1 AS lsn, user_id * 20 AS k, value AS v,
         event_type AS note, event_id <= (SELECT MAX(event_id) // 2 FROM events) AS early FROM events),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY lsn DESC) AS back FROM log)
SELECT c_custkey AS k, c_nationkey::DOUBLE AS v, c_name AS note, NULL::DOUBLE AS w, {TOP} AS sync FROM customer
  WHERE c_custkey NOT IN (SELECT k FROM log)
UNION ALL SELECT k, CASE WHEN early THEN floor(v) ELSE v END, note, CASE WHEN NOT early THEN v + 1 END, {TOP}
  FROM ranked WHERE back = 1 AND op <> 1"""

COUNTS = """COUNT(*) FILTER (event_type = 'signup') AS inserts,
  COUNT(*) FILTER (event_type NOT IN ('signup', 'error')) AS updates,
  COUNT(*) FILTER (event_type = 'error') AS deletes"""


def oracle_sql() -> dict[str, str]:
    return {
        "mapping_rows": f"WITH {MAPPING} SELECT * FROM maps",
        "mapping_source_tables": f"""WITH {MAPPING}
            SELECT doc, target, ANY_VALUE(source_table) AS source_table, COUNT(DISTINCT source_table) AS n_sources,
                   COUNT(*) AS n_columns FROM maps GROUP BY doc, target""",
        "table_list": """SELECT p_partkey AS doc, 0 AS pos, p_type AS table_name FROM part WHERE p_size > 5
            UNION ALL SELECT p_partkey, 1, 't_' || p_partkey FROM part WHERE p_size > 5""",
        "table_pairs": """SELECT o_orderkey AS doc, 0 AS pos, 'src_' || o_orderkey AS source_name,
                   'dst_' || o_orderstatus AS target_name FROM orders
            UNION ALL SELECT o_orderkey, 1, o_orderpriority, 'copy' FROM orders""",
        "type_translation": TYPES,
        "ensure_sync": """SELECT c_custkey AS k, c_acctbal AS v, CAST(NULL AS VARCHAR) AS sync FROM customer
            UNION ALL SELECT c_custkey, c_acctbal, HEX(ENCODE(CAST(c_custkey AS VARCHAR))) FROM customer""",
        "created_table": f"WITH {ACCOUNTS} SELECT k, v, '{ZERO}' AS sync FROM tgt",
        "captured_columns": f"WITH {LOG} SELECT {SHOWN} FROM log",
        "snapshot_projection": """SELECT o_orderkey AS id, o_custkey AS client, o_orderstatus AS state,
            o_totalprice AS total FROM orders""",
        "snapshot_all_columns": "SELECT * FROM customer",
        "split_ranges": """SELECT l_orderkey, l_linenumber, CASE WHEN l_tax <> 0.08 THEN l_returnflag END AS flag, l_partkey,
            1 AS by_key, TRUE AS key_same, TRUE AS key_even, 1 AS by_flag, TRUE AS flag_same, TRUE AS flag_even FROM lineitem""",
        "change_tables": """SELECT 't' || c_custkey AS table_name,
            CASE WHEN c_custkey IN (SELECT s_suppkey FROM supplier) THEN 'dbo_t' || c_custkey || '_CT' END AS change_table
            FROM customer""",
        "changes_since": f"""WITH {LOG} SELECT {SHOWN} FROM log
            WHERE lsn > (SELECT MAX(event_id) // 2 + 1 FROM events)""",
        "changes_between": f"WITH {LOG} SELECT {SHOWN} FROM log",
        "lsn_range": f"""SELECT '0x' || {_hex('MIN(event_id) + 1')} AS min_lsn,
            '0x' || {_hex('MAX(event_id) + 1')} AS max_lsn FROM events""",
        "last_sync": f"SELECT {_hex('MAX(c_custkey)')} AS last_sync FROM customer",
        "stamp_sync": f"WITH {ACCOUNTS} SELECT k, v, {TOP} AS sync FROM tgt",
        "apply_strict": STRICT,
        "apply_upsert": UPSERT,
        "apply_bag": BAG,
        "apply_since": LATE_STRICT,
        "apply_composite": COMPOSITE,
        "insert_rows": f"WITH {LOG}, {ACCOUNTS} SELECT k, v FROM tgt UNION ALL SELECT k, v FROM log WHERE op = 2",
        "clear_and_reload": f"WITH {LATER} SELECT {LATER_ROWS} FROM later",
        "new_watermark": f"SELECT {TOP} AS watermark",
        "key_changes": f"""WITH {LOG}, moves AS (SELECT *, op = 4 AND v < 20 AS moved FROM log)
            SELECT CASE WHEN moved THEN 2 ELSE op END AS op, '0x' || {_hex('lsn')} AS lsn, k, v FROM moves
            UNION ALL SELECT 1, '0x' || {_hex('lsn')}, k + 7, v FROM moves WHERE moved""",
        "quarantine_split": QUARANTINE,
        "change_counts": """SELECT CASE event_type WHEN 'purchase' THEN 7 WHEN 'signup' THEN 2 WHEN 'error' THEN 1
            ELSE 4 END AS operation, COUNT(*) AS changes FROM events GROUP BY 1""",
        "change_report": f"""SELECT COUNT(*) AS changes, {COUNTS}, '0x' || {_hex('MIN(event_id) + 1')} AS min_lsn,
            '0x' || {_hex('MAX(event_id) + 1')} AS max_lsn FROM events""",
        "update_by_key": """SELECT l_orderkey, l_linenumber,
            CASE WHEN l_linenumber = 3 AND l_returnflag = 'A' THEN 0 ELSE l_quantity END AS l_quantity, l_returnflag
            FROM lineitem""",
        "delete_by_key": """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
            WHERE NOT (l_linenumber = 3 AND l_returnflag = 'A')""",
        "thin_rows": """SELECT o_orderkey, o_totalprice FROM orders
            WHERE ('0x' || left(md5(o_orderkey::VARCHAR), 12))::BIGINT / 281474976710656.0 >= 0.3""",
        "thin_rows_random": "SELECT TRUE AS members, TRUE AS once, TRUE AS about_as_many",
        "sample_one": "SELECT CAST(1 AS BIGINT) AS n_rows, TRUE AS member",
        "stored_update": """SELECT l_orderkey, l_linenumber,
            CASE WHEN l_linenumber = 3 AND l_returnflag = 'A' THEN 0 ELSE l_quantity END AS l_quantity, l_returnflag
            FROM lineitem""",
        "stored_delete": """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
            WHERE NOT (l_linenumber = 3 AND l_returnflag = 'A')""",
        "net_changes_without_key": KEYLESS_NET,
        "reconcile_mixed_types": """SELECT c_custkey::VARCHAR AS k, CAST(1 AS BIGINT) AS source_rows, CAST(1 AS BIGINT) AS target_rows,
            CASE WHEN c_nationkey < 5 OR c_mktsegment = 'BUILDING' THEN 'different' ELSE 'equal' END AS status FROM customer""",
        "configuration_verdicts": """SELECT c_custkey AS doc,
            CASE WHEN c_nationkey < 4 THEN 'unreadable' WHEN c_nationkey < 8 THEN 'no targets'
                 WHEN c_nationkey < 12 THEN 'a target without columns' WHEN c_nationkey < 16 THEN 'an entry without a source'
                 WHEN c_nationkey < 20 THEN 'a target with two source tables' ELSE 'ok' END AS mapping,
            CASE WHEN c_nationkey < 4 THEN 'unreadable' WHEN c_nationkey < 8 THEN 'no list' WHEN c_nationkey < 12 THEN 'no tables'
                 WHEN c_nationkey < 16 THEN 'a table without a name' ELSE 'ok' END AS tables,
            CASE WHEN c_nationkey < 5 THEN 'no pairs' WHEN c_nationkey < 15 THEN 'half a pair' ELSE 'ok' END AS pairs
            FROM customer""",
        "capture_instances": """SELECT c.source_schema, c.source_table, s.capture_instance
            FROM (SELECT c_mktsegment AS source_schema, 't' || c_custkey AS source_table FROM customer) c
            LEFT JOIN (SELECT CASE WHEN s_nationkey < 12 THEN 'BUILDING' ELSE 'MACHINERY' END AS source_schema,
                              't' || s_suppkey AS source_table,
                              CASE WHEN s_nationkey < 12 THEN 'BUILDING' ELSE 'MACHINERY' END || '_t' || s_suppkey AS capture_instance
                       FROM supplier) s USING (source_schema, source_table)""",
        "empty_range": "SELECT 'none' AS \"of\", CAST(0 AS BIGINT) AS changes UNION ALL SELECT 'whole', COUNT(*) FROM events",
        "position_cast": f"SELECT event_id, '0x' || {_hex('event_id')} AS lsn FROM events",
        "apply_mixed_types": f"""SELECT 'upsert' AS mode, k, v FROM ({UPSERT}) UNION ALL SELECT 'strict', k, v FROM ({STRICT})
            UNION ALL SELECT 'bag', k, v FROM ({BAG})""",
        "stream_same_position": f"""SELECT k, v, (SELECT {_hex('MAX(event_id) // 10 + 1')} FROM events) AS sync FROM ({UPSERT})""",
        "stream_out_of_order": f"""SELECT k, v, (SELECT {_hex('MAX(event_id) // 10 + 1')} FROM events) AS sync,
            CAST(0 AS BIGINT) AS set_aside FROM ({UPSERT})""",
        "stream_metrics": f"""WITH raw AS (
              SELECT event_type, event_id + 1 AS lsn, event_id <= (SELECT MAX(event_id) // 2 FROM events) AS early FROM events
              WHERE event_type <> 'click' AND props <> '{{"k": 1}}')
            SELECT 'accounts' AS table_name, 'stream' AS phase, COUNT(*) FILTER (event_type = 'signup') AS inserts,
              COUNT(*) FILTER (event_type NOT IN ('signup', 'error', 'purchase')) AS updates,
              COUNT(*) FILTER (event_type = 'error') AS deletes, COUNT(*) FILTER (event_type = 'purchase') AS ignored,
              {_hex('MAX(lsn)')} AS watermark FROM raw GROUP BY early""",
        "stream_quarantine": f"""WITH {KEYLESS_LOG},
            {ACCOUNTS}, good AS (SELECT * FROM log WHERE k IS NOT NULL),
            ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY lsn DESC) AS back FROM good)
            SELECT 'row' AS part, NULL AS lsn, k, v FROM tgt WHERE k NOT IN (SELECT k FROM good)
            UNION ALL SELECT 'row', NULL, k, v FROM ranked WHERE back = 1 AND op <> 1
            UNION ALL SELECT 'aside', {_hex('lsn')}, k, v FROM log WHERE k IS NULL""",
        "evolved_table": EVOLVED,
        "schema_drift": DRIFT,
        "idle_table": f"""WITH half AS (SELECT {_hex('MAX(event_id) // 2 + 1')} AS h, {_hex('MAX(event_id) + 1')} AS t FROM events)
            SELECT 'initial' AS phase, (SELECT COUNT(*) FROM customer) AS loaded, h AS watermark FROM half
            UNION ALL SELECT 'incremental', 0, h FROM half
            UNION ALL SELECT 'incremental', 0, t FROM half UNION ALL SELECT 'incremental', 0, t FROM half
            UNION ALL SELECT 'rows', (SELECT COUNT(*) FROM customer), t FROM half""",
        "bad_positions": f"""WITH {LOG.replace('FROM events', "FROM events WHERE event_type NOT IN ('click', 'view')")}, {ACCOUNTS},
            ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY lsn DESC) AS back FROM log)
            SELECT 'row' AS part, k, v, CAST(NULL AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS reason FROM tgt
              WHERE k NOT IN (SELECT k FROM log)
            UNION ALL SELECT 'row', k, v, lsn, NULL FROM ranked WHERE back = 1 AND op <> 1
            UNION ALL SELECT 'aside', user_id * 20, value, event_id + 1, 'bad log position' FROM events
              WHERE event_type IN ('click', 'view')""",
        "replay_quarantine": f"SELECT k, v, {TOP} AS sync FROM ({UPSERT})",
        "net_changes": NET,
        "capture_changes": CAPTURE,
        "capture_moves": MOVES,
        "capture_then_apply": f"WITH {LATER} SELECT {LATER_ROWS} FROM later",
        "reconcile_status": f"""SELECT status, COUNT(*) AS n_keys, CAST(SUM(source_rows) AS BIGINT) AS source_rows,
            CAST(SUM(target_rows) AS BIGINT) AS target_rows FROM ({RECONCILE_KEYS}) GROUP BY status""",
        "reconcile_keys": RECONCILE_KEYS,
        "reconcile_ranges": RECONCILE_RANGES,
        "reconcile_repeated_keys": RECONCILE_GROUPS,
        "reconcile_whole_rows": RECONCILE_ROWS,
        "pair_status": """SELECT 0 AS pair, 'source' AS side, 'orders' AS table_name, TRUE AS present,
                   COUNT(*) AS n_rows FROM orders
            UNION ALL SELECT 0, 'target', 'lineitem', TRUE, COUNT(*) FROM lineitem
            UNION ALL SELECT 1, 'source', 'customer', TRUE, COUNT(*) FROM customer
            UNION ALL SELECT 1, 'target', 'no_such_table', FALSE, NULL""",
        "full_load": """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, '0000000000000000002A' AS sync
            FROM lineitem""",
        "initial_sync": f"SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, {TOP} AS sync FROM customer",
        "incremental_sync": f"SELECT k, v, {TOP} AS sync FROM ({STRICT})",
        "chunked_initial_sync": f"""SELECT 'upsert' AS mode, k, v, {TOP} AS sync FROM ({UPSERT})
            UNION ALL SELECT 'strict', k, v, {TOP} FROM ({STRICT}) UNION ALL SELECT 'bag', k, v, {TOP} FROM ({BAG})""",
        "multi_table_cycle": f"""SELECT 'a_upsert' AS table_name, k, v, {TOP} AS sync FROM ({UPSERT})
            UNION ALL SELECT 'b_bag', k, v, {TOP} FROM ({BAG})
            UNION ALL SELECT 'c_broken', c_custkey, c_acctbal, '{ZERO}' FROM customer""",
        "consistent_cycle": CUTS,
        "deferred_replay": f"SELECT k, v, {TOP} AS sync FROM ({UPSERT})",
        "folded_replay": f"SELECT k, v, {TOP} AS sync FROM ({UPSERT})",
        "mapping_driven_sync": f"SELECT k AS id, v AS balance, {TOP} AS sync FROM ({LATE_UPSERT})",
        "table_list_sync": f"SELECT k, v, {TOP} AS sync FROM ({LATE_STRICT})",
        "cycle_metrics": f"""SELECT 'accounts' AS table_name, 'incremental' AS phase, {COUNTS},
              CAST(0 AS BIGINT) AS ignored, CAST(0 AS BIGINT) AS rejected, {_hex('MAX(event_id) + 1')} AS watermark
            FROM events
            UNION ALL SELECT 'accounts', 'incremental', 0, 0, 0, 0, 0, {TOP}""",
        "stream_by_position": f"SELECT k, v, {TOP} AS sync FROM ({UPSERT})",
        "stream_apply": f"SELECT k, v, {TOP} AS sync FROM ({UPSERT})",
    }
