"""The registered queries as plain SQL over the given tables."""

from __future__ import annotations

from relaylog.plans import event_table as E

GROUP = "acme.test.projection.g1"

# Event records with their log positions.
EV = f"""
ev AS (
  SELECT event_id AS id, 'evt_' || event_id AS event_id, CAST(user_id AS VARCHAR) AS aggregate_id,
         user_id AS correlation_id, event_type AS event_name, ts, value AS score, props AS payload,
         '{E.EVENTS_TOPIC}' AS topic, CAST(user_id % 10 AS INTEGER) AS partition,
         row_number() OVER (PARTITION BY user_id % 10 ORDER BY event_id) - 1 AS "offset"
  FROM events
)"""

OD = f"""
od AS (
  SELECT *, '{E.ORDERS_TOPIC}' AS topic, CAST(o_custkey % 10 AS INTEGER) AS partition,
         row_number() OVER (PARTITION BY o_custkey % 10 ORDER BY o_orderkey) - 1 AS "offset"
  FROM orders
)"""

REASON = """CASE id % 997
    WHEN 13 THEN 'payload: unsupported operation'
    WHEN 777 THEN 'payload: unsupported operation'
    WHEN 131 THEN 'payload: source table does not match configured table'
    WHEN 257 THEN 'payload: Kafka key does not match the partition column'
    WHEN 389 THEN 'payload: field "score" is not a valid float8'
    WHEN 521 THEN 'payload: event id column "event_id" is empty'
    WHEN 643 THEN 'payload: envelope is not a JSON object' END"""

DE = f"""{EV}, de AS (SELECT *, {REASON} AS reason FROM ev)"""

# Deliveries to two destinations, the class of responses each record gets, and the attempts.
DL = f"""{EV}, dl AS (
  SELECT 'all_events' AS destination_id, NULL AS filtered, * FROM ev
  UNION ALL
  SELECT 'sales', CASE WHEN event_name NOT IN ('purchase', 'signup') THEN 'filtered' END, * FROM ev
)"""

CLS = """CASE WHEN id % 101 = 50 THEN 'stuck' WHEN id % 103 = 51 THEN 'full' WHEN id % 103 = 52 THEN 'over'
    WHEN id % 7 = 3 THEN 'once' WHEN id % 11 = 5 THEN 'keep' WHEN id % 13 = 6 THEN 'thrice' ELSE 'ok' END"""

AT = f"""{DL}, resp(cls, attempt, status, outcome, retry_reason) AS (VALUES
  ('stuck', 0, 503, NULL, 'destination returned HTTP 503'), ('stuck', 1, 503, NULL, 'destination returned HTTP 503'),
  ('stuck', 2, 503, NULL, 'destination returned HTTP 503'), ('full', 0, 200, 'delivered', NULL),
  ('over', 0, 200, NULL, 'destination response exceeds 64 KiB'), ('over', 1, 200, 'delivered', NULL),
  ('once', 0, 503, NULL, 'destination returned HTTP 503'), ('once', 1, 200, 'delivered', NULL),
  ('keep', 0, 200, 'skipped', NULL), ('thrice', 0, 200, NULL, 'invalid acknowledgement'),
  ('thrice', 1, 302, NULL, 'destination returned HTTP 302'), ('thrice', 2, 200, 'delivered', NULL),
  ('ok', 0, 200, 'delivered', NULL)
), att AS (
  SELECT dl.*, resp.attempt, resp.status, resp.outcome, resp.retry_reason
  FROM dl JOIN resp ON resp.cls = {CLS} WHERE filtered IS NULL
)"""

OUT = f"""{AT}, res AS (
  SELECT destination_id, partition, "offset", min(outcome) AS resolved, count(*) AS attempts_used
  FROM att GROUP BY ALL
), oc AS (
  SELECT dl.*, coalesce(filtered, resolved) AS outcome, attempts_used
  FROM dl LEFT JOIN res USING (destination_id, partition, "offset")
), fr AS (
  SELECT destination_id, topic, partition,
         coalesce(min("offset") FILTER (outcome IS NULL), max("offset") + 1) AS committed
  FROM oc GROUP BY ALL
)"""

BLOCKS = """
blocks AS (
  SELECT 'orders' AS source_id, max_by('order ' || o_orderkey, o_orderkey) AS reason
  FROM orders WHERE o_orderpriority LIKE '1%' HAVING count(*) > 0
)"""

SQLTS = """regexp_replace(regexp_replace(strftime({0}, '%Y-%m-%d %H:%M:%S.%f'), '0+$', ''), '\\.$', '')"""


def ts_text(expr: str) -> str:
    return SQLTS.format(expr)


def _facts(source: str, table: str, serial: str, columns: list[tuple[str, str | None]]) -> str:
    rows = []
    for pos, (name, type_name) in enumerate(columns):
        known = type_name is not None
        unique = f"count(DISTINCT {serial}) = count({serial})" if name == serial else "CAST(NULL AS BOOLEAN)"
        rows.append(
            f"SELECT {pos} AS pos, '{name}' AS name, {repr(type_name) if known else 'CAST(NULL AS VARCHAR)'} AS type, "
            f"{str(known).lower()} AS exists, {f'count(*) - count({name})' if known else 'CAST(NULL AS BIGINT)'} AS nulls, "
            f"count(*) AS rows, {unique} AS serial_unique, '{source}' AS source_id FROM {table}"
        )
    return " UNION ALL ".join(rows)


def _violation(source: str, order: int, rule: str, column: str, detail: str, when: str) -> str:
    return (
        f"SELECT {order} AS rule_order, '{rule}' AS rule, '{column}' AS \"column\", '{detail}' AS detail, "
        f"'{source}' AS source_id FROM ({when})"
    )


APP_EVENTS = """(SELECT event_id AS id, 'evt_' || event_id AS event_id, CAST(user_id AS VARCHAR) AS aggregate_id,
  user_id AS correlation_id, event_type AS event_name, ts AS recorded_on, value AS score, props AS payload FROM events)"""
NULL_USERS = "(SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN user_id END AS user_id FROM events)"

TABLE_FACTS = " UNION ALL ".join(
    [
        _facts(
            "app_events", APP_EVENTS, "id",
            [("id", "int8"), ("event_id", "text"), ("aggregate_id", "text"), ("correlation_id", "int8"),
             ("event_name", "text"), ("recorded_on", "timestamptz"), ("score", "float8"), ("payload", "text")],
        ),
        _facts("lineitem", "lineitem", "l_orderkey", [("l_orderkey", "int8"), ("l_partkey", "int8"), ("l_quantity", "float8")]),
        _facts("nation", "nation", "n_name", [("n_name", "text"), ("n_regionkey", "int4")]),
        _facts("embeddings", "embeddings", "vec_id", [("vec_id", "int8"), ("embedding", "array<float>"), ("label", "int4")]),
        _facts("part", "part", "p_partkey", [("p_partkey", "int8"), ("p_missing", None), ("p_brand", "text")]),
        _facts("null_users", NULL_USERS, "event_id", [("event_id", "int8"), ("user_id", "int8")]),
    ]
)

_ANY = "SELECT 1 FROM {0} HAVING count(*) >= 0"
CONTRACT = " UNION ALL ".join(
    [
        _violation(
            "lineitem", 6, "serial not unique", "l_orderkey",
            'serialColumn "l_orderkey" has no unique or primary-key index on it alone',
            "SELECT 1 FROM lineitem HAVING count(DISTINCT l_orderkey) < count(l_orderkey)",
        ),
        _violation(
            "nation", 4, "serial type", "n_name", 'serialColumn "n_name" must be int2, int4, or int8, got "text"',
            _ANY.format("nation"),
        ),
        _violation(
            "embeddings", 1, "unsupported type", "embedding", 'column "embedding" has unsupported type "array<float>"',
            _ANY.format("embeddings"),
        ),
        _violation(
            "part", 2, "missing columns", "p_missing", "missing configured columns: p_missing", _ANY.format("part")
        ),
        _violation(
            "null_users", 8, "partitioning null", "user_id", 'partitioningColumn "user_id" must be NOT NULL',
            f"SELECT 1 FROM {NULL_USERS} HAVING count(user_id) < count(*)",
        ),
    ]
)

CUSTOMER_SOURCES = """
src AS (
  SELECT c_mktsegment AS namespace, 'R&D <a>' AS environment, c_name AS source_id,
         CAST(c_nationkey + 1 AS BIGINT) AS generation, 'orders' AS "table", c_acctbal FROM customer
), named AS (
  SELECT *, 'relay_g' || generation || '_' || substr(sha256(
    '["' || namespace || '","R\\u0026D \\u003ca\\u003e","' || source_id || '","' || generation || '"]'), 1, 28) AS topic_prefix
  FROM src
)"""

SPAN_ACTIVITY = f"""{OUT}, worked AS (
  SELECT oc.*, oc."offset" < fr.committed AS done FROM oc JOIN fr USING (destination_id, topic, partition)
  WHERE oc."offset" <= fr.committed
), entries AS (
  SELECT destination_id, partition, "offset", event_id, 'info' AS level, 'delivery started' AS message,
         CAST(NULL AS INTEGER) AS attempt, CAST(NULL AS VARCHAR) AS outcome, CAST(NULL AS VARCHAR) AS error FROM worked
  UNION ALL
  SELECT w.destination_id, w.partition, w."offset", w.event_id, CASE WHEN a.outcome IS NULL THEN 'warn' ELSE 'info' END,
         CASE WHEN a.outcome IS NULL THEN 'retry' ELSE 'acknowledged' END, a.attempt + 1, NULL,
         CASE WHEN a.outcome IS NULL THEN 'delivery failed or retry requested' END
  FROM worked w JOIN att a USING (destination_id, partition, "offset")
  UNION ALL
  SELECT destination_id, partition, "offset", event_id, 'info', 'terminal outcome', NULL, outcome, NULL
  FROM worked WHERE outcome IS NOT NULL
  UNION ALL
  SELECT destination_id, partition, "offset", event_id, 'info', 'committed', NULL, NULL, NULL FROM worked WHERE done
)"""

FACTS = f"""{EV}, pb AS (
  SELECT event_name AS destination_id, topic, partition, min("offset") AS low, max("offset") + 1 AS end_offset
  FROM ev GROUP BY ALL
), bounds AS (
  SELECT *, CASE WHEN partition % 5 = 1 THEN low ELSE 0 END AS first_offset FROM pb
), committed AS (
  SELECT destination_id, partition, CASE WHEN partition = 7 THEN end_offset + 1 ELSE end_offset // 2 END AS committed
  FROM bounds WHERE partition % 3 <> 0
), started AS (
  SELECT destination_id, partition FROM bounds WHERE partition % 3 <> 0 OR partition = 9
)"""

HIST = """SELECT destination_id, partition, CASE WHEN reason IS NULL THEN 'running' ELSE 'blocked' END AS state, reason,
  CASE WHEN reason IS NULL THEN coalesce(committed, first_offset) END AS baseline
FROM (
  SELECT b.*, c.committed, CASE
    WHEN c.committed IS NULL AND (s.destination_id IS NOT NULL OR first_offset <> 0)
      THEN 'established consumer offsets or history lost'
    WHEN c.committed NOT BETWEEN first_offset AND end_offset THEN 'committed offset is outside retained history' END AS reason
  FROM bounds b LEFT JOIN committed c USING (destination_id, partition) LEFT JOIN started s USING (destination_id, partition)
)"""

COMMANDS = """
cmd AS (
  SELECT user_id, event_id AS seq, CASE event_type WHEN 'error' THEN 'paused' ELSE 'running' END AS state
  FROM events WHERE event_type <> 'click'
), stored AS (
  SELECT DISTINCT user_id, CASE WHEN user_id % 2 = 0 THEN 'running' ELSE 'paused' END AS desired FROM events
), steps AS (
  SELECT c.*, coalesce(lag(state) OVER (PARTITION BY user_id ORDER BY seq), desired) AS before
  FROM cmd c JOIN stored USING (user_id)
)"""

OBS = """
obs AS (
  SELECT user_id, event_type AS destination_id, CAST(floor(value / 10) AS BIGINT) AS revision, event_id AS arrival,
         CASE WHEN event_id % 2 = 0 THEN 'running' ELSE 'paused' END AS state FROM events
), latest AS (
  SELECT user_id, destination_id, max(revision) AS revision,
         arg_max(state, {'r': revision, 'a': arrival}) AS state FROM obs GROUP BY ALL
)"""

SEQ = """
log AS (
  SELECT event_id + 1 AS sequence, 'evt_' || event_id AS event_id, CAST(user_id AS VARCHAR) AS aggregate_id,
         event_type AS event_name FROM events
)"""

ROUTED = f"""{EV}, {OD}, both_sources AS (
  SELECT 'app_events' AS source_id, partition, "offset", event_name FROM ev
  UNION ALL SELECT 'orders', partition, "offset", NULL FROM od
), subs(destination_id, source_id, wanted) AS (VALUES
  ('all_events', 'app_events', NULL), ('sales', 'app_events', ['purchase', 'signup']),
  ('numeric_filter', 'app_events', NULL), ('paused_one', 'app_events', NULL), ('paused_one', 'orders', NULL),
  ('needs_both', 'app_events', NULL), ('needs_both', 'orders', NULL)
), routed AS (
  SELECT *, CASE WHEN wanted IS NOT NULL AND NOT list_contains(wanted, event_name) THEN 'filtered' ELSE 'due' END AS outcome
  FROM both_sources JOIN subs USING (source_id)
)"""

_SQL = {
    "snapshot_scan_events": f"""SELECT id, event_id, aggregate_id, correlation_id, event_name,
        epoch_us(recorded_on) AS recorded_on, score, payload, 'r' AS op FROM {APP_EVENTS} ORDER BY id""",
    "snapshot_scan_orders": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 'r' AS op
        FROM orders ORDER BY o_orderkey""",
    "assign_positions": f"""WITH {EV} SELECT id, partition, "offset" FROM ev""",
    "log_bounds": f"""WITH {EV}, {OD} SELECT topic, partition, min("offset") AS first_offset, max("offset") + 1 AS end_offset
        FROM (SELECT topic, partition, "offset" FROM ev UNION ALL SELECT topic, partition, "offset" FROM od) GROUP BY ALL""",
    "encode_changes": f"""WITH {EV} SELECT topic, partition, "offset", '{{"correlation_id":' || correlation_id || '}}' AS key,
        'c' AS op, 'public' AS source_schema, 'app_events' AS source_table, id, event_id, event_name,
        replace({ts_text("ts")}, ' ', 'T') || 'Z' AS recorded_on, score, payload FROM ev""",
    "log_round_trip": f"""WITH {EV} SELECT topic, partition, "offset", '{{"correlation_id":' || correlation_id || '}}' AS key,
        event_id FROM ev""",
    "follow_log": f"""WITH {DE} SELECT partition, "offset", event_name FROM de WHERE reason IS NULL""",
    "table_facts": TABLE_FACTS,
    "contract_violations": CONTRACT,
    "schema_drift": """WITH reg AS (
          SELECT p_partkey AS source_id, unnest([0, 1, 2]) AS pos, unnest(['id', p_brand, 'size']) AS name,
                 unnest(['int8', 'text', 'int4']) AS type FROM part
        ), cur AS (
          SELECT * FROM (SELECT p_partkey AS source_id, unnest([0, 1, 2, 3]) AS pos, unnest(['id', p_brand, 'size', 'price']) AS name,
                 unnest(['int8', CASE WHEN p_size > 25 THEN 'json' ELSE 'text' END, 'int4', 'float8']) AS type FROM part)
          WHERE pos < 3 OR source_id % 3 = 0
        )
        SELECT source_id, pos, reg.name AS registered_name, reg.type AS registered_type, cur.name AS current_name,
               cur.type AS current_type FROM reg FULL OUTER JOIN cur USING (source_id, pos)
        WHERE (reg.name, reg.type) IS DISTINCT FROM (cur.name, cur.type)""",
    "identity_drift": """WITH f AS (SELECT unnest([
          ('identity', 'table', 'orders', CASE WHEN c_custkey % 7 = 1 THEN 'orders_v2' ELSE 'orders' END),
          ('identity', 'serial_column', 'o_orderkey', 'o_orderkey'),
          ('identity', 'partitioning_column', 'o_custkey', CASE WHEN c_custkey % 11 = 2 THEN 'o_clerk' ELSE 'o_custkey' END),
          ('identity', 'event_id_column', '', CASE WHEN c_custkey % 13 = 3 THEN 'event_id' ELSE '' END),
          ('identity', 'partitions', '10', CASE WHEN c_acctbal < 0 THEN '20' ELSE '10' END),
          ('names', 'topic_prefix', 'topic_prefix_a', CASE WHEN c_custkey % 17 = 4 THEN 'topic_prefix_x' ELSE 'topic_prefix_a' END),
          ('names', 'topic', 'topic_a', CASE WHEN c_custkey % 17 = 4 THEN 'topic_x' ELSE 'topic_a' END),
          ('names', 'connector', 'connector_a', CASE WHEN c_custkey % 17 = 4 THEN 'connector_x' ELSE 'connector_a' END),
          ('names', 'slot', 'slot_a', CASE WHEN c_custkey % 17 = 4 THEN 'slot_x' ELSE 'slot_a' END),
          ('names', 'publication', 'publication_a', CASE WHEN c_custkey % 17 = 4 THEN 'publication_x' ELSE 'publication_a' END)]) AS t,
          c_name, c_custkey FROM customer
        ), g AS (SELECT c_name AS source_id, t[1] AS kind, t[2] AS field, t[3] AS registered,
                        CASE WHEN c_custkey % 19 <> 5 THEN t[4] END AS current FROM f)
        SELECT * FROM g WHERE registered IS DISTINCT FROM current""",
    "wire_small_floats": """WITH n AS (SELECT *, CAST(round(l_discount * 100) AS INTEGER) AS c FROM lineitem)
        SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 5 NOT IN (1, 2)
               THEN CAST(c // 100 AS VARCHAR) || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') END AS wire FROM n""",
    "wire_bools": """SELECT event_id, event_type,
        CASE event_type WHEN 'click' THEN 'true' WHEN 'view' THEN 'false' END AS wire FROM events""",
    "rest_on_blocked_source": f"""WITH {EV} SELECT partition, count(*) FILTER ("offset" % 2 = 0) AS records, 'orders' AS down,
        'payload: envelope is missing "op"' AS reason, 0 AS sent_after_block FROM ev GROUP BY partition""",
    "unfinished_tail": f"""WITH {EV} SELECT partition, count(*) AS records, 0 AS unfinished,
        count(*) FILTER (event_name NOT IN ('purchase', 'signup')) AS filtered, count(*) AS committed, 0 AS tried FROM ev GROUP BY partition""",
    "lost_history": f"""WITH {EV} SELECT partition, count(*) AS records, 'app_events' AS source_id,
        'committed offset is outside retained history' AS reason, 'stopped' AS state FROM ev GROUP BY partition""",
    "stamped_activity": f"""WITH {SPAN_ACTIVITY}, s AS (SELECT *, row_number() OVER (ORDER BY "offset", destination_id, partition, CASE message
          WHEN 'delivery started' THEN 0 WHEN 'terminal outcome' THEN 1000 WHEN 'committed' THEN 1001 ELSE attempt END) AS sequence
          FROM entries)
        SELECT 'boot:' || sequence AS id, sequence, '2024-01-01' AS day, message, destination_id, partition, attempt, "offset" FROM s""",
    "stream_names": f"""WITH {CUSTOMER_SOURCES} SELECT namespace, environment, source_id, generation, "table", topic_prefix,
        topic_prefix || '.public.' || "table" AS topic, topic_prefix || '_connector' AS connector,
        topic_prefix || '_slot' AS slot, topic_prefix || '_pub' AS publication FROM named""",
    "insert_registration": f"""WITH {CUSTOMER_SOURCES} SELECT namespace, environment, generation, source_id,
        CASE WHEN c_acctbal > 5000 THEN '{{"partitions": 20}}' ELSE '{{"partitions": 10}}' END AS identity,
        topic_prefix AS names, source_id AS topic_id, CASE WHEN c_acctbal < 0 THEN 'inserted' ELSE 'conflict' END AS result
        FROM named WHERE c_acctbal < 0 OR c_acctbal > 5000""",
    "decode_accepted": f"""WITH {DE} SELECT topic, partition, "offset", event_id, aggregate_id, event_name, 1 AS generation, id,
        correlation_id, epoch_us(ts) AS recorded_micros, score, payload FROM de WHERE reason IS NULL""",
    "decode_payload": f"""WITH {EV} SELECT partition, "offset", id, event_id, correlation_id, event_name,
        {ts_text("ts")} || '+00' AS recorded_on, score, payload FROM ev""",
    "decode_rejects": f"""WITH {DE} SELECT partition, "offset", reason AS reject_reason FROM de WHERE reason IS NOT NULL""",
    "decode_orders": f"""WITH {OD} SELECT partition, "offset", CAST(NULL AS VARCHAR) AS reject_reason, o_orderkey, o_custkey,
        o_orderstatus, o_totalprice, {ts_text("o_orderdate")} AS o_orderdate FROM od""",
    "accepted_prefix": f"""WITH {DE}, stops AS (
          SELECT partition, min("offset") AS stop FROM de WHERE reason IS NOT NULL GROUP BY partition)
        SELECT partition, "offset", event_id FROM de LEFT JOIN stops USING (partition) WHERE stop IS NULL OR "offset" < stop""",
    "blocked_sources": f"""WITH {DE} SELECT 'app_events' AS source_id, reason, topic, partition, "offset" FROM de
        WHERE reason IS NOT NULL ORDER BY partition, "offset" LIMIT 1""",
    "wire_ints": """WITH n AS (SELECT *, l_partkey * 37 * CAST(power(10, l_linenumber) AS BIGINT) AS v FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_partkey, CAST(TRY_CAST(v AS SMALLINT) AS VARCHAR) AS int2,
               CAST(TRY_CAST(v AS INTEGER) AS VARCHAR) AS int4, CAST(v AS VARCHAR) AS int8 FROM n""",
    "wire_floats": """WITH n AS (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS c FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_extendedprice,
               CAST(c // 100 AS VARCHAR) || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') AS wire FROM n""",
    "expand_decimal": """WITH a AS (
          SELECT *, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS w, lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS f,
                 l_partkey % 9 - 4 AS e FROM lineitem
        ), b AS (SELECT *, w || f AS d, CAST(length(w) + e AS INTEGER) AS p FROM a)
        SELECT l_orderkey, l_linenumber, l_partkey, '-' || w || '.' || f || 'e' || e AS literal,
               '-' || regexp_replace(CASE WHEN p <= 0 THEN '0.' || repeat('0', -p) || d
                 WHEN p >= length(d) THEN d || repeat('0', p - length(d))
                 ELSE substr(d, 1, p) || '.' || substr(d, p + 1) END, '^0+([0-9])', '\\1') AS expanded FROM b""",
    "wire_timestamps": f"""SELECT event_id, {ts_text("ts")} AS wire_ntz,
        {ts_text("ts - INTERVAL 330 MINUTE")} || '+00' AS wire_tz FROM events""",
    "wire_binary": """WITH a AS (SELECT *, to_base64(encode(p_name)) AS b FROM part)
        SELECT p_partkey, CASE WHEN p_size < 10 THEN NULL WHEN p_size < 25 THEN rtrim(b, '=') ELSE b END AS wire,
               CASE WHEN p_size < 10 THEN NULL ELSE p_name END AS decoded FROM a""",
    "json_text": """SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE props END AS wire FROM events""",
    "raw_members": """SELECT event_id, unnest(['k', 'e', 's', 'n']) AS name, unnest(['number', 'number', 'string', 'null']) AS kind,
        unnest([regexp_extract(props, '([0-9]+)', 1), '1.50e3', '5', 'null']) AS text FROM events""",
    "single_object": """SELECT doc_id, false AS bare, doc_id % 3 <> 0 AS wrapped,
        CASE WHEN doc_id % 3 <> 0 THEN CAST(length(text) AS BIGINT) END AS chars FROM documents""",
    "event_keys": f"""WITH {EV}, k AS (SELECT id, CASE WHEN event_name <> 'error' THEN event_id
          ELSE sha256(topic || ':' || partition || ':' || "offset") END AS stable_id FROM ev)
        SELECT id, stable_id, stable_id || ':projection:1' AS idempotency_key, '{GROUP}' AS delivery_group FROM k""",
    "backoff_bounds": """WITH a AS (SELECT o_orderkey, CAST(o_orderkey % 12 AS INTEGER) AS attempt FROM orders),
        c AS (SELECT *, CAST(power(2, least(attempt, 6)) AS DOUBLE) AS ceiling FROM a)
        SELECT o_orderkey, attempt, least(greatest(ceiling / 2, 1.0), 60.0) AS shortest,
               least(greatest(ceiling, 1.0), 60.0) AS longest FROM c""",
    "cursor_parse": """SELECT conv_id, turn, CASE turn % 7 WHEN 1 THEN ':' || turn WHEN 2 THEN role || turn
          WHEN 3 THEN role || ':' || turn || ':' || turn WHEN 4 THEN role || ':-' || turn ELSE role || ':' || turn END AS cursor,
        CASE WHEN turn % 7 NOT IN (1, 2, 3, 4) THEN role END AS boot,
        CASE WHEN turn % 7 NOT IN (1, 2, 3, 4) THEN turn END AS sequence FROM conversations""",
    "matches_filter": """SELECT event_id, event_type IN ('purchase', 'signup') OR event_id % 10 = 0 AS by_type,
        true AS by_number, true AS by_missing FROM events""",
    "route_fanout": f"""WITH {ROUTED} SELECT destination_id, source_id, partition, count(*) AS records,
        CAST(sum("offset") AS BIGINT) AS offsets FROM routed GROUP BY ALL""",
    "route_filtered": f"""WITH {ROUTED} SELECT destination_id, partition, outcome, count(*) AS records FROM routed GROUP BY ALL""",
    "route_running": f"""WITH {DL} SELECT destination_id, partition, "offset" FROM dl""",
    "ready_destinations": f"""WITH {BLOCKS}, subs(destination_id, pos, source_id) AS (VALUES
          ('all_events', 0, 'app_events'), ('sales', 0, 'app_events'), ('numeric_filter', 0, 'app_events'),
          ('paused_one', 0, 'app_events'), ('paused_one', 1, 'orders'), ('needs_both', 0, 'app_events'), ('needs_both', 1, 'orders'))
        SELECT destination_id, bool_and(reason IS NULL) AS ready,
          'source unavailable: ' || arg_min(source_id, pos) FILTER (reason IS NOT NULL) AS reason
        FROM subs LEFT JOIN blocks USING (source_id) GROUP BY destination_id""",
    "drop_blocked": f"""WITH {EV}, {OD}, {BLOCKS} SELECT * FROM (
          SELECT 'app_events' AS source_id, topic, partition, "offset" FROM ev
          UNION ALL SELECT 'orders', topic, partition, "offset" FROM od)
        WHERE source_id NOT IN (SELECT source_id FROM blocks)""",
    "drop_known_skips": f"""WITH {OUT}, hz AS (SELECT partition, (max("offset") + 1) // 2 AS horizon FROM ev GROUP BY partition)
        SELECT destination_id, partition, "offset" FROM oc JOIN hz USING (partition)
        WHERE NOT ("offset" < horizon AND outcome IS NOT DISTINCT FROM 'skipped')""",
    "envelopes": f"""WITH {EV} SELECT partition, "offset", 'app_events' AS data_source_id,
        'Application events' AS data_source_description, 'sales' AS data_destination_id,
        'Sales view' AS data_destination_description, id, event_id, {ts_text("ts")} || '+00' AS recorded_on, score, payload
        FROM ev WHERE event_name IN ('purchase', 'signup')""",
    "headers": f"""WITH {DL} SELECT event_id, '1' AS generation, 'false' AS replay, topic, CAST(partition AS VARCHAR) AS partition,
        CAST("offset" AS VARCHAR) AS "offset", event_id || ':' || destination_id || ':1' AS idempotency_key,
        'application/json' AS content_type FROM dl""",
    "classify_responses": f"""WITH {AT} SELECT destination_id, id, attempt, status, outcome, retry_reason FROM att""",
    "resolve_attempts": f"""WITH {OUT} SELECT destination_id, partition, "offset", resolved AS outcome, attempts_used FROM res""",
    "retry_schedule": f"""WITH {AT}, w AS (
          SELECT destination_id, id, attempt, least(greatest(power(2, least(attempt, 6)) / 2, 1.0), 60.0) AS wait_seconds FROM att)
        SELECT *, sum(wait_seconds) OVER (PARTITION BY destination_id, id ORDER BY attempt) AS due_seconds FROM w""",
    "commit_frontier": f"""WITH {OUT} SELECT * FROM fr""",
    "pending": f"""WITH {OUT} SELECT destination_id, partition, "offset", event_id
        FROM oc JOIN fr USING (destination_id, partition) WHERE "offset" >= committed""",
    "save_skips": f"""WITH {OUT} SELECT destination_id, 'app_events' AS source_id, event_id, partition, "offset"
        FROM oc WHERE outcome = 'skipped'""",
    "check_history": f"""WITH {FACTS} {HIST}""",
    "mark_started": f"""WITH {FACTS} SELECT destination_id, partition FROM started
        UNION SELECT destination_id, partition FROM bounds WHERE first_offset = 0""",
    "dedupe_deliveries": f"""WITH {AT} SELECT DISTINCT event_id || ':' || destination_id || ':1' AS idempotency_key,
        destination_id, id FROM att""",
    "deliver_in_order": f"""WITH {OUT} SELECT destination_id, partition, "offset", outcome, coalesce(attempts_used, 0) AS attempts
        FROM oc JOIN fr USING (destination_id, partition) WHERE "offset" <= committed""",
    "stream_delivery": f"""WITH {OUT} SELECT partition, outcome, count(*) AS records, committed
        FROM oc JOIN fr USING (destination_id, partition) WHERE destination_id = 'sales' AND "offset" < committed
        GROUP BY ALL""",
    "dedupe_stream": f"""WITH {AT} SELECT DISTINCT event_id || ':' || destination_id || ':1' AS idempotency_key,
        destination_id, id FROM att""",
    "live_append": f"""WITH {EV} SELECT topic, partition, row_number() OVER (PARTITION BY partition ORDER BY
            CASE WHEN id % 10 < 5 THEN 1 WHEN id % 10 >= 7 THEN 2 ELSE 3 END, id) - 1 AS "offset",
        CASE WHEN id % 10 < 5 THEN 'r' ELSE 'c' END AS op, id, event_id, event_name, 0 AS again FROM ev""",
    "manifest_bounds": f"""WITH {EV}, {OD} SELECT topic, partition, min("offset") AS first_offset, max("offset") + 1 AS end_offset, count(*) AS records
        FROM (SELECT topic, partition, "offset" FROM ev UNION ALL SELECT topic, partition, "offset" FROM od) GROUP BY ALL""",
    "range_read": f"""WITH {EV}, {OD}, both_logs AS (
          SELECT topic, partition, "offset", '{{"correlation_id":' || correlation_id || '}}' AS key FROM ev
          UNION ALL SELECT topic, partition, "offset", '{{"o_custkey":' || o_custkey || '}}' FROM od
        ), ends AS (SELECT topic, partition, max("offset") + 1 AS n FROM both_logs GROUP BY ALL)
        SELECT topic, partition, "offset", key FROM both_logs JOIN ends USING (topic, partition) WHERE "offset" >= n // 4 AND "offset" < n * 3 // 4""",
    "byte_bounded_round": f"""WITH {EV}, sized AS (SELECT partition, "offset", octet_length(encode(payload)) AS own FROM ev),
        summed AS (SELECT *, sum(own) OVER (PARTITION BY partition ORDER BY "offset") AS total FROM sized)
        SELECT partition, count(*) AS records, sum(own) AS bytes, max("offset") + 1 AS next_offset
        FROM summed WHERE total <= 2000 OR total = own GROUP BY partition""",
    "replay_requests": f"""WITH {DL}, ends AS (SELECT partition, max("offset") + 1 AS n FROM ev GROUP BY partition)
        SELECT destination_id, event_id, 'true' AS replay, CAST(partition AS VARCHAR) AS partition, CAST("offset" AS VARCHAR) AS "offset"
        FROM dl JOIN ends USING (partition) WHERE filtered IS NULL AND "offset" BETWEEN n // 4 AND n // 2 - 1""",
    "replay_stream": f"""WITH {EV}, ends AS (SELECT partition, max("offset") + 1 AS n FROM ev GROUP BY partition)
        SELECT partition, CASE WHEN event_name IN ('purchase', 'signup') THEN 'delivered' ELSE 'filtered' END AS outcome,
          count(*) AS records, n // 2 AS committed, n AS normal_committed, 'completed' AS state
        FROM ev JOIN ends USING (partition) WHERE "offset" BETWEEN n // 4 AND n // 2 - 1 GROUP BY ALL""",
    "insert_if_absent": """SELECT c_name AS destination_id, 'paused' AS desired, c_custkey AS revision FROM customer WHERE c_acctbal < 0
        UNION ALL
        SELECT DISTINCT c_name, 'running', 1 FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_acctbal >= 0""",
    "fold_desired": f"""WITH {COMMANDS}, agg AS (
          SELECT user_id, arg_max(state, seq) AS last_state, count(*) FILTER (state <> before) AS changes
          FROM steps GROUP BY user_id)
        SELECT user_id, coalesce(last_state, desired) AS desired, 1 + coalesce(changes, 0) AS revision
        FROM stored LEFT JOIN agg USING (user_id)""",
    "latest_by_revision": f"""WITH {OBS} SELECT * FROM latest""",
    "observed_everywhere": f"""WITH {OBS} SELECT destination_id, user_id % 25 AS worker_group,
        bool_and(revision >= 1 AND state = 'running') AS observed FROM latest GROUP BY ALL""",
    "terminal_everywhere": f"""WITH {OUT} SELECT partition, "offset", bool_and(outcome IS NOT NULL) AS terminal FROM oc GROUP BY ALL""",
    "latch_blocks": """SELECT user_id AS source_id, arg_max(props, event_id) AS reason FROM events
        WHERE event_type = 'error' GROUP BY user_id""",
    "state_change_entries": """WITH o AS (
          SELECT user_id AS source_id, event_id AS seq,
                 CASE WHEN event_type IN ('error', 'view') THEN 'blocked' ELSE 'running' END AS state,
                 CASE WHEN event_type = 'error' THEN 'failed' END AS reason FROM events
        ), s AS (SELECT *, lag(state) OVER w AS ps, lag(reason) OVER w AS pr FROM o WINDOW w AS (PARTITION BY source_id ORDER BY seq))
        SELECT 'boot:' || row_number() OVER (ORDER BY seq) AS id, CAST(source_id AS VARCHAR) AS source_id, 'source ' || state AS message,
               reason AS error, 'info' AS level FROM s WHERE ps IS NULL OR ps <> state OR pr IS DISTINCT FROM reason""",
    "state_changes": """WITH o AS (
          SELECT user_id AS source_id, event_id AS seq,
                 CASE WHEN event_type IN ('error', 'view') THEN 'blocked' ELSE 'running' END AS state,
                 CASE WHEN event_type = 'error' THEN 'failed' END AS reason FROM events
        ), s AS (SELECT *, lag(state) OVER w AS ps, lag(reason) OVER w AS pr FROM o WINDOW w AS (PARTITION BY source_id ORDER BY seq))
        SELECT source_id, seq, state, reason FROM s WHERE ps IS NULL OR ps <> state OR pr IS DISTINCT FROM reason""",
    "health_rollup": """SELECT owner, CASE WHEN bool_and(ok) THEN 'ready' ELSE 'degraded' END AS status FROM (
          SELECT c_custkey AS owner, c_acctbal > -500 AS ok FROM customer
          UNION ALL SELECT o_custkey, o_orderstatus IN ('O', 'F') FROM orders) GROUP BY owner""",
    "merge_table": """SELECT o_custkey AS owner, count(*) AS n, 'orders' AS origin FROM orders
          WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY o_custkey
        UNION ALL SELECT c_custkey, 0, 'customer' FROM customer WHERE c_acctbal < 0""",
    "activity_entries": f"""WITH {SPAN_ACTIVITY} SELECT * FROM entries""",
    "activity_round_trip": f"""WITH {SPAN_ACTIVITY} SELECT message, destination_id, count(*) AS entries, count(attempt) AS with_attempt
        FROM entries GROUP BY ALL""",
    "retain_last": f"""WITH {SEQ} SELECT * FROM log ORDER BY sequence DESC LIMIT 1000""",
    "read_after": f"""WITH {SEQ}, head AS (SELECT max(sequence) AS last FROM log), pages(cursor, after, reset) AS (
          SELECT 'boot:' || (last - 300), last - 300, false FROM head
          UNION ALL SELECT 'boot:' || greatest(last - 1001, 0), greatest(last - 1000, 0), last > 1000 FROM head
          UNION ALL SELECT 'other:' || last, greatest(last - 1000, 0), true FROM head)
        SELECT sequence, event_id, cursor, 'boot:' || last AS next_cursor, reset
        FROM log JOIN pages ON sequence > after CROSS JOIN head""",
    "find_activity": f"""WITH {SEQ} SELECT * FROM log WHERE event_name = 'purchase'
        UNION ALL SELECT * FROM log WHERE event_id = 'evt_7' AND event_name = 'click'""",
    "retained_activity": f"""WITH {SEQ}, head AS (SELECT max(sequence) AS last FROM log), pages(cursor, after, reset) AS (
          SELECT 'kept', greatest(last - 1000, 0), false FROM head
          UNION ALL SELECT 'boot:' || (last - 300), last - 300, false FROM head
          UNION ALL SELECT 'boot:' || greatest(last - 1001, 0), greatest(last - 1000, 0), last > 1000 FROM head
          UNION ALL SELECT 'other:' || last, greatest(last - 1000, 0), true FROM head)
        SELECT sequence, event_id, cursor, reset FROM log JOIN pages ON sequence > after""",
    "activity_lookup": f"""WITH {SEQ}, found AS (SELECT * FROM log WHERE event_name = 'purchase'
          UNION ALL SELECT * FROM log WHERE event_id = 'evt_7'
          UNION ALL SELECT * FROM log WHERE aggregate_id = '11' AND event_name = 'click')
        SELECT 'boot:' || sequence AS id, sequence, event_id, aggregate_id, event_name FROM found""",
}


def all_sql() -> dict[str, str]:
    return dict(_SQL)
