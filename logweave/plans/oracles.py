"""The registered queries in SQL, over the same tables."""

from __future__ import annotations

from logweave.plans.fixtures import AS_OF_US

_TIMEOUT_US = 3_600 * 1_000_000

# Public client error-code names, written out so that the lists of the library are checked.
_RETRIABLE = """
  'BrokerNotAvailable', 'ReplicaNotAvailable', 'NetworkException', 'RequestTimedOut', 'LeaderNotAvailable',
  'NotLeaderForPartition', 'UnknownLeaderEpoch', 'UnknownTopicOrPart', 'OffsetNotAvailable',
  'PreferredLeaderNotAvailable', 'EligibleLeadersNotAvailable', 'ReassignmentInProgress', 'StaleBrokerEpoch',
  'StaleCtrlEpoch', 'RebootstrapRequired', 'KafkaStorageError', 'NotEnoughReplicas', 'NotEnoughReplicasAfterAppend',
  'ThrottlingQuotaExceeded', 'Local_MsgTimedOut', 'Local_Transport', 'Local_AllBrokersDown', 'Local_TimedOut',
  'Local_IsrInsuff', 'Local_Retry', 'Local_WaitCache', 'Local_Resolve', 'Local_TimedOutQueue', 'Local_QueueFull',
  'Unknown'"""
_NON_RETRIABLE = """
  'MsgSizeTooLarge', 'RecordListTooLarge', 'TopicAuthorizationFailed', 'ClusterAuthorizationFailed',
  'GroupAuthorizationFailed', 'TransactionalIdAuthorizationFailed', 'InvalidRequiredAcks', 'InvalidConfig',
  'InvalidRequest', 'UnsupportedVersion', 'UnsupportedCompressionType', 'InvalidRecord', 'InvalidMsg',
  'PolicyViolation', 'TopicException', 'Local_UnknownTopic', 'UnknownTopicId', 'OutOfOrderSequenceNumber',
  'DuplicateSequenceNumber', 'InvalidProducerEpoch', 'UnknownProducerId', 'ProducerFenced'"""
_COOLDOWN = """
  'LeaderNotAvailable', 'NotLeaderForPartition', 'PreferredLeaderNotAvailable', 'EligibleLeadersNotAvailable',
  'BrokerNotAvailable', 'ReplicaNotAvailable', 'KafkaStorageError', 'NotEnoughReplicas',
  'NotEnoughReplicasAfterAppend'"""

# the event log. p = partition, off = offset, k = key, v = value.
_LOG = """
log AS (
  SELECT event_id, event_type, user_id, CAST(event_id % 3 AS INT) AS p,
         row_number() OVER (PARTITION BY event_id % 3 ORDER BY event_id) - 1 AS off,
         CAST(event_id AS VARCHAR) AS k, ts, epoch_us(ts) AS ts_us, props,
         '{"Id":"' || CAST(event_id AS VARCHAR) || '","EntityType":"' || event_type ||
         '","Payload":"user ' || CAST(user_id AS VARCHAR) || '"}' AS v
  FROM events)
"""

_FAULTY = _LOG + """,
faulty AS (
  SELECT p, off, event_id, event_type, user_id,
         CASE off % 20 WHEN 3 THEN NULL WHEN 7 THEN '{' || v WHEN 11 THEN 'null'
              WHEN 13 THEN '[' || v || ']' WHEN 17 THEN rtrim(v, '}') || ',"extra":{"a":[1]}}' ELSE v END AS v
  FROM log),
decoded AS (
  SELECT p, off, v,
         CASE WHEN v IS NULL OR v = 'null' THEN 'null_value'
              WHEN NOT json_valid(v) THEN 'malformed_json'
              WHEN json_type(v) <> 'OBJECT' THEN 'malformed_json' END AS error
  FROM faulty)
"""

_MARKS = _LOG + """,
marks AS (
  SELECT p, off AS seq, off, ts_us + (event_id * 7919 % 86400) * 1000000 AS processed_us
  FROM log WHERE event_id % 97 <> 53)
"""

_CONTIGUOUS = _MARKS + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY seq) - 1 AS rn FROM marks),
ends AS (SELECT p, max(CASE WHEN seq = rn THEN seq ELSE -1 END) AS committed_seq FROM ranked GROUP BY p)
"""

# Gap rule written out island by island: an island counts as committed when it is the unbroken
# prefix, or when some mark in it or after it is old enough.
_ISLANDS = _MARKS + f""",
seen AS (SELECT * FROM marks WHERE processed_us <= {AS_OF_US}),
ranked AS (SELECT *, seq - row_number() OVER (PARTITION BY p ORDER BY seq) AS island FROM seen),
islands AS (
  SELECT p, island, min(seq) AS first_seq, max(seq) AS last_seq, min(processed_us) AS oldest
  FROM ranked GROUP BY p, island),
suffix AS (
  SELECT *, min(oldest) OVER (PARTITION BY p ORDER BY first_seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS oldest_after,
         lag(last_seq, 1, -1) OVER (PARTITION BY p ORDER BY first_seq) AS last_before
  FROM islands),
done AS (
  SELECT *, first_seq = 0 OR {AS_OF_US} - oldest_after >= {_TIMEOUT_US} AS ok FROM suffix),
ends AS (SELECT p, max(CASE WHEN ok THEN last_seq ELSE -1 END) AS committed_seq FROM done GROUP BY p)
"""

_REDELIVERED = """
first AS (SELECT CAST(event_id AS VARCHAR) AS k, event_type, value, event_id AS arrival FROM events),
again AS (SELECT CAST(event_id AS VARCHAR) AS k, event_type, value + 1 AS value, event_id + 1000000000 AS arrival
          FROM events WHERE event_id % 5 = 0),
deliveries AS (SELECT * FROM first UNION ALL SELECT * FROM again),
numbered AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY arrival) AS rn FROM deliveries)
"""

_OUTCOMES = """
outcomes AS (
  SELECT event_id, CAST(event_id % 3 AS INT) AS p, epoch_us(ts) AS ts_us,
         CAST(CASE WHEN event_id % 11 = 0 THEN event_id % 8 ELSE 0 END AS INT) AS failures FROM events),
retried AS (
  SELECT event_id, p, ts_us, CAST(least(failures, 5) + 1 AS INT) AS attempts,
         CAST(CASE WHEN failures = 0 THEN 0 WHEN failures <= 5 THEN pow(2, failures - 1) - 1 ELSE 31 END AS INT) AS delay_s,
         CASE WHEN failures <= 5 THEN 'ok' ELSE 'dlq' END AS outcome
  FROM outcomes)
"""

_PAUSES = _OUTCOMES + """,
pauses AS (SELECT p, ts_us AS s, ts_us + delay_s::BIGINT * 1000000 AS e FROM retried WHERE delay_s > 0),
reach AS (SELECT *, max(e) OVER (PARTITION BY p ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM pauses),
opened AS (SELECT *, sum(CASE WHEN before IS NULL OR s > before THEN 1 ELSE 0 END)
           OVER (PARTITION BY p ORDER BY s ROWS UNBOUNDED PRECEDING) AS grp FROM reach),
merged AS (SELECT p, min(s) AS s, max(e) AS e FROM opened GROUP BY p, grp)
"""


def _attempts(failing: str) -> str:
    return f"""
base AS (
  SELECT CAST(user_id % 3 AS INT) AS p, event_id AS attempt_no, epoch_us(ts) // 1000 AS at_ms, event_id, value,
         event_type IN ({failing}) AS failed,
         CASE event_id % 5 WHEN 0 THEN 'LeaderNotAvailable' WHEN 1 THEN 'RequestTimedOut'
              WHEN 2 THEN 'MsgSizeTooLarge' WHEN 3 THEN 'NotEnoughReplicas' ELSE 'ProducerFenced' END AS code
  FROM events),
attempts AS (
  SELECT p, attempt_no, at_ms, 'produce' AS kind, NULL::DOUBLE AS latency_ms, NULL::VARCHAR AS error_code,
         NULL::BOOLEAN AS is_fatal FROM base
  UNION ALL
  SELECT p, attempt_no, at_ms, CASE WHEN failed THEN 'error' ELSE 'delivery' END,
         CASE WHEN failed THEN NULL ELSE value END, CASE WHEN failed THEN code END,
         CASE WHEN failed THEN code = 'ProducerFenced' END
  FROM base WHERE event_id % 50 <> 0)
"""


def _health(by: str) -> str:
    """Health columns per group, order-dependent parts by windows over the whole group."""
    return f"""
settled AS (
  SELECT *, CASE WHEN kind = 'error' THEN 1 ELSE -1 END AS step FROM attempts WHERE kind <> 'produce'),
walked AS (SELECT *, sum(step) OVER (PARTITION BY {by} ORDER BY attempt_no ROWS UNBOUNDED PRECEDING) AS walk FROM settled),
delivered AS (
  SELECT *, count(*) OVER (PARTITION BY {by}) - row_number() OVER (PARTITION BY {by} ORDER BY attempt_no) AS later
  FROM attempts WHERE kind = 'delivery'),
means AS (SELECT {by}, sum(0.2 * latency_ms * pow(0.8::DOUBLE, later)) AS mean FROM delivered GROUP BY {by}),
errors AS (
  SELECT {by}, sum(step) - least(0, min(walk)) AS recent_errors,
         max(CASE WHEN kind = 'error' THEN at_ms END) AS last_error_ms,
         max(CASE WHEN error_code IN ({_COOLDOWN}) THEN at_ms END) AS cool_ms
  FROM walked GROUP BY {by}),
opened AS (
  SELECT {by}, sum(CASE WHEN kind = 'produce' THEN 1 ELSE -1 END) AS inflight FROM attempts GROUP BY {by}),
health AS (
  SELECT opened.* REPLACE (CAST(inflight AS BIGINT) AS inflight), CAST(coalesce(recent_errors, 0) AS BIGINT) AS recent_errors, coalesce(mean, 0.0) AS avg_latency_ms,
         last_error_ms, coalesce(cool_ms + 5000, 0) AS unavailable_until_ms
  FROM opened LEFT JOIN errors USING ({by}) LEFT JOIN means USING ({by}))
"""


_NOW = "(SELECT max(epoch_us(ts) // 1000) + 2000 FROM events)"


def _score(now: str) -> str:
    return f"""inflight + avg_latency_ms * 0.05::DOUBLE + recent_errors * 5.0::DOUBLE +
      CASE WHEN {now} - last_error_ms < 3000 THEN 8 WHEN {now} - last_error_ms < 10000 THEN 4 ELSE 0 END"""


_CHANGES = """
changes AS (
  SELECT c_custkey AS id, c_name AS name, 'r' AS op, c_custkey AS off FROM customer
  UNION ALL SELECT c_custkey, c_name || ' v2', 'u', c_custkey + 10000000 FROM customer WHERE c_custkey % 7 = 0
  UNION ALL SELECT c_custkey, c_name, 'd', c_custkey + 20000000 FROM customer WHERE c_custkey % 11 = 0
  UNION ALL SELECT c_custkey, c_name || ' v3', 'c', c_custkey + 30000000 FROM customer WHERE c_custkey % 77 = 0),
newest AS (
  SELECT id, name, CASE WHEN op = 'd' THEN 'true' ELSE 'false' END AS deleted, off FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY off DESC) AS rn FROM changes) WHERE rn = 1)
"""

_METRICS = """
  SELECT at_ms - at_ms % 60000 AS window_start_ms, p, round(avg(latency_ms), 6) AS produce_latency_ms,
         quantile_disc(latency_ms, 0.95) AS produce_latency_p95_ms,
         count(*) FILTER (WHERE kind = 'error' AND NOT is_fatal AND error_code <> 'MsgSizeTooLarge') AS retry_count,
         count(*) FILTER (WHERE kind = 'produce') AS partition_load,
         count(*) FILTER (WHERE kind = 'error') AS delivery_errors,
         0::BIGINT AS serialization_errors, 0::BIGINT AS queue_full
  FROM attempts GROUP BY 1, 2"""


# cells of the attempts themselves, not of sums; 1048576 lies above every exponent
_ROLLUP = """,
celled AS (
  SELECT *, CASE WHEN latency_ms = 0 THEN 0
                 ELSE sign(latency_ms) * (1048576 + ceil(ln(abs(latency_ms)) / ln(1.01::DOUBLE / 0.99::DOUBLE))) END::BIGINT AS cell
  FROM attempts),
found AS (
  SELECT at_ms - at_ms % 21600000 AS window_start_ms, p, round(avg(latency_ms), 10) AS produce_latency_ms,
         quantile_disc(cell, 0.5) AS c50, quantile_disc(cell, 0.95) AS c95, quantile_disc(cell, 0.99) AS c99,
         count(*) FILTER (WHERE kind = 'error' AND NOT is_fatal AND error_code <> 'MsgSizeTooLarge') AS retry_count,
         count(*) FILTER (WHERE kind = 'produce') AS partition_load,
         count(*) FILTER (WHERE kind = 'error') AS delivery_errors,
         0::BIGINT AS serialization_errors, 0::BIGINT AS queue_full
  FROM celled GROUP BY 1, 2)
  SELECT * EXCLUDE (c50, c95, c99),
         round(CASE WHEN c50 = 0 THEN 0 ELSE sign(c50) * 0.99 * pow(1.01::DOUBLE / 0.99::DOUBLE, abs(c50) - 1048576) END, 10)
           AS produce_latency_p50_ms,
         round(CASE WHEN c95 = 0 THEN 0 ELSE sign(c95) * 0.99 * pow(1.01::DOUBLE / 0.99::DOUBLE, abs(c95) - 1048576) END, 10)
           AS produce_latency_p95_ms,
         round(CASE WHEN c99 = 0 THEN 0 ELSE sign(c99) * 0.99 * pow(1.01::DOUBLE / 0.99::DOUBLE, abs(c99) - 1048576) END, 10)
           AS produce_latency_p99_ms
  FROM found"""


def _route() -> str:
    """Ten attempts written out: choice, errors and new state of each."""
    parts = [
        _attempts("'error'"),
        _health("p"),
        f"""script AS (
  SELECT event_id, n, CASE WHEN pick = 30 THEN 'MsgSizeTooLarge' WHEN pick % 4 = 0 THEN 'LeaderNotAvailable'
         WHEN pick % 4 = 1 THEN 'RequestTimedOut' WHEN pick % 4 = 2 THEN 'NotEnoughReplicas' ELSE 'UnknownTopicOrPart' END AS code,
         failing >= n AS fails
  FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN event_id % 13 ELSE 0 END AS failing, n,
               (event_id + 3 * n) % 31 AS pick FROM events, range(1, 11) AS r(n))),
results AS (SELECT event_id, n, CASE WHEN fails THEN code END AS code FROM script),
stops AS (
  SELECT event_id, coalesce(min(CASE WHEN code IS NULL OR code = 'MsgSizeTooLarge' THEN n END), 10) AS attempts
  FROM results GROUP BY event_id),
counted AS (
  SELECT n, count(*) FILTER (WHERE code <> 'UnknownTopicOrPart') AS errors,
         bool_or(code IN ('LeaderNotAvailable', 'NotEnoughReplicas')) AS cool
  FROM results JOIN stops USING (event_id) WHERE n < attempts GROUP BY n),
s1 AS (SELECT p, inflight, recent_errors, avg_latency_ms, last_error_ms, unavailable_until_ms, {_NOW} AS now FROM health)""",
    ]
    for n in range(1, 11):
        parts.append(f"""scored{n} AS (
  SELECT p, {_score('now')} AS score FROM s{n} WHERE now > unavailable_until_ms),
c{n} AS (
  SELECT {n} AS n, CAST(coalesce(
    (SELECT p FROM scored{n} ORDER BY score, p LIMIT 1),
    CAST('0x' || substr(md5(''), 1, 15) AS BIGINT) % 3) AS INT) AS p)""")
        if n < 10:
            parts.append(f"""s{n + 1} AS (
  SELECT s.p, inflight, recent_errors + coalesce(e.errors, 0) AS recent_errors, avg_latency_ms,
         CASE WHEN coalesce(e.errors, 0) > 0 THEN now ELSE last_error_ms END AS last_error_ms,
         CASE WHEN coalesce(e.cool, false) THEN now + 5000 ELSE unavailable_until_ms END AS unavailable_until_ms, now
  FROM s{n} s LEFT JOIN (SELECT c{n}.p, errors, cool FROM c{n} JOIN counted USING (n)) e ON e.p = s.p)""")
    choices = " UNION ALL ".join(f"SELECT * FROM c{n}" for n in range(1, 11))
    return f"""WITH {','.join(parts)},
choices AS ({choices})
SELECT s.event_id, c.p, CAST(s.attempts AS INT) AS attempts,
       CASE WHEN r.code IS NULL THEN 'delivered' WHEN r.code = 'MsgSizeTooLarge' THEN 'rejected' ELSE 'exhausted' END AS outcome,
       r.code AS error_code
FROM stops s JOIN choices c ON c.n = s.attempts JOIN results r ON r.event_id = s.event_id AND r.n = s.attempts"""


_HOUR_HEALTH = (
    "WITH "
    + _attempts("'error'").replace("epoch_us(ts) // 1000 AS at_ms,", "epoch_us(ts) // 1000 AS at_ms, epoch_us(ts) // 3600000000 AS hour,")
    .replace("SELECT p, attempt_no, at_ms,", "SELECT hour, p, attempt_no, at_ms,")
    + ","
    + _health("hour, p")
)

_TOPIC_HEALTH = (
    "WITH "
    + _attempts("'error'").replace("epoch_us(ts) // 1000 AS at_ms,", "epoch_us(ts) // 1000 AS at_ms, 't' || event_id % 2 AS topic,")
    .replace("SELECT p, attempt_no, at_ms,", "SELECT topic, p, attempt_no, at_ms,")
    + ","
    + _health("topic, p")
)

_CONTIGUOUS_POSITIONS = f"""WITH {_CONTIGUOUS}
  SELECT m.p, max(CASE WHEN seq <= committed_seq THEN off END) + 1 AS position, max(committed_seq) AS committed_seq,
         count(*) FILTER (WHERE seq > committed_seq) AS pending
  FROM marks m JOIN ends e ON e.p = m.p GROUP BY m.p"""

_LATEST = f"WITH {_CHANGES} SELECT id, name, deleted, off FROM newest"
_HEALTH = f"""WITH {_attempts("'error', 'signup', 'purchase'")}, {_health("p")}
  SELECT p, inflight, recent_errors, round(avg_latency_ms, 6) AS avg_latency_ms, last_error_ms,
         unavailable_until_ms, {_NOW} > unavailable_until_ms AS available FROM health"""

ORACLES = {
    "commit_max": f"WITH {_MARKS} SELECT p, max(off) + 1 AS position FROM marks GROUP BY p",
    "commit_contiguous": _CONTIGUOUS_POSITIONS,
    "commit_gap_timeout": f"""WITH {_ISLANDS}
      SELECT s.p, max(CASE WHEN seq <= committed_seq THEN off END) + 1 AS position, max(committed_seq) AS committed_seq,
             max(committed_seq) + 1 - count(*) FILTER (WHERE seq <= committed_seq) AS skipped,
             count(*) FILTER (WHERE seq > committed_seq) AS pending
      FROM seen s JOIN ends e ON e.p = s.p GROUP BY s.p""",
    "skipped_gaps": f"""WITH {_ISLANDS}
      SELECT p, last_before + 1 AS gap_start, first_seq - 1 AS gap_end, first_seq - 1 - last_before AS missing
      FROM done WHERE ok AND first_seq > last_before + 1""",
    "seq_gaps": f"""WITH {_MARKS}, linked AS (
        SELECT p, seq, lag(seq, 1, -1) OVER (PARTITION BY p ORDER BY seq) AS before FROM marks)
      SELECT p, before + 1 AS gap_start, seq - 1 AS gap_end FROM linked WHERE seq > before + 1""",
    "oldest_pending": f"""WITH {_CONTIGUOUS}, late AS (
        SELECT m.*, row_number() OVER (PARTITION BY m.p ORDER BY processed_us, seq, off) AS nth
        FROM marks m JOIN ends e ON e.p = m.p WHERE seq > committed_seq)
      SELECT p, seq, off, processed_us FROM late WHERE nth = 1""",
    "clean_marks": f"""WITH {_CONTIGUOUS}, twice AS (
        SELECT * FROM marks UNION ALL SELECT p, seq, off, processed_us + 3600000000 FROM marks WHERE seq % 5 = 0)
      SELECT t.p, seq, min(off) AS off, min(processed_us) AS processed_us
      FROM twice t JOIN ends e ON e.p = t.p WHERE seq > committed_seq GROUP BY t.p, seq""",
    "non_monotonic_marks": f"""WITH {_MARKS}, shaken AS (
        SELECT p, seq, CASE WHEN seq % 1000 = 7 THEN off - 5 ELSE off END AS off FROM marks), checked AS (
        SELECT *, max(off) OVER (PARTITION BY p ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM shaken)
      SELECT p, seq, off FROM checked WHERE off <= before""",
    "read_log": f"WITH {_LOG} SELECT p, off, k, v, ts_us, CAST(4 AS INT) AS n_headers FROM log",
    "bounded_read": f"WITH {_LOG} SELECT p, count(*) AS n, min(off) AS first_off, max(off) AS last_off FROM log GROUP BY p",
    "selected_partitions": f"WITH {_LOG} SELECT p, off, k FROM log WHERE p IN (0, 2)",
    "custom_partitioner": f"WITH {_LOG} SELECT CAST(strlen(v) % 4 AS INT) AS p, count(*) AS n FROM log GROUP BY 1",
    "envelope": """SELECT CAST(event_id AS VARCHAR) AS k, props AS v, CAST(3 AS INT) AS n_headers, 'logweave' AS producer,
      event_type AS kind, NULL::VARCHAR AS missing FROM events""",
    "keyed_event_log": """SELECT CAST(event_id AS VARCHAR) AS k,
      '{"Id":"' || event_id || '","EntityType":"' || event_type || '","Payload":"' || replace(props, '"', '\\"') || '"}' AS v
      FROM events""",
    "log_metadata": f"""WITH {_LOG} SELECT 'events' AS _topic, p AS _partition, count(*) AS n, max(off) AS last_off
      FROM log GROUP BY p""",
    "message_transform": f"WITH {_LOG} SELECT 'test-key' AS k, 'test-value with value:' || v AS v FROM log",
    "user_hook": "SELECT 'user ' || user_id AS payload, count(*) AS n FROM events GROUP BY user_id",
    "decode_json": f"""WITH {_FAULTY}
      SELECT p, off, CASE WHEN error IS NULL THEN json_extract_string(v, '$.Id') END AS id,
             CASE WHEN error IS NULL THEN json_extract_string(v, '$.EntityType') END AS entity_type,
             CASE WHEN error IS NULL THEN json_extract_string(v, '$.Payload') END AS payload, error FROM decoded""",
    "decode_json_twice": """SELECT doc_id, lang, md5(text) AS text_md5, CAST(length(text) AS INT) AS n, NULL::VARCHAR AS error
      FROM documents""",
    "codecs": "SELECT doc_id, md5(text) AS string_md5, md5(text) AS json_md5, n_chars FROM documents",
    "header_sequence": f"""WITH {_LOG}
      SELECT p, off, CASE WHEN off % 25 IN (4, 9, 14) THEN NULL ELSE off END AS seq,
             CASE off % 25 WHEN 14 THEN 'missing_header' WHEN 4 THEN 'bad_sequence_id' WHEN 9 THEN 'bad_sequence_id' END AS error
      FROM log""",
    "suffix_partition": """SELECT event_id,
      CASE WHEN event_id % 40 IN (1, 2) THEN NULL WHEN event_id % 40 = 3 AND user_id > 0 THEN NULL ELSE CAST(user_id % 3 AS INT) END AS p,
      CASE WHEN event_id % 40 = 1 THEN 'null_key' WHEN event_id % 40 = 2 THEN 'no_key_number'
           WHEN event_id % 40 = 3 AND user_id > 0 THEN 'negative_key_number' END AS error
      FROM events""",
    "int64_key": """WITH signed AS (
        SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN -o_orderkey ELSE o_orderkey END AS n FROM orders)
      SELECT o_orderkey, printf('%016x', CASE WHEN n >= 0 THEN n::HUGEINT ELSE 18446744073709551616::HUGEINT + n END) AS key_hex,
             n AS decoded FROM signed""",
    "enum_names": """WITH numbered AS (
        SELECT CASE WHEN o_orderkey % 10 = 0 THEN 7 ELSE CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 WHEN 'F' THEN 3 ELSE 0 END END AS state
        FROM orders)
      SELECT CAST(state AS INT) AS state, CASE state WHEN 0 THEN 'ORDER_STATE_UNSPECIFIED' WHEN 1 THEN 'ORDER_STATE_CREATED'
             WHEN 2 THEN 'ORDER_STATE_CHANGED' WHEN 3 THEN 'ORDER_STATE_COMPLETED' END AS name, count(*) AS n
      FROM numbered GROUP BY state""",
    "order_event_roundtrip": """WITH shaped AS (
        SELECT o_orderkey AS order_id, o_custkey AS client_id,
               CASE o_orderstatus WHEN 'O' THEN 'ORDER_STATE_CREATED' WHEN 'P' THEN 'ORDER_STATE_CHANGED'
                    WHEN 'F' THEN 'ORDER_STATE_COMPLETED' ELSE 'ORDER_STATE_UNSPECIFIED' END AS order_state,
               epoch_us(o_orderdate) AS ts_us FROM orders),
      sized AS (
        SELECT *, CASE WHEN order_id = 0 THEN 0 ELSE 1 + floor(log2(order_id) / 7)::INT + 1 END
                + CASE WHEN client_id = 0 THEN 0 ELSE 1 + floor(log2(client_id) / 7)::INT + 1 END
                + CASE WHEN order_state = 'ORDER_STATE_UNSPECIFIED' THEN 0 ELSE 2 END AS head,
               CASE WHEN ts_us // 1000000 = 0 THEN 0 ELSE 1 + floor(log2(ts_us // 1000000) / 7)::INT + 1 END
                + CASE WHEN ts_us % 1000000 = 0 THEN 0 ELSE 1 + floor(log2(ts_us % 1000000 * 1000) / 7)::INT + 1 END AS stamp
        FROM shaped)
      SELECT order_id, client_id, order_state, ts_us, CAST(head + 2 + stamp AS INT) AS n_bytes FROM sized""",
    "stamp_sequence": """SELECT o_orderkey, o_orderstatus,
      row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) - 1 AS seq FROM orders""",
    "numbered_messages": f"""WITH {_LOG}
      SELECT event_id, p, off AS seq, 'Message #' || off || ' at ' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS v FROM log""",
    "chunked": """WITH ranked AS (
        SELECT l_quantity, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS rn FROM lineitem)
      SELECT rn // 10 AS chunk, count(*) AS n, sum(l_quantity) AS quantity FROM ranked GROUP BY 1""",
    "evolve_schema": f"""WITH {_LOG}
      SELECT k, off, CASE WHEN off % 2 = 0 THEN 'before' ELSE 'events' END AS _topic,
             CASE WHEN off % 2 = 0 THEN NULL ELSE p END AS _partition FROM log""",
    "count_view": "SELECT count(*) AS n FROM events",
    "json_queue_view": f"""WITH {_FAULTY}
      SELECT json_extract_string(v, '$.EntityType') AS entity_type, 'events' AS _topic, p AS _partition, count(*) AS n,
             count(DISTINCT json_extract_string(v, '$.Payload')) AS payloads
      FROM decoded WHERE error IS NULL GROUP BY 1, 2, 3""",
    "sorted_target": """SELECT event_type, 'repo_' || user_id AS repo_name, epoch_us(ts) AS created_us,
      CAST(event_id % 3 AS INT) AS p FROM events""",
    "read_committed": f"""WITH {_LOG}
      SELECT p, count(*) AS n, max(off) AS last_off FROM log WHERE (off // 100) % 7 <> 3 GROUP BY p""",
    "dedup_first": f"WITH {_REDELIVERED} SELECT k, event_type, value, arrival FROM numbered WHERE rn = 1",
    "duplicates": f"WITH {_REDELIVERED} SELECT k, event_type, value, arrival FROM numbered WHERE rn > 1",
    "ledger_new_only": f"""WITH {_REDELIVERED} SELECT k, event_type, value, arrival FROM numbered
      WHERE rn = 1 AND k NOT IN (SELECT CAST(event_id AS VARCHAR) FROM events WHERE event_id % 4 = 0)""",
    "null_keys": f"WITH {_REDELIVERED} SELECT event_type, arrival, 'null_key' AS error FROM deliveries WHERE arrival % 9 = 4",
    "carry_positions": """SELECT c_custkey, coalesce(position, 0) AS position FROM customer
      LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS position FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
    "set_changes": """WITH old AS (SELECT DISTINCT o_custkey AS a FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'),
      new AS (SELECT DISTINCT o_custkey AS b FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')
      SELECT coalesce(a, b) AS o_custkey, CASE WHEN a IS NULL THEN 'added' WHEN b IS NULL THEN 'removed' ELSE 'kept' END AS change
      FROM old FULL JOIN new ON a = b""",
    "retry_outcomes": f"WITH {_OUTCOMES} SELECT event_id, p, attempts, delay_s, outcome FROM retried",
    "retry_frame": f"WITH {_OUTCOMES} SELECT event_id, p, attempts, delay_s, outcome FROM retried",
    "dlq_rows": f"""WITH {_OUTCOMES} SELECT event_id, 'processing_failed' AS error, attempts, ts_us AS failed_us
      FROM retried WHERE outcome = 'dlq'""",
    "dlq_reasons": f"""WITH {_FAULTY} SELECT CASE WHEN error IS NULL THEN 'ok' ELSE 'dead' END AS outcome, error, count(*) AS n
      FROM decoded GROUP BY 1, 2""",
    "pause_intervals": f"WITH {_PAUSES} SELECT p, s AS paused_us, e AS resumed_us FROM merged",
    "pause_holds": f"""WITH {_PAUSES} SELECT r.event_id, r.p, m.e AS held_us FROM retried r
      LEFT JOIN merged m ON m.p = r.p AND r.ts_us > m.s AND r.ts_us < m.e""",
    "classify_errors": f"""WITH {_attempts("'error'")}
      SELECT error_code, CASE WHEN error_code IN ({_NON_RETRIABLE}) THEN 'non_retriable'
               WHEN error_code IN ({_RETRIABLE}) THEN 'retriable' WHEN error_code IS NOT NULL THEN 'unlisted' END AS error_class,
             coalesce(NOT is_fatal AND error_code NOT IN ({_NON_RETRIABLE}), false) AS retryable,
             coalesce(error_code IN ({_COOLDOWN}), false) AS cooldown, count(*) AS n
      FROM attempts GROUP BY 1, 2, 3, 4""",
    "ewma_latency": f"""WITH {_attempts("'error'")}, {_health("p")} SELECT p, round(mean, 6) AS ewma FROM means""",
    "inflight": f"""WITH {_attempts("'error'")}
      SELECT p, CAST(sum(CASE WHEN kind = 'produce' THEN 1 ELSE -1 END) AS BIGINT) AS inflight,
             CAST(sum(CASE kind WHEN 'produce' THEN 1 WHEN 'delivery' THEN -1 ELSE 0 END) AS BIGINT) AS leaked
      FROM attempts GROUP BY p""",
    "recent_errors": f"""WITH {_attempts("'error', 'signup', 'purchase'")}, {_health("p")}
      SELECT p, CAST(recent_errors AS BIGINT) AS recent_errors FROM errors""",
    "partition_health": _HEALTH,
    "partition_score": f"""WITH {_attempts("'error'")}, {_health("p")}
      SELECT p, round({_score(_NOW)}, 6) AS score FROM health""",
    "choose_partition": f"""{_HOUR_HEALTH},
      timed AS (SELECT *, coalesce(last_error_ms + 4000, 1) AS now FROM health),
      tried AS (SELECT hour, p, now > unavailable_until_ms AS available, {_score("now")} AS score FROM timed),
      every AS (SELECT hour, CAST(n AS INT) AS p FROM (SELECT DISTINCT hour FROM health), range(3) AS r(n)),
      scored AS (SELECT e.hour, e.p, coalesce(available, true) AS available, coalesce(score, 0) AS score
                 FROM every e LEFT JOIN tried t ON e.hour = t.hour AND e.p = t.p),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY hour ORDER BY available DESC, score, p) AS nth FROM scored)
      SELECT hour, CASE WHEN available THEN p ELSE CAST(CAST('0x' || substr(md5(CAST(hour AS VARCHAR)), 1, 15) AS BIGINT) % 3 AS INT) END AS chosen,
             CASE WHEN available THEN round(score, 6) END AS score
      FROM ranked WHERE nth = 1""",
    # the smallest numbers score, score + 1, score + 2, ... of a topic, as many as it has rows
    "partition_quota": f"""{_TOPIC_HEALTH},
      scored AS (SELECT topic, p, CAST(round(({_score(_NOW)}) * 1000000) AS BIGINT) AS score, {_NOW} > unavailable_until_ms AS available
                 FROM health),
      sizes AS (SELECT 't' || event_id % 2 AS topic, count(*) AS n FROM events GROUP BY 1),
      every AS (SELECT topic, n, CAST(r.p AS INT) AS p FROM sizes, range(3) AS r(p)),
      options AS (SELECT e.topic, e.p, n, coalesce(score, 0) AS score FROM every e
                  LEFT JOIN scored s ON e.topic = s.topic AND e.p = s.p WHERE coalesce(available, true)),
      ranked AS (SELECT topic, p, n, row_number() OVER (PARTITION BY topic ORDER BY score + 1000000 * j, p) AS nth
                 FROM options, range((SELECT max(n) FROM sizes)) AS r(j))
      SELECT topic, p, count(*) AS quota FROM ranked WHERE nth <= n GROUP BY topic, p""",
    "route_batch": _route(),
    "delivery_metrics": f"""WITH {_attempts("'error'")} {_METRICS}""",
    "metrics_rollup": f"""WITH {_attempts("'error'")} {_ROLLUP}""",
    "cdc_source": f"""WITH {_CHANGES} SELECT op, count(*) AS n, min(CASE WHEN op = 'r' THEN -1 ELSE off END) AS first_off,
      max(name) AS last_name FROM changes GROUP BY op""",
    # a key without a change in its chunk's window has one state throughout the window
    "incremental_snapshot": """WITH size AS (SELECT max(event_id) + 1 AS n FROM events),
      windows AS (SELECT r.c AS chunk, (r.c + 1) * n // 24 AS low, (r.c + 1) * n // 24 + n // 20 AS high FROM size, range(8) AS r(c)),
      keyed AS (SELECT e.*, low, high FROM events e JOIN windows ON user_id % 8 = chunk),
      newest AS (SELECT user_id, event_type, any_value(high) AS high, max(CASE WHEN event_id <= low THEN event_id END) AS event_id
                 FROM keyed GROUP BY 1, 2 HAVING NOT bool_or(event_id > low AND event_id <= high))
      SELECT user_id, event_type, value, 'r' AS op, high AS off FROM newest JOIN events USING (user_id, event_type, event_id)
      WHERE event_id % 7 <> 0
      UNION ALL SELECT user_id, event_type, value, CASE WHEN event_id % 7 = 0 THEN 'd' ELSE 'u' END, event_id
      FROM events, size WHERE event_id > n // 24""",
    "incremental_snapshot_rows": """SELECT user_id, event_type, value FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1 AND event_id % 7 <> 0""",
    "cdc_unwrap": f"""WITH {_CHANGES}
      SELECT CAST(id AS VARCHAR) AS k, off, id, name, CASE WHEN op = 'd' THEN 'true' ELSE 'false' END AS deleted,
             false AS is_tombstone, NULL::VARCHAR AS error FROM changes
      UNION ALL SELECT CAST(id AS VARCHAR), off + 5000000, NULL, NULL, NULL, true, NULL FROM changes WHERE op = 'd'""",
    "cdc_unwrap_rewritten": f"""WITH {_CHANGES}, read AS (SELECT *, id % 13 IN (5, 6, 7) AS broken FROM changes)
      SELECT CAST(id AS VARCHAR) AS k, off, CASE WHEN NOT broken THEN id END AS id, CASE WHEN NOT broken THEN name END AS name,
             CASE WHEN broken THEN NULL WHEN op = 'd' THEN 'true' ELSE 'false' END AS deleted,
             false AS is_tombstone, CASE WHEN broken THEN 'malformed_change' END AS error FROM read
      UNION ALL SELECT CAST(id AS VARCHAR), off + 5000000, NULL, NULL, NULL, true, NULL FROM changes WHERE op = 'd'""",
    "cdc_latest": _LATEST,
    "cdc_latest_live": f"{_LATEST} WHERE deleted <> 'true'",
    "upsert_table": _LATEST,
    "mark_processed": "SELECT CAST(event_id AS VARCHAR) AS message_id FROM events WHERE event_id % 5 <> 0",
}
