"""DuckDB SQL for the queries of ``streams``.

The replay's parts are computed from event times as the producer does it; a
batch reads one part.  A share of a row in a window is dropped when the window
had ended by the watermark of the batch before, which stands 120 seconds behind
the greatest event time of all batches before that one.
"""

from __future__ import annotations

from riskflow.plans.oracle import (
    ALL_FLAGS, EXPLAIN_SUBJECT, FEATURE_COLS, FEATURES, FLAGGED_IMMEDIATE, IMMEDIATE_AS_SUPERSET, SCORED, SCORED_WINDOWED, TIMED,
    TX, VIEW_INTS, WINDOWED_AS_SUPERSET, _null_safe, _q)

PARTS = 8

REPLAYED = TX + f""",
placed AS (
  SELECT tx.*, least({PARTS - 1}, ("timestamp" - lo) * {PARTS} // (hi - lo + 1)
           + CASE CAST(transaction_id AS BIGINT) % 20 WHEN 7 THEN 1 WHEN 13 THEN 2 WHEN 17 THEN 4 ELSE 0 END) AS batch
  FROM tx, (SELECT min("timestamp") AS lo, max("timestamp") AS hi FROM tx)),
timed AS (
  SELECT transaction_id, user_id, amount, "timestamp" // 1000 AS "timestamp", batch FROM placed),
tops AS (SELECT batch, max("timestamp") AS top FROM timed GROUP BY batch),
marks AS (
  SELECT r.b AS batch, (SELECT max(top) - 120 FROM tops WHERE tops.batch <= r.b - 2) AS mark
  FROM (SELECT unnest(range(0, {PARTS})) AS b) r),
shares AS (
  SELECT *, ("timestamp" // 30) * 30 - unnest([0, 30, 60, 90]) AS window_start FROM timed),
judged AS (
  SELECT s.*, window_start + 120 AS window_end, coalesce(window_start + 120 <= mark, false) AS late
  FROM shares s JOIN marks USING (batch)),
features AS (
  SELECT window_start, window_end, user_id, sum(amount) AS window_amount, count(*) AS window_count,
         avg(amount) AS avg_amount, max(amount) AS max_amount, sum(amount) / 2 AS velocity
  FROM judged WHERE NOT late GROUP BY window_start, window_end, user_id)"""


def _union(policy: str, pick: str) -> str:
    """Flags of two topics under a policy: ``pick`` is least or greatest of their watermarks."""
    return f"""
placed_{policy} AS (
  SELECT tx.*, CAST(transaction_id AS BIGINT) % 2 AS odd,
         least({PARTS - 1}, ("timestamp" - lo) * (CASE WHEN CAST(transaction_id AS BIGINT) % 2 = 0 THEN {PARTS} ELSE {2 * PARTS} END)
           // (hi - lo + 1)) AS batch
  FROM tx, (SELECT min("timestamp") AS lo, max("timestamp") AS hi FROM tx)),
shares_{policy} AS (
  SELECT user_id, amount, batch, ("timestamp" // 30000) * 30 - unnest([0, 30, 60, 90]) AS window_start FROM placed_{policy}),
marks_{policy} AS (
  SELECT r.b AS batch, {pick}((SELECT max("timestamp") // 1000 - 120 FROM placed_{policy} p WHERE odd = 0 AND p.batch <= r.b - 2),
                              (SELECT max("timestamp") // 1000 - 120 FROM placed_{policy} p WHERE odd = 1 AND p.batch <= r.b - 2)) AS mark
  FROM (SELECT unnest(range(0, {PARTS + 2})) AS b) r),
counted_{policy} AS (
  SELECT window_start, window_start + 120 AS window_end, user_id, sum(amount) AS window_amount, count(*) AS window_count,
         avg(amount) AS avg_amount, max(amount) AS max_amount, sum(amount) / 2 AS velocity
  FROM shares_{policy} JOIN marks_{policy} USING (batch)
  WHERE NOT coalesce(window_start + 120 <= mark, false) GROUP BY window_start, user_id),
union_{policy} AS (
  SELECT * FROM ({_flags_of(f'counted_{policy}')})
  WHERE rule_score > 0.5 AND window_end <= (SELECT mark FROM marks_{policy} WHERE batch = {PARTS + 1}))"""


def _flags_of(features: str) -> str:
    """The scoring step of the batch oracle over another table of features."""
    scored = SCORED_WINDOWED[len(FEATURES):]
    return scored[scored.index("SELECT"):scored.index("FROM features")] + f"FROM {features}"


def _union_sql() -> str:
    ctes = ALL_FLAGS + "," + _union("min", "least") + "," + _union("max", "greatest")
    parts = []
    for policy in ("min", "max"):
        windows = WINDOWED_AS_SUPERSET.replace("flagged_closed", f"union_{policy}")
        parts.append(f"SELECT *, '{policy}' AS policy FROM ({IMMEDIATE_AS_SUPERSET} UNION ALL {windows})")
    return _q(ctes, " UNION ALL ".join(parts))


def oracle_sql() -> dict[str, str]:
    closed = _q(SCORED_WINDOWED, f"SELECT {FEATURE_COLS} FROM closed")
    out = {
        "stream_windows_out_of_order": _q(REPLAYED, f"""
            SELECT {FEATURE_COLS} FROM features
            WHERE window_end <= (SELECT max("timestamp") - 120 FROM timed)"""),
        "stream_late_rows": _q(REPLAYED, """
            SELECT transaction_id, user_id, amount, "timestamp", window_start, window_end, CAST(batch AS BIGINT) AS batch_id
            FROM judged WHERE late"""),
        "stream_late_counts": _q(REPLAYED, """
            SELECT CAST(batch AS BIGINT) AS batch_id, count(DISTINCT transaction_id) AS rows,
                   count(DISTINCT CASE WHEN late THEN transaction_id END) AS late_rows,
                   count(DISTINCT CASE WHEN late THEN (window_start, user_id) END) AS late_windows,
                   max("timestamp") AS max_event_time
            FROM judged GROUP BY batch"""),
        "stream_windows_repaired": closed,
        "stream_restart_windows": closed,
        "stream_open_windows": _q(SCORED_WINDOWED, f"""
            SELECT {FEATURE_COLS} FROM features
            WHERE window_end > (SELECT max("timestamp") - 120 FROM timed)"""),
        "stream_flagged_topic_once": _null_safe(
            _q(ALL_FLAGS, "SELECT * FROM topic"), ["timestamp", "window_start", "window_end", "window_count"], ["is_fraud"]),
        "stream_explained": _null_safe(_q(ALL_FLAGS, f"""
            SELECT record_key, transaction_id, user_id, window_start, window_end, fraud_reason, rule_score,
                   'SUCCESS' AS status,
                   'Flagged ' || {EXPLAIN_SUBJECT} || ' as ' || fraud_reason
                     || ' with rule score ' || CAST(rule_score AS VARCHAR) || '.' AS llm_explanation
            FROM topic WHERE fraud_reason <> 'HIGH_AVERAGE'"""), VIEW_INTS),
        "stream_dead_letters": _null_safe(_q(ALL_FLAGS, """
            SELECT record_key, transaction_id, user_id, window_start, window_end, fraud_reason, rule_score,
                   'FAILED' AS status, 'explainer refused HIGH_AVERAGE' AS error
            FROM topic WHERE fraud_reason = 'HIGH_AVERAGE'"""), VIEW_INTS),
    }
    out["stream_explained_retry"] = _null_safe(_q(ALL_FLAGS, """
        SELECT record_key, transaction_id, user_id, window_start, window_end, fraud_reason, rule_score,
               CASE WHEN refused OR throttled THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               CASE WHEN refused THEN 'explainer refused HIGH_AVERAGE' WHEN throttled THEN 'throttled' END AS error,
               attempts, attempts AS batches
        FROM (SELECT *, fraud_reason = 'HIGH_AVERAGE' AS refused,
                     fraud_reason = 'HIGH_VELOCITY' AND rule_score = 0.85 AS throttled,
                     CASE WHEN fraud_reason = 'RAPID_TRANSACTIONS' THEN 2
                          WHEN fraud_reason = 'HIGH_VELOCITY' AND rule_score = 0.85 THEN 3 ELSE 1 END AS attempts
              FROM topic)"""), VIEW_INTS)
    out["stream_batch_metrics"] = _q(SCORED_WINDOWED + SCORED[len(TIMED):] + FLAGGED_IMMEDIATE[len(SCORED):] + """,
        placed AS (
          SELECT ("timestamp" - lo) * 8 // (hi - lo + 1) AS batch FROM tx, (SELECT min("timestamp") AS lo, max("timestamp") AS hi FROM tx)),
        inputs AS (SELECT count(*) AS n, count(DISTINCT batch) AS batches FROM placed)""", """
        SELECT query, metric, CAST(total AS DOUBLE) AS total, batches FROM (
          SELECT 'flagged-immediate-kafka' AS query, 'input_rows' AS metric, n AS total, batches FROM inputs
          UNION ALL SELECT 'flagged-windowed-kafka', 'input_rows', n, batches FROM inputs
          UNION ALL SELECT 'flagged-immediate-kafka', 'immediate.flags', count(*), (SELECT batches FROM inputs) FROM flagged_immediate
          UNION ALL SELECT 'flagged-windowed-kafka', 'windowed.windows', count(*), (SELECT batches FROM inputs) FROM closed
          UNION ALL SELECT 'flagged-windowed-kafka', 'windowed.flags', count(*), (SELECT batches FROM inputs) FROM flagged_closed)""")
    out["wire_evolution"] = _null_safe(_q(TX, """
        SELECT CASE WHEN kind = 2 THEN 99 ELSE kind + 1 END AS schema_id,
               CASE WHEN kind < 2 THEN CAST(kind + 1 AS DOUBLE) END AS version,
               CASE WHEN kind < 2 THEN transaction_id END AS transaction_id, CASE WHEN kind < 2 THEN user_id END AS user_id,
               CASE WHEN kind < 2 THEN amount END AS amount, CASE WHEN kind < 2 THEN currency END AS currency,
               CASE WHEN kind < 2 THEN merchant END AS merchant, CASE WHEN kind < 2 THEN category END AS category,
               CASE WHEN kind < 2 THEN "timestamp" END AS "timestamp", CASE WHEN kind < 2 THEN country END AS country,
               CASE kind WHEN 0 THEN device_type WHEN 1 THEN 'unknown' END AS device_type,
               CASE WHEN kind < 2 THEN is_fraud END AS is_fraud,
               CASE kind WHEN 0 THEN 'web' WHEN 1 THEN 'app' END AS channel, kind = 2 AS rejected
        FROM (SELECT *, CAST(transaction_id AS BIGINT) % 3 AS kind FROM tx)"""), ["timestamp"], ["is_fraud"])
    topic = ["timestamp", "window_start", "window_end", "window_count"]
    out["parse_flagged_variant"] = _null_safe(_q(ALL_FLAGS, """
        SELECT *, false AS corrupt FROM topic
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
               NULL, NULL, NULL, NULL, '', true
        FROM topic WHERE shape = 'window'"""), topic, ["is_fraud"])
    out["stream_flagged_union"] = _null_safe(_union_sql(), topic, ["is_fraud"])
    return out
