"""DuckDB SQL equal to each checked query (tables are pre-registered views).

Written independently of the Spark code: the same fixture mapping and rules,
in plain SQL.  Scores are cast to DOUBLE (DuckDB literals are DECIMAL), event
times are epoch seconds.
"""

from __future__ import annotations

# Transactions from ``events``: FIXTURES mapping (epoch ms, scaled amounts).
TX = """
tx AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         CASE WHEN user_id IS NOT NULL THEN 'user-' || printf('%04d', user_id) END AS user_id,
         round(value * 25, 2) AS amount,
         (['USD','EUR','MXN','GBP'])[((event_id % 4) + 4) % 4 + 1] AS currency,
         (['Northwind','Contoso','Globex','Initech','Umbrella','Hooli','Vandelay'])[((event_id % 7) + 7) % 7 + 1] AS merchant,
         (['electronics','groceries','travel','entertainment',NULL])[((event_id % 5) + 5) % 5 + 1] AS category,
         CAST(1704067200000 + (epoch_us(ts) - 1704067200000000) // 1000000 AS BIGINT) AS "timestamp",
         (['US','MX','GB','DE','CN','RU'])[((event_id % 6) + 6) % 6 + 1] AS country,
         (['mobile','desktop','tablet'])[((event_id % 3) + 3) % 3 + 1] AS device_type,
         event_type = 'error' AS is_fraud
  FROM events)"""

# Event time in whole epoch seconds (truncation toward zero; all values >= 0).
TIMED = TX + """,
timed AS (
  SELECT transaction_id, user_id, amount, currency, merchant, category,
         "timestamp" // 1000 AS "timestamp", country, device_type, is_fraud
  FROM tx)"""

SCORED = TIMED + """,
scored AS (
  SELECT *,
         CASE WHEN amount > 5000 THEN 'HIGH_AMOUNT'
              WHEN is_fraud THEN 'LABELED_FRAUD' ELSE 'NORMAL' END AS fraud_reason,
         CAST(CASE WHEN amount > 5000 THEN 0.9
                   WHEN is_fraud THEN 0.8 ELSE 0.1 END AS DOUBLE) AS rule_score
  FROM timed)"""

FLAGGED_IMMEDIATE = SCORED + """,
flagged_immediate AS (
  SELECT transaction_id, user_id, amount, currency, merchant, "timestamp",
         fraud_reason, rule_score, is_fraud
  FROM scored WHERE rule_score > 0.5)"""

# Each row falls in the 4 windows of 120 s whose start is a multiple of 30 s.
FEATURES = TIMED + """,
in_windows AS (
  SELECT ("timestamp" // 30) * 30 - unnest([0, 30, 60, 90]) AS window_start,
         user_id, amount
  FROM timed),
features AS (
  SELECT window_start, window_start + 120 AS window_end, user_id,
         sum(amount) AS window_amount, count(*) AS window_count,
         avg(amount) AS avg_amount, max(amount) AS max_amount,
         sum(amount) / 2 AS velocity
  FROM in_windows GROUP BY window_start, user_id)"""

SCORED_WINDOWED = FEATURES + """,
scored_windowed AS (
  SELECT *,
         CASE WHEN velocity > 2500 THEN 'HIGH_VELOCITY'
              WHEN window_count > 3 THEN 'RAPID_TRANSACTIONS'
              WHEN avg_amount > 3000 THEN 'HIGH_AVERAGE'
              ELSE 'PATTERN_DETECTED' END AS fraud_reason,
         CAST(CASE WHEN velocity > 5000 THEN 0.95
                   WHEN velocity > 2500 OR window_count > 5 THEN 0.85
                   WHEN velocity > 1000 OR window_count > 3 OR avg_amount > 3000 THEN 0.70
                   ELSE 0.1 END AS DOUBLE) AS rule_score
  FROM features),
flagged_windowed AS (
  SELECT * FROM scored_windowed WHERE rule_score > 0.5),
closed AS (
  SELECT * FROM scored_windowed
  WHERE window_end <= (SELECT max("timestamp") - 120 FROM timed)),
flagged_closed AS (
  SELECT * FROM closed WHERE rule_score > 0.5)"""

FEATURE_COLS = ("window_start, window_end, user_id, window_amount, window_count, "
                "avg_amount, max_amount, velocity")


def _varint_len(n: str) -> str:
    """Bytes of an Avro varint holding the non-negative (zigzagged) ``n``."""
    whens = " ".join(f"WHEN {n} < {1 << (7 * k)} THEN {k}" for k in range(1, 10))
    return f"(CASE {whens} ELSE 10 END)"


def _avro_string_len(s: str) -> str:
    return f"({_varint_len(f'2 * strlen({s})')} + strlen({s}))"


# Avro body size of one transaction: strings are zigzag length + UTF-8,
# double 8 bytes, the optional category has a 1-byte branch index, timestamp
# a zigzag varint, boolean 1 byte.
BODY_LEN = " + ".join([
    _avro_string_len("transaction_id"), _avro_string_len("user_id"), "8",
    _avro_string_len("currency"), _avro_string_len("merchant"),
    f"(1 + CASE WHEN category IS NULL THEN 0 ELSE {_avro_string_len('category')} END)",
    _varint_len('2 * "timestamp"'), _avro_string_len("country"),
    _avro_string_len("device_type"), "1",
])


# Both flag flows on one topic, read back with the superset schema.
IMMEDIATE_AS_SUPERSET = """
  SELECT transaction_id, user_id, amount, currency, merchant, "timestamp", fraud_reason,
         rule_score, is_fraud, CAST(NULL AS BIGINT) AS window_start, CAST(NULL AS BIGINT) AS window_end,
         CAST(NULL AS DOUBLE) AS window_amount, CAST(NULL AS BIGINT) AS window_count,
         CAST(NULL AS DOUBLE) AS avg_amount, CAST(NULL AS DOUBLE) AS max_amount,
         CAST(NULL AS DOUBLE) AS velocity, 'transaction' AS shape, user_id AS record_key
  FROM flagged_immediate"""

WINDOWED_AS_SUPERSET = """
  SELECT CAST(NULL AS VARCHAR) AS transaction_id, user_id, CAST(NULL AS DOUBLE) AS amount,
         CAST(NULL AS VARCHAR) AS currency, CAST(NULL AS VARCHAR) AS merchant,
         CAST(NULL AS BIGINT) AS "timestamp", fraud_reason, rule_score,
         CAST(NULL AS BOOLEAN) AS is_fraud, window_start, window_end, window_amount,
         window_count, avg_amount, max_amount, velocity, 'window' AS shape, user_id AS record_key
  FROM flagged_closed"""

ALL_FLAGS = (SCORED_WINDOWED + SCORED[len(TIMED):] + FLAGGED_IMMEDIATE[len(SCORED):]
             + ",\ntopic AS (" + IMMEDIATE_AS_SUPERSET + "\n  UNION ALL" + WINDOWED_AS_SUPERSET + ")")

EXPLAIN_SUBJECT = """CASE WHEN shape = 'window' THEN 'user ' || user_id || ' in a sliding window'
                          ELSE 'transaction ' || transaction_id END"""


def _null_safe(sql: str, ints: list[str], bools: list[str] = ()) -> str:
    """Same representation rule as ``plans.compare.null_safe``: nullable
    integer columns as DOUBLE, nullable booleans as text."""
    repl = [f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in ints] + \
           [f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in bools]
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM ({sql}) AS q"


TOPIC_INTS = ["timestamp", "window_start", "window_end", "window_count"]
VIEW_INTS = ["window_start", "window_end"]


def _q(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body.strip()


def oracle_sql() -> dict[str, str]:
    out = {
        "transactions": _q(TX, "SELECT * FROM tx"),
        "header_fields": _q(TX, f"""
            SELECT user_id AS key, 0 AS magic_byte, CAST(1 AS BIGINT) AS schema_id,
                   CAST(5 + {BODY_LEN} AS INTEGER) AS wire_length
            FROM tx"""),
        "strip_header": _q(TX, f"""
            SELECT user_id AS key, CAST({BODY_LEN} AS INTEGER) AS body_length,
                   printf('%02X', 2 * strlen(transaction_id)) AS first_byte,
                   CASE WHEN is_fraud THEN '01' ELSE '00' END AS last_byte
            FROM tx"""),
        "wire_roundtrip": _q(TX, "SELECT * FROM tx"),
        "wire_decode_permissive": _q(TX, """
            SELECT * FROM tx
            UNION ALL
            SELECT CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE),
                   CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
                   CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
                   CAST(NULL AS BOOLEAN)
            FROM tx"""),
        "event_time": _q(TIMED, 'SELECT transaction_id, "timestamp" FROM timed'),
        "score_immediate": _q(SCORED, "SELECT * FROM scored"),
        "flag_immediate": _q(FLAGGED_IMMEDIATE, "SELECT * FROM flagged_immediate"),
        "velocity_features": _q(FEATURES, "SELECT * FROM features"),
        "velocity_features_panes": _q(FEATURES, "SELECT * FROM features"),
        "score_windowed": _q(SCORED_WINDOWED, "SELECT * FROM scored_windowed"),
        "flag_windowed": _q(SCORED_WINDOWED, "SELECT * FROM flagged_windowed"),
        "closed_windows": _q(SCORED_WINDOWED, f"SELECT {FEATURE_COLS} FROM closed"),
        "flag_windowed_closed": _q(SCORED_WINDOWED, "SELECT * FROM flagged_closed"),
        "payload_immediate": _q(FLAGGED_IMMEDIATE,
                                "SELECT user_id AS key, * FROM flagged_immediate"),
        "payload_windowed": _q(SCORED_WINDOWED, f"""
            SELECT user_id AS key, window_start, window_end, user_id, window_amount,
                   window_count, avg_amount, max_amount, velocity, fraud_reason, rule_score
            FROM flagged_closed"""),
        "flagged_topic": _q(ALL_FLAGS, "SELECT * FROM topic"),
        "parse_flagged": _q(ALL_FLAGS, """
            SELECT *, false AS corrupt FROM topic
            UNION ALL
            SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
                   NULL, NULL, NULL, NULL, '', true
            FROM topic WHERE shape = 'window'"""),
        "explained": _q(ALL_FLAGS, f"""
            SELECT record_key, shape, transaction_id, user_id, window_start, window_end,
                   fraud_reason, rule_score, 'SUCCESS' AS status,
                   CASE WHEN fraud_reason = 'RAPID_TRANSACTIONS' THEN 2 ELSE 1 END AS attempts,
                   'Flagged ' || {EXPLAIN_SUBJECT} || ' as ' || fraud_reason
                     || ' with rule score ' || CAST(rule_score AS VARCHAR) || '.' AS llm_explanation
            FROM topic WHERE fraud_reason <> 'HIGH_AVERAGE'"""),
        "explained_template": _q(ALL_FLAGS, f"""
            SELECT record_key, shape, transaction_id, user_id, window_start, window_end,
                   fraud_reason, rule_score, 'SUCCESS' AS status, 1 AS attempts,
                   'Flagged ' || {EXPLAIN_SUBJECT} || ' as ' || fraud_reason
                     || ' with rule score ' || CAST(rule_score AS VARCHAR) || '.' AS llm_explanation
            FROM topic"""),
        "dead_letters": _q(ALL_FLAGS, """
            SELECT record_key, shape, transaction_id, user_id, window_start, window_end,
                   fraud_reason, rule_score, 'FAILED' AS status, 1 AS attempts,
                   'explainer refused HIGH_AVERAGE' AS error
            FROM topic WHERE fraud_reason = 'HIGH_AVERAGE'"""),
        "explain_summary": _q(ALL_FLAGS, """
            SELECT CASE WHEN fraud_reason = 'HIGH_AVERAGE' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
                   count(*) AS n
            FROM topic GROUP BY 1"""),
    }
    out["dead_letters_undecodable"] = _q(ALL_FLAGS, """
        SELECT user_id AS message_key, 'FAILED' AS status, 'decode: not a JSON object' AS error,
               0 AS attempts, true AS has_raw_text
        FROM topic""")
    for name in ("flagged_topic", "parse_flagged"):
        out[name] = _null_safe(out[name], TOPIC_INTS, ["is_fraud"])
    for name in ("explained", "explained_template", "dead_letters"):
        out[name] = _null_safe(out[name], VIEW_INTS)
    out["wire_decode_permissive"] = _null_safe(out["wire_decode_permissive"], ["timestamp"], ["is_fraud"])
    # A stream run over the whole input equals the batch results.
    out["stream_flag_immediate"] = out["flag_immediate"]
    out["stream_closed_windows"] = out["closed_windows"]
    out["stream_flag_windowed"] = out["flag_windowed_closed"]
    out["stream_flagged_topic"] = out["flagged_topic"]
    out["stream_closed_windows_batches"] = out["closed_windows"]
    out["stream_flag_windowed_batches"] = out["flag_windowed_closed"]
    return out
