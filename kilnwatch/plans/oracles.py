"""The registered queries in ANSI SQL, written from the semantics by self-joins.

They are the yardstick of the Spark plans: thresholds, guards and texts are written out here.
"""

from __future__ import annotations

from typing import NamedTuple

# Message templates of the alert contract.
LIMIT_TEXT = "최근 5분 내 Recipe 기준 이탈 %d회 발생. 측정값 %.3f (기준 %.3f)"
TREND_TEXT = "최근 1분 내 %s 추세 감지. 방향 비율 %.2f, 변화율 %.2f%%"
BIAS_TEXT = "최근 5분 데이터 중 %.2f%%가 공정 중심값에서 한쪽으로 편향됨"
RECOVERY_TEXT = "정상 범위 복구 (%s)"


class Guards(NamedTuple):
    limit_ms: int
    trend_ms: int
    batches: int
    trend_samples: int
    bias_samples: int


WIDE = Guards(432_000_000, 21_600_000, 5, 4, 30)
CONTRACT = Guards(300_000, 60_000, 5, 42, 240)

ORDER_READINGS = """
SELECT {prefix} || o_orderkey AS batch_id, o_orderpriority AS device_id,
       o_custkey AS equipment_id, epoch_ms(o_orderdate) AS created_ms,
       CAST(60 AS INTEGER) AS interval_sec, l_linenumber AS sequence, measured_ms,
       measurement_status, 'P' || l_partkey AS sensor_id, l_linestatus AS sensor_type,
       l_quantity AS value, CAST(10 AS DOUBLE) AS recipe_min, CAST(40 AS DOUBLE) AS recipe_max,
       'pcs' AS unit, 'OK' AS sensor_status
FROM orders JOIN (
  SELECT *, first_value(epoch_ms(l_shipdate)) OVER w AS measured_ms,
         first_value(l_returnflag) OVER w AS measurement_status
  FROM lineitem
  WINDOW w AS (PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_shipdate, l_returnflag, 'P' || l_partkey, l_linestatus, l_quantity,
                        l_suppkey)
) ON o_orderkey = l_orderkey
"""

READINGS = """
SELECT event_id AS arrival_seq, CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_id,
       'D' || user_id % 4 AS device_id, user_id % 4 AS equipment_id,
       epoch_ms(date_trunc('day', ts)) AS created_ms, CAST(1 AS INTEGER) AS interval_sec,
       CAST(event_id AS INTEGER) AS sequence, epoch_us(ts) // 1000 AS measured_ms,
       'OK' AS measurement_status, event_type AS sensor_id, event_type AS sensor_type, value,
       CASE WHEN event_type IN ('click', 'view') THEN CAST(0.3 AS DOUBLE)
            ELSE CAST(50 AS DOUBLE) END AS recipe_min,
       CASE WHEN event_type IN ('click', 'view') THEN CAST(220 AS DOUBLE)
            ELSE CAST(250 AS DOUBLE) END AS recipe_max,
       'C' AS unit, CASE WHEN value < 100 THEN 'OK' ELSE 'HOT' END AS sensor_status,
       props, ts
FROM events
"""
STORED = (
    "batch_id AS batchId, device_id AS deviceId, equipment_id AS equipmentId, created_ms,"
    " interval_sec AS intervalSec, sequence, measured_ms,"
    " measurement_status AS measurementStatus, sensor_id AS sensorId,"
    " sensor_type AS sensorType, value, recipe_min AS recipeMin, recipe_max AS recipeMax,"
    " unit, sensor_status AS sensorStatus"
)
DOCUMENT = (
    "coalesce(CAST(equipment_id AS VARCHAR), '') || '_' || coalesce(sensor_id, '') || '_'"
    " || {measured} AS document_id, batch_id AS batchId, device_id AS deviceId,"
    " equipment_id AS equipmentId, created_ms AS createdAt, interval_sec AS intervalSec,"
    " sequence, {measured} AS measuredAt, sensor_status AS status, sensor_id AS sensorId,"
    " sensor_type AS sensorType, value, recipe_min AS recipeMin, recipe_max AS recipeMax"
)
DAILY = DOCUMENT.format(measured="created_ms")
PARTITION = (
    "strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,"
    " device_id AS device"
)
FIRST_COPIES = f"""
SELECT * FROM (
  SELECT *, CAST(day(ts) AS INTEGER) AS day_no,
         row_number() OVER (PARTITION BY batch_id, equipment_id, day(ts), sensor_id
                            ORDER BY arrival_seq) AS copy
  FROM ({READINGS})
) WHERE copy = 1
"""
DAY_KEY = "batch_id || '|' || equipment_id || '|' || day_no || '|' || sensor_id AS dedup_key"


def _fixed(number: str, digits: int) -> str:
    """A number's decimal text rounded half up, as Java's Formatter does."""
    exact = f"CAST(CAST({number} AS VARCHAR) AS DECIMAL(38, 14))"
    return f"CAST(CAST({exact} AS DECIMAL(38, {digits})) AS VARCHAR)"


def _sentence(template: str, *parts: str) -> str:
    """The template with each placeholder replaced by an SQL text."""
    pieces, rest = [], template
    for part in parts:
        before, _, rest = rest.partition("%")
        rest = rest[1:] if rest[0] in "sd" else rest[3:]
        pieces += [f"'{before}'", part]
    pieces.append(f"'{rest}'")
    return " || ".join(piece.replace("%%", "%") for piece in pieces)


def _iso(ms: str) -> str:
    second = f"strftime(make_timestamp({ms} * 1000), '%Y-%m-%dT%H:%M:%S')"
    fraction = f"CASE WHEN {ms} % 1000 = 0 THEN '' ELSE '.' || lpad(CAST({ms} % 1000 AS VARCHAR), 3, '0') END"
    return f"{second} || {fraction} || 'Z'"


def _arrived(readings: str, guards: Guards) -> str:
    """CTEs of the sample sets in order of arrival: a sample leaves for good with the first later arrival more than a
    window ahead of it. ``value`` becomes the last value of a reading's set."""

    def pairs(name: str) -> str:
        return f"""
{name}_pairs AS (
  SELECT a.arrival_seq AS at_seq, b.measured_ms AS b_ms, b.value AS b_value,
         row_number() OVER (PARTITION BY a.arrival_seq ORDER BY b.measured_ms, b.pos) AS b_pos,
         lag(b.value) OVER (PARTITION BY a.arrival_seq ORDER BY b.measured_ms, b.pos) AS before,
         a.recipe_min AS low, a.recipe_max AS high
  FROM arrived a JOIN arrived b ON a.equipment_id = b.equipment_id AND a.sensor_id = b.sensor_id AND b.pos <= a.pos
  JOIN leaves l ON l.id = b.arrival_seq AND (l.{name}_leave IS NULL OR a.pos < l.{name}_leave)
),"""

    return f"""
r AS ({readings}),
known AS (
  SELECT *, lag(batch_id IGNORE NULLS) OVER s AS known_batch FROM r
  WINDOW s AS (PARTITION BY equipment_id, sensor_id ORDER BY arrival_seq)
),
arrived AS (
  SELECT *, row_number() OVER s AS pos,
         sum(CASE WHEN batch_id IS NOT NULL AND batch_id IS DISTINCT FROM known_batch THEN 1 ELSE 0 END)
           OVER (PARTITION BY equipment_id, sensor_id ORDER BY arrival_seq ROWS UNBOUNDED PRECEDING) AS batches
  FROM known
  WINDOW s AS (PARTITION BY equipment_id, sensor_id ORDER BY arrival_seq)
),
leaves AS (
  SELECT a.arrival_seq AS id,
         min(b.pos) FILTER (b.measured_ms > a.measured_ms + {guards.limit_ms}) AS limit_leave,
         min(b.pos) FILTER (b.measured_ms > a.measured_ms + {guards.trend_ms}) AS trend_leave
  FROM arrived a LEFT JOIN arrived b ON a.equipment_id = b.equipment_id AND a.sensor_id = b.sensor_id
   AND b.pos > a.pos
  GROUP BY a.arrival_seq
),
{pairs("limit")}
{_limit_stats()},
{pairs("trend")}
trend_stats AS (
  SELECT at_seq, count(*) AS samples, min(b_ms) AS start_ms, first(b_value ORDER BY b_pos) AS first_value,
         count(*) FILTER (b_value IS NOT NULL AND before IS NOT NULL) AS steps,
         count(*) FILTER (b_value > before) AS rises, count(*) FILTER (b_value < before) AS falls
  FROM trend_pairs GROUP BY at_seq
),
n AS (
  SELECT arrived.* REPLACE (s.last_value AS value) FROM arrived JOIN limit_stats s ON s.at_seq = arrived.arrival_seq
),"""


def _limit_stats() -> str:
    return """
limit_stats AS (
  SELECT at_seq, count(*) AS samples, min(b_ms) AS start_ms, count(b_value) AS valued,
         first(b_value ORDER BY b_pos) AS first_value, last(b_value ORDER BY b_pos) AS last_value,
         count(*) FILTER (b_value < low OR b_value > high) AS breaches,
         arg_max(b_value, b_pos) FILTER (b_value < low OR b_value > high) AS latest,
         count(*) FILTER (b_value > (low + high) / 2.0 + (high - low) * 0.167 * 2) AS far_above,
         count(*) FILTER (b_value < (low + high) / 2.0 - (high - low) * 0.167 * 2) AS far_below,
         count(*) FILTER (b_value > (low + high) / 2.0 + (high - low) * 0.167) AS some_above,
         count(*) FILTER (b_value < (low + high) / 2.0 - (high - low) * 0.167) AS some_below
  FROM limit_pairs GROUP BY at_seq
)"""


def _in_time(readings: str, guards: Guards) -> str:
    """CTEs: numbered samples, their gate, and the sets of both windows in order of time."""
    return f"""
r AS ({readings}),
known AS (
  SELECT *, lag(batch_id IGNORE NULLS) OVER s AS known_batch FROM r
  WINDOW s AS (PARTITION BY equipment_id, sensor_id ORDER BY measured_ms, arrival_seq)
),
n AS (
  SELECT *, row_number() OVER s AS pos,
         CASE WHEN value > lag(value) OVER s THEN 1 ELSE 0 END AS up,
         CASE WHEN value < lag(value) OVER s THEN 1 ELSE 0 END AS down,
         CASE WHEN value IS NOT NULL AND lag(value) OVER s IS NOT NULL THEN 1 ELSE 0 END AS step,
         sum(CASE WHEN batch_id IS NOT NULL AND batch_id IS DISTINCT FROM known_batch
                  THEN 1 ELSE 0 END)
           OVER (PARTITION BY equipment_id, sensor_id ORDER BY measured_ms, arrival_seq
                 ROWS UNBOUNDED PRECEDING) AS batches
  FROM known
  WINDOW s AS (PARTITION BY equipment_id, sensor_id ORDER BY measured_ms, arrival_seq)
),
limit_pairs AS (
  SELECT a.arrival_seq AS at_seq, b.measured_ms AS b_ms, b.value AS b_value, b.pos AS b_pos,
         a.recipe_min AS low, a.recipe_max AS high
  FROM n a JOIN n b ON a.equipment_id = b.equipment_id AND a.sensor_id = b.sensor_id
   AND b.measured_ms BETWEEN a.measured_ms - {guards.limit_ms} AND a.measured_ms
   AND b.pos <= a.pos
),
{_limit_stats()},
trend_stats AS (
  SELECT a.arrival_seq AS at_seq, count(*) AS samples, min(b.measured_ms) AS start_ms,
         first(b.value ORDER BY b.pos) AS first_value,
         sum(b.step) - arg_min(b.step, b.pos) AS steps,
         sum(b.up) - arg_min(b.up, b.pos) AS rises, sum(b.down) - arg_min(b.down, b.pos) AS falls
  FROM n a JOIN n b ON a.equipment_id = b.equipment_id AND a.sensor_id = b.sensor_id
   AND b.measured_ms BETWEEN a.measured_ms - {guards.trend_ms} AND a.measured_ms
   AND b.pos <= a.pos
  GROUP BY a.arrival_seq
),"""


def _windows(readings: str, gate: int, guards: Guards, arrival: bool = False) -> str:
    """CTEs from readings to the rows of all rules."""
    return f"""
{(_arrived if arrival else _in_time)(readings, guards)}
rule_1 AS (
  SELECT n.*, 'NELSON_RULE_1' AS rule_name, s.samples, s.start_ms,
         CASE WHEN breaches = 0 THEN 'NORMAL'
              WHEN breaches >= 3 THEN 'CRITICAL' ELSE 'CAUTION' END AS severity,
         CASE WHEN breaches = 0 THEN NULL
              WHEN latest > recipe_max THEN 'HIGH' ELSE 'LOW' END AS anomaly_type,
         latest AS measured_value,
         CASE WHEN breaches = 0 THEN NULL
              WHEN latest > recipe_max THEN recipe_max ELSE recipe_min END AS reference_value,
         CAST(breaches AS VARCHAR) AS breach_text
  FROM n JOIN limit_stats s ON s.at_seq = n.arrival_seq WHERE batches >= {gate}
),
rule_1_rows AS (
  SELECT *, abs(measured_value - reference_value) AS deviation,
         CASE WHEN severity = 'NORMAL' THEN NULL WHEN reference_value <> 0
              THEN abs(measured_value - reference_value) / reference_value * 100.0
              ELSE 0.0 END AS deviation_rate
  FROM rule_1
),
bias_share AS (
  SELECT n.*, s.samples, s.start_ms, (recipe_min + recipe_max) / 2.0 AS mean,
         (recipe_max - recipe_min) * 0.167 AS sigma,
         s.samples >= {guards.bias_samples} AND recipe_max > recipe_min AS usable,
         far_above / valued::DOUBLE AS fa, far_below / valued::DOUBLE AS fb,
         some_above / valued::DOUBLE AS sa, some_below / valued::DOUBLE AS sb
  FROM n JOIN limit_stats s ON s.at_seq = n.arrival_seq WHERE batches >= {gate}
),
bias_case AS (
  SELECT *, CASE WHEN usable IS NOT TRUE THEN 0 WHEN fa >= 0.8 THEN 1
                 WHEN fb >= 0.8 THEN 2 WHEN sa >= 0.8 THEN 3
                 WHEN sb >= 0.8 THEN 4 ELSE 0 END AS hit
  FROM bias_share
),
bias_rows AS (
  SELECT *, 'BIAS_RATIO_RULE' AS rule_name,
         CASE hit WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'CRITICAL' WHEN 2 THEN 'CRITICAL'
                  ELSE 'CAUTION' END AS severity,
         CASE hit WHEN 0 THEN NULL WHEN 1 THEN 'BIAS_UP' WHEN 3 THEN 'BIAS_UP'
                  ELSE 'BIAS_DOWN' END AS anomaly_type,
         CASE WHEN hit > 0 THEN value END AS measured_value,
         CASE hit WHEN 1 THEN mean + sigma * 2 WHEN 2 THEN mean - sigma * 2
                  WHEN 3 THEN mean + sigma WHEN 4 THEN mean - sigma END AS reference_value,
         abs(measured_value - reference_value) AS deviation,
         CASE hit WHEN 1 THEN fa WHEN 2 THEN fb WHEN 3 THEN sa WHEN 4 THEN sb END * 100.0
           AS deviation_rate
  FROM bias_case
),
trend_share AS (
  SELECT n.*, s.samples, s.start_ms, s.first_value,
         CASE WHEN steps > 0 THEN rises / steps::DOUBLE END AS rising,
         CASE WHEN steps > 0 THEN falls / steps::DOUBLE END AS falling,
         CASE WHEN s.first_value <> 0
              THEN abs((value - s.first_value) / s.first_value) * 100.0 END AS change
  FROM n JOIN trend_stats s ON s.at_seq = n.arrival_seq
),
trend_case AS (
  SELECT *, CASE WHEN samples >= {guards.trend_samples} AND change >= 5.0
                 THEN CASE WHEN rising >= 0.7 THEN 'TREND_UP'
                           WHEN falling >= 0.7 THEN 'TREND_DOWN' END
            END AS anomaly_type
  FROM trend_share
),
rule_3_rows AS (
  SELECT *, 'NELSON_RULE_3' AS rule_name,
         CASE WHEN anomaly_type IS NULL THEN 'NORMAL'
              WHEN recipe_max > recipe_min AND
                   CASE anomaly_type WHEN 'TREND_UP' THEN (value - recipe_min)
                        ELSE (recipe_max - value) END / (recipe_max - recipe_min)
                   >= 0.9 THEN 'CRITICAL' ELSE 'CAUTION' END AS severity,
         CASE WHEN anomaly_type IS NOT NULL THEN value END AS measured_value,
         CASE anomaly_type WHEN 'TREND_UP' THEN recipe_max WHEN 'TREND_DOWN' THEN recipe_min END
           AS reference_value,
         CASE WHEN anomaly_type IS NOT NULL THEN abs(value - first_value) END AS deviation,
         CASE WHEN anomaly_type IS NOT NULL THEN change END AS deviation_rate
  FROM trend_case
),
{_evaluations("arrival_seq" if arrival else "detected_ms, arrival_seq")}
"""


def _evaluations(order: str) -> str:
    columns = (
        "arrival_seq, equipment_id, sensor_id, sensor_type, rule_name, anomaly_type, severity,"
        " measured_value, reference_value, deviation, deviation_rate,"
        " CASE WHEN severity <> 'NORMAL' THEN recipe_min END AS min,"
        " CASE WHEN severity <> 'NORMAL' THEN recipe_max END AS max,"
        " measured_ms AS detected_ms, start_ms AS window_start_ms, measured_ms AS window_end_ms,"
        " CAST(samples AS INTEGER) AS sample_count"
    )
    reasons = {
        "rule_1_rows": _sentence(
            LIMIT_TEXT, "breach_text", _fixed("measured_value", 3), _fixed("reference_value", 3)
        ),
        "bias_rows": _sentence(BIAS_TEXT, _fixed("deviation_rate", 2)),
        "rule_3_rows": _sentence(
            TREND_TEXT,
            "CASE anomaly_type WHEN 'TREND_UP' THEN '증가' ELSE '감소' END",
            _fixed("CASE anomaly_type WHEN 'TREND_UP' THEN rising ELSE falling END", 2),
            _fixed("deviation_rate", 2),
        ),
    }
    recovery = _sentence(RECOVERY_TEXT, "rule_name")
    parts = [
        f"SELECT {columns}, CASE WHEN severity = 'NORMAL' THEN {recovery} ELSE {text} END AS reason"
        f" FROM {table}"
        for table, text in reasons.items()
    ]
    return (
        "evaluations AS (" + "\nUNION ALL\n".join(parts) + "),\n"
        "alerts AS (SELECT * EXCLUDE (last_severity) FROM (SELECT *, lag(severity) OVER"
        f" (PARTITION BY equipment_id, sensor_id, rule_name ORDER BY {order})"
        " AS last_severity FROM evaluations) WHERE severity IS DISTINCT FROM last_severity)"
    )


def _rules(
    select: str, readings: str = READINGS, gate: int = 5, guards: Guards = WIDE, arrival: bool = False
) -> str:
    return f"WITH {_windows(readings, gate, guards, arrival)}\n{select}"


def _one_rule(rule: str, readings: str = READINGS, gate: int = 0, arrival: bool = False) -> str:
    return _rules(f"SELECT * FROM evaluations WHERE rule_name = '{rule}'", readings, gate, arrival=arrival)


SHIFTING = f"""
SELECT * REPLACE (recipe_min + CAST(day(ts) % 3 AS DOUBLE) * 8.0 AS recipe_min,
                  CASE WHEN day(ts) % 5 <> 0 THEN recipe_max END AS recipe_max)
FROM ({READINGS})
"""
DENSE = f"""
SELECT * REPLACE (dense AS measured_ms, CAST(dense // 20000 AS VARCHAR) AS batch_id,
  CASE equipment_id WHEN 0 THEN 5.0::DOUBLE + 90.0::DOUBLE * phase WHEN 1 THEN 95.0::DOUBLE - 90.0::DOUBLE * phase
    WHEN 2 THEN 80.0::DOUBLE + arrival_seq % 5 + CASE WHEN sensor_id = 'click' THEN 10.0::DOUBLE ELSE 0.0::DOUBLE END
    ELSE CASE WHEN arrival_seq % 11 <> 0 THEN value END END AS value,
  CASE WHEN equipment_id = 3 THEN recipe_min ELSE CAST(0 AS DOUBLE) END AS recipe_min,
  CASE WHEN equipment_id = 3 THEN recipe_max ELSE CAST(100 AS DOUBLE) END AS recipe_max)
FROM (SELECT *, measured_ms // 5400 AS dense, ((measured_ms // 5400) % 120000) / 120000.0::DOUBLE AS phase
      FROM ({READINGS}))
"""
GAPPY = f"""
SELECT * REPLACE (CASE WHEN value >= 20 THEN batch_id END AS batch_id) FROM ({READINGS})
"""
SHUFFLED = f"""
SELECT * REPLACE ((arrival_seq + 40 * (arrival_seq * arrival_seq % 13)) * 1024 + arrival_seq % 1024 AS arrival_seq)
FROM ({READINGS})
"""
OWN_LIMITS = f"""
SELECT * REPLACE (CAST(0.3 AS DOUBLE) + (arrival_seq % 997) / 40.0::DOUBLE AS recipe_min,
                  CAST(220 AS DOUBLE) - (arrival_seq % 991) / 8.0::DOUBLE AS recipe_max)
FROM ({READINGS})
"""
LATE = f"""
SELECT equipment_id, sensor_id, count(*) AS readings, count(*) FILTER (late_ms > 0) AS late,
       count(*) FILTER (late_ms > {WIDE.limit_ms}) AS beyond_window, max(late_ms) AS latest_by_ms
FROM (SELECT *, max(measured_ms) OVER (PARTITION BY equipment_id, sensor_id ORDER BY arrival_seq
                                       ROWS UNBOUNDED PRECEDING) - measured_ms AS late_ms FROM ({SHUFFLED}))
GROUP BY equipment_id, sensor_id
"""
LIFE_MS = 30 * 86_400_000
KEPT_FOR_LIFE = f"""
WITH RECURSIVE lines AS (
  SELECT l_linestatus || '|' || o_custkey % 7 || '|' || l_linenumber || '|P' AS dedup_key, o_orderkey AS arrival_seq,
         first_value(epoch_ms(l_shipdate)) OVER w AS measured_ms, l_quantity AS value, row_number() OVER w AS line
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  WINDOW w AS (PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_shipdate, l_returnflag, 'P' || l_partkey, l_linestatus, l_quantity, l_suppkey)
), copies AS (
  SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY dedup_key, measured_ms ORDER BY arrival_seq, line) = 1
), kept AS (
  SELECT dedup_key, min(measured_ms) AS measured_ms FROM copies GROUP BY dedup_key
  UNION ALL
  SELECT c.dedup_key, min(c.measured_ms) FROM kept k JOIN copies c
    ON c.dedup_key = k.dedup_key AND c.measured_ms >= k.measured_ms + {LIFE_MS}
  GROUP BY c.dedup_key
)
SELECT dedup_key, measured_ms, arrival_seq, value FROM copies JOIN kept USING (dedup_key, measured_ms)
"""
EVENT_KEY = "equipment_id || ':' || sensor_type || ':' || severity || ':' || detected_ms"
ENVELOPE = _rules(
    f"SELECT {EVENT_KEY} AS idempotencyKey, 'SensorViolation' AS eventType,"
    " 'domain' AS envelopeType, 'Equipment' AS aggregateType,"
    " CAST(equipment_id AS VARCHAR) AS aggregateId, equipment_id AS equipmentId,"
    " sensor_id AS sensorId, sensor_type AS sensorType, rule_name AS ruleName,"
    " anomaly_type AS anomalyType, severity, measured_value AS measuredValue,"
    " reference_value AS referenceValue, deviation, deviation_rate AS deviationRate, min, max,"
    f" {_iso('detected_ms')} AS detectedAt, {_iso('window_start_ms')} AS windowStart,"
    f" {_iso('window_end_ms')} AS windowEnd, sample_count AS sampleCount, reason FROM alerts"
)
SENT = f"""
SELECT r.* REPLACE (arrival_seq * 3 + again AS arrival_seq)
FROM ({READINGS}) r CROSS JOIN (VALUES (0), (1)) AS copies(again) WHERE again = 0 OR arrival_seq % 50 = 0
"""
FAN_OUT = _rules(
    f"""SELECT 'storage' AS branch, batch_id || '|' || equipment_id || '|' || sequence || '|' || sensor_id AS item, value
        FROM ({READINGS})
        UNION ALL SELECT 'documents', equipment_id || '_' || sensor_id || '_' || measured_ms, value FROM ({READINGS})
        UNION ALL SELECT 'alerts', {EVENT_KEY} || ':' || sensor_id || ':' || rule_name, measured_value FROM alerts
        UNION ALL SELECT 'quarantine', (event_id * 3 + 2) || '|' ||
            left('{{"batchId":"' || strftime(ts, '%Y-%m-%d') || '","deviceId":"D' || user_id % 4 || '","id":0', 40), NULL
        FROM events WHERE event_id % 90 = 0""",
    SENT,
)
def _latest_daily(unit: str = "unit") -> str:
    return f"""
SELECT * EXCLUDE (age) FROM (
  SELECT {DAILY}, {unit} AS unit,
         row_number() OVER (PARTITION BY equipment_id, sensor_id, created_ms
                            ORDER BY {{order}} arrival_seq DESC) AS age
  FROM ({READINGS})
) WHERE age = 1
"""


def _trailing(window: str) -> str:
    return _rules(
        "SELECT n.arrival_seq, n.equipment_id, n.sensor_id, n.measured_ms,"
        " s.start_ms AS window_start_ms, n.measured_ms AS window_end_ms,"
        " CAST(s.samples AS INTEGER) AS sample_count, s.first_value, n.value AS last_value"
        f" FROM n JOIN {window}_stats s ON s.at_seq = n.arrival_seq"
    )


_good, _quoted = (ORDER_READINGS.format(prefix=p) for p in ("'B'", "'Q'"))
_document = DOCUMENT.format(measured="measured_ms") + ", unit"
_latest = _latest_daily().format(order="")
_stored = f"SELECT {STORED}, {PARTITION} FROM ({READINGS})"
_evaluated = _rules("SELECT * FROM evaluations")
_alerted = _rules("SELECT * FROM alerts")

ORACLES: dict[str, str] = {
    "flatten_nested": _good,
    "flatten_gaps": f"""
        SELECT g.* REPLACE (
          CASE WHEN g.sequence % 3 <> 0 THEN g.measured_ms ELSE g.created_ms END AS measured_ms,
          CASE WHEN g.equipment_id % 5 <> 0 THEN g.created_ms ELSE 0 END AS created_ms)
        FROM ({_good}) g CROSS JOIN (VALUES (1), (2)) AS twice(n)
        WHERE g.sequence NOT IN (4, 6) AND NOT (g.sequence % 3 = 0 AND g.equipment_id % 5 = 0)""",
    "parse_json_batches": f"{_good} UNION ALL {_quoted}",
    "quarantine_messages": """
        SELECT kind, o_orderkey AS order_key
        FROM orders CROSS JOIN (VALUES ('cut'), ('mistyped'), ('zoneless')) AS kinds(kind)
        WHERE kind <> 'mistyped' OR o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
    "reading_keys": f"""
        SELECT event_id AS arrival_seq,
          strftime(ts, '%Y-%m-%d') || '|' || CASE WHEN user_id % 4 <> 3 THEN user_id % 4 || '' ELSE '' END
            || '|' || CASE WHEN value < 50 THEN event_id || '' ELSE 'null' END
            || '|' || CASE WHEN event_type <> 'view' THEN event_type ELSE '' END AS dedup_key,
          CASE WHEN user_id % 4 <> 3 THEN user_id % 4 || '' ELSE '' END || '_'
            || CASE WHEN event_type <> 'view' THEN event_type ELSE '' END || '_' || epoch_us(ts) // 1000
            AS document_id,
          CASE WHEN user_id % 4 <> 3 THEN user_id % 4 || '' ELSE 'null' END || ':'
            || CASE WHEN event_type <> 'view' THEN event_type ELSE 'null' END AS stream_key,
          token AS device_token, strftime(ts, '%Y/%m/%d') || '/' || token AS bucket_path,
          {_iso('(epoch_us(ts) // 1000)')} AS measured_text
        FROM (SELECT *, CASE WHEN event_id % 5 < 3 THEN 'unknown'
                ELSE regexp_replace(props, '[^A-Za-z0-9._-]', '_', 'g') END AS token FROM events)""",
    "reading_events": f"""
        SELECT batch_id, equipment_id, sensor_id, sensor_type, value, recipe_min, recipe_max,
               measured_ms, arrival_seq FROM ({READINGS})""",
    "document_rows": f"SELECT {_document} FROM ({READINGS})",
    "flatten_documents": f"SELECT {_document} FROM ({_good})",
    "storage_rows": f"SELECT {STORED} FROM ({READINGS})",
    "dedup_ttl": KEPT_FOR_LIFE,
    "dedup_first": f"SELECT {DAY_KEY}, arrival_seq, value FROM ({FIRST_COPIES})",
    "storage_partition": f"""
        SELECT {STORED.replace(' sequence,', ' day_no AS sequence,')}, {PARTITION}
        FROM ({FIRST_COPIES})""",
    "document_latest": _latest,
    "document_upserts": _latest_daily("CASE WHEN value >= 100 THEN 'F' ELSE unit END").format(
        order="CASE WHEN value >= 100 THEN 0 ELSE 1 END,"
    ),
    "document_restarts": _latest_daily().format(order="CASE WHEN value >= 50 THEN 0 ELSE 1 END,"),
    "document_compacted": _latest_daily().format(order="arrival_seq % 12 DESC,"),
    "rejected_documents": f"""
        WITH given AS (
          SELECT equipment_id || '_' || sensor_id || '_' || measured_ms AS document_id,
                 day(ts) % 7 = 0 OR day(ts) % 11 = 0 AS rejected FROM ({READINGS}))
        SELECT DISTINCT document_id, rejected FROM given WHERE NOT rejected
        UNION ALL SELECT document_id, rejected FROM given WHERE rejected""",
    "batch_gate": _rules(
        "SELECT arrival_seq, CAST(batches AS INTEGER) AS batch_count,"
        f" batches >= {WIDE.batches} AS gate_open FROM n",
        GAPPY,
    ),
    "trailing_5m": _trailing("limit"),
    "trailing_1m": _trailing("trend"),
    "rule1": _one_rule("NELSON_RULE_1"),
    "rule3": _one_rule("NELSON_RULE_3"),
    "bias": _one_rule("BIAS_RATIO_RULE"),
    "rule1_shifting_limits": _one_rule("NELSON_RULE_1", SHIFTING, 5),
    "bias_shifting_limits": _one_rule("BIAS_RATIO_RULE", SHIFTING, 5),
    "rules_default": _rules("SELECT * FROM evaluations", DENSE, 5, CONTRACT),
    "evaluations": _evaluated,
    "alerts": _alerted,
    "evaluations_arrival": _rules("SELECT * FROM evaluations", SHUFFLED, arrival=True),
    "alerts_arrival": _rules("SELECT * FROM alerts", SHUFFLED, arrival=True),
    "rule1_arrival": _one_rule("NELSON_RULE_1", SHUFFLED, arrival=True),
    "rule3_arrival": _one_rule("NELSON_RULE_3", SHUFFLED, arrival=True),
    "rule1_own_limits": _one_rule("NELSON_RULE_1", OWN_LIMITS),
    "bias_own_limits": _one_rule("BIAS_RATIO_RULE", OWN_LIMITS),
    "late_readings": LATE,
    "severity_transitions": f"""
        SELECT * EXCLUDE (last_severity) FROM (
          SELECT *, lag(severity) OVER (PARTITION BY equipment_id, sensor_id
                                        ORDER BY detected_ms, arrival_seq) AS last_severity
          FROM (SELECT equipment_id, sensor_id, 'NELSON_RULE_1' AS rule_name,
                  CASE WHEN value >= 100 THEN 'CRITICAL' WHEN value >= 40 THEN 'CAUTION'
                       WHEN value >= 10 THEN 'NORMAL' END AS severity,
                  measured_ms AS detected_ms, arrival_seq FROM ({READINGS}))
        ) WHERE severity IS DISTINCT FROM last_severity""",
    "alert_envelope": ENVELOPE,
    "alert_envelope_files": ENVELOPE,
    "alert_keys": _rules(
        f"SELECT {EVENT_KEY} AS event_key,"
        f" {EVENT_KEY} || ':' || sensor_id || ':' || rule_name AS full_key FROM alerts"
    ),
    "stream_ingest": f"{_good} UNION ALL {_quoted}",
    "stream_dedup": f"SELECT {DAY_KEY}, arrival_seq, value FROM ({FIRST_COPIES})",
    "stream_parquet": _stored,
    "stream_upsert": _latest,
    "stream_evaluations": _evaluated,
    "stream_alerts": _alerted,
    "stream_alert_files": ENVELOPE,
    "stream_fan_out": FAN_OUT,
}
