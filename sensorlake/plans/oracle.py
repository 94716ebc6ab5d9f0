"""DuckDB SQL that states, independently of Spark, what each query returns.

The common table expressions mirror the adapter in
``sensorlake.sources.driver_tables`` and the operators' contracts.
"""

from sensorlake.constants import ACCEPTED_SENSOR_TYPES, EUROPE_COUNTRIES, INVALID_SENSOR_TYPES, SEED_CUSTOMERS
from sensorlake.schemas import BRONZE as BRONZE_SCHEMA
from sensorlake.sources.driver_tables import NATION_COUNTRY

_COUNTRIES = "[" + ", ".join(f"'{c}'" for c in NATION_COUNTRY) + "]"
_EUROPE = ", ".join(f"'{c}'" for c in EUROPE_COUNTRIES)
_INVALID = ", ".join(f"'{t}'" for t in INVALID_SENSOR_TYPES)


def avg_exact(x: str) -> str:
    plain = f"NOT isnan({x}) AND abs({x}) < 1e21"
    mean = (f"((COALESCE(CAST(SUM(CASE WHEN {plain} THEN CAST({x} AS DECIMAL(28,6)) END) AS DOUBLE), 0) "
            f"+ COALESCE(SUM(CASE WHEN NOT ({plain}) THEN {x} END), 0)) / NULLIF(COUNT({x}), 0))")
    return (f"(CASE WHEN isnan({mean}) OR abs({mean}) >= 1e15 THEN {mean} "
            f"ELSE CAST(ROUND(CAST({mean} AS DECIMAL(28,6)), 3) AS DOUBLE) END)")


def parse_ts(x: str) -> str:
    return (f"(CASE WHEN regexp_matches({x}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') "
            f"THEN TRY_CAST({x} AS TIMESTAMPTZ) AT TIME ZONE 'UTC' END)")


def json_num(v: str, key: str) -> str:
    return f"(CASE WHEN json_valid({v}) THEN TRY_CAST(json_extract_string({v}, '$.{key}') AS DOUBLE) END)"


DELIVERIES = """
deliveries AS (
    SELECT event_id, ts, user_id, event_type, value, props, ts AS arrival,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events
    UNION ALL
    SELECT event_id, ts, user_id, event_type, value, props, ts + INTERVAL 1 MINUTE AS arrival,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events WHERE event_id % 10 = 3
)"""

READINGS = f"""
readings AS (
    SELECT
        CASE WHEN event_id % 97 <> 0 THEN CAST(event_id AS VARCHAR) END AS reading_id,
        CAST(user_id AS BIGINT) AS sensor_id,
        CASE WHEN event_id % 83 = 2 THEN 'test' ELSE event_type END AS sensor_type,
        CASE WHEN event_id % 89 = 1 THEN
                 (CASE WHEN event_id % 2 = 0 THEN 'garbage' ELSE '2024-13-45T00:00:00+00:00' END)
             ELSE strftime(arrival, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS ingested_at,
        CAST((user_id * 37) % 170 - 85 AS DOUBLE) AS latitude,
        CAST((user_id * 53) % 360 - 180 AS DOUBLE) AS longitude,
        {_COUNTRIES}[CAST(user_id % 25 AS INTEGER) + 1] AS country,
        CASE WHEN event_id % 307 = 11 THEN '{{"P1": "NaN", "P2": 3}}'
             WHEN event_id % 311 = 12 THEN '{{"P1": "Infinity", "temperature": "-Infinity", "humidity": 5}}'
             WHEN event_id % 313 = 13 THEN '{{"P1": "2500000000000.5", "P2": "4e24", "temperature": "1e300", "pressure": "NaN"}}'
             WHEN event_type IN ('view', 'click') THEN
                 '{{"P1": ' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) || ', "P2": ' || CAST(k AS VARCHAR) || '}}'
             WHEN event_type IN ('purchase', 'signup') THEN
                 '{{"temperature": ' || CAST(CAST(value - 20 AS DECIMAL(12,2)) AS VARCHAR)
                 || ', "humidity": ' || CAST(k AS VARCHAR)
                 || ', "pressure": ' || CAST(100000 + k * 500 AS VARCHAR) || '}}'
             ELSE '{{"P1": "n/a", "pressure": "'
                 || CASE WHEN k % 7 = 0 THEN 'NaN' ELSE CAST(100000 + k * 500 AS VARCHAR) END || '"}}'
        END AS "values",
        arrival,
        event_id
    FROM deliveries
)"""

BRONZE = """
bronze AS (
    SELECT reading_id, sensor_id, sensor_type, ingested_at, latitude, longitude, country, "values",
           strftime(arrival, '%Y') AS year, strftime(arrival, '%m') AS month,
           strftime(arrival, '%d') AS day, strftime(arrival, '%H') AS hour
    FROM readings
)"""

CLASSIFIED = f"""
classified AS (
    SELECT *,
        CASE WHEN reading_id IS NULL THEN 'null_reading_id'
             WHEN ts_parsed IS NULL THEN 'unparseable_ingested_at'
             WHEN sensor_type IS NULL OR sensor_type IN ({_INVALID}) THEN 'invalid_sensor_type'
        END AS rejection_reason
    FROM (SELECT *, {parse_ts('ingested_at')} AS ts_parsed FROM bronze)
),
typed AS (
    SELECT reading_id, sensor_id, sensor_type, ts_parsed AS ingested_at, latitude, longitude, country,
        {json_num('"values"', 'P1')} AS pm25,
        {json_num('"values"', 'P2')} AS pm10,
        {json_num('"values"', 'temperature')} AS temperature,
        {json_num('"values"', 'humidity')} AS humidity,
        {json_num('"values"', 'pressure')} AS pressure,
        {json_num('"values"', 'pressure_at_sealevel')} AS pressure_at_sealevel,
        rejection_reason
    FROM classified
)"""

DEDUP_ORDER = ", ".join(f"{c} NULLS LAST" for c in (
    "ingested_at", "sensor_id", "sensor_type", "country", "pm25", "pm10", "temperature", "humidity",
    "pressure", "pressure_at_sealevel", "latitude", "longitude"))

SILVER_COLS = ("reading_id, sensor_id, sensor_type, ingested_at, latitude, longitude, country, "
               "pm25, pm10, temperature, humidity, pressure, pressure_at_sealevel")

SILVER = f"""
silver AS (
    SELECT {SILVER_COLS} FROM typed WHERE rejection_reason IS NULL
    QUALIFY ROW_NUMBER() OVER (PARTITION BY reading_id ORDER BY {DEDUP_ORDER}) = 1
)"""

DIMS = f"""
dim_customers AS (
    SELECT CAST(n_nationkey AS INTEGER) AS customer_id, n_name AS customer_name, r_name AS region
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
),
dim_sensors AS (
    SELECT CAST(s_suppkey AS BIGINT) AS sensor_id,
           CASE WHEN s_suppkey % 2 = 0 THEN 'SDS011' ELSE 'BME280' END AS sensor_type,
           CAST((s_suppkey * 37) % 170 - 85 AS DOUBLE) AS latitude,
           CAST((s_suppkey * 53) % 360 - 180 AS DOUBLE) AS longitude,
           {_COUNTRIES}[CAST(s_nationkey % 25 AS INTEGER) + 1] AS country,
           dc.region AS region,
           CAST(s_nationkey AS INTEGER) AS customer_id
    FROM supplier LEFT JOIN dim_customers dc ON s_nationkey = dc.customer_id
)"""

ENRICHED = """
enriched AS (
    SELECT f.reading_id, f.sensor_id, f.sensor_type, f.ingested_at, f.latitude, f.longitude,
           COALESCE(ds.country, f.country) AS country,
           f.pm25, f.pm10, f.temperature, f.humidity, f.pressure, f.pressure_at_sealevel,
           ds.customer_id AS customer_id,
           COALESCE(dc.customer_name, 'Unknown') AS customer_name,
           COALESCE(dc.region, 'Unknown') AS region
    FROM silver f
    LEFT JOIN dim_sensors ds ON f.sensor_id = ds.sensor_id
    LEFT JOIN dim_customers dc ON ds.customer_id = dc.customer_id
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = with_ctes(DELIVERIES, READINGS, BRONZE, CLASSIFIED, SILVER, DIMS, ENRICHED)


def gold_sql(source: str = "enriched") -> dict[str, str]:
    return {
        "pm25": f"""
SELECT date_trunc('hour', ingested_at) AS hour, country, region, customer_name,
       COUNT(*) AS reading_count,
       {avg_exact('pm25')} AS avg_pm25, ROUND(MAX(pm25), 3) AS max_pm25, ROUND(MIN(pm25), 3) AS min_pm25,
       {avg_exact('pm10')} AS avg_pm10, ROUND(MAX(pm10), 3) AS max_pm10
FROM {source} WHERE pm25 IS NOT NULL
GROUP BY 1, 2, 3, 4""",
        "temperature": f"""
SELECT date_trunc('day', ingested_at) AS day, region, customer_name, sensor_type,
       COUNT(*) AS reading_count,
       {avg_exact('temperature')} AS avg_temperature, ROUND(MAX(temperature), 3) AS max_temperature,
       ROUND(MIN(temperature), 3) AS min_temperature,
       {avg_exact('humidity')} AS avg_humidity, {avg_exact('pressure')} AS avg_pressure
FROM {source} WHERE temperature IS NOT NULL
GROUP BY 1, 2, 3, 4""",
        "activity": f"""
SELECT date_trunc('day', ingested_at) AS day, customer_name, region, sensor_type,
       COUNT(DISTINCT sensor_id) AS active_sensors, COUNT(*) AS total_readings,
       ROUND(COUNT(*) / COUNT(DISTINCT sensor_id), 1) AS avg_readings_per_sensor
FROM {source}
GROUP BY 1, 2, 3, 4""",
    }


GOLD = gold_sql()

ORDERS = {
    "pm25": " ORDER BY hour DESC, avg_pm25 DESC",
    "temperature": " ORDER BY day DESC, region, sensor_type",
    "activity": " ORDER BY day DESC, total_readings DESC",
}


def base_queries() -> dict[str, str]:
    out = {}
    for name, sql in GOLD.items():
        out[f"gold_{name}"] = BASE + sql
        out[f"gold_{name}_sorted"] = BASE + sql + ORDERS[name]
    out["silver_readings"] = BASE + "SELECT * FROM silver"
    out["silver_unfiltered"] = BASE + f"""
SELECT {SILVER_COLS} FROM typed
QUALIFY ROW_NUMBER() OVER (PARTITION BY reading_id ORDER BY {DEDUP_ORDER}) = 1"""
    out["rejected_readings"] = BASE + """
SELECT reading_id, sensor_id, sensor_type, ingested_at AS raw_ingested_at, country,
       "values" AS raw_values, rejection_reason
FROM classified WHERE rejection_reason IS NOT NULL"""
    out["enriched_readings"] = BASE + "SELECT * FROM enriched"
    return out


# ------------------------------------------------------------ messages, decode, alerts

MESSAGES = """
messages AS (
    SELECT CASE WHEN event_id % 67 = 8 THEN '' ELSE CAST(sensor_id AS VARCHAR) END AS key,
           CASE WHEN event_id % 101 = 7 THEN 'corrupt:' || CAST(event_id AS VARCHAR)
           WHEN event_id % 103 = 8 THEN CASE WHEN event_id % 2 = 0 THEN '[1]' ELSE '42' END ELSE
           '{' || CASE WHEN reading_id IS NOT NULL THEN '"reading_id": "' || reading_id || '", ' ELSE '' END
           || CASE WHEN event_id % 67 = 8 THEN ''
                   WHEN event_id % 59 = 9 THEN '"sensor_id": "abc", '
                   WHEN event_id % 109 = 10 THEN '"sensor_id": "0", '
                   WHEN event_id % 71 = 4 THEN '"sensor_id": "' || CAST(sensor_id AS VARCHAR) || '", '
                   ELSE '"sensor_id": ' || CAST(sensor_id AS VARCHAR) || ', ' END
           || '"sensor_type": "' || sensor_type || '", '
           || '"ingested_at": "' || ingested_at || '", '
           || CASE WHEN event_id % 73 = 10 THEN '"latitude": "unknown", ' ELSE '"latitude": ' || CAST(latitude AS VARCHAR) || ', ' END
           || '"longitude": ' || CAST(longitude AS VARCHAR) || ', '
           || CASE WHEN event_id % 61 = 5 THEN '"country": null' ELSE '"country": "' || country || '"' END
           || CASE WHEN event_id % 53 = 6 THEN '' WHEN event_id % 107 = 9 THEN ', "values": "abc"' ELSE ', "values": ' || "values" END
           || '}' END AS value,
           arrival AS "timestamp", event_id
    FROM readings
),
msg_json AS (
    SELECT key, value, "timestamp" FROM messages WHERE json_valid(value) AND json_type(value) = 'OBJECT'
),
msg_fields AS (
    SELECT key, value, "timestamp",
        json_extract_string(value, '$.reading_id') AS reading_id,
        CASE WHEN json_type(value, '$.sensor_id') IS NULL OR json_type(value, '$.sensor_id') = 'NULL' THEN 0
             ELSE TRY_CAST(json_extract_string(value, '$.sensor_id') AS BIGINT) END AS sensor_id,
        (json_type(value, '$.sensor_id') IS NOT NULL AND json_type(value, '$.sensor_id') <> 'NULL'
             AND TRY_CAST(json_extract_string(value, '$.sensor_id') AS BIGINT) IS NULL) AS bad_sensor_id,
        COALESCE(json_extract_string(value, '$.sensor_type'), '') AS sensor_type,
        COALESCE(json_extract_string(value, '$.ingested_at'), '') AS ingested_at,
        CASE WHEN json_type(value, '$.latitude') IS NULL OR json_type(value, '$.latitude') = 'NULL' THEN 0.0
             ELSE TRY_CAST(json_extract_string(value, '$.latitude') AS DOUBLE) END AS latitude,
        CASE WHEN json_type(value, '$.longitude') IS NULL OR json_type(value, '$.longitude') = 'NULL' THEN 0.0
             ELSE TRY_CAST(json_extract_string(value, '$.longitude') AS DOUBLE) END AS longitude,
        COALESCE(json_extract_string(value, '$.country'), '') AS country,
        COALESCE(CASE WHEN json_type(value, '$.values') <> 'NULL' THEN CAST(json_extract(value, '$.values') AS VARCHAR) END, '{}') AS "values"
    FROM msg_json
),
dbronze AS (
    SELECT reading_id, sensor_id, sensor_type, ingested_at, latitude, longitude, country, "values",
           strftime("timestamp", '%Y') AS year, strftime("timestamp", '%m') AS month,
           strftime("timestamp", '%d') AS day, strftime("timestamp", '%H') AS hour,
           "timestamp" AS arrival
    FROM msg_fields WHERE NOT bad_sensor_id AND latitude IS NOT NULL AND longitude IS NOT NULL
),
dead AS (
    SELECT value AS raw_value, "timestamp",
           CASE WHEN NOT json_valid(value) THEN 'invalid_json' ELSE 'not_a_json_object' END AS reason
    FROM messages WHERE NOT json_valid(value) OR json_type(value) <> 'OBJECT'
    UNION ALL
    SELECT value, "timestamp",
           CASE WHEN bad_sensor_id THEN 'uncastable_sensor_id'
                WHEN latitude IS NULL THEN 'uncastable_latitude' ELSE 'uncastable_longitude' END
    FROM msg_fields WHERE bad_sensor_id OR latitude IS NULL OR longitude IS NULL
),
lookup AS (
    SELECT ds.sensor_id, c.customer_id, c.customer_name, c.region AS customer_region
    FROM dim_sensors ds JOIN dim_customers c ON ds.customer_id = c.customer_id
),
alert_src AS (
    SELECT TRY_CAST(json_extract_string(value, '$.sensor_id') AS BIGINT) AS sensor_id,
           json_extract_string(value, '$.reading_id') AS reading_id,
           """ + json_num("value", "values.pressure") + """ AS pressure,
           TRY_CAST(json_extract_string(value, '$.latitude') AS DOUBLE) AS latitude,
           TRY_CAST(json_extract_string(value, '$.longitude') AS DOUBLE) AS longitude,
           json_extract_string(value, '$.latitude') AS lat_text, json_extract_string(value, '$.longitude') AS lon_text,
           value, "timestamp" AS arrival
    FROM msg_json WHERE TRY_CAST(json_extract_string(value, '$.sensor_id') AS BIGINT) IS NOT NULL
),
breaches AS (
    SELECT b.*, l.customer_id, COALESCE(l.customer_name, 'Unknown') AS customer_name,
           COALESCE(l.customer_region, 'Unknown') AS region
    FROM alert_src b LEFT JOIN lookup l ON b.sensor_id = l.sensor_id
    WHERE b.pressure IS NOT NULL AND NOT isnan(b.pressure) AND b.pressure > 130000
),
pressure_log AS (
    SELECT sensor_id, reading_id, 'pressure_threshold_exceeded' AS alert_type,
           CAST(json_object('pressure', pressure, 'threshold', 130000.0,
                            'latitude', CASE WHEN latitude IS NULL THEN to_json(lat_text) ELSE to_json(latitude) END,
                            'longitude', CASE WHEN longitude IS NULL THEN to_json(lon_text) ELSE to_json(longitude) END,
                            'customer_id', customer_id,
                            'customer_name', customer_name, 'region', region) AS VARCHAR) AS payload,
           arrival AS created_at,
           '[ALERT] Pressure threshold exceeded: sensor_id=' || CAST(sensor_id AS VARCHAR)
           || ' pressure=' || printf('%.1f', pressure) || 'Pa (limit=130000Pa) customer=' || customer_name
           || ' region=' || region || ' location=(' || COALESCE(CAST(latitude AS VARCHAR), lat_text) || ', '
           || COALESCE(CAST(longitude AS VARCHAR), lon_text) || ')' AS message
    FROM breaches
)"""


def unregistered_cte(name: str, where: str) -> str:
    return f"""
{name} AS (
    SELECT sensor_id, 'unregistered_device' AS alert_type,
           CAST(json_object('sensor_id', sensor_id, 'country', country, 'latitude', latitude,
                            'longitude', longitude, 'sensor_type', sensor_type, 'source', 'gold_build') AS VARCHAR) AS payload,
           first_seen AS created_at
    FROM (
        SELECT f.*, MIN(f.ingested_at) OVER (PARTITION BY f.sensor_id) AS first_seen,
               ROW_NUMBER() OVER (PARTITION BY f.sensor_id ORDER BY f.country NULLS FIRST, f.latitude NULLS FIRST,
                                  f.longitude NULLS FIRST, f.sensor_type NULLS FIRST) AS rn
        FROM silver f
        WHERE NOT EXISTS (SELECT 1 FROM dim_sensors ds WHERE ds.sensor_id = f.sensor_id) AND {where}
    ) WHERE rn = 1
)"""


ALERT_CTES = ("," + MESSAGES + "," + unregistered_cte("unreg_first", "f.ingested_at < TIMESTAMP '2024-01-01 06:00:00'")
              + "," + unregistered_cte("unreg_all", "TRUE") + """,
unreg_new AS (
    SELECT * FROM unreg_all a WHERE NOT EXISTS (SELECT 1 FROM unreg_first f WHERE f.sensor_id = a.sensor_id)
),
alert_log AS (
    SELECT sensor_id, CAST(NULL AS VARCHAR) AS reading_id, alert_type, payload, created_at FROM unreg_first
    UNION ALL
    SELECT sensor_id, CAST(NULL AS VARCHAR), alert_type, payload, created_at FROM unreg_new
    UNION ALL
    SELECT sensor_id, reading_id, alert_type, payload, created_at FROM pressure_log
),
feed AS (
    SELECT sensor_id, reading_id, alert_type, created_at,
           CASE WHEN alert_type = 'pressure_threshold_exceeded'
                THEN 'pressure=' || COALESCE(json_extract_string(payload, '$.pressure'), '?')
                     || 'Pa  customer=' || COALESCE(json_extract_string(payload, '$.customer_name'), 'Unknown')
                ELSE 'sensor_type=' || COALESCE(json_extract_string(payload, '$.sensor_type'), '?') END AS detail
    FROM alert_log
)""")

ABASE = BASE.rstrip().rstrip("\n") + ALERT_CTES + "\n"


def alert_queries() -> dict[str, str]:
    return {
        "bronze_decode": ABASE + """SELECT reading_id, sensor_id, sensor_type, ingested_at, latitude, longitude,
            country, "values", year, month, day, hour FROM dbronze""",
        "dead_letter": ABASE + "SELECT raw_value, \"timestamp\", reason FROM dead",
        "rekey": ABASE + """SELECT CASE WHEN json_type(value, '$.sensor_id') IS NULL OR json_type(value, '$.sensor_id') = 'NULL'
                 OR (json_type(value, '$.sensor_id') <> 'VARCHAR' AND json_extract_string(value, '$.sensor_id') = '0') THEN ''
                 ELSE json_extract_string(value, '$.sensor_id') END AS key, value
            FROM msg_json""",
        "alert_feed_resumed": ABASE + """SELECT * FROM feed WHERE created_at >
            (SELECT MAX(created_at) FROM alert_log WHERE created_at <= TIMESTAMP '2024-01-20 00:00:00')""",
        "pressure_alerts": ABASE + """SELECT sensor_id, reading_id, alert_type, payload, created_at,
            CAST(json_extract_string(payload, '$.pressure') AS DOUBLE) AS pressure,
            json_extract_string(payload, '$.customer_name') AS customer_name,
            json_extract_string(payload, '$.region') AS region FROM pressure_log""",
        "alert_messages": ABASE + "SELECT sensor_id, reading_id, created_at, message FROM pressure_log",
        "unregistered_sensors": ABASE + """SELECT DISTINCT f.sensor_id, f.country, f.latitude, f.longitude, f.sensor_type
            FROM silver f LEFT JOIN dim_sensors ds ON f.sensor_id = ds.sensor_id WHERE ds.sensor_id IS NULL""",
        "new_unregistered_alerts": ABASE + "SELECT sensor_id, alert_type, payload, created_at FROM unreg_new",
        "alert_feed": ABASE + "SELECT * FROM feed WHERE created_at > TIMESTAMP '2024-01-20 00:00:00'",
        "alert_feed_latest": ABASE + """SELECT * FROM feed ORDER BY created_at DESC, alert_type DESC, sensor_id DESC,
            reading_id DESC NULLS LAST LIMIT 30""",
        "stage_counts": ABASE.replace("silver AS (", "silver AS (", 1) + """
SELECT 'messages_in' AS stage, COUNT(*) AS row_count FROM messages
UNION ALL SELECT 'bronze_rows', COUNT(*) FROM dbronze
UNION ALL SELECT 'rejected', COUNT(*) FROM dbronze WHERE reading_id IS NULL
    OR """ + parse_ts('ingested_at') + """ IS NULL OR sensor_type IS NULL OR sensor_type IN ('', 'test')
UNION ALL SELECT 'dead_letter', COUNT(*) FROM dead
UNION ALL SELECT 'silver_rows', COUNT(DISTINCT reading_id) FROM dbronze WHERE reading_id IS NOT NULL
    AND """ + parse_ts('ingested_at') + """ IS NOT NULL AND sensor_type IS NOT NULL AND sensor_type NOT IN ('', 'test')
UNION ALL SELECT 'pressure_alerts', COUNT(*) FROM alert_log WHERE alert_type <> 'unregistered_device'
UNION ALL SELECT 'unregistered_alerts', COUNT(*) FROM alert_log WHERE alert_type = 'unregistered_device'""",
    }


# ------------------------------------------------------------------- registry

_SNAP_TYPES = "['SDS011', 'BME280', 'DHT22', 'SPS30', 'PMS5003']"

SNAPSHOT = f"""
snap_src AS (
    SELECT s_suppkey AS sid, s_nationkey, s_acctbal, 0 AS c FROM supplier
    UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal, 1 FROM supplier WHERE s_suppkey % 7 = 0
    UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal, 2 FROM supplier WHERE s_suppkey % 23 = 11
),
snap_items AS (
    SELECT *, [
        {{'value_type': 'P1', 'value': CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR), 'keep': true}},
        {{'value_type': 'P2', 'value': CASE WHEN sid % 13 = 0 THEN 'n/a' ELSE CAST(sid % 50 AS VARCHAR) END, 'keep': true}},
        {{'value_type': 'temperature', 'value': CAST(sid % 35 AS VARCHAR), 'keep': true}},
        {{'value_type': 'P1', 'value': '42.5', 'keep': sid % 17 = 10}},
        {{'value_type': '', 'value': '5', 'keep': sid % 11 = 1}},
        {{'value_type': 'humidity', 'value': CAST(NULL AS VARCHAR), 'keep': sid % 11 = 1}}
    ] AS items FROM snap_src
),
snap AS (
    SELECT CAST(sid * 10 + c AS BIGINT) AS id,
        CASE WHEN c = 1 THEN '2024-01-30T08:00:00'
             ELSE '2024-01-31T' || lpad(CAST(sid % 24 AS VARCHAR), 2, '0') || ':00:00' END AS "timestamp",
        CASE WHEN sid % 41 <> 3 THEN CAST(sid AS BIGINT) END AS sensor_id,
        CASE WHEN c = 2 THEN 'SEN5x' WHEN sid % 37 = 4 THEN NULL
             ELSE {_SNAP_TYPES}[CAST(sid % 5 AS INTEGER) + 1] END AS type_name,
        CASE WHEN sid % 29 = 5 AND c = 0 THEN '999' WHEN sid % 31 = 6 THEN 'not_a_number'
             ELSE CAST(CAST((sid * 37) % 170 - 85 AS DOUBLE) + c AS VARCHAR) END AS lat_text,
        CASE WHEN sid % 43 = 7 THEN '999' ELSE CAST(CAST((sid * 53) % 360 - 180 AS DOUBLE) AS VARCHAR) END AS lon_text,
        CASE WHEN sid % 47 = 8 THEN NULL ELSE {_COUNTRIES}[CAST(s_nationkey % 25 AS INTEGER) + 1] END AS country,
        CASE WHEN sid % 19 = 9 THEN [] ELSE
            list_transform(list_filter(items, lambda e: e.keep), lambda e: {{'value_type': e.value_type, 'value': e.value}}) END AS sdv
    FROM snap_items
),
latest AS (
    SELECT * FROM snap WHERE sensor_id IS NOT NULL
    QUALIFY ROW_NUMBER() OVER (PARTITION BY sensor_id ORDER BY COALESCE("timestamp", '') DESC, id DESC) = 1
),
prof AS (
    SELECT sensor_id AS id, COALESCE(type_name, 'unknown') AS sensor_type,
           TRY_CAST(lat_text AS DOUBLE) AS latitude, TRY_CAST(lon_text AS DOUBLE) AS longitude,
           COALESCE(country, '') AS country, sdv
    FROM latest
    WHERE len(sdv) > 0 AND TRY_CAST(lat_text AS DOUBLE) BETWEEN -90 AND 90
      AND TRY_CAST(lon_text AS DOUBLE) BETWEEN -180 AND 180
),
pv AS (
    SELECT id, pos, sdv[pos].value_type AS k,
           CASE WHEN sdv[pos].value IS NULL THEN 0.0 ELSE TRY_CAST(sdv[pos].value AS DOUBLE) END AS v
    FROM (SELECT id, sdv, unnest(generate_series(1, len(sdv))) AS pos FROM prof)
),
pv_last AS (
    SELECT * FROM pv WHERE k IS NOT NULL AND k <> '' AND v IS NOT NULL
    QUALIFY ROW_NUMBER() OVER (PARTITION BY id, k ORDER BY pos DESC) = 1
),
prof_flat AS (
    SELECT p.id, p.sensor_type, p.latitude, p.longitude, p.country, l.k AS value_type,
           l.v AS mean, greatest(l.v * 0.05, 0.5) AS std
    FROM prof p LEFT JOIN pv_last l ON p.id = l.id
),
prof_region AS (
    SELECT id, sensor_type, latitude, longitude, country,
        CASE WHEN country IN ({_EUROPE}) THEN 'Europe'
             WHEN longitude BETWEEN -170 AND -30 AND latitude BETWEEN 10 AND 85 THEN 'North America'
             WHEN longitude BETWEEN 60 AND 180 AND latitude BETWEEN -15 AND 75 THEN 'Asia-Pacific'
             ELSE 'Other' END AS region
    FROM prof
),
cdims AS (
    SELECT CAST(c_custkey AS BIGINT) AS sensor_id,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'SPS30' ELSE 'DHT22' END AS sensor_type,
           CAST((c_custkey * 37) % 170 - 85 AS DOUBLE) AS latitude,
           CAST((c_custkey * 53) % 360 - 180 AS DOUBLE) AS longitude,
           {_COUNTRIES}[CAST(c_nationkey % 25 AS INTEGER) + 1] AS country,
           dc.region AS region, CAST(c_nationkey AS INTEGER) AS customer_id
    FROM customer LEFT JOIN dim_customers dc ON c_nationkey = dc.customer_id
)"""

RBASE = with_ctes(DIMS, SNAPSHOT)

_FLAT = """SELECT id, "timestamp", sensor_id, COALESCE(type_name, 'unknown') AS sensor_type,
       lat_text AS latitude, lon_text AS longitude, COALESCE(country, '') AS country,
       CAST(len(sdv) AS INTEGER) AS n_values FROM {src}"""


def registry_queries() -> dict[str, str]:
    pool = ("CAST(CASE region WHEN 'Europe' THEN [1, 2][(id % 2 + 2) % 2 + 1] "
            "WHEN 'North America' THEN [3, 4][(id % 2 + 2) % 2 + 1] "
            "WHEN 'Asia-Pacific' THEN 5 ELSE 6 END AS INTEGER)")
    return {
        "snapshot_flat": RBASE + _FLAT.format(src="snap"),
        "snapshot_array": RBASE + _FLAT.format(src="snap"),
        "snapshot_split": RBASE + _FLAT.format(src="snap"),
        "snapshot_country": RBASE + _FLAT.format(src="snap WHERE country = 'DE'"),
        "latest_per_sensor": RBASE + _FLAT.format(src="latest"),
        "sensor_profiles": RBASE + "SELECT * FROM prof_flat",
        "stored_profiles": RBASE + "SELECT * FROM prof_flat",
        "region_assignment": RBASE + "SELECT id, country, latitude, longitude, region FROM prof_region",
        "customer_assignment": RBASE + f"""SELECT id AS sensor_id, sensor_type, latitude, longitude, country, region,
            {pool} AS customer_id FROM prof_region""",
        "profile_sample_count": RBASE + "SELECT LEAST(1000, COUNT(*)) AS sampled, LEAST(20, COUNT(*)) AS sampled_20, LEAST(20, COUNT(*)) AS known_20 FROM prof",
        "upsert_dims": RBASE + """SELECT * FROM dim_sensors WHERE sensor_id NOT IN (SELECT sensor_id FROM cdims WHERE sensor_id % 3 <> 0)
            UNION ALL SELECT * FROM cdims WHERE sensor_id % 3 <> 0""",
        "upsert_customers": RBASE + f"""SELECT CAST(id AS INTEGER) AS customer_id, name AS customer_name, region
            FROM (VALUES {', '.join(str(c) for c in SEED_CUSTOMERS)}) AS seed(id, name, region)
            WHERE id NOT IN (SELECT customer_id FROM dim_customers WHERE customer_id % 2 = 0)
            UNION ALL SELECT * FROM dim_customers WHERE customer_id % 2 = 0""",
        "insert_if_absent": RBASE + """SELECT * FROM dim_sensors
            UNION ALL SELECT * FROM cdims WHERE sensor_id NOT IN (SELECT sensor_id FROM dim_sensors)""",
        "registry_store": RBASE + """SELECT ds.sensor_id, ds.sensor_type, ds.latitude, ds.longitude, ds.country, ds.region,
            ds.customer_id, dc.customer_name FROM dim_sensors ds LEFT JOIN dim_customers dc ON ds.customer_id = dc.customer_id""",
    }


# --------------------------------------------------- layout, partitions, merges, quality

PARTS = """,
parts AS (
    SELECT DISTINCT year, month, day, hour,
           strptime(year || '-' || month || '-' || day || '-' || hour, '%Y-%m-%d-%H') AS start
    FROM bronze
),
rollover AS (
    SELECT year, month, day, hour, true AS has_data, start + INTERVAL 1 HOUR AS closed_at
    FROM parts WHERE start < TIMESTAMP '2024-01-19 06:00:00'
),
missing AS (
    SELECT year, month, day, hour, true AS has_data, TIMESTAMP '2024-01-20 12:30:00' AS closed_at
    FROM parts p
    WHERE start < TIMESTAMP '2024-01-20 12:00:00' AND start >= TIMESTAMP '2024-01-18 12:00:00'
      AND NOT EXISTS (SELECT 1 FROM rollover r WHERE r.year = p.year AND r.month = p.month
                      AND r.day = p.day AND r.hour = p.hour)
),
status AS (SELECT * FROM rollover UNION ALL SELECT * FROM missing)
"""

PBASE = BASE.rstrip().rstrip("\n") + PARTS


TWO_LANDINGS = """
landed AS (
    SELECT * REPLACE (
        CASE WHEN event_id % 89 = 1 THEN ingested_at
             WHEN event_id % 211 = 5 THEN '2031-06-01T00:00:00.000000+00:00'
             WHEN event_id % 61 = 8 THEN strftime(arrival + INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
             WHEN event_id % 47 = 10 THEN strftime(arrival - INTERVAL 15 DAY, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
             ELSE ingested_at END AS ingested_at)
    FROM readings
),
landed_once AS (
    SELECT l.* FROM landed l JOIN events e ON e.event_id = l.event_id AND e.ts = l.arrival WHERE l.event_id % 89 <> 1
),
bronze AS (
    SELECT reading_id, sensor_id, sensor_type, ingested_at, latitude, longitude, country, "values" FROM landed
    UNION ALL
    SELECT reading_id, sensor_id, sensor_type, strftime(arrival - INTERVAL 36 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00',
           latitude, longitude, country, "values" FROM landed_once WHERE event_id % 41 = 7
    UNION ALL
    SELECT reading_id, sensor_id, sensor_type, ingested_at, latitude, longitude, country, '{"P1": 1.5, "P2": 1}'
    FROM landed_once WHERE event_id % 43 = 9 AND event_id % 211 <> 5 AND event_id % 61 <> 8 AND event_id % 47 <> 10
)"""

IBASE = with_ctes(DELIVERIES, READINGS, TWO_LANDINGS, CLASSIFIED, SILVER, DIMS, ENRICHED)

LISTED = """SELECT strftime(arrival, '%Y') AS year, strftime(arrival, '%m') AS month, strftime(arrival, '%d') AS day,
        strftime(arrival, '%H') AS hour, COUNT(*) AS row_count, CAST(landing AS INTEGER) AS landing
    FROM (
        SELECT arrival, CASE WHEN strftime(arrival, '%Y%m%d%H') >= '2024011600' OR event_id % 30 = 1 OR event_id % 47 = 10
                             THEN 1 ELSE 0 END AS landing FROM landed
        UNION ALL SELECT arrival, 1 FROM landed_once WHERE event_id % 41 = 7
        UNION ALL SELECT arrival, 1 FROM landed_once
            WHERE event_id % 43 = 9 AND event_id % 211 <> 5 AND event_id % 61 <> 8 AND event_id % 47 <> 10
    ) GROUP BY ALL"""


def layout_queries() -> dict[str, str]:
    g = GOLD
    sel_silver = SILVER_COLS
    counts = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM ({q})" for n, q in [
            ("silver", "SELECT * FROM silver"),
            ("rejected", "SELECT * FROM classified WHERE rejection_reason IS NOT NULL"),
            ("pm25_by_country_hour", g["pm25"]),
            ("temperature_by_region_day", g["temperature"]),
            ("sensor_activity_by_customer", g["activity"]),
        ])
    europe_null = "CAST(NULL AS DOUBLE) AS pressure_at_sealevel"
    q_bronze = """
SELECT 'range' AS "check", 'bronze' AS table_name, 'sensor_id' AS column_name, COUNT(*) FILTER (WHERE NOT (sensor_id > 0)) AS failing_rows FROM bronze
UNION ALL SELECT 'range', 'bronze', 'latitude', COUNT(*) FILTER (WHERE NOT (latitude BETWEEN -90 AND 90)) FROM bronze
UNION ALL SELECT 'range', 'bronze', 'longitude', COUNT(*) FILTER (WHERE NOT (longitude BETWEEN -180 AND 180)) FROM bronze
UNION ALL SELECT 'valid_json', 'bronze', 'values', COUNT(*) FILTER (WHERE NOT json_valid("values")) FROM bronze
UNION ALL SELECT 'non_empty_object', 'bronze', 'values', COUNT(*) FILTER (WHERE json_valid("values") AND json_type("values") = 'OBJECT' AND len(json_keys("values")) = 0) FROM bronze
UNION ALL SELECT 'duplicate_ids', 'bronze', 'reading_id', COUNT(reading_id) - COUNT(DISTINCT reading_id) FROM bronze"""
    accepted = ", ".join("'" + t + "'" for t in ACCEPTED_SENSOR_TYPES)
    q_silver = f"""
UNION ALL SELECT 'not_null', 'silver', 'reading_id', COUNT(*) FILTER (WHERE reading_id IS NULL) FROM silver
UNION ALL SELECT 'not_null', 'silver', 'sensor_id', COUNT(*) FILTER (WHERE sensor_id IS NULL) FROM silver
UNION ALL SELECT 'not_null', 'silver', 'ingested_at', COUNT(*) FILTER (WHERE ingested_at IS NULL) FROM silver
UNION ALL SELECT 'not_null', 'silver', 'sensor_type', COUNT(*) FILTER (WHERE sensor_type IS NULL) FROM silver
UNION ALL SELECT 'accepted_values', 'silver', 'sensor_type', COUNT(*) FILTER (WHERE sensor_type IS NOT NULL AND sensor_type NOT IN ({accepted})) FROM silver
UNION ALL SELECT 'unique', 'silver', 'reading_id', CAST(COALESCE(SUM(n), 0) AS BIGINT) FROM (SELECT reading_id, COUNT(*) AS n FROM silver WHERE reading_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'not_null', 'rejected', 'rejection_reason', COUNT(*) FILTER (WHERE rejection_reason IS NULL) FROM classified WHERE rejection_reason IS NOT NULL
UNION ALL SELECT 'accepted_values', 'rejected', 'rejection_reason', COUNT(*) FILTER (WHERE rejection_reason NOT IN ('null_reading_id', 'unparseable_ingested_at', 'invalid_sensor_type')) FROM classified WHERE rejection_reason IS NOT NULL
UNION ALL SELECT 'not_null', 'pm25_by_country_hour', 'hour', COUNT(*) FILTER (WHERE hour IS NULL) FROM ({g['pm25']})
UNION ALL SELECT 'not_null', 'pm25_by_country_hour', 'country', COUNT(*) FILTER (WHERE country IS NULL) FROM ({g['pm25']})
UNION ALL SELECT 'not_null', 'pm25_by_country_hour', 'avg_pm25', COUNT(*) FILTER (WHERE avg_pm25 IS NULL) FROM ({g['pm25']})
UNION ALL SELECT 'not_null', 'temperature_by_region_day', 'day', COUNT(*) FILTER (WHERE day IS NULL) FROM ({g['temperature']})
UNION ALL SELECT 'not_null', 'temperature_by_region_day', 'region', COUNT(*) FILTER (WHERE region IS NULL) FROM ({g['temperature']})
UNION ALL SELECT 'not_null', 'sensor_activity_by_customer', 'day', COUNT(*) FILTER (WHERE day IS NULL) FROM ({g['activity']})
UNION ALL SELECT 'not_null', 'sensor_activity_by_customer', 'customer_name', COUNT(*) FILTER (WHERE customer_name IS NULL) FROM ({g['activity']})
UNION ALL SELECT 'not_null', 'sensor_activity_by_customer', 'active_sensors', COUNT(*) FILTER (WHERE active_sensors IS NULL) FROM ({g['activity']})"""
    types = {"StringType": "string", "LongType": "bigint", "DoubleType": "double"}
    columns = [(f.name, types[type(f.dataType).__name__]) for f in BRONZE_SCHEMA.fields]
    schema_rows = [f"('column_type', '{c}', '{t}', '{t}', true, 0)" for c, t in columns]
    schema_rows += [f"('required_column', '{c}', 'present', 'present', true, 0)" for c in ("reading_id", "sensor_id", "ingested_at", "values")]
    schema_rows += ["('hive_layout', '_metadata.file_path', NULL, NULL, true, 0)"]
    counted = [("future_timestamp", "ingested_at", f"{parse_ts('ingested_at')} > TIMESTAMP '2024-01-20 12:30:00'")]
    counted += [("not_null", c, f'"{c}" IS NULL') for c, _ in columns[:8]]
    checks = " UNION ALL ".join(f"""SELECT '{k}', '{c}', NULL, NULL, COUNT(*) FILTER (WHERE {w}) = 0,
        COUNT(*) FILTER (WHERE {w}) FROM bronze""" for k, c, w in counted)
    return {
        "quality_schema": BASE + f"""SELECT "check", column_name, CAST(expected AS VARCHAR) AS expected,
            CAST(actual AS VARCHAR) AS actual, ok, CAST(n AS BIGINT) AS failing_rows
            FROM (SELECT * FROM (VALUES {', '.join(schema_rows)}) AS v("check", column_name, expected, actual, ok, n)
                  UNION ALL {checks})""",
        "file_manifest": BASE + """SELECT DISTINCT year, month, day, hour, true AS keys_ok, true AS sizes_ok FROM bronze
            WHERE year || '-' || month || '-' || day || ' ' || hour IN ('2024-01-19 23', '2024-01-20 00')""",
        "bronze_roundtrip": BASE + "SELECT * FROM bronze",
        "partition_columns": BASE + "SELECT DISTINCT year, month, day, hour FROM bronze",
        "missing_markers": PBASE + "SELECT * FROM missing",
        "partition_status": PBASE + "SELECT * FROM status",
        "ready_hours": PBASE + "SELECT * FROM status s WHERE EXISTS (SELECT 1 FROM parts p WHERE p.year = s.year AND p.month = s.month AND p.day = s.day AND p.hour = s.hour)",
        "incremental_silver": IBASE + "SELECT * FROM silver",
        "full_refresh_silver": IBASE + "SELECT * FROM silver",
        "incremental_gold_pm25": IBASE + g["pm25"],
        "incremental_gold_temperature": IBASE + g["temperature"],
        "incremental_gold_activity": IBASE + g["activity"],
        "indexed_silver": IBASE + "SELECT * FROM silver",
        "delta_gold_pm25": IBASE + g["pm25"],
        "delta_gold": IBASE + g["temperature"],
        "delta_gold_activity": IBASE + g["activity"],
        "listed_increment": with_ctes(DELIVERIES, READINGS, TWO_LANDINGS) + LISTED,
        "schema_sync": BASE + f"SELECT {sel_silver.replace('pressure_at_sealevel', europe_null)} FROM silver",
        "full_refresh_counts": BASE + counts,
        "quality_report": BASE + q_bronze + q_silver,
        "scalar_suite": BASE + """SELECT reading_id, sensor_id, ts AS parsed_at, ts - INTERVAL 1 HOUR AS hour_before,
            ts - INTERVAL 48 HOUR AS lookback_start, sensor_id / 7 AS ratio,
            CAST(json_object('reading_id', reading_id, 'sensor_id', sensor_id) AS VARCHAR) AS as_json,
            TRY_CAST(reading_id AS BIGINT) AS id_number, strftime(ts, '%H') AS hour_text
            FROM (SELECT *, """ + parse_ts("ingested_at") + " AS ts FROM bronze)",
    }


# ---------------------------------------------------------------- streaming

def _d(sql: str) -> str:
    return (sql.replace("classified", "dclassified").replace("typed", "dtyped")
            .replace("FROM bronze)", "FROM dbronze)"))


DSILVER = ("," + _d(CLASSIFIED) + """,
dsilver AS (
    SELECT """ + SILVER_COLS + """ FROM dtyped WHERE rejection_reason IS NULL
    QUALIFY ROW_NUMBER() OVER (PARTITION BY reading_id ORDER BY """ + DEDUP_ORDER + """) = 1
),
draw_unreg AS (
    SELECT sensor_id, 'unregistered_device' AS alert_type, value AS payload, arrival AS created_at
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sensor_id ORDER BY arrival, value) AS rn FROM alert_src a
          WHERE NOT EXISTS (SELECT 1 FROM dim_sensors ds WHERE ds.sensor_id = a.sensor_id))
    WHERE rn = 1
)
""")

SBASE = ABASE.rstrip().rstrip("\n") + DSILVER


LATE = """
in_step AS (SELECT * FROM readings),
readings AS (
    SELECT * REPLACE (
        CASE WHEN event_id % 89 = 1 THEN ingested_at
             WHEN event_id % 211 = 5 THEN '2031-06-01T00:00:00.000000+00:00'
             WHEN event_id % 47 = 10 THEN strftime(arrival - INTERVAL 15 DAY, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
             ELSE ingested_at END AS ingested_at)
    FROM in_step
    UNION ALL
    SELECT l.* REPLACE (strftime(l.arrival - INTERVAL 36 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS ingested_at)
    FROM in_step l JOIN events e ON e.event_id = l.event_id AND e.ts = l.arrival
    WHERE l.event_id % 89 <> 1 AND l.event_id % 41 = 7
)"""

LBASE = SBASE.replace("readings AS (", "plain_readings AS (", 1).replace(
    BRONZE, LATE.replace("FROM readings)", "FROM plain_readings)") + "," + BRONZE, 1)


def stream_queries() -> dict[str, str]:
    rekey = alert_queries()["rekey"]
    return {
        "stream_bronze": SBASE + """SELECT reading_id, sensor_id, sensor_type, ingested_at, latitude, longitude,
            country, "values", year, month, day, hour FROM dbronze""",
        "stream_ingest": SBASE + """SELECT reading_id, sensor_id, sensor_type, ingested_at, latitude, longitude,
            country, "values", year, month, day, hour, CAST(NULL AS VARCHAR) AS reason FROM dbronze
            UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, raw_value, NULL, NULL, NULL, NULL, reason FROM dead""",
        "stream_first_seen": SBASE + """SELECT sensor_id, 'unregistered_device' AS alert_type, CAST(MIN(m.event_id % 3) AS INTEGER) AS wave
            FROM alert_src a JOIN messages m ON m.value = a.value AND m."timestamp" = a.arrival WHERE NOT EXISTS (SELECT 1 FROM dim_sensors ds WHERE ds.sensor_id = a.sensor_id) GROUP BY sensor_id""",
        "stream_silver_dedup": LBASE + "SELECT * FROM dsilver",
        "stream_alerts": SBASE + "SELECT sensor_id, reading_id, alert_type, payload, created_at FROM pressure_log",
        "stream_unregistered": SBASE + "SELECT * FROM draw_unreg",
        "stream_hourly": LBASE + f"""SELECT date_trunc('hour', ingested_at) AS hour, sensor_type,
            COUNT(*) AS reading_count, {avg_exact('pm25')} AS avg_pm25 FROM dsilver GROUP BY 1, 2""",
        "stream_hourly_delta": LBASE + f"""SELECT date_trunc('hour', ingested_at) AS hour, sensor_type,
            COUNT(*) AS reading_count, {avg_exact('pm25')} AS avg_pm25 FROM dsilver GROUP BY 1, 2""",
        "stream_from_kafka_frame": rekey,
        "stream_partition_status": SBASE + """SELECT year, month, day, hour, true AS has_data,
            start + INTERVAL 1 HOUR AS closed_at
            FROM (SELECT DISTINCT year, month, day, hour,
                         strptime(year || '-' || month || '-' || day || '-' || hour, '%Y-%m-%d-%H') AS start
                  FROM dbronze)
            WHERE start < (SELECT MAX(strptime(year || '-' || month || '-' || day || '-' || hour, '%Y-%m-%d-%H')) FROM dbronze)""",
        "new_items": BASE + """SELECT DISTINCT sensor_id FROM silver WHERE ingested_at >= TIMESTAMP '2024-01-01 06:00:00'
            AND sensor_id NOT IN (SELECT sensor_id FROM silver WHERE ingested_at < TIMESTAMP '2024-01-01 06:00:00')""",
    }


def oracle_queries() -> dict[str, str]:
    """Every query with an SQL statement of its result."""
    out = {}
    out.update(base_queries())
    out.update(alert_queries())
    out.update(registry_queries())
    out.update(layout_queries())
    out.update(stream_queries())
    # other ways to the same results
    for name, same in {"alert_feed_pruned": "alert_feed_resumed", "alert_latest_pruned": "alert_feed_latest",
                       "observed_counts": "stage_counts", "observed_quality": "quality_report", "upsert_buckets": "upsert_dims"}.items():
        out[name] = out[same]
    return out
