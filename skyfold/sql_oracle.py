"""Independent SQL statements of every registered query (DuckDB dialect).

Each statement reads the driver tables (views named after them) and
recomputes the query's result from scratch; column names equal those of
the Spark result.
"""

from __future__ import annotations

# Inputs: the same derivations as ``skyfold.sources.bindings``.
STAGING_FORECAST = """
staging_forecast AS (
  SELECT 'C' || lpad(CAST(user_id % 25 AS VARCHAR), 2, '0') AS city,
         CASE event_type WHEN 'view' THEN 'LowestTemp' ELSE 'HighestTemp' END AS type,
         ts AS start_time, ts + INTERVAL 12 HOUR AS end_time,
         CAST(floor(value) AS INTEGER) % 15 + CASE event_type WHEN 'view' THEN 15 ELSE 26 END AS temp,
         'C' AS unit, date_trunc('day', ts) + INTERVAL 20 HOUR AS batch_time
  FROM events
  WHERE event_type IN ('view', 'click') AND NOT (event_type = 'click' AND user_id % 25 = 3)
)"""

STAGING_ALERT = """
staging_alert AS (
  SELECT o_orderstatus AS event, nullif(substr(o_orderpriority, 1, 1), '4') AS level,
         'C' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || c_mktsegment AS area,
         o_orderdate AS start_time, o_orderdate + INTERVAL 24 HOUR AS end_time,
         date_trunc('month', o_orderdate) AS batch_time
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

STG_FORECAST = """
stg_forecast AS (SELECT city, type, CAST(start_time AS DATE) AS weather_date, temp FROM staging_forecast)"""

STG_ALERT = """
stg_alert AS (SELECT event, level, area, CAST(start_time AS DATE) AS weather_date FROM staging_alert)"""

EPH_ALERT = """
eph_alert AS (
  SELECT o_orderstatus AS event, CASE WHEN o_orderpriority NOT LIKE '4%' THEN left(o_orderpriority, 1) END AS level,
         printf('C%02d', c_nationkey) || c_mktsegment AS area, CAST(o_orderdate AS DATE) AS weather_date,
         printf('C%02d', c_nationkey) AS city, c_mktsegment AS district
  FROM customer JOIN orders ON c_custkey = o_custkey)"""

# Expected models, each straight from the driver tables.
DIM_CITY = """
dim_city AS (
  SELECT md5(c) AS city_key, c AS city
  FROM (SELECT printf('C%02d', user_id % 25) AS c FROM events
        WHERE event_type = 'view' OR (event_type = 'click' AND user_id % 25 <> 3)
        UNION ALL
        SELECT printf('C%02d', c_nationkey) FROM customer
        WHERE c_custkey IN (SELECT o_custkey FROM orders))
  GROUP BY c)"""

DIM_AREA = """
dim_area AS (
  SELECT md5(printf('C%02d', c_nationkey) || c_mktsegment) AS area_key,
         printf('C%02d', c_nationkey) AS city, c_mktsegment AS area
  FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
  GROUP BY c_nationkey, c_mktsegment)"""

# every forecast city has a dimension row, so no join is needed
EPH_FORECAST = """
eph_forecast AS (
  SELECT md5(printf('C%02d', user_id % 25)) AS city_key, CAST(ts AS DATE) AS weather_date,
         avg(CAST(floor(value) AS INTEGER) % 15 + 15) FILTER (WHERE event_type = 'view') AS avg_LowestTemp,
         avg(CAST(floor(value) AS INTEGER) % 15 + 26)
           FILTER (WHERE event_type = 'click' AND user_id % 25 <> 3) AS avg_HighestTemp
  FROM events
  WHERE event_type = 'view' OR (event_type = 'click' AND user_id % 25 <> 3)
  GROUP BY user_id % 25, CAST(ts AS DATE))"""

FLAG = """CASE WHEN avg_HighestTemp >= 36 THEN 'Extreme' WHEN avg_HighestTemp >= 32 THEN 'Hot'
              WHEN avg_HighestTemp >= 28 THEN 'Warm' ELSE 'Normal' END"""

MODELS = [STAGING_FORECAST, STAGING_ALERT, STG_FORECAST, STG_ALERT, EPH_ALERT, DIM_CITY,
          DIM_AREA, EPH_FORECAST]


def with_models(select: str, extra: list[str] | None = None) -> str:
    ctes = ",".join(MODELS + (extra or []))
    return f"WITH {ctes}\n{select}"


ORACLE: dict[str, str] = {}


def register(key: str, sql: str) -> None:
    ORACLE[key] = sql.strip()


register("stg_forecast", with_models("SELECT city, type, weather_date, temp FROM stg_forecast"))
register("stg_alert", with_models("SELECT event, level, area, weather_date FROM stg_alert"))
register("eph_forecast", with_models(
    "SELECT city_key, weather_date, avg_LowestTemp, avg_HighestTemp FROM eph_forecast"))
register("eph_alert", with_models(
    "SELECT event, level, area, weather_date, city, district FROM eph_alert"))
register("dim_city", with_models("SELECT city_key, city FROM dim_city"))
register("dim_area", with_models("SELECT area_key, city, area FROM dim_area"))
register("fact_forecast", with_models(
    f"SELECT city_key, weather_date, avg_LowestTemp, avg_HighestTemp, {FLAG} AS flag_HighestTemp "
    "FROM eph_forecast"))
# every alert area has its dimension rows, so no join is needed
FACT_ALERT = """
fact_alert AS (
  SELECT md5(printf('C%02d', c_nationkey)) AS city_key,
         md5(printf('C%02d', c_nationkey) || c_mktsegment) AS area_key,
         CAST(o_orderdate AS DATE) AS weather_date, o_orderstatus AS event,
         CASE WHEN o_orderpriority NOT LIKE '4%' THEN left(o_orderpriority, 1) END AS level
  FROM customer JOIN orders ON c_custkey = o_custkey)"""
register("fact_alert", f"WITH {FACT_ALERT}\nSELECT * FROM fact_alert")


# ---------------------------------------------------------------- raw payload entries

FORECAST_ENTRIES = """
forecast_entries AS (
  SELECT strftime(date_trunc('day', ts) + INTERVAL 20 HOUR, '%Y%m%dT%H%M%SZ') AS batch_id,
         CAST(floor(event_id / 1024) AS BIGINT) AS part,
         'C' || lpad(CAST(user_id % 25 AS VARCHAR), 2, '0') AS locationName,
         CASE WHEN event_type = 'view' THEN 'MinT'
              WHEN event_type = 'click' AND user_id % 25 <> 3 THEN 'MaxT'
              WHEN event_type = 'purchase' THEN 'Wx'
              WHEN event_type = 'error' THEN 'CI' ELSE 'PoP' END AS elementName,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS startTime,
         strftime(ts + INTERVAL 12 HOUR, '%Y-%m-%dT%H:%M:%S.%f') AS endTime,
         CASE WHEN event_type = 'view' OR (event_type = 'click' AND user_id % 25 <> 3)
              THEN CAST(CAST(floor(value) AS INTEGER) % 15
                        + CASE event_type WHEN 'view' THEN 15 ELSE 26 END AS VARCHAR)
              WHEN event_type = 'purchase' THEN props
              ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS parameterName,
         CASE WHEN event_type = 'view' OR (event_type = 'click' AND user_id % 25 <> 3)
              THEN 'C' ELSE '%' END AS parameterUnit
  FROM events)"""

ALERT_INFOS = """
alert_infos AS (
  SELECT strftime(date_trunc('month', o_orderdate), '%Y%m%dT%H%M%SZ') AS batch_id,
         CAST(floor(o_orderkey / 1024) AS BIGINT) AS part,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS onset,
         strftime(o_orderdate + INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S') AS expires,
         o_orderstatus AS event,
         nullif(substr(o_orderpriority, 1, 1), '4') AS level,
         'C' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || c_mktsegment AS area
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

KEPT = "elementName IN ('MinT', 'MaxT')"
LABEL = "CASE elementName WHEN 'MinT' THEN 'LowestTemp' ELSE 'HighestTemp' END"
SILVER_FC = f"""
SELECT batch_id, locationName AS City, {LABEL} AS Type, startTime, endTime,
       parameterName AS Temp, parameterUnit AS Unit
FROM forecast_entries WHERE {KEPT}"""

register("flatten_forecast", f"WITH {FORECAST_ENTRIES}\n{SILVER_FC}")
register("scan_silver", f"WITH {FORECAST_ENTRIES}\n{SILVER_FC}")
register("flatten_alert", f"""WITH {ALERT_INFOS}
SELECT batch_id, event, level, area, onset AS start_time, expires AS end_time FROM alert_infos""")
register("map_code_filter", f"""WITH {FORECAST_ENTRIES}
SELECT batch_id, part, locationName AS City, {LABEL} AS Type, count(*) AS n_slots
FROM forecast_entries WHERE {KEPT} GROUP BY ALL""")
register("last_match_attr", f"""WITH {ALERT_INFOS}
SELECT batch_id, event, onset AS start_time, level FROM alert_infos""")
register("drop_null_elements", f"""WITH {ALERT_INFOS}
SELECT batch_id, event, onset AS start_time, 2 AS n_areas, 1 AS n_areas_kept FROM alert_infos""")
register("scan_bronze_json", f"""WITH {FORECAST_ENTRIES}
SELECT batch_id, count(DISTINCT part) AS n_documents,
       count(DISTINCT part || '|' || locationName) AS n_locations,
       count(DISTINCT part || '|' || locationName || '|' || elementName) AS n_elements,
       count(*) AS n_slots
FROM forecast_entries GROUP BY batch_id""")
register("land_bronze", f"""WITH {FORECAST_ENTRIES}, {ALERT_INFOS}
SELECT 'temperature' AS dataset, batch_id, count(DISTINCT part) AS n_documents
FROM forecast_entries GROUP BY batch_id
UNION ALL
SELECT 'temperature_alert' AS dataset, batch_id, count(DISTINCT part) AS n_documents
FROM alert_infos GROUP BY batch_id""")
register("write_silver", f"""WITH {ALERT_INFOS}
SELECT batch_id, count(*) AS n_rows FROM alert_infos GROUP BY batch_id""")

# ---------------------------------------------------------------- staging

STAGING_FC_TYPED = f"""
SELECT city, type, start_time, end_time, temp, unit,
       strftime(batch_time, '%Y%m%dT%H%M%SZ') AS batch_id FROM staging_forecast"""
register("rename_standard", f"""WITH {FORECAST_ENTRIES}
SELECT locationName AS city, {LABEL} AS type, startTime AS start_time, endTime AS end_time,
       parameterName AS temp, parameterUnit AS unit, batch_id
FROM forecast_entries WHERE {KEPT}""")
register("cast_strict", f"WITH {STAGING_FORECAST}\n{STAGING_FC_TYPED}")
register("cast_quarantine", f"""WITH {FORECAST_ENTRIES}
SELECT batch_id, locationName AS City, elementName, startTime, parameterName AS Temp_text,
       try_cast(parameterName AS INTEGER) AS temp,
       CASE WHEN parameterName IS NOT NULL AND try_cast(parameterName AS INTEGER) IS NULL
            THEN 'rejected' ELSE 'ok' END AS status
FROM forecast_entries""")
register("audit_columns", f"""WITH {STAGING_FORECAST}
SELECT city, type, start_time, end_time, temp, unit, batch_time,
       TIMESTAMP '2024-02-01 00:00:00' AS update_time FROM staging_forecast""")
STAGING_OUT = "city, type, start_time, end_time, temp, unit, batch_time"
register("replace_batch", f"WITH {STAGING_FORECAST}\nSELECT {STAGING_OUT} FROM staging_forecast")
register("stream_ingest", f"WITH {STAGING_FORECAST}\nSELECT {STAGING_OUT} FROM staging_forecast")
register("replace_batch_empty", f"""WITH {STAGING_ALERT}
SELECT batch_time, count(*) AS row_count FROM staging_alert
WHERE batch_time <> (SELECT max(batch_time) FROM staging_alert) GROUP BY batch_time""")
register("publish_append", f"""WITH {STAGING_FORECAST}
SELECT batch_time, 2 * count(*) AS row_count FROM staging_forecast GROUP BY batch_time""")
register("scan_batch", f"""WITH {STAGING_FORECAST}
SELECT {STAGING_OUT} FROM staging_forecast
WHERE batch_time = (SELECT max(batch_time) FROM staging_forecast)""")
register("sql_query", with_models("""
SELECT city, count(*) AS n_hot FROM stg_forecast
WHERE type = 'HighestTemp' AND temp >= 32 GROUP BY city"""))

# ---------------------------------------------------------------- scalar & set models

register("split_area", with_models("SELECT area, city, district FROM eph_alert"))
register("bucket_level", with_models("""
SELECT type, CASE WHEN temp >= 36 THEN 'Extreme' WHEN temp >= 32 THEN 'Hot'
                  WHEN temp >= 28 THEN 'Warm' ELSE 'Normal' END AS level,
       count(*) AS n_rows
FROM stg_forecast GROUP BY ALL"""))
register("join_city_dim", with_models("""
SELECT d.city_key, s.city, s.type, s.weather_date, s.temp
FROM stg_forecast s JOIN dim_city d ON s.city = d.city"""))
register("union_distinct_city", with_models("""
SELECT city FROM stg_forecast UNION SELECT substr(area, 1, 3) AS city FROM stg_alert"""))
register("distinct_area", with_models("""
SELECT DISTINCT substr(area, 1, 3) AS city, substr(area, 4) AS area FROM stg_alert"""))

# ---------------------------------------------------------------- incremental dims

PRIOR_CITY = """
prior_city AS (
  SELECT md5(city) AS city_key, city FROM (
    SELECT 'C' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS city
    FROM nation WHERE n_regionkey <= 1))"""
PRIOR_CITY_NULL = """
prior_city_null AS (
  SELECT md5(city) AS city_key, city FROM (
    SELECT CASE WHEN n_regionkey <= 1
                THEN 'C' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS city
    FROM nation WHERE n_regionkey <= 2))"""
PRIOR_AREA = """
prior_area AS (SELECT * FROM dim_area WHERE city IN (SELECT city FROM prior_city))"""

register("dim_city_new", with_models(
    "SELECT city_key, city FROM dim_city WHERE city NOT IN (SELECT city FROM prior_city)",
    [PRIOR_CITY]))
register("dim_city_incremental", with_models("SELECT city_key, city FROM dim_city"))
register("not_in_null_target", with_models(
    "SELECT city_key, city FROM dim_city WHERE city NOT IN (SELECT city FROM prior_city_null)",
    [PRIOR_CITY_NULL]))
register("dim_area_new", with_models(
    "SELECT area_key, city, area FROM dim_area "
    "WHERE area_key NOT IN (SELECT area_key FROM prior_area)", [PRIOR_CITY, PRIOR_AREA]))
register("dim_area_incremental", with_models("SELECT area_key, city, area FROM dim_area"))

# ---------------------------------------------------------------- data quality

FACT_FORECAST = f"""
fact_forecast AS (
  SELECT city_key, weather_date, avg_LowestTemp, avg_HighestTemp, {FLAG} AS flag_HighestTemp
  FROM eph_forecast)"""

def _nn(model: str, rel: str, col: str) -> str:
    return (f"SELECT '{model}' AS model, '{col}' AS column_name, 'not_null' AS test, "
            f"count(*) AS n_rows, count(*) FILTER (WHERE {col} IS NULL) AS n_failing FROM {rel}")


def _status(sql: str) -> str:
    return (f"SELECT model, column_name, test, n_rows, n_failing, "
            f"CASE WHEN n_failing = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({sql})")


register("dq_not_null", with_models(_status(" UNION ALL ".join([
    _nn("stg_weather_forecast", "stg_forecast", "city"),
    _nn("stg_weather_alert", "stg_alert", "area"),
    _nn("dim_area", "dim_area", "area_key"),
    _nn("fact_weather_forecast", "fact_forecast", "city_key"),
    _nn("fact_weather_alert", "fact_alert", "city_key"),
    _nn("fact_weather_alert", "fact_alert", "area_key"),
])), [FACT_FORECAST, FACT_ALERT]))


def _uq(model: str, rel: str, col: str) -> str:
    return (f"SELECT '{model}' AS model, '{col}' AS column_name, 'unique' AS test, "
            f"CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, count(*) FILTER (WHERE n > 1) AS n_failing "
            f"FROM (SELECT {col}, count(*) AS n FROM {rel} WHERE {col} IS NOT NULL GROUP BY {col})")


register("dq_unique", with_models(_status(
    _uq("dim_area", "dim_area", "area_key") + " UNION ALL " + _uq("dim_city", "dim_city", "city_key"))))
register("dq_pk_forecast", f"""WITH {STAGING_FORECAST}
SELECT city, type, start_time, end_time, batch_time, count(*) AS n_rows
FROM staging_forecast GROUP BY ALL
HAVING count(*) > 1 OR city IS NULL OR type IS NULL OR start_time IS NULL
    OR end_time IS NULL OR batch_time IS NULL""")
register("dq_pk_alert", f"""WITH {STAGING_ALERT}
SELECT area, level, start_time, end_time, batch_time, count(*) AS n_rows
FROM staging_alert GROUP BY ALL
HAVING count(*) > 1 OR area IS NULL OR level IS NULL OR start_time IS NULL
    OR end_time IS NULL OR batch_time IS NULL""")
register("dq_pk_not_null", f"WITH {STAGING_FORECAST}, {STAGING_ALERT}\n" + _status(" UNION ALL ".join(
    [_nn("staging_forecast", "staging_forecast", c)
     for c in ("city", "type", "start_time", "end_time", "batch_time")]
    + [_nn("staging_alert", "staging_alert", c)
       for c in ("area", "level", "start_time", "end_time", "batch_time")])))


def _orphan(model: str, rel: str, fk: str, dim: str, pk: str) -> str:
    return (f"SELECT '{model}' AS model, '{fk}' AS column_name, 'relationships' AS test, "
            f"(SELECT count(*) FROM {rel}) AS n_rows, "
            f"(SELECT count(*) FROM {rel} f WHERE f.{fk} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {dim} d WHERE d.{pk} = f.{fk})) AS n_failing")


register("dq_orphans", with_models(_status(" UNION ALL ".join([
    _orphan("fact_weather_forecast", "fact_forecast", "city_key", "dim_city", "city_key"),
    _orphan("fact_weather_alert", "fact_alert", "city_key", "dim_city", "city_key"),
    _orphan("fact_weather_alert", "fact_alert", "area_key", "dim_area", "area_key"),
])), [FACT_FORECAST, FACT_ALERT]))

# ---------------------------------------------------------------- run state

RUN_STATE = """
reg AS (
  SELECT 'p' || CAST(user_id AS VARCHAR) AS pipeline_name, min(event_id) AS created_seq,
         arg_min(ts, event_id) AS created_at
  FROM events WHERE event_type = 'signup' GROUP BY user_id),
log AS (
  SELECT 'p' || CAST(user_id AS VARCHAR) AS pipeline_name, event_id AS seq,
         CASE WHEN event_type IN ('view', 'click') THEN 'RUNNING'
              WHEN event_type = 'purchase' THEN 'SUCCESS' ELSE 'FAILED' END AS status,
         CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) END AS row_count,
         CASE WHEN event_type = 'purchase' THEN date_trunc('day', ts) + INTERVAL 20 HOUR END
           AS last_processed_at,
         ts
  FROM events WHERE event_type <> 'signup'),
live AS (
  SELECT l.* FROM log l JOIN reg r ON l.pipeline_name = r.pipeline_name
  WHERE l.seq > r.created_seq),
folded AS (
  SELECT pipeline_name, arg_max(status, seq) AS f_status,
         arg_max(row_count, seq) FILTER (WHERE row_count IS NOT NULL) AS f_rows,
         arg_max(last_processed_at, seq) FILTER (WHERE last_processed_at IS NOT NULL) AS f_lpa,
         arg_max(ts, seq) FILTER (WHERE status = 'RUNNING') AS f_run,
         arg_max(ts, seq) AS f_ts
  FROM live GROUP BY pipeline_name),
state AS (
  SELECT r.pipeline_name, f.f_status AS status, f.f_rows AS row_count,
         f.f_lpa AS last_processed_at, f.f_run AS last_run_at, r.created_at,
         coalesce(f.f_ts, r.created_at) AS updated_at
  FROM reg r LEFT JOIN folded f ON r.pipeline_name = f.pipeline_name)"""

register("pipeline_state_fold", f"WITH {RUN_STATE}\nSELECT * FROM state")
register("pipeline_state_update", f"""WITH {RUN_STATE},
first_upd AS (
  SELECT pipeline_name, status AS u_status, row_count AS u_rows,
         last_processed_at AS u_lpa, ts AS u_ts
  FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_name ORDER BY seq) AS rn FROM live)
  WHERE rn = 1)
SELECT r.pipeline_name, u.u_status AS status, u.u_rows AS row_count,
       u.u_lpa AS last_processed_at,
       CASE WHEN u.u_status = 'RUNNING' THEN u.u_ts END AS last_run_at,
       r.created_at, coalesce(u.u_ts, r.created_at) AS updated_at
FROM reg r LEFT JOIN first_upd u ON r.pipeline_name = u.pipeline_name""")
register("pipeline_state_lookup", f"""WITH {RUN_STATE}
SELECT pipeline_name, status, last_processed_at, row_count FROM state
WHERE pipeline_name IN (SELECT pipeline_name FROM log WHERE status = 'FAILED')""")
register("high_water_mark", f"""WITH {RUN_STATE}
SELECT pipeline_name, max(last_processed_at) AS high_water_mark
FROM live WHERE status = 'SUCCESS' GROUP BY pipeline_name""")
register("batch_row_count", f"""WITH {STAGING_FORECAST}, {STAGING_ALERT}
SELECT 'staging_forecast' AS table_name, batch_time, count(*) AS row_count
FROM staging_forecast GROUP BY batch_time
UNION ALL
SELECT 'staging_alert' AS table_name, batch_time, count(*) AS row_count
FROM staging_alert GROUP BY batch_time""")
register("batch_row_count_total", f"""WITH {STAGING_FORECAST}, {STAGING_ALERT}
SELECT batch_time, CAST(count(*) AS BIGINT) AS row_count FROM (
  SELECT batch_time FROM staging_forecast UNION ALL SELECT batch_time FROM staging_alert)
GROUP BY batch_time""")

# ---------------------------------------------------------------- retention

OBJECTS = """
objects AS (
  SELECT object_name,
         try_cast(nullif(regexp_extract(object_name,
           '_([0-9]{4}-[0-9]{2}-[0-9]{2}T[^/]*)[.](json|parquet)$', 1), '') AS TIMESTAMPTZ)
           AT TIME ZONE 'UTC' AS object_ts
  FROM (
    SELECT CASE WHEN event_type = 'error' THEN 'weather/tmp/' || CAST(event_id AS VARCHAR) || '.log'
                WHEN event_type IN ('view', 'click')
                THEN 'weather/temperature_' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00.json'
                ELSE 'weather/etl_temperature_' || strftime(ts, '%Y-%m-%dT%H:%M:%S')
                     || '+00:00.parquet' END AS object_name
    FROM events))"""
register("parse_object_ts", f"WITH {OBJECTS}\nSELECT object_name, object_ts FROM objects")
register("retention_candidates", f"""WITH {OBJECTS}
SELECT object_name, object_ts FROM objects
WHERE object_ts < (SELECT max(object_ts) FROM objects) - INTERVAL 2 DAY""")
register("retention_keep", f"""WITH {OBJECTS}
SELECT object_name, object_ts FROM objects
WHERE object_ts IS NULL OR object_ts >= (SELECT max(object_ts) FROM objects) - INTERVAL 2 DAY""")

register("dq_failures", with_models(_status(" UNION ALL ".join([
    _orphan("fact_weather_forecast", "fact_forecast", "city_key", "prior_city", "city_key"),
    _orphan("fact_weather_alert", "fact_alert", "city_key", "prior_city", "city_key"),
    _orphan("fact_weather_alert", "fact_alert", "area_key", "prior_area", "area_key"),
    _nn("stg_weather_alert", "stg_alert", "event"),
    _nn("stg_weather_alert", "stg_alert", "level"),
    _uq("stg_weather_alert", "stg_alert", "area"),
])), [FACT_FORECAST, FACT_ALERT, PRIOR_CITY, PRIOR_AREA]))

# ---------------------------------------------------------------- whole jobs

# alerts by what the key check says of them
CHECKED_ALERT = """
checked_alert AS (
  SELECT *, CASE WHEN level IS NULL THEN 'null key'
                 WHEN count(*) OVER (PARTITION BY area, level, start_time, end_time, batch_time) > 1
                 THEN 'duplicate key' ELSE 'kept' END AS reason
  FROM staging_alert)"""
CLEAN_ALERT = f"WITH {STAGING_ALERT}, {CHECKED_ALERT}, clean AS (SELECT * FROM checked_alert WHERE reason = 'kept')"
register("quarantine_rejects", f"""WITH {STAGING_ALERT}, {CHECKED_ALERT}
SELECT strftime(batch_time, '%Y%m%dT%H%M%SZ') AS batch_id, reason, count(*) AS row_count
FROM checked_alert GROUP BY ALL""")
_RELOADED = f"""WITH {STAGING_FORECAST},
per_batch AS (
  SELECT strftime(batch_time, '%Y%m%dT%H%M%SZ') AS batch_id, count(*) AS row_count
  FROM staging_forecast GROUP BY batch_time),
latest AS (SELECT strftime(date_trunc('day', max(ts)) + INTERVAL 20 HOUR, '%Y%m%dT%H%M%SZ') AS id FROM events)
SELECT layer, batch_id, row_count
FROM per_batch, (VALUES ('silver'), ('staging'), ('warehouse')) AS layers(layer)
WHERE batch_id <> (SELECT id FROM latest)"""
register("batch_reload_empty", _RELOADED)
register("stream_reload_empty", _RELOADED)
register("retention_after_delete", """
WITH batch AS (SELECT DISTINCT date_trunc('day', ts) + INTERVAL 20 HOUR AS object_ts FROM events)
SELECT dataset, object_ts
FROM batch, (VALUES ('temperature'), ('temperature_alert')) AS sets(dataset)
WHERE object_ts >= (SELECT max(object_ts) FROM batch) + INTERVAL 1 DAY - INTERVAL 2 DAY""")

register("pipeline_run", ORACLE["fact_forecast"])
register("pipeline_run_alert", CLEAN_ALERT + """
SELECT md5(left(area, 3)) AS city_key, md5(area) AS area_key, CAST(start_time AS DATE) AS weather_date,
       event, level FROM clean""")
register("pipeline_run_dims", CLEAN_ALERT + f""", {STAGING_FORECAST}
SELECT DISTINCT md5(city) AS key, city, NULL AS area
FROM (SELECT city FROM staging_forecast UNION ALL SELECT left(area, 3) FROM clean)
UNION ALL
SELECT DISTINCT md5(area), left(area, 3), substr(area, 4) FROM clean""")
register("pipeline_run_tables", CLEAN_ALERT + f""", {STAGING_FORECAST},
n AS (SELECT (SELECT count(*) FROM staging_forecast) AS fc, (SELECT count(*) FROM clean) AS al,
             (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey) AS every_alert)
SELECT unnest(['staging/staging_forecast', 'warehouse/staging_forecast', 'view/stg_weather_forecast',
               'quarantine/staging_forecast', 'staging/staging_alert', 'warehouse/staging_alert',
               'view/stg_weather_alert', 'quarantine/staging_alert']) AS table_name,
       unnest([fc, fc, fc, 0, al, al, al, every_alert - al]) AS row_count
FROM n""")
register("pipeline_run_state", CLEAN_ALERT + f""", {STAGING_FORECAST}
SELECT 'forecast_and_alert_batches' AS pipeline_name, 'SUCCESS' AS status,
       (SELECT count(*) FROM staging_forecast) + (SELECT count(*) FROM clean) AS row_count,
       TIMESTAMP '2024-02-01 00:00:00' AS last_processed_at, TIMESTAMP '2024-02-01 00:00:00' AS last_run_at,
       TIMESTAMP '2024-02-01 00:00:00' AS created_at, TIMESTAMP '2024-02-01 00:00:00' AS updated_at""")

_DOCS = [
    ("stg_weather_forecast", "view", "Forecast time slots with the forecast date derived from the start time.", "staging,weather,forecast", "stg_forecast"),
    ("stg_weather_alert", "view", "Temperature alerts per area with the alert date.", "staging,weather,alert", "stg_alert"),
    ("dim_city", "table", "City keys of every city seen in forecasts or alerts.", "mart,dim,city", "dim_city"),
    ("dim_area", "table", "Area keys of every area seen in alerts.", "mart,dim,area", "dim_area"),
    ("fact_weather_forecast", "table", "Average low and high temperature per city and day, with a heat flag.", "mart,fact,weather,forecast", "fact_forecast"),
    ("fact_weather_alert", "table", "One row per alert and area, keyed to both dimensions.", "mart,fact,weather,alert", "fact_alert"),
    ("staging_forecast", "source", "Forecast time slots as loaded, one partition per batch.", "", "staging_forecast"),
    ("staging_alert", "source", "Temperature alerts as loaded, one partition per batch.", "", "staging_alert"),
]
register("table_docs", with_models(" UNION ALL ".join(
    f"SELECT '{m}' AS model, '{mat}' AS materialized, '{d}' AS description, '{t}' AS tags, "
    f"(SELECT count(*) FROM {rel}) AS n_rows" for m, mat, d, t, rel in _DOCS),
    [FACT_FORECAST, FACT_ALERT]))

_CLEAN_COUNTS = {
    "dim_city": "SELECT count(DISTINCT c) FROM (SELECT city AS c FROM staging_forecast UNION ALL SELECT left(area, 3) FROM clean)",
    "dim_area": "SELECT count(DISTINCT area) FROM clean",
    "fact_weather_forecast": "SELECT count(*) FROM (SELECT DISTINCT city, CAST(start_time AS DATE) FROM staging_forecast)",
    "fact_weather_alert": "SELECT count(*) FROM clean",
}
register("pipeline_run_docs", CLEAN_ALERT + f", {STAGING_FORECAST}\n" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{mat}' AS materialized, '{d}' AS description, '{t}' AS tags, "
    f"({_CLEAN_COUNTS[m]}) AS n_rows" for m, mat, d, t, _ in _DOCS if m in _CLEAN_COUNTS))

register("list_objects", f"""WITH {FORECAST_ENTRIES}
SELECT DISTINCT batch_id, strptime(batch_id, '%Y%m%dT%H%M%SZ') AS object_ts
FROM forecast_entries""")


# ---------------------------------------------------------------- commit records

# the earliest batch with its even temperatures only
HALVED = """
numbered AS (SELECT *, strftime(batch_time, '%Y%m%dT%H%M%SZ') AS batch_id,
                    min(batch_time) OVER () AS earliest, max(batch_time) OVER () AS latest FROM staging_forecast),
halved AS (SELECT * FROM numbered WHERE batch_time > earliest OR temp % 2 = 0)"""

register("batch_failed_reload", f"""WITH {STAGING_FORECAST}, {HALVED}
SELECT layer, batch_id, count(*) AS row_count
FROM halved, (VALUES ('kept'), ('staging'), ('warehouse')) AS layers(layer) GROUP BY layer, batch_id""")
register("fact_forecast_merged", f"""WITH {STAGING_FORECAST}, {HALVED},
days AS (SELECT city, CAST(start_time AS DATE) AS weather_date,
                avg(temp) FILTER (WHERE type = 'LowestTemp') AS avg_LowestTemp,
                avg(temp) FILTER (WHERE type = 'HighestTemp') AS avg_HighestTemp
         FROM halved WHERE batch_time < latest GROUP BY ALL)
SELECT md5(city) AS city_key, weather_date, avg_LowestTemp, avg_HighestTemp, {FLAG} AS flag_HighestTemp FROM days""")
register("batch_stats", CLEAN_ALERT + f""", {STAGING_FORECAST},
everything AS (
  SELECT 'staging/staging_forecast' AS table_name, batch_time, start_time FROM staging_forecast
  UNION ALL SELECT 'staging/staging_alert', batch_time, start_time FROM clean
  UNION ALL SELECT 'quarantine/staging_alert', batch_time, start_time FROM checked_alert WHERE reason <> 'kept')
SELECT table_name, strftime(batch_time, '%Y%m%dT%H%M%SZ') AS batch_id, count(*) AS row_count,
       CAST(CAST(min(start_time) AS TIMESTAMP) AS VARCHAR) AS low,
       CAST(CAST(max(start_time) AS TIMESTAMP) AS VARCHAR) AS high
FROM everything GROUP BY table_name, batch_time""")
register("dim_city_rivals", with_models("SELECT city_key, city, 1 AS retries FROM dim_city"))
register("mart_rebuild", with_models("""
SELECT 'before' AS opened, md5(city) AS city_key, city FROM prior_city
UNION ALL SELECT 'after', city_key, city FROM dim_city""", [PRIOR_CITY]))
register("dq_not_null_merged", with_models(_status(" UNION ALL ".join([
    _nn("stg_weather_forecast", "stg_forecast", "city"),
    _nn("stg_weather_forecast", "stg_forecast", "weather_date"),
    _nn("stg_weather_alert", "stg_alert", "area"), _nn("stg_weather_alert", "stg_alert", "level")]))))
register("stream_trickle", ORACLE["stream_ingest"])
register("publish_loaded_rows", f"""WITH {STAGING_FORECAST}
SELECT run, count(*) AS loaded_rows, run * count(*) AS table_rows
FROM staging_forecast, (VALUES (1), (2)) AS runs(run) GROUP BY run""")
