"""SQL twins of the queries, for DuckDB on the driver's tables.

``FX`` holds the mapping of FIXTURES.md as common table expressions; every statement starts
with it. Written independently of the DataFrame code.
"""

from __future__ import annotations

FX = """
WITH fx_countries AS (
  SELECT concat('N', chr(65 + n_nationkey)) AS country_code, n_name AS country_name, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
fx_stations AS (
  SELECT concat(country_code, '/', country_code, lpad(CAST(s_suppkey AS VARCHAR), 5, '0')) AS station_code,
         country_code, s_name AS station_name,
         CASE s_suppkey % 3 WHEN 0 THEN 'traffic' WHEN 1 THEN 'background' ELSE 'industrial' END AS station_type,
         CASE s_suppkey % 2 WHEN 0 THEN 'urban' ELSE 'rural' END AS area_type,
         s_suppkey
  FROM (SELECT s_suppkey, s_name, concat('N', chr(65 + s_nationkey)) AS country_code FROM supplier) s
),
fx_measurements AS (
  SELECT e.ts AS time,
         concat(s.country_code, '/SPO-', s.country_code, lpad(CAST(s.s_suppkey AS VARCHAR), 5, '0'), '_',
                lpad(CAST(e.pollutant_code AS VARCHAR), 5, '0'), '_', CAST(e.user_id AS VARCHAR)) AS sampling_point_id,
         e.pollutant_code, e.value,
         CASE e.pollutant_code WHEN 10 THEN 'mg/m3' ELSE 'ug/m3' END AS unit,
         CASE WHEN e.k % 10 = 9 THEN 'day' ELSE 'hour' END AS aggregation_type,
         CASE e.k % 10 WHEN 0 THEN -99 WHEN 1 THEN -1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 4
                       WHEN 5 THEN NULL ELSE 1 END AS validity,
         1 + e.k % 3 AS verification,
         CAST(e.k AS DOUBLE) AS data_capture,
         CAST(e.event_id AS VARCHAR) AS observation_id,
         s.s_suppkey
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
               CAST(floor(user_id / 3) AS BIGINT) AS suppkey,
               CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 5 WHEN 'purchase' THEN 7
                               WHEN 'signup' THEN 8 ELSE 10 END AS pollutant_code
        FROM events) e
  JOIN fx_stations s ON e.suppkey = s.s_suppkey
),
fx_sampling_points AS (
  SELECT DISTINCT sampling_point_id, pollutant_code,
         concat(split_part(sampling_point_id, '/', 1), '/',
                split_part(replace(split_part(sampling_point_id, '/', 2), 'SPO-', ''), '_', 1)) AS station_code,
         split_part(sampling_point_id, '/', 1) AS country_code
  FROM fx_measurements
),
fx_upsert_batch AS (
  SELECT * REPLACE (date_trunc('hour', time) AS time, value + 1 AS value),
         CAST(observation_id AS BIGINT) AS seq
  FROM fx_measurements
),
fx_upsert_target AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY time, sampling_point_id ORDER BY seq) AS rn
                 FROM fx_upsert_batch)
  WHERE rn = 1 AND seq % 2 = 0
),
fx_extract AS (
  SELECT 2 + 2 * s_suppkey + r.dup AS row_num,
         CASE WHEN s_suppkey % 13 = 5 THEN ''
              WHEN s_suppkey % 11 = 4 THEN concat('ZZ', lpad(CAST(s_suppkey AS VARCHAR), 4, '0'))
              ELSE concat('N', chr(65 + s_nationkey), lpad(CAST(s_suppkey AS VARCHAR), 4, '0'), 'A') END AS eoi_code,
         concat(' SP_', CAST(s_suppkey AS VARCHAR), '_', CAST(r.dup * (s_suppkey % 2) AS VARCHAR), ' ') AS sampling_point,
         CASE WHEN r.dup = 0 AND s_suppkey % 4 = 0 THEN 'UNKNOWN' WHEN s_suppkey % 4 = 1 THEN 'NO2'
              WHEN s_suppkey % 4 = 2 THEN 'PM10' ELSE 'O3' END AS pollutant_name,
         CASE WHEN s_suppkey % 5 = 0 THEN '-999' WHEN s_suppkey % 5 = 1 THEN '' WHEN s_suppkey % 5 = 2 THEN 'n/a'
              WHEN s_suppkey % 5 = 3 THEN '-999.0' ELSE CAST(s_acctbal AS VARCHAR) END AS altitude,
         CASE WHEN s_suppkey % 3 = 0 THEN '01/02/2020 00:00:00' WHEN s_suppkey % 3 = 1 THEN '2020-02-01'
              ELSE ' ' END AS activity_begin,
         concat('  ', s_name, ' ') AS station_name
  FROM supplier CROSS JOIN (SELECT 0 AS dup UNION ALL SELECT 1 AS dup) r
),
fx_pollutant_names AS (
  SELECT * FROM (VALUES ('PM10', 1), ('PM2.5', 6001), ('NO2', 8), ('O3', 7), ('NOx', 9), ('CO', 10), ('SO2', 14),
    ('C6H6', 20), ('Cd', 21), ('NO', 38), ('PM1', 46), ('BC', 47), ('UFP', 48), ('PN', 49), ('BaP', 5029),
    ('Ni', 5012), ('As', 5014), ('Pb', 5015)) AS t(pollutant_name, pollutant_code)
),
fx_complete AS (
  SELECT * REPLACE (trim(sampling_point) AS sampling_point), trim(eoi_code) AS station_code,
         left(trim(eoi_code), 2) AS country_code
  FROM fx_extract WHERE trim(eoi_code) <> '' AND trim(sampling_point) <> ''
),
fx_known AS (
  SELECT c.*, concat(c.country_code, '/', c.sampling_point) AS sampling_point_id, p.pollutant_code
  FROM fx_complete c LEFT JOIN fx_pollutant_names p USING (pollutant_name)
  WHERE c.country_code IN (SELECT country_code FROM fx_countries)
),
fx_extract_stations AS (
  SELECT station_code, country_code, trim(station_name) AS station_name,
         CASE WHEN altitude IN ('-999', '-999.0') THEN NULL ELSE TRY_CAST(altitude AS DOUBLE) END AS altitude,
         CASE WHEN activity_begin LIKE '%/%' THEN DATE '2020-02-01' END AS start_date
  FROM fx_known QUALIFY row_number() OVER (PARTITION BY station_code ORDER BY row_num) = 1
),
fx_extract_points AS (
  SELECT sampling_point_id, station_code, country_code, pollutant_code, row_num,
         CASE WHEN activity_begin LIKE '%/%' THEN TIMESTAMP '2020-02-01 00:00:00' END AS start_date
  FROM fx_known WHERE pollutant_code IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY sampling_point_id ORDER BY row_num) = 1
),
fx_extract_errors AS (
  SELECT row_num, format('line {}: station {} left out, its country ({}) is not registered', row_num, station_code, country_code) AS message
  FROM fx_complete WHERE country_code NOT IN (SELECT country_code FROM fx_countries)
  UNION ALL
  SELECT k.row_num, format('line {}: sampling point {} left out, its pollutant ({}) is not registered', k.row_num, k.sampling_point_id, k.pollutant_name)
  FROM fx_known k LEFT JOIN fx_extract_points a USING (sampling_point_id)
  WHERE k.pollutant_code IS NULL AND (a.row_num IS NULL OR k.row_num < a.row_num)
),
fx_raw AS (
  SELECT concat(s.country_code, lpad(CAST(s.s_suppkey AS VARCHAR), 5, '0')) AS station_code, s.country_code,
         concat(s.station_name, ' ', m.observation_id) AS station_name, s.station_type,
         m.data_capture AS altitude, CAST(m.observation_id AS BIGINT) AS seq
  FROM fx_measurements m JOIN fx_stations s USING (s_suppkey)
),
fx_daily AS (
  SELECT CAST(m.time AS DATE) AS day, sp.station_code, m.pollutant_code,
         round(avg(m.value), 6) AS avg_value, min(m.value) AS min_value, max(m.value) AS max_value,
         round(stddev_samp(m.value), 6) AS stddev_value, count(*) AS count,
         min(m.time) AS first_measurement, max(m.time) AS last_measurement
  FROM fx_measurements m JOIN fx_sampling_points sp ON m.sampling_point_id = sp.sampling_point_id
  WHERE m.validity >= 1 AND m.aggregation_type = 'hour'
  GROUP BY 1, 2, 3
),
fx_orders AS (
  SELECT *, concat('job-', strftime(o_orderdate, '%Y%m')) AS job_id,
         CAST(floor((day(o_orderdate) - 1) / 5) AS INT) AS batch_no,
         o_orderdate + to_seconds(o_orderkey % 60) AS begun,
         o_orderdate + to_seconds(o_orderkey % 60) + to_milliseconds((o_orderkey % 977 + 1) * 250) AS done,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'failed'
              ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'pending' ELSE 'running' END END AS state
  FROM orders
),
fx_files AS (
  SELECT job_id, batch_no, concat('https://host/', o_orderkey, '.parquet') AS url, state AS status,
         CASE WHEN state = 'completed' THEN CAST(round(o_totalprice) AS BIGINT) END AS measurements,
         CASE WHEN state = 'failed' THEN concat('HTTP ', 500 + o_orderkey % 5) END AS error,
         o_orderdate AS created_at,
         CASE WHEN state <> 'pending' THEN begun END AS started_at,
         CASE WHEN state IN ('completed', 'failed') THEN done END AS ended_at,
         CASE state WHEN 'pending' THEN o_orderdate WHEN 'running' THEN begun ELSE done END AS event_time
  FROM fx_orders
),
fx_aborts AS (
  SELECT job_id, batch_no, CAST(NULL AS VARCHAR) AS url, 'failed' AS status, CAST(NULL AS BIGINT) AS measurements,
         'batch aborted' AS error, o_orderdate AS created_at, begun AS started_at, done AS ended_at, done AS event_time
  FROM fx_orders WHERE o_orderpriority = '5-LOW' AND o_orderkey % 50 = 0
  QUALIFY row_number() OVER (PARTITION BY job_id, batch_no ORDER BY done DESC, o_orderkey DESC) = 1
),
fx_current AS (SELECT * FROM fx_files UNION ALL SELECT * FROM fx_aborts),
fx_batches AS (
  SELECT *, CASE WHEN aborted THEN 'failed' WHEN ended = urls THEN 'completed'
                 WHEN moved > 0 THEN 'running' ELSE 'pending' END AS status
  FROM (SELECT job_id, batch_no, count(url) AS urls,
               count(*) FILTER (url IS NOT NULL AND status = 'completed') AS succeeded,
               count(*) FILTER (url IS NOT NULL AND status = 'failed') AS failed,
               count(*) FILTER (url IS NOT NULL AND status IN ('completed', 'failed')) AS ended,
               count(*) FILTER (url IS NOT NULL AND status <> 'pending') AS moved,
               bool_or(url IS NULL) AS aborted,
               min(created_at) AS created_at, min(started_at) AS started_at, max(ended_at) AS last_end,
               max(error) FILTER (url IS NULL) AS error
        FROM fx_current GROUP BY 1, 2)
),
fx_batch_states AS (
  SELECT job_id, batch_no, status, urls, succeeded, failed, created_at, started_at,
         CASE WHEN status IN ('completed', 'failed') THEN last_end END AS ended_at, error
  FROM fx_batches
),
fx_jobs AS (
  SELECT DISTINCT job_id FROM fx_orders
  UNION ALL SELECT concat('job-', country_code) FROM fx_countries
),
fx_job_counts AS (
  SELECT j.job_id, count(b.status) AS total, count(*) FILTER (b.status = 'completed') AS completed,
         count(*) FILTER (b.status = 'failed') AS failed, count(*) FILTER (b.status = 'running') AS running,
         coalesce(sum(b.failed), 0) AS failed_urls
  FROM fx_jobs j LEFT JOIN fx_batch_states b USING (job_id) GROUP BY 1
),
fx_job_status AS (
  SELECT *, CASE WHEN total = 0 THEN 'created' WHEN completed = total THEN 'completed'
                 WHEN failed = total THEN 'failed' WHEN running > 0 THEN 'running'
                 WHEN completed + failed > 0 THEN 'running' ELSE 'pending' END AS status
  FROM fx_job_counts
)
"""

MEASURED = (
    "time, sampling_point_id, pollutant_code, value, unit, aggregation_type, validity, "
    "verification, data_capture, observation_id"
)
ALL_MEASUREMENTS = f"SELECT {MEASURED} FROM fx_measurements"
DAILY = (
    "day, station_code, pollutant_code, avg_value, min_value, max_value, stddev_value, count, "
    "first_measurement, last_measurement"
)
ALL_DAILY = f"SELECT {DAILY} FROM fx_daily"
UPSERTED = f"""
SELECT {MEASURED} FROM fx_upsert_batch
QUALIFY row_number() OVER (PARTITION BY time, sampling_point_id ORDER BY seq DESC) = 1
"""
COPIED = """
SELECT time, sampling_point_id, pollutant_code, value, unit, aggregation_type,
       CASE WHEN validity IS NOT NULL AND validity <> -99 THEN validity
            WHEN pollutant_code = 7 THEN 4 END AS validity,
       CASE WHEN verification > 1 THEN verification - 1 END AS verification, data_capture,
       CASE WHEN pollutant_code <> 10 THEN observation_id END AS observation_id
FROM fx_measurements
"""
FIRST_POINT = "(SELECT min(sampling_point_id) FROM fx_measurements)"
NUMBERED_URLS = "SELECT url, row_number() OVER (ORDER BY page_id) - 1 AS position FROM pages"

_SQL = {
    "read_measurement_parquet": ALL_MEASUREMENTS,
    "read_station_extract": """
        SELECT eoi_code, sampling_point, pollutant_name, altitude, activity_begin,
               coalesce(station_name, '') || chr(10) || '"' || eoi_code || '"' AS station_name, true AS numbered
        FROM fx_extract""",
    "read_url_manifest": NUMBERED_URLS,
    "manifest_csv_limit": "SELECT url FROM pages ORDER BY page_id LIMIT 20",
    "load_many_files": ALL_MEASUREMENTS,
    "load_dropped_rows": """
        SELECT count(*) FILTER (verification IS DISTINCT FROM 3) AS measurements,
               count(*) FILTER (verification = 3) AS dropped FROM fx_measurements""",
    "file_integrity": """
        SELECT 'parquet' AS kind, true AS is_parquet, count(*) AS rows FROM fx_measurements
        UNION ALL SELECT 'txt', false, 0""",
    "seed_lookups": """
        SELECT country_code, country_name, region FROM fx_countries
        UNION ALL SELECT * FROM (VALUES ('IT', 'Italy', 'Southern Europe'), ('PT', 'Portugal', 'Southern Europe'),
                                        ('ES', 'Spain', 'Southern Europe')) t
        WHERE col0 NOT IN (SELECT country_code FROM fx_countries)""",
    "read_from_local_copy": ALL_MEASUREMENTS,
    "bulk_insert": ALL_MEASUREMENTS,
    "bulk_insert_conflicts": """
        SELECT time, sampling_point_id, 'repeated' AS reason FROM fx_upsert_batch GROUP BY 1, 2 HAVING count(*) > 1
        UNION ALL SELECT time, sampling_point_id, 'exists' FROM fx_upsert_target""",
    "bulk_upsert": UPSERTED,
    "upsert_merge": UPSERTED,
    "bulk_copy": COPIED,
    "copy_text_export": f"""
        SELECT concat_ws(chr(9), strftime(time, '%Y-%m-%d %H:%M:%S') || '+00', sampling_point_id,
                         CAST(pollutant_code AS VARCHAR), CAST(value AS VARCHAR), unit, aggregation_type,
                         coalesce(CAST(validity AS VARCHAR), '\\N'), coalesce(CAST(verification AS VARCHAR), '\\N'),
                         CAST(data_capture AS VARCHAR), '\\N', coalesce(observation_id, '\\N')) AS line
        FROM ({COPIED}) c""",
    "write_in_batches": "SELECT count(*) AS rows, true AS within_limit FROM fx_measurements",
    "upsert_stations": """
        SELECT station_code, country_code,
               CASE WHEN station_type = 'traffic' THEN station_name
                    WHEN station_type = 'industrial' THEN upper(station_name) END AS station_name,
               CASE WHEN area_type = 'urban' THEN station_type END AS station_type,
               CASE WHEN area_type = 'urban' THEN area_type END AS area_type,
               CASE WHEN station_type <> 'traffic' THEN TIMESTAMP '2024-02-05 12:00:00' END AS updated_at,
               CASE WHEN station_type = 'traffic' THEN 'unchanged' WHEN area_type = 'urban' THEN 'updated'
                    ELSE 'created' END AS change
        FROM fx_stations WHERE area_type = 'urban' OR station_type <> 'traffic'""",
    "upsert_sampling_points": """
        SELECT sampling_point_id, station_code, CASE WHEN pollutant_code < 8 THEN country_code END AS country_code,
               pollutant_code, CASE WHEN pollutant_code > 1 THEN 'automatic' END AS instrument_type,
               CASE WHEN pollutant_code > 1 THEN TIMESTAMP '2024-02-05 12:00:00' END AS updated_at,
               CASE WHEN pollutant_code = 1 THEN 'unchanged' WHEN pollutant_code < 8 THEN 'updated'
                    ELSE 'created' END AS change
        FROM fx_sampling_points""",
    "upsert_pollutants": """
        SELECT CAST(p_partkey AS INT) AS pollutant_code,
               CASE WHEN p_size >= 20 THEN upper(p_name) ELSE p_name END AS pollutant_name,
               CASE WHEN p_size < 30 THEN p_type END AS pollutant_label,
               CASE WHEN p_size >= 20 THEN 'ug/m3' END AS unit,
               CASE WHEN p_size < 20 THEN 'unchanged' WHEN p_size < 30 THEN 'updated' ELSE 'created' END AS change
        FROM part""",
    "load_entities": """
        SELECT 'stations' AS table_name, count(DISTINCT station_code) AS rows FROM fx_raw
        UNION ALL SELECT 'sampling_points', count(DISTINCT sampling_point_id) FROM fx_measurements
        UNION ALL SELECT 'measurements', count(*) FROM fx_measurements""",
    "delete_time_range": f"""
        SELECT {MEASURED} FROM fx_measurements
        WHERE NOT (sampling_point_id = {FIRST_POINT}
                   AND time BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00')""",
    "cascade_delete": f"""
        SELECT {MEASURED} FROM fx_measurements
        WHERE NOT (pollutant_code = 8 AND left(sampling_point_id, 2) < 'NM')""",
    "truncate_daily": "SELECT count(*) AS rows_deleted, CAST(0 AS BIGINT) AS rows_left FROM fx_daily",
    "compact_old_partitions": ALL_MEASUREMENTS,
    "cleanup_processed": ALL_MEASUREMENTS,
    "insert_fk_refused": f"SELECT {MEASURED} FROM fx_measurements WHERE pollutant_code < 8",
    "harmonise_columns": ALL_MEASUREMENTS,
    "require_columns": "SELECT count(*) AS complete, CAST(0 AS BIGINT) AS without_time FROM fx_measurements",
    "require_not_null": f"""
        SELECT {MEASURED} FROM fx_measurements WHERE verification <> 3 AND pollutant_code <> 8""",
    "to_utc": """
        SELECT observation_id,
               CASE pollutant_code WHEN 5 THEN date_trunc('second', time) - INTERVAL 2 HOUR WHEN 7 THEN NULL
                    ELSE date_trunc('second', time) END AS from_text,
               time AS from_zoneless, time AS from_nanoseconds
        FROM fx_measurements""",
    "cast_measurements": """
        SELECT time, sampling_point_id, pollutant_code, CASE WHEN validity IS NULL OR validity <> -1 THEN value END AS value,
               unit, aggregation_type, validity, nullif(verification, 2) AS verification, data_capture, observation_id
        FROM fx_measurements""",
    "parse_extract_date": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN o_orderdate END AS parsed FROM orders""",
    "parse_iso_date": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders""",
    "parse_sentinel_float": """
        SELECT row_num, CASE WHEN altitude NOT IN ('-999', '-999.0') THEN TRY_CAST(altitude AS DOUBLE) END AS altitude
        FROM fx_extract""",
    "blank_to_null": """
        SELECT row_num, nullif(trim(station_name), '') AS station_name,
               nullif(trim(activity_begin), '') AS activity_begin FROM fx_extract""",
    "skip_incomplete_extract_rows": "SELECT row_num, station_code, sampling_point FROM fx_complete",
    "country_from_station_code": """
        SELECT row_num, CASE WHEN length(eoi_code) >= 2 THEN left(eoi_code, 2) END AS country_code FROM fx_extract""",
    "file_name_from_url": """
        SELECT page_id, CASE WHEN ends_with(url, '.parquet') THEN split_part(url, '/', -1)
                             ELSE split_part(url, '/', -1) || '.parquet' END AS file_name FROM pages""",
    "parse_sampling_point_id": """
        SELECT m.observation_id, p.country_code, p.station_code
        FROM fx_measurements m JOIN fx_sampling_points p USING (sampling_point_id)""",
    "prefix_sampling_point_id": """
        SELECT row_num, concat(country_code, '/', sampling_point) AS sampling_point_id FROM fx_complete""",
    "station_metadata_map": """
        SELECT station_code,
               format('{{"nat_code":"{}","network":"","network_name":"","timezone":"UTC+01"}}', station_code) AS metadata
        FROM fx_extract_stations""",
    "sampling_metadata_map": """
        SELECT sampling_point_id,
               format('{{"sample_id":"","process_id":"P{}","measurement_type":"","measurement_method":""}}', row_num) AS metadata
        FROM fx_extract_points""",
    "normalise_copy_flags": COPIED,
    "truncate_copy_time": "SELECT observation_id, date_trunc('second', time) AS time FROM fx_measurements",
    "valid_measurements": f"SELECT {MEASURED} FROM fx_measurements WHERE validity >= 1",
    "flag_classes": """
        SELECT observation_id, validity IN (1, 2, 3) AS valid, validity IN (-1, -99) AS invalid,
               validity = 1 AS strictly_valid FROM fx_measurements""",
    "min_data_capture": f"SELECT {MEASURED} FROM fx_measurements WHERE data_capture >= 75",
    "hourly_only": f"SELECT {MEASURED} FROM fx_measurements WHERE aggregation_type = 'hour'",
    "decode_flags": """
        SELECT observation_id,
               CASE validity WHEN -99 THEN 'Not valid (maintenance)' WHEN -1 THEN 'Not valid' WHEN 1 THEN 'Valid'
                    WHEN 2 THEN 'Valid (below detection)' WHEN 3 THEN 'Valid (below detection/LOQ)'
                    WHEN 4 THEN 'Valid (CCQM.O3.2019)' END AS validity_name,
               CASE verification WHEN 1 THEN 'Verified' WHEN 2 THEN 'Preliminary' WHEN 3 THEN 'Not verified' END AS verification_name,
               CASE validity WHEN -99 THEN 'Not valid (station maintenance)' WHEN -1 THEN 'Not valid' WHEN 1 THEN 'Valid'
                    WHEN 2 THEN 'Valid (below detection limit)' WHEN 3 THEN 'Valid (below detection limit + ...)' END AS validity_text,
               CASE verification WHEN 1 THEN 'Verified' WHEN 2 THEN 'Preliminary verified' WHEN 3 THEN 'Not verified' END AS verification_text,
               CASE verification WHEN 1 THEN 'E2a (Up-To-Date/UTD)' WHEN 2 THEN 'E1a (Verified)'
                    WHEN 3 THEN 'Airbase (Historical)' END AS dataset_text
        FROM fx_measurements""",
    "format_bytes": """
        SELECT o_orderkey,
               CASE WHEN b < 1024 THEN printf('%.1f B', b) WHEN b < 1024.0 ** 2 THEN printf('%.1f KB', b / 1024.0)
                    WHEN b < 1024.0 ** 3 THEN printf('%.1f MB', b / 1024.0 ** 2)
                    WHEN b < 1024.0 ** 4 THEN printf('%.1f GB', b / 1024.0 ** 3)
                    WHEN b < 1024.0 ** 5 THEN printf('%.1f TB', b / 1024.0 ** 4)
                    ELSE printf('%.1f PB', b / 1024.0 ** 5) END AS size
        FROM (SELECT o_orderkey, o_orderkey * pow(10.0::DOUBLE, o_orderkey % 14) AS b FROM orders)""",
    "slice_measurements": f"""
        SELECT {MEASURED} FROM fx_measurements
        WHERE left(sampling_point_id, 2) = 'NB' AND pollutant_code = 7
          AND time >= TIMESTAMP '2024-01-10 06:00:00' AND time < TIMESTAMP '2024-01-20 00:00:00'""",
    "slice_daily": f"""
        SELECT {DAILY} FROM fx_daily
        WHERE day BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' AND pollutant_code = 5 ORDER BY day DESC, station_code""",
    "stations_from_attributes": """
        SELECT station_code, country_code, station_name, station_type, altitude FROM fx_raw
        QUALIFY row_number() OVER (PARTITION BY station_code ORDER BY seq) = 1""",
    "stations_from_sampling_ids": "SELECT DISTINCT station_code, country_code FROM fx_sampling_points",
    "sampling_points_from_file": """
        SELECT sampling_point_id, pollutant_code, station_code, country_code FROM fx_sampling_points""",
    "stations_from_extract": "SELECT * FROM fx_extract_stations",
    "sampling_points_from_extract": "SELECT * EXCLUDE (row_num) FROM fx_extract_points",
    "parse_all": """
        SELECT (SELECT count(DISTINCT station_code) FROM fx_raw) AS stations,
               (SELECT count(*) FROM fx_sampling_points) AS sampling_points,
               (SELECT count(*) FROM fx_measurements) AS measurements""",
    "extract_errors": "SELECT row_num, message FROM fx_extract_errors ORDER BY row_num LIMIT 100",
    "all_extract_errors": "SELECT row_num, message FROM fx_extract_errors",
    "extract_summary": """
        SELECT (SELECT count(*) FROM fx_extract_stations) AS stations_processed,
               (SELECT count(altitude) FROM fx_extract_stations) AS stations_created,
               (SELECT count(*) - count(altitude) FROM fx_extract_stations) AS stations_updated,
               (SELECT count(*) FROM fx_extract_points) AS sampling_points_processed,
               (SELECT count(*) FROM fx_extract_points) AS sampling_points_created,
               CAST(0 AS BIGINT) AS sampling_points_updated,
               (SELECT count(*) FROM fx_extract_errors) AS errors""",
    "measurements_with_station": f"""
        SELECT {', '.join('m.' + c.strip() for c in MEASURED.split(','))}, p.station_code
        FROM fx_measurements m JOIN fx_sampling_points p USING (sampling_point_id)""",
    "known_country": """
        SELECT row_num, station_code FROM fx_complete WHERE country_code IN (SELECT country_code FROM fx_countries)""",
    "unknown_country": """
        SELECT row_num, station_code FROM fx_complete WHERE country_code NOT IN (SELECT country_code FROM fx_countries)""",
    "pollutant_code_by_name": """
        SELECT row_num, pollutant_name, pollutant_code FROM fx_extract LEFT JOIN fx_pollutant_names USING (pollutant_name)""",
    "fk_violations": """
        SELECT 'measurements' AS table_name, 'sampling_point_id' AS column_name, sampling_point_id AS key_value, count(*) AS rows
        FROM fx_measurements WHERE pollutant_code = 5 GROUP BY 3
        UNION ALL SELECT 'measurements', 'pollutant_code', '10', count(*) FROM fx_measurements WHERE pollutant_code = 10 HAVING count(*) > 0
        UNION ALL SELECT 'measurements', 'validity', '0', count(*) FROM fx_measurements WHERE validity IS NULL HAVING count(*) > 0
        UNION ALL SELECT 'sampling_points', 'station_code', station_code, count(*) FROM fx_sampling_points
        WHERE pollutant_code <> 5 AND station_code NOT IN (SELECT station_code FROM fx_stations WHERE station_type <> 'traffic') GROUP BY 3
        UNION ALL SELECT 'sampling_points', 'country_code', country_code, count(*) FROM fx_sampling_points
        WHERE pollutant_code <> 5 AND country_code IN (SELECT country_code FROM fx_countries WHERE region = 'EUROPE') GROUP BY 3
        UNION ALL SELECT 'sampling_points', 'pollutant_code', '10', count(*) FROM fx_sampling_points WHERE pollutant_code = 10 HAVING count(*) > 0
        UNION ALL SELECT 'stations', 'country_code', country_code, count(*) FROM fx_stations
        WHERE station_type <> 'traffic' AND country_code IN (SELECT country_code FROM fx_countries WHERE region = 'EUROPE') GROUP BY 3""",
    "daily_measurements": ALL_DAILY,
    "daily_measurements_preaggregated": ALL_DAILY,
    "refresh_daily": f"SELECT {DAILY} FROM fx_daily WHERE day >= DATE '2024-01-11' AND day < DATE '2024-01-20'",
    "refresh_daily_emptied_day": f"SELECT {DAILY} FROM fx_daily WHERE day <> DATE '2024-01-12'",
    "daily_status": """
        SELECT count(*) AS total_rows, min(day) AS first_day, max(day) AS last_day,
               count(DISTINCT station_code) AS stations, count(DISTINCT pollutant_code) AS pollutants FROM fx_daily""",
    "table_counts": """
        SELECT 'stations' AS table_name, count(*) AS rows FROM fx_stations
        UNION ALL SELECT 'sampling_points', count(*) FROM fx_sampling_points
        UNION ALL SELECT 'measurements', count(*) FROM fx_measurements""",
    "data_quality": """
        SELECT *, round(valid_measurements::DOUBLE / total_measurements * 100.0::DOUBLE, 2) AS valid_percentage,
               round(invalid_measurements::DOUBLE / total_measurements * 100.0::DOUBLE, 2) AS invalid_percentage
        FROM (SELECT count(*) AS total_measurements, count(*) FILTER (validity = 1) AS valid_measurements,
                     count(*) FILTER (validity IN (-1, -99)) AS invalid_measurements,
                     count(*) FILTER (validity IN (2, 3)) AS below_detection_measurements,
                     count(*) FILTER (validity = -99) AS maintenance_measurements FROM fx_measurements)""",
    "file_load_stats": """
        SELECT job_id, url, measurements, round(s, 6) AS seconds, round(measurements / s, 4) AS throughput
        FROM (SELECT *, (epoch_us(ended_at) - epoch_us(started_at)) / 1000000.0::DOUBLE AS s
              FROM fx_files WHERE status = 'completed')""",
    "batch_load_stats": """
        SELECT count(*) FILTER (status = 'completed') AS files_processed, CAST(0 AS BIGINT) AS stations,
               CAST(0 AS BIGINT) AS sampling_points, CAST(coalesce(sum(measurements), 0) AS BIGINT) AS measurements,
               count(*) FILTER (status = 'failed') AS errors FROM fx_files""",
    "batch_states": "SELECT * FROM fx_batch_states",
    "job_progress": """
        SELECT job_id, count(*) AS total_batches, count(*) FILTER (status = 'completed') AS batches_completed,
               count(*) FILTER (status = 'failed') AS batches_failed, count(*) FILTER (status = 'running') AS batches_running,
               count(*) FILTER (status = 'pending') AS batches_pending, CAST(sum(succeeded) AS BIGINT) AS urls_succeeded,
               CAST(sum(failed) AS BIGINT) AS urls_failed,
               round(count(*) FILTER (status = 'completed') / count(*) * 100.0::DOUBLE, 2) AS completion_pct
        FROM fx_batch_states GROUP BY 1""",
    "job_status": "SELECT job_id, status FROM fx_job_status",
    "job_status_strict": """
        SELECT job_id, CASE WHEN total > 0 AND completed + failed = total AND failed + failed_urls > 0 THEN 'failed'
                            ELSE status END AS status FROM fx_job_status""",
    "compaction_status": """
        SELECT count(DISTINCT CAST(time AS DATE)) AS total_partitions,
               count(DISTINCT CAST(time AS DATE)) FILTER (time < TIMESTAMP '2024-01-16 00:00:00') AS compacted_partitions,
               count(DISTINCT CAST(time AS DATE)) FILTER (time >= TIMESTAMP '2024-01-16 00:00:00') AS uncompacted_partitions,
               true AS compaction_enabled
        FROM fx_measurements""",
    "manifest_batches": f"""
        SELECT CAST(position // 50 AS INT) AS batch_no, CAST(count(*) AS INT) AS urls_count,
               string_agg(url, ' ' ORDER BY position) AS urls
        FROM ({NUMBERED_URLS}) u GROUP BY 1""",
    "load_estimate": """
        SELECT job_id, count(*) AS total_urls, round(count(*) / 150.0::DOUBLE * 2.4::DOUBLE, 1) AS with_3_batches,
               round(count(*) / 500.0::DOUBLE * 2.4::DOUBLE, 1) AS with_10_batches FROM fx_files GROUP BY 1""",
    "latest_by_sampling_point": f"""
        SELECT {MEASURED} FROM fx_measurements
        QUALIFY row_number() OVER (PARTITION BY sampling_point_id ORDER BY time DESC) <= 5""",
    "store_latest_by_sampling_point": f"""
        SELECT {MEASURED} FROM fx_measurements
        QUALIFY row_number() OVER (PARTITION BY sampling_point_id ORDER BY time DESC) <= 5""",
    "latest_of_one": f"""
        SELECT {MEASURED} FROM fx_measurements WHERE sampling_point_id = {FIRST_POINT} ORDER BY time DESC LIMIT 5""",
    "latest_overall": f"SELECT {MEASURED} FROM fx_measurements ORDER BY time DESC, sampling_point_id LIMIT 10",
    "store_latest": f"SELECT {MEASURED} FROM fx_measurements ORDER BY time DESC, sampling_point_id LIMIT 10",
    "store_latest_of_one": f"""
        SELECT {MEASURED} FROM fx_measurements WHERE sampling_point_id = {FIRST_POINT} ORDER BY time DESC LIMIT 5""",
    "store_late_rows": """
        SELECT CAST(time AS DATE) AS day, count(*) AS rows FROM fx_measurements
        WHERE CAST(time AS DATE) < DATE '2024-01-06' GROUP BY 1""",
    "get_all_stations": """
        SELECT station_code, country_code, station_name, TIMESTAMP '2024-02-05 12:00:00' AS created_at FROM fx_stations""",
    "storage_report_of_listing": """
        SELECT CAST((SELECT sum(o_custkey * 1000) FROM orders) AS BIGINT) AS table_bytes,
               sum(o_custkey * 5) > sum(o_custkey) AS compaction_effective,
               round(sum(o_custkey * 5) / sum(o_custkey), 2) AS compression_ratio,
               round((sum(o_custkey * 5) - sum(o_custkey)) / sum(o_custkey * 5) * 100, 2) AS space_saved_percentage
        FROM orders WHERE o_custkey % 3 > 0""",
    "recent_jobs": """
        SELECT job_id, min(created_at) AS created_at, count(*) AS total_urls FROM fx_files GROUP BY 1
        ORDER BY 2 DESC, 1 DESC LIMIT 50""",
    "get_by_key": f"""
        SELECT 'station' AS kind, station_code AS key FROM fx_stations WHERE station_code = 'NB/NB00001'
        UNION ALL SELECT 'sampling point', sampling_point_id FROM fx_sampling_points WHERE sampling_point_id = {FIRST_POINT}
        UNION ALL SELECT 'country', country_code FROM fx_countries WHERE country_code = 'NC'
        UNION ALL SELECT 'job', job_id FROM fx_jobs WHERE job_id = 'job-199703'""",
    "get_all": "SELECT country_code, country_name, region FROM fx_countries",
    "job_detail": """
        SELECT *, (epoch_us(ended_at) - epoch_us(started_at)) / 1000000.0::DOUBLE AS duration_seconds
        FROM fx_batch_states WHERE job_id = 'job-199703'""",
    "stream_daily": ALL_DAILY,
    "stream_daily_new_points": ALL_DAILY,
    "stream_daily_late_rows": ALL_DAILY,
    "refresh_daily_incremental": f"""
        SELECT CAST(m.time AS DATE) AS day, sp.station_code, m.pollutant_code, round(avg(v), 6) AS avg_value,
               min(v) AS min_value, max(v) AS max_value, round(stddev_samp(v), 6) AS stddev_value,
               count(*) AS count, min(m.time) AS first_measurement, max(m.time) AS last_measurement
        FROM (SELECT *, CASE WHEN pollutant_code = 8 THEN value + 1 ELSE value END AS v FROM fx_measurements) m
        JOIN fx_sampling_points sp ON m.sampling_point_id = sp.sampling_point_id
        WHERE m.validity >= 1 AND m.aggregation_type = 'hour'
          AND NOT (m.sampling_point_id = {FIRST_POINT}
                   AND m.time BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00')
        GROUP BY 1, 2, 3""",
    "refresh_policy": f"SELECT {DAILY} FROM fx_daily WHERE day >= DATE '2024-01-07' AND day < DATE '2024-02-04'",
    "stream_ingest": ALL_DAILY,
    "stream_ingest_mixed": ALL_MEASUREMENTS,
    "stream_ingest_unreadable_columns": f"""
        SELECT {MEASURED} FROM fx_measurements WHERE pollutant_code NOT IN (5, 7, 8)""",
    "late_rows": """
        SELECT CAST(time AS DATE) AS day, count(*) AS rows FROM fx_measurements
        WHERE CAST(time AS DATE) < DATE '2024-01-06' GROUP BY 1""",
    "ingest_ledger": "SELECT * FROM fx_current",
    "ingest_ledger_snapshot": "SELECT * FROM fx_current",
    "batch_duration": """
        SELECT job_id, batch_no, round((epoch_us(ended_at) - epoch_us(started_at)) / 1000000.0::DOUBLE, 6) AS duration_seconds
        FROM fx_batch_states""",
    "failed_files": """
        SELECT url, concat(url, ': ', coalesce(error, 'not loaded')) AS message FROM fx_files WHERE status <> 'completed'
        UNION ALL SELECT DISTINCT url, concat(url, ': not loaded') FROM pages""",
    "load_manifest_partial_failure": """
        SELECT 'good' AS kind, 'completed' AS status, count(*) AS measurements FROM fx_measurements WHERE pollutant_code >= 7
        UNION ALL SELECT 'repeated', 'failed', 0 UNION ALL SELECT 'junk', 'failed', 0 UNION ALL SELECT 'gone', 'failed', 0""",
    "load_manifest_ledger": """
        SELECT 'job-1' AS job_id, 'completed' AS status, CAST(NULL AS VARCHAR) AS error, count(*) AS measurements
        FROM fx_measurements
        UNION ALL SELECT 'job-1', 'failed', 'no local copy', 0""",
}


def all_sql() -> dict[str, str]:
    return {name: FX + sql for name, sql in _SQL.items()}
