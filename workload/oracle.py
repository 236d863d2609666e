"""SQL twins of the queries, for DuckDB on the same tables.

Averages are written as whole-number arithmetic, so that a value exactly half-way
between two hundredths is rounded up in both engines.
"""

from __future__ import annotations

from workload.adapters import TABLES as ALL_TABLES


def avg2(value: str, condition: str | None = None) -> str:
    """Average of non-negative whole numbers, rounded half up to two digits."""
    kept = f" FILTER (WHERE {condition})" if condition else ""
    total, n = f"sum({value}){kept}", f"count({value}){kept}"
    return f"((200 * {total} + {n}) // nullif(2 * {n}, 0))::DOUBLE / 100"


def avg_of(value: str, digits: int, source_digits: int = 2) -> str:
    """Average of values that carry two digits themselves, rounded half up."""
    unit, out = 10**source_digits, 10**digits
    total, n = f"sum(round({value} * {unit})::BIGINT)", f"count({value})"
    return f"((2 * {out} * {total} + {unit} * {n}) // nullif(2 * {unit} * {n}, 0))::DOUBLE / {out}"


TABLES = """
stations AS (
  SELECT 'EST-' || n_nationkey AS station_id, n_name AS nombre, n_nationkey / 4 AS latitud,
         n_regionkey / 4 AS longitud, r_name AS municipio, r_name IN ('ASIA', 'EUROPE') AS es_transbordo
  FROM nation JOIN region ON n_regionkey = r_regionkey),
stops AS (
  SELECT 'P-' || c_custkey AS stop_id, 'EST-' || c_nationkey AS station_id, c_mktsegment AS linea,
         c_nationkey + 1 AS orden,
         CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'metro'
              WHEN c_mktsegment = 'FURNITURE' THEN 'tranvia' ELSE 'cable' END AS tipo_servicio
  FROM customer WHERE c_acctbal >= 0),
dim AS (SELECT * FROM stops JOIN stations USING (station_id)),
trips AS (
  SELECT l_orderkey || '-' || l_linenumber AS trip_id, 'P-' || l_suppkey AS stop_id_origen,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 'P-' || o_custkey END AS stop_id_destino,
         l_returnflag || l_linestatus AS line, (l_quantity * 9)::INTEGER AS passenger_count,
         CASE WHEN l_discount > 0 THEN floor(l_extendedprice / 80)::INTEGER END AS delay_seconds,
         l_shipdate::DATE AS trip_date,
         ['05-06', '06-09', '09-12', '12-15', '15-18', '18-21', '21-23'][l_linenumber] AS hour_block,
         strftime(l_shipdate, '%m-%d') IN ('01-01', '05-01', '07-20', '08-07', '12-08', '12-25') AS is_holiday,
         'trips_' || year(l_shipdate) || CASE WHEN month(l_shipdate) <= 6 THEN '_S1' ELSE '_S2' END AS source_file,
         l_shipdate::TIMESTAMP AS ingestion_ts, l_shipdate::TIMESTAMP AS bronze_ingestion_ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ruled AS (
  SELECT *, CASE
      WHEN trip_id IS NULL OR stop_id_origen IS NULL OR stop_id_destino IS NULL OR line IS NULL THEN 'null_key'
      WHEN passenger_count IS NULL THEN 'null_measure'
      WHEN passenger_count NOT BETWEEN 1 AND 400 THEN 'passenger_range'
      WHEN delay_seconds IS NULL THEN 'null_measure'
      WHEN delay_seconds NOT BETWEEN 0 AND 1200 THEN 'delay_range'
      WHEN stop_id_origen = stop_id_destino THEN 'circular' END AS reason
  FROM trips),
silver AS (
  SELECT r.* EXCLUDE (reason),
    o.station_id AS station_id_origen, o.nombre AS nombre_origen, o.municipio AS municipio_origen,
    o.latitud AS latitud_origen, o.longitud AS longitud_origen, o.orden AS orden_origen,
    o.es_transbordo AS es_transbordo_origen,
    d.station_id AS station_id_destino, d.nombre AS nombre_destino, d.municipio AS municipio_destino,
    d.latitud AS latitud_destino, d.longitud AS longitud_destino, d.orden AS orden_destino,
    d.es_transbordo AS es_transbordo_destino,
    o.tipo_servicio, abs(d.orden - o.orden) AS n_stops,
    CASE WHEN d.orden > o.orden THEN 'forward' ELSE 'reverse' END AS trip_direction,
    CASE WHEN hour_block = '05-06' THEN 'madrugada' WHEN hour_block IN ('06-09', '09-12') THEN 'mañana'
         WHEN hour_block IN ('12-15', '15-18') THEN 'tarde' WHEN hour_block IN ('18-21', '21-23') THEN 'noche'
         ELSE 'desconocido' END AS time_of_day,
    hour_block IN ('06-09', '15-18') AS is_peak_hour, o.es_transbordo OR d.es_transbordo AS is_transfer_trip,
    CASE WHEN delay_seconds <= 30 THEN 'puntual' WHEN delay_seconds <= 120 THEN 'leve'
         WHEN delay_seconds <= 300 THEN 'moderado' ELSE 'severo' END AS delay_category
  FROM ruled r JOIN dim o ON o.stop_id = r.stop_id_origen JOIN dim d ON d.stop_id = r.stop_id_destino
  WHERE reason IS NULL)"""

MONTHS = (
    "['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto', "
    "'Septiembre', 'Octubre', 'Noviembre', 'Diciembre']"
)
DAYS = "['Lunes', 'Martes', 'Miércoles', 'Jueves', 'Viernes', 'Sábado', 'Domingo']"

GOLD = f"""
volume AS (
  SELECT station_id_origen AS station_id, nombre_origen AS nombre_estacion, municipio_origen AS municipio,
         hour_block, time_of_day, isodow(trip_date)::INTEGER AS day_of_week_num,
         {DAYS}[isodow(trip_date)] AS day_name, isodow(trip_date) >= 6 AS is_weekend,
         count(*) AS total_trips, sum(passenger_count)::BIGINT AS total_passengers,
         {avg2("passenger_count")} AS avg_passengers, max(passenger_count) AS max_passengers,
         {avg2("delay_seconds")} AS avg_delay_seconds
  FROM silver GROUP BY ALL),
delays AS (
  SELECT line, tipo_servicio, year(trip_date)::INTEGER AS year, month(trip_date)::INTEGER AS month,
         {MONTHS}[month(trip_date)] AS month_name, month(trip_date) IN (4, 5, 9, 10, 11) AS is_rainy_month,
         count(*) AS total_trips, sum(is_holiday::INTEGER)::BIGINT AS total_holiday_trips,
         {avg2("delay_seconds")} AS avg_delay_seconds,
         {avg2("delay_seconds", "is_peak_hour")} AS avg_delay_peak,
         {avg2("delay_seconds", "NOT is_peak_hour")} AS avg_delay_offpeak,
         {avg2("delay_seconds", "is_holiday")} AS avg_delay_holiday,
         {avg2("delay_seconds", "NOT is_holiday")} AS avg_delay_nonholiday
  FROM silver GROUP BY ALL),
limits AS (SELECT line, quantile_disc(passenger_count, 0.9)::INTEGER AS p90_threshold FROM silver GROUP BY line),
shares AS (
  SELECT line, tipo_servicio, hour_block, time_of_day, count(*) AS total_trips,
         count(*) FILTER (WHERE passenger_count > p90_threshold) AS high_demand_trips,
         ((20000 * count(*) FILTER (WHERE passenger_count > p90_threshold) + count(*)) // (2 * count(*)))::DOUBLE / 100
           AS pct_high_demand,
         {avg2("passenger_count")} AS avg_passengers, max(p90_threshold) AS p90_line_threshold,
         max(passenger_count) AS max_passengers
  FROM silver JOIN limits USING (line) GROUP BY ALL)"""

EVENTS = f"""
messages AS (
  SELECT event_id::VARCHAR AS event_id,
         CASE event_type WHEN 'click' THEN 'arrival' WHEN 'view' THEN 'departure' WHEN 'error' THEN 'delay_alert'
              WHEN 'purchase' THEN 'capacity_alert' ELSE '_invalid' END AS event_type,
         'P-' || user_id AS stop_id,
         ['A', 'B', 'TA', 'K', 'J', 'P', 'H', 'M', 'L'][regexp_extract(props, '(\\d+)', 1)::INTEGER % 9 + 1] AS line,
         'V-' || regexp_extract(props, '(\\d+)', 1) AS vehicle_id,
         floor(value * 3)::INTEGER AS passenger_count, floor(value * 2)::INTEGER AS delay_seconds,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, date_trunc('millisecond', ts) AS event_time
  FROM events),
ev AS (SELECT * FROM messages WHERE event_type <> '_invalid'),
enriched AS (
  SELECT ev.*, coalesce(dim.station_id, ev.stop_id) AS station_id, coalesce(dim.nombre, ev.stop_id) AS stop_name
  FROM ev LEFT JOIN dim ON dim.stop_id = ev.stop_id),
newest AS (SELECT max(event_time) AS now FROM ev),
occupancy AS (
  SELECT station_id, max(stop_name) AS stop_name,
         array_to_string(list_sort(list(DISTINCT line)), ',') AS lines_serving,
         date_trunc('hour', event_time) AS window_start, date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end,
         max(passenger_count) AS max_vehicle_occupancy, {avg2("passenger_count")} AS avg_vehicle_occupancy,
         count(*) AS event_count
  FROM enriched WHERE event_type IN ('arrival', 'departure')
  GROUP BY station_id, date_trunc('hour', event_time)
  HAVING date_trunc('hour', event_time) + INTERVAL 1 HOUR <= (SELECT now FROM newest) - INTERVAL 120 SECOND),
line_delays AS (
  SELECT line, CASE WHEN line IN ('K', 'J', 'L', 'H', 'M', 'P') THEN 'cable' WHEN line = 'TA' THEN 'tranvia'
              ELSE 'metro' END AS tipo_servicio,
         date_trunc('hour', event_time) AS window_start, date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end,
         {avg2("delay_seconds")} AS avg_delay_seconds, max(delay_seconds) AS max_delay_seconds,
         count(*) AS vehicles_seen, count(*) FILTER (WHERE delay_seconds > 300) AS vehicles_delayed,
         max(delay_seconds) > 300 AS high_delay
  FROM ev WHERE delay_seconds >= 0
  GROUP BY line, date_trunc('hour', event_time)
  HAVING date_trunc('hour', event_time) + INTERVAL 1 HOUR <= (SELECT now FROM newest) - INTERVAL 120 SECOND),
last_alert AS (
  SELECT *, row_number() OVER (PARTITION BY station_id, date_trunc('hour', event_time)
                               ORDER BY event_time DESC, event_id DESC) AS back_hour,
         row_number() OVER (PARTITION BY station_id, time_bucket(INTERVAL 10 MINUTE, event_time)
                            ORDER BY event_time DESC, event_id DESC) AS back_ten
  FROM enriched WHERE event_type IN ('delay_alert', 'capacity_alert')),
alerts_hour AS (
  SELECT station_id, max(stop_name) AS stop_name, max(line) FILTER (WHERE back_hour = 1) AS line,
         date_trunc('hour', event_time) AS window_start, date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end,
         count(*) FILTER (WHERE event_type = 'delay_alert') AS delay_alerts,
         count(*) FILTER (WHERE event_type = 'capacity_alert') AS capacity_alerts, count(*) AS total_alerts
  FROM last_alert GROUP BY station_id, date_trunc('hour', event_time)
  HAVING date_trunc('hour', event_time) + INTERVAL 1 HOUR <= (SELECT now FROM newest) - INTERVAL 120 SECOND),
alerts AS (
  SELECT station_id, max(stop_name) AS stop_name, max(line) FILTER (WHERE back_ten = 1) AS line,
         time_bucket(INTERVAL 10 MINUTE, event_time) AS window_start,
         time_bucket(INTERVAL 10 MINUTE, event_time) + INTERVAL 10 MINUTE AS window_end,
         count(*) FILTER (WHERE event_type = 'delay_alert') AS delay_alerts,
         count(*) FILTER (WHERE event_type = 'capacity_alert') AS capacity_alerts, count(*) AS total_alerts
  FROM last_alert GROUP BY station_id, time_bucket(INTERVAL 10 MINUTE, event_time)
  HAVING time_bucket(INTERVAL 10 MINUTE, event_time) + INTERVAL 10 MINUTE
         <= (SELECT now FROM newest) - INTERVAL 120 SECOND),
latest AS (SELECT * FROM occupancy
           QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY window_end DESC) = 1),
latest_delays AS (SELECT * FROM line_delays QUALIFY row_number() OVER (PARTITION BY line ORDER BY window_end DESC) = 1),
rollup_day AS (
  SELECT station_id, arg_min(stop_name, window_end) AS stop_name, sum(delay_alerts)::BIGINT AS delay_alerts,
         sum(capacity_alerts)::BIGINT AS capacity_alerts, sum(total_alerts)::BIGINT AS total_alerts,
         count(*) AS windows_seen, min(window_end) AS first_window, max(window_end) AS last_window
  FROM alerts WHERE window_end >= (SELECT now FROM newest) - INTERVAL 1 DAY GROUP BY station_id),
current_side AS (SELECT * FROM latest WHERE window_end >= (SELECT now FROM newest) - INTERVAL 1 DAY),
history_side AS (
  SELECT volume.* FROM volume, newest
  WHERE day_of_week_num = isodow(now) AND total_trips >= 5 AND hour_block =
    CASE WHEN hour(now) < 6 THEN '05-06' WHEN hour(now) < 9 THEN '06-09' WHEN hour(now) < 12 THEN '09-12'
         WHEN hour(now) < 15 THEN '12-15' WHEN hour(now) < 18 THEN '15-18' WHEN hour(now) < 21 THEN '18-21'
         ELSE '21-23' END),
common AS (SELECT c.*, h.avg_passengers, h.total_trips FROM current_side c JOIN history_side h USING (station_id)),
network AS (
  SELECT coalesce(avg(avg_vehicle_occupancy), 0) AS mu_s, coalesce(stddev_pop(avg_vehicle_occupancy), 0) AS sigma_s,
         coalesce(avg(avg_passengers), 0) AS mu_b, coalesce(stddev_pop(avg_passengers), 0) AS sigma_b FROM common),
scored AS (
  SELECT *, CASE WHEN sigma_s > 1e-6 THEN (avg_vehicle_occupancy - mu_s) / sigma_s ELSE 0 END AS zs,
         CASE WHEN sigma_b > 1e-6 THEN (avg_passengers - mu_b) / sigma_b ELSE 0 END AS zb
  FROM common, network),
ranking AS (
  SELECT station_id, stop_name, lines_serving AS lines, contains(lines_serving, ',') AS multimodal,
         round(avg_vehicle_occupancy, 1) AS now_val, round(avg_passengers, 1) AS hist_val, round(zs, 2) AS z_stream,
         round(zb, 2) AS z_hist, round(zs - zb, 2) AS delta_z, event_count AS n_stream, total_trips AS n_hist_trips,
         strftime(window_end, '%H:%M:%SZ') AS window_end,
         CASE WHEN round(zs - zb, 2) > 1 THEN '▲▲' WHEN round(zs - zb, 2) > 0.5 THEN '▲'
              WHEN round(zs - zb, 2) < -1 THEN '▼▼' WHEN round(zs - zb, 2) < -0.5 THEN '▼' ELSE '' END AS flag
  FROM scored),
moves AS (
  SELECT ev.*, CASE WHEN event_type = 'departure' THEN delay_seconds ELSE 0 END AS seg,
         event_type = 'arrival' AND stop_id IN (
           SELECT stop_id FROM stops JOIN (SELECT linea, min(orden) AS lo, max(orden) AS hi FROM stops GROUP BY linea)
             USING (linea) WHERE orden IN (lo, hi)) AS terminal
  FROM ev WHERE event_type IN ('arrival', 'departure')),
runs AS (
  SELECT *, coalesce(sum(terminal::INTEGER) OVER (PARTITION BY vehicle_id ORDER BY event_time, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM moves),
sums AS (
  SELECT *, sum(seg) OVER (PARTITION BY vehicle_id, run ORDER BY event_time, event_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM runs),
edges AS (
  SELECT vehicle_id, line, stop_id, event_id, event_time, total::BIGINT AS accumulated_delay FROM sums
  WHERE total > 300 AND event_type = 'departure'
  QUALIFY row_number() OVER (PARTITION BY vehicle_id, run ORDER BY event_time, event_id) = 1)"""


def _batch(body: str) -> str:
    return f"WITH {TABLES.strip()},{GOLD}\n{body}"


def _events(body: str) -> str:
    return f"WITH {TABLES.strip()},{GOLD},{EVENTS}\n{body}"


STATUS_COUNT = "SELECT o_orderpriority, o_orderstatus, count(*) AS n_orders, max(o_orderdate) AS last_order FROM orders"

TOP_SLOT_COLUMNS = (
    "station_id, nombre_estacion, municipio, hour_block, day_name, total_trips, avg_passengers, avg_delay_seconds"
)

_K = r"regexp_extract(props, '(\d+)', 1)::INTEGER"

BATCH_SQL = {
    "silver_clean": _batch("SELECT * FROM silver"),
    "discard_accounting": _batch(
        """, flags AS (
  SELECT reason, o.stop_id IS NULL AS no_origin, d.stop_id IS NULL AS no_dest
  FROM ruled r LEFT JOIN dim o ON o.stop_id = r.stop_id_origen LEFT JOIN dim d ON d.stop_id = r.stop_id_destino)
SELECT 'null_key' AS reason, count(*) FILTER (WHERE reason = 'null_key') AS discarded, false AS upstream_alert FROM flags
UNION ALL SELECT 'passenger_range', count(*) FILTER (WHERE reason = 'passenger_range'), false FROM flags
UNION ALL SELECT 'delay_range', count(*) FILTER (WHERE reason = 'delay_range'), false FROM flags
UNION ALL SELECT 'null_measure', count(*) FILTER (WHERE reason = 'null_measure'), false FROM flags
UNION ALL SELECT 'circular', count(*) FILTER (WHERE reason = 'circular'),
                 count(*) FILTER (WHERE reason = 'circular') > 0 FROM flags
UNION ALL SELECT 'orphan_origin', count(*) FILTER (WHERE reason IS NULL AND no_origin),
                 count(*) FILTER (WHERE reason IS NULL AND no_origin) > 0 FROM flags
UNION ALL SELECT 'orphan_dest', count(*) FILTER (WHERE reason IS NULL AND no_dest),
                 count(*) FILTER (WHERE reason IS NULL AND no_dest) > 0 FROM flags
UNION ALL SELECT '_read', count(*), false FROM flags
UNION ALL SELECT '_kept', count(*) FILTER (WHERE reason IS NULL AND NOT no_origin AND NOT no_dest), false FROM flags
UNION ALL SELECT '_discarded', count(*) FILTER (WHERE reason IS NOT NULL OR no_origin OR no_dest), false FROM flags"""
    ).replace("\n, flags", ", flags"),
    "reject_reasons": _batch("SELECT source_file, reason, count(*) AS trips FROM ruled GROUP BY ALL"),
    "role_playing_join": _batch(
        """SELECT o.nombre AS nombre_origen, d.nombre AS nombre_destino, o.tipo_servicio, count(*) AS trips,
  sum(passenger_count)::BIGINT AS passengers
FROM trips LEFT JOIN dim o ON o.stop_id = stop_id_origen LEFT JOIN dim d ON d.stop_id = stop_id_destino GROUP BY ALL"""
    ),
    "dim_build": _batch("SELECT * FROM dim"),
    "batch_summary": _batch(
        """SELECT source_file, count(*) AS rows, min(trip_date) AS first_date, max(trip_date) AS last_date,
  count(DISTINCT line) AS distinct_line, min(bronze_ingestion_ts) AS first_ingested FROM trips GROUP BY source_file"""
    ),
    "missing_keys": _batch("SELECT count(*) FILTER (WHERE trip_id IS NULL) AS missing_trip_ids FROM trips"),
    "sample_trips": _batch(
        """SELECT trip_id, line, tipo_servicio, nombre_origen, nombre_destino, n_stops, trip_direction, time_of_day,
  is_peak_hour, is_transfer_trip, delay_category, passenger_count, delay_seconds FROM silver
ORDER BY ALL LIMIT 10"""
    ),
    "station_volume": _batch("SELECT * FROM volume"),
    "line_month_delay": _batch("SELECT * FROM delays"),
    "line_p90": _batch("SELECT * FROM limits"),
    "high_demand_share": _batch("SELECT * FROM shares"),
    "service_season_rollup": _batch(
        f"""SELECT tipo_servicio, is_rainy_month, {avg_of("avg_delay_seconds", 2)} AS avg_delay,
  {avg_of("avg_delay_peak", 2)} AS avg_delay_peak, sum(total_trips)::BIGINT AS total_trips FROM delays GROUP BY ALL"""
    ),
    "line_threshold_rollup": _batch(
        f"""SELECT line, tipo_servicio, max(p90_line_threshold) AS p90_threshold,
  {avg_of("avg_passengers", 1)} AS avg_passengers_all_slots FROM shares GROUP BY ALL"""
    ),
    "station_rollup": _batch(
        f"""SELECT station_id, nombre_estacion, {avg_of("avg_passengers", 1)} AS avg_pax_global,
  sum(total_trips)::BIGINT AS total_trips_global FROM volume GROUP BY station_id, nombre_estacion
ORDER BY avg_pax_global DESC, station_id LIMIT 10"""
    ),
    "top_station_slots": _batch(
        f"""SELECT {TOP_SLOT_COLUMNS} FROM volume WHERE hour_block IN ('06-09', '15-18') AND NOT is_weekend
ORDER BY avg_passengers DESC, station_id, hour_block, day_of_week_num LIMIT 10"""
    ),
    "top_demand_slots": _batch(
        """SELECT * EXCLUDE (max_passengers) FROM shares
ORDER BY pct_high_demand DESC, line, tipo_servicio, hour_block, time_of_day LIMIT 10"""
    ),
    "line_evolution": _batch("SELECT * EXCLUDE (line) FROM delays WHERE line = 'AF'"),
    "calendar_enrich": f"""SELECT event_id,
  CASE WHEN hour(ts) < 6 THEN '05-06' WHEN hour(ts) < 9 THEN '06-09' WHEN hour(ts) < 12 THEN '09-12'
       WHEN hour(ts) < 15 THEN '12-15' WHEN hour(ts) < 18 THEN '15-18' WHEN hour(ts) < 21 THEN '18-21'
       ELSE '21-23' END AS hour_block,
  CASE WHEN hour(ts) < 6 THEN 'madrugada' WHEN hour(ts) < 12 THEN 'mañana' WHEN hour(ts) < 18 THEN 'tarde'
       ELSE 'noche' END AS time_of_day,
  hour(ts) BETWEEN 6 AND 8 OR hour(ts) BETWEEN 15 AND 17 AS is_peak_hour,
  year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, {MONTHS}[month(ts)] AS month_name,
  month(ts) IN (4, 5, 9, 10, 11) AS is_rainy_month, isodow(ts)::INTEGER AS day_of_week_num,
  {DAYS}[isodow(ts)] AS day_name, isodow(ts) >= 6 AS is_weekend,
  ts::DATE IN (DATE '2024-01-01', DATE '2024-01-08', DATE '2024-03-25', DATE '2024-03-28', DATE '2024-03-29',
    DATE '2024-05-01', DATE '2024-05-13', DATE '2024-06-03', DATE '2024-06-10', DATE '2024-07-01', DATE '2024-07-20',
    DATE '2024-08-07', DATE '2024-08-19', DATE '2024-10-14', DATE '2024-11-04', DATE '2024-11-11', DATE '2024-12-08',
    DATE '2024-12-25') AS is_holiday
FROM events""",
    "orphan_stops": _batch(
        """SELECT stop_id_destino AS stop_id, count(*) AS trips FROM trips
WHERE stop_id_destino IS NOT NULL AND stop_id_destino NOT IN (SELECT stop_id FROM stops) GROUP BY ALL"""
    ),
    "childless_parents": """SELECT c_custkey AS user_id, c_name FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
    "lines_per_station": _batch(
        """SELECT station_id, nombre, array_to_string(list_sort(list(DISTINCT linea)), ',') AS lines,
  count(DISTINCT linea) > 1 AS multimodal FROM dim GROUP BY station_id, nombre"""
    ),
    "terminal_stops": _batch(
        """SELECT stop_id, linea, orden FROM stops
JOIN (SELECT linea, min(orden) AS lo, max(orden) AS hi FROM stops GROUP BY linea) USING (linea)
WHERE orden IN (lo, hi)"""
    ),
    "transfer_stations": _batch("SELECT * FROM stations WHERE es_transbordo"),
    "distinct_lines": _batch("SELECT DISTINCT line, hour_block FROM trips"),
    "sequence_check": """SELECT l_orderkey, count(*) AS n, min(l_linenumber) AS first, max(l_linenumber) AS last,
  CASE WHEN count(*) <> count(DISTINCT l_linenumber) THEN 'duplicate'
       WHEN min(l_linenumber) <> 1 OR max(l_linenumber) <> count(*) THEN 'gap' ELSE 'none' END AS problem
FROM lineitem GROUP BY l_orderkey""",
    "sequence_offenders": """WITH numbers AS (
  SELECT l_orderkey, l_linenumber, count(*) AS times,
         lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS previous
  FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT l_orderkey, l_linenumber, 'duplicate' AS problem FROM numbers WHERE times > 1
UNION ALL SELECT l_orderkey, l_linenumber, 'gap_before' FROM numbers
WHERE l_linenumber <> 1 AND previous IS DISTINCT FROM l_linenumber - 1""",
    "catalog_checks": _batch(
        """, found AS (
SELECT 'stations:latitud' AS "check", true AS ok, 'double' AS observed, 'double' AS expected
UNION ALL SELECT 'stations:es_transbordo', true, 'boolean', 'boolean'
UNION ALL SELECT 'stops:orden', true, 'int', 'int|bigint'
UNION ALL SELECT 'stations:count', count(*) = 25, count(*)::VARCHAR, '25' FROM stations
UNION ALL SELECT 'stations:transfer', count(*) = 10, count(*)::VARCHAR, '10' FROM stations WHERE es_transbordo
UNION ALL SELECT 'stops:station', count(*) = 0, count(*)::VARCHAR, '0' FROM stops
  WHERE station_id NOT IN (SELECT station_id FROM stations)
UNION ALL SELECT 'stations:stop', count(*) = 0, count(*)::VARCHAR, '0' FROM stations
  WHERE station_id NOT IN (SELECT station_id FROM stops)
UNION ALL SELECT 'orders:customer', count(*) = 0, count(*)::VARCHAR, '0' FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
UNION ALL SELECT 'stations:nombre:' || name, name IN (SELECT nombre FROM stations),
  CASE WHEN name IN (SELECT nombre FROM stations) THEN 'present' ELSE 'missing' END, 'present'
  FROM (VALUES ('NATION_0'), ('NATION_24'), ('NATION_25')) v(name)
UNION ALL SELECT 'nonempty:orders', count(*) > 0, count(*)::VARCHAR, '>0' FROM orders
UNION ALL SELECT 'nonempty:customer', count(*) > 0, count(*)::VARCHAR, '>0' FROM customer)
SELECT "check", CASE WHEN ok THEN 'OK' ELSE 'FAIL' END AS status, observed, expected FROM found"""
    ).replace("\n, found", ", found"),
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS n FROM {t}"
        for t in ALL_TABLES
    ),
    "as_of_version": f"{STATUS_COUNT} WHERE o_orderstatus IN ('F', 'O') GROUP BY ALL",
    "as_of_timestamp": f"{STATUS_COUNT} WHERE o_orderstatus = 'F' GROUP BY ALL",
    "as_of_daily_counts": """SELECT o_orderdate::DATE AS day, count(*) AS n FROM orders
WHERE o_orderstatus = 'F' GROUP BY ALL""",
    "version_delta": """SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS rows_before, count(*) AS rows_after,
  count(*) FILTER (WHERE o_orderstatus <> 'F') AS delta FROM orders""",
    "snapshot_history": """SELECT (row_number() OVER (ORDER BY o_orderstatus))::INTEGER AS snapshot_id,
  TIMESTAMP '2024-01-01 00:00:00' + row_number() OVER (ORDER BY o_orderstatus) * INTERVAL 1 MILLISECOND AS committed_at,
  'append' AS operation, count(*) AS added_records,
  (sum(count(*)) OVER (ORDER BY o_orderstatus))::BIGINT AS total_records, 'orders_' || o_orderstatus AS batch_key
FROM orders GROUP BY o_orderstatus""",
    "schema_evolution": """SELECT
  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'WX-' || o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'Lluvioso'
       WHEN o_orderpriority = '2-HIGH' THEN 'Tormenta' WHEN o_orderpriority = '3-MEDIUM' THEN 'Nublado'
       ELSE 'Soleado' END AS weather_condition,
  count(*) AS n FROM orders GROUP BY 1, 2""",
    "full_refresh": """SELECT CASE WHEN o_orderstatus = 'F' THEN 'before' ELSE 'now' END AS version, o_orderstatus,
  count(*) AS n FROM orders GROUP BY ALL""",
    "catalog_files": _batch(
        """SELECT 'inferred:' || c AS "check", s AS status, o AS observed, e AS expected FROM (VALUES
  ('station_id', 'OK', 'string', 'string'), ('latitud', 'OK', 'double', 'double'), ('es_transbordo', 'OK', 'boolean', 'boolean'),
  ('nombre', 'FAIL', 'string', 'int')) v(c, s, o, e)
UNION ALL SELECT station_id || ' ' || nombre, 'read', count(*) || ' ' || sum(orden), max(latitud)::VARCHAR
FROM stops JOIN stations USING (station_id) GROUP BY station_id, nombre"""
    ),
    "freshness_states": """WITH n AS (SELECT max(o_orderdate)::TIMESTAMP AS newest FROM orders)
SELECT t AS "table", s AS status, CASE WHEN k THEN newest END AS newest FROM n, (VALUES ('fresh', 'OK', true), ('stale', 'STALE', true),
  ('empty', 'EMPTY', false), ('no_time', 'NO_TS', false), ('missing', 'MISSING', false), ('present', 'OK_EXISTS', true),
  ('vacant', 'EMPTY', false), ('gone', 'MISSING', false)) v(t, s, k)""",
    "busiest_in_order": _batch(
        f"""SELECT row_number() OVER () AS place, * FROM (SELECT {TOP_SLOT_COLUMNS} FROM volume
WHERE hour_block IN ('06-09', '15-18') AND NOT is_weekend
ORDER BY avg_passengers DESC, station_id, hour_block, day_of_week_num LIMIT 10)"""
    ),
    "column_diff": """WITH n AS (SELECT count(*) AS n FROM orders)
SELECT 'o_orderkey' AS "column", 'string' AS older, 'bigint' AS newer FROM n
UNION ALL SELECT 'weather_condition', NULL, 'string' FROM n""",
    "idempotent_ingest": _batch(
        """SELECT line, source_file, count(*) AS trips, sum(passenger_count)::BIGINT AS passengers,
  sum(delay_seconds)::BIGINT AS delay_seconds, count(*) FILTER (WHERE is_holiday) AS holiday_trips,
  max(trip_date) AS last_date FROM trips GROUP BY line, source_file"""
    ),
    "lakehouse_refresh": _batch("SELECT * FROM delays"),
    "namespace_tables": """SELECT 'nation' AS "table", c AS col_name, t AS data_type, n
FROM (VALUES ('n_nationkey', 'int'), ('n_name', 'string'), ('n_regionkey', 'int')) AS v(c, t), (SELECT count(*) AS n FROM nation)
UNION ALL SELECT 'region', c, t, n FROM (VALUES ('r_regionkey', 'int'), ('r_name', 'string')) AS v(c, t), (SELECT count(*) AS n FROM region)""",
    "access_paths": """SELECT sum(o_custkey)::BIGINT AS keys, true AS pushed, true AS one_partition,
  'struct<o_custkey:bigint,o_orderpriority:string>' AS columns FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'""",
    "load_history": _batch(
        f""", files AS (
  SELECT CASE WHEN line LIKE '%F' THEN 1 WHEN line = 'RO' THEN 2 ELSE 3 END AS n, count(*) AS added FROM trips GROUP BY 1)
SELECT (row_number() OVER (ORDER BY n))::INTEGER AS snapshot_id,
  TIMESTAMP '2024-01-01 00:00:00' + n * INTERVAL 1 MILLISECOND AS committed_at, 'append' AS operation, added AS added_records,
  (sum(added) OVER (ORDER BY n))::BIGINT AS total_records, ['closed', 'returned', 'open'][n] || '.csv' AS batch_key
FROM files"""
    ).replace("\n, files", ", files"),
    "load_as_of": _batch("SELECT trip_date AS day, count(*) AS n FROM trips WHERE line LIKE '%F' OR line = 'RO' GROUP BY trip_date"),
    "merged_volume": _batch("SELECT * FROM volume"),
    "merged_delays": _batch("SELECT * FROM delays"),
    "merged_demand": _batch("SELECT * FROM shares"),
    "merged_sketches": _batch(
        "SELECT line, count(*) AS trips, true AS threshold_within, true AS origins_within, true AS trip_ids_within FROM silver GROUP BY line"
    ),
    "slot_ranking": _batch(
        """SELECT station_id, hour_block, day_of_week_num, avg_passengers,
  row_number() OVER (ORDER BY avg_passengers DESC, station_id, hour_block, day_of_week_num) AS place,
  rank() OVER (PARTITION BY hour_block ORDER BY avg_passengers DESC) AS rank_in_block FROM volume"""
    ),
}

STREAM_SQL = {
    "event_json_parse": _events("SELECT * FROM messages"),
    "event_json_damaged": rf"""WITH numbered AS (SELECT *, {_K} AS k FROM events)
SELECT CASE WHEN k < 30 OR k BETWEEN 40 AND 49 THEN '' ELSE event_id::VARCHAR END AS event_id,
  CASE WHEN k < 30 OR k BETWEEN 40 AND 59 THEN '_invalid' WHEN k < 40 THEN 'click' ELSE event_type END AS event_type,
  '' AS stop_id, '' AS line, '' AS vehicle_id,
  CASE WHEN k BETWEEN 30 AND 39 THEN k WHEN k BETWEEN 50 AND 59 THEN 1 WHEN k >= 60 THEN k ELSE 0 END AS passenger_count,
  CASE WHEN k >= 60 THEN trunc(value)::INTEGER ELSE 0 END AS delay_seconds,
  '' AS timestamp, date_trunc('millisecond', ts) AS event_time
FROM numbered""",
    "event_times": """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso,
  strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%gZ') AS iso_ms, date_trunc('second', ts) AS parsed
FROM events""",
    "occupancy_stream": _events("SELECT * FROM occupancy"),
    "delay_stream": _events("SELECT * FROM line_delays"),
    "alert_stream": _events("SELECT * FROM alerts_hour"),
    "occupancy_latest": _events("SELECT * FROM latest"),
    "event_type_running_counts": _events("SELECT event_type, count(*) AS events FROM ev GROUP BY event_type"),
    "delay_edge_alerts": _events("SELECT * FROM edges"),
    "delay_edge_alerts_stream": _events("SELECT * FROM edges"),
    "delay_edge_alerts_carried": _events("SELECT * FROM edges"),
    "late_rows": _events(
        """, cuts AS (
  SELECT (epoch_us(min(ts)) + epoch_us(max(ts))) // 2 AS half, epoch_us(max(ts)) - (epoch_us(max(ts)) - epoch_us(min(ts))) // 100 AS last
  FROM events),
timed AS (
  SELECT e.*, epoch_us(strptime(timestamp, '%Y-%m-%dT%H:%M:%S.%fZ')) AS us, date_trunc('hour', event_time) AS hour
  FROM enriched e),
closed AS (SELECT max(event_time) - INTERVAL 120 SECOND AS until FROM timed, cuts WHERE us >= half AND us < last),
late AS (SELECT timed.* FROM timed, cuts, closed WHERE us < half AND hour + INTERVAL 1 HOUR <= until),
groups AS (
  SELECT hour, CASE WHEN event_type IN ('arrival', 'departure') THEN 'occupancy' ELSE 'alerts' END AS t, station_id AS k, stop_name AS n FROM late
  UNION SELECT hour, CASE WHEN delay_seconds >= 0 THEN 'delays' END, CASE WHEN delay_seconds >= 0 THEN line END, NULL FROM late)
SELECT 'operational' AS query, count(*)::BIGINT AS dropped FROM groups"""
    ).replace("\n, cuts", ", cuts"),
    "capacity_alerts": _events(
        """, places AS (
  SELECT * EXCLUDE (timestamp), CASE WHEN line IN ('K', 'J', 'L', 'H', 'M', 'P') THEN 50 WHEN line = 'TA' THEN 300
                 ELSE 1200 END AS capacity FROM ev WHERE event_type = 'arrival')
SELECT * FROM places WHERE passenger_count * 10 > capacity * 9"""
    ).replace("\n, places", ", places"),
    "point_lookup": _events("SELECT * FROM latest WHERE station_id = 'EST-11'"),
    "station_state": _events("SELECT * FROM latest WHERE station_id = 'EST-11'"),
    "top_occupancy": _events(
        """SELECT (row_number() OVER (ORDER BY avg_vehicle_occupancy DESC, station_id))::INTEGER AS rank, station_id,
  stop_name, lines_serving, avg_vehicle_occupancy, max_vehicle_occupancy, event_count, window_end
FROM latest ORDER BY rank LIMIT 5"""
    ),
    "critical_lines": _events("SELECT * EXCLUDE (high_delay, window_start) FROM latest_delays WHERE high_delay"),
    "alert_history_day": _events("SELECT * FROM rollup_day"),
    "alert_history_station": _events("SELECT * FROM rollup_day WHERE station_id = 'EST-11'"),
    "alert_ranking": _events(
        """SELECT (row_number() OVER (ORDER BY total_alerts DESC, station_id))::INTEGER AS rank, station_id, stop_name,
  delay_alerts, capacity_alerts, total_alerts, windows_seen FROM rollup_day ORDER BY rank LIMIT 5"""
    ),
    "ttl_retention": _events("SELECT * FROM alerts WHERE window_end > (SELECT now FROM newest) - INTERVAL 1 DAY"),
    "ttl_all_tables": _events(
        """SELECT t AS "table", s AS state, n FROM (
  SELECT 'station_occupancy' AS t, 'all' AS s, count(*) AS n FROM latest
  UNION ALL SELECT 'station_occupancy', 'alive', count(*) FROM latest WHERE window_end > (SELECT now FROM newest) - INTERVAL 2 DAY
  UNION ALL SELECT 'line_delays', 'all', count(*) FROM latest_delays
  UNION ALL SELECT 'line_delays', 'alive', count(*) FROM latest_delays WHERE window_end > (SELECT now FROM newest) - INTERVAL 3 HOUR
  UNION ALL SELECT 'station_alerts', 'all', count(*) FROM alerts
  UNION ALL SELECT 'station_alerts', 'alive', count(*) FROM alerts WHERE window_end > (SELECT now FROM newest) - INTERVAL 1 DAY)"""
    ),
    "message_bodies": _events(
        """SELECT '{"event_id":"' || event_id || '","line":"' || line || '","passenger_count":' || passenger_count || '}' AS value
FROM messages WHERE event_type <> '_invalid'"""
    ),
    "freshness": _events(
        """SELECT 'station_occupancy' AS "table", CASE WHEN max(window_end) >= (SELECT now FROM newest)
  - INTERVAL 3720 SECOND THEN 'OK' ELSE 'STALE' END AS status, max(window_end) AS newest FROM latest
UNION ALL SELECT 'line_delays', CASE WHEN max(window_end) >= (SELECT now FROM newest)
  - INTERVAL 60 SECOND THEN 'OK' ELSE 'STALE' END, max(window_end) FROM latest_delays
UNION ALL SELECT 'station_alerts', 'OK_EXISTS', max(window_end) FROM alerts"""
    ),
    "document_rules": _events(
        """SELECT 'passenger_count' AS field, 'type int' AS violation, NULL::BIGINT AS rows
UNION ALL SELECT 'stop_name', 'null', count(*) FROM enriched WHERE stop_name = stop_id"""
    ),
    "confirmation_lines": _events(
        """SELECT '{"station_id":"' || station_id || '","stop_name":"' || stop_name || '","line":"' || line ||
  '","window_start":"' || strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') || '","window_end":"' ||
  strftime(window_end, '%Y-%m-%dT%H:%M:%SZ') || '","delay_alerts":' || delay_alerts || ',"capacity_alerts":' ||
  capacity_alerts || ',"total_alerts":' || total_alerts || '}' AS value FROM alerts"""
    ),
    "zscore_ranking": _events("SELECT * FROM ranking"),
    "zscore_context": _events(
        """SELECT count(*) FILTER (WHERE c.station_id IS NOT NULL AND h.station_id IS NOT NULL) AS n_common,
  count(*) FILTER (WHERE h.station_id IS NULL) AS n_only_stream,
  count(*) FILTER (WHERE c.station_id IS NULL) AS n_only_hist,
  round(any_value(mu_s), 1) AS mu_stream, round(any_value(sigma_s), 1) AS sigma_stream,
  round(any_value(mu_b), 1) AS mu_batch, round(any_value(sigma_b), 1) AS sigma_batch,
  any_value(sigma_b) < 1e-6 AS sigma_b_zero
FROM current_side c FULL OUTER JOIN history_side h ON c.station_id = h.station_id, network"""
    ),
    "zscore_extremes": _events(
        """(SELECT 'top' AS side, station_id, delta_z FROM ranking ORDER BY delta_z DESC, station_id LIMIT 10)
UNION ALL (SELECT 'bottom', station_id, delta_z FROM ranking WHERE delta_z < 0 ORDER BY delta_z, station_id LIMIT 5)"""
    ),
    "zscore_counts": _events(
        """SELECT count(*) FILTER (WHERE delta_z > 0) AS n_above, count(*) FILTER (WHERE delta_z <= 0) AS n_not_above
FROM ranking"""
    ),
    "matched_sides": _events(
        """SELECT coalesce(c.station_id, h.station_id) AS station_id, c.station_id IS NOT NULL AS in_current,
  h.station_id IS NOT NULL AS in_history
FROM current_side c FULL OUTER JOIN history_side h ON c.station_id = h.station_id"""
    ),
}

SQL = {**BATCH_SQL, **STREAM_SQL}
