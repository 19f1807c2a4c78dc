"""Reference SQL per query, for an independent engine over the same tables.

``SOURCES`` restates the derived source tables; :func:`oracle_sql` prefixes a
query with those it mentions.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-08-01'"
AS_OF_TS = "TIMESTAMP '2001-08-01 00:00:00'"
PING_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def _pct(part: str, whole: str) -> str:
    """100 * part / whole, two digits, half up, in integer arithmetic."""
    return f"CAST((20000 * CAST({part} AS HUGEINT) + {whole}) // (2 * CAST({whole} AS HUGEINT)) AS DOUBLE) / 100"


def _ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


def _long(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)


def _date_key(c: str) -> str:
    return f"CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS BIGINT)"


def _minute_key(c: str) -> str:
    return f"CAST(hour({c}) * 10000 + minute({c}) * 100 AS BIGINT)"


def _time_key(c: str) -> str:
    return f"CAST(hour({c}) * 10000 + minute({c}) * 100 + second({c}) AS BIGINT)"


_LABEL_PERIOD = """CASE WHEN h >= 6 AND h < 12 THEN 'morning' WHEN h >= 12 AND h < 18 THEN 'afternoon'
    WHEN h >= 18 AND h < 22 THEN 'evening' ELSE 'night' END"""
_LABEL_RUSH = "CASE WHEN h >= 7 AND h < 10 THEN 'morning_rush' WHEN h >= 17 AND h < 20 THEN 'evening_rush' END"
_AGE = """CASE WHEN date_of_birth IS NULL THEN 'unknown' WHEN 2001 - year(date_of_birth) < 18 THEN 'under 18'
    WHEN 2001 - year(date_of_birth) BETWEEN 18 AND 25 THEN '18-25' WHEN 2001 - year(date_of_birth) BETWEEN 26 AND 35 THEN '26-35'
    WHEN 2001 - year(date_of_birth) BETWEEN 36 AND 50 THEN '36-50' ELSE '51+' END"""
_CARE = f"""CASE WHEN {AS_OF} - last_maintenance_date <= 30 THEN 'up_to_date'
    WHEN {AS_OF} - last_maintenance_date <= 60 THEN 'due_soon' ELSE 'overdue' END"""
_FULL_NAME = "CASE WHEN first_name IS NOT NULL AND last_name IS NOT NULL THEN first_name || ' ' || last_name ELSE username END"

SOURCES = {
    "s_users": """
        SELECT c_custkey AS user_id, c_name AS username, lower(c_name) || '@example.org' AS email,
            CASE WHEN c_custkey % 9 <> 0 THEN '+7' || lpad(CAST(c_custkey * 7919 % 10000000000 AS VARCHAR), 10, '0') END AS phone,
            CASE WHEN c_custkey % 4 <> 0 THEN upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END AS first_name,
            CASE WHEN c_custkey % 6 <> 0 THEN 'N' || c_nationkey END AS last_name,
            CASE WHEN c_custkey % 11 <> 0 THEN DATE '1930-01-01' + CAST(c_custkey * 37 % 22000 AS INTEGER) END AS date_of_birth,
            DATE '1995-01-01' + CAST(c_custkey * 17 % 2000 AS INTEGER) AS registration_date,
            CASE WHEN c_acctbal < 0 THEN 'suspended' WHEN c_custkey % 20 = 0 THEN 'deleted' ELSE 'active' END AS status,
            CAST(c_acctbal AS DECIMAL(10,2)) AS balance, c_mktsegment AS segment
        FROM customer""",
    "s_dim_user": f"""
        SELECT user_id AS user_key, user_id, username, email, phone, first_name, last_name, {_FULL_NAME} AS full_name,
            date_of_birth, {_AGE} AS age_group, registration_date, status AS current_status,
            balance AS current_balance, segment AS user_segment
        FROM s_users""",
    "s_routes": """
        SELECT p_partkey AS route_id, p_brand AS route_number, p_name AS route_name,
            CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'bus' WHEN p_type IN ('MEDIUM', 'SMALL') THEN 'tram' ELSE 'metro' END
                AS transport_type,
            CAST(p_retailprice AS DECIMAL(10,2)) AS base_fare, p_size < 45 AS is_active
        FROM part""",
    "s_dim_route": """
        SELECT route_id * 10 + version AS route_key, route_id, route_number, route_name, transport_type,
            CAST(base_fare * CASE version WHEN 1 THEN 1.00 WHEN 2 THEN 1.10 ELSE 1.25 END AS DECIMAL(10,2)) AS base_fare, is_active,
            CASE version WHEN 1 THEN DATE '1995-01-01' WHEN 2 THEN DATE '1998-07-01' ELSE DATE '2000-01-01' END AS effective_date,
            CASE WHEN version = n THEN NULL WHEN version = 1 THEN DATE '1998-07-01' ELSE DATE '2000-01-01' END AS expiration_date,
            version = n AS is_current, version
        FROM (SELECT *, unnest(range(1, n + 1)) AS version
              FROM (SELECT *, 1 + CASE WHEN route_id % 10 = 0 THEN 1 ELSE 0 END + CASE WHEN route_id % 50 = 0 THEN 1 ELSE 0 END AS n
                    FROM s_routes))""",
    "s_snapshot": """
        SELECT route_id + shift AS route_id, route_number, route_name, transport_type,
            CAST(CASE WHEN route_id % 10 = 0 THEN base_fare * 1.10 ELSE base_fare END AS DECIMAL(10,2)) AS base_fare, is_active
        FROM s_routes JOIN (VALUES (0), (1000000)) AS s(shift) ON shift = 0 OR route_id % 100 = 3
        WHERE route_id % 50 <> 7""",
    "s_vehicles": f"""
        SELECT s_suppkey AS vehicle_id, 'AA' || lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0') AS license_plate, CASE s_nationkey % 3 WHEN 0 THEN 'bus' WHEN 1 THEN 'tram' ELSE 'metro' END AS vehicle_type,
            CASE WHEN s_suppkey % 13 <> 0 THEN s_suppkey * 20 END AS route_id, 40 + s_suppkey % 7 * 20 AS capacity,
            1985 + s_suppkey % 16 AS manufacture_year, s_name AS model,
            {AS_OF} - CAST(s_suppkey * 7 % 120 AS INTEGER) AS last_maintenance_date,
            CASE WHEN s_suppkey % 10 = 8 THEN 'maintenance' WHEN s_suppkey % 10 = 9 THEN 'retired' ELSE 'active' END AS status
        FROM supplier""",
    "s_dim_vehicle": f"""
        SELECT vehicle_id AS vehicle_key, vehicle_id, license_plate, vehicle_type,
            CASE vehicle_type WHEN 'bus' THEN 'Автобус' WHEN 'tram' THEN 'Трамвай' WHEN 'metro' THEN 'Вагон метро' END AS vehicle_type_name,
            route_id AS current_route_id, capacity, manufacture_year, 2001 - manufacture_year AS vehicle_age, model,
            last_maintenance_date, {_CARE} AS maintenance_status, status AS current_status
        FROM s_vehicles""",
    "s_dim_station": """
        SELECT CAST(n_nationkey AS BIGINT) AS station_key, CAST(n_nationkey AS BIGINT) AS station_id, n_name AS station_name,
            CAST(55.55 + n_nationkey * 0.01 AS DECIMAL(10,8)) AS latitude, CAST(37.35 + n_nationkey * 0.01 AS DECIMAL(11,8)) AS longitude,
            CASE n_nationkey % 3 WHEN 0 THEN 'bus_stop' WHEN 1 THEN 'tram_stop' ELSE 'metro_station' END AS station_type,
            CASE n_nationkey % 3 WHEN 0 THEN 'Автобусная остановка' WHEN 1 THEN 'Трамвайная остановка' ELSE 'Станция метро' END AS station_type_name,
            r_name AS district, CASE n_nationkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS zone,
            n_nationkey % 10 <> 9 AS is_active
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "s_trips": """
        SELECT *, CASE WHEN status <> 'in_progress' THEN start_time + to_seconds(seconds) END AS end_time
        FROM (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS trip_id,
                o_custkey AS user_id, l_partkey AS route_id, l_suppkey AS vehicle_id, o_custkey % 25 AS start_station_id,
                l_suppkey % 25 AS end_station_id,
                o_orderdate + to_seconds((l_partkey * 37 + l_suppkey * 101 + l_linenumber * 3607) % 86400) AS start_time,
                CAST(600 + l_quantity * 60 + l_linenumber * 7 AS BIGINT) AS seconds,
                CAST(l_quantity AS DECIMAL(6,2)) AS distance_km, CAST(l_extendedprice AS DECIMAL(10,2)) AS fare,
                CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'cancelled' ELSE 'in_progress' END AS status
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "s_fact": f"""
        SELECT user_id AS user_key,
            route_id * 10 + 1 + CASE WHEN route_id % 10 = 0 AND start_time >= TIMESTAMP '1998-07-01' THEN 1 ELSE 0 END
                + CASE WHEN route_id % 50 = 0 AND start_time >= TIMESTAMP '2000-01-01' THEN 1 ELSE 0 END AS route_key,
            vehicle_id AS vehicle_key, CAST(start_time AS DATE) AS day, {_date_key("start_time")} AS date_key,
            {_minute_key("start_time")} AS minute_key, hour(start_time) AS h, start_station_id, end_station_id, distance_km,
            CAST(floor(seconds / 60.0 + 0.5) AS BIGINT) * CASE WHEN end_time IS NULL THEN NULL ELSE 1 END AS minutes,
            fare, trip_id, status, start_time, end_time
        FROM s_trips""",
    "s_done": "SELECT * FROM s_fact WHERE status = 'completed'",
    "s_txns": """
        SELECT 'T' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS transaction_id,
            o_custkey AS user_id,
            CASE WHEN l_returnflag <> 'A' THEN concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) END AS trip_id,
            CAST(l_extendedprice AS DECIMAL(10,2)) AS amount,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'card' WHEN '2-HIGH' THEN 'card' WHEN '3-MEDIUM' THEN 'cash'
                WHEN '4-NOT SPECIFIED' THEN 'subscription' ELSE 'balance' END AS payment_method,
            CASE l_returnflag WHEN 'N' THEN 'payment' WHEN 'R' THEN 'refund' ELSE 'topup' END AS transaction_type,
            CASE WHEN l_linestatus = 'F' THEN 'success' WHEN l_linenumber % 2 = 0 THEN 'failed' ELSE 'pending' END AS status,
            l_shipdate + to_seconds((l_partkey * 37 + l_suppkey * 101 + l_linenumber * 3607) % 86400) AS transaction_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "s_methods": """
        SELECT * FROM (VALUES (1, 'card', 'Банковская карта', 'digital'), (2, 'cash', 'Наличные', 'cash'),
            (3, 'subscription', 'Подписка', 'subscription'), (4, 'balance', 'Баланс приложения', 'digital'))
            AS m(payment_method_key, payment_method, payment_method_name, payment_category)""",
    "s_levels": """
        SELECT * FROM (VALUES ('empty', 1, 0, 20), ('many_seats_available', 2, 21, 40), ('few_seats_available', 3, 41, 60),
            ('standing_room_only', 4, 61, 80), ('crushed_standing_room_only', 5, 81, 100), ('full', 5, 95, 100),
            ('not_accepting_passengers', 0, NULL, NULL)) AS o(occupancy, occupancy_level, lowest, highest)""",
    "s_pings": """
        SELECT event_id AS position_id, user_id AS vehicle_id, user_id % 20 AS route_id,
            CAST(55.55 + k * 0.004 AS DECIMAL(10,8)) AS latitude,
            CAST(37.35 + event_id % 100 * 0.005 AS DECIMAL(11,8)) AS longitude,
            CAST(value AS DECIMAL(6,2)) AS speed, k AS bearing,
            CASE event_type WHEN 'signup' THEN 'empty' WHEN 'view' THEN 'many_seats_available' WHEN 'click' THEN 'few_seats_available'
                WHEN 'purchase' THEN 'standing_room_only' ELSE 'full' END AS occupancy, ts
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "s_calendar": f"""
        SELECT d AS date, {_date_key("d")} AS date_key, CAST(year(d) AS BIGINT) AS year, CAST(quarter(d) AS BIGINT) AS quarter,
            CAST(month(d) AS BIGINT) AS month, monthname(d) AS month_name, CAST(week(d) AS BIGINT) AS week, CAST(day(d) AS BIGINT) AS day,
            CAST(dayofweek(d) + 1 AS BIGINT) AS day_of_week, CAST(isodow(d) AS BIGINT) AS iso_day_of_week, dayname(d) AS day_name,
            CAST(dayofyear(d) AS BIGINT) AS day_of_year, dayofweek(d) IN (0, 6) AS is_weekend,
            CASE WHEN month(d) = 1 AND day(d) BETWEEN 1 AND 8 THEN 'Новый год' WHEN month(d) = 2 AND day(d) = 23 THEN 'День защитника Отечества'
                WHEN month(d) = 3 AND day(d) = 8 THEN 'Международный женский день' WHEN month(d) = 5 AND day(d) = 1 THEN 'Праздник Весны и Труда'
                WHEN month(d) = 5 AND day(d) = 9 THEN 'День Победы' WHEN month(d) = 6 AND day(d) = 12 THEN 'День России'
                WHEN month(d) = 11 AND day(d) = 4 THEN 'День народного единства' END AS holiday_name
        FROM (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders))""",
    "s_minutes": f"""
        SELECT CAST(h * 10000 + m * 100 AS BIGINT) AS time_key, CAST(h AS BIGINT) AS hour, CAST(m AS BIGINT) AS minute,
            {_LABEL_PERIOD} AS time_period, {_LABEL_RUSH} IS NOT NULL AS is_rush_hour, {_LABEL_RUSH} AS rush_hour_type
        FROM (SELECT i // 60 AS h, i % 60 AS m FROM range(1440) AS r(i))""",
    "s_loads": """
        SELECT *, CASE WHEN status <> 'running' THEN load_start_time + to_seconds(60 + load_id % 3600) END AS load_end_time,
            CASE WHEN status = 'success' THEN wm END AS watermark_value
        FROM (SELECT o_orderkey AS load_id, 'SRC' || (o_custkey % 7) AS source_system,
                'stg_' || lower(split_part(o_orderpriority, '-', 2)) AS table_name,
                CASE o_orderkey % 3 WHEN 0 THEN 'full' WHEN 1 THEN 'incremental' ELSE 'stream' END AS load_type,
                o_orderdate + to_seconds(o_orderkey % 86400) AS load_start_time,
                CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'failed' ELSE 'running' END AS status,
                o_custkey AS rows_inserted, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END AS wm
              FROM orders)""",
    "s_stops": """
        SELECT l_orderkey AS route_id, concat_ws('/', l_partkey, l_suppkey) AS station_id, l_linenumber AS travel_minutes,
            CAST(l_quantity AS DECIMAL(5,2)) AS distance_km,
            row_number() OVER w AS seq, sum(l_linenumber) OVER w AS minutes_from_start,
            sum(CAST(l_quantity AS DECIMAL(5,2))) OVER w AS km_from_start
        FROM lineitem
        WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice
                     ROWS UNBOUNDED PRECEDING)""",
    "s_daily_feed": """
        SELECT user_id, CAST(ts AS DATE) AS day, arg_max(event_type, ts) AS event_type FROM events GROUP BY ALL""",
    "s_feed_history": """
        SELECT user_id, event_type, day AS effective_date, lead(day) OVER w AS expiration_date,
            lead(day) OVER w IS NULL AS is_current, row_number() OVER w AS version
        FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY day) AS before FROM s_daily_feed)
        WHERE before IS NULL OR before <> event_type
        WINDOW w AS (PARTITION BY user_id ORDER BY day)""",
    "s_compared": f"""
        SELECT coalesce(c.route_id, n.route_id) AS route_id, c.route_key AS old_key, c.version AS old_version,
            c.effective_date AS old_start, c.base_fare AS old_fare, n.base_fare AS new_fare,
            c.route_number AS old_number, n.route_number AS new_number, c.route_name AS old_name, n.route_name AS new_name,
            c.transport_type AS old_type, n.transport_type AS new_type, c.is_active AS old_active, n.is_active AS new_active,
            CASE WHEN c.route_id IS NULL THEN 'new' WHEN n.route_id IS NULL THEN 'vanished'
                WHEN c.base_fare IS NOT DISTINCT FROM n.base_fare AND c.route_name IS NOT DISTINCT FROM n.route_name
                    AND c.is_active IS NOT DISTINCT FROM n.is_active THEN 'unchanged'
                WHEN c.effective_date = {AS_OF} THEN 'amended' ELSE 'changed' END AS action
        FROM (SELECT * FROM s_dim_route WHERE is_current) c FULL JOIN s_snapshot n ON c.route_id = n.route_id""",
    "s_applied": f"""
        SELECT * FROM s_dim_route WHERE NOT is_current
        UNION ALL
        SELECT old_key, route_id, old_number, old_name, old_type, old_fare, old_active, old_start, {AS_OF}, FALSE, old_version
        FROM s_compared WHERE action IN ('changed', 'vanished')
        UNION ALL
        SELECT old_key, route_id, new_number, new_name, new_type, new_fare, new_active, old_start, NULL, TRUE, old_version
        FROM s_compared WHERE action IN ('unchanged', 'amended')
        UNION ALL
        SELECT (SELECT max(route_key) FROM s_dim_route) + row_number() OVER (ORDER BY route_id), route_id, new_number, new_name,
            new_type, new_fare, new_active, {AS_OF}, NULL, TRUE, coalesce(old_version, 0) + 1
        FROM s_compared WHERE action IN ('changed', 'new')""",
    "s_flow": f"""
        SELECT f.day, f.h, dayofweek(f.day) + 1 AS dow, CASE WHEN dayofweek(f.day) IN (0, 6) THEN 1 ELSE 0 END AS weekend,
            CASE WHEN {_LABEL_RUSH} IS NOT NULL THEN 1 ELSE 0 END AS rush,
            count(*) FILTER (transport_type = 'bus') AS bus, count(*) FILTER (transport_type = 'tram') AS tram,
            count(*) FILTER (transport_type = 'metro') AS metro, count(*) AS trips, sum(fare) AS revenue,
            count(DISTINCT user_key) AS passengers
        FROM s_done f JOIN s_dim_route USING (route_key) GROUP BY ALL""",
    "s_mart_hourly": f"""
        SELECT route_id, route_number, route_name, transport_type, day, h, count(*) AS trips, count(DISTINCT user_key) AS passengers,
            sum(distance_km) AS km, {_ratio("sum(minutes)", "count(minutes)")} AS avg_minutes, sum(fare) AS revenue
        FROM s_done JOIN s_dim_route USING (route_key) WHERE day >= {AS_OF} - 30 GROUP BY ALL""",
    "s_segments": f"""
        SELECT u.user_id, u.username, u.registration_date, count(*) FILTER (day >= {AS_OF} - 30) AS recent,
            coalesce(sum(fare) FILTER (day >= {AS_OF} - 30), 0) AS recent_spent, count(f.trip_id) AS trips, sum(fare) AS spent, max(day) AS last_day
        FROM s_dim_user u LEFT JOIN s_done f ON u.user_key = f.user_key GROUP BY ALL""",
    "s_segment_mart": f"""
        SELECT *, CASE WHEN recent >= 20 THEN 'frequent' WHEN recent >= 5 THEN 'occasional' WHEN recent >= 1 THEN 'rare' ELSE 'churned' END AS segment,
            coalesce({AS_OF} - last_day, 9999) AS idle
        FROM s_segments""",
    "s_favourite": """
        SELECT user_key, route_id, n FROM (
            SELECT user_key, route_id, count(*) AS n, row_number() OVER (PARTITION BY user_key ORDER BY count(*) DESC, route_id) AS rn
            FROM s_done JOIN s_dim_route USING (route_key) GROUP BY user_key, route_id) WHERE rn = 1""",
    "s_rfm": f"""
        SELECT u.user_key, u.username, {AS_OF} - max(day) AS recency_days, count(f.trip_id) AS frequency, sum(fare) AS monetary
        FROM s_dim_user u LEFT JOIN s_done f ON u.user_key = f.user_key GROUP BY ALL""",
    "s_subs": """
        SELECT o_orderkey, o_custkey AS user_id, CASE o_orderkey % 3 WHEN 0 THEN 'monthly' WHEN 1 THEN 'quarterly' ELSE 'annual' END AS subscription_type,
            CAST(o_orderdate AS DATE) AS start_date,
            CAST(o_orderdate AS DATE) + CASE o_orderkey % 3 WHEN 0 THEN 29 WHEN 1 THEN 89 ELSE 364 END AS end_date
        FROM orders""",
    "s_cutoff": "SELECT max(ts) - INTERVAL 10 MINUTE AS cut FROM events",
    "s_spells": """
        SELECT vehicle_id, spell, min(ts) FILTER (slow) AS stopped_at, max(ts) AS until, count(*) FILTER (slow) AS slow_pings,
            count(*) FILTER (NOT slow) > 0 AS moved_on
        FROM (SELECT *, sum(CASE WHEN slow AND NOT coalesce(before, FALSE) THEN 1 ELSE 0 END)
                    OVER (PARTITION BY vehicle_id ORDER BY ts, position_id ROWS UNBOUNDED PRECEDING) AS spell
              FROM (SELECT *, lag(slow) OVER (PARTITION BY vehicle_id ORDER BY ts, position_id) AS before
                    FROM (SELECT *, speed < 20 AS slow FROM s_pings)))
        WHERE spell > 0 AND (slow OR before) GROUP BY vehicle_id, spell""",
}

_RATIO_MINUTES = _ratio("sum(minutes)", "count(minutes)")

_CHECK = """SELECT '{table}' AS table_name, '{kind}' AS check_type, '{name}' AS check_name, '0' AS expected_value,
    CAST({n} AS VARCHAR) AS actual_value, CASE WHEN {n} = 0 THEN 'passed' ELSE '{bad}' END AS check_result FROM {source}"""


def _check(table: str, kind: str, name: str, violation: str, source: str, bad: str = "failed") -> str:
    return _CHECK.format(table=table, kind=kind, name=name, n=f"count(*) FILTER ({violation})", source=source, bad=bad)


def _retention(name: str, source: str, column: str, cutoff: str) -> str:
    return f"""SELECT '{name}' AS table_name, count(*) FILTER ({column} < {cutoff}) AS rows_deleted,
        count(*) FILTER ({column} >= {cutoff}) AS rows_kept FROM {source}"""


def _statistics(name: str, source: str, column: str) -> str:
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count, CAST(CAST(min({column}) AS TIMESTAMP) AS VARCHAR) AS oldest_load,
        CAST(CAST(max({column}) AS TIMESTAMP) AS VARCHAR) AS latest_load FROM {source}"""


def _count(name: str, source: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"


def _union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


_ROUTE_VERSION = """route_key, route_id, route_number, route_name, transport_type, CAST(base_fare AS DOUBLE) AS base_fare, is_active,
    CAST(effective_date AS VARCHAR) AS effective_date, CAST(expiration_date AS VARCHAR) AS expiration_date, is_current,
    CAST(version AS BIGINT) AS version"""
_STAMPS = """CASE WHEN known THEN '2001-07-31 06:30:00' ELSE '2001-08-01 06:30:00' END AS created_date,
    CASE WHEN delivered THEN '2001-08-01 06:30:00' ELSE '2001-07-31 06:30:00' END AS updated_date"""
_PING_SPEED = """CAST(speed AS DOUBLE)"""

QUERIES = {
    "scan_parquet": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderstatus = 'F'",
    "csv_roundtrip": """SELECT user_id, username, email, phone, first_name, last_name, CAST(date_of_birth AS VARCHAR) AS date_of_birth,
        CAST(registration_date AS VARCHAR) AS registration_date, status, CAST(balance AS DOUBLE) AS balance, segment FROM s_users""",
    "write_modes": """SELECT o_orderstatus, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders
        WHERE o_orderstatus IN ('F', 'O') GROUP BY o_orderstatus""",
    "partition_pruned_scan": f"""SELECT {_date_key("o_orderdate")} AS date_key, count(*) AS orders,
        CAST(sum(CAST(o_totalprice AS DECIMAL(10,2))) AS DOUBLE) AS total FROM orders
        WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-04-01' GROUP BY 1""",
    "upsert_update_cols": """SELECT coalesce(t.route_id, s.route_id) AS route_id, coalesce(t.route_number, s.route_number) AS route_number,
        CASE WHEN s.route_id IS NULL THEN t.route_name ELSE upper(s.route_name) END AS route_name,
        coalesce(t.transport_type, s.transport_type) AS transport_type,
        CAST(CASE WHEN s.route_id IS NULL THEN t.base_fare ELSE s.base_fare END AS DOUBLE) AS base_fare,
        coalesce(t.is_active, s.is_active) AS is_active,
        CASE WHEN t.route_id IS NOT NULL AND s.route_id IS NOT NULL THEN '2001-08-01 06:30:00' END AS updated_at
        FROM s_routes t FULL JOIN s_snapshot s ON t.route_id = s.route_id""",
    "insert_if_absent": "SELECT user_id, username, CAST(balance AS DOUBLE) AS balance FROM s_users",
    "staging_copy_common": """SELECT user_id, username, phone, CAST(date_of_birth AS VARCHAR) AS date_of_birth, status, CAST(balance AS DOUBLE) AS balance,
        '2001-08-01 06:30:00' AS load_date, 'OLTP' AS source_system FROM s_users""",
    "summing_merge": f"""SELECT CAST(day AS VARCHAR) AS date, CAST(h AS BIGINT) AS hour, CAST(dow AS BIGINT) AS day_of_week,
        CAST(weekend AS BIGINT) AS is_weekend, CAST(rush AS BIGINT) AS is_rush_hour, bus AS bus_trips, tram AS tram_trips, metro AS metro_trips,
        trips AS total_trips, CAST(revenue AS DOUBLE) AS total_revenue, {_ratio("revenue", "trips")} AS avg_revenue_per_trip,
        passengers AS unique_passengers FROM s_flow""",
    "replacing_merge": """SELECT user_id, event_type, event_id, CAST(ts AS VARCHAR) AS ts, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "dim_date": """SELECT date_key, CAST(date AS VARCHAR) AS date, year, quarter, month, month_name, week, day, day_of_week, iso_day_of_week,
        day_name, day_of_year, is_weekend, year AS fiscal_year, quarter AS fiscal_quarter, month AS fiscal_month,
        CAST(CAST(date_trunc('week', date) AS DATE) AS VARCHAR) AS week_start_date,
        CAST(CAST(date_trunc('week', date) + INTERVAL 6 DAY AS DATE) AS VARCHAR) AS week_end_date,
        CAST(CAST(date_trunc('month', date) AS DATE) AS VARCHAR) AS month_start_date,
        CAST(CAST(date_trunc('month', date) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS month_end_date,
        CAST(CAST(date_trunc('quarter', date) AS DATE) AS VARCHAR) AS quarter_start_date,
        CAST(CAST(date_trunc('quarter', date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS quarter_end_date,
        CAST(CAST(date_trunc('year', date) AS DATE) AS VARCHAR) AS year_start_date,
        CAST(CAST(date_trunc('year', date) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS year_end_date FROM s_calendar""",
    "dim_date_holidays": f"""SELECT c.date_key, CAST(c.date AS VARCHAR) AS date, c.holiday_name, count(o_orderkey) AS orders
        FROM s_calendar c LEFT JOIN orders ON {_date_key("o_orderdate")} = c.date_key WHERE c.holiday_name IS NOT NULL GROUP BY ALL""",
    "dim_time": """SELECT m.time_key, lpad(CAST(hour AS VARCHAR), 2, '0') || ':' || lpad(CAST(minute AS VARCHAR), 2, '0') || ':00' AS time, hour, minute,
        CAST(0 AS BIGINT) AS second, hour AS hour_of_day, time_period, is_rush_hour, rush_hour_type, count(f.trip_id) AS trips
        FROM s_minutes m LEFT JOIN s_fact f ON m.time_key = f.minute_key GROUP BY ALL""",
    "date_time_keys": f"""SELECT event_id, {_date_key("ts")} AS date_key, {_time_key("ts")} AS time_key, {_minute_key("ts")} AS minute_key FROM events""",
    "calendar_check": """SELECT 'dim_date' AS table_name, count(*) AS total_rows, CAST(min(date) AS VARCHAR) AS first_value,
            CAST(max(date) AS VARCHAR) AS last_value, count(*) FILTER (is_weekend) AS weekend_days,
            count(holiday_name) AS holiday_days, CAST(NULL AS BIGINT) AS rush_hour_records FROM s_calendar
        UNION ALL SELECT 'dim_time', count(*), '00:00:00', '23:59:00', NULL, NULL, count(*) FILTER (is_rush_hour) FROM s_minutes""",
    "surrogate_key": "SELECT user_id, username, row_number() OVER (ORDER BY username, user_id) AS user_key FROM s_users",
    "surrogate_key_append": """SELECT user_id, username, user_id + 1 AS user_key FROM s_users WHERE user_id % 3 <> 0 UNION ALL
        SELECT user_id, username, (SELECT max(user_id + 1) FROM s_users WHERE user_id % 3 <> 0) + row_number() OVER (ORDER BY user_id)
        FROM s_users WHERE user_id % 3 = 0""",
    "fact_key_lookup": """SELECT coalesce(v.vehicle_key, -1) AS vehicle_key, coalesce(r.route_key, -1) AS route_key, count(*) AS pings
        FROM s_pings p LEFT JOIN s_dim_vehicle v ON p.vehicle_id = v.vehicle_id
        LEFT JOIN s_dim_route r ON p.route_id = r.route_id AND r.is_current GROUP BY 1, 2""",
    "fact_quarantine": f"""SELECT 'vehicle_key' AS unresolved, r.route_key, {_date_key("ts")} AS date_key, {_time_key("ts")} AS time_key,
        {_PING_SPEED} AS speed_kmh, CAST(ts AS VARCHAR) AS recorded_at
        FROM s_pings p JOIN s_dim_route r ON p.route_id = r.route_id AND r.is_current
        WHERE p.vehicle_id NOT IN (SELECT vehicle_id FROM s_dim_vehicle WHERE current_status = 'active')""",
    "scd1_user": f"""SELECT CASE WHEN known THEN user_id + 1 ELSE (SELECT max(user_id) + 1 FROM s_users WHERE user_id % 3 <> 0)
            + row_number() OVER (PARTITION BY known ORDER BY user_id) END AS user_key,
        user_id, username, email, phone, 'OLTP' AS source_system, first_name, last_name, {_FULL_NAME} AS full_name, CAST(date_of_birth AS VARCHAR) AS date_of_birth,
        {_AGE} AS age_group, CAST(registration_date AS VARCHAR) AS registration_date, status AS current_status,
        CAST(balance AS DOUBLE) AS current_balance, 'occasional' AS user_segment, {_STAMPS}
        FROM (SELECT *, user_id % 3 <> 0 AS known, TRUE AS delivered FROM s_users)""",
    "scd1_station": f"""SELECT station_id + 1 AS station_key, station_id, station_name, CAST(latitude AS DOUBLE) AS latitude,
        CAST(longitude AS DOUBLE) AS longitude, station_type, station_type_name, district, zone, is_active, FALSE AS is_transfer_station, 'OLTP' AS source_system, {_STAMPS}, departures
        FROM (SELECT *, station_id < 10 AS known, TRUE AS delivered FROM s_dim_station)
        LEFT JOIN (SELECT start_station_id, count(*) AS departures FROM s_trips GROUP BY 1) ON start_station_id = station_id""",
    "scd1_vehicle": f"""SELECT CASE WHEN known THEN vehicle_id + 1 ELSE (SELECT max(vehicle_id) + 1 FROM s_vehicles WHERE vehicle_id % 2 = 0)
            + row_number() OVER (PARTITION BY known ORDER BY vehicle_id) END AS vehicle_key,
        vehicle_id, license_plate, 'OLTP' AS source_system, vehicle_type, vehicle_type_name, current_route_id, {_long("capacity", "manufacture_year", "vehicle_age")}, model,
        CAST(last_maintenance_date AS VARCHAR) AS last_maintenance_date, maintenance_status, current_status, {_STAMPS}
        FROM (SELECT *, vehicle_id % 2 = 0 AS known, vehicle_id % 10 <> 4 AS delivered FROM s_dim_vehicle)""",
    "scd2_initial": f"""SELECT row_number() OVER (ORDER BY route_id) AS route_key, route_id, route_number, route_name, transport_type,
        CAST(base_fare AS DOUBLE) AS base_fare, is_active, CAST({AS_OF} AS VARCHAR) AS effective_date, CAST(NULL AS VARCHAR) AS expiration_date,
        TRUE AS is_current, CAST(1 AS BIGINT) AS version,
        CASE transport_type WHEN 'bus' THEN 'Автобус' WHEN 'tram' THEN 'Трамвай' WHEN 'metro' THEN 'Метро' END AS transport_type_name,
        route_number || ' ' || route_name AS description, '2001-08-01 06:30:00' AS created_date, '2001-08-01 06:30:00' AS updated_date,
        'OLTP' AS source_system FROM s_routes""",
    "scd2_diff": "SELECT route_id, action, CAST(old_fare AS DOUBLE) AS old_fare, CAST(new_fare AS DOUBLE) AS new_fare FROM s_compared",
    "scd2_apply": f"SELECT {_ROUTE_VERSION} FROM s_applied",
    "scd2_from_feed": """SELECT user_id, event_type, CAST(effective_date AS VARCHAR) AS effective_date, CAST(expiration_date AS VARCHAR) AS expiration_date,
        is_current, version FROM s_feed_history""",
    "scd2_current": f"SELECT {_ROUTE_VERSION} FROM s_dim_route WHERE is_current",
    "scd2_as_of_join": """SELECT e.event_id, e.user_id, CAST(CAST(e.ts AS DATE) AS VARCHAR) AS day, h.event_type, h.version
        FROM events e LEFT JOIN s_feed_history h ON e.user_id = h.user_id AND h.effective_date <= CAST(e.ts AS DATE)
            AND (h.expiration_date > CAST(e.ts AS DATE) OR h.expiration_date IS NULL)""",
    "scd2_latest_version": """SELECT route_id, CAST(coalesce((SELECT max(version) FROM s_dim_route h WHERE h.route_id = s.route_id), 0) AS BIGINT) AS version
        FROM s_snapshot s""",
    "scd2_history": f"""SELECT {_ROUTE_VERSION}, CAST(coalesce(expiration_date, {AS_OF}) - effective_date AS BIGINT) AS days_active,
        CAST(lag(base_fare) OVER w AS DOUBLE) AS previous_fare, CAST(base_fare - lag(base_fare) OVER w AS DOUBLE) AS fare_change,
        CASE WHEN is_current THEN 'Текущая' ELSE 'Историческая' END AS status
        FROM s_dim_route WINDOW w AS (PARTITION BY route_id ORDER BY version)""",
    "scd2_invariants": """SELECT count(DISTINCT route_id) AS members, count(*) FILTER (is_current <> (expiration_date IS NULL)) AS flag_mismatches,
        CAST(0 AS BIGINT) AS several_current, count(*) FILTER (nxt > expiration_date) AS gaps,
        count(*) FILTER (nxt < expiration_date OR (nxt IS NOT NULL AND expiration_date IS NULL)) AS overlaps
        FROM (SELECT *, lead(effective_date) OVER (PARTITION BY route_id ORDER BY effective_date, version) AS nxt FROM s_applied)""",
    "transfer_station_flag": """SELECT station_key, station_id, station_name, coalesce(n > 1, FALSE) AS is_transfer_station FROM s_dim_station
        LEFT JOIN (SELECT start_station_id, count(DISTINCT route_id) AS n FROM s_trips GROUP BY 1)
        ON start_station_id = station_id""",
    "scd1_user_segment": """SELECT u.user_key, u.username, m.segment AS user_segment
        FROM s_dim_user u JOIN s_segment_mart m ON u.user_id = m.user_id""",
    "trip_fact_load": f"""SELECT f.user_key, f.route_key, f.vehicle_key, date_key AS start_date_key, {_time_key("start_time")} AS start_time_key,
        minute_key AS start_minute_key, {_date_key("end_time")} AS end_date_key, {_time_key("end_time")} AS end_time_key,
        start_station_id AS start_station_key, end_station_id AS end_station_key, CAST(distance_km AS DOUBLE) AS distance_km,
        minutes AS duration_minutes, CAST(coalesce(paid, base_fare) AS DOUBLE) AS actual_fare, f.trip_id, f.status AS trip_status,
        CAST(start_time AS VARCHAR) AS start_timestamp, CAST(end_time AS VARCHAR) AS end_timestamp,
        '2001-08-01 06:30:00' AS created_date, 'OLTP' AS source_system
        FROM s_fact f JOIN s_dim_route r ON f.route_key = r.route_key
        LEFT JOIN (SELECT trip_id, sum(amount) AS paid FROM s_txns WHERE transaction_type = 'payment' AND status = 'success' GROUP BY 1) p
        ON f.trip_id = p.trip_id""",
    "trip_fare_resolution": """SELECT r.route_id, count(*) AS trips, CAST(sum(coalesce(paid, r.base_fare)) AS DOUBLE) AS revenue
        FROM s_trips t JOIN s_routes r ON t.route_id = r.route_id
        LEFT JOIN (SELECT trip_id, sum(amount) AS paid FROM s_txns WHERE transaction_type = 'payment' AND status = 'success' GROUP BY 1) p
        ON t.trip_id = p.trip_id GROUP BY 1""",
    "trip_duration": """SELECT position_id, vehicle_id, CAST(ts AS VARCHAR) AS ts, CAST(prev AS VARCHAR) AS prev_ts,
        CAST(floor((epoch_us(ts) - epoch_us(prev)) / 60000000.0 + 0.5) AS BIGINT) AS duration_minutes
        FROM (SELECT *, lag(ts) OVER (PARTITION BY vehicle_id ORDER BY ts, position_id) AS prev FROM s_pings)""",
    "transaction_fact_load": f"""SELECT user_id AS user_key, trip_id AS trip_key, CAST(payment_method_key AS BIGINT) AS payment_method_key,
        {_date_key("transaction_date")} AS date_key, {_time_key("transaction_date")} AS time_key, {_minute_key("transaction_date")} AS minute_key,
        CAST(amount AS DOUBLE) AS amount, transaction_id, transaction_type, status AS transaction_status,
        CAST(transaction_date AS VARCHAR) AS transaction_timestamp FROM s_txns JOIN s_methods USING (payment_method)""",
    "fact_idempotent_reload": """SELECT date_key // 100 AS month_key, count(DISTINCT trip_id) AS trips, CAST(sum(fare) AS DOUBLE) AS fares FROM s_fact GROUP BY 1""",
    "last_watermark": """SELECT source_system, table_name, CAST(coalesce(wm, TIMESTAMP '1900-01-01') AS VARCHAR) AS watermark FROM (
        SELECT source_system, table_name, arg_max(watermark_value, (load_end_time, load_id)) FILTER (status = 'success' AND watermark_value IS NOT NULL) AS wm
        FROM s_loads GROUP BY 1, 2)""",
    "load_control_state": """SELECT load_id, source_system, table_name, load_type, CAST(load_start_time AS VARCHAR) AS load_start_time, status,
        rows_inserted, CAST(watermark_value AS VARCHAR) AS watermark_value, CAST(load_end_time AS VARCHAR) AS load_end_time FROM s_loads""",
    "incremental_extract": """SELECT count(*) AS extracted, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, CAST(max(o_orderdate) AS VARCHAR) AS next_watermark
        FROM orders WHERE o_orderdate > TIMESTAMP '2001-07-01'""",
    "retention_cleanup": _union(
        _retention("stg_trips", "s_trips", "start_time", "DATE '2001-07-25'"),
        _retention("stg_users", "s_users", "registration_date", "DATE '2001-07-25'"),
        _retention("stg_vehicle_positions", "events", "ts", "DATE '2024-01-28'"),
        _retention("fact_vehicle_positions", "events", "ts", "DATE '2023-11-02'"),
        _retention("fact_trips", "s_trips", "start_time", "DATE '1998-08-01'"),
        _retention("fact_transactions", "s_txns", "transaction_date", "DATE '1994-08-01'"),
    ),
    "recent_loads": f"""SELECT load_id, source_system, table_name, load_type, CAST(load_start_time AS VARCHAR) AS load_start_time,
        CAST(load_end_time AS VARCHAR) AS load_end_time, (epoch_us(load_end_time) - epoch_us(load_start_time)) / 1e6 / 60 AS duration_minutes,
        rows_inserted, status FROM s_loads WHERE load_start_time > {AS_OF_TS} - INTERVAL 7 DAY""",
    "staging_statistics": _union(
        _statistics("stg_users", "s_users", "registration_date"),
        _statistics("stg_vehicles", "s_vehicles", "last_maintenance_date"),
        _statistics("stg_trips", "s_trips", "start_time"),
        _statistics("stg_transactions", "s_txns", "transaction_date"),
        _statistics("stg_vehicle_positions", "events", "ts"),
        _statistics("stg_loads", "s_loads", "load_start_time"),
        _statistics("stg_orders", "orders", "o_orderdate"),
    ),
    "table_counts": _union(
        _count("dim_user", "s_dim_user"), _count("dim_route", "s_dim_route"), _count("dim_station", "s_dim_station"),
        _count("dim_vehicle", "s_dim_vehicle"), _count("dim_date", "s_calendar"), _count("dim_time", "s_minutes"),
        _count("fact_trips", "s_fact"), _count("fact_transactions", "s_txns"),
    ),
    "dq_report": _union(
        _check("stg_users", "not_null", "user_id not null", "user_id IS NULL", "s_users"),
        _check("stg_users", "not_null", "first_name not null", "first_name IS NULL", "s_users"),
        _check("stg_users", "range", "balance in [0, 9000]", "balance < 0 OR balance > 9000", "s_users", "warning"),
        _check("stg_users", "domain", "status in domain", "status = 'deleted'", "s_users"),
        _check("stg_users", "length", "username length <= 50", "length(username) > 50", "s_users"),
        _check("stg_trips", "not_null", "user_id not null", "user_id IS NULL", "s_trips"),
        _check("stg_trips", "not_null", "end_time not null", "end_time IS NULL", "s_trips"),
        _check("stg_trips", "range", "distance_km in [0, 45]", "distance_km > 45", "s_trips", "warning"),
        _check("stg_trips", "domain", "status in domain", "status NOT IN ('in_progress', 'completed', 'cancelled')", "s_trips"),
        _check("stg_trips", "range", "end after start", "end_time < start_time", "s_trips"),
        _check("stg_trips", "unique", "trip_id unique", "n > 1", "(SELECT trip_id, count(*) AS n FROM s_trips GROUP BY 1)"),
        _check("stg_trips", "foreign_key", "vehicle_id references vehicle_id",
               "vehicle_id NOT IN (SELECT vehicle_id FROM s_vehicles WHERE status = 'active')", "s_trips"),
    ),
    "dq_unique": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_range": _union(
        _check("stg_vehicle_positions", "range", "latitude in [55.55, 55.95]", "latitude NOT BETWEEN 55.55 AND 55.95", "s_pings"),
        _check("stg_vehicle_positions", "range", "longitude in [37.35, 37.85]", "longitude NOT BETWEEN 37.35 AND 37.85", "s_pings"),
        _check("stg_vehicle_positions", "range", "speed in [0, 80]", "speed NOT BETWEEN 0 AND 80", "s_pings", "warning"),
        _check("stg_vehicle_positions", "range", "bearing in [0, 360]", "bearing NOT BETWEEN 0 AND 360", "s_pings"),
    ),
    "dq_domain": _union(
        _check("stg_transactions", "domain", "payment_method in domain",
               "payment_method NOT IN (SELECT payment_method FROM s_methods)", "s_txns"),
        _check("stg_transactions", "domain", "transaction_type in domain", "transaction_type = 'topup'", "s_txns"),
        _check("stg_transactions", "domain", "status in domain", "status = 'pending'", "s_txns", "warning"),
    ),
    "dq_foreign_key": _check("stg_vehicle_positions", "foreign_key", "vehicle_id references vehicle_id",
                             "vehicle_id NOT IN (SELECT vehicle_id FROM s_vehicles)", "s_pings"),
    "fk_delete_policy": """SELECT v.vehicle_id, count(*) AS trips, count(DISTINCT t.user_id) AS users
        FROM s_trips t JOIN s_users u ON t.user_id = u.user_id AND u.status <> 'deleted'
        LEFT JOIN s_vehicles v ON t.vehicle_id = v.vehicle_id AND v.status <> 'retired' GROUP BY 1""",
    "scalar_date_parts": f"""SELECT event_id, year(ts) AS year, quarter(ts) AS quarter, month(ts) AS month, week(ts) AS week, day(ts) AS day,
        dayofweek(ts) + 1 AS day_of_week, dayofyear(ts) AS day_of_year, hour(ts) AS hour, minute(ts) AS minute, second(ts) AS second,
        CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week_start, CAST(CAST(date_trunc('quarter', ts) AS DATE) AS VARCHAR) AS quarter_start,
        monthname(ts) AS month_name, dayname(ts) AS day_name, CAST(CAST(ts AS DATE) - 30 AS VARCHAR) AS month_before,
        CAST(DATE '2024-01-31' - CAST(ts AS DATE) AS BIGINT) AS days_ago,
        (epoch_us({PING_AS_OF}) - epoch_us(ts)) / 1e6 / 60 AS minutes_ago FROM events""",
    "scalar_string": f"""SELECT user_id, {_FULL_NAME} AS full_name, upper(substr(segment, 1, 4)) || '_' || lpad(CAST(user_id AS VARCHAR), 7, '0') AS code,
        regexp_replace(email, '@example\\.org$', '') AS mailbox, CAST(least(5000, greatest(0, balance)) AS DOUBLE) AS clamped,
        CAST(round(CAST(balance AS DECIMAL(18,8)) / 7, 2) AS DOUBLE) AS weekly, length(username) AS name_length FROM s_users""",
    "scalar_json": """SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_struct,
        count(*) AS events, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum FROM events GROUP BY 1""",
    "bucket_functions": f"""SELECT 'age_group' AS kind, {_AGE} AS bucket, count(*) AS members FROM s_users GROUP BY 2
        UNION ALL SELECT 'maintenance', {_CARE}, count(*) FROM s_vehicles GROUP BY 2
        UNION ALL SELECT 'day_period', {_LABEL_PERIOD}, count(*) FROM (SELECT hour(ts) AS h FROM events) GROUP BY 2
        UNION ALL SELECT 'occupancy', occupancy, CAST(sum(n) AS BIGINT) FROM (
            SELECT bearing, n, arg_max(l.occupancy, lowest) AS occupancy
            FROM (SELECT bearing, count(*) AS n FROM s_pings GROUP BY 1) LEFT JOIN s_levels l ON bearing BETWEEN lowest AND highest
            GROUP BY bearing, n) GROUP BY 2""",
    "top_routes": f"""SELECT route_number, route_name, transport_type, count(*) AS total_trips, CAST(sum(fare) AS DOUBLE) AS total_revenue,
        {_RATIO_MINUTES} AS avg_duration FROM s_done JOIN s_dim_route USING (route_key) WHERE is_current GROUP BY 1, 2, 3
        ORDER BY total_trips DESC, 1, 2, 3 LIMIT 10""",
    "transport_type_share": f"""SELECT transport_type, n AS trips_count, {_pct("n", "(sum(n) OVER ())")} AS percentage, revenue FROM (
        SELECT transport_type, count(*) AS n, CAST(sum(fare) AS DOUBLE) AS revenue FROM s_done JOIN s_dim_route USING (route_key) GROUP BY 1)""",
    "trips_by_hour": f"""SELECT hour AS hour_of_day, time_period, is_rush_hour, count(*) AS trips_count, {_RATIO_MINUTES} AS avg_duration,
        CAST(sum(fare) AS DOUBLE) AS revenue FROM s_done f JOIN s_minutes m ON f.minute_key = m.time_key GROUP BY 1, 2, 3""",
    "weekday_weekend": f"""SELECT CASE WHEN dayofweek(day) IN (0, 6) THEN 'Выходные' ELSE 'Будни' END AS day_type, count(*) AS trips_count,
        {_RATIO_MINUTES} AS avg_duration, {_ratio("sum(distance_km)", "count(distance_km)")} AS avg_distance, CAST(sum(fare) AS DOUBLE) AS total_revenue
        FROM s_done GROUP BY 1""",
    "rush_hour_compare": f"""SELECT CASE WHEN is_rush_hour THEN 'Час пик' ELSE 'Обычное время' END AS period_type, rush_hour_type, count(*) AS trips_count,
        {_RATIO_MINUTES} AS avg_duration, count(DISTINCT user_key) AS unique_passengers
        FROM s_done f JOIN s_minutes m ON f.minute_key = m.time_key GROUP BY 1, 2""",
    "user_segments": f"""SELECT age_group, user_segment, count(*) AS users_count, {_ratio("sum(current_balance)", "count(*)")} AS avg_balance
        FROM s_dim_user WHERE current_status = 'active' GROUP BY 1, 2""",
    "top_users": f"""SELECT username, user_segment, trips_count, total_spent, avg_trip_duration FROM (
        SELECT u.user_id, username, user_segment, count(*) AS trips_count, CAST(sum(fare) AS DOUBLE) AS total_spent, {_RATIO_MINUTES} AS avg_trip_duration
        FROM s_done f JOIN s_dim_user u ON f.user_key = u.user_key GROUP BY 1, 2, 3 ORDER BY trips_count DESC, 1 LIMIT 10)""",
    "payment_methods": f"""SELECT payment_method_name, payment_category, count(*) AS transactions_count, CAST(sum(amount) AS DOUBLE) AS total_amount,
        {_ratio("sum(amount)", "count(*)")} AS avg_transaction FROM s_txns JOIN s_methods USING (payment_method)
        WHERE status = 'success' AND transaction_type = 'payment' GROUP BY 1, 2""",
    "top_stations": """SELECT station_name, station_type, district, departures_count FROM (
        SELECT station_id, station_name, station_type, district, count(*) AS departures_count FROM s_done JOIN s_dim_station ON start_station_id = station_id
        GROUP BY 1, 2, 3, 4 ORDER BY departures_count DESC, 1 LIMIT 10)""",
    "top_station_pairs": f"""SELECT start_station, end_station, trips_count, avg_duration, avg_distance FROM (
        SELECT a.station_id AS sid, b.station_id AS eid, a.station_name AS start_station, b.station_name AS end_station, count(*) AS trips_count,
            {_RATIO_MINUTES} AS avg_duration, {_ratio("sum(distance_km)", "count(distance_km)")} AS avg_distance
        FROM s_done JOIN s_dim_station a ON start_station_id = a.station_id JOIN s_dim_station b ON end_station_id = b.station_id
        WHERE start_station_id <> end_station_id GROUP BY 1, 2, 3, 4 ORDER BY trips_count DESC, 1, 2 LIMIT 10)""",
    "vehicle_type_stats": f"""SELECT * FROM (SELECT vehicle_type, count(DISTINCT v.vehicle_key) AS vehicles_count, {_ratio("sum(vehicle_age)", "count(*)")} AS avg_age,
            {_ratio("sum(capacity)", "count(*)")} AS avg_capacity, count(trip_id) AS total_trips
        FROM s_dim_vehicle v LEFT JOIN s_fact f ON v.vehicle_key = f.vehicle_key WHERE current_status = 'active' GROUP BY 1)
        JOIN (SELECT vehicle_type, {_ratio("sum(vehicle_age)", "count(*)")} AS avg_age_per_vehicle, {_ratio("sum(capacity)", "count(*)")} AS avg_capacity_per_vehicle
        FROM s_dim_vehicle WHERE current_status = 'active' GROUP BY 1) USING (vehicle_type)""",
    "busiest_vehicles": """SELECT v.vehicle_id, vehicle_type, route_number, count(*) AS trips_count, CAST(manufacture_year AS BIGINT) AS manufacture_year,
        CAST(vehicle_age AS BIGINT) AS vehicle_age FROM s_done f JOIN s_dim_vehicle v ON f.vehicle_key = v.vehicle_key
        JOIN s_dim_route r ON v.current_route_id = r.route_id AND r.is_current GROUP BY ALL ORDER BY trips_count DESC, 1 LIMIT 10""",
    "daily_trips": """SELECT CAST(day AS VARCHAR) AS date, dayname(day) AS day_name, dayofweek(day) IN (0, 6) AS is_weekend, count(*) AS trips_count,
        CAST(sum(fare) AS DOUBLE) AS daily_revenue FROM s_done GROUP BY ALL""",
    "weekly_trips": f"""SELECT week(day) AS week, year(day) AS year, count(*) AS trips_count, CAST(sum(fare) AS DOUBLE) AS weekly_revenue,
        {_RATIO_MINUTES} AS avg_duration FROM s_done GROUP BY 1, 2""",
    "system_kpis": f"""SELECT count(DISTINCT user_key) AS total_active_users, count(DISTINCT route_key) AS total_active_routes,
        count(DISTINCT vehicle_key) AS total_active_vehicles, count(*) AS total_trips, count(*) FILTER (status = 'completed') AS completed_trips,
        count(*) FILTER (status = 'cancelled') AS cancelled_trips, {_pct("count(*) FILTER (status = 'completed')", "count(*)")} AS completion_rate,
        CAST(sum(fare) AS DOUBLE) AS total_revenue, {_RATIO_MINUTES} AS avg_trip_duration, {_ratio("sum(distance_km)", "count(*)")} AS avg_trip_distance
        FROM s_fact""",
    "kpi_last_n_days": f"""SELECT transport_type, count(*) AS trips_count, CAST(sum(fare) AS DOUBLE) AS revenue, {_RATIO_MINUTES} AS avg_duration,
        count(DISTINCT user_key) AS unique_passengers, count(DISTINCT vehicle_key) AS active_vehicles
        FROM s_done JOIN s_dim_route USING (route_key) WHERE day >= {AS_OF} - 7 GROUP BY 1""",
    "cohort_retention": f"""SELECT CAST(cohort AS VARCHAR) AS cohort_month, CAST(active AS VARCHAR) AS activity_month, n AS active_users,
        {_pct("n", "(first_value(n) OVER (PARTITION BY cohort ORDER BY active))")} AS retention_pct FROM (
        SELECT CAST(date_trunc('month', registration_date) AS DATE) AS cohort, CAST(date_trunc('month', day) AS DATE) AS active,
            count(DISTINCT f.user_key) AS n FROM s_done f JOIN s_dim_user u ON f.user_key = u.user_key GROUP BY 1, 2)""",
    "fare_change_demand": """SELECT route_id, route_number, CAST(base_fare AS DOUBLE) AS base_fare, CAST(effective_date AS VARCHAR) AS effective_date, n AS trips_count,
        lag(n) OVER w AS prev_trips, n - lag(n) OVER w AS demand_change FROM (
        SELECT p.route_id, p.route_number, p.base_fare, p.effective_date, count(*) AS n FROM s_done f JOIN s_dim_route r ON f.route_key = r.route_key
        JOIN s_dim_route p ON r.route_id = p.route_id AND f.day >= p.effective_date AND (f.day < p.expiration_date OR p.expiration_date IS NULL)
        GROUP BY 1, 2, 3, 4) WINDOW w AS (PARTITION BY route_id ORDER BY effective_date)""",
    "rfm_scores": """SELECT username, CAST(recency_days AS BIGINT) AS recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary, r_score, f_score, m_score,
        CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'VIP' WHEN f_score >= 4 THEN 'Loyal' WHEN r_score <= 2 THEN 'At Risk' ELSE 'Regular' END AS rfm_segment
        FROM (SELECT *, ntile(5) OVER (ORDER BY recency_days DESC NULLS FIRST, user_key) AS r_score, ntile(5) OVER (ORDER BY frequency, user_key) AS f_score,
            ntile(5) OVER (ORDER BY monetary ASC NULLS LAST, user_key) AS m_score FROM s_rfm)
        ORDER BY monetary DESC NULLS FIRST, user_key LIMIT 100""",
    "completed_trips_view": """SELECT f.trip_id, u.user_id, username, user_segment, r.route_id, route_number, route_name, transport_type,
        CAST(base_fare AS DOUBLE) AS base_fare, v.vehicle_id, vehicle_type, a.station_name AS start_station, b.station_name AS end_station,
        CAST(day AS VARCHAR) AS trip_date, dayname(day) AS day_name, dayofweek(day) IN (0, 6) AS is_weekend, m.hour AS start_hour, m.time_period,
        m.is_rush_hour, CAST(distance_km AS DOUBLE) AS distance_km, minutes AS duration_minutes, CAST(fare AS DOUBLE) AS actual_fare,
        CAST(start_time AS VARCHAR) AS start_timestamp, CAST(end_time AS VARCHAR) AS end_timestamp
        FROM s_done f JOIN s_dim_user u ON f.user_key = u.user_key JOIN s_dim_route r ON f.route_key = r.route_key
        JOIN s_minutes m ON f.minute_key = m.time_key LEFT JOIN s_dim_vehicle v ON f.vehicle_key = v.vehicle_key
        LEFT JOIN s_dim_station a ON start_station_id = a.station_id LEFT JOIN s_dim_station b ON end_station_id = b.station_id""",
    "success_txn_view": """SELECT transaction_id, t.user_id, username, payment_method_name, payment_category, CAST(CAST(transaction_date AS DATE) AS VARCHAR) AS transaction_date,
        dayname(t.transaction_date) AS day_name, dayofweek(t.transaction_date) IN (0, 6) AS is_weekend, hour(t.transaction_date) AS hour, CAST(amount AS DOUBLE) AS amount,
        transaction_type, CAST(t.transaction_date AS VARCHAR) AS transaction_timestamp
        FROM s_txns t JOIN s_methods USING (payment_method) JOIN s_dim_user u ON t.user_id = u.user_id WHERE t.status = 'success'""",
    "latest_positions": f"""SELECT position_id, p.vehicle_id, vehicle_type, r.route_id, route_number, route_name, CAST(latitude AS DOUBLE) AS latitude,
        CAST(longitude AS DOUBLE) AS longitude, {_PING_SPEED} AS speed_kmh, bearing AS direction_degree, CAST(ts AS VARCHAR) AS recorded_at,
        (epoch_us({PING_AS_OF}) - epoch_us(ts)) / 1e6 / 60 AS minutes_ago
        FROM (SELECT *, rank() OVER (PARTITION BY vehicle_id ORDER BY ts DESC) AS rk FROM s_pings WHERE ts > {PING_AS_OF} - INTERVAL 1440 MINUTE) p
        JOIN s_dim_vehicle v ON p.vehicle_id = v.vehicle_id JOIN s_dim_route r ON p.route_id = r.route_id AND r.version = 1 WHERE rk = 1""",
    "active_users": f"""SELECT user_key, user_id, username, email, full_name, age_group, current_status, CAST(current_balance AS DOUBLE) AS current_balance,
        user_segment, CAST(registration_date AS VARCHAR) AS registration_date, CAST({AS_OF} - registration_date AS BIGINT) AS days_since_registration
        FROM s_dim_user WHERE current_status = 'active'""",
    "active_vehicles": f"""SELECT vehicle_key, vehicle_id, vehicle_type, vehicle_type_name, current_route_id, route_number, route_name,
        {_long("capacity", "vehicle_age")}, model, maintenance_status, CAST(last_maintenance_date AS VARCHAR) AS last_maintenance_date,
        CAST({AS_OF} - last_maintenance_date AS BIGINT) AS days_since_maintenance
        FROM s_dim_vehicle LEFT JOIN (SELECT * FROM s_dim_route WHERE is_current) ON current_route_id = route_id WHERE current_status = 'active'""",
    "active_trips": f"""SELECT trip_id, t.user_id, username, t.route_id, route_number, route_name, vehicle_id, CAST(start_time AS VARCHAR) AS start_time,
        start_station_id, station_name AS start_station_name, (epoch_us({AS_OF_TS}) - epoch_us(start_time)) / 1e6 / 60 AS duration_minutes
        FROM s_trips t JOIN s_users u ON t.user_id = u.user_id JOIN s_routes r ON t.route_id = r.route_id
        LEFT JOIN s_dim_station ON start_station_id = station_id WHERE t.status = 'in_progress'""",
    "user_statistics": """SELECT u.user_id, username, email, CAST(balance AS DOUBLE) AS balance, coalesce(n, 0) AS total_trips, coalesce(done, 0) AS completed_trips,
        CAST(coalesce(spent, 0) AS DOUBLE) AS total_spent, CAST(last_trip AS VARCHAR) AS last_trip_date FROM s_users u
        LEFT JOIN (SELECT user_id, count(DISTINCT trip_id) AS n, count(DISTINCT CASE WHEN status = 'completed' THEN trip_id END) AS done,
            max(start_time) AS last_trip FROM s_trips GROUP BY 1) t ON u.user_id = t.user_id
        LEFT JOIN (SELECT user_id, sum(amount) AS spent FROM s_txns WHERE transaction_type = 'payment' AND status = 'success' GROUP BY 1) x
            ON u.user_id = x.user_id WHERE u.status = 'active'""",
    "popular_routes_30d": f"""SELECT route_id, c.route_number, c.route_name, c.transport_type, n AS total_trips, passengers AS unique_passengers,
        CAST(revenue AS DOUBLE) AS total_revenue, avg_duration_minutes, avg_distance_km FROM (
        SELECT route_id, count(*) AS n, count(DISTINCT user_key) AS passengers, sum(fare) AS revenue, {_RATIO_MINUTES} AS avg_duration_minutes,
            {_ratio("sum(distance_km)", "count(*)")} AS avg_distance_km FROM s_done JOIN s_dim_route USING (route_key) WHERE day >= {AS_OF} - 30 GROUP BY 1)
        JOIN (SELECT * FROM s_dim_route WHERE is_current) c USING (route_id)""",
    "refresh_route_hourly": f"""SELECT route_key, date_key, CAST(h AS BIGINT) AS hour, count(*) AS total_trips, count(DISTINCT user_key) AS total_passengers,
        CAST(sum(distance_km) AS DOUBLE) AS total_distance_km, CAST(sum(fare) AS DOUBLE) AS total_revenue, {_RATIO_MINUTES} AS avg_trip_duration_minutes
        FROM s_done WHERE day BETWEEN DATE '2001-06-01' AND DATE '2001-07-31' GROUP BY 1, 2, 3""",
    "route_hour_vehicle_stats": f"""SELECT route_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, hour(ts) AS hour, {_ratio("sum(speed)", "count(*)")} AS avg_speed,
        {_ratio("sum(occupancy_level)", "count(*)")} AS avg_occupancy_level, count(DISTINCT vehicle_id) AS active_vehicles_count
        FROM s_pings JOIN s_levels USING (occupancy) GROUP BY 1, 2, 3""",
    "user_daily_stats": f"""SELECT user_key, date_key, count(*) AS trips_count, CAST(sum(distance_km) AS DOUBLE) AS total_distance_km,
        CAST(sum(fare) AS DOUBLE) AS total_spent, count(DISTINCT route_key) AS unique_routes_count, {_RATIO_MINUTES} AS avg_trip_duration_minutes
        FROM s_done GROUP BY 1, 2""",
    "mart_route_hourly": f"""SELECT route_id, route_number, route_name, transport_type, CAST(day AS VARCHAR) AS date, CAST(h AS BIGINT) AS hour, trips AS total_trips,
        passengers AS unique_passengers, CAST(km AS DOUBLE) AS total_distance_km, avg_minutes AS avg_trip_duration_minutes,
        CAST(revenue AS DOUBLE) AS total_revenue, {_ratio("revenue", "trips")} AS avg_fare FROM s_mart_hourly""",
    "station_popularity": f"""SELECT s.station_id, station_name, station_type, district, CAST(d.day AS VARCHAR) AS date, dep AS departures_count,
        coalesce(arr, 0) AS arrivals_count, dep + coalesce(arr, 0) AS total_traffic, greatest(du, coalesce(au, 0)) AS unique_users, eu AS unique_users_exact
        FROM (SELECT start_station_id AS station_id, day, count(*) AS dep, count(DISTINCT user_key) AS du FROM s_done WHERE day >= {AS_OF} - 30 GROUP BY 1, 2) d
        LEFT JOIN (SELECT end_station_id AS station_id, day, count(*) AS arr, count(DISTINCT user_key) AS au FROM s_done GROUP BY 1, 2) a
            ON d.station_id = a.station_id AND d.day = a.day
        JOIN (SELECT station_id, day, count(DISTINCT user_key) AS eu FROM (SELECT start_station_id AS station_id, day, user_key FROM s_done
            UNION ALL SELECT end_station_id, day, user_key FROM s_done) GROUP BY 1, 2) e ON d.station_id = e.station_id AND d.day = e.day
        JOIN s_dim_station s ON d.station_id = s.station_id""",
    "passenger_flow_by_hour": f"""SELECT CAST(day AS VARCHAR) AS date, CAST(h AS BIGINT) AS hour, CAST(dow AS BIGINT) AS day_of_week, CAST(weekend AS BIGINT) AS is_weekend,
        CAST(rush AS BIGINT) AS is_rush_hour, bus AS bus_trips, tram AS tram_trips, metro AS metro_trips, trips AS total_trips,
        CAST(revenue AS DOUBLE) AS total_revenue, {_ratio("revenue", "trips")} AS avg_revenue_per_trip, passengers AS unique_passengers
        FROM s_flow WHERE day >= {AS_OF} - 30""",
    "user_segmentation": """SELECT m.user_id, m.username, CAST(m.registration_date AS VARCHAR) AS registration_date, segment AS user_segment, recent AS trips_last_30d,
        CAST(recent_spent AS DOUBLE) AS total_spent_last_30d, CAST(CAST(recent AS DOUBLE) / 4 AS DOUBLE) AS avg_trips_per_week, trips AS trips_total,
        CAST(spent AS DOUBLE) AS total_spent_total, coalesce(CAST(f.route_id AS VARCHAR), 'N/A') AS favorite_route_id, coalesce(f.n, 0) AS favorite_route_trips,
        CAST(last_day AS VARCHAR) AS last_trip_date, CAST(idle AS BIGINT) AS days_since_last_trip
        FROM s_segment_mart m LEFT JOIN s_favourite f ON m.user_id = f.user_key""",
    "route_performance": f"""SELECT route_id, route_number, route_name, transport_type, CAST(day AS VARCHAR) AS date, CAST(revenue AS DOUBLE) AS total_revenue,
        CASE WHEN km > 0 THEN {_ratio("revenue", "km")} ELSE 0 END AS revenue_per_km, {_ratio("revenue", "vehicles")} AS revenue_per_vehicle, n AS total_trips,
        CAST(km AS DOUBLE) AS total_distance_km, avg_minutes AS avg_trip_duration_minutes, vehicles AS active_vehicles_count,
        {_pct("done", "n")} AS completion_rate, {_pct("gone", "n")} AS cancellation_rate,
        row_number() OVER (PARTITION BY day ORDER BY n DESC, route_id) AS popularity_rank FROM (
        SELECT route_id, route_number, route_name, transport_type, day, sum(fare) AS revenue, count(*) AS n, sum(distance_km) AS km,
            {_RATIO_MINUTES} AS avg_minutes, count(DISTINCT vehicle_key) AS vehicles, count(*) FILTER (status = 'completed') AS done,
            count(*) FILTER (status = 'cancelled') AS gone FROM s_fact JOIN s_dim_route USING (route_key) WHERE day >= {AS_OF} - 30 GROUP BY 1, 2, 3, 4, 5)""",
    "speed_analysis": f"""SELECT s.*, route_number, transport_type FROM (
        SELECT route_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, hour(ts) AS hour, {_ratio("sum(speed)", "count(*)")} AS avg_speed,
            CAST(max(speed) AS DOUBLE) AS max_speed, CAST(min(speed) AS DOUBLE) AS min_speed,
            round(quantile_cont(CAST(speed AS DOUBLE), 0.5), 6) AS median_speed, count(*) AS measurements_count FROM s_pings GROUP BY 1, 2, 3) s
        LEFT JOIN (SELECT * FROM s_dim_route WHERE is_current) r ON s.route_id = r.route_id""",
    "mart_top_revenue": """SELECT route_number, route_name, CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(sum(trips) AS BIGINT) AS trips FROM s_mart_hourly
        GROUP BY 1, 2 ORDER BY sum(s_mart_hourly.revenue) DESC, 1, 2 LIMIT 10""",
    "mart_hourly_averages": f"""SELECT CAST(h AS BIGINT) AS hour, {_ratio("sum(trips)", "count(*)")} AS avg_trips, {_ratio("sum(revenue)", "count(*)")} AS avg_revenue,
        {_ratio("sum(passengers)", "count(*)")} AS avg_passengers FROM s_flow WHERE day >= {AS_OF} - 7 GROUP BY 1""",
    "mart_segment_profile": f"""SELECT segment AS user_segment, count(*) AS users_count, {_ratio("sum(recent)", "count(*)")} AS avg_trips,
        {_ratio("sum(recent_spent)", "count(*)")} AS avg_spent, {_ratio("sum(idle)", "count(*)")} AS avg_days_inactive FROM s_segment_mart GROUP BY 1""",
    "account_balance": """SELECT user_id, CAST(sum(CASE WHEN status <> 'success' THEN 0 WHEN transaction_type = 'payment' THEN -amount ELSE amount END) AS DOUBLE) AS balance,
        count(*) AS transactions FROM s_txns GROUP BY 1""",
    "running_balance": """SELECT transaction_id, user_id, CAST(transaction_date AS VARCHAR) AS transaction_date, transaction_type, status, CAST(amount AS DOUBLE) AS amount,
        CAST(sum(CASE WHEN status <> 'success' THEN 0 WHEN transaction_type = 'payment' THEN -amount ELSE amount END)
            OVER (PARTITION BY user_id ORDER BY transaction_date, transaction_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_balance FROM s_txns""",
    "ping_kinematics": """SELECT position_id, vehicle_id, secs AS elapsed_seconds, round(km, 4) AS distance_km, round(km * 3600 / nullif(secs, 0), 3) AS implied_kmh,
        CAST(speed AS DOUBLE) AS speed FROM (SELECT *, (epoch_us(ts) - epoch_us(pts)) / 1e6 AS secs,
        2 * 6371.0 * asin(least(1.0, sqrt(pow(sin((radians(la) - radians(pla)) / 2), 2)
            + cos(radians(pla)) * cos(radians(la)) * pow(sin((radians(lo) - radians(plo)) / 2), 2)))) AS km
        FROM (SELECT *, CAST(latitude AS DOUBLE) AS la, CAST(longitude AS DOUBLE) AS lo, lag(ts) OVER w AS pts,
            lag(CAST(latitude AS DOUBLE)) OVER w AS pla, lag(CAST(longitude AS DOUBLE)) OVER w AS plo FROM s_pings
            WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts, position_id)))""",
    "occupancy_by_period": f"""SELECT period, occupancy, n AS pings, {_pct("n", "(sum(n) OVER (PARTITION BY period))")} AS share_pct FROM (
        SELECT CASE WHEN hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 19 THEN 'rush' ELSE 'off_peak' END AS period, occupancy, count(*) AS n
        FROM s_pings GROUP BY 1, 2)""",
    "delay_state": """SELECT vehicle_id, CAST(spell AS BIGINT) AS spell, CAST(stopped_at AS VARCHAR) AS stopped_at, CAST(until AS VARCHAR) AS until, slow_pings, moved_on,
        (epoch_us(until) - epoch_us(stopped_at)) / 1e6 / 60 AS delay_minutes FROM s_spells""",
    "route_reachability": """SELECT route_id, station_id, seq, CAST(minutes_from_start AS BIGINT) AS minutes_from_start, CAST(km_from_start AS DOUBLE) AS km_from_start,
        count(*) OVER a AS stops_ahead, CAST(coalesce(sum(travel_minutes) OVER a, 0) AS BIGINT) AS minutes_ahead,
        CAST(coalesce(sum(distance_km) OVER a, 0) AS DOUBLE) AS km_ahead FROM s_stops
        WINDOW a AS (PARTITION BY route_id ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""",
    "route_legs": """SELECT a.route_id, a.seq AS start_seq, CAST(a.seq + a.travel_minutes - 1 AS BIGINT) AS end_seq, coalesce(b.seq > a.seq, FALSE) AS feasible,
        CAST(CASE WHEN b.seq > a.seq THEN b.minutes_from_start - a.minutes_from_start END AS BIGINT) AS ride_minutes,
        CAST(CASE WHEN b.seq > a.seq THEN b.km_from_start - a.km_from_start END AS DOUBLE) AS ride_km
        FROM s_stops a LEFT JOIN s_stops b ON a.route_id = b.route_id AND b.seq = a.seq + a.travel_minutes - 1""",
    "type_compat_join": """SELECT transport_type, stations, routes FROM
        (SELECT CASE n_nationkey % 3 WHEN 0 THEN 'bus' WHEN 1 THEN 'tram' ELSE 'metro' END AS transport_type, count(*) AS stations FROM nation GROUP BY 1)
        JOIN (SELECT transport_type, count(*) AS routes FROM s_routes GROUP BY 1) USING (transport_type)""",
    "json_suggestions": """SELECT CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 2 END AS BIGINT) AS suggestions,
        CASE WHEN event_type = 'view' THEN 'none' WHEN event_type <> 'error' AND event_id % 4 < 2 THEN 'suggested' ELSE 'other' END AS selection,
        count(*) AS searches FROM events GROUP BY 1, 2""",
    "interval_coverage": """SELECT subscription_type, CAST(day AS VARCHAR) AS day, CAST(sum(delta) OVER (PARTITION BY subscription_type ORDER BY day) AS BIGINT) AS active FROM (
        SELECT subscription_type, day, sum(delta) AS delta FROM (SELECT subscription_type, start_date AS day, 1 AS delta FROM s_subs
        UNION ALL SELECT subscription_type, end_date + 1, -1 FROM s_subs) GROUP BY 1, 2)""",
    "interval_overlaps": """SELECT user_id, subscriptions, CAST(most AS BIGINT) AS most_at_once, days AS days_overlapping FROM
        (SELECT user_id, count(*) AS subscriptions FROM s_subs GROUP BY 1) JOIN
        (SELECT user_id, max(n) AS most, count(*) FILTER (n > 1) AS days FROM (
            SELECT user_id, d, count(*) AS n FROM (SELECT user_id, unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS d FROM s_subs) GROUP BY 1, 2)
        GROUP BY 1) USING (user_id)""",
    "stream_ping_ingest": """SELECT CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'bad timestamp' END AS error,
        CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(date_trunc('hour', ts) AS VARCHAR) END AS hour, count(*) AS records,
        CAST(sum(CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(value AS DECIMAL(10,2)) END) AS DOUBLE) AS speed_sum,
        count(DISTINCT CASE WHEN event_type NOT IN ('error', 'signup') THEN user_id END) AS vehicles FROM events GROUP BY 1, 2""",
    "stream_dedup": "SELECT position_id, vehicle_id, CAST(ts AS VARCHAR) AS ts, CAST(speed AS DOUBLE) AS speed FROM s_pings",
    "stream_hourly_speed": f"""SELECT CAST(w AS VARCHAR) AS window_start, CAST(w + INTERVAL 1 HOUR AS VARCHAR) AS window_end, route_id, avg_speed, min_speed, max_speed,
        median_speed, measurements_count, active_vehicles FROM (SELECT date_trunc('hour', ts) AS w, route_id, {_ratio("sum(speed)", "count(*)")} AS avg_speed,
            CAST(min(speed) AS DOUBLE) AS min_speed, CAST(max(speed) AS DOUBLE) AS max_speed,
            round(quantile_cont(CAST(speed AS DOUBLE), 0.5), 6) AS median_speed, count(*) AS measurements_count,
            count(DISTINCT vehicle_id) AS active_vehicles FROM s_pings GROUP BY 1, 2), s_cutoff
        WHERE w + INTERVAL 1 HOUR <= cut""",
    "stream_sliding_load": f"""SELECT CAST(w AS VARCHAR) AS window_start, CAST(w + INTERVAL 15 MINUTE AS VARCHAR) AS window_end, route_id, avg_level, pings FROM (
        SELECT time_bucket(INTERVAL 5 MINUTE, ts) - back * INTERVAL 5 MINUTE AS w, route_id, {_ratio("sum(occupancy_level)", "count(*)")} AS avg_level, count(*) AS pings
        FROM s_pings JOIN s_levels USING (occupancy), (VALUES (0), (1), (2)) AS b(back) GROUP BY 1, 2), s_cutoff WHERE w + INTERVAL 15 MINUTE <= cut""",
    "stream_vehicle_sessions": """SELECT CAST(a AS VARCHAR) AS window_start, CAST(b + INTERVAL 30 MINUTE AS VARCHAR) AS window_end, vehicle_id, pings, max_speed FROM (
        SELECT vehicle_id, grp, min(ts) AS a, max(ts) AS b, count(*) AS pings, CAST(max(speed) AS DOUBLE) AS max_speed FROM (
            SELECT *, sum(CASE WHEN ts - before < INTERVAL 30 MINUTE THEN 0 ELSE 1 END) OVER (PARTITION BY vehicle_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS grp
            FROM (SELECT *, lag(ts) OVER (PARTITION BY vehicle_id ORDER BY ts) AS before FROM s_pings)) GROUP BY 1, 2), s_cutoff
        WHERE b + INTERVAL 30 MINUTE <= cut""",
    "stream_latest_position": """SELECT position_id, vehicle_id, route_id, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
        CAST(speed AS DOUBLE) AS speed, bearing, occupancy, CAST(ts AS VARCHAR) AS ts FROM (
        SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY ts DESC, position_id DESC) AS rn FROM s_pings) WHERE rn = 1""",
    "stream_delay_state": """SELECT vehicle_id, CAST(stopped_at AS VARCHAR) AS stopped_at, CAST(until AS VARCHAR) AS until,
        (epoch_us(until) - epoch_us(stopped_at)) / 1e6 / 60 AS delay_minutes, slow_pings FROM s_spells, s_cutoff
        WHERE moved_on AND until <= date_trunc('milliseconds', cut)""",
    "position_fact_load": f"""SELECT v.vehicle_key, r.route_key, {_date_key("ts")} AS date_key, {_time_key("ts")} AS time_key, {_minute_key("ts")} AS minute_key,
        CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, CAST(speed AS DOUBLE) AS speed_kmh, bearing AS direction_degree,
        CAST(ts AS VARCHAR) AS recorded_at FROM s_pings p LEFT JOIN s_dim_vehicle v ON p.vehicle_id = v.vehicle_id
        LEFT JOIN s_dim_route r ON p.route_id = r.route_id AND r.is_current""",
}
QUERIES["mart_incremental"] = QUERIES["mart_route_hourly"]
QUERIES["build_all_marts"] = _union(*[
    f"SELECT '{mart}' AS mart, count(*) AS row_count, CAST(sum({total}) AS BIGINT) AS total, '2001-08-01 06:30:00' AS updated_at FROM ({QUERIES[key]})"
    for mart, total, key in (
        ("mart_route_hourly_stats", "total_trips", "mart_route_hourly"), ("mart_station_popularity", "total_traffic", "station_popularity"),
        ("mart_passenger_flow_by_hour", "unique_passengers", "passenger_flow_by_hour"),
        ("mart_user_segmentation", "trips_total", "user_segmentation"), ("mart_route_performance", "popularity_rank", "route_performance"),
    )
])


def with_sources(sql: str) -> str:
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in SOURCES:
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(SOURCES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ", ".join(f"{n} AS ({SOURCES[n]})" for n in needed) + " " + sql


def oracle_sql() -> dict[str, str]:
    return {name: with_sources(sql) for name, sql in QUERIES.items()}
