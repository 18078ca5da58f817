"""The registered queries as plain SQL over the given tables."""

from __future__ import annotations

import re

STOP_ID = "(8500000 + {k})::VARCHAR || CASE WHEN {k} % 4 = 0 THEN ':0:A' ELSE '' END"
X0 = "(6.497::DOUBLE + {k} % 10 * 0.006::DOUBLE)"
Y0 = "(46.498::DOUBLE + {k} // 10 * 0.004::DOUBLE)"
RADIUS = "6371008.0::DOUBLE"
SPEED = "(50.0::DOUBLE / 60)"


def stop_id(k: str) -> str:
    return STOP_ID.format(k=k)


def distance(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"2 * {RADIUS} * asin(sqrt(least(1.0, pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


def clock(s: str) -> str:
    return f"printf('%02d:%02d:%02d', ({s}) // 3600, ({s}) % 3600 // 60, ({s}) % 60)"


DEPARTS = "(21600 + l_orderkey * 97 % 72000 + l_linenumber * 240)"
LINE_DEPARTS = "(21600 + l_orderkey * 97 % 72000 + line * 240)"

# Each table: name, SQL. A query uses the tables it names and those they name.
def mean(column: str, keys: str) -> str:
    """Mean over a window from sums of whole 2^-30 units, which no order of adding changes."""
    return (
        f"(sum(floor({column}::DOUBLE * 1073741824 + 0.5)::HUGEINT) OVER (PARTITION BY {keys}))::DOUBLE"
        f" / count({column}) OVER (PARTITION BY {keys}) / 1073741824"
    )


TABLES = {
    "fx_stops": f"""
        SELECT {stop_id('s_suppkey')} AS stop_id, s_name AS stop_name,
               46.50::DOUBLE + s_suppkey // 10 * 0.004::DOUBLE AS stop_lat,
               6.50::DOUBLE + s_suppkey % 10 * 0.006::DOUBLE AS stop_lon,
               CASE WHEN s_suppkey % 11 = 10 THEN '1' END AS location_type,
               CASE WHEN s_suppkey % 5 = 0 THEN 'Parent' || (8500000 + s_suppkey) END AS parent_station,
               CASE WHEN s_suppkey % 23 = 22 THEN DATE '2024-09-01' ELSE DATE '2024-04-01' END AS pub_date
        FROM supplier""",
    "fx_shapes": f"""
        SELECT 'D' || (s_suppkey % 10) || ' ' AS uuid,
               CASE WHEN s_suppkey % 13 = 5 THEN 'canton' ELSE 'district' END AS level,
               {X0.format(k='s_suppkey')} AS x0, {X0.format(k='s_suppkey')} + 0.006::DOUBLE AS x1,
               {X0.format(k='s_suppkey')} + CASE WHEN s_suppkey % 17 = 3 THEN 0.002::DOUBLE ELSE 0.005::DOUBLE END AS xm,
               {Y0.format(k='s_suppkey')} AS y0, {Y0.format(k='s_suppkey')} + 0.004::DOUBLE AS y1,
               {Y0.format(k='s_suppkey')} + CASE WHEN s_suppkey % 17 = 3 THEN 0.001::DOUBLE ELSE 0.003::DOUBLE END AS ym
        FROM supplier""",
    "fx_regions": "SELECT * FROM fx_shapes WHERE level = 'district' AND trim(uuid) <> 'D9'",
    "fx_snapshot": "SELECT max(pub_date) AS pub_date FROM fx_stops WHERE pub_date <= DATE '2024-06-03'",
    "fx_inside": """
        SELECT DISTINCT s.* FROM fx_stops s JOIN fx_regions r
          ON s.stop_lon > r.x0 AND s.stop_lon < r.x1 AND s.stop_lat > r.y0 AND s.stop_lat < r.y1
         AND NOT (s.stop_lon >= r.xm AND s.stop_lat >= r.ym)
        WHERE s.location_type IS NULL""",
    "fx_region_stops": """
        SELECT DISTINCT stop_id, stop_name, stop_lat, stop_lon, replace(parent_station, 'Parent', '') AS parent_stop_id
        FROM fx_inside JOIN fx_snapshot USING (pub_date)""",
    "fx_calendar": """
        SELECT 'S' || n_nationkey AS service_id, n_nationkey % 7 AS p,
               p <= 4 OR p = 5 AS monday, p <= 4 OR p = 5 AS tuesday, p <= 4 OR p = 5 AS wednesday,
               p <= 4 OR p = 5 AS thursday, p <= 3 AS friday, p = 6 AS saturday, p IN (5, 6) AS sunday,
               DATE '2024-01-01' AS start_date,
               CASE WHEN p = 3 THEN DATE '2024-03-01' ELSE DATE '2024-12-31' END AS end_date
        FROM nation""",
    "fx_lines": """
        SELECT *, row_number() OVER (PARTITION BY l_orderkey
                    ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS line
        FROM lineitem""",
    "fx_times": f"""
        SELECT 'T' || l_orderkey AS trip_id, {stop_id('l_suppkey')} AS stop_id, line AS stop_sequence,
               l_orderkey, {LINE_DEPARTS} AS dep_raw, {LINE_DEPARTS} - 30 AS arr_raw,
               dep_raw // 86400 AS shift, (dep_raw % 86400)::INT AS dep_s, (arr_raw % 86400)::INT AS arr_s
        FROM fx_lines""",
    "fx_timetable": """
        SELECT t.trip_id, t.stop_id, t.stop_sequence, t.arr_s, t.dep_s, t.shift::INT AS shift, s.stop_name, s.stop_lat,
               s.stop_lon, s.parent_stop_id, 'R' || (o.o_custkey % 25) AS route_id,
               'S' || (o.o_orderkey % 25) AS service_id, (o.o_orderkey % 2)::INT AS direction_id,
               o.o_orderpriority AS trip_headsign, n.n_name AS route_short_name, 'B' AS route_desc
        FROM fx_times t
        JOIN fx_region_stops s USING (stop_id)
        JOIN orders o ON o.o_orderkey = t.l_orderkey
        JOIN nation n ON n.n_nationkey = o.o_custkey % 25
        JOIN fx_calendar c ON c.service_id = 'S' || (o.o_orderkey % 25)
        WHERE DATE '2024-06-03' BETWEEN c.start_date AND c.end_date
          AND t.arr_s <= 72000 AND t.dep_s >= 7 * 3600 AND t.arr_s < 21 * 3600
          AND CASE t.shift WHEN 0 THEN c.monday AND c.tuesday AND c.wednesday AND c.thursday AND c.friday
                           WHEN 1 THEN c.sunday AND c.monday AND c.tuesday AND c.wednesday AND c.thursday END""",
    "fx_ends": """
        SELECT * FROM fx_timetable
        QUALIFY row_number() OVER (PARTITION BY trip_id, direction_id, stop_sequence ORDER BY arr_s DESC, dep_s DESC, stop_id DESC) = 1""",
    "fx_starts": """
        SELECT * FROM fx_timetable
        QUALIFY row_number() OVER (PARTITION BY trip_id, direction_id, stop_sequence ORDER BY arr_s DESC, dep_s DESC, stop_id DESC) = 1""",
    "fx_hops": """
        SELECT a.stop_id AS source_stop_id, a.stop_name AS source_stop_name, a.stop_lon AS source_stop_lon,
               a.stop_lat AS source_stop_lat, a.parent_stop_id AS source_parent_stop_id,
               b.stop_id AS target_stop_id, b.stop_name AS target_stop_name, b.stop_lon AS target_stop_lon,
               b.stop_lat AS target_stop_lat, b.parent_stop_id AS target_parent_stop_id, a.trip_id, a.direction_id,
               a.route_short_name || ' - ' || a.route_desc || ' (' || a.trip_headsign || ')' AS trip_description,
               a.stop_sequence AS source_stop_sequence, b.dep_s, a.arr_s
        FROM fx_ends a JOIN fx_starts b
          ON a.trip_id = b.trip_id AND a.direction_id = b.direction_id
         AND a.stop_sequence = b.stop_sequence + 1 AND a.stop_id <> b.stop_id""",
    "fx_runs": """
        SELECT *, max(CASE WHEN breaks THEN source_stop_sequence END)
                    OVER (PARTITION BY trip_id, direction_id ORDER BY source_stop_sequence) AS run_start
        FROM (SELECT *, coalesce(lag(source_stop_sequence) OVER w <> source_stop_sequence - 1
                                 OR lag(arr_s) OVER w > dep_s
                                 OR lag(source_stop_id) OVER w <> target_stop_id, true) AS breaks
              FROM fx_hops WHERE dep_s <= arr_s
              WINDOW w AS (PARTITION BY trip_id, direction_id ORDER BY source_stop_sequence))""",
    "fx_pairs": f"""
        SELECT a.stop_id AS source_stop_id, b.stop_id AS target_stop_id, a.stop_name AS source_stop_name,
               a.stop_lon AS source_stop_lon, a.stop_lat AS source_stop_lat, a.parent_stop_id AS source_parent_stop_id,
               b.stop_name AS target_stop_name, b.stop_lon AS target_stop_lon, b.stop_lat AS target_stop_lat,
               b.parent_stop_id AS target_parent_stop_id,
               {distance('a.stop_lon', 'a.stop_lat', 'b.stop_lon', 'b.stop_lat')} AS metres
        FROM fx_region_stops a JOIN fx_region_stops b ON a.stop_id <> b.stop_id WHERE metres <= 1000""",
    "fx_transfers": f"""
        SELECT {stop_id('s_suppkey')} AS from_stop_id, {stop_id('(s_suppkey + 1)')} AS to_stop_id,
               (60 * (s_suppkey % 30))::INT AS transfer_time FROM supplier""",
    "fx_walks": f"""
        SELECT p.* EXCLUDE (metres), trunc(metres / {SPEED})::BIGINT AS walk_s,
               coalesce(t.transfer_time, 0) AS transfer_time
        FROM fx_pairs p LEFT JOIN fx_transfers t ON t.from_stop_id = source_stop_id AND t.to_stop_id = target_stop_id""",
    "fx_network": """
        SELECT source_stop_id, target_stop_id, trip_id, trip_description, source_stop_sequence, 'ride' AS kind,
               0 AS transfer_time, dep_s, arr_s, NULL::BIGINT AS walk_s FROM fx_hops
        UNION ALL
        SELECT source_stop_id, target_stop_id, 'walking', 'Walking', NULL, 'walk', transfer_time, NULL, NULL, walk_s
        FROM fx_walks""",
    "fx_arrivals": """
        SELECT 8500000 + l_suppkey AS bpuic, day AS operating_day,
               day::TIMESTAMP + to_seconds(l_linenumber * 10800 + 7200 + l_partkey % 60 * 60) AS arr_time,
               CASE WHEN l_partkey % 13 <> 0 THEN arr_time + INTERVAL 1 MINUTE END AS dep_time,
               CASE WHEN l_partkey % 17 <> 0 THEN arr_time + to_seconds((l_quantity * 40 - 100)::INT) END AS arr_actual,
               ['REAL', 'GESCHAETZT', 'PROGNOSE', 'UNBEKANNT'][l_orderkey % 4 + 1] AS arr_status,
               ['Bus', 'BUS', 'Zug', 'Tram', 'Metro', 'Taxi', 'Schiff', '', NULL][l_orderkey % 9 + 1] AS product_id,
               l_partkey % 19 = 0 AS unplanned, l_partkey % 23 = 0 AS failed, l_partkey % 29 = 0 AS transit
        FROM (SELECT *, DATE '2024-01-01' + (date_diff('day', DATE '1995-01-01', l_shipdate::DATE) % 30)::INT AS day
              FROM lineitem)""",
    "fx_usable": """
        SELECT * FROM fx_arrivals
        WHERE NOT unplanned AND NOT failed AND NOT transit AND arr_status <> 'UNBEKANNT'
          AND product_id NOT IN ('Taxi', 'Schiff', '') AND arr_actual IS NOT NULL
          AND operating_day BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
          AND dayofweek(operating_day) BETWEEN 1 AND 5 AND hour(arr_time) <= 20 AND hour(dep_time) >= 7""",
    "fx_clean": """
        SELECT DISTINCT bpuic::VARCHAR AS stop_id, operating_day, arr_time,
               greatest(0, least(1800, epoch(arr_actual)::BIGINT - epoch(arr_time)::BIGINT)) AS delay,
               CASE WHEN product_id IN ('Bus', 'BUS') THEN 'bus' WHEN product_id = 'Zug' THEN 'train'
                    WHEN product_id IN ('Tram', 'Metro') THEN 'metro' END AS type
        FROM fx_usable WHERE bpuic::VARCHAR IN (SELECT left(stop_id, 7) FROM fx_inside)""",
    "fx_stations": """
        SELECT 'Site' || (c_custkey % 3) AS site, 46.50::DOUBLE + c_custkey % 89 * 0.001::DOUBLE AS lat,
               6.50::DOUBLE + c_custkey % 97 * 0.001::DOUBLE AS lon, c_custkey % 5 <> 0 AS active
        FROM customer""",
    "fx_centroid": """
        SELECT sum(w * h * (x0 + w / 2) - cw * ch * (xm + cw / 2)) / sum(w * h - cw * ch) AS lon,
               sum(w * h * (y0 + h / 2) - cw * ch * (ym + ch / 2)) / sum(w * h - cw * ch) AS lat
        FROM (SELECT *, x1 - x0 AS w, y1 - y0 AS h, x1 - xm AS cw, y1 - ym AS ch FROM fx_regions)""",
    "fx_site": f"""
        SELECT site, {distance('s.lon', 's.lat', 'c.lon', 'c.lat')} AS metres
        FROM fx_stations s, fx_centroid c WHERE active ORDER BY metres, site LIMIT 1""",
    "fx_observations": """
        SELECT 'Site' || (user_id % 3) AS site, floor(epoch(ts))::BIGINT AS epoch_s,
               timezone('Europe/Zurich', to_timestamp(epoch_s)) AS at_local,
               CASE WHEN event_id % 4 <> 0 THEN value / 20 END AS rain,
               CASE WHEN event_id % 9 <> 0 THEN (event_id * 7 % 30 - 5)::INT END AS temperature
        FROM events""",
    "fx_weather": """
        SELECT year(at_local)::INT AS year, month(at_local)::INT AS month, day(at_local)::INT AS dayofmonth,
               hour(at_local)::INT AS hour, max(CASE WHEN a = 1 THEN rain END) AS rain,
               max(CASE WHEN b = 1 THEN temperature END) AS temperature
        FROM (SELECT *,
                row_number() OVER (PARTITION BY date_trunc('hour', at_local)
                    ORDER BY minute(at_local) DESC, epoch_s DESC, rain DESC NULLS LAST) AS a,
                row_number() OVER (PARTITION BY date_trunc('hour', at_local)
                    ORDER BY minute(at_local) DESC, epoch_s DESC, temperature DESC NULLS LAST) AS b
              FROM fx_observations
              WHERE site = (SELECT site FROM fx_site) AND at_local >= TIMESTAMP '2024-01-01'
                AND at_local <= TIMESTAMP '2024-01-31')
        GROUP BY ALL""",
    "fx_joined": """
        SELECT h.*, year(operating_day) AS year, month(operating_day) AS month, week(operating_day) AS weekofyear,
               day(operating_day) AS dayofmonth, hour(arr_time) AS hour, w.rain, w.temperature
        FROM fx_clean h LEFT JOIN fx_weather w
          ON w.year = year(operating_day) AND w.month = month(operating_day)
         AND w.dayofmonth = day(operating_day) AND w.hour = hour(arr_time)""",
    "fx_filled": f"""
        SELECT * REPLACE (
            coalesce(rain, {mean('rain', 'year, month, dayofmonth')}, {mean('rain', 'year, weekofyear')},
                     {mean('rain', 'year, month')}) AS rain,
            coalesce(temperature::DOUBLE, {mean('temperature', 'year, weekofyear, hour')},
                     {mean('temperature', 'year, month, hour')}) AS temperature)
        FROM fx_joined""",
    "fx_history": """
        SELECT * REPLACE (coalesce(rain > 2.5, false) AS rain,
            CASE WHEN temperature < 6 THEN 'low' WHEN temperature < 14 THEN 'medium' ELSE 'high' END AS temperature)
        FROM fx_filled""",
    "fx_queries": f"""
        SELECT c_custkey AS query_id, {stop_id('(c_custkey % n)')} AS from_stop_id,
               {stop_id('((c_custkey * 7 + 3) % n)')} AS to_stop_id, 36000 + 1800 * (c_custkey % 10) AS arrival_s
        FROM customer, (SELECT count(*) AS n FROM supplier)""",
    "fx_legs": f"""
        SELECT l_orderkey AS journey_id, line::INT AS leg,
               CASE WHEN p % 4 = 0 THEN 'walking' ELSE 'T' || (s % 3) END AS trip_id,
               {stop_id('s')} AS from_stop_id, {stop_id('(s + 1)')} AS to_stop_id,
               (25000 + l_orderkey % 20 * 1800 + line * 900)::INT AS dep_s,
               (25000 + l_orderkey % 20 * 1800 + line * 900 + 200 + p % 600)::INT AS arr_s,
               (25000 + l_orderkey % 20 * 1800 + 7700)::INT AS deadline_s, l_orderkey % 2 = 0 AS rain,
               ['low', 'medium', 'high'][l_orderkey % 3 + 1] AS temperature
        FROM (SELECT l_orderkey, line, l_partkey AS p, l_suppkey AS s FROM fx_lines)""",
    "fx_compressed": """
        SELECT journey_id, part::INT AS leg, any_value(trip_id) AS trip_id, arg_min(from_stop_id, leg) AS from_stop_id,
               arg_max(to_stop_id, leg) AS to_stop_id, min(dep_s) AS dep_s, arg_max(arr_s, leg) AS arr_s,
               any_value(deadline_s) AS deadline_s, any_value(rain) AS rain, any_value(temperature) AS temperature
        FROM (SELECT *, sum(starts) OVER (PARTITION BY journey_id ORDER BY leg) - 1 AS part
              FROM (SELECT *, CASE WHEN trip_id <> 'walking'
                                    AND trip_id = lag(trip_id) OVER (PARTITION BY journey_id ORDER BY leg)
                                   THEN 0 ELSE 1 END AS starts FROM fx_legs))
        GROUP BY journey_id, part""",
    "fx_slack": """
        SELECT journey_id, ride::INT AS ride, trip_id, to_stop_id, rain, temperature,
               ((arr_s + walk_s) // 3600 % 24)::INT AS hour,
               (coalesce(lead(dep_s) OVER (PARTITION BY journey_id ORDER BY ride), deadline_s) - arr_s - walk_s)::BIGINT AS slack_s
        FROM (SELECT journey_id, ride, any_value(deadline_s) AS deadline_s, any_value(rain) AS rain,
                     any_value(temperature) AS temperature,
                     max(CASE WHEN trip_id <> 'walking' THEN trip_id END) AS trip_id,
                     max(CASE WHEN trip_id <> 'walking' THEN to_stop_id END) AS to_stop_id,
                     max(CASE WHEN trip_id <> 'walking' THEN dep_s END) AS dep_s,
                     max(CASE WHEN trip_id <> 'walking' THEN arr_s END) AS arr_s,
                     sum(CASE WHEN trip_id = 'walking' THEN arr_s - dep_s ELSE 0 END) AS walk_s
              FROM (SELECT *, sum((trip_id <> 'walking')::INT) OVER (PARTITION BY journey_id ORDER BY leg) AS ride
                    FROM fx_compressed)
              WHERE ride > 0 GROUP BY journey_id, ride)""",
}

TABLES["fx_timetable_day"] = TABLES["fx_timetable"].replace(
    "t.arr_s <= 72000 AND t.dep_s >= 7 * 3600 AND t.arr_s < 21 * 3600", "true"
)


def distributions(name: str, source: str, threshold: int) -> dict[str, str]:
    """Back-off distributions of ``source`` as tables ``name`` (one row per key) and its parts."""
    picked = f"{name}_picked"
    keys = "stop_id, hour, rain, temperature"
    return {
        f"{name}_sizes": f"""
            SELECT {keys}, count(*) AS n0, sum(count(*)) OVER (PARTITION BY stop_id, hour, rain) AS n1,
                   sum(count(*)) OVER (PARTITION BY stop_id, hour) AS n2, sum(count(*)) OVER (PARTITION BY stop_id) AS n3
            FROM {source} GROUP BY {keys}""",
        picked: f"""
            SELECT {keys}, CASE WHEN n0 >= {threshold} THEN 0 WHEN n1 >= {threshold} THEN 1
                                WHEN n2 >= {threshold} THEN 2 ELSE 3 END AS level,
                   CASE level WHEN 0 THEN n0 WHEN 1 THEN n1 WHEN 2 THEN n2 ELSE n3 END::BIGINT AS sample_size
            FROM {name}_sizes WHERE n3 >= {threshold}""",
        f"{name}_samples": f"""
            SELECT p.stop_id, p.hour, p.rain, p.temperature, p.level, p.sample_size,
                   list(h.delay ORDER BY h.delay) AS delays
            FROM {picked} p JOIN {source} h
              ON h.stop_id = p.stop_id AND (p.level > 2 OR h.hour = p.hour)
             AND (p.level > 1 OR h.rain = p.rain) AND (p.level > 0 OR h.temperature = p.temperature)
            GROUP BY ALL""",
        name: f"""
            SELECT {keys}, level, sample_size,
                   list_transform(range(101), lambda p: delays[greatest(1, (p * sample_size + 99) // 100)]) AS percentiles
            FROM {name}_samples""",
    }


HISTORY = ("fx_usable", "fx_clean", "fx_weather", "fx_joined", "fx_filled", "fx_history")


def history_of(suffix: str, start: str, end: str) -> dict[str, str]:
    """The tables of the history of one period, each filled from that period alone."""
    found = {}
    for name in HISTORY:
        sql = TABLES[name].replace("'2024-01-01'", f"'{start}'").replace("'2024-01-31'", f"'{end}'")
        found[name + suffix] = re.sub(rf"\b({'|'.join(HISTORY)})\b", rf"\1{suffix}", sql)
    return found


TABLES |= history_of("_train", "2024-01-01", "2024-01-15") | history_of("_val", "2024-01-16", "2024-01-31")
TABLES |= {"fx_train": "SELECT * FROM fx_history_train", "fx_val": "SELECT * FROM fx_history_val"}
TABLES |= distributions("fx_dist", "fx_history", 30)
TABLES |= distributions("fx_dist5", "fx_history", 5)
TABLES |= distributions("fx_dist_train", "fx_train", 30)


def probability(value: str, percentiles: str) -> str:
    """Interpolated probability below a value."""
    below = f"len(list_filter({percentiles}, lambda x: x <= {value}))"
    return (
        f"CASE WHEN {value} <= {percentiles}[1] THEN 0.0 WHEN {value} >= {percentiles}[101] THEN 1.0 ELSE "
        f"({below} - 1 + ({value} - {percentiles}[{below}]) / ({percentiles}[{below} + 1] - {percentiles}[{below}])) / 100 END"
    )


def exponential(rate: str) -> str:
    return (
        f"list_transform(range(101), lambda p: CASE WHEN p = 100 THEN 'Infinity'::DOUBLE "
        f"ELSE abs(ln(1 - p / 100.0::DOUBLE)) / {rate}::DOUBLE END)"
    )


TABLES |= {
    "fx_chances": f"""
        SELECT journey_id, ride, to_stop_id, hour, slack_s, sample_size, {probability('slack', 'percentiles')} AS probability
        FROM (SELECT s.*, s.slack_s::DOUBLE AS slack, coalesce(d.sample_size, -1) AS sample_size,
                     coalesce(d.percentiles::DOUBLE[], {exponential('1.6')}) AS percentiles
              FROM fx_slack s LEFT JOIN fx_dist d
                ON d.stop_id = left(s.to_stop_id, 7) AND d.hour = s.hour AND d.rain = s.rain AND d.temperature = s.temperature)""",
}


def kolmogorov(name: str, keys: str, least: int, where: str) -> dict[str, str]:
    """Two-sample statistics per group of ``keys``."""
    return {
        f"{name}_steps": f"""
        SELECT {keys}, delay, sum(t) OVER w AS tu, sum(v) OVER w AS vu,
               sum(t) OVER (PARTITION BY {keys}) AS nt, sum(v) OVER (PARTITION BY {keys}) AS nv
        FROM (SELECT {keys}, delay, sum(t) AS t, sum(v) AS v
              FROM (SELECT *, 1 AS t, 0 AS v FROM fx_train UNION ALL SELECT *, 0, 1 FROM fx_val)
              WHERE {where} GROUP BY ALL)
        WINDOW w AS (PARTITION BY {keys} ORDER BY delay)""",
        f"{name}_groups": f"""
        SELECT {keys}, nt::BIGINT AS nt, nv::BIGINT AS nv, max(abs(tu / nt::DOUBLE - vu / nv::DOUBLE)) AS statistic,
               max(abs(tu * nv - vu * nt))::BIGINT AS gap
        FROM {name}_steps WHERE nt >= {least} AND nv >= {least} GROUP BY ALL""",
        # Share of the lattice paths to (i, s - i) that have reached the gap, diagonal by diagonal.
        f"{name}_paths": f"""
        SELECT DISTINCT nt, nv, gap, 0::BIGINT AS s, list_transform(range(0, nt + 1), lambda i: 0.0::DOUBLE) AS v FROM {name}_groups
        UNION ALL
        SELECT nt, nv, gap, s + 1, list_transform(range(0, nt + 1), lambda i:
            CASE WHEN i > s + 1 OR s + 1 - i > nv THEN 0.0::DOUBLE
                 WHEN abs(i * nv - (s + 1 - i) * nt) >= gap THEN 1.0::DOUBLE
                 ELSE i / (s + 1)::DOUBLE * coalesce(v[i], 0.0) + (s + 1 - i) / (s + 1)::DOUBLE * v[i + 1] END)
        FROM {name}_paths WHERE s < nt + nv""",
        name: f"""
        SELECT g.*, least(1.0, p.v[g.nt + 1]) AS p_value FROM {name}_groups g
        JOIN {name}_paths p ON p.nt = g.nt AND p.nv = g.nv AND p.gap = g.gap AND p.s = g.nt + g.nv""",
    }


TABLES |= kolmogorov("fx_ks", "stop_id, type", 15, "type IS NOT NULL")
TABLES |= kolmogorov("fx_ks4", "stop_id, hour, rain, temperature", 2, "true")

TABLES |= {
    "fx_calibration": """
        SELECT stop_id, hour, rain, temperature, percentile, percentile / 100.0::DOUBLE AS train_probability,
               CASE WHEN v.delays IS NULL THEN 0.0
                    ELSE len(list_filter(v.delays, lambda x: x <= value_at)) / len(v.delays)::DOUBLE END AS validation_probability
        FROM (SELECT stop_id, hour, rain, temperature, unnest(range(101)) AS percentile, unnest(percentiles) AS value_at
              FROM fx_dist_train) t
        LEFT JOIN (SELECT stop_id, hour, rain, temperature, list(delay) AS delays FROM fx_val GROUP BY ALL) v
        USING (stop_id, hour, rain, temperature)""",
    # Latest departures per search, stop, seconds walked and kind of last leg, leg by leg.
    "fx_rides": """
        SELECT j.source_stop_id AS alight, i.target_stop_id AS board, j.arr_s, i.dep_s
        FROM fx_runs j JOIN fx_runs i ON i.trip_id = j.trip_id AND i.direction_id = j.direction_id
         AND i.run_start = j.run_start AND i.source_stop_sequence <= j.source_stop_sequence""",
    "fx_labels": """
        SELECT DISTINCT to_stop_id, arrival_s, to_stop_id AS stop_id, arrival_s AS dep_s, 0::BIGINT AS walked_s,
               false AS on_foot FROM fx_queries
        UNION ALL
        SELECT to_stop_id, arrival_s, stop_id, dep_s, walked_s, on_foot FROM (
          SELECT l.to_stop_id, l.arrival_s, r.board AS stop_id, r.dep_s, l.walked_s, false AS on_foot
          FROM fx_labels l JOIN fx_rides r
            ON r.alight = l.stop_id AND r.arr_s <= l.dep_s - CASE WHEN l.on_foot THEN 0 ELSE 120 END
          UNION ALL
          SELECT l.to_stop_id, l.arrival_s, w.target_stop_id, l.dep_s - greatest(w.walk_s, w.transfer_time)::INT,
                 l.walked_s + w.walk_s, true
          FROM fx_labels l JOIN fx_walks w
            ON w.source_stop_id = l.stop_id AND l.walked_s + w.walk_s <= 1200
          WHERE l.dep_s - greatest(w.walk_s, w.transfer_time) >= 0)
        WHERE stop_id <> to_stop_id
        QUALIFY row_number() OVER (PARTITION BY to_stop_id, arrival_s, stop_id, walked_s, on_foot ORDER BY dep_s DESC) = 1""",
}
RECURSIVE = {"fx_ks_paths", "fx_ks4_paths", "fx_labels"}


def _with(select: str) -> str:
    """Prefix a select with the tables it needs, in order."""
    needed: list[str] = []

    def visit(text: str, skip: str = "") -> None:
        for name, sql in TABLES.items():
            words = text.replace(",", " ").replace(")", " ").replace("(", " ").split()
            if name != skip and name not in needed and name in words:
                visit(sql, name)
                needed.append(name)

    visit(select)
    if not needed:
        return select
    recursive = "RECURSIVE " if RECURSIVE & set(needed) else ""
    return f"WITH {recursive}" + ",\n".join(f"{n} AS ({TABLES[n]})" for n in needed) + "\n" + select


KEYS = "stop_id, hour, rain, temperature"
JOINED = "list_transform(percentiles, lambda x: x::VARCHAR)"

SELECTS = {
    "latest_snapshot": "SELECT pub_date::VARCHAR AS pub_date FROM fx_snapshot",
    "service_calendar": """
        SELECT service_id, monday, tuesday, wednesday, thursday, friday, saturday, sunday
        FROM fx_calendar WHERE DATE '2024-06-03' BETWEEN start_date AND end_date""",
    "history_clean": """
        SELECT stop_id, operating_day::VARCHAR AS operating_day, strftime(arr_time, '%Y-%m-%d %H:%M:%S') AS arr_time,
               delay, type FROM fx_clean""",
    "weekday_hours": """
        SELECT bpuic, operating_day::VARCHAR AS operating_day, product_id, count(*) AS n
        FROM fx_usable GROUP BY ALL""",
    "timetable": "SELECT * FROM fx_timetable",
    "timetable_whole_day": "SELECT trip_id, stop_id, stop_sequence, arr_s, dep_s, shift FROM fx_timetable_day",
    "trip_edges": "SELECT * FROM fx_hops",
    "ride_runs": "SELECT trip_id, direction_id, source_stop_sequence, dep_s, arr_s, run_start FROM fx_runs",
    "ill_timed_hops": """
        SELECT trip_id, source_stop_sequence, dep_s + source_stop_sequence % 3 * 200 AS dep_s, arr_s FROM fx_hops
        WHERE dep_s + source_stop_sequence % 3 * 200 > arr_s""",
    "walking_edges": "SELECT * FROM fx_walks",
    "transfer_override": """
        SELECT source_stop_id, target_stop_id, walk_s, transfer_time,
               greatest(walk_s, transfer_time)::BIGINT AS takes_s FROM fx_walks""",
    "stops_in_region": "SELECT DISTINCT stop_id FROM fx_inside",
    "wkb_shapes": """
        SELECT trim(uuid) AS uuid, level, count(*) AS polygons, 7 * count(*) AS vertices,
               min(x0) AS min_lon, max(y1) AS max_lat FROM fx_shapes GROUP BY ALL""",
    "stop_prefix_semi": """
        SELECT bpuic::VARCHAR AS stop_id, count(*) AS n FROM fx_arrivals
        WHERE bpuic::VARCHAR IN (SELECT left(stop_id, 7) FROM fx_inside) GROUP BY ALL""",
    "history_weather": f"""
        SELECT stop_id, strftime(arr_time, '%Y-%m-%d %H:%M:%S') AS arr_time, delay, type, year::INT AS year,
               month::INT AS month, weekofyear::INT AS weekofyear, dayofmonth::INT AS dayofmonth, hour::INT AS hour,
               round(rain, 6) AS rain, temperature FROM fx_joined""",
    "closest_site": "SELECT site, round(metres, 3) AS distance FROM fx_site",
    "region_centroid": "SELECT round(lon, 6) AS lon, round(lat, 6) AS lat FROM fx_centroid",
    "overlapping_regions": """
        SELECT * FROM (WITH moved AS (SELECT x0 + dx AS x0, xm + dx AS xm, x1 + dx AS x1, y0 + dy AS y0, ym + dy AS ym, y1 + dy AS y1
                       FROM fx_regions, (VALUES (0::DOUBLE, 0::DOUBLE), (0.0023::DOUBLE, 0.0017::DOUBLE)) AS by_(dx, dy)),
             boxes AS (SELECT x0 AS w, x1 AS e, y0 AS s, ym AS n FROM moved UNION SELECT x0, xm, ym, y1 FROM moved),
             columns_ AS (SELECT x AS w, lead(x) OVER (ORDER BY x) AS e FROM (SELECT w AS x FROM boxes UNION SELECT e FROM boxes)),
             rows_ AS (SELECT y AS s, lead(y) OVER (ORDER BY y) AS n FROM (SELECT s AS y FROM boxes UNION SELECT n FROM boxes)),
             covered AS (SELECT DISTINCT c.w, c.e, r.s, r.n FROM boxes b JOIN columns_ c ON c.w >= b.w AND c.e <= b.e
                         JOIN rows_ r ON r.s >= b.s AND r.n <= b.n)
        SELECT round(sum((e - w) * (n - s)) * 1e6, 6) AS area, round(sum((e - w) * (n - s) * (e + w) / 2) / sum((e - w) * (n - s)), 6) AS lon,
               round(sum((e - w) * (n - s) * (n + s) / 2) / sum((e - w) * (n - s)), 6) AS lat FROM covered)""",
    "weather_json": """
        SELECT CASE WHEN document % 7 <> 3 THEN site END AS site, document % 7 = 3 AS malformed, count(*) AS documents,
               sum(CASE WHEN document % 7 <> 3 THEN n ELSE 0 END)::BIGINT AS observations
        FROM (SELECT 'Site' || (user_id % 3) AS site, event_id // 64 AS document, count(*) AS n FROM events GROUP BY ALL)
        GROUP BY ALL""",
    "weather_hourly": "SELECT year, month, dayofmonth, hour, round(rain, 6) AS rain, temperature FROM fx_weather",
    "group_counts": f"SELECT {KEYS}, count(*) AS sample_size FROM fx_history GROUP BY ALL HAVING count(*) >= 3",
    "delay_percentiles": """
        SELECT stop_id, sample_size, array_to_string(list_transform(range(101),
                 lambda p: delays[greatest(1, (p * sample_size + 99) // 100)]::VARCHAR), ',') AS percentiles
        FROM (SELECT stop_id, count(*) AS sample_size, list(delay ORDER BY delay) AS delays
              FROM fx_history GROUP BY stop_id)""",
    "delay_sketches": "SELECT stop_id, count(*) AS sample_size, true AS within FROM fx_history GROUP BY stop_id",
    "delay_distributions": f"SELECT {KEYS}, level, sample_size, array_to_string({JOINED}, ',') AS percentiles FROM fx_dist",
    "delay_distributions_min5": f"SELECT {KEYS}, level, sample_size, array_to_string({JOINED}, ',') AS percentiles FROM fx_dist5",
    "impute_rain": """
        SELECT stop_id, strftime(arr_time, '%Y-%m-%d %H:%M:%S') AS arr_time, delay, type, round(rain, 6) AS rain FROM fx_filled""",
    "impute_temperature": """
        SELECT stop_id, strftime(arr_time, '%Y-%m-%d %H:%M:%S') AS arr_time, delay, type,
               round(temperature, 6) AS temperature FROM fx_filled""",
    "compress_legs": "SELECT journey_id, leg, trip_id, from_stop_id, to_stop_id, dep_s, arr_s FROM fx_compressed",
    "transfer_count": """
        SELECT journey_id, coalesce(sum((trip_id <> before)::INT), 0)::BIGINT AS transfers
        FROM (SELECT *, lag(trip_id) OVER (PARTITION BY journey_id ORDER BY leg) AS before FROM fx_legs)
        GROUP BY journey_id""",
    "leg_slack": "SELECT journey_id, ride, trip_id, to_stop_id, hour, slack_s FROM fx_slack",
    "cdf_lookup": "SELECT journey_id, ride, to_stop_id, hour, slack_s, sample_size, round(probability + 1e-9, 6) AS probability FROM fx_chances",
    "journey_confidence": """
        SELECT journey_id, round(product(probability) + 1e-9, 6) AS confidence FROM fx_chances GROUP BY journey_id""",
    "exp_percentiles": f"""
        SELECT event_id, round({probability('v', 'p')}, 6) AS probability
        FROM (SELECT event_id, value / 10 AS v, {exponential('0.2')} AS p FROM events)""",
    "gtfs_times": f"""
        SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, {clock(DEPARTS)} AS departure_time,
               {clock(DEPARTS + ' % 86400')} AS clock, ({DEPARTS} // 86400)::INT AS shift FROM lineitem""",
    "weekday_shift": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CASE s WHEN 0 THEN c.monday WHEN 1 THEN c.sunday WHEN 2 THEN c.saturday END AS monday,
               CASE s WHEN 0 THEN c.friday WHEN 1 THEN c.thursday WHEN 2 THEN c.wednesday END AS friday
        FROM (SELECT *, l_linenumber % 4 + CASE WHEN l_linenumber % 4 = 3 THEN 4 ELSE 0 END AS s FROM lineitem)
        JOIN fx_calendar c ON c.service_id = 'S' || (l_orderkey % 25)""",
    "classify_vehicle": """
        SELECT product_id, CASE WHEN product_id IN ('Bus', 'BUS') THEN 'bus' WHEN product_id = 'Zug' THEN 'train'
               WHEN product_id IN ('Tram', 'Metro') THEN 'metro' END AS type, count(*) AS n FROM fx_arrivals GROUP BY ALL""",
    "discretise_weather": """
        SELECT coalesce(rain > 2.5, false) AS rain,
               CASE WHEN temperature < 6 THEN 'low' WHEN temperature < 14 THEN 'medium' ELSE 'high' END AS temperature,
               count(*) AS n FROM fx_observations GROUP BY ALL""",
    "clip_delay": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CASE WHEN l_partkey % 17 <> 0 THEN greatest(0, least(1800, (l_quantity * 40 - 100)::BIGINT)) END AS delay
        FROM lineitem""",
    "duration_text": """
        SELECT c_custkey, CASE WHEN s >= 3600 THEN (s // 3600) || 'h ' || (s % 3600 // 60) || 'm'
               ELSE (s // 60) || 'm' END AS duration FROM (SELECT c_custkey, c_custkey * 37 % 90000 AS s FROM customer)""",
    "time_arith": f"""
        SELECT o_orderkey, CASE WHEN t + d < 86400 THEN {clock('t + d')} END AS later,
               CASE WHEN t - d >= 0 THEN {clock('t - d')} END AS earlier, (t - d)::BIGINT AS apart
        FROM (SELECT o_orderkey, o_orderkey * 7919 % 86400 AS t, o_custkey * 61 % 86400 AS d FROM orders)""",
    "local_time": """
        SELECT event_id, strftime(timezone('Europe/Zurich', to_timestamp(e)), '%Y-%m-%d %H:%M:%S') AS local,
               dayname(timezone('Europe/Zurich', to_timestamp(e))) AS weekday
        FROM (SELECT event_id, floor(epoch(ts))::BIGINT + event_id % 12 * 2629800 AS e FROM events)""",
    "parse_local": """
        SELECT event_id, strftime(timezone('UTC', timezone('Europe/Zurich', date_trunc('second', ts))), '%Y-%m-%d %H:%M:%S') AS utc
        FROM events""",
    "error_bounds": """
        SELECT c_custkey, n AS transfers, round(pow(p, n), 6) AS expected, round(pow(p - 0.1, n), 6) AS lowest,
               round(pow(p + 0.1, n), 6) AS highest
        FROM (SELECT c_custkey, 0.1::DOUBLE + c_custkey % 80 / 100.0::DOUBLE AS p FROM customer),
             (SELECT unnest(range(1, 6))::INT AS n)""",
    "network": """
        SELECT source_stop_id, target_stop_id, trip_id, trip_description, source_stop_sequence, kind, transfer_time,
               dep_s, arr_s, walk_s FROM fx_network
        QUALIFY row_number() OVER (PARTITION BY source_stop_id, target_stop_id, trip_id
                                   ORDER BY dep_s DESC, walk_s, trip_description DESC, source_stop_sequence DESC) = 1""",
    "remaining_edges": """
        SELECT source_stop_id, target_stop_id, trip_id FROM fx_network
        WHERE (source_stop_id, target_stop_id, trip_id) NOT IN (
            SELECT source_stop_id, target_stop_id, trip_id FROM fx_network WHERE arr_s % 2 = 0)""",
    "stop_listing": """
        SELECT DISTINCT stop_name, stop_id FROM (
            SELECT source_stop_name AS stop_name, source_stop_id AS stop_id FROM fx_hops UNION ALL
            SELECT target_stop_name, target_stop_id FROM fx_hops UNION ALL
            SELECT source_stop_name, source_stop_id FROM fx_walks)""",
    "node_conflicts": """
        SELECT stop_id, count(DISTINCT stop_name) AS versions FROM (
            SELECT 8500000 + s_suppkey AS stop_id, s_name AS stop_name FROM supplier UNION ALL
            SELECT 8500000 + c_custkey, c_name FROM customer) GROUP BY stop_id HAVING count(DISTINCT stop_name) > 1""",
    "best_journey": """
        SELECT q.query_id, q.from_stop_id, q.to_stop_id, q.arrival_s::INT AS arrival_s,
               min(q.arrival_s - l.dep_s)::INT AS cost
        FROM fx_queries q JOIN fx_labels l
          ON l.to_stop_id = q.to_stop_id AND l.arrival_s = q.arrival_s AND l.stop_id = q.from_stop_id
        WHERE l.stop_id <> l.to_stop_id GROUP BY ALL""",
    "ks_by_group": """
        SELECT stop_id, type, nt::BIGINT AS n_train, nv::BIGINT AS n_validation, round(statistic, 6) AS statistic,
               round(p_value, 6) AS p_value FROM fx_ks""",
    "ks_by_weather_group": """
        SELECT stop_id, hour, rain, temperature, nt::BIGINT AS n_train, nv::BIGINT AS n_validation,
               round(statistic, 6) AS statistic, round(p_value, 6) AS p_value FROM fx_ks4""",
    "drift_summary": """
        SELECT count(*) AS tests, round(avg((p_value < 0.05)::INT), 6) AS share_rejected,
               round(avg(statistic), 6) AS mean_statistic FROM fx_ks""",
    "drift_histogram": """
        SELECT least(9, floor(p_value * 10)::INT) AS bin, count(*) AS n FROM fx_ks GROUP BY ALL""",
    "cdf_calibration": f"""
        SELECT {KEYS}, percentile::INT AS percentile, train_probability,
               round(validation_probability, 6) AS validation_probability FROM fx_calibration""",
    "probability_histogram": """
        SELECT split, least(19, floor(p * 20)::INT) AS bin, count(*) AS n FROM (
            SELECT 'train' AS split, train_probability AS p FROM fx_calibration UNION ALL
            SELECT 'val', validation_probability FROM fx_calibration) GROUP BY ALL""",
}


def check_sql() -> dict[str, str]:
    return {name: _with(select) for name, select in SELECTS.items()}
