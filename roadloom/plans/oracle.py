"""SQL of the registered queries for a single-node engine, from shared named parts.

``PARTS`` holds common table expressions in the order of their use; ``sql`` puts before a final
select those that it needs.
"""

from __future__ import annotations

import re


def r(x: str, places: int) -> str:
    """Half up, as in ``functions.columns.rounded``."""
    return f"round({x} + 1e-9, {places})"


HOT = "coalesce(speed IS NOT NULL AND reference_speed > 0 AND speed < CAST(0.7 AS DOUBLE) * reference_speed, false)"
SEEN = "coalesce(speed IS NOT NULL AND reference_speed > 0, false)"
RATIO = "speed / nullif(reference_speed, 0)"
DAY = "CAST(measurement_tstamp AS DATE)"


def title(x: str) -> str:
    return f"upper(left({x}, 1)) || lower(substr({x}, 2))"


def clock(x: str) -> str:
    return f"lpad(CAST(CASE WHEN {x} % 12 = 0 THEN 12 ELSE {x} % 12 END AS VARCHAR), 2, '0') || ':00 ' || CASE WHEN {x} < 12 THEN 'AM' ELSE 'PM' END"


def weekday(x: str) -> str:
    return f"(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'])[{x}]"


def _pairs(where: str) -> str:
    return f"""SELECT road, direction, road || ' ' || {title("direction")} AS corridor_name, CAST(count(*) AS INTEGER) AS segment_count, max(aadt) AS peak_aadt
        FROM tmc WHERE {where} AND trim(direction) <> '' GROUP BY road, direction HAVING count(*) >= 3"""


STEPS = "(VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) AS steps(a, b)"
AROUND = "(VALUES (-1, -1), (-1, 0), (-1, 1), (0, -1), (0, 1), (1, -1), (1, 0), (1, 1)) AS around(a, b)"
SHARES = f"count(*) AS analyzed_days, count(*) FILTER (occurrence) AS occurrence_days, {r('100.0 * count(*) FILTER (occurrence) / count(*)', 1)} AS occurrence_pct"


def _component(cells: str) -> str:
    """Pairs of cells that a walk over 8 neighbours joins."""
    return f"""SELECT corridor_id, analysis_date, slot, segment_order, slot * 10000 + segment_order AS o FROM {cells}
        UNION SELECT k.corridor_id, k.analysis_date, k.slot, k.segment_order, x.o FROM (SELECT * FROM {{name}} CROSS JOIN {AROUND}) AS x
        JOIN {cells} AS k ON k.corridor_id = x.corridor_id AND k.analysis_date = x.analysis_date AND k.slot = x.slot + x.a AND k.segment_order = x.segment_order + x.b"""


def _picks(hot: str, key: str) -> str:
    return f"""SELECT h.{key}, h.peak_hour, d.peak_dow FROM
        (SELECT {key}, arg_min(hour, -n * 100 + hour) AS peak_hour FROM (SELECT {key}, hour, count(*) AS n FROM {hot} GROUP BY ALL) GROUP BY {key}) AS h JOIN
        (SELECT {key}, arg_min(dow, -n * 100 + dow) AS peak_dow FROM (SELECT {key}, dow, count(*) AS n FROM {hot} GROUP BY ALL) GROUP BY {key}) AS d ON d.{key} = h.{key}"""


HOUR_DOW = "CAST(hour(measurement_tstamp) AS INTEGER) AS hour, CAST(isodow(measurement_tstamp) AS INTEGER) AS dow"

FEATURES = ("speed_drop_ratio", "occurrence_pct", "aadt", "annual_queue_mile_hours")


def _tiers(name: str, source: str) -> dict[str, str]:
    """Parts that end in ``name``: the rows of ``source`` with class_score, class_rank and tier."""
    z = [f"z{i}" for i in range(1, 5)]
    zs = ", ".join(z)
    scaled = [f"coalesce({'-' if i == 0 else ''}round(({f} - avg({f}) OVER ()) / (CASE WHEN round(stddev_pop({f}) OVER (), 9) = 0 THEN 1.0 ELSE round(stddev_pop({f}) OVER (), 9) END), 9), 0.0) AS z{i + 1}" for i, f in enumerate(FEATURES)]

    def apart(other: str) -> str:
        return " + ".join(f"(p.{x} - {other}.{x}) * (p.{x} - {other}.{x})" for x in z)

    part = ", ".join(f"(row_number() OVER (ORDER BY {o}, {zs}) - 1) * k // n AS part{i}" for i, o in enumerate(["class_score", *z]))
    quantiles = " UNION ALL ".join(f"SELECT {i + 2} AS run, CAST(part{i} AS INTEGER) AS c, {', '.join(f'round(avg({x}), 9) AS {x}' for x in z)} FROM {name}_parts GROUP BY part{i}" for i in range(5))
    far = f"""SELECT f.run, f.c + 1 AS c, p.{', p.'.join(z)}, f.seen || [{{{', '.join(f"'{x}': p.{x}" for x in z)}}}] AS seen FROM {name}_far AS f JOIN {name}_points AS p ON f.c + 1 < p.k
        QUALIFY row_number() OVER (PARTITION BY f.run ORDER BY list_min(list_transform(f.seen, lambda s: {apart('s')})) DESC, p.{', p.'.join(z)}) = 1"""
    return {
        f"{name}_scored": f"SELECT *, round(({' + '.join(z)}) / 4, 9) AS class_score FROM (SELECT *, row_number() OVER () AS rid, {', '.join(scaled)} FROM {source})",
        f"{name}_points": f"SELECT rid, class_score, {zs}, count(*) OVER () AS n, least(5, (SELECT count(*) FROM (SELECT DISTINCT {zs} FROM {name}_scored))) AS k FROM {name}_scored",
        f"{name}_parts": f"SELECT {zs}, {part} FROM {name}_points",
        f"{name}_far": f"""SELECT run, 0 AS c, {zs}, [{{{', '.join(f"'{x}': {x}" for x in z)}}}] AS seen FROM (SELECT *, 0 AS run FROM (SELECT * FROM {name}_points ORDER BY class_score, {zs} LIMIT 1) UNION ALL SELECT *, 1 FROM (SELECT * FROM {name}_points ORDER BY {' + '.join(f'{x} * {x}' for x in z)}, {zs} LIMIT 1))
            UNION ALL {far}""",
        f"{name}_seeds": f"SELECT run, c, {zs} FROM {name}_far UNION ALL {quantiles}",
        f"{name}_steps": f"""SELECT 0 AS step, run, c, {zs}, true AS moved FROM {name}_seeds
            UNION ALL SELECT step + 1, run, c, {zs}, bool_or(changed) OVER (PARTITION BY run) AS moved FROM
            (SELECT step, run, c, {', '.join(f'coalesce(round(avg({x}) FILTER (own), 9), any_value(c{x})) AS {x}' for x in z)}, {' OR '.join(f'coalesce(round(avg({x}) FILTER (own), 9), any_value(c{x})) <> any_value(c{x})' for x in z)} AS changed FROM
                (SELECT s.step, s.run, s.c, {', '.join(f'p.{x}, s.{x} AS c{x}' for x in z)}, row_number() OVER (PARTITION BY s.run, p.rid ORDER BY {apart('s')}, s.c) = 1 AS own FROM {name}_steps AS s CROSS JOIN {name}_points AS p WHERE s.moved AND s.step < 100) GROUP BY step, run, c)""",
        f"{name}_near": f"""SELECT run, rid, c, d FROM (SELECT s.run, p.rid, s.c, {apart('s')} AS d, row_number() OVER (PARTITION BY s.run, p.rid ORDER BY {apart('s')}, s.c) AS place
            FROM (SELECT * FROM {name}_steps QUALIFY step = max(step) OVER (PARTITION BY run)) AS s CROSS JOIN {name}_points AS p) WHERE place = 1""",
        f"{name}_best": f"SELECT run FROM {name}_near GROUP BY run ORDER BY round(sum(d), 6), run LIMIT 1",
        f"{name}_ranks": f"SELECT c, CAST(row_number() OVER (ORDER BY round(avg(class_score), 6), min(class_score)) - 1 AS INTEGER) AS class_rank FROM {name}_near JOIN {name}_scored USING (rid) WHERE run = (SELECT run FROM {name}_best) GROUP BY c",
        name: f"""SELECT s.* EXCLUDE (rid, {zs}), r.class_rank, ['Least Severe', 'Low', 'Moderate', 'High', 'Most Severe'][r.class_rank + 1] AS tier FROM {name}_scored AS s JOIN {name}_near AS x ON x.rid = s.rid AND x.run = (SELECT run FROM {name}_best) JOIN {name}_ranks AS r ON r.c = x.c""",
    }


def _classes(name: str, source: str, value: str) -> dict[str, str]:
    """Parts that end in ``name``: units of the value with class_rank, by the best last run of each prefix of the distinct values."""
    return {
        f"{name}_sums": f"SELECT row_number() OVER (ORDER BY u) AS j, u, v0, v9, CAST(sum(n) OVER (ORDER BY u) AS HUGEINT) AS n, sum(n * u) OVER (ORDER BY u) AS s, sum(n * u * u) OVER (ORDER BY u) AS q FROM (SELECT CAST(round({value} * 1000) AS HUGEINT) AS u, count(*) AS n, min({value}) AS v0, max({value}) AS v9 FROM {source} WHERE {value} IS NOT NULL GROUP BY 1)",
        f"{name}_levels": f"""SELECT 1 AS level, j, [CAST(0 AS BIGINT)] AS starts, CAST(n * q - s * s AS DOUBLE) / n AS cost FROM {name}_sums
            UNION ALL SELECT level, j, starts, cost FROM (SELECT a.level + 1 AS level, b.j, list_append(a.starts, a.j) AS starts, a.cost + CAST((b.n - i.n) * (b.q - i.q) - (b.s - i.s) * (b.s - i.s) AS DOUBLE) / (b.n - i.n) AS cost, a.j AS i
                FROM {name}_levels AS a JOIN {name}_sums AS i ON i.j = a.j JOIN {name}_sums AS b ON b.j > a.j WHERE a.level < 5 QUALIFY row_number() OVER (PARTITION BY b.j ORDER BY 4, a.j) = 1)""".replace("ORDER BY 4", "ORDER BY a.cost + CAST((b.n - i.n) * (b.q - i.q) - (b.s - i.s) * (b.s - i.s) AS DOUBLE) / (b.n - i.n)"),
        name: f"""SELECT u, class_rank, format('{{:,.0f}}', round_even(min(v0) OVER w, 0)) || '–' || format('{{:,.0f}}', round_even(max(v9) OVER w, 0)) AS class_label FROM
            (SELECT x.*, CAST(len(list_filter(starts, lambda i: i < x.j)) - 1 AS INTEGER) AS class_rank FROM {name}_sums AS x CROSS JOIN (SELECT starts FROM {name}_levels ORDER BY j DESC, level DESC LIMIT 1)) WINDOW w AS (PARTITION BY class_rank)""",
    }


PARTS: dict[str, str] = {
    "tmc": """SELECT 'T' || lpad(CAST(k AS VARCHAR), 6, '0') AS tmc,
        CASE cls WHEN 0 THEN 'I-' || (20 + rd) WHEN 1 THEN 'GA-' || (400 + rd) WHEN 2 THEN 'US-' || (20 + rd) WHEN 3 THEN 'SR-' || (20 + rd) ELSE 'LOCAL RD ' || rd END AS road,
        CASE WHEN rd % 2 = 0 THEN 'NORTHBOUND' ELSE 'SOUTHBOUND' END AS direction, 'X' || (pos // 2) AS intersection, n_name AS county,
        CAST(33.5 AS DOUBLE) + CAST(0.01 AS DOUBLE) * pos AS start_latitude, CAST(-84.5 AS DOUBLE) + CAST(0.02 AS DOUBLE) * rd AS start_longitude,
        CAST(33.5 AS DOUBLE) + CAST(0.01 AS DOUBLE) * pos + CAST(0.01 AS DOUBLE) AS end_latitude, CAST(-84.5 AS DOUBLE) + CAST(0.02 AS DOUBLE) * rd AS end_longitude,
        CAST(0.2 AS DOUBLE) + CAST(0.05 AS DOUBLE) * ((k * 7) % 10) AS miles, CAST(pos + 1 AS DOUBLE) AS road_order, CAST(k // 4 AS VARCHAR) AS tmclinear,
        CAST(CASE cls WHEN 0 THEN 1 WHEN 1 THEN (CASE WHEN pos < 12 THEN 2 ELSE 3 END) WHEN 2 THEN 3 WHEN 3 THEN 4 ELSE (CASE WHEN k % 2 = 0 THEN 5 ELSE 7 END) END AS INTEGER) AS f_system,
        CASE WHEN cls = 3 AND pos >= 18 THEN NULL ELSE 1 END AS urban_code, CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(floor(CAST(s_acctbal AS DOUBLE) * 20) AS INTEGER) END AS aadt
        FROM (SELECT *, CAST(s_suppkey AS BIGINT) AS k, CAST(s_suppkey AS BIGINT) // 20 AS rd, CAST(s_suppkey AS BIGINT) % 20 AS pos, (CAST(s_suppkey AS BIGINT) // 20) % 5 AS cls FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey)""",
    "probe": """SELECT 'T' || lpad(CAST(s AS VARCHAR), 6, '0') AS tmc_code, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(7 * (k // 5) + k % 5 AS INTEGER)) + to_minutes(CAST(5 * slot AS BIGINT)) AS measurement_tstamp,
        CASE WHEN p % 97 = 0 THEN NULL ELSE q + 4 * least(abs(pos - 6), abs(pos - 14)) + (CASE WHEN night THEN 30 ELSE 0 END) END AS speed, CASE WHEN p % 89 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(60 AS DOUBLE) END AS reference_speed,
        (CASE WHEN p % 89 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(60 AS DOUBLE) END) * CAST(0.9 AS DOUBLE) AS historical_average_speed, CAST(NULL AS DOUBLE) AS travel_time_minutes, l_returnflag AS data_density
        FROM (SELECT *, CASE WHEN night THEN (p // 4 + l) % 12 ELSE 192 + (p + l * 5) % 24 END AS slot FROM
            (SELECT l_suppkey::BIGINT AS s, l_orderkey::BIGINT % 40 AS k, l_partkey::BIGINT AS p, l_linenumber::BIGINT AS l, l_quantity::DOUBLE AS q, l_returnflag, l_suppkey::BIGINT % 20 AS pos, l_partkey::BIGINT % 4 = 0 AS night FROM lineitem))""",
    "cand_i": _pairs("regexp_matches(road, '^I-[0-9]+(/I-[0-9]+)?$')"),
    "cand_a": _pairs("f_system IN (3, 4)") + " ORDER BY peak_aadt DESC NULLS LAST, road, direction LIMIT 25",
    "cand_e": _pairs("f_system = 2"),
    "registry": """SELECT CAST(row_number() OVER (ORDER BY priority, road, direction) AS INTEGER) AS corridor_id, road, direction, corridor_name, corridor_group, true AS is_active,
        NOT (corridor_group = 'Arterial' AND EXISTS (SELECT 1 FROM tmc AS t WHERE t.road = d.road AND t.direction = d.direction AND t.urban_code IS NULL)) AS ranking_eligible,
        road AS source_road, CAST(NULL AS DOUBLE) AS segment_order_start, CAST(NULL AS DOUBLE) AS segment_order_end
        FROM (SELECT *, row_number() OVER (PARTITION BY road, direction ORDER BY priority DESC) AS pick FROM
            (SELECT *, 'Interstate' AS corridor_group, 0 AS priority FROM cand_i UNION ALL SELECT *, 'Arterial', 1 FROM cand_a UNION ALL SELECT *, 'Expressway', 2 FROM cand_e)) AS d WHERE pick = 1""",
    "segs": """SELECT corridor_id, corridor_name, CAST(row_number() OVER (PARTITION BY corridor_id ORDER BY road_order, tmc) AS INTEGER) AS segment_order, tmc, m.road, m.direction, intersection, miles, road_order,
        start_latitude, start_longitude, end_latitude, end_longitude FROM registry AS d JOIN tmc AS m ON m.road = d.source_road AND m.direction = d.direction WHERE d.is_active""",
    "split_runs": """SELECT corridor_id, road, direction, run, bucket, arg_min(road_order, n) AS start_order, arg_max(road_order, n) AS end_order, CAST(count(*) AS INTEGER) AS segment_count, arg_min(intersection, n) AS from_intersection, arg_max(intersection, n) AS to_intersection
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY corridor_id ORDER BY n) AS run FROM
            (SELECT *, CASE WHEN n > 1 AND lag(bucket) OVER (PARTITION BY corridor_id ORDER BY n) IS NOT DISTINCT FROM bucket THEN 0 ELSE 1 END AS fresh FROM
                (SELECT d.corridor_id, m.*, CASE WHEN f_system IN (1, 2) THEN 'Expressway' WHEN f_system IN (3, 4) THEN 'Arterial' END AS bucket, row_number() OVER (PARTITION BY d.corridor_id ORDER BY road_order, tmc) AS n
                FROM registry AS d JOIN tmc AS m ON m.road = d.road AND m.direction = d.direction WHERE d.corridor_group = 'Expressway' AND d.is_active)))
        GROUP BY corridor_id, road, direction, run, bucket HAVING bucket IS NOT NULL AND count(*) >= 3""",
    "split_plan": """SELECT corridor_id, road, direction, CAST(row_number() OVER (PARTITION BY corridor_id ORDER BY run) AS INTEGER) AS run_number, bucket, start_order, end_order, segment_count, from_intersection, to_intersection
        FROM split_runs QUALIFY count(*) OVER (PARTITION BY corridor_id) > 1""",
    "split_registry": f"""SELECT corridor_id, road, direction, corridor_name, corridor_group, is_active AND corridor_id NOT IN (SELECT corridor_id FROM split_plan) AS is_active, ranking_eligible, source_road, segment_order_start, segment_order_end FROM registry
        UNION ALL SELECT CAST((SELECT max(corridor_id) FROM registry) + row_number() OVER (ORDER BY road, direction, run_number) AS INTEGER), road || '-' || run_number, direction,
        road || ' ' || {title("direction")} || ' (' || from_intersection || ' to ' || to_intersection || ')', bucket, true, true, road, start_order, end_order FROM split_plan""",
    "watch": """SELECT tmc, road, direction, intersection, county, f_system, road_class, aadt, miles, CAST(rank_in_class AS INTEGER) AS rank_in_class FROM
        (SELECT *, row_number() OVER (PARTITION BY road_class ORDER BY aadt DESC, tmc) AS rank_in_class FROM
            (SELECT *, CASE WHEN f_system IN (5, 6) THEN 'Collector' WHEN f_system = 7 THEN 'Local' END AS road_class FROM tmc WHERE aadt IS NOT NULL) WHERE road_class IS NOT NULL)
        WHERE rank_in_class <= CASE WHEN road_class = 'Collector' THEN 25 ELSE 10 END""",
    "joined": f"""SELECT corridor_id, {DAY} AS analysis_date, segment_order, tmc, intersection, miles, measurement_tstamp, speed, reference_speed FROM probe JOIN segs ON tmc = tmc_code""",
    "daily": f"""SELECT corridor_id, analysis_date, segment_order, tmc, intersection, miles, count(*) FILTER ({SEEN}) AS observed_intervals, count(*) FILTER ({HOT}) AS congested_intervals, count(*) FILTER ({HOT}) * 5 AS congested_minutes,
        {r(f"avg({RATIO}) FILTER ({SEEN})", 9)} AS average_speed_ratio, {r(f"avg({RATIO}) FILTER ({HOT})", 9)} AS congested_average_speed_ratio FROM joined GROUP BY ALL""",
    "profile": f"""SELECT corridor_id, segment_order, max(tmc) AS tmc, max(intersection) AS intersection, max(miles) AS miles, count(*) AS analyzed_days, count(*) FILTER (congested_minutes >= 30) AS occurrence_days,
        {r("100.0 * count(*) FILTER (congested_minutes >= 30) / count(*)", 2)} AS weekday_occurrence_pct, {r("avg(congested_minutes) FILTER (congested_minutes >= 30)", 1)} AS avg_congested_minutes_occurrence_day,
        {r("quantile_cont(congested_minutes, 0.5) FILTER (congested_minutes >= 30)", 1)} AS median_congested_minutes, {r("quantile_cont(congested_minutes, 0.95) FILTER (congested_minutes >= 30)", 1)} AS p95_congested_minutes,
        {r("sum(congested_intervals) * max(miles) * 5 / 60.0", 3)} AS annual_segment_mile_hours, {r("avg(congested_average_speed_ratio) FILTER (congested_intervals > 0)", 3)} AS average_congested_speed_ratio
        FROM daily GROUP BY corridor_id, segment_order""",
    "smooth": """SELECT *, (coalesce(lag(occurrence) OVER w, 0.0) + occurrence + coalesce(lead(occurrence) OVER w, 0.0)) / 3.0 AS smoothed FROM
        (SELECT *, coalesce(weekday_occurrence_pct, 0.0) AS occurrence, coalesce(miles, 0.0) AS length, CAST(row_number() OVER (PARTITION BY corridor_id ORDER BY segment_order) - 1 AS INTEGER) AS position FROM profile WHERE analyzed_days >= 30)
        WINDOW w AS (PARTITION BY corridor_id ORDER BY segment_order)""",
    "levels": """SELECT corridor_id, run, min(position) AS l, max(position) AS r, any_value(smoothed) AS v FROM
        (SELECT *, sum(fresh) OVER (PARTITION BY corridor_id ORDER BY position) AS run FROM
            (SELECT *, CASE WHEN smoothed = lag(smoothed) OVER (PARTITION BY corridor_id ORDER BY position) THEN 0 ELSE 1 END AS fresh FROM smooth)) GROUP BY corridor_id, run""",
    "maxima": """SELECT corridor_id, CAST((l + r) // 2 AS INTEGER) AS p, v FROM (SELECT *, lag(v) OVER w AS a, lead(v) OVER w AS b FROM levels WINDOW w AS (PARTITION BY corridor_id ORDER BY run)) WHERE a < v AND b < v""",
    "prio": "SELECT corridor_id, p, row_number() OVER (PARTITION BY corridor_id ORDER BY v DESC, p DESC) AS k FROM maxima WHERE v >= 20",
    "spaced": """SELECT corridor_id, k, [p] AS ps FROM prio WHERE k = 1
        UNION ALL SELECT t.corridor_id, n.k, CASE WHEN len(list_filter(t.ps, lambda q: abs(q - n.p) < 3)) = 0 THEN list_append(t.ps, n.p) ELSE t.ps END FROM spaced AS t JOIN prio AS n ON n.corridor_id = t.corridor_id AND n.k = t.k + 1""",
    "apart": "SELECT corridor_id, unnest(ps) AS p FROM (SELECT corridor_id, arg_max(ps, k) AS ps FROM spaced GROUP BY corridor_id)",
    "bounds": """SELECT a.corridor_id, a.p, any_value(h.smoothed) AS v, coalesce(max(s.position) FILTER (s.position < a.p AND s.smoothed > h.smoothed), -1) AS lo, coalesce(min(s.position) FILTER (s.position > a.p AND s.smoothed > h.smoothed), 1000000) AS hi
        FROM apart AS a JOIN smooth AS h ON h.corridor_id = a.corridor_id AND h.position = a.p JOIN smooth AS s ON s.corridor_id = a.corridor_id GROUP BY a.corridor_id, a.p""",
    "peaks": """SELECT b.corridor_id, b.p, any_value(b.v) AS v FROM bounds AS b JOIN smooth AS s ON s.corridor_id = b.corridor_id GROUP BY b.corridor_id, b.p
        HAVING any_value(b.v) - greatest(min(s.smoothed) FILTER (s.position > b.lo AND s.position <= b.p), min(s.smoothed) FILTER (s.position >= b.p AND s.position < b.hi)) >= 10""",
    "lefts": """SELECT k.corridor_id, k.p, q.position AS q, list_reduce(list(s.length ORDER BY s.position DESC), lambda a, b: a + b) AS spent, bool_and(s.position = k.p OR s.smoothed >= k.v * 0.5) AS ok
        FROM peaks AS k JOIN smooth AS q ON q.corridor_id = k.corridor_id AND q.position <= k.p JOIN smooth AS s ON s.corridor_id = k.corridor_id AND s.position BETWEEN q.position AND k.p GROUP BY k.corridor_id, k.p, q.position""",
    "starts": "SELECT corridor_id, p, coalesce(min(q) FILTER (ok AND (spent <= 5.0 OR q = p)), p) AS s0, arg_min(spent, q) FILTER (ok AND (spent <= 5.0 OR q = p)) AS spent FROM lefts GROUP BY corridor_id, p",
    "rights": """SELECT k.corridor_id, k.p, q.position AS q, list_reduce(list_concat([any_value(t.spent)], list(s.length ORDER BY s.position)), lambda a, b: a + b) AS spent, bool_and(s.smoothed >= k.v * 0.5) AS ok
        FROM peaks AS k JOIN starts AS t ON t.corridor_id = k.corridor_id AND t.p = k.p JOIN smooth AS q ON q.corridor_id = k.corridor_id AND q.position > k.p JOIN smooth AS s ON s.corridor_id = k.corridor_id AND s.position > k.p AND s.position <= q.position
        GROUP BY k.corridor_id, k.p, q.position""",
    "grown": """SELECT t.corridor_id, t.p, t.s0, coalesce(max(x.q) FILTER (x.ok AND x.spent <= 5.0), t.p) AS e0, row_number() OVER (PARTITION BY t.corridor_id ORDER BY t.s0, t.p) AS i
        FROM starts AS t LEFT JOIN rights AS x ON x.corridor_id = t.corridor_id AND x.p = t.p GROUP BY t.corridor_id, t.p, t.s0""",
    "valleys": """SELECT a.corridor_id, a.i, arg_min(s.position, s.smoothed * 1000000000 + s.position) AS valley, any_value(b.p) AS np, any_value(b.s0) AS ns, any_value(b.e0) AS ne FROM grown AS a JOIN grown AS b ON b.corridor_id = a.corridor_id AND b.i = a.i + 1
        JOIN smooth AS s ON s.corridor_id = a.corridor_id AND s.position BETWEEN least(a.p, b.p) AND greatest(a.p, b.p) GROUP BY a.corridor_id, a.i""",
    "cuts": """SELECT corridor_id, i, p, s0, e0, s0 AS s, e0 AS e FROM grown WHERE i = 1
        UNION ALL SELECT t.corridor_id, t.i + 1, v.np, v.ns, v.ne, CASE WHEN t.e >= v.ns AND t.p <= v.np THEN greatest(v.valley + 1, v.ns) ELSE v.ns END, CASE WHEN t.e >= v.ns AND t.p > v.np THEN least(v.valley, v.ne) ELSE v.ne END
        FROM cuts AS t JOIN valleys AS v ON v.corridor_id = t.corridor_id AND v.i = t.i""",
    "extents": """SELECT t.corridor_id, t.p AS peak_position, CASE WHEN v.i IS NOT NULL AND t.e >= v.ns AND t.p > v.np THEN greatest(v.valley + 1, t.s0) ELSE t.s END AS start_position,
        CASE WHEN v.i IS NOT NULL AND t.e >= v.ns AND t.p <= v.np THEN least(v.valley, t.e0) ELSE t.e END AS end_position FROM cuts AS t LEFT JOIN valleys AS v ON v.corridor_id = t.corridor_id AND v.i = t.i""",
    "numbered": """SELECT CAST(row_number() OVER (ORDER BY d.road, d.direction, start_position, peak_position) AS INTEGER) AS bottleneck_id, x.*, d.road, d.direction, d.corridor_group FROM extents AS x JOIN registry AS d ON d.corridor_id = x.corridor_id""",
    "bottlenecks": f"""SELECT bottleneck_id, n.corridor_id, road AS corridor, direction, corridor_group, max(s.segment_order) FILTER (s.position = peak_position) AS peak_segment_order, min(s.segment_order) AS start_segment_order, max(s.segment_order) AS end_segment_order,
        CAST(count(*) AS INTEGER) AS segment_count, max(s.intersection) FILTER (s.position = peak_position) AS representative_intersection, {r("max(s.smoothed) FILTER (s.position = peak_position)", 3)} AS peak_occurrence_pct, max(s.occurrence) AS maximum_raw_occurrence_pct,
        {r("sum(s.annual_segment_mile_hours)", 3)} AS annual_mile_hours, {r("coalesce(avg(s.average_congested_speed_ratio), 0.0)", 3)} AS average_congested_speed_ratio
        FROM numbered AS n JOIN smooth AS s ON s.corridor_id = n.corridor_id AND s.position BETWEEN start_position AND end_position GROUP BY bottleneck_id, n.corridor_id, road, direction, corridor_group""",
    "members": "SELECT bottleneck_id, s.segment_order FROM numbered AS n JOIN smooth AS s ON s.corridor_id = n.corridor_id AND s.position BETWEEN start_position AND end_position",
    "within_extent": "SELECT bottleneck_id, tmc, s.segment_order, miles, b.corridor_group FROM bottlenecks AS b JOIN segs AS s ON s.corridor_id = b.corridor_id AND s.segment_order BETWEEN start_segment_order AND end_segment_order",
    "queues": f"""SELECT bottleneck_id, measurement_tstamp, CAST(count(*) FILTER ({HOT}) AS INTEGER) AS congested_segments, {r(f"coalesce(sum(miles) FILTER ({HOT}), 0.0)", 6)} AS queue_miles,
        {r(f"avg({RATIO}) FILTER ({HOT})", 9)} AS average_congested_speed_ratio, {r(f"min({RATIO}) FILTER ({SEEN})", 9)} AS minimum_speed_ratio FROM probe JOIN within_extent ON tmc = tmc_code GROUP BY bottleneck_id, measurement_tstamp""",
    "active": f"""SELECT *, {DAY} AS analysis_date, queue_miles > 0 AS hot, date_diff('second', CAST({DAY} AS TIMESTAMP), measurement_tstamp) / 3600.0 AS hours,
        first_value(CASE WHEN queue_miles > 0 THEN measurement_tstamp END) OVER (PARTITION BY bottleneck_id, {DAY} ORDER BY queue_miles DESC, measurement_tstamp) AS peak FROM queues""",
    "day_raw": """SELECT bottleneck_id, analysis_date, count(*) FILTER (hot) * 5 AS minutes, min(measurement_tstamp) FILTER (hot) AS onset, min(peak) AS peak, max(measurement_tstamp) FILTER (hot) AS last, max(queue_miles) FILTER (hot) AS longest, avg(queue_miles) FILTER (hot) AS mean,
        sum(queue_miles) FILTER (hot) AS total, max(congested_segments) FILTER (hot) AS segments, avg(average_congested_speed_ratio) FILTER (hot) AS ratio, min(minimum_speed_ratio) FILTER (hot) AS lowest,
        CASE WHEN count(*) FILTER (hot AND measurement_tstamp <= peak) >= 3 THEN regr_slope(queue_miles, hours) FILTER (hot AND measurement_tstamp <= peak) END AS growth,
        CASE WHEN count(*) FILTER (hot AND measurement_tstamp >= peak) >= 3 THEN regr_slope(queue_miles, hours) FILTER (hot AND measurement_tstamp >= peak) END AS decay, count(*) FILTER (hot) * 5 >= 30 AS occurrence
        FROM active GROUP BY bottleneck_id, analysis_date""",
    "metrics": f"""SELECT bottleneck_id, analysis_date, occurrence, CASE WHEN occurrence THEN onset END AS onset_time, CASE WHEN occurrence THEN peak END AS peak_time, CASE WHEN occurrence THEN last + INTERVAL 5 MINUTE END AS clearance_time, minutes AS active_congestion_minutes,
        CASE WHEN occurrence THEN date_diff('minute', onset, last + INTERVAL 5 MINUTE) ELSE 0 END AS episode_duration_minutes, CASE WHEN occurrence THEN {r("longest", 3)} ELSE 0.0 END AS maximum_queue_miles, CASE WHEN occurrence THEN {r("mean", 3)} ELSE 0.0 END AS average_queue_miles,
        CASE WHEN occurrence THEN {r("total * 5 / 60.0", 3)} ELSE 0.0 END AS queue_mile_hours, CASE WHEN occurrence THEN segments ELSE 0 END AS maximum_congested_segments, CASE WHEN occurrence THEN {r("ratio", 3)} END AS average_congested_speed_ratio,
        CASE WHEN occurrence THEN {r("lowest", 3)} END AS minimum_speed_ratio, CASE WHEN occurrence THEN {r("growth", 3)} END AS queue_growth_rate_mph, CASE WHEN occurrence THEN {r("decay", 3)} END AS queue_dissipation_rate_mph FROM day_raw""",
    "annual": f"""SELECT b.bottleneck_id, b.corridor_id, b.corridor, b.direction, peak_segment_order, start_segment_order, end_segment_order, representative_intersection, {SHARES}, {r("avg(active_congestion_minutes) FILTER (occurrence)", 1)} AS avg_active_minutes,
        {r("quantile_cont(active_congestion_minutes, 0.5) FILTER (occurrence)", 1)} AS median_active_minutes, {r("quantile_cont(active_congestion_minutes, 0.95) FILTER (occurrence)", 1)} AS p95_active_minutes, {r("avg(maximum_queue_miles) FILTER (occurrence)", 2)} AS avg_max_queue_miles,
        {r("quantile_cont(maximum_queue_miles, 0.95) FILTER (occurrence)", 2)} AS p95_max_queue_miles, {r("max(maximum_queue_miles)", 2)} AS annual_max_queue_miles, {r("sum(queue_mile_hours)", 2)} AS annual_queue_mile_hours,
        {r("avg(m.average_congested_speed_ratio) FILTER (occurrence)", 3)} AS avg_congested_speed_ratio, {r("avg(queue_growth_rate_mph) FILTER (occurrence)", 2)} AS avg_queue_growth_rate_mph, {r("avg(queue_dissipation_rate_mph) FILTER (occurrence)", 2)} AS avg_queue_dissipation_rate_mph
        FROM metrics AS m JOIN bottlenecks AS b ON b.bottleneck_id = m.bottleneck_id GROUP BY b.bottleneck_id, b.corridor_id, b.corridor, b.direction, peak_segment_order, start_segment_order, end_segment_order, representative_intersection""",
    "overnight": f"""SELECT bottleneck_id, {r("p", 3)} AS overnight_congested_pct, p < 15.0 AS ranking_eligible FROM (SELECT bottleneck_id, 100.0 * avg(CASE WHEN speed < CAST(0.7 AS DOUBLE) * reference_speed THEN 1.0 ELSE 0.0 END) AS p
        FROM probe JOIN within_extent ON tmc = tmc_code WHERE corridor_group = 'Arterial' AND hour(measurement_tstamp) IN (0, 1, 2, 3, 4) AND reference_speed > 0 GROUP BY bottleneck_id)""",
    "scored": """SELECT a.*, d.corridor_name, d.corridor_group, s.tmc AS peak_tmc, d.ranking_eligible AS corridor_ranking_eligible, coalesce(o.ranking_eligible, true) AS bottleneck_ranking_eligible, d.ranking_eligible AND coalesce(o.ranking_eligible, true) AS ranking_eligible, o.overnight_congested_pct,
        t.aadt AS peak_segment_aadt, round(annual_queue_mile_hours * occurrence_pct / 100.0 * (1.0 - avg_congested_speed_ratio), 9) AS plain FROM annual AS a JOIN registry AS d ON d.corridor_id = a.corridor_id AND d.is_active
        LEFT JOIN overnight AS o ON o.bottleneck_id = a.bottleneck_id LEFT JOIN segs AS s ON s.corridor_id = a.corridor_id AND s.segment_order = a.peak_segment_order LEFT JOIN tmc AS t ON t.tmc = s.tmc""",
    "weighted": "SELECT *, round(plain * coalesce(peak_segment_aadt, 100000.0) / 100000.0, 9) AS weighted FROM scored",
    "ranked": f"""SELECT * EXCLUDE (plain, weighted), {r("plain", 2)} AS severity_index, {r("weighted", 2)} AS aadt_weighted_severity_index, CAST(rank() OVER (PARTITION BY corridor, direction ORDER BY plain DESC NULLS FIRST) AS INTEGER) AS corridor_severity_rank,
        CASE WHEN ranking_eligible THEN CAST(rank() OVER (PARTITION BY ranking_eligible ORDER BY weighted DESC NULLS FIRST) AS INTEGER) END AS network_severity_rank FROM weighted""",
    "polygons": """SELECT name, CAST(file_order AS INTEGER) AS file_order, CAST(ring AS INTEGER) AS ring, CAST(i AS INTEGER) AS i, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM
        (SELECT 'District ' || road AS name, file_order, ring, i, CASE WHEN i IN (1, 2) THEN lon + w ELSE lon - w END AS x, CASE WHEN i IN (2, 3) THEN lat + h ELSE lat + g END AS y
        FROM (SELECT road, min(start_longitude) AS lon, min(start_latitude) AS lat, round((min(start_longitude) + 84.5) / 0.02) AS file_order FROM tmc GROUP BY road)
        CROSS JOIN (VALUES (0, CAST(0.015 AS DOUBLE), CAST(-0.005 AS DOUBLE), CAST(0.1 AS DOUBLE)), (1, CAST(0.002 AS DOUBLE), CAST(0.02 AS DOUBLE), CAST(0.04 AS DOUBLE))) AS shapes(ring, w, g, h) CROSS JOIN range(5) AS v(i) WHERE ring = 0 OR file_order % 2 = 0
        UNION ALL SELECT 'Region', 1000000, 0, i, CASE WHEN i IN (1, 2) THEN b + CAST(0.1 AS DOUBLE) ELSE a - CAST(0.1 AS DOUBLE) END, CASE WHEN i IN (2, 3) THEN c + CAST(0.155 AS DOUBLE) ELSE c - CAST(0.1 AS DOUBLE) END
        FROM (SELECT min(start_longitude) AS a, max(start_longitude) AS b, min(start_latitude) AS c FROM tmc) CROSS JOIN range(5) AS v(i))""",
    "points": "SELECT tmc, (start_latitude + end_latitude) / 2.0 AS lat, (start_longitude + end_longitude) / 2.0 AS lon FROM tmc WHERE tmc IN (SELECT tmc FROM segs UNION SELECT tmc FROM watch)",
    "edges": "SELECT * FROM (SELECT file_order, name, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM polygons WINDOW w AS (PARTITION BY file_order, ring ORDER BY i)) WHERE x2 IS NOT NULL",
    "districts": """SELECT p.tmc, f.cid_name FROM points AS p LEFT JOIN (SELECT tmc, arg_min(name, file_order) AS cid_name FROM
        (SELECT tmc, file_order, name FROM points CROSS JOIN edges WHERE (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / nullif(y2 - y1, 0.0) + x1 GROUP BY tmc, file_order, name HAVING count(*) % 2 = 1) GROUP BY tmc) AS f ON f.tmc = p.tmc""",
    "slotted": "SELECT *, hour(measurement_tstamp) * 60 + minute(measurement_tstamp) AS minute_of_day, max(segment_order) OVER (PARTITION BY corridor_id, analysis_date) AS width FROM joined",
    "cells": f"""SELECT corridor_id, analysis_date, CAST(minute_of_day // 5 AS INTEGER) AS slot, segment_order, speed, reference_speed, width, tmc, intersection, coalesce(miles, 0.0) AS miles, {SEEN} AS observed, CASE WHEN {SEEN} THEN {RATIO} END AS ratio
        FROM (SELECT *, row_number() OVER (PARTITION BY corridor_id, analysis_date, minute_of_day, segment_order ORDER BY speed NULLS LAST, reference_speed DESC NULLS LAST) AS pick FROM slotted WHERE minute_of_day % 5 = 0) WHERE pick = 1""",
    "raw": "SELECT corridor_id, analysis_date, slot, segment_order, width FROM cells WHERE observed AND ratio < CAST(0.7 AS DOUBLE)",
    "dilated": f"""SELECT DISTINCT corridor_id, analysis_date, slot + a AS slot, segment_order + b AS segment_order, width FROM raw CROSS JOIN {STEPS} WHERE slot + a BETWEEN 0 AND 287 AND segment_order + b BETWEEN 1 AND width""",
    "closed": f"""SELECT corridor_id, analysis_date, CAST(s AS INTEGER) AS slot, CAST(o AS INTEGER) AS segment_order, max(width) AS width FROM (SELECT corridor_id, analysis_date, slot + a AS s, segment_order + b AS o, width FROM dilated CROSS JOIN {STEPS} WHERE slot + a BETWEEN 0 AND 287 AND segment_order + b BETWEEN 1 AND width)
        GROUP BY corridor_id, analysis_date, s, o HAVING count(*) = 5""",
    "cores": f"""SELECT corridor_id, analysis_date, CAST(s AS INTEGER) AS slot, CAST(o AS INTEGER) AS segment_order FROM (SELECT corridor_id, analysis_date, slot + a AS s, segment_order + b AS o FROM closed CROSS JOIN {STEPS}) GROUP BY corridor_id, analysis_date, s, o HAVING count(*) = 5""",
    "reach": _component("closed").replace("{name}", "reach"),
    "comp": "SELECT corridor_id, analysis_date, slot, segment_order, min(o) AS whole FROM reach GROUP BY ALL",
    "core_reach": _component("cores").replace("{name}", "core_reach"),
    "core_comp": "SELECT corridor_id, analysis_date, slot, segment_order, min(o) AS inside FROM core_reach GROUP BY ALL",
    "kernels": "SELECT c.corridor_id, c.analysis_date, c.slot, c.segment_order, whole, inside FROM comp AS c JOIN core_comp AS k ON k.corridor_id = c.corridor_id AND k.analysis_date = c.analysis_date AND k.slot = c.slot AND k.segment_order = c.segment_order",
    "multi": "SELECT corridor_id, analysis_date, whole FROM kernels GROUP BY ALL HAVING count(DISTINCT inside) > 1",
    "owners": """SELECT c.corridor_id, c.analysis_date, c.slot, c.segment_order, arg_min(k.inside, ((c.slot - k.slot) * (c.slot - k.slot) + (c.segment_order - k.segment_order) * (c.segment_order - k.segment_order))::BIGINT * 100000000 + k.slot * 10000 + k.segment_order) AS owner
        FROM comp AS c JOIN multi AS m ON m.corridor_id = c.corridor_id AND m.analysis_date = c.analysis_date AND m.whole = c.whole JOIN kernels AS k ON k.corridor_id = c.corridor_id AND k.analysis_date = c.analysis_date AND k.whole = c.whole GROUP BY ALL""",
    "labels": """SELECT c.corridor_id, c.analysis_date, c.slot, c.segment_order, CAST(dense_rank() OVER (PARTITION BY c.corridor_id, c.analysis_date ORDER BY whole, coalesce(owner, -1)) AS INTEGER) AS label
        FROM comp AS c LEFT JOIN owners AS o ON o.corridor_id = c.corridor_id AND o.analysis_date = c.analysis_date AND o.slot = c.slot AND o.segment_order = c.segment_order""",
    "posts": """SELECT *, end_mile - miles AS start_mile FROM (SELECT *, sum(miles) OVER (PARTITION BY corridor_id, analysis_date ORDER BY segment_order ROWS UNBOUNDED PRECEDING) AS end_mile FROM
        (SELECT corridor_id, analysis_date, segment_order, max(miles) AS miles, max(tmc) AS tmc, max(intersection) AS intersection FROM cells GROUP BY ALL))""",
    "runs": """SELECT corridor_id, analysis_date, label, slot, run, sum(length) AS length, min(segment_order) AS segment_order, arg_min(start_mile, segment_order) AS start_mile FROM
        (SELECT l.*, coalesce(p.miles, 0.0) AS length, p.start_mile, l.segment_order - row_number() OVER (PARTITION BY l.corridor_id, l.analysis_date, label, slot ORDER BY l.segment_order) AS run
        FROM labels AS l LEFT JOIN posts AS p ON p.corridor_id = l.corridor_id AND p.analysis_date = l.analysis_date AND p.segment_order = l.segment_order) GROUP BY corridor_id, analysis_date, label, slot, run""",
    "slices": "SELECT corridor_id, analysis_date, label, slot, max(length) AS run_miles, sum(length) AS total_miles, min(segment_order) AS first_order, arg_min(start_mile, segment_order) AS upstream_mile FROM runs GROUP BY ALL",
    "bodies": """SELECT l.corridor_id, l.analysis_date, label, count(*) AS cell_count, count(DISTINCT l.slot) AS slots, count(DISTINCT l.segment_order) AS segment_count, min(l.slot) AS first_slot, max(l.slot) AS last_slot, min(l.segment_order) AS first_segment_order, max(l.segment_order) AS last_segment_order,
        avg(speed) AS speed, min(ratio) AS low, avg(ratio) AS ratio, avg(reference_speed - speed) AS slower, max(reference_speed - speed) AS most FROM labels AS l LEFT JOIN cells AS c ON c.corridor_id = l.corridor_id AND c.analysis_date = l.analysis_date AND c.slot = l.slot AND c.segment_order = l.segment_order
        GROUP BY l.corridor_id, l.analysis_date, label""",
    "spans": """SELECT corridor_id, analysis_date, label, max(run_miles) AS run_miles, max(total_miles) AS total_miles, sum(least(total_miles, 5.0)) AS sliced, CASE WHEN count(*) >= 3 AND count(upstream_mile) = count(*) THEN regr_slope(upstream_mile, slot * 5 / 60.0) END AS slope FROM slices GROUP BY ALL""",
    "kept": """SELECT b.*, s.run_miles, s.total_miles, s.sliced, s.slope, CAST(row_number() OVER (PARTITION BY b.corridor_id, b.analysis_date ORDER BY b.label) AS INTEGER) AS event_id FROM bodies AS b JOIN spans AS s ON s.corridor_id = b.corridor_id AND s.analysis_date = b.analysis_date AND s.label = b.label
        WHERE cell_count >= 6 AND slots * 5 >= 10 AND segment_count >= 2 AND least(run_miles, 5.0) >= 0.25""",
    "events": f"""SELECT k.corridor_id, k.analysis_date, event_id, CAST(k.analysis_date AS TIMESTAMP) + to_minutes(first_slot::BIGINT * 5) AS start_time, CAST(k.analysis_date AS TIMESTAMP) + to_minutes(last_slot::BIGINT * 5) AS end_time, slots * 5 AS duration_minutes, cell_count, segment_count,
        first_segment_order, last_segment_order, f.tmc AS first_tmc, t.tmc AS last_tmc, f.intersection AS first_intersection, t.intersection AS last_intersection, {r("least(run_miles, 5.0)", 3)} AS maximum_contiguous_extent_miles, {r("least(total_miles, 5.0)", 3)} AS maximum_total_active_miles,
        {r("sliced * 5 / 60.0", 3)} AS event_area_mile_hours, {r("speed", 2)} AS average_speed_mph, {r("low", 3)} AS minimum_speed_ratio, {r("ratio", 3)} AS average_speed_ratio, {r("slower", 2)} AS average_speed_drop_mph, {r("most", 2)} AS maximum_speed_drop_mph,
        {r("slope", 3)} AS estimated_upstream_boundary_speed_mph, {r("coalesce(f.start_mile, 0.0)", 3)} AS corridor_start_mile, {r("coalesce(t.end_mile, 0.0)", 3)} AS corridor_end_mile
        FROM kept AS k LEFT JOIN posts AS f ON f.corridor_id = k.corridor_id AND f.analysis_date = k.analysis_date AND f.segment_order = first_segment_order LEFT JOIN posts AS t ON t.corridor_id = k.corridor_id AND t.analysis_date = k.analysis_date AND t.segment_order = last_segment_order""",
    "hour_parts": """SELECT *, date_diff('second', greatest(start_time, hour_start), least(end_time, hour_start + INTERVAL 1 HOUR)) / 60.0 AS overlap_minutes FROM (SELECT *, unnest(generate_series(date_trunc('hour', start_time), date_trunc('hour', end_time), INTERVAL 1 HOUR)) AS hour_start FROM events)""",
    "hours": f"""SELECT CAST(hour(hour_start) AS INTEGER) AS hour_of_day, count(DISTINCT event_id) AS event_count, count(DISTINCT (corridor_id, analysis_date, event_id)) AS events, {r("sum(overlap_minutes)", 0)} AS total_duration_minutes,
        {r("sum(event_area_mile_hours * overlap_minutes / nullif(duration_minutes, 0))", 2)} AS total_mile_hours FROM hour_parts WHERE overlap_minutes > 0 GROUP BY ALL""",
    "months": f"SELECT CAST(date_trunc('month', analysis_date) AS DATE) AS month, count(*) AS event_count, {r('sum(duration_minutes)', 0)} AS total_duration_minutes, {r('sum(event_area_mile_hours)', 2)} AS total_mile_hours FROM events GROUP BY ALL",
    "weekdays": f"SELECT CAST(isodow(analysis_date) AS INTEGER) AS weekday_number, strftime(analysis_date, '%a') AS weekday_name, count(*) AS event_count, {r('sum(duration_minutes)', 0)} AS total_duration_minutes, {r('sum(event_area_mile_hours)', 2)} AS total_mile_hours FROM events GROUP BY ALL",
    "counties": f"SELECT coalesce(county, 'UNKNOWN') AS county, count(*) AS event_count, {r('sum(duration_minutes)', 0)} AS total_duration_minutes, {r('sum(event_area_mile_hours)', 2)} AS total_mile_hours FROM events LEFT JOIN tmc ON tmc = first_tmc GROUP BY coalesce(county, 'UNKNOWN')",
    "worst": f"SELECT analysis_date, {r('sum(event_area_mile_hours)', 3)} AS total_mile_hours FROM events GROUP BY analysis_date ORDER BY total_mile_hours DESC, analysis_date LIMIT 1",
    "watch_daily": f"""SELECT tmc, miles, {DAY} AS day, count(*) FILTER ({HOT}) AS n, {r(f"avg({RATIO}) FILTER ({HOT})", 9)} AS ratio FROM probe JOIN watch ON tmc = tmc_code GROUP BY ALL""",
    "watch_hot": f"SELECT tmc, {HOUR_DOW} FROM probe JOIN watch ON tmc = tmc_code WHERE {HOT}",
    "watch_picks": _picks("watch_hot", "tmc"),
    "watch_metrics": f"""SELECT a.*, p.peak_hour, {clock("p.peak_hour")} AS peak_hour_label, {weekday("p.peak_dow")} AS peak_weekday_name FROM (SELECT tmc, count(*) AS analyzed_days, count(*) FILTER (n * 5 >= 30) AS occurrence_days, {r("100.0 * count(*) FILTER (n * 5 >= 30) / count(*)", 2)} AS occurrence_pct,
        {r("avg(n * 5) FILTER (n * 5 >= 30)", 1)} AS avg_congested_minutes_occurrence_day, {r("sum(n) * max(miles) * 5 / 60.0", 3)} AS annual_segment_mile_hours, {r("avg(ratio) FILTER (n > 0)", 3)} AS average_congested_speed_ratio FROM watch_daily GROUP BY tmc) AS a LEFT JOIN watch_picks AS p ON p.tmc = a.tmc""",
    "class_curve": f"""SELECT road_class, CAST(hour(measurement_tstamp) AS INTEGER) AS hour, {r("avg(speed)", 2)} AS avg_speed FROM probe JOIN (SELECT tmc, CASE WHEN f_system = 1 THEN 'Interstate' WHEN f_system = 2 THEN 'Expressway' WHEN f_system IN (3, 4) THEN 'Arterial' WHEN f_system IN (5, 6) THEN 'Collector' WHEN f_system = 7 THEN 'Local' END AS road_class FROM tmc) ON tmc = tmc_code
        WHERE speed > 0 AND road_class IS NOT NULL GROUP BY ALL""",
    "extremes": """SELECT 'free_flow' AS kind, hour FROM class_curve WHERE road_class = 'Arterial' AND avg_speed = (SELECT max(avg_speed) FROM class_curve WHERE road_class = 'Arterial')
        UNION ALL SELECT 'peak', hour FROM class_curve WHERE road_class = 'Arterial' AND avg_speed = (SELECT min(avg_speed) FROM class_curve WHERE road_class = 'Arterial')""",
    "filled": """SELECT tmc, road, direction, county, intersection, road_order, miles, start_latitude, start_longitude, end_latitude, end_longitude, coalesce(aadt, donor_aadt) AS aadt_filled, coalesce(f_system, donor_class) AS f_system_filled
        FROM tmc LEFT JOIN (SELECT tmclinear AS line, max(aadt) AS donor_aadt, max(f_system) AS donor_class FROM tmc WHERE f_system NOT IN (1, 2) GROUP BY tmclinear) ON line = tmclinear""",
    "names": """SELECT name, roads, CASE WHEN name LIKE 'Main Road SR%' THEN counties END AS counties FROM (SELECT 'Main Road ' || left(road, 2) || ' ' || (CAST(split_part(road, '-', -1) AS INTEGER) // 20) AS name, list_sort(list(DISTINCT road)) AS roads FROM tmc WHERE f_system IN (3, 4) GROUP BY 1)
        CROSS JOIN (SELECT list(county ORDER BY county) FILTER (n % 2 = 1) AS counties FROM (SELECT county, row_number() OVER (ORDER BY county) AS n FROM (SELECT DISTINCT county FROM tmc WHERE county IS NOT NULL)))""",
    "named": "SELECT f.*, name AS arterial_name FROM filled AS f JOIN names ON list_contains(roads, road) WHERE counties IS NULL OR list_contains(counties, county)",
    "existing": "SELECT f.*, d.corridor_name AS arterial_name FROM filled AS f JOIN segs AS s ON s.tmc = f.tmc JOIN registry AS d ON d.corridor_id = s.corridor_id WHERE d.corridor_group = 'Arterial' AND d.is_active",
    "chosen": "SELECT * EXCLUDE (pick, source) FROM (SELECT *, row_number() OVER (PARTITION BY tmc ORDER BY source, arterial_name) AS pick FROM (SELECT *, 0 AS source FROM named UNION ALL SELECT *, 1 FROM existing)) WHERE pick = 1",
    "hourly": f"""SELECT tmc_code, {DAY} AS day, CAST(hour(measurement_tstamp) AS INTEGER) AS hour, {r("avg(speed)", 9)} AS avg_speed, CAST(any_value(isodow(measurement_tstamp)) AS INTEGER) AS dow FROM probe WHERE speed > 0 AND isodow(measurement_tstamp) <= 5 AND tmc_code IN (SELECT tmc FROM chosen) GROUP BY tmc_code, {DAY}, hour(measurement_tstamp)""",
    "day_speeds": f"""SELECT tmc_code, day, min(avg_speed) AS day_peak_speed, {r("avg(avg_speed) FILTER (hour IN (SELECT hour FROM extremes WHERE kind = 'free_flow'))", 9)} AS day_free_flow_speed FROM hourly GROUP BY tmc_code, day""",
    "occurrences": f"""SELECT tmc_code, count(*) AS analyzed_days, count(*) FILTER (day_peak_speed < CAST(0.7 AS DOUBLE) * day_free_flow_speed) AS occurrence_days, {r("avg(day_peak_speed)", 6)} AS avg_speed_peak, {r("avg(day_free_flow_speed)", 6)} AS avg_speed_free_flow FROM day_speeds WHERE day_peak_speed IS NOT NULL AND day_free_flow_speed > 0 GROUP BY tmc_code""",
    "flagged": f"""SELECT h.*, free_flow_speed, h.avg_speed < CAST(0.7 AS DOUBLE) * free_flow_speed AS is_congested FROM hourly AS h JOIN (SELECT tmc_code, {r("avg(avg_speed)", 9)} AS free_flow_speed FROM hourly WHERE hour IN (SELECT hour FROM extremes WHERE kind = 'free_flow') GROUP BY tmc_code) AS f ON f.tmc_code = h.tmc_code""",
    "queue_hours": "SELECT tmc_code, CAST(sum(n) AS BIGINT) AS total_congested_hours, max(n) AS max_daily_congested_hours FROM (SELECT tmc_code, day, count(*) FILTER (is_congested) AS n FROM flagged GROUP BY ALL) GROUP BY tmc_code",
    "hour_counts": f"SELECT tmc_code, hour, count(*) FILTER (is_congested) AS n, {r('avg(avg_speed)', 6)} AS speed FROM flagged GROUP BY ALL",
    "hour_picks": "SELECT tmc_code, hour AS peak_hour, n AS peak_n FROM hour_counts QUALIFY row_number() OVER (PARTITION BY tmc_code ORDER BY speed, hour) = 1",
    "picks": f"""SELECT w.tmc_code, peak_hour, onset_hour, busiest_dow, w.day AS busiest_date, w.hour AS busiest_hour, {r("w.avg_speed", 3)} AS min_speed FROM (SELECT * FROM flagged QUALIFY row_number() OVER (PARTITION BY tmc_code ORDER BY avg_speed, day, hour) = 1) AS w
        JOIN hour_picks AS p ON p.tmc_code = w.tmc_code JOIN (SELECT tmc_code, dow AS busiest_dow FROM (SELECT tmc_code, dow, count(*) FILTER (is_congested) AS n FROM flagged GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY tmc_code ORDER BY n DESC, dow) = 1) AS b ON b.tmc_code = w.tmc_code
        LEFT JOIN (SELECT c.tmc_code, min(c.hour) AS onset_hour FROM hour_counts AS c JOIN hour_picks AS k ON k.tmc_code = c.tmc_code WHERE k.peak_n > 0 AND c.n >= CAST(0.3 AS DOUBLE) * k.peak_n GROUP BY c.tmc_code) AS o ON o.tmc_code = w.tmc_code""",
    "character": "SELECT o.*, q.total_congested_hours, q.max_daily_congested_hours, p.peak_hour, p.onset_hour, p.busiest_dow, p.busiest_date, p.busiest_hour, p.min_speed FROM occurrences AS o JOIN queue_hours AS q ON q.tmc_code = o.tmc_code JOIN picks AS p ON p.tmc_code = o.tmc_code",
    "candidates": f"""SELECT c.*, k.* EXCLUDE (tmc_code), {r("avg_speed_peak / avg_speed_free_flow", 6)} AS speed_drop_ratio, {r("100.0 * occurrence_days / analyzed_days", 6)} AS occurrence_pct, {r("total_congested_hours * miles", 6)} AS annual_queue_mile_hours, {r("max_daily_congested_hours * miles", 6)} AS max_queue_mile_hours
        FROM chosen AS c JOIN character AS k ON k.tmc_code = c.tmc WHERE avg_speed_free_flow > 0 AND avg_speed_peak IS NOT NULL AND aadt_filled IS NOT NULL AND intersection IS NOT NULL AND miles <= 1.5 AND analyzed_days >= 30 AND f_system_filled IN (3, 4)""",
    "grouped": """SELECT g.arterial_name, g.direction, g.intersection, f.speed_drop_ratio, g.occurrence_pct, g.aadt, f.county, f.tmc, f.start_latitude, f.start_longitude, f.end_latitude, f.end_longitude, f.analyzed_days, f.annual_queue_mile_hours, f.max_queue_mile_hours, f.peak_hour, f.onset_hour, f.busiest_dow, f.busiest_date, f.busiest_hour, f.min_speed
        FROM (SELECT arterial_name, direction, intersection, max(occurrence_pct) AS occurrence_pct, quantile_cont(aadt_filled, 0.5) AS aadt FROM candidates GROUP BY ALL) AS g
        JOIN (SELECT * FROM candidates QUALIFY row_number() OVER (PARTITION BY arterial_name, direction, intersection ORDER BY speed_drop_ratio, tmc) = 1) AS f ON f.arterial_name = g.arterial_name AND f.direction = g.direction AND f.intersection = g.intersection""",
    "severity": f"SELECT *, {r('annual_queue_mile_hours * occurrence_pct / 100.0 * (1.0 - speed_drop_ratio) * aadt / 100000.0', 6)} AS severity_index FROM grouped",
    "vertices": """SELECT tmc, i, CASE i WHEN 0 THEN start_longitude WHEN 1 THEN start_longitude + CAST(0.001234567 AS DOUBLE) ELSE end_longitude END AS lon, CASE i WHEN 0 THEN start_latitude WHEN 1 THEN start_latitude + CAST(0.004 AS DOUBLE) ELSE end_latitude END AS lat
        FROM tmc CROSS JOIN (VALUES (0), (1), (2)) AS v(i) WHERE CAST(substr(tmc, 2) AS INTEGER) % 4 <> 3""",
    "lines": """SELECT tmc, i, lat, lon, count(*) OVER (PARTITION BY tmc) AS n FROM (SELECT tmc, i, lat, lon FROM vertices UNION ALL SELECT tmc, i, CASE i WHEN 0 THEN start_latitude ELSE end_latitude END, CASE i WHEN 0 THEN start_longitude ELSE end_longitude END FROM tmc CROSS JOIN (VALUES (0), (1)) AS v(i) WHERE tmc NOT IN (SELECT tmc FROM vertices))""",
    "shifts": """SELECT tmc, 12.0 * cos(t) / 111320.0 AS up, 12.0 * sin(t) / (111320.0 * greatest(0.1, cos(radians(mid)))) AS east FROM (SELECT tmc, atan2(arg_max(lon, i) - arg_min(lon, i), arg_max(lat, i) - arg_min(lat, i)) + pi() / 2 AS t, (arg_min(lat, i) + arg_max(lat, i)) / 2.0 AS mid FROM lines GROUP BY tmc)""",
    "deltas": """SELECT tmc, i, x - coalesce(lag(x) OVER w, 0) AS dx, y - coalesce(lag(y) OVER w, 0) AS dy FROM (SELECT tmc, i, CAST(round_even(lon * 1e6, 0) AS BIGINT) AS x, CAST(round_even(lat * 1e6, 0) AS BIGINT) AS y FROM vertices) WINDOW w AS (PARTITION BY tmc ORDER BY i)""",
}
PARTS["eligible"] = "SELECT bottleneck_id, aadt_weighted_severity_index FROM ranked WHERE ranking_eligible"
PARTS["mapped"] = """SELECT k.bottleneck_id, k.corridor_id, k.corridor_group, k.corridor_name, m.segment_order, s.tmc, aadt_weighted_severity_index AS severity, x.analysis_date AS worst_date, x.peak_time AS worst_time, k.corridor || CASE k.direction WHEN 'NORTHBOUND' THEN ' NB' WHEN 'SOUTHBOUND' THEN ' SB' END AS name,
    coalesce(strftime(x.analysis_date, '%B %-d, %Y'), 'N/A') AS worst_date_label, coalesce(strftime(x.peak_time, '%-I:%M %p'), 'N/A') AS worst_time_label, CAST(CASE k.corridor_group WHEN 'Interstate' THEN 5.0 WHEN 'Expressway' THEN 4.0 ELSE 3.0 END AS DOUBLE) AS width
    FROM ranked AS k JOIN members AS m ON m.bottleneck_id = k.bottleneck_id JOIN segs AS s ON s.corridor_id = k.corridor_id AND s.segment_order = m.segment_order
    LEFT JOIN (SELECT * FROM metrics WHERE occurrence QUALIFY row_number() OVER (PARTITION BY bottleneck_id ORDER BY queue_mile_hours DESC, analysis_date) = 1) AS x ON x.bottleneck_id = k.bottleneck_id WHERE k.ranking_eligible"""
PARTS["shifted"] = "SELECT l.tmc, '[' || string_agg('{\"lat\":' || CAST(round(lat + up, 6) AS VARCHAR) || ',\"lon\":' || CAST(round(lon + east, 6) AS VARCHAR) || '}', ',' ORDER BY i) || ']' AS points FROM lines AS l JOIN shifts AS s ON s.tmc = l.tmc GROUP BY l.tmc"
PARTS |= _classes("bottleneck_classes", "eligible", "aadt_weighted_severity_index") | _classes("map_classes", "mapped", "severity") | _tiers("tiers", "severity")
PARTS["top_tiers"] = "SELECT * FROM tiers ORDER BY class_rank DESC, severity_index DESC, tmc LIMIT 50"
PARTS |= _tiers("display_tiers", "(SELECT * EXCLUDE (class_score, class_rank, tier) FROM top_tiers)")

#: Parts that refer to themselves, or that many others read.
KEPT = {"probe", "joined", "daily", "profile", "smooth", "bottlenecks", "extents", "queues", "metrics", "ranked", "cells", "closed", "labels", "events", "comp", "core_comp", "hourly", "flagged", "candidates", "districts", "registry", "segs", "tmc"} | {f"{x}_{y}" for x in ("tiers", "display_tiers") for y in ("scored", "points", "near", "best")} | {"tiers", "top_tiers", "severity", "mapped"}


def sql(select: str) -> str:
    """``select`` with the parts that it needs, directly or through others."""
    need: set[str] = set()

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in need and re.search(rf"(?:FROM|JOIN)\s+{name}\b", text):
                need.add(name)
                visit(PARTS[name])

    visit(select)
    order: list[str] = []

    def place(name: str) -> None:
        for other in PARTS:
            if other in need and other != name and other not in order and re.search(rf"(?:FROM|JOIN)\s+{other}\b", PARTS[name]):
                place(other)
        if name not in order:
            order.append(name)

    for name in PARTS:
        if name in need:
            place(name)
    parts = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in KEPT else ''}({PARTS[n]})" for n in order)
    return f"WITH RECURSIVE {parts}\n{select}" if parts else select
