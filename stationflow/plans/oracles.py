"""DuckDB SQL for the catalog's queries, written from the benchmark tables and independent of Spark's code.

Trip times are known before they are rendered as text, so the parsing queries are checked against the
times themselves rather than against a second parser.
"""

from __future__ import annotations

CTES = {
    "trips": """
        SELECT l_orderkey * 10 + l_linenumber AS row_number,
               TIMESTAMP '2013-06-01' + to_seconds(secs) AS start_time,
               TIMESTAMP '2013-06-01'
                 + to_seconds(secs + 120 + CAST(floor(l_quantity * 60) AS BIGINT) + l_suppkey % 60) AS end_time,
               CAST(100 + l_suppkey % 500 AS INTEGER) AS start_station_id,
               CAST(100 + l_partkey % 500 AS INTEGER) AS end_station_id,
               l_linenumber AS line, l_returnflag AS flag
        FROM (SELECT *, date_diff('day', TIMESTAMP '1995-01-01', l_shipdate) * 144000
                        + l_orderkey % 1440 * 60 + l_partkey % 60 AS secs
              FROM lineitem)""",
    "gappy": """
        SELECT row_number,
               CASE WHEN line <> 3 THEN start_time END AS start_time,
               CASE WHEN line <> 5 THEN end_time END AS end_time,
               CASE WHEN NOT (line = 7 AND flag = 'A') THEN start_station_id END AS start_station_id,
               CASE WHEN NOT (line = 7 AND flag = 'R') THEN end_station_id END AS end_station_id
        FROM trips""",
    "placed": """
        SELECT *, 'Station ' || start_station_id AS start_station_name,
               CAST(CAST(406000 + start_station_id * 5 + line AS DOUBLE) / 10000 AS FLOAT) AS start_station_latitude,
               CAST(CAST(-740000 + start_station_id * 3 - line AS DOUBLE) / 10000 AS FLOAT) AS start_station_longitude,
               'Station ' || end_station_id AS end_station_name,
               CAST(CAST(406000 + end_station_id * 5 + line AS DOUBLE) / 10000 AS FLOAT) AS end_station_latitude,
               CAST(CAST(-740000 + end_station_id * 3 - line AS DOUBLE) / 10000 AS FLOAT) AS end_station_longitude
        FROM trips""",
    "raw": """
        SELECT * REPLACE (
                 CASE WHEN known THEN start_station_id END AS start_station_id,
                 CASE WHEN known THEN start_station_name END AS start_station_name,
                 CASE WHEN known THEN start_station_latitude END AS start_station_latitude,
                 CASE WHEN known THEN start_station_longitude END AS start_station_longitude,
                 CASE WHEN early THEN start_time - INTERVAL 1 MONTH ELSE start_time END AS start_time,
                 CASE WHEN early THEN end_time - INTERVAL 1 MONTH ELSE end_time END AS end_time),
               CASE WHEN listed THEN
                 CASE WHEN ym IN ('201501', '201502', '201503', '201506') THEN 'M/d/yyyy H:mm'
                      WHEN ym BETWEEN '201409' AND '201609' THEN 'M/d/yyyy HH:mm:ss'
                      ELSE 'yyyy-MM-dd HH:mm:ss' END END AS time_format
        FROM (SELECT *, strftime(start_time, '%Y%m') AS ym,
                     NOT (line = 6 AND flag = 'N') AS listed,
                     NOT (line = 7 AND flag = 'A') AS known,
                     strftime(start_time, '%Y%m') = '202108' AND flag = 'R' AS early,
                     CASE WHEN line = 6 AND flag = 'N' THEN 'JC-' ELSE '' END
                       || strftime(start_time, '%Y%m') || '-trips.csv' AS file_name
              FROM placed)""",
    "read_times": """
        SELECT * REPLACE (
                 CASE WHEN time_format = 'M/d/yyyy H:mm' THEN date_trunc('minute', start_time)
                      ELSE start_time END AS start_time,
                 CASE WHEN line = 7 AND flag = 'N' THEN NULL
                      WHEN time_format = 'M/d/yyyy H:mm' THEN date_trunc('minute', end_time)
                      ELSE end_time END AS end_time)
        FROM raw WHERE time_format IS NOT NULL""",
    "parsed": """
        SELECT * REPLACE (
                 CASE WHEN file_name LIKE '202108%' AND strftime(start_time, '%Y%m') = '202107'
                      THEN date_trunc('day', start_time + INTERVAL 1 MONTH)::TIMESTAMP
                      ELSE start_time END AS start_time,
                 CASE WHEN file_name LIKE '202108%' AND strftime(end_time, '%Y%m') = '202107'
                      THEN date_trunc('day', end_time + INTERVAL 1 MONTH)::TIMESTAMP
                      ELSE end_time END AS end_time)
        FROM read_times""",
    "bronze": """
        SELECT start_time, end_time, start_station_id, end_station_id, row_number
        FROM parsed WHERE start_station_id IS NOT NULL AND end_station_id IS NOT NULL""",
    "stations": """
        SELECT id, min(name) AS name, min(latitude) AS latitude, min(longitude) AS longitude
        FROM (SELECT start_station_id AS id, start_station_name AS name,
                     start_station_latitude AS latitude, start_station_longitude AS longitude FROM placed
              UNION ALL
              SELECT end_station_id, end_station_name, end_station_latitude, end_station_longitude FROM placed)
        GROUP BY id""",
    "departed": """
        SELECT start_station_id AS station_id, date_trunc('hour', start_time)::TIMESTAMP AS time,
               count(row_number) AS "count"
        FROM trips GROUP BY ALL""",
    "arrived": """
        SELECT end_station_id AS station_id, date_trunc('hour', end_time)::TIMESTAMP AS time,
               count(row_number) AS "count"
        FROM trips GROUP BY ALL""",
    "demand": """
        SELECT station_id, time, coalesce(d."count", 0) AS bike_demand, coalesce(a."count", 0) AS dock_demand
        FROM departed d FULL OUTER JOIN arrived a USING (station_id, time)""",
    "keyed_silver": """
        SELECT station_id, time, bike_demand, dock_demand, latitude, longitude,
               CAST(year(time) AS INTEGER) AS year, CAST(month(time) AS INTEGER) AS month,
               CAST(day(time) AS INTEGER) AS dayofmonth, CAST(isodow(time) - 1 AS INTEGER) AS weekday,
               CAST(week(time) AS INTEGER) AS weekofyear, CAST(dayofyear(time) AS INTEGER) AS dayofyear,
               CAST(hour(time) AS INTEGER) AS hour
        FROM demand LEFT JOIN stations ON id = station_id""",
    "calendar": """
        SELECT row_number, CAST(year(start_time) AS INTEGER) AS year, CAST(month(start_time) AS INTEGER) AS month,
               CAST(day(start_time) AS INTEGER) AS dayofmonth, CAST(isodow(start_time) - 1 AS INTEGER) AS weekday,
               CAST(week(start_time) AS INTEGER) AS weekofyear, CAST(dayofyear(start_time) AS INTEGER) AS dayofyear,
               CAST(hour(start_time) AS INTEGER) AS hour
        FROM trips""",
    "requests": """
        SELECT event_id, 'Station ' || (100 + CAST(json_extract_string(props, '$.k') AS INTEGER)) AS station_name,
               date_trunc('minute', ts)::TIMESTAMP AS start, CAST(event_type = 'purchase' AS INTEGER) AS ticked
        FROM events""",
    "grid": """
        SELECT event_id, latitude, longitude, start + to_hours(h) AS time, ticked
        FROM requests JOIN stations ON name = station_name, range(24) AS hours(h)""",
}

# What each CTE reads.
READS = {
    "trips": [],
    "gappy": ["trips"],
    "placed": ["trips"],
    "raw": ["placed"],
    "read_times": ["raw"],
    "parsed": ["read_times"],
    "bronze": ["parsed"],
    "stations": ["placed"],
    "departed": ["trips"],
    "arrived": ["trips"],
    "demand": ["departed", "arrived"],
    "keyed_silver": ["demand", "stations"],
    "calendar": ["trips"],
    "requests": [],
    "grid": ["requests", "stations"],
}


def _with(sql: str, *ctes: str) -> str:
    """Prefix ``sql`` with the CTEs it names and all they read, each before its readers."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for read in READS[name]:
            add(read)
        if name not in ordered:
            ordered.append(name)

    for name in ctes:
        add(name)
    kept = {name: "MATERIALIZED " if name in ("trips", "keyed_silver") else "" for name in ordered}
    return "WITH " + ",\n".join(f"{name} AS {kept[name]}({CTES[name]})" for name in ordered) + "\n" + sql


def _cleared(expr: str) -> str:
    """Six places, without a negative zero."""
    return f"round({expr}, 6) + 0.0"


CYCLES = (("dayofmonth", 31), ("weekofyear", 52), ("dayofyear", 365), ("hour", 24))
CYCLIC = {
    f"{part}_{fn}": f"{fn}(2 * pi() * {part} / {length})" for part, length in CYCLES for fn in ("sin", "cos")
}
NUMERIC = {
    "latitude": "CAST(latitude AS DOUBLE)",
    "longitude": "CAST(longitude AS DOUBLE)",
    "year": "CAST(year AS DOUBLE)",
    **CYCLIC,
}

WEEKEND = "weekday IN (5, 6)"
FLOATING = {
    "mlk_presidents": "month IN (1, 2) AND weekday = 0 AND dayofmonth BETWEEN 15 AND 21",
    "labor": "month = 9 AND weekday = 0 AND dayofmonth <= 7",
    "columbus": "month = 10 AND weekday = 0 AND dayofmonth BETWEEN 8 AND 14",
    "thanksgiving": "month = 11 AND weekday = 3 AND dayofmonth >= 22",
}
FIXED = ((1, 1), (6, 19), (7, 4), (11, 11), (12, 25))


def _fixed(month: int, day: int) -> str:
    return (
        f"(month = {month} AND ((dayofmonth = {day} AND weekday <= 4)"
        f" OR (dayofmonth = {day - 1} AND weekday = 5)))"
    )


ANY_FIXED = " OR ".join(_fixed(m, d) for m, d in FIXED)
# As a whole, the fixed rules add no more to the weekends than the dates themselves.
HOLIDAY = " OR ".join(
    [WEEKEND, *[f"({rule})" for rule in FLOATING.values()],
     *[f"(month = {m} AND dayofmonth = {d})" for m, d in FIXED]]
)


def _marked(rule: str) -> str:
    return _with(
        f"SELECT row_number, month, dayofmonth, weekday, ({rule}) AS is_holiday FROM calendar", "calendar"
    )


_STATS = ", ".join(
    f"avg({expr}) AS mean_{i}, stddev_samp({expr}) AS std_{i}" for i, expr in enumerate(NUMERIC.values())
)
# The same next to every row, so that rows and statistics come from one scan without a join.
_STATS_OF_ALL = ", ".join(
    f"avg({expr}) OVER () AS mean_{i}, stddev_samp({expr}) OVER () AS std_{i}" for i, expr in enumerate(NUMERIC.values())
)
_SCALED = [_cleared(f"({expr} - mean_{i}) / std_{i}") for i, expr in enumerate(NUMERIC.values())]
_KEYED_SPLIT = """(CASE WHEN CAST('0x' || substr(md5(station_id || '|' || strftime(time, '%Y-%m-%d %H')), 1, 8) AS BIGINT)
                             / 4294967296::DOUBLE < 0.9::DOUBLE THEN 'train'
                        WHEN CAST('0x' || substr(md5(station_id || '|' || strftime(time, '%Y-%m-%d %H')), 1, 8) AS BIGINT)
                             / 4294967296::DOUBLE < 0.9::DOUBLE + 0.05::DOUBLE THEN 'val' ELSE 'test' END)"""
_METRICS = """(VALUES ('bike_demand'), ('dock_demand')) AS labels(label), (VALUES ('val'), ('test')) AS splits(split),
              (VALUES ('rmse'), ('r2')) AS metrics(metric)"""
_MONTHS = [f"CAST(month = {slot} AS DOUBLE)" for slot in range(12)]
_WEEKDAYS = [f"CAST(weekday = {slot} AS DOUBLE)" for slot in range(6)]


def _boosted(n_trees: int, rate: float = 0.1) -> str:
    """Metrics of boosted trees of one split each. The first tree predicts the label, each later one twice what is left over; a tree
    splits by the flag whose group means have the larger sum of squares over the training rows."""
    train = "FILTER (WHERE split = 'train')"
    step = f"""(
        SELECT split, y, holiday, morning, p + {{weight}} * CASE WHEN sum(h * h) {train} OVER () >= sum(m * m) {train} OVER () THEN h ELSE m END AS p
        FROM (SELECT *, avg({{left}}) {train} OVER (PARTITION BY holiday) AS h, avg({{left}}) {train} OVER (PARTITION BY morning) AS m
              FROM {{rows}}))"""
    rows = f"(SELECT {_KEYED_SPLIT} AS split, bike_demand AS y, ({HOLIDAY}) AS holiday, hour < 12 AS morning, 0::DOUBLE AS p FROM keyed_silver)"
    for k in range(n_trees):
        rows = step.format(rows=rows, left="y" if k == 0 else "2 * (y - p)", weight="1" if k == 0 else f"{rate}::DOUBLE")
    return _with(
        f"""SELECT 'bike_demand' AS label, split, unnest(['rmse', 'r2']) AS metric,
                   round(unnest([sqrt(avg((y - p) ^ 2)), 1 - sum((y - p) ^ 2) / (var_pop(y) * count(*))]), 6) AS value
            FROM {rows} WHERE split <> 'train' GROUP BY split""",
        "keyed_silver",
    )


def _slots(*exprs: str) -> str:
    return ", ".join(f"{expr} AS f{i:02d}" for i, expr in enumerate(exprs))


def _feature_sql(kept: str, holiday: str, source: str, *ctes: str) -> str:
    slots = _slots(*_SCALED, *_MONTHS, *_WEEKDAYS, f"CAST({holiday} AS DOUBLE)")
    if source == "keyed_silver":
        return _with(f"SELECT {kept}, {slots} FROM (SELECT *, {_STATS_OF_ALL} FROM keyed_silver)", "keyed_silver", *ctes)
    return _with(
        f"SELECT {kept}, {slots} FROM {source}, (SELECT {_STATS} FROM keyed_silver)", "keyed_silver", *ctes
    )


GOLD = _feature_sql("bike_demand, dock_demand", f"({HOLIDAY})", "keyed_silver")
SILVER = _with(
    f"""SELECT bike_demand, dock_demand, latitude, longitude, year, month, dayofmonth, weekday,
               weekofyear, dayofyear, hour, ({HOLIDAY}) AS is_holiday FROM keyed_silver""",
    "keyed_silver",
)
DEMAND_WITH_GAPS = _with(
    """SELECT coalesce(station_id, 0) AS station_id, time,
              coalesce(b, 0) AS bike_demand, coalesce(d, 0) AS dock_demand
       FROM (SELECT start_station_id AS station_id, date_trunc('hour', start_time)::TIMESTAMP AS time,
                    count(row_number) AS b FROM gappy GROUP BY ALL)
       FULL OUTER JOIN
            (SELECT end_station_id AS station_id, date_trunc('hour', end_time)::TIMESTAMP AS time,
                    count(row_number) AS d FROM gappy GROUP BY ALL)
       USING (station_id, time)""",
    "gappy",
)

_ERA_1_ROWS = """
    SELECT CAST(date_diff('second', start_time, end_time) AS INTEGER) AS tripduration,
           strftime(start_time, '%Y-%m-%d %H:%M:%S') || '.0000' AS starttime,
           strftime(end_time, '%Y-%m-%d %H:%M:%S') || '.0000' AS stoptime,
           CASE WHEN NOT (line = 7 AND flag = 'A') THEN CAST(start_station_id AS FLOAT) END AS start_id,
           CAST(end_station_id AS FLOAT) AS end_id,
           CAST(row_number % 40000 AS INTEGER) AS bikeid,
           CASE WHEN line <> 4 THEN CASE WHEN flag = 'N' THEN 'Customer' ELSE 'Subscriber' END END AS usertype,
           *
    FROM placed WHERE year(start_time) < 2020"""
_ERA_2_ROWS = """
    SELECT strftime(start_time, '%Y-%m-%d %H:%M:%S') AS started_at,
           strftime(end_time, '%Y-%m-%d %H:%M:%S') AS ended_at,
           CASE WHEN NOT (line = 7 AND flag = 'A') THEN CAST(start_station_id || '.15' AS FLOAT) END AS start_id,
           CASE WHEN line <> 4 THEN CASE WHEN flag = 'N' THEN 'casual' ELSE 'member' END END AS member_casual,
           *
    FROM placed WHERE year(start_time) >= 2020"""
_PLACES = """start_station_name, start_station_latitude, start_station_longitude,
             end_station_name, end_station_latitude, end_station_longitude"""
_HARMONIZED_1 = f"""
    SELECT starttime AS start_time, stoptime AS end_time, {_PLACES},
           CASE WHEN NOT (line = 7 AND flag = 'A') THEN start_station_id END AS start_station_id, end_station_id,
           CASE WHEN usertype = 'Subscriber' THEN 1 ELSE 0 END AS member
    FROM ({_ERA_1_ROWS})"""
_HARMONIZED_2 = f"""
    SELECT started_at AS start_time, ended_at AS end_time, {_PLACES},
           CASE WHEN NOT (line = 7 AND flag = 'A') THEN start_station_id END AS start_station_id, end_station_id,
           CASE WHEN member_casual = 'casual' THEN 0 ELSE 1 END AS member
    FROM ({_ERA_2_ROWS})"""
_BOTH_ERAS = _with(f"{_HARMONIZED_1} UNION ALL {_HARMONIZED_2}", "placed")
_OBSERVATIONS = """
    SELECT start_station_id AS id, start_station_name AS name,
           start_station_latitude AS latitude, start_station_longitude AS longitude FROM raw
    UNION ALL
    SELECT end_station_id, end_station_name, end_station_latitude, end_station_longitude FROM raw"""
_NAIVE_RMSE = "round(sqrt(avg((bike_demand - dock_demand) ** 2)), 6) AS rmse"
_NAIVE_R2 = (
    "round(1 - sum((bike_demand - dock_demand) ** 2) / (var_pop(bike_demand) * count(*)), 6) AS r2"
)
_CALENDAR_OF_GRID = """(SELECT *, year(time) AS year, month(time) AS month, day(time) AS dayofmonth,
                               isodow(time) - 1 AS weekday, week(time) AS weekofyear,
                               dayofyear(time) AS dayofyear, hour(time) AS hour FROM grid)"""

ORACLES: dict[str, str] = {
    "csv_scan_era1": _with(
        f"""SELECT tripduration, starttime, stoptime, start_id AS "start station id",
                   start_station_name AS "start station name",
                   start_station_latitude AS "start station latitude",
                   start_station_longitude AS "start station longitude", end_id AS "end station id",
                   end_station_name AS "end station name", end_station_latitude AS "end station latitude",
                   end_station_longitude AS "end station longitude", bikeid, usertype,
                   1980 AS "birth year", line AS gender
            FROM ({_ERA_1_ROWS})""",
        "placed",
    ),
    "csv_scan_two_eras": _with(
        f"""SELECT 1 AS era, starttime AS start_text, start_id AS station_id, usertype AS rider FROM ({_ERA_1_ROWS})
            UNION ALL
            SELECT 2, started_at, start_id, member_casual FROM ({_ERA_2_ROWS})""",
        "placed",
    ),
    "table_roundtrip": _with(
        "SELECT start_time, end_time, start_station_id, end_station_id, row_number FROM trips", "trips"
    ),
    "source_lineage": _with(
        "SELECT strftime(start_time, '%Y%m') AS file_month, count(*) AS n_rows FROM trips GROUP BY ALL", "trips"
    ),
    "surrogate_row_id": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_tasks_with_gaps FROM lineitem",
    "feature_model_roundtrip": GOLD,
    "model_roundtrip": _with("SELECT count(*) AS n_rows, count(*) AS n_same FROM demand", "demand"),
    "model_version_score": _with(
        "SELECT CAST(year(time) AS INTEGER) AS year, count(*) AS n_rows, count(*) AS n_same FROM demand GROUP BY ALL", "demand"
    ),
    "station_names": _with("SELECT name FROM stations", "stations"),
    "harmonize_era1": _with(_HARMONIZED_1, "placed"),
    "harmonize_era2": _with(_HARMONIZED_2, "placed"),
    "station_id_truncate": """
        SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS FLOAT) AS raw_id,
               CAST(trunc(CAST(l_extendedprice AS FLOAT)) AS INTEGER) AS station_id
        FROM lineitem""",
    "member_flag": """
        SELECT l_orderkey, l_linenumber,
               CAST(l_linenumber <> 4 AND l_returnflag <> 'N' AS INTEGER) AS member_era_1,
               CAST(l_linenumber = 4 OR l_returnflag <> 'N' AS INTEGER) AS member_era_2
        FROM lineitem""",
    "trip_legs": _with(
        """SELECT row_number, start_time AS time, start_station_id AS station_id, true AS is_start FROM trips
           UNION ALL
           SELECT row_number, end_time, end_station_id, false FROM trips""",
        "trips",
    ),
    "bronze_trip_fact": _with("SELECT * FROM bronze", "bronze"),
    "time_format_slice_counts": _with(
        "SELECT time_format, count(*) AS n_rows FROM raw WHERE time_format IS NOT NULL GROUP BY ALL", "raw"
    ),
    "drop_null_stations": _with(
        """SELECT row_number, start_station_id, end_station_id FROM raw
           WHERE start_station_id IS NOT NULL AND end_station_id IS NOT NULL""",
        "raw",
    ),
    "unmatched_slice_count": _with(
        "SELECT file_name, count(*) AS dropped_rows FROM raw WHERE time_format IS NULL GROUP BY ALL", "raw"
    ),
    "file_name_from_path": _with("SELECT row_number, file_name FROM raw", "raw"),
    "parse_trip_times": _with("SELECT row_number, start_time, end_time FROM parsed", "parsed"),
    "month_shift_repair": _with(
        """SELECT row_number, file_name,
                  CASE WHEN file_name LIKE '202108%' AND strftime(start_time, '%Y%m') = '202107'
                       THEN date_trunc('day', start_time + INTERVAL 1 MONTH)::TIMESTAMP
                       ELSE start_time END AS start_time,
                  CASE WHEN file_name LIKE '202108%' AND strftime(end_time, '%Y%m') = '202107'
                       THEN date_trunc('day', end_time + INTERVAL 1 MONTH)::TIMESTAMP
                       ELSE end_time END AS end_time
           FROM raw""",
        "raw",
    ),
    "month_shift_repair_keeping_time": _with(
        """SELECT row_number, file_name,
                  CASE WHEN file_name LIKE '202108%' AND strftime(start_time, '%Y%m') = '202107'
                       THEN start_time + INTERVAL 1 MONTH ELSE start_time END AS start_time,
                  CASE WHEN file_name LIKE '202108%' AND strftime(end_time, '%Y%m') = '202107'
                       THEN end_time + INTERVAL 1 MONTH ELSE end_time END AS end_time
           FROM raw""",
        "raw",
    ),
    "combine_eras": _BOTH_ERAS,
    "job_ingest": _BOTH_ERAS,
    "station_observations": _with(_OBSERVATIONS, "raw"),
    "station_dimension": _with(
        f"""SELECT id, min(name) AS name, min(latitude) AS latitude, min(longitude) AS longitude
            FROM ({_OBSERVATIONS}) GROUP BY id""",
        "raw",
    ),
    "station_dimension_whole_row": _with(
        f"""SELECT id, name, latitude, longitude
            FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY name, latitude, longitude) AS place
                  FROM ({_OBSERVATIONS}))
            WHERE place = 1""",
        "raw",
    ),
    "hourly_departures": _with("SELECT * FROM departed", "departed"),
    "hourly_arrivals": _with("SELECT * FROM arrived", "arrived"),
    "hourly_demand": _with("SELECT * FROM demand", "demand"),
    "hourly_demand_with_gaps": DEMAND_WITH_GAPS,
    "hourly_demand_outer_join": DEMAND_WITH_GAPS,
    "station_enriched": _with(
        "SELECT time, bike_demand, dock_demand, latitude, longitude FROM keyed_silver", "keyed_silver"
    ),
    "time_features": _with("SELECT * FROM calendar", "calendar"),
    "holiday_weekend": _marked(WEEKEND),
    **{f"holiday_{name}": _marked(rule) for name, rule in FLOATING.items()},
    "holiday_fixed_date": _marked(_fixed(7, 4)),
    "holiday_fixed_date_observed": _marked(
        f"""{_fixed(7, 4)} OR (month = 7 AND dayofmonth = 3 AND weekday = 4)
            OR (month = 7 AND dayofmonth = 5 AND weekday = 0)"""
    ),
    "holiday_fixed_dates": _marked(ANY_FIXED),
    "holiday_all": _marked(HOLIDAY),
    "cyclic_encode": _with(
        "SELECT row_number, year, month, weekday, "
        + ", ".join(f"{_cleared(expr)} AS {name}" for name, expr in CYCLIC.items())
        + " FROM calendar",
        "calendar",
    ),
    "scaled_features": _with(
        f"SELECT station_id, time, {_slots(*_SCALED)} FROM (SELECT *, {_STATS_OF_ALL} FROM keyed_silver)",
        "keyed_silver",
    ),
    "onehot_month": _with(
        f"SELECT station_id, time, {_slots(*_MONTHS)} FROM keyed_silver", "keyed_silver"
    ),
    "onehot_weekday": _with(
        f"SELECT station_id, time, {_slots(*_WEEKDAYS)} FROM keyed_silver", "keyed_silver"
    ),
    "gold_features": GOLD,
    "job_gold": GOLD,
    "silver_null_counts": _with(
        f"""SELECT CAST(0 AS BIGINT) AS bike_demand, CAST(0 AS BIGINT) AS dock_demand,
                   count(*) - count(latitude) AS latitude, count(*) - count(longitude) AS longitude,
                   {", ".join(f"count(*) - count(time) AS {part}" for part in
                              ("year", "month", "dayofmonth", "weekday", "weekofyear", "dayofyear", "hour"))},
                   CAST(0 AS BIGINT) AS is_holiday
            FROM gaps_demand LEFT JOIN stations ON id = station_id""",
        "stations",
    ).replace("WITH ", f"WITH gaps_demand AS ({DEMAND_WITH_GAPS}), ", 1),
    "eval_rmse": _with(f"SELECT {_NAIVE_RMSE} FROM demand", "demand"),
    "eval_r2": _with(f"SELECT {_NAIVE_R2} FROM demand", "demand"),
    "eval_both": _with(
        f"SELECT CAST(year(time) AS INTEGER) AS year, {_NAIVE_RMSE}, {_NAIVE_R2} FROM demand GROUP BY ALL", "demand"
    ),
    "train_split": _with(
        "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differ FROM demand", "demand"
    ),
    "train_split_keyed": _with(
        """SELECT station_id, time,
                  CASE WHEN share < 0.9::DOUBLE THEN 'train'
                       WHEN share < 0.9::DOUBLE + 0.05::DOUBLE THEN 'val' ELSE 'test' END AS split
           FROM (SELECT *, CAST('0x' || substr(md5(station_id || '|' || strftime(time, '%Y-%m-%d %H')), 1, 8)
                                AS BIGINT) / 4294967296::DOUBLE AS share FROM demand)""",
        "demand",
    ),
    "station_lookup": _with(
        "SELECT event_id, station_name, latitude, longitude FROM requests JOIN stations ON name = station_name",
        "requests", "stations",
    ),
    "forecast_horizon": _with(
        """SELECT event_id, strftime(start + to_hours(h), '%Y-%m-%d %H:%M') AS time_text,
                  start + to_hours(h) AS time
           FROM requests, range(24) AS hours(h)""",
        "requests",
    ),
    "forecast_grid": _with("SELECT * RENAME (ticked AS is_holiday) FROM grid", "grid"),
    "forecast_grid_calendar": _with(
        f"""SELECT event_id, latitude, longitude, time, CAST({HOLIDAY} AS INTEGER) AS is_holiday
            FROM {_CALENDAR_OF_GRID}""",
        "grid",
    ),
    "forecast_features": _feature_sql("event_id, time", "ticked", _CALENDAR_OF_GRID, "grid"),
    "forecast_round": """
        SELECT l_orderkey, l_linenumber, CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS predicted_bike_demand,
               CAST(round_even(l_quantity / 4, 0) AS BIGINT) AS predicted_dock_demand
        FROM lineitem""",
    "forecast_unify": _with(
        """SELECT station_id, time, CAST(round_even(d."count" / 2, 0) AS BIGINT) AS predicted_bike_demand,
                  CAST(round_even(a."count" / 2, 0) AS BIGINT) AS predicted_dock_demand
           FROM departed d JOIN arrived a USING (station_id, time)""",
        "departed", "arrived",
    ),
    "job_bronze": _with(
        f"""SELECT start_station_id, start_time, end_time, end_station_id, row_number, latitude, longitude
            FROM bronze LEFT JOIN (
                 SELECT id, min(latitude) AS latitude, min(longitude) AS longitude
                 FROM ({_OBSERVATIONS.replace('FROM raw', 'FROM parsed WHERE start_station_id IS NOT NULL')})
                 GROUP BY id)
            ON id = start_station_id""",
        "bronze",
    ),
    "job_silver": SILVER,
    **{
        name: _with(
            f"""SELECT 'bike_demand' AS label, split, unnest(['rmse', 'r2']) AS metric,
                       round(unnest([sqrt(avg((y - p) ^ 2)), 1 - sum((y - p) ^ 2) / (var_pop(y) * count(*))]), 6) AS value
                FROM (SELECT split, bike_demand AS y,
                             avg(bike_demand) FILTER (WHERE split = 'train') OVER (PARTITION BY flag) AS p
                      FROM (SELECT *, ({HOLIDAY}) AS flag, {_KEYED_SPLIT} AS split FROM keyed_silver))
                WHERE split <> 'train' GROUP BY split""",
            "keyed_silver",
        )
        for name in ("train_rf",)
    },
    "train_gbt": _boosted(4),
    "streamed_demand": _with("SELECT * FROM demand", "demand"),
    "monthly_silver": SILVER,
    "train_two_targets": f"SELECT label, split, metric, true AS agrees FROM {_METRICS}",
    "job_train": f"SELECT label, split, metric, true AS agrees, 'random_forest' AS model FROM {_METRICS}",
    "experiment_metrics": f"""
        SELECT model, label, split, metric, CAST(1 AS BIGINT) AS n_runs, CAST(1 AS BIGINT) AS n_features, CAST(0 AS BIGINT) AS n_null
        FROM {_METRICS}, (VALUES ('random_forest')) AS families(model)""",
    "score_both_targets": _with("SELECT station_id, time, bike_demand, dock_demand, true AS agrees FROM demand", "demand"),
    "forecast_demand": _with(
        """SELECT event_id, station_name, start + to_hours(h) AS time, true AS agrees
           FROM requests JOIN stations ON name = station_name, range(24) AS hours(h)""",
        "requests", "stations",
    ),
    "forecast_every_station": _with(
        f"""SELECT station_id, time, CAST({HOLIDAY} AS INTEGER) AS is_holiday, true AS agrees
            FROM (SELECT *, month(time) AS month, day(time) AS dayofmonth, isodow(time) - 1 AS weekday
                  FROM (SELECT id AS station_id, last + to_hours(h) AS time
                        FROM stations, (SELECT date_trunc('minute', max(start_time))::TIMESTAMP AS last FROM trips), range(24) AS hours(h)))""",
        "trips", "stations",
    ),
    "job_chain": _with(
        """, readable AS (
               SELECT * FROM bronze WHERE start_time IS NOT NULL AND end_time IS NOT NULL
           ), hours AS (
               SELECT start_station_id AS id, date_trunc('hour', start_time) AS time FROM readable
               UNION SELECT end_station_id, date_trunc('hour', end_time) FROM readable
           ), ids AS (
               SELECT start_station_id AS id FROM bronze UNION SELECT end_station_id FROM bronze
           )
           SELECT (SELECT count(*) FROM raw) AS n_raw, (SELECT count(*) FROM bronze) AS n_bronze,
                  (SELECT count(*) FROM bronze) - (SELECT count(*) FROM readable) AS n_rejects,
                  (SELECT count(*) FROM hours) AS n_silver, (SELECT count(*) FROM hours) AS n_gold,
                  (SELECT count(*) FROM ids) AS n_station, 24 * (SELECT count(*) FROM ids) AS n_forecast""",
        "bronze",
    ).replace(")\n, readable", "), readable"),
}
