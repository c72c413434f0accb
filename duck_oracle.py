"""DuckDB SQL that computes every registered query independently of Spark.

The driver runs these next to the Spark queries on the same parquet tables
(views ``events``, ``orders``, ...). The shared CTEs re-derive the incident
and weather sources straight from table columns (no JSON), so they check the
Spark side's payload handling, time-zone rules, rounding and joins from a
second implementation. Unreferenced CTEs are never evaluated.
"""

from __future__ import annotations

from squall.functions.urls import (INCIDENT_BASE_URL, INCIDENT_PAGE_SIZE, WEATHER_BASE_URL,
                                   WEATHER_HOURLY_VARS)

# Fixed values shared with squall.sources.adapters.
TZ = "America/Toronto"
LOAD_TIME = "TIMESTAMP '2024-02-01 00:00:00'"
UPDATE_LOAD_TIME = "TIMESTAMP '2024-03-01 00:00:00'"

_LAT = "CAST(43.6 + (user_id % 5) * 0.05 + (event_id % 7) * 0.0025 AS DECIMAL(9,6))"
_LON = "CAST(-79.6 + (user_id % 5) * 0.05 - (event_id % 7) * 0.0025 AS DECIMAL(9,6))"


def _yes_if(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 'YES' ELSE 'NO' END"


# Labels by code, in code order; other codes and NULL are 'Other'.
WEATHER_LABELS = [
    ("Clear", [0]), ("Cloudy", [1, 2, 3]), ("Fog", [45, 48]), ("Rain/Drizzle", [51, 53, 55, 56, 57]),
    ("Rain", [61, 63, 65, 66, 67]), ("Snow", [71, 73, 75, 77]), ("Rain showers", [80, 81, 82]), ("Snow", [85, 86]),
    ("Thunderstorm", [95, 96, 99]),
]
# Hours of the day; all others and NULL are 'Evening'.
DAYPARTS = [("Night", 0, 5), ("Morning", 6, 11), ("Afternoon", 12, 17)]
# Months of the seasons; NULL is 'Fall'.
SEASONS = [("Winter", [12, 1, 2]), ("Spring", [3, 4, 5]), ("Summer", [6, 7, 8]), ("Fall", [9, 10, 11])]


def weather_case(c: str) -> str:
    whens = " ".join(f"WHEN {c} IN ({', '.join(map(str, codes))}) THEN '{label}'" for label, codes in WEATHER_LABELS)
    return f"CASE {whens} ELSE 'Other' END"


def daypart_case(c: str) -> str:
    whens = " ".join(f"WHEN {c} BETWEEN {lo} AND {hi} THEN '{label}'" for label, lo, hi in DAYPARTS)
    return f"CASE {whens} ELSE 'Evening' END"


def yes_no_case(c: str) -> str:
    return f"CASE {c} WHEN 'YES' THEN true WHEN 'NO' THEN false END"


def season_case(c: str) -> str:
    whens = " ".join(f"WHEN month({c}) IN ({', '.join(map(str, months))}) THEN '{label}'" for label, months in SEASONS)
    return f"CASE {whens} ELSE 'Fall' END"


# Severity: the smallest rank whose flag holds (flags that are NULL do not hold),
# then the label by rank.
_RANK = ("least(CASE WHEN fatalities > 0 THEN 1 ELSE 5 END, CASE WHEN injury_collisions THEN 2 ELSE 5 END, "
         "CASE WHEN ftr_collisions THEN 3 ELSE 5 END, CASE WHEN pd_collisions THEN 4 ELSE 5 END)")
_SEVERITY_LABELS = "['Fatality', 'Injury', 'Fail to Remain', 'Property Damage', 'Unknown']"
# Invalid coordinates: anything but both inside the box.
_INVALID = "NOT coalesce(lat BETWEEN 40 AND 45 AND lon BETWEEN -80 AND -78, false)"


def local_to_utc(local_ts: str) -> str:
    """Naive local wall clock -> naive UTC wall clock (standard time when ambiguous)."""
    return f"timezone('UTC', timezone('{TZ}', {local_ts}))"


def utc_to_local(utc_ts: str) -> str:
    return f"timezone('{TZ}', timezone('UTC', {utc_ts}))"


CTES: list[tuple[str, str]] = [
    ("incidents_src", f"""
    SELECT
      event_id AS pos,
      CAST(ts AS DATE) AS doc_day,
      CAST(event_id // 1000 AS INTEGER) AS page,
      CAST(event_id % 2147483647 AS INTEGER) AS objectid,
      CASE WHEN event_id % 97 = 0 THEN NULL
           WHEN event_id % 10 = 1 THEN 'GO-' || CAST(event_id - 1 AS VARCHAR)
           ELSE 'GO-' || CAST(event_id AS VARCHAR) END AS event_unique_id,
      CASE WHEN event_id % 89 = 0 THEN NULL
           ELSE epoch_ms(timezone('{TZ}', date_trunc('day', ts))) END AS occ_ms,
      CASE WHEN event_id % 83 = 0 THEN NULL ELSE CAST(hour(ts) AS VARCHAR) END AS occ_hour_text,
      strftime(ts, '%B') AS occ_month,
      strftime(ts, '%A') AS occ_dow,
      CAST(year(ts) AS INTEGER) AS occ_year,
      'D' || CAST(user_id % 6 + 11 AS VARCHAR) AS division,
      CAST(user_id % 158 + 1 AS VARCHAR) AS hood_158,
      'Hood ' || CAST(user_id % 158 + 1 AS VARCHAR) AS neighbourhood_158,
      CASE WHEN event_id % 59 = 0 THEN NULL
           WHEN event_id % 53 = 0 THEN CAST(0 AS DECIMAL(9,6))
           ELSE {_LAT} END AS lat0,
      CASE WHEN event_id % 53 = 0 THEN CAST(0 AS DECIMAL(9,6)) ELSE {_LON} END AS lon0,
      CASE WHEN event_type = 'error' AND value > 20 THEN 1
           WHEN event_id % 11 = 0 THEN NULL ELSE 0 END AS fatalities_raw,
      CASE WHEN event_type = 'error' THEN 'YES' WHEN event_type = 'view' THEN 'NO'
           WHEN event_type = 'click' THEN 'yes' END AS injury_text,
      {_yes_if('event_id % 4 = 0')} AS ftr_text,
      {_yes_if('event_id % 3 = 0')} AS pd_text,
      {_yes_if('event_id % 2 = 0')} AS automobile_text,
      {_yes_if('event_id % 17 = 0')} AS motorcycle_text,
      CASE WHEN event_id % 5 = 0 THEN 'YES' WHEN event_id % 5 = 1 THEN 'NO' END AS passenger_text,
      {_yes_if('event_id % 19 = 0')} AS bicycle_text,
      CASE WHEN event_type = 'purchase' THEN 'YES' WHEN event_type = 'signup' THEN 'Yes'
           ELSE 'NO' END AS pedestrian_text
    FROM events"""),
    # UTC instant by the DST rule, and the coordinate null rule, for every feature.
    ("incidents_occ", f"""
    SELECT s.*,
      CASE WHEN occ_ms IS NULL OR occ_ms = 0 THEN NULL
           WHEN occ_hour_text IS NULL THEN timezone('UTC', make_timestamptz(occ_ms * 1000))
           ELSE timezone('UTC', timezone('{TZ}', date_trunc('day', timezone('{TZ}',
                make_timestamptz(occ_ms * 1000))) + to_hours(CAST(occ_hour_text AS INTEGER))))
      END AS occ_utc,
      CASE WHEN lat0 IS NULL OR lon0 IS NULL OR (lat0 = 0 AND lon0 = 0) THEN NULL ELSE lat0 END AS lat,
      CASE WHEN lat0 IS NULL OR lon0 IS NULL OR (lat0 = 0 AND lon0 = 0) THEN NULL ELSE lon0 END AS lon
    FROM incidents_src s"""),
    # Normalised batch: every feature with an id.
    ("batch", """
    SELECT *, event_unique_id AS event_id FROM incidents_occ
    WHERE coalesce(event_unique_id, '') <> ''"""),
    # raw_incidents: last feature per key wins.
    ("raw", f"""
    SELECT * EXCLUDE (rn), {LOAD_TIME} AS inserted_at FROM (
      SELECT b.*, row_number() OVER (PARTITION BY event_id ORDER BY doc_day DESC, page DESC, pos DESC) AS rn
      FROM batch b) WHERE rn = 1"""),
    ("wx_days", f"""
    SELECT DISTINCT round({_LAT}, 2) AS lat, round({_LON}, 2) AS lon, CAST(ts AS DATE) AS day
    FROM events"""),
    ("wx_hours", """
    SELECT lat, lon, hour_utc,
      CAST(lat * 100 AS INTEGER) + day(hour_utc) AS k,
      CAST(lat * 100 AS INTEGER) + day(hour_utc) * 24 + hour(hour_utc) AS m
    FROM (SELECT lat, lon, CAST(day AS TIMESTAMP) + to_hours(CAST(h AS INTEGER)) AS hour_utc
          FROM wx_days, range(24) t(h))"""),
    ("weather_src", """
    SELECT CAST(lat AS DECIMAL(8,5)) AS lat, CAST(lon AS DECIMAL(8,5)) AS lon, hour_utc,
      CAST(hour_utc AS DATE) AS date_utc, m,
      CAST((m % 400 - 150) / 10 AS REAL) AS temperature,
      CAST((m % 7) / 10 AS REAL) AS precipitation,
      CAST((m % 50) / 10000 AS REAL) AS snowfall,
      CASE WHEN m % 13 = 0 THEN NULL ELSE CAST(m % 100 AS INTEGER) END AS weathercode,
      CAST((m % 300) / 10 AS REAL) AS windspeed,
      CAST(m % 101 AS REAL) AS cloudcover,
      CAST(30 + (m % 700) / 10 AS REAL) AS humidity
    FROM wx_hours WHERE k % 6 <> 0 AND m % 11 <> 0"""),
    ("stg", """
    SELECT
      event_id, objectid, event_unique_id,
      occ_ms // 1000 AS occ_date_epoch,
      make_timestamp((occ_ms // 1000) * 1000000) AS occ_date,
      occ_month, occ_dow, occ_year,
      CAST(occ_hour_text AS INTEGER) AS occ_hour,
      division, hood_158, neighbourhood_158,
      coalesce(fatalities_raw, 0) AS fatalities,
      CASE injury_text WHEN 'YES' THEN true WHEN 'NO' THEN false END AS injury_collisions,
      CASE ftr_text WHEN 'YES' THEN true WHEN 'NO' THEN false END AS ftr_collisions,
      CASE pd_text WHEN 'YES' THEN true WHEN 'NO' THEN false END AS pd_collisions,
      lon0 AS long_wgs84, lat0 AS lat_wgs84,
      CASE automobile_text WHEN 'YES' THEN true WHEN 'NO' THEN false END AS automobile,
      CASE motorcycle_text WHEN 'YES' THEN true WHEN 'NO' THEN false END AS motorcycle,
      CASE passenger_text WHEN 'YES' THEN true WHEN 'NO' THEN false END AS passenger,
      CASE bicycle_text WHEN 'YES' THEN true WHEN 'NO' THEN false END AS bicycle,
      CASE pedestrian_text WHEN 'YES' THEN true WHEN 'NO' THEN false END AS pedestrian,
      lon0 AS geometry_x, lat0 AS geometry_y,
      occ_utc AS occ_date_utc, lat, lon, inserted_at
    FROM raw"""),
    ("prep", f"""
    SELECT * EXCLUDE (rank),
      round(lat, 2) AS lat_r, round(lon, 2) AS lon_r,
      {_INVALID} AS invalid_coord_flag,
      {_SEVERITY_LABELS}[rank] AS collision_severity,
      rank AS collision_severity_rank,
      date_trunc('day', occ_date) AS occ_date_day,
      coalesce(isodow(occ_date) >= 6, false) AS is_weekend,
      {season_case('occ_date')} AS season
    FROM (SELECT *, {_RANK} AS rank FROM stg)"""),
    ("enriched", f"""
    SELECT p.*, wc.temperature, wc.precipitation, wc.snowfall, wc.weathercode, wc.windspeed,
      wc.cloudcover, wc.humidity,
      {weather_case('wc.weathercode')} AS weather_condition
    FROM prep p LEFT JOIN weather_src wc
      ON wc.lat = p.lat_r AND wc.lon = p.lon_r AND wc.hour_utc = p.occ_date_utc"""),
    ("mart", f"""
    SELECT event_id, occ_date_utc, occ_date_day, occ_year, occ_month,
      occ_dow AS day_of_week, occ_hour AS hour_of_day, is_weekend, season,
      {daypart_case('occ_hour')} AS daypart,
      division, hood_158 AS tps_hood_code, neighbourhood_158, lat, lon, invalid_coord_flag,
      collision_severity, collision_severity_rank, fatalities, injury_collisions, ftr_collisions,
      pd_collisions, automobile, motorcycle, passenger, bicycle, pedestrian,
      temperature, precipitation, snowfall, weathercode, weather_condition, windspeed,
      cloudcover, humidity, inserted_at
    FROM enriched"""),
]


def with_ctes(select: str, extra: list[tuple[str, str]] | None = None) -> str:
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in CTES + list(extra or []))
    return f"WITH {body}\n{select}"


def portable(columns: dict[str, str]) -> str:
    """Select list casting decimals/reals to DOUBLE, as the Spark side does."""
    out = []
    for name, kind in columns.items():
        if kind == "double":
            out.append(f"CAST({name} AS DOUBLE) AS {name}")
        else:
            out.append(name)
    return ", ".join(out)


MART_DOUBLES = ["lat", "lon", "temperature", "precipitation", "snowfall", "windspeed",
                "cloudcover", "humidity"]


def _d(cols: list[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


def _all_but(table: str, doubles: list[str]) -> str:
    return f"SELECT * EXCLUDE ({', '.join(doubles)}), {_d(doubles)} FROM {table}"


STG_DOUBLES = ["long_wgs84", "lat_wgs84", "geometry_x", "geometry_y", "lat", "lon"]
INT_DOUBLES = STG_DOUBLES + ["lat_r", "lon_r", "temperature", "precipitation", "snowfall",
                             "windspeed", "cloudcover", "humidity"]
_HAS_ID = "coalesce(event_unique_id, '') <> ''"
_USABLE = "(lat0 IS NOT NULL AND lon0 IS NOT NULL AND NOT (lat0 = 0 AND lon0 = 0))"


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    # models
    q["stg_incidents"] = with_ctes(_all_but("stg", STG_DOUBLES))
    q["join_weather_left"] = with_ctes(
        "SELECT event_id, CAST(lat_r AS DOUBLE) AS lat_r, CAST(lon_r AS DOUBLE) AS lon_r, "
        "occ_date_utc, CAST(temperature AS DOUBLE) AS temperature, weathercode, "
        "weather_condition, temperature IS NOT NULL AS matched FROM enriched")
    q["int_enriched"] = with_ctes(_all_but("enriched", INT_DOUBLES))
    q["fct_flat"] = with_ctes(_all_but("mart", MART_DOUBLES))
    # ingest
    q["ingest_normalise"] = with_ctes(
        f"SELECT doc_day, page, pos, event_id, objectid, occ_utc AS occ_date_utc, {_d(['lat', 'lon'])}, "
        f"{LOAD_TIME} AS inserted_at FROM batch")
    q["ingest_counts"] = with_ctes(
        f"SELECT doc_day, count(*) AS n_features, "
        f"count(*) FILTER (WHERE {_HAS_ID}) AS n_upserted, "
        f"count(*) FILTER (WHERE NOT ({_HAS_ID})) AS n_skipped_no_id, "
        f"count(*) FILTER (WHERE {_HAS_ID} AND NOT {_USABLE}) AS n_null_coords, "
        f"count(*) FILTER (WHERE {_HAS_ID} AND (occ_ms IS NULL OR occ_ms = 0)) AS n_no_date, "
        f"count(DISTINCT CASE WHEN {_HAS_ID} THEN event_unique_id END) AS n_distinct_keys, "
        f"count(*) >= 1000 AS possibly_truncated "
        f"FROM incidents_src GROUP BY doc_day")
    q["ingest_high_water_mark"] = with_ctes(
        f"SELECT max(occ_utc) AS max_occ_date_utc, count(*) AS n_rows, "
        f"coalesce(CAST({utc_to_local('max(occ_utc)')} AS DATE) + 1, DATE '2024-01-01') "
        f"AS next_local_day FROM raw")
    lo = local_to_utc("TIMESTAMP '2024-01-08 00:00:00'")
    hi = local_to_utc("TIMESTAMP '2024-01-15 00:00:00'")
    q["filter_day_slice"] = with_ctes(
        f"SELECT event_id, occ_utc AS occ_date_utc, {_d(['lat', 'lon'])} FROM raw "
        f"WHERE occ_utc >= {lo} AND occ_utc < {hi}")
    # scalar expressions
    q["json_extract"] = (
        "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, "
        "json_extract_string(props, '$.k') AS k_text, CAST(json(props) AS VARCHAR) AS props_json "
        "FROM events")
    q["time_epoch"] = with_ctes(
        "SELECT pos, occ_ms, occ_ms // 1000 AS occ_date_epoch, "
        "make_timestamp((occ_ms // 1000) * 1000000) AS occ_date FROM incidents_src")
    q["time_local_to_utc"] = with_ctes(
        f"SELECT pos, occ_ms, CAST(occ_hour_text AS INTEGER) AS occ_hour, occ_utc AS occ_date_utc, "
        f"CAST((epoch({utc_to_local('occ_utc')}) - epoch(occ_utc)) / 3600 AS INTEGER) "
        f"AS utc_offset_hours FROM incidents_occ")
    q["time_dst_spine"] = (
        f"SELECT local_date, CAST(h AS INTEGER) AS hour, "
        f"{local_to_utc('CAST(local_date AS TIMESTAMP) + to_hours(CAST(h AS INTEGER))')} AS utc "
        f"FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS local_date FROM orders), range(24) t(h)")
    q["coords_null_rule"] = with_ctes(
        f"SELECT pos, {_d(['lat0', 'lon0', 'lat', 'lon'])} FROM incidents_occ")
    q["coords_round"] = with_ctes(
        "SELECT pos, CAST(round(lat0, 2) AS DOUBLE) AS lat_r, CAST(round(lon0, 2) AS DOUBLE) AS lon_r "
        "FROM incidents_src")
    q["coords_validity"] = with_ctes(f"SELECT pos, {_INVALID} AS invalid_coord_flag FROM incidents_occ")
    q["flags_yes_no"] = with_ctes(
        "SELECT pos, " + ", ".join(f"{yes_no_case(t)} AS {n}" for n, t in [
            ("injury_collisions", "injury_text"), ("ftr_collisions", "ftr_text"),
            ("pd_collisions", "pd_text"), ("automobile", "automobile_text"),
            ("motorcycle", "motorcycle_text"), ("passenger", "passenger_text"),
            ("bicycle", "bicycle_text"), ("pedestrian", "pedestrian_text")])
        + " FROM incidents_src")
    q["calendar_fields"] = (
        f"SELECT o_orderkey, date_trunc('day', o_orderdate) AS occ_date_day, "
        f"coalesce(isodow(o_orderdate) >= 6, false) AS is_weekend, "
        f"{season_case('o_orderdate')} AS season FROM orders")
    q["classify_severity"] = with_ctes(
        "SELECT event_id, fatalities, injury_collisions, ftr_collisions, pd_collisions, "
        "collision_severity, collision_severity_rank FROM prep")
    q["classify_weather"] = with_ctes(
        f"SELECT {_d(['lat', 'lon'])}, hour_utc, weathercode, {weather_case('weathercode')} "
        f"AS weather_condition FROM weather_src")
    q["classify_daypart"] = with_ctes(
        f"SELECT event_id, occ_hour, {daypart_case('occ_hour')} AS daypart FROM stg")
    # upsert
    first = "pos % 10 <> 1 AND pos % 5 <> 3"
    last_wins = ("SELECT * EXCLUDE (rn) FROM (SELECT b.*, row_number() OVER (PARTITION BY event_id "
                 "ORDER BY doc_day DESC, page DESC, pos DESC) AS rn FROM batch b WHERE {w}) WHERE rn = 1")

    def pick(c):
        return f"CASE WHEN u.event_id IS NOT NULL THEN u.{c} ELSE t.{c} END"
    q["upsert_incidents_last_wins"] = with_ctes(
        f"SELECT coalesce(u.event_id, t.event_id) AS event_id, {pick('objectid')} AS objectid, "
        f"{pick('occ_utc')} AS occ_date_utc, CAST({pick('lat')} AS DOUBLE) AS lat, "
        f"CAST({pick('lon')} AS DOUBLE) AS lon, "
        f"CASE WHEN t.event_id IS NOT NULL THEN {LOAD_TIME} ELSE {UPDATE_LOAD_TIME} END AS inserted_at "
        f"FROM tgt t FULL OUTER JOIN upd u ON t.event_id = u.event_id",
        [("tgt", last_wins.format(w=first)), ("upd", last_wins.format(w=f"NOT ({first})"))])
    q["upsert_weather_hours"] = with_ctes(
        "SELECT CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, hour_utc, date_utc, "
        "CAST(CASE WHEN m % 5 = 0 THEN temperature + 2 WHEN day(hour_utc) % 3 <> 1 "
        "THEN temperature + 1 ELSE temperature END AS DOUBLE) AS temperature, "
        + _d(["precipitation", "snowfall"]) + ", weathercode, "
        + _d(["windspeed", "cloudcover", "humidity"]) + " FROM weather_src")
    # gaps
    gap_ctes = [
        ("cd", "SELECT DISTINCT round(lat, 2) AS lat_r, round(lon, 2) AS lon_r, "
               "CAST(occ_utc AS DATE) AS day_utc FROM raw WHERE lat IS NOT NULL AND lon IS NOT NULL "
               "AND NOT (lat = 0 AND lon = 0) AND occ_utc IS NOT NULL"),
        ("missing", "SELECT lat_r, lon_r, day_utc FROM cd WHERE NOT EXISTS (SELECT 1 FROM weather_src wc "
                    "WHERE wc.lat = cd.lat_r AND wc.lon = cd.lon_r AND CAST(wc.hour_utc AS DATE) = cd.day_utc)"),
        ("islands", "SELECT *, day_utc - CAST(row_number() OVER (PARTITION BY lat_r, lon_r "
                    "ORDER BY day_utc) AS INTEGER) AS run FROM missing"),
    ]
    q["gap_missing_days_anti"] = with_ctes(
        "SELECT CAST(lat_r AS DOUBLE) AS lat_r, CAST(lon_r AS DOUBLE) AS lon_r, day_utc FROM missing",
        gap_ctes)
    ranges = ("SELECT CAST(lat_r AS DOUBLE) AS lat_r, CAST(lon_r AS DOUBLE) AS lon_r, "
              "min(day_utc) AS start_date, max(day_utc) AS end_date, count(*) AS missing_days "
              "FROM {t} GROUP BY {g} ORDER BY 1, 2, 3")
    q["gap_missing_ranges"] = with_ctes(ranges.format(t="missing", g="lat_r, lon_r"), gap_ctes)
    q["gap_missing_islands"] = with_ctes(ranges.format(t="islands", g="lat_r, lon_r, run"), gap_ctes)
    # plans
    d0 = "strftime(local_day, '%Y-%m-%d')"
    d1 = "strftime(local_day + 1, '%Y-%m-%d')"
    quote = "''''"
    where = (f"'OCC_DATE >= TIMESTAMP ' || {quote} || {d0} || ' 00:00:00' || {quote} || "
             f"' AND OCC_DATE < TIMESTAMP ' || {quote} || {d1} || ' 00:00:00' || {quote}")
    url = (f"'{INCIDENT_BASE_URL}?where=OCC_DATE%20%3E%3D%20TIMESTAMP%20%27' || {d0} || "
           f"'%2000%3A00%3A00%27%20AND%20OCC_DATE%20%3C%20TIMESTAMP%20%27' || {d1} || "
           f"'%2000%3A00%3A00%27&outFields=%2A&f=json&resultRecordCount={INCIDENT_PAGE_SIZE}"
           f"&resultOffset=' || CAST(page * {INCIDENT_PAGE_SIZE} AS VARCHAR)")
    q["plan_incident_days"] = with_ctes(
        f"SELECT local_day, {where} AS where_clause, {url} AS url, n_landed, n_landed >= {INCIDENT_PAGE_SIZE} "
        f"AS possibly_truncated, page FROM (SELECT days.local_day, coalesce(landed.n, 0) AS n_landed, "
        f"unnest(range(coalesce(landed.n, 0) // {INCIDENT_PAGE_SIZE} + 1)) AS page "
        f"FROM days LEFT JOIN landed ON days.local_day = landed.doc_day)",
        [("landed", "SELECT doc_day, count(*) AS n FROM incidents_src GROUP BY doc_day"),
         ("bounds", "SELECT min(doc_day) AS s FROM incidents_src"),
         ("days", "SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), "
                  "CAST(date_trunc('quarter', s) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS TIMESTAMP), "
                  "INTERVAL 1 DAY)) AS DATE) AS local_day FROM bounds")])
    wurl = (f"'{WEATHER_BASE_URL}?latitude=' || CAST(CAST(lat_r AS DOUBLE) AS VARCHAR) || "
            f"'&longitude=' || CAST(CAST(lon_r AS DOUBLE) AS VARCHAR) || '&start_date=' || "
            f"strftime(min(day_utc), '%Y-%m-%d') || '&end_date=' || strftime(max(day_utc), '%Y-%m-%d') "
            f"|| '&hourly={WEATHER_HOURLY_VARS}&timezone=UTC'")
    q["plan_weather_ranges"] = with_ctes(
        f"SELECT CAST(lat_r AS DOUBLE) AS lat_r, CAST(lon_r AS DOUBLE) AS lon_r, "
        f"min(day_utc) AS start_date, max(day_utc) AS end_date, count(*) AS missing_days, "
        f"{wurl} AS url FROM missing GROUP BY lat_r, lon_r", gap_ctes)
    point = wurl.replace("min(day_utc)", "day").replace("max(day_utc)", "day")
    q["plan_weather_force"] = with_ctes(
        f"SELECT CAST(lat_r AS DOUBLE) AS lat_r, CAST(lon_r AS DOUBLE) AS lon_r, day AS start_date, day AS end_date, "
        f"{point} AS url FROM (SELECT DISTINCT round(lat0, 2) AS lat_r, round(lon0, 2) AS lon_r, doc_day AS day "
        f"FROM incidents_src WHERE lat0 IS NOT NULL AND lon0 IS NOT NULL AND lat0 <> 0)")
    # run log (C4 in SQL)
    runs = ("SELECT 'run-' || CAST(event_id AS VARCHAR) AS run_id, event_type AS pipeline_name, "
            "timezone('UTC', ts) AS start_time_tz, ts AS start_time, "
            "CASE WHEN event_id % 29 = 0 THEN NULL ELSE ts + to_seconds(event_id % 3600) END AS end_time, "
            "CASE WHEN event_id % 29 = 0 THEN 'running' WHEN event_id % 13 = 0 THEN 'failure' "
            "ELSE 'success' END AS status, "
            "CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(floor(value) AS INTEGER) END AS row_count, "
            "CASE WHEN event_id % 7 = 0 THEN 'scheduled' ELSE 'manual' END AS triggered_by, "
            "CASE WHEN event_id % 13 = 0 AND event_id % 29 <> 0 THEN 'error in run ' || "
            "CAST(event_id AS VARCHAR) END AS error_message, "
            "CASE WHEN event_id % 29 = 0 THEN NULL ELSE event_id % 3600 END AS duration_s FROM events")
    q["run_log_summary"] = with_ctes(
        "SELECT pipeline_name, count(*) AS n_runs, "
        "count(*) FILTER (WHERE status = 'success') AS n_success, "
        "count(*) FILTER (WHERE status = 'failure') AS n_failure, "
        "count(*) FILTER (WHERE status = 'running') AS n_running, "
        "CAST(sum(CASE WHEN status = 'success' THEN row_count END) AS BIGINT) AS rows_success, "
        "CAST(sum(duration_s) AS BIGINT) AS total_duration_s, max(duration_s) AS max_duration_s "
        "FROM runs GROUP BY pipeline_name", [("runs", runs)])
    q["run_log_latest"] = with_ctes(
        "SELECT pipeline_name, run_id, start_time, end_time, status, row_count, triggered_by, "
        "error_message, duration_s FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_name "
        "ORDER BY start_time DESC, run_id DESC) AS rn FROM runs) WHERE rn = 1", [("runs", runs)])
    # data quality
    def chk(model, check, column, failures_sql):
        return (f"SELECT '{model}' AS model, '{check}' AS \"check\", '{column}' AS \"column\", "
                f"CAST(f AS BIGINT) AS failures, f = 0 AS passed FROM ({failures_sql})")
    parts = []
    for model, table in (("stg_tps_incidents", "stg"), ("int_enriched_incidents", "enriched"),
                         ("fct_incidents_flat", "mart")):
        parts.append(chk(model, "not_null", "event_id",
                         f"SELECT count(*) FILTER (WHERE event_id IS NULL) AS f FROM {table}"))
        parts.append(chk(model, "unique", "event_id",
                         f"SELECT count(*) AS f FROM (SELECT event_id FROM {table} GROUP BY event_id "
                         f"HAVING count(*) > 1)"))
    parts.append(chk("fct_incidents_flat", "non_empty", "*",
                     "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS f FROM mart"))
    parts.append(chk("fct_incidents_flat", "has_column", "event_id", "SELECT 0 AS f"))
    for c in ("lat", "lon", "hour_utc"):
        parts.append(chk("weather_cache", "not_null", c,
                         f"SELECT count(*) FILTER (WHERE {c} IS NULL) AS f FROM weather_src"))
    parts.append(chk("weather_cache", "unique", "lat,lon,hour_utc",
                     "SELECT count(*) AS f FROM (SELECT lat, lon, hour_utc FROM weather_src "
                     "GROUP BY ALL HAVING count(*) > 1)"))
    parts.append(chk("run_log", "accepted_values", "status",
                     "SELECT count(*) FILTER (WHERE NOT coalesce(status IN ('running', 'success', "
                     "'failure'), false)) AS f FROM runs"))
    q["dq_report"] = with_ctes(" UNION ALL ".join(parts), [("runs", runs)])
    # export
    bools = ["is_weekend", "invalid_coord_flag", "injury_collisions", "ftr_collisions",
             "pd_collisions", "automobile", "motorcycle", "passenger", "bicycle", "pedestrian"]
    ints = ["occ_year", "hour_of_day", "collision_severity_rank", "fatalities", "weathercode"]
    cols = []
    for c in ["event_id", "occ_date_utc", "occ_date_day", "occ_year", "occ_month", "day_of_week",
              "hour_of_day", "is_weekend", "season", "daypart", "division", "tps_hood_code",
              "neighbourhood_158", "lat", "lon", "invalid_coord_flag", "collision_severity",
              "collision_severity_rank", "fatalities", "injury_collisions", "ftr_collisions",
              "pd_collisions", "automobile", "motorcycle", "passenger", "bicycle", "pedestrian",
              "temperature", "precipitation", "snowfall", "weathercode", "weather_condition",
              "windspeed", "cloudcover", "humidity", "inserted_at"]:
        if c in bools:
            cols.append(f"CASE WHEN {c} THEN 'True' WHEN NOT {c} THEN 'False' END AS {c}")
        elif c in ("occ_date_utc", "inserted_at"):
            cols.append(f"strftime({c}, '%Y-%m-%d %H:%M:%S') || '+00:00' AS {c}")
        elif c == "occ_date_day":
            cols.append(f"strftime({c}, '%Y-%m-%d') AS {c}")
        elif c in ints:
            cols.append(f"CAST({c} AS VARCHAR) AS {c}")
        elif c in ("lat", "lon"):
            cols.append(f"CAST(CAST({c} AS DOUBLE) AS VARCHAR) AS {c}")
        elif c in MART_DOUBLES:      # 32-bit numbers print as such
            cols.append(f"CAST({c} AS VARCHAR) AS {c}")
        else:
            cols.append(c)
    q["export_mart_rows"] = with_ctes(f"SELECT {', '.join(cols)} FROM mart")
    q["export_csv_roundtrip"] = q["fct_flat"]
    q["export_one_file"] = q["fct_flat"]
    # landed documents
    feat = ("SELECT doc_day, page, page * 1000 + CAST(row_number() OVER (PARTITION BY doc_day, page "
            "ORDER BY pos) - 1 AS BIGINT) AS pos, event_unique_id, objectid, occ_ms, occ_hour_text AS occ_hour, "
            "CAST(lat0 AS DOUBLE) AS lat0, CAST(lon0 AS DOUBLE) AS lon0 FROM incidents_src")
    q["src_incident_documents"] = with_ctes(feat)
    q["src_partition_pruned_scan"] = with_ctes(
        f"SELECT * FROM ({feat}) WHERE doc_day BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'")
    q["src_weather_documents"] = with_ctes(
        "SELECT CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, hour_utc, date_utc, "
        + _d(["temperature", "precipitation", "snowfall"]) + ", weathercode, "
        + _d(["windspeed", "cloudcover", "humidity"]) + " FROM weather_src WHERE m % 17 <> 0")
    q["stream_ingest_equals_batch"] = with_ctes(
        f"SELECT event_id, objectid, occ_utc AS occ_date_utc, {_d(['lat', 'lon'])} FROM raw")
    # the stored path
    q["ingest_rejects"] = with_ctes(
        "SELECT doc_day, CASE WHEN day(doc_day) % 3 = 1 THEN 0 ELSE n END AS n_accepted, "
        "CASE WHEN day(doc_day) % 3 = 1 THEN n ELSE 0 END AS n_unparsable, CAST(0 AS BIGINT) AS n_no_features "
        "FROM (SELECT doc_day, count(DISTINCT page) AS n FROM incidents_src GROUP BY doc_day)")
    q["upsert_stored_reland"] = with_ctes(
        "SELECT event_id, objectid, fatalities FROM (SELECT *, row_number() OVER (PARTITION BY event_id "
        "ORDER BY load DESC, doc_day DESC, page DESC, pos DESC) AS rn FROM loads) WHERE rn = 1",
        [("loads", "SELECT 1 AS load, event_id, objectid, doc_day, page, pos, coalesce(fatalities_raw, 0) AS fatalities FROM batch "
                   "UNION ALL SELECT 2, b.event_id, b.objectid, b.doc_day, b.page, b.pos, "
                   "CASE WHEN e.event_type = 'error' AND e.value + 100 > 20 THEN 1 ELSE 0 END "
                   "FROM batch b JOIN events e ON e.event_id = b.pos WHERE day(b.doc_day) % 2 = 0 AND b.pos % 4 <> 0")])
    q["upsert_stored_weather"] = with_ctes(
        "SELECT CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, hour_utc, date_utc, "
        "CAST(CASE WHEN day(hour_utc) % 2 = 0 THEN CAST(temperature + 1 AS REAL) ELSE temperature END AS DOUBLE) AS temperature, "
        + _d(["precipitation", "snowfall"]) + ", weathercode, " + _d(["windspeed", "cloudcover", "humidity"]) + " FROM weather_src")
    q["jobs_mart"] = with_ctes(f"SELECT * EXCLUDE (inserted_at) FROM ({_all_but('mart', MART_DOUBLES)})")
    q["run_log_lifecycle"] = with_ctes(
        "SELECT 'tps_ingest' AS pipeline_name, 'success' AS status, CAST(count(*) AS INTEGER) AS row_count, 'manual' AS triggered_by, "
        "true AS ended, false AS has_message FROM batch "
        "UNION ALL SELECT 'weather_cache', 'success', CAST(count(*) AS INTEGER), 'manual', true, false FROM weather_src "
        "UNION ALL SELECT 'build_models', 'success', 0, 'manual', true, false "
        "UNION ALL SELECT 'tps_ingest', 'failure', 0, 'check', true, true")
    bad = "day(doc_day) % 5 = 2 AND pos % 50 = 3 AND occ_ms IS NOT NULL AND occ_ms <> 0"
    day_ctes = [("days", f"SELECT doc_day, count(*) AS n_rows, count(*) FILTER (WHERE {bad}) AS n_bad FROM batch GROUP BY doc_day"),
                ("held", "SELECT doc_day, count(*) AS stored FROM (SELECT b.doc_day, row_number() OVER (PARTITION BY b.event_id "
                         "ORDER BY b.doc_day DESC, b.page DESC, b.pos DESC) AS rn FROM batch b JOIN days USING (doc_day) WHERE n_bad = 0) "
                         "WHERE rn = 1 GROUP BY doc_day")]
    q["ingest_bad_day"] = with_ctes(
        "SELECT doc_day, CASE WHEN n_bad > 0 THEN 'failed' ELSE 'stored' END AS status, n_rows, n_bad, "
        "CASE WHEN n_bad > 0 THEN 'OCC_HOUR' END AS reason, coalesce(stored, 0) AS stored FROM days LEFT JOIN held USING (doc_day)", day_ctes)
    q["ingest_bad_day_repaired"] = with_ctes(
        "SELECT event_id, objectid, occ_utc AS occ_date_utc FROM (SELECT b.*, row_number() OVER (PARTITION BY event_id "
        "ORDER BY n_bad > 0 DESC, b.doc_day DESC, page DESC, pos DESC) AS rn FROM batch b JOIN days USING (doc_day)) WHERE rn = 1", day_ctes)
    kept = "hour(hour_utc) % 12 <> 5"
    q["upsert_null_keys"] = with_ctes(
        f"SELECT 'drop' AS way, 'success' AS status, false AS names_column, count(*) FILTER (WHERE {kept}) AS rows_upserted, "
        f"count(*) FILTER (WHERE {kept}) AS distinct_keys, count(*) FILTER (WHERE NOT ({kept})) AS null_keys, "
        f"count(*) FILTER (WHERE {kept}) AS stored FROM weather_src UNION ALL SELECT 'error', 'failure', true, 0, 0, 0, 0")
    q["stream_rejects"] = with_ctes(
        "SELECT doc_day, 'unparsable' AS reason, count(DISTINCT page) AS n FROM incidents_src WHERE day(doc_day) % 3 = 1 GROUP BY doc_day "
        f"UNION ALL SELECT doc_day, 'OCC_HOUR', count(*) FROM batch WHERE day(doc_day) % 3 <> 1 AND {bad} GROUP BY doc_day")
    q["backfill_incremental"] = with_ctes(
        "SELECT 'success' AS status, CAST(count(*) AS INTEGER) AS row_count, false AS has_message, CAST(1 AS BIGINT) AS landing FROM weather_src "
        "UNION ALL SELECT 'success', CAST(count(*) FILTER (WHERE day(hour_utc) % 2 = 0) AS INTEGER), false, 2 FROM weather_src "
        "UNION ALL SELECT 'success', 0, false, NULL")
    faults = [("faulty", "SELECT CASE WHEN pos % 13 <> 0 THEN event_id END AS event_id FROM batch"),
              ("states", "SELECT CASE WHEN event_id % 17 = 0 THEN 'lost' WHEN event_id % 19 <> 0 THEN status END AS status "
                         "FROM (SELECT event_id, CASE WHEN event_id % 29 = 0 THEN 'running' WHEN event_id % 13 = 0 "
                         "THEN 'failure' ELSE 'success' END AS status FROM events)")]
    q["dq_report_faults"] = with_ctes(" UNION ALL ".join([
        chk("batch", "not_null", "event_id", "SELECT count(*) FILTER (WHERE event_id IS NULL) AS f FROM faulty"),
        chk("batch", "unique", "event_id", "SELECT count(*) AS f FROM (SELECT event_id FROM faulty WHERE event_id IS NOT NULL "
                                           "GROUP BY event_id HAVING count(*) > 1)"),
        chk("run_log", "accepted_values", "status", "SELECT count(*) FILTER (WHERE NOT coalesce(status IN ('running', 'success', "
                                                    "'failure'), false)) AS f FROM states"),
        chk("empty", "non_empty", "*", "SELECT 1 AS f"), chk("batch", "has_column", "objectid", "SELECT 1 AS f")]), faults)
    return q
