"""The registered queries as plain SQL over the same tables, for DuckDB.

Written independently of the Spark side: same result, other formulation where one exists.
"""

from __future__ import annotations

from gridcast import spec

AS_OF = "DATE '2026-03-26'"
STAMP = "TIMESTAMP '2026-03-26 12:00:00'"
EARLIER = "TIMESTAMP '2026-03-25 12:00:00'"

ORD = "src_ord, src_id, src_seq, src_part, src_supp, src_qty, src_tax"
ORD_DESC = ", ".join(f"{c} DESC" for c in ORD.split(", "))

# ----------------------------------------------------------------- inputs

BASE = """base AS (
  SELECT d.src_ord, l_orderkey AS src_id, l_linenumber AS src_seq, l_partkey AS src_part, l_suppkey AS src_supp,
    l_quantity AS src_qty, l_tax AS src_tax, l_discount AS src_disc,
    CAST(l_suppkey % 3 AS INTEGER) AS model_no,
    CASE WHEN l_quantity = 50 THEN CAST(-538099 AS DOUBLE)
         ELSE CAST(25 AS DOUBLE) + CAST(l_partkey % 96 AS DOUBLE) * CAST(0.25 AS DOUBLE) END AS latitude,
    CASE WHEN l_discount = CAST(0 AS DOUBLE) THEN CAST(NULL AS DOUBLE)
         ELSE CAST(235 AS DOUBLE) + CAST(l_orderkey % 224 AS DOUBLE) * CAST(0.25 AS DOUBLE) END AS longitude_360,
    CAST(DATE '2026-03-20' + CAST(l_linenumber % 7 AS INTEGER) AS DATE) AS frt_date,
    CAST(CAST(l_quantity AS INTEGER) % 4 AS INTEGER) AS cycle_no,
    CAST(l_suppkey % 4 AS INTEGER) AS step_no,
    CAST(l_orderkey % 3 AS INTEGER) AS level_no
  FROM lineitem
  CROSS JOIN (SELECT 0 AS src_ord UNION ALL SELECT 1 AS src_ord) d
  WHERE d.src_ord = 0 OR l_orderkey % 50 = 0
)"""

_INDEX = (
    "CAST(round_even((CAST({0} AS FLOAT) + CAST({1} AS FLOAT)) * CAST(1000 AS FLOAT), 0) AS INTEGER)"
)

PLACED = f"""placed AS (
  SELECT *, CASE model_no WHEN 0 THEN 'gfs' WHEN 1 THEN 'aifs' ELSE 'ifs' END AS model,
    CASE WHEN longitude_360 >= 180 THEN longitude_360 - 360 ELSE longitude_360 END AS longitude,
    CASE WHEN model_no = 2 THEN 12 * (cycle_no % 2) ELSE 6 * cycle_no END AS usual_cycle,
    12 * (cycle_no % 2) AS spread_cycle,
    CASE step_no WHEN 0 THEN 192 WHEN 1 THEN 240 WHEN 2 THEN 288 ELSE 360 END AS usual_step,
    CASE WHEN step_no < 2 THEN 240 ELSE 360 END AS spread_step,
    CAST(frt_date AS VARCHAR) AS forecast_date
  FROM base
), indexed AS (
  SELECT *, {_INDEX.format("latitude", 90)} AS lat_i, {_INDEX.format("longitude", 180)} AS lon_i FROM placed
)"""


def _times(cycle: str, step: str) -> str:
    return f"""latitude, longitude,
    CAST(frt_date AS TIMESTAMP) + {cycle} * INTERVAL '1' HOUR AS forecast_reference_time,
    CAST(frt_date AS TIMESTAMP) + ({cycle} + {step}) * INTERVAL '1' HOUR AS valid_time,
    CAST({step} AS INTEGER) AS step_hours, lat_i, lon_i"""


RAW_UPPER = f"""raw_upper AS (
  SELECT model, {ORD}, src_disc, longitude_360, {_times("usual_cycle", "usual_step")},
    CAST(CASE level_no WHEN 0 THEN 250 WHEN 1 THEN 500 ELSE 850 END AS INTEGER) AS "isobaricInhPa",
    CASE WHEN src_tax = CAST(0 AS DOUBLE) THEN CAST(NULL AS FLOAT)
         ELSE CAST(4800 + src_part % 1200 + src_ord AS FLOAT) END AS gh,
    CAST(230 + src_qty AS FLOAT) AS t,
    CAST(src_supp % 120 - 60 AS FLOAT) AS u,
    CAST(src_part % 90 - 45 AS FLOAT) AS v,
    forecast_date, CAST(usual_cycle AS INTEGER) AS forecast_cycle
  FROM indexed
)"""
RAW_SURFACE = f"""raw_surface AS (
  SELECT model, model_no, {ORD}, longitude_360, {_times("usual_cycle", "usual_step")},
    CAST(250 + src_qty AS FLOAT) AS t2m,
    CAST(240 + src_qty AS FLOAT) AS d2m,
    CASE WHEN src_tax = CAST(0 AS DOUBLE) THEN CAST(NULL AS FLOAT)
         ELSE CAST(98000 + src_part % 6000 + src_ord AS FLOAT) END AS msl,
    CAST(src_disc AS FLOAT) AS tp,
    CAST(2 AS DOUBLE) AS "heightAboveGround",
    CAST(0 AS DOUBLE) AS surface,
    forecast_date, CAST(usual_cycle AS INTEGER) AS forecast_cycle
  FROM indexed
)"""
RAW_SPREAD = f"""raw_spread AS (
  SELECT model, {ORD}, {_times("spread_cycle", "spread_step")},
    CAST(CASE WHEN level_no = 0 THEN 500 ELSE 850 END AS INTEGER) AS "isobaricInhPa",
    CAST(src_qty AS FLOAT) AS gh,
    CAST(src_seq AS FLOAT) AS t,
    forecast_date, CAST(spread_cycle AS INTEGER) AS forecast_cycle
  FROM indexed WHERE model IN ('aifs', 'ifs')
)"""
INPUTS = ",\n".join([BASE, PLACED, RAW_UPPER, RAW_SURFACE, RAW_SPREAD])

_Q = {"isobaricInhPa": '"isobaricInhPa"', "heightAboveGround": '"heightAboveGround"'}
COLS = {s: ", ".join(_Q.get(n, n) for n in spec.raw_schema(s).names) for s in spec.SHAPES}
KEY_UPPER = 'forecast_date, forecast_cycle, step_hours, lat_i, lon_i, "isobaricInhPa"'


def _with(sql: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([INPUTS, *ctes]) + "\n" + sql


# ------------------------------------------------------- staging and facts

GUARD = "latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 360"
ZERO_C = "CAST(273.15 AS FLOAT)"
_STAGE_METRICS = {
    "upper": f'''CAST("isobaricInhPa" AS INTEGER) AS pressure_level_hpa, gh AS geopotential_height_m, t AS temp_kelvin,
    t - {ZERO_C} AS temp_celsius, u AS u_wind_m_s, v AS v_wind_m_s''',
    "surface": f'''t2m AS temp_2m_kelvin, t2m - {ZERO_C} AS temp_2m_celsius, d2m AS dewpoint_2m_kelvin,
    d2m - {ZERO_C} AS dewpoint_2m_celsius, msl / CAST(100 AS FLOAT) AS msl_pressure_hpa, tp AS total_precipitation_m,
    "heightAboveGround" AS height_above_ground_metadata, surface AS surface_type_metadata''',
    "spread": f'''CAST("isobaricInhPa" AS INTEGER) AS pressure_level_hpa, t AS temp_spread_kelvin,
    t - {ZERO_C} AS temp_spread_celsius, gh AS geopotential_height_spread_m''',
}


def _stage(shape: str, model: str, where: str = "TRUE", wide: bool = False, keep: str = "") -> str:
    degrees = "DOUBLE" if wide else "FLOAT"
    keep = f", {keep}" if keep else ""
    return f"""SELECT CAST(forecast_reference_time AS DATE) AS cycle_date,
    CAST(EXTRACT(HOUR FROM forecast_reference_time) AS INTEGER) AS cycle_hour,
    step_hours AS forecast_step_hours, CAST(valid_time AS DATE) AS valid_date,
    CAST(EXTRACT(HOUR FROM valid_time) AS INTEGER) AS valid_hour,
    CAST(latitude AS {degrees}) AS lat, CAST(longitude AS {degrees}) AS lon,
    COALESCE(CAST(ROUND((latitude + 90) * 1000) AS INTEGER), -1) AS lat_i,
    COALESCE(CAST(ROUND((longitude + 180) * 1000) AS INTEGER), -1) AS lon_i,
    {_STAGE_METRICS[shape]}{keep}
  FROM raw_{shape} WHERE model = '{model}' AND {GUARD} AND {where}"""


def _fact(shape: str, model: str, stamp: str = STAMP, where: str = "TRUE", keep: str = "") -> str:
    tail = f", {keep}" if keep else ""
    columns = [c for c in spec.fact_columns(shape) if c not in ("weather_model", "dbt_updated_at")]
    columns = [
        "total_precipitation_m * CAST(1000 AS FLOAT) AS total_precipitation_mm" if c == "total_precipitation_mm" else c
        for c in columns
    ]
    return f"""SELECT '{model}' AS weather_model, {", ".join(columns)}, {stamp} AS dbt_updated_at{tail}
  FROM ({_stage(shape, model, keep=keep)}) WHERE {where}"""


def _unified(shape: str) -> str:
    models = ("aifs", "ifs") if shape == "spread" else ("gfs", "aifs", "ifs")
    return "\nUNION ALL\n".join(_fact(shape, m) for m in models)


BOX = "latitude BETWEEN 30 AND 50 AND (longitude BETWEEN -125 AND -70 OR longitude BETWEEN 235 AND 290)"
RECENT = f"forecast_reference_time >= CAST({AS_OF} - 1 AS TIMESTAMP)"
CYCLE_TIME = "CAST(cycle_date AS TIMESTAMP) + cycle_hour * INTERVAL '1' HOUR"

# ----------------------------------------------------------------- stations

_CITY_VALUES = ",\n".join(
    "({}, {}, {}, {})".format(
        ", ".join(f"'{v}'" for v in (c[0], c[1], c[2])) + f", CAST({c[3]} AS DOUBLE), '{c[4]}', CAST({c[5]} AS DOUBLE), CAST({c[6]} AS DOUBLE)",
        spec.EAST_LIMITS.get(c[0], "CAST(NULL AS DOUBLE)"),
        spec.WEST_LIMITS.get(c[0], "CAST(NULL AS DOUBLE)"),
        "0",
    )
    for c in spec.CITIES
)
CITIES = f"""cities AS (
  SELECT * FROM (VALUES {_CITY_VALUES}) c(city_name, state, region, market_weight, associated_hub, latitude, longitude,
    east_limit, west_limit, unused)
)"""
CUSTOMER_CITIES = """cities AS (
  SELECT c_name AS city_name, 'N' || c_nationkey AS state, c_mktsegment AS region,
    CAST(c_custkey % 20 AS DOUBLE) / 16 AS market_weight, 'Hub ' || c_nationkey AS associated_hub,
    26 + CAST(c_custkey % 711 AS DOUBLE) / 32 AS latitude, -124 + CAST(c_custkey % 1637 AS DOUBLE) / 32 AS longitude,
    CASE WHEN c_nationkey = 3 THEN CAST(-100 AS DOUBLE) END AS east_limit,
    CASE WHEN c_nationkey = 7 THEN CAST(-90 AS DOUBLE) END AS west_limit
  FROM customer
)"""
STATIONS = """stations AS (
  SELECT city_name, state, region, market_weight, associated_hub,
    CAST(trunc((lat + 90) * 1000) AS INTEGER) AS lat_i, CAST(trunc((lon + 180) * 1000) AS INTEGER) AS lon_i, lat, lon
  FROM (
    SELECT c.*, round_even(latitude * 4, 0) / 4 + a.o AS lat, round_even(longitude * 4, 0) / 4 + b.o AS lon
    FROM cities c
    CROSS JOIN (VALUES (CAST(-0.25 AS DOUBLE)), (CAST(0 AS DOUBLE)), (CAST(0.25 AS DOUBLE))) a(o)
    CROSS JOIN (VALUES (CAST(-0.25 AS DOUBLE)), (CAST(0 AS DOUBLE)), (CAST(0.25 AS DOUBLE))) b(o)
  ) p
  WHERE COALESCE(lon <= east_limit, TRUE) AND COALESCE(lon >= west_limit, TRUE)
)"""
DIM = f"""dim AS (
  SELECT g.lat_i, g.lon_i, g.lat, g.lon, s.city_name, s.state, s.region, s.market_weight, s.associated_hub,
    s.city_name IS NOT NULL AS is_city
  FROM (SELECT DISTINCT lat_i, lon_i, lat, lon FROM ({_stage("upper", "gfs")})) g
  LEFT JOIN stations s ON g.lat_i = s.lat_i AND g.lon_i = s.lon_i
)"""


def _hash(shape: str, prefix: str = "", city: bool = False) -> str:
    parts = [f"CAST({prefix}{c} AS VARCHAR)" for c in spec.hash_key_columns(shape)] + (["city_name"] if city else [])
    return f"md5({' || chr(45) || '.join(parts)})"


def _city(shape: str, forecast: str, city: bool = False) -> str:
    return f"""SELECT {_hash(shape, "f.", city)} AS unique_key, f.*, d.city_name, d.state, d.region, d.market_weight,
  d.associated_hub
FROM ({forecast}) f JOIN dim d ON f.lat_i = d.lat_i AND f.lon_i = d.lon_i WHERE d.is_city"""


ORACLE: dict[str, str] = {}

# ---------------------------------------------------- scans, sources, sinks

ORACLE["raw_scan"] = _with(
    f"SELECT {COLS['upper']} FROM raw_upper WHERE forecast_date >= '2026-03-23'"
)
ORACLE["ext_scan"] = _with(f"SELECT {COLS['upper']} FROM raw_upper")
ORACLE["seed_load"] = f"WITH {CUSTOMER_CITIES}, {STATIONS} SELECT * FROM stations"
ORACLE["station_grid"] = ORACLE["seed_load"]
ORACLE["raw_append"] = _with(f"SELECT {COLS['surface']} FROM raw_surface")


def _replaced(untouched: str) -> str:
    pair = "((forecast_date = '2026-03-24' AND forecast_cycle = 6) OR (forecast_date = '2026-03-25' AND forecast_cycle = 12))"
    bumped = COLS["upper"].replace(" t,", " CAST(t + 1 AS FLOAT) AS t,")
    return _with(
        f"""SELECT {COLS['upper']} FROM raw_upper WHERE {untouched}
UNION ALL
SELECT {bumped} FROM raw_upper WHERE gh IS NOT NULL AND {pair}"""
    )


ORACLE["partition_replace"] = _replaced(
    "NOT ((forecast_date = '2026-03-24' AND forecast_cycle = 6) OR (forecast_date = '2026-03-25' AND forecast_cycle = 12))"
)
ORACLE["partition_replace_product"] = _replaced(
    "NOT (forecast_date IN ('2026-03-24', '2026-03-25') AND forecast_cycle IN (6, 12))"
)
ORACLE["parquet_export"] = _with(f"SELECT {COLS['spread']} FROM raw_spread")

_KEY_VALUES = ", ".join(f"('{k}')" for k in spec.INDEX_KEYS["upper"] + spec.INDEX_KEYS["surface"])
ORACLE["index_ranges"] = f"""WITH words AS (
  SELECT doc_id, n_chars, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS n
  FROM documents
), lines AS (
  SELECT 'doc' || doc_id AS file,
    CASE n_chars % 3 WHEN 0 THEN 240 WHEN 1 THEN 360 ELSE 0 END AS step, n,
    (n - 1) * 1000 + length(w) AS off,
    ':' || CASE length(w) % 6 WHEN 0 THEN 'HGT:500 mb' WHEN 1 THEN 'TMP:850 mb' WHEN 2 THEN 'UGRD:250 mb'
      WHEN 3 THEN 'APCP:surface' WHEN 4 THEN 'VGRD:250 mb' ELSE 'HGT:250 mb' END || ':' AS var,
    CASE length(w) % 4 WHEN 0 THEN '240 hour fcst' WHEN 1 THEN '192-240 hour acc fcst' WHEN 2 THEN '360 hour fcst'
      ELSE 'anl' END AS fc
  FROM words
), followed AS (
  SELECT *, lead(off) OVER (PARTITION BY file ORDER BY n) - 1 AS range_end FROM lines
), hits AS (
  SELECT file, step, k.key, off AS range_start, range_end,
    row_number() OVER (PARTITION BY file, k.key ORDER BY n) AS nth
  FROM followed JOIN (VALUES {_KEY_VALUES}) k(key) ON followed.var = k.key
  WHERE fc = CASE WHEN step > 0 THEN step || ' hour fcst' ELSE 'anl' END
     OR (k.key = ':APCP:surface:' AND fc = '192-240 hour acc fcst')
)
SELECT file, CAST(step AS INTEGER) AS step, key, CAST(range_start AS BIGINT) AS range_start,
  CAST(range_end AS BIGINT) AS range_end FROM hits WHERE nth = 1"""

ORACLE["listing_ready"] = r"""WITH listed AS (
  SELECT url, replace(html, '</a>', '-' || CASE length(url) % 3 WHEN 0 THEN '360' WHEN 1 THEN '240' ELSE '192' END
    || 'h-oper-fc.grib2</a>') AS html FROM pages
), links AS (
  SELECT url, html, list_filter(list_transform(regexp_extract_all(html, '(?is)<a\b[^>]*>(.*?)</a>', 1),
    lambda a: trim(regexp_replace(a, '<[^>]*>', '', 'g'))), lambda t: length(t) > 0) AS texts FROM listed
)
SELECT url, CAST(len(texts) AS INTEGER) AS links,
  len(list_filter(texts, lambda t: contains(t, '-360h-oper-fc.grib2'))) > 0
    OR contains(html, 'gfs.t00z.pgrb2.0p25.f360') AS ready
FROM links"""

_B, _I, _S, _D, _N = ("bigint", "int8"), ("int", "int4"), ("string", "text"), ("double", "float8"), ("timestamp_ntz", "timestamp")
_DESCRIBED = {
    "lineitem": dict(
        l_orderkey=_B, l_partkey=_B, l_suppkey=_B, l_linenumber=_I, l_quantity=_D, l_extendedprice=_D, l_discount=_D,
        l_tax=_D, l_returnflag=_S, l_linestatus=_S, l_shipdate=_N,
    ),
    "orders": dict(o_orderkey=_B, o_custkey=_B, o_orderstatus=_S, o_totalprice=_D, o_orderdate=_N, o_orderpriority=_S),
    "customer": dict(c_custkey=_B, c_name=_S, c_nationkey=_I, c_acctbal=_D, c_mktsegment=_S),
    "supplier": dict(s_suppkey=_B, s_name=_S, s_nationkey=_I, s_acctbal=_D),
    "part": dict(p_partkey=_B, p_name=_S, p_brand=_S, p_type=_S, p_size=_I, p_retailprice=_D),
    "nation": dict(n_nationkey=_I, n_name=_S, n_regionkey=_I),
    "region": dict(r_regionkey=_I, r_name=_S),
    "events": dict(event_id=_B, ts=_N, user_id=_B, event_type=_S, value=_D, props=_S),
    "documents": dict(doc_id=_B, text=_S, lang=_S, source=_S, n_chars=_B),
    "embeddings": dict(vec_id=_B, embedding=("array<float>", "float4[]"), label=_I),
    "pages": dict(page_id=_B, url=_S, html=_S),
    "benchmark": dict(item_id=_B, text=_S),
    "labels": dict(doc_id=_B, quality=_I, toxic=_I),
    "conversations": dict(conv_id=_B, turn=_B, role=_S, text=_S),
}
ORACLE["schema_map"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{src}' AS source_type, '{dst}' AS target_type, "
    f"count({c}) AS rows_with_value FROM {t}"
    for t, columns in _DESCRIBED.items()
    for c, (src, dst) in columns.items()
)

# --------------------------------------------------------- grids to rows

ORACLE["grid_flatten"] = """WITH cells AS (
  SELECT vec_id AS message_id, label, embedding, unnest(range(0, 64)) AS k FROM embeddings
), points AS (
  SELECT message_id, -11.0 + label * 0.25 + (k // 8) * 0.25 AS latitude, 178.0 + (k % 8) * 0.5 AS longitude,
    embedding[k + 1] AS gh, embedding[64 - k] AS t
  FROM cells
)
SELECT message_id, CAST(latitude AS DOUBLE) AS latitude,
  CAST(CASE WHEN longitude >= 180 THEN longitude - 360 ELSE longitude END AS DOUBLE) AS longitude, gh, t
FROM points WHERE latitude >= -10 AND latitude <= 90"""
ORACLE["lon_normalize"] = _with(
    f"""SELECT {ORD}, CASE WHEN longitude_360 >= 180 THEN longitude_360 - 360 ELSE longitude_360 END AS longitude_360
FROM raw_upper"""
)
ORACLE["lat_crop"] = _with(
    f"SELECT {ORD}, latitude - 30 AS latitude FROM raw_upper WHERE latitude >= 20 AND latitude <= 120"
)
ORACLE["drop_missing_target"] = _with(f"SELECT {ORD}, gh, t FROM raw_upper WHERE gh IS NOT NULL AND src_qty <> 7")
ORACLE["fixed_point_index"] = _with(
    f"""SELECT {ORD}, latitude, longitude_360 AS longitude, CAST(src_disc AS FLOAT) AS tp,
  {_INDEX.format("latitude", 90)} AS lat_i, {_INDEX.format("longitude_360", 180)} AS lon_i FROM base"""
)
ORACLE["time_derive"] = _with(
    f"""SELECT {ORD}, forecast_reference_time, forecast_date, forecast_cycle,
  forecast_reference_time + step_hours * INTERVAL '1' HOUR + INTERVAL '30' MINUTE AS valid_time, step_hours
FROM raw_upper"""
)
ORACLE["dedup_first"] = _with(
    f"""SELECT {COLS['upper']} FROM raw_upper
QUALIFY row_number() OVER (PARTITION BY {KEY_UPPER} ORDER BY {ORD}) = 1"""
)
ORACLE["union_by_name"] = _with(
    """SELECT latitude, longitude, forecast_reference_time, valid_time, step_hours, lat_i, lon_i, t2m,
  CASE WHEN step_hours <> 240 THEN d2m END AS d2m, msl, CASE WHEN step_hours <> 192 THEN tp END AS tp,
  "heightAboveGround", CASE WHEN step_hours <> 240 THEN surface END AS surface, forecast_date, forecast_cycle
FROM raw_surface"""
)
ORACLE["rename_mandatory"] = ORACLE["raw_append"]
ORACLE["z_to_gh"] = _with(
    f"""SELECT {ORD}, CASE WHEN gh IS NULL
    THEN CAST(CAST(CAST(src_part * 49 AS FLOAT) AS DOUBLE) / CAST(9.80665 AS DOUBLE) AS FLOAT) ELSE gh END AS gh
FROM raw_upper"""
)
_EVOLVED = (
    COLS["upper"]
    .replace(" u,", " CASE WHEN forecast_date < '2026-03-24' THEN u END AS u,")
    .replace(" v,", " CASE WHEN forecast_date >= '2026-03-24' THEN v END AS v,")
)
ORACLE["schema_evolve"] = _with(
    f"""SELECT {_EVOLVED}, CASE WHEN forecast_date >= '2026-03-24' THEN CAST(t / CAST(1000 AS DOUBLE) AS FLOAT) END AS q FROM raw_upper"""
)
_BROAD = "forecast_date BETWEEN '2026-03-23' AND '2026-03-24'"
_THOUSANDTH = "t / CAST(1000 AS DOUBLE)"
ORACLE["schema_widen"] = _with(
    f"""SELECT {COLS["upper"]},
  CASE WHEN {_BROAD} THEN CAST(step_hours AS BIGINT) * 1000000000 ELSE CAST(step_hours AS BIGINT) END AS n,
  CASE WHEN {_BROAD} THEN {_THOUSANDTH} ELSE CAST(CAST({_THOUSANDTH} AS FLOAT) AS DOUBLE) END AS q,
  CASE WHEN {_BROAD} THEN CAST(t AS DOUBLE) ELSE CAST(step_hours AS DOUBLE) END AS w
FROM raw_upper"""
)
ORACLE["schema_strict"] = ORACLE["parquet_export"]
ORACLE["product_filter"] = _with(
    """SELECT model, forecast_date, forecast_cycle, step_hours, lat_i, lon_i, gh, t FROM raw_upper
WHERE model = 'ifs' AND step_hours IN (240, 360) AND forecast_cycle IN (0, 12)"""
)

_DELAYS = ", ".join(f"('{p.task}', {int(p.delay_hours * 60)}, {12 if p.cycles == (0, 12) else 6})" for p in spec.PRODUCTS)
_TASK_CASE = " ".join(f"WHEN {i} THEN '{p.task}'" for i, p in enumerate(spec.PRODUCTS))
_TRIGGERS = f"""WITH delays AS (SELECT * FROM (VALUES {_DELAYS}, ('other', 280, 6)) d(task, minutes, every)),
triggers AS (
  SELECT event_id, CASE user_id % 9 {_TASK_CASE} ELSE 'other' END AS task, ts AS trigger_time FROM events
), nominal AS (
  SELECT event_id, task, trigger_time, trigger_time - minutes * INTERVAL '1' MINUTE AS nominal_time, every
  FROM triggers JOIN delays USING (task)
)"""
ORACLE["cycle_resolve"] = f"""{_TRIGGERS}, rounded AS (
  SELECT *, CAST(round_even(EXTRACT(HOUR FROM nominal_time) / 6.0, 0) * 6 AS INTEGER) AS h FROM nominal
)
SELECT event_id, task, trigger_time, nominal_time,
  CAST(CAST(nominal_time AS DATE) + CASE WHEN h = 24 THEN 1 ELSE 0 END AS DATE) AS cycle_date,
  CASE WHEN h = 24 THEN 0 ELSE h END AS cycle_hour FROM rounded"""
ORACLE["cycle_resolve_own"] = f"""{_TRIGGERS}
SELECT event_id, task, trigger_time, nominal_time, CAST(nominal_time AS DATE) AS cycle_date,
  CAST(EXTRACT(HOUR FROM nominal_time) - EXTRACT(HOUR FROM nominal_time) % every AS INTEGER) AS cycle_hour FROM nominal"""

ORACLE["z500_scale"] = _with(
    f"""SELECT model, forecast_date, forecast_cycle, step_hours, {ORD}, gh,
  CAST(CASE WHEN m > 40000 THEN CAST(gh AS DOUBLE) / CAST(9.80665 AS DOUBLE) / 10
       WHEN m > 4000 THEN CAST(gh AS DOUBLE) / 10 ELSE CAST(gh AS DOUBLE) END AS FLOAT) AS z500_dam
FROM (SELECT *, avg(CAST(gh AS DOUBLE)) OVER (PARTITION BY model, forecast_date, forecast_cycle, step_hours) AS m
      FROM scaled) WHERE m IS NOT NULL""",
    """scaled AS (SELECT * REPLACE (CAST(CAST(gh AS DOUBLE) * CASE model WHEN 'aifs' THEN CAST(10 AS DOUBLE)
    WHEN 'ifs' THEN CAST(0.125 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS FLOAT) AS gh)
  FROM raw_upper WHERE "isobaricInhPa" = 500)""",
)
ORACLE["nearest_sample"] = _with(
    """SELECT p.lat_i, p.lon_i, p.city_name, p.latitude, p.longitude, COALESCE(CAST(g.t2m AS DOUBLE), 0) AS sampled
FROM placed_points p LEFT JOIN grid g ON p.lat_i = g.lat_i AND p.lon_i = g.lon_i""",
    CUSTOMER_CITIES,
    "grid AS (SELECT lat_i, lon_i, min(t2m) AS t2m FROM raw_surface WHERE lat_i BETWEEN 0 AND 180000 AND lon_i BETWEEN 0 AND 360000 GROUP BY 1, 2)",
    """lat_near AS (
  SELECT city_name, a.lat_i FROM cities c CROSS JOIN (SELECT DISTINCT lat_i FROM grid) a
  QUALIFY row_number() OVER (PARTITION BY city_name ORDER BY abs((c.latitude + 90) * 1000 - a.lat_i), a.lat_i DESC) = 1
)""",
    """lon_near AS (
  SELECT city_name, a.lon_i FROM cities c CROSS JOIN (SELECT DISTINCT lon_i FROM grid WHERE lon_i IS NOT NULL) a
  QUALIFY row_number() OVER (PARTITION BY city_name ORDER BY abs((c.longitude + 180) * 1000 - a.lon_i), a.lon_i DESC) = 1
)""",
    """placed_points AS (
  SELECT c.city_name, c.latitude, c.longitude, a.lat_i, o.lon_i
  FROM cities c JOIN lat_near a USING (city_name) JOIN lon_near o USING (city_name)
)""",
)
ORACLE["last_slice"] = _with(
    f"""SELECT model, {KEY_UPPER}, gh, t FROM (
  SELECT *, max(step_hours) OVER a AS last_step, max("isobaricInhPa") OVER a AS last_level FROM raw_upper
  WINDOW a AS (PARTITION BY model, forecast_date, forecast_cycle)
) WHERE step_hours = last_step AND "isobaricInhPa" = last_level"""
)

# ---------------------------------------------------------------- staging

for _p in spec.PRODUCTS:
    _name = f"stg_{_p.shape}_{_p.model}"
    _name = {"stg_upper_gfs": "stg_upper", "stg_surface_gfs": "stg_surface", "stg_spread_aifs": "stg_spread"}.get(_name, _name)
    ORACLE[_name] = _with(_stage(_p.shape, _p.model))
for _shape in spec.SHAPES:
    _model = "ifs" if _shape == "spread" else "gfs"
    ORACLE[f"stg_{_shape}_windowed"] = _with(_stage(_shape, _model, RECENT, wide=True))
    ORACLE[f"stg_{_shape}_region"] = _with(_stage(_shape, _model, BOX))
ORACLE["geo_guard"] = _with(f"SELECT model, {COLS['surface']} FROM raw_surface WHERE {GUARD}")
ORACLE["region_box"] = _with(
    f"""SELECT {ORD}, latitude, longitude, t2m FROM (
  SELECT * REPLACE (CASE WHEN model = 'aifs' THEN longitude_360 ELSE longitude END AS longitude) FROM raw_surface
) WHERE {BOX}"""
)
ORACLE["recent_window"] = _with(f"SELECT model, {COLS['upper']} FROM raw_upper WHERE {RECENT}")

# ------------------------------------------------------------- fact loads

def _each(shape: str, sql) -> str:
    """The union of one query a model."""
    models = ("aifs", "ifs") if shape == "spread" else ("gfs", "aifs", "ifs")
    return "\nUNION ALL\n".join(f"SELECT * FROM ({sql(m)})" for m in models)


ORACLE["fact_append_hwm"] = _each("upper", lambda m: _with(
    f"""SELECT * FROM loaded
UNION ALL
SELECT f.* FROM ({_fact("upper", m)}) f
WHERE cycle_date >= {AS_OF} - 7 AND {CYCLE_TIME} > (SELECT max({CYCLE_TIME}) FROM loaded)""",
    f"loaded AS ({_fact('upper', m, EARLIER, chr(99) + 'ycle_date <= DATE ' + repr('2026-03-24'))})",
))
ORACLE["fact_append_hwm_strict"] = _each("spread", lambda m: _with(
    f"""SELECT f.*, 'current' AS target FROM ({_fact("spread", m)}) f
WHERE cycle_date >= {AS_OF} - 4 AND {CYCLE_TIME} > (
  SELECT max({CYCLE_TIME}) FROM ({_fact("spread", m)}) WHERE cycle_date BETWEEN {AS_OF} - 4 AND DATE '2026-03-24')"""
))
ORACLE["fact_latest_window"] = _each("upper", lambda m: _with(
    f"""SELECT * FROM recent WHERE {CYCLE_TIME} >= (SELECT max({CYCLE_TIME}) FROM recent) - INTERVAL '1' DAY""",
    f"recent AS (SELECT * FROM ({_fact('upper', m)}) WHERE cycle_date >= {AS_OF} - 1)",
))
_FKEY = ", ".join(spec.fact_key("upper"))
_FCOLS = ", ".join(spec.fact_columns("upper"))


def _merged(model: str, first: str, batch: str, batch_order: str) -> str:
    return _with(
        f"""SELECT {_FCOLS} FROM late
UNION ALL
SELECT {_FCOLS} FROM early WHERE NOT EXISTS (
  SELECT 1 FROM late WHERE {" AND ".join(f"late.{k} = early.{k}" for k in spec.fact_key("upper"))})""",
        f"""early AS (SELECT * FROM ({first})
  QUALIFY row_number() OVER (PARTITION BY {_FKEY} ORDER BY {ORD}) = 1)""",
        f"""late AS (SELECT * FROM ({batch})
  QUALIFY row_number() OVER (PARTITION BY {_FKEY} ORDER BY {batch_order}) = 1)""",
    )


ORACLE["fact_merge"] = _each("upper", lambda m: _merged(
    m,
    _fact("upper", m, EARLIER, keep=ORD),
    _fact("upper", m, STAMP, f"cycle_date >= {AS_OF} - 1 AND forecast_step_hours > 192", keep=ORD),
    ORD_DESC,
))
ORACLE["stream_ingest"] = _each("upper", lambda m: _merged(
    m,
    _fact("upper", m, EARLIER, "forecast_step_hours < 360", keep=ORD),
    f"""SELECT * REPLACE (CAST(temp_kelvin + 1 AS FLOAT) AS temp_kelvin,
      CAST(temp_kelvin + 1 AS FLOAT) - {ZERO_C} AS temp_celsius) FROM ({_fact("upper", m, STAMP, "forecast_step_hours > 240", keep=ORD)})""",
    ORD,
))
ORACLE["stream_ingest_cuts"] = f"SELECT *, unnest(['deliveries', 'files']) AS cut FROM ({ORACLE['stream_ingest']})"
ORACLE["merge_backfill"] = """
WITH o AS (SELECT CASE WHEN o_orderkey % 97 <> 0 THEN DATE '1992-01-01' + CAST((CAST(o_orderdate AS DATE) - DATE '1992-01-01') % 1100 AS INTEGER) END AS day, o_orderkey, o_totalprice, o_orderstatus FROM orders)
SELECT day, o_orderkey, o_totalprice + 1 AS o_totalprice, 'B' AS o_orderstatus FROM o WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0
UNION ALL SELECT * FROM o WHERE o_orderkey % 2 <> 0 AND o_orderkey % 3 <> 0
"""
ORACLE["merge_hot_key"] = """
WITH keyed AS (
  SELECT CASE WHEN l_suppkey % 3 > 0 THEN CAST(date_trunc('month', l_shipdate) AS DATE) ELSE DATE '1995-01-01' END AS month,
    CASE WHEN l_suppkey % 3 > 0 THEN l_partkey ELSE -1 END AS part, l_extendedprice, l_orderkey, l_linenumber, l_returnflag
  FROM lineitem
)
SELECT * FROM keyed
QUALIFY row_number() OVER (PARTITION BY month, part ORDER BY l_returnflag = 'R' DESC, l_extendedprice DESC, l_orderkey, l_linenumber) = 1
"""
ORACLE["fact_append_window"] = _each("surface", lambda m: _with(
    f"""SELECT * FROM ({_fact("surface", m)}) WHERE cycle_date >= {AS_OF} - 3
UNION ALL
SELECT * FROM ({_fact("surface", m)}) WHERE cycle_date >= {AS_OF} - 1"""
))
_LOC = "SELECT DISTINCT lat_i, lon_i, lat, lon"
ORACLE["delete_insert"] = _each("surface", lambda m: _with(
    f"""SELECT lat_i, lon_i, CAST(lat + 100 AS FLOAT) AS lat, lon, '{m}' AS weather_model FROM latest
UNION ALL
SELECT *, '{m}' FROM everything e WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.lat_i = e.lat_i AND l.lon_i = e.lon_i)""",
    f"everything AS ({_LOC} FROM ({_stage('surface', m)}))",
    f"latest AS ({_LOC} FROM ({_stage('surface', m)}) WHERE cycle_date >= {AS_OF})",
))
ORACLE["full_refresh"] = _each("spread", lambda m: _with(_fact("spread", m, where="pressure_level_hpa = 500")))
ORACLE["fact_surface_project"] = _with(_fact("surface", "gfs"))
for _p in spec.PRODUCTS:
    if (_p.model, _p.shape) != ("gfs", "surface"):
        ORACLE[f"fact_{_p.shape}_{_p.model}"] = _with(_fact(_p.shape, _p.model))

# --------------------------------------------- dimensions, joins, set operations

ORACLE["dim_grid"] = _with("SELECT * FROM dim", CITIES, STATIONS, DIM)
ORACLE["dim_grid_plain"] = _with(f"{_LOC} FROM ({_stage('upper', 'gfs')})")
_SLICE = f"forecast_step_hours = 240 AND cycle_hour = 0 AND cycle_date >= {AS_OF} - 1"
ORACLE["dim_locations"] = _with(
    "\nUNION\n".join(
        f"SELECT lat_i, lon_i, lat, lon FROM ({_stage('surface', m)}) WHERE {_SLICE}" for m in ("gfs", "ifs", "aifs")
    )
)
ORACLE["dim_locations_again"] = ORACLE["dim_locations"]
ORACLE["dim_times"] = f"""WITH {BASE}, combos AS (
  SELECT CAST(m.d - i AS DATE) AS cycle_date, h AS cycle_hour, s AS step
  FROM (SELECT max(frt_date) AS d FROM base) m
  CROSS JOIN (VALUES (0), (1), (2), (3)) a(i)
  CROSS JOIN (VALUES (0), (6), (12), (18)) b(h)
  CROSS JOIN (VALUES (192), (240), (288), (360)) c(s)
)
SELECT DISTINCT cycle_date, cycle_hour,
  CAST(CAST(cycle_date AS TIMESTAMP) + (cycle_hour + step) * INTERVAL '1' HOUR AS DATE) AS valid_date,
  CAST((cycle_hour + step) % 24 AS INTEGER) AS valid_hour, {STAMP} AS dbt_updated_at
FROM combos"""
for _shape in spec.SHAPES:
    ORACLE[f"unified_{_shape}"] = _with(_unified(_shape))
    ORACLE[f"city_{_shape}"] = _with(_city(_shape, _unified(_shape)), CITIES, STATIONS, DIM)
ORACLE["hash_key"] = _with(
    f"SELECT {_hash('upper')} AS unique_key, {', '.join(spec.hash_key_columns('upper'))} FROM ({_unified('upper')})"
)
_STAMPED_AT = f"""CASE WHEN cycle_date < DATE '2026-03-24' THEN TIMESTAMP '2026-03-23 12:00:00'
    WHEN cycle_date < DATE '2026-03-25' THEN {EARLIER} ELSE {STAMP} END AS dbt_updated_at"""
for _shape, _kelvin in (("upper", "temp_kelvin"), ("surface", "temp_2m_kelvin"), ("spread", "temp_spread_kelvin")):
    _first = "\nUNION ALL\n".join(
        f"""SELECT * FROM ({_fact(_shape, p.model, keep=ORD)})
  QUALIFY row_number() OVER (PARTITION BY {", ".join(spec.fact_key(_shape))} ORDER BY {ORD}) = 1"""
        for p in spec.PRODUCTS
        if p.shape == _shape
    )
    ORACLE["city_incremental" + ("" if _shape == "upper" else f"_{_shape}")] = _with(
        f"""SELECT * FROM ({_city(_shape, "SELECT * FROM stamped WHERE dbt_updated_at >= (SELECT max(dbt_updated_at) FROM held_city)", True)})
UNION ALL
SELECT * FROM held_city WHERE dbt_updated_at < (SELECT max(dbt_updated_at) FROM held_city)""",
        CITIES,
        STATIONS,
        DIM,
        f"""stamped AS (
  SELECT {", ".join(spec.fact_columns(_shape)).replace("dbt_updated_at", _STAMPED_AT)} FROM ({_first})
)""",
        f"""held_city AS ({_city(_shape, f"SELECT * REPLACE (CAST({_kelvin} + 100 AS FLOAT) AS {_kelvin}) FROM stamped WHERE cycle_date <= DATE '2026-03-24'", True)})""",
    )

# ---------------------------------------------------------------- quality

ORACLE["profile_columns"] = _with(
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
  {"count(*) FILTER (WHERE src_qty = 30)" if c == "t" else "CAST(0 AS BIGINT)"} AS nan_count,
  (count(*) - count({c})) / CAST(count(*) AS DOUBLE) * 100 AS null_percentage,
  CAST(min({c}){" FILTER (WHERE src_qty <> 30)" if c == "t" else ""} AS DOUBLE) AS min_value,
  CAST(max({c}){" FILTER (WHERE src_qty <> 30)" if c == "t" else ""} AS DOUBLE) AS max_value
FROM raw_upper"""
        for c in ("gh", "t", "u", "v")
    )
)
ORACLE["profile_rollup"] = _with(
    """SELECT count(*) AS records_extracted, count(*) - count(latitude) AS null_count_latitude,
  count(*) - count(longitude) AS null_count_longitude, count(*) - count(valid_time) AS null_count_valid_time,
  4 * count(*) - count(t2m) - count(d2m) - count(msl) - count(tp) AS null_count_metric_values,
  min(latitude) AS min_latitude, max(latitude) AS max_latitude, min(longitude) AS min_longitude,
  max(longitude) AS max_longitude,
  CAST(least(min(t2m), min(d2m), min(msl), min(tp)) AS DOUBLE) AS min_metric_value,
  CAST(greatest(max(t2m), max(d2m), max(msl), max(tp)) AS DOUBLE) AS max_metric_value
FROM raw_surface"""
)
ORACLE["profile_incremental"] = ORACLE["profile_rollup"]
ORACLE["coord_rule"] = _with(
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, min({c}) AS min_value, max({c}) AS max_value, CAST({lo} AS DOUBLE) AS rule_min,
  CAST({hi} AS DOUBLE) AS rule_max, min({c}) >= {lo} AND max({c}) <= {hi} AS passed,
  CASE WHEN min({c}) >= {lo} AND max({c}) <= {hi} THEN 'SUCCESS' ELSE 'WARNING' END AS status
FROM raw_upper"""
        for c, (lo, hi) in spec.COORDINATE_RULES.items()
    )
)
ORACLE["duplicate_keys"] = _with(
    f"""SELECT count(*) AS row_count, count(*) - count(DISTINCT k) AS duplicate_records_count,
  CASE WHEN count(*) > count(DISTINCT k) THEN 'WARNING' ELSE 'SUCCESS' END AS status
FROM (SELECT ROW({KEY_UPPER}) AS k FROM raw_upper)"""
)
ORACLE["audit_row"] = _with(
    "\nUNION ALL\n".join(
        f"""SELECT model AS model_name, 'extract.' || model || '.upper' AS dag_id, 'manual' AS run_id,
  {STAMP} AS logical_date, 'upper' AS layer_type, 'WARNING' AS status,
  n AS records_extracted, n AS records_loaded, 0::BIGINT AS null_count_latitude, no_lon AS null_count_longitude,
  0::BIGINT AS null_count_valid_time, no_gh AS null_count_metric_values, n - keys AS duplicate_records_count,
  min_lat AS min_latitude, max_lat AS max_latitude, min_lon AS min_longitude, max_lon AS max_longitude,
  least(min_gh, min_t, min_u, min_v) AS min_metric_value, greatest(max_gh, max_t, max_u, max_v) AS max_metric_value,
  CAST(0 AS DOUBLE) AS execution_time_seconds, CAST(NULL AS VARCHAR) AS validation_error, n = keys AS keys_unique,
  'forecast_date,forecast_cycle,step_hours,lat_i,lon_i,isobaricInhPa' AS key_columns, '{c}' AS column_name,
  {"no_gh" if c == "gh" else "0::BIGINT"} AS null_count, 0::BIGINT AS nan_count,
  {"no_gh" if c == "gh" else "0"} / CAST(n AS DOUBLE) * 100 AS null_percentage, min_{c} AS min_value, max_{c} AS max_value
FROM stats"""
        for c in ("gh", "t", "u", "v")
    ),
    f"""stats AS (
  SELECT model, count(*) AS n, count(DISTINCT ROW({KEY_UPPER})) AS keys, count(*) - count(longitude) AS no_lon,
    count(*) - count(gh) AS no_gh, min(latitude) AS min_lat, max(latitude) AS max_lat, min(longitude) AS min_lon,
    max(longitude) AS max_lon, {", ".join(f"CAST(min({c}) AS DOUBLE) AS min_{c}, CAST(max({c}) AS DOUBLE) AS max_{c}" for c in ("gh", "t", "u", "v"))}
  FROM raw_upper GROUP BY model
)""",
)
ORACLE["verify_gold"] = _with(
    "\nUNION ALL\n".join(
        f"""SELECT 'fct_{s}_forecast' AS view_name, count(*) AS row_count, count(*) - count(valid_date) AS null_valid_date_count,
  max(valid_date) AS max_valid_date, count(*) > 0 AND count(*) = count(valid_date) AS passed,
  CASE WHEN count(*) > 0 AND count(*) = count(valid_date) THEN 'SUCCESS' ELSE 'WARNING' END AS status
FROM ({_unified(s)})"""
        for s in spec.SHAPES
    )
)


def _test(name: str, failures: str, source: str, severity: str = "error", extra: str = "") -> str:
    return f"""SELECT '{name}' AS test_name, {failures} AS failures, '{severity}' AS severity,
  {failures} = 0 AS passed{extra} FROM {source}"""


def _tests(parts: list[str], **ctes: str) -> str:
    return _with("\nUNION ALL\n".join(parts), *[f"{n} AS MATERIALIZED ({q})" for n, q in ctes.items()])


ORACLE["test_not_null"] = _tests(
    [
        _test(f"not_null_{c}", f"count(*) FILTER (WHERE {c} IS NULL)", f"unified_{s}")
        for s in spec.SHAPES
        for c in spec.fact_columns(s)
    ],
    **{f"unified_{s}": _unified(s) for s in spec.SHAPES},
)
ORACLE["test_unique"] = _tests(
    [
        _test(
            f"unique_{s}",
            "count(*)",
            f"(SELECT 1 FROM unified_{s} GROUP BY weather_model, {', '.join(spec.fact_key(s))} HAVING count(*) > 1)",
        )
        for s in spec.SHAPES
    ],
    **{f"unified_{s}": _unified(s) for s in spec.SHAPES},
)
ORACLE["test_accepted_values"] = "\nUNION ALL\n".join(
    f"SELECT *, '{s}' AS shape FROM ("
    + _tests(
        [
            _test(f"accepted_values_{c}", f"count(*) FILTER (WHERE {c} NOT IN ({v}))", "unified")
            for c, v in (
                ("weather_model", "'gfs', 'aifs'"),
                ("cycle_hour", "0, 12"),
                ("forecast_step_hours", "192, 240, 288, 360"),
                ("pressure_level_hpa", "500, 850"),
            )
            if c in spec.fact_columns(s)
        ],
        unified=_unified(s),
    )
    + ")"
    for s in spec.SHAPES
)
ORACLE["test_expression"] = _tests(
    [
        _test(
            f"expression_is_true_{c}", f"count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi})", f"unified_{s}", "warn", f", '{s}' AS shape"
        )
        for s in spec.SHAPES
        for c, (lo, hi) in spec.RANGE_RULES.items()
        if c in spec.fact_columns(s)
    ],
    **{f"unified_{s}": _unified(s) for s in spec.SHAPES},
)
ORACLE["read_back"] = _with(
    """SELECT forecast_date, forecast_cycle, count(*) AS rows_written, count(*) AS rows_read, TRUE AS passed
FROM raw_upper GROUP BY 1, 2"""
)

# ------------------------------------------- calendar, retention, events

_PARTS = "\nUNION\n".join(
    f"SELECT '{p.table}' AS table_name, '{p.fact}' AS fact_name, forecast_date, forecast_cycle FROM raw_{p.shape} WHERE model = '{p.model}'"
    for p in spec.PRODUCTS
)
_EXPECTED = ", ".join(f"('{p.table}', {c})" for p in spec.PRODUCTS if p.published for c in p.cycles)
ORACLE["partition_readiness"] = _with(
    f"""SELECT table_name, '2026-03-25' AS forecast_date, CAST(cycle AS INTEGER) AS forecast_cycle
FROM (VALUES {_EXPECTED}) e(table_name, cycle)
WHERE NOT EXISTS (SELECT 1 FROM parts p WHERE p.table_name = e.table_name AND p.forecast_cycle = e.cycle
  AND p.forecast_date = '2026-03-25' AND NOT (p.table_name LIKE '%surface' AND p.forecast_cycle = 0))""",
    f"parts AS ({_PARTS})",
)
_FACT_CYCLES = ", ".join(f"('{p.fact}', {c})" for p in spec.PRODUCTS for c in p.fact_cycles)
_PNAME = "fact_name || '_c' || lpad(CAST({0} AS VARCHAR), 2, '0') || '_p' || replace(CAST({1} AS VARCHAR), '-', '_')"
ORACLE["partition_calendar"] = _with(
    f"""SELECT * FROM (
  SELECT {_PNAME.format("cycle", "d")} AS partition_name, fact_name, CAST(cycle AS INTEGER) AS cycle_hour, d AS cycle_date
  FROM (VALUES {_FACT_CYCLES}) f(fact_name, cycle)
  CROSS JOIN (SELECT CAST({AS_OF} + CAST(i AS INTEGER) AS DATE) AS d FROM range(-5, 11) r(i)) days
) WHERE partition_name NOT IN (SELECT {_PNAME.format("forecast_cycle", "forecast_date")} FROM parts)""",
    f"parts AS ({_PARTS})",
)
ORACLE["retention_raw"] = _with(
    f"SELECT {COLS['surface']} FROM raw_surface WHERE forecast_date >= '2026-03-23'"
)
ORACLE["retention_gold"] = _with(
    f"""SELECT {_PNAME.format("forecast_cycle", "forecast_date")} AS partition_name, CAST(forecast_date AS DATE) AS partition_date
FROM parts WHERE forecast_date < '2026-03-24'""",
    f"parts AS ({_PARTS})",
)
ORACLE["repartition_fact"] = _with(
    f"""SELECT weather_model, cycle_hour, cycle_date, count(*) AS rows_before, count(*) AS rows_after
FROM ({_unified("upper")}) GROUP BY 1, 2, 3"""
)
ORACLE["recent_snapshot"] = _with(
    f"SELECT {COLS['spread']} FROM raw_spread WHERE forecast_date >= '2026-03-23'"
)

_ROUTED = """CASE event_type WHEN 'view' THEN 'gfs_upper' WHEN 'click' THEN 'gfs_surface' WHEN 'signup' THEN 'aifs_upper'
    WHEN 'purchase' THEN 'ifs_spread' END"""
ORACLE["event_routing"] = f"""SELECT DISTINCT {_ROUTED} AS model FROM events
WHERE event_type <> 'error' AND ts > COALESCE(
  (SELECT max(ts) - INTERVAL '15' DAY FROM events WHERE event_type = 'error' AND value >= 20),
  TIMESTAMP '2024-01-30 23:45:00')"""
ORACLE["event_coalesce"] = f"""SELECT time_bucket(INTERVAL '5' MINUTE, ts) AS window_start,
  time_bucket(INTERVAL '5' MINUTE, ts) + INTERVAL '5' MINUTE AS window_end,
  string_agg(DISTINCT {_ROUTED}, ',' ORDER BY {_ROUTED}) AS models, count(*) AS events
FROM events WHERE event_type <> 'error' GROUP BY 1, 2"""

# A window opens with the first event that lies in none: a chain from one opening event to the next.
ORACLE["event_coalesce_first"] = f"""WITH RECURSIVE routed AS (
  SELECT ts, {_ROUTED} AS model FROM events WHERE event_type <> 'error' AND ts IS NOT NULL
), opened AS (
  SELECT min(ts) AS t FROM routed
  UNION ALL
  SELECT (SELECT min(r.ts) FROM routed r WHERE r.ts >= o.t + INTERVAL '5' MINUTE) FROM opened o WHERE o.t IS NOT NULL
)
SELECT o.t AS window_start, o.t + INTERVAL '5' MINUTE AS window_end,
  string_agg(DISTINCT r.model, ',' ORDER BY r.model) AS models, count(*) AS events
FROM routed r ASOF JOIN (SELECT t FROM opened WHERE t IS NOT NULL) o ON r.ts >= o.t GROUP BY 1, 2"""
ORACLE["ingest_order"] = """WITH cells AS (
  SELECT vec_id, label, embedding, unnest(range(0, 64)) AS k FROM embeddings
), points AS (
  SELECT vec_id, k, -11.0 + label * 0.25 + (k // 8) * 0.25 AS latitude, 178.0 + (k % 8) * 0.5 AS lon,
    embedding[k + 1] AS gh, embedding[64 - k] AS t,
    TIMESTAMP '2026-03-26 00:00:00' + (vec_id % 4 * 6) * INTERVAL '1' HOUR AS frt, [250, 500, 850][(vec_id % 3 + 1)::INT] AS level
  FROM cells
), first_rows AS (
  SELECT * FROM points WHERE latitude >= -10 AND latitude <= 90
  QUALIFY row_number() OVER (PARTITION BY frt, level, latitude, lon ORDER BY vec_id DESC, k) = 1
), wrapped AS (
  SELECT *, CASE WHEN lon >= 180 THEN lon - 360 ELSE lon END AS longitude FROM first_rows
)
SELECT CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, frt AS forecast_reference_time,
  frt + INTERVAL '240' HOUR AS valid_time, 240 AS step_hours,
  CAST(ROUND((latitude + 90) * 1000) AS INTEGER) AS lat_i, CAST(ROUND((longitude + 180) * 1000) AS INTEGER) AS lon_i,
  CAST(level AS INTEGER) AS "isobaricInhPa", gh, t, gh AS u, t AS v,
  '2026-03-26' AS forecast_date, CAST(EXTRACT(HOUR FROM frt) AS INTEGER) AS forecast_cycle
FROM wrapped"""
