"""DuckDB text of the views, prepended to the SQL twins as CTEs."""

from unitgrid import schema as S

YEAR = 1996

# Bands of one observation, shared by both engines; {d} is the integer division operator.
BAND_EXPRESSIONS = {
    "BLUE": "300 + 100 * (((row + col) {d} 10) % 9) + CAST(floor(l_quantity * 20) AS INT)",
    "GREEN": "300 + 250 * ((row {d} 6 + col {d} 8) % 12) + CAST(floor(l_extendedprice / 200) AS INT)",
    "RED": "400 + 180 * ((2 * (row {d} 7) + col {d} 9) % 10) + CAST(floor(l_discount * 3000) AS INT)",
    "NIR": "500 + 150 * ((row {d} 9 + col {d} 5) % 13) + CAST(floor(l_tax * 2500) AS INT)",
    "SWIR1": "200 + 300 * ((row {d} 8 + 2 * (col {d} 6)) % 11) + CAST(floor(l_quantity * 6) AS INT)",
    "SWIR2": "250 + 120 * ((row {d} 5 + col {d} 7) % 14) + CAST(floor(l_extendedprice / 400) AS INT)",
}
# Hexagon around a centre: (dy, dx) of its corners, so that no edge meets a pixel centre.
HEXAGON = [(-6, 0), (-3, 4), (3, 4), (6, 0), (3, -4), (-3, -4)]
DAY_FACTORS = {m: i + 1 for i, m in enumerate(S.DAY_METRICS)}


def _hexagon_rows():
    ring = HEXAGON + HEXAGON[:1]
    return ", ".join(f"({i}, {a[0]}, {a[1]}, {b[0]}, {b[1]})" for i, (a, b) in enumerate(zip(ring, ring[1:])))


_ND = "CASE WHEN {a} >= 0 AND {b} >= 0 AND {a} + {b} <> 0 THEN ({a} - {b}) / ({a} + {b}) END"


def nd(a, b):
    return _ND.format(a=a, b=b)


def nd_eps(a, b):
    return f"(({a} - {b}) / ({a} + {b} + 1e-6))"


BSI = ("CASE WHEN (SWIR1 + RED) + (NIR + BLUE) <> 0 THEN ((SWIR1 + RED) - (NIR + BLUE)) / "
       "((SWIR1 + RED) + (NIR + BLUE)) END")
LIT = "avg_rad >= 1.5"
CLEAR = "(qa & 3072) = 0"
VALID = "RED IS NOT NULL AND GREEN IS NOT NULL AND BLUE IS NOT NULL AND (RED > 0 OR GREEN > 0 OR BLUE > 0)"

VIEWS = {
    "v_unit": ((), f"""
        SELECT c_custkey AS custkey,
               'C.' || (r_regionkey + 1) || '.' || (n_nationkey + 1) || '.' || (c_custkey + 1) || '_1' AS gid_3,
               'Đường ' || c_name || ' Thủ' AS name_3,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'Phường' WHEN 'MACHINERY' THEN 'Phường'
                    WHEN 'FURNITURE' THEN 'nan' WHEN 'AUTOMOBILE' THEN 'Thị trấn' ELSE 'Xã' END AS type_3,
               'C.' || (r_regionkey + 1) || '.' || (n_nationkey + 1) || '_1' AS gid_2, 'Huyện ' || n_name AS name_2,
               'C.' || (r_regionkey + 1) || '_1' AS gid_1, 'Tỉnh ' || r_name AS name_1
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "v_admin": (("v_unit",), f"SELECT {', '.join(S.ADMIN_COLUMNS)} FROM v_unit"),
    "v_month": (("v_unit",), f"""
        SELECT gid_3, CAST({YEAR} AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
               round(avg(o_totalprice) / 73331.0, 6) AS val, count(*) AS n
        FROM orders JOIN v_unit ON o_custkey = custkey WHERE year(o_orderdate) = {YEAR} GROUP BY ALL"""),
    "v_day": (("v_month",), "SELECT gid_3, year, month, "
              + ", ".join(f"val * {k} AS {m}" for m, k in DAY_FACTORS.items())
              + " FROM v_month"),
    "v_px": (("v_unit",), f"""
        SELECT gid_3, CAST(month(o_orderdate) AS BIGINT) AS month, o_totalprice / 73331.0 AS avg_rad,
               CAST(o_orderkey % 7 AS DOUBLE) AS cf_cvg, (custkey % 500 + 1) * CAST(1.37 AS DOUBLE) AS area_ha
        FROM orders JOIN v_unit ON o_custkey = custkey WHERE year(o_orderdate) = {YEAR}"""),
    "v_long": (("v_px",), f"""
        SELECT gid_3, month, max(area_ha) AS area_ha, CAST(count(*) AS DOUBLE) AS n,
               sum(avg_rad) AS avg_rad_sum, avg(avg_rad) AS avg_rad_mean, stddev_pop(avg_rad) AS "avg_rad_stdDev",
               min(avg_rad) AS avg_rad_min, max(avg_rad) AS avg_rad_max, count(avg_rad) AS avg_rad_count,
               sum(CASE WHEN {LIT} THEN avg_rad END) AS lit_rad, count(*) FILTER (WHERE {LIT}) AS is_lit,
               avg(cf_cvg) AS cf_cvg
        FROM v_px GROUP BY gid_3, month"""),
    "v_ind": (("v_long",), f"""
        SELECT gid_3, CAST({YEAR} AS BIGINT) AS year, month, '{YEAR}-' || lpad(CAST(month AS VARCHAR), 2, '0') AS "TIME",
               round(area_ha, 2) AS "COMMUNE_AREA_HA", round(avg_rad_sum, 4) AS "TNL", round(avg_rad_mean, 4) AS "MEAN_RAD",
               round("avg_rad_stdDev", 4) AS "STD_RAD", round(avg_rad_min, 4) AS "MIN_RAD", round(avg_rad_max, 4) AS "MAX_RAD",
               round(CASE WHEN avg_rad_mean > 0 THEN "avg_rad_stdDev" / avg_rad_mean ELSE 0 END, 4) AS "SPATIAL_CV",
               CAST(is_lit AS BIGINT) AS "LIT_PIXELS", round(is_lit * 25.0, 2)::DOUBLE AS "LIT_AREA_HA",
               round(CASE WHEN avg_rad_count > 0 THEN is_lit::DOUBLE / avg_rad_count * 100.0 ELSE 0 END, 2) AS "ELECTRIFICATION_RATIO_PCT",
               round(coalesce(lit_rad, 0), 4) AS "LIT_POP_PROXY", round(cf_cvg, 1) AS "CLOUD_FREE_OBS"
        FROM v_long"""),
    "v_night": (("v_ind",), """
        SELECT *, round(avg("TNL") OVER w3, 6) AS "TNL_MA3",
               round(CASE WHEN p <> 0 THEN ("TNL" - p) / p * 100.0 WHEN "TNL" > 0 THEN 'inf'::DOUBLE END, 6)
                 AS "TNL_MOM_GROWTH_PCT"
        FROM (SELECT *, lag("TNL") OVER (PARTITION BY gid_3 ORDER BY month) AS p FROM v_ind)
        WINDOW w3 AS (PARTITION BY gid_3 ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""),
    "v_scene": ((), """
        SELECT event_id AS scene_id, ts, 'U.' || user_id AS unit, event_type AS collection, value AS cloud,
               CAST(json_extract_string(props, '$.k') AS INT) * 64 AS qa, user_id,
               CAST(event_id * 37 % 1000 AS DOUBLE) AS minx, CAST(event_id * 91 % 1000 AS DOUBLE) AS miny,
               CAST(event_id * 37 % 1000 + 10 AS DOUBLE) AS maxx, CAST(event_id * 91 % 1000 + 8 AS DOUBLE) AS maxy
        FROM events"""),
    "v_box": (("v_unit",), """
        SELECT gid_3, CAST(custkey * 53 % 1000 AS DOUBLE) + 0.5 AS minx, CAST(custkey * 29 % 1000 AS DOUBLE) + 0.5 AS miny,
               CAST(custkey * 53 % 1000 AS DOUBLE) + 6.5 AS maxx, CAST(custkey * 29 % 1000 AS DOUBLE) + 5.5 AS maxy FROM v_unit"""),
    "v_obs": ((), "SELECT 'img_' || (l_suppkey // 12) AS image_id, l_suppkey // 12 AS block, row, col, l_shipdate AS ts, "
              "l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN 1024 WHEN l_linenumber = 6 THEN 2048 ELSE 0 END AS qa, "
              + ", ".join(f"CAST({e.format(d='//')} AS INT) AS {b}" for b, e in BAND_EXPRESSIONS.items())
              + " FROM (SELECT *, l_orderkey % 64 AS row, l_partkey % 64 AS col FROM lineitem)"),
    "v_image_size": (("v_obs",), """SELECT DISTINCT image_id, 64::BIGINT AS height, CASE WHEN block % 2 = 1 THEN 80 ELSE 64 END::BIGINT AS width,
        CASE WHEN block % 2 = 1 THEN 100.0 ELSE 900.0 END::DOUBLE AS pixel_area_m2, CASE WHEN block % 2 = 1 THEN 10.0 ELSE 30.0 END::DOUBLE AS res_m FROM v_obs"""),
    "v_pixel": (("v_obs",), "SELECT image_id, block, row, col, "
                + ", ".join(f"median({b}) / 10000.0 AS {b}" for b in S.REFLECTANCE_BANDS)
                + f" FROM v_obs WHERE {CLEAR} GROUP BY image_id, block, row, col"),
    "v_indexed": (("v_pixel",), f"""
        SELECT *, {nd('NIR', 'RED')} AS NDVI, {nd('SWIR1', 'NIR')} AS NDBI, {nd('GREEN', 'SWIR1')} AS MNDWI, {BSI} AS BSI
        FROM v_pixel"""),
    "v_road": (("v_indexed",), f"""SELECT image_id, row, col FROM v_indexed WHERE {VALID}
        AND NDVI < 0.25 AND MNDWI < -0.05 AND NDBI > -0.10"""),
    "v_industrial": (("v_pixel",), f"""SELECT image_id, row, col FROM v_pixel WHERE {VALID} AND SWIR1 > 0.18
        AND {nd_eps('SWIR1', 'NIR')} > 0.05 AND {nd_eps('NIR', 'RED')} < 0.25 AND {nd_eps('GREEN', 'SWIR1')} < -0.05"""),
    "v_water": (("v_pixel",), f"""SELECT image_id, row, col FROM v_pixel WHERE {VALID}
        AND {nd_eps('GREEN', 'SWIR1')} > 0.12 AND {nd_eps('NIR', 'RED')} < 0.15 AND GREEN > 0.04 AND SWIR1 < 0.10"""),
    "v_edge": ((), f"""
        SELECT 'S.' || s_suppkey AS gid, h.k AS k,
               CAST(cx + h.dx1 AS DOUBLE) AS x1, CAST(cy + h.dy1 AS DOUBLE) AS y1,
               CAST(cx + h.dx2 AS DOUBLE) AS x2, CAST(cy + h.dy2 AS DOUBLE) AS y2
        FROM (SELECT s_suppkey, 64 * (s_suppkey // 12) + 8 + s_suppkey * 7 % 48 AS cy, 8 + s_suppkey * 11 % 48 AS cx
              FROM supplier), (VALUES {_hexagon_rows()}) AS h(k, dy1, dx1, dy2, dx2)"""),
    "v_bounds": (("v_edge",), """SELECT gid, min(least(x1, x2)) AS minx, min(least(y1, y2)) AS miny,
        max(greatest(x1, x2)) AS maxx, max(greatest(y1, y2)) AS maxy FROM v_edge GROUP BY gid"""),
    "v_world": (("v_pixel",), "SELECT block * 64 + row AS row, col, " + ", ".join(S.REFLECTANCE_BANDS) + " FROM v_pixel"),
    "v_inside": (("v_world", "v_edge", "v_bounds"), """
        SELECT b.gid, p.row, p.col FROM v_world p
        JOIN v_bounds b ON p.row BETWEEN b.miny - 1 AND b.maxy AND p.col BETWEEN b.minx - 1 AND b.maxx
        JOIN v_edge e ON e.gid = b.gid AND least(e.y1, e.y2) <= p.row + 0.5 AND p.row + 0.5 < greatest(e.y1, e.y2)
          AND e.x1 + (p.row + 0.5 - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) > p.col + 0.5
        GROUP BY b.gid, p.row, p.col HAVING count(*) % 2 = 1"""),
    "v_point": ((), """
        SELECT event_id // 20 AS way_id, event_id % 20 AS seq,
               CASE event_type WHEN 'click' THEN 'primary' WHEN 'view' THEN 'trunk' ELSE 'residential' END AS class,
               CAST(event_id * 17 % 64 AS DOUBLE) + 0.37 AS x,
               CAST((event_id // 20) % 8 * 64 + event_id * 29 % 64 AS DOUBLE) + 0.41 AS y
        FROM events"""),
    "v_seg": (("v_point",), """
        SELECT a.way_id, a.seq, a.class, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
        FROM v_point a JOIN v_point b ON a.way_id = b.way_id AND a.seq + 1 = b.seq"""),
    "v_status": ((), """
        SELECT 'U.' || user_id AS gid_3, 'run_' || (user_id % 5) AS run_id, event_id AS seq, ts,
               CASE event_type WHEN 'purchase' THEN 'done' WHEN 'signup' THEN 'partial' WHEN 'click' THEN 'partial'
                    ELSE 'failed' END AS status,
               CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS attempts,
               CASE CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 WHEN 0 THEN 'HTTP 429 Too Many Requests'
                    WHEN 1 THEN 'Total request size (9 bytes) must be less than or equal to 8 bytes'
                    WHEN 2 THEN 'HTTP 403 Forbidden' WHEN 3 THEN '' ELSE 'read timed out' END AS errors
        FROM events"""),
    "v_manifest": (("v_unit",), """
        SELECT CASE WHEN o_orderkey % 11 = 0 THEN kind_dir || '/plan_' || o_orderkey || '.json'
                    ELSE (CASE WHEN o_orderkey % 13 = 0 THEN 'Day' ELSE kind_dir END) || '/' || gid_1 || '/' ||
                         replace(gid_3, '.', '_') || '_' || lower(kind_dir) || '_' || year(o_orderdate) ||
                         lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '.tif' END AS path,
               o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS size, o_orderdate AS mtime,
               'h' || (o_orderkey % 97) AS hash, CAST(1 AS BIGINT) AS version,
               CASE WHEN o_orderkey % 17 = 0 THEN 6 WHEN kind_dir = 'Day' THEN 10 ELSE 2 END AS bands,
               CASE WHEN o_orderkey % 19 = 0 THEN 3857 ELSE 4326 END AS epsg,
               (CASE WHEN o_orderkey % 23 = 0 THEN 1.02 ELSE 1.0 END) * (CASE WHEN kind_dir = 'Day' THEN 20 ELSE 500 END)
                 / 111319.49079327357 AS step,
               CASE WHEN o_orderkey % 29 = 0 THEN 'float32' WHEN o_orderkey % 31 = 0 THEN 'int16' ELSE 'float64' END AS dtype
        FROM (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN 'Day' ELSE 'Night' END AS kind_dir FROM orders) o
        JOIN v_unit ON o_custkey = custkey"""),
    "v_named": (("v_manifest", "v_admin"), f"""
        SELECT a.gid_3, regexp_extract(m.path, '_(day|night)_', 1) AS kind,
               CAST(regexp_extract(m.path, '_{YEAR}(\\d\\d)\\.tif$', 1) AS BIGINT) AS month, m.*
        FROM v_manifest m JOIN v_admin a
          ON regexp_extract(m.path, '([^/]+)_(day|night)_{YEAR}(0[1-9]|1[0-2])\\.tif$', 1) = replace(a.gid_3, '.', '_')
        WHERE lower(split_part(m.path, '/', 1)) = regexp_extract(m.path, '_(day|night)_{YEAR}', 1)"""),
    "v_checked": (("v_named",), f"""
        SELECT *, CASE WHEN error = '' THEN 'done' ELSE 'failed' END AS state FROM (
            SELECT *, CASE WHEN bands <> (CASE kind WHEN 'day' THEN 10 ELSE 2 END) OR epsg <> 4326 THEN '{S.MSG_BANDS_CRS}'
                WHEN abs(step * 111319.49079327357 - (CASE kind WHEN 'day' THEN 20 ELSE 500 END))
                     > (CASE kind WHEN 'day' THEN 20 ELSE 500 END) * 0.01 THEN '{S.MSG_RESOLUTION}'
                WHEN kind = 'night' AND dtype <> 'float64' THEN '{S.MSG_NIGHT_DTYPE}'
                WHEN kind = 'day' AND dtype NOT LIKE 'float%' THEN '{S.MSG_DAY_DTYPE}' ELSE '' END AS error FROM v_named)"""),
    "v_images": (("v_checked",), f"""
        SELECT kind, gid_3, month, CASE WHEN count(*) > 1 THEN 'failed' ELSE max(state) END AS state,
               CASE WHEN count(*) > 1 THEN '{S.MSG_SEVERAL_FILES}' ELSE max(error) END AS error
        FROM v_checked
        GROUP BY kind, gid_3, month"""),
    "v_grid": (("v_admin",), f"""SELECT gid_3, CAST({YEAR} AS BIGINT) AS year, m AS month
        FROM v_admin, (SELECT unnest(range(1, 13)) AS m)"""),
    "v_evidence": (("v_grid",), f"""
        SELECT gid_3, year, month, f AS field, CAST((length(gid_3) + month + i) % 4 AS DOUBLE) AS "count"
        FROM v_grid, (VALUES {', '.join(f"({i}, '{f}')" for i, f in enumerate(S.FIELDS))}) AS t(i, f)"""),
    "v_plan": (("v_unit",), """
        SELECT gid_3, m AS month, CAST((custkey + m) % 3 AS BIGINT) AS c0, CAST((custkey * 3 + m) % 4 AS BIGINT) AS c1,
               CAST((custkey + m * 5) % 5 AS BIGINT) AS c2 FROM v_unit, (SELECT unnest(range(1, 13)) AS m)"""),
}


def state_sql(kind, frame, zero):
    """SQL of the state machine over a completed frame with a zero-source flag column."""
    metrics = S.METRICS[kind]
    empty = " AND ".join(f'"{m}" IS NULL' for m in metrics)
    hole = " OR ".join(f'"{m}" IS NULL' for m in metrics if m != S.GROWTH)
    time = (f"WHEN coalesce(\"TIME\", '') <> '{YEAR}-' || lpad(CAST(month AS VARCHAR), 2, '0') THEN "
            if kind == "night" else None)
    def chain(zero_empty, zero_full, none, bad_time, broken, done):
        return (f"CASE WHEN {zero} AND {empty} THEN '{zero_empty}' WHEN {zero} THEN '{zero_full}' "
                f"WHEN {empty} THEN '{none}' " + (f"{time}'{bad_time}' " if time else "")
                + f"WHEN {hole} THEN '{broken}' ELSE '{done}' END")
    state = chain("no_source", "failed", "pending", "failed", "failed", "done")
    error = chain("", S.MSG_ZERO_SOURCE, S.MSG_NO_METRICS, S.MSG_TIME, S.MSG_MISSING, "")
    return f"SELECT gid_3, year, month, {state} AS state, {error} AS error FROM ({frame})"


def completed(table):
    """A metric view completed to twelve months per unit."""
    return f"SELECT * FROM v_grid LEFT JOIN {table} USING (gid_3, year, month)"


def flagged(table, field):
    """Completed table with its zero-source flag `z0`."""
    return (f"SELECT g.*, coalesce(v.\"count\" = 0, false) AS z0 FROM ({completed(table)}) g LEFT JOIN v_evidence v "
            f"ON v.gid_3 = g.gid_3 AND v.month = g.month AND v.field = '{field}'")


def components_sql(mask, conn, name="comp"):
    """CTEs that label the runs of a mask view: {name}(image_id, line, p0, p1, label)."""
    r = 1 if conn == 8 else 0
    return f"""
    {name}_runs AS (
        SELECT image_id, row AS line, min(col) AS p0, max(col) AS p1, row * 2147483648 + min(col) AS id
        FROM (SELECT image_id, row, col, col - row_number() OVER (PARTITION BY image_id, row ORDER BY col) AS g FROM {mask})
        GROUP BY image_id, row, g),
    {name}_edges AS (
        SELECT a.image_id, a.id AS u, b.id AS v FROM {name}_runs a JOIN {name}_runs b
          ON a.image_id = b.image_id AND abs(a.line - b.line) = 1 AND a.p0 - {r} <= b.p1 AND b.p0 <= a.p1 + {r}),
    {name}_walk AS (
        SELECT image_id, id, id AS l FROM {name}_runs
        UNION SELECT w.image_id, e.v, w.l FROM {name}_walk w JOIN {name}_edges e
          ON e.image_id = w.image_id AND e.u = w.id WHERE w.l < e.v),
    {name}_min AS (SELECT image_id, id, min(l) AS label FROM {name}_walk GROUP BY image_id, id),
    {name} AS (SELECT r.image_id, r.line, r.p0, r.p1, m.label FROM {name}_runs r JOIN {name}_min m USING (image_id, id))"""


def thinning_sql(mask, name):
    """CTEs that thin a mask of 64 x 64 pixels: {name}(image_id, row, col). The state is one list of cells per image, with a clear border."""
    side = 66
    near = [f"g[i {d:+d}]" for d in (-side, -side + 1, 1, side + 1, side, side - 1, -1, -side - 1)]
    turns = " + ".join(f"(1 - {a}) * {b}" for a, b in zip(near, near[1:] + near[:1]))
    north, east, south, west = near[0], near[2], near[4], near[6]

    def half(sides):
        open_side = " AND ".join("{} * {} * {} = 0".format(*s) for s in sides)
        return (f"list_transform(g, lambda v, i: CASE WHEN v = 1 AND {' + '.join(near)} BETWEEN 2 AND 6 AND {turns} = 1 AND {open_side} THEN 0 ELSE v END)")
    first, second = half([(north, east, south), (east, south, west)]), half([(north, east, west), (north, south, west)])
    return f"""
    {name}_walk AS (
        SELECT image_id, 0 AS step, list(coalesce(n, 0) ORDER BY i) AS g
        FROM (SELECT image_id, unnest(range({side * side})) AS i FROM (SELECT DISTINCT image_id FROM {mask}))
        LEFT JOIN (SELECT image_id, (row + 1) * {side} + col + 1 AS i, 1 AS n FROM {mask}) USING (image_id, i) GROUP BY image_id
        UNION ALL
        SELECT image_id, step + 1, g FROM (SELECT image_id, step, old, {second} AS g FROM (SELECT image_id, step, g AS old, {first} AS g FROM {name}_walk))
        WHERE g <> old),
    {name} AS (
        SELECT image_id, (i - 1) // {side} - 1 AS row, (i - 1) % {side} - 1 AS col FROM (
            SELECT image_id, arg_max(g, step) AS g FROM {name}_walk GROUP BY image_id), LATERAL (SELECT unnest(range(1, {side * side} + 1)) AS i) WHERE g[i] = 1)"""


def pixels_sql(runs, name):
    return f"{name} AS (SELECT image_id, line AS row, unnest(range(p0, p1 + 1)) AS col FROM {runs})"


def _needed(names, seen):
    for name in names:
        if name not in seen:
            _needed(VIEWS[name][0], seen)
            seen.append(name)
    return seen


def statement(views, body):
    """Full SQL text: the needed views as CTEs, then the body."""
    ctes = [f"{name} AS ({VIEWS[name][1].strip()})" for name in _needed(views, [])]
    body = body.strip()
    if not ctes:
        return body if body.upper().startswith("SELECT") else "WITH RECURSIVE " + body
    joined = ",\n".join(ctes)
    separator = "\n" if body.upper().startswith("SELECT") else ",\n"
    return f"WITH RECURSIVE {joined}{separator}{body}"
