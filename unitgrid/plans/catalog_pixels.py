"""Queries over scenes, observations and pixels, and over scalar functions."""

from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.functions import dates, grid, numbers, spectral, text
from unitgrid.operators import compare, contract, regions, scenes, zonal
from unitgrid.plans.registry import query, rounded
from unitgrid.plans.sqlviews import BSI, CLEAR, LIT, VALID, YEAR, nd, nd_eps
from unitgrid.plans.views import PIXEL_M2
from unitgrid.sources import readers

_BANDS = S.REFLECTANCE_BANDS
_BAND_LIST = ", ".join(_BANDS)


def _r(expr, name, digits=6):
    return f"round({expr}, {digits}) AS {name}"


# --- scenes -----------------------------------------------------------------------------------------------

@query("a9_read_scenes", "SELECT event_type, count(*) AS n, min(ts) AS first FROM events GROUP BY event_type")
def _(v):
    found = readers.read_scenes(v.spark, f"{v.dir}/events.parquet", ["event_type", "ts"])
    return found.groupBy("event_type").agg(F.count("*").alias("n"), F.min("ts").alias("first"))


@query("a10_read_pixels", """SELECT l_orderkey, l_linenumber, CASE WHEN l_tax <> 0.05 THEN l_tax * 0.5 END AS l_tax,
    CASE WHEN l_discount <> 0.05 THEN l_discount * 0.5 END AS l_discount FROM lineitem""")
def _(v):
    px = readers.read_pixels(v.spark, f"{v.dir}/lineitem.parquet", ["l_tax", "l_discount"], nodata=0.05, scale=0.5)
    return px.select("l_orderkey", "l_linenumber", "l_tax", "l_discount")


@query("c7_filter_month", """SELECT 'last_day' AS how, scene_id FROM v_scene WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31'
    UNION ALL SELECT 'next_month', scene_id FROM v_scene WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'""", ["v_scene"])
def _(v):
    part = lambda how: scenes.filter_month(v.scene, 2024, 1, how=how).select(F.lit(how).alias("how"), "scene_id")
    return part("last_day").union(part("next_month"))


@query("c8_cloud_filter_or_all", """SELECT scene_id, unit, collection FROM v_scene s WHERE cloud < 5 OR NOT EXISTS
    (SELECT 1 FROM v_scene o WHERE o.unit = s.unit AND o.collection = s.collection AND o.cloud < 5)""", ["v_scene"])
def _(v):
    return scenes.cloud_filter_or_all(v.scene, ["unit", "collection"], limit=5).select("scene_id", "unit", "collection")


@query("c9_cloud_filter", "SELECT scene_id FROM v_scene WHERE cloud < 70", ["v_scene"])
def _(v):
    return scenes.cloud_filter(v.scene).select("scene_id")


@query("c10_prefer_collection", """SELECT scene_id, unit, collection FROM v_scene s WHERE collection IN ('click', 'view') AND
    (collection = 'click' OR NOT EXISTS (SELECT 1 FROM v_scene o WHERE o.unit = s.unit AND o.collection = 'click'
      AND CAST(o.ts AS DATE) = CAST(s.ts AS DATE)))""", ["v_scene"])
def _(v):
    dated = v.scene.withColumn("day", F.col("ts").cast("date"))
    return scenes.prefer_collection(dated, ["unit", "day"], ["click", "view"]).select("scene_id", "unit", "collection")


@query("c11_route_sensor", """SELECT o_orderkey, CASE WHEN y <= 2011 THEN 'Landsat-5' WHEN y = 2012 THEN 'Landsat-7(SLC-off)' ELSE 'Landsat-8' END AS sensor,
    CASE WHEN y <= 2011 THEN 'LANDSAT/LT05/C02/T1_L2' WHEN y = 2012 THEN 'LANDSAT/LE07/C02/T1_L2' ELSE 'LANDSAT/LC08/C02/T1_L2' END AS source_collection
    FROM (SELECT o_orderkey, year(o_orderdate) + 11 AS y FROM orders)""")
def _(v):
    shifted = v.table("orders").select("o_orderkey", (F.year("o_orderdate") + 11).alias("year"))
    return scenes.route_sensor(shifted).select("o_orderkey", "sensor", "source_collection")


_COUNTS = """
    hit AS (SELECT 'U' AS k, s.unit, m, s.ts >= d AND s.ts < last_day(d) AS a,
              s.ts >= d - INTERVAL 15 DAY AND s.ts < last_day(d) + INTERVAL 15 DAY AS b,
              s.ts >= d - INTERVAL 30 DAY AND s.ts < last_day(d) + INTERVAL 30 DAY AS c
            FROM v_scene s, (SELECT m, make_date(2024, m, 1) AS d FROM (SELECT CAST(unnest(range(1, 13)) AS INT) AS m)))"""


@query("c12_window_class", _COUNTS + """ SELECT unit, CAST(m AS BIGINT) AS month, CASE WHEN count(*) FILTER (WHERE a) > 0 THEN 0
      WHEN count(*) FILTER (WHERE b) > 0 THEN 1 ELSE 2 END AS "window" FROM hit WHERE c GROUP BY unit, m""", ["v_scene"])
def _(v):
    counts = scenes.count_by_window(v.scene, 2024, unit="unit")
    return counts.select("unit", "month", scenes.window_class().alias("window"))


@query("c13_mask_qa", f"""SELECT l_orderkey, l_linenumber, row, col, CASE WHEN {CLEAR} THEN "RED" END AS "RED",
    CASE WHEN (qa & 27) = 0 THEN "NIR" END AS "NIR" FROM v_obs""", ["v_obs"])
def _(v):
    one = spectral.mask_qa(v.obs, ["RED"])
    return spectral.mask_qa(one, ["NIR"], bits=spectral.LANDSAT_CLOUD_BITS).select(
        "l_orderkey", "l_linenumber", "row", "col", "RED", "NIR")


@query("c14_valid_pixel", """SELECT seq, NOT isnan(r) AND r <> -9999 AND (r > 0 OR g > 0) AS ok FROM (
    SELECT seq, CASE seq % 4 WHEN 0 THEN 'nan'::DOUBLE WHEN 1 THEN -9999 ELSE attempts - 1.0 END AS r, attempts - 2.0 AS g FROM v_status)""",
       ["v_status"])
def _(v):
    m = F.col("seq") % 4
    r = F.when(m == 0, float("nan")).when(m == 1, -9999.0).otherwise(F.col("attempts") - 1.0)
    return v.status.select("seq", spectral.valid_pixel(r, F.col("attempts") - 2.0, F.lit(0.0), -9999.0).alias("ok"))


@query("d8_count_scenes", """
    pair AS (SELECT b.gid_3, s.ts FROM v_scene s JOIN v_box b ON s.minx <= b.maxx AND b.minx <= s.maxx AND s.miny <= b.maxy AND b.miny <= s.maxy),
    hit AS (SELECT gid_3, m, ts >= d AND ts < last_day(d) AS a, ts >= d - INTERVAL 15 DAY AND ts < last_day(d) + INTERVAL 15 DAY AS b,
              ts >= d - INTERVAL 30 DAY AND ts < last_day(d) + INTERVAL 30 DAY AS c
            FROM pair, (SELECT m, make_date(2024, m, 1) AS d FROM (SELECT CAST(unnest(range(1, 13)) AS INT) AS m)))
    SELECT u.gid_3, CAST(u.m AS BIGINT) AS month, count(*) FILTER (WHERE a) AS c0, count(*) FILTER (WHERE b) AS c1, count(*) FILTER (WHERE c) AS c2
    FROM (SELECT gid_3, CAST(unnest(range(1, 13)) AS INT) AS m FROM v_unit) u LEFT JOIN hit h ON h.gid_3 = u.gid_3 AND h.m = u.m GROUP BY u.gid_3, u.m""",
       ["v_scene", "v_box"])
def _(v):
    found = v.scene.select("scene_id", "ts", "minx", "miny", "maxx", "maxy")
    return scenes.count_scenes(found, v.box, 2024, cell=16)


# --- composites and zones ------------------------------------------------------------------------------------

@query("e1_zonal_stats", "SELECT image_id, " + ", ".join(
    f"{_r(f'avg({b})', b + '_mean')}, {_r(f'stddev_pop({b})', '\"' + b + '_stdDev\"')}" for b in S.DAY_BANDS) + " FROM v_indexed GROUP BY image_id",
       ["v_indexed"])
def _(v):
    return rounded(zonal.zonal_stats(v.indexed, ["image_id"], S.DAY_BANDS))


@query("e2_night_zonal", f"""SELECT gid_3, month, {_r('sum(avg_rad)', 'avg_rad_sum')}, {_r('avg(avg_rad)', 'avg_rad_mean')},
    {_r('stddev_pop(avg_rad)', '"avg_rad_stdDev"')}, {_r('min(avg_rad)', 'avg_rad_min')}, {_r('max(avg_rad)', 'avg_rad_max')},
    count(avg_rad) AS avg_rad_count, {_r(f'sum(CASE WHEN {LIT} THEN avg_rad END)', 'lit_rad')},
    count(*) FILTER (WHERE {LIT}) AS is_lit, {_r('avg(cf_cvg)', 'cf_cvg')} FROM v_px GROUP BY gid_3, month""", ["v_px"])
def _(v):
    return rounded(zonal.night_zonal(v.px, ["gid_3", "month"]))


@query("e2_night_summary", """SELECT gid_3, count(*) AS valid_pixel_count, round(sum(avg_rad), 4) AS ntl_sum, round(avg(avg_rad), 4) AS ntl_mean,
    round(stddev_pop(avg_rad), 4) AS ntl_std, round(min(avg_rad), 4) AS ntl_min, round(max(avg_rad), 4) AS ntl_max,
    round(stddev_pop(avg_rad) / avg(avg_rad), 4) AS spatial_cv, count(*) FILTER (WHERE avg_rad >= 1.5) AS lit_pixels,
    round(coalesce(sum(CASE WHEN avg_rad >= 1.5 THEN area_ha * CAST(977.31 AS DOUBLE) END), 0) / 1e4, 2) AS lit_area_ha,
    round(100.0::DOUBLE * count(*) FILTER (WHERE avg_rad >= 1.5) / count(*), 2) AS lit_ratio_pct,
    round(coalesce(sum(CASE WHEN avg_rad >= 1.5 THEN avg_rad END), 0), 4) AS lit_pop_proxy, round(avg(cf_cvg), 2) AS cloud_free_obs
    FROM v_px WHERE cf_cvg > 0 GROUP BY gid_3""", ["v_px"])
def _(v):
    return zonal.night_summary(v.px, ["gid_3"], F.col("area_ha") * 977.31)


@query("e3_composite_median", f"SELECT image_id, row, col, {', '.join(f'median({b}) AS {b}' for b in _BANDS)} FROM v_obs GROUP BY ALL",
       ["v_obs"])
def _(v):
    return zonal.composite(v.obs, ["image_id", "row", "col"], _BANDS, digital=True)


@query("e3_composite_large", """SELECT l_suppkey % 50 AS zone, median(CAST(l_extendedprice AS INTEGER) * 10) AS x,
    median(CAST(l_quantity AS BIGINT) * 4000000000) AS y FROM lineitem GROUP BY ALL""")
def _(v):
    obs = v.table("lineitem").select((F.col("l_suppkey") % 50).alias("zone"), (F.rint("l_extendedprice").cast("int") * 10).alias("x"),
                                     (F.rint("l_quantity").cast("long") * F.lit(4000000000)).alias("y"))
    return zonal.composite(obs, ["zone"], ["x", "y"])


@query("e3_composite_wide", """SELECT image_id, row, col, round(median(x), 9) AS x, round(median(y), 9) AS y FROM (
    SELECT 'w_' || (l_suppkey // 12) AS image_id, l_orderkey % 8 AS row, l_partkey % 8 AS col, l_extendedprice / 7 AS x,
           CASE WHEN l_linenumber > 2 THEN l_quantity / 3 END AS y FROM lineitem) GROUP BY ALL""")
def _(v):
    li = v.table("lineitem")
    obs = li.select(F.concat(F.lit("w_"), F.floor(F.col("l_suppkey") / 12).cast("string")).alias("image_id"),
                    (F.col("l_orderkey") % 8).alias("row"), (F.col("l_partkey") % 8).alias("col"),
                    (F.col("l_extendedprice") / 7).alias("x"),
                    F.when(F.col("l_linenumber") > 2, F.col("l_quantity") / 3).alias("y"))
    return rounded(zonal.composite(obs, ["image_id", "row", "col"], ["x", "y"]), 9)


@query("e4_composite_mean", f"SELECT image_id, row, col, {', '.join(_r(f'avg({b})', b) for b in _BANDS)} FROM v_obs GROUP BY ALL", ["v_obs"])
def _(v):
    return rounded(zonal.composite(v.obs, ["image_id", "row", "col"], _BANDS, how="mean"))


@query("e14_bounds", "SELECT * FROM v_bounds", ["v_bounds"])
def _(v):
    return v.bounds


_PAIR = """(SELECT image_id, row, col, "RED" AS a, CASE WHEN row % 5 <> 0 THEN "RED" + CASE WHEN image_id = 'img_0' THEN 0 ELSE col * 0.001::DOUBLE END END AS b FROM v_pixel)"""


@query("e16_diff_summary", f"""SELECT image_id, count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS both,
    count(*) FILTER (WHERE a IS NOT NULL AND b IS NULL) AS only_left, count(*) FILTER (WHERE a IS NULL AND b IS NOT NULL) AS only_right,
    {_r('max(abs(a - b))', 'max_abs_diff')} FROM {_PAIR} GROUP BY image_id""", ["v_pixel"])
def _(v):
    shift = F.when(F.col("image_id") == "img_0", 0.0).otherwise(F.col("col") * 0.001)
    pairs = v.pixel.select("image_id", F.col("RED").alias("a"), F.when(F.col("row") % 5 != 0, F.col("RED") + shift).alias("b"))
    return rounded(compare.diff_summary(pairs, "a", "b", ["image_id"]))


@query("e20_empty_bands", """SELECT image_id, row, count(*) FILTER (WHERE z <> 0 OR w <> 0) = 0 AS empty FROM (
    SELECT image_id, row, CASE WHEN row % 3 = 2 THEN "RED" ELSE 0 END AS z, CASE WHEN row % 3 = 1 THEN "NIR" END AS w FROM v_pixel) GROUP BY image_id, row""", ["v_pixel"])
def _(v):
    m = F.col("row") % 3
    pixels = v.pixel.withColumns({"z": F.when(m == 2, F.col("RED")).otherwise(0.0), "w": F.when(m == 1, F.col("NIR"))})
    return zonal.empty_images(pixels, ["image_id", "row"], ["z", "w"])


@query("e20_empty_images", """SELECT image_id, row, count(*) FILTER (WHERE z <> 0) = 0 AS empty FROM (
    SELECT image_id, row, CASE WHEN row % 3 = 0 THEN 0 WHEN row % 3 = 1 THEN NULL ELSE "RED" END AS z FROM v_pixel) GROUP BY image_id, row""", ["v_pixel"])
def _(v):
    m = F.col("row") % 3
    return zonal.empty_images(v.pixel.withColumn("z", F.when(m == 0, 0.0).when(m == 2, F.col("RED"))), ["image_id", "row"], "z")


@query("d12_compare_rasters", f"""
    a AS (SELECT * FROM v_pixel WHERE col < 60),
    b AS (SELECT image_id, row, col, "RED" + CASE WHEN block % 2 = 0 THEN 0 ELSE 0.001::DOUBLE END AS "RED", "NIR" FROM v_pixel WHERE row > 2),
    j AS (SELECT image_id, a."RED" AS ar, b."RED" AS br, greatest(abs(a."RED" - b."RED"), abs(a."NIR" - b."NIR")) AS d FROM a FULL JOIN b USING (image_id, row, col))
    SELECT image_id, count(*) FILTER (WHERE ar IS NOT NULL AND br IS NOT NULL) AS px_both, count(*) FILTER (WHERE br IS NULL) AS px_only_new,
      count(*) FILTER (WHERE ar IS NULL) AS px_only_old, {_r('max(d)', 'max_abs_diff')},
      CASE WHEN max(d) IS NULL THEN '{S.VERDICT_DISJOINT}' WHEN max(d) <= 1e-6 THEN '{S.VERDICT_SAME}' ELSE '{S.VERDICT_VALUES}' END AS verdict
    FROM j GROUP BY image_id""", ["v_pixel"])
def _(v):
    a = v.pixel.filter("col < 60")
    b = v.pixel.filter("row > 2").select("image_id", (F.col("row") - 2).alias("row"), (F.col("col") + 1).alias("col"),
                                         (F.col("RED") + F.when(F.col("block") % 2 == 0, 0.0).otherwise(0.001)).alias("RED"), "NIR")
    return rounded(compare.compare_rasters(a, b, ["RED", "NIR"], ["image_id"], d_row=2, d_col=-1).drop("null_mismatch"))


@query("d12_verify_rasters", f"""
    a AS (SELECT * FROM v_pixel WHERE block % 7 <> 6), b AS (SELECT image_id, block, row, col, "RED" + CASE block % 4 WHEN 0 THEN 0.001::DOUBLE WHEN 3 THEN 0.01::DOUBLE ELSE 0 END AS "RED",
      CASE WHEN block % 4 <> 1 OR (row + col) % 9 <> 0 THEN "NIR" END AS "NIR" FROM v_pixel WHERE block % 4 <> 2 OR (row * 5 + col) % 11 <> 0),
    e AS (SELECT image_id, greatest(min(a.row), min(b.row)) AS r0, least(max(a.row), max(b.row)) AS r1, greatest(min(a.col), min(b.col)) AS c0, least(max(a.col), max(b.col)) AS c1
      FROM (SELECT image_id, row, col FROM a) a FULL JOIN (SELECT image_id, row, col FROM b) b USING (image_id, row, col) GROUP BY image_id),
    j AS (SELECT image_id, coalesce(a.block, b.block) AS block, row, col, a."RED" AS ar, a."NIR" AS an, b."RED" AS br, b."NIR" AS bn FROM a FULL JOIN b USING (image_id, row, col)),
    s AS (SELECT image_id, max(block) AS block, CAST(coalesce(sum((ar IS NOT NULL AND br IS NOT NULL)::INT + (an IS NOT NULL AND bn IS NOT NULL)::INT) FILTER (WHERE row BETWEEN r0 AND r1 AND col BETWEEN c0 AND c1), 0) AS BIGINT) AS both,
      max(greatest(abs(ar - br), abs(an - bn))) AS d, count(ar) = 0 OR count(br) = 0 AS lone,
      CAST(coalesce(sum(((ar IS NULL) <> (br IS NULL))::INT + ((an IS NULL) <> (bn IS NULL))::INT) FILTER (WHERE row BETWEEN r0 AND r1 AND col BETWEEN c0 AND c1), 0) AS BIGINT) AS holes
      FROM j JOIN e USING (image_id) GROUP BY image_id),
    n AS (SELECT *, CASE WHEN lone THEN 'missing side' WHEN block % 11 = 8 THEN 'grid' WHEN "both" = 0 THEN 'no common value'
      WHEN d > CASE WHEN block % 2 = 0 THEN 0.0015 ELSE 0.000001 END THEN 'values' WHEN holes > 0 THEN 'nodata' ELSE '' END AS note FROM s)
    SELECT image_id, "both", {_r('d', 'max_abs_diff')}, holes AS null_mismatch,
      CASE WHEN note = '' THEN 'PASS' WHEN note IN ('missing side', 'nodata') THEN 'WARN' ELSE 'FAIL' END AS level, note FROM n""", ["v_pixel"])
def _(v):
    """Units that pass, warn and fail: shifted copies with other values, holes and absent sides."""
    at, block = (F.col("row"), F.col("col")), F.col("block")
    a = v.pixel.filter(block % 7 != 6)
    b = v.pixel.filter((block % 4 != 2) | ((at[0] * 5 + at[1]) % 11 != 0)).select(
        "image_id", (at[0] - block % 5).alias("row"), (at[1] + 1).alias("col"), (F.col("RED") + F.when(block % 4 == 0, 0.001).when(block % 4 == 3, 0.01).otherwise(0.0)).alias("RED"),
        F.when((block % 4 != 1) | ((at[0] + at[1]) % 9 != 0), F.col("NIR")).alias("NIR"))
    image = v.pixel.select("image_id", "block").distinct()
    offsets = image.select("image_id", (block % 5).alias("d_row"), F.lit(-1).alias("d_col"))
    grids = image.select("image_id", F.when(block % 11 == 8, S.VERDICT_GRID).alias("verdict"))
    tolerances = image.filter(block % 2 == 0).select("image_id", F.lit(0.0015).alias("tolerance"))
    return rounded(compare.verify_rasters(a, b, ["RED", "NIR"], ["image_id"], tolerances, 1e-6, offsets, grids))


@query("d12_grid_verdict", f"""SELECT o_orderkey, {_r('(ay - yb) / s', 'd_row')}, {_r('(bx - ax) / s', 'd_col')},
    CASE WHEN abs((ay - yb) / s - round((ay - yb) / s)) > 1e-3 OR abs((bx - ax) / s - round((bx - ax) / s)) > 1e-3 OR t <> s THEN '{S.VERDICT_GRID}' END AS verdict
    FROM (SELECT o_orderkey, 0.5::DOUBLE AS s, CASE WHEN o_orderkey % 7 = 0 THEN 0.6 ELSE 0.5 END::DOUBLE AS t, 105::DOUBLE AS ax, 21::DOUBLE AS ay,
      105 + o_orderkey % 9 * 0.5::DOUBLE + CASE WHEN o_orderkey % 5 = 0 THEN 0.1 ELSE 0 END::DOUBLE AS bx, 21 - o_orderkey % 4 * 0.5::DOUBLE AS yb FROM orders)""")
def _(v):
    k = F.col("o_orderkey")
    pairs = v.table("orders").select(
        "o_orderkey", F.lit(0.5).alias("s"), F.when(k % 7 == 0, 0.6).otherwise(0.5).alias("t"), F.lit(105.0).alias("ax"),
        F.lit(21.0).alias("ay"), (105 + k % 9 * 0.5 + F.when(k % 5 == 0, 0.1).otherwise(0.0)).alias("bx"), (21 - k % 4 * 0.5).alias("by"))
    return rounded(compare.grid_verdict(pairs, "ax", "bx", "ay", "by", "s", "t").select("o_orderkey", "d_row", "d_col", "verdict"))


# --- scalar functions ------------------------------------------------------------------------------------------

@query("i1_add_indices", f"SELECT image_id, row, col, {_r(nd('NIR', 'RED'), 'NDVI')}, {_r(nd('SWIR1', 'NIR'), 'NDBI')}, "
       f"{_r(nd('GREEN', 'SWIR1'), 'MNDWI')}, {_r(BSI, 'BSI')} FROM v_pixel", ["v_pixel"])
def _(v):
    return rounded(v.indexed.select("image_id", "row", "col", "NDVI", "NDBI", "MNDWI", "BSI"))


@query("i1_indices_shifted", f"SELECT l_orderkey, l_linenumber, {_r(nd('a', 'b'), 'masked')}, "
       f"{_r('CASE WHEN a + b + 1e-6 <> 0 THEN ' + nd_eps('a', 'b') + ' END', 'plain')} FROM (SELECT l_orderkey, l_linenumber, l_discount - 0.03 AS a, l_tax + 0.013 AS b FROM lineitem)")
def _(v):
    li = v.table("lineitem").select("l_orderkey", "l_linenumber", (F.col("l_discount") - 0.03).alias("a"), (F.col("l_tax") + 0.013).alias("b"))
    return rounded(li.select("l_orderkey", "l_linenumber", spectral.normalized_difference("a", "b").alias("masked"),
                             spectral.normalized_difference("a", "b", 1e-6, False).alias("plain")))


@query("i2_scale_reflectance", """SELECT l_orderkey, l_linenumber, row, col, round("RED" / 10000.0, 6) AS s2, round("RED" * 0.0000275::DOUBLE - 0.2::DOUBLE, 6) AS landsat FROM v_obs""", ["v_obs"])
def _(v):
    obs = v.obs.withColumns({"s2": F.col("RED"), "landsat": F.col("RED")})
    out = spectral.scale_reflectance(spectral.scale_reflectance(obs, ["s2"]), ["landsat"], "Landsat")
    return rounded(out.select("l_orderkey", "l_linenumber", "row", "col", "s2", "landsat"))


@query("i3_rename_bands", f"SELECT l_orderkey, l_linenumber, {_BAND_LIST} FROM v_obs", ["v_obs"])
def _(v):
    raw = v.obs.select("l_orderkey", "l_linenumber", *[F.col(new).alias(old) for old, new in spectral.SENSOR_BANDS["Landsat-8"].items()])
    return spectral.rename_bands(raw, "Landsat-8")


@query("i4_lit_mask", "SELECT gid_3, month, avg_rad >= 1.5 AS viirs, avg_rad >= 5 AS dmsp, count(*) AS n FROM v_px GROUP BY ALL", ["v_px"])
def _(v):
    return v.px.groupBy("gid_3", "month", spectral.is_lit("avg_rad").alias("viirs"),
                        spectral.is_lit("avg_rad", "DMSP-OLS").alias("dmsp")).agg(F.count("*").alias("n"))


@query("i5_night_indices", "SELECT * FROM v_ind", ["v_ind"])
def _(v):
    return zonal.night_indices(v.long, YEAR)


@query("i6_parse_double", "SELECT seq, TRY_CAST(nullif(trim(errors), '') AS DOUBLE) AS a, CASE seq % 3 WHEN 0 THEN seq * 0.5::DOUBLE END AS b FROM v_status", ["v_status"])
def _(v):
    m = F.col("seq") % 3
    txt = F.when(m == 0, (F.col("seq") * 0.5).cast("string")).when(m == 1, "NaN")
    return v.status.select("seq", numbers.parse_double("errors").alias("a"), numbers.parse_double(txt).alias("b"))


@query("i7_time_stamp", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS stamp FROM orders""")
def _(v):
    return v.table("orders").select("o_orderkey", text.time_stamp(F.year("o_orderdate"), F.month("o_orderdate")).alias("stamp"))


@query("i8_month_windows", """SELECT o_orderkey, CAST(d AS VARCHAR) AS start, CAST(last_day(d) AS VARCHAR) AS last_day_end, CAST(CAST(d + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS next_end,
    CAST(CAST(d - INTERVAL 15 DAY AS DATE) AS VARCHAR) AS w1_start, CAST(CAST(last_day(d) + INTERVAL 30 DAY AS DATE) AS VARCHAR) AS w2_end,
    year(d) * 12 + month(d) AS month_id, datediff('month', DATE '1995-01-01', d) + 1 AS months
    FROM (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders)""")
def _(v):
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    s = lambda c: c.cast("string")
    return v.table("orders").select(
        "o_orderkey", s(dates.month_start(y, m)).alias("start"), s(dates.month_end(y, m)).alias("last_day_end"),
        s(dates.month_end(y, m, "next_month")).alias("next_end"), s(dates.window_bounds(y, m, 15)[0]).alias("w1_start"),
        s(dates.window_bounds(y, m, 30)[1]).alias("w2_end"), dates.month_id(y, m).alias("month_id"),
        F.size(dates.month_sequence(F.lit("1995-01-01").cast("date"), F.col("o_orderdate").cast("date"))).alias("months"))


_PLAIN = "replace(replace(strip_accents({0}), 'đ', 'd'), 'Đ', 'D')"
_CAMEL = "list_reduce(list_transform(regexp_extract_all({0}, '[A-Za-z0-9]+'), lambda w: upper(w[1]) || lower(w[2:])), lambda a, b: a || b)"


@query("i9_slug", f"""SELECT gid_3, lower(regexp_replace({_PLAIN.format('name_3')}, '[^a-zA-Z0-9]', '', 'g')) AS joined,
    lower(trim(regexp_replace({_PLAIN.format('name_1')}, '[^a-zA-Z0-9]+', '_', 'g'), '_')) AS underscored,
    {_CAMEL.format(_PLAIN.format('name_3'))} AS camel FROM v_admin""", ["v_admin"])
def _(v):
    return v.admin.select("gid_3", text.slug("name_3", "joined").alias("joined"), text.slug("name_1").alias("underscored"),
                          text.slug("name_3", "camel").alias("camel"))


_FULL = "CASE WHEN lower(type_3) = 'nan' THEN name_3 ELSE type_3 || ' ' || name_3 END"


@query("i10_full_name", f"SELECT gid_3, {_FULL} AS full_name FROM v_admin", ["v_admin"])
def _(v):
    return v.admin.select("gid_3", text.full_name().alias("full_name"))


_SLUG = "lower(trim(regexp_replace({0}, '[^a-zA-Z0-9]+', '_', 'g'), '_'))"


@query("i11_names", f"""SELECT gid_3, 'Day/' || gid_1 || '_' || {_SLUG.format(_PLAIN.format('name_1'))} || '/' || gid_3 || '_' || {_SLUG.format(_PLAIN.format(_FULL))} AS day_dir,
    replace(gid_3, '.', '_') || '_night_202403.tif' AS image, 'day_csv_' || replace(gid_1, '.', '-') AS province,
    'day_img_202411_w2' AS grp, {_CAMEL.format(_PLAIN.format('name_1'))} || '_' || {_CAMEL.format(_PLAIN.format(_FULL))} || '_' || gid_3 AS stem FROM v_admin""", ["v_admin"])
def _(v):
    return v.admin.select("gid_3", text.unit_dir("day").alias("day_dir"),
                          text.image_name("gid_3", F.lit("night"), F.lit(2024), F.lit(3)).alias("image"),
                          text.province_prefix("day").alias("province"),
                          text.group_prefix("day", F.lit(2024), F.lit(11), F.lit(2)).alias("grp"), text.stem().alias("stem"))


@query("i12_quantise", """SELECT seq, CAST(CASE WHEN q IS NULL THEN -32768 ELSE greatest(least(q, 32767), -32767) END AS SMALLINT) AS code, coalesce(abs(q) > 32767, false) AS over,
    CASE WHEN q IS NOT NULL THEN round(greatest(least(q, 32767), -32767) * (1.0::DOUBLE / 10000), 6) END AS back FROM (
    SELECT seq, round_even(x * 10000, 0) AS q FROM (SELECT seq, CASE WHEN seq % 9 <> 0 THEN (attempts - 2) * 1.23457::DOUBLE + seq * 0.00031::DOUBLE END AS x FROM v_status))""", ["v_status"])
def _(v):
    x = F.when(F.col("seq") % 9 != 0, (F.col("attempts") - 2) * 1.23457 + F.col("seq") * 0.00031)
    rows = v.status.select("seq", x.alias("x")).withColumns({"code": numbers.quantise("x"), "over": numbers.overflows("x")})
    return rounded(rows.select("seq", "code", "over", numbers.dequantise("code").alias("back")))


@query("i13_grid_maths", f"""SELECT custkey, CAST(floor((21 - lat) / s) AS BIGINT) AS r, CAST(floor((lon - 105) / s) AS BIGINT) AS c,
    CAST(floor((21 - (lat + h)) / s + 1e-9) AS BIGINT) AS r0, CAST(CASE WHEN h = 0 THEN floor((21 - (lat + h)) / s + 1e-9) + 1 ELSE ceil((21 - lat) / s - 1e-9) END AS BIGINT) AS r1,
    CAST(floor((lon - 105) / s + 1e-9) AS BIGINT) AS c0, CAST(CASE WHEN h = 0 THEN floor((lon - 105) / s + 1e-9) + 1 ELSE ceil((lon + h - 105) / s - 1e-9) END AS BIGINT) AS c1
    FROM (SELECT custkey, 20 / {grid.METRES_PER_DEGREE!r}::DOUBLE AS s, 105 + custkey * 0.00071::DOUBLE AS lon, 20 - custkey * 0.00053::DOUBLE AS lat,
      CASE WHEN custkey % 4 = 0 THEN 0 ELSE 0.0123 END::DOUBLE AS h FROM v_unit)""", ["v_unit"])
def _(v):
    k = F.col("custkey")
    pts = v.unit.select("custkey", (105 + k * 0.00071).alias("lon"), (20 - k * 0.00053).alias("lat"),
                        F.when(k % 4 == 0, 0.0).otherwise(0.0123).alias("h"))
    window = grid.pixel_window("lon", "lat", F.col("lon") + F.col("h"), F.col("lat") + F.col("h"), 105.0, 21.0, grid.STEP_20M)
    return pts.select("custkey", grid.row_of("lat", 21.0, grid.STEP_20M).alias("r"),
                      grid.col_of("lon", 105.0, grid.STEP_20M).alias("c"), *[e.alias(n) for n, e in window.items()])


_TERM = ("({b2} / 2) * (sin(radians({p})) / (1 - {e2} * sin(radians({p})) ** 2) + ln((1 + {e} * sin(radians({p}))) / (1 - {e} * sin(radians({p})))) / (2 * {e}))")


def _term(p):
    return _TERM.format(p=p, b2=f"{grid.SEMI_MINOR ** 2!r}::DOUBLE", e2=f"{grid.E2!r}::DOUBLE", e=f"{grid.E2 ** 0.5!r}::DOUBLE")


@query("i14_cell_area", f"""SELECT custkey, round(abs({_term('top')} - {_term('(top - s)')}) * radians(s), 3) AS area, round(30::DOUBLE * custkey, 3) AS flat
    FROM (SELECT custkey, custkey % 140 - 70 + 0.25::DOUBLE AS top, {grid.STEP_500M!r}::DOUBLE AS s FROM v_unit)""", ["v_unit"])
def _(v):
    top = F.col("custkey") % 140 - 70 + 0.25
    return rounded(v.unit.select("custkey", grid.cell_area(top, top - grid.STEP_500M, F.lit(grid.STEP_500M)).alias("area"),
                                 grid.projected_cell_area(F.lit(-30.0), F.col("custkey").cast("double")).alias("flat")), 3)


@query("i15_is_finite", "SELECT seq, seq % 4 > 2 AS ok FROM v_status", ["v_status"])
def _(v):
    m = F.col("seq") % 4
    x = F.when(m == 0, float("nan")).when(m == 1, float("inf")).when(m == 3, F.col("seq") * 1.0)
    return v.status.select("seq", numbers.is_finite(x).alias("ok"))


@query("i16_land_cover_masks", """SELECT 'road' AS mask, image_id, row, col FROM v_road UNION ALL SELECT 'industrial', image_id, row, col FROM v_industrial
    UNION ALL SELECT 'water', image_id, row, col FROM v_water""", ["v_road", "v_industrial", "v_water"])
def _(v):
    tag = lambda name, df: df.select(F.lit(name).alias("mask"), "image_id", "row", "col")
    return tag("road", v.road).union(tag("industrial", v.industrial)).union(tag("water", v.water))


@query("i17_shares", """SELECT gid_3, round(CASE WHEN a > 0 THEN l / (a / 100) END, 6) AS road_density_km_per_km2,
    round(CASE WHEN a > 0 THEN 100 * i / a END, 6) AS industrial_share_pct, round(CASE WHEN a > 0 THEN 100 * w / a END, 6) AS water_share_pct
    FROM (SELECT gid_3, (custkey % 50)::DOUBLE AS a, custkey % 7 * 1.1::DOUBLE AS l, custkey % 11 * 0.3::DOUBLE AS i, custkey % 13 * 0.7::DOUBLE AS w FROM v_unit)""", ["v_unit"])
def _(v):
    k = F.col("custkey")
    rows = v.unit.select("gid_3", (k % 50).cast("double").alias("valid_area_ha"), (k % 7 * 1.1).alias("road_length_km"),
                         (k % 11 * 0.3).alias("industrial_area_ha"), (k % 13 * 0.7).alias("water_area_ha"))
    return rounded(regions.shares(rows).select("gid_3", "road_density_km_per_km2", "industrial_share_pct", "water_share_pct"))


@query("i18_json_fields", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def _(v):
    return v.table("events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("i19_error_class", """SELECT seq, CASE WHEN errors LIKE '%429%' THEN 'rate_limited' WHEN errors LIKE '%request size%' THEN 'too_large'
    WHEN errors LIKE '%403%' THEN 'permanent' ELSE 'transient' END AS class FROM v_status""", ["v_status"])
def _(v):
    return v.status.select("seq", text.error_class("errors").alias("class"))
