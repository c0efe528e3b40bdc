"""Queries over polygons, lines, tiles and regions."""

from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.functions import grid, spectral
from unitgrid.operators import contract, geometry, regions
from unitgrid.plans import imagecut
from unitgrid.plans.images import analyze_images
from unitgrid.plans.registry import query, rounded
from unitgrid.plans.sqlviews import VALID, components_sql, pixels_sql, thinning_sql
from unitgrid.plans.views import SIZE
from unitgrid.session import materialize, scratch_path
from unitgrid.sources import readers, writers

_LABEL = "label // 2147483648 AS label_row, label % 2147483648 AS label_col"


def _features(v):
    """One GeoJSON feature per supplier, in three geometry types."""
    e = v.edge.filter("k < 6")
    ring = F.transform(F.sort_array(F.collect_list(F.struct("k", F.array("x1", "y1").alias("p")))), lambda s: s["p"])
    rings = e.groupBy("gid").agg(ring.alias("r")).select("gid", F.concat("r", F.slice("r", 1, 1)).alias("r"))
    n = F.substring("gid", 3, 20).cast("int") % 3
    polygon = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array("r").alias("coordinates")))
    multi = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array("r")).alias("coordinates")))
    wrapped = F.concat(F.lit('{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":[0,0]},'), polygon, F.lit("]}"))
    wrapped = F.concat(F.lit('{"type":"GeometryCollection","geometries":[{"type":"GeometryCollection","geometries":['), wrapped, F.lit("]}]}"))
    return rings.select("gid", F.when(n == 0, polygon).when(n == 1, multi).otherwise(wrapped).alias("geometry"))


@query("a6_read_polygons", "SELECT gid, x1, y1, x2, y2 FROM v_edge", ["v_edge"])
def _(v):
    path = scratch_path(v.spark, "features")
    text = F.concat(F.lit('{"type":"Feature","properties":{"GID_3":"'), "gid", F.lit('"},"geometry":'), "geometry", F.lit("}"))
    _features(v).select(text.alias("value")).write.text(path)
    return readers.read_polygons(v.spark, path, lines=True).select("gid", "x1", "y1", "x2", "y2")


@query("a6_repeated_features", 'SELECT gid, row, col, "RED" FROM v_inside JOIN v_world USING (row, col)', ["v_inside", "v_world"])
def _(v):
    """Every feature twice in one file and once more in another: the same pixels as once."""
    path = scratch_path(v.spark, "features")
    entry = F.concat(F.lit('{"type":"Feature","properties":{"GID_3":"'), "gid", F.lit('"},"geometry":'), "geometry", F.lit("}"))
    rows = _features(v).select(entry.alias("f"), F.crc32(F.col("gid").cast("binary")).alias("h"))
    for times, folder in ((2, "a"), (1, "b")):
        files = rows.select(F.explode(F.array_repeat("f", times)).alias("f"), (F.col("h") % 7).alias("file")).groupBy("file").agg(F.array_join(F.collect_list("f"), ",").alias("fs"))
        files.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), "fs", F.lit("]}")).alias("value")).repartitionByRange(7, "value").write.option("maxRecordsPerFile", 1).text(f"{path}/{folder}")
    edges = readers.read_polygons(v.spark, [f"{path}/a", f"{path}/b"])
    return geometry.clip_pixels(v.world, geometry.polygon_spans(edges)).select("gid", "row", "col", "RED")


@query("d9_required_tiles", """SELECT gid, CAST(tr * 16 AS BIGINT) AS tile_row, CAST(tc * 16 AS BIGINT) AS tile_col FROM (
    SELECT gid, unnest(range(CAST(miny AS BIGINT) // 16, (CAST(maxy AS BIGINT) - 1) // 16 + 1)) AS tr, minx, maxx FROM v_bounds),
    LATERAL (SELECT unnest(range(CAST(minx AS BIGINT) // 16, (CAST(maxx AS BIGINT) - 1) // 16 + 1)) AS tc)""", ["v_bounds"])
def _(v):
    return geometry.required_tiles(geometry.windows(v.bounds, y_down=True), 16)


@query("d9_missing_tiles", """SELECT gid, CAST(tr * 16 AS BIGINT) AS tile_row, CAST(tc * 16 AS BIGINT) AS tile_col FROM (
    SELECT gid, unnest(range(CAST(miny AS BIGINT) // 16, (CAST(maxy AS BIGINT) - 1) // 16 + 1)) AS tr, minx, maxx FROM v_bounds),
    LATERAL (SELECT unnest(range(CAST(minx AS BIGINT) // 16, (CAST(maxx AS BIGINT) - 1) // 16 + 1)) AS tc)
    WHERE (tr * 16, tc * 16) NOT IN (SELECT row // 16 * 16, col // 16 * 16 FROM v_world WHERE col < 40)""", ["v_bounds", "v_world"])
def _(v):
    need = geometry.required_tiles(geometry.windows(v.bounds, y_down=True), 16)
    have = v.world.filter("col < 40").select((F.floor(F.col("row") / 16) * 16).alias("tile_row"),
                                             (F.floor(F.col("col") / 16) * 16).alias("tile_col")).distinct()
    return geometry.missing_tiles(need, have)


@query("d9_untiled_file", """SELECT gid, t AS tile_row, t AS tile_col FROM v_bounds, LATERAL (SELECT unnest(
    CASE WHEN miny < 0 OR minx < 0 OR maxy > 300 OR maxx > 50 THEN [0::BIGINT, -1::BIGINT] ELSE [0::BIGINT] END) AS t)""", ["v_bounds"])
def _(v):
    return geometry.required_whole(geometry.windows(v.bounds, y_down=True), 300, 50)


@query("d10_tiled_store", 'SELECT gid, row, col, "RED", "NIR" FROM v_inside JOIN v_world USING (row, col)', ["v_inside", "v_world"])
def _(v):
    """The cut from a store partitioned by tile; only the tiles that the boxes cross are read."""
    path = scratch_path(v.spark, "pixel-tiles")
    writers.write_pixel_tiles(v.world, path, 16)
    store = readers.read_pixel_tiles(v.spark, path, v.world.schema.add("tile_row", "long").add("tile_col", "long"))
    needed = geometry.needed_tiles(geometry.required_tiles(geometry.windows(v.bounds, y_down=True), 16))
    cut = geometry.clip_pixels(geometry.pixels_of_tiles(store, needed), geometry.polygon_spans(v.edge))
    return cut.select("gid", "row", "col", "RED", "NIR")


@query("d10_clip_pixels", 'SELECT gid, row, col, "RED", "NIR" FROM v_inside JOIN v_world USING (row, col)', ["v_inside", "v_world"])
def _(v):
    return geometry.clip_pixels(v.world, geometry.polygon_spans(v.edge)).select("gid", "row", "col", "RED", "NIR")


@query("d10_clip_zonal", 'SELECT gid, count(*) AS n, round(avg("RED"), 9) AS red FROM v_inside JOIN v_world USING (row, col) GROUP BY gid', ["v_inside", "v_world"])
def _(v):
    cut = geometry.clip_pixels(v.world, geometry.polygon_spans(v.edge))
    return rounded(cut.groupBy("gid").agg(F.count("*").alias("n"), F.avg("RED").alias("red")), 9)


@query("d10_cut_windows", """SELECT b.gid, p.row, p.col, i.gid IS NOT NULL AS inside, CASE WHEN i.gid IS NOT NULL THEN p."RED" END AS "RED"
    FROM v_world p JOIN v_bounds b ON p.row >= b.miny AND p.row < b.maxy AND p.col >= b.minx AND p.col < b.maxx
    LEFT JOIN v_inside i ON i.gid = b.gid AND i.row = p.row AND i.col = p.col""", ["v_inside", "v_world", "v_bounds"])
def _(v):
    boxes = geometry.windows(v.bounds, y_down=True)
    out = geometry.cut_windows(v.world, boxes, geometry.polygon_spans(v.edge), ["RED"])
    return out.select("gid", "row", "col", "inside", "RED")


_CUT_SQL = f"""
    store AS (SELECT 'p_' || (l_linenumber % 3) AS prefix, row, col, avg("RED") AS red FROM (SELECT * REPLACE (block * 64 + row AS row) FROM v_obs WHERE (qa & 3072) = 0) GROUP BY ALL),
    present AS (SELECT DISTINCT prefix, row // 16 AS tr, col // 16 AS tc FROM store WHERE (row // 16 * 3 + col // 16 * 5 + l(prefix)) % 17 <> 0),
    need AS (SELECT 'p_' || p AS prefix, gid, CAST(substr(gid, 3) AS BIGINT) AS k, (CAST(substr(gid, 3) AS BIGINT) + p) % 7 = 0 AS had FROM v_bounds, (VALUES (0), (1), (2)) AS t(p)),
    tiles AS (SELECT gid, tr, tc FROM (SELECT gid, unnest(range(CAST(miny AS BIGINT) // 16, (CAST(maxy AS BIGINT) - 1) // 16 + 1)) AS tr, minx, maxx FROM v_bounds),
      LATERAL (SELECT unnest(range(CAST(minx AS BIGINT) // 16, (CAST(maxx AS BIGINT) - 1) // 16 + 1)) AS tc)),
    gaps AS (SELECT prefix, gid, count(*) FILTER (WHERE (prefix, tr, tc) NOT IN (SELECT prefix, tr, tc FROM present)) AS gaps FROM need JOIN tiles USING (gid) GROUP BY ALL),
    states AS (SELECT prefix, gid, had, CASE WHEN had THEN '' WHEN k % 13 = 5 THEN '{S.MSG_NO_GEOMETRY}' WHEN gaps > 0 THEN '{S.MSG_TILES_MISSING}'
      WHEN prefix = 'p_2' THEN '{S.MSG_RESOLUTION}' ELSE '' END AS error FROM need JOIN gaps USING (prefix, gid))""".replace("l(prefix)", "CAST(substr(prefix, 3) AS BIGINT)")


def _cut_inputs(v):
    """Three exports over one grid, the third of wrong resolution; some tiles, boundaries and images are absent or there already."""
    number = F.substring("gid", 3, 20).cast("long")
    clear = v.obs.filter(spectral.is_clear("qa")).withColumns({"row": F.col("block") * SIZE + F.col("row"), "prefix": F.concat(F.lit("p_"), (F.col("l_linenumber") % 3).cast("string"))})
    tile = {f"tile_{c}": F.floor(F.col(c) / 16) * 16 for c in ("row", "col")}
    store = clear.groupBy("prefix", "row", "col").agg(F.avg("RED").alias("red")).withColumns(tile)
    gone = (F.col("tile_row") / 16 * 3 + F.col("tile_col") / 16 * 5 + F.substring("prefix", 3, 20).cast("long")) % 17 == 0
    present = store.filter(~gone).select("prefix", "tile_row", "tile_col").distinct()
    need = v.bounds.select("gid", F.explode(F.array(*[F.lit(p) for p in range(3)])).alias("p")).select(
        F.concat(F.lit("p_"), F.col("p").cast("string")).alias("prefix"), "gid", ((number + F.col("p")) % 7 == 0).alias("had"))
    boxes = geometry.windows(v.bounds.filter(number % 13 != 5), y_down=True)
    step = grid.STEP_500M * F.when(F.col("prefix") == "p_2", 1.5).otherwise(1.0)
    images = contract.check_images(store.select("prefix").distinct().select(
        "prefix", F.lit("night").alias("kind"), F.lit(2).alias("bands"), F.lit(4326).alias("epsg"), step.alias("step_x"), (-step).alias("step_y"),
        F.lit(0.0).alias("rot_x"), F.lit(0.0).alias("rot_y"), F.lit("float64").alias("dtype")))
    return need, boxes, present, images, store


@query("k9_cut_states", _CUT_SQL + """ SELECT prefix, gid, had, CASE WHEN error = '' THEN 'done' ELSE 'failed' END AS state, error, NOT had AND error = '' AS cut FROM states""",
       ["v_obs", "v_bounds"])
def _(v):
    need, boxes, present, images, _ = _cut_inputs(v)
    return imagecut.cut_states(need, boxes, present, images, 16)


@query("k9_cut_images", _CUT_SQL + """ SELECT prefix, gid, count(*) AS pixels, round(avg(red), 6) AS red FROM states JOIN v_inside USING (gid) JOIN store USING (prefix, row, col)
    WHERE NOT had AND error = '' GROUP BY prefix, gid""", ["v_obs", "v_inside"])
def _(v):
    need, boxes, present, images, store = _cut_inputs(v)
    states = imagecut.cut_states(need, boxes, present, images, 16)
    cut = imagecut.cut_pixels(states, boxes, geometry.polygon_spans(v.edge), store, 16)
    return rounded(cut.groupBy("prefix", "gid").agg(F.count("*").alias("pixels"), F.avg("red").alias("red")))


@query("k9_cut_outcomes", _CUT_SQL + f""" SELECT prefix, count(*) AS units, count(*) FILTER (WHERE had) AS had, count(*) FILTER (WHERE NOT had AND error = '') AS cut,
    count(*) FILTER (WHERE error <> '') AS failed, CASE WHEN count(*) FILTER (WHERE error = '{S.MSG_NO_GEOMETRY}') > 0 THEN 'failed' WHEN count(*) FILTER (WHERE error <> '') > 0
    THEN 'partial' ELSE 'done' END AS state FROM states GROUP BY prefix""", ["v_obs", "v_bounds"])
def _(v):
    need, boxes, present, images, _ = _cut_inputs(v)
    return imagecut.group_outcomes(imagecut.cut_states(need, boxes, present, images, 16))


@query("d13_clip_line_length", """
    cand AS (SELECT b.gid, s.* FROM v_seg s JOIN v_bounds b ON least(s.x1, s.x2) <= b.maxx AND b.minx <= greatest(s.x1, s.x2)
             AND least(s.y1, s.y2) <= b.maxy AND b.miny <= greatest(s.y1, s.y2)),
    cross_t AS (SELECT c.gid, c.way_id, c.seq, ((e.x1 - c.x1) * (e.y2 - e.y1) - (e.y1 - c.y1) * (e.x2 - e.x1)) /
               ((c.x2 - c.x1) * (e.y2 - e.y1) - (c.y2 - c.y1) * (e.x2 - e.x1)) AS t FROM cand c JOIN v_edge e USING (gid)
               WHERE (c.x2 - c.x1) * (e.y2 - e.y1) <> (c.y2 - c.y1) * (e.x2 - e.x1)),
    ts AS (SELECT gid, way_id, seq, 0.0::DOUBLE AS t FROM cand UNION ALL SELECT gid, way_id, seq, 1.0 FROM cand
           UNION ALL SELECT * FROM cross_t WHERE t > 0 AND t < 1),
    part AS (SELECT *, lead(t) OVER (PARTITION BY gid, way_id, seq ORDER BY t) AS t2 FROM ts),
    mid AS (SELECT p.*, c.class, c.x1 + (t + t2) / 2 * (c.x2 - c.x1) AS mx, c.y1 + (t + t2) / 2 * (c.y2 - c.y1) AS my,
              sqrt((c.x2 - c.x1) ** 2 + (c.y2 - c.y1) ** 2) * (t2 - t) AS len FROM part p JOIN cand c USING (gid, way_id, seq) WHERE t2 > t),
    ins AS (SELECT m.gid, m.way_id, m.seq, m.class, m.t, m.len FROM mid m JOIN v_edge e ON e.gid = m.gid AND least(e.y1, e.y2) <= m.my AND m.my < greatest(e.y1, e.y2)
            AND e.x1 + (m.my - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) > m.mx GROUP BY ALL HAVING count(*) % 2 = 1),
    tot AS (SELECT gid, sum(len) / 1000 AS a, sum(CASE WHEN class IN ('primary', 'trunk') THEN len END) / 1000 AS b, count(DISTINCT way_id) AS n FROM ins GROUP BY gid)
    SELECT gid, round(CASE WHEN gid IN (SELECT gid FROM cand) THEN coalesce(a, 0) END, 4) AS km_total,
      round(CASE WHEN gid IN (SELECT gid FROM cand) THEN coalesce(b, 0) END, 4) AS km_main, coalesce(n, 0) AS lines
    FROM v_bounds LEFT JOIN tot USING (gid)""", ["v_seg", "v_edge", "v_bounds"])
def _(v):
    return geometry.clip_line_length(v.seg, v.edge, cell=8.0)


@query("d13_lines_on_outlines", """
    seg0 AS (SELECT way_id, seq, class, floor(x1) AS x1, floor(y1) AS y1, floor(x2) AS x2, floor(y2) AS y2 FROM v_seg),
    cand AS (SELECT b.gid, s.* FROM seg0 s JOIN v_bounds b ON least(s.x1, s.x2) <= b.maxx AND b.minx <= greatest(s.x1, s.x2)
             AND least(s.y1, s.y2) <= b.maxy AND b.miny <= greatest(s.y1, s.y2)),
    cross_t AS (SELECT c.gid, c.way_id, c.seq, ((e.x1 - c.x1) * (e.y2 - e.y1) - (e.y1 - c.y1) * (e.x2 - e.x1)) /
               ((c.x2 - c.x1) * (e.y2 - e.y1) - (c.y2 - c.y1) * (e.x2 - e.x1)) AS t FROM cand c JOIN v_edge e USING (gid)
               WHERE (c.x2 - c.x1) * (e.y2 - e.y1) <> (c.y2 - c.y1) * (e.x2 - e.x1)),
    ts AS (SELECT gid, way_id, seq, 0.0::DOUBLE AS t FROM cand UNION ALL SELECT gid, way_id, seq, 1.0 FROM cand
           UNION ALL SELECT * FROM cross_t WHERE t > 0 AND t < 1),
    part AS (SELECT *, lead(t) OVER (PARTITION BY gid, way_id, seq ORDER BY t) AS t2 FROM ts),
    mid AS (SELECT p.*, c.class, c.x1 + (t + t2) / 2 * (c.x2 - c.x1) AS mx, c.y1 + (t + t2) / 2 * (c.y2 - c.y1) AS my,
              sqrt((c.x2 - c.x1) ** 2 + (c.y2 - c.y1) ** 2) * (t2 - t) AS len FROM part p JOIN cand c USING (gid, way_id, seq) WHERE t2 > t),
    ins AS (SELECT m.gid, m.way_id, m.seq, m.class, m.t, m.len FROM mid m JOIN v_edge e ON e.gid = m.gid AND least(e.y1, e.y2) <= m.my AND m.my < greatest(e.y1, e.y2)
            AND e.x1 + (m.my - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) > m.mx GROUP BY ALL HAVING count(*) % 2 = 1),
    tot AS (SELECT gid, sum(len) / 1000 AS a, sum(CASE WHEN class IN ('primary', 'trunk') THEN len END) / 1000 AS b, count(DISTINCT way_id) AS n FROM ins GROUP BY gid)
    SELECT gid, round(CASE WHEN gid IN (SELECT gid FROM cand) THEN coalesce(a, 0) END, 4) AS km_total,
      round(CASE WHEN gid IN (SELECT gid FROM cand) THEN coalesce(b, 0) END, 4) AS km_main, coalesce(n, 0) AS lines
    FROM v_bounds LEFT JOIN tot USING (gid)""", ["v_seg", "v_edge", "v_bounds"])
def _(v):
    on_grid = v.seg.withColumns({c: F.floor(c).cast("double") for c in ("x1", "y1", "x2", "y2")})
    return geometry.clip_line_length(on_grid, v.edge, cell=8.0)


@query("f7_segments", "SELECT way_id, seq, class, x1, y1, x2, y2 FROM v_seg", ["v_seg"])
def _(v):
    return v.seg.select("way_id", "seq", "class", "x1", "y1", "x2", "y2")


@query("f7_segments_gaps", """
    kept AS (SELECT * FROM v_point WHERE seq % 3 <> 1),
    nxt AS (SELECT way_id, seq, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM kept WINDOW w AS (PARTITION BY way_id ORDER BY seq))
    SELECT * FROM nxt WHERE x2 IS NOT NULL""", ["v_point"])
def _(v):
    return geometry.segments(v.point.filter("seq % 3 <> 1")).select("way_id", "seq", "x1", "y1", "x2", "y2")


@query("f7_ground_length", """SELECT way_id, round(sum(sqrt((radians(y2 - y1) / 1000 * 6335439.327292464 / w ** 1.5) ** 2 +
      (radians(x2 - x1) / 1000 * 6378137.0 / sqrt(w) * cos(m)) ** 2)), 3) AS metres FROM (
    SELECT *, 1 - 0.0066943799901413165::DOUBLE * sin(m) ** 2 AS w FROM (SELECT *, radians(21 + (y1 + y2) / 2000) AS m FROM v_seg)) GROUP BY way_id""", ["v_seg"])
def _(v):
    lon = lambda c: 105 + F.col(c) / 1000
    lat = lambda c: 21 + F.col(c) / 1000
    metres = grid.ground_length(lon("x1"), lat("y1"), lon("x2"), lat("y2"))
    return rounded(v.seg.groupBy("way_id").agg(F.sum(metres).alias("metres")), 3)


# --- regions ------------------------------------------------------------------------------------------------------

@query("f6_runs", """SELECT 'row' AS axis, image_id, row AS line, min(col) AS p0, max(col) AS p1 FROM (
    SELECT *, col - row_number() OVER (PARTITION BY image_id, row ORDER BY col) AS g FROM v_road) GROUP BY image_id, row, g
    UNION ALL SELECT 'col', image_id, col, min(row), max(row) FROM (
    SELECT *, row - row_number() OVER (PARTITION BY image_id, col ORDER BY row) AS g FROM v_road) GROUP BY image_id, col, g""", ["v_road"])
def _(v):
    both = [regions.runs(v.road, a).select(F.lit(a).alias("axis"), "image_id", "line", "p0", "p1") for a in ("row", "col")]
    return both[0].union(both[1])


@query("j1_mosaic", """
    t AS (SELECT row, col, block, CASE WHEN col % 9 <> 0 OR block % 2 = 0 THEN "RED" END AS "RED",
            CASE WHEN col % 9 <> 0 OR block % 2 = 0 THEN "NIR" END AS "NIR" FROM v_pixel)
    SELECT row, col, max("RED") AS "RED", max("NIR") AS "NIR", min("RED") IS DISTINCT FROM max("RED") OR min("NIR") IS DISTINCT FROM max("NIR") AS conflict
    FROM (SELECT row + 32 * (block // 3) AS row, col, "RED", "NIR" FROM t) GROUP BY row, col""", ["v_pixel"])
def _(v):
    odd = (F.col("col") % 9 != 0) | (F.col("block") % 2 == 0)
    tiles = v.pixel.select(
        (32 * F.floor(F.col("block") / 3)).alias("row_off"), F.lit(0).alias("col_off"), "row", "col",
        *[F.when(odd, F.col(b)).alias(b) for b in ("RED", "NIR")])
    return regions.mosaic(tiles, ["RED", "NIR"])


@query("j2_null_metadata", """SELECT o_orderkey, CASE WHEN o_orderkey % 9 < 2 THEN 'bands_or_crs' WHEN o_orderkey % 9 < 6 THEN 'grid'
    WHEN o_orderkey % 9 < 8 THEN 'position' END AS problem FROM orders""")
def _(v):
    k, s = F.col("o_orderkey") % 9, grid.STEP_500M
    fields = {"bands": F.lit(2), "epsg": F.lit(4326), "step_x": F.lit(s), "step_y": F.lit(-s), "rot_x": F.lit(0.0), "rot_y": F.lit(0.0),
              "origin_x": F.lit(105.0), "origin_y": F.lit(21.0)}
    tiles = v.table("orders").select("o_orderkey", F.lit(0).alias("tile_row"), F.lit(0).alias("tile_col"),
                                     *[F.when(k != i, x).alias(c) for i, (c, x) in enumerate(fields.items())])
    return readers.check_tiles(tiles, 105.0, 21.0, s, 2).select("o_orderkey", "problem")


@query("j2_check_tiles", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'bands_or_crs' WHEN o_orderkey % 7 = 0 THEN 'grid'
    WHEN o_orderkey % 3 = 0 THEN 'position' END AS problem FROM orders""")
def _(v):
    k = F.col("o_orderkey")
    s = grid.STEP_500M
    tiles = v.table("orders").select(
        "o_orderkey", (k % 4 * 4096).alias("tile_row"), (k % 6 * 4096).alias("tile_col"),
        (21 - (k % 4 * 4096 + F.when(k % 3 == 0, 0.5).otherwise(0.0)) * s).alias("origin_y"), (105 + k % 6 * 4096 * s).alias("origin_x"),
        F.when(k % 5 == 0, 3).otherwise(2).alias("bands"), F.lit(4326).alias("epsg"),
        (F.lit(s) * F.when(k % 7 == 0, 1.1).otherwise(1.0)).alias("step_x"), F.lit(-s).alias("step_y"), F.lit(0.0).alias("rot_x"), F.lit(0.0).alias("rot_y"))
    return readers.check_tiles(tiles, 105.0, 21.0, s, 2).select("o_orderkey", "problem")


def _open_sql(mask):
    return f"""
    op AS (
      SELECT image_id, line AS row, unnest(range(p0, p1 + 1)) AS col FROM (SELECT image_id, row AS line, min(col) AS p0, max(col) AS p1 FROM (
        SELECT *, col - row_number() OVER (PARTITION BY image_id, row ORDER BY col) AS g FROM {mask}) GROUP BY image_id, row, g) JOIN v_image_size USING (image_id)
        WHERE p1 - p0 + 1 + (CASE WHEN p0 = 0 THEN 2 ELSE 0 END) + (CASE WHEN p1 = width - 1 THEN 2 ELSE 0 END) >= 5
      UNION SELECT image_id, unnest(range(p0, p1 + 1)), line FROM (SELECT image_id, col AS line, min(row) AS p0, max(row) AS p1 FROM (
        SELECT *, row - row_number() OVER (PARTITION BY image_id, col ORDER BY row) AS g FROM {mask}) GROUP BY image_id, col, g) JOIN v_image_size USING (image_id)
        WHERE p1 - p0 + 1 + (CASE WHEN p0 = 0 THEN 2 ELSE 0 END) + (CASE WHEN p1 = height - 1 THEN 2 ELSE 0 END) >= 5)"""


@query("j3_open_lines", _open_sql("v_road") + " SELECT image_id, row, col FROM op", ["v_road", "v_image_size"])
def _(v):
    return regions.open_lines(v.road, images=v.image_size)


def _small_sql(mask, conn, size, name="kept"):
    return (components_sql(mask, conn, name + "_c") + f", {name}_n AS (SELECT image_id, label FROM {name}_c GROUP BY image_id, label "
            f"HAVING sum(p1 - p0 + 1) >= {size}), {name}_r AS (SELECT * FROM {name}_c JOIN {name}_n USING (image_id, label)), "
            + pixels_sql(name + "_r", name))


@query("j4_remove_small", _small_sql("v_road", 4, 10) + " SELECT image_id, row, col FROM kept", ["v_road"])
def _(v):
    return regions.remove_small(v.road, regions.MIN_ROAD)


@query("j5_components_8", components_sql("v_industrial", 8) + f" SELECT image_id, line AS row, unnest(range(p0, p1 + 1)) AS col, {_LABEL} FROM comp", ["v_industrial"])
def _(v):
    return regions.components(v.industrial, 8)


@query("j5_components_4", components_sql("v_water", 4) + f" SELECT image_id, line AS row, unnest(range(p0, p1 + 1)) AS col, {_LABEL} FROM comp", ["v_water"])
def _(v):
    return regions.components(v.water, 4)


_PROPS = """
    px AS (SELECT image_id, label, line AS r, unnest(range(p0, p1 + 1)) AS c FROM {comp}),
    st AS (SELECT image_id, label, count(*) AS area, avg(r) AS mr, avg(c) AS mc, var_pop(r) AS vr, var_pop(c) AS vc, covar_pop(r, c) AS k FROM px GROUP BY image_id, label),
    props AS (SELECT *, 4 * sqrt(greatest((vr + vc) / 2 + sqrt(((vr - vc) / 2) ** 2 + k * k), 0)) AS major, 4 * sqrt(greatest((vr + vc) / 2 - sqrt(((vr - vc) / 2) ** 2 + k * k), 0)) AS minor FROM st)"""


@query("j6_region_props", components_sql("v_water", 8) + "," + _PROPS.format(comp="comp") + f""" SELECT image_id, {_LABEL}, area, round(mr, 5) AS centre_row,
    round(mc, 5) AS centre_col, round(major, 5) AS major_axis, round(CASE WHEN minor < 1e-5 THEN 0 ELSE minor END, 5) AS minor_axis FROM props""", ["v_water"])
def _(v):
    props = regions.region_props(regions.component_runs(v.water, 8)).drop("label", "aspect")
    return rounded(props.withColumn("minor_axis", F.when(F.col("minor_axis") < 1e-5, 0.0).otherwise(F.col("minor_axis"))), 5)


_WATER = (_small_sql("v_water", 4, 4, "clean") + "," + components_sql("clean", 8) + "," + _PROPS.format(comp="comp")
          + """, body AS (SELECT *, area * pixel_area_m2 >= 12000 OR (major / (minor + 1e-6) >= 4 AND area * pixel_area_m2 >= 8000) AS is_natural
            FROM props JOIN v_image_size USING (image_id))""")


@query("j7_classify_water", _WATER + f" SELECT image_id, {_LABEL}, area, is_natural AS \"natural\" FROM body", ["v_water", "v_image_size"])
def _(v):
    return regions.classify_water(v.water, images=v.image_size).select("image_id", "label_row", "label_col", "area", "natural")


@query("j7_water_metrics", _WATER + f""" SELECT image_id, CAST(sum(area) AS BIGINT) AS water_pixels, round(sum(area) * max(pixel_area_m2) / 1e4, 6) AS water_area_ha,
    round(coalesce(sum(area) FILTER (WHERE is_natural), 0) * max(pixel_area_m2) / 1e4, 6) AS water_natural_ha,
    round(coalesce(sum(area) FILTER (WHERE NOT is_natural), 0) * max(pixel_area_m2) / 1e4, 6) AS water_aquaculture_ha,
    count(*) FILTER (WHERE is_natural) AS water_natural_bodies, count(*) FILTER (WHERE NOT is_natural) AS water_aquaculture_bodies FROM body GROUP BY image_id""", ["v_water", "v_image_size"])
def _(v):
    return rounded(regions.water_metrics(v.water, images=v.image_size))


@query("j8_industrial_metrics", components_sql("v_industrial", 8) + """, s AS (SELECT image_id, label, sum(p1 - p0 + 1) AS n FROM comp GROUP BY image_id, label HAVING sum(p1 - p0 + 1) >= 5)
    SELECT image_id, count(*) AS industrial_clusters, CAST(sum(n) AS BIGINT) AS industrial_pixels, round(sum(n) * max(pixel_area_m2) / 1e4, 6) AS industrial_area_ha,
    round(sum(n) * max(pixel_area_m2), 6)::DOUBLE AS industrial_area_m2 FROM s JOIN v_image_size USING (image_id) GROUP BY image_id""", ["v_industrial", "v_image_size"])
def _(v):
    return rounded(regions.industrial_metrics(v.industrial, images=v.image_size))


_CORRIDOR = _open_sql("v_road") + "," + _small_sql("op", 4, 10)


@query("j9_road_corridor", _CORRIDOR + " SELECT image_id, row, col FROM kept", ["v_road", "v_image_size"])
def _(v):
    return regions.road_corridor(v.road, images=v.image_size)


@query("j9_road_metrics", _CORRIDOR + "," + thinning_sql("kept", "thin") + """ SELECT image_id, road_corridor_pixels, road_centerline_pixels,
    round(road_centerline_pixels * res_m / 1000.0, 6)::DOUBLE AS road_length_km, round(road_corridor_pixels * pixel_area_m2 / 1e4, 6)::DOUBLE AS road_area_ha
    FROM (SELECT image_id, count(*) AS road_corridor_pixels FROM kept GROUP BY image_id)
    JOIN (SELECT image_id, count(*) AS road_centerline_pixels FROM thin GROUP BY image_id) USING (image_id) JOIN v_image_size USING (image_id)""", ["v_road", "v_image_size"])
def _(v):
    return rounded(regions.road_metrics(v.road, images=v.image_size))


@query("j10_skeleton", thinning_sql("v_industrial", "thin") + " SELECT image_id, row, col FROM thin", ["v_industrial"])
def _(v):
    return regions.skeleton(v.industrial)


@query("j11_dilate", """SELECT DISTINCT image_id, row + a AS row, col + b AS col FROM v_water, (VALUES (-1), (0), (1)) AS p(a), (VALUES (-1), (0), (1)) AS q(b)""", ["v_water"])
def _(v):
    return regions.dilate(v.water)


@query("j12_analyze_images")
def _(v):
    return analyze_images(v.indexed, images=v.image_size)


@query("j12_image_summary", f"""SELECT image_id, max(height) AS img_height, max(width) AS img_width, 10::BIGINT AS n_bands, max(res_m) AS pixel_size_m,
    count(*) FILTER (WHERE {VALID}) AS valid_pixels, round(count(*) FILTER (WHERE {VALID}) * max(pixel_area_m2) / 1e4, 6)::DOUBLE AS valid_area_ha,
    round(avg("RED") FILTER (WHERE {VALID}), 6) AS "RED_mean", round(stddev_pop("RED") FILTER (WHERE {VALID}), 6) AS "RED_stdDev" FROM v_indexed JOIN v_image_size USING (image_id) GROUP BY image_id""", ["v_indexed", "v_image_size"])
def _(v):
    """The columns of the summary that SQL can count; labelled regions have queries of their own."""
    out = analyze_images(v.indexed, images=v.image_size).select(
        "image_id", "img_height", "img_width", "n_bands", "pixel_size_m", "valid_pixels", F.round("valid_area_ha", 6).alias("valid_area_ha"),
        "RED_mean", "RED_stdDev")
    return out
