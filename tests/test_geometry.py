import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from unitgrid.functions import grid
from unitgrid.operators import geometry as G
from unitgrid.sources import readers, writers


def edges_of(spark, polygons):
    """polygons: gid -> list of parts, each a list of rings."""
    rows = [(g, str(p), i, float(a[0]), float(a[1]), float(b[0]), float(b[1])) for g, parts in polygons.items()
            for p, rings in enumerate(parts) for i, ring in enumerate(rings) for a, b in zip(ring, ring[1:] + ring[:1])]
    return spark.createDataFrame(rows, "gid string, part string, ring int, x1 double, y1 double, x2 double, y2 double")


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 <= y < y2 or y2 <= y < y1) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x:
                odd = not odd
    return odd


STAR = [[(2.1, 1.3), (30.2, 9.7), (12.4, 14.1), (28.9, 30.6), (3.2, 25.5), (9.8, 13.2)]]
HOLED = [[(10.3, 10.2), (40.7, 10.9), (41.2, 38.8), (9.9, 37.4)], [(18.2, 18.7), (30.1, 19.3), (25.5, 31.9)]]


def test_cut_matches_point_in_polygon(spark):
    edges = edges_of(spark, {"star": [STAR], "holed": [HOLED], "two": [[[(0.2, 0.2), (5.7, 0.4), (2.9, 6.1)]], [[(4.1, 0.1), (9.3, 0.2), (6.6, 7.7)]]]})
    px = spark.range(50 * 50).select((F.col("id") / 50).cast("int").alias("row"), (F.col("id") % 50).alias("col"), F.col("id").alias("v"))
    got = {(r.gid, r.row, r.col) for r in G.clip_pixels(px, G.polygon_spans(edges), bucket=8).collect()}
    want = set()
    for g, parts in {"star": [STAR], "holed": [HOLED], "two": [[[(0.2, 0.2), (5.7, 0.4), (2.9, 6.1)]], [[(4.1, 0.1), (9.3, 0.2), (6.6, 7.7)]]]}.items():
        want |= {(g, r, c) for r in range(50) for c in range(50) if any(inside(p, c + 0.5, r + 0.5) for p in parts)}
    assert got == want


def test_whole_box_returns_every_pixel(spark):
    edges = edges_of(spark, {"box": [[[(0, 0), (4, 0), (4, 4), (0, 4)]]]})
    px = spark.range(36).select((F.col("id") / 6).cast("int").alias("row"), (F.col("id") % 6).alias("col"))
    cut = G.clip_pixels(px, G.polygon_spans(edges))
    assert {(r.row, r.col) for r in cut.collect()} == {(r, c) for r in range(4) for c in range(4)}


def test_line_length_matches_sampling(spark):
    edges = edges_of(spark, {"star": [STAR], "holed": [HOLED], "far": [[[(200, 200), (210, 200), (205, 209)]]],
                             "near": [[[(44.5, 1.2), (49.5, 1.4), (47.0, 3.1)]]]})
    rng = np.random.default_rng(2)
    pts = [(w, s, ["primary", "residential"][w % 2], float(x), float(y)) for w in range(12) for s, (x, y) in enumerate(rng.random((6, 2)) * 44)]
    pts += [(99, 0, "primary", 44.6, 2.9), (99, 1, "primary", 44.9, 3.0)]
    points = spark.createDataFrame(pts, "way_id long, seq long, class string, x double, y double")
    got = {r.gid: r for r in G.clip_line_length(G.segments(points), edges, cell=7.0, factor=1.0, digits=6).collect()}
    assert got["far"].km_total is None and got["far"].lines == 0
    assert got["near"].km_total == 0.0 and got["near"].lines == 0
    for gid, rings in (("star", STAR), ("holed", HOLED)):
        total, main, ways = 0.0, 0.0, set()
        for a, b in zip(pts, pts[1:]):
            if a[0] != b[0]:
                continue
            n = 4000
            t = (np.arange(n) + 0.5) / n
            hit = sum(inside(rings, a[3] + k * (b[3] - a[3]), a[4] + k * (b[4] - a[4])) for k in t)
            length = hit / n * math.hypot(b[3] - a[3], b[4] - a[4])
            total += length
            main += length if a[2] == "primary" else 0
            if hit:
                ways.add(a[0])
        assert got[gid].km_total == pytest.approx(total, rel=2e-3)
        assert got[gid].km_main == pytest.approx(main, rel=2e-3)
        assert got[gid].lines == len(ways)


def test_polygon_files(spark, tmp_path):
    ring = [[105.0, 21.0], [105.5, 21.0], [105.5, 21.5], [105.0, 21.0]]
    features = [{"type": "Feature", "properties": {"GID_3": "A"}, "geometry": {"type": "Polygon", "coordinates": [ring]}},
                {"type": "Feature", "properties": {"GID_3": "A"}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}},
                {"type": "Feature", "properties": {"GID_3": "B"}, "geometry": {"type": "GeometryCollection", "geometries": [
                    {"type": "Point", "coordinates": [1, 2]}, {"type": "Polygon", "coordinates": [ring]}]}},
                {"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]
    path = tmp_path / "c.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    got = readers.read_polygons(spark, str(path))
    assert {r.gid: r["count"] for r in got.groupBy("gid").count().collect()} == {"A": 9, "B": 3}
    box = G.bounds(got).filter("gid = 'B'").first()
    assert (box.minx, box.miny, box.maxx, box.maxy) == (105.0, 21.0, 105.5, 21.5)


def test_tiles(spark):
    names = spark.createDataFrame([("day_img_202401_w0-0000000000-0000004096.tif",), ("night_img_202401.tif",), ("plan_day.json",),
                                   ("day_img_202401_w0.tif",)], "path string")
    got = {(r.tile_row, r.tile_col) for r in readers.parse_tile_names(names, "day_img_202401_w0").collect()}
    assert got == {(0, 4096), (0, 0)}
    swapped = {(r.tile_row, r.tile_col) for r in readers.parse_tile_names(names, "day_img_202401_w0", swap=True).collect()}
    assert swapped == {(4096, 0), (0, 0)}
    boxes = spark.createDataFrame([("a", 4090, 4100, 10, 20)], "gid string, r0 long, r1 long, c0 long, c1 long")
    need = G.required_tiles(boxes)
    assert {(r.tile_row, r.tile_col) for r in need.collect()} == {(0, 0), (4096, 0)}
    have = spark.createDataFrame([(0, 0)], "tile_row long, tile_col long")
    assert [(r.tile_row, r.tile_col) for r in G.missing_tiles(need, have).collect()] == [(4096, 0)]


def test_cell_area_and_ground_length(spark):
    row = spark.range(1).select(grid.cell_area(F.lit(1.0), F.lit(0.0), F.lit(1.0)).alias("a"),
                                grid.ground_length(F.lit(105.0), F.lit(21.0), F.lit(105.0), F.lit(21.01)).alias("l"),
                                grid.cell_area(F.lit(90.0), F.lit(-90.0), F.lit(360.0)).alias("all")).first()
    # One-degree cell at the equator; the geodesic polygon (12,308,778,361 m2) bulges past the parallel.
    assert row.a == pytest.approx(12308778361.0, rel=1e-4)
    assert row["all"] == pytest.approx(510065621724000.0, rel=1e-9)
    assert row.l == pytest.approx(1107.2, rel=1e-3)


def test_features_that_repeat_count_once(spark, tmp_path):
    ring = [[1.0, 1.0], [9.0, 1.5], [8.0, 8.0], [1.0, 1.0]]
    feature = lambda g: {"type": "Feature", "properties": {"GID_3": g}, "geometry": {"type": "Polygon", "coordinates": [ring]}}
    whole = lambda *f: json.dumps({"type": "FeatureCollection", "features": list(f)})
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.geojson").write_text(whole(feature("twice"), feature("once"), feature("twice")))
    (tmp_path / "a" / "2.geojson").write_text(whole(feature("twice"), feature("files")))
    (tmp_path / "a" / "3.geojson").write_text(whole(feature("files")))
    (tmp_path / "l.geojson").write_text("\n".join(json.dumps(feature(g)) for g in ("twice", "once", "twice", "files", "files")))
    for edges in (readers.read_polygons(spark, str(tmp_path / "a")), readers.read_polygons(spark, str(tmp_path / "l.geojson"), lines=True)):
        spans = {}
        for r in G.polygon_spans(edges).collect():
            spans.setdefault(r.gid, set()).add((r.row, r.c0, r.c1))
        assert spans["twice"] == spans["once"] == spans["files"] and len(spans["once"]) > 4
        segs = spark.createDataFrame([(1, 0, "primary", 0.0, 3.3, 20.0, 3.3)], "way_id long, seq long, class string, x1 double, y1 double, x2 double, y2 double")
        km = {r.gid: r.km_total for r in G.clip_line_length(segs, edges, cell=4.0, factor=1.0).collect()}
        assert km["twice"] == km["once"] == km["files"] > 4


def test_lines_of_one_course_are_cut_once(spark, monkeypatch):
    """Lines that run the same course meet the polygons as one segment; each of them counts, also one that is there twice."""
    met = []
    cut = G.inside_pieces
    monkeypatch.setattr(G, "inside_pieces", lambda segs, *rest, **more: met.append(segs.count()) or cut(segs, *rest, **more))
    rows = [(w, s, ["primary", "residential", None][w % 3], 0.0, 3.0, 20.0, 3.0) for w in range(30) for s in range(2)]
    rows += [(w, 2, "primary", 20.0, 3.0, 0.0, 3.0) for w in range(5)] + [(99, 0, "primary", -0.0, 3.0, 20.0, 3.0), (50, 0, "primary", 90.0, 90.0, 91.0, 91.0), (51, 0, "primary", None, 3.0, 20.0, 3.0)]
    segs = spark.createDataFrame(rows, "way_id long, seq long, class string, x1 double, y1 double, x2 double, y2 double")
    edges = edges_of(spark, {"box": [[[(2, 1), (6, 1), (6, 5), (2, 5)]]], "near": [[[(7, 3.5), (9, 3.5), (7, 2.9)]], [[(7, 3.5), (9, 3.5), (7, 2.9)]]], "far": [[[(200, 200), (210, 200), (205, 209)]]]})
    got = {r.gid: r for r in G.clip_line_length(segs, edges, cell=4.0, factor=1.0).collect()}
    assert met == [4]
    assert (got["box"].km_total, got["box"].km_main, got["box"].lines) == (4.0 * 66, 4.0 * 26, 31)
    assert got["near"].lines == 31 and got["near"].km_total == pytest.approx(66 * 1 / 3, abs=1e-3)
    assert tuple(got["far"])[1:] == (None, None, 0)


def test_lines_on_outlines_and_over_parts(spark):
    """Integer lines through vertices and along edges, of polygons whose parts overlap, against the half-open rule."""
    rng = np.random.default_rng(5)
    parts = [[[(2, 2), (12, 2), (12, 12), (2, 12)], [(5, 5), (9, 5), (9, 9), (5, 9)]], [[(8, 8), (16, 8), (12, 16)]], [[(2, 2), (12, 2), (12, 12), (2, 12)]]]
    polygons = {"one": parts[:1], "two": parts[:2], "all": parts, "star": [[[(0, 6), (6, 7), (7, 14), (8, 7), (14, 6), (8, 5), (7, 0), (6, 5)]]]}
    ends = [[int(v) for v in rng.integers(0, 17, 4)] for _ in range(60)] + [[2, 2, 12, 2], [12, 2, 2, 2], [2, 12, 2, 2], [0, 12, 16, 12], [5, 0, 5, 16], [7, 0, 7, 14], [3, 3, 3, 3]]
    segs = spark.createDataFrame([(i, 0, "primary", *map(float, e)) for i, e in enumerate(ends)], "way_id long, seq long, class string, x1 double, y1 double, x2 double, y2 double")
    pieces, _ = G.inside_pieces(segs, edges_of(spark, polygons), cell=5.0)
    got = {}
    for r in pieces.collect():
        got.setdefault((r.gid, r.way_id), []).append((r.t0, r.t1))
    for gid, some in polygons.items():
        for i, (x1, y1, x2, y2) in enumerate(ends):
            t = (np.arange(997) + 0.5) / 997
            want = np.array([any(inside(p, x1 + k * (x2 - x1), y1 + k * (y2 - y1)) for p in some) for k in t])
            mine = np.zeros(997, bool)
            for a, b in got.get((gid, i), []):
                assert not mine[(t > a) & (t < b)].any()
                mine |= (t > a) & (t < b)
            assert (mine != want).sum() <= 8, (gid, ends[i])  # a sample may fall on a crossing


def test_tile_store_is_pruned(spark, tmp_path):
    px = spark.range(64 * 64).select((F.col("id") / 64).cast("long").alias("row"), (F.col("id") % 64).alias("col"), F.col("id").alias("v"))
    writers.write_pixel_tiles(px, str(tmp_path / "t"), 8)
    store = readers.read_pixel_tiles(spark, str(tmp_path / "t"), "row long, col long, v long, tile_row long, tile_col long")
    edges = edges_of(spark, {"a": [[[(3, 3), (11, 3), (11, 6)]]], "b": [[[(50, 50), (55, 50), (55, 55)]]]})
    needed = G.needed_tiles(G.required_tiles(G.windows(G.bounds(edges), y_down=True), 8))
    near = G.pixels_of_tiles(store, needed)
    assert "dynamicpruning" in near._jdf.queryExecution().executedPlan().toString()
    files = G.pixels_of_tiles(store.withColumn("file", F.col("_metadata.file_path")), needed)
    assert files.select("file").distinct().count() == 3 and near.count() == 3 * 64
    cut = lambda p: {(r.gid, r.row, r.col, r.v) for r in G.clip_pixels(p, G.polygon_spans(edges)).select("gid", "row", "col", "v").collect()}
    assert cut(near) == cut(px) != set()


def test_store_of_many_small_tiles_has_few_folders(spark, tmp_path):
    """2,500 tiles of 4 pixels: squares of tiles share a folder; tiles needed are read exactly, from the folders that hold them."""
    px = spark.range(100 * 100).select((F.col("id") / 100).cast("long").alias("row"), (F.col("id") % 100 - 50).alias("col"), F.col("id").alias("v"))
    writers.write_pixel_tiles(px, str(tmp_path / "t"), 2)
    store = readers.read_pixel_tiles(spark, str(tmp_path / "t"), "row long, col long, v long, tile_row long, tile_col long")
    assert len(list(tmp_path.glob("t/**/*.parquet"))) <= 1000
    whole = sorted(tuple(r) for r in px.collect())
    assert sorted(tuple(r) for r in store.select("row", "col", "v").collect()) == whole
    needed = G.needed_tiles(spark.createDataFrame([(0, 0), (2, -4), (2, -4), (98, 48), (500, 0)], "tile_row long, tile_col long"))
    near = G.pixels_of_tiles(store, needed)
    assert "dynamicpruning" in near._jdf.queryExecution().executedPlan().toString()
    at = {(0, 0), (2, -4), (98, 48)}
    assert sorted(tuple(r) for r in near.select("row", "col", "v").collect()) == [p for p in whole if (p[0] // 2 * 2, p[1] // 2 * 2) in at]


def test_store_without_pixels(spark, tmp_path):
    writers.write_pixel_tiles(spark.createDataFrame([], "row long, col long, v long"), str(tmp_path / "t"), 8)
    store = readers.read_pixel_tiles(spark, str(tmp_path / "t"), "row long, col long, v long, tile_row long, tile_col long")
    needed = G.needed_tiles(spark.createDataFrame([(0, 0)], "tile_row long, tile_col long"))
    assert G.pixels_of_tiles(store, needed).count() == 0


def test_untiled_file_must_cover_the_window(spark):
    boxes = spark.createDataFrame([("in", 0, 10, 0, 10), ("low", 5, 11, 0, 3), ("left", 0, 2, -1, 3)], "gid string, r0 long, r1 long, c0 long, c1 long")
    have = spark.createDataFrame([(0, 0)], "tile_row long, tile_col long")
    missing = G.missing_tiles(G.required_whole(boxes, 10, 10), have).collect()
    assert {r.gid for r in missing} == {"low", "left"}
