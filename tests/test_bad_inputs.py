"""Inputs that the driver tables never hold: each is an error or has a defined result."""

import json

import pytest
from helpers import GIDS, admin, evidence, records
from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.operators import contract, geometry, keys, regions, scenes, zonal
from unitgrid.plans.images import analyze_images
from unitgrid.sources import readers, writers


def square(x0, y0, size):
    ring = [[x0, y0], [x0 + size, y0], [x0 + size, y0 + size], [x0, y0 + size], [x0, y0]]
    return {"type": "Polygon", "coordinates": [ring]}


def nested(g, depth):
    return g if not depth else {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [0, 0]}, nested(g, depth - 1)]}


@pytest.mark.parametrize("depth", [0, 1, 3, 40])
def test_polygons_at_any_depth(spark, depth):
    df = spark.createDataFrame([("a", json.dumps(nested(square(0, 0, 2), depth))), ("b", None)], "gid string, geometry string")
    assert [r.gid for r in geometry.polygon_edges(df).collect()] == ["a"] * 4


def test_malformed_geometry_stops(spark):
    with pytest.raises(Exception, match="JSON|Expecting"):
        geometry.polygon_edges(spark.createDataFrame([("a", "{oops")], "gid string, geometry string")).collect()


def test_segments_over_gaps(spark):
    points = spark.createDataFrame([(1, s, "p", float(s), 0.0) for s in (0, 1, 3, 4, 9)] + [(2, 5, "p", 0.0, 0.0)],
                                   "way_id long, seq long, class string, x double, y double")
    assert sorted((r.seq, r.x2) for r in geometry.segments(points).collect()) == [(0, 1.0), (1, 3.0), (3, 4.0), (4, 9.0)]


@pytest.mark.parametrize("line,inside", [
    ((5, 2, 9, 2), 0.0), ((0, 2, 4, 2), 4.0), ((5, 2, 1, 2), 4.0), ((-3, -3, 8, 8), 50 ** 0.5), ((-2, 2, 0, 2), 0.0), ((5, 5, 8, 8), 0.0),
    ((0, 0, 5, 5), 50 ** 0.5), ((-1, 7, 7, -1), 32 ** 0.5), ((2, 2, 2, 2), 0.0), ((-1, 2, 6, 2), 5.0)])
def test_lines_that_touch_the_outline(spark, line, inside):
    edges = geometry.polygon_edges(spark.createDataFrame([("a", json.dumps(square(0, 0, 5)))], "gid string, geometry string"))
    seg = spark.createDataFrame([(1, 0, "primary", *map(float, line))], "way_id long, seq long, class string, x1 double, y1 double, x2 double, y2 double")
    got = geometry.clip_line_length(seg, edges, cell=4.0, factor=1.0, digits=9).first()
    assert (got.km_total or 0.0) == pytest.approx(inside)


def test_null_group_keys_stay(spark):
    df = spark.createDataFrame([(None, 90.0, "A"), (None, 95.0, "B"), ("m", 10.0, "B"), ("m", 99.0, "A")], "month string, cloud double, collection string")
    assert sorted(r.cloud for r in scenes.cloud_filter_or_all(df, ["month"]).collect()) == [10.0, 90.0, 95.0]
    assert sorted(r.cloud for r in scenes.prefer_collection(df, ["month"], ["B", "A"]).collect()) == [10.0, 95.0]
    assert {(r.month, tuple(r.collections)) for r in keys.listed(df, ["month"], "collection").collect()} == {(None, ("A", "B")), ("m", ("A", "B"))}


def test_unreadable_image_metadata_fails(spark):
    good = {"kind": "night", "bands": 2, "epsg": 4326, "step_x": 500 / 111319.49079327357, "step_y": -500 / 111319.49079327357, "rot_x": 0.0, "rot_y": 0.0, "dtype": "float64"}
    schema = "kind string, bands int, epsg int, step_x double, step_y double, rot_x double, rot_y double, dtype string"
    rows = [good] + [good | {k: None} for k in good if k != "kind"]
    states = [r.state for r in contract.check_images(spark.createDataFrame([tuple(r.values()) for r in rows], schema).coalesce(1)).collect()]
    assert states == ["done"] + ["failed"] * 7
    tiles = spark.createDataFrame([(0, 0, None, None, None, None, None, None, None, None)],
                                  "tile_row int, tile_col int, bands int, epsg int, step_x double, step_y double, rot_x double, rot_y double, origin_x double, origin_y double")
    assert readers.check_tiles(tiles, 105.0, 21.0, 0.1, 2).first().problem == "bands_or_crs"


@pytest.mark.parametrize("count", [5.0, -1.0, float("nan"), None])
def test_contradictory_evidence_stops(spark, count):
    table = contract.normalize(records(spark), admin(spark), "day")
    sources = evidence(spark, "day_indices", [1]).unionByName(evidence(spark, "day_indices", [1], count))
    with pytest.raises(Exception, match="source evidence"):
        contract.metric_states(table, "day", sources).collect()


@pytest.mark.parametrize("months", [
    [[1.5, 2, 3]] * 12, [[1, 2]] * 12, [[1, 2, 3]] * 13, [[1, -2, 3]] * 12, [[1, 2, 3]] * 11 + [None], [[1, None, 3]] * 12])
def test_broken_plans_stop(spark, months):
    texts = spark.createDataFrame([(json.dumps({"u": months}),)], "plan string")
    assert [r.gid_3 for r in readers.plan_violations(texts).collect()] == ["u"]
    with pytest.raises(Exception, match="plan: unit"):
        readers.read_plan(texts).collect()


def test_repeated_keys_stop(spark):
    twice = admin(spark).unionByName(admin(spark, GIDS[:1]))
    with pytest.raises(Exception, match="repeated key"):
        contract.normalize(records(spark), twice, "day").collect()
    with pytest.raises(Exception, match="repeated key"):
        keys.enrich_admin(records(spark).withColumnRenamed("GID_3", "gid_3"), twice).collect()
    month = spark.createDataFrame([(GIDS[0], 2024, 1, 0.5), (GIDS[0], 2024, 1, 0.5)], "gid_3 string, year long, month long, val double")
    with pytest.raises(Exception, match="repeated key"):
        keys.complete_grid(month, admin(spark), 2024).collect()


def test_whole_number_metrics_conflict_before_the_cast(spark):
    rows = records(spark, "night")
    other = rows.filter("MONTH = 1").withColumn("LIT_PIXELS", F.col("LIT_PIXELS") + 0.5)
    with pytest.raises(Exception, match="conflict"):
        contract.normalize(rows.unionByName(other), admin(spark), "night").collect()


def test_csv_quotes_and_surplus_fields(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("GID_3,NAME_3\nu,\"a \"\"q\"\" b, c\"\n")
    assert readers.read_admin(spark, path).first().name_3 == 'a "q" b, c'
    with open(path, "w", encoding="utf-8") as f:
        f.write("GID_3,NAME_3\nu,a,b\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_index(spark, path, "day").collect()
    table = str(tmp_path / "index")
    named = contract.conform(contract.normalize(records(spark), admin(spark).withColumn("name_3", F.lit('x "y", z')), "day"), "day")
    writers.write_index(named, table, "day", "r1")
    text = "".join(r.value for r in spark.read.text(table + "/v=*/").collect())
    assert '"x ""y"", z"' in text
    assert {r.name_3 for r in writers.read_published(spark, table, S.index_schema("day"), "csv", header="true", escape='"').collect()} == {'x "y", z'}


def test_images_without_valid_pixels_have_a_row(spark):
    bands = {b: 0.1 + 0.01 * i for i, b in enumerate(S.DAY_BANDS)}
    rows = [("full", r, c, *bands.values()) for r in range(3) for c in range(3)] + [("void", 0, 0, *[None] * len(bands))]
    df = spark.createDataFrame(rows, "image_id string, row long, col long, " + ", ".join(f"{b} double" for b in bands))
    got = {r.image_id: r for r in analyze_images(df, 3, 3, 900.0, 30.0).collect()}
    assert got["void"].valid_pixels == 0 and got["void"].road_corridor_pixels == 0 and got["full"].valid_pixels == 9


def test_empty_images_looks_at_all_bands(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("b", 0.0, None), ("b", None, float("nan"))], "i string, x double, y double")
    assert {r.i: r.empty for r in zonal.empty_images(df, ["i"], ["x", "y"]).collect()} == {"a": False, "b": True}


def test_thick_region_is_thinned_to_the_end(spark):
    mask = spark.range(90 * 60).select(F.lit("i").alias("image_id"), F.floor(F.col("id") / 60).alias("row"), (F.col("id") % 60).alias("col"))
    small = regions.skeleton(mask, tile=16, passes=1)
    whole = regions.skeleton(mask, tile=256, passes=64)
    assert set(map(tuple, small.collect())) == set(map(tuple, whole.collect())) and small.count() < 150


def test_plan_texts_that_are_no_plan_stop_the_job(spark):
    good = '{"u": [' + ", ".join(["[1, 0, 2]"] * 12) + "]}"
    frame = lambda *t: spark.createDataFrame([(x,) for x in t], "plan string")
    assert readers.read_plan(frame(good)).count() == 12
    for bad in ("not json", '["u"]', "{"):
        assert readers.plan_violations(frame(good, bad)).count() == 1
        with pytest.raises(Exception, match="plan"):
            readers.read_plan(frame(good, bad)).collect()
    assert [r.gid_3 for r in readers.plan_violations(frame(good, good)).collect()] == ["u"]
    with pytest.raises(Exception, match="repeated key u"):
        readers.read_plan(frame(good, good)).collect()
