"""Image cuts and verification on small cases."""

import pytest
from helpers import GIDS, admin, records, sources
from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.operators import compare, contract, geometry
from unitgrid.plans import imagecut

EDGE = "gid string, part string, x1 double, y1 double, x2 double, y2 double"


def square(gid, x, y, n):
    ring = [(x, y), (x + n, y), (x + n, y + n), (x, y + n), (x, y)]
    return [(gid, "0", *map(float, a), *map(float, b)) for a, b in zip(ring, ring[1:])]


def inputs(spark):
    """Units a (two tiles), b (there already), c (no boundary), d (a tile absent), e (a pixel's width), in the good p and the bad q."""
    edges = spark.createDataFrame(square("a", 2, 2, 4) + square("b", 0, 0, 2) + square("d", 6, 6, 4) + square("e", 1, 1, 1), EDGE)
    boxes = geometry.windows(geometry.bounds(edges), y_down=True)
    need = spark.createDataFrame([(p, g, True if g == "b" else None if g == "e" else False) for p in "pq" for g in "abcde"] + [("p", "a", False)], "prefix string, gid string, had boolean")
    store = spark.createDataFrame([(p, r, c, float(r * 10 + c)) for p in "pq" for r in range(8) for c in range(8)], "prefix string, row long, col long, red double")
    store = store.withColumns({f"tile_{c}": F.floor(F.col(c) / 4) * 4 for c in ("row", "col")})
    images = spark.createDataFrame([("p", "done", ""), ("q", "failed", "bad")], "prefix string, state string, error string")
    return edges, boxes, need, store, store.select("prefix", "tile_row", "tile_col").distinct(), images


def test_every_outcome_of_a_cut(spark):
    edges, boxes, need, store, present, images = inputs(spark)
    states = imagecut.cut_states(need, boxes, present, images, 4)
    got = {(r.prefix, r.gid): (r.state, r.error, r.cut) for r in states.collect()}
    assert len(got) == 10
    assert got["p", "a"] == ("done", "", True) and got["p", "b"] == ("done", "", False) and got["p", "e"] == ("done", "", True)
    assert got["p", "c"] == ("failed", S.MSG_NO_GEOMETRY, False) and got["p", "d"] == ("failed", S.MSG_TILES_MISSING, False)
    assert got["q", "a"] == ("failed", "bad", False) and got["q", "d"][1] == S.MSG_TILES_MISSING and got["q", "b"][0] == "done"
    cut = {}
    for r in imagecut.cut_pixels(states, boxes, geometry.polygon_spans(edges), store, 4).collect():
        cut.setdefault((r.prefix, r.gid), set()).add((r.row, r.col))
    assert cut == {("p", "a"): {(r, c) for r in range(2, 6) for c in range(2, 6)}, ("p", "e"): {(1, 1)}}
    groups = {r.prefix: r for r in imagecut.group_outcomes(states).collect()}
    assert (groups["p"].state, groups["p"].cut, groups["p"].failed, groups["p"].had) == ("failed", 2, 2, 1)
    bounded = imagecut.cut_states(need.filter("gid <> 'c'"), boxes, present, images, 4)
    assert {r.prefix: r.state for r in imagecut.group_outcomes(bounded).collect()} == {"p": "partial", "q": "partial"}
    names = spark.createDataFrame([("p", "night", 3), ("q", "night", 4)], "prefix string, kind string, month int")
    updates = imagecut.image_updates(states, names).collect()
    assert len(updates) == 8 and {r.field for r in updates} == {"night_image"} and {r.month for r in updates} == {3, 4}


def test_cut_of_one_untiled_file_and_of_nothing(spark):
    _, boxes, need, _, present, images = inputs(spark)
    whole = spark.createDataFrame([("p", 8, 8)], "prefix string, height int, width int")
    one = spark.createDataFrame([("p", 0, 0)], "prefix string, tile_row long, tile_col long")
    got = {r.gid: r.error for r in imagecut.cut_states(need.filter("prefix = 'p'"), boxes, one, images, 4, whole).collect()}
    assert got == {"a": "", "b": "", "c": S.MSG_NO_GEOMETRY, "d": S.MSG_TILES_MISSING, "e": ""}
    lost = imagecut.cut_states(need, boxes, present, images.limit(0), 4).filter("gid = 'a'").collect()
    assert {r.error for r in lost} == {S.MSG_BANDS_CRS}
    assert imagecut.cut_states(need.limit(0), boxes, present, images, 4).count() == 0


@pytest.mark.parametrize("change, level, note", [
    ({}, "PASS", ""), ({(1, 1): 5.4}, "PASS", ""), ({(1, 1): 6.0}, "FAIL", "values"), ({(1, 1): None}, "WARN", "nodata"), ({(1, 1): "gone"}, "WARN", "nodata")])
def test_levels_of_rasters(spark, change, level, note):
    base = {(r, c): 5.0 for r in range(4) for c in range(4)}
    other = {k: x for k, x in (base | change).items() if x != "gone"}
    frame = lambda cells, d: spark.createDataFrame([("k", r + d, c, x) for (r, c), x in cells.items()], "key string, row long, col long, v double")
    offsets = spark.createDataFrame([("k", -2, 0)], "key string, d_row long, d_col long")
    limit = spark.createDataFrame([("k", 0.5)], "key string, tolerance double")
    got = compare.verify_rasters(frame(base, 0), frame(other, 2), ["v"], ["key"], limit, 1e-6, offsets).collect()
    assert [(r.level, r.note) for r in got] == [(level, note)]


def test_rasters_that_cannot_meet(spark):
    frame = lambda key, row: spark.createDataFrame([(key, row, 0, 1.0), (key, row + 1, 0, 1.0)], "key string, row long, col long, v double")
    a = frame("far", 0).unionByName(frame("lone", 0)).unionByName(frame("grid", 0)).unionByName(frame("part", 0))
    b = frame("far", 9).unionByName(frame("grid", 0)).unionByName(frame("part", 1))
    grids = spark.createDataFrame([("grid", S.VERDICT_GRID), ("far", None)], "key string, verdict string")
    got = {r.key: (r.level, r.note, r.both) for r in compare.verify_rasters(a, b, ["v"], ["key"], grids=grids).collect()}
    assert got == {"far": ("FAIL", "no common value", 0), "lone": ("WARN", "missing side", 0), "grid": ("FAIL", "grid", 2), "part": ("PASS", "", 1)}
    with pytest.raises(Exception, match="offset"):
        compare.verify_rasters(a, b, ["v"], ["key"], offsets=spark.createDataFrame([], "key string, d_row long, d_col long")).collect()


def test_notes_of_outputs(spark):
    table = contract.normalize(records(spark), admin(spark), "day")
    files = spark.createDataFrame([("day", GIDS[0], m, "done", "") for m in range(1, 13)], S.IMAGES_SCHEMA)
    good = contract.verify_notes(table, "day", sources(spark), admin(spark, GIDS[:1]), files)
    assert good.count() == 0
    report = contract.verify_report(good, "day", admin(spark, GIDS[:1])).collect()
    assert {(r.level, r.note) for r in report} == {("PASS", S.NOTE_CSV_GOOD), ("PASS", S.NOTE_IMAGES_GOOD)}
    first = S.DAY_METRICS[0]
    broken = table.filter("NOT (gid_3 = 'VNM.1.2_1' AND month = 4)").withColumn(first, F.when(F.col("month") != 6, F.col(first)))
    broken = broken.unionByName(broken.filter("gid_3 = 'VNM.1.10_1' AND month = 2"))
    empty = sources(spark, [(GIDS[0], S.YEAR, 9, "day_image", 0.0)])
    some = files.filter("month NOT IN (8, 9)").unionByName(files.filter("month = 1")).withColumn("state", F.when(F.col("month") == 3, "failed").otherwise(F.col("state"))) \
        .withColumn("error", F.when(F.col("month") == 3, "bad").otherwise(""))
    notes = contract.verify_notes(broken.select(*reversed(broken.columns)), "day", empty, admin(spark), some)
    got = {(r.gid_3, r.item, r.month): [] for r in notes.collect()}
    for r in notes.collect():
        got[r.gid_3, r.item, r.month].append(r.note)
    csv = "CSV/day_indices.csv"
    assert sorted(got[GIDS[0], csv, 0]) == sorted([S.NOTE_MONTHS, S.NOTE_SCHEMA])
    assert sorted(got[GIDS[1], csv, 0]) == sorted([S.NOTE_MONTHS, S.NOTE_KEY, S.NOTE_SCHEMA])
    assert got[GIDS[0], csv, 6] == [f"tháng 6: failed {S.MSG_MISSING}"]
    assert {m: got[GIDS[0], "Ảnh day", m] for m in (1, 3, 8)} == {1: ["tháng 1: 2 file"], 3: ["tháng 3: bad"], 8: ["tháng 8: 0 file"]}
    assert (GIDS[0], "Ảnh day", 9) not in got and (GIDS[1], "Ảnh day", 9) in got
