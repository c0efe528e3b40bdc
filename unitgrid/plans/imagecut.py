"""Export tiles to unit images: what is there, what is cut, what fails, in one plan.

A unit's image of a group (one export, `prefix`) can be cut when every tile that its window crosses is present: a relational
division of the tiles needed by the tiles present. Units that fail stop no others.
"""

from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.operators import geometry
from unitgrid.session import materialize


def cut_states(need, boxes, present, images, tile=geometry.TILE, whole=None):
    """State of every needed image: prefix, gid, had, state, error, cut (whether it is to be cut now).

    need: prefix, gid, had (the image is there or its source is empty). boxes: gid and pixel window; a unit without one has no boundary.
    present: prefix, tile_row, tile_col. images: prefix, state, error (`contract.check_images` of the export). whole: prefix, height,
    width of exports that are one untiled file; a window beyond its edge lacks a tile. Repeated rows count once; an unknown `had` is
    false; a group without metadata fails as one that cannot be read.
    """
    need = need.groupBy("prefix", "gid").agg(F.coalesce(F.bool_or("had"), F.lit(False)).alias("had"))
    boxes = boxes.dropDuplicates(["gid"])
    open_work = need.filter(~F.col("had")).join(boxes, "gid")
    tiled, untiled = open_work, None
    if whole is not None:
        tiled = open_work.join(whole, "prefix", "left_anti")
        untiled = geometry.required_whole(open_work.join(whole, "prefix"), F.col("height"), F.col("width"), by=["prefix", "gid"])
    required = geometry.required_tiles(tiled, tile, by=["prefix", "gid"])
    if untiled is not None:
        required = required.unionByName(untiled)
    there = present.select("prefix", "tile_row", "tile_col").distinct().withColumn("_there", F.lit(True))
    covered = required.join(there, ["prefix", "tile_row", "tile_col"], "left").groupBy("prefix", "gid").agg(
        F.count_if(F.col("_there").isNull()).alias("_gaps"))
    known = images.groupBy("prefix").agg(F.max(F.struct((F.col("state") != "done").alias("bad"), "error")).alias("_image"))
    out = need.join(covered, ["prefix", "gid"], "left").join(known, "prefix", "left")
    error = (F.when(F.col("had"), "").when(F.col("_gaps").isNull(), S.MSG_NO_GEOMETRY).when(F.col("_gaps") > 0, S.MSG_TILES_MISSING)
             .when(F.col("_image").isNull(), S.MSG_BANDS_CRS).when(F.col("_image")["bad"], F.col("_image")["error"]).otherwise(""))
    return out.select("prefix", "gid", "had", error.alias("error")).select(
        "prefix", "gid", "had", F.when(F.col("error") == "", "done").otherwise("failed").alias("state"), "error",
        (~F.col("had") & (F.col("error") == "")).alias("cut"))


def cut_pixels(states, boxes, spans, store, tile=geometry.TILE):
    """Pixels inside the boundaries of the images to be cut: prefix, gid and the columns of `store`.

    store: prefix, tile_row, tile_col, row, col and bands. Its tiles are joined first, so only those that some image needs are read
    where it is partitioned by them.
    """
    ready = materialize(states.filter("cut").select("prefix", "gid"), "cut")
    tiles = geometry.required_tiles(ready.join(boxes.dropDuplicates(["gid"]), "gid"), tile, by=["prefix", "gid"])
    tiles = materialize(tiles.select("prefix", "tile_row", "tile_col").distinct(), "tiles")
    pixels = store.join(tiles, ["prefix", "tile_row", "tile_col"], "left_semi")
    return geometry.clip_pixels(pixels, ready.join(spans, "gid"), key=["prefix"])


def group_outcomes(states):
    """Per group: units, had, cut, failed, and its state: failed if a boundary is unknown, partial if an image failed, else done."""
    counted = states.groupBy("prefix").agg(
        F.count("*").alias("units"), F.count_if("had").alias("had"), F.count_if("cut").alias("cut"), F.count_if(F.col("state") == "failed").alias("failed"),
        F.count_if(F.col("error") == S.MSG_NO_GEOMETRY).alias("_unbounded"))
    return counted.withColumn("state", F.when(F.col("_unbounded") > 0, "failed").when(F.col("failed") > 0, "partial").otherwise("done")).drop("_unbounded")


def image_updates(states, groups):
    """State updates for `contract.apply_updates`. groups: prefix, kind, month. Images that were there before change nothing."""
    return states.filter(~F.col("had")).join(groups, "prefix").select(
        F.col("gid").alias("gid_3"), F.col("month").cast("long").alias("month"), F.concat("kind", F.lit("_image")).alias("field"), "state", "error")
