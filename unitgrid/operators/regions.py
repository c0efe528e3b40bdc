"""Regions of pixel masks: runs, opening, components, region statistics, skeleton.

A mask is a table (image_id, row, col) of its set pixels, without duplicates.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from unitgrid.functions.numbers import ratio
from unitgrid.session import discard, materialize, ship_by_value

ship_by_value(__name__)

# Sizes and limits of the region rules.
LINE_LENGTH = 5
MIN_ROAD, MIN_WATER, MIN_INDUSTRIAL = 10, 4, 5
NATURAL_M2, NATURAL_LONG_M2, LONG_ASPECT = 12000.0, 8000.0, 4.0
ASPECT_EPS = 1e-6

IMG = "image_id"
LABEL_BASE = 1 << 31      # labels are row * LABEL_BASE + column of the first pixel


def runs(mask, axis="row"):
    """Maximal runs of set pixels along rows (or columns): (image_id, line, p0, p1).

    One window partition is one line of one image, bounded by the image's width.
    """
    line, pos = ("row", "col") if axis == "row" else ("col", "row")
    w = Window.partitionBy(IMG, line).orderBy(pos)
    return (mask.select(IMG, line, pos).withColumn("_g", F.col(pos) - F.row_number().over(w))
            .groupBy(IMG, F.col(line).alias("line"), "_g")
            .agg(F.min(pos).alias("p0"), F.max(pos).alias("p1")).drop("_g"))


def _pixels(spans, axis="row"):
    line, pos = ("row", "col") if axis == "row" else ("col", "row")
    return spans.withColumn("_p", F.explode(F.sequence("p0", "p1"))).select(
        IMG, F.col("line").alias(line), F.col("_p").alias(pos)).select(IMG, "row", "col")


def described(df, images, **values):
    """`df` with one column `_name` for each of `values`: the image's own value in `images`, or without `images` the given one.

    images: image_id, height, width, pixel_area_m2, res_m, one row per image; an image that is missing, repeated or has NULL there stops the job.
    """
    if images is None:
        return df.withColumns({f"_{n}": F.lit(v) for n, v in values.items()})
    one = images.groupBy(IMG).agg(F.count("*").alias("_rows"), *[F.max(n).alias(f"_{n}") for n in values])
    stop = F.raise_error(F.concat(F.lit("image without exactly one description: "), F.col(IMG).cast("string")))
    good = F.coalesce(F.col("_rows") == 1, F.lit(False))
    return df.join(one, IMG, "left").withColumns({f"_{n}": F.when(good & F.col(f"_{n}").isNotNull(), F.col(f"_{n}")).otherwise(stop) for n in values}).drop("_rows")


def open_lines(mask, height=None, width=None, length=LINE_LENGTH, images=None):
    """Opening by a horizontal or a vertical line of `length` pixels.

    A run survives when it holds the line; beyond the image border pixels count as set, which adds
    half a line per touched side. The border is that of the image's row in `images`, else `height` and `width` for all.
    """
    half = length // 2

    def kept(axis, name, size):
        span = described(runs(mask, axis), images, **{name: size})
        extra = (F.when(F.col("p0") == 0, half).otherwise(0)
                 + F.when(F.col("p1") == F.col(f"_{name}") - 1, half).otherwise(0))
        return _pixels(span.filter(F.col("p1") - F.col("p0") + 1 + extra >= length), axis)
    return kept("row", "width", width).union(kept("col", "height", height)).distinct()


def dilate(mask):
    """Grow a mask by one pixel in all eight directions."""
    around = F.sequence(F.lit(-1), F.lit(1))
    return (mask.withColumn("_dr", F.explode(around)).withColumn("_dc", F.explode(around))
            .select(IMG, (F.col("row") + F.col("_dr")).alias("row"), (F.col("col") + F.col("_dc")).alias("col"))
            .distinct())


# --- components ------------------------------------------------------------------------------------

def _tile_labels(rows, starts, ends, width, reach):
    """Index of the first run of each run's component inside one tile; runs come in row order."""
    span = width + 4
    first = np.searchsorted(rows * span + ends, (rows + 1) * span + starts - reach, side="left")
    last = np.searchsorted(rows * span + starts, (rows + 1) * span + ends + reach, side="right")
    count = np.maximum(last - first, 0)
    u = np.repeat(np.arange(len(rows)), count)
    v = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    label = np.arange(len(rows))
    while True:
        a, b = label[u], label[v]
        if np.array_equal(a, b):
            return label
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label, label[label]):
            label = label[label]


def _tile_runs(mask, conn, tile):
    """Row runs inside tiles, labelled within their tile: one shuffle of bounded blocks."""
    reach = 1 if conn == 8 else 0

    def label_tile(key, pdf):
        image, tr, tc = key
        top, left = int(tr) * tile, int(tc) * tile
        block = np.zeros((tile, tile + 2), dtype=np.int8)
        block[pdf["row"].to_numpy() - top, pdf["col"].to_numpy() - left + 1] = 1
        turn = np.diff(block, axis=1)
        rows, starts = np.nonzero(turn == 1)
        ends = np.nonzero(turn == -1)[1] - 1
        ids = (rows + top) * LABEL_BASE + starts + left
        return pd.DataFrame({IMG: image, "line": rows + top, "p0": starts + left, "p1": ends + left,
                             "label": ids[_tile_labels(rows, starts, ends, tile, reach)]})

    at = lambda c: F.floor(F.col(c) / tile)
    cells = mask.select(F.col(IMG).cast("string").alias(IMG), F.col("row").cast("long").alias("row"),
                        F.col("col").cast("long").alias("col"), at("row").alias("_tr"), at("col").alias("_tc"))
    return cells.groupBy(IMG, "_tr", "_tc").applyInPandas(
        label_tile, f"{IMG} string, line long, p0 long, p1 long, label long")


def _border_edges(runs_, conn, tile):
    """Pairs of tile labels that touch across a tile border, both directions."""
    line, lo, hi = F.col("line"), F.col("p0"), F.col("p1")
    edge_row = (line % tile).isin(0, tile - 1)
    cols = (F.when(edge_row, F.sequence(lo, hi))
            .otherwise(F.array_compact(F.array(F.when(lo % tile == 0, lo), F.when(hi % tile == tile - 1, hi)))))
    rim = (runs_.filter(edge_row | (lo % tile == 0) | (hi % tile == tile - 1))
           .select(IMG, F.col("line").alias("row"), F.explode(F.array_distinct(cols)).alias("col"), "label"))
    steps = [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if conn == 8 else [])
    near = F.explode(F.array(*[F.struct((F.col("row") + dr).alias("row"), (F.col("col") + dc).alias("col"))
                               for dr, dc in steps])).alias("n")
    pairs = (rim.select(IMG, F.col("label").alias("a"), near).select(IMG, "a", "n.row", "n.col")
             .join(rim.withColumnRenamed("label", "b"), [IMG, "row", "col"]).filter("a <> b"))
    both = F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                             F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))
    return pairs.select(IMG, both.alias("e")).select(IMG, "e.u", "e.v").distinct()


def component_runs(mask, conn=8, tile=512):
    """Row runs (split at tile borders) with the first run of their component as label.

    Tiles are labelled on their own; only labels that touch across tile borders enter the iterative
    part. There, each round hooks every node's parent to the smallest grandparent among its neighbours
    and jumps pointers, so rounds grow with the logarithm of a component's extent. State is written out
    after each round; only a changed-rows flag reaches the driver.
    """
    labelled = materialize(_tile_runs(mask, conn, tile), "runs")
    return _united(labelled, _border_edges(labelled, conn, tile))


def join_diagonals(labelled):
    """8-connected components from runs that carry 4-connected labels of whole components, as `component_runs` gives them.

    Pixels that touch at a corner belong to different 4-connected components only if both pixels beside that corner are
    clear, so one run starts there and the other ends: contacts are found by joining ends with starts of the next line.
    Nothing is cut into tiles or expanded again; only the labels in contact enter the iteration.
    """
    ends = labelled.select(IMG, "line", F.col("p1").alias("at"), F.col("label").alias("u"))
    step = lambda k: F.struct((F.col("line") + k).alias("line"), (F.col("p0") - 1).alias("at"))
    starts = labelled.select(IMG, F.col("label").alias("v"), F.explode(F.array(step(1), step(-1))).alias("n")).select(IMG, "v", "n.line", "n.at")
    pairs = ends.join(starts, [IMG, "line", "at"]).filter("u <> v")
    both = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")
    return _united(labelled, pairs.select(IMG, both).select(IMG, "e.u", "e.v").distinct())


def _united(labelled, edges):
    """`labelled` with the smallest label that its own is connected with; edges: image_id, u, v in both directions."""
    edges = materialize(edges, "edges")
    if not edges.take(1):
        return labelled
    nodes = edges.select(IMG, F.col("u").alias("id")).distinct()
    state = materialize(nodes.select(IMG, "id", F.col("id").alias("f"), F.col("id").alias("gf")), "labels")
    while True:
        old, state = state, _hook(state, edges)
        discard(old)
        if not state.filter("moved").take(1):
            break
    final = state.select(IMG, F.col("id").alias("label"), F.col("gf").alias("_l"))
    return labelled.join(final, [IMG, "label"], "left").select(
        IMG, "line", "p0", "p1", F.coalesce("_l", "label").alias("label"))


def _hook(state, edges):
    """One round of hooking and pointer jumping."""
    near = (edges.join(state.select(IMG, F.col("id").alias("v"), "gf"), [IMG, "v"])
            .groupBy(IMG, F.col("u").alias("id")).agg(F.min("gf").alias("m")))
    seen = state.join(near, [IMG, "id"]).select(
        IMG, "id", "f", "gf", F.least("m", "gf").alias("m"))
    offers = seen.select(IMG, F.explode(F.array(F.struct(F.col("f").alias("id"), "m"),
                                                F.struct("id", "m"))).alias("o")).select(IMG, "o.id", "o.m")
    best = offers.groupBy(IMG, "id").agg(F.min("m").alias("m"))
    moved = (state.join(best, [IMG, "id"], "left")
             .select(IMG, "id", F.least("f", F.coalesce("m", "f")).alias("f"), F.col("gf").alias("old")))
    moved = materialize(moved, "hook")
    parent = moved.select(IMG, F.col("id").alias("f"), F.col("f").alias("gf"))
    found = materialize(moved.join(parent, [IMG, "f"])
                       .select(IMG, "id", "f", "gf", (F.col("gf") != F.col("old")).alias("moved")), "labels")
    discard(moved)
    return found


def label_name(label):
    """Row and first column of the run that names a component."""
    return (F.floor(label / F.lit(LABEL_BASE)).cast("long").alias("label_row"),
            (label % F.lit(LABEL_BASE)).cast("long").alias("label_col"))


def components(mask, conn=8):
    """Component label of every pixel, named by its first pixel in row order."""
    labelled = component_runs(mask, conn)
    return labelled.withColumn("col", F.explode(F.sequence("p0", "p1"))).select(
        IMG, F.col("line").alias("row"), "col", *label_name(F.col("label")))


def large_runs(mask, min_size, conn=4):
    """Labelled runs of the components of at least `min_size` pixels."""
    labelled = materialize(component_runs(mask, conn), "small")
    sizes = labelled.groupBy(IMG, "label").agg(F.sum(F.col("p1") - F.col("p0") + 1).alias("_n"))
    keep = sizes.filter(F.col("_n") >= min_size).select(IMG, "label")
    return labelled.join(keep, [IMG, "label"], "left_semi")


def remove_small(mask, min_size, conn=4):
    """Drop components below `min_size` pixels."""
    return _pixels(large_runs(mask, min_size, conn))


def region_props(labelled):
    """Area, centroid, axis lengths and aspect per component, from runs.

    Sums over a run have closed forms, so pixels are never expanded; positions are taken relative to
    the label to keep the sums small.
    """
    n = (F.col("p1") - F.col("p0") + 1).cast("double")
    top = F.floor(F.col("label") / F.lit(LABEL_BASE))
    r = (F.col("line") - top).cast("double")
    base = F.col("label") % F.lit(LABEL_BASE)
    a, b = (F.col("p0") - base).cast("double"), (F.col("p1") - base).cast("double")
    sum_c = n * (a + b) / 2
    squares = lambda k: k * (k + 1) * (2 * k + 1) / 6
    sum_cc = squares(b) - squares(a - 1)
    s = labelled.groupBy(IMG, "label").agg(
        F.sum(n).alias("n"), F.sum(r * n).alias("sr"), F.sum(sum_c).alias("sc"), F.sum(r * r * n).alias("srr"),
        F.sum(sum_cc).alias("scc"), F.sum(r * sum_c).alias("src"))
    mr, mc = F.col("sr") / F.col("n"), F.col("sc") / F.col("n")
    vr, vc = F.col("srr") / F.col("n") - mr * mr, F.col("scc") / F.col("n") - mc * mc
    vrc = F.col("src") / F.col("n") - mr * mc
    root = F.sqrt(F.pow((vr - vc) / 2, 2) + vrc * vrc)
    major = 4 * F.sqrt(F.greatest((vr + vc) / 2 + root, F.lit(0.0)))
    minor = 4 * F.sqrt(F.greatest((vr + vc) / 2 - root, F.lit(0.0)))
    row0, col0 = label_name(F.col("label"))
    return (s.select(IMG, "label", row0, col0, F.col("n").cast("long").alias("area"), (mr + F.floor(
        F.col("label") / F.lit(LABEL_BASE))).alias("centre_row"), (mc + F.col("label") % F.lit(LABEL_BASE)).alias("centre_col"),
        major.alias("major_axis"), minor.alias("minor_axis"))
        .withColumn("aspect", F.col("major_axis") / (F.col("minor_axis") + ASPECT_EPS)))


def classify_water(mask, pixel_area_m2=None, images=None):
    """Water bodies of at least four pixels with their class, natural or aquaculture.

    The mask is cut into tiles once: bodies (8-connected) are united from the 4-connected parts that are large enough.
    """
    clean = materialize(large_runs(mask, MIN_WATER, conn=4), "water")
    props = described(region_props(join_diagonals(clean)), images, pixel_area_m2=pixel_area_m2)
    area = F.col("area") * F.col("_pixel_area_m2")
    natural = (area >= NATURAL_M2) | ((F.col("aspect") >= LONG_ASPECT) & (area >= NATURAL_LONG_M2))
    return props.withColumns({"area_m2": area, "natural": natural}).drop("_pixel_area_m2")


def water_metrics(mask, pixel_area_m2=None, images=None):
    """Water pixels, areas and body counts per image."""
    bodies = described(classify_water(mask, pixel_area_m2, images), images, pixel_area_m2=pixel_area_m2)
    ha = lambda px: F.coalesce(px, F.lit(0)) * F.max("_pixel_area_m2") / 1e4
    nat = F.col("natural")
    return bodies.groupBy(IMG).agg(
        F.sum("area").alias("water_pixels"), ha(F.sum("area")).alias("water_area_ha"),
        ha(F.sum(F.when(nat, F.col("area")))).alias("water_natural_ha"),
        ha(F.sum(F.when(~nat, F.col("area")))).alias("water_aquaculture_ha"),
        F.count_if(nat).alias("water_natural_bodies"), F.count_if(~nat).alias("water_aquaculture_bodies"))


def industrial_metrics(mask, pixel_area_m2=None, images=None):
    """Clusters of at least five 8-connected pixels: count, pixels and areas per image."""
    labelled = component_runs(mask, 8)
    sizes = labelled.groupBy(IMG, "label").agg(F.sum(F.col("p1") - F.col("p0") + 1).alias("n"))
    m2 = F.sum("n") * F.max("_pixel_area_m2")
    return described(sizes.filter(F.col("n") >= MIN_INDUSTRIAL), images, pixel_area_m2=pixel_area_m2).groupBy(IMG).agg(
        F.count("*").alias("industrial_clusters"), F.sum("n").alias("industrial_pixels"),
        (m2 / 1e4).alias("industrial_area_ha"), m2.alias("industrial_area_m2"))


# --- roads -------------------------------------------------------------------------------------------

def road_corridor(mask, height=None, width=None, images=None):
    """Opened road mask without objects below ten pixels. The mask is read twice, so it is written once."""
    mask = materialize(mask.select(IMG, "row", "col"), "road")
    return remove_small(materialize(open_lines(mask, height, width, images=images), "opened"), MIN_ROAD, conn=4)


def _thin(grid, passes, core):
    """Zhang-Suen passes on a boolean array; True when the last pass still changed the core."""
    busy = False
    for _ in range(passes):
        before = grid
        for first in (True, False):
            p = np.pad(grid, 1)
            n = [p[:-2, 1:-1], p[:-2, 2:], p[1:-1, 2:], p[2:, 2:], p[2:, 1:-1], p[2:, :-2], p[1:-1, :-2], p[:-2, :-2]]
            count = sum(x.astype(np.int8) for x in n)
            turns = sum((~n[i] & n[(i + 1) % 8]).astype(np.int8) for i in range(8))
            north, east, south, west = n[0], n[2], n[4], n[6]
            if first:
                open_side = ~(north & east & south) & ~(east & south & west)
            else:
                open_side = ~(north & east & west) & ~(north & south & west)
            drop = grid & (count >= 2) & (count <= 6) & (turns == 1) & open_side
            grid = grid & ~drop
        busy = bool((before[core] != grid[core]).any())
        if np.array_equal(before, grid):
            break
    return grid, busy


def skeleton(mask, tile=256, passes=16):
    """Zhang-Suen skeleton of masks of any size.

    Images are cut into tiles with a border wide enough for `passes` passes (two pixels each), so each task thins a
    bounded block exactly. A tile whose core and border stood still in the last pass of a round cannot change in the next
    one, so only tiles near one that moved (the frontier) are thinned again, with the pixels around them; all others stay
    in the table in which they were written. Only a flag reaches the driver.
    """
    halo = 2 * passes
    reach = -(-halo // tile)
    tile_key = [IMG, "_tr", "_tc"]
    schema = f"{IMG} string, _tr long, _tc long, row long, col long"

    def thin_tile(key, pdf):
        """The tile's own pixels, and one row without a pixel if its last pass changed them."""
        image, tr, tc = key
        r0, c0, side = int(tr) * tile - halo, int(tc) * tile - halo, tile + 2 * halo
        grid = np.zeros((side, side), dtype=bool)
        grid[pdf["row"].to_numpy() - r0, pdf["col"].to_numpy() - c0] = True
        core = (slice(halo, halo + tile), slice(halo, halo + tile))
        grid, busy = _thin(grid, passes, core)
        rows, cols = np.nonzero(grid[core])
        mark = [None] * busy
        return pd.DataFrame({IMG: image, "_tr": int(tr), "_tc": int(tc), "row": pd.array([*(rows + r0 + halo), *mark], "Int64"),
                             "col": pd.array([*(cols + c0 + halo), *mark], "Int64")})

    def around(tiles):
        """The tiles and those that a border can reach from them."""
        near = F.sequence(F.lit(-reach), F.lit(reach))
        spread = tiles.withColumn("_dr", F.explode(near)).withColumn("_dc", F.explode(near))
        return spread.select(IMG, (F.col("_tr") + F.col("_dr")).alias("_tr"), (F.col("_tc") + F.col("_dc")).alias("_tc")).distinct()

    def near_tiles(pos):
        return F.explode(F.sequence(F.floor((F.col(pos) - halo) / tile), F.floor((F.col(pos) + halo) / tile)))

    own = lambda pos: F.floor(F.col(pos) / tile).alias("_tr" if pos == "row" else "_tc")
    current = mask.select(F.col(IMG).cast("string").alias(IMG), own("row"), own("col"), F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"))
    frontier, rounds = None, 0
    while True:
        source = current if frontier is None else current.join(around(frontier), tile_key, "left_semi")
        spread = source.select(IMG, "row", "col", near_tiles("row").alias("_tr")).withColumn("_tc", near_tiles("col"))
        if frontier is not None:
            spread = spread.join(frontier, tile_key, "left_semi")
        done = materialize(spread.groupBy(*tile_key).applyInPandas(thin_tile, schema), "thin")
        pixels = done.filter("row IS NOT NULL")
        current = pixels if frontier is None else pixels.unionByName(current.join(frontier, tile_key, "left_anti"))
        moved = done.filter("row IS NULL").select(*tile_key)
        if not moved.take(1):
            return current.select(IMG, "row", "col")
        rounds += 1
        if rounds % 8 == 0:  # the list of tables that a pixel may lie in stays short
            current = materialize(current, "thinned")
        frontier = materialize(around(moved), "frontier")


def road_metrics(mask, height=None, width=None, pixel_area_m2=None, res_m=None, images=None):
    """Corridor and centre-line pixels, road length and area per image."""
    corridor = materialize(road_corridor(mask, height, width, images), "corridor")
    wide = corridor.groupBy(IMG).agg(F.count("*").alias("road_corridor_pixels"))
    centre = skeleton(corridor).groupBy(IMG).agg(F.count("*").alias("road_centerline_pixels"))
    return described(wide.join(centre, IMG, "left"), images, pixel_area_m2=pixel_area_m2, res_m=res_m).select(
        IMG, "road_corridor_pixels", "road_centerline_pixels",
        (F.col("road_centerline_pixels") * F.col("_res_m") / 1000.0).alias("road_length_km"),
        (F.col("road_corridor_pixels") * F.col("_pixel_area_m2") / 1e4).alias("road_area_ha"))


def shares(df):
    """Densities and shares of the valid area; NULL when there is none."""
    area = F.when(F.col("valid_area_ha") > 0, F.col("valid_area_ha"))
    return df.withColumns({
        "road_density_km_per_km2": ratio(F.col("road_length_km"), area / 100.0),
        "industrial_share_pct": ratio(100.0 * F.col("industrial_area_ha"), area),
        "water_share_pct": ratio(100.0 * F.col("water_area_ha"), area)})


def mosaic(tiles, bands, key=()):
    """Overlapping tiles on one grid per `key` (one grid in all without it): valid values win over nodata, overlaps must agree.

    tiles: key, row_off, col_off, row, col and bands (nodata as NULL). Returns the mosaic and its conflicts.
    """
    placed = tiles.withColumns({"row": F.col("row") + F.col("row_off"), "col": F.col("col") + F.col("col_off")})
    valid = F.coalesce(*[F.col(b) for b in bands]).isNotNull()
    checks = []
    for b in bands:
        checks += [F.max(b).alias(b), (~F.min(b).eqNullSafe(F.max(b))
                                       | ((F.count(b) > 0) & (F.count(b) < F.count_if(valid)))).alias(f"_bad_{b}")]
    merged = placed.groupBy(*key, "row", "col").agg(*checks)
    bad = F.exists(F.array(*[F.col(f"_bad_{b}") for b in bands]), lambda x: x)
    return merged.withColumn("conflict", bad).select(*key, "row", "col", *bands, "conflict")
