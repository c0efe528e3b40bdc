"""Polygons as edge tables: bounds, tiles, pixel cuts and line overlay.

edges: gid, part, ring, x1, y1, x2, y2. In pixel units x is the column and y the row.
"""

import json

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unitgrid.functions.grid import TILE, pixel_window, planar_length
from unitgrid.operators.ordering import rank_rows
from unitgrid.session import materialize, ship_by_value

ship_by_value(__name__)

# Classes counted as main roads.
MAIN_ROADS = ["motorway", "trunk", "primary", "secondary", "tertiary", "motorway_link", "trunk_link",
              "primary_link", "secondary_link", "tertiary_link"]

def polygons_of(text):
    """Polygons (lists of rings) of a GeoJSON geometry; collections are opened to any depth."""
    out, left = [], [json.loads(text)]
    while left:
        g = left.pop()
        if g is None:
            continue
        if g["type"] == "Polygon":
            out.append(g["coordinates"])
        elif g["type"] == "MultiPolygon":
            out += g["coordinates"][::-1]
        elif g["type"] == "GeometryCollection":
            left += g["geometries"]
    return [[[[float(v) for v in point[:2]] for point in ring] for ring in rings] for rings in reversed(out)]


@F.pandas_udf(T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))))
def _polygons(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [] if t is None else polygons_of(t))


def polygon_edges(features, gid="gid", geometry="geometry", feature=None):
    """GeoJSON geometry texts to edges, features of one gid merged.

    Each polygon of each feature is a part of its gid, named after the feature: by the column `feature`, or by the row.
    So a feature that occurs twice is two parts, whose union is that of one. Polygons are read at any depth of nested
    collections; a NULL geometry has no edges, and a text that is not GeoJSON stops the job.
    """
    name = F.monotonically_increasing_id() if feature is None else F.col(feature)
    polys = (features.select(F.col(gid).alias("gid"), F.col(geometry).alias("g"), name.alias("_i"))
             .select("gid", "_i", F.posexplode(_polygons("g")).alias("_k", "rings")))
    rings = polys.select("gid", F.concat_ws(".", "_i", "_k").alias("part"),
                         F.posexplode("rings").alias("ring", "pts"))
    pairs = F.arrays_zip(F.slice("pts", 1, F.size("pts") - 1).alias("a"), F.slice("pts", 2, F.size("pts")).alias("b"))
    return (rings.select("gid", "part", "ring", F.explode(pairs).alias("e"))
            .select("gid", "part", "ring", F.col("e.a")[0].alias("x1"), F.col("e.a")[1].alias("y1"),
                    F.col("e.b")[0].alias("x2"), F.col("e.b")[1].alias("y2")))


def bounds(edges):
    """Bounding box per gid."""
    return edges.groupBy("gid").agg(
        F.min(F.least("x1", "x2")).alias("minx"), F.min(F.least("y1", "y2")).alias("miny"),
        F.max(F.greatest("x1", "x2")).alias("maxx"), F.max(F.greatest("y1", "y2")).alias("maxy"))


def windows(boxes, left=0.0, top=0.0, step=1.0, y_down=False):
    """Pixel window r0..r1, c0..c1 of each box; `y_down` when boxes are already in rows and columns."""
    miny, maxy = (-F.col("maxy"), -F.col("miny")) if y_down else (F.col("miny"), F.col("maxy"))
    return boxes.withColumns(pixel_window("minx", miny, "maxx", maxy, left, top, step))


def required_tiles(boxes, tile=TILE, by=("gid",)):
    """Tile offsets crossing each pixel window, with the columns `by`."""
    offsets = lambda lo, hi: F.sequence((F.floor(F.col(lo) / tile) * tile).cast("long"), F.col(hi).cast("long") - 1,
                                        F.lit(tile).cast("long"))
    return (boxes.withColumn("tile_row", F.explode(offsets("r0", "r1")))
            .withColumn("tile_col", F.explode(offsets("c0", "c1"))).select(*by, "tile_row", "tile_col"))


def required_whole(boxes, height, width, by=("gid",)):
    """Tiles that windows on one untiled file need: (0, 0), and (-1, -1), which never exists, if the file does not cover the window."""
    outside = (F.col("r0") < 0) | (F.col("c0") < 0) | (F.col("r1") > height) | (F.col("c1") > width)
    tile = lambda at: F.struct(F.lit(at).cast("long").alias("tile_row"), F.lit(at).cast("long").alias("tile_col"))
    return boxes.select(*by, F.inline(F.when(outside, F.array(tile(0), tile(-1))).otherwise(F.array(tile(0)))))


def needed_tiles(required):
    """Distinct tiles with the number of units that need them, written, so that their size is known where they are joined."""
    return materialize(required.groupBy("tile_row", "tile_col").agg(F.count("*").alias("units")), "tiles").filter("units > 0")


def pixels_of_tiles(store, needed):
    """Pixels of the needed tiles. On a store of `read_pixel_tiles` only the folders that hold these tiles are read."""
    key = ["tile_row", "tile_col"]
    if "folder_row" in store.columns:
        side = store.schema["folder_row"].metadata["side"]
        needed = needed.withColumns({f"folder_{c}": (F.floor(F.col(f"tile_{c}") / side) * side).cast("long") for c in ("row", "col")})
        key += ["folder_row", "folder_col"]
    return store.join(needed, key, "left_semi")


def missing_tiles(required, present):
    """Units whose cut must fail because a tile of their window is absent."""
    return (required.join(present.select("tile_row", "tile_col"), ["tile_row", "tile_col"], "left_anti")
            .select("gid", "tile_row", "tile_col"))


def polygon_spans(edges):
    """Column runs per pixel row whose centres lie inside: (gid, row, c0, c1).

    Each edge yields its crossing with every row centre it spans (half-open in y); crossings of a
    row pair up in x order. Runs of different parts are merged, so parts never count twice.
    """
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    first, last = F.ceil(lo - 0.5).cast("long"), (F.ceil(hi - 0.5) - 1).cast("long")
    rows = (edges.withColumns({"_r0": first, "_r1": last}).filter("_r1 >= _r0")
            .withColumn("row", F.explode(F.sequence("_r0", "_r1"))))
    x = F.col("x1") + (F.col("row") + 0.5 - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    w = Window.partitionBy("gid", "part", "row").orderBy("x")
    paired = (rows.select("gid", "part", "row", x.alias("x"))
              .withColumns({"_n": F.row_number().over(w), "_xb": F.lead("x").over(w)}).filter("_n % 2 = 1"))
    runs = paired.select("gid", "row", F.ceil(F.col("x") - 0.5).cast("long").alias("c0"),
                         (F.ceil(F.col("_xb") - 0.5) - 1).cast("long").alias("c1")).filter("c1 >= c0")
    order = Window.partitionBy("gid", "row").orderBy("c0", "c1")
    reach = F.max("c1").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = runs.withColumn("_new", F.when(F.col("c0") <= reach + 1, 0).otherwise(1)).withColumn(
        "_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (islands.groupBy("gid", "row", "_island").agg(F.min("c0").alias("c0"), F.max("c1").alias("c1"))
            .drop("_island"))


def clip_pixels(pixels, spans, bucket=256, key=()):
    """Pixels whose centre lies in a polygon, tagged with its gid. With `key` pixels meet spans of equal key only.

    Spans are cut at bucket borders and joined on (row, bucket); the column test is the residual.
    Pixels move once, and the optimizer broadcasts the spans when their measured size allows.
    """
    cut = (spans.withColumn("_b", F.explode(F.sequence(F.floor(F.col("c0") / bucket), F.floor(F.col("c1") / bucket))))
           .select("gid", *key, "row", "_b", "c0", "c1"))
    keyed = pixels.withColumn("_b", F.floor(F.col("col") / bucket))
    return (keyed.join(cut, [*key, "row", "_b"]).filter(F.col("col").between(F.col("c0"), F.col("c1")))
            .select("gid", *pixels.columns))


def cut_windows(pixels, boxes, spans, bands, bucket=256):
    """Full pixel window of each polygon; bands outside the polygon are blanked.

    The spans of a row do not overlap, so the left join on (gid, row) matches a pixel at most once.
    """
    cut = boxes.withColumn("_row", F.explode(F.sequence(F.col("r0").cast("long"), F.col("r1").cast("long") - 1)))
    frames = cut.select("gid", F.col("_row").alias("row"), F.col("c0").cast("long").alias("c0"),
                        (F.col("c1") - 1).cast("long").alias("c1"))
    framed = clip_pixels(pixels, frames, bucket)
    runs = spans.select(F.col("gid").alias("_g"), F.col("row").alias("_r"), F.col("c0").alias("_c0"), F.col("c1").alias("_c1"))
    here = ((F.col("gid") == F.col("_g")) & (F.col("row") == F.col("_r"))
            & F.col("col").between(F.col("_c0"), F.col("_c1")))
    out = framed.join(runs, here, "left").withColumn("inside", F.col("_g").isNotNull()).drop("_g", "_r", "_c0", "_c1")
    return out.withColumns({b: F.when(F.col("inside"), F.col(b)) for b in bands})


# --- lines ---------------------------------------------------------------------------------------

def segments(points, key=("way_id",), seq="seq", carry=("class",)):
    """Consecutive points of a polyline as segments; `seq` orders the points and may have gaps.

    Points are ranked by (way, seq) in a global range sort and each is joined to the next rank of its own
    way: no window gathers a long line in one task.
    """
    ranked = rank_rows(points.select(*key, seq, *carry, "x", "y"), [*key, seq, "x", "y"], "_rank")
    a = ranked.select(*key, "_rank", seq, *carry, F.col("x").alias("x1"), F.col("y").alias("y1"))
    b = ranked.select(*key, (F.col("_rank") - 1).alias("_rank"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    return a.join(b, [*key, "_rank"]).drop("_rank")


def _boxed(df):
    return df.withColumns({"_lx": F.least("x1", "x2"), "_hx": F.greatest("x1", "x2"),
                           "_ly": F.least("y1", "y2"), "_hy": F.greatest("y1", "y2")})


def _on_cells(df, prefix, cell):
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
    return (df.withColumn("_cx", F.explode(span(f"{prefix}lx", f"{prefix}hx")))
            .withColumn("_cy", F.explode(span(f"{prefix}ly", f"{prefix}hy"))))


def _meets(a, b, cell):
    """Boxes touch, and this cell is the one that owns the pair."""
    corner = lambda axis: F.floor(F.greatest(F.col(f"{a}l{axis}"), F.col(f"{b}l{axis}")) / cell)
    return ((F.col(f"{a}lx") <= F.col(f"{b}hx")) & (F.col(f"{b}lx") <= F.col(f"{a}hx"))
            & (F.col(f"{a}ly") <= F.col(f"{b}hy")) & (F.col(f"{b}ly") <= F.col(f"{a}hy"))
            & (F.col("_cx") == corner("x")) & (F.col("_cy") == corner("y")))


def _merged(intervals):
    """Union of sorted (t0, t1) intervals."""
    def step(done, p):
        last = F.element_at(done, -1)
        longer = F.struct(last["t0"].alias("t0"), F.greatest(last["t1"], p["t1"]).alias("t1"))
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["t1"] >= p["t0"]),
                      F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(p)))
    return F.aggregate(F.slice(intervals, F.lit(2), F.greatest(F.size(intervals) - 1, F.lit(0))), F.slice(intervals, 1, 1), step)


def inside_pieces(segs, edges, cell, key=("way_id", "seq")):
    """Parts of segments inside polygons, (gid, the segment's columns, t0, t1), and the segments whose box meets a polygon's.

    `key` names a segment. Segments meet parts by their boxes, in an equi-join on grid cells, and a part's edges by slabs of y of height `cell`.
    One ray test of its start tells whether a segment begins inside a part: a ray to the right crosses the outline an odd
    number of times, edges counted half-open in y. From there its crossings take it in and out by turns. The ray rule equals
    testing the point moved by an infinitesimal (d, e), e much smaller than d; crossings follow the same rule, so vertices on
    the segment's line, edges along it and starts on the outline need no cases of their own. Pieces inside several parts
    count once.
    """
    seg_cells = _on_cells(_boxed(segs), "_", cell)
    box = [F.min(F.least("x1", "x2")).alias("_plx"), F.min(F.least("y1", "y2")).alias("_ply"),
           F.max(F.greatest("x1", "x2")).alias("_phx"), F.max(F.greatest("y1", "y2")).alias("_phy")]
    # written, so that the size of the boxes is known where they are joined; a box without a part is the gid's
    boxes = materialize(edges.groupBy("gid", "part").agg(*box).unionByName(edges.groupBy("gid").agg(*box).withColumn("part", F.lit(None).cast("string"))), "boxes")
    near = lambda own: (seg_cells.join(_on_cells(boxes.filter(own), "_p", cell), ["_cx", "_cy"]).filter(_meets("_", "_p", cell))
                        .select("gid", "part", *segs.columns))
    e = {c: F.col("e" + c) for c in ("x1", "y1", "x2", "y2")}
    edge = edges.select("gid", "part", *[F.col(c).alias("e" + c) for c in e])
    edge_box = edge.withColumns({"_elx": F.least("ex1", "ex2"), "_ehx": F.greatest("ex1", "ex2"),
                                 "_ely": F.least("ey1", "ey2"), "_ehy": F.greatest("ey1", "ey2")})
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    ex, ey = e["x2"] - e["x1"], e["y2"] - e["y1"]
    moved = lambda s, tie: F.when(s == 0, tie).otherwise(F.signum(s))
    side = lambda n: moved(dx * (e["y" + n] - F.col("y1")) - dy * (e["x" + n] - F.col("x1")), F.when(dy != 0, F.signum(dy)).otherwise(-F.signum(dx)))
    t = F.try_divide((e["x1"] - F.col("x1")) * ey - (e["y1"] - F.col("y1")) * ex, dx * ey - dy * ex)
    leaves = F.when(ey != 0, -F.signum(ey)).otherwise(F.signum(ex)) != F.signum(ex * (F.col("y2") - e["y1"]) - ey * (F.col("x2") - e["x1"]))
    crossed = (seg_cells.join(_on_cells(edge_box, "_e", cell), ["_cx", "_cy"]).filter(_meets("_", "_e", cell)).filter(side("1") != side("2"))
               .withColumn("_t", t).filter((F.col("_t") >= 0) & (F.col("_t") < 1)).filter((F.col("_t") > 0) | leaves))
    slab = lambda y: F.floor(y / cell)
    low, high = F.least("ey1", "ey2"), F.greatest("ey1", "ey2")
    slabs = edge.filter("ey1 <> ey2").withColumn("_slab", F.explode(F.sequence(slab(low), slab(high))))
    right = e["x1"] + (F.col("y1") - e["y1"]) * ex / ey > F.col("x1")
    rays = (near("part IS NOT NULL").withColumn("_slab", slab(F.col("y1"))).join(slabs, ["gid", "part", "_slab"])
            .filter((low <= F.col("y1")) & (F.col("y1") < high) & right).withColumn("_t", F.lit(None).cast("double")))
    columns = ["gid", "part", *segs.columns, "_t"]
    hits = crossed.select(*columns).unionByName(rays.select(*columns))
    # one shuffle serves both groupings
    parts = hits.repartition("gid", *key).groupBy("gid", "part", *segs.columns).agg(
        (F.count_if(F.col("_t").isNull()) % 2).cast("int").alias("_odd"), F.sort_array(F.collect_list("_t")).alias("_ts"))
    begin = lambda i: F.when(i == 0, 0.0).otherwise(F.get("_ts", i - 1))
    end = lambda i: F.when(i == F.size("_ts"), 1.0).otherwise(F.get("_ts", i))
    turns = F.when(F.col("_odd") + F.size("_ts") > 0, F.sequence(1 - F.col("_odd"), F.size("_ts"), F.lit(2)))
    pieces = F.filter(F.transform(turns, lambda i: F.struct(begin(i).alias("t0"), end(i).alias("t1"))), lambda p: p["t1"] > p["t0"])
    whole = (parts.select("gid", *segs.columns, F.explode(pieces).alias("_p"))
             .groupBy("gid", *segs.columns).agg(F.sort_array(F.collect_list("_p")).alias("_in")))
    return whole.select("gid", *segs.columns, F.inline(_merged(F.col("_in")))), near("part IS NULL").select("gid", *segs.columns)


def clip_line_length(segs, edges, cell, main=MAIN_ROADS, length=planar_length, factor=1e-3, digits=4):
    """Line length inside each polygon, total and main classes, and the number of lines inside.

    A polygon whose box meets no line has NULL lengths; one met only outside its outline has 0.0. Segments of one course
    (the same two ends in the same order) are cut once, however many lines run there, and each of them counts.
    """
    ends = ["x1", "y1", "x2", "y2"]
    segs = materialize(segs.select("way_id", "class", *ends), "segments")  # read twice below, so written once
    courses = materialize(segs.select(*ends).distinct().withColumn("course", F.monotonically_increasing_id()), "courses")
    pieces, cand = inside_pieces(courses, edges, cell, key=("course",))
    cut = lambda t, a, b: F.col(a) + F.col(t) * (F.col(b) - F.col(a))
    measured = pieces.withColumns({"_ax": cut("t0", "x1", "x2"), "_ay": cut("t0", "y1", "y2"),
                                   "_bx": cut("t1", "x1", "x2"), "_by": cut("t1", "y1", "y2")}
                                  ).withColumn("_len", length("_ax", "_ay", "_bx", "_by") * factor)
    # written, so that its size is known where the segments meet it
    within = materialize(measured.groupBy("gid", *ends).agg(F.sum("_len").alias("_len")), "within")
    totals = segs.join(within, ends).groupBy("gid").agg(
        F.sum("_len").alias("total"), F.sum(F.when(F.col("class").isin(*main), F.col("_len"))).alias("main"),
        F.count_distinct("way_id").alias("lines"))
    met = cand.groupBy("gid").agg(F.count("*").alias("met"))
    zero = F.when(F.col("met").isNotNull(), 0.0)
    return (edges.select("gid").distinct().join(met, "gid", "left").join(totals, "gid", "left").select(
        "gid", F.round(F.coalesce("total", zero), digits).alias("km_total"),
        F.round(F.coalesce("main", zero), digits).alias("km_main"), F.coalesce("lines", F.lit(0)).alias("lines")))
