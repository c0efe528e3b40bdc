"""Scene selection: time windows, cloud filters, collection and sensor choice, scene counts."""

from pyspark.sql import functions as F

from unitgrid.functions.dates import WIDENINGS, month_end, month_start, window_bounds
from unitgrid.functions.numbers import col
from unitgrid.operators.keys import same_keys

# Cloud limits and the sensor used in each block of years.
CLOUD_LIMIT_INDEX = 85
CLOUD_LIMIT_OLDER = 70
SENSOR_YEARS = [(2004, 2011, "Landsat-5", "LANDSAT/LT05/C02/T1_L2"),
                (2012, 2012, "Landsat-7(SLC-off)", "LANDSAT/LE07/C02/T1_L2"),
                (2013, 2026, "Landsat-8", "LANDSAT/LC08/C02/T1_L2")]


def filter_month(scenes, year, month, ts="ts", how="last_day"):
    """Scenes of a month, end exclusive. `how` is last_day or next_month."""
    start, end = month_start(F.lit(year), F.lit(month)), month_end(F.lit(year), F.lit(month), how)
    return scenes.filter((F.col(ts) >= start) & (F.col(ts) < end))


def cloud_filter(scenes, cloud="cloud", limit=CLOUD_LIMIT_OLDER):
    return scenes.filter(F.col(cloud) < limit)


def cloud_filter_or_all(scenes, group, cloud="cloud", limit=CLOUD_LIMIT_INDEX):
    """Scenes under the cloud limit, or all scenes of a group that has none.

    The groups are summed up first (combined before the shuffle) and joined back, so a very large
    group is never gathered in one task.
    """
    clear = F.coalesce(F.col(cloud) < limit, F.lit(False))
    names = [f"_g{i}" for i in range(len(group))]
    groups = scenes.groupBy(*group).agg(F.bool_or(clear).alias("_any")).toDF(*names, "_any")
    return scenes.join(groups, same_keys(group, names)).filter(clear | ~F.col("_any")).drop("_any", *names)


def prefer_collection(scenes, group, priority):
    """Scenes of the best-ranked collection present in each group; `priority` lists names, best first."""
    rank = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("collection"))
    ranked = scenes.withColumn("_rank", rank).filter("_rank > 0")
    names = [f"_g{i}" for i in range(len(group))]
    best = ranked.groupBy(*group).agg(F.min("_rank").alias("_best")).toDF(*names, "_best")
    return ranked.join(best, same_keys(group, names)).filter("_rank = _best").drop("_rank", "_best", *names)


def route_sensor(df, year="year"):
    """Sensor and collection assigned to each year; a year outside the plan is an error."""
    year = col(year)
    sensor = collection = None
    for first, last, name, coll in SENSOR_YEARS:
        hit = year.between(first, last)
        sensor = F.when(hit, name) if sensor is None else sensor.when(hit, name)
        collection = F.when(hit, coll) if collection is None else collection.when(hit, coll)
    refuse = F.raise_error(F.concat(F.lit("year outside the sensor plan: "), year.cast("string"))).cast("string")
    return df.withColumns({"sensor": sensor.otherwise(refuse), "source_collection": collection.otherwise(refuse)})


def window_class(c0="c0", c1="c1", c2="c2"):
    """0 for the month itself, 1 or 2 for the first widening that has scenes, NULL for none."""
    return F.when(col(c0) > 0, 0).when(col(c1) > 0, 1).when(col(c2) > 0, 2)


def window_histogram(plan):
    """Unit-months per window class; class -1 stands for none."""
    return (plan.groupBy(F.coalesce(window_class(), F.lit(-1)).alias("window")).agg(F.count("*").alias("n")))


def first_positive(counts):
    """First positive entry of an array of counts, else 0."""
    return F.coalesce(F.get(F.filter(counts, lambda v: v > 0), F.lit(0)), F.lit(0))


def _cells(df, cell, minx, miny, maxx, maxy):
    """Grid cells touched by each box."""
    span = lambda lo, hi: F.sequence(F.floor(col(lo) / cell), F.floor(col(hi) / cell))
    return (df.withColumn("_cx", F.explode(span(minx, maxx))).withColumn("_cy", F.explode(span(miny, maxy))))


def scene_units(scenes, units, cell):
    """Pairs of scenes and units whose boxes intersect: equi-join on grid cells.

    A pair that shares several cells is kept only in the cell of its intersection's lower corner.
    """
    s = _cells(scenes, cell, "minx", "miny", "maxx", "maxy")
    u = _cells(units.select("gid_3", *[F.col(c).alias(f"_u{c}") for c in ("minx", "miny", "maxx", "maxy")]),
               cell, "_uminx", "_uminy", "_umaxx", "_umaxy")
    corner = lambda a, b: F.floor(F.greatest(F.col(a), F.col(b)) / cell)
    touch = ((F.col("minx") <= F.col("_umaxx")) & (F.col("_uminx") <= F.col("maxx"))
             & (F.col("miny") <= F.col("_umaxy")) & (F.col("_uminy") <= F.col("maxy")))
    pairs = s.join(u, ["_cx", "_cy"]).filter(
        touch & (F.col("_cx") == corner("minx", "_uminx")) & (F.col("_cy") == corner("miny", "_uminy")))
    return pairs.select("gid_3", *[c for c in scenes.columns if c != "gid_3"])


def _window_hits(scenes, year, ts="ts"):
    """Rows of scenes once per month whose windows may hold them, with `month` and _in0, _in1, _in2, for those inside a widening."""
    reach = max(WIDENINGS) + 1
    at = lambda d: (F.year(d) - year) * 12 + F.month(d)
    first = F.greatest(at(F.date_sub(F.to_date(ts), reach)), F.lit(1))
    last = F.least(at(F.date_add(F.to_date(ts), reach)), F.lit(12))
    months = scenes.filter(first <= last).withColumn("month", F.explode(F.sequence(first, last)))
    inside = {}
    for i, days in enumerate(WIDENINGS):
        start, end = window_bounds(F.lit(year), "month", days)
        inside[f"_in{i}"] = (F.col(ts) >= start) & (F.col(ts) < end)
    return months.withColumns({"month": F.col("month").cast("long"), **inside}).filter("_in2")


def count_by_window(pairs, year, unit="gid_3", ts="ts"):
    """Scenes per unit and month in the month and in its two widenings.

    The at most four months whose windows may hold a scene follow from its date, so no range join is
    needed; counts combine before the shuffle.
    """
    return _window_hits(pairs, year, ts).groupBy(unit, "month").agg(*[F.count_if(F.col(f"_in{i}")).alias(f"c{i}") for i in range(3)])


BOX = ["minx", "miny", "maxx", "maxy"]


def count_scenes(scenes, units, year, cell):
    """Window counts of every unit and month; months without scenes have zeros.

    Only scenes that some window of the year can hold reach the spatial join; the bounds are constants, so the scan filters.
    Footprints recur: scenes of one box are counted per month before they meet a unit, and units of one box meet them once, so
    the pairs grow with the distinct boxes, not with scenes times units.
    """
    reach = max(WIDENINGS)
    near = scenes.filter((F.col("ts") >= window_bounds(F.lit(year), F.lit(1), reach)[0]) & (F.col("ts") < window_bounds(F.lit(year), F.lit(12), reach)[1]))
    c = [f"c{i}" for i in range(3)]
    hits = _window_hits(near.select("ts", *BOX), year).groupBy(*BOX, "month").agg(*[F.count_if(F.col(f"_in{i}")).alias(n) for i, n in enumerate(c)])
    # one row per footprint, with its at most twelve months
    prints = hits.groupBy(*BOX).agg(F.collect_list(F.struct("month", *c)).alias("_months"))
    places = units.select(*BOX).distinct().withColumn("gid_3", F.struct(*BOX))
    met = scene_units(prints, places, cell).select("gid_3", F.inline("_months")).groupBy("gid_3", "month").agg(*[F.sum(n).alias(n) for n in c])
    placed = met.select(*[F.col("gid_3")[b].alias(b) for b in BOX], "month", *c)
    counts = units.select("gid_3", *BOX).join(placed, BOX).groupBy("gid_3", "month").agg(*[F.sum(n).alias(n) for n in c])
    grid = units.select("gid_3").withColumn("month", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(12).cast("long"))))
    return grid.join(counts, ["gid_3", "month"], "left").select(
        "gid_3", "month", *[F.coalesce(n, F.lit(0)).alias(n) for n in c])
