"""Sources: tables, exports, logs, plans, polygons, manifests, pixels."""

import re

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.functions.numbers import is_finite, null_if_nan
from unitgrid.functions.text import IMAGE_NAME
from unitgrid.operators.geometry import polygon_edges
from unitgrid.operators.keys import drop_exact, one_per_key
from unitgrid.operators.scenes import first_positive
from unitgrid.session import numbered


#: Quotes are doubled inside quoted fields; a line with more or fewer fields than the header stops the job.
CSV = {"escape": '"', "mode": "FAILFAST"}


def read_admin(spark, path):
    """Administrative CSV, all text, blanks kept as empty strings, contract names in lower case."""
    df = spark.read.csv(path, header=True, **CSV)
    df = df.toDF(*[c.lower() if c.lower() in S.ADMIN_COLUMNS else c for c in df.columns])
    return df.na.fill("")


def read_index(spark, path, kind):
    """Index CSV as text columns; an absent file is an empty table of the contract's types."""
    try:
        return spark.read.csv(path, header=True, **CSV)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], S.index_schema(kind))


def read_exports(spark, folder, prefix, columns):
    """All CSVs of a folder whose name starts with `prefix`, with their file name.

    Headers are checked against `columns`, so a file with another column order is an error.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    return (spark.read.option("pathGlobFilter", f"{prefix}*.csv").option("recursiveFileLookup", "true")
            .csv(folder, header=True, schema=schema, enforceSchema=False, **CSV)
            .select("*", F.col("_metadata.file_name").alias("file_name")))


def read_log(spark, path, schema=S.STATUS_SCHEMA):
    """JSON lines; malformed lines are skipped."""
    return spark.read.json(path, schema=schema, mode="DROPMALFORMED")


PLAN_TYPE = "map<string,array<array<double>>>"
NO_PLAN = "(a text that is no plan)"


def _plan_units(texts, column):
    """Units of all texts; a text that is no plan gives one row without a unit."""
    parsed = texts.select(F.from_json(column, PLAN_TYPE).alias("p")).withColumn("p", F.coalesce("p", F.create_map(F.lit(NO_PLAN), F.lit(None).cast("array<array<double>>"))))
    return parsed.select(F.explode("p").alias("gid_3", "months"))


def _plan_wrong():
    """Not twelve months, or counts that are not three whole non-negative numbers (NULL counts too)."""
    bad = lambda v: F.coalesce(~is_finite(v) | (v < 0) | (v != F.floor(v)), F.lit(True))
    wrong = F.exists("months", lambda c: F.coalesce(F.size(c) != 3, F.lit(True)) | F.exists(c, bad))
    return F.coalesce((F.size("months") != 12) | wrong, F.lit(True))


def plan_rows(texts, column="plan"):
    """Plan JSON texts to one row per (gid_3, month) with the counts of the three windows."""
    units = texts.select(F.explode(F.from_json(column, PLAN_TYPE)).alias("gid_3", "months"))
    rows = units.select("gid_3", F.posexplode("months").alias("_m", "c"))
    return rows.select("gid_3", (F.col("_m") + 1).cast("long").alias("month"), "c")


def plan_violations(texts, column="plan"):
    """Units without twelve months or with counts that are not three whole non-negative numbers, units in several texts, and texts that are no plan."""
    units = _plan_units(texts, column)
    again = units.groupBy("gid_3").count().filter("count > 1").select("gid_3")
    return units.filter(_plan_wrong()).select("gid_3").unionByName(again).distinct()


def read_plan(texts, column="plan"):
    """Counts as integers: gid_3, month, c0, c1, c2. A unit that `plan_violations` would list stops the job."""
    units = one_per_key(_plan_units(texts, column), ["gid_3"], "plan")
    stop = F.raise_error(F.concat(F.lit("plan: unit without twelve months of three whole counts: "), F.coalesce("gid_3", F.lit("?"))))
    rows = units.filter(F.when(_plan_wrong(), stop.cast("boolean")).otherwise(F.lit(True))).select("gid_3", F.posexplode("months").alias("_m", "c"))
    return rows.select("gid_3", (F.col("_m") + 1).cast("long").alias("month"), "c").select(
        "gid_3", "month", *[F.get("c", F.lit(i)).cast("long").alias(f"c{i}") for i in range(3)])


def plan_evidence(plan, year=S.YEAR):
    """Source counts of day images: the first positive window count, else zero."""
    return plan.select("gid_3", F.lit(year).cast("long").alias("year"), "month",
                       F.lit("day_image").alias("field"),
                       first_positive(F.array("c0", "c1", "c2")).cast("double").alias("count"))


def read_polygons(spark, path, gid="GID_3", lines=False):
    """GeoJSON files to edges. `lines` reads one feature per line, which splits large files over tasks."""
    place = F.col("_metadata.file_path")
    if lines:
        features = spark.read.json(path, schema="properties map<string,string>, geometry string").select(
            "properties", "geometry", F.concat_ws("#", place, F.monotonically_increasing_id()).alias("feature"))
    else:
        files = spark.read.json(path, multiLine=True, schema="features array<struct<properties:map<string,string>,geometry:string>>")
        features = files.select(place.alias("file"), F.posexplode("features").alias("at", "f")).select(
            "f.properties", "f.geometry", F.concat_ws("#", "file", "at").alias("feature"))
    return polygon_edges(features.select(F.col("properties")[gid].alias("gid"), "geometry", "feature").filter("gid <> ''"), feature="feature")


def read_pixel_tiles(spark, path, schema):
    """Pixels that `write_pixel_tiles` wrote, with tile_row and tile_col; `geometry.pixels_of_tiles` reads only the folders it needs.

    folder_row and folder_col name a pixel's folder and carry the side of folders as metadata. A store without pixels has neither.
    """
    sides = numbered(spark, path, "folder_side=")
    store = spark.read.schema(schema)
    if not sides:
        return store.parquet(path)
    store = store.parquet(f"{path}/folder_side={sides[0]}")
    return store.withColumns({c: F.col(c).cast("long").alias(c, metadata={"side": sides[0]}) for c in ("folder_row", "folder_col")})


def read_manifest(spark, path, glob="*"):
    """Path, size and modification time of files; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
            .load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime")))


def read_sources(spark, path):
    """Source evidence CSV with exact duplicates dropped; the rules are in operators.contract."""
    return drop_exact(spark.read.csv(path, header=True, schema=S.SOURCES_SCHEMA, **CSV))


def read_scenes(spark, path, columns=None):
    scenes = spark.read.parquet(path)
    return scenes if columns is None else scenes.select(*columns)


def clean_pixels(pixels, bands, nodata=None, scale=1.0):
    """Nodata and NaN become NULL, values are scaled."""
    def value(b):
        v = null_if_nan(F.col(b).cast("double"))
        return (v if nodata is None else F.when(v != F.lit(float(nodata)), v)) * F.lit(float(scale))
    return pixels.withColumns({b: value(b) for b in bands})


def read_pixels(spark, path, bands, nodata=None, scale=1.0):
    return clean_pixels(spark.read.parquet(path), bands, nodata, scale)


def parse_image_names(manifest, admin, year=S.YEAR, path="path"):
    """Files named after a known unit in the folder of their own kind: gid_3, kind, month.

    Names carry the gid with dots replaced; the admin table maps them back.
    """
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    pattern = IMAGE_NAME.format(year=year)
    part = lambda i: F.regexp_extract(name, pattern, i)
    rows = manifest.withColumns({"_safe": part(1), "kind": part(2), "_mm": part(3)}).filter(
        (F.col("_safe") != "") & (F.lower(F.split(path, "/")[0]) == F.col("kind")))
    units = admin.select("gid_3", F.replace("gid_3", F.lit("."), F.lit("_")).alias("_safe"))
    return rows.withColumn("month", F.col("_mm").try_cast("long")).join(units, "_safe").drop("_safe", "_mm")


def parse_tile_names(manifest, prefix, swap=False, path="path"):
    """Tile offsets from `prefix-RRRR-CCCC.tif`; an untiled file sits at (0, 0); others are ignored."""
    pattern = rf"^{re.escape(prefix)}(?:-(\d+)-(\d+))?\.tif$"
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract(path, pattern, i), F.lit("")).try_cast("long"),
                                F.lit(0).cast("long"))
    row, col = (2, 1) if swap else (1, 2)
    return manifest.filter(F.col(path).rlike(pattern)).withColumns({"tile_row": part(row), "tile_col": part(col)})


def check_tiles(tiles, left, top, step, bands, tolerance=1e-3):
    """Tiles whose true position, CRS, bands or step disagree with their name."""
    ro = (F.lit(top) - F.col("origin_y")) / F.lit(step)
    co = (F.col("origin_x") - F.lit(left)) / F.lit(step)
    known = lambda wrong: F.coalesce(wrong, F.lit(True))  # metadata that cannot be read is a problem
    problem = (F.when(known((F.col("epsg") != 4326) | (F.col("bands") != bands)), "bands_or_crs")
               .when(known((F.abs(F.col("step_x") - step) > step * 1e-6) | (F.abs(F.col("step_y") + step) > step * 1e-6)
                     | (F.col("rot_x") != 0) | (F.col("rot_y") != 0)), "grid")
               .when(known((F.abs(ro - F.col("tile_row")) > tolerance) | (F.abs(co - F.col("tile_col")) > tolerance)),
                     "position"))
    return tiles.withColumns({"true_row": ro, "true_col": co, "problem": problem})
