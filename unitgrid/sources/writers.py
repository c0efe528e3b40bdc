"""Sinks: versioned publishing, partitioned tables, logs, plans and reports."""

from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from unitgrid.functions.grid import TILE
from unitgrid.operators.contract import conform, natural_sorted
from unitgrid.operators.keys import keep_last, union_all
from unitgrid.session import discard, materialize

POINTER_SCHEMA = "version string, rows long, published timestamp"


class PublishError(RuntimeError):
    """A new version could not be verified; the old one stays current."""


def publish(df, table, run_id, fmt="parquet", **options):
    """Write a new version beside the old ones, count it back, then point to it.

    Readers follow the pointer, so a failed or partial write is never seen and earlier versions stay.
    """
    spark = df.sparkSession
    version = f"{table}/v={run_id}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).options(**options).save(version)
    expected = seen.get["rows"]
    written = spark.read.format(fmt).options(**options).schema(df.schema).load(version).count()
    if written != expected:
        raise PublishError(f"{version}: {written} rows written, {expected} expected")
    (spark.range(1).select(F.lit(run_id).alias("version"), F.lit(written).cast("long").alias("rows"),
                           F.current_timestamp().alias("published"))
     .write.mode("append").json(f"{table}/_pointer"))
    return version


def current_version(spark, table):
    """Newest published version, None before the first."""
    try:
        rows = (spark.read.json(f"{table}/_pointer", schema=POINTER_SCHEMA)
                .orderBy(F.desc("published"), F.desc("version")).limit(1).collect())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows[0]["version"] if rows else None


def read_published(spark, table, schema, fmt="parquet", **options):
    version = current_version(spark, table)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).options(**options).schema(schema).load(f"{table}/v={version}")


# Rows of a range of the sorted index table.
SORT_ROWS = 100_000


def write_index(df, table, kind, run_id, digits=None):
    """Index table as CSV in contract column and row order, published as a new version."""
    df = conform(df, kind)
    if digits is not None:
        df = df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})
    # written before it is sorted: the sort samples its input, and ranges of a known number of rows fit a task
    rows = materialize(df, "index")
    version = publish(natural_sorted(rows, max(1, -(-rows.count() // SORT_ROWS))), table, run_id, "csv", header="true", escape='"')
    discard(rows)
    return version


def write_by_unit(df, path, columns=("gid_1", "gid_3"), fmt="parquet", max_rows=5_000_000):
    """One folder per unit, replacing only the folders present in `df`.

    The rebalance hint gathers a unit's rows but splits a unit that is too large for one task.
    """
    (df.hint("rebalance", *columns).write.mode("overwrite").format(fmt)
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_rows)
     .partitionBy(*columns).save(path))


# Folders that a pixel store has at most, unless it has more rows than this many per folder; and how often the side of a folder may double.
FOLDERS, FOLDER_ROWS, DOUBLINGS = 1_000, 1_000_000, 24


def _folder_side(tiles, tile):
    """Side of the least folders, `tile` times a power of two, of which there are not too many. Folders are counted approximately, which moves the layout only."""
    sides = [tile << k for k in range(DOUBLINGS)]
    folders = [F.approx_count_distinct(F.xxhash64(F.floor(F.col("tile_row") / s), F.floor(F.col("tile_col") / s))) for s in sides]
    rows, *counts = tiles.groupBy("tile_row", "tile_col").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)), *folders).first()
    return next((s for s, n in zip(sides, counts) if n <= max(FOLDERS, rows // FOLDER_ROWS)), sides[-1])


def write_pixel_tiles(pixels, path, tile=TILE, max_rows=5_000_000):
    """Pixels by tile of `tile` x `tile` pixels, for readers that need few tiles. Large tiles become several files.

    A tile has a folder to itself unless these were too many small ones: then squares of tiles share a folder, in the order of
    tiles. Reads `pixels` twice, first to count.
    """
    at = lambda c, side: (F.floor(F.col(c) / side) * side).cast("long")
    tiles = pixels.withColumns({"tile_row": at("row", tile), "tile_col": at("col", tile)})
    side = _folder_side(tiles, tile)
    folder = ["folder_side", "folder_row", "folder_col"]
    (tiles.withColumns({"folder_side": F.lit(side), "folder_row": at("row", side), "folder_col": at("col", side)})
     .hint("rebalance", "folder_row", "folder_col").sortWithinPartitions(*folder, "tile_row", "tile_col").write
     .option("maxRecordsPerFile", max_rows).partitionBy(*folder).parquet(path))


def append_log(df, path):
    df.write.mode("append").json(path)


def combined(parts, key=("gid_3", "month"), order=("run_seq",)):
    """National table from per-unit parts: union by name, the last record of a key wins."""
    return keep_last(union_all(parts), list(key), list(order))


def plan_texts(plan):
    """One JSON object per unit, {gid: [[c0, c1, c2] x 12]}; a unit has twelve entries, so this is bounded."""
    months = F.sort_array(F.collect_list(F.struct("month", F.array("c0", "c1", "c2").alias("c"))))
    units = plan.groupBy("gid_3").agg(F.transform(months, lambda m: m["c"]).alias("months"))
    return units.select("gid_3", F.to_json(F.create_map("gid_3", "months")).alias("plan"))


def write_plan(plan, path):
    """Plan as JSON lines, one unit per line, so large plans are written in parallel."""
    plan_texts(plan).select("plan").write.mode("overwrite").text(path)


def write_report(items, path):
    items.write.mode("overwrite").json(path)
