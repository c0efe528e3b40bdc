"""Comparing tables and rasters."""

from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.functions.grid import grid_offset, is_whole

TOLERANCE = 1e-6


def diff_summary(pairs, left, right, by=()):
    """Counts of present values, largest difference and NULL mismatches of two columns."""
    a, b = F.col(left), F.col(right)
    return pairs.groupBy(*by).agg(
        F.count_if(a.isNotNull() & b.isNotNull()).alias("both"),
        F.count_if(a.isNotNull() & b.isNull()).alias("only_left"),
        F.count_if(a.isNull() & b.isNotNull()).alias("only_right"),
        F.max(F.abs(a - b)).alias("max_abs_diff"))


def compare_rasters(a, b, bands, key=(), d_row=0, d_col=0, tolerance=TOLERANCE, offsets=None):
    """Aligned pixel comparison per key. `b` is shifted by whole pixels onto the grid of `a`, by its key's row in `offsets` (key, d_row,
    d_col; a key that is missing or repeated there stops the job) or by `d_row` and `d_col`.

    A pixel is present where any band is; differences and NULL mismatches cover all bands of pixels present in both. A mismatch is a difference.
    """
    at = [*key, "row", "col"]
    shift = F.lit(d_row), F.lit(d_col)
    if offsets is not None:
        one = offsets.groupBy(*key).agg(F.count("*").alias("_rows"), F.max("d_row").alias("_d_row"), F.max("d_col").alias("_d_col"))
        b = b.join(one, list(key), "left")
        shift = [F.when(F.coalesce(F.col("_rows") == 1, F.lit(False)) & F.col(d).isNotNull(), F.col(d)).otherwise(F.raise_error(F.lit("key without exactly one offset")))
                 for d in ("_d_row", "_d_col")]
    right = b.select(*key, (F.col("row") + shift[0]).alias("row"), (F.col("col") + shift[1]).alias("col"),
                     *[F.col(x).alias(f"_b_{x}") for x in bands])
    both = a.select(*at, *bands).join(right, at, "full")
    new, old = F.coalesce(*bands).isNotNull(), F.coalesce(*[f"_b_{x}" for x in bands]).isNotNull()
    worst = F.array_max(F.array(*[F.abs(F.col(x) - F.col(f"_b_{x}")) for x in bands]))
    holes = F.size(F.filter(F.array(*[F.col(x).isNull() != F.col(f"_b_{x}").isNull() for x in bands]), lambda x: x))
    out = both.groupBy(*key).agg(
        F.count_if(new & old).alias("px_both"), F.count_if(new & ~old).alias("px_only_new"), F.count_if(~new & old).alias("px_only_old"),
        F.max(worst).alias("max_abs_diff"), F.coalesce(F.sum(F.when(new & old, holes)), F.lit(0)).alias("null_mismatch"))
    verdict = (F.when(F.col("null_mismatch") > 0, S.VERDICT_VALUES).when(F.col("max_abs_diff").isNull(), S.VERDICT_DISJOINT)
               .when(F.col("max_abs_diff") <= tolerance, S.VERDICT_SAME).otherwise(S.VERDICT_VALUES))
    return out.withColumn("verdict", verdict)


def verify_rasters(a, b, bands, key, tolerances=None, tolerance=TOLERANCE, offsets=None, grids=None):
    """Verification of rasters per key: both (values present on both sides), max_abs_diff, null_mismatch, level and note.

    `b` is shifted by its key's row in `offsets` (key, d_row, d_col). tolerances: key, tolerance; without a row there `tolerance` holds.
    grids: key, verdict (`grid_verdict`); a key with one is on another grid. FAIL: another grid, no common value, or a difference above the
    tolerance; WARN: values agree, but a value is present on one side only, inside the overlap of both extents, or one side has no
    raster of the key; else PASS. A key whose extents do not overlap has no common value.
    """
    moved, key = b, list(key)
    if offsets is not None:
        one = offsets.groupBy(*key).agg(F.count("*").alias("_rows"), F.max("d_row").alias("_d_row"), F.max("d_col").alias("_d_col"))
        good = F.coalesce(F.col("_rows") == 1, F.lit(False)) & F.col("_d_row").isNotNull() & F.col("_d_col").isNotNull()
        shift = lambda c, d: F.when(good, F.col(c) + F.col(d)).otherwise(F.raise_error(F.lit("key without exactly one offset")).cast("long"))
        moved = b.join(one, key, "left").withColumns({"row": shift("row", "_d_row"), "col": shift("col", "_d_col")})
    at = [*key, "row", "col"]
    both = a.select(*at, F.lit(True).alias("_l"), *bands).join(
        moved.select(*at, F.lit(True).alias("_r"), *[F.col(x).alias(f"_b_{x}") for x in bands]), at, "full")
    ends = lambda side: [f(F.when(F.col(side), F.col(c))).alias(f"{side}_{n}_{c}") for n, f in (("lo", F.min), ("hi", F.max)) for c in ("row", "col")]
    extent = both.groupBy(*key).agg(*ends("_l"), *ends("_r"))
    # extents are few numbers per key; pixels outside the common window are no mismatch
    inside = F.lit(True)
    for c in ("row", "col"):
        inside &= F.col(c).between(F.greatest(f"_l_lo_{c}", f"_r_lo_{c}"), F.least(f"_l_hi_{c}", f"_r_hi_{c}"))
    pairs = [(F.col(x), F.col(f"_b_{x}")) for x in bands]
    counted = lambda test: sum((test(x, y).cast("long") for x, y in pairs), F.lit(0).cast("long"))
    lone = F.coalesce(F.col("_l_lo_row").isNull() | F.col("_r_lo_row").isNull(), F.lit(True))
    out = both.join(extent, key).groupBy(*key).agg(
        F.sum(F.when(inside, counted(lambda x, y: x.isNotNull() & y.isNotNull())).otherwise(0)).alias("both"),
        F.max(F.when(inside, F.array_max(F.array(*[F.abs(x - y) for x, y in pairs])))).alias("max_abs_diff"),
        F.sum(F.when(inside, counted(lambda x, y: x.isNull() != y.isNull())).otherwise(0)).alias("null_mismatch"), F.bool_or(lone).alias("_lone"))
    if tolerances is not None:
        out = out.join(tolerances.groupBy(*key).agg(F.min("tolerance").alias("_tolerance")), key, "left")
    else:
        out = out.withColumn("_tolerance", F.lit(None).cast("double"))
    if grids is not None:
        out = out.join(grids.filter(F.col("verdict").isNotNull()).select(*key, F.lit(True).alias("_grid")).distinct(), key, "left")
    else:
        out = out.withColumn("_grid", F.lit(None).cast("boolean"))
    limit = F.coalesce("_tolerance", F.lit(tolerance))
    note = (F.when(F.col("_lone"), "missing side").when(F.col("_grid"), "grid").when(F.col("both") == 0, "no common value")
            .when(F.col("max_abs_diff") > limit, "values").when(F.col("null_mismatch") > 0, "nodata").otherwise(""))
    level = F.when(note.isin("missing side", "nodata"), "WARN").when(note == "", "PASS").otherwise("FAIL")
    return out.select(*key, "both", "max_abs_diff", "null_mismatch", level.alias("level"), note.alias("note"))


def grid_verdict(manifest, left_a, left_b, top_a, top_b, step_a, step_b):
    """Offset of two grids in pixels; a fractional offset or another step is a different grid."""
    dc, dr = grid_offset(left_b, left_a, step_a), grid_offset(top_a, top_b, step_a)
    same = is_whole(dc) & is_whole(dr) & (F.abs(F.col(step_b) - F.col(step_a)) <= 1e-12)
    return manifest.withColumns({"d_row": dr, "d_col": dc,
                                 "verdict": F.when(~same, S.VERDICT_GRID)})


def compare_index(mine, reference, metrics, key, by, tolerance=TOLERANCE):
    """Per unit: rows on each side, largest difference over all metrics, NULL mismatches, PASS or FAIL."""
    other = reference.select(*key, F.lit(True).alias("_r"), *[F.col(m).alias(f"_r_{m}") for m in metrics])
    both = mine.select(*key, F.lit(True).alias("_l"), *metrics).join(other, key, "full")
    diff = F.array_max(F.array(*[F.abs(F.col(m).cast("double") - F.col(f"_r_{m}").cast("double")) for m in metrics]))
    holes = F.size(F.filter(F.array(*[F.col(m).isNull() != F.col(f"_r_{m}").isNull() for m in metrics]), lambda x: x))
    out = both.groupBy(*by).agg(
        F.count("_l").alias("rows_left"), F.count("_r").alias("rows_right"),
        F.max(diff).alias("max_abs_diff"),
        F.sum(F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull(), holes).otherwise(0)).alias("null_mismatch"))
    good = ((F.col("rows_left") == F.col("rows_right")) & (F.col("null_mismatch") == 0)
            & (F.coalesce("max_abs_diff", F.lit(0.0)) <= tolerance))
    return out.withColumn("level", F.when(good, "PASS").otherwise("FAIL"))


def table_differences(a, b):
    """Rows found on one side only, with multiplicity."""
    b = b.select(*[F.col(c).cast(t).alias(c) for c, t in a.dtypes])
    return (a.exceptAll(b).withColumn("side", F.lit("left"))
            .unionByName(b.exceptAll(a).withColumn("side", F.lit("right"))))


def same_table(a, b):
    """True when both tables hold the same rows under the types of `a`."""
    return set(a.columns) == set(b.columns) and not table_differences(a, b).take(1)


def reuse_verdicts(manifest, cache, fingerprint=("size", "mtime", "hash", "version"), path="path"):
    """Manifest rows with the cached state where path and fingerprint are unchanged and it was `done`."""
    known = cache.filter(F.col("state") == "done").select(path, *fingerprint, F.lit(True).alias("_hit")).distinct()
    return (manifest.join(known, [path, *fingerprint], "left")
            .withColumn("state", F.when(F.col("_hit"), "done")).drop("_hit"))


def to_validate(manifest, cache, fingerprint=("size", "mtime", "hash", "version"), path="path"):
    """Files that have no reusable verdict."""
    known = cache.filter(F.col("state") == "done").select(path, *fingerprint)
    return manifest.join(known, [path, *fingerprint], "left_anti")
