"""Composites, zonal statistics and the night-light index chain."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.functions.numbers import as_double, null_if_nan, ratio, round_half
from unitgrid.functions.spectral import is_lit
from unitgrid.operators.trends import trends_rows
from unitgrid.session import materialize

# Fixed value: hectares of one 500 m pixel.
PIXEL_HA = 25.0


def composite(obs, by, bands, how="median", digital=False, few=False):
    """One row per pixel: exact median or mean of each band over its observations.

    Medians of `tinyint` and `smallint` bands keep counts per distinct value and merge them map-side: a
    pixel's state never exceeds 65,536 entries per band. With `digital` the caller promises the same of
    wider integer bands (16-bit digital numbers); with `few` as well that pixels have few observations, which
    `composite_few` then moves as they are. All other values go through `composite_wide`.
    """
    if how == "mean":
        return obs.groupBy(*by).agg(*[F.avg(b).alias(b) for b in bands])
    types = dict(obs.dtypes)
    narrow = ("tinyint", "smallint", "int", "bigint") if digital else ("tinyint", "smallint")
    if any(types[b] not in narrow for b in bands):
        return composite_wide(obs, by, bands)
    if few:
        return composite_few(obs, by, bands)
    return obs.groupBy(*by).agg(*[F.median(b).alias(b) for b in bands])


def composite_few(obs, by, bands):
    """Exact median of integer bands of pixels that mostly have few observations; the table is written.

    Of up to four values the median follows from their number, least, greatest and sum, which are exact. Partial results of
    so few are larger than the observations, so these are moved, and a task keeps four numbers per pixel and band whatever
    their number. Only pixels with more values in some band are counted per distinct value, merged map-side.
    """
    aggs, medians, many = [], [], F.lit(False)
    for i, b in enumerate(bands):
        x = F.col(b).cast("long")
        aggs += [F.count(x).alias(f"_n{i}"), F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}"), F.sum(x).alias(f"_sum{i}")]
        n, lo, hi = F.col(f"_n{i}"), F.col(f"_lo{i}"), F.col(f"_hi{i}")
        inner = F.col(f"_sum{i}") - lo - hi
        medians.append(F.when(n <= 2, (lo + hi) / 2).when(n == 3, inner.cast("double")).when(n == 4, inner / 2).alias(b))
        many |= n > 4
    close = materialize(obs.select(*by, *bands).repartition(*by).groupBy(*by).agg(*aggs).select(*by, *medians, many.alias("_many")), "pixels")
    short = close.filter("NOT _many").drop("_many")
    # written, so that its size is known where it is joined
    crowded = materialize(close.filter("_many").select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)]), "crowded")
    if not crowded.take(1):
        return short
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)])
    counted = obs.join(crowded, same, "left_semi").groupBy(*by).agg(*[F.median(b).alias(b) for b in bands])
    return short.unionByName(materialize(counted, "counted"))


# Values of one pixel up to which a median is taken in one task, in a count per value.
GATHERED = 65_536


def composite_wide(obs, by, bands, gathered=GATHERED):
    """Exact median of arbitrary doubles, NULLs and NaN as in `median`, without gathering a large pixel in one task.

    Pixels of at most `gathered` observations are aggregated directly. The others, usually few, are found by `radix_median`.
    """
    large = materialize(obs.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > gathered)
                        .select(*by, F.monotonically_increasing_id().alias("_id")), "large")
    doubles = obs.select(*by, *[F.col(b).cast("double").alias(b) for b in bands])
    medians = [F.median(b).alias(b) for b in bands]
    if not large.take(1):
        return doubles.groupBy(*by).agg(*medians)
    keyed = large.toDF(*[f"_k{i}" for i in range(len(by))], "_id")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)])
    small = doubles.join(keyed, same, "left_anti").groupBy(*by).agg(*medians)
    heavy = radix_median(doubles.join(keyed, same).select("_id", *bands), bands)
    return small.unionByName(large.join(heavy, "_id", "left").select(*by, *bands))


def _ordered_bits(x):
    """Bits of a double as a long of the same order; NaN after all others, -0.0 as 0.0."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), x + F.lit(0.0)).cast("long")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit(2**63 - 1))).otherwise(bits)


def _value_of(key):
    bits = F.when(key < 0, key.bitwiseXOR(F.lit(2**63 - 1))).otherwise(key)
    return F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bits).cast("double")


def radix_median(rows, bands, digit=16):
    """Median per `_id` and band by radix selection.

    A double's bits, in an order-preserving form, are read `digit` at a time: the values of each (id, band) are counted per
    prefix, which combines before the shuffle, and only the prefix that holds the middle is opened further. No sort of the
    values and no copy of them; a window sees at most 2 ** digit counts.
    """
    long = (rows.unpivot(["_id"], list(bands), "_band", "_x").filter(F.col("_x").isNotNull())
            .select("_id", "_band", _ordered_bits(F.col("_x")).alias("_key")))
    group, targets = ["_id", "_band"], None
    for shift in range(64 - digit, -1, -digit):
        prefix = F.shiftright("_key", shift)
        if targets is None:
            counts = long.groupBy(*group, prefix.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
            w = Window.partitionBy(*group)
            n = F.sum("_c").over(w)
            wanted = F.array(F.struct(F.lit(0).alias("_side"), F.floor((n + 1) / 2).alias("_rank")), F.struct(F.lit(1).alias("_side"), F.floor((n + 2) / 2).alias("_rank")))
            seen = counts.withColumns({"_end": F.sum("_c").over(w.orderBy("_p")), "_w": wanted}).select(*group, "_p", "_c", "_end", F.inline("_w"))
        else:
            opened = targets.select(*group, F.col("_p").alias("_open")).distinct()
            inside = long.withColumn("_open", F.shiftright("_key", shift + digit)).join(opened, [*group, "_open"], "left_semi")
            counts = inside.groupBy(*group, "_open", prefix.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
            picked = targets.withColumnRenamed("_p", "_open")
            w = Window.partitionBy(*group, "_side").orderBy("_p")
            seen = counts.join(picked, [*group, "_open"]).withColumn("_end", F.sum("_c").over(w))
        hit = (F.col("_end") - F.col("_c") < F.col("_rank")) & (F.col("_rank") <= F.col("_end"))
        targets = materialize(seen.filter(hit).select(*group, "_side", "_p", (F.col("_rank") - F.col("_end") + F.col("_c")).alias("_rank")), "median")
    side = lambda s: F.max(F.when(F.col("_side") == s, F.col("_v")))
    middle = targets.withColumn("_v", _value_of(F.col("_p"))).groupBy(*group).agg(side(0).alias("_lo"), side(1).alias("_hi"))
    value = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.col("_lo") * 0.5 + F.col("_hi") * 0.5)
    return middle.groupBy("_id").agg(*[F.max(F.when(F.col("_band") == b, value)).alias(b) for b in bands])


def zonal_stats(pixels, by, bands):
    """Mean and population standard deviation of each band per zone."""
    aggs = []
    for b in bands:
        aggs += [F.avg(b).alias(f"{b}_mean"), F.stddev_pop(b).alias(f"{b}_stdDev")]
    return pixels.groupBy(*by).agg(*aggs)


def night_zonal(pixels, by, radiance="avg_rad", coverage="cf_cvg", sensor="VIIRS", extra=()):
    """All night reductions of a zone, and any `extra` aggregates, in one aggregation."""
    lit = is_lit(radiance, sensor)
    return pixels.groupBy(*by).agg(
        *extra,
        F.sum(radiance).alias("avg_rad_sum"), F.avg(radiance).alias("avg_rad_mean"),
        F.stddev_pop(radiance).alias("avg_rad_stdDev"), F.min(radiance).alias("avg_rad_min"),
        F.max(radiance).alias("avg_rad_max"), F.count(radiance).alias("avg_rad_count"),
        F.sum(F.when(lit, F.col(radiance))).alias("lit_rad"), F.count_if(lit).alias("is_lit"),
        F.avg(coverage).alias("cf_cvg"))


def valid_night(pixels, radiance="avg_rad", coverage="cf_cvg"):
    """Older rule: only pixels with a positive cloud-free count are read."""
    return pixels.filter(null_if_nan(F.col(radiance)).isNotNull() & (F.col(coverage) > 0))


def night_summary(pixels, by, area_m2, radiance="avg_rad", coverage="cf_cvg", sensor="VIIRS"):
    """Older per-image night row; lit area from each pixel's own cell area."""
    lit = is_lit(radiance, sensor)
    agg = valid_night(pixels, radiance, coverage).groupBy(*by).agg(
        F.count("*").alias("valid_pixel_count"), F.sum(radiance).alias("s"), F.avg(radiance).alias("m"),
        F.stddev_pop(radiance).alias("d"), F.min(radiance).alias("lo"), F.max(radiance).alias("hi"),
        F.count_if(lit).alias("lit_pixels"), F.sum(F.when(lit, area_m2)).alias("a"),
        F.sum(F.when(lit, F.col(radiance))).alias("p"), F.avg(coverage).alias("c"))
    return agg.select(
        *by, "valid_pixel_count", round_half("s", 4).alias("ntl_sum"), round_half("m", 4).alias("ntl_mean"),
        round_half("d", 4).alias("ntl_std"), round_half("lo", 4).alias("ntl_min"), round_half("hi", 4).alias("ntl_max"),
        F.when(F.col("m") > 0, round_half(ratio("d", "m"), 4)).otherwise(0.0).alias("spatial_cv"), "lit_pixels",
        round_half(F.coalesce("a", F.lit(0.0)) / 1e4, 2).alias("lit_area_ha"),
        round_half(100.0 * F.col("lit_pixels") / F.col("valid_pixel_count"), 2).alias("lit_ratio_pct"),
        round_half(F.coalesce("p", F.lit(0.0)), 4).alias("lit_pop_proxy"), round_half("c", 2).alias("cloud_free_obs"))


def pivot_months(long, keys, values, months=range(1, 13)):
    """Long to the wide export form {value}_{MM}; months are fixed, so no extra pass to find them."""
    return long.groupBy(*keys).agg(*[
        F.max(F.when(F.col("month") == m, F.col(v))).alias(f"{v}_{m:02d}") for m in months for v in values])


def unpivot_months(wide, keys, values, months=range(1, 13)):
    """Wide export form to one row per month, numbers parsed null-safely."""
    present = set(wide.columns)
    cell = lambda v, m: as_double(wide, f"{v}_{m:02d}") if f"{v}_{m:02d}" in present else F.lit(None).cast("double")
    rows = F.array(*[F.struct(F.lit(m).cast("long").alias("month"), *[cell(v, m).alias(v) for v in values])
                     for m in months])
    return wide.select(*keys, F.inline(rows))


def missing_counts(long):
    """Unit-months with scenes but no pixel count: an export that cannot be used."""
    return long.filter((F.coalesce("n", F.lit(0.0)) != 0) & F.col("avg_rad_count").isNull())


def night_indices(long, year=S.YEAR):
    """Night metrics from reductions: months without scenes dropped, missing numbers count as zero."""
    num = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    rows = long.filter(num("n") != 0)
    lit, total = num("is_lit"), num("avg_rad_count")
    mean, std = num("avg_rad_mean"), num("avg_rad_stdDev")
    share = F.when(total > 0, ratio(lit, total) * 100.0).otherwise(0.0)
    return rows.select(
        "gid_3", F.lit(year).cast("long").alias("year"), "month",
        F.concat(F.lit(f"{year}-"), F.lpad(F.col("month").cast("string"), 2, "0")).alias("TIME"),
        round_half(num("area_ha"), 2).alias("COMMUNE_AREA_HA"), round_half(num("avg_rad_sum"), 4).alias("TNL"),
        round_half(mean, 4).alias("MEAN_RAD"), round_half(std, 4).alias("STD_RAD"),
        round_half(num("avg_rad_min"), 4).alias("MIN_RAD"), round_half(num("avg_rad_max"), 4).alias("MAX_RAD"),
        round_half(F.when(mean > 0, ratio(std, mean)).otherwise(0.0), 4).alias("SPATIAL_CV"),
        lit.cast("long").alias("LIT_PIXELS"), round_half(lit * PIXEL_HA, 2).alias("LIT_AREA_HA"),
        round_half(share, 2).alias("ELECTRIFICATION_RATIO_PCT"), round_half(num("lit_rad"), 4).alias("LIT_POP_PROXY"),
        round_half(num("cf_cvg"), 1).alias("CLOUD_FREE_OBS"))


def night_table(long, year=S.YEAR):
    """Night metrics with their trends, ready for the contract."""
    return trends_rows(night_indices(long, year), "TNL")


def empty_images(pixels, by, bands):
    """Images without any valid pixel or with zeros only, over all `bands`."""
    bands = [bands] if isinstance(bands, str) else list(bands)
    filled = F.exists(F.array(*[(F.col(b) != 0) & ~F.isnan(b) for b in bands]), lambda x: F.coalesce(x, F.lit(False)))
    return pixels.groupBy(*by).agg((F.count_if(filled) == 0).alias("empty"))
