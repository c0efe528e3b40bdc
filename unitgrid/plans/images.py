"""Image analytics: one row per image with road, industrial, water and spectral metrics."""

from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.functions import spectral
from unitgrid.operators import regions, zonal
from unitgrid.session import materialize


def analyze_images(indexed, height=None, width=None, pixel_area_m2=None, res_m=None, images=None):
    """Summary row per image, those without a valid pixel included (zero counts, NULL statistics), with its size, bands and resolution.

    `indexed` has image_id, row, col and the ten day bands; `images` the size and resolution of each image
    (`regions.described`), else those given hold for all.
    """
    by = [regions.IMG]
    valid = materialize(indexed.filter(spectral.valid_pixel())
                        .select(*by, "row", "col", *S.DAY_BANDS), "valid")
    mask = lambda predicate: valid.filter(predicate).select(*by, "row", "col")
    counted = valid.groupBy(*by).agg(F.count("*").alias("valid_pixels"))
    out = indexed.select(*by).distinct().join(counted, by, "left").na.fill(0, ["valid_pixels"])
    out = regions.described(out, images, height=height, width=width, pixel_area_m2=pixel_area_m2, res_m=res_m)
    out = out.select(*by, F.col("_height").cast("long").alias("img_height"), F.col("_width").cast("long").alias("img_width"), F.lit(len(S.DAY_BANDS)).cast("long").alias("n_bands"),
                     F.round("_res_m", 2).alias("pixel_size_m"), "valid_pixels", (F.col("valid_pixels") * F.col("_pixel_area_m2") / 1e4).alias("valid_area_ha"))
    parts = [regions.road_metrics(mask(spectral.road_mask()), height, width, pixel_area_m2, res_m, images),
             regions.industrial_metrics(mask(spectral.industrial_mask()), pixel_area_m2, images),
             regions.water_metrics(mask(spectral.water_mask()), pixel_area_m2, images)]
    for part in parts:
        out = out.join(part, by, "left")
    stats = zonal.zonal_stats(valid, by, S.DAY_BANDS)
    stats = stats.select(*by, *[F.round(c, 6).alias(c) for c in S.DAY_METRICS])
    counts = [c for p in parts for c in p.columns if c not in by]
    return regions.shares(out.join(stats, by, "left").na.fill(0, counts))
