"""Reflectance scaling, spectral indices, masks and land-cover predicates."""

import math
from functools import reduce

from pyspark.sql import functions as F

from unitgrid.functions.numbers import col, ratio

# Cloud bits, band numbers per sensor, thresholds.
SENTINEL_CLOUD_BITS = (10, 11)
LANDSAT_CLOUD_BITS = (0, 1, 3, 4)
SENSOR_BANDS = {
    "Sentinel-2": {"B2": "BLUE", "B3": "GREEN", "B4": "RED", "B8": "NIR", "B11": "SWIR1", "B12": "SWIR2"},
    "Landsat-5": {"SR_B1": "BLUE", "SR_B2": "GREEN", "SR_B3": "RED", "SR_B4": "NIR", "SR_B5": "SWIR1",
                  "SR_B7": "SWIR2"},
    "Landsat-8": {"SR_B2": "BLUE", "SR_B3": "GREEN", "SR_B4": "RED", "SR_B5": "NIR", "SR_B6": "SWIR1",
                  "SR_B7": "SWIR2"},
}
SENSOR_BANDS["Landsat-7(SLC-off)"] = SENSOR_BANDS["Landsat-5"]
SCALING = {"Sentinel-2": (1.0 / 10000, 0.0), "Landsat": (0.0000275, -0.2)}
LIT_THRESHOLD = {"VIIRS": 1.5, "DMSP-OLS": 5.0}
ROAD_LIMITS = {"ndvi": 0.25, "mndwi": -0.05, "ndbi": -0.10}
INDUSTRIAL_LIMITS = {"swir1": 0.18, "ndbi": 0.05, "ndvi": 0.25, "mndwi": -0.05}
WATER_LIMITS = {"mndwi": 0.12, "ndvi": 0.15, "green": 0.04, "swir1": 0.10}
RECOMPUTE_EPS = 1e-6


def normalized_difference(a, b, eps=None, mask_negative=True):
    """(a - b) / (a + b). Either input below zero masks the pixel unless told otherwise."""
    a, b = col(a), col(b)
    value = ratio(a - b, a + b + F.lit(eps)) if eps is not None else ratio(a - b, a + b)
    return F.when((a >= 0) & (b >= 0), value) if mask_negative else value


def bare_soil(swir1, red, nir, blue):
    hot, cool = col(swir1) + col(red), col(nir) + col(blue)
    return ratio(hot - cool, hot + cool)


def add_indices(df, eps=None, mask_negative=True):
    """Add NDVI, NDBI, MNDWI and BSI next to the six reflectance bands."""
    nd = lambda a, b: normalized_difference(a, b, eps, mask_negative)
    return df.withColumns({
        "NDVI": nd("NIR", "RED"), "NDBI": nd("SWIR1", "NIR"), "MNDWI": nd("GREEN", "SWIR1"),
        "BSI": bare_soil("SWIR1", "RED", "NIR", "BLUE"),
    })


def scale_reflectance(df, bands, sensor="Sentinel-2"):
    """Digital numbers to reflectance."""
    if sensor == "Sentinel-2":
        return df.withColumns({b: F.col(b) / F.lit(10000.0) for b in bands})
    factor, offset = SCALING["Landsat"]
    return df.withColumns({b: F.col(b) * F.lit(factor) + F.lit(offset) for b in bands})


def rename_bands(df, sensor):
    """Keep the sensor's six bands under their common names, other columns unchanged."""
    names = SENSOR_BANDS[sensor]
    others = [c for c in df.columns if not (c.startswith("B") or c.startswith("SR_B")) or c in names.values()]
    return df.select(*others, *[F.col(old).alias(new) for old, new in names.items()])


def is_clear(qa, bits=SENTINEL_CLOUD_BITS):
    """All named quality bits are zero."""
    return col(qa).bitwiseAND(F.lit(sum(1 << b for b in bits)).cast("int")) == 0


def mask_qa(df, bands, qa="qa", bits=SENTINEL_CLOUD_BITS):
    """Blank the bands of cloudy observations."""
    clear = is_clear(qa, bits)
    return df.withColumns({b: F.when(clear, F.col(b)) for b in bands})


def valid_pixel(red="RED", green="GREEN", blue="BLUE", nodata=None):
    """Finite colours, at least one of them positive, red not the nodata value."""
    colours = [col(c) for c in (red, green, blue)]
    present = reduce(lambda a, b: a & b, [c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))
                                          for c in colours])
    positive = reduce(lambda a, b: a | b, [c > 0 for c in colours])
    ok = present & positive
    if nodata is not None:
        ok = ok & (colours[0] != F.lit(nodata))
    return F.coalesce(ok, F.lit(False))


def is_lit(radiance, sensor="VIIRS"):
    return col(radiance) >= F.lit(LIT_THRESHOLD[sensor])


def _filled(c, default):
    return F.coalesce(F.when(~F.isnan(c), c), F.lit(default))


def road_mask(ndvi="NDVI", mndwi="MNDWI", ndbi="NDBI"):
    """Dry, bare and not built-dark; reads the stored indices."""
    return ((_filled(col(ndvi), 1.0) < ROAD_LIMITS["ndvi"]) & (_filled(col(mndwi), 1.0) < ROAD_LIMITS["mndwi"])
            & (_filled(col(ndbi), -1.0) > ROAD_LIMITS["ndbi"]))


def _recomputed(a, b, default):
    return _filled(normalized_difference(a, b, RECOMPUTE_EPS, mask_negative=False), default)


def industrial_mask():
    """Bright short-wave surfaces; indices recomputed from the bands with a small denominator term."""
    return ((_filled(F.col("SWIR1"), 0.0) > INDUSTRIAL_LIMITS["swir1"])
            & (_recomputed("SWIR1", "NIR", -1.0) > INDUSTRIAL_LIMITS["ndbi"])
            & (_recomputed("NIR", "RED", 1.0) < INDUSTRIAL_LIMITS["ndvi"])
            & (_recomputed("GREEN", "SWIR1", 1.0) < INDUSTRIAL_LIMITS["mndwi"]))


def water_mask():
    return ((_recomputed("GREEN", "SWIR1", -1.0) > WATER_LIMITS["mndwi"])
            & (_recomputed("NIR", "RED", 1.0) < WATER_LIMITS["ndvi"])
            & (_filled(F.col("GREEN"), 0.0) > WATER_LIMITS["green"])
            & (_filled(F.col("SWIR1"), 1.0) < WATER_LIMITS["swir1"]))
