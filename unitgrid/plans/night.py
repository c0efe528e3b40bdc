"""Night-light indices from pixels to the contract table, in one job."""

from pyspark.sql import functions as F

from unitgrid.operators import contract, zonal


def night_long(pixels, scenes=None):
    """Reductions per unit and month with the unit's area and the number of scenes, in one aggregation.

    pixels: gid_3, month, area_ha, avg_rad, cf_cvg and, if `scenes` is given, that scene id column;
    without it every row counts as a scene.
    """
    n = F.count("*") if scenes is None else F.count_distinct(scenes)
    return zonal.night_zonal(pixels, ["gid_3", "month"],
                             extra=[F.max("area_ha").alias("area_ha"), n.cast("double").alias("n")])


def night_index_table(pixels, admin, year, scenes=None):
    """Pixels to the night table. The reductions combine before the one shuffle of the pixels."""
    long = night_long(pixels, scenes)
    return contract.normalize(zonal.night_table(long, year), admin, "night", year)


def night_from_export(wide, admin, year, check=True):
    """The same from the wide export form {metric}_{MM}."""
    from unitgrid.schema import NIGHT_EXPORT_KEYS
    long = zonal.unpivot_months(wide, ["gid_3", "area_ha"], ["n", *NIGHT_EXPORT_KEYS])
    if check:
        contract.enforce(zonal.missing_counts(long), "night export without avg_rad_count")
    return contract.normalize(zonal.night_table(long, year), admin, "night", year)
