"""From export tables to evidence and to the national tables."""

from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.functions.numbers import as_double
from unitgrid.operators import contract, zonal
from unitgrid.plans.night import night_from_export


def evidence_from_exports(day=None, night=None, year=S.YEAR):
    """Source counts that exports carry: gid_3, year, month, field, count.

    day: gid_3, month, SOURCE_COUNT gives `day_indices`; night: the wide form, whose n_MM gives `night_indices` and
    `night_image`. Absent counts are no evidence. Contradictions inside an export stop the job where the evidence is used.
    """
    parts = []
    if day is not None and "SOURCE_COUNT" in day.columns:
        parts.append(day.select("gid_3", F.col("month").cast("long").alias("month"), F.lit("day_indices").alias("field"), as_double(day, "SOURCE_COUNT").alias("count")))
    if night is not None:
        long = zonal.unpivot_months(night, ["gid_3"], ["n"])
        parts.append(long.select("gid_3", "month", F.explode(F.array(F.lit("night_indices"), F.lit("night_image"))).alias("field"), F.col("n").alias("count")))
    if not parts:
        raise ValueError("no export with counts given")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.filter(F.col("count").isNotNull()).select("gid_3", F.lit(year).cast("long").alias("year"), "month", "field", "count")


def newest_evidence(sources, found):
    """Evidence after an export: its counts replace those known before, key by key; other counts stay.

    Several counts of one key inside `found`, or inside `sources` where the export has none, are kept as they are, so that
    they stop the job where the evidence is used.
    """
    if sources is None:
        return found
    key = ["gid_3", "year", "month", "field"]
    rows = sources.withColumn("_new", F.lit(False)).unionByName(found.withColumn("_new", F.lit(True)))
    ends = lambda own, side: [f(F.when(own, F.col("count"))).alias(f"{side}_{n}") for n, f in (("lo", F.min), ("hi", F.max))]
    sides = rows.groupBy(*key).agg(F.bool_or("_new").alias("_new"), *ends(F.col("_new"), "new"), *ends(~F.col("_new"), "old"))
    last = [F.when(F.col("_new"), F.col(f"new_{n}")).otherwise(F.col(f"old_{n}")) for n in ("lo", "hi")]
    return sides.select(*key, F.explode(F.array_distinct(F.array(*last))).alias("count"))


def day_from_export(export, old, admin, sources=None, year=S.YEAR):
    """National day table after an export: its year is set, its counts replace older evidence, valid old rows stay.

    Without counts in the export, and without `sources`, there is no evidence.
    """
    incoming = export.withColumn("year", F.lit(year))
    if "SOURCE_COUNT" in export.columns:
        sources = newest_evidence(sources, evidence_from_exports(day=export, year=year))
    if sources is None:
        sources = export.sparkSession.createDataFrame([], S.SOURCES_SCHEMA)
    return contract.merge_valid(old, incoming.drop("SOURCE_COUNT"), admin, "day", sources, year)


def night_merged(wide, old, admin, sources=None, year=S.YEAR):
    """National night table after an export in the wide form; its scene counts replace older evidence."""
    evidence = newest_evidence(sources, evidence_from_exports(night=wide, year=year))
    incoming = night_from_export(wide, admin, year).filter(F.col("TIME").isNotNull())
    return contract.merge_valid(old, incoming.select(*S.KEY, *S.METRICS["night"]), admin, "night", evidence, year)
