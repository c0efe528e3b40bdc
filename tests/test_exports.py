"""Export tables through evidence to the national tables."""

import pytest
from helpers import GIDS, admin, at, records, sources
from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.operators import contract, zonal
from unitgrid.plans.exports import day_from_export, evidence_from_exports, newest_evidence, night_merged


def test_day_export_replaces_what_is_open_and_brings_evidence(spark):
    old = contract.normalize(records(spark).filter("MONTH <= 6"), admin(spark), "day")
    export = records(spark).drop("YEAR").withColumnRenamed("GID_3", "gid_3").withColumnRenamed("MONTH", "month").filter("month IN (1, 7, 8)")
    export = export.withColumns({m: F.when(F.col("month") != 8, F.col(m) * 100) for m in S.DAY_METRICS}).withColumn("SOURCE_COUNT", F.when(F.col("month") == 8, 0))
    merged = day_from_export(export, old, admin(spark), sources(spark))
    first = S.DAY_METRICS[0]
    assert at(merged, GIDS[0], 1)[first] == 1.0 and at(merged, GIDS[0], 7)[first] == 700.0 and at(merged, GIDS[0], 9)[first] is None
    evidence = evidence_from_exports(day=export)
    states = contract.metric_states(merged, "day", evidence)
    assert at(states, GIDS[1], 8).state == "no_source" and at(states, GIDS[1], 9).state == "pending"


def test_night_export_gives_evidence_for_indices_and_images(spark):
    long = spark.createDataFrame([(g, m, 10.0, 0.0 if m == 3 else 4.0) for g in GIDS for m in (1, 2, 3)], "gid_3 string, month long, area_ha double, n double")
    for c in S.NIGHT_EXPORT_KEYS:
        long = long.withColumn(c, F.when(F.col("n") > 0, 5.0))
    wide = zonal.pivot_months(long, ["gid_3", "area_ha"], ["n", *S.NIGHT_EXPORT_KEYS])
    found = {(r.gid_3, r.month, r.field): r["count"] for r in evidence_from_exports(night=wide).collect()}
    assert len(found) == 12 and found[GIDS[0], 3, "night_image"] == 0.0 and found[GIDS[1], 1, "night_indices"] == 4.0
    none = spark.createDataFrame([], S.index_schema("night"))
    merged = night_merged(wide, none, admin(spark))
    assert at(merged, GIDS[0], 1).TNL == 5.0 and at(merged, GIDS[0], 3).TNL is None
    states = contract.metric_states(merged, "night", evidence_from_exports(night=wide))
    assert at(states, GIDS[0], 3).state == "no_source" and at(states, GIDS[0], 4).state == "pending"


def test_contradictory_export_stops(spark):
    export = spark.createDataFrame([(GIDS[0], 1, 0.0), (GIDS[0], 1, 3.0)], "gid_3 string, month long, SOURCE_COUNT double")
    table = contract.normalize(records(spark), admin(spark), "day")
    with pytest.raises(Exception, match="source evidence"):
        contract.metric_states(table, "day", evidence_from_exports(day=export)).collect()
    with pytest.raises(ValueError):
        evidence_from_exports()


def test_newest_count_wins(spark):
    """A repeated export: its count replaces an older one, other counts stay, contradictions are not resolved."""
    old = sources(spark, [(GIDS[0], S.YEAR, 1, "day_indices", 4.0), (GIDS[0], S.YEAR, 2, "day_indices", 0.0), (GIDS[1], S.YEAR, 1, "day_indices", 3.0), (GIDS[1], S.YEAR, 1, "day_indices", 2.0)])
    found = sources(spark, [(GIDS[0], S.YEAR, 1, "day_indices", 5.0), (GIDS[1], S.YEAR, 9, "day_indices", 1.0), (GIDS[1], S.YEAR, 9, "day_indices", 1.0)])
    got = sorted((r.gid_3, r.month, r["count"]) for r in newest_evidence(old, found).collect())
    assert got == sorted([(GIDS[0], 1, 5.0), (GIDS[0], 2, 0.0), (GIDS[1], 1, 2.0), (GIDS[1], 1, 3.0), (GIDS[1], 9, 1.0)])
    assert newest_evidence(None, found) is found
    export = records(spark).drop("YEAR").withColumnRenamed("GID_3", "gid_3").withColumnRenamed("MONTH", "month").withColumn("SOURCE_COUNT", F.lit(5.0))
    none = spark.createDataFrame([], S.index_schema("day"))
    known = evidence_from_exports(day=export.withColumn("SOURCE_COUNT", F.lit(0.0)))
    merged = day_from_export(export, none, admin(spark), known)
    assert merged.filter(F.col(S.DAY_METRICS[0]).isNotNull()).count() == 24


def test_export_without_counts(spark):
    export = records(spark).drop("YEAR").withColumnRenamed("GID_3", "gid_3").withColumnRenamed("MONTH", "month")
    merged = day_from_export(export, spark.createDataFrame([], S.index_schema("day")), admin(spark))
    assert at(merged, GIDS[1], 12)[S.DAY_METRICS[3]] == 12.0
