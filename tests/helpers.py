"""Small fixtures: two units whose natural order differs from their text order."""

from pyspark.sql import functions as F

from unitgrid import schema as S

GIDS = ("VNM.1.2_1", "VNM.1.10_1")
YEAR = 2024


def admin(spark, gids=GIDS):
    return spark.createDataFrame([(g, "Xã " + g, "Xa", "VNM.1_1", "Huyện", "VNM.1_1", "Tỉnh") for g in gids],
                                 S.ADMIN_SCHEMA)


def records(spark, kind="day", gids=GIDS):
    """Twelve legacy rows per unit in which every metric equals the month."""
    base = spark.createDataFrame([(g, YEAR, m) for g in gids for m in range(1, 13)], "GID_3 string, YEAR long, MONTH long")
    metrics = {m: F.col("MONTH").cast("double") for m in S.METRICS[kind]}
    if kind == "night":
        metrics["TIME"] = F.concat(F.lit("2024-"), F.lpad(F.col("MONTH").cast("string"), 2, "0"))
        metrics[S.GROWTH] = F.when(F.col("MONTH") > 1, F.col("MONTH").cast("double"))
    return base.withColumns(metrics)


def images(spark, gids=GIDS, months=range(1, 13), kinds=("day", "night")):
    return spark.createDataFrame([(k, g, m, "done", "") for k in kinds for g in gids for m in months], S.IMAGES_SCHEMA)


def sources(spark, rows=()):
    return spark.createDataFrame(list(rows), S.SOURCES_SCHEMA)


def evidence(spark, field, months=range(1, 13), count=0.0, gids=GIDS):
    return sources(spark, [(g, YEAR, m, field, count) for g in gids for m in months])


def at(df, gid, month):
    return df.filter((F.col("gid_3") == gid) & (F.col("month") == month)).collect()[0]
