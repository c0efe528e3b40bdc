import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.functions import numbers, spectral, text
from unitgrid.operators import compare, keys, ordering, scenes, status, trends, zonal


def test_rank_and_running_sum(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit(1).alias("same"))
    ranked = ordering.rank_rows(df, ["same", "k"]).collect()
    assert all(r["rank"] == r.k + 1 for r in ranked) and len(ranked) == 5000
    inside = ordering.rank_in_groups(df.withColumn("g", F.col("k") % 3), ["g"], ["k"]).collect()
    assert all(r["rank"] == r.k // 3 + 1 for r in inside) and len(inside) == 5000
    summed = ordering.running_sum(df, ["same", "k"], F.col("k"), "s").collect()
    assert all(r.s == r.k * (r.k + 1) // 2 for r in summed)


def test_natural_order(spark):
    ids = ["A.10_1", "A.2_1", "A.2_10", "A.2_9", "B.1", "A.123456789012345678901", "A.02"]
    df = spark.createDataFrame([(i,) for i in ids], "gid_3 string")
    got = [r.gid_3 for r in ordering.natural_order(df).orderBy("rank").collect()]
    assert got == ["A.02", "A.2_1", "A.2_9", "A.2_10", "A.10_1", "A.123456789012345678901", "B.1"]


def test_pilot_sample(spark):
    rows = [(f"A.{i}_1", "Phường" if i in (3, 9) else "Xã" if i in (1, 4, 5) else "Thị trấn") for i in range(1, 11)]
    df = spark.createDataFrame(rows, "gid_3 string, type_3 string")
    pick = lambda n: {r.gid_3 for r in ordering.pilot_sample(df, n).collect()}
    assert pick(2) == {"A.3_1", "A.1_1"}
    assert pick(3) == {"A.3_1", "A.1_1", "A.9_1"}
    assert pick(6) == {"A.3_1", "A.1_1", "A.9_1", "A.4_1", "A.5_1", "A.2_1"}


def test_trends_over_rows_and_over_months(spark):
    df = spark.createDataFrame([("g", 2024, m, v) for m, v in [(1, 0.0), (2, 0.0), (4, 6.0), (5, 3.0), (6, 9.0)]],
                               "gid_3 string, year long, month long, TNL double")
    rows = {r.month: r for r in trends.trends_rows(df).collect()}
    assert rows[1].TNL_MOM_GROWTH_PCT is None and rows[2].TNL_MOM_GROWTH_PCT is None
    assert rows[4].TNL_MOM_GROWTH_PCT == math.inf and rows[5].TNL_MOM_GROWTH_PCT == -50.0
    assert rows[4].TNL_MA3 == 2.0 and rows[1].TNL_MA3 == 0.0
    strict = {r.month: r for r in trends.trends_contiguous(df, "TNL").collect()}
    assert strict[6].ntl_ma3 == 6.0 and strict[5].ntl_ma3 is None
    assert strict[4].ntl_mom_growth_pct is None and strict[2].ntl_mom_growth_pct is None and strict[6].ntl_mom_growth_pct == pytest.approx(200.0)


def test_night_indices_zero_defaults(spark):
    cols = ["gid_3", "month", "area_ha", "n", *S.NIGHT_EXPORT_KEYS]
    df = spark.createDataFrame([("g", 1, 10.0, 2.0, 30.0, 2.0, 1.0, 0.5, 4.0, 10.0, 25.0, 4.0, 7.26), ("g", 2, 10.0, 0.0, *[1.0] * 9),
                                ("g", 3, None, 1.0, *[None] * 9)], ", ".join(f"`{c}` " + ("string" if c == "gid_3" else "long" if c == "month" else "double") for c in cols))
    got = {r.month: r for r in zonal.night_indices(df).collect()}
    assert set(got) == {1, 3}
    assert (got[1].LIT_PIXELS, got[1].LIT_AREA_HA, got[1].ELECTRIFICATION_RATIO_PCT, got[1].SPATIAL_CV, got[1].CLOUD_FREE_OBS) == (4, 100.0, 40.0, 0.5, 7.3)
    assert (got[3].TNL, got[3].ELECTRIFICATION_RATIO_PCT, got[3].COMMUNE_AREA_HA, got[3].TIME) == (0.0, 0.0, 0.0, "2024-03")
    assert zonal.missing_counts(df).count() == 1


def test_median_paths_agree(spark):
    obs = spark.range(3000).select((F.col("id") % 7).alias("row"), (F.pmod(F.xxhash64("id"), F.lit(900))).cast("int").alias("v"))
    a = {r.row: r.v for r in zonal.composite(obs, ["row"], ["v"]).collect()}
    b = {r.row: r.v for r in zonal.composite(obs.withColumn("v", F.col("v").cast("double")), ["row"], ["v"]).collect()}
    assert a == b
    even = spark.createDataFrame([(1, v) for v in (1.0, 2.0, 4.0, 10.0)] + [(2, None)], "row int, v double")
    assert {r.row: r.v for r in zonal.composite(even, ["row"], ["v"]).collect()} == {1: 3.0, 2: None}
    large = spark.createDataFrame([(1, 70000), (1, 90000), (1, -5), (None, 8)], "row int, v int")
    assert {r.row: r.v for r in zonal.composite(large, ["row"], ["v"]).collect()} == {1: 70000.0, None: 8.0}


def test_cloud_fallback_and_collection_choice(spark):
    df = spark.createDataFrame([(1, "a", "p", 90.0), (2, "a", "p", 10.0), (3, "b", "s", 95.0), (4, "b", "s", 99.0), (5, "c", "s", None)],
                               "id int, g string, collection string, cloud double")
    assert {r.id for r in scenes.cloud_filter_or_all(df, ["g"]).collect()} == {2, 3, 4, 5}
    assert {r.id for r in scenes.prefer_collection(df, ["g"], ["p", "s"]).collect()} == {1, 2, 3, 4, 5}
    both = df.union(spark.createDataFrame([(6, "b", "p", 1.0)], df.schema))
    assert {r.id for r in scenes.prefer_collection(both, ["g"], ["p", "s"]).collect()} == {1, 2, 5, 6}


def test_sensor_plan(spark):
    got = [r.sensor for r in scenes.route_sensor(spark.createDataFrame([(2004,), (2012,), (2026,)], "year int")).orderBy("year").collect()]
    assert got == ["Landsat-5", "Landsat-7(SLC-off)", "Landsat-8"]
    with pytest.raises(Exception, match="outside the sensor plan"):
        scenes.route_sensor(spark.createDataFrame([(2003,)], "year int")).collect()


def test_month_window_drops_the_last_day_by_default(spark):
    df = spark.createDataFrame([("2024-01-30",), ("2024-01-31",), ("2024-02-01",)], "d string").select(F.col("d").cast("timestamp_ntz").alias("ts"))
    assert scenes.filter_month(df, 2024, 1).count() == 1
    assert scenes.filter_month(df, 2024, 1, how="next_month").count() == 2


def test_adaptive_window_counts(spark):
    units = spark.createDataFrame([("u", 0.0, 0.0, 1.0, 1.0), ("v", 50.0, 50.0, 51.0, 51.0)], "gid_3 string, minx double, miny double, maxx double, maxy double")
    found = spark.createDataFrame([(1, "2024-01-10", 0.5, 0.5, 30.0, 30.0), (2, "2024-02-20", -9.0, -9.0, 0.0, 0.0), (3, "2024-02-20", 60.0, 60.0, 61.0, 61.0)],
                                  "scene_id int, d string, minx double, miny double, maxx double, maxy double").select("scene_id", F.col("d").cast("timestamp_ntz").alias("ts"), "minx", "miny", "maxx", "maxy")
    got = {(r.gid_3, r.month): (r.c0, r.c1, r.c2) for r in scenes.count_scenes(found, units, 2024, 4.0).collect()}
    assert len(got) == 24
    assert got[("u", 1)] == (1, 1, 2) and got[("u", 2)] == (1, 1, 2) and got[("u", 3)] == (0, 1, 1) and got[("u", 4)] == (0, 0, 0)
    assert got[("v", 2)] == (0, 0, 0)


def test_streaks_and_finished(spark):
    seq = "FFSFFFSSF"
    log = spark.createDataFrame([("r", i, c == "S") for i, c in enumerate(seq)], "run string, seq int, ok boolean")
    got = sorted((r.first_seq, r.streak, r.alarm) for r in status.failure_streaks(log, ["run"], ["seq"], F.col("ok"), 3).collect())
    assert got == [(0, 2, False), (3, 3, True), (8, 1, False)]
    rows = [("done", 0, "", True), ("failed", 3, "boom", True), ("failed", 3, "HTTP 429", False), ("failed", 2, "", False), ("not_in_asset", 0, "", True)]
    df = spark.createDataFrame(rows, "status string, attempts int, errors string, want boolean")
    assert all(r.f == r.want for r in df.withColumn("f", status.finished()).collect())


def test_reconcile_marks_missing_files(spark):
    st = spark.createDataFrame([("A.1_1", "done", 5, {"01": "ok", "02": "none"}, {"01": "ok"}), ("A.2_1", "done", 1, {"01": "ok"}, {"03": "fail"})],
                               "gid_3 string, status string, attempts long, t2 map<string,string>, t3img map<string,string>")
    files = spark.createDataFrame([("A_1_1_night_202401.tif",), ("A_2_1_day_202401.tif",)], "name string")
    got = {r.gid_3: r for r in status.reconcile_status(st, files, 2024).collect()}
    assert got["A.1_1"].status == "partial" and got["A.1_1"].attempts == 2 and got["A.1_1"].t2 == {"01": "missing", "02": "none"}
    assert got["A.1_1"].lost_months == "day 01"
    assert got["A.2_1"].status == "done" and got["A.2_1"].t3img == {"03": "fail"}


def test_compare_and_reuse(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (0, 2, None)], "row long, col long, v double")
    b = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.5), (1, 3, 9.0)], "row long, col long, v double")
    r = compare.compare_rasters(a, b, ["v"], d_row=-1, d_col=-1).first()
    assert (r.px_both, r.px_only_new, r.px_only_old, r.max_abs_diff, r.verdict) == (2, 0, 1, 0.5, S.VERDICT_VALUES)
    assert compare.compare_rasters(a, a, ["v"]).first().verdict == S.VERDICT_SAME
    assert compare.same_table(a, a.orderBy(F.desc("col"))) and not compare.same_table(a, b)
    man = spark.createDataFrame([("p", 1, "t", "h", 1), ("q", 1, "t", "h", 1)], "path string, size int, mtime string, hash string, version int")
    cache = spark.createDataFrame([("p", 1, "t", "h", 1, "done"), ("q", 2, "t", "h", 1, "done")], "path string, size int, mtime string, hash string, version int, state string")
    assert {r.path: r.state for r in compare.reuse_verdicts(man, cache).collect()} == {"p": "done", "q": None}
    assert [r.path for r in compare.to_validate(man, cache).collect()] == ["q"]


def test_listed_splits_large_groups(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, "big").otherwise("small").alias("g"), F.col("id").cast("string").alias("v"))
    got = sorted(keys.listed(df, ["g"], "v", chunk=100).collect(), key=lambda r: (r.g, r.chunk))
    assert [len(r.vs) for r in got] == [100] * 10
    assert [v for r in got if r.g == "big" for v in r.vs] == sorted(str(i) for i in range(900))


def test_scalars(spark):
    row = spark.range(1).select(
        text.slug(F.lit("Thị xã Đông Triều"), "joined").alias("a"), text.slug(F.lit(" Huyện  Ea H'leo ")).alias("b"),
        text.slug(F.lit("Phường Đức Nghĩa 2"), "camel").alias("c"), text.slug(F.lit(None).cast("string"), "camel").alias("d"),
        text.full_name(F.lit("nan"), F.lit("Ba")).alias("e"), numbers.quantise(F.lit(0.00005)).alias("q"),
        numbers.quantise(F.lit(9.0)).alias("q2"), numbers.quantise(F.lit(float("nan"))).alias("q3"),
        numbers.parse_double(F.lit("1_0")).alias("p"), numbers.parse_double(F.lit("-inf")).alias("p2"),
        spectral.normalized_difference(F.lit(-0.1), F.lit(0.5)).alias("n"), spectral.normalized_difference(F.lit(0.0), F.lit(0.0)).alias("n2")).first()
    assert (row.a, row.b, row.c, row.d, row.e) == ("thixadongtrieu", "huyen_ea_h_leo", "PhuongDucNghia2", "NA", "Ba")
    assert (row.q, row.q2, row.q3) == (0, 32767, -32768)
    assert row.p is None and row.p2 == -math.inf and row.n is None and row.n2 is None


def test_rasters_with_a_hole_in_one_band_differ(spark):
    schema = "k string, row long, col long, a double, b double"
    new = spark.createDataFrame([("p", 0, 0, 1.0, 2.0), ("q", 0, 0, 1.0, 2.0), ("r", 0, 0, None, 2.0)], schema)
    old = spark.createDataFrame([("p", 0, 0, 1.0, None), ("q", 3, 4, 1.0, 2.0), ("r", 0, 0, None, 5.0)], schema)
    offsets = spark.createDataFrame([("p", 0, 0), ("q", -3, -4), ("r", 0, 0)], "k string, d_row int, d_col int")
    got = {r.k: r for r in compare.compare_rasters(new, old, ["a", "b"], ["k"], offsets=offsets).collect()}
    assert (got["p"].null_mismatch, got["p"].verdict) == (1, S.VERDICT_VALUES)
    assert (got["q"].px_both, got["q"].verdict) == (1, S.VERDICT_SAME)
    assert (got["r"].px_both, got["r"].max_abs_diff, got["r"].verdict) == (1, 3.0, S.VERDICT_VALUES)
    with pytest.raises(Exception, match="exactly one offset"):
        compare.compare_rasters(new, old, ["a", "b"], ["k"], offsets=offsets.limit(1)).collect()


def test_medians_of_large_pixels_by_radix(spark):
    """Direct and radix medians agree with numpy: signs, zeros, infinities, NaN, NULL keys and values, one and many values."""
    rng = random.Random(9)
    special = [0.0, -0.0, math.inf, -math.inf, 5e-324, -1e308, 1.0, None, math.nan]
    rows = [(g, rng.choice(["a", None]), rng.choice(special) if g == 2 else rng.uniform(-1e3, 1e3) ** 3, rng.choice([None, 1.5, 2.5]) if g else None)
            for g, n in ((0, 1), (1, 40), (2, 300), (3, 2001), (None, 64)) for _ in range(n)]
    obs = spark.createDataFrame(rows, "g int, k string, x double, y double").repartition(5)
    groups = {}
    for g, k, x, y in rows:
        groups.setdefault((g, k), ([], []))[0].append(x)
        groups[g, k][1].append(y)

    def median(values):
        values = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
        if not values:
            return None
        low, high = values[(len(values) - 1) // 2], values[len(values) // 2]
        return low if low == high else low * 0.5 + high * 0.5
    for gathered in (10_000, 50, 0):
        got = {(r.g, r.k): (r.x, r.y) for r in zonal.composite_wide(obs, ["g", "k"], ["x", "y"], gathered).collect()}
        assert str(sorted(got.items(), key=str)) == str(sorted(((key, (median(x), median(y))) for key, (x, y) in groups.items()), key=str)).replace("-0.0", "0.0")


def test_median_of_few_values_keeps_no_count_per_value(spark):
    """Up to four values the median comes from sums; more in any band, NULLs and NULL keys go the same way as before."""
    rng = random.Random(5)
    rows = [(None if k == 7 else k, rng.randrange(2), rng.choice([None, rng.randrange(-300, 9000)]), rng.randrange(65536))
            for k in range(60) for _ in range(rng.randrange(1, 10))]
    obs = spark.createDataFrame(rows, "g int, k int, x int, y int")
    got = {(r.g, r.k): (r.x, r.y) for r in zonal.composite(obs, ["g", "k"], ["x", "y"], digital=True, few=True).collect()}
    median = lambda v: statistics.median(v) if v else None
    groups = {(g, k) for g, k, _, _ in rows}
    assert got == {p: (median([x for g, k, x, _ in rows if (g, k) == p and x is not None]), median([y for g, k, _, y in rows if (g, k) == p])) for p in groups}
    small = zonal.composite(obs.limit(3), ["g", "k"], ["x", "y"], digital=True, few=True)
    assert "percentile" not in small._jdf.queryExecution().toString() and "median" not in small._jdf.queryExecution().toString()


def test_scenes_of_one_footprint_meet_a_unit_once(spark, monkeypatch):
    found = spark.createDataFrame([(i, f"2024-0{1 + i % 3}-10 00:00:00", 0.0, 0.0, 4.0, 4.0) for i in range(60)] + [(99, "2024-05-05 00:00:00", 90.0, 90.0, 94.0, 94.0)],
                                  "scene_id long, t string, minx double, miny double, maxx double, maxy double").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    units = spark.createDataFrame([(f"g{i}", 1.0, 1.0, 2.0, 2.0) for i in range(40)] + [("far", 50.0, 50.0, 51.0, 51.0), ("none", None, None, None, None)],
                                  "gid_3 string, minx double, miny double, maxx double, maxy double")
    pairs, plain = [], scenes.scene_units
    monkeypatch.setattr(scenes, "scene_units", lambda *a: pairs.append(plain(*a)) or pairs[-1])
    got = {(r.gid_3, r.month): (r.c0, r.c1, r.c2) for r in scenes.count_scenes(found, units, 2024, 4.0).collect()}
    assert len(got) == 42 * 12 and sum(p.count() for p in pairs) == 1     # 2400 pairs of scenes and units
    assert {got[f"g{i}", 2] for i in range(40)} == {(20, 40, 60)}
    assert got["far", 5] == got["none", 2] == (0, 0, 0)
