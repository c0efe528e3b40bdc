import re

import pytest
from helpers import GIDS, admin, at, evidence, images, records, sources
from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.operators import contract as C
from unitgrid.operators import keys
from unitgrid.sources import readers, writers


@pytest.fixture(scope="module")
def adm(spark):
    return admin(spark).cache()


def progress(spark, adm, day=None, night=None, imgs=None, src=None, previous=None):
    return C.progress(adm, records(spark, "day") if day is None else day, records(spark, "night") if night is None else night,
                      images(spark) if imgs is None else imgs, sources(spark) if src is None else src, previous)


def test_legacy_columns_names_and_natural_order(spark, adm):
    old = records(spark).withColumn("NAME_3", F.lit("wrong")).orderBy(F.desc("MONTH"))
    rows = C.natural_sorted(C.normalize(old, adm, "day")).collect()
    assert list(rows[0].asDict()) == S.COLUMNS["day"]
    assert [r.gid_3 for r in rows] == [GIDS[0]] * 12 + [GIDS[1]] * 12
    assert [r.month for r in rows[:12]] == list(range(1, 13))
    assert rows[0].name_3 == "Xã " + GIDS[0]
    assert all(r.BLUE_mean == r.month for r in rows)


def test_missing_month_is_blank_and_blocks_the_night_phase(spark, adm):
    frame = C.normalize(records(spark).filter("MONTH <> 5"), adm, "day")
    assert frame.count() == 24
    assert all(v is None for v in frame.filter("month = 5").select(*S.DAY_METRICS).first())
    table = progress(spark, adm)
    C.require_complete(table)
    blocked = table.withColumn("day_indices", F.when(F.col("month") == 5, "pending").otherwise(F.col("day_indices")))
    with pytest.raises(C.ContractError, match="night phase blocked"):
        C.require_complete(blocked)


def test_no_source_needs_evidence(spark, adm):
    empty = spark.createDataFrame([], S.index_schema("day"))
    full = C.normalize(empty, adm, "day")
    assert {r.state for r in C.metric_states(full, "day", sources(spark)).collect()} == {"pending"}
    zero = evidence(spark, "day_indices")
    assert {r.state for r in C.metric_states(full, "day", zero).collect()} == {"no_source"}
    table = progress(spark, adm, day=empty, src=zero)
    assert {r.day_indices for r in table.collect()} == {"no_source"}
    C.require_complete(table)


def test_zero_source_with_metrics_fails(spark, adm):
    full = C.normalize(records(spark), adm, "day")
    states = C.metric_states(full, "day", evidence(spark, "day_indices", months=[4])).collect()
    assert {(r.state, r.error) for r in states if r.month == 4} == {("failed", S.MSG_ZERO_SOURCE)}
    assert {r.state for r in states if r.month != 4} == {"done"}


def test_duplicates_domain_and_unknown_ids(spark, adm):
    rows = records(spark)
    assert C.normalize(rows.union(rows), adm, "day").count() == 24
    conflict = rows.filter("MONTH = 1").withColumn("BLUE_mean", F.lit(100.0))
    with pytest.raises(Exception, match="conflict at"):
        C.normalize(rows.union(conflict), adm, "day").collect()
    hole = rows.filter("MONTH = 1").withColumn("BSI_mean", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="conflict at"):
        C.normalize(rows.union(hole), adm, "day").collect()
    for column, value in (("YEAR", 2023), ("MONTH", 13), ("GID_3", "unknown")):
        wrong = rows.withColumn(column, F.when(F.col("MONTH") == 1, value).otherwise(F.col(column)))
        for complete in (True, False):
            with pytest.raises(Exception, match="unknown gid" if column == "GID_3" else "domain at"):
                C.normalize(wrong, adm, "day", complete=complete).collect()
        assert C.normalize_violations(wrong, adm, "day").count() > 0
    assert C.normalize_violations(rows, adm, "day").count() == 0


def test_text_metrics_must_be_numbers(spark, adm):
    rows = records(spark).withColumn("BLUE_mean", F.when(F.col("MONTH") == 2, "x1").when(F.col("MONTH") == 3, "NaN")
                                     .otherwise("1e2"))
    with pytest.raises(Exception, match="number at"):
        C.normalize(rows, adm, "day").collect()
    good = C.normalize(rows.filter("MONTH <> 2"), adm, "day")
    assert at(good, GIDS[0], 3).BLUE_mean is None and at(good, GIDS[0], 4).BLUE_mean == 100.0


def test_merge_repairs_only_missing_rows(spark, adm):
    old = records(spark).filter("NOT (GID_3 = 'VNM.1.2_1' AND MONTH = 1)")
    new = records(spark).withColumns({m: F.col(m) * 100 for m in S.DAY_METRICS})
    merged = C.merge_valid(old, new, adm, "day", sources(spark))
    assert at(merged, GIDS[0], 1).BLUE_mean == 100 and at(merged, GIDS[0], 2).BLUE_mean == 2


def test_merge_into_empty_night_table(spark, adm):
    merged = C.merge_valid(spark.createDataFrame([], S.index_schema("night")), records(spark, "night"), adm, "night",
                           sources(spark))
    assert merged.count() == 24 and at(merged, GIDS[0], 1).TIME == "2024-01"


def test_first_month_growth_may_be_missing(spark, adm):
    full = C.normalize(records(spark, "night"), adm, "night")
    assert full.columns == S.COLUMNS["night"]
    assert {r.state for r in C.metric_states(full, "night", sources(spark)).collect()} == {"done"}
    wild = full.withColumn(S.GROWTH, F.lit(float("inf"))).withColumn("TNL", F.when(F.col("month") != 2, F.col("TNL"))
                                                                     .otherwise(float("inf")))
    states = {r.month: r.state for r in C.metric_states(wild, "night", sources(spark)).collect()}
    assert states[2] == "failed" and states[3] == "done"


def test_admin_contract(spark, adm):
    with pytest.raises(C.ContractError, match="2 of 11163"):
        C.check_admin(adm)
    with pytest.raises(C.ContractError, match="duplicate"):
        C.check_admin(adm.union(adm), expected=None)
    full = spark.range(1, 11164).select(F.concat(F.lit("VNM.1."), F.col("id").cast("string"), F.lit("_1")).alias("GID_3"),
                                        *[F.lit("x").alias(c) for c in S.ADMIN_COLUMNS if c != "gid_3"])
    assert C.check_admin(full).count() == 11163
    with pytest.raises(C.ContractError, match="11136 of 11163"):
        C.check_admin(full.filter("GID_3 NOT IN (" + ",".join(f"'VNM.1.{i}_1'" for i in range(1, 28)) + ")"))
    with pytest.raises(C.ContractError, match="blank"):
        C.check_admin(full.withColumn("name_3", F.when(F.col("GID_3") == "VNM.1.7_1", "").otherwise(F.col("name_3"))))


@pytest.mark.parametrize("state", ["pending", "running", "failed"])
def test_gate_rejects_open_states(spark, adm, state):
    table = progress(spark, adm).withColumn("day_image", F.when(F.col("month") == 1, state).otherwise(F.col("day_image")))
    with pytest.raises(C.ContractError):
        C.require_complete(table)


def test_gate_rejects_missing_and_duplicate_rows(spark, adm):
    table = progress(spark, adm).cache()
    for wrong in (table.filter("month > 1"), table.union(table.filter("month = 1")), table.limit(0)):
        with pytest.raises(C.ContractError):
            C.require_complete(wrong)


def test_interrupted_work_is_retried_but_done_is_rechecked(spark, adm):
    previous = progress(spark, adm).withColumn("day_image", F.when(F.col("month") == 1, "running").otherwise(F.col("day_image")))
    no_images = images(spark).limit(0)
    resumed = progress(spark, adm, imgs=no_images, previous=previous)
    assert at(resumed, GIDS[0], 1).day_image == "failed" and at(resumed, GIDS[0], 2).day_image == "pending"
    assert at(resumed, GIDS[0], 1).day_image_error == S.MSG_INTERRUPTED
    found = progress(spark, adm, imgs=images(spark, GIDS[:1], [1], ["day"]), previous=previous)
    assert at(found, GIDS[0], 1).day_image == "done"


def test_zero_evidence_keeps_a_blank_row_and_passes_the_gate(spark, adm):
    zero = evidence(spark, "day_indices", months=[12]).union(evidence(spark, "day_image", months=[12]))
    table = progress(spark, adm, day=records(spark).filter("MONTH < 12"), imgs=images(spark, months=range(1, 12)), src=zero)
    last = at(table, GIDS[1], 12)
    assert (last.day_indices, last.day_image) == ("no_source", "no_source")
    C.require_complete(table)


def test_updates_never_downgrade(spark, adm):
    table = progress(spark, adm, imgs=images(spark, GIDS[:1], [1], ["day"]))
    updates = spark.createDataFrame([(g, None, "day_image", "failed", "boom") for g in GIDS],
                                    "gid_3 string, month long, field string, state string, error string")
    out = C.apply_updates(table, updates)
    assert at(out, GIDS[0], 1).day_image == "done"
    assert at(out, GIDS[0], 2).day_image == "failed" and at(out, GIDS[1], 1).day_image_error == "boom"


def test_image_metadata(spark):
    s = 20 / 111319.49079327357
    n = 500 / 111319.49079327357
    rows = [("day", 10, 4326, s, -s, 0.0, 0.0, "float64", "done"), ("day", 6, 4326, s, -s, 0.0, 0.0, "float64", "failed"),
            ("day", 10, 4326, n, -n, 0.0, 0.0, "float64", "failed"), ("day", 10, 3857, s, -s, 0.0, 0.0, "float64", "failed"),
            ("day", 10, 4326, s, -s, 0.1, 0.0, "float32", "failed"), ("day", 10, 4326, s, -s, 0.0, 0.0, "float32", "done"),
            ("night", 2, 4326, n, -n, 0.0, 0.0, "float32", "failed"), ("night", 2, 4326, n, -n, 0.0, 0.0, "float64", "done"),
            ("day", 10, None, s, -s, 0.0, 0.0, "float64", "failed"), ("day", 10, 4326, s, -s, 0.0, 0.0, "int16", "failed")]
    df = spark.createDataFrame(rows, "kind string, bands int, epsg int, step_x double, step_y double, rot_x double, "
                                     "rot_y double, dtype string, want string")
    assert all(r.state == r.want for r in C.check_images(df).collect())


def test_verify_units_reports_absent_units(spark, adm):
    full = C.normalize(records(spark), adm, "day").filter(F.col("gid_3") == GIDS[0])
    got = {r.gid_3: r.level for r in C.verify_units(full, "day", sources(spark), adm).collect()}
    assert got == {GIDS[0]: "PASS", GIDS[1]: "FAIL"}


def test_aliases(spark):
    df = spark.createDataFrame([("a", None, 1), (None, "b", 2), ("c", "c", 3)], "x string, y string, BLUE_mean int").toDF("GID_3", "gid_3", "BLUE_mean")
    assert [r.gid_3 for r in C.unify_aliases(df).orderBy("BLUE_mean").collect()] == ["a", "b", "c"]
    assert C.alias_conflicts(df).count() == 0
    bad = spark.createDataFrame([("a", "b")], "x string, y string").toDF("GID_3", "gid_3")
    assert C.alias_conflicts(bad).count() == 1


def test_plan_round_trip_and_rules(spark):
    plan = spark.createDataFrame([("g1", m, m % 3, 1, 2) for m in range(1, 13)], "gid_3 string, month long, c0 long, c1 long, c2 long")
    texts = writers.plan_texts(plan)
    assert readers.plan_violations(texts).count() == 0
    assert sorted(map(tuple, readers.read_plan(texts).collect())) == sorted(map(tuple, plan.collect()))
    zero = readers.plan_evidence(readers.read_plan(texts)).filter("month = 3").first()
    assert zero["count"] == 1.0
    for broken in ("[[1,2,3]]", "[" + ",".join(["[1,2]"] * 12) + "]", "[" + ",".join(["[1,-2,3]"] * 12) + "]",
                   "[" + ",".join(["[1,2.5,3]"] * 12) + "]"):
        text = spark.createDataFrame([('{"g":' + broken + "}",)], "plan string")
        assert readers.plan_violations(text).count() == 1


def test_publish_keeps_the_old_version_until_verified(spark, adm, tmp_path):
    table = str(tmp_path / "t")
    assert writers.current_version(spark, table) is None
    assert writers.read_published(spark, table, adm.schema).count() == 0
    writers.publish(adm, table, "r1")
    with pytest.raises(Exception):
        writers.publish(adm, table, "r1")
    assert writers.current_version(spark, table) == "r1"
    writers.publish(adm.limit(1), table, "r2")
    assert writers.read_published(spark, table, adm.schema).count() == 1


def test_reading_blank_admin_fields_and_absent_tables(spark, tmp_path):
    path = tmp_path / "admin.csv"
    path.write_text("GID_3,NAME_3,TYPE_3,GID_2,NAME_2,GID_1,NAME_1\nA.1_1,,NA,x,x,x,x\n", encoding="utf-8")
    row = readers.read_admin(spark, str(path)).first()
    assert row.name_3 == "" and row.type_3 == "NA"
    assert readers.read_index(spark, str(tmp_path / "none.csv"), "night").columns == S.COLUMNS["night"]


def test_resolve_ids(spark):
    known = spark.createDataFrame([("A.1.2_1",), ("A.1.3_4",), ("A.1.3_2",)], "gid_3 string")
    wanted = spark.createDataFrame([("A.1.2_1",), ("A.1.2",), ("A.1.2_7",), ("A.1.3",), ("B",)], "gid_3 string")
    got = {r.wanted: (r.resolved, r.rank) for r in keys.resolve_ids(wanted, known).collect()}
    assert got == {"A.1.2_1": ("A.1.2_1", 1), "A.1.2": ("A.1.2_1", 3), "A.1.2_7": ("A.1.2_1", 3), "A.1.3": ("A.1.3_2", 4),
                   "B": (None, None)}


def test_states_join_no_metrics_and_evidence_is_spread(spark, sf_dir, tmp_path):
    """Units of one file are spread before their months are made; the states' joins carry no metric."""
    import os

    from unitgrid.operators import keys
    from unitgrid.plans import catalog
    from unitgrid.plans.views import Views
    for t in os.listdir(sf_dir):
        if t != "customer.parquet":
            os.symlink(f"{sf_dir}/{t}", tmp_path / t)
    one = spark.read.parquet(f"{sf_dir}/customer.parquet").crossJoin(spark.range(200).toDF("k"))
    one.withColumn("c_custkey", F.col("c_custkey") + F.col("k") * 1000).drop("k").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    v = Views(spark, str(tmp_path))
    sizes = [r["n"] for r in v.evidence.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 48 * v.admin.count() and max(sizes) < 48 * 2 * keys.SPREAD_ROWS and len(sizes) >= 3
    states = catalog.QUERIES["k3_day_states"](spark, str(tmp_path))
    text = states._jdf.queryExecution().optimizedPlan().toString()
    top = text.split("Join LeftOuter")[0]
    assert "Join LeftOuter" in text and "BLUE_mean" not in top


def many_units(spark, sf_dir, folder):
    """The tables of `sf_dir` with 200 times its units, in one file."""
    import os

    for t in os.listdir(sf_dir):
        if t != "customer.parquet":
            os.symlink(f"{sf_dir}/{t}", folder / t)
    one = spark.read.parquet(f"{sf_dir}/customer.parquet").crossJoin(spark.range(200).toDF("k"))
    one.withColumn("c_custkey", F.col("c_custkey") + F.col("k") * 1000).drop("k").coalesce(1).write.parquet(str(folder / "customer.parquet"))
    return str(folder)


def test_sources_of_one_file_of_units_are_written_by_several_tasks(spark, sf_dir, tmp_path):
    from unitgrid.plans import catalog
    folder = many_units(spark, sf_dir, tmp_path)
    out = catalog.QUERIES["a8_read_sources"](spark, folder)
    lines = spark.read.text(out.inputFiles()).filter("value NOT LIKE 'gid_3,%'").groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()
    units = spark.read.parquet(folder + "/customer.parquet").count()
    assert sum(r["n"] for r in lines) == 52 * units and max(r["n"] for r in lines) < 48 * 20_000
    assert out.count() == 48 * units


def test_night_states_hold_no_metric_and_evidence_of_many_tasks(spark, sf_dir, tmp_path):
    """Where states meet their evidence, rows carry three facts; the evidence of one file of units comes from several tasks."""
    from unitgrid.plans import catalog
    states = catalog.QUERIES["k3_night_states"](spark, many_units(spark, sf_dir, tmp_path))
    text = states._jdf.queryExecution().optimizedPlan().toString()
    top, evidence = text.split("Join LeftOuter", 1)
    assert "TNL" not in top and "_zero_night_indices" in evidence
    assert evidence.rindex("Generate inline") < evidence.rindex("Generate explode") < evidence.rindex("RepartitionByExpression")


def test_long_month_tables_are_not_merged_into_few_tasks(spark, monkeypatch, adm):
    """Joins of units by month keep tasks of a bounded number of rows, though keys and flags shrink to few bytes."""
    kept = keys.placed.__defaults__
    monkeypatch.setattr(keys.placed, "__defaults__", (2,))
    full = C.normalize(records(spark), adm, "day")
    assert "REPARTITION_BY_NUM" in full._jdf.queryExecution().executedPlan().toString()
    notes = C.verify_notes(full, "day", sources(spark), adm, images(spark))
    assert "REPARTITION_BY_NUM" in notes._jdf.queryExecution().executedPlan().toString()
    placed = sorted(map(tuple, notes.collect()), key=str)
    monkeypatch.setattr(keys.placed, "__defaults__", kept)
    assert placed == sorted(map(tuple, C.verify_notes(full, "day", sources(spark), adm, images(spark)).collect()), key=str)


@pytest.mark.parametrize("complete", [True, False])
def test_units_are_placed_before_their_keys_are_checked(spark, monkeypatch, complete):
    """Units of a large table are sorted in tasks of a bounded number of rows, not in one task of their file or of few bytes."""
    gids = [f"VNM.1.{i}_1" for i in range(1, 21)]
    units, table = admin(spark, gids), records(spark, gids=gids)
    plain = sorted(map(tuple, C.normalize(table, units, "day", complete=complete).collect()), key=str)
    monkeypatch.setattr(keys.placed, "__defaults__", (2,))
    full = C.normalize(table, units, "day", complete=complete)
    assert re.search(r"RepartitionByExpression \[gid_3#\d+\], 10", full._jdf.queryExecution().optimizedPlan().toString())
    assert sorted(map(tuple, full.collect()), key=str) == plain and len(plain) == 240
    with pytest.raises(Exception, match="administrative table: repeated key VNM.1.7_1"):
        C.normalize(table, units.union(units.filter("gid_3 = 'VNM.1.7_1'")), "day", complete=complete).collect()


def test_index_table_is_sorted_in_ranges_of_bounded_rows(spark, adm, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "SORT_ROWS", 5)
    full = C.normalize(records(spark), adm, "day")
    version = writers.write_index(full, str(tmp_path / "t"), "day", "r1")
    parts = [p.read_text(encoding="utf-8").splitlines()[1:] for p in sorted((tmp_path / "t" / version.split("/")[-1]).glob("part-*"))]
    lines = [line.split(",")[0] + "/" + line.split(",")[8] for part in parts for line in part]
    assert len(parts) > 1 and lines == [f"{g}/{m}" for g in GIDS[:2] for m in range(1, 13)]


def test_newest_evidence_takes_one_pass(spark):
    from unitgrid.plans import exports
    row = lambda month, count: ("g", 2024, month, "day_indices", count)
    old = spark.createDataFrame([row(1, 5.0), row(2, 1.0), row(2, 4.0), row(3, None), row(4, 9.0)], S.SOURCES_SCHEMA)
    found = spark.createDataFrame([row(1, 0.0), row(4, 2.0), row(4, 3.0)], S.SOURCES_SCHEMA)
    out = exports.newest_evidence(old, found)
    assert sorted(((r.month, r["count"]) for r in out.collect()), key=str) == [(1, 0.0), (2, 1.0), (2, 4.0), (3, None), (4, 2.0), (4, 3.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "max_by" not in plan and "SortAggregate" not in plan
