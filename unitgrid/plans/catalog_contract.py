"""Queries over tables, keys, contracts and states."""

from functools import reduce

from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.functions import grid, text
from unitgrid.operators import compare, contract, keys, ordering, scenes, status, trends, zonal
from unitgrid.plans.exports import day_from_export, evidence_from_exports, night_merged
from unitgrid.plans.night import night_from_export, night_index_table
from unitgrid.plans.registry import query, rounded
from unitgrid.plans.sqlviews import YEAR, completed, flagged, state_sql
from unitgrid.session import scratch_path
from unitgrid.sources import readers, writers

_NAT = """list_transform(regexp_extract_all({0}, '(\\d+|\\D+)'),
          lambda x: CASE WHEN regexp_matches(x, '^\\d') THEN lpad(x, 20, '0') ELSE x END)"""
_PFX = "gid_3, name_3, type_3, gid_2, name_2, gid_1, name_1, year, month"
_DAY = ", ".join(S.DAY_METRICS)
_NIGHT = ", ".join(f'"{m}"' for m in S.NIGHT_METRICS)


# --- sources -----------------------------------------------------------------------------------------

@query("a1_read_admin", "SELECT * FROM v_admin", ["v_admin"])
def _(v):
    path = scratch_path(v.spark, "admin-csv")
    v.admin.toDF(*[c.upper() for c in S.ADMIN_COLUMNS]).write.csv(path, header=True)
    return readers.read_admin(v.spark, path).select(*S.ADMIN_COLUMNS)


@query("a2_read_index", f"SELECT gid_3, year, month, {_DAY} FROM v_day", ["v_day"])
def _(v):
    path = scratch_path(v.spark, "index-csv")
    v.day.write.csv(path, header=True)
    table = contract.strict_double(readers.read_index(v.spark, path, "day"), S.DAY_METRICS)
    absent = readers.read_index(v.spark, path + "-absent", "day").select(*table.columns)
    out = table.unionByName(absent.select(*[F.col(c).cast(t).alias(c) for c, t in table.dtypes]))
    return out.withColumns({c: F.col(c).cast("long") for c in ("year", "month")})


@query("a3_read_exports", "SELECT gid_3, month, val, 1 AS files FROM v_month", ["v_month"])
def _(v):
    path = scratch_path(v.spark, "exports")
    v.month.select("gid_3", "month", "val").write.csv(path, header=True)
    rows = readers.read_exports(v.spark, path, "part-", ["gid_3", "month", "val"])
    named = F.col("file_name").like("part-%.csv")
    return rows.groupBy("gid_3", F.col("month").cast("long").alias("month"), F.col("val").cast("double").alias("val")).agg(
        F.count_distinct(F.when(named, F.col("file_name"))).alias("files"))


@query("a4_read_log", """SELECT gid_3, run_id, seq, status, attempts, errors FROM v_status""", ["v_status"])
def _(v):
    path = scratch_path(v.spark, "log")
    good = v.status.select(F.to_json(F.struct(
        "gid_3", "run_id", "seq", "status", "attempts", F.array("errors").alias("errors"))).alias("value"))
    cut = good.select(F.substring("value", 1, 20).alias("value"))
    good.union(cut).write.text(path)
    return readers.read_log(v.spark, path).select("gid_3", "run_id", "seq", "status", "attempts",
                                                  F.col("errors")[0].alias("errors"))


@query("a5_read_plan", "SELECT gid_3, month, c0, c1, c2 FROM v_plan", ["v_plan"])
def _(v):
    return readers.read_plan(writers.plan_texts(v.plan))


@query("a5_plan_evidence", f"""SELECT gid_3, CAST({YEAR} AS BIGINT) AS year, month, 'day_image' AS field,
    CAST(CASE WHEN c0 > 0 THEN c0 WHEN c1 > 0 THEN c1 WHEN c2 > 0 THEN c2 ELSE 0 END AS DOUBLE) AS "count" FROM v_plan""",
       ["v_plan"])
def _(v):
    return readers.plan_evidence(v.plan, YEAR)


@query("a7_rows_per_file", """SELECT 'orders.parquet' AS name, count(*) AS n, TRUE AS sized FROM orders
    UNION ALL SELECT 'lineitem.parquet', count(*), TRUE FROM lineitem UNION ALL SELECT 'events.parquet', count(*), TRUE FROM events""")
def _(v):
    files = readers.read_manifest(v.spark, v.dir, "*.parquet").withColumn("path", F.regexp_replace("path", "^[a-z]+:/+", "/"))
    rows = [v.spark.read.parquet(f"{v.dir}/{t}.parquet").select(F.regexp_replace(F.col("_metadata.file_path"), "^[a-z]+:/+", "/").alias("path"))
            for t in ("orders", "lineitem", "events")]
    counted = reduce(lambda a, b: a.unionByName(b), rows).groupBy("path").agg(F.count("*").alias("n"))
    return counted.join(files, "path").groupBy(F.regexp_extract("path", r"([^/]+\.parquet)", 1).alias("name")).agg(
        F.sum("n").alias("n"), F.bool_and(F.col("size") > 0).alias("sized"))


@query("a7_read_manifest")
def _(v):
    return readers.read_manifest(v.spark, v.dir, "*.parquet").select(
        F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "size", (F.col("mtime").isNotNull()).alias("dated"))


@query("a8_read_sources", 'SELECT gid_3, year, month, field, "count" FROM v_evidence', ["v_evidence"])
def _(v):
    path = scratch_path(v.spark, "sources")
    v.evidence.union(v.evidence.filter("month = 3")).write.csv(path, header=True)
    return readers.read_sources(v.spark, path)


@query("a8_source_rules", """SELECT 'source' AS "check", gid_3 || '/' || month || '/' || field AS detail FROM (
    SELECT *, CASE WHEN month = 5 AND field = 'day_image' THEN -1.0 ELSE "count" END AS c FROM v_evidence) WHERE c < 0""",
       ["v_evidence"])
def _(v):
    broken = v.evidence.withColumn("count", F.when((F.col("month") == 5) & (F.col("field") == "day_image"), -1.0)
                                   .otherwise(F.col("count")))
    return contract.read_source_rules(broken, YEAR)


# --- sinks ---------------------------------------------------------------------------------------------

@query("b1_write_index", f"SELECT {_PFX}, {_DAY} FROM ({completed('v_day')}) JOIN v_admin USING (gid_3)",
       ["v_grid", "v_day", "v_admin"])
def _(v):
    path = scratch_path(v.spark, "index-table")
    writers.write_index(v.day_full, path, "day", "r1")
    return writers.read_published(v.spark, path, S.index_schema("day"), "csv", header="true")


@query("b2_write_by_unit", "SELECT gid_1, count(*) AS units, count(DISTINCT gid_3) AS gids FROM v_admin GROUP BY gid_1",
       ["v_admin"])
def _(v):
    path = scratch_path(v.spark, "by-unit")
    writers.write_by_unit(v.admin, path, ("gid_1",))
    return v.spark.read.parquet(path).groupBy("gid_1").agg(F.count("*").alias("units"),
                                                           F.count_distinct("gid_3").alias("gids"))


@query("b3_append_log", "SELECT status, 2 * count(*) AS n FROM v_status GROUP BY status", ["v_status"])
def _(v):
    path = scratch_path(v.spark, "append")
    lines = v.status.select("gid_3", "run_id", "seq", "status", "attempts")
    writers.append_log(lines, path)
    writers.append_log(lines, path)
    return readers.read_log(v.spark, path).groupBy("status").agg(F.count("*").alias("n"))


@query("b4_publish", "SELECT gid_3, month, val FROM v_month WHERE month > 6", ["v_month"])
def _(v):
    path = scratch_path(v.spark, "published")
    table = v.month.select("gid_3", "month", "val")
    writers.publish(table, path, "r1")
    writers.publish(table.filter("month > 6"), path, "r2")
    return writers.read_published(v.spark, path, table.schema)


@query("b5_build_combined", """SELECT DISTINCT ON (gid_3, month) gid_3, month, val, src, s AS run_seq FROM (
    SELECT gid_3, month, val, 'first' AS src, 1 AS s FROM v_month UNION ALL
    SELECT gid_3, month, val * 2, NULL, 2 FROM v_month WHERE month % 2 = 0) ORDER BY gid_3, month, s DESC""", ["v_month"])
def _(v):
    first = v.month.select("gid_3", "month", "val", F.lit("first").alias("src"), F.lit(1).alias("run_seq"))
    second = v.month.filter("month % 2 = 0").select("gid_3", "month", (F.col("val") * 2).alias("val"),
                                                    F.lit(2).alias("run_seq"))
    return writers.combined([first, second]).select("gid_3", "month", "val", "src", "run_seq")


@query("b6_write_plan", """SELECT gid_3, '{"' || gid_3 || '":[' || string_agg('[' || c0 || ',' || c1 || ',' || c2 || ']', ','
    ORDER BY month) || ']}' AS plan FROM v_plan GROUP BY gid_3""", ["v_plan"])
def _(v):
    return writers.plan_texts(v.plan)


@query("b7_write_report", """SELECT type_3 AS item, CASE WHEN count(*) % 2 = 0 THEN 'PASS' ELSE 'WARN' END AS level,
    CAST(count(*) AS VARCHAR) AS note FROM v_admin GROUP BY type_3""", ["v_admin"])
def _(v):
    path = scratch_path(v.spark, "report")
    n = F.count("*")
    writers.write_report(v.admin.groupBy(F.col("type_3").alias("item")).agg(
        F.when(n % 2 == 0, "PASS").otherwise("WARN").alias("level"), n.cast("string").alias("note")), path)
    return v.spark.read.json(path, schema="item string, level string, note string")


# --- filters and columns ---------------------------------------------------------------------------------

@query("c1_unify_aliases", """SELECT gid_3, year, month, val FROM v_month""",
       ["v_month"])
def _(v):
    legacy = v.month.select(F.when(F.col("month") % 3 != 0, F.col("gid_3")).alias("a"),
                            F.when(F.col("month") % 3 == 0, F.col("gid_3")).alias("b"), "year", "month", "val")
    return contract.unify_aliases(legacy.toDF("GID_3", "gid_3", "YEAR", "MONTH", "val"))


@query("c1_alias_conflicts", """SELECT 'alias' AS "check", 'gid_3' AS detail FROM v_month WHERE month % 4 = 0""", ["v_month"])
def _(v):
    legacy = v.month.select(F.col("gid_3").alias("a"), F.when(F.col("month") % 4 == 0, "other")
                            .otherwise(F.col("gid_3")).alias("b"), "val")
    return contract.alias_conflicts(legacy.toDF("GID_3", "gid_3", "val"))


_TEXTS = """CASE seq % 5 WHEN 0 THEN ' 1.5e3 ' WHEN 1 THEN 'NaN' WHEN 2 THEN 'bad' || seq WHEN 3 THEN NULL
    ELSE CAST(seq AS VARCHAR) || '.25' END"""
_NUMBERS = "CASE seq % 5 WHEN 0 THEN 1500.0 WHEN 4 THEN seq + 0.25 END"


@query("c2_strict_double", f"SELECT seq, {_NUMBERS} AS x FROM v_status", ["v_status"])
def _(v):
    return contract.strict_double(v.status.select("seq", F.expr(_TEXTS.replace("VARCHAR", "STRING")).alias("x")), ["x"])


@query("c2_bad_numbers", "SELECT 'number' AS \"check\", 'x' AS detail FROM v_status WHERE seq % 5 = 2", ["v_status"])
def _(v):
    return contract.bad_numbers(v.status.select(F.expr(_TEXTS.replace("VARCHAR", "STRING")).alias("x")), ["x"])


@query("c3_conform", f"""SELECT gid_3, NULL::VARCHAR AS name_3, NULL::VARCHAR AS type_3, NULL::VARCHAR AS gid_2,
    NULL::VARCHAR AS name_2, NULL::VARCHAR AS gid_1, NULL::VARCHAR AS name_1, year, month,
    {', '.join(m if i < 4 else f'NULL::DOUBLE AS {m}' for i, m in enumerate(S.DAY_METRICS))} FROM v_day""", ["v_day"])
def _(v):
    return contract.conform(v.day.select("gid_3", "year", "month", *S.DAY_METRICS[:4], F.lit(1).alias("extra")), "day")


@query("c4_check_domain", f"""SELECT 'domain' AS "check", gid_3 || '/' || y || '/' || m AS detail FROM (
    SELECT gid_3, month + CASE WHEN n > 1 THEN 6 ELSE 0 END AS m, year - CASE WHEN n > 2 THEN 1 ELSE 0 END AS y FROM v_month)
    WHERE y <> {YEAR} OR m > 12""", ["v_month"])
def _(v):
    shifted = v.month.select("gid_3", (F.col("month") + F.when(F.col("n") > 1, 6).otherwise(0)).alias("month"),
                             (F.col("year") - F.when(F.col("n") > 2, 1).otherwise(0)).alias("year"))
    return contract.domain_violations(shifted, YEAR)


@query("c5_parse_image_names", "SELECT o_orderkey, gid_3, kind, month, path FROM v_named", ["v_named"])
def _(v):
    return v.named.select("o_orderkey", "gid_3", "kind", "month", "path")


_TILES = """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'day_img_199601_w0.tif' WHEN o_orderkey % 5 = 1 THEN 'night_img_199601.tif'
    ELSE 'day_img_199601_w0-' || lpad(CAST(o_orderkey % 7 * 4096 AS {t}), 10, '0') || '-' ||
         lpad(CAST(o_orderkey % 11 * 4096 AS {t}), 10, '0') || '.tif' END AS path FROM orders"""


@query("c6_parse_tile_names", f"""SELECT o_orderkey, path, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey % 7 * 4096 END AS tile_row,
    CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey % 11 * 4096 END AS tile_col
    FROM ({_TILES.format(t='VARCHAR')}) WHERE o_orderkey % 5 <> 1""")
def _(v):
    v.table("orders").createOrReplaceTempView("unitgrid_orders")
    tiles = v.spark.sql(_TILES.format(t="STRING").replace("FROM orders", "FROM unitgrid_orders"))
    return readers.parse_tile_names(tiles, "day_img_199601_w0")


@query("c15_needed", """SELECT DISTINCT gid_3 FROM v_images WHERE state = 'failed' AND month = 7
    AND gid_3 IN (SELECT gid_3 FROM v_admin WHERE type_3 = 'Xã')""", ["v_images", "v_admin"])
def _(v):
    work = v.images.withColumnRenamed("state", "day_image")
    return keys.needed(work, "day_image", v.admin.filter("type_3 = 'Xã'"), 7)


@query("c16_in_provinces", "SELECT gid_3, gid_1 FROM v_admin WHERE gid_1 IN ('C.1_1', 'C.3_1')", ["v_admin"])
def _(v):
    return keys.in_provinces(v.admin, ["C.1_1", "C.3_1"]).select("gid_3", "gid_1")


# --- joins -------------------------------------------------------------------------------------------------

@query("d1_complete_grid", completed("v_month"), ["v_grid", "v_month"])
def _(v):
    return keys.complete_grid(v.month, v.admin, YEAR)


@query("d2_enrich_admin", "SELECT a.*, m.year, m.month, m.val FROM v_month m LEFT JOIN v_admin a USING (gid_3)",
       ["v_month", "v_admin"])
def _(v):
    named = v.month.select("gid_3", "year", "month", "val", F.lit("wrong").alias("name_3"))
    return keys.enrich_admin(named, v.admin)


@query("d3_unknown_keys", "SELECT DISTINCT gid_3 FROM v_month WHERE gid_3 NOT IN (SELECT gid_3 FROM v_admin WHERE type_3 = 'Xã')",
       ["v_month", "v_admin"])
def _(v):
    return keys.unknown_keys(v.month, v.admin.filter("type_3 = 'Xã'"))


@query("d4_reconcile_keys", """SELECT count(*) FILTER (WHERE r.n IS NULL) AS missing, count(*) FILTER (WHERE l.gid_3 IS NULL) AS extra,
    CAST(sum(r.n - 1) AS BIGINT) AS duplicated FROM (SELECT gid_3 FROM v_admin WHERE type_3 <> 'nan') l
    FULL JOIN (SELECT gid_3, count(*) AS n FROM v_month GROUP BY gid_3) r ON l.gid_3 = r.gid_3""", ["v_admin", "v_month"])
def _(v):
    return keys.reconcile_keys(v.admin.filter("type_3 <> 'nan'"), v.month, ["gid_3"])


def _old_new(v):
    """A prior table with holes and an incoming one with other values."""
    old = v.night.filter("month % 3 <> 0")
    new = v.night.filter("month <> 5").withColumn("TNL", F.col("TNL") * 10)
    return old, new


@query("d5_merge_valid", f"""
    old AS (SELECT * FROM v_night WHERE month % 3 <> 0),
    new AS (SELECT * REPLACE ("TNL" * 10 AS "TNL") FROM v_night WHERE month <> 5),
    prior AS ({flagged('old', 'night_indices')}),
    st AS ({state_sql('night', 'SELECT * FROM prior', 'z0')})
    SELECT {_PFX}, {', '.join(f'CASE WHEN keep THEN o."{m}" ELSE n."{m}" END AS "{m}"' for m in S.NIGHT_METRICS)}
    FROM (SELECT p.*, s.state IN ('done', 'no_source') OR n0.gid_3 IS NULL AS keep FROM prior p JOIN st s USING (gid_3, year, month)
          LEFT JOIN new n0 USING (gid_3, year, month)) o
    LEFT JOIN new n USING (gid_3, year, month) JOIN v_admin USING (gid_3)""", ["v_night", "v_admin", "v_evidence"])
def _(v):
    old, new = _old_new(v)
    return contract.merge_valid(old, new, v.admin, "night", v.evidence, YEAR)


@query("d6_evidence_lookup", """SELECT m.gid_3, m.month, e."count" FROM v_month m
    LEFT JOIN v_evidence e ON e.gid_3 = m.gid_3 AND e.month = m.month AND e.field = 'night_image'""", ["v_month", "v_evidence"])
def _(v):
    found = v.evidence.filter("field = 'night_image'").select("gid_3", "month", "count")
    return v.month.select("gid_3", "month").join(found, ["gid_3", "month"], "left")


@query("d11_resolve_ids", """
    w AS (SELECT DISTINCT CASE custkey % 4 WHEN 0 THEN gid_3 WHEN 1 THEN left(gid_3, length(gid_3) - 2)
          WHEN 2 THEN left(gid_3, length(gid_3) - 2) || '_9' ELSE 'X' || gid_3 END AS wanted FROM v_unit),
    k AS (SELECT CASE WHEN custkey % 10 = 2 THEN left(gid_3, length(gid_3) - 2) || '_3' ELSE gid_3 END AS resolved FROM v_unit),
    p AS (SELECT wanted, resolved, CASE WHEN resolved = wanted THEN 1 WHEN resolved = regexp_replace(wanted, '_\\d+$', '') THEN 2
            WHEN resolved = regexp_replace(wanted, '_\\d+$', '') || '_1' THEN 3 WHEN resolved IS NOT NULL THEN 4 END AS rank
          FROM w LEFT JOIN k ON regexp_replace(wanted, '_\\d+$', '') = regexp_replace(resolved, '_\\d+$', ''))
    SELECT wanted, resolved, rank FROM p QUALIFY row_number() OVER (PARTITION BY wanted ORDER BY rank, resolved) = 1""", ["v_unit"])
def _(v):
    base = F.regexp_replace("gid_3", r"_\d+$", "")
    k = F.col("custkey")
    wanted = v.unit.select(F.when(k % 4 == 0, F.col("gid_3")).when(k % 4 == 1, base)
                           .when(k % 4 == 2, F.concat(base, F.lit("_9")))
                           .otherwise(F.concat(F.lit("X"), "gid_3")).alias("gid_3"))
    known = v.unit.select(F.when(k % 10 == 2, F.concat(base, F.lit("_3"))).otherwise(F.col("gid_3")).alias("gid_3"))
    return keys.resolve_ids(wanted, known)


@query("d14_reconcile_status", f"""
    s AS (SELECT DISTINCT ON (gid_3, month, kind) gid_3, month, kind,
            CASE WHEN (month + length(gid_3)) % 5 = 0 THEN 'fail' ELSE 'ok' END AS state
          FROM v_named WHERE gid_3 IS NOT NULL),
    names AS (SELECT DISTINCT regexp_extract(path, '([^/]+)$', 1) AS name FROM v_named WHERE o_orderkey % 3 <> 0),
    c AS (SELECT s.*, state = 'ok' AND names.name IS NULL AS lost FROM s LEFT JOIN names ON names.name =
          replace(gid_3, '.', '_') || '_' || kind || '_{YEAR}' || lpad(CAST(month AS VARCHAR), 2, '0') || '.tif')
    SELECT gid_3, CASE WHEN count(*) FILTER (WHERE lost) > 0 THEN 'partial' ELSE 'done' END AS status,
      CAST(CASE WHEN count(*) FILTER (WHERE lost) > 0 THEN 2 ELSE 3 END AS BIGINT) AS attempts,
      count(*) FILTER (WHERE lost) AS lost, coalesce(string_agg(kind || ' ' || lpad(CAST(month AS VARCHAR), 2, '0'), ', '
        ORDER BY kind || ' ' || lpad(CAST(month AS VARCHAR), 2, '0')) FILTER (WHERE lost), '') AS lost_months,
      coalesce(string_agg(lpad(CAST(month AS VARCHAR), 2, '0') || '=' || CASE WHEN lost THEN 'missing' ELSE state END, ','
        ORDER BY month) FILTER (WHERE kind = 'day'), '') AS t2 FROM c GROUP BY gid_3""", ["v_named"])
def _(v):
    mm = F.lpad(F.col("month").cast("string"), 2, "0")
    slots = v.named.select("gid_3", "kind", mm.alias("mm"), F.when(
        (F.col("month") + F.length("gid_3")) % 5 == 0, "fail").otherwise("ok").alias("state")).distinct()
    entry = lambda kind: F.map_from_entries(F.collect_list(F.when(F.col("kind") == kind, F.struct("mm", "state"))))
    claims = slots.groupBy("gid_3").agg(F.lit("done").alias("status"), F.lit(3).cast("long").alias("attempts"),
                                        entry("day").alias("t2"), entry("night").alias("t3img"))
    have = v.named.filter("o_orderkey % 3 <> 0").select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"))
    out = status.reconcile_status(claims, have, YEAR)
    pairs = F.transform(F.array_sort(F.map_entries("t2")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return out.select("gid_3", "status", "attempts", "lost", "lost_months", F.array_join(pairs, ",").alias("t2"))


@query("d15_compare_index", """SELECT gid_3, count(a.month) AS rows_left, count(b.month) AS rows_right,
    round(max(abs(a.val - b.val)), 6) AS max_abs_diff, CAST(sum(CASE WHEN a.month IS NOT NULL AND b.month IS NOT NULL
      AND (a.val IS NULL) <> (b.val IS NULL) THEN 1 ELSE 0 END) AS BIGINT) AS null_mismatch,
    CASE WHEN count(a.month) = count(b.month) AND null_mismatch = 0 AND coalesce(max(abs(a.val - b.val)), 0) <= 1e-6
      THEN 'PASS' ELSE 'FAIL' END AS level
    FROM v_month a FULL JOIN (SELECT gid_3, month, CASE WHEN n > 2 THEN NULL WHEN n > 1 THEN val + 0.5 ELSE val END AS val FROM v_month
      WHERE month <> 4) b USING (gid_3, month) GROUP BY gid_3""", ["v_month"])
def _(v):
    n = F.col("n")
    other = v.month.filter("month <> 4").select("gid_3", "month", F.when(n > 2, None).when(n > 1, F.col("val") + 0.5)
                                                .otherwise(F.col("val")).alias("val"))
    return rounded(compare.compare_index(v.month.select("gid_3", "month", "val"), other, ["val"],
                                         ["gid_3", "month"], ["gid_3"]))


_CACHE = """(SELECT path, size + CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS size, mtime, hash, version,
    CASE WHEN o_orderkey % 5 = 0 THEN 'failed' ELSE 'done' END AS state FROM v_manifest)"""


def _cache(v):
    k = F.col("o_orderkey")
    return v.manifest.select("path", (F.col("size") + F.when(k % 4 == 0, 1).otherwise(0)).alias("size"), "mtime", "hash",
                             "version", F.when(k % 5 == 0, "failed").otherwise("done").alias("state"))


@query("d16_reuse_verdicts", f"""SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM {_CACHE} c WHERE c.state = 'done'
    AND c.path = m.path AND c.size = m.size AND c.mtime = m.mtime AND c.hash = m.hash) THEN 'done' END AS state FROM v_manifest m""",
       ["v_manifest"])
def _(v):
    return compare.reuse_verdicts(v.manifest, _cache(v)).select("o_orderkey", "state")


@query("d16_to_validate", f"""SELECT o_orderkey FROM v_manifest m WHERE NOT EXISTS (SELECT 1 FROM {_CACHE} c WHERE c.state = 'done'
    AND c.path = m.path AND c.size = m.size AND c.mtime = m.mtime AND c.hash = m.hash)""", ["v_manifest"])
def _(v):
    return compare.to_validate(v.manifest, _cache(v)).select("o_orderkey")


# --- aggregations --------------------------------------------------------------------------------------------

@query("e5_window_histogram", """SELECT CASE WHEN c0 > 0 THEN 0 WHEN c1 > 0 THEN 1 WHEN c2 > 0 THEN 2 ELSE -1 END AS "window",
    count(*) AS n FROM v_plan GROUP BY 1""", ["v_plan"])
def _(v):
    return scenes.window_histogram(v.plan)


_WIDE_STATES = """SELECT i.kind || '_image' AS field, state, count(*) AS n FROM v_images i GROUP BY ALL"""


@query("e6_state_counts", _WIDE_STATES, ["v_images"])
def _(v):
    wide = v.images.groupBy("gid_3", "month").agg(*[F.max(F.when(F.col("kind") == k, F.col("state"))).alias(f"{k}_image")
                                                    for k in ("day", "night")])
    return keys.state_counts(wide, ["day_image", "night_image"]).filter("state IS NOT NULL")


_TASKS = """(SELECT event_type || '_csv_' || user_id AS description, ts, event_id AS seq,
    CASE CAST(json_extract_string(props, '$.k') AS INT) % 3 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'FAILED' ELSE 'RUNNING' END AS state
    FROM events)"""


def _tasks(v):
    k = F.get_json_object("props", "$.k").cast("int") % 3
    return v.table("events").select(
        F.concat("event_type", F.lit("_csv_"), F.col("user_id").cast("string")).alias("description"), "ts",
        F.col("event_id").alias("seq"),
        F.when(k == 0, "COMPLETED").when(k == 1, "FAILED").otherwise("RUNNING").alias("state"))


@query("e7_task_status", f"""SELECT split_part(description, '_', 1) || '_csv' AS kind,
    count(*) FILTER (WHERE state = 'COMPLETED') AS "COMPLETED", count(*) FILTER (WHERE state = 'FAILED') AS "FAILED",
    count(*) FILTER (WHERE state = 'RUNNING') AS "RUNNING"
    FROM (SELECT description, arg_max(state, (ts, seq)) AS state FROM {_TASKS} GROUP BY description) GROUP BY 1""")
def _(v):
    return status.task_pivot(_tasks(v), ["COMPLETED", "FAILED", "RUNNING"])


@query("e8_month_complete", "SELECT gid_3, count(DISTINCT month) AS months, count(DISTINCT month) = 12 AS complete FROM v_images GROUP BY gid_3",
       ["v_images"])
def _(v):
    return keys.month_complete(v.images)


@query("e9_distinct_counts", "SELECT count(DISTINCT gid_3) AS n_gid_3, count(DISTINCT gid_1) AS n_gid_1 FROM v_admin", ["v_admin"])
def _(v):
    return keys.distinct_counts(v.admin, ["gid_3", "gid_1"])


_LEVEL = "CASE {s} WHEN 'failed' THEN 'FAIL' WHEN 'partial' THEN 'WARN' ELSE 'PASS' END"


@query("e10_worst", f"""SELECT gid_3, attempts, CASE max(CASE status WHEN 'failed' THEN 2 WHEN 'partial' THEN 1 ELSE 0 END)
    WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS level FROM v_status GROUP BY gid_3, attempts""", ["v_status"])
def _(v):
    levels = v.status.withColumn("level", F.expr(_LEVEL.format(s="status")))
    return contract.worst(levels, ["gid_3", "attempts"])


@query("e11_first_positive", """SELECT gid_3, month, CASE WHEN c0 > 0 THEN c0 WHEN c1 > 0 THEN c1 WHEN c2 > 0 THEN c2 ELSE 0 END AS n
    FROM v_plan""", ["v_plan"])
def _(v):
    return v.plan.select("gid_3", "month", scenes.first_positive(F.array("c0", "c1", "c2")).alias("n"))


@query("e12_keep_last", """SELECT unit, collection, arg_max(scene_id, (ts, scene_id)) AS scene_id, arg_max(cloud, (ts, scene_id)) AS cloud,
    max(ts) AS ts FROM v_scene GROUP BY unit, collection""", ["v_scene"])
def _(v):
    return keys.keep_last(v.scene.select("unit", "collection", "scene_id", "cloud", "ts"), ["unit", "collection"],
                          ["ts", "scene_id"])


@query("e12_keep_first", """SELECT unit, collection, arg_min(scene_id, (ts, scene_id)) AS scene_id, arg_min(cloud, (ts, scene_id)) AS cloud,
    min(ts) AS ts FROM v_scene GROUP BY unit, collection""", ["v_scene"])
def _(v):
    return keys.keep_first(v.scene.select("unit", "collection", "scene_id", "cloud", "ts"), ["unit", "collection"],
                           ["ts", "scene_id"])


@query("e12_drop_exact", "SELECT DISTINCT gid_3, status, attempts, errors FROM v_status", ["v_status"])
def _(v):
    return keys.drop_exact(v.status.select("gid_3", "status", "attempts", "errors"))


_LATEST = "SELECT DISTINCT ON (gid_3) * FROM v_status ORDER BY gid_3, ts DESC, seq DESC"


@query("e13_latest_by", f"SELECT gid_3, run_id, seq, status, attempts, errors FROM ({_LATEST})", ["v_status"])
def _(v):
    return keys.latest_by(v.status, ["gid_3"], ["ts", "seq"]).drop("ts")


@query("e15_finished", f"""SELECT gid_3, status IN ('done', 'not_in_asset') OR (attempts >= 3 AND lower(errors) NOT LIKE '%429%') AS finished
    FROM ({_LATEST})""", ["v_status"])
def _(v):
    return keys.latest_by(v.status, ["gid_3"], ["ts", "seq"]).select("gid_3", status.finished().alias("finished"))


@query("e17_listed_by_province", """SELECT gid_1, chunk, string_agg(gid_3, ',' ORDER BY gid_3) AS gids, count(*) AS n FROM (
    SELECT gid_1, gid_3, (row_number() OVER (PARTITION BY gid_1 ORDER BY gid_3) - 1) // 7 AS chunk FROM v_admin) GROUP BY gid_1, chunk""", ["v_admin"])
def _(v):
    lists = keys.listed(v.admin, ["gid_1"], "gid_3", 7)
    return lists.select("gid_1", "chunk", F.array_join("gid_3s", ",").alias("gids"), "n")


@query("e17_listed_by_window", """SELECT month, CASE WHEN c0 > 0 THEN 0 WHEN c1 > 0 THEN 1 WHEN c2 > 0 THEN 2 END AS "window",
    count(*) AS units FROM v_plan WHERE c0 > 0 OR c1 > 0 OR c2 > 0 GROUP BY 1, 2""", ["v_plan"])
def _(v):
    classed = v.plan.withColumn("window", scenes.window_class()).filter("window IS NOT NULL")
    lists = keys.listed(classed, ["month", "window"], "gid_3", 500)
    return lists.groupBy("month", "window").agg(F.sum(F.size("gid_3s")).alias("units"))


@query("e18_pivot_months", "SELECT gid_3, area_ha, " + ", ".join(
    f"max(CASE WHEN month = {m} THEN {x} END) AS {x}_{m:02d}" for m in range(1, 13) for x in ("n", "avg_rad_count"))
    + " FROM v_long GROUP BY gid_3, area_ha", ["v_long"])
def _(v):
    return zonal.pivot_months(v.long, ["gid_3", "area_ha"], ["n", "avg_rad_count"])


@query("e18_unpivot_months", f"""SELECT g.gid_3, g.month, round(l.avg_rad_sum, 6) AS avg_rad_sum, l.n
    FROM v_grid g LEFT JOIN v_long l USING (gid_3, month) WHERE g.gid_3 IN (SELECT gid_3 FROM v_long)""", ["v_grid", "v_long"])
def _(v):
    wide = zonal.pivot_months(v.long, ["gid_3"], ["n", "avg_rad_sum"])
    return rounded(zonal.unpivot_months(wide, ["gid_3"], ["n", "avg_rad_sum"])).select("gid_3", "month", "avg_rad_sum", "n")


@query("e19_duplicate_keys", "SELECT kind, gid_3, month, count(*) AS n FROM v_named GROUP BY ALL HAVING count(*) > 1", ["v_named"])
def _(v):
    return keys.duplicate_keys(v.named, ["kind", "gid_3", "month"])


# --- trends and order --------------------------------------------------------------------------------------------

_W = "PARTITION BY gid_3 ORDER BY month"


@query("f1_ma3_rows", f"""SELECT gid_3, month, round(avg(val) OVER ({_W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 9) AS ma3
    FROM v_month""", ["v_month"])
def _(v):
    return rounded(trends.ma3_rows(v.month, "val").select("gid_3", "month", "ma3"), 9)


@query("f2_growth_rows", f"""SELECT gid_3, month, round(CASE WHEN p <> 0 THEN (z - p) / p * 100 WHEN z > 0 THEN 'inf'::DOUBLE END, 6)
    AS growth_pct FROM (SELECT *, lag(z) OVER ({_W}) AS p FROM (SELECT *, CASE WHEN month % 4 = 0 THEN 0 ELSE val END AS z FROM v_month))""",
       ["v_month"])
def _(v):
    zeroed = v.month.withColumn("z", F.when(F.col("month") % 4 == 0, 0.0).otherwise(F.col("val")))
    return rounded(trends.growth_rows(zeroed, "z").select("gid_3", "month", "growth_pct"))


@query("f3_trends_contiguous", f"""SELECT gid_3, month,
    round(CASE WHEN month - m1 = 1 AND m1 - m2 = 1 THEN (val + p1 + p2) / 3 END, 6) AS ntl_ma3,
    round(CASE WHEN month - m1 = 1 AND p1 <> 0 THEN 100 * (val / p1 - 1) END, 6) AS ntl_mom_growth_pct
    FROM (SELECT *, lag(month) OVER ({_W}) AS m1, lag(month, 2) OVER ({_W}) AS m2, lag(val) OVER ({_W}) AS p1,
                 lag(val, 2) OVER ({_W}) AS p2 FROM v_month)""", ["v_month"])
def _(v):
    out = trends.trends_contiguous(v.month.withColumnRenamed("val", "ntl_sum"))
    return rounded(out.select("gid_3", "month", "ntl_ma3", "ntl_mom_growth_pct"))


@query("f4_keep_first_by_arrival", """SELECT gid_3, status, min(seq) AS seq FROM v_status GROUP BY gid_3, status""", ["v_status"])
def _(v):
    return keys.keep_first(v.status.select("gid_3", "status", "seq", F.col("seq").alias("arrival")),
                           ["gid_3", "status"], ["arrival"]).select("gid_3", "status", "seq")


@query("f5_failure_streaks", """SELECT run_id, count(*) AS streak, min(seq) AS first_seq, max(seq) AS last_seq, count(*) >= 5 AS alarm
    FROM (SELECT *, count(*) FILTER (WHERE status <> 'failed') OVER (PARTITION BY run_id ORDER BY ts, seq) AS i FROM v_status)
    WHERE status = 'failed' GROUP BY run_id, i""", ["v_status"])
def _(v):
    out = status.failure_streaks(v.status.select("run_id", "ts", "seq", "status"), ["run_id"], ["ts", "seq"],
                                 F.col("status") != "failed", status.OVERLAY_STREAK)
    return out.select("run_id", "streak", "first_seq", "last_seq", "alarm")


@query("g1_natural_order", f"SELECT gid_3, row_number() OVER (ORDER BY {_NAT.format('gid_3')}) AS rank FROM v_admin", ["v_admin"])
def _(v):
    return ordering.natural_order(v.admin.select("gid_3"))


@query("g2_nulls_first_order", """SELECT seq, row_number() OVER (ORDER BY a NULLS FIRST, status, seq) AS rank
    FROM (SELECT *, CASE WHEN attempts > 0 THEN attempts END AS a FROM v_status)""", ["v_status"])
def _(v):
    gaps = v.status.select("seq", "status", F.when(F.col("attempts") > 0, F.col("attempts")).alias("a"))
    return ordering.nulls_first_order(gaps, ["a", "status", "seq"]).select("seq", "rank")


@query("g3_head_per_group", """SELECT gid_1, gid_3 FROM v_admin QUALIFY row_number() OVER (PARTITION BY gid_1 ORDER BY gid_3) <= 5""",
       ["v_admin"])
def _(v):
    return ordering.head_per_group(v.admin, ["gid_1"], ["gid_3"], 5).select("gid_1", "gid_3")


@query("g3_head", "SELECT seq, gid_3 FROM v_status WHERE status = 'failed' ORDER BY ts DESC, seq LIMIT 20", ["v_status"])
def _(v):
    return ordering.head(v.status.filter("status = 'failed'"), [F.desc("ts"), "seq"], 20).select("seq", "gid_3")


@query("g4_pilot_sample", f"""
    t AS (SELECT gid_3, CASE lower(type_3) WHEN 'phường' THEN 0 WHEN 'xã' THEN 1 ELSE 2 END AS slot, {_NAT.format('gid_3')} AS k FROM v_admin),
    r AS (SELECT *, CASE WHEN slot < 2 THEN row_number() OVER (PARTITION BY slot ORDER BY k) ELSE 1000000 END AS turn FROM t)
    SELECT gid_3 FROM r ORDER BY turn, slot, k LIMIT 25""", ["v_admin"])
def _(v):
    return ordering.pilot_sample(v.admin, 25).select("gid_3")


@query("g5_newest", "SELECT hash, max(mtime) AS newest FROM v_manifest GROUP BY hash", ["v_manifest"])
def _(v):
    return keys.newest(v.manifest, ["hash"], "mtime")


# --- sets ------------------------------------------------------------------------------------------------------

@query("h1_union_all", """SELECT gid_3, month, val, NULL::VARCHAR AS kind FROM v_month
    UNION ALL SELECT gid_3, month, NULL, kind FROM v_images""", ["v_month", "v_images"])
def _(v):
    return keys.union_all([v.month.select("gid_3", "month", "val"), v.images.select("gid_3", "month", "kind")])


@query("h2_key_except", "SELECT gid_3 FROM v_admin EXCEPT SELECT gid_3 FROM v_month", ["v_admin", "v_month"])
def _(v):
    return keys.key_except(v.admin, v.month, ["gid_3"])


@query("h2_key_intersect", "SELECT gid_3, month FROM v_month INTERSECT SELECT gid_3, month FROM v_images", ["v_month", "v_images"])
def _(v):
    return keys.key_intersect(v.month, v.images, ["gid_3", "month"])


@query("h3_table_differences", """SELECT gid_3, month, val, 'left' AS side FROM v_month WHERE n > 1
    UNION ALL SELECT gid_3, month, val + 1, 'right' FROM v_month WHERE n > 1""", ["v_month"])
def _(v):
    a = v.month.select("gid_3", "month", "val")
    b = v.month.select("gid_3", "month", (F.col("val") + F.when(F.col("n") > 1, 1).otherwise(0)).alias("val"))
    return compare.table_differences(a, b)


# --- contract -----------------------------------------------------------------------------------------------------

@query("k1_admin_violations", """
    a AS (SELECT * REPLACE (CASE WHEN type_3 = 'nan' THEN '' ELSE name_3 END AS name_3) FROM v_admin UNION ALL
          SELECT * FROM v_admin WHERE type_3 = 'Xã')
    SELECT 'blank' AS "check", gid_3 AS detail FROM a WHERE name_3 = ''
    UNION ALL SELECT 'duplicate', gid_3 FROM a GROUP BY gid_3 HAVING count(*) > 1
    UNION ALL SELECT 'count', count(*) || ' of 11163' FROM a HAVING count(*) <> 11163""", ["v_admin"])
def _(v):
    broken = v.admin.withColumn("name_3", F.when(F.col("type_3") == "nan", "").otherwise(F.col("name_3")))
    return contract.admin_violations(broken.unionByName(v.admin.filter("type_3 = 'Xã'")))


@query("k2_normalize", f"SELECT {_PFX}, {_DAY} FROM ({completed('v_day')}) JOIN v_admin USING (gid_3)",
       ["v_grid", "v_day", "v_admin"])
def _(v):
    legacy = v.day.unionByName(v.day.filter("month < 3"))
    legacy = legacy.toDF(*[c.upper() if c in S.KEY else c for c in legacy.columns])
    return contract.normalize(legacy, v.admin, "day", YEAR)


@query("k2_normalize_violations", """
    SELECT 'conflict' AS "check", gid_3 || '/' || month AS detail FROM v_day WHERE month = 2
    UNION ALL SELECT DISTINCT 'unknown', gid_3 FROM v_day WHERE gid_3 NOT IN (SELECT gid_3 FROM v_admin WHERE type_3 <> 'Xã')""",
       ["v_day", "v_admin"])
def _(v):
    double = v.day.filter("month = 2").withColumn("BLUE_mean", F.col("BLUE_mean") + 1)
    return contract.normalize_violations(v.day.unionByName(double), v.admin.filter("type_3 <> 'Xã'"), "day", YEAR)


@query("k3_day_states", f"f AS ({flagged('v_day', 'day_indices')}) " + state_sql("day", "SELECT * FROM f", "z0"),
       ["v_grid", "v_day", "v_evidence"])
def _(v):
    return contract.metric_states(v.day_full, "day", v.evidence, YEAR)


_LATE = "SELECT * REPLACE (CASE WHEN month = 6 THEN 'x' ELSE \"TIME\" END AS \"TIME\", CASE WHEN month = 7 THEN NULL ELSE \"TNL\" END AS \"TNL\") FROM v_night"


@query("k3_night_states", f"b AS ({_LATE}), f AS ({flagged('b', 'night_indices')}) " + state_sql("night", "SELECT * FROM f", "z0"),
       ["v_grid", "v_night", "v_evidence"])
def _(v):
    broken = v.night.withColumns({"TIME": F.when(F.col("month") == 6, "x").otherwise(F.col("TIME")),
                                  "TNL": F.when(F.col("month") != 7, F.col("TNL"))})
    full = contract.normalize(broken, v.admin, "night", YEAR)
    return contract.metric_states(full, "night", v.evidence, YEAR)


def _progress(v):
    return contract.progress(v.admin, v.day, v.night, v.images, v.evidence, None, YEAR)


def _progress_sql(previous=False):
    """CTEs of the progress table `pr`."""
    image = lambda k: (f"CASE WHEN coalesce({k}.state, 'pending') = 'pending' AND z{k}.\"count\" = 0 THEN 'no_source' "
                       f"ELSE coalesce({k}.state, 'pending') END AS {k}_image, "
                       f"CASE WHEN coalesce({k}.state, 'pending') = 'pending' AND z{k}.\"count\" = 0 THEN '' "
                       f"ELSE coalesce({k}.error, '{S.MSG_NO_IMAGE}') END AS {k}_image_error")
    joins = " ".join(
        f"LEFT JOIN v_images {k} ON {k}.gid_3 = g.gid_3 AND {k}.month = g.month AND {k}.kind = '{k}' "
        f"LEFT JOIN v_evidence z{k} ON z{k}.gid_3 = g.gid_3 AND z{k}.month = g.month AND z{k}.field = '{k}_image' "
        f"JOIN s{k} ON s{k}.gid_3 = g.gid_3 AND s{k}.month = g.month" for k in ("day", "night"))
    states = lambda k: f"s{k}.state AS {k}_indices, s{k}.error AS {k}_indices_error"
    return (f"fday AS ({flagged('v_day', 'day_indices')}), sday AS ({state_sql('day', 'SELECT * FROM fday', 'z0')}), "
            f"fnight AS ({flagged('v_night', 'night_indices')}), snight AS ({state_sql('night', 'SELECT * FROM fnight', 'z0')}), "
            f"pr AS (SELECT a.*, g.year, g.month, {image('day')}, {states('day')}, {image('night')}, {states('night')} "
            f"FROM v_grid g JOIN v_admin a ON a.gid_3 = g.gid_3 {joins})")


_PROGRESS_VIEWS = ["v_grid", "v_day", "v_night", "v_evidence", "v_images", "v_admin"]


@query("k4_progress", _progress_sql() + " SELECT * FROM pr", _PROGRESS_VIEWS)
def _(v):
    return _progress(v)


def _previous(v):
    """An earlier checkpoint with interrupted work."""
    base = v.spark.createDataFrame([], S.progress_schema())
    fields = {c: F.lit(None).cast("string") for f in S.FIELDS for c in (f, f + "_error")}
    rows = keys.month_grid(v.admin, YEAR).filter("month % 2 = 0").withColumns(fields).withColumns({
        "night_image": F.lit("running"), "day_image": F.lit("failed"), "day_image_error": F.lit("disk full")})
    return base.unionByName(rows, allowMissingColumns=True)


@query("d7_previous_checkpoint", _progress_sql() + f""" SELECT gid_3, month,
    CASE WHEN day_image = 'pending' AND month % 2 = 0 THEN 'failed' ELSE day_image END AS day_image,
    CASE WHEN day_image = 'pending' AND month % 2 = 0 THEN 'disk full' ELSE day_image_error END AS day_image_error,
    CASE WHEN night_image = 'pending' AND month % 2 = 0 THEN 'failed' ELSE night_image END AS night_image,
    CASE WHEN night_image = 'pending' AND month % 2 = 0 THEN '{S.MSG_INTERRUPTED}' ELSE night_image_error END AS night_image_error
    FROM pr""", _PROGRESS_VIEWS)
def _(v):
    table = contract.progress(v.admin, v.day, v.night, v.images, v.evidence, _previous(v), YEAR)
    return table.select("gid_3", "month", "day_image", "day_image_error", "night_image", "night_image_error")


@query("k5_gate_violations", _progress_sql() + """ SELECT gid_3, month, 'open' AS reason FROM pr WHERE month <> 9
      AND NOT (day_image IN ('done', 'no_source') AND day_indices IN ('done', 'no_source'))
    UNION ALL SELECT gid_3, NULL, 'months' FROM pr WHERE month <> 9 GROUP BY gid_3""", _PROGRESS_VIEWS)
def _(v):
    return contract.gate_violations(_progress(v).filter("month <> 9"), YEAR)


@query("k6_check_images", "SELECT kind, gid_3, month, state, error FROM v_images", ["v_images"])
def _(v):
    return v.images


@query("k6_null_metadata", """SELECT o_orderkey, CASE WHEN o_orderkey % 8 < 7 THEN 'failed' ELSE 'done' END AS state FROM orders""")
def _(v):
    k = F.col("o_orderkey") % 8
    keep = lambda i, x: F.when(k != i, x)
    images = v.table("orders").select(
        "o_orderkey", F.lit("night").alias("kind"), keep(0, F.lit(2)).alias("bands"), keep(1, F.lit(4326)).alias("epsg"),
        keep(2, F.lit(grid.STEP_500M)).alias("step_x"), keep(3, F.lit(-grid.STEP_500M)).alias("step_y"), keep(4, F.lit(0.0)).alias("rot_x"),
        keep(5, F.lit(0.0)).alias("rot_y"), keep(6, F.lit("float64")).alias("dtype"))
    return contract.check_images(images).select("o_orderkey", "state")


@query("k7_apply_updates", _progress_sql() + """ SELECT gid_3, month,
    CASE WHEN night_image NOT IN ('done', 'no_source') THEN CASE WHEN month = 3 THEN 'done' ELSE 'running' END ELSE night_image END AS night_image,
    CASE WHEN night_image NOT IN ('done', 'no_source') THEN CASE WHEN month = 3 THEN '' ELSE 'queued' END ELSE night_image_error END AS night_image_error
    FROM pr""", _PROGRESS_VIEWS)
def _(v):
    base = v.admin.select("gid_3", F.lit("night_image").alias("field"))
    updates = base.select("gid_3", F.lit(None).cast("long").alias("month"), "field", F.lit("running").alias("state"),
                          F.lit("queued").alias("error")).unionByName(
        base.select("gid_3", F.lit(3).cast("long").alias("month"), "field", F.lit("done").alias("state"),
                    F.lit("").alias("error")))
    return contract.apply_updates(_progress(v), updates).select("gid_3", "month", "night_image", "night_image_error")


@query("k8_verify_units", f"f AS ({flagged('v_day', 'day_indices')}), s AS ({state_sql('day', 'SELECT * FROM f', 'z0')}) " + """
    SELECT gid_3, CAST(12 AS BIGINT) AS rows, CAST(12 AS BIGINT) AS months, CAST(0 AS BIGINT) AS bad_keys,
      count(*) FILTER (WHERE state NOT IN ('done', 'no_source')) AS open,
      CASE WHEN count(*) FILTER (WHERE state NOT IN ('done', 'no_source')) = 0 THEN 'PASS' ELSE 'FAIL' END AS level
    FROM s GROUP BY gid_3""", ["v_grid", "v_day", "v_evidence"])
def _(v):
    return contract.verify_units(v.day_full, "day", v.evidence, v.admin, YEAR)


_OUTPUTS_SQL = f"""f AS ({flagged('v_day', 'day_indices')}), s0 AS ({state_sql('day', 'SELECT * FROM f', 'z0')}),
    s AS (SELECT * FROM s0 WHERE NOT (month = 7 AND length(gid_3) % 3 = 0) UNION ALL SELECT * FROM s0 WHERE month = 3 AND length(gid_3) % 4 = 0),
    u AS (SELECT gid_3, (SELECT count(*) FROM s WHERE s.gid_3 = a.gid_3) AS n, (SELECT count(DISTINCT month) FROM s WHERE s.gid_3 = a.gid_3) AS m FROM v_admin a),
    i AS (SELECT g.gid_3, g.month, count(v.state) AS n, max(v.error) AS e, max(v.state) AS st FROM v_grid g LEFT JOIN v_checked v ON v.kind = 'day' AND v.gid_3 = g.gid_3 AND v.month = g.month GROUP BY ALL),
    notes AS (SELECT gid_3, 'CSV/day_indices.csv' AS item, 0::BIGINT AS month, '{S.NOTE_MONTHS}' AS note FROM u WHERE n <> 12 OR m <> 12
      UNION ALL SELECT gid_3, 'CSV/day_indices.csv', 0, '{S.NOTE_KEY}' FROM u WHERE n > m
      UNION ALL SELECT DISTINCT gid_3, 'CSV/day_indices.csv', month, 'tháng ' || month || ': ' || state || ' ' || error FROM s WHERE state NOT IN ('done', 'no_source')
      UNION ALL SELECT i.gid_3, 'Ảnh day', i.month, 'tháng ' || i.month || ': ' || CASE WHEN n <> 1 THEN n || ' file' ELSE e END FROM i
        JOIN v_evidence v ON v.gid_3 = i.gid_3 AND v.month = i.month AND v.field = 'day_image' WHERE NOT (n = 0 AND v."count" = 0) AND (n <> 1 OR st <> 'done'))"""
_OUTPUTS_VIEWS = ["v_grid", "v_day", "v_evidence", "v_admin", "v_checked"]


def _output_notes(v):
    """Outputs with an absent month, a repeated one, open states, absent, several and bad images."""
    size = F.length("gid_3")
    copies = F.when((F.col("month") == 7) & (size % 3 == 0), 0).when((F.col("month") == 3) & (size % 4 == 0), 2).otherwise(1)
    table = v.day_full.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies))).drop("_copy")
    return contract.verify_notes(table, "day", v.evidence, v.admin, v.checked, YEAR)


@query("k8_verify_notes", _OUTPUTS_SQL + " SELECT gid_3, item, month, note FROM notes", _OUTPUTS_VIEWS)
def _(v):
    return _output_notes(v)


@query("k8_verify_report", _OUTPUTS_SQL + f""" SELECT gid_3, item, CASE WHEN count(note) = 0 THEN 'PASS' ELSE 'FAIL' END AS level,
    CASE WHEN count(note) > 0 THEN string_agg(note, '; ' ORDER BY month, note) WHEN item = 'Ảnh day' THEN '{S.NOTE_IMAGES_GOOD}' ELSE '{S.NOTE_CSV_GOOD}' END AS note
    FROM (SELECT gid_3, unnest(['CSV/day_indices.csv', 'Ảnh day']) AS item FROM v_admin) LEFT JOIN notes USING (gid_3, item) GROUP BY gid_3, item""", _OUTPUTS_VIEWS)
def _(v):
    return contract.verify_report(_output_notes(v), "day", v.admin)


@query("k9_group_state", """
    g AS (SELECT 'img_' || month || '_' || c0 AS prefix, gid_3, CASE WHEN c1 = 0 THEN 'pending' ELSE 'done' END AS image_state,
            length(gid_3) % 9 <> 0 AS has_polygon, c2 <> 4 AS tiles_present FROM v_plan),
    r AS (SELECT prefix, bool_and(image_state = 'done') AS all_done, bool_or(image_state <> 'done' AND NOT has_polygon) AS np,
            bool_or(image_state <> 'done' AND NOT tiles_present) AS gaps FROM g GROUP BY prefix)
    SELECT prefix, CASE WHEN all_done THEN 'done' WHEN prefix LIKE 'img_5_%' THEN 'failed'
      WHEN prefix LIKE 'img_7_%' OR prefix LIKE '%\\_2' ESCAPE '\\' THEN 'waiting' WHEN np THEN 'failed' WHEN gaps THEN 'partial'
      ELSE 'ready' END AS state FROM r""", ["v_plan"])
def _(v):
    units = v.plan.select(
        F.concat(F.lit("img_"), F.col("month").cast("string"), F.lit("_"), F.col("c0").cast("string")).alias("prefix"),
        "gid_3", F.when(F.col("c1") == 0, "pending").otherwise("done").alias("image_state"),
        (F.length("gid_3") % 9 != 0).alias("has_polygon"), (F.col("c2") != 4).alias("tiles_present"))
    names = units.select("prefix").distinct()
    tiles = names.filter(~F.col("prefix").endswith("_2")).select("prefix", F.lit(True).alias("settled"))
    tasks = names.filter("prefix LIKE 'img_5_%'").select("prefix", F.lit("FAILED").alias("state")).unionByName(
        names.filter("prefix LIKE 'img_7_%'").select("prefix", F.lit("RUNNING").alias("state")))
    return contract.group_state(units, tiles, tasks)


# --- whole plans -----------------------------------------------------------------------------------------------------

_NIGHT_SQL = f"SELECT {_PFX}, {_NIGHT} FROM ({completed('v_night')}) JOIN v_admin USING (gid_3)"


@query("night_index_table", _NIGHT_SQL, ["v_grid", "v_night", "v_admin"])
def night_flagship(v):
    return rounded(night_index_table(v.px, v.admin, YEAR))


@query("evidence_from_exports", f"""SELECT gid_3, CAST({YEAR} AS BIGINT) AS year, month, f AS field, n AS "count"
    FROM v_long, (VALUES ('night_indices'), ('night_image')) AS t(f) WHERE n IS NOT NULL
    UNION ALL SELECT gid_3, {YEAR}, month, 'day_indices', CAST(c0 AS DOUBLE) FROM v_plan WHERE c0 > 0""", ["v_long", "v_plan"])
def _(v):
    day = v.plan.filter("c0 > 0").select("gid_3", "month", F.col("c0").alias("SOURCE_COUNT"))
    return evidence_from_exports(day, zonal.pivot_months(v.long, ["gid_3", "area_ha"], ["n"]), YEAR)


@query("night_from_export", _NIGHT_SQL, ["v_grid", "v_night", "v_admin"])
def _(v):
    wide = zonal.pivot_months(v.long, ["gid_3", "area_ha"], ["n", *S.NIGHT_EXPORT_KEYS])
    return rounded(night_from_export(wide, v.admin, YEAR))


def _merged_sql(kind, new, evidence):
    """Twin of a merge: rows of `old` that are finished under `evidence` stay, others give way to `new`."""
    field = f"{kind}_indices"
    prior = flagged("old", field).replace("v_evidence", "ev")
    pick = ", ".join(f'CASE WHEN keep THEN o."{m}" ELSE n."{m}" END AS "{m}"' for m in S.METRICS[kind])
    return f"""old AS (SELECT * FROM v_{kind} WHERE month % 3 <> 0), new AS ({new}), ev AS ({evidence}), prior AS ({prior}),
    st AS ({state_sql(kind, 'SELECT * FROM prior', 'z0')})
    SELECT {_PFX}, {pick} FROM (SELECT p.*, s.state IN ('done', 'no_source') OR n0.gid_3 IS NULL AS keep FROM prior p JOIN st s USING (gid_3, year, month)
      LEFT JOIN new n0 USING (gid_3, year, month)) o LEFT JOIN new n USING (gid_3, year, month) JOIN v_admin USING (gid_3)"""


@query("day_from_export", _merged_sql("day", "SELECT * REPLACE (" + ", ".join(f"{m} * 10 AS {m}" for m in S.DAY_METRICS) + ") FROM v_day WHERE month <> 5",
       """SELECT e.* REPLACE (CASE WHEN e.field = 'day_indices' AND e.month <> 5 AND m.n IS NOT NULL THEN CAST(m.n % 2 AS DOUBLE) ELSE e."count" END AS "count")
          FROM v_evidence e LEFT JOIN v_month m USING (gid_3, month)"""), ["v_day", "v_month", "v_admin", "v_evidence"])
def _(v):
    export = v.month.select("gid_3", "month", "n").join(v.day.drop("year"), ["gid_3", "month"]).filter("month <> 5")
    export = export.withColumns({m: F.col(m) * 10 for m in S.DAY_METRICS}).withColumn("SOURCE_COUNT", F.col("n") % 2).drop("n")
    return day_from_export(export, v.day.filter("month % 3 <> 0"), v.admin, v.evidence, YEAR)


@query("night_merged", _merged_sql("night", "SELECT * FROM v_night", """SELECT e.* REPLACE (CASE WHEN e.field IN ('night_indices', 'night_image') AND l.n IS NOT NULL THEN l.n ELSE e."count" END AS "count")
          FROM v_evidence e LEFT JOIN v_long l USING (gid_3, month)""").replace("old AS (SELECT * FROM v_night", 'old AS (SELECT * REPLACE (round("TNL" * 10, 6) AS "TNL") FROM v_night'),
       ["v_night", "v_long", "v_admin", "v_evidence"])
def _(v):
    wide = zonal.pivot_months(v.long, ["gid_3", "area_ha"], ["n", *S.NIGHT_EXPORT_KEYS])
    old = v.night.filter("month % 3 <> 0").withColumn("TNL", F.col("TNL") * 10)
    return rounded(night_merged(wide, old, v.admin, v.evidence, YEAR))
