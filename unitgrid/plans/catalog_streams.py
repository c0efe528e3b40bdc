"""Streaming queries, each compared with its batch twin."""

from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.operators import keys, status
from unitgrid.plans.registry import query
from unitgrid.plans.sqlviews import YEAR
from unitgrid.session import scratch_path
from unitgrid.streaming import jobs, streaks


def _events(v):
    schema = v.table("events").schema
    return jobs.stream_files(v.spark, v.dir, schema, "events.parquet")


@query("l1_stream_log", "SELECT gid_3, run_id, seq, status, attempts FROM v_status", ["v_status"])
def _(v):
    path = scratch_path(v.spark, "log-in")
    lines = v.status.select(F.to_json(F.struct("gid_3", "run_id", "seq", "status", "attempts")).alias("value"))
    lines.union(lines.select(F.substring("value", 1, 9).alias("value"))).repartition(3).write.text(path)
    out = jobs.drain(jobs.stream_log(v.spark, path, S.STATUS_SCHEMA, max_files=1), "append", "log-out")
    return out.select("gid_3", "run_id", "seq", "status", "attempts")


@query("l2_ready_sessions", """SELECT user_id, min(ts) AS first_seen, max(ts) + INTERVAL 15 MINUTE AS ready_at, count(*) AS n FROM (
    SELECT *, count(*) FILTER (WHERE gap) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
      SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 15 MINUTE AS gap FROM events)) GROUP BY user_id, s""")
def _(v):
    return jobs.drain(jobs.ready_sessions(_events(v), ["user_id"]), "complete", "sessions")


@query("l3_latest_status", """SELECT DISTINCT ON (user_id, event_type) user_id, event_type, event_id, value FROM events
    ORDER BY user_id, event_type, ts DESC, event_id DESC""")
def _(v):
    latest = jobs.latest_status(_events(v), ["user_id", "event_type"], ["ts", "event_id"], ["event_id", "value"])
    return jobs.drain(latest, "complete", "latest")


@query("l4_tumbling_counts", """SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS win_start, date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS win_end,
    count(*) AS n FROM events GROUP BY ALL""")
def _(v):
    return jobs.drain(jobs.tumbling_counts(_events(v), ["event_type"]), "complete", "tumbling")


@query("l5_sliding_counts", """SELECT w AS win_start, w + INTERVAL 6 DAY AS win_end, event_type, count(*) AS n FROM events,
    (SELECT TIMESTAMP '2023-12-01' + to_days(CAST(3 * i AS INT)) AS w FROM range(0, 25) t(i))
    WHERE epoch(w)::BIGINT // 86400 % 3 = 0 AND ts >= w AND ts < w + INTERVAL 6 DAY GROUP BY ALL""")
def _(v):
    return jobs.drain(jobs.sliding_counts(_events(v), ["event_type"], size="6 days", slide="3 days"), "complete", "sliding")


@query("l6_without_duplicates", "SELECT event_id, user_id, event_type FROM events")
def _(v):
    replayed = _events(v).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    out = jobs.drain(jobs.without_duplicates(replayed, ["event_id"], delay="60 days"), "append", "distinct")
    return out.select("event_id", "user_id", "event_type")


@query("l8_upsert_progress", f"""
    u AS (SELECT 'U.' || (user_id % 50) AS gid_3, CAST(event_id % 12 + 1 AS BIGINT) AS month, ts, event_id,
            CASE event_type WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' ELSE 'running' END AS state FROM events),
    f AS (SELECT DISTINCT ON (gid_3, month) gid_3, month, state FROM u ORDER BY gid_3, month, state = 'done' DESC,
            CASE WHEN state = 'done' THEN epoch_us(ts) ELSE -epoch_us(ts) END, CASE WHEN state = 'done' THEN event_id ELSE -event_id END)
    SELECT gid_3, month, coalesce(f.state, 'pending') AS day_image FROM (SELECT gid_3, month FROM
      (SELECT DISTINCT 'U.' || (user_id % 50) AS gid_3 FROM events), (SELECT unnest(range(1, 13)) AS month)) LEFT JOIN f USING (gid_3, month)""")
def _(v):
    unit = F.concat(F.lit("U."), (F.col("user_id") % 50).cast("string"))
    units = v.table("events").select(unit.alias("gid_3")).distinct()
    fields = {c: F.lit("pending" if c in S.FIELDS else "") for f in S.FIELDS for c in (f, f + "_error")}
    names = {c: F.lit("") for c in S.ADMIN_COLUMNS if c != "gid_3"}
    progress = keys.month_grid(units, YEAR).withColumns({**names, **fields})
    kind = F.col("event_type")
    updates = _events(v).select(
        unit.alias("gid_3"), (F.col("event_id") % 12 + 1).alias("month"), F.lit("day_image").alias("field"),
        F.when(kind == "purchase", "done").when(kind == "error", "failed").otherwise("running").alias("state"),
        F.lit("").alias("error"), "ts", F.col("event_id").alias("seq"))
    return jobs.upsert_progress(progress, updates).select("gid_3", "month", "day_image")


@query("l7_failure_streaks_batch", """SELECT user_id % 5 AS run, max(streak) AS longest, count(*) FILTER (WHERE streak >= 3) AS alarms FROM (
    SELECT user_id, count(*) AS streak FROM (SELECT *, count(*) FILTER (WHERE event_type <> 'error') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events)
    WHERE event_type = 'error' GROUP BY user_id, i) GROUP BY user_id % 5""")
def _(v):
    e = v.table("events").select("user_id", "ts", "event_id", "event_type")
    streaks = status.failure_streaks(e, ["user_id"], ["ts", "event_id"], F.col("event_type") != "error", 3)
    return streaks.groupBy((F.col("user_id") % 5).alias("run")).agg(F.max("streak").alias("longest"),
                                                                   F.count_if("alarm").alias("alarms"))


@query("l7_failure_alarms", """SELECT 'run_' || (user_id % 5) AS run, count(*) AS attempts, max(st) AS longest, max(st) >= 10 AS alarm,
    count(*) FILTER (WHERE i = last_i AND event_type = 'error') AS streak FROM (
    SELECT *, max(i) OVER (PARTITION BY user_id % 5) AS last_i FROM (
    SELECT *, count(*) FILTER (WHERE event_type = 'error') OVER (PARTITION BY user_id % 5, i ORDER BY ts, event_id) AS st FROM (
      SELECT *, count(*) FILTER (WHERE event_type <> 'error') OVER (PARTITION BY user_id % 5 ORDER BY ts, event_id) AS i FROM events)))
    GROUP BY user_id % 5""")
def _(v):
    log = _events(v).select(F.concat(F.lit("run_"), (F.col("user_id") % 5).cast("string")).alias("run"), "ts",
                            F.col("event_id").alias("seq"), (F.col("event_type") != "error").alias("ok"))
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = v.spark.conf.get(provider)
    v.spark.conf.set(provider, jobs.ROCKSDB)
    try:
        summaries = jobs.drain(jobs.failure_alarms(log), "update", "alarms", ["run", "slice"])
    finally:
        v.spark.conf.set(provider, before)
    return streaks.run_streaks(summaries).select("run", "attempts", "longest", "streak", "alarm")
