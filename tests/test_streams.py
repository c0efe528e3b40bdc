import os
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.operators import contract
from unitgrid.streaming import jobs, streaks
from unitgrid.streaming.logtable import LogTable

SCHEMA = "key string, ts timestamp_ntz, seq long, ok boolean"


def feed(spark, path, batches):
    """One file per batch, in arrival order."""
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "key string, ts string, seq long, ok boolean").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        df.coalesce(1).write.mode("append").parquet(path)
    return jobs.stream_files(spark, path, SCHEMA, "*.parquet", max_files=1)


BATCHES = [[("a", "2024-01-01 00:00:00", 1, False), ("a", "2024-01-01 00:05:00", 2, False)],
           [("a", "2024-01-01 00:10:00", 3, False), ("b", "2024-01-01 01:00:00", 4, True)],
           [("a", "2024-01-01 02:00:00", 5, True), ("a", "2024-01-01 02:01:00", 6, False)]]


def test_sessions_over_several_triggers(spark, tmp_path):
    out = jobs.drain(jobs.ready_sessions(feed(spark, str(tmp_path / "e"), BATCHES), ["key"]), "complete", "s").collect()
    got = sorted((r.key, str(r.first_seen), str(r.ready_at), r.n) for r in out)
    assert got == [("a", "2024-01-01 00:00:00", "2024-01-01 00:25:00", 3), ("a", "2024-01-01 02:00:00", "2024-01-01 02:16:00", 2),
                   ("b", "2024-01-01 01:00:00", "2024-01-01 01:15:00", 1)]


def test_append_mode_closes_windows_behind_the_watermark(spark, tmp_path):
    late = BATCHES + [[("z", "2024-01-09 00:00:00", 9, True)]]
    out = jobs.drain(jobs.tumbling_counts(feed(spark, str(tmp_path / "e"), late), ["key"]), "append", "w").collect()
    assert sorted((r.key, r.n) for r in out) == [("a", 5), ("b", 1)]


def test_latest_record_wins(spark, tmp_path):
    stream = feed(spark, str(tmp_path / "e"), BATCHES)
    out = jobs.drain(jobs.latest_status(stream, ["key"], ["ts", "seq"], ["seq", "ok"]), "complete", "l").collect()
    assert {r.key: (r.seq, r.ok) for r in out} == {"a": (6, False), "b": (4, True)}


def alarms(spark, log):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, jobs.ROCKSDB)
    try:
        return jobs.drain(jobs.failure_alarms(log.withColumnRenamed("key", "run"), width=900), "update", "a", ["run", "slice"])
    finally:
        spark.conf.set(provider, before)


def test_streaks_carry_over_triggers(spark, tmp_path):
    out = streaks.run_streaks(alarms(spark, feed(spark, str(tmp_path / "e"), BATCHES)), limit=3).collect()
    assert {r.run: (r.streak, r.attempts, r.longest, r.alarm) for r in out} == {"a": (1, 5, 3, True), "b": (0, 1, 0, False)}


def plain_streaks(events):
    out = {}
    for run in {e[0] for e in events}:
        streak = longest = 0
        rows = sorted((e[1], e[2], bool(e[3])) for e in events if e[0] == run)
        for *_, ok in rows:
            streak = 0 if ok else streak + 1
            longest = max(longest, streak)
        out[run] = (streak, len(rows), longest)
    return out


def test_streaks_do_not_depend_on_files(spark, tmp_path):
    """One run has most events; events arrive in any order, one of them very late; empty slices lie between."""
    rng = random.Random(6)
    at = lambda i: str(datetime(2024, 1, 1) + timedelta(seconds=i))
    events = [("hot" if rng.random() < 0.8 else f"r{rng.randrange(3)}", at(rng.randrange(40_000) + 9_000_000 * (i > 350)), i, rng.random() < 0.15) for i in range(400)]
    events += [("hot", at(5), 1000, False), ("r1", at(-86_400 * 400), 1001, None), ("r1", at(7), 1002, False), ("r1", at(7), 1002, True)]
    wanted = plain_streaks(events)
    for files in (1, 5):
        mixed = events[:]
        rng.shuffle(mixed)
        mixed = [e for e in mixed if e[2] != 1000] + [e for e in mixed if e[2] == 1000]
        size = -(-len(mixed) // files)
        summaries = alarms(spark, feed(spark, str(tmp_path / f"e{files}"), [mixed[i:i + size] for i in range(0, len(mixed), size)]))
        assert summaries.filter("run = 'hot'").count() > 30 and summaries.agg({"attempts": "max"}).first()[0] < 60
        for fan in (64, 2):
            assert {r.run: (r.streak, r.attempts, r.longest) for r in streaks.run_streaks(summaries, fan=fan).collect()} == wanted
    assert streaks.run_streaks(summaries.limit(0)).count() == 0


def test_summaries():
    assert streaks.summary(np.array([], bool)) == (0, 0, 0, 0)
    assert streaks.summary(np.array([False, False])) == (2, 2, 2, 2)
    assert streaks.summary(np.array([False, True, False, False, False, True])) == (1, 0, 3, 6)


def test_progress_stream_never_downgrades(spark, tmp_path):
    progress = spark.createDataFrame([("a", 1), ("b", 1)], "gid_3 string, month long").withColumns(
        {**{c: F.lit("") for c in S.ADMIN_COLUMNS if c != "gid_3"}, "year": F.lit(2024).cast("long"),
         **{c: F.lit("pending" if c in S.FIELDS else "") for f in S.FIELDS for c in (f, f + "_error")}})
    batches = [[("a", "2024-01-01 00:00:00", 1, True)], [("a", "2024-01-01 00:01:00", 2, False), ("b", "2024-01-01 00:02:00", 3, False)]]
    stream = feed(spark, str(tmp_path / "e"), batches).select(
        F.col("key").alias("gid_3"), F.lit(1).cast("long").alias("month"), F.lit("day_image").alias("field"),
        F.when(F.col("ok"), "done").otherwise("failed").alias("state"),
        F.lit("e").alias("error"), "ts", "seq")
    out = jobs.upsert_progress(progress, stream).collect()
    assert {r.gid_3: r.day_image for r in out} == {"a": "done", "b": "failed"}


def test_broken_log_lines_are_skipped(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"gid_3": "g", "seq": 1, "status": "done"}\n{"gid_3": "h", "se\n[1]\n')
    out = jobs.drain(jobs.stream_log(spark, str(folder), S.STATUS_SCHEMA), "append", "log").collect()
    assert [(r.gid_3, r.seq, r.status) for r in out] == [("g", 1, "done")]


def updates_of(stream):
    return stream.select(F.col("key").alias("gid_3"), F.lit(1).cast("long").alias("month"), F.lit("day_image").alias("field"),
                         F.when(F.col("ok"), "done").otherwise("failed").alias("state"), F.col("seq").cast("string").alias("error"), "ts", "seq")


def test_jobs_go_on_after_a_restart(spark, tmp_path):
    events, folders = str(tmp_path / "e"), {n: str(tmp_path / n) for n in ("out", "state", "p_out", "p_state")}
    progress = spark.createDataFrame([("a", 1), ("b", 1)], "gid_3 string, month long").withColumns(
        {**{c: F.lit("") for c in S.ADMIN_COLUMNS if c != "gid_3"}, "year": F.lit(2024).cast("long"),
         **{c: F.lit("pending" if c in S.FIELDS else "") for f in S.FIELDS for c in (f, f + "_error")}})

    def run(stream):
        latest = jobs.drain(jobs.latest_status(stream, ["key"], ["ts", "seq"], ["seq", "ok"]), "complete", "l", output=folders["out"], checkpoint=folders["state"])
        table = jobs.upsert_progress(progress, updates_of(stream), output=folders["p_out"], checkpoint=folders["p_state"])
        return {r.key: r.seq for r in latest.collect()}, {r.gid_3: (r.day_image, r.day_image_error) for r in table.collect()}

    first = run(feed(spark, events, BATCHES[:1]))
    assert first == ({"a": 2}, {"a": ("failed", "2"), "b": ("pending", "")})
    assert run(jobs.stream_files(spark, events, SCHEMA, "*.parquet", max_files=1)) == first  # nothing new
    last = run(feed(spark, events, BATCHES[1:]))
    assert last == ({"a": 6, "b": 4}, {"a": ("done", "5"), "b": ("done", "4")})
    whole = jobs.upsert_progress(progress, updates_of(jobs.stream_files(spark, events, SCHEMA, "*.parquet", max_files=1)))
    assert {r.gid_3: r.day_image for r in whole.collect()} == {"a": "done", "b": "done"}


def progress_rows(spark, units):
    return spark.createDataFrame([(u, m) for u in units for m in range(1, 13)], "gid_3 string, month long").withColumns(
        {**{c: F.lit("") for c in S.ADMIN_COLUMNS if c != "gid_3"}, "year": F.lit(2024).cast("long"),
         **{c: F.lit("pending" if c in S.FIELDS else "") for f in S.FIELDS for c in (f, f + "_error")}})


CHANGES = "gid_3 string, month long, field string, state string, error string"
TRIGGERS = [[("u1", None, "day_image", "running", "a"), ("u1", 2, "day_image", "failed", "b"), ("u7", 1, "night_image", "done", "")],
            [("u1", 2, "day_image", "done", "c"), ("u7", None, "night_image", "failed", "d"), ("nobody", 1, "day_image", "done", "")],
            [],
            [("u1", None, "day_image", "no_source", "e"), ("u2", 3, "day_indices", "running", "f")]]


def test_log_table_equals_one_rewrite_per_trigger(spark, tmp_path):
    base = progress_rows(spark, [f"u{i}" for i in range(40)])
    wanted, log = base, LogTable(spark, str(tmp_path / "t"), base.schema, 8)
    log.create(base)
    rows = lambda df: sorted(map(str, df.collect()))
    for n, trigger in enumerate(TRIGGERS):
        updates = spark.createDataFrame(trigger, CHANGES)
        wanted = contract.apply_updates(wanted, updates)
        log.append(updates, n)
        assert rows(log.read()) == rows(wanted)
        written = sum(f.stat().st_size for f in (tmp_path / "t" / "changes" / f"batch={n}").rglob("*.parquet"))
        assert written < sum(f.stat().st_size for f in (tmp_path / "t" / "base").rglob("*.parquet")) / 3
        if n == 1:
            touched = log.compact()
            assert 1 <= len(touched) <= 3 and not set(log.open_changes()) & set(touched) and rows(log.read()) == rows(wanted)
    # a trigger and a compaction that broke off are not seen, and their repetition overwrites them
    before = rows(log.read())
    for folder, n in (("changes/batch=", 4), ("base/c=", 3)):
        half = spark.createDataFrame([("u3", 1, "day_image", "done", "x", 4)], CHANGES + ", batch long")
        half.withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(str(tmp_path / "t" / f"{folder}{n}"))
        os.remove(tmp_path / "t" / f"{folder}{n}" / "_SUCCESS")
    assert rows(log.read()) == before
    log.append(spark.createDataFrame([("u3", 1, "day_image", "failed", "y")], CHANGES), 4)
    log.append(spark.createDataFrame([("u3", 1, "day_image", "failed", "y")], CHANGES), 4)
    log.compact()
    assert rows(log.read()) == rows(contract.apply_updates(wanted, spark.createDataFrame([("u3", 1, "day_image", "failed", "y")], CHANGES)))


def test_stream_compacts_as_it_goes(spark, tmp_path):
    stream = feed(spark, str(tmp_path / "e"), [[("u1", f"2024-01-01 00:0{i}:00", i, i == 3)] for i in range(5)])
    out = jobs.upsert_progress(progress_rows(spark, ["u1", "u2"]), updates_of(stream), output=str(tmp_path / "t"), compact_after=2)
    assert {(r.gid_3, r.day_image, r.day_image_error) for r in out.filter("month = 1").collect()} == {("u1", "done", "3"), ("u2", "pending", "")}
    assert len(os.listdir(tmp_path / "t" / "base")) >= 3


def test_updates_that_differ_stop_the_job(spark):
    base, twice = progress_rows(spark, ["u1"]), [("u1", 1, "day_image", "done", ""), ("u1", 1, "day_image", "failed", "")]
    assert contract.apply_updates(base, spark.createDataFrame(twice[:1] * 2, CHANGES)).filter("day_image = 'done'").count() == 1
    with pytest.raises(Exception, match="several updates at u1/1"):
        contract.apply_updates(base, spark.createDataFrame(twice, CHANGES)).collect()
