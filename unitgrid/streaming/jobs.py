"""Streaming jobs over event and log folders.

Every trigger reads a bounded number of files, so no key can gather more rows at once than one
trigger holds. Results go to tables, never to the driver.
"""

from pyspark.sql import functions as F

from unitgrid.operators.keys import keep_last
from unitgrid.session import numbered, scratch_path
from unitgrid.streaming import streaks
from unitgrid.streaming.logtable import LogTable, settle

# Fixed value: a file untouched for this long is complete.
QUIET = "15 minutes"


def instant(ts):
    """Zone-less event time as the instant it names in UTC; watermarks need an instant."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(ts)).cast("timestamp")


def wall_clock(ts):
    """Back to zone-less UTC."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def stream_files(spark, folder, schema, glob="*", fmt="parquet", max_files=64):
    """Files of a folder as they arrive."""
    return (spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", glob)
            .option("maxFilesPerTrigger", max_files).load(folder))


def stream_log(spark, folder, schema, max_files=64):
    """Status lines as they arrive; lines that do not parse are dropped."""
    lines = stream_files(spark, folder, "value string", "*", "text", max_files)
    parsed = lines.select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"))
    return parsed.filter(F.col("r.gid_3").isNotNull()).select("r.*")


def drain(stream, mode, label, key=(), output=None, checkpoint=None):
    """Process everything available and return the result as a table.

    With `output` and `checkpoint` given again, a later call goes on where an earlier one ended or broke off; without
    them a call stands alone.

    Complete mode: the last batch carries the whole result. Append mode: the batches add up. Update
    mode: the newest batch of each `key` counts.
    """
    spark = stream.sparkSession
    out, checkpoint = output or scratch_path(spark, label), checkpoint or scratch_path(spark, label + "-state")
    if mode == "append":
        query = (stream.writeStream.format("parquet").outputMode("append").option("path", out)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)

    def save(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    query = (stream.writeStream.foreachBatch(save).outputMode(mode)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    done = numbered(spark, out, "batch=")
    if not done:
        return spark.createDataFrame([], stream.schema)
    if mode == "update":
        rows = spark.read.schema(stream.schema.add("batch", "long")).parquet(out)
        return keep_last(rows, list(key), ["batch"]).select(*stream.columns)
    return spark.read.schema(stream.schema).parquet(f"{out}/batch={done[-1]}")


def ready_sessions(events, key, ts="ts", quiet=QUIET, delay="1 hour"):
    """Bursts of activity per key, closed by a quiet period."""
    return (events.withColumn("_t", instant(ts)).withWatermark("_t", delay)
            .groupBy(*key, F.session_window("_t", quiet).alias("w"))
            .agg(F.count("*").alias("n"), F.max("_t").alias("newest"))
            .select(*key, wall_clock(F.col("w.start")).alias("first_seen"),
                    wall_clock(F.col("w.end")).alias("ready_at"), "n"))


def latest_status(events, key, order, fields):
    """Newest record per key."""
    best = F.max_by(F.struct(*fields), F.struct(*order)).alias("r")
    return events.groupBy(*key).agg(best).select(*key, *[F.col(f"r.{f}").alias(f) for f in fields])


def tumbling_counts(events, by, ts="ts", size="1 day", delay="1 hour"):
    return _windowed(events, by, ts, delay, F.window("_t", size))


def sliding_counts(events, by, ts="ts", size="30 days", slide="15 days", delay="1 hour"):
    """Counts in overlapping windows: the widened month windows on a stream."""
    return _windowed(events, by, ts, delay, F.window("_t", size, slide))


def _windowed(events, by, ts, delay, window):
    return (events.withColumn("_t", instant(ts)).withWatermark("_t", delay).groupBy(*by, window.alias("w"))
            .agg(F.count("*").alias("n"))
            .select(*by, wall_clock(F.col("w.start")).alias("win_start"),
                    wall_clock(F.col("w.end")).alias("win_end"), "n"))


def without_duplicates(events, key, ts="ts", delay="1 day"):
    """Replayed records dropped while they are within the watermark."""
    return (events.withColumn("_t", instant(ts)).withWatermark("_t", delay)
            .dropDuplicatesWithinWatermark(list(key)).drop("_t"))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def failure_alarms(log, ts="ts", width=3600):
    """Stream of streak summaries per (run, slice of `width` seconds), for `streaks.run_streaks`. log: run, ts, seq, ok."""
    return streaks.slice_summaries(log, instant(ts), width)


def upsert_progress(progress, updates, label="progress", output=None, checkpoint=None, buckets=32, compact_after=16):
    """Apply a stream of updates to a progress table kept as a log (see `logtable`).

    A trigger appends its settled changes; after `compact_after` triggers the buckets they touched are written anew. A
    restarted or replayed trigger overwrites its own changes and gives the same table. With `output` and `checkpoint`
    given again, a later call goes on from there; `progress` then only gives the schema.
    """
    spark = progress.sparkSession
    out, checkpoint = output or scratch_path(spark, label), checkpoint or scratch_path(spark, label + "-state")
    table = LogTable(spark, out, progress.schema, buckets)
    if not table.exists():
        table.create(progress)

    def apply(batch, batch_id):
        table.append(settle(batch), batch_id)
        if max(map(len, table.open_changes().values()), default=0) >= compact_after:
            table.compact()
    query = (updates.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return table.read()
