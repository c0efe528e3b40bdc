"""Status logs, task tallies, failure streaks and file reconciliation."""

from pyspark.sql import functions as F

from unitgrid.functions.text import image_name, is_rate_limited
from unitgrid.operators.keys import latest_by
from unitgrid.operators.ordering import running_sum

# Attempts allowed and streak lengths that raise an alarm.
MAX_ATTEMPTS = 3
OUTAGE_STREAK, OVERLAY_STREAK = 10, 5


def task_status(tasks, key="description", order=("ts", "seq")):
    """Newest record per task, counted per kind (first two words of the name) and state."""
    latest = latest_by(tasks, [key], order)
    kind = F.array_join(F.slice(F.split(key, "_"), 1, 2), "_")
    return latest.groupBy(kind.alias("kind"), "state").agg(F.count("*").alias("n"))


def task_pivot(tasks, states, key="description", order=("ts", "seq")):
    counts = task_status(tasks, key, order)
    return counts.groupBy("kind").agg(*[F.coalesce(F.sum(F.when(F.col("state") == s, F.col("n"))), F.lit(0)).alias(s)
                                        for s in states])


def finished(status="status", attempts="attempts", errors="errors"):
    """Done, not in the asset, or out of attempts; rate-limit errors never use up attempts."""
    over = ~is_rate_limited(errors) & (F.coalesce(F.col(attempts), F.lit(0)) >= MAX_ATTEMPTS)
    return F.coalesce(F.col(status).isin("done", "not_in_asset") | over, F.lit(False))


def failure_streaks(log, run, order, ok, limit=OUTAGE_STREAK):
    """Failures since the last success, as islands per run, with an alarm from `limit` on.

    Islands are numbered by a distributed running count of successes, so one long run spreads over
    all tasks; counting within islands combines before the shuffle.
    """
    numbered = running_sum(log, [*run, *order], F.when(ok, 1).otherwise(0), "_island")
    return (numbered.filter(~ok).groupBy(*run, "_island")
            .agg(F.count("*").alias("streak"), *[F.min(c).alias(f"first_{c}") for c in order],
                 *[F.max(c).alias(f"last_{c}") for c in order])
            .withColumn("alarm", F.col("streak") >= limit).drop("_island"))


def reconcile_status(status, manifest, year, slots=(("t2", "day"), ("t3img", "night"))):
    """Months claimed ok whose file is absent become missing; such units go back to partial.

    status: gid_3, status, attempts and one month->state map per slot; manifest: name. Maps have at most
    twelve entries, so regrouping them is bounded.
    """
    rows = None
    for slot, kind in slots:
        part = status.select("gid_3", F.lit(slot).alias("slot"), F.lit(kind).alias("kind"),
                             F.explode_outer(slot).alias("month", "state"))
        rows = part if rows is None else rows.unionByName(part)
    rows = rows.filter("month IS NOT NULL").withColumn("name", image_name("gid_3", "kind", F.lit(year), "month"))
    names = manifest.select("name").distinct().withColumn("_have", F.lit(True))
    checked = rows.join(names, "name", "left").withColumn("lost", (F.col("state") == "ok") & F.col("_have").isNull())
    entries = lambda slot: F.map_from_entries(F.array_sort(F.collect_list(F.when(
        F.col("slot") == slot, F.struct("month", F.when(F.col("lost"), "missing").otherwise(F.col("state")))))))
    label = F.concat_ws(" ", "kind", "month")
    per = checked.groupBy("gid_3").agg(
        *[entries(slot).alias(f"_{slot}") for slot, _ in slots], F.count_if("lost").alias("lost"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("lost"), label))), ", ").alias("lost_months"))
    hit = F.coalesce(F.col("lost") > 0, F.lit(False))
    return status.join(per, "gid_3", "left").select(
        "gid_3", F.when(hit, "partial").otherwise(F.col("status")).alias("status"),
        F.when(hit, F.least(F.coalesce("attempts", F.lit(0)), F.lit(MAX_ATTEMPTS - 1)))
        .otherwise(F.col("attempts")).alias("attempts"),
        *[F.coalesce(f"_{slot}", slot).alias(slot) for slot, _ in slots],
        F.coalesce("lost", F.lit(0)).alias("lost"), F.coalesce("lost_months", F.lit("")).alias("lost_months"))
