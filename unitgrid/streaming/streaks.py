"""Failure streaks of runs, from summaries of time slices that merge.

Events of a (run, time slice) are kept in state, so an event that arrives late lands between its neighbours. A slice is
summed up by its leading, trailing and longest streak and its number of events. Such summaries merge in time order, in any
grouping, so a run with a third of all events is spread over its slices, and its result does not depend on how events
fall into files and triggers.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from unitgrid.operators.status import OUTAGE_STREAK
from unitgrid.session import ship_by_value

ship_by_value(__name__)

EVENT = np.dtype([("ts", "<i8"), ("seq", "<i8"), ("ok", "?")])
SUMMARY = "run string, slice long, leading long, trailing long, longest long, attempts long"
PARTS = ("leading", "trailing", "longest", "attempts")


def summary(ok):
    """(leading, trailing, longest, attempts) of outcomes in order."""
    gaps = np.diff(np.concatenate([[-1], np.flatnonzero(ok), [len(ok)]])) - 1
    return int(gaps[0]), int(gaps[-1]), int(gaps.max()), len(ok)


class SliceProcessor(StatefulProcessor):
    """The events of one (run, slice) as sorted records; every trigger that touches it gives its summary."""

    def init(self, handle):
        self._events = handle.getValueState("events", "body binary")

    def handleInputRows(self, key, rows, timer_values):
        parts = [np.frombuffer(self._events.get()[0], EVENT)] if self._events.exists() else []
        for frame in rows:
            part = np.empty(len(frame), EVENT)
            for name in EVENT.names:
                part[name] = frame[name].to_numpy()
            parts.append(part)
        events = np.concatenate(parts)
        events = events[np.lexsort((events["ok"], events["seq"], events["ts"]))]
        self._events.update((events.tobytes(),))
        yield pd.DataFrame([(key[0], key[1], *summary(events["ok"]))], columns=["run", "slice", *PARTS])

    def close(self):
        pass


def slice_summaries(log, instant, width=3600):
    """Stream of summaries per (run, slice of `width` seconds); the newest of a slice counts.

    log: run, seq, ok and the event time `instant` (a timestamp). Events are ordered by time, then seq, failures
    first. A NULL outcome is a failure, a NULL time or seq comes first. State holds 17 bytes an event.
    """
    micros = F.coalesce(F.unix_micros(instant), F.lit(0))
    events = log.select(F.col("run").cast("string").alias("run"), F.floor(micros / F.lit(width * 1_000_000)).alias("slice"), micros.alias("ts"),
                        F.coalesce(F.col("seq").cast("long"), F.lit(-2**63)).alias("seq"), F.coalesce("ok", F.lit(False)).alias("ok"))
    return events.groupBy("run", "slice").transformWithStateInPandas(SliceProcessor(), outputStructType=SUMMARY, outputMode="Update", timeMode="None")


def _joined(a, b):
    """Summary of two stretches of events, `a` before `b`."""
    return F.struct(
        (a["leading"] + F.when(a["leading"] == a["attempts"], b["leading"]).otherwise(0)).alias("leading"),
        (b["trailing"] + F.when(b["trailing"] == b["attempts"], a["trailing"]).otherwise(0)).alias("trailing"),
        F.greatest(a["longest"], b["longest"], a["trailing"] + b["leading"]).alias("longest"),
        (a["attempts"] + b["attempts"]).alias("attempts"))


def run_streaks(summaries, limit=OUTAGE_STREAK, fan=64):
    """Streaks per run: failures since the last success, attempts, longest, alarm from `limit` on.

    Summaries of neighbouring slices are merged `fan` at a time, in as many rounds as the range of slices asks for.
    """
    low, high = summaries.agg(F.min("slice"), F.max("slice")).first()
    span = 0 if low is None else high - low
    table = summaries.select("run", (F.col("slice") - F.lit(low or 0)).alias("slice"), *PARTS)
    none = F.struct(*[F.lit(0).cast("long").alias(p) for p in PARTS])
    while True:
        grouped = table.groupBy("run", F.floor(F.col("slice") / fan).alias("slice")).agg(F.sort_array(F.collect_list(F.struct("slice", *PARTS))).alias("s"))
        table = grouped.select("run", "slice", F.aggregate("s", none, _joined).alias("m")).select("run", "slice", *[f"m.{p}" for p in PARTS])
        if span < fan:
            return table.select("run", F.col("trailing").alias("streak"), "attempts", "longest", (F.col("longest") >= limit).alias("alarm"))
        span //= fan
