"""Fire / resolve state per rule on a stream of statistics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from skyops.operators import alerts
from skyops.streaming import run
from skyops.streaming.logs import sliding_stats

EVENTS = ("name string, stream string, ts timestamp, metric string, operator string, "
          "threshold double, severity string, channels array<string>, value double, state string")
_COLUMNS = [c.split()[0] for c in EVENTS.split(", ")]


STATE = "firing boolean, ts timestamp, value double"


class Transitions(StatefulProcessor):
    """Keeps for each (rule, stream) whether it is firing, and when and at what value that began."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._firing = handle.getValueState("firing", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        ticks = pd.concat(list(rows)).sort_values("ts", kind="stable")
        before = self._firing.get()
        firing = bool(before[0]) if before is not None else False
        hit = ticks["breached"].to_numpy(dtype=bool)
        was = [firing, *hit[:-1]]
        changed = hit != was
        if changed.any():
            out = ticks[changed].copy()
            last = out.iloc[-1]
            self._firing.update((bool(hit[-1]), last["ts"].to_pydatetime(), float(last["value"])))
            out["state"] = ["firing" if h else "resolved" for h in hit[changed]]
            yield out[_COLUMNS]

    def close(self) -> None:
        pass


def transitions(evaluated: DataFrame) -> DataFrame:
    """Evaluated rules (name, stream, ts, breached, ...) to change events.

    A rule and stream see one row per window that closed, so a task call holds ticks, not entries.
    """
    return evaluated.groupBy("name", "stream").transformWithStateInPandas(
        Transitions(), outputStructType=EVENTS, outputMode="Append", timeMode="None")


def watch(entries: DataFrame, rules: Sequence[dict], stream_key: str | None = None,
          window_seconds: int = 300, slide_seconds: int = 60,
          delay: str = "10 minutes") -> DataFrame:
    """Entries to alert events: sliding statistics, rules, transitions.

    Each rule looks at its own ``window_seconds``; ``window_seconds`` here is for rules without one.
    """
    spark = entries.sparkSession
    run.use_rocksdb(spark)
    key = F.lit("") if stream_key is None else F.col(stream_key).cast("string")
    rows = entries.withColumn("stream", key)
    evaluated = None
    for w in sorted({int(r.get("window_seconds", window_seconds)) for r in rules}):
        mine = [r for r in rules if int(r.get("window_seconds", window_seconds)) == w]
        stats = sliding_stats(rows, ["stream"], w, min(w, slide_seconds), delay)
        ticked = stats.withColumn("ts", F.col("window.end"))
        part = alerts.evaluate(ticked, alerts.rules_frame(spark, mine), ["stream", "ts"])
        evaluated = part if evaluated is None else evaluated.unionByName(part)
    return transitions(evaluated)


def firing_now(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What fires now, read from the state of a running or stopped ``watch`` query: name, stream, ts and value at its start."""
    operators = spark.read.format("state-metadata").load(checkpoint)
    ours = operators.where(F.col("operatorProperties").contains('"stateName":"firing"')).select("operatorId").first()
    if ours is None:
        raise ValueError(f"{checkpoint}: not the checkpoint of an alert query")
    state = spark.read.format("statestore").option("operatorId", ours[0]).option("stateVarName", "firing").load(checkpoint)
    return state.where("value.firing").select("key.name", "key.stream", "value.ts", "value.value")
