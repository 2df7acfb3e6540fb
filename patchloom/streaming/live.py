"""Following results as they arrive. Each operator gives the batch result on the same rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from patchloom.functions.rewards import FORMAT_WEIGHT, TEST_WEIGHT, log_passed
from patchloom.operators.scans import running
from patchloom.operators.scoring import KEY, add_reward, add_test_reward, fold_logs, score, with_patch
from patchloom.operators.tasks import REWARD_GUARD, RUN_LIMITS
from patchloom.session import materialize

# Seconds a completion waits for its harness log: the run's limit and its outer guard.
LOG_WAIT = RUN_LIMITS["reward"] + REWARD_GUARD


def event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Give rows an event time with a watermark; times without a zone are read as UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def score_stream(
    completions: DataFrame,
    outcomes: DataFrame,
    mode: str = "hybrid",
    *,
    ts: str = "ts",
    wait: float = LOG_WAIT,
    delay: str = "10 minutes",
    on: Sequence[str] = KEY,
    stdlib_only: bool = False,
    strip_globals: bool = False,
    has_task: Column | None = None,
    w_f: float = FORMAT_WEIGHT,
    w_t: float = TEST_WEIGHT,
) -> DataFrame:
    """Score arriving completions against harness logs: one row per completion, in append mode.

    With logs that arrive as a stream too, a completion waits for its log: one that comes
    within ``wait`` seconds of event time counts, in whatever trigger it arrives, and the
    format's fallback is given only when the watermark has passed that time. A log of a pass
    scores at once; without one, a log of a failure counts when no pass can come any more, so
    repeated logs give what the table form gives. Completions whose score needs no log (no
    patch, a forbidden import) don't wait. Both sides need the event time ``ts``; rows later
    than ``delay`` are left out.

    A table of logs is folded to one row per completion and written once, when the stream is
    set up, so a trigger joins without an aggregate. Such a table doesn't grow: logs that come
    later belong on a stream.
    """
    checks = {"stdlib_only": stdlib_only, "strip_globals": strip_globals}
    options = {"on": on, "has_task": has_task, "w_f": w_f, "w_t": w_t, **checks}
    if mode == "format" or not completions.isStreaming:
        return score(completions, outcomes, mode, **options)
    if not outcomes.isStreaming:
        return score(completions, materialize(fold_logs(outcomes, on)), mode, folded=True, **options)

    waiting = event_time(with_patch(completions, **checks), ts, delay)
    logs = event_time(outcomes.select(*on, ts, log_passed(F.col("stdout")).alias("_pass")), ts, delay)
    needs_log = F.col("has_patch") & F.col("imports_allowed")

    def with_log(rows: DataFrame, passes: bool, needed: Column) -> DataFrame:
        """Join one log of a kind per completion; rows that need none go on at once."""
        found = logs.where(F.col("_pass") if passes else ~F.col("_pass")).dropDuplicatesWithinWatermark(list(on))
        found = found.select(*[F.col(k).alias(f"_log_{k}") for k in on], F.col(ts).alias("_log_ts"))
        in_time = F.col("_log_ts").between(F.col(ts), F.col(ts) + F.expr(f"INTERVAL '{float(wait)}' SECOND"))
        same = reduce(and_, [F.col(k) == F.col(f"_log_{k}") for k in on])
        joined = rows.join(found, same & in_time & needed, "left")
        return joined.select(*rows.columns, F.col("_log_ts").isNotNull().alias("_has_pass" if passes else "_has_failure"))

    first = with_log(waiting, True, needs_log)
    both = with_log(first, False, needs_log & ~F.col("_has_pass"))
    passed = F.when(F.col("_has_pass"), True).when(F.col("_has_failure"), False)
    scored = add_test_reward(both.withColumn("passed", passed).drop("_has_pass", "_has_failure"), has_task)
    return add_reward(scored, mode, w_f=w_f, w_t=w_t)


def live_rates(
    rows: DataFrame,
    hit: Column,
    *,
    ts: str = "ts",
    width: str = "1 day",
    delay: str = "1 hour",
    by: Sequence[str] = (),
) -> DataFrame:
    """Share of rows with ``hit`` per tumbling window; rows later than ``delay`` are left out."""
    timed = event_time(rows.withColumn("_hit", F.coalesce(hit, F.lit(False))), ts, delay)
    counts = timed.groupBy(F.window(ts, width), *by).agg(
        F.count("*").alias("total"), F.count_if("_hit").alias("hits")
    )
    return counts.select(
        F.col("window.start").alias("start"),
        F.col("window.end").alias("end"),
        *by,
        "total",
        "hits",
        (F.col("hits") / F.col("total")).alias("rate"),
    )


def dedupe_results(results: DataFrame, key: Sequence[str], *, ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Count a repeated report of one run once: a stream's repeats within the delay, a table's all.

    Of differing repeats a table keeps the earliest, then the least by all other columns in
    turn, whatever the layout; a stream keeps the one it meets first.
    """
    timed = event_time(results, ts, delay)
    if results.isStreaming:
        return timed.dropDuplicatesWithinWatermark(list(key))
    # a null time is no time: such a report stands behind all others
    order = [F.col(ts).isNull().alias("_untimed"), F.col(ts), *[F.col(c) for c in timed.columns if c != ts]]
    return timed.groupBy(*key).agg(F.min(F.struct(*order)).alias("_first")).select(*[f"_first.{c}" for c in timed.columns])


def idle_sessions(
    events: DataFrame, by: Sequence[str], *, ts: str = "ts", gap: str = "30 minutes", delay: str = "1 hour"
) -> DataFrame:
    """Agent sessions: a pause longer than ``gap`` ends one.

    A stream keeps one state per open session. A table is numbered over ranges of (agent, time)
    instead of sorted per agent, so an agent, or an hour, with most of the events is no hot spot.
    """
    timed = event_time(events, ts, delay)
    if events.isStreaming:
        groups = timed.groupBy(*by, F.session_window(ts, gap).alias("_session"))
    else:
        rows = timed.select(*by, ts)
        seen = running(rows, by, [ts], None, {"_last": ("max", F.col(ts))}, inclusive=False, keep="_block")
        paused = F.col("_last").isNull() | (F.col(ts) > F.col("_last") + F.expr(f"INTERVAL {gap}"))
        starts = seen.withColumn("_start", F.when(paused, 1).otherwise(0)).drop("_last")
        order = [ts, F.col("_start").desc()]  # of two events at one time, the start goes first
        numbered = running(starts, by, order, "_block", {"_session": ("sum", F.col("_start"))}, dealt=True)
        groups = numbered.groupBy(*by, "_session")
    counts = groups.agg(
        F.count("*").alias("events"), F.min(ts).alias("first_event"), F.max(ts).alias("last_event")
    )
    return counts.drop("_session")


class _StopState(StatefulProcessor):
    """Early stopping of one run: best loss, idle evaluations, last step.

    With event times, evaluations wait in a map by step until the watermark has passed them
    and are then taken in step order; a run's state goes when nothing came for ``timeout``.
    Without, the evaluations of a trigger are taken in step order.
    """

    def __init__(self, run: str, patience: int, threshold: float, timeout_ms: int, timed: bool):
        self.run, self.patience, self.threshold = run, patience, threshold
        self.timeout_ms, self.timed = timeout_ms, timed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        fields = "best double, idle bigint, last bigint, stopped boolean, latest bigint"
        self.progress = handle.getValueState("progress", fields)
        if self.timed:
            self.waiting = handle.getMapState("waiting", "step bigint", "at bigint, loss double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best, idle, last, stopped, latest = self.progress.get() if self.progress.exists() else (None, 0, None, False, None)
        taken, earliest = [], None
        for part in rows:
            for step, loss, at in zip(part["step"].tolist(), part["loss"].tolist(), part["at"].tolist()):
                if stopped or (last is not None and step <= last):
                    continue  # a repeat of one already taken, or the run is over
                if not self.timed:
                    taken.append((step, loss))
                elif not self.waiting.containsKey((step,)):
                    self.waiting.updateValue((step,), (int(at), loss))
                    latest = at if latest is None else max(latest, at)
                    earliest = at if earliest is None else min(earliest, at)
        self.progress.update((best, idle, last, stopped, None if latest is None else int(latest)))
        if earliest is not None:
            self.handle.registerTimer(int(earliest))
        yield from self._take(key, taken)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.progress.exists():
            return
        now = timerValues.getCurrentWatermarkInMs()
        held = [(step[0], at, loss) for step, (at, loss) in self.waiting.iterator()]
        ready = [(step, loss) for step, at, loss in held if at <= now]
        for step, _ in ready:
            self.waiting.removeKey((step,))
        yield from self._take(key, ready)
        latest = self.progress.get()[4]
        if len(ready) < len(held):
            self.handle.registerTimer(min(at for _, at, _ in held if at > now))
        elif now >= latest + self.timeout_ms:
            self.progress.clear()
            self.waiting.clear()
        else:
            self.handle.registerTimer(latest + self.timeout_ms)

    def _take(self, key, evaluations: list[tuple]) -> Iterator[pd.DataFrame]:
        """Fold evaluations in step order into the progress; emit the step a run stops at."""
        best, idle, last, stopped, latest = self.progress.get()
        for step, value in sorted(evaluations, key=lambda e: e[0]):
            if stopped or (last is not None and step <= last):
                continue
            last = step
            good = value is not None and abs(value) < float("inf")  # false for NaN too
            idle = 0 if good and (best is None or value < best - self.threshold) else idle + 1
            if good and (best is None or value < best):
                best = value
            if idle >= self.patience:
                stopped = True
                yield pd.DataFrame({self.run: [key[0]], "stop_step": [step]})
        self.progress.update((best, idle, last, stopped, latest))
        if stopped and self.timed:
            self.waiting.clear()

    def close(self) -> None:
        pass


def live_early_stop(
    metrics: DataFrame,
    patience: int,
    threshold: float = 0.0,
    *,
    run: str = "trial",
    step: str = "step",
    loss: str = "eval_loss",
    ts: str | None = None,
    delay: str = "10 minutes",
    timeout: float = 86_400,
) -> DataFrame:
    """Early stopping with one small state per run. Emits a run once, when it stops.

    With an event time ``ts``, evaluations may arrive out of order, repeated and in any
    trigger, up to ``delay`` late: they wait until the watermark has passed them and are taken
    in step order, which must be their order in time. Without, they must arrive in step order
    from trigger to trigger, and a step at or before one already seen is skipped. With ``ts`` a
    run is forgotten when it has sent nothing for ``timeout`` seconds of event time; without, its
    few numbers stay. Evaluations without a step are left out. What a task holds is one
    trigger's share of a run, bounded by the source's rate limit, and what waits for the watermark.
    """
    run_type = metrics.schema[run].dataType.simpleString()
    timed = metrics if ts is None else event_time(metrics, ts, delay).where(F.col(ts).isNotNull())
    at = F.lit(0).cast("bigint") if ts is None else F.unix_millis(ts)
    slim = timed.where(F.col(step).isNotNull()).select(
        run,
        F.col(step).cast("bigint").alias("step"),
        F.col(loss).cast("double").alias("loss"),
        at.alias("at"),
        *([] if ts is None else [ts]),
    )
    state = _StopState(run, patience, threshold, int(timeout * 1000), ts is not None)
    mode = "None" if ts is None else "EventTime"
    return slim.groupBy(run).transformWithStateInPandas(state, f"`{run}` {run_type}, stop_step bigint", "append", mode)


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """Where a stream keeps its progress: a folder of its own in the shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a shared folder, or pass a checkpoint location")
    return f"{base.rstrip('/')}/{name}"


def start_files(
    df: DataFrame, name: str, path: str, *, checkpoint: str | None = None, available_now: bool = False
) -> StreamingQuery:
    """Append a stream to a Parquet folder, surviving restarts through its checkpoint."""
    writer = df.writeStream.queryName(name).outputMode("append").format("parquet").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint or checkpoint_location(df.sparkSession, name))
    return (writer.trigger(availableNow=True) if available_now else writer).start()
