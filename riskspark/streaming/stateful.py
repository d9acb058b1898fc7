"""Keyed state that lives as long as its stream.

Such streams need the RocksDB state store, which keeps state outside the JVM heap and saves only
what a batch changed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside use the RocksDB state store, as ``transformWithState`` asks for."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


class InOrder(StatefulProcessor):
    """Hands a key's rows on in the order of event time, whatever order they arrive in.

    A row waits until the watermark has passed it, so no earlier one can follow. Subclasses say what a
    row does and what the mere passing of time does; between two rows a timer wakes the key at the
    next moment at which time alone matters. A key holds its waiting rows, bounded by the
    watermark's delay, and four values.
    """

    STATE = "waiting array<struct<at:bigint,on:boolean>>, since bigint, last bigint, raised boolean, timer bigint"
    #: Of output rows, after the key's columns. Times are in microseconds.
    OUTPUT = {"state": T.StringType(), "at": T.LongType(), "since": T.LongType()}

    by: Sequence[str] = ()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("state", self.STATE)
        self._out = Row(*self.by, *self.OUTPUT)
        self.since: int | None = None
        self.last: int | None = None
        self.raised = False

    def row(self, at: int, on: bool) -> Iterator[tuple[str, int, int]]:
        raise NotImplementedError

    def passed(self, until: int) -> Iterator[tuple[str, int, int]]:
        """What happens up to ``until`` although no row came."""
        raise NotImplementedError

    def deadline(self) -> int | None:
        """From when on ``passed`` has something to say."""
        raise NotImplementedError

    def _load(self) -> tuple[list[tuple[int, bool]], int | None]:
        found = self._state.get() if self._state.exists() else (None, None, None, False, None)
        waiting, self.since, self.last, self.raised, timer = found
        return [(w[0], w[1]) for w in waiting or []], timer

    def _save(self, waiting: list[tuple[int, bool]], timer: int | None) -> None:
        times = [at for at, _ in waiting]
        due = self.deadline()
        if due is not None:
            times.append(due)
        wanted = -(-min(times) // 1000) if times else None
        if wanted != timer:
            if timer is not None:
                self._handle.deleteTimer(timer)
            if wanted is not None:
                self._handle.registerTimer(wanted)
        self._state.update((waiting, self.since, self.last, self.raised, wanted))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [(r["_at"], r["_on"]) for r in rows if r["_on"] is not None]
        if new:
            waiting, timer = self._load()
            self._save(waiting + new, timer)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        waiting, _ = self._load()
        now = timerValues.getCurrentWatermarkInMs() * 1000
        out = []
        for at, on in sorted(w for w in waiting if w[0] <= now):
            out += self.passed(at)
            out += self.row(at, on)
        out += self.passed(now)
        # The timer that has just gone off is gone by itself.
        self._save([w for w in waiting if w[0] > now], None)
        for state, at, since in out:
            yield self._out(*key, state, at, since)

    def close(self) -> None:
        pass


class HeldAlerts(InOrder):
    """pending, then firing once the condition has held for ``hold``, then resolved or dropped.

    A spell ends when the condition fails or no row comes for longer than ``step``.
    """

    def __init__(self, hold: int, step: int) -> None:
        self.hold, self.step = hold, step

    def _end(self) -> Iterator[tuple[str, int, int]]:
        if self.since is not None:
            yield "resolved" if self.raised else "dropped", self.last, self.since
        self.since = self.last = None
        self.raised = False

    def row(self, at, on):
        if not on:
            yield from self._end()
            return
        if self.since is None:
            self.since = at
            yield "pending", at, at
        self.last = at
        if not self.raised and at - self.since >= self.hold:
            self.raised = True
            yield "firing", self.since + self.hold, self.since

    def passed(self, until):
        if self.since is not None and until - self.last > self.step:
            yield from self._end()

    def deadline(self):
        return None if self.since is None else self.last + self.step + 1


class Watchdog(InOrder):
    """silent once nothing has come for longer than ``limit``, back with the next row."""

    def __init__(self, limit: int) -> None:
        self.limit = limit

    def row(self, at, on):
        if self.raised:
            yield "back", at, self.last
        self.last, self.raised = at, False

    def passed(self, until):
        if self.last is not None and not self.raised and until - self.last > self.limit:
            self.raised = True
            yield "silent", self.last + self.limit, self.last

    def deadline(self):
        return None if self.last is None or self.raised else self.last + self.limit + 1


def _states(series: DataFrame, on: Column, ts: str, by: Sequence[str], late: str, machine: InOrder) -> DataFrame:
    keyed = series.withWatermark(ts, late).select(
        *by, F.col(ts), F.unix_micros(F.col(ts)).alias("_at"), on.alias("_on")
    )
    machine.by = list(by)
    out = T.StructType([series.schema[c] for c in by] + [T.StructField(c, kind) for c, kind in InOrder.OUTPUT.items()])
    found = keyed.groupBy(*by).transformWithState(machine, out, outputMode="Append", timeMode="EventTime")
    return found.select(
        *by, "state", F.timestamp_micros("at").alias("at"), F.timestamp_micros("since").alias("since")
    )


def held_alerts_stream(
    series: DataFrame,
    condition: Column,
    hold_seconds: int,
    step_seconds: int,
    by: Sequence[str],
    ts: str = "window_start",
    late: str = "0 seconds",
) -> DataFrame:
    """(by..., state, at, since): every change of state of every alert, as the watermark passes it.

    One key per series. A row whose condition is NULL says only how late it is, and so closes and
    fires the alerts of all other series.
    """
    machine = HeldAlerts(hold_seconds * 1_000_000, step_seconds * 1_000_000)
    return _states(series, condition, ts, by, late, machine)


def watchdog_stream(
    reports: DataFrame,
    limit_seconds: int,
    by: Sequence[str],
    ts: str = "generated_at",
    late: str = "0 seconds",
    tick: Column | None = None,
) -> DataFrame:
    """(by..., state, at, since): series that fell silent for longer than the limit, and came back.

    Rows for which ``tick`` holds are no reports, they say only how late it is.
    """
    on = F.lit(True) if tick is None else F.when(~tick, True)
    return _states(reports, on, ts, by, late, Watchdog(limit_seconds * 1_000_000))


def spells(states: DataFrame, by: Sequence[str], began: str, ended: str) -> DataFrame:
    """(by..., since, began, ended): one row per spell that reached ``began``; open ones have no end."""

    def at(state: str) -> Column:
        return F.max(F.when(F.col("state") == state, F.col("at")))

    found = states.groupBy(*by, "since").agg(at(began).alias("began"), at(ended).alias("ended"))
    return found.where(F.col("began").isNotNull())
