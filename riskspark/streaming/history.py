"""As-of history that grows while the stream runs."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskspark.functions import day
from riskspark.schema import ROLES, Roles

_DAY_MS = 86_400_000


class GrowingHistory(StatefulProcessor):
    """Per entity the outcomes of each day; answers requests with those of earlier days.

    Days that the watermark has passed can only be asked for as a whole and are folded into
    one total, so an entity holds as many days as the watermark is behind, not its whole past.
    Days of the calendar count from 1970. With ``forget_days`` an entity without rows for so long is dropped.
    """

    STATE = "closed_n bigint, closed_k bigint, days array<struct<day:int,n:bigint,k:bigint>>, latest int"

    def __init__(self, columns: list[str], forget_days: int | None = None) -> None:
        self.columns, self.forget_days = columns, forget_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("outcomes", self.STATE)
        self._out = Row(*self.columns, "_n", "_k")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        found = self._state.get() if self._state.exists() else None
        closed_n, closed_k, days, latest = found or (0, 0, [], None)
        by_day = {d[0]: [d[1], d[2]] for d in days}
        asked, changed = [], False
        for r in rows:
            if r["_n"] is None:
                asked.append(r)
            else:
                own = by_day.setdefault(r["_day"], [0, 0])
                own[0] += r["_n"]
                own[1] += r["_k"]
                latest = r["_day"] if latest is None else max(latest, r["_day"])
                changed = True
        # Outcomes of the batch count whatever place they have in it, as far as their day is earlier.
        for r in asked:
            n, k = closed_n, closed_k
            for d, own in by_day.items():
                if d < r["_day"]:
                    n, k = n + own[0], k + own[1]
            yield self._out(*[r[c] for c in self.columns], n, k)
        if changed:
            passed = timerValues.getCurrentWatermarkInMs() // _DAY_MS
            for d in [d for d in by_day if d < passed]:
                n, k = by_day.pop(d)
                closed_n, closed_k = closed_n + n, closed_k + k
            self._state.update((closed_n, closed_k, [(d, *own) for d, own in sorted(by_day.items())], latest))
            if self.forget_days is not None:
                self._handle.registerTimer((latest + self.forget_days) * _DAY_MS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        latest = self._state.get()[3] if self._state.exists() else None
        if latest is not None and (latest + self.forget_days) * _DAY_MS <= timerValues.getCurrentWatermarkInMs():
            self._state.clear()
        return iter(())

    def close(self) -> None:
        pass


def history_stream(
    outcomes: DataFrame,
    requests: DataFrame,
    target: str = "target",
    roles: Roles = ROLES,
    late: str = "1 day",
    forget_days: int | None = None,
) -> DataFrame:
    """The requests with ``previous_appointments`` and ``previous_miss_rate`` as known at their day.

    Every outcome that has come in by the request's micro-batch counts if its day is strictly
    earlier; where both streams run in the order of days this equals ``asof_history`` over all
    outcomes. Rows later than ``late`` behind the newest are dropped with the watermark. Outcomes
    without entity, day or label are no history; requests without entity or day have none.

    The rows of one entity in one micro-batch meet in one task; the size of micro-batches bounds that.
    """
    kept = [f for f in requests.schema.fields]

    def passed_on(f: T.StructField):
        # As numbers, so that no time zone of a Python worker has a say.
        column = F.col(f"`{f.name}`")
        return (F.unix_micros(column) if isinstance(f.dataType, T.TimestampType) else column).alias(f"c_{f.name}")

    numbers = [
        T.StructField(f"c_{f.name}", T.LongType() if isinstance(f.dataType, T.TimestampType) else f.dataType)
        for f in kept
    ]
    kind = requests.schema[roles.entity].dataType
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in numbers]
    known = F.col(roles.outcome_at).isNotNull() & F.col(target).isNotNull() & F.col(roles.entity).isNotNull()
    told = outcomes.where(known).select(
        F.col(roles.entity).cast(kind).alias("_entity"),
        F.col(roles.outcome_at).cast("timestamp").alias("_at"),
        F.unix_date(day(F.col(roles.outcome_at))).alias("_day"),
        F.lit(1).cast("long").alias("_n"),
        F.col(target).cast("long").alias("_k"),
        *none,
    )
    askable = F.col(roles.entity).isNotNull() & F.col(roles.known_at).isNotNull()
    asked = requests.where(askable).select(
        F.col(roles.entity).alias("_entity"),
        F.col(roles.known_at).cast("timestamp").alias("_at"),
        F.unix_date(day(F.col(roles.known_at))).alias("_day"),
        F.lit(None).cast("long").alias("_n"),
        F.lit(None).cast("long").alias("_k"),
        *[passed_on(f) for f in kept],
    )
    rows = told.unionByName(asked).withWatermark("_at", late)
    out = T.StructType([*numbers, T.StructField("_n", T.LongType()), T.StructField("_k", T.LongType())])
    found = rows.groupBy("_entity").transformWithState(
        GrowingHistory([f.name for f in numbers], forget_days), out, outputMode="Append", timeMode="EventTime"
    )

    def restored(f: T.StructField):
        column = F.col(f"`c_{f.name}`")
        return (F.timestamp_micros(column) if isinstance(f.dataType, T.TimestampType) else column).alias(f.name)

    known = found.select(
        *[restored(f) for f in kept],
        F.col("_n").cast("double").alias("previous_appointments"),
        F.when(F.col("_n") == 0, 0.0).otherwise(F.col("_k") / F.col("_n")).alias("previous_miss_rate"),
    )
    # NULL keys need no state, and would all meet in one task.
    zero = F.lit(0.0)
    return known.unionByName(
        requests.where(~askable).withColumns({"previous_appointments": zero, "previous_miss_rate": zero})
    )
