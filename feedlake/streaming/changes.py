"""Stateful change detection and quota monitoring on streams (STR-08, STR-09).

Both are ``transformWithStateInPandas`` processors with one value of state a key, kept in
RocksDB: the last detour set of a route, the number of calls of an agency's day. Timers
take the state of keys that are done. A key's rows of a micro-batch reach its processor in
pieces; neither holds more of them than it needs (the polls of one route, the first calls
up to the quota).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from feedlake.functions.scalars import from_local
from feedlake.operators.monitor import DAILY_CALL_QUOTA
from feedlake.schema import DEFAULT_TZ
from feedlake.session import ensure_keyed_state

CHANGE_SCHEMA = "agency string, id string, day date, detours string, late boolean"
DAY_MS = 86_400_000
RETIRE_DAYS = 30


class DetourMemory(StatefulProcessor):
    """The last poll of a route: its day and its set."""

    def __init__(self, forget_after_days: int | None):
        self.forget = forget_after_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "day date, detours string, at_ms bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        parts = [p for p in rows if len(p)]
        if not parts:
            return
        known = self.last.exists()
        last_day, last_set, last_ms = self.last.get() if known else (None, None, None)
        polls, out = pd.concat(parts).sort_values("day", kind="stable"), []
        for day, detours, at_ms in zip(polls["day"], polls["detours"], polls["at_ms"]):
            if pd.isna(day):  # sorted behind the others, told against the last set; the state stays
                if last_day is None or detours != last_set:
                    out.append((*key, None, detours, False))
                continue
            if last_day is not None and day <= last_day:
                if detours != last_set:  # older than the last one seen: told apart, the state stays
                    out.append((*key, day, detours, True))
                continue
            gone = last_day is not None and self.forget is not None and (day - last_day).days > self.forget
            if last_day is None or gone or detours != last_set:
                out.append((*key, day, detours, False))
            last_day, last_set, last_ms = day, detours, int(at_ms)
        if last_day is not None:
            self.last.update((last_day, last_set, last_ms))
        if last_day is not None and not known:
            self.handle.registerTimer(last_ms)
        if out:
            yield pd.DataFrame(out, columns=["agency", "id", "day", "detours", "late"])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.last.exists():
            last_ms = self.last.get()[2]
            if last_ms > timerValues.getCurrentWatermarkInMs():
                self.handle.registerTimer(last_ms)  # polled since the timer was set
            else:
                self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def detour_changes(polls: DataFrame, forget_after_days: int | None = None, retire_days: int = RETIRE_DAYS) -> DataFrame:
    """Polls ``(agency, id, day, detours)`` -> the polls whose set changed (STR-08).

    A route seen for the first time counts as changed; a route that vanishes is not reported,
    and with ``forget_after_days`` one that comes back after a longer gap counts as changed
    whatever its set. A poll older than the last one seen whose set differs from it comes out
    with ``late`` true and leaves the state as it is, as does a poll without a day, which comes
    out if its set differs from the last one seen. The watermark runs ``retire_days``
    behind the newest poll: polls before it are left out, and the state of a route whose
    last poll it passes is dropped.
    """
    ensure_keyed_state(polls.sparkSession)
    at = F.col("day").cast("timestamp")
    timed = polls.select("agency", "id", "day", "detours", at.alias("poll_at"), F.unix_millis(at).alias("at_ms")) \
        .withWatermark("poll_at", f"{retire_days} days")
    return timed.groupBy("agency", "id").transformWithStateInPandas(
        DetourMemory(forget_after_days), CHANGE_SCHEMA, "append", "eventTime")


class QuotaWatch(StatefulProcessor):
    """Calls of an agency's day so far; tells the call that first exceeds the quota, once."""

    def __init__(self, limit: int, order: list[str], delay_ms: int):
        self.limit, self.order, self.delay_ms = limit, order, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.calls = handle.getValueState("calls", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        known = self.calls.exists()
        before = self.calls.get()[0] if known else 0
        room = self.limit - before  # calls still allowed; below 0 once the breach has been told
        total, first, end_ms = 0, None, None
        for part in rows:
            if not len(part):
                continue
            total += len(part)
            end_ms = part["end_ms"].iloc[0]
            if room >= 0:  # the first calls in time order, one more than the room
                first = part if first is None else pd.concat([first, part])
                first = first.sort_values(self.order, kind="stable").head(room + 1)
        if not total:
            return
        self.calls.update((before + total,))
        if not known and not pd.isna(end_ms):  # calls without a time are a day that does not end
            self.handle.registerTimer(int(end_ms) + self.delay_ms)
        if room >= 0 and total > room:
            call = first.iloc[[room]]
            yield pd.DataFrame({"agency": [key[0]], "day": [key[1]], "ts": call["ts"].to_numpy(), "call_id": call["call_id"].to_numpy(),
                                "quota": [self.limit]})

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.calls.clear()
        return iter(())

    def close(self) -> None:
        pass


def quota_breaches(stream: DataFrame, call_id: Column, limit: int = DAILY_CALL_QUOTA, delay_days: int = 2,
                   tz: str = DEFAULT_TZ) -> DataFrame:
    """One event for each agency and local day whose calls exceed the quota: the call that first did (STR-09).

    ``stream`` has ``agency``, ``ts`` and ``day``. Calls count in the order they arrive,
    within a micro-batch by (ts, call_id); the count is kept until the watermark, ``delay_days``
    behind the newest call, passes the day's end by as much again, and calls later than that
    are left out, so a day is told once however often the query is restarted.
    """
    ensure_keyed_state(stream.sparkSession)
    end = F.unix_millis(from_local(F.date_add("day", 1).cast("timestamp_ntz"), tz).cast("timestamp"))
    calls = stream.select("agency", "day", F.col("ts").cast("timestamp").alias("ts"), call_id.alias("call_id"), end.alias("end_ms"))
    id_type = dict(calls.dtypes)["call_id"]
    return calls.withWatermark("ts", f"{delay_days} days").groupBy("agency", "day").transformWithStateInPandas(
        QuotaWatch(limit, ["ts", "call_id"], delay_days * DAY_MS),
        f"agency string, day date, ts timestamp, call_id {id_type}, quota long", "append", "eventTime")


def daily_calls(stream: DataFrame) -> DataFrame:
    """Running call count per (agency, local day) (STR-09): exact, for ``complete`` output,
    with one state row per agency-day."""
    return stream.groupBy("agency", "day").agg(F.count(F.lit(1)).alias("calls"))


def append_call_counts(path: str):
    """``foreachBatch`` writer: each micro-batch's own counts are appended with its batch id.

    No state and no watermark, so a call counts however late it comes (STR-10); a replayed
    batch appends the same counts under the same id, which ``current_calls`` takes once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        daily_calls(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("append").parquet(path)
    return write


def current_calls(log: DataFrame) -> DataFrame:
    """Call count per (agency, day) from a log of batch counts, each batch counted once."""
    once = log.groupBy("agency", "day", "batch_id").agg(F.max("calls").alias("calls"))
    return once.groupBy("agency", "day").agg(F.sum("calls").alias("calls"))
