"""Refreshing many catalogs as one stream: a cursor per project as keyed state, timers for what waits.

The stream carries the answers to requests (project, at, id, code, entries). Each project has a cursor in a window of slices.
An answer of 200 moves it behind one slice; some codes stop a project for a while, others are tried again sooner, and after
`calls` requests a run is over and the project rests. What is answered while a project rests or is complete is counted as
skipped. A complete project opens again, for a longer window, some time after it ended. Rests and reopenings take effect with
the first answer behind their time or, where none comes, by an event-time timer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from corvane.streaming.refresh import RETRIED, STOPPING

HOUR = 3_600_000
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Policy:
    """Days since the window's start are counted from 0; times are milliseconds."""

    start: str = "2020-01-01"
    days: int = 400
    slice_days: int = 90
    calls: int = 6
    rest: int = 12 * HOUR
    stopped: int = 24 * HOUR
    retry: int = 2 * HOUR
    reopen_after: int = 96 * HOUR
    reopen_days: int = 180


#: Columns of a project's state, all longs; -1 where a time is not set.
STATE = ("seen", "cursor", "stop", "complete", "rests_until", "reopens_at", "calls", "requests", "skipped", "entries", "errors")
STATE_SCHEMA = ", ".join(f"{c} long" for c in STATE)
OUTPUT = "project string, event string, seen long, status string, cursor string, requests long, skipped long, entries long, errors long"


def opened(policy: Policy) -> dict[str, int]:
    return dict.fromkeys(STATE, 0) | {"stop": policy.days, "rests_until": -1, "reopens_at": -1}


def wake(state: dict[str, int], now: int, policy: Policy) -> str | None:
    """Ends a rest, or opens a complete window again, if its time has come; what happened."""
    if state["complete"] and 0 <= state["reopens_at"] <= now:
        state.update(complete=0, reopens_at=-1, stop=state["stop"] + policy.reopen_days, calls=0, rests_until=-1)
        return "reopened"
    if 0 <= state["rests_until"] <= now:
        state.update(rests_until=-1, calls=0)
        return "resumed"
    return None


def answered(state: dict[str, int], at: int, code: int, entries: int, policy: Policy) -> None:
    """Takes one answer into the state."""
    wake(state, at, policy)
    state["seen"] += 1
    if state["complete"] or state["rests_until"] >= 0:
        state["skipped"] += 1
        return
    state["requests"] += 1
    state["calls"] += 1
    if code == 200:
        state["entries"] += entries
        state["cursor"] += policy.slice_days
        if state["cursor"] > state["stop"]:
            state.update(complete=1, reopens_at=at + policy.reopen_after)
            return
    else:
        state["errors"] += 1
    if code in STOPPING:
        state["rests_until"] = at + policy.stopped
    elif code in RETRIED:
        state["rests_until"] = at + policy.retry
    elif state["calls"] >= policy.calls:
        state["rests_until"] = at + policy.rest


def row_of(project: str, event: str, state: dict[str, int], policy: Policy) -> dict[str, object]:
    status = "COMPLETE" if state["complete"] else "CURSOR_PAUSED" if state["rests_until"] >= 0 else "OPEN"
    cursor = (pd.Timestamp(policy.start) + pd.Timedelta(days=state["cursor"])).strftime("%Y-%m-%d")
    return {"project": project, "event": event, "status": status, "cursor": cursor} | {c: state[c] for c in ("seen", "requests", "skipped", "entries", "errors")}


class Cursors(StatefulProcessor):
    """One row per project and batch with answers, and one for each rest or reopening that a timer ends."""

    def __init__(self, policy: Policy):
        self.policy = policy

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("cursor", STATE_SCHEMA)

    def _read(self) -> dict[str, int]:
        return dict(zip(STATE, map(int, self.value.get()), strict=True)) if self.value.exists() else opened(self.policy)

    def _write(self, state: dict[str, int]) -> None:
        """Keeps the state and one timer, that of its next change."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if (due := state["reopens_at"] if state["complete"] else state["rests_until"]) >= 0:
            self.handle.registerTimer(due)
        self.value.update(tuple(state[c] for c in STATE))

    def _frame(self, row: dict[str, object]) -> pd.DataFrame:
        return pd.DataFrame([row])[[c.split()[0] for c in OUTPUT.split(", ")]]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self._read()
        batch = pd.concat(list(rows)).sort_values(["at", "id"])
        for at, code, entries in zip((batch["at"].astype("datetime64[ms]").astype("int64")), batch["code"], batch["entries"], strict=True):
            answered(state, int(at), int(code), int(entries), self.policy)
        self._write(state)
        yield self._frame(row_of(key[0], "answers", state, self.policy))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self._read()
        event = wake(state, expiredTimerInfo.getExpiryTimeInMs(), self.policy)
        self._write(state)
        if event:
            yield self._frame(row_of(key[0], event, state, self.policy))

    def close(self) -> None:
        pass


def follow(answers: DataFrame, policy: Policy, late: str = "0 seconds") -> DataFrame:
    """Rows of OUTPUT from a stream of (project, at, id, code, entries), whose order inside a batch does not matter.

    Answers that come later than `late` behind the latest one of an earlier batch are dropped by the watermark.
    """
    grouped = answers.select("project", "at", "id", "code", "entries").withWatermark("at", late).groupBy("project")
    return grouped.transformWithStateInPandas(Cursors(policy), OUTPUT, "Append", "EventTime")


def run_available(answers: DataFrame, policy: Policy, folder: str, late: str = "0 seconds", wait: bool = True) -> StreamingQuery:
    """Takes what the source has into the Parquet rows of `<folder>/rows`; a later run, or one after a failure, goes on behind it."""
    spark, key = answers.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, PROVIDER)  # a query keeps the one that it starts with
    try:
        writer = follow(answers, policy, late).writeStream.outputMode("append").format("parquet").trigger(availableNow=True)
        query = writer.option("checkpointLocation", f"{folder}/checkpoint").start(f"{folder}/rows")
        if wait:
            query.awaitTermination()
    finally:
        spark.conf.set(key, before)
    return query


def newest(rows: DataFrame) -> DataFrame:
    """The state of each project after its last answer."""
    names = [c for c in rows.columns if c != "project"]
    return rows.where("event = 'answers'").groupBy("project").agg(F.max_by(F.struct(*names), "seen").alias("s")).select("project", "s.*")
