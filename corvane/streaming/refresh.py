"""Refreshing catalogs: budgets that pause a cursor, outcomes that stop a run, and plans of steps."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass
class Budget:
    """What one run may use. `calls` counts this run alone, `stored_bytes` what all runs together have fetched."""

    seconds: float = 3600.0
    calls: int = 1000
    stored_bytes: int = 1 << 30
    clock: Callable[[], float] = time.monotonic
    began: float = field(init=False)

    def __post_init__(self):
        self.began = self.clock()

    def spent(self, calls: int, stored_bytes: int) -> str | None:
        """What has run out: time, calls or bytes; None if nothing has."""
        if self.clock() - self.began > self.seconds:
            return "time"
        if calls >= self.calls:
            return "calls"
        return "bytes" if stored_bytes >= self.stored_bytes else None


def run_slices(slices: Iterable[tuple[str, str]], fetch: Callable[[str, str], int], budget: Budget, stored_bytes: int = 0) -> tuple[str | None, str | None, int]:
    """(next start, reason, bytes): fetches slices (start, end) in order until they end or the budget is spent.

    The cursor moves behind a slice only when it was fetched whole, so a paused run goes on with the first that was not;
    next start is None when all are done. `fetch` returns the bytes of a slice.
    """
    for calls, (start, end) in enumerate(slices):
        reason = budget.spent(calls, stored_bytes)
        if reason:
            return start, reason, stored_bytes
        stored_bytes += fetch(start, end)
    return None, None, stored_bytes


def affordable(candidates: DataFrame, order: list[Column], size: str, calls: int, stored_bytes: int) -> DataFrame:
    """The first candidates in order that fit into a number of calls and of bytes: the first beyond either ends the list.

    The limit comes before the running sum, so the window sees `calls` rows at most.
    """
    first = candidates.orderBy(*order).limit(calls)
    running = F.sum(size).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return first.withColumn("_sum", running).where(F.col("_sum") <= stored_bytes).drop("_sum")


# Answers after which a run stops, and such as are tried again.
STOPPING, RETRIED = (403, 429), (500, 502, 503, 504)


def until_stopped(outcomes: DataFrame, order: str) -> DataFrame:
    """Outcomes (key, order, code) up to and with the first that stops the run, with a state: done, failed, retry or stopped."""
    stop = outcomes.where(F.col("code").isin(*STOPPING)).agg(F.min(order).alias("_stop"))  # one row
    state = F.when(F.col("code").isin(*STOPPING), "stopped").when(F.col("code").isin(*RETRIED), "retry").when(F.col("code") == 200, "done").otherwise("failed")
    before = outcomes.crossJoin(F.broadcast(stop)).where(F.col("_stop").isNull() | (F.col(order) <= F.col("_stop")))
    return before.drop("_stop").withColumn("state", state)


def by_source(rows: DataFrame, sources: list[str], newest_first: tuple[str, ...] = ("linux-cna",), most: int | None = None) -> DataFrame:
    """Candidates (project, ord, advisory_id, in_pack) in the order of work: those of packs first, then by the order of the projects,
    the ids of some of them from the newest to the oldest, the others as they come; cut to `most`."""
    place = F.array_position(F.array(*(F.lit(s) for s in sources)), F.col("project"))
    newest = F.col("project").isin(*newest_first)
    ordered = rows.where(place > 0).orderBy(
        F.col("in_pack").desc(), place, F.when(newest, F.col("advisory_id")).desc(), F.when(~newest, F.col("ord")), "advisory_id"
    )
    return ordered if most is None else ordered.limit(most)


@dataclass
class Step:
    """A step of a plan: what it needs, what it does, whether the rest can go on without it."""

    name: str
    run: Callable[[], object]
    needs: tuple[str, ...] = ()
    optional: bool = False


def run_plan(steps: list[Step], skip: tuple[str, ...] = ()) -> dict[str, str]:
    """Runs steps in the order of their needs and gives the state of each: done, skipped, failed: <error> or blocked.

    Skipped steps count as done. A failed step blocks those that need it, unless it is optional; all others still run. A need
    that no step has, or a circle of them, is an error before anything runs.
    """
    known = {s.name: s for s in steps}
    order: list[Step] = []
    marks: dict[str, int] = {}

    def visit(name: str) -> None:
        if name not in known:
            raise ValueError(f"no step is called {name}")
        if marks.get(name) == 1:
            raise ValueError(f"the steps need each other in a circle at {name}")
        if name not in marks:
            marks[name] = 1
            for need in known[name].needs:
                visit(need)
            marks[name] = 2
            order.append(known[name])

    for step in steps:
        visit(step.name)
    states: dict[str, str] = {}
    for step in order:
        if step.name in skip:
            states[step.name] = "skipped"
        elif any(states[n] not in ("done", "skipped") and not known[n].optional for n in step.needs):
            states[step.name] = "blocked"
        else:
            try:
                step.run()
                states[step.name] = "done"
            except Exception as error:  # the state tells; what needs it is blocked
                states[step.name] = f"failed: {error}"
    return states
