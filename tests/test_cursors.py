"""Cursors as keyed state: the fold of answers, rests and reopenings, resumed streams."""

import datetime as dt

import pytest

from corvane.streaming import cursors
from corvane.streaming.cursors import HOUR, Policy, answered, opened, wake

POLICY = Policy(days=100, slice_days=60, calls=3, rest=5 * HOUR, stopped=24 * HOUR, retry=HOUR, reopen_after=48 * HOUR, reopen_days=100)


def test_answers_move_rest_and_complete():
    state = opened(POLICY)
    answered(state, 0, 200, 4, POLICY)
    assert (state["cursor"], state["entries"], state["requests"]) == (60, 4, 1)
    answered(state, HOUR, 503, 9, POLICY)  # tried again an hour later
    answered(state, 2 * HOUR - 1, 200, 9, POLICY)
    assert (state["skipped"], state["errors"], state["cursor"]) == (1, 1, 60)
    answered(state, 2 * HOUR, 404, 9, POLICY)  # the rest is over and began a run of its own
    assert (state["calls"], state["errors"], state["rests_until"]) == (1, 2, -1)
    answered(state, 2 * HOUR, 200, 1, POLICY)
    assert state["complete"] == 1 and state["reopens_at"] == 50 * HOUR
    answered(state, 3 * HOUR, 200, 1, POLICY)
    assert state["skipped"] == 2 and wake(state, 49 * HOUR, POLICY) is None
    assert wake(state, 50 * HOUR, POLICY) == "reopened" and state["stop"] == 200
    for at in (51, 52, 53, 54):
        answered(state, at * HOUR, 404, 0, POLICY)
    assert state["rests_until"] == 58 * HOUR and state["skipped"] == 3  # three calls make a run
    answered(state, 58 * HOUR, 403, 0, POLICY)
    assert state["rests_until"] == 82 * HOUR and state["seen"] == 11


def at(hours: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


ANSWERS = "project string, at timestamp, id long, code int, entries long"


@pytest.fixture(scope="module")
def arrivals():
    first = [("a", at(k), k, 200 if k % 3 else 503, 2) for k in range(8)] + [("b", at(2), 100, 403, 1)]
    second = [("a", at(20 + k), 20 + k, 404, 1) for k in range(5)] + [("c", at(21), 300, 200, 7)]
    third = [("c", at(90 + k), 400 + k, 200, 1) for k in range(4)]
    return [first, second, third]


def expected(arrivals):
    states = {}
    for project, when, _, code, entries in sorted((r for part in arrivals for r in part), key=lambda r: (r[1], r[2])):
        answered(states.setdefault(project, opened(POLICY)), int((when - dt.datetime(1970, 1, 1)).total_seconds() * 1000), code, entries, POLICY)
    return {p: cursors.row_of(p, "answers", s, POLICY) for p, s in states.items()}


def test_a_killed_stream_goes_on_like_one_run(spark, tmp_path, arrivals):
    source, folder = str(tmp_path / "answers"), str(tmp_path / "state")
    stream = lambda: spark.readStream.schema(ANSWERS).parquet(source)
    for number, part in enumerate(arrivals):
        spark.createDataFrame(part, ANSWERS).repartition(2).write.mode("append").parquet(source)
        if number == 1:
            cursors.run_available(stream(), POLICY, folder, wait=False).stop()  # killed as it starts, whatever it has done
        cursors.run_available(stream(), POLICY, folder)
    rows = spark.read.schema(cursors.OUTPUT).parquet(f"{folder}/rows")
    got = {r.project: r.asDict() for r in cursors.newest(rows).collect()}
    assert got == expected(arrivals)
    events = {(r.project, r.event) for r in rows.where("event <> 'answers'").collect()}
    assert {("a", "resumed"), ("b", "resumed")} & events and all(e in ("resumed", "reopened") for _, e in events)
