"""Incremental loads: windows with cursors, upserts, histories, and their streaming forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def window_slices(state: DataFrame, days: int = 90) -> DataFrame:
    """(id, slice_start, slice_stop): what an index (id, start, stop, cursor) still has to load, in slices of `days`."""
    begin = F.coalesce(F.date_add(F.to_date("cursor"), 1), F.to_date("start"))
    starts = F.when(begin <= F.to_date("stop"), F.sequence(begin, F.to_date("stop"), F.expr(f"interval {days} days")))
    return state.select("id", "stop", F.explode(starts).alias("slice_start")).select(
        "id", "slice_start", F.least(F.date_add("slice_start", days - 1), F.to_date("stop")).alias("slice_stop")
    )


def reopened(state: DataFrame, today: str) -> DataFrame:
    """Closed windows that end before today open again from the day after; future ends are an error."""
    ends = F.to_date("stop")
    checked = F.when(ends > F.lit(today).cast("date"), F.raise_error("a window ends in the future")).otherwise(ends)
    gap = (F.col("status") == "COMPLETE") & (checked < F.lit(today).cast("date"))
    return state.withColumns({
        "start": F.when(gap, F.date_format(F.date_add(ends, 1), "yyyy-MM-dd")).otherwise(F.col("start")),
        "stop": F.when(gap, F.lit(today)).otherwise(F.col("stop")),
        "cursor": F.when(gap, None).otherwise(F.col("cursor")),
        "status": F.when(gap, "CURSOR_PAUSED").otherwise(F.col("status")),
    })


def upsert(stored: DataFrame, fresh: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, that of the greatest order; of equal ones the fresh row."""
    columns = [c for c in stored.columns if c != key]
    both = stored.withColumn("_fresh", F.lit(0)).unionByName(fresh.withColumn("_fresh", F.lit(1)))
    newest = F.max_by(F.struct(*columns), F.struct(order, "_fresh"))
    return both.groupBy(key).agg(newest.alias("_row")).select(key, "_row.*")


def error_history(history: Column, errors: Column, most: int = 50) -> Column:
    """Distinct errors in order of their first time, the last `most` of them."""
    both = F.array_distinct(F.concat(F.coalesce(history, F.array().cast("array<string>")), F.coalesce(errors, F.array().cast("array<string>"))))
    return F.slice(both, F.greatest(F.size(both) - most + 1, F.lit(1)), F.lit(most))


def status(entries: Column, requests: Column, closed: Column, snapshot: Column) -> Column:
    """NOT_FETCHED, OBSERVED_EMPTY, CURSOR_PAUSED, SNAPSHOT_COMPLETE or COMPLETE; entries without a request contradict."""
    return (
        F.when((requests == 0) & (entries > 0), F.raise_error("entries without a request"))
        .when(requests == 0, "NOT_FETCHED")
        .when(snapshot, "SNAPSHOT_COMPLETE")
        .when(~closed, "CURSOR_PAUSED")
        .when(entries == 0, "OBSERVED_EMPTY")
        .otherwise("COMPLETE")
    )


def outcome(failed: Column, total: Column, advanced: Column) -> Column:
    """OK, PARTIAL or FAILED of a fetch."""
    return F.when(failed == 0, "OK").when(advanced & (failed < total), "PARTIAL").otherwise("FAILED")


def is_outage(outcomes: DataFrame) -> DataFrame:
    """One row: whether more than half of all fetches failed."""
    return outcomes.agg((F.count_if(F.col("outcome") == "FAILED") * 2 > F.count("*")).alias("outage"))


def pending(candidates: DataFrame, state: DataFrame, key: str, retry: bool = False, most: int | None = None) -> DataFrame:
    """Candidates in order of `ord` without the done ones and, unless `retry`, the failed ones."""
    skipped = state.where(F.col("state").isin(*(("done",) if retry else ("done", "failed")))).select(key)
    rest = candidates.join(skipped, key, "left_anti").orderBy("ord")
    return rest if most is None else rest.limit(most)


def tumbling_counts(events: DataFrame, time: str, width: str, keys: list[str], late: str | None = None) -> DataFrame:
    """Counts by tumbling window; with `late`, a watermark for streams (time must be a timestamp)."""
    frame = events.withWatermark(time, late) if late else events
    grouped = frame.groupBy(F.window(time, width).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    return grouped.select(F.col("w.start").alias("start"), *keys, "n", "value")


def first_seen(events: DataFrame, keys: list[str], time: str, late: str = "1 day") -> DataFrame:
    """The first event of each key: of a stream, of those that come again within the watermark the first that arrives; of a
    table the earliest, ties going to the smallest values, with the number n of all."""
    if events.isStreaming:
        return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)
    rest = [c for c in events.columns if c not in (*keys, time)]
    first = events.groupBy(*keys).agg(F.min(F.struct(time, *rest)).alias("_first"), F.count("*").alias("n"))
    return first.select(*keys, "_first.*", "n")


def sessions(events: DataFrame, time: str, gap: str, key: str, late: str | None = None) -> DataFrame:
    """(key, start, stop, n): bursts of events less than `gap` apart."""
    frame = events.withWatermark(time, late) if late else events
    grouped = frame.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return grouped.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "n")


def stream_upserts(stream: DataFrame, key: str, order: str, read: Callable[[], DataFrame | None], write: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Runs all available input through `upsert`, batch by batch; a restart resumes at the checkpoint.

    read gives the stored table (None at first); write must replace it in one step. A batch that
    is repeated after a failure changes nothing, as the same rows win again.
    """

    def apply(batch: DataFrame, _: int) -> None:
        stored = read()
        newest = upsert(batch.limit(0) if stored is None else stored, batch, key, order)
        write(newest)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
