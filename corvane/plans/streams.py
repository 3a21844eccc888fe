"""Queries that run as streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.plans.registry import query
from corvane.session import shared_folder
from corvane.sources.tables import table
from corvane.streaming import cursors

#: Projects that the users of `events` are dealt to.
PROJECTS = 60


def answers_of(events: DataFrame) -> DataFrame:
    """Events as answers to requests: errors have one of three kinds of codes."""
    failed = F.when(F.col("event_id") % 7 == 0, 403).when(F.col("event_id") % 7 < 4, 503).otherwise(404)
    return events.select(
        F.concat(F.lit("p"), (F.col("user_id") % PROJECTS).cast("string")).alias("project"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("id"),
        F.when(F.col("event_type") == "error", failed).otherwise(200).alias("code"), (F.col("event_id") % 5).alias("entries"),
    )


@query(f"""
WITH RECURSIVE a AS MATERIALIZED (SELECT concat('p', user_id % {PROJECTS}) AS project, epoch_ms(ts) AS tm, event_id % 5 AS e,
    CASE WHEN event_type <> 'error' THEN 200 WHEN event_id % 7 = 0 THEN 403 WHEN event_id % 7 < 4 THEN 503 ELSE 404 END AS code,
    row_number() OVER (PARTITION BY user_id % {PROJECTS} ORDER BY ts, event_id) AS k FROM events),
s(project, k, cursor, stop, complete, rests, reopens, calls, requests, skipped, entries, errors) AS (
  SELECT DISTINCT project, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(400 AS BIGINT), false, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM a
  UNION ALL
  SELECT project, k, moved, stop, done, CASE WHEN NOT taken THEN rests WHEN done THEN NULL WHEN code = 403 THEN tm + 86400000 WHEN code = 503 THEN tm + 7200000 WHEN tried >= 6 THEN tm + 43200000 END,
    CASE WHEN taken AND done THEN tm + 345600000 ELSE reopens END, tried, requests + CASE WHEN taken THEN 1 ELSE 0 END, skipped + CASE WHEN taken THEN 0 ELSE 1 END,
    entries + CASE WHEN taken AND code = 200 THEN e ELSE 0 END, errors + CASE WHEN taken AND code <> 200 THEN 1 ELSE 0 END
  FROM (SELECT *, CASE WHEN taken AND code = 200 THEN cursor + 90 ELSE cursor END AS moved, complete OR (taken AND code = 200 AND cursor + 90 > stop) AS done, calls + CASE WHEN taken THEN 1 ELSE 0 END AS tried
    FROM (SELECT *, NOT complete AND rests IS NULL AS taken
      FROM (SELECT s.project, a.k, tm, code, e, cursor, CASE WHEN complete AND tm >= reopens THEN stop + 180 ELSE stop END AS stop, complete AND NOT tm >= reopens AS complete,
          CASE WHEN (complete AND tm >= reopens) OR tm >= rests THEN NULL ELSE rests END AS rests, CASE WHEN complete AND tm >= reopens THEN NULL ELSE reopens END AS reopens,
          CASE WHEN (complete AND tm >= reopens) OR tm >= rests THEN 0 ELSE calls END AS calls, requests, skipped, entries, errors
        FROM s JOIN a ON a.project = s.project AND a.k = s.k + 1))))
SELECT project, k AS seen, CASE WHEN complete THEN 'COMPLETE' WHEN rests IS NOT NULL THEN 'CURSOR_PAUSED' ELSE 'OPEN' END AS status,
  strftime(DATE '2020-01-01' + CAST(cursor AS INTEGER), '%Y-%m-%d') AS cursor, requests, skipped, entries, errors
FROM s QUALIFY row_number() OVER (PARTITION BY project ORDER BY k DESC) = 1
""")
def refresh_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as answers that arrive in three slices of time, each of which resumes the stream; every project's last state."""
    folder = f"{shared_folder(spark)}/cursors-{uuid.uuid4().hex}"
    answers = answers_of(table(spark, sf_dir, "events"))
    first, last = answers.agg(F.min(F.unix_micros("at")), F.max(F.unix_micros("at"))).first()
    step = ((last or 0) - (first or 0)) // 3 + 1
    for number in range(3):
        low = (first or 0) + number * step
        arrived = answers.where((F.unix_micros("at") >= low) & (F.unix_micros("at") < low + step))
        arrived.write.mode("append").parquet(f"{folder}/answers")
        cursors.run_available(spark.readStream.schema(answers.schema).parquet(f"{folder}/answers"), cursors.Policy(), folder)
    return cursors.newest(spark.read.schema(cursors.OUTPUT).parquet(f"{folder}/rows")).drop("event")
