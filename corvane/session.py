"""Session defaults. A cluster's own settings win: only unset keys are filled in."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int = 8, partitions: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and bench.py."""
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", "8g")
    settings = DEFAULTS | {
        "spark.sql.shuffle.partitions": str(partitions or cpus),
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where that is unset in local mode (tests, laptops) is one made under the session's warehouse; on a cluster
    it is an error, as a folder of one machine would lose what another has written.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_checkpoints")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def checkpointed_by(df: DataFrame, *keys: str) -> DataFrame:
    """`checkpointed`, dealt and sorted by the keys; joins by them, in this order, neither shuffle nor sort it again.

    A checkpoint keeps how its rows lie only if the plan that wrote it was fixed beforehand, so adaptive execution rests
    while it is written. Rows of one key stay in one partition.
    """
    spark, key = df.sparkSession, "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return checkpointed(df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys))
    finally:
        spark.conf.set(key, before)


#: Bytes of one Arrow batch between the JVM and Python, at most.
BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batch size where it is larger than BATCH_BYTES, and leaves it so.

    Maps that hand whole documents back hold a batch several times over, on both sides. Plans read the setting when they
    run, which is after the operator has returned, so it can't be put back here.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(-?[0-9]+)([a-z]*)", spark.conf.get(key).lower()).groups()
    if not 0 < int(number) << {"k": 10, "m": 20, "g": 30}.get(unit[:1], 0) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
