"""The corpus pipeline: five operators in a row, each on what the one before kept.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the
next one's docs. All but the last return the columns of `documents`, further ones of any name included.
What each makes of nulls, empty texts, ties and repeated rows stands with it; an empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import decontamination, mixing, near_duplicates, personal_data, toxicity
from corvane.session import checkpointed, shared_folder
from corvane.sources.tables import table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity model predicts as toxic.

    Null and empty texts score the model's bias and stay; equal texts, repeated rows included, go or stay
    together, whatever their ids. Without labels of both classes nothing goes.
    """
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of linked SimHash fingerprints.

    The smallest id stays, of rows that repeat it the one of the smallest values. Null, empty and blank texts
    are one component; rows with a null id all stay.
    """
    return near_duplicates.one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that share a window of words with a benchmark item.

    Null, empty and wordless texts stay; repeated rows go or stay together; an empty benchmark drops nothing.
    """
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by the names of their kinds.

    No row goes. Null and empty texts stay as they are, repeated rows are changed alike, and where kinds
    overlap the first span, at equal starts the kind listed first, names the whole.
    """
    return personal_data.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: for each document how many words and copies of it are taken, 0 included.

    Null and empty texts are taken 0 times; a null source is a source of its own; repeated rows are units of
    their own, and ties are broken by size, hash and id, so reruns agree.
    """
    return mixing.mix(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
]

#: A learnt model, 64-bit xxHash fingerprints and balanced sampling have no form in SQL.
ORACLE_SQL = None


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`.

    The stages' tables lie in the shared checkpoint folder, each until the next is written; the last
    result is a checkpoint there, and the run's own folder is removed.
    """
    docs = table(spark, sf_dir, "documents")
    folder, before = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            _remove(spark, before)
        before = path
    docs = checkpointed(docs)
    _remove(spark, folder)
    return docs
