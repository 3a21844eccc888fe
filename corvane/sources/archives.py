"""Archives: JSON in ZIP, CSV in ZIP, gzip feeds by year, verified tar bundles."""

from __future__ import annotations

import csv
import hashlib
import io
import json
import os
import shutil
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_zip(spark: SparkSession, path: str, ending: str = ".json") -> DataFrame:
    """(archive, member, text) of the members with an ending; a member that cannot be decoded is skipped."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in batch.itertuples(index=False):
                rows = []
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in sorted(archive.namelist()):
                        if not member.endswith(ending):
                            continue
                        try:
                            rows.append((name, member, archive.read(member).decode()))
                        except (UnicodeDecodeError, zipfile.BadZipFile):
                            continue
                yield pd.DataFrame(rows, columns=["archive", "member", "text"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, "archive string, member string, text string")


def zip_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parsed JSON members; malformed ones are skipped."""
    parsed = read_zip(spark, path).select("archive", "member", F.from_json("text", schema, {"mode": "PERMISSIVE"}).alias("row"), F.try_parse_json("text").isNotNull().alias("ok"))
    return parsed.where("ok").select("archive", "member", "row.*")


def zip_csv(spark: SparkSession, path: str, key: str, name: str) -> DataFrame:
    """(id, name) of the CSV members: rows with a numeric id and a name."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(r.get(key), r.get(name)) for text in batch["text"] for r in csv.DictReader(io.StringIO(text))]
            yield pd.DataFrame(rows, columns=["id", "name"])

    rows = read_zip(spark, path, ".csv").mapInPandas(run, "id string, name string")
    return rows.where(F.col("id").rlike("^[0-9]+$") & (F.trim("name") != ""))


def yearly_feed(spark: SparkSession, pattern: str, years: list[int], schema: str) -> DataFrame:
    """Gzip JSON feeds with {year} in their path, only those years; the feed's year comes along."""
    out = None
    for year in years:
        part = spark.read.schema(schema).option("multiLine", "true").json(pattern.format(year=year)).withColumn("year", F.lit(year))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no years")
    return out


def first_entries(feed: DataFrame, array: str, key: str) -> DataFrame:
    """(key, year, entry) of the entries in an array column of yearly feeds; of an id that comes again the first counts, by year and place."""
    entries = feed.select("year", F.posexplode(array).alias("place", "entry"))
    first = entries.groupBy(F.col(f"entry.{key}").alias("key")).agg(F.min_by(F.struct("year", "entry"), F.struct("year", "place")).alias("first"))
    return first.select("key", "first.year", "first.entry")


def bundle(folder: str, target: str) -> str:
    """A reproducible tar.gz of a folder; returns its sha256."""
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w", format=tarfile.USTAR_FORMAT) as archive:
        names = sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, files in os.walk(folder) for f in files)
        for name in names:
            with open(os.path.join(folder, name), "rb") as file:
                data = file.read()
            info = tarfile.TarInfo(name)
            info.size, info.mode, info.mtime = len(data), 0o644, 0
            archive.addfile(info, io.BytesIO(data))
    import gzip

    packed = gzip.compress(raw.getvalue(), mtime=0)
    with open(target + ".part", "wb") as file:
        file.write(packed)
    os.replace(target + ".part", target)
    return hashlib.sha256(packed).hexdigest()


def install(archive: str, sha256: str, target: str) -> None:
    """Unpacks a verified bundle in the place of target, all or nothing; unsafe members are an error."""
    with open(archive, "rb") as file:
        data = file.read()
    if hashlib.sha256(data).hexdigest() != sha256:
        raise ValueError("the bundle has another hash")
    fresh = target + ".new"
    shutil.rmtree(fresh, ignore_errors=True)
    os.makedirs(fresh)
    with tarfile.open(fileobj=io.BytesIO(data), mode="r:gz") as opened:
        for member in opened.getmembers():
            if not (member.isfile() or member.isdir()) or member.name.startswith("/") or ".." in member.name.split("/") or "\\" in member.name:
                raise ValueError(f"unsafe member {member.name!r}")
        opened.extractall(fresh, filter="data")
    inner = os.listdir(fresh)
    root = os.path.join(fresh, inner[0]) if len(inner) == 1 and os.path.isdir(os.path.join(fresh, inner[0])) else fresh
    old = target + ".old"
    shutil.rmtree(old, ignore_errors=True)
    if os.path.exists(target):
        os.replace(target, old)
    os.replace(root, target)
    shutil.rmtree(old, ignore_errors=True)
    shutil.rmtree(fresh, ignore_errors=True)


def canonical(value: object) -> bytes:
    """Deterministic JSON: sorted keys, no blanks, one newline at the end."""
    return (json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False) + "\n").encode()
