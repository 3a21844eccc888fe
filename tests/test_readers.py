"""ZIP members and recorded pages as data sources."""

import os
import tracemalloc
import zipfile
from types import SimpleNamespace

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corvane.plans import roundtrips
from corvane.sources import readers


@pytest.fixture(scope="module")
def sources(spark):
    readers.register(spark)


def test_zip_members_come_back_pruned_and_split(spark, sources, tmp_path):
    folder = str(tmp_path / "zips")
    rows = [(f"d{k}/r{k}.json", "{" + f'"k":{k},"t":"{chr(228) * k}"' + "}") for k in range(40)] + [("n.txt", "x"), ("z.json", None)]
    spark.createDataFrame(rows, "member string, text string").repartition(2).write.format("zip_members").option("path", folder).mode("append").save()
    assert len(os.listdir(folder)) == 2 and not any(f.startswith("_") for f in os.listdir(folder))
    read = lambda **o: spark.read.format("zip_members").options(path=folder, **o)
    whole = read().load()
    assert sorted((r.member, r.text) for r in whole.collect()) == sorted((m, t or "") for m, t in rows)
    assert read(ending=".json", partition_bytes="100").load().rdd.getNumPartitions() > 5
    only = whole.where(F.col("member") == "d7/r7.json")
    assert [r.text for r in only.collect()] == ['{"k":7,"t":"äääääää"}'] and only.rdd.getNumPartitions() == 1
    assert whole.where(F.col("member").startswith("d1")).count() == 11 and whole.where(F.col("member").isin("n.txt", "none") & (F.col("bytes") > 0)).count() == 1
    assert whole.where(F.col("member") == "none").count() == 0
    names = read().schema("member string, bytes bigint").load()
    assert names.columns == ["member", "bytes"] and names.agg(F.sum("bytes")).first()[0] == sum(len((t or "").encode()) for _, t in rows)
    with zipfile.ZipFile(f"{folder}/odd.zip", "w") as archive:
        archive.writestr("bad.json", b"\xff\xfe")
        archive.writestr("folder/", b"")
    assert whole.where(F.col("member").startswith("bad")).count() == 0  # cannot be decoded
    spark.createDataFrame([("a", "b")], "member string, text string").write.format("zip_members").option("path", folder).mode("overwrite").save()
    assert [(r.member, r.text) for r in read().load().collect()] == [("a", "b")]


def test_recorded_pages_as_table_and_as_a_stream_that_resumes(spark, sources, tmp_path):
    folder, out = str(tmp_path / "pages"), str(tmp_path / "out")
    pages = lambda a, b: spark.createDataFrame([(k, readers.body_of([{"k": k, "x": "y" * 50}])) for k in range(a, b)], "page long, body string").repartition(3)
    record = lambda frame: frame.write.format("recorded_pages").option("path", folder).mode("append").save()
    record(pages(0, 12))
    table = spark.read.format("recorded_pages").option("path", folder).load()
    assert [r.page for r in table.orderBy("page").collect()] == list(range(12)) and table.where("page = 11").first().body == '[{"k":11,"x":"' + "y" * 50 + '"}]'

    def run():
        stream = spark.readStream.format("recorded_pages").options(path=folder, batch_bytes="200").load()
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/state").start(f"{out}/rows")
        query.processAllAvailable()
        batches = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
        query.stop()
        return batches

    assert sum(run()) == 12 and len(os.listdir(f"{out}/state/commits")) > 3  # 200 bytes are three pages
    record(pages(12, 15))
    assert sum(run()) == 3
    assert sorted(r.page for r in spark.read.parquet(f"{out}/rows").collect()) == list(range(15))
    with pytest.raises(PythonException, match="page .* bytes, more than 10"):
        spark.read.format("recorded_pages").options(path=folder, page_bytes="10").load().collect()


def test_an_aborted_write_leaves_nothing(spark, sources, tmp_path):
    folder = str(tmp_path / "zips")
    bad = spark.range(20).repartition(2).select(F.when(F.col("id") == 13, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("string").alias("member"), F.lit("t").alias("text"))
    with pytest.raises(Exception, match="no"):
        bad.write.format("zip_members").option("path", folder).mode("append").save()
    assert not os.path.isdir(folder) or os.listdir(folder) == []


def test_empty_folders(spark, sources, tmp_path):
    for name in ("zip_members", "recorded_pages"):
        assert spark.read.format(name).option("path", str(tmp_path / "none")).load().count() == 0


def test_a_quiet_folder_is_listed_once_and_pages_share_tasks(spark, tmp_path, monkeypatch):
    for k in range(300):
        (tmp_path / f"page-{k}.json").write_text("x" * 100)
    os.utime(tmp_path, (1, 1))
    calls, files = [], readers._files
    monkeypatch.setattr(readers, "_files", lambda *a: calls.append(a) or files(*a))
    stream = readers.RecordedPages({"path": str(tmp_path), "batch_bytes": "1000"}).streamReader(StructType.fromDDL("page bigint, bytes bigint, body string"))
    at, read = stream.initialOffset(), []
    while (to := stream.latestOffset()) != at:
        tasks = stream.partitions(at, to)
        assert len(tasks) == 1
        read.append([number for number, *_ in tasks[0].files])
        at = to
    assert read == [list(range(k, k + 10)) for k in range(0, 300, 10)] and len(calls) == 1
    (tmp_path / "page-300.json").write_text("y")
    assert stream.latestOffset() == {"page": 300} and [n for n, *_ in stream.partitions(at, {"page": 300})[0].files] == [300]


def test_a_stream_far_behind_catches_up_in_few_batches_and_misses_no_page(tmp_path):
    for k in range(400):
        (tmp_path / f"page-{3 * k}.json").write_text("x" * (50 + k % 7))
    schema = StructType.fromDDL("page bigint, bytes bigint, body string")

    def batches(count=10_000, **options):
        stream = readers.RecordedPages({"path": str(tmp_path), "batch_bytes": "200", **options}).streamReader(schema)
        at, read = stream.initialOffset(), []
        while (to := stream.latestOffset()) != at and len(read) < count:
            read.append([number for task in stream.partitions(at, to) for number, *_ in task.files])
            at = to
        return read

    plain, quick = batches(), batches(catch_up="4")
    assert sum(plain, []) == sum(quick, []) == list(range(0, 1200, 3))
    assert len(plain) == 100 and all(len(b) == 4 for b in plain) and len(quick) < 25
    assert 100 <= len(quick[0]) < 105 and sorted(map(len, quick), reverse=True) == [*map(len, quick)] and len(quick[-2]) == 4


def test_archives_are_written_and_read_in_pieces(spark, tmp_path):
    rows = ({"member": f"m{k}", "text": os.urandom(100_000).hex()} for k in range(100))
    writer = readers._ZipWriter({"path": str(tmp_path)}, False)
    tracemalloc.start()
    written = writer.write(rows)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 5 << 20 and os.path.getsize(written.files[0][0]) > 10_000_000  # not gathered in memory
    writer.commit([written])
    source = readers.ZipMembers({"path": str(tmp_path)})
    schema = StructType.fromDDL(source.schema())
    reader = source.reader(schema)
    batches = [b for part in reader.partitions() for b in reader.read(part)]
    assert len(batches) > 1 and sum(b.num_rows for b in batches) == 100 and max(b.nbytes for b in batches) < 5 << 20


def test_members_that_fail_are_no_result(spark, sources, tmp_path):
    for name, texts in (("undecoded", [b"\xff\xfe"]), ("damaged", [b"x" * 999]), ("twice", [b"one", b"two"])):
        os.mkdir(tmp_path / name)
        with zipfile.ZipFile(tmp_path / name / "a.zip", "w") as archive:
            for text in texts:
                archive.writestr("d3/3.txt", text)
    damaged = tmp_path / "damaged" / "a.zip"
    damaged.write_bytes(damaged.read_bytes().replace(b"xxx", b"xyx", 1))  # its checksum is wrong now
    read = lambda name, **o: spark.read.format("zip_members").options(path=str(tmp_path / name), **o).load()
    for name in ("undecoded", "damaged"):
        assert read(name).count() == 0
        with pytest.raises(PythonException, match="3.txt of .* can't be read"):
            read(name, unreadable="fail").collect()
    with pytest.raises(Exception, match="no archives at"):
        read("none", unreadable="fail").collect()
    with pytest.raises(Exception, match="skip or fail"):
        read("twice", unreadable="drop").collect()
    assert sorted(r.text for r in read("twice", unreadable="fail").collect()) == ["one", "two"]  # not the last one twice
    spark.createDataFrame([], "member string, text string").write.format("zip_members").option("path", str(tmp_path / "empty")).mode("append").save()
    assert read("empty", unreadable="fail").count() == 0


def test_the_round_trip_of_archives_fails_by_a_member_that_does_not_come_back(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(3, "whole"), (10, None), (11, "d4")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {(r.doc_id, r.bytes) for r in roundtrips.zip_members_roundtrip(spark, str(tmp_path)).collect()} == {(3, 5), (10, 0)}
    monkeypatch.setattr(roundtrips, "shared_folder", lambda spark: str(tmp_path / "shared"))
    monkeypatch.setattr(roundtrips, "uuid", SimpleNamespace(uuid4=lambda: SimpleNamespace(hex="known")))
    os.makedirs(tmp_path / "shared" / "zips-known")
    with zipfile.ZipFile(tmp_path / "shared" / "zips-known" / "odd.zip", "w") as archive:
        archive.writestr("d3/17.txt", b"\xff\xfe")
    with pytest.raises(PythonException, match="d3/17.txt of .* can't be read"):
        roundtrips.zip_members_roundtrip(spark, str(tmp_path)).collect()
