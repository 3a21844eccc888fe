"""Readers and sinks on files made here."""

import gzip
import hashlib
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from corvane.sources import archives, catalogs, sinks, trees


def write(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())


def test_catalog_scan_and_projects(spark, tmp_path):
    for name, lines in {"postgres-upstream": ['{"advisory_id":"CVE-1-1","cwe":null}', "", '{"advisory_id":"CVE-1-2"}'], "curl": ['{"advisory_id":"CVE-1-1","published":""}']}.items():
        write(tmp_path / name / "catalog.jsonl", "\n".join(lines) + "\n")
    rows = catalogs.read_catalogs(spark, f"{tmp_path}/*/catalog.jsonl").collect()
    assert sorted((r.advisory_id, r.project, r.auth) for r in rows) == [("CVE-1-1", "curl", False), ("CVE-1-1", "postgresql", True), ("CVE-1-2", "postgresql", True)]
    write(tmp_path / "bad" / "catalog.jsonl", '{"advisory_id":"CVE-1-1"}\n{broken\n')
    with pytest.raises(Exception):
        catalogs.read_catalogs(spark, f"{tmp_path}/bad/catalog.jsonl").collect()
    assert catalogs.read_catalogs(spark, f"{tmp_path}/bad/catalog.jsonl", mode="DROPMALFORMED").count() == 1


def test_last_line_wins(spark, tmp_path):
    write(tmp_path / "catalog.jsonl", '{"advisory_id":"A-1","cwe":"x"}\n\n{"advisory_id":"A-2","cwe":"y"}\n{"advisory_id":"A-1","cwe":"z"}\n')
    rows = catalogs.last_line_wins(catalogs.read_numbered(spark, str(tmp_path / "catalog.jsonl"), catalogs.ADVISORY)).collect()
    assert sorted((r.advisory_id, r.cwe, r.line_no) for r in rows) == [("A-1", "z", 4), ("A-2", "y", 3)]


def test_documents_by_tag_and_name(spark, tmp_path):
    write(tmp_path / "fp" / "curl" / "CVE-1-1.json", json.dumps({"schema": "a/1", "x": 1}, indent=1))
    write(tmp_path / "fp" / "curl" / "CVE-1-2.json", '{"schema":"b/1","x":2}')
    write(tmp_path / "fp" / "index.json", '{"schema":"a/1"}')
    write(tmp_path / "fp" / "git-CVE-2016-2315.json", '{"schema":"a/1","x":3}')
    found = catalogs.read_documents(spark, f"{tmp_path}/fp", "schema string, x int", "a/1")
    assert sorted((r.dir, r.name, r.x) for r in found.collect()) == [("curl", "CVE-1-1", 1), ("fp", "git-CVE-2016-2315", 3)]
    assert [(r.project, r.advisory_id) for r in catalogs.file_keys(found).collect()] == [("git", "CVE-2016-2315")]


def test_point_lookup_prunes_and_checks(spark, tmp_path):
    spark.createDataFrame([("curl", "CVE-1-1"), ("git", "CVE-1-2")], "project string, id string").write.partitionBy("project").parquet(f"{tmp_path}/t")
    found = catalogs.point(spark, f"{tmp_path}/t", project="curl", id="CVE-1-1")
    assert found.count() == 1 and "PartitionFilters: [isnotnull(project" in found._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        catalogs.point(spark, f"{tmp_path}/t", project="../x")
    assert catalogs.locate(spark.read.parquet(f"{tmp_path}/t"), "id", "CVE-1-2").first().project == "git"


def test_resolve(tmp_path, monkeypatch):
    monkeypatch.delenv("X_DATA", raising=False)
    assert catalogs.resolve("arg", "X_DATA") == "arg" and catalogs.resolve(None, "X_DATA", "/nowhere", str(tmp_path)) == str(tmp_path)
    monkeypatch.setenv("X_DATA", "env")
    assert catalogs.resolve(None, "X_DATA", str(tmp_path)) == "env"
    monkeypatch.delenv("X_DATA")
    with pytest.raises(FileNotFoundError):
        catalogs.resolve(None, "X_DATA", "/nowhere")


def test_listings_must_agree(spark):
    one = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    assert catalogs.agreeing(one, one.select("k", F.col("x").alias("y")), "k").count() == 2
    with pytest.raises(Exception):
        catalogs.agreeing(one, one.where("x = 1").select("k"), "k").collect()


def test_zip_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("1.json", '{"id":"x"}')
        z.writestr("2.json", "{bad")
        z.writestr("3.json", b"\xff\xfe")
        z.writestr("n.csv", "ID,Name\n79,XSS\nx,No\n80,\n")
    assert [r.id for r in archives.zip_json(spark, f"{tmp_path}/a.zip", "id string").collect()] == ["x"]
    assert [tuple(r) for r in archives.zip_csv(spark, f"{tmp_path}/a.zip", "ID", "Name").collect()] == [("79", "XSS")]


def test_yearly_feed_reads_its_years_only(spark, tmp_path):
    for year in (2001, 2002):
        write(tmp_path / f"f-{year}.json.gz", gzip.compress(json.dumps({"id": year}).encode()))
    rows = archives.yearly_feed(spark, f"{tmp_path}/f-{{year}}.json.gz", [2002], "id int").collect()
    assert [(r.id, r.year) for r in rows] == [(2002, 2002)]


def test_bundle_and_install(tmp_path):
    write(tmp_path / "src" / "d" / "a.txt", "one")
    write(tmp_path / "src" / "b.txt", "two")
    first = archives.bundle(str(tmp_path / "src"), str(tmp_path / "x.tgz"))
    os.utime(tmp_path / "src" / "b.txt", (1, 1))
    assert archives.bundle(str(tmp_path / "src"), str(tmp_path / "y.tgz")) == first
    archives.install(str(tmp_path / "x.tgz"), first, str(tmp_path / "out"))
    assert (tmp_path / "out" / "d" / "a.txt").read_text() == "one"
    with pytest.raises(ValueError):
        archives.install(str(tmp_path / "x.tgz"), "0" * 64, str(tmp_path / "out"))


def test_walk_and_lock_files(spark, tmp_path):
    write(tmp_path / "a.c", "int x;")
    write(tmp_path / "bad.py", b"\xff\xfe\xfa")
    write(tmp_path / "node_modules" / "b.c", "no")
    write(tmp_path / ".hidden" / "c.c", "no")
    write(tmp_path / "big.c", "x" * 3000)
    write(tmp_path / "sub" / "requirements-dev.txt", "a==1\n")
    rows = {r.relative: r for r in trees.walk(spark, str(tmp_path), max_bytes=2000).collect()}
    assert set(rows) == {"a.c", "bad.py"} and not rows["bad.py"].readable and rows["bad.py"].text is None
    assert trees.walk(spark, str(tmp_path), max_files=1).count() == 1
    assert [r.path.rsplit("/", 1)[1] for r in trees.lock_files(spark, str(tmp_path)).collect()] == ["requirements-dev.txt"]
    kinds = spark.createDataFrame([("x/y.rs",), ("z",)], "p string").select(trees.language(F.col("p")).alias("l")).collect()
    assert [r.l for r in kinds] == ["Rust", None]


def test_manifest_states(spark, tmp_path):
    write(tmp_path / "m" / "a", "1")
    write(tmp_path / "m" / "b", "2")
    write(tmp_path / "m" / "extra", "3")
    good = hashlib.sha256(b"1").hexdigest()
    listed = spark.createDataFrame([("a", good, 1), ("b", good, 1), ("c", good, 1), ("../d", good, 1)], "path string, sha256 string, bytes long")
    states = {r.path: r.state for r in trees.verify_manifest(spark, str(tmp_path / "m"), listed).collect()}
    assert states == {"a": "OK", "b": "CHANGED", "c": "MISSING", "../d": "UNSAFE", "extra": "EXTRA"}
    assert [r.path for r in sinks.manifest(spark, str(tmp_path / "m")).collect()] == ["a", "b", "extra"]


def test_yaml_and_recorded_responses(spark, tmp_path):
    write(tmp_path / "a.yaml", "name: x\nlist:\n- 1\n- k: v\n")
    assert {(r.key, r.value) for r in trees.read_yaml(spark, f"{tmp_path}/a.yaml").collect()} == {("name", "x"), ("list.0", "1"), ("list.1.k", "v")}
    write(tmp_path / "r" / "page1.json", '{"n":1}')
    write(tmp_path / "r" / "page2.json", '{"n":2}')
    assert sorted((r.page, r.n) for r in trees.recorded_responses(spark, f"{tmp_path}/r", "n int").collect()) == [(1, 1), (2, 2)]
    with pytest.raises(Exception):
        trees.recorded_responses(spark, f"{tmp_path}/r", "n int", most_bytes=3).collect()


def test_sinks(spark, tmp_path):
    frame = spark.createDataFrame([(2, "b'c", {"z": 1, "a": 2}), (1, None, {})], "id int, name string, m map<string,int>")
    sinks.write_jsonl(frame.repartition(2), f"{tmp_path}/j", ["id"])
    lines = [r.value for r in spark.read.text(f"{tmp_path}/j").collect()]
    assert sorted(lines) == ['{"id":1,"m":{},"name":null}', '{"id":2,"m":{"a":2,"z":1},"name":"b\'c"}']
    plain = frame.drop("m")
    assert sinks.write_if_changed(plain, f"{tmp_path}/t") and not sinks.write_if_changed(plain.repartition(3), f"{tmp_path}/t")
    assert sinks.write_if_changed(plain.limit(1), f"{tmp_path}/t") and spark.read.parquet(f"{tmp_path}/t").count() == 1
    assert sorted(r.value for r in sinks.insert_statements(plain, "t").collect()) == ["INSERT INTO t VALUES (1, NULL);", "INSERT INTO t VALUES (2, 'b''c');"]
    sinks.write_entities(plain, f"{tmp_path}/e", "id", ["name"])
    assert os.path.isdir(f"{tmp_path}/e/id=2")
    assert "| 2 | b'c |" in sinks.markdown(plain.orderBy("id"), "T")
    assert archives.canonical({"b": 1, "a": [1]}) == b'{"a":[1],"b":1}\n'
