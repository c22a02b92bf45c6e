import gzip
import hashlib
import re

from pyspark.sql import functions as F

from shelfspark.llm import warc
from shelfspark.session import run_folder


def pages(spark):
    big = "<p>é" + "x" * 2000
    rows = [
        (1, "u1", big), (5, "u5", big), (3, "u\n3", big), (2, None, "short"), (4, "u4", "short"), (6, "u6", None), (7, "u7", ""),
        (8, "u8", "y" * 998 + "é"), (9, "u9", "y" * 998 + "é"), (None, "n", big), (5, "u5", big), (10, "u10", "z" * 999), (11, "u11", "z" * 999),
        (12, "long", "w" * 3_000_000),
    ]
    return spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, payload string").coalesce(1)


def test_round_trip(spark):
    got = sorted(map(tuple, warc.archived_pages(pages(spark)).collect()), key=str)
    assert len(got) == 14
    by_id = {}
    for r in got:
        by_id.setdefault(r[0], []).append(r)
    assert sorted(r[3] for r in by_id[5]) == ["response", "revisit"]
    for i in (1, 3, None):
        assert by_id[i][0][3:] == ("revisit", 5) and by_id[i][0][1] == 2005
    assert by_id[8][0][3:] == ("revisit", 9) and by_id[9][0][3:] == ("response", None)
    assert all(by_id[i][0][3:] == ("response", None) for i in (2, 4, 6, 7, 10, 11, 12))
    assert by_id[12][0][2] == hashlib.sha1(b"w" * 3_000_000).hexdigest() and by_id[6][0][1] == 0
    assert warc.archived_pages(pages(spark).limit(0)).collect() == []


def test_predicates_reach_the_source(spark):
    path = run_folder(spark, "warc-test")
    warc.write_warc(warc.archive_records(pages(spark)), path)
    revisits = warc.read_warc(spark, path).filter((F.col("record_type") == "revisit") & F.col("target_uri").startswith("u"))
    plan = revisits._jdf.queryExecution().executedPlan().toString()
    # both predicates are taken by the source, so no filter stands above the scan
    assert "BatchScan warc" in plan and not re.search(r"(?m)^[^A-Za-z]*Filter ", plan)
    assert {r.target_uri for r in revisits.collect()} <= {"u1", "u3", "u 3", "u5", "u8"}
    reader = warc.WarcReader(warc.SCHEMA, {"path": path})
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload",), b"")]))
    assert len(left) == 1 and len(reader.filters) == 1
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert rows and all(r["record_type"] == "revisit" for r in rows)
    many = warc.read_warc(spark, path, ["record_id"], splitBytes="10")
    assert many.count() == 14


def test_unwanted_payloads_are_not_inflated(tmp_path, monkeypatch):
    import pyarrow.fs as pafs

    row = {"record_type": "response", "record_id": "<a>", "payload": bytes(range(256)) * 4000}
    (tmp_path / "a.warc.gz").write_bytes(warc.member(warc.record(row)) * 3)
    assert gzip.decompress((tmp_path / "a.warc.gz").read_bytes()) == warc.record(row) * 3
    f = pafs.LocalFileSystem().open_input_file(str(tmp_path / "a.warc.gz"))
    made = []
    inflate = warc.zlib.decompressobj

    class Counted:
        def __init__(self, *a):
            self.z = inflate(*a)

        def decompress(self, *a):
            out = self.z.decompress(*a)
            made.append(len(out))
            return out

        def __getattr__(self, name):
            return getattr(self.z, name)

    monkeypatch.setattr(warc.zlib, "decompressobj", Counted)
    assert len(list(warc._packed(f, lambda r: True, False))) == 3 and sum(made) < 3 * 2 * warc.HEAD_BYTES
    made.clear()
    assert [p for _, _, p in warc._packed(f, lambda r: True, True)] == [row["payload"]] * 3


def test_foreign_archives(tmp_path, spark):
    """Unpacked files, and gzip members without skip lengths."""
    rows = [{"record_type": "response", "record_id": f"<{i}>", "target_uri": f"http://h/{i}", "payload": b"p" * i * 7000} for i in range(4)]
    (tmp_path / "a.warc").write_bytes(b"".join(map(warc.record, rows)))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(warc.record(r)) for r in rows))
    df = warc.read_warc(spark, str(tmp_path))
    assert sorted((r.record_id, len(r.payload)) for r in df.collect()) == sorted([(f"<{i}>", i * 7000) for i in range(4)] * 2)
    assert sorted(r.target_uri for r in df.filter("target_uri in ('http://h/1', 'http://h/3')").select("target_uri").collect()) == ["http://h/1"] * 2 + ["http://h/3"] * 2


def test_stores_by_the_names_that_spark_has(monkeypatch):
    seen = []
    names = {"s3a://b/x": "s3://b/x", "s3n://b/x": "s3://b/x", "abfss://c@a/x": "abfs://c@a/x", "file:/tmp/x": "file:///tmp/x", "hdfs://n/x": "hdfs://n/x"}

    class Store:
        from_uri = staticmethod(lambda uri: seen.append(uri))

    monkeypatch.setattr(warc.pafs, "FileSystem", Store)
    for path in names:
        warc._store(path)
    assert seen == list(names.values())
