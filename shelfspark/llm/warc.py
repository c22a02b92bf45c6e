"""WARC archives as a Spark data source: written with revisit records, read headers first, payloads only where wanted."""

from __future__ import annotations

import base64
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)

from shelfspark.session import run_folder

#: Payloads at least this long may be replaced by a revisit record.
REVISIT_BYTES = 1000
SPLIT_BYTES = 128 << 20
FILE_BYTES = 256 << 20
BATCH_BYTES = 8 << 20
HEAD_BYTES = 16 << 10
LEVEL = 1

SCHEMA = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("content_length", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("refers_to", T.StringType()), T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("payload", T.BinaryType()),
])
# The header behind each column.
HEADER_OF = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "content_length": "Content-Length", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
}
# Names of stores in Spark's paths and in Arrow's.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs", "wasb": "abfs"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it; any store that Arrow knows by its URI, or by another name that Spark has for it."""
    path = re.sub(r"^file:/+", "file:///", path)
    for spark_name, arrow_name in SCHEMES.items():
        if path.startswith(f"{spark_name}://"):
            path = arrow_name + path.removeprefix(spark_name)
    return pafs.FileSystem.from_uri(path)


def _hex_digest(value: str | None) -> str | None:
    """``sha1:`` with a base-32 or hexadecimal digest as bare hexadecimal."""
    if value is None:
        return None
    digest = value.partition(":")[2] or value
    return base64.b32decode(digest.upper()).hex() if len(digest) == 32 else digest.lower()


# ---- one record -----------------------------------------------------------------------------------------------------


def member(data: bytes) -> bytes:
    """A gzip member whose extra field ``sl`` tells its packed and its plain length, so that a reader can skip it."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _one_line(value: object) -> str:
    return re.sub(r"[\r\n]+", " ", str(value))


def record(row: dict) -> bytes:
    """The bytes of a record: headers, blank line, HTTP head, and the payload unless it is a revisit."""
    payload = row.get("payload") or b""
    revisit = row["record_type"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    heads = {HEADER_OF[c]: row.get(c) for c in ("record_type", "record_id", "target_uri", "date", "refers_to")}
    if row.get("payload_digest") is not None:
        heads["WARC-Payload-Digest"] = "sha1:" + base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    if revisit:
        heads["WARC-Profile"] = PROFILE
    heads |= dict(row.get("headers") or ())
    heads |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    lines = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in heads.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in lines if ":" in x)}


def _values(heads: dict[str, str]) -> dict[str, object]:
    """The columns that headers alone give."""
    folded = {k.lower(): v for k, v in heads.items()}
    out: dict[str, object] = {c: folded.get(h.lower()) for c, h in HEADER_OF.items()}
    out["content_length"] = int(out["content_length"] or 0)
    out["payload_digest"] = _hex_digest(out["payload_digest"])
    return out


def _body(heads: dict[str, str], block: bytes) -> bytes:
    if heads.get("Content-Type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


# ---- predicates -----------------------------------------------------------------------------------------------------


def _holds(f: Filter, row: dict[str, object]) -> bool:
    """Whether a pushed predicate is true of a record's headers; a null compares as not true."""
    if isinstance(f, Not):
        inner = f.child
        column = row.get(inner.attribute[0])
        return isinstance(inner, (IsNull, IsNotNull)) and not _holds(inner, row) or column is not None and not _holds(inner, row)
    value = row.get(f.attribute[0])
    if isinstance(f, IsNull):
        return value is None
    if isinstance(f, IsNotNull):
        return value is not None
    if value is None:
        return False
    test = {
        EqualTo: lambda: value == f.value, In: lambda: value in f.value, GreaterThan: lambda: value > f.value,
        GreaterThanOrEqual: lambda: value >= f.value, LessThan: lambda: value < f.value, LessThanOrEqual: lambda: value <= f.value,
        StringStartsWith: lambda: value.startswith(f.value), StringEndsWith: lambda: value.endswith(f.value),
        StringContains: lambda: f.value in value,
    }
    return test[type(f)]()


SUPPORTED = (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, StringStartsWith, StringEndsWith, StringContains, IsNull, IsNotNull)


def _pushable(f: Filter) -> bool:
    inner = f.child if isinstance(f, Not) else f
    return isinstance(inner, SUPPORTED) and len(inner.attribute) == 1 and inner.attribute[0] in HEADER_OF


# ---- reading --------------------------------------------------------------------------------------------------------


@dataclass
class Files(InputPartition):
    paths: list[str] = field(default_factory=list)

    def __init__(self, paths: list[str]):
        super().__init__(None)
        self.paths = paths


def _packed(f, wanted, want_payload: bool) -> Iterator[tuple[dict, dict, bytes | None]]:
    """Records of a .warc.gz: a member is inflated until its headers are there, and further only if the record is wanted."""
    size, at = f.size(), 0
    while at < size:
        f.seek(at)
        chunk = f.read(HEAD_BYTES)
        length = 0
        if chunk[3] & 4:
            extra_size = struct.unpack_from("<H", chunk, 10)[0]
            if chunk[12:14] == b"sl" and extra_size >= 12:
                length = struct.unpack_from("<I", chunk, 16)[0]
        inflate = zlib.decompressobj(31)
        read = len(chunk)
        plain = inflate.decompress(chunk, HEAD_BYTES)
        while b"\r\n\r\n" not in plain and not inflate.eof:
            more = inflate.unconsumed_tail or f.read(HEAD_BYTES)
            read += 0 if inflate.unconsumed_tail else len(more)
            if not more:
                raise ValueError(f"cut off within the record at byte {at}")
            plain += inflate.decompress(more, HEAD_BYTES)
        head, _, rest = plain.partition(b"\r\n\r\n")
        heads = parse_head(head)
        row = _values(heads)
        keep = wanted(row)
        if length and not (keep and want_payload):
            at += length
        else:
            parts = [rest]
            while not inflate.eof:
                more = inflate.unconsumed_tail
                if not more:
                    more = f.read(1 << 18)
                    read += len(more)
                    if not more:
                        raise ValueError(f"cut off within the record at byte {at}")
                part = inflate.decompress(more, 1 << 20)
                if keep and want_payload:
                    parts.append(part)
            at += read - len(inflate.unused_data)
            rest = b"".join(parts)
        if keep:
            yield row, heads, _body(heads, rest[: row["content_length"]]) if want_payload else None


def _plain(f, wanted, want_payload: bool) -> Iterator[tuple[dict, dict, bytes | None]]:
    """Records of an unpacked .warc: unwanted blocks are jumped over."""
    size, at = f.size(), 0
    while at < size:
        f.seek(at)
        head = f.read(HEAD_BYTES)
        while b"\r\n\r\n" not in head:
            more = f.read(HEAD_BYTES)
            if not more:
                if head.strip():
                    raise ValueError(f"cut off within the record at byte {at}")
                return
            head += more
        head = head.partition(b"\r\n\r\n")[0]
        heads = parse_head(head)
        row = _values(heads)
        block = at + len(head) + 4
        if wanted(row):
            payload = None
            if want_payload:
                f.seek(block)
                payload = _body(heads, f.read(row["content_length"]))
            yield row, heads, payload
        at = block + row["content_length"] + 4


class WarcReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.path, self.filters = schema, options["path"], []
        self.split = int(options.get("splitbytes", SPLIT_BYTES))

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if _pushable(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """Whole files, small ones together; where a writer left lists of files, only what they name."""
        store, path = _store(self.path)
        info = store.get_file_info(path)
        found = [info] if info.is_file else store.get_file_info(pafs.FileSelector(path, recursive=True))
        lists = [x for x in found if x.base_name.startswith("_files-")]
        named = {n for x in lists for n in json.loads(store.open_input_file(x.path).read())}
        files = [
            x for x in found
            if x.is_file and x.size and re.search(r"\.warc(\.gz)?$", x.base_name) and (not lists or x.base_name in named)
        ]
        parts: list[list[str]] = []
        room = 0
        for x in sorted(files, key=lambda x: -x.size):
            if x.size > room or not parts:
                parts.append([])
                room = self.split
            parts[-1].append(x.path)
            room -= x.size
        return [Files(p) for p in parts] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        names = self.schema.fieldNames()
        kinds = [
            {"binary": pa.binary(), "bigint": pa.int64()}.get(f.dataType.simpleString(), pa.map_(pa.string(), pa.string()) if isinstance(f.dataType, T.MapType) else pa.string())
            for f in self.schema.fields
        ]
        store, _ = _store(self.path)
        wanted = lambda row: all(_holds(f, row) for f in self.filters)
        rows: list[list] = [[] for _ in names]
        held = 0
        pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=names)
        for path in partition.paths:
            with store.open_input_file(path) as f:
                for row, heads, payload in (_packed if path.endswith(".gz") else _plain)(f, wanted, "payload" in names):
                    full = row | {"headers": list(heads.items()), "payload": payload}
                    for c, n in zip(rows, names, strict=True):
                        c.append(full[n])
                    held += 500 + len(payload or b"")
                    if held > BATCH_BYTES:
                        yield pack()
                        rows, held = [[] for _ in names], 0
        if rows[0]:
            yield pack()


# ---- writing --------------------------------------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Each task writes files of its own names; only those of tasks that ended well are listed, so a lost one leaves nothing."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, path = _store(self.path)
        store.create_dir(path, recursive=True)
        names: list[str] = []
        out, size = None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size > FILE_BYTES:
                    if out is not None:
                        out.close()
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(f"{path}/{names[-1]}", compression=None), 0
                data = member(record(row))
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        store, path = _store(self.path)
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/_files-{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps([n for m in messages if m for n in m.names]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, path = _store(self.path)
        for m in messages:
            for n in m.names if m else ():
                store.delete_file(f"{path}/{n}")


class Warc(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("archives are only added to; write to a new folder")
        return WarcWriter(self.options)


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None, **options: str) -> DataFrame:
    """Records below ``path``. Payloads are decoded only if ``columns`` holds ``payload``, and of records that pass the filters."""
    spark.dataSource.register(Warc)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    wanted = T.StructType([f for f in SCHEMA.fields if columns is None or f.name in columns])
    return spark.read.format("warc").schema(wanted).options(**options).load(path)


def write_warc(records: DataFrame, path: str) -> None:
    """Writes rows of (a part of) the columns of the archive; ``headers`` may hold more headers."""
    records.sparkSession.dataSource.register(Warc)
    records.write.format("warc").mode("append").save(path)


# ---- pages ----------------------------------------------------------------------------------------------------------


def archive_records(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """One record per page: of equal payloads of ``least`` bytes or more the one with the largest id is the response.

    Only ids and digests are grouped; the join that brings the decision back is on the digest, whose hot values Spark
    splits. A null id is smaller than any, and of repeated rows one is the response. ``pages`` is read twice and has to
    give its rows in one order, as a table does.
    """
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("target_uri"),
        F.encode(F.coalesce(F.col(html_col), F.lit("")), "utf-8").alias("payload"),
    ).withColumns({"size": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    groups = (
        rows.filter(F.col("size") >= least).groupBy("payload_digest")
        .agg(F.max(F.struct("id", "row")).alias("top"), F.count("*").alias("n")).filter("n > 1").drop("n")
    )
    urn = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("top.row") != F.col("row")
    return rows.join(groups, "payload_digest", "left").select(
        urn(F.col("id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit("2000-01-01T00:00:00Z").alias("date"),
        "payload_digest",
        F.when(revisit, urn(F.col("top.id"))).alias("refers_to"),
        F.create_map(F.lit("X-Payload-Length"), F.col("size").cast("string")).alias("headers"),
        F.when(revisit, None).otherwise(F.col("payload")).alias("payload"),
    )


def page_id(urn: str) -> Column:
    return F.expr(f"try_cast(regexp_extract({urn}, '<urn:x-page:(.*)>', 1) as bigint)")


def archived_pages(pages: DataFrame, **columns: str) -> DataFrame:
    """Writes an archive of ``pages`` and reads it back: id, size and digest of the full payload, record type, what it revisits.

    Size and digest of a response are taken from the payload that was read; those of a revisit stand in its headers, and
    revisits are read without payloads. Null html is empty; an empty table gives no rows.
    """
    spark = pages.sparkSession
    path = run_folder(spark, "warc")
    write_warc(archive_records(pages, **columns), path)
    responses = read_warc(spark, path, ["record_id", "record_type", "payload"]).filter("record_type = 'response'")
    revisits = read_warc(spark, path, ["record_id", "record_type", "payload_digest", "refers_to", "headers"]).filter("record_type = 'revisit'")
    return responses.select(
        page_id("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(revisits.select(
        page_id("record_id").alias("page_id"), F.element_at("headers", "X-Payload-Length").cast("long").alias("payload_bytes"),
        "payload_digest", "record_type", page_id("refers_to").alias("refers_to"),
    ))
