"""WARC archives: a writer that gives the same files for the same records, and a reader."""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetrisk.llm.common import lookup, staged
from fleetrisk.llm.sharding import hex_key, range_of, splitters

#: Payloads from this many bytes on are written once.
LEAST_REVISIT_BYTES = 100
#: Compressed bytes after which a file is full.
FILE_BYTES = 1 << 30
_SPACE = uuid.UUID("8b0c2f4e-5d0a-5c53-9a4e-2f1d6a7b9c10")
_MANIFEST = "temporary string, name string, records long, bytes long, sha256 string"
_RECORDS = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, "
            "refers_to long")


def _record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, str(page))}>"


def _value(text: str) -> str:
    """A header value on one line."""
    return "".join(f"%{b:02X}" if b < 32 or b == 127 else chr(b) for b in text.encode()).encode("latin-1").decode(errors="replace")


def record(row: dict, date: str) -> bytes:
    """One record: a response, or a revisit with the response's headers and no payload."""
    revisit = row["refers_to"] is not None
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['payload_bytes']}\r\n\r\n").encode()
    block = http if revisit else http + row["payload"]
    head = {
        "WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": _record_id(row["page_id"]), "WARC-Date": date,
        "WARC-Target-URI": None if row["url"] is None else _value(row["url"]),
        "WARC-Payload-Digest": f"sha256:{row['payload_digest']}", "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "X-Page-Id": row["page_id"],
    }
    if revisit:
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 "WARC-Refers-To": _record_id(row["refers_to"]), "X-Refers-To-Page-Id": row["refers_to"]}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(stream) -> Iterator[tuple[dict, bytes]]:
    """The headers and blocks of an uncompressed stream."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[name] = value
        block = stream.read(int(head["Content-Length"]))
        if f"sha256:{hashlib.sha256(block).hexdigest()}" != head["WARC-Block-Digest"] or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {head['WARC-Record-ID']} is damaged")
        yield head, block


class _Files:
    """The archive files that one task writes, under temporary names."""

    def __init__(self, path: str, file_bytes: int):
        self.fs, self.base = fs.FileSystem.from_uri(path)
        self.file_bytes, self.range, self.out = file_bytes, None, None

    def put(self, range_: int, member: bytes) -> dict | None:
        """Appends a member; gives the file that this has ended, if any."""
        done = None
        if self.out is None or range_ != self.range or self.bytes + len(member) > self.file_bytes:
            done = self.close()
            self.number = self.number + 1 if range_ == self.range else 0
            self.range, self.records, self.bytes, self.hash = range_, 0, 0, hashlib.sha256()
            self.name = f"pages-{range_:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
            self.fs.create_dir(f"{self.base}/_temporary", recursive=True)
            self.out = self.fs.open_output_stream(f"{self.base}/{self.temporary}", compression=None)
        self.out.write(member)
        self.hash.update(member)
        self.records, self.bytes = self.records + 1, self.bytes + len(member)
        return done

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        return {"temporary": self.temporary, "name": self.name, "records": self.records, "bytes": self.bytes,
                "sha256": self.hash.hexdigest()}


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_MANIFEST_SCHEMA = pa.schema([("temporary", pa.string()), ("name", pa.string()), ("records", pa.int64()),
                              ("bytes", pa.int64()), ("sha256", pa.string())])
_RECORD_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def with_revisits(pages: DataFrame, payload: Column) -> DataFrame:
    """pages (page_id, url) with payload, its size and digest, and refers_to: the first page of an equal payload."""
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns({
        "payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    rows = rows.withColumn("_h", F.xxhash64("payload_digest"))
    large = rows.filter(F.col("payload_bytes") >= LEAST_REVISIT_BYTES)
    groups = large.groupBy("_h", "payload_digest").agg(F.min("page_id").alias("_first"), F.count("*").alias("_copies"))
    groups = staged(groups.filter(F.col("_copies") > 1), "copies")
    rows = lookup(rows.withColumn("_deal", hex_key(F.col("page_id"))), groups, ["_h", "payload_digest"], "_copies", "_deal", ["_first"])
    other = ~F.coalesce(F.col("page_id") == F.col("_first"), F.lit(False))
    return rows.withColumn("refers_to", F.when(other, F.col("_first"))).drop("_h", "_deal", "_first")


def write_warc(pages: DataFrame, path: str, payload_col: str = "html", file_bytes: int = FILE_BYTES, range_bytes: int = 1 << 28,
               least_ranges: int = 48, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes a record for each of pages (page_id, url, payload_col) under path, a URI that executors can reach.

    Records are range-sorted by page_id (null first), then digest. Each range is written by one task to files
    that are ended before they would pass file_bytes compressed (a larger record has its own). Ranges,
    order and contents depend on the records only, so the same records give the same files. Of payloads that are equal
    and have 100 bytes or more, that of the smallest page_id is a response and the others revisit it; rows that
    repeat this page_id are responses too, and so is a group that has no page_id at all. A null payload is empty.

    Tasks write under temporary names, and only names that a finished task reports come into the manifest; then
    the files are renamed, and the manifest of the final names is the commit. A lost task leaves a file that no
    manifest names. Other columns are not written. An empty table gives a manifest without files.
    """
    text = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    keys = staged(pages.select(hex_key(F.col("page_id")).alias("_key"), (F.octet_length(text) + 500).cast("long").alias("_weight")), "keys")
    total = keys.agg(F.sum("_weight")).first()[0] or 0
    bounds, _ = splitters(keys, max(least_ranges, total // range_bytes), total)
    rows = with_revisits(pages, text).withColumn("_range", range_of(hex_key(F.col("page_id")), bounds))
    rows = rows.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")))
    rows = rows.repartition(max(1, len(bounds) + 1), "_range").sortWithinPartitions("_range", hex_key(F.col("page_id")), "payload_digest")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, done = _Files(path, file_bytes), []
        for batch in batches:
            for row in batch.to_pylist():
                ended = files.put(row["_range"], gzip.compress(record(row, date), 6, mtime=0))
                done += [ended] if ended else []
        ended = files.close()
        yield _batch(done + ([ended] if ended else []), _MANIFEST_SCHEMA)

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(path)
        for batch in batches:
            for row in batch.to_pylist():
                if store.get_file_info(f"{base}/{row['temporary']}").type != fs.FileType.NotFound:
                    store.move(f"{base}/{row['temporary']}", f"{base}/{row['name']}")
                if store.get_file_info(f"{base}/{row['name']}").size != row["bytes"]:
                    raise OSError(f"{row['name']} is not complete")
            yield batch

    rows.mapInArrow(write, _MANIFEST).write.parquet(f"{path}/_written")
    spark = pages.sparkSession
    spark.read.schema(_MANIFEST).parquet(f"{path}/_written").mapInArrow(rename, _MANIFEST).write.parquet(f"{path}/_manifest")


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives that the manifest names, checked against their digests; a task for each file.

    A revisit's payload is null; its size and digest are those of its headers.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(path)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, size = [], 0
                with store.open_input_stream(f"{base}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for head, block in parse(stream):
                        rows.append(_row(head, block, payloads))
                        size += len(block) * payloads + 500
                        if size > 1 << 24:
                            yield _batch(rows, _RECORD_SCHEMA)
                            rows, size = [], 0
                yield _batch(rows, _RECORD_SCHEMA)

    manifest = spark.read.schema(_MANIFEST).parquet(f"{path}/_manifest").select("name")
    files = manifest.count()
    return manifest.repartition(max(1, files), "name").mapInArrow(read, _RECORDS)


def _row(head: dict, block: bytes, payloads: bool) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = head["WARC-Type"]
    if kind == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
        raise ValueError(f"the payload of {head['WARC-Record-ID']} is damaged")
    number = lambda name: int(head[name]) if name in head else None
    return {"page_id": number("X-Page-Id"), "url": head.get("WARC-Target-URI"),
            "payload": payload if payloads and kind == "response" else None, "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": number("X-Refers-To-Page-Id")}
