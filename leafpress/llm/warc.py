"""WARC archives as a PySpark data source.

Writing: each task writes one archive of gzip members, a record each, beside its final name and moves it there when
complete, so a lost attempt leaves nothing that a reader sees.  Reading: the driver lists the files and plans them into
partitions; predicates on record type and headers are pushed into the reader, which parses a record's headers first and
seeks past a record that fails them, and past every payload when no payload column is asked for, without inflating it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from leafpress.storage import new_path

SCHEMA = "file string, record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, payload_length long, content_length long, payload binary, digest_ok boolean"
#: Header of each column that a predicate can be pushed to.
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
_READ = 1 << 18
_BATCH_BYTES, _BATCH_ROWS = 8 << 20, 2000


def digest_of(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open_fs(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


#: Extra field of a gzip header that holds the member's length, so that a reader may skip it unread.  Other tools ignore it.
_EXTRA = b"LM"


def record(fields: dict[str, str | None], block: bytes) -> bytes:
    """One record as a gzip member whose headers and block are separate deflate runs, and whose length its header tells."""
    lines = [f"{k}: {quote(v, safe=' !#$%&()*+,-./:;<=>?@[]^_{|}~') if k == 'WARC-Target-URI' else v}" for k, v in fields.items() if v is not None]
    head = ("WARC/1.1\r\n" + "\r\n".join(lines) + f"\r\nContent-Length: {len(block)}\r\n\r\n").encode()
    packer, tail = zlib.compressobj(3, zlib.DEFLATED, -15), block + b"\r\n\r\n"
    body = packer.compress(head) + packer.flush(zlib.Z_FULL_FLUSH) + packer.compress(tail) + packer.flush()
    check = struct.pack("<II", zlib.crc32(tail, zlib.crc32(head)), (len(head) + len(tail)) & 0xFFFFFFFF)
    start = b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H2sHQ", 12, _EXTRA, 8, 24 + len(body) + len(check))
    return start + body + check


class Committed(WriterCommitMessage):
    def __init__(self, temporary: str, final: str):
        self.temporary, self.final = temporary, final


class WarcWriter(DataSourceArrowWriter):
    """Rows: record_id, record_type, target_uri, date, refers_to, payload_digest, payload (null: no block)."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Committed:
        system, root = _open_fs(self.path)
        system.create_dir(root, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        with system.open_output_stream(f"{root}/.{name}", compression=None) as out:
            for batch in iterator:
                for row in batch.to_pylist():
                    payload = row["payload"]
                    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
                    fields = {"WARC-Type": row["record_type"], "WARC-Record-ID": row["record_id"], "WARC-Date": row["date"], "WARC-Target-URI": row["target_uri"], "WARC-Refers-To": row["refers_to"], "WARC-Payload-Digest": f"sha1:{row['payload_digest']}", "X-Payload-Length": str(row["payload_length"])}
                    if row["record_type"] == "revisit":
                        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                    fields["Content-Type"] = "application/http; msgtype=response"
                    out.write(record(fields, http + (b"" if payload is None else payload)))
        return Committed(f"{root}/.{name}", f"{root}/{name}")

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, _ = _open_fs(self.path)
        for m in messages:
            if m is not None:
                system.move(m.temporary, m.final)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, _ = _open_fs(self.path)
        for m in messages:
            if m is not None:
                system.delete_file(m.temporary)


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _Members:
    """A file of gzip members: parses a member's header lines, then reads or skips the rest of it.

    ``bytes_read`` counts what is read of the file.  A member that tells its length is skipped by seeking; others are inflated
    to their end, piece by piece, and dropped.
    """

    def __init__(self, file: pa.NativeFile):
        self.file, self.size, self.at = file, file.size(), 0  # where ``raw`` begins
        self.raw, self.bytes_read, self.ends = b"", 0, None

    def _more(self) -> bool:
        """Read on behind ``raw``."""
        data = self.file.read_at(min(_READ, self.size - self.at - len(self.raw)), self.at + len(self.raw))
        self.raw += data
        self.bytes_read += len(data)
        return bool(data)

    def _inflate(self, most: int = 0) -> bytes | None:
        """The next bytes of this member, None at its end."""
        while True:
            if self.packer.eof:
                self._drop(len(self.raw) - len(self.packer.unused_data))
                return None
            if held := self.packer.unconsumed_tail:
                data = self.packer.decompress(held, most)
            else:
                self._drop(len(self.raw))
                if not self._more():
                    raise EOFError("a record is cut short")
                data = self.packer.decompress(self.raw, most)
            if data:
                return data

    def _drop(self, n: int) -> None:
        self.at, self.raw = self.at + n, self.raw[n:]

    def headers(self) -> dict[str, str] | None:
        while len(self.raw) < 24 and self.at + len(self.raw) < self.size:
            self._more()
        if not self.raw:
            return None
        told = self.raw[:2] == b"\x1f\x8b" and len(self.raw) >= 24 and self.raw[3] & 4 and self.raw[12:14] == _EXTRA
        self.ends = self.at + struct.unpack("<Q", self.raw[16:24])[0] if told else None
        self.packer, self.held = zlib.decompressobj(31), b""
        data = self.packer.decompress(self.raw, 4096)
        while b"\r\n\r\n" not in self.held:
            self.held += data
            if b"\r\n\r\n" not in self.held and (data := self._inflate(4096)) is None:
                raise EOFError("a record has no end of headers")
        head, _, self.held = self.held.partition(b"\r\n\r\n")
        lines = (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])
        return {k.strip().lower(): v.strip() for k, _, v in lines}

    def block(self, length: int) -> bytes:
        parts = [self.held]
        while (data := self._inflate()) is not None:
            parts.append(data)
        return b"".join(parts)[:length]

    def skip(self) -> None:
        """To the next member."""
        if self.ends is None:
            while self._inflate(1 << 16) is not None:
                pass
        elif self.ends <= self.at + len(self.raw):
            self._drop(self.ends - self.at)
        else:
            self.at, self.raw = self.ends, b""


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, options: dict[str, str]):
        self.path, self.names, self.types = path, [f.name for f in schema], schema
        self.wanted: dict[str, set[str]] = {}
        self.starts: dict[str, str] = {}
        self.split = int(options.get("filesPerPartition", "1"))

    def pushFilters(self, filters: list) -> Iterable:
        """Takes equality, IN and prefix predicates on header columns; all others stay with Spark."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if column in HEADERS and column != "payload_digest" and values is not None and all(isinstance(v, str) for v in values):
                self.wanted[column] = self.wanted.get(column, values) & values
            elif column in HEADERS and column != "payload_digest" and isinstance(f, StringStartsWith) and column not in self.starts:
                self.starts[column] = f.value
            else:
                yield f

    def partitions(self) -> list[Files]:
        system, root = _open_fs(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)) if system.get_file_info(root).type != fs.FileType.File else [system.get_file_info(root)]
        paths = sorted((-x.size, x.path) for x in found if x.type == fs.FileType.File and not x.base_name.startswith((".", "_")))
        groups = [Files([p for _, p in paths[k : k + self.split]]) for k in range(0, len(paths), self.split)]
        return groups or [Files([])]

    def _passes(self, head: dict[str, str]) -> bool:
        return all(head.get(HEADERS[c]) in v for c, v in self.wanted.items()) and all((head.get(HEADERS[c]) or "").startswith(v) and HEADERS[c] in head for c, v in self.starts.items())

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = _open_fs(self.path)
        needs_block = not {"payload", "digest_ok"}.isdisjoint(self.names)
        types = {"payload": pa.binary(), "payload_length": pa.int64(), "content_length": pa.int64(), "digest_ok": pa.bool_()}
        schema = pa.schema([(n, types.get(n, pa.string())) for n in self.names])
        rows, held = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as file:
                member = _Members(file)
                while (head := member.headers()) is not None:
                    if not self._passes(head):
                        member.skip()
                        continue
                    row = {c: head.get(h) for c, h in HEADERS.items()} | {"file": path, "content_length": int(head["content-length"]), "payload_length": int(head["x-payload-length"]) if "x-payload-length" in head else None, "payload": None, "digest_ok": None}
                    row["payload_digest"] = (row["payload_digest"] or "").removeprefix("sha1:") or None
                    if needs_block and row["record_type"] != "revisit":
                        block = member.block(row["content_length"])
                        row["payload"] = block.partition(b"\r\n\r\n")[2] if head.get("content-type", "").startswith("application/http") else block
                        row["digest_ok"] = digest_of(row["payload"]) == row["payload_digest"]
                        held += len(row["payload"])
                    else:
                        member.skip()
                    rows.append(row)
                    if held > _BATCH_BYTES or len(rows) >= _BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist([{n: r[n] for n in self.names} for r in rows], schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([{n: r[n] for n in self.names} for r in rows], schema)


class WarcDataSource(DataSource):
    """``spark.read.format("warc").schema(columns wanted).load(path)`` and ``df.write.format("warc").save(path)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The named columns of ``SCHEMA``; without ``payload`` and ``digest_ok`` no payload is decoded."""
    register(spark)
    kinds = dict(x.split(" ") for x in SCHEMA.split(", "))
    return spark.read.format("warc").schema(", ".join(f"{c} {kinds[c]}" for c in columns)).load(path)


def page_uri(column: str) -> str:
    return f"concat('<urn:page:', {column}, '>')"


def write_pages(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a record per row of (page_id, url, html); payload: html in UTF-8, null as empty.

    Of records with equal payloads of at least ``least_bytes`` bytes, that with the largest page_id is the response
    and the others revisit it; smaller payloads are all responses.  Null page_id: always a response, without a number in its record id.
    Null url: no target header; signs that a header cannot hold are percent-encoded.  Rows that repeat a page_id and payload
    all are responses if that page is the response.  Other columns are ignored; no rows give an archive without records.
    """
    register(pages.sparkSession)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumn("sha", F.sha1("payload"))
    eligible = F.expr(f"octet_length(payload) >= {least_bytes} and page_id is not null")
    first = rows.where(eligible).groupBy("sha").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = rows.join(first, "sha", "left").withColumn("revisits", F.expr(f"coalesce(octet_length(payload) >= {least_bytes} and page_id < first_id, false)"))
    sign = F.expr("transform(sequence(0, 31), k -> substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', int(conv(substring(lpad(conv(substring(sha, 10 * int(k / 8) + 1, 10), 16, 2), 40, '0'), 5 * (k % 8) + 1, 5), 2, 10)) + 1, 1))")
    out = joined.select(
        F.coalesce(F.expr(page_uri("page_id")), F.lit("<urn:page:>")).alias("record_id"),
        F.when(F.col("revisits"), "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.when(F.col("revisits"), F.expr(page_uri("first_id"))).alias("refers_to"),
        F.array_join(sign, "").alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_length"),
        F.when(~F.col("revisits"), F.col("payload")).alias("payload"),
    )
    out.write.format("warc").mode("append").save(path)


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """Per record read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Responses are measured on the decoded payload; a payload that does not match its digest raises.
    """
    number = "cast(nullif(regexp_extract({}, 'urn:page:(-?[0-9]*)>', 1), '') as long)"
    rows = read_warc(spark, path, ["record_id", "record_type", "refers_to", "payload_digest", "payload_length", "payload", "digest_ok"])
    digest = F.when(F.col("digest_ok") | (F.col("record_type") == "revisit"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("payload does not match its digest")).cast("string"))
    length = F.coalesce(F.octet_length("payload").cast("long"), F.col("payload_length"))
    return rows.select(F.expr(number.format("record_id")).alias("page_id"), length.alias("payload_bytes"), digest.alias("payload_digest"), "record_type", F.expr(number.format("refers_to")).alias("refers_to"))


def archive_and_read(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    path = new_path(pages.sparkSession, "warc")
    write_pages(pages, path, least_bytes)
    return page_records(pages.sparkSession, path)
