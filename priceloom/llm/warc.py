"""WARC archives: a Spark data source that writes and reads them.

Writing: one gzip member per record, with the member's length in its ``sl`` extra field (WARC 1.0, annex D), so that a reader can step over
a payload without inflating it.  A task writes files of bounded size under names of its own attempt; the commit lists the files that count
in a manifest, so attempts of lost executors leave nothing visible.

Reading: the driver plans partitions from the manifest (or the directory), packing small files together.  Predicates on record type
and headers are pushed down; a record's headers are inflated and parsed first, and its payload only if the record is wanted and payloads are
asked for (option ``payload``).
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, WriterCommitMessage

from priceloom.llm.common import batch, materialize, new_path
from priceloom.session import ship_code

SCHEMA = "record_id string, record_type string, target_uri string, date string, payload_digest string, refers_to string, payload_length long, payload binary"
_ARROW = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload_length", pa.int64()), ("payload", pa.binary())])
#: WARC header of each column that predicates can be pushed to.
_HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}
_SAME = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
MANIFEST = "_files.json"
_FIRST = 4096


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _clean(value: str) -> str:
    """A header value on one line: control characters become percent escapes."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(record_id: str, record_type: str, uri: str, date: str, digest: str, refers_to: str | None, payload: bytes | None, payload_length: int) -> bytes:
    """An uncompressed record.  A revisit has the HTTP headers of its payload, ``Content-Length`` included, and no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % payload_length
    body = http if record_type == "revisit" else http + (payload or b"")
    head = [
        "WARC/1.0", f"WARC-Type: {record_type}", f"WARC-Record-ID: <{_clean(record_id)}>", f"WARC-Date: {date}", f"WARC-Target-URI: {_clean(uri)}",
        f"WARC-Payload-Digest: sha1:{digest}", *([f"WARC-Refers-To: <{_clean(refers_to)}>", f"WARC-Profile: {_SAME}"] if refers_to is not None else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", "",
    ]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def member(data: bytes, level: int = 4) -> bytes:
    """A gzip member with its compressed and plain length in the ``sl`` extra field."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    size = 12 + 12 + len(body) + 8
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\x03" + struct.pack("<H2sHII", 12, b"sl", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _fields(head: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def _bare(value: str | None) -> str | None:
    return value[1:-1] if value and value.startswith("<") and value.endswith(">") else value


def _column(headers: dict[str, str], name: str) -> str | None:
    value = _bare(headers.get(_HEADERS[name]))
    return value.removeprefix("sha1:") if name == "payload_digest" and value else value


def records(f, size: int, wanted=lambda headers: True, payload: bool = True):
    """(headers, HTTP headers, payload or None) of each wanted record of an open file of ``size`` bytes, gzip members or plain."""
    at = 0
    while at < size:
        f.seek(at)
        data = f.read(_FIRST)
        if data[:2] == b"\x1f\x8b":
            length = 0
            if data[3] & 4:
                xlen = struct.unpack_from("<H", data, 10)[0]
                k = 12
                while k + 4 <= 12 + xlen:
                    tag, n = data[k : k + 2], struct.unpack_from("<H", data, k + 2)[0]
                    if tag == b"sl":
                        length = struct.unpack_from("<I", data, k + 4)[0]
                    k += 4 + n
            z = zlib.decompressobj(31)
            plain, fed = z.decompress(data, 1 << 14), len(data)

            def more(z=z):
                nonlocal plain, fed
                if z.eof:
                    return False
                chunk = z.unconsumed_tail
                if not chunk:
                    f.seek(at + fed)
                    chunk = f.read(1 << 18)
                    fed += len(chunk)
                    if not chunk:
                        return False
                plain += z.decompress(chunk, 1 << 20)
                return True
        else:
            plain, fed, length, z = data, len(data), -1, None

            def more():
                nonlocal plain, fed
                f.seek(at + fed)
                chunk = f.read(1 << 18)
                fed += len(chunk)
                plain += chunk
                return bool(chunk)

        while (end := plain.find(b"\r\n\r\n")) < 0 and more():
            pass
        if end < 0:
            return
        headers = _fields(plain[:end])
        block = int(headers.get("content-length", 0))
        http, body = None, None
        if wanted(headers):
            while (cut := plain.find(b"\r\n\r\n", end + 4)) < 0 and len(plain) < end + 4 + block and more():
                pass
            http = _fields(plain[end + 4 : cut]) if 0 <= cut < end + 4 + block else {}
            if payload:
                while len(plain) < end + 4 + block and more():
                    pass
                body = plain[cut + 4 if http else end + 4 : end + 4 + block]
            yield headers, http, body
        if z is None:
            at += end + 4 + block + 4
        elif length:
            at += length
        else:
            while more():
                plain = plain[-1:]
            at += fed - len(z.unused_data)


@dataclass
class _Files(InputPartition):
    paths: tuple[tuple[str, int], ...]

    def __post_init__(self):
        super().__init__(self.paths)


@dataclass
class _Wrote(WriterCommitMessage):
    files: tuple[tuple[str, int], ...]


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload = options["path"], options.get("payload", "true").lower() == "true"
        self.pack = int(options.get("split_bytes", 64 << 20))
        self.equal: list[tuple[str, tuple]] = []

    def pushFilters(self, filters):
        for x in filters:
            name = x.attribute[0] if getattr(x, "attribute", None) and len(x.attribute) == 1 else None
            if name in _HEADERS and isinstance(x, EqualTo):
                self.equal.append((name, (x.value,)))
            elif name in _HEADERS and isinstance(x, In):
                self.equal.append((name, tuple(x.value)))
            elif name in _HEADERS and isinstance(x, IsNotNull):
                self.equal.append((name, None))
            else:
                yield x

    def partitions(self):
        store, root = open_fs(self.path)
        info = store.get_file_info(f"{root}/{MANIFEST}")
        if info.type == fs.FileType.File:
            with store.open_input_stream(info.path) as f:
                files = [(f"{root}/{name}", size) for name, size in json.loads(f.read())]
        else:
            found = store.get_file_info(fs.FileSelector(root, recursive=True))
            files = [(x.path, x.size) for x in found if x.type == fs.FileType.File and x.path.endswith((".warc", ".warc.gz"))]
        out, held, size = [], [], 0
        for name, n in sorted(files):
            if held and size + n > self.pack:
                out.append(_Files(tuple(held)))
                held, size = [], 0
            held.append((name, n))
            size += n
        return [*out, *([_Files(tuple(held))] if held or not out else [])]

    def _wanted(self, headers: dict) -> bool:
        return all((v := _column(headers, name)) is not None and (values is None or v in values) for name, values in self.equal)

    def read(self, partition):
        store, _ = open_fs(self.path)
        rows, size = [], 0
        for name, n in partition.paths:
            with store.open_input_file(name) as f:
                for headers, http, body in records(f, n, self._wanted, self.payload):
                    length = int(http["content-length"]) if "content-length" in (http or {}) else (len(body) if body is not None else None)
                    rows.append([*(_column(headers, c) for c in _HEADERS), length, body if self.payload and headers.get("warc-type") != "revisit" else None])
                    size += len(body or b"") + 400
                    if size > 4 << 20:
                        yield batch(_ARROW, *zip(*rows, strict=True))
                        rows, size = [], 0
        if rows:
            yield batch(_ARROW, *zip(*rows, strict=True))


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.most, self.date = options["path"], int(options.get("file_bytes", 32 << 20)), options.get("date", "1970-01-01T00:00:00Z")

    def write(self, iterator):
        store, root = open_fs(self.path)
        store.create_dir(root, recursive=True)
        files, out, name, size = [], None, "", 0
        for b in iterator:
            for start in range(0, b.num_rows, 256):
                for r in b.slice(start, 256).to_pylist():
                    data = member(record(r["record_id"], r["record_type"], r["target_uri"] or "", r["date"] or self.date, r["payload_digest"] or "", r["refers_to"], r["payload"], r["payload_length"] or 0))
                    if out is None:
                        name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                        out.write(first := member(_info()))
                        size += len(first)
                    out.write(data)
                    size += len(data)
                    if size >= self.most:
                        out.close()
                        files.append((name, size))
                        out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return _Wrote(tuple(files))

    def commit(self, messages):
        store, root = open_fs(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{MANIFEST}") as f:
            f.write(json.dumps([x for m in messages if m for x in m.files]).encode())

    def abort(self, messages):
        store, root = open_fs(self.path)
        for m in messages:
            for name, _ in m.files if m else ():
                store.delete_file(f"{root}/{name}")


def _info() -> bytes:
    body = b"software: priceloom\r\nformat: WARC File Format 1.0\r\n"
    return b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:priceloom:writer>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(dir)`` and ``df.write.format("warc").mode("append").save(dir)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _Reader(dict(self.options))

    def writer(self, schema, overwrite: bool):
        return _Writer(dict(self.options))


def register(spark: SparkSession) -> None:
    ship_code(spark)
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


#: Groups of equal payloads that are broadcast, those of most bytes in all: a bounded table.
HOT_GROUPS = 10_000


def page_records(pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A record per page.  Of pages with equal payloads of at least ``least`` bytes, the one with the largest id is the response and the others
    revisit it; smaller payloads are all responses.  Null html is an empty payload; rows that repeat the largest id are all
    responses; a row with a null id revisits any row that has one.

    Payloads are equal if SHA-1, length and a second hash are.  Groups of equal payloads are found and written down without the payloads; the
    ``HOT_GROUPS`` heaviest are then broadcast, which drops the bodies of their revisits before anything is shuffled, and the others are joined as
    Spark sees fit: none of them is a hot key any more.
    """
    key = ["sha", "n", "x"]
    body = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), body.alias("payload")).withColumns({"sha": F.sha1("payload"), "n": F.octet_length("payload").cast("long"), "x": F.xxhash64("payload")})
    groups = rows.groupBy(*key).agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("c")).filter((F.col("c") > 1) & (F.col("n") >= least))
    groups = materialize(groups, "warc-groups")
    hot = materialize(groups.orderBy(F.desc(F.col("c") * (F.col("n") + 1)), *key).limit(HOT_GROUPS), "warc-hot")
    rest = groups.join(hot.select(*key), key, "left_anti")
    revisits = lambda last: F.col("grouped") & ~F.col("id").eqNullSafe(F.col(last))
    for number, some in enumerate((F.broadcast(hot), rest)):
        rows = rows.join(some.select(*key, F.col("last").alias(f"last{number}"), F.lit(True).alias("grouped")), key, "left").withColumn("grouped", F.coalesce("grouped", F.lit(False)))
        rows = rows.withColumn(f"revisit{number}", revisits(f"last{number}")).drop("grouped")
        rows = rows.withColumn("payload", F.when(~F.col(f"revisit{number}"), F.col("payload")))
    revisit = F.col("revisit0") | F.col("revisit1")
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("null")))
    return rows.select(
        urn(F.col("id")).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.col("url").alias("target_uri"),
        F.lit(None).cast("string").alias("date"), F.unhex("sha").alias("sha"), F.when(revisit, urn(F.coalesce("last0", "last1"))).alias("refers_to"),
        F.col("n").alias("payload_length"), "payload",
    )


def page_id(urn):
    """The integer id in ``urn:page:...``; null where there is none."""
    return F.expr(f"try_cast(substring({urn}, length('urn:page:') + 1) AS bigint)")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the response and revisit records of an archive, from the payloads read back.

    Length and digest of a response are those of the body that was read.  A revisit has no body: it is looked up among the bodies of the page it refers to, by
    its digest, and gets that body's figures; they are null if the archive has no such body.
    """
    figures = [F.octet_length("payload").cast("long").alias("payload_bytes"), _base32(F.unhex(F.sha1("payload"))).alias("payload_digest")]
    responses = read_records(spark, path).filter(F.col("record_type") == "response").select(page_id("record_id").alias("page_id"), *figures)
    revisits = read_records(spark, path, payload=False).filter(F.col("record_type") == "revisit")
    revisits = revisits.select(page_id("record_id").alias("page_id"), page_id("refers_to").alias("refers_to"), F.col("payload_digest").alias("said"))
    bodies = responses.select(F.col("page_id").alias("body_of"), "payload_bytes", "payload_digest").distinct()
    found = revisits.join(bodies, F.col("refers_to").eqNullSafe(F.col("body_of")) & (F.col("said") == F.col("payload_digest")), "left")
    columns = lambda kind, to: ["page_id", "payload_bytes", "payload_digest", F.lit(kind).alias("record_type"), to]
    return responses.select(*columns("response", F.lit(None).cast("long").alias("refers_to"))).unionByName(found.select(*columns("revisit", F.col("refers_to"))))


def write_pages(pages: DataFrame, path: str, least: int = 0, **cols) -> None:
    register(pages.sparkSession)
    rows = page_records(pages, least, **cols).withColumn("payload_digest", _base32(F.col("sha"))).drop("sha")
    rows.select(*(f.split()[0] for f in SCHEMA.split(", "))).write.format("warc").mode("append").save(path)


def _base32(raw):
    """RFC 4648 base32 of 20 bytes: groups of 5 bytes are 8 letters of 5 bits each."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for g in range(4):
        n = F.conv(F.hex(F.substring(raw, 5 * g + 1, 5)), 16, 10).cast("long")
        out += [F.substring(letters, (F.shiftright(n, 35 - 5 * i).bitwiseAND(31) + 1).cast("int"), F.lit(1)) for i in range(8)]
    return F.concat(*out)


def read_records(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def archive_path(spark: SparkSession) -> str:
    return new_path(spark, "warc")


#: The records of all pages by window functions and base32 by arithmetic; used as an oracle.
PAGES_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(d, (10 * (i // 8) + 1)::INTEGER, 10))::BIGINT >> (35 - 5 * (i % 8))::INTEGER) & 31)::INTEGER + 1, 1)), 'string_agg', '') AS payload_digest,
CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to FROM p"""
