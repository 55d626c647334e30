"""WARC records in ZIP packages: written by tasks, read back by ranges without extraction.

A package holds two stored members: archive/data.warc.gz, where every record is a gzip member of
its own, and indexes/index.jsonl, one line with offset and length for each record. The reader
parses the central directory, with ZIP64 fields where they are used, finds where the stored bytes of
both members lie, and reads records by their ranges.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievetally.llm.common import open_new, open_range, qualified
from sievetally.session import cut_lineage, scratch_dir

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
# Payload bytes after which a task begins another package.
ROLL_BYTES = 256 * 1024 * 1024
# Neighbouring records are read together up to this size.
READ_BYTES = 4 * 1024 * 1024
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# --- ZIP directories (fixed layout of the file format) ---
_END = struct.Struct("<4s4H2LH")
_END64_PLACE = struct.Struct("<4sLQL")
_END64 = struct.Struct("<4sQ2H2L4Q")
_ENTRY = struct.Struct("<4s6H3L5H2L")
_LOCAL = struct.Struct("<4s5H3L2H")
_FULL32, _FULL16 = 0xFFFFFFFF, 0xFFFF


@dataclass(frozen=True)
class Member:
    name: str
    start: int
    size: int


def _directory(file: pa.NativeFile) -> tuple[int, int, int]:
    """(entries, bytes, start) of the central directory."""
    total = file.size()
    tail_size = min(total, _END.size + 0xFFFF)
    tail = file.read_at(tail_size, total - tail_size)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + _END.size + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of a central directory")
    _, _, _, _, entries, size, start, _ = _END.unpack_from(tail, at)
    place = total - tail_size + at - _END64_PLACE.size
    if place >= 0 and (found := file.read_at(_END64_PLACE.size, place))[:4] == b"PK\x06\x07":
        end64 = _END64.unpack(file.read_at(_END64.size, _END64_PLACE.unpack(found)[2]))
        if end64[0] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of a central directory where its locator points")
        entries, size, start = (wide if narrow in (_FULL16, _FULL32) else narrow for narrow, wide in ((entries, end64[7]), (size, end64[8]), (start, end64[9])))
    return entries, size, start


def _wide(extra: bytes, fields: list[int]) -> list[int]:
    """fields, those of all ones replaced from the ZIP64 extra field, which lists them in order."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            return [next(values) if x == _FULL32 else x for x in fields]
        at += 4 + size
    return fields


def stored_members(file: pa.NativeFile) -> dict[str, Member]:
    """Where the bytes of every stored member of a ZIP package lie. A compressed or encrypted one is an error."""
    entries, size, start = _directory(file)
    directory, at, members = file.read_at(size, start), 0, {}
    for _ in range(entries):
        mark, _, _, flags, method, _, _, _, packed, plain, name_size, extra_size, note_size, _, _, _, local = _ENTRY.unpack_from(directory, at)
        if mark != b"PK\x01\x02":
            raise ValueError("broken central directory")
        at += _ENTRY.size
        name = directory[at : at + name_size].decode("utf-8" if flags & 0x800 else "cp437")
        plain, packed, local = _wide(directory[at + name_size : at + name_size + extra_size], [plain, packed, local])
        at += name_size + extra_size + note_size
        if method or flags & 1 or plain != packed:
            raise ValueError(f"{name} is not stored")
        head = _LOCAL.unpack(file.read_at(_LOCAL.size, local))
        if head[0] != b"PK\x03\x04":
            raise ValueError(f"no local header for {name}")
        members[name] = Member(name, local + _LOCAL.size + head[9] + head[10], plain)
    return members


# --- Records ---
def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page: object) -> str:
    return "<urn:page:>" if page is None else f"<urn:page:{page}>"


def _page(urn: str | None) -> int | None:
    return int(urn[len("<urn:page:") : -1]) if urn and urn != _urn(None) else None


def format_record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A response record, or a revisit with the HTTP headers of the full payload and no body."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c for c in url or "urn:none:" if c >= " ")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page)}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload (null in a revisit).

    The digest of a response is taken from its payload and must equal the header's.
    """
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [int(x.partition(b":")[2]) for x in http.split(b"\r\n")[1:] if x.lower().startswith(b"content-length:")]
    digest, revisit = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"] == "revisit"
    if not revisit and (payload_digest(payload) != digest or sizes != [len(payload)]):
        raise ValueError(f"damaged payload of {fields['warc-record-id']}")
    return {"page_id": _page(fields["warc-record-id"]), "url": fields["warc-target-uri"], "record_type": fields["warc-type"], "refers_to": _page(fields.get("warc-refers-to")), "payload_bytes": sizes[0], "payload_digest": digest, "payload": None if revisit else payload}


class _Package:
    """One package being written: records stream into the archive member, the index follows as the second member."""

    def __init__(self, uri: str):
        self.uri, self.index, self.offset, self.payload_bytes = uri, [], 0, 0
        self.out = open_new(uri)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)

    def add(self, record: bytes, payload_bytes: int) -> None:
        packed = gzip.compress(record, 1, mtime=0)
        self.member.write(packed)
        self.index.append(json.dumps({"offset": self.offset, "length": len(packed)}))
        self.offset += len(packed)
        self.payload_bytes += payload_bytes

    def close(self) -> tuple[str, int]:
        self.member.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as member:
            member.write("".join(f"{x}\n" for x in self.index).encode())
        self.zip.close()
        self.out.close()
        return self.uri, len(self.index)


# --- Spark jobs ---
def mark_revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """pages (page_id, url, html) with `first`: the smallest page_id of an equal payload, where the row has to refer to it, else null.

    Only pairs of id and digest are grouped by digest; payloads move once, by id and digest, so a
    payload that a third of all pages share meets in no task. Rows that hold the smallest id
    themselves (repeated ids too) and payloads under min_bytes have null. A null id comes after all
    others; where all ids of a payload are null, so is `first`.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col("url"), payload.alias("html"), F.sha1(payload.cast("binary")).alias("digest"))
    keys = rows.where(F.octet_length("html") >= min_bytes).select("page_id", "digest").distinct()
    firsts = keys.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    later = keys.join(firsts, "digest").where("page_id IS NULL OR page_id > first")
    later = later.select(F.col("page_id").alias("own"), F.col("digest").alias("same"), "first")
    mine = F.col("page_id").eqNullSafe(F.col("own")) & (F.col("digest") == F.col("same"))
    return rows.join(later, mine, "left").select("page_id", "url", "html", "first")


def write_packages(marked: DataFrame, folder: str | None = None, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes the rows of mark_revisits() into packages; returns (file, n) of those of the tasks that succeeded.

    A task holds one record and the index of the package that it writes.
    """
    spark = marked.sparkSession
    folder = qualified(spark, folder or scratch_dir(spark, "warc"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for page, url, html, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if package is None:
                    package = _Package(f"{folder}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.zip")
                payload = html.encode("utf-8", "surrogatepass")
                package.add(format_record(page, url, payload, first, first is not None), len(payload))
                if package.payload_bytes >= roll_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        if done:
            files, counts = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(files), pa.array(counts, pa.int64())], names=["file", "n"])

    return cut_lineage(marked.select("page_id", "url", "html", "first").mapInArrow(write, "file string, n long"), "packages")


def _ranges(index: bytes) -> list[list[tuple[int, int]]]:
    """(offset, length) of every record, neighbours together up to READ_BYTES."""
    groups: list[list[tuple[int, int]]] = []
    for line in index.splitlines():
        x = json.loads(line)
        offset, length = x["offset"], x["length"]
        if groups and sum(groups[-1][-1]) == offset and offset + length - groups[-1][0][0] <= READ_BYTES:
            groups[-1].append((offset, length))
        else:
            groups.append([(offset, length)])
    return groups


def read_packages(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of every record in the packages named by files (file).

    payload is null for revisits, and for all unless with_payload; digests are checked in any case.
    A task holds the index of a package and READ_BYTES of records, or one longer record.
    """
    schema = T.StructType.fromDDL("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")
    arrow = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with open_range(uri) as file:
                    members = stored_members(file)
                    archive, index = members[ARCHIVE], members[INDEX]
                    for group in _ranges(file.read_at(index.size, index.start)):
                        first = group[0][0]
                        packed = file.read_at(sum(group[-1]) - first, archive.start + first)
                        records = [parse_record(gzip.decompress(packed[o - first : o - first + n])) for o, n in group]
                        yield pa.RecordBatch.from_pylist(records if with_payload else [r | {"payload": None} for r in records], schema=arrow)

    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("file").repartition(parts, "file").mapInArrow(read, schema)


def archive_pages(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Archives every row of pages and returns the records as read back, without payloads.

    A null payload is an empty one, and empty payloads equal one another. An empty table writes no
    package and gives no rows.
    """
    return read_packages(write_packages(mark_revisits(pages, id_col, payload_col, min_bytes)).select("file"), with_payload=False)
