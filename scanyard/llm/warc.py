"""WARC archives: a writer with revisit records and a salvage reader.

The writer gives every row a record, each a gzip member of its own. Of rows with equal payloads of
at least ``LEAST_REVISIT`` bytes, the one with the largest id is a response; the others are
revisits that refer to it. Each task writes files under names of its own, ending one at about
``FILE_BYTES``; the manifest lists those of tasks that ended well.

The reader checks each record: the member's own checksum, version line, lengths, closing line
breaks and digests. After a failed check it searches for the next place where a gzip member or a
version line begins and a record passes, goes on from there, and logs the bytes between as a gap.
Records of a broken member that pass their digest are kept. Plain and compressed records may follow
on each other in a file. The reader holds one record at a time, of at most ``MOST_BYTES``.

Defined cases: null payloads are empty, null URLs are left out, a null id stays null; rows that
repeat the id of a response are responses; an empty table gives no files; empty files have no
records; columns other than id, URL and payload are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanyard.llm.common import findable, keep, open_folder, slices
from scanyard.operators.keymap import with_may_be_listed
from scanyard.session import shared_dir

LEAST_REVISIT = 1000
FILE_BYTES = 64 << 20
# A record at most, and its headers. Larger payloads than this a column cannot hold.
MOST_HEADERS = 8 << 20
MOST_BYTES = (1 << 31) - 1 + MOST_HEADERS
CHUNK = 1 << 18
RESPONSE, REVISIT = "response", "revisit"
DATE = "2000-01-01T00:00:00Z"
_ID = "urn:page:"
# Fixed values of the format.
VERSION = b"WARC/1.0"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
GZIP = b"\x1f\x8b\x08"
_EMPTY = re.compile(rb"\r?\n\r?\n")
_BEGIN = re.compile(rb"\x1f\x8b\x08|WARC/[01]\.\d")
_VERSION = re.compile(rb"WARC/[01]\.\d+\r?\n")


def sha1_text(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, name: str, url: str | None, payload: bytes, digest: str,
           refers_to: str | None = None, date: str = DATE) -> bytes:
    """One record as in an uncompressed file."""
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             b"Content-Length: %d\r\n\r\n" % len(payload))
    if kind == RESPONSE:
        block += payload
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", date)]
    if url is not None:
        lines.append(("WARC-Target-URI", re.sub(r"[\r\n]", "", url)))
    lines += [("WARC-Payload-Digest", digest), ("WARC-Block-Digest", sha1_text(block))]
    if kind == REVISIT:
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    lines += [("Content-Type", "application/http; msgtype=response"),
              ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in lines)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Damaged(ValueError):
    """A record that fails a check; ``needs`` says how many bytes it would take."""


@dataclass
class Record:
    kind: str
    headers: dict[str, str]
    payload: bytes
    http: dict[str, str]
    offset: int = 0
    length: int = 0


@dataclass
class Gap:
    offset: int
    length: int
    reason: str


def _fields(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("a header line without a colon")
        out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


def parse(data: bytes, at: int = 0) -> tuple[Record, int]:
    """The record at a place of some bytes, checked, and where it ends."""
    version = _VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    close = _EMPTY.search(data, version.end() - 2)
    if not close:
        raise Damaged("headers without an end")
    headers = _fields([x for x in data[version.end():close.start()].splitlines() if x])
    try:
        length = int(headers["content-length"])
    except (KeyError, ValueError):
        raise Damaged("no length") from None
    block = data[close.end():close.end() + length]
    end = close.end() + length
    if length < 0 or len(block) < length or data[end:end + 4] != b"\r\n\r\n":
        raise Damaged("a block of another length")
    if "warc-block-digest" in headers and not _same(headers["warc-block-digest"], block):
        raise Damaged("block digest")
    kind, http, payload = headers.get("warc-type", ""), {}, block
    if headers.get("content-type", "").startswith("application/http"):
        top, _, payload = block.partition(b"\r\n\r\n")
        http = _fields(top.splitlines()[1:])
    if kind == RESPONSE and not _same(headers.get("warc-payload-digest"), payload):
        raise Damaged("payload digest")
    return Record(kind, headers, payload, http), end + 4


def _same(digest: str | None, data: bytes) -> bool:
    """Whether a digest fits; digests of other kinds are not checked."""
    if not digest or not digest.lower().startswith("sha1:"):
        return True
    return digest_hex(digest) == hashlib.sha1(data).hexdigest()


def digest_hex(digest: str) -> str | None:
    """Lower-case hex of a digest given in base 32 or hex."""
    text = digest.partition(":")[2]
    try:
        return text.lower() if len(text) == 40 else base64.b32decode(text.upper()).hex()
    except ValueError:
        return None


@dataclass
class Salvage:
    """Records and gaps of an open file, in its order."""

    file: object
    most: int = MOST_BYTES
    headers: int = MOST_HEADERS
    size: int = field(init=False)

    def __post_init__(self):
        self.size = self.file.size()

    def _bytes(self, at: int, count: int) -> bytes:
        self.file.seek(at)
        return self.file.read(min(count, self.size - at))

    def __iter__(self) -> Iterator[Record | Gap]:
        at, lost, reason = 0, None, ""
        while at < self.size:
            try:
                found, end, whole = self._take(at)
            except Damaged as damage:
                if lost is None:
                    lost, reason = at, str(damage)
                at = self._next(at + 1)
                continue
            if lost is not None:
                yield Gap(lost, at - lost, reason)
                lost = None
            yield from found
            if not whole:
                # What passed was given; the rest of the member is lost.
                lost, reason = at, "a broken member"
                end = self._next(at + 1)
            at = end
        if lost is not None:
            yield Gap(lost, self.size - lost, reason)

    def _next(self, at: int) -> int:
        """The next place where a member or version line may begin, or the end."""
        while at < self.size:
            data = self._bytes(at, CHUNK)
            found = _BEGIN.search(data)
            if found:
                return at + found.start()
            at += max(len(data) - 7, 1)
        return self.size

    def _take(self, at: int) -> tuple[list[Record], int, bool]:
        if self._bytes(at, 3) == GZIP:
            return self._member(at)
        return self._plain(at)

    def _plain(self, at: int) -> tuple[list[Record], int, bool]:
        count = 1 << 16
        head = self._bytes(at, count)
        if not _VERSION.match(head):
            raise Damaged("no version line")
        # Headers end at an empty line, however far on.
        while not (close := _EMPTY.search(head)) and count < min(self.headers, self.size - at):
            count = min(4 * count, self.headers)
            head = self._bytes(at, count)
        head = head[:close.end()] if close else head
        length = re.compile(rb"(?i)\ncontent-length:\s*(\d{1,18})\s*\r?\n").search(head)
        if not length or int(length[1]) > self.most:
            raise Damaged("no length")
        data = self._bytes(at, len(head) + int(length[1]) + 4)
        got, end = parse(data)
        got.offset, got.length = at, end
        return [got], at + end, True

    def _member(self, at: int) -> tuple[list[Record], int, bool]:
        """Records of the member, where it ends, and whether all of it passed."""
        unpack, parts, total, place, whole = zlib.decompressobj(31), [], 0, at, True
        try:
            while not unpack.eof:
                data = self._bytes(place, CHUNK)
                if not data:
                    raise zlib.error("the file ends")
                place += len(data)
                parts.append(unpack.decompress(data, self.most - total + 1))
                total += len(parts[-1])
                if total > self.most:
                    raise zlib.error("too long")
        except zlib.error as error:
            if not total:
                raise Damaged(f"member: {error}") from None
            whole = False
        end = place - len(unpack.unused_data)
        data, found, inner = b"".join(parts), [], 0
        while inner < len(data):
            try:
                got, inner = parse(data, inner)
            except Damaged:
                if not found:
                    raise
                whole = False
                break
            got.offset, got.length = at, end - at
            found.append(got)
        if not whole and not found:
            raise Damaged("a broken member")
        return found, end, whole


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives under ``folder``; returns the manifest: file, records, bytes."""
    findable(pages.sparkSession)
    body = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    given = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                         body.alias("body")).withColumn("sha", F.unhex(F.sha1("body")))
    large = given.where(F.octet_length("body") >= LEAST_REVISIT)
    several = keep(large.select("id", "sha").groupBy("sha").agg(
        F.max("id").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n"), "several")
    # Payloads that may have a copy are joined with their response; the others stay where they are.
    likely = with_may_be_listed(large, F.col("sha"), several.select("sha"), "near")
    joined = likely.where("near").join(several.hint("merge"), "sha", "left")
    alone = given.where(F.octet_length("body") < LEAST_REVISIT).unionByName(
        likely.where("not near").drop("near")).withColumn(
        "head", F.lit(None).cast(given.schema["id"].dataType))
    rows = joined.drop("near").unionByName(alone)
    refers = F.when(~F.col("id").eqNullSafe(F.col("head")), F.col("head"))
    rows = rows.select("url", "body", F.col("id").cast("string").alias("id"),
                       refers.cast("string").alias("refers"))

    def run(batches):
        store, base = open_folder(folder)
        out, name, records, size = None, "", 0, 0

        def done():
            out.close()
            return pa.RecordBatch.from_pylist(
                [{"file": name, "records": records, "bytes": size}], schema=manifest)

        for batch in batches:
            for part in slices(batch):
                for row in part.to_pylist():
                    if out is None:
                        store.create_dir(base, recursive=True)
                        name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    kind = RESPONSE if row["refers"] is None else REVISIT
                    data = member(record(
                        kind, _ID + (row["id"] or ""), row["url"], row["body"],
                        sha1_text(row["body"]), _ID + (row["refers"] or "")))
                    out.write(data)
                    records, size = records + 1, size + len(data)
                    if size >= file_bytes:
                        yield done()
                        out = None
        if out is not None:
            yield done()

    manifest = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
    return keep(rows.mapInArrow(run, "file string, records long, bytes long"), "manifest")


_READ = ("file string, `offset` long, length long, gap string, record_id string, type string, "
         "url string, payload binary, payload_sha1 string, payload_bytes long, refers_to string")


def read(manifest: DataFrame, folder: str, most: int = MOST_BYTES,
         headers: int = MOST_HEADERS) -> DataFrame:
    """One row per record of the manifest's files, and one per gap, with ``gap`` its reason.

    ``most`` and ``headers`` bound what is read as one record and its headers. Size and digest are those of the full payload, for revisits as their headers tell.
    """
    findable(manifest.sparkSession)
    files = max(1, manifest.count())

    def run(batches):
        store, base = open_folder(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, size = [], 0
                with store.open_input_file(f"{base}/{name}") as file:
                    for got in Salvage(file, most, headers):
                        rows.append(_row(name, got))
                        size += rows[-1]["length"] + len(rows[-1].get("payload") or b"")
                        if size > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    texts = ("file", "gap", "record_id", "type", "url", "payload_sha1", "refers_to")
    kinds = {name: pa.string() for name in texts} | {
        name: pa.int64() for name in ("offset", "length", "payload_bytes")} | {
        "payload": pa.binary()}
    order = [part.split()[0].strip("`") for part in _READ.split(", ")]
    schema = pa.schema([(name, kinds[name]) for name in order])
    return manifest.select("file").repartition(files, "file").mapInArrow(run, _READ)


def _row(name: str, got: Record | Gap) -> dict:
    if isinstance(got, Gap):
        return {"file": name, "offset": got.offset, "length": got.length, "gap": got.reason}
    whole = got.kind != REVISIT
    told = got.http.get("content-length", "")
    return {
        "file": name, "offset": got.offset, "length": got.length,
        "record_id": got.headers.get("warc-record-id", "").strip("<>"), "type": got.kind,
        "url": got.headers.get("warc-target-uri"), "payload": got.payload if whole else None,
        "payload_sha1": hashlib.sha1(got.payload).hexdigest() if whole else
        digest_hex(got.headers.get("warc-payload-digest", "")),
        "payload_bytes": len(got.payload) if whole else int(told) if told.isdigit() else None,
        "refers_to": got.headers.get("warc-refers-to", "").strip("<>") or None}


def page_id(column):
    """The id in a record's name."""
    return F.nullif(F.substr(column, F.lit(len(_ID) + 1)), F.lit(""))


def new_folder(pages: DataFrame) -> str:
    return f"{shared_dir(pages.sparkSession)}/warc"
