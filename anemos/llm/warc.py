"""WARC archives: one gzip member per record, written by tasks, read back sequentially.

Writing: payloads of at least ``MIN_REVISIT`` bytes that occur again become revisit
records of the one with the smallest id. Digests are combined in each task before they
meet, and the winners go back to the pages by (digest, salt), so a payload that a third
of the pages share is spread over all tasks. Each task streams its records into
archives in the folder given, under names that no other attempt uses; the table of
archives that the job returns holds those of successful attempts only.

Reading: each archive is read from its start in blocks of 64 KB. zlib inflates one
member at a time, Content-Length frames the block while it is inflated, and block and payload digests are
verified as it goes by; anything that does not add up raises an error with archive and offset. Archives of other
writers are read, too: records of any type, digests in SHA-1 or base 32, ids that name no page.

Archives are opened through ``pyarrow.fs`` by the folder's URI, so the folder may lie in
any store that pyarrow knows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path, send_with_tasks
from .text import whole

MIN_REVISIT = 100
SALTS = 32
BLOCK = 1 << 16
ARCHIVE_BYTES = 1 << 28
HEADER_BYTES = 1 << 20
ALGORITHMS = ("sha256", "sha1", "md5", "sha512")
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:x-page:"

RECORDS = "page_id bigint, record_type string, refers_to bigint, url string, payload_bytes bigint, payload_digest string, payload binary, record_id string, refers_to_id string"


def _page_uri(page_id: int | None) -> str:
    return f"<{_ID}{'null' if page_id is None else page_id}>"


def _page_of(uri: str | None) -> int | None:
    if uri is None:
        return None
    name = uri.strip().removeprefix("<").removesuffix(">")
    # The id of another writer's record names no page.
    number = name.removeprefix(_ID) if name.startswith(_ID) else ""
    return int(number) if number.removeprefix("-").isdecimal() else None


def _one_line(url: str) -> str:
    """A URL as a header value: control characters and spaces percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP header, which tells the payload's length, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_page_uri(page_id)}",
        f"WARC-Date: {DATE}", "Content-Type: application/http;msgtype=response",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_one_line(url)}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_page_uri(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(data) + packer.flush()


def with_revisits(pages: DataFrame, salts: int = SALTS) -> DataFrame:
    """page_id, url, payload, digest, refers_to and revisit of each page."""
    payload = whole(F.col("html")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"),
                        F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int").alias("salt"))
    shared = rows.where(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest", "salt").agg(
        F.min("page_id").alias("page_id"), F.count(F.lit(1)).alias("n"))
    shared = shared.groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.sum("n").alias("n"),
        F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salt_bits")).where("n > 1")
    bits = F.filter(F.sequence(F.lit(0), F.lit(salts - 1)),
                    lambda at: F.call_function("shiftright", F.col("salt_bits"), at).bitwiseAND(F.lit(1)) == 1)
    shared = shared.select("digest", F.explode(bits).alias("salt"), "first_id")
    rows = rows.join(shared, ["digest", "salt"], "left")
    repeats = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.select("page_id", "url", "payload", "digest",
                       F.when(repeats, F.col("first_id")).alias("refers_to"), repeats.alias("revisit"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write every page into archives below ``folder``; returns path, records and bytes of each.

    ``pages`` holds page_id, url and html. A null html is an empty payload, a null url leaves
    out the header, a page with a null id is never referred to: it is a revisit if another
    page has its payload and an id. Rows that repeat the id and payload of the first are
    responses too. No rows give no archives; other columns are not read.
    """
    send_with_tasks(__name__)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out = path = None
        records = size = 0
        done = []
        for batch in batches:
            for row in zip(*(batch.column(name) for name in ("page_id", "url", "payload", "digest", "refers_to", "revisit"))):
                page_id, url, payload, digest, refers_to, revisit = (value.as_py() for value in row)
                if out is None:
                    path, records, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(path, compression=None)
                size += out.write(record_bytes(page_id, url, payload, digest, refers_to, revisit))
                records += 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((path, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, records, size))
        yield pa.RecordBatch.from_pydict({
            "path": pa.array([d[0] for d in done], pa.string()), "records": pa.array([d[1] for d in done], pa.int64()),
            "bytes": pa.array([d[2] for d in done], pa.int64())})

    return materialize(with_revisits(pages).mapInArrow(write, "path string, records bigint, bytes bigint"), "warc-archives")


class _Member:
    """One gzip member of a stream, inflated block by block as its content is asked for."""

    def __init__(self, stream, data: bytes, offset: int, where: str):
        self.stream, self.data, self.offset, self.where = stream, data, offset, f"{where} at {offset}"
        self.inflate, self.ready = zlib.decompressobj(31), b""

    def more(self) -> bool:
        """Inflate another block; False at the end of the member."""
        while not self.inflate.eof:
            if not self.data:
                self.data = self.stream.read(BLOCK)
                if not self.data:
                    raise ValueError(f"{self.where}: the member is cut off")
            try:
                found = self.inflate.decompress(self.data, BLOCK)
            except zlib.error as error:
                raise ValueError(f"{self.where}: {error}") from error
            left = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            self.offset += len(self.data) - len(left)
            self.data = left
            if found:
                self.ready += found
                return True
        return False

    def header(self, most: int = HEADER_BYTES) -> bytes:
        """What comes before the next empty line."""
        while (end := self.ready.find(b"\r\n\r\n")) < 0:
            if len(self.ready) > most or not self.more():
                raise ValueError(f"{self.where}: a header without end")
        found, self.ready = self.ready[:end], self.ready[end + 4:]
        return found

    def take(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, in parts."""
        while size:
            if not self.ready and not self.more():
                raise ValueError(f"{self.where}: Content-Length does not frame the block")
            part, self.ready = self.ready[:size], self.ready[size:]
            size -= len(part)
            yield part

    def close(self) -> None:
        """The member must end here, with the two line ends behind a block."""
        while self.more():
            if len(self.ready) > 4:
                break
        if self.ready != b"\r\n\r\n":
            raise ValueError(f"{self.where}: Content-Length does not frame the block")


def _fields(header: bytes, where: str) -> tuple[str, dict[str, str]]:
    try:
        first, *lines = header.decode("utf-8").split("\r\n")
    except UnicodeDecodeError as error:
        raise ValueError(f"{where}: a header that is no UTF-8") from error
    return first, {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _number(fields: dict[str, str], where: str) -> int:
    text = fields.get("content-length", "")
    if not text.isdecimal():
        raise ValueError(f"{where}: Content-Length is {text or 'missing'}")
    return int(text)


class _Digest:
    """A digest as a header claims it (``sha256:`` or ``sha1:`` and so on, in hexadecimal or base 32), taken part by part.
    One of an algorithm that is not known here cannot be verified."""

    def __init__(self, claim: str | None, where: str, what: str):
        name, _, self.text = (claim or "").partition(":")
        name = name.strip().lower().replace("-", "")
        self.hash = hashlib.new(name) if name in ALGORITHMS else None
        self.where, self.what = where, what

    def update(self, part: bytes) -> None:
        if self.hash is not None:
            self.hash.update(part)

    def verify(self) -> None:
        if self.hash is None:
            return
        found, text = self.hash.digest(), self.text.strip()
        base32 = base64.b32encode(found).decode()
        if text.lower() != found.hex() and text.upper().rstrip("=") != base32.rstrip("="):
            raise ValueError(f"{self.where}: {self.what} digest does not match")


def _record(member: _Member, payloads: bool) -> tuple:
    """A row of ``RECORDS``: framed, hashed and verified while the member is inflated."""
    version, head = _fields(member.header(), member.where)
    if not version.startswith("WARC/"):
        raise ValueError(f"{member.where}: not a WARC record")
    kind, length = head.get("warc-type", ""), _number(head, member.where)
    block = _Digest(head.get("warc-block-digest"), member.where, "block")
    claim = head.get("warc-payload-digest")
    revisit = kind == "revisit"
    payload = _Digest(None if revisit else claim, member.where, "payload")
    own, parts, size, http, told = hashlib.sha256(), [], 0, None, None
    is_http = head.get("content-type", "").lower().startswith("application/http") and length > 0
    waiting = b""
    for part in member.take(length):
        block.update(part)
        if is_http and http is None:
            # The HTTP header comes first; what follows its empty line is the payload.
            waiting += part
            end = waiting.find(b"\r\n\r\n")
            if end < 0:
                if len(waiting) > HEADER_BYTES:
                    break
                continue
            _, http = _fields(waiting[:end], member.where)
            part = waiting[end + 4:]
        payload.update(part)
        own.update(part)
        size += len(part)
        if payloads and not revisit:
            parts.append(part)
    if is_http and http is None:
        raise ValueError(f"{member.where}: a header without end")
    member.close()
    block.verify()
    payload.verify()
    if http is not None and "content-length" in http and "transfer-encoding" not in http:
        told = _number(http, member.where)
        if not revisit and told != size:
            raise ValueError(f"{member.where}: the payload has {size} bytes instead of {told}")
    digest = own.hexdigest()
    if revisit:
        # A revisit has no payload; what it says of it is told on.
        size, digest = told, claim.partition(":")[2] if claim else None
    record, refers = head.get("warc-record-id"), head.get("warc-refers-to")
    return (_page_of(record), kind, _page_of(refers), head.get("warc-target-uri"), size, digest,
            b"".join(parts) if payloads and not revisit else None, record, refers)


def records(stream, where: str, payloads: bool = True) -> Iterator[tuple]:
    """Rows of ``RECORDS`` from an archive, read from its start: one gzip member per record.

    Records of any type are read; only those of ``application/http`` have an HTTP header before their payload. Memory holds a block, a
    header, and, if asked for, a payload. Whatever does not add up is a ValueError that names archive and offset.
    """
    data, offset = stream.read(BLOCK), 0
    while data:
        member = _Member(stream, data, offset, where)
        yield _record(member, payloads)
        data, offset = member.data or stream.read(BLOCK), member.offset


def read_archives(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all archives listed (a column ``path``), as ``RECORDS``; without
    ``payloads`` they are read and verified but not returned."""
    send_with_tasks(__name__)
    fields = ("page_id", "record_type", "refers_to", "url", "payload_bytes", "payload_digest", "payload", "record_id", "refers_to_id")
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.string())

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=list(fields))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)
        for listed in batches:
            for path in listed.column("path").to_pylist():
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for row in records(stream, path, payloads):
                        rows.append(row)
                        size += len(row[6] or b"")
                        if len(rows) >= 1000 or size >= 1 << 24:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    # With a number of its own the shuffle is not coalesced: the list is small, what it lists is not.
    paths = archives.select("path")
    return paths.repartition(max(paths.count(), 1), "path").mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages, read the archives back: one row per record."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder, payloads=False)
