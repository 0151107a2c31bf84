"""WARC records in ZIP packages: written by tasks, read back by byte ranges.

A package holds two stored members: the records, each a gzip member of its
own, and an index of their byte ranges. The reader never unpacks a package. It
reads the end of the file, follows the ZIP64 locator where there is one,
parses the central directory, finds where the members' bytes begin, range-reads
the index, and then each record alone. Packages are read through pyarrow's file
systems, so the folder may be any that those open on all executors.

Packages of other writers may hold several archive members, with indexes in CDXJ
that are plain, gzip files or deflated, and records that are plain or gzip members. Archive
members themselves must be stored. A record without this module's own fields goes by its
record id; its payload's SHA-256 is computed, or taken over for a revisit that
names it, else null, as is the size of a revisit's payload. A response whose
payload differs from a SHA-256 or SHA-1 that it names stops the read, unless its
HTTP block is in a transfer encoding, where writers disagree about what is hashed. So does an archive member
that no index names: its records would be lost unsaid.

Records with the same payload of at least ``MIN_REVISIT`` bytes are written
once, for the smallest page id; the others revisit it.

Defined results. Null html is an empty payload. A null page id comes after all
others and is kept as null; pages that repeat the smallest id of a payload are
responses as well. A null address is left out of the record. Only the named
columns are read, so extra columns of any name do no harm. No pages, no
packages.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricegrid.llm import textbuf
from pricegrid.session import scratch_dir, stage

MIN_REVISIT = 100
RECORDS = "archive/data.warc.gz"
INDEX = "indexes/index.cdxj"
ARCHIVES = (".warc", ".warc.gz")
INDEXES = (".cdxj", ".cdx", ".cdxj.gz", ".cdx.gz")
PACKAGE_BYTES = 1 << 28

# Signatures and sizes of the ZIP format.
END = b"PK\x05\x06"
END64 = b"PK\x06\x06"
LOCATOR64 = b"PK\x06\x07"
CENTRAL = b"PK\x01\x02"
LOCAL = b"PK\x03\x04"
END_SIZE = 22
LOCATOR64_SIZE = 20
MAX_COMMENT = 65535
FULL32 = 0xFFFFFFFF
FULL16 = 0xFFFF
ZIP64_EXTRA = 0x0001

# Fixed value: the profile of a revisit with the same payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_store(uri: str):
    """File system and path of an address; a bare path is a local one."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        uri = f"file://{uri}"
    elif not rest.startswith("//"):  # as in file:/folder
        uri = f"{scheme}://{rest}"
    return fs.FileSystem.from_uri(uri)


# Reading


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    packed: int
    header: int


def _zip64(extra: bytes, fields: list[tuple[int, int]]) -> list[int]:
    """Fill fields that hold their largest value from the ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_EXTRA:
            place, out = at + 4, []
            for value, full in fields:
                if value == full:
                    value = struct.unpack_from("<Q", extra, place)[0]
                    place += 8
                out.append(value)
            return out
        at += 4 + size
    return [value for value, _ in fields]


def members(source) -> dict[str, Member]:
    """The central directory of a package, from its last bytes."""
    size = source.size()
    tail_from = max(0, size - END_SIZE - MAX_COMMENT - LOCATOR64_SIZE)
    tail = source.read_at(size - tail_from, tail_from)
    # the signature may also stand in the comment: the record's comment must end the file
    end = tail.rfind(END, 0, len(tail) - END_SIZE + len(END))
    while end >= 0 and end + END_SIZE + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(END, 0, end + len(END) - 1)
    if end < 0:
        raise ValueError("no end of a central directory: not a ZIP file, or cut short")
    count, length, begin = struct.unpack_from("<HII", tail, end + 10)
    locator = end - LOCATOR64_SIZE
    if locator >= 0 and tail[locator : locator + 4] == LOCATOR64:
        record = source.read_at(56, struct.unpack_from("<Q", tail, locator + 8)[0])
        if record[:4] != END64:
            raise ValueError("the ZIP64 locator points at no ZIP64 end record")
        count, length, begin = struct.unpack_from("<QQQ", record, 32)
    directory, at, found = source.read_at(length, begin), 0, {}
    for _ in range(count):
        if directory[at : at + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method, packed, full, n, x, c, disk, header = struct.unpack_from("<10xH8xIIHHHH6xI", directory, at)
        name = directory[at + 46 : at + 46 + n].decode()
        extra = directory[at + 46 + n : at + 46 + n + x]
        full, packed, header, _ = _zip64(extra, [(full, FULL32), (packed, FULL32), (header, FULL32), (disk, FULL16)])
        found[name] = Member(name, method, full, packed, header)
        at += 46 + n + x + c
    return found


def begin_of(source, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed; only stored members have byte ranges")
    local = source.read_at(30, member.header)
    if local[:4] != LOCAL:
        raise ValueError(f"no local header of {member.name}")
    n, x = struct.unpack_from("<HH", local, 26)
    return member.header + 30 + n + x


def content_of(source, member: Member) -> bytes:
    """All bytes of a small member, such as an index."""
    if member.method == 8:
        stored = Member(member.name, 0, member.packed, member.packed, member.header)
        raw = zlib.decompress(source.read_at(member.packed, begin_of(source, stored)), -15)
    else:
        raw = source.read_at(member.size, begin_of(source, member))
    return gzip.decompress(raw) if member.name.endswith(".gz") else raw


def index_entries(source) -> list[tuple[int, int]]:
    """Absolute offset and length of each record that a package's indexes name."""
    held = members(source)
    archives = {name: begin_of(source, member) for name, member in held.items() if name.endswith(ARCHIVES) and member.size}
    # indexes name an archive member with or without its folder
    short = {name.rpartition("/")[2]: name for name in archives}
    found, named = set(), set()
    for member in held.values():
        if not member.name.endswith(INDEXES):
            continue
        for line in content_of(source, member).decode().splitlines():
            parts = line.split(" ", 2)
            if len(parts) < 3 or not parts[2].startswith("{"):  # a heading
                continue
            entry = json.loads(parts[2])
            name = entry["filename"] if entry["filename"] in archives else short.get(entry["filename"].rpartition("/")[2])
            if name is None:
                raise ValueError(f"the index {member.name} names {entry['filename']}, which is not in the package")
            named.add(name)
            found.add((archives[name] + int(entry["offset"]), int(entry["length"])))
    if named != set(archives):
        raise ValueError(f"no index names {sorted(set(archives) - named)}")
    return sorted(found)


def parse_record(packed: bytes) -> tuple[dict[str, str], bytes]:
    """Fields by lower-case name, and block, of a record, which is plain or a gzip member."""
    raw = zlib.decompressobj(31).decompress(packed) if packed[:2] == b"\x1f\x8b" else packed
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this byte range")
    fields = (line.partition(":") for line in lines[1:])
    named = {name.strip().lower(): value.strip() for name, _, value in fields}
    return named, rest[: int(named["content-length"])]


def _digest(labelled: str | None) -> tuple[str, str] | None:
    """Algorithm and lower-case hex of a digest in hex or base 32; None if it is neither SHA-256 nor SHA-1."""
    kind, _, value = (labelled or "").partition(":")
    kind = kind.lower().replace("-", "")
    size = {"sha256": 64, "sha1": 40}.get(kind)
    if size is None or len(value) == size:
        return (kind, value.lower()) if size else None
    return kind, base64.b32decode(value.upper() + "=" * (-len(value) % 8)).hex()


def result_of(packed: bytes) -> tuple[str | None, int | None, str | None, str, str | None, str | None, bytes | None]:
    """Page id, payload bytes, digest, record type, page it refers to, address, payload."""
    named, block = parse_record(packed)
    kind, digest = named["warc-type"], _digest(named.get("warc-payload-digest"))
    ours = "payload-length" in named
    size, sha256, payload = int(named["payload-length"]) if ours else None, digest[1] if digest and digest[0] == "sha256" else None, None
    if kind != "revisit":
        http, _, payload = block.partition(b"\r\n\r\n") if "application/http" in named.get("content-type", "") else (b"", b"", block)
        own = hashlib.sha256(payload).hexdigest()
        told = digest is None or digest[1] == (own if sha256 else hashlib.sha1(payload).hexdigest())
        if kind == "response" and b"\r\ntransfer-encoding:" not in http.lower() and not (told and size in (None, len(payload))):
            raise ValueError(f"the payload of {named['warc-record-id']} differs from its digest")
        size, sha256 = len(payload), own
    page, refers_to = ("page-id", "refers-to-page-id") if ours else ("warc-record-id", "warc-refers-to")
    return named.get(page), size, sha256, kind, named.get(refers_to), named.get("warc-target-uri"), payload


def read_records(packages: DataFrame, with_payload: bool = False) -> DataFrame:
    """All records of packages, whose addresses are in the column ``path``.

    First each package's index, then the records, dealt out by byte range, so
    a large package is read by many tasks.
    """

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, inner = open_store(path)
                with store.open_input_file(inner) as source:
                    found = index_entries(source)
                offsets, lengths = [a for a, _ in found], [n for _, n in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(offsets), pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    names=["path", "offset", "length"],
                )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, source = None, None
        for batch in batches:
            wanted, rows, held = batch.to_pydict(), [], 0
            for own, offset, length in zip(wanted["path"], wanted["offset"], wanted["length"]):
                if own != path:
                    store, inner = open_store(own)
                    path, source = own, store.open_input_file(inner)
                rows.append(result_of(source.read_at(length, offset))[: len(names)])
                held += len(rows[-1][-1] or b"") if with_payload else 0
                if held > 1 << 20:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"][: 7 if with_payload else 6]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

    found = packages.select("path").repartition(F.col("path")).mapInArrow(textbuf.released(entries), "path string, offset bigint, length bigint")
    # runs of a million bytes of a package go to one task
    dealt = found.repartition(F.col("path"), F.floor(F.col("offset") / (1 << 20))).sortWithinPartitions("path", "offset")
    schema = "page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, url string"
    return dealt.mapInArrow(textbuf.released(read), schema + ", payload binary" * with_payload)


# Writing


def record(
    page_id: str | None,
    url: str | None,
    payload: bytes,
    digest: str,
    response: str | None,
    date: str,
) -> bytes:
    """A record as a gzip member. ``response`` is the page whose payload is the same, if that is another."""
    revisit = response is not None
    name = lambda page: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{digest}')}>"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Payload-Length: {len(payload)}",
        f"Content-Length: {len(block)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        lines.append(f"Page-Id: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {name(response)}", f"Refers-To-Page-Id: {response}"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write_packages(
    pages: DataFrame,
    folder: str,
    html: str = "html",
    id_col: str = "page_id",
    url: str = "url",
    date: str = "2025-01-01T00:00:00Z",
) -> DataFrame:
    """Write all pages; returns ``path, n_records`` of the packages of tasks that ended well.

    A package's name is its own for each attempt. The list is written to the
    shared folder by Spark's commit, so packages of lost or repeated attempts
    are in no list and never read.
    """
    full = pages.select(
        F.col(id_col).cast("string").alias("id"),
        F.col(id_col).alias("order"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    # of payloads that occur once nothing needs to be known; partial counts before the shuffle. Put down, so
    # that both sides of the join are shuffled and Spark can split a payload that very many pages have
    shared = stage(
        full.filter(F.octet_length("html") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.min("order").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 and first is not null")
        .select("digest", F.col("first").cast("string").alias("first")),
        "payloads",
    )
    response = F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first")).alias("response")
    chosen = full.join(shared.hint("merge"), "digest", "left").select("id", "url", "html", "digest", response)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        written, package = [], None
        for batch in batches:
            for i in range(batch.num_rows):
                page, address, text, digest, response = (column[i].as_py() for column in batch.columns)
                if package is None:
                    package = _Package(store, root, folder)
                package.add(record(page, address, text.encode(), digest, response, date), digest, address)
                if package.bytes >= PACKAGE_BYTES:
                    written.append(package.close())
                    package = None
        if package is not None:
            written.append(package.close())
        if written:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*written)], names=["path", "n_records"])

    return stage(chosen.mapInArrow(textbuf.released(write), "path string, n_records bigint"), "packages")


class _Package:
    """One package being written; record bytes go straight to the store."""

    def __init__(self, store, root: str, folder: str):
        name = f"{uuid.uuid4().hex}.wacz"
        self.path = f"{folder}/{name}"
        self.stream = store.open_output_stream(f"{root}/{name}")
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(RECORDS, "w", force_zip64=True)
        self.bytes, self.lines = 0, []

    def add(self, packed: bytes, digest: str, url: str | None) -> None:
        entry = {"offset": self.bytes, "length": len(packed), "digest": f"sha256:{digest}", "filename": "data.warc.gz"}
        key = json.dumps(url or "").replace(" ", "%20")
        self.lines.append(f"{key} 0 {json.dumps(entry)}\n")
        self.member.write(packed)
        self.bytes += len(packed)

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.zip.writestr(INDEX, "".join(self.lines))
        self.zip.close()
        self.stream.close()
        return self.path, len(self.lines)


def archive_round_trip(
    pages: DataFrame,
    html: str = "html",
    id_col: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """Write all pages to packages in the shared folder and read every record back."""
    folder = scratch_dir(pages.sparkSession, "warc")
    kind = pages.schema[id_col].dataType
    records = read_records(write_packages(pages, folder, html, id_col, url))
    return records.select(
        F.col("page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )
