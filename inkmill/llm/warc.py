"""WARC archives with a two-level capture index.

Captures become WARC records, each its own gzip member, in archive files of bounded size in the shared
folder.  A capture whose payload occurs elsewhere becomes a revisit of the one with the largest id.  The index
sorts captures by reversed-host URL keys into compressed blocks; a sparse directory holds the first key of
every block.  A lookup binary-searches the directory, opens one block, binary-searches its lines, and reads
just that range of the archive file.  A directory too large to send around is itself packed into blocks under
a sparser one.

Where Python cannot open the shared folder (a file system that only Spark reads), the archives are segments
of bounded size in a table instead, and a lookup opens the segments that hold its ranges.

Defined cases: a null page is an empty payload and a null URL an empty one; a very long page is one record, of
which a task holds one at a time; rows that repeat an id and payload are responses alike; rows without an id
revisit like any other and are never referred to; clashing columns are ignored; an empty table gives an empty
table.  A repeated task writes files of other names, and only those that its committed rows name are read.

At scale: pages are shuffled only where the table of repeated payloads is too large to broadcast; then
the join's two sides are plain exchanges, which adaptive execution splits where one payload is frequent.
Index keys end in the capture's id, so that one frequent URL is spread over range partitions.  Archives are
never shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import map_rows, new_path, small, store

#: An archive file ends at so many bytes; ranges within so many are read by one task.
ARCHIVE_BYTES = 1 << 30
STRETCH_BYTES = 1 << 22
#: A segment ends at so many compressed bytes or records.
SEGMENT_BYTES = 1 << 20
SEGMENT_RECORDS = 512
#: Lines of an index block.
BLOCK_LINES = 3_000
#: Blocks whose directory may be broadcast: some 100 bytes each.
DIRECTORY_ROWS = 200_000
#: The crawl's date; a parameter, since the tables have none.
DATE = "2024-01-01T00:00:00Z"
LEVEL = 4


def surt(url: str | None) -> str:
    """Sort-friendly key: host reversed by its labels, then path and query, without scheme and fragment."""
    try:
        parts = urlsplit(url or "")
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return ")" + quote(url or "", safe="")
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return quote(f"{key}){tail}", safe="%:/?#[]@!$&'()*+,;=~")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _target(url: str | None) -> list[str]:
    """The header lines of a URL; one that a line can't hold is told a second time in a form that can be undone."""
    url = url or ""
    if re.fullmatch(r"[^\x00-\x20\x7f](?:[^\x00-\x1f\x7f]*[^\x00-\x20\x7f])?|", url):
        return [f"WARC-Target-URI: {url}"]
    return [f"WARC-Target-URI: {quote(url, safe='%:/?#[]@!$&()*+,;=~')}", f"X-Target-URI: {quote(url, safe='')}"]


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """A WARC record: a response, or a revisit where ``refers_to`` is given."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_uri(page_id)}", f"WARC-Date: {date}", *_target(url), f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is None:
        block += payload
    else:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_uri(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of one record; a response's payload is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda uri: int(n) if (n := re.fullmatch(r"<urn:x-page:(-?\d*)>", uri)[1]) else None
    size = int(re.search(rb"(?i)content-length: *(\d+)", http)[1])
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError("a payload differs from its digest")
    refers = fields.get("WARC-Refers-To")
    return {"page_id": number(fields["WARC-Record-ID"]), "url": unquote(fields["X-Target-URI"]) if "X-Target-URI" in fields else fields["WARC-Target-URI"], "type": kind, "payload": payload, "payload_bytes": size, "digest": digest, "refers_to": None if refers is None else number(refers)}


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a Hadoop-style location."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), unquote(urlsplit(uri).path)
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _folder(df: DataFrame) -> str | None:
    """A new folder for archive files, or None where Python can't open the shared one."""
    uri = new_path(df.sparkSession, "archives")
    try:
        files, path = _open(uri)
        files.create_dir(path)
        return uri
    except (OSError, ValueError, ImportError):
        return None


def _members(df: DataFrame, key: str, url: str, page: str, min_revisit: int) -> DataFrame:
    """(id, url, html, sha, keeper): what the records are made of; keeper is null for payloads without copies."""
    picked = df.select(F.col(key).cast("long").alias("id"), F.col(url).alias("url"), F.coalesce(F.col(page), F.lit("")).alias("html"))
    picked = picked.withColumn("sha", F.unhex(F.sha1("html")))
    sizes = picked.select("id", "sha", F.octet_length("html").alias("n"))
    repeated = sizes.filter(F.col("n") >= min_revisit).groupBy("sha").agg(F.max("id").alias("keeper"), F.count("*").alias("copies"))
    repeated = store(repeated.filter("copies > 1").select("sha", "keeper"), "repeated")
    return picked.join(F.broadcast(repeated) if small(repeated) else repeated, "sha", "left").select("id", "url", "html", "sha", "keeper")


def _encoded(source: Iterator[tuple]) -> Iterator[tuple[str, int | None, bytes]]:
    """(index key, id, gzip member) of the rows of ``_members``."""
    for i, u, text, sha, keeper in source:
        refers = keeper if keeper is not None and keeper != i else None
        yield surt(u), i, _member(record(i, u, text.encode(), base64.b32encode(bytes(sha)).decode(), refers))


ENTRIES = "archive string, segment int, data binary, entries array<struct<key:string,id:long,offset:long,length:int>>"


def write_archives(df: DataFrame, key: str, url: str, page: str, min_revisit: int = 0, files: bool = True) -> DataFrame:
    """Written table ENTRIES of all captures: their archive and place, and, where there are no files, the bytes.

    Payloads of fewer than ``min_revisit`` bytes are all responses.
    """
    folder = _folder(df) if files else None

    def written(source: Iterator[tuple]) -> Iterator[tuple]:
        name, out, at, entries = "", None, 0, []
        for k, i, data in _encoded(source):
            if out is None:
                name = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                system, path = _open(name)
                out, at = system.open_output_stream(path, compression=None), 0
            entries.append({"key": k, "id": i, "offset": at, "length": len(data)})
            out.write(data)
            at += len(data)
            if at >= ARCHIVE_BYTES:
                out.close()
                out = None
            if len(entries) >= SEGMENT_RECORDS or out is None:
                yield name, None, None, entries
                entries = []
        if out is not None:
            out.close()
        if entries:
            yield name, None, None, entries

    def packed(source: Iterator[tuple]) -> Iterator[tuple]:
        archive = f"{TaskContext.get().partitionId():06d}.warc.gz"
        segment, parts, entries, size = 0, [], [], 0
        for k, i, data in _encoded(source):
            entries.append({"key": k, "id": i, "offset": size, "length": len(data)})
            parts.append(data)
            size += len(data)
            if size >= SEGMENT_BYTES or len(parts) >= SEGMENT_RECORDS:
                yield archive, segment, b"".join(parts), entries
                segment, parts, entries, size = segment + 1, [], [], 0
        if parts:
            yield archive, segment, b"".join(parts), entries

    return store(map_rows(_members(df, key, url, page, min_revisit), ENTRIES, written if folder else packed), "captures")


def export_archives(archives: DataFrame, archive: str) -> Iterator[bytes]:
    """The bytes of one archive as a regular .warc.gz file, piece by piece."""
    if not archives.filter("data is not null").isEmpty():
        for r in archives.filter(F.col("archive") == archive).select("segment", "data").orderBy("segment").toLocalIterator():
            yield bytes(r["data"])
        return
    files, path = _open(archive)
    with files.open_input_file(path) as f:
        while piece := f.read(STRETCH_BYTES):
            yield piece


# -- the index -----------------------------------------------------------------------------------------

def _line_key(key: str, page_id: int | None) -> str:
    """Keys sort as text: the URL key, then the id, which is padded and shifted to be positive."""
    return f"{key} {'-' if page_id is None else format(page_id + (1 << 63), '020d')}"


def _pack(lines: DataFrame) -> DataFrame:
    """Written table (block, first, data) of ``lines(key, value)`` in key order."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        block = TaskContext.get().partitionId() << 32
        held: list[tuple[str, str]] = []

        def packed() -> tuple:
            return block, held[0][0], zlib.compress("\n".join(f"{k}\t{v}" for k, v in held).encode(), LEVEL)

        for line in source:
            held.append(line)
            if len(held) >= BLOCK_LINES:
                yield packed()
                block, held = block + 1, []
        if held:
            yield packed()

    ordered = lines.repartitionByRange("key", "value").sortWithinPartitions("key", "value")
    return store(map_rows(ordered.select("key", "value"), "block long, first string, data binary", rows), "index")


def build_index(archives: DataFrame) -> DataFrame:
    """Blocks of the capture index of ``write_archives``: sorted lines of key, segment, offset, length and archive."""

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for archive, segment, entries in source:
            for e in entries:
                yield _line_key(e["key"], e["id"]), f"{'-' if segment is None else segment} {e['offset']} {e['length']} {archive}"

    return _pack(map_rows(archives.select("archive", "segment", "entries"), "key string, value string", rows))


def _read_block(data: bytes) -> tuple[list[str], list[str]]:
    pairs = [line.split("\t", 1) for line in zlib.decompress(data).decode().split("\n")]
    return [p[0] for p in pairs], [p[1] for p in pairs]


def _locate(queries: DataFrame, blocks: DataFrame, limit: int) -> DataFrame:
    """(query, block): every block in which lines of a query key may stand."""
    directory = blocks.select("first", "block")
    if directory.count() > limit:
        above = _pack(directory.select(F.col("first").alias("key"), F.col("block").cast("string").alias("value")))
        found = _fetch(queries, above, limit, exact=False)
        return found.select("query", F.col("value").cast("long").alias("block"))
    held = queries.sparkSession.sparkContext.broadcast(sorted((r["first"], r["block"]) for r in directory.toLocalIterator()))

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        firsts, numbers = [f for f, _ in held.value], [b for _, b in held.value]
        for (query,) in source:
            # lines of one key may go on from the block before the first that begins with it
            for i in range(max(0, bisect_left(firsts, query) - 1), bisect_right(firsts, query)):
                yield query, numbers[i]

    return map_rows(queries.select("query"), "query string, block long", rows)


def _fetch(queries: DataFrame, blocks: DataFrame, limit: int, exact: bool = True) -> DataFrame:
    """(query, value) of all lines with a query's key; or, if not exact, of those that its block range covers."""
    asked = _locate(queries, blocks, limit).groupBy("block").agg(F.collect_list("query").alias("queries"))

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for asked_keys, data in source:
            keys, values = _read_block(data)
            for q in asked_keys:
                low, high = bisect_left(keys, q), bisect_right(keys, q)
                for i in range(low if exact else max(0, low - 1), high):
                    yield q, values[i]

    return map_rows(asked.join(blocks, "block").select("queries", "data"), "query string, value string", rows)


def lookup(captures: DataFrame, archives: DataFrame, blocks: DataFrame, directory_rows: int = DIRECTORY_ROWS, payload: bool = False) -> DataFrame:
    """Read the records of ``captures(url, id)`` through the index: one row for each record found.

    Equal captures are asked for once.  A block is opened once for all its queries, and a stretch of an archive
    once for all its ranges; both hold a bounded number of records.
    """

    def keyed(source: Iterator[tuple]) -> Iterator[tuple]:
        for u, i in source:
            yield (_line_key(surt(u), i),)

    queries = map_rows(captures.select("url", "id"), "query string", keyed).distinct()
    place = F.split("value", " ", 4)
    ranges = _fetch(queries, blocks, directory_rows).select(place[3].alias("archive"), F.when(place[0] != "-", place[0].cast("int")).alias("segment"), F.struct(place[1].cast("long").alias("offset"), place[2].cast("int").alias("length")).alias("range"))
    fields = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", url string, payload binary" * payload

    def parsed(member: bytes) -> tuple:
        found = parse(zlib.decompress(member, 31))
        row = found["page_id"], found["payload_bytes"], found["digest"], found["type"], found["refers_to"]
        return (*row, found["url"], found["payload"]) if payload else row

    def read(source: Iterator[tuple]) -> Iterator[tuple]:
        for archive, wanted in source:
            files, path = _open(archive)
            with files.open_input_file(path) as f:
                for offset, length in sorted((r["offset"], r["length"]) for r in wanted):
                    f.seek(offset)
                    yield parsed(f.read(length))

    def cut(source: Iterator[tuple]) -> Iterator[tuple]:
        for wanted, data in source:
            for r in wanted:
                yield parsed(data[r["offset"] : r["offset"] + r["length"]])

    if archives.filter("data is not null").isEmpty():
        stretch = F.floor(F.col("range.offset") / STRETCH_BYTES)
        near = ranges.groupBy("archive", stretch.alias("stretch")).agg(F.collect_list("range").alias("ranges"))
        return map_rows(near.select("archive", "ranges"), fields, read)
    ranges = ranges.groupBy("archive", "segment").agg(F.collect_list("range").alias("ranges"))
    joined = archives.select("archive", "segment", "data").join(ranges, ["archive", "segment"]).select("ranges", "data")
    return map_rows(joined, fields, cut)


def archive_and_read(df: DataFrame, key: str, url: str, page: str, min_revisit: int = 0) -> DataFrame:
    """Write all rows to archives, index them, and read every capture back through the index."""
    archives = write_archives(df, key, url, page, min_revisit)
    blocks = build_index(archives)
    return lookup(df.select(F.col(url).alias("url"), F.col(key).cast("long").alias("id")), archives, blocks)
