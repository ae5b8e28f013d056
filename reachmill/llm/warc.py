"""WARC archives compressed with Zstandard and a dictionary: writer and streaming reader.

An archive begins with a skippable frame that holds the dictionary, then has one frame
for each record. The writing task trains the dictionary on its own first records. The
reader takes the dictionary from the leading frame, decodes one frame at a time in
bounded memory, and checks for every record the version line, the headers, both lengths,
the closing line feeds and the payload digest; anything amiss ends the read with the
archive's name and the record's number.

Pages with equal payloads are stored once: the one with the smallest id is a response,
the others are revisits that name it.

Defined cases: a null payload is empty; a null id is stored as such, is a response, and no
revisit names it; rows with the same id and payload are each a response (they are one
page); null urls stay null; an empty table writes no archive. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Frame magic numbers of the formats.
_SKIPPABLE = (0x184D2A5D).to_bytes(4, "little")
_FRAME = (0xFD2FB528).to_bytes(4, "little")
_TRAINED = (0xEC30A437).to_bytes(4, "little")
_VERSION = "WARC/1.1"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_SAMPLE = 200
_CHUNK = 1 << 16
RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


class BrokenArchive(ValueError):
    """A record that is not what its headers say."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def _page_id(uri: str) -> int | None:
    if not (uri.startswith("<urn:page:") and uri.endswith(">")):
        raise BrokenArchive(f"record id {uri}")
    name = uri[10:-1]
    return None if name == "none" else int(name)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One whole record: headers, HTTP headers, and for a response the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    content = http if refers_to is not None else http + payload
    head = [
        _VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_uri(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(content)}",
    ]
    if url is not None:
        # a header is one line, so whatever would end it is written by its number
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {_REVISIT}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + content + b"\r\n\r\n"


def _headers(block: bytes, first: str) -> dict[str, str]:
    lines = block.decode().split("\r\n")
    if not lines[0].startswith(first):
        raise BrokenArchive(f"begins with {lines[0][:40]!r}")
    found = {}
    for line in lines[1:]:
        name, colon, value = line.partition(": ")
        if not colon:
            raise BrokenArchive(f"header line {line[:40]!r}")
        found[name.lower()] = value
    return found


def parsed(raw: bytes) -> tuple:
    """A record's fields as RECORDS has them; BrokenArchive if anything does not agree."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    if not gap:
        raise BrokenArchive("no end of headers")
    headers = _headers(head, _VERSION)
    try:
        length, kind = int(headers["content-length"]), headers["warc-type"]
        page_id, digest = _page_id(headers["warc-record-id"]), headers["warc-payload-digest"].removeprefix("sha1:")
        if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
            raise BrokenArchive(f"{len(rest) - 4} bytes of content, {length} announced")
        http, gap, payload = rest[:length].partition(b"\r\n\r\n")
        size = int(_headers(http, "HTTP/")["content-length"])
        refers_to = _page_id(headers["warc-refers-to"]) if kind == "revisit" else None
    except KeyError as missing:
        raise BrokenArchive(f"no header {missing}") from None
    if kind not in ("response", "revisit") or not gap:
        raise BrokenArchive(f"record of type {kind}")
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise BrokenArchive("the payload is not the one announced")
    url = headers.get("warc-target-uri")
    url = None if url is None else url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
    return page_id, url, size, digest, kind, refers_to, payload if kind == "response" else None


def _dictionary(samples: list[bytes]) -> bytes:
    """Trained on the samples, or the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(16 << 10, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[: 16 << 10]


def _dictionary_of(raw: bytes) -> zstandard.ZstdCompressionDict:
    kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == _TRAINED else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(raw, dict_type=kind)


def archive(records: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of an archive, frame by frame."""
    held: list[bytes] = []
    compress = None
    for one in records:
        if compress is None:
            held.append(one)
            if len(held) < _SAMPLE:
                continue
        if compress is None:
            compress, leading = _opened(held)
            yield leading
            for each in held:
                yield compress(each)
            held = []
        else:
            yield compress(one)
    if compress is None and held:
        compress, leading = _opened(held)
        yield leading
        for each in held:
            yield compress(each)


def _opened(samples: list[bytes]):
    raw = _dictionary(samples)
    packed = zstandard.ZstdCompressor(level=9).compress(raw)
    compressor = zstandard.ZstdCompressor(level=3, dict_data=_dictionary_of(raw), write_checksum=True)
    return compressor.compress, _SKIPPABLE + len(packed).to_bytes(4, "little") + packed


def frames(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The decoded records of an archive that comes in chunks of any size."""
    buffer, chunks = b"", iter(chunks)

    def fill(n: int) -> None:
        nonlocal buffer
        while len(buffer) < n:
            more = next(chunks, b"")
            if not more:
                raise BrokenArchive("ends within a frame")
            buffer += more

    fill(8)
    if buffer[:4] != _SKIPPABLE:
        raise BrokenArchive("no leading dictionary frame")
    size = int.from_bytes(buffer[4:8], "little")
    fill(8 + size)
    raw, buffer = buffer[8 : 8 + size], buffer[8 + size :]
    if raw[:4] == _FRAME:
        raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=1 << 24)
    decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary_of(raw))
    while True:
        buffer = buffer or next(chunks, b"")
        if not buffer:
            return
        fill(4)
        if buffer[:4] != _FRAME:
            raise BrokenArchive("something between two frames")
        one, parts = decompressor.decompressobj(), []
        while not one.eof:
            buffer = buffer or next(chunks, b"")
            if not buffer:
                raise BrokenArchive("ends within a frame")
            parts.append(one.decompress(buffer))
            buffer = one.unused_data if one.eof else b""
        yield b"".join(parts)


def _opened_at(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def write_archives(pages: DataFrame, target: str, key: str = "page_id", url: str = "url", payload: str = "html", archives: int | None = None) -> DataFrame:
    """Write the pages as archives into the folder target, which all executors share, one
    archive a task. Returns a row for each archive: path and number of records; the
    archives are written when these rows are computed, and a task that runs again writes
    under a new name, so a row always names a whole file.

    The first of equal payloads is found by digest before any payload moves; a payload
    that a third of all pages share is one row there, and adaptive execution splits its
    pages in the join."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumn("_digest", F.sha1("payload"))
    first = rows.where(F.col("page_id").isNotNull()).groupBy("_digest").agg(F.min("page_id").alias("_first"))
    joined = rows.join(first, "_digest", "left").select(
        "page_id", "url", "payload", F.when(F.col("page_id") != F.col("_first"), F.col("_first")).alias("refers_to")
    )
    if archives is not None:
        joined = joined.repartition(archives)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = 0

        def records() -> Iterator[bytes]:
            nonlocal count
            for batch in batches:
                for page_id, at, content, refers_to in zip(*(batch.column(i) for i in range(4)), strict=True):
                    count += 1
                    yield record(page_id.as_py(), at.as_py(), content.as_py(), refers_to.as_py())

        out = archive(records())
        leading = next(out, None)
        if leading is None:
            return
        system, folder = _opened_at(target)
        system.create_dir(folder, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.zst"
        with system.open_output_stream(posixpath.join(folder, name), compression=None) as sink:
            sink.write(leading)
            for frame in out:
                sink.write(frame)
        yield pa.RecordBatch.from_arrays([pa.array([posixpath.join(target, name)]), pa.array([count], pa.int64())], names=["path", "n_records"])

    return joined.mapInArrow(write, "path string, n_records bigint")


def read_archives(paths: DataFrame, path: str = "path", payloads: bool = True) -> DataFrame:
    """The records of the archives that the rows name, as RECORDS has them. Without
    payloads they are checked all the same but not returned."""
    kept = 7 if payloads else 6
    schema = ", ".join(RECORDS.split(", ")[:kept])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][:kept]
        names = [c.split()[0] for c in schema.split(", ")]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

        for these in batches:
            for where in these.column(0).to_pylist():
                system, at = _opened_at(where)
                rows, size = [], 0
                with system.open_input_stream(at, compression=None) as source:
                    for n, raw in enumerate(frames(iter(lambda: source.read(_CHUNK), b""))):
                        try:
                            rows.append(parsed(raw)[:kept])
                        except BrokenArchive as broken:
                            raise BrokenArchive(f"{where}, record {n}: {broken}") from None
                        size += len(raw) if payloads else 200
                        if size > 1 << 23:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    # one archive a task: the names are few bytes, so no measure of size may pool them
    tasks = max(1, paths.count())
    return paths.select(path).repartition(tasks, path).mapInArrow(read, schema)
