"""Web-archive records (WARC and WET, gzip or plain) as a Spark data source.

    register(spark)
    spark.read.format("webarchive").option("path", folder).load()

Records are streamed, so a task holds one record at a time. A large gzip archive whose records are members of their own is read
by several tasks: each takes a range of bytes, finds the first member in it that begins a record, and owns the records whose
member begins in its range, wherever they end. Files that do not begin with such a member (plain text, gzip within gzip) are read by
one task, and so is a file that is a single member: nothing begins in its later ranges.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from firmweave import schemas

FORMAT = "webarchive"
KEPT_TYPES = "response,conversion"
_BATCH_BYTES = 8 << 20
ERROR = "error"
# Bytes of a file that one task reads, about.
SPLIT_BYTES = 128 << 20
# Members after a possible first one of a range that must follow each other without a gap; payloads may hold bytes that look like members.
CHAIN = 64
_MAGIC, _RECORD = b"\x1f\x8b\x08", b"WARC/"


def _fields(lines: list[bytes]) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in lines:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found.setdefault(name.strip().lower(), value.strip())
    return found


def _dechunked(body: bytes) -> bytes:
    """Body of a chunked HTTP message; the input itself when it is not chunked after all."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size_text = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        try:
            size = int(size_text, 16)
        except ValueError:
            return body if not out else b"".join(out) + body[at:]
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2


def _inflated(body: bytes) -> bytes:
    """Whole content of a gzip or deflate body, all members of it; what there is of a body that was cut off.

    Bytes after the last member are no content. Raises ``zlib.error`` if nothing can be read.
    """
    out: list[bytes] = []
    for window in (47, -15):
        rest = body
        try:
            while rest:
                member = zlib.decompressobj(window)
                out.append(member.decompress(rest) + member.flush())
                rest = member.unused_data if window > 0 and member.unused_data[:2] == b"\x1f\x8b" else b""
            return b"".join(out)
        except zlib.error:
            if out:
                return b"".join(out)
    raise zlib.error("neither gzip nor deflate")


def _http_body(block: bytes) -> bytes:
    """Payload of an HTTP response block, transfer and content encodings undone."""
    if not block.startswith(b"HTTP/"):
        return block
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        head, gap, body = block.partition(b"\n\n")
    fields = _fields(head.splitlines()[1:])
    if "chunked" in fields.get("transfer-encoding", "").lower():
        body = _dechunked(body)
    if fields.get("content-encoding", "").lower() in ("gzip", "x-gzip", "deflate"):
        try:
            return _inflated(body)
        except zlib.error:
            return body
    return body


def records(stream, types: set[str], uri_part: str | None, stop: int | None = None) -> Iterator[tuple[str, str | None, bytes, int]]:
    """(type, target URI, payload, number) of the wanted records of an open archive.

    With ``stop``, ``stream`` is of ``Members``: records that begin in members from that offset on are left to others, and numbers
    are those of ``Members.number``.

    Framing goes by Content-Length alone, so text that looks like a header inside a
    payload does no harm. Unwanted payloads are skipped, not kept. A record whose length cannot be
    read or whose payload ends early gives a record of type ``error`` that tells why; reading
    goes on at the next record.
    """
    number = -1
    while True:
        if stop is not None and stream.member() >= stop:
            return
        line = stream.readline()
        if not line:
            return
        if not line.startswith(_RECORD):
            continue
        number = number + 1 if stop is None else stream.number()
        head: list[bytes] = []
        while (line := stream.readline()).strip():
            head.append(line)
        fields = _fields(head)
        stated = fields.get("content-length", "0") or "0"
        kind, uri = fields.get("warc-type", ""), fields.get("warc-target-uri")
        uri = uri.strip("<>") if uri else uri
        if not (stated.isascii() and stated.isdigit()):
            yield ERROR, uri, f"length {stated!r}".encode(), number
            continue
        length = int(stated)
        if kind in types and (uri_part is None or (uri is not None and uri_part in uri.lower())):
            block = stream.read(length)
            if len(block) < length:
                yield ERROR, uri, f"{len(block)} of {length} bytes".encode(), number
                return
            http = kind == "response" and (uri or "").lower().startswith("http")
            yield kind, uri, _http_body(block) if http else block, number
        else:
            left = length
            while left > 0 and (skipped := stream.read(min(left, 1 << 20))):
                left -= len(skipped)


class _Gunzipped(io.RawIOBase):
    """All members of a gzip stream. What can be read before a broken or cut-off member is given out first."""

    def __init__(self, raw):
        self.raw, self.member, self.held = raw, None, b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while True:
            data = self.held or self.raw.read(1 << 16)
            if self.member is None:
                data += self.raw.read(1) if len(data) == 1 else b""
                if data[:2] != b"\x1f\x8b":  # the end, or bytes that are no member
                    return 0
                self.member = zlib.decompressobj(31)
            if not data:
                raise EOFError("the file ends within a gzip member")
            out = self.member.decompress(data, len(buffer))
            self.held = self.member.unconsumed_tail
            if self.member.eof:
                self.held, self.member = self.member.unused_data, None
            if out:
                buffer[: len(out)] = out
                return len(out)


class Members:
    """The content of a gzip file from a member on, and the member that each byte is of."""

    def __init__(self, raw, at: int):
        self.raw, self.next, self.begin = raw, at, at
        self.data, self.place, self.inflater, self.counted = b"", 0, None, 0
        raw.seek(at)
        self.packed = b""

    def _more(self) -> bool:
        """Inflate a piece behind what is left; False at the end."""
        while True:
            packed = self.packed or self.raw.read(1 << 16)
            if self.inflater is None:
                if len(packed) < 3:
                    packed += self.raw.read(1 << 16)
                if packed[:3] != _MAGIC:  # the end, or bytes that are no member
                    return False
                self.inflater, self.begin, self.counted = zlib.decompressobj(31), self.next, 0
            if not packed:
                raise EOFError("the file ends within a gzip member")
            out = self.inflater.decompress(packed, 1 << 18)
            self.packed = self.inflater.unconsumed_tail
            if self.inflater.eof:
                self.packed, self.inflater = self.inflater.unused_data, None
                self.next = self.raw.tell() - len(self.packed)
            if out:
                self.data, self.place = self.data[self.place :] + out, 0
                return True

    def member(self) -> int:
        """Offset of the member that the next byte is of; beyond all of them at the end."""
        return self.begin if self.place < len(self.data) or self._more() else 1 << 62

    def number(self) -> int:
        """A number that ascends with (member, record within it); for the record whose first line has just been read."""
        self.counted += 1
        return (self.line_of << 24) + self.counted - 1

    def readline(self) -> bytes:
        self.line_of = self.member()
        parts = []
        while self.place < len(self.data) or self._more():
            end = self.data.find(b"\n", self.place) + 1
            parts.append(self.data[self.place : end or len(self.data)])
            self.place = end or len(self.data)
            if end:
                break
        return b"".join(parts)

    def read(self, size: int) -> bytes:
        parts = []
        while size > 0 and (self.place < len(self.data) or self._more()):
            part = self.data[self.place : self.place + size]
            self.place += len(part)
            size -= len(part)
            parts.append(part)
        return b"".join(parts)


def begins_record(raw, at: int) -> bool:
    """Whether a member at ``at`` begins a record and is followed by further members, or by the end of the file."""
    raw.seek(at)
    head = raw.read(1 << 12)
    try:
        if head[:3] != _MAGIC or not zlib.decompressobj(31).decompress(head, len(_RECORD)).startswith(_RECORD):
            return False
        seen, chain = 0, Members(raw, at)
        while seen < CHAIN:
            before = chain.begin
            if chain.member() == 1 << 62:
                return not chain.packed  # bytes that are no member: it was none of the file's own
            seen += chain.begin != before
            chain.place = len(chain.data)
    except EOFError:  # a file that is cut off
        return True
    except zlib.error:
        return False
    return True


def first_member(raw, lo: int, hi: int) -> int | None:
    """Offset of the first member in the range that begins a record."""
    at = lo
    while at < hi:
        raw.seek(at)
        block = raw.read(min(1 << 20, hi - at + len(_MAGIC) - 1))
        place = block.find(_MAGIC)
        while 0 <= place and at + place < hi:
            if begins_record(raw, at + place):
                return at + place
            place = block.find(_MAGIC, place + 1)
        at += max(1, len(block) - len(_MAGIC) + 1)
        if not block:
            return None
    return None


def _open_split(path: str):
    """A file that can be read from any place."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    return system.open_input_file(inner)


def _open(path: str):
    """A buffered byte stream of any file that Arrow's file systems reach, gunzipped if need be."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    raw = system.open_input_stream(inner, compression=None)
    # Layers of gzip are told by their first bytes; some writers compress records and then the file.
    stream = io.BufferedReader(raw, 1 << 20)
    while stream.peek(2)[:2] == b"\x1f\x8b":
        stream = io.BufferedReader(_Gunzipped(stream), 1 << 20)
    return stream


def list_files(path: str, suffixes: tuple[str, ...]) -> list[str]:
    """Files below ``path`` with one of the endings, sorted; ``path`` itself when it is a file."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    prefix = path[: len(path) - len(inner)] if "://" in path and path.endswith(inner) else ""
    found = system.get_file_info(inner)
    if found.type == fs.FileType.File:
        return [path]
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    listed = system.get_file_info(fs.FileSelector(inner, recursive=True))
    files = sorted(prefix + f.path for f in listed if f.type == fs.FileType.File and f.path.endswith(suffixes))
    if not files:
        raise FileNotFoundError(f"no {' or '.join(suffixes)} files below {path}")
    return files


class _File(InputPartition):
    def __init__(self, path: str, lo: int, hi: int, whole: bool):
        self.path, self.lo, self.hi, self.whole = path, lo, hi, whole


def file_sizes(paths: list[str]) -> list[int]:
    from pyarrow import fs

    if "://" not in paths[0]:
        found = fs.LocalFileSystem().get_file_info([p.removeprefix("file:") for p in paths])
    else:
        system, _ = fs.FileSystem.from_uri(paths[0])
        found = system.get_file_info([fs.FileSystem.from_uri(p)[1] for p in paths])
    return [f.size or 0 for f in found]


class ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.types = set(options.get("types", KEPT_TYPES).split(","))
        self.uri_part = options.get("uriContains") or None
        self.suffixes = tuple(options.get("suffixes", ".gz").split(","))
        self.split = int(options.get("splitBytes", SPLIT_BYTES))

    def partitions(self) -> list[_File]:
        paths = list_files(self.path, self.suffixes)
        out = []
        for path, size in zip(paths, file_sizes(paths)):
            cuts = [*range(0, max(size, 1), self.split), size]
            out += [_File(path, lo, hi, len(cuts) == 2) for lo, hi in zip(cuts, cuts[1:])]
        return out

    def _records(self, part: _File):
        """The records that a partition owns."""
        if not part.whole:
            with _open_split(part.path) as raw:
                if begins_record(raw, 0):
                    at = 0 if part.lo == 0 else first_member(raw, part.lo, part.hi)
                    if at is not None:
                        yield from records(Members(raw, at), self.types, self.uri_part, part.hi)
                    return
        if part.lo == 0:  # of another make: read by the first range's task alone
            with _open(part.path) as stream:
                yield from records(stream, self.types, self.uri_part)

    def read(self, partition: _File):
        import pyarrow as pa

        names = ["rec_type", "target_uri", "payload", "file", "pos"]
        kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]
        schema = pa.schema(list(zip(names, kinds)))
        rows: list[tuple] = []
        held = 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], schema=schema)

        def readable():
            """The records up to where the content can be read, then an error record if that is not its end.

            Errors of the storage are not caught: the task fails and is tried again.
            """
            last = -1
            try:
                for found in self._records(partition):
                    last = found[3]
                    yield found
            except (EOFError, zlib.error) as error:
                yield ERROR, None, f"{type(error).__name__}: {error}".encode(), last + 1

        for kind, uri, payload, number in readable():
            # Bytes that are not UTF-8 are left out.
            text = payload.decode("utf-8", "ignore")
            rows.append((kind, uri, text, partition.path, number))
            held += len(payload)
            if held >= _BATCH_BYTES:
                yield batch()
                rows, held = [], 0
        if rows:
            yield batch()


class ArchiveSource(DataSource):
    """Options: path (file or folder), types, uriContains, suffixes (default ``.gz``), splitBytes.

    ``pos`` ascends with the records of a file. In a file of one range it is the record's number; in one that several tasks read it is the
    offset of the record's member times 2 ** 24, plus the number of the record within it, which no task has to ask others for.

    ``uriContains`` skips records before their payload is decoded; give it a
    lower-case text that every wanted address holds, such as ``.au``.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return schemas.ARCHIVE_RECORD

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ArchiveSource)


def read_archives(
    spark: SparkSession, path: str, uri_contains: str | None = None, suffixes: str = ".gz", split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Records of an archive file or a folder of them; with ``uri_contains`` only those whose address holds that text."""
    register(spark)
    reader = spark.read.format(FORMAT).option("path", path).option("suffixes", suffixes).option("splitBytes", split_bytes)
    if uri_contains:
        reader = reader.option("uriContains", uri_contains)
    return reader.load()


def read_errors(archive_records: DataFrame) -> DataFrame:
    """Records that could not be read: file, pos, target_uri and the reason."""
    broken = archive_records.filter(archive_records["rec_type"] == ERROR)
    return broken.select("file", "pos", "target_uri", broken["payload"].alias("reason"))
