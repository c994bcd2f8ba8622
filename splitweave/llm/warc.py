"""WARC archives: written as one gzip stream each, then normalised to one gzip member for each record, with an offset index.

The normaliser inflates an archive's stream once, from front to back and a piece at a time, rewrites every record as a member of its
own and writes a sidecar file with a line for each record. What is read later goes through that index. Files have names of their own for
each attempt of a task, and only those that a finished task has named in a table are read on.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitweave.functions.text import join_path
from splitweave.llm.common import file_system, small_batches, with_small, written
from splitweave.sources.paths import remove

LEVEL = 6
ARCHIVE_BYTES = 64 << 20  # of records, before an archive is closed and the next begun
PIECE = 1 << 16
DATE = "2000-01-01T00:00:00Z"
# Fixed values of the format.
VERSION = b"WARC/1.0\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
GZIP = 31
MANIFEST = "archive string, sidecar string, records long"


def decided(pages: DataFrame, least_bytes: int, id_column: str, payload: str) -> DataFrame:
    """The pages with their payload, digest and, for revisits, the id they refer to."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(id_column).cast("long").alias("id"), F.col("url"), body.alias("payload"), F.sha1(body).alias("digest"))
    big = rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
    repeated = written(big.where("n > 1 and keeper is not null").select("digest", "keeper"), "keepers")
    joined = with_small(rows, repeated, "digest", "left")
    return joined.select("id", "url", "payload", "digest", F.when(F.col("keeper").eqNullSafe(F.col("id")), None).otherwise(F.col("keeper")).alias("refers_to"))


def record(id_: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit has no payload, only the digest of the one it refers to."""
    named = lambda i: f"<urn:page:{'' if i is None else i}>"
    lines = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", named(id_)), ("WARC-Date", DATE)]
    if url:
        lines.append(("WARC-Target-URI", "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url)))
    lines.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()))
    if refers_to is not None:
        lines += [("WARC-Refers-To", named(refers_to)), ("WARC-Profile", SAME_PAYLOAD)]
        payload = b""
    lines += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + payload + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 1000, id_column: str = "page_id", payload: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every page as a record; (archive, sidecar, records) of the archives, which are one gzip stream each."""
    small_batches(pages.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, place = file_system(folder)
        sink = None
        for b in batches:
            done = []
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if sink is None:
                    fs.create_dir(place)
                    name, records, size = f"raw-{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink, packer = fs.open_output_stream(f"{place}/{name}", compression=None), zlib.compressobj(1, zlib.DEFLATED, GZIP)
                data = record(row[0], row[1], row[2].encode(), row[3], row[4])
                sink.write(packer.compress(data))
                records, size = records + 1, size + len(data)
                if size >= archive_bytes:
                    sink.write(packer.flush())
                    sink.close()
                    sink = None
                    done.append((name, None, records))
            yield manifest(done)
        if sink is not None:
            sink.write(packer.flush())
            sink.close()
            yield manifest([(name, None, records)])

    return written(decided(pages, least_bytes, id_column, payload).mapInArrow(work, MANIFEST), "archives")


def manifest(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["archive", "sidecar", "records"])


class Inflated:
    """The plain bytes of a gzip file, whether one stream or many members, a piece at a time."""

    def __init__(self, source) -> None:
        self.source, self.inflater, self.ready = source, zlib.decompressobj(GZIP), bytearray()

    def more(self) -> bool:
        data = self.inflater.unused_data if self.inflater.eof else self.source.read(PIECE)
        if self.inflater.eof:
            data = data or self.source.read(PIECE)
            self.inflater = zlib.decompressobj(GZIP)
        if not data:
            return False
        self.ready += self.inflater.decompress(data)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """The bytes up to and with the mark; None at the end of the file."""
        seen = 0
        while (at := self.ready.find(mark, seen)) < 0:
            seen = max(0, len(self.ready) - len(mark) + 1)
            if not self.more():
                if self.ready.strip():
                    raise ValueError("the archive ends inside a record")
                return None
        out = bytes(self.ready[: at + len(mark)])
        del self.ready[: at + len(mark)]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.ready and not self.more():
                raise ValueError("the archive ends inside a record")
            part = bytes(self.ready[: min(n, PIECE)])
            del self.ready[: len(part)]
            n -= len(part)
            if part:
                yield part


def headers(block: bytes) -> dict[str, str]:
    first, *lines = block.strip(b"\r\n").split(b"\r\n")
    if not first.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.decode().partition(":") for line in lines)}


def rewrite(source, sink) -> Iterator[tuple[int, int, str, str]]:
    """Copy an archive record by record, each as a gzip member; (offset, length, type, id) of every record."""
    stream, offset = Inflated(source), 0
    while (head := stream.until(b"\r\n\r\n")) is not None:
        head = head.lstrip(b"\r\n")
        fields, packer, length = headers(head), zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP), 0
        for part in parts(head, stream, int(fields["content-length"])):
            length += sink.write(packed) if (packed := packer.compress(part)) else 0
        length += sink.write(packer.flush())
        yield offset, length, fields["warc-type"], fields["warc-record-id"]
        offset += length


def parts(head: bytes, stream: Inflated, n: int) -> Iterator[bytes]:
    yield head
    yield from stream.take(n)
    if b"".join(stream.take(4)) != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    yield b"\r\n\r\n"


def normalise(archives: DataFrame, raw: str, folder: str) -> DataFrame:
    """Rewrite every archive of the folder ``raw``; (archive, sidecar, records) of the new ones. One task takes one archive and holds a piece of it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (fs, place), (raw_fs, raw_place) = file_system(folder), file_system(raw)
        fs.create_dir(place)
        for b in batches:
            done = []
            for name, expected in zip(b.column("archive").to_pylist(), b.column("records").to_pylist(), strict=True):
                new = f"{uuid.uuid4().hex}.warc.gz"
                with raw_fs.open_input_stream(f"{raw_place}/{name}", compression=None) as source, fs.open_output_stream(f"{place}/{new}", compression=None) as sink:
                    found = list(rewrite(source, sink))
                if len(found) != expected:
                    raise ValueError(f"{name}: {len(found)} records, {expected} were written")
                with fs.open_output_stream(f"{place}/{new}.idx", compression=None) as side:
                    side.write("".join(f"{o}\t{n}\t{kind}\t{i}\n" for o, n, kind, i in found).encode())
                done.append((new, f"{new}.idx", len(found)))
            yield manifest(done)

    spread = archives.repartition(max(1, archives.count()), F.xxhash64("archive"))
    return written(spread.mapInArrow(work, MANIFEST), "normalised")


RECORDS = "id long, record_type string, refers_to long, payload_bytes long, payload_digest string"


def read_records(archives: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """(id, record_type, refers_to, payload_bytes, payload_digest[, url, payload]) of every record, member by member through the index.

    Length and digest are taken from the payload read; those of a revisit are null here.
    """
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()] + [pa.string(), pa.binary()] * with_payload
    names = ["id", "record_type", "refers_to", "payload_bytes", "payload_digest"] + ["url", "payload"] * with_payload

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, place = file_system(folder)
        for b in batches:
            for name, side in zip(b.column("archive").to_pylist(), b.column("sidecar").to_pylist(), strict=True):
                with fs.open_input_stream(f"{place}/{side}", compression=None) as f:
                    index = [line.split("\t") for line in f.read().decode().splitlines()]
                rows, held = [], 0
                with fs.open_input_file(f"{place}/{name}") as source:
                    for offset, length, kind, _ in index:
                        source.seek(int(offset))
                        plain = zlib.decompress(source.read(int(length)), GZIP)
                        rows.append(parsed(plain, kind, with_payload))
                        held += len(plain) if with_payload else 200
                        if held >= 8 << 20:
                            yield columns(rows, names, kinds)
                            rows, held = [], 0
                yield columns(rows, names, kinds)

    more = ", url string, payload binary" if with_payload else ""
    spread = archives.repartition(max(1, archives.count()), F.xxhash64("archive"))
    return spread.mapInArrow(work, RECORDS + more)


def columns(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)


def parsed(plain: bytes, kind: str, with_payload: bool) -> tuple:
    head, _, rest = plain.partition(b"\r\n\r\n")
    fields = headers(head)
    number = lambda v: int(d) if (d := v.removeprefix("<urn:page:").rstrip(">")) else None
    payload = rest[: int(fields["content-length"])]
    full = kind == "response"
    digest = hashlib.sha1(payload).hexdigest() if full else None
    if full and base64.b32encode(bytes.fromhex(digest)).decode() != fields["warc-payload-digest"].removeprefix("sha1:"):
        raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
    own = (number(fields["warc-record-id"]), kind, None if full else number(fields["warc-refers-to"]), len(payload) if full else None, digest)
    return own + ((fields.get("warc-target-uri"), payload) if with_payload else ())


def archive(pages: DataFrame, folder: str, least_bytes: int = 1000, id_column: str = "page_id", payload: str = "html") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page, written to archives below ``folder`` and read back.

    Of pages with equal payloads of at least ``least_bytes`` bytes, the one with the largest id is the response, as is every row that
    repeats it; the others are revisits of it, and take length and digest from it. Null payloads are empty, null urls are left
    out of the record. Rows without an id never become the one that others refer to. An empty table gives no rows; other columns
    are ignored.
    """
    raw = join_path(folder, "raw")
    archives = normalise(write_archives(pages, raw, least_bytes, id_column, payload), raw, folder)
    remove(pages.sparkSession, raw)  # the normalised archives are complete
    records = written(read_records(archives, folder), "records")
    seen = records.where("record_type = 'revisit'").select(F.col("refers_to").alias("id")).distinct()
    full = records.where("record_type = 'response'").join(seen, "id", "left_semi")
    full = written(full.groupBy(F.col("id").alias("refers_to")).agg(F.max(F.struct("payload_bytes", "payload_digest")).alias("_full")), "referred")
    joined = with_small(records, full, "refers_to", "left")
    pick = lambda c: F.coalesce(c, f"_full.{c}").alias(c)
    return joined.select(F.col("id").alias(id_column), pick("payload_bytes"), pick("payload_digest"), "record_type", "refers_to")
