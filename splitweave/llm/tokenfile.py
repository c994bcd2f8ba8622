"""Token ids in files of independent zstandard frames with a seek table and a checksum for each frame.

A shard is a sequence of frames, each a whole zstandard frame of little-endian unsigned 32-bit ids, and then the seek table of
the public seekable format: a skippable frame with (compressed size, decompressed size, low 32 bits of the XXH64) of every
frame and a footer. A reader takes the table from the end of the file and decompresses the frames of the documents it is asked
for. The documents' places stand in an index, a Parquet table written by Spark, which names finished shards only: what a lost
or repeated task has left behind is never read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from splitweave.functions.text import join_path
from splitweave.llm.common import file_system, slabs, small_batches, utf8
from splitweave.llm.tokens import encoder

# Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
WITH_CHECKSUMS = 0x80

FRAME_BYTES = 256 << 10
LEVEL = 3


class FrameWriter:
    """Writes ids as frames of at most ``FRAME_BYTES``; ``close`` adds the seek table."""

    def __init__(self, sink, frame_bytes: int = FRAME_BYTES) -> None:
        self.sink, self.frame_bytes, self.waiting, self.table = sink, frame_bytes, bytearray(), []
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, ids: bytes) -> None:
        """A document that fits stays in one frame; a longer one goes on in further frames."""
        if self.waiting and len(self.waiting) + len(ids) > self.frame_bytes:
            self._frame(len(self.waiting))
        self.waiting += ids
        while len(self.waiting) >= self.frame_bytes:
            self._frame(self.frame_bytes)

    def _frame(self, n: int) -> None:
        plain = bytes(self.waiting[:n])
        del self.waiting[:n]
        packed = self.compressor.compress(plain)
        self.sink.write(packed)
        self.table.append((len(packed), n, xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.waiting:
            self._frame(len(self.waiting))
        entries = b"".join(struct.pack("<III", *t) for t in self.table)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(self.table), WITH_CHECKSUMS, SEEKABLE))


class FrameReader:
    """Random access to the ids of a shard; keeps the frame read last."""

    def __init__(self, source, size: int) -> None:
        self.source, self.last = source, (-1, b"")
        source.seek(size - 9)
        frames, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE or flags != WITH_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        source.seek(size - 9 - 12 * frames)
        table = np.frombuffer(source.read(12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.packed, self.plain, self.sums = np.r_[0, np.cumsum(table[:, 0])], np.r_[0, np.cumsum(table[:, 1])], table[:, 2]
        self.decompressor = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> bytes:
        if self.last[0] != k:
            self.source.seek(int(self.packed[k]))
            packed = self.source.read(int(self.packed[k + 1] - self.packed[k]))
            plain = self.decompressor.decompress(packed, max_output_size=int(self.plain[k + 1] - self.plain[k]))
            if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.sums[k]:
                raise ValueError(f"frame {k} is damaged")
            self.last = (k, plain)
        return self.last[1]

    def read(self, start: int, n: int) -> bytes:
        """``n`` ids from the shard's id ``start`` on, as bytes."""
        low, high, out = 4 * start, 4 * (start + n), []
        k = int(np.searchsorted(self.plain, low, "right")) - 1
        while low < high:
            end = min(high, int(self.plain[k + 1]))
            base = int(self.plain[k])
            out.append(self.frame(k)[low - base : end - base])
            low, k = end, k + 1
        return b"".join(out)


def write_token_file(docs: DataFrame, path: str, vocabulary: str, layout: str = "dropped", end: tuple[int, ...] = (2,), id_column: str = "doc_id", text: str = "text") -> None:
    """Encode all texts and write them in ascending order of id to shards below ``path``, with an index.

    Null and empty texts are the end ids alone. Rows without an id come first; rows that repeat an id stand next to each
    other. An empty table gives an index without rows. Other columns are ignored. One task writes one shard, from rows that
    Spark has put in order by range; it holds a frame and a batch of rows at a time.
    """
    spark = docs.sparkSession
    small_batches(spark)
    tail = np.array(end, "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, writer, done = encoder(vocabulary, layout), None, 0
        name = f"shard-{uuid.uuid4().hex}.zst"
        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                fs, folder = file_system(join_path(path, "shards"))
                fs.create_dir(folder)
                sink = fs.open_output_stream(f"{folder}/{name}", compression=None)
                writer = FrameWriter(sink)
            sizes = []
            for i, j in slabs(utf8(b.column(1))[1], 1 << 20):
                for ids in enc.encode(b.column(1)[i:j].to_pylist()):
                    writer.add(ids + tail)
                    sizes.append(len(ids) // 4 + len(end))
            n = np.array(sizes, np.int64)
            place = done + np.cumsum(n) - n
            done += int(n.sum())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([name] * len(n)), pa.array(place), pa.array(n)], ["doc_id", "shard", "place", "n_tokens"])
        if writer is not None:
            writer.close()
            sink.close()

    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(text).alias("_tie"))
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").drop("_tie")
    kind = docs.schema[id_column].dataType.simpleString()
    index = ordered.mapInArrow(work, f"doc_id {kind}, shard string, place long, n_tokens long")
    index.write.parquet(join_path(path, "index"))


def read_index(spark, path: str, kind: str = "long") -> DataFrame:
    """(doc_id, shard, place, n_tokens, start): ``start`` counts the ids of all documents before it in the whole file."""
    index = spark.read.schema(f"doc_id {kind}, shard string, place long, n_tokens long").parquet(join_path(path, "index"))
    # One row for each shard: its first document decides its place among them.
    shards = index.groupBy("shard").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("head"), F.max(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("last"), F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("head", "last", "shard").rowsBetween(Window.unboundedPreceding, -1)
    base = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return index.join(F.broadcast(base) if base.count() <= 100_000 else base, "shard").select("doc_id", "shard", "place", "n_tokens", (F.col("base") + F.col("place")).alias("start"))


def read_documents(index: DataFrame, path: str, wanted: Column | None = None, with_ids: bool = True) -> DataFrame:
    """The documents of an index, or those wanted: its columns with ids (array<long>, if asked for) and ids_crc32, read from the shards.

    Only the frames that hold them are read and decompressed; each is checked. A damaged frame raises an error.
    """
    rows = index if wanted is None else index.where(wanted)
    schema = StructType([*rows.schema.fields]).add("ids_crc32", LongType())
    schema = schema.add("ids", ArrayType(LongType())) if with_ids else schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_name, reader = None, None
        for b in batches:
            sums, ids = [], []
            for shard, place, n in zip(*(b.column(c).to_pylist() for c in ("shard", "place", "n_tokens")), strict=True):
                if shard != open_name:
                    fs, folder = file_system(join_path(path, "shards"))
                    size = fs.get_file_info(f"{folder}/{shard}").size
                    open_name, reader = shard, FrameReader(fs.open_input_file(f"{folder}/{shard}"), size)
                got = reader.read(place, n)
                sums.append(zlib.crc32(got))
                if with_ids:
                    ids.append(np.frombuffer(got, "<u4").astype(np.int64))
            more = [pa.array(sums, pa.int64())] + ([pa.array(ids, pa.list_(pa.int64()))] if with_ids else [])
            yield pa.RecordBatch.from_arrays([*b.columns, *more], schema.names)

    return rows.mapInArrow(work, schema)
