"""Token ids in files that can be read document by document.

A file holds one zstandard frame for each document: its ids as little-endian unsigned 32-bit
integers. Two skippable frames follow. The first lists the documents: for each a byte that
says whether there is a doc_id, and the doc_id as a little-endian signed 64-bit integer. The second is the
seek table of the public seekable format: for each frame its compressed and decompressed size and the
low 32 bits of the XXH64 of its content, then the number of frames, a byte of flags and a magic
number. So any zstandard tool can decompress a file, and a reader that wants some
documents reads the end of the file, then only their frames.

Documents are in ascending order of doc_id, those without one first; rows with equal doc_id by a hash
of their text. Null texts are empty: only the end id. An empty table gives no file. Other
columns are left out. A task writes its file under a name of its own and then moves it to its place,
so a task that runs twice leaves one whole file.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as filesystems
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.encode import ID, encoder
from tarmac.llm.store import id_and_text, saved

SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80  # flag: the table has checksums
ENTRY = np.dtype([("compressed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
DOCUMENT = np.dtype([("known", "u1"), ("doc_id", "<i8")])
FOOTER = struct.Struct("<IBI")
HEADER = struct.Struct("<II")


class Writer:
    """Writes one file to a binary stream."""

    def __init__(self, stream, level: int = 3):
        self.stream = stream
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=False)
        self.entries: list[tuple[int, int, int]] = []
        self.documents: list[tuple[bool, int]] = []

    def add(self, doc_id: int | None, content: bytes) -> None:
        frame = self.compressor.compress(content)
        self.stream.write(frame)
        self.entries.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.documents.append((doc_id is not None, doc_id or 0))

    def finish(self) -> None:
        index = np.array(self.documents, DOCUMENT).tobytes()
        self.stream.write(HEADER.pack(SKIPPABLE_INDEX, len(index)) + index)
        entries = [*self.entries, (HEADER.size + len(index), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)]
        table = np.array(entries, ENTRY).tobytes() + FOOTER.pack(len(entries), CHECKSUMS, SEEKABLE)
        self.stream.write(HEADER.pack(SKIPPABLE_SEEK_TABLE, len(table)) + table)


class Reader:
    """Reads one file of which any part can be read; ``source`` has size() and read_at(n, offset)."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        count, flags, magic = FOOTER.unpack(source.read_at(FOOTER.size, size - FOOTER.size))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        length = count * ENTRY.itemsize
        entries = np.frombuffer(source.read_at(length, size - FOOTER.size - length), ENTRY)
        self.frames, index = entries[:-1], entries[-1]
        self.offsets = np.concatenate([[0], np.cumsum(self.frames["compressed"], dtype=np.int64)])
        raw = source.read_at(int(index["compressed"]) - HEADER.size, int(self.offsets[-1]) + HEADER.size)
        self.documents = np.frombuffer(raw, DOCUMENT)
        self.starts = np.concatenate([[0], np.cumsum(self.frames["size"], dtype=np.int64)]) // ID.itemsize
        self.decompressor = zstandard.ZstdDecompressor()

    def doc_id(self, k: int) -> int | None:
        return int(self.documents["doc_id"][k]) if self.documents["known"][k] else None

    def content(self, k: int) -> bytes:
        """The ids of the k-th document; an error if they aren't what was written."""
        frame = self.source.read_at(int(self.frames["compressed"][k]), int(self.offsets[k]))
        size = int(self.frames["size"][k])
        found = self.decompressor.decompress(frame, max_output_size=size) if size else b""
        if len(found) != size or xxhash.xxh64_intdigest(found) & 0xFFFFFFFF != self.frames["checksum"][k]:
            raise ValueError(f"document {k} of the file is damaged")
        return found


def _filesystem(path: str):
    return filesystems.FileSystem.from_uri(path)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Encodes the documents into files under ``path``; returns a row for each file: ``part`` (its
    place in the order), ``file``, ``n_docs``, ``n_tokens``, ``first_id``, ``last_id`` and ``start``, the number
    of ids in the files before it."""
    hashed = F.xxhash64("text")
    ordered = id_and_text(docs).repartitionByRange(F.col("doc_id"), hashed).sortWithinPartitions("doc_id", hashed, "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids_of = encoder(tokenizer, end_id)
        target, folder = _filesystem(path)
        name = f"{folder}/tokens-{part:06d}.zst"
        own = f"{folder}/.tokens-{part:06d}-{uuid.uuid4().hex}"
        stream, writer, tokens = None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                target.create_dir(folder, recursive=True)
                stream = target.open_output_stream(own)
                writer = Writer(stream)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_of.encode(batch.column("text").to_pylist())):
                writer.add(doc_id, ids)
                tokens += len(ids) // ID.itemsize
        if writer is None:
            return
        writer.finish()
        stream.close()
        target.move(own, name)
        known = [i for there, i in writer.documents if there]
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "part": part, "file": name, "n_docs": len(writer.documents), "n_tokens": tokens,
                    "first_id": known[0] if known else None, "last_id": known[-1] if known else None,
                }
            ],
            schema=pa.schema(
                [("part", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                 ("first_id", pa.int64()), ("last_id", pa.int64())]
            ),
        )

    files = saved(
        ordered.mapInArrow(write, "part long, file string, n_docs long, n_tokens long, first_id long, last_id long"), "files"
    )
    # one row for each file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return saved(files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "manifest")


def read_token_files(files: DataFrame, path: str, only: list[int] | None = None) -> DataFrame:
    """doc_id, ``start`` (ids of all documents before it) and ``ids`` (bytes) of the documents, or of
    those in ``only``: then other files aren't opened and other documents aren't decompressed."""
    wanted = None if only is None else frozenset(only)
    if wanted is not None:
        files = files.where(F.exists(F.array(*map(F.lit, sorted(wanted))).cast("array<long>"), lambda i: i.between(F.col("first_id"), F.col("last_id"))))
    count = max(1, files.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = _filesystem(path)[0]
        for batch in batches:
            for row in batch.to_pylist():
                with source.open_input_file(row["file"]) as f:
                    reader = Reader(f)
                    rows: list[tuple] = []
                    size = 0
                    for k in range(len(reader.documents)):
                        if wanted is not None and reader.doc_id(k) not in wanted:
                            continue
                        rows.append((reader.doc_id(k), row["start"] + int(reader.starts[k]), reader.content(k)))
                        size += len(rows[-1][2])
                        if size > 8_000_000:
                            yield _documents(rows)
                            rows, size = [], 0
                    yield _documents(rows)

    return files.select("part", "file", "start").repartitionByRange(count, "part").mapInArrow(
        read, "doc_id long, start long, ids binary"
    )


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    ids, starts, contents = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(contents, pa.binary())], ["doc_id", "start", "ids"]
    )
