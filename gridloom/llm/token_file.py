"""Token-id files: independent zstandard frames, a document index and a trailing seek table.

A file is a run of zstandard frames, each holding the little-endian 32-bit ids of whole consecutive
documents; then a skippable frame with the document index (doc_id, number of ids, frame); then a seek
table in zstandard's seekable format: compressed size, size and checksum of each frame (the low 32
bits of XXH64 of its contents).  Any zstandard decoder reads the ids as one stream; a reader of one
document fetches the table, the index and that document's frame.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import scratch_path
from gridloom.llm.tokens import word_ids

ROWS = 1024
"""Texts given to the tokenizer together."""
SKIPPABLE_INDEX, SKIPPABLE_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES, FILE_BYTES = 1 << 18, 1 << 30
"""A frame ends with the document that reaches the first, a file with the one whose ids reach the second."""
INDEX_ROW = np.dtype([("doc_id", "<i8"), ("null_id", "u1"), ("n", "<u8"), ("frame", "<u4"), ("at", "<u8")])
ROW = struct.Struct("<qBQIQ")


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; a bare path is a local one."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


class Writer:
    """Writes documents in the order given; the file appears under its name when closed."""

    def __init__(self, path: str, level: int = 1):
        self.fs, self.path = file_system(path)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.temporary = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.temporary)
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress
        self.pending: list[bytes] = []
        self.size = self.ids = self.documents = 0
        self.frames: list[tuple[int, int, int]] = []
        self.index = bytearray()

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.index += ROW.pack(0 if doc_id is None else doc_id, doc_id is None, len(ids) // 4, len(self.frames), self.size // 4)
        self.documents += 1
        self.ids += len(ids) // 4
        self.pending.append(ids)
        self.size += len(ids)
        if self.size >= FRAME_BYTES:
            self._end_frame()

    def _end_frame(self) -> None:
        if self.pending:
            raw = b"".join(self.pending)
            packed = self.compress(raw)
            self.out.write(packed)
            self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.pending, self.size = [], 0

    def close(self) -> int:
        """Ends the file and returns its number of ids."""
        self._end_frame()
        index = self.compress(bytes(self.index))
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index) + 4) + index + struct.pack("<I", len(index)))
        entries = b"".join(struct.pack("<III", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE_TABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()
        self.fs.move(self.temporary, self.path)
        return self.ids


class Reader:
    """Random access; a frame is decompressed when one of its documents is asked for, and checked."""

    def __init__(self, path: str):
        self.fs, self.path = file_system(path)
        self.file = self.fs.open_input_file(self.path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or not flags & 0x80:
            raise ValueError(f"{path}: no seek table")
        table_at = size - 9 - 12 * n - 8
        if struct.unpack("<II", self._at(table_at, 8)) != (SKIPPABLE_TABLE, 12 * n + 9):
            raise ValueError(f"{path}: broken seek table")
        self.frames = np.frombuffer(self._at(table_at + 8, 12 * n), dtype="<u4").reshape(n, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.frames[:, 0])]).astype(np.int64)
        (packed,) = struct.unpack("<I", self._at(table_at - 4, 4))
        index = self._at(table_at - 4 - packed, packed)
        if int(self.starts[-1]) + 8 + packed + 4 != table_at:
            raise ValueError(f"{path}: frames and index do not fill the file")
        self.index = np.frombuffer(zstandard.ZstdDecompressor().decompress(index), dtype=INDEX_ROW)
        self.held: tuple[int, bytes] = (-1, b"")

    def _at(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at)

    def frame(self, k: int) -> bytes:
        if self.held[0] != k:
            packed, size, check = (int(x) for x in self.frames[k])
            raw = zstandard.ZstdDecompressor().decompress(self._at(int(self.starts[k]), packed), max_output_size=max(1, size))
            if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
                raise ValueError(f"{self.path}: frame {k} fails its checksum")
            self.held = (k, raw)
        return self.held[1]

    def __len__(self) -> int:
        return len(self.index)

    def doc_id(self, k: int) -> int | None:
        return None if self.index[k]["null_id"] else int(self.index[k]["doc_id"])

    def document(self, k: int) -> bytes:
        row = self.index[k]
        if not row["n"]:
            return b""
        at = 4 * int(row["at"])
        return self.frame(int(row["frame"]))[at : at + 4 * int(row["n"])]

    def find(self, doc_id: int) -> Iterator[bytes]:
        """Ids of all documents with this id."""
        for k in np.flatnonzero((self.index["doc_id"] == doc_id) & (self.index["null_id"] == 0)):
            yield self.document(int(k))


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, parts: int | None = None, file_bytes: int = FILE_BYTES) -> list[tuple[int, str, int, int]]:
    """Writes all rows in ascending doc_id order; (part, path, documents, ids) of each file.

    Rows are dealt by ranges of doc_id; a task writes files of about ``file_bytes`` of ids, each under a
    temporary name, and moves them into place, so a repeated task replaces them by the same contents.  The
    list has one row a file.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    end = np.array([end_id], dtype="<u4").tobytes()

    schema = pa.schema([("part", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        writer, ids = None, word_ids(tokenizer)

        def closed(writer: Writer, path: str) -> pa.RecordBatch:
            n = writer.close()
            return pa.RecordBatch.from_pydict({"part": [part], "path": [path], "docs": [writer.documents], "ids": [n]}, schema=schema)

        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            for k in range(0, len(names), ROWS):
                for name, got in zip(names[k : k + ROWS], ids.texts(texts[k : k + ROWS].to_pylist()), strict=True):
                    if writer is None:
                        path = f"{folder}/part-{part:06d}-{number:04d}.tok"
                        writer, number = Writer(path), number + 1
                    writer.add(name, got + end)
                    if writer.ids * 4 >= file_bytes:
                        yield closed(writer, path)
                        writer = None
        if writer:
            yield closed(writer, path)

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(write, "part int, path string, docs long, ids long").collect()
    return [tuple(r) for r in sorted(rows)]


def read_tokens(spark, files: list[tuple[int, str, int, int]]) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""
    before, rows = 0, []
    for _, path, _, ids in sorted(files):
        rows.append((path, before))
        before += ids

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        for batch in batches:
            for path, start in zip(batch["path"], batch["before"], strict=True):
                file = Reader(path)
                n = file.index["n"].astype(np.int64)
                starts = int(start) + np.cumsum(n) - n
                for a in range(0, len(file), 4096):
                    at = range(a, min(a + 4096, len(file)))
                    yield pd.DataFrame({"doc_id": pd.array([file.doc_id(k) for k in at], dtype="Int64"), "start": starts[a : a + 4096], "n_tokens": n[a : a + 4096], "ids_crc32": np.array([zlib.crc32(file.document(k)) for k in at], dtype=np.int64)})

    listed = spark.createDataFrame(rows, "path string, before long").repartition(max(1, min(len(rows), int(spark.conf.get("spark.sql.shuffle.partitions")))), "path")
    return listed.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 2) -> DataFrame:
    """Encodes, writes and reads back every row: doc_id, start, n_tokens, ids_crc32.

    Null texts are empty and hold the end id alone; very long texts are whole, in a frame of their own size.
    Rows with null ids come first, repeated rows and repeated ids follow one another; an empty table writes no file and gives no rows.  Only doc_id and text are
    read, so further columns cannot clash.
    """
    spark = docs.sparkSession
    return read_tokens(spark, write_tokens(docs, folder or scratch_path(spark, "tokens"), tokenizer, end_id))
