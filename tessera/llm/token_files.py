"""Token ids in seekable Zstandard files, in ascending document order.

A file holds the ids (unsigned 32-bit, little-endian) of a range of documents as independent
Zstandard frames of whole documents (a document longer than a frame takes several), each with its
content checksum; then, in a skippable frame, the compressed document directory; and last, in a
skippable frame, the seek table of the Zstandard seekable format with sizes and checksum of every
frame. Any Zstandard tool can decompress a file; a reader that wants some documents reads the
tail, and then fetches and decompresses only the frames that hold them.

Documents are dealt to files by ranges of their id (one shuffle of the texts); every task sorts
its range and streams it out. A file is written under a name of the attempt and renamed to its
final name, so a task that runs again gives the same file. The driver sees one small row a file.

Files are opened through pyarrow's filesystems by URI (local or shared folders, S3, GCS, HDFS).

Defined cases: null text is empty and has the end id alone; a null doc_id comes first and stays
null; rows that repeat an id are documents of their own, in the order of a hash of their texts;
an empty table gives no files; columns other than id and text are not written.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.bpe import codec, encoded_slices, read_vocabulary
from tessera.session import checkpoint_dir

FRAME_IDS = 1 << 16
LEVEL = 1
#: Fixed values of the Zstandard formats.
SKIPPABLE, SEEK_SKIPPABLE, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
FILES = "part int, path string, n_docs long, n_tokens long"


def open_fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class Writer:
    """Writes one file; add() takes documents in order."""

    def __init__(self, out):
        self.out, self.zip = out, zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.seek, self.ids, self.sizes, self.held, self.n = [], [], [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.sizes.append(len(ids))
        if self.n and self.n + len(ids) > FRAME_IDS:
            self.flush()
        for lo in range(0, len(ids), FRAME_IDS):
            self.held.append(ids[lo : lo + FRAME_IDS])
            self.n += len(self.held[-1])
            if self.n >= FRAME_IDS:
                self.flush()

    def flush(self) -> None:
        if self.n:
            raw = np.concatenate(self.held).astype("<u4").tobytes()
            frame = self.zip.compress(raw)
            self.seek.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.out.write(frame)
            self.held, self.n = [], 0

    def close(self) -> None:
        self.flush()
        known = np.array([x is not None for x in self.ids], "u1")
        directory = np.array([x or 0 for x in self.ids], "<i8").tobytes() + np.array(self.sizes, "<i8").tobytes() + known.tobytes()
        packed = self.zip.compress(directory)
        self.out.write(struct.pack("<II", SKIPPABLE, len(packed)) + packed)
        table = b"".join(struct.pack("<III", *x) for x in self.seek)
        self.out.write(struct.pack("<II", SEEK_SKIPPABLE, len(table) + 9) + table + struct.pack("<IBI", len(self.seek), 0x80, SEEK_MAGIC))


class Reader:
    """Reads one file; only the tail until documents are asked for."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEK_MAGIC or not flags & 0x80:
            raise ValueError("no seek table")
        source.seek(size - 9 - 12 * n)
        self.seek = np.frombuffer(source.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.seek[:, 0])])
        self.raw = np.concatenate([[0], np.cumsum(self.seek[:, 1])]) // 4
        source.seek(int(self.at[-1]))
        _, length = struct.unpack("<II", source.read(8))
        self.unzip = zstandard.ZstdDecompressor()
        directory = self.unzip.decompress(source.read(length))
        docs = len(directory) // 17
        self.doc_ids = np.frombuffer(directory, "<i8", docs)
        self.bounds = np.concatenate([[0], np.cumsum(np.frombuffer(directory, "<i8", docs, 8 * docs))])
        self.known = np.frombuffer(directory, "u1", docs, 16 * docs).astype(bool)

    def frame(self, k: int) -> np.ndarray:
        self.source.seek(int(self.at[k]))
        raw = self.unzip.decompress(self.source.read(int(self.seek[k, 0])))
        if len(raw) != self.seek[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.seek[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(raw, "<u4")

    def documents(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) of the wanted rows, ascending; each frame is read once, no other frame is."""
        last, held = -1, None
        for r in rows.tolist():
            a, z = int(self.bounds[r]), int(self.bounds[r + 1])
            parts, k = [], int(np.searchsorted(self.raw, a, "right")) - 1
            while a < z:
                if k != last:
                    held, last = self.frame(k), k
                stop = min(z, int(self.raw[k + 1]))
                parts.append(held[a - self.raw[k] : stop - self.raw[k]])
                a, k = stop, k + 1
            yield r, np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def write_tokens(docs: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 0) -> list[tuple[int, str, int, int, int]]:
    """Writes docs' ids below folder; (part, path, documents, ids, ids of all files before) for each file."""
    source = read_vocabulary(docs, path)
    end = np.array([] if end_id is None else [end_id], np.uint32)
    fs, place = open_fs(folder)
    fs.create_dir(place, recursive=True)

    def run(batches):
        fs, place = open_fs(folder)
        fs.create_dir(place, recursive=True)
        task = TaskContext.get()
        part = task.partitionId()
        name, trial = f"{place}/part-{part:06d}.zst", f"{place}/.part-{part:06d}-{task.taskAttemptId()}"
        writer, total, coder = None, 0, codec(source.value)
        for batch in batches:
            for rows, ids in encoded_slices(batch, "text", coder):
                for doc_id, x in zip(rows.column("doc_id").to_pylist(), ids, strict=True):
                    writer = writer or Writer(fs.open_output_stream(trial, compression=None))
                    writer.add(doc_id, np.concatenate([x, end]))
                    total += len(x) + len(end)
        if writer:
            writer.close()
            writer.out.close()
            fs.move(trial, name)
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [name], "n_docs": [len(writer.ids)], "n_tokens": [total]})

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    dealt = texts.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    out, start = [], 0
    for x in sorted(dealt.mapInArrow(run, FILES).collect()):
        out.append((*x, start))
        start += x["n_tokens"]
    return out


def read_tokens(spark: SparkSession, folder: str, files: list, digest: Callable[[np.ndarray], int] | None = None, wanted: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens, and ids (or digest(ids) as a long).

    wanted(doc_ids) marks the documents to fetch; the others' frames are not read.
    """
    last = T.StructField("digest", T.LongType()) if digest else T.StructField("ids", T.ArrayType(T.LongType(), False))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), last])
    rows = spark.createDataFrame([(x[1], x[4]) for x in files], "path string, start long")

    def run(batches):
        fs, _ = open_fs(folder)
        for batch in batches:
            for path, start in zip(*(batch.column(c).to_pylist() for c in ("path", "start")), strict=True):
                with fs.open_input_file(path) as f:
                    reader = Reader(f, f.size())
                    rows = np.arange(len(reader.doc_ids)) if wanted is None else np.flatnonzero(wanted(reader.doc_ids) & reader.known)
                    for lo in range(0, len(rows), 2048):
                        part = rows[lo : lo + 2048]
                        values = [digest(x) if digest else x.astype(np.int64) for _, x in reader.documents(part)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(reader.doc_ids[part], mask=~reader.known[part]), pa.array(start + reader.bounds[part]), pa.array(np.diff(reader.bounds)[part]), pa.array(values, pa.int64() if digest else pa.list_(pa.int64()))],
                            names=["doc_id", "start", "n_tokens", last.name],
                        )

    return rows.repartition(max(1, len(files)), "path").mapInArrow(run, schema)


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder in the folder that the cluster shares."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{kind}-{uuid.uuid4().hex}"
