"""Web archives: WARC records compressed one by one with a Zstandard dictionary.

Of the records with one payload the one with the largest page id is written as response, the
others as revisits that refer to it. The payload digests are counted first (partially summed, so a
payload that a third of all pages share is no hot group). Payloads held by more than one in
`HOT_SHARE` of the pages are fewer than `HOT_SHARE` by arithmetic: these are broadcast; the other
repeated ones are joined by shuffle, where no key is then larger than that share.

Each task writes one archive: the first records, up to `SAMPLE_BYTES`, train a dictionary, which
leads the file in a skippable frame (as the WARC Zstandard convention has it); every record is a
frame of its own. A file is written under a name of the attempt and renamed to its final name.
Archives are read back by streaming them record by record, the dictionary first.

Defined cases: null html is an empty payload; a null url is written as an empty target; a null page
id comes before all others and is null when read back, and is a response if its payload has no
other id; rows that repeat the largest page id of a payload are all responses; an empty table gives
no archives; line breaks in a url are percent-encoded; other columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.token_files import open_fs

HOT_SHARE = 1000
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
READ_BYTES = 1 << 20
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "part int, path string, n_records long"


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"),
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest, revisit = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def page(x: str) -> int | None:
        x = x.removeprefix("<urn:page:").removesuffix(">")
        return None if x == "none" else int(x)

    return {"page_id": page(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload": payload, "payload_bytes": size, "payload_digest": digest, "record_type": "revisit" if revisit else "response", "refers_to": page(fields["WARC-Refers-To"]) if revisit else None}


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def mark_revisits(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """page_id, url, html, refers_to (largest page id of the payload), revisit."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    counted = rows.groupBy("digest").agg(F.count("*").alias("copies"), F.max("page_id").alias("largest"), F.first(F.octet_length("html")).alias("size"))
    repeated = counted.filter((F.col("copies") > 1) & (F.col("size") >= min_payload))
    least = max(1, rows.count() // HOT_SHARE)
    hot = repeated.filter(F.col("copies") > least).select("digest", F.col("largest").alias("hot_largest"), F.lit(True).alias("is_hot"))
    rest = repeated.filter(F.col("copies") <= least).select(F.col("digest").alias("join_key"), "largest", F.lit(True).alias("is_repeated"))
    out = rows.join(F.broadcast(hot), "digest", "left")
    # rows that are settled get a key of their own, so no key of the shuffle is hot
    key = F.when(F.col("is_hot"), F.concat(F.lit("#"), F.xxhash64("page_id", "url").cast("string"))).otherwise(F.col("digest"))
    out = out.withColumn("join_key", key).join(rest, "join_key", "left")
    found = F.when(F.col("is_hot"), F.col("hot_largest")).when(F.col("is_repeated"), F.col("largest")).otherwise(F.col("page_id"))
    return out.select("page_id", "url", "html", found.alias("refers_to")).withColumn("revisit", ~F.col("page_id").eqNullSafe(F.col("refers_to")))


def _train(sample: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample)
    except zstandard.ZstdError:  # too few or too uniform records for a dictionary
        return None


def write_archives(pages: DataFrame, folder: str, min_payload: int = 0) -> list[tuple[int, str, int]]:
    """Writes the pages as archives below folder; (part, path, records) for each."""

    def run(batches):
        fs, place = open_fs(folder)
        fs.create_dir(place, recursive=True)
        task = TaskContext.get()
        part = task.partitionId()
        name, trial = f"{place}/part-{part:06d}.warc.zst", f"{place}/.part-{part:06d}-{task.taskAttemptId()}"
        held, size, out, zipper, n = [], 0, None, None, 0

        def start():
            nonlocal out, zipper, held
            out, dictionary = fs.open_output_stream(trial, compression=None), _train(held)
            if dictionary:
                raw = dictionary.as_bytes()
                out.write(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
            zipper = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
            for x in held:
                out.write(zipper.compress(x))
            held = []

        for batch in batches:
            for page_id, url, html, refers_to, revisit in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to", "revisit")), strict=True):
                payload = html.as_py().encode()
                raw = record(page_id.as_py(), url.as_py() or "", payload, base32_sha1(payload), refers_to.as_py(), revisit.as_py())
                n += 1
                if zipper:
                    out.write(zipper.compress(raw))
                    continue
                held.append(raw)
                size += len(raw)
                if size >= SAMPLE_BYTES:
                    start()
        if n:
            if not zipper:
                start()
            out.close()
            fs.move(trial, name)
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [name], "n_records": [n]})

    fs, place = open_fs(folder)
    fs.create_dir(place, recursive=True)
    return sorted(tuple(x) for x in mark_revisits(pages, min_payload).mapInArrow(run, FILES).collect())


def records(source) -> Iterator[bytes]:
    """Decompressed records of an archive, one at a time."""
    buffer = source.read(READ_BYTES)
    dictionary = None
    if len(buffer) >= 8 and struct.unpack("<I", buffer[:4])[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<I", buffer[4:8])[0]
        while len(buffer) < 8 + size:
            buffer += source.read(READ_BYTES)
        dictionary, buffer = zstandard.ZstdCompressionDict(buffer[8 : 8 + size]), buffer[8 + size :]
    unzip = zstandard.ZstdDecompressor(dict_data=dictionary)
    frame, parts, at = unzip.decompressobj(), [], 0
    while True:
        if at >= len(buffer):
            buffer, at = source.read(READ_BYTES), 0
            if not buffer:
                return
        chunk = buffer[at : at + 8192]
        parts.append(frame.decompress(chunk))
        at += len(chunk)
        if frame.eof:
            at -= len(frame.unused_data)
            yield b"".join(parts)
            frame, parts = unzip.decompressobj(), []


def read_archives(spark: SparkSession, folder: str, files: list, with_payload: bool = True) -> DataFrame:
    """One row per record: page_id, url, payload (of responses), payload_bytes, payload_digest, record_type, refers_to."""
    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    if not with_payload:
        del kinds["payload"]
    schema = "page_id long, url string," + " payload binary," * with_payload + " payload_bytes long, payload_digest string, record_type string, refers_to long"
    rows = spark.createDataFrame([(x[1],) for x in files], "path string")

    def batch(held):
        return pa.RecordBatch.from_arrays([pa.array([x[c] for x in held], k) for c, k in kinds.items()], names=list(kinds))

    def run(batches):
        fs, _ = open_fs(folder)
        for paths in batches:
            for path in paths.column("path").to_pylist():
                with fs.open_input_stream(path, compression=None) as source:
                    held, size = [], 0
                    for raw in records(source):
                        held.append(parse(raw))
                        size += len(raw)
                        if size > (4 << 20):
                            yield batch(held)
                            held, size = [], 0
                    if held:
                        yield batch(held)

    return rows.repartition(max(1, len(files)), "path").mapInArrow(run, schema)
