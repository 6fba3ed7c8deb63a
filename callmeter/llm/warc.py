"""Web archives in seekable Zstandard bundles.

A page is one WARC record: a response that holds the whole HTTP message, or,
where another record has the same payload, a revisit of that response with the
message's header only. Records are gathered into frames that are compressed
independently. A bundle is its frames, a skippable frame that maps record
identifiers to frames and offsets within them, and a skippable frame that is
the seek table of the Zstandard seekable format. A reader finds the tables
from a bundle's end, and reads one record by decompressing one frame.

Of the pages of equal payload that of largest id is the response; null ids
are smallest. Null html is an empty payload. Of wholly equal pages one is the
response and the others revisit it; their records share an identifier. A null
url leaves out the target, and white space in a url is percent-encoded. An
empty table gives no bundle and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmeter.operators.durable import cut_lineage

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 25
# Payloads of at least so many bytes are written once.
LEAST_SHARED = 0
# Fixed values of the formats.
_SKIPPABLE, _INDEX, _SEEKABLE = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
_DATE = "2024-01-01T00:00:00Z"
BUNDLES = "bundle long, content binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(kind: str, page_id: int | None, payload_digest: str) -> str:
    return f"urn:x-page:{'none' if page_id is None else page_id}:{payload_digest}:{kind}"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: str | None, payload_digest: str) -> tuple[str, bytes]:
    """The identifier and the bytes of a response, or of a revisit of ``refers_to``."""
    kind = "response" if refers_to is None else "revisit"
    name = record_id(kind, page_id, payload_digest)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:?#[]@!$&'()*+,;=~-._"))
    head.append(f"WARC-Payload-Digest: sha1:{payload_digest}")
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <{refers_to}>")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return name, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class BundleWriter:
    """Gathers records into frames, and frames into one bundle."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        self._frame_bytes = frame_bytes
        self._compressor = zstandard.ZstdCompressor(level=3)
        self._open = bytearray()
        self._frames: list[bytes] = []
        self._sizes: list[tuple[int, int]] = []
        self._index: list[tuple[str, int, int, int]] = []

    def add(self, name: str, content: bytes) -> None:
        if self._open and len(self._open) + len(content) > self._frame_bytes:
            self._close_frame()
        self._index.append((name, len(self._sizes), len(self._open), len(content)))
        self._open += content

    def _close_frame(self) -> None:
        frame = self._compressor.compress(bytes(self._open))
        self._sizes.append((len(frame), len(self._open)))
        self._frames.append(frame)
        self._open = bytearray()

    def written(self) -> int:
        return sum(size for size, _ in self._sizes)

    def close(self) -> bytes:
        if self._open:
            self._close_frame()
        index = self._compressor.compress(json.dumps(self._index).encode())
        entries = b"".join(struct.pack("<II", *s) for s in [*self._sizes, (len(index) + 8, 0)])
        footer = entries + struct.pack("<IBI", len(self._sizes) + 1, 0, _SEEKABLE)
        return b"".join(
            [*self._frames, struct.pack("<II", _INDEX, len(index)), index, struct.pack("<II", _SKIPPABLE, len(footer)), footer]
        )


@dataclass
class Record:
    fields: dict[str, str]
    payload: bytes
    http: dict[str, str]

    @property
    def name(self) -> str:
        return self.fields["WARC-Record-ID"].strip("<>")


class BundleReader:
    """Reads a bundle by its tables."""

    def __init__(self, content: bytes):
        self._content = content
        frames, _, magic = struct.unpack("<IBI", content[-9:])
        if magic != _SEEKABLE:
            raise ValueError("no seek table at the end")
        table = content[-9 - 8 * frames : -9]
        sizes = np.frombuffer(table, dtype="<u4").reshape(frames, 2)
        if struct.unpack("<II", content[-17 - 8 * frames : -9 - 8 * frames]) != (_SKIPPABLE, 8 * frames + 9):
            raise ValueError("the seek table is damaged")
        # The last frame is the index, which a plain reader skips.
        self._sizes = sizes[:-1].astype(np.int64)
        self._starts = np.concatenate([[0], np.cumsum(sizes[:, 0].astype(np.int64))])
        self._decompressor = zstandard.ZstdDecompressor()
        index = content[self._starts[-2] + 8 : self._starts[-1]]
        self.index = [tuple(x) for x in json.loads(self._decompressor.decompress(index))]

    def frame(self, k: int) -> bytes:
        data = self._content[self._starts[k] : self._starts[k + 1]]
        return self._decompressor.decompress(data, max_output_size=int(self._sizes[k, 1]))

    def find(self, name: str) -> Record | None:
        """The record of an identifier, or None; one frame is decompressed."""
        for own, frame, offset, length in self.index:
            if own == name:
                return parse(self.frame(frame)[offset : offset + length])
        return None

    def records(self) -> Iterator[Record]:
        current, data = -1, b""
        for _, frame, offset, length in self.index:
            if frame != current:
                current, data = frame, self.frame(frame)
            yield parse(data[offset : offset + length])


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines)


def parse(content: bytes) -> Record:
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('WARC-Record-ID')} is cut off")
    http, _, payload = block.partition(b"\r\n\r\n")
    return Record(fields, payload, _fields(http))


def write_bundles(pages: DataFrame, least_shared: int = LEAST_SHARED) -> DataFrame:
    """The pages' records in bundles: rows of ``BUNDLES``, one for each archive.

    A payload's response is found by its digest, over all pages. Each task
    writes the bundles of its rows.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha", F.sha1("payload"))
    equal = rows.filter(F.length("payload") >= least_shared).groupBy("sha", "page_id", "url")
    # Null ids are smallest, and of equal ids the greatest url is the last page.
    last = F.struct("page_id", "url")
    groups = equal.agg(F.count(F.lit(1)).alias("n")).groupBy("sha").agg(
        F.sum("n").alias("copies"), F.max(last).alias("last"), F.max_by("n", last).alias("last_n")
    )
    groups = cut_lineage(groups.filter("copies > 1").withColumnRenamed("sha", "group_sha"))
    rows = rows.join(groups, rows["sha"] == groups["group_sha"], "left")
    is_last = F.coalesce(last.eqNullSafe(F.col("last")), F.lit(False))
    is_first = is_last & (F.col("last_n") == 1)
    plain = F.col("copies").isNull() | is_first | ~is_last
    records = rows.filter(plain).withColumn("repeats", F.col("copies").isNotNull() & ~is_first)
    if not groups.filter("last_n > 1").isEmpty():
        # Wholly equal last pages: one is the response, the others revisit it.
        one = rows.filter(~plain).dropDuplicates(["sha"])
        places = F.explode(F.sequence(F.lit(1), F.col("last_n").cast("int"))).alias("place")
        one = one.select("*", places).withColumn("repeats", F.col("place") > 1).drop("place")
        records = records.unionByName(one)
    records = records.select("page_id", "url", "payload", "repeats", F.col("last.page_id").alias("last_id"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, writer, held = TaskContext.get().partitionId() << 36, BundleWriter(), 0
        for batch in batches:
            for page_id, url, content, repeats, last_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = digest(content)
                refers_to = record_id("response", last_id, own) if repeats else None
                writer.add(*record(page_id, url, content, refers_to, own))
                held += 1
                if writer.written() >= BUNDLE_BYTES:
                    yield _bundle(number, writer)
                    number, writer, held = number + 1, BundleWriter(), 0
        if held:
            yield _bundle(number, writer)

    return records.mapInArrow(write, BUNDLES)


def _bundle(number: int, writer: BundleWriter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([writer.close()], pa.binary())], names=["bundle", "content"])


def read_bundles(bundles: DataFrame) -> DataFrame:
    """Per record of the bundles in ``content``: page_id, payload_bytes, payload_digest, record_type and refers_to.

    The payload of a response is checked against its digest; a revisit's size
    and digest are those of the payload it refers to, from its own headers.
    """
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def page_of(name: str) -> int | None:
        number = name.strip("<>").split(":")[2]
        return None if number == "none" else int(number)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out: list[list] = [[], [], [], [], []]
                for r in BundleReader(content.as_py()).records():
                    kind, own = r.fields["WARC-Type"], r.fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(r.http["Content-Length"])
                    if kind == "response" and (digest(r.payload) != own or len(r.payload) != size):
                        raise ValueError(f"the payload of {r.name} is damaged")
                    refers_to = page_of(r.fields["WARC-Refers-To"]) if kind == "revisit" else None
                    for column, value in zip(out, (page_of(r.name), size, own, kind, refers_to), strict=True):
                        column.append(value)
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, types, strict=True)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )

    return bundles.select("content").mapInArrow(read, schema)


def export_bundles(bundles: DataFrame, folder: str) -> None:
    """Write each bundle as a file ``<number>.warc.zst`` to a folder that all executors mount."""

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column(0), batch.column(1), strict=True):
                with open(f"{folder}/{number.as_py()}.warc.zst", "wb") as file:
                    file.write(content.as_py())
        yield pa.RecordBatch.from_pydict({"done": pa.array([1], pa.int64())})

    bundles.select("bundle", "content").mapInArrow(save, "done long").agg(F.sum("done")).collect()


def page_records(pages: DataFrame) -> DataFrame:
    """Write the pages to stored archives and read them back."""
    return read_bundles(cut_lineage(write_bundles(pages)))
