"""Archives: exact round trips, revisits, tables and single records."""

from __future__ import annotations

import base64
import hashlib
import io
from collections import defaultdict

import pytest
import zstandard

from callmeter.llm import registry, warc
from tests.llm.cases import clashing

SCHEMA = "page_id long, url string, html string"
ROWS = [
    (1, "u", "x"), (1, "u", "x"), (1, "u", "x"), (2, "v", None), (3, None, ""), (None, None, "x"), (4, "a b\n", "é"),
    (5, "q", None), (5, "q", None), (6, "w", "line\r\n\r\nWARC/1.1\r\n" * 5), (7, "z", "long " * 200_000), (8, "y", "long " * 200_000),
    (None, None, "alone"), (None, "u", "twice"), (None, "w", "twice"),
]


def expected(rows, least=0):
    groups = defaultdict(list)
    for page_id, _, html in rows:
        groups[(html or "").encode()].append(page_id)
    out = []
    for content, ids in groups.items():
        own = base64.b32encode(hashlib.sha1(content).digest()).decode()
        ids.sort(key=lambda i: -1 << 62 if i is None else i)
        for k, i in enumerate(ids):
            revisit = k < len(ids) - 1 and len(content) >= least
            out.append((i, len(content), own, "revisit" if revisit else "response", ids[-1] if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 2])
def test_round_trip(spark, least):
    pages = clashing(spark.createDataFrame(ROWS, SCHEMA))
    found = warc.read_bundles(warc.write_bundles(pages, least))
    assert sorted(map(tuple, found.collect()), key=repr) == expected(ROWS, least)


def test_query_on_given_tables(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()
    found = registry.QUERIES["op4_web_archives"](spark, sf_dir)
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)


def test_empty_table(spark):
    assert warc.page_records(spark.createDataFrame([], SCHEMA)).collect() == []


def test_single_records_and_plain_readers():
    writer, names = warc.BundleWriter(frame_bytes=500), []
    for i in range(40):
        payload = f"<p>{i}</p>".encode() * i
        name, content = warc.record(i, f"https://example.org/{i}", payload, None, warc.digest(payload))
        writer.add(name, content)
        names.append((name, payload, content))
    bundle = writer.close()
    reader = warc.BundleReader(bundle)
    for name, payload, _ in names:
        assert reader.find(name).payload == payload
    assert reader.find("urn:x-page:none") is None
    frames = {frame for _, frame, _, _ in reader.index}
    assert len(frames) > 5 and all(len(reader.frame(k)) == reader._sizes[k, 1] for k in frames)
    # To a reader that knows no tables the bundle is one stream of records.
    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(bundle), read_across_frames=True)
    assert stream.read() == b"".join(content for *_, content in names)


def test_damage_is_found(spark):
    name, content = warc.record(1, None, b"payload", None, warc.digest(b"other"))
    writer = warc.BundleWriter()
    writer.add(name, content)
    bundle = writer.close()
    with pytest.raises(Exception, match="damaged"):
        warc.read_bundles(spark.createDataFrame([(0, bytearray(bundle))], warc.BUNDLES)).collect()
    with pytest.raises(ValueError, match="seek table"):
        warc.BundleReader(bundle[:-1])


def test_exported_files(spark, tmp_path):
    bundles = warc.write_bundles(spark.createDataFrame(ROWS, SCHEMA))
    warc.export_bundles(bundles, str(tmp_path))
    files = spark.read.format("binaryFile").load(f"{tmp_path}/*.warc.zst")
    assert sorted(map(tuple, warc.read_bundles(files).collect()), key=repr) == expected(ROWS)
