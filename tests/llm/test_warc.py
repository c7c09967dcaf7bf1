"""What is read back, random access by the index, and the bundle format."""

from __future__ import annotations

import base64
import hashlib
import struct

import pytest
import zstandard
from tierline.llm import warc as W


def expected(rows, least_bytes=0):
    out = []
    by_payload = {}
    for page_id, _, html in rows:
        by_payload.setdefault(html or "", []).append(page_id)
    for page_id, _, html in rows:
        data = (html or "").encode()
        ids = [i for i in by_payload[html or ""] if i is not None]
        revisit = len(data) >= least_bytes and bool(ids) and page_id != max(ids)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "revisit" if revisit else "response", max(ids) if revisit else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a/é x\r\n", "same"), (2, None, "same"), (7, "http://b", "same"), (3, "u", None), (4, "u", ""), (5, "u", "é" * 70_000),
    (6, "u", "other\r\n\r\nWARC/1.1\r\n"), (6, "u", "other\r\n\r\nWARC/1.1\r\n"), (None, "u", "same"), (None, "u", "no id"), (8, "u", "x"), (9, "u", "x"),
]


@pytest.mark.parametrize("least_bytes", [0, 3])
def test_round_trip(spark, tmp_dir, monkeypatch, least_bytes):
    monkeypatch.setattr(W, "FRAME_BYTES", 600)
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "'d' AS digest", "1 AS response")
    index = W.write_archives(pages, f"file://{tmp_dir}/w", least_bytes=least_bytes)
    got = [tuple(r)[:5] for r in W.read_archives(index).collect()]
    assert sorted(got, key=repr) == expected(ROWS, least_bytes)
    # every record by its index entry alone
    for r in index.collect():
        fields, body = W.read_record(r.bundle, r.frame, r.offset)
        assert fields["WARC-Record-ID"] == f"<urn:page:{'' if r.page_id is None else r.page_id}>"
        if fields["WARC-Type"] == "response":
            assert W.payload_digest(body) == fields["WARC-Payload-Digest"].removeprefix("sha1:")
        else:
            assert body == b"" and fields["WARC-Refers-To"].startswith("<urn:page:")
    assert W.read_archives(W.write_archives(pages.limit(0), f"file://{tmp_dir}/none")).collect() == []


def test_format(tmp_path, monkeypatch):
    """Frames are independent, and a reader without the table reads on."""
    monkeypatch.setattr(W, "FRAME_BYTES", 100)
    path = tmp_path / "b.warc.zst"
    bundle = W.Bundle(path.open("wb"))
    records = [W.record(i, "u", b"p" * i * 37, False, None) for i in range(9)]
    places = [bundle.add(r) for r in records]
    bundle.close()
    raw = path.read_bytes()
    n, flags, magic = struct.unpack("<IBI", raw[-9:])
    assert (flags, magic) == (0, 0x8F92EAB1) and n == places[-1][0] + 1
    with zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True) as reader:
        assert reader.read() == b"".join(records)
    reader = W.Reader(str(path))
    for record, (frame, offset, length) in zip(records, places, strict=True):
        assert reader.frame(frame)[offset : offset + length] == record


def test_archive_of_a_table(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    assert sorted((tuple(r)[:5] for r in W.archive(pages).collect()), key=repr) == expected(ROWS)


def test_read_back_is_spread(spark, tmp_dir, monkeypatch):
    """Many bundles, and frames of one bundle, are read by several tasks."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(W, "READ_BYTES", 60_000)
    pages = spark.range(4000).selectExpr("id AS page_id", "'u' AS url", "repeat(sha2(string(id), 256), 4) AS html").repartition(4)
    index = W.write_archives(pages, f"file://{tmp_dir}/w", frame_bytes=2000, bundle_bytes=4000)
    assert index.select("bundle").distinct().count() >= 16
    back = W.read_archives(index).withColumn("task", F.spark_partition_id())
    per_task = [r["count"] for r in back.groupBy("task").count().collect()]
    assert len(per_task) >= 8 and sum(per_task) == 4000 and max(per_task) < 1500
    monkeypatch.setattr(W, "READ_FRAMES", 1)
    one = W.write_archives(pages.coalesce(1), f"file://{tmp_dir}/one", frame_bytes=2000)
    assert one.select("bundle").distinct().count() == 1
    back = W.read_archives(one).withColumn("task", F.spark_partition_id())
    assert back.select("task").distinct().count() >= 8 and back.count() == 4000


def test_wrong_index_is_noticed(spark, tmp_dir):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame(ROWS[:3], "page_id long, url string, html string")
    index = W.write_archives(pages, f"file://{tmp_dir}/w")
    with pytest.raises(Exception, match="damaged"):
        W.read_archives(index.withColumn("length", F.col("length") + 1)).collect()
