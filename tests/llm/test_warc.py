import hashlib

import pytest

from sluicebox.llm import warc
from sluicebox.llm.warc import Bundle, archive_pages, parse_records, read_frame, read_record, record, seek_table, write_bundles

PAGES = "page_id bigint, url string, html string, digest string, first bigint, id int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], PAGES)


def test_bundle_round_trip_and_seek():
    bundle, data = Bundle(frame_bytes=300), []
    for k in range(40):
        payload = (f"page {k} é ".encode() * (k * k % 50))
        data.append(payload)
        bundle.add(k, record(k, f"http://x/{k}", payload, "d", None))
    archive = bundle.close()
    frames = seek_table(archive)
    assert len(frames) > 5
    for page_id, frame, offset in bundle.index:
        headers, body = read_record(archive, frame, offset)
        assert headers["WARC-Record-ID"] == f"<urn:page:{page_id}>" and body == data[page_id]
    assert [b for f in frames for _, _, b in parse_records(read_frame(archive, f))] == data
    with pytest.raises(ValueError):
        seek_table(archive[:-1] + b"x")


def test_archive_pages(spark, monkeypatch):
    long, short = "é" * 60, "x" * 99
    rows = [(5, "u", long), (3, "v\r\nw: z", long), (9, None, long), (1, "u", short), (2, "u", short), (7, "u", None), (8, "u", ""),
            (10, "u", "y" * 700_000), (11, "u", "a\r\n\r\nb" * 30), (3, "again", long)]
    got = sorted(map(tuple, archive_pages(pages(spark, rows)).select("page_id", "payload_bytes", "record_type", "refers_to").collect()), key=str)
    assert got == sorted([(5, 120, "revisit", 3), (3, 120, "response", None), (3, 120, "response", None), (9, 120, "revisit", 3),
                          (1, 99, "response", None), (2, 99, "response", None), (7, 0, "response", None), (8, 0, "response", None),
                          (10, 700_000, "response", None), (11, 180, "response", None)], key=str)
    assert archive_pages(pages(spark, [])).count() == 0


def test_index_leads_to_records(spark):
    rows = [(k, f"http://h/{k}", f"text {k} " * k) for k in range(200)]
    seen = 0
    for bundle in write_bundles(pages(spark, rows)).collect():
        for r in bundle["records"]:
            headers, body = read_record(bytes(bundle["archive"]), r["frame"], r["offset"])
            assert headers["WARC-Record-ID"] == f"<urn:page:{r['page_id']}>"
            assert body.decode() == rows[r["page_id"]][2]
            seen += 1
    assert seen == 200


def test_no_file_is_left_by_tasks():
    assert warc.BUNDLE_BYTES > warc.FRAME_BYTES


def test_one_id_with_other_payloads(spark):
    """Only the payload that stands under a smaller id is left out."""
    a, b, c = "a" * 200, "b" * 200, "c" * 300
    rows = [(1, "u", a), (2, "u", b), (5, "u", a), (5, "u", b), (5, "u", c)]
    got = sorted(map(tuple, archive_pages(pages(spark, rows)).select("page_id", "payload_digest", "record_type", "refers_to").collect()), key=str)
    digest = lambda html: hashlib.sha256(html.encode()).hexdigest()
    assert got == sorted([(1, digest(a), "response", None), (2, digest(b), "response", None), (5, digest(a), "revisit", 1),
                          (5, digest(b), "revisit", 2), (5, digest(c), "response", None)], key=str)
