from __future__ import annotations

import hashlib

from tickloom.llm import warc
from tickloom.session import Scratch

PAGES = "page_id long, url string, html string, file string"


def expected(rows):
    newest = {}
    for page, _, html, _ in rows:
        payload = (html or "").encode()
        if len(payload) >= 1000 and page is not None:
            newest[payload] = max(page, newest.get(payload, page))
    out = []
    for page, _, html, _ in rows:
        payload = (html or "").encode()
        to = newest.get(payload)
        revisit = to is not None and page != to
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def round_trip(spark, rows):
    scratch = Scratch(spark)
    path = scratch.path("archives")
    warc.write_archives(scratch, spark.createDataFrame(rows, PAGES), path)
    found = []
    for r in warc.read_archives(scratch, path).collect():
        response = r["record_type"] == "response"
        found.append(
            (r["page_id"], r["body_bytes"] if response else r["payload_bytes"], r["body_digest"] if response else r["payload_digest"], r["record_type"], r["refers_to"])
        )
    return sorted(found, key=str)


def test_magic_inside_payloads_nulls_ties_and_split_files(spark):
    inner = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    cut = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 99999\r\n\r\nx"
    rows = [
        (1, "http://a/1", "<p>short</p>", "x"),
        (2, "http://a/2", f"before {inner} after", "x"),
        (3, "http://a/3", inner, "x"),
        (4, None, None, None),
        (5, "http://a/\r\nWARC/1.0\r\n", "", "x"),
        (6, "http://a/6", "WARC/1.0\r\nWARC/1.0\r\nWAWARC/1.0\r\n\r\n\r\n", "x"),
        (None, None, "no key", None),
        (7, "http://a/7", f"{cut} {inner}" * 3, "x"),
        (8, "http://a/8", "é" * 3000, "x"),
        (9, "http://a/9", "é" * 3000, "x"),
        (9, "http://a/9", "é" * 3000, "x"),
        (10, "http://a/10", "y" * 999, "x"),
        (11, "http://a/11", "y" * 999, "x"),
        (None, "http://a/12", "é" * 3000, "x"),
    ] + [(100 + i, f"http://b/{i}", (f"text {i} " * (i % 50)) + (inner if i % 7 == 0 else "") + "WARC/1.0\r\n" * (i % 3), "x") for i in range(300)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert round_trip(spark, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_no_pages(spark):
    assert round_trip(spark, []) == []
