"""WARC writing and reading: magic inside payloads, split boundaries, broken chains."""

import hashlib
import os

import pytest

from retentia.llm.op6_warc import MAGIC, read_warc, write_warc
from retentia.session import scratch

PAGE = "page_id long, url string, html string, digest string, size int"
LONG = "x" * 120


def record(payload: str) -> str:
    return f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: {len(payload)}\r\n\r\n{payload}\r\n\r\n"


ROWS = [
    (5, "http://a/", LONG, "d", 1), (3, "http://b/", LONG, "d", 1), (3, "http://b/", LONG, "d", 1), (9, None, LONG, None, None), (1, "u", "short", "", 0), (2, "u", "short", "", 0),
    (4, "u", None, "", 0), (6, "u", "", "", 0), (None, "u", LONG, "", 0), (7, "a WARC/1.1", "é" * 200, "", 0), (8, "a\r\nWARC/1.1\r\nb", MAGIC + "fake", "", 0),
    (10, "u", "start " + record("inner") + record("two " * 50) + " end", "", 0), (11, "u", record("whole"), "", 0), (12, "u", (MAGIC + "Content-Length: 3\r\n\r\nabc\r\n\r\n") * 40, "", 0),
    (13, "u", "\r\n\r\n" + MAGIC + "\r\n\r\n" + MAGIC, "", 0), (14, "u", "WARC/1.1", "", 0), (15, "u", "tail\r\n\r\n", "", 0), (16, "u", "z" * 300_000, "", 0),
]


def wanted(rows):
    first = {}
    for page, _, html, *_ in rows:
        if page is not None and len((html or "").encode()) >= 100:
            first[html] = min(page, first.get(html, page))
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        shared = page is not None and html in first and page > first[html]
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if shared else "response", first[html] if shared else None))
    return out


def got(frame):
    def page(urn):
        return None if urn is None else int(urn[len("<urn:page:") : -1])

    return [(page(r["record_id"]), r["size"], r["digest"], r["type"], page(r["refers_to"])) for r in frame.collect()]


def ordered(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("split", ["128m", "3000", "700"])
def test_round_trip(spark, split):
    path = scratch(spark, "warc")
    write_warc(spark.createDataFrame(ROWS, PAGE).repartition(3), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert ordered(got(read_warc(spark, path))) == ordered(wanted(ROWS))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_splits_differ_between_the_reads(spark, monkeypatch):
    """Payloads with magic lines are read twice; the second read may split the files otherwise."""
    from retentia.llm import op6_warc

    path = scratch(spark, "warc")
    write_warc(spark.createDataFrame(ROWS, PAGE).coalesce(1), path)
    size, write = "spark.sql.files.maxPartitionBytes", op6_warc.written
    before = spark.conf.get(size)

    def then_smaller(df, label):
        out = write(df, label)
        if label == "op6-records":
            spark.conf.set(size, "700")
        return out

    monkeypatch.setattr(op6_warc, "written", then_smaller)
    spark.conf.set(size, "3000")
    try:
        assert ordered(got(read_warc(spark, path))) == ordered(wanted(ROWS))
    finally:
        spark.conf.set(size, before)


def test_files_are_plain_warc(spark):
    path = scratch(spark, "warc")
    write_warc(spark.createDataFrame(ROWS, PAGE).coalesce(1), path)
    name = next(f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-"))
    data = open(f"{path.removeprefix('file:')}/{name}", "rb").read()
    at = n = 0
    while at < len(data):
        assert data[at:].startswith(b"WARC/1.1\r\n")
        head = data[at : data.index(b"\r\n\r\n", at)]
        length = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length")).split()[1])
        at += len(head) + 4 + length
        assert data[at : at + 4] == b"\r\n\r\n"
        at, n = at + 4, n + 1
    assert n == len(ROWS)


def test_no_pages(spark):
    path = scratch(spark, "warc")
    write_warc(spark.createDataFrame([], PAGE), path)
    assert read_warc(spark, path).collect() == []


def test_broken_chain_is_an_error(spark):
    path = scratch(spark, "warc")
    text = record("one") + record("two").replace("Content-Length: 3", "Content-Length: 30") + record("three")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    with pytest.raises(ValueError, match="breaks off"):
        read_warc(spark, path)
