"""Archives: round trip, revisits, bounded chunks."""

import base64
import gzip
import hashlib
import io
import os
import random

from tallyroll.llm import common, warc

PAGES = "page_id long, url string, html string, record_type string, digest string"


def expected(rows):
    newest = {}
    for i, _, html in rows:
        if i is not None:
            newest[html or ""] = max(newest.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        text = html or ""
        to = newest.get(text)
        again = to is not None and (i is None or i < to)
        out.append((i, len(text.encode()), base64.b32encode(hashlib.sha1(text.encode()).digest()).decode(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=repr)


def test_records_and_revisits(spark):
    big = "".join(random.Random(1).choice("abcdefgh é\r\n") for _ in range(300000))
    rows = [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u\r\nWARC-Type: fake", None), (4, "http://b", ""), (5, "c", "WARC/1.1\r\n\r\nnot a record\r\n\r\n"), (6, "d", big), (7, "e", big),
            (None, "f", "<p>x</p>"), (None, "g", "only null ids"), (None, "g", "only null ids"), (2, None, "<p>x</p>")]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES).repartition(3)
    assert sorted((tuple(r) for r in warc.archived_pages(pages).collect()), key=repr) == expected(rows)


def test_small_payloads_are_no_copies(spark):
    pages = spark.createDataFrame([(1, "a", "x", "", ""), (2, "b", "x", "", ""), (3, "c", "long enough", "", ""), (4, "d", "long enough", "", "")], PAGES)
    kinds = {r.page_id: r.record_type for r in warc.archived_pages(pages, least_bytes=5).collect()}
    assert kinds == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_chunks_rejoin_to_the_payload_and_carry_its_digest(spark):
    payloads = {str(k): os.urandom(n).hex() for k, n in enumerate((0, 10, 40000, 200000))}
    pages = spark.createDataFrame([(int(k), "u", v, "", "") for k, v in payloads.items()], PAGES)
    archives = warc.write_archives(pages, common.new_path(spark, "warc"))
    rows = warc.read_archives(archives).collect()
    for k, text in payloads.items():
        own = sorted((r for r in rows if r.record_id == k), key=lambda r: r.chunk_no)
        assert [r.chunk_no for r in own] == list(range(len(own))) and [r.last for r in own] == [False] * (len(own) - 1) + [True]
        assert all(len(r.chunk) <= warc.CHUNK for r in own)
        so_far = b""
        for r in own:
            so_far += bytes(r.chunk)
            assert r.payload_bytes == len(so_far) and r.digest == base64.b32encode(hashlib.sha1(so_far).digest()).decode()
        assert so_far == text.encode()


def test_archives_are_gzip_members_any_reader_opens(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "<p>x</p>", "", ""), (2, "http://b/", "y", "", "")], PAGES).coalesce(1)
    archives = warc.write_archives(pages, f"file://{tmp_path}/w").collect()
    assert [r.records for r in archives] == [2]
    with open(archives[0].uri.removeprefix("file://"), "rb") as f:
        raw = f.read()
    text = gzip.decompress(raw)
    assert text.count(b"WARC/1.1\r\n") == 2 and b"WARC-Target-URI: http://a/\r\n" in text
    assert [r[0] for r in warc.archive_chunks(io.BytesIO(raw), 7)] == ["1", "1", "2"]


def test_several_archives_in_a_task(spark):
    pages = spark.createDataFrame([(k, "u", os.urandom(300).hex(), "", "") for k in range(9)], PAGES).coalesce(1)
    assert warc.write_archives(pages, common.new_path(spark, "warc"), archive_bytes=500).count() > 3


def test_empty_table(spark):
    assert warc.archived_pages(spark.createDataFrame([], PAGES)).collect() == []


def test_records_are_an_aggregation_of_whole_chunk_tables(spark):
    import pytest

    pages = spark.createDataFrame([(k, "u", "x" * (k * 70000), "", "") for k in (0, 1, 1, 3)], PAGES)
    chunks = warc.read_archives(warc.write_archives(pages, common.new_path(spark, "warc")))
    assert sorted((r.record_id, r.payload_bytes, r.n_chunks) for r in warc.records_of(chunks).collect()) == [("0", 0, 1), ("1", 70000, 2), ("1", 70000, 2), ("3", 210000, 4)]
    with pytest.raises(Exception, match="chunks of a record are missing"):
        warc.records_of(chunks.filter("chunk_no <> 1")).collect()
