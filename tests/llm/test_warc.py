import base64
import hashlib

from pyspark.sql import functions as F

from bizops.llm import warc
from bizops.llm.queries import QUERIES

COLUMNS = "page_id bigint, url string, html string, file string, digest string, first bigint"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 3) for r in rows], COLUMNS).repartition(3)


def written(spark, rows, scratch, **options):
    folder = scratch.path("archives")
    index = warc.write_archives(pages(spark, rows), folder, scratch, **options)
    return index, folder


def test_record_round_trip():
    member = warc.record("response", {"WARC-Record-ID": "<urn:page:1>"}, b"a\r\n\r\nb")
    headers, block = warc.parse(member)
    assert headers["WARC-Type"] == "response" and headers["Content-Length"] == "6" and block == b"a\r\n\r\nb"


def test_pages_come_back(spark, scratch):
    rows = [
        (5, "http://a/\r\nX: 1", "<p>same</p>"), (3, None, "<p>same</p>"), (9, "u", "<p>same</p>"), (1, "u", None), (2, "u", ""),
        (4, "u", "\r\n\r\nWARC/1.1 é "), (None, "u", "<p>same</p>"), (None, "u", "alone"), (7, "u", "x" * 300_000), (3, None, "<p>same</p>"),
    ]
    index, folder = written(spark, rows, scratch)
    assert index.count() == len(rows)
    got = {(r["page_id"], r["payload_digest"]): r for r in warc.read_records(index, folder).collect()}
    for page, url, html in rows:
        r = got[page, digest(html)]
        assert r["payload_bytes"] == len((html or "").encode())
        first = {digest("<p>same</p>"): 3, digest(""): 1, digest("alone"): page}.get(digest(html), page)
        assert (r["record_type"], r["refers_to"]) == (("response", None) if page == first else ("revisit", first))
        assert r["payload"] == ((html or "").encode() if page == first else None)


def test_a_selection_reads_only_its_records(spark, scratch):
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * 50) for i in range(200)]
    index, folder = written(spark, rows, scratch)
    got = warc.read_records(index.where("page_id % 50 = 7"), folder).collect()
    assert sorted((r["page_id"], r["payload"].decode()) for r in got) == [(i, f"<p>{i}</p>" * 50) for i in (7, 57, 107, 157)]
    assert index.where(F.col("url") == "http://h/7").first()["digest"] == digest("<p>7</p>" * 50)


def test_short_payloads_stay_responses(spark, scratch):
    index, folder = written(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], scratch, min_revisit_bytes=3)
    assert [r["record_type"] for r in index.orderBy("page_id").collect()] == ["response"] * 3 + ["revisit"]


def test_empty_table(spark, scratch):
    index, folder = written(spark, [], scratch)
    assert warc.read_records(index, folder).count() == 0


def test_query_against_brute_force(spark, small):
    got = QUERIES["op3_warc"](spark, small).collect()
    html = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    first = {}
    for i in sorted(html, reverse=True):
        first[digest(html[i])] = i
    want = set()
    for i, h in html.items():
        f = first[digest(h)]
        want.add((i, len((h or "").encode()), digest(h), "response" if f == i else "revisit", None if f == i else f))
    assert {(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got} == want
