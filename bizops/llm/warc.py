"""WARC archives of web pages: written record by record, indexed first, read back by byte ranges.

Each task writes one archive of gzip members, one per record, and hands on an index row for every
record: file, offset, length, URL and digest.  A reader picks records from that index, sorts them
by file and offset, and fetches neighbours with one read.  A page whose payload another page has
too is written as a revisit of the one with the smallest id.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizops.llm.scratch import Scratch, spread, storage, write_once

# Fixed values of the format
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"

DATE = "2000-01-01T00:00:00Z"  # the page table has no date
READ_BYTES = 8 << 20  # one read takes at most this much (or one record)
READ_GAP = 64 << 10  # and passes over at most this much between two records
INDEX = "file string, offset bigint, length bigint, url string, digest string, page_id bigint, record_type string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, headers: dict[str, str], block: bytes, level: int = 6) -> bytes:
    """One record as a gzip member of its own."""
    lines = {"WARC-Type": kind, **headers, "Content-Length": str(len(block))}
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items()).encode("utf-8", "surrogatepass")
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0].encode() != VERSION:
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    return headers, rest[: int(headers["Content-Length"])]


def _header_text(url: str | None) -> str:
    """A URL as one header line: control characters and spaces percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")


def _page(n: int | None) -> str:
    return f"<urn:page:{'' if n is None else n}>"


def _page_number(uri: str) -> int | None:
    digits = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _write(folder: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def payload(out) -> None:
            at = 0

            def put(member: bytes) -> tuple[int, int]:
                nonlocal at
                out.write(member)
                at += len(member)
                return at - len(member), len(member)

            put(record("warcinfo", {"WARC-Record-ID": "<urn:page:info>", "WARC-Date": DATE, "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n", level))
            for batch in batches:
                for page, url, html, first in zip(*(c.to_pylist() for c in batch.columns)):
                    body = (html or "").encode("utf-8", "surrogatepass")
                    digest = payload_digest(body)
                    revisit = first is not None and first != page
                    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
                    headers = {
                        "WARC-Record-ID": _page(page), "WARC-Date": DATE, "WARC-Target-URI": _header_text(url),
                        "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": HTTP_TYPE,
                    }
                    if revisit:
                        headers |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": _page(first)}
                    kind = "revisit" if revisit else "response"
                    rows.append((*put(record(kind, headers, http if revisit else http + body, level)), url, digest, page, kind))

        name = write_once(folder, f"{TaskContext.get().partitionId():06d}", payload)
        for i in range(0, len(rows), 10_000):
            offset, length, url, digest, page, kind = zip(*rows[i : i + 10_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(page)), pa.array(offset, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(url, pa.string()), pa.array(digest), pa.array(page, pa.int64()), pa.array(kind)],
                names=["file", "offset", "length", "url", "digest", "page_id", "record_type"],
            )

    return run


def write_archives(pages: DataFrame, folder: str, scratch: Scratch, page_id: str = "page_id", url: str = "url",
                   html: str = "html", min_revisit_bytes: int = 0, level: int = 6) -> DataFrame:
    """Write one record per row below ``folder`` and return the stored index of the records.

    Of rows with equal payloads of at least ``min_revisit_bytes`` bytes, that with the smallest
    page id is a response and the others revisit it; rows that repeat its id are responses too,
    and rows with a null id revisit it (all are responses where no row has an id).  A null page
    is an empty payload, a null URL is written as ``about:blank``.  No row is dropped.
    """
    named = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")
    )
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = named.withColumn("_key", F.when(F.octet_length(body) >= min_revisit_bytes, F.sha1(body)))
    # Only payloads that more than one row has, so mostly a small table.
    shared = keyed.groupBy("_key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    marked = keyed.join(shared.select(F.col("_key").alias("_shared"), "first"), F.col("_key") == F.col("_shared"), "left")
    return scratch.table(marked.select("page_id", "url", "html", "first").mapInArrow(_write(folder, level), INDEX), "index")


def _read(folder: str, with_payload: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = storage(folder)
        opened, f = None, None
        for rows in frames:
            files, offset, length = (rows[c].tolist() for c in ("file", "offset", "length"))
            out, i = [], 0
            while i < len(rows):
                j, end = i, offset[i] + length[i]
                while j + 1 < len(rows) and files[j + 1] == files[i] and offset[j + 1] - end <= READ_GAP and offset[j + 1] + length[j + 1] - offset[i] <= READ_BYTES:
                    j += 1
                    end = max(end, offset[j] + length[j])
                if files[i] != opened:
                    if f is not None:
                        f.close()
                    f, opened = fs.open_input_file(f"{path}/{files[i]}"), files[i]
                data = f.read_at(end - offset[i], offset[i])
                for k in range(i, j + 1):
                    at = offset[k] - offset[i]
                    out.append(_fields(*parse(data[at : at + length[k]]), with_payload))
                i = j + 1
            yield pd.DataFrame(out, columns=["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"][: 7 if with_payload else 6]).astype(
                {"page_id": "Int64", "refers_to": "Int64"})
        if f is not None:
            f.close()

    return run


def _fields(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    """A revisit keeps the HTTP head of its page, so the full payload's size is in the record."""
    head, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
    refers = headers.get("WARC-Refers-To")
    row = (_page_number(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], kind, size, digest, _page_number(refers) if refers else None)
    return (*row, payload if kind == "response" else None) if with_payload else row


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that the rows of ``index`` (all of it or a selection) point to: page_id, url,
    record_type, payload_bytes, payload_digest, refers_to and, if wanted, payload (null for
    revisits, whose payload is that of the record they refer to).  Payloads are checked against
    their digests."""
    schema = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint"
    return (
        index.select("file", "offset", "length").repartition(spread(index), "file").sortWithinPartitions("file", "offset")
        .mapInPandas(_read(folder, with_payload), schema + (", payload binary" if with_payload else ""))
    )
