"""Token counts of whole texts from one count per distinct pre-token.

A text is cut wherever white space begins, where the tokenizer's own pre-tokenizer always cuts
too, so its tokens are those of the pieces, one after the other.  Documents are worked off in
chunks of bounded size.  A chunk keeps the distinct pre-tokens of its documents once, and each
document's frequencies refer to them by number.  All chunks' pre-tokens meet in one shuffle by
hash bucket, in which each distinct one is tokenized once; a pre-token is there at most once per
chunk, so even the commonest is a small share of the data.  The counts go back to their chunk,
where they are multiplied with the frequencies.  Token ids are never kept.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizops.llm import varint
from bizops.llm.scratch import Scratch

#: The characters that Unicode calls white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0" + "".join(
    map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
PRE_TOKEN = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
CHUNK_BYTES = 32 << 20  # text of one chunk
CHUNK_WORDS = 500_000  # distinct pre-tokens of one chunk
BUCKETS = 4096  # hash buckets of pre-tokens: the tasks that can count at a time
_BETWEEN = b"\xff"  # no UTF-8 text holds this byte


def load_tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _chunks(buckets: int):
    """Rows of two kinds.  0: the pre-tokens of a chunk that fall into one bucket (``words``,
    with their numbers as gaps in ``idx``).  1: a document with its frequencies (``freq``: the
    numbers of its pre-tokens as gaps, then how often each occurs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, id_type = TaskContext.get().partitionId() << 24, 0, pa.int64()
        words, docs, size = defaultdict(count().__next__), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            chunk = task + number
            names = [w.encode("utf-8", "surrogatepass") for w in words]
            bucket = np.fromiter((zlib.crc32(w) for w in names), np.int64, len(names)) % buckets
            order = np.argsort(bucket, kind="stable")
            starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            groups = [order[a:b] for a, b in zip(starts, np.r_[starts[1:], len(order)].astype(int))]
            for at in range(0, len(groups), 1000):
                part = groups[at : at + 1000]
                k = len(part)
                yield pa.RecordBatch.from_arrays([
                    pa.array([0] * k, pa.int32()), pa.array([chunk] * k, pa.int64()), pa.array([int(bucket[g[0]]) for g in part], pa.int32()),
                    pa.array([varint.encode(np.diff(g, prepend=0))[0].tobytes() for g in part], pa.binary()),
                    pa.array([_BETWEEN.join([names[i] for i in g]) for g in part], pa.binary()),
                    pa.nulls(k, id_type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()),
                ], names=FIELDS)
            for at in range(0, len(docs), 1000):
                part = docs[at : at + 1000]
                k = len(part)
                yield pa.RecordBatch.from_arrays([
                    pa.array([1] * k, pa.int32()), pa.array([chunk] * k, pa.int64()), pa.nulls(k, pa.int32()),
                    pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()), pa.array([d[0] for d in part], id_type),
                    pa.array([d[1] for d in part], pa.int64()), pa.array([d[2] for d in part], pa.binary()),
                ], names=FIELDS)

        for batch in batches:
            id_type = batch.column(0).type
            for key, n_bytes, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = Counter(PRE_TOKEN.findall(text or ""))
                idx = np.fromiter(map(words.__getitem__, found), np.int64, len(found))
                n = np.fromiter(found.values(), np.int64, len(found))
                order = np.argsort(idx, kind="stable")
                coded, _ = varint.encode(np.r_[np.diff(idx[order], prepend=0), n[order]])
                docs.append((key, n_bytes, coded.tobytes()))
                size += n_bytes
                if size >= CHUNK_BYTES or len(words) >= CHUNK_WORDS:
                    yield from flush()
                    number += 1
                    words, docs, size = defaultdict(count().__next__), [], 0
        if docs:
            yield from flush()

    return run


FIELDS = ["kind", "chunk", "bucket", "idx", "words", "_id", "n_bytes", "freq"]


def _pieces(tokenizer_path: str):
    """Rows sorted by bucket in, the same pre-tokens' counts (``n``) for each chunk out.  Every
    distinct pre-token of a bucket is tokenized once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(tokenizer_path)
        bucket, known = None, {}
        for batch in batches:
            coded = []
            for at, blob in zip(batch.column("bucket").to_pylist(), batch.column("words").to_pylist()):
                if at != bucket:
                    bucket, known = at, {}
                words = blob.split(_BETWEEN)
                new = [w for w in words if w not in known]
                if new:
                    texts = [w.decode("utf-8", "surrogatepass") for w in new]
                    known.update(zip(new, (len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False))))
                coded.append(varint.encode(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))[0].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("idx"), pa.array(coded, pa.binary())], names=["chunk", "idx", "freq"])

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by chunk, pre-token counts before documents, in; token counts out."""
    chunk, parts, sizes = None, [], None
    for batch in batches:
        ids, totals = [], []
        kinds, chunks = batch.column("kind").to_pylist(), batch.column("chunk").to_pylist()
        for row, (kind, at) in enumerate(zip(kinds, chunks)):
            if at != chunk:
                chunk, parts, sizes = at, [], None
            coded = varint.decode(batch.column("freq")[row].as_py())
            if kind == 0:
                parts.append((np.cumsum(varint.decode(batch.column("idx")[row].as_py())), coded))
                continue
            if sizes is None:
                sizes = np.zeros(sum(len(i) for i, _ in parts), np.int64)
                for i, n in parts:
                    sizes[i] = n
                parts = []
            half = len(coded) // 2
            totals.append(int(sizes[np.cumsum(coded[:half])] @ coded[half:]) if half else 0)
            ids.append(row)
        if ids:
            rows = batch.take(pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [rows.column("_id"), rows.column("n_bytes"), pa.array(totals, pa.int64())], names=["_id", "n_bytes", "n_tokens"]
            )


def token_counts(docs: DataFrame, tokenizer_path: str, scratch: Scratch, id_col: str = "doc_id", text: str = "text",
                 buckets: int = BUCKETS) -> DataFrame:
    """Id, n_bytes (UTF-8) and n_tokens of every row, as the tokenizer counts its whole text
    without added special tokens.

    The tokenizer file is one of the ``tokenizers`` library whose pre-tokenizer cuts before white
    space (byte-level or white-space ones); it must be there on every executor.  Null texts count
    as empty (0 bytes, 0 tokens); repeated rows stay repeated; an empty table gives no rows.
    Other columns are not read.
    """
    kept = docs.select(
        F.col(id_col).alias("_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.col(text).cast("string").alias("_text"),
    )
    id_type = kept.schema["_id"].dataType.simpleString()
    made = kept.mapInArrow(
        _chunks(buckets), f"kind int, chunk bigint, bucket int, idx binary, words binary, _id {id_type}, n_bytes bigint, freq binary"
    )
    parts = scratch.table(made, "frequencies", by="kind")
    words = parts.where("kind = 0").select("bucket", "chunk", "idx", "words")
    pieces = words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _pieces(tokenizer_path), "chunk bigint, idx binary, freq binary"
    )
    docs_rows = parts.where("kind = 1").select("kind", "chunk", "_id", "n_bytes", "freq")
    together = pieces.select(F.lit(0).alias("kind"), "chunk", "idx", "freq").unionByName(docs_rows, allowMissingColumns=True)
    return (
        together.repartition("chunk").sortWithinPartitions("chunk", "kind")
        .mapInArrow(_sums, f"_id {id_type}, n_bytes bigint, n_tokens bigint")
        .withColumnRenamed("_id", id_col)
    )
