"""Benchmark decontamination with a positional inverted index of the training text.

The documents are worked off in chunks of bounded size.  A chunk's index has one row per term: the
places of all its occurrences, as gaps, in a numbering that leaves one place free between
documents, so no phrase spans two of them.  The index is stored; a search takes the rows of the
searched terms, brings those of a chunk together, and intersects the lists of a phrase shifted to
its first word, the rarest term first.  With a slop, terms may stand that many places off.
Searched phrases are read in blocks of bounded size, so a benchmark of any size fits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizops.llm import varint
from bizops.llm.scratch import Scratch, storage, write_once
from bizops.llm.simhash import word_pieces

CHUNK_WORDS = 6_000_000
CHUNK_TERMS = 500_000
BLOCK_WORDS = 500_000  # words of searched phrases held at a time
WINDOW = 10

#: Bytes of a word: digits, lower-case letters and everything beyond ASCII; A-Z become lower case.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[str]:
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES)
    return [w.decode("utf-8", "surrogatepass") for w in raw.split()]


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of kind 0: a chunk's terms with their places; of kind 1: its documents."""
    task, number = TaskContext.get().partitionId() << 24, 0
    names = ["kind", "chunk", "term", "n", "places", "_id", "base", "n_words"]
    id_type = pa.int64()
    terms, parts, docs, at = defaultdict(count().__next__), [], [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        chunk = task + number
        if parts:
            ids = np.concatenate([p[1] for p in parts])
            places = np.concatenate([np.arange(b, b + len(p), dtype=np.int64) for b, p in parts])
            order = np.argsort(ids, kind="stable")
            n = np.bincount(ids, minlength=len(terms))
            first = np.cumsum(n) - n
            places = places[order]
            gaps = np.diff(places, prepend=0)
            gaps[first] = places[first]
            coded, widths = varint.encode(gaps)
            ends = np.cumsum(widths)[first + n - 1]
            starts = np.r_[0, ends[:-1]]
            words = list(terms)
            for a in range(0, len(words), 10_000):
                b = min(a + 10_000, len(words))
                offsets = np.r_[starts[a:b], ends[b - 1]] - starts[a]
                blob = coded[starts[a] : ends[b - 1]]
                k = b - a
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.zeros(k), pa.int32(), safe=False), pa.array(np.full(k, chunk), pa.int64()),
                    pa.array([w.decode("utf-8", "surrogatepass") for w in words[a:b]], pa.string()), pa.array(n[a:b], pa.int32(), safe=False),
                    pa.Array.from_buffers(pa.binary(), k, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(blob.tobytes())]),
                    pa.nulls(k, id_type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                ], names=names)
        for a in range(0, len(docs), 10_000):
            ids, bases, sizes = zip(*docs[a : a + 10_000])
            k = len(ids)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.ones(k), pa.int32(), safe=False), pa.array(np.full(k, chunk), pa.int64()), pa.nulls(k, pa.string()),
                pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()), pa.array(ids, id_type),
                pa.array(bases, pa.int64()), pa.array(sizes, pa.int64()),
            ], names=names)

    for batch in batches:
        id_type = batch.column(0).type
        for key, text in zip(*(c.to_pylist() for c in batch.columns)):
            base = at
            raw = (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES)
            for words in word_pieces(raw, 0):
                parts.append((at, np.fromiter(map(terms.__getitem__, words), np.int32, len(words))))
                at += len(words)
            docs.append((key, base, at - base))
            at += 1
            if at >= CHUNK_WORDS or len(terms) >= CHUNK_TERMS:
                yield from flush()
                number += 1
                terms, parts, docs, at = defaultdict(count().__next__), [], [], 0
    if docs:
        yield from flush()


def build_index(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index of whole texts: rows of kind 0 (chunk, term, n, places) for terms and of
    kind 1 (chunk, _id, base, n_words) for every document.  Null texts have no words."""
    kept = docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("_text"))
    id_type = kept.schema["_id"].dataType.simpleString()
    made = kept.mapInArrow(
        _index_rows, f"kind int, chunk bigint, term string, n int, places binary, _id {id_type}, base bigint, n_words bigint"
    )
    return scratch.table(made, "index", by="kind")


# ---------------------------------------------------------------- searching


def _write_blocks(folder: str):
    """Items of the benchmark, cut into words, in files of bounded size; terms and file names out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids: list[str | None] = []
        held: list[list[str]] = []
        size, number = 0, 0

        def flush() -> pa.RecordBatch:
            block = pa.table({"item": pa.array(ids, pa.string()), "words": pa.array(held, pa.list_(pa.string()))})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_file(sink, block.schema) as out:
                out.write_table(block)
            name = write_once(folder, f"{part:06d}-{number:06d}", sink.getvalue().to_pybytes())
            terms = list(dict.fromkeys(w for words in held for w in words))
            return pa.RecordBatch.from_arrays([pa.array([name] * len(terms), pa.string()), pa.array(terms, pa.string())], names=["block", "term"])

        for batch in batches:
            for item, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                if not words:
                    continue
                ids.append(item)
                held.append(words)
                size += len(words)
                if size >= BLOCK_WORDS:
                    yield flush()
                    number += 1
                    ids, held, size = [], [], 0
        if held:
            yield flush()

    return run


def windows(words: Sequence[str], size: int) -> list[tuple[str, ...]]:
    """All windows of ``size`` words; a shorter item is one window of its own."""
    if len(words) <= size:
        return [tuple(words)] if words else []
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


class ChunkPostings:
    """The searched terms' places in one chunk."""

    def __init__(self):
        self.coded: dict[str, tuple[int, bytes]] = {}
        self._places: dict[str, np.ndarray] = {}

    def places(self, term: str) -> np.ndarray:
        if term not in self._places:
            self._places[term] = np.cumsum(varint.decode(self.coded[term][1]))
        return self._places[term]

    def find(self, phrase: Sequence[str], slop: int = 0) -> np.ndarray:
        """Where the phrase begins: the lists of its terms, shifted to its first word and
        intersected from the rarest on."""
        if any(t not in self.coded for t in phrase):
            return np.zeros(0, np.int64)
        order = sorted(range(len(phrase)), key=lambda i: self.coded[phrase[i]][0])
        starts = self.places(phrase[order[0]]) - order[0]
        for i in order[1:]:
            if not len(starts):
                break
            places, want = self.places(phrase[i]), starts + i
            near = np.searchsorted(places, want - slop)
            there = near < len(places)
            there[there] = places[near[there]] <= want[there] + slop
            starts = starts[there]
        return starts


def _search(folder: str, blocks: list[str], size: int, slop: int):
    """Rows sorted by (chunk, kind, base) in, one row per document out."""

    def hits(postings: ChunkPostings, fs, path: str) -> tuple[np.ndarray, np.ndarray, list[str | None]]:
        """Spans (start, end) found in the chunk and the item of each."""
        spans, items = [np.zeros((0, 2), np.int64)], []
        for block in blocks:
            with fs.open_input_file(f"{path}/{block}") as f:
                table = pa.ipc.open_file(f).read_all()
            known: dict[tuple[str, ...], np.ndarray] = {}
            for item, words in zip(table.column("item").to_pylist(), table.column("words").to_pylist()):
                for phrase in windows(words, size):
                    if phrase not in known:
                        known[phrase] = postings.find(phrase, slop)
                    starts = known[phrase]
                    if len(starts):
                        spans.append(np.column_stack([starts, starts + len(phrase)]))
                        items += [item] * len(starts)
        return np.concatenate(spans), items

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = storage(folder)
        chunk, postings, found = None, ChunkPostings(), None
        for frame in frames:
            out = []
            for (c, kind), rows in frame.groupby(["chunk", "kind"], sort=False):
                if c != chunk:
                    chunk, postings, found = c, ChunkPostings(), None
                if kind == 0:
                    postings.coded.update(zip(rows["term"], zip(rows["n"].astype(int), rows["places"])))
                    continue
                if found is None:
                    spans, items = hits(postings, fs, path)
                    order = np.argsort(spans[:, 0], kind="stable")
                    spans, items = spans[order], [items[i] for i in order]
                    # the union of the spans, as disjoint ones
                    top = np.maximum.accumulate(spans[:, 1]) if len(spans) else spans[:, 1]
                    begin = np.flatnonzero(np.r_[True, spans[1:, 0] > top[:-1]]) if len(spans) else np.zeros(0, np.int64)
                    joined = np.column_stack([spans[begin, 0], top[np.r_[begin[1:], len(spans)].astype(int) - 1]]) if len(spans) else spans
                    found = spans, items, joined, np.r_[0, np.cumsum(joined[:, 1] - joined[:, 0])]
                out.append(_documents(rows, *found))
            if out:
                yield pd.concat(out, ignore_index=True)

    return run


def _documents(rows: pd.DataFrame, spans: np.ndarray, items: list, joined: np.ndarray, covered: np.ndarray) -> pd.DataFrame:
    base, n = rows["base"].to_numpy(np.int64), rows["n_words"].to_numpy(np.int64)
    first, last = (np.searchsorted(joined[:, 0], x) for x in (base, base + n))
    lo, hi = (np.searchsorted(spans[:, 0], x) for x in (base, base + n))
    which = [sorted({i for i in items[a:b] if i is not None}) for a, b in zip(lo.tolist(), hi.tolist())]
    return pd.DataFrame({
        "_id": rows["_id"].to_numpy(), "n_words": n, "n_hit": covered[last] - covered[first], "items": which,
    })


def search(index: DataFrame, benchmark: DataFrame, scratch: Scratch, item_id: str = "item_id", text: str = "text",
           size: int = WINDOW, slop: int = 0) -> DataFrame:
    """_id, n_words, n_hit (words inside an occurrence of a window of any item) and items (sorted
    ids, as strings, of the items with occurring windows) for every indexed document.

    ``slop`` 0 finds exact phrases; a larger one also finds windows whose words each stand at most
    that many places from where the phrase has them (the span reported is the phrase's length).
    Items without words have no window; null item ids count as hits but are not listed.
    """
    folder = scratch.path("phrases")
    words = scratch.table(
        benchmark.select(F.col(item_id).cast("string"), F.col(text).cast("string"))
        .mapInArrow(_write_blocks(folder), "block string, term string"), "terms")
    # File names of phrase blocks: one for half a million searched words.
    blocks = sorted(r["block"] for r in words.select("block").distinct().collect())
    lists = index.where("kind = 0").join(words.select("term").distinct(), "term", "left_semi")
    id_type = index.schema["_id"].dataType.simpleString()
    together = lists.select("kind", "chunk", "term", "n", "places").unionByName(
        index.where("kind = 1").select("kind", "chunk", "_id", "base", "n_words"), allowMissingColumns=True
    )
    return (
        together.repartition("chunk").sortWithinPartitions("chunk", "kind", "base")
        .mapInPandas(_search(folder, blocks, size, slop), f"_id {id_type}, n_words bigint, n_hit bigint, items array<string>")
    )


def contamination(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, id_col: str = "doc_id", text: str = "text",
                  size: int = WINDOW) -> DataFrame:
    """Id, n_words, n_hit, n_items, items and contaminated for every row of ``docs``.

    Null texts have no words and are clean; repeated rows stay repeated; an empty benchmark leaves
    every document clean; empty ``docs`` give no rows.  Other columns are not read.
    """
    found = search(build_index(docs, scratch, id_col, text), benchmark, scratch, size=size)
    return found.select(
        F.col("_id").alias(id_col), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items",
        (F.col("n_hit") > 0).alias("contaminated"),
    )
