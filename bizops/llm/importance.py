"""Importance resampling towards a target distribution of word features.

The pre-tokenizer of the tokenizers library - an untrained Split by a pattern over text whose
A-Z are lower-cased - gives the words of a text and their offsets.  Windows of one or more
neighbouring words, held as pairs of offsets, are the features; the CRC-32 of a feature picks its
bucket.  The histograms of the corpus and of the target give every bucket a gain, a document's
weight is the mean gain of its features, and Gumbel noise on the weights turns "the highest scores"
into a sample without replacement.

A text is pre-tokenized once: its bucket numbers are kept, two bytes a feature, and both the
histogram and the sum of gains read them.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizops.llm.scratch import Scratch
from bizops.operators.ordered import with_order

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PIECE = 1 << 20  # bytes of a text that are pre-tokenized at a time
REMEMBERED = 500_000  # features whose bucket a task remembers
_BREAK = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def pre_tokenizer():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), "removed", invert=True)


def pieces(data: bytes, size: int = PIECE) -> Iterator[str]:
    """A lowered text in pieces that end where no word goes on."""
    at = 0
    while at < len(data):
        end = at + size
        if end < len(data):
            found = _BREAK.search(data, end)
            end = found.start() if found else len(data)
        yield data[at:end].decode("utf-8", "surrogatepass")
        at = end


class Buckets:
    """Bucket numbers of all features of a text; remembers those of features it has seen."""

    def __init__(self, most: int, buckets: int):
        self.split, self.most, self.buckets = pre_tokenizer(), most, buckets
        self.known: dict[str, int] = {}

    def of(self, feature: str) -> int:
        bucket = zlib.crc32(feature.encode("utf-8", "surrogatepass")) % self.buckets
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[feature] = bucket
        return bucket

    def __call__(self, text: str | None) -> tuple[int, np.ndarray]:
        """(number of words, bucket of every feature)."""
        n, found, carry, carried = 0, [], "", 0
        get, of = self.known.get, self.of
        for piece in pieces((text or "").encode("utf-8", "surrogatepass").lower()):
            piece = carry + piece
            spans = [span for _, span in self.split.pre_tokenize_str(piece)]
            n += len(spans) - carried
            for size in range(1, self.most + 1):
                # Only windows that end in the new words; the others were there with the piece before.
                first = max(carried - size + 1, 0)
                pairs = zip(spans[first:], spans[first + size - 1 :])
                names = [piece[a:b] for (a, _), (_, b) in pairs]
                if size > 1:
                    names = [_GAP.sub(" ", name) for name in names]
                numbers = [b if (b := get(w)) is not None else of(w) for w in names]
                found.append(np.array(numbers, np.uint32))
            carried = min(self.most - 1, len(spans))
            carry = piece[spans[-carried][0] :] if carried else ""
        return n, np.concatenate(found) if found else np.zeros(0, np.uint32)


def _width(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def features(docs: DataFrame, text: str = "text", keep: Sequence[str] = (), most: int = 1, buckets: int = 10_000) -> DataFrame:
    """``keep`` columns, n_words, n_features and ``packed`` (the features' bucket numbers)."""
    kept = docs.select(*[F.col(k) for k in keep], F.col(text).cast("string").alias("_whole"))
    names = [*keep, "n_words", "n_features", "packed"]
    schema = kept.drop("_whole").schema.add("n_words", "long").add("n_features", "long").add("packed", "binary")
    width = _width(buckets)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Buckets(most, buckets)
        for batch in batches:
            rows = [numbers(t.as_py()) for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[: len(keep)], pa.array([n for n, _ in rows], pa.int64()),
                pa.array([len(b) for _, b in rows], pa.int64()),
                pa.array([b.astype(width).tobytes() for _, b in rows], pa.binary()),
            ], names=names)

    return kept.mapInArrow(work, schema)


def histogram(packed: DataFrame, buckets: int = 10_000) -> np.ndarray:
    """Features of each bucket over all rows.  Tasks add up their rows first; what reaches the driver
    is one number a bucket."""
    width = _width(buckets)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for b in batch.column(0):
                counts += np.bincount(np.frombuffer(b.as_py(), width), minlength=buckets)
        filled = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled, pa.int64()), pa.array(counts[filled], pa.int64())], names=["bucket", "n"]
        )

    summed = packed.select("packed").mapInArrow(work, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for r in summed.collect():  # at most ``buckets`` rows
        counts[r["bucket"]] = r["n"]
    return counts


@dataclass(frozen=True)
class Gains:
    """What a feature of each bucket adds: thousandths of the log ratio of the smoothed shares."""

    gain: np.ndarray

    @classmethod
    def of(cls, corpus: np.ndarray, target: np.ndarray) -> Gains:
        n, (s, t) = len(corpus), (int(corpus.sum()), int(target.sum()))
        return cls(np.array([
            math.floor(1000 * math.log(float((b + 1) * (s + n)) / float((a + 1) * (t + n))))
            for a, b in zip(corpus.tolist(), target.tolist())
        ], np.int64))


def weighted(packed: DataFrame, gains: Gains, keep: Sequence[str], buckets: int) -> DataFrame:
    """``keep`` columns, n_words, n_features and ``weight``: the mean gain of the features, floored;
    0 without features."""
    width, names = _width(buckets), [*keep, "n_words", "n_features", "weight"]
    schema = packed.select(*names[:-1]).schema.add("weight", "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = []
            for b in batch.column(len(names) - 1):
                found = gains.gain[np.frombuffer(b.as_py(), width)]
                weights.append(int(found.sum()) // len(found) if len(found) else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(weights, pa.int64())], names=names)

    return packed.select(*names[:-1], "packed").mapInArrow(work, schema)


def noise(key: Column, seed: int = 2024) -> Column:
    """Thousandths of a Gumbel number fixed by the seed and the key, floored."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(u))).cast("bigint")


def resample(docs: DataFrame, target: DataFrame, scratch: Scratch, id_col: str = "doc_id", text: str = "text",
             most: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """Id, n_words, n_features, weight, score and rank of every row of ``docs``.

    Features are all windows of 1 to ``most`` words.  Of the rows with at least ``least_words`` words,
    ``percent`` in a hundred (rounded down) with the highest scores are drawn and ranked from 1; ties
    go to the smaller id.  All other rows have a null rank.  Null and empty texts have no features
    and weight 0; rows without an id draw the noise of the word "null" and lose ties; repeated rows
    have equal scores and take neighbouring ranks.  Empty tables on either side are answered too:
    an empty target favours rare features.  Only the id and text columns are read.
    """
    named = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    packed = scratch.table(features(named, "_text", ["_id"], most, buckets), "features")
    wanted = features(target.select(F.col(text).alias("_text")), "_text", [], most, buckets)
    gains = Gains.of(histogram(packed, buckets), histogram(wanted, buckets))
    scored = scratch.table(
        weighted(packed, gains, ["_id"], buckets).withColumn("score", F.col("weight") + noise(F.col("_id"), seed)), "scored"
    )
    able = F.col("n_words") >= least_words
    # Range-sorted by a total order but for full repeats, of which any order gives the same rows.
    ranked = with_order(scored.where(able), [F.col("score").desc(), F.col("_id").asc_nulls_last(), "n_features", "weight"])
    drawn = F.when(F.col("rank") <= F.floor(F.col("total_rows") * percent / 100), F.col("rank"))
    columns = [F.col("_id").alias(id_col), "n_words", "n_features", "weight", "score"]
    return ranked.select(*columns, drawn.cast("bigint").alias("rank")).unionByName(
        scored.where(~able).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    )
