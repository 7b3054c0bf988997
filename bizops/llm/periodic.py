"""Periodic runs of words in whole texts, found online by dyadic square catching.

A text is appended piece by piece.  As soon as a block of 2^k words that starts at a multiple of
2^k is complete, it becomes a catcher: it waits for its own words to come back 2^(k+1)-1 to
2^(k+2)-2 words later.  Every square whose half has a length p in that span holds such a block in its
first half, so the block and its return give away p.  Each appended word is the end of one suffix
of 2^k words per level, and at any time just two catchers of a level can wait for that suffix, so a
word costs two comparisons of block hashes per level.  Returns of neighbouring blocks at one distance
form a stretch; where it ends is settled to the word by halving steps, and a stretch of at least
p words is a square or several, merged into one run.  All words of a piece are compared together.

Hashes only propose: every reported run is compared word by word, and a text with a false one
is done again under other hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizops.llm.simhash import word_pieces

MERSENNE = (1 << 31) - 1
PIECE = 1 << 16  # words appended at a time


class Runs(NamedTuple):
    """Maximal runs, by start and then period: words [start, start + length) with that period."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo the Mersenne number, for 0 <= x < 2^62."""
    x = (x & MERSENNE) + (x >> 31)
    x = (x & MERSENNE) + (x >> 31)
    return np.where(x >= MERSENNE, x - MERSENNE, x)


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1), by doubling."""
    out = np.ones(max(n, 1), np.int64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = _mod(out[:more] * pow(base, done, MERSENNE))
        done += more
    return out


class SquareCatcher:
    """Finds the runs of a growing text of at least ``exponent`` (2 or more) periods and
    ``least`` words.

    ``append`` takes word numbers; ``finish`` returns the runs.  Memory is a few numbers a word.
    ``longest`` bounds the length of runs where the caller knows a bound.
    """

    def __init__(self, exponent: int = 2, least: int = 0, seed: int = 1, longest: int | None = None):
        if exponent < 2:
            raise ValueError("a run holds at least one square")
        self.exponent, self.least, self.longest = exponent, least, longest
        base = 1 + int.from_bytes(hashlib.sha256(b"base%d" % seed).digest()[:8], "big") % (MERSENNE - 2)
        self._base, self._inverse = base, pow(base, -1, MERSENNE)
        self._salt = np.uint64(int.from_bytes(hashlib.sha256(b"word%d" % seed).digest()[:8], "big") | 1)
        self.words = np.zeros(0, np.int64)
        self._sums = np.zeros(1, np.int64)  # of word hash x base^place, before each word
        self._undo = np.ones(1, np.int64)  # base^-place
        self._open: list[np.ndarray] = []  # per level: rows (distance, first block, last block) that may go on
        self._found: list[np.ndarray] = []  # rows (start, end, period)

    def _hash(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` words at each place, the same wherever they stand."""
        return _mod(_mod((self._sums[at + size] - self._sums[at]) % MERSENNE) * self._undo[at])

    def append(self, words: np.ndarray) -> None:
        before = len(self.words)
        words = np.asarray(words, np.int64)
        n = before + len(words)
        mixed = (words.astype(np.uint64) + np.uint64(1)) * self._salt
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        values = ((mixed >> np.uint64(33)).astype(np.int64)) % MERSENNE
        place = _mod(_powers(self._base, len(words)) * pow(self._base, before, MERSENNE))
        self.words = np.concatenate([self.words, words])
        self._sums = np.concatenate([self._sums, self._sums[-1] + np.cumsum(_mod(values * place))])
        back = _mod(_powers(self._inverse, len(words)) * pow(self._inverse, before + 1, MERSENNE))
        self._undo = np.concatenate([self._undo, back])
        level = 0
        # As long as some block of the level can have come back, and a square of it fits.
        while 3 * (1 << level) - 1 <= n and (self.longest is None or (4 << level) - 2 <= self.longest):
            if level == len(self._open):
                self._open.append(np.zeros((0, 3), np.int64))
            self._advance(level, before, n)
            level += 1

    def _advance(self, level: int, before: int, n: int) -> None:
        """Compare the suffixes that end in the new words with the two catchers waiting for each."""
        size = 1 << level
        low = max(2 * size - 1, before - size + 1)
        if low > n - size:
            return
        suffix = np.arange(low, n - size + 1)
        near = (suffix - (2 * size - 1)) >> level  # block number of the later catcher
        first = max(int(near[0]) - 1, 0)
        blocks = self._hash(np.arange(first, int(near[-1]) + 1) << level, size)
        hashes = self._hash(suffix, size)
        caught = []
        for number in (near, near - 1):
            hit = np.flatnonzero((number >= first) & (blocks[np.maximum(number - first, 0)] == hashes))
            block = number[hit] << level
            caught.append(np.column_stack([suffix[hit] - block, block, block]))
        rows = np.concatenate([self._open[level], *caught])
        if not len(rows):
            return
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        starts = np.r_[True, (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 2] + size)]
        heads = np.flatnonzero(starts)
        rows = np.column_stack([rows[heads, 0], rows[heads, 1], rows[np.r_[heads[1:], len(rows)] - 1, 2]])
        # The block after the last one would have been caught by now unless its return lies ahead.
        ahead = rows[:, 2] + 2 * size + rows[:, 0] > n
        self._open[level] = rows[ahead]
        self._settle(rows[~ahead], level)

    def _settle(self, rows: np.ndarray, level: int) -> None:
        """Extend closed stretches to the word and keep those that hold a square."""
        if not len(rows):
            return
        n = len(self.words)
        p, a, b = rows[:, 0].copy(), rows[:, 1].copy(), rows[:, 2] + (1 << level)
        for step in reversed(range(level)):  # less than one block is missing at either end
            size = 1 << step
            on = np.flatnonzero(a >= size)
            on = on[self._hash(a[on] - size, size) == self._hash(a[on] + p[on] - size, size)]
            a[on] -= size
            on = np.flatnonzero(b + p + size <= n)
            on = on[self._hash(b[on], size) == self._hash(b[on] + p[on], size)]
            b[on] += size
        square = b - a >= p
        self._found.append(np.column_stack([a, b + p, p])[square])

    def finish(self) -> Runs | None:
        """The runs; None if a hash was false, which another seed puts right."""
        for level, rows in enumerate(self._open):
            self._settle(rows, level)
            self._open[level] = rows[:0]
        found = np.concatenate(self._found) if self._found else np.zeros((0, 3), np.int64)
        # A stretch of several periods is found under each multiple of its period: the least counts.
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        if len(found):
            found = found[np.r_[True, (found[1:, :2] != found[:-1, :2]).any(axis=1)]]
        long = found[:, 1] - found[:, 0] >= np.maximum(self.least, self.exponent * found[:, 2])
        found = found[long]
        found = found[np.lexsort((found[:, 2], found[:, 0]))]
        for a, b, p in found.tolist():
            if not np.array_equal(self.words[a : b - p], self.words[a + p : b]):
                return None
        return Runs(found[:, 0], found[:, 1] - found[:, 0], found[:, 2])


def runs_of(texts: Sequence[np.ndarray], exponent: int = 4, least: int = 6, piece: int = PIECE) -> list[Runs]:
    """All maximal runs of at least ``exponent`` periods and ``least`` words, for every text.

    The texts are appended one after the other, with a word between them that comes only once, so
    no run reaches over it.
    """
    parts: list[np.ndarray] = []
    for i, words in enumerate(texts):
        parts += [words, np.array([-1 - i], np.int64)]
    joined = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    ends = np.cumsum([len(words) + 1 for words in texts], dtype=np.int64)
    longest = max((len(words) for words in texts), default=0)
    for seed in count(1):
        catcher = SquareCatcher(exponent, least, seed, longest)
        for at in range(0, len(joined), piece):
            catcher.append(joined[at : at + piece])
        found = catcher.finish()
        if found is not None:
            break
    cuts = np.searchsorted(found.start, ends)
    out, low = [], 0
    for i, (high, words) in enumerate(zip(cuts.tolist(), texts)):
        begin = ends[i] - len(words) - 1
        out.append(Runs(found.start[low:high] - begin, found.length[low:high], found.period[low:high]))
        low = high
    return out


def kept_words(n: int, runs: Runs) -> np.ndarray:
    """False for the words that some run holds after its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, runs.start + runs.period, 1)
    np.add.at(steps, runs.start + runs.length, -1)
    return np.cumsum(steps[:-1]) == 0


def strongest(runs: Runs) -> int | None:
    """Number of the run of greatest exact length / period; ties: smallest start, then period."""
    best = None
    for i, (start, length, period) in enumerate(zip(*(x.tolist() for x in runs))):
        if best is None or length * best[2] > best[1] * period or (
            length * best[2] == best[1] * period and (start, period) < (best[0], best[2])
        ):
            best = (start, length, period, i)
    return best and best[3]


def encode(text: str | None) -> tuple[np.ndarray, bytes]:
    """Numbers of a text's words, equal words alike, and the text's bytes."""
    data, known, parts = (text or "").encode("utf-8", "surrogatepass"), {}, []
    for words in word_pieces(data, 0):
        parts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), data


def collapse(data: bytes, keep: np.ndarray) -> str:
    """The kept words of a text, joined by one space."""
    at, out = 0, []
    for words in word_pieces(data, 0):
        flags = keep[at : at + len(words)].tolist()
        at += len(words)
        out += [w for w, k in zip(words, flags) if k]
    return b" ".join(out).decode("utf-8", "surrogatepass")


def answered(texts: pa.Array, exponent: int, least: int, pool: int = PIECE) -> Iterator[tuple[np.ndarray, bytes, Runs]]:
    """Word numbers, bytes and runs of every text; short texts are searched together."""
    held: list[tuple[np.ndarray, bytes]] = []
    size = 0
    for t in texts:
        held.append(encode(t.as_py()))
        size += len(held[-1][0])
        if size >= pool:
            yield from ((*h, r) for h, r in zip(held, runs_of([w for w, _ in held], exponent, least)))
            held, size = [], 0
    yield from ((*h, r) for h, r in zip(held, runs_of([w for w, _ in held], exponent, least)))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", exponent: int = 4, least: int = 6,
              keep: Sequence[str] = ()) -> DataFrame:
    """Id, ``keep`` columns, n_words, ``runs`` (an array of start, length, period, by start and then
    period), ``best`` (the run of greatest length / period; ties: smallest start, then period; null
    without runs) and ``collapsed`` (the words that no run holds after its first period, joined by
    one space), for every row.

    Words are what stands between white space (0x20, 0x09-0x0D), compared byte by byte.  A null text
    has no words, no runs and an empty ``collapsed``, like an empty one.  Repeated rows and rows
    without an id are answered like any other; an empty table gives no rows.  Only the id, text and
    ``keep`` columns are read.  Nothing is shuffled: a document is one row of one task.
    """
    run = "struct<start:bigint,length:bigint,period:bigint>"
    kept = docs.select(F.col(id_col), *[F.col(k) for k in keep], F.col(text).cast("string").alias("_whole"))
    names = kept.columns[:-1]
    schema = kept.drop("_whole").schema
    added = docs.sparkSession.createDataFrame(
        [], f"n_words bigint, runs array<{run}>, best {run}, collapsed string"
    ).schema
    for field in added:
        schema = schema.add(field)
    row_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, runs, best, collapsed = [], [], [], []
            for words, data, found in answered(batch.column(len(names)), exponent, least):
                rows = [dict(zip(Runs._fields, r)) for r in zip(*(x.tolist() for x in found))]
                top = strongest(found)
                sizes.append(len(words))
                runs.append(rows)
                best.append(None if top is None else rows[top])
                collapsed.append(collapse(data, kept_words(len(words), found)))
            yield pa.RecordBatch.from_arrays([
                *batch.columns[: len(names)], pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(row_type)),
                pa.array(best, row_type), pa.array(collapsed, pa.string()),
            ], names=[*names, *added.names])

    return kept.mapInArrow(work, schema)
