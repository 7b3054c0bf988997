"""Exact top-k inner products by MaxScore over impact postings.

A vector component is a term: a dimension and a sign, with the size of the scaled component as its
impact.  Vectors are indexed in shards; a shard has one posting list per term.  For a query, only
lists of its own sign can raise a score, by at most its weight times the list's largest impact.
Sorted by these bounds, the smallest ones that together cannot lift a vector over the k-th best
score so far are the non-essential terms.  The essential lists are traversed for all vectors of
the shard, the others are probed one by one for vectors that can still compete.  The shards' best
are merged.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bizops.llm import varint
from bizops.llm.scratch import Scratch, spread, storage, write_once

SCALE = 1024
SHARD = 8192  # vectors of one shard
QUERY_BLOCK = 4096  # queries held at a time
SEEDS = 4  # times k: vectors scored at once for a first threshold
KEPT_BESTS = 100_000  # queries whose best scores a task carries from shard to shard
PACKED = 1 << 35  # impacts below this are stored as bytes of seven bits, larger ones as digits
WORD = 1 << 62  # sums below this are made in machine words, others in whole numbers of any size


def usable(rows: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v): the components, as doubles, of the rows that take part.

    Left out are rows with a null id, a null vector, or a component that is null or not finite."""
    x = F.col(vector)
    fine = F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))  # NaN is not below
    return rows.where(F.col(id_col).isNotNull() & x.isNotNull() & fine).select(
        F.col(id_col).cast("bigint").alias("id"), x.cast("array<double>").alias("v")
    )


def _dense(vectors: list) -> np.ndarray:
    """Rows of doubles; a shorter vector has zeros at its end."""
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * component), in machine words or, where one does not fit, as Python's whole numbers."""
    if not x.size or np.abs(x).max() < WORD / scale:
        return np.floor(x * scale).astype(np.int64)
    out = np.empty(x.shape, object)
    for at, c in np.ndenumerate(x):
        product = float(c) * scale
        out[at] = math.floor(product) if math.isfinite(product) else int(c) * scale
    return out


def _index(size: int, scale: int):
    names = ["shard", "term", "top", "docs", "impacts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId() << 24, 0
        ids: list[int] = []
        vectors: list = []

        def flush() -> pa.RecordBatch:
            x = scaled(_dense(vectors), scale)
            rows = [(task + number, -1, x.shape[1], np.array(ids, "<i8").tobytes(), b"")]
            for d in range(x.shape[1]):
                for sign in (0, 1):
                    at = np.flatnonzero(x[:, d] < 0 if sign else x[:, d] > 0)
                    if len(at):
                        impacts = np.abs(x[at, d])
                        places = varint.encode(np.diff(at, prepend=0))[0].tobytes()
                        if impacts.max() < PACKED:
                            rows.append((task + number, 2 * d + sign, int(impacts.max()), places, varint.encode(impacts)[0].tobytes()))
                        else:
                            rows.append((task + number, 2 * d + sign, -1, places, b" ".join(b"%d" % i for i in impacts.tolist())))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for key, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist()):
                ids.append(key)
                vectors.append(v)
                if len(ids) >= size:
                    yield flush()
                    number += 1
                    ids, vectors = [], []
        if ids:
            yield flush()

    return run


def _write_queries(folder: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = 0
        for frame in frames:
            for at in range(0, len(frame), QUERY_BLOCK):
                part = frame.iloc[at : at + QUERY_BLOCK]
                out = io.BytesIO()
                np.savez(out, ids=part["id"].to_numpy(np.int64), q=_dense(part["v"].tolist()))  # unscaled doubles
                name = write_once(folder, f"{TaskContext.get().partitionId():06d}-{number:06d}", out.getvalue())
                number += 1
                yield pd.DataFrame({"block": [name]})

    return run


class Shard:
    """The posting lists of one shard, and the same components by vector for probing."""

    def __init__(self, rows: pd.DataFrame):
        head = rows[rows["term"] == -1].iloc[0]
        self.ids = np.frombuffer(head["docs"], "<i8")
        self.exact = bool((rows["top"] < 0).any())  # holds components that machine words cannot multiply
        self.x = np.zeros((len(self.ids), int(head["top"])), object if self.exact else np.int64)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.tops = np.zeros(2 * self.x.shape[1], np.int64)
        for term, top, docs, impacts in zip(rows["term"], rows["top"], rows["docs"], rows["impacts"]):
            if term >= 0:
                at = np.cumsum(varint.decode(docs))
                size = varint.decode(impacts) if top >= 0 else np.array([int(i) for i in impacts.split()], object)
                self.lists[term], self.tops[term] = (at, size), max(top, 0)
                self.x[at, term >> 1] = -size if term & 1 else size

    def best(self, query: np.ndarray, own: int, k: int, least: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of this shard's candidates for the k best, own id excluded.  ``least``
        is a score that k others are known to reach."""
        dims = np.flatnonzero(query[: self.x.shape[1]])
        weight = query[dims]
        if self.exact or query.dtype == object or np.abs(weight).astype(float) @ self.tops.reshape(-1, 2).max(axis=1, initial=0)[dims].astype(float) >= WORD:
            return self._best_exact(dims, weight, own, k)
        bounds = np.abs(weight) * self.tops[2 * dims + (weight < 0)]
        order = np.argsort(-bounds, kind="stable")
        dims, weight, bounds = dims[order], weight[order], bounds[order]
        after = np.r_[np.cumsum(bounds[::-1])[::-1], 0]  # after[i]: what terms i.. can add at most
        others = self.ids != own
        if least is None and int(others.sum()) > k:
            first = self.x[:, dims[:8]] @ weight[:8]
            first[~others] = np.iinfo(np.int64).min
            seeds = np.argpartition(-first, min(SEEDS * k, len(first) - 1))[: SEEDS * k]
            seeds = seeds[others[seeds]]
            if len(seeds) >= k:
                least = int(np.sort(self.x[seeds][:, dims] @ weight)[-k])
        essential = len(dims) if least is None else int(np.argmax(after < least)) if (after < least).any() else len(dims)
        score = np.zeros(len(self.ids), np.int64)
        for d, w in zip(dims[:essential].tolist(), weight[:essential].tolist()):
            for sign in (0, 1):
                if (found := self.lists.get(2 * d + sign)) is not None:
                    score[found[0]] += (-w if sign else w) * found[1]
        live = np.flatnonzero(others if least is None else others & (score + after[essential] >= least))
        score = score[live]
        for i in range(essential, len(dims)):
            if not len(live):
                break
            score = score + weight[i] * self.x[live, dims[i]]
            keep = score + after[i + 1] >= least
            live, score = live[keep], score[keep]
        if len(live) > k:
            top = np.lexsort((self.ids[live], -score))[:k]
            live, score = live[top], score[top]
        return self.ids[live], score


    def _best_exact(self, dims: np.ndarray, weight: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for values whose sums may leave the machine word: all lists are essential."""
        score = np.zeros(len(self.ids), object)
        for d, w in zip(dims.tolist(), weight.tolist()):
            for sign in (0, 1):
                if (found := self.lists.get(2 * d + sign)) is not None:
                    score[found[0]] += (-w if sign else w) * found[1].astype(object)
        live = [(-s, i) for s, i in zip(score.tolist(), self.ids.tolist()) if i != own]
        top = heapq.nsmallest(k, live)
        return np.array([i for _, i in top], np.int64), np.array([-s for s, _ in top], object)


def _in_long(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores held within a long, and which of them are not the true ones."""
    if scores.dtype != object:
        return scores, np.zeros(len(scores), bool)
    most = (1 << 63) - 1
    held = [max(-most - 1, min(most, s)) for s in scores.tolist()]
    return np.array(held, np.int64), np.array([h != s for h, s in zip(held, scores.tolist())], bool)


def _search(folder: str, blocks: list[str], k: int, scale: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = storage(folder)
        least: dict[int, list[int]] = {}  # by query: its k best scores in this task so far

        def search(shard: Shard) -> Iterator[pd.DataFrame]:
            for block in blocks:
                if len(least) > KEPT_BESTS:  # only a head start; the result is the same without it
                    least.clear()
                with fs.open_input_file(f"{path}/{block}") as f:
                    part = np.load(io.BytesIO(f.read()))
                out = []
                for own, query in zip(part["ids"].tolist(), scaled(part["q"], scale)):
                    seen = least.get(own, [])
                    ids, score = shard.best(query, own, k, seen[-1] if len(seen) == k else None)
                    least[own] = sorted(seen + score.tolist(), reverse=True)[:k]
                    held, beyond = _in_long(score)
                    out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": held, "beyond": beyond}))
                if out:
                    yield pd.concat(out, ignore_index=True)

        held: list[pd.DataFrame] = []
        for frame in frames:
            for value, part in frame.groupby("shard", sort=False):
                if held and held[0]["shard"].iloc[0] != value:
                    yield from search(Shard(pd.concat(held, ignore_index=True)))
                    held = []
                held.append(part)
        if held:
            yield from search(Shard(pd.concat(held, ignore_index=True)))

    return run


def top_k(vectors: DataFrame, queries: DataFrame, scratch: Scratch, k: int = 10, id_col: str = "vec_id",
          vector: str = "embedding", scale: int = SCALE, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best scores of every query among all vectors but
    those with its own id; ties go to the smaller id.  All, where there are fewer than k.

    Rows that ``usable`` leaves out are neither queries nor candidates.  Components of any finite size
    take part, and scores are exact; one of the result that a long cannot hold is an error.  Vectors of
    different lengths are compared over their common components, so an empty one scores 0.  Repeated
    candidates all count; a query id is asked once, with the first of its vectors in order.  Without
    vectors or queries there are no rows.
    """
    found = usable(vectors, id_col, vector)
    index = scratch.table(found.mapInArrow(
        _index(shard, scale), "shard bigint, term int, top bigint, docs binary, impacts binary"), "postings")
    folder = scratch.path("queries")
    asked = usable(queries, id_col, vector).groupBy("id").agg(F.min("v").alias("v"))
    written = scratch.table(asked.mapInPandas(_write_queries(folder), "block string"), "blocks")
    # File names of query blocks: each task of this small stage writes one for 4,096 queries.
    blocks = sorted(r["block"] for r in written.collect())
    best = index.repartition(spread(index), "shard").sortWithinPartitions("shard", "term").mapInPandas(
        _search(folder, blocks, k, scale), "query_id bigint, vec_id bigint, score bigint, beyond boolean"
    )
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    told = F.when(F.col("beyond"), F.raise_error(F.lit("a score is beyond a long"))).otherwise(F.col("score"))
    return ranked.select("query_id", "rank", "vec_id", told.alias("score"))


def divisible(id_col: str, by: int) -> Column:
    return F.col(id_col) % by == 0
