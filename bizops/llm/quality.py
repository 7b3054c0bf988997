"""Text quality by compression: which dictionary, good or bad, shortens a text more.

Two zstandard dictionaries are trained on labelled text.  A document is compressed with both; the
difference of the sizes, divided by the text's length and by the sum of the sizes, together with
the length and the better ratio (a text that repeats itself shrinks under any dictionary), goes
through a logistic calibration fitted on whole labelled texts that the dictionaries never saw.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizops.llm.compression import compressor, dictionary, even_sample, held_out, label_sizes, map_texts, piece

THRESHOLD = 0.3


@dataclass(frozen=True)
class QualityModel:
    """Fitted on the driver, a few hundred kB, sent to the tasks with the function."""

    good: bytes
    bad: bytes
    level: int
    weights: tuple[float, ...]  # intercept first, for the scaled features
    centre: tuple[float, ...]
    scale: tuple[float, ...]

    def scorer(self):
        trained = [compressor(d, self.level, trained=True) for d in (self.good, self.bad)]

        def score(texts: pa.Array) -> list[pa.Array]:
            raw = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in texts]
            p = self.probability(features(raw, trained))
            return [pa.array(p, pa.float64())]

        return score

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = (x - np.array(self.centre)) / np.array(self.scale)
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + z @ np.array(self.weights[1:]), -40, 40)))


def features(texts: Sequence[bytes], pair) -> np.ndarray:
    n = np.array([len(t) for t in texts], float)
    good, bad = (np.array([len(c.compress(t)) for t in texts], float) for c in pair)
    least = np.maximum(n, 1)
    return np.column_stack([
        (bad - good) / least, (bad - good) / np.maximum(good + bad, 1), np.log1p(n), np.minimum(good, bad) / least,
    ]) if len(n) else np.zeros((0, 4))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30):
    """Weighted logistic regression by Newton steps, with a small ridge."""
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    a = np.column_stack([np.ones(len(x)), (x - centre) / scale])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        grad = a.T @ (weight * (p - y)) + 1e-2 * w
        curve = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(curve, grad)
    return tuple(w), tuple(centre), tuple(scale)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
        per_label: int = 3200, excerpt: int = 2000, size: int = 262_144, level: int = 3) -> QualityModel:
    """Fit on a bounded sample: about ``per_label`` labelled documents of each class that are not
    held out.  Half of them train the dictionaries, each with ``excerpt`` characters from a hashed
    place in its text; the other half calibrates, with whole texts as they will be scored (only
    their four features come to the driver) and the classes' true shares.

    The bound is on documents, not ids: an id with very many texts is thinned like the rest, and
    repeated rows count once.  Labels other than 0 and 1 and null texts are left out.  Without examples of both classes the
    model gives every text the same score, the share of label 1 (0.5 without any label).
    """
    known = labels.where(F.col(label).isin(0, 1)).where(~held_out(id_col)).select(
        F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y")
    ).distinct()
    totals = label_sizes(known, "_y")
    chosen = F.broadcast(even_sample(known, "_y", ["_id"], per_label, totals).drop("h"))  # bounded by per_label
    named = docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("t")).where("t IS NOT NULL")
    joined = named.join(chosen, "_id")
    sample = even_sample(joined, "_y", ["_id", "t"], per_label, label_sizes(joined, "_y"))
    half = F.xxhash64(F.lit("half"), "h")
    train = sample.where(half >= 0).select("_y", F.encode(piece("t", "train", excerpt), "utf-8").alias("t"), "h").collect()
    found = {y: [bytes(r["t"]) for r in sorted((r for r in train if r["_y"] == y), key=lambda r: r["h"])] for y in (0, 1)}
    share = (totals.get(1, 0) + 0.5) / (sum(totals.values()) + 1)
    constant = (float(np.log(share / (1 - share))), 0.0, 0.0, 0.0, 0.0)
    flat = QualityModel(b"", b"", level, constant, (0.0,) * 4, (1.0,) * 4)
    if not all(found.values()):
        return flat
    good, bad = (dictionary(found[y], size, level, trained=True) for y in (1, 0))

    def measure():
        pair = [compressor(d, level, trained=True) for d in (good, bad)]

        def run(texts: pa.Array) -> list[pa.Array]:
            x = features([t.as_py().encode("utf-8", "surrogatepass") for t in texts], pair)
            return [pa.array(x.tolist(), pa.list_(pa.float64()))]

        return run

    rest = sample.where(half < 0)
    rows = map_texts(rest, "t", [F.col("_y"), F.col("h")], "x array<double>", measure).collect()
    rows.sort(key=lambda r: (r["h"], r["_y"]))
    x, y = np.array([r["x"] for r in rows]), np.array([r["_y"] for r in rows])
    if len(set(y.tolist())) < 2:
        return flat
    weight = np.where(y == 1, share / (y == 1).sum(), (1 - share) / (y == 0).sum()) * len(y)
    return QualityModel(good, bad, level, *calibrate(x, y, weight))


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text: str = "text",
          threshold: float = THRESHOLD, keep: Sequence[str] = ()) -> DataFrame:
    """Id, ``keep`` columns, held_out, score (0 to 1) and predicted for every row, whole texts.

    Null and empty texts are scored like any other, as texts of no bytes.  Repeated rows get equal
    scores.  Only the id, text and ``keep`` columns are read.
    """
    scored = map_texts(docs, text, [F.col(id_col), *map(F.col, keep)], "score double", model.scorer)
    return scored.select(
        id_col, *keep, held_out(id_col).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
