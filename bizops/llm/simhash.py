"""SimHash fingerprints and near-duplicate groups by bit-sliced comparison.

Fingerprints that differ in at most ``radius`` bits agree on all of some choice of blocks, when
the 64 bits are cut into ``radius + 2`` blocks and two of them are compared (radius 3: 10 choices
of about 26 bits).  Each distinct fingerprint goes to one bucket per choice.  Inside the buckets
fingerprints are stored vertically, one bit plane per bit position, and the distances of 64
neighbours are counted at once with carry-save counters; words of which every lane has passed
the radius are dropped from the block.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizops.llm.components import connected_components
from bizops.llm.scratch import Scratch

BITS = 64
TILE = 1024  # fingerprints of one bucket that one comparison block takes from either side
PIECE = 1 << 20  # bytes of a text that are split into words at a time
_SPACE = b" \t\n\x0b\x0c\r"


def word_pieces(data: bytes, keep: int, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text in pieces of bounded size; each starts with the last ``keep`` words
    of the one before, so no shingle of ``keep + 1`` words is lost or repeated."""
    if len(data) <= piece:
        yield data.split()
        return
    tail: list[bytes] = []
    at = 0
    while at < len(data):
        end = min(at + piece, len(data))
        while end < len(data) and data[end] not in _SPACE:
            end += 1
        words = tail + data[at:end].split()
        at = end
        if len(words) > keep or at >= len(data):
            yield words
            tail = words[-keep:] if keep else []
        else:
            tail = words


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Majority of the bits of the XXH64 of all word shingles; 0 for a text without words."""
    counts, total, few = np.zeros(BITS, np.int64), 0, None
    digest = xxhash.xxh64_digest
    for words in word_pieces((text or "").encode("utf-8", "surrogatepass").lower(), shingle - 1):
        if len(words) < shingle:
            if not total:
                few = words
            continue
        few = None
        grams = zip(*(words[i:] for i in range(shingle)))
        hashes = b"".join([digest(b" ".join(g), seed) for g in grams])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.int32)
        total += len(bits)
    if few:
        return int.from_bytes(digest(b" ".join(few), seed), "big")
    if not total:
        return 0
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``fp`` (the 64 bits as a bigint) for every row, whole texts."""
    schema = docs.select(*keep).schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(len(keep))]
            column = pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], column], names=[*batch.schema.names[: len(keep)], "fp"]
            )

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def masks(radius: int) -> list[int]:
    """Bit masks of all pairs of ``radius + 2`` blocks: within the radius, one pair is equal."""
    blocks = radius + 2
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    single = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [x | y for x, y in combinations(single, 2)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _planes(fps: np.ndarray) -> np.ndarray:
    """Vertical storage: row b holds bit b of all fingerprints, 64 of them to a word."""
    words = -(-len(fps) // 64)
    bits = np.zeros((BITS, words * 64), np.uint8)
    bits[:, : len(fps)] = np.unpackbits(
        fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
    ).T
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def _pack(flags: np.ndarray, words: int) -> np.ndarray:
    full = np.zeros(words * 64, np.uint8)
    full[: len(flags)] = flags
    return np.packbits(full, bitorder="little").view("<u8")


def _shift(planes: np.ndarray, by: int) -> np.ndarray:
    """Lane i of the result is lane i + by of the planes."""
    whole, rest = divmod(by, 64)
    out = np.zeros_like(planes)
    width = planes.shape[1] - whole
    if width <= 0:
        return out
    out[:, :width] = planes[:, whole:] >> np.uint64(rest)
    if rest and width > 1:
        out[:, : width - 1] |= planes[:, whole + 1 :] << np.uint64(64 - rest)
    return out


def near_lanes(left: np.ndarray, right: np.ndarray, wanted: np.ndarray, radius: int, step: int = 8) -> np.ndarray:
    """Lanes (as packed words) among ``wanted`` whose two fingerprints differ in <= radius bits.

    The counters hold, bit-sliced, how far a lane is from passing the radius; a carry out of the
    top counter marks it.  Every ``step`` planes the words without a live lane are left behind.
    """
    depth = max(1, radius.bit_length())
    start = (1 << depth) - 1 - radius
    result = np.zeros_like(wanted)
    at = np.flatnonzero(wanted)
    left, right, live = left[:, at], right[:, at], wanted[at]
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    counter = [np.full(len(at), full if start >> i & 1 else 0, np.uint64) for i in range(depth)]
    for b in range(BITS):
        carry = left[b] ^ right[b]
        for i in range(depth):
            counter[i], carry = counter[i] ^ carry, counter[i] & carry
        live = live & ~carry
        if b % step == step - 1:
            on = live != 0
            if not on.all():
                at, live = at[on], live[on]
                left, right = left[:, on], right[:, on]
                counter = [c[on] for c in counter]
            if not len(at):
                return result
    result[at] = live
    return result


def links_in_tiles(fps: np.ndarray, tile: np.ndarray, radius: int) -> np.ndarray:
    """For rows in which equal ``tile`` values stand together: the first row of each row's
    group of linked rows of its tile (its own number if it has no link)."""
    n = len(fps)
    root = np.arange(n)
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    planes = _planes(fps)
    for by in range(1, n):
        same = tile[:-by] == tile[by:]
        if not same.any():
            break
        same &= root[:-by] != root[by:]  # already in one group: the link adds nothing
        if not same.any():
            continue
        lanes = near_lanes(planes, _shift(planes, by), _pack(same, planes.shape[1]), radius)
        hit = np.flatnonzero(np.unpackbits(lanes.view(np.uint8), bitorder="little"))
        for i in hit.tolist():
            a, b = find(i), find(i + by)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(hit):
            up = np.array(parent)
            root = up[up]
            while (root != up).any():
                up, root = root, root[root]
            parent = root.tolist()
    return root


def _compare(radius: int, rows: int = 1 << 16):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None

        def links(df: pd.DataFrame) -> pd.DataFrame:
            keys = df[["table", "key", "a", "b"]].to_numpy()
            tile = np.cumsum(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            root = links_in_tiles(df["fp"].to_numpy().view(np.uint64), tile, radius)
            rep = df["rep"].to_numpy()
            found = np.flatnonzero(root != np.arange(len(df)))
            return pd.DataFrame({"u": rep[found], "v": rep[root[found]]})

        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            if len(held) < rows:
                continue
            last = (held[["table", "key", "a", "b"]].to_numpy() == held[["table", "key", "a", "b"]].to_numpy()[-1]).all(axis=1)
            cut = len(held) - int(last.sum())  # the last tile may go on
            if cut:
                yield links(held.iloc[:cut].reset_index(drop=True))
                held = held.iloc[cut:].reset_index(drop=True)
        if held is not None and len(held):
            yield links(held)

    return run


def fingerprint_links(reps: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """Links (u, v) that connect all fingerprints within ``radius`` bits.

    ``reps`` has one row per distinct fingerprint: ``fp`` and ``rep`` (bigint).  The result holds
    a spanning star of each bucket's groups rather than all pairs; its components are those of
    the full link graph.  A bucket larger than ``tile`` is dealt out as pairs of parts, so no task
    holds more than two parts of it.
    """
    bands = reps.select(
        "fp", "rep",
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
            for i, m in enumerate(masks(radius))
        ])).alias("_band"),
    ).select("fp", "rep", "_band.table", "_band.key")
    sizes = bands.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / F.lit(tile)).cast("int")

    def both(part: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda j: F.struct(F.least(part, j).alias("a"), F.greatest(part, j).alias("b")),
        )

    tiles = (
        bands.join(sizes, ["table", "key"])
        .select("table", "key", "fp", "rep", parts.alias("parts"))
        .withColumn("_part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .withColumn("_tile", F.explode(both(F.col("_part"))))
        .select("table", "key", "_tile.a", "_tile.b", "fp", "rep")
    )
    return (
        tiles.repartition("table", "key", "a", "b")
        .sortWithinPartitions("table", "key", "a", "b")
        .mapInPandas(_compare(radius), "u bigint, v bigint")
    )


def near_duplicates(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text: str = "text",
                    shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per document: id, ``fp`` (bigint) and ``component_id``, the smallest id reachable
    over links of at most ``radius`` differing bits.

    Ids may be of any type with an order.  Null and wordless texts have fingerprint 0 and link like
    any other.  Repeated rows stay repeated; rows that share an id but not a text belong each to its
    own group.  Rows with a null id link like others but give no component its name (null where only
    such rows are).  Only the id and text columns are read.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    fps = scratch.table(with_fingerprint(named, "text", shingle), "fingerprints")
    reps = scratch.table(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "reps")
    # The nodes are the fingerprints themselves; a component's name is found once it is complete.
    members = connected_components(fingerprint_links(reps.select("fp", F.col("fp").alias("rep")), radius), scratch)
    joined = reps.join(members, F.col("fp") == F.col("node"))
    names = joined.groupBy(F.col("component").alias("_component")).agg(F.min("rep").alias("_name"))
    linked = joined.join(names, F.col("component") == F.col("_component")).select(
        F.col("node").alias("_node"), F.col("_name"), F.lit(True).alias("_linked"))
    # Written, so that the join with the documents is one of two tables: Spark can then split a
    # fingerprint that very many documents share, or broadcast the classes if they are few.
    classes = scratch.table(reps.join(linked, F.col("fp") == F.col("_node"), "left").select(
        F.col("fp").alias("_fp"), F.when(F.col("_linked"), F.col("_name")).otherwise(F.col("rep")).alias("component_id")
    ), "classes")
    return fps.join(classes, F.col("fp") == F.col("_fp"), "left").select(
        F.col("doc_id").alias(id_col), "fp", "component_id"
    )
