"""Token ids of whole texts in shard files, with keyed access through minimal perfect hashes.

A dataset is a folder: ``shards/`` holds the raw ids of the documents in ascending key order
(little-endian, 16 bits where the vocabulary allows, else 32), ``index/`` holds hash buckets that
map a key to its place, and two small tables name the files.  Inside a bucket a minimal perfect
hash gives every key a slot of its own, and the slot stores a fingerprint of the key, so a key
that was never written is told apart, and the place of its ids: one lookup is one hash, one
fingerprint and one read, however many documents there are.
"""

from __future__ import annotations

import io
import json
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bizops.llm.scratch import Scratch, spread, storage, write_once
from bizops.llm.tokens import load_tokenizer

BUCKET_KEYS = 4096  # keys of one hash bucket, give or take
ENCODE_BYTES = 4 << 20  # bytes of texts that are encoded together
CACHE_PIECES = 600_000  # pre-tokens whose ids a worker remembers, give or take
ORDER_CHARS = 32  # of equal ids, how much of a text orders them
READ_BYTES = 8 << 20  # what one read of neighbouring documents takes at most

# ---------------------------------------------------------------- minimal perfect hash

_GAMMA = 2.0  # bits per key and level while building
_LEVELS = 40


def mix64(keys: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit keys, another one for every salt."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@dataclass
class PerfectHash:
    """Levels of bit arrays: a key's slot is the rank of the first set bit it meets.

    A level sets the bits that exactly one of the remaining keys hits; the keys that collide go on
    to the next level.
    """

    sizes: np.ndarray  # bits of each level
    bits: np.ndarray  # all levels' bits, one after the other, packed
    ranks: np.ndarray  # set bits before each byte

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct keys."""
        left, sizes, levels = keys.astype(np.uint64), [], []
        while len(left):
            if len(sizes) == _LEVELS:
                raise ValueError("keys are not distinct")
            size = max(64, int(_GAMMA * len(left)) + 7 & ~7)
            at = (mix64(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[at]]
        bits = np.concatenate(levels) if levels else np.zeros(0, np.uint8)
        ones = np.bitwise_count(bits).astype(np.int64)
        return cls(np.array(sizes, np.int64), bits, np.cumsum(ones) - ones)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, 0 .. n - 1; -1 or any slot for keys that were not there."""
        keys = keys.astype(np.uint64)
        found, todo, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(todo):
                break
            at = base + (mix64(keys[todo], level) % np.uint64(size)).astype(np.int64)
            byte, bit = at >> 3, (at & 7).astype(np.uint8)
            hit = (self.bits[byte] >> bit & 1).astype(bool)
            below = np.bitwise_count(self.bits[byte] & ((np.uint8(1) << bit) - np.uint8(1)).astype(np.uint8))
            found[todo[hit]] = (self.ranks[byte] + below)[hit]
            todo, base = todo[~hit], base + size
        return found


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys, 101) >> np.uint64(32)).astype(np.uint32)


# ---------------------------------------------------------------- writing


# Fixed values of the tokenizer: its split of lower-case text, for letters up to Latin-1.
_LETTERS = "a-zß-öø-ÿ"
#: What is set apart by spaces: contractions, digits one by one, and runs of other signs.
_APART = rf"'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^ \t\n\x0b\f\r{_LETTERS}0-9]+"
#: Characters beyond which the split is left to the library, and the beginning of special strings.
_OTHER = "[^\\x00-\\x1b\\x20-\\x7eÀ-ÖØ-öø-ÿ]|<\\|"
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}


def cuts_alike(tokenizer) -> bool:
    """True if the tokenizer drops white space and cuts texts as ``_APART`` and ``_OTHER`` suppose."""
    told = json.loads(tokenizer.to_str())
    before = told.get("pre_tokenizer") or {}
    steps = before.get("pretokenizers", [])
    model = told["model"]
    return (
        told.get("normalizer") == _NORMALIZER and len(steps) == 2
        and steps[0] == {"type": "Split", "pattern": _SPLIT, "behavior": "Removed", "invert": True}
        and steps[1].get("type") == "ByteLevel" and not steps[1].get("add_prefix_space") and not steps[1].get("use_regex", True)
        and model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("dropout")
        and told.get("truncation") is None and told.get("padding") is None
        and all("<|" in t["content"] for t in told.get("added_tokens", []))
    )


def byte_list(strings: pa.StringArray) -> list[bytes]:
    """The UTF-8 bytes of all values, none of them null; much faster than ``to_pylist``."""
    _, at, data = strings.buffers()
    at = np.frombuffer(at, np.int32)[strings.offset : strings.offset + len(strings) + 1].tolist() if len(strings) else []
    data = data.to_pybytes() if data else b""
    return [data[a:b] for a, b in zip(at, at[1:])]


class Remembered:
    """Ids by pre-token; of those seen, the last ``limit`` to two times ``limit`` are remembered."""

    def __init__(self, limit: int, learn: Callable[[list[bytes]], Iterable[tuple[bytes, bytes]]]):
        self.limit, self.learn = limit, learn
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def look_up(self, texts: list[bytes]) -> list[bytes]:
        if len(self.known) > self.limit:
            self.known, self.older = {}, self.known
        found = list(map(self.known.get, texts))
        lost = {t for t, f in zip(texts, found) if f is None}
        if lost:
            self.known.update((t, self.older[t]) for t in lost & self.older.keys())
            self.known.update(self.learn(sorted(lost - self.older.keys())))
            found = list(map(self.known.__getitem__, texts))
        return found


class PieceEncoder:
    """Ids of many texts at once, remembering the ids of pre-tokens.

    A tokenizer that lower-cases, drops white space and splits as ``_APART`` does has as the ids of
    a text those of its pre-tokens in turn.  Arrow cuts the texts and numbers the pre-tokens, so
    Python sees each of them once per call.  Texts with other letters, special strings or separators
    that Arrow and the tokenizer treat differently, and all texts of any other tokenizer, go to the
    library whole.
    """

    _JOINED = 64  # new pre-tokens handed to the library as one text

    def __init__(self, tokenizer_path: str, dtype: str, limit: int = CACHE_PIECES):
        self.tokenizer, self.dtype = load_tokenizer(tokenizer_path), np.dtype(dtype)
        self.by_pieces = cuts_alike(self.tokenizer)
        self.pieces = Remembered(limit, self._learn)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(names.values()) + 1, bool)  # ids that end a pre-token
        self.ends[[i for name, i in names.items() if name.endswith("</w>")]] = True

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """The ids of new pre-tokens, many to a text: each ends with the only one of its ids that
        can end one, so they can be told apart; where the numbers disagree, one by one."""
        groups = [pieces[i : i + self._JOINED] for i in range(0, len(pieces), self._JOINED)]
        for group, ids in zip(groups, self.ids([b" ".join(g).decode() for g in groups])):
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(group) and cuts[-1] == len(ids):
                data, at = ids.tobytes(), [0, *(cuts * ids.itemsize).tolist()]
                yield from zip(group, (data[a:b] for a, b in zip(at, at[1:])))
            else:
                yield from zip(group, (x.tobytes() for x in self.ids([p.decode() for p in group])))

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        apart = pc.replace_substring_regex(pc.utf8_lower(texts), _APART, r" \0 ")
        lists = pc.ascii_split_whitespace(apart)
        coded = lists.flatten().dictionary_encode()
        spelled = self.pieces.look_up(byte_list(coded.dictionary))
        size = np.fromiter(map(len, spelled), np.int64, len(spelled)) // self.dtype.itemsize
        begin, pool = np.cumsum(size) - size, np.frombuffer(b"".join(spelled), self.dtype)
        piece = coded.indices.to_numpy(zero_copy_only=False)
        many = size[piece]
        upto = np.cumsum(many)
        ids = pool[np.repeat(begin[piece] - (upto - many), many) + np.arange(upto[-1] if len(upto) else 0)]
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        return ids, np.diff(np.r_[0, np.r_[0, upto][ends]])

    def encode_many(self, texts: pa.Array | Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        column = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).fill_null("")
        if self.by_pieces:
            other = pc.match_substring_regex(column, _OTHER).to_numpy(zero_copy_only=False)
            if not other.any():
                return self._by_pieces(column)
        else:
            other = np.ones(len(column), bool)
        whole = iter(self.ids(column.filter(pa.array(other)).to_pylist()))
        ids, many = self._by_pieces(column.filter(pa.array(~other)))
        rest = iter(np.split(ids, np.cumsum(many)[:-1]))
        parts = [next(whole if o else rest) for o in other]
        return np.concatenate([ids[:0], *parts]), np.array([len(p) for p in parts], np.int64)


_ENCODERS: dict[tuple[str, str], PieceEncoder] = {}


def encoder_for(tokenizer_path: str, dtype: str) -> PieceEncoder:
    """The encoder of this Python worker, kept from task to task with what it knows."""
    key = tokenizer_path, dtype
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(tokenizer_path, dtype)
    return _ENCODERS[key]


def by_size(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of neighbouring texts of about so many bytes, one text at least."""
    upto, first = np.cumsum(sizes), 0
    while first < len(sizes):
        done = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, done + most, side="right")))
        yield slice(first, last)
        first = last


def _write_shards(folder: str, tokenizer_path: str, dtype: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = encoder_for(tokenizer_path, dtype), TaskContext.get().partitionId()
        rows: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def payload(out) -> None:
            at = 0
            for batch in batches:
                keys, texts = batch.column(0), batch.column(1)
                sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
                for some in by_size(sizes, ENCODE_BYTES):
                    ids, many = encoder.encode_many(texts[some])
                    out.write(np.insert(ids, np.cumsum(many), end_id).tobytes())
                    many = many + 1
                    begin = at + np.cumsum(many) - many
                    rows.append((keys[some], begin, many))
                    at += int(many.sum())

        name = write_once(f"{folder}/shards", f"{shard:06d}", payload)
        for key, at, n in rows:
            yield pa.RecordBatch.from_arrays(
                [key, pa.array([shard] * len(key), pa.int32()), pa.array([name] * len(key)),
                 pa.array(at, pa.int64()), pa.array(n, pa.int64())],
                names=["key", "shard", "file", "at", "n"],
            )

    return run


def bucket_of(key: Column, buckets: int) -> Column:
    """Null keys have a bucket of their own, the last."""
    return F.when(key.isNull(), F.lit(buckets)).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def _write_index(folder: str):
    """Rows of whole cells (a bucket, or a shard's part of an id with very many rows), sorted by
    (cell, key, shard, at), in; one row per cell out."""

    def pack(rows: pd.DataFrame) -> bytes:
        keys, first = np.unique(rows["key"].fillna(0).to_numpy(np.int64), return_index=True)
        hashed = PerfectHash.build(keys.view(np.uint64))
        slot = hashed.slots(keys.view(np.uint64))
        runs = np.diff(np.r_[first, len(rows)])  # repeated keys stand together
        prints, begin, many = (np.zeros(len(keys), t) for t in (np.uint32, np.int64, np.int64))
        prints[slot], begin[slot], many[slot] = fingerprints(keys.view(np.uint64)), first, runs
        out = io.BytesIO()
        np.savez(out, sizes=hashed.sizes, bits=hashed.bits, ranks=hashed.ranks, prints=prints, begin=begin, many=many,
                 shard=rows["shard"].to_numpy(np.int32), at=rows["at"].to_numpy(np.int64), n=rows["n"].to_numpy(np.int64))
        return out.getvalue()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: list[tuple[int, int, int]] = []

        def payload(out) -> None:
            pos = 0
            for cell, rows in whole_groups(frames, "cell"):
                data = pack(rows)
                out.write(data)
                made.append((cell, pos, len(data)))
                pos += len(data)

        name = write_once(f"{folder}/index", f"{TaskContext.get().partitionId():06d}", payload)
        if made:
            cell, pos, size = zip(*made)
            yield pd.DataFrame({"cell": cell, "file": name, "pos": pos, "size": size})

    return run


def whole_groups(frames: Iterator[pd.DataFrame], by: str) -> Iterator[tuple[int, pd.DataFrame]]:
    """The groups of rows that arrive sorted by one column; one group is held at a time."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        for value, part in frame.groupby(by, sort=False):
            if held and held[0][by].iloc[0] != value:
                yield held[0][by].iloc[0], pd.concat(held, ignore_index=True)
                held = []
            held.append(part)
    if held:
        yield held[0][by].iloc[0], pd.concat(held, ignore_index=True)


@dataclass
class TokenDataset:
    """A written dataset: its folder, its two tables and its numbers."""

    folder: str
    dtype: str
    buckets: int
    shards: DataFrame  # shard, file, base (ids in all shards before it), ids, docs
    index: DataFrame  # bucket, cell, file, pos, size


def write_dataset(docs: DataFrame, folder: str, tokenizer_path: str, scratch: Scratch, id_col: str = "doc_id",
                  text: str = "text", end_id: int = 1, vocabulary: int | None = None, shards: int | None = None,
                  bucket_keys: int = BUCKET_KEYS) -> TokenDataset:
    """Encode every whole text, append ``end_id``, and write ids and index below ``folder``.

    Documents are dealt out by ranges of their id, so shards follow each other in ascending id
    order, null ids first.  Equal ids stand in order of the first ``ORDER_CHARS`` characters of their
    texts, then of a hash of the whole text, then as they were read, and these take part in the
    ranges: an id that holds a third of all rows fills as many shards as its texts need.  Null texts
    are empty: only the end id.  Every attempt of a task writes files of its own, and the tables name those of
    the attempts that succeeded.  An empty table gives empty tables.
    """
    spark = docs.sparkSession
    size = vocabulary or load_tokenizer(tokenizer_path).get_vocab_size()
    dtype = "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"
    named = docs.select(F.col(id_col).cast("bigint").alias("_key"), F.col(text).cast("string").alias("_text"))
    order = [F.col("_key"), F.substring("_text", 1, ORDER_CHARS), F.xxhash64("_text"), F.col("_row")]
    ordered = named.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(
        shards or int(spark.conf.get("spark.sql.shuffle.partitions")), *order
    ).sortWithinPartitions(*order)
    entries = scratch.table(
        ordered.select("_key", "_text").mapInArrow(_write_shards(folder, tokenizer_path, dtype, end_id),
                           "key bigint, shard int, file string, at bigint, n bigint"), "entries")
    # One row per shard: the running sum is over the files of the dataset, not its documents.
    totals = entries.groupBy("shard", "file").agg(F.sum("n").alias("ids"), F.count(F.lit(1)).alias("docs"))
    base = F.coalesce(F.sum("ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shard_table = scratch.table(totals.withColumn("base", base), "shards")
    buckets = max(1, -(-(shard_table.agg(F.sum("docs")).first()[0] or 0) // bucket_keys))
    # An id with more rows than a bucket should hold is indexed once per shard that holds it.
    many = entries.groupBy(F.coalesce("key", F.lit(0)).alias("_same"), F.col("key").isNull().alias("_null")).agg(
        F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bucket_keys).drop("_n")
    same = (F.coalesce("key", F.lit(0)) == F.col("_same")) & (F.col("key").isNull() == F.col("_null"))
    part = F.when(F.col("_same").isNotNull(), F.col("shard") + 1).otherwise(0)
    cell = bucket_of(F.col("key"), buckets).cast("bigint") * F.lit(1 << 32) + part
    index = scratch.table(
        entries.join(many, same, "left").select(cell.alias("cell"), "key", "shard", "at", "n")
        .repartition("cell").sortWithinPartitions("cell", "key", "shard", "at")
        .mapInPandas(_write_index(folder), "cell bigint, file string, pos bigint, size bigint")
        .withColumn("bucket", F.shiftright("cell", 32).cast("int")), "index")
    return TokenDataset(folder, dtype, buckets, shard_table, index)


# ---------------------------------------------------------------- reading


def _look_up(folder: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = storage(f"{folder}/index")
        for _, rows in whole_groups(frames, "cell"):
            first = rows.iloc[0]
            with fs.open_input_file(f"{path}/{first['file']}") as f:
                part = np.load(io.BytesIO(f.read_at(int(first["size"]), int(first["pos"]))))
            keys = rows["key"].fillna(0).to_numpy(np.int64).view(np.uint64)
            slot = PerfectHash(part["sizes"], part["bits"], part["ranks"]).slots(keys)
            there = (slot >= 0) & (slot < len(part["prints"]))
            there[there] = part["prints"][slot[there]] == fingerprints(keys[there])
            many = part["many"][slot[there]]
            start = np.repeat(part["begin"][slot[there]], many)
            at = start + np.arange(len(start)) - np.repeat(np.cumsum(many) - many, many)
            yield pd.DataFrame({
                "key": rows["key"][there].repeat(many).reset_index(drop=True),
                "shard": part["shard"][at], "at": part["at"][at], "n": part["n"][at],
            })

    return run


def look_up(dataset: TokenDataset, keys: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(key, shard, at, n): the place of each distinct key's ids, one row for every document that
    has the key, none for a key that was never written."""
    wanted = keys.select(F.col(id_col).cast("bigint").alias("key")).distinct()
    wanted = wanted.withColumn("bucket", bucket_of(F.col("key"), dataset.buckets))
    return (
        wanted.join(dataset.index, "bucket").repartition("cell").sortWithinPartitions("cell")
        .mapInPandas(_look_up(dataset.folder), "key bigint, shard int, at bigint, n bigint")
    )


def _read(folder: str, dtype: str, with_ids: bool, gap: int = READ_BYTES):
    width = np.dtype(dtype).itemsize

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = storage(f"{folder}/shards")
        opened, f = None, None
        for rows in frames:
            out: dict[str, list] = {"crc": [], "ids": []}
            start, data = 0, b""
            ends = (rows["at"] + rows["n"]).to_numpy() * width
            begins, names = rows["at"].to_numpy() * width, rows["file"].to_numpy()
            for i in range(len(rows)):
                if names[i] != opened:
                    if f is not None:
                        f.close()
                    f, opened, data = fs.open_input_file(f"{path}/{names[i]}"), names[i], b""
                if begins[i] < start or ends[i] > start + len(data):
                    j = i  # this and the following documents in one read
                    while j + 1 < len(rows) and names[j + 1] == opened and begins[j + 1] >= begins[i] and ends[j + 1] - begins[i] <= gap:
                        j += 1
                    start = int(begins[i])
                    data = f.read_at(int(max(ends[i], ends[j])) - start, start)
                ids = np.frombuffer(data, dtype, int(rows["n"].iloc[i]), int(begins[i]) - start)
                out["crc"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                if with_ids:
                    out["ids"].append(ids.astype(np.int64))
            made = pd.DataFrame({"doc_id": rows["key"], "start": rows["base"] + rows["at"], "n_tokens": rows["n"], "ids_crc32": np.array(out["crc"], np.int64)})
            yield made.assign(ids=out["ids"]) if with_ids else made
        if f is not None:
            f.close()

    return run


def read_documents(dataset: TokenDataset, keys: DataFrame, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit numbers) and, if wanted, ids of the documents with these keys.

    Places come from the index, the payload from sorted reads of the shards."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    placed = look_up(dataset, keys, id_col).join(dataset.shards.select("shard", "file", "base"), "shard")
    return (
        placed.repartition(spread(keys), "shard").sortWithinPartitions("shard", "at")
        .mapInPandas(_read(dataset.folder, dataset.dtype, with_ids), schema)
    )


def encode_and_read(spark: SparkSession, docs: DataFrame, scratch: Scratch, tokenizer_path: str, **options) -> DataFrame:
    """Write a dataset into the scratch folder and read every document back by its key."""
    dataset = write_dataset(docs, scratch.path("tokens"), tokenizer_path, scratch, **options)
    return read_documents(dataset, docs, options.get("id_col", "doc_id"), with_ids=False)
