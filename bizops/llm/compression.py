"""Compression as a classifier: sizes of texts under one zstandard dictionary per class."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows with this remainder of the id's checksum are held out from all fitting.
HELD_OUT = 5


def held_out(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text is divisible by 5 (a null id is never held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def label_sizes(rows: DataFrame, label: str, most: int = 500) -> dict:
    """Number of rows of each label, of the ``most`` commonest ones where a label column holds more
    different values; that many rows come to the driver."""
    counted = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), label).limit(most)
    return {r[label]: r["n"] for r in counted.collect()}


def even_sample(rows: DataFrame, label: str, keys: str | Sequence[str], per_label: int, sizes: dict) -> DataFrame:
    """About ``per_label`` rows of each label in ``sizes``, the same on every run, by one filter.

    A row is kept if the hash of its keys falls under its label's share, so nothing is sorted or
    gathered, however many rows a label has; rows with equal keys count as one.  The binomial spread keeps
    the total under ``labels x (per_label + a few standard deviations)``.  Adds the hash as ``h``.
    """
    keys = [keys] if isinstance(keys, str) else keys
    marked = rows.withColumn("h", F.xxhash64(F.lit("even_sample"), *[F.col(k) for k in keys]))
    if not sizes:
        return marked.where(F.lit(False))
    shares = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, per_label / n)])
    place = F.pmod(F.col("h"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return marked.where(place < F.element_at(shares, F.col(label))).dropDuplicates([label, "h"])


def piece(text: str, seed: str, size: int) -> Column:
    """``size`` characters of a text from a place that a hash of the text picks, anywhere in it; a
    shorter text whole."""
    room = F.greatest(F.length(text) - size, F.lit(0)) + 1
    return F.substr(F.col(text), F.lit(1) + F.pmod(F.xxhash64(F.lit(seed), text), room).cast("int"), F.lit(size))


def dictionary(samples: Sequence[bytes], size: int, level: int, trained: bool) -> bytes:
    """Dictionary bytes for one class: trained with entropy tables, or the raw text itself
    (also where there is too little text to train on)."""
    text = b"\n".join(samples)
    if trained and len(samples) >= 8:
        try:
            return zstandard.train_dictionary(min(size, max(256, len(text) // 3)), list(samples), level=level).as_bytes()
        except zstandard.ZstdError:
            pass
    return text[:size]


def compressor(content: bytes, level: int, trained: bool) -> zstandard.ZstdCompressor:
    # A trained dictionary starts with its magic number; raw text is taken as it is.
    kind = zstandard.DICT_TYPE_AUTO if trained else zstandard.DICT_TYPE_RAWCONTENT
    frame = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not content:
        return zstandard.ZstdCompressor(level=level, **frame)
    held = zstandard.ZstdCompressionDict(content, dict_type=kind)
    return zstandard.ZstdCompressor(level=level, dict_data=held, **frame)


def map_texts(docs: DataFrame, text: str, keep: Sequence[Column], schema: str, scorer, rows: int = 500) -> DataFrame:
    """``keep`` columns and the columns that ``scorer()`` - called once a task - returns, as a list of
    arrays, for some texts at a time.

    ``text`` names a column, or as ``struct.field`` a field of a kept one, so that the text is not
    sent to Python twice.
    """
    types = docs.select(*keep).schema
    names, own = list(types.names), "_text"
    while own in names:
        own += "_"
    outer, _, field = text.partition(".")
    inside = names.index(outer) if field and outer in names else None
    kept = docs.select(*keep) if inside is not None else docs.select(*keep, F.col(text).alias(own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer()
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                texts = batch.column(len(names)) if inside is None else pc.struct_field(batch.column(inside), [field])
                made = score(texts)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *made], names=fields)

    added = kept.sparkSession.createDataFrame([], schema).schema
    fields = [*names, *added.names]
    for f in added:
        types = types.add(f)
    return kept.mapInArrow(run, types)
