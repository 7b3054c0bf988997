"""From raw documents to a tokenized training corpus.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last return
the columns of ``docs``.  Rows are told apart by their document id and a hash of their text; a row
without an id gets a negative one from its text, for the time of the stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizops.llm import decontaminate, mixing, quality, simhash, tokenfile
from bizops.llm.scratch import Scratch, ship_package

ID, TEXT = "doc_id", "text"
TOKENIZER = "word_bpe_49k.json"
SHINGLE, RADIUS = 3, 3  # words of a shingle and differing bits of near copies, as in op1

#: SQL has neither the fingerprints nor the classifier; the tests hold the stages against plain code.
ORACLE_SQL = None


def _rows(docs: DataFrame) -> DataFrame:
    """(key, words, text, source, row): id, hash of the text, and the whole row as one column, so no
    other name can clash."""
    words = F.xxhash64(F.coalesce(F.col(TEXT), F.lit("")))
    stand_in = -F.pmod(words, F.lit(1 << 62)) - 1
    source = F.col("source") if "source" in docs.columns else F.lit(None).cast("string")
    return docs.select(
        F.coalesce(F.col(ID).cast("bigint"), stand_in).alias("key"), words.alias("words"), F.col(TEXT).alias("text"),
        source.alias("source"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier (operator 4): documents scored below the threshold go."""
    ship_package(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(_rows(docs).select("key", "row"), model, id_col="key", text=f"row.{TEXT}", keep=["row"])
    return scored.where("predicted = 1").select("row.*")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (operator 1, its shingles of 3 words and 3 bits): of each group the document
    with the smallest id stays, once if its row is repeated."""
    rows = _rows(docs).withColumn("key", F.struct("key", "words"))
    with Scratch(spark, "stage-dedup") as scratch:
        found = simhash.near_duplicates(rows, scratch, id_col="key", shingle=SHINGLE, radius=RADIUS)
        counted = found.groupBy("key").agg(F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
        # Only what differs from "stays as it is": members that go, and rows that are repeated.
        decided = scratch.finish(counted.select(
            F.col("key").alias("_key"), (F.col("key") != F.col("component_id")).alias("_goes")
        ).where("_goes OR n > 1"))
    marked = rows.join(decided, F.col("key") == F.col("_key"), "left")
    once = marked.where("NOT _goes").groupBy("key").agg(F.min_by("row", F.coalesce("text", F.lit(""))).alias("row"))
    return marked.where("_key IS NULL").select("row.*").unionByName(once.select("row.*"))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (operator 7): documents with a benchmark passage go."""
    rows = _rows(docs).withColumn("key", F.concat_ws(":", "key", "words"))
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    with Scratch(spark, "stage-decontaminate") as scratch:
        found = decontaminate.contamination(rows, benchmark, scratch, id_col="key")
        goes = scratch.finish(found.where("contaminated").select(F.col("key").alias("_key")).distinct())
    return rows.join(goes, F.col("key") == F.col("_key"), "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights (operator 9): each document stays as often as the mix takes it."""
    rows = _rows(docs)
    by = [F.col("key").alias("_key"), F.col("words").alias("_words")]
    with Scratch(spark, "stage-mix") as scratch:
        mixed = mixing.mix(rows, scratch, id_col="key", keep=["words"])
        copies = scratch.finish(mixed.groupBy(*by).agg(F.max("copies").cast("int").alias("_copies")))
    taken = rows.join(copies.where("_copies > 0"), (F.col("key") == F.col("_key")) & (F.col("words") == F.col("_words")))
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("_copies")))).select("row.*")


def write_token_file(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-ID output (operator 5): ids in shards, read back through the key index."""
    with Scratch(spark, "stage-tokens") as scratch:
        return scratch.finish(tokenfile.encode_and_read(spark, docs, scratch, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_one_of_each_group),
    ("benchmark decontamination", drop_benchmark_passages),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_token_file),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of one folder, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark, "pipeline") as scratch:
        for number, (_, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if number < len(STAGES) - 1:
                docs = scratch.table(docs, f"stage-{number}")
        return scratch.finish(docs)
