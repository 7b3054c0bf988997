"""The registered queries of the operators, each over the whole tables of one folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizops.llm import (
    decontaminate, importance, language, maxscore, mixing, periodic, quality, secretscan, simhash, tokenfile, tokens,
    urlfilter, warc,
)
from bizops.llm.scratch import Scratch, ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    with Scratch(spark, "simhash") as scratch:
        found = simhash.near_duplicates(table(spark, folder, "documents"), scratch)
        return scratch.finish(
            found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
        )


@query
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, folder, "labels")))


@query
def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document; narrow decisions are marked, not rejected."""
    docs = table(spark, folder, "documents")
    return language.predict(docs, language.fit(docs), reject=False)


@query
def op9_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document."""
    with Scratch(spark, "mix") as scratch:
        return scratch.finish(mixing.mix(table(spark, folder, "documents"), scratch))


@query
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document."""
    with Scratch(spark, "tokens") as scratch:
        counted = tokens.token_counts(
            table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), scratch
        )
        return scratch.finish(counted.withColumn("over_limit", F.col("n_tokens") > 512))


@query
def op5_token_file(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's token ids, written to shards and read back through the key index."""
    with Scratch(spark, "token-file") as scratch:
        return scratch.finish(tokenfile.encode_and_read(
            spark, table(spark, folder, "documents"), scratch, public_tokenizers.path("word_bpe_49k.json")
        ))


@query
def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in every document."""
    with Scratch(spark, "decontaminate") as scratch:
        found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), scratch)
        return scratch.finish(found.select(
            "doc_id", "n_words", "n_hit", "n_items",
            F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
        ))


@query
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page, written to archives and read back from them."""
    with Scratch(spark, "warc") as scratch:
        archives = scratch.path("archives")
        index = warc.write_archives(table(spark, folder, "pages"), archives, scratch)
        found = warc.read_records(index, archives, with_payload=False)
        return scratch.finish(found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


@query
def op6_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector."""
    with Scratch(spark, "top-k") as scratch:
        vectors = table(spark, folder, "embeddings")
        return scratch.finish(maxscore.top_k(vectors, vectors.where(maxscore.divisible("vec_id", 100)), scratch))


@query
def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document."""
    with Scratch(spark, "secrets") as scratch:
        found = secretscan.scan(table(spark, folder, "documents"), scratch)
        count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint")
        listed = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
        return scratch.finish(found.select(
            "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
            F.sha2(listed, 256).alias("base_sha256"), listed.alias("spans"),
        ))


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the contract's periodic tails: where crc32(doc_id) is divisible by 10 and
    the text has words, every word from place a on repeats the p words that start there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    )
    n, g = F.size("words").cast("bigint"), F.floor(F.col("h") / 10)
    a = F.pmod(g, n)
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
    placed = chosen.withColumns({"n": n, "a": F.when(n > 0, a).cast("int"), "p": F.when(n > 0, p).cast("int")})
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    changed = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), (F.col("n") - F.col("a")).cast("int")))
    return placed.select("doc_id", F.when(F.col("n") > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in every document, and the document without their repetitions."""
    found = periodic.find_runs(planted(table(spark, folder, "documents")))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Weight, score and rank of every document when resampled towards the benchmark's words."""
    with Scratch(spark, "importance") as scratch:
        drawn = importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"), scratch)
        return scratch.finish(drawn.select("doc_id", "n_features", "weight", "score", "rank"))


@query
def op13_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict of every page's URL: the given rules', else the mined ones'."""
    with Scratch(spark, "url-filter") as scratch:
        return scratch.finish(urlfilter.judge(table(spark, folder, "pages"), scratch).drop("antecedent"))
