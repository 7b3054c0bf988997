"""URL verdicts from given rules and, where none fits, from mined association rules.

A given rule holds for a host with all its subdomains and a beginning of the path; the longest
one wins.  URLs that such rules judge are labelled examples.  Combinations of URL tokens that go
with a verdict, found size by size, become rules if they have enough support and confidence and no
part of them says the same with no less confidence.  A URL is
matched through an inverted index: every mined rule is posted under its rarest token, the tokens of
a URL look their postings up, and the combinations found there are checked.

Everything is DataFrame and SQL functions; URLs that have the same rule tokens are judged once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizops.llm.scratch import Scratch

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


#: The rules of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
SUPPORT = 0.02  # share of the labelled URLs that a mined combination must be part of, with its verdict
CONFIDENCE = 0.8  # share of a combination's URLs that must have the verdict
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_COUNTS = ("whole", ALLOW, BLOCK)  # URLs that hold a combination: all, and those with each verdict


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and path of a URL; both empty if it is null or has no "://"."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as struct(size, rule, verdict), or null.

    Rules are looked up under each of the host's own suffixes.  Of equally long rules the last in
    order of text, then of verdict, wins, so a block beats an allow of the same text.
    """
    kind = "struct<size:int,rule:string,verdict:string,path:string>"
    by_host: dict[str, list[Rule]] = {}
    for r in rules:
        by_host.setdefault(r.host, []).append(r)
    if not by_host:
        return F.lit(None).cast(kind)
    entries = [
        (F.lit(name), F.array(*[
            F.struct(F.lit(len(r.host) + len(r.path)).alias("size"), F.lit(r.host + r.path).alias("rule"),
                     F.lit(r.verdict).alias("verdict"), F.lit(r.path).alias("path"))
            for r in found
        ]))
        for name, found in by_host.items()
    ]
    index = F.create_map(*[x for entry in entries for x in entry])
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    posted = F.flatten(F.transform(suffixes, lambda s: F.coalesce(F.element_at(index, s), F.array().cast(f"array<{kind}>"))))
    return F.array_max(F.filter(posted, lambda r: F.startswith(path, r["path"])))


def tokens(url: Column) -> Column:
    """The distinct tokens of a whole URL: host labels, words of the path, of the query and of the
    fragment, each marked with where it stands.  Null URLs have none."""
    host, path = host_and_path(url)
    text = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(text, r"(?s)^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(text, r"(?s)^[^#]*#(.*)$", 1)

    def marked(mark: str, part: Column, cut: str) -> Column:
        words = F.filter(F.split(F.translate(part, _UPPER, _LOWER), cut), lambda w: w != "")
        return F.transform(words, lambda w: F.concat(F.lit(mark), w))

    words = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return F.array_distinct(F.concat(
        marked("h:", host, r"\."), marked("p:", path, words), marked("q:", query, words), marked("f:", fragment, words)
    ))


def mine(labelled: DataFrame, scratch: Scratch, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Mined rules (antecedent, verdict, confidence, support, key) from rows (tokens, verdict).

    ``key`` is the antecedent's rarest token, under which the index posts the rule.  Tokens below the
    support cannot be part of a rule and are left out before mining; all others are combined, however
    many a URL has.  Rows with a null verdict or without tokens teach nothing; without any rows
    there are no rules.
    """
    empty = "antecedent array<string>, verdict string, confidence double, support double, key string"
    spark = labelled.sparkSession
    rows = scratch.table(labelled.where("verdict IS NOT NULL AND size(tokens) > 0").select("tokens", "verdict"), "labelled")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], empty)
    seen = rows.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    # At most (tokens of a URL) / support rows: the frequent tokens.
    frequent = [r for r in seen.where(F.col("n") >= F.lit(support) * n).collect()]
    if not frequent:
        return spark.createDataFrame([], empty)
    # Items are the places of tokens in this list, so the first item of a combination is its rarest token.
    order = F.array(*[F.lit(r["token"]) for r in sorted(frequent, key=lambda r: (r["n"], r["token"]))])
    # array_intersect keeps the order of its first argument.  URLs with the same tokens are one row.
    alike = rows.select(F.array_intersect(order, "tokens").alias("held"), "verdict").where(F.size("held") > 0).groupBy("held").agg(
        F.count(F.lit(1)).alias("whole"), *[F.count_if(F.col("verdict") == v).alias(v) for v in (ALLOW, BLOCK)])
    baskets = scratch.table(alike.select(
        F.transform("held", lambda t: F.array_position(order, t).cast("int")).alias("items"), *_COUNTS), "baskets")
    combinations = _telling(baskets, scratch, max(support * n, 1))
    verdicts = F.array(*[
        F.struct(F.lit(v).alias("verdict"), F.col(v).alias("good"), F.col(f"{v}_part").alias("part")) for v in (ALLOW, BLOCK)])
    share = F.col("good") / F.col("whole")
    found = combinations.select("combo", "whole", F.inline(verdicts)).where(
        (F.col("good") >= F.lit(support) * n) & (share >= confidence) & (F.col("part").isNull() | (F.col("part") < share)))
    return scratch.table(found.select(
        F.array_sort(F.transform("combo", lambda i: F.element_at(order, i))).alias("antecedent"), "verdict",
        share.alias("confidence"), (F.col("good") / n).alias("support"), F.element_at(order, F.col("combo")[0]).alias("key"),
    ), "rules")


def _telling(baskets: DataFrame, scratch: Scratch, least: float) -> DataFrame:
    """All combinations of items that can be rules, with their counts and, by verdict, the greatest share
    that a part with one item less has (null without such parts).

    ``baskets`` are rows (items, whole, allow, block), items ascending.  A rule needs ``least`` URLs of its
    verdict and a greater share than each of its parts.  So it has no part that stands for the same URLs as
    a smaller part, none whose URLs all have one verdict, and none that is rarer than ``least``; only
    combinations without such parts are made, each size from the one before.  A group of URLs that share many
    tokens therefore ends with their pairs, whereas all combinations would be 2^tokens.
    """
    totals = [F.sum(c).alias(c) for c in _COUNTS]
    enough = F.greatest(ALLOW, BLOCK) >= least
    mixed = enough & (F.greatest(ALLOW, BLOCK) < F.col("whole"))
    none = F.lit(None).cast("double")
    single = baskets.select(F.explode("items").alias("item"), *_COUNTS).groupBy(F.array("item").alias("combo")).agg(*totals)
    level = scratch.table(single.where(enough).select("combo", *_COUNTS, *[none.alias(f"{v}_part") for v in (ALLOW, BLOCK)]), "size")
    levels = [level]
    held = baskets.select(F.explode("items").alias("first"), "items", *_COUNTS)
    size = 1
    while not (parts := level.where(mixed)).isEmpty():
        size += 1
        head, last = F.slice("combo", 1, size - 2).alias("head"), F.element_at("combo", -1)
        pairs = parts.select(head, last.alias("a")).join(parts.select(head, last.alias("b")), "head").where("a < b")
        made = pairs.select(F.concat("head", F.array("a", "b")).alias("combo"))
        without = F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: F.concat(F.slice("combo", F.lit(1), i - 1), F.slice("combo", i + 1, F.lit(size))))
        known = parts.select(F.col("combo").alias("part"), F.col("whole").alias("_whole"), *[(F.col(v) / F.col("whole")).alias(f"_{v}") for v in (ALLOW, BLOCK)])
        bounds = made.select("combo", F.explode(without).alias("part")).join(known, "part").groupBy("combo").agg(
            F.count(F.lit(1)).alias("_parts"), F.min("_whole").alias("_whole"), *[F.max(f"_{v}").alias(f"{v}_part") for v in (ALLOW, BLOCK)])
        tried = scratch.table(bounds.where(F.col("_parts") == size).drop("_parts").withColumn("first", F.col("combo")[0]), "tried")
        counts = held.join(tried.select("first", "combo"), "first").where(F.size(F.array_except("combo", "items")) == 0).groupBy("combo").agg(*totals)
        level = scratch.table(counts.where(enough).join(tried, "combo").where("whole < _whole").select(
            "combo", *_COUNTS, *[f"{v}_part" for v in (ALLOW, BLOCK)]), "size")
        levels.append(level)
    return reduce(DataFrame.unionByName, levels)


def matched(signatures: DataFrame, rules: DataFrame) -> DataFrame:
    """(signature, verdict, confidence, antecedent) of the best mined rule for each array of tokens
    that some rule fits: highest confidence, then support, then most tokens; a block beats an equal
    allow."""
    probes = signatures.select("signature", F.explode("signature").alias("key"))
    candidates = probes.join(rules, "key").where(F.size(F.array_except("antecedent", "signature")) == 0)
    best = F.max(F.struct("confidence", "support", F.size("antecedent").alias("n"), "verdict", "antecedent"))
    return candidates.groupBy("signature").agg(best.alias("_best")).select(
        F.col("signature"), F.col("_best.verdict").alias("mined_verdict"), F.col("_best.confidence").alias("confidence"),
        F.col("_best.antecedent").alias("antecedent"),
    )


def judge(pages: DataFrame, scratch: Scratch, rules: Sequence[Rule] = RULES, id_col: str = "page_id", url: str = "url",
          support: float = SUPPORT, confidence: float = CONFIDENCE, default: str = ALLOW) -> DataFrame:
    """Id, host, path, rule (text of the given rule or null), verdict, ``antecedent`` and ``confidence`` (of
    the mined rule, where one decided) for every row.

    Given rules decide first; the rows they decide are the examples for mining.  URLs without
    either get ``default``.  A null URL, or one without "://", has an empty host and path and gets
    what its other words get; without any, the default.  Repeated rows get equal answers, a null id
    is carried along, an empty table gives no rows.  Only the id and URL columns are read.
    """
    host, path = host_and_path(F.col("_url"))
    parsed = pages.select(F.col(id_col).alias("_id"), F.col(url).cast("string").alias("_url")).withColumns({"host": host, "path": path})
    given = parsed.withColumn("_given", fitting_rule(F.col("host"), F.col("path"), rules))
    rows = scratch.table(given.select(
        "_id", "host", "path", F.col("_given.rule").alias("rule"), F.col("_given.verdict").alias("_verdict"), tokens(F.col("_url")).alias("_tokens")
    ), "urls")
    mined = mine(rows.select(F.col("_tokens").alias("tokens"), F.col("_verdict").alias("verdict")), scratch, support, confidence)
    # Tokens outside every mined rule change no answer; there are at most as many inside as frequent ones.
    inside = [r[0] for r in mined.select(F.explode("antecedent")).distinct().collect()]
    held = F.array(*[F.lit(t) for t in sorted(inside)]).cast("array<string>")
    marked = rows.withColumn("_signature", F.when(F.col("_verdict").isNull(), F.array_intersect(held, F.col("_tokens"))))
    open_ = marked.where("_signature IS NOT NULL AND size(_signature) > 0").select(F.col("_signature").alias("signature")).distinct()
    answers = scratch.table(matched(open_, mined), "answers").withColumnRenamed("signature", "_answered")
    done = marked.join(answers, F.col("_signature") == F.col("_answered"), "left")
    return done.select(
        F.col("_id").alias(id_col), "host", "path", "rule",
        F.coalesce("_verdict", "mined_verdict", F.lit(default)).alias("verdict"), "antecedent", "confidence",
    )
