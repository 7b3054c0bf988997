"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Every source gets a target number of words.  Documents are first taken in certain whole copies
(as often as the target holds the whole source).  The rest comes from a Pareto sample with inclusion
probabilities in proportion to size: a document whose probability would reach 1 is certain, and
each other one draws a random number u and ranks by the odds of u divided by the odds of its
probability.  In that order documents are taken as long as they fit what is left of the target, and one
last document may close the gap from above.

The order of a source is never gathered in one task.  Ranking values fall into 1,024 bins and,
inside the one bin in which the target is reached, into 1,024 finer ones; the bins' word sums
locate that point, and only the documents of one fine bin are put in order.  Where a document does
not fit, the next round goes on with those that are small enough.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bizops.llm.scratch import Scratch
from bizops.operators.ordered import with_order

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BINS = 1024
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(key: Column, digest: Column, seed: int) -> Column:
    """A number inside (0, 1) fixed by the key, a digest of the text and the seed: 52 bits of an MD5."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null")), digest).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def source_targets(sizes: DataFrame, scratch: Scratch, weights: Sequence[float] = WEIGHTS,
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, weight, target) for a table (source, source_size).

    Weights repeat along the sources in code-point order, null last.  The targets share the sum of
    all sizes by weight; one that exceeds ``max_copies`` times its source stops there, and the
    excess is shared again until none exceeds.  Each round is one sum over the sources.
    """
    ranked = with_order(sizes, [F.col("source").isNull(), F.col("source")])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    table = scratch.table(ranked.select("source", "source_size", weight.alias("weight")), "sources")
    limit = F.col("source_size") * float(max_copies)
    total, shares = table.agg(F.sum("source_size"), F.sum("weight")).first()
    total, level, stopped = total or 0, (total or 0) / (shares or 1), -1
    while True:
        over = limit < F.lit(level) * F.col("weight")
        n, held, free = table.agg(
            F.count_if(over), F.sum(F.when(over, limit).otherwise(0.0)), F.sum(F.when(~over, F.col("weight")).otherwise(0.0))
        ).first()
        if n == stopped or not free:
            break
        stopped, level = n, (total - held) / free
    return table.withColumn("target", F.round(F.least(limit, F.lit(level) * F.col("weight")), 6))


def inclusion(histogram: DataFrame) -> DataFrame:
    """(_s, _c, _cut, _certain) from rows (_s, size, n, _rest), one for each size of a source.

    The inclusion probability of a document is ``_c`` times its size; sizes above ``_cut`` would
    reach 1, so they are certain, ``_certain`` words in all.  Going down the sizes, the first that stays
    below 1 when all larger ones are certain is the cut.  A source has one row per different size here.
    """
    larger = W.partitionBy("_s").orderBy(F.col("size").desc()).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("_s")
    square = F.col("n") * F.col("size") * F.col("size")
    tried = histogram.where("size > 0 AND _rest > 0").withColumns({
        "_certain": F.coalesce(F.sum(F.col("n") * F.col("size")).over(larger), F.lit(0)),
        "_squares": F.sum(square).over(whole) - F.coalesce(F.sum(square).over(larger), F.lit(0)),
    }).withColumn("_c", (F.col("_rest") - F.col("_certain")) / F.col("_squares"))
    below = tried.where(F.col("_c") * F.col("size") < 1)
    return below.groupBy("_s").agg(F.max(F.struct("size", "_c", "_certain")).alias("_m")).select(
        "_s", F.col("_m._c").alias("_c"), F.col("_m.size").alias("_cut"), F.col("_m._certain").alias("_certain"))


def _crossing(sums: DataFrame, part: str) -> DataFrame:
    """(source, bin, words before it) of the first ``part`` in which the words exceed ``_left``.

    A source has at most ``BINS`` rows here."""
    before = F.coalesce(
        F.sum("n").over(W.partitionBy("_s").orderBy(part).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    found = sums.withColumn("_before", before).where(F.col("_before") + F.col("n") > F.col("_left"))
    return found.groupBy("_s").agg(F.min(part).alias(f"_at_{part}"), F.min("_before").alias(f"_before_{part}"))


def _fit(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """One round: of the documents not taken (``_in`` false) that are no larger than what is left
    of their source's target (``_gap``), those in rank order up to the first that no longer fits."""
    ready = ~F.col("_in") & F.col("_q").isNotNull() & (F.col("size") > 0) & (F.col("size") <= F.col("_gap"))
    drawn = rows.where(ready)
    coarse = _crossing(drawn.groupBy("_s", "_bin").agg(F.sum("size").alias("n"), F.max("_gap").alias("_left")), "_bin")
    inside = drawn.join(coarse, "_s").where("_bin = _at__bin")
    fine = _crossing(inside.groupBy("_s", "_fine").agg(
        F.sum("size").alias("n"), F.max(F.col("_gap") - F.col("_before__bin")).alias("_left")), "_fine")
    cuts = scratch.table(coarse.join(fine, "_s", "left"), "cuts").withColumnRenamed("_s", "_of")
    placed = rows.join(cuts, F.col("_s") == F.col("_of"), "left").withColumn("_ready", ready)
    at_bin, at_fine = F.col("_bin") == F.col("_at__bin"), F.col("_fine") == F.col("_at__fine")
    # Without a cut all that are ready fit.
    below = F.col("_of").isNull() | (F.col("_bin") < F.col("_at__bin")) | (at_bin & (F.col("_fine") < F.col("_at__fine")))
    on_edge = F.col("_ready") & F.coalesce(at_bin & at_fine, F.lit(False))
    # The documents of one fine bin of each source: a millionth of a source, give or take.
    order = W.partitionBy("_s").orderBy("_q", "_id", "_digest", "_row").rowsBetween(W.unboundedPreceding, W.currentRow)
    upto = F.sum("size").over(order) + F.col("_before__bin") + F.col("_before__fine")
    edge = placed.where(on_edge).withColumn("_new", upto <= F.col("_gap"))
    rest = placed.where(~on_edge).withColumn("_new", F.col("_ready") & F.coalesce(below, F.lit(False)))
    columns = [c for c in rows.columns if c not in ("_in", "_gap")]
    taken = scratch.table(rest.unionByName(edge).select(*columns, "_gap", (F.col("_in") | F.col("_new")).alias("_in"), "_new"), "taken")
    return _with_gaps(taken, scratch, columns)


def _with_gaps(taken: DataFrame, scratch: Scratch, columns: Sequence[str]) -> DataFrame:
    """What is left of each source's target after its new documents, beside every row."""
    gaps = scratch.table(taken.groupBy(F.col("_s").alias("_of")).agg(
        (F.max("_gap") - F.sum(F.when(F.col("_new"), F.col("size")).otherwise(0))).alias("_less")), "gaps")
    return taken.join(gaps, F.col("_s") == F.col("_of")).select(*columns, "_in", F.col("_less").alias("_gap"))


def mix(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = 42,
        keep: Sequence[str] = ()) -> DataFrame:
    """Id, ``keep`` columns, size, source_size, target, copies and taken (size x copies) per row.

    A null text has size 0; a null source is a source of its own, the last in order.  The sampled
    documents never pass the target, nothing that still fits is left out, and one closing document
    is added where it narrows what is left.  The draw depends on the id, the text and the seed alone, so
    reruns agree; rows that repeat in both draw equal numbers and are told apart only to close with
    one of them.  Sources of size 0 get target 0, an empty table gives no rows.
    """
    digest = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(source).alias("_source"), words(text).alias("size"), digest.alias("_digest"),
        F.monotonically_increasing_id().alias("_row"), *[F.col(k).alias(f"_keep_{k}") for k in keep],
    ).withColumn("_u", uniform(F.col("_id"), F.col("_digest"), seed))
    # A source's hash stands for it in the joins below: fixed width, and never null.
    rows = scratch.table(rows.withColumn("_s", F.concat_ws(":", F.col("_source").isNull(), F.sha2(F.coalesce("_source", F.lit("")), 256))), "sizes")
    histogram = scratch.table(rows.groupBy("_s", F.col("_source").alias("source"), "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    sizes = histogram.groupBy("_s", "source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = source_targets(sizes.drop("_s"), scratch, weights, max_copies).join(
        sizes.select("_s", F.col("source").alias("_source")), F.col("source").eqNullSafe(F.col("_source"))
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = scratch.table(
        targets.withColumn("_whole", whole.cast("bigint"))
        .withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size"))
        .select("_s", "source_size", "target", "_whole", "_rest"), "plan",
    )
    chances = scratch.table(inclusion(histogram.join(plan.select("_s", "_rest"), "_s")), "chances").withColumnRenamed("_s", "_of")
    joined = rows.join(plan, "_s").join(chances, F.col("_s") == F.col("_of"), "left")
    certain = F.coalesce(F.col("size") > F.col("_cut"), F.lit(False))
    chance = F.col("_c") * F.col("size")
    pareto = F.when((chance > 0) & (chance < 1) & ~certain, (F.col("_u") / (1 - F.col("_u"))) / (chance / (1 - chance)))
    ranked = joined.withColumns({"_q": pareto, "_in": certain, "_gap": F.coalesce(F.col("_rest") - F.col("_certain"), F.lit(0.0))})
    place = F.col("_q") / (1 + F.col("_q")) * BINS  # even odds lie in the middle
    state = scratch.table(ranked.withColumn("_bin", F.floor(place).cast("int")).withColumn(
        "_fine", F.floor((place - F.floor(place)) * BINS).cast("int")
    ).drop("_of", "_c", "_cut", "_certain", "_source", "_rest", "_u"), "ranked")
    # Every round ends with a smaller gap than the document that did not fit, so the rounds are few.
    fits = "NOT _in AND _q IS NOT NULL AND size > 0 AND size <= _gap"
    while not state.where(fits).isEmpty():
        state = scratch.table(_fit(state, scratch), "round")

    # What is left is smaller than every document; the one whose size comes nearest closes the gap, if
    # that narrows it (lowest rank first).  One row per source, written so that its size is known.
    distance = F.abs(F.col("_gap") - F.col("size"))
    closing = scratch.table(
        state.where("NOT _in AND _q IS NOT NULL AND size > 0").where(distance < F.col("_gap"))
        .groupBy(F.col("_s").alias("_close"))
        .agg(F.min(F.struct(distance.alias("d"), "_q", "_id", "_digest", "_row")).alias("_best")), "closing",
    )
    done = state.join(closing, F.col("_s") == F.col("_close"), "left")
    extra = (F.col("_in") | F.coalesce(F.col("_best._row") == F.col("_row"), F.lit(False))).cast("bigint")
    copies = F.col("_whole") + extra
    return done.select(
        F.col("_id").alias(id_col), *[F.col(f"_keep_{k}").alias(k) for k in keep], "size", "source_size", "target",
        copies.alias("copies"), (F.col("size") * copies).alias("taken"),
    )
