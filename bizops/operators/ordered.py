"""Exact global ranks, running totals and percentiles without a single-partition window.

``orderBy`` range-partitions the rows by sampled bounds; because the keys end in a unique
tie-break, a value shared by a third of the rows still spreads over many partitions.  A row's
number inside its partition comes from ``monotonically_increasing_id`` and the sorted rows are
checkpointed once, so the sampled bounds can never move between two readers.  What remains is one
row of totals per partition: those few rows give each partition its starting point.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bizops.session import cut_lineage

_SLOT = "_slot"
_PART = "_part"
_LOCAL_BITS = 33  # monotonically_increasing_id: partition above, row within partition below


def with_order(df: DataFrame, order: Sequence[Column | str], value: str | None = None) -> DataFrame:
    """Number the rows by ``order``, which must be a total order (end it in a unique key).

    Adds ``rank`` (from 1) and ``total_rows``; with ``value`` also ``running`` (sum of ``value`` up
    to and including the row) and ``grand_total``.  Runs the sort eagerly.
    """
    placed = cut_lineage(df.orderBy(*order).withColumn(_SLOT, F.monotonically_increasing_id()))
    placed = placed.withColumn(_PART, F.shiftright(F.col(_SLOT), _LOCAL_BITS))

    sums = [F.count(F.lit(1)).alias("_rows")]
    if value:
        sums.append(F.sum(value).alias("_sum"))
    # One row per sort partition, so these plain windows and the broadcast are bounded by the
    # number of shuffle partitions, whatever the data.
    before = W.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    starts = [
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_rows").over(everything).alias("total_rows"),
    ]
    if value:
        starts += [
            F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"),
            F.sum("_sum").over(everything).alias("grand_total"),
        ]
    offsets = placed.groupBy(_PART).agg(*sums).select(_PART, *starts)

    if value:
        # A sort partition holds a bounded, sampled share of the rows, never a hot key's whole group.
        inside = W.partitionBy(_PART).orderBy(_SLOT).rowsBetween(W.unboundedPreceding, W.currentRow)
        placed = placed.withColumn("_inside", F.sum(value).over(inside))
    located = placed.join(F.broadcast(offsets), _PART)

    row_in_part = F.col(_SLOT).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    out = [*df.columns, (row_in_part + F.col("_rows_before") + 1).alias("rank"), "total_rows"]
    if value:
        out += [(F.col("_inside") + F.col("_sum_before")).alias("running"), "grand_total"]
    return located.select(*out)


def percentiles(df: DataFrame, col: str, points: dict[str, float]) -> DataFrame:
    """Exact linear-interpolation percentiles as one row, one column per named point.

    Works on the histogram of ``col``; the positions are found on its distributed running count,
    so no task ever holds the column's distinct values.
    """
    histogram = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    counted = with_order(histogram, [col], value="_n").withColumn("_first", F.col("running") - F.col("_n"))

    def value_at(position: Column) -> Column:
        covers = (F.col("_first") <= position) & (position < F.col("running"))
        return F.max(F.when(covers, F.col(col).cast("double")))

    found, out = [], []
    for name, p in points.items():
        position = F.lit(p) * (F.col("grand_total") - 1)
        low = F.floor(position)
        found += [
            value_at(low).alias(f"_{name}_low"),
            value_at(F.ceil(position)).alias(f"_{name}_high"),
            F.max(position - low).alias(f"_{name}_part"),
        ]
        spread = F.col(f"_{name}_high") - F.col(f"_{name}_low")
        out.append((F.col(f"_{name}_low") + spread * F.col(f"_{name}_part")).alias(name))
    return counted.agg(*found).select(*out)


def percentiles_by(df: DataFrame, by: str, col: str, points: dict[str, float]) -> DataFrame:
    """Exact linear-interpolation percentiles of every group: ``by`` and a column per named point.

    Works on the counts of each (group, value); one distributed running count over all of them
    places every value inside its group, so a group of any size is spread over the tasks.  Null values
    are left out, a null group is a group.
    """
    histogram = df.where(F.col(col).isNotNull()).groupBy(by, col).agg(F.count(F.lit(1)).alias("_n"))
    counted = with_order(histogram, [by, col], value="_n").select(
        F.col(by).alias("_group"), F.col(col).cast("double").alias("_value"), (F.col("running") - F.col("_n")).alias("_first"), "running")
    groups = counted.groupBy(F.col("_group").alias(by)).agg(F.min("_first").alias("_start"), F.max("running").alias("_end"))
    placed = counted.join(groups, F.col("_group").eqNullSafe(F.col(by)))
    found, out = [], []
    for name, p in points.items():
        position = F.lit(p) * (F.col("_end") - F.col("_start") - 1)
        low = F.floor(position)
        for side, at in (("low", low), ("high", F.ceil(position))):
            covers = (F.col("_first") <= F.col("_start") + at) & (F.col("_start") + at < F.col("running"))
            found.append(F.max(F.when(covers, F.col("_value"))).alias(f"_{name}_{side}"))
        found.append(F.max(position - low).alias(f"_{name}_part"))
        spread = F.col(f"_{name}_high") - F.col(f"_{name}_low")
        out.append((F.col(f"_{name}_low") + spread * F.col(f"_{name}_part")).alias(name))
    return placed.groupBy(by).agg(*found).select(by, *out)


def _rows_at(ordered: DataFrame, ranks: Sequence[int], names: Sequence[str]) -> dict:
    """The rows of some ranks, as one row of structs."""
    kept = F.struct(*names, "_key")
    row = ordered.where(F.col("rank").isin(list(ranks))).agg(*[
        F.any_value(F.when(F.col("rank") == r, kept), True).alias(f"_{r}") for r in set(ranks)
    ]).first()
    return {r: row[f"_{r}"] for r in ranks}


class Place(NamedTuple):
    """The row of a rank: its value and its tie-break key."""

    value: object
    key: object


ACCURACY = 10_000  # the brackets below are off by no more than this part of the rows
IN_TASK = 100_000  # rows of a bracket that one task may put in order


def at_ranks(
    df: DataFrame, measures: Mapping[str, Column], key: str, ranks: Callable[[int], Sequence[int]], accuracy: int = ACCURACY
) -> dict[str, list[Place]]:
    """For every measure, the rows at some ranks (from 1) of the order (measure, key), null measures
    first; ``key`` is unique and not null.  ``ranks`` gives the ranks for a number of rows.

    Only cut points are selected, so nothing is sorted whole: approximate percentiles, which merge
    on the map side, bracket each wanted rank; exact counts below the brackets say which row of a
    bracket is meant, and only the rows inside brackets - a few thousandths, and values that many
    rows share - are put in order.  Should a bracket miss its rank, or a rank
    fall among nulls, that measure is ordered whole.
    """
    names = list(measures)
    rows = df.select(*[measures[m].alias(m) for m in names], F.col(key).alias("_key"))
    n = rows.count()
    wanted = list(ranks(n)) if n else []
    if not wanted:
        return {m: [] for m in names}
    share = lambda r, by: min(1.0, max(0.0, r / n + by))
    points = [[share(r, by) for r in wanted] for by in (-2 / accuracy, 2 / accuracy)]
    near = rows.agg(*[F.percentile_approx(m, points[0] + points[1], accuracy).alias(m) for m in names]).first()
    kinds = {f.name: f.dataType for f in rows.schema}
    brackets = {
        (m, i): (F.lit(low).cast(kinds[m]), F.lit(high).cast(kinds[m]))
        for m in names if near[m] is not None
        for i, (low, high) in enumerate(zip(near[m][: len(wanted)], near[m][len(wanted) :]))
    }
    inside = {b: (F.col(b[0]) >= low) & (F.col(b[0]) <= high) for b, (low, high) in brackets.items()}
    below = {b: F.col(b[0]).isNull() | (F.col(b[0]) < low) for b, (low, _) in brackets.items()}
    counts = rows.agg(
        *[F.count_if(c).alias(f"in_{m}_{i}") for (m, i), c in inside.items()],
        *[F.count_if(c).alias(f"before_{m}_{i}") for (m, i), c in below.items()],
        F.lit(n).alias("_n"),
    ).first()
    slots, whole = [], set()
    for m in names:
        for i, r in enumerate(wanted):
            known = (m, i) in brackets
            place = r - counts[f"before_{m}_{i}"] if known else 0
            if known and 1 <= place <= counts[f"in_{m}_{i}"]:
                slots.append((m, i, place))
            else:
                whole.add(m)
    found: dict[tuple[str, int], Place] = {}
    # One table of the brackets' rows: each measure has a column of its own, filled in its slots only.
    # The exact counts say how large a bracket is.  Those that a task can hold are ranked by a window, a
    # task each; the others, where very many rows share a value, by a distributed sort.
    slots = [s for s in slots if s[0] not in whole]
    small = [s for s in slots if counts[f"in_{s[0]}_{s[1]}"] <= IN_TASK]

    def bracketed(some: list) -> DataFrame:
        copies = F.array(*[
            F.when(inside[m, i], F.struct(
                F.lit(number).alias("slot"), *[(F.col(o) if o == m else F.lit(None).cast(kinds[o])).alias(o) for o in names]
            )) for number, (m, i, _) in enumerate(some)
        ])
        return rows.select("_key", F.explode(F.array_compact(copies)).alias("_c")).select("_key", "_c.*")

    if small:
        picks = {number * (IN_TASK + 1) + place: (m, i) for number, (m, i, place) in enumerate(small)}
        nth = F.row_number().over(W.partitionBy("slot").orderBy(*names, "_key"))
        placed = _rows_at(bracketed(small).withColumn("rank", F.col("slot") * (IN_TASK + 1) + nth), list(picks), names)
        found |= {(m, i): Place(placed[r][m], placed[r]["_key"]) for r, (m, i) in picks.items()}
    large = [s for s in slots if s not in small]
    if large:
        start, picks = 0, {}
        for m, i, place in large:
            picks[start + place] = (m, i)
            start += counts[f"in_{m}_{i}"]
        placed = _rows_at(with_order(bracketed(large), ["slot", *names, "_key"]), list(picks), names)
        found |= {(m, i): Place(placed[r][m], placed[r]["_key"]) for r, (m, i) in picks.items()}
    for m in whole:
        placed = _rows_at(with_order(rows.select(m, "_key"), [m, "_key"]), wanted, [m])
        found |= {(m, i): Place(placed[r][m], placed[r]["_key"]) for i, r in enumerate(wanted)}
    return {m: [found[m, i] for i in range(len(wanted))] for m in names}
