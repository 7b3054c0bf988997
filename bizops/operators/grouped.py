"""Several groupings of one fact from a single pass, and distinct counts that can be merged.

A distinct count of whole-number ids is kept as words of 64 bits: one row per group and block of 64
neighbouring ids, with a bit for each id that occurs.  Words are combined on the map side, they
merge by OR over any coarser group (months to years, stores to regions), and counting them needs no
second look at the fact and no copy of its rows for each count.  Ids of other types are a word each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from bizops.session import cut_lineage

_SET = "_set"


def id_word(df: DataFrame, col: str) -> tuple[Column, Column]:
    """(block, bit) of an id: the block to group by, and the bit to combine with ``bit_or``.

    A null id has no bit, so it is not counted.
    """
    if isinstance(df.schema[col].dataType, IntegralType):
        block = F.shiftright(F.col(col).cast("bigint"), 6)
        return block, F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.col(col), F.lit(64)).cast("int"))
    return F.col(col), F.when(F.col(col).isNotNull(), F.lit(1).cast("bigint"))


def count_bits(bits: str) -> Column:
    """Number of distinct ids in the words of a group."""
    return F.coalesce(F.sum(F.bit_count(bits)), F.lit(0)).cast("bigint")


_LOW = 20  # bits of the lower part of a whole number that is summed in two parts


def total(col: Column | str, scale: int | None = None) -> Column:
    """Sum of a column; with ``scale`` the column holds whole units of ``10^-scale``, and the sum is
    an exact decimal with that scale.

    Whole units are summed as machine words, in a high and a low part, which is many times faster
    than decimals and cannot overflow before a trillion rows or so.
    """
    col = F.col(col) if isinstance(col, str) else col
    if scale is None:
        return F.sum(col)
    high, low = F.sum(F.shiftright(col, _LOW)), F.sum(col.bitwiseAND(F.lit((1 << _LOW) - 1)))
    units = high.cast("decimal(31,0)") * F.lit(1 << _LOW).cast("decimal(7,0)") + low.cast("decimal(31,0)")
    return units * F.lit(f"0.{'1'.zfill(scale)}").cast(f"decimal({scale},{scale})") if scale else units


def grouped_once(df: DataFrame, sets: Mapping[str, Sequence[str]], *aggs: Column) -> dict[str, DataFrame]:
    """The same aggregates for several sets of key columns, from one read of ``df``.

    Every set is one grouping of GROUPING SETS: rows are combined on the map side, where a hot key
    becomes one row per task, before anything is shuffled.  The result is written once, so its
    readers never touch ``df`` again.  Each named table has the keys of its set and the aggregates.
    """
    keys = list(dict.fromkeys(k for names in sets.values() for k in names))
    grouped = df.groupingSets([[F.col(k) for k in names] for names in sets.values()], *[F.col(k) for k in keys])
    made = cut_lineage(grouped.agg(F.grouping_id().alias(_SET), *aggs))
    values = [c for c in made.columns if c not in keys and c != _SET]
    number = lambda names: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in names)
    return {name: made.where(F.col(_SET) == number(names)).select(*names, *values) for name, names in sets.items()}


def visits(sales: DataFrame, key: str, scales: Mapping[str, int] = {}) -> DataFrame:
    """Distinct ``customers`` and ``tickets``, ``_revenue`` and ``_margin`` of sale lines by ``key``.

    The joined lines go to a given number of tasks, so that adaptive execution does not merge them by their
    packed size again and the sums do not share a task's memory with the sorts of the joins before them.
    The lines that a key has in one block of tickets are in one task.  The two distinct counts expand the
    customers of such a block, not lines, and what they shuffle are words of bits.
    """
    tasks = int(sales.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    money = ("revenue", "margin")
    block, bit = id_word(sales, "ticket_id")
    tickets = sales.withColumns({"_block": block, "_bit": bit}).repartition(tasks, key, "_block").groupBy(key, "_block", "customer_id").agg(
        F.bit_or("_bit").alias("_tickets"), *[total(c, scales.get(c)).alias(f"_{c}") for c in money])
    customers, customer = id_word(sales, "customer_id")
    marked = tickets.withColumns({"_customers": customers, "_seen": customer})
    words = marked.groupingSets(
        [[F.col(key), F.col("_block")], [F.col(key), F.col("_customers")]], F.col(key), F.col("_block"), F.col("_customers")
    ).agg((F.grouping("_block") == 0).alias("_of_block"), *[F.bit_or(c).alias(c) for c in ("_tickets", "_seen")], *[F.sum(f"_{c}").alias(f"_{c}") for c in money])
    of_block = [F.when(F.col("_of_block"), F.col(c)).alias(c) for c in ("_tickets", *[f"_{c}" for c in money])]
    return words.select(key, *of_block, F.when(~F.col("_of_block"), F.col("_seen")).alias("_seen")).groupBy(key).agg(
        count_bits("_seen").alias("customers"), count_bits("_tickets").alias("tickets"), *[F.sum(f"_{c}").alias(f"_{c}") for c in money])
