"""Secret scan with a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean trigram query is derived: alternatives, each a set
of trigrams that a match cannot do without.  The index holds, for every trigram that some rule
names, the documents that contain it in either case.  Intersecting the postings gives each rule's
candidates, and only they are searched with the expression itself; a rule without mandatory
trigrams is searched for in every document.  Positions are code points, from one split of the text
at the matches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser as sre_parse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizops.llm.scratch import Scratch

MOST_STRINGS = 64  # alternatives that a trigram query spells out; beyond that, a part is skipped
BLOCK = 512  # lengths summed at a time where match positions are added up


@dataclass(frozen=True)
class Rule:
    """``pattern`` must mean the same to Java and Python.  A match counts if its group ``group``
    has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules.  A run of at least n of a class, taken greedily, is the maximal
# run wherever that is long enough, so the length is written into the last two expressions.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)


# ---------------------------------------------------------------- trigram queries


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of lower-case trigrams, one of which every match contains whole; None if the
    expression has no mandatory trigram."""
    parts: list[list[frozenset[str]]] = []
    run = {""}

    def close() -> None:
        nonlocal run
        if min(map(len, run)) >= 3:
            sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
            parts.append([a for a in sets if not any(b < a for b in sets)])
        run = {""}

    for choices in _pieces(sre_parse.parse(pattern)):
        if choices is None:
            close()
            continue
        longer = {a + b for a, b in product(run, choices)}
        if len(longer) > MOST_STRINGS:
            close()
            longer = set(choices) if len(choices) <= MOST_STRINGS else {""}
        run = longer
    close()
    if not parts:
        return None
    # All parts are mandatory; the one with the longest alternatives is the most selective.
    return sorted(max(parts, key=lambda p: (min(map(len, p)), -len(p))), key=sorted)


def _pieces(parsed) -> list[set[str] | None]:
    """The strings each piece of a sequence can be, or None where they are not few and known."""
    out: list[set[str] | None] = []
    for op, value in parsed:
        if op is sre.LITERAL:
            out.append({chr(value).lower()})
        elif op is sre.IN:
            letters = [chr(v).lower() for o, v in value if o is sre.LITERAL]
            out.append(set(letters) if len(letters) == len(value) and len(letters) <= 4 else None)
        elif op is sre.SUBPATTERN:
            out += _pieces(value[-1])
        elif op is sre.BRANCH:
            options = [_whole(_pieces(branch)) for branch in value[1]]
            out.append(set().union(*options) if all(o is not None for o in options) else None)
        elif op is sre.MAX_REPEAT and value[0] == 0 and value[1] == 1:
            inner = _whole(_pieces(value[2]))
            out.append(inner | {""} if inner is not None else None)
        elif op is sre.MAX_REPEAT and value[0] > 0:
            once = _pieces(value[2])
            out += [*once, None] if value[1] > 1 else once
        else:
            out.append(None)
    return out


def _whole(pieces: list[set[str] | None]) -> set[str] | None:
    found = {""}
    for choices in pieces:
        if choices is None or len(found) * len(choices) > MOST_STRINGS:
            return None
        found = {a + b for a, b in product(found, choices)}
    return found


# ---------------------------------------------------------------- index


def vocabulary(rules: Sequence[Rule]) -> list[str]:
    return sorted({t for r in rules for part in trigram_query(r.pattern) or [] for t in part})


def build_index(docs: DataFrame, trigrams: Sequence[str], scratch: Scratch, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored postings (trigram, doc): which documents contain a trigram in either case.

    One scan of the whole texts; only trigrams that can be asked for are kept."""
    low = docs.select(F.col(id_col).alias("doc"), F.lower(F.col(text)).alias("_low"))
    found = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return scratch.table(low.select("doc", F.explode(found).alias("trigram")).select("trigram", "doc"), "trigrams")


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(doc, rules): the numbers of the rules whose trigram query the document satisfies.

    A document satisfies a query if the postings of all trigrams of one of its parts hold it.  The
    parts are a table, joined to the postings by trigram, so any number of rules can be asked."""
    parts = [
        F.struct(F.lit(number).alias("rule"), F.lit(k).alias("part"), F.lit(len(part)).alias("need"), F.lit(t).alias("asked"))
        for number, rule in enumerate(rules) for k, part in enumerate(trigram_query(rule.pattern) or []) for t in sorted(part)
    ]
    empty = F.array().cast("array<struct<rule:int,part:int,need:int,asked:string>>")
    asked = index.sparkSession.range(1).select(F.inline(F.array(*parts) if parts else empty))
    found = index.join(asked, F.col("trigram") == F.col("asked")).groupBy("doc", "rule", "part").agg(
        F.size(F.collect_set("trigram")).alias("n"), F.max("need").alias("need"))
    return found.where("n = need").groupBy("doc").agg(F.collect_set("rule").alias("rules"))


# ---------------------------------------------------------------- verification


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def spans_of(text: Column, rule: Rule, number: int) -> Column:
    """array<struct<start, kind, end>> of a rule's leftmost non-overlapping matches that count.

    The split at the matches and the matches themselves alternate, so a match starts where the
    lengths before it end.  Sums go by blocks, so many matches stay far from quadratic.
    """
    pattern = F.lit(rule.pattern)
    kind = "array<struct<start:int,kind:int,end:int>>"

    def placed(s: Column) -> Column:
        gaps = F.transform(s["between"], lambda x: F.char_length(x))
        sizes = F.transform(s["found"], lambda x: F.char_length(x))
        steps = F.zip_with(F.slice(gaps, 1, F.size(sizes)), sizes, lambda a, b: a + b)

        def with_blocks(t: Column) -> Column:
            def before(i: Column) -> Column:
                block = F.floor(i / BLOCK).cast("int")
                return _total(F.slice(t["sums"], 1, block)) + _total(F.slice(t["steps"], block * BLOCK + 1, i % BLOCK))

            every = F.transform(
                F.sequence(F.lit(0), F.size(t["sizes"]) - 1),
                lambda i: _let(
                    before(i) + F.get(t["gaps"], i),
                    lambda start: F.struct(
                        start.alias("start"), F.lit(number).alias("kind"), (start + F.get(t["sizes"], i)).alias("end"),
                        (F.get(t["checked"], i) >= rule.least).alias("ok"),
                    ),
                ),
            )
            return F.transform(F.filter(every, lambda x: x["ok"]), lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))

        def sums(t: Column) -> Column:
            blocks = F.transform(
                F.sequence(F.lit(0), F.floor(F.size(t["steps"]) / BLOCK).cast("int")),
                lambda b: _total(F.slice(t["steps"], b * BLOCK + 1, BLOCK)),
            )
            return F.struct(t["gaps"].alias("gaps"), t["sizes"].alias("sizes"), t["steps"].alias("steps"), t["checked"].alias("checked"), blocks.alias("sums"))

        checked = F.transform(s["checked"], lambda x: F.char_length(x))
        first = F.struct(gaps.alias("gaps"), sizes.alias("sizes"), steps.alias("steps"), checked.alias("checked"))
        return _let(first, lambda t: _let(sums(t), with_blocks))

    parts = F.struct(
        F.split(text, rule.pattern, -1).alias("between"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("checked"),
    )
    return F.when(F.rlike(text, pattern), _let(parts, placed)).otherwise(F.array()).cast(kind)


def scan(docs: DataFrame, scratch: Scratch, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Id and ``spans`` - array<struct<kind string, start int, end int>>, ordered by start, then by
    the order of the rules - for every row of ``docs``.

    Null texts are empty and have no span.  Repeated rows, null ids and ids that several texts
    share all keep their own spans: sharing an id only makes a document a candidate too often.
    Other columns are not read.
    """
    named = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    index = build_index(named, vocabulary(rules), scratch, "doc", "_text")
    chosen = scratch.table(candidates(index, rules), "candidates").withColumnRenamed("doc", "_doc")
    found = []
    for number, rule in enumerate(rules):
        spans = spans_of(F.col("_text"), rule, number)
        if trigram_query(rule.pattern) is not None:
            asked = F.coalesce(F.array_contains("rules", number), F.lit(False))
            spans = F.when(asked, spans).otherwise(F.array())
        found.append(spans)
    names = F.array(*[F.lit(r.kind) for r in rules])
    joined = named.join(chosen, F.col("doc").eqNullSafe(F.col("_doc")), "left")
    listed = joined.select("doc", F.sort_array(F.concat(*found)).alias("_found"))
    return listed.select(
        F.col("doc").alias(id_col),
        F.transform("_found", lambda x: F.struct(
            F.get(names, x["kind"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end")
        )).alias("spans"),
    )
