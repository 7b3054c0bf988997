import os
import sys

import pytest

import bizops

# Workers of a local session import the package from the source tree.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [os.path.dirname(os.path.dirname(bizops.__file__)), os.environ.get("PYTHONPATH", "")]
)
sys.path.insert(0, os.path.dirname(__file__))

SMALL = "/root/testdata/sf0.001"
#: Columns that documents need not have, under names that the operators use inside.
EXTRA = "lang string, source string, n_chars bigint, score double, key bigint, chunk bigint, _text string, fp bigint"
LONG = " ".join(f"word{i % 977} is{i}" for i in range(40_000))


@pytest.fixture
def make_docs(spark):
    """make_docs([(doc_id, text), ...] or longer rows) with extra columns of clashing names."""

    def make(rows, source="s"):
        full = [(*r[:2], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else source, None, 0.5, 7, 7, "clash", 7) for r in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, " + EXTRA).repartition(3)

    return make


@pytest.fixture
def edge_rows():
    """Nulls, empty, blank and very long texts, copies, repeated rows."""
    return [
        (1, "Alpha beta gamma delta"), (2, "alpha BETA\tgamma  delta"), (3, None), (4, ""), (5, " \n\t "), (6, "one"),
        (7, LONG), (8, LONG + " end"), (9, "repeated row of words"), (9, "repeated row of words"),
        (None, "no id here at all"), (10, "ünïcödé wörds 漢字 \U0001f600 done"), (11, "x" * 100_000),
    ]


@pytest.fixture
def scratch(spark):
    from bizops.llm.scratch import Scratch

    with Scratch(spark, "test") as s:
        yield s


@pytest.fixture
def small():
    return SMALL
