import fractions
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from bizops.llm import decontaminate, maxscore
from bizops.llm.queries import QUERIES


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_contamination(docs, items, size=10):
    found = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            found.setdefault(tuple(w[k : k + size]), set()).add(item)
    lengths, out = sorted({len(x) for x in found}), []
    for doc, text in docs:
        w, hit, which = words(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in found:
                    which |= found[tuple(w[k : k + n])]
                    hit |= set(range(k, k + n))
        which = sorted(str(i) for i in which if i is not None)
        out.append((doc, len(w), len(hit), len(which), tuple(which), bool(hit)))
    return sorted(out, key=str)


PASSAGE = "one two three four five six seven eight nine ten eleven twelve"


def test_contamination(spark, make_docs, edge_rows, scratch, monkeypatch):
    monkeypatch.setattr(decontaminate, "CHUNK_WORDS", 40)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)
    docs = [
        *edge_rows, (50, f"start {PASSAGE.upper()}; end"), (51, PASSAGE.replace("six", "sex")), (52, PASSAGE.replace(" ", " -- ")),
        (53, " ".join(PASSAGE.split()[:10])), (54, " ".join(PASSAGE.split()[:9])), (55, "ten eleven twelve"), (56, (PASSAGE + " ") * 3),
        (57, "short item here"), (58, "a b a b a b a b a b a b a b a b"), (59, "été naïve 漢字"), (60, "end of doc one two three four five six"),
        (61, "seven eight nine ten eleven twelve"),
    ]
    items = [(1, PASSAGE), (2, "short item"), (3, None), (4, " ,, "), (5, "a b a b a b a b a b a b"), (6, "naïve 漢字"), (None, "end of doc"), (1, PASSAGE), (30, "beta gamma")]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, chunk string")
    got = decontaminate.contamination(make_docs(docs), bench, scratch).collect()
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], tuple(r["items"]), r["contaminated"]) for r in got]
    assert sorted(got, key=str) == plain_contamination(docs, items)


def test_nothing_to_search_or_to_find(spark, make_docs, edge_rows, scratch):
    empty = spark.createDataFrame([], "item_id bigint, text string")
    got = decontaminate.contamination(make_docs(edge_rows), empty, scratch).collect()
    assert len(got) == len(edge_rows) and not any(r["contaminated"] or r["n_items"] for r in got)
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id bigint, text string")
    assert decontaminate.contamination(make_docs([]), bench, scratch).count() == 0


def test_proximity(spark, make_docs, scratch):
    bench = spark.createDataFrame([(1, "red green blue")], "item_id bigint, text string")
    index = decontaminate.build_index(make_docs([(1, "red green blue"), (2, "red dark green blue"), (3, "red a b c green blue"), (4, "blue green")]), scratch)
    hits = lambda slop: {r["_id"] for r in decontaminate.search(index, bench, scratch, slop=slop).collect() if r["items"]}
    assert hits(0) == {1} and hits(1) == {1, 2} and hits(3) == {1, 2, 3}


def test_decontamination_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op7_decontaminate"](spark, folder).collect()
    want = [(d, n, h, k, hashlib.sha256(",".join(w).encode()).hexdigest(), c) for d, n, h, k, w, c in plain_contamination(docs, items)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and any(r["contaminated"] for r in got)


def plain_top_k(rows, queries, k):
    out = []
    for q, v in queries:
        scores = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("sparse", [False, True])
def test_top_k(spark, scratch, sparse):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 12)) * (rng.random((400, 12)) < 0.2 if sparse else 1)
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(x)]
    rows += [(7, rows[7][1], 1), (500, rows[3][1], 1), (501, rows[3][1], 1), (502, [0.0] * 12, 1), (503, [1.0, -2.0], 1), (504, [], 1)]
    bad = [(600, None, 1), (601, [None, 1.0], 1), (602, [float("nan")] * 12, 1), (603, [float("inf")] * 12, 1), (None, rows[0][1], 1)]
    frame = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>, score int").repartition(3)
    scaled = [(i, [int(np.floor(1024 * c)) for c in v]) for i, v, _ in rows]
    got = maxscore.top_k(frame, frame.where("vec_id % 20 = 0 OR vec_id IN (7, 503, 504) OR vec_id IS NULL"), scratch, k=5, shard=64)
    queries = {i: v for i, v in scaled if i % 20 == 0 or i in (7, 503, 504)}
    assert sorted(map(tuple, got.collect())) == plain_top_k(scaled, queries.items(), 5)


def exact(v):
    return [int(fractions.Fraction(c) * 1024 // 1) for c in v]


@pytest.mark.parametrize("shard", [8, 1000])
def test_components_of_any_size(spark, scratch, shard):
    """Against Python's whole numbers: sums near, at and beyond what a machine word holds on the way."""
    rng = random.Random(4)
    sizes = [1.0, 2.0**19, 2.0**20 - 1, 2.0**25, 2.0**40, 1e15]
    rows = [(i, [rng.choice([-1, 0, 1]) * rng.choice(sizes[: 2 + i % 5]) * rng.random() for _ in range(16)]) for i in range(120)]
    rows += [(200, [2.0**20 - 1] * 2), (201, [2.0**20 - 1] * 2), (202, [1.0] * 16), (203, []), (204, [2.0**70, 0.0]), (205, [0.0, 2.0**-70])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    asked = [r for r in rows if r[0] in (200, 202, 203, 205) or r[0] % 30 == 0]
    want = plain_top_k([(i, exact(v)) for i, v in rows], [(i, exact(v)) for i, v in asked], 5)
    fits = {q for q in {r[0] for r in asked} if all(abs(r[3]) < 2**63 for r in want if r[0] == q)}
    assert {203, 205} <= fits and len(fits) < len(asked)
    few = frame.where(F.col("vec_id").isin(list(fits)))
    got = maxscore.top_k(frame, few, scratch, k=5, shard=shard)
    assert sorted(map(tuple, got.collect())) == sorted(r for r in want if r[0] in fits)
    for q in {r[0] for r in asked} - fits:
        with pytest.raises(Exception, match="beyond a long"):
            maxscore.top_k(frame, frame.where(F.col("vec_id") == q), scratch, k=5, shard=shard).collect()


def test_sixteen_large_dimensions_rank_before_ones(spark, scratch):
    rows = [(0, [2.0**18 - 1] * 16), (1, [2.0**18 - 1] * 16), (2, [1.0] * 16)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = maxscore.top_k(frame, frame.where("vec_id = 0"), scratch).orderBy("rank").collect()
    side = (2**18 - 1) * 1024
    assert [tuple(r) for r in got] == [(0, 1, 1, 16 * side * side), (0, 2, 2, 16 * side * 1024)]


def test_a_repeated_query_id_asks_with_its_first_vector(spark, scratch):
    rows = [(0, [2.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [3.0, 1.0])]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, "vec_id bigint, embedding array<double>")
        got = maxscore.top_k(frame, frame.where("vec_id = 0"), scratch).orderBy("rank").collect()
        assert [tuple(r) for r in got] == [(0, 1, 2, 3 * 1024 * 1024), (0, 2, 1, 1024 * 1024)]


def test_fewer_rows_than_k(spark, scratch):
    frame = spark.createDataFrame([(0, [1.0, 0.5]), (1, [0.25, 0.0]), (2, [-1.0, 0.0])], "vec_id bigint, embedding array<float>")
    got = maxscore.top_k(frame, frame.where("vec_id = 0"), scratch)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 1, 1024 * 256), (0, 2, 2, -1024 * 1024)]
    assert maxscore.top_k(frame.where("false"), frame, scratch).count() == 0 == maxscore.top_k(frame, frame.where("false"), scratch).count()


def test_bounds_leave_vectors_out_early(spark, scratch):
    """The threshold makes small terms non-essential: they are not traversed."""
    rng = np.random.default_rng(5)
    x = np.floor(1024 * rng.normal(size=(2000, 16)) * np.geomspace(4, 0.01, 16)).astype(np.int64)
    import pandas as pd

    from bizops.llm import varint

    rows = [(1, -1, 16, np.arange(2000, dtype="<i8").tobytes(), b"")]
    for d in range(16):
        for sign in (0, 1):
            at = np.flatnonzero(x[:, d] < 0 if sign else x[:, d] > 0)
            rows.append((1, 2 * d + sign, int(np.abs(x[at, d]).max()), varint.encode(np.diff(at, prepend=0))[0].tobytes(), varint.encode(np.abs(x[at, d]))[0].tobytes()))
    shard = maxscore.Shard(pd.DataFrame(rows, columns=["shard", "term", "top", "docs", "impacts"]))
    traversed = []
    shard.lists = type("Lists", (dict,), {"get": lambda self, k: traversed.append(k) or dict.get(self, k)})(shard.lists)
    ids, score = shard.best(x[17], 17, 10, None)
    full = x @ x[17]
    full[17] = -(2**60)
    assert sorted(ids.tolist()) == sorted(np.lexsort((np.arange(2000), -full))[:10].tolist()) and (score == full[ids]).all()
    assert 0 < len(traversed) < 32


def test_top_k_query(spark, small):
    rows = [(r["vec_id"], [int(np.floor(1024 * float(c))) for c in r["embedding"]]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    got = QUERIES["op6_top_k"](spark, small).collect()
    assert sorted(map(tuple, got)) == plain_top_k(rows, [r for r in rows if r[0] % 100 == 0], 10)
