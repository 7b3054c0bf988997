import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from bizops.llm import importance
from bizops.llm.queries import QUERIES


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_buckets(text, most=1, buckets=10_000):
    words = plain_words(text)
    return [zlib.crc32(" ".join(words[i : i + k]).encode()) % buckets for k in range(1, most + 1) for i in range(len(words) - k + 1)]


def plain_resample(docs, target, most=1, buckets=10_000, percent=10, least=20):
    """[(id, text)], [text] -> rows (id, n_features, weight, score, rank)."""
    features = [plain_buckets(t, most, buckets) for _, t in docs]
    s, t = Counter(b for f in features for b in f), Counter(b for x in target for b in plain_buckets(x, most, buckets))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for (i, text), f in zip(docs, features):
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None, len(plain_words(text))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return [tuple(r[:5]) for r in rows]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_query_against_plain_code(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op12_importance"](spark, small).collect()]
    assert sorted(got, key=key) == sorted(plain_resample(docs, target), key=key)
    assert sum(r[4] is not None for r in got) >= 10


@pytest.mark.parametrize("most, buckets", [(1, 10_000), (3, 70_000)])
def test_edges_and_wider_windows(make_docs, scratch, edge_rows, most, buckets):
    rows = edge_rows + [(30 + i, f"Word{i % 7} AND-other; {'text ' * (i % 40)}end") for i in range(80)] + [(None, "again " * 30)] * 2
    target = [(1, "word3 and other end"), (2, None), (3, "")]
    got = importance.resample(make_docs(rows), make_docs(target), scratch, most=most, buckets=buckets)
    found = [(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got.collect()]
    assert sorted(found, key=key) == sorted(plain_resample(rows, [t for _, t in target], most, buckets), key=key)


def test_empty_tables(make_docs, scratch, edge_rows):
    none = make_docs(edge_rows).where("false")
    assert importance.resample(none, make_docs(edge_rows), scratch).count() == 0
    got = importance.resample(make_docs(edge_rows), none, scratch).collect()
    assert len(got) == len(edge_rows)


def test_pieces_change_nothing(monkeypatch):
    text = "Ünder the Sea-level \U0001f600 42x; " * 50 + "z" * 300
    want = plain_buckets(text, 3)
    for size in (7, 64, 1 << 20):
        monkeypatch.setattr(importance.pieces, "__defaults__", (size,))
        n, got = importance.Buckets(3, 10_000)(text)
        assert n == len(plain_words(text)) and sorted(got.tolist()) == sorted(want)


def test_ties_go_to_the_smaller_id(make_docs, scratch, monkeypatch):
    monkeypatch.setattr(importance, "noise", lambda key, seed: importance.F.lit(0).cast("bigint"))
    rows = [(i, "same words here " * 8) for i in range(100)]
    got = importance.resample(make_docs(rows[::-1]), make_docs(rows[:1]), scratch).where("rank IS NOT NULL").collect()
    assert {(r["doc_id"], r["rank"]) for r in got} == {(i, i + 1) for i in range(10)}
