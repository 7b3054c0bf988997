import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from bizops.llm import periodic
from bizops.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, exponent=4, least=6):
    """(start, length, period) of all runs, every period tried at every place."""
    n, found = len(words), {}
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i >= p and (i, j + p) not in found:
                found[i, j + p] = p
            i = j + 1
    return sorted(
        ((a, b - a, p) for (a, b), p in found.items() if b - a >= max(least, exponent * p)), key=lambda r: (r[0], r[2])
    )


def rows(runs):
    return [tuple(map(int, r)) for r in zip(*runs)]


def some_words(rng):
    n = rng.randint(0, 90)
    words = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(n)]
    if n and rng.random() < 0.6:
        a, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
        words = [words[a + (i - a) % p] if i >= a and a + (i - a) % p < n else w for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize("piece", [1, 7, 1 << 16])
def test_runs_against_trying_every_period(piece):
    rng = random.Random(piece)
    texts = [some_words(rng) for _ in range(60)]
    for exponent, least in ((4, 6), (2, 0), (3, 10)):
        got = periodic.runs_of([np.array(t, np.int64) for t in texts], exponent, least, piece)
        assert [rows(r) for r in got] == [plain_runs(t, exponent, least) for t in texts]


def test_one_text_alone_and_among_others():
    text = np.array([1, 2, 3] * 30 + list(range(9, 400)) + [5] * 7, np.int64)
    [alone] = periodic.runs_of([text])
    among = periodic.runs_of([text[:0], np.array([3]), text, np.array([3])])[2]
    assert rows(alone) == rows(among) == [(0, 90, 3), (481, 7, 1)]


def test_long_texts_of_one_word_and_of_long_periods():
    [one] = periodic.runs_of([np.zeros(200_000, np.int64)])
    assert rows(one) == [(0, 200_000, 1)]
    [wide] = periodic.runs_of([np.arange(200_000) % 50_000])
    assert rows(wide) == [(0, 200_000, 50_000)]


def test_false_hashes_are_noticed(monkeypatch):
    """With hashes that are all alike the runs are refused, and the next seed answers."""
    tried, real = [], periodic.SquareCatcher._hash

    def weak(self, at, size):
        return np.zeros(len(at), np.int64) if len(tried) == 1 else real(self, at, size)

    class Counted(periodic.SquareCatcher):
        def __init__(self, *a):
            tried.append(a)
            super().__init__(*a)

    monkeypatch.setattr(periodic.SquareCatcher, "_hash", weak)
    monkeypatch.setattr(periodic, "SquareCatcher", Counted)
    text = [1, 2, 1, 2, 1, 2, 1, 2, 9, 8, 7, 6, 5, 4, 3]
    assert rows(periodic.runs_of([np.array(text)])[0]) == plain_runs(text) and len(tried) == 2


def test_strongest_breaks_ties_exactly():
    runs = periodic.Runs(np.array([9, 3, 3]), np.array([8, 16, 24]), np.array([2, 4, 6]))
    assert periodic.strongest(runs) == 1
    assert periodic.strongest(periodic.Runs(*[np.zeros(0, np.int64)] * 3)) is None


def test_edge_rows(make_docs, edge_rows):
    more = [(20, "a b " * 9), (21, "x " * 5), (22, "x " * 6), (23, "x\t" * 500_000), (None, "q q q q q q r")]
    got = periodic.find_runs(make_docs(edge_rows + more), keep=["key"]).collect()
    assert len(got) == len(edge_rows) + len(more) and all(r["key"] == 7 for r in got)
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[3]["n_words"] == by[4]["n_words"] == 0 and by[3]["collapsed"] == "" and by[3]["best"] is None
    assert tuple(by[20]["best"]) == (0, 18, 2) and by[20]["collapsed"] == "a b"
    assert by[21]["runs"] == [] and tuple(by[22]["best"]) == (0, 6, 1)
    assert by[23]["n_words"] == 500_000 and by[23]["collapsed"] == "x"
    assert {r["collapsed"] for r in got if r["doc_id"] is None} == {"no id here at all", "q r"}
    assert periodic.find_runs(make_docs(edge_rows).where("false")).count() == 0


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    found = plain_runs(words)
    kept = [True] * n
    for start, length, period in found:
        kept[start + period : start + length] = [False] * (length - period)
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id, len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
        sha("".join(f"{s},{l},{p}\n" for s, l, p in found)), sha(" ".join(w for w, k in zip(words, kept) if k)),
    )


def test_query_against_plain_code(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    short = {r["doc_id"]: r["text"] for r in docs if len(WORD.findall(r["text"] or "")) <= 1500}
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, small).collect()}
    assert len(got) == len(docs) and sum(r[1] > 0 for r in got.values()) > 5
    assert {i: got[i] for i in short} == {i: plain_row(i, t) for i, t in short.items()}
