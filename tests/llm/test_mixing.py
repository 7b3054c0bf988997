import hashlib
import re
from collections import defaultdict

import pytest

from bizops.llm import mixing
from bizops.llm.queries import QUERIES


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    total, free, target = sum(sizes.values()), set(order), {}
    while True:
        left = total - sum(target.values())
        level = left / sum(w[s] for s in free) if free else 0
        over = {s for s in free if level * w[s] > most * sizes[s]}
        if not over:
            return target | {s: level * w[s] for s in free}
        target |= {s: float(most * sizes[s]) for s in over}
        free -= over


def draw(i, text, seed=42):
    name = f"{seed}:{'null' if i is None else i}:{hashlib.md5((text or '').encode()).hexdigest()}"
    return (int(hashlib.md5(name.encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def chances(sizes, rest):
    """Inclusion probabilities in proportion to size that take ``rest`` words on average; 1 where certain."""
    left, open_ = rest, sorted((n for n in sizes if n > 0), reverse=True)
    while open_ and left > 0:
        c = left / sum(n * n for n in open_)
        if c * open_[0] < 1:
            return lambda n, c=c, top=open_[0]: 0 if n <= 0 else 1 if n > top else c * n
        left -= open_.pop(0)
    return lambda n: 0


def plain_mix(rows, seed=42):
    """[(id, text, source)] -> {id: taken}, by sorting each source whole and going through it once."""
    sizes, by = defaultdict(int), defaultdict(list)
    for number, (i, text, source) in enumerate(rows):
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] += n
        by[source].append((draw(i, text, seed), i, n, number))
    target, taken = plain_targets(sizes), {}
    for s, docs in by.items():
        whole = int(round(target[s], 6) // sizes[s]) if sizes[s] else 0
        gap = round(target[s], 6) - whole * sizes[s]
        chance = chances([n for _, _, n, _ in docs], gap)
        chosen, ranked = set(), []
        for u, i, n, number in docs:
            p = chance(n)
            if p == 1:
                chosen.add(number)
                gap -= n
            elif p > 0:
                ranked.append(((u / (1 - u)) / (p / (1 - p)), i is not None, i, n, number))
        left = []
        for row in sorted(ranked):
            if row[3] <= gap:
                chosen.add(row[4])
                gap -= row[3]
            else:
                left.append(row)
        close = min(((abs(gap - row[3]), row) for row in left), default=None)
        if close and close[0] < gap:
            chosen.add(close[1][4])
        for _, i, n, number in docs:
            taken[i] = n * (whole + (number in chosen))
    return taken, target, sizes


def documents(n=600):
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else None if i % 17 == 0 else ["a", "b", "Z", "é", "\U0001f600"][i % 5]
        rows.append((i, None if i % 50 == 9 else " ".join(["w"] * (i * 7 % 83)), "en", source))
    return rows


@pytest.mark.parametrize("bins", [1024, 2])
def test_mix_against_sorting(make_docs, scratch, monkeypatch, bins):
    monkeypatch.setattr(mixing, "BINS", bins)
    rows = documents()
    got = mixing.mix(make_docs(rows), scratch).collect()
    taken, target, sizes = plain_mix([(i, t, s) for i, t, _, s in rows])
    source = {i: s for i, _, _, s in rows}
    assert {r["doc_id"]: r["taken"] for r in got} == taken
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s], abs=1e-5)
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["copies"]
    for s in sizes:
        left = target[s] - sum(r["taken"] for r in got if source[r["doc_id"]] == s)
        free = [r["size"] for r in got if source[r["doc_id"]] == s and r["size"] and r["taken"] == r["size"] * (target[s] // sizes[s])]
        assert abs(left) <= 0.02 * target[s] or all(abs(left - n) >= abs(left) for n in free)
    again = mixing.mix(make_docs(rows), scratch).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_larger_documents_move_up_in_the_order():
    """The odds of the inclusion probability change places against the plain random order."""
    chance = chances([1, 1, 1, 10], 4)
    by_random = [0.30, 0.35]  # the small one first
    rank = lambda u, n: (u / (1 - u)) / (chance(n) / (1 - chance(n)))
    assert rank(by_random[1], 10) < rank(by_random[0], 1)


def test_sizes_change_who_is_taken(spark, make_docs, scratch):
    """Large documents are taken more often than small ones, in proportion; the largest is certain."""
    rows = [(i, " ".join(["w"] * (5 if i % 2 else 40)), "en", "a") for i in range(2000)]
    rows += [(9000, " ".join(["w"] * 30_000), "en", "a")] + [(10_000 + i, "w " * 60, "en", "b") for i in range(900)]
    got = mixing.mix(make_docs(rows), scratch, weights=(1, 2)).collect()
    share = lambda n: sum(r["copies"] > 0 for r in got if r["size"] == n) / sum(r["size"] == n for r in got)
    assert share(30_000) == 1 and 4 < share(40) / share(5) < 13
    assert {r["doc_id"]: r["taken"] for r in got} == plain_mix_of(rows, (1, 2))


def plain_mix_of(rows, weights):
    import test_mixing

    real = test_mixing.plain_targets
    test_mixing.plain_targets = lambda sizes: real(sizes, weights)
    try:
        return test_mixing.plain_mix([(i, t, s) for i, t, _, s in rows])[0]
    finally:
        test_mixing.plain_targets = real


def test_a_document_that_does_not_fit_does_not_end_the_draw(make_docs, scratch):
    """One document holds most of the source; the small ones behind it in the order fill the target."""
    rows = [(0, "w " * 9000, "en", "a")] + [(i, "w " * 3, "en", "a") for i in range(1, 600)] + [(1000 + i, "w " * 50, "en", "b") for i in range(2000)]
    got = mixing.mix(make_docs(rows), scratch, weights=(1, 70)).collect()
    target = next(r["target"] for r in got if r["doc_id"] == 0)
    assert target < 1797 and abs(sum(r["taken"] for r in got if r["doc_id"] < 1000) - target) < 2


def test_many_rows_without_an_id(spark, make_docs, scratch):
    """They draw different numbers, and repeated rows close one at a time."""
    rows = [(None, f"text {i} " * (1 + i % 9), "en", "a") for i in range(3000)] + [(None, "same row of words", "en", "b")] * 1000
    got = mixing.mix(make_docs(rows), scratch, weights=(1, 3)).collect()
    for size in {r["source_size"] for r in got}:
        some = [r for r in got if r["source_size"] == size]
        assert abs(sum(r["taken"] for r in some) - some[0]["target"]) <= 4


def test_excess_is_shared_again(make_docs, scratch):
    rows = [(1, "w", "en", "a"), (2, "w w", "en", "b"), *[(10 + i, "w " * 30, "en", "c") for i in range(20)]]
    got = {r["doc_id"]: r for r in mixing.mix(make_docs(rows), scratch).collect()}
    assert got[1]["target"] == 3 and got[1]["taken"] == 3 and got[2]["taken"] == 6
    assert got[10]["target"] == pytest.approx(603 - 9)


def test_edge_cases(make_docs, edge_rows, scratch):
    rows = [(*r, "en", s) for r, s in zip(edge_rows, ["a", "a", None, "", "z", "a", "b", "b", "c", "c", None, "b", "b"])]
    got = mixing.mix(make_docs(rows, source=None), scratch, keep=["score"]).collect()
    assert len(got) == len(rows) and all(r["taken"] <= 3 * r["size"] and r["score"] == 0.5 for r in got)
    assert [r["taken"] for r in got if r["doc_id"] in (3, 4, 5)] == [0, 0, 0]
    assert mixing.mix(make_docs([]), scratch).count() == 0
    assert [r["taken"] for r in mixing.mix(make_docs([(1, None), (2, "")]), scratch).collect()] == [0, 0]


def test_query(spark, small):
    got = QUERIES["op9_mix"](spark, small).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "source").collect()]
    assert {r["doc_id"]: r["taken"] for r in got} == plain_mix(rows)[0]
