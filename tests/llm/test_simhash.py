import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from bizops.llm import simhash
from bizops.llm.components import connected_components
from bizops.llm.queries import QUERIES


def plain_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs):
    """{(id, fp), ...} -> {id: smallest id reachable}, by comparing everything."""
    root = {}
    items = sorted(pairs)

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, (i, x) in enumerate(items):
        find(i)
        for j, y in items[a + 1 :]:
            if (x ^ y).bit_count() <= 3:
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    return {i: find(i) for i, _ in items}


@pytest.mark.parametrize("piece", [7, 64, 1 << 20])
def test_words_in_pieces(piece, monkeypatch):
    text = "Aa b\tc  éÉ d E\n" * 40
    whole = text.encode().lower().split()
    got = list(simhash.word_pieces(text.encode().lower(), 2, piece))
    grams = [tuple(p[i : i + 3]) for p in got for i in range(len(p) - 2)]
    assert grams == [tuple(whole[i : i + 3]) for i in range(len(whole) - 2)]


@pytest.mark.parametrize("text", [None, "", "  ", "one", "One two", "a b c", "é É ß a B c d e f", "the cat " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_distance(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    flips = [np.bitwise_xor.reduce(np.uint64(1) << rng.choice(64, n, replace=False).astype(np.uint64)) if n else np.uint64(0)
             for n in rng.integers(0, 12, 300)]
    fps = base[rng.integers(0, 40, 300)] ^ np.array(flips, np.uint64)
    planes = simhash._planes(fps)
    for by in (1, 5, 63, 64, 65, 130, 299):
        wanted = np.ones(len(fps) - by, bool)
        lanes = simhash.near_lanes(planes, simhash._shift(planes, by), simhash._pack(wanted, planes.shape[1]), radius)
        got = np.unpackbits(lanes.view(np.uint8), bitorder="little")[: len(fps) - by]
        assert (got == (np.bitwise_count(fps[:-by] ^ fps[by:]) <= radius)).all()


def test_every_pair_within_the_radius_shares_a_bucket():
    rng = np.random.default_rng(0)
    masks = simhash.masks(3)
    assert len(masks) == 10
    for _ in range(300):
        x = int(rng.integers(0, 2**63))
        y = x
        for b in rng.choice(64, 3, replace=False).tolist():
            y ^= 1 << b
        assert any(x & m == y & m for m in masks)


def test_large_buckets_are_dealt_out_and_lose_no_link(spark, scratch):
    """All fingerprints share most bits, so every bucket is far larger than a tile."""
    rng = np.random.default_rng(1)
    fps = sorted({int(x) for x in rng.integers(0, 2**14, 400)})
    rows = [(f, i) for i, f in enumerate(fps)]
    reps = spark.createDataFrame(rows, "fp bigint, rep bigint")
    found = connected_components(simhash.fingerprint_links(reps, tile=16), scratch)
    got = {r["node"]: r["component"] for r in found.collect()}
    want = plain_components({(i, f) for f, i in rows})
    assert {i: got.get(i, i) for _, i in rows} == want


def test_components_of_paths_rings_and_stars(spark, scratch):
    path = [(i, i + 1) for i in range(60)]
    ring = [(100 + i, 100 + (i + 1) % 7) for i in range(7)]
    star = [(200, 200 + i) for i in range(1, 50)]
    rows = path + ring + star + star + [(5, 5), (None, 1), (3, None)]
    found = connected_components(spark.createDataFrame(rows, "u bigint, v bigint"), scratch)
    got = {r["node"]: r["component"] for r in found.collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(7)} | {200 + i: 200 for i in range(50)}
    none = spark.createDataFrame([], "u bigint, v bigint")
    assert connected_components(none, scratch).count() == 0


def test_edge_cases(make_docs, edge_rows, scratch):
    found = simhash.near_duplicates(make_docs(edge_rows), scratch).collect()
    assert len(found) == len(edge_rows)
    text = dict(edge_rows)
    want = plain_components({(i, plain_fingerprint(t)) for i, t in edge_rows if i is not None and i not in (7, 8)})
    for r in found:
        if r["doc_id"] is not None:
            assert r["fp"] % (1 << 64) == plain_fingerprint(text[r["doc_id"]]) if r["doc_id"] not in (7, 8) else True
            if r["doc_id"] not in (7, 8):
                assert r["component_id"] == want[r["doc_id"]]
        else:
            assert r["component_id"] is None
    by_id = {r["doc_id"]: r["component_id"] for r in found}
    assert by_id[2] == 1 and by_id[8] == 7 and by_id[4] == by_id[5] == 3
    assert simhash.near_duplicates(make_docs([]), scratch).count() == 0


def test_query_against_brute_force(spark, small):
    got = QUERIES["op1_simhash"](spark, small).collect()
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in text.items()}
    want = plain_components(set(prints.items()))
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got} == {(i, f"{prints[i]:016x}", want[i]) for i in text}


def test_hash_is_the_one_spark_has(spark):
    r = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first()
    assert r["h"] % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)
