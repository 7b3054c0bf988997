import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bizops.llm import tokenfile, tokens, varint
from bizops.llm.queries import QUERIES

BYTES, LETTERS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SIGNS = [chr(c) for c in (0x85, 0xA0, 0x1680, 0x180E, 0x2000, 0x200B, 0x2028, 0x202F, 0x3000, 0xFEFF, 0x301, 0x3A3, 0x3C3, 0x130, 0x1C5, 0x1C, 0x1F)]
PARTS = [*"ab 'sZ1²éß\t\n\r\x0b\x0c.,!", "٣", "漢", "<|endoftext|>", "<|startoftext|>", "'ll", "  ", *SIGNS]


@given(st.lists(st.integers(0, 2**35 - 1), max_size=50))
@settings(max_examples=200, deadline=None)
def test_varints(values):
    coded, widths = varint.encode(np.array(values, np.int64))
    assert varint.decode(coded.tobytes()).tolist() == values and widths.sum() == len(coded)


def test_cutting_at_white_space_changes_no_token():
    tokenizer, rng = tokens.load_tokenizer(BYTES), random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        pieces = tokens.PRE_TOKEN.findall(text)
        assert "".join(pieces) == text
        ids = [i for e in tokenizer.encode_batch(pieces, add_special_tokens=False) for i in e.ids]
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def split(ids, many):
    return [x.tolist() for x in np.split(ids, np.cumsum(many)[:-1])]


@pytest.mark.parametrize("path, by_pieces", [(LETTERS, True), (BYTES, False)])
def test_encoder_equals_the_library(path, by_pieces):
    """Many texts at once, with few and with many pre-tokens remembered; another tokenizer goes to the
    library whole instead of giving ids of its own."""
    encoder, rng = tokenfile.PieceEncoder(path, "<u2", limit=50), random.Random(2)
    assert encoder.by_pieces is by_pieces
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + ["Hello World, it's 2024"]
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for size in (1, 7, 500):
        got = [x for i in range(0, len(texts), size) for x in split(*encoder.encode_many(texts[i : i + size]))]
        assert got == want
    assert encoder.encode_many([])[0].tolist() == [] and split(*encoder.encode_many([None, "a"]))[0] == []


def test_changed_tokenizer_files_are_told_apart(tmp_path):
    import json

    told = json.loads(tokens.load_tokenizer(LETTERS).to_str())
    changes = [
        ("normalizer", None), ("pre_tokenizer", {"type": "Whitespace"}),
        ("added_tokens", told["added_tokens"] + [{**told["added_tokens"][0], "id": 5, "content": "hello", "special": False}]),
    ]
    for k, (name, value) in enumerate(changes):
        path = tmp_path / f"{k}.json"
        path.write_text(json.dumps({**told, name: value}))
        encoder = tokenfile.PieceEncoder(str(path), "<u2")
        want = encoder.tokenizer.encode("Say hello", add_special_tokens=False).ids
        assert not encoder.by_pieces and encoder.encode_many(["Say hello"])[0].tolist() == want


def test_token_counts(make_docs, edge_rows, scratch, monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK_BYTES", 30)
    rows = [*edge_rows, (40, "a <|endoftext|>  b"), (41, "x   y\n\nz ")]
    got = tokens.token_counts(make_docs(rows), BYTES, scratch).collect()
    tokenizer = tokens.load_tokenizer(BYTES)
    want = [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert tokens.token_counts(make_docs([]), BYTES, scratch).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_minimal_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64))
    hashed = tokenfile.PerfectHash.build(keys)
    assert sorted(hashed.slots(keys).tolist()) == list(range(len(keys)))
    if n == 5000:
        absent = np.arange(1, 5001, dtype=np.uint64)
        slots = hashed.slots(absent)
        prints = np.zeros(len(keys), np.uint32)
        prints[hashed.slots(keys)] = tokenfile.fingerprints(keys)
        there = slots >= 0
        assert not (prints[slots[there]] == tokenfile.fingerprints(absent[there])).any()
        assert len(hashed.bits) * 8 / n < 4


def expected(rows, end=1):
    tokenizer = tokens.load_tokenizer(LETTERS)
    at, out = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, end]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("vocabulary", [None, 1 << 17])
def test_round_trip(spark, make_docs, edge_rows, scratch, vocabulary):
    rows = [*edge_rows, (-5, "below zero"), (None, "second without id")]
    docs = make_docs(rows)
    dataset = tokenfile.write_dataset(docs, scratch.path("tokens"), LETTERS, scratch, vocabulary=vocabulary, shards=3, bucket_keys=4)
    assert dataset.dtype == ("<u2" if vocabulary is None else "<u4") and dataset.buckets > 2
    got = tokenfile.read_documents(dataset, docs).collect()
    assert sorted((tuple(r)[:4] for r in got), key=str) == sorted(expected(rows), key=str)
    for r in got:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and r["ids"][-1] == 1
    asked = spark.createDataFrame([(9,), (1,), (12345,), (1,)], "doc_id bigint")
    assert sorted(r["doc_id"] for r in tokenfile.read_documents(dataset, asked).collect()) == [1, 9, 9]


def test_hot_and_missing_ids_spread_over_shards_and_cells(spark, scratch):
    """A third of the rows without an id, a third with one id: neither fills one shard or one cell."""
    rows = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 1 THEN 7 WHEN id % 3 = 2 THEN id END AS doc_id",
        "CASE WHEN id % 30 = 0 THEN 'same text' ELSE 'text ' || id END AS text").repartition(4)
    dataset = tokenfile.write_dataset(rows, scratch.path("tokens"), LETTERS, scratch, shards=12, bucket_keys=500)
    assert max(r["docs"] for r in dataset.shards.collect()) < 9_000
    cells = dataset.index.groupBy("bucket").count().collect()
    assert sorted(r["count"] for r in cells)[-2] >= 4 and len({r["cell"] for r in dataset.index.collect()}) == dataset.index.count()
    got = tokenfile.read_documents(dataset, rows, with_ids=False).collect()
    assert len(got) == 60_000 and len({r["start"] for r in got}) == 60_000
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    keys = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0)) and keys.count(7) == keys.count(None) == 20_000


def test_no_documents(spark, make_docs, scratch):
    assert tokenfile.encode_and_read(spark, make_docs([]), scratch, LETTERS).count() == 0


def test_queries_against_the_library(spark, small):
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    tokenizer = tokens.load_tokenizer(BYTES)
    for r in QUERIES["op8_token_counts"](spark, small).collect():
        n = len(tokenizer.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids)
        assert (r["n_tokens"], r["over_limit"], r["n_bytes"]) == (n, n > 512, len((text[r["doc_id"]] or "").encode()))
    assert sorted(map(tuple, QUERIES["op5_token_file"](spark, small).collect())) == expected(text.items())
