import math
import re
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from bizops.llm import language, quality
from bizops.llm.compression import even_sample, held_out, label_sizes, piece
from bizops.llm.queries import QUERIES

GOOD = ["the river runs to the sea and the hill is green", "a house by the road has a red door and a garden"]
BAD = ["BUY!! NOW!! CHEAP!!", "click ### here *** win $$$ prize %%%"]
WORDS = {"en": "the of and house river green stone water", "de": "der die und haus fluss grün stein wasser", "fr": "le la et maison fleuve vert pierre eau"}


def test_held_out_is_the_checksum_of_the_id(spark):
    rows = spark.range(200).select(F.col("id").alias("doc_id")).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    for r in rows.select("doc_id", held_out().alias("h")).collect():
        assert r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_even_sample_keeps_about_as_many_of_each(spark):
    rows = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 300 == 1, "rare").otherwise("mid").alias("label"))
    sizes = label_sizes(rows, "label")
    got = {r["label"]: r["count"] for r in even_sample(rows, "label", "id", 500, sizes).groupBy("label").count().collect()}
    assert got["rare"] == sizes["rare"] and all(350 < got[k] < 650 for k in ("hot", "mid"))
    assert even_sample(rows, "label", "id", 500, {}).count() == 0


@pytest.mark.parametrize("ident", ["7", "null", "61"])
def test_sample_of_one_id_is_bounded(spark, ident):
    """20,000 rows of one id, or of none: about as many are kept as are wanted, neither all nor none."""
    rows = spark.range(20_000).selectExpr(f"{ident} AS doc_id", "'a' AS label", "'text ' || id AS text")
    got = even_sample(rows, "label", ["doc_id", "text"], 500, label_sizes(rows, "label")).count()
    assert 350 < got < 650
    same = rows.withColumn("text", F.lit("same"))
    assert even_sample(same, "label", ["doc_id", "text"], 50_000, label_sizes(same, "label")).count() == 1


def test_fits_on_a_flood_of_one_id_stay_bounded(spark, make_docs, monkeypatch):
    flood = spark.range(4000).selectExpr("IF(id % 2 = 0, 7, 8) AS doc_id", "'text of ' || id AS text", "IF(id % 2 = 0, 'en', 'de') AS lang")
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id bigint, quality int")
    seen = []
    real = quality.even_sample
    monkeypatch.setattr(quality, "even_sample", lambda *a: seen.append(real(*a)) or seen[-1])
    quality.fit(flood, labels, per_label=200)
    assert 250 < seen[-1].count() < 550
    assert max(map(len, language.fit(flood, per_language=100).contents)) < 150 * 20
    dirty = flood.withColumn("lang", F.col("text"))
    assert len(language.fit(dirty, most=30).languages) == 30


def test_pieces_come_from_anywhere_in_a_text(spark):
    texts = spark.range(400).selectExpr("repeat(CAST(id AS STRING) || ' ', 100) || 'middle ' || repeat('tail ', 100) AS t")
    got = [r["p"] for r in texts.select(piece("t", "x", 50).alias("p")).collect()]
    assert all(len(p) == 50 for p in got) and sum("tail" in p for p in got) > 100 and sum("tail" not in p for p in got) > 50
    short = spark.createDataFrame([("short",), ("",), (None,)], "t string").select(piece("t", "x", 50).alias("p")).collect()
    assert [r["p"] for r in short] == ["short", "", None]


@pytest.fixture
def labelled(spark, make_docs):
    rows, labels = [], []
    for i in range(400):
        good = i % 2
        text = " ".join((GOOD if good else BAD)[(i // 2 + k) % 2] for k in range(1 + i % 7)) + f" {i}"
        rows.append((i, text))
        labels.append((i, good, 0))
    labels += [(401, None, 0), (402, 7, None), (None, 1, 0), (403, 1, 0), (3, 1, 0)]
    return make_docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_quality_tells_good_from_bad(labelled):
    docs, labels = labelled
    found = quality.score(docs, quality.fit(docs, labels)).where("held_out").collect()
    assert len(found) > 40
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    assert sum(r["predicted"] == r["doc_id"] % 2 for r in found) >= 0.95 * len(found)


def test_quality_never_looks_at_held_out_labels(labelled):
    docs, labels = labelled
    turned = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (quality.score(docs, quality.fit(docs, x)).orderBy("doc_id").collect() for x in (labels, turned))
    assert one == two


def test_quality_edge_cases(labelled, make_docs, edge_rows):
    docs, labels = labelled
    model = quality.fit(docs, labels)
    found = quality.score(make_docs(edge_rows), model, keep=["lang", "_text"]).collect()
    assert len(found) == len(edge_rows) and all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["doc_id"] in (3, 4)}) == 1 and len({r["score"] for r in found if r["doc_id"] == 9}) == 1
    assert quality.score(make_docs([]), model).count() == 0
    for none in (labels.where("false"), labels.where("quality = 1")):
        scores = {r["score"] for r in quality.score(docs, quality.fit(docs, none)).collect()}
        assert len(scores) == 1 and (scores == {0.5} if none.count() == 0 else min(scores) > 0.9)


@pytest.fixture
def spoken(make_docs):
    rows = []
    for i in range(300):
        lang = list(WORDS)[i % 3]
        words = WORDS[lang].split()
        rows.append((i, " ".join(words[(i * k + k * k) % 8] for k in range(3 + i % 40)), lang))
    return make_docs([*rows, (900, "unlabelled text", None), (901, None, "de")])


def test_language_on_held_out_rows(spoken):
    model = language.fit(spoken)
    assert set(model.languages) == set(WORDS)
    found = language.predict(spoken, model, reject=False, keep=["lang"]).where("held_out AND lang IS NOT NULL AND doc_id < 900").collect()
    assert len(found) > 30 and all(r["lang_pred"] == r["lang"] and 0 <= r["score"] <= 1 for r in found)


def test_language_never_looks_at_held_out_rows(spoken):
    turned = spoken.withColumn("lang", F.when(held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert language.fit(turned) == language.fit(spoken)


def test_language_edge_cases(spoken, make_docs, edge_rows):
    model = language.fit(spoken)
    rows = [*edge_rows, (30, "12345 !! 678"), (31, "\U0001f600")]
    found = {r["doc_id"]: r for r in language.predict(make_docs(rows), model, reject=False).collect()}
    assert len(found) == len(rows) - 1
    for i, r in found.items():
        none = i in (3, 4, 5, 30, 31)
        assert (r["lang_pred"] == "und") == none and (r["score"] == 0) == none
    rejected = language.predict(make_docs(rows), model, narrow=0.9, reject=True).collect()
    assert all(r["lang_pred"] == "und" for r in rejected)
    assert language.predict(make_docs([]), model).count() == 0
    empty = language.fit(make_docs([]))
    assert {r["lang_pred"] for r in language.predict(make_docs([(1, "text")]), empty).collect()} == {"und"}


def test_queries_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    scored = QUERIES["op4_quality"](spark, folder).collect()
    assert len(scored) == 1000 and {type(r["held_out"]) for r in scored} == {bool}
    judged = [r for r in scored if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in judged) > 0.8 * len(judged)  # 46 bad texts to learn from
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    judged = [r for r in QUERIES["op10_language"](spark, folder).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in judged) > 0.92 * len(judged)


# ---------------------------------------------------------------- the classifiers in plain Python


def packer(content, level, trained):
    kind = zstandard.DICT_TYPE_AUTO if trained else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressor(
        level=level, dict_data=zstandard.ZstdCompressionDict(content, dict_type=kind),
        write_content_size=False, write_checksum=False, write_dict_id=False)


def plain_features(text, good, bad):
    data = (text or "").encode()
    g, b, n = len(good.compress(data)), len(bad.compress(data)), len(data)
    return [(b - g) / max(n, 1), (b - g) / max(g + b, 1), math.log1p(n), min(g, b) / max(n, 1)]


def test_quality_equals_plain_code(spark, labelled):
    """Dictionaries, calibration and every row's score, from the same sample with zstandard alone."""
    docs, labels = labelled
    model = quality.fit(docs, labels, per_label=10_000, excerpt=10_000)
    known = labels.where("quality IN (0, 1)").select("doc_id", "quality").distinct()
    sample = docs.where(~held_out()).where("text IS NOT NULL").join(known, "doc_id").withColumn("h", F.xxhash64(F.lit("even_sample"), "doc_id", "text"))
    rows = sorted(sample.select("doc_id", "text", "quality", "h", (F.xxhash64(F.lit("half"), "h") >= 0).alias("train")).collect(), key=lambda r: r["h"])
    packers = []
    for y, content in ((1, model.good), (0, model.bad)):
        texts = [r["text"].encode() for r in rows if r["train"] and r["quality"] == y]
        size = min(262_144, max(256, len(b"\n".join(texts)) // 3))
        assert content == zstandard.train_dictionary(size, texts, level=3).as_bytes()
        packers.append(packer(content, 3, True))
    rest = [r for r in rows if not r["train"]]
    x = [plain_features(r["text"], *packers) for r in rest]
    y = [r["quality"] for r in rest]
    centre = [sum(c) / len(x) for c in zip(*x)]
    scale = [max(math.sqrt(sum((v - m) ** 2 for v in c) / len(x)), 1e-9) for c, m in zip(zip(*x), centre)]
    assert model.centre == pytest.approx(centre) and model.scale == pytest.approx(scale)

    def chance(row):
        return 1 / (1 + math.exp(-max(-40, min(40, model.weights[0] + sum(w * (v - m) / s for w, v, m, s in zip(model.weights[1:], row, centre, scale))))))

    totals = {r["quality"]: r["n"] for r in known.where(~held_out()).groupBy("quality").agg(F.count("*").alias("n")).collect()}
    share = (totals[1] + 0.5) / (sum(totals.values()) + 1)
    weight = {1: share / sum(y) * len(y), 0: (1 - share) / (len(y) - sum(y)) * len(y)}
    # At the fitted weights the gradient of the weighted likelihood and its ridge is zero.
    for k in range(5):
        columns = [1.0 if k == 0 else (row[k - 1] - centre[k - 1]) / scale[k - 1] for row in x]
        slope = sum(weight[t] * (chance(row) - t) * c for row, t, c in zip(x, y, columns)) + 0.01 * model.weights[k]
        assert abs(slope) < 1e-3
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = quality.score(docs, model).collect()
    for r in got:
        want = chance(plain_features(texts[r["doc_id"]], *packers))
        assert r["score"] == pytest.approx(want, abs=1e-12) and r["predicted"] == (want >= 0.3)


def test_language_equals_plain_code(spark, spoken):
    model = language.fit(spoken, per_language=10_000, excerpt=10_000)
    plain = lambda t: re.sub(rb"[\x00-@\[-`{-\x7f]", b" ", t.lower().encode())
    rows = spoken.where(~held_out()).where("lang IS NOT NULL AND text IS NOT NULL").withColumn("h", F.xxhash64(F.lit("even_sample"), "doc_id", "text")).collect()
    by = {}
    for r in sorted(rows, key=lambda r: r["h"]):
        by.setdefault(r["lang"], []).append(plain(r["text"]))
    order = sorted(by, key=lambda k: (-len(by[k]), k))
    assert model.languages == tuple(order) and model.contents == tuple(b"\n".join(by[k])[:409_600] for k in order)
    packers = [packer(c, 3, False) for c in model.contents]
    texts = {r["doc_id"]: r["text"] for r in spoken.collect()}
    for r in language.predict(spoken, model, reject=False).collect():
        if not texts[r["doc_id"]]:
            assert (r["lang_pred"], r["score"]) == ("und", 0)
            continue
        sizes = [len(p.compress(plain(texts[r["doc_id"]]))) for p in packers]
        first, second = sorted(sizes)[:2]
        margin = (second - first) / second
        assert r["lang_pred"] == order[sizes.index(first)] and r["narrow"] == (margin < language.NARROW)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-min(40, 50 * margin))))
