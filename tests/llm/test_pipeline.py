import pathlib
import re

import pytest

import corpus_pipeline
from bizops.llm import scratch as scratch_module
from bizops.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """[(name, rows in, rows out), ...], each stage on what the one before wrote."""
    base, out = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{base}/{number}")
        after = spark.read.parquet(f"{base}/{number}")
        out.append((name, docs, after))
        docs = after
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_keep_the_columns(steps):
    for _, before, after in steps[:-1]:
        assert before.dtypes == after.dtypes


def test_quality_stage(spark, steps):
    _, before, after = steps[0]
    kept = {r["doc_id"] for r in QUERIES["op4_quality"](spark, FOLDER).where("predicted = 1").select("doc_id").collect()}
    assert set(ids(after)) == kept and 0.6 * before.count() < len(kept) < before.count()


def test_dedup_stage(steps):
    from test_simhash import plain_components, plain_fingerprint

    _, before, after = steps[1]
    prints = {(r["doc_id"], plain_fingerprint(r["text"])) for r in before.select("doc_id", "text").collect()}
    assert ids(after) == sorted(set(plain_components(prints).values())) and after.count() < before.count()


def test_decontamination_stage(spark, steps):
    from test_search import plain_contamination

    _, before, after = steps[2]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [tuple(r) for r in before.select("doc_id", "text").collect()]
    assert ids(after) == sorted(r[0] for r in plain_contamination(docs, items) if not r[-1])


def test_mixing_stage(steps):
    from test_mixing import plain_mix

    _, before, after = steps[3]
    rows = [tuple(r) for r in before.select("doc_id", "text", "source").collect()]
    taken = plain_mix(rows)[0]
    want = []
    for i, text, _ in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        want += [i] * (taken[i] // n if n else 0)
    assert ids(after) == sorted(want)


def test_token_stage(steps):
    from test_tokens import expected

    _, before, after = steps[4]
    rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
    assert sorted(map(tuple, after.collect())) == sorted(expected(rows))


def test_run_is_the_stages_and_leaves_nothing(spark, steps):
    got = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, steps[-1][2].collect()))
    fs, path = scratch_module.storage(scratch_module.use_checkpoint_dir(spark))
    from pyarrow.fs import FileSelector

    left = [i.path for i in fs.get_file_info(FileSelector(path)) if re.search("/(pipeline|stage|simhash|token|mix|secrets|warc|top-k|decontaminate)-[a-z-]*[0-9a-f]{32}$", i.path)]
    assert not left


def test_a_failing_query_leaves_nothing(spark, monkeypatch):
    from bizops.llm import importance

    def lost(*_):
        raise RuntimeError("lost")

    fs, path = scratch_module.storage(scratch_module.use_checkpoint_dir(spark))
    from pyarrow.fs import FileSelector

    monkeypatch.setattr(importance, "histogram", lost)  # the features are written by then
    with pytest.raises(RuntimeError, match="lost"):
        QUERIES["op12_importance"](spark, "/root/testdata/sf0.001")
    assert not [i.path for i in fs.get_file_info(FileSelector(path)) if "importance-" in i.path]


def test_stages_on_rows_without_ids_or_text(spark, make_docs, tmp_path):
    spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, "alpha beta"), (1, "alpha beta"), (None, "alpha beta"), (None, "other words"), (None, "other words"), (2, None), (3, ""), (None, None)]
    docs = make_docs(rows)
    once = corpus_pipeline.keep_one_of_each_group(spark, docs, str(tmp_path))
    assert once.dtypes == docs.dtypes
    texts = sorted(r["text"] or "" for r in once.collect())
    assert texts == ["", "alpha beta", "other words"]
    for _, stage in corpus_pipeline.STAGES:
        for some in (docs, make_docs([])):
            assert stage(spark, some, str(tmp_path)).count() <= 3 * len(rows)
    assert corpus_pipeline.drop_benchmark_passages(spark, docs, str(tmp_path)).count() == len(rows)


def test_sources_keep_to_the_rules():
    root = pathlib.Path(corpus_pipeline.__file__).parent
    for path in [root / "corpus_pipeline.py", *(root / "bizops" / "llm").glob("*.py")]:
        text = path.read_text(encoding="utf-8")
        assert not re.search(r"localCheckpoint|toPandas|crossJoin|\.rdd\b|\.sample\(|tempfile", text), path
    for name in ("secretscan", "mixing", "urlfilter"):
        text = (root / "bizops" / "llm" / f"{name}.py").read_text(encoding="utf-8")
        assert not re.search(r"pandas|Arrow|InPandas|udf|numpy", text), name
