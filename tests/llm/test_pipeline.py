"""The corpus pipeline, stage by stage against brute force."""

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from estate.llm import byte_bpe, secret_scan
from estate.session import shared_dir
from test_decontaminate import brute as leaked
from test_minhash import brute as grouped

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage got and gave."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SMALL).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    for name in ("quality", "near_duplicates", "decontamination", "secrets"):
        assert stages[name].dtypes == stages["documents"].dtypes


def test_quality_keeps_clean_documents(spark, stages):
    kept = set(by_id(stages["quality"]))
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    clean = [r.doc_id in kept for r in labels if r.quality == 1 and r.toxic == 0]
    bad = [r.doc_id in kept for r in labels if r.quality == 0 or r.toxic == 1]
    assert sum(clean) / len(clean) > 0.99 and sum(bad) / len(bad) < 0.15   # 400 labels only


def test_one_of_each_group_stays(stages):
    docs = [(r.doc_id, r.text) for r in stages["quality"].collect()]
    _, component = grouped(docs, 5, 80)
    assert set(by_id(stages["near_duplicates"])) == {i for i, c in component.items() if i == c}
    assert len(set(component.values())) < len(docs)


def test_leaks_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = by_id(stages["decontamination"])
    squeeze = __import__("test_decontaminate").squeezed
    texts = {i: r.text for i, r in by_id(stages["near_duplicates"]).items()}
    for i, t in texts.items():
        inside = any(squeeze(x) in squeeze(t) for _, x in items)
        assert not (inside and i in kept)
        if i not in kept:
            assert leaked(t, items)
    assert 0 < len(texts) - len(kept) < 0.1 * len(texts)


def test_secrets_are_masked(stages):
    before, after = by_id(stages["decontamination"]), by_id(stages["secrets"])
    assert before.keys() == after.keys()
    assert any(secret_scan.find(r.text.encode()) for r in before.values())
    for i, r in after.items():
        assert not secret_scan.find(r.text.encode()) and r.n_chars == len(r.text)
        if not secret_scan.find(before[i].text.encode()):
            assert r == before[i]


def test_tokens(stages):
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    before, after = by_id(stages["secrets"]), by_id(stages["tokens"])
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert r.exact and r.ids == lib.encode_ordinary(before[i].text) and r.n_tokens == len(r.ids)


def test_run_is_registered(spark, stages):
    got = entry.queries()["pipeline"](spark, SMALL)
    assert sorted(map(tuple, got.select("doc_id", "n_tokens").collect())) == sorted(map(tuple, stages["tokens"].select("doc_id", "n_tokens").collect()))


def test_odd_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    text = docs.first().text
    rows = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (None, "lone", "en", "s", 4), (3, text, "en", "s", 1),
                                  (3, text, "en", "s", 1), (4, text, None, "t", 1)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, SMALL)
        rows.write.parquet(path := f"{shared_dir(spark)}/odd-{name}-{id(rows)}")
        rows = spark.read.parquet(path)
    got = sorted((str(r.doc_id), r.n_tokens > 0, r.exact) for r in rows.collect())
    assert got == [("1", False, True), ("2", False, True), ("3", True, True), ("None", True, True)]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SMALL)
    assert empty.collect() == []
