from __future__ import annotations

from pathlib import Path

import corpora
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from martwright.llm import common, exact_dedup, near_dedup, pii, quality
from martwright.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables are absent")


def test_each_stage_works_on_what_its_predecessor_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF_DIR)
        result.write.parquet(f"{tmp_path}/{name}")
        result = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs, result
        if name != "packing":
            assert result.columns == columns
        docs = result
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}

    source, good = kept["quality rules"]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    judged = quality.judge(source, quality.fit(source, labels))
    assert ids(good) == ids(judged.where("kept"))
    source, one = kept["exact dedup"]
    assert ids(one) == ids(exact_dedup.exact_dedup(source).where("kept"))
    source, one = kept["near-dedup"]
    assert ids(one) == ids(near_dedup.near_duplicates(source, percent=corpus_pipeline.NEAR_PERCENT).where("kept"))
    source, masked = kept["personal data"]
    assert ids(masked) == ids(source)
    assert all(not pii.base_spans(r.text) and r.n_chars == len(r.text) for r in masked.collect())
    source, packed = kept["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in source.collect()}
    assert {r.doc_id: r.n for r in packed.groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect()} == sizes


def test_run_is_the_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near-dedup", "personal data", "packing"]
    assert "sequence_id" in corpus_pipeline.run(spark, SF_DIR).columns


def test_stages_on_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    spark.read.parquet(f"{SF_DIR}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, name):
    from check_oracle import connect, difference

    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) is None


def test_odd_documents_through_all_stages(spark, odd, tmp_path):
    docs = odd.select("doc_id", "text", "kept", "row").selectExpr("*", "'en' AS lang", "'s' AS source", "cast(0 AS long) AS n_chars")
    spark.createDataFrame([(14, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert {r.doc_id for r in docs.collect()} <= {i for i, _ in corpora.odd_rows()}
    assert {11, 14} <= {r.doc_id for r in docs.collect()}


def test_a_worker_gives_memory_back_at_a_tasks_end(monkeypatch):
    given_back = []

    class Pool:
        def release_unused(self):
            given_back.append(True)

    monkeypatch.setattr(common.pa, "system_memory_pool", Pool)
    whole = common.released(iter)([1, 2])
    assert next(whole) == 1 and not given_back
    assert list(whole) == [2] and given_back
    part = common.released(iter)([1, 2])
    next(part)
    part.close()
    assert len(given_back) == 2
