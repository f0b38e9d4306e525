from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from accountloom.llm import language, quality, simhash
from accountloom.llm.common import table
from tests.llm.support import SF
from tests.llm.test_packing import check
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_suffixes import plain as plain_suffixes

NAMES = ["language ID", "quality rules", "SimHash near-dedup", "suffix-array dedup", "packing"]


@pytest.fixture(scope="module")
def stages(spark):
    out = [table(spark, SF, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.stored(stage(spark, out[-1], SF), "test-stage"))
    return out


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES and corpus_pipeline.ORACLE_SQL is None


def test_stages_keep_the_columns(stages):
    assert all(s.dtypes == stages[0].dtypes for s in stages[1:-1])


def test_each_stage_against_its_operator(spark, stages):
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in stages]
    found = language.identified(stages[0]).filter("lang_pred <> 'und' AND score >= 0.3")
    assert ids[1] == {r.doc_id for r in found.select("doc_id").collect()}
    trusted = quality.trusted_ids(table(spark, SF, "labels"))
    assert ids[2] == {r.doc_id for r in quality.judged(stages[1], trusted).filter("kept").collect()}
    texts = {r.doc_id: r.text for r in stages[2].collect()}
    labels = plain_components({i: plain_fingerprint(t) for i, t in texts.items()})
    assert ids[3] == {i for i in texts if labels[i] == i}
    wanted = {i: kept.decode("utf-8", "ignore") for i, kept, _, _ in plain_suffixes([(i, texts[i]) for i in ids[3]])}
    assert {r.doc_id: r.text for r in stages[4].collect()} == wanted
    assert all(r.n_chars == len(r.text) for r in stages[4].collect())
    check(stages[5].collect(), list(wanted.items()))


def test_run_and_empty_table(spark, stages, tmp_path):
    rows = corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sorted(rows.collect()) == sorted(stages[5].select(rows.columns).collect())
    stages[0].limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, SF, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_odd_documents_pass_through(spark, tmp_path):
    docs = table(spark, SF, "documents")
    nulls = docs.limit(3).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), *[F.lit(None).cast(k).alias(c) for c, k in docs.dtypes[2:]])
    extra = docs.unionByName(docs.limit(5)).unionByName(nulls).withColumn("kept", F.lit(1)).withColumn("fp", F.lit("x"))
    extra.write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, SF, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.filter("doc_id IS NULL").count() == 0 and found.count() > 0


def test_clean_labelled_documents_are_kept(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    good = table(spark, sf, "labels").filter("quality = 1 AND toxic = 0").select("doc_id")
    kept = corpus_pipeline.good_quality(spark, corpus_pipeline.known_language(spark, docs, sf), sf)
    long = docs.join(good, "doc_id", "left_semi").filter("size(split(text, ' ')) >= 25")
    assert kept.join(long.select("doc_id"), "doc_id", "left_semi").count() >= 0.99 * long.count()
    assert simhash.RADIUS == 2 and simhash.SHINGLE_WORDS == 3
