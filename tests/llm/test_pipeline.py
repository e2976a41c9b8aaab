import corpus_pipeline
from driftscan.llm import secrets
from driftscan.session import load, materialize


def test_stages_one_by_one(spark, sf):
    docs = load(spark, sf, "documents")
    extra = spark.createDataFrame([(10_001, None, "en", "s", 0), (10_002, "12 34", "en", "s", 5), (None, docs.first()["text"], "en", "s", 9)], docs.schema)
    now = materialize(docs.unionByName(extra), "in")
    texts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, now, sf), name)
        assert out.dtypes == docs.dtypes, name
        texts.append((name, now, out))
        now = out
    before, after = texts[0][1:]
    assert {r["doc_id"] for r in before.join(after.select("doc_id"), "doc_id", "left_anti").filter("doc_id is not null").collect()} == {10_001, 10_002}
    before, after = texts[1][1:]
    assert after.select("text").distinct().count() >= before.select("text").distinct().count() * 0.9
    assert after.filter("doc_id is not null").groupBy("text").count().filter("count > 1").count() == 0
    before, after = texts[2][1:]
    assert before.count() == after.count() and secrets.find_secrets(after).filter("size(base) > 0").count() == 0
    before, after = texts[3][1:]
    labels = load(spark, sf, "labels")
    clean = before.join(labels.filter("quality = 1 and toxic = 0"), "doc_id", "left_semi")
    assert clean.join(after, "doc_id", "left_semi").count() >= 0.95 * clean.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, sf)
    assert pieces.select("doc_id").distinct().count() == now.select("doc_id").distinct().count()


def test_run_on_smallest(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0
