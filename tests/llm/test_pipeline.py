import corpus_pipeline
from dugout.llm import decontaminate, jaccard_join, toxicity


def test_stages(spark, small_dir, tmp_path):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    labels, items = (spark.read.parquet(f"{small_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "token_pack"]
    now = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = now
        stage(spark, before, small_dir).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        if i < 4:
            assert now.columns == docs.columns
        a, b = {r["doc_id"] for r in before.collect()}, {r["doc_id"] for r in now.collect()}
        assert b <= a
        if name == "toxicity":
            bad = {r["doc_id"] for r in toxicity.score(before, toxicity.fit(before, toxicity.with_categories(labels))).where("toxic").collect()}
            assert bad and a - b == bad
        if name == "ngram_jaccard_join":
            classes = {r["doc_id"]: r["class_id"] for r in jaccard_join.similar_documents(before).collect()}
            assert b == set(classes.values()) and now.count() == len(b) < len(a)
        if name == "benchmark_decontamination":
            bad = {r["doc_id"] for r in decontaminate.contaminated(before, items).collect()}
            assert bad and a - b == bad
        if name == "token_pack":
            assert now.count() == before.count()
            rows = now.orderBy("start").collect()
            at = 0
            for r in rows:
                assert r["start"] == at
                at += r["n_tokens"]


def test_run_equals_stages(spark, small_dir):
    rows = corpus_pipeline.run(spark, small_dir).collect()
    assert rows and {"doc_id", "start", "n_tokens", "ids_crc32"} <= set(rows[0].asDict())


def test_pipeline_on_odd_rows(spark, weird, tmp_path, small_dir):
    docs = weird
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small_dir)
        assert out.count() >= 1
        docs = out if "text" in out.columns else docs
