import corpus_pipeline
from verdance.llm import queries


def write(spark, path, docs, labels):
    docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_on_odd_rows(spark, docs, labelled, tmp_path):
    d = write(spark, tmp_path, docs, labelled[1])
    now = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, d)
        out.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == docs.columns
    assert now.count() > 0
    assert corpus_pipeline.run(spark, d).count() == now.count()


def test_empty_documents(spark, no_docs, no_labels, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, tmp_path, no_docs, no_labels)).count() == 0


def test_stage_effects(spark, labelled, tmp_path):
    d = write(spark, tmp_path, *labelled)
    docs = labelled[0]
    truth = {r.doc_id: r for r in labelled[1].where("doc_id is not null and toxic is not null").collect()}
    clean = {r.doc_id for r in corpus_pipeline.toxic_stage(spark, docs, d).collect()}
    good = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, d).collect()}
    wrong = sum((i in clean) == bool(truth[i].toxic) for i in range(600) if i in truth)
    poor = sum((i in good) != bool(truth[i].quality) for i in range(600) if i in truth)
    assert wrong <= 12 and poor <= 12


def test_every_operator_is_registered():
    names = queries.queries()
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 11)}
    assert set(queries.oracle_sql()) <= set(names)
