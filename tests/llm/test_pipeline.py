import corpus_pipeline
from stintflow.llm import leaks
from stintflow.sources.shared import stage

from . import cases
from .test_leaks import brute as leaked
from .test_minmax import brute as linked
from .test_private import brute as private_spans
from .test_quality import brute as measured


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{cases.SMALL}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{cases.SMALL}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = [[(k, t) for k, t in rows if measured(t)[-1]]]
    kept = {k for k, _, _, good in linked(expected[0], 5) if good}
    expected.append([(k, t) for k, t in expected[0] if k in kept])
    expected.append([(k, t) for (k, t), found in zip(expected[1], leaked(expected[1], bench)) if not found[-1]])
    for (name, step), want in zip(corpus_pipeline.STAGES, expected):
        docs = stage(step(spark, docs, cases.SMALL))
        assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(want), name
    docs = stage(corpus_pipeline.STAGES[3][1](spark, docs, cases.SMALL))
    masked = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == list(corpus_pipeline.COLUMNS) and set(masked) == {k for k, _ in expected[2]}
    for key, text in expected[2]:
        assert (masked[key].text == text) == (private_spans(text)[-1] == "") and masked[key].n_chars == len(masked[key].text)
    packed = corpus_pipeline.STAGES[4][1](spark, docs, cases.SMALL).collect()
    assert {r.doc_id for r in packed} == set(masked)
    assert sorted(map(tuple, corpus_pipeline.run(spark, cases.SMALL).select("doc_id", "piece", "ids_crc32").collect())) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed)


def test_awkward_and_empty_tables(spark):
    for docs in (cases.documents(spark), cases.awkward(spark), cases.empty(spark)):
        for _, step in corpus_pipeline.STAGES:
            docs = stage(step(spark, docs, cases.SMALL))
        docs.count()


def test_registered(spark):
    import __spark_entry__ as entry
    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {k if k == "pipeline" else k.split("_")[0] + "_" for k in entry.queries()}
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert leaks.WINDOW_WORDS == 10
