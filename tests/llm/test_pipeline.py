"""The corpus pipeline stage by stage on a small table."""

import corpus_pipeline
from clientele.llm import pii, queries
from clientele.llm.common import components, table
from clientele.session import truncate

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = truncate(stage(spark, docs, SF))
        assert docs.columns == columns, name
        seen.append(docs.count())
        if name == "toxicity":
            toxic = table(spark, SF, "labels").where("toxic = 1")
            left = docs.join(toxic, "doc_id").count()
            assert left <= 0.35 * table(spark, SF, "documents").join(toxic, "doc_id").count()
        if name == "simhash_near_dedup":
            assert docs.select("doc_id").distinct().count() == docs.count()
        if name == "pii":
            texts = [r.text for r in docs.select("text").collect()]
            assert not any(pii.base_spans(t) for t in texts if t) and any("[EMAIL]" in t for t in texts)
    assert seen[0] > seen[1] > seen[2] == seen[3]
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert encoded.count() == seen[4]


def test_stages_keep_extra_columns_and_different_texts_of_one_id(spark):
    rows = [(1, "first text of some words here", "a"), (1, "another one that is not alike at all", "a"), (1, "first text of some words here", "a"),
            (2, None, None), (3, "", "b"), (None, "without id", "b"), (None, "without id", "b")]
    docs = spark.createDataFrame([(*r, "en", 1, 7, 8) for r in rows],
                                 "doc_id long, text string, source string, lang string, n_chars int, _score int, kept_id int")
    left = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert left.columns == docs.columns and left.count() == len(rows)
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    found = sorted((r.doc_id or -1, r.text or "") for r in kept.collect())
    # the empty and the null text have the same fingerprint, so the smaller id stays
    assert found == [(-1, "without id"), (-1, "without id"), (1, "another one that is not alike at all"),
                     (1, "first text of some words here"), (2, "")]
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), SF).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 1000 for i in range(1000, 1050))


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
