"""The stages of the pipeline on rows without a doc_id and rows that share one."""

import collections

import corpus_pipeline
from conftest import *  # noqa: F403

FOLDER = "/root/testdata/sf0.001"


def texts_after(stage, spark, docs):
    rows = stage(spark, docs, FOLDER)
    assert rows.columns == docs.columns
    return collections.Counter((row.doc_id, row.text) for row in rows.collect())


def test_masks_keep_to_their_own_text(spark, documents):
    rows = [
        (None, "my mail is a.b@c.de today"),
        (None, "write from 10.0.0.1 or to x@y.example, please"),
        (None, "nothing of that kind is to be found here"),
        (None, None),
        (7, "card 4111 1111 1111 1111 is mine"),
        (7, "the other text of seven, sent by q@r.example"),
        (7, "the other text of seven, sent by q@r.example"),
    ]
    assert texts_after(corpus_pipeline.mask_personal_data, spark, documents(rows)) == {
        (None, "my mail is <email> today"): 1,
        (None, "write from <ip> or to <email>, please"): 1,
        (None, rows[2][1]): 1,
        (None, None): 1,
        (7, "card <card> is mine"): 1,
        (7, "the other text of seven, sent by <email>"): 2,
    }


def test_filters_decide_about_rows(spark, documents):
    item = next(row.text for row in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect() if len(row.text.split()) > 12)
    leak = f"before it {item} after it"
    rows = [(None, leak), (None, "clean words of no id"), (7, leak), (7, "clean words of seven"), (7, "other words of seven")]
    kept = texts_after(corpus_pipeline.drop_contaminated, spark, documents(rows))
    assert kept == {(None, rows[1][1]): 1, (7, rows[3][1]): 1, (7, rows[4][1]): 1}


def test_toxic_rows_go_whatever_their_id(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    predicted = corpus_pipeline.score_toxicity(docs, corpus_pipeline.train(corpus_pipeline.labelled(spark, docs, FOLDER)))
    good = {row.doc_id for row in predicted.where("predicted = 0").collect()}
    texts = {row.doc_id: row.text for row in docs.collect()}
    bad = set(texts) - good
    assert bad and good
    shared = docs.selectExpr("CASE WHEN doc_id = 0 THEN 0 END AS doc_id", *[f"`{c}`" for c in docs.columns if c != "doc_id"])
    # The labels of the models belong to ids, so the ids are taken away behind the training.
    train, corpus_pipeline.train = corpus_pipeline.train, lambda _: train(corpus_pipeline.labelled(spark, docs, FOLDER))
    try:
        kept = corpus_pipeline.drop_toxic(spark, shared, FOLDER).collect()
    finally:
        corpus_pipeline.train = train
    assert collections.Counter(row.text for row in kept) == collections.Counter(texts[i] for i in good)


def test_one_row_of_each_group_stays(spark, documents):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [
        (None, long),
        (None, f"{long} more"),
        (4, f"{long} words"),
        (9, long),
        (None, "a text that has no id and no copy"),
        (None, "a copy among rows of no id"),
        (None, "a copy among rows of no id"),
        (5, "the first text of five"),
        (5, "a second one, quite unlike it"),
        (5, "a second one, quite unlike it"),
        (None, None),
        (None, " \n"),
        (None, " \n"),
        (6, ""),
        (6, ""),
    ]
    assert texts_after(corpus_pipeline.drop_near_copies, spark, documents(rows)) == {
        (4, rows[2][1]): 1,
        (None, rows[4][1]): 1,
        (None, rows[5][1]): 1,
        (5, rows[7][1]): 1,
        (5, rows[8][1]): 1,
        (None, None): 1,
        (None, " \n"): 2,
        (6, ""): 1,
    }


CLASHES = "kept found code spans id key first last row batch size toxic score component_id contaminated slot curve".split()


def test_stages_bear_clashing_names_and_empty_tables(spark):
    schema = ", ".join(["doc_id bigint, text string, lang string, source string, n_chars bigint", *(f"{c} string" for c in CLASHES)])
    tail = ("en", "s", 9, *CLASHES)
    rows = [(1, "write to a.b@c.de now", *tail), (2, "some other words are here", *tail), (None, None, *tail), (3, "", *tail)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, FOLDER)
            assert out.columns == docs.columns
            found = out.collect()
            assert len(found) == docs.count(), name
            assert all(row[c] == c for row in found for c in CLASHES)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()
