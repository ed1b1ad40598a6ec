"""Copies of a text are weighed and clustered once, and count as many as they are."""

from pyspark.sql import functions as F

from snaptrend.operators.clusters import folded, k_means
from snaptrend.operators.subtopics import (
    cluster_phrases, clustered_texts, distinct_texts, labels_of_copies, term_weights,
)

STOPS = ["the", "a"]
TEXTS = ["red apple the pie", "red apple", "blue sky over", "blue sky", "", None]


def docs_of(spark, times):
    rows = [("m", i, TEXTS[i % len(TEXTS)]) for i in range(len(TEXTS) * times)]
    return spark.createDataFrame(rows, "macro string, id long, text string")


def test_weights_count_copies(spark):
    docs = docs_of(spark, 20)
    every = {(r.id, r.term): r.weight for r in term_weights(docs, ["macro"], "id", "text", STOPS).collect()}
    texts, members = distinct_texts(docs, ["macro"], "id", "text")
    once = term_weights(texts, ["macro"], "id", "text", STOPS, copies="copies")
    got = {(r.id, r.term): r.weight for r in once.collect()}
    assert {i for i, _ in got} == {0, 1, 2, 3} and len(got) * 20 == len(every)
    assert all(abs(w - every[k]) < 1e-12 for k, w in got.items())
    assert {r.id: r.first for r in members.collect()} == {i: min(i % 6, 4) for i in range(120)}

    label = F.when(F.col("id") % 6 < 2, 0).otherwise(1).alias("label")
    said = lambda rows: sorted((r.label, tuple(r.phrases), tuple(r.scores)) for r in rows.collect())
    alone = texts.select("macro", "id", label, "copies")
    assert said(cluster_phrases(once, alone, ["macro"], "id", copies="copies")) == said(
        cluster_phrases(term_weights(docs, ["macro"], "id", "text", STOPS), docs.select("macro", "id", label), ["macro"], "id")
    )
    back = labels_of_copies(alone, members, ["macro"], "id")
    assert {r.id: r.label for r in back.collect()} == {i: 0 if i % 6 < 2 else 1 for i in range(120)}


def test_copies_are_clustered_once(spark):
    docs = docs_of(spark, 30).where("text != ''")
    labels = {r.id: r.label for r in clustered_texts(docs, ["macro"], "id", "text", STOPS, starts=4).collect()}
    assert len(labels) == 120 and all(labels[i] == labels[i % 6] for i in labels)
    assert labels[0] == 0 and sorted(set(labels.values())) == list(range(len(set(labels.values()))))


def test_copies_weigh_in_the_centres(spark):
    # Two clusters on a line of angles: a heavy document keeps the centre with it, which its neighbour then leaves.
    import math

    at = {1: 0.0, 2: 0.5, 3: 0.9}
    rows = [("g", i, t, w) for i, x in at.items() for t, w in (("x", math.cos(x)), ("y", math.sin(x)))]
    weights = spark.createDataFrame(rows, "g string, id long, term string, weight double")
    docs = lambda n: spark.createDataFrame([("g", 1, n), ("g", 2, 1), ("g", 3, 1)], "g string, id long, n long")
    for n in (1, 50):
        labels = {r.id: r.label for r in k_means(weights, docs(n), ["g"], "id", clusters=2, starts=4, copies="n").collect()}
        assert labels == {1: 0, 2: 1, 3: 1}


def test_equal_columns_fold(spark):
    rows = [("g", d, f"t{j}", 0.5) for d in (1, 2) for j in range(3)] + [("g", 1, "own", 0.25), ("g", 1, "own too", 0.25), ("g", 2, "t0 x", 0.5)]
    weights = spark.createDataFrame(rows, "g string, id long, term string, weight double")
    got = {(r.term, r._n, r._m) for r in folded(weights, ["g"], "id").collect()}
    assert got == {("t0", 2, 3), ("own", 1, 2), ("t0 x", 1, 1)}


def test_groups_without_terms_have_one_label(spark):
    docs = spark.createDataFrame([("g", 1, "x"), ("g", 2, "y"), ("h", 3, "the"), ("h", 4, "a the")], "g string, id long, text string")
    got = {r.id: r.label for r in clustered_texts(docs, ["g"], "id", "text", STOPS, starts=2).collect()}
    assert set(got) == {1, 2, 3, 4} and got[3] == got[4] == 0
