"""Phrases of known labels: equal to the weighed rows, without moving them."""

import pytest
from pyspark.sql import functions as F

from snaptrend.operators import phrases, subtopics
from workload.registry import QUERIES

STOPS = ["the", "and"]


def both(spark, docs, **settings):
    weights = subtopics.term_weights(docs, ["g"], "id", "text", STOPS)
    labels = docs.select("g", "id", "label").where("id is not null and label is not null")
    # All documents of a label count in its mean.
    slow = subtopics.cluster_phrases(weights, labels, ["g"], "id")
    fast = phrases.label_phrases(docs, ["g"], "id", "text", STOPS, **settings)
    said = lambda rows: {(r.g, r.label): (list(r.phrases), [round(x, 9) for x in r.scores]) for r in rows.collect()}
    return said(slow), said(fast)


def docs_of(spark):
    rows = []
    for i in range(120):
        own = " ".join(f"w{(i * k) % 17}x" for k in range(1, 9))
        text = f"the apple pie {own} and apple {'tart' if i % 3 else 'cake'} ab 日本 {'common ' * (i % 4)}"
        rows.append((i, f"g{i % 2}", "rare" if i == 7 else f"l{i % 3}", None if i % 40 == 5 else text))
    rows += [(200, None, "l0", "apple pie"), (201, "g0", None, "apple w1x w2x nothing else"), (202, "empty", "l0", "the and"), (203, "empty", "l1", "")]
    return spark.createDataFrame(rows, "id long, g string, label string, text string")


@pytest.mark.parametrize("rare", [0.0, 0.005, 0.9])
def test_equal_to_the_weighed_rows(spark, monkeypatch, rare):
    """A first limit that is too high is taken back, so what is left out cannot be among the best."""
    monkeypatch.setattr(phrases, "RARE", rare)
    slow, fast = both(spark, docs_of(spark))
    assert slow == fast and ("g1", "rare") in fast and ("empty", "l0") not in fast


def test_many_blocks_and_parts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHARS", 300)
    monkeypatch.setattr(phrases, "PART", 200)
    slow, fast = both(spark, docs_of(spark))
    assert slow == fast


def test_odd_rows(spark):
    docs = docs_of(spark).where("g = 'g0'").limit(3).unionByName(docs_of(spark).where("false"))
    slow, fast = both(spark, docs)
    assert slow == fast
    assert phrases.label_phrases(docs.where("false"), ["g"], "id", "text", STOPS).count() == 0
    assert phrases.label_phrases(docs.withColumn("text", F.lit(None).cast("string")), ["g"], "id", "text", STOPS).count() == 0


def test_query_moves_no_term_rows(spark, monkeypatch):
    """The counts of every (document, term) were stored and shuffled; now a block sends each of its terms once."""
    def refuse(*_, **__):
        raise AssertionError("rows of documents and terms")

    monkeypatch.setattr(subtopics, "term_counts", refuse)
    assert QUERIES["cluster_top_phrases"](spark, "/root/testdata/sf0.001").count() > 0
