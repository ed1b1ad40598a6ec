"""Clusters of texts from packed cells are those of the weights, without a row for every term of every document."""

import random

import numpy as np
from pyspark.sql import functions as F

from snaptrend.operators import clusters, subtopics, text_cells
from snaptrend.operators.clusters import k_means, laid, packed_bytes, unpacked_numbers
from snaptrend.operators.subtopics import clustered_texts, distinct_texts, term_weights

STOPS = ["the", "a"]


def texts_of(n, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    said = lambda k: " ".join(rng.choice(words[10 * k : 10 * k + 25]) for _ in range(rng.randint(1, 40)))
    out = [said(rng.randrange(4)) for _ in range(n)]
    # Copies, near copies, texts without a term and one without text.
    return [*out, *out[: n // 8], *(f"{x} also" for x in out[: n // 8]), "", "the a", None]


def docs_of(spark, n=160):
    rows = [(g, 1000 * k + i, x) for k, g in enumerate("gh") for i, x in enumerate(texts_of(n // (k + 1), k))]
    return spark.createDataFrame(rows, "g string, id long, text string")


def vectors(cells, blocks):
    """Inner products of all documents of a group, by block and place."""
    held, scale, own = {}, {}, {}
    for r in blocks.collect():
        for i, (x, o) in enumerate(zip(unpacked_numbers(r.x), unpacked_numbers(r.own))):
            scale[r._g, r.block, i], own[r._g, r.block, i] = x, o
    by = {(r._g, r.part): unpacked_numbers(r.x) for r in cells.where("part >= 0 and block < 0").collect()}
    for r in cells.where("part >= 0 and block >= 0").collect():
        t, n, x = np.cumsum(unpacked_numbers(r.t), dtype=np.int32), unpacked_numbers(r.n), unpacked_numbers(r.x)
        for i, t, x in zip(np.repeat(np.arange(len(n)), n), t, x):
            key = (r._g, r.block, int(i))
            held.setdefault(key, {})[r.part, t] = x * by[r._g, r.part][t] * scale[key]
    return held, scale, own


def small(monkeypatch):
    """Many blocks and parts for few texts."""
    monkeypatch.setattr(clusters, "CHARS", 2000)
    monkeypatch.setattr(clusters, "PART", 1500)


def test_cells_hold_the_weights(spark, monkeypatch):
    small(monkeypatch)
    docs = docs_of(spark)
    texts, _ = distinct_texts(docs, ["g"], "id", "text")
    chars = docs.groupBy("g").agg(F.sum(F.char_length("text")).alias("_chars"))
    placed = laid(texts, ["g"], "id", copies="copies", chars=chars)
    cells, blocks = text_cells.text_cells(texts, placed, ["g"], "id", "text", STOPS)
    assert cells.where("part >= 0").select("_g", "part").distinct().count() > 4 and blocks.count() > 4
    held, scale, own = vectors(cells, blocks)
    at = {(r.g, r._doc): (r._g, r.block, r.i) for r in placed.collect()}
    want = {}
    for r in term_weights(texts, ["g"], "id", "text", STOPS, copies="copies").collect():
        want.setdefault((r.g, r.id), {})[r.term] = r.weight
    keys = sorted(at)
    assert {k for k in keys if scale[at[k]] > 0} == set(want)
    for a in keys:
        for b in keys:
            if a[0] == b[0]:
                one, two = want.get(a, {}), want.get(b, {})
                got = sum(x * held.get(at[b], {}).get(k, 0.0) for k, x in held.get(at[a], {}).items()) + (own[at[a]] if a == b else 0.0)
                assert abs(got - sum(x * two.get(t, 0.0) for t, x in one.items())) < 1e-9


def test_clusters_are_those_of_the_weights(spark, monkeypatch):
    small(monkeypatch)
    docs = docs_of(spark)
    got = {(r.g, r.id): r.label for r in clustered_texts(docs, ["g"], "id", "text", STOPS, starts=6).collect()}
    monkeypatch.undo()
    texts, members = distinct_texts(docs, ["g"], "id", "text")
    weights = term_weights(texts, ["g"], "id", "text", STOPS, copies="copies")
    labels = k_means(weights, texts, ["g"], "id", starts=6, copies="copies")
    want = {(r.g, r.id): r.label for r in subtopics.labels_of_copies(labels, members, ["g"], "id").collect()}
    assert got == want and len(got) == docs.count()


def test_rounds_are_those_of_plain_arrays(spark):
    """A start to its standstill, from the same first centres, on dense vectors."""
    rows = [(g, i, x) for g in "gh" for i, x in enumerate(texts_of(60, 7)) if x]
    docs = spark.createDataFrame(rows, "g string, id long, text string").where("text != 'the a'")
    weights = term_weights(docs, ["g"], "id", "text", STOPS)
    got = {(r.g, r.id): r.label for r in k_means(weights, docs, ["g"], "id", clusters=3, starts=1).collect()}
    firsts = clusters._starting(weights, docs, ["g"], "id", 3, 1, 42).collect()
    cells = weights.collect()
    for g in "gh":
        ids, terms = sorted({r.id for r in cells if r.g == g}), sorted({r.term for r in cells if r.g == g})
        x, centres = np.zeros((len(ids), len(terms))), np.zeros((3, len(terms)))
        for r in cells:
            if r.g == g:
                x[ids.index(r.id), terms.index(r.term)] = r.weight
        for r in firsts:
            if r.g == g:
                centres[:, terms.index(r.term)] = [r.c0_0 or 0.0, r.c0_1 or 0.0, r.c0_2 or 0.0]
        for _ in range(300):
            label = ((centres**2).sum(1) - 2 * x @ centres.T).round(9).argmin(1)
            centres = np.stack([x[label == c].mean(0) for c in range(3)])
        order = sorted(range(3), key=lambda c: min(np.flatnonzero(label == c)))
        assert [got[g, i] for i in ids] == [order.index(c) for c in label]


def test_rows_of_one_document_count_once_as_vector(spark):
    docs = docs_of(spark, 40).where("text != ''")
    twice = clustered_texts(docs.unionByName(docs), ["g"], "id", "text", STOPS, starts=3).groupBy("g", "id").agg(F.count_distinct("label").alias("n"))
    assert twice.count() == docs.count() and twice.where("n > 1").isEmpty()


def test_no_row_for_every_term(spark, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("terms as rows")

    docs = docs_of(spark, 40)
    monkeypatch.setattr(subtopics, "term_counts", refuse)
    monkeypatch.setattr(subtopics, "term_weights", refuse)
    assert clustered_texts(docs, ["g"], "id", "text", STOPS, starts=2).count() == docs.count()


def test_packed_numbers_come_back():
    for kind in (np.uint8, np.uint16, np.int32, np.int64, np.uint64, np.float64):
        for n in (0, 1, 1000):
            x = (np.arange(n) * 37 % 251).astype(kind)
            assert unpacked_numbers(packed_bytes(x)).tolist() == x.tolist()
