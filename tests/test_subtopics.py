from pyspark.sql import functions as F

from snaptrend.functions.text import jaccard, keyword_set, normalized_set, readable_name
from snaptrend.operators.clusters import _starting
from snaptrend.operators.subtopics import (
    cluster_count, cluster_documents, cluster_phrases, document_phrases, stable_ids, term_weights,
)

STOPS = ["the", "a"]


def test_cluster_count():
    assert [cluster_count(n) for n in (0, 1, 2, 3, 4, 5, 9, 10, 16, 17, 1000)] == [0, 1, 2, 2, 2, 3, 3, 4, 4, 5, 5]


def test_weights_and_phrases(spark):
    import math

    docs = spark.createDataFrame(
        [("m", 1, "red apple the pie"), ("m", 2, "red apple"), ("m", 3, "blue sky"), ("m", 4, "the")],
        "macro string, id long, text string",
    )
    weights = term_weights(docs, ["macro"], "id", "text", STOPS, longest=2)
    got = {(r.id, r.term): r.weight for r in weights.collect()}
    idf1, idf2 = math.log(5 / 2) + 1, math.log(5 / 3) + 1
    norm = math.sqrt(3 * idf2**2 + 2 * idf1**2)       # red, apple, "red apple"; pie, "apple pie"
    assert set(t for i, t in got if i == 1) == {"red", "apple", "pie", "red apple", "apple pie"}
    assert abs(got[(1, "pie")] - idf1 / norm) < 1e-12
    labels = docs.select("macro", "id", F.when(F.col("id") < 3, 0).otherwise(1).alias("label"))
    phrases = {r.label: r.phrases for r in cluster_phrases(weights, labels, ["macro"], "id", 3).collect()}
    assert phrases == {0: ["apple", "red", "red apple"], 1: ["blue", "blue sky", "sky"]}


def test_frequent_terms_leave_the_vocabulary(spark):
    docs = spark.createDataFrame([("m", 1, "same one"), ("m", 2, "same two")], "macro string, id long, text string")
    weights = term_weights(docs, ["macro"], "id", "text", STOPS, longest=1)
    assert {r.term for r in weights.collect()} == {"one", "two"}


def test_document_phrases(spark):
    docs = spark.createDataFrame(
        [(1, "gol gran gol gran the pase"), (2, "the a of"), (3, None)], "id long, text string"
    )
    got = {r.id: r.phrases for r in document_phrases(docs, ["id"], F.col("text"), STOPS + ["of"]).collect()}
    # twice: "gol gran", "gol", "gran"; once: the trigrams and the other bigrams in text order
    assert got[1][:3] == ["gol gran", "gol", "gran"]
    assert got[1][3:6] == ["gol gran gol", "gran gol gran", "gol gran pase"]
    assert got[2] == got[3] == ["conversacion especifica"]


def test_clusters_cover_documents_and_repeat(spark):
    texts = [f"{a} {b} x{i}" for i, (a, b) in enumerate([("red", "apple"), ("blue", "sky"), ("green", "tree")] * 4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    grouped = docs.withColumn("g", F.lit("g"))
    weights = term_weights(grouped, ["g"], "id", "text", STOPS)
    one = {r.id: r.label for r in cluster_documents(weights, grouped, ["g"], "id", clusters=3, starts=3).collect()}
    two = {r.id: r.label for r in cluster_documents(weights, grouped, ["g"], "id", clusters=3, starts=3).collect()}
    assert one == two and len(one) == 12
    assert [one[i] for i in range(3)] == [0, 1, 2] and all(one[i] == one[i % 3] for i in range(12))


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "macro_topic_id string, label int, name string, phrases array<string>")


def test_ids_reuse_threshold_and_contention(spark):
    labels = labels_frame(spark, [
        ("m", 0, "first", ["a1", "b1", "c1", "d1"]),
        ("m", 1, "second", ["a1", "b1", "c1", "e1"]),
        ("m", 2, "third", ["x1", "y1"]),
        ("m", 3, "third", ["x1", "y1"]),
        ("n", 0, "other", ["a1", "b1", "c1", "d1"]),
    ])
    previous = spark.createDataFrame(
        [("m", "m__old", "a1, B1, c1, d1"), ("m", "m__older", "a1|b1|c1"), ("m", "m__low", "x1, q, r, s")],
        "macro_topic_id string, sub_topic_id string, keywords string",
    )
    got = {(r.macro_topic_id, r.label): r.sub_topic_id for r in stable_ids(labels, previous).collect()}
    assert got[("m", 0)] == "m__old"
    assert got[("m", 1)] == "m__older"                 # the better one is taken
    assert got[("m", 2)].startswith("m__third__") and got[("m", 3)] == got[("m", 2)] + "_2"
    assert got[("n", 0)].startswith("n__other__")


def test_jaccard_at_threshold(spark):
    df = spark.createDataFrame([("a, b ,c|D", ["d", "É"])], "k string, l array<string>")
    row = df.select(
        keyword_set(F.col("k")).alias("s"),
        jaccard(keyword_set(F.col("k")), normalized_set(F.col("l"))).alias("j"),
        jaccard(keyword_set(F.lit(None)), normalized_set(F.col("l"))).alias("z"),
    ).first()
    assert row.s == ["a", "b", "c", "d"] and row.j == 0.2 and row.z == 0.0


def test_readable_name(spark):
    df = spark.createDataFrame(
        [(["gol", "estadio bbva monterrey"], ["T"]), (["gol"], ["  ", " Big\n title "]), (["fifa"], []), ([], [])],
        "p array<string>, t array<string>",
    )
    got = [r[0] for r in df.select(readable_name(F.col("p"), F.col("t"))).collect()]
    assert got == ["Estadio BBVA Monterrey", "Big title", "FIFA", "Conversacion especifica"]


def greedy(labels, previous, threshold=0.45):
    """Label by label, as plain Python."""
    from collections import Counter

    def key(words):
        return "|".join(sorted(words))

    out = {}
    first = {}
    for i, kw in sorted(previous):
        first.setdefault(key(kw), i)
    used, made = set(), Counter()
    for label, new_id, kw in sorted(labels):
        scored = []
        for i, old in previous:
            score = len(set(kw) & set(old)) / len(set(kw) | set(old))
            if score >= threshold and i not in used:
                scored.append((-score, first[key(old)], i))
        if scored:
            picked = min(scored)[2]
        else:
            picked, n = new_id, 2
            while picked in used:
                picked, n = f"{new_id}_{n}", n + 1
        used.add(picked)
        out[label] = picked
    return out


def test_rounds_decide_like_the_fold(spark):
    import hashlib
    import random

    rng = random.Random(5)
    words = ["aa", "bb", "cc", "dd", "ee"]
    sets = [sorted(rng.sample(words, 3)) for _ in range(5)]
    labels = [(i, sets[min(int(rng.expovariate(1)), 4)]) for i in range(30)]
    previous = [(f"m__p{i:02d}", sets[rng.randrange(5)]) for i in range(12)]
    # An id that a label of the first set would make anew is already held, with number three.
    digest = hashlib.sha1("|".join(sets[0]).encode()).hexdigest()[:8]
    previous += [(f"m__name__{digest}", sets[0]), (f"m__name__{digest}_3", sets[0])]
    frame = labels_frame(spark, [("m", i, "name", kw) for i, kw in labels])
    old = spark.createDataFrame(
        [("m", i, ", ".join(kw)) for i, kw in previous], "macro_topic_id string, sub_topic_id string, keywords string"
    )
    new_ids = {i: f"m__name__{hashlib.sha1('|'.join(kw).encode()).hexdigest()[:8]}" for i, kw in labels}
    want = greedy([(i, new_ids[i], kw) for i, kw in labels], previous)
    fold = {r.label: r.sub_topic_id for r in stable_ids(frame, old).collect()}
    rounds = {r.label: r.sub_topic_id for r in stable_ids(frame, old).collect()}
    assert fold == want
    assert len(set(rounds.values())) == 30
    assert rounds == want


def test_numbered_cuts_hot_groups(spark):
    from snaptrend.operators.ranking import numbered

    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "x").otherwise("hot").alias("k"), (F.col("id") * 7 % 1000).alias("o"))
    rows = numbered(df, ["k"], ["o"], "n").collect()
    for k in ("x", "hot"):
        own = sorted((r.o, r.n) for r in rows if r.k == k)
        assert [n for _, n in own] == list(range(1, len(own) + 1))


def test_starts_are_drawn_by_squared_distance(spark):
    """Beside a drawn document, one at squared distance 2 is drawn twice as often as one at 1, and never a copy."""
    vectors = [("a", "x", 1.0), ("a2", "x", 1.0), ("b", "x", 0.5), ("b", "y", 0.75**0.5), ("c", "z", 1.0)]
    groups = spark.range(3000).select(F.col("id").alias("g"))
    rows = spark.createDataFrame(vectors, "d string, term string, weight double")
    weights = groups.join(F.broadcast(rows)).select("g", F.concat("d", F.lit("-"), F.col("g").cast("string")).alias("id"), "term", "weight")
    docs = weights.select("g", "id").distinct()
    centres = _starting(weights, docs, ["g"], "id", 2, 2, 42).collect()
    assert sorted(map(tuple, _starting(weights, docs, ["g"], "id", 2, 2, 42).collect()), key=str) == sorted(map(tuple, centres), key=str)
    # An even start takes what is farthest.
    farthest = {r.g for r in centres if r.term == "x" and r.c0_0 == 1.0}
    assert farthest == {r.g for r in centres if r.term == "z" and r.c0_1 is not None} & farthest
    # An odd one draws.
    first = {r.g for r in centres if r.term == "x" and r.c1_0 == 1.0}
    far = {r.g for r in centres if r.term == "z" and r.c1_1 is not None} & first
    near = {r.g for r in centres if r.term == "y" and r.c1_1 is not None} & first
    assert 0.45 < len(first) / 3000 < 0.55
    assert far | near == first and not far & near
    assert 0.62 < len(far) / len(first) < 0.71
