from pyspark.sql import functions as F

from snaptrend.functions import lexicon
from snaptrend.operators.topics import build_documents, classify_macro_topics


def classify(spark, texts, **kw):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, source_text string")
    rows = classify_macro_topics(docs, **kw).orderBy("id").collect()
    return rows


def test_rules_scores_and_ties(spark):
    rows = classify(spark, [
        "Gran ESTADIO BBVA, sede",            # 1 + 1 + 2 + 1
        "Evento y boletos",                   # tie of 1: confidence decides
        "hotelito unhotel",                   # inside longer words only
        None,
        "!!! ___",
        "Selección mexicana de fútbol",
    ])
    first = rows[0]
    assert first.macro_topic_id == "stadium"
    assert first.macro_topic_keywords == "estadio, bbva, estadio bbva, sede"
    assert first.topic_confidence == 5 / 5.5 and first.topic_method == lexicon.METHOD_RULES
    assert rows[1].macro_topic_id == "fan_fest"       # 1/6 against 1/7.5
    assert [r.macro_topic_id for r in rows[2:5]] == ["other"] * 3
    assert rows[3].topic_confidence == 0.0 and rows[3].matched_source == "none"
    assert rows[5].macro_topic_keywords == "seleccion, seleccion mexicana, futbol"


def test_similarity_fallback_against_plain_python(spark):
    import math
    from collections import Counter

    from snaptrend.operators.topics import plain_normalize

    text = "gigante party gigante national zeppelin group gratuito acero zeppelin"
    stops = set(lexicon.default_stop_words())

    def grams(t):
        kept = [w for w in plain_normalize(t).split() if len(w) > 1 and w not in stops]
        return Counter(kept + [f"{a} {b}" for a, b in zip(kept, kept[1:])])

    corpus = [grams(text)] + [
        grams(" ".join([r.name, *r.keywords])) for r in lexicon.DEFAULT_TOPIC_RULES
    ]
    freq = Counter(t for c in corpus for t in c)
    vectors = []
    for counts in corpus:
        v = {t: n * (math.log(8 / (1 + freq[t])) + 1) for t, n in counts.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        vectors.append({t: x / size for t, x in v.items()})
    sims = [sum(x * v.get(t, 0) for t, x in vectors[0].items()) for v in vectors[1:]]
    best = max(range(6), key=lambda i: sims[i])

    row = classify(spark, [text])[0]
    assert row.topic_method == lexicon.METHOD_TFIDF
    assert row.macro_topic_id == lexicon.DEFAULT_TOPIC_RULES[best].topic_id
    assert abs(row.topic_confidence - sims[best]) < 1e-12
    assert row.macro_topic_keywords == ""


def test_documents_take_most_liked_comments(spark):
    videos = spark.createDataFrame(
        [("d", "v1", "T", None, "a, b", "q"), ("d", "v2", "U", "desc", None, None)],
        "run_date string, video_id string, title string, description string, tags string, search_query string",
    )
    comments = spark.createDataFrame(
        [("d", "v1", f"c{i}", f"t{i}", i) for i in range(4)] + [("d", "v1", "c9", None, 99), ("d", "v1", "c8", "nul", None)],
        "run_date string, video_id string, comment_id string, comment_text string, like_count int",
    )
    rows = {r.video_id: r.source_text for r in build_documents(videos, comments, max_comments=3).collect()}
    assert rows == {"v1": "T a, b q t3 t2 t1", "v2": "U desc"}
    cut = build_documents(videos, comments, max_comments=5, max_chars=9).orderBy("video_id").first()
    assert cut.source_text == "T a, b q "
