"""Rules over statistics: held-out rows, and the compiled columns against a plain reading of the rules."""

import math
import re
from binascii import crc32

import duckdb
import pytest

from snaptrend.llm import quality
from snaptrend.llm.rows import table

MIDDLE = "/root/testdata/sf0.01"


def plain_statistics(text):
    text = text or ""
    words, lines = re.findall(r"[^\x20\x09-\x0D]+", text), [x for x in text.split("\n") if x.strip(" ")]
    n, m, k = len(text), len(words), len(lines)
    over = lambda a, b: a / b if b else 0.0
    is_ = lambda c, *kinds: __import__("unicodedata").category(c)[: len(kinds[0])] in kinds
    symbols = sum(not (is_(c, "L", "M", "N") or c in " \t\n\x0b\f\r.,;:!?'\"()-") for c in text)
    found = {
        "chars": n, "words": m, "word_length": over(n, m), "vocabulary": math.log(1 + len(set(words))) / math.log(1 + m) if m else 0.0,
        "repeated_next": over(sum(a == b for a, b in zip(words, words[1:], strict=False)), m),
        "short_words": over(sum(len(w) <= 3 for w in words), m), "symbols": over(symbols, n),
        "capitals": over(sum(is_(c, "Lu") for c in text), n), "digits": over(sum(is_(c, "N") for c in text), n),
        "shouts": over(text.count("!"), m), "stops": over(text.count(".") + text.count("?"), m), "commas": over(text.count(","), m),
        "distinct_lines": over(len(set(lines)), k), "line_words": over(m, k),
    }
    return [float(found[s]) for s in quality.STATISTICS]


@pytest.fixture(scope="module")
def model(spark):
    return quality.fit(table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels"))


def test_statistics_of_whole_texts(spark):
    texts = [None, "", " \n\t ", "One two two. THREE!\n\nOne two two. THREE!\n4,5 é$ ##", "word " * 60_000, "x", "a\n  \na"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").selectExpr("*", "1 as _text", "2 as _words", "3 as _s_chars")
    rows = quality.with_statistics(docs, quality.F.col("doc_id")).collect()
    for r in rows:
        assert list(r)[1:] == pytest.approx(plain_statistics(texts[r.doc_id])), texts[r.doc_id]


def test_paths_of_a_printed_tree():
    said = """DecisionTreeClassificationModel: uid=x, depth=2
  If (feature 0 <= 10.5)
   If (feature 1 <= 2.0)
    Predict: 0.0
   Else (feature 1 > 2.0)
    Predict: 1.0
  Else (feature 0 > 10.5)
   If (feature 0 <= 1.0E2)
    Predict: 1.0
   Else (feature 0 > 1.0E2)
    Predict: 0.0
"""
    inf = math.inf
    assert [r.bounds for r in quality.paths(said)] == [
        (("chars", -inf, 10.5),), (("chars", -inf, 10.5), ("words", -inf, 2.0)), (("chars", -inf, 10.5), ("words", 2.0, inf)),
        (("chars", 10.5, inf),), (("chars", 10.5, 100.0),), (("chars", 100.0, inf),),
    ]
    assert str(quality.paths(said)[4]) == "chars > 10.5 and chars <= 100"


def test_held_out_rows_and_compiled_scores(spark, model):
    docs = table(spark, MIDDLE, "documents")
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    texts = dict(duckdb.sql(f"select doc_id, text from '{MIDDLE}/documents.parquet'").fetchall())
    labels = dict(duckdb.sql(f"select doc_id, quality from '{MIDDLE}/labels.parquet'").fetchall())
    assert len(got) == len(texts)
    for i, r in got.items():
        x = dict(zip(quality.STATISTICS, plain_statistics(texts[i]), strict=True))
        odds = model.constant + sum(w for rule, w in model.rules.items() if all(lo < x[n] <= hi for n, lo, hi in rule.bounds))
        assert r.score == pytest.approx(1 / (1 + math.exp(-odds))) and r.predicted == (r.score >= 0.3)
        assert r.held_out == (crc32(str(i).encode()) % 5 == 0)
    held = [(got[i].predicted, y) for i, y in labels.items() if got[i].held_out]
    assert len(held) > 50 and sum(p == y for p, y in held) >= 0.95 * len(held)


def test_held_out_labels_are_never_read(spark, model):
    docs, labels = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels")
    turned = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    again = quality.fit(docs, turned)
    assert again.constant == model.constant and again.rules == model.rules


def test_odd_rows_and_labels(spark, model):
    docs = spark.createDataFrame(
        [(2**53 + 1, "Some text."), (None, "Some text."), (1, None), (1, None), (2, "")], "doc_id bigint, text string"
    ).selectExpr("*", "'x' as score", "true as held_out", "0 as predicted", "1 as _y", "2 as _id")
    got = quality.score(docs, model).collect()
    assert len(got) == 5 and {r.doc_id for r in got} == {2**53 + 1, None, 1, 2}
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out for r in got if r.doc_id is None)
    assert quality.score(docs.limit(0), model).count() == 0
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, quality int")
    assert quality.fit(docs, none) == quality.Ensemble(0.0)
    ones = spark.createDataFrame([(1, 1), (2, 1), (2, 1)], "doc_id bigint, quality int")
    assert quality.fit(docs, ones).constant > 0 and not quality.fit(docs, ones).rules
