"""Ids beyond the range of doubles beside a null one come out as they are, from every operator that goes through Python."""

from snaptrend.llm import leaks, licenses, pages, toxicity, transcripts

FAR = 2**53 + 1


def docs(spark):
    text = "under the gnu general public license, which is free, what is asked is what is answered by it all day long"
    return spark.createDataFrame([(FAR, text), (None, text), (FAR + 2, None)], "doc_id bigint, text string")


def ids(df, name="doc_id"):
    return sorted((r[name] for r in df.collect()), key=lambda i: (i is None, i))


def test_rows_of_documents(spark):
    given = docs(spark)
    assert ids(licenses.scan(given)) == [FAR, FAR + 2, None]
    assert ids(toxicity.rate(given, toxicity.Severity({"bad": 1.0}, [1.0, 2.0]))) == [FAR, FAR + 2, None]
    html = given.selectExpr("doc_id as page_id", "'u' as url", "text as html")
    assert ids(pages.extract(html), "page_id") == [FAR, FAR + 2, None]


def test_leaks(spark):
    given = docs(spark)
    item = given.where("text is not null").limit(1).selectExpr(f"{FAR + 4} as item_id", "text")
    got = leaks.contaminated(given, item.unionByName(item.selectExpr("cast(null as bigint) as item_id", "'other words, none of them there. not one' as text")))
    assert ids(got) == [FAR, None]


def test_conversations(spark):
    rows = [(c, i, role, f"words {i}") for c in (FAR, FAR + 2, None) for i, role in enumerate(("user", "assistant", "user"))]
    parts = transcripts.transcripts(spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string"))
    got = transcripts.parse(parts, transcripts.fit(parts))
    assert {r.conv_id for r in got.collect()} == {FAR, FAR + 2, None}


def test_a_text_full_of_phrases_takes_time_by_its_length():
    import time

    search = licenses.NoticeSearch(licenses.NOTICES, licenses.RATE)
    licenses.scan_text("mit license", search)
    start = time.perf_counter()
    n, base, _ = licenses.scan_text("mit license cc by " * 60_000, search)
    assert n == 240_000 and len(base) == 120_000 and base[-1] == ("cc-by", 239_998)
    assert time.perf_counter() - start < 30
