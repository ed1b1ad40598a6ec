import sys
import unicodedata
from datetime import date

import pytest
from pyspark.sql import functions as F

from snaptrend.functions import dates, lexicon, numbers, text


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize("raw,want", [
    (None, ""), ("", ""), ("Ñandú, ÉL! 100%", "nandu el 100"), ("a_b  -  c", "a_b c"), ("!!!", ""),
    # Lower case comes before decomposition, so a styled capital stays a capital.
    ("Ｆｕｌｌ 𝐁old", "full Bold"),
])
def test_normalize_text(spark, raw, want):
    assert one(spark, raw, text.normalize_text) == want


def test_characters_of_several_parts(spark):
    assert one(spark, "straße №5 ﬁn", text.normalize_text) == "straße No5 fin"


def test_folding_equals_decomposition_on_all_code_points(spark):
    codes = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    rows = ["|".join(map(chr, codes[i : i + 256])) for i in range(0, len(codes), 256)]
    df = spark.createDataFrame([(r,) for r in rows], "v string").select("v", text.fold_accents(F.col("v")).alias("f"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    for v, f in df.collect():
        want = "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c))
        assert f == want, (hex(ord(v[0])), [(a, b) for a, b in zip(f.split("|"), want.split("|"), strict=False) if a != b][:3])


def test_hangul_syllables_become_jamo(spark):
    want = unicodedata.normalize("NFKD", "한국어 가각")
    assert one(spark, "한국어, 가각!", text.normalize_text) == want


def test_slug(spark):
    assert one(spark, "¡Hola, Señor Gómez!", text.slugify) == "hola_senor_gomez"
    assert one(spark, "abc def", lambda c: text.slugify(c, 4)) == "abc"
    assert one(spark, "¿?", text.slugify) == "topic"


@pytest.mark.parametrize("raw,want", [
    ("PT1H2M3S", 3723), ("P1DT1S", 86401), ("P2W", 1209600), ("PT1.5S", 1), ("-PT10S", -10), ("PT", 0),
    ("P0D", 0), ("P", None), ("1H", None), ("PTX", None), ("", None), (None, None), ("P1Y2M3D", 259200),
    ("a|b|c|d|e|f", None), ("PT0,5H", 1800),
])
def test_iso_duration(spark, raw, want):
    assert one(spark, raw, text.iso_duration_seconds) == want


@pytest.mark.parametrize("raw,want", [("0", 0), ("", None), (None, None), ("12", 12), ("x", None)])
def test_counter(spark, raw, want):
    assert one(spark, raw, numbers.counter) == want


def test_restore_terms(spark):
    got = one(spark, " -Fan Fest en el ESTADIO BBVA, unbbva_", text.restore_terms)
    assert got == "Fan Fest en el Estadio BBVA, unbbva"


def test_stop_words(spark):
    assert len(lexicon.ENGLISH_STOP_WORDS) == 318
    assert len(lexicon.SPANISH_STOP_WORDS) == len(set(lexicon.SPANISH_STOP_WORDS)) == 85
    assert len(lexicon.DOMAIN_STOP_WORDS) == 16


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 0), (1, 4), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(numbers.safe_divide(F.col("a"), F.col("b"))).collect()] == [None, 0.25, None]


def test_dates(spark):
    window = dates.date_window(None, "2024-03-02", "2024-03-01")
    assert window.dates() == ["2024-03-01", "2024-03-02"] and window.days == 2
    for bad in ((None, None, None), ("2024-03-02", "2024-03-01", None), ("x", None, "2024-03-01")):
        with pytest.raises(ValueError):
            dates.date_window(*bad)
    df = spark.sql("select timestamp'2024-01-31 05:30:00' as t, date'2024-01-30' as d")
    after, before = dates.search_window_utc(F.col("d"))
    row = df.select(dates.local_yesterday(F.col("t")), after.cast("string"), before.cast("string"),
                    dates.whole_hours(F.lit("2024-01-01 00:10:00").cast("timestamp"), F.lit("2024-01-01 02:00:00").cast("timestamp"))).first()
    assert tuple(row) == (date(2024, 1, 29), "2024-01-28 06:00:00", "2024-01-31 06:00:00", -1)


def test_sub_topic_id(spark):
    import hashlib

    df = spark.createDataFrame([(["B b", "á"], "El Nombre"), ([], "El Nombre")], "k array<string>, n string")
    got = [r[0] for r in df.select(text.sub_topic_id(F.lit("m"), F.col("k"), F.col("n"))).collect()]
    digest = [hashlib.sha1(s.encode()).hexdigest()[:8] for s in ("a|b b", "el nombre")]
    assert got == [f"m__el_nombre__{d}" for d in digest]
