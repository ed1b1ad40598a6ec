"""Periodic runs against a plain search for every period."""

import hashlib
import random
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from snaptrend.llm import runs

SMALL = "/root/testdata/sf0.001"


def plain_runs(words, least=24):
    """All maximal stretches of every period, the smallest period of each."""
    n, best = len(words), {}
    for q in range(1, n // 3 + 1):
        a = None
        for i in range(n - q + 1):
            same = i < n - q and words[i] == words[i + q]
            if same and a is None:
                a = i
            if not same and a is not None:
                b = i + q
                if b - a >= max(least, 3 * q):
                    best.setdefault((a, b), q)
                a = None
    return sorted(((a, b - a, q) for (a, b), q in best.items()), key=lambda r: (r[0], r[2]))


def texts(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(60):
        kind = rng.randrange(5)
        letters = [chr(97 + i) for i in range(rng.choice([1, 2, 2, 3, 26]))]
        words = rng.choices(letters, k=rng.randrange(0, 150))
        if kind == 1:
            root = rng.choices(letters, k=rng.randint(1, 60))
            words += root * rng.randint(2, 6) + root[: rng.randrange(len(root) + 1)] + rng.choices(letters, k=rng.randrange(40))
        if kind == 2:
            inner = rng.choices(letters, k=rng.randint(1, 4)) * rng.randint(1, 30)
            words += (inner + [rng.choice("xyz")]) * rng.randint(2, 5)
        if kind == 3:
            words = words + ["a"] * rng.randint(0, 200) + words
        if kind == 4:
            a, b = "a", "ab"
            while len(b) < rng.randint(20, 300):
                a, b = b, b + a
            words = list(b) * rng.randint(1, 3)
        out.append(words)
    return out


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_the_plain_search(seed):
    given = texts(seed)
    assert runs.found_in(given) == [plain_runs(w) for w in given]


@pytest.mark.parametrize("portion", [1, 7, 64])
def test_portions_of_the_stream_do_not_matter(portion, monkeypatch):
    """Words that come one by one, or a few at a time."""
    monkeypatch.setattr(runs, "PORTION", portion)
    given = texts(99)[:25]
    assert runs.found_in(given) == [plain_runs(w) for w in given]


def test_equal_hashes_of_unequal_words_change_nothing(monkeypatch):
    """A hash that knows two values only tells lies, and is found out."""
    good = runs.hashed
    monkeypatch.setattr(runs, "hashed", lambda x, seed: good(x, seed) if seed else x.astype(np.uint64) % np.uint64(2))
    for seed in range(3):
        given = texts(seed)
        assert runs.found_in(given) == [plain_runs(w) for w in given]


def test_long_texts_of_one_word_take_no_square_of_their_length():
    words = ["a"] * 200_000
    assert runs.found_in([words]) == [[(0, 200_000, 1)]]
    nested = (["a"] * 300 + ["b"]) * 300
    found = runs.found_in([nested])[0]
    assert (0, len(nested), 301) in found and len(found) == 301


def test_whole_rows(spark):
    """Nulls, empty and repeated texts, ids beyond the range of doubles beside a null one, clashing names."""
    far = 2**53 + 1
    rows = [(far, "a b c " * 20), (None, "x " * 30), (None, None), (3, ""), (3, ""), (4, " \t\n"), (5, "é b " * 24)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as runs", "2 as collapsed", "3 as n_words")
    got = runs.periodic_runs(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [tuple(x) for x in by[far].runs] == [(0, 60, 3)] and by[far].collapsed == "a b c" and by[far].n_words == 60
    assert sorted((r.n_words, r.collapsed) for r in got if r.doc_id is None) == [(0, ""), (30, "x")]
    assert [r.collapsed for r in got if r.doc_id in (3, 4)] == ["", "", ""]
    assert by[5].collapsed == "é b"
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_query_against_plain_rows(spark):
    got = {r.doc_id: r for r in runs.query(spark, SMALL).collect()}
    given = duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet' where length(text) < 6000").fetchall()
    some = 0
    for doc_id, text in given:
        words = runs.planted(doc_id, runs.WORD.findall(text or ""))
        want = plain_runs(words)
        keep = [True] * len(words)
        for a, n, q in want:
            keep[a + q : a + n] = [False] * (n - q)
        r = got[doc_id]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert r.n_runs == len(want)
        assert r.runs_sha256 == sha("".join(f"{a},{n},{q}\n" for a, n, q in want))
        assert r.collapsed_sha256 == sha(" ".join(w for w, k in zip(words, keep, strict=True) if k))
        if want:
            some += 1
            a, n, q = min(want, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (a, n, q, 1000 * n // q)
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
    assert some > 5
