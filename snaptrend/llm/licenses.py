"""Fuzzy search for short licence notices: exact seeds, then bounded-error matching."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrend.llm.rows import ship, table, through_pandas

ship(__name__)

#: Words of a text whose ASCII letters are in lower case.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

#: Fixed phrases with their labels; each consecutive place counts.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Notices that are searched with errors.
NOTICES = (
    ("licensed under the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("licensed under the apache license version 2 0", "apache"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("mozilla public license version 2 0", "mpl"),
    ("licensed under cc by", "cc-by"),
    ("creative commons attribution", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "proprietary"),
)
#: Edits allowed per character of a notice.
RATE = 0.1

SCHEMA = (
    "n_words bigint, "
    "base array<struct<label:string,word:bigint>>, "
    "fuzzy array<struct<label:string,first_word:bigint,last_word:bigint,edits:int,score:double>>"
)


class NoticeSearch:
    """Notices within a bounded number of edits.

    A notice that is to match with ``k`` edits is cut into ``k + 1`` pieces; wherever it does match, one
    piece at least is untouched. An automaton finds all pieces in one pass; only the surroundings of a
    piece are matched with errors.
    """

    def __init__(self, notices=NOTICES, rate: float = RATE):
        self.notices = []
        self.seeds = ahocorasick.Automaton()
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (text, label) in enumerate(notices):
            edits = int(len(text) * rate)
            pattern = regex.compile(rf"(?b)(?<![^ ])(?:{regex.escape(text)}){{e<={edits}}}(?![^ ])")
            self.notices.append((text, label, edits, pattern))
            cuts = [len(text) * i // (edits + 1) for i in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                pieces.setdefault(text[a:b], []).append((n, a))
        for piece, places in pieces.items():
            self.seeds.add_word(piece, (len(piece), places))
        self.seeds.make_automaton()

    def find(self, text: str) -> list[tuple[str, int, int, int, float]]:
        """Label, start, end, edits and score of every match in a text of words parted by one space."""
        windows: dict[int, list[list[int]]] = {}
        for end, (size, places) in self.seeds.iter(text):
            for n, offset in places:
                notice, _, edits, _ = self.notices[n]
                start = end + 1 - size - offset - edits
                stop = start + len(notice) + 2 * edits
                own = windows.setdefault(n, [])
                if own and start <= own[-1][1]:
                    own[-1] = [min(own[-1][0], start), max(own[-1][1], stop)]
                else:
                    own.append([start, stop])
        found = []
        for n, own in windows.items():
            notice, label, _, pattern = self.notices[n]
            for start, stop in own:
                for m in pattern.finditer(text, max(0, start - 1), min(len(text), stop + 1)):
                    edits = sum(m.fuzzy_counts)
                    found.append((label, m.start(), m.end(), edits, 1 - edits / len(notice)))
        return sorted(set(found), key=lambda x: (x[1], x[2], x[0]))


def words_of(text: str | None) -> list[str]:
    """Lower-case words; only A-Z changes case."""
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


def word_numbers(padded: str) -> Iterator[int]:
    """Takes rising places of a text whose words are parted by one space, gives the number of spaces before each."""
    at = n = 0
    while True:
        to = yield n
        n += padded.count(" ", at, to)
        at = to


def scan_text(text: str | None, search: NoticeSearch, phrases=PHRASES) -> tuple[int, list, list]:
    words = words_of(text)
    joined = " ".join(words)
    padded = f" {joined} "
    base = []
    for phrase, label in phrases:
        needle, at, number = f" {phrase} ", 0, word_numbers(padded)
        next(number)
        while (at := padded.find(needle, at)) >= 0:
            base.append((label, number.send(at)))
            at += 1
    fuzzy, number = [], word_numbers(joined)
    next(number)
    # In order of their start.
    for label, start, stop, edits, score in search.find(joined):
        first = number.send(start)
        fuzzy.append((label, first, first + joined.count(" ", start, stop), edits, score))
    return len(words), sorted(base, key=lambda x: (x[1], x[0])), fuzzy


def scan(docs: DataFrame, notices=NOTICES, phrases=PHRASES, rate: float = RATE) -> DataFrame:
    """Phrases and notices of every text: doc_id, n_words, base (label, word), fuzzy (label, first and last word, edits, score).

    Words are counted from 0. Every row gives one row, whatever its id; a null or empty text has no words and no
    spans. Matches of one notice do not overlap; those of different notices may. Other columns are ignored.
    """
    rows = docs.select("doc_id", "text")
    notices, phrases = tuple(notices), tuple(phrases)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search = NoticeSearch(notices, rate)
        for batch in batches:
            found = [scan_text(t, search, phrases) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"],
                "n_words": [x[0] for x in found],
                "base": [[{"label": a, "word": b} for a, b in x[1]] for x in found],
                "fuzzy": [
                    [dict(zip(("label", "first_word", "last_word", "edits", "score"), y, strict=True)) for y in x[2]]
                    for x in found
                ],
            })

    return through_pandas(rows, run, SCHEMA, "doc_id")


QUERY = "op4_license_scan"


def query(spark, folder) -> DataFrame:
    found = scan(table(spark, folder, "documents"))
    labels = lambda *arrays: F.concat_ws(",", F.array_sort(F.array_distinct(F.concat(*arrays))))
    words, base, fuzzy = F.col("base.word"), F.col("base.label"), F.col("fuzzy.label")
    exact = F.when(F.size("base") > 0, 1.0).otherwise(0.0)
    return found.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        labels(base).alias("base_labels"), labels(base, fuzzy).alias("labels"),
        F.greatest(exact, F.coalesce(F.array_max("fuzzy.score"), F.lit(0.0))).alias("score"),
        F.col("fuzzy"),
    )
