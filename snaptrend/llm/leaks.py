"""Benchmark items in training texts: BM25 over an inverted index of items, block-max WAND, overlap checks."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaptrend.llm.rows import ship, stored, table, through_pandas
from snaptrend.session import checkpointed

ship(__name__)

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")

#: Items of one index; more items take more indexes, so none grows. Scores do not depend on the cut.
SHARD_ITEMS = 2_000
#: Indexes that one pass over the documents asks, one after the other.
SHARDS_A_PASS = 4
#: Shortest stride of passages. An item belongs to the stride, doubled as needed, that is as long as it.
STRIDE = 64
#: Cells of the table of block maxima, which sets how many items share a block.
CELLS = 4_000_000
BLOCK = 2
#: Share of an item's own BM25 score that a passage must reach to be retrieved.
THRESHOLD = 0.5
#: Shares of the three-word runs of question and answer that a passage must hold.
QUESTION, ANSWER, ALONE = 0.6, 0.6, 0.8
#: Words of a question that tells an item by itself; shorter ones are common phrases.
ASKED = 8


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def parts_of(text: str | None) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer: the answer is the last sentence, if there are two."""
    sentences = [w for w in map(words_of, SENTENCE.split(text or "")) if w]
    if len(sentences) < 2:
        return (sentences or [[]])[0], []
    return [w for s in sentences[:-1] for w in s], sentences[-1]


def runs(words: list[str], size: int) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def overlap(part: list[str], passage: list[str]) -> float:
    """Share of the part's runs of three words (fewer, if it has fewer) that the passage holds; 1 for an empty part."""
    size = min(3, len(part))
    own = runs(part, size) if size else set()
    return len(own & runs(passage, size)) / len(own) if own else 1.0


@dataclass(frozen=True)
class Statistics:
    """What BM25 takes from all items: their number, their mean length, and in how many each word is."""

    n: int
    mean: float
    df: Mapping[str, int]

    @classmethod
    def of(cls, texts: list[list[str]]) -> Statistics:
        return cls(len(texts), sum(map(len, texts)) / max(len(texts), 1), Counter(w for t in texts for w in set(t)))

    def impacts(self, words: list[str], k1: float, b: float) -> dict[str, float]:
        """BM25 score of every word of a text."""
        found = {}
        for w, tf in Counter(words).items():
            idf = math.log(1 + (self.n - self.df[w] + 0.5) / (self.df[w] + 0.5))
            found[w] = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(words) / self.mean))
        return found


def stride_of(words: list[str]) -> int:
    """Stride of the passages that look for an item: the shortest one, doubled until it is as long as the item."""
    stride = STRIDE
    while stride < len(words):
        stride *= 2
    return stride


class Index:
    """Postings of the items by term, in item order, with impacts as shares of the item's own score.

    Shares make one threshold serve all items. ``maxima`` holds, for every term and block of neighbouring
    items, the largest impact. All items have one stride. An item whose answer holds so much of its score that
    the question alone might not reach the threshold has its question, if that has ``ASKED`` words, as a second
    entry; ``items`` and ``parts`` are by entry.
    Statistics are those of all items, or of those given where none are.
    """

    def __init__(
        self, items: list[tuple[int, str | None]], statistics: Statistics | None = None, stride: int | None = None,
        threshold: float = THRESHOLD, k1: float = 1.2, b: float = 0.75,
    ):
        whole = sorted(((i, t) for i, t in items if words_of(t)), key=lambda x: (x[0] is None, x[0], x[1]))
        statistics = statistics or Statistics.of([words_of(t) for _, t in whole])
        self.items, self.parts, scores = [], [], []
        for item in whole:
            words, parts = words_of(item[1]), parts_of(item[1])
            raw = statistics.impacts(words, k1, b)
            asked = set(parts[0])
            entries = [raw]
            if parts[1] and len(parts[0]) >= ASKED and ALONE * sum(x for w, x in raw.items() if w in asked) < threshold * sum(raw.values()):
                entries.append(statistics.impacts(parts[0], k1, b))
            self.items += [item] * len(entries)
            self.parts += [parts] * len(entries)
            scores += entries
        n = len(scores)
        self.terms = {w: i for i, w in enumerate(sorted({w for raw in scores for w in raw}))}
        self.postings: list[list[int]] = [[] for _ in self.terms]
        self.impacts: list[list[float]] = [[] for _ in self.terms]
        for at, raw in enumerate(scores):
            total = sum(raw.values())
            for w, x in raw.items():
                self.postings[self.terms[w]].append(at)
                self.impacts[self.terms[w]].append(x / total)
        self.block = max(BLOCK, math.ceil(n * max(1, len(self.terms)) / CELLS))
        self.maxima = np.zeros((len(self.terms), max(1, math.ceil(n / self.block))))
        for t, (at, x) in enumerate(zip(self.postings, self.impacts, strict=True)):
            np.maximum.at(self.maxima[t], np.array(at) // self.block, x)
        self.top = self.maxima.max(axis=1) if len(self.terms) else np.zeros(0)
        #: A passage is two strides long and starts at every stride, so that it holds any item whole.
        self.stride = stride or max([STRIDE, *(stride_of(words_of(t)) for _, t in whole)])

    def retrieve(self, terms: list[int], live: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """Items whose score reaches the threshold, by block-max WAND over the blocks that may hold one."""
        least = threshold - 1e-9
        # A cursor: current item, term, place in its postings.
        cursors = []
        for t in terms:
            own = self.postings[t]
            cursors.append([own[0], t, 0])
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for i, (_, t, _) in enumerate(cursors):
                bound += self.top[t]
                if bound >= least:
                    pivot = i
                    break
            if pivot is None:
                break
            item = cursors[pivot][0]
            block = item // self.block
            if not live[block]:
                goal = (block + 1) * self.block
                move = [c for c in cursors if c[0] < goal]
            elif cursors[0][0] == item:
                score = 0.0
                move = [c for c in cursors if c[0] == item]
                for _, t, at in move:
                    score += self.impacts[t][at]
                if score >= least:
                    found.append((item, min(score, 1.0)))
                goal = item + 1
            else:
                goal = item
                move = [c for c in cursors if c[0] < goal]
            for c in move:
                own = self.postings[c[1]]
                c[2] = bisect_left(own, goal, c[2])
                c[0] = own[c[2]] if c[2] < len(own) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def passages(self, texts: list[list[str]], threshold: float) -> Iterator[tuple[int, int, int, float]]:
        """Text, first word, item and score of all passages that reach the threshold.

        All passages of a batch are bounded block by block first: the sum of their terms' maxima. Only blocks
        whose bound reaches the threshold are searched.
        """
        get, width = self.terms.get, max(1, len(self.terms))
        size = np.array([len(t) for t in texts])
        windows = np.maximum(1, -(-size // self.stride) - 1)
        first = np.concatenate([[0], np.cumsum(windows)[:-1]]) if len(texts) else np.zeros(0, int)
        ids = np.fromiter((get(w, -1) for t in texts for w in t), np.int64, int(size.sum()))
        text = np.repeat(np.arange(len(texts)), size)
        place = np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size)
        known = ids >= 0
        ids, text, place = ids[known], text[known], place[known]
        step = place // self.stride
        here = step < windows[text]
        before = step > 0
        window = np.concatenate([(first[text] + step)[here], (first[text] + step - 1)[before]])
        pairs = np.unique(window * width + np.concatenate([ids[here], ids[before]]))
        window, term = pairs // width, pairs % width
        # One cheap bound by the terms' own maxima, then by blocks.
        may = np.bincount(window, self.top[term], minlength=int(windows.sum())) >= threshold - 1e-9
        keep = may[window]
        window, term = window[keep], term[keep]
        edges = np.flatnonzero(np.diff(window, prepend=-1))
        ends = np.append(edges[1:], len(window))
        for lo in range(0, len(edges), 128):
            hi = min(lo + 128, len(edges))
            own = self.maxima[term[edges[lo] : ends[hi - 1]]]
            live = np.add.reduceat(own, edges[lo:hi] - edges[lo], axis=0) >= threshold - 1e-9
            for k in np.flatnonzero(live.any(axis=1)):
                at = lo + int(k)
                w = int(window[edges[at]])
                source = int(np.searchsorted(first, w, side="right")) - 1
                start = (w - int(first[source])) * self.stride
                for item, score in self.retrieve(term[edges[at] : ends[at]].tolist(), live[k], threshold):
                    yield source, start, item, score


HIT = "first_word bigint, item_id bigint, score double, question_overlap double, answer_overlap double"


def verified(indexes: list[Index], texts: list[list[str]], threshold: float) -> Iterator[tuple[int, int, int, float, float, float]]:
    for index in indexes:
        for source, start, item, score in index.passages(texts, threshold):
            question, answer = index.parts[item]
            passage = texts[source][start : start + 2 * index.stride]
            q, a = overlap(question, passage), overlap(answer, passage)
            if (q >= QUESTION and a >= ANSWER) or q >= ALONE:
                yield source, start, index.items[item][0], score, q, a


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct words of every item that has any: shard, item, stride, n_words, term."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for shard, item, text in zip(batch["shard"], batch["item"], batch["text"], strict=True):
                words = words_of(text)
                rows += [(shard, item, stride_of(words), len(words), w) for w in sorted(set(words))]
            yield pd.DataFrame(rows, columns=["shard", "item", "stride", "n_words", "term"])

    return items.select("shard", "item", "text").mapInPandas(run, "shard bigint, item string, stride bigint, n_words bigint, term string")


def indexes(benchmark: DataFrame, threshold: float = THRESHOLD, shard_items: int = SHARD_ITEMS) -> Iterator[list[Index]]:
    """Indexes of all items for one pass over the documents after the other, small enough to send to tasks.

    Items are cut by hash into shards and within them by stride. Number, mean length and document frequencies
    are aggregates of Spark over all items, so neither cut changes a score; the driver holds the shards of a pass and
    the frequencies of their own words. Equal rows count once.
    """
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where(F.length("text") > 0).distinct()
    shards = max(1, math.ceil(items.count() / shard_items))
    mark = F.xxhash64("item_id", "text")
    items = items.withColumn("shard", F.pmod(mark, F.lit(shards))).withColumn("item", F.sha2(F.concat_ws(":", F.col("item_id").cast("string"), "text"), 256))
    items, terms = stored(items), stored(item_terms(items))
    lengths = terms.groupBy("item").agg(F.max("n_words").alias("n_words"))
    n, mean = lengths.agg(F.count(F.lit(1)), F.avg("n_words")).first()
    df = checkpointed(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    for first in range(0, shards if n else 0, SHARDS_A_PASS):
        found = []
        for shard in range(first, min(first + SHARDS_A_PASS, shards)):
            held = [tuple(r) for r in items.where(F.col("shard") == shard).select("item_id", "text").collect()]
            known = {r.term: r.df for r in df.join(terms.where(F.col("shard") == shard), "term", "left_semi").collect()}
            by_stride: dict[int, list] = {}
            for item in held:
                if words := words_of(item[1]):
                    by_stride.setdefault(stride_of(words), []).append(item)
            found += [Index(own, Statistics(n, mean, known), stride, threshold) for stride, own in sorted(by_stride.items())]
        yield found


def portions(texts: list[str | None], most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Stretches of a batch of about so many characters, so that few are in words at a time; a longer text goes alone."""
    lo, size = 0, 0
    for k, text in enumerate(texts):
        if k > lo and size + len(text or "") > most:
            yield lo, k
            lo, size = k, 0
        size += len(text or "")
    if lo < len(texts):
        yield lo, len(texts)


def _scan(rows: DataFrame, held: list[Index], threshold: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for lo, hi in portions(texts):
                hits = list(verified(held, [words_of(t) for t in texts[lo:hi]], threshold))
                if hits:
                    found = pd.DataFrame(hits, columns=["_at", *(c.split()[0] for c in HIT.split(", "))])
                    own = batch.iloc[lo:hi][["doc_id"]].reset_index(drop=True).iloc[found["_at"]].reset_index(drop=True)
                    yield pd.concat([own, found.drop(columns="_at")], axis=1)

    return through_pandas(rows, run, HIT, "doc_id")


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Verified pairs of document and item: doc_id, item_id, first_word, score, question_overlap, answer_overlap.

    Passages of every whole text query the index; those that reach ``threshold`` of the BM25 score of an item, or of
    its question where that alone might fall short, are checked: question and answer each hold most of their three-word
    runs, or the question nearly all. Passages are two strides long, by the item's own length. The best
    passage of each pair is kept. Null and empty texts or items match nothing; rows that share an id
    give that id's pairs once; items that share an id are told apart only by text. Other columns are ignored.
    """
    rows = docs.select("doc_id", "text")
    found = _scan(rows.limit(0), [], threshold)
    for held in indexes(benchmark, threshold):
        found = found.unionByName(_scan(rows, held, threshold))
    best = Window.partitionBy("doc_id", "item_id").orderBy(F.desc("score"), F.desc("question_overlap"), F.desc("answer_overlap"), "first_word")
    return found.withColumn("_rn", F.row_number().over(best)).where("_rn = 1").drop("_rn")


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that hold no verified item, with all their columns; decided row by row, without a shuffle."""
    for held in indexes(benchmark, threshold):
        docs = docs.where(_clean(held, threshold)(F.col("text")))
    return docs


def _clean(indexes: list[Index], threshold: float):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        stays = np.ones(len(texts), dtype=bool)
        held = texts.tolist()
        for lo, hi in portions(held):
            for hit in verified(indexes, [words_of(t) for t in held[lo:hi]], threshold):
                stays[lo + hit[0]] = False
        return pd.Series(stays)

    return clean


QUERY = "op7_benchmark_leaks"


def query(spark, folder) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
