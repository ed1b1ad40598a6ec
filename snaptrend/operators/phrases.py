"""Phrases of labelled documents by their mean TF-IDF weight, without moving the weights."""

from __future__ import annotations

import itertools
import sys
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrend.functions.text import term_words
from snaptrend.operators.ranking import top_per_group
from snaptrend.session import stored

# Executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of a block of documents, and entries of a part of the terms, about: what tasks hold at a time.
CHARS, PART = 4_000_000, 4_000_000
#: Weights are summed as integers of this unit, so that sums and ties do not depend on row order.
UNIT = 1_000_000_000
#: Terms found in fewer documents than this share of a label's documents are first taken to be none of its best.
RARE = 0.005
BLOCK, PLACE = ("_g", "_c", "_block"), "_g string, _c string, _block int"


def label_phrases(
    docs: DataFrame,
    group: Sequence[str],
    doc: str,
    text: str,
    stop_words: Sequence[str],
    limit: int = 8,
    longest: int = 3,
    max_df: float = 0.9,
) -> DataFrame:
    """Per group and ``label`` of ``docs`` the terms of highest mean weight, as an array in order.

    The same as ``cluster_phrases`` of ``term_weights``, for labels that are known beforehand. The documents of a label lie in
    blocks. A block sends each of its terms once, as a hash of 80 bits and the number of its documents with it, to the part of
    the terms where it is counted, and gets the numbers of all documents and of the label's back. So it has the exact weights
    of its documents at hand: neither weights nor terms as text are shuffled, and a frequent term is one entry a block.

    A weight is at most one, so the sum of a term is at most the number of the label's documents with it. Blocks send the sums
    of terms that enough documents hold; where others may reach the last of the best, that label is done again with its sum as
    the limit, which leaves nothing out.
    """
    group = list(group)
    whole = F.concat(*[F.col(c).cast("string") for c in group]).isNotNull()
    rows = docs.where(whole).select(
        F.to_json(F.struct(*group)).alias("_g"), F.to_json(F.struct("label")).alias("_c"), *group, "label", F.col(doc).alias("_doc"), text
    )
    # A row per label.
    labels = stored(rows.groupBy("_g", "_c", *group, "label").agg(
        F.count(F.lit(1)).alias("_docs"), F.coalesce(F.sum(F.char_length(text)), F.lit(0)).alias("_chars")
    ))
    entries = lambda chars: F.col(chars) * longest / 6
    tasks = docs.sparkSession.sparkContext.defaultParallelism
    # A row per group. Small inputs are cut finer, as far as there are cores.
    sizes = labels.groupBy("_g").agg(F.sum("_docs").alias("_all"), F.sum("_chars").alias("_every"), F.count(F.lit(1)).alias("_labels"))
    fine = lambda chars: F.floor(entries(chars) / (PART // 20))
    sizes = stored(labels.join(sizes, "_g").select(
        "_g", "_c", "_all",
        F.greatest(F.lit(1), F.ceil(F.col("_chars") / CHARS), F.least(F.floor(tasks / F.col("_labels")), fine("_chars"))).cast("int").alias("_blocks"),
        F.greatest(F.lit(1), F.ceil(entries("_every") / PART), F.least(F.lit(tasks), fine("_every"))).cast("int").alias("_parts"),
    ))
    words = F.array_join(term_words(F.col(text), stop_words), " ").alias("_words")
    block = F.pmod(F.xxhash64("_doc"), F.col("_blocks")).cast("int").alias("_block")
    # Stored, since both passes read it: texts are normalised once.
    texts = stored(rows.where(F.col("_doc").isNotNull()).join(sizes, ["_g", "_c"]).select("_g", "_c", block, "_doc", "_all", "_parts", words))
    asked = texts.groupBy(*BLOCK).applyInPandas(_asked(longest), f"{PLACE}, part int, h binary, low binary, n binary")
    told = stored(asked.groupBy("_g", "part").applyInPandas(_counted, f"{PLACE}, part int, df binary, own binary"))

    def best_of(floors: DataFrame) -> DataFrame:
        held = texts.join(floors, ["_g", "_c"])
        sums = held.groupBy(*BLOCK).cogroup(told.groupBy(*BLOCK)).applyInPandas(
            _sums(longest, max_df), "_g string, _c string, term string, part_sum long"
        ).groupBy("_g", "_c", "term").agg(F.sum("part_sum").alias("_sum")).where(F.col("_sum") > 0)
        return stored(top_per_group(sums, ["_g", "_c"], [F.col("_sum").desc(), F.col("term")], limit, "_rank"))

    floors = labels.where(F.col("label").isNotNull()).select("_g", "_c", (F.col("_docs") * RARE).alias("_floor"))
    found = best_of(floors)
    last = found.groupBy("_g", "_c").agg(F.count(F.lit(1)).alias("_n"), F.min("_sum").alias("_last"))
    reached = F.when(F.col("_n") == limit, F.col("_last") / F.lit(UNIT)).otherwise(F.lit(0.0))
    # Every term is in one document at least, so nothing was left out below that.
    again = floors.where(F.col("_floor") > 1).join(last, ["_g", "_c"], "left").withColumn("_next", F.coalesce(reached, F.lit(0.0)))
    again = stored(again.where(F.col("_next") < F.col("_floor")).select("_g", "_c", F.col("_next").alias("_floor")))
    if not again.isEmpty():
        found = found.join(again, ["_g", "_c"], "left_anti").unionByName(best_of(again))
    scored = found.join(labels, ["_g", "_c"]).withColumn("_mean", F.col("_sum") / F.lit(UNIT) / F.col("_docs"))
    listed = F.array_sort(F.collect_list(F.struct("_rank", "term", "_mean")))
    return scored.groupBy(*group, "label").agg(
        F.transform(listed, lambda x: x["term"]).alias("phrases"),
        F.transform(listed, lambda x: x["_mean"]).alias("scores"),
    )


def _planes(numbers: np.ndarray) -> bytes:
    """Bytes of numbers by their place in the number: equal ones lie side by side and pack well."""
    return numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T.tobytes()


def _numbers(planes: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(planes, np.uint8).reshape(size, -1).T.copy().view(kind).reshape(-1)


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a term from that of its beginning and its last word."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Terms:
    """Distinct terms of a block in the order of their part and hash, and the entries of its documents."""

    def __init__(self, rows: pd.DataFrame, longest: int):
        said = [w.split(" ") if w else [] for w in rows["_words"]]
        at = np.repeat(np.arange(len(said)), [len(s) for s in said])
        self.words = np.array(list(itertools.chain.from_iterable(said)), dtype=object)
        word, known = pd.factorize(self.words)
        word, known = word.astype(np.int64), np.asarray(known, dtype=object)
        lanes = [pd.util.hash_array(known, hash_key=key, categorize=False) for key in ("terms of a block", "and its low bits")]
        # Terms of a length by place; those of one word are the words.
        term, hashes = word, lanes
        first = np.zeros(len(known), np.int64)
        first[word[::-1]] = np.arange(len(word))[::-1]
        h, low, firsts, sizes, chars, terms, docs = [], [], [], [], [], [], []
        begun = 0
        for size in range(1, longest + 1):
            starts = np.arange(max(0, len(word) - size + 1))
            starts = starts[at[starts] == at[starts + size - 1]]
            if size > 1:
                key, first, short = np.unique(term[starts] * max(1, len(known)) + word[starts + size - 1], return_index=True, return_inverse=True)
                first = starts[first]
                hashes = [_mixed(one[term[first]], lane[word[first + size - 1]]) for one, lane in zip(hashes, lanes)]
                term = np.full(len(word), -1, np.int64)
                term[starts] = short
            h.append(hashes[0]), low.append(hashes[1]), firsts.append(first)
            sizes.append(np.full(len(first), size))
            chars.append(np.array([len(w) for w in known], np.int64) if size == 1 else np.full(len(first), 3))
            terms.append(term[starts] + begun), docs.append(at[starts])
            begun += len(first)
        h, low = np.concatenate(h), np.concatenate(low)
        parts = int(rows["_parts"].iloc[0])
        part = ((low >> np.uint64(16)) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((h, part))
        self.h, self.low, part = h[order], low[order].astype(np.uint16), part[order]
        self.bounds = np.searchsorted(part, np.arange(parts + 1))
        self.first, self.size, self.chars = (np.concatenate(x)[order] for x in (firsts, sizes, chars))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        pairs, self.tf = np.unique(place[np.concatenate(terms)] * len(said) + np.concatenate(docs), return_counts=True)
        self.term, self.doc = pairs // len(said), pairs % len(said)

    def shown(self, term: int) -> str:
        return " ".join(self.words[self.first[term] : self.first[term] + self.size[term]])


def _asked(longest: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Terms of a block by part, in how many of its documents each is."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        terms = _Terms(rows.sort_values("_doc"), longest)
        n = np.bincount(terms.term, minlength=len(terms.h)).astype(np.uint32)
        cuts = [(p, slice(a, b)) for p, (a, b) in enumerate(itertools.pairwise(terms.bounds)) if a < b]
        place = {name: [rows[name].iloc[0]] * len(cuts) for name in BLOCK}
        return pd.DataFrame({
            **place, "part": [p for p, _ in cuts],
            # In order, so differences are small.
            "h": [_planes(np.diff(terms.h[c], prepend=np.uint64(0))) for _, c in cuts],
            "low": [_planes(terms.low[c]) for _, c in cuts], "n": [_planes(n[c]) for _, c in cuts],
        }, dtype=object)

    return run


def _counted(blocks: pd.DataFrame) -> pd.DataFrame:
    """For the terms of each block, in its order, how many documents have them, and how many of the block's label."""
    h = np.concatenate([np.cumsum(_numbers(x, np.uint64), dtype=np.uint64) for x in blocks["h"]])
    low = np.concatenate([_numbers(x, np.uint16) for x in blocks["low"]])
    n = [_numbers(x, np.uint32) for x in blocks["n"]]
    upto = np.cumsum([0, *map(len, n)])
    label = np.repeat(pd.factorize(blocks["_c"])[0], np.diff(upto))
    order = np.lexsort((label, low, h))
    h, low, label, n = h[order], low[order], label[order], np.concatenate(n)[order]
    other = (h[1:] != h[:-1]) | (low[1:] != low[:-1])
    counts = []
    for new in (other, other | (label[1:] != label[:-1])):
        run = np.cumsum(np.concatenate([[False], new]))
        count = np.empty(len(order), np.int64)
        count[order] = np.bincount(run, weights=n)[run].astype(np.int64)
        counts.append([_planes(count[a:b]) for a, b in itertools.pairwise(upto)])
    return blocks[[*BLOCK, "part"]].assign(df=counts[0], own=counts[1])


def _sums(longest: int, max_df: float) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Summed weights of the terms that enough documents of a block's label have."""

    def run(rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(told):
            return pd.DataFrame({"_g": [], "_c": [], "term": [], "part_sum": []}, dtype=object)
        terms, told = _Terms(rows.sort_values("_doc"), longest), told.sort_values("part")
        df, own = (np.concatenate([_numbers(x, np.int64) for x in told[name]]) for name in ("df", "own"))
        every = int(rows["_all"].iloc[0])
        idf = np.where(df <= max_df * every, np.log((1 + every) / (1 + df)) + 1, 0.0)
        raw = terms.tf * idf[terms.term]
        length = np.sqrt(np.bincount(terms.doc, weights=raw * raw, minlength=len(rows)))
        sent = (idf > 0) & (own >= rows["_floor"].iloc[0]) & (terms.chars > 2)
        kept = sent[terms.term]
        units = np.floor(raw[kept] / length[terms.doc[kept]] * UNIT + 0.5)
        sums = np.bincount(terms.term[kept], weights=units, minlength=len(df)).astype(np.int64)
        at = np.flatnonzero(sent)
        # Typed, since a block may have none.
        return pd.DataFrame({
            "_g": [rows["_g"].iloc[0]] * len(at), "_c": [rows["_c"].iloc[0]] * len(at), "term": [terms.shown(t) for t in at], "part_sum": sums[at],
        }, dtype=object)

    return run
