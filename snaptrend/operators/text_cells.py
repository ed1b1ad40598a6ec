"""TF-IDF weights of texts as packed entries for k-means: terms travel as hashes, and only those of more than one document."""

from __future__ import annotations

import itertools
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaptrend.functions.text import term_words
from snaptrend.operators.clusters import CELLS, group_key, packed_bytes, packed_cell, parts_of, unpacked_numbers
from snaptrend.session import discard, stored

# Executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PLACE = "_g string, block int, part int"
#: Bits of a term's hash that are not asked for, and of those asked for that tell its part.
REST, WIDE = np.uint64(24), 24


def text_cells(
    texts: DataFrame, docs: DataFrame, group: Sequence[str], doc: str, text: str, stop_words: Sequence[str], longest: int = 3, max_df: float = 0.9
) -> tuple[DataFrame, DataFrame]:
    """The weights of ``term_weights`` as cells and blocks of ``packed_k_means``; ``docs`` are the ``laid`` texts with their copies.

    A block of texts asks once, by 40 bits of hash, which of its terms other blocks have too. All others it has found itself:
    terms of one document alone are one direction that no other document has, of which only the squared length is kept. The
    rest goes with 80 bits of hash to the part of the terms, where documents are counted and weights are made. Terms
    that the same documents hold equally often are one there, as ``folded`` does it.
    """
    # A row per group.
    sizes = stored(docs.groupBy("_g").agg(F.max("_blocks").alias("_blocks"), F.max("_n").alias("every"), F.max("_chars").alias("_chars")))
    # Of the entries, about half are left: others are repeated in a text or in no other one.
    parts = parts_of(sizes.select("_g", (F.col("_chars") * longest / 12).alias("_entries")))
    sizes, before = stored(sizes.join(parts, "_g")), sizes
    words = F.transform(term_words(F.col(text), stop_words), lambda w: F.xxhash64(w)).alias("h")
    rows = texts.where(F.concat(*[F.col(c).cast("string") for c in group]).isNotNull()).select(
        group_key(group), F.col(doc).alias("_doc"), F.col("copies").cast("bigint").alias("copies"), words
    )
    rows = rows.join(sizes, "_g").withColumn("block", F.pmod(F.xxhash64("_doc"), F.col("_blocks")).cast("int"))
    # A window group is a block.
    place = (F.dense_rank().over(Window.partitionBy("_g", "block").orderBy("_doc")) - 1).alias("i")
    rows = rows.select("_g", "block", "parts", "units", "every", "copies", "h", place)
    # Stored, since both passes read it: texts are cut into words once.
    said = stored(rows.groupBy("_g", "block").applyInArrow(_said, SAID))
    asked = said.select("_g", "block", "parts", "known", "code", "len").mapInPandas(_asked(longest), f"{PLACE}, ask binary")
    told = stored(asked.groupBy("_g", "part").applyInPandas(_answered, f"{PLACE}, mask binary"))
    sent = said.groupBy("_g", "block").cogroup(told.groupBy("_g", "block")).applyInPandas(_sent(longest, max_df), SENT)
    dealt = stored(sent.groupBy("_g", "part").applyInPandas(_weighed(max_df), CELLS))
    discard(before, sizes, said, told)
    weighed = stored(dealt.select("_g", "part", "block", "units", "n", "x", "own").where("block >= 0").withColumn(
        # Entries are not needed.
        "x", F.when(F.col("part") < 0, F.col("x"))
    ).withColumn("n", F.when(F.col("part") < 0, F.col("n"))).groupBy("_g", "block").applyInPandas(_scaled, CELLS))
    return dealt, weighed


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a term from that of its beginning and its last word."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grams(word: np.ndarray, row: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hash and first place of every term of each length."""
    at, h = np.arange(len(word)), word
    yield h, at
    for size in range(2, longest + 1):
        kept = at + size - 1 < len(word)
        at, h = at[kept], h[kept]
        kept = row[at] == row[at + size - 1]
        at, h = at[kept], h[kept]
        h = _mixed(h, word[at + size - 1])
        yield h, at


def _part_of(asked: np.ndarray, parts: int) -> np.ndarray:
    """Part of a term by the leading bits of its hash: in order of the hash."""
    return (((asked >> np.uint64(40 - WIDE)) * np.uint64(parts)) >> np.uint64(WIDE)).astype(np.int64)


SAID = "_g string, block int, parts int, units int, every long, known binary, code binary, i binary, len binary, copies binary"


def _said(rows: pa.Table) -> pa.Table:
    """Words of a block, as hashes, by the place of their document."""
    rows = rows.take(np.argsort(rows["i"].to_numpy(), kind="stable"))
    lists = rows["h"].combine_chunks()
    known, code = np.unique(lists.flatten().to_numpy().view(np.uint64), return_inverse=True)
    said = (
        known, code.astype(np.int32), rows["i"].to_numpy().astype(np.int32),
        lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32), rows["copies"].to_numpy(),
    )
    head = rows.slice(0, 1).select(["_g", "block", "parts", "units", "every"])
    for name, numbers in zip(("known", "code", "i", "len", "copies"), said):
        head = head.append_column(name, pa.array([packed_bytes(numbers)], pa.binary()))
    return head


def _asked(longest: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For every part, the hashes of a block's terms."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                known, code, sizes = (unpacked_numbers(x) for x in (row.known, row.code, row.len))
                line = np.repeat(np.arange(len(sizes)), sizes)
                h = np.concatenate([h for h, _ in _grams(known[code], line, longest)]) >> REST
                h.sort()
                h = h[np.diff(h, prepend=~h[:1]) != 0]
                bounds = np.searchsorted(_part_of(h, row.parts), np.arange(row.parts + 1))
                cuts = [(p, slice(a, b)) for p, (a, b) in enumerate(itertools.pairwise(bounds)) if a < b]
                # In order, so differences are small. Typed, since a block may have none.
                asks = [packed_bytes(np.diff(h[c], prepend=np.uint64(0))) for _, c in cuts]
                yield pd.DataFrame({"_g": [row[0]] * len(cuts), "block": [row.block] * len(cuts), "part": [p for p, _ in cuts], "ask": asks}, dtype=object)

    return run


def _answered(blocks: pd.DataFrame) -> pd.DataFrame:
    """For the hashes of each block, in its order, whether another block has asked for them as well."""
    asked = [np.cumsum(unpacked_numbers(x), dtype=np.uint64) for x in blocks["ask"]]
    every = np.concatenate(asked)
    every.sort()
    shared = every[1:][every[1:] == every[:-1]]
    shared = np.append(shared[np.diff(shared, prepend=~shared[:1]) != 0], np.uint64(2**64 - 1))
    masks = [packed_bytes(np.packbits(shared[np.searchsorted(shared, h)] == h)) for h in asked]
    return blocks[["_g", "block", "part"]].assign(mask=masks)


SENT = f"{PLACE}, units int, every long, h binary, low binary, docs binary, n binary, doc binary, tf binary"


def _small(numbers: np.ndarray) -> np.ndarray:
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0))))


def _sent(longest: int, max_df: float) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """For every part, the terms of a block that are in more documents than one, and the entries of these.

    The row of a part below zero, one for every block, has the copies of its documents, and in ``doc`` the squares of their
    weights by all other terms.
    """

    def run(said: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        row = said.iloc[0]
        known, code, i, sizes, copies = (unpacked_numbers(row[name]) for name in ("known", "code", "i", "len", "copies"))
        documents, parts, every = int(i.max()) + 1, int(row["parts"]), int(row["every"])
        # A document counts as many times as its rows say, a number said twice once.
        pairs = np.unique(np.stack([i.astype(np.int64), copies]), axis=1)
        many = np.bincount(pairs[0], weights=pairs[1], minlength=documents).astype(np.int64)
        word, lines = known[code], np.repeat(np.arange(len(sizes)), sizes)
        grams = list(_grams(word, lines, longest))
        h, at = (np.concatenate(x) for x in zip(*grams))
        order = np.argsort(h, kind="stable")
        h, doc = h[order], i[lines[at[order]]].astype(np.int64)
        new = np.diff(h, prepend=~h[:1]) != 0
        first = np.flatnonzero(new | (np.diff(doc, prepend=-1) != 0))
        tf, doc, start = np.diff(first, append=len(h)), doc[first], new[first]
        # Of every term its first entry, and how many documents have it.
        begun = np.flatnonzero(start)
        docs = np.diff(begun, append=len(first))
        h, place = h[first[begun]], order[first[begun]]
        asked = h >> REST
        mask = [np.unpackbits(unpacked_numbers(x)) for x in told.sort_values("part")["mask"]]
        distinct = np.diff(asked, prepend=~asked[:1]) != 0
        part = _part_of(asked, parts)
        # Masks are filled up to whole bytes.
        counts = np.bincount(part[distinct], minlength=parts)
        counts = counts[counts > 0]
        shared = np.concatenate([np.zeros(0, bool), *[m[:c].astype(bool) for m, c in zip(mask, counts)]])
        sent = (docs > 1) | shared[np.cumsum(distinct) - 1] if len(h) else np.zeros(0, bool)

        alone = ~np.repeat(sent, docs)
        own, df = doc[alone], many[doc[alone]]
        idf = np.where(df <= max_df * every, np.log((1 + every) / (1 + df)) + 1, 0.0)
        # Without entries the sums would be whole numbers.
        squares = np.bincount(own, weights=(tf[alone] * idf) ** 2, minlength=documents).astype(np.float64)
        # Low bits of the hashes of the terms that are sent, from other hashes of their words.
        low, lane = np.zeros(len(h), np.uint16), known * np.uint64(0xD6E8FEB86659FD93) ^ (known >> np.uint64(32))
        ends = np.cumsum([len(x) for x, _ in grams])
        for size in range(1, longest + 1):
            mine = np.flatnonzero(sent & (place < ends[size - 1]) & (place >= (ends[size - 2] if size > 1 else 0)))
            begin = at[place[mine]]
            other = lane[code[begin]]
            for k in range(1, size):
                other = _mixed(other, lane[code[begin + k]])
            low[mine] = (other >> np.uint64(7)).astype(np.uint16)
        n = np.add.reduceat(many[doc], begun) if len(begun) else np.zeros(0, np.int64)
        entry = np.append(begun, len(doc))
        rows = [(
            -1 - row["block"], None, None, None, packed_bytes(np.bincount(i, weights=copies, minlength=documents).astype(np.int64)), packed_bytes(squares), None
        )]
        bounds = np.searchsorted(part, np.arange(parts + 1))
        for p, (a, b) in enumerate(itertools.pairwise(bounds)):
            kept = np.flatnonzero(sent[a:b]) + a
            if len(kept):
                inside = np.repeat(sent[a:b], docs[a:b])
                mine = slice(entry[a], entry[b])
                rows.append((
                    p, packed_bytes(np.diff(h[kept], prepend=np.uint64(0))), packed_bytes(low[kept]), packed_bytes(_small(docs[kept])),
                    packed_bytes(_small(n[kept])), packed_bytes(_small(doc[mine][inside])), packed_bytes(_small(tf[mine][inside])),
                ))
        out = pd.DataFrame(rows, columns=["part", "h", "low", "docs", "n", "doc", "tf"])
        return out.assign(**{name: row[name] for name in ("_g", "block", "units", "every")})[[x.split()[0] for x in SENT.split(", ")]]

    return run


def _equal_runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys, and where in it another combination begins. The first key alone tells nearly all apart."""
    order = np.argsort(keys[0], kind="stable")
    changed = [np.diff(k[order], prepend=~k[order[:1]]) != 0 for k in keys]
    if (~changed[0] & np.logical_or.reduce(changed)).any():
        order = np.lexsort(keys[::-1])
        changed = [np.diff(k[order], prepend=~k[order[:1]]) != 0 for k in keys]
    return order, np.logical_or.reduce(changed)


def _weighed(max_df: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Cells of a part, by block: terms that are one, their weights, and in ``own`` the squared weights of the documents."""

    def run(blocks: pd.DataFrame) -> pd.DataFrame:
        names = [x.split()[0] for x in CELLS.split(", ")]
        if blocks["part"].iloc[0] < 0:
            return blocks.assign(part=-1, t=None, x=blocks["doc"], own=None)[names]
        blocks = blocks.sort_values("block")
        every = int(blocks["every"].iloc[0])
        h = [np.cumsum(unpacked_numbers(x), dtype=np.uint64) for x in blocks["h"]]
        upto = np.cumsum([0, *map(len, h)])
        docs, n = (np.concatenate([unpacked_numbers(x).astype(np.int64) for x in blocks[name]]) for name in ("docs", "n"))
        order, new = _equal_runs(np.concatenate(h), np.concatenate([unpacked_numbers(x) for x in blocks["low"]]))
        del h
        begun = np.flatnonzero(new)
        term = np.empty(len(order), np.int64)
        term[order] = np.cumsum(new) - 1
        df, size = np.add.reduceat(n[order], begun), np.add.reduceat(docs[order], begun)
        idf = np.log((1 + every) / (1 + df)) + 1
        # Terms of the same documents, equally often each, are one.
        sums = []
        for block, a, b, doc, tf in zip(blocks["block"], upto, upto[1:], blocks["doc"], blocks["tf"]):
            key = (np.uint64(block) << np.uint64(32)) + unpacked_numbers(doc).astype(np.uint64)
            many = unpacked_numbers(tf).astype(np.uint64)
            starts = np.cumsum(docs[a:b]) - docs[a:b]
            sums.append([np.add.reduceat(_mixed(key, many * np.uint64(odd)), starts) for odd in (0xA24BAED4963EE407, 0x9FB21C651E98DF25)])
        marks = [np.add.reduceat(np.concatenate(x)[order], begun) for x in zip(*sums)]
        kept = np.flatnonzero(df <= max_df * every)
        del sums, order
        if not len(kept):
            return pd.DataFrame(columns=names)
        alike, new = _equal_runs(marks[0][kept], marks[1][kept], size[kept])
        first = kept[alike[np.flatnonzero(new)]]
        number = np.diff(np.flatnonzero(new), append=len(kept))
        # Frequent terms have the lowest numbers, which lie close together.
        rank = np.argsort(-size[first], kind="stable")
        by = idf[first[rank]] * np.sqrt(number[rank])
        to = np.full(len(df), -1, np.int64)
        to[first[rank]] = np.arange(len(first))
        rows = [(-1, None, None, packed_bytes(by), None)]
        for block, a, b, doc, tf in zip(blocks["block"], upto, upto[1:], blocks["doc"], blocks["tf"]):
            t = np.repeat(to[term[a:b]], docs[a:b])
            held = np.flatnonzero(t >= 0)
            if len(held):
                t, i, x = t[held], unpacked_numbers(doc)[held].astype(np.int64), unpacked_numbers(tf)[held]
                sort = np.argsort(i * len(by) + t)
                t, i, x = t[sort], i[sort], x[sort]
                cell = packed_cell(t, i, x)
                rows.append((block, cell["t"], cell["n"], cell["x"], packed_bytes(np.bincount(i, weights=(x * by[t]) ** 2))))
        out = pd.DataFrame(rows, columns=["block", "t", "n", "x", "own"])
        return out.assign(**{name: blocks[name].iloc[0] for name in ("_g", "part", "units")})[names]

    return run


def _scaled(rows: pd.DataFrame) -> pd.DataFrame:
    """A block with the factors that make its documents as long as one, and the squares of what a document has alone."""
    row = rows[rows["part"] < 0].iloc[0]
    own = unpacked_numbers(row["x"])
    squares = own.copy()
    for some in rows[rows["part"] >= 0].sort_values("part")["own"]:
        some = unpacked_numbers(some)
        squares[: len(some)] += some
    held = squares > 0
    scale = np.divide(1.0, np.sqrt(squares), out=np.zeros_like(squares), where=held)
    own = np.divide(own, squares, out=np.zeros_like(squares), where=held)
    return pd.DataFrame({
        "_g": [row["_g"]], "part": [-1], "block": [row["block"]], "units": [row["units"]], "t": [None], "n": [row["n"]],
        "x": [packed_bytes(scale)], "own": [packed_bytes(own)],
    })
