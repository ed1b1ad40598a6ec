"""Near-duplicate texts: order MinHash sketches find candidates, a banded alignment verifies them.

A text is the sequence of its runs of five words, each with the number of its occurrence. A sketch unit
takes the few runs that are least under one hash and keeps them in text order, so that two texts agree in a unit if
they share those runs in the same order. The similarity of two texts is ``L / (n + m - L)``, where ``L`` is the longest
common subsequence of their runs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrend.llm.rows import KEY_SCHEMA, KEYS, keyed, ship, stored, table

ship(__name__)

WORD = re.compile(r"\w+")
RUN = 5
SIMILARITY = 0.8

#: Units of a sketch and the runs that each takes; short texts have units of fewer runs, and those in between have both.
UNITS, TAKEN = 32, 5
SHORT_UNITS, SHORT_TAKEN = 16, 2
SHORT, LONG = 40, 25
#: Units in which two long texts must agree. Two texts of similarity 0.8 agree in ten of 32 on average; in fewer than
#: two once in about 20,000 pairs.
AGREE = 2

#: Texts of one block, and runs; two blocks meet in a task.
BLOCK_TEXTS, BLOCK_RUNS = 256, 400_000

def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: Unrelated seeds, one for every unit.
_SEEDS = mixed(np.arange(1, UNITS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def runs_of(text: str | None) -> tuple[np.ndarray, int]:
    """Hashes of the five-word runs in text order, and one of all words; a shorter text is one run, if it has words."""
    words = WORD.findall((text or "").lower())
    whole = xxhash.xxh64_intdigest(" ".join(words).encode("utf-8", "surrogatepass"))
    if not words:
        return np.zeros(0, np.uint64), whole
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    names = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in known), np.uint64, len(known))
    word = names[ids]
    n = max(1, len(word) - RUN + 1)
    run = np.zeros(n, np.uint64)
    for k in range(min(RUN, len(word))):
        run = run * np.uint64(0x9E3779B97F4A7C15) + word[k : k + n]
    return mixed(run), whole


def labelled(runs: np.ndarray) -> np.ndarray:
    """Runs told apart by the number of their occurrence."""
    order = np.argsort(runs, kind="stable")
    same = runs[order]
    first = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]])) if len(same) else np.zeros(0, int)
    count = np.arange(len(same)) - np.repeat(first, np.diff(np.append(first, len(same))))
    out = np.empty_like(runs)
    out[order] = mixed(same + count.astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))
    return out


def units(runs: np.ndarray) -> np.ndarray:
    """Keys of the sketch: the least runs under every hash, in text order."""
    n = len(runs)
    keys = []
    marks = labelled(runs)
    for kind, count, taken, use in ((1, SHORT_UNITS, SHORT_TAKEN, n <= SHORT), (2, UNITS, TAKEN, n >= LONG)):
        if not use or n == 0:
            continue
        few = min(taken, n)
        least = np.empty((count, few), np.int64)
        for lo in range(0, count, 8):
            ranked = mixed_rows(marks, _SEEDS[lo : lo + 8])[: count - lo]
            least[lo : lo + 8] = np.argpartition(ranked, few - 1, axis=1)[:, :few] if few < n else np.arange(n)
        picked = marks[np.sort(least, axis=1)]
        key = np.full(count, kind, np.uint64) * np.uint64(0xA24BAED4963EE407) + np.arange(count, dtype=np.uint64)
        for k in range(few):
            key = mixed(key) + picked[:, k]
        keys.append(mixed(key))
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def mixed_rows(marks: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Ranks of the runs under every unit's own hash; multiples of one number would agree or fail together."""
    return mixed(marks[None, :] ^ seeds[:, None])


def sketches(docs: DataFrame) -> DataFrame:
    """Identity, hash of the words, number of runs and sketch of every text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [runs_of(t) for t in batch["_text"]]
            yield pd.DataFrame({
                "_id": batch["_id"], "_hash": batch["_hash"],
                "fp": np.array([w for _, w in found], np.uint64).view(np.int64), "n": [len(r) for r, _ in found],
                "units": [units(r).view(np.int64) for r, _ in found],
            })

    return keyed(docs, F.col("text").alias("_text")).mapInPandas(run, f"{KEY_SCHEMA}, fp bigint, n int, units array<bigint>")


# --- connected components -------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """Least node of the component of every node that has a link: node, label.

    Every node points to its least neighbour if that is less, and the pointers are followed to their ends by
    doubling. Links are then drawn between ends; those within one are gone, so each round has far fewer than the
    last. All joins are by node, and sums are partial.
    """
    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    edges = stored(links.where("a <> b").select(*ordered("a", "b")).distinct())
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        ends = stored(least.select(F.col("a").alias("node"), F.least("a", "m").alias("up")))
        while True:
            above = ends.select(F.col("node").alias("up"), F.col("up").alias("top"))
            new = stored(ends.join(above, "up").select("node", F.col("up").alias("old"), F.col("top").alias("up")))
            done = new.where("old <> up").isEmpty()
            ends = new.select("node", "up")
            if done:
                break
        if labels is None:
            labels = ends.select("node", F.col("up").alias("label"))
        else:
            moved = ends.select(F.col("node").alias("label"), "up")
            labels = stored(labels.join(moved, "label", "left").select("node", F.coalesce("up", "label").alias("label")))
        here = ends.select(F.col("node").alias("a"), F.col("up").alias("x"))
        there = ends.select(F.col("node").alias("b"), F.col("up").alias("y"))
        edges = stored(edges.join(here, "a").join(there, "b").where("x <> y").select(*ordered("x", "y")).distinct())
        if edges.isEmpty():
            return labels


# --- verification ---------------------------------------------------------------------------


def common_length(x: np.ndarray, y: np.ndarray, band: int) -> int:
    """Longest common subsequence along diagonals at most ``band`` apart, one machine word per 30 or so cells.

    A column of the alignment is one large integer with a bit per run of ``x``; matches outside the band are
    masked. A subsequence long enough for the wanted similarity never leaves the band.
    """
    places: dict[int, int] = {}
    for i, v in enumerate(x.tolist()):
        places[v] = places.get(v, 0) | (1 << i)
    n = len(x)
    full = (1 << n) - 1
    row = full
    window = (1 << (2 * band + 1)) - 1
    for j, v in enumerate(y.tolist()):
        match = places.get(v)
        if match is None:
            continue
        shift = j - band
        match &= window << shift if shift >= 0 else window >> -shift
        u = row & match
        row = ((row + u) | (row - u)) & full
    return n - row.bit_count()


def similar(x: np.ndarray, y: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether the alignment of two sequences of runs reaches the similarity."""
    n, m = len(x), len(y)
    if not n or not m:
        return n == m
    need = int(np.ceil(least / (1 + least) * (n + m) - 1e-9))
    if min(n, m) < need:
        return False
    # Equal ends belong to some longest subsequence, so only what lies between them is aligned.
    k = min(n, m)
    head = np.flatnonzero(x[:k] != y[:k])
    head = int(head[0]) if len(head) else k
    x, y, k = x[head:], y[head:], k - head
    tail = np.flatnonzero(x[::-1][:k] != y[::-1][:k])
    tail = int(tail[0]) if len(tail) else k
    x, y = x[: len(x) - tail], y[: len(y) - tail]
    rest = need - head - tail
    if rest <= 0:
        return True
    if min(len(x), len(y)) < rest:
        return False
    band = max(len(x), len(y)) - rest
    return common_length(x, y, band) >= rest


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.top(x)] = self.top(y)


def tile_links(fps: list[int], texts: list[str], left: np.ndarray, right: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Links between two blocks (or in one) that join texts which no earlier link joined.

    All pairs whose sketches agree are weighed, best agreement first; a pair that is already joined needs no alignment.
    """
    runs = [runs_of(t)[0] for t in texts]
    marks = [np.sort(labelled(r)) for r in runs]
    keys = [units(r) for r in runs]
    size = np.array([len(r) for r in runs])
    # Texts by key: only texts that share one are paired.
    owner = np.repeat(np.arange(len(runs)), [len(k) for k in keys])
    flat = np.concatenate(keys) if len(keys) else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    _, inverse = np.unique(flat[order], return_inverse=True)
    table_ = np.zeros((len(runs), int(inverse.max()) + 1 if len(inverse) else 0), np.float32)
    table_[owner[order], inverse] = 1
    agree = table_[left] @ table_[right].T
    ratio = np.minimum(size[left][:, None], size[right][None, :]) >= least * np.maximum(size[left][:, None], size[right][None, :])
    short = np.minimum(size[left][:, None], size[right][None, :]) <= SHORT
    wanted = np.where(short, 1, AGREE)
    rows, cols = np.nonzero((agree >= wanted) & ratio & (left[:, None] != right[None, :]))
    best = np.argsort(-agree[rows, cols], kind="stable")
    forest, links = Forest(len(runs)), []
    for k in best:
        x, y = int(left[rows[k]]), int(right[cols[k]])
        if forest.top(x) == forest.top(y):
            continue
        shared = np.isin(marks[x], marks[y], assume_unique=True).sum()
        if shared * (1 + least) >= least * (size[x] + size[y]) - 1e-9 and similar(runs[x], runs[y], least):
            forest.join(x, y)
            links.append((fps[x], fps[y]))
    return links


def verified_links(docs: DataFrame, nodes: DataFrame, coarse: DataFrame, least: float) -> DataFrame:
    """Verified links between different texts of one coarse group, as many as join them.

    A group is cut into blocks; every two blocks meet in a task of their own, so that a group of any size is
    spread and no task holds more than two blocks.
    """
    inside = nodes.join(coarse, nodes["fp"] == coarse["node"]).select("fp", "n", "_id", "_hash", "label")
    sizes = inside.groupBy("label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    blocks = F.greatest(F.ceil(F.col("c") / BLOCK_TEXTS), F.ceil(F.col("s") / BLOCK_RUNS)).cast("int")
    placed = inside.join(sizes.select("label", blocks.alias("of")), "label")
    placed = placed.withColumn("blk", F.pmod(F.xxhash64("fp"), F.col("of")).cast("int"))
    texts = keyed(docs, F.col("text").alias("_text")).join(placed.select("fp", *KEYS, "label", "of", "blk"), list(KEYS))
    tiles = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1))).select(
        "label", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"), "blk", "fp", "_text",
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # Rows equal in id and text are one text.
        rows = rows.drop_duplicates("fp").sort_values("fp")
        blk = rows["blk"].to_numpy()
        lo, hi = rows["lo"].iloc[0], rows["hi"].iloc[0]
        left, right = np.flatnonzero(blk == lo), np.flatnonzero(blk == hi)
        links = tile_links(rows["fp"].tolist(), rows["_text"].tolist(), left, right, least)
        return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)

    return tiles.groupBy("label", "lo", "hi").applyInPandas(run, "a bigint, b bigint")


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Class of every row: _id, _hash, class_id (the least id in it), representative (whether the row is the one to keep),
    and links (to how many other texts verified links lead; links within a class are as many as join it).

    Texts of equal words are one text, those without words too. Rows equal in id and text share a row here. Null
    ids come first. Other texts are in one class if a chain of similarities of ``least`` or more joins them.
    """
    seen = stored(sketches(docs).dropDuplicates(list(KEYS)))
    nodes = stored(
        seen.groupBy("fp").agg(F.min(F.struct("_id", "_hash")).alias("k"), F.min("n").alias("n"))
        .select("fp", "n", F.col("k._id").alias("_id"), F.col("k._hash").alias("_hash"))
    )
    keys = seen.join(nodes.select(*KEYS), list(KEYS), "left_semi").select("fp", F.explode("units").alias("key"))
    shared = keys.groupBy("key").agg(F.min("fp").alias("first"), F.max("fp").alias("last")).where("first <> last")
    near = keys.join(shared.select("key", "first"), "key").where("fp <> first").select(F.col("fp").alias("a"), F.col("first").alias("b"))
    coarse = components(near.distinct())
    links = stored(verified_links(docs, nodes, coarse, least))
    labels = components(links)
    degree = links.select("a").unionByName(links.select(F.col("b").alias("a"))).groupBy("a").agg(F.count(F.lit(1)).alias("links"))
    named = (
        nodes.join(labels, nodes["fp"] == labels["node"], "left").drop("node")
        .join(degree, nodes["fp"] == degree["a"], "left")
        .select("fp", "_id", "_hash", F.coalesce("label", "fp").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    named = stored(named)
    heads = named.groupBy("label").agg(F.min(F.struct("_id", "_hash")).alias("head"))
    heads = named.join(heads, "label").select("fp", "links", "head")
    return seen.select(*KEYS, "fp").join(heads, "fp").select(
        *KEYS, F.col("head._id").alias("class_id"),
        ((F.col("_id") == F.col("head._id")) & (F.col("_hash") == F.col("head._hash"))).alias("representative"), "links",
    )


def one_of_each(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One document of each class, the one with the least id, with all its columns; of rows equal in id and text, one.

    The texts are not shuffled but for the join with the ids that stay.
    """
    names = docs.columns
    stay = classes(docs, least).where("representative").select(*KEYS)
    inner = [F.col(f"`{n}`").alias(f"_c{i}") for i, n in enumerate(names)]
    kept = keyed(docs, *inner).join(stay, list(KEYS), "left_semi").dropDuplicates(list(KEYS))
    return kept.select(*[f"_c{i}" for i in range(len(names))]).toDF(*names)


QUERY = "op8_order_minhash"


def query(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents")
    return classes(docs).select(F.col("_id").alias("doc_id"), "class_id", "representative", "links")
