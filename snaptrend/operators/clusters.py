"""k-means over exact sparse term weights, for all groups and all starts at once."""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaptrend.session import checkpointed, discard, shuffles_cleaned, stored

# Executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST_CLUSTERS = 5
#: Documents and characters of a block, and entries of a part of the terms, about: what tasks work on at a time. A task of a round
#: goes through the parts of a unit one by one, and holds their packed entries.
BLOCK, CHARS, PART, UNIT = 4096, 6_000_000, 4_000_000, 64_000_000


def cluster_count_column(documents: Column) -> Column:
    """Clusters for a number of documents: each its own up to two, then about the root, two to five."""
    root = F.least(F.lit(MOST_CLUSTERS), F.ceil(F.sqrt(documents.cast("double"))))
    return F.when(documents <= 2, documents).otherwise(F.greatest(F.lit(2), root)).cast("int")


def _sims(weights: DataFrame, centres: DataFrame, group: list[str], doc: str, names: list[str]) -> DataFrame:
    """Inner product of every document with every named centre: one join on the term, sums per document."""
    parts = [F.sum(F.col("weight") * F.col(n)).alias(n) for n in names]
    return weights.join(centres, [*group, "term"]).groupBy(*group, doc).agg(*parts)


def _uniform(doc: str, *salt: int) -> Column:
    """A number between 0 and 1, both left out, that depends on the document and the salt alone."""
    return (F.shiftrightunsigned(F.xxhash64(doc, *map(F.lit, salt)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def _turn(doc: str, near: Column, many: Column, seed: int, s: int, c: int) -> Column:
    """What is least for the document that is the first centre of cluster ``c`` in start ``s``.

    Even starts take the document least like those taken, which finds clusters that lie far apart for certain; odd ones draw,
    each document with a chance in proportion to its squared distance from the nearest one drawn before, which outliers mislead
    less. The first document of a start is picked by hash. For a draw documents run a race, as exponential times
    ``-ln(u) / distance²`` have that chance to be the least: a minimum per group, folded before any shuffle.
    ``u`` is a hash of the document, so reruns draw alike. A copy of a drawn document is not drawn while others are left.
    A row that stands for ``many`` copies has as many chances.
    """
    near, tie = F.round(near, 9), F.xxhash64(doc, F.lit(seed + s))
    if s % 2 == 0:
        return F.struct(near, tie)
    # Vectors have length one.
    apart = F.lit(1.0) if c == 0 else F.greatest(2 - 2 * near, F.lit(0.0))
    race = -F.log(_uniform(doc, seed, s, c)) / F.nullif(apart * many, F.lit(0.0))
    return F.struct(race.isNull(), race, tie)


def _picked(
    weights: DataFrame, docs: DataFrame, group: list[str], doc: str, clusters: int, starts: int, seed: int
) -> DataFrame:
    """Documents ``doc`` that are the first centre of cluster ``c`` in start ``s``, from rows of weights."""
    held = weights.select(*group, doc).distinct().join(docs, [*group, doc])
    state = checkpointed(held.select(*group, doc, *[F.lit(-1.0).alias(f"near{s}") for s in range(starts)]))
    picked = None
    for c in range(clusters):
        chosen = [F.min_by(doc, _turn(doc, F.col(f"near{s}"), F.lit(1.0), seed, s, c)).alias(f"s{s}") for s in range(starts)]
        # A row per group.
        row = state.groupBy(*group).agg(*chosen)
        one = row.select(
            *group, F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.col(f"s{s}").alias(doc)) for s in range(starts)])).alias("p")
        ).select(*group, "p.s", f"p.{doc}", F.lit(c).alias("c"))
        one = checkpointed(one)
        picked = one if picked is None else picked.unionByName(one)
        if c + 1 < clusters:
            latest = weights.join(one, [*group, doc]).groupBy(*group, "term").agg(
                *[F.sum(F.when(F.col("s") == s, F.col("weight"))).alias(f"n{s}") for s in range(starts)]
            )
            sims = _sims(weights, latest, group, doc, [f"n{s}" for s in range(starts)])
            state = checkpointed(
                state.join(sims, [*group, doc], "left").select(
                    *group, doc, *[F.greatest(f"near{s}", F.coalesce(f"n{s}", F.lit(0.0))).alias(f"near{s}") for s in range(starts)]
                )
            )
    return picked


def _starting(
    weights: DataFrame, docs: DataFrame, group: list[str], doc: str, clusters: int, starts: int, seed: int
) -> DataFrame:
    """First centres of every start, one column each by term."""
    picked = _picked(weights, docs, group, doc, clusters, starts, seed)
    cells = [
        F.sum(F.when((F.col("s") == s) & (F.col("c") == c), F.col("weight"))).alias(f"c{s}_{c}")
        for s in range(starts) for c in range(clusters)
    ]
    return weights.join(picked, [*group, doc]).groupBy(*group, "term").agg(*cells)


def folded(weights: DataFrame, group: list[str], doc: str) -> DataFrame:
    """The same vectors with fewer terms: a row per distinct column of weights, and how many terms have it.

    Terms that the same documents hold with the same weights are one direction of the space: ``m`` of them give every
    inner product that one with ``sqrt(m)`` times the weights gives. Most long phrases are such, for they occur in one text
    or its near copies alone. Columns are compared by 128 bits of hash.
    """
    marks = weights.groupBy(*group, "term").agg(
        F.count(F.lit(1)).alias("_n"),
        F.bit_xor(F.xxhash64(doc, "weight")).alias("_x"), F.bit_xor(F.xxhash64("weight", doc, F.lit(1))).alias("_y"),
    )
    return marks.groupBy(*group, "_n", "_x", "_y").agg(F.min("term").alias("term"), F.count(F.lit(1)).alias("_m")).drop("_x", "_y")


def k_means(
    weights: DataFrame,
    docs: DataFrame,
    group: Sequence[str],
    doc: str,
    clusters: int | None = None,
    starts: int = 10,
    seed: int = 42,
    rounds: int = 300,
    copies: str | None = None,
) -> DataFrame:
    """Document and ``label`` within its group: Lloyd's rounds to a standstill, the best of ``starts``.

    ``weights`` has one row per document and term, ``docs`` one per document; both have the group. A row of ``docs`` may
    stand for many equal documents, their number in the column ``copies``.
    """
    docs = laid(docs, group, doc, clusters, copies)
    with shuffles_cleaned(docs.sparkSession):
        cells, blocks = _dealt(weights.select(group_key(group), F.col(doc).alias("_doc"), "term", "weight"), docs)
        return packed_k_means(cells, blocks, docs, group, doc, clusters, starts, seed, rounds)


def group_key(group: Sequence[str]) -> Column:
    return F.to_json(F.struct(*group)).alias("_g")


def laid(
    docs: DataFrame, group: Sequence[str], doc: str, clusters: int | None = None, copies: str | None = None, chars: DataFrame | None = None
) -> DataFrame:
    """Documents with the block of their group that they lie in, their place ``i`` there, and the clusters ``_k`` of the group.

    ``chars`` has the characters ``_chars`` of each group, for blocks of texts. Rows of one document share a place. Beside them
    stand the number ``_n`` of documents, copies counted, and of ``_blocks`` of the group.
    """
    number = F.col(copies).cast("bigint") if copies else F.lit(1).cast("bigint")
    docs = docs.where(F.concat(*[F.col(c).cast("string") for c in group]).isNotNull()).select(
        group_key(group), *group, F.col(doc).alias("_doc"), number.alias("_copies")
    )
    # A row per group.
    sizes = docs.groupBy("_g").agg(F.sum("_copies").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    sizes = sizes.withColumn("_chars", F.lit(0)) if chars is None else sizes.join(chars.select(group_key(group), "_chars"), "_g", "left").fillna(0)
    k = cluster_count_column(F.col("_n")) if clusters is None else F.least(F.col("_n"), F.lit(clusters)).cast("int")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_rows") / BLOCK), F.ceil(F.col("_chars") / CHARS)).cast("int")
    sizes = stored(sizes.select("_g", k.alias("_k"), "_n", blocks.alias("_blocks"), "_chars"))
    # A window group is a block.
    place = (F.dense_rank().over(Window.partitionBy("_g", "block").orderBy("_doc")) - 1).alias("i")
    placed = docs.join(sizes, "_g").withColumn("block", F.pmod(F.xxhash64("_doc"), F.col("_blocks")).cast("int"))
    out = stored(placed.select("*", place))
    discard(sizes)
    return out


def parts_of(sizes: DataFrame) -> DataFrame:
    """Parts ``parts`` of the terms of each group, by how many entries ``_entries`` it has, and ``units`` of parts that a task goes through.

    A round sends a fixed number of values per document and unit, so there are no more units than keep the cores busy.
    """
    every = sizes.agg(F.sum("_entries")).first()[0] or 1
    share = F.round(F.col("_entries") / every * 2 * sizes.sparkSession.sparkContext.defaultParallelism)
    fine = F.least(share, F.floor(F.col("_entries") / (PART // 10)))
    units = F.greatest(F.lit(1), F.ceil(F.col("_entries") / UNIT), fine).cast("int")
    parts = units * F.greatest(F.lit(1), F.ceil(F.col("_entries") / units / PART)).cast("int")
    return sizes.select("_g", parts.alias("parts"), units.alias("units"))


def _dealt(weights: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries over folded terms, packed by part and block, and a row for each block."""
    docs = docs.select("_g", "_doc", "block", "i", "_copies")
    places = docs.groupBy("_g", "_doc", "block", "i").agg(F.sum("_copies").alias("_copies"))
    weights = stored(weights.join(places.drop("_copies"), ["_g", "_doc"]))
    terms = stored(folded(weights, ["_g"], "_doc"))
    parts = docs.select("_g").distinct().join(terms.groupBy("_g").agg(F.sum("_n").alias("_entries")), "_g", "left").fillna(0)
    parts = stored(parts_of(parts))
    numbered = terms.join(parts, "_g").withColumn("part", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int"))
    t = F.row_number().over(Window.partitionBy("_g", "part").orderBy("term")) - 1
    numbered = numbered.select("_g", "term", "part", "units", t.alias("t"), F.sqrt(F.col("_m").cast("double")).alias("_by"))
    entries = weights.join(numbered, ["_g", "term"]).select("_g", "block", "i", "part", "units", "t", (F.col("weight") * F.col("_by")).alias("weight"))
    packed = entries.groupBy("_g", "part", "block").applyInPandas(_packed, CELLS)
    held = weights.select("_g", "_doc").distinct().withColumn("_has", F.lit(1))
    rows = places.join(held, ["_g", "_doc"], "left").select("_g", "block", "i", "_copies", F.coalesce("_has", F.lit(0)).alias("_has"))
    blocks = rows.groupBy("_g", "block").applyInPandas(_packed_block, CELLS)
    blocks = blocks.drop("units").join(parts, "_g")
    packed, blocks = stored(packed), stored(blocks.select(packed.columns))
    discard(weights, terms, parts)
    return packed, blocks


#: Cells are of two kinds: a part and block, with entries by document, of term ``t`` and value ``x``, ``n`` of a document; and a part
#: with block -1, with a factor of each term in ``x``, one where there is no such row. Blocks have part -1, the copies ``n`` of their
#: documents, the factor ``x`` of their entries, zero for those without any, and the square ``own`` of what a document shares with no other.
CELLS = "_g string, part int, block int, units int, t binary, n binary, x binary, own binary"


def packed_bytes(numbers: np.ndarray) -> bytes:
    """Numbers by the place of their bytes, which lie side by side where they are equal, compressed."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T)
    return numbers.dtype.str.encode() + len(numbers).to_bytes(8, "little") + (pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True) if len(numbers) else b"")


def unpacked_numbers(packed: bytes) -> np.ndarray:
    """What ``packed_bytes`` packed."""
    kind, n = np.dtype(packed[:3].decode()), int.from_bytes(packed[3:11], "little")
    if not n:
        return np.zeros(0, kind)
    planes = pa.Codec("zstd").decompress(packed[11:], n * kind.itemsize, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T).reshape(-1).view(kind)


def packed_cell(t: np.ndarray, i: np.ndarray, x: np.ndarray) -> dict[str, bytes]:
    """Entries in the order of document and term."""
    return {"t": packed_bytes(np.diff(t.astype(np.int32), prepend=np.int32(0))), "n": packed_bytes(np.bincount(i).astype(np.int32)), "x": packed_bytes(x)}


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["i", "t"])
    cell = packed_cell(rows["t"].to_numpy(), rows["i"].to_numpy(), rows["weight"].to_numpy(np.float64))
    head = rows[["_g", "part", "block", "units"]].iloc[:1].reset_index(drop=True)
    return head.assign(**{name: [value] for name, value in cell.items()}, own=None)


def _packed_block(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("i")
    n, x = rows["_copies"].to_numpy(np.int64), rows["_has"].to_numpy(np.float64)
    return pd.DataFrame({
        "_g": rows["_g"].iloc[:1].to_list(), "part": -1, "block": rows["block"].iloc[:1].to_list(), "units": 0, "t": None,
        "n": [packed_bytes(n)], "x": [packed_bytes(x)], "own": [packed_bytes(np.zeros(len(n)))],
    })


STATE = (
    "_g string, block int, k int, units int, size int, copies binary, scale binary, own binary, "
    "labels binary, latest binary, near binary, moved array<boolean>, cost array<double>"
)


def packed_k_means(
    cells: DataFrame,
    blocks: DataFrame,
    docs: DataFrame,
    group: Sequence[str],
    doc: str,
    clusters: int | None = None,
    starts: int = 10,
    seed: int = 42,
    rounds: int = 300,
) -> DataFrame:
    """Document and ``label`` within its group, from packed ``cells`` and ``blocks`` and the ``laid`` documents, all stored tables that go in the end.

    In a round every unit of parts gets the labels of all blocks, makes its slice of the centres of all starts, and sends each block
    its share of the inner products, which the block adds up. So a round shuffles a fixed number of values per document and unit,
    never the weights. A start at a standstill leaves the rounds. Neither vocabulary nor centres reach the driver; only which
    starts a round changed does. Distances are compared after rounding. Labels are numbered by the smallest document of their
    cluster.
    """
    spark, most = cells.sparkSession, clusters or MOST_CLUSTERS
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    dealt = _united(cells).repartition(tasks, "_g", "unit").persist(StorageLevel.MEMORY_AND_DISK)
    with shuffles_cleaned(spark):
        try:
            state = _first_state(blocks, docs, dealt, starts, most, seed)
            live = list(range(starts))
            for _ in range(rounds):
                before, state = state, stored(_round(state, dealt, "labels", live, starts, most, _nearest(live, starts, most)))
                discard(before)
                # One row: the starts that changed.
                moved = state.agg(*[F.bool_or(F.get("moved", F.lit(s))).alias(f"m{s}") for s in live]).first()
                live = [s for s in live if moved[f"m{s}"]]
                if not live:
                    break
        finally:
            dealt.unpersist()
        costs = state.select("_g", F.posexplode("cost").alias("s", "c")).groupBy("_g", "s").agg(F.round(F.sum("c"), 6).alias("_cost"))
        # A row per group.
        best = costs.groupBy("_g").agg(F.min_by("s", F.struct("_cost", "s")).alias("s"))
        chosen = state.join(best, "_g").select("_g", "block", "s", "labels").mapInPandas(
            _unpacked(starts), "_g string, block int, i int, _cluster int"
        )
        found = checkpointed(docs.join(chosen, ["_g", "block", "i"]).select("_g", *group, F.col("_doc").alias(doc), "_cluster"))
        discard(cells, blocks, docs, state)
    # At most as many rows as a group has clusters.
    firsts = found.groupBy("_g", "_cluster").agg(F.min(doc).alias("_first"))
    order = firsts.withColumn("label", F.row_number().over(Window.partitionBy("_g").orderBy("_first")) - 1)
    return found.join(order.drop("_first"), ["_g", "_cluster"]).select(*group, doc, "label")


def _united(cells: DataFrame) -> DataFrame:
    return cells.where("part >= 0").select("_g", F.expr("part % units").alias("unit"), "part", "block", "t", "n", "x")


def _first_state(blocks: DataFrame, docs: DataFrame, cells: DataFrame, starts: int, most: int, seed: int) -> DataFrame:
    """Blocks in which only the first centres have labels, by start; the others have -1."""
    kinds = docs.select("_g", F.col("_k").alias("k")).distinct()

    def begin(frames):
        for rows in frames:
            said = []
            for _, row in rows.iterrows():
                copies, scale, own = (unpacked_numbers(row[name]) for name in ("n", "x", "own"))
                none = np.full((len(copies), starts), -1, np.int8).tobytes()
                said.append((
                    row["_g"], row["block"], row["k"], row["units"], len(copies), copies.tobytes(), scale.tobytes(), own.tobytes(),
                    none, none, np.full((len(copies), starts), -1.0).tobytes(), [True] * starts, [0.0] * starts,
                ))
            yield pd.DataFrame(said, columns=[x.split()[0] for x in STATE.split(", ")])

    state = stored(blocks.join(kinds, "_g").mapInPandas(begin, STATE))
    for c in range(most):
        marks = _drawn(state, docs, starts, seed, c).groupBy("_g", "block").agg(F.collect_list(F.struct("s", "i")).alias("marks"))
        before = state
        marked = state.join(marks, ["_g", "block"], "left").mapInPandas(_marked(starts, c), STATE)
        if c + 1 < most:
            marked = stored(marked)
            state = stored(_round(marked, cells, "latest", list(range(starts)), starts, 1, _nearer(starts)))
            discard(marked)
        else:
            state = stored(marked)
        discard(before)
    return state


def _drawn(state: DataFrame, docs: DataFrame, starts: int, seed: int, c: int) -> DataFrame:
    """Places ``block`` and ``i`` of the documents that ``_turn`` makes the first centre of cluster ``c`` in start ``s``."""

    def shown(frames):
        for rows in frames:
            out = []
            for row in rows.itertuples(index=False):
                held = np.flatnonzero(np.frombuffer(row.scale, np.float64) > 0)
                near = np.frombuffer(row.near, np.float64).reshape(-1, starts)[held]
                out.append((np.full(len(held), row[0], object), np.full(len(held), row.block), held.astype(np.int32), near))
            if sum(len(held) for _, _, held, _ in out):
                g, block, i, near = (np.concatenate(x) for x in zip(*out))
                yield pd.DataFrame({"_g": g, "block": block, "i": i, "near": list(near)})

    near = state.select("_g", "block", "near", "scale").mapInPandas(shown, "_g string, block int, i int, near array<double>")
    held = docs.select("_g", "block", "i", "_doc", "_copies").join(near, ["_g", "block", "i"])
    turn = lambda s: _turn("_doc", F.get("near", F.lit(s)), F.col("_copies").cast("double"), seed, s, c)
    # A row per group.
    row = held.groupBy("_g").agg(*[F.min_by(F.struct("block", "i"), turn(s)).alias(f"s{s}") for s in range(starts)])
    each = F.array(*[F.struct(F.lit(s).alias("s"), F.col(f"s{s}.block").alias("block"), F.col(f"s{s}.i").alias("i")) for s in range(starts)])
    return row.select("_g", F.explode(each).alias("p")).select("_g", "p.s", "p.block", "p.i")


def _marked(starts: int, c: int) -> Callable:
    """Blocks with cluster ``c`` as the label of the documents that are picked for it."""

    def run(frames):
        for rows in frames:
            labels, latest = [], []
            for _, row in rows.iterrows():
                old = np.frombuffer(row["labels"], np.int8).reshape(-1, starts).copy()
                new = np.full_like(old, -1)
                for mark in row["marks"] if row["marks"] is not None else ():
                    new[mark["i"], mark["s"]] = 0
                old[(new == 0) & (old < 0)] = c
                labels.append(old.tobytes()), latest.append(new.tobytes())
            yield rows.drop(columns="marks").assign(labels=labels, latest=latest)

    return run


def _round(state: DataFrame, cells: DataFrame, labels: str, live: list[int], starts: int, most: int, then: Callable) -> DataFrame:
    """Blocks after ``then`` got the inner products of their documents with the centres, which are the means of ``labels``."""
    every = F.sequence(F.lit(0), F.col("units") - 1)
    told = state.select("_g", F.explode(every).alias("unit"), "block", "size", "copies", "scale", "own", F.col(labels).alias("labels"))
    met = cells.groupBy("_g", "unit").cogroup(told.groupBy("_g", "unit")).applyInPandas(
        _products(live, starts, most), "_g string, unit int, block int, sims binary, lengths binary, counts binary"
    )
    return met.groupBy("_g", "block").cogroup(state.groupBy("_g", "block")).applyInPandas(then, STATE)


def _products(live: list[int], starts: int, most: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Inner products of all documents with the centres, over one unit of the terms, and the squared lengths there.

    The first unit has the lengths by what documents share with no other as well.
    """

    def run(cells: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("block")
        upto = np.cumsum([0, *blocks["size"]])
        begin, n = dict(zip(blocks["block"], upto)), int(upto[-1])
        labels = np.frombuffer(b"".join(blocks["labels"]), np.int8).reshape(-1, starts)[:, live].T.astype(np.int64)
        # The last column takes documents without a label.
        labels[labels < 0] = most
        copies = np.frombuffer(b"".join(blocks["copies"]), np.int64).astype(np.float64)
        mass = copies * np.frombuffer(b"".join(blocks["scale"]), np.float64)
        counts = np.stack([np.bincount(label, weights=copies, minlength=most + 1)[:most] for label in labels])
        sims, lengths = np.zeros((len(live), most, n)), np.where(counts > 0, 0.0, np.nan)
        if blocks["unit"].iloc[0] == 0:
            own = np.frombuffer(b"".join(blocks["own"]), np.float64) * copies * copies
            lengths += np.stack([np.bincount(label, weights=own, minlength=most + 1)[:most] for label in labels]) / np.maximum(counts, 1) ** 2
        for _, part in cells.groupby("part"):
            _add_products(part.sort_values("block"), begin, labels, mass, counts, sims, lengths)
        sims = np.ascontiguousarray(np.moveaxis(sims, 2, 0))
        return pd.DataFrame({
            "_g": blocks["_g"].to_list(), "unit": blocks["unit"].to_list(), "block": blocks["block"].to_list(),
            "sims": [sims[a:b].tobytes() for a, b in zip(upto, upto[1:])],
            "lengths": [lengths.tobytes()] * len(blocks), "counts": [counts.tobytes()] * len(blocks),
        })

    return run


def _add_products(
    cells: pd.DataFrame, begin: dict, labels: np.ndarray, mass: np.ndarray, counts: np.ndarray, sims: np.ndarray, lengths: np.ndarray
) -> None:
    """Add the inner products and lengths over one part of the terms."""
    t, x, many, by, most = [], [], np.zeros(len(mass), np.int64), None, counts.shape[1]
    for cell in cells[["block", "t", "n", "x"]].itertuples(index=False):
        if cell.block < 0:
            by = unpacked_numbers(cell.x)
            continue
        some = np.cumsum(unpacked_numbers(cell.t), dtype=np.int32).astype(np.int64)
        t.append(some), x.append(unpacked_numbers(cell.x) * (1.0 if by is None else by.take(some)))
        held = unpacked_numbers(cell.n)
        many[begin[cell.block] : begin[cell.block] + len(held)] = held
    if not t:
        return
    t, x = np.concatenate(t), np.concatenate(x)
    full = np.flatnonzero(many)
    starting, many = (np.cumsum(many) - many)[full], many[full]
    heavy, at, terms = x * np.repeat(mass[full], many), t * (most + 1), int(t.max()) + 1
    for s, label in enumerate(labels):
        sums = np.bincount(at + np.repeat(label[full], many), weights=heavy, minlength=terms * (most + 1)).reshape(terms, most + 1)
        for c in np.flatnonzero(counts[s]):
            centre = sums[:, c] / counts[s, c]
            lengths[s, c] += centre @ centre
            shared = centre.take(t)
            shared *= x
            sims[s, c, full] += np.add.reduceat(shared, starting)


def _gathered(met: pd.DataFrame, row: pd.Series, labels: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of a block's documents with the centres, and the squared lengths of those; ``labels`` made the centres."""
    met, live = met.sort_values("unit"), labels.shape[1]
    sims, lengths = np.zeros((row["size"], live, most)), np.zeros((live, most))
    for some, length in zip(met["sims"], met["lengths"]):
        sims += np.frombuffer(some, np.float64).reshape(sims.shape)
        lengths += np.frombuffer(length, np.float64).reshape(lengths.shape)
    sims *= np.frombuffer(row["scale"], np.float64)[:, None, None]
    counts = np.frombuffer(met["counts"].iloc[0], np.float64).reshape(live, most)
    # What a document shares with no other is in the centre it belongs to.
    i, s = np.nonzero(labels >= 0)
    c = labels[i, s]
    own = np.frombuffer(row["own"], np.float64) * np.frombuffer(row["copies"], np.int64)
    sims[i, s, c] += own[i] / counts[s, c]
    return sims, lengths


def _nearer(starts: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """How near the nearest of the documents picked so far is to every document of a block, by start."""

    def run(met: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        row = state.iloc[0]
        latest = np.frombuffer(row["latest"], np.int8).reshape(-1, starts)
        sims, _ = _gathered(met, row, latest, 1)
        near = np.maximum(np.frombuffer(row["near"], np.float64).reshape(-1, starts), sims[:, :, 0])
        return state.iloc[:1].reset_index(drop=True).assign(near=[near.tobytes()])

    return run


def _nearest(live: list[int], starts: int, most: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The nearest centre of every document of a block by start, which starts it changed, and their cost."""

    def run(met: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        row = state.iloc[0]
        labels = np.frombuffer(row["labels"], np.int8).reshape(-1, starts).copy()
        sims, lengths = _gathered(met, row, labels[:, live], most)
        # Squared distance without the document's own length; empty clusters and those beyond the group's number stay out.
        far = np.round(lengths - 2 * sims, 9)
        far[:, :, row["k"]:] = np.nan
        far = np.where(np.isnan(far), 9.0, far)
        now = far.argmin(2).astype(np.int8)
        moved, cost = [False] * starts, list(row["cost"])
        spent = np.frombuffer(row["copies"], np.int64) @ far.min(2)
        for to, s in enumerate(live):
            moved[s], cost[s] = bool((labels[:, s] != now[:, to]).any()), float(spent[to])
        labels[:, live] = now
        out = state.iloc[:1].reset_index(drop=True)
        return out.assign(labels=[labels.tobytes()], moved=[moved], cost=[cost])

    return run


def _unpacked(starts: int) -> Callable:
    def run(frames):
        for frame in frames:
            for _, row in frame.iterrows():
                label = np.frombuffer(row["labels"], np.int8).reshape(-1, starts)[:, row["s"]].astype(np.int32)
                yield pd.DataFrame({"_g": row["_g"], "block": row["block"], "i": np.arange(len(label), dtype=np.int32), "_cluster": label})

    return run
