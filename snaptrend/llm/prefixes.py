"""Prefix trie of conversations from vertical bitmaps.

Conversations are dealt to shards by ranges of ids, and cut into segments of some turns, so that neither a hot first turn nor
an endless conversation lands in one task. In each shard every (position, turn) has a bitset of the conversations that
hold it there. A depth-first walk intersects the bitset of a node with those postings: what is left is a child, its bits are
counted, and the bits of conversations that end there are its end list. Nodes of all shards meet by a hash of their
turns. Sums over subtrees add up: each node counts in the shard of its smallest conversation only, where the walk's
numbering turns a subtree into a stretch of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaptrend.llm.rows import ship, stored, table

ship(__name__)

WORD = r"[^\x20\x09-\x0D]+"
#: A shard holds the conversations of so many ids in a row (a power of two), and a segment so many turns of each.
SHARD_BITS = 8
SEGMENT = 64
#: Bytes of the hash that stands for a turn or a prefix.
HASH = 16

TURN, START, NEXT, BARE = range(4)


def short_hash(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.encode(text, "utf-8"), 256)), 1, HASH)


# --- turns in order -------------------------------------------------------------------------


def numbered(turns: DataFrame) -> DataFrame:
    """Turns of every conversation numbered from 0: conv_id, pos, t (hash of role and text), words; stored.

    Order is by turn, null first; turns of one number are in order of their hash. Null roles and texts are empty. Rows
    without conv_id belong to no conversation and are left out. A global sort deals rows out by conversation, turn and
    hash, so that one conversation may fill many tasks; places follow from the sizes of the sorted parts.
    """
    spark = turns.sparkSession
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        short_hash(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("t"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ("conv_id", "turn", "t")
    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    dealt = stored(dealt.withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    # One number for each sorted part, whatever the size of the table.
    sizes = sorted(dealt.groupBy(part.alias("p")).count().collect())
    before, offsets = 0, []
    for r in sizes:
        offsets.append((r["p"], before))
        before += r["count"]
    known = F.broadcast(spark.createDataFrame(offsets, "p bigint, before bigint"))
    ranked = dealt.join(known, part == known["p"]).withColumn("_g", F.col("before") + F.col("_m").bitwiseAND((1 << 33) - 1))
    first = ranked.groupBy("conv_id").agg(F.min("_g").alias("_first")).withColumnRenamed("conv_id", "_c")
    placed = ranked.join(first, F.col("conv_id") == F.col("_c"))
    return stored(placed.select("conv_id", (F.col("_g") - F.col("_first")).alias("pos"), "t", "words"))


def lengths_of(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length"))


# --- one shard ------------------------------------------------------------------------------

NODE = (
    "segment bigint, shard bigint, no int, stop int, parent int, key binary, depth bigint, n bigint, first bigint, "
    "words bigint, n_ends bigint, ends binary, on binary"
)


def walk(held: pd.DataFrame, segment: int, shard: int, bits: int, turns: int) -> list[tuple]:
    """Nodes of one shard and segment in the order of the walk; those a segment starts from count no conversations."""
    base, deepest = shard << bits, (segment + 1) * turns
    at: dict[tuple[int, int], bytes] = {}
    postings: dict[tuple[int, bytes], int] = {}
    words: dict[tuple[int, bytes], int] = {}
    starts: dict[bytes, int] = {}
    following: dict[int, bytes] = {}
    length: dict[int, int] = {}
    columns = (held[c] for c in ("conv_id", "kind", "pos", "t", "words", "length"))
    for conv, kind, pos, t, w, n in zip(*columns, strict=True):
        bit, mask = conv - base, 1 << (conv - base)
        length[bit] = n
        if kind == TURN:
            t = bytes(t)
            at[bit, pos] = t
            postings[pos, t] = postings.get((pos, t), 0) | mask
            words[pos, t] = w
        elif kind == START:
            starts[bytes(t)] = starts.get(bytes(t), 0) | mask
        elif kind == NEXT:
            following[bit] = bytes(t)
    ended: dict[int, int] = {}
    for bit, n in length.items():
        ended[n] = ended.get(n, 0) | 1 << bit
    if segment == 0:
        starts = {b"": sum(1 << bit for bit in length)}

    def packed(x: int) -> bytes | None:
        return x.to_bytes((1 << bits) // 8 or 1, "little") if x else None

    out: list[tuple] = []
    stops: list[int] = []
    # An entry without bits closes the node that it names.
    stack = [(key, segment * turns, members, -1, 0) for key, members in sorted(starts.items())]
    while stack:
        key, depth, members, parent, w = stack.pop()
        if not members:
            stops[parent] = len(out)
            continue
        no, top = len(out), depth == segment * turns
        ends = 0 if top and segment else members & ended.get(depth, 0)
        on = members & ~ended.get(depth, 0) if depth == deepest else 0
        lowest = (members & -members).bit_length() - 1
        counted = not (top and segment)
        out.append((
            segment, shard, no, 0, parent, key, depth, members.bit_count() if counted else 0, base + lowest if counted else None,
            w, ends.bit_count(), packed(ends), packed(on),
        ))
        stops.append(0)
        stack.append((b"", 0, 0, no, 0))
        left = members & ~ended.get(depth, 0) if depth < deepest else 0
        while left:
            bit = (left & -left).bit_length() - 1
            t = at[bit, depth]
            child = left & postings[depth, t]
            left ^= child
            name = following[bit] if depth + 1 == deepest else sha256(key + t).digest()[:HASH]
            stack.append((name, depth + 1, child, no, words[depth, t]))
    return [(*r[:3], stop, *r[4:]) for r, stop in zip(out, stops, strict=True)]


SUMS = (
    "key binary, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, shard bigint, ends binary"
)


def summed(held: pd.DataFrame, bits: int) -> list[tuple]:
    """Parts of the sums of a shard's nodes, given what is known of each node in all shards."""
    later = {int(c): (int(s), int(n)) for c, s, n in held.loc[held["no"] < 0, ["conv_id", "saved", "leaf"]].itertuples(index=False)}
    nodes = held[held["no"] >= 0].sort_values("no")
    m = len(nodes)
    own = nodes["own"].to_numpy(bool)
    # Sums may pass 64 bits only where the result itself does.
    saved = np.where(own, nodes["saved"].to_numpy(np.int64), 0)
    leaf = np.where(own, nodes["leaf"].to_numpy(np.int64), 0)
    parent = nodes["parent"].to_numpy(np.int64)
    for i, on in enumerate(nodes["on"]):
        if on is None or not later:
            continue
        left, base = int.from_bytes(on, "little"), int(nodes["shard"].iloc[i]) << bits
        while left:
            bit = (left & -left).bit_length() - 1
            left &= left - 1
            more = later.get(base + bit, (0, 0))
            saved[i] += more[0]
            leaf[i] += more[1]
    total = [np.concatenate([[0], np.cumsum(x)]) for x in (saved, leaf)]
    no, stop = np.arange(m), nodes["stop"].to_numpy(np.int64)
    children = np.bincount(parent[own & (parent >= 0)], minlength=m)
    conv = nodes["conv_id"].to_numpy(np.int64)
    counted = nodes["n"].to_numpy(np.int64) > 0
    out = []
    for i, key, depth, n_convs, shard, ends in zip(no, nodes["key"], nodes["depth"], nodes["n_convs"], nodes["shard"], nodes["ends"], strict=True):
        above = int(conv[parent[i]]) if own[i] and parent[i] >= 0 else None
        sums = (int(total[1][stop[i]] - total[1][i]), int(total[0][stop[i]] - total[0][i])) if counted[i] else (0, 0)
        out.append((key, depth, int(conv[i]), above, n_convs, int(children[i]), *sums, shard, ends))
    return out


def frame_of(rows: list[tuple], schema: str) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = pa.schema([(n, kinds[c.split()[1]]) for n, c in zip(names, schema.split(", "), strict=True)])
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)] if rows else [[]] * len(names), schema=fields)


# --- all shards -----------------------------------------------------------------------------


def boundaries(turns: DataFrame, segment: int) -> DataFrame:
    """Hash of the prefix at the end of every whole segment: conv_id, segment, key. Only long conversations have any.

    Two sums over (position, turn) hashes settle a prefix wherever its parts lie.
    """
    whole = turns.where(F.col("length") >= segment).withColumn("segment", F.expr(f"pos div {segment}"))
    whole = whole.where((F.col("segment") + 1) * segment <= F.col("length"))
    wide = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(20,0)"))
    parts = whole.groupBy("conv_id", "segment").agg(wide("pos", "t").alias("a"), wide("t", F.lit("b"), "pos").alias("b"))
    upto = Window.partitionBy("conv_id").orderBy("segment")
    sums = (F.sum(c).over(upto).cast("string") for c in ("a", "b"))
    return parts.select("conv_id", "segment", short_hash(F.concat_ws(":", "segment", *sums)).alias("key"))


def prefix_trie(turns: DataFrame, convs: DataFrame, bits: int = SHARD_BITS, segment: int = SEGMENT) -> DataFrame:
    """One row for each distinct prefix of the conversations, the empty one (depth 0) included.

    ``turns`` has conv_id, pos (0, 1, ... in every conversation), t (a hash that stands for the turn) and words; ``convs``
    has conv_id and length, of conversations without turns too. Gives conv_id (the smallest member), depth, parent_conv_id (null
    at the top), n_convs (members), n_children, n_leaves (childless nodes in the subtree), saved_tokens (over the subtree,
    members but one times words of the last turn) and ends_sha256 (of the ids that end here, in order, joined by commas).
    Repeated conversations are members of the same nodes. Without conversations there is no row.
    """
    turns = turns.join(convs.select(F.col("conv_id").alias("_c"), "length"), F.col("conv_id") == F.col("_c")).drop("_c")
    shard = F.shiftright("conv_id", bits).alias("shard")
    part = ["conv_id", "pos", "t", "words", "length"]
    edges = stored(
        boundaries(turns, segment).join(convs.select(F.col("conv_id").alias("_c"), "length"), F.col("conv_id") == F.col("_c")).drop("_c")
    )
    none = (F.lit(0).cast("bigint").alias("pos"), F.col("key").alias("t"), F.lit(0).cast("bigint").alias("words"), "length")
    rows = turns.select(F.expr(f"pos div {segment}").alias("segment"), shard, F.lit(TURN).alias("kind"), *part)
    begun = edges.where((F.col("segment") + 1) * segment < F.col("length"))
    rows = rows.unionByName(begun.select((F.col("segment") + 1).alias("segment"), shard, F.lit(START).alias("kind"), "conv_id", *none))
    rows = rows.unionByName(edges.select("segment", shard, F.lit(NEXT).alias("kind"), "conv_id", *none))
    bare = convs.where("length = 0").withColumn("key", F.lit(None).cast("binary"))
    rows = rows.unionByName(bare.select(F.lit(0).cast("bigint").alias("segment"), shard, F.lit(BARE).alias("kind"), "conv_id", *none))

    def nodes_of(held: pa.Table) -> pa.Table:
        rows = held.to_pandas()
        return frame_of(walk(rows, int(rows["segment"].iloc[0]), int(rows["shard"].iloc[0]), bits, segment), NODE)

    nodes = stored(rows.groupBy("segment", "shard").applyInArrow(nodes_of, NODE))

    # What is known of a node in all shards; partial sums go first, so a node that every shard holds is no burden.
    totals = nodes.groupBy("key").agg(F.sum("n").alias("n_convs"), F.min("first").alias("conv_id"), F.sum("n_ends").alias("_ends"))
    totals = totals.select(F.col("key").alias("_k"), "n_convs", "conv_id", (F.col("n_convs") == F.col("_ends")).cast("bigint").alias("leaf"))
    known = stored(
        nodes.join(totals, F.col("key") == F.col("_k")).select(
            "segment", "shard", "no", "stop", "parent", "key", "depth", "n", "ends", "on", "n_convs", "conv_id", "leaf",
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
            F.coalesce(F.col("first") == F.col("conv_id"), F.lit(False)).alias("own"),
        )
    )

    # Of conversations that go on into further segments: what they count there.
    cut = edges.select("conv_id", "length").distinct().where(F.col("length") > segment)
    own = known.where("own").join(cut.select(F.col("conv_id").alias("_c")), F.col("conv_id") == F.col("_c"), "left_semi")
    own = own.groupBy("conv_id", "segment").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    all_of = cut.select("conv_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(length - 1) div {segment}"))).alias("segment"))
    after = Window.partitionBy("conv_id").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, -1)
    later = all_of.join(own, ["conv_id", "segment"], "left").select(
        "segment", shard, "conv_id",
        *(F.coalesce(F.sum(c).over(after), F.lit(0)).cast("bigint").alias(c) for c in ("saved", "leaf")),
    ).where("saved <> 0 or leaf <> 0")
    rows = known.unionByName(later.withColumn("no", F.lit(-1)), allowMissingColumns=True)

    def sums_of(held: pa.Table) -> pa.Table:
        return frame_of(summed(held.to_pandas(), bits), SUMS)

    sums = stored(rows.groupBy("segment", "shard").applyInArrow(sums_of, SUMS))
    found = sums.groupBy("key").agg(
        F.max("depth").alias("depth"), F.max("conv_id").alias("conv_id"), F.max("parent_conv_id").alias("parent_conv_id"),
        F.max("n_convs").alias("n_convs"), *(F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")),
    )
    digests = end_digests(sums.where("ends is not null").select("key", "shard", "ends"), bits)
    found = found.join(digests, F.col("key") == F.col("_k"), "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def end_digests(ends: DataFrame, bits: int) -> DataFrame:
    """Hash of the end list of every node: bitsets follow each other by shard, one at a time in memory."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, sha256()
        names = ["_k", "ends_sha256"]

        def told(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=names)

        for batch in batches:
            out = []
            for key, shard, bitset in zip(*(batch.column(c).to_pylist() for c in ("key", "shard", "ends")), strict=True):
                held = np.flatnonzero(np.unpackbits(np.frombuffer(bitset, np.uint8), bitorder="little")) + (shard << bits)
                line = ",".join(map(str, held.tolist())).encode()
                if key != now:
                    if now is not None:
                        out.append((now, state.hexdigest()))
                    now, state = key, sha256(line)
                else:
                    state.update(b"," + line)
            yield told(out)
        if now is not None:
            yield told([(now, state.hexdigest())])

    tasks = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ends.repartition(tasks, "key").sortWithinPartitions("key", "shard")
    return dealt.mapInArrow(digest, "_k binary, ends_sha256 string")


# --- the registered query -------------------------------------------------------------------


def forked(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of another one: turns and lengths.

    Conversation c takes the first h turns of c - c % every, h = crc32(c) % most, in place of its own first h.
    """
    convs = lengths_of(turns)
    base = convs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_b"), F.col("length").alias("_of"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = convs.withColumn("_base", F.col("conv_id") - F.col("conv_id") % every).withColumn("_h", h)
    convs = convs.join(base, F.col("_base") == F.col("_b"), "left").withColumn("_taken", F.least("_h", F.coalesce("_of", F.lit(0))))
    convs = stored(convs.select("conv_id", "_base", "_h", "_taken", (F.col("_taken") + F.greatest(F.col("length") - F.col("_h"), F.lit(0))).alias("length")))
    own = turns.join(convs.select(F.col("conv_id").alias("_c"), "_h", "_taken"), F.col("conv_id") == F.col("_c")).where("pos >= _h")
    own = own.select("conv_id", (F.col("pos") - F.col("_h") + F.col("_taken")).alias("pos"), "t", "words")
    lent = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < most - 1)).withColumnRenamed("conv_id", "_b")
    lent = lent.join(convs, (F.col("_base") == F.col("_b")) & (F.col("pos") < F.col("_h"))).select("conv_id", "pos", "t", "words")
    return own.unionByName(lent), convs.select("conv_id", "length")


QUERY = "op12_prefix_trie"


def query(spark, folder) -> DataFrame:
    """Trie of all conversations, each begun with turns of another one."""
    return prefix_trie(*forked(numbered(table(spark, folder, "conversations"))))


#: A prefix is the string of its turns' hashes; every node is counted at all of its own prefixes.
ORACLE = """
WITH crc AS (
  SELECT [list_reduce([n] || [1, 2, 3, 4, 5, 6, 7, 8],
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) FOR n IN range(256)] AS tab
), turns AS (
  SELECT conv_id, turn, left(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS t,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
  SELECT conv_id, t, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, t) - 1 AS pos FROM turns
), convs AS (
  SELECT conv_id, count(*) AS n, xor(list_reduce([4294967295::BIGINT] || [ascii(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')],
    lambda a, b: xor(a >> 8, tab[1 + (xor(a, b) & 255)])), 4294967295) % 4 AS h
  FROM placed, crc GROUP BY conv_id, tab
), forked AS (
  SELECT c.conv_id, c.h, least(c.h, coalesce(b.n, 0)) AS taken, greatest(c.n - c.h, 0) + least(c.h, coalesce(b.n, 0)) AS size
  FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 20
), rebuilt AS (
  SELECT f.conv_id, p.pos - h + taken AS pos, t, words FROM forked f JOIN placed p ON p.conv_id = f.conv_id AND p.pos >= h
  UNION ALL
  SELECT f.conv_id, p.pos, t, words FROM forked f JOIN placed p ON p.conv_id = f.conv_id - f.conv_id % 20 AND p.pos < h
), steps AS (
  SELECT conv_id, pos + 1 AS depth, words, string_agg(t, '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM forked
), nodes AS (
  SELECT prefix, depth, min(words) AS words, min(s.conv_id) AS conv_id, count(*) AS n_convs,
    sum((f.size = depth)::INT) AS n_ends,
    sha256(coalesce(string_agg(s.conv_id::VARCHAR, ',' ORDER BY s.conv_id) FILTER (WHERE f.size = depth), '')) AS ends_sha256
  FROM steps s JOIN forked f ON f.conv_id = s.conv_id GROUP BY prefix, depth
), above AS (
  SELECT left(prefix, 32 * unnest(range(depth + 1))) AS top, n_ends = n_convs AS leaf, (n_convs - 1) * words AS saved FROM nodes
), sums AS (
  SELECT top, sum(leaf::INT) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY top
), children AS (
  SELECT left(prefix, 32 * (depth - 1)) AS top, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.top = n.prefix LEFT JOIN children c ON c.top = n.prefix
LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = left(n.prefix, 32 * (n.depth - 1))
"""
