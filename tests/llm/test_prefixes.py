"""The prefix trie of conversations against plain dictionaries."""

import hashlib
import random
from binascii import crc32
from collections import defaultdict

import pytest

from snaptrend.llm import prefixes


def plain_trie(convs):
    """Nodes of conversations (id to list of (role, text))."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, held in members.items():
        below = [k for k in members if k[: len(node)] == node]
        children = [k for k in below if len(k) == len(node) + 1]
        leaves = [k for k in below if not any(o[: len(k)] == k and len(o) > len(k) for o in below)]
        saved = sum((len(members[k]) - 1) * len(prefixes_words(k[-1][1])) for k in below if k)
        ends = ",".join(map(str, sorted(c for c in held if len(convs[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(held), len(node), parent, len(held), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def prefixes_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text)


def plain_fork(convs):
    out = {}
    for c, own in convs.items():
        h = crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def some(seed, n, turns):
    rng = random.Random(seed)
    texts = ["", "a", "a b", "one two three", "é ö"]
    out = {}
    for c in rng.sample(range(n * 3), n):
        kind = rng.randrange(4)
        if kind == 0 and out:
            out[c] = list(rng.choice(list(out.values())))
        elif kind == 1 and out:
            other = list(rng.choice(list(out.values())))
            out[c] = other[: rng.randrange(len(other) + 1)] + [("user", rng.choice(texts))] * rng.randrange(3)
        else:
            out[c] = [(rng.choice(["user", "assistant"]), rng.choice(texts)) for _ in range(rng.randrange(turns))]
    return {c: t for c, t in out.items() if t}


def rows_of(spark, convs):
    rows = [(c, i, role, text) for c, turns in convs.items() for i, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)


@pytest.mark.parametrize(("bits", "segment", "seed"), [(8, 64, 1), (2, 2, 2), (1, 3, 3), (0, 1, 4)])
def test_trie_of_any_shards_and_segments(spark, bits, segment, seed):
    convs = some(seed, 40, 9)
    turns = prefixes.numbered(rows_of(spark, convs))
    got = prefixes.prefix_trie(turns, prefixes.lengths_of(turns), bits, segment).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_trie(convs)


def test_forked_conversations(spark):
    convs = some(7, 60, 5)
    got = prefixes.prefix_trie(*prefixes.forked(prefixes.numbered(rows_of(spark, convs))), 3, 2).collect()
    want = plain_fork(convs)
    assert any(not t for t in want.values())
    assert sorted((tuple(r) for r in got), key=str) == plain_trie(want)


def test_long_conversations_and_copies(spark):
    """Two copies of many segments, one that leaves them late, negative ids and ids beyond the range of doubles."""
    long = [("user", f"turn {i % 5} {'x ' * (i % 3)}") for i in range(300)]
    convs = {2**53 + 1: long, 2**53 + 3: long, -7: long[:290], 5: [*long[:200], ("user", "other"), *long[:40]]}
    turns = prefixes.numbered(rows_of(spark, convs))
    got = prefixes.prefix_trie(turns, prefixes.lengths_of(turns), 8, 32).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_trie(convs)


def test_odd_rows(spark):
    """Null turns come first, null roles and texts are empty, rows without an id take no part, ties have an order of their own."""
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (2, 5, "user", "first"), (2, 9, "", ""), (None, 0, "user", "lost"),
        (3, 1, "user", "x"), (3, 1, "user", "y"), (3, 1, "user", "x"), (4, 1, "user", "y"), (4, 1, "user", "x"), (4, 1, "user", "x"),
        (6, 1, "user", "word " * 50_000),
    ]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    turns = prefixes.numbered(frame.selectExpr("*", "1 as length", "2 as pos", "'z' as t", "3 as kind", "4 as shard"))
    got = {(r.conv_id, r.depth): r for r in prefixes.prefix_trie(turns, prefixes.lengths_of(turns)).collect()}
    assert got[1, 0].n_convs == 5 and got[1, 0].parent_conv_id is None and got[1, 0].n_leaves == 3
    assert got[1, 2].n_convs == 2 and got[3, 3].n_convs == 2
    assert got[1, 2].ends_sha256 == hashlib.sha256(b"1,2").hexdigest()
    assert got[6, 1].n_children == 0
    nothing = prefixes.numbered(frame.limit(0))
    assert prefixes.prefix_trie(nothing, prefixes.lengths_of(nothing)).count() == 0
