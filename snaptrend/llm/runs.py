"""Periodic runs in texts: dyadic catchers find squares of words while they are appended; squares merge into runs.

Whenever a block of ``b`` words is completed (``b`` a power of two, blocks in a row), a catcher waits for it. Every word
that is appended ends one suffix of ``b`` words, and on each level exactly one catcher may meet it: the block that ends
``b`` to ``2b - 1`` words earlier. Where both agree at a distance ``q``, and words agree backwards and forwards at that
distance for ``q`` words in all, a square of period ``q`` is caught; as long as words go on to agree it is a run. A run
of three periods holds a whole block and its like one period on, so none is missed. On the lowest level the block is
short enough for the least length of a run.

Suffixes are compared by a rolling hash of word numbers. Every run that is known in the end is compared word by word; should
one differ, the stream is read again with another hash.
"""

from __future__ import annotations

import re
from binascii import crc32
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrend.llm.rows import ship, table

ship(__name__)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Shortest run, and the periods it holds at least.
LENGTH, PERIODS = 24, 3
#: Words of the shortest block; periods below twice that are caught by two catchers of it.
LEAST = 8
#: Words that are appended in one go.
PORTION = 1 << 16

_P = np.uint64(0x9E3779B97F4A7C15)


def hashed(words: np.ndarray, seed: int) -> np.ndarray:
    x = words.astype(np.uint64) + np.uint64(seed << 32 | 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Catchers:
    """Runs of a growing stream of word numbers; two words are equal if their numbers are. No run is longer than ``longest``."""

    powers = np.ones(1, np.uint64)

    def __init__(self, length: int = LENGTH, longest: int | None = None, seed: int = 0):
        if length < 3 * LEAST:
            raise ValueError(f"the lowest blocks hold {LEAST} words: runs have {3 * LEAST} at least")
        self.length, self.longest, self.seed = length, longest, seed
        self.n = 0
        self.words = np.zeros(0, np.int64)
        self.upto = np.zeros(1, np.uint64)
        #: Known runs as start, end, period; those that end with the stream may go on.
        self.runs = np.zeros((0, 3), np.int64)

    def append(self, words: np.ndarray) -> None:
        before, m = self.n, len(words)
        if not m:
            return
        self._room(before + m)
        self.words[before : before + m] = words
        now = hashed(words, self.seed) * self.powers[before : before + m]
        self.upto[before + 1 : before + m + 1] = self.upto[before] + np.cumsum(now)
        self.n = before + m
        self._go_on(before)
        block = LEAST
        while block == LEAST or PERIODS * block <= min(self.n, self.longest or self.n):
            start, period = self._caught(before, block)
            self._add(start, period, block)
            block *= 2

    def finished(self) -> np.ndarray | None:
        """All runs (start, end, smallest period), by start and period; None where unequal words had equal hashes."""
        least: dict[tuple[int, int], int] = {}
        for a, b, q in self.runs.tolist():
            w = self.words
            ends = (a == 0 or w[a - 1] != w[a - 1 + q]) and (b == self.n or w[b] != w[b - q])
            if not ends or not np.array_equal(w[a : b - q], w[a + q : b]):
                return None
            if b - a >= max(self.length, PERIODS * q):
                least[a, b] = min(q, least.get((a, b), q))
        return np.array(sorted(((a, b, q) for (a, b), q in least.items()), key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)

    def _room(self, n: int) -> None:
        size = len(self.words)
        if n > size:
            size = max(n, 2 * size)
            self.words = np.concatenate([self.words[: self.n], np.zeros(size - self.n, np.int64)])
            self.upto = np.concatenate([self.upto[: self.n + 1], np.zeros(size - self.n, np.uint64)])
        if n >= len(self.powers):
            steps = np.full(2 * n, _P)
            steps[0] = 1
            Catchers.powers = np.cumprod(steps)

    def _caught(self, before: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Blocks whose like ends with a new word: start of the block, distance. One comparison a word and catcher."""
        starts, periods = [], []
        # A run may be shorter than three of the lowest blocks' distances: two blocks may meet a word there.
        for blocks_back, near in ((0, 1), (1, 1)) if block == LEAST else ((1, 0),):
            # The first word that a block may meet; from there on every suffix has its one block.
            first = max(before + 1, (1 + blocks_back) * block + near)
            if first > self.n:
                continue
            ends = np.arange(first, self.n + 1)
            last = ((ends - near) & -block) - blocks_back * block
            blocks = np.arange(last[0], last[-1] + 1, block)
            held = np.repeat(self.upto[blocks] - self.upto[blocks - block], block)
            held = held[(first - near) % block :][: len(ends)]
            suffix = self.upto[first : self.n + 1] - self.upto[first - block : self.n + 1 - block]
            hit = np.flatnonzero(held * self.powers[ends - last] == suffix)
            starts.append(last[hit] - block)
            periods.append(ends[hit] - last[hit])
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        start, period = np.concatenate(starts), np.concatenate(periods)
        own = period < 2 * block
        return start[own], period[own]

    def _add(self, start: np.ndarray, period: np.ndarray, block: int) -> None:
        """Squares caught at blocks become runs, unless they lie in a run that is known already."""
        if not len(start):
            return
        known = self.runs[np.argsort(self.runs[:, 0], kind="stable")]
        if len(known):
            # Words with a shorter period agree at every multiple of it: the same run.
            lower = known[known[:, 2] < block]
            inside = np.zeros(len(start), bool)
            if len(lower):
                reach = np.maximum.accumulate(lower[:, 1])
                at = np.searchsorted(lower[:, 0], start, side="right") - 1
                inside = (at >= 0) & (reach[np.maximum(at, 0)] >= start + period + block)
            start, period = start[~inside], period[~inside]
        order = np.lexsort((start, period))
        start, period = start[order], period[order]
        # Neighbouring blocks caught at one distance lie in one run.
        new = np.ones(len(start), bool)
        new[1:] = (period[1:] != period[:-1]) | (start[1:] - start[:-1] > block)
        start, period = start[new], period[new]
        for at in range(0, len(start), PORTION):
            s, q = start[at : at + PORTION], period[at : at + PORTION]
            a = s - self._agreeing(s, q, back=True)
            b = s + q + self._agreeing(s, q)
            caught = b - a >= 2 * q
            self.runs = np.concatenate([self.runs, np.column_stack([a, b, q])[caught]])
        self.runs = np.unique(self.runs, axis=0)

    def _go_on(self, before: int) -> None:
        """Runs that ended with the stream go on as far as the new words agree."""
        still = self.runs[:, 1] == before
        if still.any():
            end, q = self.runs[still, 1], self.runs[still, 2]
            self.runs[still, 1] = end + self._agreeing(end - q, q)

    def _agreeing(self, at: np.ndarray, q: np.ndarray, back: bool = False) -> np.ndarray:
        """Words from each place on (or before it) that agree with those ``q`` further on."""
        limit = at if back else self.n - at - q
        found = np.zeros(len(at), np.int64)
        step = 1 << max(int(limit.max(initial=0)).bit_length() - 1, 0)
        while step:
            more = found + step
            open_ = np.flatnonzero(more <= limit)
            lo = at[open_] - more[open_] if back else at[open_]
            hi = at[open_] if back else at[open_] + more[open_]
            d = q[open_]
            same = (self.upto[hi] - self.upto[lo]) * self.powers[d] == self.upto[hi + d] - self.upto[lo + d]
            found[open_[same]] += step
            step //= 2
        return found


def runs_of(words: np.ndarray, length: int = LENGTH, longest: int | None = None) -> np.ndarray:
    """Runs of a stream that is appended in portions; another hash is taken where one has told a lie."""
    seed = 0
    while True:
        stream = Catchers(length, longest, seed)
        for at in range(0, len(words), PORTION):
            stream.append(words[at : at + PORTION])
        if (found := stream.finished()) is not None:
            return found
        seed += 1


def found_in(texts: list[list[str]], length: int = LENGTH) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of every list of words. Short texts go through one stream, parted by numbers of their own."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    numbers: defaultdict[str, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    held: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        offset = []
        total = sum(len(texts[k]) + 1 for k in held)
        words = np.empty(total, np.int64)
        at = 0
        for k in held:
            offset.append(at)
            n = len(texts[k])
            words[at : at + n] = np.fromiter(map(numbers.__getitem__, texts[k]), np.int64, n)
            words[at + n] = -2 - at
            at += n + 1
        for a, b, q in runs_of(words, length, max(len(texts[k]) for k in held)).tolist():
            k = int(np.searchsorted(offset, a, side="right")) - 1
            out[held[k]].append((a - offset[k], b - a, q))
        numbers.clear()
        held, size = [], 0

    for k, words in enumerate(texts):
        if len(words) < length:
            continue
        held.append(k)
        size += len(words)
        if size >= PORTION:
            flush()
    if held:
        flush()
    return out


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words, but of every run only its first period, joined by one space."""
    if not runs:
        return " ".join(words)
    keep = np.ones(len(words), bool)
    for a, n, q in runs:
        keep[a + q : a + n] = False
    return " ".join(words[i] for i in np.flatnonzero(keep))


Rewrite = Callable[[int, list[str]], list[str]]


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, runs (start, length and smallest period of each, by start and period) and collapsed text.

    A run is a stretch of words of some period (words that far apart are identical), three of its periods and
    ``length`` words at least, that no neighbouring word extends. Runs are counted in words of the whole
    text, after ``rewrite`` (given id and words) where one is named. Every row gives one row, repeated or without id
    (which is not rewritten); null and empty texts have no words and no runs. Other columns are ignored.
    Memory follows the longest text.
    """
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                words = [WORD.findall(t) if t else [] for t in batch.column("text").to_pylist()]
                if rewrite:
                    ids = batch.column("doc_id").to_pylist()
                    words = [w if i is None else rewrite(i, w) for i, w in zip(ids, words, strict=True)]
                runs = found_in(words, length)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x in runs], pa.list_(run)),
                    pa.array([collapsed(w, x) for w, x in zip(words, runs, strict=True)], pa.large_string()).cast(pa.string()),
                ], names=["doc_id", "n_words", "runs", "collapsed"])

    schema = f"doc_id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return rows.mapInArrow(found, schema)


# --- the registered query -------------------------------------------------------------------


def planted(doc_id: int, words: list[str]) -> list[str]:
    """Every tenth document, by a hash of its id, repeats some of its words to the end."""
    h, n = crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


QUERY = "op13_periodic_runs"


def query(spark, folder) -> DataFrame:
    """Digests of all runs and of the collapsed text of every document, and its run of most periods."""
    found = periodic_runs(table(spark, folder, "documents"), planted)
    # Runs come by start and period, so that the first of equals stays.
    best = F.aggregate(
        F.col("runs"),
        F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b),
    )
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    sha = lambda c: F.sha2(F.encode(c, "utf-8"), 256)
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        sha(F.array_join(F.transform("runs", line), "")).alias("runs_sha256"),
        sha(F.col("collapsed")).alias("collapsed_sha256"),
    )


#: Runs in SQL: pairs of equal words at every distance, put together where they follow each other.
ORACLE = """
WITH crc AS (
  SELECT [list_reduce([n] || [1, 2, 3, 4, 5, 6, 7, 8],
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) FOR n IN range(256)] AS t
), texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    xor(list_reduce([4294967295::BIGINT] || [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')],
      lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) AS h
  FROM documents, crc
), sized AS (
  SELECT *, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS parts FROM texts
), planted AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN [w[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // parts) ELSE i END] FOR i IN range(n)] ELSE w END AS w
  FROM sized
), words AS (
  SELECT r, n, unnest(w) AS word, unnest(range(n)) AS i FROM planted
), pairs AS (
  SELECT x.r, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
), placed AS (
  SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM pairs
), stretches AS (
  SELECT r, min(i) AS start, count(*) + q AS length, q AS period FROM placed GROUP BY r, q, g HAVING count(*) + q >= greatest(24, 3 * q)
), runs AS (
  SELECT r, start, length, min(period) AS period FROM stretches GROUP BY r, start, length
), told AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS line
  FROM runs GROUP BY r
), best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY length::DOUBLE / period DESC, start, period) = 1
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS line FROM words w
  WHERE NOT EXISTS (SELECT 1 FROM runs u WHERE u.r = w.r AND w.i >= u.start + u.period AND w.i < u.start + u.length) GROUP BY r
)
SELECT p.doc_id, coalesce(t.n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
  sha256(coalesce(t.line, '')) AS runs_sha256, sha256(coalesce(k.line, '')) AS collapsed_sha256
FROM planted p LEFT JOIN told t USING (r) LEFT JOIN best b USING (r) LEFT JOIN kept k USING (r)
"""
