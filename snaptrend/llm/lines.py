"""Repeated passages across documents: content-defined chunks of words, removed after byte comparison.

Texts are read as words, whatever their script and case, so that a passage in the middle of a long line has words of its
own; a sign of Chinese or Japanese writing is a word. A rolling hash over two word hashes is least somewhere in
every window of words; those places are chunk boundaries, and they depend on nothing further away than the window.
Two windows and a few words, some 50 words, are sure to hold a whole chunk. Chunks whose hash occurs in several documents are seeds. Runs of neighbouring seeds
are compared byte by byte with the earliest document that holds them, and grown to both sides as far as the
bytes agree.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrend.llm.rows import KEY_SCHEMA, KEYS, keyed, portions, ship, stored, table
from snaptrend.session import configure

ship(__name__)

#: Signs that are words of their own: writing without white space between words.
WIDE = ((0x2E80, 0xA4CF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF))
#: Words in a window, each of which has a boundary.
WINDOW = 22
#: Words of the shortest chunk that is looked up.
CHUNK = 4
#: A passage that is removed has at least so many words.
WORDS = 30
#: Characters to either side that a run is sent with, to be grown; where they all agree, eight times as many follow.
MARGIN = 160
#: Characters that are hashed in one go; a boundary is forced where a longer text is parted.
PIECE = 1 << 18

_P = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


# --- chunks of one text ---------------------------------------------------------------------

_WIDE = "".join(f"{chr(a)}-{chr(b)}" for a, b in WIDE)
WORD = re.compile(rf"[{_WIDE}]|[^\s{_WIDE}]+")


def word_count(text: str) -> int:
    return len(text.split()) if text.isascii() else sum(1 for _ in WORD.finditer(text))


def within_word(text: str, at: int) -> bool:
    """Whether a place parts a word in two."""
    if not 0 < at < len(text) or text[at - 1].isspace() or text[at].isspace():
        return False
    return not any(a <= ord(c) <= b for c in text[at - 1 : at + 1] for a, b in WIDE)


def sliding(x: np.ndarray, width: int, fold) -> np.ndarray:
    """Least or greatest value of every window, by windows of doubled width."""
    size = 1
    while 2 * size <= width:
        x, size = fold(x[:-size], x[size:]), 2 * size
    return fold(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Chunker:
    def __init__(self):
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            n = max(n, 2 * len(self.powers))
            steps = np.full(n, _P), np.full(n, _INVERSE)
            for s in steps:
                s[0] = 1
            self.powers, self.inverse = (np.cumprod(s) for s in steps)

    def chunks(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, start, end and hash of the chunks of ``CHUNK`` words or more; many short texts go at once."""
        parts, held, size = [], [], 0
        for k, text in enumerate(texts):
            for at in range(0, len(text), PIECE):
                piece = text[at : at + PIECE]
                if held and size + len(piece) > PIECE:
                    parts.append(self._pieces(held))
                    held, size = [], 0
                held.append((k, at, piece))
                size += len(piece) + 1
        if held:
            parts.append(self._pieces(held))
        if not parts:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def _pieces(self, held: list[tuple[int, int, str]]):
        # A line feed parts two texts; words and chunks never reach into the next text.
        codes = np.frombuffer("\n".join(x[2] for x in held).encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(codes)
        self._grow(n + 1)
        size = np.array([len(x[2]) for x in held])
        offset = np.cumsum(size + 1) - size - 1
        space = (codes == 32) | ((codes >= 9) & (codes <= 13))
        parted = space.copy()
        if n and codes.max() >= WIDE[0][0]:
            for lo, hi in WIDE:
                parted |= (codes >= lo) & (codes <= hi)
        edge = np.ones(n + 1, bool)
        edge[1:-1] = parted[1:] | parted[:-1]
        start, stop = np.flatnonzero(edge[:-1] & ~space), np.flatnonzero(edge[1:] & ~space) + 1
        if len(start) < CHUNK:
            return (np.zeros(0, np.int64),) * 4
        owner = np.searchsorted(offset, start, side="right") - 1
        weighed = codes * self.powers[:n]
        weighed[space] = 0
        upto = np.empty(n + 1, np.uint64)
        upto[0] = 0
        np.cumsum(weighed, out=upto[1:])
        word = mixed((upto[stop] - upto[start]) * self.inverse[start])
        new = np.concatenate([[True], owner[1:] != owner[:-1]])
        before = np.concatenate([np.zeros(1, np.uint64), word[:-1]])
        before[new] = 0
        rolled = word * np.uint64(3) + before
        # Words that go on with a short period are told apart by their number in it, or every one would be a boundary.
        place = np.arange(len(word))
        for period in range(1, CHUNK):
            again = np.zeros(len(word), bool)
            again[period:] = (word[period:] == word[:-period]) & (owner[period:] == owner[:-period])
            if again.any():
                number = place - np.maximum.accumulate(np.where(again, -1, place))
                rolled += number.astype(np.uint64) * (_P << np.uint64(period))
        rolled = mixed(rolled)
        closing = np.concatenate([new[1:], [True]])
        if len(rolled) >= WINDOW:
            least = sliding(rolled, WINDOW, np.minimum)
            least[owner[: len(least)] != owner[WINDOW - 1 :]] = 0
            closed = np.zeros(WINDOW - 1, np.uint64)
            closing |= sliding(np.concatenate([closed, least, closed]), WINDOW, np.maximum) == rolled
        final = np.flatnonzero(closing)
        begin = np.concatenate([[0], final[:-1] + 1])
        several = final - begin >= CHUNK - 1
        a, b, who = start[begin[several]], stop[final[several]], owner[final[several]]
        found = mixed((upto[b] - upto[a]) * self.inverse[a] + (b - a).astype(np.uint64))
        base = np.array([x[1] for x in held])[who] - offset[who]
        return np.array([x[0] for x in held])[who], a + base, b + base, found.view(np.int64)


def chunk_rows(docs: DataFrame) -> DataFrame:
    """Chunks of all texts: id, start, end, hash. Empty and null texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunker = Chunker()
        for part in portions(batches, "text"):
            text, start, stop, found = chunker.chunks(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([
                part.column("_id").take(pa.array(text, pa.int64())), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32)),
                pa.array(found.astype(np.int64)),
            ], names=["_id", "start", "stop", "h"])

    texts = keyed(docs, F.col("text")).where("text is not null and text <> ''").select("_id", "text")
    return texts.mapInArrow(run, "_id bigint, start int, stop int, h bigint")


# --- repeated chunks ------------------------------------------------------------------------

def repeated_runs(docs: DataFrame) -> DataFrame:
    """Runs of neighbouring repeated chunks in all but the earliest document: id, a, b, and the
    id and place (ki, ka, kb) of the same run there.

    Hashes are counted with partial sums first; only rows of repeated ones are joined, and a hash that is in
    a third of all documents is one row on the side it is joined with.
    """
    # Stored, or both sides of the join would read and hash all texts.
    chunks = stored(chunk_rows(docs))
    often = chunks.groupBy("h").count().where("count > 1").select("h")
    seen = stored(chunks.join(often, "h"))
    keeper = seen.groupBy("h").agg(F.min(F.struct("_id", "start", "stop")).alias("k"))
    place = F.struct(
        F.col("start").alias("a"), F.col("stop").alias("b"), F.col("k._id").alias("ki"),
        F.col("k.start").alias("ka"), F.col("k.stop").alias("kb"),
    )
    copies = seen.join(keeper, "h").where("_id <> k._id").select("_id", place.alias("place"))

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, places in zip(batch["_id"], batch["places"], strict=True):
                now = None
                for p in sorted((p["a"], p["b"], p["ki"], p["ka"], p["kb"]) for p in places):
                    a, b, ki, ka, kb = p
                    # The next chunk begins right after the white space that ends the last one, here and there.
                    if now and now[2] == ki and 0 <= a - now[1] <= 2 and a - now[1] == ka - now[4]:
                        now[1], now[4] = b, kb
                        continue
                    if now:
                        out.append((i, *now))
                    now = list(p)
                if now:
                    out.append((i, *now))
            yield pd.DataFrame(out, columns=["_id", "a", "b", "ki", "ka", "kb"])

    # All chunks of one document: bounded by its length.
    by_doc = copies.groupBy("_id").agg(F.collect_set("place").alias("places"))
    return stored(by_doc.mapInPandas(runs, "_id bigint, a int, b int, ki bigint, ka int, kb int"))


# --- comparison and removal -----------------------------------------------------------------


def packed(docs: DataFrame) -> DataFrame:
    """Rows with their identity and compressed text; other columns under numbered names."""
    names = docs.columns
    rest = [F.col(f"`{n}`").alias(f"_c{i}") for i, n in enumerate(names) if n != "text"]
    rows = keyed(docs, F.col("text").alias("_text"), *rest)
    others = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name.startswith("_c")]
    kept = [*KEYS, *(c.split()[0] for c in others)]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for part in portions(batches, "_text"):
            texts = part.column("_text").to_pylist()
            blobs = pa.array([None if t is None else squeeze.compress(t.encode("utf-8", "surrogatepass")) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), blobs], names=[*kept, "_blob"])

    return rows.mapInArrow(pack, ", ".join([KEY_SCHEMA, *others, "_blob binary"]))


def unpacked(blob: bytes | None) -> str | None:
    if blob is None:
        return None
    return zstandard.ZstdDecompressor().decompress(bytes(blob)).decode("utf-8", "surrogatepass")


PLACE = ("ki", "ka", "kb", "side")
SIDES = ("body", "left", "right", "k_body", "k_left", "k_right")
SLICE = "ki bigint, ka int, kb int, side int, _id bigint, _hash bigint, a int, b int, body string, left string, right string, wanted boolean"


def frame(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [c.split() for c in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def places_of(runs: DataFrame) -> DataFrame:
    """The places that each document is to hand out: its own runs and those that others want from it, each place once."""
    own = runs.select("_id", F.struct("a", "b", *PLACE).alias("p"), F.lit(False).alias("wanted"))
    there = F.struct(F.col("ka").alias("a"), F.col("kb").alias("b"), *PLACE)
    asked = runs.select(F.col("ki").alias("_id"), there.alias("p"), F.lit(True).alias("wanted")).distinct()
    return own.unionByName(asked).groupBy("_id").agg(F.collect_set(F.struct("p", "wanted")).alias("places"))


def slices(rows: DataFrame, margin: int) -> DataFrame:
    """Bytes of every run and of its like in the earliest document, with what surrounds them; rows have text and places."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, "_blob", 1 << 18):
            out, size = [], 0
            for row in part.to_pylist():
                text = unpacked(row["_blob"]) or ""
                for x in row["places"]:
                    p = x["p"]
                    a, b = p["a"], p["b"]
                    parts = text[a:b], text[max(0, a - margin) : a] if p["side"] <= 0 else "", text[b : b + margin] if p["side"] >= 0 else ""
                    out.append((p["ki"], p["ka"], p["kb"], p["side"], row["_id"], row["_hash"], a, b, *parts, x["wanted"]))
                    size += sum(map(len, parts))
                    if size > 1 << 20:
                        yield frame(out, SLICE)
                        out, size = [], 0
            yield frame(out, SLICE)

    return stored(rows.select(*KEYS, "_blob", "places").mapInArrow(cut, SLICE))


def common_prefix(x: str, y: str) -> int:
    """Characters that two short texts begin with alike."""
    lo, hi = 0, min(len(x), len(y))
    while lo < hi:
        middle = (lo + hi + 1) // 2
        lo, hi = (middle, hi) if x[:middle] == y[:middle] else (lo, middle - 1)
    return lo


def equal_stretches(x: str, y: str) -> list[tuple[int, int]]:
    """Stretches in which two texts that lie side by side agree."""
    if x == y:
        return [(0, len(x))]
    n = min(len(x), len(y))
    u, v = (np.frombuffer(z[:n].encode("utf-32-le", "surrogatepass"), np.uint32) for z in (x, y))
    edges = np.flatnonzero(np.diff(np.concatenate([[False], u == v, [False]]).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


FOUND = f"{KEY_SCHEMA}, a int, b int, ki bigint, d int, lo boolean, ro boolean"


def verified(parts: DataFrame, margin: int) -> DataFrame:
    """Places whose bytes agree with the earliest document's (ki, at a distance of d), grown to both sides, and whether
    the whole margin agreed there."""
    wanted = parts.where("wanted").select(*PLACE, *(F.col(c).alias(f"k_{c}") for c in ("body", "left", "right")))
    pairs = parts.where("not wanted").drop("wanted").join(wanted.distinct(), list(PLACE))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, "body", 1 << 18):
            out = []
            columns = (part.column(c).to_pylist() for c in ("_id", "_hash", "a", "ki", "ka", *SIDES))
            for i, h, at, ki, ka, *sides in zip(*columns, strict=True):
                body, left, right, k_body, k_left, k_right = sides
                # Where bytes differ the run is parted, and what agrees on either side of them stays.
                for a, b in equal_stretches(body, k_body):
                    more = common_prefix(left[::-1], k_left[::-1]) if a == 0 else 0
                    on = common_prefix(right, k_right) if b == len(body) == len(k_body) else 0
                    out.append((i, h, at + a - more, at + b + on, ki, ka - at, more == margin, on == margin))
            yield frame(out, FOUND)

    return pairs.mapInArrow(compare, FOUND)


def further(places: list[tuple]) -> set[tuple[int, int, int, int]]:
    """Where growing goes on in a document: place, document and place there, side.

    An edge inside what is already found goes on at the end of that; if found at the same distance, that place goes on itself.
    """
    joined: list[list[int]] = []
    for a, b, *_ in sorted(places):
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b])
    starts = [a for a, _ in joined]
    reach: dict[tuple[int, int], list[tuple]] = {}
    for a, b, ki, d, lo, ro in places:
        reach.setdefault((ki, d), []).append((a, b, lo, ro))
    out = set()
    for (ki, d), own in reach.items():
        opened = {(x, side) for a, b, lo, ro in own for x, side, on in ((a, -1, lo), (b, 1, ro)) if on}
        for x, side in opened:
            if any(a < x < b or (x == a and side > 0) or (x == b and side < 0) for a, b, _, _ in own):
                continue
            a, b = joined[bisect_right(starts, x) - 1]
            at = b if side > 0 else a
            if at + d >= 0:
                out.add((at, ki, at + d, side))
    return out


def grown(held: DataFrame) -> DataFrame:
    """Verified places of documents that have some, each grown until a byte differs or a text ends."""
    margin = MARGIN
    found = stored(verified(slices(held, margin), margin))
    done = found

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, held in zip(batch["_id"], batch["held"], strict=True):
                places = [(p["a"], p["b"], p["ki"], p["d"], p["lo"], p["ro"]) for p in held]
                out += [(i, at, at, ki, ka, ka, side) for at, ki, ka, side in further(places)]
            yield pd.DataFrame(out, columns=["_id", "a", "b", "ki", "ka", "kb", "side"])

    while not found.where("lo or ro").isEmpty():
        margin *= 8
        seen = done.withColumn("lo", F.lit(False)).withColumn("ro", F.lit(False)).unionByName(found)
        texts = seen.join(found.where("lo or ro").select(*KEYS).distinct(), list(KEYS), "left_semi")
        reached = texts.groupBy(*KEYS).agg(F.collect_set(F.struct("a", "b", "ki", "d", "lo", "ro")).alias("held"))
        asked = reached.mapInPandas(ask, "_id bigint, a int, b int, ki bigint, ka int, kb int, side int").distinct()
        more = held.select(*KEYS, "_blob").join(places_of(stored(asked)), "_id")
        found = stored(verified(slices(more, margin), margin))
        done = done.unionByName(found)
    return done


def passages(text: str, places: list[tuple[int, int]], words: int = WORDS) -> list[tuple[int, int]]:
    """Places joined where they touch, drawn in to whole words, and long enough to be removed."""
    joined: list[list[int]] = []
    for a, b in sorted(places):
        if joined and (a <= joined[-1][1] or not text[joined[-1][1] : a].strip()):
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b])
    kept = []
    for a, b in joined:
        while a < b and within_word(text, a):
            a += 1
        while b > a and within_word(text, b):
            b -= 1
        if word_count(text[a:b]) >= words:
            kept.append((a, b))
    return kept


def cut_out(text: str, places: list[tuple[int, int]]) -> str:
    out, at = "", 0
    for a, b in [*places, (len(text), len(text))]:
        part = text[at:a]
        if out and part and not out[-1].isspace() and not part[0].isspace():
            out += " "
        out += part
        at = b
    return out if not places or out.strip() else ""


def without_repeats(docs: DataFrame, words: int = WORDS, gone: str | None = "removed_words") -> DataFrame:
    """Documents with all their columns, and one more, named by ``gone``, that counts the removed words; ``text`` lacks
    the passages that an earlier document (smaller id) holds.

    Passages of under ``words`` words stay, as does what repeats within one document only. Rows that
    share an id are one document, so nothing goes for being in another of them; rows without id share one that comes
    first. Null texts stay null, a text of which nothing is left becomes empty; no row is dropped. Columns of
    any name are passed on. All texts are shuffled once, and those with a repeated passage once more.
    """
    configure(docs.sparkSession)
    runs = repeated_runs(docs).withColumn("side", F.lit(0))
    held = stored(packed(docs).join(places_of(runs), "_id", "left"))
    some = held.where("places is not null")
    cuts = grown(some).groupBy(*KEYS).agg(F.collect_set(F.struct("a", "b")).alias("_cuts"))
    # Stored, so that the bytes that were compared are read no more.
    cut = some.drop("places").join(stored(cuts), list(KEYS), "left")
    rows = cut.unionByName(held.where("places is null").drop("places"), allowMissingColumns=True)
    names = docs.columns
    inner = [f"_c{i}" if n != "text" else "_text" for i, n in enumerate(names)]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema} | {"_text": "string"}
    last = [] if gone is None else [gone]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, "_blob", 1 << 18):
            texts, counts = [], []
            for blob, places in zip(part.column("_blob").to_pylist(), part.column("_cuts").to_pylist(), strict=True):
                text = unpacked(blob)
                found = passages(text, [(p["a"], p["b"]) for p in places], words) if places is not None else []
                counts.append(sum(word_count(text[a:b]) for a, b in found))
                texts.append(cut_out(text, found) if found else text)
            own = {"_text": pa.array(texts, pa.string())}
            columns = [own.get(c) if c in own else part.column(c) for c in inner]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(counts, pa.int64())] * len(last))], names=[*inner, *["_gone"] * len(last)])

    schema = ", ".join([*(f"{c} {kinds[c]}" for c in inner), *["_gone bigint"] * len(last)])
    return rows.mapInArrow(remove, schema).toDF(*names, *last)


QUERY = "op2_line_dedup"


def query(spark, folder) -> DataFrame:
    found = without_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "removed_words", "text")
