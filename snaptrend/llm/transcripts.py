"""Roles of transcript lines by a hidden Markov model, then canonical turns.

A state is a role and whether the line begins a turn. Lines are seen through their speaker marker and a few features.
A transcript may come in numbered parts, each of which begins a turn; the best path runs through all of them, as each part
first becomes a small table of best scores from state to state, and only these tables are put in a row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrend.llm.rows import ship, stored, table, through_pandas

ship(__name__)

ROLES = ("system", "user", "assistant")
#: State 2 r begins a turn of role r, state 2 r + 1 goes on with it.
STATES = 2 * len(ROLES)

#: Speaker markers at the start of a line, by the role they usually stand for.
MARKERS = (
    ("system", re.compile(r"^\s*(?:\[?(?:system|sys|context|instructions?)\]?)\s*[:>]\s*", re.I)),
    ("user", re.compile(r"^\s*(?:\[?(?:user|human|customer|me|question|q)\]?)\s*[:>]\s*", re.I)),
    ("assistant", re.compile(r"^\s*(?:\[?(?:assistant|ai|bot|agent|answer|a)\]?)\s*[:>]\s*", re.I)),
    ("any", re.compile(r"^\s*(?:[-–—]|>>|#\d+|speaker \d+\s*:)\s+", re.I)),
)
LENGTHS = (0, 20, 80, 300)

#: Turns of one part.
PART_TURNS = 64


def marker_of(line: str) -> tuple[str, str]:
    """Kind of the speaker marker of a line, and the line without it."""
    for name, pattern in MARKERS:
        m = pattern.match(line)
        if m:
            return name, line[m.end() :]
    return "none", line


def features(line: str) -> tuple[str, ...]:
    """What the model sees of a line: marker, length, final mark, whether it opens with a capital."""
    marker, rest = marker_of(line)
    rest = rest.strip()
    return (
        f"marker={marker}",
        f"length={sum(len(rest) > n for n in LENGTHS)}",
        f"ends={rest[-1] if rest and rest[-1] in '?!.:' else 'other'}",
        f"capital={rest[:1].isupper()}",
    )


@dataclass
class RoleModel:
    """Log chances of states at the start, from state to state, and of features in states."""

    start: np.ndarray
    step: np.ndarray
    seen: dict[str, np.ndarray]
    unseen: dict[str, np.ndarray]

    def scores(self, lines: list[str]) -> np.ndarray:
        none = np.zeros(STATES)
        return np.array([
            sum((self.seen.get(f, self.unseen.get(f.split("=")[0], none)) for f in features(x)), none) for x in lines
        ]).reshape(len(lines), STATES)

    def table(self, lines: list[str]) -> np.ndarray:
        """Best score of a path over the lines from each state of the first to each of the last; the first begins a turn."""
        seen = self.scores(lines)
        best = np.full((STATES, STATES), -np.inf)
        for r in range(0, STATES, 2):
            best[r, r] = seen[0, r]
        for row in seen[1:]:
            best = (best[:, :, None] + self.step[None]).max(axis=1) + row
        return best

    def path(self, lines: list[str], first: int, last: int) -> list[int]:
        """Best states of the lines with those of the first and last line given."""
        seen = self.scores(lines)
        now = np.full(STATES, -np.inf)
        now[first] = seen[0, first]
        back = []
        for row in seen[1:]:
            ways = now[:, None] + self.step
            back.append(ways.argmax(axis=0))
            now = ways.max(axis=0) + row
        out = [last]
        for b in reversed(back):
            out.append(int(b[out[-1]]))
        return out[::-1]

    def ends(self, tables: list[np.ndarray]) -> list[tuple[int, int]]:
        """States of the first and last line of every part on the best path through all parts."""
        now, back = None, []
        for t in tables:
            enter = self.start if now is None else (now[:, None] + self.step).max(axis=0)
            via = np.zeros(STATES, int) if now is None else (now[:, None] + self.step).argmax(axis=0)
            ways = enter[:, None] + t
            back.append((via, ways.argmax(axis=0)))
            now = ways.max(axis=0)
        last = int(now.argmax())
        out = []
        for via, first in reversed(back):
            out.append((int(first[last]), last))
            last = int(via[first[last]])
        return out[::-1]


# --- fitting --------------------------------------------------------------------------------


def fit(parts: DataFrame, smooth: float = 0.5) -> RoleModel:
    """Counts of states, steps and features over parts whose lines carry their state: columns lines and states.

    Counting is a sum per task; a few hundred numbers reach the driver, whatever the size of the table.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n: dict[tuple[str, int], int] = {}
            for lines, states in zip(batch["lines"], batch["states"], strict=True):
                before = None
                for line, s in zip(lines, states, strict=True):
                    for name in ("start" if before is None else f"step={before}", *features(line)):
                        n[name, s] = n.get((name, s), 0) + 1
                    before = s
            yield pd.DataFrame([(k, s, c) for (k, s), c in n.items()], columns=["name", "state", "n"])

    rows = parts.select("lines", "states").mapInPandas(count, "name string, state int, n bigint")
    found = rows.groupBy("name", "state").agg(F.sum("n").alias("n")).collect()
    counts: dict[str, np.ndarray] = {}
    for r in found:
        counts.setdefault(r["name"], np.zeros(STATES))[r["state"]] = r["n"]
    begins = np.array([s % 2 == 0 for s in range(STATES)])
    start = np.where(begins, counts.get("start", np.zeros(STATES)) + smooth, 0)
    step = np.zeros((STATES, STATES))
    for s in range(STATES):
        own = counts.get(f"step={s}", np.zeros(STATES))
        # A line begins a turn or goes on with the role of the line before it.
        allowed = begins | (np.arange(STATES) == s - s % 2 + 1)
        step[s] = np.where(allowed, own + smooth, 0)
    seen, unseen = {}, {}
    for kind in ("marker", "length", "ends", "capital"):
        names = [k for k in counts if k.startswith(kind + "=")]
        total = sum((counts[k] for k in names), np.zeros(STATES)) + smooth * (len(names) + 1)
        for k in names:
            seen[k] = np.log((counts[k] + smooth) / total)
        unseen[kind] = np.log(smooth / total)
    with np.errstate(divide="ignore"):
        return RoleModel(np.log(start / start.sum()), np.log(step / step.sum(axis=1, keepdims=True)), seen, unseen)


# --- parsing --------------------------------------------------------------------------------


def render(role: str, text: str) -> str:
    return f"<|{role}|>\n{text}\n<|end|>"


def parse(parts: DataFrame, model: RoleModel) -> DataFrame:
    """Turns of transcripts: conv_id, part, turn (within the part, from 0), role, text without marker, rendered.

    ``parts`` has conv_id, part (unique within a conversation, in order) and lines. Parts without lines give no turns.
    A null conv_id is a conversation of its own. A conversation of any length is spread by part.
    """
    rows = parts.where(F.size("lines") > 0).select("conv_id", "part", "lines")

    def tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            best = [model.table(list(x)).ravel() for x in batch["lines"]]
            yield batch[["conv_id", "part"]].assign(best=best)

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv, held in zip(batch["conv_id"], batch["held"], strict=True):
                held = sorted(held, key=lambda x: x["part"])
                ends = model.ends([np.array(x["best"]).reshape(STATES, STATES) for x in held])
                out += [(conv, x["part"], a, b) for x, (a, b) in zip(held, ends, strict=True)]
            yield pd.DataFrame(out, columns=["conv_id", "part", "first", "last"])

    best = through_pandas(rows, tables, "part bigint, best array<double>", "conv_id")
    # A few numbers for each part of a conversation, not its lines.
    held = best.groupBy("conv_id").agg(F.collect_list(F.struct("part", "best")).alias("held"))
    ends = through_pandas(held, chain, "part bigint, first int, last int", "conv_id")
    named = ends.select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), "first", "last")
    joined = rows.join(named, rows["conv_id"].eqNullSafe(named["_c"]) & (rows["part"] == named["_p"]))

    def turns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv, part, lines, first, last in zip(*(batch[c] for c in ("conv_id", "part", "lines", "first", "last")), strict=True):
                lines = list(lines)
                held: list[tuple[str, list[str]]] = []
                for line, s in zip(lines, model.path(lines, first, last), strict=True):
                    rest = marker_of(line)[1] if s % 2 == 0 else line
                    if s % 2 == 0:
                        held.append((ROLES[s // 2], [rest]))
                    else:
                        held[-1][1].append(rest)
                for k, (role, texts) in enumerate(held):
                    text = "\n".join(texts).strip()
                    out.append((conv, part, k, role, text, render(role, text)))
            yield pd.DataFrame(out, columns=["conv_id", "part", "turn", "role", "text", "rendered"])

    return through_pandas(
        joined.select("conv_id", "part", "lines", "first", "last"), turns,
        "part bigint, turn int, role string, text string, rendered string", "conv_id",
    )


# --- transcripts of the conversations table -------------------------------------------------

#: Marks by which a turn is written into a transcript; the last two say nothing about the role.
WRITTEN = {
    "system": ("System: ", "[context]: ", "Instructions: "),
    "user": ("User: ", "Human: ", "Q: "),
    "assistant": ("Assistant: ", "AI: ", "A: "),
}
VAGUE = ("- ", "")


def transcripts(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Conversations written down as numbered parts of lines: conv_id, part, lines, states (the true ones).

    Each turn gets a speaker mark chosen by a hash: an alias of its role, a bare dash, or none. Parts hold at most about
    ``part_turns`` rows even if a turn number repeats. Null texts and roles: an empty line, a user. Rows without a
    turn number come first; equal rows are told apart by nothing and follow each other.
    """
    role = F.when(F.col("role").isin(*ROLES), F.col("role")).otherwise("user")
    text = F.coalesce("text", F.lit(""))
    rows = turns.select(
        "conv_id", F.coalesce(F.col("turn").cast("bigint"), F.lit(-1)).alias("turn"), role.alias("role"), text.alias("text"),
        F.xxhash64("conv_id", "turn", "text").alias("_x"),
    )
    rows = rows.withColumn("_page", F.expr(f"turn div {part_turns}"))
    size = rows.groupBy("conv_id", "_page").agg(F.ceil(F.count(F.lit(1)) / (2 * part_turns)).alias("_of"))
    size = size.select(F.col("conv_id").alias("_c"), F.col("_page").alias("_g"), "_of")
    rows = rows.join(size, rows["conv_id"].eqNullSafe(size["_c"]) & (rows["_page"] == size["_g"]))
    # Turns of a crowded page are dealt by turn and hash in order, so that the parts stay in order.
    cell = F.when(F.col("_of") > 1, F.pmod(F.xxhash64("turn", "_x"), "_of")).otherwise(F.lit(0))
    part = F.when(F.col("_of") > 1, F.col("turn") * 1_000_000 + cell).otherwise(F.col("_page") * part_turns * 1_000_000)
    marks = F.lit("")
    for name, aliases in WRITTEN.items():
        choice = F.element_at(F.array(*map(F.lit, (*aliases, *aliases, *VAGUE))), (F.pmod("_x", F.lit(8)) + 1).cast("int"))
        marks = F.when(F.col("role") == name, choice).otherwise(marks)
    state = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")).cast("int") * 2 - 2
    lines = F.split(F.concat(marks, "text"), "\n")
    held = rows.groupBy("conv_id", part.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("turn", "_x", lines.alias("lines"), state.alias("s")))).alias("held")
    )
    states = F.flatten(F.transform("held", lambda x: F.concat(
        F.array(x["s"]), F.array_repeat(x["s"] + 1, F.greatest(F.size(x["lines"]) - 1, F.lit(0)))
    )))
    return held.select("conv_id", "part", F.flatten(F.col("held.lines")).alias("lines"), states.alias("states"))


QUERY = "op6_transcripts"


def query(spark, folder) -> DataFrame:
    """Turns recovered from the transcripts of all conversations, numbered through."""
    parts = stored(transcripts(table(spark, folder, "conversations")))
    found = parse(parts, fit(parts))
    return found.select("conv_id", "part", "turn", "role", "text", "rendered")
