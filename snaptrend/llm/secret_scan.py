"""Secrets in texts: fixed patterns, and sliding-window entropy of candidate strings. SQL functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrend.llm.rows import table, text_of

#: Patterns of the base kinds in the order in which they are listed.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

#: Candidate strings: whole runs of one token alphabet with a letter and a digit in them.
RUN = "A-Za-z0-9+/_=-"
CANDIDATE = rf"(?<![{RUN}])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[{RUN}]{{20,}}+"
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
#: Narrowest class that holds all of a candidate, with the bits per character that its window must reach.
CLASSES = (("^[0-9a-f]+$|^[0-9A-F]+$", 3.0), ("^[0-9a-z]+$|^[0-9A-Z]+$", 3.5), (".", 3.8))
#: Candidates that are no secrets: UUIDs, dates, placeholders, runs of the alphabet.
ALLOWED = (
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "^[0-9]{4}-[0-9]{2}-[0-9]{2}[T_-]",
    "(?i)example|placeholder|changeme|dummy|sample|xxxx|your_|your-",
    "123456789|(?i:abcdefgh|qwertyui)",
)

_SPANS = "array<struct<start:int,stop:int,value:string>>"
#: Matches whose places are summed in one go.
STRETCH = 256


def matches(text: Column, pattern: str, keep=lambda part: F.lit(True), group: int = 0) -> Column:
    """Places (start, stop, text of ``group``) of the leftmost non-overlapping matches, in code points.

    What lies between matches is what ``split`` leaves, so running lengths give the places. ``keep`` says
    from the text of ``group`` which matches stay.
    """
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"),
    )
    placed = F.transform(F.array(zipped), _placed)[0]
    found = F.filter(placed, lambda x: F.coalesce(x["stop"].isNotNull() & keep(x["value"]), F.lit(False)))
    return F.when(text.rlike(pattern), found.cast(_SPANS)).otherwise(F.array().cast(_SPANS))


def _placed(pieces: Column) -> Column:
    """Places of the matches from the lengths of gaps and matches; the last gap has no match after it, so no stop.

    Running sums append to arrays, which copies them, so they are taken in stretches of ``STRETCH`` and over
    the sums of stretches: a text of ``n`` matches copies ``n * STRETCH`` numbers, not ``n * n``.
    """
    width = F.transform(pieces, lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0)))
    cut = F.transform(
        F.array(width),
        lambda w: F.transform(F.sequence(F.lit(0), F.floor((F.size(w) - 1) / STRETCH).cast("int")), lambda b: F.slice(w, b * STRETCH + 1, STRETCH)),
    )[0]
    starts = F.transform(
        F.array(cut),
        lambda c: F.flatten(F.zip_with(
            c, _before(F.transform(c, lambda s: F.aggregate(s, F.lit(0), lambda a, x: a + x))),
            lambda stretch, base: F.transform(_before(stretch), lambda x: x + base),
        )),
    )[0]
    return F.zip_with(
        pieces, starts,
        lambda x, at: F.struct(
            (at + F.length(x["gap"])).alias("start"), (at + F.length(x["gap"]) + F.length(x["hit"])).alias("stop"), x["part"].alias("value")
        ),
    )


def _before(numbers: Column) -> Column:
    """Sum of what comes before each number."""
    first = F.array(F.lit(0))
    sums = F.aggregate(numbers, first, lambda done, x: F.array_append(done, F.element_at(done, -1) + x))
    return F.slice(sums, 1, F.size(sums) - 1)


def entropy_span(value: Column, window: int) -> Column:
    """First and last character of the windows whose entropy reaches the bar of the candidate's class.

    One pass: counts of the window's symbols and the sum of ``c log2 c`` are updated by the character that
    enters and the one that leaves. Null bounds where no window reaches the bar; ``top`` is the largest entropy.
    """
    bar = F.lit(CLASSES[-1][1])
    for pattern, least in reversed(CLASSES[:-1]):
        bar = F.when(value.rlike(pattern), F.lit(least)).otherwise(bar)
    symbols = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    begin = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("top"),
        F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"),
    )
    packed = F.struct(symbols.alias("s"), bar.alias("bar"), weight.alias("w"))

    def slide(p):
        def at(i):
            return F.element_at(p["s"], i)

        def step(done, i):
            enters = at(i)
            leaves = F.when(i > window, at(F.greatest(i - window, F.lit(1)))).otherwise(F.lit(0))
            counts = F.transform(
                done["counts"],
                lambda c, k: c + (k + 1 == enters).cast("int") - (k + 1 == leaves).cast("int"),
            )
            was_in = F.element_at(done["counts"], enters)
            was_out = F.when(leaves > 0, F.element_at(done["counts"], F.greatest(leaves, F.lit(1)))).otherwise(F.lit(0))
            grown = F.element_at(p["w"], was_in + 2) - F.element_at(p["w"], was_in + 1)
            shrunk = F.when(
                leaves > 0, F.element_at(p["w"], F.greatest(was_out, F.lit(1))) - F.element_at(p["w"], was_out + 1)
            ).otherwise(F.lit(0.0))
            total = done["total"] + F.when(enters == leaves, F.lit(0.0)).otherwise(grown + shrunk)
            return F.struct(
                counts.alias("counts"), total.alias("total"), done["top"].alias("top"),
                done["first"].alias("first"), done["last"].alias("last"), i.alias("i"),
            )

        def seen(done):
            bits = F.lit(math.log2(window)) - done["total"] / window
            high = (done["i"] >= window) & (bits >= p["bar"])
            return F.struct(
                done["counts"].alias("counts"), done["total"].alias("total"),
                F.when(done["i"] >= window, F.greatest(done["top"], bits)).otherwise(done["top"]).alias("top"),
                F.coalesce(done["first"], F.when(high, done["i"] - window)).alias("first"),
                F.when(high, done["i"]).otherwise(done["last"]).alias("last"),
            )

        def both(done, i):
            return F.element_at(F.transform(F.array(step(done, i)), seen), 1)

        return F.aggregate(F.sequence(F.lit(1), F.size(p["s"])), begin, both)

    return F.element_at(F.transform(F.array(packed), slide), 1)


def entropy_spans(text: Column, window: int, allowed: tuple[str, ...]) -> Column:
    """Spans of high entropy in candidate strings that no allow-list pattern suppresses."""
    found = F.transform(
        matches(text, CANDIDATE, lambda v: ~_any(v, allowed)),
        lambda x: F.struct(x["start"].alias("start"), entropy_span(x["value"], window).alias("e")),
    )
    return F.transform(
        F.filter(found, lambda x: x["e"]["first"].isNotNull()),
        lambda x: F.struct(
            (x["start"] + x["e"]["first"]).alias("start"), (x["start"] + x["e"]["last"]).alias("stop"),
            x["e"]["top"].alias("bits"),
        ),
    )


def _any(value: Column, patterns: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | value.rlike(pattern)
    return hit


def scan(docs: DataFrame, window: int = 20, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """Spans of every text as arrays of (start, stop, ...), one column per kind, with doc_id.

    ``assign`` needs a value of 12 characters, ``access`` 18 in all, ``hex`` 16; ``entropy`` are the method's
    own. The allow-list suppresses only those. Places are code points, the end exclusive. A null or empty
    text has no spans; every row, repeated or without id, gives its own row. Other columns are ignored.
    """
    text = F.col("_text")
    return docs.select(F.col("doc_id"), text_of().alias("_text")).select(
        "doc_id",
        matches(text, ASSIGN, lambda v: F.length(v) >= 12, 2).alias("assign"),
        matches(text, ACCESS, lambda v: F.length(v) >= 18).alias("access"),
        matches(text, HEX).alias("hex"),
        entropy_spans(text, window, allowed).alias("entropy"),
    )


def _listed(kinds: tuple[str, ...]) -> Column:
    """Spans of the kinds as kind:start:end by start, then kind as listed."""
    def part(n: int) -> Column:
        return F.transform(kinds[n], lambda x: F.struct(x["start"].alias("a"), F.lit(n).alias("k"), x["stop"].alias("b")))

    parts = [part(n) for n in range(len(kinds))]
    names = F.array(*map(F.lit, kinds))
    one = lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["a"].cast("string"), x["b"].cast("string"))
    return F.concat_ws(",", F.transform(F.array_sort(F.concat(*parts)), one))


QUERY = "op3_secret_scan"


def query(spark, folder) -> DataFrame:
    found = scan(table(spark, folder, "documents"))
    count = lambda kind: F.size(kind).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(_listed(KINDS[:3]), 256).alias("base_sha256"), _listed(KINDS).alias("spans"), count("entropy"),
    )
