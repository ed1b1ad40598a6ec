"""Text expressions. All are JVM-side columns."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrend.functions.lexicon import DEFAULT_SLUG, DEFAULT_SUB_NAME, PROTECTED_TERMS


def _fold_char(char: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))


#: Hangul syllables decompose by arithmetic: a lead, a vowel and perhaps a tail.
HANGUL, VOWELS, TAILS = 0xAC00, 21, 28
HANGUL_END = HANGUL + 19 * VOWELS * TAILS - 1


@lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, str, tuple[str, ...]]:
    """Source and target of a ``translate``, then characters that become several, with what they become.

    Built from the Unicode data by rule: every character whose decomposition without combining marks is one
    other character, then every mark that disappears. ``translate`` deletes source characters that
    have no partner, so the marks come last. Hangul syllables are left to arithmetic.
    """
    singles, marks, several = [], [], []
    for code in (*range(0x80, HANGUL), *range(0xE000, sys.maxunicode + 1)):
        char = chr(code)
        if not (unicodedata.combining(char) or unicodedata.decomposition(char)):
            continue
        folded = _fold_char(char)
        if folded == "":
            marks.append(char)
        elif len(folded) > 1:
            several.append((char, folded))
        elif folded != char:
            singles.append((char, folded))
    source = "".join(c for c, _ in singles) + "".join(marks)
    return source, "".join(f for _, f in singles), "".join(c for c, _ in several), tuple(f for _, f in several)


def _class_of(chars: str, block: int = 1 << 8) -> str:
    """Regular expression for one of the characters, given in order.

    Stretches are held in blocks, of which a character that is not meant tests little more than the bounds.
    """
    stretches: list[list[int]] = []
    for code in map(ord, chars):
        if stretches and stretches[-1][1] == code - 1 and code % block:
            stretches[-1][1] = code
        else:
            stretches.append([code, code])
    held: dict[int, list[list[int]]] = {}
    for lo, hi in stretches:
        held.setdefault(lo // block, []).append([lo, hi])
    span = lambda lo, hi: rf"\x{{{lo:x}}}-\x{{{hi:x}}}"
    inside = ("".join(span(*x) for x in part) for part in held.values())
    outside = (span(part[0][0], part[-1][1]) for part in held.values())
    return "[" + "".join(f"[{o}&&[{i}]]" for o, i in zip(outside, inside, strict=True)) + "]"


def _expanded(char: Column) -> Column:
    """What one character becomes where that is several, else the character."""
    _, _, several, become = fold_tables()
    at = F.instr(F.lit(several), char)
    known = F.split(F.lit("\n".join(become)), "\n")
    code = F.ascii(char) - HANGUL
    lead, vowel, tail = F.floor(code / (VOWELS * TAILS)), F.floor(code / TAILS) % VOWELS, code % TAILS
    jamo = lambda first, number: F.substring(
        F.lit("".join(chr(first + i) for i in range(TAILS))), (number + 1).cast("int"), F.lit(1)
    )
    syllable = F.concat(jamo(0x1100, lead), jamo(0x1161, vowel), F.when(tail > 0, jamo(0x11A7, tail)).otherwise(F.lit("")))
    return (
        F.when((code >= 0) & (code <= HANGUL_END - HANGUL), syllable)
        .when(at > 0, F.element_at(known, at))
        .otherwise(char)
    )


def fold_accents(col: Column) -> Column:
    """Compatibility decomposition without its combining marks, as an expression.

    A text that holds characters which become several, told by a lookup that leaves them out, is cut at them.
    """
    source, target, several, _ = fold_tables()
    wide = several + "".join(map(chr, range(HANGUL, HANGUL_END + 1)))
    without = F.translate(col, wide, "")
    pattern = _class_of("".join(sorted(wide)))
    gaps, hits = F.split(col, pattern, -1), F.regexp_extract_all(col, F.lit(pattern), F.lit(0))
    # The last gap has no character after it.
    parts = F.zip_with(gaps, F.transform(hits, _expanded), lambda gap, become: F.concat(gap, F.coalesce(become, F.lit(""))))
    apart = F.when(F.octet_length(without) < F.octet_length(col), F.array_join(parts, "")).otherwise(col)
    return F.translate(apart, source, target)


def normalize_text(col: Column) -> Column:
    """Lower case, no accents, every run of non-word characters one space, trimmed; null is ""."""
    lower = F.lower(F.coalesce(col, F.lit("")))
    # Text whose byte and character lengths agree is plain ASCII and skips the lookup.
    folded = F.when(F.octet_length(lower) == F.char_length(lower), lower).otherwise(fold_accents(lower))
    return F.trim(F.regexp_replace(folded, r"[^\p{L}\p{N}_]+", " "))


def quoted(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def slugify(col: Column, max_len: int = 42, normalized: bool = False) -> Column:
    """Identifier of ``[a-z0-9_]``, cut to ``max_len``; a default when nothing is left."""
    base = col if normalized else normalize_text(col)
    slug = _strip_underscores(F.regexp_replace(base, "[^a-z0-9]+", "_"))
    cut = _strip_underscores(F.substring(slug, 1, max_len))
    return F.coalesce(F.nullif(cut, F.lit("")), F.lit(DEFAULT_SLUG))


def _strip_underscores(col: Column) -> Column:
    return F.btrim(col, F.lit("_"))


def iso_duration_seconds(col: Column) -> Column:
    """Seconds of an ISO-8601 duration, cut to whole seconds; unreadable text gives null.

    Weeks, days, hours, minutes and seconds count; years and months have no fixed length and
    add nothing.
    """
    number = r"(\d+(?:[.,]\d+)?)"
    date_part = "".join(rf"(?:{number}{unit})?" for unit in "YMWD")
    time_part = "".join(rf"(?:{number}{unit})?" for unit in "HMS")
    pattern = rf"^([+-])?P(?!\b){date_part}(?:T{time_part})?$"

    # One replacement cuts the text into its numbers; the parts are computed for every row, so that the
    # generated code shares it between them. The pattern is tried once more to tell unreadable text.
    parts = F.split(F.regexp_replace(col, pattern, "$1|$4|$5|$6|$7|$8"), r"\|")

    def part(position: int, seconds: int) -> Column:
        number = F.nullif(F.translate(F.get(parts, F.lit(position)), ",", "."), F.lit(""))
        return F.coalesce(number.try_cast("double"), F.lit(0.0)) * F.lit(seconds)

    units = (604800, 86400, 3600, 60, 1)
    total = reduce(lambda a, b: a + b, [part(i, s) for i, s in enumerate(units, start=1)])
    sign = F.when(F.get(parts, F.lit(0)) == "-", F.lit(-1)).otherwise(F.lit(1))
    return (total * sign * F.when(col.rlike(pattern), F.lit(1))).cast("bigint")


def words(normalized: Column) -> Column:
    """Words of an already normalised text."""
    return F.filter(F.split(normalized, " "), lambda w: w != "")


def drop_words(tokens: Column, stop_words: list[str]) -> Column:
    return F.filter(tokens, lambda w: ~w.isin(list(stop_words))) if stop_words else tokens


def term_words(text: Column, stop_words: list[str]) -> Column:
    """Words of a text that make terms: two characters or more, the first an ASCII one, no stop words."""
    kept = drop_words(words(normalize_text(text)), list(stop_words))
    return F.filter(kept, lambda w: (F.char_length(w) > 1) & (F.ascii(w) < 128))


def longer_grams(shorter: Column, tokens: Column, size: int) -> Column:
    """Word n-grams of ``size`` from those one word shorter.

    The words are what filtering left, so n-grams bridge removed words.
    """
    count = F.greatest(F.size(tokens) - (size - 1), F.lit(0))
    return F.zip_with(
        F.slice(shorter, F.lit(1), count),
        F.slice(tokens, F.lit(size), count),
        lambda left, right: F.concat(left, F.lit(" "), right),
    )


def with_grams(df: DataFrame, tokens: Column, name: str, longest: int) -> DataFrame:
    """Add arrays ``name1`` to ``name<longest>`` of word n-grams.

    Each is its own column, so that none is computed again for the next.
    """
    df = df.withColumn(f"{name}1", tokens)
    for size in range(2, longest + 1):
        grams = longer_grams(F.col(f"{name}{size - 1}"), F.col(f"{name}1"), size)
        df = df.withColumn(f"{name}{size}", grams)
    return df


def keyword_set(col: Column) -> Column:
    """Distinct normalised entries of a ``,`` or ``|`` separated text."""
    return normalized_set(F.split(F.coalesce(col, F.lit("")), "[,|]"))


def normalized_set(items: Column) -> Column:
    """Distinct normalised entries of an array, empty ones dropped."""
    return F.array_distinct(F.filter(F.transform(items, lambda x: normalize_text(x)), lambda x: x != ""))


def jaccard(left: Column, right: Column) -> Column:
    """Shared over all entries of two sets; zero when either is empty."""
    both = F.size(F.array_intersect(left, right)).cast("double")
    either = F.size(F.array_union(left, right)).cast("double")
    return F.when((F.size(left) == 0) | (F.size(right) == 0), F.lit(0.0)).otherwise(both / either)


def sub_topic_id(macro_id: Column, keywords: Column, name: Column) -> Column:
    """New sub-topic id: macro id, slug of the name, digest of the sorted keyword set."""
    joined = F.array_join(F.array_sort(normalized_set(keywords)), "|")
    signature = F.when(joined == "", normalize_text(name)).otherwise(joined)
    digest = F.substring(F.sha1(signature.cast("binary")), 1, 8)
    return F.concat_ws("__", macro_id, slugify(name, 28), digest)


def restore_terms(phrase: Column, terms: dict[str, str] | None = None) -> Column:
    """Lower-cased phrase with the protected terms in their display casing, longest first."""
    terms = PROTECTED_TERMS if terms is None else terms
    ordered = sorted(terms.items(), key=lambda kv: -len(kv[0]))
    start = F.lower(F.btrim(phrase, F.lit(" -_/")))
    return reduce(
        lambda text, kv: F.regexp_replace(text, rf"(?iU)\b\Q{kv[0]}\E\b", kv[1]), ordered, start
    )


def readable_name(phrases: Column, titles: Column, terms: dict[str, str] | None = None) -> Column:
    """First phrase of two words or more, else first title with text, else first phrase."""
    cased = F.transform(phrases, lambda p: restore_terms(p, terms))
    long_ones = F.filter(cased, lambda p: F.size(F.split(F.trim(p), r"\s+")) >= 2)
    clean = F.filter(
        F.transform(titles, lambda t: F.trim(F.regexp_replace(t, r"(?U)\s+", " "))),
        lambda t: t != "",
    )
    picked = F.coalesce(F.get(long_ones, F.lit(0)), F.get(clean, F.lit(0)), F.get(cased, F.lit(0)))
    return F.coalesce(F.substring(picked, 1, 80), F.lit(DEFAULT_SUB_NAME))


def displayed_keywords(phrases: Column, terms: dict[str, str] | None = None, limit: int = 8) -> Column:
    """Up to ``limit`` phrases in display casing, joined by a comma."""
    shown = F.transform(F.slice(phrases, 1, limit), lambda p: restore_terms(p, terms))
    return F.array_join(shown, ", ")
