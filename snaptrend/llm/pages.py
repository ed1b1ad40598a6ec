"""Main text of web pages: flat text blocks, classified by a decision tree over themselves and their neighbours."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrend.llm.rows import ship, table, through_pandas

ship(__name__)

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*(?:>|\Z)"
    # A quote opens a value after an equals sign only, and only if it is closed somewhere.
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?""")

#: Elements whose content is no text of the page.
SILENT = frozenset("script style title template noscript iframe svg canvas select option textarea button object".split())
#: Those among them whose content is no markup: without an end tag they reach to the end of the page.
RAW = frozenset("script style title textarea".split())
#: Those that hold themselves, and those that hold no paragraphs.
NESTED, PHRASE = frozenset("template svg object".split()), frozenset("select option button".split())
#: Blocks with which an article goes on after an element that was never closed.
TEXTUAL = frozenset("article main section p h1 h2 h3 h4 h5 h6 blockquote ul ol dl table".split())
#: Elements that end a block; others stand inside one. A line break is white space inside its block.
BLOCK = frozenset(
    "html head body p div section article main nav header footer aside form fieldset ul ol li dl dt dd table thead tbody "
    "tfoot tr td th caption blockquote pre h1 h2 h3 h4 h5 h6 hr figure figcaption details summary address dialog menu "
    "label input search hgroup center".split()
)
#: Elements that are kept on the stack as surroundings of a block.
HOLDER = frozenset(
    "div section article main nav header footer aside form ul ol dl table details dialog menu blockquote figure search span p"
    .split()
)
EMPTY = frozenset("br hr img input meta link area base col embed source track wbr".split())
#: Surroundings that are not the article, by element, role, or a word of class and id.
CHROME_TAGS = frozenset("nav header footer aside form dialog menu search".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
CHROME_WORDS = frozenset(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice popup modal overlay sidebar side menu nav navbar navigation breadcrumb breadcrumbs header masthead footer "
    "copyright share sharing social related recommended newsletter subscribe subscription signup login widget toolbar "
    "pagination pager tags alert".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist reply replies discussion respond disqus".split())
ARTICLE_WORDS = frozenset("article articlebody content post entry story main".split())
#: With one of these in its name, a header is that of an article and holds its heading.
HEADED_WORDS = frozenset("article post entry story".split())

FEATURES = (
    "words", "density", "previous_words", "previous_density", "next_words", "next_density", "in_article", "in_chrome",
)

#: The labelled table: features as listed, then whether the block is main text. Fixed, judged by hand.
LABELLED = (
    # Menus, headers, footers, side bars, notices, adverts, forms and comments of known surroundings.
    (1, 1.00, 0, 0.00, 1, 1.00, 0, 1, 0),
    (1, 1.00, 1, 1.00, 1, 1.00, 0, 1, 0),
    (2, 1.00, 1, 1.00, 9, 0.00, 0, 1, 0),
    (9, 0.00, 1, 1.00, 11, 0.00, 0, 1, 0),
    (14, 0.00, 60, 0.00, 0, 0.00, 0, 1, 0),
    (35, 0.10, 80, 0.00, 12, 0.20, 0, 1, 0),
    (120, 0.00, 60, 0.00, 20, 0.00, 0, 1, 0),
    (22, 0.00, 45, 0.00, 3, 1.00, 1, 1, 0),
    (4, 0.50, 70, 0.00, 70, 0.00, 1, 1, 0),
    (55, 0.00, 40, 0.00, 40, 0.00, 1, 1, 0),
    (3, 1.00, 30, 0.00, 3, 1.00, 1, 1, 0),
    # Blocks of an article: headings, short and long paragraphs, lists, linked words.
    (6, 0.00, 9, 0.00, 80, 0.00, 1, 0, 1),
    (6, 0.00, 1, 1.00, 80, 0.00, 1, 0, 1),
    (1, 0.00, 60, 0.00, 70, 0.00, 1, 0, 1),
    (1, 0.00, 1, 0.00, 1, 0.00, 1, 0, 1),
    (2, 0.00, 60, 0.00, 9, 0.00, 1, 0, 1),
    (25, 0.30, 60, 0.00, 3, 0.00, 1, 0, 1),
    (90, 0.05, 6, 0.00, 120, 0.00, 1, 0, 1),
    (300, 0.00, 90, 0.00, 14, 0.10, 1, 0, 1),
    (5, 1.00, 60, 0.00, 60, 0.00, 1, 0, 1),
    (12, 0.60, 40, 0.00, 30, 0.00, 1, 0, 1),
    (8, 1.00, 8, 1.00, 8, 1.00, 1, 0, 1),
    (1, 1.00, 50, 0.00, 1, 1.00, 1, 0, 1),
    # Surroundings unknown: words and links of the block and its neighbours decide.
    (1, 1.00, 1, 1.00, 1, 1.00, 0, 0, 0),
    (3, 1.00, 0, 0.00, 2, 1.00, 0, 0, 0),
    (4, 0.80, 2, 1.00, 30, 0.00, 0, 0, 0),
    (12, 0.90, 10, 0.90, 11, 0.90, 0, 0, 0),
    (40, 0.70, 12, 0.90, 20, 0.80, 0, 0, 0),
    (3, 0.00, 2, 1.00, 2, 1.00, 0, 0, 0),
    (5, 0.00, 1, 1.00, 4, 0.60, 0, 0, 0),
    (6, 0.40, 8, 0.50, 0, 0.00, 0, 0, 0),
    (7, 0.00, 0, 0.00, 1, 1.00, 0, 0, 0),
    (30, 0.00, 40, 0.00, 50, 0.00, 0, 0, 1),
    (80, 0.00, 6, 0.00, 60, 0.00, 0, 0, 1),
    (60, 0.10, 1, 1.00, 70, 0.00, 0, 0, 1),
    (150, 0.05, 80, 0.00, 5, 1.00, 0, 0, 1),
    (45, 0.20, 3, 1.00, 3, 1.00, 0, 0, 1),
    (6, 0.00, 70, 0.00, 80, 0.00, 0, 0, 1),
    (5, 0.00, 2, 0.00, 90, 0.00, 0, 0, 1),
    (2, 0.00, 60, 0.00, 40, 0.00, 0, 0, 1),
    (9, 0.00, 50, 0.10, 12, 0.00, 0, 0, 1),
    (1, 0.00, 30, 0.00, 90, 0.00, 0, 0, 1),
    (9, 0.00, 0, 0.00, 0, 0.00, 0, 0, 1),
    (16, 0.00, 0, 0.00, 12, 0.10, 0, 0, 1),
    (12, 0.10, 16, 0.00, 0, 0.00, 0, 0, 1),
    (40, 0.00, 0, 0.00, 30, 0.00, 0, 0, 1),
    (25, 0.00, 1, 1.00, 0, 0.00, 0, 0, 1),
    (20, 0.00, 0, 0.00, 2, 1.00, 0, 0, 1),
    (18, 0.00, 2, 1.00, 3, 1.00, 0, 0, 1),
)


# --- the tree -------------------------------------------------------------------------------


def fit_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 8):
    """Binary decision tree by Gini impurity: (feature, bar, below or equal, above), or a label."""
    if depth == 0 or len(set(labels)) == 1:
        return int(2 * labels.sum() > len(labels))
    best = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for bar in (values[1:] + values[:-1]) / 2:
            low = rows[:, f] <= bar
            score = sum(n * p * (1 - p) for n, p in ((low.sum(), labels[low].mean()), ((~low).sum(), labels[~low].mean())))
            if best is None or score < best[0] - 1e-12:
                best = (score, f, float(bar), low)
    if best is None:
        return int(2 * labels.sum() > len(labels))
    _, f, bar, low = best
    return f, bar, fit_tree(rows[low], labels[low], depth - 1), fit_tree(rows[~low], labels[~low], depth - 1)


def trained_tree(labelled=LABELLED):
    data = np.array(labelled, dtype=float)
    return fit_tree(data[:, :-1], data[:, -1].astype(int))


def is_main(tree, features) -> bool:
    while isinstance(tree, tuple):
        f, bar, low, high = tree
        tree = low if features[f] <= bar else high
    return bool(tree)


# --- blocks ---------------------------------------------------------------------------------


def _surroundings(name: str, attributes: str) -> tuple[bool, bool, bool, bool]:
    """Whether an element is an article, chrome by kind, chrome by name, or a place of comments."""
    article, kind = name in ("article", "main"), name in CHROME_TAGS
    words: set[str] = set()
    if attributes.strip():
        for m in ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
            if key in ("class", "id"):
                words.update(re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", (m[2] or "")).lower()))
            elif key == "role":
                kind |= value in CHROME_ROLES
                article |= value in ("main", "article")
            elif key == "hidden" or (key == "aria-hidden" and value == "true"):
                kind = True
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                kind = True
    comments = bool(words & COMMENT_WORDS)
    headed = {"header"} if words & HEADED_WORDS else set()
    named = bool(words & CHROME_WORDS - headed)
    article = (article or bool(words & ARTICLE_WORDS)) and not named and not comments and not kind
    return article, kind, named and name not in ("article", "main"), comments


def silent_end(page: str, at: int, name: str) -> int:
    """Where a silent element ends whose content begins at ``at``: after its end tag, or where its parent ends.

    One without an end tag of its own before that gives back all from its first block of text.
    """
    if name in RAW:
        end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
        return end.end() if end else len(page)
    inside: list[str] = []
    block = None
    while m := TAG.search(page, at):
        at, tag = m.end(), (m[2] or "").lower()
        if not tag or tag in EMPTY or (not m[1] and m[3].endswith("/")):
            continue
        if m[1]:
            if tag in inside:
                del inside[len(inside) - 1 - inside[::-1].index(tag) :]
            elif tag == name:
                return at
            elif name == "select" and tag in ("option", "optgroup"):
                continue
            elif tag in BLOCK or tag in SILENT or tag in ("datalist", "optgroup"):
                return m.start() if block is None else block
        elif tag in RAW:
            at = silent_end(page, at, tag)
        elif (tag == name and tag not in NESTED) or (name == "option" and tag == "optgroup"):
            return m.start() if block is None else block
        else:
            if tag in TEXTUAL:
                if name in PHRASE:
                    return m.start()
                block = m.start() if block is None else block
            # The end tag of an option may be left out.
            if tag not in ("option", "optgroup"):
                inside.append(tag)
    return len(page) if block is None else block


def text_blocks(page: str | None) -> list[tuple[str, int, float, bool, bool]]:
    """Blocks of a page in order: text, words, share of words in links, inside an article, inside chrome."""
    page = page or ""
    blocks = []
    stack: list[tuple[str, tuple[bool, bool, bool, bool]]] = []
    state = (False, False)
    parts: list[tuple[str, bool]] = []
    links, at, n = 0, 0, len(page)

    def weigh() -> tuple[bool, bool]:
        article = kind = named = comments = False
        for name, (is_article, is_kind, is_named, is_comments) in stack:
            if is_article:
                # An advert that was never closed doesn't swallow the article after it.
                article, named = True, False
            # The header of an article holds its heading.
            kind |= is_kind and not (article and name == "header")
            named |= is_named
            comments |= is_comments
        return article, kind or named or comments

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(t for t, _ in parts)).split())
            if text:
                words = text.count(" ") + 1
                linked = len(html.unescape(" ".join(t for t, inside in parts if inside)).split())
                blocks.append((text, words, min(1.0, linked / words), *state))
            parts.clear()

    while at < n:
        m = TAG.search(page, at)
        upto = m.start() if m else n
        if upto > at:
            parts.append((page[at:upto], links > 0))
        if not m:
            break
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name, closing = name.lower(), bool(m[1])
        if name in SILENT:
            if not closing and not m[3].endswith("/"):
                at = silent_end(page, at, name)
            continue
        if name == "br":
            parts.append((" ", False))
        elif name == "a":
            links = 0 if closing else 1
        if name in BLOCK:
            flush()
            links = 0
        if name in HOLDER and name not in EMPTY:
            if closing:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        flush()
                        del stack[i:]
                        break
            elif not m[3].endswith("/"):
                about = _surroundings(name, m[3])
                if name == "p":
                    # A paragraph ends where the next one begins.
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] == "p":
                            del stack[i]
                            break
                        if stack[i][0] not in ("span",):
                            break
                if name not in ("p", "span") or any(about):
                    flush()
                    stack.append((name, about))
                elif name == "span":
                    stack.append((name, about))
            state = weigh()
    flush()
    return blocks


def main_text(page: str | None, tree) -> str:
    blocks = text_blocks(page)
    kept = []
    for i, (text, words, density, article, chrome) in enumerate(blocks):
        _, words_before, density_before, *_ = blocks[i - 1] if i else ("", 0, 0.0)
        _, words_after, density_after, *_ = blocks[i + 1] if i + 1 < len(blocks) else ("", 0, 0.0)
        row = (words, density, words_before, density_before, words_after, density_after, article, chrome)
        if is_main(tree, row):
            kept.append(text)
    return "\n".join(kept)


def extract(pages: DataFrame, labelled=LABELLED) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars (code points).

    One row for each page, repeated or without id. A null or empty page, one without markup that holds only a menu,
    and one that is cut off all give what text they have, else an empty one. Character references are decoded,
    white space inside a block becomes one space, blocks are joined in page order by a line feed. The
    tree is fitted to ``labelled``, rows of ``FEATURES`` and a label. Other columns are ignored.
    """
    rows = pages.select("page_id", "url", "html")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    tree = trained_tree(labelled)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["page_id", "url"]].assign(text=[main_text(x, tree) for x in batch["html"]])

    found = through_pandas(rows, run, f"url {kinds['url']}, text string", "page_id")
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


QUERY = "op1_main_text"


def query(spark, folder) -> DataFrame:
    return extract(table(spark, folder, "pages"))
