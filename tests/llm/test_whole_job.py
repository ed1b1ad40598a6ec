"""Cases of the whole job that the review found missing."""

import random

import numpy as np
import pytest

from snaptrend.llm import lines, near, pages


def prose(seed, n, letters="abcdefghijklmnopqrstuvwxyz"):
    rng = random.Random(str(seed))
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(n))


# --- passages -------------------------------------------------------------------------------

CYRILLIC = "абвгдежзийклмнопрстуфхцчшщ"
CJK = "".join(chr(c) for c in range(0x4E00, 0x4F00))


def shared_chunks(passage, k):
    found = []
    for side in (0, 1):
        text = f"{prose((k, side, 1), 40)} {passage} {prose((k, side, 2), 40)}"
        _, _, _, h = lines.Chunker().chunks([text])
        found.append(set(h.tolist()))
    return found[0] & found[1]


@pytest.mark.parametrize("kind", ["upper", "cyrillic", "consonants", "cjk", "same", "pair", "line"])
def test_fifty_words_hold_a_chunk_in_any_script(kind):
    for k in range(60):
        passage = {
            "upper": lambda: prose(k, 51).upper(), "cyrillic": lambda: prose(k, 51, CYRILLIC),
            "consonants": lambda: prose(k, 51, "bcdfghjklmnpqstvwxz"),
            "cjk": lambda: prose(k, 51, CJK).replace(" ", "")[:51],
            "same": lambda: " ".join([f"WORD{k}"] * 51), "pair": lambda: " ".join([f"BUY{k}", "NOW"] * 26),
            "line": lambda: "\n".join([prose(k, 6).upper()] * 9),
        }[kind]()
        assert shared_chunks(passage, k), (kind, k)


def test_passages_of_other_scripts_go(spark):
    shared = [prose("u", 60).upper(), prose("c", 60, CYRILLIC), prose("j", 60, CJK).replace(" ", "")[:60], " ".join(["SAME"] * 60)]
    rows = [(2 * k + side, f"{prose((k, side), 40)} {s} {prose((k, side, 2), 40)}") for k, s in enumerate(shared) for side in (0, 1)]
    got = {r.doc_id: r for r in lines.without_repeats(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert [got[2 * k].removed_words for k in range(4)] == [0] * 4
    assert [got[2 * k + 1].removed_words for k in range(4)] == [60] * 4


# --- near-duplicates ------------------------------------------------------------------------


def test_units_fail_apart():
    """Pairs of similarity 0.8 that agree in too few units: about one in 20,000."""
    rng, n, missed = np.random.default_rng(7), 45, 0
    for _ in range(4000):
        x = rng.integers(0, 2**63, n).astype(np.uint64)
        y = x.copy()
        y[rng.choice(n, n // 9, replace=False)] = rng.integers(0, 2**63, n // 9).astype(np.uint64)
        missed += (near.units(x) == near.units(y)).sum() < near.AGREE
    assert missed <= 1


# --- passages, compared and grown -----------------------------------------------------------


def test_one_other_white_space_leaves_the_rest_of_a_run(spark):
    words = prose("run", 300).split(" ")
    other = " ".join(words[:150]) + "\n" + " ".join(words[150:])
    rows = spark.createDataFrame([(1, " ".join(words)), (2, f"{prose('x', 40)} {other}")], "doc_id int, text string")
    got = {r.doc_id: r for r in lines.without_repeats(rows).collect()}
    assert got[2].removed_words == 300 and got[2].text.strip() == prose("x", 40)


def test_growing_goes_on_until_a_byte_differs(spark):
    """Long words without a chunk of their own at the head and tail of a passage: more than a margin of them."""
    long = ["".join(random.Random(f"w{k}").choices("ABCDEFGH", k=3000)) for k in range(2)]
    shared = f"{long[0]} {prose('grow', 60)} {long[1]}"
    rows = [(1, f"{prose('l', 30)} {shared} {prose('r', 30)}"), (2, f"{prose('m', 30)} {shared} {prose('s', 30)}")]
    got = {r.doc_id: r for r in lines.without_repeats(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got[2].removed_words == 62 and not any(w in got[2].text for w in long)


# --- pages ----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "silent",
    [
        "<button>Buy", "<noscript><img src=x>", "<canvas>", "<svg><path d=x>", "<object data=x>", "<template>", "<iframe src=x>",
        "<div><button>Buy</div>", "<datalist><option value=a>A<option value=b>B</datalist>",
        "<select><option>A<option>B</select>", "<noscript><p>Turn it on</p></noscript>", "<button><div>Buy</div></button>",
    ],
)
@pytest.mark.parametrize("later", ["", "<button>Sell</button>"])
def test_unclosed_silent_elements_leave_the_article(silent, later):
    page = f"<article><p>Before it.</p>{silent}<p>The rest of the article.</p>{later}<p>Its end.</p></article>"
    assert pages.main_text(page, pages.trained_tree()) == "Before it.\nThe rest of the article.\nIts end."


def test_lines_keep_ids_and_clashing_columns(spark):
    far, shared = 2**53 + 1, prose("ids", 80)
    rows = [(far, f"a {shared}"), (None, f"b {shared}"), (far + 2, f"c {shared}"), (None, None), (7, ""), (far, f"a {shared}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "1 as removed_words", "2 as _id", "3 as _hash", "4 as _blob", "5 as places", "timestamp'2024-01-01 00:00:00' as _c0", "array(doc_id) as _cuts"
    )
    got = lines.without_repeats(docs, gone=None)
    assert got.columns == docs.columns
    found = got.collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in found) == sorted([(far, "a"), (far, "a"), (0, f"b {shared}"), (far + 2, "c"), (0, ""), (7, "")])
    assert all(r.removed_words == 1 and r.places == 5 and list(r._cuts) == [r.doc_id] for r in found)
