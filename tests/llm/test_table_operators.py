"""Operators over whole tables: passages, near-duplicates, mixing, neighbours, transcripts, the pipeline."""

import itertools
import random
import string
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from snaptrend.llm import lines, mixing, near, neighbours, transcripts
from snaptrend.llm.registry import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


def prose(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 8))) for _ in range(n)]
    return " ".join(w + ("." if rng.random() < 0.15 else "") for w in words)


@pytest.fixture(scope="module")
def docs(spark):
    """A passage in the middle of three texts, copies, near copies, nulls, empty and long texts, clashing names."""
    shared, base = prose("shared", 70), prose("base", 300).split()
    changed = base[:150] + ["other", "words"] + base[152:]
    halved = base[:150] + prose("half", 150).split()
    texts = [
        (1, f"{prose(1, 90)} {shared} {prose(2, 90)}"), (2, f"{prose(3, 40)}\n{shared}"), (3, f"{shared} {prose(4, 200)}"),
        (4, " ".join(base)), (5, " ".join(base)), (6, " ".join(changed)), (7, " ".join(halved)),
        (8, None), (9, None), (10, ""), (None, prose(5, 100)), (None, prose(5, 100)), (11, "word " * 30_000), (11, prose(6, 80)),
        (12, "one two three"), (13, "One, two three!"),
    ]
    rows = spark.createDataFrame(texts, "doc_id bigint, text string")
    return rows.selectExpr("*", "'s' as source", "1 as _id", "2 as _hash", "3 as n", "4 as label", "'x' as _c0", "5 as a", "6 as h")


# --- passages -------------------------------------------------------------------------------


def test_passages_stay_once(spark, docs):
    got = lines.without_repeats(docs)
    assert got.columns == [*docs.columns, "removed_words"]
    rows = got.collect()
    assert len(rows) == docs.count()
    shared = prose("shared", 70)
    assert [r.doc_id for r in rows if r.text and shared in r.text] == [1]
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert by[2][0].text.strip() == prose(3, 40) and by[3][0].text.strip() == prose(4, 200)
    assert by[4][0].removed_words == 0 and by[5][0].text == ""
    assert by[8][0].text is None and by[10][0].text == "" and all(r.removed_words == 0 for r in by[None] + by[11] + by[12])
    assert lines.without_repeats(docs.limit(0)).count() == 0


def test_clean_texts_are_untouched(spark):
    texts = [(i, f"Common line of the site.\n{prose(100 + i, 120)}\nAll rights reserved.") for i in range(40)]
    rows = spark.createDataFrame(texts, "doc_id int, text string")
    assert {(r.doc_id, r.text) for r in lines.without_repeats(rows).collect()} == set(texts)


def test_boundaries_resist_shifts():
    passage, chunker = prose("p", 80), lines.Chunker()
    found = []
    for k in range(6):
        text = f"{prose(k, 30 + k)} {passage} {prose(k + 50, 20)}"
        _, a, b, h = chunker.chunks([text])
        found.append({int(x): text[i:j] for x, i, j in zip(h, a, b, strict=True)})
    common = set.intersection(*map(set, found))
    assert common and all(len({f[x] for f in found}) == 1 for x in common)


def test_many_texts_chunk_like_one(monkeypatch):
    monkeypatch.setattr(lines, "PIECE", 900)
    texts = [prose(i, 5 + 37 * i) for i in range(12)] + ["", " \n ", "a"]
    chunker = lines.Chunker()
    who, *rest = chunker.chunks(texts)
    for k, text in enumerate(texts):
        for have, want in zip(rest, chunker.chunks([text])[1:], strict=True):
            assert (have[who == k] == want).all()


# --- near-duplicates ------------------------------------------------------------------------


def plain_lcs(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        last = 0
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], last + 1 if a == b else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_like_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        x = np.array([rng.randrange(9) for _ in range(rng.randint(1, 40))], np.uint64)
        y = np.array([v if rng.random() < 0.9 else np.uint64(rng.randrange(9)) for v in x][rng.randrange(3) :], np.uint64)
        n = plain_lcs(x.tolist(), y.tolist())
        assert near.common_length(x, y, len(x) + len(y)) == n
        for least in (0.5, 0.8):
            assert near.similar(x, y, least) == (len(y) > 0 and n / (len(x) + len(y) - n) >= least - 1e-9)


def brute_classes(texts, least=0.8):
    runs = [near.runs_of(t)[0] for t in texts]
    forest = near.Forest(len(texts))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if near.similar(runs[i], runs[j], least):
            forest.join(i, j)
    return [forest.top(i) for i in range(len(texts))]


def same_partition(a, b):
    return len(set(zip(a, b, strict=True))) == len(set(a)) == len(set(b))


def test_classes_like_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in near.query(spark, SMALL).collect()}
    assert same_partition([got[r.doc_id].class_id for r in rows], brute_classes([r.text for r in rows]))
    heads = [r.doc_id for r in got.values() if r.representative]
    assert sorted(heads) == sorted({r.class_id for r in got.values()})


def test_large_group_is_split_and_whole(spark, monkeypatch):
    base, texts = prose("b", 60).split(), []
    for i in range(60):
        words = list(base)
        words[(7 * i) % 60] = f"changed{i}"
        texts.append(" ".join(words))
    texts += [prose(i, 60) for i in range(20)]
    found = near.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    assert same_partition([r.class_id for r in sorted(found, key=lambda r: r._id)], brute_classes(texts))
    monkeypatch.setattr(near, "BLOCK_TEXTS", 16)
    again = near.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    assert {(r._id, r.class_id) for r in again} == {(r._id, r.class_id) for r in found}


def test_one_of_each(spark, docs):
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    # 5 and 6 are copies of 4, 13 of 12; the texts without words are one class.
    assert ids == Counter([1, 2, 3, 4, 7, 8, None, 11, 11, 12])
    assert near.one_of_each(docs.limit(0)).count() == 0


# --- mixing ---------------------------------------------------------------------------------


def test_mix_like_sql(spark):
    got = mixing.query(spark, SMALL).toPandas()
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    want = con.execute(ORACLE["op9_mix_sources"]).df()
    both = got.merge(want, on="doc_id", suffixes=("", "_sql"))
    assert len(both) == len(got) == len(want)
    for c in ("size", "source_size", "target", "taken"):
        assert (both[c] == both[f"{c}_sql"]).all()
    assert abs(got.taken.sum() - 1.5 * got["size"].sum()) <= 20


def test_schedule_is_even(spark):
    plan = spark.createDataFrame([(0, "a", 5000), (1, "b", 2000), (2, "c", 1000), (3, "d", 0)], "_sid int, source string, _quota bigint")
    slots = mixing.schedule(plan, 100).orderBy("slot").collect()
    assert Counter(r._sid for r in slots) == {0: 50, 1: 20, 2: 10}
    for sid in range(3):
        assert [r.rank for r in slots if r._sid == sid] == list(range(1, len([r for r in slots if r._sid == sid]) + 1))
    for n in (8, 16, 32, 64):
        counts = Counter(r._sid for r in slots[:n])
        assert all(abs(counts[s] - n * share) <= 3 for s, share in ((0, 50 / 80), (1, 20 / 80), (2, 10 / 80)))


def test_mix_odd_rows(spark, docs):
    rows = docs.withColumn("source", docs["source"]).collect()
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in got)
    assert sorted((r.size for r in got if r.doc_id in (8, 9, 10))) == [0, 0, 0]
    one = spark.createDataFrame([(1, "a b c", None), (1, "a b c", None), (2, "x " * 9, "s"), (3, None, "t")], "doc_id int, text string, source string")
    got = sorted((r.doc_id, r.source, r.target, r.taken) for r in mixing.mix(one, block=2).where("source is not null").collect())
    assert got == [(2, "s", 18.0, 18), (3, "t", 0.0, 0)]
    assert sorted(r.taken for r in mixing.mix(one, block=2).where("source is null").collect()) in ([1, 4], [0, 5], [2, 3], [1, 3], [0, 4])
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_runs_no_python(spark):
    plan = mixing.query(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


# --- neighbours -----------------------------------------------------------------------------


def test_neighbours_like_sql(spark):
    got = neighbours.query(spark, SMALL).toPandas()
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SMALL}/embeddings.parquet'")
    want = con.execute(ORACLE["op10_vp_neighbours"]).df()
    both = got.merge(want, on=["query_id", "rank"], suffixes=("", "_sql"))
    assert len(both) == len(got) == len(want) and (both.vec_id == both.vec_id_sql).all() and (both.score == both.score_sql).all()


@pytest.mark.parametrize("factor", [1.0, 1.5, 3.0])
def test_recall_by_factor(factor):
    rng = np.random.default_rng(1)
    points = np.repeat(rng.normal(size=(40, 8)) * 3, 60, axis=0) + rng.normal(size=(2400, 8))
    points[:300] = points[0]
    ids = rng.permutation(2400)
    order, nodes = neighbours.build_tree(np.column_stack([points, np.sqrt(np.maximum((points**2).sum(1).max() - (points**2).sum(1), 0))]), 32)
    top = (points**2).sum(axis=1).max()
    found, _ = neighbours.Search(ids[order], points[order], nodes, top, 20, factor).run(ids[::20], points[::20])
    scores = points[::20] @ points.T
    hits = 0
    for row, q, have in zip(scores, ids[::20], found, strict=True):
        best = [i for _, i in sorted(zip(-row, ids, strict=True)) if i != q][:20]
        hits += len({round(float(row[list(ids).index(i)]), 9) for i in best} & {round(float(row[list(ids).index(i)]), 9) for i in have}) / len({round(float(row[list(ids).index(i)]), 9) for i in best})
    assert hits / len(scores) >= {1.0: 0.999, 1.5: 0.9, 3.0: 0.3}[factor]


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, [None, 1.0]), (None, [9.0, 9.0]), (9, [1.0, 0.0, 0.0]), (20, [0.5, 0.0]), (20, [0.25, 0.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as _v", "2 as _dim", "3 as score")
    got = neighbours.nearest(table, table.where("vec_id = 0"), k=20).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 1.0), (2, 1.0), (20, 0.5), (20, 0.25)]
    assert neighbours.nearest(table.limit(0), table.limit(0)).count() == 0


# --- transcripts ----------------------------------------------------------------------------


def test_viterbi_like_brute_force(spark):
    parts = transcripts.transcripts(spark.read.parquet(f"{SMALL}/conversations.parquet"))
    model = transcripts.fit(parts)
    rows = [["User: hi?", "more", "A: yes.", "- and?"], ["Human: ok", "- fine."], ["no mark"]]

    def score(path):
        flat = [x for r in rows for x in r]
        seen = model.scores(flat)
        total = model.start[path[0]] + seen[0, path[0]]
        for i in range(1, len(flat)):
            total += model.step[path[i - 1], path[i]] + seen[i, path[i]]
        at = 0
        for r in rows:
            if path[at] % 2:
                return -np.inf
            at += len(r)
        return total

    best = max(itertools.product(range(transcripts.STATES), repeat=7), key=score)
    ends = model.ends([model.table(r) for r in rows])
    got = [s for r, (a, b) in zip(rows, ends, strict=True) for s in model.path(r, a, b)]
    assert score(got) == pytest.approx(score(best))


def test_roles_are_recovered(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    parts = transcripts.transcripts(turns)
    found = transcripts.parse(parts.where("conv_id % 3 = 0"), transcripts.fit(parts.where("conv_id % 3 <> 0"))).collect()
    true = turns.where("conv_id % 3 = 0").orderBy("conv_id", "turn").collect()
    have, want = defaultdict(list), defaultdict(list)
    for r in sorted(found, key=lambda r: (r.conv_id, r.part, r.turn)):
        have[r.conv_id].append(r.role)
        assert r.rendered == f"<|{r.role}|>\n{r.text}\n<|end|>"
    for r in true:
        want[r.conv_id].append(r.role)
    assert sum(have[c] == want[c] for c in want) >= 0.8 * len(want)


def test_long_conversations_are_parted(spark):
    rows = [(1, t % 300, ("user", "assistant")[t % 2], f"Text {t}.\nline") for t in range(900)] + [(None, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").selectExpr("*", "1 as part", "2 as lines")
    parts = transcripts.transcripts(turns, 16)
    assert parts.selectExpr("max(size(lines))").first()[0] <= 200 and parts.count() > 20
    assert parts.selectExpr("sum(size(lines))", "sum(size(states))").first()[:] == (1801, 1801)
    found = transcripts.parse(parts, transcripts.fit(parts))
    assert found.where("conv_id is null").count() == 1
    assert transcripts.transcripts(turns.limit(0)).count() == 0


# --- pipeline -------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
        rows = out.collect()
        assert len({r.doc_id for r in rows}) == len(rows) <= n
        docs, n = spark.createDataFrame(rows, docs.schema), len(rows)
    by_stages = {tuple(r) for r in corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()}
    assert {tuple(r) for r in QUERIES["pipeline"](spark, SMALL).collect()} == by_stages and len(by_stages) == n
