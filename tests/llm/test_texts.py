"""Substring dedup, string tiling, near duplicates on small tables against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T

from eventloom.llm import minhash_bayes, phrase_automata, string_tiling
from eventloom.llm.components import components
from tests.llm import brute

rng = random.Random(5)


def prose(n, seed=None):
    r = random.Random(seed) if seed is not None else rng
    return " ".join(r.choice(["the", "of", "And"]) if r.random() < 0.3 else f"w{r.randrange(5000)}" for _ in range(n))


def repeats():
    shared, short, edge = prose(80, 1), prose(34, 2), prose(35, 3)
    rows = [
        (1, prose(50) + " " + shared + "\n" + prose(20)), (2, shared), (3, prose(10) + "\t" + shared[: len(shared) // 2] + " " + prose(60)),
        (4, short + " " + prose(9)), (5, prose(9) + " " + short), (6, edge), (7, prose(3) + " " + edge.replace(" ", "  ") + " " + prose(3)),
        (8, "la " * 300), (9, "la " * 34), (10, None), (11, ""), (12, "  \n "), (13, prose(90, 7)), (13, prose(90, 7)),
        (None, prose(70, 8)), (14, prose(70, 8)), (15, " ".join([prose(40, 9)] * 3)), (16, "x" * 50000), (17, prose(12000, 10)),
        (18, " ".join(prose(12000, 10).split()[4000:9000])), (19, prose(34, 11) + " q " + prose(34, 11)),
    ]
    for k in range(20):
        cut = shared.split()
        at = rng.randrange(len(cut) - 40)
        rows.append((100 + k, prose(5) + " " + " ".join(cut[at : at + 30 + rng.randrange(12)]) + " " + prose(5)))
    return rows


@pytest.mark.parametrize("p", [phrase_automata.Params(), phrase_automata.Params(block_chars=500)])
def test_substring_dedup_equals_brute_force(spark, p):
    rows = repeats()
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id bigint, text string, n_words int").repartition(5)
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in phrase_automata.without_repeats(df, p=p).collect()]
    want = [(d, *w) for (d, _), w in zip(rows, brute.without_repeats([t for _, t in rows]))]
    order = lambda x: (x[0] is None, x[0] or 0, x[3])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert sum(w[2] for w in want) > 500


def test_phrases_of_a_block_are_dealt_in_parts(spark, monkeypatch):
    """Pairs of texts behind one header: its gram is the anchor of a phrase of every pair."""
    header = " ".join(f"head{i}" for i in range(8))
    rows = []
    for k in range(60):
        body = prose(45, 900 + k)
        rows += [(2 * k, header + " " + body + " x"), (2 * k + 1, "y " + header + " " + body)]
    locate = phrase_automata._locate

    def watched(p):
        run = locate(p)

        def bounded(passages, phrases):
            size = sum(len(x) for x in phrases.column("phrase").to_pylist())
            assert size < 4 * p.part_chars, "a part holds too many phrases"
            return run(passages, phrases)

        return bounded

    monkeypatch.setattr(phrase_automata, "_locate", watched)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = phrase_automata.without_repeats(df, p=phrase_automata.Params(block_chars=2000, part_chars=2000)).collect()
    want = dict(zip([d for d, _ in rows], brute.without_repeats([t for _, t in rows])))
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out} == want


def test_a_phrase_goes_to_the_blocks_that_hold_a_window_of_it(spark, monkeypatch):
    """Pairs of texts around one passage too short to be a window: each phrase has its grams, two texts have its windows."""
    common = " ".join(f"com{i}" for i in range(20))
    rows = []
    for k in range(60):
        text = f"{prose(25, 2000 + k)} {common} {prose(25, 3000 + k)}"
        rows += [(2 * k, text + " x"), (2 * k + 1, "y " + text)]

    def counted(p):
        def run(passages, phrases):
            n = pa.array([phrases.num_rows], pa.int32())
            return pa.table({"row": passages.column("row").combine_chunks()[:1], "at": n, "to": n})

        return run

    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    p = phrase_automata.Params(block_chars=2000)
    out = phrase_automata.without_repeats(df, p=p).collect()
    want = dict(zip([d for d, _ in rows], brute.without_repeats([t for _, t in rows])))
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out} == want
    monkeypatch.setattr(phrase_automata, "_locate", counted)
    sent = sum(r["spans"][0]["at"] for r in phrase_automata.repeated_spans(df, "text", "doc_id", p).collect())
    # a phrase is at most two pieces, and a piece is in two texts
    assert 60 <= sent <= 60 * 2 * 2


def test_substring_dedup_of_test_documents_and_of_none(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = df.collect()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in phrase_automata.without_repeats(df, whole=False).collect()}
    assert got == dict(zip([r["doc_id"] for r in rows], brute.without_repeats([r["text"] for r in rows])))
    assert phrase_automata.without_repeats(df.limit(0)).count() == 0


SMALL = st.lists(st.integers(0, 3), max_size=14)


@given(SMALL, SMALL, st.integers(2, 4))
@settings(deadline=None, max_examples=200)
def test_tiles_are_greedy(item, doc, least):
    p = string_tiling.Params(least=least)
    found = string_tiling.tiles(np.array(item, np.uint64), np.array(doc, np.uint64), p)
    for a, b, n in found:
        assert n >= least and item[a : a + n] == doc[b : b + n]
    used = [a + k for a, _, n in found for k in range(n)]
    assert len(used) == len(set(used)) and len({b + k for _, b, n in found for k in range(n)}) == len(used)
    first = max((n for _, _, n in found), default=0)
    assert first == max(brute.tiled(item, doc, least), default=0)
    free = [k not in set(used) for k in range(len(item))]
    other = {b + k for _, b, n in found for k in range(n)}
    for i in range(len(item) - least + 1):  # nothing is left over
        for j in range(len(doc) - least + 1):
            open_ = all(free[i + k] and j + k not in other for k in range(least))
            assert not (open_ and item[i : i + least] == doc[j : j + least])


@pytest.mark.parametrize("p", [string_tiling.Params(), string_tiling.Params(pass_chars=150)])
def test_reordered_passages_are_found(spark, p):
    items = [prose(40, 20 + k) for k in range(4)]
    halves = items[0].split()
    moved = " ".join([*halves[20:], "between", *halves[:20]]).replace(" of ", " OF, ")
    docs = [
        (1, prose(30) + " " + items[0] + ". " + prose(30)), (2, prose(30) + "\n" + moved), (3, prose(200)), (4, None), (5, ""),
        (6, " ".join(items[1].split()[:10]) + " " + prose(50)), (7, items[2] + " " + items[3]), (7, items[2]), (8, "x" * 60000),
        (None, items[1]),
    ]
    df = spark.createDataFrame([(*d, "k") for d in docs], "doc_id bigint, text string, item_id string")
    bench = spark.createDataFrame(
        [*enumerate(items), (9, "too short"), (10, None), (None, None)], "item_id bigint, text string"
    )
    got = sorted((r["doc_id"] or 0, r["item_id"]) for r in string_tiling.contaminated(df, bench, p=p).collect())
    assert got == [(0, 1), (1, 0), (2, 0), (7, 2), (7, 2), (7, 3)]
    clean = string_tiling.decontaminated(df, bench, p=p)
    assert clean.columns == df.columns and sorted(r["doc_id"] for r in clean.collect()) == [3, 4, 5, 6, 8]
    assert string_tiling.contaminated(df, bench.limit(0), p=p).count() == 0
    assert string_tiling.decontaminated(df, bench.limit(0), p=p).count() == len(docs)
    assert string_tiling.contaminated(df.limit(0), bench, p=p).count() == 0


def test_short_items_and_scripts_without_spaces(spark):
    items = [
        (1, "alpha beta gamma delta"), (2, "水は百度で沸騰し、零度で凍る。"), (3, "seven words make an item long enough"), (4, "..."), (5, ""),
        (6, "ประเทศไทยอยู่ในเอเชีย"), (7, "alpha beta gamma delta"),
    ]
    docs = [(d, f"x {t} y") for d, t in items[:3]] + [
        (10, "Alpha, beta — gamma\u3000delta!"), (11, "alpha beta gamma no delta"), (12, "前置き水は百度で沸騰し零度で凍るので"), (13, "水は百度の日本"),
        (14, "ก่อนประเทศไทยอยู่ในเอเชียหลัง"), (15, "零度で凍る。水は百度で沸騰し、"), (16, "betaalpha beta gamma deltas"), (17, None), (18, "…"),
        (19, "水" * 60000),
    ]
    left = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in string_tiling.contaminated(left, bench).collect())
    assert got == [(1, 1), (1, 7), (2, 2), (3, 3), (10, 1), (10, 7), (12, 2), (14, 6), (15, 2)]
    clean = string_tiling.decontaminated(left, bench)
    assert sorted(r["doc_id"] for r in clean.collect()) == [11, 13, 16, 17, 18, 19]


def test_tokens_beyond_ascii():
    column = pa.array(["Aé b\u00a0c«d» e", "日本a語", None, "x。y", "é" * 3 + "–" + "ö", "𠀀𠀁z"])
    words = string_tiling.tokens_of(column)
    got = [[w.decode() for w in words.strings(a, b)] for a, b in zip(words.first, words.first[1:])]
    assert got == [["aé", "b", "c", "d", "e"], ["日", "本", "a", "語"], [], ["x", "y"], ["ééé", "ö"], ["𠀀", "𠀁", "z"]]


def test_columns_with_the_names_operators_use(spark):
    text = prose(60, 51)
    names = [
        "__row", "__key", "__text", "__spans", "row", "of", "place", "spans", "at", "to", "key", "cls", "band", "group", "label",
        "n_words", "kept_sha256", "__chosen", "a.b",
    ]
    df = spark.createDataFrame(
        [(1, text, *[f"v{n}" for n in names]), (2, text + " x", *[f"u{n}" for n in names])],
        T.StructType([T.StructField("doc_id", T.LongType()), *(T.StructField(n, T.StringType()) for n in ["text", *names])]),
    )
    out = phrase_automata.without_repeats(df)
    rows = sorted(out.collect())
    replaced = ["n_words", "n_removed", "kept_sha256", "kept_text"]
    assert out.columns == ["doc_id", *(n for n in names if n not in replaced), *replaced]
    assert [(r["n_words"], r["n_removed"], r["kept_text"], r["__row"], r["a.b"]) for r in rows] == [
        (60, 60, "", "v__row", "va.b"), (61, 60, "x", "u__row", "ua.b"),
    ]
    kept = minhash_bayes.one_of_each(df)
    assert kept.columns == df.columns and [r["__row"] for r in kept.collect()] == ["v__row"]
    assert {r["component_id"] for r in minhash_bayes.near_duplicates(df).collect()} == {1}
    bench = spark.createDataFrame([(7, text, 0)], "item_id bigint, text string, __item int")
    assert string_tiling.decontaminated(df, bench).columns == df.columns
    assert string_tiling.contaminated(df, bench).count() == 2


def near_rows():
    base = prose(150, 30).split()
    rows = [(50, " ".join(base)), (40, " ".join(base)), (41, " ".join(base).upper())]
    for k in range(60):
        copy = list(base)
        for _ in range(k % 8):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
        rows.append((100 + k, " ".join(copy)))
    rows += [(1, None), (2, ""), (3, " "), (4, "a b"), (5, "A  b"), (6, "a b c"), (None, "n1 n2 n3 n4 n5 n6"), (None, "n1 n2 n3 n4 n5 n6")]
    rows += [(7, prose(60, 31)), (7, prose(60, 31)), (8, prose(9000, 32)), (9, prose(9000, 32) + " tail"), (10, "x " * 500), (11, "x " * 700)]
    return rows


@pytest.mark.parametrize("p", [minhash_bayes.Params(), minhash_bayes.Params(piece_docs=7)])
def test_near_duplicates_equal_brute_force(spark, p):
    rows = near_rows()
    df = spark.createDataFrame([(*r, True) for r in rows], "doc_id bigint, text string, kept boolean").repartition(4)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_bayes.near_duplicates(df, p=p).collect()]
    want = [(d, n, c, d is not None and d == c) for (d, _), (n, c, _) in zip(rows, brute.components(rows))]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_rows_that_agree_in_id_and_text_are_compared_once(spark, monkeypatch):
    verifier = minhash_bayes._verifier

    def strict(p):
        run = verifier(p)

        def once(table):
            assert len(set(table.column("cls").to_pylist())) == table.num_rows, "a class came more than once"
            return run(table)

        return once

    monkeypatch.setattr(minhash_bayes, "_verifier", strict)
    text = prose(60, 41)
    df = spark.createDataFrame([(None, text)] * 9 + [(1, text + " tail")], "doc_id bigint, text string").repartition(3)
    got = minhash_bayes.near_duplicates(df, p=minhash_bayes.Params(piece_docs=1)).collect()
    assert len(got) == 10 and {r["component_id"] for r in got} == {1}


def test_near_duplicates_of_test_documents_and_of_none(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash_bayes.near_duplicates(df).collect()}
    assert got == {d: w[:2] for (d, _), w in zip(rows, brute.components(rows))}
    assert minhash_bayes.near_duplicates(df.limit(0)).count() == 0


def test_one_of_each(spark):
    rows = near_rows()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, group int")
    out = minhash_bayes.one_of_each(df)
    groups = {}
    for (d, t), (n, _, g) in zip(rows, brute.components(rows)):
        groups.setdefault(g if n else ("alone", d, t), []).append(d)
    best = sorted(min(x for x in v if x is not None) if any(x is not None for x in v) else -1 for v in groups.values())
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in out.collect()) == best
    assert out.columns == df.columns


def test_bounds_never_drop_a_likely_pair():
    p = minhash_bayes.Params()
    bounds = minhash_bayes.least_matches(p)
    assert len(bounds) == p.hashes // p.batch and bounds == sorted(bounds)
    # far below what a pair at the threshold shows on average
    assert all(m < 0.85 * p.batch * (k + 1) for k, m in enumerate(bounds)) and bounds[-1] > 0.6 * p.hashes


def test_components_of_a_long_chain(spark):
    links = spark.range(300).selectExpr("(id * 7919) % 1000003 AS a", "((id + 1) * 7919) % 1000003 AS b")
    labels = components(links, "a", "b").collect()
    assert len(labels) == 301 and {r["label"] for r in labels} == {0}
    assert components(links.limit(0), "a", "b").count() == 0
