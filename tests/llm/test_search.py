"""Ranked search against scores of every document."""

import collections
import math
import random
import re

import numpy as np
import pytest

from eventloom.llm import k2_treap
from eventloom.llm.k2_treap import Params, Treap, grow, ranked
from tests.llm.brute import LOWER

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def best(docs, items, top=20):
    """docs, items: lists of (id, text); rows of item, rank, document and score."""
    counts = [(d, collections.Counter(terms(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    big_n, big_l = len(counts), sum(n for *_, n in counts)
    df = collections.Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in counts:
            m = 100 - 25 + (25 * n * big_n) // big_l
            score = sum(
                math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms(text) if t in c
            )
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def corpus(seed=4):
    r = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(400)] + ["É", "éa", "日本", "A1", "a1"]
    prose = lambda n: r.choice([" ", "-", "\n", ". "]).join(
        vocabulary[min(int(r.paretovariate(0.6)) - 1, len(vocabulary) - 1)] for _ in range(n)
    )
    docs = [(i, prose(r.randrange(1, 120))) for i in range(200)]
    same = prose(40)
    docs += [(1000 - i, same) for i in range(45)] + [(3, docs[3][1]), (None, docs[5][1]), (None, same), (None, None)]
    docs += [(900, None), (901, ""), (902, "-- ... \x00"), (903, "solo"), (904, prose(30000)), (905, "t0 " * 5000), (906, "x" * 90000)]
    items = [(i, prose(r.randrange(1, 30))) for i in range(25)]
    items += [(50, same), (51, None), (52, ""), (53, "nowhere else"), (54, "solo SOLO"), (55, prose(3000)), (50, same), (50, "solo"), (None, "t1 日本")]
    return docs, items


def answers(df):
    return sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in df.collect()), key=repr)


@pytest.mark.parametrize("p", [Params(), Params(shard_tokens=700, width=2, pass_chars=900, held_nodes=600, salts=3)])
def test_ranks_equal_brute_force(spark, p):
    docs, items = corpus()
    left = spark.createDataFrame([(*d, 1, 1, 1, "x") for d in docs], "doc_id bigint, text string, score int, rank int, key int, item_id string")
    right = spark.createDataFrame([(*i, 1, 1, 1) for i in items], "item_id bigint, text string, number int, doc int, salt int")
    got = answers(ranked(left.repartition(4), right.repartition(2), p=p))
    assert got == best(docs, items)
    assert collections.Counter(r[0] for r in got)[50] >= 41


def test_ranks_of_test_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    want = best([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert answers(ranked(docs, items)) == want


def test_empty_tables_and_text_keys(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "x")], "item_id string, text string")
    assert ranked(docs.limit(0), items).count() == 0
    assert ranked(docs, items.limit(0)).count() == 0
    more = docs.unionByName(spark.createDataFrame([(f"z{i}", "z") for i in range(9)], docs.schema))
    assert [(r[1], r[2]) for r in answers(ranked(more, items))] == [(1, "a"), (2, "b")]


def test_a_tree_holds_the_maxima_of_its_cells():
    draw = np.random.default_rng(2)
    point = np.unique(draw.integers(0, 64 * 64, 300))
    row, column, value = point // 64, point % 64, draw.integers(1, 10**6, len(point))
    sizes, masks, falls = grow(row, column, value, 6)
    tree = Treap(sizes, masks, falls)
    assert sizes[-1] == len(point) and tree.top[0] == value.max()
    for r in range(64):
        node, level = np.zeros((1, 1), np.int64), 0
        ranges = {0: node}
        while level < 6:
            ranges = {
                2 * c + half: tree.opened(n, np.array([level]), np.array([r]), half) for c, n in ranges.items() for half in (0, 1)
            }
            level += 1
            for c, n in ranges.items():
                low, high = r >> (6 - level) << (6 - level), ((r >> (6 - level)) + 1) << (6 - level)
                inside = (row >= low) & (row < high) & (column >> (6 - level) == c)
                assert tree.top[n[0, 0]] == value[inside].max(initial=0)


def test_most_ranges_are_never_opened():
    draw = np.random.default_rng(5)
    column = np.arange(4096)
    value = draw.integers(1, 1000, 4096)
    value[77] = 10**6
    tree = Treap(*grow(np.zeros(4096, np.int64), column, value, 12))
    opened = []
    plain = tree.opened
    tree.opened = lambda node, *rest: opened.append(len(node)) or plain(node, *rest)
    columns, scores = tree.best(np.array([0]), np.array([3]), np.zeros(0, np.int64), Params(top=1, width=1))
    assert columns.tolist() == [77] and scores.tolist() == [3 * 10**6] and sum(opened) == 24
    assert k2_treap.Params().top == 20
