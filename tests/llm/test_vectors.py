"""Near-duplicate vectors against all pairs."""

import collections

import numpy as np
import pytest

from eventloom.llm import hyperplanes
from eventloom.llm.hyperplanes import Params, buckets, near_vectors

COLUMNS = ["vec_id", "n_links", "component_id", "kept"]


def all_pairs(rows, least=0.95):
    """rows: (id, vector); links per row, smallest id of its component and whether the row is kept."""
    n = len(rows)
    fit = [
        v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows
    ]
    parent, links = list(range(n)), [0] * n

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    unit = [np.array(v, float) / np.abs(v).max() if f else None for (_, v), f in zip(rows, fit)]
    unit = [u / np.linalg.norm(u) if f else None for u, f in zip(unit, fit)]
    for i in range(n):
        for j in range(i):
            if fit[i] and fit[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i, (key, _) in enumerate(rows):
        groups[find(i)].append(key)
    lowest = {g: min((k for k in keys if k is not None), default=None) for g, keys in groups.items()}
    return [(rows[i][0], links[i], lowest[find(i)], rows[i][0] is not None and rows[i][0] == lowest[find(i)]) for i in range(n)]


def cloud(seed=3, dimensions=24):
    draw = np.random.default_rng(seed)
    rows = [(100 + i, v.tolist()) for i, v in enumerate(draw.normal(size=(120, dimensions)))]
    at = 300
    for size, noise in ((3, 0.02), (40, 0.01), (9, 0.12), (12, 0.15)):
        centre = draw.normal(size=dimensions)
        for _ in range(size):
            scale = float(draw.choice([1e-3, 1, 1e6]))
            rows.append((at, (scale * (centre + noise * draw.normal(size=dimensions))).tolist()))
            at += 1
    rows += [(at + i, rows[5][1]) for i in range(30)] + [rows[7], rows[7], (None, rows[9][1]), (None, rows[9][1])]
    nan, inf = float("nan"), float("inf")
    rows += [(1, None), (2, []), (3, [0.0] * dimensions), (4, [1.0, None]), (5, [nan] * 3), (6, [inf, 1.0]), (7, [0.0] * dimensions)]
    rows += [(None, None), (None, [0.0]), (8, [2.0]), (9, [1.0]), (10, [-1.0]), (11, [1e300, 1e300]), (12, [1e-300, 1e-300])]
    return rows + [(13, [1.0] * 1500), (14, [1.0] * 1499 + [1.5]), (15, [1.0] * 1501)]


def answers(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


@pytest.mark.parametrize("p", [Params(miss=1e-7), Params(miss=1e-7, piece=7, spare_bits=0, least_bits=4)])
def test_links_equal_all_pairs(spark, p):
    rows = cloud()
    names = "vec_id bigint, embedding array<double>, label int, vec int, fit int, node int, copies int, bucket int, key int, h1 int"
    df = spark.createDataFrame([(*r, *[0] * 8) for r in rows], names).repartition(5)
    got = answers(near_vectors(df, p=p))
    assert got == sorted(all_pairs(rows), key=repr)
    assert sum(r[1] for r in got) > 1500


def test_links_of_test_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert answers(near_vectors(df)) == sorted(all_pairs(rows), key=repr)


def test_empty_and_other_types(spark):
    df = spark.createDataFrame([("b", [1, 2]), ("a", [2, 4])], "vec_id string, embedding array<int>")
    assert near_vectors(df.limit(0)).count() == 0
    assert answers(near_vectors(df)) == [("a", 1, "a", True), ("b", 1, "a", False)]


def test_recall_of_pairs_at_the_threshold():
    draw = np.random.default_rng(0)
    p = Params()
    tables, bits = p.shape(50_000)
    a = draw.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = draw.normal(size=a.shape)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * b
    shared = (buckets(a, tables, bits, p.seed) == buckets(b, tables, bits, p.seed)).any(axis=1)
    assert shared.mean() > 0.998


def test_the_chance_to_miss_is_the_same_at_every_size():
    p = Params()
    for n in (1, 10, 10**4, 10**7, 10**10):
        tables, bits = p.shape(n)
        assert 2 ** (bits - p.spare_bits) >= min(n, 2**44) and tables < 1 << 15
        same = (1 - np.arccos(p.cosine) / np.pi) ** bits
        assert (1 - same) ** tables <= p.miss


def test_signs_do_not_depend_on_the_batch():
    x = np.random.default_rng(1).normal(size=(50, 700))
    whole = buckets(x, 9, 11, 3)
    assert (whole == np.concatenate([buckets(x[i : i + 1], 9, 11, 3) for i in range(50)])).all()
    assert hyperplanes._hyperplanes(3, 0, 512, 99).dtype == np.float64
