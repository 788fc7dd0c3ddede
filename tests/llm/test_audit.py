"""Filter audit on small tables against a plain run of every order."""

import itertools
import re

import numpy as np

from eventloom.llm import filter_audit
from tests.llm.brute import words

COLUMNS = ["part", "filter_order", "step", *filter_audit.COUNTS]


def failures(rows):
    """rows: (id, text, part); the set of filters that each row fails."""
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    out = []
    for d, t, _ in rows:
        ws, t = words(t), t or ""
        out.append({
            name for name, hit in {
                "A": len(ws) < 200, "B": 100 * len(set(ws)) < 50 * len(ws), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                "D": re.search(r"[#$%&*|]", t), "E": d is not None and d > least[t],
            }.items() if hit
        })
    return out


def plain(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    fails, out, shapley = failures(rows), [], {}
    for part in {p or "" for _, _, p in rows}:
        mine = [(d, f) for (d, _, p), f in zip(rows, fails) if (p or "") == part]
        for order in itertools.permutations("ABCDE"):
            left, gone = mine, []
            for step, x in enumerate(order, 1):
                lost = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                out.append([
                    part, "".join(order), step, len(left), len(lost), sum(x in f for _, f in gone),
                    sum(f == {x} for _, f in mine), sum(d in good for d, _ in lost), sum(d in toxic for d, _ in lost),
                ])
                gone += lost
                shapley[part, x] = shapley.get((part, x), 0) + len(lost)
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


LONG = " ".join(f"w{i}" for i in range(300))
ROWS = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, LONG, ""), (5, LONG, "a"), (5, LONG, "a"), (6, LONG, "b"), (None, LONG, "b"),
    (None, "x # y", None), (7, "same " * 250, "b"), (8, "AB c " * 150, "b"), (9, LONG + " &", "a"), (10, LONG.upper(), "a"),
    (11, "é" * 100000, "b"), (12, LONG + " | " + LONG.upper(), "b"), (13, "À É " * 120, "c"), (2, "other", "c"), (14, "AÉ" + "é" * 48, "c"),
    (15, "A" + "é" * 49, "c"), (0, "A" + "é" * 49, "a"), (16, "a b " * 199 + "c", "c"), (17, " ".join(["a b c d"] * 50), "c"),
]
LABELS = [(1, 1, 0), (4, 1, 1), (5, 1, 0), (6, 0, 1), (6, 1, 0), (8, None, 1), (None, 1, 1), (99, 1, 1), (10, 1, None)]


def test_audit_equals_the_plain_run(spark):
    names = "doc_id bigint, text string, source string, part string, failed int, h1 int, times int, n int, first int, __key int"
    docs = spark.createDataFrame([(*r, "z", 7, 7, 7, 7, 7, 7) for r in ROWS], names).repartition(4)
    labels = spark.createDataFrame(
        [(*r, 5, 6) for r in LABELS], "doc_id bigint, quality int, toxic int, part int, times int"
    )
    got = sorted(tuple(r[c] for c in COLUMNS) for r in filter_audit.audit(docs, labels).collect())
    assert got == plain(ROWS, LABELS)


def test_audit_of_test_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = sorted(tuple(r[c] for c in COLUMNS) for r in filter_audit.audit(docs, labels).collect())
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    assert got == plain(rows, [(r["doc_id"], r["quality"], r["toxic"]) for r in labels.collect()])


def test_empty_tables_and_other_key_types(spark):
    docs = spark.createDataFrame([("b", "x", "p"), ("a", "x", "p")], "doc_id string, text string, source string")
    assert filter_audit.audit(docs.limit(0), docs.limit(0).selectExpr("doc_id", "1 AS quality", "1 AS toxic")).count() == 0
    first = {r["step"]: r for r in filter_audit.audit(docs).where("filter_order = 'EABCD'").collect()}
    assert (first[1]["kept"], first[1]["removed"], first[2]["removed"]) == (1, 1, 1)


def test_a_step_is_a_contraction():
    tensor = np.random.default_rng(1).integers(0, 9, (3, 3, 2, 2, 2, 2, 2))
    counts = filter_audit.steps_of(tensor)
    at = [i for i, o in enumerate(filter_audit.orders()) if o == (1, 4, 0, 2, 3)][0] * 5 + 2
    assert (counts["removed"][:, at] == tensor[:, 0, 1, 0, :, :, 0].sum((1, 2))).all()
    assert (counts["unique_fails"][:, at] == tensor[:, 0, 1, 0, 0, 0, 0]).all()
    assert (counts["shapley"].reshape(3, -1, 5).sum(2) > 0).all()
