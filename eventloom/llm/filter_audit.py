"""How filters interact: what each one removes, by the order in which they run.

Every document gets one failure bit per filter. Per part the documents are counted by their five bits, which makes a
contingency tensor of shape 2 x 2 x 2 x 2 x 2 (index 0: pass, 1: fail). What a step of an order keeps or removes is a
contraction of that tensor: along each axis the filters that ran earlier select pass, the filter of the step pass or
fail, and those that did not run yet select both. So all 120 orders cost the documents one pass, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from eventloom.llm.columns import discard, staged
from eventloom.llm.words import slices, split_words

FILTERS = "ABCDE"
CELLS = 1 << len(FILTERS)
MARKS = b"#$%&*|"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT = 200, 50, 2
PASS, FAIL, BOTH = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
#: Parts whose tensors are contracted at once.
PARTS_AT_ONCE = 64

_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(MARKS)] = True
_IS_CAPITAL = np.zeros(256, bool)
_IS_CAPITAL[ord("A") : ord("Z") + 1] = True
#: Bytes that begin a code point in UTF-8.
_BEGINS = np.ones(256, bool)
_BEGINS[0x80:0xC0] = False


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[bounds[1:]] - total[bounds[:-1]]


def text_failures(column: pa.Array) -> np.ndarray:
    """Bits A to D of each text (NULL: empty). Words are told apart by 64-bit hashes within their text."""
    words = split_words(column)
    counts = words.counts
    order = np.lexsort((words.hash, words.text_of))
    owner, value = words.text_of[order], words.hash[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    distinct = np.bincount(owner[fresh], minlength=len(counts))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    chars, capitals, marks = (_per_text(table[words.data], bounds) for table in (_BEGINS, _IS_CAPITAL, _IS_MARK))
    failed = [
        counts < LEAST_WORDS,
        100 * distinct < LEAST_DISTINCT_PERCENT * counts,
        100 * capitals > MOST_CAPITALS_PERCENT * chars,
        marks > 0,
    ]
    return sum(f.astype(np.int32) << k for k, f in enumerate(failed))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in ("key", "part", "h1", "h2")] + [pa.array(text_failures(part.column("text")), pa.int32())],
                ["key", "part", "h1", "h2", "failed"],
            )


def judged(docs: DataFrame, text: str = "text", key: str = "doc_id", part: str = "source") -> DataFrame:
    """Per row ``key``, ``part`` and ``failed``, whose bit k is set if filter k of ``FILTERS`` fails.

    Filter E fails for every row whose text (NULL: empty) a smaller key has. Texts are told apart by 128 bits of hash.
    Only the hashes meet: the smallest key of each text is found by partial aggregation, and a row is the first of its
    text if hashes and key are those, which spreads the copies of a text over all tasks. A NULL key has no smaller one.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(1), body).alias("h2"), body.alias("text"),
    )
    kind = docs.schema[key].dataType.simpleString()
    bits = staged(rows.mapInArrow(_judge, f"key {kind}, part string, h1 bigint, h2 bigint, failed int"), "filter-bits")
    first = (
        bits.groupBy("h1", "h2").agg(F.min("key").alias("first"))
        .where("first IS NOT NULL").withColumnsRenamed({"h1": "f1", "h2": "f2"})
    )
    same = (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")) & (F.col("key") == F.col("first"))
    copy = F.col("first").isNull() & F.col("key").isNotNull()
    # rows that agree in all of this are counted where they are read, so that repeated rows do not meet either
    narrow = bits.groupBy(*bits.columns).agg(F.count("*").alias("times"))
    out = narrow.join(first, same, "left").select(
        "key", "part", F.col("failed").bitwiseOR(F.when(copy, 1 << 4).otherwise(0)).alias("failed"), "times"
    )
    out.staged_folder = bits.staged_folder
    return out


def contingency(judged_docs: DataFrame, labels: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """Per part ``cells``: for each combination of bits that occurs, the documents (``n``), the good and the toxic ones.

    ``labels`` has ``key``, ``quality`` and ``toxic`` (1: yes) for some documents; a key with several rows is good or
    toxic if one of them says so.
    """
    if labels is None:
        known = judged_docs.withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    else:
        flag = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)
        marks = labels.groupBy(F.col(key).alias("__key")).agg(flag("quality"), flag("toxic"))
        known = judged_docs.join(marks, F.col("key") == F.col("__key"), "left").withColumn("good", F.col("quality"))
    times = lambda c: F.sum(F.when(F.col(c) == 1, F.col("times")).otherwise(0))
    cells = known.groupBy("part", "failed").agg(
        F.sum("times").alias("n"), times("good").alias("good"), times("toxic").alias("toxic")
    )
    # at most CELLS entries for a part
    return cells.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))


def orders() -> list[tuple[int, ...]]:
    return list(permutations(range(len(FILTERS))))


def _selections(last: np.ndarray) -> np.ndarray:
    """One row per order and step, one of PASS, FAIL and BOTH per axis: ``last`` for the filter of the step."""
    out = np.empty((len(orders()) * len(FILTERS), len(FILTERS), 2), np.int64)
    out[:] = BOTH
    at = 0
    for order in orders():
        for step, axis in enumerate(order):
            out[at, list(order[:step])] = PASS
            out[at, axis] = last
            at += 1
    return out


def contracted(tensors: np.ndarray, selections: np.ndarray) -> np.ndarray:
    """``tensors`` (parts, kinds, 2, 2, 2, 2, 2) under each selection: (parts, kinds, selections).

    Many steps select the same, so the distinct selections are contracted, axis by axis.
    """
    distinct, back = np.unique(selections.reshape(len(selections), -1), axis=0, return_inverse=True)
    picks = distinct.reshape(len(distinct), len(FILTERS), 2)
    left = np.einsum("pkabcde,sa->pksbcde", tensors, picks[:, 0])
    for axis in range(1, len(FILTERS)):
        left = np.einsum("pksx...,sx->pks...", left, picks[:, axis])
    return left[:, :, back.reshape(-1)]


def steps_of(tensors: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every order and step: arrays of shape (parts, orders times steps)."""
    n = len(FILTERS)
    filter_of = np.array(orders()).reshape(-1)
    kept = contracted(tensors[:, :1], _selections(PASS))[:, 0]
    removed, good, toxic = np.moveaxis(contracted(tensors, _selections(FAIL)), 1, 0)
    alone = np.stack([np.where(np.arange(n)[:, None] == axis, FAIL, BOTH) for axis in range(n)])
    only = np.stack([np.where(np.arange(n)[:, None] == axis, FAIL, PASS) for axis in range(n)])
    fails = contracted(tensors[:, :1], alone)[:, 0]
    unique = contracted(tensors[:, :1], only)[:, 0]
    by_filter = np.zeros((len(tensors), n), np.int64)
    np.add.at(by_filter, (slice(None), filter_of), removed)
    return {
        "kept": kept,
        "removed": removed,
        "redundant": fails[:, filter_of] - removed,
        "unique_fails": unique[:, filter_of],
        "good_lost": good,
        "toxic_lost": toxic,
        "shapley": by_filter[:, filter_of],
    }


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _tabulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["".join(FILTERS[k] for k in order) for order in orders()]
    order_column = [name for name in names for _ in FILTERS]
    step_column = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(names))
    for batch in batches:
        for at in range(0, batch.num_rows, PARTS_AT_ONCE):
            rows = batch.slice(at, PARTS_AT_ONCE).to_pylist()
            flat = np.zeros((len(rows), 3, CELLS), np.int64)
            for i, row in enumerate(rows):
                for cell in row["cells"]:
                    flat[i, :, cell["failed"]] = cell["n"], cell["good"], cell["toxic"]
            # bit k of a cell is axis k: the lowest bit varies fastest, so axes come out reversed
            tensors = flat.reshape(len(rows), 3, *[2] * len(FILTERS)).transpose(0, 1, 6, 5, 4, 3, 2)
            counts = steps_of(tensors)
            for i, row in enumerate(rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(order_column), pa.string()), pa.array(order_column), pa.array(step_column)]
                    + [pa.array(counts[name][i], pa.int64()) for name in COUNTS],
                    ["part", "filter_order", "step", *COUNTS],
                )


def audit(
    docs: DataFrame,
    labels: DataFrame | None = None,
    text: str = "text",
    key: str = "doc_id",
    part: str = "source",
    label_key: str = "doc_id",
) -> DataFrame:
    """One row per part, order of the filters and step: what the step keeps and removes, and what it removes in vain.

    ``kept``: documents left after the step; ``removed``: by it; ``redundant``: they fail its filter but went earlier;
    ``unique_fails``: they fail its filter only; ``good_lost`` and ``toxic_lost``: removed here, with that label;
    ``shapley``: what its filter removes, summed over all orders.

    A NULL text is empty, a NULL part the part of the empty string, which holds empty strings too. Repeated rows are
    documents of their own that share their key, so neither is a copy of the other. Parts without rows do not appear;
    an empty table gives no rows. Other columns are ignored, whatever their names.
    """
    narrow = docs.select(F.col(key).alias("key"), F.col(part).alias("part"), F.col(text).alias("text"))
    bits = judged(narrow, "text", "key", "part")
    tables = contingency(bits, labels, label_key)
    done = staged(tables, "filter-cells")
    discard(bits)
    schema = "part string, filter_order string, step int, " + ", ".join(f"{name} bigint" for name in COUNTS)
    return done.mapInArrow(_tabulate, schema)
