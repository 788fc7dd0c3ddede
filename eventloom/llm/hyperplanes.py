"""Near-duplicate vectors by random-hyperplane signs, exact cosines and connected components.

A hyperplane through the origin tells two vectors at angle t apart with probability t / pi. A table's bucket is the
signs of a vector at some hyperplanes of its own; vectors that share a bucket of any table are compared exactly.

1. Vectors that are equal component by component form one class, and classes are what is compared.
2. The number of signs grows with the logarithm of the number of classes, so a bucket of unrelated vectors stays small;
   the number of tables follows from it and the chance to miss a link, which is the same at every size.
3. Buckets are counted before any vector moves; vectors go to the buckets that hold two or more.
4. A large bucket is compared in pieces of bounded size, each pair of pieces in a group of its own. A pair counts in the
   first table where it shares a bucket, so no pair is counted twice and none has to be made distinct. A group reports
   the number of links of its members and a star for each of its components, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eventloom.llm.columns import discard, staged
from eventloom.llm.components import components

_TABLE_SHIFT = 48
_DIMENSIONS_AT_ONCE = 512
_ROWS_AT_ONCE = 1000
#: Groups up to this size have their pairs listed together, larger ones are matrix products.
_SMALL = 8


@dataclass(frozen=True)
class Params:
    """``miss``: chance that a pair exactly at ``cosine`` shares no bucket; closer pairs are missed far less often.
    ``spare_bits``: there are 2 ** spare_bits buckets a table for each class, so few unrelated vectors meet. ``piece``
    bounds the vectors of one comparison, not what is compared."""

    cosine: float = 0.95
    miss: float = 1e-4
    spare_bits: int = 4
    least_bits: int = 8
    piece: int = 1000
    seed: int = 12

    def shape(self, n: int) -> tuple[int, int]:
        """Tables, and signs per table, for ``n`` classes."""
        bits = min(_TABLE_SHIFT, max(self.least_bits, max(n - 1, 1).bit_length() + self.spare_bits))
        same = (1 - math.acos(self.cosine) / math.pi) ** bits
        return math.ceil(math.log(self.miss) / math.log1p(-same)), bits


@lru_cache(maxsize=4)
def _hyperplanes(seed: int, part: int, dimensions: int, columns: int) -> np.ndarray:
    """Normal vectors with whole components up to 2 ** 15 in ``columns``, for a run of dimensions."""
    draw = np.random.Generator(np.random.PCG64([seed, part])).standard_normal((dimensions, columns))
    return np.rint(np.clip(draw, -7.9, 7.9) * (1 << 12))


def buckets(vectors: np.ndarray, tables: int, bits: int, seed: int) -> np.ndarray:
    """Bucket of each vector in each table: number of the table and signs.

    Components become whole numbers small enough that all sums are exact, so a vector has the same signs in any batch.
    """
    n, dimensions = vectors.shape
    scale = min(24, 37 - dimensions.bit_length())
    out = np.empty((n, tables), np.int64)
    powers = np.int64(1) << np.arange(bits, dtype=np.int64)
    for at in range(0, n, _ROWS_AT_ONCE):
        rows = vectors[at : at + _ROWS_AT_ONCE]
        whole = np.rint(rows / np.abs(rows).max(axis=1, keepdims=True) * (1 << scale))
        side = np.zeros((len(rows), tables * bits))
        for part, low in enumerate(range(0, dimensions, _DIMENSIONS_AT_ONCE)):
            cut = whole[:, low : low + _DIMENSIONS_AT_ONCE]
            side += cut @ _hyperplanes(seed, part, cut.shape[1], tables * bits)
        out[at : at + len(rows)] = (side >= 0).reshape(len(rows), tables, bits) @ powers
    return out | (np.arange(tables, dtype=np.int64) << _TABLE_SHIFT)


def _matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors by dimension: their places in the column and a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(column.offsets.to_numpy())
    starts = np.cumsum(sizes) - sizes
    for dimensions in np.unique(sizes):
        at = np.flatnonzero(sizes == dimensions)
        yield at, flat[starts[at, None] + np.arange(dimensions)]


def _coder(p: Params, tables: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, vectors in _matrices(batch.column("vec")):
                codes = buckets(vectors, tables, bits, p.seed)
                nodes = batch.column("node").to_numpy()[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(nodes),
                        pa.ListArray.from_arrays(np.arange(0, codes.size + 1, tables, dtype=np.int32), codes.reshape(-1)),
                    ],
                    ["node", "buckets"],
                )

    return run


def _directions(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _first_meetings(a: np.ndarray, b: np.ndarray, codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which pairs of rows share no bucket of a table before their own."""
    left = np.arange(len(a))
    for t in range(int(table.max(initial=0))):
        early = table[left] > t
        met = early & (codes[a[left], t] == codes[b[left], t])
        left = left[~met]
        if not len(left):
            break
    return left


def _pairs_of_group(unit: np.ndarray, piece: np.ndarray, base: int, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked pairs of one group: of its one piece, or between its two."""
    split = int(np.searchsorted(piece, piece[0], "right"))
    if split == len(piece):
        a, b = np.nonzero(np.triu(unit @ unit.T >= p.cosine, 1))
        return a + base, b + base
    a, b = np.nonzero(unit[:split] @ unit[split:].T >= p.cosine)
    return a + base, b + base + split


def _linked(unit: np.ndarray, start: np.ndarray, piece: np.ndarray, alone: np.ndarray, p: Params):
    """Linked pairs of all groups, in runs of bounded size. ``start`` has the groups' first rows, and the end.

    ``alone`` says of each group whether one piece is compared with itself.
    """
    sizes = np.diff(start)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size in range(2, _SMALL + 1):
        of = start[:-1][(sizes == size) & alone]
        i, j = np.triu_indices(size, 1)
        a.append((of[:, None] + i).reshape(-1))
        b.append((of[:, None] + j).reshape(-1))
    a, b = np.concatenate(a), np.concatenate(b)
    for at in range(0, len(a), 1 << 16):
        x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
        near = np.einsum("ij,ij->i", unit[x], unit[y]) >= p.cosine
        yield x[near], y[near]
    for g in np.flatnonzero((sizes > 1) & ((sizes > _SMALL) | ~alone)):
        low, high = start[g], start[g + 1]
        own = piece[low:high]
        if alone[g] or own[0] != own[-1]:
            yield _pairs_of_group(unit[low:high], own, low, p)


def _stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each row is connected with."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _compare(table: pa.Table, p: Params, tables: int, bits: int) -> Iterator[pa.RecordBatch]:
    """All links of whole groups; ``table`` is sorted by group."""
    table = table.combine_chunks()
    for at, vectors in _matrices(table.column("vec").combine_chunks() if table.num_rows else table.column("vec")):
        rows = table.select(["bucket", "lo", "hi", "piece", "node", "copies"]).take(pa.array(at))
        bucket, lo, hi, piece, node, copies = (c.to_numpy() for c in rows.columns)
        order = np.lexsort((piece, hi, lo, bucket))
        bucket, lo, hi, piece, node, copies = (c[order] for c in (bucket, lo, hi, piece, node, copies))
        vectors = vectors[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (bucket[1:] != bucket[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
        begins = np.flatnonzero(fresh)
        unit = _directions(vectors)
        codes = np.zeros((len(order), tables), np.int64)
        known = np.zeros(len(order), bool)
        links = np.zeros(len(order), np.int64)
        for a, b in _linked(unit, np.append(begins, len(order)), piece, lo[begins] == hi[begins], p):
            new = np.unique(np.concatenate([a, b]))
            new = new[~known[new]]
            if len(new):
                codes[new] = buckets(vectors[new], tables, bits, p.seed)
                known[new] = True
            first = _first_meetings(a, b, codes, bucket[a] >> _TABLE_SHIFT)
            a, b = a[first], b[first]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            touched, place = np.unique(np.concatenate([a, b]), return_inverse=True)
            star = touched[_stars(len(touched), *np.split(place, 2))]
            far = star != touched
            yield _found(node[touched[far]], node[star[far]], None)
        counted = np.flatnonzero(links)
        yield _found(node[counted], None, links[counted])


def _found(a: np.ndarray, b: np.ndarray | None, links: np.ndarray | None) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(a), none if b is None else pa.array(b), none if links is None else pa.array(links)], ["a", "b", "links"]
    )


def _comparer(p: Params, tables: int, bits: int):
    """A partition's groups as they come, so many at once that their vectors fill a batch or two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy() for c in ("bucket", "lo", "hi")]
            same = np.logical_and.reduce([k == k[-1] for k in keys])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if held and cut == 0:
                last = held[-1]
                if any(last.column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in ("bucket", "lo", "hi")):
                    yield from _compare(pa.Table.from_batches(held), p, tables, bits)
                    held = []
                held.append(batch)
                continue
            if cut:
                held.append(batch.slice(0, cut))
                yield from _compare(pa.Table.from_batches(held), p, tables, bits)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from _compare(pa.Table.from_batches(held), p, tables, bits)

    return run


def _usable(vec: Column) -> Column:
    """Whether a vector has a direction."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def near_vectors(docs: DataFrame, key: str = "vec_id", vec: str = "embedding", p: Params = Params()) -> DataFrame:
    """Per row ``key``, ``n_links``, ``component_id`` and ``kept``.

    Rows are linked if their vectors' cosine, in doubles, is ``p.cosine`` or more and they share a bucket. ``n_links``
    counts the other rows a row is linked with, ``component_id`` is the smallest key that links reach, and kept is a row
    whose key is its component's. A vector that is NULL, empty or zero or has a NULL or non-finite component is linked
    with nothing, nor are vectors of different length. Repeated rows are rows of their own, linked with each other. A
    NULL key names no component unless all of its keys are NULL, and such a row is not kept unless it has another key.
    An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(vec).alias("vec"))
    if docs.schema[vec].dataType.simpleString() not in ("array<float>", "array<double>"):
        rows = rows.withColumn("vec", F.col("vec").cast("array<double>"))
    rows = rows.withColumns(
        {"fit": _usable(F.col("vec")), "h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(1), F.col("vec"))}
    )
    # numbers are given as the table is written, so they last
    classes = staged(
        rows.where("fit").groupBy("h1", "h2")
        .agg(F.min("key").alias("first_key"), F.count("*").alias("copies"), F.any_value("vec").alias("vec"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vector-classes",
    )
    tables, bits = p.shape(classes.count())
    coded = classes.select("node", "vec").mapInArrow(_coder(p, tables, bits), "node bigint, buckets array<bigint>")
    placed = coded.select("node", F.explode("buckets").alias("bucket"))
    crowded = staged(
        placed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        .select(F.col("bucket").alias("at"), F.ceil(F.col("n") / p.piece).cast("int").alias("pieces")),
        "vector-buckets",
    )
    # plain exchanges on both sides, so Spark can split a bucket that very many vectors share
    members = placed.join(crowded, F.col("bucket") == F.col("at")).select(
        F.col("node").alias("member"), "bucket", "pieces", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int").alias("piece")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other")
    grouped = (
        members.join(classes.select("node", "copies", "vec"), F.col("member") == F.col("node"))
        .select("bucket", "piece", "node", "copies", "vec", other)
        .select("bucket", F.least("piece", "other").alias("lo"), F.greatest("piece", "other").alias("hi"), "piece", "node", "copies", "vec")
        .repartition("bucket", "lo", "hi")
        .sortWithinPartitions("bucket", "lo", "hi")
    )
    found = staged(
        grouped.mapInArrow(_comparer(p, tables, bits), "a bigint, b bigint, links bigint"), "vector-links"
    )
    labels = components(found.where("b IS NOT NULL"), "a", "b")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("of")).agg(F.sum("links").alias("links"))
    known = classes.select("h1", "h2", "first_key", "copies", "node")
    named = (
        known.join(labels.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left")
        .join(counts, F.col("node") == F.col("of"), "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    lowest = named.groupBy(F.col("label").alias("group")).agg(F.min("first_key").alias("component_id"))
    told = staged(
        named.join(lowest, F.col("label") == F.col("group")).select(
            F.col("h1").alias("c1"), F.col("h2").alias("c2"), "component_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "vector-components",
    )
    discard(crowded, found, labels, classes)
    linked = rows.where("fit").select("key", "h1", "h2").join(told, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")))
    alone = rows.where("NOT fit").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return (
        linked.select("key", "n_links", "component_id").unionByName(alone)
        .withColumn("kept", F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)))
        .withColumnRenamed("key", key)
    )
