"""Ranked lexical search with K2-treaps over the grid of terms and documents.

Documents are dealt into shards. A shard's grid has a row per term, a column per document and an impact where the term
occurs; a K2-treap holds it as a quadtree of the cells that are not empty. A cell keeps four bits that say which of its
quarters are not empty and the largest impact inside, as the difference to the cell around it; both are compressed.
Rows are in order of falling document frequency, so that rare terms share cells that are empty nearly everywhere.

An item searches a shard along the rows of its terms. One step halves a range of documents for all these rows at once:
each row moves to the quarter that holds its own half and the half of the documents. The weighted sum of the maxima
bounds the score of every document of the range. The ranges with the best bounds go first, single documents have their
exact score, and a range below the item's best scores so far is never opened.

The impact of a term does not depend on how many documents hold it; that is a weight of the row, looked up per item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from eventloom.llm.columns import discard, staged
from eventloom.llm.words import Words, slices, split_words

#: Bytes between terms: ASCII without letters and digits.
NOT_TERM = np.ones(256, bool)
for _low, _high in (("0", "9"), ("A", "Z"), ("a", "z")):
    NOT_TERM[ord(_low) : ord(_high) + 1] = False
NOT_TERM[0x80:] = False

_COUNT = np.array([bin(m).count("1") for m in range(16)], np.int64)
#: Of each mask, the quarters before each quarter.
_BEFORE = np.array([[_COUNT[m & ((1 << q) - 1)] for q in range(4)] for m in range(16)], np.int64)


@dataclass(frozen=True)
class Params:
    """``shard_tokens`` bounds the text one tree is made from, ``pass_chars`` the items searched for in one pass;
    ``width`` ranges are opened at once, fewer for items of very many terms. None of them changes the result."""

    top: int = 20
    shard_tokens: int = 1_000_000
    width: int = 128
    pass_chars: int = 8_000_000
    held_nodes: int = 8_000_000
    salts: int = 64


def terms_of(column: pa.Array) -> Words:
    return split_words(column, lower=True, between=NOT_TERM)


def _spread(x: np.ndarray) -> np.ndarray:
    """The lower 32 bits with a gap after each."""
    x = x.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555),
    ):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers by byte planes, compressed."""
    planes = np.ascontiguousarray(values.astype(np.uint32).view(np.uint8).reshape(len(values), 4).T)
    return pa.compress(planes, "zstd", asbytes=True)


def _unpack(raw: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, 4 * n, "zstd", asbytes=True) if n else b"", np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).reshape(-1).view(np.int32)


def impacts(tf: np.ndarray, terms: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Of occurrences in documents of ``terms`` terms, in a corpus of ``n_docs`` documents and ``n_terms`` terms."""
    m = 100 - 25 + (25 * terms * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def grow(row: np.ndarray, column: np.ndarray, value: np.ndarray, depth: int) -> tuple[list[int], bytes, bytes]:
    """The tree of the points of a grid with 2 ** depth rows and columns: cells per level, masks and maxima, packed."""
    code = (_spread(row) << np.uint64(1)) | _spread(column)
    order = np.argsort(code)
    code, value = code[order], value[order]
    levels = [value]
    masks = []
    for _ in range(depth):
        parent = code >> np.uint64(2)
        fresh = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
        masks.append(np.bitwise_or.reduceat(np.uint8(1) << (code & np.uint64(3)).astype(np.uint8), fresh))
        value = np.maximum.reduceat(value, fresh)
        levels.append(value)
        code = parent[fresh]
    levels.reverse()
    masks.reverse()
    falls = [levels[0]]
    for above, mask, below in zip(levels, masks, levels[1:], strict=False):
        falls.append(np.repeat(above, _COUNT[mask]) - below)
    flat = np.concatenate(masks)
    return [len(x) for x in levels], pa.compress(flat, "zstd", asbytes=True), _pack(np.concatenate(falls))


class Treap:
    """A tree in memory: cells of all levels in one run, the last cell stands for any empty one."""

    def __init__(self, sizes: list[int], masks: bytes, falls: bytes) -> None:
        self.depth, cells = len(sizes) - 1, sum(sizes)
        inner = cells - sizes[-1]
        self.mask = np.zeros(cells + 1, np.uint8)
        self.mask[:inner] = np.frombuffer(pa.decompress(masks, inner, "zstd", asbytes=True), np.uint8)
        count = _COUNT.astype(np.int8)[self.mask]
        self.child = np.cumsum(count, dtype=np.int32)
        self.child -= count - np.int8(1)
        self.top = np.append(_unpack(falls, cells), np.int32(0))
        low = 0
        for size, below in zip(sizes, sizes[1:], strict=False):
            at = slice(low + size, low + size + below)
            self.top[at] = np.repeat(self.top[low : low + size], count[low : low + size]) - self.top[at]
            low += size
        self.empty = cells

    def opened(self, node: np.ndarray, level: np.ndarray, row: np.ndarray, half: int) -> np.ndarray:
        """For ranges (rows of ``node``) and terms the cells of one half of the range."""
        quarter = 2 * ((row >> (self.depth - 1 - level)[:, None]) & 1) + half
        mask = self.mask[node]
        return np.where((mask >> quarter) & 1, self.child[node] + _BEFORE[mask, quarter], self.empty)

    def best(self, row: np.ndarray, weight: np.ndarray, least: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
        """Columns and scores of what can be among the ``p.top`` best, given the best scores ``least`` found elsewhere.

        All columns that tie with the last of the best are among them.
        """
        width = max(1, min(p.width, p.held_nodes // (8 * len(row))))
        node, level, column = np.zeros((1, len(row)), np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        bound = (self.top[node] * weight).sum(1)
        columns, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        known = np.sort(least)[-p.top :]
        while len(bound):
            # without as many scores as asked for, anything above 0 counts
            floor = max(1, int(known[0])) if len(known) == p.top else 1
            live = bound >= floor
            if not live.all():
                node, level, column, bound = node[live], level[live], column[live], bound[live]
                if not len(bound):
                    break
            if len(bound) > width:
                # the deepest first where too many are held
                order = bound if node.size < p.held_nodes else level * (int(bound.max()) + 1) + bound
                pick = np.argpartition(order, -width)
                rest, pick = pick[:-width], pick[-width:]
            else:
                rest, pick = np.zeros(0, np.int64), np.arange(len(bound))
            halves = [self.opened(node[pick], level[pick], row, half) for half in (0, 1)]
            new = np.concatenate(halves)
            new_bound = (self.top[new] * weight).sum(1)
            new_level = np.tile(level[pick] + 1, 2)
            new_column = np.concatenate([2 * column[pick], 2 * column[pick] + 1])
            leaf = new_level == self.depth
            done = leaf & (new_bound >= floor)
            if done.any():
                columns.append(new_column[done])
                scores.append(new_bound[done])
                known = np.sort(np.concatenate([known, new_bound[done]]))[-p.top :]
            on = ~leaf & (new_bound >= floor)
            node = np.concatenate([node[rest], new[on]])
            level = np.concatenate([level[rest], new_level[on]])
            column = np.concatenate([column[rest], new_column[on]])
            bound = np.concatenate([bound[rest], new_bound[on]])
        columns, scores = np.concatenate(columns), np.concatenate(scores)
        if len(known) == p.top:
            good = scores >= known[0]
            columns, scores = columns[good], scores[good]
        return columns, scores


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            counts = terms_of(part.column("text")).counts
            yield pa.RecordBatch.from_arrays(
                [pa.array([int((counts > 0).sum())]), pa.array([int(counts.sum())])], ["docs", "terms"]
            )


_SHARD = "terms binary, df binary, cells array<int>, masks binary, falls binary"


def _shards(n_docs: int, n_terms: int, p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, hashes, counts = [], [], []

        def flush() -> pa.RecordBatch:
            key, term, sizes = pa.concat_arrays(keys), np.concatenate(hashes), np.concatenate(counts)
            for part in (keys, hashes, counts):
                part.clear()
            vocabulary, number = np.unique(term, return_inverse=True)
            point, tf = np.unique(number * len(sizes) + np.repeat(np.arange(len(sizes)), sizes), return_counts=True)
            row, column = np.divmod(point, len(sizes))
            df = np.bincount(row, minlength=len(vocabulary))
            order = np.argsort(-df, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            depth = max(1, (len(vocabulary) - 1).bit_length(), (len(sizes) - 1).bit_length())
            cells, masks, falls = grow(place[row], column, impacts(tf, sizes[column], n_docs, n_terms), depth)
            return pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array([0, len(key)], pa.int32()), key),
                    pa.array([vocabulary[order].tobytes()], pa.binary()), pa.array([_pack(df[order])], pa.binary()),
                    pa.array([cells], pa.list_(pa.int32())), pa.array([masks], pa.binary()), pa.array([falls], pa.binary()),
                ],
                ["keys", "terms", "df", "cells", "masks", "falls"],
            )

        for batch in batches:
            for part in slices(batch, "text"):
                words = terms_of(part.column("text"))
                full = np.flatnonzero(words.counts)
                if len(full):
                    keys.append(part.column("key").take(pa.array(full)))
                    hashes.append(words.hash)
                    counts.append(words.counts[full])
                if sum(map(len, hashes)) >= p.shard_tokens:
                    yield flush()
        if keys:
            yield flush()

    return run


@dataclass
class Index:
    """A shard per row of ``table``, documents with terms and terms of the whole corpus."""

    table: DataFrame
    n_docs: int
    n_terms: int

    def discard(self) -> None:
        discard(self.table)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", p: Params = Params()) -> Index:
    """Index every document; a NULL text has no terms. Terms are told apart by 64-bit hashes."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    sizes = rows.select("text").mapInArrow(_sizes, "docs bigint, terms bigint").agg(F.sum("docs"), F.sum("terms")).first()
    n_docs, n_terms = (x or 0 for x in sizes)
    table = staged(rows.mapInArrow(_shards(n_docs, n_terms, p), f"keys array<{kind}>, {_SHARD}"), "treaps")
    return Index(table, n_docs, n_terms)


@dataclass
class _Items:
    """The items of a pass: the terms of all, ascending; of each item its numbers among them and how often it has each."""

    ids: list
    terms: np.ndarray
    own: list[np.ndarray]
    times: list[np.ndarray]
    kind: pa.DataType
    weight: np.ndarray | None = None

    @classmethod
    def of(cls, table: pa.Table) -> _Items:
        words = terms_of(table.column("text"))
        terms, number = np.unique(words.hash, return_inverse=True)
        pairs = [np.unique(number[a:b], return_counts=True) for a, b in zip(words.first, words.first[1:], strict=False)]
        return cls(
            table.column("item").to_pylist(), terms, [a for a, _ in pairs], [b for _, b in pairs], table.schema.field("item").type
        )


def _rows_of(shard: dict, terms: np.ndarray) -> np.ndarray:
    """The shard's row of each term, -1 where it has none."""
    known = np.frombuffer(shard["terms"], np.uint64)
    order = np.argsort(known)
    at = np.minimum(np.searchsorted(known, terms, sorter=order), len(known) - 1)
    return np.where(known[order[at]] == terms, order[at], -1)


def _frequencies(items: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = items.value.terms
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for shard in batch.to_pylist():
                df = _unpack(shard["df"], len(shard["terms"]) // 8)
                row = _rows_of(shard, terms)
                total[row >= 0] += df[row[row >= 0]]
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["term", "df"])

    return run


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def _search(items: Broadcast, key: pa.DataType, p: Params):
    def better(found: tuple) -> tuple:
        score, _, doc = found
        return (-score, doc is None, doc if doc is not None else 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = items.value
        best: list[list[tuple]] = [[] for _ in wanted.ids]
        for batch in batches:
            keys = batch.column("keys")
            for i, shard in enumerate(batch.drop_columns(["keys"]).to_pylist()):
                treap, docs = Treap(shard["cells"], shard["masks"], shard["falls"]), keys[i].values
                row_of = _rows_of(shard, wanted.terms)
                for k, (own, times) in enumerate(zip(wanted.own, wanted.times, strict=True)):
                    row, weight = row_of[own], wanted.weight[own] * times
                    use = (row >= 0) & (weight > 0)
                    if not use.any():
                        continue
                    least = np.array([b[0] for b in best[k]], np.int64)
                    columns, scores = treap.best(row[use], weight[use], least, p)
                    if len(columns):
                        new = zip(scores.tolist(), [k] * len(scores), docs.take(pa.array(columns)).to_pylist(), strict=True)
                        best[k] = sorted([*best[k], *new], key=better)[: p.top]
        score, item, doc = zip(*(b for own in best for b in own), strict=True) if any(best) else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(item, pa.int64()), pa.array([wanted.ids[k] for k in item], wanted.kind), pa.array(doc, key),
                pa.array(score, pa.int64()),
            ],
            ["number", "item", "doc", "score"],
        )

    return run


def search(
    index: Index, items: DataFrame, item: str = "item_id", text: str = "text", key: str = "doc_id", p: Params = Params()
) -> DataFrame:
    """Per item and rank: ``item``, ``rank``, ``key`` and ``score`` of its ``p.top`` best documents with a score above 0.

    Equal scores are in order of the key, NULL last. Repeated items are ranked each for itself, repeated documents are
    ranked one by one. Items without terms and items that no document shares a term with give no rows. Items are read
    by the driver and broadcast in passes of bounded size, each of which searches the whole index.
    """
    spark = items.sparkSession
    numbered = staged(
        items.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text"))
        .where("text IS NOT NULL").withColumn("number", F.monotonically_increasing_id()),
        "search-items",
        small=True,
    )
    passes = -(-(numbered.agg(F.sum(F.length("text"))).first()[0] or 0) // p.pass_chars)
    item_kind, key_kind = (numbered.schema["item"].dataType.simpleString(), index.table.schema["keys"].dataType.elementType.simpleString())
    schema = f"number bigint, item {item_kind}, doc {key_kind}, score bigint"
    key_type = spark.createDataFrame([], f"k {key_kind}").toArrow().schema.field("k").type
    found = spark.createDataFrame([], f"pass int, {schema}")
    for turn in range(passes if index.n_docs else 0):
        own = numbered.where(F.pmod(F.xxhash64("number"), F.lit(passes)) == turn)
        wanted = _Items.of(own.select("item", "text").toArrow())
        shared = spark.sparkContext.broadcast(wanted)
        df = np.zeros(len(wanted.terms), np.int64)
        # one row per term of the pass at most
        counts = index.table.select("terms", "df").mapInArrow(_frequencies(shared), "term bigint, df bigint")
        for row in counts.groupBy("term").agg(F.sum("df").alias("df")).collect():
            df[row["term"]] = row["df"]
        wanted.weight = weights(df, index.n_docs)
        shared = spark.sparkContext.broadcast(wanted)
        lean = index.table.select("keys", "terms", "cells", "masks", "falls")
        found = found.unionByName(lean.mapInArrow(_search(shared, key_type, p), schema).withColumn("pass", F.lit(turn)))
    # each task has its own best ones of an item; they meet in two steps, so that no task gets those of all
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    salt = F.pmod(F.xxhash64("doc", F.spark_partition_id()), F.lit(p.salts))
    some = Window.partitionBy("pass", "number", "salt").orderBy(*order)
    every = Window.partitionBy("pass", "number").orderBy(*order)
    few = found.withColumn("salt", salt).withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= p.top)
    return (
        few.withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= p.top)
        .select(F.col("item").alias(item), "rank", F.col("doc").alias(key), "score")
    )


def ranked(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    p: Params = Params(),
) -> DataFrame:
    """``search`` in an index of all ``docs``. An empty table of either kind gives no rows; other columns are ignored."""
    return search(build_index(docs, key, text, p), items, item, item_text, key, p)
