"""Benchmark contamination by greedy string tiling.

A test item and a document that share a run of ``least`` tokens are a candidate. Their longest common runs are then
marked as tiles, longest first, until no unmarked run of ``least`` tokens is shared; a token belongs to one tile at
most and tiles may come in any order, so a passage whose sentences were moved around is covered all the same. The
share of the item's tokens under tiles decides.

Tokens are lower-cased (A-Z) runs without white space and punctuation, compared by their 64-bit hashes. In scripts that
are written without spaces every character is a token. An item with fewer tokens than a tile needs is found where all of
it stands in one run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventloom.llm.columns import boxed, column, unboxed
from eventloom.llm.words import (
    IS_SPACE_OR_MARK,
    Words,
    gram_hashes,
    gram_starts,
    mix,
    range_hashes,
    slices,
    split_words,
    unsigned,
)


#: Code points that separate tokens, beyond ASCII (spaces, punctuation, full-width marks).
_GAPS = (
    (0xA0, 0xA9), (0xAB, 0xB1), (0xB6, 0xB8), (0xBB, 0xBB), (0xBF, 0xBF), (0x2000, 0x206F), (0x3000, 0x3004), (0x3008, 0x3020),
    (0x3030, 0x3030), (0xFE10, 0xFE1F), (0xFE30, 0xFE6F), (0xFF00, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65),
)
#: Blocks of scripts that are written without spaces between words.
_UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1980, 0x19DF), (0x3005, 0x3007), (0x3021, 0x312F), (0x31A0, 0x31BF),
    (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFF66, 0xFF9F),
    (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF),
)


def _among(points: np.ndarray, blocks: tuple[tuple[int, int], ...]) -> np.ndarray:
    low, high = np.array(blocks).T
    at = np.searchsorted(low, points, "right") - 1
    return (at >= 0) & (points <= high[at])


def _apart(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of UTF-8 that separate tokens, and where tokens begin and end within runs of letters."""
    at = np.flatnonzero(data >= 0xC2)
    if not len(at):
        return at, at
    lead = data[at].astype(np.int64)
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    point = lead & np.where(size == 2, 0x1F, np.where(size == 3, 0x0F, 0x07))
    for k in range(1, 4):
        more = size > k
        point[more] = (point[more] << 6) | (data[np.minimum(at[more] + k, len(data) - 1)] & 0x3F)
    gap, alone = _among(point, _GAPS), _among(point, _UNSPACED)
    length = size[gap]
    gaps = np.repeat(at[gap], length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    return gaps, np.concatenate([at[alone], at[alone] + size[alone]])


def tokens_of(column: pa.Array) -> Words:
    return split_words(column, lower=True, between=IS_SPACE_OR_MARK, apart=_apart)


@dataclass(frozen=True)
class Params:
    """``least``: tokens of the shortest tile. ``coverage``: share of an item's tokens that makes a document
    contaminated. ``pass_chars`` bounds the test texts a task holds; a larger benchmark takes several passes."""

    least: int = 5
    coverage: float = 0.6
    first_length: int = 32
    pass_chars: int = 32_000_000


def _runs_of(hashes: np.ndarray, free: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and Karp-Rabin hashes of the windows of ``length`` tokens that hold no marked token."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    at = np.flatnonzero(taken[length:] == taken[:-length])
    return at, range_hashes(hashes, at, at + length)


def tiles(item: np.ndarray, doc: np.ndarray, p: Params) -> list[tuple[int, int, int]]:
    """Tiles as (place in the item, place in the document, length), found longest first.

    The search length starts high. Whenever a run more than twice as long turns up, the search starts over at that
    length; when a length yields nothing more it is halved, down to ``p.least``.
    """
    free_a, free_b = np.ones(len(item), bool), np.ones(len(doc), bool)
    out: list[tuple[int, int, int]] = []
    length = max(p.least, min(p.first_length, len(item)))
    while True:
        at_b, hash_b = _runs_of(doc, free_b, length)
        places: dict[int, list[int]] = {}
        at_a, hash_a = _runs_of(item, free_a, length)
        shared = np.isin(hash_b, hash_a)
        for h, b in zip(hash_b[shared].tolist(), at_b[shared].tolist(), strict=True):
            places.setdefault(h, []).append(b)
        found = []
        for h, a in zip(hash_a.tolist(), at_a.tolist(), strict=True):
            for b in places.get(h, ()):
                if a and b and free_a[a - 1] and free_b[b - 1] and item[a - 1] == doc[b - 1]:
                    continue  # part of a run that began earlier
                end = length
                while (
                    a + end < len(item)
                    and b + end < len(doc)
                    and free_a[a + end]
                    and free_b[b + end]
                    and item[a + end] == doc[b + end]
                ):
                    end += 1
                found.append((end, a, b))
        if found and max(found)[0] > 2 * length:
            length = max(found)[0]
            continue
        marked = False
        for end, a, b in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
            if free_a[a : a + end].all() and free_b[b : b + end].all():
                free_a[a : a + end] = free_b[b : b + end] = False
                out.append((a, b, end))
                marked = True
        if marked:
            continue  # what a longer tile cut off may still hold a run of this length
        if length == p.least:
            return out
        length = max(p.least, length // 2)


class _Items:
    """The test items of one pass and an index of their seeds."""

    def __init__(self, ids: list, words: Words, p: Params) -> None:
        self.ids, self.first, self.hash = ids, words.first, words.hash
        starts = gram_starts(words, p.least)
        seeds = gram_hashes(words.hash, p.least)[starts]
        owner = words.text_of[starts]
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.owner = seeds[order], owner[order]
        # most grams of a document are no seed; a small table tells without a search
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.seeds >> np.uint64(44)] = True
        # items too short for a seed, by their number of tokens: hash of all of it, and the item
        counts = words.counts
        self.short = {}
        for size in np.unique(counts[(counts > 0) & (counts < p.least)]).tolist():
            items = np.flatnonzero(counts == size)
            whole = range_hashes(words.hash, words.first[items], words.first[items] + size)
            order = np.argsort(whole, kind="stable")
            self.short[size] = whole[order], items[order]

    def tokens(self, k: int) -> np.ndarray:
        return self.hash[self.first[k] : self.first[k + 1]]


def _short_runs(words: Words, items: _Items) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """Text, item and the one tile of every short item that a text holds, at its first place."""
    for size, (whole, owner) in items.short.items():
        at = gram_starts(words, size)
        grams = gram_hashes(words.hash, size)[at]
        lo, hi = np.searchsorted(whole, grams, "left"), np.searchsorted(whole, grams, "right")
        hit = hi > lo
        text, run = words.text_of[at[hit]], lo[hit]
        _, first = np.unique(np.stack([text, run]), axis=1, return_index=True)
        for k in first.tolist():
            place = int(at[hit][k] - words.first[text[k]])
            for item in owner[run[k] : hi[hit][k]].tolist():
                yield int(text[k]), item, [(0, place, size)]


def _covered(words: Words, items: _Items, p: Params) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """Text, item and tiles of every pair that shares a seed. A tile lies where seeds of its item are, so only these
    places of a document are tiled."""
    yield from _short_runs(words, items)
    at = gram_starts(words, p.least)
    grams = gram_hashes(words.hash, p.least)[at]
    likely = items.maybe[grams >> np.uint64(44)]
    at, grams = at[likely], grams[likely]
    lo = np.searchsorted(items.seeds, grams, "left")
    hi = np.searchsorted(items.seeds, grams, "right")
    hit = hi > lo
    at, lo, hi = at[hit], lo[hit], hi[hit]
    if not len(at):
        return
    text = words.text_of[at]
    reach = hi - lo
    spread = np.repeat(lo - (np.cumsum(reach) - reach), reach) + np.arange(reach.sum())
    triples = np.unique(
        np.stack([np.repeat(text, reach), items.owner[spread], np.repeat(at, reach)]), axis=1
    )
    text, item, at = triples
    edges = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (item[1:] != item[:-1])))
    for begin, end in zip(edges, np.append(edges[1:], len(text)), strict=True):
        place = np.unique(at[begin:end, None] + np.arange(p.least))
        # places apart are kept apart by a token that nothing equals
        gaps = np.flatnonzero(np.diff(place) > 1) + 1
        doc = np.insert(words.hash[place], gaps, mix(np.arange(len(gaps), dtype=np.uint64) + np.uint64(1 << 63)))
        k = int(item[begin])
        yield int(text[begin]), k, tiles(items.tokens(k), doc, p)


PAIRS = "item_id {item}, item_tokens bigint, covered bigint, tiles bigint, longest bigint, coverage double"


def _passes(benchmark: DataFrame, item: str, text: str, p: Params):
    """The benchmark in parts whose texts have a bounded length, each read by the driver and broadcast."""
    spark = benchmark.sparkSession
    total = benchmark.agg(F.sum(F.length(text))).first()[0] or 0
    parts = -(-total // p.pass_chars)
    for part in range(parts):
        rows = benchmark.where(F.pmod(F.xxhash64(F.col(item), F.col(text)), F.lit(parts)) == part)
        table = rows.select(F.col(item).alias("item"), F.col(text).alias("text")).where("text IS NOT NULL").toArrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        yield spark.sparkContext.broadcast(sink.getvalue().to_pybytes())


def _load(raw: bytes, p: Params) -> tuple[_Items, pa.Array]:
    table = pa.ipc.open_stream(raw).read_all().combine_chunks()
    ids = table.column("item").combine_chunks() if table.num_rows else table.column("item")
    words = tokens_of(table.column("text"))
    return _Items(ids.to_pylist(), words, p), ids.type


def _pairs(shared, key: str, text: str, p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, kind = _load(shared.value, p)
        for batch in batches:
            for part in slices(batch, text):
                words = tokens_of(part.column(text))
                rows, out = [], []
                for row, k, found in _covered(words, items, p):
                    covered, size = sum(t[2] for t in found), len(items.tokens(k))
                    rows.append(row)
                    out.append((items.ids[k], size, covered, len(found), max(t[2] for t in found), covered / size))
                if rows:
                    columns = list(zip(*out, strict=True))
                    kinds = [kind, *[pa.int64()] * 4, pa.float64()]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(key).take(pa.array(rows))]
                        + [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                        [key, "item_id", "item_tokens", "covered", "tiles", "longest", "coverage"],
                    )

    return run


def covered_items(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    p: Params = Params(),
) -> DataFrame:
    """One row per document and test item that share a tile: tokens of the item, those covered, tiles, longest tile.

    The whole documents are searched. NULL texts share nothing; an item with fewer than ``p.least`` tokens is covered by
    a document that holds all of them in one run, which a very short one may owe to chance; an item without tokens is
    never covered. Repeated documents or items give repeated rows. Empty tables give no rows.
    """
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kinds = benchmark.schema[item].dataType.simpleString()
    schema = f"key {docs.schema[key].dataType.simpleString()}, {PAIRS.format(item=kinds)}"
    out = docs.sparkSession.createDataFrame([], schema)
    for shared in _passes(benchmark, item, item_text, p):
        out = out.unionByName(narrow.mapInArrow(_pairs(shared, "key", "text", p), schema))
    return out.withColumnRenamed("key", key)


def contaminated(*args, p: Params = Params(), **kwargs) -> DataFrame:
    """The rows of ``covered_items`` whose coverage reaches the threshold."""
    return covered_items(*args, p=p, **kwargs).where(F.col("coverage") >= p.coverage)


def _clean(shared, text: str, p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, _ = _load(shared.value, p)
        for batch in batches:
            for part in slices(batch, text):
                words = tokens_of(part.column(text))
                keep = np.ones(part.num_rows, bool)
                for row, k, found in _covered(words, items, p):
                    if sum(t[2] for t in found) >= p.coverage * len(items.tokens(k)):
                        keep[row] = False
                yield part.filter(pa.array(keep))

    return run


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", p: Params = Params()
) -> DataFrame:
    """``docs`` without the rows whose text covers a test item; all columns stay. Cases as in ``covered_items``."""
    rows = boxed(docs, text, text=F.col(text))
    for shared in _passes(benchmark.withColumn("__item", F.lit(0)), "__item", item_text, p):
        rows = rows.mapInArrow(_clean(shared, "text", p), rows.schema)
    return unboxed(rows, F.col("text").alias(text)).select(*(column(c) for c in docs.columns))
