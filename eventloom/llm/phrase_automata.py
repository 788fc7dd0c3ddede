"""Substring dedup: repeated passages confirmed by counting, located by Aho-Corasick automata.

A window is ``Params.window`` consecutive words. Two equal windows share the same smallest gram (their anchor, a run of
``gram`` words), so

1. every text reports its anchors, one for about every fourteen words, and anchors that occur once are dropped;
2. texts are cut to the passages around shared anchors, and these are dealt into blocks of bounded size; windows are
   counted, block by block and then over all blocks: those found twice are repeated, and their blocks are known;
3. each repeated window is taken from one of its places; neighbouring windows form phrases of bounded length;
4. each block gets the phrases that have a repeated window it holds, in parts of bounded size that are tasks of their own. A part's automaton holds pieces of its phrases, half a window long, at every half window: any window of a phrase
   contains a whole piece. All passages of the block stream through it, and a hit is extended as far as phrase and text
   agree; where that is a window or more, all of it is repeated;
5. the words found are removed from the whole texts.

Work grows with the text, not with the square of anything: a phrase goes to the blocks that hold a window of it (or of
a phrase that stands within ``phrase_windows`` words of it), however many others share its anchors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from eventloom.llm.columns import boxed, discard, row_key, staged, unboxed
from eventloom.llm.words import (
    CHUNK_BYTES,
    Words,
    gram_hashes,
    gram_starts,
    signed,
    sliding_argmin,
    slices,
    split_words,
)

#: A place is the upper bits of a row key and the number of a word; no text that fits a row has more words.
_WORD_BITS = 28
_ROW_MASK = -(1 << _WORD_BITS)
#: Rows of a batch that a task hands over.
_ROWS = 100_000
#: Code points an automaton may use for words, without the surrogates.
_CODES = 0x10FFFF - 0xE000


@dataclass(frozen=True)
class Params:
    """``block_chars`` bounds the passages one automaton serves, ``part_chars`` the phrases it holds (about ten bytes of
    memory a character), ``phrase_windows`` the length of a phrase; none changes the result. Every part of a block's
    phrases reads the block's passages again, so parts are as large as a task's memory allows."""

    window: int = 35
    gram: int = 8
    block_chars: int = 3_000_000
    part_chars: int = 24_000_000
    phrase_windows: int = 150


def anchored(words: Words, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of windows under one anchor: number of the text, first word, number of windows, anchor hash."""
    grams = gram_hashes(words.hash, p.gram)
    place = sliding_argmin(grams, p.window - p.gram + 1)
    start = gram_starts(words, p.window)
    if not len(start):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, np.uint64)
    place = place[start]
    text = words.text_of[start]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(fresh)
    return text[at], start[at], np.diff(np.append(at, len(start))), grams[place[at]]


def _anchors(text: str, p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                words = split_words(part.column(text))
                owner, start, count, anchor = anchored(words, p)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row").take(pa.array(owner)), pa.array(signed(anchor)),
                        pa.array((start - words.first[owner]).astype(np.int32)), pa.array(count.astype(np.int32)),
                    ],
                    ["row", "anchor", "at", "windows"],
                )

    return run


def _cut(p: Params):
    """The parts of a text under shared anchors; parts that overlap or touch are one passage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                rows, starts, texts = [], [], []
                spans = part.column("spans")
                for i, row in enumerate(part.column("row").to_pylist()):
                    flat = spans[i].values
                    at = flat.field("at").to_numpy()
                    end = at + flat.field("windows").to_numpy() + p.window - 1
                    order = np.argsort(at, kind="stable")
                    at, end = at[order], np.maximum.accumulate(end[order])
                    fresh = np.flatnonzero(np.append(True, at[1:] > end[:-1]))
                    last = np.append(fresh[1:], len(at)) - 1
                    base = words.first[i]
                    for a, b in zip(at[fresh].tolist(), end[last].tolist(), strict=True):
                        rows.append(row)
                        starts.append(a)
                        texts.append(words.joined(np.arange(base + a, base + b)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), pa.array(starts, pa.int32()), pa.array(texts, pa.binary()).cast(pa.string())],
                    ["row", "at", "text"],
                )

    return run


def _places(row: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (row & _ROW_MASK) | at


def _windows(p: Params):
    """The different windows of a block, each with its least place there and whether it has several."""

    def run(passages: pa.Table) -> pa.Table:
        hashes, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in passages.to_batches():
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                start = gram_starts(words, p.window)
                owner = words.text_of[start]
                at = part.column("at").to_numpy()[owner] + start - words.first[owner]
                places.append(_places(part.column("row").to_numpy()[owner], at))
                hashes.append(signed(gram_hashes(words.hash, p.window)[start]))
        hashes, places = np.concatenate(hashes), np.concatenate(places)
        order, first = _grouped(hashes)
        least = np.minimum.reduceat(places[order], first) if len(first) else places
        block = pa.array(np.repeat(passages.column("block")[:1].to_numpy(), len(first)), pa.int64())
        several = np.diff(np.append(first, len(order))) > 1
        return pa.table({"hash": pa.array(hashes[order[first]]), "place": pa.array(least), "several": pa.array(several), "block": block})

    return run


def _grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal hashes together, and where in it each hash begins."""
    order = np.argsort(hashes)
    inside = hashes[order]
    return order, np.flatnonzero(np.append(True, inside[1:] != inside[:-1])[: len(inside)])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows with several places, from all rows of their hashes: the least place and the blocks."""
    seen = list(batches)
    hashes, places, several, blocks = (
        np.concatenate([np.zeros(0, kind), *(b.column(c).to_numpy(zero_copy_only=False) for b in seen)])
        for c, kind in (("hash", np.int64), ("place", np.int64), ("several", bool), ("block", np.int64))
    )
    del seen
    order, first = _grouped(hashes)
    if not len(first):
        return
    size = np.diff(np.append(first, len(order)))
    kept = (size > 1) | np.logical_or.reduceat(several[order], first)
    least = np.minimum.reduceat(places[order], first)[kept]
    hashes, blocks, size = hashes[order[first]][kept], blocks[order][np.repeat(kept, size)], size[kept]
    edges = np.append(0, np.cumsum(size))
    for a in range(0, len(size), _ROWS):
        b = min(a + _ROWS, len(size))
        lists = pa.ListArray.from_arrays(pa.array((edges[a : b + 1] - edges[a]).astype(np.int32)), pa.array(blocks[edges[a] : edges[b]]))
        yield pa.RecordBatch.from_arrays([pa.array(hashes[a:b]), pa.array(least[a:b]), lists], ["hash", "place", "blocks"])


def _phrases(p: Params):
    """Runs of repeated windows, from the passages that are their chosen places, with the blocks that hold some of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                hashes = signed(gram_hashes(words.hash, p.window))
                chosen = np.zeros(len(words) + 1, bool)
                at, places, held = part.column("at").to_numpy(), part.column("places"), part.column("held")
                blocks, texts = [], []
                for i in range(part.num_rows):
                    flat = places[i].values
                    local = (flat.field("place").to_numpy() & ~_ROW_MASK) - at[i]
                    inside = (local >= 0) & (local <= words.counts[i] - p.window)
                    local = local[inside] + words.first[i]
                    # another row may share the upper bits of the key; its windows are not here
                    local = local[hashes[local] == flat.field("hash").to_numpy()[inside]]
                    chosen[local] = True
                    # windows of two texts never neighbour each other: a text's last words start none
                    base = int(words.first[i])
                    edges = (np.flatnonzero(np.diff(chosen[base : base + words.counts[i] + 1].astype(np.int8), prepend=0)) + base).tolist()
                    cells = held[i].values.field("cell").to_numpy() & ~_ROW_MASK
                    order = np.argsort(cells, kind="stable")
                    cells, own = cells[order], held[i].values.field("block").to_numpy()[order]
                    shift = int(at[i]) - base
                    for begin, end in zip(edges[::2], edges[1::2], strict=True):
                        while begin < end:
                            cell = (begin + shift) // p.phrase_windows
                            to = min(end, (cell + 1) * p.phrase_windows - shift)
                            low, high = np.searchsorted(cells, [cell, cell + 1])
                            blocks.append(own[low:high])
                            texts.append(words.joined(np.arange(begin, to - 1 + p.window)))
                            begin = to
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks, pa.list_(pa.int64())), pa.array(texts, pa.binary()).cast(pa.string())],
                    ["blocks", "phrase"],
                )

    return run


def _coded(ids: np.ndarray) -> str:
    """Words as code points, so that the automaton works on words and not on letters."""
    code = (ids % _CODES).astype(np.uint32) + np.uint32(1)
    code[code >= 0xD800] += np.uint32(0x800)
    return code.tobytes().decode("utf-32-le")


def _numbered(columns: list[pa.ChunkedArray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Words of text columns as numbers that agree where the words do, and where each text's begin."""
    hashes, firsts = [], []
    for column in columns:
        parts, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        for batch in pa.table({"text": column}).to_batches():
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                parts.append(words.hash)
                counts.append(words.counts)
        hashes.append(np.concatenate(parts))
        firsts.append(np.cumsum(np.concatenate(counts)))
    _, number = np.unique(np.concatenate(hashes), return_inverse=True)
    return np.split(number.astype(np.int32), np.cumsum([len(h) for h in hashes])[:-1]), firsts


def _locate(p: Params):
    piece = (p.window + 1) // 2

    def extent(a: str, at: int, low: int, high: int, b: str, here: int) -> tuple[int, int]:
        """The longest range around ``at`` in which both agree, between ``low`` and ``high``."""
        shift = here - at
        if a[low:high] == b[low + shift : high + shift]:
            return low, high
        left, right = low, at  # the first place that may be in the range, the last that is known to be
        while left < right:
            middle = (left + right) // 2
            if a[middle:right] == b[middle + shift : right + shift]:
                right = middle
            else:
                left = middle + 1
        start, left, right = left, at, high
        while left < right:
            middle = (left + right + 1) // 2
            if a[left:middle] == b[left + shift : middle + shift]:
                left = middle
            else:
                right = middle - 1
        left, right = start, left
        return left, right

    def run(passages: pa.Table, phrases: pa.Table) -> pa.Table:
        out_row, out_at, out_to = [], [], []
        if passages.num_rows and phrases.num_rows:
            (doc, phrase), (first, known) = _numbered([passages.column("text"), phrases.column("phrase")])
            codes, phrase_codes = _coded(doc), _coded(phrase)
            exact = max(doc.max(initial=0), phrase.max(initial=0)) < _CODES
            edges = known.tolist()
            automaton = ahocorasick.Automaton()
            for begin, end in zip(edges, edges[1:], strict=False):
                for at in range(begin, end - piece + 1, piece):
                    word = phrase_codes[at : at + piece]
                    places = automaton.get(word, None)
                    if places is None:
                        automaton.add_word(word, [(begin, at, end)])
                    else:
                        places.append((begin, at, end))
            automaton.make_automaton()
            if not exact:  # more words than code points: compare the numbers themselves
                doc_words, phrase_words = doc.tolist(), phrase.tolist()
            done = bytearray(len(doc))
            firsts = first.tolist()
            for low, high in zip(firsts, firsts[1:], strict=False):
                for last, places in automaton.iter(codes[low:high]):
                    at = low + last - piece + 1
                    for begin, here, end in places:
                        left, right = max(low, at - (here - begin)), min(high, at + (end - here))
                        if right - left < p.window or done.find(0, left, right) < 0:
                            continue
                        if exact:
                            a, b = extent(codes, at, left, right, phrase_codes, here)
                        else:
                            a, b = extent(doc_words, at, left, right, phrase_words, here)
                        if b - a >= p.window:
                            done[a:b] = b"\x01" * (b - a)
            inside = np.frombuffer(done, np.uint8)
            fresh = inside == 1
            fresh[1:] &= inside[:-1] == 0
            fresh[first[:-1][first[:-1] < len(doc)]] |= inside[first[:-1][first[:-1] < len(doc)]] == 1
            close = inside == 1
            close[:-1] &= inside[1:] == 0
            ends = first[1:][first[1:] > 0] - 1
            close[ends] |= inside[ends] == 1
            begin, end = np.flatnonzero(fresh), np.flatnonzero(close) + 1
            owner = np.searchsorted(first, begin, "right") - 1
            shift = passages.column("at").to_numpy()[owner] - first[owner]
            out_row = passages.column("row").to_numpy()[owner]
            out_at, out_to = begin + shift, end + shift
        return pa.table(
            {"row": pa.array(out_row, pa.int64()), "at": pa.array(out_at, pa.int32()), "to": pa.array(out_to, pa.int32())}
        )

    return run


def repeated_spans(docs: DataFrame, text: str, key: str, p: Params = Params()) -> DataFrame:
    """``row`` (the key of ``row_key``) and ``spans``: the ranges of words, from and to, that repeated windows cover."""
    rows = docs.select(row_key(text, key).alias("row"), F.col(text).alias("text"))
    anchors = staged(
        rows.mapInArrow(_anchors("text", p), "row bigint, anchor bigint, at int, windows int"), "anchors"
    )
    counts = anchors.groupBy("anchor").agg(F.count("*").alias("n"))
    # written out, so that the join has a plain exchange on both sides and Spark can split a frequent anchor
    shared = staged(counts.where("n > 1").select("anchor"), "anchor-counts")
    hits = staged(anchors.join(shared, "anchor"), "shared-anchors")
    discard(anchors, shared)
    spans = hits.groupBy("row").agg(F.collect_set(F.struct("at", "windows")).alias("spans"))
    passages = staged(
        rows.join(spans.withColumnRenamed("row", "__row"), F.col("row") == F.col("__row"))
        .select("row", "text", "spans")
        .mapInArrow(_cut(p), "row bigint, at int, text string"),
        "passages",
    )
    discard(hits)
    chars = passages.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // p.block_chars))
    dealt = passages.withColumn("block", F.pmod(F.xxhash64("row", F.lit(11)), F.lit(blocks)))
    windows = dealt.groupBy("block").applyInArrow(_windows(p), "hash bigint, place bigint, several boolean, block bigint")
    # as many partitions as blocks, so that the windows of one are bounded too; a window has a row for each block at most
    windows = staged(windows.repartition(blocks, "hash").mapInArrow(_repeated, "hash bigint, place bigint, blocks array<bigint>"), "repeated-windows")
    mask = F.lit(_ROW_MASK).cast("long")
    places = windows.groupBy(F.col("place").bitwiseAND(mask).alias("__key")).agg(F.collect_list(F.struct("place", "hash")).alias("places"))
    # a cell is ``phrase_windows`` places of a row; a phrase lies in one
    cell = F.expr(f"(place & {_ROW_MASK}L) | ((place & {~_ROW_MASK}L) div {p.phrase_windows})").alias("cell")
    held = windows.select(cell, F.explode("blocks").alias("block")).distinct().groupBy(F.col("cell").bitwiseAND(mask).alias("__of")).agg(
        F.collect_list(F.struct("cell", "block")).alias("held")
    )
    phrases = staged(
        passages.withColumn("__part", F.col("row").bitwiseAND(mask))
        .join(places, F.col("__part") == F.col("__key"))
        .join(held, F.col("__part") == F.col("__of"))
        .select("at", "text", "places", "held")
        .mapInArrow(_phrases(p), "blocks array<bigint>, phrase string"),
        "phrases",
    )
    discard(windows)
    wanted = phrases.select(F.explode("blocks").alias("block"), "phrase")
    # the phrases of a block are dealt in parts of bounded size, and each part meets the block's passages by itself
    chars = wanted.groupBy("block").agg(F.sum(F.length("phrase")).alias("chars"))
    parts = chars.select("block", F.greatest(F.ceil(F.col("chars") / p.part_chars), F.lit(1)).cast("int").alias("parts"))
    parts = staged(parts, "phrase-parts", small=True)
    wanted = wanted.join(parts, "block").select(
        "block", F.pmod(F.xxhash64("phrase", F.lit(13)), F.col("parts")).cast("int").alias("part"), "phrase"
    )
    dealt = dealt.join(parts, "block").select(
        "block", "row", "at", "text", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    found = staged(
        dealt.groupBy("block", "part")
        .cogroup(wanted.groupBy("block", "part"))
        .applyInArrow(_locate(p), "row bigint, at int, to int"),
        "repeated",
    )
    discard(passages, phrases, parts)
    return found.groupBy("row").agg(F.collect_set(F.struct("at", "to")).alias("spans"))


def _remover(p: Params, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                gone = np.zeros(len(words) + 1, np.int32)
                spans = part.column("spans")
                for i in range(part.num_rows):
                    flat = spans[i].values
                    if flat is not None:
                        np.add.at(gone, words.first[i] + flat.field("at").to_numpy(), 1)
                        np.add.at(gone, words.first[i] + flat.field("to").to_numpy(), -1)
                keep = np.cumsum(gone[:-1]) == 0
                kept = [
                    words.joined(a + np.flatnonzero(keep[a:b]))
                    for a, b in zip(words.first.tolist(), words.first[1:].tolist(), strict=False)
                ]
                total = np.concatenate([[0], np.cumsum(~keep)])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"), pa.array(words.counts),
                        pa.array(total[words.first[1:]] - total[words.first[:-1]]),
                        pa.array([hashlib.sha256(t).hexdigest() for t in kept]),
                    ]
                    + ([pa.array(kept, pa.binary()).cast(pa.string())] if whole else []),
                    ["row", "n_words", "n_removed", "kept_sha256", *(["kept_text"] if whole else [])],
                )

    return run


def without_repeats(
    docs: DataFrame, text: str = "text", key: str = "doc_id", p: Params = Params(), whole: bool = True
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed``, ``kept_sha256`` and (``whole``) ``kept_text``, without ``text``.

    Removed is every word of a window that also starts anywhere else, in the same text or another. Kept words are
    joined by one space. NULL and blank texts have no words; texts shorter than a window lose nothing; rows that agree
    in id and text are repeats of each other and lose all their windows. An empty table stays empty. Columns of ``docs``
    named like the result are replaced, all others pass through whatever their names.
    """
    added = ["n_words", "n_removed", "kept_sha256", *(["kept_text"] if whole else [])]
    spans = staged(
        repeated_spans(docs, text, key, p).select(F.col("row").alias("of"), "spans"), "spans"
    )
    others = boxed(docs, text, "n_words", "n_removed", "kept_sha256", "kept_text", place=row_key(text, key), text=F.col(text))
    wide = others.join(spans, F.col("place") == F.col("of"), "left").select("row", "text", "spans")
    schema = T.StructType(
        [T.StructField("row", others.schema["row"].dataType), T.StructField("n_words", T.LongType())]
        + [T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
        + [T.StructField("kept_text", T.StringType())] * whole
    )
    return unboxed(wide.mapInArrow(_remover(p, whole), schema), *added)
