"""Near duplicates by MinHash bands and sequential Bayesian verification.

Documents with equal shingle sets form one class, and classes are what is compared. Classes that agree on a band are
candidates. A candidate pair has its signatures compared batch by batch. After each batch it goes if the posterior
probability that its similarity reaches the threshold is below the chosen miss probability. What survives is verified on
the full sets.

1. Every class is compared with its hub, the smallest class it shares a band with. That is one comparison a class and
   joins nearly all of a large group of copies, however large it is.
2. Bands whose classes are not all in one component by then are open. Classes of open bands that are connected through
   them form a block, and a block is compared in pieces of bounded size, each pair of pieces a task of its own; classes
   that are joined already are not verified again. A task reports a spanning forest of its links, which has the same
   components and is never longer than its documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventloom.llm.columns import boxed, discard, row_key, staged, unboxed
from eventloom.llm.components import components
from eventloom.llm.words import Words, gram_hashes, mix, range_hashes, signed, slices, split_words, unsigned


@dataclass(frozen=True)
class Params:
    """``percent``: 100 times the similarity of a link. A pair at the threshold shares no band with probability
    (1 - (percent / 100) ** rows) ** bands, 3e-7 by default; ``miss`` is the chance per batch to give up on a pair
    that reaches it. ``piece_docs`` and ``piece_shingles`` bound what a task holds, not what is compared."""

    shingle: int = 5
    percent: int = 85
    bands: int = 32
    rows: int = 6
    batch: int = 32
    miss: float = 1e-7
    piece_docs: int = 1000
    piece_shingles: int = 1_000_000

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where each text's begin."""
    n = len(words.first) - 1
    counts = words.counts
    grams = gram_hashes(words.hash, size)
    starts = np.arange(len(grams))
    stop = np.repeat(words.first[1:], counts)[: len(grams)]
    fits = starts + size <= stop
    owner = np.repeat(np.arange(n), counts)[: len(grams)][fits]
    short = np.flatnonzero((counts > 0) & (counts < size))
    whole = range_hashes(words.hash, words.first[short], words.first[short] + counts[short])
    owner = np.concatenate([owner, short])
    value = np.concatenate([grams[fits], whole])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[fresh], value[fresh]
    return value, np.searchsorted(owner, np.arange(n + 1))


def signatures(value: np.ndarray, first: np.ndarray, hashes: int) -> np.ndarray:
    """MinHash of each non-empty set, 32 bits per hash function."""
    keys = mix(np.arange(1, 2 * hashes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.empty((len(first) - 1, hashes), np.uint32)
    for k in range(hashes):
        mixed = ((value ^ keys[2 * k]) * (keys[2 * k + 1] | np.uint64(1))) >> np.uint64(32)
        out[:, k] = np.minimum.reduceat(mixed, first[:-1])
    return out


def _sketcher(key: str, text: str, p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                value, first = shingle_sets(split_words(part.column(text), lower=True), p.shingle)
                sizes = np.diff(first)
                full = np.flatnonzero(sizes)
                n = part.num_rows
                bands, sketch = [None] * n, [None] * n
                same = np.zeros(n, np.uint64)
                if len(full):
                    starts = np.append(first[full], first[-1])
                    sig = signatures(value, starts, p.hashes)
                    rows = sig.reshape(len(full), p.bands, p.rows).astype(np.uint64)
                    band = np.broadcast_to(np.arange(1, p.bands + 1, dtype=np.uint64), rows.shape[:2])
                    for r in range(p.rows):
                        band = mix(band ^ rows[:, :, r])
                    low = sig.astype(np.uint8)
                    one, two = mix(value), mix(value ^ np.uint64(0x5851F42D4C957F2D))
                    same[full] = mix(
                        np.add.reduceat(one, starts[:-1]) ^ mix(np.add.reduceat(two, starts[:-1]) + sizes[full].astype(np.uint64))
                    )
                    for i, at in enumerate(full.tolist()):
                        bands[at], sketch[at] = signed(band[i]), low[i].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("__row"), part.column(key), pa.array(sizes), pa.array(signed(same)),
                        pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary()),
                    ],
                    ["row", key, "n_shingles", "cls", "bands", "sketch"],
                )

    return run


def least_matches(p: Params) -> list[int]:
    """After 1, 2, ... batches: the fewest equal hashes with which a pair stays.

    With a uniform prior the similarity given m of n equal hashes is Beta(m + 1, n - m + 1), and the probability that
    it reaches t is that of at most m successes in n + 1 trials at t. Sketches keep 8 bits of a hash, so unequal
    hashes look equal once in 256, which raises t a little; the bound of a true pair is what counts.
    """
    t = p.percent / 100
    t = t + (1 - t) / 256
    bounds = []
    for n in range(p.batch, p.hashes + 1, p.batch):
        below, m = 0.0, 0
        while m <= n:
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= p.miss:
                break
            m += 1
        bounds.append(m)
    return bounds


def surviving(a: np.ndarray, b: np.ndarray, p: Params, bounds: list[int], same: bool) -> Iterator[tuple[int, np.ndarray]]:
    """Banded pairs of two sketch matrices that no batch ruled out: each row of ``a`` with the rows of ``b`` left."""

    def band_keys(x: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(x), p.bands, 8), np.uint8)
        wide[:, :, : min(p.rows, 8)] = x.reshape(len(x), p.bands, p.rows)[:, :, :8]
        return wide.view(np.uint64)[:, :, 0]

    keys_a, keys_b = band_keys(a), band_keys(b)
    for i in range(len(a)):
        begin = i + 1 if same else 0
        left = begin + np.flatnonzero((keys_b[begin:] == keys_a[i]).any(axis=1))
        equal = np.zeros(len(left), np.int32)
        for k, least in enumerate(bounds):
            cut = slice(k * p.batch, (k + 1) * p.batch)
            equal += (b[left, cut] == a[i, cut]).sum(axis=1)
            stay = equal >= least
            left, equal = left[stay], equal[stay]
            if not len(left):
                break
        if len(left):
            yield i, left[np.argsort(-equal, kind="stable")]


class _Forest:
    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x


def _verifier(p: Params):
    bounds = least_matches(p)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        piece = table.column("piece").to_numpy()
        cls = table.column("cls").to_numpy()
        _, at = np.unique(cls, return_index=True)  # rows that agree in id and text
        at = at[np.argsort(piece[at], kind="stable")]
        piece, cls = piece[at], cls[at]
        table = table.take(pa.array(at))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(at), p.hashes)
        sets = []
        for batch in table.select(["text"]).to_batches():
            for part in slices(batch, "text"):
                value, first = shingle_sets(split_words(part.column("text"), lower=True), p.shingle)
                sets += [value[x:y] for x, y in zip(first, first[1:], strict=False)]
        vocabulary, number = np.unique(np.concatenate(sets), return_inverse=True)
        edges = np.cumsum([0, *map(len, sets)])
        sets = [number[x:y] for x, y in zip(edges, edges[1:], strict=False)]
        size = np.diff(edges)
        flag = np.zeros(len(vocabulary), bool)
        split = int(np.searchsorted(piece, piece[0], "right")) if piece[0] != piece[-1] else 0
        forest, links = _Forest(len(at)), []
        _, joined, label = np.unique(table.column("label").to_numpy(), return_index=True, return_inverse=True)
        for i, k in enumerate(joined[label].tolist()):
            forest.parent[i] = k
        for i, partners in surviving(sketch[:split] if split else sketch, sketch[split:], p, bounds, not split):
            flag[sets[i]] = True
            for j in (partners + split).tolist():
                x, y = forest.find(i), forest.find(j)
                if x == y:
                    continue
                common = int(flag[sets[j]].sum())
                if 100 * common >= p.percent * (int(size[i]) + int(size[j]) - common):
                    forest.parent[x] = y
                    links.append((cls[i], cls[j]))
            flag[sets[i]] = False
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _pieces(members: DataFrame, group: str, p: Params) -> DataFrame:
    """``members`` (``cls``, ``n``, ``group``) with the number of ``pieces`` of their group and their own ``piece``."""
    pieces = members.groupBy(group).agg(
        F.greatest(
            F.ceil(F.count("*") / p.piece_docs), F.ceil(F.sum("n") / p.piece_shingles), F.lit(1)
        ).cast("int").alias("pieces")
    )
    return members.join(pieces, group).withColumn("piece", F.pmod(F.xxhash64("cls", F.lit(7)), F.col("pieces")).cast("int"))


def _with_hubs(work: DataFrame, hubs: DataFrame, p: Params) -> DataFrame:
    """Classes by hub and ``part``, a bounded number together, each part with its hub as the other piece."""
    members = _pieces(hubs.where("cls <> hub").join(work, "cls"), "hub", p)
    own = members.select("hub", F.col("piece").alias("part"), F.lit(1).alias("piece"), "cls", "sketch", "text")
    parts = members.select("hub", F.col("piece").alias("part")).distinct()
    other = parts.join(work, F.col("hub") == F.col("cls")).select("hub", "part", F.lit(0).alias("piece"), "cls", "sketch", "text")
    return own.unionByName(other).withColumn("label", F.col("cls"))


def _in_pieces(work: DataFrame, open_bands: DataFrame, p: Params) -> DataFrame:
    """Classes by block and pair of pieces. A class meets the smallest class of each of its bands. It is linked with the
    smallest of these, and they are linked with that one too: the same blocks as by a link per band, with about as many
    links as classes."""
    least = open_bands.groupBy("band").agg(F.min("cls").alias("least"))
    meets = open_bands.join(least, "band").groupBy("cls", "label").agg(F.collect_set("least").alias("leasts"))
    meets = staged(meets.withColumn("hub", F.array_min("leasts")), "hubs")
    near = meets.select("cls", "hub").unionByName(meets.select(F.explode("leasts").alias("cls"), "hub").distinct())
    blocks = components(near.where("cls <> hub"), "cls", "hub").withColumnsRenamed({"node": "cls", "label": "block"})
    members = blocks.join(meets.select("cls", "label"), "cls").join(work, "cls")
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other")
    return _pieces(members, "block", p).select("*", other).select(
        "block", F.least("piece", "other").alias("lo"), F.greatest("piece", "other").alias("hi"), "piece", "cls", "label", "sketch", "text"
    )


def _verified(grouped: DataFrame, by: list[str], p: Params, name: str) -> DataFrame:
    return staged(grouped.groupBy(*by).applyInArrow(_verifier(p), "a bigint, b bigint"), name)


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", p: Params = Params()) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest key, NULL last, then of the smallest row key.

    Texts without words are no duplicates of each other, but rows that agree in key and text are; all columns stay.
    """
    found = near_duplicates(docs.select(key, text), key, text, p)
    best = F.min(F.struct(F.col(key).isNull().alias("x"), F.col(key).alias("k"), F.col("row").alias("r"))).alias("b")
    chosen = found.groupBy("group").agg(best).select(F.col("b.r").alias("chosen"))
    times = found.groupBy(F.col("row").alias("of")).agg(F.count("*").alias("times"))
    chosen = staged(chosen.join(times, F.col("chosen") == F.col("of")).select("chosen", "times"), "near-chosen")
    discard(*found.staged_tables)
    rows = boxed(docs, place=row_key(text, key))
    same = F.col("place") == F.col("chosen")
    # most rows are kept, so this is no join to broadcast, whatever the size of the input
    kept = rows.join(chosen.where("times = 1").hint("merge"), same, "left_semi")
    # rows that agree in id and text are the only ones that must meet; their keys are a table of their own, so that
    # Spark knows how few they are
    repeated = staged(chosen.where("times > 1"), "near-repeated", small=True)
    if not repeated.isEmpty():
        kept = kept.unionByName(rows.join(repeated, same, "left_semi").dropDuplicates(["place"]))
    return unboxed(kept)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", p: Params = Params()) -> DataFrame:
    """Per row: ``key``, ``n_shingles``, ``component_id`` (smallest key that links reach) and ``kept``; also ``row``, the
    key of ``row_key``, and ``group``, which tells components apart whatever their keys are.

    Texts are compared as sets of ``p.shingle`` lower-cased words; a shorter text is one shingle, a text without words
    has none and is linked with nothing, its component is itself. Kept is a row whose key is its component's. Repeated
    rows are copies of each other and all kept or all not. A NULL key never names a component unless all of its keys
    are NULL, and such rows are not kept. An empty table gives an empty result; other columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).withColumn(
        "__row", row_key("text", "key")
    )
    sketches = staged(
        rows.mapInArrow(
            _sketcher("key", "text", p),
            f"row bigint, key {kind}, n_shingles bigint, cls bigint, bands array<bigint>, sketch binary",
        ),
        "sketches",
    )
    full = sketches.where("n_shingles > 0")
    banded = full.select("cls", F.explode("bands").alias("band"))
    ends = banded.groupBy("band").agg(F.min("cls").alias("least"), F.max("cls").alias("most")).where("least < most")
    # written out, so that the join has a plain exchange on both sides and Spark can split a frequent band
    buckets = staged(ends.select("band", "least"), "buckets")
    shared = staged(banded.join(buckets, "band").select("band", "cls", "least").distinct(), "shared-bands")
    first = full.groupBy("cls").agg(F.min("row").alias("row"), F.min("key").alias("first_key"))
    first = staged(first.join(full.groupBy("cls").agg(F.max("n_shingles").alias("n")), "cls"), "classes")
    hubs = shared.groupBy("cls").agg(F.min("least").alias("hub"))
    wanted = first.join(shared.select("cls").distinct(), "cls", "left_semi").select("cls", "row", "n")
    # only the candidates' texts leave the place where they are read, and of rows that agree in id and text only one
    texts = rows.join(wanted.select("row"), F.col("__row") == F.col("row"), "left_semi").dropDuplicates(["__row"])
    sketch = full.select(F.col("row").alias("__r"), F.col("cls").alias("__c"), "sketch").join(
        wanted.select(F.col("row").alias("r")), F.col("__r") == F.col("r"), "left_semi"
    )
    work = staged(
        wanted.join(sketch.dropDuplicates(["__r", "__c"]), (F.col("row") == F.col("__r")) & (F.col("cls") == F.col("__c")))
        .join(texts.select("__row", "text"), F.col("row") == F.col("__row"))
        .select("cls", "n", "sketch", "text"),
        "near-texts",
    )
    starred = _verified(_with_hubs(work, hubs, p), ["hub", "part"], p, "hub-links")
    found, rest = starred, []
    joined = components(starred, "a", "b").withColumnsRenamed({"node": "cls", "label": "joined"})
    label = F.coalesce("joined", "cls").alias("label")
    labelled = shared.join(joined, "cls", "left").select("band", "cls", label)
    ends = labelled.groupBy("band").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    open_bands = staged(labelled.join(ends.where("least < most").select("band"), "band"), "open-bands")
    if not open_bands.isEmpty():
        rest = [_verified(_in_pieces(work, open_bands, p), ["block", "lo", "hi"], p, "near-links")]
        found = starred.unionByName(*rest)
    labels = components(found, "a", "b")
    discard(buckets, shared, work, open_bands, starred, *rest)
    named = first.select("cls", "first_key").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    named = named.withColumn("label", F.coalesce("label", "cls"))
    lowest = named.groupBy("label").agg(F.min("first_key").alias("component_id"))
    classes = staged(named.join(lowest, "label").select("cls", "component_id", F.col("label").alias("group")), "near-classes")
    discard(first, labels)
    # texts without words stay out of the join: they would all meet under one class
    linked = full.select("key", "n_shingles", "row", "cls").join(classes, "cls").drop("cls")
    alone = sketches.where("n_shingles = 0").select(
        "key", "n_shingles", "row", F.col("key").alias("component_id"), F.col("row").alias("group")
    )
    out = (
        linked.unionByName(alone)
        .withColumn("kept", F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)))
        .withColumnRenamed("key", key)
    )
    out.staged_tables = [sketches, classes]
    return out
