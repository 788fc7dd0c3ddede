"""A bigram language model by deleted interpolation.

P(w | v) = a(b) c(v w) / c(v) + u(b) c(w) / N + e(b) / (V + 1), where b is the bucket of the context's frequency c(v).
The three weights of a bucket are learned by expectation-maximisation on held-out counts: every training token in turn
is left out of the counts that predict it, so c(v w), c(v), c(w) and N are one less. What EM needs of the corpus is how
often each pair of component probabilities occurs in a bucket; probabilities are rounded to a quarter of an octave for
that, so the table has a bounded size and is all the driver sees.

Counting and looking up go together. A task turns its documents into blocks of a few million tokens and reports each
block's distinct unigrams and bigrams once, sorted by hash and split by hash range. A range sums the counts of all
blocks and answers every block with the totals in the order asked, so answers need no keys. Grams are told apart by
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from eventloom.llm.columns import release, staged
from eventloom.llm.words import mix, slices, split_words

_END, _START = np.uint64(0x3C6EF372FE94F82B), np.uint64(0x510E527FADE682D1)
_STEPS = 4  # per octave
_NONE = 1023  # the code of probability 0


@dataclass(frozen=True)
class Params:
    """``block_tokens`` and ``range_grams`` bound what a task holds; ``rounds`` and ``precision`` end EM."""

    block_tokens: int = 1_000_000
    range_grams: int = 1_000_000
    rounds: int = 500
    precision: float = 1e-7
    least_weight: float = 1e-9


def _pack(values: np.ndarray) -> bytes:
    """Unsigned integers by byte planes, compressed: most counts and frequent ranks need one plane."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T), "zstd", asbytes=True)


def _unpack(raw: bytes, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    flat = pa.decompress(raw, n * width, "zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(width, n).T).reshape(-1).view(kind)


def _pack_sorted(hashes: np.ndarray) -> bytes:
    return _pack(np.diff(hashes, prepend=np.uint64(0)))


def _unpack_sorted(raw: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(raw, n, np.uint64), dtype=np.uint64)


_BLOCK = "block bigint, held array<boolean>, lengths array<int>, vocabulary binary, n_vocabulary int, tokens binary, grams bigint"


@dataclass
class _Block:
    """Tokens of a block by rank in its vocabulary, and its distinct bigrams."""

    held: np.ndarray
    lengths: np.ndarray
    vocabulary: np.ndarray
    tokens: np.ndarray

    def __post_init__(self) -> None:
        first = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        before = np.empty(len(self.tokens), np.uint64)
        before[1:] = self.tokens[:-1]
        before[first] = len(self.vocabulary)
        pairs, self.bigram = np.unique((before << np.uint64(32)) | self.tokens, return_inverse=True)
        self.left, self.right = pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)
        self.learned = np.repeat(~self.held, self.lengths)
        left = np.append(self.vocabulary, _START)[self.left]
        hashes = [mix(self.vocabulary ^ np.uint64(0x1F83D9ABFB41BD6B))]
        hashes.append(mix(mix(left) * np.uint64(0x9FB21C651E98DF25) + self.vocabulary[self.right]))
        self.order = [np.argsort(h, kind="stable") for h in hashes]
        self.hashes = [h[o] for h, o in zip(hashes, self.order, strict=True)]

    @classmethod
    def of(cls, row: dict) -> _Block:
        lengths = np.array(row["lengths"], np.int64)
        return cls(
            np.array(row["held"], bool), lengths, np.frombuffer(row["vocabulary"], np.uint64),
            _unpack(row["tokens"], int(lengths.sum()), np.uint32).astype(np.uint64),
        )

    def counts(self) -> list[np.ndarray]:
        """Training counts inside the block, in hash order."""
        learned = self.learned.astype(np.float64)
        one = np.bincount(self.tokens.astype(np.int64), learned, len(self.vocabulary))
        two = np.bincount(self.bigram, learned, len(self.left))
        return [c[o].astype(np.uint64) for c, o in zip((one, two), self.order, strict=True)]


def _ranges(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The range of each hash: equal parts of the hash space."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _blocks(key_type: str, p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        keys, held, lengths, hashes, size = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number, size
            tokens = np.concatenate(hashes)
            vocabulary, ids, counts = np.unique(tokens, return_inverse=True, return_counts=True)
            by_rank = np.argsort(-counts, kind="stable")
            rank = np.empty(len(by_rank), np.uint32)
            rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
            ids = rank[ids]
            # an upper bound of the distinct grams
            grams = len(vocabulary) + min(len(tokens), len(np.unique((ids[:-1].astype(np.uint64) << np.uint64(32)) | ids[1:])) + len(keys))
            row = {
                "keys": pa.concat_arrays(keys), "held": np.concatenate(held), "lengths": np.concatenate(lengths),
            }
            one = pa.array([0, len(row["keys"])], pa.int32())
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 24) + number], pa.int64()),
                    pa.ListArray.from_arrays(one, row["keys"]),
                    pa.ListArray.from_arrays(one, pa.array(row["held"])),
                    pa.ListArray.from_arrays(one, pa.array(row["lengths"], pa.int32())),
                    pa.array([vocabulary[by_rank].tobytes()], pa.binary()),
                    pa.array([len(vocabulary)], pa.int32()),
                    pa.array([_pack(ids)], pa.binary()),
                    pa.array([grams], pa.int64()),
                ],
                ["block", "keys", "held", "lengths", "vocabulary", "n_vocabulary", "tokens", "grams"],
            )
            number, size = number + 1, 0
            for part in (keys, held, lengths, hashes):
                part.clear()
            return batch

        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"), lower=True)
                keys.append(part.column("key"))
                held.append(part.column("held").to_numpy(zero_copy_only=False))
                lengths.append(words.counts + 1)
                hashes.append(np.insert(words.hash, words.first[1:], _END))
                size += len(hashes[-1])
                if size >= p.block_tokens:
                    yield flush()
        if keys:
            yield flush()

    return run


def _ask(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "block", "n1", "n2", "hashes1", "hashes2", "counts1", "counts2"]
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block.of(row)
                cuts = [np.searchsorted(_ranges(h, parts), np.arange(parts + 1)) for h in block.hashes]
                counts = block.counts()
                out = []
                for part in np.flatnonzero(np.diff(cuts[0]) + np.diff(cuts[1])).tolist():
                    a, b = (slice(cut[part], cut[part + 1]) for cut in cuts)
                    out.append(
                        (part, row["block"], a.stop - a.start, b.stop - b.start,
                         _pack_sorted(block.hashes[0][a]), _pack_sorted(block.hashes[1][b]),
                         _pack(counts[0][a]), _pack(counts[1][b]))
                    )
                kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(x) if i < 4 else x for x in c], k) for i, (c, k) in enumerate(zip(zip(*out, strict=True), kinds, strict=True))],
                    names,
                )

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Sum the counts of a range and answer each block; the row of block -1 has the range's distinct and all tokens."""
    rows = table.to_pylist()
    replies = []
    totals = (0, 0)
    for kind in ("1", "2"):
        sizes = [r["n" + kind] for r in rows]
        hashes = np.concatenate([_unpack_sorted(r["hashes" + kind], n) for r, n in zip(rows, sizes, strict=True)])
        counts = np.concatenate([_unpack(r["counts" + kind], n, np.uint64) for r, n in zip(rows, sizes, strict=True)])
        distinct, at = np.unique(hashes, return_inverse=True)
        total = np.zeros(len(distinct), np.uint64)
        np.add.at(total, at, counts)
        if kind == "1":
            totals = (int((total > 0).sum()), int(total.sum()))
        replies.append([_pack(x) for x in np.split(total[at], np.cumsum(sizes)[:-1])])
    blocks = [r["block"] for r in rows]
    return pa.table(
        {
            "block": pa.array([*blocks, -1], pa.int64()),
            "part": pa.array([r["part"] for r in rows] + [rows[0]["part"]], pa.int32()),
            "n1": pa.array([r["n1"] for r in rows] + [totals[0]], pa.int64()),
            "n2": pa.array([r["n2"] for r in rows] + [totals[1]], pa.int64()),
            "one": pa.array([*replies[0], None], pa.binary()),
            "two": pa.array([*replies[1], None], pa.binary()),
        }
    )


def _totals(block: _Block, answers: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Corpus counts: of each vocabulary entry; of each distinct bigram, of its left and of its right token."""
    answers = sorted(answers, key=lambda a: a["part"])
    out = []
    for order, name, size in zip(block.order, ("one", "two"), ("n1", "n2"), strict=True):
        flat = np.concatenate([_unpack(a[name], a[size], np.uint64) for a in answers])
        back = np.empty(len(flat), np.int64)
        back[order] = flat
        out.append(back)
    one, two = out
    # a text starts as often as one ends
    starts = one[np.flatnonzero(block.vocabulary == _END)]
    return one, two, np.append(one, starts)[block.left.astype(np.int64)], one[block.right.astype(np.int64)]


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, then one bucket per doubling of its frequency."""
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))) + 1, 0).astype(np.int64)


def _code(probability: np.ndarray) -> np.ndarray:
    safe = np.where(probability > 0, probability, 1.0)
    return np.where(probability > 0, np.round(-_STEPS * np.log2(safe)), _NONE).astype(np.int64)


def _held_out(n: int):
    """How often each combination of bucket and rounded component probabilities predicts a left-out token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block.of(row)
                _, two, left, right = _totals(block, row["answers"])
                times = np.bincount(block.bigram, block.learned.astype(np.float64), len(two)).astype(np.int64)
                use = times > 0
                two, left, right, times = two[use] - 1, left[use] - 1, right[use] - 1, times[use]
                p2 = np.where(left > 0, two / np.maximum(left, 1), 0.0)
                p1 = right / max(n - 1, 1)
                cell, at = np.unique((bucket(left) << 20) | (_code(p2) << 10) | _code(p1), return_inverse=True)
                total = np.bincount(at, times.astype(np.float64), len(cell)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total)], ["cell", "times"])

    return run


def learn_weights(cells: list[tuple[int, int]], v: int, p: Params = Params()) -> np.ndarray:
    """Per bucket the weights of bigram, unigram and uniform, by EM. A bucket without tokens gets those of all."""
    table = np.array(sorted(cells), np.int64).reshape(-1, 2)
    kind, times = table[:, 0] >> 20, table[:, 1].astype(float)

    def value(code: np.ndarray) -> np.ndarray:
        return np.where(code == _NONE, 0.0, np.exp2(-code / _STEPS))

    parts = np.stack([value((table[:, 0] >> 10) & 1023), value(table[:, 0] & 1023), np.full(len(table), 1 / (v + 1))], 1)

    def fit(rows: np.ndarray) -> np.ndarray:
        weights = np.full(3, 1 / 3)
        for _ in range(p.rounds):
            share = parts[rows] * weights
            share *= (times[rows] / share.sum(1))[:, None]
            new = np.maximum(share.sum(0) / times[rows].sum(), p.least_weight)
            new /= new.sum()
            done = np.abs(new - weights).max() < p.precision
            weights = new
            if done:
                break
        return weights

    everything = fit(np.arange(len(table))) if len(table) else np.array([0.0, 0.0, 1.0])
    out = np.tile(everything, (65, 1))
    for k in np.unique(kind):
        out[k] = fit(np.flatnonzero(kind == k))
    return out


def _scores(n: int, v: int, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("keys")
            for i, row in enumerate(batch.drop_columns(["keys"]).to_pylist()):
                block = _Block.of(row)
                one, two, left, right = _totals(block, row["answers"])
                mixing = weights[bucket(left)]
                probability = (
                    mixing[:, 0] * (two / np.maximum(left, 1)) + mixing[:, 1] * (right / max(n, 1)) + mixing[:, 2] / (v + 1)
                )
                tokens = block.tokens.astype(np.int64)
                first = np.concatenate([[0], np.cumsum(block.lengths)])[:-1]
                base = np.log10(one + 1.0) - np.log10(float(n + v + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        keys[i].values, pa.array(block.held), pa.array(block.lengths),
                        pa.array(np.add.reduceat((one > 0)[tokens].astype(np.int64), first)),
                        pa.array(np.full(len(first), n)),
                        pa.array(np.add.reduceat(base[tokens], first)),
                        pa.array(np.add.reduceat(np.log10(probability)[block.bigram], first)),
                    ],
                    ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def scored(
    docs: DataFrame, text: str = "text", key: str = "doc_id", folds: int = 7, held_fold: int = 2, p: Params = Params()
) -> DataFrame:
    """Per row: ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    The model learns from the rows whose crc32 of the key as text leaves another remainder than ``held_fold``; a NULL
    key counts as empty text. Tokens are the words, A-Z lower-cased, and one end per text; a NULL text is empty and has
    the end only. ``base_score`` is the add-one unigram score. Repeated rows are learned and scored one by one. Without
    training rows every token is uniform. An empty table gives no rows; other columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()
    held = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds == held_fold
    rows = docs.select(F.col(key).alias("key"), held.alias("held"), F.col(text).cast("string").alias("text"))
    blocks = staged(
        rows.mapInArrow(_blocks(kind, p), _BLOCK.replace("held array", f"keys array<{kind}>, held array", 1)), "lm-blocks"
    )
    grams = blocks.agg(F.sum("grams")).first()[0] or 0
    parts = max(1, -(-grams // p.range_grams))
    lean = blocks.select("block", "held", "lengths", "vocabulary", "tokens")
    asked = lean.mapInArrow(
        _ask(parts), "part int, block bigint, n1 int, n2 int, hashes1 binary, hashes2 binary, counts1 binary, counts2 binary"
    )
    answers = staged(
        asked.groupBy("part").applyInArrow(
            _answer, "block bigint, part int, n1 bigint, n2 bigint, one binary, two binary"
        ),
        "lm-counts",
    )
    v, n = (x or 0 for x in answers.where("block = -1").agg(F.sum("n1"), F.sum("n2")).first())
    replies = answers.where("block >= 0").groupBy("block").agg(
        F.collect_list(F.struct("part", "n1", "n2", "one", "two")).alias("answers")
    )
    cells = (
        lean.join(replies, "block").mapInArrow(_held_out(n), "cell bigint, times bigint")
        .groupBy("cell").agg(F.sum("times").alias("times")).collect()
    )
    release(docs.sparkSession)
    weights = learn_weights([tuple(c) for c in cells], v, p)
    full = blocks.select("block", "keys", "held", "lengths", "vocabulary", "tokens").join(replies, "block")
    return full.mapInArrow(
        _scores(n, v, weights),
        f"key {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    ).withColumnRenamed("key", key)
