"""Token counts under a unigram vocabulary, with one trie of distinct pre-tokens per task.

A pre-token is a word with the vocabulary's word mark before it. The best segmentation of a pre-token maximises the sum
of its pieces' scores; the forward score of a prefix depends on that prefix only, so it is computed once per trie node
and shared by every word that starts that way. A word's token count sits at its terminal node. Documents never leave
their task: nothing is shuffled, and a task's trie is rebuilt when it reaches ``most_nodes``, which costs time but
never changes a count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventloom.llm.words import slices, split_words

WORD_MARK = "▁"
#: A longer word gets its scores without nodes of its own.
LONGEST_SHARED = 200


def load_pieces(path: str) -> dict[str, float]:
    """Pieces of a SentencePiece file with log probabilities by Zipf's law over their rank.

    The file orders its pieces by merge rank and has no probabilities; byte and control pieces are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    mass = sum(1 / rank for rank in range(1, len(plain) + 1))
    return {piece: -math.log(rank * mass) for rank, piece in enumerate(plain, 1)}


class Trie:
    """Forward scores and token counts by prefix.

    A character that no piece covers costs ``unknown`` and counts as its UTF-8 bytes. Of segmentations with equal
    scores the one with fewer tokens counts.
    """

    def __init__(self, pieces: dict[str, float], most_nodes: int = 600_000) -> None:
        self.most_nodes = most_nodes
        # every ending of a piece, with the score of those that are pieces: where an ending is missing, no longer
        # piece can end
        self.endings: dict[str, float | None] = {piece[k:]: None for piece in pieces for k in range(1, len(piece))}
        self.endings.update(pieces)
        self.unknown = min(pieces.values(), default=0.0) - 10.0
        self.clear()

    def clear(self) -> None:
        """Forget all words; a node holds a prefix's best score and its token count, negative."""
        self.child: dict[tuple[int, str], int] = {}
        self.forward: list[tuple[float, int]] = [(0.0, 0)]
        self.terminal: dict[bytes, int] = {}

    def _step(self, word: str, end: int, path: list[tuple[float, int]]) -> tuple[float, int]:
        """Best score and token count (negative) of the first ``end`` characters, from those of shorter prefixes."""
        score, tokens = path[end - 1]
        best = (score + self.unknown, tokens - len(word[end - 1].encode()))
        endings = self.endings
        for begin in range(end - 1, -1, -1):
            value = endings.get(word[begin:end], False)
            if value is False:
                break
            if value is not None:
                score, tokens = path[begin]
                score += value
                if score > best[0] or (score == best[0] and tokens - 1 > best[1]):
                    best = (score, tokens - 1)
        return best

    def count(self, raw: bytes) -> int:
        """Tokens of a word given as UTF-8."""
        found = self.terminal.get(raw)
        if found is not None:
            return found
        if len(self.forward) >= self.most_nodes:
            self.clear()
        word = WORD_MARK + raw.decode("utf-8", "replace")
        forward, child, node, end = self.forward, self.child, 0, 0
        path, shared = [forward[0]], len(word) <= LONGEST_SHARED
        for end, letter in enumerate(word if shared else "", 1):
            known = child.get((node, letter))
            if known is None:
                known = child[node, letter] = len(forward)
                forward.append(self._step(word, end, path))
            node = known
            path.append(forward[node])
        for end in range(len(path), len(word) + 1):
            path.append(self._step(word, end, path))
        tokens = -path[-1][1]
        if shared:
            self.terminal[raw] = tokens
        return tokens


def _counter(pieces, text: str, most_nodes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(pieces.value, most_nodes)
        for batch in batches:
            for part in slices(batch, text):
                words = split_words(part.column(text))
                _, at, which = np.unique(words.hash, return_index=True, return_inverse=True)
                raw, count = words.data.tobytes(), trie.count
                ranges = zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)
                each = np.fromiter((count(raw[a:b]) for a, b in ranges), np.int64, len(at))[which]
                total = np.concatenate([[0], np.cumsum(each)])
                tokens = total[words.first[1:]] - total[words.first[:-1]]
                keep = [c for c in part.schema.names if c != text]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + [pa.array(words.counts), pa.array(tokens)],
                    [*keep, "n_words", "n_tokens"],
                )

    return run


def count_tokens(
    docs: DataFrame, pieces: dict[str, float], text: str = "text", most_nodes: int = 600_000
) -> DataFrame:
    """``docs`` without ``text``, with ``n_words`` and ``n_tokens`` of the whole text.

    NULL and blank texts have none of either. The vocabulary is broadcast: its size is that of a file the driver has
    read. Repeated rows are counted alike, an empty table stays empty. Columns named like the result are replaced.
    """
    docs = docs.drop("n_words", "n_tokens")
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text)
    schema = f"{fields}{', ' if fields else ''}n_words bigint, n_tokens bigint"
    return docs.mapInArrow(_counter(shared, text, most_nodes), schema)
