"""Conversations as token ids with a loss mask, assembled from separately encoded segments.

Each turn is a header, its text and an end mark. Header and end mark are reserved ids beyond the vocabulary, spliced
between the ids of the text, so no text can produce them. In the rendered form they are control strings; where a text
contains one, it is escaped, and reading back undoes that.

Escape rule: n backslashes before a control string become 2n + 1, and n backslashes at the very end of a text become
2n. An odd number before a control string hence marks text, an even number a real mark.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: The template. Role names and what their turns begin with; other roles are spelled out after OTHER.
HEADERS = {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "}
OTHER, ROLE_END, TURN_END = "### Other: ", "</role> ", "</turn>\n"
MARKS = (*HEADERS.values(), OTHER, ROLE_END, TURN_END)
CONTROL = r"### (?:System|User|Assistant|Other):|</role>|</turn>"
LEARNED_ROLE = "assistant"

_ESCAPE = re.compile(rf"(\\*)({CONTROL})|(\\+)\Z")


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[3] * 2 if m[3] else m[1] * 2 + "\\" + m[2], text)


def unescape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[3][: len(m[3]) // 2] if m[3] else m[1][: len(m[1]) // 2] + m[2], text)


class Codec:
    """Ids of plain text by a byte-level vocabulary, plus one reserved id per mark of the template."""

    def __init__(self, vocabulary: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.first = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ids = {mark: self.first + i for i, mark in enumerate(MARKS)}
        self.marks = {i: mark for mark, i in self.ids.items()}
        self.roles = {self.ids[mark]: role for role, mark in HEADERS.items()}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def decode(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    def render(self, ids: list[int]) -> str:
        """The text form of a sequence, marks included."""
        out, run = [], []
        for i in ids:
            if i in self.marks:
                out += [self.decode(run), self.marks[i]]
                run = []
            else:
                run.append(i)
        return "".join([*out, self.decode(run)])

    def parse(self, ids: np.ndarray, learned: np.ndarray) -> Iterator[tuple[str, str, str]]:
        """Role, text and the part of the text under the loss mask of each turn, unescaped."""
        begin = 0
        for end in np.flatnonzero(ids == self.ids[TURN_END]).tolist():
            head, at = int(ids[begin]), begin + 1
            if head in self.roles:
                role = self.roles[head]
            else:
                at = begin + int(np.flatnonzero(ids[begin:end] == self.ids[ROLE_END])[0]) + 1
                role = unescape(self.decode(ids[begin + 1 : at - 1].tolist()))
            body = ids[at:end]
            under = body[learned[at:end] == 1]
            text = unescape(self.decode(body.tolist()))
            loss = text if len(under) == len(body) else unescape(self.decode(under.tolist()))
            yield role, text, loss if len(under) else ""
            begin = end + 1


def _encoder(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                roles = [r or "" for r in part.column("role").to_pylist()]
                texts = codec.encode([escape(t or "") for t in part.column("text").to_pylist()])
                odd = codec.encode([escape(r) for r in roles])
                pieces, lengths, starts = [], [], []
                for role, text, name in zip(roles, texts, odd, strict=True):
                    head = [codec.ids[HEADERS[role]]] if role in HEADERS else [codec.ids[OTHER], *name, codec.ids[ROLE_END]]
                    pieces += [head, text, [codec.ids[TURN_END]]]
                    lengths.append(len(head) + len(text) + 1)
                    starts.append(len(head))
                ids = np.fromiter((i for piece in pieces for i in piece), np.int32)
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                # the loss mask: +1 where a learned text begins, -1 where it ends, summed up
                step = np.zeros(len(ids) + 1, np.int8)
                learned = np.array([r == LEARNED_ROLE for r in roles], np.int8)
                np.add.at(step, offsets[:-1] + np.array(starts), learned)
                np.add.at(step, offsets[1:] - 1, -learned)
                mask = np.cumsum(step[:-1], dtype=np.int8)
                lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (ids, mask)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), part.column("turn"), *lists], ["conv_id", "turn", "ids", "loss_mask"]
                )

    return run


def format_turns(turns: DataFrame, vocabulary: str) -> DataFrame:
    """Each row of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``) as ``ids`` and ``loss_mask`` of equal length.

    A conversation is the concatenation of its rows by ``turn`` (ties: by ids, so the order does not depend on the
    input). The mask is 1 on the texts of the assistant, 0 elsewhere. NULL role and text are empty; rows without a
    conversation id form one; other columns are ignored. ``vocabulary`` is the JSON of a byte-level tokenizer, whose
    size bounds the broadcast.
    """
    shared = turns.sparkSession.sparkContext.broadcast(vocabulary)
    kinds = {f.name: f.dataType.simpleString() for f in turns.schema}
    narrow = turns.select("conv_id", "turn", F.col("role").cast("string"), F.col("text").cast("string"))
    return narrow.mapInArrow(
        _encoder(shared),
        f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, ids array<int>, loss_mask array<tinyint>",
    )


def as_sequences(formatted: DataFrame) -> DataFrame:
    """One row per conversation with all its ``ids`` and ``loss_mask``, for conversations that fit a row."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "ids", "loss_mask")))
    return formatted.groupBy("conv_id").agg(turns.alias("t")).select(
        "conv_id", F.flatten("t.ids").alias("ids"), F.flatten("t.loss_mask").alias("loss_mask")
    )


DIGEST = (
    "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, "
    "n_tokens bigint, n_loss_tokens bigint"
)


def _reader(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary.value)
        now, state, done = object(), None, []

        def flush() -> pa.RecordBatch:
            names = ["conv_id", *(f.split()[0] for f in DIGEST.split(", "))]
            columns = list(zip(*done, strict=True))
            done.clear()
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        def close() -> None:
            if state is not None:
                turns, loss = state[1].hexdigest(), state[3].hexdigest()
                done.append((now, state[0], turns, state[2], loss, *state[4:]))

        for batch in batches:
            kind = batch.column("conv_id").type
            ids, mask = batch.column("ids"), batch.column("loss_mask")
            for row, conv in enumerate(batch.column("conv_id").to_pylist()):
                if conv != now:
                    close()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                one = ids[row].values.to_numpy()
                learned = mask[row].values.to_numpy()
                for role, text, loss in codec.parse(one, learned):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    state[2] += len(loss)
                    state[3].update(loss.encode())
                state[4] += len(codec.render(one.tolist()))
                state[5] += len(one)
                state[6] += int(learned.sum())
            if len(done) >= 1000:
                yield flush()
        close()
        if done:
            yield flush()

    return run


def read_back(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """Per conversation the turns, texts and lengths found in its ids and mask alone, as digests.

    The rows of a conversation pass a task in order and are digested one by one, so a very long conversation needs no
    more memory than a short one.
    """
    shared = formatted.sparkSession.sparkContext.broadcast(vocabulary)
    kind = formatted.schema["conv_id"].dataType.simpleString()
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "ids")
    return ordered.mapInArrow(_reader(shared), f"conv_id {kind}, {DIGEST}")
