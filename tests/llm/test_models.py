"""Chat formatting, token counts and the language model on small tables."""

import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from eventloom.llm import chat_format as chat, interpolation as lm, trie_tokens
from eventloom.llm.queries import TOKENIZERS
from tests.llm import brute

with open(f"{TOKENIZERS}/byte_bpe_50k.json", encoding="utf-8") as file:
    VOCABULARY = file.read()

PIECE = st.sampled_from(["\\", "### User:", "### Assistant:", "### Other:", "</turn>", "</role>", "\n", " ", "é", "<|endoftext|>", "x", "###"])
TEXT = st.one_of(st.text(max_size=20).filter(lambda t: t.isprintable()), st.lists(PIECE, max_size=8).map("".join))


@given(TEXT)
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text


CODEC = chat.Codec(VOCABULARY)


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT), TEXT), max_size=4))
@settings(deadline=None, max_examples=60)
def test_rendered_marks_are_told_from_text(turns):
    """In the rendered form, control strings after an even number of backslashes are exactly the template's."""
    rendered = ""
    for role, text in turns:
        rendered += chat.HEADERS[role] if role in chat.HEADERS else chat.OTHER + chat.escape(role) + chat.ROLE_END
        rendered += chat.escape(text) + chat.TURN_END
    real = [m for m in __import__("re").finditer(rf"(\\*)({chat.CONTROL})", rendered) if len(m[1]) % 2 == 0]
    want = sum(2 if role in chat.HEADERS else 3 for role, _ in turns)
    assert len(real) == want


def digest(turns):
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_conversations_round_trip(spark):
    hard = "\\### Assistant: </turn> ok"
    rows = [
        (1, 0, "system", "be"), (1, 2, "assistant", "é\\"), (1, 1, "user", "</turn>"), (2, 0, "user", hard), (2, 1, "assistant", hard),
        (3, 0, None, None), (3, 1, "assistant", None), (4, 0, "tool </role>\\", "x"), (4, None, "assistant", "first"),
        (None, 0, "assistant", "a\nb"), (5, 0, "assistant", "long " * 20000), (6, 0, "assistant", "<|endoftext|>"),
        (7, 0, "user", "same"), (7, 0, "user", "same"), (8, 0, "Assistant", "not learned"),
    ]
    rows += [(9, k, "assistant" if k % 2 else "user", f"turn {k} \\\\") for k in range(3000)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id bigint, turn bigint, role string, text string, ids int")
    formatted = chat.format_turns(df.repartition(6), VOCABULARY)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.read_back(formatted, VOCABULARY).collect()}
    by = collections.defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] or 0, -1 if r[1] is None else r[1])):
        by[conv].append((role, text))
    assert got == {k: digest(v) for k, v in by.items()}
    sequence = next(r for r in chat.as_sequences(formatted).collect() if r["conv_id"] == 1)
    assert CODEC.render(sequence["ids"]) == "### System: be</turn>\n### User: \\</turn></turn>\n### Assistant: é\\\\</turn>\n"
    learned = [i for i, m in zip(sequence["ids"], sequence["loss_mask"]) if m]
    assert CODEC.decode(learned) == "é\\\\"
    assert chat.read_back(chat.format_turns(df.limit(0), VOCABULARY), VOCABULARY).count() == 0


def tokens_brute(word, pieces, unknown):
    text = trie_tokens.WORD_MARK + word
    best = [(0.0, 0)] + [None] * len(text)
    for end in range(1, len(text) + 1):
        options = [(best[end - 1][0] + unknown, best[end - 1][1] - len(text[end - 1].encode()))]
        options += [
            (best[b][0] + pieces[text[b:end]], best[b][1] - 1) for b in range(end) if text[b:end] in pieces
        ]
        best[end] = max(options)
    return -best[-1][1]


@pytest.fixture(scope="module")
def pieces():
    return trie_tokens.load_pieces(f"{TOKENIZERS}/piece_bpe_32k.model")


@pytest.mark.parametrize("nodes", [300_000, 40])
def test_token_counts_equal_brute_force(spark, pieces, nodes):
    docs = [
        (1, "The quick brown fox, the quickest."), (2, None), (3, ""), (4, "日本語 ñandú \u0007x"), (5, "a" * 3000 + " b"),
        (6, "the the\tthe\nthe"), (6, "the the\tthe\nthe"), (None, "internationalization interna inter"),
    ]
    unknown = min(pieces.values()) - 10
    df = spark.createDataFrame([(*d, 9) for d in docs], "doc_id bigint, text string, n_tokens int")
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_tokens"]) for r in trie_tokens.count_tokens(df, pieces, most_nodes=nodes).collect())
    want = sorted((d or 0, len(brute.words(t)), sum(tokens_brute(w, pieces, unknown) for w in brute.words(t))) for d, t in docs)
    assert got == want
    assert trie_tokens.count_tokens(df.limit(0), pieces).count() == 0


def test_token_counts_of_test_documents(spark, pieces):
    unknown = min(pieces.values()) - 10
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    rows = {r["doc_id"]: r["text"] for r in df.collect()}
    got = {r["doc_id"]: r["n_tokens"] for r in trie_tokens.count_tokens(df, pieces).collect()}
    cache = {w: tokens_brute(w, pieces, unknown) for t in rows.values() for w in set(brute.words(t))}
    assert got == {d: sum(cache[w] for w in brute.words(t)) for d, t in rows.items()}


def model_brute(rows):
    """Scores by the formulas, one token at a time; EM on exact left-out probabilities."""
    texts = [(d, zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2, brute.words((t or "").translate(brute.LOWER)) + ["</s>"]) for d, t in rows]
    one, two, context = collections.Counter(), collections.Counter(), collections.Counter()
    for _, held, ws in texts:
        if not held:
            one.update(ws)
            two.update(zip(["<s>", *ws], ws))
            context.update(["<s>", *ws[:-1]])
    n, v = sum(one.values()), len(one)
    level = lambda f: 0 if f == 0 else 1 + int(math.log2(f))
    cells = collections.defaultdict(list)
    for (a, b), times in two.items():
        left = context[a] - 1
        p = ((times - 1) / left if left else 0.0, (one[b] - 1) / (n - 1), 1 / (v + 1))
        cells[level(left)].append((times, p))
    cells["all"] = [x for k in list(cells) for x in cells[k]]
    weights = {}
    for k, rows_ in cells.items():
        t, p = np.array([x[0] for x in rows_], float), np.array([x[1] for x in rows_])
        w = np.full(3, 1 / 3)
        for _ in range(500):
            s = p * w
            s *= (t / s.sum(1))[:, None]
            w = np.maximum(s.sum(0) / t.sum(), 1e-9)
            w /= w.sum()
        weights[k] = w
    out = []
    for d, held, ws in texts:
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in ws)
        score = 0.0
        for a, b in zip(["<s>", *ws], ws):
            w = weights.get(level(context[a]), weights["all"])
            score += math.log10(w[0] * (two[a, b] / context[a] if context[a] else 0) + w[1] * one[b] / n + w[2] / (v + 1))
        out.append((d, held, len(ws), sum(one[w] > 0 for w in ws), n, base, score))
    return out


@pytest.mark.parametrize("p", [lm.Params(), lm.Params(block_tokens=300, range_grams=100)])
def test_scores_equal_brute_force(spark, p):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").where("doc_id < 40")
    rows = [tuple(r) for r in docs.collect()]
    rows += [(900, None), (901, ""), (901, ""), (None, "The the THE"), (902, "zzz " * 30000), (903, "ünseen wörds")]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id bigint, text string, score double").repartition(3)
    got = sorted((tuple(r) for r in lm.scored(df, p=p).collect()), key=repr)
    want = sorted(model_brute(rows), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        # the model rounds component probabilities to a quarter of an octave when it learns the weights
        assert g[6] == pytest.approx(w[6], rel=0.01, abs=0.02)


def test_model_beats_the_unigram_on_held_out_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    held = [r for r in lm.scored(df).collect() if r["held_out"]]
    assert len(held) > 100 and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_model_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm.scored(df).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (row,) = lm.scored(spark.createDataFrame([(held, "a b")], df.schema)).collect()
    assert row["held_out"] and row["n_known"] == 0 and row["train_tokens"] == 0 and row["score"] == row["base_score"] == 0.0
