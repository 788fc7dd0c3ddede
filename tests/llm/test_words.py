import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from eventloom.llm.words import gram_hashes, gram_starts, slices, sliding_argmin, split_words
from tests.llm import brute

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\t\n\x0b\u00a0\u2003Z", max_size=40)), max_size=8)


@given(TEXTS)
@settings(deadline=None)
def test_words_are_those_of_the_pattern(texts):
    words = split_words(pa.array(texts, pa.string()))
    found = [
        [x.decode() for x in words.strings(a, b)] for a, b in zip(words.first, words.first[1:], strict=False)
    ]
    assert found == [brute.words(t) for t in texts]
    flat = [x for t in found for x in t]
    assert len(set(words.hash.tolist())) == len(set(flat))
    for t, (a, b) in zip(texts, zip(words.first, words.first[1:], strict=False), strict=True):
        assert words.joined(np.arange(a, b)).decode() == " ".join(brute.words(t))


def test_hashes_do_not_depend_on_the_place():
    one = split_words(pa.array(["x y z", "Q x y z w"]))
    grams = gram_hashes(one.hash, 3)
    assert grams[0] == grams[4] and grams[0] != grams[5]
    assert gram_starts(one, 3).tolist() == [0, 3, 4, 5]
    sliced = split_words(pa.array(["no", "x y z"]).slice(1))
    assert (sliced.hash == one.hash[:3]).all()


def test_lower_case_is_ascii_only():
    words = split_words(pa.array(["ÀB", "Àb"]), lower=True)
    assert words.hash[0] == words.hash[1]
    assert split_words(pa.array(["à"])).hash[0] != words.hash[0]


@given(st.lists(st.integers(0, 5), min_size=1, max_size=60), st.integers(1, 9))
def test_sliding_argmin(keys, width):
    values = np.array(keys, np.uint64) << np.uint64(40)
    want = [i + int(np.argmin(keys[i : i + width])) for i in range(len(keys) - width + 1)]
    assert sliding_argmin(values, width).tolist() == want


def test_slices_hold_every_row_once():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 50, None, "b" * 500, "", "c"])], ["text"])
    parts = list(slices(batch, "text", 100))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert [p.num_rows for p in parts] == [2, 1, 2] or sum(p.num_rows for p in parts) == 5
