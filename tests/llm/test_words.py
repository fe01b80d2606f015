import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from binlens.llm.words import code_points, sub_batches, windows, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=" \n\t\x0b abAB.é🙂", max_size=40)), max_size=12)


@given(TEXTS)
@settings(max_examples=150, deadline=None)
def test_words_are_runs_outside_ascii_white_space(texts):
    arr = pa.array(texts, pa.string())
    w = words(arr)
    want = [(t or "").encode().split() for t in texts]
    got = [[w.text(j) for j in range(w.ptr[i], w.ptr[i + 1])] for i in range(len(texts))]
    assert got == want
    seen = {}
    for j in range(len(w.hashes)):
        assert seen.setdefault(int(w.hashes[j]), w.text(j)) == w.text(j)
    assert len(set(w.hashes.tolist())) == len({w.text(j) for j in range(len(w.hashes))})


@given(TEXTS, st.integers(1, 4))
@settings(max_examples=100, deadline=None)
def test_windows_match_brute_force(texts, size):
    w = words(pa.array(texts, pa.string()))
    hashes, first = windows(w, size, short_whole=True)
    meaning = {}
    for h, f in zip(hashes.tolist(), first.tolist()):
        doc = int(np.searchsorted(w.ptr, f, side="right") - 1)
        n = min(size, w.ptr[doc + 1] - f)
        assert meaning.setdefault(h, tuple(w.text(j) for j in range(f, f + n))) == tuple(w.text(j) for j in range(f, f + n))
    split = [(t or "").encode().split() for t in texts]
    want = {tuple(s[i:i + size]) for s in split for i in range(max(1, len(s) - size + 1)) if s}
    assert set(meaning.values()) == want


def test_lower_case_touches_only_ascii():
    a, b, c = words(pa.array(["ÄB ab", "äb AB", "Äb"]), lower=True), None, None
    assert a.hashes[1] == a.hashes[3] and a.hashes[0] != a.hashes[2] and a.hashes[0] == a.hashes[4]


@given(TEXTS)
@settings(max_examples=50, deadline=None)
def test_code_points(texts):
    points, offsets = code_points(pa.array(texts, pa.string()))
    assert ["".join(map(chr, points[a:b])) for a, b in zip(offsets, offsets[1:])] == [t or "" for t in texts]


def test_slices_of_arrays_and_batches():
    arr = pa.array(["aa bb", "cc", None, "dd ee ff"]).slice(1)
    assert words(arr).counts.tolist() == [1, 0, 3]
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 50, 5, 5)])], names=["t"])
    assert [b.num_rows for b in sub_batches(batch, "t", 20)] and sum(b.num_rows for b in sub_batches(batch, "t", 20)) == 4
