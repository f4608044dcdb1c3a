import numpy as np
import pyarrow as pa
from conftest_llm import words_of
from hypothesis import given, settings
from hypothesis import strategies as st

from rollcall.llm.texts import Memo, Words, digests, slices, sliding, windows

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\t é \x1c", max_size=12)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_runs_of_other_bytes(texts):
    words = Words(pa.array(texts, pa.string()))
    data = words.data.tobytes()
    found = [
        [data[a:b].decode() for a, b in zip(words.starts[x:y], words.ends[x:y])]
        for x, y in zip(words.bounds[:-1], words.bounds[1:])
    ]
    assert found == [words_of(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_hashes_and_digests_follow_the_words(texts):
    words = Words(pa.array(texts, pa.string()))
    hashes = words.hashes()
    known = {}
    for h, a, b in zip(hashes.tolist(), words.starts, words.ends):
        assert known.setdefault(words.data[a:b].tobytes(), h) == h
    assert len(set(known.values())) == len(known)
    code = [tuple(x) for x in digests(words, hashes).tolist()]
    same = [tuple(words_of(t)) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            assert (code[i] == code[j]) == (same[i] == same[j])


def test_words_of_a_slice_of_a_batch():
    column = pa.array(["a b", None, "", "c  d e", "f"], pa.string()).slice(1, 3)
    words = Words(column)
    assert words.counts.tolist() == [0, 0, 3]
    assert words.hashes().tolist() == Words(pa.array(["c d e"])).hashes().tolist()


def test_slices_keep_rows_whole_and_in_order():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 100, "", "c" * 5]})
    parts = list(slices([batch], limit=20))
    assert [p.num_rows for p in parts] == [2, 1, 2]
    assert sum((p.column("text").to_pylist() for p in parts), []) == batch.column("text").to_pylist()
    assert list(slices([batch.slice(0, 0)])) == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=30), st.integers(1, 9))
def test_sliding_minimum(values, size):
    values = np.array(values, np.int64)
    expected = [values[i : i + size].min() for i in range(len(values) - size + 1)]
    assert sliding(np.minimum, values, size).tolist() == expected


def test_windows_of_fewer_words_are_none():
    assert len(windows(np.arange(3, dtype=np.uint64), 5)) == 0


def test_memo_gives_the_same_whatever_it_forgot():
    memo = Memo(3)
    for keys in ([1, 5], [2, 5, 9], [1, 2, 3, 4, 5], [5], []):
        keys = np.array(keys, np.uint64)
        out = memo.get(keys, lambda i: keys[i].astype(np.int64) * 2)
        assert out.tolist() == (keys * np.uint64(2)).tolist()
