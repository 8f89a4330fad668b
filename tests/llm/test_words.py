import re

import numpy as np
import pyarrow as pa
import pytest

from mercaflow.llm import words as W

TEXTS = [None, "", " \t\n", "a", "A b\tc\x0bD", "é-É x9 09", "q" * 1000 + " b", "q" * 999, "Stop stop. STOP", "a" * 17]
FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def expected(rule, text):
    data = (text or "").encode()
    if rule is W.PLAIN:
        return data.split()
    data = data.translate(FOLD)
    return data.split() if rule is W.LOWER else re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", data)


@pytest.mark.parametrize("rule", [W.PLAIN, W.LOWER, W.ALPHANUMERIC])
@pytest.mark.parametrize("slice_bytes", [1, 50, 1 << 20])
def test_words_equal_those_of_the_pattern(monkeypatch, rule, slice_bytes):
    monkeypatch.setattr(W, "SLICE_BYTES", slice_bytes)
    hash_of, word_of = {}, {}
    seen = 0
    for part in W.words_of(pa.array(TEXTS * 3), rule):
        for i in range(part.last - part.first):
            own = part.hashes[part.bounds[i] : part.bounds[i + 1]]
            words = expected(rule, (TEXTS * 3)[part.first + i])
            assert len(own) == len(words)
            for word, hashed in zip(words, own):
                assert hash_of.setdefault(word, hashed) == hashed
                assert word_of.setdefault(hashed, word) == word
            seen += 1
    assert seen == len(TEXTS) * 3


def test_equal_runs_have_equal_hashes():
    hashes = np.array([5, 7, 9, 5, 7, 9, 5], dtype=np.uint64)
    runs = W.Rolling(hashes).runs(np.array([0, 3, 1, 4]), np.array([3, 6, 3, 6]))
    assert runs[0] == runs[1] and runs[2] == runs[3] and runs[0] != runs[2]


def test_slices_of_rows_are_of_a_size():
    column = pa.array(["ab", None, "", "c" * 50, "d", "e" * 9, "é"])
    for size in (1, 5, 20, 1000):
        parts = list(W.row_slices(column, size))
        assert [x for _, part in parts for x in part.to_pylist()] == column.to_pylist()
        assert [first for first, _ in parts] == [0, *(first + len(part) for first, part in parts)][: len(parts)]
        assert all(sum(len(x or "") for x in part.to_pylist()[1:]) <= size for _, part in parts)
    assert list(W.row_slices(pa.array([], pa.string()), 5)) == []
