import numpy as np
import pyarrow as pa
import pytest

from osm_tables.llm import text as T
from tests.llm.helpers import odd_docs, words


def hashes_by_word(texts):
    data, at = T.flat(pa.array(texts, pa.string()))
    out, counts = T.word_hashes(data, at)
    return out, counts


def test_words_are_told_apart_and_counted():
    texts = [t for _, t in odd_docs()]
    hashes, counts = hashes_by_word(texts)
    expected = [words(t, fold=True) for t in texts]
    assert counts.tolist() == [len(x) for x in expected]
    known = {}
    for h, w in zip(hashes.tolist(), (w for x in expected for w in x)):
        assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


@pytest.mark.parametrize("text", ["ab cd  " * 400_000, "x" * 3_000_000, " " * 3_000_000, "é ö\n" * 500_000])
def test_long_texts_are_worked_through_in_segments(text):
    hashes, counts = hashes_by_word([text])
    expected = words(text)
    assert counts.tolist() == [len(expected)]
    short = dict(zip(sorted(set(expected)), (hashes_by_word([w])[0][0] for w in sorted(set(expected)))))
    assert all(h == short[w] for h, w in zip(hashes[-50:], expected[-50:]))


def test_slices_cover_all_texts():
    at = np.cumsum([0, 5, 0, 700_000, 1, 1, 2_000_000, 0])
    found = list(T.slices(at))
    assert found[0][0] == 0 and found[-1][1] == len(at) - 1
    assert all(x[1] == y[0] for x, y in zip(found, found[1:]))


def test_per_text_handles_empty_texts():
    out = T.per_text(np.array([1, 2, 3]), np.array([0, 2, 0, 1, 0]))
    assert out.tolist() == [0, 3, 0, 3, 0]
