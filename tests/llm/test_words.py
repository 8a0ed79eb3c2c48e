import pyarrow as pa
import pytest

from dealerlake.llm import words as W


@pytest.mark.parametrize("text", ["", "a", "a b", "a b c", "a b c d", "a b c d e"])
def test_shingles_of_a_slice_shorter_than_they_are(text):
    _, data, offsets = next(W.slices(pa.array([text])))
    run, total = W.shingles(*W.words(data, offsets), 5)
    assert len(run) == total[-1] == min(len(text.split()), 1)
