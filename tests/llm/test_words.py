import numpy as np
import pyarrow as pa
from corpus import ODD
from hypothesis import given, settings
from hypothesis import strategies as st

from tickertone.llm import words as W


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\x1c\x85 😀")), max_size=8), st.integers(1, 40))
def test_words_are_those_between_ascii_spaces(texts, size):
    column = pa.array(["pad"] + texts, pa.string()).slice(1)
    seen = []
    for part in W.texts(column, size):
        starts, ends, first = W.split_words(part)
        for i in range(len(part)):
            own = slice(first[i], first[i + 1])
            seen.append([part.data[a:b].tobytes() for a, b in zip(starts[own], ends[own], strict=True)])
    assert seen == [(t or "").encode().split() for t in texts]


def test_equal_spans_have_equal_hashes_everywhere():
    words = [f"w{i % 50}é" for i in range(2000)]
    part = next(W.texts(pa.array([" ".join(words)])))
    starts, ends, _ = W.split_words(part)
    hashes = W.span_hashes(part.data, starts, ends)
    assert len(np.unique(hashes)) == 50
    grams = W.runs_of(hashes, 4)
    assert len(np.unique(grams)) == 50 and (grams[:50] == grams[50:100]).all()


def test_odd_texts():
    for part in W.texts(pa.array(ODD, pa.string()), 10):
        W.split_words(part)
