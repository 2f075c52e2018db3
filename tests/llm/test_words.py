import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from matchlake.llm import arrays


def split(text):
    return re.findall("[^\x20\x09-\x0d]+", text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té▁", max_size=30)), max_size=12))
def test_words_are_found_and_hashed_alike(texts):
    rows, hashes = [], []
    for w in arrays.words(pa.array(texts, pa.string())):
        rows.extend((w.row + w.lo).tolist())
        hashes.extend(w.hash.tolist())
    want = [(k, word) for k, t in enumerate(texts) for word in split(t or "")]
    assert rows == [k for k, _ in want]
    assert hashes == [arrays.hash_word(word) for _, word in want]


def test_long_texts_are_cut_at_separators(monkeypatch):
    monkeypatch.setattr(arrays, "CUT", 50)
    monkeypatch.setattr(arrays, "GROUP", 80)
    texts = ["x" * 200, "ab cd " * 60, "", None, "tail", "q" * 49 + " " + "r" * 51]
    got = [h for w in arrays.words(pa.array(texts)) for h in w.hash.tolist()]
    assert got == [arrays.hash_word(x) for t in texts for x in split(t or "")]


def test_extras_and_class_counts():
    col = pa.array(["Hello WORLD!", "", "a.b"])
    w = next(arrays.words(col, arrays.NOT_ALNUM, lower=True, extras={"begin": lambda p: p.prefix(2), "end": lambda p: p.suffix(2)}))
    assert w.per_row().tolist() == [2, 0, 2]
    again = next(arrays.words(pa.array(["help would"]), lower=True, extras={"begin": lambda p: p.prefix(2), "end": lambda p: p.suffix(2)}))
    assert w.more["begin"][0] == again.more["begin"][0]
    assert w.more["end"][1] == again.more["end"][1]
    upper = np.array([65 <= b <= 90 for b in range(256)])
    assert arrays.class_counts(col, [upper, arrays.WHITE]).tolist() == [[6, 1], [0, 0], [0, 0]]
