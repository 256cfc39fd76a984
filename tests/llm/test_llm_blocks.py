import numpy as np
import pyarrow as pa

from millrace.llm.blocks import hashed_words, text_groups


def test_words_are_split_lowered_and_hashed_alike():
    texts = ["A b\tc", None, "", "  b A\x0bzz ", "\x1cq É é"]
    (first, last, words, offsets), = hashed_words(pa.array(texts, pa.string()))
    assert (first, last) == (0, 5)
    assert np.diff(offsets).tolist() == [3, 0, 0, 3, 3]
    a, b, c = words[:3]
    assert words[3:5].tolist() == [b, a]
    assert len({*words.tolist()}) == 7  # É is not lowered, 0x1C is no blank


def test_hash_does_not_depend_on_the_place_or_the_block():
    texts = ["word " * 40, "x" * 3_000_000, "word"]
    seen = {}
    for first, last, words, offsets in hashed_words(pa.array(texts)):
        for i in range(first, last):
            seen[i] = words[offsets[i - first] : offsets[i - first + 1]]
    assert set(seen[0].tolist()) == set(seen[2].tolist()) and len(seen[1]) == 1


def test_groups_cover_all_texts():
    bounds = np.array([0, 5, 5, 30, 31, 32])
    assert list(text_groups(bounds, 10)) == [(0, 2), (2, 3), (3, 5)]
    assert list(text_groups(np.zeros(1, int), 10)) == []
