import re

import numpy as np
from hypothesis import given, settings, strategies as st

from lendscope.llm import words

ASCII = {65 + i: 97 + i for i in range(26)}


def reference(text, pattern):
    return re.findall(pattern, text.translate(ASCII))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aB z9.\n\té漢_-", max_size=60), max_size=6))
def test_words_match_the_pattern(texts):
    for table, pattern in ((words.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (words.NONSPACE, r"[^\x20\x09-\x0D]+")):
        h, offsets = words.hash_words([t.encode() for t in texts], table)
        expected = [reference(t, pattern) for t in texts]
        assert np.diff(offsets).tolist() == [len(e) for e in expected]
        by_word = {}
        for hashed, word in zip(h.tolist(), [w for e in expected for w in e], strict=True):
            assert by_word.setdefault(word, hashed) == hashed
        assert len(set(by_word.values())) == len(by_word)


def test_long_texts_are_cut_between_words():
    text = ("word%d " * 400_000) % tuple(range(400_000))
    h, offsets = words.hash_words([b"x", text.encode(), b"y"], words.NONSPACE)
    assert np.diff(offsets).tolist() == [1, 400_000, 1] and len(set(h.tolist())) == 400_002
    giant = b"g" * (3 << 20)
    h, offsets = words.hash_words([giant, b"a " + giant], words.NONSPACE)
    assert np.diff(offsets).tolist() == [1, 2] and h[0] == h[2]


def test_windows_stay_inside_a_text():
    h, o = words.hash_words([b"a b c", b"a b", b"", b"z a b c"], words.NONSPACE)
    w, wo = words.windows(h, o, 3)
    assert np.diff(wo).tolist() == [1, 0, 0, 2] and w[0] == w[2] != w[1]
