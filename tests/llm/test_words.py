from __future__ import annotations

import numpy as np

from tickloom.llm import words as w


def of(*texts: bytes, lower: bool = False) -> w.Words:
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    return w.Words(data, np.array([len(t) for t in texts]), lower=lower)


def test_words_are_told_apart_and_found_again(monkeypatch):
    texts = [b"a bb a\t ccc", b"", b"  ", b"bb\x0bA a\xc3\xa9", b"x" * 70 + b" a"]
    whole = of(*texts)
    assert whole.counts.tolist() == [4, 0, 0, 3, 2]
    parts = [t.split() for t in texts]
    flat = [x for p in parts for x in p]
    by = {}
    for word, print_ in zip(flat, whole.prints, strict=True):
        assert by.setdefault(word, print_) == print_
    assert len(set(by.values())) == len(by)
    # The segments that bound the memory change nothing.
    monkeypatch.setattr(w, "_SEGMENT", 5)
    assert np.array_equal(of(*texts).prints, whole.prints)
    assert np.array_equal(w.windows(whole.prints, 2), w.windows(of(*texts).prints, 2))


def test_lower_case_is_ascii_only():
    a, b = of("ABC É".encode(), lower=True).prints, of("abc é".encode(), lower=True).prints
    assert a[0] == b[0] and a[1] != b[1]


def test_windows_depend_on_order_and_place_in_the_text():
    words = of(b"a b c a b c b a", b"a b")
    found = w.windows(words.prints, 2)
    assert found[0] == found[3] == found[8] and found[0] != found[6]
    assert words.window_starts(2).tolist() == [True] * 7 + [False, True, False]
    assert w.windows(words.prints, 2)[0] != w.windows(words.prints, 2, second=True)[0]
    assert len(w.windows(words.prints, 99)) == 0
