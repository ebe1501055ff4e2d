import random
import re

import numpy as np
import pyarrow as pa

from loomstat.llm import words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_words_and_shingles_equal_the_plain_way(monkeypatch):
    rng = random.Random(3)
    texts = [None, "", " ", "a", "\x0bA b\x0c", "x" * 5000, "é 一 z  q"]
    texts += ["".join(rng.choice("ab \n\té") for _ in range(rng.randrange(3000))) for _ in range(60)]
    for size in (1 << 20, 64, 7):
        monkeypatch.setattr(W.pieces, "__defaults__", (size,))
        h, first = W.word_hashes(pa.array(texts))
        plain = [WORD.findall(t or "") for t in texts]
        assert [len(p) for p in plain] == list(np.diff(first))
        name = {}
        for w, x in zip((w for p in plain for w in p), h):
            assert name.setdefault(w, x) == x
        assert len(set(name.values())) == len(name)
        g, begins = W.shingle_hashes(h, first, 3)
        grams = [[tuple(p[i : i + 3]) for i in range(max(1, len(p) - 2))] if p else [] for p in plain]
        assert [len(x) for x in grams] == list(np.diff(begins))
        name = {}
        for w, x in zip((w for p in grams for w in p), g):
            assert name.setdefault(w, x) == x
        assert len(set(name.values())) == len(name)


def test_only_ascii_capitals_are_lowered():
    h, _ = W.word_hashes(pa.array(["ABZ abz", "É é"]), lower=True)
    assert h[0] == h[1] and h[2] != h[3]


def test_slices_cover_all_rows():
    column = pa.array(["x" * n for n in (0, 10, 5_000_000, 3, 4_000_000)] + [None])
    cuts = list(W.slices(column))
    assert cuts[0][0] == 0 and cuts[-1][1] == 6 and all(b == c for (_, b), (c, _) in zip(cuts, cuts[1:]))
    assert list(W.slices(pa.array([], pa.string()))) == []
