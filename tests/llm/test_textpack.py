"""Word boundaries, hashes and joining, against plain Python."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from unitgrid.llm import textpack
from unitgrid.llm.textpack import NOT_ALNUM, SPACE, Words, window_hashes


def texts(seed):
    rng = random.Random(seed)
    parts = ["a", "Bc", "é", "x" * 30, " ", "  ", "\n", "\t", "-", "1", "日本", " "]
    return [None, "", " ", "a", " a", "a "] + ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(60)]


@pytest.mark.parametrize("size", [1, 7, 50, 10**6])
def test_words_and_joining(size, monkeypatch):
    portions = Words._portions
    monkeypatch.setattr(Words, "_portions", lambda self, _=None: portions(self, size))
    for seed in range(5):
        col = pa.chunked_array([pa.array(texts(seed)[:20], pa.string()), pa.array(texts(seed)[20:], pa.string())])
        plain, alnum = Words(col, SPACE), Words(col, NOT_ALNUM, lower=True)
        expected = [brute.words(t) for t in texts(seed)]
        spelled = [plain.buf[a:b].tobytes() for a, b in zip(plain.start, plain.end)]
        assert spelled == [w for ws in expected for w in ws] and plain.counts.tolist() == [len(w) for w in expected]
        assert alnum.counts.tolist() == [len(brute.alnum(t)) for t in texts(seed)]
        assert plain.joined().to_pylist() == [b" ".join(w).decode() for w in expected]
        keep = np.random.default_rng(seed).random(len(spelled)) < 0.5
        kept, at = [], 0
        for ws in expected:
            kept.append(b" ".join(w for w, k in zip(ws, keep[at:at + len(ws)]) if k).decode())
            at += len(ws)
        assert plain.joined(keep).to_pylist() == kept
        by_word = {}
        for w, h in zip(spelled, plain.hashes().tolist()):
            assert by_word.setdefault(w, h) == h
        assert len(set(by_word.values())) == len(by_word)


def test_window_hashes_tell_windows_apart():
    h = textpack.mixed(np.array([1, 2, 3, 1, 2, 3, 1, 2, 9], np.uint64))
    for k in range(1, 8):
        got = window_hashes(h, k).tolist()
        windows = [tuple(h[i:i + k].tolist()) for i in range(len(h) - k + 1)]
        assert len(got) == len(windows) and all((a == b) == (x == y) for a, x in zip(got, windows) for b, y in zip(got, windows))
    assert len(window_hashes(h, 20)) == 0


def test_slices_keep_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n if n % 5 else None for n in range(50)])], ["text"])
    parts = list(textpack.slices([batch], 60))
    assert sum(p.num_rows for p in parts) == 50 and len(parts) > 5
