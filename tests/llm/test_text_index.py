import numpy as np
import pytest

from tilespark.llm.text_index import RunIndex, WaveletIndex, earlier_matches


def brute(patterns, least):
    """Positions of each pattern covered by a window that also stands at a smaller (pattern, place)."""
    seen, covered = {}, [set() for _ in patterns]
    for p, s in enumerate(patterns):
        for i in range(len(s) - least + 1):
            w = tuple(s[i : i + least])
            if w in seen:
                covered[p].update(range(i, i + least))
            else:
                seen[w] = (p, i)
    return covered


@pytest.mark.parametrize("kind", [WaveletIndex, RunIndex])
@pytest.mark.parametrize("seed", range(30))
def test_earlier_matches_equal_brute_force(kind, seed):
    rng = np.random.default_rng(seed)
    symbols, least = int(rng.integers(1, 6)), int(rng.integers(2, 7))
    base = rng.integers(1, symbols + 1, 60)
    patterns = []
    for _ in range(int(rng.integers(1, 12))):
        a = int(rng.integers(0, 40))
        s = base[a : a + int(rng.integers(0, 20))].copy()
        if len(s) and rng.random() < 0.6:
            s[rng.integers(len(s))] = rng.integers(1, symbols + 1)
        patterns.append(s)
    text = np.concatenate([np.append(s, 0) for s in patterns]).astype(np.uint8 if kind is RunIndex else np.int64)
    length = np.array([len(s) for s in patterns])
    start = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
    keys = np.arange(len(text)).astype(np.int32)
    got = [set() for _ in patterns]
    for p, a, b in zip(*earlier_matches(kind, text, symbols, keys, keys, start, length, least)):
        assert b - a >= least
        got[p].update(range(a, b))
    assert got == brute(patterns, least)
