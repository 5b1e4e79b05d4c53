import numpy as np
import pyarrow as pa
import pytest

from codexmill.llm import fmindex, textkit
from codexmill.llm.textkit import ALNUM, BLANK, Hasher
from tests.llm.brute import LOWER, blanks


@pytest.mark.parametrize("lower", [False, True])
def test_words_are_told_apart(lower, monkeypatch):
    texts = ["a b  c\n", "", None, "A É é ü", "long" * 300 + " b " + "c" * 700, "b a", " ", "x" * 5000]
    monkeypatch.setattr(textkit, "PIECE", 256)  # so that pieces, cuts and words beyond a piece come about
    hasher, seen, got = Hasher(BLANK, lower), {}, []
    for lo, hi, words, starts in hasher.rows(pa.array(texts)):
        assert len(starts) == hi - lo + 1
        got += [words[i:j].tolist() for i, j in zip(starts[:-1], starts[1:], strict=True)]
    for text, hashes in zip(texts, got, strict=True):
        expected = blanks((text or "").translate(LOWER) if lower else text)
        assert len(expected) == len(hashes)
        for w, h in zip(expected, hashes, strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_beginnings(monkeypatch):
    monkeypatch.setattr(textkit, "PIECE", 64)
    texts = ["prefixes prefixed pre", "a " * 60 + "prefix", "", "x" * 300 + " prefab"]
    hasher, got = Hasher(ALNUM, True, prefix=6), []
    for _, _, words, starts in hasher.rows(pa.array(texts)):
        assert words.shape == (2, starts[-1])
        got += [words[:, i:j] for i, j in zip(starts[:-1], starts[1:], strict=True)]
    first = got[0][1]
    assert first[0] == first[1] == got[1][1][-1] != first[2] and got[3][1][1] not in first and len(set(got[0][0].tolist())) == 3


def test_alnum_and_slices():
    column = pa.array(["x", "Don't stop-é1", None]).slice(1)
    ((_, _, words, starts),) = list(Hasher(ALNUM, True).rows(column))
    assert starts.tolist() == [0, 4, 4]


def test_grams_differ_by_order():
    words = Hasher(BLANK, False).piece(np.frombuffer(b"a b a b b a", "u1"), np.zeros(0, int))[0]
    g = textkit.grams(words, 2).tolist()
    assert g[0] == g[2] and g[1] == g[4] and len(set(g)) == 3 and len(textkit.grams(words, 7)) == 0


@pytest.mark.parametrize("sigma,n,length", [(2, 400, 5), (4, 1000, 9), (60, 3000, 3), (1, 90, 35)])
def test_fm_index_counts(sigma, n, length):
    rng = np.random.default_rng(n)
    text = np.append(rng.integers(1, sigma + 1, n), 0)
    starts = np.arange(n - length + 1)
    got = fmindex.FMIndex(text, sigma + 1, length + 1).repeated(text, starts, length)
    all_windows = [tuple(text[s : s + length]) for s in starts]
    assert got.tolist() == [all_windows.count(w) > 1 for w in all_windows]


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from codexmill.llm.common import one_machine

    assert all(one_machine(m) for m in ("local", "local[4]", "local[*]", "local[4, 2]"))
    assert not any(one_machine(m) for m in ("local-cluster[3,2,1024]", "yarn", "spark://host:7077", "k8s://host"))
