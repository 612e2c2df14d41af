import random
from itertools import combinations
from statistics import stdev

import numpy as np
import pytest

from cadenza.kernels.ctc import align, alignment_score, by_lengths, chunks, word_times
from cadenza.kernels.editops import edit_script
from cadenza.kernels.overlap import ratio
from cadenza.kernels.per import equalise, phoneme_errors
from cadenza.kernels.punctuation import parts_of, place_punctuation

LEXICON = {
    "hello": ["h e l l o", "h a l l o"],
    "guy": ["g a i"],
    "i": ["aɪ"],
    "am": ["æ m"],
    "bahrainian": ["b ɚ eɪ n i ə n", "b aɪ ɹ ɑ n i ə n", "b ɑ ɹ eɪ n i ə n"],
    "4806": ["f ɔ ɹ eɪ t oʊ s ɪ k s", "f ɔ eɪ t oʊ s ɪ k s", "f ɔ eɪ t z ɪ ɹ oʊ s ɪ k s", "f l ɔ ɹ eɪ t oʊ s ɪ k s"],
}
# Words, the phonemes said and the error rate.
GOLDEN = [
    ("i am bahrainian", "aɪ æ m b ɚ eɪ n i ə n", 0),
    ("i am bahrainian", "aɪ æ m b ɑ ɹ eɪ n i ə n", 0),
    ("hello guy", "h a l l o g a i", 0),
    ("hello guy", "h a l l X g a i", 1 / 8),
    ("hello guy", "h a l l X X X g a i", 3 / 8),
    ("hello guy", "h a X g a i", 3 / 8),
    ("hello guy", "h a l l X o g a i", 1 / 8),
    ("hello guy", "h a l l X X X o g a i", 3 / 8),
    ("hello guy", "h a l l g a i", 1 / 8),
    ("hello guy", "h a l g a i", 2 / 8),
    ("hello guy", "h e l l o g a i", 0),
    ("hello guy", "h X e X X l l o g a i", 3 / 8),
    ("hello guy", "h e X X l l o g a i", 2 / 8),
    ("hello guy", "h e o g a i", 2 / 8),
    ("hello guy", "h e X l o g a i", 1 / 8),
    ("hello guy hello", "h a l l o g a i h e l l o", 0),
    ("hello guy hello", "h a l l o g h e o", 4 / 13),
    ("hello guy hello", "h a l l X o g a i X h X e X l l o", 4 / 13),
    ("hello guy hello", "h a X o g X i h e l l X", 4 / 13),
    ("hello guy hello", "g a i h e l l o", 5 / 13),
    ("hello guy hello", "h a l X X X X a i h X l l o", 5 / 13),
    ("4806", "f ɔ ɹ eɪ t ə s ɪ k s", 2 / 14),
]


@pytest.mark.parametrize(("words", "said", "rate"), GOLDEN)
def test_phoneme_error_rate(words, said, rate):
    variants = [equalise([p.split() for p in LEXICON[w]]) for w in words.split()]
    errors, total = phoneme_errors(variants, said.split())
    assert errors / total == pytest.approx(rate)


def test_edit_script_is_shortest_and_right():
    rng = random.Random(1)
    for _ in range(400):
        a = [rng.choice("abc") for _ in range(rng.randint(0, 7))]
        b = [rng.choice("abc") for _ in range(rng.randint(0, 7))]
        ops = edit_script(a, b)
        d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
        assert len(ops) == d[-1][-1]
        out, at = [], 0
        for op, i, j in ops:
            out += a[at:i]
            at = i
            if op != "delete":
                out.append(b[j])
            if op != "insert":
                at += 1
        assert out + a[at:] == b


def test_punctuation_golden():
    first = "h h ɚ i d ʌ m b ɹ ɛ l ə ɪ z d͡ʒ ʌ s t ð ə b ɛ s t".split()
    truth = "h ɜː ɹ ɛ d ʌ m b ɹ ɛ l ə , ɪ z d͡ʒ ʌ s t ð ə b ɛ s t .".split()
    starts = [round(i * 0.1, 1) for i in range(len(first))]
    ends = [round(s + 0.05, 2) for s in starts]
    out = place_punctuation(first, starts, ends, truth)
    assert [t for t, _, _ in out] == [*first[:12], ",", *first[12:], "."]
    assert out[12] == (",", ends[11], starts[12])
    assert out[-1] == (".", ends[-1], ends[-1])


def test_punctuation_against_enumeration():
    rng = random.Random(2)
    for _ in range(60):
        texts = [rng.choice("abcd") for _ in range(rng.randint(4, 9))]
        truth = [rng.choice("abcd,.") for _ in range(9)] + ["a"]
        parts, clean = parts_of(truth)
        best, cut = -1.0, None
        for inner in combinations(range(1, len(texts)), len(clean) - 1):
            marks = (0, *inner, len(texts))
            pieces = [texts[a:b] for a, b in zip(marks, marks[1:], strict=False)]
            if len(clean) > 1 and abs(stdev(map(len, pieces)) - stdev(len(c.split()) for c in clean)) > 1:
                continue
            s = sum(ratio(" ".join(p), q) for p, q in zip(pieces, parts, strict=False)) / len(clean)
            if s > best:
                best, cut = s, pieces
        n = [float(i) for i in range(len(texts))]
        if cut is None:
            with pytest.raises(ValueError):
                place_punctuation(texts, n, n, truth)
            continue
        want, pieces = [], iter(cut)
        for p in parts:
            want += [p] if p in ",." else next(pieces)
        assert [t for t, _, _ in place_punctuation(texts, n, n, truth)] == want


def test_many_phonemes_in_many_parts():
    rng = random.Random(6)
    sizes = [14, 22, 9, 20, 17, 18]
    texts = [rng.choice("abcdefghij") for _ in range(100)]
    truth, at = [], 0
    for k in sizes:
        truth += [*texts[at : at + k], ","]
        at += k
    n = [float(i) for i in range(100)]
    out = place_punctuation(texts, n, n, truth, paired="cleaned")
    assert [i for i, (t, _, _) in enumerate(out) if t == ","] == [sum(sizes[: k + 1]) + k for k in range(6)]


def test_no_fitting_cut_is_an_error():
    with pytest.raises(ValueError):
        place_punctuation(["a"], [0.0], [0.0], ["a", ",", "b"])
    with pytest.raises(ValueError):
        place_punctuation([], [], [], ["a"])


def test_ctc_against_all_paths():
    rng = np.random.default_rng(3)
    for _ in range(20):
        t, k = 5, 3
        lp = np.log(rng.dirichlet(np.ones(k), size=t))
        targets = [int(x) for x in rng.integers(1, k, size=2)]
        best = -np.inf
        for path in np.ndindex(*[k] * t):
            collapsed = [p for i, p in enumerate(path) if p and (i == 0 or path[i - 1] != p)]
            if collapsed == targets:
                best = max(best, lp[np.arange(t), path].sum())
        labels, probs = align(lp, targets)
        assert np.log(probs).sum() == pytest.approx(best)
        assert alignment_score(lp, targets) == pytest.approx((best - lp.max(axis=1).sum()) / t)


def test_ctc_edges():
    lp = np.log(np.full((2, 3), 1 / 3))
    with pytest.raises(ValueError):
        align(lp, [1, 1])
    assert alignment_score(lp, [1, 1]) == float("-inf")
    assert word_times(np.log(np.array([[0.1, 0.8, 0.1], [0.8, 0.1, 0.1], [0.1, 0.1, 0.8], [0.8, 0.1, 0.1]])), ["a", "b"], {"a": 1, "b": 2}, 1600, 16000) == [("a", 0.0, 0.0), ("b", 0.05, 0.05)]
    with pytest.raises(ValueError):
        by_lengths([1, 2], [1])
    assert chunks(1300, 500) == [(0, 500), (500, 1000)]
    assert chunks(1400, 500) == [(0, 500), (500, 1000), (1000, 1400)]
