"""Passages: what is hashed, filtered and aligned side by side gives what one by one gives."""

import random

import numpy as np
import pytest
import xxhash

from tidemart.llm import substrings

LETTERS = list("abAB  .,-$\n\t\x1c\xa0éÉ×÷中K\x85 İßΣςЖж'\"\U0001f600\x00")
ODD = ["", " ", "-" * 50, ".a" * 40, "x" * 31 + " " + "x" * 32 + " ." + "y" * 31 + ".", "--------a ---------b---------", "　a　", "É"]


def one_by_one(text):
    return [xxhash.xxh64_intdigest(w.strip(substrings._STRIP).lower() or w) for w in text.split()]


def test_words_hashed_side_by_side(monkeypatch):
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choices(LETTERS, k=rnd.randrange(90))) for _ in range(500)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(32, 0x250), rnd.randrange(32, 0xD800), 32])) for _ in range(60)) for _ in range(500)]
    expected = [one_by_one(t) for t in texts]
    assert [w.tolist() for w in substrings.Hasher().words_all(texts)] == expected
    monkeypatch.setattr(substrings, "HASHED_CHARS", 1)
    monkeypatch.setattr(substrings, "MEMO_WORDS", 3)
    hasher = substrings.Hasher()
    assert [w.tolist() for w in hasher.words_all(texts)] == expected
    hasher = substrings.Hasher()
    assert hasher.words("Plain (été) 中文 words").tolist() == one_by_one("plain ÉTÉ 中文 words") and not hasher.memo


@pytest.mark.parametrize("vocabulary", [2, 1000])
def test_seeds_are_each_windows_least(vocabulary):
    rnd = random.Random(vocabulary)
    texts = [np.array([hash((vocabulary, rnd.randrange(vocabulary))) % 2**64 for _ in range(n)], np.uint64) for n in [0, 4, 5, 14, 15, 19, 45, 46, 0, 120, 9]]
    _, owner, place = found = substrings.minimizers_all(texts)
    for i, words in enumerate(texts):
        seeds, places = substrings.minimizers(words)
        assert (found[0][owner == i] == seeds).all() and (place[owner == i] == places).all() and len(seeds) == (owner == i).sum()
        for kind, (span, window) in enumerate(zip(substrings.SPANS, substrings.WINDOWS, strict=True)):
            at = places[seeds & np.uint64(3) == kind].tolist()
            n = len(words) - span + 1
            assert all(any(a <= p < a + window for p in at) for a in range(n - window + 1)) and bool(at) == (n > 0)
            assert len(set(at)) == len(at) and all(0 <= p < n for p in at)


def reach(a, b, loss):
    """The first best cell of the whole table, by rows."""
    n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[n:], b[n:]
    score = {(i, j): -loss * (i + j) for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    best, at = 0, (0, 0)
    for i in range(1, len(a) + 1):
        for j in range(len(b) + 1):
            if j:
                score[i, j] = max(score[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -loss), score[i - 1, j] - loss, score[i, j - 1] - loss)
            if score[i, j] > best:
                best, at = score[i, j], (i, j)
    return [n + at[0], n + at[1]]


def test_ends_that_cannot_gain_are_not_aligned(monkeypatch):
    rnd = random.Random(5)
    sides = [[np.array([rnd.randrange(2, 2 + v) for _ in range(rnd.randrange(30))], np.uint32) for v in [2, 4, 8, 30] * 60] for _ in range(2)]
    sides[1][::3] = [np.array([w if rnd.random() < 0.8 else 99 for w in a], np.uint32) for a in sides[0][::3]]
    for loss in (1.5, 0.5):
        assert substrings.reach_all(*sides, loss).tolist() == [reach(a.tolist(), b.tolist(), loss) for a, b in zip(*sides, strict=True)]
    apart = [[np.arange(2, 82, dtype=np.uint32) + 1000 * k + 500 * side for k in range(600)] for side in range(2)]
    aligned, accumulate = [], substrings._side_by_side
    monkeypatch.setattr(substrings, "_side_by_side", lambda a, b: aligned.append(len(a)) or accumulate(a, b))
    assert not substrings.reach_all(*apart).any() and aligned == [600, 0]


def test_common_words_of_equal_beginnings():
    rnd = random.Random(6)
    a = [np.array(rnd.choices(range(2, 6), k=rnd.randrange(12)), np.uint32) for _ in range(400)]
    b = [x if rnd.random() < 0.3 else np.array([*x[: rnd.randrange(9)], *rnd.choices(range(2, 6), k=rnd.randrange(6))], np.uint32) for x in a]

    def common(x, y):
        row = [0] * (len(y) + 1)
        for u in x:
            new = [0]
            for j, v in enumerate(y):
                new.append(row[j] + 1 if u == v else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    assert substrings.lcs_all(a, b).tolist() == [common(x.tolist(), y.tolist()) for x, y in zip(a, b, strict=True)]


def test_covers_and_pairs_that_may_hold_a_passage(monkeypatch):
    rnd = random.Random(7)
    for _ in range(50):
        cover, ranges = substrings.Cover(), []
        for _ in range(40):
            start = rnd.randrange(40)
            end = start + rnd.randrange(1, 12)
            assert cover.holds(start, end) == any(a <= start and end <= b for a, b in ranges)
            cover.add(start, end)
            ranges.append((start, end))
    pairs = [tuple(np.array(rnd.choices(range(v), k=rnd.randrange(120)), np.uint32) for v in (60, rnd.choice([20, 40, 60]))) for _ in range(300)]
    expected = []
    for a, b in pairs:
        hit = [int(w) in set(b.tolist()) for w in a]
        expected.append(any(sum(hit[i : i + substrings.MIN_WORDS]) >= substrings.LEAST_SHARED for i in range(len(a) - substrings.MIN_WORDS + 1)))
    assert 20 < sum(expected) < 280
    for bound in (1, 1000, 1 << 15):
        monkeypatch.setattr(substrings, "SHARED_WORDS", bound)
        assert substrings._may_hold_passages(pairs).tolist() == expected
