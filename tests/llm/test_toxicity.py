"""Toxicity: what workers remember and how the language model is counted change no result."""

import random
from collections import Counter

import numpy as np
import pytest

from tidemart.llm import toxicity

WORDS = "fool idiot Ids! sooo coool f.o.o.l 1d10t état \u1e9eig \u4f60\u597d a1b2 x_y (word) 12 \ud800b -".split()


def texts(seed):
    rnd = random.Random(seed)
    return [None, "", "f o o l", "a b c", *(" ".join(rnd.choices(WORDS + [f"w{i}" for i in range(30)], k=rnd.randrange(60))) for _ in range(60))]


@pytest.mark.parametrize("bound", [0, 3, 10**6])
def test_tokens_without_features_are_remembered_apart(monkeypatch, bound):
    table = toxicity.count_grams(Counter({"fool": 9, "idiot": 5, "cool": 2}))
    wanted = np.zeros(toxicity.BUCKETS)
    wanted[[f for w in ("fool", "idiot", "état") for f in toxicity.features(w)]] = 1
    alone = [toxicity.Extractor(table, wanted).of(t) for t in texts(1)]
    everything = [toxicity.Extractor(table).of(t) for t in texts(1)]
    monkeypatch.setattr(toxicity, "MEMO_WORDS", bound)
    monkeypatch.setattr(toxicity, "MEMO_WITHOUT", bound)
    find = toxicity.Extractor(table, wanted)
    assert [find.of(t) for t in texts(1)] == alone
    assert alone == [x & set(np.flatnonzero(wanted).tolist()) for x in everything]
    assert all(find.memo.values()) and len(find.without) <= bound + 2
    assert bound < 10**6 or {"w1", "w2", "12", "-"} <= find.without


def test_counts_are_those_of_each_gram_and_its_context(spark):
    docs = [t for t in texts(2) if t is None or "\ud800" not in t]
    words = Counter(w for t in docs for w in toxicity.WORD.findall((t or "").lower()))
    expected, half = np.zeros(toxicity.TABLE, np.int64), toxicity.TABLE // 2
    for word, times in words.items():
        framed = "<" * (toxicity.ORDER - 1) + word + ">"
        for last in range(toxicity.ORDER - 1, len(framed)):
            for n in range(1, toxicity.ORDER + 1):
                own = framed[last + 1 - n : last + 1]
                expected[toxicity.gram(own) % half] += times
                expected[(toxicity.gram(own[:-1]) if n > 1 else 0) % half + half] += times
    assert (toxicity.count_grams(words) == expected).all()
    counted = toxicity.character_counts(spark.createDataFrame([(t,) for t in docs], "text string").repartition(3))
    assert (counted == expected).all()
    assert not toxicity.count_grams(Counter()).any() and toxicity.count_grams(Counter({"\ud800": 1})).sum() == 20


def test_counting_in_parts_and_repeated_letters(monkeypatch):
    words = Counter({w: i + 1 for i, w in enumerate(f"x{a}{b}" for a in "abcdé" for b in "uvw")})
    whole = toxicity.count_grams(words)
    monkeypatch.setattr(toxicity, "COUNTED_WORDS", 4)
    assert (toxicity.count_grams(words) == whole).all()
    rnd = random.Random(4)
    for token in ["".join(rnd.choices("aab1_é.\n", k=rnd.randrange(14))) for _ in range(20000)]:
        doubled, i = [], 0  # letters twice or three times, from the left
        while i + 1 < len(token):
            if token[i] == token[i + 1] and token[i].isalpha():
                n = 3 if token[i : i + 3] == token[i] * 3 else 2
                doubled.append(n)
                i += n
            else:
                i += 1
        assert toxicity._repeated(token) == (len(doubled) >= 3 or 3 in doubled), token


def test_grams_are_hashed_once(monkeypatch):
    table = toxicity.count_grams(Counter({"fool": 9, "idiot": 5, "cool": 2, "état": 1}))
    asked = []
    plain = toxicity.gram
    monkeypatch.setattr(toxicity, "gram", lambda text: asked.append(text) or plain(text))
    tokens = ["1d10t", "c00l", "f@ol", "id!0t", "fo0l", "cooool", "ét@t"]
    model = toxicity.CharacterModel(table)
    words = [toxicity.decode(t, model) for t in tokens]
    assert len(asked) == len(set(asked)) > 100
    monkeypatch.setattr(toxicity, "MEMO_WORDS", 1)
    assert [toxicity.decode(t, toxicity.CharacterModel(table)) for t in tokens] == words
    half = toxicity.TABLE // 2
    for context, c in [("<<<<", "f"), ("<foo", "l"), ("<éta", "t"), ("zzzz", "q")]:
        p = 1e-4
        for n in range(1, toxicity.ORDER + 1):
            own = (context + c)[-n:]
            total = int(table[(plain(own[:-1]) if n > 1 else 0) % half + half])
            p = (min(int(table[plain(own) % half]), total) + 4 * p) / (total + 4)
        assert abs(model.log_chance(context, c) - np.log(p)) < 1e-12
