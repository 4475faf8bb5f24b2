"""Encoding: plain words are learned as they are met, whatever else a text holds."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tidemart.llm import encoding

WORDS = "plain Words été naïve it's 3.5 end. end.. wait?! (a) 中文 x_y Ж. . .. \t \n \n\n a  b </s> don't, über; ,".split(" ")


@pytest.mark.parametrize("joined, name", [(True, "byte_bpe_50k.json"), (False, "word_bpe_49k.json")])
@pytest.mark.parametrize("bound", [0, 30, 10**6])
def test_plain_words_are_learned_one_by_one(monkeypatch, joined, name, bound):
    rnd = random.Random(bound)
    texts = [" ".join(rnd.choices(WORDS, k=rnd.randrange(25))) for _ in range(150)] + ["", " ", "."]
    monkeypatch.setattr(encoding, "MEMO_CHUNKS", bound)
    found = encoding.Encoder(public_tokenizers.path(name), joined)
    for text in texts:
        assert found.encode([text])[0].tolist() == found.tokenizer.encode(text, add_special_tokens=False).ids, text
        assert not found.memo.waiting and len(found.memo) <= bound + 100
    learned = []
    monkeypatch.setattr(found, "_learn", lambda chunks: learned.append(chunks))
    assert len(found.encode(["some newly said words"])[0]) and not learned


COLUMN = [
    *WORDS, "end.Then", "a,b", "x-y_z", "we're,", "l'été!", "é.", "É,***", "×.", "÷,", "a×,b", "ÿ;", "ā.", "—.", "中.", "a@b.co", "3.5,", "f(x)[1]",
    "a b", "a\u0085b", "　", "\r\n", "<|endoftext|>", "a<|endoftext|>.", "\0", "\x1c", "naïve&&&", "«été»", "ñ́.", "#$%",
]


@pytest.mark.parametrize("joined, name", [(True, "byte_bpe_50k.json"), (False, "word_bpe_49k.json")])
@pytest.mark.parametrize("memo, size", [(0, 1), (40, 300), (10**6, 1 << 22)])
def test_columns_have_the_ids_of_their_texts(monkeypatch, joined, name, memo, size):
    rnd = random.Random(size)
    plain = [w for w in COLUMN if not set(w) & set("\t\r\n\0\x1c\u0085 　") and w and "endoftext" not in w]
    texts = [rnd.choice([" ", "\n", ""]).join(rnd.choices(rnd.choice([plain, COLUMN]), k=rnd.randrange(20))) for _ in range(300)]
    texts = [None, "", *texts, " a", "\na", "a\n", "a ", " ", "\n", "a \n b", "a\n\nb", None, ""]
    monkeypatch.setattr(encoding, "MEMO_CHUNKS", memo)
    monkeypatch.setattr(encoding, "COLUMN_BYTES", size)
    found = encoding.Encoder(public_tokenizers.path(name), joined)
    for column in (pa.array(texts), pa.array([*"xyz", *texts, "z"]).slice(3, len(texts)), pa.array([None, ""]), pa.array([""])):
        ids, lengths = map(np.concatenate, zip(*found.encode_column(column, 7), strict=True))
        want = [[*found.tokenizer.encode(t or "", add_special_tokens=False).ids, 7] for t in column.to_pylist()]
        got = [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]
        assert got == want and lengths.tolist() == [*map(len, want)]
    assert not list(found.encode_column(pa.array([], pa.string()), 7))


def test_a_column_looks_each_chunk_up_once(monkeypatch):
    found = encoding.Encoder(public_tokenizers.path("byte_bpe_50k.json"), True)
    asked, alone = [], []
    ids, encode = found._ids, found.encode
    monkeypatch.setattr(found, "_ids", lambda chunks: asked.append(chunks) or ids(chunks))
    monkeypatch.setattr(found, "encode", lambda texts: alone.extend(texts) or encode(texts))
    texts = ["one word, one word. Été, été!***", "one word,\nword, one", "two  spaces"] * 50
    assert sum(len(n) for _, n in found.encode_column(pa.array(texts), 2)) == len(texts)
    assert len(asked) == 1 and len(asked[0]) == len(set(asked[0])) and alone == ["two  spaces"] * 50
    assert {"one", " one", " word", ",", ".", "\n", "word", " Été", " été", "!***"} == set(asked[0])


def test_a_full_memo_keeps_what_a_column_uses(monkeypatch):
    found = encoding.Encoder(public_tokenizers.path("byte_bpe_50k.json"), True)
    monkeypatch.setattr(encoding, "MEMO_CHUNKS", 4)
    for text in ("a b c d", "a b e f"):
        list(found.encode_column(pa.array([text]), 2))
    assert set(found.memo) == {"a", " b", " e", " f"}
