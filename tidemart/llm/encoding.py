"""Token ids of whole texts, each distinct chunk of text encoded once per worker.

A tokenizer that splits text before it merges never merges across the split, so the ids of a
text are the ids of its chunks, joined. Chunks repeat, texts do not: looking chunks up costs a
fraction of encoding them. Only chunks not met before go to the tokenizer, many at a time with a
separator between them. A column is cut into chunks as bytes, and each distinct one looked up once.
"""

from __future__ import annotations

import codecs
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemart.llm.common import kept

#: Chunks a worker keeps; beyond that it starts afresh, so memory has a bound (about 250 MB).
MEMO_CHUNKS = 1_200_000
#: Characters of new chunks per call of the tokenizer.
CALL_CHARS = 20_000
#: A space between two characters that are no white space: a split is always safe there.
INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Texts in which splitting at every space and line break could part a run of white space.
SPACE_RUN = re.compile(r"\s\s|\s\Z|\x00")
#: Texts of a column that are looked at one by one (RE2): two spaces or line breaks side by side or one
#: at the end, and any other white space.
ODD = (
    r"[ \n][ \n]|[ \n]\z|[\x00\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
#: Kinds of bytes in a column's texts. No tokenizer takes a letter together with a mark after it.
LETTER, MARK, LINE, SPACE = 1, 2, 3, 4
KIND = np.zeros(256, np.uint8)
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
KIND[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = MARK
KIND[10], KIND[32] = LINE, SPACE
#: A plain Latin word of a column (RE2), see ``Encoder._word``.
PLAIN = r"\A ?[A-Za-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+\z"
#: Bytes of a column's texts that are cut into chunks together (at least one text). A bound on memory.
COLUMN_BYTES = 1 << 22
#: Between a letter and one of these every tokenizer splits.
POINTS = ".,;:!?"
#: Python's split() takes these as white space, tokenizers do not.
SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 bytes
    are themselves, the others the letters from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def _has_space_run(text: str) -> bool:
    """Whether ``SPACE_RUN`` is found. A text with one white space character less than it has words has
    none, which is quicker to see."""
    words = text.split()
    if len(text) - sum(map(len, words)) == len(words) - 1:
        return "\0" in text
    return SPACE_RUN.search(text) is not None


class Memo(dict):
    """Ids of the chunks met so far. Plain words are added as they are asked for; other new chunks
    are put down in ``waiting``, with no ids yet."""

    def __init__(self, plain: Callable[[str], bytes | None]):
        self.plain, self.waiting = plain, []

    def __missing__(self, chunk: str) -> bytes:
        ids = self.plain(chunk)
        if ids is None:
            self.waiting.append(chunk)
            return b""
        self[chunk] = ids
        return ids


class Encoder:
    """Encodes texts with a file of the ``tokenizers`` library; the ids are exactly those of
    ``Tokenizer.encode(text, add_special_tokens=False)``.

    ``joined=True``: byte-level vocabulary where a word keeps the space before it.
    ``joined=False``: white space only separates and is dropped.
    """

    def __init__(self, path: str, joined: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.joined = joined
        self.memo = Memo(self._plain)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.mark = "\n" if joined else " \x01 "
        mark = self.tokenizer.encode(self.mark, add_special_tokens=False).ids
        self.mark_id = mark[0] if len(mark) == 1 else None

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _chunks(self, text: str) -> list[str] | None:
        """None: the text has to be encoded as a whole."""
        if any(s in text for s in self.special):
            return None
        if not self.joined:
            return None if SEPARATORS.search(text) else text.split()
        if _has_space_run(text):
            parts = INNER_SPACE.split(text)
            return parts[:1] + [" " + p for p in parts[1:]]
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def _alone(self, chunk: str) -> bool:
        """Whether the separator could not be told from the chunk's own content."""
        if self.joined:
            body = chunk[1:] if chunk.startswith(" ") else chunk
            return not body or body.split(None, 1) != [body]
        return "\x01" in chunk

    def _learn(self, chunks: set[str]) -> None:
        """Encode chunks not met before; points after a word are looked up by themselves."""
        memo, ends = self.memo, []
        group: dict[str, None] = {}
        for chunk in chunks:
            stem = chunk.rstrip(POINTS)
            if stem and len(stem) < len(chunk) and stem[-1].isalpha():
                tail = chunk[len(stem) :]
                ends.append((chunk, stem, tail))
                group.update(dict.fromkeys(x for x in (stem, tail) if x not in memo))
            else:
                group[chunk] = None
        call, size = [], 0
        for chunk in group:
            if not chunk:
                memo[chunk] = b""
            elif (word := self._word(chunk)) is not None:
                memo[chunk] = word
            elif self.mark_id is None or self._alone(chunk):
                memo[chunk] = self._whole(chunk)
            else:
                call.append(chunk)
                size += len(chunk)
                if size >= CALL_CHARS:
                    self._call(call)
                    call, size = [], 0
        if call:
            self._call(call)
        for chunk, stem, tail in ends:
            memo[chunk] = memo[stem] + memo[tail]

    def _plain(self, chunk: str) -> bytes | None:
        """Ids of a plain Latin word and the points after it."""
        if not chunk:
            return b""
        if chunk[-1] in POINTS:
            stem = chunk.rstrip(POINTS)
            if stem and stem[-1].isalpha():
                before = len(self.memo.waiting)
                ids = self.memo[stem] + self.memo[chunk[len(stem) :]]
                if len(self.memo.waiting) == before:
                    return ids
                del self.memo.waiting[before:]
            return None
        return self._word(chunk)

    def _word(self, chunk: str) -> bytes | None:
        """A plain Latin word is one pre-token, which the tokenizer's model takes as it is."""
        lead = self.joined and chunk[0] == " "
        body = chunk[1:] if lead else chunk
        if not body.isalpha() or (not body.isascii() and max(body) >= "\u0100"):
            return None
        if not self.joined:
            body = body.lower()
        if not body.isascii():
            body = "".join([self.letters[b] for b in body.encode()])
        if lead:
            body = self.letters[32] + body
        return array("I", [t.id for t in self.model.tokenize(body)]).tobytes()

    def _call(self, group: list[str]) -> None:
        ids = np.array(self.tokenizer.encode(self.mark.join(group), add_special_tokens=False).ids, "<u4")
        ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids))
        if len(ends) != len(group):  # a chunk holds the separator's own id
            for chunk in group:
                self.memo[chunk] = self._whole(chunk)
            return
        raw, at = ids.tobytes(), 0
        for chunk, end in zip(group, ends.tolist(), strict=True):
            self.memo[chunk] = raw[4 * at : 4 * end]
            at = end + 1

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit integers; null counts as empty."""
        out: list[np.ndarray] = []
        memo = self.memo
        for text in texts:
            parts = self._chunks(text or "")
            if parts is None:
                raw = self._whole(text)
            else:
                if len(memo) + len(parts) > MEMO_CHUNKS:
                    memo.clear()
                raw = b"".join(map(memo.__getitem__, parts))
                if memo.waiting:
                    new = set(memo.waiting)
                    memo.waiting.clear()
                    self._learn(new)
                    raw = b"".join(map(memo.__getitem__, parts))
            out.append(np.frombuffer(raw, "<u4"))
        return out

    def _ids(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks. What they share with a full memo stays in it."""
        memo = self.memo
        raw = list(map(memo.get, chunks))
        new = [i for i, ids in enumerate(raw) if ids is None]
        if len(memo) + len(new) > MEMO_CHUNKS:
            memo.clear()
            memo.update((c, ids) for c, ids in zip(chunks, raw, strict=True) if ids is not None)
        if new:
            self._learn_many([chunks[i] for i in new])
        for i in new:
            raw[i] = memo[chunks[i]]
        return raw

    def _learn_many(self, chunks: list[str]) -> None:
        """Encode a column's new chunks, plain Latin words by themselves."""
        plain = pc.match_substring_regex(pa.array(chunks, pa.large_string()), PLAIN).to_numpy(zero_copy_only=False).tolist()
        self._learn({c for c, p in zip(chunks, plain, strict=True) if not p})
        words = [c for c, p in zip(chunks, plain, strict=True) if p]
        shown = codecs.charmap_decode("\n".join(words).encode(), "strict", "".join(self.letters))[0]
        ids: list[int] = []
        ends = []
        for word in shown.split(self.letters[10]) if words else []:
            ids += [t.id for t in self.model.tokenize(word)]
            ends.append(len(ids))
        raw, at = np.array(ids, "<u4").tobytes(), 0
        for word, end in zip(words, ends, strict=True):
            self.memo[word] = raw[4 * at : 4 * end]
            at = end

    def encode_column(self, texts: pa.Array, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For one slice of the column after another: the ids of its texts, each followed by ``end_id``, and
        how many each text has with it. Null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        a = 0
        while a < len(texts):
            b = int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + COLUMN_BYTES, side="right"))
            b = max(a + 1, b)
            yield self._encode_slice(texts.slice(a, b - a), end_id)
            a = b

    def _encode_slice(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(texts, ODD) if self.joined else pa.array([True] * len(texts))
        for special in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        apart = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        alone = [x.tobytes() for x in self.encode(texts.take(pa.array(apart)).to_pylist())]
        texts = pc.if_else(odd, "", texts)

        # A chunk starts at every space, line break and text, after every line break and at marks after a letter.
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2] if bounds[-1] else pa.py_buffer(b"")
        body = np.frombuffer(data, np.uint8)[: bounds[-1]]
        kind = KIND[body]
        letter = kind == LETTER  # or the second byte of one from U+00C0 to U+00FF, but for the signs of multiplying and dividing
        letter[1:] |= (body[:-1] == 0xC3) & (body[1:] != 0x97) & (body[1:] != 0xB7)
        cut = kind >= LINE
        cut[1:] |= (kind[:-1] == LINE) | ((kind[1:] == MARK) & letter[:-1])
        cut[bounds[:-1][np.diff(bounds) > 0]] = True
        at = np.append(np.flatnonzero(cut), bounds[-1])
        words = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), data).dictionary_encode()

        # The chunks' numbers text by text; then, by numbers of their own, a text looked at alone and the end.
        raw = self._ids(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        last = np.searchsorted(at, bounds[1:])
        end = len(raw)
        raw += [np.array([end_id], "<u4").tobytes(), *alone]
        place = np.append(last[apart], last)
        order = np.argsort(np.append(apart, np.arange(len(texts))), kind="stable")
        extra = np.append(np.arange(end + 1, len(raw)), np.full(len(texts), end))
        numbers = np.insert(words.indices.to_numpy().astype(np.int64), place[order], extra[order])

        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        counts = sizes[numbers]
        ends = np.cumsum(counts)
        shift = (np.cumsum(sizes) - sizes)[numbers] - (ends - counts)
        ids = np.frombuffer(b"".join(raw), "<u4")[np.repeat(shift, counts) + np.arange(ends[-1])]
        return ids, np.diff(ends[numbers == end], prepend=0)


def encoder(path: str, joined: bool) -> Encoder:
    """The worker's encoder for a file, kept from task to task."""
    return kept(("encoder", path, joined), lambda: Encoder(path, joined))
