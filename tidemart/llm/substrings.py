"""Passages that documents share, exactly or with small edits, by chaining k-mer seeds.

1. Seeds: all of each text's hashed 5-word k-mers, since of an edited passage few may be left. Minimizers of runs of 10, 20 and 40 words are seeds as well, so that any 45 equal words hold a common seed of 40: where a passage is made of frequent lines, its short seeds lead to the lines'
   documents, and the long ones to a document that has the lines in this order.
2. Matches: an occurrence of a seed is joined to the seed's first document and to the last one
   before its own, never to all others, so matches grow with the occurrences. This happens twice:
   within blocks of each task's own rows, and then over all blocks for the first occurrence of each.
   A seed that a third of all documents hold is thus shuffled once per block. What is shuffled is
   packed: sorted runs of seeds or matches in compressed planes of bytes, some 6 bytes a seed.
3. Chains: matches of two documents on one diagonal become segments, and segments are chained in
   order of both texts with a cost for gaps. The best predecessor is a prefix maximum in a Fenwick
   tree over the other text's positions.
4. Alignment: each chain is aligned on the words themselves and extended at both ends. A passage
   has at least 45 words of which 0.8 agree. Chains of two documents that lie close together share
   the words that are moved for them; one that lies in a passage already found is passed over. Two documents are aligned if their seeds cover 8
   words. Simulated (random substitutions, 3,000 passages each), no passage of 45 words with 9
   changed, 50 with 9, 60 with 11 or 80 with 16 has fewer; changes of every fifth word leave none.

Defined results. Null, empty or short text: no passage. Null doc_id: no passage. Rows that share a
doc_id are not compared with each other. Copies: every document but the first is one passage.
Empty table: no rows. Further columns are ignored by ``passages`` and kept by ``cut``.
Which earlier document a passage is traced to may depend on how the table is split into tasks.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import kept, map_rows, named, stored, width

K = 5
WINDOW = 1
#: Words of each kind of seed, doubled from one to the next, and the windows their minimizers are of.
SPANS = (K, 2 * K, 4 * K, 8 * K)
WINDOWS = (WINDOW, 10, 16, 6)
MIN_WORDS = 45
#: Words that the seeds of two documents must cover.
MIN_COVERED = 8
IDENTITY = 0.8
#: Words that may lie between two matches of a passage.
MAX_GAP = 40
GAP_COST = 0.25
#: Words beyond a chain's ends into which its alignment may reach.
MARGIN = 80
#: Loss per differing word of the second try to align a chain.
LEAST_LOSS = 0.5
#: A passage has 45 words in a row of which at least this many occur on the other side. If every 45 had
#: 29 at most, 45 k + r words (r < 45) had no more than 29 k + min(r, 29), which is below 0.8 (45 k + r).
LEAST_SHARED = 30
#: Seeds that a task joins among themselves at once, and those of the texts hashed with the last one.
BLOCK_SEEDS = 1 << 20
#: Spans that are asked of one document's text in one group.
GROUP_ASKS = 20_000
#: Documents asked more often than that are broadcast up to this many (16 bytes each).
BROADCAST_ROWS = 200_000
#: Ranges of seeds for each shuffle partition.
PARTS = 4
MEMO_WORDS = 600_000
WORD = re.compile(r"\S+")
_STRIP = ".,;:!?\"'()[]{}<>|*#&%$-_"
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Memo(dict):
    """Hashes of the words met so far."""

    def __missing__(self, word: str) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word.strip(_STRIP).lower() or word)
        return value


#: Characters of texts whose words are hashed together.
HASHED_CHARS = 1 << 18
#: Punctuation characters on a side of a word that are looked for in arrays.
MOST_STRIPPED = 8
_SPACE, _PUNCTUATION = np.zeros(256, bool), np.zeros(256, bool)
_SPACE[[*range(9, 14), *range(28, 33)]] = True
_PUNCTUATION[list(_STRIP.encode())] = True
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
#: First bytes of characters that lower case may change, other than the Latin ones of U+00C0 to U+00DE, which keep
#: their first byte 0xC3 and get 0x20 added to the second.
_CASED = np.zeros(256, bool)
_CASED[0xF0:] = True
_CASED[[chr(c).encode()[0] for c in range(0x100, 0x10000) if not 0xD800 <= c < 0xE000 and chr(c).lower() != chr(c)]] = True
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(h: np.ndarray, bits: int) -> np.ndarray:
    return h << np.uint64(bits) | h >> np.uint64(64 - bits)


def _hashes(raw: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """XXH64 (seed 0) of the ``size`` bytes, fewer than 32, of ``raw`` from each of ``starts``."""
    eights = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    fours = np.ndarray(len(raw) - 3, "<u4", raw, strides=(1,))
    h = np.full(len(starts), _P5 + np.uint64(size), np.uint64)
    for at in range(0, size - 7, 8):
        h ^= _turned(eights[starts + at] * _P2, 31) * _P1
        h = _turned(h, 27) * _P1 + _P4
    at = size & ~7
    if size & 4:
        h ^= fours[starts + at].astype(np.uint64) * _P1
        h = _turned(h, 23) * _P2 + _P3
        at += 4
    for k in range(at, size):
        h ^= raw[starts + k].astype(np.uint64) * _P5
        h = _turned(h, 11) * _P1
    h ^= h >> np.uint64(33)
    h *= _P2
    h ^= h >> np.uint64(29)
    h *= _P3
    return h ^ h >> np.uint64(32)


class Hasher:
    """64-bit hashes of words without case and outer punctuation. Those of short words in Latin-1 or in scripts
    without case are computed side by side, the others are remembered per worker."""

    def __init__(self):
        self.memo = Memo()

    def words(self, text: str) -> np.ndarray:
        return self.words_all([text])[0]

    def words_all(self, texts: list[str]) -> list[np.ndarray]:
        """The hashes of each text's words."""
        out, some, held = [], [], 0
        for text in texts:
            some.append(text if text.isascii() else " ".join(text.split()))
            held += len(text)
            if held >= HASHED_CHARS:
                out += self._together(some)
                some, held = [], 0
        return out + self._together(some) if some else out

    def _together(self, texts: list[str]) -> list[np.ndarray]:
        raws = [t.encode() for t in texts]
        joined = b"\n".join(raws) + b"\n" * 8  # words are read by eights
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        raw = np.frombuffer(joined, np.uint8)
        edges = np.flatnonzero(np.diff(_SPACE[raw], prepend=True))
        starts, ends = edges[::2].copy(), edges[1::2].copy()
        text_ends = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)) + 1)
        counts = np.diff(starts.searchsorted(text_ends), prepend=0)
        apart = self._strip(raw, starts, ends)
        lower = _LOWER[raw]
        if not joined.isascii():
            apart[edges[::2].searchsorted(np.flatnonzero(_CASED[raw]), side="right") - 1] = True
            after = np.flatnonzero(raw == 0xC3) + 1
            capital = raw[after]
            lower[after[(capital <= 0x9E) & (capital != 0x97)]] += 0x20
        sizes = ends - starts
        apart |= sizes >= 32
        out = np.zeros(len(starts), np.uint64)
        sizes[apart] = 0
        with np.errstate(over="ignore"):
            order = np.argsort(sizes.astype(np.uint8), kind="stable")
            bounds = np.append(0, np.cumsum(np.bincount(sizes, minlength=32))).tolist()
            for size in range(1, 32):
                rows = order[bounds[size] : bounds[size + 1]]
                if len(rows):
                    out[rows] = _hashes(lower, starts[rows], size)
        rest = order[: bounds[1]]
        words = [joined[a:b].decode() for a, b in zip(edges[::2][rest].tolist(), edges[1::2][rest].tolist(), strict=True)]
        out[rest] = np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))
        return np.split(out, np.cumsum(counts)[:-1])

    @staticmethod
    def _strip(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Moves the words' bounds over outer punctuation, unless they are nothing else; returns which words are
        left over."""
        left = np.zeros(len(starts), bool)
        for bounds, step, last in ((starts, 1, 0), (ends, -1, -1)):
            some = np.flatnonzero(_PUNCTUATION[raw[bounds + last]])
            for _ in range(MOST_STRIPPED):
                bounds[some] += step
                some = some[starts[some] < ends[some]]
                some = some[_PUNCTUATION[raw[bounds[some] + last]]]
                if not len(some):
                    break
            left[some] = True
        return left | (starts >= ends)


def hasher() -> Hasher:
    return kept(("hasher",), Hasher)


def minimizers(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of a text's seeds. The last two bits of a hash tell which of ``SPANS`` it
    is of."""
    seeds, _, places = minimizers_all([words])
    return seeds, places


def minimizers_all(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The seeds of several texts, kind by kind: hashes, numbers of texts and positions. The last two bits of a
    hash tell which of ``SPANS`` it is of."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(sizes) - sizes
    grams = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
    text = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(grams)) - begins[text]
    left = sizes[text] - place  # words from here to the text's end
    power, words = np.uint64(1), grams
    seeds, owners, places = [], [], []
    with np.errstate(over="ignore"):
        grams = np.zeros(max(0, len(words) - K + 1), np.uint64)
        for j in range(K):
            grams += words[j : j + len(grams)] * power
            power *= _BASE
        for kind, (span, window) in enumerate(zip(SPANS, WINDOWS, strict=True)):
            if kind:
                half = span // 2
                if len(grams) <= half:
                    break
                grams = grams[:-half] + grams[half:] * power
                power *= power
            mixed = grams ^ (grams >> np.uint64(29))
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
            at = _least_of_each(mixed, window, begins, sizes - span + 1, text, place, left - span + 1)
            seeds.append(mixed[at] & ~np.uint64(3) | np.uint64(kind))
            owners.append(text[at])
            places.append(place[at])
    if not seeds:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(seeds), np.concatenate(owners), np.concatenate(places)


def _sliding(values: np.ndarray, window: int, best: np.ufunc) -> np.ndarray:
    """The best of every ``window`` entries in a row, from runs of doubled length."""
    size = 1
    while 2 * size <= window:
        values = best(values[:-size], values[size:])
        size *= 2
    return best(values[: len(values) - window + size], values[window - size :]) if window > size else values


def _least_of_each(grams: np.ndarray, window: int, begins: np.ndarray, counts: np.ndarray, text: np.ndarray, place: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Positions of the smallest entry of every window of a text's grams, of equal ones the first. ``begins`` and
    ``counts`` are the texts' bounds; ``left`` is 1 for a text's last gram and less behind it."""
    n = len(grams)
    text, place, left = text[:n], place[:n], left[:n]
    if window == 1:
        return np.flatnonzero(left > 0)
    short = np.flatnonzero((counts > 0) & (counts <= window))
    alone = [a + int(grams[a : a + c].argmin()) for a, c in zip(begins[short].tolist(), counts[short].tolist(), strict=True)]
    if n <= window:
        return np.array(alone, np.int64)
    low = np.array([(1 << max(0, c).bit_length()) - 1 for c in counts.tolist()], np.uint64)[text]
    grams = grams & ~low | place.astype(np.uint64)
    # An entry is the smallest of some window if it is as small as the largest of its windows' minima.
    minima = np.zeros(n + window - 1, np.uint64)
    minima[window - 1 : n] = _sliding(grams, window, np.minimum) * (left >= window)[: n - window + 1]
    found = (grams == _sliding(minima, window, np.maximum)) & (left > 0)
    if alone:
        found &= (counts > window)[text]
        found[alone] = True
    return np.flatnonzero(found)


def _by_seed(seed: np.ndarray) -> np.ndarray:
    """The order of the seeds, equal ones as they come."""
    bits = len(seed).bit_length()
    if SEED_BITS + bits > 63:
        return np.argsort(seed, kind="stable")
    return np.sort(seed << bits | np.arange(len(seed))) & ((1 << bits) - 1)


def _repeated(seed: np.ndarray) -> np.ndarray:
    """Which of the sorted seeds are not the only one of their kind."""
    same = np.concatenate([[False], seed[1:] == seed[:-1], [False]])
    return same[1:] | same[:-1]


def _star(seed: np.ndarray, doc: np.ndarray, pos: np.ndarray):
    """Rows sorted by seed, doc, pos. Matches (later, x, earlier, y) of each occurrence with its
    seed's first document and with the document before its own; and which rows are of the first.
    A seed's second occurrence in one document meets the second in the other, and so on. A long
    seed matches at its first and its last K words."""
    n = len(seed)
    if not n:
        nothing = np.zeros(0, np.int64)
        return (nothing,) * 4, nothing
    new_seed = np.append(True, seed[1:] != seed[:-1])
    new_doc = new_seed | np.append(True, doc[1:] != doc[:-1])
    rows = np.arange(n)
    first = np.maximum.accumulate(np.where(new_seed, rows, 0))
    run = np.maximum.accumulate(np.where(new_doc, rows, 0))
    starts = np.flatnonzero(new_doc)
    size = np.zeros(n, np.int64)
    size[starts] = np.diff(np.append(starts, n))
    i = np.flatnonzero(run != first)
    before = run[run[i] - 1]
    j = before != first[i]
    i, other = np.concatenate([i, i[j]]), np.concatenate([first[i], before[j]])
    other = other + np.minimum(i - run[i], size[other] - 1)
    x, y, further = pos[i], pos[other], np.array(SPANS)[seed[i] & 3] - K
    long = further > 0
    i, other = np.concatenate([i, i[long]]), np.concatenate([other, other[long]])
    x, y = np.concatenate([x, x[long] + further[long]]), np.concatenate([y, y[long] + further[long]])
    return _thin(doc[i], x, doc[other], y), np.flatnonzero(run == first)


def _thin(later: np.ndarray, x: np.ndarray, earlier: np.ndarray, y: np.ndarray):
    """Of each diagonal's matches the first and the last in every half of ``MAX_GAP`` words. The
    segments they make are the same, since those depend on ends and on gaps over ``MAX_GAP`` only."""
    order = np.lexsort((x, x - y, earlier, later))
    later, x, earlier, y = later[order], x[order], earlier[order], y[order]
    parts = (later, earlier, x - y, x // (MAX_GAP // 2))
    new = np.append(True, np.any([p[1:] != p[:-1] for p in parts], axis=0))[: len(x)]
    keep = new | np.append(new[1:], True)[: len(x)]
    return later[keep], x[keep], earlier[keep], y[keep]


#: Seeds are compared by this many bits. Two that agree by chance make a match of a few words, which
#: no passage can consist of.
SEED_BITS = 42

PACKED = "kind int, part int, packed binary"
_PACKED = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("packed", pa.binary())])
SEEDS, MATCHES = 0, 1


def pack(ascending: np.ndarray, *columns: np.ndarray) -> bytes:
    """Equally long integer columns, the first in ascending order, as its steps and the others less
    their least values, in planes of bytes that compress to little more than what they tell."""
    head, planes = [len(ascending), len(columns) + 1], []
    for low, values in [(ascending[0], np.diff(ascending, prepend=ascending[:1])), *[(c.min(), c - c.min()) for c in columns]]:
        size = (int(values.max()).bit_length() + 7) // 8
        head += [int(low), size]
        bytes_of = values.astype("<u8").view(np.uint8).reshape(-1, 8)
        planes += [bytes_of[:, k].tobytes() for k in range(size)]
    return np.array(head, np.int64).tobytes() + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpack(packed: bytes) -> list[np.ndarray]:
    n, width = np.frombuffer(packed, np.int64, 2).tolist()
    heads = np.frombuffer(packed, np.int64, 2 * width, 16).reshape(width, 2).tolist()
    total = n * sum(size for _, size in heads)
    planes = np.frombuffer(pa.decompress(packed[16 * (1 + width) :], decompressed_size=total, codec="zstd", asbytes=True), np.uint8).reshape(-1, n)
    out, at = [], 0
    for i, (low, size) in enumerate(heads):
        values = np.zeros((n, 8), np.uint8)
        for k in range(size):
            values[:, k] = planes[at + k]
        at += size
        column = values.view("<i8").reshape(n)
        out.append(low + (column if i else np.cumsum(column)))
    return out


def _packed(kind: int, parts: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """A packed row for every run of equal ``parts``."""
    starts = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])[: len(parts)])
    rows = [pack(*[c[a:b] for c in columns]) for a, b in zip(starts, np.append(starts[1:], len(parts)), strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(rows), pa.int32()), pa.array(parts[starts].astype(np.int32)), pa.array(rows, pa.binary())], schema=_PACKED)


def _packed_matches(later, x, earlier, y, parts: int) -> pa.RecordBatch:
    """Matches dealt by pairs of documents."""
    with np.errstate(over="ignore"):
        mixed = (later.astype(np.uint64) * _BASE ^ earlier.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    part = ((mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((x, x - y, earlier, later, part))
    later, x, earlier, y = later[order], x[order], earlier[order], y[order]
    return _packed(MATCHES, part[order], later, earlier, x - y, x)


def _seeds(parts: int, groups: int):
    """Matches among a block of the task's own documents, and the first occurrence of each of its seeds.

    Nearly all seeds occur in one document only, so what they take decides what is moved: a block's
    seeds go out sorted, packed by range of seeds."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, words_all = [], 0, hasher().words_all

        def flush():
            ids, (seed, doc, pos) = np.concatenate([h[0] for h in held]), (np.concatenate(c) for c in list(zip(*held, strict=True))[1:])
            if np.any(ids[1:] < ids[:-1]):
                order = np.argsort(doc, kind="stable")
                seed, doc, pos = seed[order], doc[order], pos[order]
            order = _by_seed(seed)
            seed, doc, pos = seed[order], doc[order], pos[order]
            again = np.flatnonzero(_repeated(seed))
            if len(np.unique(ids)) < len(ids):  # rows that share a doc_id
                rows = again[np.lexsort((pos[again], doc[again], seed[again]))]
                doc[again], pos[again] = doc[rows], pos[rows]
            matches, first = _star(seed[again], doc[again], pos[again])
            if len(matches[0]):
                yield _packed_matches(*matches, groups)
            keep = np.ones(len(seed), bool)
            keep[again] = False
            keep[again[first]] = True
            seed, doc, pos = seed[keep], doc[keep], pos[keep]
            yield _packed(SEEDS, seed * parts >> SEED_BITS, seed, doc, pos)

        def learn(texts: list[tuple[int, str]]):
            ids = np.array([d for d, _ in texts], np.int64)
            seed, owner, at = minimizers_all(words_all([t for _, t in texts]))
            # The leading bits, and the two that tell the kind.
            short = (seed >> np.uint64(66 - SEED_BITS) << np.uint64(2) | seed & np.uint64(3)).astype(np.int64)
            held.append((ids, short, ids[owner], at))
            return len(at)

        texts, chars = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if doc_id is None or not text:
                    continue
                texts.append((doc_id, text))
                chars += len(text)
                if chars >= HASHED_CHARS:
                    size += learn(texts)
                    texts, chars = [], 0
                if size >= BLOCK_SEEDS:
                    yield from flush()
                    held.clear()
                    size = 0
        if texts:
            size += learn(texts)
        if size:
            yield from flush()

    return seeds


def _parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[bytes]]]:
    """The packed rows of every (kind, part) of a sorted partition."""
    rows = ((k, p, blob) for batch in batches for k, p, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for (kind, part), group in itertools.groupby(rows, lambda r: r[:2]):
        yield kind, part, [blob for _, _, blob in group]


def _join_seeds(groups: int):
    """Seeds that several blocks have become matches; a seed that only one block has goes no further.
    Matches of many ranges of seeds are packed together, so that packets stay few and large."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            return _packed_matches(*(np.concatenate(c) for c in zip(*held, strict=True)), groups)

        for kind, part, blobs in _parts_of(batches):
            if kind == MATCHES:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * len(blobs), pa.int32()), pa.array([part] * len(blobs), pa.int32()), pa.array(blobs, pa.binary())],
                    schema=_PACKED)
            elif len(blobs) > 1:
                seed, doc, pos = (np.concatenate(c) for c in zip(*map(unpack, blobs), strict=True))
                order = _by_seed(seed)
                again = order[_repeated(seed[order])]
                seed, doc, pos = seed[again], doc[again], pos[again]
                order = np.lexsort((pos, doc, seed))
                matches, _ = _star(seed[order], doc[order], pos[order])
                if len(matches[0]):
                    held.append(matches)
                    size += len(matches[0])
                if size >= BLOCK_SEEDS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return join


class Fenwick:
    """Prefix maxima with the entry that attains them."""

    def __init__(self, n: int):
        self.best, self.who = [float("-inf")] * (n + 1), [-1] * (n + 1)

    def put(self, at: int, value: float, who: int) -> None:
        at += 1
        while at < len(self.best):
            if value > self.best[at]:
                self.best[at], self.who[at] = value, who
            at += at & -at

    def upto(self, at: int) -> tuple[float, int]:
        """The largest value at positions <= at."""
        at += 1
        best, who = float("-inf"), -1
        while at > 0:
            if self.best[at] > best:
                best, who = self.best[at], self.who[at]
            at -= at & -at
        return best, who


def chain(segments: list[tuple[int, int, int, int]]) -> list[list[tuple[int, int, int, int]]]:
    """Chains of segments (x0, x1, y0, y1; ends exclusive, of seeds' first words), best first. A
    segment scores the words it covers, a gap costs in proportion to its words on both sides."""
    ends = sorted({s[3] for s in segments})
    rank = {y: i for i, y in enumerate(ends)}
    places = np.array(ends)
    tree = Fenwick(len(ends))
    events = sorted([(s[0], 1, i) for i, s in enumerate(segments)] + [(s[1], 0, i) for i, s in enumerate(segments)])
    score, before = [0.0] * len(segments), [-1] * len(segments)
    for _, start, i in events:
        x0, x1, y0, y1 = segments[i]
        if start:
            score[i] = x1 - x0 + K - 1
            at = int(np.searchsorted(places, y0, side="right")) - 1
            best, who = tree.upto(at) if at >= 0 else (0.0, -1)
            gain = best - GAP_COST * (x0 + y0)
            if who >= 0 and gain > 0 and x0 - segments[who][1] <= MAX_GAP and y0 - segments[who][3] <= MAX_GAP:
                score[i], before[i] = score[i] + gain, who
        else:
            tree.put(rank[y1], score[i] + GAP_COST * (x1 + y1), i)
    used, chains = set(), []
    for i in sorted(range(len(segments)), key=lambda i: -score[i]):
        links = []
        while i >= 0 and i not in used:
            used.add(i)
            links.append(segments[i])
            i = before[i]
        if links:
            chains.append(links[::-1])
    return chains


CLUSTER = "later long, earlier long, x0 int, x1 int, y0 int, y1 int, segments binary"


def clusters(chains: list[tuple[int, int, int, int, list]]) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """Chains (x0, x1, y0, y1, segments) of one pair of documents, put together where the words of
    their common range are no more than those of their own ones. Segments get their chain's rank."""

    def words(x0, x1, y0, y1):
        return x1 - x0 + y1 - y0 + 4 * MARGIN

    def together(hull, ranks):
        return *hull, np.array([(rank, *s) for rank in sorted(ranks) for s in chains[rank][4]], "<i4")

    hull, ranks = None, []
    for rank in sorted(range(len(chains)), key=lambda r: chains[r][:4]):
        x0, x1, y0, y1, _ = chains[rank]
        if hull:
            both = min(hull[0], x0), max(hull[1], x1), min(hull[2], y0), max(hull[3], y1)
            if words(*both) <= words(*hull) + words(x0, x1, y0, y1):
                hull = both
                ranks.append(rank)
                continue
            yield together(hull, ranks)
        hull, ranks = (x0, x1, y0, y1), [rank]
    if hull:
        yield together(hull, ranks)


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed matches of whole pairs of documents to clusters of chains."""
    for _, _, blobs in _parts_of(batches):
        later, earlier, diagonal, x = (np.concatenate(c) for c in zip(*map(unpack, blobs), strict=True))
        y = x - diagonal
        order = np.lexsort((x, x - y, earlier, later))
        later, earlier, x, y = later[order], earlier[order], x[order], y[order]
        new_pair = np.append(True, (later[1:] != later[:-1]) | (earlier[1:] != earlier[:-1]))
        new = new_pair | np.append(True, (x - y)[1:] != (x - y)[:-1]) | np.append(True, np.diff(x) > MAX_GAP)
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(x)) - 1
        pair = np.cumsum(new_pair)[start] - 1
        covered = np.bincount(pair, weights=x[end] - x[start] + K)
        keep = covered[pair] >= MIN_COVERED
        start, end, pair = start[keep], end[keep], pair[keep]
        if not len(pair):
            continue
        bounds = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        out = []
        for a, b in zip(bounds, np.append(bounds[1:], len(pair)), strict=True):
            s, e = start[a:b], end[a:b]
            segments = list(zip(x[s].tolist(), (x[e] + 1).tolist(), y[s].tolist(), (y[e] + 1).tolist(), strict=True))
            ranges, found = [], []
            for links in [segments] if len(segments) == 1 else chain(segments):
                x0, x1, y0, y1 = links[0][0], links[-1][1] + K - 1, links[0][2], links[-1][3] + K - 1
                # A few words close to a better chain on both sides: that chain's alignment reaches them.
                if x1 - x0 < MIN_WORDS // 4 and any(
                    a - MAX_GAP < x0 and x1 < b + MAX_GAP and c - MAX_GAP < y0 and y1 < d + MAX_GAP for a, b, c, d in ranges
                ):
                    continue
                ranges.append((x0, x1, y0, y1))
                found.append((x0, x1, y0, y1, links))
            out.extend((int(later[s[0]]), int(earlier[s[0]]), *hull, packed.tobytes()) for *hull, packed in clusters(found))
        if out:
            kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                ["later", "earlier", "x0", "x1", "y0", "y1", "segments"])


#: What shorter rows are filled up with, on either side; words with these hashes count as the next.
_PAD_A, _PAD_B = 0, 1
#: Rows that are aligned side by side.
SIDE_BY_SIDE = 256

Words = list[np.ndarray]


def _sizes(rows: Words) -> np.ndarray:
    return np.fromiter(map(len, rows), np.int64, len(rows))


def _filled(rows: Words, wide: int, pad: int) -> np.ndarray:
    out = np.full((len(rows), wide), pad, np.uint32)
    out[np.arange(wide) < _sizes(rows)[:, None]] = np.maximum(np.concatenate(rows), 2)
    return out


def _equal_beginnings(a: Words, b: Words) -> np.ndarray:
    """How many words at the beginnings of ``a[i]`` and ``b[i]`` are equal."""
    out = np.minimum(_sizes(a), _sizes(b))
    order = np.argsort(out)
    order = order[out[order] > 0]
    for at in range(0, len(order), SIDE_BY_SIDE):
        rows = order[at : at + SIDE_BY_SIDE]
        n = int(out[rows[-1]])
        differ = _filled([a[i][:n] for i in rows], n + 1, _PAD_A) != _filled([b[i][:n] for i in rows], n + 1, _PAD_B)
        out[rows] = differ.argmax(axis=1)
    return out


def _side_by_side(a: Words, b: Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of similar length as matrices: their numbers, ``a``, ``b``. Rows with an empty side are left out."""
    sizes = np.stack([_sizes(a), _sizes(b)], axis=1)
    order = np.lexsort((sizes.sum(axis=1), sizes.max(axis=1)))
    order = order[sizes[order].min(axis=1) > 0]
    for at in range(0, len(order), SIDE_BY_SIDE):
        rows = order[at : at + SIDE_BY_SIDE]
        m, n = sizes[rows].max(axis=0).tolist()
        yield rows, _filled([a[i] for i in rows], m, _PAD_A), _filled([b[i] for i in rows], n, _PAD_B)


def lcs_all(a: Words, b: Words) -> np.ndarray:
    """Lengths of the longest common subsequences of ``a[i]`` and ``b[i]``."""
    out = _equal_beginnings(a, b)
    runs = out.tolist()
    for rows, x, y in _side_by_side([x[r:] for x, r in zip(a, runs, strict=True)], [y[r:] for y, r in zip(b, runs, strict=True)]):
        best = np.zeros((len(rows), y.shape[1] + 1), np.int16 if y.shape[1] < 1 << 15 else np.int32)
        for i in range(x.shape[1]):
            step = best.copy()
            np.maximum(best[:, 1:], best[:, :-1] + (y == x[:, i : i + 1]), out=step[:, 1:])
            best = np.maximum.accumulate(step, axis=1)
        out[rows] += best[:, -1]
    return out


def lcs(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of any two sequences."""
    codes = np.unique(np.concatenate([a, b]), return_inverse=True)[1] + 2
    return int(lcs_all([codes[: len(a)]], [codes[len(a) :]])[0])


def _may_gain(x: np.ndarray, y: np.ndarray, lost: int) -> np.ndarray:
    """Rows whose beginnings may have an alignment with a sum above 0. One that ends after i words of a side
    agrees in no more of them than occur on the other side at all, and loses for each of the rest."""
    x, y = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
    shared_x, shared_y = np.zeros(x.shape, bool), np.zeros(y.shape, bool)
    for i in range(len(x)):
        hit = y == x[i]
        np.logical_or.reduce(hit, axis=0, out=shared_x[i])
        shared_y |= hit
    ok = np.ones(x.shape[1], bool)
    for shared in (shared_x, shared_y):
        ok &= np.where(shared, 2, -lost).cumsum(axis=0).max(axis=0) > 0
    return ok


def reach_all(a: Words, b: Words, loss: float = 1.5) -> np.ndarray:
    """How many words of either side to add at an end, for each pair: the alignment of the two
    beginnings with the best sum of +1 for each agreeing word and -``loss`` for each other step.
    Equal words at the very beginning are added first."""
    out = np.repeat(_equal_beginnings(a, b)[:, None], 2, axis=1)
    runs = out[:, 0].tolist()
    a, b = [x[r:] for x, r in zip(a, runs, strict=True)], [y[r:] for y, r in zip(b, runs, strict=True)]
    # Most ends go apart at once: only those that may gain are aligned.
    some = [rows[_may_gain(x, y, int(2 * loss))] for rows, x, y in _side_by_side(a, b)]
    some = np.concatenate(some) if some else np.zeros(0, np.int64)
    for rows, x, y in _side_by_side([a[i] for i in some], [b[i] for i in some]):
        rows = some[rows]
        # Sums are doubled, so that they are whole numbers.
        lost, drop = np.int16(2 * loss), (2 * loss * np.arange(y.shape[1] + 1)).astype(np.int16)
        score = np.repeat(-drop[None], len(rows), axis=0)
        best, at = np.zeros(len(rows), np.int16), np.zeros((len(rows), 2), np.int64)
        for i in range(x.shape[1]):
            step = score - lost
            hit = (y == x[:, i : i + 1]).view(np.int8) * np.int16(2 + lost) - lost
            np.maximum(step[:, 1:], score[:, :-1] + hit, out=step[:, 1:])
            step += drop
            score = np.maximum.accumulate(step, axis=1, out=step)
            score -= drop
            j = score.argmax(axis=1)
            top = score[np.arange(len(rows)), j]
            better = np.flatnonzero(top > best)
            best[better] = top[better]
            at[better, 0], at[better, 1] = i + 1, j[better]
            # Rows in which no later words can make up for what is lost are done.
            going = top + 2 * (x.shape[1] - 1 - i) > best
            if 4 * np.count_nonzero(going) < 3 * len(rows):
                out[rows[~going]] += at[~going]
                rows, x, y, score, best, at = (c[going] for c in (rows, x, y, score, best, at))
                if not len(rows):
                    break
        out[rows] += at
    return out


Links = list[tuple[int, int, int, int]]
Task = tuple[np.ndarray, np.ndarray, int, int, Links]


#: What tasks have in common for every loss: agreeing words between the chain's ends, where it ends,
#: and the sides of its left and its right end.
Cores = tuple[np.ndarray, list[tuple[int, int]], tuple[tuple[Words, Words], tuple[Words, Words]]]


def _cores(tasks: list[Task]) -> Cores:
    matched, until = np.zeros(len(tasks), np.int64), []
    owner, gap_a, gap_b = [], [], []
    (left_a, left_b), (right_a, right_b) = ends = ([], []), ([], [])
    for t, (a, b, a0, b0, links) in enumerate(tasks):
        x1, y1 = links[0][0], links[0][2]
        i, j, agreeing = x1 - a0, y1 - b0, 0
        left_a.append(a[max(0, i - MARGIN) : i][::-1])
        left_b.append(b[max(0, j - MARGIN) : j][::-1])
        for sx, ex, sy, _ in links:
            ex = ex + K - 1
            skip = max(0, x1 - sx, y1 - sy)  # words that the segment before has covered
            sx, sy = sx + skip, sy + skip
            if sx >= ex:
                continue
            if sx > x1 and sy > y1:
                owner.append(t)
                gap_a.append(a[x1 - a0 : sx - a0])
                gap_b.append(b[y1 - b0 : sy - b0])
            n = ex - sx
            agreeing += np.count_nonzero(a[sx - a0 : ex - a0] == b[sy - b0 : sy - b0 + n])
            x1, y1 = ex, sy + n
        i, j = x1 - a0, y1 - b0
        right_a.append(a[i : i + MARGIN])
        right_b.append(b[j : j + MARGIN])
        matched[t] = agreeing
        until.append((x1, y1))
    np.add.at(matched, np.array(owner, np.int64), lcs_all(gap_a, gap_b))
    return matched, until, ends


def _extended(tasks: list[Task], cores: Cores, loss: float) -> list[tuple[int, int, int, int, int]]:
    matched, until, ends = cores
    matched, added = matched.copy(), []
    for side_a, side_b in ends:
        reach = reach_all(side_a, side_b, loss)
        added.append(reach.tolist())
        matched += lcs_all([x[:n] for x, (n, _) in zip(side_a, added[-1], strict=True)], [y[:n] for y, (_, n) in zip(side_b, added[-1], strict=True)])
    return [
        (task[4][0][0] - left_x, x1 + right_x, task[4][0][2] - left_y, y1 + right_y, m)
        for task, (x1, y1), (left_x, left_y), (right_x, right_y), m in zip(tasks, until, *added, matched.tolist(), strict=True)
    ]


def align_all(tasks: list[Task], loss: float = 1.5) -> list[tuple[int, int, int, int, int]]:
    """Align words a (from position a0 of its text) and b (from b0) along a chain, for each (a, b,
    a0, b0, chain). Returns x0, x1, y0, y1 and the number of agreeing words of each."""
    return _extended(tasks, _cores(tasks), loss)


SPAN = "later long, earlier long, x0 int, y0 int, role int, at int, words binary, segments binary"
_SPAN = pa.schema([("later", pa.int64()), ("earlier", pa.int64()), *[(c, pa.int32()) for c in ("x0", "y0", "role", "at")],
                   ("words", pa.binary()), ("segments", pa.binary())])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashed words of the asked spans. Rows are sorted: a document's text (texts, if rows share the
    id), then what is asked of it, so that its words are hashed once and one document is held."""
    words_all = hasher().words_all
    key, texts, hashed = None, [], None
    for batch in batches:
        rows = []
        text_column = batch.column(batch.schema.get_field_index("text"))
        plain = batch.drop_columns(["text"]).to_pylist()
        # Texts that are asked for in this batch are hashed together.
        asked = [i for i, (r, after) in enumerate(itertools.pairwise(plain)) if r["role"] < 0 <= after["role"]]
        words_by_row = dict(zip(asked, words_all([text_column[i].as_py() or "" for i in asked]), strict=True))
        for i, r in enumerate(plain):
            if (r["doc_id"], r["salt"]) != key:
                key, texts, hashed = (r["doc_id"], r["salt"]), [], None
            if r["role"] < 0:
                text = text_column[i].as_py()
                if text not in [t for t, _ in texts]:
                    texts.append((text, words_by_row.get(i)))
                continue
            if hashed is None:
                hashed = [(words_all([text or ""])[0] if words is None else words).astype(np.uint32) for text, words in texts]
            at = max(0, r["a"] - MARGIN)
            rows.extend(
                (r["later"], r["earlier"], r["x0"], r["y0"], r["role"], at, words[at : r["b"] + MARGIN].tobytes(), r["segments"])
                for words in hashed if len(words) >= r["b"])
        columns = list(zip(*rows, strict=True)) or [()] * len(_SPAN)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SPAN, strict=True)], schema=_SPAN)


PASSAGE = "doc_id long, start int, end int, source_id long, source_start int, source_end int, matched int, identity double"


#: Words of pairs that are looked at together for what they share.
SHARED_WORDS = 1 << 15


def _may_hold_passages(pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each (a, b): are there ``MIN_WORDS`` words in a row of a of which enough occur in b at all?"""
    out, some, held = np.zeros(len(pairs), bool), [], 0
    for i, (a, b) in enumerate(pairs):
        if len(a) < MIN_WORDS or not len(b):
            continue
        some.append(i)
        held += len(a) + len(b)
        if held >= SHARED_WORDS:
            out[some] = _share_enough([pairs[k] for k in some])
            some, held = [], 0
    if some:
        out[some] = _share_enough([pairs[k] for k in some])
    return out


def _share_enough(pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    sides = []
    for side in zip(*pairs, strict=True):
        pair = np.repeat(np.arange(len(side), dtype=np.uint64), _sizes(side))
        sides.append((pair, pair << np.uint64(32) | np.concatenate(side)))
    (pair, words), (_, others) = sides
    others.sort()
    at = others.searchsorted(words)
    at[at == len(others)] = 0
    shared = np.zeros(len(words) + 1, np.int64)
    np.cumsum(others[at] == words, out=shared[1:])
    enough = shared[MIN_WORDS:] - shared[:-MIN_WORDS] >= LEAST_SHARED
    enough &= pair[MIN_WORDS - 1 :] == pair[: len(enough)]
    out = np.zeros(len(pairs), bool)
    out[pair[: len(enough)][enough].astype(np.int64)] = True
    return out


def _is_passage(x0: int, x1: int, y0: int, y1: int, matched: int) -> bool:
    return x1 - x0 >= MIN_WORDS and matched >= IDENTITY * max(x1 - x0, y1 - y0)


def _try_chains(tasks: list[Task]) -> list[list[tuple[int, int, int, int, int]]]:
    """Each chain's passages. Changes crowded near an end cut an alignment short; a lower loss reaches
    beyond them. A chain that makes none as a whole is tried by its segments."""
    out: list[list] = [[] for _ in tasks]
    matched, until, ends = _cores(tasks)
    left = list(range(len(tasks)))
    for loss in (1.5, LEAST_LOSS):
        cores = matched[left], [until[t] for t in left], tuple(tuple([side[t] for t in left] for side in end) for end in ends)
        for t, got in zip(left, _extended([tasks[t] for t in left], cores, loss), strict=True):
            if _is_passage(*got):
                out[t].append(got)
        left = [t for t in left if not out[t]]
    parts = [(t, (*tasks[t][:4], [s])) for t in left if len(tasks[t][4]) > 1 for s in tasks[t][4]]
    for (t, _), got in zip(parts, align_all([p for _, p in parts]), strict=True):
        if _is_passage(*got):
            out[t].append(got)
    return out


Cluster = tuple[np.ndarray, np.ndarray, int, int, np.ndarray]


def align_clusters(items: list[Cluster]) -> list[list[tuple[int, int, int, int, int]]]:
    """Passages x0, x1, y0, y1, agreeing words of each cluster (a, b, a's and b's first position,
    segments). Chains of all clusters are aligned side by side: first every cluster's best one, then
    the others. A chain whose words lie in a passage of a better one adds nothing to what repeats,
    and is passed over."""
    found: list[list] = [[] for _ in items]
    covers = [Cover() for _ in items]
    waiting: list[list[tuple[int, Task]]] = [[], []]
    may_hold = _may_hold_passages([item[:2] for item in items]).tolist()
    for c, (a, b, a_at, b_at, segments) in enumerate(items):
        if not may_hold[c]:
            continue
        for k, (_, links) in enumerate(itertools.groupby(segments.tolist(), lambda s: s[0])):
            waiting[k > 0].append((c, (a, b, a_at, b_at, [tuple(s[1:]) for s in links])))
    for chains in waiting:
        tasks, parts = [], []
        for c, (a, b, a_at, b_at, links) in chains:
            x0, x1, y0, y1 = links[0][0], links[-1][1] + K - 1, links[0][2], links[-1][3] + K - 1
            if covers[c].holds(x0, x1):
                continue
            i, j = max(0, x0 - MARGIN - a_at), max(0, y0 - MARGIN - b_at)
            near = a[i : x1 + MARGIN - a_at], b[j : y1 + MARGIN - b_at]
            if len(near[0]) + len(near[1]) < len(a) + len(b):
                parts.append(len(tasks))
            tasks.append((c, (*near, a_at + i, b_at + j, links)))
        none = {k for k, may in zip(parts, _may_hold_passages([tasks[k][1][:2] for k in parts]).tolist(), strict=True) if not may}
        tasks = [t for k, t in enumerate(tasks) if k not in none]
        for (c, task), got in zip(tasks, _try_chains([t for _, t in tasks]), strict=True):
            if got and not covers[c].holds(task[4][0][0], task[4][-1][1] + K - 1):
                found[c].extend(got)
                for x0, x1, *_ in got:
                    covers[c].add(x0, x1)
    return found


class Cover:
    """Ranges of which none lies in another, in order."""

    def __init__(self):
        self.starts, self.ends = [], []

    def holds(self, start: int, end: int) -> bool:
        """Whether [start, end) lies in one of the ranges added."""
        at = bisect.bisect_right(self.starts, start)
        return at > 0 and end <= self.ends[at - 1]

    def add(self, start: int, end: int) -> None:
        if self.holds(start, end):
            return
        first, last = bisect.bisect_left(self.starts, start), bisect.bisect_right(self.ends, end)
        self.starts[first:last], self.ends[first:last] = [start], [end]


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows are sorted by cluster and role: the later document's words and the segments, then the
    earlier one's words."""
    key, sides = None, []
    for batch in batches:
        names, items = [], []
        for r in batch.to_pylist():
            if (r["later"], r["earlier"], r["x0"], r["y0"]) != key:
                key, sides = (r["later"], r["earlier"], r["x0"], r["y0"]), []
            words = np.frombuffer(r["words"], "<u4")
            if r["role"] == 0:
                sides.append((words, r["at"], np.frombuffer(r["segments"], "<i4").reshape(-1, 5)))
                continue
            for a, a_at, segments in sides:
                names.append(key[:2])
                items.append((a, words, a_at, r["at"], segments))
        out = [
            (later, x0, x1, earlier, y0, y1, matched, matched / max(x1 - x0, y1 - y0))
            for (later, earlier), found in zip(names, align_clusters(items), strict=True) for x0, x1, y0, y1, matched in found
        ]
        columns = list(zip(*out, strict=True)) or [()] * 8
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [f.split()[0] for f in PASSAGE.split(", ")])


def passages(docs: DataFrame) -> DataFrame:
    """Every passage of a document that an earlier one (smaller doc_id) holds as well: its words
    [start, end), the earlier document and place, the agreeing words and their share."""
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    groups = width(docs.sparkSession)
    found = texts.mapInArrow(_seeds(PARTS * groups, groups), PACKED).repartition("kind", "part").sortWithinPartitions("kind", "part")
    matches = found.mapInArrow(_join_seeds(groups), PACKED).repartition("part").sortWithinPartitions("part")
    pairs = stored(matches.mapInArrow(_chains, CLUSTER), "clusters")
    asked = pairs.select("later", "earlier", "x0", "y0", F.explode(F.array(
        F.struct(F.col("later").alias("doc_id"), F.lit(0).alias("role"), F.col("x0").alias("a"), F.col("x1").alias("b"), "segments"),
        F.struct(F.col("earlier").alias("doc_id"), F.lit(1).alias("role"), F.col("y0").alias("a"), F.col("y1").alias("b"), F.lit(None).alias("segments")),
    )).alias("ask")).select("later", "earlier", "x0", "y0", "ask.*")
    # A document that very many others are compared with is asked in several groups, with its text in each.
    hot = asked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP_ASKS)
    hot = stored(hot.select("doc_id", F.ceil(F.col("n") / GROUP_ASKS).cast("int").alias("groups")), "hot_documents")
    n_hot = hot.count()
    if n_hot:
        hot = F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot
        group = F.pmod(F.xxhash64("later", "earlier", "x0", "y0"), F.coalesce("groups", F.lit(1))).cast("int")
        asked = asked.join(hot, "doc_id", "left").withColumn("salt", group).drop("groups")
        texts = texts.join(hot, "doc_id", "left").select(
            "doc_id", "text", F.explode(F.sequence(F.lit(0), F.coalesce("groups", F.lit(1)) - 1)).alias("salt"))
    else:
        asked, texts = asked.withColumn("salt", F.lit(0)), texts.withColumn("salt", F.lit(0))
    rows = texts.where(F.col("doc_id").isNotNull()).withColumn("role", F.lit(-1)).unionByName(asked, allowMissingColumns=True)
    rows = rows.repartition("doc_id", "salt").sortWithinPartitions("doc_id", "salt", "role")
    spans = rows.mapInArrow(_spans, SPAN).repartition("later", "earlier", "x0", "y0")
    return spans.sortWithinPartitions("later", "earlier", "x0", "y0", "role").mapInArrow(_aligned, PASSAGE)


def cut(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the passages in ``found``; a document of which no word is left goes."""
    spans = found.groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # at most a document's words
    joined = docs.alias("d").join(spans.alias("s"), F.col("d.doc_id") == F.col("s.doc_id"), "left")
    at, kept = docs.columns.index("text"), len(docs.columns)

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = batch.column(kept).to_pylist()
            texts = [_without(t.as_py(), s) if s else t.as_py() for t, s in zip(batch.column(at), cuts, strict=True)]
            whole = pa.array([not s or bool(t.strip()) for t, s in zip(texts, cuts, strict=True)], pa.bool_())
            columns = [pa.array(texts, batch.column(at).type) if i == at else batch.column(i) for i in range(kept)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:kept]).filter(whole)

    return map_rows(joined.select(*named(docs, "d"), "s.spans"), shorten, kept)


def _without(text: str, spans: list[dict]) -> str:
    words = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for s in sorted(spans, key=lambda s: s["start"]):
        start, end = words[s["start"]][0], words[min(s["end"], len(words)) - 1][1]
        if start > at:
            out.append(text[at:start])
        at = max(at, end)
    out.append(text[at:])
    return "".join(out)
