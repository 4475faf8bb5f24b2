"""Toxicity scores that see through simple disguises.

1. A character language model (interpolated 5-grams in a hashed table of fixed size) is counted over
   the words of all documents.
2. Tokens that look disguised (digits or signs among letters, letters said three times, letters
   set apart) become lattices of what each character may stand for: the letters a sign resembles,
   one or two of a repeated letter, nothing for stray signs, a word border between spaced
   letters. The Viterbi path under the language model and the costs of the channel is the
   restored text. Restored words are scored beside the words as written.
3. A logistic model on hashed words and word beginnings, each counted once per text, is fitted in
   numpy on a bounded sample of labelled documents, with an L1 penalty.

Defined results. Null or empty text: the model's bias alone. Label null, or of an unknown
document: not learned from. No labelled document: score 0. Repeated rows: each is scored. Empty
table: no rows. Further columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import held_out, kept

ORDER = 5
#: Words whose grams are counted at a time: arrays of some MB, not as large as the vocabulary.
COUNTED_WORDS = 1 << 15
#: Entries of the language model's count table: its size does not depend on the corpus.
TABLE = 1 << 19
#: Most labelled documents of each class that the classifier is fitted on.
SAMPLE_PER_CLASS = 6000
BUCKETS = 1 << 18
BEGINNINGS = (3, 4, 5, 6, 7)
EPOCHS = 8
RATE = 0.3
PENALTY = 0.02
MEMO_WORDS = 400_000
#: Tokens without a feature of any weight that are remembered, about 100 bytes each.
MEMO_WITHOUT = 800_000
WORD = re.compile(r"[^\W\d_]+")

# Letters that signs and digits stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou",
}
#: Costs of the channel (negative natural logarithms).
AS_SIGN, DROPPED, ONCE, TWICE, AS_WRITTEN, BORDER = 1.0, 1.5, 0.5, 1.0, 3.0, 4.0

_SIGNS = "".join(re.escape(c) for c in LOOKS_LIKE)
#: A sign between letters, or before two letters at a token's start.
MIXED = re.compile(rf"[^\W\d_][{_SIGNS}]+[^\W\d_]|^[{_SIGNS}][^\W\d_]{{2}}")
#: A letter twice or three times; three doublings or one tripling look disguised.
DISGUISED = re.compile(r"([^\W\d_])\1(?:\1|.*?([^\W\d_])\2.*?([^\W\d_])\3)", re.S)
#: Punctuation around a word.
AROUND = ".,;:?\"')]}"
#: Single characters set apart, within a token by a sign, or by spaces.
PARTED = re.compile(rf"^(?:[^\W_]|[{_SIGNS}])([.\-_*])(?:(?:[^\W_]|[{_SIGNS}])\1){{2,}}(?:[^\W_]|[{_SIGNS}])[.,;:!?]*$")
SPACED = re.compile(r"(?<!\S)\S \S \S \S(?: \S)*(?!\S)")
_RUN = re.compile(r"(.)\1*", re.S)


_ALL = (1 << 64) - 1


def _mix(h: np.ndarray) -> np.ndarray:
    """Mixes the bits of ``h`` in place."""
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


def grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-grams of an array of code points."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    codes = codes.astype(np.uint64, copy=False)
    h = np.full(m, n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            h *= np.uint64(1_000_003)
            h += codes[j : j + m]
            h = _mix(h)
    return h


def gram(text: str) -> int:
    """``grams`` for one short text, in plain integers."""
    h = len(text) + 1
    for c in text:
        h = (h * 1_000_003 + ord(c)) & _ALL
        h ^= h >> 31
        h = (h * 0x9E3779B97F4A7C15) & _ALL
        h ^= h >> 29
    return h


def count_grams(words: Counter) -> np.ndarray:
    """The table's counts: grams of each order in its first half, contexts in its second."""
    table, pairs = np.zeros(TABLE, np.int64), iter(words.items())
    while some := dict(itertools.islice(pairs, COUNTED_WORDS)):
        table += _count_some(some)
    return table


def _count_some(words: dict[str, int]) -> np.ndarray:
    table, half = np.zeros(TABLE, np.int64), TABLE // 2
    text = "".join("<" * (ORDER - 1) + w + ">" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.array([len(w) + ORDER for w in words], np.int64)
    weight = np.repeat(np.array(list(words.values()), np.int64), lengths)
    inside = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)  # place in the word's frame
    context = np.zeros(len(codes), np.uint64)  # before single characters: none
    for n in range(1, ORDER + 1):
        h = grams(codes, n)
        last = np.arange(len(h)) + n - 1  # the predicted character
        ok = (inside[last] >= ORDER - 1) & (inside[last] >= n - 1)
        at = (h[ok] % np.uint64(half)).astype(np.int64)
        table += np.bincount(at, weights=weight[last[ok]], minlength=TABLE).astype(np.int64)
        at = (context[: len(h)][ok] % np.uint64(half)).astype(np.int64) + half
        table += np.bincount(at, weights=weight[last[ok]], minlength=TABLE).astype(np.int64)
        context = h  # the grams of one character less
    return table


def character_counts(docs: DataFrame) -> np.ndarray:
    """Counts over the words of all documents. The driver gets at most one number per entry."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(TABLE, np.int64)
        for batch in batches:
            tokens: Counter = Counter()
            for text in batch.column(0):
                tokens.update((text.as_py() or "").lower().split())
            words: Counter = Counter()
            for token, n in tokens.items():
                for word in [token] if token.isalpha() else WORD.findall(token):
                    words[word] += n
            table += count_grams(words)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at])], ["entry", "n"])

    rows = docs.select("text").mapInArrow(count, "entry long, n long").groupBy("entry").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(TABLE, np.int64)
    table[rows.column("entry").to_numpy()] = rows.column("n").to_numpy()
    return table


class Entries(dict):
    """The table's entries of grams met so far; contexts and short grams come again with most characters."""

    def __missing__(self, text: str) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        self[text] = entry = gram(text) % (TABLE // 2)
        return entry


class CharacterModel:
    """Log-probabilities of characters after up to four others."""

    def __init__(self, table: np.ndarray):
        self.table, self.memo, self.entries = table.tolist(), {}, Entries()

    def log_chance(self, context: str, c: str) -> float:
        key = (context, c)
        if key not in self.memo:
            if len(self.memo) > MEMO_WORDS:
                self.memo.clear()
            half, p, table, entries = TABLE // 2, 1e-4, self.table, self.entries
            text = context + c
            for n in range(1, ORDER + 1):
                own = text[len(text) - n :]
                seen = table[entries[own]]
                total = table[(entries[own[:-1]] if n > 1 else 0) + half]
                p = (min(seen, total) + 4 * p) / (total + 4)
            self.memo[key] = math.log(p)
        return self.memo[key]


def lattice(token: str, spaced: bool) -> list[list[tuple[str, float]]]:
    """What each run of equal characters may stand for, with its cost."""
    slots = []
    for run in _RUN.finditer(token.lower()):
        c, n = run.group(1), len(run.group(0))
        if c.isalpha():
            options = [(c, 0.0 if n == 1 else ONCE)]
            if n > 1:
                options.append((c * 2, TWICE if n > 2 else 0.0))
        elif c in LOOKS_LIKE:
            options = [(x * k, AS_SIGN + (k - 1)) for x in LOOKS_LIKE[c] for k in range(1, min(n, 2) + 1)] + [("", DROPPED)]
        else:
            options = [("", DROPPED)]
        if spaced and slots:
            options += [("><" + x, cost + BORDER) for x, cost in options if x]
        slots.append(options)
    return slots


def decode(token: str, model: CharacterModel, spaced: bool = False) -> list[str]:
    """The words on the best path through the token's lattice."""
    start = "<" * (ORDER - 1)
    states: dict[str, tuple[float, str]] = {start: (0.0, "")}
    for options in [*lattice(token, spaced), [(">", 0.0)]]:
        after: dict[str, tuple[float, str]] = {}
        for context, (cost, said) in states.items():
            for text, extra in options:
                total, now = cost + extra, context
                for c in text:
                    if c == "<":
                        now = start
                        continue
                    total -= model.log_chance(now, c)
                    now = (now + c)[-(ORDER - 1) :]
                if now not in after or total < after[now][0]:
                    after[now] = (total, said + text.replace("><", " ").replace(">", ""))
        states = after
    return min(states.values())[1].split()


def token_words(token: str, model: CharacterModel) -> list[str]:
    """A token's words as written and, if it looks disguised, as restored."""
    token = token.lower()
    if token.isalpha():
        return [token, *decode(token, model)] if _repeated(token) else [token]
    words = WORD.findall(token)
    if PARTED.search(token):
        words += decode(token[::2], model, spaced=True)
    elif MIXED.search(token) or _repeated(token):
        words += decode(token, model)
    return words


def _repeated(token: str) -> bool:
    return DISGUISED.search(token) is not None


def features(word: str) -> list[int]:
    """The buckets of the word in a frame and of its framed beginnings."""
    framed = f"<{word}>".encode("utf-8", "surrogatepass")
    if len(framed) == len(word) + 2:  # one byte a character
        names = [framed, *[framed[: n + 1] for n in BEGINNINGS[: max(0, len(word) - BEGINNINGS[0])]]]
    else:
        names = [framed, *[f"<{word[:n]}".encode("utf-8", "surrogatepass") for n in BEGINNINGS if len(word) > n]]
    return [zlib.crc32(x) % BUCKETS for x in names]


class Extractor:
    """Features of texts; remembers those of each token, and the tokens that have none."""

    def __init__(self, table: np.ndarray, wanted: np.ndarray | None = None):
        self.model, self.memo, self.without = CharacterModel(table), {}, set()
        self.wanted = np.ones(BUCKETS, bool).tobytes() if wanted is None else (wanted != 0).tobytes()

    def _token(self, token: str, spaced: bool = False) -> tuple[int, ...]:
        words = decode(token[::2], self.model, spaced=True) if spaced else token_words(token, self.model)
        wanted = self.wanted
        return tuple({f for w in words for f in features(w) if wanted[f]}) if words else ()

    def _new(self, token: str) -> tuple[int, ...]:
        word = token.rstrip(AROUND)
        if word in self.without:
            own = ()
        elif (own := self.memo.get(word)) is None:
            own = self._token(word)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        if len(self.without) > MEMO_WITHOUT:
            self.without.clear()
        if own:
            self.memo[word] = self.memo[token] = own
        else:
            self.without.update((word, token))
        return own

    def of(self, text: str | None) -> set[int]:
        """The features that the text has at least once."""
        text = text or ""
        hits: set[int] = set()
        memo = self.memo
        for token in set(text.split()).difference(self.without):
            own = memo.get(token)
            hits.update(self._new(token) if own is None else own)
        for run in SPACED.finditer(text):
            hits.update(self._token(run.group(0), spaced=True))
        return hits


@dataclass
class Classifier:
    weights: np.ndarray
    bias: float
    key: str


def train(rows: list[np.ndarray], labels: list[int], seed: int = 3) -> Classifier | None:
    """Logistic regression by adaptive stochastic gradient descent with soft thresholding. A
    feature of fewer than three texts is not used."""
    if not rows:
        return None
    seen = np.bincount(np.concatenate(rows), minlength=BUCKETS)
    rows = [x[seen[x] >= min(3, len(rows))] for x in rows]
    share = min(max(sum(labels) / len(labels), 1e-3), 1 - 1e-3)
    weights, squares, bias = np.zeros(BUCKETS), np.full(BUCKETS, 1e-2), math.log(share / (1 - share))
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)).tolist():
            x = rows[i]
            error = _chance(weights[x].sum() + bias) - labels[i]
            squares[x] += error * error
            step = RATE / np.sqrt(squares[x])
            moved = weights[x] - step * error
            weights[x] = np.sign(moved) * np.maximum(np.abs(moved) - step * PENALTY, 0)
            bias -= 0.02 * error
    return Classifier(weights.astype(np.float32), float(bias), uuid.uuid4().hex)


def _chance(x: float) -> float:
    return 1 / (1 + math.exp(-min(max(x, -30.0), 30.0)))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> list:
    """Texts and labels to learn from: of each class the documents with the smallest hashes."""
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).select("doc_id", "toxic").distinct()
    sizes = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    span = 1 << 40
    bound = F.lit(0).cast("long")
    for label, n in sizes.items():
        # A sixth more than wanted on average; what is still over is cut below.
        bound = F.when(F.col("toxic") == label, min(span, span * per_class * 7 // (6 * n) + 1)).otherwise(bound)
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < bound)
    # At most about 14,000 rows of two numbers.
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    found = rows.select("text", "toxic", F.pmod(F.xxhash64("doc_id"), F.lit(span)).alias("order")).collect()
    out, taken = [], Counter()
    for r in sorted(found, key=lambda r: (r.order, r.text)):
        if taken[r.toxic] < per_class:
            taken[r.toxic] += 1
            out.append((r.text, r.toxic))
    return out


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, Classifier | None]:
    """The language model's counts and the classifier."""
    table = character_counts(docs)
    extractor, rows, marks = Extractor(table), [], []
    for text, label in sample(docs, labels):
        rows.append(np.array(sorted(extractor.of(text)), np.int32))
        marks.append(int(label))
    return table, train(rows, marks)


def extractor_of(table: np.ndarray, classifier: Classifier) -> Extractor:
    """The worker's extractor for a classifier, kept from task to task with the tokens it has met."""
    return kept(("toxicity", classifier.key), lambda: Extractor(table, classifier.weights != 0))


def score(docs: DataFrame, table: np.ndarray, classifier: Classifier | None) -> DataFrame:
    """doc_id and the probability that the document is toxic."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if classifier is not None:
            extractor = extractor_of(table, classifier)
            weights = classifier.weights.tolist()
        for batch in batches:
            out = [
                0.0 if classifier is None
                else _chance(sum(map(weights.__getitem__, sorted(extractor.of(text.as_py())))) + classifier.bias)
                for text in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(apply, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled documents that are not held out and score all documents."""
    table, classifier = fit(docs, labels)
    scored = score(docs, table, classifier)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
