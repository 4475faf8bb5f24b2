"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the average of its words' vectors, a word that of its hashed subwords' (the word
itself and its character n-grams between borders). The classifier is linear in that average. Both
are trained by stochastic gradient descent in numpy on a bounded sample of labelled documents,
equally many per language. A part of the sample that training does not see sets the temperature
of the probabilities and the threshold below which a prediction is rejected.

Applying the model is linear as well: each word contributes its subwords' scores, looked up
per distinct word, so a text costs one look-up per word and there is no limit on its length.

Defined results. Null text or one without any letter: ``und`` with score 0, rejected. Null lang:
never learned from. Ties in score: the first language in sorted order. No labelled document:
every prediction is ``und``. Empty table: no rows. Further columns are ignored.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import held_out, kept, map_rows, slices

#: Most labelled documents per language that the model is fitted on.
SAMPLE_PER_LANGUAGE = 600
#: Most labelled documents over all languages.
SAMPLE_TOTAL = 8000
#: Most languages: those with the most labelled documents.
LANGUAGES = 400
BUCKETS = 1 << 15
WIDTH = 16
NGRAMS = (1, 2, 3, 4)
EPOCHS = 6
#: Least number of training steps: few labelled documents are gone through more often.
STEPS = 12_000
RATE = 0.5
#: Share of good held-back documents that the rejection threshold may cost, at most.
REJECT_SHARE = 0.001
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
#: Distinct words a worker remembers.
MEMO_WORDS = 600_000


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # a row per bucket: what a subword adds to each language's score
    bias: np.ndarray
    temperature: float
    threshold: float
    key: str

    def judge(self, raw: np.ndarray) -> tuple[str, float, bool]:
        chances = _softmax(raw / self.temperature)
        i = int(chances.argmax())
        return self.languages[i], float(chances[i]), bool(chances[i] < self.threshold)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed subwords of many words at once, a block per length of n-gram and one for the words
    themselves: buckets (a row per block), whether each is one, and where the words begin."""
    framed = [f"<{w}>" for w in words]
    codes = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.array([len(w) for w in framed])
    begins = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(framed)), lengths)
    buckets = np.zeros((len(NGRAMS) + 1, len(codes)), np.int64)
    real = np.zeros((len(NGRAMS) + 1, len(codes)), bool)
    with np.errstate(over="ignore"):
        for row, n in enumerate(NGRAMS):
            size = len(codes) - n + 1
            if size < 1:
                continue
            h = np.full(size, n, np.uint64)
            for j in range(n):
                h = _mix(h + codes[j : j + size])
            buckets[row, :size] = (h % np.uint64(BUCKETS)).astype(np.int64)
            real[row, :size] = owner[:size] == owner[n - 1 :]
        place = (np.arange(len(codes)) - begins[owner]).astype(np.uint64)
        whole = np.add.reduceat(_mix(codes + (place << np.uint64(32))), begins)
        buckets[-1, begins] = (_mix(whole) % np.uint64(BUCKETS)).astype(np.int64)
        real[-1, begins] = True
    return buckets, real, begins


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's subwords with their weights in its average."""
    counts: dict[str, int] = {}
    for word in WORD.findall(text.lower()):
        counts[word] = counts.get(word, 0) + 1
    buckets, real, begins = subwords(list(counts))
    each = np.array(list(counts.values())) / sum(counts.values()) / np.add.reduceat(real.sum(0), begins)
    weights = np.broadcast_to(np.repeat(each, np.diff(np.append(begins, real.shape[1]))), real.shape)
    index, at = np.unique(buckets[real], return_inverse=True)
    return index, np.bincount(at, weights=weights[real], minlength=len(index))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: list[str], labels: list[str], seed: int = 7) -> Model | None:
    """Fit embeddings and softmax by stochastic gradient descent; every fifth text is held back
    to set the temperature and the threshold."""
    kept_rows = [(t, y) for t, y in zip(texts, labels, strict=True) if WORD.search(t or "")]
    if not kept_rows:
        return None
    languages = sorted({y for _, y in kept_rows})
    known = {y: i for i, y in enumerate(languages)}
    rng = np.random.default_rng(seed)
    rows = [(*_features(t), known[y]) for t, y in kept_rows]
    order = rng.permutation(len(rows))
    held = {int(i) for i in order[::5]} if len(rows) >= 10 else set()
    embed = rng.normal(0, 1 / WIDTH, (BUCKETS, WIDTH))
    weights, bias = np.zeros((WIDTH, len(languages))), np.zeros(len(languages))
    learn = [int(i) for i in order if int(i) not in held]
    epochs = max(EPOCHS, -(-STEPS // len(learn)))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for i in rng.permutation(learn).tolist():
            index, weight, y = rows[i]
            mean = weight @ embed[index]
            error = _softmax(mean @ weights + bias)
            error[y] -= 1
            back = weights @ error
            weights -= rate * np.outer(mean, error)
            bias -= rate * 0.1 * error
            embed[index] -= rate * len(index) ** 0.5 * np.outer(weight, back)
    scores = embed @ weights
    # Calibration on whole texts and on their first words, since short texts are the uncertain ones.
    check = [(t, y) for i in sorted(held) or range(len(kept_rows)) for t, y in [kept_rows[i]]]
    check += [(" ".join(WORD.findall(t)[: 1 + n % 12]), y) for n, (t, y) in enumerate(check)]
    found = [(_features(t), known[y]) for t, y in check]
    raw = np.array([w @ scores[i] + bias for (i, w), _ in found])
    truth = np.array([y for _, y in found])
    best = min(np.geomspace(0.1, 20, 53), key=lambda t: -np.log(_softmax(raw / t)[np.arange(len(truth)), truth] + 1e-12).sum())
    chances = _softmax(raw / best)
    right = chances.max(1)[chances.argmax(1) == truth]
    floor = float(np.quantile(right, REJECT_SHARE)) if len(right) else 0.0
    # Half of the least sure right answer: what is rejected is unlike anything that was learned.
    return Model(languages, scores.astype(np.float32), bias.astype(np.float32), float(best), floor / 2, uuid.uuid4().hex)


def sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, languages: int = LANGUAGES) -> list:
    """The labelled documents to learn from: per language those with the smallest hashes. The
    choice is made on ids alone, so that texts of at most ``per_language`` × ``languages``
    documents move."""
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    sizes = {r.lang: r.n for r in sizes.collect()}
    if not sizes:
        return []
    per_language = max(1, min(per_language, SAMPLE_TOTAL // len(sizes)))
    # A hash below the bound keeps about twice the wanted number; the surplus is cut below.
    span = 1 << 40
    bound = F.lit(0).cast("long")
    for lang, n in sizes.items():
        bound = F.when(F.col("lang") == lang, min(span, 2 * span * per_language // n + 1)).otherwise(bound)
    order = F.pmod(F.xxhash64("doc_id"), F.lit(span))
    rows = usable.where(order < bound).select("lang", "text", order.alias("order")).collect()
    out, taken = [], {}
    for r in sorted(rows, key=lambda r: (r.order, r.text)):
        if taken.setdefault(r.lang, 0) < per_language:
            taken[r.lang] += 1
            out.append((r.text, r.lang))
    return out


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    rows = sample(docs, per_language)
    return train([t for t, _ in rows], [y for _, y in rows])


class Scorer:
    """Applies a model; remembers what each word adds."""

    def __init__(self, model: Model | None):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.model.languages) if self.model else 0), np.float32)

    def _learn(self, words: Iterable[str]) -> None:
        """Scores of words not met before: the mean over their subwords."""
        words = dict.fromkeys(words)
        if len(self.memo) > MEMO_WORDS:
            self._forget()
        new = [w for w in words if w not in self.memo]
        buckets, real, begins = subwords(new)
        total = sum(np.add.reduceat(self.model.scores[b] * r[:, None], begins) for b, r in zip(buckets, real, strict=True))
        end = len(self.memo) + len(new)
        if end > len(self.rows):
            self.rows = np.resize(self.rows, (2 * end, self.rows.shape[1]))
        self.rows[len(self.memo) : end] = total / np.add.reduceat(real.sum(0), begins)[:, None]
        self.memo.update(zip(new, range(len(self.memo), end), strict=True))

    def scores(self, texts: list[str | None]) -> Iterator[tuple[str, float, bool]]:
        """Language, probability and whether it is rejected, of each text."""
        for a, b in slices(len(texts), 128):
            words = [WORD.findall((t or "").lower()) for t in texts[a:b]] if self.model else [[]] * (b - a)
            if any(w not in self.memo for own in words for w in own):
                self._learn(itertools.chain.from_iterable(words))
            for own in words:
                if not own:
                    yield UNKNOWN, 0.0, True
                    continue
                at = np.fromiter(map(self.memo.__getitem__, own), np.int64, len(own))
                yield self.model.judge(self.rows[at].mean(0, dtype=np.float64) + self.model.bias)


def scorer_of(model: Model | None) -> Scorer:
    """The worker's scorer of a model, with the words it has met in earlier tasks."""
    return kept(("language", model.key if model else ""), lambda: Scorer(model))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score and rejected for every document."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(model)
        for batch in batches:
            found = list(scorer.scores(batch.column(1).to_pylist()))
            lang, score, rejected = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    schema = "doc_id long, lang_pred string, score double, rejected boolean"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(apply, schema)


def identify(docs: DataFrame) -> DataFrame:
    """Train on ``docs`` (text, lang of those not held out) and predict all of them."""
    out = predict(docs, fit(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, all columns as they are."""
    model, at = fit(docs), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(model)
        for batch in batches:
            yield batch.filter(pa.array([not s[2] for s in scorer.scores(batch.column(at).to_pylist())], pa.bool_()))

    return map_rows(docs, keep, len(docs.columns))
