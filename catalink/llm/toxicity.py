"""Toxicity scores from a counterfactual-regularised classifier.

Features are the distinct lower-cased words of a text and their beginnings of
three to eight letters (insults are inflected). A logistic model is
fitted on labelled texts. For each labelled sentence that names a group, the
identity term is swapped for others, and for sentences that name none a term is
put in front; the fit adds

    lambda * mean((margin(changed) - margin(sentence)) ** 2)

to the loss, so that the mention of a group does not move the score.

Labels come from a sample of at most ``SAMPLE`` labelled rows, those with the
smallest hash of doc_id; only their feature numbers reach the driver. The
feature list has at most ``FEATURES`` entries, chosen by their counts over the
sample. Scoring covers every whole text.

Defined cases: null and empty texts score what the intercept gives. Repeated
rows get the same score. Without any training label, or with one class only,
every score is 0. An empty table gives an empty result. Further columns
of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, saved, sliced

SAMPLE = 16_000
FEATURES = 3_000
LEAST_DOCS = 4
STEMS = (3, 4, 5, 6, 7, 8)
KNOWN_WORDS = 200_000
LAMBDA = 1.0
RIDGE = 0.5
"""Weight of the squared norm, divided by the number of features."""
ROUNDS = 400

#: Identity terms that are swapped among each other, in groups of one grammatical kind.
IDENTITY = (
    tuple("women men girls boys immigrants refugees foreigners muslims jews christians hindus buddhists atheists catholics gays lesbians transgenders africans asians europeans americans arabs mexicans indians".split()),
    tuple("female male muslim jewish christian hindu buddhist atheist catholic gay lesbian bisexual transgender black white asian african european american arab mexican indian disabled blind deaf old young".split()),
    tuple("frauen männer einwanderer muslime juden christen schwule lesben behinderte".split()),
    tuple("femmes hommes immigrés musulmans juifs chrétiens homosexuels handicapés".split()),
    tuple("mujeres hombres inmigrantes musulmanes judíos cristianos homosexuales discapacitados".split()),
)
PARTNER = {t: group for group in IDENTITY for t in group}

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features_of(word: str) -> list[str]:
    """The word, and ``stem*`` for each length of stem that is shorter than the word."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


def text_features(words: set[str]) -> set[str]:
    return {f for w in words for f in features_of(w)}


def held_out() -> F.Column:
    """The rows whose label training must not see."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def training_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(text, y) of at most ``most`` labelled rows outside the held-out fold, as a saved table.

    Of rows with one doc_id one is taken; of several labels of one doc_id the largest counts."""
    usable = labels.select("doc_id", F.col(label).alias("y")).filter(F.col("doc_id").isNotNull() & ~held_out() & F.col("y").isin(0, 1))
    # bounded by ``most`` rows of two numbers, so it can be broadcast
    chosen = usable.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return saved(rows.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "y"), "training-sample")


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, y) to (feature, n, positive), summed within a task: the sample is bounded."""
    counts: dict[str, list[int]] = {}
    for batch in batches:
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for f in text_features(words_of(text)):
                c = counts.setdefault(f, [0, 0])
                c[0] += 1
                c[1] += y
    n, pos = [c[0] for c in counts.values()], [c[1] for c in counts.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(n, pa.int64()), pa.array(pos, pa.int64())], ["feature", "n", "positive"])


def swapped(words: list[str], at: int) -> list[tuple[set[str], set[str]]]:
    """Pairs of word sets of a sentence before and after its identity term changes; without one, a term is put in.

    ``at`` picks the partner, in turn."""
    pairs = []
    plain = set(words)
    terms = [w for w in plain if w in PARTNER]
    for w in terms:
        group = PARTNER[w]
        other = group[(group.index(w) + 1 + at % (len(group) - 1)) % len(group)]
        pairs.append((plain, plain - {w} | {other}))
    if not terms and plain:
        group = IDENTITY[at % len(IDENTITY)]
        pairs.append((plain, plain | {group[at // len(IDENTITY) % len(group)]}))
    return pairs


def vector_batches(batches: Iterator[pa.RecordBatch], number: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """(text, y) to (y, features, changed): numbers of the features present, and those that a swap in one of its
    sentences adds (n + 1) or takes away (-n - 1)."""
    present = lambda words: {number[f] for f in text_features(words) if f in number}
    turn = 0
    for batch in batches:
        xs, ds = [], []
        for text in batch.column(0).to_pylist():
            xs.append(sorted(present(words_of(text))))
            changes: list[list[int]] = []
            sentences = _SENTENCE.findall((text or "").lower())
            named = [s for s in (_WORD.findall(s) for s in sentences) if not PARTNER.keys().isdisjoint(s)]
            for sentence in named or [_WORD.findall(s) for s in sentences[:1]]:
                for before, after in swapped(sentence, turn):
                    turn += 1
                    a, b = present(before), present(after)
                    changes.append([n + 1 for n in b - a] + [-n - 1 for n in a - b])
            ds.append(changes)
        yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), pa.array(xs, pa.list_(pa.int32())), pa.array(ds, pa.list_(pa.list_(pa.int32())))], ["y", "features", "changed"])


def fit(vectors: list, n_features: int, penalty: float = LAMBDA) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated gradient steps on logistic loss, ridge and the counterfactual term."""
    y = np.array([v[0] for v in vectors], dtype=np.float64)
    columns = np.concatenate([np.array(v[1], dtype=np.int64) for v in vectors])
    rows = np.repeat(np.arange(len(y)), [len(v[1]) for v in vectors])
    changes = [c for v in vectors for c in v[2] if c]
    signed = np.concatenate([np.array(c, dtype=np.int64) for c in changes]) if changes else np.zeros(0, dtype=np.int64)
    change_rows = np.repeat(np.arange(len(changes)), [len(c) for c in changes])
    change_columns, signs = np.abs(signed) - 1, np.sign(signed).astype(np.float64)
    # both classes weigh the same
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    scale = 1 / np.sqrt(max(1.0, len(columns) / len(y)))
    w, b = np.zeros(n_features), 0.0
    m, v, mb, vb = np.zeros(n_features), np.zeros(n_features), 0.0, 0.0
    for step in range(1, ROUNDS + 1):
        margin = scale * np.bincount(rows, w[columns], minlength=len(y)) + b
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y)
        g = scale * np.bincount(columns, error[rows], minlength=n_features) + RIDGE * w / n_features
        if len(changes):
            moved = scale * np.bincount(change_rows, signs * w[change_columns], minlength=len(changes))
            g += 2 * penalty * scale / len(changes) * np.bincount(change_columns, signs * moved[change_rows], minlength=n_features)
        gb = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = 0.1 / (1 - 0.9**step)
        w -= rate * m / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        b -= rate * mb / (np.sqrt(vb / (1 - 0.999**step)) + 1e-9)
    return w * scale, float(b)


class Scorer:
    """Scores of texts. The features with a weight are remembered for each word, for most none."""

    def __init__(self, weights: dict[str, float], intercept: float):
        self.weights, self.intercept = weights, intercept
        self.known: dict[str, tuple[str, ...]] = {}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        known, weights, margins = self.known, self.weights, []
        for text in texts:
            present: set[str] = set()
            for word in words_of(text):
                found = known.get(word)
                if found is None:
                    found = tuple(f for f in features_of(word) if f in weights)
                    if len(known) < KNOWN_WORDS:
                        known[word] = found
                if found:
                    present.update(found)
            margins.append(self.intercept + sum(map(weights.__getitem__, sorted(present))))
        return 1 / (1 + np.exp(-np.clip(np.array(margins, dtype=np.float64), -40, 40)))


def score_batches(batches: Iterator[pa.RecordBatch], weights: dict[str, float], intercept: float) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, score)."""
    scorer = Scorer(weights, intercept)
    for batch in sliced(batches):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.scores(batch.column(1).to_pylist()))], ["doc_id", "score"])


def toxicity_model(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, penalty: float = LAMBDA) -> tuple[dict[str, float], float]:
    """Weight of each feature, and the intercept."""
    sample = training_sample(docs, labels, "toxic", most)
    counts = in_arrow(sample, count_batches, "feature string, n long, positive long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive"))
    size = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positive")).first()
    if not size.positive or size.positive == size.n:
        return {}, -40.0
    expected = F.col("n") * (size.positive / size.n)
    surprise = F.abs(F.col("positive") - expected) / F.sqrt(expected + 1)
    best = counts.filter(F.col("n") >= LEAST_DOCS).orderBy(surprise.desc(), "feature").limit(FEATURES)
    names = [r.feature for r in best.select("feature").collect()]
    names += [t for t in sorted(PARTNER) if t not in set(names)]
    number = {f: i for i, f in enumerate(names)}
    rows = in_arrow(sample, lambda it: vector_batches(it, number), "y int, features array<int>, changed array<array<int>>").collect()
    w, b = fit([(r.y, r.features, r.changed) for r in rows], len(names), penalty)
    return {f: float(w[i]) for f, i in number.items() if abs(w[i]) > 1e-6}, b


def toxicity_scores(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, penalty: float = LAMBDA) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs`` (doc_id, text); ``labels``: doc_id, toxic."""
    weights, intercept = toxicity_model(docs, labels, most, penalty)
    scored = in_arrow(docs.select("doc_id", "text"), lambda it: score_batches(it, weights, intercept), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, weights: dict[str, float], intercept: float, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (text, ...) that score below ``least``, with all columns."""
    number = docs.schema.names.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights, intercept)
        for batch in sliced(batches):
            yield batch.filter(pa.array(scorer.scores(batch.column(number).to_pylist()) < least))

    return in_arrow(docs, clean, docs.schema)
