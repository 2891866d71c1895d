"""Quality scores from support vectors on naive-Bayes features.

N-grams: single words, and runs of one to three word shapes. A shape is the
word with its letters, capitals and digits each reduced to one sign and runs
collapsed (``THE!!`` and ``AND!!`` are one shape); a word that repeats the one
before counts as the shape ``=``. An indicator says whether a text has an
n-gram. Each indicator is scaled by the log-count ratio of its class counts,

    r = log((p + 1) / |p + 1|) - log((q + 1) / |q + 1|)

and a linear model with hinge loss is fitted to the scaled indicators by dual
coordinate descent. A logistic curve through the margins of the training texts gives scores.

Labels come from a sample of at most ``SAMPLE`` labelled rows, those with the
smallest hash of doc_id; only their n-gram numbers reach the driver. The list
of n-grams has at most ``FEATURES`` entries, chosen by their counts over the
sample. Scoring covers every whole text.

Defined cases: null and empty texts score what the intercept gives. Repeated
rows get the same score. Without both classes among the training labels, every
score is that of the only class, 0.5 without any label. An empty table gives an
empty result. Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, sliced
from .toxicity import held_out, training_sample

SAMPLE = 16_000
FEATURES = 20_000
LEAST_DOCS = 4
COST = 0.1
ROUNDS = 30
RUN = 3
KNOWN_SHAPES = 200_000

# a: lower-case letters, A: capitals, 0: digits; bytes beyond ASCII are letters of words and left out
_SIGN = bytearray(range(256))
for _c in range(256):
    if 97 <= _c <= 122:
        _SIGN[_c] = ord("a")
    elif 65 <= _c <= 90:
        _SIGN[_c] = ord("A")
    elif 48 <= _c <= 57:
        _SIGN[_c] = ord("0")
_SIGN = bytes(_SIGN)
_BEYOND = bytes(range(128, 256))


def shape_of(word: str) -> str:
    """``It's`` is ``Aa'a``: signs with runs collapsed."""
    signs = word.encode("utf-8", "surrogatepass").translate(_SIGN, _BEYOND).decode()
    out = signs[:1]
    for c in signs[1:]:
        if c != out[-1]:
            out += c
    return out or "a"


class Shapes(dict):
    """Remembers the shapes of words, a bounded number of them."""

    def __missing__(self, word: str) -> str:
        shape = shape_of(word)
        if len(self) < KNOWN_SHAPES:
            self[word] = shape
        return shape


def ngrams(text: str | None, shapes: Shapes, words: bool = True) -> set:
    """The n-grams of a text: words as strings, runs of shapes as tuples."""
    found = (text or "").split()
    shaped = ["=" if w == before else shapes[w] for w, before in zip(found, ["", *found], strict=False)]
    out: set = set(zip(shaped))
    out.update(zip(shaped, shaped[1:]))
    out.update(zip(shaped, shaped[1:], shaped[2:]))
    if words:
        out.update(w.lower() for w in set(found))
    return out


def key_of(gram: str | tuple) -> str:
    return gram if isinstance(gram, str) else " ".join(gram) + " "


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, y) to (gram, n, positive), summed within a task: the sample is bounded. A run of shapes ends with a space, a word doesn't."""
    shapes = Shapes()
    counts: dict = {}
    for batch in batches:
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for g in ngrams(text, shapes):
                c = counts.setdefault(g, [0, 0])
                c[0] += 1
                c[1] += y
    columns = [pa.array([key_of(g) for g in counts], pa.string()), *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1))]
    yield pa.RecordBatch.from_arrays(columns, ["gram", "n", "positive"])


def lookup(names: list[str]) -> dict:
    """Number of each n-gram, under the form that ``ngrams()`` gives."""
    return {tuple(g[:-1].split(" ")) if g.endswith(" ") else g: i for i, g in enumerate(names)}


def vector_batches(batches: Iterator[pa.RecordBatch], number: dict) -> Iterator[pa.RecordBatch]:
    """(text, y) to (y, features): the numbers of the n-grams present."""
    shapes = Shapes()
    for batch in batches:
        xs = [sorted(number[g] for g in ngrams(text, shapes) & number.keys()) for text in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), pa.array(xs, pa.list_(pa.int32()))], ["y", "features"])


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, n: int) -> np.ndarray:
    p, q = np.ones(n), np.ones(n)
    for x, label in zip(rows, y, strict=True):
        (p if label > 0 else q)[x] += 1
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, cost: float = COST, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (the last is the intercept) of the linear hinge-loss model on scaled indicators.

    One dual variable for each text, 0 <= a <= c, moved to its optimum in random order. The
    bound c is larger for the smaller class, so that both weigh the same."""
    w = np.zeros(len(ratios) + 1)
    a = np.zeros(len(rows))
    share = (y > 0).mean()
    bound = np.where(y > 0, cost / (2 * share), cost / (2 * (1 - share)))
    values = [np.append(ratios[x], 1.0) for x in rows]
    columns = [np.append(x, len(ratios)) for x in rows]
    norms = np.array([v @ v for v in values])
    order = np.random.default_rng(5)
    for _ in range(rounds):
        most = 0.0
        for i in order.permutation(len(rows)):
            g = y[i] * (w[columns[i]] @ values[i]) - 1
            to = min(max(a[i] - g / norms[i], 0.0), bound[i])
            if to != a[i]:
                w[columns[i]] += (to - a[i]) * y[i] * values[i]
                most = max(most, abs(to - a[i]) / bound[i])
                a[i] = to
        if most < 1e-2:
            break
    return w


def logistic_curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve that turns a margin into a probability, from smoothed targets."""
    up, down = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    weight = np.where(y > 0, 0.5 / up, 0.5 / down)
    slope, offset = 1.0, 0.0
    for _ in range(50):
        s = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        error, curve = weight * (s - target), weight * np.maximum(s * (1 - s), 1e-9)
        gradient = np.array([error @ margins, error.sum()])
        hessian = np.array([[curve @ margins**2, curve @ margins], [curve @ margins, curve.sum()]]) + 1e-6 * np.eye(2)
        step = np.clip(np.linalg.solve(hessian, gradient), -2, 2)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(slope), float(offset)


def score_batches(batches: Iterator[pa.RecordBatch], weights: dict, intercept: float, any_words: bool) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, score)."""
    shapes = Shapes()
    for batch in sliced(batches):
        margins = [intercept + sum(sorted(weights[g] for g in ngrams(t, shapes, any_words) & weights.keys())) for t in batch.column(1).to_pylist()]
        score = 1 / (1 + np.exp(-np.clip(np.array(margins, dtype=np.float64), -30, 30)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])


def quality_model(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> tuple[dict, float]:
    """Weight of each n-gram on the scale of log odds, and the intercept."""
    sample = training_sample(docs, labels, "quality", most)
    size = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positive")).first()
    if not size.n or size.positive in (0, size.n):
        return {}, 0.0 if not size.n else 30.0 if size.positive else -30.0
    counts = in_arrow(sample, count_batches, "gram string, n long, positive long").groupBy("gram").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive"))
    expected = F.col("n") * (size.positive / size.n)
    surprise = F.abs(F.col("positive") - expected) / F.sqrt(F.col("n") + 1)
    best = counts.filter(F.col("n") >= LEAST_DOCS).orderBy(surprise.desc(), "gram").limit(FEATURES)
    names = [r.gram for r in best.select("gram").collect()]
    number = lookup(names)
    collected = in_arrow(sample, lambda it: vector_batches(it, number), "y int, features array<int>").collect()
    rows = [np.array(r.features, dtype=np.int64) for r in collected]
    y = np.array([1.0 if r.y else -1.0 for r in collected])
    ratios = log_count_ratios(rows, y, len(names))
    w = dual_coordinate_descent(rows, y, ratios)
    scaled = w[:-1] * ratios
    margins = np.array([scaled[x].sum() for x in rows]) + w[-1]
    slope, offset = logistic_curve(margins, y)
    return {g: float(slope * scaled[i]) for g, i in number.items() if abs(scaled[i]) > 1e-9}, slope * w[-1] + offset


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs`` (doc_id, text); ``labels``: doc_id, quality."""
    weights, intercept = quality_model(docs, labels, most)
    any_words = any(isinstance(g, str) for g in weights)
    scored = in_arrow(docs.select("doc_id", "text"), lambda it: score_batches(it, weights, intercept, any_words), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
