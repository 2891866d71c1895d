"""Classifiers: accuracy outside the training labels, the counterfactual term, and odd inputs."""

import random
import zlib

import numpy as np

from catalink.llm import quality as Q
from catalink.llm import toxicity as X


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def accuracy(scores, truth):
    rows = [r for r in scores.collect() if r.held_out and r.doc_id in truth]
    assert rows and all(held(r.doc_id) for r in rows)
    return sum(r.predicted == truth[r.doc_id] for r in rows) / len(rows)


def corpus(prose, n, change):
    draw = random.Random(n)
    rows, truth = [], {}
    for i in range(n):
        truth[i] = int(draw.random() < 0.3)
        rows.append((i, change(prose(40), truth[i], draw)))
    return rows, truth


def labels(spark, truth, column):
    rows = [(i, y, "x") for i, y in truth.items()] + [(None, 1, None), (5, None, None), (999_999, 1, None)]
    return spark.createDataFrame(rows, f"doc_id long, {column} int, text string")


def test_toxicity(spark, documents, prose):
    def insult(text, y, draw):
        return f"{text} {draw.choice(['mugloth', 'mugloths', 'zerkish', 'zerkisher'])} {draw.choice(['women', 'muslims', ''])}" if y else text

    rows, truth = corpus(prose, 400, insult)
    rows += [(1000, None), (1001, ""), (None, "x"), (1, rows[1][1])]
    scores = X.toxicity_scores(documents(rows), labels(spark, truth, "toxic"))
    assert accuracy(scores, truth) > 0.95
    assert scores.count() == len(rows) and scores.filter("score is null or score < 0 or score > 1 or held_out is null").count() == 0
    assert X.toxicity_scores(documents([]), labels(spark, truth, "toxic")).count() == 0
    none = X.toxicity_scores(documents(rows[:3]), labels(spark, {}, "toxic").filter("false")).collect()
    assert all(r.score < 1e-6 for r in none)


def test_counterfactual_term_moves_identity_weights(spark, documents, prose):
    """In the labels, a group is named in toxic texts only; the term takes the weight of its name down."""
    rows, truth = corpus(prose, 300, lambda t, y, d: f"{t}. the muslims are here. {d.choice(['mugloth', 'zerkish'])}" if y else t)
    frame, marks = documents(rows), labels(spark, truth, "toxic")
    plain, _ = X.toxicity_model(frame, marks, penalty=0.0)
    fair, _ = X.toxicity_model(frame, marks, penalty=50.0)
    shift = lambda w: abs(sum(w.get(f, 0) for f in X.features_of("muslims")) - sum(w.get(f, 0) for f in X.features_of("women")))
    assert shift(fair) < 0.2 * shift(plain)
    assert accuracy(X.toxicity_scores(frame, marks), truth) > 0.95


def test_quality(spark, documents, prose):
    def junk(text, y, draw):
        if y:
            return text
        return draw.choice([text.upper().replace(" ", "!! "), text.replace(" ", "%%% "), " ".join([text.split()[0]] * 30)])

    rows, truth = corpus(prose, 400, junk)
    rows += [(1000, None), (1001, ""), (None, "x"), (1, rows[1][1])]
    scores = Q.quality_scores(documents(rows), labels(spark, truth, "quality"))
    assert accuracy(scores, truth) > 0.95
    assert scores.count() == len(rows) and scores.filter("score is null or score < 0 or score > 1 or held_out is null").count() == 0
    assert Q.quality_scores(documents([]), labels(spark, truth, "quality")).count() == 0


def test_dual_coordinate_descent_meets_its_conditions():
    """At the optimum: no loss inside the margin's free variables, complementary bounds elsewhere."""
    draw = np.random.default_rng(4)
    rows = [np.flatnonzero(draw.random(12) < 0.4) for _ in range(80)]
    y = np.where(draw.random(80) < 0.5, 1.0, -1.0)
    ratios = Q.log_count_ratios(rows, y, 12)
    w = Q.dual_coordinate_descent(rows, y, ratios, cost=0.5, rounds=2000)
    bound = np.where(y > 0, 0.5 / (2 * (y > 0).mean()), 0.5 / (2 * (y < 0).mean()))

    def primal(v):
        margins = np.array([(v[:-1] * ratios)[x].sum() + v[-1] for x in rows])
        return 0.5 * v @ v + (bound * np.maximum(0, 1 - y * margins)).sum()

    assert all(primal(w) <= primal(w + step * draw.normal(size=13)) + 1e-3 for step in (0.01, 0.1) for _ in range(50))


def test_ngrams():
    assert Q.shape_of("THE!!") == Q.shape_of("AND!!") == "A!"
    assert Q.shape_of("é") == "a"
    assert ("=",) in Q.ngrams("a a", Q.Shapes()) and Q.ngrams(None, Q.Shapes()) == set()
