import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from omnimart.llm import quality

WORDS = ["river", "stone", "house", "green", "garden", "light", "evening", "little", "under", "bridge"]


def rated(n, seed=1):
    """Texts of three grades: junk, mixed and prose."""
    draw, docs, grades = random.Random(seed), [], []
    for i in range(n):
        grade = draw.randrange(3)
        words = [draw.choice(WORDS) for _ in range(40)]
        for k in range((0, 12, 30)[2 - grade]):
            words[k] = draw.choice(WORDS) + draw.choice(("$$$", "***", "!!!"))
        docs.append((i, " ".join(words)))
        grades.append((i, grade))
    return docs, grades


def test_held_out_accuracy_and_order(spark, documents):
    docs, grades = rated(600)
    truth = dict(grades)
    model = quality.fit(documents(docs), spark.createDataFrame(grades[:400], "doc_id long, grade int"))
    assert np.all(np.diff(model.thresholds) > 0)
    found = quality.score(documents(docs), model, tail=1).where("doc_id >= 400").collect()
    right = sum(round(r.expected_grade) == truth[r.doc_id] for r in found)
    assert right >= 0.9 * len(found)
    assert sum(r.selected == (truth[r.doc_id] >= 1) for r in found) >= 0.95 * len(found)


def test_scores_follow_the_formula(spark, documents):
    docs, grades = rated(60)
    model = quality.fit(documents(docs), spark.createDataFrame(grades, "doc_id long, grade int"))
    text = docs[0][1]
    data = text.encode()
    parts = []
    for feature, row, count in quality.features(np.frombuffer(data, np.uint8), np.array([0, len(data)])):
        assert count[0] == len(feature)
        parts.append(model.weights[feature].mean())
    tail = 1 / (1 + np.exp(model.thresholds[0] - sum(parts)))
    row = quality.score(documents(docs[:1]), model, tail=1).first()
    assert row.tail_probability == pytest.approx(tail, abs=1e-9)


def test_same_model_whatever_the_partitions(spark, documents):
    docs, grades = rated(80)
    ratings = spark.createDataFrame(grades, "doc_id long, grade int")
    one, other = (quality.fit(d, ratings) for d in (documents(docs).repartition(1), documents(docs[::-1]).repartition(5)))
    assert np.array_equal(one.weights, other.weights) and np.array_equal(one.thresholds, other.thresholds)


def test_sample_bound(spark, documents):
    docs, grades = rated(50)
    ratings = spark.createDataFrame(grades, "doc_id long, grade int")
    few = quality.fit(documents(docs), ratings, sample=10)
    chosen = [r.doc_id for r in ratings.orderBy(F.xxhash64("doc_id")).limit(10).collect()]
    same = quality.fit(documents(docs), ratings.where(F.col("doc_id").isin(chosen)))
    assert np.array_equal(few.weights, same.weights)


def test_edge_rows(spark, documents):
    docs, grades = rated(40)
    edge = [(100, None), (101, ""), (102, "  "), (None, "river stone"), (103, "x" * 3_000_000), (1, docs[1][1])]
    ratings = spark.createDataFrame([*grades, (None, 1), (5, None), (900, 2), (0, 2 - grades[0][1])], "doc_id long, grade int")
    model = quality.fit(documents(docs + edge), ratings)
    found = quality.score(documents(docs + edge), model, tail=1).collect()
    assert len(found) == len(docs) + len(edge) and all(0 <= r.tail_probability <= 1 for r in found)
    assert len({r.tail_probability for r in found if r.doc_id in (100, 101)}) == 1
    assert len({r.tail_probability for r in found if r.doc_id == 1}) == 1


def test_without_grades_and_empty_tables(spark, documents):
    docs = documents([(1, "a b"), (2, None)])
    for rows, grade in (([], 0.0), ([(1, 4)], 4.0)):
        model = quality.fit(docs, spark.createDataFrame(rows, "doc_id long, grade int"))
        found = quality.score(docs, model, tail=1).collect()
        assert {(r.expected_grade, r.selected) for r in found} == {(grade, True)}
    assert quality.score(documents([]), model, tail=1).count() == 0
    with pytest.raises(ValueError):
        quality.score(docs.withColumn("selected", F.lit(1)), model, tail=1)


def test_extra_columns_pass_through(spark):
    rows = spark.createDataFrame([(1, "river stone", 5, [1, 2])], "doc_id long, text string, grade int, feature array<int>")
    model = quality.OrdinalModel(np.array([0, 1]), np.array([0.5]), np.zeros(3 * quality.BUCKETS))
    found = quality.score(rows, model, tail=1).first()
    assert found.grade == 5 and found.feature == [1, 2] and found.tail_probability == pytest.approx(1 / (1 + np.exp(0.5)))


def test_fit_reaches_the_loss_of_a_plain_optimiser():
    """Penalised likelihood of the fitted numbers against gradient descent with numeric slopes on the same loss."""
    draw = np.random.RandomState(5)
    n, f, penalty = 240, 8, 1e-2
    value = draw.rand(n, f).astype(np.float32) / 10
    latent = (value - value.mean(axis=0)) @ draw.randn(f) * 60 + draw.logistic(size=n)
    grade = np.digitize(latent, [-1.0, 1.5])
    model = quality._fit_rows(grade, np.tile(np.arange(f), n).astype(np.int32), value.ravel(), np.arange(n + 1) * f, 1500, penalty)
    unit = np.sqrt(((value.astype(float) * quality.SCALE) ** 2).sum(axis=0) / n) + 0.5
    scale = quality.SCALE * 0.3 / unit

    def loss(p):
        w, edges = p[:f], np.concatenate([p[f : f + 1], p[f : f + 1] + np.cumsum(np.exp(p[f + 1 :]))])
        score = value @ (w * scale)
        cdf = 1 / (1 + np.exp(-np.clip(np.concatenate([[-60.0], edges, [60.0]])[None, :] - score[:, None], -60, 60)))
        return -np.log(np.maximum(cdf[np.arange(n), grade + 1] - cdf[np.arange(n), grade], 1e-9)).mean() + penalty / 2 * (w @ w)

    found = np.concatenate([model.weights[:f] / scale, model.thresholds[:1], np.log(np.diff(model.thresholds))])
    p, rate = np.concatenate([np.zeros(f), [-1.0, 0.5]]), 1.0
    for _ in range(1500):
        slope = np.array([(loss(p + h) - loss(p - h)) / 2e-5 for h in np.eye(len(p)) * 1e-5])
        while loss(p - rate * slope) > loss(p) and rate > 1e-9:
            rate /= 2
        p, rate = p - rate * slope, rate * 1.5
    assert loss(found) <= loss(p) + 2e-3
    assert np.corrcoef(value @ (found[:f] * scale), value @ (p[:f] * scale))[0, 1] > 0.999


def test_the_sample_is_fitted_once(spark, documents, monkeypatch):
    """No step samples the result of the fit, which would run it again."""
    docs = [(i, ("good calm words " if i % 2 else "$$$ ### !!! ") * 5 + str(i)) for i in range(60)]
    fits = spark.sparkContext.accumulator(0)
    inner = quality._fit_rows

    def counted(*settings):
        fits.add(1)
        return inner(*settings)

    monkeypatch.setattr(quality, "_fit_rows", counted)
    quality.fit(documents(docs), spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, grade int"), rounds=5)
    assert fits.value == 1
