"""Text quality by ordinal cumulative-link regression on graded ratings.

A text is described by relative frequencies of hashed byte triples, words and pairs of
neighbouring words. One weight vector is shared by all grades, and ordered thresholds split its score:
``P(grade <= k) = sigmoid(threshold_k - score)``. The expected grade ranks
documents; the tail probability of a grade and above selects them.

The model is fitted on at most ``sample`` rated rows, those with the smallest hash of their
id; every document is scored on its whole text. Ratings are whole numbers in
any steps. Null ratings and ratings without a document are left out; a document with several
ratings counts with each. Null and empty texts have no features and score by the thresholds
alone. A clash of column names with the three results is an error. With fewer than two grades there is nothing to learn: all documents then
get that grade (0 without ratings) and are selected. Extra columns pass through;
equal texts get equal scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from omnimart.llm import textops
from omnimart.llm.frames import fresh, map_batches

#: Documented bound of the rated rows that a model is fitted on.
SAMPLE = 6_000
BUCKETS = 1 << 16
SCALE = 30.0
#: Entries of the sample that a training step handles at a time.
PIECE = 500_000
_ODD = np.uint32(0x9E3779B1)


@dataclass
class OrdinalModel:
    grades: np.ndarray
    thresholds: np.ndarray
    weights: np.ndarray

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """Chance of each grade, shape (rows, grades)."""
        below = 1 / (1 + np.exp(np.clip(score[:, None] - self.thresholds[None, :], -500, 500)))
        edge = np.zeros((len(score), 1))
        return np.diff(np.hstack([edge, below, edge + 1]), axis=1)


def features(raw: np.ndarray, bounds: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], ...]:
    """For byte triples, words and word pairs: feature of each occurrence, its row, and occurrences by row."""
    n = len(bounds) - 1
    if len(raw) > 2:
        wide = raw.astype(np.uint32)
        triple = (((wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)) * _ODD) >> np.uint32(16)).astype(np.int64)
        row = np.repeat(np.arange(n, dtype=np.int32), np.diff(bounds))
        whole = row[2:] == row[:-2]
        triples = triple[whole], row[:-2][whole]
    else:
        triples = np.zeros(0, np.int64), np.zeros(0, np.int32)
    h, row = textops.word_hashes(raw, bounds)
    words = (h >> np.uint64(48)).astype(np.int64) + BUCKETS, row
    # The hash of a pair is the difference of its words, so all repeated words share one feature.
    beside = row[1:] == row[:-1]
    pairs = ((h[1:] ^ h[:-1])[beside] >> np.uint64(48)).astype(np.int64) + 2 * BUCKETS, row[1:][beside]
    return tuple((f, r, np.bincount(r, minlength=n)) for f, r in (triples, words, pairs))


def fit(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE, rounds: int = 120, penalty: float = 1e-3) -> OrdinalModel:
    """Model from ``ratings`` (doc_id, grade) of ``docs`` (doc_id, text)."""
    rated = (
        fresh(ratings, "doc_id", "grade").where("doc_id is not null and grade is not null").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample)
    )

    def run(batches):
        for batch in batches:
            for at, end, raw, bounds in textops.pieces(batch["text"]):
                cells, parts = [], []
                for feature, row, count in features(raw, bounds):
                    cell, n = np.unique(row.astype(np.int64) << 20 | feature, return_counts=True)
                    cells.append(cell)
                    parts.append(n / np.maximum(count, 1)[cell >> 20])
                cell, part = np.concatenate(cells), np.concatenate(parts)
                order = np.argsort(cell, kind="stable")
                cut = np.searchsorted(cell[order] >> 20, np.arange(end - at + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][at:end], batch["grade"][at:end], textops.lists((cell[order] & ((1 << 20) - 1)).astype(np.int32), cut), textops.lists(part[order].astype(np.float32), cut)],
                    ["doc_id", "grade", "feature", "part"],
                )

    def train(rows: pa.Table) -> pa.Table:
        model = _fit_rows(*_arrays(rows), rounds, penalty)
        used = np.flatnonzero(model.weights)
        kinds = np.repeat([0, 1, 2], [len(model.grades), len(model.thresholds), len(used)])
        keys = np.concatenate([np.arange(len(model.grades)), np.arange(len(model.thresholds)), used])
        return pa.table({"kind": kinds, "key": keys, "value": np.concatenate([model.grades, model.thresholds, model.weights[used]])})

    chosen = fresh(docs, "doc_id", "text").join(F.broadcast(rated.select("doc_id", F.col("grade").cast("int").alias("grade"))), "doc_id")
    described = map_batches(chosen, run, "doc_id long, grade int, feature array<int>, part array<float>")
    # The bounded sample is one group; only the fitted numbers reach the driver.
    found = described.withColumn("sample", F.lit("all")).groupBy("sample").applyInArrow(train, "kind long, key long, value double").toArrow()
    if not found.num_rows:
        return OrdinalModel(np.zeros(1, np.int64), np.zeros(0), np.zeros(3 * BUCKETS))
    # Few numbers, sorted here: a sort in the cluster would sample its input and so fit a second time.
    order = np.lexsort((found["key"].to_numpy(), found["kind"].to_numpy()))
    kind, key, value = (found[c].to_numpy()[order] for c in ("kind", "key", "value"))
    weights = np.zeros(3 * BUCKETS)
    weights[key[kind == 2]] = value[kind == 2]
    return OrdinalModel(value[kind == 0].astype(np.int64), value[kind == 1], weights)


def _arrays(rows: pa.Table):
    """Grade of each row, features, values, and bounds of each row's features.

    Rows get a fixed order, so that a model does not depend on the order of tasks.
    """
    order = np.lexsort((pc.list_value_length(rows["feature"]).to_numpy(), rows["grade"].to_numpy(), rows["doc_id"].to_numpy()))
    rows = rows.take(pa.array(order))
    features = rows["feature"].combine_chunks()
    bounds = np.concatenate([[0], np.cumsum(features.value_lengths().to_numpy().astype(np.int64))])
    return rows["grade"].to_numpy(), features.flatten().to_numpy(), rows["part"].combine_chunks().flatten().to_numpy(), bounds


def _fit_rows(grade, index, value, bounds, rounds, penalty) -> OrdinalModel:
    grades, level = np.unique(grade, return_inverse=True)
    if len(grades) < 2:
        return OrdinalModel(grades if len(grades) else np.zeros(1, np.int64), np.zeros(0), np.zeros(3 * BUCKETS))
    n, cuts = len(level), len(grades) - 1
    # Narrow types and pieces of rows: there is an entry for each feature of each row.
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(bounds))
    ends = np.unique(np.concatenate([[0], np.searchsorted(bounds, np.arange(0, bounds[-1], PIECE)), [n]]))
    pieces = [(int(i), int(j), slice(int(bounds[i]), int(bounds[j]))) for i, j in zip(ends[:-1], ends[1:])]
    used = np.flatnonzero(np.bincount(index, minlength=3 * BUCKETS))
    at = np.zeros(3 * BUCKETS, dtype=np.int32)
    at[used] = np.arange(len(used))
    place = at[index]
    x = value * np.float32(SCALE)
    # Each feature is measured in units of its root mean square over the sample.
    unit = np.sqrt(sum(np.bincount(place[s], x[s] * x[s], minlength=len(used)) for _, _, s in pieces) / n) + 0.5
    x *= (0.3 / unit).astype(np.float32)[place]
    share = np.cumsum(np.bincount(level))[:-1] / n
    first = np.log(share / (1 - share))
    # theta_0, then logarithms of the steps between thresholds, keep the thresholds in order.
    theta = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-3))])
    w = np.zeros(len(used))
    state = [np.zeros(len(w) + cuts), np.zeros(len(w) + cuts)]
    for step in range(1, rounds + 1):
        edges = np.concatenate([theta[:1], theta[:1] + np.cumsum(np.exp(theta[1:]))])
        narrow = w.astype(np.float32)
        score = np.concatenate([np.bincount(row[s] - i, x[s] * narrow[place[s]], minlength=j - i) for i, j, s in pieces])
        upper = np.concatenate([edges, [np.inf]])[level]
        lower = np.concatenate([[-np.inf], edges])[level]
        cu, cl = _sigmoid(upper - score), _sigmoid(lower - score)
        p = np.maximum(cu - cl, 1e-9)
        du, dl = cu * (1 - cu), cl * (1 - cl)
        by_score = (du - dl) / p / n
        slope_w, narrow = penalty * w, by_score.astype(np.float32)
        for _, _, s in pieces:
            slope_w += np.bincount(place[s], x[s] * narrow[row[s]], minlength=len(w))
        by_edge = np.zeros(cuts)
        has_upper, has_lower = level < cuts, level > 0
        np.add.at(by_edge, level[has_upper], -(du / p)[has_upper] / n)
        np.add.at(by_edge, level[has_lower] - 1, (dl / p)[has_lower] / n)
        tail = np.cumsum(by_edge[::-1])[::-1]
        slope_theta = np.concatenate([tail[:1], tail[1:] * np.exp(theta[1:])])
        slope = np.concatenate([slope_w, slope_theta])
        state[0] = 0.9 * state[0] + 0.1 * slope
        state[1] = 0.99 * state[1] + 0.01 * slope * slope
        move = 0.1 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-9)
        w -= move[: len(w)]
        theta -= move[len(w) :]
    weights = np.zeros(3 * BUCKETS)
    weights[used] = w * SCALE / unit * 0.3
    return OrdinalModel(grades, np.concatenate([theta[:1], theta[:1] + np.cumsum(np.exp(theta[1:]))]), weights)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(-z, -500, 500)))


def score(docs: DataFrame, model: OrdinalModel, tail: int, least: float = 0.5) -> DataFrame:
    """``docs`` with expected_grade, tail_probability of grade ``tail`` and above, and selected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        above = model.grades >= tail
        for batch in batches:
            expected, tails = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for at, end, raw, bounds in textops.pieces(batch["text"]):
                total = np.zeros(end - at)
                for feature, row, count in features(raw, bounds):
                    total += np.bincount(row, model.weights[feature], minlength=end - at) / np.maximum(count, 1)
                p = model.probabilities(total)
                expected[at:end] = p @ model.grades
                tails[at:end] = p[:, above].sum(axis=1) if len(model.thresholds) else 1.0
            columns = [*batch.columns, pa.array(expected), pa.array(tails), pa.array(tails >= least)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "expected_grade", "tail_probability", "selected"])

    clash = {"expected_grade", "tail_probability", "selected"} & set(docs.columns)
    if clash:
        raise ValueError(f"the input has a column {min(clash)}")
    found = T.StructType([*docs.schema.fields, T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_probability", T.DoubleType()), T.StructField("selected", T.BooleanType())])
    return map_batches(docs, run, found)


def quality_grades(labels: DataFrame) -> DataFrame:
    """Ratings (doc_id, grade) from the label table: 0 of low quality, 1 usable but marked toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") > 0, F.when(F.col("toxic") > 0, 1).otherwise(2))
    return labels.select("doc_id", grade.alias("grade"))
