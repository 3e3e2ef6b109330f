import math
import random
import re

import numpy as np
import pytest

from omnimart.llm import toxicity

LABELS = "doc_id long, label int"


def corpus(n, seed=1):
    draw, docs, labels = random.Random(seed), [], []
    calm = [f"word{chr(97 + k % 26)}{k}" for k in range(60)]
    for i in range(n):
        toxic = draw.random() < 0.3
        words = [draw.choice(calm) for _ in range(25)]
        if toxic:
            for _ in range(3):
                words[draw.randrange(25)] = draw.choice(("idiot", "scum!", "Moronic"))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def plain_terms(text):
    words = re.findall(r"[A-Za-z0-9]+", text or "")
    return [w.lower() for w in words] + ["stem:" + w.lower()[:5] for w in words if len(w) > 5]


def plain_hash(term):
    stem = term.startswith("stem:")
    data = np.frombuffer(term.removeprefix("stem:").encode(), np.uint8)
    h, _ = toxicity.textops.word_hashes(data, np.array([0, len(data)]), toxicity.textops.LETTER)
    return int((toxicity.textops.mix(h + np.uint64(1)) if stem else h)[0])


def test_held_out_accuracy(spark, documents):
    docs, labels = corpus(500)
    index = toxicity.learn(documents(docs), spark.createDataFrame(labels[:350], LABELS))
    truth = dict(labels)
    found = [r for r in toxicity.score(documents(docs), index).collect() if r.doc_id >= 350]
    assert sum((r.score >= 0.5) == truth[r.doc_id] for r in found) >= 0.97 * len(found)


def test_neighbours_and_scores_equal_a_plain_search(spark, documents):
    docs, labels = corpus(300, 4)
    index = toxicity.learn(documents(docs), spark.createDataFrame(labels[:200], LABELS))
    names = {int(h): k for k, h in enumerate(index.vocabulary)}
    df = {}
    for _, text in docs:
        for t in {plain_hash(t) for t in plain_terms(text)}:
            df[t] = df.get(t, 0) + 1
    idf = [math.log(1 + len(docs) / df[int(h)]) for h in index.vocabulary]
    assert index.idf == pytest.approx(idf)

    def vector(text):
        tf = {}
        for t in plain_terms(text):
            k = names.get(plain_hash(t))
            if k is not None:
                tf[k] = tf.get(k, 0) + 1
        v = {k: (1 + math.log(n)) * idf[k] for k, n in tf.items()}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {k: x / length for k, x in v.items()}

    texts = dict(docs)
    examples = [(int(i), int(y), float(w), vector(texts[int(i)])) for i, y, w in zip(index.ids, index.labels, index.weights)]
    for row in toxicity.score(documents(docs), index).collect():
        own = vector(texts[row.doc_id])
        near = sorted(((sum(x * v.get(k, 0) for k, x in own.items()), i, y, w) for i, y, w, v in examples), key=lambda e: (-round(e[0], 12), e[1]))
        near = [e for e in near if e[0] > 0][: toxicity.NEAREST]
        if near:
            w = [e[3] / (0.05 + max(0, 1 - e[0])) for e in near]
            vote = sum(a * e[2] for a, e in zip(w, near)) / sum(w)
            assert row.score == pytest.approx(index.score(vote), abs=1e-6)
            assert row.evidence == [e[1] for e in near[:3]]
        else:
            assert row.score == pytest.approx(index.score(index.empty)) and row.evidence == []


def test_bounds_of_the_sample(spark, documents):
    docs, labels = corpus(200)
    index = toxicity.learn(documents(docs), spark.createDataFrame(labels, LABELS), positives=20, negatives=30, vocabulary=5)
    assert sorted(np.bincount(index.labels)) == [20, 30] and len(index.vocabulary) <= 5
    assert index.weights.sum() == pytest.approx(200)


def test_edge_rows(spark, documents):
    docs, labels = corpus(120)
    edge = [(900, None), (901, ""), (902, "?!"), (None, "idiot"), (903, "idiot " * 200_000), (1, docs[1][1])]
    rows = spark.createDataFrame([*labels, (None, 1), (3, None), (7777, 1), (901, 0), (0, 1 - labels[0][1])], LABELS)
    index = toxicity.learn(documents(docs + edge), rows)
    found = toxicity.score(documents(docs + edge), index).collect()
    assert len(found) == len(docs) + len(edge) and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r.score for r in found}
    assert by_id[900] == by_id[901] == by_id[902] < 0.5 <= by_id[903]


def test_without_both_classes_and_empty_tables(spark, documents):
    docs = documents([(1, "a b"), (2, None)])
    for rows, score in (([], 0.0), ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0)):
        index = toxicity.learn(docs, spark.createDataFrame(rows, LABELS))
        assert {r.score for r in toxicity.score(docs, index).collect()} == {score}
    assert toxicity.score(documents([]), index).count() == 0


def test_only_text_counts(spark, documents):
    docs, labels = corpus(100)
    index = toxicity.learn(documents(docs), spark.createDataFrame(labels, LABELS))
    plain = {r.doc_id: r.score for r in toxicity.score(documents(docs), index).collect()}
    moved = spark.createDataFrame([(i + 5000, t, 1, 0.5) for i, t in docs], "doc_id long, text string, label int, score double")
    assert {r.doc_id - 5000: r.score for r in toxicity.score(moved, index).collect()} == plain


def test_every_term_counts(spark, documents):
    docs, labels = corpus(240, 3)
    # Words of two examples and of no example: the first find each other, the second only lengthen a vector.
    docs += [(500, "zebra quagga"), (501, "zebra quagga okapi"), (502, "okapi word unheard"), (503, "unheard unheard zebra")]
    labels += [(500, 0)]
    known = spark.createDataFrame(labels, LABELS)
    for associated in (False, True):
        index = toxicity.learn(documents(docs), known, associated=associated)
        assert {plain_hash(t) for _, text in docs[:240] for t in plain_terms(text)} <= {int(h) for h in index.vocabulary}
        found = {r.doc_id: r for r in toxicity.score(documents(docs), index).collect()}
        assert all(found[i].evidence for i, _ in docs[:240]) and found[501].evidence == found[503].evidence == [500] and found[502].evidence == []


def test_lengths_hold_terms_of_no_example(spark, documents):
    docs, labels = corpus(120, 5)
    docs += [(900, docs[0][1] + " unheard okapi okapi"), (901, "okapi")]
    index = toxicity.learn(documents(docs), spark.createDataFrame(labels, LABELS))
    rows = [r.square for r in toxicity._unseen(documents(docs), index, spark.sparkContext.broadcast(index)).orderBy("square").collect()]
    n = len(docs)
    okapi, once = math.log(1 + n / 2), math.log(1 + n)
    # "unheard" has a stem as well.
    assert rows == pytest.approx([okapi**2, 2 * once**2 + ((1 + math.log(2)) * okapi) ** 2], abs=1e-8)


def test_toxic_rows_are_found_in_long_texts(spark, documents):
    draw = random.Random(8)
    calm = [f"plain{k}" for k in range(400)]
    docs, labels = [], []
    for i in range(400):
        words = draw.choices(calm, k=80)
        labels.append((i, int(i % 8 == 0)))
        if i % 8 == 0:
            words[draw.randrange(80)] = "moronic"
        docs.append((i, " ".join(words)))
    index = toxicity.learn(documents(docs), spark.createDataFrame(labels[:300], LABELS), associated=True)
    truth = dict(labels)
    found = [r for r in toxicity.score(documents(docs), index).collect() if r.doc_id >= 300]
    assert sum((r.score >= 0.5) == truth[r.doc_id] for r in found) >= 0.97 * len(found)


def test_vocabulary_finds_what_is_there():
    draw = np.random.RandomState(3)
    ends = np.array([0, 1, 2**63, 2**64 - 1], np.uint64)
    for known in (np.zeros(0, np.uint64), ends[:1], ends, draw.randint(0, 40, 30).astype(np.uint64), draw.randint(0, 2**63 - 1, 5000).astype(np.uint64)):
        known = np.unique(known)
        asked = np.concatenate([known, known[::3] + np.uint64(1), ends])
        place, there = toxicity.Vocabulary(known).find(asked)
        assert (there == np.isin(asked, known)).all()
        assert (known[place[there]] == asked[there]).all()


def test_nearest_by_double_precision():
    """Cosines closer than single precision tells are ordered as double precision orders them."""
    n, k = 40, 5
    matrix = np.zeros((n, 2))
    matrix[:, 0] = 0.5 + 1e-10 * np.random.RandomState(4).permutation(n)
    matrix[:, 1] = 0.1
    none = np.zeros(0, np.int64)
    index = toxicity.ExampleIndex(np.arange(2, dtype=np.uint64), np.ones(2), np.ones(2), n, np.arange(n), np.zeros(n, np.int64), np.ones(n), np.zeros(3, np.int64), none, np.zeros(0), np.arange(2), matrix)
    (slots, cosines), = index.nearest(np.zeros(2, np.int64), np.arange(2), np.array([0.8, 0.6]), 1, k)
    whole = matrix @ np.array([0.8, 0.6])
    assert slots.tolist() == np.argsort(-whole)[:k].tolist()
    assert np.allclose(cosines, np.sort(whole)[::-1][:k], rtol=0, atol=1e-14)
    assert index._single.dtype == np.float32 and "_single" not in index.__getstate__()
