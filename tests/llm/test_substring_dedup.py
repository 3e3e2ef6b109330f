import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from omnimart.llm import fm_index, substring_dedup


def plain(docs, least):
    """(id, words, removed, kept text) of (id, text) pairs, as it is defined."""
    words = [(t or "").encode().split() for _, t in docs]
    windows = Counter(tuple(w[i : i + least]) for w in words for i in range(len(w) - least + 1))
    out = []
    for (i, _), w in zip(docs, words):
        gone = {j for k in range(len(w) - least + 1) if windows[tuple(w[k : k + least])] > 1 for j in range(k, k + least)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), kept))
    return sorted(out, key=str)


def corpus(seed, n, vocabulary=400):
    """Texts with exact copies, near copies, passages that many share, and texts that repeat themselves."""
    draw = random.Random(seed)
    word = lambda: draw.choice("aàbBcd") + str(draw.randrange(vocabulary))
    shared = [[word() for _ in range(draw.randint(8, 30))] for _ in range(6)]
    texts = []
    for _ in range(n):
        kind, own = draw.randrange(7), [word() for _ in range(draw.randint(0, 60))]
        if kind == 1 and texts:
            own = list(draw.choice(texts))
        elif kind == 2 and texts:
            own = list(draw.choice(texts))
            for _ in range(draw.randint(1, 3)):
                if own:
                    own[draw.randrange(len(own))] = word()
        elif kind == 3:
            at = draw.randint(0, len(own))
            own[at:at] = draw.choice(shared)
        elif kind == 4:
            own = own[:9] * draw.randint(2, 5) + own[9:]
        elif kind == 5:
            own = [word()] * draw.randint(1, 40) + own[:5]
        texts.append(own)
    return list(enumerate(draw.choice([" ", "\n", " \t"]).join(t) for t in texts))


ODD = [(None, None), (None, ""), (8, "  \n "), (3, "same id other text " * 6), (9, "x" * 200_000), (10, " ".join(f"w{i % 977}" for i in range(20_000)))]


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 5, 6) for i, t in docs], "doc_id long, text string, n_words int, key int")


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.text)) for r in df.collect()), key=str)


@pytest.mark.parametrize("settings", [{}, {"shard_words": 50}, {"hot": 1}, {"hot": 3, "shard_words": 50}, {"run": 1}], ids=str)
@pytest.mark.parametrize("least", [6, 12])
def test_equals_the_plain_form(spark, least, settings):
    docs = corpus(least, 250) + ODD
    assert found(substring_dedup.remove_repeats(frame(spark, docs), least, **{"run": 3} | settings)) == plain(docs, least)


def test_production_parameters(spark):
    draw = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(55))
    docs = [(i, " ".join([" ".join(f"{draw.random()}" for _ in range(draw.randint(0, 50))), passage, f"end{i}"])) for i in range(40)]
    docs += [(100, passage.rsplit(" ", 21)[0]), (101, "a b " * 40), (102, "c " * 35), (103, "c " * 34)]
    got = substring_dedup.remove_repeats(frame(spark, docs))
    assert found(got) == plain(docs, 35)
    assert {r.doc_id: r.kept_sha256 for r in substring_dedup.digest(got).collect()} == {i: hashlib.sha256(kept).hexdigest() for i, _, _, kept in plain(docs, 35)}


def test_empty_table(spark):
    assert substring_dedup.remove_repeats(frame(spark, [])).collect() == []


def test_windows_that_the_index_cannot_hold_are_refused(spark):
    with pytest.raises(ValueError):
        substring_dedup.remove_repeats(frame(spark, []), 60)


@pytest.mark.parametrize("seed", range(5))
def test_index_against_all_windows(seed):
    draw = np.random.RandomState(seed)
    segments = [draw.randint(0, 4, draw.randint(1, 40)).astype(np.uint64) for _ in range(60)]
    weights = draw.randint(1, 3, len(segments))
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in segments])])
    index = fm_index.FMIndex(np.concatenate(segments), bounds, weights)
    for least in (4, 7, 13):
        count = Counter()
        for s, w in zip(segments, weights):
            for k in range(len(s) - least + 1):
                count[s[k : k + least].tobytes()] += int(w)
        expected = {(i, k) for i, s in enumerate(segments) for k in range(len(s) - least + 1) if count[s[k : k + least].tobytes()] > 1}
        assert {(s, k) for s, a, b in zip(*(x.tolist() for x in index.repeated(least))) for k in range(a, b - least + 1)} == expected


def test_backward_search_counts_occurrences():
    words = np.array([5, 6, 5, 6, 5, 7, 5, 6], dtype=np.uint64)
    index = fm_index.FMIndex(words, np.array([0, 6, 8]), np.array([1, 10]))
    low, high = np.array([0]), np.array([index.n])
    for symbol in (2, 1):  # the second, then the first of the words in order: 5, 6
        low, high = index.extend(low, high, np.array([symbol]))
    assert high[0] - low[0] == 3 and index.occurrences(low, high)[0] == 12
