import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from omnimart.llm import resampling

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    words = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return words, [b" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, longest, buckets, least=20, percent=10):
    own = [(i, *features(t, longest)) for i, t in docs]
    s, t = (Counter(zlib.crc32(f) % buckets for fs in sides for f in fs) for sides in ([f for _, _, f in own], [features(x, longest)[1] for x in target]))
    n, m = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for i, words, found in own:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * n / ((s[b] + 1) * m))) for b in (zlib.crc32(f) % buckets for f in found))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], math.inf if r[0] is None else r[0]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = rank
    return sorted(map(tuple, rows), key=str)


def texts(seed, n):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcé0") for _ in range(draw.randint(1, 3))) for _ in range(80)]
    return [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 60))).title().replace("B ", "b-") for _ in range(n)]


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, 2.0) for i, t in docs], "doc_id long, text string, rank int, score double")


@pytest.mark.parametrize("longest, head", [(1, 20_000), (1, 0), (2, 20_000), (2, 30), (2, 0), (3, 30)])
def test_equals_the_plain_form(spark, longest, head):
    docs = [*enumerate(texts(3, 200)), (None, None), (None, "x " * 30), (900, ""), (901, "word " * 40_000), (902, "w" * 100_000), (7, "again " * 25), (7, "again " * 25)]
    target = texts(4, 20)
    found = resampling.resample(frame(spark, docs), spark.createDataFrame([(t,) for t in [*target, None]], "text string"), longest, 97, head)
    assert sorted(map(tuple, found.collect()), key=str) == plain(docs, target, longest, 97)


def test_head_holds_the_most_frequent_words_and_pairs(spark):
    head = resampling.Head.learn(frame(spark, [(1, "a a a b b c"), (2, "a b")]).select("text"), 2, 2)
    assert head.states == {w: zlib.crc32(w) for w in (b"a", b"b")}
    assert head.pairs == {(b"a", b"a"): resampling.bucket_of(b"a a"), (b"a", b"b"): resampling.bucket_of(b"a b")}


def test_counts_handed_on_early_are_the_same(spark, monkeypatch):
    docs, target = [*enumerate(texts(8, 100))], texts(9, 5)
    monkeypatch.setattr(resampling, "HELD", 3)
    found = resampling.resample(frame(spark, docs), spark.createDataFrame([(t,) for t in target], "text string"), 2, 50, 5)
    assert sorted(map(tuple, found.collect()), key=str) == plain(docs, target, 2, 50)


def test_ties_and_empty_tables(spark):
    none, target = frame(spark, []), spark.createDataFrame([("a b",)], "text string")
    assert resampling.resample(none, target).collect() == []
    same = frame(spark, [(5, "a " * 20)] * 30)
    ranks = [r.rank for r in resampling.resample(same, target.limit(0)).collect()]
    assert sorted(r for r in ranks if r) == [1, 2, 3] and len(ranks) == 30
