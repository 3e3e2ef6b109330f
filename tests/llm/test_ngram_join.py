import itertools
import random

import pytest

from llm.conftest import Groups, word_shingles
from omnimart.llm import linking, ngram_join, textops


def expected(pairs, percent=80):
    sets = {i: word_shingles(t) for i, t in pairs}
    groups = Groups(sets)
    for a, b in itertools.combinations(sorted(sets), 2):
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if either and 100 * both >= percent * either and both:
            groups.join(a, b)
    return {(i, len(sets[i]), groups.root(i)) for i in sets}


def corpus(seed, n):
    """Texts with copies, near copies, chains of edits, shared passages and repeated words."""
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passage = " ".join(draw.choices(words, k=60))
    base = [draw.choices(words, k=draw.choice((3, 5, 8, 30, 90))) for _ in range(n // 4)]
    texts = []
    for k in range(n):
        own = list(draw.choice(base))
        for _ in range(draw.choice((0, 0, 1, 2, 4))):
            own[draw.randrange(len(own))] = draw.choice(words)
        text = " ".join(own)
        if k % 7 == 0:
            text += "\n" + passage
        if k % 11 == 0:
            text = " ".join(["the"] * draw.randrange(4, 12) + ["of"] * draw.randrange(4, 12))
        texts.append(text.upper() if k % 13 == 0 else text)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(documents, seed):
    pairs = corpus(seed, 240)
    found = {tuple(r) for r in ngram_join.similarity_classes(documents(pairs)).collect()}
    assert found == expected(pairs)


def test_chain_of_edits_through_blocks(documents, monkeypatch):
    """A family with several components is compared in blocks, however small they are."""
    monkeypatch.setattr(linking, "BLOCK_NODES", 4)
    draw, base = random.Random(5), [f"v{k}" for k in range(80)]
    pairs = []
    for i in range(40):
        own = list(base)
        for _ in range(draw.choice((0, 1, 2, 3))):
            own[draw.randrange(80)] = f"x{draw.randrange(30)}"
        pairs.append((i, " ".join(own)))
    found = {tuple(r) for r in ngram_join.similarity_classes(documents(pairs)).collect()}
    assert found == expected(pairs)


@pytest.mark.parametrize("few", [1, 3, 1000])
def test_groups_of_few_and_many_families(documents, monkeypatch, few):
    """Short texts around one common passage, some of them alike, with either way of comparing a group."""
    monkeypatch.setattr(linking, "FEW", few)
    draw, passage = random.Random(8), " ".join(f"p{k}" for k in range(12))
    pairs = []
    for i in range(150):
        own = [f"u{draw.randrange(4000)}" for _ in range(draw.randrange(2, 12))]
        if i > 100:
            own = pairs[draw.randrange(100)][1].split()
            own = own[: len(own) - 12] if draw.random() < 0.5 else own + ["z"]
        pairs.append((i, " ".join(own) + " " + passage))
    found = {tuple(r) for r in ngram_join.similarity_classes(documents(pairs)).collect()}
    assert found == expected(pairs)


def test_edge_rows(spark, documents):
    long_text = " ".join(f"q{k}" for k in range(60_000))
    pairs = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one"), (7, long_text), (8, long_text + " end"), (-9, "one two")]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_classes(documents(pairs)).collect()}
    assert found == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, -9), 5: (1, -9), 6: (1, 6), 7: (59_996, 7), 8: (59_997, 7), -9: (1, -9)}


def test_repeated_rows_and_null_ids(documents):
    pairs = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "x y z")]
    found = sorted(tuple(r) for r in ngram_join.similarity_classes(documents(pairs)).collect())
    assert found == [(1, 2, 1), (1, 2, 1), (2, 1, 2)]


def test_empty_table_and_clashing_columns(spark, documents):
    assert ngram_join.similarity_classes(documents([])).count() == 0
    rows = spark.createDataFrame([(1, "a b", 9, 9, 9), (2, "a b", 9, 9, 9)], "doc_id long, text string, node long, bucket long, component_id long")
    assert {tuple(r) for r in ngram_join.similarity_classes(rows).collect()} == {(1, 1, 1), (2, 1, 1)}


def test_components_of_long_paths(spark):
    from omnimart.llm.frames import Pins

    order = list(range(200))
    random.Random(3).shuffle(order)
    edges = [(a, b) for a, b in zip(order, order[1:])] + [(1000 + k, 1001 + k) for k in range(50)] + [(5000, 5000)]
    found = dict(linking.components(spark.createDataFrame(edges, "a long, b long"), Pins(spark)).collect())
    assert found == {**{k: 0 for k in range(1, 200)}, **{1001 + k: 1000 for k in range(50)}}


def test_hashes_tell_rows_apart():
    import pyarrow as pa

    texts = ["a b", None, "", "b a", "a b"]
    sets = [h[b[k] : b[k + 1]].tolist() for _, end, h, b in textops.word_sets(pa.array(texts)) for k in range(end)]
    assert sets[0] == sets[4] and sets[0] != sets[3] and sets[1] == sets[2] == []


def test_repeated_ids_with_other_texts_keep_their_links(documents):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    pairs = [(5, a), (5, b), (5, "alone in its words here now"), (7, a), (8, b + " more"), (1, b + " more words")]
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.similarity_classes(documents(pairs)).collect())
    assert found == [(1, 28, 1), (5, 2, 5), (5, 26, 1), (5, 26, 5), (7, 26, 5), (8, 27, 1)]


def test_the_smallest_node_of_a_family_is_compared_as_well(spark):
    """Two copies that are unlike the hub they share, one of them the smallest node of all."""
    from omnimart.llm.frames import Pins

    pins = Pins(spark)
    texts = {1: "a b c d e f g h i j k l", 2: "hub " * 3 + "x y z w v u t s", 3: "a b c d e f g h i j k l"}
    rows = [(bucket, node, 1, 8, 0.0 if node == 2 else 0.5, True) for bucket, nodes in ((10, (1, 2)), (11, (2, 3))) for node in nodes]
    postings = pins.pin(spark.createDataFrame(rows, "bucket long, node long, need int, size int, own double, core boolean"), "p")
    held = pins.pin(spark.createDataFrame(list(texts.items()), "node long, text string"), "t")
    found = linking.link(postings, held, textops.word_sets, 80, pins)
    assert [tuple(r) for r in found.collect()] == [(3, 1)]
