import random

import pytest

from llm.conftest import word_shingles
from omnimart.llm import decontaminate

ITEMS = "item_id long, text string"


def expected(docs, items, percent=80):
    sets = {i: word_shingles(t) for i, t in docs}
    found = set()
    for j, text in items:
        own = word_shingles(text)
        found |= {(i, j, len(own), len(own & s)) for i, s in sets.items() if own and 100 * len(own & s) >= percent * len(own)}
    return found


def test_equals_exact_containment(spark, documents):
    draw = random.Random(3)
    words = [f"w{k}" for k in range(3000)]
    items = [(j, " ".join(draw.choices(words, k=draw.choice((2, 5, 6, 9, 17, 40, 70, 300))))) for j in range(60)]
    docs = []
    for i in range(120):
        parts = [" ".join(draw.choices(words, k=draw.randrange(1, 400)))]
        for _ in range(draw.choice((0, 1, 2))):
            own = draw.choice(items)[1].split()
            if draw.random() < 0.4:
                own[draw.randrange(len(own))] = "changed"
            parts.insert(draw.randrange(len(parts) + 1), " ".join(own).upper())
        docs.append((i, "\n".join(parts)))
    docs.append((500, items[0][1]))
    found = {tuple(r) for r in decontaminate.contained_items(documents(docs), spark.createDataFrame(items, ITEMS)).collect()}
    assert found == expected(docs, items)


def test_item_inside_a_very_long_document(spark, documents):
    item = " ".join(f"k{n}" for n in range(30))
    text = " ".join(f"z{n}" for n in range(100_000))
    found = decontaminate.contained_items(documents([(1, f"{text} {item} {text}"), (2, text)]), spark.createDataFrame([(7, item)], ITEMS)).collect()
    assert [tuple(r) for r in found] == [(1, 7, 26, 26)]


def test_many_blocks_of_items(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 2)
    items = [(j, f"item number {j} with a few more words") for j in range(9)]
    docs = [(i, f"before {items[i][1]} after") for i in range(9)]
    found = {tuple(r)[:2] for r in decontaminate.contained_items(documents(docs), spark.createDataFrame(items, ITEMS)).collect()}
    assert found == {(i, i) for i in range(9)}


def test_edge_rows(spark, documents):
    docs = documents([(1, None), (2, ""), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (4, "short one")])
    items = spark.createDataFrame([(1, None), (2, ""), (3, "A b c d e"), (3, "b c d e f"), (None, "a b c d e f"), (5, "Short  one")], ITEMS)
    found = sorted(tuple(r) for r in decontaminate.contained_items(docs, items).collect())
    assert found == [(3, 3, 2, 2), (3, 3, 2, 2), (4, 5, 1, 1)]
    kept = decontaminate.remove_contaminated(docs, items)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "None"] and kept.columns == docs.columns


def test_empty_tables_and_clashing_columns(spark, documents):
    items = spark.createDataFrame([(3, "a b c d e", 1)], ITEMS + ", doc_id long")
    assert decontaminate.contained_items(documents([]), items).count() == 0
    assert decontaminate.contained_items(documents([(1, "a b c d e")]), items.limit(0)).count() == 0
    rows = spark.createDataFrame([(1, "a b c d e", 4, 5)], "doc_id long, text string, item_id long, n_item long")
    assert [tuple(r) for r in decontaminate.contained_items(rows, items).collect()] == [(1, 3, 1, 1)]
    with pytest.raises(ValueError, match="item_id"):
        decontaminate.contained_items(rows, rows.select("text"))


def test_null_ids_go_by_their_text(spark, documents):
    docs = documents([(None, "a b c d e f"), (None, "a b c d e f"), (None, "other words that hold no item"), (None, None), (1, "a b c d e f"), (2, "clean text of other words")])
    items = spark.createDataFrame([(3, "A b c d e")], ITEMS)
    kept = decontaminate.remove_contaminated(docs, items, unnamed=True)
    assert kept.columns == docs.columns
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(map(str, [(None, "other words that hold no item"), (None, None), (2, "clean text of other words")]))
