import random

import corpus_pipeline
import __spark_entry__
from llm.conftest import word_shingles
from llm.test_line_dedup import expected as plain_lines
from omnimart.llm import queries


def write(spark, folder, docs, labels, items):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def corpus():
    draw, pairs, labels = random.Random(6), [], []
    words = [f"{a}{b}" for a in ("ri", "sto", "hou", "gar", "ev", "lit") for b in ("ver", "ne", "se", "den", "en", "tle", "mo")]
    for i in range(120):
        own = ["\n".join(" ".join(draw.choices(words, k=14)) for _ in range(4))]
        junk = i % 5 == 0
        text = " ".join(w + "$$$" for w in own[0].split()) if junk else own[0]
        pairs.append((i, text))
        labels.append((i, int(not junk), 0))
    good = [(i, t) for i, t in pairs if i % 5]
    pairs += [(200, good[0][1]), (201, good[1][1] + " more"), (202, "header\n" + good[2][1][:70] + "\nown last line of this text")]
    item = good[3][1].split("\n")[0]
    return pairs, labels, [(0, item), (1, "never seen anywhere at all in these texts")]


def test_stages_against_plain_versions(spark, documents, tmp_path):
    pairs, labels, items = corpus()
    folder = str(tmp_path / "sf")
    write(spark, folder, documents(pairs), labels, items)
    docs, texts = spark.read.parquet(f"{folder}/documents.parquet"), dict(pairs)
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = texts
        result = stage(spark, docs, folder)
        if k < 4:
            assert result.columns == docs.columns
            docs = spark.createDataFrame(result.collect(), docs.schema)
            texts = {r.doc_id: r.text for r in docs.collect()}
        kept[name] = texts
        if name == "quality":
            assert set(texts) == {i for i in before if not (i < 120 and i % 5 == 0)}
        elif name == "line_dedup":
            plain = plain_lines(sorted(before.items()))
            assert texts == {i: t for i, t in plain.items() if t.strip(" \t\r\n") or t == before[i]}
        elif name == "ngram_jaccard":
            sets = {i: word_shingles(t) for i, t in before.items()}
            gone = {b for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
            assert set(texts) == set(before) - gone
        elif name == "decontaminate":
            own = word_shingles(items[0][1])
            hit = {i for i, t in before.items() if 100 * len(own & word_shingles(t)) >= 80 * len(own)}
            assert hit and set(texts) == set(before) - hit
        else:
            rows = result.collect()
            assert {r.doc_id for r in rows} == set(before) and all(r.n_tokens == len(r.token_ids) > 0 for r in rows)
    assert 200 not in kept["line_dedup"]
    found = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, folder).collect()}
    assert found == {r.doc_id: r.n_tokens for r in rows}


def test_edge_rows_pass_all_stages(spark, documents, tmp_path):
    folder = str(tmp_path / "sf")
    edge = [(1, None), (2, ""), (3, "only one line"), (3, "only one line"), (None, "null id"), (4, "x " * 100_000)]
    write(spark, folder, documents(edge), [], [(1, None)])
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted(str(r.doc_id) for r in found) == ["1", "2", "3", "3", "4", "None"]


def test_empty_tables(spark, documents, tmp_path):
    folder = str(tmp_path / "sf")
    write(spark, folder, documents([]), [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_registered():
    names = set(__spark_entry__.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


def plain_short_lines(pairs):
    """Kept lines by all pairs of lines over runs of four characters; pairs in the order of documents."""
    import itertools

    from llm.conftest import Groups

    first = {}
    for i, text in pairs:
        for k, line in enumerate((text or "").split("\n")):
            if line.strip(" \t\r"):
                first.setdefault(line, (i, k))
    names = list(first)
    sets = [{x[j : j + 4] for j in range(max(1, len(x) - 3))} for x in names]
    groups = Groups(range(len(names)))
    for a, b in itertools.combinations(range(len(names)), 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            groups.join(a, b)
    leader, place = {}, {x: k for k, x in enumerate(names)}
    for k, x in enumerate(names):
        leader.setdefault(groups.root(k), first[x])
    return {
        i: None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if not x.strip(" \t\r") or leader[groups.root(place[x])] == (i, k))
        for i, text in pairs
    }


def test_line_stage_against_all_pairs_of_short_runs(spark, documents):
    draw = random.Random(31)
    base = ["".join(draw.choices("abcdefghijklm nop", k=draw.choice((20, 60, 90)))) for _ in range(25)]

    def line():
        own = list(draw.choice(base))
        for _ in range(draw.choice((0, 1, 1, 4))):
            own[draw.randrange(len(own))] = draw.choice("xyzé")
        return "".join(own)

    pairs = [(i, "\n".join([*(line() for _ in range(draw.randrange(4))), f"own line {i * i} of text {i ** 3}"])) for i in range(60)]
    found = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, documents(pairs), "").collect()}
    plain = plain_short_lines(pairs)
    assert found == {i: t for i, t in plain.items() if t.strip(" \t\r\n") or t == dict(pairs)[i]}


def test_columns_of_any_name_pass(spark, tmp_path):
    extra = "selected boolean, n_lines int, gone int, node int, others string, nameless int, copy int, `a b` int, expected_grade double, token_ids int, lang string, source string"
    rows = [(i, f"words of document {i * i} and {i ** 3} that no other has", True, 1, 2, 3, "o", 4, 5, 6, 0.5, 7, "en", "s") for i in range(6)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {extra}")
    folder = str(tmp_path / "sf")
    write(spark, folder, docs, [], [(1, "an item that is nowhere in these texts")])
    now = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, folder)
        assert now.columns == docs.columns
    assert sorted(map(tuple, now.collect())) == sorted(rows)
    assert corpus_pipeline.run(spark, folder).count() == 6


def test_copies_without_an_id_go(spark, documents, tmp_path):
    text = "a text that stands here several times, whoever sent it"
    other = " ".join(f"word{k}" for k in range(40))
    pairs = [(None, text), (None, text), (5, text), (None, other), (None, other + " more"), (None, None)]
    by_lines = [r.text for r in corpus_pipeline.drop_repeated_lines(spark, documents(pairs), "").collect()]
    assert sorted(map(str, by_lines)) == ["None", text, other]
    groups = corpus_pipeline.keep_one_of_each_group(spark, documents(pairs), "").collect()
    assert sorted((str(r.doc_id), str(r.text)[:6]) for r in groups) == [("5", "a text"), ("None", "None"), ("None", "word0 ")]


def test_rows_of_one_id_with_other_texts_stay_apart(spark, documents):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    pairs = [(1, a), (2, a + " more"), (2, b), (3, b + " more"), (2, "only here in the world of texts")]
    kept = corpus_pipeline.keep_one_of_each_group(spark, documents(pairs), "").collect()
    assert sorted((r.doc_id, r.text[:5]) for r in kept) == [(1, "a0 a1"), (2, "b0 b1"), (2, "only ")]
