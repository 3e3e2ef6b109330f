import itertools
import random
from functools import partial

import numpy as np
import pytest

from llm.conftest import Groups
from omnimart.llm import line_dedup, linking, textops
from omnimart.llm.frames import Pins


def shingles(line):
    return {line[i : i + 10] for i in range(max(1, len(line) - 9))}


def expected(pairs, percent=80):
    first = {}
    for i, text in sorted((p for p in pairs if p[0] is not None), key=lambda p: p[0]):
        for k, line in enumerate((text or "").split("\n")):
            if line.strip(" \t\r"):
                first.setdefault(line, (i, k))
    groups, sets = Groups(range(len(first))), [shingles(x) for x in first]
    for a, b in itertools.combinations(range(len(sets)), 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * len(sets[a] | sets[b]):
            groups.join(a, b)
    names = list(first)
    kept = {}
    for k, line in enumerate(names):
        r = groups.root(k)
        kept[r] = min(kept.get(r, first[line]), first[line])
    place = {line: k for k, line in enumerate(names)}
    return {
        i: None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if not x.strip(" \t\r") or kept[groups.root(place[x])] == (i, k))
        for i, text in pairs
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(documents, seed):
    draw = random.Random(seed)
    base = ["".join(draw.choices("abcdefg hij", k=draw.choice((4, 12, 60, 150)))) for _ in range(30)]

    def line():
        own = list(draw.choice(base))
        for _ in range(draw.choice((0, 0, 1, 3))):
            own[draw.randrange(len(own))] = draw.choice("xyzé漢")
        return "".join(own)

    pairs = [(i, "\n".join(line() if draw.random() > 0.1 else "" for _ in range(draw.randrange(6)))) for i in range(60)]
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(pairs)).collect()}
    assert found == expected(pairs)


def test_edge_rows(documents):
    long_line = "".join(random.Random(1).choices("abcdef ", k=200_000))
    pairs = [(1, None), (2, ""), (3, "\n\n"), (4, "same line here\nsame line here"), (5, "same line here"), (6, long_line), (7, long_line[:-3]), (None, "same line here"), (8, " \t")]
    found = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(documents(pairs)).collect()}
    assert found == {
        1: (None, 0, 0), 2: ("", 1, 0), 3: ("\n\n", 3, 0), 4: ("same line here", 2, 1), 5: ("", 1, 1),
        6: (long_line, 1, 0), 7: ("", 1, 1), None: ("same line here", 1, 0), 8: (" \t", 1, 0),
    }


def test_hot_line_and_near_copies(documents):
    pairs = [(i, f"A very common header line of all\nunique words of document number {i * 7919} and {i * 104729}") for i in range(300)]
    found = line_dedup.dedup_lines(documents(pairs)).collect()
    assert sum(r.text.startswith("A very") for r in found) == 1


def test_empty_table_and_extra_columns(spark, documents):
    assert line_dedup.dedup_lines(documents([])).count() == 0
    rows = spark.createDataFrame([(1, "a line that is here", 5, 6, 7), (2, "a line that is here", 8, 9, 0)], "doc_id long, text string, gone int, node int, line int")
    found = {tuple(r) for r in line_dedup.dedup_lines(rows).collect()}
    assert found == {(1, "a line that is here", 5, 6, 7, 1, 0), (2, "", 8, 9, 0, 1, 1)}
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(rows.withColumnRenamed("gone", "n_lines"))


def test_repeated_ids_keep_the_same_line(documents):
    found = [r.text for r in line_dedup.dedup_lines(documents([(1, "one line of text"), (1, "one line of text")])).collect()]
    assert found == ["one line of text"] * 2


def test_one_changed_character_in_short_lines(documents):
    draw = random.Random(9)
    lines = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz ", k=40 + k)) for k in range(61)]
    changed = [x[: (at := draw.randrange(len(x)))] + "#" + x[at + 1 :] for x in lines]
    pairs = [(1, "\n".join(lines)), (2, "\n".join(changed)), (3, "Page 12 of 90\nabc\nabd")]
    found = {r.doc_id: r for r in line_dedup.dedup_lines(documents(pairs), chars=line_dedup.SHORT_CHARS).collect()}
    assert found[1].n_removed == 0 and found[3].n_removed == 0
    # A pair at the bound of 0.8 is met with a chance of 99.5 %.
    assert found[2].n_removed >= 60


def test_short_runs_equal_all_pairs(documents):
    draw = random.Random(4)
    base = ["".join(draw.choices("abcdefg hij", k=draw.choice((3, 12, 60, 150)))) for _ in range(20)]
    lines = []
    for _ in range(150):
        own = list(draw.choice(base))
        own[draw.randrange(len(own))] = draw.choice("xyzé漢")
        lines.append("".join(own))
    first, kept = {}, {}
    for k, x in enumerate(lines):
        first.setdefault(x, k)
    names = list(first)
    sets, groups = [{x[i : i + 4] for i in range(max(1, len(x) - 3))} for x in names], Groups(range(len(names)))
    for a, b in itertools.combinations(range(len(names)), 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            groups.join(a, b)
    for k, x in enumerate(names):
        kept.setdefault(groups.root(k), x)
    found = line_dedup.dedup_lines(documents([(1, "\n".join(lines))]), chars=line_dedup.SHORT_CHARS).collect()
    assert found[0].text.split("\n") == sorted(kept.values(), key=first.get)


def test_pipeline_drops_short_near_copies(spark, documents):
    import corpus_pipeline

    line = "The annual report was printed on 12 May, page 7"
    found = corpus_pipeline.drop_repeated_lines(spark, documents([(1, line), (2, line.replace("page 7", "page 8") + "\nother text")]), "")
    assert {r.doc_id: r.text for r in found.collect()} == {1: line, 2: "other text"}


def test_lines_carry_the_size_of_their_set(documents):
    lines = ["", "short", "a line of some length", "abababababababababababab", "x" * 300, "a line of some length"]
    for chars in (line_dedup.CHARS, line_dedup.SHORT_CHARS):
        found = {r.line: r["size"] for r in line_dedup.line_rows(documents([(1, "\n".join(lines))]), chars).collect()}
        assert found == {k: len({x[i : i + chars] for i in range(max(1, len(x) - chars + 1))}) for k, x in enumerate(lines) if x}


def test_near_copies_are_linked_by_fewer_links_than_lines(documents, monkeypatch):
    """A crowd of near copies is joined by a spanning forest, not by a link for each pair of them."""
    from omnimart.llm import linking

    draw, counts, inner = random.Random(12), [], linking.verify_blocks

    def counted(*settings):
        found = inner(*settings)
        counts.append(found.count())
        return found

    monkeypatch.setattr(linking, "verify_blocks", counted)
    base = "".join(draw.choices("abcdefghijklmnop ", k=260))
    lines = []
    for _ in range(300):
        own = list(base)
        own[draw.randrange(len(own))] = "#"
        own[draw.randrange(len(own))] = "%"
        lines.append("".join(own))
    found = line_dedup.dedup_lines(documents(list(enumerate(lines)))).collect()
    assert sum(r.n_removed for r in found) >= 290
    assert sum(counts) < 300


def test_repeated_ids_with_other_texts_lose_no_other_lines(documents):
    pairs = [(1, "a line that is here twice"), (2, "a line that is here twice\nsecond line of two"), (2, "first of its own words\nnothing like it before"), (2, "a line that is here twice")]
    found = {(r.doc_id, r.n_lines, r.text) for r in line_dedup.dedup_lines(documents(pairs)).collect()}
    assert found == {(1, 1, "a line that is here twice"), (2, 2, "second line of two"), (2, 2, "first of its own words\nnothing like it before"), (2, 1, "")}


def test_marks_pass_all_links():
    draw = np.random.RandomState(5)
    for n in (1, 5, 40, 90, 300, 2000):
        for _ in range(20):
            pool = np.unique(draw.randint(1, 2**62, n).astype(np.uint64) * np.uint64(3))
            cut = draw.randint(0, max(1, n // 8) + 1)
            a, b = pool[cut:], pool[: len(pool) - draw.randint(0, max(1, n // 8) + 1)]
            sets = [x for x in (a, b) if len(x)]
            if len(sets) < 2:
                continue
            signs = linking.marks(np.concatenate(sets), np.cumsum([0, len(a), len(b)]))
            if textops.jaccard_at_least(a, b, 80):
                assert linking._may(np.array([len(a)]), np.array([len(b)]), signs[:1], signs[1:], 80).all()


def test_unlike_candidates_are_not_read(spark, monkeypatch):
    """Lines of one bucket that share few shingles are left by their marks, and make no family to compare in blocks."""
    lines = [f"{chr(97 + k) * 20} an entirely different line number {k * 7919} {chr(98 + k) * 30}" for k in range(12)]
    lines += [lines[0] + "." + "x" * 2, lines[3] + ",y"]
    texts = spark.createDataFrame([(k, t) for k, t in enumerate(lines)], "node long, text string")
    pins = Pins(spark)
    sized = pins.pin(line_dedup.sized_lines(texts, 4), "test-lines")
    postings = sized.selectExpr("1L as bucket", "node", "size", "marks", "1 as need", "0 as own", "true as core")
    compared = []
    verify = linking.verify_pairs

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verify(pairs, *rest)

    def blocks(*_):
        raise AssertionError("compared in blocks")

    monkeypatch.setattr(linking, "verify_pairs", counted)
    monkeypatch.setattr(linking, "verify_blocks", blocks)
    roots = linking.link(pins.pin(postings, "test-postings"), sized, partial(line_dedup.line_sets, chars=4), 80, pins)
    assert {(r.node, r.root) for r in roots.collect()} == {(12, 0), (13, 3)}
    assert sum(compared) <= 4


@pytest.mark.parametrize("few", [3, 6, 4096])
def test_groups_of_all_sizes_lose_no_link(spark, monkeypatch, few):
    """Groups compared as pairs, by marks first, or in blocks: the hub, the node of the smallest hash, is unlike all others."""
    monkeypatch.setattr(linking, "FEW", few)
    lines = ["z" * 10 + "y" * 10 + "0123456789" * 4] + [f"{chr(98 + k // 2) * 3}{'abcdefghij'[k // 2:]}{'klmnopqrstuvwxyz' * 3}{chr(65 + k // 2) * (20 + k % 2)}" for k in range(10)]
    pins = Pins(spark)
    texts = spark.createDataFrame([(k, t) for k, t in enumerate(lines)], "node long, text string")
    sized = pins.pin(line_dedup.sized_lines(texts, 4), "test-lines")
    postings = pins.pin(sized.selectExpr("1L as bucket", "node", "size", "marks", "1 as need", "0 as own", "true as core"), "test-postings")
    sets = {k: {t[i : i + 4] for i in range(len(t) - 3)} for k, t in enumerate(lines)}
    groups = Groups(sets)
    for a, b in itertools.combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            groups.join(a, b)
    roots = linking.link(postings, sized, partial(line_dedup.line_sets, chars=4), 80, pins)
    assert {r.node: r.root for r in roots.collect()} == {n: groups.root(n) for n in sets if groups.root(n) != n}


def test_chains_of_unlike_lines_are_not_compared_as_a_whole(spark, monkeypatch):
    """Long lines near their hub, by coarse marks, but not alike: compared by bucket and fine marks, and only the texts of the alike pair are read."""
    draw = random.Random(3)
    base = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz ", k=1500))
    lines = [base]
    for _ in range(linking.FAMILY_NODES + 6):
        at = draw.randrange(1100)
        lines.append(base[:at] + "".join(draw.choices("abcdefghijklmnopqrstuvwxyz ", k=300)) + base[at + 300 :])
    lines.append(lines[5] + "...")
    pins = Pins(spark)
    sized = pins.pin(line_dedup.sized_lines(spark.createDataFrame(list(enumerate(lines)), "node long, text string"), 4), "test-lines")
    postings = pins.pin(sized.selectExpr("1L as bucket", "node", "size", "marks", "1 as need", "0 as own", "true as core"), "test-postings")

    def blocks(*_):
        raise AssertionError("compared in blocks")

    read, pin = [], Pins.pin

    def counted(self, df, name):
        found = pin(self, df, name)
        if name == "near-pairs":
            read.append(found.count())
        return found

    monkeypatch.setattr(linking, "verify_blocks", blocks)
    monkeypatch.setattr(Pins, "pin", counted)
    roots = linking.link(postings, sized, partial(line_dedup.line_sets, chars=4), 80, pins)
    assert {(r.node, r.root) for r in roots.collect()} == {(len(lines) - 1, 5)}
    assert 1 <= sum(read) <= 20


def test_leading_hashes_make_the_same_sets():
    draw = np.random.RandomState(2)
    h, row = draw.randint(0, 2**62, 500).astype(np.uint64)[draw.randint(0, 500, 4000)] * np.uint64(5), draw.randint(0, 300, 4000)
    whole, rows = textops.distinct(h, row)
    leading, same = textops.distinct_leading(h, row)
    assert (rows == same).all() and (whole & line_dedup.LEADING == leading).all()


def test_wanted_lines_of_a_text(spark):
    docs = spark.createDataFrame([([7, 8, 9], [2, 0, 5], "a\nb\n"), ([4], [1], "c\nd"), ([3], [0], None)], "nodes array<long>, numbers array<int>, text string")
    assert {tuple(r) for r in line_dedup.wanted_lines(docs).collect()} == {(7, ""), (8, "a"), (4, "d")}


def test_pairs_that_finer_marks_tell_apart_are_not_written(spark, monkeypatch):
    """Pairs of a bucket are judged where the bucket lies: their number grows with its square, that of the written ones does not."""
    draw = random.Random(4)
    base = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz ", k=1500))
    lines = [base]
    for _ in range(linking.FAMILY_NODES + 6):
        at = draw.randrange(1100)
        lines.append(base[:at] + "".join(draw.choices("abcdefghijklmnopqrstuvwxyz ", k=300)) + base[at + 300 :])
    lines.append(lines[5] + "...")
    pins = Pins(spark)
    sized = pins.pin(line_dedup.sized_lines(spark.createDataFrame(list(enumerate(lines)), "node long, text string"), 4), "test-lines")
    # A second bucket has two nodes, one of them its hub, which the other one has been compared with.
    postings = sized.selectExpr("explode(if(node < 2, array(1L, 2L), array(1L))) as bucket", "node", "size", "marks", "1 as need", "0 as own", "true as core")
    written, pin = {}, Pins.pin

    def counted(self, df, name):
        found = pin(self, df, name)
        if name in ("pairs", "rest"):
            written[name] = found.count()
        return found

    monkeypatch.setattr(Pins, "pin", counted)
    roots = linking.link(pin(pins, postings, "test-postings"), sized, partial(line_dedup.line_sets, chars=4), 80, pins)
    assert {(r.node, r.root) for r in roots.collect()} == {(len(lines) - 1, 5)}
    assert 1 <= written["pairs"] <= 20 and written["rest"] == len(lines) - 1


def test_groups_that_span_batches_are_judged_whole(spark, monkeypatch):
    few = 8
    monkeypatch.setattr(linking, "FEW", few)
    draw, rows, sets = random.Random(5), [], {}
    for bucket in range(-30, 30):
        base = [draw.getrandbits(64) for _ in range(draw.choice([5, 40, 250, 280, 900]))]
        for k in range(draw.choice([1, 2, 3, 9, 25])):
            own = sorted({*draw.sample(base, len(base) - draw.randrange(1 + len(base) // 5)), *(draw.getrandbits(64) for _ in range(draw.randrange(1 + len(base) // 5)))})
            node = len(sets)
            sets[node] = np.array(own, dtype=np.uint64)
            words = linking.MARKS if len(own) <= 64 * linking.MARKS else linking.FINE
            signs = linking.marks(sets[node], np.array([0, len(own)]), words)[0].tolist()
            rows.append((bucket, draw.choice([-2, -2, 3]), node, len(own), draw.randrange(8), signs))
    expected, crowded = set(), set()
    for group in {r[:2] for r in rows}:
        pairs = set()
        for x, y in itertools.combinations([r for r in rows if r[:2] == group], 2):
            words = min(len(x[5]), len(y[5]))
            x_signs, y_signs = (linking.marks(sets[r[2]], np.array([0, r[3]]), words)[0] for r in (x, y))
            differ = int(np.bitwise_count(x_signs.view(np.uint64) ^ y_signs.view(np.uint64)).sum())
            if x[4] != y[4] and 100 * min(x[3], y[3]) >= 80 * max(x[3], y[3]) and 180 * differ <= 20 * (x[3] + y[3]):
                pairs.add((*group, x[2], y[2]))
        if len(pairs) > few:
            crowded.add((*group, None, None))
        else:
            expected |= pairs
    draw.shuffle(rows)
    members = spark.createDataFrame(rows, "bucket long, class long, node long, size long, family long, signs array<long>").repartition(3)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    for batch in ("1", "7", "5000"):
        spark.conf.set(size, batch)
        found = [tuple(r) for r in linking.alike_pairs(members, 80).collect()]
        assert len(found) == len(set(found)) and set(found) == expected | crowded
    spark.conf.set(size, before)
    assert expected and crowded
