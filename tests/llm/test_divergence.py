import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from omnimart.llm import divergence, perfect_hash

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least=3, top=200):
    """The audit of (text, lang, source) rows, as it is defined."""
    docs = [(TERM.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())), lang or "", source or "") for t, lang, source in rows]
    held = defaultdict(Counter)
    for terms, lang, _ in docs:
        held[lang].update(set(terms))
    counts = defaultdict(Counter)
    for terms, lang, source in docs:
        kept = [t for t in terms if held[lang][t] >= least]
        counts[lang, source].update(kept)
        counts[lang, None].update(kept)
    out = set()
    for lang in {d[1] for d in docs}:
        kept = sorted(t for t, n in held[lang].items() if n >= least)
        sources = sorted({d[2] for d in docs if d[1] == lang})
        share = {}
        for s in [*sources, None]:
            n = sum(counts[lang, s].values())
            share[s] = {t: 1 + 10**9 * (counts[lang, s][t] + 1) // (n + len(kept)) for t in kept}
        for s in sources:
            pairs = [(-sum((share[s][t] - share[o][t]) ** 2 // share[o][t] for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-((share[s][t] - share[None][t]) ** 2 // share[None][t]), t) for t in kept if counts[lang, s][t] and share[s][t] > share[None][t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item.decode(), -v, r) for r, (v, item) in enumerate(found, 1)}
    return out


def corpus(seed, n, words=60):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 4))) for _ in range(words)]
    rows = []
    for _ in range(n):
        lang, source = draw.choice(["de", "en", "en", "en"]), draw.choice(["a", "a", "a", "b", "c", "d", "é"])
        rows.append((" ".join(draw.choice(vocabulary).title() for _ in range(draw.randint(0, 40))), lang, source))
    return rows


ODD = [(None, "en", "a"), ("", None, None), ("x x x", None, "a"), ("1 2 3", "fr", "p"), ("4", "fr", "q"), ("long " * 20_000 + "end", "en", "b"), ("Ab" * 50_000, "en", "b")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "text string, lang string, source string, rank int")


@pytest.mark.parametrize("settings", [{}, {"sent_bytes": 0}, {"shard_terms": 7}, {"sent_bytes": 0, "shard_terms": 7, "sources": 2}, {"top": 3}], ids=str)
def test_equals_the_plain_form(spark, settings):
    rows = corpus(5, 300) + ODD * 3
    found = {tuple(r) for r in divergence.audit(frame(spark, rows), **settings).collect()}
    assert found == plain(rows, top=settings.get("top", 200))


def test_ties_go_by_bytes_and_repeated_rows_count(spark):
    rows = [("zeta alpha éta", "en", "a")] * 3 + [("other", "en", "b")] * 3
    found = divergence.audit(frame(spark, rows)).where("part = 'term' and source = 'a'").orderBy("rank").collect()
    assert [r.item for r in found] == ["alpha", "zeta", "éta"] and len({r.value for r in found}) == 1


def test_no_rows_and_no_kept_terms(spark):
    assert divergence.audit(frame(spark, [])).collect() == []
    rows = [("once", "en", "a"), ("never", "en", "b")]
    assert {tuple(r) for r in divergence.audit(frame(spark, rows)).collect()} == plain(rows) == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}


def test_shares_are_exact_for_large_counts():
    counts = np.array([0, 1, 10**12, 9 * 10**15 // 4], dtype=np.int64)
    n = 9 * 10**15 // 2
    assert divergence.shares(counts, n, 77).tolist() == [1 + 10**9 * (int(c) + 1) // (n + 77) for c in counts]


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_hash_is_minimal_and_knows_its_terms(n):
    terms = [f"t{i}".encode() for i in range(n)]
    shard = perfect_hash.shard_of(perfect_hash.hashes(terms), 5)
    index = perfect_hash.PerfectHashes({k: perfect_hash.build([t for t, s in zip(terms, shard) if s == k]) for k in range(5) if (shard == k).any()}, 5)
    assert sorted(index.slots(terms).tolist()) == list(range(n))
    assert [index.terms(i, i + 1)[0] for i in index.slots(terms).tolist()] == terms
    assert set(index.slots([f"u{i}".encode() for i in range(500)]).tolist()) == {-1}


def test_equal_hashes_are_told_by_the_stored_term(monkeypatch):
    monkeypatch.setattr(perfect_hash, "hashes", lambda terms: np.array([len(t) for t in terms], dtype=np.uint64))
    terms = [b"aa", b"bb", b"cc", b"d"]
    index = perfect_hash.PerfectHashes({0: perfect_hash.build(terms)}, 1)
    assert sorted(index.slots(terms).tolist()) == [0, 1, 2, 3]
    assert index.slots([b"zz", b"e", b"aaa"]).tolist() == [-1, -1, -1]
