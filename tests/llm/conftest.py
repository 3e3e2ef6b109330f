import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (id, text) pairs."""

    def make(pairs):
        rows = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS)

    return make


def lower_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def word_shingles(text):
    words = lower_words(text)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


class Groups:
    """Union-find, for expected values."""

    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def root(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a
