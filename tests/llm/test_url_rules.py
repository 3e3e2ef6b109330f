import pytest

from omnimart.llm import url_rules
from omnimart.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string"


def plain(url):
    """Every rule on every url."""
    host, path = url_rules.parse(url)
    found = []
    for rule in URL_RULES:
        if rule.host:
            own, slash, rest = rule.text.partition("/")
            fits = (host == own or host.endswith("." + own)) and path.startswith(slash + rest)
        else:
            parts = rule.text.split("*")
            at, fits = 0, True
            for part in parts:
                at = (host + path).find(part, at)
                if at < 0:
                    fits = False
                    break
                at += len(part)
        if fits:
            found.append(rule)
    best = max(found, key=url_rules.Rule.rank, default=None)
    return host, path, best.text if best and best.host else None, best.verdict if best else "allow"


URLS = [
    "https://www.a.example.org/en/123", "http://a.example.org/es/1", "http://a.example.org/es", "HTTP://A.Example.ORG/en/2?x=/es/", "https://org/x", "https://xorg/x",
    "http://b.example.com/fr/1", "http://b.example.com/de/1#fr", "http://b.example.com/DE/1", "http://b.example.com?de/1", "http://b.example.com", "http://com/de/",
    "https://www.cheap-pills.example.net/en/1", "https://xcheap-pills.example.net/en/1", "cheap-pills.net/x", "https://free-bets.example.com/fr/7", "http://ads-track.example.net/",
    None, "", "no scheme", "://", "a://b://c/d", "http://" + "a." * 20_000 + "org/" + "x/" * 50_000, "http://ünï.example.com/de/é", "http://h:80/p\nq",
]


def test_equals_trying_all_rules(spark):
    rows = [*enumerate(URLS), (1, URLS[0]), (None, URLS[6])]
    found = url_rules.judge(spark.createDataFrame([(i, u, None) for i, u in rows], PAGES), URL_RULES).collect()
    by = sorted([(str(r.page_id), r.host, r.path, r.rule, r.verdict) for r in found], key=str)
    assert by == sorted([(str(i), *plain(u)) for i, u in rows], key=str)


def test_contract_cases(spark):
    found = {r.page_id: (r.rule, r.verdict) for r in url_rules.judge(spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], PAGES), URL_RULES).collect()}
    assert found[0] == ("example.org/en/1", "block") and found[1] == ("example.org/es/", "block") and found[2] == ("org/", "allow")
    assert found[6] == ("com/fr/", "allow") and found[7] == ("com/de/", "block") and found[8] == (None, "allow") and found[10] == (None, "allow")
    assert found[12] == (None, "block") and found[15] == ("com/fr/", "allow") and found[16] == (None, "block")


def test_rules_are_indexed_by_rarest_token(spark):
    rows = spark.createDataFrame([(1, "http://a.example.org/es/1", None)] * 3 + [(2, "http://es.x/", None)], PAGES)
    index = url_rules.index_rules(rows, [url_rules.host_rule("example.org/es/", "block"), url_rules.host_rule("example.org/es", "block"), url_rules.pattern_rule("*bets*", "block")])
    assert {k: [r.text for r in v] for k, v in index.items()} == {"example": ["example.org/es/", "example.org/es"], "": ["*bets*"]}


def test_only_whole_words_are_tokens():
    assert url_rules.host_rule("example.org/en/1", "x").tokens() == {"example", "org", "en"}
    assert url_rules.pattern_rule("ab*.cd-ef*gh", "x").tokens() == {"cd"}


def test_empty_and_clashing(spark):
    rows = spark.createDataFrame([], PAGES)
    assert url_rules.judge(rows, URL_RULES).count() == 0
    assert url_rules.judge(rows, []).count() == 0
    extra = spark.createDataFrame([(1, "http://x.org/", "h", "v")], "page_id long, url string, host string, verdict string")
    assert tuple(url_rules.judge(extra, URL_RULES).first())[:4] == (1, "x.org", "/", "org/")
    with pytest.raises(ValueError):
        url_rules.judge(extra.drop("url"), URL_RULES)
