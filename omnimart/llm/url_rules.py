"""URL verdicts by pattern rules that are indexed by their rarest literal token.

A rule is a host with a path (it fits the host and all subdomains, if the path starts with the
rule's), or a pattern over host and path in which ``*`` stands for anything. Each becomes
a regular expression. The whole words (letters and digits) that every url it fits must hold
are its tokens; tokens are counted over all urls, and the rarest one of a rule is its key in
the index. A url's own tokens fetch the rules that can fit at all, and only their
expressions run. Rules without a whole token are tried on every url.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from
there up to ``?``, ``#`` or the end. A null url, or one without ``://``, has an empty host and
path. Of the host rules that fit, the longest wins (then the longer host), and it outranks patterns; of patterns
likewise the longest. Without any the verdict is ``default``.
Repeated rows and null ids get a result each; extra columns are not read. The rule list is the
query set and is sent to all tasks, at most ``RULES`` rules.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from omnimart.llm.frames import fresh, map_batches

RULES = 200_000
_TOKEN = re.compile(r"[a-z0-9]+")
_TOKENS = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    text: str
    verdict: str
    host: bool

    def expression(self) -> str:
        """Regular expression over host and path, matched from the start."""
        if self.host:
            host, slash, path = self.text.partition("/")
            return rf"(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}"
        return ".*" + ".*".join(map(re.escape, self.text.split("*")))

    def tokens(self) -> set[str]:
        """Words that stand whole in whatever the rule fits."""
        literal = "." + self.text.lower() if self.host else self.text.lower()
        found = set()
        for part in literal.split("*"):
            # A word at either end of a literal may go on in the url.
            found |= {m[0] for m in _TOKEN.finditer(part) if m.start() > 0 and m.end() < len(part)}
        return found

    def rank(self) -> tuple:
        return self.host, len(self.text), len(self.text.partition("/")[0]), self.text


def host_rule(text: str, verdict: str) -> Rule:
    return Rule(text, verdict, True)


def pattern_rule(text: str, verdict: str) -> Rule:
    return Rule(text, verdict, False)


def parse(url: str | None) -> tuple[str, str]:
    """Host and path."""
    if url is None:
        return "", ""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def index_rules(pages: DataFrame, rules: Sequence[Rule]) -> dict[str, list[Rule]]:
    """Rules by their rarest token among all urls; those without one under the empty text."""
    if len(rules) > RULES:
        raise ValueError(f"more than {RULES} rules")
    wanted = sorted({t for r in rules for t in r.tokens()})
    spark = pages.sparkSession
    names = F.broadcast(spark.range(1).select(F.explode(F.split(F.lit(" ".join(wanted)), " ")).alias("token")))
    found = fresh(pages, "url").select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("url"), F.lit(_TOKENS), F.lit(0)))).alias("token")).join(names, "token")
    count = defaultdict(int, {r[0]: r[1] for r in found.groupBy("token").count().collect()})
    index = defaultdict(list)
    for rule in sorted(rules, key=Rule.rank, reverse=True):
        index[min(rule.tokens(), key=lambda t: (count[t], t), default="")].append(rule)
    return dict(index)


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (null if none), pattern (null if none) and verdict of each page's url."""
    index = index_rules(pages, rules)

    def run(batches):
        ready = {token: [(r, re.compile(r.expression(), re.S)) for r in own] for token, own in index.items()}
        for batch in batches:
            rows = []
            for url in batch["url"].to_pylist():
                host, path = parse(url)
                where = host + path
                best = None
                for token in {"", *_TOKEN.findall(where.lower())}:
                    for rule, expression in ready.get(token, ()):
                        if (best is None or rule.rank() > best.rank()) and expression.match(where):
                            best = rule
                rows.append((host, path, best.text if best and best.host else None, best.text if best and not best.host else None, best.verdict if best else default))
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([batch["page_id"], *(pa.array(c, pa.string()) for c in columns)], ["page_id", "host", "path", "rule", "pattern", "verdict"])

    return map_batches(fresh(pages, "page_id", "url"), run, "page_id long, host string, path string, rule string, pattern string, verdict string")
