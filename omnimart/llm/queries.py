"""Registered queries of the training-data operators, each over its whole table.

Where the rows of a query are set by its contract, columns come in that order and further
ones follow.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from omnimart.llm import decontaminate, divergence, line_dedup, multi_index, ngram_join, quality, resampling, sentencepiece_codec, shard_table, substring_dedup, token_files, toxicity, url_rules
from omnimart.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2
SHARDS = tuple(f"shard-{i:04d}" for i in range(256))
URL_RULES = (
    url_rules.host_rule("org/", "allow"),
    url_rules.host_rule("example.org/es/", "block"),
    url_rules.host_rule("example.org/en/1", "block"),
    url_rules.host_rule("com/fr/", "allow"),
    url_rules.host_rule("com/de/", "block"),
    url_rules.pattern_rule("*.cheap-pills.*", "block"),
    url_rules.pattern_rule("cheap-pills.*", "block"),
    url_rules.pattern_rule("*free-bets.*", "block"),
    url_rules.pattern_rule("*ads-track.*", "block"),
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade, probability of a usable grade, and selection of each document."""
    docs = _table(spark, folder, "documents")
    model = quality.fit(docs, quality.quality_grades(_table(spark, folder, "labels")))
    return quality.score(docs.select("doc_id", "text"), model, tail=1).drop("text")


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, rule and verdict of each page's url."""
    return url_rules.judge(_table(spark, folder, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "pattern")


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its lines, how many went, and length and digest of the text that is left."""
    found = line_dedup.dedup_lines(_table(spark, folder, "documents"))
    counts = [F.col(c).cast("long").alias(c) for c in ("n_lines", "n_removed")]
    return found.select("doc_id", *counts, F.length("text").cast("long").alias("n_chars_left"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item's shingles and how many of them they hold."""
    return decontaminate.contained_items(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op5_wavelet_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Place, count and checksum of each document's token ids, read back from the shard files."""
    where = scratch_path(spark, "token-shards")
    token_files.write_shards(_table(spark, folder, "documents"), BYTE_BPE, END_ID, where)
    return token_files.read_documents(spark, where)


def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: size of its shingle set and smallest id it is linked with."""
    return ngram_join.similarity_classes(_table(spark, folder, "documents"))


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: number and hash of its ids, and whether they decode to its text."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = sentencepiece_codec.encode(docs, PIECES, back=True)
    blank = F.replace(F.coalesce("text", F.lit("")), F.lit(sentencepiece_codec.MARK), F.lit(" "))
    return found.select("doc_id", F.size("token_ids").alias("n_tokens"), F.xxhash64("token_ids").alias("ids_hash"), (F.col("decoded") == blank).alias("round_trip"))


def op8_shard_table(spark: SparkSession, folder: str) -> DataFrame:
    """Slot and shard of each document."""
    return shard_table.place(_table(spark, folder, "documents").select("doc_id"), "doc_id", SHARDS)


def op9_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors found for every hundredth one."""
    return multi_index.search(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of each document, learnt from labels outside the held-out fifth."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    # A null id counts as an empty text, whose remainder is 0.
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    index = toxicity.learn(docs, labels.where(~held_out).select("doc_id", F.col("toxic").alias("label")), associated=True)
    found = toxicity.score(docs, index)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Divergence of each source from the others of its language, and its most overrepresented terms."""
    return divergence.audit(_table(spark, folder, "documents")).select("lang", "source", "part", "item", "value", "rank")


def op12_resample(spark: SparkSession, folder: str) -> DataFrame:
    """Weight, score and rank of each document in a draw towards the benchmark's words."""
    found = resampling.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its words, how many stood in a repeated passage, and the digest of the words that are left."""
    return substring_dedup.digest(substring_dedup.remove_repeats(_table(spark, folder, "documents")))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_url_filter": op2_url_filter,
    "op3_line_dedup": op3_line_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_wavelet_tokens": op5_wavelet_tokens,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_shard_table": op8_shard_table,
    "op9_multi_index": op9_multi_index,
    "op10_toxicity": op10_toxicity,
    "op11_divergence": op11_divergence,
    "op12_resample": op12_resample,
    "op13_substring_dedup": op13_substring_dedup,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _shingles(table: str, key: str) -> str:
    """Distinct word shingles of a table, as SQL: (id, s)."""
    return f"""SELECT DISTINCT {key} AS id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
        FROM (SELECT {key}, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
              FROM {table} WHERE text IS NOT NULL AND {key} IS NOT NULL) AS words,
             unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS pos(i)
        WHERE len(w) > 0"""


#: Smallest node reachable from each node of edge(a, b), which has both directions.
_REACH = "reach(a, b) AS (SELECT a, b FROM edge UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)"

_HOST_RULES = ", ".join(f"('{r.text}', '{r.text.partition('/')[0]}', '/{r.text.partition('/')[2]}', '{r.verdict}')" for r in URL_RULES if r.host)

#: CRC-32 of a text column x as SQL: the usual table, built bit by bit, and one step a byte.
_CRC_TABLE = "(SELECT list(list_reduce([n, 0, 1, 2, 3, 4, 5, 6, 7], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) FROM range(256) AS r(n))"

ORACLES: dict[str, str] = {
    "op2_url_filter": f"""
        WITH rest AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') = 0 THEN ''
                        ELSE substr(url, strpos(url, '://') + 3) END AS r FROM pages),
        cut AS (SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS h FROM rest),
        parts AS (SELECT row_number() OVER () AS nth, page_id, translate(h, '{_UPPER}', '{_LOWER}') AS host,
                         regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM cut),
        rules(rule, own, start, verdict) AS (VALUES {_HOST_RULES}),
        best AS (SELECT nth, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
                 FROM parts JOIN rules ON (host = own OR ends_with(host, '.' || own)) AND starts_with(path, start) GROUP BY nth),
        found AS (SELECT page_id, host, path, rule, verdict,
                         CASE WHEN rule IS NOT NULL THEN NULL
                              WHEN contains(host || path, '.cheap-pills.') THEN '*.cheap-pills.*'
                              WHEN contains(host || path, 'cheap-pills.') THEN 'cheap-pills.*'
                              WHEN contains(host || path, 'free-bets.') THEN '*free-bets.*'
                              WHEN contains(host || path, 'ads-track.') THEN '*ads-track.*' END AS pattern
                  FROM parts LEFT JOIN best USING (nth))
        SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict, pattern
        FROM found""",
    "op3_line_dedup": f"""
        WITH RECURSIVE line AS (SELECT doc_id, i, string_split(text, chr(10))[i] AS l
            FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos(i) WHERE text IS NOT NULL),
        full_line AS (SELECT * FROM line WHERE trim(l, ' ' || chr(9) || chr(13)) <> ''),
        node AS (SELECT l, row_number() OVER (ORDER BY min((doc_id, i))) AS n, min((doc_id, i)) AS first FROM full_line GROUP BY l),
        shingle AS MATERIALIZED (SELECT DISTINCT n, substr(l, k, {line_dedup.CHARS}) AS s
            FROM node, unnest(range(1, greatest(length(l) - {line_dedup.CHARS - 1}, 1) + 1)) AS pos(k)),
        size AS (SELECT n, count(*) AS c FROM shingle GROUP BY n),
        pair AS (SELECT x.n AS a, y.n AS b, count(*) AS same FROM shingle x JOIN shingle y ON x.s = y.s AND x.n < y.n GROUP BY 1, 2),
        link AS (SELECT a, b FROM pair JOIN size p ON p.n = a JOIN size q ON q.n = b WHERE 100 * same >= {line_dedup.PERCENT} * (p.c + q.c - same)),
        edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
        {_REACH},
        root AS (SELECT a AS n, least(a, min(b)) AS r FROM reach GROUP BY a),
        -- Nodes are numbered by first occurrence, so a component's smallest node has its first line.
        kept AS (SELECT doc_id, i, l FROM full_line JOIN node USING (l) LEFT JOIN root USING (n) WHERE r IS NULL AND (doc_id, i) = first OR r = n AND (doc_id, i) = first),
        stays AS (SELECT doc_id, i, l FROM kept UNION ALL SELECT doc_id, i, l FROM line WHERE trim(l, ' ' || chr(9) || chr(13)) = ''),
        left_text AS (SELECT doc_id, count(*) AS n, string_agg(l, chr(10) ORDER BY i) AS t FROM stays GROUP BY doc_id),
        total AS (SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines,
                         CASE WHEN text IS NULL THEN NULL ELSE coalesce(t, '') END AS t, coalesce(left_text.n, 0) AS n
                  FROM documents LEFT JOIN left_text USING (doc_id))
        SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_lines - n AS BIGINT) AS n_removed, CAST(length(t) AS BIGINT) AS n_chars_left, md5(t) AS text_md5
        FROM total""",
    "op4_decontaminate": f"""
        WITH d AS ({_shingles("documents", "doc_id")}), b AS ({_shingles("benchmark", "item_id")}),
        size AS (SELECT id, count(*) AS n FROM b GROUP BY id)
        SELECT d.id AS doc_id, b.id AS item_id, any_value(n) AS n_item, count(*) AS n_shared
        FROM b JOIN d USING (s) JOIN size ON size.id = b.id GROUP BY d.id, b.id
        HAVING 100 * count(*) >= {decontaminate.PERCENT} * any_value(n)""",
    "op6_ngram_jaccard": f"""
        WITH RECURSIVE d AS MATERIALIZED ({_shingles("documents", "doc_id")}),
        size AS (SELECT id, count(*) AS n FROM d GROUP BY id),
        pair AS (SELECT x.id AS a, y.id AS b, count(*) AS same FROM d x JOIN d y ON x.s = y.s AND x.id < y.id GROUP BY 1, 2),
        link AS (SELECT a, b FROM pair JOIN size p ON p.id = a JOIN size q ON q.id = b WHERE 100 * same >= {ngram_join.PERCENT} * (p.n + q.n - same)),
        edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
        {_REACH},
        root AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
        FROM documents LEFT JOIN size ON size.id = doc_id LEFT JOIN root ON root.a = doc_id""",
    "op11_divergence": f"""
        WITH d AS MATERIALIZED (SELECT row_number() OVER () AS nth, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text,
                                       coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
        word AS MATERIALIZED (SELECT nth, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
        kept AS MATERIALIZED (SELECT lang, term FROM word GROUP BY ALL HAVING count(DISTINCT nth) >= {divergence.LEAST_DOCS}),
        size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        grp AS (SELECT DISTINCT lang, source FROM d),
        own AS (SELECT lang, source, term, count(*) AS c FROM word JOIN kept USING (lang, term) GROUP BY ALL),
        total AS (SELECT lang, source, sum(c) AS n FROM own GROUP BY ALL),
        share AS MATERIALIZED (SELECT grp.lang, grp.source, term, coalesce(c, 0) AS c,
                1 + (1000000000::HUGEINT * (coalesce(c, 0) + 1)) // (coalesce(n, 0) + v) AS p
            FROM grp JOIN kept USING (lang) JOIN size USING (lang) LEFT JOIN own USING (lang, source, term) LEFT JOIN total USING (lang, source)),
        whole AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(c) + 1)) // (any_value(n) + any_value(v)) AS q
            FROM own JOIN (SELECT lang, sum(c) AS n FROM own GROUP BY lang) USING (lang) JOIN size USING (lang) GROUP BY lang, term),
        pair AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
            FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
                  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
                  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM share JOIN whole USING (lang, term) WHERE c > 0 AND p > q)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
               CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
        FROM found QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) <= {divergence.TOP}""",
    "op12_resample": f"""
        WITH crc AS MATERIALIZED (SELECT {_CRC_TABLE} AS t),
        d AS MATERIALIZED (SELECT row_number() OVER () AS nth, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        b AS (SELECT unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS f FROM benchmark),
        feature AS MATERIALIZED (SELECT nth, unnest(w) AS f FROM d),
        one AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM feature UNION SELECT f FROM b)),
        bucket AS MATERIALIZED (SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
            lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1])), 4294967295) % {resampling.BUCKETS} AS k FROM one, crc),
        s AS (SELECT k, count(*) AS n FROM feature JOIN bucket USING (f) GROUP BY k),
        t AS (SELECT k, count(*) AS n FROM b JOIN bucket USING (f) GROUP BY k),
        gain AS (SELECT k, CAST(floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + {resampling.BUCKETS})::DOUBLE)
                 / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + {resampling.BUCKETS})::DOUBLE))) AS BIGINT) AS g
                 FROM range({resampling.BUCKETS}) AS r(k) LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
        weight AS (SELECT nth, CAST(sum(g) AS BIGINT) AS weight FROM feature JOIN bucket USING (f) JOIN gain USING (k) GROUP BY nth),
        scored AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
            coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{resampling.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
            FROM d LEFT JOIN weight USING (nth)),
        drawn AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {resampling.LEAST_WORDS} ORDER BY score DESC, doc_id) AS r,
                         count(*) OVER (PARTITION BY n_features >= {resampling.LEAST_WORDS}) AS n FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {resampling.LEAST_WORDS} AND r <= {resampling.PERCENT} * n // 100 THEN r END AS rank FROM drawn""",
    "op13_substring_dedup": f"""
        WITH d AS MATERIALIZED (SELECT row_number() OVER () AS nth, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        span AS MATERIALIZED (SELECT nth, i, md5(array_to_string(w[i : i + {substring_dedup.LEAST - 1}], ' ')) AS h
                              FROM d, unnest(range(1, len(w) - {substring_dedup.LEAST - 2})) AS pos(i)),
        repeated AS (SELECT h FROM span GROUP BY h HAVING count(*) > 1),
        gone AS (SELECT DISTINCT nth, unnest(range(i, i + {substring_dedup.LEAST})) AS j FROM span JOIN repeated USING (h)),
        word AS (SELECT nth, j, w[j] AS x FROM d, unnest(range(1, len(w) + 1)) AS pos(j)),
        kept AS (SELECT nth, count(*) AS n, string_agg(x, ' ' ORDER BY j) AS t FROM word ANTI JOIN gone USING (nth, j) GROUP BY nth)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (nth)""",
}
