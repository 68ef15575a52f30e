"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airtally.llm import bpe, divergence, jaccard, language, mixing, privacy, quality, rules, search, secrets, token_files, topk, toxicity
from airtally.llm.common import table
from airtally.session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[make.__name__] = make
    return make


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.decided(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find(table(spark, sf_dir, "documents")))


@query
def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"))


@query
def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


ORACLES["op5_topk"] = """
WITH v AS (
    SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) AS ranked
WHERE rank <= 5
"""


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """The place of a public vocabulary file; the package that holds them is installed beside Spark."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), vocabulary_path()
    return bpe.digest(docs, path, bpe.lexicon(docs, path))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.digest(privacy.find(table(spark, sf_dir, "documents")))


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


@query
def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op11_search"] = r"""
WITH words AS (
    SELECT doc, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS doc, doc_id, text FROM documents) AS d
), postings AS (
    SELECT doc, doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), lengths AS (
    SELECT doc, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY doc
), totals AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * t.docs + 2 AS DOUBLE) / CAST(2 * p.df + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term) AS p, totals t
), items AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scored AS (
    SELECT i.item_id, p.doc, p.doc_id,
           CAST(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (100 - 50 + (50 * l.n * t.docs) // t.terms)))) AS BIGINT) AS score
    FROM items i JOIN postings p USING (term) JOIN weights w USING (term) JOIN lengths l USING (doc), totals t
    GROUP BY i.item_id, p.doc, p.doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) AS ranked
WHERE rank <= 50
"""


@query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op12_divergence"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), words AS (
    SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
    SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), langs AS (
    SELECT lang, sum(total) AS n, count(*) AS v FROM kept GROUP BY lang
), groups AS (
    SELECT g.lang, g.source, coalesce(s.n, 0) AS n, coalesce(l.v, 0) AS v
    FROM (SELECT DISTINCT lang, source FROM d) g
    LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL) s USING (lang, source)
    LEFT JOIN langs l USING (lang)
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // (g.n + g.v) AS p,
           1 + CAST(1000000000 AS HUGEINT) * (k.total + 1) // (l.n + l.v) AS q
    FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), priced AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN priced p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found) AS ranked
WHERE part = 'pair' OR rank <= 200
"""


@query
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.checksums(table(spark, sf_dir, "documents"), new_folder(spark, "token-files"), vocabulary_path())
