"""Registered queries of this subpackage; each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderflow.llm import (
    bpe, decontaminate, embedding_dedup, html_extract, jaccard_join, periodic_runs, quality, repeats, secret_scan, sharding,
    toxicity, url_filters, whitening,
)
from orderflow.llm.common import prepare, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(sharding.minimax_shards(table(spark, sf_dir, "documents")))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    return periodic_runs.digest(periodic_runs.periodic_runs(docs))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def _ready(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES = {f.__name__: _ready(f) for f in (
    op1_toxicity, op2_bpe, op3_repeats, op4_url_filters, op5_decontamination, op6_embedding_dedup, op7_secret_scan,
    op8_jaccard_join, op9_sharding, op10_html_text, op11_periodic_runs, op12_whitening, op13_quality)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _low(column: str) -> str:
    return f"translate({column}, '{_UPPER}', '{_LOWER}')"


#: Smallest node that links lead to, over a table links(a, b) that holds both directions.
_REACH = """reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)"""

ORACLE: dict[str, str] = {
    "op4_url_filters": f"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS r FROM pages),
parts AS (SELECT page_id, coalesce({_low("regexp_extract(r, '^[^/?#]*')")}, '') AS host,
    coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
rules(verdict, host, path) AS (VALUES {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in url_filters.RULES)}),
judged AS (SELECT page_id, host, path, (SELECT r.host || r.path FROM rules r
    WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    ORDER BY length(r.host || r.path) DESC, r.host || r.path LIMIT 1) AS rule FROM parts p)
SELECT page_id, judged.host, judged.path, rule, coalesce(rules.verdict, 'allow') AS verdict
FROM judged LEFT JOIN rules ON rule = rules.host || rules.path
""",
    "op5_decontamination": f"""
WITH items AS (SELECT item_id, regexp_extract_all({_low("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS gram
    FROM items, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
docs AS (SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all({_low("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents),
grams AS (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram
    FROM docs, (SELECT DISTINCT n FROM windows) AS sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS (SELECT r, i, n, item_id FROM grams JOIN windows USING (n, gram)),
words AS (SELECT r, count(DISTINCT k) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(k) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN named USING (r)
""",
    "op6_embedding_dedup": f"""
WITH RECURSIVE vecs AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x <> 0]) > 0
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM vecs a JOIN vecs b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {embedding_dedup.THRESHOLD}),
{_REACH}, degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least.b, vec_id)) AS component_id,
    vec_id <= coalesce(least.b, vec_id) AS kept
FROM embeddings LEFT JOIN degree ON vec_id = degree.a LEFT JOIN least ON vec_id = least.a
""",
    "op8_jaccard_join": f"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce(regexp_extract_all({_low("text")}, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
    FROM docs, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
{_REACH}
SELECT docs.doc_id, coalesce(n, 0) AS n_shingles, least(docs.doc_id, coalesce(least.b, docs.doc_id)) AS component_id
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON docs.doc_id = least.a
""",
}
