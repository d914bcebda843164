"""The registered queries of the subpackage, and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from verdance.llm.common import ship, table


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from verdance.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from verdance.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from verdance.llm.urls import filter_urls

    return filter_urls(table(spark, sf_dir, "pages"))


def op4_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from verdance.llm.quality import quality

    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from verdance.llm.tokens import token_counts

    return token_counts(table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from verdance.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from verdance.llm.packing import packed_sequences

    return packed_sequences(table(spark, sf_dir, "documents"))


def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from verdance.llm.html import extract

    return extract(table(spark, sf_dir, "pages"))


def op9_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    from verdance.llm.topk import top_products

    return top_products(table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from verdance.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("spans")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(f: Callable) -> Callable:
        @functools.wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        return run

    return {k: shipped(f) for k, f in globals().items() if k.startswith("op")}


_MIX = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, (length(text) - length(regexp_replace(text, '[^\p{L}\p{N}\x09-\x0D\x20]+', '', 'g')))::DOUBLE / greatest(length(text), 1) AS odd, md5('42|' || coalesce(CAST(doc_id AS VARCHAR), '?')) AS m FROM documents),
k AS (SELECT doc_id, source, size, -ln((CAST(('0x' || substr(m, 1, 13)) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE) * (1 + least(8.0::DOUBLE, 8.0::DOUBLE * coalesce(odd, 0))) AS key FROM d),
s AS (SELECT source, sum(size) AS source_size FROM k GROUP BY 1), w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s),
f AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS c FROM w),
t AS (SELECT source, source_size, least(w * max(c) OVER (), 2.0::DOUBLE * source_size) AS target FROM f), g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
r AS (SELECT k.*, source_size, target, epochs, target - epochs * source_size AS rest, sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source),
x AS (SELECT source, min(upto) AS over FROM r WHERE size > 0 AND upto > rest GROUP BY 1), c AS (SELECT r.source, r.doc_id, r.key, r.upto >= x.over AS later, r.size, min(r.rest - (r.upto - r.size)) FILTER (r.upto = x.over AND r.size > 0) OVER (PARTITION BY r.source) AS gap FROM r JOIN x ON r.source IS NOT DISTINCT FROM x.source),
n AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY abs(size - gap), key, doc_id) AS n FROM c WHERE later AND size > 0 AND abs(size - gap) < abs(gap))
SELECT r.doc_id, r.size, CAST(r.source_size AS BIGINT) AS source_size, r.target, CAST(r.size * (epochs + CASE WHEN rest > 0 AND r.size > 0 AND (r.upto < x.over OR n.doc_id IS NOT NULL) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r LEFT JOIN x ON r.source IS NOT DISTINCT FROM x.source LEFT JOIN n ON r.source IS NOT DISTINCT FROM n.source AND r.doc_id = n.doc_id AND n.n = 1"""

_NEAR = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) >= 0.9),
r AS (SELECT vec_id AS u, vec_id AS v FROM embeddings UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u), n AS (SELECT u, count(*) AS n FROM l GROUP BY 1), c AS (SELECT u, min(v) AS c FROM r GROUP BY 1)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.c AS component_id, c.c = e.vec_id AS kept FROM embeddings e LEFT JOIN n ON e.vec_id = n.u LEFT JOIN c ON e.vec_id = c.u"""

_TOP = """
WITH v AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(64 * x)) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 20"""


def oracle_sql() -> dict[str, str]:
    """Of the queries that SQL can express; models, tokenizers, XXH64 and markup it can't."""
    return {"op1_embedding_near_dedup": _NEAR, "op2_source_mixing": _MIX, "op9_top_products": _TOP}
