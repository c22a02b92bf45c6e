"""Queries of the filter audit, the centroid clusters and the extraction of main texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm import centroids, filter_audit, html_extraction
from shelfspark.llm.common import table
from shelfspark.llm.registry import query

FILTER_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
m AS (SELECT doc_id, part,
             [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
              100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text),
              regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
w AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM m LEFT JOIN l USING (doc_id) GROUP BY part, fails),
f AS (SELECT unnest([1, 2, 3, 4, 5]) AS f),
o AS (SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
r AS (SELECT w.*, o, list_min(list_transform([1, 2, 3, 4, 5], lambda i: CASE WHEN fails[o[i]] THEN i ELSE 6 END)) AS gone FROM w, o),
s AS (SELECT part, o, f AS step, o[f] AS fltr, n, good, toxic, gone, fails FROM r, f),
t AS (SELECT part, o, step, fltr, sum(CASE WHEN gone > step THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN gone < step AND fails[fltr] THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN fails[fltr] AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN gone = step THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS toxic_lost
      FROM s GROUP BY part, o, step, fltr)
SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, step::INT AS step,
       kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, fltr))::BIGINT AS shapley
FROM t
"""


@query("op11_filter_audit", FILTER_SQL)
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _round_sql(i: int) -> str:
    """The assignment to the centroids c{i}, and the centroids after it."""
    return f"""
q{i} AS MATERIALIZED (SELECT x.vec_id, c.cluster, sum((x.x - c.x) * (x.x - c.x))::BIGINT AS distance
      FROM x JOIN c{i} c USING (d) GROUP BY x.vec_id, c.cluster),
a{i} AS MATERIALIZED (SELECT vec_id, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM q{i} GROUP BY vec_id),
c{i + 1} AS MATERIALIZED (SELECT c.cluster, c.d, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN
      (SELECT cluster, d, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
       FROM a{i} JOIN x USING (vec_id) GROUP BY cluster, d) m USING (cluster, d))"""


CLUSTER_SQL = (
    """
WITH e AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64
           AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = 64),
x AS MATERIALIZED (SELECT vec_id, unnest(range(1, 65)) AS d, unnest(list_transform(embedding, lambda v: floor(256 * v::DOUBLE)::BIGINT)) AS x FROM e),
f AS (SELECT vec_id, (row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1)::INT AS cluster FROM e),
c0 AS MATERIALIZED (SELECT cluster, d, x FROM f JOIN x USING (vec_id) WHERE cluster < 40),"""
    + ",".join(_round_sql(i) for i in range(6))
    + """,
h AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c5 GROUP BY cluster)
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a5 JOIN h USING (cluster)
"""
)


@query("op12_centroid_clusters", CLUSTER_SQL)
def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.centroid_clusters(table(spark, folder, "embeddings"))


@query("op13_html_extraction")
def op13_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extraction.main_text(table(spark, folder, "pages"))
