"""The query of the archive source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm import warc
from shelfspark.llm.common import table
from shelfspark.llm.registry import query

WARC_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(encode(coalesce(html, ''))) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM g
"""


@query("op7_warc", WARC_SQL)
def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived_pages(table(spark, folder, "pages"))
