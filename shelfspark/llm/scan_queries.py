"""Queries of the operators that SQL can express: licence scan, secret scan, exact dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm import exact_dedup as dedup, licence_scan as licences, secret_scan as secrets
from shelfspark.llm.common import table
from shelfspark.llm.registry import query

EXACT_DEDUP_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""


@query("op6_exact_dedup", EXACT_DEDUP_SQL)
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.exact_dedup(table(spark, folder, "documents"))


def _secret_sql() -> str:
    """Every kind is found in the same way: pieces between matches and matches give the places by running sums."""
    quoted = lambda s: s.replace("'", "''")
    kinds = " UNION ALL ".join(
        f"""SELECT row_id, {rank} AS rank, '{role}' AS role, {str(strong).lower()} AS strong, {least} AS least,
            unnest(list_transform(string_split_regex(text, '{quoted(pattern)}'), lambda x: length(x))) AS gap,
            unnest(list_transform(regexp_extract_all(text, '{quoted(pattern)}', 0), lambda x: length(x))) AS size,
            unnest(list_transform(regexp_extract_all(text, '{quoted(pattern)}', {group}), lambda x: length(x))) AS tested,
            generate_subscripts(string_split_regex(text, '{quoted(pattern)}'), 1) AS no FROM docs"""
        for rank, role, strong, pattern, group, least in secrets.KINDS.values()
    )
    near = lambda test, field, over: f"{field}(CASE WHEN {test} THEN \"{ {'max': 'end', 'min': 'begin'}[field] }\" END) OVER {over}"
    role_near = lambda role: (
        f"(coalesce({near(f'role = {chr(39)}{role}{chr(39)}', 'max', 'earlier')} >= \"begin\" - {secrets.REACH}, false)"
        f" OR coalesce({near(f'role = {chr(39)}{role}{chr(39)}', 'min', 'later')} <= \"end\" + {secrets.REACH}, false))"
    )
    linked = "CASE role " + " ".join(
        f"WHEN '{role}' THEN " + " OR ".join(role_near(x) for x in others) for role, others in secrets.COMPLETES.items()
    ) + " END"
    name = "CASE rank " + " ".join(f"WHEN {v[0]} THEN '{k}'" for k, v in secrets.KINDS.items()) + " END"
    frames = """WINDOW earlier AS (PARTITION BY row_id ORDER BY "begin", rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      later AS (PARTITION BY row_id ORDER BY "begin", rank ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"""
    listed = lambda test: f"coalesce(string_agg({name} || ':' || \"begin\" || ':' || \"end\", ',' ORDER BY \"begin\", rank) FILTER (WHERE {test}), '')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({kinds}),
placed AS (SELECT *, sum(gap + size) OVER (PARTITION BY row_id, rank ORDER BY no ROWS UNBOUNDED PRECEDING) AS "end" FROM found WHERE size IS NOT NULL),
parts AS (SELECT row_id, rank, role, strong, CAST("end" - size AS BIGINT) AS "begin", CAST("end" AS BIGINT) AS "end" FROM placed WHERE tested >= least),
outside AS (SELECT * EXCLUDE inside FROM (
  SELECT *, coalesce({near('strong', 'max', 'earlier')} > "begin", false) OR coalesce({near('strong', 'min', 'later')} < "end", false) AS inside
  FROM parts {frames}) WHERE strong OR NOT inside),
linked AS (SELECT *, {linked} AS linked FROM outside {frames})
SELECT d.doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
       count(*) FILTER (WHERE rank = 2) AS n_hex, sha256({listed('strong')}) AS base_sha256,
       {listed('strong OR linked')} AS spans, count(*) FILTER (WHERE strong OR linked) AS n_spans
FROM docs d LEFT JOIN linked l USING (row_id) GROUP BY d.row_id, d.doc_id
"""


@query("op3_secret_scan", _secret_sql())
def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_scan(table(spark, folder, "documents"))


def _licence_sql() -> str:
    """The same sentences, first known identifier and ordered rules as shipped; one step per rule, each taking out its sequence."""
    quoted = lambda s: s.replace("'", "''")
    likely = quoted(licences.prefilter())
    known = "CASE " + " ".join(f"WHEN regexp_matches(s, '{quoted(p)}') THEN '{i}'" for i, p in licences.ALL_SENTENCES)
    known += f" WHEN regexp_matches(s0, '{quoted(licences.CRITICAL)}') THEN '?' END"
    marks = r"""["''`*#/_:<>|\x{201c}\x{201d}\x{2018}\x{2019}\x{00ab}\x{00bb}\x{2010}\x{2011}\x{2013}\x{2014}-]+"""
    clean = f"replace(regexp_replace(lower(s0), '{marks}', ' ', 'g'), 'licence', 'license')"
    clean = f"trim(replace(regexp_replace({clean}, '[\\x20\\x09-\\x0D\\x{{00a0}}]+', ' ', 'g'), ' ,', ','), ' ')"
    names = ", ".join(f"'{k}': '{v}'" for k, v in licences.SPDX_NAMES.items())
    bare = f"regexp_replace(regexp_replace(s0, '(?i)^.*?identifier:', ''), '{licences.SPDX_WITH}', '~\\1', 'g')"
    named = (
        f"'SPDX:' || (MAP {{{names}}})[lower(regexp_replace(split_part(w, '~', 1), '[.-]+$', ''))] || "
        "CASE WHEN contains(w, '~') THEN ' WITH ' || regexp_replace(split_part(w, '~', 2), '[.-]+$', '') ELSE '' END"
    )
    steps, last = [], "sequences"
    for n, (name, ids) in enumerate(licences.ALL_RULES):
        seq = licences.rule_pattern(ids)
        steps.append(
            f"r{n} AS MATERIALIZED (SELECT row_id, regexp_replace(left_over, '{seq}', '|', 'g') AS left_over, "
            f"CASE WHEN regexp_matches(left_over, '{seq}') THEN list_append(found, '{name}') ELSE found END AS found FROM {last})"
        )
        last = f"r{n}"
    silent = ", ".join(f"'{x}'" for x in licences.ALL_SILENT)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT row_id, regexp_replace(regexp_replace(text, '(?i)\\b(v)\\.[\\x20\\x09]+([0-9])', '\\1 \\2', 'g'),
                 '{licences.SPDX_TAG}', chr(10) || chr(10) || '\\1' || chr(10) || chr(10), 'g') AS text
          FROM docs WHERE regexp_matches(lower(text), '{likely}')),
parts AS (SELECT row_id, generate_subscripts(p, 1) AS no, unnest(p) AS s0
          FROM (SELECT row_id, string_split_regex(text, '{licences.SENTENCE_END}') AS p FROM lines)),
clean AS (SELECT row_id, no, s0, {clean} AS s FROM parts WHERE regexp_matches(lower(s0), '{likely}')),
listed AS (SELECT row_id, no, CASE WHEN regexp_matches(s0, '{licences.SPDX_TAG}')
             THEN list_filter(list_transform(string_split_regex({bare}, '{licences.SPDX_PARTS}'), lambda w: {named}), lambda x: x IS NOT NULL)
             ELSE [{known}] END AS ids, regexp_matches(s0, '{licences.SPDX_TAG}') AS tag FROM clean),
known AS (SELECT * FROM (SELECT row_id, no, generate_subscripts(i, 1) AS k, unnest(i) AS id
          FROM (SELECT row_id, no, CASE WHEN tag AND len(ids) = 0 THEN ['SPDX'] ELSE ids END AS i FROM listed)) WHERE id IS NOT NULL),
sequences AS (SELECT row_id, coalesce(string_agg(',' || id || ',', '' ORDER BY no, k) FILTER (WHERE id NOT IN ({silent})), '') AS left_over,
              coalesce(list(substr(id, 6)) FILTER (WHERE contains(id, ' WITH ')), []) AS found FROM known GROUP BY row_id),
{", ".join(steps)},
named AS (SELECT row_id, list_sort(list_distinct(found)) AS names FROM {last}),
ids AS (SELECT row_id, string_agg(id, ',' ORDER BY no, k) AS ids, count(*) AS n, count(*) FILTER (WHERE id = '?') AS u FROM known GROUP BY row_id)
SELECT doc_id, coalesce(ids, '') AS sentence_ids, coalesce(array_to_string(names, ','), '') AS licences, coalesce(n, 0) AS n_sentences,
       coalesce(u, 0) AS n_unknown,
       CASE WHEN n IS NULL THEN 'none' WHEN len(names) = 0 THEN 'unknown' WHEN len(names) = 1 THEN 'single' ELSE 'several' END AS verdict
FROM docs LEFT JOIN ids USING (row_id) LEFT JOIN named USING (row_id)
"""


@query("op1_licence_scan", _licence_sql())
def op1_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.licence_scan(table(spark, folder, "documents"))
