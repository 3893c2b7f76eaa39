"""Queries over operators that use DataFrame functions only."""

from __future__ import annotations

from ledgerlark.llm.line_dedup import remove_spread_lines
from ledgerlark.llm.pseudonyms import KINDS, pseudonymise_texts
from ledgerlark.llm.registry import query, table
from ledgerlark.llm.sharding import place

SHARDS = [f"shard-{i:02d}" for i in range(64)]
TABLE_SIZE = 8191
MIN_SITES = 10
#: The queries' key; a deployment passes a column that reads its secret.
KEY = "ledgerlark-demo-key"


@query("op1_sharding")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return place(docs, "doc_id", SHARDS, TABLE_SIZE).select("doc_id", "source", "n_chars", "slot", "shard", "shard_name")


OP7_SQL = f"""
WITH listed AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
           FROM documents),
judged AS (SELECT doc_id, source, line, i, trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS t FROM listed),
pages AS (SELECT doc_id, list_sort(list_distinct(list(t) FILTER (t <> ''))) AS page FROM judged GROUP BY 1),
sites AS (SELECT t, page, min(source) AS source FROM judged JOIN pages USING (doc_id) WHERE t <> '' GROUP BY 1, 2),
spread AS (SELECT t FROM sites GROUP BY 1 HAVING count(DISTINCT source) >= {MIN_SITES}),
marked AS (SELECT j.*, s.t IS NOT NULL AS gone FROM judged j LEFT JOIN spread s ON j.t = s.t),
sums AS (SELECT doc_id, count(*) FILTER (t <> '') AS n_lines, count(*) FILTER (gone) AS n_gone,
           coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS cleaned
         FROM marked GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN n_gone > 0 THEN cleaned ELSE d.text END AS text,
  CAST(coalesce(n_lines, 0) AS INT) AS n_lines, CAST(coalesce(n_gone, 0) AS INT) AS n_removed
FROM documents d LEFT JOIN sums USING (doc_id)"""


@query("op7_line_dedup", OP7_SQL)
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return remove_spread_lines(docs, MIN_SITES).select("doc_id", "text", "n_lines", "n_removed")


@query("op8_pii_pseudonyms")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise_texts(docs, KEY).select("doc_id", "text", *[f"n_{k}" for k in KINDS])
