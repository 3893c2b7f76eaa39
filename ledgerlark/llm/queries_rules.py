"""Queries over the line rules, the secret scan and the benchmark search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.llm.decontaminate import find_passages
from ledgerlark.llm.line_rules import host_line_rules
from ledgerlark.llm.near_dup import near_duplicates
from ledgerlark.llm.registry import query, table
from ledgerlark.llm.secret_scan import scan

MAX_DOCS = 20

OP2_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
win AS (SELECT doc_id, i, words[i:i + 4] AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY 1),
raw AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d),
filled AS (SELECT *, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS w FROM raw
           WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM filled GROUP BY 1),
formed AS (SELECT doc_id, source, len(w) AS words, translate(array_to_string(w, ' '),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000') AS form FROM filled),
freq AS (SELECT source, form FROM formed GROUP BY 1, 2 HAVING count(DISTINCT doc_id) > {MAX_DOCS}),
gone AS (SELECT doc_id, CAST(sum(words) AS BIGINT) AS n, count(DISTINCT form) AS n_lines
         FROM formed JOIN freq USING (source, form) GROUP BY 1),
base AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM d),
j AS (SELECT base.*, coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    n_words - coalesce(gone.n, 0) AS words_left, coalesce(gone.n_lines, 0) AS n_frequent_lines
  FROM base LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
    AND words_left >= 10 AND 2 * (n_words - words_left) <= n_words AS kept, words_left, n_frequent_lines
FROM j"""


@query("op2_quality_rules", OP2_SQL)
def op2(spark, sf_dir):
    judged = host_line_rules(table(spark, sf_dir, "documents"), MAX_DOCS)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & ~F.col("depleted")).alias("kept"), "words_left", "n_frequent_lines")


@query("op4_secret_scan")
def op4(spark, sf_dir):
    found = scan(table(spark, sf_dir, "documents"), ["doc_id"])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds):
        return F.filter("secrets", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(listed(of("assign", "access", "hex")), 256).alias("base_sha256"),
                        listed(F.col("secrets")).alias("spans"))


OP6_SQL = """
WITH b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT item_id, w[i:i + 12] AS w, least(len(w), 13) AS n FROM (
    SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
hits AS (SELECT p.doc_id, p.i, win.n, win.item_id FROM p JOIN win ON p.w[p.i] = win.w[1] AND p.w[p.i:p.i + win.n - 1] = win.w),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query("op6_decontamination", OP6_SQL)
def op6(spark, sf_dir):
    found = find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), "contaminated")


OP3_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i:i + 1] AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id
    GROUP BY 1, 2) p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id, n"""


@query("op3_near_duplicates", OP3_SQL)
def op3(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), size=2)
