"""Queries over exact copies, periodic runs and conversation repair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.exact_dup import mark_copies
from ledgerlark.llm.periodic_runs import find_runs
from ledgerlark.llm.registry import query, table
from ledgerlark.llm.turn_repair import digests, repair

OP11_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)"""


@query("op11_exact_copies", OP11_SQL)
def op11(spark, sf_dir):
    return mark_copies(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])


def crc_sql(text: str) -> str:
    """CRC-32 of an ASCII text, a bit at a time."""
    return f"""xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''),
    lambda c: ascii(c)::BIGINT)), lambda r, c: list_reduce(list_concat([xor(r, c)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"""


OP12_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {crc_sql("doc_id::VARCHAR")} AS h FROM documents),
p AS (SELECT *, (h // 10) % len(w) AS a, CAST(1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) AS BIGINT) AS p
      FROM d WHERE h % 10 = 0 AND len(w) > 0),
x AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS i FROM d WHERE h % 10 <> 0
      UNION ALL SELECT doc_id, w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1], i
      FROM (SELECT *, unnest(range(len(w))) AS i FROM p)),
eq AS (SELECT a.doc_id, b.i - a.i AS q, a.i FROM x a JOIN x b ON a.doc_id = b.doc_id AND a.w = b.w AND a.i < b.i),
isles AS (SELECT doc_id, q, min(i) AS s, count(*) AS n
          FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM eq) GROUP BY doc_id, q, g),
runs AS (SELECT doc_id, s, n + q AS n, min(q) AS q FROM isles WHERE n >= q AND n + q >= 12 GROUP BY ALL),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + n)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t FROM x ANTI JOIN gone USING (doc_id, i) GROUP BY 1),
r AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS t,
      first({{'s': s, 'n': n, 'q': q}} ORDER BY n DESC, s, q) AS best FROM runs GROUP BY 1)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start, best.n AS length, CAST(best.q AS BIGINT) AS period,
  CAST(1000 * best.n // best.q AS BIGINT) AS exponent_milli, sha256(coalesce(r.t, '')) AS runs_sha256,
  sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def planted(docs: DataFrame) -> DataFrame:
    """One document of ten, told by its id, with its words from a place on replaced by repeats of the first of them."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    found = docs.withColumns({"h": h, "w": F.when(h % 10 == 0, F.expr(r"regexp_extract_all(text, r'[^\x20\x09-\x0D]+', 0)"))})
    sized = found.withColumns({"g": F.floor(F.col("h") / 10), "n": F.size("w")})
    placed = sized.withColumn("a", F.expr("CASE WHEN n > 0 THEN CAST(g % n AS INT) END"))
    stepped = placed.withColumn("p", F.expr("CASE WHEN n > 0 THEN CAST(1 + floor((n - a) / (3 + g % 8)) AS INT) END"))
    again = F.expr("""array_join(concat(slice(w, 1, a),
        slice(flatten(array_repeat(slice(w, a + 1, p), CAST(ceil((n - a) / p) AS INT))), 1, n - a)), ' ')""")
    return stepped.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs", OP12_SQL)
def op12(spark, sf_dir):
    found = find_runs(planted(table(spark, sf_dir, "documents").select("doc_id", "text")), ["doc_id"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("least"), r["start"].alias("start"), r["period"].alias("period"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.least")).alias("length"),
        F.col("best.period").alias("period"), F.expr("(1000 * -best.least) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """Turns dropped, emptied, cut, repeated or given to the user, one in twenty each, told by their conversation and number."""
    told = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    h = F.crc32(told.cast("binary")) % 20
    plain = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), h.alias("h"))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return plain.filter("h <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy"))


OP13_SQL = f"""
WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS h FROM conversations),
bad AS (SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE h WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM src WHERE h <> 0),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS k,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM bad),
f AS (SELECT *, left(role, 1) AS ini, CASE WHEN t = '' THEN 'blank' WHEN k > 1 THEN 'duplicate'
    WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS ini2 FROM num),
moves(p, x, q) AS (VALUES ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')),
ins AS (SELECT p, p AS m, '' AS a, []::VARCHAR[] AS out FROM (VALUES ('0'), ('s'), ('u'), ('a')) v(p)
  UNION ALL SELECT p, q, 'I', [CASE x WHEN 'u' THEN 'user:' ELSE 'assistant:' END] FROM moves WHERE x <> 's'
  UNION ALL SELECT p, 'a', 'II', ['user:', 'assistant:'] FROM moves WHERE x = 'u'),
step AS (SELECT conv_id, i, p, q, cost, a, out FROM (
  SELECT conv_id, i, ins.p, m AS q, 3 * length(a) + 4 AS cost, a || 'D' AS a, out FROM f, ins
  UNION ALL SELECT conv_id, i, ins.p, CASE WHEN ini = '' THEN m ELSE moves.q END, 3 * length(a) + 3 * CAST(fault = 'truncated' AS INT),
    a || 'K', out || [role || ':' || text] FROM f, ins LEFT JOIN moves ON moves.p = m
    WHERE fault NOT IN ('blank', 'duplicate') AND (moves.x = ini OR ini = '')
  UNION ALL SELECT conv_id, i, ins.p, moves.q, 3 * length(a) + 3 + 3 * CAST(fault = 'truncated' AS INT),
    a || 'R', out || [CASE x WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text] FROM f, ins JOIN moves ON moves.p = m AND x <> 's'
    WHERE fault NOT IN ('blank', 'duplicate'))
  QUALIFY row_number() OVER (PARTITION BY conv_id, i, p, q ORDER BY cost, a) = 1),
dp AS (SELECT conv_id, 0::BIGINT AS i, '0' AS p, 0::BIGINT AS cost, '' AS a, []::VARCHAR[] AS out FROM f GROUP BY conv_id
  UNION ALL SELECT dp.conv_id, dp.i + 1, s.q, dp.cost + s.cost, dp.a || s.a, dp.out || s.out
  FROM dp JOIN step s ON s.conv_id IS NOT DISTINCT FROM dp.conv_id AND s.i = dp.i + 1 AND s.p = dp.p
  QUALIFY row_number() OVER (PARTITION BY dp.conv_id, s.q ORDER BY dp.cost + s.cost, dp.a || s.a) = 1),
best AS (SELECT dp.conv_id, cost + 3 * length(ins.a) AS cost, dp.a || ins.a AS audit, dp.out || ins.out AS out
  FROM dp JOIN (SELECT conv_id, max(i) AS n FROM f GROUP BY 1) z ON z.conv_id IS NOT DISTINCT FROM dp.conv_id AND z.n = dp.i
  JOIN ins ON ins.p = dp.p AND ins.m IN ('0', 'a')
  QUALIFY row_number() OVER (PARTITION BY dp.conv_id ORDER BY cost + 3 * length(ins.a), dp.a || ins.a) = 1),
st AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (ini2 IS NOT NULL AND ini || ini2 NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(out, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN st ON st.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id"""


@query("op13_conversation_repair", OP13_SQL)
def op13(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    fixed = repair(damaged(rows))
    hashes = digests(fixed.turns)
    every = rows.select(F.col("conv_id").alias("id")).distinct()
    joined = every.join(fixed.conversations, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id").join(
        hashes, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(n, F.lit(0)).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(F.col("id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
