"""The queries of the operators in this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import bpe, chat, decontaminate, extract, language, near, nearest, quality, repair, spelling, substrings, vectors, warc
from slotwise.plans.registry import query, table


def _words_sql(text: str, outside: str) -> str:
    """DuckDB: the list of words of a text, `outside` being a class of separating characters."""
    return f"regexp_extract_all(coalesce({text}, ''), '[^{outside}]+')"


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BLANK = r"\x20\x09-\x0D"
MARKS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"

OP7_SQL = f"""
WITH d AS (SELECT doc_id, {_words_sql(LOWER.format('text'), MARKS)} AS w FROM documents),
b AS (SELECT item_id, {_words_sql(LOWER.format('text'), MARKS)} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS win, least(13, len(w)) AS n
  FROM (SELECT *, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, s, dw.n, item FROM dw JOIN bw USING (win) WHERE dw.n = bw.n),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query("op7_decontaminate", OP7_SQL)
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


OP1_SQL = f"""
WITH d AS (SELECT doc_id, {_words_sql('text', BLANK)} AS w FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS t
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS s FROM d WHERE len(w) >= 20)),
dup AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + 19)) AS p FROM dup),
word AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS k, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query("op1_substring_dedup", OP1_SQL)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return done.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


# Links by exact counts of shared shingles; components by a recursive walk along the links.
OP6_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words_sql(LOWER.format('text'), BLANK)} AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 2], ' ') AS t
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b USING (t) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
walk(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT walk.a, link.b FROM walk JOIN link ON walk.b = link.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM walk GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@query("op6_minhash_near_dedup", OP6_SQL)
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_groups(table(spark, sf_dir, "documents"), size=3, percent=85)


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def _fold(folds: int) -> Column:
    """The fold of a document; a null doc_id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identified(docs, language.fit(docs, _fold(4) != 2))
    return found.select("doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", "score")


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = quality.fit(docs, table(spark, sf_dir, "labels"), _fold(5) != 0)
    return quality.scored(docs, field).select(
        "doc_id", (_fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query("op8_html_extraction")
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.extracted(table(spark, sf_dir, "pages"))
    return found.select(
        F.col("row.page_id").alias("page_id"), F.col("row.url").alias("url"), F.col("main_text").alias("text"),
        F.char_length("main_text").cast("long").alias("n_chars"),
    )


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, h, min(page_id) OVER (PARTITION BY h) AS first FROM p),
b AS (SELECT page_id, strlen(h) AS payload_bytes, unhex(sha1(h)) AS d, first FROM q),
bits AS (SELECT page_id, string_agg(bin, '' ORDER BY i) AS s FROM (
  SELECT page_id, i, right('00000000' || bin(('0x' || substr(hex(d), 2 * i + 1, 2))::INT), 8) AS bin
  FROM b, generate_series(0, 19) AS g(i)) GROUP BY page_id),
base AS (SELECT page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + 16 * substr(s, 5 * j + 1, 1)::INT + 8 * substr(s, 5 * j + 2, 1)::INT + 4 * substr(s, 5 * j + 3, 1)::INT
  + 2 * substr(s, 5 * j + 4, 1)::INT + substr(s, 5 * j + 5, 1)::INT, 1), '' ORDER BY j) AS payload_digest
  FROM bits, generate_series(0, 31) AS g(j) GROUP BY page_id)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM b JOIN base USING (page_id)
"""


@query("op10_warc", OP10_SQL)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


@query("op5_exact_top_k", OP5_SQL)
def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


OP2_SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM t),
f AS (
  SELECT conv_id, row_number() OVER (PARTITION BY role, text ORDER BY conv_id) AS k,
    lead(conv_id) OVER (PARTITION BY role, text ORDER BY conv_id) AS partner
  FROM n WHERE i = 1),
p AS (SELECT conv_id AS chosen_id, partner AS rejected_id FROM f WHERE k % 2 = 1),
size AS (SELECT conv_id, count(*) AS c, min(CASE WHEN role = 'assistant' THEN i END) AS a FROM n GROUP BY conv_id),
same AS (
  SELECT chosen_id, min(CASE WHEN y.i IS NULL OR x.role <> y.role OR x.text <> y.text THEN x.i END) AS d
  FROM p JOIN n x ON x.conv_id = chosen_id LEFT JOIN n y ON y.conv_id = rejected_id AND y.i = x.i GROUP BY chosen_id),
m AS (
  SELECT p.*, CASE WHEN rejected_id IS NULL THEN coalesce(a - 1, c) ELSE coalesce(d - 1, c) END AS n_common
  FROM p JOIN size ON conv_id = chosen_id JOIN same USING (chosen_id)),
r AS (
  SELECT conv_id, i, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS s,
    '0:' || (length(role) + 5) || ',' || CASE WHEN role = 'assistant' THEN '1:' ELSE '0:' END || (length(text) + 8) AS k
  FROM n),
c AS (
  SELECT chosen_id, coalesce(string_agg(s, '' ORDER BY i) FILTER (i <= n_common), '') AS prompt,
    coalesce(string_agg(s, '' ORDER BY i) FILTER (i > n_common), '') AS s, coalesce(string_agg(k, ',' ORDER BY i) FILTER (i > n_common), '') AS k
  FROM m JOIN r ON conv_id = chosen_id GROUP BY chosen_id),
j AS (
  SELECT chosen_id, coalesce(string_agg(s, '' ORDER BY i) FILTER (i > n_common), '') AS s,
    coalesce(string_agg(k, ',' ORDER BY i) FILTER (i > n_common), '') AS k
  FROM m JOIN r ON conv_id = rejected_id GROUP BY chosen_id)
SELECT chosen_id, rejected_id, n_common::INT AS n_common, prompt, c.s AS chosen_completion, c.k AS chosen_mask,
  j.s AS rejected_completion, j.k AS rejected_mask
FROM m JOIN c USING (chosen_id) LEFT JOIN j USING (chosen_id)
"""


@query("op2_preference_format", OP2_SQL)
def op2_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(chat.preference_pairs(table(spark, sf_dir, "conversations"))).drop("chosen", "rejected")


def _crc_sql(text: str) -> str:
    """DuckDB: the unsigned crc32 of a string's UTF-8 bytes."""
    table = range(256)
    for _ in range(8):
        table = [(x >> 1) ^ (0xEDB88320 if x & 1 else 0) for x in table]
    return (
        f"xor(4294967295::BIGINT, list_reduce(list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT), "
        f"lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1]), 4294967295::BIGINT))"
    )


def _plus(way: str, cost: str, edits: str) -> str:
    """DuckDB: a way (ten digits of cost, then its audit) with further edits."""
    return f"lpad((substr({way}, 1, 10)::BIGINT + {cost})::VARCHAR, 10, '0') || substr({way}, 11) || {edits}"


def _step_sql() -> str:
    """DuckDB: the best ways to the four states of the grammar after one more turn w, which is
    [role's initial, must be deleted, truncated]. At most one insert goes before a turn."""
    gone = [_plus(f"a[{k}]", "3", "'D'") for k in (1, 2, 3, 4)]
    cut = "w[3]::BIGINT"
    to = {}
    for initial, before, other in (("u", (1, 2, 4), (3,)), ("a", (3,), (1, 2, 4))):
        cost, edit = f"{cut} + CASE w[1] WHEN '{initial}' THEN 0 ELSE 2 END", f"CASE w[1] WHEN '{initial}' THEN 'K' ELSE 'R' END"
        straight = [_plus(f"a[{k}]", cost, edit) for k in before]
        after_insert = [_plus(f"a[{k}]", f"2 + {cost}", f"'I' || {edit}") for k in other]
        to[initial] = ", ".join(straight + after_insert)
    system = f"CASE w[1] WHEN 's' THEN {_plus('a[1]', cut, chr(39) + 'K' + chr(39))} ELSE '5000000000' END"
    free = f"[{gone[0]}, least({gone[1]}, {system}), least({gone[2]}, {to['u']}), least({gone[3]}, {to['a']})]"
    return f"CASE w[2] WHEN '1' THEN [{', '.join(gone)}] ELSE {free} END"


OP11_SQL = f"""
WITH k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT * FROM k UNION ALL SELECT * FROM k WHERE k = 3) WHERE k <> 0),
r AS (
  SELECT *, left(role, 1) AS c, NOT regexp_matches(text, '[^{BLANK}]') AS blank, NOT regexp_matches(text, '[.!?][{BLANK}]*$') AS cut,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS i
  FROM d),
n AS (
  SELECT *, lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c NOT IN ('su', 'ua', 'au') AS odd,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM r),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT blank AND NOT again) AS truncated,
    count(*) FILTER (odd) AS illegal, list([c, (blank OR again)::INT::VARCHAR, cut::INT::VARCHAR, ''] ORDER BY i) AS ws
  FROM n GROUP BY conv_id),
s AS (
  SELECT *, list_reduce(ws, lambda a, w: {_step_sql()}, ['0000000000', '5000000000', '5000000000', '5000000000']) AS a FROM g),
b AS (SELECT *, least(a[1], a[4], {_plus('a[2]', '4', "'II'")}, {_plus('a[3]', '2', "'I'")}) AS best FROM s),
e AS (
  SELECT conv_id, p, edit, sum((edit <> 'I')::INT) OVER o AS i, sum((edit <> 'D')::INT) OVER o AS j
  FROM (SELECT conv_id, unnest(generate_series(1, length(best) - 10)) AS p, substr(best, 10 + p, 1) AS edit FROM b)
  WINDOW o AS (PARTITION BY conv_id ORDER BY p)),
t AS (
  SELECT e.conv_id, p, edit, j, r.role, CASE edit WHEN 'I' THEN '' ELSE r.text END AS text,
    max((edit = 'K' AND r.c = 's')::INT) OVER (PARTITION BY e.conv_id) AS shift
  FROM e LEFT JOIN r ON e.conv_id IS NOT DISTINCT FROM r.conv_id AND e.i = r.i WHERE edit <> 'D'),
h AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (j - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p) AS said
  FROM t GROUP BY conv_id)
SELECT x.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(substr(best, 1, 10)::BIGINT, 0) AS cost, coalesce(substr(best, 11), '') AS audit,
  sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) x LEFT JOIN b ON x.conv_id IS NOT DISTINCT FROM b.conv_id
  LEFT JOIN h ON x.conv_id IS NOT DISTINCT FROM h.conv_id
"""


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with the faults of op11: by the remainder of a crc32 dropped, emptied, robbed of their
    full stops, repeated or given to the user."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(key) % 20).alias("fault")
    ).where("fault <> 0")
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return rows.withColumn("copy", F.explode(times)).select("conv_id", "turn", role.alias("role"), text.alias("text"))


@query("op11_structure_repair", OP11_SQL)
def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    rows, found = repair.repairs(damaged(turns))
    return repair.report(turns, found, repair.repaired(rows, found))


@query("op12_nearest_neighbours")
def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


OP13_SQL = f"""
WITH RECURSIVE w AS (
  SELECT d, {LOWER.format('r')} AS w FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) AS r FROM documents)
  WHERE length(r) >= 6),
x AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word
  FROM (SELECT w, {_crc_sql("d || ':' || w")} AS h FROM w)),
v AS (SELECT word, count(*) AS n FROM x WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
cut AS (
  SELECT word, n, length(word) AS size, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT *, unnest(generate_series(1, length(word))) AS i FROM v)),
e AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b USING (rest, i) WHERE a.size = b.size AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN v b ON a.rest = b.word),
best AS (SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k FROM e),
f AS (
  SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
  FROM v LEFT JOIN best ON v.word = best.word AND k = 1),
walk(word, root) AS (SELECT word, word FROM f UNION ALL SELECT walk.word, form FROM walk JOIN f ON walk.root = f.word WHERE form IS NOT NULL),
roots AS (SELECT walk.word, root FROM walk JOIN f ON walk.root = f.word WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN roots USING (word)
"""


def misspelt(docs: DataFrame, length: int = 6) -> DataFrame:
    """(word): the runs of letters of all texts; where 199 divides the crc32 of `doc_id:run`, the
    run loses one letter."""
    words = spelling.runs(docs, length)
    code = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "word"))
    at = (code % F.char_length("word")).cast("int")
    return words.select(F.when(code % 199 == 0, spelling.without_letter(F.col("word"), at)).otherwise(F.col("word")).alias("word"))


@query("op13_spelling_variants", OP13_SQL)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(misspelt(table(spark, sf_dir, "documents"))))
