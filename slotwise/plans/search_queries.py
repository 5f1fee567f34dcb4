"""Queries over documents: filters, ranking, aggregations, statistics, suggestions."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from slotwise.functions.skew import spread
from slotwise.operators import buckets, changes, filters, ordering, routing, search
from slotwise.operators.term_index import TermIndex, build_index
from slotwise.plans.registry import cents, ms, query, table
from slotwise.session import scratch_dir, stored

TOK = r"regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')"
ASKED = "with from les"


def bm25(terms: str, partition: str = "") -> str:
    """SQL for the scored documents `hits(doc_id, lang, source, n_chars, score)`."""
    words = ", ".join(f"'{t}'" for t in terms.split())
    over = f"PARTITION BY {partition}" if partition else ""
    shard = f"AND n.{partition} IS NOT DISTINCT FROM d.{partition}" if partition else ""
    group = f"{partition}, " if partition else ""
    return f"""
    tok AS (SELECT doc_id, source, unnest({TOK}) AS term FROM documents),
    words AS (SELECT doc_id, source, term FROM tok WHERE term <> ''),
    dl AS (SELECT d.doc_id, d.source, d.lang, d.n_chars, count(w.term) AS len
           FROM documents d LEFT JOIN words w ON w.doc_id = d.doc_id GROUP BY ALL),
    n AS (SELECT {group} count(*) FILTER (len > 0) AS n, sum(len) AS total FROM dl {f"GROUP BY {partition}" if partition else ""}),
    tf AS (SELECT doc_id, source, term, count(*) AS tf FROM words WHERE term IN ({words}) GROUP BY ALL),
    df AS (SELECT *, count(*) OVER (PARTITION BY term {", " + partition if partition else ""}) AS df FROM tf),
    hits AS (
        SELECT d.doc_id, d.lang, d.source, d.n_chars,
               round(sum(ln(1 + (n.n - df.df + 0.5::DOUBLE) / (df.df + 0.5::DOUBLE)) * df.tf * 2.2::DOUBLE
                   / (df.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * d.len / (n.total / n.n)))), 6) AS score
        FROM df JOIN dl d ON d.doc_id = df.doc_id JOIN n ON true {shard}
        GROUP BY ALL)
    """


def _docs(spark, sf):
    return table(spark, sf, "documents")


def _texts(spark, sf):
    """Documents for work on their whole text."""
    return spread(table(spark, sf, "documents"))


def _scored(spark, sf, shard=None):
    return search.match_score(_texts(spark, sf), "text", ASKED, shard).withColumnRenamed("_score", "score")


@query(
    "query_filter",
    f"""
    WITH d AS (SELECT *, {TOK} AS tok FROM documents)
    SELECT doc_id, lang, source, n_chars FROM d
    WHERE list_has_any(tok, ['with', 'from', 'les']) AND lang IN ('en', 'fr') AND n_chars >= 200
      AND n_chars < 20000 AND source IS NOT NULL AND NOT source = 'src3'
    """,
)
def _query_filter(spark, sf):
    spec = {
        "bool": {
            "must": {"match": {"text": ASKED}},
            "filter": [
                {"terms": {"lang": ["en", "fr"]}},
                {"range": {"n_chars": {"gte": 200, "lt": 20000}}},
                {"exists": {"field": "source"}},
            ],
            "must_not": {"term": {"source": "src3"}},
        }
    }
    return _texts(spark, sf).filter(filters.query_filter(spec)).select("doc_id", "lang", "source", "n_chars")


@query(
    "post_filter",
    """
    SELECT 'hit' AS part, doc_id, lang, NULL::BIGINT AS doc_count FROM documents WHERE n_chars >= 500 AND lang = 'de'
    UNION ALL
    SELECT 'bucket', NULL, lang, count(*) FROM documents WHERE n_chars >= 500 GROUP BY lang
    """,
)
def _post_filter(spark, sf):
    matching = _docs(spark, sf).filter("n_chars >= 500")
    hits, whole = filters.post_filter(matching, F.col("lang") == "de")
    hits = hits.select(F.lit("hit").alias("part"), "doc_id", "lang", F.lit(None).cast("bigint").alias("doc_count"))
    per_lang = buckets.terms(whole, "lang", size=None)
    return hits.unionByName(
        per_lang.select(
            F.lit("bucket").alias("part"), F.lit(None).cast("bigint").alias("doc_id"), F.col("bucket").alias("lang"), "doc_count"
        )
    )


@query("match_score", f"WITH {bm25(ASKED)} SELECT doc_id, score FROM hits")
def _match_score(spark, sf):
    return _scored(spark, sf).select("doc_id", "score")


@query("match_score_slot", f"WITH {bm25(ASKED, 'source')} SELECT doc_id, source, score FROM hits")
def _match_score_slot(spark, sf):
    return _scored(spark, sf, "source").select("doc_id", "source", "score")


@query("min_score", f"WITH {bm25(ASKED)} SELECT doc_id, score FROM hits WHERE score >= 1.5")
def _min_score(spark, sf):
    return filters.min_score(_scored(spark, sf), 1.5, "score").select("doc_id", "score")


@query("top_docs", f"WITH {bm25(ASKED)} SELECT doc_id, score FROM hits ORDER BY score DESC, doc_id LIMIT 20 OFFSET 10")
def _top_docs(spark, sf):
    scored = _scored(spark, sf).select("doc_id", "score")
    return ordering.top_docs(scored, ordering.by_score("doc_id", "score"), size=20, from_=10)


@query(
    "fetch_hits",
    f"""WITH {bm25(ASKED)}, top AS (SELECT doc_id, score FROM hits ORDER BY score DESC, doc_id LIMIT 25)
    SELECT d.doc_id, d.text, d.lang, top.score FROM top JOIN documents d ON d.doc_id = top.doc_id""",
)
def _fetch_hits(spark, sf):
    scored = _scored(spark, sf).select("doc_id", "score")
    top = ordering.top_docs(scored, ordering.by_score("doc_id", "score"), size=25)
    return search.fetch_hits(_docs(spark, sf), top, "doc_id").select("doc_id", "text", "lang", "score")


@query(
    "boost_tables",
    f"""WITH {bm25(ASKED)}
    SELECT doc_id, lang, score * CASE lang WHEN 'fr' THEN 2.0::DOUBLE WHEN 'de' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS score FROM hits""",
)
def _boost_tables(spark, sf):
    tagged = _scored(spark, sf).withColumn("_table", F.concat(F.lit("docs_"), "lang"))
    boosts = [("docs_fr", 2.0), ("docs_de", 0.5), ("docs_fr", 9.0)]
    return search.boost_tables(tagged, boosts, "score").select("doc_id", "lang", "score")


@query(
    "hit_stats",
    f"""WITH {bm25(ASKED)}
    SELECT count(*) AS total_hits, greatest(0, least(10, count(*) - 5))::BIGINT AS fetched_hits, max(score) AS max_score FROM hits""",
)
def _hit_stats(spark, sf):
    return search.hit_stats(_scored(spark, sf), "score", from_=5, size=10)


@query(
    "source_fields",
    "SELECT doc_id, source, n_chars FROM documents",
)
def _source_fields(spark, sf):
    return filters.source_fields(_docs(spark, sf), ["doc_*", "source", "n_chars", "lang"], ["la*"])


@query(
    "doc_value_fields",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderstatus FROM orders""",
)
def _doc_value_fields(spark, sf):
    return filters.doc_value_fields(
        table(spark, sf, "orders"), [("o_orderdate", "yyyy-MM-dd"), ("o_orderstatus", None)], keep=["o_orderkey"]
    )


@query(
    "script_fields",
    """SELECT o_orderkey, o_totalprice / 1000 AS price_k, o_orderstatus || '-' || o_orderpriority AS tag FROM orders""",
)
def _script_fields(spark, sf):
    out = filters.script_fields(
        table(spark, sf, "orders"),
        {"price_k": "o_totalprice / 1000", "tag": "concat(o_orderstatus, '-', o_orderpriority)"},
    )
    return out.select("o_orderkey", "price_k", "tag")


# ---------------------------------------------------------------------------------------
# Order and paging


@query("sort_by", "SELECT doc_id, lang, n_chars FROM documents ORDER BY lang, n_chars DESC, doc_id")
def _sort_by(spark, sf):
    return ordering.sort_by(_docs(spark, sf).select("doc_id", "lang", "n_chars"), "lang,n_chars:desc", "doc_id")


@query(
    "search_after",
    """
    SELECT doc_id, lang, n_chars FROM documents
    WHERE lang > 'en' OR (lang = 'en' AND n_chars < 600) OR (lang = 'en' AND n_chars = 600 AND doc_id > 100)
    ORDER BY lang, n_chars DESC, doc_id LIMIT 50
    """,
)
def _search_after(spark, sf):
    docs = _docs(spark, sf).select("doc_id", "lang", "n_chars")
    return ordering.search_after(docs, "lang:asc,n_chars:desc", "doc_id", ["en", 600, 100], 50)


@query(
    "scroll_pages",
    """
    WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS pos FROM orders)
    SELECT o_orderkey, pos, pos // 1000 AS page FROM p
    """,
)
def _scroll_pages(spark, sf):
    from slotwise.session import scratch_dir, stored

    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    pages = ordering.scroll_pages(
        spark, orders, "o_totalprice:desc", "o_orderkey", 1000, scratch_dir(spark, "scroll")
    )
    return pages.select("o_orderkey", F.col("_pos").alias("pos"), F.col("_page").alias("page"))


@query(
    "collapse",
    """
    SELECT doc_id, source, n_chars FROM documents
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) = 1
    """,
)
def _collapse(spark, sf):
    docs = _docs(spark, sf).select("doc_id", "source", "n_chars")
    return ordering.collapse(docs, "source", ordering.sort_columns([("n_chars", False)], "doc_id"))


@query(
    "expand_collapsed",
    """
    WITH h AS (SELECT doc_id, lang, n_chars FROM documents
               QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) = 1),
    r AS (SELECT doc_id, lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) AS pos FROM documents)
    SELECT h.doc_id, h.lang, r.pos - 2 AS pos, r.doc_id AS inner_id, r.n_chars AS inner_chars
    FROM h JOIN r ON r.lang = h.lang AND r.pos > 1 AND r.pos <= 6
    """,
)
def _expand_collapsed(spark, sf):
    docs = _docs(spark, sf).select("doc_id", "lang", "n_chars")
    best = ordering.sort_columns([("n_chars", False)], "doc_id")
    hits = ordering.top_docs(ordering.collapse(docs, "lang", best), best, size=10)
    shortest = search.InnerHits("shortest", size=5, from_=1, sort="n_chars:asc", fields=("doc_id", "n_chars"))
    out = search.expand_collapsed(hits, docs, "lang", "doc_id", [shortest])
    return out.select("doc_id", "lang", F.posexplode("shortest").alias("pos", "inner")).select(
        "doc_id", "lang", F.col("pos").cast("bigint").alias("pos"),
        F.col("inner.doc_id").alias("inner_id"), F.col("inner.n_chars").alias("inner_chars"),
    )


@query(
    "terminate_after",
    """
    SELECT doc_id, source FROM documents
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 20
    """,
)
def _terminate_after(spark, sf):
    return ordering.terminate_after(_docs(spark, sf).select("doc_id", "source"), "source", "doc_id", 20)


@query(
    "rescore",
    f"""WITH {bm25(ASKED)},
    r AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS pos FROM hits)
    SELECT r.doc_id, pos <= 50 AS rescored,
           round(r.score + CASE WHEN pos <= 50 THEN coalesce(l.quality, 0) * 0.75::DOUBLE ELSE 0 END, 6) AS score
    FROM r LEFT JOIN labels l ON l.doc_id = r.doc_id""",
)
def _rescore(spark, sf):
    second = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("second_score"))
    hits = _scored(spark, sf).select("doc_id", "score")
    out = ordering.rescore(hits, second, "doc_id", window=50, weight=0.75, score="score")
    return out.select("doc_id", F.col("_rescored").alias("rescored"), F.round("score", 6).alias("score"))


# ---------------------------------------------------------------------------------------
# Aggregations


@query(
    "agg_search_terms",
    """
    SELECT o_orderpriority AS bucket, count(*) AS doc_count, count(o_totalprice) AS price_count,
           min(o_totalprice) AS price_min, max(o_totalprice) AS price_max,
           sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(o_totalprice) AS price_avg,
           sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS price_sum
    FROM orders GROUP BY 1 ORDER BY doc_count DESC, bucket LIMIT 3
    """,
)
def _agg_terms(spark, sf):
    metrics = buckets.stats_columns("o_totalprice", "price_")
    aggs = {"by_priority": ("terms", {"field": "o_orderpriority", "size": 3, "metrics": metrics})}
    return buckets.agg_search(table(spark, sf, "orders"), aggs)["by_priority"]


@query(
    "agg_search_stats",
    """
    SELECT count(l_extendedprice) AS count, min(l_extendedprice) AS min, max(l_extendedprice) AS max,
           sum(l_extendedprice::DECIMAL(18,2))::DOUBLE / count(l_extendedprice) AS avg,
           sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS sum
    FROM lineitem
    """,
)
def _agg_stats(spark, sf):
    return buckets.stats(table(spark, sf, "lineitem"), "l_extendedprice")


@query("agg_search_cardinality", "SELECT count(DISTINCT o_custkey) AS value FROM orders")
def _agg_cardinality(spark, sf):
    return buckets.cardinality(table(spark, sf, "orders"), "o_custkey", exact=True)


@query(
    "agg_search_cardinality_sketch",
    "SELECT count(DISTINCT o_custkey) AS counted, true AS within_error FROM orders",
)
def _agg_cardinality_sketch(spark, sf):
    """The exact count, and whether the sketch lies within three of its standard deviations."""
    orders = table(spark, sf, "orders")
    counted = buckets.cardinality(orders, "o_custkey", exact=True).scalar()
    sketch = buckets.cardinality(orders, "o_custkey", rsd=0.01).withColumn("counted", counted)
    error = F.abs(F.col("value") - F.col("counted"))
    return sketch.select("counted", (error <= 0.03 * F.col("counted")).alias("within_error"))


@query(
    "agg_search_percentiles",
    """
    WITH q AS (SELECT unnest([1.0, 5.0, 25.0, 50.0, 75.0, 95.0, 99.0])::DOUBLE AS percent),
    r AS (SELECT o_totalprice AS v, row_number() OVER (ORDER BY o_totalprice) AS pos, count(*) OVER () AS n FROM orders)
    SELECT q.percent, min(r.v) AS value FROM q JOIN r ON r.pos >= ceil(q.percent * r.n / 100) GROUP BY q.percent
    """,
)
def _agg_percentiles(spark, sf):
    return buckets.percentiles(table(spark, sf, "orders"), "o_totalprice")


@query(
    "agg_search_histogram",
    "SELECT floor(o_totalprice / 5000) * 5000 AS bucket, count(*) AS doc_count FROM orders GROUP BY 1",
)
def _agg_histogram(spark, sf):
    return buckets.histogram(table(spark, sf, "orders"), "o_totalprice", 5000)


@query(
    "agg_search_date_histogram",
    """
    SELECT epoch_ms(date_trunc('month', o_orderdate)) AS bucket_ms, count(*) AS doc_count,
           sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS price_sum
    FROM orders GROUP BY 1
    """,
)
def _agg_date_histogram(spark, sf):
    total = F.sum(cents("o_totalprice")).cast("double").alias("price_sum")
    out = buckets.date_histogram(table(spark, sf, "orders"), "o_orderdate", "month", [total])
    return out.select(ms(F.col("bucket")).alias("bucket_ms"), "doc_count", "price_sum")


@query(
    "agg_search_range",
    """
    SELECT '*-100000' AS bucket, count(*) AS doc_count FROM orders WHERE o_totalprice < 100000
    UNION ALL SELECT '50000-200000', count(*) FROM orders WHERE o_totalprice >= 50000 AND o_totalprice < 200000
    UNION ALL SELECT '200000-*', count(*) FROM orders WHERE o_totalprice >= 200000
    """,
)
def _agg_range(spark, sf):
    return buckets.ranges(table(spark, sf, "orders"), "o_totalprice", [(None, 100000), (50000, 200000), (200000, None)])


@query(
    "agg_search_filter",
    """SELECT count(*) AS doc_count, max(o_totalprice) AS price_max FROM orders WHERE o_orderstatus = 'F'""",
)
def _agg_filter(spark, sf):
    return buckets.filter_bucket(
        table(spark, sf, "orders"), F.col("o_orderstatus") == "F", [F.max("o_totalprice").alias("price_max")]
    )


@query(
    "agg_search_nested",
    """
    WITH o AS (SELECT o_orderpriority AS priority, date_trunc('year', o_orderdate) AS y, o_totalprice AS p FROM orders),
    one AS (SELECT priority, count(*) AS n FROM o GROUP BY 1 ORDER BY n DESC, priority LIMIT 3),
    two AS (SELECT priority, y, count(*) AS n FROM o JOIN one USING (priority) GROUP BY priority, y
            QUALIFY row_number() OVER (PARTITION BY priority ORDER BY count(*) DESC, y) <= 4),
    lows AS (SELECT * FROM (VALUES ('*-100000', 0, 100000), ('50000-200000', 50000, 200000), ('200000-*', 200000, 1e18)) AS v(label, lo, hi)),
    b AS (
      SELECT 1 AS depth, priority, NULL::TIMESTAMP AS y, NULL AS price, count(*) AS doc_count, sum(p::DECIMAL(18,2))::DOUBLE AS total FROM o JOIN one USING (priority) GROUP BY ALL
      UNION ALL SELECT 2, priority, y, NULL, count(*), sum(p::DECIMAL(18,2))::DOUBLE FROM o JOIN two USING (priority, y) GROUP BY ALL
      UNION ALL SELECT 3, priority, y, label, count(*), sum(p::DECIMAL(18,2))::DOUBLE FROM o JOIN two USING (priority, y) JOIN lows ON p >= lo AND p < hi GROUP BY ALL)
    SELECT depth, priority, epoch_ms(y) AS year_ms, price, doc_count, total FROM b
    """,
)
def _agg_nested(spark, sf):
    levels = [
        buckets.by_terms("priority", "o_orderpriority", size=3),
        buckets.Level("year", buckets.by_date("year", "o_orderdate", "year").labels, size=4),
        buckets.by_ranges("price", "o_totalprice", [(None, 100000), (50000, 200000), (200000, None)]),
    ]
    out = buckets.tree(table(spark, sf, "orders"), levels, [F.sum(cents("o_totalprice")).cast("double").alias("total")])
    return out.select("depth", "priority", ms(F.col("year")).alias("year_ms"), "price", "doc_count", "total")


@query(
    "agg_search_merged",
    """
    SELECT count(*) AS doc_count, min(o_totalprice) AS price_min, max(o_totalprice) AS price_max, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS price_sum,
           sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(o_totalprice) AS price_avg, count(DISTINCT o_custkey) AS customers,
           true AS customers_near, true AS median_near
    FROM orders
    """,
)
def _agg_merged(spark, sf):
    """Aggregates stored for each month and merged; sketches are held against exact figures."""
    orders = table(spark, sf, "orders").withColumn("month", F.date_trunc("month", "o_orderdate"))
    fields = ["o_totalprice", "o_custkey"]
    parts = stored(buckets.partial_aggregates(orders, ["month"], fields), "partial-aggregates")
    told = buckets.estimates(buckets.merged_aggregates(parts, ["month"], fields, batch=16), fields, [50])
    exact = orders.agg(F.count_distinct("o_custkey")).scalar()
    median = buckets.percentiles(orders, "o_totalprice", [47, 53]).agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi"))).scalar()
    told = told.withColumn("customers", exact).withColumn("m", median).withColumn("p50", F.col("o_totalprice_percentiles")[0])
    return told.select(
        "doc_count", F.col("o_totalprice_min").alias("price_min"), F.col("o_totalprice_max").alias("price_max"),
        F.col("o_totalprice_sum").cast("double").alias("price_sum"), F.col("o_totalprice_avg").alias("price_avg"), "customers",
        (F.abs(F.col("o_custkey_cardinality") - F.col("customers")) <= 0.03 * F.col("customers")).alias("customers_near"),
        F.col("p50").between(F.col("m.lo"), F.col("m.hi")).alias("median_near"),
    )


MONTHS_SQL = """
    WITH m AS (SELECT o_orderstatus AS status, epoch_ms(date_trunc('month', o_orderdate)) AS month_ms, count(*) AS doc_count
               FROM orders GROUP BY ALL)
"""


def _months(spark, sf):
    per_month = F.date_trunc("month", "o_orderdate")
    return (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderstatus").alias("status"), ms(per_month).alias("month_ms"))
        .agg(F.count(F.lit(1)).alias("doc_count"))
    )


@query(
    "bucket_cumulative_sum",
    MONTHS_SQL
    + """SELECT *, (sum(doc_count) OVER (PARTITION BY status ORDER BY month_ms))::BIGINT AS cumulative_sum FROM m""",
)
def _bucket_cumulative(spark, sf):
    return buckets.cumulative_sum(_months(spark, sf), order="month_ms", group="status")


@query(
    "bucket_derivative",
    MONTHS_SQL + """SELECT *, doc_count - lag(doc_count) OVER (PARTITION BY status ORDER BY month_ms) AS derivative FROM m""",
)
def _bucket_derivative(spark, sf):
    return buckets.derivative(_months(spark, sf), order="month_ms", group="status")


@query("bucket_sort", MONTHS_SQL + "SELECT * FROM m ORDER BY doc_count DESC, status, month_ms LIMIT 10 OFFSET 5")
def _bucket_sort(spark, sf):
    order = [F.desc("doc_count"), F.asc("status"), F.asc("month_ms")]
    return buckets.bucket_sort(_months(spark, sf), order, size=10, from_=5)


# ---------------------------------------------------------------------------------------
# Statistics and suggestions


@query(
    "term_statistics",
    f"""
    WITH t AS (SELECT doc_id, unnest({TOK}) AS term FROM documents)
    SELECT term, count(DISTINCT doc_id) AS doc_freq, count(*) AS total_term_freq FROM t WHERE term <> '' GROUP BY term
    """,
)
def _term_statistics(spark, sf):
    return search.term_statistics(_texts(spark, sf), "text")


@query(
    "term_statistics_merged",
    f"""
    WITH t AS (SELECT doc_id, source, unnest({TOK}) AS term FROM documents),
    c AS (SELECT source, term, count(DISTINCT doc_id) AS df, count(*) AS n FROM t WHERE term <> '' GROUP BY source, term),
    p AS (SELECT term, df, CASE WHEN source = 'src0' THEN -1 ELSE n END AS ttf FROM c)
    SELECT term, sum(df)::BIGINT AS doc_freq,
           (CASE WHEN min(ttf) = -1 THEN -1 ELSE sum(ttf) END)::BIGINT AS total_term_freq FROM p GROUP BY term
    """,
)
def _term_statistics_merged(spark, sf):
    parts = search.term_statistics(_texts(spark, sf), "text", shard="source")
    unknown = F.when(F.col("source") == "src0", F.lit(search.UNKNOWN)).otherwise(F.col("total_term_freq"))
    return search.merge_term_statistics(parts.withColumn("total_term_freq", unknown))


@query(
    "field_statistics",
    f"""
    WITH t AS (SELECT doc_id, unnest({TOK}) AS term FROM documents),
    f AS (SELECT doc_id, count(*) AS len, count(DISTINCT term) AS uniq FROM t WHERE term <> '' GROUP BY doc_id)
    SELECT (SELECT count(*) FROM documents) AS max_doc, count(*) AS doc_count,
           sum(len)::BIGINT AS sum_total_term_freq, sum(uniq)::BIGINT AS sum_doc_freq FROM f
    """,
)
def _field_statistics(spark, sf):
    parts = search.field_statistics(_texts(spark, sf), "text", shard="source")
    return search.merge_field_statistics(parts)


def suggest_sql(mode: str) -> str:
    return f"""
    WITH t AS (SELECT DISTINCT doc_id, term FROM (SELECT doc_id, unnest({TOK}) AS term FROM documents) WHERE term <> ''),
    v AS (SELECT term, count(*) AS doc_freq, translate(term, 'ßäçèéêíñóöü', '!"#$%&()*+,') AS plain FROM t GROUP BY term),
    q AS (SELECT unnest(['thier', 'wihth', 'from', 'qxvwk']) AS token),
    c AS (SELECT q.token, v.term, v.doc_freq, levenshtein(v.plain, q.token) AS distance FROM q JOIN v
          ON abs(len(v.plain) - len(q.token)) <= 2 AND levenshtein(v.plain, q.token) <= 2),
    o AS (SELECT c.*, coalesce((SELECT v.doc_freq FROM v WHERE v.term = c.token), 0) AS own FROM c),
    r AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY distance, doc_freq DESC, term) AS rank
          FROM o WHERE distance > 0 AND {mode})
    SELECT token, term AS suggestion, distance::INTEGER AS distance, doc_freq, rank::INTEGER AS rank FROM r WHERE rank <= 5
    """


def _suggest(mode):
    return lambda spark, sf: search.term_suggest(_texts(spark, sf), "text", "Thier wihth, from qxvwk", mode=mode)


query("term_suggest", suggest_sql("own = 0"))(_suggest("missing"))
query("term_suggest_popular", suggest_sql("doc_freq > own"))(_suggest("popular"))
query("term_suggest_always", suggest_sql("true"))(_suggest("always"))


@query("term_suggest_indexed", suggest_sql("doc_freq > own"))
def _term_suggest_indexed(spark, sf):
    return search.term_suggest(None, "text", "Thier wihth, from qxvwk", mode="popular", index=_indexed(spark, sf))


@query(
    "prefix_suggest",
    """
    WITH q AS (SELECT unnest(['blue', 'red']) AS name, unnest(['blue b', 'red']) AS prefix),
    r AS (SELECT q.name, p_partkey, p_name, p_retailprice,
                 row_number() OVER (PARTITION BY q.name ORDER BY p_retailprice DESC, p_name, p_partkey) AS rank
          FROM q JOIN part ON starts_with(p_name, q.prefix))
    SELECT name, p_partkey, p_name, p_retailprice, rank::INTEGER AS rank FROM r WHERE rank <= 5
    """,
)
def _prefix_suggest(spark, sf):
    return search.prefix_suggest(
        table(spark, sf, "part"), "p_name", "p_retailprice", "p_partkey", {"blue": "blue b", "red": "red"}
    )


@query(
    "multi_search",
    """
    (SELECT 0 AS search_no, doc_id, n_chars FROM documents WHERE lang = 'de' ORDER BY n_chars DESC, doc_id LIMIT 10)
    UNION ALL
    (SELECT 2, doc_id, n_chars FROM documents WHERE source = 'src1' ORDER BY n_chars, doc_id LIMIT 5)
    """,
)
def _multi_search(spark, sf):
    return _searches(spark, sf).hits.select("search_no", "doc_id", "n_chars")


@query(
    "multi_search_outcomes",
    """
    SELECT 0 AS search_no, true AS ok, NULL AS error, least(10, count(*)) AS n FROM documents WHERE lang = 'de'
    UNION ALL SELECT 1, false, 'AnalysisException', 0
    UNION ALL SELECT 2, true, NULL, least(5, count(*)) FROM documents WHERE source = 'src1'
    """,
)
def _multi_search_outcomes(spark, sf):
    result = _searches(spark, sf)
    sizes = result.hits.groupBy("search_no").agg(F.count(F.lit(1)).alias("n"))
    return result.outcomes.join(sizes, "search_no", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def _searches(spark, sf):
    requests = [
        search.SearchRequest(query={"term": {"lang": "de"}}, sort="n_chars:desc", size=10),
        search.SearchRequest(query={"term": {"no_such_field": 1}}, sort="n_chars:asc", size=5),
        search.SearchRequest(query={"term": {"source": "src1"}}, sort="n_chars:asc", size=5),
    ]
    return search.shared_searches(_docs(spark, sf), requests, "doc_id", ["doc_id", "n_chars"])


@query(
    "multi_search_scored",
    f"""WITH a AS (WITH {bm25(ASKED)} SELECT 0 AS search_no, doc_id, score FROM hits WHERE lang IN ('fr', 'de') ORDER BY score DESC, doc_id LIMIT 12 OFFSET 3),
    b AS (WITH {bm25('the les')} SELECT 1 AS search_no, doc_id, score FROM hits WHERE score >= 0.2 ORDER BY score DESC, doc_id LIMIT 20),
    c AS (SELECT 2 AS search_no, doc_id, 1.0::DOUBLE AS score FROM documents WHERE source = 'src2' ORDER BY lang, n_chars DESC, doc_id LIMIT 7)
    SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c""",
)
def _multi_search_scored(spark, sf):
    requests = [
        search.SearchRequest(text="text", match=ASKED, query={"terms": {"lang": ["fr", "de"]}}, size=12, from_=3),
        search.SearchRequest(text="text", match="the les", min_score=0.2, size=20),
        search.SearchRequest(query={"term": {"source": "src2"}}, sort="lang:asc,n_chars:desc", size=7),
    ]
    hits = search.shared_searches(_docs(spark, sf), requests, "doc_id", ["doc_id"]).hits
    return hits.select("search_no", "doc_id", F.col("_score").alias("score"))


SEARCH_SQL = f"""WITH {bm25(ASKED)},
    f AS (SELECT * FROM hits WHERE lang IN ('en', 'fr') AND score >= 0.5),
    c AS (SELECT * FROM f WHERE n_chars >= 300 QUALIFY row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) = 1)
"""


def _request():
    return search.SearchRequest(
        text="text",
        match=ASKED,
        query={"terms": {"lang": ["en", "fr"]}},
        post_filter={"range": {"n_chars": {"gte": 300}}},
        min_score=0.5,
        collapse="source",
        from_=2,
        size=8,
        aggs={"sources": ("terms", {"field": "source", "size": None})},
    )


def _result(spark, sf):
    return search.search(_texts(spark, sf), _request(), "doc_id")


@query("search", SEARCH_SQL + "SELECT doc_id, lang, source, score FROM c ORDER BY score DESC, doc_id LIMIT 8 OFFSET 2")
def _search(spark, sf):
    return _result(spark, sf).hits.select("doc_id", "lang", "source", F.col("_score").alias("score"))


@query(
    "search_stats",
    SEARCH_SQL
    + """SELECT (SELECT count(*) FROM f WHERE n_chars >= 300) AS total_hits, greatest(0, least(8, (SELECT count(*) FROM c) - 2)) AS fetched_hits,
    (SELECT max(score) FROM f WHERE n_chars >= 300) AS max_score""",
)
def _search_stats(spark, sf):
    return _result(spark, sf).stats


@query("search_aggs", SEARCH_SQL + "SELECT source AS bucket, count(*) AS doc_count FROM f WHERE source IS NOT NULL GROUP BY 1")
def _search_aggs(spark, sf):
    return _result(spark, sf).aggs["sources"]


@query(
    "search_terminated",
    f"""WITH {bm25(ASKED)},
    t AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 20)
    SELECT doc_id, score FROM t ORDER BY score DESC, doc_id LIMIT 15""",
)
def _search_terminated(spark, sf):
    request = search.SearchRequest(text="text", match=ASKED, shard="source", terminate_after=20, size=15)
    return search.search(_texts(spark, sf), request, "doc_id").hits.select("doc_id", F.col("_score").alias("score"))


@query(
    "search_rescored",
    f"""WITH {bm25(ASKED)},
    b AS (SELECT doc_id, n_chars, score AS own, score * CASE lang WHEN 'fr' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS score FROM hits),
    r AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS pos FROM b),
    s AS (SELECT doc_id, n_chars * 2 AS twice, pos <= 30 AS rescored, score + CASE WHEN pos <= 30 THEN own * 0.5::DOUBLE ELSE 0 END AS score FROM r)
    SELECT doc_id, twice, rescored, round(score, 6) AS score FROM s ORDER BY rescored DESC, s.score DESC, doc_id LIMIT 40""",
)
def _search_rescored(spark, sf):
    request = search.SearchRequest(
        text="text", match=ASKED, boosts=[("docs_fr", 2.0)], rescore=search.Rescore(ASKED, window=30, weight=0.5),
        script_fields={"twice": "n_chars * 2"}, size=40,
    )
    docs = _texts(spark, sf).withColumn("_table", F.concat(F.lit("docs_"), "lang"))
    hits = search.search(docs, request, "doc_id").hits
    return hits.select("doc_id", "twice", F.col("_rescored").alias("rescored"), F.round("_score", 6).alias("score"))


# ---------------------------------------------------------------------------------------
# Searches with the stored postings of a table version

_INDEXES: dict[tuple[str, str, str], TermIndex] = {}


def _indexed(spark, sf) -> TermIndex:
    """The index of `documents`, by `source`; built once for a session and table."""
    key = (spark.sparkContext.applicationId, sf, "source")
    if key not in _INDEXES:
        index = build_index(_texts(spark, sf), "doc_id", "text", scratch_dir(spark, "term-index"), "source", block_docs=256)
        _INDEXES[key] = index.with_variants()
    return _INDEXES[key]


@query("match_score_indexed", f"WITH {bm25(ASKED)} SELECT doc_id, score FROM hits")
def _match_score_indexed(spark, sf):
    return _indexed(spark, sf).match_score(ASKED).select("doc_id", F.col("_score").alias("score"))


@query("match_score_slot_indexed", f"WITH {bm25(ASKED, 'source')} SELECT doc_id, source, score FROM hits")
def _match_score_slot_indexed(spark, sf):
    found = _indexed(spark, sf).match_score(ASKED, per_shard=True)
    return found.select("doc_id", F.col("shard").alias("source"), F.col("_score").alias("score"))


@query("top_docs_indexed", f"WITH {bm25(ASKED)} SELECT doc_id, score FROM hits ORDER BY score DESC, doc_id LIMIT 20 OFFSET 10")
def _top_docs_indexed(spark, sf):
    best = _indexed(spark, sf).top(ASKED, 30).withColumnRenamed("_score", "score").select("doc_id", "score")
    return ordering.top_docs(best, ordering.by_score("doc_id", "score"), size=20, from_=10)


@query(
    "term_statistics_indexed",
    f"""WITH w AS (SELECT doc_id, unnest({TOK}) AS term FROM documents)
    SELECT term, count(DISTINCT doc_id) AS doc_freq, count(*) AS total_term_freq FROM w WHERE term <> '' GROUP BY term""",
)
def _term_statistics_indexed(spark, sf):
    return _indexed(spark, sf).term_statistics()


@query("search_indexed", SEARCH_SQL + "SELECT doc_id, lang, source, score FROM c ORDER BY score DESC, doc_id LIMIT 8 OFFSET 2")
def _search_indexed(spark, sf):
    hits = search.search(_docs(spark, sf), _request(), "doc_id", _indexed(spark, sf)).hits
    return hits.select("doc_id", "lang", "source", F.col("_score").alias("score"))


@query(
    "search_filtered_indexed",
    f"""WITH {bm25(ASKED)}
    SELECT doc_id, lang, score FROM hits WHERE lang IN ('en', 'fr') AND n_chars >= 300 AND score >= 0.5 ORDER BY score DESC, doc_id LIMIT 12 OFFSET 4""",
)
def _search_filtered_indexed(spark, sf):
    request = search.SearchRequest(
        match=ASKED, query={"terms": {"lang": ["en", "fr"]}}, post_filter={"range": {"n_chars": {"gte": 300}}}, min_score=0.5, from_=4, size=12
    )
    hits = search.search(_docs(spark, sf), request, "doc_id", _indexed(spark, sf)).hits
    return hits.select("doc_id", "lang", F.col("_score").alias("score"))


@query(
    "search_rescored_indexed",
    f"""WITH a AS (WITH {bm25(ASKED)} SELECT * FROM hits), b AS (WITH {bm25('und the')} SELECT doc_id, score AS second FROM hits),
    r AS (SELECT a.doc_id, score, second, row_number() OVER (ORDER BY score DESC, a.doc_id) AS pos FROM a LEFT JOIN b ON a.doc_id = b.doc_id),
    s AS (SELECT doc_id, pos <= 30 AS rescored, score + CASE WHEN pos <= 30 THEN coalesce(second, 0) * 0.5::DOUBLE ELSE 0 END AS score FROM r WHERE pos <= 40)
    SELECT doc_id, rescored, round(score, 6) AS score FROM s ORDER BY rescored DESC, s.score DESC, doc_id LIMIT 35""",
)
def _search_rescored_indexed(spark, sf):
    request = search.SearchRequest(match=ASKED, rescore=search.Rescore("und the", window=30, weight=0.5), size=35)
    hits = search.search(_docs(spark, sf), request, "doc_id", _indexed(spark, sf)).hits
    return hits.select("doc_id", F.col("_rescored").alias("rescored"), F.round("_score", 6).alias("score"))


CHANGED = """documents_changed AS (
    SELECT doc_id, lang, source, n_chars, CASE WHEN doc_id % 10 = 5 THEN text || ' with extra from les' ELSE text END AS text
    FROM documents WHERE doc_id % 10 <> 3
    UNION ALL SELECT doc_id + 100000000, lang, source, n_chars, 'with les ' || lang FROM documents WHERE doc_id % 10 = 7)"""


def _changed(spark, sf):
    """The changed table, its outcomes, and the index of the version after the changes."""
    docs, fields = _docs(spark, sf), ["lang", "source", "n_chars", "text"]
    digit = F.col("doc_id") % 10
    text = F.when(digit == 5, F.concat("text", F.lit(" with extra from les"))).when(digit == 7, F.concat(F.lit("with les "), "lang"))
    ops = docs.filter(digit.isin(3, 5, 7)).select(
        F.col("doc_id").alias("seq"),
        F.when(digit == 3, "delete").when(digit == 5, "update").otherwise("index").alias("op"),
        F.when(digit == 7, F.col("doc_id") + 100_000_000).otherwise(F.col("doc_id")).alias("id"),
        *[F.when(digit == 7, F.col(c)).alias(c) for c in fields[:3]],
        text.alias("text"),
    )
    applied = changes.apply_changes(docs, ops, "doc_id", fields)
    key = (spark.sparkContext.applicationId, sf, "changed")
    if key not in _INDEXES:
        _INDEXES[key] = _indexed(spark, sf).compacted(scratch_dir(spark, "term-index")).after_changes(docs, applied.table, applied.outcomes)
    return applied.table, _INDEXES[key]


@query(
    "search_after_changes",
    f"WITH {CHANGED}, {bm25(ASKED).replace('documents', 'documents_changed')} SELECT doc_id, lang, score FROM hits ORDER BY score DESC, doc_id LIMIT 50",
)
def _search_after_changes(spark, sf):
    docs, index = _changed(spark, sf)
    hits = search.search(docs, search.SearchRequest(match=ASKED, size=50), "doc_id", index).hits
    return hits.select("doc_id", "lang", F.col("_score").alias("score"))


@query(
    "term_statistics_after_changes",
    f"""WITH {CHANGED}, w AS (SELECT doc_id, unnest({TOK}) AS term FROM documents_changed)
    SELECT term, count(DISTINCT doc_id) AS doc_freq, count(*) AS total_term_freq FROM w WHERE term <> '' GROUP BY term""",
)
def _term_statistics_after_changes(spark, sf):
    return _changed(spark, sf)[1].term_statistics()


SLOT_SQL = "('0x' || substr(md5(coalesce({0}, doc_id::VARCHAR)), 1, 8))::BIGINT % 8"


@query(
    "slot_search",
    f"""SELECT doc_id, source, n_chars FROM documents
    WHERE {SLOT_SQL.format('source')} IN (SELECT ('0x' || substr(md5(r), 1, 8))::BIGINT % 8 FROM (SELECT unnest(['src1', 'src4']) AS r))
      AND lang IN ('en', 'de')
    ORDER BY n_chars DESC, doc_id LIMIT 20""",
)
def _slot_search(spark, sf):
    placed = routing.assign_slot(_docs(spark, sf), "doc_id", 8, 8, "source", method="md5")
    request = search.SearchRequest(query={"terms": {"lang": ["en", "de"]}}, sort="n_chars:desc", size=20)
    return search.slot_search(placed, request, "doc_id", ["src1", "src4"], 8, "md5").hits.select("doc_id", "source", "n_chars")


@query(
    "slot_search_indexed",
    f"""WITH pruned AS (SELECT * FROM documents
      WHERE {SLOT_SQL.format('source')} IN (SELECT ('0x' || substr(md5(r), 1, 8))::BIGINT % 8 FROM (SELECT unnest(['src1', 'src4']) AS r))),
    {bm25(ASKED).replace('documents', 'pruned')} SELECT doc_id, source, score FROM hits WHERE lang IN ('en', 'fr') ORDER BY score DESC, doc_id LIMIT 20""",
)
def _slot_search_indexed(spark, sf):
    placed = routing.assign_slot(_docs(spark, sf), "doc_id", 8, 8, "source", method="md5")
    key = (spark.sparkContext.applicationId, sf, "slot")
    if key not in _INDEXES:
        _INDEXES[key] = build_index(placed, "doc_id", "text", scratch_dir(spark, "term-index"), "slot", block_docs=256)
    request = search.SearchRequest(match=ASKED, query={"terms": {"lang": ["en", "fr"]}}, size=20)
    hits = search.slot_search(placed, request, "doc_id", ["src1", "src4"], 8, "md5", _INDEXES[key]).hits
    return hits.select("doc_id", "source", F.col("_score").alias("score"))


# ---------------------------------------------------------------------------------------
# Node statistics: events as nodes, their properties as attributes


def _nodes(spark, sf):
    ev = table(spark, sf, "events")
    props = F.from_json("props", "map<string,string>")
    attrs = F.map_concat(props, F.create_map(F.lit("zone"), F.concat(F.lit("z"), F.col("user_id") % 3)))
    return ev.select(
        F.col("event_id").alias("node_id"),
        attrs.alias("attrs"),
        F.struct(F.col("value").alias("load")).alias("os"),
        F.struct(F.col("user_id").alias("heap")).alias("jvm"),
        F.struct(F.col("event_id").alias("docs"), F.length("props").alias("store"), F.col("user_id").alias("get")).alias("indices"),
    )


@query(
    "attr_filter",
    """
    SELECT event_id AS node_id FROM events
    WHERE props->>'k' IN ('1', '2', '3', '50') AND 'z' || (user_id % 3) = 'z1'
    """,
)
def _attr_filter(spark, sf):
    return filters.attr_filter(_nodes(spark, sf), "k|1|2|3|50,zone|z1,ignored").select("node_id")


@query(
    "metric_select",
    "SELECT event_id AS node_id, value AS load, event_id AS docs, len(props)::INTEGER AS store FROM events",
)
def _metric_select(spark, sf):
    out = filters.metric_select(_nodes(spark, sf), "os,indices", "docs,store")
    return out.select("node_id", "os.load", "indices.docs", "indices.store")
