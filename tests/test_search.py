import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from slotwise.functions.text import query_tokens, snake_case, tokens
from slotwise.operators import buckets, filters, ordering, search
from slotwise.session import scratch_dir

DOCS = [
    (1, "the quick brown fox", "en", 5),
    (2, "the lazy dog; the quick dog", "en", 9),
    (3, "der schnelle Fuchs", "de", 2),
    (4, "", "de", 9),
    (5, "QUICK quick quíck", None, 1),
    (6, None, None, 4),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id bigint, text string, lang string, n int").cache()


def words(text):
    return query_tokens(text) and [w for w in __import__("re").findall(r"[^\W_]+", (text or "").lower())]


def bm25(query, data):
    bags = {d[0]: words(d[1] or "") or [] for d in data}
    n = sum(1 for b in bags.values() if b)
    avg = sum(map(len, bags.values())) / n
    out = {}
    for ident, bag in bags.items():
        score = 0.0
        for term in dict.fromkeys(query.split()):
            df = sum(1 for b in bags.values() if term in b)
            tf = bag.count(term)
            idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
            score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(bag) / avg))
        if score:
            out[ident] = round(score, 6)
    return out


def test_text_helpers(spark):
    assert snake_case("createAt") == "create_at" and snake_case("aBC") == "a_b_c"
    assert query_tokens("The the, quick_dog") == ["the", "quick", "dog"]
    df = spark.createDataFrame([("Ärger--mit 2 Hüten!",)], "t string")
    assert df.select(tokens(F.col("t"))).first()[0] == ["ärger", "mit", "2", "hüten"]


@pytest.mark.parametrize("query", ["quick", "quick dog fuchs", "the"])
def test_scores_follow_the_formula(docs, query):
    got = {r.id: r._score for r in search.match_score(docs, "text", query).collect()}
    assert got == pytest.approx(bm25(query, DOCS), abs=1e-6)


def test_shard_scores_use_their_own_statistics(docs):
    got = {r.id: r._score for r in search.match_score(docs, "text", "quick", shard="lang").collect()}
    want = {}
    for lang in ("en", "de", None):
        want |= bm25("quick", [d for d in DOCS if d[2] == lang])
    assert got == pytest.approx(want, abs=1e-6)
    assert search.match_score(docs, "text", "?!").count() == 0


def test_unknown_statistics_are_contagious(spark, docs):
    parts = spark.createDataFrame([("a", 1, 4), ("a", 2, -1), ("b", 1, 2), ("b", 1, 3)], "term string, doc_freq bigint, total_term_freq bigint")
    assert rows(search.merge_term_statistics(parts)) == [("a", 3, -1), ("b", 2, 5)]
    whole = rows(search.term_statistics(docs, "text"))
    merged = rows(search.merge_term_statistics(search.term_statistics(docs, "text", shard="lang")))
    assert merged == whole and ("quick", 3, 4) in whole
    fields = search.merge_field_statistics(search.field_statistics(docs, "text", shard="lang"))
    assert tuple(fields.first()) == (6, 4, 16, 13)


def test_query_specs(docs):
    ids = lambda spec: [r[0] for r in rows(docs.filter(filters.query_filter(spec)).select("id"))]
    assert ids({"match": {"text": "DOG fuchs"}}) == [2, 3]
    assert ids({"bool": {"must_not": {"exists": {"field": "lang"}}}}) == [5, 6]
    assert ids({"bool": {"filter": [{"range": {"n": {"gt": 2, "lte": 9}}}], "must_not": {"term": {"lang": "de"}}}}) == [1, 2, 6]
    assert ids({"match_all": {}}) == [1, 2, 3, 4, 5, 6]
    for bad in ({"fuzzy": {"text": "x"}}, {"bool": {"should": []}}):
        with pytest.raises(ValueError):
            filters.query_filter(bad)


def test_source_fields_reach_into_structs(spark):
    df = spark.createDataFrame([(1, (2, ("x", "y")), "k")], "id int, a struct<b:int,c:struct<d:string,e:string>>, keep_id string")
    assert filters.source_fields(df, ["a.c.*", "*_id"], ["a.c.e"]).schema.simpleString() == "struct<a:struct<c:struct<d:string>>,keep_id:string>"
    assert filters.source_fields(df, ["a"]).schema["a"] == df.schema["a"]
    assert filters.source_fields(df, enabled=False, always=["id"]).columns == ["id"]
    pruned = filters.source_fields(df, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "keep_id" not in pruned.split("LogicalRDD")[0]


def test_sort_specs_and_nulls(docs):
    assert ordering.parse_sort("a:asc,b:desc,c,d:up,_score") == [("a", True), ("b", False), ("c", True), ("_score", False)]
    order = [r.id for r in ordering.sort_by(docs, "lang:desc", "id").collect()]
    assert order == [1, 2, 3, 4, 5, 6]
    order = [r.id for r in ordering.sort_by(docs, "lang", "id").collect()]
    assert order == [3, 4, 1, 2, 5, 6]


@pytest.mark.parametrize("spec", ["lang,n:desc", "lang:desc,n", "n"])
def test_page_chains_equal_the_full_sort(spark, docs, spec):
    want = [r.id for r in ordering.sort_by(docs, spec, "id").collect()]
    first = [r for r in ordering.sort_by(docs, spec, "id").limit(2).collect()]
    seen, last = [r.id for r in first], first[-1]
    while True:
        values = [last[k] for k, _ in ordering.parse_sort(spec)] + [last.id]
        page = ordering.search_after(docs, spec, "id", values, 2).collect()
        if not page:
            break
        seen += [r.id for r in page]
        last = page[-1]
    assert seen == want
    paged = ordering.scroll_pages(spark, docs, spec, "id", 4, scratch_dir(spark, "scroll-test"))
    assert [r.id for r in paged.orderBy("_pos").collect()] == want
    assert rows(paged.groupBy("_page").count()) == [(0, 4), (1, 2)]
    for args in [(1, 10, True), (0, 0, True), (0, 10, False)]:
        with pytest.raises(ValueError):
            ordering.check_scroll(*args)


def test_collapse_counts_null_as_a_group_and_expands(docs):
    order = ordering.sort_columns([("n", False)], "id")
    best = ordering.collapse(docs, "lang", order)
    assert rows(best.select("id")) == [(2,), (4,), (6,)]
    specs = [
        search.InnerHits("small", size=1, sort="n:asc", fields=("id", "n")),
        search.InnerHits("second", size=5, from_=1, sort="n:asc"),
    ]
    out = search.expand_collapsed(best, docs, "lang", "id", specs).collect()
    got = {r.id: ([(s.id, s.n) for s in r.small], [s.id for s in r.second]) for r in out}
    assert got == {2: ([(1, 5)], [2]), 4: ([(3, 2)], [4]), 6: ([(5, 1)], [6])}


@pytest.mark.parametrize("count", [2, 3, 2000])
@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_terminate_after_any_count_and_id(spark, count, kind):
    df = spark.range(50).select(F.col("id").cast(kind).alias("id"), (F.col("id") % 3).alias("shard"))
    limited = rows(ordering.terminate_after(df, "shard", "id", count))
    assert len(limited) == min(50, 3 * count)
    assert ordering.terminated_early(df, "shard", count).first()[0] is (count < 17)
    assert ordering.terminate_after(df, "shard", "id", 0).count() == 50
    with pytest.raises(ValueError):
        ordering.terminate_after(df, "shard", "id", -1)


def test_rescore_keeps_the_rest_below(spark):
    hits = spark.createDataFrame([(1, 5.0), (2, 4.0), (3, 3.0), (4, 2.0)], "id int, _score double")
    second = spark.createDataFrame([(2, 10.0), (4, 100.0)], "id int, second_score double")
    out = ordering.rescore(hits, second, "id", window=3, weight=0.5)
    got = [(r.id, r._score) for r in out.orderBy(*ordering.rescored_order("id")).collect()]
    assert got == [(2, 9.0), (1, 5.0), (3, 3.0), (4, 2.0)]
    with pytest.raises(ValueError):
        ordering.rescore(hits, second, "id", window=0)


def test_hit_stats_edges(spark):
    none = spark.createDataFrame([], "id int, _score double")
    stats = search.hit_stats(none, track_total=False).first()
    assert stats.total_hits == -1 and stats.fetched_hits == 0 and math.isnan(stats.max_score)


def test_boosts_first_entry_wins(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "_table string, _score double")
    assert rows(search.boost_tables(df, [("a", 2.0), ("a", 5.0)])) == [("a", 2.0), ("b", 1.0)]


def test_aggregations(docs):
    aggs = buckets.agg_search(
        docs,
        {
            "langs": ("terms", {"field": "lang"}),
            "n": ("stats", {"field": "n"}),
            "kinds": ("cardinality", {"field": "lang", "exact": True}),
            "about": ("cardinality", {"field": "lang"}),
            "bins": ("histogram", {"field": "n", "interval": 4}),
            "spans": ("range", {"field": "n", "bounds": [(None, 5), (5, None), (50, 60)]}),
            "mid": ("percentiles", {"field": "n", "percents": [50]}),
            "some": ("filter", {"predicate": F.col("n") > 4}),
        },
    )
    assert [tuple(r) for r in aggs["langs"].collect()] == [("de", 2), ("en", 2)]
    assert tuple(aggs["n"].first()) == (6, 1, 9, 5.0, 30.0)
    assert aggs["kinds"].first()[0] == aggs["about"].first()[0] == 2
    assert rows(aggs["bins"]) == [(0.0, 2), (4.0, 2), (8.0, 2)]
    assert rows(aggs["spans"]) == [("*-5", 3), ("5-*", 3), ("50-60", 0)]
    assert aggs["mid"].first()[1] == 4 and aggs["some"].first()[0] == 3
    with pytest.raises(ValueError):
        buckets.agg_search(docs, {"x": ("geo", {})})
    bins = buckets.cumulative_sum(aggs["bins"])
    assert [r.cumulative_sum for r in bins.orderBy("bucket").collect()] == [2, 4, 6]
    assert [r.derivative for r in buckets.derivative(bins).orderBy("bucket").collect()] == [None, 0, 0]


@pytest.mark.parametrize("accuracy", [20, 100_000])
def test_percentiles_are_exact_beyond_the_accuracy_of_their_bounds(spark, monkeypatch, accuracy):
    monkeypatch.setattr(buckets, "ACCURACY", accuracy)
    draw = random.Random(3)
    values = [draw.choice([7, draw.randrange(10_000), draw.randrange(50)]) for _ in range(5_000)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "n bigint").repartition(7)
    percents = [0, 1, 5, 33.3, 50, 99, 100]
    got = {r.percent: r.value for r in buckets.percentiles(df, "n", percents).collect()}
    ordered = sorted(values)
    assert got == {float(p): ordered[max(math.ceil(p * len(values) / 100), 1) - 1] for p in percents}
    assert buckets.percentiles(df.filter("n IS NULL"), "n").count() == 0
    sketch = {r.percent: r.value for r in buckets.percentiles_sketch(df, "n", [50]).collect()}
    assert abs(sketch[50.0] - got[50.0]) <= 5


def test_request_parts_that_exclude_each_other(docs):
    second = search.Rescore("dog", 2)
    for wrong in ({"sort": "n:asc"}, {"collapse": "lang"}, {"search_after": [1.0, 1]}):
        with pytest.raises(ValueError):
            search.search(docs, search.SearchRequest(text="text", match="quick", rescore=second, **wrong), "id")
    with pytest.raises(ValueError):
        search.search(docs, search.SearchRequest(text="text", match="quick", shard_statistics=True), "id")


def test_slices_of_a_search_are_disjoint_and_whole(docs):
    def part(index):
        request = search.SearchRequest(slice=search.Slice("id", index, 3), size=100)
        return [r.id for r in search.search(docs, request, "id").hits.collect()]

    assert sorted(part(0) + part(1) + part(2)) == [d[0] for d in DOCS]


def test_rescored_search_ranks_its_window_first(docs):
    request = search.SearchRequest(text="text", match="quick", rescore=search.Rescore("dog", 2, 10.0), script_fields={"m": "n + 1"})
    plain = search.search(docs, search.SearchRequest(text="text", match="quick"), "id").hits.collect()
    got = search.search(docs, request, "id").hits.collect()
    assert {r.id for r in got} == {r.id for r in plain} and [r._rescored for r in got] == [True, True, False]
    assert all(r.m == r.n + 1 for r in got) and got[2].id == plain[2].id


def test_suggestions(spark, docs):
    got = search.term_suggest(docs, "text", "quik dog", mode="missing")
    assert rows(got.select("token", "suggestion", "distance", "doc_freq")) == [("quik", "quick", 1, 3), ("quik", "quíck", 2, 1)]
    popular = search.term_suggest(docs, "text", "dog the", mode="popular")
    assert popular.count() == 0
    always = search.term_suggest(docs, "text", "dog", mode="always")
    assert [r.suggestion for r in always.orderBy("rank").collect()] == ["der", "fox"]
    with pytest.raises(ValueError):
        search.term_suggest(docs, "text", "x", mode="never")
    opts = spark.createDataFrame([(1, "blue", 3), (2, "blues", 3), (3, "black", 9)], "id int, o string, w int")
    out = search.prefix_suggest(opts, "o", "w", "id", {"x": "bl", "y": "blu"}, size=2)
    assert rows(out.select("name", "id", "rank")) == [("x", 1, 2), ("x", 3, 1), ("y", 1, 1), ("y", 2, 2)]


def test_multi_search_reports_failures(spark, docs):
    out = search.multi_search(spark, [lambda: docs.select("id"), lambda: docs.select("nope"), lambda: docs.limit(1).select("id")])
    assert rows(out.outcomes.select("search_no", "ok")) == [(0, True), (1, False), (2, True)]
    assert rows(out.hits.groupBy("search_no").count()) == [(0, 6), (2, 1)]
    with pytest.raises(ValueError):
        search.multi_search(spark, [])
    with pytest.raises(ValueError):
        search.multi_search(spark, [lambda: docs], max_concurrent=0)


def test_whole_search(docs):
    request = search.SearchRequest(
        text="text", match="quick the", query={"exists": {"field": "lang"}}, post_filter={"term": {"lang": "en"}},
        sort="_score,n:desc", size=1, inner_hits=[search.InnerHits("all", size=9, sort="n")], collapse="lang",
        includes=["text"], aggs={"langs": ("terms", {"field": "lang"})},
    )
    result = search.search(docs, request, "id")
    hit = result.hits.collect()
    want = bm25("quick the", DOCS)
    assert [h.id for h in hit] == [max((1, 2), key=want.get)]
    assert set(hit[0].asDict()) == {"id", "text", "n", "_score", "all"}
    assert [s.id for s in hit[0]["all"]] == [1, 2]
    assert result.stats.first().total_hits == 2
    assert rows(result.aggs["langs"]) == [("en", 2)]
    with pytest.raises(ValueError):
        search.slot_search(docs, request, "id", [], 4)


def test_attributes_and_metrics(spark):
    nodes = spark.createDataFrame(
        [("n1", {"zone": "a", "disk": "ssd"}), ("n2", {"zone": "b"}), ("n3", None)], "node_id string, attrs map<string,string>"
    )
    ids = lambda spec: [r[0] for r in rows(filters.attr_filter(nodes, spec).select("node_id"))]
    assert ids("zone|a|b") == ["n1", "n2"]
    assert ids("zone|a|b,disk|ssd") == ["n1"]
    assert ids("zone|a|b,disk") == ["n1", "n2"]  # a key without values does not count
    assert ids("disk") == [] and ids(None) == ["n1", "n2", "n3"]
    stats = spark.createDataFrame([("n1", (1,), (2, 3))], "node_id string, os struct<x:int>, indices struct<docs:int,store:int>")
    assert filters.metric_select(stats).columns == ["node_id", "os", "indices"]
    assert filters.metric_select(stats, "indices", "store").select("indices.*").columns == ["store"]
    for bad in [("_all,os", None), ("zzz,aaa", None), ("os", "docs"), ("_all", "docs"), ("indices", "nope")]:
        with pytest.raises(ValueError):
            filters.metric_select(stats, *bad)
    with pytest.raises(ValueError, match=r"\['aaa', 'zzz'\]"):
        filters.metric_select(stats, "zzz,aaa")


def test_rescore_window_beyond_all_hits(spark):
    hits = spark.range(5).select("id", F.lit(1.0).alias("_score"))
    out = ordering.rescore(hits, hits.select("id", F.col("id").cast("double").alias("second_score")), "id", window=20_000)
    assert [r.id for r in out.orderBy(*ordering.rescored_order("id")).collect()] == [4, 3, 2, 1, 0]


def test_search_terminates_on_matching_documents(spark):
    docs = spark.range(40).select(
        "id", (F.col("id") % 2).alias("shard"), F.when(F.col("id") >= 20, "red fox").otherwise("hen").alias("text")
    )
    found = search.search(docs, search.SearchRequest(text="text", match="fox", shard="shard", terminate_after=3, size=4), "id")
    assert len(found.hits.collect()) == 4
    assert found.stats.first()["total_hits"] == 6


def test_stats_count_collapsed_hits(spark):
    docs = spark.range(20).select("id", (F.col("id") % 3).alias("kind"), F.lit("fox").alias("text"))
    found = search.search(docs, search.SearchRequest(text="text", match="fox", collapse="kind", size=10), "id")
    assert found.stats.first()["fetched_hits"] == 3
